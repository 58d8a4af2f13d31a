"""Secret scans with an incremental ledger of blobs.

Every version of a path is named by the hash of its content. The ledger is a table with a row for
each scan of a blob: the rule versions that were applied and the spans they found. A scan looks only
at the pairs of blob and rule version that the ledger lacks, each text once for all rules it still
needs; the findings go back to all paths and versions that hold the blob. A rule whose version
changes is applied anew, the others are not.

Null text is empty; an empty text has no findings. Rows with the same text are one blob, repeated
rows give repeated results; an empty table gives empty ones. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import find_spans, named
from tidemark.shared import write_and_read

SPANS = "array<struct<start:bigint,kind_order:int,stop:bigint,kind:string,hit:string>>"
LEDGER = f"blob string, rules array<string>, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """``must`` is a pattern that a match has to fulfil; a match that fails is dropped whole. ``plain``
    finds the same matches without possessive repetition, for engines that don't know it."""

    name: str
    version: int
    pattern: str
    must: str | None = None
    plain: str | None = None

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


#: Patterns of the base kinds (fixed values). A run of hex digits or capitals that is long enough is
#: asked for at once, which gives the same spans as dropping short runs afterwards.
ASSIGN = (
    "(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"
    "|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
)
ASSIGN_MUST = (
    r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{8,}$"""
)
BASE = (
    Rule("assign", 1, ASSIGN, ASSIGN_MUST),
    Rule("access", 1, "AKIA[A-Z0-9]{12,}"),
    Rule("hex", 1, "[0-9a-f]{32,}"),
)
def _pem(p: str) -> str:
    """A private key from its BEGIN line to the END line, whatever lies between except five hyphens in a
    row. Without an END: the header fields and the lines of base64 that follow, a line being whole up
    to its first other character; or its words of 32 and more on one line. With ``p`` set to "+" the
    repetitions are possessive: Java then loops over the lines of a key instead of nesting calls."""
    line = rf"[\x20\t]*{p}(?:\r?\n|\\r\\n|\\n)[\x20\t>]*{p}"
    code = "[A-Za-z0-9+/=]"
    return (
        "-----BEGIN [A-Z ]*PRIVATE KEY-----"
        f"(?:[^-]*{p}(?:-{{1,4}}{p}[^-]+{p})*{p}-----END [A-Z ]*PRIVATE KEY-----"
        f"|(?:{line}(?:Proc-Type|DEK-Info):[A-Za-z0-9,\\x20-]+{p})*{p}"
        f"(?:(?:{line})+{p}{code}{{16,}}{p}(?:{line}{code}+{p})*{p}"
        f"|(?:\\x20{code}{{32,}}{p})+{p}))?"
    )


#: Further kinds: private key blocks, web tokens, and tokens with a known beginning.
MORE = (
    Rule("pem", 3, _pem("+"), plain=_pem("")),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("prefixed", 1, "gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}"),
)
RULES = (*BASE, *MORE)


def empty_ledger(versions: DataFrame) -> DataFrame:
    return versions.sparkSession.createDataFrame([], LEDGER)


def _fulfils(must: str) -> Callable[[Column], Column]:
    return lambda span: F.regexp_like(span["hit"], F.lit(must))


def scan(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """New ledger rows for the rows (id, text) of ``versions``: one for every blob that still needs
    a rule."""
    texts = versions.select(F.sha2("text", 256).alias("blob"), "text").dropDuplicates(["blob"])
    known = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
    wanted = F.array(*(F.lit(r.key) for r in rules))
    todo = texts.join(known, "blob", "left").withColumn(
        "rules", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<string>")))
    )
    found = []
    for order, rule in enumerate(rules):
        spans = find_spans(F.col("text"), rule.pattern)
        if rule.must:
            spans = F.filter(spans, _fulfils(rule.must))
        needed = F.array_contains("rules", rule.key)
        found.append(F.when(needed, named(spans, rule.name, order)).otherwise(F.array().cast(SPANS)))
    return todo.where(F.size("rules") > 0).select("blob", "rules", F.concat(*found).alias("spans"))


def known_spans(ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(blob, spans) of the blobs with findings of these rule versions, by start and then by the
    order of the rules."""
    current = F.array(*(F.lit(r.key) for r in rules))
    # A row's spans stand for the rules of that row: those of a version that is gone don't count.
    kinds = F.transform(F.array_intersect("rules", current), lambda r: F.substring_index(r, "@", 1))
    own = ledger.select("blob", F.filter("spans", lambda s: F.array_contains(kinds, s["kind"])).alias("spans"))
    return (
        own.where(F.size("spans") > 0)
        .groupBy("blob")
        .agg(F.array_distinct(F.sort_array(F.flatten(F.collect_list("spans")))).alias("spans"))
    )


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(id, blob, spans): what the ledger holds for each row (id, text) of ``versions``."""
    found = write_and_read(known_spans(ledger, rules), "findings")
    rows = versions.select("id", F.sha2("text", 256).alias("blob"))
    none = F.array().cast(SPANS)
    return rows.join(found, "blob", "left").select("id", "blob", F.coalesce("spans", none).alias("spans"))


def redacted(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with every span, or run of spans that touch, replaced by ``mark``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        apart = (s["start"] > acc["at"]) | (acc["out"] == "")
        return F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.when(apart, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"),
        )

    def finish(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def redact(
    docs: DataFrame, ledger: DataFrame, mark: str = "[SECRET]", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the secrets that the ledger holds for its texts replaced. A null text stays."""
    found = write_and_read(known_spans(ledger), "findings")
    blob = F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)
    rows = docs.select(F.struct("*").alias("row"), blob.alias("blob")).join(found, "blob", "left")
    text = F.col(f"row.{text_col}")
    clean = F.when(F.col("spans").isNull(), text).otherwise(redacted(text, F.col("spans"), mark))
    return rows.select("row.*", clean.alias("_clean")).select(
        *(F.col("_clean").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns)
    )
