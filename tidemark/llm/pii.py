"""Personal data by bootstrapped contextual extraction.

Base kinds are found by their patterns and checks; these instances are the seeds. The one or two
words before an instance are its lexical patterns. Instances and patterns form a graph with counts;
in each round a pattern's confidence is the share of its uses that confident instances of a kind
make up, and an unknown identifier's confidence is one minus the product of the doubts of the
accepted patterns that it follows. Patterns with enough support and confidence are accepted, confident
identifiers induce patterns of their own, and rounds go on until none is new. Accepted patterns turn
unknown identifiers (runs with six digits or more) into spans ``like_<kind>``. Base spans stay as they
are. A context reaches ``REACH`` code points back.

Spark counts, joins and scores; the graph's rows are summed counts, so a context or identifier that
a third of all documents share is one row. Null text is empty; an empty text has no spans; repeated
rows are all answered, and count as so many uses; an empty table gives an empty one. Other columns
are not looked at. Texts are searched whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.spans import find_spans
from tidemark.shared import write_and_read

KINDS = ("email", "ip", "card", "phone")
#: Patterns of the base kinds (fixed values), written so that no text takes quadratic time: a run of
#: letters is entered at its beginning or where the last match ended.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
IP_MUST = rf"^{PART}\.{PART}\.{PART}\.{PART}$"
#: Identifiers that may be personal: capitals, then digits and hyphens, six digits or more.
UNKNOWN = r"(?<![A-Za-z0-9-])[A-Z]{0,3}[0-9](?:-?[0-9]){5,}+(?![A-Za-z0-9-])"
#: Code points before a span in which its context is looked for.
REACH = 48
#: Least confidence of a pattern and of an identifier, and least confident instances of a pattern.
CONFIDENT, SUPPORT = 0.8, 5

SPAN = "struct<order:int,start:bigint,stop:bigint,kind:string,hit:string>"


def digits_of(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check: from the right, every second digit counts
    double, and a double above 9 loses 9."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda d, k: F.when(k % 2 == 0, d.cast("int")).otherwise(
            F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)
        ),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, d: a + F.coalesce(d, F.lit(0)))
    return total % 10 == 0


def is_card(hit: Column) -> Column:
    digits = digits_of(hit)
    return F.length(digits).between(16, 19) & luhn(digits)


def kept(text: Column, kind: str, pattern: str, order: int, holds: Callable | None) -> Column:
    spans = find_spans(text, pattern)
    if holds is not None:
        spans = F.filter(spans, lambda s: holds(s["hit"]))
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(order).alias("order"),
            s["start"].alias("start"),
            s["stop"].alias("stop"),
            F.lit(kind).alias("kind"),
            s["hit"].alias("hit"),
        ),
    )


def base_spans(text: Column) -> Column:
    """All base spans by kind and start."""
    return F.concat(
        kept(text, "email", EMAIL, 0, None),
        kept(text, "ip", IP, 1, lambda h: F.regexp_like(h, F.lit(IP_MUST))),
        kept(text, "card", CARD, 2, is_card),
        kept(text, "phone", PHONE, 3, lambda h: F.length(digits_of(h)).between(8, 15)),
    )


def contexts(text: Column, start: Column) -> Column:
    """The last word and the last two words before a place, in lower case with digits as 0."""
    from_ = F.greatest(start - REACH, F.lit(0))
    before = F.lower(F.substring(text, (from_ + 1).cast("int"), (start - from_).cast("int")))
    before = F.regexp_replace(before, "[0-9]", "0")
    one = F.regexp_extract(before, r"(\S+)\s*$", 1)
    two = F.regexp_extract(before, r"(\S+\s+\S+)\s*$", 1)
    return F.filter(F.array(one, two), lambda c: c != "")


def occurrences(docs: DataFrame) -> DataFrame:
    """(id, row, base, unknown) of rows (id, text): base spans, and unknown identifiers outside
    them; both with their contexts. ``row`` names a row for good once this is written."""
    text = F.col("text")
    rows = docs.select(
        "id", "text", base_spans(text).alias("base"), kept(text, "", UNKNOWN, 0, None).alias("other")
    )
    free = F.filter(
        "other",
        lambda o: ~F.exists("base", lambda b: (b["start"] < o["stop"]) & (o["start"] < b["stop"])),
    )

    def with_context(s: Column) -> Column:
        return s.withField("context", contexts(text, s["start"]))

    return rows.select(
        "id",
        F.monotonically_increasing_id().alias("row"),
        F.transform("base", with_context).alias("base"),
        F.transform(free, with_context).alias("unknown"),
    )


def uses_of(found: DataFrame) -> DataFrame:
    """(context, kind, instance, n): the graph's edges; kind is empty for unknown identifiers."""
    rows = found.where((F.size("base") > 0) | (F.size("unknown") > 0))
    spans = rows.select(F.explode(F.concat("base", "unknown")).alias("s"))
    uses = spans.select(F.explode("s.context").alias("context"), "s.kind", F.sha2("s.hit", 256).alias("instance"))
    return uses.groupBy("context", "kind", "instance").agg(F.count("*").alias("n"))


def confident_patterns(uses: DataFrame) -> DataFrame:
    """(context, kind, confidence) of the patterns that the rounds accept.

    Seeds have confidence 1 for their kind. What is accepted stays, so beliefs only grow and every round
    but the last accepts a pattern. Sums of counts per pattern and of logarithms per instance are all
    that moves; each round is written.
    """
    seeds = uses.where("kind <> ''").withColumn("belief", F.lit(1.0))
    unknown = write_and_read(uses.where("kind = ''").select("context", "instance", "n"), "unknown")
    totals = write_and_read(uses.groupBy("context").agg(F.sum("n").alias("uses")), "totals")

    def scored(edges: DataFrame) -> DataFrame:
        """Edges are one for each pattern and instance."""
        sums = edges.groupBy("context", "kind").agg(
            F.sum(F.col("n") * F.col("belief")).alias("sure"), F.count("*").alias("support")
        )
        shares = sums.where(F.col("support") >= SUPPORT).join(totals, "context")
        shares = shares.select("context", "kind", (F.col("sure") / F.col("uses")).alias("confidence"))
        return shares.where(F.col("confidence") >= CONFIDENT)

    accepted = write_and_read(scored(seeds), "patterns")
    while True:
        believed = instances(unknown, accepted).where(F.col("belief") >= CONFIDENT)
        edges = seeds.unionByName(unknown.join(believed, "instance"), allowMissingColumns=True)
        new = write_and_read(scored(edges).join(accepted, ["context", "kind"], "left_anti"), "patterns")
        if new.isEmpty():
            return accepted
        accepted = write_and_read(accepted.unionByName(new), "patterns")


def instances(unknown: DataFrame, patterns: DataFrame) -> DataFrame:
    """(instance, kind, belief): 1 - the product of (1 - confidence) over the patterns followed."""
    doubt = F.log1p(-F.least("confidence", F.lit(0.999999)))
    edges = unknown.join(patterns.where("confidence > 0"), "context")
    return edges.groupBy("instance", "kind").agg((1 - F.exp(F.sum(doubt))).alias("belief"))


def extract(docs: DataFrame) -> DataFrame:
    """(id, base, found) of rows (id, text): base spans by kind and start, and the spans that
    confident patterns add."""
    found = write_and_read(occurrences(docs), "occurrences")
    patterns = confident_patterns(uses_of(found))
    spans = found.where(F.size("unknown") > 0).select("row", F.explode("unknown").alias("s"))
    spans = spans.select("row", "s", F.explode("s.context").alias("context"))
    doubt = F.log1p(-F.least("confidence", F.lit(0.999999)))
    hits = spans.join(patterns, "context").groupBy("row", "s.start", "s.stop", "kind").agg(
        (1 - F.exp(F.sum(doubt))).alias("belief")
    )
    best = hits.where(F.col("belief") >= CONFIDENT).groupBy("row", "start", "stop").agg(
        F.max(F.struct("belief", "kind")).alias("best")
    )
    added = best.groupBy("row").agg(
        F.sort_array(
            F.collect_list(
                F.struct(
                    F.lit(len(KINDS)).alias("order"),
                    "start",
                    "stop",
                    F.concat(F.lit("like_"), "best.kind").alias("kind"),
                )
            )
        ).alias("found")
    )
    none = F.array().cast("array<struct<order:int,start:bigint,stop:bigint,kind:string>>")
    rows = found.join(added, "row", "left")
    return rows.select("id", "base", F.coalesce("found", none).alias("found"))
