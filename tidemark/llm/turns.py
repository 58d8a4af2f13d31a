"""Repair of conversation structure by a run-length dynamic programme.

A conversation should be an optional system turn and then pairs of a user's and an assistant's turn,
read from the initials of the roles: ``(s?(ua)+)?``. Rows are taken by turn (nulls first; ties by role,
the first hundred code points of the text, its hash). Each has at most one fault, the first of

* blank: the text has only spaces, tabs and line ends, or nothing;
* duplicate: an earlier row of the conversation has its role and text;
* truncated: the last other character is none of ``.!?``.

Edits are Keep (costs 0), Rerole to user or assistant (3), Delete (4; blank and duplicate rows must go)
and Insert of an empty turn anywhere (3); a truncated row that stays costs 3 more. The cheapest edits are
chosen, ties by the least string of initials D, I, K, R.

The state of the programme is what may come next, so one row is a min-plus matrix of 4 x 4. Rows with the
same role class and fault in a row are one run; a run's matrix to the power of its length is applied by
binary powers, which are cached for each symbol, and only the choices are unrolled row by row.

Rows are sorted by ranges, so a long conversation is spread over tasks, which pack it into chunks. Texts
stay in their chunks; for the programme only runs come together, and the audit, one value of the result,
is as long as those. The digest of a conversation is one SHA-256 over all its text, which has no
parallel form: chunks stream through one task, which holds one at a time.

Nulls: role and text count as one space; conversations without id are one of their own; gaps ignore null
turns. Repeated rows are rows. An empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import partitions
from tidemark.shared import write_and_read

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: States: nothing written, after a system turn, after a user's, after an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
NEVER = 1 << 60
#: A chunk ends at so many rows or characters.
CHUNK_ROWS, CHUNK_CHARS = 4096, 1 << 20

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


# The programme -------------------------------------------------------------------------------------


def after(state: int, initial: str) -> int | None:
    """The state after a turn whose role begins with ``initial``; None where it may not come."""
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == "u":
        return None if state == USER else USER
    if initial == "a":
        return ASSISTANT if state == USER else None
    return None


def edits(symbol: str, state: int) -> dict[str, tuple[int, int]]:
    """(cost, next state) by letter for a row; ``symbol`` is its role's initial and its fault."""
    found = {"D": (DELETE, state)}
    if symbol[1] in "bd":
        return found
    more = TRUNCATED if symbol[1] == "t" else 0
    kept = after(state, symbol[0])
    if kept is not None:
        found["K"] = (KEEP + more, kept)
    found["R"] = (REROLE + more, NEXT[state])
    return found


def before(costs: list[int]) -> Vector:
    """The least costs where turns may be inserted first; three insertions pass through all states."""
    for _ in range(3):
        costs = [min(c, INSERT + costs[NEXT[s]]) for s, c in enumerate(costs)]
    return tuple(costs)


def times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(x + y for x, y in zip(row, col, strict=True)) for col in zip(*b, strict=True)) for row in a)


def step(a: Matrix, v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v, strict=True)) for row in a)


@cache
def power(symbol: str, bit: int) -> Matrix:
    """The matrix of 2**bit rows with this symbol."""
    if bit:
        half = power(symbol, bit - 1)
        return times(half, half)
    columns = []
    for end in range(4):
        reach = [min([c for c, t in edits(symbol, s).values() if t == end], default=NEVER) for s in range(4)]
        columns.append(before(reach))
    return tuple(zip(*columns, strict=True))


#: The least cost to end from each state.
END = before([0, NEVER, NEVER, 0])


def over_run(symbol: str, length: int, end: Vector) -> Vector:
    """Costs to go before a run, from those after it."""
    bit = 0
    while length:
        if length & 1:
            end = step(power(symbol, bit), end)
        length >>= 1
        bit += 1
    return end


@cache
def one_back(symbol: str, shape: Vector) -> tuple[int, Vector]:
    """``over_run`` of one row, as what is added to all and the rest above the least."""
    costs = step(power(symbol, 0), shape)
    least = min(costs)
    return least, tuple(c - least for c in costs)


@cache
def choose(symbol: str, shape: Vector, state: int) -> tuple[str, int]:
    """The least letters on a cheapest way over a row, and the state after it; ``shape`` are the costs
    to go after the row."""
    costs = step(power(symbol, 0), shape)
    letters = ""
    while True:
        ways = {k: c + shape[t] for k, (c, t) in edits(symbol, state).items()}
        ways["I"] = INSERT + costs[NEXT[state]]
        letter = min(k for k, c in ways.items() if c == costs[state])
        letters += letter
        if letter != "I":
            return letters, edits(symbol, state)[letter][1]
        state = NEXT[state]


def solve(runs: list[tuple[str, int]]) -> tuple[int, Iterator[str]]:
    """The cost of the cheapest edits, and their letters row by row (the last item: those at the end)."""
    ends = [END]
    for symbol, length in reversed(runs):
        ends.append(over_run(symbol, length, ends[-1]))
    ends.reverse()

    def letters() -> Iterator[str]:
        state = START
        for (symbol, length), end in zip(runs, ends[1:], strict=True):
            least = min(end)
            shapes = [tuple(c - least for c in end)]
            for _ in range(length - 1):
                shapes.append(one_back(symbol, shapes[-1])[1])
            for shape in reversed(shapes):
                found, state = choose(symbol, shape, state)
                yield found
        tail = ""
        while END[state]:
            tail, state = tail + "I", NEXT[state]
        yield tail

    return ends[0][START], letters()


# The tables ----------------------------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults by the checksum of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 takes its ``.!?`` away, 3 repeats it, 4 makes its role user."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")).cast("binary")) % 20
    text = or_space("text")
    return (
        rows.select("conv_id", "turn", or_space("role").alias("role"), text.alias("text"), kind.alias("kind"))
        .where("kind <> 0")
        .select(
            "conv_id",
            "turn",
            F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
            F.when(F.col("kind") == 1, F.lit(""))
            .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
            .otherwise(F.col("text"))
            .alias("text"),
            F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
        )
        .drop("copy")
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Distinct rows (conv, turn, role, text), how often each occurs, the fault of the first of them and
    of the others: b, d, t or a hyphen."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    counted = rows.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies"))
    name = F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), F.lit("")), F.length("role"), "role", "text")
    counted = write_and_read(counted.withColumn("name", F.unhex(F.sha2(name, 256))), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("there"), "turn")
    firsts = counted.groupBy("name").agg(F.min(place).alias("first"))
    seen = counted.join(firsts, "name")
    body = F.rtrim("text", F.lit(SPACES))
    later = F.when(body == "", F.lit("b")).otherwise(F.lit("d"))
    ends = F.when(F.substring(body, -1, 1).isin(".", "!", "?"), F.lit("-")).otherwise(F.lit("t"))
    fault = F.when(body == "", F.lit("b")).when(F.col("first") != place, F.lit("d")).otherwise(ends)
    return seen.select("conv", "turn", "role", "text", "copies", "name", fault.alias("fault"), later.alias("later"))


CHUNK = (
    "conv long, segment int, chunk int, symbols array<string>, lengths array<long>, roles array<string>, "
    "texts array<string>, copies array<long>, blank long, duplicate long, truncated long, illegal long, "
    "first_role string, last_role string, least_turn long, most_turn long, turns long"
)
SUMS = ("blank", "duplicate", "truncated", "illegal", "turns")


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    kinds |= {f"array<{k}>": pa.list_(v) for k, v in kinds.items()}
    return pa.schema([(n, kinds[k]) for n, k in (field.split(" ") for field in ddl.split(", "))])


def illegal(left: str | None, right: str) -> bool:
    return left is not None and left + right not in ("su", "ua", "au")


class Chunk:
    """Rows of a conversation that follow each other, being packed."""

    def __init__(self, conv: int | None, number: int) -> None:
        self.conv, self.number, self.chars = conv, number, 0
        self.runs: list[list] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.copies: list[int] = []
        self.turns: list[int] = []
        self.sums = dict.fromkeys(SUMS, 0)

    def add(self, turn: int | None, role: str, text: str, copies: int, fault: str, later: str) -> None:
        initial = role[:1]
        self.sums["illegal"] += illegal(self.roles[-1][:1] if self.roles else None, initial) + copies - 1
        for letter, count in ((fault, 1), (later, copies - 1)):
            name = {"b": "blank", "d": "duplicate", "t": "truncated"}.get(letter)
            if name:
                self.sums[name] += count
            symbol = (initial if initial in ("s", "u", "a") else "-") + letter
            if count and self.runs and self.runs[-1][0] == symbol:
                self.runs[-1][1] += count
            elif count:
                self.runs.append([symbol, count])
        if turn is not None:
            self.sums["turns"] += not self.turns or self.turns[-1] != turn
            self.turns = [self.turns[0] if self.turns else turn, turn]
        self.roles.append(role)
        self.texts.append(text)
        self.copies.append(copies)
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.roles) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS

    def row(self, segment: int) -> dict:
        return self.sums | {
            "conv": self.conv,
            "segment": segment,
            "chunk": self.number,
            "symbols": [s for s, _ in self.runs],
            "lengths": [n for _, n in self.runs],
            "roles": self.roles,
            "texts": self.texts,
            "copies": self.copies,
            "first_role": self.roles[0][:1],
            "last_role": self.roles[-1][:1],
            "least_turn": self.turns[0] if self.turns else None,
            "most_turn": self.turns[-1] if self.turns else None,
        }


def packed(faults: DataFrame) -> DataFrame:
    """Chunks of conversations: the range of their rows (segment), their number in it, runs and texts."""
    schema = arrow_schema(CHUNK)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segment, open_chunk, ready, chars = TaskContext.get().partitionId(), None, [], 0
        names = ("conv", "turn", "role", "text", "copies", "fault", "later")
        for batch in batches:
            for conv, *row in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if open_chunk is not None and (conv != open_chunk.conv or open_chunk.full()):
                    ready.append(open_chunk.row(segment))
                    chars += open_chunk.chars
                    number = open_chunk.number + 1 if conv == open_chunk.conv else 0
                    open_chunk = Chunk(conv, number)
                elif open_chunk is None:
                    open_chunk = Chunk(conv, 0)
                open_chunk.add(*row)
                if chars > CHUNK_CHARS:
                    yield pa.RecordBatch.from_pylist(ready, schema)
                    ready, chars = [], 0
        if open_chunk is not None:
            ready.append(open_chunk.row(segment))
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)

    keys = ["conv", "turn", "role", F.substring("text", 1, 100), "name"]
    dealt = faults.repartitionByRange(partitions(faults.sparkSession), *keys)
    return dealt.sortWithinPartitions(*keys).mapInArrow(work, CHUNK)


PLAN = (
    "conv long, segment int, chunk int, audit string, last boolean, gaps long, blank long, duplicate long, "
    "truncated long, illegal long, cost long"
)


def in_order(chunks: DataFrame, *after_keys: str) -> DataFrame:
    """All chunks of a conversation in one task, in order; conversations spread by hash."""
    dealt = chunks.repartition(partitions(chunks.sparkSession), "conv")
    return dealt.sortWithinPartitions("conv", "segment", "chunk", *after_keys)


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of each conversation from batches in order."""
    held: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if held and held[0]["conv"] != row["conv"]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def planned(chunks: DataFrame) -> DataFrame:
    """The letters of each chunk; the last chunk of a conversation has its figures."""
    schema = arrow_schema(PLAN)

    def plan(chunks_: list[dict]) -> list[dict]:
        runs: list[tuple[str, int]] = []
        for chunk in chunks_:
            for symbol, length in zip(chunk["symbols"], chunk["lengths"], strict=True):
                if runs and runs[-1][0] == symbol:
                    length += runs.pop()[1]
                runs.append((symbol, length))
        cost, letters = solve(runs)
        sums = {name: sum(c[name] for c in chunks_) for name in SUMS}
        out, turn, role = [], None, None
        for chunk in chunks_:
            audit = "".join(next(letters) for _ in range(sum(chunk["lengths"])))
            out.append({k: chunk[k] for k in ("conv", "segment", "chunk")} | {"audit": audit, "last": False})
            sums["illegal"] += illegal(role, chunk["first_role"])
            role = chunk["last_role"]
            if chunk["least_turn"] is not None:
                sums["turns"] -= turn == chunk["least_turn"]
                turn = chunk["most_turn"]
        first = next((c["least_turn"] for c in chunks_ if c["least_turn"] is not None), None)
        gaps = 0 if first is None else turn - first + 1 - sums.pop("turns")
        sums.pop("turns", None)
        out[-1] |= sums | {"last": True, "gaps": min(gaps, 2**63 - 1), "cost": cost}
        out[-1]["audit"] += next(letters)
        return out

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready: list[dict] = []
        for held in conversations(batches):
            ready += plan(held)
            if len(ready) >= 4096:
                yield pa.RecordBatch.from_pylist(ready, schema)
                ready = []
        if ready:
            yield pa.RecordBatch.from_pylist(ready, schema)

    return in_order(chunks.drop("roles", "texts", "copies")).mapInArrow(work, PLAN)


REPAIRED = PLAN + ", roles array<string>, texts array<string>, sha256 string"


def applied(chunks: DataFrame, plans: DataFrame) -> DataFrame:
    """The repaired turns of each chunk. The last row of a conversation has its whole audit, its
    figures, and the SHA-256 of all its ``role:text``, joined by line ends."""
    schema = arrow_schema(REPAIRED)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, state, digest, some, audits = None, START, hashlib.sha256(), False, []
        for batch in batches:
            ready = []
            for row in batch.to_pylist():
                if row["side"] == 0:
                    plan = row
                    continue
                rows = ((r, t) for r, t, n in zip(row["roles"], row["texts"], row["copies"], strict=True) for _ in range(n))
                roles, texts = [], []
                for letter in plan["audit"]:
                    role, text = ("", "") if letter == "I" else next(rows)
                    if letter == "D":
                        continue
                    if letter == "K":
                        state = after(state, role[:1])
                    else:
                        state = NEXT[state]
                        role = ROLES[state]
                    digest.update(f"{chr(10) if some else ''}{role}:{text}".encode())
                    some = True
                    roles.append(role)
                    texts.append(text)
                audits.append(plan["audit"])
                done = {k: plan[k] for k in schema.names if k in plan} | {"roles": roles, "texts": texts, "sha256": None}
                if plan["last"]:
                    done |= {"audit": "".join(audits), "sha256": digest.hexdigest()}
                    state, digest, some, audits = START, hashlib.sha256(), False, []
                ready.append(done)
            if ready:
                yield pa.RecordBatch.from_pylist(ready, schema)

    both = plans.withColumn("side", F.lit(0)).unionByName(
        chunks.select("conv", "segment", "chunk", "roles", "texts", "copies").withColumn("side", F.lit(1)),
        allowMissingColumns=True,
    )
    return in_order(both, "side").mapInArrow(work, REPAIRED)


def repair(rows: DataFrame) -> DataFrame:
    """(conv, segment, chunk, audit, last, figures, roles, texts, sha256): the repaired turns of every
    conversation in ``rows`` (conv_id, turn, role, text), chunk by chunk; see ``applied``."""
    chunks = write_and_read(packed(with_faults(rows)), "chunks")
    return applied(chunks, planned(chunks))


def figures(repaired: DataFrame, originals: DataFrame) -> DataFrame:
    """One row for every conv_id of ``originals``; zeros, no edits and the digest of nothing where no
    row was left."""
    last = repaired.where("last").drop("segment", "chunk", "last", "roles", "texts")
    ids = originals.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = ids.join(last, ids["conv_id"].eqNullSafe(last["conv"]), "left")
    zero = [F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.sha2(F.lit(b""), 256)
    return found.select(
        "conv_id", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", nothing).alias("repaired_sha256")
    )
