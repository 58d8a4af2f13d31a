"""Removal of repeated byte strings with suffix arrays.

Every byte that lies in a string of ``LENGTH`` bytes which also starts earlier goes: earlier is in a
document with a smaller id, or before in the same one. Strings never cross documents.

1. Documents are dealt into shards as they are read. A shard's suffix array is refined as Larsson
   and Sadakane do, doubling the sorted prefix and sorting only groups that are not settled, until
   it exceeds ``LENGTH``; the common prefixes of neighbours give its repeated strings. All but the
   first of each are repeats.
2. Between shards, suffixes are compared at places chosen by their content: in every string of
   ``LENGTH`` bytes the ``GRAM`` bytes with the smallest hash. Such an anchor goes to the fragment of
   its hash with a hash of all bytes that a string around it can reach. Anchors with an equal
   surrounding that is earlier are repeats, with all strings around them. A string has at least half
   of its other bytes on one side of its anchor: the first of a surrounding goes on to step 3 where
   another surrounding has the same bytes so far to the left, or to the right.
3. The strings around those anchors are merged one by one: each sorted fragment is searched for the
   first place of every string.

Hashes have 64 bits. Step 1 sees the bytes themselves. Null text is empty; texts of fewer than
``LENGTH`` bytes lose nothing, nor do those without repeats. Rows with the same id and text are the
same document and get the same answer; with the same id and other text, their order is that of a
hash. A null id comes first. An empty table gives an empty one; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, keyed_text, mix, partitions, text_bytes
from tidemark.llm.words import powers
from tidemark.shared import shuffles_removed, write_and_read

LENGTH = 100
GRAM = 32
#: Bytes of a shard, where a document doesn't make it longer.
SHARD = 1 << 20
#: Kinds of places that the steps find: a repeated string begins there, a repeated surrounding has
#: its anchor there, an anchor there has to be looked at closer, repeated strings begin from there to
#: before the place that follows.
STRING, AROUND, OPEN, RUN = 0, 1, 2, 3

PACK = (
    "fragment int, code binary, detail binary, sides binary, owner binary, place binary, "
    "ids binary, keys binary"
)
FLAG = "bucket int, kind int, keys binary, counts binary, places binary"
PLACES = "key long, strings binary, arounds binary, nearer binary"
#: Anchors and strings are dealt to so many fragments at least, documents to so many buckets, by key: a
#: fragment hands on a row for each bucket and kind, not for each document that it meets.
FRAGMENTS = BUCKETS = 256


def packed_words(flat: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on, as a number that sorts like them. Zeros follow the end."""
    padded = np.append(flat, np.zeros(8, np.uint8))
    words = np.zeros(len(flat), np.uint64)
    for k in range(8):
        words = words << np.uint64(8) | padded[k : k + len(flat)]
    return words


def suffix_array(flat: np.ndarray, depth: int) -> np.ndarray:
    """The places of all suffixes in the order of at least their first ``depth`` bytes.

    A suffix's rank is where its group begins in the array. Each round sorts only groups with several
    suffixes, by the ranks of what follows the part already sorted, which doubles that part.
    """
    return sorted_suffixes(flat, depth)[0]


def sorted_suffixes(flat: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and how many bytes each suffix is known to share with the one before it: what was
    sorted before the round that parted them. They share less than twice as many, or 8."""
    size = len(flat)
    words = packed_words(flat)
    order = np.argsort(words)
    new = np.ones(size, bool)
    new[1:] = words[order[1:]] != words[order[:-1]]
    rank = np.empty(size, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(size), 0))
    known = np.zeros(size, np.int64)
    sorted_upto = 8
    while sorted_upto < depth:
        begin = np.flatnonzero(new)
        length = np.diff(np.append(begin, size))
        open_ = np.repeat(length > 1, length)
        at = np.flatnonzero(open_)
        if not len(at):
            break
        suffix = order[at]
        follow = suffix + sorted_upto
        then = np.where(follow < size, rank[np.minimum(follow, size - 1)] + 1, 0)
        own = rank[suffix]
        codes = own << 32 | then
        by = np.argsort(codes)
        order[at] = suffix[by]
        codes = codes[by]
        fresh = np.ones(len(at), bool)
        fresh[1:] = codes[1:] != codes[:-1]
        known[at[fresh & ~new[at]]] = sorted_upto
        new[at] = fresh
        rank[order[at]] = np.maximum.accumulate(np.where(fresh, at, 0))
        sorted_upto *= 2
    known[~new] = sorted_upto
    return order, known


def common_prefixes(flat: np.ndarray, order: np.ndarray, most: int, known: np.ndarray | None = None) -> np.ndarray:
    """How many bytes each suffix shares with the one before it in the array, up to ``most``.

    As Kasai does, nothing is compared again that is known to be equal: pairs of neighbours are
    extended together, eight bytes at a time, and those that differ leave. With what the sorting already
    knows, pairs that it shows to share ``most``, or less, aren't compared; the latter keep what is known.
    """
    size = len(flat)
    words = packed_words(flat)
    shared = np.zeros(size, np.int64) if known is None else known.copy()
    at = np.arange(1, size)
    if known is not None:
        at = at[(known[1:] * 2 > most) & (known[1:] < most)]
    done = shared[at]
    while len(at):
        a, b = order[at - 1] + done, order[at] + done
        inside = (a < size) & (b < size) & (done < most)
        at, a, b, done = at[inside], a[inside], b[inside], done[inside]
        apart = words[a] ^ words[b]
        equal = apart == 0
        differ = apart[~equal]
        if len(differ):
            lead = np.zeros(len(differ), np.int64)
            for k in range(1, 8):
                lead += differ >> np.uint64(64 - 8 * k) == 0
            shared[at[~equal]] = done[~equal] + lead
        at, done = at[equal], done[equal] + 8
        shared[at] = done
    ends = size - np.maximum(order, np.append(0, order[:-1]))
    return np.minimum(np.minimum(shared, ends), most)


def repeats(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For every place: whether a string of ``LENGTH`` bytes of one row begins there that begins
    earlier as well."""
    size = len(flat)
    made = np.zeros(size, bool)
    if size <= LENGTH:
        return made
    order, known = sorted_suffixes(flat, LENGTH)
    joined = common_prefixes(flat, order, LENGTH, known) >= LENGTH
    near = np.flatnonzero(joined)
    if not len(near):
        return made
    group = np.cumsum(~joined)
    members = np.unique(np.concatenate([near - 1, near]))
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(size)
    members = members[room[order[members]] >= LENGTH]
    places, groups = order[members], group[members]
    by = np.lexsort((places, groups))
    places, groups = places[by], groups[by]
    made[places[1:][groups[1:] == groups[:-1]]] = True
    return made


class Hashes:
    """Hashes of any ranges of bytes."""

    def __init__(self, flat: np.ndarray) -> None:
        power, self.inverse = powers(len(flat) + 1)
        self.sums = np.zeros(len(flat) + 1, np.uint64)
        np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * power[: len(flat)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[begin]) * self.inverse[begin]
        return mix(raw + (end - begin).astype(np.uint64))


def slide(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """The least or greatest of every ``width`` neighbours: ``len(values) - width + 1`` of them."""
    made, have = values, 1
    while have * 2 <= width:
        made = pick(made[:-have], made[have:])
        have *= 2
    rest = width - have
    return pick(made[: len(made) - rest], made[rest:]) if rest else made


def anchors(flat: np.ndarray, offsets: np.ndarray, hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes) of the grams that have the smallest hash of some string of ``LENGTH`` bytes.
    Equal strings have equal anchors."""
    size = len(flat)
    if size < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    begin = np.arange(size - GRAM + 1)
    own = hashes.of(begin, begin + GRAM)
    grams = LENGTH - GRAM + 1
    least = slide(own, grams, np.minimum)
    room = np.repeat(offsets[1:], np.diff(offsets))[: len(least)] - np.arange(len(least))
    least[room < LENGTH] = 0
    padded = np.concatenate([np.zeros(grams - 1, np.uint64), least, np.zeros(grams - 1, np.uint64)])
    chosen = np.flatnonzero((slide(padded, grams, np.maximum) == own) & (own > 0))
    return chosen, own[chosen]


def around(
    places: np.ndarray, offsets: np.ndarray, hashes: Hashes
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, begin, end) of all that strings around these anchors reach in their rows."""
    row = np.searchsorted(offsets, places, side="right") - 1
    begin = np.maximum(places - (LENGTH - GRAM), offsets[row])
    end = np.minimum(places + LENGTH, offsets[row + 1])
    return mix(hashes.of(begin, end) + (places - begin).astype(np.uint64)), begin, end


def sides_of(places: np.ndarray, offsets: np.ndarray, hashes: Hashes) -> np.ndarray:
    """(n, 2) short hashes of half the bytes that a string has beside its anchor, to the left and to
    the right of it; 0 where the row has fewer."""
    half = (LENGTH - GRAM + 1) // 2
    row = np.searchsorted(offsets, places, side="right") - 1
    left = np.where(places - half >= offsets[row], places - half, places)
    end = places + GRAM
    right = np.where(end + half <= offsets[row + 1], end + half, end)
    made = np.stack([hashes.of(left, places), hashes.of(end, right)], axis=1) >> np.uint64(48)
    made = np.maximum(made, np.uint64(1))
    made[left == places, 0] = 0
    made[right == end, 1] = 0
    return made.astype("<u2")


def in_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, offsets, ids, keys) for parts of the rows (id, key, text), ascending, without rows
    that occur twice in a part."""
    for batch in batches:
        flat, offsets = text_bytes(batch.column("text"))
        ids = batch.column("id").fill_null(-(2**63)).to_numpy()
        keys = batch.column("key").to_numpy()
        for a, b in chunks(offsets, SHARD):
            order = a + np.lexsort((keys[a:b], ids[a:b]))
            _, first = np.unique(keys[order], return_index=True)
            order = order[np.sort(first)]
            parts = [flat[offsets[k] : offsets[k + 1]] for k in order]
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            yield np.concatenate(parts), ends, ids[order], keys[order]


def pack(
    fragments: int,
    code: np.ndarray,
    detail: np.ndarray,
    row: np.ndarray,
    place: np.ndarray,
    ids: np.ndarray,
    keys: np.ndarray,
    sides: np.ndarray | None = None,
) -> list[tuple]:
    """Rows of ``PACK``: entries dealt to the fragments of their codes."""
    fragment = (code % np.uint64(fragments)).astype(np.int64)
    order = np.argsort(fragment, kind="stable")
    edges = np.searchsorted(fragment[order], np.arange(fragments + 1))
    made = []
    for f in np.flatnonzero(np.diff(edges)).tolist():
        at = order[edges[f] : edges[f + 1]]
        used, owner = np.unique(row[at], return_inverse=True)
        short = (code[at] // np.uint64(fragments)).astype("<u4")
        made.append(
            (
                f,
                short.tobytes(),
                detail[at].astype("<u8").tobytes(),
                b"" if sides is None else sides[at].tobytes(),
                owner.astype("<u2" if len(used) < 1 << 16 else "<u4").tobytes(),
                place[at].astype("<u4").tobytes(),
                ids[used].astype("<i8").tobytes(),
                keys[used].astype("<i8").tobytes(),
            )
        )
    return made


def pack_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [c.split(" ")[0] for c in PACK.split(", ")]
    kinds = [pa.int32()] + [pa.binary()] * 7
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 8
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
    )


def binaries(flat: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary column whose values are parts of an array."""
    ends = pa.py_buffer((offsets * flat.itemsize).astype("<i4"))
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, ends, pa.py_buffer(flat)])


def changes(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the last ends."""
    if not len(values):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(values[1:] != values[:-1]) + 1, [len(values)]])


def flag_batch(key: np.ndarray, kind: int, place: np.ndarray) -> pa.RecordBatch:
    """Rows of ``FLAG``: the documents of each bucket, how many places each has, and those."""
    order = np.lexsort((place, key, key % BUCKETS))
    key, place = key[order], place[order]
    each = changes(key)
    own = key[each[:-1]]
    bucket = (own % BUCKETS).astype(np.int32)
    edges = changes(bucket)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket[edges[:-1]], pa.int32()),
            pa.array([kind] * (len(edges) - 1), pa.int32()),
            binaries(own.astype("<i8"), edges),
            binaries(np.diff(each).astype("<u4"), edges),
            binaries(place.astype("<u4"), each[edges]),
        ],
        [c.split(" ")[0] for c in FLAG.split(", ")],
    )


def runs_of(places: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places where runs begin and end in turns, rows of the runs) of ascending places in ascending rows."""
    fresh = np.append(True, (np.diff(places.astype(np.int64)) != 1) | (np.diff(rows) != 0))[: len(places)]
    begin = np.flatnonzero(fresh)
    last = np.append(begin[1:], len(places))[: len(begin)] - 1
    return np.stack([places[begin], places[last] + 1], axis=1).ravel().astype("<u4"), rows[begin]


def places_of_documents(flags: DataFrame) -> DataFrame:
    """One row of ``PLACES`` for every document of ``FLAG`` rows. Its strings are runs of places: begin
    and end in turns."""

    def joined(held: list[dict]) -> pa.RecordBatch:
        counts = [np.frombuffer(row["counts"], "<u4") for row in held]
        key = np.concatenate([np.repeat(np.frombuffer(r["keys"], "<i8"), n) for r, n in zip(held, counts, strict=True)])
        kind = np.repeat(np.array([r["kind"] for r in held], np.int8), [n.sum() for n in counts])
        place = np.concatenate([np.frombuffer(row["places"], "<u4") for row in held])
        own, row = np.unique(key, return_inverse=True)

        def column(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.Array:
            places, rows = (np.concatenate(f) for f in zip(*found, strict=True))
            by = np.argsort(rows, kind="stable")
            return binaries(places[by], np.searchsorted(rows[by], np.arange(len(own) + 1)))

        def sorted_places(k: int) -> tuple[np.ndarray, np.ndarray]:
            places, rows = place[kind == k], row[kind == k]
            by = np.lexsort((places, rows))
            return places[by], rows[by]

        runs, rows_of_runs = runs_of(*sorted_places(STRING))
        strings = column([(runs, np.repeat(rows_of_runs, 2)), (place[kind == RUN], row[kind == RUN])])
        columns = [strings, column([sorted_places(AROUND)]), column([sorted_places(OPEN)])]
        names = [c.split(" ")[0] for c in PLACES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), *columns], names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and row["bucket"] != held[0]["bucket"]:
                    yield joined(held)
                    held = []
                held.append(row)
        if held:
            yield joined(held)

    return deal(flags, "bucket").mapInArrow(work, PLACES)


def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(code, detail, id, key, place, sides) arrays of each fragment of a sorted partition."""
    held: list[list[np.ndarray]] = []
    current = None

    def joined() -> tuple:
        return tuple(np.concatenate(c) for c in zip(*held, strict=True))

    for batch in batches:
        for row in batch.to_pylist():
            if row["fragment"] != current:
                if held:
                    yield joined()
                current, held = row["fragment"], []
            place = np.frombuffer(row["place"], "<u4")
            width = len(row["owner"]) // max(len(place), 1)
            sides = np.frombuffer(row["sides"], "<u2").reshape(-1, 2)
            owner = np.frombuffer(row["owner"], f"<u{width or 2}")
            held.append(
                [
                    np.frombuffer(row["code"], "<u4"),
                    np.frombuffer(row["detail"], "<u8"),
                    np.frombuffer(row["ids"], "<i8")[owner],
                    np.frombuffer(row["keys"], "<i8")[owner],
                    place,
                    sides if len(sides) else np.zeros((len(place), 2), "<u2"),
                ]
            )
    if held:
        yield joined()


def sorted_entries(part: tuple) -> tuple:
    """Entries by code, detail and then order of documents and places, each once; with whether an
    entry is the first of its code and detail."""
    code, detail, ids, keys, place, sides = part
    order = np.lexsort((place, keys, ids, detail, code))
    code, detail, ids, keys, place = (x[order] for x in (code, detail, ids, keys, place))
    sides = sides[order]
    same = np.zeros(len(code), bool)
    same[1:] = (code[1:] == code[:-1]) & (detail[1:] == detail[:-1])
    again = same.copy()
    again[1:] &= (keys[1:] == keys[:-1]) & (place[1:] == place[:-1])
    keep = ~again
    return code[keep], detail[keep], sides[keep], keys[keep], place[keep], ~same[keep]


def shard_findings(text: DataFrame, fragments: int) -> DataFrame:
    """Rows of ``PACK`` from every shard: its anchors, and its own repeats (runs of one document in a
    row), whose fragment is -1 less the document's bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for flat, offsets, ids, keys in in_shards(batches):
            again = repeats(flat, offsets)
            found = np.flatnonzero(again)
            rows = []
            if len(found):
                owner = np.searchsorted(offsets, found, side="right") - 1
                runs, owner = runs_of(found - offsets[owner], owner)
                edges = changes(owner)
                for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    own = keys[owner[first] : owner[first] + 1]
                    places = runs[2 * first : 2 * last].tobytes()
                    rows.append((-1 - int(own[0]) % BUCKETS, b"", b"", b"", b"", places, b"", own.astype("<i8").tobytes()))
            hashes = Hashes(flat)
            places, codes = anchors(flat, offsets, hashes)
            if len(places):
                detail, begin, end = around(places, offsets, hashes)
                fresh = np.concatenate([[0], np.cumsum(~again)])
                last = np.minimum(end - LENGTH, places)
                open_ = fresh[last + 1] - fresh[begin] > 0
                places, codes, detail = places[open_], codes[open_], detail[open_]
                sides = sides_of(places, offsets, hashes)
                owner = np.searchsorted(offsets, places, side="right") - 1
                rows += pack(fragments, codes, detail, owner, places - offsets[owner], ids, keys, sides)
            if rows:
                yield pack_batch(rows)

    return text.mapInArrow(work, PACK)


def anchor_flags(packs: DataFrame) -> DataFrame:
    """Rows of ``FLAG`` after step 2."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def others() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                fragment = batch.column("fragment").to_numpy()
                own = fragment < 0
                if own.any():
                    known = batch.filter(pa.array(own))
                    sizes = np.array([len(p) // 4 for p in known.column("place").to_pylist()], "<u4")
                    passed.append(
                        pa.RecordBatch.from_arrays(
                            [
                                pa.array(-1 - fragment[own], pa.int32()),
                                pa.array([RUN] * len(sizes), pa.int32()),
                                known.column("keys"),
                                binaries(sizes, np.arange(len(sizes) + 1)),
                                known.column("place"),
                            ],
                            [c.split(" ")[0] for c in FLAG.split(", ")],
                        )
                    )
                yield batch.filter(pa.array(~own))

        passed: list[pa.RecordBatch] = []
        for part in entries(others()):
            yield from passed
            passed.clear()
            code, _, sides, keys, place, first = sorted_entries(part)
            yield flag_batch(keys[~first], AROUND, place[~first])
            code, sides, keys, place = code[first], sides[first], keys[first], place[first]
            met = np.zeros(len(code), bool)
            for side in sides.T:
                _, group, size = np.unique(
                    code.astype(np.int64) << 16 | side, return_inverse=True, return_counts=True
                )
                met |= (size[group] > 1) & (side > 0)
            yield flag_batch(keys[met], OPEN, place[met])
        yield from passed

    return packs.mapInArrow(work, FLAG)


def string_packs(rows: DataFrame, fragments: int) -> DataFrame:
    """Rows of ``PACK`` with every string around the open anchors of rows (id, key, text, nearer,
    strings): places of open anchors, and runs of strings known to be repeats."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = text_bytes(batch.column("text"))
            ids = batch.column("id").fill_null(-(2**63)).to_numpy()
            keys = batch.column("key").to_numpy()
            for a, b in chunks(offsets, SHARD):
                text, ends = flat[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                wanted = np.zeros(len(text) + 1, np.int64)
                for k in range(a, b):
                    at = np.frombuffer(batch.column("nearer")[k].as_py(), "<u4").astype(np.int64) + ends[k - a]
                    top = ends[k - a + 1] - LENGTH
                    np.add.at(wanted, np.maximum(at - (LENGTH - GRAM), ends[k - a]), 1)
                    np.add.at(wanted, np.minimum(at, top) + 1, -1)
                inside = np.cumsum(wanted)[:-1] > 0
                for k in range(a, b):
                    known = np.frombuffer(batch.column("strings")[k].as_py(), "<u4").astype(np.int64)
                    for first, last in (known + ends[k - a]).reshape(-1, 2).tolist():
                        inside[first:last] = False
                begin = np.flatnonzero(inside)
                if not len(begin):
                    continue
                codes = Hashes(text).of(begin, begin + LENGTH)
                owner = np.searchsorted(ends, begin, side="right") - 1
                fragment = codes % np.uint64(fragments)  # all that the code has to tell here
                yield pack_batch(
                    pack(fragments, fragment, codes, owner, begin - ends[owner], ids[a:b], keys[a:b])
                )

    return rows.select("id", "key", "text", "nearer", "strings").mapInArrow(work, PACK)


def string_flags(packs: DataFrame) -> DataFrame:
    """Rows of ``FLAG`` after step 3: strings whose first place, searched in the sorted fragment, is
    another."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in entries(batches):
            _, detail, _, keys, place, first = sorted_entries(part)
            by = np.argsort(detail, kind="stable")
            where = np.searchsorted(detail[by], detail[by], side="left")
            repeated = np.zeros(len(by), bool)
            repeated[by] = where != np.arange(len(by))
            assert np.array_equal(repeated, ~first)
            yield flag_batch(keys[repeated], STRING, place[repeated])

    return packs.mapInArrow(work, FLAG)


def removals(rows: DataFrame) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, spans, kept_sha256) of rows (id, text, strings, arounds, more):
    ``more`` are strings that step 3 found. Spans are the removed runs as little-endian pairs of 32-bit
    places."""
    schema = "id long, n_bytes long, n_removed long, n_spans long, spans binary, kept_sha256 string"

    def places_of(packed: bytes | None) -> np.ndarray:
        return np.frombuffer(packed or b"", "<u4").astype(np.int64)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = text_bytes(batch.column("text"))
            strings, arounds, more = (batch.column(c) for c in ("strings", "arounds", "more"))
            made: tuple[list, ...] = ([], [], [], [], [])
            for k in range(batch.num_rows):
                text = flat[offsets[k] : offsets[k + 1]]
                size = len(text)
                edge = np.zeros(size + 1, np.int64)
                runs = np.concatenate([places_of(strings[k].as_py()), places_of(more[k].as_py())])
                np.add.at(edge, runs[::2], 1)
                np.add.at(edge, runs[1::2] - 1 + LENGTH, -1)
                at = places_of(arounds[k].as_py())
                np.add.at(edge, np.maximum(at - (LENGTH - GRAM), 0), 1)
                np.add.at(edge, np.minimum(at + LENGTH, size), -1)
                gone = np.cumsum(edge)[:-1] > 0
                change = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]])))
                made[0].append(size)
                made[1].append(int(gone.sum()))
                made[2].append(len(change) // 2)
                made[3].append(change.astype("<u4").tobytes())
                made[4].append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), *(pa.array(m, t) for m, t in zip(made, kinds, strict=True))],
                [c.split(" ")[0] for c in schema.split(", ")],
            )

    return rows.select("id", "text", "strings", "arounds", "more").mapInArrow(work, schema)


def deal(packs: DataFrame, by: str = "fragment") -> DataFrame:
    count = partitions(packs.sparkSession)
    return packs.repartition(count, by).sortWithinPartitions(by)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, spans, kept_sha256) of every row."""
    text = keyed_text(docs, id_col, text_col).withColumn("key", F.xxhash64("id", "text"))
    fragments = max(FRAGMENTS, partitions(docs.sparkSession))
    found = shard_findings(text.select("id", "key", "text"), fragments)
    with shuffles_removed(docs.sparkSession):
        first = write_and_read(places_of_documents(anchor_flags(deal(found))), "repeats")
    asked = text.join(first.where(F.octet_length("nearer") > 0), "key")
    with shuffles_removed(docs.sparkSession):
        strings = string_flags(deal(string_packs(asked, fragments)))
        more = write_and_read(places_of_documents(strings), "repeats").select("key", F.col("strings").alias("more"))
    places = first.select("key", "strings", "arounds")
    return removals(text.join(places, "key", "left").join(more, "key", "left"))
