"""Exact top-k by inner product with a KD-tree per shard.

A bounded sample (``SAMPLE_PER_CELL`` vectors for each of at most ``MOST_CELLS`` cells) gives median
splits that cut the space into cells; every row is placed in a cell, and a cell's rows are dealt by hash
into parts of about ``SHARD_ROWS``: a part is a shard, whatever share of all rows a cell holds. Within
its shard each row stands in a KD-tree: median splits on the widest dimension, tight bounding boxes.

The bound of a box for a query is the largest inner product that any point of the box could have. A
query first searches one shard of the cell with the largest bound; the k-th score found there is
propagated, and only cells whose bound reaches it are asked after. A tree is walked best-first by the
bounds, until no open box can hold a better row.

Components become ``floor(scale * x)`` of the double x, scores are exact integers (a score that a long
can't hold counts as the nearest long). Higher scores come first, then smaller ids. A query's own row is
no candidate, other rows with its id or vector are. Rows whose vector is null or holds null or non-finite
components, and rows without an id, take no part; vectors of different lengths don't meet; empty vectors
score 0 with each other. Repeated rows are candidates, and queries, as often as they occur. An empty
table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import tiles
from tidemark.shared import write_and_read

SHARD_ROWS, MOST_CELLS, SAMPLE_PER_CELL = 8192, 256, 16
LEAF = 128
#: Queries of one shard that one task answers.
ASKS = 4096

ROW = "id long, mark long, copies long, vector array<double>"
FOUND = "query_id long, mark long, copies long, vec_id long, score long"


@dataclass
class Cells:
    """A complete tree of median splits over vectors of one length; other lengths have own cells."""

    length: int
    dims: np.ndarray
    values: np.ndarray

    def of(self, vectors: np.ndarray) -> np.ndarray:
        place = np.zeros(len(vectors), np.int64)
        if vectors.shape[1] != self.length:
            return place - vectors.shape[1] - 1
        rows = np.arange(len(vectors))
        for _ in range(len(self.dims).bit_length()):
            right = vectors[rows, self.dims[place]] >= self.values[place]
            place = 2 * place + 1 + right
        return place - len(self.dims)


def fit_cells(sample: np.ndarray, levels: int) -> Cells:
    """Split at the median of the widest dimension, ``levels`` times."""
    count = 2**levels - 1
    dims, values = np.zeros(count, np.int64), np.zeros(count)
    groups = {0: sample}
    for node in range(count):
        points = groups.pop(node)
        if len(points) and points.shape[1]:
            dims[node] = np.argmax(np.ptp(points, axis=0))
            values[node] = np.median(points[:, dims[node]])
            right = points[:, dims[node]] >= values[node]
        else:
            right = np.zeros(len(points), bool)
        groups[2 * node + 1], groups[2 * node + 2] = points[~right], points[right]
    return Cells(sample.shape[1], dims, values)


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The largest inner product of each query with any point of each box."""
    return np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T


class Tree:
    """KD-tree over whole-number vectors; nodes are numbered in the order they are made."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, marks: np.ndarray, keep: int) -> None:
        order = np.arange(len(points))
        low, high, children, ranges, least = [], [], [], [], []
        open_ranges = [(0, len(points), -1)]
        kept: list[np.ndarray] = []
        n_kept = 0
        while open_ranges:
            first, last, parent = open_ranges.pop()
            node = len(low)
            if parent >= 0:
                children[parent].append(node)
            own = order[first:last]
            box = points[own]
            low.append(box.min(axis=0))
            high.append(box.max(axis=0))
            least.append(int(ids[own].min()))
            children.append([])
            width = high[-1] - low[-1]
            flat = not width.size or not width.any()
            if flat or last - first <= LEAF:
                own = own[np.argsort(ids[own], kind="stable")]
                if flat:  # equal points: only the first by id can be among the best
                    own = own[:keep]
                ranges.append((n_kept, n_kept + len(own)))
                kept.append(own)
                n_kept += len(own)
                continue
            ranges.append((0, 0))
            middle = (last - first) // 2
            axis = int(np.argmax(width))
            order[first:last] = own[np.argsort(box[:, axis], kind="stable")]
            open_ranges += [(first, first + middle, node), (first + middle, last, node)]
        held = np.concatenate(kept)
        self.points, self.ids, self.marks = points[held], ids[held], marks[held]
        self.low, self.high = np.stack(low), np.stack(high)
        self.children, self.ranges, self.least = children, ranges, least

    def search(
        self, query: np.ndarray, limit: np.ndarray, own: tuple[int, int], k: int, floor: tuple[int, int] | None
    ) -> list[tuple[int, int]]:
        """The best (score, id) that come before ``floor``, by the boxes' bounds ``limit``."""
        found: list[tuple[int, int]] = []
        worst = (floor[0], -floor[1]) if floor else None
        skip = 1
        heap = [(-int(limit[0]), self.least[0], 0)]
        while heap:
            bound, least, node = heapq.heappop(heap)
            if worst is not None and -bound < worst[0]:
                break
            if worst is not None and (-bound, -least) <= worst:
                continue
            if self.children[node]:
                for child in self.children[node]:
                    reach = int(limit[child])
                    if worst is None or (reach, -self.least[child]) > worst:
                        heapq.heappush(heap, (-reach, self.least[child], child))
                continue
            first, last = self.ranges[node]
            scores = tiles.clipped(self.points[first:last] @ query)
            near = range(len(scores)) if worst is None else np.flatnonzero(scores >= worst[0])
            for place in near:
                at = first + int(place)
                item = (int(scores[place]), -int(self.ids[at]))
                if skip and -item[1] == own[0] and int(self.marks[at]) == own[1]:
                    skip = 0
                elif len(found) < k:
                    heapq.heappush(found, item)
                elif item > found[0]:
                    heapq.heapreplace(found, item)
            if len(found) == k and (worst is None or found[0] > worst):
                worst = found[0]
        return [(s, -i) for s, i in found]


@dataclass
class Shard:
    points: np.ndarray
    ids: np.ndarray
    marks: np.ndarray
    trees: dict


def rows_of(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """Distinct (id, vector) that take part, with how often they occur."""
    chosen = rows.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    chosen = chosen.where(F.col("id").isNotNull() & tiles.whole_vector(F.col("vector")))
    counted = chosen.groupBy("id", "vector").agg(F.count("*").alias("copies"))
    return counted.select("id", F.xxhash64("id", "vector").alias("mark"), "copies", "vector")


def learn_cells(rows: DataFrame) -> Cells:
    """Median splits of a sample: the vectors with the smallest hashes, of their commonest length."""
    levels = 0
    n = rows.count()
    while 2**levels < MOST_CELLS and 2**levels * SHARD_ROWS < n:
        levels += 1
    sample = rows.orderBy(F.xxhash64("mark", F.lit(11)), "id").select("vector")
    drawn = [r["vector"] for r in sample.limit(SAMPLE_PER_CELL * 2**levels).collect()]
    lengths = [len(v) for v in drawn]
    length = max(sorted(set(lengths)), key=lengths.count, default=0)
    fitting = [v for v in drawn if len(v) == length]
    points = np.array(fitting, np.float64).reshape(len(fitting), length)
    return fit_cells(points, levels if length else 0)


def place(rows: DataFrame, cells: Cells) -> DataFrame:
    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = batch.column("vector")
            sizes = tiles.integers(vectors.value_lengths())
            cell = np.zeros(batch.num_rows, np.int64)
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                flat = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                cell[at] = cells.of(flat.astype(np.float64).reshape(len(at), int(size)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("id", "mark", "copies", "vector")), pa.array(cell)],
                ["id", "mark", "copies", "vector", "cell"],
            )

    return rows.mapInArrow(work, f"{ROW}, cell long")


def boxes_of(placed: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """For each cell the number of its parts and its bounding box: at most MOST_CELLS, and one for
    each other length of a vector."""

    def work(batches):
        seen: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            cell = tiles.integers(batch.column("cell"))
            for name in np.unique(cell):
                at = np.flatnonzero(cell == name)
                own = batch.column("vector").take(pa.array(at)).flatten()
                box = own.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(at), -1)
                n, low, high = len(at), box.min(axis=0), box.max(axis=0)
                if int(name) in seen:
                    m, a, b = seen[int(name)]
                    n, low, high = n + m, np.minimum(low, a), np.maximum(high, b)
                seen[int(name)] = (n, low, high)
        for name, (n, low, high) in seen.items():
            yield pa.RecordBatch.from_pylist(
                [{"cell": name, "n": n, "low": low.tolist(), "high": high.tolist()}],
                pa.schema([("cell", pa.int64()), ("n", pa.int64()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))]),
            )

    partial = placed.select("cell", "vector").mapInArrow(
        work, "cell long, n long, low array<double>, high array<double>"
    )
    sizes = partial.groupBy("cell").agg(F.sum("n").alias("n"))
    sides = partial.select("cell", F.posexplode(F.arrays_zip("low", "high")).alias("at", "side"))
    sides = sides.groupBy("cell", "at").agg(F.min("side.low").alias("low"), F.max("side.high").alias("high"))
    sides = sides.groupBy("cell").agg(F.array_sort(F.collect_list(F.struct("at", "low", "high"))).alias("box"))
    out = {}
    for row in sizes.join(sides, "cell", "left").collect():
        box = row["box"] or []
        low = np.array([b["low"] for b in box], np.float64)
        high = np.array([b["high"] for b in box], np.float64)
        out[row["cell"]] = (-(-row["n"] // SHARD_ROWS), low, high)
    return out


def route(queries: DataFrame, boxes: dict, scale: int, first: bool) -> DataFrame:
    """Queries with the shards they ask: one of the best cell first, then all others in reach."""
    names = sorted(boxes)

    def work(batches):
        for batch in batches:
            rows, cell, part = [], [], []
            marks = tiles.integers(batch.column("mark"))
            vectors = batch.column("vector")
            sizes = tiles.integers(vectors.value_lengths()) if batch.num_rows else np.zeros(0, int)
            limits = batch.column("limit_score").to_pylist()
            for size in np.unique(sizes):
                near = [n for n in names if len(boxes[n][1]) == size]
                low = tiles.scaled(np.stack([boxes[n][1] for n in near]), scale)
                high = tiles.scaled(np.stack([boxes[n][2] for n in near]), scale)
                at = np.flatnonzero(sizes == size)
                points = tiles.matrix(vectors.take(pa.array(at)), scale)
                points, low, high = exact(points, low, high)
                reach = tiles.clipped(bounds(points, low, high))
                home = reach.argmax(axis=1)
                for k, row in enumerate(at.tolist()):
                    own = near[home[k]]
                    own_part = int(marks[row]) % boxes[own][0]
                    if first:
                        pairs = [(own, own_part)]
                    else:
                        limit = tiles.LOWEST if limits[row] is None else limits[row]
                        asked = [near[j] for j in np.flatnonzero(reach[k] >= limit)]
                        pairs = [(c, p) for c in asked for p in range(boxes[c][0]) if (c, p) != (own, own_part)]
                    rows += [row] * len(pairs)
                    cell += [c for c, _ in pairs]
                    part += [p for _, p in pairs]
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*taken.columns, pa.array(cell, pa.int64()), pa.array(part, pa.int64())],
                [*taken.schema.names, "cell", "part"],
            )

    return queries.select("id", "mark", "copies", "vector", "limit_score", "limit_id").mapInArrow(
        work, f"{ROW}, limit_score long, limit_id long, cell long, part long"
    )


def exact(points: np.ndarray, *others: np.ndarray) -> tuple[np.ndarray, ...]:
    """As doubles where every sum of products stays a whole number below 2**53, else as integers."""
    most = max(tiles.magnitude(o) for o in others)
    fits = tiles.magnitude(points) * most * max(points.shape[1], 1) < 2**52
    return tuple(a.astype(np.float64 if fits else object) for a in (points, *others))


def ask(placed: DataFrame, asked: DataFrame, boxes: dict, k: int, scale: int) -> DataFrame:
    """The best rows of each asked shard, at most k for a query and shard."""
    asked = write_and_read(asked, "asks")
    keys = ["cell", "part"]
    salts = asked.groupBy(*keys).agg(F.ceil(F.count("*") / ASKS).cast("int").alias("salts"))
    parts = F.create_map(*(F.lit(x) for c, b in sorted(boxes.items()) for x in (c, b[0])))
    rows = placed.withColumn("part", F.pmod("mark", F.element_at(parts, F.col("cell"))))
    rows = rows.join(salts, keys).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    asks = asked.join(salts, keys).withColumn("salt", F.pmod(F.xxhash64("id", "mark"), "salts"))
    fields = [*keys, "salt", "id", "mark", "copies", "vector"]

    def prepare(held: pa.Table) -> Shard:
        repeat = np.minimum(tiles.integers(held["copies"].combine_chunks()), k + 1)
        points = np.repeat(tiles.matrix(held["vector"].combine_chunks(), scale), repeat, axis=0)
        ids = np.repeat(tiles.integers(held["id"].combine_chunks()), repeat)
        marks = np.repeat(tiles.integers(held["mark"].combine_chunks()), repeat)
        return Shard(points, ids, marks, {})

    def answer(shard: Shard, piece: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        ids, marks = tiles.integers(piece.column("id")), tiles.integers(piece.column("mark"))
        copies = tiles.integers(piece.column("copies"))
        limits = list(zip(piece.column("limit_score").to_pylist(), piece.column("limit_id").to_pylist(), strict=True))
        queries, points = exact(tiles.matrix(piece.column("vector"), scale), shard.points)
        if points.dtype not in shard.trees:
            shard.trees[points.dtype] = Tree(points, shard.ids, shard.marks, k + 1)
        tree = shard.trees[points.dtype]
        for start in range(0, len(queries), 256):
            block = queries[start : start + 256]
            limit = tiles.clipped(bounds(block, tree.low, tree.high))
            for row, query in enumerate(block, start):
                own = (int(ids[row]), int(marks[row]))
                floor = limits[row] if limits[row][0] is not None else None
                for score, near in tree.search(query, limit[row - start], own, k, floor):
                    out.append((own[0], own[1], int(copies[row]), near, score))
        columns = list(zip(*out, strict=True)) if out else [[]] * 5
        names = ["query_id", "mark", "copies", "vec_id", "score"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return tiles.meet(
        rows.select(*fields), asks.select(*fields, "limit_score", "limit_id"), [*keys, "salt"], prepare, answer, FOUND
    )


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 10,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best other rows of every row for which ``is_query``
    (a condition on column ``id``) holds."""
    counted = write_and_read(rows_of(rows, id_col, vector_col), "vectors")
    cells = learn_cells(counted)
    placed = write_and_read(place(counted, cells), "placed")
    boxes = boxes_of(placed)
    if not boxes:
        return counted.select(
            F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("mark").alias("score")
        )
    queries = counted.where(is_query)
    none = F.lit(None).cast("long")
    start = queries.withColumns({"limit_score": none, "limit_id": none})
    near = write_and_read(ask(placed, route(start, boxes, scale, True), boxes, k, scale), "near")
    full = near.groupBy(F.col("query_id").alias("id"), "mark").agg(
        F.count("*").alias("n"), F.min(F.struct("score", -F.col("vec_id"))).alias("last")
    )
    full = full.where(F.col("n") == k).select(
        "id", "mark", F.col("last.score").alias("limit_score"), (-F.col("last.col2")).alias("limit_id")
    )
    reached = queries.join(full, ["id", "mark"], "left")
    far = ask(placed, route(reached, boxes, scale, False), boxes, k, scale)
    by_query = Window.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), "vec_id")
    best = near.unionByName(far).withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
    each = best.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return each.select("query_id", "rank", "vec_id", "score")
