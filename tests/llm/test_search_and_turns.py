"""Top-k search, hard negatives and conversation repair against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hardneg, kdtree, tiles, turns
from tidemark.llm.op13_query import op13_conversation_repair

VECTORS = "vec_id long, embedding array<double>, label int, mark string, part int, copies string"


def table(spark, rows):
    """Rows (vec_id, embedding, label) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], VECTORS)


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def whole(vector, scale):
    return [math.floor(scale * x) if abs(x) < 2**52 else int(x) * scale for x in vector]


def clip(score):
    return min(max(score, tiles.LOWEST), tiles.HIGHEST)


def odd_rows(first, wide):
    """Vectors that take no part, or only with each other."""
    odd = [None, [None] + [1.0] * (wide - 1), [float("nan")] * wide, [float("inf")] * wide]
    odd += [[], [], [1.0, 2.0], [1.0, -2.0], [0.0] * wide, [1e300] * wide, [-1e300] + [0.0] * (wide - 1)]
    return [(first + 50 * k, v, 3) for k, v in enumerate(odd)]


def vectors(seed, n, wide, ids=None):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, wide))
    rows = [(k, (centres[k % 6] + 0.4 * rng.normal(size=wide)).tolist(), k % 4) for k in range(n)]
    same = rows[7][1]
    rows += [(n + k, same, k % 4) for k in range(n // 2)]  # a third of all rows
    rows += [rows[100], rows[100], rows[100], (100, same, 1), (None, same, 1), (n * 2, same, None)]
    return rows + odd_rows(10 * n, wide)


def brute_top(rows, every, k, scale):
    out = []
    kept = [(i, v, whole(v, scale)) for i, v, _ in rows if i is not None and usable(v)]
    for at, (i, _, q) in enumerate(kept):
        if i % every:
            continue
        scores = [
            (-clip(sum(a * b for a, b in zip(q, c, strict=True))), j)
            for other, (j, _, c) in enumerate(kept)
            if other != at and len(c) == len(q)
        ]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard", [8192, 64])
def test_top_k(spark, monkeypatch, shard):
    monkeypatch.setattr(kdtree, "SHARD_ROWS", shard)
    monkeypatch.setattr(kdtree, "LEAF", 16)
    rows = vectors(3, 400, 6)
    got = kdtree.top_k(table(spark, rows), F.col("id") % 50 == 0)
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 50, 10, 1024)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]


def test_top_k_of_few_and_none(spark):
    rows = [(0, [1.0, 2.0], None), (1, [0.5, -1.0], 0)]
    assert sorted(map(tuple, kdtree.top_k(table(spark, rows), F.col("id") % 100 == 0).collect())) == brute_top(rows, 100, 10, 1024)
    assert kdtree.top_k(table(spark, []), F.col("id") % 100 == 0).collect() == []
    alone = table(spark, rows[:1])
    assert kdtree.top_k(alone, F.col("id") % 100 == 0).collect() == []


def test_tree_visits_less_than_all():
    """The bounds leave most leaves of clustered vectors unread."""
    rng = np.random.default_rng(5)
    points = np.floor(1024 * (rng.normal(size=(40, 3))[rng.integers(0, 40, 20000)] + 0.05 * rng.normal(size=(20000, 3))))
    tree = kdtree.Tree(points, np.arange(20000), np.arange(20000), 11)
    read = 0

    class Counting(np.ndarray):
        def __getitem__(self, at):
            nonlocal read
            if isinstance(at, slice):
                read += at.stop - at.start
            return np.asarray(self).__getitem__(at)

    plain = tree.points
    tree.points = plain.view(Counting)
    for row in range(0, 20000, 400):
        limit = kdtree.bounds(points[row : row + 1], tree.low, tree.high)[0]
        best = tree.search(points[row], limit, (row, row), 10, None)
        scores = plain @ points[row]
        order = np.lexsort((tree.ids, -scores))
        want = [(int(scores[j]), int(tree.ids[j])) for j in order if tree.ids[j] != row][:10]
        assert sorted(best, key=lambda x: (-x[0], x[1])) == want
    assert read < 0.1 * 20000 * 50


def test_strassen():
    rng = np.random.default_rng(1)
    for m, k, n in ((1, 1, 1), (33, 65, 129), (64, 64, 64), (100, 0, 70), (130, 97, 35), (200, 40, 257)):
        a, b = rng.integers(-(2**20), 2**20, (m, k)), rng.integers(-(2**20), 2**20, (k, n))
        assert (hardneg.strassen(a, b) == a @ b).all()
    big = np.array([[2**61, -(2**61)]] * 40, dtype=object)
    assert hardneg.products(big, big)[0, 0] == tiles.HIGHEST
    assert hardneg.products(big, -big)[0, 0] == tiles.LOWEST


def brute_negatives(rows, every, scale):
    kept = [(i, l, whole(v, scale)) for i, v, l in rows if i is not None and l is not None and usable(v)]  # noqa: E741
    out = []
    for at, (i, label, q) in enumerate(kept):
        if i % every:
            continue
        scores = sorted(
            (-clip(sum(a * b for a, b in zip(q, c, strict=True))), j, other)
            for n, (j, other, c) in enumerate(kept)
            if n != at and len(c) == len(q)
        )
        for p, pos, _ in [s for s in scores if s[2] == label][:5]:
            inside = [(j, -s) for s, j, other in scores if other != label and -50 * p <= -100 * s <= -95 * p]
            out += [(i, pos, r, j, -p, s) for r, (j, s) in enumerate(inside[:3], 1)]
    return sorted(out)


@pytest.mark.parametrize("tile", [2048, 32])
def test_hard_negatives(spark, monkeypatch, tile):
    monkeypatch.setattr(hardneg, "TILE", tile)
    rows = vectors(4, 300, 40)
    got = hardneg.mine(table(spark, rows), F.col("id") % 25 == 0, F.col("label"))
    want = brute_negatives(rows, 25, 256)
    assert len(want) > 100
    assert sorted(map(tuple, got.collect())) == want
    assert hardneg.mine(table(spark, []), F.col("id") % 25 == 0, F.col("label")).collect() == []


# Conversations -------------------------------------------------------------------------------------

TURNS = "conv_id long, turn long, role string, text string, segment int, name string, side int"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (kind > 0) + [(conv, turn, role, text)] * (kind == 3)
    return out


def fault_of(row, seen):
    body = row[3].rstrip(turns.SPACES)
    if not body:
        return "b"
    if row[2:] in seen:
        return "d"
    return "-" if body[-1] in ".!?" else "t"


def brute_edits(rows, faults):
    """The cheapest (cost, audit, turns) by a search over all edits, place by place."""
    def insert(best):
        for _ in range(3):
            for state, (cost, audit, out) in list(best.items()):
                need = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                way = (cost + 3, audit + "I", [*out, ({"u": "user", "a": "assistant"}[need], "")])
                if need not in best or way[:2] < best[need][:2]:
                    best[need] = way
        return best

    best = insert({"": (0, "", [])})
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        new = {}

        def offer(state, way):
            if state not in new or way[:2] < new[state][:2]:
                new[state] = way

        for state, (cost, audit, out) in best.items():
            offer(state, (cost + 4, audit + "D", out))
            if fault in "bd":
                continue
            more = 3 * (fault == "t")
            if role and state + role[:1] in ("s", "u", "su", "ua", "au"):
                offer(role[:1], (cost + more, audit + "K", [*out, (role, text)]))
            for full in ("user", "assistant"):
                if state + full[0] in ("u", "su", "ua", "au"):
                    offer(full[0], (cost + 3 + more, audit + "R", [*out, (full, text)]))
        best = insert(new)
    return min((w for s, w in best.items() if s in ("", "a")), key=lambda w: w[:2])


def brute_repair(rows, damaged):
    key = lambda r: (r[0] is not None, r[0] or 0)
    out = {r[0]: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for r in rows}
    order = lambda r: (*key(r), r[1] is not None, r[1] or 0, r[2], r[3])
    for _, group in groupby(sorted(damaged, key=order), key):
        own = list(group)
        faults = [fault_of(r, {s[2:] for s in own[:k]}) for k, r in enumerate(own)]
        named = [r[1] for r in own if r[1] is not None]
        gaps = max(named) - min(named) + 1 - len(set(named)) if named else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, kept = brute_edits(own, faults)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()
        counts = tuple(faults.count(f) for f in "bdt")
        out[own[0][0]] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def conversations_of(seed, n):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "What?", "", " \n", "a. ", "Go on!", None, "Zed.\x0b", "ü", "x" * 5000 + "."]
    roles = ["user", "assistant"] * 4 + ["system", "tool", None, "", "User"]
    rows = []
    for conv in [*range(n), None]:
        for turn in range(rng.randint(0, 12)):
            rows += [(conv, rng.choice([turn, turn, turn, turn, 2 * turn, None]), rng.choice(roles), rng.choice(texts))]
    rows += rng.sample(rows, 20)
    return rows


@pytest.mark.parametrize("chunk", [4096, 3])
def test_conversation_repair(spark, monkeypatch, chunk):
    monkeypatch.setattr(turns, "CHUNK_ROWS", chunk)
    rows = conversations_of(6, 120)
    # One conversation has a third of all rows and spreads over the sorted ranges.
    rng = random.Random(1)
    rows += [(7, k, rng.choice(["user", "assistant"]), f"Line {k % 200}.") for k in range(400)]
    rows += [(8, k, "user", "Again.") for k in range(300)]
    frame = spark.createDataFrame([(*r, 1, "n", 5) for r in rows], TURNS)
    got = turns.figures(turns.repair(turns.damage(frame)), frame).collect()
    found = {r["conv_id"]: tuple(r)[1:] for r in got}
    assert len(got) == len(found)
    want = brute_repair(rows, brute_damage(rows))
    assert found == want


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be brief."), (1, 1, "assistant", "Hello."), (1, 2, "user", "Why?"), (1, 2, "user", "Why?")]
    frame = spark.createDataFrame([(*r, 1, "n", 5) for r in rows], TURNS)
    pieces = sorted(turns.repair(frame).collect(), key=lambda r: (r["segment"], r["chunk"]))
    row = pieces[-1]
    assert [r["last"] for r in pieces] == [False] * (len(pieces) - 1) + [True]
    assert row["audit"] == "KIKKDI" and row["cost"] == 10 and row["duplicate"] == 1
    assert sum((r["roles"] for r in pieces), []) == ["system", "user", "assistant", "user", "assistant"]
    assert sum((r["texts"] for r in pieces), []) == ["Be brief.", "", "Hello.", "Why?", ""]


def test_no_conversations(spark):
    frame = spark.createDataFrame([], TURNS)
    assert turns.figures(turns.repair(turns.damage(frame)), frame).collect() == []
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(dropped, 0, "user", "Hi.", 1, "n", 5)], TURNS)
    row = turns.figures(turns.repair(turns.damage(frame)), frame).first()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_runs_by_powers():
    """A run of any length costs as many steps as its length has binary digits."""
    for symbol in ("u-", "at", "-b", "sd", "s-"):
        slow = turns.END
        for length in range(1, 70):
            slow = turns.step(turns.power(symbol, 0), slow)
            assert turns.over_run(symbol, length, turns.END) == slow
    assert turns.over_run("-b", 10**15, turns.END)[0] == 4 * 10**15


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = {r["conv_id"]: tuple(r)[1:] for r in op13_conversation_repair(spark, sf).collect()}
    assert found == brute_repair(rows, brute_damage(rows))
