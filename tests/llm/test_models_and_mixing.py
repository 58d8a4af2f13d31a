"""Language identification, embedding links, mixing and the pipeline."""

from __future__ import annotations

import hashlib
import heapq
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import language, mixing, pivots

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(language.learning_rows(docs))
    found = language.predict(docs, model).select("row.doc_id", "row.lang", "lang_pred", "score").toPandas()
    held = found[[zlib.crc32(str(i).encode()) % 3 == 1 for i in found.doc_id]]
    assert (held.lang == held.lang_pred).mean() > 0.98
    assert found.score.between(0, 1).all()
    assert 0 < np.count_nonzero(model.weights) < model.weights.size / 2  # sparse


def test_language_of_odd_rows(docs_of):
    rows = [(k, t, g) for k in range(40) for t, g in (("the cat sat on the mat", "en"), ("der hund ist groß und weiß", "de"))]
    learn = docs_of(rows)
    model = language.fit(learn.select("doc_id", "text", "lang").withColumnRenamed("doc_id", "id"))
    odd = docs_of([(1, None), (2, ""), (3, "12 34 !"), (None, "THE CAT"), (5, "der Hund " * 9000), (5, "der Hund " * 9000)])
    out = sorted((r["row"]["doc_id"] or -1, r["lang_pred"], r["score"] > 0.5) for r in language.predict(odd, model).collect())
    assert out == [(-1, "en", True), (1, "und", False), (2, "und", False), (3, "und", False), (5, "de", True), (5, "de", True)]
    assert language.fit(docs_of([]).select(F.col("doc_id").alias("id"), "text", "lang")) is None
    assert language.predict(odd, None).where("lang_pred <> 'und'").count() == 0
    assert language.predict(docs_of([]), model).collect() == []


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(1)
    labels = rng.integers(0, 3, 500)
    logits = 8 * (np.eye(3)[labels] + rng.normal(0, 1, (500, 3)))
    t = language.fit_temperature(logits, labels)
    loss = [-np.log(language.softmax(logits / x)[np.arange(500), labels]).mean() for x in (1, t)]
    assert t > 1 and loss[1] < loss[0]


def brute_links(rows):
    unit = {}
    for i, (_, vector, label) in enumerate(rows):
        if vector and label is not None and all(v is not None and np.isfinite(v) for v in vector) and any(vector):
            x = np.array(vector, np.float64)
            unit[i] = x / np.linalg.norm(x)
    links = {i: set() for i in range(len(rows))}
    for a in unit:
        for b in unit:
            if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= 0.93:
                links[a].add(b), links[b].add(a)
    return links


def test_links_and_recall(spark):
    rng = np.random.default_rng(2)
    rows = []
    for k in range(260):
        base = rng.normal(size=32)
        for _ in range(rng.integers(1, 5)):
            angle = np.arccos(rng.uniform(0.9, 0.999)) / 2
            other = rng.normal(size=32)
            other -= base * (other @ base) / (base @ base)
            other *= np.linalg.norm(base) / np.linalg.norm(other)
            rows.append((len(rows), (np.cos(angle) * base + np.sin(angle) * other).tolist(), int(k % 3)))
    same = rows[5][1]
    rows += [(len(rows) + k, same, 2) for k in range(700)]
    n = len(rows)
    odd = [None, [], [0.0] * 32, [None] + [1.0] * 31, [float("nan")] * 32, [float("inf")] * 32, [1.0] * 8, [1.0] * 8]
    rows += [(n + k, v, 1) for k, v in enumerate(odd)] + [(n + 50, same, None)]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, key string, id int")
    got = {r["id"]: r for r in pivots.near_duplicates(table).collect()}
    want = brute_links(rows)
    assert len(got) == len(rows)
    found = sum(r["n_links"] for r in got.values())
    true = sum(map(len, want.values()))
    assert 0.9 * true <= found <= true
    few = [k for k in range(n - 700) if k != 5]
    missed = sum(len(want[k]) - got[rows[k][0]]["n_links"] for k in few)
    assert missed <= 0.1 * sum(len(want[k]) for k in few)
    assert all(got[rows[k][0]]["n_links"] <= len(want[k]) for k in range(len(rows)))
    assert {got[n + k]["n_links"] for k in (0, 1, 2, 3, 4, 5)} == {0} and got[n + 6]["component"] == n + 6
    assert got[n + 7]["component"] == n + 6 and got[n + 50]["n_links"] == 0
    empty = spark.createDataFrame([], table.schema)
    assert pivots.near_duplicates(empty).collect() == []


def test_links_of_repeated_and_missing_ids(spark):
    """A row's links are those of its own vector, whatever ids other vectors have."""
    near = lambda k: [1.0, 0.01 * k, 0.0]
    rows = [(1, near(0), 0), (1, [0.0, 0.0, 1.0], 0), (5, near(1), 0), (None, near(2), 0), (None, near(2), 0)]
    rows += [(9, [0.0, 0.02, 1.0], 0), (None, [-1.0, 0.0, 0.0], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted((tuple(r) for r in pivots.near_duplicates(table).collect()), key=repr)
    want = [(1, 3, 1), (1, 1, 1), (5, 3, 1), (None, 3, 1), (None, 3, 1), (9, 1, 1), (None, 0, None)]
    assert got == sorted(want, key=repr)


def test_schedule_keeps_every_window(spark):
    for weights in ([1], [1, 1], [500, 300, 150, 49, 1], [7, 3, 11, 1, 1, 29]):
        rows = [(f"s{k}", w) for k, w in enumerate(weights)]
        plan = mixing.schedule(spark.createDataFrame(rows, "_source string, w long")).collect()
        period = sum(weights)
        assert sorted(r["offset"] for r in plan) == list(range(period))
        done = Counter()
        for r in sorted(plan, key=lambda r: r["offset"]):
            w, i, t = r["w"], r["i"], r["offset"]
            assert i == done[r["_source"]]
            assert i * period // w <= t < -(-(i + 1) * period // w)
            done[r["_source"]] += 1
            for (name, weight) in rows:
                assert abs(done[name] - Fraction(weight * (t + 1), period)) < 1


def edf(weights):
    """Sources by slot: earliest deadline first, with a heap, over one period."""
    period, heap, picks = sum(weights.values()), [], []
    comes = sorted((i * period // w, -(-(i + 1) * period // w), s) for s, w in weights.items() for i in range(w))
    at = 0
    for slot in range(period):
        while at < len(comes) and comes[at][0] <= slot:
            heapq.heappush(heap, comes[at][1:])
            at += 1
        picks.append(heapq.heappop(heap)[1])
    return picks


@pytest.mark.parametrize("many, most", [(7, 400), (61, 90), (3000, 9)])
def test_schedule_equals_a_heap(spark, many, most):
    """Over one shuffle of the tree, over several, and with many sources, one of them hot."""
    rng = random.Random(many)
    weights = {f"s{k:05}": rng.randint(1, most) for k in range(many)}
    weights["hot"] = sum(weights.values()) // 2
    plan = mixing.schedule(spark.createDataFrame(list(weights.items()), "_source string, w long")).toPandas()
    plan = plan.sort_values("offset")
    assert plan.offset.tolist() == list(range(sum(weights.values())))
    assert plan._source.tolist() == edf(weights)
    period = sum(weights.values())
    for row in plan.itertuples(index=False):  # less than one block from its share, at any slot
        w, i, t = row.w, row.i, row.offset
        assert i * period < (t + 1) * w and t * w < (i + 1) * period


def test_weights_of_many_sources(spark):
    """Shares far below one in RESOLUTION keep their proportions."""
    sizes = spark.range(5000).select(F.concat(F.lit("s"), "id").alias("_source"), ((F.col("id") % 2) * 900 + 100).alias("n"))
    got = {r["w"] for r in mixing.tempered(sizes).collect()}
    assert len(got) == 2 and 3.5 < max(got) / min(got) < 6.5
    assert mixing.schedule(spark.createDataFrame([], "_source string, w long")).collect() == []


def test_mix_keeps_columns_of_clashing_names(docs_of):
    docs = docs_of([(k, "t", None, f"s{k % 3}") for k in range(90)])
    docs = docs.withColumns({c: F.concat(F.lit(c), "doc_id") for c in ("i", "w", "n", "offset", "period")})
    out = mixing.mix(docs).collect()
    assert len(out) == 90
    assert all(r[c] == f"{c}{r['doc_id']}" for r in out for c in ("i", "w", "n", "offset", "period"))


def test_mix_of_odd_rows(docs_of):
    rows = [(k, "t", None, "big") for k in range(700)] + [(k, "t", None, "small") for k in range(700, 800)]
    rows += [(900, "t", None, None), (900, "t", None, None), (None, "t", None, "big")]
    out = mixing.mix(docs_of(rows))
    assert out.count() == len(rows)
    numbers = [r["_number"] for r in out.where("source = 'big'").collect()]
    assert sorted(numbers) == list(range(701))
    given = docs_of([]).sparkSession.createDataFrame([("big", 3), ("small", 1)], "source string, w long")
    mixed = mixing.mix(docs_of(rows), given, block=4).collect()
    assert all(r["_slot"] is None and not r["_mixed"] for r in mixed if r["source"] is None)
    inside = Counter(r["source"] for r in mixed if r["_mixed"])
    assert abs(inside["big"] - 3 * inside["small"]) <= 3 * 4
    assert mixing.mix(docs_of([])).collect() == []


def test_mixing_stage_keeps_all_rows(spark, docs_of):
    """A source of one row runs out at once; the others go on, in the order of the schedule."""
    sizes = {"big": 3000, "small": 200, "rare": 1, None: 1}
    rows = [(k, f"t{k}", None, s) for k, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    docs = docs_of(rows)
    out = corpus_pipeline.mixed(spark, docs, SF).select("doc_id").collect()
    slot = {r["doc_id"]: r["_slot"] for r in mixing.mix(docs).collect()}
    assert [r["doc_id"] for r in out] == sorted(slot, key=lambda i: (slot[i], i)) and len(out) == len(rows)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    made = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        made.append((name, docs))
    return made


def test_stages_keep_the_columns(stages):
    for _, docs in stages[1:-1]:
        assert docs.columns == stages[0][1].columns


def test_stages_decide(stages):
    by_name = {name: {r["doc_id"]: r["text"] for r in docs.collect()} for name, docs in stages[:-1]}
    assert by_name["language"].keys() <= by_name["input"].keys()
    assert len(by_name["language"]) > 0.98 * len(by_name["input"])
    kept = by_name["near_duplicates"]
    first = {}
    for i, text in sorted(by_name["language"].items()):
        first.setdefault(text, i)
    assert kept.keys() <= set(first.values())
    clean = by_name["secrets"]
    assert clean.keys() == kept.keys()
    changed = [i for i in kept if clean[i] != kept[i]]
    assert changed and all("[SECRET]" in clean[i] for i in changed)
    assert by_name["mixing"].keys() <= clean.keys()
    last = {r["doc_id"]: r["decoded_sha256"] for r in stages[-1][1].collect()}
    assert last == {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in by_name["mixing"].items()}


def test_stages_take_odd_rows(spark, docs_of):
    rng = random.Random(4)
    words = ["the", "of", "and", "cat", "house", "green", "walks", "into"]
    rows = [(k, " ".join(rng.choices(words, k=40)), "en", f"s{k % 3}") for k in range(60)]
    rows += [(70, None, None, None), (71, "", "en", "s1"), (None, "the house and the cat", None, "s1")]
    rows += [rows[5], rows[6]]
    docs = docs_of(rows)
    for name, stage in corpus_pipeline.STAGES:
        empty = spark.createDataFrame([], docs.schema)
        assert stage(spark, empty, SF).collect() == [], name
        assert stage(spark, docs, SF).count() > 0, name
