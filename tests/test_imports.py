"""Stored import states, listing pages and changed files."""

from __future__ import annotations

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import planning
from tidemark.operators.imports import latest_server_imports
from tidemark.shared import finished_writes, new_path
from tidemark.sources import imports, writers

STATE = "project_id string, import_id string, relative_path string, uploaded boolean"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def test_interleaved_writers_lose_nothing(spark, monkeypatch):
    path = new_path(spark, "states")
    put = lambda rows: writers.write_import_state(spark.createDataFrame(rows, STATE), path)
    assert writers.read_import_state(spark, path, STATE).collect() == []
    put([("p", "a", "1", False), ("p", "a", "2", False), ("p", "b", "1", False), (None, "a", "9", True)])
    # A second writer begins, a third writes other imports to its end, then the second ends.
    real, order = writers.time.time_ns, []
    early = real()
    order.append(put([("p", "b", "1", True), ("q", "", "x", True)]))
    monkeypatch.setattr(writers.time, "time_ns", lambda: early)
    order.append(put([("p", "c", "5", True), ("p", "b", "0", False)]))
    monkeypatch.setattr(writers.time, "time_ns", real)
    assert order[1] < order[0]
    want = [(None, "a", "9", True), ("p", "a", "1", False), ("p", "a", "2", False)]
    want += [("p", "b", "1", True), ("p", "c", "5", True), ("q", "", "x", True)]
    key = lambda r: (r[0] or "", *r[1:])
    assert sorted(map(tuple, writers.read_import_state(spark, path, STATE).collect()), key=key) == want
    # A write that never ended is not read.
    broken = f"{path}/version={real():020d}-x"
    spark.createDataFrame([("p", "a", "half", True)], STATE).write.parquet(broken)
    os.remove(f"{broken}/_SUCCESS")
    assert sorted(map(tuple, writers.read_import_state(spark, path, STATE).collect()), key=key) == want
    writers.fold_import_state(spark, path, STATE)
    assert len(finished_writes(spark, path)) == 1
    put([("p", "a", "3", True)])
    want = [r for r in want if r[:2] != ("p", "a")]
    want.insert(1, ("p", "a", "3", True))
    assert sorted(map(tuple, writers.read_import_state(spark, path, STATE).collect()), key=key) == want


def test_reading_states_sorts_no_rows(spark):
    """The last version of each import comes from a few distinct rows, and the rows are read once more."""
    path = new_path(spark, "states")
    for flag in (False, True):
        rows = spark.range(2000).selectExpr("'p' project_id", "'i' || id % 3 import_id", "'' || id relative_path")
        rows = rows.where("import_id < 'i2'") if flag else rows
        writers.write_import_state(rows.withColumn("uploaded", F.lit(flag)), path)
    read = writers.read_import_state(spark, path, STATE)
    assert read.groupBy("import_id", "uploaded").count().count() == 3
    scans = [line for line in read._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert sum("[project_id#" in line for line in scans) == 1
    assert sum("[_project_id#" in line for line in scans) == 1


def page(path, status, cursor=None, after=None, mtime=0, project="p"):
    text = {"imports": [{"import_id": "i", "status": status}, {"import_id": status, "status": "x"}]}
    text |= {"cursor": cursor} if cursor else {}
    text |= {"next_cursor": after} if after else {}
    return project, path, mtime, json.dumps(text)


def pages(spark, rows):
    df = spark.createDataFrame(rows, "project_id string, path string, sec long, text string")
    return df.select("project_id", "path", F.timestamp_seconds("sec").alias("mtime"), "text")


def last_status(spark, rows):
    found = latest_server_imports(imports.listed_imports(pages(spark, rows)))
    return {r.project_id: r.status for r in found.where("import_id = 'i'").collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_pages_follow_their_cursors(spark, seed):
    """Shuffled names and landing times: the chain of cursors alone gives the order."""
    rng = random.Random(seed)
    names = rng.sample(range(100), 37)
    cursors = [None, *(f"c{rng.random()}" for _ in range(36)), None]
    rows = [page(f"/p/{names[k]}.json", f"s{k}", cursors[k], cursors[k + 1], rng.randint(0, 9)) for k in range(37)]
    rows += [page("/q_5/page-10.json", "new", project="q"), page("/q_5/page-9.json", "old", mtime=3, project="q")]
    rng.shuffle(rows)
    assert last_status(spark, rows) == {"p": "s36", "q": "new"}
    ranks = {r.path: r["rank"] for r in imports.page_ranks(pages(spark, rows)).collect()}
    assert ranks == {f"/p/{names[k]}.json": k for k in range(37)}


def test_listings_made_twice_and_circles(spark):
    twice = [page("/p/z.json", "a1", None, "c", 1), page("/p/y.json", "a2", "c", None, 2)]
    twice += [page("/p/b.json", "b1", None, "d", 5), page("/p/a.json", "b2", "d", None, 6)]
    circle = [page("/r/1.json", "one", "x", "y", project="r"), page("/r/2.json", "two", "y", "x", project="r")]
    folder = [page("/s_7/page.json", "only", project="s"), page("/s_7/page-1.json", "next", project="s")]
    assert last_status(spark, twice + circle + folder) == {"p": "b2", "r": "two", "s": "next"}
    assert imports.page_ranks(pages(spark, circle)).collect() == []
    assert imports.listed_imports(pages(spark, circle).limit(0)).collect() == []


def test_changed_files_are_pending_if_asked(spark):
    files = spark.createDataFrame(
        [("d", "same", 5, "h"), ("d", "size", 6, None), ("d", "hash", 5, "new"), ("d", "unknown", 5, None), ("d", "fresh", 1, None)],
        "dataset_id string, relative_path string, size_bytes bigint, sha256 string",
    )
    known = [("d", n, True, True, s, h) for n, s, h in (("same", 5, "h"), ("size", 5, "h"), ("hash", 5, "h"), ("unknown", 0, ""))]
    state = spark.createDataFrame(
        known, "dataset_id string, relative_path string, uploaded boolean, streamed boolean, size_bytes bigint, sha256 string"
    )
    status = lambda df: {r.relative_path: r.status for r in df.collect()}
    plain = {"same": "done", "size": "done", "hash": "done", "unknown": "done", "fresh": "pending_upload"}
    assert status(planning.resume_split(files, state)) == plain
    asked = status(planning.resume_split(files, state, detect_changes=True))
    assert asked == plain | {"size": "pending_upload", "hash": "pending_upload"}
    few = state.drop("size_bytes", "sha256")
    assert status(planning.resume_split(files, few, detect_changes=True)) == plain


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_files_of_a_manifest_grow_with_rows_not_with_datasets(spark, tmp_path, fmt):
    """3,000 small datasets don't make 3,000 folders; names that a folder can't carry come back."""
    number = F.col("id")
    names = F.when(number % 4 == 1, "").when(number % 4 == 2, F.lit(None)).otherwise(F.concat(F.lit("007/"), number % 3000))
    files = spark.range(9000).select(names.alias("dataset_id"), F.concat(F.lit("f"), number).alias("relative_path"))
    path = str(tmp_path / "manifest")
    writers.write_manifest(files, path, fmt)
    made = [name for _, _, found in os.walk(path) for name in found if name.startswith("part-")]
    assert 0 < len(made) <= 64
    back = spark.read.schema(files.schema).format(fmt).load(path)
    assert sorted(back.collect(), key=lambda r: r[1]) == sorted(files.collect(), key=lambda r: r[1])


def test_objects_are_told_without_a_schema_of_all_that_is_in_them(spark):
    """a resume document is judged by its first sign and parsed, not walked through for its schema."""
    texts = ["{}", ' \t\r\n{"a":[{}]}', "{", "[{}]", "5", '"{}"', "", "{a:1}", "\f{}", None]
    found = spark.createDataFrame([(t,) for t in texts], "text string").select("text", imports.is_json_object(F.col("text")))
    assert [r[1] for r in found.collect()] == [True, True] + [False] * 8
    assert "schema_of_variant" not in found._jdf.queryExecution().analyzed().toString()
