"""Real file trees: listing, content, metadata and the jobs over one tree."""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections import Counter
from pathlib import Path

import pytest
from pyarrow import fs
from pyspark.sql import functions as F

from tidemark.operators.verify import REPORT_ORDER
from tidemark.plans import jobs
from tidemark.shared import new_path
from tidemark.sources import filetree
from tidemark.sources.image_headers import measure
from tidemark.sources.stores import Store
from tidemark.sources.tree_source import tree_file_stream, tree_files
from tidemark.streaming import sinks

LABEL = "0 0.31 0.62 0.2 0.17\n"
PNG = bytes.fromhex("89504e470d0a1a0a0000000d49484452") + (640).to_bytes(4, "big") + (
    480
).to_bytes(4, "big")


def build(root: Path, files: dict[str, str | bytes]) -> str:
    for name, content in files.items():
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content.encode() if isinstance(content, str) else content)
    return str(root)


SMALL = {"images/run/k7.jpg": "pixels", "labels/run/k7.txt": LABEL, "classes.txt": "heron\n"}


def test_listing_keeps_hidden_and_empty_files(spark, tmp_path):
    files = {
        "images/train/a b.jpg": b"x",
        "images/train/é%20.PNG": PNG,
        "labels/train/a b.txt": LABEL,
        "labels/train/empty.txt": "",
        "_meta.json": "{}",
        ".gitignore": "x",
        ".hid/deep/a.jpg": "y",
        ".transfer-state/imports/p/i.json": "{}",
        "a/.transfer-state/z": "z",
        "classes.txt": "c",
    }
    root = build(tmp_path, files)
    os.symlink(tmp_path / "classes.txt", tmp_path / "link.txt")
    os.symlink(tmp_path / "nowhere", tmp_path / "broken.txt")
    want = {n for n in files if ".transfer-state" not in n} | {"link.txt"}
    listed = filetree.list_files(spark, root, "d")
    assert {r.relative_path for r in listed.collect()} == want
    read = filetree.read_content(listed, root)
    got = {r.relative_path: bytes(r.content) for r in read.collect()}
    assert set(got) == want
    for name, content in files.items():
        if name in want:
            assert got[name] == (content.encode() if isinstance(content, str) else content)


def test_flat_folder_is_read_in_many_tasks(spark, tmp_path):
    names = [f"images/train/{k:05}.jpg" for k in range(5000)] + ["a/b/c/d/e.txt"]
    root = build(tmp_path, {name: name for name in names})
    listed = filetree.list_files(spark, root, "d", hash_files=True)
    rows = listed.select("relative_path", "sha256", F.spark_partition_id().alias("task")).collect()
    assert {r.relative_path: r.sha256 for r in rows} == {
        n: hashlib.sha256(n.encode()).hexdigest() for n in names
    }
    sizes = Counter(r.task for r in rows)
    assert len(sizes) > spark.sparkContext.defaultParallelism
    assert max(sizes.values()) < 2 * len(names) / len(sizes)


def below_shared_root():
    """A second file system: pyarrow's, seen from a folder above the tree."""

    def opener(root):
        parent, name = os.path.split(root)
        return fs.SubTreeFileSystem(parent, fs.LocalFileSystem()), name

    return opener


def not_below_b():
    """Local files, but nobody may look into a folder called b."""

    class NotBelowB(fs.FileSystemHandler):
        def get_file_info(self, paths):
            return fs.LocalFileSystem().get_file_info(paths)

        def get_file_info_selector(self, selector):
            if selector.base_dir.endswith("/b"):
                raise OSError("closed to readers")
            return fs.LocalFileSystem().get_file_info(selector)

        def get_type_name(self):
            return "not_below_b"

        def normalize_path(self, path):
            return path

    for name in NotBelowB.__abstractmethods__:
        setattr(NotBelowB, name, None)
    NotBelowB.__abstractmethods__ = frozenset()
    return lambda root: (fs.PyFileSystem(NotBelowB()), root)


def test_root_must_be_a_folder(spark, tmp_path):
    with pytest.raises(ValueError, match="no such folder"):
        filetree.list_files(spark, str(tmp_path / "none"), "d")
    with pytest.raises(ValueError, match="local path"):
        filetree.local_root("s3://bucket/x")


def test_file_systems_give_equal_rows(spark, tmp_path):
    files = SMALL | {".hid/a/b/c.txt": "", "images/run/p.png": PNG, "a/.transfer-state/z": "z"}
    root = build(tmp_path, files)
    seen = []
    stores = (root, f"file://{root}", Store(root, below_shared_root()))
    for store in stores:
        listed = filetree.list_files(spark, store, "d")
        described = filetree.add_missing_metadata(listed, store)
        content = filetree.read_content(listed, store).select("relative_path", "content", "read_error")
        seen.append((sorted(map(repr, described.collect())), sorted(map(repr, content.collect()))))
    assert seen[0] == seen[1] == seen[2] and len(seen[0][0]) == len(files) - 1


def test_filters_reach_the_reader(spark, tmp_path):
    """Only folders that can hold a wanted path are listed: others may be unreadable."""
    root = build(tmp_path, {f"{d}/x/{k}.{e}": "1" for d in "ab" for k in range(3) for e in ("txt", "jpg")})
    closed = Store(root, not_below_b())
    wanted = F.col("relative_path").startswith("a/x/") & F.col("relative_path").endswith(".txt")
    listed = tree_files(spark, closed).where(wanted)
    assert sorted(r.relative_path for r in listed.collect()) == [f"a/x/{k}.txt" for k in range(3)]
    one = tree_files(spark, closed).where("relative_path = 'a/x/2.jpg' AND size_bytes = 1")
    assert [r.relative_path for r in one.collect()] == ["a/x/2.jpg"]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.split("Scan")[0]
    with pytest.raises(Exception, match="closed to readers"):
        tree_files(spark, closed).collect()


def test_listing_is_lazy_and_has_no_job_for_a_level(spark, tmp_path):
    root = build(tmp_path, {f"{'d/' * depth}{k}": "x" for depth in range(12) for k in range(3)})
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        listed = filetree.list_files(spark, root, "d")
        filetree.read_content(listed, root)
        assert len(tracker.getJobIdsForGroup("listing")) == 0
        assert len(listed.collect()) == 36
        assert len(tracker.getJobIdsForGroup("listing")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_files_in_chunks(spark, tmp_path):
    root = build(tmp_path, {"a.bin": bytes(range(250)) * 4, "empty": ""})
    with open(tmp_path / "large.bin", "wb") as file:
        file.truncate((2 << 30) + 5)
    listed = filetree.list_files(spark, root, "d")
    small = filetree.read_chunks(listed.where("relative_path <> 'large.bin'"), root, 300).collect()
    assert sorted((r.relative_path, r.offset) for r in small) == [("a.bin", k) for k in (0, 300, 600, 900)] + [("empty", 0)]
    parts = {r.offset: bytes(r.chunk) for r in small if r.relative_path == "a.bin"}
    assert b"".join(parts[k] for k in sorted(parts)) == bytes(range(250)) * 4
    large = filetree.read_chunks(listed.where("relative_path = 'large.bin'"), root, 32 << 20)
    total = large.agg(F.sum(F.octet_length("chunk").cast("long")), F.count("*"), F.count("read_error")).first()
    assert tuple(total) == ((2 << 30) + 5, 65, 0)
    whole = {r.relative_path: r for r in filetree.read_content(listed, root).collect()}
    assert whole["large.bin"].content is None and whole["large.bin"].read_error == filetree.TOO_LARGE


def test_files_of_a_tree_as_a_stream(spark, tmp_path):
    root = build(tmp_path / "tree", {"a/x": "1", "y": "22"})
    out = new_path(spark, "feeds")
    running = sinks.start(tree_file_stream(spark, Store(root)), out, every="300 milliseconds")
    try:
        for names in (["a/x", "y"], ["a/x", "b/c/z", "y"]):
            until = time.monotonic() + 60
            while time.monotonic() < until:
                rows = sinks.read_rows(spark, out, "relative_path string, size_bytes bigint").collect()
                if len(rows) >= len(names):
                    break
                time.sleep(0.3)
            assert sorted(r.relative_path for r in rows) == names
            build(tmp_path / "tree", {"b/c/z": "333"})
    finally:
        running.stop()


def test_unneeded_files_are_not_read(spark, tmp_path):
    """An image beyond what a column holds, and one that is gone, stop no job that needs neither."""
    root = build(tmp_path, SMALL | {"images/run/gone.jpg": "x", "labels/run/gone.txt": LABEL})
    with open(tmp_path / "images" / "run" / "k7.jpg", "wb") as file:
        file.truncate(3 << 30)
    assert jobs.inspect_tree(spark, root).first().image_count == 2
    tree = jobs.open_tree(spark, root)
    os.remove(tmp_path / "images" / "run" / "gone.jpg")
    verdict, _ = jobs.verify_tree(spark, root)
    assert verdict.first().status == "ok"
    known = F.when(F.col("relative_path").endswith(".jpg"), "known")
    files = tree.files.withColumns({"sha256": known, "width": F.lit(3), "height": F.lit(4)})
    rows = {r.relative_path: r for r in filetree.add_missing_metadata(files, root).collect()}
    assert rows["images/run/gone.jpg"].error is None and rows["images/run/k7.jpg"].sha256 == "known"
    assert rows["classes.txt"].sha256 == hashlib.sha256(b"heron\n").hexdigest()
    content = {r.relative_path: r.content for r in filetree.read_content(tree.files, root).collect()}
    assert content["images/run/k7.jpg"] is None and content["images/run/gone.jpg"] is None
    lost = filetree.add_missing_metadata(tree.files.where("relative_path like '%gone.jpg'"), root)
    assert "cannot be read" in lost.first().error


def test_jpeg_segments_are_skipped(tmp_path):
    path = tmp_path / "long.jpg"
    comment = b"\xff\xfe\xff\xff" + b"c" * 65533
    path.write_bytes(b"\xff\xd8" + comment * 40 + b"\xff\xc0\x00\x11\x08" + bytes([1, 2, 3, 4]))
    with open(path, "rb") as file:
        assert measure(file) == (772, 258, None)
    path.write_bytes(b"\xff\xd8" + comment)
    with open(path, "rb") as file:
        assert measure(file)[2] == "no dimensions: no JPEG frame"


def test_metadata_is_read_only_where_missing(spark, tmp_path):
    root = build(tmp_path, {"images/a.png": PNG, "images/b.jpg": "bad", "notes/_n.md": "text"})
    files = filetree.list_files(spark, root, "d")
    described = filetree.add_missing_metadata(files, root)
    rows = {r.relative_path: r for r in described.collect()}
    assert (rows["images/a.png"].width, rows["images/a.png"].height) == (640, 480)
    assert rows["images/b.jpg"].width is None and rows["images/b.jpg"].error
    assert rows["notes/_n.md"].sha256 == hashlib.sha256(b"text").hexdigest()
    found = filetree.unreadable_images(described).collect()
    assert [(f.code, f.path) for f in found] == [("image_read_failed", "images/b.jpg")]


def test_inspect_small_dataset(spark, tmp_path):
    row = jobs.inspect_tree(spark, build(tmp_path, SMALL)).first()
    assert (row.format, row.file_count, row.image_count, row.label_count) == ("yolo", 3, 1, 1)
    assert row.classes == ["heron"]
    assert row.sample_files == ["classes.txt", "images/run/k7.jpg", "labels/run/k7.txt"]


def test_missing_label_is_a_warning(spark, tmp_path):
    files = {k: v for k, v in SMALL.items() if not k.startswith("labels/")}
    verdict, found = jobs.verify_tree(spark, build(tmp_path, files))
    row = verdict.first()
    assert (row.status, row.error_count, row.warning_count) == ("ok", 0, 1)
    warning = found.first()
    assert (warning.code, warning.path) == ("missing_yolo_label", "images/run/k7.jpg")
    assert warning.expected_label_path == "labels/run/k7.txt"


def test_labels_without_images_fail(spark, tmp_path):
    verdict, found = jobs.verify_tree(
        spark, build(tmp_path, {"labels/left/alone.txt": "0 0.4 0.1 0.33 0.08\n"})
    )
    row = verdict.first()
    assert (row.status, row.error_count) == ("failed", 1)
    codes = [r.code for r in found.orderBy(*REPORT_ORDER).collect()]
    assert codes == ["no_images", "missing_class_names", "orphan_yolo_label"]


def test_label_text_rules(spark, tmp_path):
    text = "\r\n0 1 2 3\n\n5 0 0 0 0\x0b-1 0 0 0 0 0 x 0 0 0\n"
    files = SMALL | {
        "labels/run/k7.txt": text,
        "images/run/m.jpg": "x",
        "labels/run/m.txt": b"\xff\xfe bad",
        "images/run/n.jpg": "x",
        "labels/run/n.txt": "",
    }
    _verdict, found = jobs.verify_tree(spark, build(tmp_path, files))
    got = [(r.code, r.path, r.line) for r in found.orderBy(*REPORT_ORDER).collect()]
    assert got == [
        ("invalid_yolo_label", "labels/run/k7.txt", 2),
        ("unknown_yolo_class", "labels/run/k7.txt", 4),
        ("invalid_yolo_class", "labels/run/k7.txt", 5),
        ("invalid_yolo_label", "labels/run/k7.txt", 6),
        ("label_read_failed", "labels/run/m.txt", None),
    ]


def test_other_formats_only_need_an_image(spark, tmp_path):
    verdict, found = jobs.verify_tree(spark, build(tmp_path, {"a.json": "{}"}), "coco")
    assert verdict.first().status == "failed"
    assert [r.message for r in found.collect()] == ["dataset has no image files"]


def test_samples_keep_labels_metadata_and_all_class_names(spark, tmp_path):
    files = {f"images/{c}.jpg": "x" for c in "abc"} | {f"labels/{c}.txt": LABEL for c in "bc"}
    files |= {"data.yaml": "names: {5: b, 0: a}\n", "x.json": "{}", "notes/y.json": "{}"}
    root = build(tmp_path, files)
    tree = jobs.open_tree(spark, root, max_samples=2)
    kept = {r.relative_path for r in tree.files.collect()}
    assert kept == {"images/a.jpg", "images/b.jpg", "labels/b.txt", "data.yaml", "x.json"}
    names = {r.class_id: r.class_name for r in tree.classes.collect()}
    assert names == {0: "a", 1: "b"}
    with pytest.raises(ValueError):
        jobs.open_tree(spark, root, "coco", max_samples=1)
    with pytest.raises(ValueError):
        jobs.open_tree(spark, root, "yolo", max_files=1)


def test_cleanup_plan(spark, tmp_path):
    states, listing = tmp_path / "states", tmp_path / "listing"
    done = {"project_id": "proj_1", "import_id": "imp_north", "source": "/d", "format": "yolo"}
    flags = {"uploaded": True, "streamed": True}
    document = done | {"completed": True, "files": {"a.jpg": flags, "b.jpg": 3}}
    build(
        states,
        {
            "proj_1/imp_north.json": json.dumps(document),
            "proj_1/imp_open.json": json.dumps(document | {"import_id": "imp_open"}),
            "proj_1/array.json": "[1]",
            "proj_1/cut.json": json.dumps(document)[:-1],
            "proj_1/none.json": json.dumps({"import_id": "x"}),
            "other/imp_north.json": json.dumps(document),
        },
    )
    page = {
        "imports": [
            {"import_id": "imp_north", "status": "succeeded", "progress": {"phase": "packing"}},
            {"import_id": "imp_open", "status": "ready"},
            "text",
        ],
        "next_cursor": "after-north",
    }
    build(listing, {"proj_1/page-1.json": json.dumps(page)})
    actions, local = jobs.cleanup_plan(spark, str(states), str(listing), "proj_1")
    counts = {r.import_id: (r.total_files, r.uploaded_files) for r in local.collect()}
    assert counts == {"imp_north": (2, 1), "imp_open": (2, 1), "x": (0, 0)}
    assert [tuple(a) for a in actions.collect()] == [
        (
            "proj_1",
            "remove_local_state",
            str(states / "proj_1" / "imp_north.json"),
            "server import is terminal and local resume state is completed",
        )
    ]


def test_upload_plan_resumes(spark, tmp_path):
    state = spark.createDataFrame(
        [("dataset", "classes.txt", True, True), ("dataset", "images/run/k7.jpg", True, False)],
        "dataset_id string, relative_path string, uploaded boolean, streamed boolean",
    )
    plan = jobs.upload_plan(spark, build(tmp_path, SMALL), state, batch_size=2)
    rows = [(r.relative_path, r.status, r.batch_id) for r in plan.orderBy("row_index").collect()]
    assert rows == [
        ("classes.txt", "done", 0),
        ("images/run/k7.jpg", "pending_stream", 0),
        ("labels/run/k7.txt", "pending_upload", 1),
    ]
    with pytest.raises(ValueError):
        jobs.upload_plan(spark, str(tmp_path), state, batch_size=1001)


def test_file_hash_option(spark, tmp_path):
    root = build(tmp_path, SMALL)
    row = (
        filetree.list_files(spark, root, "d", hash_files=True)
        .where(F.col("relative_path") == "classes.txt")
        .first()
    )
    assert row.sha256 == hashlib.sha256(b"heron\n").hexdigest()
