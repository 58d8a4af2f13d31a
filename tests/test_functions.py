"""Column functions against tables of cases and small Python models."""

from __future__ import annotations

import io
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import labels, paths, refs, sizes, status, urls
from tidemark.operators import verify
from tidemark.sources import documents
from tidemark.sources.image_headers import image_size

FIELDS, NUMBER, NEGATIVE = labels.FIELDS_MESSAGE, labels.NUMBER_MESSAGE, labels.NEGATIVE_MESSAGE


def model(raw: str, class_count: int) -> tuple[str | None, int | None]:
    """Message and class of one line, straight from the rules."""
    tokens = raw.split()
    if len(tokens) < 5:
        return FIELDS, None
    try:
        first, *_rest = [float(t) for t in tokens]
        value = int(first)
    except (ValueError, OverflowError):
        return NUMBER, None
    if value < 0:
        return NEGATIVE, value
    if class_count and value >= class_count:
        return labels.UNKNOWN_MESSAGE, value
    return None, value


CASES = [
    "0 1 2 3", "0 x 1 1 1", "-1 0 0 0 0", "-0.5 0 0 0 0", "2.9 0 0 0 0", "1.0d 0 0 0 0",
    "0x1p3 0 0 0 0", "1_0 0 0 0 0", "1__0 0 0 0 0", "_1 0 0 0 0", "nan 0 0 0 0", "inf 0 0 0 0",
    "-inf 0 0 0 0", "1e400 0 0 0 0", "0 inf nan -nan +inf 1e400", "0\xa01 3\x1c4 5", "1. .5 +.5e-3 1E+2 0",
    ". 0 0 0 0", "1e 0 0 0 0", "0 0 0 0 0x", "\t0 0 0 0 0 ", "0 0 0 0 0 " + "0.1 " * 5000, "0 1 1 1 1,",
    "0 " + "0.5 " * 3000 + "x", "1f 0 0 0 0", "infinity 0 0 0 0", "0 Infinity NaN 0 1_0.5_0e1_0",
]


def test_label_lines_match_model(spark):
    rng = random.Random(7)
    alphabet = ["0", "1", "7", ".", "-", "+", "e", "_", "x", " ", " ", "\t", "nan", "inf", "\x1d", "　"]
    lines = CASES + ["".join(rng.choices(alphabet, k=rng.randint(6, 24))) for _ in range(3000)]
    lines += [" ".join(rng.choices(["0", "1.5", "-2", "3e0", "4_0", ".5", "x"], k=rng.randint(4, 9))) for _ in range(2000)]
    lines = [raw for raw in lines if raw.strip()]
    rows = [("d", "p", i, raw) for i, raw in enumerate(lines)]
    df = spark.createDataFrame(rows, "dataset_id string, path string, line bigint, raw string")
    counts = spark.createDataFrame([("d", 3)], "dataset_id string, class_count bigint")
    found = {r.line: r for r in verify.label_findings(df, counts).collect()}
    parsed = {r.line: r for r in verify.parse_labels(df).collect()}
    column = df.select("line", labels.parse_label_line(F.col("raw")).alias("p"))
    by_column = {r.line: r.p for r in column.collect()}
    for i, raw in enumerate(lines):
        message, value = model(raw, 3)
        assert (found[i].message if i in found else None) == message, raw
        assert by_column[i].code == parsed[i].code, raw
        if message not in (FIELDS, NUMBER):
            assert parsed[i].class_id == value, raw
            got = [None if c != c else c for c in parsed[i].coords]
            assert got == [None if float(t) != float(t) else float(t) for t in raw.split()[1:]]
            if message == labels.UNKNOWN_MESSAGE:
                assert (found[i].severity, found[i].class_id) == ("warning", value)


def test_no_names_means_no_range_check(spark):
    df = spark.createDataFrame(
        [("d", "p", 1, "9 0 0 0 0")], "dataset_id string, path string, line bigint, raw string"
    )
    counts = spark.createDataFrame([("d", 0)], "dataset_id string, class_count bigint")
    assert verify.label_findings(df, counts).count() == 0


def test_lines_are_split_like_python(spark):
    rng = random.Random(3)
    marks = ["a", "b ", "\n", "\r\n", "\r", "\x0b", "\x0c", "\x1c", "\x1e", "\x1f", "\x85", " ", " "]
    texts = ["".join(rng.choices(marks, k=rng.randint(0, 12))) for _ in range(500)]
    df = spark.createDataFrame(
        [("d", str(i), t) for i, t in enumerate(texts)], "dataset_id string, path string, text string"
    )
    got: dict[int, list] = {}
    for r in documents.read_label_lines(df).collect():
        got.setdefault(int(r.path), []).append((r.line, r.raw))
    for i, text in enumerate(texts):
        want = [(n, s) for n, s in enumerate(text.splitlines(), 1) if s.strip()]
        assert sorted(got.get(i, [])) == want, repr(text)


@pytest.mark.parametrize(
    "path, image, kind",
    [
        ("a/b.JPG", True, "image/jpeg"),
        (".png", False, "application/octet-stream"),
        ("a/.png", False, "application/octet-stream"),
        ("x.jpg\n", False, "application/octet-stream"),
        ("x.tar.gz", False, "application/x-tar"),
        ("x.TGZ", False, "application/x-tar"),
        ("x.gz", False, "application/octet-stream"),
        ("n.yaml", False, "application/octet-stream"),
        ("a.b/c", False, "application/octet-stream"),
        ("x.webp", True, "image/webp"),
    ],
)
def test_path_kinds(spark, path, image, kind):
    row = spark.range(1).select(
        paths.is_image(F.lit(path)).alias("i"), paths.content_type(F.lit(path)).alias("t")
    )
    assert tuple(row.first()) == (image, kind)


def test_component_order_differs_from_string_order(spark):
    df = spark.createDataFrame([(p,) for p in ("a-b", "a/b", "a", "a.b/c", "a/b/c")], "p string")
    by_parts = [r.p for r in df.orderBy(paths.component_order(F.col("p"))).collect()]
    assert by_parts == ["a", "a/b", "a/b/c", "a-b", "a.b/c"]
    by_text = [r.p for r in df.orderBy(paths.string_order(F.col("p"))).collect()]
    assert by_text == sorted(by_text)


def test_safe_segment(spark):
    df = spark.createDataFrame([("a b/é",), ("..",), ("",), ("_x.y-z.",)], "p string")
    got = [r[0] for r in df.select(paths.safe_segment(F.col("p"))).collect()]
    assert got == ["a_b_é", "default", "default", "x.y-z"]


def test_rewritten_upload_url(spark):
    made = urls.upload_request(
        F.lit("https://svc.example.com/api/v1"),
        F.lit("https://svc.example.com/bucket/a.jpg?X-Sig=1#"),
        F.lit("http://127.0.0.1:9000/"),
    )
    row = spark.range(1).select(made.alias("r")).first().r
    assert row.url == "http://127.0.0.1:9000/bucket/a.jpg?X-Sig=1"
    assert (row.host, row.error) == ("svc.example.com", None)


def test_url_errors(spark):
    base, rel = F.lit("api.example.com"), F.lit("/x")
    row = spark.range(1).select(
        urls.resolve_url(base, rel).alias("u"),
        urls.resolve_url_error(base, rel).alias("e"),
        urls.rewrite_origin(F.lit("relative"), F.lit("http://h"))["error"].alias("a"),
        urls.rewrite_origin(F.lit("http://h/x"), F.lit("ftp://h"))["error"].alias("b"),
    )
    u, e, a, b = row.first()
    assert u is None and e and a and b


def test_hosts(spark):
    cases = {
        "http://localhost:9000/x": True,
        "http://u:p@S3.minio/x": True,
        "http://[::1]/x": False,
        "http://notminio/x": False,
        "/x": False,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    got = {r[0]: r[1] for r in df.select("u", urls.host_in_domains(F.col("u"))).collect()}
    assert got == cases


def test_promoted_refs_keep_own_and_skip_text(spark):
    text = (
        '{"artifact_ref":"text","dataset_manifest_ref":{"id":"own"},'
        '"complete":{"dataset_manifest_ref":{"id":"other"},"read_lease":5},'
        '"multipart":{"complete":{"artifact_ref":{"id":"ar","storage":{"kind":"k"}},'
        '"read_lease":{"id":"lease"}}},"job":{"artifact_ref":{"id":"late"}}}'
    )
    row = spark.range(1).select(refs.promote_refs(F.lit(text)).alias("r")).first().r
    assert row.dataset_manifest_ref == '{"id":"own"}'
    assert row.artifact_ref == '{"id":"ar","storage":{"kind":"k"}}'
    assert row.read_lease == '{"id":"lease"}'
    assert row.result_manifest_ref is None


def test_status_sets_differ(spark):
    df = spark.createDataFrame([("ready",), (" FAILED",), ("Canceled",), (None,)], "s string")
    got = [
        tuple(r)
        for r in df.select(
            status.import_status_class(F.col("s")), status.is_terminal(F.col("s"))
        ).collect()
    ]
    assert got == [("success", False), ("failed", False), ("failed", True), ("pending", False)]


def test_auth_result_needs_gate_and_text(spark):
    df = spark.createDataFrame(
        [(22, "returned error: 401"), (1, "unauthorized"), (401, "other")], "c int, t string"
    )
    got = [r[0] for r in df.select(status.is_auth_result(F.col("c"), F.col("t"))).collect()]
    assert got == [True, False, False]


def test_part_size_limits(spark):
    mib = 1024 * 1024
    cases = [(1, 1, 5 * mib), (1, 8, 8 * mib), (1, 0, 64 * mib), (10**12, 0, 111111112)]
    df = spark.createDataFrame([c[:2] for c in cases], "t bigint, r int")
    got = [r[0] for r in df.select(sizes.part_size(F.col("t"), F.col("r"))).collect()]
    assert got == [c[2] for c in cases]


def yaml_case(spark, text: str):
    df = spark.createDataFrame([("d", "data.yaml", text)], "dataset_id string, path string, text string")
    table, problems = documents.class_catalog(df)
    names = [r.class_name for r in table.orderBy("class_id").collect()]
    return names, [p.message for p in problems.collect()]


def test_class_documents(spark):
    assert yaml_case(spark, "names: [a, ' b ', '', 3]\nnc: 3") == (["a", "b", "3"], [])
    assert yaml_case(spark, "names: {'5': x, 0: y, 2: ' '}") == (["y", "x"], [])
    assert yaml_case(spark, "train: x") == ([], [])
    for bad in ("- a", "names: {x: a}", "names: text", "names: []", "names: [a]\nnc: 2", "a: [", "names: [a]\nnc: z"):
        names, problems = yaml_case(spark, bad)
        assert names == [] and len(problems) == 1, bad


def test_image_headers():
    little = lambda n, k: n.to_bytes(k, "little")
    bmp = b"BM" + bytes(12) + little(40, 4) + little(31, 4) + (-17 & 0xFFFFFFFF).to_bytes(4, "little")
    lossless = b"RIFF" + bytes(4) + b"WEBPVP8L" + bytes(4) + b"\x2f" + little((639) | (479 << 14), 4)
    lossy = b"RIFF" + bytes(4) + b"WEBPVP8 " + bytes(7) + b"\x9d\x01\x2a" + little(320, 2) + little(200, 2)
    jpeg = bytes.fromhex("ffd8ffe000040102ffffc2000b08") + bytes([0, 9, 1, 0]) + bytes(6)
    assert image_size(io.BytesIO(bmp)) == (31, 17)
    assert image_size(io.BytesIO(lossless)) == (640, 480)
    assert image_size(io.BytesIO(lossy)) == (320, 200)
    assert image_size(io.BytesIO(jpeg)) == (256, 9)
    for broken in (b"", b"\xff\xd8", b"BM", bmp[:20], lossy[:24], b"RIFF....WEBPVP8L", b"GIF89a"):
        with pytest.raises((ValueError, IndexError)):
            image_size(io.BytesIO(broken))
