"""Queries over readers and writers. Each first derives the files it reads from whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import imports as import_operators
from tidemark.operators.classes import compact_class_ids
from tidemark.plans.registry import query
from tidemark.plans.trees import write_tree
from tidemark.plans.views import STATE_DIR, table, view
from tidemark.shared import new_path
from tidemark.sources import documents, filetree, image_headers, imports, writers

_KEPT = f"relative_path NOT LIKE '{STATE_DIR}/%'"
_EMPTY = "doc_id % 40 IN (8, 12, 29)"
_CUT_SHORT = "doc_id % 40 = 17"
# Dimensions an image file of a document gets, and its header as hex.
_W, _H = "(length(text) % 5000 + 1)", "(doc_id % 3000 + 1)"
_BIG4 = "lpad(hex({0}), 8, '0')"
_BIG2 = "lpad(hex({0}), 4, '0')"


def _little(value: str, size: int) -> str:
    """Hex of an integer, low byte first."""
    padded = f"lpad(hex({value}), {size * 2}, '0')"
    return " || ".join(f"substr({padded}, {i * 2 + 1}, 2)" for i in reversed(range(size)))


_HEADER = f"""CASE doc_id % 8
    WHEN 0 THEN '89504E470D0A1A0A0000000D49484452' || {_BIG4.format(_W)} || {_BIG4.format(_H)}
    WHEN 1 THEN '424D0000000000000000360000002800' || '0000' || {_little(_W, 4)}
      || {_little(_H, 4)}
    WHEN 2 THEN '5249464600000000574542505650385800000000' || '00000000'
      || {_little(f"({_W} - 1)", 3)} || {_little(f"({_H} - 1)", 3)}
    WHEN 3 THEN 'FFD8FFE000064A464946FFFE00044142FFC0001108' || {_BIG2.format(_H)}
      || {_BIG2.format(_W)}
    ELSE '' END"""


def _tree_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file: images get a header before the text, a few files are empty and a
    few images end inside their header."""
    header = F.expr(_HEADER)
    body = F.concat(F.unhex(header), F.col("text").cast("binary"))
    content = (
        F.when(F.expr(_EMPTY), F.lit(b""))
        .when(F.expr(_CUT_SHORT), F.unhex(F.substring(header, 1, 20)))
        .otherwise(body)
    )
    return view(spark, sf_dir, "v_tree").select("doc_id", "relative_path", content.alias("content"))


def _tree(spark: SparkSession, sf_dir: str) -> str:
    root = filetree.local_root(new_path(spark, "trees"))
    write_tree(_tree_rows(spark, sf_dir), root)
    return root


_CONTENT = f"""(SELECT doc_id, text, relative_path, CASE WHEN {_EMPTY} THEN ''::BLOB
    WHEN {_CUT_SHORT} THEN unhex(substr({_HEADER}, 1, 20))
    ELSE unhex({_HEADER}) || encode(text) END AS content FROM v_tree WHERE {_KEPT})"""
_IS_IMAGE = "doc_id % 8 < 4"
_MEASURED = f"{_IS_IMAGE} AND NOT ({_EMPTY}) AND NOT ({_CUT_SHORT})"


@query(
    "list_files",
    f"""SELECT 'tree' AS dataset_id, relative_path, octet_length(content)::BIGINT AS size_bytes,
        CASE doc_id % 8 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/bmp' WHEN 2 THEN 'image/webp'
          WHEN 3 THEN 'image/jpeg' WHEN 6 THEN 'text/markdown' ELSE 'text/plain' END AS content_type
      FROM {_CONTENT}""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = filetree.list_files(spark, _tree(spark, sf_dir), "tree", STATE_DIR)
    return listed.select("dataset_id", "relative_path", "size_bytes", "content_type")


@query(
    "list_files_hashed",
    f"SELECT relative_path, sha256(content) AS sha256 FROM {_CONTENT}",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _tree(spark, sf_dir)
    listed = filetree.list_files(spark, root, "tree", STATE_DIR, hash_files=True)
    return listed.select("relative_path", "sha256")


@query(
    "read_content",
    f"""SELECT relative_path, octet_length(content)::BIGINT AS n_bytes, sha256(content) AS sha256
      FROM {_CONTENT}""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _tree(spark, sf_dir)
    listed = filetree.list_files(spark, root, "tree", STATE_DIR)
    return filetree.read_content(listed, root).select(
        "relative_path",
        F.octet_length("content").cast("bigint").alias("n_bytes"),
        F.sha2("content", 256).alias("sha256"),
    )


@query(
    "image_dimensions",
    f"""SELECT doc_id, {_W}::INT AS width, {_H}::INT AS height FROM documents
      WHERE {_MEASURED}
      UNION ALL SELECT doc_id, NULL, NULL FROM documents WHERE NOT ({_MEASURED})""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    contents = _tree_rows(spark, sf_dir).select("doc_id", "content")
    return image_headers.image_dimensions(contents).drop("error")


@query(
    "unreadable_images",
    f"""SELECT 'tree' AS dataset_id, relative_path AS path, 'image_read_failed' AS code
      FROM {_CONTENT} WHERE {_IS_IMAGE} AND NOT ({_MEASURED})""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _tree(spark, sf_dir)
    files = filetree.list_files(spark, root, "tree", STATE_DIR)
    described = filetree.add_missing_metadata(files, root)
    return filetree.unreadable_images(described).select("dataset_id", "path", "code")


@query(
    "add_missing_metadata",
    f"""SELECT relative_path,
        CASE WHEN doc_id % 3 = 0 THEN 'known' ELSE sha256(content) END AS sha256,
        CASE WHEN doc_id % 3 = 0 THEN 7 WHEN {_MEASURED} THEN {_W} END::INT
          AS width,
        CASE WHEN doc_id % 3 = 0 THEN 9 WHEN {_MEASURED} THEN {_H} END::INT
          AS height
      FROM {_CONTENT}""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = _tree(spark, sf_dir)
    number = F.regexp_extract("relative_path", r"(\d+)[^/\d]*(20b\.md)?$", 1).cast("bigint")
    written_for = F.when(F.col("relative_path").startswith("labels/"), number + 4).otherwise(number)
    known = written_for % 3 == 0
    files = filetree.list_files(spark, root, "tree", STATE_DIR).withColumns(
        {
            "sha256": F.when(known, "known"),
            "width": F.when(known, 7).cast("int"),
            "height": F.when(known, 9).cast("int"),
        }
    )
    filled = filetree.add_missing_metadata(files, root)
    return filled.select("relative_path", "sha256", "width", "height")


@query(
    "class_catalog_lines",
    r"""SELECT CAST(doc_id AS VARCHAR) AS dataset_id,
        CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INT) AS class_id,
        name AS class_name
      FROM (SELECT doc_id, regexp_replace(s, '^[\s\x{a0}]+|[\s\x{a0}]+$', '', 'g') AS name, i
        FROM (SELECT doc_id, unnest(p) AS s, generate_subscripts(p, 1) AS i
          FROM (SELECT doc_id, string_split_regex(text, '\r\n|[\n\r\x0B\x0C\x1C-\x1E]') AS p
            FROM documents)))
      WHERE name <> ''""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("dataset_id"), F.lit("classes.txt").alias("path"), "text"
    )
    return compact_class_ids(documents.class_names(texts))


def _class_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One YAML document per forty parts, in the shapes metadata comes in."""
    part = table(spark, sf_dir, "part")
    block = F.expr("p_partkey div 40")
    position = F.col("p_partkey") % 40
    name = F.when(F.col("p_partkey") % 7 == 0, F.lit("'  '")).otherwise(
        F.concat(F.lit("' "), "p_name", F.lit("'"))
    )
    kind = F.col("block") % 6
    entry = (
        F.when(kind == 0, F.concat(F.lit("- "), name))
        .when(kind == 1, F.concat(F.lit("x"), position.cast("string"), F.lit(": "), name))
        .otherwise(F.concat((position * 3).cast("string"), F.lit(": "), name))
    )
    lines = part.withColumn("block", block).select(
        "block", "p_partkey", F.concat(F.lit("  "), entry).alias("line")
    )
    listed = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "line"))), lambda x: x["line"]),
        "\n",
    )
    whole = lines.groupBy("block").agg(listed.alias("body"))
    names = F.concat(F.lit("path: .\nnames:\n"), "body")
    text = (
        F.when(kind == 3, F.lit("train: images/train\n"))
        .when(kind == 4, F.concat(names, F.lit("\nnc: 7\n")))
        .when(kind == 5, F.lit("names: [unclosed"))
        .otherwise(names)
    )
    return whole.select(
        F.concat(F.lit("set_"), F.col("block").cast("string")).alias("dataset_id"),
        F.lit("data.yaml").alias("path"),
        text.alias("text"),
    )


_NAMED = """(SELECT CAST(floor(p_partkey / 40) AS BIGINT) AS block, p_partkey, p_name FROM part)"""


@query(
    "class_catalog_yaml",
    f"""SELECT 'set_' || block AS dataset_id, CAST(row_number() OVER (PARTITION BY block
          ORDER BY p_partkey) - 1 AS INT) AS class_id, trim(p_name) AS class_name
      FROM {_NAMED} WHERE p_partkey % 7 <> 0 AND block % 6 IN (0, 2)""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compact_class_ids(documents.class_names(_class_documents(spark, sf_dir)))


@query(
    "class_catalog_problems",
    f"""SELECT 'set_' || block AS dataset_id, 'invalid_class_metadata' AS code, 'data.yaml' AS path,
        CASE block % 6 WHEN 1 THEN 'a key of names is not an integer'
          WHEN 4 THEN 'nc is 7 but there are ' || count(*) FILTER (p_partkey % 7 <> 0) || ' names'
          ELSE 'document cannot be parsed as YAML' END AS message
      FROM {_NAMED} WHERE block % 6 IN (1, 4, 5) GROUP BY block""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = documents.metadata_problems(_class_documents(spark, sf_dir))
    return found.select("dataset_id", "code", "path", "message")


_STATE_OWNER = "CASE WHEN o_custkey % 3 = 0 THEN 'proj_0' ELSE 'proj_1' END"


def _spelled_flag(flag: Column, number: Column) -> Column:
    """A flag as JSON: true and false, or another value that counts as the same."""
    yes = F.when(number % 5 == 0, "1").when(number % 7 == 0, '"false"').when(number % 11 == 0, "[0]")
    no = F.when(number % 5 == 0, "0").when(number % 7 == 0, '""').when(number % 11 == 0, "null")
    return F.when(flag, yes.otherwise("true")).otherwise(no.otherwise("false"))


def _state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One resume document per customer, holding the customer's orders as files; some are cut
    short, some are arrays."""
    orders = table(spark, sf_dir, "orders")
    number = F.col("o_orderkey")
    value = F.when(number % 23 == 0, F.lit("5")).otherwise(
        F.concat(
            F.lit('{"uploaded":'),
            _spelled_flag(number % 2 == 0, number),
            F.lit(',"streamed":'),
            _spelled_flag(number % 4 == 0, number + 1),
            F.lit(',"sha256":"","size_bytes":'),
            number.cast("string"),
            F.lit(',"width":0}'),
        )
    )
    entry = F.concat(F.lit('"images/'), number.cast("string"), F.lit('.jpg":'), value)
    owner = F.expr(_STATE_OWNER).alias("project_id")
    files = orders.groupBy("o_custkey", owner).agg(
        F.array_join(F.collect_list(entry), ",").alias("files")
    )
    customer = F.col("o_custkey").cast("string")
    whole = F.concat(
        F.lit('{"project_id":"'),
        "project_id",
        F.lit('","import_id":"imp_'),
        customer,
        F.lit('","source":"/data","format":"yolo","completed":'),
        _spelled_flag(F.col("o_custkey") % 2 == 0, F.col("o_custkey")),
        F.lit(',"files":{'),
        "files",
        F.lit("}}"),
    )
    text = (
        F.when(F.col("o_custkey") % 10 == 8, F.substr(whole, F.lit(1), F.length(whole) - 1))
        .when(F.col("o_custkey") % 10 == 9, F.concat(F.lit("["), whole, F.lit("]")))
        .otherwise(whole)
    )
    path = F.concat("project_id", F.lit("/imp_"), customer, F.lit(".json"))
    return files.select(path.alias("relative_path"), text.cast("binary").alias("content"))


_READABLE = "o_custkey % 10 < 8"


def _states(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    root = filetree.local_root(new_path(spark, "states"))
    write_tree(_state_rows(spark, sf_dir), root)
    return imports.read_import_states(spark, root)


@query(
    "read_import_states",
    f"""SELECT DISTINCT {_STATE_OWNER} AS project_id, 'imp_' || o_custkey AS import_id,
        '/data' AS source, 'yolo' AS format, o_custkey % 2 = 0 AS completed
      FROM orders WHERE {_READABLE}""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    header, _files = _states(spark, sf_dir)
    return header.select("project_id", "import_id", "source", "format", "completed")


@query(
    "read_import_files",
    f"""SELECT {_STATE_OWNER} AS project_id, 'imp_' || o_custkey AS import_id,
        'images/' || o_orderkey || '.jpg' AS relative_path,
        CASE WHEN o_orderkey % 23 <> 0 THEN o_orderkey % 2 = 0 END AS uploaded,
        CASE WHEN o_orderkey % 23 <> 0 THEN o_orderkey % 4 = 0 END AS streamed,
        CASE WHEN o_orderkey % 23 <> 0 THEN o_orderkey END AS size_bytes
      FROM orders WHERE {_READABLE}""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    _header, files = _states(spark, sf_dir)
    return files.select(
        "project_id", "import_id", "relative_path", "uploaded", "streamed", "size_bytes"
    )


@query(
    "read_server_imports",
    """SELECT CASE WHEN o_custkey % 3 = 0 THEN 'proj_0' ELSE 'proj_1' END AS project_id,
        'imp_' || o_orderkey AS import_id, o_orderstatus AS status, o_orderkey AS file_count,
        o_orderpriority AS phase FROM orders""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    entry = F.struct(
        F.concat(F.lit("imp_"), F.col("o_orderkey").cast("string")).alias("import_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("file_count"),
        F.struct(F.col("o_orderpriority").alias("phase"), F.lit(1).alias("other")).alias("progress"),
    )
    owner = F.expr(_STATE_OWNER).alias("project_id")
    page = F.expr("o_orderkey div 100").alias("page")
    # Each entry also stands on the page before, with a status of its own: the later page counts.
    on_page = orders.select("*", owner, page)
    earlier = on_page.where("page > 0").withColumns({"page": F.col("page") - 1, "o_orderstatus": F.lit("stale")})
    pages = on_page.unionByName(earlier).groupBy("project_id", "page").agg(
        F.concat(
            F.lit('{"imports":[7,'),
            F.array_join(F.collect_list(F.to_json(entry)), ","),
            F.lit(',"text"],"next_cursor":"c"}'),
        ).alias("text")
    )
    path = F.concat("project_id", F.lit("/page-"), F.col("page").cast("string"), F.lit(".json"))
    root = filetree.local_root(new_path(spark, "listings"))
    write_tree(pages.select(path.alias("relative_path"), F.col("text").cast("binary").alias("content")), root)
    listed = import_operators.latest_server_imports(imports.read_server_imports(spark, root))
    return listed.select(
        "project_id", "import_id", "status", "file_count", F.col("progress.phase").alias("phase")
    )


@query("write_manifest", "SELECT dataset_id, relative_path, size_bytes FROM v_files")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = view(spark, sf_dir, "v_files").select("dataset_id", "relative_path", "size_bytes")
    path = new_path(spark, "manifests")
    writers.write_manifest(files, path, "json")
    return spark.read.schema(files.schema).json(path)


@query(
    "write_import_state",
    """SELECT CASE WHEN l_orderkey % 3 = 0 THEN 'proj_0' ELSE 'proj_1' END AS project_id,
        CASE l_suppkey % 20 WHEN 6 THEN '' ELSE 'imp_' || l_suppkey % 20 END AS import_id,
        count(*) AS total_files,
        count(*) FILTER (l_returnflag <> 'N' AND l_suppkey % 2 = 1) AS uploaded_files,
        0::BIGINT AS streamed_files
      FROM lineitem GROUP BY 1, 2""",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    owner = F.when(F.col("l_orderkey") % 3 == 0, "proj_0").otherwise("proj_1")
    lines = table(spark, sf_dir, "lineitem").select(
        owner.alias("project_id"),
        F.when(F.col("l_suppkey") % 20 == 6, "")
        .otherwise(F.concat(F.lit("imp_"), (F.col("l_suppkey") % 20).cast("string")))
        .alias("import_id"),
        (F.col("l_returnflag") != "N").alias("uploaded"),
        F.lit(False).alias("streamed"),
    )
    path = new_path(spark, "import_state")
    writers.write_import_state(lines, path)
    even = lines.where(F.col("import_id").rlike("^$|[02468]$"))
    writers.write_import_state(even.withColumn("uploaded", F.lit(False)), path)
    writers.fold_import_state(spark, path, lines.schema)
    writers.write_import_state(even.where("import_id = ''").withColumn("uploaded", F.lit(False)), path)
    return import_operators.import_state_counts(writers.read_import_state(spark, path, lines.schema))
