"""Readers and writers besides plain tables."""

from __future__ import annotations

import atexit
import io
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


_made: list[tuple[SparkSession, str]] = []


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder that driver and executors share, deleted when the process
    ends; only a session on this machine may go without spark.checkpoint.dir."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="folioflow-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def _release() -> None:
    while _made:
        spark, path = _made.pop()
        if spark.sparkContext._jsc is not None:  # not stopped
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


atexit.register(_release)


def read_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, length, modificationTime and content of files."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)


def file_kind(content) -> F.Column:
    """"pdf", "html" or "unknown" by the first bytes."""
    head = F.substring(content, 1, 512)
    text = F.lower(F.decode(head, "ISO-8859-1"))
    return F.when(F.substring(content, 1, 4) == F.lit(b"%PDF"), "pdf").when(text.contains("<html") | text.contains("<!doctype"), "html").otherwise("unknown")


def read_results(spark: SparkSession, folders: list[str], schema: StructType | str) -> DataFrame:
    """JSON results of several folders; a file name (or a folder ``stem=...`` in
    its place) in a later folder wins."""
    out = None
    for rank, folder in enumerate(folders):
        one = spark.read.schema(schema).option("recursiveFileLookup", "true").json(folder, multiLine=True).withColumn("__stem", F.regexp_extract(F.input_file_name(), r"(?:/stem=([^/]+)/[^/]+|/([^/]+)\.json)$", 0)).withColumn("__rank", F.lit(rank))
        one = one.withColumn("__stem", F.regexp_replace("__stem", r"^/(?:stem=)?|(?<=[^/])/.*$|\.json$", ""))
        out = one if out is None else out.unionByName(one)
    top = out.groupBy("__stem").agg(F.max("__rank").alias("__rank"))
    return out.join(top, ["__stem", "__rank"]).withColumnRenamed("__stem", "stem").drop("__rank")


def completed_keys(spark: SparkSession, path: str, event: str = "doc_done") -> DataFrame:
    """Keys that a JSON-lines run log reports as done; bad lines are skipped."""
    log = spark.read.schema("event string, slug string, ts string").option("mode", "DROPMALFORMED").json(path)
    return log.where((F.col("event") == event) & F.col("slug").isNotNull()).select("slug").distinct()


def read_worklist(spark: SparkSession, path: str, schema: str = "slug string, url string, in_db string") -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct lower-case words of a list; lines that start with # are notes."""
    w = F.lower(F.trim("value"))
    return spark.read.text(path).where((w != "") & ~w.startswith("#")).select(w.alias("word")).distinct()


def export_metadata(rows: DataFrame, path: str, columns: list[str], kind: str = "json") -> None:
    out = rows.select(*columns).write.mode("overwrite")
    (out.option("header", "true").csv if kind == "csv" else out.json)(path)


def export_texts(pages: DataFrame, path: str, doc: str, page: str, separator: str = "\n\n--- PAGE BREAK ---\n\n") -> None:
    """One record per complete document: its pages in order."""
    joined_pages(pages, doc, page, separator).select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def joined_pages(pages: DataFrame, doc: str, page: str, separator: str = "\n\n--- PAGE BREAK ---\n\n") -> DataFrame:
    """doc and text of documents none of whose pages lacks a text."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(page).alias("p"), F.col("text").alias("t"))))
    both = pages.groupBy(doc).agg(ordered.alias("x"), F.count("text").alias("n"), F.count(F.lit(1)).alias("all"))
    return both.where("n = all").select(doc, F.array_join(F.transform("x", lambda v: v["t"]), separator).alias("text"))


def export_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").option("header", "true").csv(f"{path}/nodes")
    edges.write.mode("overwrite").option("header", "true").csv(f"{path}/relationships")


def append_facts(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def replace_table(rows: DataFrame, path: str) -> None:
    """Write beside the table and swap: readers see the old rows or the new, and
    ``rows`` may come from the table itself."""
    spark = rows.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    staged, old = (jvm.org.apache.hadoop.fs.Path(f"{path}.{kind}-{uuid.uuid4().hex}") for kind in ("new", "old"))
    rows.write.parquet(staged.toString())
    if fs.exists(target):
        fs.rename(target, old)
    fs.rename(staged, target)
    fs.delete(old, True)


def failed_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a JSON-lines report whose status is "fail"; bad lines are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path).where(F.lower("status") == "fail")


def markdown(rows: DataFrame, title: str, fields: list[str], body: str) -> DataFrame:
    """rows with ``note``: front matter of the fields that are there, the title as
    heading, and the body."""
    front = F.concat_ws("\n", *[F.concat(F.lit(f"{f}: "), F.col(f).cast("string")) for f in fields])
    return rows.withColumn("note", F.concat(F.lit("---\n"), front, F.lit("\n---\n\n# "), F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit(""))))


def export_markdown(rows: DataFrame, path: str, folder: str) -> None:
    """One JSON record (slug, note) per document, a folder for each value of ``folder``."""
    rows.select(folder, "slug", "note").write.mode("overwrite").partitionBy(folder).json(path)


def export_pack(rows: DataFrame, path: str, by: str) -> None:
    """A sample as JSON and CSV, and its counts."""
    rows.write.mode("overwrite").json(f"{path}/json")
    rows.write.mode("overwrite").option("header", "true").csv(f"{path}/csv")
    rows.groupBy(by).agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").json(f"{path}/stats")


def committed(change: Callable[[], DataFrame], path: str) -> bool:
    """Replace the table by what ``change`` returns, all of it or nothing: if the
    change fails while it is computed, the old rows stay and False is returned."""
    from pyspark.errors import PySparkException

    try:
        replace_table(change(), path)
    except PySparkException:
        return False
    return True


_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


def _blocks_of_docx(content: bytes) -> list[tuple[str, str]]:
    """Paragraphs and tables (rows by \\n, cells by |) of a word file in order."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        body = ElementTree.fromstring(z.read("word/document.xml")).find(f"{_W}body")
    said = lambda e: "".join(t.text or "" for t in e.iter(f"{_W}t"))
    out = []
    for e in body if body is not None else []:
        if e.tag == f"{_W}p" and said(e).strip():
            out.append(("paragraph", said(e)))
        elif e.tag == f"{_W}tbl":
            out.append(("table", "\n".join("|".join(said(c) for c in r.iter(f"{_W}tc")) for r in e.iter(f"{_W}tr"))))
    return out


def docx_blocks(files: DataFrame, key: str) -> DataFrame:
    """key, at, kind and text of the blocks of word files in column ``content``;
    a file that is none gives no rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if content and zipfile.is_zipfile(io.BytesIO(content)):
                    rows += [(name, i, kind, text) for i, (kind, text) in enumerate(_blocks_of_docx(content))]
            columns = list(zip(*rows, strict=True)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.string()), strict=True)], [key, "at", "kind", "text"])

    return files.select(F.col(key).cast("string"), "content").mapInArrow(run, f"{key} string, at int, kind string, text string")
