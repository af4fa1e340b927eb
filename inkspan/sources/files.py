"""Readers of files. All take explicit schemas: empty arrays would otherwise be read as strings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from inkspan.operators.articles import numbered
from inkspan.operators.records import image_mime
from inkspan.session import cut_lineage


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(p)
    return found is not None and len(found) > 0


def read_json(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Whole-file JSON, one row for a file's object or for each element of its list; no rows where there is no file."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def read_records(spark: SparkSession, path: str, record: StructType, envelope: StructType | None = None) -> DataFrame:
    """Records of files that are an envelope with ``records`` or a bare list of records, the envelope's fields beside.

    Both shapes may stand side by side. Records that are no list raise.
    """
    fields = [f for f in (envelope or StructType([])).fields if f.name not in record.fieldNames()]
    schema = StructType([*fields, *record.fields, StructField("records", ArrayType(record))])
    rows = read_json(spark, path, schema)
    names = [f.name for f in fields]
    # an element of a bare list has the record's own fields and no list
    wrapped = rows.where("records is not null").select(*names, F.explode("records").alias("r")).select(*names, "r.*")
    own = F.coalesce(*[F.col(f"`{n}`").isNotNull() for n in record.fieldNames()][:1], F.lit(False))
    for n in record.fieldNames()[1:]:
        own = own | F.col(f"`{n}`").isNotNull()
    for n in names:  # an envelope without records is no record, though it may have fields of that name
        own = own & F.col(f"`{n}`").isNull()
    return wrapped.unionByName(rows.where(F.col("records").isNull() & own).select(*names, *record.fieldNames()))


def read_jsonl(spark: SparkSession, path: str, schema: StructType, strict: bool = True) -> DataFrame:
    """JSON lines. strict: a malformed line raises; else such lines are kept in column ``_corrupt`` for counting.
    Blank lines never count."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    wide = StructType([*schema.fields, StructField("_corrupt", StringType())])
    return spark.read.schema(wide).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no bigint, line) of the lines of all files, numbered from 1 in the order of the files' names and of the lines
    in them."""
    found = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    # within a block of a file the scan's order is that of the lines
    placed = cut_lineage(found.withColumn("at", F.struct("file_path", "file_block_start", F.monotonically_increasing_id().alias("k"))).select("at", F.col("value").alias("line")))
    return numbered(placed, "at").select((F.col("n") + 1).cast("bigint").alias("line_no"), "line")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, text) of the .txt files of a folder, the suffix in any case; undecodable bytes become U+FFFD."""
    raw = spark.read.option("wholetext", True).option("pathGlobFilter", "*.[tT][xX][tT]").text(path)
    name = F.regexp_replace(F.col("_metadata.file_name"), r"(?i)\.txt$", "")
    return raw.select(F.url_decode(name).alias("doc_id"), F.make_valid_utf8("value").alias("text"))


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """(path, mime, content, base64) of a folder's images."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return raw.select("path", image_mime("path").alias("mime"), "content", F.base64("content").alias("base64"))


def read_ocr_pages(spark: SparkSession, path: str) -> DataFrame:
    """(ark_id, page_no, content): page images kept as ``<ark_id>/page_0001.jpg``."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "page_*").load(path)
    parts = F.split("path", "/")
    return raw.select(F.get(parts, F.size(parts) - 2).alias("ark_id"), F.regexp_extract("path", r"page_(\d+)", 1).cast("int").alias("page_no"), "content")


def discover(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, length) of the files below root whose name fits the regular expression."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length")
    return listed.where(F.element_at(F.split("path", "/"), -1).rlike(pattern))


def year_files(spark: SparkSession, root: str) -> DataFrame:
    """(path, length, collection, year) of files named by a year in the folders of collections."""
    parts = F.split("path", "/")
    return discover(spark, root, r"^\d{4}\.json$").select("path", "length", F.get(parts, F.size(parts) - 2).alias("collection"), F.regexp_extract("path", r"(\d{4})\.json$", 1).cast("int").alias("year"))


__all__ = ["discover", "read_images", "read_json", "read_jsonl", "read_lines", "read_ocr_pages", "read_records", "read_texts", "year_files"]
