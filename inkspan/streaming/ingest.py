"""Resumable ingestion: a landing folder read as a stream, with checkpoints instead of lists of processed ids."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener
from pyspark.sql.types import StructType

from inkspan.operators.records import day_of, year_of


def shared_folder(spark: SparkSession) -> str:
    """A new folder that all executors share: below spark.checkpoint.dir, or a temporary one of a local session."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/inkspan-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="inkspan-stream-")


def landing(spark: SparkSession, path: str, schema: StructType, form: str = "json", files: int = 100, pattern: str | None = None) -> DataFrame:
    """Files of a folder as a stream, at most ``files`` of them in each batch."""
    reader = spark.readStream.schema(schema).format(form).option("maxFilesPerTrigger", files)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(path)


def run_available(stream: DataFrame, target: str, checkpoint: str, partition_by: list[str] = (), form: str = "parquet") -> None:
    """Processes what is there and ends. What a checkpoint knows isn't processed again, and a batch that was written
    before a crash isn't written twice: the sink's log makes a batch's files visible once."""
    writer = stream.writeStream.format(form).option("checkpointLocation", checkpoint).option("path", target).outputMode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).trigger(availableNow=True).start().awaitTermination()


def file_stream(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """A table of files, or a single file, as a stream."""
    schema = spark.read.format(form).load(path).schema
    reader = spark.readStream.schema(schema).format(form)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    # a stream's source is a folder: of a single file, the one that holds it
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isFile():
        parent, _, name = path.rpartition("/")
        return reader.option("pathGlobFilter", name).load(parent)
    return reader.load(path)


def ingest_all(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """A table of files, passed through a stream with checkpoints into a new table."""
    folder = shared_folder(spark)
    run_available(file_stream(spark, path, form), f"{folder}/table", f"{folder}/log")
    return spark.read.parquet(f"{folder}/table")


def by_day(stream: DataFrame) -> DataFrame:
    """Records with the year and date that their files are partitioned by."""
    return stream.withColumn("year_part", year_of()).withColumn("date_part", day_of())


def log_batches(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Appends each batch to ``target`` below its number. A batch that is repeated replaces itself, so nothing counts
    twice; no batch reads or rewrites what is there."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def current(spark: SparkSession, target: str, key: str, order: str) -> DataFrame:
    """One row for each key of a log of batches: the first by ``order``, combined within partitions before the shuffle."""
    rows = spark.read.option("basePath", target).parquet(target).drop("batch")
    return rows.groupBy(key).agg(F.min_by(F.struct("*"), order).alias("r")).select("r.*")


def compact(spark: SparkSession, target: str, into: str, key: str, order: str) -> None:
    """Writes the current rows of a log as batch 0 of a new one, for readers that would else go over many batches."""
    current(spark, target, key, order).write.mode("overwrite").parquet(f"{into}/batch=0")


def _marked(rows: DataFrame, time_col: str, late: str | None) -> DataFrame:
    """With a watermark, if given; that needs times of a zone, the session's."""
    return rows.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, late) if late else rows


def hourly(stream: DataFrame, time_col: str = "ts", key: str = "event_type", late: str = "2 hours") -> DataFrame:
    """Counts by key and hour; rows later than the watermark are left out."""
    counted = _marked(stream, time_col, late).groupBy(key, F.window(time_col, "1 hour").alias("w")).agg(F.count("*").alias("events"))
    return counted.select(key, F.col("w.start").cast(stream.schema[time_col].dataType).alias("start"), "events")


def deduplicated(stream: DataFrame, key: str, time_col: str, within: str = "1 day") -> DataFrame:
    """The first row of each key within a span of event time; the state of older keys is dropped."""
    return _marked(stream, time_col, within).dropDuplicatesWithinWatermark([key])


def sliding(df: DataFrame, time_col: str = "ts", key: str = "event_type", length: str = "1 hour", step: str = "15 minutes", late: str | None = None) -> DataFrame:
    """Counts by key and overlapping windows, of a table or, with ``late``, of a stream."""
    rows, kind = _marked(df, time_col, late), df.schema[time_col].dataType
    return rows.groupBy(key, F.window(time_col, length, step).alias("w")).agg(F.count("*").alias("events")).select(key, F.col("w.start").cast(kind).alias("start"), "events")


def sessions(df: DataFrame, time_col: str = "ts", key: str = "user_id", gap: str = "30 minutes", late: str | None = None) -> DataFrame:
    """(key, start, end, events) of the sessions of each key: rows with less than ``gap`` between them."""
    rows, kind = _marked(df, time_col, late), df.schema[time_col].dataType
    found = rows.groupBy(key, F.session_window(time_col, gap).alias("w")).agg(F.count("*").alias("events"))
    return found.select(key, F.col("w.start").cast(kind).alias("start"), F.col("w.end").cast(kind).alias("end"), "events")


def joined_streams(left: DataFrame, right: DataFrame, key: str, time_col: str, within: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows of two streams with the same key, the right one at most ``within`` later; state older than that is dropped."""
    a, b = _marked(left, time_col, late).alias("a"), _marked(right, time_col, late).alias("b")
    span = F.expr(f"b.`{time_col}` between a.`{time_col}` and a.`{time_col}` + interval {within}")
    return a.join(b, (F.col(f"a.`{key}`") == F.col(f"b.`{key}`")) & span)


def run_windows(spark: SparkSession, path: str, windows, form: str = "parquet") -> DataFrame:
    """What a windowed query over a folder's stream has given when the stream is at its end: the windows that the
    watermark has closed."""
    folder = shared_folder(spark)
    run_available(windows(file_stream(spark, path, form)), f"{folder}/table", f"{folder}/log")
    return spark.read.parquet(f"{folder}/table")


class Progress(StreamingQueryListener):
    """Collects rows and rate of each batch."""

    def __init__(self):
        self.batches: list[tuple[int, int, float]] = []

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.batches.append((p.batchId, p.numInputRows, p.processedRowsPerSecond))

    def onQueryTerminated(self, event):
        pass
