"""Writers: JSON lines, partitioned tables, reports."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.operators.records import day_of, year_of


def write_jsonl(df: DataFrame, path: str, append: bool = False, single: bool = False) -> None:
    """JSON lines, non-ASCII characters as they are, nulls kept. single: one file, for small results only."""
    out = df.coalesce(1) if single else df
    out.write.mode("append" if append else "overwrite").option("ignoreNullFields", False).json(path)


def append_by_year(df: DataFrame, path: str, salts: int = 8) -> None:
    """Records below ``year=``; rows of a year are brought together into ``salts`` files at most, so that a year with very
    many rows, such as 0 of the undated ones, is no single task."""
    salt = F.pmod(F.xxhash64("record_id"), F.lit(salts))
    df.withColumn("year_part", year_of()).repartition("year_part", salt).write.mode("append").partitionBy("year_part").parquet(path)


def write_by_day(df: DataFrame, path: str, salts: int = 8) -> None:
    """Records below ``year=/date=``, days without a date together as ``unknown``; only days that occur are replaced.

    Days that hold very many rows, as that of the undated may, are spread over ``salts`` files.
    """
    parts = df.withColumn("year_part", year_of()).withColumn("date_part", day_of())
    salt = F.when(F.col("date_part") == "unknown", F.pmod(F.xxhash64("record_id"), F.lit(salts))).otherwise(F.lit(0))
    spread = parts.repartition("year_part", "date_part", salt)
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year_part", "date_part").parquet(path)


def write_texts(df: DataFrame, id_col: str, text_col: str, folder: str) -> int:
    """One file ``<id>.txt`` for each row below a folder that all executors reach, and how many were written. Ids are
    file names; a null text is an empty file; of rows with the same id one remains."""

    def run(batches):
        from pyarrow import fs

        if folder.startswith("file:") or "://" not in folder:
            system, root = fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
        else:
            system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with system.open_output_stream(f"{root}/{key}.txt") as f:
                    f.write((text or "").encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]}, schema=pa.schema([("n", pa.int64())]))

    rows = df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0


def write_articles(df: DataFrame, path: str) -> None:
    """Articles below ``period=/year=``, ``unknown`` where there is no year."""
    year = F.coalesce(F.get("year", F.lit(0)).cast("string"), F.lit("unknown"))
    df.withColumn("period_part", F.col("period")).withColumn("year_part", year).write.mode("append").partitionBy("period_part", "year_part").parquet(path)


def write_report(df: DataFrame, path: str, limit: int = 100_000) -> None:
    """A small table as one indented JSON file, on any file system; larger ones raise, as they belong into write_jsonl."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows are no report")
    sc = df.sparkSession.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    out = p.getFileSystem(sc._jsc.hadoopConfiguration()).create(p, True)
    out.write(bytearray(json.dumps([r.asDict(recursive=True) for r in rows], indent=2, ensure_ascii=False, default=str).encode()))
    out.close()


def export_summary(counts: DataFrame, pairs: DataFrame, order: str, samples: int = 5, width: int = 80) -> str:
    """The export's summary as text: counts by dimension, then the first pairs, shortened."""
    lines = ["Questions and answers", "=" * 50]
    for r in counts.orderBy("dimension", F.desc("n"), "value").collect():
        lines.append(f"{r.dimension:<12} {r.value:<20} {r.n}")
    for r in pairs.orderBy(order).select(F.substring("question", 1, width).alias("q"), F.substring("answer", 1, width).alias("a")).limit(samples).collect():
        lines += ["", f"Q: {r.q}", f"A: {r.a}"]
    return "\n".join(lines)
