"""The column functions under one name, and their registration for SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from inkspan.operators import corpus, quality, records, vocabulary
from inkspan.text import clean, metrics, segments

COLUMN_FUNCTIONS = {
    "clean_tier1": clean.clean_tier1, "clean_eval": clean.clean_eval, "clean_flat": clean.clean_flat, "segments": segments.segments, "sentences": segments.sentences,
    "packed_sentences": segments.packed_sentences, "chunks": segments.chunks, "keyword_score": segments.keyword_score, "anomaly_rate": metrics.anomaly_rate, "symbol_rate": metrics.symbol_rate,
    "non_alpha_rate": metrics.non_alpha_rate, "short_rate": metrics.short_rate, "composite": metrics.composite, "cer": quality.cer, "wer": quality.wer, "era": corpus.era,
    "token_estimate": corpus.token_estimate, "short_id": records.short_id, "year_of": records.year_of, "day_of": records.day_of, "image_url": records.image_url, "edtf_date": records.edtf_date,
    "trimmed": vocabulary.trimmed,
}

#: Functions of one text that SQL gets by name; those with lambdas have no SQL text and stay with the column API.
_SQL = {
    "clean_tier1": ("string", clean.clean_tier1), "clean_eval": ("string", clean.clean_eval), "clean_flat": ("string", clean.clean_flat), "anomaly_rate": ("double", metrics.anomaly_rate),
    "symbol_rate": ("double", metrics.symbol_rate), "token_estimate": ("int", corpus.token_estimate),
    "short_id": ("string", records.short_id), "image_url": ("string", records.image_url),
}


def register(spark: SparkSession, prefix: str = "") -> list[str]:
    """Temporary SQL functions of the same names. They are SQL expressions, not Python: Spark inlines them."""
    names = []
    for name, (kind, f) in _SQL.items():
        body = spark.range(1).select(F.lit("x").alias("t"))
        sql = body.select(f("t"))._jdf.queryExecution().analyzed().projectList().head().child().sql()
        sql = sql.replace("__auto_generated_subquery_name.", "")
        spark.sql(f"create or replace temporary function {prefix}{name}(t string) returns {kind} return {sql}")
        names.append(prefix + name)
    return names
