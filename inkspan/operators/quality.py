"""Quality of texts: scores by document, statistics by corpus, cleaning stages against each other."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from inkspan.session import ship_package
from inkspan.text.classes import NOT_WS, c, rounded, text_of, tokens
from inkspan.text.metrics import METRICS, with_scores

#: Rates have four digits; sums of them are made of whole ten-thousandths, so they don't depend on the order.
SCALE = 10_000


def score_documents(df: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    return with_scores(df, keep, text_col)


def long_form(scores: DataFrame, keep: list[str], metrics: list[str]) -> DataFrame:
    """(keep, metric, value)."""
    pairs = ", ".join(f"'{m}', `{m}`" for m in metrics)
    return scores.select(*keep, F.expr(f"stack({len(metrics)}, {pairs}) as (metric, value)"))


def corpus_statistics(long: DataFrame, by: list[str]) -> DataFrame:
    """(by, metric, n, mean, std, p10, p50, p90) of values with four digits: population deviation, interpolated
    percentiles. A metric has at most SCALE + 1 different values, so exact percentiles need little memory."""
    v = F.floor(F.col("value") * SCALE + 0.5).cast("bigint")
    sums = long.select(*by, "metric", v.alias("v")).groupBy(*by, "metric").agg(
        F.count("v").alias("n"), F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"), F.percentile("v", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("p")
    )
    mean = F.col("s") / F.col("n")
    std = F.sqrt(F.greatest(F.lit(0.0), F.col("q") / F.col("n") - mean * mean))
    at = lambda k: rounded(F.get("p", F.lit(k)) / SCALE)
    return sums.select(*by, "metric", "n", rounded(mean / SCALE).alias("mean"), rounded(std / SCALE).alias("std"), at(0).alias("p10"), at(1).alias("p50"), at(2).alias("p90"))


def delta(raw: DataFrame, cleaned: DataFrame, by: list[str]) -> DataFrame:
    """(by, metric, delta): gain of the cleaned corpus, of the rounded means; rates fall, the composite rises."""
    joined = raw.select(*by, "metric", F.col("mean").alias("a")).join(cleaned.select(*by, "metric", F.col("mean").alias("b")), [*by, "metric"])
    gain = F.when(F.col("metric") == "composite_score", F.col("b") - F.col("a")).otherwise(F.col("a") - F.col("b"))
    return joined.select(*by, "metric", rounded(gain).alias("delta"))


def present_tiers(df: DataFrame, tiers: dict[str, str]) -> DataFrame:
    """(tier, present): whether any record has a text of the tier. One pass over all tiers."""
    has = df.agg(*[F.coalesce(F.max(F.length(c(col)) > 0), F.lit(False)).alias(t) for t, col in tiers.items()])
    pairs = ", ".join(f"'{t}', `{t}`" for t in tiers)
    return has.select(F.expr(f"stack({len(tiers)}, {pairs}) as (tier, present)"))


def tier_texts(df: DataFrame, tiers: dict[str, Column], keep: list[str]) -> DataFrame:
    """(keep, tier, text): the texts of all tiers below one another, empty ones left out."""
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("tier"), text_of(x).alias("text")) for t, x in tiers.items()]))
    return df.select(*keep, each.alias("t")).select(*keep, "t.tier", "t.text").where("text <> ''")


def counters(df: DataFrame, text_col: str) -> DataFrame:
    """(total, evaluated, skipped)."""
    full = F.length(text_of(text_col)) > 0
    return df.agg(F.count("*").alias("total"), F.count_if(full).alias("evaluated"), F.count_if(~full).alias("skipped"))


def histogram(long: DataFrame, by: list[str], bins: int = 30) -> DataFrame:
    """(by, metric, bin, n): rates in equal bins of [0, 1], the last one closed."""
    k = F.least(F.lit(bins - 1), F.floor(F.col("value") * bins)).cast("int")
    return long.groupBy(*by, "metric", k.alias("bin")).agg(F.count("*").alias("n"))


# -- against reference texts -----------------------------------------------------------------------------------------


def edits(a: Sequence, b: Sequence) -> int:
    """Edit distance of two texts or lists of words of any length: one column of the matrix in each step, its differences
    as the bits of two numbers (Myers, Hyyrö). What both begin and end with is left out before."""
    if len(a) < len(b):
        a, b = b, a
    start, end = 0, len(b)
    while start < end and a[start] == b[start]:
        start += 1
    while end > start and a[end - 1 + len(a) - len(b)] == b[end - 1]:
        end -= 1
    a, b = a[start : end + len(a) - len(b)], b[start:end]
    if not b:
        return len(a)
    at: dict = {}
    for k, x in enumerate(a):
        at.setdefault(x, []).append(k)
    often: dict = {}
    full = (1 << len(a)) - 1
    up, down = full, 0
    for block in range(0, len(b), 64):
        for x in b[block : block + 64]:
            equal = often.get(x)
            if equal is None:
                bits = bytearray((len(a) + 7) // 8)
                for k in at.get(x, ()):
                    bits[k >> 3] |= 1 << (k & 7)
                equal = int.from_bytes(bits, "little")
                if len(at.get(x, ())) > 8:  # others are cheap to make and would be many
                    often[x] = equal
            same = ((equal & up) + up ^ up) | equal | down
            rises = (down | full ^ (same | up)) << 1 | 1
            up, down = (up & same) << 1 | full ^ (same | rises), rises & same
        up, down = up & full, down & full  # bits above have no effect on those below
    return len(b) + up.bit_count() - down.bit_count()


@F.pandas_udf(LongType())
def _char_edits(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([edits(x, y) for x, y in zip(a, b, strict=True)], dtype="int64")


@F.pandas_udf(LongType())
def _line_edits(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([edits(x.split("\n") if x else [], y.split("\n") if y else []) for x, y in zip(a, b, strict=True)], dtype="int64")


def cer(hypothesis, reference) -> Column:
    """Edits per character of the reference, four digits; null where that is empty."""
    ship_package(SparkSession.active())
    h, r = text_of(hypothesis), text_of(reference)
    return F.when(F.length(r) > 0, rounded(_char_edits(r, h) / F.length(r)))


def wer(hypothesis, reference) -> Column:
    """Edits per word of the reference, four digits; null where that has none."""
    ship_package(SparkSession.active())
    h, r = tokens(hypothesis), tokens(reference)
    return F.when(F.size(r) > 0, rounded(_line_edits(F.array_join(r, "\n"), F.array_join(h, "\n")) / F.size(r)))


def evaluate(ocr: DataFrame, truth: DataFrame, key: str, cleaned: DataFrame | None = None) -> DataFrame:
    """(key, stage, metrics, cer, wer) of the texts and, where there are such, of their cleaned forms. Texts without
    a reference have the metrics alone; cleaned texts without an original don't count. All frames: key, text."""
    ref = truth.select(key, F.col("text").alias("reference"))
    stages = ocr.select(key, F.lit("raw").alias("stage"), "text")
    if cleaned is not None:
        stages = stages.unionByName(cleaned.join(ocr.select(key), key, "left_semi").select(key, F.lit("cleaned").alias("stage"), "text"))
    joined = stages.join(ref, key, "left")
    has = F.col("reference").isNotNull()
    compared = [F.when(has, cer("text", "reference")).alias("cer"), F.when(has, wer("text", "reference")).alias("wer")]
    return with_scores(joined, [key, "stage", *compared], "text").select(key, "stage", *METRICS, "cer", "wer")


def token_total(text_col: str) -> Column:
    return F.regexp_count(text_of(text_col), F.lit(f"{NOT_WS}+"))
