"""Lines that one source repeats in many of its documents, found as frequent sequences of line identifiers."""

from __future__ import annotations

from functools import reduce
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspan.llm.quality import PAGE_BREAK
from inkspan.session import cut_lineage, ship_package

#: A line that is only a page number, in lower case: digits, or a Roman numeral, which no word is.
PAGE_ONLY = r"^[^\p{L}]*(?:(?:page|pag|pág|p|seite|página|no)[^\p{L}]*)?(?:(?=[ivxlc])c{0,3}(?:x[cl]|l?x{0,3})(?:i[xv]|v?i{0,3})[^\p{L}]*)?$"
#: Wordings are candidates from this part of the support on, as misread copies are counted only then. Of a line of n letters,
#: (1 - r) ** n of the copies are exact at a rate r of misread letters: 0.13 of those of 200 letters at 0.01.
CANDIDATE_SHARE = 0.125
#: Letters of a segment by which copies of a wording are looked up; rows of a table small enough to be broadcast.
SEGMENT, SHORT_SEGMENT, BROADCAST_ROWS = 6, 4, 200_000


def _sources(df: DataFrame, id_col: str, text_col: str, source_col: str, record_col: str) -> DataFrame:
    record = F.coalesce(F.col(f"`{record_col}`").cast("string"), F.concat(F.lit("row:"), F.col(f"`{id_col}`").cast("string")))
    return df.select(
        F.col(f"`{id_col}`").alias("doc"), F.coalesce(F.col(f"`{source_col}`"), F.lit("")).alias("source"),
        F.xxhash64(record).alias("record"), F.col(f"`{text_col}`").alias("text"),
    )


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc, source, record, line_no, key): the lines that have a wording; the key is their letters in lower case."""
    low = F.lower("line")
    return (
        docs.select("doc", "source", "record", F.posexplode(F.split("text", "\n")).alias("at", "line"))
        .where(~F.trim("line").isin("", PAGE_BREAK))
        .select("doc", "source", "record", (F.col("at") + 1).alias("line_no"), low.alias("low"), F.regexp_replace(low, r"[^\p{L}]+", "").alias("key"))
        .where((F.length("key") > 12) | (F.length("key") > 0) & ~F.col("low").rlike(PAGE_ONLY))
        .drop("low")
    )


def _tolerance(n: Column) -> Column:
    """Edits by which a copy of a wording of n letters may differ."""
    return F.when(n < 8, 0).when(n < 18, 1).when(n < 30, 2).otherwise(3)


def _segments(key: Column, either: bool) -> Column:
    """Hashes of segments, one of which is whole in every copy that differs by few edits, as there is one more of them than
    edits: the first and the last letters, and one or two in the middle, which in a copy (``either``) may be shifted."""
    n = F.length(key)
    long, short = F.lit(SEGMENT), F.lit(SHORT_SEGMENT)

    def tag(kind: int, x: Column) -> Column:
        return F.xxhash64(F.col("source"), F.lit(kind), x)

    def middle(kind: int, at: int) -> list[Column]:
        shifts = range(-3, 4) if either else (0,)
        return [tag(kind, F.substring(key, F.greatest(F.lit(1), F.floor(n / 2).cast("int") + at + s), long)) for s in shifts]

    # copies of different length fall on both sides of a bound: near it, they have both kinds
    ends_short = [tag(3, F.substring(key, F.lit(1), short)), tag(4, F.substring(key, n - SHORT_SEGMENT + 1, short))]
    ends = [tag(0, F.substring(key, F.lit(1), long)), tag(1, F.substring(key, n - SEGMENT + 1, long))]
    one, two = middle(2, -2), [*middle(6, -SEGMENT), *middle(7, 1)]
    exact = F.array(tag(5, key))
    if not either:
        return F.when(n < 8, exact).when(n < 18, F.array(*ends_short)).when(n < 30, F.array(*ends, *one)).otherwise(F.array(*ends, *two))
    return (
        F.when(n < 7, exact).when(n < 9, F.array(tag(5, key), *ends_short)).when(n < 15, F.array(*ends_short))
        .when(n < 21, F.array(*ends_short, *ends, *one)).when(n < 27, F.array(*ends, *one)).when(n < 33, F.array(*ends, *one, *two)).otherwise(F.array(*ends, *two))
    )


def frequent_wordings(df: DataFrame, id_col: str, text_col: str, source_col: str, record_col: str, min_records: int = 4, min_share: float = 0.08):
    """(frequent, occurrences): the wordings with sufficient support, and every line that has one of them.

    frequent: source, wording (an identifier), key, support, records. occurrences: doc, source, record, line_no,
    wording. Support counts distinct records whose line equals the wording but for a misread character or two.
    Counting is keyed by wording, so a source that holds a third of the rows is spread over all tasks.
    """
    docs = _sources(df, id_col, text_col, source_col, record_col)
    lines = lines_of(docs)
    least = F.greatest(F.lit(min_records), F.ceil(F.col("records") * min_share))
    records = docs.groupBy("source").agg(F.countDistinct("record").alias("records"))
    counted = lines.groupBy("source", "key").agg(F.count("*").alias("n")).where(F.col("n") >= 2)
    hot = cut_lineage(
        counted.join(records, "source").where(F.col("n") >= F.greatest(F.lit(2), F.ceil(least * CANDIDATE_SHARE)))
        .select("source", F.xxhash64("source", "key").alias("wording"), "key", "n", "records")
    )
    small = hot.count() <= BROADCAST_ROWS
    hint = F.broadcast if small else (lambda x: x)
    sought = hint(hot.select("wording", "n", F.col("key").alias("hot_key"), F.explode(_segments(F.col("key"), False)).alias("segment")))
    near = F.levenshtein("key", "hot_key", 3).between(0, _tolerance(F.least(F.length("key"), F.length("hot_key"))))
    matched = cut_lineage(
        lines.select("doc", "source", "record", "line_no", "key", F.explode(_segments(F.col("key"), True)).alias("segment"))
        .join(sought, "segment").where((F.col("key") == F.col("hot_key")) | near)
        .groupBy("doc", "source", "record", "line_no").agg(F.max_by("wording", F.struct("n", "wording")).alias("wording"), F.first(F.xxhash64("source", "key")).alias("own"))
    )
    # a wording that is itself a copy of a more frequent one stands for that one
    copies = matched.where("own <> wording").join(hint(hot.select(F.col("wording").alias("own"))), "own", "left_semi")
    copies = copies.groupBy(F.col("own").alias("copy")).agg(F.max("wording").alias("of"))
    found = matched.join(hint(copies), F.col("wording") == F.col("copy"), "left").select(
        "doc", "source", "record", "line_no", F.coalesce("of", "wording").alias("wording")
    )
    support = found.groupBy("wording").agg(F.countDistinct("record").alias("support"))
    frequent = cut_lineage(
        hot.join(support, "wording").where(F.col("support") >= least).select("source", "wording", "key", "support", "records")
    )
    return frequent, found.join(hint(frequent.select("wording")), "wording", "left_semi")


def prefix_span(occurrences: DataFrame, frequent: DataFrame, min_records: int = 4, min_share: float = 0.08, max_length: int | None = None) -> DataFrame:
    """(source, pattern array<bigint>, support): the frequent sequences of wordings, of one up to max_length lines, or
    of any length.

    PrefixSpan: the projected database of a pattern holds, for each record, what follows its first occurrence; items
    frequent there extend the pattern. Every level is one aggregation by (source, pattern, item); an empty one is the
    last. All frequent sequences come out, so a block of n lines has 2 ** n - 1 of them.
    """
    records = frequent.select("source", "records").distinct()
    rows = F.sort_array(F.collect_list(F.struct("doc", "line_no", "wording")))
    start = occurrences.groupBy("source", "record").agg(F.transform(rows, lambda x: x["wording"]).alias("rest"))
    least = F.greatest(F.lit(min_records), F.ceil(F.col("records") * min_share))
    base = cut_lineage(start.withColumn("pattern", F.array().cast("array<bigint>")))
    levels = []
    for length in count(1):
        items = base.select("source", "record", "pattern", "rest", F.explode(F.array_distinct("rest")).alias("item"))
        grown = items.select("source", "record", F.concat("pattern", F.array("item")).alias("pattern"), "rest", "item")
        support = (
            grown.groupBy("source", "pattern").agg(F.countDistinct("record").alias("support"))
            .join(records, "source").where(F.col("support") >= least).select("source", "pattern", "support")
        )
        level = cut_lineage(support)
        if levels and level.isEmpty():
            break
        levels.append(level)
        if length == max_length:
            break
        rest = F.expr("slice(rest, cast(array_position(rest, item) as int) + 1, size(rest))")
        base = cut_lineage(grown.join(level, ["source", "pattern"], "left_semi").select("source", "record", "pattern", rest.alias("rest")).where("size(rest) > 0"))
        if base.isEmpty():
            break
    return reduce(DataFrame.unionByName, levels)


def repeated_lines(df: DataFrame, id_col: str, text_col: str, source_col: str, record_col: str, min_records: int = 4, min_share: float = 0.08, max_length: int = 3) -> DataFrame:
    """(doc, line_no) of every line that belongs to a frequent sequence of its source, single lines included.

    Null texts have no lines; a null source counts as one source of its own; a null record counts as a record for
    each row. Blank lines, page breaks and bare page numbers have no wording. Each line comes out once.
    """
    frequent, occurrences = frequent_wordings(df, id_col, text_col, source_col, record_col, min_records, min_share)
    patterns = prefix_span(occurrences, frequent, min_records, min_share, max_length)
    members = patterns.select(F.explode("pattern").alias("wording")).distinct()
    return occurrences.join(members, "wording", "left_semi").select("doc", "line_no")


def without_lines(df: DataFrame, id_col: str, text_col: str, lines: DataFrame) -> DataFrame:
    """(id, text): the texts without the given (doc, line_no); null texts stay null."""
    gone = lines.groupBy("doc").agg(F.collect_set("line_no").alias("gone"))
    ship_package(df.sparkSession)

    @F.pandas_udf("string")
    def kept(texts: pd.Series, gone: pd.Series) -> pd.Series:
        out = []
        for t, numbers in zip(texts, gone, strict=True):
            drop = set(numbers)
            out.append("\n".join(x for k, x in enumerate(t.split("\n"), 1) if k not in drop))
        return pd.Series(out, dtype=object)

    both = df.select(F.col(f"`{id_col}`").alias("doc"), F.col(f"`{text_col}`").alias("_text")).join(gone, "doc", "left")
    whole = F.col("gone").isNull() | F.col("_text").isNull()
    joined = kept(F.coalesce("_text", F.lit("")), F.coalesce("gone", F.array().cast("array<int>")))
    return both.select(F.col("doc").alias(id_col), F.when(whole, F.col("_text")).otherwise(joined).alias("text"))
