"""Cutting text into paragraphs, segments, sentences and chunks."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from inkspan.session import ship_package
from inkspan.text.classes import c, strip, text_of

NO_TEXTS = "array<string>"


def paragraphs(x) -> Column:
    """Stripped, non-empty parts between two or more line ends."""
    return F.filter(F.transform(F.split(text_of(x), r"\n{2,}"), strip), lambda p: p != "")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once: lambdas don't share what they refer to."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def merged(text: str, min_chars: int = 200) -> list[str]:
    """Paragraphs joined by blank lines until a segment has min_chars; a short rest goes to the last segment."""
    out: list[list[str]] = []
    held: list[str] = []
    n = 0
    for p in (x.strip() for x in re.split(r"\n{2,}", text)):
        if not p:
            continue
        n += len(p) + (2 if held else 0)
        held.append(p)
        if n >= min_chars:
            out.append(held)
            held, n = [], 0
    if held:
        if out:
            out[-1] += held
        else:
            out.append(held)
    return ["\n\n".join(x) for x in out]


def segments(x, min_chars: int = 200) -> Column:
    """merged as an Arrow function: where a segment begins depends on all before it. Null gives no segments."""
    ship_package(SparkSession.active())

    @F.pandas_udf(ArrayType(StringType()))
    def cut(s: pd.Series) -> pd.Series:
        return s.map(lambda t: merged(t or "", min_chars))

    return cut(c(x))


def keyword_score(x, keywords) -> Column:
    """How many of the keywords occur in the text, as plain substrings of its lower-case form."""
    keys = F.array(*[F.lit(k) for k in keywords]).cast(NO_TEXTS) if not isinstance(keywords, Column) else keywords
    return let(F.lower(text_of(x)), lambda low: F.size(F.filter(keys, lambda k: F.contains(low, k))))


def top_segments(segs: Column, keywords, min_score: int = 2, top: int = 5) -> Column:
    """struct<best array<struct<text, score>>, n>: the best segments and how many reach min_score. Ties keep order."""
    scored = F.transform(segs, lambda s, i: F.struct((-keyword_score(s, keywords)).alias("rank"), i.alias("at"), s.alias("text")))

    def best(kept: Column) -> Column:
        first = F.slice(F.array_sort(kept), 1, top)
        return F.struct(F.transform(first, lambda s: F.struct(s["text"].alias("text"), (-s["rank"]).alias("score"))).alias("best"), F.size(kept).alias("n"))

    return let(F.filter(scored, lambda s: s["rank"] <= -min_score), best)


def sentences(x) -> Column:
    """Parts between ``. `` (and ``|``), stripped, empty ones left out."""
    parts = F.split(F.replace(text_of(x), F.lit(". "), F.lit(".|")), r"\|")
    return F.filter(F.transform(parts, strip), lambda s: s != "")


def packed(text: str, limit: int = 400) -> list[str]:
    """Sentences joined by spaces into groups; a group is closed once its sentences have more than limit characters."""
    out, held, n = [], [], 0
    for t in text.replace(". ", ".|").split("|"):
        t = t.strip()
        if t:
            held.append(t)
            n += len(t)
        if n > limit:
            out.append(" ".join(held))
            held, n = [], 0
    return [*out, " ".join(held)] if held else out


def packed_sentences(x, limit: int = 400) -> Column:
    """packed as an Arrow function. Null gives no groups."""
    ship_package(SparkSession.active())

    @F.pandas_udf(ArrayType(StringType()))
    def cut(s: pd.Series) -> pd.Series:
        return s.map(lambda t: packed(t or "", limit))

    return cut(c(x))


def cut_chunks(text: str, size: int = 1500, lossless: bool = True) -> list[str]:
    """Chunks of at most size characters, cut at their last space. Not lossless: where there is no space, the
    character at the cut is lost, too."""
    out, at = [], 0
    while at < len(text):
        if at + size >= len(text):
            out.append(text[at:])
            break
        space = text.rfind(" ", at, at + size)
        out.append(text[at : at + size] if space < 0 else text[at:space])
        at = at + size + (not lossless) if space < 0 else space + 1
    return out


def chunks(x, size: int = 1500, lossless: bool = True) -> Column:
    """cut_chunks as an Arrow function: where a chunk begins depends on all before it. Null gives no chunks."""

    ship_package(SparkSession.active())

    @F.pandas_udf(ArrayType(StringType()))
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda t: cut_chunks(t or "", size, lossless))

    return cut(c(x))
