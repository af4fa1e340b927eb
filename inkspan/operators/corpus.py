"""What a corpus of questions and answers holds; token volume and its cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspan.config import EMBEDDING_PRICES, ERA_KEYWORDS
from inkspan.text.classes import c, rounded, text_of, tokens
from inkspan.text.metrics import token_count


def completeness(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, non_null, nulls, share) of the fields, in one pass."""
    sums = df.agg(F.count("*").alias("_n"), *[F.count(f"`{f}`").alias(f) for f in fields])
    pairs = ", ".join(f"'{f}', `{f}`" for f in fields)
    return sums.select(F.expr(f"stack({len(fields)}, {pairs}) as (field, non_null)"), "_n").select("field", "non_null", (F.col("_n") - F.col("non_null")).alias("nulls"), rounded(F.try_divide(F.col("non_null"), F.col("_n"))).alias("share"))


def distribution(df: DataFrame, col: str) -> DataFrame:
    """(value, n, share), null being a value."""
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("value", "n", rounded(F.col("n") / F.col("total")).alias("share"))  # one row


def truth_state(x="ground_truths") -> Column:
    return F.when(c(x).isNull(), "null").when(F.size(c(x)) == 0, "empty").otherwise("populated")


def truth_partition(df: DataFrame) -> DataFrame:
    """(state, size, n): rows by the state of their ground truths and, of populated ones, by their number."""
    size = F.when(F.size("ground_truths") > 0, F.size("ground_truths"))
    return df.groupBy(truth_state().alias("state"), size.alias("size")).agg(F.count("*").alias("n"))


def truth_sizes(df: DataFrame) -> DataFrame:
    """One row: rows that are populated, least, most and mean number of truths."""
    size = F.size("ground_truths")
    return df.where(size > 0).agg(F.count("*").alias("n"), F.min(size).alias("least"), F.max(size).alias("most"), rounded(F.sum(size) / F.count("*"), 1).alias("mean"))


def id_references(df: DataFrame) -> DataFrame:
    """(ark_id, n) of all references."""
    return df.select(F.explode("ground_truths").alias("g")).groupBy(F.coalesce(F.col("g.ark_id"), F.lit("")).alias("ark_id")).agg(F.count("*").alias("n"))


def reference_totals(refs: DataFrame) -> DataFrame:
    """One row: references, different ids, ids referred to more than once."""
    return refs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.count("*").alias("unique_ids"), F.count_if(F.col("n") > 1).alias("duplicated"))


def annotation_tier() -> Column:
    typed, truths = F.col("question_type").isNotNull(), F.coalesce(F.size("ground_truths") > 0, F.lit(False))
    return F.when(typed & truths, "full").when(truths, "truths_only").when(typed, "type_only").otherwise("minimal")


def length_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """(field, unit, least, most, mean) of the words and characters of the columns."""
    each = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.lit(u).alias("unit"), v.alias("n")) for f in cols for u, v in (("words", token_count(f)), ("chars", F.length(text_of(f))))]))
    return df.select(each.alias("s")).groupBy("s.field", "s.unit").agg(F.min("s.n").alias("least"), F.max("s.n").alias("most"), rounded(F.sum("s.n") / F.count("*"), 1).alias("mean"))


def first_words(df: DataFrame, col: str) -> DataFrame:
    """(word, n) of the texts' first words, lower case."""
    word = F.lower(F.get(tokens(col), F.lit(0)))
    return df.select(word.alias("word")).where("word is not null").groupBy("word").agg(F.count("*").alias("n"))


def most_common(counts: DataFrame, key: str, n: int, order: str | None = None) -> DataFrame:
    """The n rows of the largest counts; ties by ``order`` (such as first encounter), else by the key."""
    return counts.orderBy(F.desc("n"), order or key).limit(n)


def era(question, answer, keywords: dict[str, list[str]] = ERA_KEYWORDS) -> Column:
    """The first era of which a keyword occurs in question or answer, as a plain substring; else ``unclassified``."""
    text = F.concat(F.lower(text_of(question)), F.lit(" "), F.lower(text_of(answer)))
    out = F.lit("unclassified")
    for name, keys in reversed(keywords.items()):
        found = F.contains(text, F.lit(keys[0]))
        for k in keys[1:]:
            found = found | F.contains(text, F.lit(k))
        out = F.when(found, F.lit(name)).otherwise(out)
    return out


# -- token volume ----------------------------------------------------------------------------------------------------


def token_estimate(x, per_word: float = 1.3) -> Column:
    return F.floor(token_count(x) * per_word).cast("int")


def per_page(df: DataFrame, keep: list[str], text_col: str, pages_col: str) -> DataFrame:
    """(keep, page_count, char_count_actual, word_count, total_tokens, and these by page with one digit)."""
    pages = F.greatest(F.coalesce(F.col(pages_col), F.lit(1)), F.lit(1))
    base = df.select(*keep, pages.alias("page_count"), F.length(text_of(text_col)).alias("char_count_actual"), token_count(text_col).alias("word_count"), token_estimate(text_col).alias("total_tokens"))
    return base.select("*", *[rounded(F.col(a) / F.col("page_count"), 1).alias(b) for a, b in (("total_tokens", "tokens_per_page"), ("char_count_actual", "chars_per_page"), ("word_count", "words_per_page"))])


def token_stats(samples: DataFrame, by: list[str] = ()) -> DataFrame:
    """(by, n, mean, median, p5, p25, p75, p95, least, most) of tokens_per_page, one digit each."""
    v = F.floor(F.col("tokens_per_page") * 10 + 0.5).cast("bigint")
    agg = samples.select(*by, v.alias("v")).groupBy(*by).agg(
        F.count("v").alias("n"), F.sum("v").alias("s"), F.percentile("v", F.array(*[F.lit(p) for p in (0.5, 0.05, 0.25, 0.75, 0.95)])).alias("p"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    one = lambda x: rounded(x / 10, 1)
    return agg.select(*by, "n", one(F.col("s") / F.col("n")).alias("mean"), *[one(F.get("p", F.lit(k))).alias(n) for k, n in enumerate(("median", "p5", "p25", "p75", "p95"))], one(F.col("lo")).alias("least"), one(F.col("hi")).alias("most"))


def cost_model(stats: DataFrame, prices: dict[str, float] = EMBEDDING_PRICES) -> DataFrame:
    """(model, price, per page, per 1,000 and 10,000 pages) from the mean tokens of a page."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.lit(p).alias("price")) for m, p in prices.items()]))
    cost = F.col("mean") * F.col("price") / 1_000_000
    return stats.select("mean", each.alias("m")).select("m.model", "m.price", "mean").select("model", "price", rounded(cost, 6).alias("per_page"), rounded(cost * 1_000).alias("per_1000_pages"), rounded(cost * 10_000).alias("per_10000_pages"))


def fields_seen(df: DataFrame) -> DataFrame:
    """(field, records): the keys that records have values for, as their JSON has them, and how many records do."""
    keys = F.json_object_keys(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    return df.select(F.explode(keys).alias("field")).groupBy("field").agg(F.count("*").alias("records"))
