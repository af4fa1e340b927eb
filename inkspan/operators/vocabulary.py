"""Words of a corpus: vocabularies, frequencies, unknown words, spelling, special characters."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkspan.config import JUNK_CHARS, WHITELIST
from inkspan.session import cut_lineage, ship_package
from inkspan.text.classes import WS_IN, c, ratio, rounded, text_of, tokens, words

#: Words of a table of corrections that are sent to the workers at a time.
BROADCAST_WORDS = 500_000


def vocabulary(df: DataFrame, text_col: str) -> DataFrame:
    """(word): the different words of more than two letters, lower case."""
    return df.select(F.explode(words(text_col)).alias("w")).select(F.lower("w").alias("word")).where(F.length("word") > 2).distinct()


def union_vocabulary(*tables: DataFrame, extra: list[str] = ()) -> DataFrame:
    """(word): the whitelist, the tables and the extra words together, lower case."""
    spark = tables[0].sparkSession
    out = spark.createDataFrame([(w,) for w in dict.fromkeys([*WHITELIST, *extra])], "word string")
    for t in tables:
        out = out.union(t.select("word"))
    return out.select(F.lower("word").alias("word")).distinct()


def word_frequencies(df: DataFrame, text_col: str) -> DataFrame:
    """(word, n, zipf): how often each word stands in the corpus; zipf is the logarithm of its share in a billion."""
    counts = df.select(F.explode(words(text_col)).alias("w")).groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("word", "n", F.log10(F.col("n") / F.col("total") * 1e9).alias("zipf"))  # one row


def trimmed(x) -> Column:
    """A token without what isn't a letter at its ends, lower case."""
    return F.lower(F.regexp_replace(c(x), r"^[^a-zA-Z]+|[^a-zA-Z]+\z", ""))


def decomposed(x) -> tuple[Column, Column, Column]:
    """What stands before the letters of a token, the core, what stands after."""
    pattern = r"^([^a-zA-Z]*)(.*?)([^a-zA-Z]*)\z"
    return tuple(F.regexp_extract(c(x), f"(?s){pattern}", k) for k in (1, 2, 3))


def oov_rates(df: DataFrame, id_col: str, text_col: str, vocab: DataFrame, zipf: DataFrame, threshold: float = 1.5) -> DataFrame:
    """(id, tokens, unknown, oov_rate): tokens that neither are short nor stand in the vocabulary nor are frequent.

    Every different word is looked up once: counts by id and word are aggregated before the joins, the known words
    are one table.
    """
    known = vocab.select("word").union(zipf.where(F.col("zipf") > threshold).select("word")).distinct().withColumn("known", F.lit(True))
    counts = df.select(id_col, F.explode_outer(tokens(text_col)).alias("t")).select(id_col, trimmed("t").alias("word"), F.col("t").isNotNull().cast("int").alias("one"))
    per_word = counts.groupBy(id_col, "word").agg(F.sum("one").alias("n"))
    joined = per_word.join(known, "word", "left")
    unknown = F.when((F.length(F.coalesce("word", F.lit(""))) > 2) & F.col("known").isNull(), F.col("n")).otherwise(0)
    sums = joined.groupBy(id_col).agg(F.sum("n").alias("tokens"), F.sum(unknown).alias("unknown"))
    return sums.select(id_col, "tokens", "unknown", rounded(ratio(F.col("unknown"), F.col("tokens"))).alias("oov_rate"))


def token_classes(df: DataFrame, text_col: str, modern: DataFrame, truth: DataFrame) -> DataFrame:
    """(class, tokens, token_ratio, words): words that are modern, else of the ground truth, else unknown; and all."""
    counts = df.select(F.explode(words(text_col)).alias("w")).groupBy(F.lower("w").alias("word")).agg(F.count("*").alias("n"))
    m = modern.select("word").distinct().withColumn("m", F.lit(True))
    g = truth.select("word").distinct().withColumn("g", F.lit(True))
    kind = F.when(F.col("m"), "modern").when(F.col("g"), "ground_truth").otherwise("oov")
    classed = counts.join(m, "word", "left").join(g, "word", "left").groupBy(kind.alias("class")).agg(F.sum("n").alias("tokens"), F.count("*").alias("words"))
    total = classed.agg(F.sum("tokens").alias("all"))
    out = classed.unionByName(classed.agg(F.lit("all").alias("class"), F.sum("tokens").alias("tokens"), F.sum("words").alias("words")))
    return out.crossJoin(F.broadcast(total)).select("class", "tokens", rounded(F.try_divide(F.col("tokens"), F.col("all"))).alias("token_ratio"), "words")  # one row


def sorted_sample(vocab: DataFrame, n: int = 50) -> DataFrame:
    """The first n words in order: a sample to look at."""
    return vocab.select("word").distinct().orderBy("word").limit(n)


def special_characters(df: DataFrame, text_col: str) -> DataFrame:
    """(class, ch, n): characters that are neither alphanumeric nor space, junk apart from the others."""
    found = F.regexp_extract_all(text_of(text_col), F.lit(rf"[^\p{{L}}\p{{N}}{WS_IN}]"), 0)
    kind = F.when(F.contains(F.lit(JUNK_CHARS), F.col("ch")), "junk").otherwise("other")
    return df.select(F.explode(found).alias("ch")).groupBy(kind.alias("class"), "ch").agg(F.count("*").alias("n"))


def special_summary(chars: DataFrame) -> DataFrame:
    """(class, unique_chars, total, all_chars) of special_characters."""
    return chars.groupBy("class").agg(F.count("*").alias("unique_chars"), F.sum("n").alias("total"), F.array_join(F.array_sort(F.collect_list("ch")), "").alias("all_chars"))


# -- spelling --------------------------------------------------------------------------------------------------------


def deletions(x, edits: int = 1) -> Column:
    """The word and the words that lack up to so many of its letters: two words within that many edits, a swap of
    neighbouring letters counting for one, share one of these."""
    x = c(x)

    def shorter(w: Column) -> Column:
        n = F.length(w)
        return F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: F.concat(F.substring(w, F.lit(1), k - 1), F.substring(w, k + 1, n)))

    out = F.array(x)
    for _ in range(edits):
        out = F.array_distinct(F.concat(out, F.flatten(F.transform(out, shorter))))
    return out


def swapped(a: Column, b: Column) -> Column:
    """Whether two words differ by a swap of neighbouring letters."""
    n = F.length(a)
    swap = lambda k: F.concat(F.substring(a, F.lit(1), k - 1), F.substring(a, k + 1, F.lit(1)), F.substring(a, k, F.lit(1)), F.substring(a, k + 2, n))
    return (n == F.length(b)) & (n > 1) & F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda k: swap(k) == b)


def corrections(df: DataFrame, text_col: str, vocab: DataFrame, zipf: DataFrame, threshold: float = 0.0, distance: int = 1) -> DataFrame:
    """(word, correction) of the words of the corpus that are to be corrected.

    Candidates are vocabulary words within one edit (a letter more, less or other, or two neighbours swapped); with a
    distance of 2, for words that have none of these, those within two. They are found by a join on the neighbourhoods of
    deletions, so neither side is compared with all of the other. The most frequent wins, then the first in the alphabet.
    Words of up to two letters, with capitals or digits, in the vocabulary, or frequent themselves stay.
    """
    if distance not in (1, 2):
        raise ValueError("the distance is 1 or 2")
    _, core, _ = decomposed("t")
    # the generator keeps the filter above the distinct tokens, so that each is taken apart once
    cores = df.select(F.explode(tokens(text_col)).alias("t")).distinct().select(F.explode(F.array(core)).alias("word")).where((F.length("word") > 2) & ~F.col("word").rlike("^[A-Z]|[0-9]"))
    found = cores.select(F.lower("word").alias("word")).distinct()
    fit = zipf.select("word", "zipf")
    wrong = found.join(vocab.select("word"), "word", "left_anti").join(fit.where(F.col("zipf") > threshold).select("word"), "word", "left_anti")
    targets = vocab.join(fit, "word", "left").select(F.col("word").alias("correction"), F.coalesce("zipf", F.lit(0.0)).alias("zipf"))
    near = wrong.select("word", F.explode(deletions("word", distance)).alias("d")).join(targets.select("correction", "zipf", F.explode(deletions("correction", distance)).alias("d")), "d")
    one = (F.levenshtein("word", "correction", 1) == 1) | swapped(F.col("word"), F.col("correction"))
    edits = F.when(one, 1)
    if distance == 2:
        # two edits, one of which may be a swap
        edits = edits.when((F.levenshtein("word", "correction", 2) == 2) | swapped_once(F.col("word"), F.col("correction")), 2)
    close = near.select("word", "correction", "zipf", edits.alias("edits")).where("edits is not null").distinct()
    return close.groupBy("word").agg(F.min_by("correction", F.struct("edits", -F.col("zipf"), F.col("correction"))).alias("correction"))


def swapped_once(a: Column, b: Column) -> Column:
    """Whether one swap of neighbouring letters and one other edit make b of a."""
    n = F.length(a)
    swap = lambda k: F.concat(F.substring(a, F.lit(1), k - 1), F.substring(a, k + 1, F.lit(1)), F.substring(a, k, F.lit(1)), F.substring(a, k + 2, n))
    near = lambda w: (F.levenshtein(w, b, 1) == 1) | swapped(w, b)
    return (n > 1) & F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda k: near(swap(k)))


def corrected_texts(df: DataFrame, id_col: str, text_col: str, table: DataFrame) -> DataFrame:
    """(id, text, corrected) of every row, with the corrections put in and their number; white space stays as it is. Null
    texts become empty ones; rows of one id stay rows of their own.

    Every text is rewritten where it is: the corrections are sent to the workers, in blocks of bounded size. A correction
    is a word of the vocabulary and so never corrected again, whatever the order of the blocks.
    """
    spark = df.sparkSession
    ship_package(spark)
    kept = cut_lineage(table.select("word", "correction"))
    blocks = max(1, -(-kept.count() // BROADCAST_WORDS))
    out = df.select(F.col(id_col), text_of(text_col).alias("text"), F.lit(0).cast("bigint").alias("corrected"))
    for k in range(blocks):
        part = kept if blocks == 1 else kept.where(F.pmod(F.xxhash64("word"), F.lit(blocks)) == k)
        rewrite = _rewriter(spark.sparkContext.broadcast(dict(part.toArrow().to_pandas().itertuples(index=False, name=None))))
        out = out.select(id_col, rewrite("text").alias("_r"), "corrected").select(id_col, "_r.text", (F.col("corrected") + F.col("_r.n")).alias("corrected"))
    return out


def _rewriter(shared):
    part, core = re.compile(r"(\s+)"), re.compile(r"([^a-zA-Z]*)(.*?)([^a-zA-Z]*)", re.DOTALL)

    @F.pandas_udf("text string, n bigint")
    def rewrite(texts: pd.Series) -> pd.DataFrame:
        table, out = shared.value, []
        known: dict[str, str] = {}
        for t in texts:
            n, parts = 0, part.split(t)
            for k in range(0, len(parts), 2):
                token = parts[k]
                new = known.get(token)
                if new is None:
                    before, word, after = core.fullmatch(token).groups()
                    right = table.get(word.lower()) if word and not ("A" <= word[0] <= "Z") and not re.search("[0-9]", word) else None
                    new = known[token] = before + right + after if right else token
                if new != token:
                    parts[k], n = new, n + 1
            out.append(("".join(parts), n))
            if len(known) > 200_000:
                known.clear()
        return pd.DataFrame(out, columns=["text", "n"])

    return rewrite
