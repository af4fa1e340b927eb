"""The queries of the training-data problems, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.llm import leaks, ocr, packing, pairs, quality, repeats, split, tokens, truncated
from inkspan.session import table
from inkspan.sources.files import discover
from inkspan.streaming.ingest import shared_folder


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Issues whose text is mainly lists, tables or rubbish."""
    return quality.prose_verdicts(table(spark, d, "issues", spread=True), "seq", "raw_text").where("verdict = 'not_prose'").select("seq")


def p1_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Statistics and verdict of the raw and the cleaned text of every issue."""
    issues = table(spark, d, "issues", spread=True)
    of = [quality.document_statistics(issues, "seq", c).withColumn("field", F.lit(c)) for c in ("raw_text", "tier_1_cleaned")]
    return of[0].unionByName(of[1])


P1_COUNTS = ("n_chars", "n_words", "n_lines", "n_paragraphs", "mean_word_length", "digit_ratio", "dup_line_share")


def p1_counts(spark: SparkSession, d: str) -> DataFrame:
    """Those of the statistics of every issue's text that SQL can say, ratios in whole ten-thousandths."""
    found = quality.document_statistics(table(spark, d, "issues", spread=True), "seq", "raw_text", common=frozenset())
    return found.select("seq", *[F.floor(F.col(c) * 10_000 + 0.5).cast("bigint").alias(c) if c.endswith(("ratio", "share", "length")) else F.col(c) for c in P1_COUNTS])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Defective question and answer pairs with their defect."""
    found = pairs.pair_defects(table(spark, d, "test_queries"), "qa_id", "question", "answer")
    return found.where("defect is not null").select(F.col("id").alias("qa_id"), "defect")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Noise by line of the issues that are prose."""
    pages = ocr.repair_pages(table(spark, d, "issues", spread=True), "seq", "raw_text", "newspaper", prose_only=True)
    return pages.where("verdict <> 'not_prose'").select("seq", F.explode("noise").alias("x")).select("seq", "x.line_no", "x.noise")


def p3_repaired(spark: SparkSession, d: str) -> DataFrame:
    """Every issue's text in continuous paragraphs."""
    return ocr.repair_pages(table(spark, d, "issues", spread=True), "seq", "raw_text", "newspaper").select("seq", "repaired", "verdict")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Oversized issues with the best boundary that suffices."""
    return split.boundary_levels(table(spark, d, "issues"), "seq", "raw_text").select(F.col("item").alias("seq"), "boundary")


def p4_pieces(spark: SparkSession, d: str) -> DataFrame:
    """All issues in pieces of at most 4,000 characters that overlap by 200."""
    return split.split_texts(table(spark, d, "issues", spread=True), "seq", "raw_text").withColumnRenamed("item", "seq")


#: Bytes of a range of the files of p4_files: small, so that every file has many ranges.
P4_RANGE = 1 << 16


def _p4_tables(spark: SparkSession, d: str) -> DataFrame:
    """The issues' texts written as files of many texts each, page breaks between them, and the tables of their ranges."""
    folder = f"{shared_folder(spark)}/texts"
    texts = table(spark, d, "issues").where("raw_text is not null").select("raw_text")
    texts.write.option("lineSep", f"\n\n{split.MARKER}\n\n").text(folder)
    paths = sorted(r.path for r in discover(spark, folder, r"^part-").select("path").collect())
    return split.file_tables(spark, paths, P4_RANGE)


def _file_no() -> Column:
    return F.regexp_extract("item", r"part-(\d+)", 1).cast("int").alias("file")


def p4_files(spark: SparkSession, d: str) -> DataFrame:
    """The pieces of all files, read by ranges of bytes."""
    return split.file_pieces(_p4_tables(spark, d)).select(_file_no(), "piece_no", "start", "end", "boundary", "piece")


def p4_file_levels(spark: SparkSession, d: str) -> DataFrame:
    """The best boundary that suffices for each file, stitched from the tables of its ranges."""
    return split.file_levels(_p4_tables(spark, d)).select(_file_no(), "chars", "boundary")


P5 = ("seq", "raw_text", "newspaper", "record_id")


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Lines that a newspaper repeats in many of its issues."""
    return repeats.repeated_lines(table(spark, d, "issues"), *P5).select(F.col("doc").alias("seq"), "line_no")


def p5_sequences(spark: SparkSession, d: str) -> DataFrame:
    """The frequent sequences of repeated lines by newspaper, with their support."""
    frequent, occurrences = repeats.frequent_wordings(table(spark, d, "issues"), *P5)
    return repeats.prefix_span(occurrences, frequent).withColumnRenamed("source", "newspaper")


def p5_cleaned(spark: SparkSession, d: str) -> DataFrame:
    """Every issue's text without the repeated lines."""
    issues = table(spark, d, "issues")
    return repeats.without_lines(issues, "seq", "raw_text", repeats.repeated_lines(issues, *P5))


def _p6(spark: SparkSession, d: str, **how) -> DataFrame:
    """Both corpora with their slices: table, id, source, language, domain, tokens."""
    i, t = table(spark, d, "issues", spread=True), table(spark, d, "documents", spread=True)
    spoken = F.when(F.size("language") > 0, F.array_join(F.transform("language", tokens.language_code), "+")).otherwise(F.lit("und"))
    a = i.select(F.lit("issues").alias("corpus"), F.col("seq").alias("id"), F.col("newspaper").alias("source"), F.coalesce(spoken, F.lit("und")).alias("language"), F.col("collection").alias("domain"), F.col("raw_text").alias("text"))
    b = t.select(F.lit("documents").alias("corpus"), F.col("doc_id").alias("id"), "source", tokens.language_code(F.col("lang")).alias("language"), "domain", "text")
    return tokens.token_counts(a.unionByName(b), ["corpus", "id", "source", "language", "domain"], "text", **how)


def _p6_slices(counted: DataFrame) -> DataFrame:
    return tokens.token_budget(counted.withColumn("source", F.concat("corpus", F.lit("/"), F.coalesce("source", F.lit("unknown")))))


def p6_budget(spark: SparkSession, d: str) -> DataFrame:
    """Tokens by newspaper or source, by language, by collection or domain, and by all three."""
    return _p6_slices(_p6(spark, d))


def p6_unigram(spark: SparkSession, d: str) -> DataFrame:
    """The same slices by count-only Viterbi over the pieces of a supplied vocabulary, taken as a unigram one."""
    return _p6_slices(_p6(spark, d, vocabulary=tokens.PIECES, best_path=True))


def p6_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of every issue and document."""
    return _p6(spark, d).select("corpus", "id", "tokens")


def _p7(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack(tokens.token_counts(table(spark, d, "documents", spread=True), ["doc_id"], "text"), "doc_id", "tokens")


def p7_assignment(spark: SparkSession, d: str) -> DataFrame:
    """Every document, or its pieces, with its container of 2,048 tokens."""
    return _p7(spark, d).withColumnRenamed("item", "doc_id")


def p7_bins(spark: SparkSession, d: str) -> DataFrame:
    """The containers with their contents' size and what they leave unused."""
    return packing.bins_of(_p7(spark, d))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents that hold evaluation passages, with the passages."""
    found = leaks.find_leaks(table(spark, d, "documents", spread=True), "doc_id", "text", table(spark, d, "eval_passages"), "item_id", "text")
    return found.select(F.col("doc").alias("doc_id"), "item_id")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    """Every evaluation item with the number of documents that leak it."""
    found = leaks.find_leaks(table(spark, d, "documents", spread=True), "doc_id", "text", table(spark, d, "eval_passages"), "item_id", "text")
    counted = found.groupBy("item_id").agg(F.count("*").alias("documents"), F.max("words").alias("most_words"))
    items = table(spark, d, "eval_passages").select("item_id", "item_kind", "split_name")
    return items.join(counted, "item_id", "left").na.fill(0, ["documents", "most_words"])


def _p9(spark: SparkSession, d: str) -> DataFrame:
    return truncated.truncation(table(spark, d, "documents"), "doc_id", "text", "source")


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """Documents whose text was cut."""
    return _p9(spark, d).where("cut").select(F.col("id").alias("doc_id"))


def p9_share(spark: SparkSession, d: str) -> DataFrame:
    """How often each source cuts its texts."""
    return _p9(spark, d).groupBy("source").agg(F.count("*").alias("documents"), F.count_if("cut").alias("cut"), F.avg(F.col("cut").cast("double")).alias("share"))


QUERIES = {
    f.__name__: f for f in (
        p1_found, p1_statistics, p1_counts, p2_found, p3_found, p3_repaired, p4_found, p4_pieces, p4_files, p4_file_levels, p5_found, p5_sequences, p5_cleaned,
        p6_budget, p6_unigram, p6_tokens, p7_assignment, p7_bins, p8_found, p8_items, p9_found, p9_share,
    )
}

_BLANK = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_SPACE = _BLANK.replace(r"\s", r" \t\r\f")


def _longest(pattern: str) -> str:
    """The longest part of raw_text between matches of the pattern, white space around it not counted."""
    return f"list_max(list_transform(string_split_regex(raw_text, '{pattern}'), lambda x: length(regexp_replace(x, '^{_BLANK}+|{_BLANK}+\\z', '', 'g'))))"


_AT = {"page": rf"(?m)^{_SPACE}*--- PAGE BREAK ---{_SPACE}*$", "paragraph": rf"\n(?:{_SPACE}*\n)+", "line": r"\n", "word": rf"{_BLANK}+"}
_STRIPPED = f"regexp_replace(x, '^{_BLANK}+|{_BLANK}+\\z', '', 'g')"
_TEN = "cast(floor(case when ({1}) = 0 then 0.0 else ({0})::double / ({1}) end * 10000 + 0.5) as bigint)"
_WORDS = r"regexp_extract_all(t, '[\p{L}\p{Nl}\p{No}]+')"
_DENSE = f"length(regexp_replace(t, '{_BLANK}+', '', 'g'))"
SQL: dict[str, str] = {
    "p1_counts": f"with l as (select seq, length(coalesce(raw_text, '')) as n_chars, case when regexp_replace(coalesce(raw_text, ''), '{_BLANK}+', '', 'g') = '' then '' else raw_text end as t from issues), "
    f"f as (select *, list_filter(list_transform(string_split(t, chr(10)), lambda x: {_STRIPPED}), lambda x: x <> '') as full_lines, {_WORDS} as words from l) "
    f"select seq, n_chars, len(words) as n_words, len(full_lines) as n_lines, len(list_filter(list_transform(string_split_regex(t, '\\n{_BLANK}*\\n'), lambda x: {_STRIPPED}), lambda x: x <> '')) as n_paragraphs, "
    + _TEN.format("list_sum(list_transform(words, lambda w: length(w)))", "len(words)") + " as mean_word_length, " + _TEN.format("len(regexp_extract_all(t, '[0-9]'))", _DENSE) + " as digit_ratio, "
    + _TEN.format("len(full_lines) - len(list_distinct(full_lines))", "len(full_lines)") + " as dup_line_share from f",
    "p4_found": "select seq, case " + " ".join(f"when {_longest(p)} <= 4000 then '{k}'" for k, p in _AT.items()) + " else 'none' end as boundary from issues where length(raw_text) > 4000",
}
