"""Articles, generated questions and answers, retrieval, export."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, StructField, StructType

from inkspan.config import ID_PREFIX, PERIOD_KEYWORDS, QA_TEMPLATES
from inkspan.operators.matching import Best
from inkspan.operators.records import first_by
from inkspan.session import cut_lineage, ship_package
from inkspan.text.classes import NOT_W, text_of
from inkspan.text.clean import clean_eval
from inkspan.text.segments import let, segments, top_segments


def prefer_ocr(records: DataFrame, vlm: DataFrame, key: str = "ark_id") -> DataFrame:
    """Records with text and ocr_source: the page model's text where there is one, even an empty one, else the API's."""
    other = vlm.select(key, F.col("text").alias("_text"), F.lit(True).alias("_has"))
    joined = records.join(other, key, "left")
    has = F.coalesce("_has", F.lit(False))
    return joined.withColumn("text", F.when(has, F.col("_text")).otherwise(F.col("raw_text"))).withColumn("ocr_source", F.when(has, "dots.ocr").otherwise("api")).drop("_text", "_has")


def period_keywords(period, keywords: dict[str, list[str]] = PERIOD_KEYWORDS) -> Column:
    """The keywords of a period, those of the first period for an unknown one, none if there are no lists."""
    table = F.create_map(*[v for k, ws in keywords.items() for v in (F.lit(k), F.array(*map(F.lit, ws)))])
    default = next(iter(keywords), None)
    return F.coalesce(F.try_element_at(table, F.coalesce(period, F.lit(""))), F.try_element_at(table, F.lit(default)), F.array().cast("array<string>"))


def extract_articles(df: DataFrame, period: Column, keywords: dict[str, list[str]] = PERIOD_KEYWORDS, min_chars: int = 100, min_segment: int = 200, min_score: int = 2, top: int = 5) -> DataFrame:
    """Records (with text, ocr_source) that have segments of the period's topic, with the best of them. No join, no
    shuffle."""
    topic = period_keywords(F.col("period"), keywords)
    cleaned = df.where(F.length(text_of("text")) >= min_chars).withColumn("period", period).withColumn("_clean", clean_eval("text"))
    found = cleaned.withColumn("_segs", segments("_clean", min_segment)).withColumn("_top", top_segments(F.col("_segs"), topic, min_score, top))
    out = found.select(
        "ark_id", "record_id", "newspaper", F.coalesce("issue_date", F.lit("")).alias("issue_date"), "date_iso", "year", F.coalesce("title", F.lit("")).alias("title"), "period",
        "ocr_source", F.size("_segs").alias("total_segments"), F.col("_top.n").alias("war_segments"), F.col("_top.best").alias("top_segments"), F.length("_clean").alias("full_text_chars"),
    )
    return out.where("war_segments > 0")


def ground_truth() -> Column:
    title = F.concat("title", F.lit(", "), F.coalesce("issue_date", F.lit("unknown date")))
    return F.array(F.struct(title.alias("title"), F.concat(F.lit(ID_PREFIX), "ark_id").alias("ark_id")))


def unanswered(articles: DataFrame, qa: DataFrame, order: str) -> DataFrame:
    """Articles with segments that no pair's ground truth names; the first row of each id."""
    named = qa.select(F.explode("ground_truths").alias("g")).select(F.replace(F.col("g.ark_id"), F.lit(ID_PREFIX), F.lit("")).alias("ark_id")).distinct()
    return first_by(articles.where(F.size("top_segments") > 0).join(named, "ark_id", "left_anti"), "ark_id", order)


def numbered(df: DataFrame, order: str) -> DataFrame:
    """Consecutive numbers from 0 in that order, column ``n``.

    Rows are cut into ranges of the order; numbers within a range are counted apart and offset by the counts of the
    ranges before, so there is no window over all rows.
    """
    ranged = df.repartitionByRange(F.col(order)).withColumn("_p", F.spark_partition_id())
    # kept as it is: another evaluation might draw other bounds
    within = cut_lineage(ranged.withColumn("_k", F.row_number().over(Window.partitionBy("_p").orderBy(order))))
    counts = within.groupBy("_p").agg(F.count("*").alias("_c"))
    offsets = counts.select("_p", (F.sum("_c").over(Window.orderBy("_p")) - F.col("_c")).alias("_o"))  # a row for each range
    return within.join(F.broadcast(offsets), "_p").withColumn("n", F.col("_o") + F.col("_k") - 1).drop("_p", "_k", "_o")


def template_qa(articles: DataFrame, order: str) -> DataFrame:
    """Pairs from templates used in turn, one for each article in the given order."""
    n = len(QA_TEMPLATES)
    rows = numbered(articles, order)
    pick = lambda k: F.get(F.array(*[F.lit(t[k]) for t in QA_TEMPLATES]), (F.col("n") % n).cast("int"))
    date = F.coalesce("issue_date", F.lit("unknown date"))
    top = F.get("top_segments", F.lit(0))
    question = F.replace(F.replace(pick(0), F.lit("{newspaper}"), F.col("newspaper")), F.lit("{date}"), date)
    return rows.select(
        question.alias("question"), pick(1).alias("question_type"), ground_truth().alias("ground_truths"),
        F.concat(F.lit("Based on the "), "newspaper", F.lit(" from "), date, F.lit(": "), F.substring(top["text"], 1, 500), F.lit("...")).alias("answer"),
        F.lit("medium").alias("confidence"), F.format_string("pseudoGT_template | war_score=%d | ocr=%s", top["score"], F.col("ocr_source")).alias("notes"),
        "period", order,
    )


# -- retrieval -------------------------------------------------------------------------------------------------------


def query_keywords(x) -> Column:
    """Words of more than two characters, repeated ones kept."""
    return F.filter(F.split(F.lower(text_of(x)), f"{NOT_W}+"), lambda w: F.length(w) > 2)


def retrieve(queries: DataFrame, records: DataFrame, top: int = 5, order: str = "seq", preview: int | None = None) -> DataFrame:
    """(query_id, order, score, rank): the records in which most of a query's keywords occur, as substrings. preview: only
    so many characters of a text are searched, if given.

    queries: query_id, question. The query set is broadcast; each partition of records is read once, for all queries, and
    keeps its best rows of each before they are ranked.
    """
    spark = queries.sparkSession
    ship_package(spark)
    body = text_of("raw_text") if preview is None else F.substring(text_of("raw_text"), 1, preview)
    text = F.lower(F.concat_ws(" ", text_of("newspaper"), text_of("issue_date"), body))
    keyed = queries.select("query_id", query_keywords("question").alias("keys")).toArrow()
    shared = spark.sparkContext.broadcast((keyed["query_id"].combine_chunks(), keyed["keys"].to_pylist()))
    out = StructType([queries.schema["query_id"], records.schema[order], StructField("score", IntegerType())])
    arrow = to_arrow_schema(out)

    def run(batches):
        ids, keys = shared.value
        best, places = Best(keys, top), []
        for b in batches:
            places.append(b.column(0))
            for k in range(0, b.num_rows, best.rows):
                best.add(b.column(1).slice(k, best.rows).to_pylist())
        if not places:
            return
        query, place, score = best.found()
        columns = [ids.take(pa.array(query)), pa.chunked_array(places).take(pa.array(place)).combine_chunks(), pa.array(score)]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    # by rising order, so that of equal scores the first stays
    kept = records.select(order, text.alias("_text")).sortWithinPartitions(order).mapInArrow(run, out)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), order)))
    return ranked.where(F.col("rank") <= top).select("query_id", order, "score", "rank")


# The instructions that models are given.
ANSWER_RULES = """Rules:
- Base your answer ONLY on the provided excerpts — do not use external knowledge
- If the excerpts do not contain relevant information, say so honestly
- Keep answers factual and cite specific dates when mentioned in the text
- confidence = high if text directly answers query, medium if partially, low if tangential"""
NO_RECORDS = "No relevant newspaper records found in the dataset for this query."
NO_RECORDS_NOTE = "No matching records in dataset"


def excerpts_prompt(hits: DataFrame, queries: DataFrame, records: DataFrame, order: str = "seq", chars: int = 2000, archive: str = "newspaper") -> DataFrame:
    """(query_id, records, prompt): the query with excerpts of its records in their order, at most ``chars`` of each;
    archive: whose excerpts the prompt says they are. Queries without records have a prompt without excerpts."""
    d = lambda col, default: F.coalesce(F.col(col), F.lit(default))
    excerpt = F.concat(F.lit("--- Record: "), d("newspaper", "Unknown"), F.lit(", "), d("issue_date", "Unknown date"), F.lit(" ---\nark_id: "), d("record_id", "N/A"), F.lit("\nText excerpt:\n"), F.substring(text_of("raw_text"), 1, chars), F.lit("\n"))
    rows = records.select(order, excerpt.alias("e")).join(F.broadcast(hits), order).groupBy("query_id").agg(F.count("*").alias("records"), F.array_sort(F.collect_list(F.struct("rank", "e"))).alias("es"))
    joined = queries.join(rows, "query_id", "left")
    shown = F.coalesce(F.array_join(F.transform("es", lambda x: x["e"]), "\n"), F.lit(""))
    prompt = F.concat(F.lit("Query: "), text_of("question"), F.lit(f"\n\nHere are the most relevant newspaper excerpts from the {archive} archive:\n\n"), shown)
    return joined.select("query_id", F.coalesce("records", F.lit(0)).alias("records"), prompt.alias("prompt"))


def merge_answers(queries: DataFrame, answered: DataFrame, generated: DataFrame, order: str) -> DataFrame:
    """(order, question, question_type, answer, confidence, notes, source): queries with ground truths as they are; of the
    others, the last stored answer, else the new one, else a low-confidence result without records.

    queries: order, question, question_type, ground_truths, answer, confidence, notes; answered and generated: question,
    answer, confidence, notes and ``at``, by which the last one is told."""
    has = F.coalesce(F.size("ground_truths") > 0, F.lit(False))
    own = queries.where(has).select(order, "question", "question_type", "answer", "confidence", "notes", F.lit("given").alias("source"))
    last = lambda df, name: df.groupBy("question").agg(F.max_by(F.struct("answer", "confidence", "notes"), "at").alias(name))
    rest = queries.where(~has).select(order, "question", "question_type").join(last(answered, "_s"), "question", "left").join(last(generated, "_m"), "question", "left")
    # an answer that was made gets its defaults and the mark of its kind
    made = F.struct(
        text_of("_m.answer").alias("answer"), F.coalesce("_m.confidence", F.lit("low")).alias("confidence"),
        F.concat(F.lit("pseudoGT | "), F.coalesce("_m.notes", F.lit("generated from actual newspaper text"))).alias("notes"), F.lit("generated").alias("source"),
    )
    none = F.struct(F.lit(NO_RECORDS).alias("answer"), F.lit("low").alias("confidence"), F.lit(f"pseudoGT | {NO_RECORDS_NOTE}").alias("notes"), F.lit("none").alias("source"))
    stored = F.struct("_s.answer", "_s.confidence", "_s.notes", F.lit("stored").alias("source"))
    chosen = F.when(F.col("_s").isNotNull(), stored).when(F.col("_m").isNotNull(), made).otherwise(none)
    return own.unionByName(rest.select(order, "question", "question_type", chosen.alias("_c")).select(order, "question", "question_type", "_c.*"))


# -- export ----------------------------------------------------------------------------------------------------------


def export_pairs(qa: DataFrame, periods: list[str], order: str) -> DataFrame:
    """The first pair of each question (missing ones together), then those of the periods or of none."""
    keyed = qa.withColumn("_q", F.coalesce("question", F.lit("")))
    kept = first_by(keyed, "_q", order).drop("_q")
    return kept.where(F.col("period").isNull() | (F.col("period") == "") | F.col("period").isin(*periods))


def export_counts(pairs: DataFrame) -> DataFrame:
    """(dimension, value, n): pairs by period, type, confidence and source, each for itself, in one pass."""
    shown = lambda col: F.coalesce(F.col(col), F.lit("unknown"))
    source = F.when(F.contains(text_of("notes"), F.lit("llm")), "llm").otherwise("template")
    dims = {"period": shown("period"), "type": shown("question_type"), "confidence": shown("confidence"), "source": source}
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("dimension"), v.alias("value")) for k, v in dims.items()]))
    return pairs.select(each.alias("d")).groupBy("d.dimension", "d.value").agg(F.count("*").alias("n"))
