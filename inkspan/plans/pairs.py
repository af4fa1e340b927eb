"""Queries on questions, answers and articles: description, retrieval, generation, export, token volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan import models
from inkspan.config import ERA_KEYWORDS, QA_TEMPLATES
from inkspan.operators import articles, corpus
from inkspan.plans import sql as S
from inkspan.session import table

QUERIES: dict = {}
SQL: dict[str, str] = {}
FIELDS = ["question", "question_type", "ground_truths", "answer", "confidence", "notes", "period"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _qa(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "test_queries")


# -- description -------------------------------------------------------------------------------------------------------


@query(" union all ".join(f"select '{f}' as field, count({f}) as non_null, count(*) - count({f}) as nulls, {S.rounded(f'count({f})::double / count(*)')} as share from test_queries" for f in FIELDS))
def completeness(spark: SparkSession, d: str) -> DataFrame:
    return corpus.completeness(_qa(spark, d), FIELDS)


_SEEN = ["qa_id", *FIELDS, "generated_at"]


@query(" union all ".join(f"select '{f}' as field, count({f}) as records from test_queries having count({f}) > 0" for f in _SEEN))
def fields_seen(spark: SparkSession, d: str) -> DataFrame:
    """The keys that the records have values for, and in how many of them, from the records themselves."""
    return corpus.fields_seen(_qa(spark, d))


@query(f"select question_type as value, count(*) as n, {S.rounded('count(*)::double / (select count(*) from test_queries)')} as share from test_queries group by 1")
def type_distribution(spark: SparkSession, d: str) -> DataFrame:
    return corpus.distribution(_qa(spark, d), "question_type")


_STATE = "case when ground_truths is null then 'null' when len(ground_truths) = 0 then 'empty' else 'populated' end"


@query(f"select {_STATE} as state, case when len(ground_truths) > 0 then len(ground_truths) end as size, count(*) as n from test_queries group by 1, 2")
def truth_partition(spark: SparkSession, d: str) -> DataFrame:
    return corpus.truth_partition(_qa(spark, d))


@query(f"select count(*) as n, min(len(ground_truths)) as least, max(len(ground_truths)) as most, {S.rounded('sum(len(ground_truths))::double / count(*)', 1)} as mean from test_queries where len(ground_truths) > 0")
def truth_sizes(spark: SparkSession, d: str) -> DataFrame:
    return corpus.truth_sizes(_qa(spark, d))


_REFS = "select coalesce(g.ark_id, '') as ark_id, count(*) as n from (select unnest(ground_truths) as g from test_queries) u group by 1"


@query(f"select ark_id, n from ({_REFS}) r where n > 1")
def id_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return corpus.id_references(_qa(spark, d)).where("n > 1")


@query(f"select coalesce(sum(n), 0)::bigint as total, count(*) as unique_ids, count_if(n > 1) as duplicated from ({_REFS}) r")
def id_reference_totals(spark: SparkSession, d: str) -> DataFrame:
    return corpus.reference_totals(corpus.id_references(_qa(spark, d)))


@query("select case when question_type is not null and coalesce(len(ground_truths) > 0, false) then 'full' when coalesce(len(ground_truths) > 0, false) then 'truths_only' when question_type is not null then 'type_only' else 'minimal' end as tier, count(*) as n from test_queries group by 1")
def annotation_tiers(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).groupBy(corpus.annotation_tier().alias("tier")).agg(F.count("*").alias("n"))


def _lengths() -> str:
    parts = []
    for f in ("question", "answer"):
        for unit, x in (("words", f"len({S.tokens(f'coalesce({f}, {S.lit("")})')})"), ("chars", f"length(coalesce({f}, ''))")):
            parts.append(f"select '{f}' as field, '{unit}' as unit, min({x}) as least, max({x}) as most, {S.rounded(f'sum({x})::double / count(*)', 1)} as mean from test_queries")
    return " union all ".join(parts)


@query(_lengths())
def length_stats(spark: SparkSession, d: str) -> DataFrame:
    return corpus.length_stats(_qa(spark, d), ["question", "answer"])


@query(f"select word, count(*) as n from (select lower({S.tokens('question')}[1]) as word from test_queries) w where word is not null group by 1 order by n desc, word limit 5")
def first_word_top(spark: SparkSession, d: str) -> DataFrame:
    return corpus.most_common(corpus.first_words(_qa(spark, d), "question"), "word", 5)


_QA_TEXT = "lower(coalesce(question, '')) || ' ' || lower(coalesce(answer, ''))"
_ERA = "case " + " ".join(f"when len(list_filter({S.listed(ks)}, lambda k: contains(t, k))) > 0 then {S.lit(e)}" for e, ks in ERA_KEYWORDS.items()) + " else 'unclassified' end"


@query(f"select qa_id, {_ERA} as era from (select qa_id, {_QA_TEXT} as t from test_queries) q")
def era_class(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).select("qa_id", corpus.era("question", "answer").alias("era"))


@query(f"select era, count(*) as n, count_if(populated) as with_truths from (select {_ERA} as era, populated from (select {_QA_TEXT} as t, coalesce(len(ground_truths) > 0, false) as populated from test_queries) q) e group by 1")
def era_counts(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d).select(corpus.era("question", "answer").alias("era"), (corpus.truth_state() == "populated").alias("populated"))
    return q.groupBy("era").agg(F.count("*").alias("n"), F.count_if("populated").alias("with_truths"))


@query(f"select qa_id from (select qa_id, {_ERA} as era from (select qa_id, {_QA_TEXT} as t from test_queries) q) e where era like 'WW%' intersect select qa_id from test_queries where len(ground_truths) > 0")
def war_with_truths(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d)
    war = q.where(corpus.era("question", "answer").startswith("WW")).select("qa_id")
    return war.join(q.where("size(ground_truths) > 0").select("qa_id"), "qa_id", "left_semi")


# -- export ------------------------------------------------------------------------------------------------------------

_KEPT = "(select * from (select *, row_number() over (partition by coalesce(question, '') order by qa_id) as rn from test_queries) f where rn = 1 and (period is null or period = '' or period in ('wwi')))"


@query(f"select qa_id, question, period from {_KEPT} k")
def export_pairs(spark: SparkSession, d: str) -> DataFrame:
    return articles.export_pairs(_qa(spark, d), ["wwi"], "qa_id").select("qa_id", "question", "period")


@query(
    "select dimension, value, count(*) as n from (" + " union all ".join(
        f"select '{k}' as dimension, {v} as value from {_KEPT} k" for k, v in (
            ("period", "coalesce(period, 'unknown')"), ("type", "coalesce(question_type, 'unknown')"), ("confidence", "coalesce(confidence, 'unknown')"),
            ("source", "case when contains(coalesce(notes, ''), 'llm') then 'llm' else 'template' end"),
        )
    ) + ") u group by 1, 2"
)
def export_counts(spark: SparkSession, d: str) -> DataFrame:
    return articles.export_counts(articles.export_pairs(_qa(spark, d), ["wwi"], "qa_id"))


# -- generation --------------------------------------------------------------------------------------------------------

_ORDERED = "(select *, row_number() over (order by ark_id, period, full_text_chars, ocr_source, total_segments, war_segments, title, issue_date, newspaper) as o from articles)"
_OPEN = (
    f"(select * from (select *, row_number() over (partition by ark_id order by o) as rn from {_ORDERED} a where len(top_segments) > 0 and ark_id not in "
    "(select distinct replace(g.ark_id, 'commonwealth:', '') from (select unnest(ground_truths) as g from test_queries) u where g.ark_id is not null)) x where rn = 1)"
)
ORDER = ["ark_id", "period", "full_text_chars", "ocr_source", "total_segments", "war_segments", "title", "issue_date", "newspaper"]


def _open_articles(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "articles").withColumn("o", F.struct(*ORDER))
    return articles.unanswered(a, _qa(spark, d), "o").dropDuplicates(["ark_id"])


@query(f"select ark_id, len(top_segments) as segments from {_OPEN} p")
def qa_pending(spark: SparkSession, d: str) -> DataFrame:
    return _open_articles(spark, d).select("ark_id", F.size("top_segments").alias("segments"))


_TEMPLATES = S.listed(t for t, _ in QA_TEMPLATES)
_TYPES = S.listed(t for _, t in QA_TEMPLATES)
_DATE = "coalesce(issue_date, 'unknown date')"


@query(
    f"with p as (select *, row_number() over (order by ark_id) - 1 as n from {_OPEN} p0) select ark_id, replace(replace({_TEMPLATES}[n % 5 + 1], '{{newspaper}}', newspaper), '{{date}}', {_DATE}) as question, "
    f"{_TYPES}[n % 5 + 1] as question_type, title || ', ' || {_DATE} as truth_title, 'commonwealth:' || ark_id as truth_id, "
    f"'Based on the ' || newspaper || ' from ' || {_DATE} || ': ' || substring(top_segments[1].text, 1, 500) || '...' as answer, 'pseudoGT_template | war_score=' || top_segments[1].score || ' | ocr=' || ocr_source as notes, period from p"
)
def template_qa(spark: SparkSession, d: str) -> DataFrame:
    made = articles.template_qa(_open_articles(spark, d), "ark_id")
    g = F.get("ground_truths", F.lit(0))
    return made.select("ark_id", "question", "question_type", g["title"].alias("truth_title"), g["ark_id"].alias("truth_id"), "answer", "notes", "period")


# -- retrieval ---------------------------------------------------------------------------------------------------------

#: The query set: every pair whose id is divisible by 50.
_QUERYSET = "select qa_id as query_id, question from test_queries where qa_id % 50 = 0"
_HITS = (
    f"with q as (select query_id, list_filter(string_split_regex(lower(coalesce(question, '')), '[^\\p{{L}}\\p{{N}}_]+'), lambda w: length(w) > 2) as ks from ({_QUERYSET}) z), "
    "r as (select seq, lower(concat_ws(' ', coalesce(newspaper, ''), coalesce(issue_date, ''), coalesce(raw_text, ''))) as t from issues), "
    "s as (select query_id, seq, len(list_filter(ks, lambda w: contains(t, w))) as score from q, r), "
    "k as (select *, row_number() over (partition by query_id order by score desc, seq) as rank from s where score > 0) select query_id, seq, score, rank from k where rank <= 5"
)


def _queries(spark: SparkSession, d: str) -> DataFrame:
    return _qa(spark, d).where("qa_id % 50 = 0").select(F.col("qa_id").alias("query_id"), "question")


@query(_HITS)
def retrieve_top5(spark: SparkSession, d: str) -> DataFrame:
    return articles.retrieve(_queries(spark, d), table(spark, d, "issues", spread=True))


@query(
    _HITS.replace("select query_id, seq, score, rank from k where rank <= 5", "")
    + ", e as (select query_id, count(*) as records, string_agg('--- Record: ' || coalesce(newspaper, 'Unknown') || ', ' || coalesce(issue_date, 'Unknown date') || ' ---' || chr(10) || 'ark_id: ' || coalesce(record_id, 'N/A') || chr(10) || 'Text excerpt:' || chr(10) || substring(coalesce(raw_text, ''), 1, 2000) || chr(10), chr(10) order by rank) as shown "
    "from k join issues i using (seq) where rank <= 5 group by query_id) "
    f"select z.query_id, coalesce(records, 0) as records, 'Query: ' || coalesce(question, '') || chr(10) || chr(10) || 'Here are the most relevant newspaper excerpts from the newspaper archive:' || chr(10) || chr(10) || coalesce(shown, '') as prompt from ({_QUERYSET}) z left join e on z.query_id = e.query_id"
)
def retrieval_prompts(spark: SparkSession, d: str) -> DataFrame:
    q, r = _queries(spark, d), table(spark, d, "issues", spread=True)
    return articles.excerpts_prompt(articles.retrieve(q, r), q, r)


_LAST = "select question, arg_max(struct_pack(answer := answer, confidence := confidence, notes := notes), qa_id) as s from test_queries where confidence = '{}' group by question"


@query(
    f"with q as (select * from test_queries), st as ({_LAST.format('high')}), md as ({_LAST.format('low')}), j as (select q.qa_id, q.question, q.question_type, coalesce(len(q.ground_truths) > 0, false) as given, q.answer, q.confidence, q.notes, "
    "st.s as a, md.s as b, st.question is not null as has_a, md.question is not null as has_b from q left join st on q.question = st.question left join md on q.question = md.question) "
    "select qa_id, question, question_type, case when given then answer when has_a then a.answer when has_b then coalesce(b.answer, '') else 'No relevant newspaper records found in the dataset for this query.' end as answer, "
    "case when given then confidence when has_a then a.confidence when has_b then coalesce(b.confidence, 'low') else 'low' end as confidence, "
    "case when given then notes when has_a then a.notes when has_b then 'pseudoGT | ' || coalesce(b.notes, 'generated from actual newspaper text') else 'pseudoGT | No matching records in dataset' end as notes, "
    "case when given then 'given' when has_a then 'stored' when has_b then 'generated' else 'none' end as source from j"
)
def merge_answers(spark: SparkSession, d: str) -> DataFrame:
    q = _qa(spark, d)
    told = lambda kind: q.where(f"confidence = '{kind}'").select("question", "answer", "confidence", "notes", F.col("qa_id").alias("at"))
    return articles.merge_answers(q, told("high"), told("low"), "qa_id")


@query(
    f"with p as (select *, row_number() over (order by ark_id) - 1 as n from {_OPEN} p0) select ark_id, case when n % 2 = 0 then 'Q of ' || ark_id else replace(replace({_TEMPLATES}[n % 5 + 1], '{{newspaper}}', newspaper), '{{date}}', {_DATE}) end as question, "
    f"case when n % 2 = 0 then 'explanatory' else {_TYPES}[n % 5 + 1] end as question_type, case when n % 2 = 0 then 'high' else 'medium' end as confidence, "
    "case when n % 2 = 0 then 'pseudoGT_llm | war_score=' else 'pseudoGT_template | war_score=' end || top_segments[1].score || ' | ocr=' || ocr_source as notes from p"
)
def model_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of a stand-in model's fenced answers for every other article, of templates for the rest."""
    opened = _open_articles(spark, d)
    n = articles.numbered(opened.select("ark_id"), "ark_id")
    told = F.concat(F.lit('```json\n{"question": "Q of '), "ark_id", F.lit('", "answer": "A.", "confidence": "high"}\n```'))
    answers = n.select("ark_id", F.when(F.col("n") % 2 == 0, told).otherwise("no answer").alias("answer"))
    return models.pairs_of_answers(opened, answers, "ark_id").select("ark_id", "question", "question_type", "confidence", "notes")


# -- token volume ------------------------------------------------------------------------------------------------------

_PAGES = "greatest(coalesce(page_count, 1), 1)"
_COUNTS = f"select seq, collection, {_PAGES} as page_count, length(coalesce(raw_text, '')) as char_count_actual, len({S.tokens('coalesce(raw_text, ' + S.lit('') + ')')}) as word_count from issues"
_PER_PAGE = (
    f"select *, cast(floor(word_count * 1.3::double) as int) as total_tokens, {S.rounded('floor(word_count * 1.3::double) / page_count', 1)} as tokens_per_page, "
    f"{S.rounded('char_count_actual::double / page_count', 1)} as chars_per_page, {S.rounded('word_count::double / page_count', 1)} as words_per_page from ({_COUNTS}) c"
)


def _per_page(spark: SparkSession, d: str) -> DataFrame:
    return corpus.per_page(table(spark, d, "issues", spread=True), ["seq", "collection"], "raw_text", "page_count")


@query(_PER_PAGE)
def token_cost(spark: SparkSession, d: str) -> DataFrame:
    return _per_page(spark, d)


def _stats(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    ps = ", ".join(f"{S.rounded(f'quantile_cont(v, {p}) / 10', 1)} as {n}" for n, p in (("median", 0.5), ("p5", 0.05), ("p25", 0.25), ("p75", 0.75), ("p95", 0.95)))
    tail = f" group by {by}" if by else ""
    return f"select {lead}count(*) as n, {S.rounded('sum(v) / count(*) / 10', 1)} as mean, {ps}, {S.rounded('min(v) / 10', 1)} as least, {S.rounded('max(v) / 10', 1)} as most from (select {lead}floor(tokens_per_page * 10 + 0.5)::double as v from ({_PER_PAGE}) p) w{tail}"


@query(_stats())
def token_stats(spark: SparkSession, d: str) -> DataFrame:
    return corpus.token_stats(_per_page(spark, d))


@query(_stats("collection"))
def token_stats_by_collection(spark: SparkSession, d: str) -> DataFrame:
    return corpus.token_stats(_per_page(spark, d), ["collection"])


@query(f"select model, price, {S.rounded('mean * price / 1000000', 6)} as per_page, {S.rounded('mean * price / 1000000 * 1000')} as per_1000_pages, {S.rounded('mean * price / 1000000 * 10000')} as per_10000_pages from ({_stats()}) s, (values ('small', 0.02::double), ('large', 0.13::double)) m(model, price)")
def cost_model(spark: SparkSession, d: str) -> DataFrame:
    return corpus.cost_model(corpus.token_stats(_per_page(spark, d)))


@query(f"select coalesce(year[1], 0) as year, p.collection, tokens_per_page, count(*) as issues from ({_PER_PAGE}) p join issues i using (seq) group by 1, 2, 3")
def tokens_by_year(spark: SparkSession, d: str) -> DataFrame:
    """The points of a chart of tokens per page by year and collection, equal ones together."""
    kept = corpus.per_page(table(spark, d, "issues", spread=True), ["seq", "collection", F.coalesce(F.get("year", F.lit(0)), F.lit(0)).alias("year")], "raw_text", "page_count")
    return kept.groupBy("year", "collection", "tokens_per_page").agg(F.count("*").alias("issues"))


@query("select page_count, count(*) as issues from issues where page_count is not null group by 1")
def pages_by_count(spark: SparkSession, d: str) -> DataFrame:
    """The bars of a chart of pages per issue."""
    return table(spark, d, "issues").where("page_count is not null").groupBy("page_count").agg(F.count("*").alias("issues"))


@query(f"select period, coalesce(year[1]::varchar, 'unknown') as year, count(*) as articles, sum(war_segments)::bigint as segments from articles group by 1, 2")
def articles_by_period(spark: SparkSession, d: str) -> DataFrame:
    """Articles by the period and year that their files are named by."""
    a = table(spark, d, "articles")
    return a.groupBy("period", F.coalesce(F.get("year", F.lit(0)).cast("string"), F.lit("unknown")).alias("year")).agg(F.count("*").alias("articles"), F.sum("war_segments").alias("segments"))


