"""Queries on texts: cleaning, quality, vocabulary, segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan.config import PERIOD_KEYWORDS, WHITELIST
from inkspan.operators import articles, quality, vocabulary
from inkspan.plans import sql as S
from inkspan.session import cut_lineage, table
from inkspan.text import clean, metrics, segments
from inkspan.text.classes import text_of

QUERIES: dict = {}
SQL: dict[str, str] = {}
METRICS = list(S.METRICS)
WAR = PERIOD_KEYWORDS["wwi"]
RAW = "coalesce(raw_text, '')"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# -- cleaning ---------------------------------------------------------------------------------------------------------


@query(f"select seq, {S.clean('raw_text')} as text from issues")
def clean_tier1(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issues", spread=True).select("seq", clean.clean_tier1("raw_text").alias("text"))


@query(f"select seq, {S.clean('raw_text', False)} as text from issues")
def clean_eval(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issues", spread=True).select("seq", clean.clean_eval("raw_text").alias("text"))


@query(f"select doc_id, {S.clean_flat('text')} as text from documents")
def clean_flat(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents", spread=True).select("doc_id", clean.clean_flat("text").alias("text"))


@query(f"select seq, raw_text = '' or raw_text is null as skipped, case when raw_text <> '' then {S.clean('raw_text')} else tier_1_cleaned end as tier_1_cleaned from issues")
def record_update(spark: SparkSession, d: str) -> DataFrame:
    """Records with a new cleaned field, empty texts skipped."""
    t = F.col("raw_text")
    return table(spark, d, "issues", spread=True).select("seq", (t.isNull() | (t == "")).alias("skipped"), F.when(t != "", clean.clean_tier1(t)).otherwise(F.col("tier_1_cleaned")).alias("tier_1_cleaned"))


# -- quality ----------------------------------------------------------------------------------------------------------


@query(
    f"select doc_id, {S.junk('text')} as junk, {S.symbols('text')} as symbols, {S.non_alpha('text')[0]} as non_alpha, {S.non_alpha('text')[1]} as alpha_base, "
    f"{S.short('text')[0]} as short, {S.short('text')[1]} as short_base, {S.count('text', S.SOLID + '+')} as tokens, {S.score_columns('text')} from documents"
)
def doc_quality(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "documents", spread=True)
    c = metrics.counts_of("text")
    counted = [c["_junk"].alias("junk"), c["_symbols"].alias("symbols"), c["_non_alpha"].alias("non_alpha"), c["_base"].alias("alpha_base"), c["_short"].alias("short"), c["_lettered"].alias("short_base"), metrics.token_count("text").alias("tokens")]
    return metrics.with_scores(t, ["doc_id", *counted], "text")


_BY_LANG = f"select coalesce(lower(lang), 'und') as lang, {S.score_columns('t')} from (select lang, {S.clean('text')} as t from documents) c"


@query(S.statistics(S.long_form(_BY_LANG, "lang"), "lang"))
def corpus_stats_by_lang(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned documents, metrics by document, statistics by language."""
    cleaned = table(spark, d, "documents", spread=True).select(F.coalesce(F.lower("lang"), F.lit("und")).alias("lang"), clean.clean_tier1("text").alias("t"))
    return quality.corpus_statistics(quality.long_form(quality.score_documents(cleaned, ["lang"], "t"), ["lang"], METRICS), ["lang"])


_TIERS = f"select * from (select 'raw' as tier, {RAW} as t from issues union all select 'tier_1' as tier, {S.clean(RAW)} as t from issues union all select 'stored' as tier, coalesce(tier_1_cleaned, '') as t from issues) u where t <> ''"
_TIER_STATS = S.statistics(S.long_form(f"select tier, {S.score_columns('t')} from ({_TIERS}) t", "tier"), "tier")


def _tiers(spark: SparkSession, d: str) -> DataFrame:
    tiers = {"raw": F.col("raw_text"), "tier_1": clean.clean_tier1(text_of("raw_text")), "stored": F.col("tier_1_cleaned")}
    texts = quality.tier_texts(table(spark, d, "issues", spread=True), tiers, [])
    return quality.corpus_statistics(quality.long_form(quality.score_documents(texts, ["tier"], "text"), ["tier"], METRICS), ["tier"])


@query(_TIER_STATS)
def tier_compare(spark: SparkSession, d: str) -> DataFrame:
    return _tiers(spark, d)


@query(
    f"with s as ({_TIER_STATS}) select metric, {S.rounded(chr(39).join(['case when metric = ', 'composite_score', ' then b - a else a - b end']))} as delta "
    "from (select r.metric, r.mean as a, c.mean as b from s r join s c on r.metric = c.metric where r.tier = 'raw' and c.tier = 'tier_1') j"
)
def tier_delta(spark: SparkSession, d: str) -> DataFrame:
    stats = _tiers(spark, d)
    return quality.delta(stats.where("tier = 'raw'"), stats.where("tier = 'tier_1'"), [])


@query("select 'raw' as tier, coalesce(max(case when length(raw_text) > 0 then 1 else 0 end), 0) = 1 as present from issues union all select 'stored', coalesce(max(case when length(tier_1_cleaned) > 0 then 1 else 0 end), 0) = 1 from issues union all select 'notes', false")
def tiers_present(spark: SparkSession, d: str) -> DataFrame:
    issues = table(spark, d, "issues").withColumn("_none", F.lit(None).cast("string"))
    return quality.present_tiers(issues, {"raw": "raw_text", "stored": "tier_1_cleaned", "notes": "_none"})


@query("select count(*) as total, count_if(coalesce(raw_text, '') <> '') as evaluated, count_if(coalesce(raw_text, '') = '') as skipped from issues")
def text_counters(spark: SparkSession, d: str) -> DataFrame:
    return quality.counters(table(spark, d, "issues"), "raw_text")


@query(f"select metric, cast(least(29, floor(value * 30)) as int) as bin, count(*) as n from ({S.long_form(f'select doc_id, {S.score_columns("text")} from documents', 'doc_id')}) l group by 1, 2")
def rate_histogram(spark: SparkSession, d: str) -> DataFrame:
    long = quality.long_form(quality.score_documents(table(spark, d, "documents", spread=True), ["doc_id"], "text"), ["doc_id"], METRICS)
    return quality.histogram(long, [])


@query()
def cer_wer(spark: SparkSession, d: str) -> DataFrame:
    """Documents that name an issue against that issue's text, raw and cleaned."""
    docs = table(spark, d, "documents", spread=True).where("ark_id is not null").select("doc_id", "ark_id", "text")
    truth = table(spark, d, "issues", spread=True).where("raw_text <> ''").groupBy("ark_id").agg(F.min_by("raw_text", "seq").alias("reference"))
    pairs = docs.join(truth, "ark_id")
    stages = pairs.select("doc_id", F.explode(F.array(F.struct(F.lit("raw").alias("stage"), F.col("text").alias("t")), F.struct(F.lit("cleaned").alias("stage"), clean.clean_tier1("text").alias("t")))).alias("s"), "reference")
    return stages.select("doc_id", "s.stage", quality.cer("s.t", "reference").alias("cer"), quality.wer("s.t", "reference").alias("wer"))


@query()
def texts_evaluated(spark: SparkSession, d: str) -> DataFrame:
    """All documents with their metrics, raw and cleaned, and against the text of the issue they name."""
    docs = table(spark, d, "documents", spread=True).select("doc_id", "ark_id", "text")
    issues = table(spark, d, "issues", spread=True).where("raw_text <> ''").groupBy("ark_id").agg(F.min_by("raw_text", "seq").alias("text"))
    truth = docs.select("doc_id", "ark_id").join(issues, "ark_id").select("doc_id", "text")
    return quality.evaluate(docs.select("doc_id", "text"), truth, "doc_id", docs.select("doc_id", clean.clean_tier1("text").alias("text")))


@query(" union all ".join(f"select '{m}' as metric, count(*) as n, {S.rounded(f'coalesce(sum(cast(floor({m} * 10000 + 0.5) as bigint))::double / count(*) / 10000, 0.0)')} as mean from (select {S.score_columns('text')} from documents) s" for m in METRICS))
def rate_means(spark: SparkSession, d: str) -> DataFrame:
    """Means of the record-level rates over all documents."""
    long = quality.long_form(quality.score_documents(table(spark, d, "documents", spread=True), ["doc_id"], "text"), ["doc_id"], METRICS)
    return quality.corpus_statistics(long, []).select("metric", "n", "mean")


@query(f"select seq, case when seq <= 100 and raw_text <> '' then {S.clean('raw_text')} else raw_text end as text from issues")
def clean_first_records(spark: SparkSession, d: str) -> DataFrame:
    """A limited cleaning run: all records come out, the first hundred cleaned."""
    t = F.col("raw_text")
    return table(spark, d, "issues", spread=True).select("seq", F.when((F.col("seq") <= 100) & (t != ""), clean.clean_tier1(t)).otherwise(t).alias("text"))


# -- vocabulary -------------------------------------------------------------------------------------------------------

_VOCAB = f"select distinct lower(w) as word from (select unnest({S.words('text')}) as w from eval_passages) x where length(w) > 2"
_FREQ = f"select word, n, log10(n::double / (sum(n) over ())::double * 1e9) as zipf from (select lower(w) as word, count(*) as n from (select unnest({S.words('text')}) as w from documents) x group by 1) c"
_WHITE = "select unnest(" + S.listed(WHITELIST) + ") as word"


def _vocab(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.vocabulary(table(spark, d, "eval_passages"), "text")


@query(_VOCAB)
def vocab_build(spark: SparkSession, d: str) -> DataFrame:
    return _vocab(spark, d)


@query(f"select distinct word from ({_VOCAB} union all {_WHITE} union all select 'gazette') u")
def vocab_union(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.union_vocabulary(_vocab(spark, d), extra=["Gazette"])


@query(f"select word, n, {S.rounded('zipf')} as zipf from ({_FREQ}) f")
def word_frequencies(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.word_frequencies(table(spark, d, "documents"), "text").select("word", "n", quality.rounded(F.col("zipf")).alias("zipf"))


_OOV = (
    f"with v as ({_VOCAB}), known as (select word from v union {_WHITE} union select word from ({_FREQ}) f where zipf > 1.5), "
    f"t as (select seq, unnest({S.tokens(RAW)}) as tok from issues), w as (select seq, lower(regexp_replace(tok, '^[^a-zA-Z]+|[^a-zA-Z]+\\z', '', 'g')) as word from t) "
    "select i.seq, coalesce(c.tokens, 0) as tokens, coalesce(c.unknown, 0) as unknown, " + S.rounded(S.ratio("coalesce(c.unknown, 0)", "coalesce(c.tokens, 0)")) + " as oov_rate from issues i left join "
    "(select seq, count(*) as tokens, count_if(length(w.word) > 2 and k.word is null) as unknown from w left join known k on w.word = k.word group by seq) c on i.seq = c.seq"
)


@query(_OOV)
def oov_by_doc(spark: SparkSession, d: str) -> DataFrame:
    """Unknown words of the issues: in neither the vocabulary nor the whitelist nor the corpus of documents."""
    zipf = cut_lineage(vocabulary.word_frequencies(table(spark, d, "documents", spread=True), "text"))
    return vocabulary.oov_rates(table(spark, d, "issues", spread=True), "seq", "raw_text", vocabulary.union_vocabulary(_vocab(spark, d)), zipf)


@query(
    f"with v as ({_VOCAB}), m as (select word from ({_FREQ}) f where zipf > 4.0), c as (select lower(w) as word, count(*) as n from (select unnest({S.words(RAW)}) as w from issues) x group by 1), "
    "k as (select case when m.word is not null then 'modern' when v.word is not null then 'ground_truth' else 'oov' end as class, c.n from c left join m on c.word = m.word left join v on c.word = v.word), "
    "s as (select class, sum(n)::bigint as tokens, count(*) as words from k group by 1), a as (select * from s union all select 'all', sum(tokens)::bigint, sum(words)::bigint from s) "
    "select class, tokens, " + S.rounded("tokens::double / (select sum(tokens) from s)::double") + " as token_ratio, words from a"
)
def token_classes(spark: SparkSession, d: str) -> DataFrame:
    modern = cut_lineage(vocabulary.word_frequencies(table(spark, d, "documents", spread=True), "text").where("zipf > 4.0"))
    return vocabulary.token_classes(table(spark, d, "issues", spread=True), "raw_text", modern, _vocab(spark, d))


@query(f"select word from ({_VOCAB}) v order by word limit 50")
def vocab_sample(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.sorted_sample(_vocab(spark, d))


_CHARS = f"select case when contains({S.lit(S.JUNK)}, ch) then 'junk' else 'other' end as class, ch, count(*) as n from (select unnest({S.found(RAW, '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}' + S.SPACE_IN + ']')}) as ch from issues) x group by 1, 2"


@query(_CHARS)
def special_chars(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.special_characters(table(spark, d, "issues", spread=True), "raw_text")


@query(f"select class, count(*) as unique_chars, sum(n)::bigint as total, string_agg(ch, '' order by ch) as all_chars from ({_CHARS}) c group by 1")
def special_char_summary(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.special_summary(vocabulary.special_characters(table(spark, d, "issues"), "raw_text"))


@query(f"select class, ch, n from ({_CHARS}) c order by n desc, ch limit 10")
def special_chars_top(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.special_characters(table(spark, d, "issues"), "raw_text").orderBy(F.desc("n"), "ch").limit(10)


def _corrections(spark: SparkSession, d: str, distance: int = 1) -> DataFrame:
    zipf = cut_lineage(vocabulary.word_frequencies(table(spark, d, "documents", spread=True), "text"))
    return vocabulary.corrections(table(spark, d, "documents", spread=True), "text", vocabulary.union_vocabulary(_vocab(spark, d)), zipf, threshold=4.3, distance=distance)


#: The words to correct. What isn't ASCII stands in no word of the vocabulary; as it is compared with these only, one byte
#: may stand for it, since the check's edit distance counts bytes.
_CORE = "regexp_extract(tok, '(?s)^([^a-zA-Z]*)(.*?)([^a-zA-Z]*)\\z', 2)"
_WRONG = (
    f"with v as (select distinct word from ({_VOCAB} union all {_WHITE}) u), f as ({_FREQ}), t as (select unnest({S.tokens('text')}) as tok from documents), c as (select distinct {_CORE} as core from t), "
    "w as (select distinct lower(core) as word from c where length(core) > 2 and not regexp_matches(core, '^[A-Z]|[0-9]')), "
    "x as (select w.word, regexp_replace(w.word, '[^\\x01-\\x7f]', '#', 'g') as bytes from w left join v on w.word = v.word left join (select word from f where zipf > 4.3) m on w.word = m.word where v.word is null and m.word is null), "
)
_ONE = _WRONG + (
    "p as (select x.word, v.word as correction, coalesce(f.zipf, 0.0) as zipf from x join v on abs(length(x.bytes) - length(v.word)) <= 1 and damerau_levenshtein(x.bytes, v.word) = 1 left join f on v.word = f.word), "
    "fixed as (select word, arg_min(correction, {'z': -zipf, 'c': correction}) as correction from p group by word) "
)


@query(_ONE + "select * from fixed")
def spell_corrections(spark: SparkSession, d: str) -> DataFrame:
    """Corrections of all words within one edit of the vocabulary."""
    return _corrections(spark, d)


@query()
def spell_corrections_2(spark: SparkSession, d: str) -> DataFrame:
    """Corrections within two edits."""
    return _corrections(spark, d, 2)


_TOKEN = "case when regexp_matches({core}, '^[A-Z]|[0-9]') or m.k[lower({core})] is null then tok else regexp_extract(tok, '(?s)^([^a-zA-Z]*)(.*?)([^a-zA-Z]*)\\z', 1) || m.k[lower({core})] || regexp_extract(tok, '(?s)^([^a-zA-Z]*)(.*?)([^a-zA-Z]*)\\z', 3) end".replace("{core}", _CORE)
_PARTS = S.found("coalesce(text, '')", f"{S.SPACE}+|{S.SOLID}+")


@query(
    _ONE + ", m as (select map_from_entries(list({'k': word, 'v': correction})) as k from fixed), r as (select doc_id, " + _PARTS + f" as parts, list_transform({_PARTS}, lambda tok: {_TOKEN}) as new from documents, m) "
    "select doc_id, array_to_string(new, '') as text, len(list_filter(list_zip(parts, new), lambda z: z[1] <> z[2])) as corrected from r"
)
def spell_corrected_texts(spark: SparkSession, d: str) -> DataFrame:
    return vocabulary.corrected_texts(table(spark, d, "documents", spread=True), "doc_id", "text", _corrections(spark, d))


# -- segments ---------------------------------------------------------------------------------------------------------

_SEG = f"select seq, newspaper, {S.segment_list('f')} as segs from (select seq, newspaper, {S.segments(S.clean(RAW, False))} as f from issues) x"


@query(f"select seq, k as segment_no, segs[k] as segment from (select seq, segs, unnest(range(1, len(segs) + 1)) as k from ({_SEG}) s) y")
def segments_by_issue(spark: SparkSession, d: str) -> DataFrame:
    cut = table(spark, d, "issues", spread=True).select("seq", F.posexplode(segments.segments(clean.clean_eval(text_of("raw_text")))).alias("k", "segment"))
    return cut.select("seq", (F.col("k") + 1).cast("bigint").alias("segment_no"), "segment")


@query(f"select seq, len(list_filter({S.listed(WAR)}, lambda k: contains(lower({RAW}), k))) as hits from issues")
def keyword_hits(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issues", spread=True).select("seq", segments.keyword_score("raw_text", WAR).alias("hits"))


_SCORED = (
    f"select seq, k, seg, len(list_filter({S.listed(WAR)}, lambda w: contains(lower(seg), w))) as score, total from "
    f"(select seq, k, segs[k] as seg, len(segs) as total from (select seq, segs, unnest(range(1, len(segs) + 1)) as k from ({_SEG} where length(raw_text) >= 100) s) y) z"
).replace("from issues) x where length(raw_text) >= 100", "from issues where length(raw_text) >= 100) x")


@query(
    f"with s as ({_SCORED}), r as (select *, row_number() over (partition by seq order by score desc, k) as rank, count(*) over (partition by seq) as war_segments from s where score >= 2) "
    "select seq, rank, seg as segment, score, total as total_segments, war_segments from r where rank <= 5"
)
def war_segments_top5(spark: SparkSession, d: str) -> DataFrame:
    """The best segments of every issue by the keywords of the first period."""
    issues = table(spark, d, "issues", spread=True).withColumn("text", F.col("raw_text")).withColumn("ocr_source", F.lit("api"))
    found = articles.extract_articles(issues.withColumn("record_id", F.col("seq").cast("string")), F.lit("wwi"))
    top = found.select(F.col("record_id").cast("bigint").alias("seq"), F.posexplode("top_segments").alias("k", "s"), "total_segments", "war_segments")
    return top.select("seq", (F.col("k") + 1).alias("rank"), F.col("s.text").alias("segment"), F.col("s.score").alias("score"), "total_segments", "war_segments")


_PERIOD = "case when year[1] between 1914 and 1918 then 'wwi' when year[1] between 1939 and 1945 then 'wwii' when year[1] is not null then 'other' end"
_BY_PERIOD = (
    f"select seq, period, k, len(list_filter(case when period = 'wwii' then {S.listed(PERIOD_KEYWORDS['wwii'])} else {S.listed(WAR)} end, lambda w: contains(lower(seg), w))) as score, total, chars from "
    f"(select seq, period, chars, k, segs[k] as seg, len(segs) as total from (select seq, period, chars, segs, unnest(range(1, len(segs) + 1)) as k from (select seq, period, length(t) as chars, {S.segment_list('f')} as segs from "
    f"(select seq, {_PERIOD} as period, {S.clean(RAW, False)} as t, {S.segments(S.clean(RAW, False))} as f from issues where length(raw_text) >= 100) x) s) y) z"
)


@query(f"select seq, coalesce(period, 'none') as period, any_value(total) as total_segments, count(*) as war_segments, max(score) as best_score, any_value(chars) as full_text_chars from ({_BY_PERIOD}) b where score >= 2 group by 1, 2")
def war_articles(spark: SparkSession, d: str) -> DataFrame:
    """Issues with segments of their period's topic; periods without keywords of their own use the first list."""
    y = F.get("year", F.lit(0))
    period = F.when(y.between(1914, 1918), "wwi").when(y.between(1939, 1945), "wwii").when(y.isNotNull(), "other")
    issues = table(spark, d, "issues", spread=True).withColumn("text", F.col("raw_text")).withColumn("ocr_source", F.lit("api"))
    found = articles.extract_articles(issues.withColumn("record_id", F.col("seq").cast("string")), period)
    return found.select(F.col("record_id").cast("bigint").alias("seq"), F.coalesce("period", F.lit("none")).alias("period"), "total_segments", "war_segments", F.get("top_segments", F.lit(0))["score"].alias("best_score"), "full_text_chars")


_SENT = f"list_filter(list_transform(string_split(replace({RAW}, '. ', '.|'), '|'), lambda s: {S.strip('s')}), lambda s: s <> '')"


@query(f"select seq, len({_SENT}) as sentences, coalesce(list_sum(list_transform({_SENT}, lambda s: length(s))), 0)::bigint as chars from issues")
def sentence_counts(spark: SparkSession, d: str) -> DataFrame:
    s = segments.sentences("raw_text")
    return table(spark, d, "issues").select("seq", F.size(s).alias("sentences"), F.aggregate(s, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("chars"))


#: Groups of sentences: a group is closed once it has more than 400 characters.
_PACK = (
    f"list_reduce(list_transform({_SENT}, lambda t: {{'d': []::varchar[], 'o': '', 'n': 0, 't': t}}), lambda a, b: case when a.n + length(b.t) > 400 "
    "then {'d': list_append(a.d, case when a.o = '' then b.t else a.o || ' ' || b.t end), 'o': '', 'n': 0, 't': ''} "
    "else {'d': a.d, 'o': case when a.o = '' then b.t else a.o || ' ' || b.t end, 'n': a.n + length(b.t), 't': ''} end, {'d': []::varchar[], 'o': '', 'n': 0, 't': ''})"
)
_PACKS = f"select seq, case when f.o = '' then f.d else list_append(f.d, f.o) end as packs from (select seq, {_PACK} as f from issues) x"


@query(f"select seq, (k - 1)::int as pack_no, packs[k] as pack from (select seq, packs, unnest(range(1, len(packs) + 1)) as k from ({_PACKS}) p) y")
def sentence_packs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issues", spread=True).select("seq", F.posexplode(segments.packed_sentences("raw_text")).alias("pack_no", "pack"))


#: Chunks one after the other: at most 1,500 characters, cut at the last space, which goes; without one, at 1,500.
_CHUNKS = (
    "with recursive r as (select seq, raw_text as rest, -1 as no, '' as chunk from issues where raw_text <> '' union all "
    "select seq, case when length(rest) <= 1500 then '' when cut = 0 then substring(rest, 1501) else substring(rest, cut + 1) end, no + 1, "
    "case when length(rest) <= 1500 then rest when cut = 0 then substring(rest, 1, 1500) else substring(rest, 1, cut - 1) end "
    "from (select *, case when contains(head, ' ') then 1501 - instr(reverse(head), ' ') else 0 end as cut from (select *, substring(rest, 1, 1500) as head from r where rest <> '') h) c) "
)


@query(_CHUNKS + "select seq, no as chunk_no, chunk from r where no >= 0")
def text_chunks(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issues").select("seq", F.posexplode(segments.chunks("raw_text")).alias("chunk_no", "chunk"))
