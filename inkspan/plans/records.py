"""Queries on records: dates, listings, deduplication, envelopes, manifests, streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from inkspan import sinks
from inkspan.operators import articles, records
from inkspan.session import cut_lineage, table
from inkspan.sources import files
from inkspan.streaming import ingest

_schema = _parse_datatype_string

QUERIES: dict = {}
SQL: dict[str, str] = {}

_YEAR = "coalesce(year[1], try_cast(substring(date_start, 1, 4) as int), 0)"
_DAY = "coalesce(nullif(substring(date_iso[1], 1, 10), ''), nullif(substring(date_start, 1, 10), ''), 'unknown')"
_IDS = "(select g.generated_at, r.id, r.newspaper, r.collection from (select generated_at, unnest(records) as r from id_envelopes) g)"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query(f"select seq, replace(record_id, 'commonwealth:', '') as ark_id, {_YEAR} as year, {_DAY} as day, replace(concat_ws('_', newspaper, collection), ' ', '_') as folder from issues")
def record_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issues").select("seq", records.short_id("record_id").alias("ark_id"), records.year_of().alias("year"), records.day_of().alias("day"), records.folder_name("newspaper", "collection").alias("folder"))


@query("select seq, coalesce(try_cast(try_strptime(x, '%Y-%m-%d') as date), try_cast(try_strptime(x || '-01', '%Y-%m-%d') as date), try_cast(try_strptime(x || '-01-01', '%Y-%m-%d') as date)) as day from (select seq, date_iso[1] as x from issues) i")
def edtf_dates(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issues").select("seq", records.edtf_date(F.get("date_iso", F.lit(0))).alias("day"))


@query(f"select day as date, min(year) as year, count(*) as total, count(distinct record_id) as records from (select {_DAY} as day, {_YEAR} as year, record_id from issues) i group by 1")
def by_day(spark: SparkSession, d: str) -> DataFrame:
    return records.by_day(table(spark, d, "issues"))


@query(f"select {_YEAR} as year, count(*) as total, sum(char_count)::bigint as chars from issues group by 1")
def by_year(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issues").groupBy(records.year_of().alias("year")).agg(F.count("*").alias("total"), F.sum("char_count").alias("chars"))


@query("select seq, date_start, newspaper from issues where starts_with(date_start, '194') and contains(lower(newspaper), 'mirror')")
def read_by_date(spark: SparkSession, d: str) -> DataFrame:
    return records.read_by_date(table(spark, d, "issues"), "194", "Mirror").select("seq", "date_start", "newspaper")


@query("select substring(date_start, 1, 10) as date, count(*) as issues from issues where substring(date_start, 1, 7) = '1917-05' and length(substring(date_start, 1, 10)) = 10 group by 1 order by 1 limit 10")
def nearby_dates(spark: SparkSession, d: str) -> DataFrame:
    return records.nearby_dates(table(spark, d, "issues"), "1917-05-31")


@query(
    "with t as (select substring(date_start, 1, 10) as d from issues where coalesce(substring(date_start, 1, 10), '') <> ''), u as (select substring(d, 1, 4) as year, substring(d, 6, 2) as month, d from t) "
    "select year, month, count(*) as issues, count(distinct d) as dates, substring(min(d), 9, 2) as first_day, substring(max(d), 9, 2) as last_day from u group by grouping sets ((year, month), (year))"
)
def date_listing(spark: SparkSession, d: str) -> DataFrame:
    return records.list_dates(table(spark, d, "issues"))


@query(
    "with t as (select substring(date_start, 1, 10) as d from issues where substring(date_start, 1, 4) = '1917'), u as (select substring(d, 1, 4) as year, substring(d, 6, 2) as month, d from t) "
    "select year, month, count(*) as issues, count(distinct d) as dates, substring(min(d), 9, 2) as first_day, substring(max(d), 9, 2) as last_day from u group by grouping sets ((year, month), (year))"
)
def date_listing_year(spark: SparkSession, d: str) -> DataFrame:
    return records.list_dates(table(spark, d, "issues"), "1917")


@query("select coalesce(newspaper, 'unknown') as newspaper, count(*) as issues from issues group by 1 order by issues desc")
def count_by_newspaper(spark: SparkSession, d: str) -> DataFrame:
    return records.count_by_newspaper(table(spark, d, "issues")).orderBy(F.desc("issues"), "newspaper")


@query("select count(*) as records, min(nullif(substring(date_start, 1, 10), '')) as first_date, max(nullif(substring(date_start, 1, 10), '')) as last_date, coalesce(sum(char_count), 0)::bigint as characters from issues")
def dataset_summary(spark: SparkSession, d: str) -> DataFrame:
    return records.summary(table(spark, d, "issues"))


@query("select seq, record_id from (select seq, record_id, row_number() over (partition by record_id order by seq) as n from issues) i where n = 1")
def first_dedupe(spark: SparkSession, d: str) -> DataFrame:
    """The first delivery of each record."""
    return records.first_by(table(spark, d, "issues"), "record_id", "seq").select("seq", "record_id")


@query(f"select id, newspaper, collection from {_IDS} i")
def envelope_unwrap(spark: SparkSession, d: str) -> DataFrame:
    return records.unwrap(table(spark, d, "id_envelopes"))


@query(f"select count(*) as ids, count(distinct id) as distinct_ids, (select sum(total)::bigint from id_envelopes) as stated from {_IDS} i")
def id_totals(spark: SparkSession, d: str) -> DataFrame:
    listed = records.unwrap(table(spark, d, "id_envelopes")).agg(F.count("*").alias("ids"), F.countDistinct("id").alias("distinct_ids"))
    return listed.crossJoin(table(spark, d, "id_envelopes").agg(F.sum("total").alias("stated")))  # a row each


@query(f"select distinct id from {_IDS} i where id is not null and not exists (select 1 from issues s where s.record_id = i.id)")
def pending_ids(spark: SparkSession, d: str) -> DataFrame:
    """Listed ids that were never ingested."""
    ids = records.unwrap(table(spark, d, "id_envelopes")).where("id is not null").select("id").distinct()
    return records.pending(ids, table(spark, d, "issues").select(F.col("record_id").alias("id")), "id")


@query("select record_id, newspaper from issues union all select 'commonwealth:' || ark_id, newspaper from articles")
def append_union(spark: SparkSession, d: str) -> DataFrame:
    more = table(spark, d, "articles").select(F.concat(F.lit("commonwealth:"), "ark_id").alias("record_id"), "newspaper")
    return records.append(table(spark, d, "issues").select("record_id", "newspaper"), more)


@query("select distinct ark_id from issues where raw_text <> '' intersect select ark_id from page_manifests")
def scanned_and_transcribed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issues").where("raw_text <> ''").select("ark_id").intersect(table(spark, d, "page_manifests").select("ark_id"))


@query(
    "with c as (select ark_id, unnest(sequences[1].canvases) as v, generate_subscripts(sequences[1].canvases, 1) as k from page_manifests), "
    "u as (select ark_id, k, coalesce(nullif(v.images[1].resource.service.\"@id\", ''), nullif(v.images[1].resource.\"@id\", '')) as image from c) "
    "select ark_id, row_number() over (partition by ark_id order by k) as page_no, image, case when contains(image, '/full/') then image else image || '/full/1500,/0/default.jpg' end as url from u where image is not null"
)
def page_urls(spark: SparkSession, d: str) -> DataFrame:
    pages = records.manifest_pages(table(spark, d, "page_manifests"))
    return pages.withColumn("url", records.image_url("image"))


@query("select ark_id, year, seq from (select *, row_number() over (partition by year_of, newspaper order by seq) as n from (select seq, ark_id, newspaper, " + _YEAR + " as year_of, " + _YEAR + " as year from issues) i) x where n <= 2")
def sample_first_n(spark: SparkSession, d: str) -> DataFrame:
    """The first two issues of each newspaper and year, in source order."""
    keyed = table(spark, d, "issues").select("seq", "ark_id", "newspaper", records.year_of().alias("year"))
    return records.sample_first(keyed, ["newspaper", "year"], 2, "seq").select("ark_id", "year", "seq")


_DRAW = "row_number() over (partition by collection, yr order by md5('42:' || seq), seq)"


@query(f"select seq, collection, yr as year from (select *, {_DRAW} as n from (select seq, collection, {_YEAR} as yr from issues) i) x where n = 1")
def sample_seeded(spark: SparkSession, d: str) -> DataFrame:
    keyed = table(spark, d, "issues").select("seq", "collection", records.year_of().alias("year"))
    return records.sample_one(keyed, ["collection", "year"], "seq").select("seq", "collection", "year")


@query("select seq, k as page_no, lower(split_part(p, '.', 2)) as suffix, case when lower(p) like '%.png' then 'image/png' else 'image/jpeg' end as mime from (select seq, unnest(pages) as p, generate_subscripts(pages, 1) as k from issues) x where p is not null")
def image_mimes(spark: SparkSession, d: str) -> DataFrame:
    """The media type of every page's image."""
    pages = table(spark, d, "issues").select("seq", F.posexplode("pages").alias("at", "p")).where("p is not null")
    return pages.select("seq", (F.col("at") + 1).cast("bigint").alias("page_no"), F.lower(F.split_part("p", F.lit("."), F.lit(2))).alias("suffix"), records.image_mime("p").alias("mime"))


_FIELDS = ["title", "issue_date", "date_start", "source_url", "iiif_manifest", "institution"]
_LISTS = {"date_iso": True, "publisher": True, "place": True, "language": True, "topics": False, "geography": False}


@query(
    "select record_id, replace(record_id, 'commonwealth:', '') as ark_id, newspaper, collection, coalesce(raw_text, '') as raw_text, coalesce(year, []::int[]) as year, coalesce(pages, []::varchar[]) as pages, "
    "len(coalesce(pages, []::varchar[])) as page_count, length(coalesce(raw_text, '')) as char_count, " + ", ".join(f"coalesce({f}, '') as {f}" for f in _FIELDS) + ", "
    + ", ".join(f"coalesce({f}, {'[' + chr(39) * 2 + ']' if one else '[]::varchar[]'}) as {f}" for f, one in _LISTS.items())
    + " from issues where length(coalesce(raw_text, '')) >= 50 and page_count > 0"
)
def metadata_projection(spark: SparkSession, d: str) -> DataFrame:
    """The record fields from API attributes, of transcribed records with enough text; all but the time of the run."""
    attributes = F.struct(
        (F.col("page_count") > 0).alias("has_transcription_bsi"), F.col("title").alias("title_info_primary_tsi"), F.col("issue_date").alias("title_info_partnum_tsi"), F.col("date_iso").alias("date_edtf_ssm"),
        F.col("date_start").alias("date_start_dtsi"), F.col("year").alias("date_facet_yearly_itim"), F.col("pages").alias("filenames_ssim"), F.col("source_url").alias("identifier_uri_ss"), F.col("iiif_manifest").alias("identifier_iiif_manifest_ss"),
        F.col("institution").alias("institution_name_ssi"), F.col("publisher").alias("publisher_tsim"), F.col("place").alias("publication_place_tsim"), F.col("language").alias("language_ssim"), F.col("topics").alias("subject_topic_tsim"),
        F.col("geography").alias("subject_geographic_ssim"),
    )
    api = table(spark, d, "issues").select("record_id", "newspaper", "collection", "raw_text", attributes.alias("attributes"))
    return records.project_metadata(records.transcribed(api)).drop("ingested_at")


@query()
def issues_rendered(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "issues").select("seq", records.render_issue(full=True).alias("shown"), records.render_issue().alias("preview"))


@query(
    "select ark_id, string_agg(page, chr(10) || chr(10) || '--- PAGE BREAK ---' || chr(10) || chr(10) order by k) as text from "
    "(select ark_id, k, coalesce(parts[k], '') as page from (select ark_id, string_split(raw_text, chr(10) || chr(10)) as parts, unnest(range(1, len(string_split(raw_text, chr(10) || chr(10))) + 1)) as k from (select ark_id, arg_min(raw_text, seq) as raw_text from issues where raw_text is not null group by 1) o) p) q group by 1"
)
def pages_joined(spark: SparkSession, d: str) -> DataFrame:
    """The blocks of each issue's first text as pages, joined by the page-break line."""
    first = table(spark, d, "issues").where("raw_text is not null").groupBy("ark_id").agg(F.min_by("raw_text", "seq").alias("raw_text"))
    return records.join_pages(first.select("ark_id", F.posexplode(F.split("raw_text", "\n\n")).alias("page_no", "text")))


@query("select seq, coalesce(a.ark_id is not null, false) as extracted, case when a.ark_id is not null then 'dots.ocr' else 'api' end as ocr_source, length(coalesce(case when a.ark_id is not null then a.text else i.raw_text end, '')) as chars from issues i left join (select ark_id, any_value(top_segments[1].text) as text from (select distinct on (ark_id) ark_id, top_segments from articles order by ark_id, full_text_chars, ocr_source) z group by 1) a on i.ark_id = a.ark_id")
def ocr_source_prefer(spark: SparkSession, d: str) -> DataFrame:
    """Issues with the page model's text where an article has one."""
    firsts = table(spark, d, "articles").groupBy("ark_id").agg(F.min_by("top_segments", F.struct("full_text_chars", "ocr_source")).alias("s"))
    vlm = firsts.select("ark_id", F.get("s", F.lit(0))["text"].alias("text"))
    out = articles.prefer_ocr(table(spark, d, "issues").select("seq", "ark_id", "raw_text"), vlm)
    return out.select("seq", (F.col("ocr_source") == "dots.ocr").alias("extracted"), "ocr_source", F.length(F.coalesce("text", F.lit(""))).alias("chars"))


# -- event stream ------------------------------------------------------------------------------------------------------


@query("select event_type, time_bucket(interval 1 hour, ts, timestamp '1970-01-01') as start, count(*) as events, count(distinct user_id) as users from events group by 1, 2")
def events_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Events by type and hour: what the stream of inkspan.streaming gives when it has seen all."""
    e = table(spark, d, "events")
    return e.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users")).select("event_type", F.col("w.start").alias("start"), "events", "users")


@query("select event_id, try_cast(json_extract_string(props, '$.k') as int) as k from events")
def event_props(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("select event_type, count(*) as events from (select event_type from events) e group by 1")
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Events read as a stream to its end into a checkpointed table, counted from there."""
    return ingest.ingest_all(spark, f"{d}/events.parquet").groupBy("event_type").agg(F.count("*").alias("events"))


@query("select event_type, start, count(*) as events from (select event_type, unnest([time_bucket(interval 15 minutes, ts, timestamp '1970-01-01') - k * interval 15 minutes for k in range(4)]) as start from events) w group by 1, 2")
def events_sliding(spark: SparkSession, d: str) -> DataFrame:
    """Events by type and hours that begin every quarter of an hour."""
    return ingest.sliding(table(spark, d, "events"))


_GAPS = "select user_id, ts, case when ts >= lag(ts) over (partition by user_id order by ts) + interval 30 minutes or lag(ts) over (partition by user_id order by ts) is null then 1 else 0 end as fresh from events"


@query(f"select user_id, min(ts) as start, max(ts) + interval 30 minutes as \"end\", count(*) as events from (select *, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as s from ({_GAPS}) g) x group by user_id, s")
def event_sessions(spark: SparkSession, d: str) -> DataFrame:
    """The sessions of every user."""
    return ingest.sessions(table(spark, d, "events"))


@query("select event_type, time_bucket(interval 1 hour, ts, timestamp '1970-01-01') as start, count(*) as events from events group by 1, 2 having start + interval 1 hour <= (select max(ts) from events) - interval 2 hours")
def stream_hourly(spark: SparkSession, d: str) -> DataFrame:
    """Events by type and hour from a stream: the hours that the watermark has closed."""
    return ingest.run_windows(spark, f"{d}/events.parquet", ingest.hourly)


@query(f"select user_id, start, \"end\", events from (select user_id, min(ts) as start, max(ts) + interval 30 minutes as \"end\", count(*) as events from (select *, sum(fresh) over (partition by user_id order by ts rows unbounded preceding) as s from ({_GAPS}) g) x group by user_id, s) y where \"end\" <= (select max(ts) from events) - interval 2 hours")
def stream_sessions(spark: SparkSession, d: str) -> DataFrame:
    """Users' sessions from a stream: those that the watermark has closed."""
    return ingest.run_windows(spark, f"{d}/events.parquet", lambda s: ingest.sessions(s, late="2 hours"))


@query("select event_id, event_type from events")
def stream_log(spark: SparkSession, d: str) -> DataFrame:
    """Events delivered twice as a log of batches, the current rows read from it."""
    folder = ingest.shared_folder(spark)
    twice = ingest.file_stream(spark, f"{d}/events.parquet").select("event_id", "event_type", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    ingest.log_batches(twice, f"{folder}/table", f"{folder}/log")
    return ingest.current(spark, f"{folder}/table", "event_id", "delivery").select("event_id", "event_type")


# -- files: written, and read again -----------------------------------------------------------------------------------


@query("select seq, newspaper, title, raw_text, language from issues")
def jsonl_strict(spark: SparkSession, d: str) -> DataFrame:
    """Records through JSON lines."""
    path = f"{ingest.shared_folder(spark)}/lines"
    kept = table(spark, d, "issues").select("seq", "newspaper", "title", "raw_text", "language")
    sinks.write_jsonl(kept, path)
    return files.read_jsonl(spark, path, kept.schema)


@query("select count(*) as lines, count_if(seq % 7 = 0) as malformed, sum(case when seq % 7 <> 0 then seq end)::bigint as total from issues")
def jsonl_tolerant(spark: SparkSession, d: str) -> DataFrame:
    """JSON lines of which every seventh breaks off: these are counted, the others read."""
    path = f"{ingest.shared_folder(spark)}/lines"
    line = F.to_json(F.struct("seq", "newspaper"))
    broken = F.when(F.col("seq") % 7 == 0, F.substring(line, F.lit(1), F.length(line) - 3)).otherwise(line)
    table(spark, d, "issues").select(broken.alias("value")).write.text(path)
    return cut_lineage(files.read_jsonl(spark, path, _schema("seq bigint, newspaper string"), strict=False)).agg(F.count("*").alias("lines"), F.count_if(F.col("_corrupt").isNotNull()).alias("malformed"), F.sum(F.when(F.col("_corrupt").isNull(), F.col("seq"))).alias("total"))


def _envelopes(spark: SparkSession, d: str) -> str:
    """Every envelope as a JSON file of its own; of those with records, every other one as a bare list."""
    path = f"{ingest.shared_folder(spark)}/envelopes"
    e = table(spark, d, "id_envelopes")
    key = F.md5(F.to_json(F.struct(*e.columns)))
    bare = (F.conv(F.substring(key, 1, 1), 16, 10).cast("int") % 2 == 0) & (F.size("records") > 0)
    e.select(key.alias("k"), F.when(bare, F.to_json("records")).otherwise(F.to_json(F.struct(*e.columns))).alias("value")).repartition("k").write.partitionBy("k").text(path)
    return path


@query(f"select id, newspaper, collection from {_IDS} i where id is not null or newspaper is not null or collection is not null")
def envelope_files(spark: SparkSession, d: str) -> DataFrame:
    """Records of files that are an envelope or a bare list."""
    schema = table(spark, d, "id_envelopes").schema
    record = schema["records"].dataType.elementType
    envelope = StructType([f for f in schema.fields if f.name in ("generated_at", "date_start", "date_end", "total")])
    return files.read_records(spark, f"{_envelopes(spark, d)}/*", record, envelope).select("id", "newspaper", "collection")


@query("select item_id::varchar as doc_id, coalesce(text, '') as text from eval_passages")
def text_folder(spark: SparkSession, d: str) -> DataFrame:
    """Passages through a folder of text files."""
    folder = f"{ingest.shared_folder(spark)}/texts"
    sinks.write_texts(table(spark, d, "eval_passages"), "item_id", "text", folder)
    return files.read_texts(spark, folder)


@query("select row_number() over (order by item_id) as line_no, replace(replace(text, chr(10), ' '), chr(13), ' ') as line from eval_passages")
def numbered_lines(spark: SparkSession, d: str) -> DataFrame:
    """Passages as lines of files, numbered as they are read."""
    folder = f"{ingest.shared_folder(spark)}/lines"
    rows = table(spark, d, "eval_passages").select("item_id", F.translate(F.col("text"), "\n\r", "  ").alias("value"))
    rows.repartitionByRange(4, "item_id").sortWithinPartitions("item_id").select("value").write.text(folder)
    return files.read_lines(spark, folder)


@query(f"select year_part, date_part, count(*) as records, sum(length(raw_text))::bigint as chars from (select {_YEAR} as year_part, {_DAY} as date_part, raw_text from issues) i group by 1, 2")
def day_files(spark: SparkSession, d: str) -> DataFrame:
    """Records by day, written twice, the second time one newspaper's days anew, and read by partition."""
    path = f"{ingest.shared_folder(spark)}/days"
    issues = table(spark, d, "issues").select("seq", "record_id", "newspaper", "year", "date_iso", "date_start", "raw_text")
    sinks.write_by_day(issues, path)
    again = issues.withColumn("_d", records.day_of()).withColumn("_y", records.year_of())
    days = again.where("seq % 10 = 0").select("_d", "_y").distinct()
    sinks.write_by_day(again.join(days, ["_d", "_y"], "left_semi").drop("_d", "_y"), path)
    read = spark.read.schema(StructType([*issues.schema.fields, *_schema("year_part int, date_part string").fields])).parquet(path)
    return read.groupBy("year_part", "date_part").agg(F.count("*").alias("records"), F.sum(F.length("raw_text")).alias("chars"))


@query(f"select {_YEAR} as year_part, count(*) * 2 as records from issues group by 1")
def year_files(spark: SparkSession, d: str) -> DataFrame:
    """Records appended by year, twice."""
    path = f"{ingest.shared_folder(spark)}/years"
    issues = table(spark, d, "issues").select("seq", "record_id", "year", "date_start")
    for _ in range(2):
        sinks.append_by_year(issues, path)
    return spark.read.parquet(path).groupBy("year_part").agg(F.count("*").alias("records"))


@query("select period, coalesce(year[1]::varchar, 'unknown') as year, count(*) as articles from articles group by 1, 2")
def article_files(spark: SparkSession, d: str) -> DataFrame:
    """Articles by the period and year of their files."""
    path = f"{ingest.shared_folder(spark)}/articles"
    sinks.write_articles(table(spark, d, "articles"), path)
    read = spark.read.option("inferSchema", False).parquet(path)
    return read.groupBy(F.col("period_part").alias("period"), F.col("year_part").cast("string").alias("year")).agg(F.count("*").alias("articles"))


@query("select count(*) as files, count_if(ends_with(ark_id, '0')) as ending_in_0 from (select distinct ark_id from page_manifests where ark_id is not null) m")
def discovered_files(spark: SparkSession, d: str) -> DataFrame:
    """One small file for each manifest, found again by name."""
    folder = f"{ingest.shared_folder(spark)}/marks"
    marks = table(spark, d, "page_manifests").where("ark_id is not null").select("ark_id", F.lit("x").alias("t")).distinct()
    sinks.write_texts(marks, "ark_id", "t", folder)
    found = files.discover(spark, folder, r"\.txt$")
    return found.agg(F.count("*").alias("files"), F.count_if(F.col("path").rlike(r"0\.txt$")).alias("ending_in_0"))


@query("select period, count(*) as articles, sum(war_segments)::bigint as segments from articles where period in ('wwi', 'wwii') group by 1")
def article_files_period(spark: SparkSession, d: str) -> DataFrame:
    """Articles of the files of some periods; others aren't opened, since the period is a folder."""
    path = f"{ingest.shared_folder(spark)}/articles"
    sinks.write_articles(table(spark, d, "articles"), path)
    found = spark.read.parquet(path).where(F.col("period_part").isin("wwi", "wwii"))
    return found.groupBy(F.col("period_part").alias("period")).agg(F.count("*").alias("articles"), F.sum("war_segments").alias("segments"))


@query("select coalesce(newspaper, 'unknown') as newspaper, count(*) as issues from issues group by 1")
def report_file(spark: SparkSession, d: str) -> DataFrame:
    """Counts by newspaper through a report, one indented JSON file."""
    counts = records.count_by_newspaper(table(spark, d, "issues"))
    path = f"{ingest.shared_folder(spark)}/report.json"
    sinks.write_report(counts, path)
    return files.read_json(spark, path, counts.schema)
