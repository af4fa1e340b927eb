"""Records of issues: ids, dates, listings, deduplication, manifests."""

from __future__ import annotations

import textwrap

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkspan.config import ID_PREFIX
from inkspan.session import ship_package
from inkspan.text.classes import c
from inkspan.text.segments import packed

# -- scalars ---------------------------------------------------------------------------------------------------------


def short_id(x) -> Column:
    """The id without any occurrence of the prefix."""
    return F.replace(c(x), F.lit(ID_PREFIX), F.lit(""))


def folder_name(*parts) -> Column:
    """Parts joined by underscores, spaces replaced likewise."""
    return F.replace(F.concat_ws("_", *[c(p) for p in parts]), F.lit(" "), F.lit("_"))


def year_of(years="year", date_start="date_start") -> Column:
    """First of the years, else the first four characters of the date where they are a number, else 0."""
    return F.coalesce(F.get(c(years), F.lit(0)), F.substring(c(date_start), 1, 4).try_cast("int"), F.lit(0))


def day_of(date_iso="date_iso", date_start="date_start") -> Column:
    """First ten characters of the first ISO date, else of the start date, else ``unknown``."""
    first = F.nullif(F.substring(F.get(c(date_iso), F.lit(0)), 1, 10), F.lit(""))
    return F.coalesce(first, F.nullif(F.substring(c(date_start), 1, 10), F.lit("")), F.lit("unknown"))


def edtf_date(x) -> Column:
    """A date of a year, month or day in ISO form, the missing parts being 1; null where it is none of these."""
    x = c(x)
    return F.coalesce(*[F.try_to_date(F.concat(x, F.lit(rest)), "yyyy-MM-dd") for rest in ("", "-01", "-01-01")])


# -- filters and listings --------------------------------------------------------------------------------------------


def read_by_date(df: DataFrame, prefix: str, paper: str | None = None, date_col: str = "date_start", paper_col: str = "newspaper") -> DataFrame:
    """Records whose date begins so and, if given, whose newspaper contains paper in any case."""
    out = df.where(F.startswith(F.col(date_col), F.lit(prefix)))
    return out.where(F.contains(F.lower(paper_col), F.lit(paper.lower()))) if paper else out


def nearby_dates(df: DataFrame, date: str, limit: int = 10, date_col: str = "date_start") -> DataFrame:
    """(date, issues): the first dates of the same month in the same form, for a date that has no issues."""
    day = F.substring(date_col, 1, 10)
    found = df.where((F.substring(date_col, 1, 7) == date[:7]) & (F.length(day) == len(date)))
    return found.groupBy(day.alias("date")).agg(F.count("*").alias("issues")).orderBy("date").limit(limit)


def list_dates(df: DataFrame, year: str | None = None, date_col: str = "date_start") -> DataFrame:
    """(year, month, issues, dates, first_day, last_day) by month and, with a null month, by year.

    issues counts records, dates distinct dates; records without a date don't count.
    """
    day = F.substring(date_col, 1, 10)
    dated = df.select(day.alias("d")).where("d <> ''").select("d", F.substring("d", 1, 4).alias("year"), F.substring("d", 6, 2).alias("month"))
    if year:
        dated = dated.where(F.col("year") == year)
    # one row for each date: the counts of both levels come from it
    by_day = dated.groupBy("year", "month", "d").agg(F.count("*").alias("n"))
    sums = [F.sum("n").alias("issues"), F.count("*").alias("dates"), F.substring(F.min("d"), 9, 2).alias("first_day"), F.substring(F.max("d"), 9, 2).alias("last_day")]
    months = by_day.groupBy("year", "month").agg(*sums)
    return months.unionByName(by_day.groupBy("year").agg(*sums).withColumn("month", F.lit(None).cast("string")))


def count_by_newspaper(df: DataFrame, col: str = "newspaper") -> DataFrame:
    return df.groupBy(F.coalesce(F.col(col), F.lit("unknown")).alias(col)).agg(F.count("*").alias("issues"))


def summary(df: DataFrame, date_col: str = "date_start", chars_col: str = "char_count") -> DataFrame:
    """One row: records, first and last date, characters in millions (as an exact decimal)."""
    dates = F.nullif(F.substring(date_col, 1, 10), F.lit(""))
    return df.agg(
        F.count("*").alias("records"), F.min(dates).alias("first_date"), F.max(dates).alias("last_date"),
        F.coalesce(F.sum(F.col(chars_col).cast("bigint")), F.lit(0)).alias("characters"),
    )


def by_day(df: DataFrame) -> DataFrame:
    """(date, year, total, record_ids): the records of each day, as the day files hold them."""
    kept = df.select(day_of().alias("date"), year_of().alias("year"), "record_id")
    return kept.groupBy("date").agg(F.min("year").alias("year"), F.count("*").alias("total"), F.countDistinct("record_id").alias("records"))


# -- deduplication, pending work -------------------------------------------------------------------------------------


def first_by(df: DataFrame, keys, order) -> DataFrame:
    """The first row of each key. Only the order's minimum is shuffled, combined within partitions first; the rows
    then come back by a semi join, so no window sorts a key with very many rows."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    firsts = df.groupBy(*keys).agg(F.min(order).alias("_first"))
    match = [F.col(f"a.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
    on = match[0]
    for m in match[1:]:
        on &= m
    return df.alias("a").join(firsts.alias("b"), on & (F.col(f"a.`{order}`") == F.col("b._first")), "left_semi")


def pending(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key isn't among those done."""
    return df.join(done.select(key).distinct(), key, "left_anti")


def append(old: DataFrame, new: DataFrame) -> DataFrame:
    """Bag union by column names; columns of one side only are null on the other."""
    return old.unionByName(new, allowMissingColumns=True)


def sample_first(df: DataFrame, by: list[str], n: int, order: str) -> DataFrame:
    """The first n rows of each group in source order. A sampling operator: the limit is its purpose."""
    w = Window.partitionBy(*by).orderBy(order)
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def sample_one(df: DataFrame, by: list[str], key: str, seed: int = 42) -> DataFrame:
    """One row of each group, drawn by the hash of seed and key; the key breaks ties."""
    draw = F.struct(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), F.col(key))
    best = df.groupBy(*by).agg(F.min(draw).alias("_best")).select(*by, F.col("_best")[key].alias(key))
    return df.join(best, [*by, key], "left_semi")


# -- envelopes, manifests, API records -------------------------------------------------------------------------------


def unwrap(df: DataFrame, records: str = "records") -> DataFrame:
    """The records of envelopes; an envelope of null or no records has none. A column that is no array raises."""
    if not df.schema[records].dataType.typeName() == "array":
        raise ValueError(f"{records} holds no list of records")
    return df.select(F.explode(records).alias("r")).select("r.*")


def manifest_pages(df: DataFrame, id_col: str = "ark_id", sequences: str = "sequences") -> DataFrame:
    """(id, page_no, image): the images of the first sequence's canvases; the service's id before the resource's,
    canvases without either left out before numbering."""
    canvases = F.get(F.col(sequences), F.lit(0))["canvases"]
    resource = lambda v: F.get(v["images"], F.lit(0))["resource"]
    image = lambda v: F.coalesce(F.nullif(resource(v)["service"]["@id"], F.lit("")), F.nullif(resource(v)["@id"], F.lit("")))
    images = F.filter(F.transform(canvases, image), lambda u: u.isNotNull())
    return df.select(id_col, F.posexplode(images).alias("at", "image")).select(id_col, (F.col("at") + 1).alias("page_no"), "image")


def image_url(x, width: int = 1500) -> Column:
    """Address of a page's image of that width; addresses of full images stay."""
    x = c(x)
    return F.when(F.contains(x, F.lit("/full/")), x).otherwise(F.concat(x, F.lit(f"/full/{width},/0/default.jpg")))


def image_mime(path) -> Column:
    """Media type by the file name's suffix: PNG, else JPEG."""
    return F.when(F.lower(c(path)).endswith(".png"), "image/png").otherwise("image/jpeg")


def project_metadata(df: DataFrame, attributes: str = "attributes") -> DataFrame:
    """The 22 fields of a record from the API's attributes, missing ones with their defaults."""
    a = F.col(attributes)
    names = {f.name for f in df.schema[attributes].dataType.fields}
    text = lambda n: F.coalesce(a[n] if n in names else F.lit(None).cast("string"), F.lit(""))
    many = lambda n, default=(): F.coalesce(a[n] if n in names else F.lit(None).cast("array<string>"), F.array(*map(F.lit, default)).cast("array<string>"))
    files, raw = many("filenames_ssim"), F.coalesce(F.col("raw_text"), F.lit(""))
    return df.select(
        short_id("record_id").alias("ark_id"), "record_id", text("identifier_uri_ss").alias("source_url"),
        text("identifier_iiif_manifest_ss").alias("iiif_manifest"), F.col("newspaper"), F.col("collection"),
        text("title_info_primary_tsi").alias("title"), text("title_info_partnum_tsi").alias("issue_date"),
        many("date_edtf_ssm", ("",)).alias("date_iso"), text("date_start_dtsi").alias("date_start"),
        F.coalesce(a["date_facet_yearly_itim"] if "date_facet_yearly_itim" in names else F.lit(None).cast("array<int>"), F.array().cast("array<int>")).alias("year"),
        many("publisher_tsim", ("",)).alias("publisher"), many("publication_place_tsim", ("",)).alias("place"),
        many("language_ssim", ("",)).alias("language"), text("institution_name_ssi").alias("institution"),
        F.size(files).alias("page_count"), files.alias("pages"), many("subject_topic_tsim").alias("topics"),
        many("subject_geographic_ssim").alias("geography"), raw.alias("raw_text"), F.length(raw).alias("char_count"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("ingested_at"),
    )


def transcribed(df: DataFrame, flag: str = "has_transcription_bsi", min_chars: int = 50) -> DataFrame:
    """Records that are transcribed and have a text of at least min_chars characters."""
    return df.where(F.coalesce(F.col(f"attributes.{flag}"), F.lit(False)) & (F.length(F.coalesce("raw_text", F.lit(""))) >= min_chars))


def join_pages(df: DataFrame, id_col: str = "ark_id", page_col: str = "page_no", text_col: str = "text") -> DataFrame:
    """(id, text): the pages of an issue in order, joined by the page-break line; failed pages are empty."""
    from inkspan.config import PAGE_BREAK

    pages = F.array_sort(F.collect_list(F.struct(F.col(page_col), F.coalesce(F.col(text_col), F.lit("")).alias("t"))))
    return df.groupBy(id_col).agg(F.array_join(F.transform(pages, lambda p: p["t"]), f"\n\n{PAGE_BREAK}\n\n").alias("text"))


#: Columns of a rendered issue.
WIDTH = 80


def wrapped(text: str, indent: int = 2, width: int = WIDTH) -> str:
    """The text in lines of at most width columns, indented."""
    return textwrap.fill(text, width=width, initial_indent=" " * indent, subsequent_indent=" " * indent)


def rendered(r: dict, full: bool) -> str:
    """An issue as readable text: its metadata between rules, then the whole text in packed sentences, or a preview."""
    text, date = r["raw_text"] or "", (r["date_start"] or "")[:10]
    heavy, light = "=" * WIDTH, "-" * WIDTH
    out = [heavy, f"  {(r['newspaper'] or 'Unknown Newspaper').upper()}", f"  {r['issue_date'] or date}", heavy, ""]
    pages = "?" if r["page_count"] is None else r["page_count"]
    facts = {"Collection": r["collection"] or "?", "Date": date, "Pages": pages, "Length": f"{r['char_count'] or 0:,} characters", "Source": r["source_url"] or ""}
    out += [f"  {k:<12}: {v}" for k, v in facts.items()] + ["", light, ""]
    if full:
        out += ["  FULL TEXT", ""]
        for p in packed(text):
            out += [wrapped(p), ""]
    else:
        out += ["  PREVIEW (first 600 chars)", "", wrapped(text[:600]), "  [... truncated. Use --full to see complete text ...]", ""]
    return "\n".join([*out, heavy])


def render_issue(full: bool = False) -> Column:
    """rendered as an Arrow function over the columns of an issue; missing fields have defaults."""
    names = ["newspaper", "issue_date", "date_start", "collection", "page_count", "char_count", "source_url", "raw_text"]
    ship_package(SparkSession.active())

    @F.pandas_udf("string")
    def run(rows: pd.DataFrame) -> pd.Series:
        cols = {n: rows[n].astype(object).where(rows[n].notna(), None) for n in names}
        whole = [None if v is None else int(v) for v in cols["page_count"]], [None if v is None else int(v) for v in cols["char_count"]]
        cols["page_count"], cols["char_count"] = whole
        return pd.Series([rendered(dict(zip(names, v, strict=True)), full) for v in zip(*(cols[n] for n in names), strict=True)], dtype=object)

    return run(F.struct(*names))
