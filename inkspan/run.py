"""Runs the steps of an archive's pipeline: ``python -m inkspan.run --config archive.json [--step ids ...] [--test]``.

Each step reads the tables of those before it below the data folder and writes its own. A step whose table is complete is
skipped, so a run that was interrupted goes on where it stopped; ``--again`` runs it anew.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkspan import sinks
from inkspan.config import PERIOD_KEYWORDS, Config, load_config
from inkspan.operators import articles, quality, records
from inkspan.sources import listing
from inkspan.text import clean

#: The attributes of a record's answer that are kept.
ATTRIBUTES = (
    "has_transcription_bsi boolean, identifier_uri_ss string, identifier_iiif_manifest_ss string, title_info_primary_tsi string, title_info_partnum_tsi string, date_edtf_ssm array<string>, date_start_dtsi string, "
    "date_facet_yearly_itim array<int>, publisher_tsim array<string>, publication_place_tsim array<string>, language_ssim array<string>, institution_name_ssi string, filenames_ssim array<string>, "
    "subject_topic_tsim array<string>, subject_geographic_ssim array<string>"
)


@dataclass(frozen=True)
class Archive:
    """What is fetched, and where it goes. periods: name -> first and last year."""

    data: str
    collections: list = field(default_factory=list)  # newspaper, collection, base
    details: str = ""
    years: tuple = (None, None)
    periods: dict = field(default_factory=dict)
    config: Config = field(default_factory=Config)


STEPS: dict[str, Callable[[SparkSession, Archive], DataFrame]] = {}


def step(f):
    STEPS[f.__name__] = f
    return f


def _read(spark: SparkSession, a: Archive, name: str) -> DataFrame:
    return spark.read.parquet(f"{a.data}/{name}")


@step
def ids(spark: SparkSession, a: Archive) -> DataFrame:
    """The ids of all collections within the years."""
    listing.register(spark)
    reader = spark.read.format("archive_ids").option("collections", json.dumps(a.collections)).option("perpage", a.config.per_page)
    for name, year in zip(("firstyear", "lastyear"), a.years, strict=True):
        reader = reader.option(name, year) if year is not None else reader
    reader = reader.option("maxpages", a.config.max_pages) if a.config.max_pages else reader
    return reader.load()


@step
def details(spark: SparkSession, a: Archive) -> DataFrame:
    """Metadata and text of each id, with the status of its fetch."""
    wanted = _read(spark, a, "ids").select("id", "newspaper", "collection").dropDuplicates(["id"])
    return listing.fetch_details(wanted, a.details, a.config.retry)


@step
def texts(spark: SparkSession, a: Archive) -> DataFrame:
    """Records of the transcribed ids with enough text, cleaned."""
    got = _read(spark, a, "details").where("status = 'done'").withColumn("attributes", F.from_json("metadata", ATTRIBUTES))
    kept = records.project_metadata(records.transcribed(got, min_chars=a.config.min_ingest_chars))
    return kept.withColumn("tier_1_cleaned", clean.clean_tier1("raw_text"))


@step
def days(spark: SparkSession, a: Archive) -> DataFrame:
    """Counts by day, the records themselves being written by day."""
    rows = _read(spark, a, "texts")
    sinks.write_by_day(rows, f"{a.data}/by_day")
    return records.by_day(rows)


@step
def scores(spark: SparkSession, a: Archive) -> DataFrame:
    """Statistics of the raw and the cleaned texts."""
    tiers = quality.tier_texts(_read(spark, a, "texts"), {"raw": F.col("raw_text"), "tier_1": F.col("tier_1_cleaned")}, [])
    long = quality.long_form(quality.score_documents(tiers, ["tier"], "text"), ["tier"], list(quality.METRICS))
    return quality.corpus_statistics(long, ["tier"])


@step
def topics(spark: SparkSession, a: Archive) -> DataFrame:
    """Articles of the periods' topics."""
    year, period = records.year_of(), F.lit(None).cast("string")
    for name, (first, last) in a.periods.items():
        period = F.when(year.between(first, last), name).otherwise(period)
    rows = _read(spark, a, "texts").withColumn("text", F.col("raw_text")).withColumn("ocr_source", F.lit("api"))
    c = a.config
    found = articles.extract_articles(rows, period, PERIOD_KEYWORDS, c.min_extract_chars, c.segment_min_chars, c.segment_min_score, c.top_segments)
    return found.where("period is not null")


@step
def pairs(spark: SparkSession, a: Archive) -> DataFrame:
    """A question and answer for each article, from templates."""
    return articles.template_qa(_read(spark, a, "topics").dropDuplicates(["ark_id"]), "ark_id")


@step
def export(spark: SparkSession, a: Archive) -> DataFrame:
    """The pairs of the periods, also as JSON lines."""
    kept = articles.export_pairs(_read(spark, a, "pairs"), list(a.periods), "ark_id")
    sinks.write_jsonl(kept, f"{a.data}/export_lines")
    return kept


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a step's table was written to its end."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def run(spark: SparkSession, a: Archive, steps: list[str] | None = None, again: bool = False) -> list[str]:
    """Runs the steps, all in order or those named, and says which ran."""
    unknown = set(steps or ()) - set(STEPS)
    if unknown:
        raise ValueError(f"no such steps: {sorted(unknown)}")
    ran = []
    for name in STEPS:
        if steps and name not in steps or complete(spark, f"{a.data}/{name}") and not again:
            continue
        STEPS[name](spark, a).write.mode("overwrite").parquet(f"{a.data}/{name}")
        ran.append(name)
    return ran


def archive_of(path: str, test: bool = False, **overrides) -> Archive:
    """An archive from a JSON file: its own fields, and those of the configuration under ``config``."""
    with open(path, encoding="utf-8") as f:
        values = json.load(f) | overrides
    config = load_config(None, **values.pop("config", {}))
    return Archive(**values, config=config.for_test() if test else config)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    p.add_argument("--config", required=True)
    p.add_argument("--step", action="append", choices=list(STEPS), help="only this step; may be given several times")
    p.add_argument("--again", action="store_true", help="run steps that are complete, too")
    p.add_argument("--test", action="store_true", help="two pages of each listing")
    p.add_argument("--data", help="another data folder than the configuration's")
    args = p.parse_args(argv)
    a = archive_of(args.config, args.test, **({"data": args.data} if args.data else {}))
    for name in run(SparkSession.builder.getOrCreate(), a, args.step, args.again):
        print(name, flush=True)


if __name__ == "__main__":
    main()
