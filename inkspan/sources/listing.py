"""Python data sources for a paginated listing of ids and for the details of each id.

Addresses are ``http(s)://`` or ``file://``; with the latter, folders of saved answers take the service's place.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from inkspan.config import Retry


class Transient(Exception):
    """A failure after which another attempt makes sense."""


def open_url(url: str, timeout: int) -> bytes | None:
    """The answer's bytes; None for 4xx. 5xx, time-outs and lost connections raise Transient."""
    if url.startswith("file://"):
        try:
            with open(urllib.parse.unquote(url[7:]), "rb") as f:
                return f.read()
        except FileNotFoundError:
            return None
    try:
        with urllib.request.urlopen(url, timeout=timeout) as r:
            return r.read()
    except urllib.error.HTTPError as e:
        if e.code >= 500:
            raise Transient(str(e)) from e
        return None
    except (urllib.error.URLError, TimeoutError, ConnectionError) as e:
        raise Transient(str(e)) from e


def get_with_retry(url: str, retry: Retry, fetch: Callable[[str, int], bytes | None] = open_url, sleep: Callable[[float], None] = time.sleep) -> bytes | None:
    """The answer, or None after a definite failure or the last attempt; waits between attempts as ``backoff`` says."""
    for attempt in range(retry.max_retries):
        try:
            return fetch(url, retry.timeout)
        except Transient:
            if attempt + 1 < retry.max_retries:
                sleep(retry.backoff[min(attempt, len(retry.backoff) - 1)])
        except Exception:
            return None
    return None


def page_address(base: str, page: int, per_page: int, years: tuple[int | None, int | None]) -> str:
    """Address of a page of a listing: a query string, or for saved answers a file of that page."""
    if base.startswith("file://"):
        return f"{base}/page_{page}.json"
    query = {"per_page": per_page, "page": page}
    if years != (None, None):
        query["range[date_facet_yearly_itim][begin]"] = years[0] or ""
        query["range[date_facet_yearly_itim][end]"] = years[1] or ""
    return f"{base}{'&' if '?' in base else '?'}{urllib.parse.urlencode(query)}"


def list_ids(base: str, years: tuple[int | None, int | None] = (None, None), per_page: int = 100, max_pages: int | None = None, delay: float = 2.0, retry: Retry = Retry(), fetch=open_url, sleep=time.sleep) -> Iterator[str]:
    """Ids of a listing, page by page, until the last page, an empty one, a failure or max_pages."""
    page = 1
    while max_pages is None or page <= max_pages:
        raw = get_with_retry(page_address(base, page, per_page, years), retry, fetch, sleep)
        if raw is None:
            return
        answer = json.loads(raw)
        pages = (answer.get("meta") or {}).get("pages") or {}
        if page == 1 and pages.get("total_count") == 0:
            return
        items = answer.get("data") or []
        if not items:
            return
        yield from (x["id"] for x in items if x.get("id"))
        if pages.get("last_page?"):
            return
        page += 1
        if not base.startswith("file://"):
            sleep(delay)


@dataclass
class Collection(InputPartition):
    """One collection and one span of years: a partition."""

    newspaper: str
    collection: str
    base: str
    first: int | None
    last: int | None


class IdReader(DataSourceReader):
    def __init__(self, options: dict):
        self.collections = json.loads(options["collections"])
        self.first = int(options["firstyear"]) if "firstyear" in options else None
        self.last = int(options["lastyear"]) if "lastyear" in options else None
        self.per_page = int(options.get("perpage", 100))
        self.max_pages = int(options["maxpages"]) if "maxpages" in options else None
        self.delay = float(options.get("delay", 2.0))

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        """Bounds on ``year`` narrow the addresses; Spark still applies all filters to the rows."""
        for f in filters:
            if getattr(f, "attribute", None) == ("year",) and isinstance(getattr(f, "value", None), int):
                if isinstance(f, (GreaterThanOrEqual, GreaterThan, EqualTo)):
                    low = f.value + isinstance(f, GreaterThan)
                    self.first = low if self.first is None else max(self.first, low)
                if isinstance(f, (LessThanOrEqual, LessThan, EqualTo)):
                    high = f.value - isinstance(f, LessThan)
                    self.last = high if self.last is None else min(self.last, high)
            yield f

    def partitions(self) -> list[Collection]:
        """A partition for each collection and, where both bounds are known, each year."""
        spans = [(y, y) for y in range(self.first, self.last + 1)] if self.first is not None and self.last is not None else [(self.first, self.last)]
        return [Collection(c["newspaper"], c["collection"], c["base"], a, b) for c in self.collections for a, b in spans]

    def read(self, partition: Collection) -> Iterator[tuple]:
        base = partition.base
        if base.startswith("file://") and partition.first is not None and partition.first == partition.last:
            base = f"{base}/{partition.first}"
        for x in list_ids(base, (partition.first, partition.last), self.per_page, self.max_pages, self.delay):
            yield x, partition.newspaper, partition.collection, partition.first if partition.first == partition.last else None


class IdListing(DataSource):
    """``spark.read.format("archive_ids").option("collections", json)``: id, newspaper, collection, year."""

    @classmethod
    def name(cls) -> str:
        return "archive_ids"

    def schema(self) -> str:
        return "id string, newspaper string, collection string, year int"

    def reader(self, schema) -> IdReader:
        return IdReader(self.options)


def register(spark) -> None:
    """Makes ``archive_ids`` known to a session, with filters passed to sources written in Python."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(IdListing)


def fetch_details(ids, base: str, retry: Retry = Retry(), pause: float = 0.5):
    """(record_id, newspaper, collection, metadata json, raw_text) of the ids of a DataFrame: metadata first, the text
    only of transcribed records; a missing text gives no row, a failure a null one, so that it can be tried again."""

    def run(batches):
        import pandas as pd

        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                meta = get_with_retry(f"{base}/{r.id}.json", retry)
                if meta is None:
                    rows.append((r.id, r.newspaper, r.collection, None, None, "failed"))
                    continue
                attributes = (json.loads(meta).get("data") or {}).get("attributes") or {}
                if not attributes.get("has_transcription_bsi"):
                    rows.append((r.id, r.newspaper, r.collection, json.dumps(attributes), None, "not_transcribed"))
                    continue
                if not base.startswith("file://"):
                    time.sleep(pause)
                text = get_with_retry(f"{base}/{r.id}.txt", retry)
                rows.append((r.id, r.newspaper, r.collection, json.dumps(attributes), text.decode("utf-8", "replace") if text is not None else None, "done" if text is not None else "no_text"))
            yield pd.DataFrame(rows, columns=["record_id", "newspaper", "collection", "metadata", "raw_text", "status"])

    return ids.mapInPandas(run, "record_id string, newspaper string, collection string, metadata string, raw_text string, status string")
