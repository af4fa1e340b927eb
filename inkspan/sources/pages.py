"""Download of page images: a folder for each issue, with a marker once all its pages are there."""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkspan.config import Retry
from inkspan.operators.records import image_url, manifest_pages
from inkspan.session import ship_package
from inkspan.sources.listing import get_with_retry, open_url

DONE = ".done"


def _system(folder: str) -> tuple[fs.FileSystem, str]:
    if folder.startswith("file:") or "://" not in folder:
        return fs.LocalFileSystem(), "/" + folder.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(folder)


def download_pages(manifests: DataFrame, folder: str, width: int = 1500, max_pages: int | None = None, retry: Retry = Retry(timeout=30), pause: float = 0.3, fetch: Callable = open_url) -> DataFrame:
    """(ark_id, pages, downloaded, skipped) of every issue whose manifest has images; a lazy query that downloads when run.

    Images are kept as ``<folder>/<ark_id>/page_0001.jpg``; those that exist aren't fetched again, issues with a marker
    not at all (skipped). A page that fails is left out, the marker says how many there are. A task that is run again
    goes on where the lost one stopped. max_pages: only the first so many pages of an issue, if given.
    """
    ship_package(manifests.sparkSession)
    pages = manifest_pages(manifests)
    pages = pages.where(F.col("page_no") <= max_pages) if max_pages else pages
    listed = pages.select("ark_id", "page_no", image_url("image", width).alias("url")).groupBy("ark_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "url"))).alias("urls"))

    def run(batches):
        system, root = _system(folder)

        def exists(path: str) -> bool:
            return system.get_file_info(path).type != fs.FileType.NotFound

        for b in batches:
            out = []
            for ark, urls in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                home = f"{root}/{ark}"
                if exists(f"{home}/{DONE}"):
                    out.append((ark, len(urls), 0, True))
                    continue
                system.create_dir(home, recursive=True)
                done = 0
                for u in urls:
                    path = f"{home}/page_{u['page_no']:04d}.jpg"
                    if not exists(path):
                        data = get_with_retry(u["url"], retry, fetch)
                        if data is None:
                            continue
                        # a file has its name only when it is whole
                        with system.open_output_stream(path + ".part") as f:
                            f.write(data)
                        system.move(path + ".part", path)
                        time.sleep(0 if u["url"].startswith("file://") else pause)
                    done += 1
                with system.open_output_stream(f"{home}/{DONE}") as f:
                    f.write(f"{done} pages\n".encode())
                out.append((ark, len(urls), done, False))
            cols = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()), pa.array(cols[3], pa.bool_())], names=["ark_id", "pages", "downloaded", "skipped"])

    return listed.mapInArrow(run, "ark_id string, pages int, downloaded int, skipped boolean")
