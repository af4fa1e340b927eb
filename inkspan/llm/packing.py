"""Filling containers of fixed capacity with items, from the histogram of their sizes.

Sizes are whole tokens up to the capacity, so the histogram has at most ``capacity`` entries however many items there
are. Variable-capacity best fit runs on it: a bin is opened at the permitted length that leaves the least of it unused,
filled with the sizes that fit best, and repeated as often as the histogram allows. Items find their bins by their size
and their rank among items of that size.
"""

from __future__ import annotations

import bisect
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkspan.llm.arrow import map_partitions, struct
from inkspan.session import cut_lineage

CAPACITY = 2048
#: Permitted lengths of a bin, the capacity among them.
LENGTHS = (256, 512, 1024, 2048)
#: Unused shares are compared in steps of 1 / GRAIN.
GRAIN = 50


@dataclass
class Plan:
    """By size: from which rank on, in which bins, how many in each bin. At most capacity patterns of at most
    sqrt(2 capacity) different sizes each, so its size has a bound of its own."""

    capacity: int
    starts: dict[int, np.ndarray]
    bins: dict[int, np.ndarray]
    each: dict[int, np.ndarray]
    lengths: dict[int, np.ndarray]  # with which the bins were opened
    n_bins: int

    def bin_of(self, size: int, rank: int) -> tuple[int, int]:
        """The bin of an item, and the length with which that was opened."""
        k = int(np.searchsorted(self.starts[size], rank, "right")) - 1
        return int(self.bins[size][k] + (rank - self.starts[size][k]) // self.each[size][k]), int(self.lengths[size][k])


def _fill(seed: int, length: int, have: dict[int, int], sizes: list[int]) -> list[int]:
    """The seed and the sizes that fit best beside it: one that fills the rest, else two that do, else the largest."""
    content, left, used = [seed], length - seed, {seed: 1}

    def free(s: int) -> int:
        return have.get(s, 0) - used.get(s, 0)

    def take(s: int) -> None:
        nonlocal left
        content.append(s)
        used[s] = used.get(s, 0) + 1
        left -= s

    while left > 0:
        if free(left) > 0:
            take(left)
            break
        k = bisect.bisect_right(sizes, left) - 1
        while k >= 0 and free(sizes[k]) <= 0:
            k -= 1
        if k < 0:
            break
        largest, pair = sizes[k], None
        m = k
        while m >= 0 and 2 * sizes[m] >= left:
            a, b = sizes[m], left - sizes[m]
            if free(a) > (a == b) and free(b) > (a == b):
                pair = (a, b)
                break
            m -= 1
        if pair:
            take(pair[0])
            take(pair[1])
            break
        take(largest)
    return content


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY, lengths: tuple[int, ...] = LENGTHS) -> Plan:
    """histogram: size -> items, sizes from 1 to capacity."""
    if capacity not in lengths or max(lengths) != capacity:
        raise ValueError("the capacity must be the largest permitted length")
    have = {s: n for s, n in histogram.items() if n > 0}
    sizes = sorted(have)
    given = dict.fromkeys(have, 0)
    rows: dict[int, list[tuple[int, int, int, int]]] = {s: [] for s in have}
    bins = 0
    while sizes:
        seed = sizes[-1]
        options = [_fill(seed, x, have, sizes) for x in lengths if x >= seed]
        allowed = [x for x in lengths if x >= seed]
        # least cost: the smallest unused share, in steps of GRAIN; among equals the longest, which takes the most along
        best = min(range(len(options)), key=lambda k: (int(GRAIN * (allowed[k] - sum(options[k])) / allowed[k]), -allowed[k]))
        content = options[best]
        uses: dict[int, int] = {}
        for s in content:
            uses[s] = uses.get(s, 0) + 1
        times = min(have[s] // u for s, u in uses.items())
        for s, u in uses.items():
            rows[s].append((given[s], bins, u, allowed[best]))
            given[s] += times * u
            have[s] -= times * u
            if not have[s]:
                sizes.pop(bisect.bisect_left(sizes, s))
        bins += times
    column = lambda s, k: np.array([r[k] for r in rows[s]], dtype=np.int64)
    return Plan(capacity, *({s: column(s, k) for s in rows} for k in range(4)), bins)


def pack(sized: DataFrame, id_col: str, size_col: str, capacity: int = CAPACITY, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """(item, piece_no, start, size, bin, opened): every item, or its pieces where it exceeds the capacity, with its bin
    and the permitted length with which that was opened.

    start and size count tokens. Items of null or no size take no room: they have one piece and a null bin. Rows with
    the same id are items of their own. Only counts by size reach the driver; ranks are counted within partitions and
    offset by the counts of the partitions before, so a size that a third of all items have is no hot group.
    """
    size = F.greatest(F.lit(0), F.coalesce(F.col(f"`{size_col}`"), F.lit(0))).cast("bigint")
    items = sized.select(F.col(f"`{id_col}`").alias("item"), size.alias("total"))
    n = F.greatest(F.lit(1), F.ceil(F.col("total") / capacity))
    pieces = items.select("item", "total", F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("piece_no"))
    start = (F.col("piece_no") - 1).cast("bigint") * capacity
    pieces = pieces.select("item", "piece_no", start.alias("start"), F.least(F.lit(capacity), F.col("total") - start).cast("int").alias("size"), F.spark_partition_id().alias("part"))
    placed = cut_lineage(pieces)
    counts = placed.where("size > 0").groupBy("size", "part").agg(F.count("*").alias("n"))
    histogram = {r["size"]: r["n"] for r in counts.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    shared = sized.sparkSession.sparkContext.broadcast(plan_bins(histogram, capacity, lengths))
    before = counts.select("size", "part", (F.sum("n").over(Window.partitionBy("size").orderBy("part")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("part", "size").orderBy("item", "piece_no")) - 1
    ranked = placed.withColumn("within", within).join(before, ["size", "part"], "left").withColumn("rank", F.col("within") + F.coalesce("before", F.lit(0)))
    fields = [ranked.schema[c] for c in ("item", "piece_no", "start", "size")]

    def make():
        plan = shared.value

        def go(cols):
            if not cols:
                return []
            return [(i, p, s, z, *(plan.bin_of(z, r) if z else (None, None))) for i, p, s, z, r in zip(*cols, strict=True)]

        return go

    return map_partitions(ranked, ["item", "piece_no", "start", "size", "rank"], make, StructType([*fields, *struct("bin bigint, opened int").fields]))


def bins_of(assigned: DataFrame, lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """(bin, items, used, opened, capacity, unused): every bin, downsized from the length it was opened with to the least
    permitted one for its contents."""
    used = assigned.where("bin is not null").groupBy("bin").agg(F.count("*").alias("items"), F.sum("size").alias("used"), F.max("opened").alias("opened"))
    fit = F.coalesce(*[F.when(F.col("used") <= x, F.lit(x)) for x in sorted(lengths)])
    return used.withColumn("capacity", fit).withColumn("unused", F.col("capacity") - F.col("used"))
