"""Hashed linear classifiers, trained on bounded samples."""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
from pyspark.sql import SparkSession

BITS = 16
MASK = (1 << BITS) - 1


def hashed(features: list[str]) -> list[int]:
    """Buckets of the features; 0 is the bias, that every row has."""
    return [0, *[1 + crc32(f.encode("utf-8", "surrogatepass")) % MASK for f in features]]


@dataclass
class Linear:
    """One weight vector for each label."""

    labels: tuple[str, ...]
    weights: np.ndarray
    offsets: np.ndarray

    def margins(self, buckets: list[list[int]]) -> np.ndarray:
        """Rows by labels: log odds."""
        if not buckets:
            return np.zeros((0, len(self.labels)))
        flat, starts, _ = _packed(buckets)
        return np.stack([np.add.reduceat(w[flat], starts) for w in self.weights], axis=1) + self.offsets


def _packed(buckets):
    counts = np.fromiter(map(len, buckets), np.int64, len(buckets))
    flat = np.fromiter((b for x in buckets for b in x), np.int64, int(counts.sum()))
    return flat, np.concatenate([[0], np.cumsum(counts)[:-1]]), counts


@dataclass
class Rows:
    """Training rows: the buckets of all rows, one row after the other, and how many each has."""

    flat: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, buckets: list[list[int]]) -> Rows:
        flat, _, counts = _packed(buckets)
        return cls(flat.astype(np.uint16), counts)

    @classmethod
    def of_lists(cls, column) -> Rows:
        """From an Arrow column of lists."""
        lists = column.combine_chunks()
        return cls(lists.flatten().to_numpy().astype(np.uint16), lists.value_lengths().to_numpy().astype(np.int64))

    def __len__(self) -> int:
        return len(self.sizes)

    def margins(self, first: np.ndarray, second: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Log odds of each row by the first or the second weights, as ``which`` says."""
        starts = np.cumsum(self.sizes) - self.sizes
        return np.where(which == 0, *(np.add.reduceat(w[self.flat], starts) for w in (first, second)))

    def fit(self, y: np.ndarray, weight: np.ndarray, l2: float, rounds: int, rate: float, least: int) -> np.ndarray:
        """Weights of one label by logistic regression: full-batch Adam, deterministic. y: 0 or 1; rows of weight 0
        don't count. Features of fewer than ``least`` rows get no weight: they could only recall single rows."""
        used = weight > 0
        flat, row = self.flat[np.repeat(used, self.sizes)], np.repeat(np.flatnonzero(used).astype(np.int32), self.sizes[used])
        active = np.flatnonzero(np.bincount(flat, minlength=MASK + 1) >= least)
        column = np.full(MASK + 1, -1, np.int32)
        column[active] = np.arange(len(active))
        kept = column[flat] >= 0
        # as wide as bincount takes them, which else widens them in every round
        flat, row = column[flat[kept]].astype(np.intp), row[kept].astype(np.intp)
        weight = weight / max(weight.sum(), 1e-12)
        w, m, v = np.zeros(len(active)), np.zeros(len(active)), np.zeros(len(active))
        for t in range(1, rounds + 1):
            p = 1 / (1 + np.exp(-np.clip(np.bincount(row, w[flat], len(self)), -30, 30)))
            g = np.bincount(flat, ((p - y) * weight)[row], len(active)) + l2 * w
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        out = np.zeros(MASK + 1, np.float32)
        out[active] = w
        return out


def train(buckets: list[list[int]], y: np.ndarray, labels, importance: np.ndarray | None = None, l2: float = 1e-4, rounds: int = 120, rate: float = 0.15, least: int = 8) -> Linear:
    """One classifier for each label. y: rows by labels, 0 or 1."""
    rows = Rows.of(buckets)
    weight = np.ones(len(buckets)) if importance is None else importance
    return Linear(tuple(labels), np.stack([rows.fit(y[:, k], weight, l2, rounds, rate, least) for k in range(y.shape[1])]), np.zeros(y.shape[1]))


def train_each(spark: SparkSession, rows: Rows, jobs: list[tuple[np.ndarray, np.ndarray]], **options) -> np.ndarray:
    """Weights of several fits on the same rows, a task for each (y, weight); the rows, bounded by the sample, are
    broadcast."""
    from inkspan.llm.arrow import map_partitions

    shared = spark.sparkContext.broadcast((rows, jobs, options))

    def make():
        def go(cols):
            if not cols:
                return []
            rows, jobs, options = shared.value
            return [(k, rows.fit(*jobs[k], **options).tobytes()) for k in cols[0]]

        return go

    found = map_partitions(spark.range(len(jobs), numPartitions=len(jobs)), ["id"], make, "id bigint, w binary").collect()
    shared.unpersist()
    return np.stack([np.frombuffer(r.w, np.float32) for r in sorted(found, key=lambda r: r.id)])
