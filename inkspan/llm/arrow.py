"""Arrow-batched mapping of Python functions over DataFrames."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from inkspan.session import ship_package

#: Rows that a worker holds as Python objects at a time.
SLICE = 512


def struct(schema: str | StructType) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema) if hasattr(StructType, "fromDDL") else _parse_datatype_string(schema)


def _slices(batches) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(0, b.num_rows, SLICE):
            yield b.slice(k, SLICE)


def map_partitions(df: DataFrame, columns: list[str], make: Callable[[], Callable], schema: str | StructType) -> DataFrame:
    """``make()`` is called once in each task; what it returns gets the columns of a slice of rows as lists and
    returns rows as tuples; called with None at the end of the partition, it returns what it still holds."""
    ship_package(df.sparkSession)
    out = struct(schema)
    arrow = to_arrow_schema(out)

    def run(batches):
        f = make()

        def emit(rows):
            if rows:
                cols = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t.type) for c, t in zip(cols, arrow, strict=True)], schema=arrow)

        for b in _slices(batches):
            yield from emit(f([c.to_pylist() for c in b.columns]))
        yield from emit(f(None))

    return df.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(run, out)


def kept_fields(df: DataFrame, names: list[str], schema: str | StructType) -> list[StructField]:
    """The fields of columns that are handed through; one whose name an output column has gets ``_in`` behind it."""
    taken = set(struct(schema).fieldNames())
    return [StructField(f"{n}_in" if n in taken else n, df.schema[n].dataType, True) for n in names]


def map_rows(df: DataFrame, keep: list[str], inputs: list[str], f: Callable, schema: str) -> DataFrame:
    """The columns ``keep`` beside the row of ``schema`` that ``f`` makes of the columns ``inputs``."""
    kept = kept_fields(df, keep, schema)
    n = len(keep)

    def make():
        def go(cols):
            if cols is None:
                return []
            return [(*k, *f(*v)) for k, v in zip(zip(*cols[:n], strict=True), zip(*cols[n:], strict=True), strict=True)]

        return go

    return map_partitions(df, [*keep, *inputs], make, StructType([*kept, *struct(schema).fields]))


def flat_map_rows(df: DataFrame, keep: list[str], inputs: list[str], f: Callable, schema: str) -> DataFrame:
    """As map_rows, with any number of rows for each input row."""
    kept = kept_fields(df, keep, schema)
    n = len(keep)

    def make():
        def go(cols):
            if cols is None:
                return []
            return [(*k, *r) for k, v in zip(zip(*cols[:n], strict=True), zip(*cols[n:], strict=True), strict=True) for r in f(*v)]

        return go

    return map_partitions(df, [*keep, *inputs], make, StructType([*kept, *struct(schema).fields]))
