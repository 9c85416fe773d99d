"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from starloom.session import scratch_path

SLICE_BYTES = 4 << 20  # text that one slice of an Arrow batch holds, a longer single text aside


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back: cuts
    the lineage, survives lost executors, and fixes what later passes read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns of these names (upper and lower case alike):
    an operator's own outputs replace columns of the same name."""
    low = {n.lower() for n in names}
    return df.select(*[df[f"`{c}`"] for c in df.columns if c.lower() not in low])


def slices(batch, column: str, limit: int = SLICE_BYTES) -> Iterator:
    """Cut an Arrow record batch into pieces whose ``column`` holds about
    ``limit`` bytes each (one row at least), to bound a worker's memory."""
    import numpy as np
    import pyarrow.compute as pc

    if batch.num_rows == 0:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64) + 64)
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


class Remembered(dict):
    """What ``make`` gives for a key, made once while it is remembered: the
    last ``limit`` keys asked for and, of those before them, the ones asked for
    again. Keys longer than ``longest`` are made anew each time."""

    def __init__(self, make: Callable, limit: int, longest: int) -> None:
        super().__init__()
        self.make, self.limit, self.longest = make, limit, longest
        self.older: dict = {}

    def __missing__(self, key):
        got = self.older.get(key)
        if got is None:
            got = self.make(key)
            if len(key) > self.longest:
                return got
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = got
        return got
