"""Dense, deterministic numbering in parallel.

``row_number() OVER (ORDER BY k)`` without PARTITION BY plans an
``Exchange SinglePartition``: every row of the table goes through one task.
:func:`dense_index` gives the same numbers with the work spread out:

1. range-partition on the ordering columns and sort inside each partition
   (one shuffle; a hot key range is split by the sampled bounds), and note
   each row's partition and place;
2. write that layout once (the *pin*), so later passes - and task retries after
   a lost executor - see exactly the same rows and places;
3. count rows per partition - one small row per partition reaches the driver
   (not needed if the rows fill one partition only, which the write observes);
4. index = start + (rows in earlier partitions) + (place inside the partition),
   the former from a broadcast frame of one row per partition.

Callers number narrow rows (keys) and fetch wide ones by a join. A run gives
its own ``pins`` folder and removes it when it ends.

Where only places inside groups count and no group is a large share of the rows,
:func:`clustered_index` numbers them at the cost of one shuffle for all that
follows: its pin is bucketed by the group, so joins and groupings on the group
read it in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starloom.session import scratch_path

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits
_CODEC = "zstd"  # of the pins


def _cols(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def dense_index(
    df: DataFrame,
    order_by: Sequence[str | Column],
    start: int = 1,
    index_col: str = "_idx",
    pins: str | None = None,
) -> tuple[DataFrame, int]:
    """Return ``(df + index_col, row_count)``; index runs start..start+n-1 in
    ``order_by`` order (ties in an arbitrary but stable order)."""
    spark = df.sparkSession
    keys = _cols(order_by)
    path = f"{pins}/{uuid.uuid4().hex}" if pins else scratch_path(spark, "pin")
    place = F.monotonically_increasing_id()
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("__place", place)
    pid = F.shiftright(F.col("__place"), _LOCAL_BITS)
    seen = Observation(f"pin-{uuid.uuid4().hex}")
    ranged.observe(seen, F.count(F.lit(1)).alias("n"), F.max(pid).alias("last")).write.parquet(path, compression=_CODEC)
    pinned = spark.read.schema(ranged.schema).parquet(path)

    total = seen.get["n"]
    if total == 0:
        return pinned.drop("__place").withColumn(index_col, F.lit(None).cast("long")), 0
    if seen.get["last"] == 0:  # one range: places are the index
        return pinned.withColumn(index_col, F.col("__place") + F.lit(start).cast("long")).drop("__place"), total
    rows = pinned.groupBy(pid.alias("pid")).agg(F.count(F.lit(1)).alias("n")).collect()
    offsets, before = [], 0
    for r in sorted(rows, key=lambda r: r["pid"]):
        offsets.append((r["pid"], start + before - (r["pid"] << _LOCAL_BITS)))
        before += r["n"]
    shift = F.broadcast(spark.createDataFrame(offsets, "__pid long, __shift long"))  # one row per partition
    out = pinned.join(shift, pid == F.col("__pid")).withColumn(index_col, F.col("__place") + F.col("__shift"))
    return out.drop("__place", "__pid", "__shift"), total


def assign_surrogate_keys(
    df: DataFrame,
    order_by: Sequence[str | Column],
    start: int,
    sk_col: str,
    pins: str | None = None,
) -> tuple[DataFrame, int]:
    """Dense surrogate keys ``start, start+1, ...`` in business-key order.

    Equivalent to ``start + row_number() OVER (ORDER BY order_by) - 1``.
    Returns the numbered frame (SK first) and the number of keys handed out,
    which is what the key sequence advances by.
    """
    numbered, n = dense_index(df, order_by, start=start, index_col=sk_col, pins=pins)
    cols = [sk_col] + [c for c in df.columns if c != sk_col]
    return numbered.select(*cols), n


def clustered_index(
    df: DataFrame, group: str, order_by: str, index_col: str = "_idx", pins: str | None = None
) -> DataFrame:
    """``df + index_col``, which grows by one from row to row of a group in
    ``order_by`` order (groups start anywhere). The pin has a bucket per shuffle
    partition, each written and read by one task, so no group may be hot.

    Spark keeps buckets with tables only: the pin is a table of its own until
    the returned frame is resolved, and a plain folder after that."""
    spark = df.sparkSession
    name = f"pin_{uuid.uuid4().hex}"
    path = f"{pins}/{name}" if pins else scratch_path(spark, "pin")
    conf = spark.conf
    buckets = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions"))
    ranked = df.repartition(buckets, group).sortWithinPartitions(group, order_by).withColumn(index_col, F.monotonically_increasing_id())
    ranked.write.format("parquet").bucketBy(buckets, group).option("path", path).option("compression", _CODEC).saveAsTable(name)
    pinned = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return pinned
