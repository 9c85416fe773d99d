"""Landed order lines, loaded by Structured Streaming.

New order lines land as files (any file format Spark streams: parquet, JSON,
CSV ...), in any order, an order's lines possibly in several files. A streaming
query over the landing folder hands each micro-batch to ``foreachBatch``, which
runs one load (:func:`starloom.plans.loads.lines_load`) and records the batch id
in the published manifest. A batch replayed after a failure (same id, or an
older one) is skipped, so every micro-batch is published exactly once.
``trigger(availableNow=True)`` processes everything landed so far and stops - a
scheduled run; a processing-time trigger keeps it live.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from starloom.plans.loads import lines_load
from starloom.plans.warehouse import Manifest, Warehouse
from starloom.session import remove_folder, scratch_path
from starloom.sources.source import Source


def apply_batch(
    spark: SparkSession,
    root: str,
    base: Source,
    lines: DataFrame,
    batch_id: int,
    effective_date: _dt.date,
    run_ts: _dt.datetime | None = None,
    dimension_version: str | None = None,
) -> Manifest | None:
    """One micro-batch -> one published run (``None`` if it was applied before)."""
    prev = Warehouse(spark, root).require()
    if prev.stream_batch_id is not None and batch_id <= prev.stream_batch_id:
        return None
    now = run_ts or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    return lines_load(spark, base, root, lines, batch_id, effective_date, now, dimension_version)


def start_incremental_stream(
    spark: SparkSession,
    root: str,
    base: Source,
    landing_path: str,
    lines_schema: T.StructType,
    checkpoint_location: str,
    effective_date: Callable[[int], _dt.date] | _dt.date,
    file_format: str = "parquet",
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    dimension_version: Callable[[int], str] | str | None = None,
) -> StreamingQuery:
    """Stream landed order-line files into the warehouse.

    ``effective_date`` is a date or a function of the batch id; so is
    ``dimension_version``, which names the state of ``base``'s dimensions. The stream's
    own checkpoint (``checkpoint_location``, a shared folder) tracks which
    files were consumed; the manifest tracks which batches were published."""
    reader = spark.readStream.schema(lines_schema).format(file_format)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(landing_path)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        eff = effective_date(batch_id) if callable(effective_date) else effective_date
        version = dimension_version(batch_id) if callable(dimension_version) else dimension_version
        # the micro-batch is read several times by the load; pin it once
        path = scratch_path(spark, "micro-batch")
        batch.write.parquet(path)
        try:
            apply_batch(spark, root, base, spark.read.schema(batch.schema).parquet(path), batch_id, eff, dimension_version=version)
        finally:
            remove_folder(spark, path)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
