"""Warehouse storage: immutable parquet parts plus one manifest per run.

Layout under the warehouse root (any Hadoop-compatible path)::

    runs/<run_id>-<attempt>/<part>/  parquet written by one attempt of a run
    _manifests/<run_id>.json       every live part, the control state (watermark,
                                   key sequences) and row counts

A run writes all of its parts first and its manifest last; readers take the
newest manifest. Every attempt writes its own folder and removes it if it
fails, and its pins in any case; every run is published all-or-nothing. The
manifest file is created exclusively, and only if no other run was published
since the attempt started, so of two overlapping runs one fails cleanly.

Part kinds: type-2 dimensions keep ``<dim>#current`` (rewritten when it
changes) and ``<dim>#history`` (closed versions); facts, history and the run
log grow by one part per run until a key has more than ``MAX_PARTS``, when the
smaller ones are merged into one, so neither the manifest nor a scan's list of
paths grows with the number of runs. :meth:`Warehouse.expire` frees what only old
runs used. The calendar and type-1 dimensions are
one part each.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from starloom.operators.sketch import bits_for, build_sketch, probable_members
from starloom.schemas import (
    SURROGATE_KEY_SEQ,
    project_to,
    WAREHOUSE_TABLES,
    WATERMARK,
    WATERMARK_ENTITY,
)

from starloom.session import create_small_file, list_folder, read_small_file, remove_folder

CURRENT, HISTORY = "current", "history"
FACT_TABLE = "fact_sales_line"
SKETCH = "word long, field long"
MAX_PARTS = 8
MERGED_FILE_ROWS = 4_000_000  # rows per file of a merged part
CODEC = "zstd"  # of the parts
SORT = {FACT_TABLE: ["order_date_sk", "order_id", "product_id"]}  # row groups clustered by order date


@dataclass
class Manifest:
    run_id: int
    run_type: str
    run_ts: str | None = None  # ISO timestamp of the run
    effective_date: str | None = None  # ISO date
    watermark: int | None = None  # last loaded order id
    watermark_updated_at: str | None = None
    fact_max_order_id: int | None = None
    next_sk: dict[str, int] = field(default_factory=dict)
    stream_batch_id: int | None = None  # last micro-batch applied (exactly-once guard)
    dimension_version: str | None = None  # version of the dimension source that was applied last
    rejected_lines: int = 0  # landed lines without an order or product id, so far
    parts: dict[str, list[str]] = field(default_factory=dict)  # part key -> paths
    rows: dict[str, int] = field(default_factory=dict)  # part key -> rows (sum over paths)
    part_stats: dict[str, dict] = field(default_factory=dict)  # path -> {"min_order_id", "max_order_id", "sketch_bits"}
    part_rows: dict[str, int] = field(default_factory=dict)  # path -> rows, of the parts that grow by appending

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        return cls(**json.loads(text))

    def table_rows(self, table: str) -> int:
        return sum(v for k, v in self.rows.items() if k == table or k.startswith(table + "#"))


def sketch_path(part: str) -> str:
    return f"{part}__orders"


def part_key(table: str, part: str | None = None) -> str:
    return f"{table}#{part}" if part else table


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.attempt = uuid.uuid4().hex[:12]  # this writer's folder suffix

    # ------------------------------------------------------------------ reading
    @property
    def manifest_dir(self) -> str:
        return f"{self.root}/_manifests"

    @property
    def pins(self) -> str:
        """Folder of what this attempt pins; gone when it ends."""
        return f"{self.root}/runs/pins-{self.attempt}"

    def latest_run(self) -> int | None:
        """Id of the newest published run, from the names of the manifests."""
        names = list_folder(self.spark, self.manifest_dir)
        ids = [int(n[: -len(".json")]) for n in names or [] if n.endswith(".json") and n[: -len(".json")].isdigit()]
        return max(ids, default=None)

    def latest(self) -> Manifest | None:
        """Newest published manifest, ``None`` before the first run."""
        run_id = self.latest_run()
        return None if run_id is None else self.manifest(run_id)

    def manifest(self, run_id: int) -> Manifest:
        """The manifest of one past run (time travel to that state)."""
        if f"{run_id}.json" not in (list_folder(self.spark, self.manifest_dir) or []):
            raise RuntimeError(f"run {run_id} was never published under {self.root}")
        return Manifest.from_json(read_small_file(self.spark, f"{self.manifest_dir}/{run_id}.json"))

    def require(self) -> Manifest:
        m = self.latest()
        if m is None:
            raise RuntimeError(f"no published warehouse under {self.root}; run init_warehouse/full_load first")
        return m

    def empty(self, table: str) -> DataFrame:
        return self.spark.createDataFrame([], WAREHOUSE_TABLES[table])

    def table(self, table: str, manifest: Manifest | None = None, part: str | None = None) -> DataFrame:
        """A warehouse table (all its parts, or one part) as one parquet scan."""
        m = manifest or self.require()
        if part is not None:
            paths = list(m.parts.get(part_key(table, part), []))
        else:
            paths = [p for k, v in m.parts.items() if k == table or k.startswith(table + "#") for p in v]
        if not paths:
            return self.empty(table)
        return self.spark.read.schema(WAREHOUSE_TABLES[table]).parquet(*paths)

    def fact_paths_above(self, order_id: int | None, m: Manifest) -> list[str]:
        """Fact parts whose recorded max order id exceeds ``order_id``; parts
        without recorded stats are always included."""
        known = {p: m.part_stats.get(p, {}).get("max_order_id") for p in m.parts.get(FACT_TABLE, [])}
        return [p for p, top in known.items() if order_id is None or top is None or top > order_id]

    def fact_paths_holding(self, orders: DataFrame, m: Manifest, among: list[str] | None = None) -> list[str]:
        """Fact parts that may hold one of these orders (a frame with
        ``order_id``): those whose recorded range meets the orders' range and
        whose sketch finds one of them. Parts without a sketch are included."""
        paths = m.parts.get(FACT_TABLE, []) if among is None else among
        plain = [p for p in paths if not m.part_stats.get(p, {}).get("sketch_bits")]
        asked = [p for p in paths if p not in plain]
        if asked:
            ends = orders.agg(F.min("order_id").alias("lo"), F.max("order_id").alias("hi")).first()
            if ends.lo is None:
                return []
            asked = [p for p in asked if m.part_stats[p]["min_order_id"] <= ends.hi and m.part_stats[p]["max_order_id"] >= ends.lo]
        if asked:
            sketches = [(self.spark.read.schema(SKETCH).parquet(sketch_path(p)), m.part_stats[p]["sketch_bits"]) for p in asked]
            hit = {r.part for r in probable_members(orders, "order_id", sketches).select("part").distinct().collect()}
            asked = [p for i, p in enumerate(asked) if i in hit]
        return [p for p in paths if p in plain or p in asked]

    def fact(self, paths: list[str]) -> DataFrame:
        """Fact rows of some parts."""
        if not paths:
            return self.empty(FACT_TABLE)
        return self.spark.read.schema(WAREHOUSE_TABLES[FACT_TABLE]).parquet(*paths)

    def rows(self, table: str, manifest: Manifest | None = None, part: str | None = None) -> int:
        m = manifest or self.require()
        return m.rows.get(part_key(table, part), 0) if part else m.table_rows(table)

    def watermark_table(self, manifest: Manifest | None = None) -> DataFrame:
        """``ctl.watermark`` view of the control state."""
        m = manifest or self.require()
        if m.run_type == "INIT":
            return self.spark.createDataFrame([], WATERMARK)
        ts = _dt.datetime.fromisoformat(m.watermark_updated_at) if m.watermark_updated_at else None
        return self.spark.createDataFrame([(WATERMARK_ENTITY, m.watermark, ts)], WATERMARK)

    def sequence_table(self, manifest: Manifest | None = None) -> DataFrame:
        """``ctl.surrogate_key_seq`` view of the control state."""
        m = manifest or self.require()
        return self.spark.createDataFrame(sorted(m.next_sk.items()), SURROGATE_KEY_SEQ)

    # ------------------------------------------------------------------ writing
    def write_part(
        self,
        run_id: int,
        table: str,
        df: DataFrame,
        part: str | None = None,
        sort_by: list[str] | None = None,
        tag: str | None = None,
    ) -> tuple[str, int]:
        """Write one part (schema-checked) and return ``(path, rows)``."""
        path, rows, _ = self.write_part_observed(run_id, table, df, part, sort_by, tag)
        return path, rows

    def write_part_observed(
        self,
        run_id: int,
        table: str,
        df: DataFrame,
        part: str | None = None,
        sort_by: list[str] | None = None,
        tag: str | None = None,
        metrics: dict[str, Column] | None = None,
    ) -> tuple[str, int, dict]:
        """Write one part; return ``(path, rows, metrics)``.

        The row count and any extra aggregate ``metrics`` are observed while
        the write runs (no second pass), in the write's result stage, where
        each successful task is counted exactly once even when tasks are
        retried after a lost executor."""
        out = project_to(df, WAREHOUSE_TABLES[table])
        obs = Observation(f"write_{uuid.uuid4().hex}")
        extra = [c.alias(k) for k, c in (metrics or {}).items()]
        out = out.observe(obs, F.count(F.lit(1)).alias("__rows"), *extra)
        if sort_by:
            out = out.sortWithinPartitions(*sort_by)
        name = part_key(table, part).replace("#", "__") + (f"__{tag}" if tag else "")
        path = f"{self.root}/runs/{run_id}-{self.attempt}/{name}"
        out.write.mode("overwrite").parquet(path, compression=CODEC)
        observed = obs.get
        return path, int(observed["__rows"]), {k: observed.get(k) for k in (metrics or {})}

    def write_sketch(self, path: str, rows: int) -> int:
        """Keep the sketch of a fact part's order ids beside it; its size in bits.
        Of the ids each is taken once: an order's lines lie in many files, and
        every line's bits would be shuffled."""
        bits = bits_for(rows)
        build_sketch(self.fact([path]).select("order_id").distinct(), "order_id", bits).sortWithinPartitions("word").write.parquet(sketch_path(path))
        return bits

    def write_split_parts(
        self, run_id: int, table: str, df: DataFrame, split: Column, labels: tuple[str, str]
    ) -> dict[str, tuple[str, int]]:
        """One write that yields two parts: rows where ``split`` is true go to
        ``labels[0]``, the others to ``labels[1]`` (a partitioned write, one
        pass over ``df``). Returns ``label -> (path, rows)`` for non-empty parts;
        per-part row counts are observed during the write."""
        out = project_to(df, WAREHOUSE_TABLES[table])
        out = out.withColumn("__part", F.when(split, F.lit(labels[0])).otherwise(F.lit(labels[1])))
        obs = Observation(f"write_{uuid.uuid4().hex}")
        out = out.observe(
            obs,
            F.sum(F.when(F.col("__part") == labels[0], 1).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("__part") == labels[1], 1).otherwise(0)).alias("b"),
        )
        path = f"{self.root}/runs/{run_id}-{self.attempt}/{table}"
        out.write.mode("overwrite").partitionBy("__part").parquet(path, compression=CODEC)
        got = obs.get
        counts = {labels[0]: int(got["a"] or 0), labels[1]: int(got["b"] or 0)}
        return {lab: (f"{path}/__part={lab}", n) for lab, n in counts.items() if n}

    def merge_parts(self, m: Manifest) -> Manifest:
        """``m`` with the smaller parts of every key that has more than
        ``MAX_PARTS`` merged into one. A merge leaves half as many parts, so a
        row is rewritten about as often as its table doubles."""
        for key, paths in m.parts.items():
            if len(paths) <= MAX_PARTS:
                continue
            by_size = sorted(paths, key=lambda p: m.part_rows.get(p, 0))
            small = by_size[: len(paths) - MAX_PARTS // 2]
            table = key.split("#")[0]
            df = self.spark.read.schema(WAREHOUSE_TABLES[table]).parquet(*small)
            path = f"{self.root}/runs/{m.run_id}-{self.attempt}/{key.replace('#', '__')}__merged"
            rows = sum(m.part_rows.get(p, 0) for p in small)
            df.coalesce(max(1, rows // MERGED_FILE_ROWS)).sortWithinPartitions(*SORT.get(table, [df.columns[0]])).write.parquet(path, compression=CODEC)
            m.parts[key] = [p for p in paths if p not in small] + [path]
            m.part_rows[path] = rows
            stats = [m.part_stats.pop(p, None) for p in small]
            if table == FACT_TABLE and all(stats):
                m.part_stats[path] = {
                    "min_order_id": min(s["min_order_id"] for s in stats),
                    "max_order_id": max(s["max_order_id"] for s in stats),
                    "sketch_bits": self.write_sketch(path, rows),
                }
            for p in small:
                m.part_rows.pop(p, None)
        return m

    def publish(self, manifest: Manifest, after: int | None = None) -> Manifest:
        """Make a run visible: one JSON file, written last and exclusively.

        ``after`` is the run id this run started from (``None``: there was
        none); if that isn't the newest one any more, or the run id is taken,
        the publish is refused: the other run wins."""
        current = self.latest_run()
        if current != after:
            raise ConcurrentRunError(
                f"run {manifest.run_id} started after run {after}, but run {current} is now the latest; not publishing"
            )
        live = {p for paths in manifest.parts.values() for p in paths}
        manifest.part_rows = {p: n for p, n in manifest.part_rows.items() if p in live}
        if not create_small_file(self.spark, f"{self.manifest_dir}/{manifest.run_id}.json", manifest.to_json()):
            raise ConcurrentRunError(f"run {manifest.run_id} was published by another writer; not publishing")
        return manifest

    def expire(self, keep: int) -> list[str]:
        """Remove what only runs before the newest ``keep`` (one at least) used:
        replaced and merged parts with their sketches, parts of attempts that
        were never published, and the older manifests; returns what went, below
        ``runs``. Time travel ends at the oldest run kept, and readers of older
        runs must have finished. Folders of runs that aren't published yet stay.

        Manifests go first, so a removal that breaks off leaves no manifest that
        names a missing part; the next one goes on. Names only: no Spark job."""
        names = list_folder(self.spark, self.manifest_dir) or []
        ids = sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[: -len(".json")].isdigit())
        kept = ids[-max(1, keep) :]
        live = {_below(p) for run_id in kept for paths in self.manifest(run_id).parts.values() for p in paths}
        live |= {sketch_path(p) for p in live}
        for run_id in ids[: -len(kept)]:
            remove_folder(self.spark, f"{self.manifest_dir}/{run_id}.json")
        gone = []
        for folder in list_folder(self.spark, f"{self.root}/runs") or []:
            run_id = folder.split("-")[0]
            if not run_id.isdigit() or int(run_id) > kept[-1]:
                continue
            unused = self._unused(folder, live)
            for path in unused:
                remove_folder(self.spark, f"{self.root}/runs/{path}")
            gone += unused
        return gone

    def _unused(self, folder: str, live: set[str]) -> list[str]:
        """Paths below a folder of runs that hold no live part, the highest that do so."""
        if folder in live:
            return []
        if not any(p.startswith(f"{folder}/") for p in live):
            return [folder]
        below = [n for n in list_folder(self.spark, f"{self.root}/runs/{folder}") or [] if not n.startswith((".", "_SUCCESS"))]
        return [p for n in below for p in self._unused(f"{folder}/{n}", live)]

    def end_attempt(self, run_id: int, failed: bool) -> None:
        """Remove this attempt's pins and, if it failed, its parts."""
        remove_folder(self.spark, self.pins)
        if failed:
            remove_folder(self.spark, f"{self.root}/runs/{run_id}-{self.attempt}")


def _below(path: str) -> str:
    """A part's path below the folder of all runs."""
    return path.split("/runs/", 1)[1].rstrip("/")


class ConcurrentRunError(RuntimeError):
    pass


def carry_parts(m: Manifest, prev: Manifest | None, keep: list[str]) -> Manifest:
    """``m`` with the parts (and what is known of them) that it inherits unchanged."""
    for key in keep:
        if prev is not None and key in prev.parts:
            m.parts[key] = list(prev.parts[key])
            m.rows[key] = prev.rows.get(key, 0)
            for p in m.parts[key]:
                m.part_rows[p] = prev.part_rows.get(p, 0)
                if p in prev.part_stats:
                    m.part_stats[p] = prev.part_stats[p]
    return m


def add_part(m: Manifest, key: str, path: str, n: int, append: bool) -> None:
    """Add a part to a key, or make it the key's only one."""
    if append:
        m.parts.setdefault(key, []).append(path)
        m.rows[key] = m.rows.get(key, 0) + n
    else:
        m.parts[key] = [path]
        m.rows[key] = n
    m.part_rows[path] = n
