"""Embedding near-duplicates: an exact metric range join.

Two vectors link if their labels are equal and their cosine, in double
precision, reaches the threshold t. On unit vectors that is a distance of at
most r = sqrt(2 - 2t). A few vectors serve as pivots; every vector's home is
the cell of its nearest pivot. For x at home with pivot i and y at home with
pivot j the triangle inequality gives d(y, i) - d(y, j) <= 2 d(x, y), and in
this space the sharper d(y, i)^2 - d(y, j)^2 <= 2 d(i, j) d(x, y); so y is
replicated to a cell i in front of its own exactly if its difference of
squares is at most 2 r d(i, j). A pair is compared in the first of its homes
only. Cells then join on their own; a cell with more than ``BLOCK`` vectors is
cut into blocks, and each pair of blocks is a group of its own, so a label or
cell that holds a third of all rows is spread over many tasks of bounded size.

Equal vectors of one label are one entry with a count, however many there are.
A group gives each entry its number of links and a spanning forest; pairs are
never written out. Components come from :mod:`starloom.llm.components`.

Defined results: null labels, null or empty vectors, zero vectors and vectors
with a null, NaN or infinite component link with nothing, not even a copy;
vectors of different length don't link; repeated rows link like any others; a
row without vec_id counts as a row, and as no id; an empty table stays empty.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import materialize
from starloom.llm.components import connected_components, local_roots

THRESHOLD = 0.98
PIVOTS = 16
BLOCK = 2048
_CLOSE = 1e-12  # cosines this near the threshold are summed again without rounding


def _valid() -> F.Column:
    v = F.col("_v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col("_label").isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def cosines(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether each row of a reaches the threshold with each row of b."""
    na, nb = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    c = (a / na[:, None]) @ (b / nb[:, None]).T
    for i, j in zip(*np.nonzero(np.abs(c - threshold) < _CLOSE)):
        dot = math.fsum(x * y for x, y in zip(a[i].tolist(), b[j].tolist()))
        c[i, j] = dot / math.sqrt(math.fsum(x * x for x in a[i].tolist()) * math.fsum(x * x for x in b[j].tolist()))
    return c >= threshold


def _cells(entries: DataFrame, pivots: list[list[float]], threshold: float) -> DataFrame:
    """Entries at home (``replica`` false) and in the cells they border on."""
    by_length: dict[int, np.ndarray] = {}
    for p in pivots:
        by_length.setdefault(len(p), []).append(np.asarray(p, np.float64) / np.linalg.norm(p))
    by_length = {n: np.array(p) for n, p in by_length.items()}
    reach = 2 * math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-7
    shipped = entries.sparkSession.sparkContext.broadcast(by_length)  # PIVOTS vectors
    names = ["rid", "n", "label", "v", "cell", "replica"]
    out = T.StructType([*(entries.schema[c] for c in names[:4]), T.StructField("cell", T.IntegerType()), T.StructField("replica", T.BooleanType())])

    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows, cell, replica = [], [], []
            for i, v in enumerate(b.column(3)):
                v = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
                p = shipped.value.get(len(v))
                homes = [0]
                if p is not None:
                    scale = np.abs(v).max()
                    u = v / scale
                    d = 2 - 2 * (p @ (u / np.linalg.norm(u)))
                    home = int(d.argmin())
                    between = np.sqrt(np.maximum(0, 2 - 2 * (p[:home] @ p[home])))
                    homes = [home, *np.flatnonzero(d[:home] - d[home] <= reach * between + 1e-9).tolist()]
                rows += [i] * len(homes)
                cell += homes
                replica += [False] + [True] * (len(homes) - 1)
            took = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*took.columns, pa.array(cell, pa.int32()), pa.array(replica, pa.bool_())], names=names)

    return entries.select(*names[:4]).mapInArrow(run, out)


def _linked(threshold: float):
    """One group: entries of block a and block b of a cell -> rows (rid, links, parent)."""

    def run(group):
        import pyarrow as pa

        rid = group.column("rid").to_numpy()
        n = group.column("n").to_numpy()
        block = group.column("block").to_numpy()
        flat = group.column("v").combine_chunks().values.to_numpy(zero_copy_only=False).astype(np.float64)
        v = flat.reshape(len(rid), -1)
        v = v / np.abs(v).max(axis=1, keepdims=True)
        a, b = group.column("a")[0].as_py(), group.column("b")[0].as_py()
        left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
        links = np.zeros(len(rid), np.int64)
        found_i, found_j = [], []
        for at in range(0, len(left), 256):
            some = left[at : at + 256]
            i, j = np.nonzero(cosines(v[some], v[right], threshold)) if len(right) else (np.zeros(0, int),) * 2
            i, j = some[i], right[j]
            if a == b:
                i, j = i[i < j], j[i < j]
            np.add.at(links, i, n[j])
            np.add.at(links, j, n[i])
            roots = local_roots(len(rid), i, j)  # a forest of the strip's links
            child = np.flatnonzero(roots != np.arange(len(rid)))
            found_i.append(child)
            found_j.append(roots[child])
        i, j = (np.concatenate(f) if f else np.zeros(0, int) for f in (found_i, found_j))
        root = local_roots(len(rid), i, j)
        hit = np.flatnonzero(links)
        return pa.table({"rid": rid[hit], "links": links[hit], "parent": rid[root[hit]]})

    return run


def links(entries: DataFrame, threshold: float = THRESHOLD, pivots: int = PIVOTS) -> DataFrame:
    """``entries`` (rid, n, label, v; valid, distinct) -> rows (rid, links,
    parent): links of an entry within one group of one cell, weighted by n,
    and an entry of the same group it is connected to."""
    chosen = [r["v"] for r in entries.orderBy(F.xxhash64("v", "label"), "rid").limit(pivots).select("v").collect()]
    cells = materialize(_cells(entries, chosen, threshold), "embeddings")
    key = ["label", "length", "cell"]
    cells = cells.withColumn("length", F.size("v"))
    sizes = cells.groupBy(*key).agg(F.count_if(~F.col("replica")).alias("home"), F.count_if("replica").alias("away"))
    sizes = sizes.where("home > 0 and home + away > 1").select(*key, F.ceil(F.col("home") / BLOCK).cast("int").alias("h"), F.ceil(F.col("away") / BLOCK).cast("int").alias("w"))
    dealt = cells.join(sizes, key).withColumn("block", F.when(F.col("replica"), F.col("h") + F.pmod(F.xxhash64("rid"), F.col("w"))).otherwise(F.pmod(F.xxhash64("rid"), F.col("h"))).cast("int"))
    with_home = "transform(sequence(0, h - 1), o -> struct(least(o, block) AS a, greatest(o, block) AS b))"
    with_away = "CASE WHEN replica OR w = 0 THEN array() ELSE transform(sequence(h, h + w - 1), o -> struct(block AS a, o AS b)) END"
    groups = dealt.withColumn("s", F.explode(F.concat(F.expr(with_home), F.expr(with_away)))).select(*key, "s.a", "s.b", "block", "rid", "n", "v")
    return groups.groupBy(*key, "a", "b").applyInArrow(_linked(threshold), "rid long, links long, parent long")


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = THRESHOLD, pivots: int = PIVOTS) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept."""
    rows = df.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"), F.col(vector_col).alias("_v")).withColumn("_ok", _valid())
    same = rows.where("_ok").groupBy("_label", "_v").agg(F.count(F.lit(1)).alias("n"), F.min("_id").alias("least"))
    entries = materialize(same.select(F.monotonically_increasing_id().alias("rid"), "n", F.col("_label").alias("label"), F.col("_v").alias("v"), "least"), "embeddings")
    found = materialize(links(entries, threshold, pivots), "embeddings")
    counts = found.groupBy("rid").agg(F.sum("links").alias("links"))
    roots = connected_components(found, "rid", "parent").select(F.col("node").alias("rid"), "root")
    least = roots.join(entries.select("rid", "least"), "rid").groupBy("root").agg(F.min("least").alias("component"))
    parts = roots.join(least, "root").select("rid", "component")
    known = entries.join(counts, "rid", "left").join(parts, "rid", "left")
    known = known.select(F.col("label").alias("_l"), F.col("v").alias("_w"), (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "least").alias("component_id"))
    known = materialize(known, "embeddings")
    valid = rows.where("_ok").join(known, (F.col("_label") == F.col("_l")) & (F.col("_v") == F.col("_w"))).select("_id", "n_links", "component_id")
    alone = rows.where("NOT _ok").select("_id", F.lit(0).cast("long").alias("n_links"), F.col("_id").alias("component_id"))
    out = valid.unionByName(alone)
    return out.select(F.col("_id").alias("vec_id"), "n_links", "component_id", F.coalesce(F.col("_id") == F.col("component_id"), F.lit(False)).alias("kept"))


SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id AND len(x.e) = len(y.e)
  WHERE list_cosine_similarity(x.e, y.e) >= {THRESHOLD}),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(m, vec_id)) AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) c ON c.a = vec_id
LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = vec_id
"""
