"""Hard-negative mining over a multiway hyperplane tree (GNAT).

Vectors are made whole numbers, floor(256 x) for each component, so scores are
exact integer inner products. With M the greatest norm of all vectors, a vector
x gets one more component sqrt(M^2 - |x|^2) and a query q the component 0; then
|q - x|^2 = |q|^2 + M^2 - 2 q.x, so a window of scores is an annulus of distances
around the query, and best scores are nearest neighbours.

The tree: a node has split points; a vector belongs to the nearest one (the
region between hyperplanes). Every split point stores, for each sibling's
subtree, the least and greatest distance of that subtree's vectors. Split points
are chosen from a sample of at most ``SAMPLE`` vectors; the ranges cover all
vectors, which are all indexed. Two levels of at most ``WAYS`` split points each
grow with the number of vectors, and lead to leaves. A query visits a child only
if, from every split point of its node, the child's range meets the annulus:
not beyond its outer and not wholly inside its inner circle. Leaves are scanned
exactly, in blocks of at most ``BLOCK`` vectors and ``QUERIES`` queries, each a
task's group of bounded size; copies of one vector fill blocks like any others.

Searches take two rounds: a query's home leaf gives it k candidates, the worst
of which shrinks the annulus for the visits of the other leaves. A block returns
k candidates a query at most.

Anchors are a stated query set: rows whose id is divisible by ``ANCHOR_EVERY``.

Defined results: rows with a null label, a null or empty vector, or a null or
non-finite component take no part; vectors of different length don't meet; a
null id is no anchor and comes last among ties; repeated rows are rows of their
own, also as positives and negatives; an anchor without positives, or without a
negative in the window, gives no row; an empty table stays empty; other columns
are not read. Scores beyond 64 bits end the job with an error.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.common import materialize

SCALE = 256
ANCHOR_EVERY = 50
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95  # percent of the positive's score
SAMPLE = 4096
WAYS = 32
LEAF = 2048  # vectors a leaf is meant to hold
BLOCK = 16384
QUERIES = 8192
_EXACT = 2.0**53
_SLACK = 1e-6  # slack of distances relative to the greatest norm, for rounding


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers (float64) as int64."""
    if not len(q) or not len(x):
        return np.zeros((len(q), len(x)), np.int64)
    if np.abs(q).max() * np.abs(x).max() * q.shape[1] < _EXACT:
        return (q @ x.T).astype(np.int64)
    whole = [[int(v) for v in row] for row in x.tolist()]
    out = [[sum(a * b for a, b in zip(row, other)) for other in whole] for row in ([int(v) for v in r] for r in q.tolist())]
    return np.array(out, dtype=np.int64)  # OverflowError beyond 64 bits


@dataclass
class Node:
    """Split points (lifted vectors) and, for every split point i and child j,
    the range of distances from i to the vectors below j."""

    points: np.ndarray
    least: np.ndarray
    most: np.ndarray

    @classmethod
    def without_ranges(cls, points: np.ndarray) -> Node:
        n = len(points)
        return cls(points, np.full((n, n), np.inf), np.full((n, n), -np.inf))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sq = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * (a @ b.T)
    return np.sqrt(np.maximum(sq, 0))


def spread_points(sample: np.ndarray, n: int) -> np.ndarray:
    """At most n different split points, each the farthest from those before."""
    chosen = [0]
    d = distances(sample, sample[:1])[:, 0]
    while len(chosen) < n and d.max() > 0:
        chosen.append(int(d.argmax()))
        d = np.minimum(d, distances(sample, sample[chosen[-1] :][:1])[:, 0])
    return sample[chosen]


def lift(v: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the component that gives all of them the norm ``top``."""
    rest = np.sqrt(np.maximum(top * top - (v * v).sum(axis=1), 0))
    return np.concatenate([v, rest[:, None]], axis=1)


def visits(node: Node, d: np.ndarray, inner: np.ndarray, outer: np.ndarray, slack: float) -> np.ndarray:
    """(queries x children): whether the child may hold a vector whose distance
    from the query lies between ``inner`` and ``outer``; ``d`` holds the
    queries' distances to the split points."""
    # by the triangle inequality the query's distances to child j lie in [low, high], as seen from split point i
    low = np.maximum(node.least[None] - d[:, :, None], d[:, :, None] - node.most[None]).max(axis=1)
    high = (d[:, :, None] + node.most[None]).min(axis=1)
    known = np.isfinite(node.least).all(axis=0)[None]  # a child without vectors is never visited
    return known & (low <= outer[:, None] + slack) & (high >= inner[:, None] - slack)


def _whole(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label, v array<double> of whole numbers, for the rows that take part."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = df.where(F.col(label_col).isNotNull() & F.coalesce((F.size(v) > 0) & ~bad, F.lit(False)))
    # a double beyond 2^53 is whole as it is, so floor is only taken below
    whole = F.transform(v, lambda x: F.when(F.abs(x) < 2.0**44, F.floor(x * float(SCALE)).cast("double")).otherwise(x * float(SCALE)))
    return some.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), whole.alias("v"))


def _matrix(column) -> np.ndarray:
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


class Tree:
    """The split points and ranges of vectors of one length (driver side: a
    bounded number of nodes), and the rows by leaf."""

    def __init__(self, rows: DataFrame, n: int, top: float) -> None:
        self.top = top
        leaves = max(1, -(-n // LEAF))
        ways = int(min(WAYS, max(2, np.ceil(np.sqrt(leaves))))) if leaves > 1 else 1
        drawn = rows.orderBy(F.xxhash64("v"), "uid").limit(SAMPLE).select("v").collect()
        sample = lift(np.array([r["v"] for r in drawn], np.float64), top)
        points = spread_points(sample, ways)
        home = distances(sample, points).argmin(axis=1)
        below = [spread_points(sample[home == j], ways) for j in range(len(points))]
        self.root, self.inner = Node.without_ranges(points), [Node.without_ranges(m) for m in below]
        self.indexed = materialize(self._assign(rows), "tree")
        self._measure()

    @property
    def slack(self) -> float:
        return _SLACK * max(self.top, 1.0)

    def _assign(self, rows: DataFrame) -> DataFrame:
        """Every row with the leaf it belongs to."""
        shipped, top = rows.sparkSession.sparkContext.broadcast((self.root, self.inner)), self.top

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            root, inner = shipped.value
            for b in batches:
                if b.num_rows:
                    own = _own_leaves(root, inner, lift(_matrix(b.column(3)), top))
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.astype(np.int32))], names=names)

        src = rows.select("uid", "id", "label", "v")
        names = [*src.columns, "leaf"]
        return src.mapInArrow(run, T.StructType([*src.schema.fields, T.StructField("leaf", T.IntegerType())]))

    def _measure(self) -> None:
        """Least and greatest distance from every split point to every
        sibling's vectors, over all rows: partial ranges a task, then one row
        a pair of split points."""
        indexed = self.indexed
        shipped, top = indexed.sparkSession.sparkContext.broadcast((self.root.points, [m.points for m in self.inner])), self.top

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            points, below = shipped.value
            found: dict[tuple[int, int], list[np.ndarray]] = {}

            def note(node: int, child: int, d: np.ndarray) -> None:
                lo, hi = d.min(axis=0), d.max(axis=0)
                had = found.get((node, child))
                found[node, child] = [lo, hi] if had is None else [np.minimum(had[0], lo), np.maximum(had[1], hi)]

            for b in batches:
                if not b.num_rows:
                    continue
                x, leaf = lift(_matrix(b.column(0)), top), b.column(1).to_numpy()
                d = distances(x, points)
                for j in np.unique(leaf // WAYS):
                    note(-1, int(j), d[leaf // WAYS == j])
                for at in np.unique(leaf):
                    note(int(at) // WAYS, int(at) % WAYS, distances(x[leaf == at], below[at // WAYS]))
            rows = [(n, c, i, float(lo[i]), float(hi[i])) for (n, c), (lo, hi) in found.items() for i in range(len(lo))]
            cols = list(zip(*rows)) if rows else [()] * 5
            types = [pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["node", "child", "i", "least", "most"])

        got = indexed.select("v", "leaf").mapInArrow(run, "node int, child int, i int, least double, most double")
        for r in got.groupBy("node", "child", "i").agg(F.min("least").alias("least"), F.max("most").alias("most")).collect():
            node = self.root if r["node"] < 0 else self.inner[r["node"]]
            node.least[r["i"], r["child"]] = r["least"]
            node.most[r["i"], r["child"]] = r["most"]


def _own_leaves(root: Node, inner: list[Node], x: np.ndarray) -> np.ndarray:
    first = distances(x, root.points).argmin(axis=1)
    own = np.zeros(len(x), np.int64)
    for j in np.unique(first):
        own[first == j] = j * WAYS + distances(x[first == j], inner[j].points).argmin(axis=1)
    return own


def _leaves(root: Node, inner: list[Node], x: np.ndarray, near: np.ndarray, far: np.ndarray, slack: float) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, places of the queries that must visit it)."""
    alive = visits(root, distances(x, root.points), near, far, slack)
    for j, node in enumerate(inner):
        at = np.flatnonzero(alive[:, j])
        if len(at):
            below = visits(node, distances(x[at], node.points), near[at], far[at], slack)
            for c in range(len(node.points)):
                hit = at[below[:, c]]
                if len(hit):
                    yield j * WAYS + c, hit


def _dealt(tree: Tree, queries: DataFrame, windows: DataFrame, home: bool) -> DataFrame:
    """Queries with their windows at the leaf that is their home, or (``home``
    false) at all others that a window's annulus meets."""
    shipped = queries.sparkSession.sparkContext.broadcast((tree.root, tree.inner, tree.top, tree.slack))
    per_query = windows.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("pair", "low", "high"))).alias("wins"))
    asked = queries.join(per_query, "qid").select("qid", "label", "wins.pair", "wins.low", "wins.high", "v")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        root, inner, top, slack = shipped.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                q = _matrix(b.column(5))
                x = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
                own = _own_leaves(root, inner, x)
                if home:
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.astype(np.int32))], names=names)
                    continue
                low = np.array([min(w) for w in b.column(3).to_pylist()], np.float64)
                high = np.array([max(w) for w in b.column(4).to_pylist()], np.float64)
                base = (q * q).sum(axis=1) + top * top
                near, far = (np.sqrt(np.maximum(base - 2 * s, 0)) for s in (high, low))
                for leaf, hit in _leaves(root, inner, x, near, far, slack):
                    hit = hit[own[hit] != leaf]
                    if len(hit):
                        yield pa.RecordBatch.from_arrays([*b.take(pa.array(hit)).columns, pa.array(np.full(len(hit), leaf, np.int32))], names=names)

    names = [*asked.columns, "leaf"]
    return asked.mapInArrow(run, T.StructType([*asked.schema.fields, T.StructField("leaf", T.IntegerType())]))


def _scan(k: int, same_label: bool):
    """A block of a leaf and a block of queries -> the k best of each window."""

    def run(group):
        import pyarrow as pa

        asks = group.column("wants").to_numpy(zero_copy_only=False)
        v = _matrix(group.column("v"))
        qid, uid, label = (group.column(c).to_numpy(zero_copy_only=False) for c in ("qid", "uid", "label"))
        pair, low, high = (group.column(c).combine_chunks() for c in ("pair", "low", "high"))
        ids = group.column("id").combine_chunks()
        no_id, plain = ids.is_null().to_numpy(zero_copy_only=False), ids.fill_null(0).to_numpy(zero_copy_only=False)
        ask, there = np.flatnonzero(asks), np.flatnonzero(~asks)
        there = there[np.lexsort((uid[there], plain[there], no_id[there]))]  # equal scores: by id, nulls last
        pairs, places, found = [], [], []
        for at in range(0, len(ask), 64):
            some = ask[at : at + 64]
            s = scores(v[some], v[there])
            fits = (label[some][:, None] == label[there][None]) == same_label
            fits &= qid[some][:, None] != uid[there][None]
            for i, row in enumerate(some):
                open_at = np.flatnonzero(fits[i])
                mine = s[i, open_at]
                for p, lo, hi in zip(pair[row].as_py(), low[row].as_py(), high[row].as_py()):
                    hit = np.flatnonzero((mine >= lo) & (mine <= hi))
                    best = hit[np.argsort(-mine[hit], kind="stable")[:k]]
                    pairs += [p] * len(best)
                    places.append(there[open_at[best]])
                    found.append(mine[best])
        at = np.concatenate(places) if places else np.zeros(0, np.int64)
        score = np.concatenate(found) if found else np.zeros(0, np.int64)
        return pa.table({"pair": pa.array(pairs, pa.int64()), "uid": pa.array(uid[at], pa.int64()), "id": ids.take(pa.array(at, pa.int64())), "score": pa.array(score, pa.int64())})

    return run


def _round(tree: Tree, dealt: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The k best of every window in each (block of a leaf, block of queries)."""
    dealt = materialize(dealt, "tree")
    blocks = tree.indexed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("h"))
    asks = dealt.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("w"))
    sizes = F.broadcast(blocks.join(asks, "leaf"))  # a row a leaf: WAYS * WAYS at most
    none = F.array().cast("array<long>")
    to, fro = F.expr("explode(sequence(0, w - 1))"), F.expr("explode(sequence(0, h - 1))")
    nothing = F.lit(None).cast("long")
    data = tree.indexed.join(sizes, "leaf").select("leaf", F.pmod(F.xxhash64("uid"), F.col("h")).cast("int").alias("a"), to.alias("b"), F.lit(False).alias("wants"), F.lit(-1).cast("long").alias("qid"), "uid", "id", "label", none.alias("pair"), none.alias("low"), none.alias("high"), "v")
    ask = dealt.join(sizes, "leaf").select("leaf", fro.alias("a"), F.pmod(F.xxhash64("qid"), F.col("w")).cast("int").alias("b"), F.lit(True).alias("wants"), "qid", F.lit(-1).cast("long").alias("uid"), nothing.alias("id"), "label", "pair", "low", "high", "v")
    return data.unionByName(ask).groupBy("leaf", "a", "b").applyInArrow(_scan(k, same_label), "pair long, uid long, id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("pair").orderBy(F.desc("score"), F.asc_nulls_last("id"), "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(tree: Tree, queries: DataFrame, windows: DataFrame, k: int, same_label: bool) -> DataFrame:
    """The k best rows of every window: pair, uid, id, score, rank.

    ``queries``: qid (the query's own row, never returned), label, v;
    ``windows``: qid, pair (names the window), low, high (scores, both
    included). Exact: a leaf is left out only if the ranges show that none of
    its rows can be among the k best."""
    first = materialize(_best(_round(tree, _dealt(tree, queries, windows, home=True), k, same_label), k), "tree")
    worst = first.where(F.col("rank") == k).select("pair", F.col("score").alias("worst"))
    shrunk = windows.join(worst, "pair", "left").select("qid", "pair", F.greatest("low", "worst").alias("low"), "high")
    others = _round(tree, _dealt(tree, queries, shrunk, home=False), k, same_label)
    return materialize(_best(first.drop("rank").unionByName(others), k), "tree")


def mine(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", anchors: str = f"id % {ANCHOR_EVERY} = 0", positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchors``: SQL condition on ``id`` that names the query set."""
    rows = materialize(_whole(df, id_col, vector_col, label_col).withColumn("uid", F.monotonically_increasing_id()), "tree")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    kinds = rows.groupBy(F.size("v").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("top")).collect()
    out = df.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for kind in kinds:  # vectors of one length; a table has one, as a rule
        own = rows.where(F.size("v") == kind["size"])
        if kind["top"] < 1 << 31:
            own = own.withColumn("v", F.col("v").cast("array<int>"))
        tree = Tree(own, kind["n"], kind["top"])
        queries = materialize(tree.indexed.where(anchors).select(F.col("uid").alias("qid"), "id", "label", "v"), "tree")
        everything = queries.select("qid", F.col("qid").alias("pair"), F.lit(-(1 << 63)).alias("low"), F.lit((1 << 63) - 1).alias("high"))
        pos = search(tree, queries.drop("id"), everything, positives, same_label=True)
        pairs = pos.select(F.monotonically_increasing_id().alias("_pair"), F.col("pair").alias("qid"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        pairs = materialize(pairs.withColumnRenamed("_pair", "pair"), "tree")
        # LOW p <= 100 n <= HIGH p in whole numbers; of a negative p there is no such n
        p = "cast(positive_score AS decimal(30))"
        low, high = F.expr(f"({LOW} * {p} + 99) div 100"), F.expr(f"({HIGH} * {p}) div 100")
        windows = pairs.where("positive_score >= 0").select("qid", "pair", low.alias("low"), high.alias("high"))
        neg = search(tree, queries.drop("id"), windows, negatives, same_label=False)
        found = neg.join(pairs, "pair").join(queries.select("qid", F.col("id").alias("anchor_id")), "qid")
        found = found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out = out.unionByName(found)
    return out


def relabelled(df: DataFrame) -> DataFrame:
    """Rows with every seventh id's label moved on by one, of ten."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return df.select("vec_id", "embedding", label.alias("label"))


SQL = f"""
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v, row_number() OVER () AS u
  FROM embeddings WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.u AS anchor, a.id AS anchor_id, x.u, x.id, x.label = a.label AS same, list_inner_product(a.v, x.v)::BIGINT AS score
  FROM v a JOIN v x ON a.id % {ANCHOR_EVERY} = 0 AND a.u <> x.u AND len(a.v) = len(x.v)),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id NULLS LAST, u) <= {POSITIVES}),
n AS (
  SELECT p.anchor_id, p.id AS positive_id, p.score AS positive_score, x.id AS negative_id, x.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.u ORDER BY x.score DESC, x.id NULLS LAST, x.u) AS rank
  FROM p JOIN s x ON x.anchor = p.anchor AND NOT x.same AND {LOW} * p.score <= 100 * x.score AND 100 * x.score <= {HIGH} * p.score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= {NEGATIVES}
"""
