"""Mixing sources to target weights.

Each row gets a key: a hash of its id and whole text, so the order within a
source is random, yet every rerun finds the same. Rows that repeat (same
source, id, text) share a key and are one group of the order. The groups are
range-sorted by (source, key); words are summed up within each range and,
from the ranges' totals, before it, which gives every group its distributed
prefix sum. Each source is then cut where its budget ends: whole epochs first
(every row as often as the budget holds the source's total), then, in key
order, rows until the rest is spent; the row the cut falls into is taken in
part. Members of a repeated group at the cut share alike, rounded down.

Targets: all sources together share the words of the table by weight; weights
repeat along the sources in code-point order, null last; a source's target
stops at ``max_epochs`` times its own words, and what it leaves is shared by
weight among the others until none is above. The water level that does this
is found from sums over sources; a few numbers per step reach the driver.

Only ids, sources, keys and sizes are shuffled, never texts. A source that
holds a third of all rows is split over many ranges; per-source totals are
aggregated before they are shuffled.

Defined results: a null or blank text has size 0 and nothing is taken of it;
a null source is a source of its own; a table without words has targets 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.common import materialize, without
from starloom.operators.keys import dense_index

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"
_SEED = 20_011


def _size(text_col: str) -> F.Column:
    return F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")


def _keyed(df: DataFrame, id_col: str, text_col: str) -> list[F.Column]:
    """Two 64-bit hashes of id and whole text: the random order and its tie-break."""
    return [
        F.xxhash64(F.lit(_SEED), F.col(id_col), F.col(text_col)).alias("_key"),
        F.xxhash64(F.lit(_SEED + 1), F.col(text_col), F.col(id_col)).alias("_tie"),
    ]


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size) of all sources -> with ``target double``."""
    order = [F.col("source").isNull(), F.col("source")]
    numbered, count = dense_index(sizes, order, start=0, index_col="_n")
    if count == 0:
        return sizes.select("source", "source_size", F.lit(0.0).alias("target"))
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_n") % len(weights) + 1).cast("int"))
    s = numbered.select("source", "source_size", share.alias("_w"), (F.col("source_size") * float(max_epochs)).alias("_cap"))
    total = s.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:  # each step caps one more source at least
        capped = F.col("_cap") <= F.col("_w") * level
        taken, open_w = s.agg(
            F.sum(F.when(capped, F.col("_cap")).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("_w"))),
        ).first()
        if not open_w:
            break
        rising = (total - taken) / open_w
        if rising <= level:
            break
        level = rising
    return s.select("source", "source_size", F.least(F.col("_cap"), F.col("_w") * F.lit(level)).alias("target"))


def plan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, target, epochs (times every
    row is taken), and the cut: keys below (cut_key, cut_tie) are taken once
    more, those at it ``cut_words`` words more, ``cut_more`` of them (the cut
    falls into a group of repeated rows) one word more than that."""
    rows = df.select(F.col(source_col).alias("source"), *_keyed(df, id_col, text_col), _size(text_col).alias("z"))
    groups = rows.groupBy("source", "_key", "_tie", "z").agg(F.count(F.lit(1)).alias("g"))
    order = ["source", "_key", "_tie", "z"]
    ranged = materialize(
        groups.where("z > 0").repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_range", F.spark_partition_id()),
        "mixing",
    )
    words = F.col("z") * F.col("g")
    per_range = ranged.groupBy("source", "_range").agg(F.sum(words).alias("n"))
    sums = materialize(per_range.withColumn("before", F.sum("n").over(W.partitionBy("source").orderBy("_range")) - F.col("n")), "mixing")
    empty = df.select(F.col(source_col).alias("source")).distinct().withColumn("n", F.lit(0).cast("long"))
    sizes = sums.select("source", "n").unionByName(empty).groupBy("source").agg(F.sum("n").alias("source_size"))
    t = targets(sizes, weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.least(F.lit(max_epochs), F.floor(F.col("target") / F.col("source_size")))).otherwise(0)
    t = t.withColumn("epochs", epochs.cast("long"))
    t = materialize(t.withColumn("rest", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long")), "mixing")
    # the range the cut falls into, then the group inside it
    cut_range = (
        sums.withColumnRenamed("source", "s").join(t, F.col("s").eqNullSafe(F.col("source")))
        .where("before < rest and rest <= before + n")
        .select("s", "_range", "before", "rest")
    )
    inside = ranged.join(cut_range, F.col("source").eqNullSafe(F.col("s")) & (ranged["_range"] == cut_range["_range"])).select("source", "_key", "_tie", "z", "g", "before", "rest")
    done = F.col("before") + F.sum(words).over(W.partitionBy("source").orderBy("_key", "_tie", "z")) - words
    cut = (
        inside.withColumn("done", done)
        .where("done < rest and rest <= done + z * g")
        .select(F.col("source").alias("s"), F.col("_key").alias("cut_key"), F.col("_tie").alias("cut_tie"), F.expr("(rest - done) div g").alias("cut_words"), F.expr("(rest - done) % g").alias("cut_more"))
    )
    return t.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select("source", "source_size", "target", "epochs", "cut_key", "cut_tie", "cut_words", "cut_more")


def _one_more(at_cut: DataFrame) -> DataFrame:
    """Rows of repeated groups at the cut, with ``taken`` one larger for
    ``_mix.cut_more`` rows of each source. Members stay where they are: they are
    numbered by their place in a partition and the members in partitions before."""
    pid = F.shiftright(F.col("_place"), 33)  # monotonically_increasing_id: partition above 33 bits of row number
    placed = materialize(at_cut.sortWithinPartitions("_mix_source").withColumn("_place", F.monotonically_increasing_id()), "mixing")
    parts = placed.groupBy(F.col("_mix_source").alias("s"), pid.alias("p")).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("n"))
    parts = parts.withColumn("_before", F.sum("n").over(W.partitionBy("s").orderBy("p")) - F.col("n"))
    numbered = placed.join(parts, F.col("_mix_source").eqNullSafe(F.col("s")) & (pid == F.col("p")))
    more = F.expr("_place - _first + _before < _mix.cut_more").cast("long")
    return numbered.withColumn("taken", F.col("taken") + more).select(*at_cut.columns)


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``df`` with size, source_size, target and taken (words the mix takes
    of the row, repeats counted); its own columns of these names go."""
    src = without(df, "size", "source_size", "target", "taken", "_mix", "_mix_source", "_mix_key", "_mix_tie")
    cuts = materialize(plan(src, id_col, text_col, source_col, weights, max_epochs), "mixing")
    cuts = cuts.select(F.col("source").alias("_mix_source"), F.struct(*[c for c in cuts.columns if c != "source"]).alias("_mix"))
    rows = src.withColumns({"size": _size(text_col)} | dict(zip(("_mix_key", "_mix_tie"), _keyed(src, id_col, text_col))))
    at_cut = "_mix_key = _mix.cut_key AND _mix_tie = _mix.cut_tie"
    below = "_mix_key < _mix.cut_key OR (_mix_key = _mix.cut_key AND _mix_tie < _mix.cut_tie)"
    taken = F.expr(f"_mix.epochs * size + CASE WHEN {at_cut} THEN least(_mix.cut_words, size) WHEN {below} THEN size ELSE 0 END")
    joined = rows.join(cuts, F.col(source_col).eqNullSafe(F.col("_mix_source"))).withColumn("taken", taken)
    if cuts.where("_mix.cut_more > 0").limit(1).count():
        uneven = F.coalesce(F.expr(f"{at_cut} AND _mix.cut_more > 0"), F.lit(False))
        joined = joined.where(~uneven).unionByName(_one_more(joined.where(uneven)))
    return joined.select(*[F.col(f"`{c}`") for c in src.columns], "size", F.col("_mix.source_size").alias("source_size"), F.col("_mix.target").alias("target"), "taken")


def emit(mixed: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of :func:`mix` as the mix holds them: each row ``taken div size``
    times whole, and, where the cut falls into it, once more with the words
    up to the cut (white space between words as it was)."""
    times = F.expr("CASE WHEN size > 0 THEN taken div size ELSE 0 END")
    rest = F.expr("CASE WHEN size > 0 THEN taken % size ELSE 0 END")
    copies = F.flatten(F.array(F.array_repeat(F.lit(0).cast("long"), times.cast("int")), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<long>"))))
    out = mixed.withColumn("_cut", F.explode(copies))
    pieces = F.regexp_extract_all(F.col(text_col), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut_at = F.array_join(F.slice(pieces, F.lit(1), F.col("_cut").cast("int")), "")
    return out.withColumn(text_col, F.when(F.col("_cut") > 0, cut_at).otherwise(F.col(text_col))).drop("_cut")


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document."""
    return mix(documents.select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")
