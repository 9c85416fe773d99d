"""Lookup joins: the validity-range (as-of) lookup and the key lookup.

Neither side is hinted: AQE broadcasts a dimension when its *measured* size is
below ``spark.sql.adaptive.autoBroadcastJoinThreshold`` and splits skewed
partitions of a sort-merge join otherwise. Rows without a key can't match;
instead of meeting in the one partition that holds NULL, they carry a spread
value in a second join column that the dimension never has.

A member that a large share of the rows refers to is *hot*: its rows would meet
in one task of a sort-merge join. :func:`hot_members` finds such members by a
bounded frequency sketch, only where the dimension is too large for a broadcast.
Their validity ranges are cut into time buckets, and each bucket is copied to a
few salts; a row looks for its member in the bucket of its own date, under a salt
of its own. The range condition stays, so buckets decide only where rows meet.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.schemas import FACT_KEY

SPREAD = 4096  # partitions that rows without a key are dealt over, at most
HOT_SHARE = 64  # a member with this part of all rows is hot, so there are this many at most
TRACKED = 4096  # members the frequency sketch follows
BUCKETS = 64  # time buckets of a hot member's validity
SALTS = 8  # copies of a bucket


@dataclass(frozen=True)
class HotMembers:
    """Members to spread, and the span of time their buckets divide."""

    keys: tuple
    first: _dt.date
    last: _dt.date

    def bucket(self, at: Column) -> Column:
        """Number of the bucket of a date; dates outside the span go to the ends."""
        days = max(1, -(-((self.last - self.first).days + 1) // BUCKETS))
        number = F.floor(F.datediff(at, F.lit(self.first)) / F.lit(days))
        return F.greatest(F.lit(0), F.least(F.lit(BUCKETS - 1), number)).cast("int")


def may_broadcast(dim: DataFrame) -> bool:
    """Whether the dimension is small enough, by its files' sizes, for AQE to broadcast."""
    conf = dim.sparkSession.conf
    limit = conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) or conf.get("spark.sql.autoBroadcastJoinThreshold")
    if limit.startswith("-"):  # broadcasts are off
        return False
    jvm = dim.sparkSession.sparkContext._jvm
    return int(str(dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)


def hot_keys(rows: DataFrame, key: str, share: int = HOT_SHARE) -> tuple:
    """Values of ``key`` that at least one in ``share`` of ``rows`` has. A single
    partial aggregation; a value the sketch misses is only not spread."""
    seen = rows.agg(F.count(key).alias("n"), F.expr(f"approx_top_k(`{key}`, {share}, {TRACKED})").alias("top")).first()
    return tuple(r["item"] for r in seen["top"] or [] if r["item"] is not None and r["count"] * share >= seen["n"])


def hot_members(rows: DataFrame, key: str, dated: DataFrame, at: str, share: int = HOT_SHARE) -> HotMembers | None:
    """Members of ``key`` that at least one in ``share`` of ``rows`` refers to
    (``None`` if there is none), with the span of ``dated[at]``. Both are
    single partial aggregations."""
    hot = hot_keys(rows, key, share)
    if not hot:
        return None
    span = dated.agg(F.min(F.to_date(at)).alias("first"), F.max(F.to_date(at)).alias("last")).first()
    return HotMembers(hot, span["first"], span["last"]) if span["first"] else None


def _none(bk: str) -> str:
    """0 for every member, in a form that isn't folded into a constant (which would keep it out of the join keys)."""
    return f"pmod(xxhash64(`{bk}`), 1) AS __none"


def _row_hash(facts: DataFrame) -> Column:
    """Hash of a row by what identifies it: its fact key, so that no join carries
    other columns only to be hashed, or all columns where it has none."""
    own = [c for c in FACT_KEY if c in facts.columns] or facts.columns
    return F.xxhash64(*[F.col(f"`{c}`") for c in own])


def _spread(facts: DataFrame, key: Column) -> Column:
    """0 where the key is set, else a number from 1 to SPREAD by the row's hash."""
    return F.when(key.isNull(), F.pmod(_row_hash(facts), F.lit(SPREAD)) + 1).otherwise(F.lit(0).cast("long"))


def validity_lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str,
    dim_key: str,
    at: str,
    sk: str,
    out_col: str,
    valid_from: str = "effective_from",
    valid_to: str = "effective_to",
    unknown_sk: int = 0,
    hot: HotMembers | None = None,
) -> DataFrame:
    """Left as-of join: the version of ``dim`` whose [from, to] range (both ends
    inclusive) contains ``facts[at]``; its surrogate key lands in ``out_col``,
    ``unknown_sk`` where nothing matches.

    Versions are never filtered on ``is_current``: back-dated facts resolve to
    the version valid at their own date. Planned as an equi-join on the
    business key with the range as residual predicate; members in ``hot`` meet
    their rows by time bucket and salt.
    """
    d = dim.selectExpr(
        f"`{dim_key}` AS __bk", f"`{valid_from}` AS __from", f"`{valid_to}` AS __to", f"`{sk}` AS __sk", _none(dim_key)
    )
    spread = _spread(facts, F.col(fact_key))
    if hot:
        salt = F.pmod(_row_hash(facts), F.lit(SALTS))
        # below 0, so apart from both the members that aren't hot (0) and rows without a key (above 0)
        own = -(F.coalesce(hot.bucket(F.col(at)), F.lit(0)) * SALTS + salt) - 1
        spread = F.when(F.col(fact_key).isin(*hot.keys), own).otherwise(spread)
        buckets = F.sequence(hot.bucket(F.col("__from")), hot.bucket(F.col("__to")))
        copies = F.flatten(F.transform(buckets, lambda b: F.transform(F.sequence(F.lit(0), F.lit(SALTS - 1)), lambda s: (-(b * SALTS + s) - 1).cast("long"))))
        is_hot = F.col("__bk").isin(*hot.keys) & F.col("__from").isNotNull() & F.col("__to").isNotNull()
        d = d.withColumn("__none", F.explode(F.when(is_hot, copies).otherwise(F.array("__none"))))
    f = facts.withColumn("__spread", spread)
    cond = F.expr(f"`{fact_key}` = __bk AND __spread = __none AND `{at}` BETWEEN __from AND __to")
    joined = f.join(d, cond, "left")
    return joined.withColumn(out_col, F.expr(f"CAST(coalesce(__sk, {int(unknown_sk)}) AS BIGINT)")).drop(
        "__bk", "__from", "__to", "__sk", "__none", "__spread"
    )


def key_lookup(
    facts: DataFrame,
    dim: DataFrame,
    fact_key: str | Column,
    dim_key: str,
    sk: str,
    out_col: str,
    unknown_sk: int = 0,
    cast: str = "long",
) -> DataFrame:
    """Left equi lookup of a surrogate key; ``unknown_sk`` where nothing matches."""
    d = dim.selectExpr(f"`{dim_key}` AS __bk", f"`{sk}` AS __sk", _none(dim_key))
    key = F.col(fact_key) if isinstance(fact_key, str) else fact_key
    f = facts.withColumn("__spread", _spread(facts, key))
    joined = f.join(d, (key == F.col("__bk")) & (F.col("__spread") == F.col("__none")), "left")
    out = joined.withColumn(out_col, F.expr(f"CAST(coalesce(__sk, {int(unknown_sk)}) AS {cast})"))
    return out.drop("__bk", "__sk", "__none", "__spread")
