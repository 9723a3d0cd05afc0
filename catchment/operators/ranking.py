"""Exact ranks and order statistics without gathering a group in one task.

One path for every size and every kind of value. Each group's distinct values
(a value repeated by a third of all rows is one row after the first aggregate)
are range-partitioned by group and value and stored with the number of their
partition. Within a partition a running sum over the distinct values gives each
value's position; per partition and group, the number of rows gives the offset
of the partition (a running sum over at most as many rows as there are
partitions). How values are spread, or how close they lie, does not matter: the
partitions are cut by Spark's sample of the values themselves, and where they
are cut changes no result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

def join_on_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys`` where NULL matches NULL (a NULL class is a group of
    its own). With no keys, ``right`` must be a one-row aggregate: its columns
    are attached as one scalar subquery (evaluated once; no join), NULL when
    it is empty."""
    keys = list(keys)
    if not keys:
        one = right.select(F.struct(*right.columns).alias("_s")).scalar()
        return left.select("*", *[one[c].alias(c) for c in right.columns])
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def distinct_ranks(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    extra: dict[str, Column] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One row per group and distinct non-NULL value (numeric; NaN is above all):
    *keys, ``_v`` (the value), ``_t`` (rows with it), ``_less`` (rows of the group
    with a smaller value), ``_part`` (its range, rising with the value within a
    group), and the ``extra`` aggregates (e.g. a count of positives) over the rows
    with that value. ``partitions``: number of ranges, by default the session's
    shuffle partitions, which adaptive execution merges while they are small."""
    keys = list(keys)
    v = F.col(value) if isinstance(value, str) else value
    if not keys:  # one group: give it a key, so that every join below has one
        out = distinct_ranks(df.select("*", v.alias("_v0"), F.lit(0).alias("_g")), ["_g"], "_v0", extra, partitions)
        return out.drop("_g")
    rows = df.select("*", v.alias("_v")).where(F.col("_v").isNotNull())
    aggs = [F.count("*").alias("_t")] + [c.alias(n) for n, c in (extra or {}).items()]
    distinct = rows.groupBy(*keys, "_v").agg(*aggs)
    ranged = distinct.repartitionByRange(partitions, *keys, "_v") if partitions else distinct.repartitionByRange(*keys, "_v")
    stored = materialize(ranged.withColumn("_part", F.spark_partition_id()))
    within = Window.partitionBy(*keys, "_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    placed = stored.withColumn("_within", F.coalesce(F.sum("_t").over(within), F.lit(0)))
    totals = stored.groupBy(*keys, "_part").agg(F.sum("_t").alias("_bt"))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_part", F.coalesce(F.sum("_bt").over(before), F.lit(0)).alias("_off"))
    out = join_on_keys(placed, offsets, [*keys, "_part"])
    return out.withColumn("_less", F.col("_off") + F.col("_within")).drop("_off", "_within")


def order_statistics(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    probs: Sequence[float],
    partitions: int | None = None,
) -> DataFrame:
    """Quantiles by linear interpolation between order statistics (the
    "type 7" rule: position (n - 1) p), exact, one row per group with the
    array ``q`` (NULL values are ignored; an empty group gives NULLs)."""
    keys = list(keys)
    if not keys:  # one group: give it a key, so that every join below has one
        v = F.col(value) if isinstance(value, str) else value
        out = order_statistics(df.select(v.alias("_v0"), F.lit(0).alias("_g")), ["_g"], "_v0", probs, partitions)
        return out.drop("_g")
    ranks = materialize(distinct_ranks(df, keys, value, partitions=partitions))
    n = ranks.groupBy(*keys).agg(F.sum("_t").alias("_n"))
    targets = n.select(
        *keys, "_n",
        F.posexplode(F.array(*[F.lit(float(p)) for p in probs])).alias("_pi", "_p"),
    ).withColumn("_h", (F.col("_n") - 1).cast("double") * F.col("_p"))
    targets = targets.withColumns({"_lo": F.floor("_h"), "_hi": F.ceil("_h")})
    # the value at 0-based order position j is the one with _less <= j < _less + _t
    need = targets.select(*keys, "_pi", F.explode(F.array(F.col("_lo"), F.col("_hi"))).alias("_j")).distinct()
    spans = ranks.groupBy(*keys, "_part").agg(F.min("_less").alias("_s"), F.sum("_t").alias("_bt"))
    located = join_on_keys(need, spans, keys).where(
        (F.col("_j") >= F.col("_s")) & (F.col("_j") < F.col("_s") + F.col("_bt"))
    ).drop("_s", "_bt")
    picked = join_on_keys(located, ranks.select(*keys, "_part", "_v", "_t", "_less"), [*keys, "_part"]).where(
        (F.col("_j") >= F.col("_less")) & (F.col("_j") < F.col("_less") + F.col("_t"))
    ).select(*keys, "_pi", "_j", "_v")
    lo = picked.select(*keys, "_pi", F.col("_j").alias("_lo"), F.col("_v").alias("_vlo"))
    hi = picked.select(*keys, "_pi", F.col("_j").alias("_hi"), F.col("_v").alias("_vhi"))
    q = join_on_keys(targets, lo, [*keys, "_pi", "_lo"])
    q = join_on_keys(q, hi, [*keys, "_pi", "_hi"])
    frac = F.col("_h") - F.col("_lo")
    q = q.withColumn("_q", F.when(frac == 0, F.col("_vlo")).otherwise(
        F.col("_vlo") + frac * (F.col("_vhi") - F.col("_vlo"))))
    return q.groupBy(*keys).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_pi", "_q"))), lambda s: s["_q"]).alias("q")
    )
