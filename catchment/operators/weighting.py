"""Population-weighted roll-up from blocks to zones.

A block's weight is its population (all residents) or its population times
the share of a sub-population in the block's area. A zone's value is
``sum(value * weight) / sum(weight)``, where the denominator counts every
populated block of the zone, also those without a reachable destination (as
the analysis does). The roll-up is a single partial + final hash aggregate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from ..session import checked_broadcast


def _isin_keep_null(col: Column, values: Sequence) -> Column:
    """``col NOT IN values`` that keeps rows whose ``col`` is NULL."""
    return F.coalesce(~col.isin(list(values)), F.lit(True))


def area_shares(
    area_attributes: DataFrame,
    attribute: str,
    area_col: str = "area_id",
    attribute_col: str = "attribute_id",
    value_col: str = "value",
    percent: bool = True,
) -> DataFrame:
    """Share of the sub-population per area from a long attribute table:
    keep one attribute, rename its value to ``share``, percent -> fraction."""
    value = F.col(value_col) / F.lit(100.0) if percent else F.col(value_col)
    return (
        area_attributes.where(F.col(attribute_col) == F.lit(attribute))
        .select(F.col(area_col).alias("area_id"), value.alias("share"))
    )


def block_weights(
    pops: DataFrame,
    lookup: DataFrame,
    shares: DataFrame | None = None,
    keep_null_zone: bool = False,
) -> DataFrame:
    """One row per populated block: ``block_id, zone_id, w_all, w_sub``.

    ``pops``: block_id, pop[, area_id]; ``lookup``: block_id, zone_id;
    ``shares``: area_id, share. A block without a share row has ``w_sub`` NULL
    (it adds nothing to the sub-population). Blocks without a zone are dropped
    unless ``keep_null_zone``.
    """
    df = pops
    if shares is not None:
        df = df.join(checked_broadcast(shares), "area_id", "left")
        w_sub = F.col("pop") * F.col("share")
    else:
        w_sub = F.lit(None).cast("double")
    df = df.join(lookup.select("block_id", "zone_id"), "block_id", "left")
    if not keep_null_zone:
        df = df.where(F.col("zone_id").isNotNull())
    return df.select(
        "block_id", "zone_id",
        F.col("pop").cast("double").alias("w_all"),
        w_sub.cast("double").alias("w_sub"),
    )


def zone_access(
    block_means: DataFrame,
    weights: DataFrame,
    values: Sequence[str] = ("avg_dist", "avg_time"),
    outputs: Sequence[str] | None = None,
    weight: str | Column = "w_all",
    fallback_weight: str | Column | None = None,
    fallback_ids: Sequence | None = None,
    empty_as_zero: bool = False,
    reachable_only: bool = False,
    by: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Weighted mean of block values per zone.

    ``block_means``: block_id + ``values``; ``weights``: from
    :func:`block_weights`. ``weight`` is a weight column name or expression.
    With ``fallback_weight``, a zone whose ``weight`` total is 0 or missing
    uses ``fallback_weight`` instead -- for the zones in ``fallback_ids``, or
    for every such zone when ``fallback_ids`` is None.

    ``empty_as_zero=True`` reproduces the analysis exactly: a populated zone
    where no block reaches a destination scores 0 instead of NULL.
    ``reachable_only=True`` leaves blocks without a value out of the
    denominator.

    ``by`` rolls up several tables in the same pass, e.g. ``{"mode": ["auto",
    "pedestrian"], "population": ["all", "sub"]}`` when ``block_means``
    carries those columns: every block weight is repeated once per listed
    value (a fixed fan-out), so each table's denominator sees every populated
    block, reachable or not. ``weight`` may then depend on these columns.
    """
    outputs = list(outputs or values)
    by = dict(by or {})
    for col, vals in by.items():
        weights = weights.withColumn(col, F.explode(F.array(*[F.lit(v) for v in vals])))
    keys = ["block_id", *by]
    # Left join from the weights: the denominator sees every populated block.
    joined = weights.join(block_means.select(*keys, *values), keys, "left")
    w_main = F.col(weight) if isinstance(weight, str) else weight
    weight_sets = [("", w_main)]
    if fallback_weight is not None:
        w_fb = F.col(fallback_weight) if isinstance(fallback_weight, str) else fallback_weight
        weight_sets.append(("_fb", w_fb))
    aggs = []
    for suffix, w in weight_sets:
        for v in values:
            aggs.append(F.sum(F.col(v) * w).alias(f"_n_{v}{suffix}"))
            w_used = F.when(F.col(v).isNotNull(), w) if reachable_only else w
            aggs.append(F.sum(w_used).alias(f"_w_{v}{suffix}"))
    zoned = joined.groupBy("zone_id", *by).agg(*aggs)

    def mean(v: str, suffix: str) -> Column:
        num = F.col(f"_n_{v}{suffix}")
        if empty_as_zero:
            num = F.coalesce(num, F.lit(0.0))
        return safe_div(num, F.col(f"_w_{v}{suffix}"))

    cols = [F.col("zone_id"), *[F.col(c) for c in by]]
    for v, out in zip(values, outputs):
        result = mean(v, "")
        if fallback_weight is not None:
            w = F.col(f"_w_{v}")
            use_fb = w.isNull() | (w == F.lit(0.0))
            if fallback_ids is not None:
                use_fb = use_fb & F.col("zone_id").isin(list(fallback_ids))
            result = F.when(use_fb, mean(v, "_fb")).otherwise(result)
        cols.append(result.alias(out))
    return zoned.select(*cols)


def zone_population(lookup: DataFrame, pops: DataFrame) -> DataFrame:
    """Population per zone: blocks of the lookup with their population summed;
    a zone whose blocks have no population gets 0; the NULL zone is dropped."""
    return (
        lookup.select("block_id", "zone_id")
        .join(pops.select("block_id", "pop"), "block_id", "left")
        .where(F.col("zone_id").isNotNull())
        .groupBy("zone_id")
        .agg(F.coalesce(F.sum("pop"), F.lit(0.0)).cast("double").alias("zone_pop"))
    )
