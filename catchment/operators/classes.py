"""Zone-class benchmark: the population-weighted average of each class, and
every zone's deviation from it.

Class totals come from one small aggregate joined back to the zones (a
checked broadcast), not from a window over a whole class, so no class is ever
gathered into a single task. The zone table is read twice for that, so it is
written once to the shared checkpoint folder first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from ..session import checked_broadcast, materialize
from .weighting import _isin_keep_null

_MEASURES = ["dist_sub", "time_sub", "dist_all", "time_all"]


def _strict_sum(expr: Column) -> Column:
    """Sum that is NULL when any term is NULL (no missing values skipped)."""
    return F.when(F.count(F.when(expr.isNull(), 1)) > 0, F.lit(None)).otherwise(F.sum(expr))


def class_benchmark(
    gap: DataFrame,
    classes: DataFrame,
    zone_pops: DataFrame,
    exclude: Sequence | None = None,
    benchmark: str = "all",
    by: Sequence[str] = (),
) -> DataFrame:
    """``gap``: a cleaned gap table; ``classes``: zone_id, name, zone_class;
    ``zone_pops``: zone_id, zone_pop.

    Adds zone_class, zone_pop, the four class averages
    ``{dist,time}_{sub,all}_class_avg`` and ``diff_{d,t}_class`` = the zone's
    sub-population value minus the class average of ``benchmark`` ('all' as
    the analysis does, or 'sub'). The class population is that of the class
    table after exclusions; an unclassified zone forms its own NULL class.
    ``by`` columns of ``gap`` (e.g. ``mode``) give separate benchmarks.
    """
    if benchmark not in ("all", "sub"):
        raise ValueError("benchmark must be 'all' or 'sub'")
    by = list(by)
    keep = (lambda c: _isin_keep_null(c, exclude)) if exclude else (lambda c: F.lit(True))
    class_pops = (
        classes.select("zone_id", "name", "zone_class")
        .join(checked_broadcast(zone_pops.select("zone_id", "zone_pop")), "zone_id", "left")
        .where(keep(F.col("zone_id")))
    )
    class_total = class_pops.groupBy("zone_class").agg(
        F.coalesce(F.sum("zone_pop"), F.lit(0.0)).alias("_class_pop")
    ).withColumnRenamed("zone_class", "_tcls")
    # Zone-sized and read twice (class sums, then the join back): written once,
    # so the plan above it is not run and planned once per reader.
    table = materialize(
        gap.join(checked_broadcast(class_pops), ["zone_id", "name"], "left").where(keep(F.col("zone_id")))
    )
    sums = table.groupBy("zone_class", *by).agg(
        *[_strict_sum(F.col(m) * F.col("zone_pop")).alias(f"_s_{m}") for m in _MEASURES]
    )
    avgs = sums.join(checked_broadcast(class_total), sums["zone_class"].eqNullSafe(F.col("_tcls")), "left").select(
        F.col("zone_class").alias("_cls"), *[F.col(b).alias(f"_by_{b}") for b in by],
        *[safe_div(F.col(f"_s_{m}"), F.col("_class_pop")).alias(f"{m}_class_avg") for m in _MEASURES],
    )
    cond = table["zone_class"].eqNullSafe(avgs["_cls"])
    for b in by:
        cond = cond & table[b].eqNullSafe(avgs[f"_by_{b}"])
    out = table.join(checked_broadcast(avgs), cond, "left")
    return out.select(
        *gap.columns, "zone_class", "zone_pop",
        "dist_sub_class_avg", "time_sub_class_avg", "dist_all_class_avg", "time_all_class_avg",
        (F.col("dist_sub") - F.col(f"dist_{benchmark}_class_avg")).alias("diff_d_class"),
        (F.col("time_sub") - F.col(f"time_{benchmark}_class_avg")).alias("diff_t_class"),
    )
