"""Gap table between the whole population and a sub-population (per zone)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import checked_broadcast
from .weighting import _isin_keep_null

GAP_COLUMNS = ["zone_id", "name", "dist_all", "time_all", "dist_sub", "time_sub", "diff_d", "diff_t"]


def access_gap(
    all_zone: DataFrame, sub_zone: DataFrame, names: DataFrame | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """``all_zone``/``sub_zone``: zone_id, dist, time (from ``zone_access``);
    ``names``: zone_id, name. Every zone of ``all_zone`` is kept; the
    sub-population values and names are attached where present, and the
    differences are sub minus all. ``by`` columns (e.g. ``mode``) are kept
    and joined on."""
    by = list(by)
    a = all_zone.select("zone_id", *by, F.col("dist").alias("dist_all"), F.col("time").alias("time_all"))
    s = sub_zone.select("zone_id", *by, F.col("dist").alias("dist_sub"), F.col("time").alias("time_sub"))
    df = a.join(s, ["zone_id", *by], "left")
    if names is not None:
        df = df.join(checked_broadcast(names.select("zone_id", "name")), "zone_id", "left")
    else:
        df = df.withColumn("name", F.lit(None).cast("string"))
    return df.select(
        *by, "zone_id", "name", "dist_all", "time_all", "dist_sub", "time_sub",
        (F.col("dist_sub") - F.col("dist_all")).alias("diff_d"),
        (F.col("time_sub") - F.col("time_all")).alias("diff_t"),
    )


def access_gap_long(
    zone_long: DataFrame,
    names: DataFrame | None = None,
    by: Sequence[str] = (),
    population_col: str = "population",
    all_label: str = "all",
    sub_label: str = "sub",
) -> DataFrame:
    """The gap table from one roll-up that carries a population column
    (zone_id, *by, population, dist, time): the two populations are put side
    by side with one conditional aggregate over the zone-sized table, so the
    roll-up below is planned once (two filtered copies of it would each be
    planned, and scanned, on their own)."""
    by = list(by)
    pop = F.col(population_col)

    def pick(label: str, col: str):
        return F.max(F.when(pop == F.lit(label), F.col(col)))

    wide = zone_long.groupBy("zone_id", *by).agg(
        pick(all_label, "dist").alias("dist_all"), pick(all_label, "time").alias("time_all"),
        pick(sub_label, "dist").alias("dist_sub"), pick(sub_label, "time").alias("time_sub"),
        F.count(F.when(pop == F.lit(all_label), 1)).alias("_has_all"),
    ).where(F.col("_has_all") > 0)
    df = wide
    if names is not None:
        df = df.join(checked_broadcast(names.select("zone_id", "name")), "zone_id", "left")
    else:
        df = df.withColumn("name", F.lit(None).cast("string"))
    return df.select(
        *by, "zone_id", "name", "dist_all", "time_all", "dist_sub", "time_sub",
        (F.col("dist_sub") - F.col("dist_all")).alias("diff_d"),
        (F.col("time_sub") - F.col("time_all")).alias("diff_t"),
    )


def clean_gap(gap: DataFrame, exclude: Sequence | None = None) -> DataFrame:
    """Rows with any missing value dropped, then the listed zones removed
    (a NULL zone would already be gone with the missing values)."""
    df = gap.na.drop("any")
    if exclude:
        df = df.where(_isin_keep_null(F.col("zone_id"), exclude))
    return df


def mode_required(mode: str | None) -> str:
    """The travel mode names the output; it must be given."""
    if mode is None or mode == "":
        raise ValueError("a travel mode is required: it names the output")
    return mode
