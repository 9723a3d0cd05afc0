"""Per-capita supply: zone point counts joined to zone populations from a long
attribute table, with rates and their inverses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import nonfinite_to_null, round_half_even, safe_div, zero_to_null
from ..session import checked_broadcast


def attribute_wide(
    attributes: DataFrame,
    names: Sequence[str],
    zone_col: str = "zone_id",
    attribute_col: str = "attribute",
    value_col: str = "value",
) -> DataFrame:
    """Long (zone, attribute, value) -> one row per zone and one column per
    listed attribute. Exact duplicate rows collapse (the aggregate is
    ``max``, so a repeated (zone, attribute, value) counts once); the zone id
    is cast to an integer the lenient way (text that is not an integer ->
    NULL)."""
    names = list(names)
    zid = F.col(zone_col).cast("string")
    zone_int = F.when(zid.rlike(r"^\s*[-+]?[0-9]+\s*$"), F.trim(zid).try_cast("int"))
    return (
        attributes.where(F.col(attribute_col).isin(names))
        .select(zone_int.alias("zone_id"), F.col(attribute_col).alias("_attr"), F.col(value_col).try_cast("double").alias("_v"))
        .groupBy("zone_id").pivot("_attr", names).agg(F.max("_v"))
    )


def zone_populations(
    attributes: DataFrame,
    pop_attr: str,
    sub_only_attr: str,
    sub_extra_attr: str,
    extra: Sequence[str] = (),
    **kw,
) -> DataFrame:
    """zone_id, pop_all, pop_sub, pop_sub_only from percent attributes:
    ``pop_sub_only = round(pop * a / 100)`` (0 -> NULL), ``pop_sub =
    round(pop * (a + b) / 100)``, rounding half to even."""
    wide = attribute_wide(attributes, [pop_attr, sub_only_attr, sub_extra_attr, *extra], **kw)
    pop, a, b = F.col(pop_attr), F.col(sub_only_attr), F.col(sub_extra_attr)
    return wide.select(
        "zone_id",
        pop.alias("pop_all"),
        round_half_even(pop * (a + b) / F.lit(100.0)).alias("pop_sub"),
        zero_to_null(round_half_even(pop * a / F.lit(100.0))).alias("pop_sub_only"),
    )


def per_capita(all_counts: DataFrame, sub_counts: DataFrame, pops: DataFrame) -> DataFrame:
    """``all_counts``/``sub_counts``: zone_id, name, name_alt, n (from
    ``zone_counts``); ``pops``: from :func:`zone_populations`.

    Columns: zone_id, name, name_alt, num_all, num_sub, pop_all, pop_sub,
    pop_sub_only, percap_{all,sub,sub_only} = count / population, and
    pop_per_point_{...} = round(1 / percap). A zero or missing denominator
    gives NULL (never Inf or NaN); rows without a zone id are dropped.
    """
    a = all_counts.select("zone_id", "name", "name_alt", F.col("n").alias("num_all"))
    s = sub_counts.select(
        F.col("zone_id").alias("_z"), F.col("name").alias("_n"), F.col("name_alt").alias("_a"),
        F.col("n").alias("num_sub"),
    )
    cond = a["zone_id"].eqNullSafe(s["_z"]) & a["name"].eqNullSafe(s["_n"]) & a["name_alt"].eqNullSafe(s["_a"])
    return _rates(a.join(checked_broadcast(s), cond, "left").drop("_z", "_n", "_a"), pops)


def per_capita_long(
    counts: DataFrame, pops: DataFrame, population_col: str = "population", all_label: str = "all",
    sub_label: str = "sub",
) -> DataFrame:
    """As :func:`per_capita`, from one count table with a population column
    (``zone_counts(..., by={"population": [...]})``): the two populations are
    put side by side with one conditional aggregate, so the spatial join
    below is planned once."""
    p = F.col(population_col)
    wide = counts.groupBy("zone_id", "name", "name_alt").agg(
        F.max(F.when(p == F.lit(all_label), F.col("n"))).alias("num_all"),
        F.max(F.when(p == F.lit(sub_label), F.col("n"))).alias("num_sub"),
        F.count(F.when(p == F.lit(all_label), 1)).alias("_has_all"),
    ).where(F.col("_has_all") > 0).drop("_has_all")
    return _rates(wide, pops)


def _rates(df: DataFrame, pops: DataFrame) -> DataFrame:
    df = df.join(checked_broadcast(pops), "zone_id", "left")
    rates = {
        "percap_all": safe_div(F.col("num_all"), F.col("pop_all")),
        "percap_sub": safe_div(F.col("num_sub"), F.col("pop_sub")),
        "percap_sub_only": safe_div(F.col("num_sub"), F.col("pop_sub_only")),
    }
    df = df.withColumns(rates)
    df = df.withColumns({
        f"pop_per_point_{k[len('percap_'):]}": round_half_even(safe_div(F.lit(1.0), F.col(k))) for k in rates
    })
    # Non-finite doubles (from inputs) become NULL, column by column.
    df = df.select(*[
        nonfinite_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
        for f in df.schema.fields
    ])
    return df.where(F.col("zone_id").isNotNull()).select(
        "zone_id", "name", "name_alt", "num_all", "num_sub", "pop_all", "pop_sub", "pop_sub_only",
        "percap_all", "percap_sub", "percap_sub_only",
        "pop_per_point_all", "pop_per_point_sub", "pop_per_point_sub_only",
    )
