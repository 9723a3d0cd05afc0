"""Data sets behind the published maps and plots (the drawing itself is not
data work and is not built).

A figure spec row names a data table, the column to fill zones with, a
legend label and a file name. For each row: the zone values of the fill
column and of its counterpart population (``*_all`` <-> ``*_sub``), the
shared colour-scale limits (lowest value floored at 0, highest value), and
the title texts derived from the names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import replace_first
from ..session import checked_broadcast, materialize

# The published figure list, and the label texts.
FIGURE_SPEC_ROWS = [
    ("auto", "time_all", "Drive Time (min)", "drive_time_all"),
    ("auto", "time_sub", "Drive Time (min)", "drive_time_sub"),
    ("walk", "dist_all", "Walk Dist. (km)", "walk_dist_all"),
    ("walk", "dist_sub", "Walk Dist. (km)", "walk_dist_sub"),
]
LABELS = {
    "pop_all": "General Population", "pop_sub": "Sub-population",
    "dest_all": "Any Destination", "dest_sub": "Sub-population Destinations",
    "distance": "Distance", "time": "Time", "drive": "Driving", "walk": "Walking",
}


def long_table(df: DataFrame, data_table: str, variables: Sequence[str], keys: Sequence[str] = ("zone_id", "name", "zone_class")) -> DataFrame:
    """data_table, *keys, variable, value: a metric table in long form."""
    return df.select(*keys, *[F.col(v).cast("double").alias(v) for v in variables]).unpivot(
        list(keys), list(variables), "variable", "value"
    ).withColumn("data_table", F.lit(data_table))


def other_column(fill: str = "fill_column", all_tag: str = "all", sub_tag: str = "sub"):
    """The counterpart column name: 'all' -> 'sub' (first occurrence), else
    'sub' -> 'all'."""
    f = F.col(fill)
    return F.when(f.contains(sub_tag), replace_first(f, sub_tag, all_tag)).when(
        f.contains(all_tag), replace_first(f, all_tag, sub_tag)
    )


def figure_specs(spec: DataFrame, skip_marker: str = "diff") -> DataFrame:
    """The spec rows that are drawn (difference columns are not), with the
    counterpart column and the title texts."""
    f, fn = F.col("fill_column"), F.col("filename")
    is_all = f.contains("all")
    pop = F.when(is_all, F.lit(LABELS["pop_all"])).otherwise(F.lit(LABELS["pop_sub"]))
    dest = F.when(is_all, F.lit(LABELS["dest_all"])).otherwise(F.lit(LABELS["dest_sub"]))
    metric = F.when(f.contains("dist"), F.lit(LABELS["distance"])).otherwise(F.lit(LABELS["time"]))
    modality = F.when(fn.contains("drive"), F.lit(LABELS["drive"])).otherwise(F.lit(LABELS["walk"]))
    return spec.where(~f.contains(skip_marker)).select(
        "data_table", "fill_column", other_column().alias("other_column"), "fill_label", "filename",
        F.concat(modality, F.lit(" "), metric, F.lit(": "), pop).alias("title"),
        F.concat(pop, F.lit(" to "), dest).alias("subtitle"),
    )


def figure_data(long: DataFrame, spec: DataFrame, zones: DataFrame | None = None,
                keys: Sequence[str] = ("zone_id", "name", "zone_class")) -> DataFrame:
    """One row per (figure, zone): filename, *keys, fill_value, other_value
    (+ rings when ``zones`` is given: outlines are attached last, by zone)."""
    specs = checked_broadcast(figure_specs(spec))
    long = materialize(long)  # zone-sized, read twice (fill and counterpart values)
    fill = long.join(specs, (long["data_table"] == specs["data_table"]) & (long["variable"] == specs["fill_column"]))
    fill = fill.select(specs["filename"], long["data_table"], *[long[k] for k in keys],
                       F.col("value").alias("fill_value"), specs["other_column"])
    other = long.select(
        F.col("data_table").alias("_dt"), F.col(keys[0]).alias("_k"), F.col("variable").alias("_var"),
        F.col("value").alias("other_value"),
    )
    out = fill.join(
        other,
        (fill["data_table"] == other["_dt"]) & (fill[keys[0]] == other["_k"]) & (fill["other_column"] == other["_var"]),
        "left",
    ).select("filename", *keys, "fill_value", "other_value")
    if zones is not None:
        out = out.join(checked_broadcast(zones.select(keys[0], "rings")), keys[0], "left")
    return out


def figure_limits(data: DataFrame, spec: DataFrame) -> DataFrame:
    """Per figure: min_value = min(fill, other, 0), max_value = max(fill,
    other), and the labels."""
    lim = data.groupBy("filename").agg(
        F.least(F.min("fill_value"), F.min("other_value"), F.lit(0.0)).alias("min_value"),
        F.greatest(F.max("fill_value"), F.max("other_value")).alias("max_value"),
    )
    specs = figure_specs(spec).select("filename", "fill_column", "fill_label", "title", "subtitle")
    return specs.join(lim, "filename", "left")


def outlines_for(data: DataFrame, outlines: DataFrame, if_absent: str, keep_only: str,
                 class_col: str = "zone_class") -> DataFrame:
    """Class outlines to draw with ``data``: all of them, unless ``data`` has
    no row of class ``if_absent`` -- then only ``keep_only``. The decision is
    an uncorrelated scalar subquery (one small aggregate, evaluated once and
    used as a value): no join, no round trip through the driver."""
    has = data.select(
        F.coalesce(F.max(F.coalesce(F.col(class_col) == F.lit(if_absent), F.lit(False))), F.lit(False))
    ).scalar()
    return outlines.where(has | (F.col(class_col) == F.lit(keep_only)))


def attribute_vs_metric(attributes: DataFrame, attribute: str, metrics: DataFrame, metric: str,
                        value_name: str = "attribute_value") -> DataFrame:
    """zone_id, attribute value, metric for zones that have both (the scatter
    plot data set): one attribute of the long table, ids cast to integers,
    exact duplicates removed, joined to the metric table, missing rows
    dropped."""
    zid = F.col("zone_id").cast("string")
    a = attributes.where(F.col("attribute") == F.lit(attribute)).select(
        F.when(zid.rlike(r"^\s*[-+]?[0-9]+\s*$"), F.trim(zid).try_cast("int")).alias("zone_id"),
        F.col("value").alias(value_name),
    ).distinct()
    return a.join(metrics.select("zone_id", metric), "zone_id", "left").na.drop("any")


def bivariate_data(zones: DataFrame, metrics: DataFrame, metric: str, attributes: DataFrame, attribute: str,
                   value_name: str = "attribute_value") -> DataFrame:
    """Every zone with one metric (joined on zone id and name) and one
    attribute (the two-variable map data set)."""
    zid = F.col("zone_id").cast("string")
    a = attributes.where(F.col("attribute") == F.lit(attribute)).select(
        F.when(zid.rlike(r"^\s*[-+]?[0-9]+\s*$"), F.trim(zid).try_cast("int")).alias("zone_id"),
        F.col("value").alias(value_name),
    ).distinct()
    z = zones.join(checked_broadcast(metrics.select("zone_id", "name", metric)), ["zone_id", "name"], "left")
    return z.join(checked_broadcast(a), "zone_id", "left")
