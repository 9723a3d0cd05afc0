"""The whole analysis from its own inputs, as one function returning the
output tables. The zone-level gap table is computed when ``run`` is called, and
so are the zone-sized intermediates of the outputs that read one several times
(all are written to the shared checkpoint folder; ``session.drop_stored``
removes them); what follows is lazy.

Inputs are DataFrames (see ``catchment.schemas`` and ``catchment.sources``):

- ``od``: block_id, dest_id, mode, distance (km), time (s) -- the full OD
  table, one row per origin x in-scope destination and mode (``read_od``); or
  a table with a ``population`` column whose rows are taken as they are, such
  as the straight-line proxy (``od_straight_line_by_population``). A table
  cut to the nearest destinations without that column would lose the
  sub-population, so it is no valid input;
- ``dests``: dest_id, in_scope, sub (+ lat, lon for the per-capita counts);
- ``pops``: block_id, pop, area_id; ``area_attributes``: area_id,
  attribute_id, value (percent); ``lookup``: block_id, zone_id;
- ``zones``: zone_id, name, name_alt, rings; ``zone_classes``: zone_id, name,
  zone_class; ``zone_attributes``: zone_id, attribute, value.

Parameters default to the analysis's method (k = 5, 50 m tolerance, attribute
codes) and exclude no zone; ``PUBLISHED`` has the zones it left out.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.classes import class_benchmark
from ..operators.figures import FIGURE_SPEC_ROWS, attribute_vs_metric, figure_data, figure_limits
from ..operators.gap import access_gap_long, clean_gap
from ..operators.nearest import nearest_k_mean
from ..operators.od import od_by_population
from ..operators.percapita import per_capita_long, zone_populations
from ..operators.ranktest import test_report
from ..operators.spatial import points_in_zones, zone_counts
from ..operators.summary import summary_table
from ..operators.weighting import area_shares, block_weights, zone_access, zone_population
from .. import schemas
from ..session import materialize


@dataclass
class Params:
    # Fixed values of the analysis.
    k: int = 5
    modes: tuple[str, ...] = ("auto", "pedestrian")
    share_attribute: str = "7002"
    fallback_ids: tuple | None = ()
    clean_exclude: tuple = ()
    class_exclude: tuple = ()
    benchmark: str = "all"
    empty_as_zero: bool = False
    tolerance_m: float = 50.0
    total_id: int = 0
    total_name: str = "Total"
    pop_attr: str = "pop2016"
    sub_only_attr: str = "CDP269b"
    sub_extra_attr: str = "CDP269c"
    extra_attrs: tuple = ("CDP269", "CDP269a")
    scatter_attr: str = "CDP269b"
    walk_class: str = "Urban"
    summary_variables: dict = field(default_factory=lambda: {
        "auto": ["time_all", "time_sub", "diff_t"], "pedestrian": ["dist_all", "dist_sub", "diff_d"]})
    tests: tuple = (("auto", "time_all", "time_sub", "Driving", "Time"),
                    ("pedestrian", "dist_all", "dist_sub", "Walking", "Distance"))


# The zones that the published tables leave out, and those that
# use the weights of all residents.
PUBLISHED = Params(fallback_ids=(51, 65), clean_exclude=(17,), class_exclude=(5, 17, 71), total_name="Ottawa")


def run(
    od: DataFrame,
    dests: DataFrame,
    pops: DataFrame,
    area_attributes: DataFrame,
    lookup: DataFrame,
    zones: DataFrame,
    zone_classes: DataFrame,
    zone_attributes: DataFrame,
    params: Params | None = None,
) -> dict[str, DataFrame]:
    p = params or Params()
    spark = od.sparkSession
    by_mode = {"mode": list(p.modes)}

    # nearest-k means per block, both populations, every mode, one OD pass
    tagged = od if "population" in od.columns else od_by_population(od, dests)
    means = nearest_k_mean(tagged, keys=["block_id", "mode", "population"], k=p.k)
    weights = block_weights(pops, lookup, area_shares(area_attributes, p.share_attribute))
    is_all = F.col("population") == F.lit("all")
    zone_long = zone_access(
        means, weights, outputs=["dist", "time"],
        weight=F.when(is_all, F.col("w_all")).otherwise(F.col("w_sub")), fallback_weight="w_all",
        fallback_ids=p.fallback_ids, empty_as_zero=p.empty_as_zero,
        by={**by_mode, "population": ["all", "sub"]},
    )
    names = zones.select("zone_id", "name")
    # zone-sized and the root of every later output: written once, so the OD
    # pipeline runs once for all of them
    gap = materialize(access_gap_long(zone_long, names, by=["mode"]))
    zpop = zone_population(lookup, pops)
    classes = class_benchmark(clean_gap(gap, p.clean_exclude), zone_classes, zpop, exclude=p.class_exclude,
                              benchmark=p.benchmark, by=["mode"])

    pairs_spec = spark.createDataFrame(
        [(m, v) for m, vs in p.summary_variables.items() for v in vs], "mode string, variable string")
    variables = sorted({v for vs in p.summary_variables.values() for v in vs})
    summary = summary_table(classes, variables, by="zone_class", keys=["mode"], pairs=pairs_spec)
    report = test_report(classes, list(p.tests), alternative="less")

    # per-capita supply: in-scope destinations, and those also serving the sub-population
    pts = dests.where(F.coalesce(F.col("in_scope"), F.lit(False))).select(
        F.col("dest_id").alias("point_id"), "lon", "lat",
        F.explode(F.array(F.lit("all"), F.when(F.col("sub"), F.lit("sub")))).alias("population")).where(
        F.col("population").isNotNull())
    hits = points_in_zones(pts, zones, tolerance_m=p.tolerance_m)
    counts = zone_counts(hits, zones, pts, total_id=p.total_id, total_name=p.total_name,
                         by={"population": ["all", "sub"]})
    zpops = zone_populations(zone_attributes, p.pop_attr, p.sub_only_attr, p.sub_extra_attr, extra=p.extra_attrs)
    percap = per_capita_long(counts, zpops)

    # figure data sets
    spec = spark.createDataFrame(FIGURE_SPEC_ROWS, schemas.FIGURE_SPEC)
    fig_vars = ["dist_all", "time_all", "dist_sub", "time_sub"]
    z = zones.select("zone_id", "name").withColumn("mode", F.explode(F.array(*[F.lit(m) for m in p.modes])))
    j = z.join(classes.select("zone_id", "mode", "zone_class", *fig_vars), ["zone_id", "mode"], "left")
    dt = F.when(F.col("mode") == "auto", F.lit("auto")).when(
        (F.col("mode") == "pedestrian") & (F.col("zone_class") == F.lit(p.walk_class)), F.lit("walk"))
    long = j.withColumn("data_table", dt).where(F.col("data_table").isNotNull()).unpivot(
        ["data_table", "zone_id", "name", "zone_class"], fig_vars, "variable", "value")
    fdata = figure_data(long, spec)
    scatter = attribute_vs_metric(zone_attributes, p.scatter_attr, classes.where(F.col("mode") == "auto"), "diff_t")

    return {
        "block_means": means, "gap": gap, "class_table": classes, "per_capita": percap,
        "summary": summary, "test_report": report, "figure_data": fdata,
        "figure_limits": figure_limits(fdata, spec), "scatter": scatter,
    }
