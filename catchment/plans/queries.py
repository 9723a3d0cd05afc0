"""Registered queries: each takes ``(spark, sf_dir)``, reads the driver tables
through :mod:`.roles` and runs the library's operators over the whole tables.

Double outputs of sums and means are quantized to ``DIGITS`` places at the
very end (and the same way in the oracle SQL), because sums of doubles depend
on the order of addition; row-level values are returned as computed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.geo import in_buffer
from ..functions.projection import MTM_ZONE_9, LocalPlane
from ..operators.classes import class_benchmark
from ..operators.figures import (FIGURE_SPEC_ROWS, attribute_vs_metric, bivariate_data, figure_data,
                                 figure_limits, outlines_for)
from ..operators.gap import access_gap_long, clean_gap
from ..operators.nearest import nearest_k_mean
from ..operators.network import od_network
from ..operators.od import DEFAULT_POPULATIONS, od_by_population, od_for_destinations, od_straight_line, od_straight_line_by_population
from ..operators.percapita import per_capita_long, zone_populations
from ..operators.ranking import join_on_keys, order_statistics
from ..operators.ranktest import signed_rank_test, test_report
from ..operators.spatial import points_in_zones, zone_buffers, zone_counts
from ..operators.summary import summary_table
from ..operators.weighting import area_shares, block_weights, zone_access, zone_population
from ..session import input_tasks, materialize, shared_dir
from ..sources import files, sinks
from . import gaps, roles

DIGITS = 6
K = 5
BY_MODE = {"mode": list(roles.MODES)}


def quantize(col, digits: int):
    """``floor(x * 10^d + 0.5) / 10^d``: the same double on every engine for
    the same input (no decimal-tie rules involved)."""
    scale = float(10 ** digits)
    return F.floor(col * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Quantize every double column (the last step of a registered query whose
    values are sums or means, which depend on the order of addition)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(quantize(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ------------------------------------------------------------ shared parts
def block_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """block_id, mode, population, avg_dist, avg_time: nearest-5 means."""
    od = roles.od_to_rank(spark, sf_dir)
    tagged = od_by_population(od, roles.destinations(spark, sf_dir))
    return nearest_k_mean(tagged, keys=["block_id", "mode", "population"], k=K)


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = area_shares(roles.area_attributes(spark, sf_dir), roles.SUB_ATTRIBUTE)
    return block_weights(roles.block_pops(spark, sf_dir), roles.block_zone(spark, sf_dir), shares)


def zone_table(spark: SparkSession, sf_dir: str, means: DataFrame | None = None) -> DataFrame:
    """zone_id, mode, population, dist, time: both populations and both modes
    rolled up in one pass (from ``means``, else the nearest-5 means of the OD
    table). The sub-population weight falls back to the whole population in
    zones where it is zero."""
    means = block_means(spark, sf_dir) if means is None else means
    w = weights(spark, sf_dir)
    is_all = F.col("population") == F.lit("all")
    return zone_access(
        means, w, outputs=["dist", "time"],
        weight=F.when(is_all, F.col("w_all")).otherwise(F.col("w_sub")),
        fallback_weight="w_all",
        by={**BY_MODE, "population": ["all", "sub"]},
    )


def gap_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return access_gap_long(zone_table(spark, sf_dir), roles.zone_names(spark, sf_dir), by=["mode"])


def class_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned gap table with class benchmarks, both modes."""
    zp = zone_population(roles.block_zone(spark, sf_dir), roles.block_pops(spark, sf_dir))
    return class_benchmark(clean_gap(gap_table(spark, sf_dir)), roles.zone_classes(spark, sf_dir), zp, by=["mode"])


# Which variables each mode's summary and test use.
SUMMARY_VARIABLES = {"auto": ["time_all", "time_sub", "diff_t"], "pedestrian": ["dist_all", "dist_sub", "diff_d"]}
TESTS = [("auto", "time_all", "time_sub", "Driving", "Time"), ("pedestrian", "dist_all", "dist_sub", "Walking", "Distance")]


# ------------------------------------------------------------ the queries
def q_access_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(gap_table(spark, sf_dir))


def q_nearest_k_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(block_means(spark, sf_dir))


def _one_population(spark: SparkSession, sf_dir: str, population: str) -> DataFrame:
    z = zone_table(spark, sf_dir)
    return rounded(z.where(F.col("population") == F.lit(population)).drop("population"))


def q_zone_weighted_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_population(spark, sf_dir, "all")


def q_zone_weighted_mean_sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _one_population(spark, sf_dir, "sub")


def q_zone_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(zone_population(roles.block_zone(spark, sf_dir), roles.block_pops(spark, sf_dir)))


def q_clean_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(clean_gap(gap_table(spark, sf_dir)))


def q_class_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(class_table(spark, sf_dir))


def q_summary_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spark.createDataFrame(
        [(m, v) for m, vs in SUMMARY_VARIABLES.items() for v in vs], "mode string, variable string"
    )
    variables = [v for vs in SUMMARY_VARIABLES.values() for v in vs]
    return summary_table(class_table(spark, sf_dir), variables, by="zone_class", keys=["mode"], pairs=pairs)


def q_signed_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per mode and class: time (driving) or distance (walking), whole
    population vs sub-population, one-sided 'less'."""
    ct = class_table(spark, sf_dir)
    is_auto = F.col("mode") == F.lit("auto")
    x = F.when(is_auto, F.col("time_all")).otherwise(F.col("dist_all"))
    y = F.when(is_auto, F.col("time_sub")).otherwise(F.col("dist_sub"))
    return rounded(signed_rank_test(ct, x, y, by=["mode", "zone_class"], alternative="less"), 12)


def q_test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(test_report(class_table(spark, sf_dir), TESTS, alternative="less"), 12)


# Grid cell of the spatial join (metres) for the driver zones.
CELL_M = 5000.0
ORIGIN = (roles.PLANE_LON0, roles.PLANE_LAT0)


def point_pairs(spark: SparkSession, sf_dir: str, sub_only: bool = False) -> DataFrame:
    return points_in_zones(
        roles.points(spark, sf_dir, sub_only), roles.zones(spark, sf_dir),
        tolerance_m=roles.TOLERANCE_M, cell_m=CELL_M, origin=ORIGIN,
    )


def counts(spark: SparkSession, sf_dir: str, sub_only: bool = False) -> DataFrame:
    return zone_counts(
        point_pairs(spark, sf_dir, sub_only), roles.zone_names(spark, sf_dir),
        roles.points(spark, sf_dir, sub_only), total_id=roles.TOTAL_ZONE_ID, total_name=roles.TOTAL_NAME,
    )


def zone_pops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_populations(
        roles.zone_attributes(spark, sf_dir), roles.POP_ATTRIBUTE, roles.SUB_ONLY_ATTRIBUTE,
        roles.SUB_EXTRA_ATTRIBUTE,
    )


def q_points_in_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return point_pairs(spark, sf_dir).select("point_id", "zone_id")


def q_project_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point on the national grid, and back from there."""
    p = roles.points(spark, sf_dir)
    x, y = MTM_ZONE_9.forward(F.col("lon"), F.col("lat"))
    lon, lat = MTM_ZONE_9.inverse(F.col("x"), F.col("y"))
    back = p.withColumns({"x": x, "y": y}).withColumns({"lon_back": lon, "lat_back": lat})
    far = F.sqrt(F.pow((F.col("lon_back") - F.col("lon")) * roles.KX, 2) + F.pow((F.col("lat_back") - F.col("lat")) * roles.KY, 2))
    return back.select("point_id", quantize(F.col("x"), 3).alias("x"), quantize(F.col("y"), 3).alias("y"),
                       quantize(F.col("lon_back"), 8).alias("lon"), quantize(F.col("lat_back"), 8).alias("lat"), (far < 1e-3).alias("returned"))


def q_points_in_zones_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points in zones on the national grid."""
    return points_in_zones(roles.points(spark, sf_dir), roles.zones(spark, sf_dir), tolerance_m=roles.TOLERANCE_M,
                           cell_m=CELL_M, plane=MTM_ZONE_9).select("point_id", "zone_id")


def q_points_in_wide_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One zone over the whole box, in cells of 250 m: inner cells of all sizes."""
    box = roles.zones(spark, sf_dir).agg(F.lit(1).alias("zone_id"), F.array(F.array(*[
        F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in roles.BOX_CORNERS])).alias("rings"))
    return points_in_zones(roles.points(spark, sf_dir), box, tolerance_m=roles.TOLERANCE_M, cell_m=250.0, origin=ORIGIN).select(
        "point_id", "zone_id")


BUFFER_STEPS = 64  # chords of a quarter circle: 4 mm inside the true arc of 50 m


def q_points_in_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points inside the zones' widened outlines: those a little further from a
    zone are tested against its curves."""
    pts, z = roles.points(spark, sf_dir), roles.zones(spark, sf_dir)
    near = points_in_zones(pts, z, tolerance_m=roles.TOLERANCE_M + 5.0, cell_m=CELL_M, origin=ORIGIN)
    wide = zone_buffers(z, roles.TOLERANCE_M, ORIGIN, BUFFER_STEPS).select("zone_id", "curves")
    x, y = LocalPlane(ORIGIN).forward(F.col("lon"), F.col("lat"))
    return near.join(wide, "zone_id").where(in_buffer(F.col("curves"), x, y)).select("point_id", "zone_id")


def q_zone_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts(spark, sf_dir)


def q_attribute_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(zone_pops(spark, sf_dir))


def q_per_capita(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both point populations in one spatial join: every point once as 'all'
    and once more as 'sub' when it belongs to the sub-population."""
    pts = roles.points_tagged(spark, sf_dir)
    pairs = points_in_zones(pts, roles.zones(spark, sf_dir), tolerance_m=roles.TOLERANCE_M, cell_m=CELL_M, origin=ORIGIN)
    cnt = zone_counts(pairs, roles.zone_names(spark, sf_dir), pts, total_id=roles.TOTAL_ZONE_ID,
                      total_name=roles.TOTAL_NAME, by={"population": ["all", "sub"]})
    return rounded(per_capita_long(cnt, zone_pops(spark, sf_dir)), 12)


# Fixed values for the figure data sets: walking maps show one class only,
# and the outline rule (no zone of the first class -> only outlines of the second).
WALK_CLASS = "AMERICA"
OUTLINE_IF_ABSENT, OUTLINE_KEEP_ONLY = "AFRICA", "AMERICA"
FIG_VARS = ["dist_all", "time_all", "dist_sub", "time_sub"]
SCATTER_ATTRIBUTE = roles.SUB_ONLY_ATTRIBUTE


def figure_spec(spark: SparkSession) -> DataFrame:
    return files.literal_table(spark, FIGURE_SPEC_ROWS, schemas.FIGURE_SPEC)


def figure_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every zone x mode with its metrics (zones without metrics kept, as the
    outline table is joined first), tagged with the figure data table."""
    ct = class_table(spark, sf_dir)
    z = roles.zone_names(spark, sf_dir).select("zone_id", "name").withColumn(
        "mode", F.explode(F.array(*[F.lit(m) for m in roles.MODES]))
    )
    j = z.join(ct.select("zone_id", "mode", "zone_class", *FIG_VARS), ["zone_id", "mode"], "left")
    dt = F.when(F.col("mode") == "auto", F.lit("auto")).when(
        (F.col("mode") == "pedestrian") & (F.col("zone_class") == F.lit(WALK_CLASS)), F.lit("walk"))
    j = j.withColumn("data_table", dt).where(F.col("data_table").isNotNull())
    return j.unpivot(["data_table", "zone_id", "name", "zone_class"], FIG_VARS, "variable", "value")


def q_figure_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(figure_data(figure_long(spark, sf_dir), figure_spec(spark)))


def q_figure_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = figure_data(figure_long(spark, sf_dir), figure_spec(spark))
    return rounded(figure_limits(data, figure_spec(spark)))


def class_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """zone_class, rings: the bounding box of each class's zones."""
    from ..functions.geo import rings_bbox
    z = roles.zones(spark, sf_dir).join(roles.zone_classes(spark, sf_dir).select("zone_id", "zone_class"), "zone_id")
    b = z.select("zone_class", rings_bbox(F.col("rings")).alias("b")).groupBy("zone_class").agg(
        F.min("b.min_x").alias("x0"), F.min("b.min_y").alias("y0"), F.max("b.max_x").alias("x1"), F.max("b.max_y").alias("y1"))
    pt = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    return b.select("zone_class", F.array(F.array(pt("x0", "y0"), pt("x1", "y0"), pt("x1", "y1"), pt("x0", "y1"), pt("x0", "y0"))).alias("rings"))


def q_figure_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines kept for each figure data table (rings dropped for the check)."""
    long = materialize(figure_long(spark, sf_dir))  # read once per data table
    outl = class_outlines(spark, sf_dir)
    parts = []
    for dt in ("auto", "walk"):
        kept = outlines_for(long.where(F.col("data_table") == dt), outl, OUTLINE_IF_ABSENT, OUTLINE_KEEP_ONLY)
        parts.append(kept.select(F.lit(dt).alias("data_table"), "zone_class", F.size("rings").alias("n_rings")))
    return parts[0].unionByName(parts[1])


def q_attribute_vs_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    ct = class_table(spark, sf_dir).where(F.col("mode") == "auto")
    return rounded(attribute_vs_metric(roles.zone_attributes(spark, sf_dir), SCATTER_ATTRIBUTE, ct, "diff_t"))


def q_bivariate_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    ct = class_table(spark, sf_dir).where(F.col("mode") == "auto")
    z = roles.zone_names(spark, sf_dir)
    return rounded(bivariate_data(z, ct, "time_sub", roles.zone_attributes(spark, sf_dir), SCATTER_ATTRIBUTE))


def q_od_by_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return od_by_population(roles.od_table(spark, sf_dir), roles.destinations(spark, sf_dir))


def q_od_sub(spark: SparkSession, sf_dir: str) -> DataFrame:
    return od_for_destinations(roles.od_table(spark, sf_dir), roles.destinations(spark, sf_dir), ["in_scope", "sub"])


def _scratch(spark: SparkSession, name: str) -> str:
    import uuid
    return f"{shared_dir(spark)}/catchment-io/{name}-{uuid.uuid4().hex[:12]}"


def q_csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block populations (numbers with grouping marks) and the block -> zone
    lookup written as CSV and read back typed; then zone populations."""
    base = _scratch(spark, "csv")
    c = roles.table(spark, sf_dir, "customer")
    bid = F.lpad(F.col("c_custkey").cast("string"), 8, "0")
    pops = c.select(bid.alias("DBUID"),
                    F.format_number(F.floor(F.greatest(F.col("c_acctbal"), F.lit(0.0))), 0).alias("pop"))
    sinks.write_csv(pops, f"{base}/pops.csv")
    sinks.write_csv(c.select(bid.alias("block_id"), F.col("c_nationkey").alias("zone_id")), f"{base}/lookup.csv")
    pops_back = files.read_block_pops(spark, f"{base}/pops.csv", area_width=6)
    lookup_back = files.read_table(spark, f"{base}/lookup.csv", schemas.LOOKUP)
    return rounded(zone_population(lookup_back, pops_back))


def q_destinations_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Destinations written with the source column names and read back: flag
    combinations and their counts."""
    base = _scratch(spark, "dest")
    d = roles.destinations(spark, sf_dir)
    src = d.select(F.col("dest_id").cast("string").alias("cpso"), F.lit(45.0).alias("lat"), F.lit(-75.0).alias("lng"),
                   F.when(F.col("in_scope"), "TRUE").otherwise("FALSE").alias("family_physician"),
                   F.when(F.col("sub"), "TRUE").otherwise("FALSE").alias("french"))
    sinks.write_csv(src, f"{base}/dest.csv")
    back = files.read_destinations(spark, f"{base}/dest.csv")
    return back.groupBy("in_scope", "sub").agg(F.count("*").alias("n"))


def q_od_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The OD table written partitioned by mode and read back; nearest-5
    means over all destinations."""
    base = _scratch(spark, "od")
    sinks.write_partitioned(roles.od_table(spark, sf_dir), f"{base}/od", by="mode")
    od = files.read_od(spark, f"{base}/od")
    return rounded(nearest_k_mean(od, keys=["block_id", "mode"], k=K))


def q_od_one_mode_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each mode's OD table written in a call of its own, one of them wrongly and
    then again: nearest-5 means of what the directory holds."""
    path = f"{_scratch(spark, 'od-modes')}/od"
    od = roles.od_table(spark, sf_dir)
    auto, walk = (od.where(F.col("mode") == m) for m in roles.MODES)
    sinks.write_partitioned(auto.withColumn("distance", F.lit(-1.0)), path)
    sinks.write_partitioned(walk, path)
    sinks.write_partitioned(auto, path)
    return rounded(nearest_k_mean(files.read_od(spark, path), keys=["block_id", "mode"], k=K))


def q_published_one_mode_rewritten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published gap table with one mode published again."""
    path = f"{_scratch(spark, 'published-modes')}/gap"
    gap = materialize(q_access_gap(spark, sf_dir)).select("mode", "zone_id", "name", "time_all")
    order = [("time_all", True)]
    sinks.write_published(gap.withColumn("time_all", F.lit(0.0)), path, order, by="mode")
    for mode in roles.MODES:
        sinks.write_published(gap.where(F.col("mode") == mode), path, order, by="mode")
    back = spark.read.option("header", True).option("nullValue", "NA").schema(
        "zone_id int, name string, time_all double, mode string").csv(path)
    return back.select("mode", "zone_id", "name", "time_all")


def q_csv_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Block populations with values that are no numbers, read typed: the
    failures by column and text, and the rows that kept a value."""
    path = f"{_scratch(spark, 'failures')}/pops.csv"
    c = roles.table(spark, sf_dir, "customer")
    pop = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("owes "), F.col("c_mktsegment"))).when(
        F.col("c_mktsegment") == "MACHINERY", F.lit("NA")).otherwise(F.floor("c_acctbal").cast("string"))
    sinks.write_csv(c.select(F.col("c_custkey").cast("string").alias("DBUID"), pop.alias("pop")), path)
    typed, failed = files.read_csv_checked(spark, path, schemas.BLOCK_POPS_CSV)
    bad = failed.groupBy("column", "text").agg(F.count("*").alias("n"))
    good = typed.where("pop is not null").agg(F.count("*").alias("n"))
    return bad.unionByName(good.select(F.lit(None).cast("string").alias("column"), F.lit("(number)").alias("text"), "n"))


BUCKETS = 8  # at least


def q_od_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The OD table stored in buckets by origin and read back: nearest-5 means
    without an exchange of OD rows."""
    path = f"{_scratch(spark, 'od-buckets')}/od"
    od = roles.od_table(spark, sf_dir)
    sinks.write_od_buckets(od, path, max(BUCKETS, input_tasks(od)))
    return rounded(nearest_k_mean(files.read_od_buckets(spark, path), keys=["block_id", "mode"], k=K))


def q_geojson_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone outlines written as GeoJSON features (one per line) and read back:
    rings and vertices per zone."""
    base = _scratch(spark, "geo")
    z = roles.zones(spark, sf_dir)
    coords = F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    feat = z.select(F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("zone_id").cast("string").alias("zone_id"), "name", "name_alt").alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")).alias("geometry"),
    )).alias("value"))
    feat.write.mode("overwrite").text(f"{base}/zones.geojsonl")
    back = files.read_zones_geojson(spark, f"{base}/zones.geojsonl", feature_per_line=True)
    return back.select(
        "zone_id", "name", "name_alt", F.size("rings").cast("long").alias("n_rings"),
        F.aggregate("rings", F.lit(0).cast("long"), lambda a, r: a + F.size(r)).alias("n_vertices"),
    )


def straight_line_od(spark: SparkSession, sf_dir: str) -> DataFrame:
    return od_straight_line(roles.block_points(spark, sf_dir), roles.dest_points(spark, sf_dir), k=K,
                            plane_origin=ORIGIN)


def q_od_straight_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(straight_line_od(spark, sf_dir))


def q_od_dense_town(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Straight-line proxy OD to one dense town and a few places on empty land."""
    return rounded(od_straight_line(roles.block_points(spark, sf_dir), roles.town_points(spark, sf_dir), k=K, plane_origin=ORIGIN))


def q_straight_line_access(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest-5 means over the straight-line proxy OD."""
    return rounded(nearest_k_mean(straight_line_od(spark, sf_dir), keys=["block_id", "mode"], k=K))


def q_straight_line_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone access gap over a straight-line proxy OD of each population."""
    dests = roles.dest_points(spark, sf_dir).join(roles.destinations(spark, sf_dir), "dest_id")
    od = od_straight_line_by_population(roles.block_points(spark, sf_dir), dests, k=K, plane_origin=ORIGIN)
    means = nearest_k_mean(od, keys=["block_id", "mode", "population"], k=K)
    return rounded(access_gap_long(zone_table(spark, sf_dir, means), roles.zone_names(spark, sf_dir), by=["mode"]))


NETWORK_MIN = 5  # nodes of an island of streets that places are tied to


def network_od(spark: SparkSession, sf_dir: str, cost: str = "time") -> DataFrame:
    """The k cheapest destinations of every block over the streets, per mode
    and population."""
    dests = roles.dest_points(spark, sf_dir).join(roles.destinations(spark, sf_dir), "dest_id")
    blocks = roles.block_points(spark, sf_dir)
    return od_network(roles.streets(spark, sf_dir), blocks.withColumnRenamed("block_id", "node"), blocks, dests, k=K, cost=cost,
                      min_reachability=NETWORK_MIN, modes=roles.MODES, populations=DEFAULT_POPULATIONS, plane_origin=ORIGIN)


def q_od_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quickest ways over the street network."""
    return network_od(spark, sf_dir)


def q_network_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone access gap over the shortest ways of each population."""
    means = nearest_k_mean(network_od(spark, sf_dir, cost="distance"), keys=["block_id", "mode", "population"], k=K)
    return rounded(access_gap_long(zone_table(spark, sf_dir, means), roles.zone_names(spark, sf_dir), by=["mode"]))


def q_signed_rank_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed-rank test of all residents against the sub-population over the
    blocks of each mode: more than 50 pairs, with ties and zero differences, so
    the normal approximation."""
    means = block_means(spark, sf_dir)
    both = means.groupBy("block_id", "mode").pivot("population", ["all", "sub"]).agg(F.max("avg_time"))
    pairs = both.select("mode", F.rint("all").alias("x"), F.rint("sub").alias("y"))
    return rounded(signed_rank_test(pairs, "x", "y", by=["mode"], alternative="less"))


def q_signed_rank_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact signed-rank test over the zones of each mode, times in whole minutes
    and distances in whole kilometres: ties and zero differences."""
    gap = materialize(q_access_gap(spark, sf_dir))
    pairs = gap.select("mode", F.inline(F.array(
        F.struct(F.lit("time").alias("metric"), F.rint("time_all").alias("x"), F.rint("time_sub").alias("y")),
        F.struct(F.lit("distance").alias("metric"), F.rint("dist_all").alias("x"), F.rint("dist_sub").alias("y")))))
    return rounded(signed_rank_test(pairs, "x", "y", by=["mode", "metric"], alternative="two.sided", exact=True), 9)


def q_quantiles_epoch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of event times in microseconds since 1970, per type: values
    that lie close together, far from zero."""
    ev = roles.table(spark, sf_dir, "events").select("event_type", F.unix_micros(F.col("ts").cast("timestamp")).cast("double").alias("v"))
    q = order_statistics(ev, ["event_type"], "v", [0.0, 0.25, 0.5, 0.75, 1.0])
    return q.select("event_type", *[quantize(F.col("q")[i], 2).alias(f"p{p}") for i, p in enumerate((0, 25, 50, 75, 100))])


# ------------------------------------------------------ inputs with gaps
def gaps_zone_table(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """:func:`zone_table` from the inputs of :mod:`.gaps`; ``options`` go to
    ``zone_access``."""
    tagged = od_by_population(gaps.od_table(spark, sf_dir), roles.destinations(spark, sf_dir))
    means = nearest_k_mean(tagged, keys=["block_id", "mode", "population"], k=K)
    shares = area_shares(gaps.area_attributes(spark, sf_dir), roles.SUB_ATTRIBUTE)
    w = block_weights(gaps.block_pops(spark, sf_dir), gaps.block_zone(spark, sf_dir), shares)
    weight = F.when(F.col("population") == F.lit("all"), F.col("w_all")).otherwise(F.col("w_sub"))
    return zone_access(means, w, outputs=["dist", "time"], weight=weight,
                       by={**BY_MODE, "population": ["all", "sub"]}, **options)


def gaps_gap_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = gaps_zone_table(spark, sf_dir, fallback_weight="w_all")
    return access_gap_long(z, roles.zone_names(spark, sf_dir), by=["mode"])


def q_signed_rank_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-sided signed-rank test of the blocks' populations against their
    mean: ties, and a p-value away from 0 and 1."""
    pops = roles.block_pops(spark, sf_dir).select(F.col("pop").alias("x"))
    mean = pops.agg(F.rint(F.avg("x")).alias("y"))
    return rounded(signed_rank_test(join_on_keys(pops, mean, []), "x", "y", alternative="two.sided"))


def q_gaps_access_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap table with missing values, fall-back weights and NULL zones."""
    return rounded(gaps_gap_table(spark, sf_dir))


def q_gaps_clean_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(clean_gap(gaps_gap_table(spark, sf_dir), exclude=gaps.CLEAN_EXCLUDE))


def q_gaps_class_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class benchmark with an unclassified zone and zones left out."""
    zp = zone_population(gaps.block_zone(spark, sf_dir), gaps.block_pops(spark, sf_dir))
    clean = clean_gap(gaps_gap_table(spark, sf_dir), exclude=gaps.CLEAN_EXCLUDE)
    return rounded(class_benchmark(clean, gaps.zone_classes(spark, sf_dir), zp, exclude=gaps.CLASS_EXCLUDE, by=["mode"]))


def q_gaps_empty_as_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up in which a populated zone that reaches nothing scores 0."""
    return rounded(gaps_zone_table(spark, sf_dir, empty_as_zero=True))


def q_gaps_reachable_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roll-up in which only blocks with a value weigh in, with the fall-back
    weights in one listed zone."""
    return rounded(gaps_zone_table(spark, sf_dir, reachable_only=True, fallback_weight="w_all",
                                   fallback_ids=[gaps.ZERO_SHARE_ZONE]))


def q_gaps_points_in_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A very large zone among small ones, small cells, points without valid coordinates."""
    return points_in_zones(gaps.points(spark, sf_dir), gaps.zones(spark, sf_dir), tolerance_m=roles.TOLERANCE_M,
                           cell_m=1500.0, origin=ORIGIN).select("point_id", "zone_id")


def q_gaps_straight_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Straight-line proxy OD to destinations that share three addresses."""
    return rounded(od_straight_line(roles.block_points(spark, sf_dir), gaps.dest_points(spark, sf_dir), k=K, plane_origin=ORIGIN))


def q_quantiles_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of the block means, per mode and population."""
    q = order_statistics(block_means(spark, sf_dir), ["mode", "population"], "avg_time", [0.0, 0.25, 0.5, 0.75, 1.0])
    names = ["p0", "p25", "p50", "p75", "p100"]
    return rounded(q.select("mode", "population", *[F.col("q")[i].alias(n) for i, n in enumerate(names)]))


# ------------------------------------------- files, read back in full
def q_area_table_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area attributes under their source names, in another order and with a
    column more; all columns read back."""
    path = f"{_scratch(spark, 'area')}/area.csv"
    a = roles.area_attributes(spark, sf_dir)
    sinks.write_csv(a.select(F.col("value").alias("T_DATA_DONNEE"), F.lit("x").alias("note"),
                             F.col("attribute_id").alias("TEXT_ID"), F.col("area_id").alias("DAUID")), path)
    return rounded(files.read_area_attributes(spark, path))


def q_block_points_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{_scratch(spark, 'points')}/points.csv"
    p = roles.block_points(spark, sf_dir)
    sinks.write_csv(p.select("lat", F.lit(1).alias("other"), F.col("block_id").alias("DBUID"), "lon"), path)
    return rounded(files.read_block_points(spark, path))


def q_destinations_table_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Destinations with reordered columns; every column read back."""
    path = f"{_scratch(spark, 'dest')}/dest.csv"
    d = roles.destinations(spark, sf_dir).join(roles.dest_points(spark, sf_dir), "dest_id", "left")
    sinks.write_csv(d.select(F.col("sub").alias("french"), F.col("lon").alias("lng"), "lat",
                             F.col("in_scope").alias("family_physician"), F.col("dest_id").alias("cpso")), path)
    return rounded(files.read_destinations(spark, path))


def q_zone_tables_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone classes and long zone attributes written as CSV, read back and joined."""
    base = _scratch(spark, "zones")
    sinks.write_csv(roles.zone_classes(spark, sf_dir), f"{base}/classes.csv")
    sinks.write_csv(roles.zone_attributes(spark, sf_dir), f"{base}/attributes.csv")
    classes = files.read_table(spark, f"{base}/classes.csv", schemas.ZONE_CLASS)
    values = files.read_table(spark, f"{base}/attributes.csv", schemas.ZONE_ATTRIBUTES)
    both = values.withColumn("zone_id", F.col("zone_id").try_cast("int")).join(classes, "zone_id", "left")
    return rounded(both.select("zone_id", "name", "zone_class", "attribute", "value"))


def q_published_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gap table published per mode, longest time first and missing ones
    last, and read back with every row's place in its file."""
    path = f"{_scratch(spark, 'published')}/gap"
    sinks.write_published(rounded(gaps_gap_table(spark, sf_dir)), path, order=[("time_sub", True), ("zone_id", False)], by="mode")
    back = spark.read.option("header", True).option("nullValue", "NA").schema(
        "zone_id int, name string, dist_all double, time_all double, dist_sub double, time_sub double, "
        "diff_d double, diff_t double, mode string").csv(path)
    place = Window.partitionBy("mode").orderBy("_line")
    return back.withColumn("_line", F.monotonically_increasing_id()).select(
        "mode", "zone_id", "name", "time_sub", F.row_number().over(place).cast("long").alias("place"))


def pipeline_outputs(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The end-to-end ``pipeline.run`` on the driver tables, its parameters
    mapped to the driver roles (no hard-coded zones apply to nations)."""
    from .pipeline import Params, run

    dests = roles.destinations(spark, sf_dir).join(
        roles.dest_points(spark, sf_dir).select("dest_id", "lon", "lat"), "dest_id", "left")
    params = Params(
        share_attribute=roles.SUB_ATTRIBUTE, fallback_ids=None, clean_exclude=(), class_exclude=(),
        total_id=roles.TOTAL_ZONE_ID, total_name=roles.TOTAL_NAME, pop_attr=roles.POP_ATTRIBUTE,
        sub_only_attr=roles.SUB_ONLY_ATTRIBUTE, sub_extra_attr=roles.SUB_EXTRA_ATTRIBUTE, extra_attrs=(),
        scatter_attr=SCATTER_ATTRIBUTE, walk_class=WALK_CLASS,
    )
    return run(
        od=roles.od_to_rank(spark, sf_dir), dests=dests, pops=roles.block_pops(spark, sf_dir),
        area_attributes=roles.area_attributes(spark, sf_dir), lookup=roles.block_zone(spark, sf_dir),
        zones=roles.zones(spark, sf_dir), zone_classes=roles.zone_classes(spark, sf_dir),
        zone_attributes=roles.zone_attributes(spark, sf_dir), params=params,
    )


def q_pipeline_class_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class table as the end-to-end pipeline produces it."""
    return rounded(pipeline_outputs(spark, sf_dir)["class_table"])


QUERIES = {
    "access_gap": q_access_gap,
    "nearest_k_mean": q_nearest_k_mean,
    "zone_weighted_mean": q_zone_weighted_mean,
    "zone_weighted_mean_sub": q_zone_weighted_mean_sub,
    "zone_population": q_zone_population,
    "clean_gap": q_clean_gap,
    "class_benchmark": q_class_benchmark,
    "summary_table": q_summary_table,
    "signed_rank": q_signed_rank,
    "test_report": q_test_report,
    "points_in_zones": q_points_in_zones,
    "project_points": q_project_points,
    "points_in_zones_grid": q_points_in_zones_grid,
    "points_in_wide_zone": q_points_in_wide_zone,
    "points_in_buffers": q_points_in_buffers,
    "zone_counts": q_zone_counts,
    "attribute_pivot": q_attribute_pivot,
    "per_capita": q_per_capita,
    "figure_data": q_figure_data,
    "figure_limits": q_figure_limits,
    "figure_outlines": q_figure_outlines,
    "attribute_vs_metric": q_attribute_vs_metric,
    "bivariate_data": q_bivariate_data,
    "od_by_population": q_od_by_population,
    "od_sub": q_od_sub,
    "csv_round_trip": q_csv_round_trip,
    "destinations_csv": q_destinations_csv,
    "od_round_trip": q_od_round_trip,
    "od_one_mode_rewritten": q_od_one_mode_rewritten,
    "published_one_mode_rewritten": q_published_one_mode_rewritten,
    "od_bucketed": q_od_bucketed,
    "csv_failures": q_csv_failures,
    "geojson_zones": q_geojson_zones,
    "od_straight_line": q_od_straight_line,
    "od_dense_town": q_od_dense_town,
    "straight_line_gap": q_straight_line_gap,
    "od_network": q_od_network,
    "network_gap": q_network_gap,
    "signed_rank_blocks": q_signed_rank_blocks,
    "signed_rank_level": q_signed_rank_level,
    "signed_rank_exact": q_signed_rank_exact,
    "quantiles_epoch": q_quantiles_epoch,
    "straight_line_access": q_straight_line_access,
    "pipeline_class_table": q_pipeline_class_table,
    "gaps_access_gap": q_gaps_access_gap,
    "gaps_clean_gap": q_gaps_clean_gap,
    "gaps_class_benchmark": q_gaps_class_benchmark,
    "gaps_empty_as_zero": q_gaps_empty_as_zero,
    "gaps_reachable_only": q_gaps_reachable_only,
    "gaps_points_in_zones": q_gaps_points_in_zones,
    "gaps_straight_line": q_gaps_straight_line,
    "quantiles_blocks": q_quantiles_blocks,
    "area_table_csv": q_area_table_csv,
    "block_points_csv": q_block_points_csv,
    "destinations_table_csv": q_destinations_table_csv,
    "zone_tables_csv": q_zone_tables_csv,
    "published_gap": q_published_gap,
}
