"""catchment: zone-level access analytics on Spark.

Operators (``catchment.operators``) are DataFrame -> DataFrame functions built
from Spark's own expressions; ``catchment.plans.pipeline.run`` chains them
into the whole analysis; ``catchment.sources`` reads and writes the tables.
"""

from .operators.classes import class_benchmark
from .operators.figures import attribute_vs_metric, bivariate_data, figure_data, figure_limits, outlines_for
from .operators.gap import access_gap, access_gap_long, clean_gap
from .operators.nearest import nearest_k_mean, top_k_per_group
from .operators.od import nearest_destinations, od_by_population, od_for_destinations, od_straight_line, od_straight_line_by_population
from .operators.percapita import attribute_wide, per_capita, per_capita_long, zone_populations
from .operators.ranktest import signed_rank_test, test_report
from .operators.spatial import points_in_zones, zone_counts
from .operators.summary import summary_table
from .operators.weighting import area_shares, block_weights, zone_access, zone_population

__all__ = [
    "access_gap", "access_gap_long", "area_shares", "attribute_vs_metric", "attribute_wide", "bivariate_data",
    "block_weights", "class_benchmark", "clean_gap", "figure_data", "figure_limits", "nearest_destinations",
    "nearest_k_mean", "od_by_population", "od_for_destinations", "od_straight_line", "od_straight_line_by_population", "outlines_for",
    "per_capita", "per_capita_long", "points_in_zones", "signed_rank_test", "summary_table", "test_report",
    "top_k_per_group", "zone_access", "zone_counts", "zone_population", "zone_populations",
]
