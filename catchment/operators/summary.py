"""Quantile summary tables: minimum, quartiles and maximum of several
variables, per class and over all rows.

Quantiles interpolate linearly between order statistics (the usual "type 7"
rule), computed exactly and distributed (``ranking.order_statistics``): no
group is gathered in one task, whatever the size of the input. Every row is
used twice -- with its class and in the overall group -- a fixed fan-out
that gives both grouping levels in one pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import range_text
from ..session import checked_broadcast, materialize
from .ranking import join_on_keys, order_statistics

PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]
Q_COLS = ["p0", "p25", "p50", "p75", "p100"]


def summary_table(
    df: DataFrame,
    variables: Sequence[str],
    by: str = "zone_class",
    keys: Sequence[str] = (),
    overall_label: str = "Overall",
    digits: int = 2,
    diff_marker: str = "diff",
    pairs: DataFrame | None = None,
) -> DataFrame:
    """One row per (``keys``, class, variable) plus one per (``keys``,
    variable) labelled ``overall_label``.

    Columns: *keys, ``by``, variable, p0, p25, p50, p75, p100 (rounded half to
    even to ``digits``), ``median_iqr_text`` = 'p50 (p25-p75)' for variables
    without ``diff_marker`` in their name and ``median_min_max_text`` =
    'p50 (p0-p100)' for those with it. ``pairs`` (keys + variable) limits which
    variables are summarised for which keys.
    """
    keys = list(keys)
    long = df.select(*keys, by, *[F.col(v).cast("double").alias(v) for v in variables]).unpivot(
        [*keys, by], list(variables), "variable", "value"
    )
    if pairs is not None:
        long = long.join(checked_broadcast(pairs.select(*keys, "variable")), [*keys, "variable"], "left_semi")
    long = long.select(*keys, "variable", "value", F.inline(F.array(
        F.struct(F.col(by).alias("_cls"), F.lit(False).alias("_overall")),
        F.struct(F.lit(None).cast(long.schema[by].dataType).alias("_cls"), F.lit(True).alias("_overall")),
    )))
    gk = [*keys, "_cls", "_overall", "variable"]
    long = materialize(long)
    groups = long.select(*gk).distinct()
    g = join_on_keys(groups, order_statistics(long, gk, "value", PROBS), gk, "left")
    g = g.withColumn(by, F.col("_cls")).withColumnRenamed("q", "_q")
    label = F.when(F.col("_overall"), F.lit(overall_label)).otherwise(F.col(by))
    q = [F.bround(F.col("_q")[i], digits).alias(c) for i, c in enumerate(Q_COLS)]
    out = g.select(*keys, label.alias(by), "variable", *q)
    is_diff = F.col("variable").contains(diff_marker)
    return out.select(
        "*",
        F.when(~is_diff, range_text("p50", "p25", "p75", digits)).alias("median_iqr_text"),
        F.when(is_diff, range_text("p50", "p0", "p100", digits)).alias("median_min_max_text"),
    )
