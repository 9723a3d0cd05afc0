"""Nearest-k access: per origin, the mean cost to its k cheapest destinations.

Each measure ranks on itself (the k nearest by distance and the k quickest by
time may be different destinations). The ``row_number() <= k`` filter sits directly above
its window, which lets Catalyst insert a partial ``WindowGroupLimit`` *before*
the shuffle: every map task ships at most k rows per origin and measure, so
neither the OD size nor a hot origin reaches the exchange.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, keys: Sequence[str], order_col: str | Sequence[str], k: int) -> DataFrame:
    """First ``k`` rows of each group by ascending ``order_col`` (one column
    or several, the later ones breaking ties), NULLs last.

    With one order column, ties at rank k are cut arbitrarily; the mean of
    the k smallest values does not depend on which tied row is kept.
    """
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    w = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) for c in order])
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")


def nearest_k_mean(
    od: DataFrame,
    keys: Sequence[str] = ("block_id",),
    measures: Mapping[str, tuple[str, float]] | None = None,
    k: int = 5,
) -> DataFrame:
    """Mean of each measure over the k rows of the key with the smallest values.

    ``measures`` maps an output name to ``(input column, divisor)``; the default
    gives ``avg_dist`` in input units and ``avg_time`` in minutes from seconds.
    Missing costs rank last and are skipped by the mean, so an origin with fewer
    than k known costs gets the mean of those it has. Rows without a key are
    dropped: they cannot be attributed to an origin.

    One pass: every OD row is turned into one (measure, value) row per measure
    inside the scan's pipeline; a single window over (key, measure) with the
    ``<= k`` filter gets its partial limit before the one exchange; the small
    per-key result is pivoted back to one column per measure.
    """
    if measures is None:
        measures = {"avg_dist": ("distance", 1.0), "avg_time": ("time", 60.0)}
    keys = list(keys)
    base = od.where(_all_not_null(keys))
    long = base.select(*keys, F.inline(F.array(*[
        F.struct(F.lit(i).alias("_m"), F.col(col).cast("double").alias("_v")) for i, (col, _) in enumerate(measures.values())
    ])))
    top = top_k_per_group(long, [*keys, "_m"], "_v", k)
    per_measure = top.groupBy(*keys, "_m").agg(F.avg("_v").alias("_a"))
    cols = []
    for i, (name, (_, divisor)) in enumerate(measures.items()):
        mean = F.max(F.when(F.col("_m") == F.lit(i), F.col("_a")))
        if divisor != 1.0:
            mean = mean / F.lit(float(divisor))
        cols.append(mean.alias(name))
    return per_measure.groupBy(*keys).agg(*cols)


def _all_not_null(keys: Sequence[str]):
    cond = F.col(keys[0]).isNotNull()
    for c in keys[1:]:
        cond = cond & F.col(c).isNotNull()
    return cond
