"""Paired Wilcoxon signed-rank test as an aggregate, per group.

Differences ``x - y``; pairs with a missing side are dropped, zero
differences are dropped (and noted). The absolute differences get average
ranks; the statistic V is the rank sum of the positive differences.

p-value: the exact null distribution when ``n < 50`` and there are neither
ties nor zeros (subset-sum counts built with array higher-order functions, one
row per group); otherwise the normal approximation with tie and continuity
correction. The normal CDF is column arithmetic (``normal_cdf``). With
``exact=True`` every group gets the exact distribution given its own ranks: twice
the average ranks are whole numbers, and the chance of every sum of them is
built rank by rank, each positive with chance one half. That takes about n ** 3
steps on one row, so a group above ``EXACT_LIMIT`` pairs is an error then, never
a silent approximation.

Ranks are exact and distributed (``ranking.distinct_ranks``): no group is
ever gathered in one task, so the test also runs on block-level data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import normal_cdf
from ..session import materialize
from .ranking import distinct_ranks, join_on_keys

ALTERNATIVES = ("less", "greater", "two.sided")


def _psignrank(q: Column, n_col: str = "_n_exact") -> Column:
    """P(V <= q) for n = ``n_col`` from the subset-sum counts (doubles are
    exact up to 2^53, far above 2^49 for n < 50)."""
    counts = F.expr(
        f"aggregate(sequence(1, {n_col}), "
        f"transform(sequence(0, CAST({n_col} * ({n_col} + 1) / 2 AS INT)), s -> IF(s = 0, 1D, 0D)), "
        f"(acc, i) -> transform(acc, (c, s) -> c + IF(s >= i, acc[s - i], 0D)))"
    )
    qi = F.floor(q).cast("int")
    upto = F.when(qi < 0, F.lit(0.0)).otherwise(
        F.aggregate(F.slice(counts, 1, qi + 1), F.lit(0.0), lambda a, c: a + c)
    )
    return upto / F.pow(F.lit(2.0), F.col(n_col))


# Pairs of a group up to which exact=True is computed.
EXACT_LIMIT = 500


def _tied_cdf(q: Column, ranks: Column) -> Column:
    """P(S <= q) of the sum of those of the whole numbers ``ranks`` that a fair
    coin picks. The law is symmetric: at most half of it is built."""
    total = F.aggregate(ranks, F.lit(0).cast("long"), lambda a, r: a + r)
    upper = q >= total - q - 1
    top = F.when(upper, total - q - 1).otherwise(q)
    start = F.transform(F.sequence(F.lit(0).cast("long"), F.greatest(top, F.lit(0))), lambda s: F.when(s == 0, F.lit(1.0)).otherwise(F.lit(0.0)))

    def with_rank(law: Column, r: Column) -> Column:
        return F.transform(law, lambda p, s: p / F.lit(2.0) + F.when(s >= r, F.get(law, (s - r).cast("int")) / F.lit(2.0)).otherwise(F.lit(0.0)))

    below = F.when(top < 0, F.lit(0.0)).otherwise(
        F.aggregate(F.aggregate(ranks, start, with_rank), F.lit(0.0), lambda a, p: a + p))
    return F.when(upper, F.lit(1.0) - below).otherwise(below)


def _doubled_ranks(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    """*by, ``_ranks``: twice the average ranks of a group's pairs, for groups up
    to ``EXACT_LIMIT`` (no more than so many numbers a row)."""
    size = ranked.groupBy(*by).agg(F.sum("_t").alias("_size")).where(F.col("_size") <= EXACT_LIMIT)
    small = join_on_keys(ranked, size, by) if by else join_on_keys(ranked, size, by).where(F.col("_size").isNotNull())
    twice = F.col("_less") * 2 + F.col("_t") + 1
    return small.groupBy(*by).agg(F.sort_array(F.flatten(F.collect_list(F.array_repeat(twice, F.col("_t").cast("int"))))).alias("_ranks"))


def signed_rank_test(
    df: DataFrame,
    x: str | Column,
    y: str | Column,
    by: Sequence[str] = (),
    alternative: str = "two.sided",
    correct: bool = True,
    exact: bool | None = None,
) -> DataFrame:
    """Columns: *by, n (pairs used), statistic (V), p_value, method
    ('exact' / 'normal'), alternative. ``alternative='less'`` tests x < y.
    ``exact``: None decides by the number of pairs and ties, True is exact for
    every group (an error above ``EXACT_LIMIT`` pairs), False always normal."""
    if alternative not in ALTERNATIVES:
        raise ValueError(f"alternative must be one of {ALTERNATIVES}")
    by = list(by)
    xc = F.col(x) if isinstance(x, str) else x
    yc = F.col(y) if isinstance(y, str) else y
    d = materialize(df.select(*by, (xc - yc).alias("_d")).where(F.col("_d").isNotNull()))

    zeros = d.groupBy(*by).agg(F.count(F.when(F.col("_d") == 0, 1)).alias("_zeros"))
    ranked = distinct_ranks(
        d.where(F.col("_d") != 0), by, F.abs(F.col("_d")), extra={"_pos": F.count(F.when(F.col("_d") > 0, 1))}
    )
    avg_rank = F.col("_less") + (F.col("_t") + F.lit(1)) / F.lit(2.0)
    stats = ranked.groupBy(*by).agg(
        F.sum("_t").alias("n"),
        F.sum(F.col("_pos") * avg_rank).alias("statistic"),
        F.sum(F.pow(F.col("_t").cast("double"), F.lit(3.0)) - F.col("_t")).alias("_tie"),
        F.max("_t").alias("_max_t"),
    )
    stats = join_on_keys(zeros, stats, by, "left")
    n = F.coalesce(F.col("n"), F.lit(0))
    v = F.col("statistic")
    nd = n.cast("double")  # products of counts overflow a long
    if exact:
        use_exact = n > 0
        ranks = _doubled_ranks(ranked, by)
        # a group above the limit has no ranks here
        stats = join_on_keys(stats, ranks, by, "left")
        v2 = F.round(v * 2).cast("long")

        def cdf(q: Column) -> Column:
            return _tied_cdf(q, F.col("_ranks"))

        v_at, v_below = v2, v2 - 1
    else:
        use_exact = F.lit(exact is None) & (n < 50) & (n > 0) & (F.coalesce(F.col("_max_t"), F.lit(1)) <= 1) & (F.col("_zeros") == 0)
        stats = stats.withColumn("_n_exact", F.when(use_exact, n).otherwise(F.lit(0)).cast("int"))
        cdf, v_at, v_below = _psignrank, v, v - 1

    # exact p-values
    if alternative == "less":
        p_exact = cdf(v_at)
    elif alternative == "greater":
        p_exact = F.lit(1.0) - cdf(v_below)
    else:
        half = nd * (nd + 1) / F.lit(4.0)
        p_one = F.when(v > half, F.lit(1.0) - cdf(v_below)).otherwise(cdf(v_at))
        p_exact = F.least(F.lit(2.0) * p_one, F.lit(1.0))
    if exact:
        p_exact = F.when(n <= EXACT_LIMIT, p_exact).otherwise(F.raise_error(F.concat(
            F.lit(f"no exact p-value above {EXACT_LIMIT} pairs: a group has "), n.cast("string"))).cast("double"))

    # normal approximation
    z0 = v - nd * (nd + 1) / F.lit(4.0)
    sigma = F.sqrt(nd * (nd + 1) * (F.lit(2) * nd + 1) / F.lit(24.0) - F.coalesce(F.col("_tie"), F.lit(0.0)) / F.lit(48.0))
    if not correct:
        corr = F.lit(0.0)
    elif alternative == "less":
        corr = F.lit(-0.5)
    elif alternative == "greater":
        corr = F.lit(0.5)
    else:
        corr = F.signum(z0) * F.lit(0.5)
    z = F.try_divide(z0 - corr, sigma)
    if alternative == "less":
        p_norm = normal_cdf(z)
    elif alternative == "greater":
        p_norm = F.lit(1.0) - normal_cdf(z)
    else:
        p_norm = F.lit(2.0) * F.least(normal_cdf(z), F.lit(1.0) - normal_cdf(z))

    p = F.when(n == 0, F.lit(None)).when(use_exact, p_exact).otherwise(p_norm)
    return stats.select(
        *by,
        n.cast("long").alias("n"),
        v.cast("double").alias("statistic"),
        p.cast("double").alias("p_value"),
        F.when(n == 0, F.lit(None)).when(use_exact, F.lit("exact")).otherwise(F.lit("normal")).alias("method"),
        F.lit(alternative).alias("alternative"),
    )


def test_report(
    df: DataFrame,
    tests: Sequence[tuple[str, str, str, str, str]],
    key: str = "mode",
    by: str = "zone_class",
    overall_label: str = "All",
    alternative: str = "less",
) -> DataFrame:
    """Stacked report of several signed-rank tests, per class and over all
    rows, in one pass.

    ``tests``: (key value, x column, y column, mode label, metric label) --
    e.g. ('auto', 'time_all', 'time_sub', 'Driving', 'Time'). Each row of
    ``df`` is used once with its class and once in the overall group (a fixed
    two-way fan-out), so every test is one group of one aggregate.
    Columns: mode, metric, zone class, p_value, paired, alternative.
    """
    kc = F.col(key)
    x = y = None
    for kv, xc, yc, _, _ in tests:
        cond = kc == F.lit(kv)
        x = F.when(cond, F.col(xc)) if x is None else x.when(cond, F.col(xc))
        y = F.when(cond, F.col(yc)) if y is None else y.when(cond, F.col(yc))
    rows = df.where(kc.isin([t[0] for t in tests])).select(
        kc.alias(key), x.alias("_x"), y.alias("_y"),
        F.inline(F.array(
            F.struct(F.col(by).alias("_cls"), F.lit(False).alias("_overall")),
            F.struct(F.lit(None).cast("string").alias("_cls"), F.lit(True).alias("_overall")),
        )),
    )
    res = signed_rank_test(rows, "_x", "_y", by=[key, "_cls", "_overall"], alternative=alternative)
    label = F.when(F.col("_overall"), F.lit(overall_label)).otherwise(F.col("_cls"))
    kc2 = F.col(key)
    ml = mt = None
    for kv, _, _, m1, m2 in tests:
        cond = kc2 == F.lit(kv)
        ml = F.when(cond, F.lit(m1)) if ml is None else ml.when(cond, F.lit(m1))
        mt = F.when(cond, F.lit(m2)) if mt is None else mt.when(cond, F.lit(m2))
    return res.select(
        ml.alias("mode"), mt.alias("metric"), label.alias(by), "p_value",
        F.lit(True).alias("paired"), "alternative",
    )
