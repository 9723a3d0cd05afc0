"""Mixing sources to target weights by pivotal dependent rounding.

Every source gets a target number of words; each of its documents should then
be taken ``target / source size`` times. The whole part of that is certain. The
fractional parts are paired: words are moved between the two documents of a
pair at random, without bias, until one of them is taken a whole number of
times; the other goes on to its next pair. Every move keeps the words taken in
total, so a source misses its target by less than its last open document.

Pairs are worked off in a reduction tree: a hashed bucket of about ``FAN_IN``
documents leaves one open document, the buckets' open documents are dealt into
buckets again, and so on, until one is left for each source. Only DataFrame
functions are used, and draws are hashes of ids, so that reruns agree.

Defined results. Null or blank text has size 0 and no words taken. Sources are
ranked by code point with null last; a null source is a source. Rows alike in
id, source and size are one unit with a row count, so they need no room of
their own in a bucket; the first of them take the extra copies. An empty table
gives an empty result. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .shared import by_position, numbered

FAN_IN = 64
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Runs of characters outside ``[\\x20\\x09-\\x0D]``; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple = (5, 2, 1), share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """``source, source_size, target``. The weights repeat over the sources in
    order; targets share ``share`` times all sizes by weight and stop at
    ``limit`` times the source's size, the excess going to the others by
    weight: the targets are ``min(cap, level * weight)`` for the one level that
    gives the sum, found from prefix sums over the sources ordered by the level
    at which each is full. One row per source is ordered in one task."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - F.lit(1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(limit)))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_full = Window.orderBy(F.col("cap") / F.col("w"), "source")
    per = per.withColumn("total", F.sum("source_size").over(every) * F.lit(float(share)))
    full = F.coalesce(F.sum("cap").over(by_full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_w = F.sum("w").over(by_full.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = per.withColumn("level", (F.col("total") - full) / open_w).withColumn("at", F.col("cap") / F.col("w"))
    per = per.withColumn("turn", F.row_number().over(by_full))
    # the first source in that order that the level of its place does not fill
    level = F.min(F.when(F.col("level") <= F.col("at"), F.struct("turn", "level"))).over(every)["level"]
    per = per.withColumn("lv", level)
    target = F.when(F.col("lv").isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), F.col("lv") * F.col("w")))
    return per.select("source", "source_size", target.alias("target"))


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def _uniform(*cols: Column) -> Column:
    """A hash in [0, 1) that no data order changes."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))


def _pair(acc: Column, x: Column, seed: int) -> Column:
    """One pair: the open document ``acc.open`` meets ``x``. ``up`` and ``down``
    are the words that can be moved to and from the open one."""
    a = acc["open"]

    def settle(d: Column, extra: int) -> Column:
        return F.concat(acc["done"], F.array(F.struct(d["id"].alias("id"), d["size"].alias("size"), d["m"].alias("m"),
                                                      (d["sure"] + F.lit(extra)).alias("extra"))))

    def moved(d: Column, by: Column) -> Column:
        return F.struct(d["h"].alias("h"), d["id"].alias("id"), d["size"].alias("size"), d["m"].alias("m"),
                        d["sure"].alias("sure"), (d["p"] + by / d["size"]).alias("p"))

    def out(open_: Column, done: Column) -> Column:
        return F.struct(open_.alias("open"), done.alias("done"))

    def decide(v: Column) -> Column:
        up, down = v["up"], v["down"]
        rises = _uniform(F.lit(seed), a["id"], a["size"], x["id"], x["size"]) * (up + down) < down
        a_first_up = (F.lit(1.0) - a["p"]) * a["size"] <= x["p"] * x["size"]
        a_first_down = a["p"] * a["size"] <= (F.lit(1.0) - x["p"]) * x["size"]
        return (
            F.when(rises & a_first_up, out(moved(x, -up), settle(a, 1)))
            .when(rises, out(moved(a, up), settle(x, 0)))
            .when(a_first_down, out(moved(x, down), settle(a, 0)))
            .otherwise(out(moved(a, -down), settle(x, 1)))
        )

    return _let(F.struct(
        F.least((F.lit(1.0) - a["p"]) * a["size"], x["p"] * x["size"]).alias("up"),
        F.least(a["p"] * a["size"], (F.lit(1.0) - x["p"]) * x["size"]).alias("down"),
    ), decide)


_DONE = "array<struct<id bigint, size bigint, m bigint, extra bigint>>"


def mixed_units(docs: DataFrame, id_col: str, source_col: str, text_col: str, seed: int, **targets) -> DataFrame:
    """``id, source, size, source_size, target, base, m, extra``: the ``m`` rows
    alike in id, source and size are each taken ``base`` times, and ``extra``
    of them once more."""
    sized = materialize(
        docs.select(F.col(id_col).cast("long").alias("id"), F.col(source_col).alias("source"),
                    word_count(F.col(text_col)).alias("size"))
        .groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("m")),
        few=True,
    )
    goal = materialize(source_targets(sized.select("source", (F.col("size") * F.col("m")).alias("size")), **targets), few=True)
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    near = F.round(times)
    times = F.when(F.abs(times - near) < 1e-12, near).otherwise(times)
    units = sized.alias("s").join(goal.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source"))).select(
        "s.*", "g.source_size", "g.target").withColumn("base", F.floor(times)).withColumn("p", (times - F.col("base")) * F.col("m"))
    units = materialize(units.withColumn("sure", F.floor("p")).withColumn("p", F.col("p") - F.col("sure")), few=True)
    of_source = ["source", "source_size", "target", "base"]
    open_ = (F.col("size") > 0) & (F.col("p") > 0)
    settled = [units.where(~open_).select(*of_source, "id", "size", "m", F.col("sure").alias("extra"))]
    level = units.where(open_).select(
        *of_source, F.struct(F.xxhash64(F.lit(seed), "id", "size").alias("h"), "id", "size", "m", "sure", "p").alias("u"))
    counts = materialize(level.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / F.lit(FAN_IN)).alias("buckets")), few=True)
    most = counts.agg(F.max("buckets")).first()[0]
    depth = 0
    while most:
        dealt = level.alias("l").join(counts.alias("c"), F.col("l.source").eqNullSafe(F.col("c.source"))).select(
            "l.*", F.pmod(F.xxhash64(F.lit(seed + depth), "u.id", "u.size", "u.m"), "c.buckets").alias("bucket"))
        met = F.sort_array(F.collect_list("u"))
        start = F.struct(F.element_at("all", 1).alias("open"), F.array().cast(_DONE).alias("done"))
        level = materialize(
            dealt.groupBy(*of_source, "bucket").agg(met.alias("all")).select(*of_source, F.aggregate(
                F.slice("all", F.lit(2), F.size("all")), start, lambda acc, x: _pair(acc, x, seed)).alias("r")),
            few=True,
        )
        settled.append(level.select(*of_source, F.explode("r.done").alias("d")).select(
            *of_source, "d.id", "d.size", "d.m", "d.extra"))
        level = level.select(*of_source, F.col("r.open").alias("u"))
        if most == 1:
            last = F.when(_uniform(F.lit(seed), "u.id", F.lit("last")) < F.col("u.p"), F.lit(1)).otherwise(F.lit(0))
            settled.append(level.select(*of_source, "u.id", "u.size", "u.m", (F.col("u.sure") + last).alias("extra")))
            break
        counts = materialize(counts.select("source", F.ceil(F.col("buckets") / F.lit(FAN_IN)).alias("buckets")), few=True)
        most, depth = -(-most // FAN_IN), depth + 1
    result = settled[0]
    for more in settled[1:]:
        result = result.union(more)
    return result


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                seed: int = 42, **targets) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, size, source_size, target, taken``.
    ``targets``: ``weights``, ``share`` and ``limit`` as in ``source_targets``."""
    units = mixed_units(docs, id_col, source_col, text_col, seed, **targets)
    rows = units.select("*", F.explode(F.sequence(F.lit(1).cast("long"), "m")).alias("i"))
    copies = F.col("base") + F.when(F.col("i") <= F.col("extra"), F.lit(1)).otherwise(F.lit(0))
    return rows.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (copies * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
                    seed: int = 42, **targets) -> DataFrame:
    """The rows of ``docs`` (same columns), each as many times as the mix takes
    it: of the ``m`` rows alike in id, source and size, the first ``extra`` by
    hash of all their columns are taken once more than the others. Further
    columns may have any name."""
    units = mixed_units(docs, id_col, source_col, text_col, seed, **targets)
    own, names = by_position(docs)
    at = dict(zip(docs.columns, names))
    return _taken_documents(own, units, at[id_col], at[source_col], at[text_col]).toDF(*docs.columns)


def _taken_documents(docs: DataFrame, units: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    alike = ["_id", "_source", "_size"]
    copies = units.select(F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("size").alias("_size"),
                          F.col("m").alias("_m"), F.col("base").alias("_base"), F.col("extra").alias("_extra"))
    on = (docs[id_col].eqNullSafe(F.col("_id")) & docs[source_col].eqNullSafe(F.col("_source"))
          & (word_count(docs[text_col]) == F.col("_size")))
    own = [docs[c] for c in docs.columns]

    def taken(rows: DataFrame, turn: Column) -> DataFrame:
        times = (F.col("_base") + F.when(turn < F.col("_extra"), F.lit(1)).otherwise(F.lit(0))).cast("int")
        return rows.select(*docs.columns, F.explode(F.array_repeat(F.lit(0), times)).alias("_copy")).drop("_copy")

    single = taken(docs.join(copies.where("_m = 1"), on).select(*own, "_base", "_extra"), F.lit(0))
    more = copies.where("_m > 1")
    if more.isEmpty():
        return single
    # equal rows are numbered apart, so that no hash of a row is common
    rows = materialize(docs.join(more, on).select(
        *own, *alike, "_base", "_extra", F.xxhash64(F.to_json(F.struct(*own))).alias("_mark"),
        F.monotonically_increasing_id().alias("_row")))
    rows = materialize(numbered(rows, [*alike, "_mark"], ["_row"], "_same").drop("_row"))
    return single.union(taken(numbered(rows, alike, ["_mark", "_same"], "_turn"), F.col("_turn")))
