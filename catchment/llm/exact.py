"""Exact duplicates by distributed MSD radix partitioning.

Documents are split by their normalised byte length and then by successive
runs of bytes. A group is named by a number of its own; each round splits every open
group by the next run, which a map-side summed count does without moving equal
rows. Rows that are alone after a round are settled, and so are groups whose
texts have ended; only the others go on, with the rest of their text. Runs
grow from round to round, so that a long text takes few rounds. Texts are
compared byte by byte; the SHA-256 is an output column and decides nothing.

Defined results. A null text counts as empty. Rows that repeat an id with an
equal text are copies as any others (all of them carry the id that stays). A
null id is below every other; if all of a group are null, the id that stays is
null and none of them is marked as kept (``keep_one`` lets one of them stay, and
every row that is alone). An empty table gives an empty result. Further columns
are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .shared import attach_groups, by_position

# Bytes compared in the first round, growth of the run per round, longest run.
FIRST_RUN = 32
GROWTH = 64
LONGEST_RUN = 1 << 20

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def normalised(text: Column) -> Column:
    """A-Z lower-cased, nothing else; null becomes empty."""
    return F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower())


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept,
    text_sha256``; of equal normalised texts the row with the largest id stays."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.encode(normalised(F.col(text_col)), "UTF-8").alias("rest")
    ).select("id", F.sha2("rest", 256).alias("sha"), F.octet_length("rest").alias("left"), "rest")
    keys, at, run = ["left", "run"], 0, FIRST_RUN
    settled = []
    while True:
        cut = rows.withColumn("run", F.substring("rest", 1, run)).withColumn("rest", F.expr(f"substring(rest, {run + 1})"))
        found = attach_groups(cut, keys, {"keep": F.max("id")}, number="name")
        alone, ended = F.col("_n") == 1, F.col("left") <= run
        done = materialize(found.select(
            "id", "sha", F.when(alone, F.col("id")).otherwise(F.col("keep")).alias("keep"), F.col("_n").alias("size"),
            (F.col("left") - run).alias("left"), F.when(~alone & ~ended, F.col("rest")).alias("rest"),
            "name", (alone | ended).alias("done"),
        ), few=True)
        settled.append(done.where("done").select("id", "sha", "keep", "size"))
        rows = done.where(~F.col("done")).select("id", "sha", F.col("name").alias("grp"), "left", "rest")
        if rows.isEmpty():
            break
        keys, run = ["grp", "left", "run"], min(run * GROWTH, LONGEST_RUN)
        at += 1
    return reduce(DataFrame.union, settled).select(
        F.col("id").alias("doc_id"), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"),
        F.coalesce(F.col("id") == F.col("keep"), F.lit(False)).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` (same columns) without exact copies: of each group
    of equal texts the document with the largest id stays, and of rows alike in
    id (or without one) and text one, by hash. Further columns may have any
    name."""
    own, names = by_position(docs)
    at = dict(zip(docs.columns, names))
    return _one_of_each(own, at[id_col], at[text_col]).toDF(*docs.columns)


def _one_of_each(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    found = exact_duplicates(docs, id_col, text_col)
    keys = materialize(
        found.groupBy(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
        .agg(F.count(F.lit(1)).alias("_n"), F.first(~F.col("kept") & F.col("keep_id").isNotNull()).alias("_gone"))
        .where("_gone or _n > 1"),
        few=True,
    )
    sha = F.sha2(F.encode(normalised(docs[text_col]), "UTF-8"), 256)
    on = docs[id_col].eqNullSafe(F.col("_id")) & (sha == F.col("_sha"))
    alone = docs.join(keys, on, "left_anti")
    again = keys.where("not _gone")
    if again.isEmpty():
        return alone
    row = F.struct(*[docs[c] for c in docs.columns])
    one = docs.join(again, on).groupBy("_id", "_sha").agg(F.min_by(row, F.xxhash64(F.to_json(row))).alias("_row"))
    return alone.union(one.select("_row.*"))
