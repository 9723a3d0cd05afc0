"""URL rules found by their rarest literal token.

A rule fits a host and its subdomains where the path starts with the rule's
path. Every rule is filed under that one of its complete literal tokens (host
labels, and path parts that end within the rule) which the fewest addresses
carry. An address fetches the rules filed under its own tokens, and only those
run their regular expression. The longest rule that fits decides.

Only DataFrame functions are used. Equal (host, path) pairs are judged once.
The rules are a table: a short list given as Python rows, or any DataFrame
with ``host, path, verdict``; Spark broadcasts what it files under tokens when
that is small and else joins by shuffle.

Defined results. A null URL or one without ``://`` has an empty host and path,
which no rule fits. Rules without a token (empty host and path) fit nothing.
Of rules alike in length the smallest text wins, and block wins over allow.
Repeated rows each get their row; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _after(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_after(url), r"^([^/?#]*)", 1), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def tokens_of(host: Column, path: Column) -> Column:
    """Host labels (``h:``) and complete path parts (``p:``), distinct and not
    empty. The last path part counts as complete, as an address ends there."""
    parts = F.concat(
        F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("h:"), x)),
        F.transform(F.filter(F.split(path, "/"), lambda x: x != ""), lambda x: F.concat(F.lit("p:"), x)),
    )
    return F.array_distinct(parts)


def _rule_tokens(host: Column, path: Column) -> Column:
    """Like ``tokens_of``, but a path part that the rule does not end may go on
    in an address, so it is no token."""
    return tokens_of(host, F.regexp_replace(path, r"[^/]*$", ""))


def _pattern(host: Column, path: Column) -> Column:
    def quoted(c: Column) -> Column:
        return F.regexp_replace(c, r"([\\^$.|?*+()\[\]{}])", r"\\$1")

    return F.concat(F.lit(r"^([^/]*\.)?"), quoted(host), quoted(path))


def judge_urls(
    pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", otherwise: str = "allow"
) -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict``.
    ``rule`` is host and path of the rule that decides, null if none fits."""
    seen = pages.select(
        F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")
    )
    addresses = materialize(
        seen.where("host <> ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"))
        .select("host", "path", "pages", tokens_of(F.col("host"), F.col("path")).alias("tokens"))
    )
    filed = rules.select(
        F.concat("host", "path").alias("rule"), "verdict", _pattern(F.col("host"), F.col("path")).alias("pattern"),
        F.explode(_rule_tokens(F.col("host"), F.col("path"))).alias("token"),
    )
    wanted = filed.select("token").distinct()
    # summed up per token before the tokens meet the rules
    carried = addresses.select("pages", F.explode("tokens").alias("token")).groupBy("token").agg(
        F.sum("pages").alias("carried")).join(wanted, "token", "left_semi")
    index = materialize(
        filed.join(carried, "token", "left").groupBy("rule", "verdict", "pattern")
        .agg(F.min(F.struct(F.coalesce("carried", F.lit(0)).alias("n"), "token")).alias("best"))
        .select("rule", "verdict", "pattern", F.col("best.token").alias("token"))
    )
    fitting = (
        addresses.select("host", "path", F.explode("tokens").alias("token")).join(index, "token")
        .where(F.expr("concat(host, path) rlike pattern"))
    )
    order = F.struct(-F.length("rule"), F.col("rule"), (F.col("verdict") != F.lit("block")))
    decided = materialize(
        fitting.groupBy("host", "path").agg(F.min_by(F.struct("rule", "verdict"), order).alias("won"))
        .select("host", "path", "won.rule", "won.verdict")
    )
    return seen.alias("s").join(decided.alias("d"), ["host", "path"], "left").select(
        "s.page_id", "s.host", "s.path", "d.rule", F.coalesce("d.verdict", F.lit(otherwise)).alias("verdict"))
