"""Registered queries of this subpackage: each applies one operator to its
whole table. ``ORACLE`` has the DuckDB SQL of those that SQL can express; the
others are tested against brute force in ``tests/llm``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, codes, digest, divergence, exact, mixing, neardup, ngram, packing, quality, sharding, tokenfiles, urls
from .shared import ship_package

SHARDS = 8
# The rules of the URL query: host, path, verdict.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Where the installed public tokenizer file lies."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS, stored=True)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model).select("doc_id", "content_score", "meta_score", "quality_score", "kept")


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=2)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = tokenfiles.write_token_files(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return tokenfiles.read_token_files(manifest)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(table(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.lm_scores(table(spark, sf_dir, "documents"))


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress_vectors(table(spark, sf_dir, "embeddings"))


def op12_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.neighbour_digests(table(spark, sf_dir, "documents"), stored=True)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf_dir, "documents"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f)
    for f in (op1_sharding, op2_quality_classifier, op3_minhash_near_dedup, op4_source_mixing, op5_token_files,
              op6_exact_dedup, op7_lm_scoring, op8_nearest_neighbours, op9_url_filters, op10_packing, op11_vector_codes,
              op12_document_fingerprints, op13_source_divergence)
}

_CODE_NEAREST = """
            SELECT x.id, x.p, any_value(x.v) AS v, arg_min(b.e, (d, b.e)) AS e, min(d) AS d
            FROM parts x JOIN book{i} b USING (p),
                 LATERAL (SELECT list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - b.v[i]) * (x.v[i] - b.v[i]))) AS d)
            GROUP BY x.id, x.p"""
_CODE_ROUND = f"""
        near{{i}} AS MATERIALIZED ({_CODE_NEAREST}),
        sums{{i}} AS MATERIALIZED (
            SELECT p, e, i, sum(v[i])::BIGINT AS s, count(*) AS n
            FROM near{{i}}, (SELECT unnest(range(1, (SELECT max(len(v)) FROM parts) + 1)) AS i) GROUP BY p, e, i),
        mean{{i}} AS (
            SELECT p, e, list(s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END ORDER BY i) AS v FROM sums{{i}} GROUP BY p, e),
        book{{j}} AS MATERIALIZED (
            SELECT b.p, b.e, coalesce(m.v, b.v) AS v FROM book{{i}} b LEFT JOIN mean{{i}} m USING (p, e)),"""

ORACLE: dict[str, str] = {
    "op11_vector_codes": """
        WITH k AS (
            SELECT vec_id AS id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        parts AS MATERIALIZED (
            SELECT id, p, v[p * (len(v) // 8) + 1: (p + 1) * (len(v) // 8)] AS v FROM k, (SELECT unnest(range(8)) AS p)),
        book0 AS MATERIALIZED (
            SELECT p, e, v FROM parts JOIN (SELECT id, row_number() OVER (ORDER BY id) - 1 AS e FROM k) USING (id) WHERE e < 16),"""
    + "".join(_CODE_ROUND.format(i=i, j=i + 1) for i in range(6))
    + f"""
        near AS ({_CODE_NEAREST.format(i=6)}),
        coded AS (SELECT id, string_agg(lpad(printf('%x', e), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near GROUP BY id)
        SELECT id AS vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) FROM book6) AS codebooks_sha256
        FROM coded JOIN k USING (id)
    """,
    "op13_source_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents),
        t AS (SELECT k, lang, source, unnest(w) AS term FROM d),
        kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT k) >= 10),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY lang, source, term),
        g AS (SELECT DISTINCT lang, source FROM d),
        total AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY lang, source),
        cells AS (
            SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
                   1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(total.n, 0) + 2 * v.v) AS p
            FROM g JOIN kept USING (lang) JOIN v USING (lang) LEFT JOIN total USING (lang, source) LEFT JOIN c USING (lang, source, term)),
        whole AS (
            SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 2)) // ((SELECT sum(n) FROM total x WHERE x.lang = cells.lang) + 2 * any_value(v.v)) AS q
            FROM cells JOIN v USING (lang) GROUP BY lang, term),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(sum(x.f), 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN (
                SELECT p.lang, p.source, q.source AS item, ((p.p - q.p) * (p.p - q.p)) // (p.p + q.p) AS f
                FROM cells p JOIN cells q ON p.lang = q.lang AND p.term = q.term AND p.source <> q.source) x
            ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
            GROUP BY a.lang, a.source, b.source),
        strong AS (
            SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value
            FROM cells JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
        found AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs
                  UNION ALL SELECT lang, source, 'term', item, value FROM strong)
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM found)
        WHERE part = 'pair' OR rank <= 10
    """,
    "op3_minhash_near_dedup": r"""
        WITH RECURSIVE toks AS (
            SELECT doc_id, list_filter(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                lambda x: x <> '') AS w
            FROM documents),
        sets AS (
            SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
                ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
            FROM toks),
        sh AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id <> b.doc_id AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        reach(doc_id, root) AS (
            SELECT doc_id, doc_id FROM sets
            UNION
            SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.doc_id WHERE r.root < l.b),
        comp AS (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id)
        SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, c.component_id, c.component_id = s.doc_id AS kept
        FROM sets s JOIN comp c USING (doc_id)
    """,
    "op6_exact_dedup": """
        WITH t AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n
            FROM documents),
        g AS (SELECT n, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY n)
        SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.n) AS text_sha256
        FROM t JOIN g USING (n)
    """,
    "op8_nearest_neighbours": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        d AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   sqrt(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: (q.e[i] - c.e[i]) * (q.e[i] - c.e[i])))) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
        SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM d
        WINDOW w AS (PARTITION BY query_id ORDER BY score, vec_id) QUALIFY row_number() OVER w <= 10
    """,
    "op9_url_filters": r"""
        WITH u AS (
            SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS a FROM pages),
        s AS (
            SELECT page_id,
                   translate(regexp_extract(a, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(a, '^[^/?#]*([^?#]*)', 1) AS path
            FROM u),
        r(h, p, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
                                    ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        f AS (
            SELECT page_id, h || p AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC) AS k
            FROM s JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
        SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
        FROM s LEFT JOIN f ON s.page_id = f.page_id AND f.k = 1
    """,
}
