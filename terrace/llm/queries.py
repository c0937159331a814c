"""The queries of this subpackage: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import byte_bpe, chat_tree, clustering, fingerprint, mixing, ngram_join, packing, quality, sorted_table, substring_dedup, toxicity, url_lists, whitening
from .common import materialize, text_rows


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "clauses")


def url_entries(pages: DataFrame) -> DataFrame:
    """The tables have no list, so one is derived from the addresses of pages: dated entries of hosts, of their parent domains, of paths below hosts and of whole addresses, by fixed rules of their digests."""
    host = url_lists.host_of(F.col("url"))
    hosts = pages.select(host.alias("host")).where("host <> ''").distinct()
    parents = hosts.select(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("host")).where("host <> ''").distinct()
    paths = pages.select(F.concat(host, F.regexp_extract(url_lists.path_of(F.col("url")), "^(/[^/]+/[^/]+)", 1)).alias("host"), host.alias("short")).where("host <> short").select("host").distinct()
    addresses = pages.select(F.concat(host, url_lists.tail_of(F.col("url"))).alias("host"), host.alias("short")).where("short <> '' and contains(host, '?')").select("host").distinct()
    crc = F.conv(F.substring(F.md5(F.col("host").cast("binary")), 1, 6), 16, 10).cast("long")
    dated = lambda n, gap: F.date_add(F.lit("2024-01-01").cast("date"), (crc % n + gap).cast("int"))
    one = hosts.where(crc % 3 == 0).select(F.col("host").alias("key"), F.when(crc % 2 == 0, "block").otherwise("allow").alias("action"), dated(200, 0).alias("dated"))
    end = hosts.where(crc % 9 == 0).select(F.col("host").alias("key"), F.lit("delist").alias("action"), dated(200, 90).alias("dated"))
    wide = parents.where(crc % 4 == 1).select(F.col("host").alias("key"), F.lit("block").alias("action"), dated(300, 0).alias("dated"))
    deep = paths.where(crc % 7 == 2).select(F.col("host").alias("key"), F.when(crc % 2 == 0, "block").otherwise("allow").alias("action"), dated(250, 20).alias("dated"))
    full = addresses.where(crc % 6 == 3).select(F.col("host").alias("key"), F.lit("block").alias("action"), dated(150, 10).alias("dated"))
    return one.union(end).union(wide).union(deep).union(full)


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    # pages say no date of fetching; it is derived from page_id
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") * 37 % 366).cast("int")))
    return url_lists.judge(captures, url_entries(pages))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.round_trip(text_rows(table(spark, sf_dir, "documents")), ranks, public_tokenizers.PATTERN))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = materialize(quality.measure(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).drop("text"), "measured")
    kept = quality.judge(measured, quality.cutoffs(measured, table(spark, sf_dir, "labels")))
    return kept.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_sorted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sorted_table.digests(sorted_table.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(table(spark, sf_dir, "documents"), width=3, percent=90)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digests(packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op9_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_tree.digests(chat_tree.read_back(*chat_tree.build(rows)))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.digests(fingerprint.edits(table(spark, sf_dir, "documents")))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    # deviations beyond a long, which tables of some million vectors can have, are null here
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.totals(*mixing.plan(table(spark, sf_dir, "documents")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_toxicity, op2_url_filters, op3_substring_dedup, op4_byte_bpe, op5_quality_rules, op6_sorted_table, op7_ngram_join, op8_packing, op9_chat_tree, op10_fingerprints, op11_centroid_clustering, op12_whitening, op13_mixing)}


def _clusters(rounds: int = 10) -> str:
    """Rounds written out: every vector against every centroid, all dimensions."""
    parts = [
        "v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = 64)",
        "e AS MATERIALIZED (SELECT vec_id, i, x[i + 1] AS x FROM (SELECT vec_id, x, unnest(range(64)) AS i FROM v))",
        "c0 AS MATERIALIZED (SELECT j, i, x[i + 1] AS c FROM (SELECT j, x, unnest(range(64)) AS i FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS j, x FROM v) WHERE j < 8))",
    ]
    near = "(SELECT vec_id, d, j FROM (SELECT vec_id, d, j, row_number() OVER (PARTITION BY vec_id ORDER BY d, j) AS r FROM (SELECT e.vec_id, c.j, CAST(sum((e.x - c.c) * (e.x - c.c)) AS BIGINT) AS d FROM e JOIN c{t} c ON e.i = c.i GROUP BY ALL)) WHERE r = 1)"
    for t in range(rounds + 1):
        parts.append(f"a{t} AS MATERIALIZED {near.format(t=t)}")
        if t < rounds:
            parts.append(f"c{t + 1} AS MATERIALIZED (SELECT c.j, c.i, coalesce(m.c, c.c) AS c FROM c{t} c LEFT JOIN (SELECT j, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS c FROM a{t} JOIN e ON a{t}.vec_id = e.vec_id GROUP BY j, i) m ON c.j = m.j AND c.i = m.i)")
    return f"""WITH {", ".join(parts)},
        p AS (SELECT j, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY j),
        w AS (SELECT j, CAST(sum(d) AS BIGINT) AS cluster_inertia FROM a{rounds} GROUP BY j)
        SELECT vec_id, CAST(a.j AS INTEGER) AS cluster, d AS distance, cluster_inertia, CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia, centroid_sha256
        FROM a{rounds} a JOIN p ON a.j = p.j JOIN w ON a.j = w.j"""


ORACLE: dict[str, str] = {
    "op11_centroid_clustering": _clusters(),
    "op13_mixing": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, md5('13:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS key FROM documents),
        s AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source)),
        o AS (SELECT *, row_number() OVER (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST) AS place FROM s),
        u AS (SELECT *, (SELECT sum(source_size) FROM o) - coalesce((SELECT sum(3 * b.source_size) FROM o b WHERE b.place < a.place), 0) AS free, (SELECT sum(b.weight) FROM o b WHERE b.place >= a.place) AS others FROM o a),
        f AS (SELECT max(CAST(free AS DOUBLE) / CAST(others AS DOUBLE)) AS level FROM u WHERE free * weight <= 3 * source_size * others),
        t AS (SELECT *, least(CAST(floor(target + 0.5) AS BIGINT), 3 * source_size) AS words FROM (SELECT source, source_size, CASE WHEN free * weight > 3 * source_size * others THEN CAST(3 * source_size AS DOUBLE) ELSE level * weight END AS target FROM u, f)),
        p AS (SELECT d.doc_id, d.size, source_size, target, words, CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size AS BIGINT) AS begun FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
        SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE CAST(words // source_size * size + greatest(0, least(begun + size, words % source_size) - begun) AS BIGINT) END AS taken FROM p
    """,
    "op2_url_filters": r"""
        WITH p AS (
            SELECT page_id, url, DATE '2024-01-01' + CAST(page_id * 37 % 366 AS INTEGER) AS fetched,
                   rtrim(lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
                   regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1) AS path,
                   regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)', 1) AS tail
            FROM pages),
        h AS (SELECT host, CAST('0x' || substr(md5(host), 1, 6) AS BIGINT) AS c FROM (SELECT DISTINCT host FROM p WHERE host <> '')),
        d AS (SELECT host, CAST('0x' || substr(md5(host), 1, 6) AS BIGINT) AS c FROM (SELECT DISTINCT regexp_extract(host, '([^.]+\.[^.]+)$', 1) AS host FROM p) WHERE host <> ''),
        f AS (SELECT host, CAST('0x' || substr(md5(host), 1, 6) AS BIGINT) AS c FROM (SELECT DISTINCT host || regexp_extract(path, '^(/[^/]+/[^/]+)', 1) AS host FROM p WHERE regexp_matches(path, '^/[^/]+/[^/]+'))),
        a AS (SELECT host, CAST('0x' || substr(md5(host), 1, 6) AS BIGINT) AS c FROM (SELECT DISTINCT host || tail AS host FROM p WHERE host <> '' AND contains(host || tail, '?'))),
        e AS (
            SELECT host AS key, CASE WHEN c % 2 = 0 THEN 'block' ELSE 'allow' END AS action, DATE '2024-01-01' + CAST(c % 200 AS INTEGER) AS dated FROM h WHERE c % 3 = 0
            UNION ALL SELECT host, 'delist', DATE '2024-01-01' + CAST(c % 200 + 90 AS INTEGER) FROM h WHERE c % 9 = 0
            UNION ALL SELECT host, 'block', DATE '2024-01-01' + CAST(c % 300 AS INTEGER) FROM d WHERE c % 4 = 1
            UNION ALL SELECT host, CASE WHEN c % 2 = 0 THEN 'block' ELSE 'allow' END, DATE '2024-01-01' + CAST(c % 250 + 20 AS INTEGER) FROM f WHERE c % 7 = 2
            UNION ALL SELECT host, 'block', DATE '2024-01-01' + CAST(c % 150 + 10 AS INTEGER) FROM a WHERE c % 6 = 3),
        i AS (SELECT *, lead(dated) OVER (PARTITION BY key ORDER BY dated) AS valid_to FROM (SELECT key, dated, min(action) AS action FROM e GROUP BY key, dated)),
        k AS (
            SELECT DISTINCT page_id, url, fetched, unnest(list_concat([host || tail],
                   list_transform(range(1, len(string_split(path, '/')) + 1), lambda n: host || array_to_string(string_split(path, '/')[:n], '/')),
                   list_transform(range(1, len(string_split(host, '.')) + 1), lambda n: array_to_string(string_split(host, '.')[n:], '.')))) AS key
            FROM p WHERE host <> ''),
        m AS (
            SELECT page_id, url, k.fetched, k.key, i.action, i.dated, row_number() OVER (PARTITION BY page_id, url, k.fetched ORDER BY length(k.key) DESC, k.key DESC) AS r
            FROM k JOIN i ON k.key = i.key AND i.action <> 'delist' AND i.dated <= k.fetched AND (i.valid_to IS NULL OR k.fetched < i.valid_to))
        SELECT p.page_id, p.fetched, p.host, coalesce(m.action, 'none') AS verdict, m.key AS matched, m.dated AS valid_from
        FROM (SELECT DISTINCT page_id, url, fetched, host FROM p) p LEFT JOIN (SELECT * FROM m WHERE r = 1) m ON p.page_id = m.page_id AND p.url = m.url
    """,
    "op9_chat_tree": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        s AS (SELECT *, role || text AS said FROM c)
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(15 + length(said) + length(said) - length(translate(said, '\<>', ''))) AS BIGINT) AS formatted_chars
        FROM s GROUP BY conv_id
    """,
}
