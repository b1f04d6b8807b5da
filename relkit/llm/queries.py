"""The queries that apply each corpus operator, with production
parameters, to its whole table, and the DuckDB SQL of those that SQL can
express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relkit.llm import bagminhash, chunk_recipes, crf_language, license_templates, line_join, mix_flow, multi_index, online_packing, pseudonyms, quotes, spelling_trie, tier_packing, vantage_clusters
from relkit.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.chat_lines(quotes.link_quotes(table(spark, sf_dir, "conversations")))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_mix_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_flow.mixed_table(table(spark, sf_dir, "documents"))


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts with pseudonyms; n_values and kinds (distinct, sorted,
    comma-joined) of the values found, and has_private."""
    got = pseudonyms.pseudonymise(table(spark, sf_dir, "documents"))
    n = F.size("spans").cast("bigint")
    return got.select("doc_id", "text", n.alias("n_values"), (n > 0).alias("has_private"),
                      F.array_join(F.array_sort(F.array_distinct("spans.kind")), ",").alias("kinds"))


def op5_line_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_join.link_lines(table(spark, sf_dir, "documents"), **line_join.WHOLE)


def op6_chunk_recipes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_recipes.dedup(table(spark, sf_dir, "documents")).drop("n_chunks")


def op7_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_templates.scan(table(spark, sf_dir, "documents"))


def op8_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bagminhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_language.predict_all(table(spark, sf_dir, "documents"))


def op10_tier_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tier_packing.pack_documents(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_vantage_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vantage_clusters.clusters(table(spark, sf_dir, "embeddings"))


def op12_spelling_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_trie.variants(table(spark, sf_dir, "documents"))


def op13_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return online_packing.pack_online(table(spark, sf_dir, "documents"), TOKENIZER)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quotes": op1_quotes,
    "op2_multi_index": op2_multi_index,
    "op3_mix_flow": op3_mix_flow,
    "op4_pseudonyms": op4_pseudonyms,
    "op5_line_join": op5_line_join,
    "op6_chunk_recipes": op6_chunk_recipes,
    "op7_license_templates": op7_license_templates,
    "op8_bagminhash": op8_bagminhash,
    "op9_crf_language": op9_crf_language,
    "op10_tier_packing": op10_tier_packing,
    "op11_vantage_clusters": op11_vantage_clusters,
    "op12_spelling_trie": op12_spelling_trie,
    "op13_online_packing": op13_online_packing,
    "pipeline": corpus_pipeline.run,
}



def _clusters_sql(k: int = 8, rounds: int = 10, dim: int = 64) -> str:
    """k-means in whole numbers, a step after the other.  A distance and a
    centroid's number make one number, so the smaller one wins ties."""
    near = """
        SELECT r, vec_id, x, best % {k} AS c, best // {k} AS d FROM (
            SELECT v.r, any_value(v.vec_id) AS vec_id, any_value(v.x) AS x,
                   min({k} * CAST(list_sum(list_transform(list_zip(v.x, m.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)
                       + m.c) AS best
            FROM v, {centroids} AS m GROUP BY v.r)"""
    steps = [f"""
        v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: CAST(floor({1024} * CAST(x AS DOUBLE)) AS BIGINT)) AS x
            FROM embeddings
            WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h NULLS LAST, x) - 1 AS c, x
            FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h NULLS LAST, x LIMIT {k}))"""]
    for i in range(rounds):
        steps.append(f"""
        a{i} AS MATERIALIZED ({near.format(k=k, centroids=f"c{i}")}),
        m{i} AS (
            SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY j) AS x
            FROM (SELECT c, j, sum(y) AS s, count(*) AS n
                  FROM (SELECT c, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM a{i}) GROUP BY c, j) GROUP BY c),
        c{i + 1} AS MATERIALIZED (
            SELECT o.c, coalesce(m.x, o.x) AS x FROM c{i} AS o LEFT JOIN m{i} AS m ON m.c = o.c)""")
    return f"""
        WITH {",".join(steps)},
        f AS MATERIALIZED ({near.format(k=k, centroids=f"c{rounds}")})
        SELECT f.vec_id, CAST(f.c AS INTEGER) AS cluster, CAST(f.d AS BIGINT) AS distance,
               CAST(sum(f.d) OVER (PARTITION BY f.c) AS BIGINT) AS cluster_inertia, CAST(sum(f.d) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(m.x, ',')) AS centroid_sha256
        FROM f JOIN c{rounds} AS m ON m.c = f.c"""


ORACLE_SQL: dict[str, str] = {
    "op11_vantage_clusters": _clusters_sql(),
    # The checksum is the exclusive or of a table's entries for each byte and
    # its distance from the end; 3988292384 is the reversed polynomial.
    "op12_spelling_trie": """
        WITH RECURSIVE found AS (
            SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\\x{C0}-\\x{FF}]{5,}')) AS run FROM documents),
        runs AS MATERIALIZED (
            SELECT row_number() OVER () AS r, * FROM (
                SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
                FROM found GROUP BY 1, 2)),
        hexed AS MATERIALIZED (SELECT r, hex(encode(CAST(doc_id AS VARCHAR) || ':' || run)) AS h FROM runs WHERE doc_id IS NOT NULL),
        bits AS (
            SELECT b, 0 AS i, b AS v FROM range(256) AS x(b)
            UNION ALL
            SELECT b, i + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE i < 8),
        first AS MATERIALIZED (SELECT b, v FROM bits WHERE i = 8),
        entries AS (
            SELECT 0 AS k, b, v FROM first
            UNION ALL
            SELECT k + 1, entries.b, xor(entries.v >> 8, first.v) FROM entries JOIN first ON first.b = entries.v & 255
            WHERE k < (SELECT max(len(h)) // 2 FROM hexed)),
        bytes AS (
            SELECT r, len(h) // 2 - 1 - i AS k,
                   xor(CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT), CASE WHEN i < 4 THEN 255 ELSE 0 END) AS b
            FROM (SELECT r, h, unnest(range(len(h) // 2)) AS i FROM hexed)),
        sums AS (
            SELECT r, xor(bit_xor(v), 4294967295) AS h FROM bytes JOIN entries ON entries.k = bytes.k AND entries.b = bytes.b GROUP BY r),
        spelt AS (
            SELECT CASE WHEN h % 97 = 0
                        THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) + 2 AS BIGINT))
                        ELSE run END AS word, n
            FROM runs LEFT JOIN sums USING (r)),
        w AS MATERIALIZED (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
        less AS MATERIALIZED (
            SELECT word, i, substr(word, 1, i) || substr(word, i + 2) AS rest
            FROM (SELECT word, unnest(range(length(word))) AS i FROM w)),
        links AS (
            SELECT a.word, b.word AS near FROM less AS a JOIN less AS b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT less.word, w.word FROM less JOIN w ON less.rest = w.word
            UNION SELECT w.word, less.word FROM less JOIN w ON less.rest = w.word),
        ranked AS (
            SELECT links.word, near, m.n AS near_n, count(*) OVER (PARTITION BY links.word) AS n_near,
                   row_number() OVER (PARTITION BY links.word ORDER BY m.n DESC, near) AS place
            FROM links JOIN w AS m ON m.word = near),
        told AS MATERIALIZED (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
                   CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
            FROM w LEFT JOIN ranked ON ranked.word = w.word AND place = 1),
        walk AS (
            SELECT word, word AS root, form AS next FROM told
            UNION ALL
            SELECT walk.word, told.word, told.form FROM walk JOIN told ON told.word = walk.next)
        SELECT told.word, told.form, walk.root, told.n, told.n_near, told.form_n
        FROM told JOIN walk ON walk.word = told.word AND walk.next IS NULL""",
    # Shares: sources in order of 2 * size / weight are full up to the first
    # one that the level of the rest does not fill.
    "op3_mix_flow": """
        WITH d AS (
            SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
                   md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS hash
            FROM documents),
        s AS (
            SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                        WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
            FROM d GROUP BY source),
        o AS (
            SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total,
                   CAST(coalesce(sum(source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS below,
                   CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS weights
            FROM s WINDOW w AS (ORDER BY 2.0 * source_size / weight, source NULLS LAST)),
        f AS (
            SELECT *, 2 * source_size * 2 * weights < weight * (3 * total - 4 * below) AS is_full FROM o),
        l AS (
            SELECT any_value(total) AS total, coalesce(sum(source_size) FILTER (is_full), 0) AS full_size,
                   sum(weight) FILTER (NOT is_full) AS rest_weight FROM f),
        t AS (
            SELECT source, source_size,
                   CASE WHEN is_full THEN CAST(2 * source_size AS DOUBLE)
                        ELSE CAST(weight * (3 * l.total - 4 * full_size) AS DOUBLE) / CAST(2 * rest_weight AS DOUBLE)
                   END AS target
            FROM f, l),
        q AS (
            SELECT *, least(CAST(floor(target + 0.5) AS BIGINT), 2 * source_size) AS amount FROM t),
        r AS (
            SELECT *, CASE WHEN source_size > 0 THEN amount // source_size ELSE 0 END AS whole FROM q),
        c AS (
            SELECT d.doc_id, d.size, r.source_size, r.target, r.whole, r.amount - r.whole * r.source_size AS rest,
                   sum(d.size) OVER (PARTITION BY d.source ORDER BY hash, size, doc_id
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS before
            FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source)
        SELECT doc_id, size, source_size, target,
               CAST(whole * size + greatest(0, least(size, rest - before)) AS BIGINT) AS taken
        FROM c""",
    "op6_chunk_recipes": """
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW g AS (PARTITION BY coalesce(text, ''))""",
}
