"""Queries of the text operators over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_pack_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from ledgerline.llm.op1_packing import packed

    return packed(_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op2_language_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op2_language import identified

    return identified(_documents(spark, sf_dir))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op3_minhash import near_duplicates

    return near_duplicates(_documents(spark, sf_dir), k=4, percent=80)


def op4_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op4_line_dedup import deduplicated

    return deduplicated(_documents(spark, sf_dir).select("doc_id", "text"))


def op5_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op5_stream_dedup import exact_duplicates

    return exact_duplicates(spark, f"{sf_dir}/documents.parquet")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op6_mixing import mixed

    return mixed(_documents(spark, sf_dir).select("doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")


def op7_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op7_permutation_index import nearest

    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=50, k=5)


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op8_surrogates import pseudonymised

    return pseudonymised(_documents(spark, sf_dir))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op9_licenses import licensed

    return licensed(_documents(spark, sf_dir))


def op10_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op10_suffix_dedup import without_repeats

    return without_repeats(_documents(spark, sf_dir), 100).drop("kept")


def op11_gated_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op11_gated_scoring import log_likelihoods

    return log_likelihoods(_documents(spark, sf_dir))


def op12_heap_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op12_heap_clustering import clustered

    return clustered(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerline.llm.op13_fill_in_middle import transformed

    return transformed(_documents(spark, sf_dir)).drop("output", "restored", "pieces")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_pack_best_fit,
        op2_language_families,
        op3_near_duplicates,
        op4_fuzzy_lines,
        op5_exact_duplicates,
        op6_mix_sources,
        op7_permutation_index,
        op8_surrogates,
        op9_licenses,
        op10_suffix_repeats,
        op11_gated_likelihood,
        op12_heap_clusters,
        op13_fill_in_middle,
    )
}

_WORDS = r"[^\x20\x09-\x0D]+"

ORACLE_SQL: dict[str, str] = {
    "op5_exact_duplicates": """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
""",
    "op6_mix_sources": rf"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS BIGINT) AS size,
                  md5('mix:' || CAST(doc_id AS VARCHAR)) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, encode(source)) AS i
      FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][CAST((i - 1) % 3 + 1 AS INT)] :: DOUBLE AS w, 3 * source_size AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / w, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, CASE WHEN cap <= level * w THEN CAST(cap AS DOUBLE)
             ELSE least(max(CASE WHEN cap > level * w THEN level END) OVER () * w, cap) END AS target FROM l),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS b,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (b // source_size) * size + greatest(0, least(size, b % source_size - ahead)) END AS BIGINT) AS taken
FROM p
""",
    "op13_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
h AS (SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT *, CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                     WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b FROM h),
p AS (SELECT *, substr(text, 1, a) AS prefix, substr(text, a + 1, b - a) AS middle, substr(text, b + 1) AS suffix FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(text) AS restored_sha256
FROM p
""",
}


def _clusters_sql(k: int = 40, rounds: int = 5) -> str:
    """k-means over whole numbers as a chain of tables: a(n) assigns to the centroids c(n), c(n + 1) are their floored means."""
    steps = [
        """v AS MATERIALIZED (SELECT row_number() OVER () AS i, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        f"""c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || CAST(vec_id AS VARCHAR)), v) - 1 AS INT) AS j, v AS c
FROM v QUALIFY j < {k})""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""a{n} AS MATERIALIZED (SELECT i, vec_id, v, min(CAST(d AS BIGINT) * 1000 + j) AS dj FROM (
SELECT i, vec_id, v, j, list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c) AS d FROM v CROSS JOIN c{n}) GROUP BY i, vec_id, v)""")
        if n < rounds:
            steps.append(f"""m{n} AS (SELECT dj % 1000 AS j, p, CAST(sum(CAST(x AS BIGINT)) AS BIGINT) AS s, count(*) AS n FROM (SELECT dj, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM a{n}) GROUP BY ALL)""")
            steps.append(f"""c{n + 1} AS MATERIALIZED (SELECT c{n}.j, coalesce(m.c, c{n}.c) AS c FROM c{n} LEFT JOIN (
SELECT j, list(CAST((s - (s % n + n) % n) // n AS DOUBLE) ORDER BY p) AS c FROM m{n} GROUP BY j) m ON c{n}.j = m.j)""")
    final = f"a{rounds}"
    return f"""WITH {", ".join(steps)}
SELECT vec_id, CAST(dj % 1000 AS INT) AS cluster, CAST(dj // 1000 AS BIGINT) AS distance, CAST(sum(dj // 1000) OVER (PARTITION BY dj % 1000) AS BIGINT) AS cluster_inertia,
       CAST(sum(dj // 1000) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM {final} JOIN c{rounds} ON j = dj % 1000"""


ORACLE_SQL["op12_heap_clusters"] = _clusters_sql()
