"""One query per operator, with production parameters, over whole ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import (
    alignment, byte_bpe, exact_dedup, imatch, line_dedup, mixing, orchard, pii, quality, simhash,
    token_counts, token_files, topk,
)
from contrail.llm.common import documents
from contrail.session import scratch_path


#: Documents that score less are rejected.
QUALITY_THRESHOLD = 0.7


def vocabulary(name: str) -> str:
    """A file of the installed public vocabularies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), words=3, distance=3)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_shards(documents(spark, sf_dir), path, vocabulary("word_bpe_49k.json"))
    return token_files.read_documents(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("tokens").alias("ids_crc32"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("source")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.find(docs, pii.fit(docs)).drop("text_sha256")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", F.size("deleted").cast("long").alias("n_deleted"),
        F.array_join("deleted", ",").alias("deleted"), F.sha2("text", 256).alias("cleaned_sha256"))


def op8_every_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_every_repeat(documents(spark, sf_dir)).select(
        "doc_id", "n_lines", F.size("deleted").cast("long").alias("n_deleted"),
        F.array_join("deleted", ",").alias("deleted"), F.sha2("text", 256).alias("cleaned_sha256"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(documents(spark, sf_dir), largest=True)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op5_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprint_edits(documents(spark, sf_dir))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    docs = documents(spark, sf_dir).select("doc_id", "text")
    ids = byte_bpe.encode(docs, ranks, chunks_col="n_chunks").drop("text")
    return byte_bpe.decode(ids, ranks).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "n_chunks")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def op11_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(embeddings(spark, sf_dir), k=10, scale=1024, every=100)


def op12_orchard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.cluster(embeddings(spark, sf_dir), k=40, rounds=5, scale=256, size=64, seed=2).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        orchard.digest().alias("centroid_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.score_links(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"),
                                 vocabulary("piece_bpe_32k.model"))


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_token_files": op2_token_files,
    "op4_quality": op4_quality,
    "op5_imatch": op5_imatch,
    "op6_byte_bpe": op6_byte_bpe,
    "op10_token_counts": op10_token_counts,
    "op3_mix_sources": op3_mix_sources,
    "op7_pii": op7_pii,
    "op8_line_dedup": op8_line_dedup,
    "op8_every_line": op8_every_line,
    "op9_exact_dedup": op9_exact_dedup,
    "op11_topk": op11_topk,
    "op12_orchard": op12_orchard,
    "op13_alignment": op13_alignment,
}


def _clusters_sql(k: int = 40, rounds: int = 5, scale: int = 256, size: int = 64, seed: int = 2) -> str:
    """Rounds of assignment and means, each a pair of tables."""
    steps = [f"""
        kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                   list_transform(embedding, lambda x: cast(floor({scale} * cast(x AS double)) AS bigint)) AS v
            FROM embeddings
            WHERE len(embedding) = {size}
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
        parts AS MATERIALIZED (SELECT r, generate_subscripts(v, 1) AS j, unnest(v) AS x FROM kept),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
            FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM kept ORDER BY h NULLS LAST, v LIMIT {k}))"""]
    for i in range(rounds + 1):
        steps.append(f"""
        p{i} AS MATERIALIZED (SELECT c, generate_subscripts(v, 1) AS j, unnest(v) AS x FROM c{i}),
        a{i} AS MATERIALIZED (
            SELECT r, c, d FROM (
                SELECT a.r, b.c, sum((a.x - b.x) * (a.x - b.x)) AS d
                FROM parts a JOIN p{i} b USING (j) GROUP BY ALL)
            QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)""")
        if i < rounds:
            steps.append(f"""
        m{i} AS MATERIALIZED (
            SELECT c, list(x ORDER BY j) AS v FROM (
                SELECT c, j, cast(sum(x) AS bigint) AS s, count(*) AS n,
                       (s - ((s % n) + n) % n) // n AS x
                FROM a{i} JOIN parts USING (r) GROUP BY c, j)
            GROUP BY c),
        c{i + 1} AS MATERIALIZED (
            SELECT c{i}.c, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (c))""")
    return f"""
        WITH {",".join(steps)}
        SELECT vec_id, cast(a.c AS int) AS cluster, cast(d AS bigint) AS distance,
               cast(sum(d) OVER (PARTITION BY a.c) AS bigint) AS cluster_inertia,
               cast(sum(d) OVER () AS bigint) AS inertia,
               sha256(array_to_string(f.v, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN kept USING (r) JOIN c{rounds} f ON f.c = a.c
    """

SQL = {
    "op11_topk": """
        WITH kept AS (
            SELECT DISTINCT vec_id,
                   list_transform(embedding, lambda x: cast(floor(1024 * cast(x AS double)) AS bigint)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
        scored AS (
            SELECT q.vec_id AS query_id, q.v AS q, c.vec_id,
                   cast(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) AS bigint) AS score
            FROM kept q JOIN kept c ON len(q.v) = len(c.v) AND (q.vec_id IS DISTINCT FROM c.vec_id OR q.v <> c.v)
            WHERE q.vec_id % 100 = 0)
        SELECT query_id, cast(row_number() OVER (PARTITION BY query_id, q ORDER BY score DESC, vec_id) AS int) AS rank,
               vec_id, score
        FROM scored
        QUALIFY rank <= 10
    """,
    "op12_orchard": _clusters_sql(),
    "op8_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, line, n - 1 AS n, string_split(coalesce(text, ''), chr(10)) AS every
            FROM documents, unnest(string_split(coalesce(text, ''), chr(10))) WITH ORDINALITY AS l(line, n)),
        marked AS (
            SELECT *, len(regexp_extract_all(line, '[^ \\t-\\r]+')) AS words FROM lines),
        units AS (
            SELECT doc_id, n, line || chr(10) || j AS u,
                   row_number() OVER (PARTITION BY doc_id ORDER BY n, j) AS i
            FROM marked, unnest(range(1, 1 + cast(ceil(words / {line_dedup.UNIT}) AS int))) AS r(j)
            WHERE words > 0),
        windows AS (
            SELECT doc_id, i, u || chr(10) || lead(u, 1) OVER o || chr(10) || lead(u, 2) OVER o AS g
            FROM units WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        firsts AS (
            SELECT doc_id, i, first_value(doc_id) OVER e AS first_id, first_value(i) OVER e AS first_i
            FROM windows WHERE g IS NOT NULL WINDOW e AS (PARTITION BY g ORDER BY doc_id, i)),
        later AS (
            SELECT doc_id, i FROM firsts
            WHERE first_id <> doc_id OR i - first_i >= {line_dedup.WINDOW}),
        gone AS (
            SELECT DISTINCT doc_id, n FROM units SEMI JOIN (
                SELECT doc_id, i + k AS i FROM later, unnest(range({line_dedup.WINDOW})) AS r(k)) USING (doc_id, i))
        SELECT doc_id, count(*) AS n_lines, count(g.n) AS n_deleted,
               coalesce(string_agg(cast(g.n AS varchar), ',' ORDER BY g.n) FILTER (g.n IS NOT NULL), '') AS deleted,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY l.n) FILTER (g.n IS NULL), '')) AS cleaned_sha256
        FROM lines l LEFT JOIN gone g USING (doc_id, n)
        GROUP BY doc_id
    """,
    "op8_every_line": """
        WITH lines AS (
            SELECT doc_id, line, n - 1 AS n
            FROM documents, unnest(string_split(coalesce(text, ''), chr(10))) WITH ORDINALITY AS l(line, n)),
        marked AS (
            SELECT *, regexp_matches(line, '[^ \\t-\\r]')
                      AND row_number() OVER (PARTITION BY line ORDER BY doc_id, n) > 1 AS gone
            FROM lines)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_deleted,
               coalesce(string_agg(cast(n AS varchar), ',' ORDER BY n) FILTER (gone), '') AS deleted,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS cleaned_sha256
        FROM marked
        GROUP BY doc_id
    """,
    "op9_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
}
