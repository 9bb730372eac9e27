"""Corpus pipeline over ``documents``: quality, exact copies, near copies, mix, token ids.

Each stage gets what its predecessor wrote as Parquet and returns the columns of
``documents``; the last returns each document's token ids.  Columns that a stage adds
take names that the table does not have; what the last one returns beside the table's own
columns keeps its name, and a column of the table called so gets underscores appended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contrail.llm import byte_bpe, exact_dedup, mixing, quality, simhash
from contrail.llm.catalog import QUALITY_THRESHOLD, vocabulary
from contrail.llm.common import column, documents
from contrail.session import scratch_path


RESULT = ("n_tokens", "ids", "ids_sha256", "decoded_sha256")


def free_name(wanted: str, taken: list[str]) -> str:
    """``wanted`` with underscores appended until no name of ``taken`` equals it."""
    names = {c.lower() for c in taken}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = free_name("score", docs.columns)
    scored = quality.score(docs, model, out=out)
    return scored.where(F.col(out) >= QUALITY_THRESHOLD).drop(out)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id."""
    return exact_dedup.drop_duplicates(docs, largest=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest id."""
    return simhash.drop_near_duplicates(docs, words=3, distance=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix takes them."""
    return mixing.mixture(docs)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them."""
    ranks = vocabulary("byte_bpe_50k.tiktoken")
    kept = []
    for c in docs.columns:
        clash = c.lower() in (*RESULT, "decoded")
        kept.append((c, free_name(c + "_", docs.columns + [k for _, k in kept]) if clash else c))
    renamed = docs.select(*[column(a).alias(b) for a, b in kept])
    coded = byte_bpe.decode(byte_bpe.encode(renamed, ranks).drop("text"), ranks)
    return coded.select(
        *[column(b) for _, b in kept if b != "text"],
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix_sources),
    ("byte-level BPE", encode_tokens),
]

#: SQL has no expression for the classifier, SimHash or BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the cluster's shared folder and read again."""
    docs = documents(spark, sf_dir)
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
