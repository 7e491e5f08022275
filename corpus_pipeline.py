"""Corpus pipeline: toxicity filter, near-duplicate removal, benchmark decontamination, secret redaction, piece encoding.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before kept. All but the last return the columns of
documents; the last returns (doc_id, ids, n_tokens, round_trip). Nulls and empty texts pass all filters; of documents that are
all empty one stays, since they are copies of one another.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, nearcopies, pieces, secrets, toxicity
from tessera.llm.shared import materialise


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the toxicity classifier does not reject; it learns from the labelled rows of docs."""
    return toxicity.reject(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group of near copies (five-word Jaccard of 0.8 or more), that of the smallest doc_id, then fingerprint and text; rows without an id stay."""
    found = nearcopies.groups(docs).withColumnRenamed("node", "_node").withColumnRenamed("component", "_component")
    rest = [F.col(c) for c in docs.columns if c not in ("doc_id", "text")]
    rows = docs.filter("doc_id is not null").select(F.struct("doc_id", F.expr(nearcopies.NODE).alias("_node"), "text", *rest).alias("_row"))
    of = rows.join(found, F.col("_row._node") == F.col("_node"), "left")
    kept = of.groupBy(F.coalesce("_component", "_row._node").alias("_group")).agg(F.min("_row").alias("_row")).select("_row.*")
    return kept.select(docs.columns).unionByName(docs.filter("doc_id is null"))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that overlap no benchmark item."""
    return decontaminate.remove(docs, _table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents, secrets replaced by a mark."""
    return secrets.redact(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document's pieces."""
    return pieces.encode(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("secrets", redact_secrets),
    ("pieces", encode_pieces),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written to the shared folder and read again."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
