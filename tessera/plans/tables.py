"""Tables that the queries share, and the same tables in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import segments as S

#: SQL of a time as minutes and seconds.
CLOCK = "CASE WHEN isnan({x}) OR {x} < 0 THEN '?:??' ELSE lpad((floor({x})::BIGINT // 60)::VARCHAR, greatest(2, length((floor({x})::BIGINT // 60)::VARCHAR))::INTEGER, '0') || ':' || lpad((floor({x})::BIGINT % 60)::VARCHAR, 2, '0') END"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def registrar() -> tuple[dict, dict, Callable]:
    """Empty query and SQL tables and a decorator that adds a function and its SQL to them."""
    queries: dict[str, Callable] = {}
    oracles: dict[str, str] = {}

    def register(sql: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if sql:
                oracles[f.__name__] = sql
            return f

        return add

    return queries, oracles, register


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as timed segments."""
    return S.from_conversations(table(spark, sf_dir, "conversations"))


SEGMENTS_SQL = """seg AS (
  SELECT conv_id AS episode_id, turn AS seq, e - dur AS "start", e AS "end", role AS speaker, text FROM (
    SELECT conv_id, turn, role, text, length(text) / 16.0::DOUBLE AS dur,
      sum(length(text) / 16.0::DOUBLE + ((conv_id * 7 + turn * 13) % 5) * 0.5::DOUBLE) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS e
    FROM conversations))"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Assistant turns as answers, the turn before as context, a question made of it; scores and flags from the ids."""
    from pyspark.sql import Window

    w = Window.partitionBy("episode_id").orderBy("seq")
    rows = segments(spark, sf_dir).withColumn("context", F.lag("text").over(w)).filter("speaker = 'assistant' and context is not null")
    question = F.concat(F.when((F.col("episode_id") + F.col("seq")) % 5 == 0, F.lit("What ")).otherwise(""), F.regexp_replace("context", r"\.$", "?"))
    return rows.select(
        F.concat_ws("-", F.col("episode_id").cast("string"), F.col("seq").cast("string")).alias("pair_id"), "episode_id", "seq", "start", "end", "speaker", "context",
        F.when((F.col("episode_id") + F.col("seq")) % 3 == 0, question).otherwise(F.col("context")).alias("question"), F.col("text").alias("answer"), (((F.col("episode_id") * 37 + F.col("seq") * 11) % 100) / 100.0).alias("score"),
    )


PAIRS_SQL = (
    SEGMENTS_SQL
    + """,
pairs AS (
  SELECT episode_id || '-' || seq AS pair_id, episode_id, seq, "start", "end", speaker, context,
    CASE WHEN (episode_id + seq) % 3 = 0 THEN CASE WHEN (episode_id + seq) % 5 = 0 THEN 'What ' ELSE '' END || regexp_replace(context, '\\.$', '?') ELSE context END AS question,
    text AS answer, ((episode_id * 37 + seq * 11) % 100) / 100.0::DOUBLE AS score
  FROM (SELECT *, lag(text) OVER (PARTITION BY episode_id ORDER BY seq) AS context FROM seg) WHERE speaker = 'assistant' AND context IS NOT NULL)"""
)
