"""Model stages: any client behind one protocol, run in batches, results kept by prompt so that a rerun asks nothing twice.

A client is made once a partition. Replies are written to a table keyed by the prompt's SHA-256; only prompts that the table lacks
are sent, so retried tasks, reruns and repeated prompts cost no call. StubClient answers from the prompt alone, for tests.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T


class ModelClient(Protocol):
    def complete(self, prompts: list[str]) -> list[str | None]:
        """A reply for each prompt, None where it failed."""

    def score(self, pairs: list[tuple[str, str]]) -> list[float | None]:
        """A raw score for each pair."""


class StubClient:
    """Replies and scores that depend on the text alone; no measure of any model."""

    def complete(self, prompts: list[str]) -> list[str | None]:
        return [f"reply to {len(p)} characters?" for p in prompts]

    def score(self, pairs: list[tuple[str, str]]) -> list[float | None]:
        out = []
        for a, b in pairs:
            x, y = set(a.lower().split()), set(b.lower().split())
            out.append(6.0 * len(x & y) / max(1, len(x)) - 3.0)
        return out


def complete(rows: DataFrame, prompt: Column, make: Callable[[], ModelClient] = StubClient, store: str | None = None, batch: int = 64) -> DataFrame:
    """rows with ``reply``. store: the folder of the table of replies that runs share; without it, replies last for the query."""
    spark = rows.sparkSession
    asked = rows.withColumn("_prompt", prompt).withColumn("_key", F.sha2("_prompt", 256))
    wanted = asked.select("_key", "_prompt").dropDuplicates(["_key"]).filter("_prompt is not null")
    known = None
    if store:
        try:
            known = spark.read.schema("_key string, reply string").parquet(store)
            wanted = wanted.join(known.select("_key"), "_key", "left_anti")
        except Exception as e:  # the first run has no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise

    def run(batches):
        client = make()
        for b in batches:
            for at in range(0, len(b), batch):
                part = b.iloc[at : at + batch]
                yield pd.DataFrame({"_key": part["_key"].to_numpy(), "reply": client.complete(part["_prompt"].tolist())})

    fresh = wanted.mapInPandas(run, "_key string, reply string")
    if store:
        fresh.filter("reply is not null").write.mode("append").parquet(store)
        fresh = spark.read.schema("_key string, reply string").parquet(store).dropDuplicates(["_key"])
    return asked.join(fresh, "_key", "left").drop("_key", "_prompt")


def fit_scores(question: Column, answer: Column, make: Callable[[], ModelClient] = StubClient) -> Column:
    """Scores of question and answer between 0 and 1, rounded to three places; null where the client has none."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        client = make()
        for q, a in batches:
            yield pd.Series(client.score(list(zip(q.fillna(""), a.fillna("")))), dtype="float64")

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.bround(T.sigmoid(F.pandas_udf(run, "double")(question, answer)), 3)


def audit(sample: DataFrame, verdict: Column, least: float = 0.95) -> DataFrame:
    """(evaluated, passed, rate): the rate is over rows with a verdict, 1 if there are none; fails the query below ``least``."""
    row = sample.agg(F.count(verdict).alias("evaluated"), F.count_if(F.coalesce(verdict, F.lit(False))).alias("passed"))
    rate = F.when(F.col("evaluated") > 0, F.col("passed") / F.col("evaluated")).otherwise(1.0)
    said = F.concat(F.lit("audit pass rate "), rate.cast("string"), F.lit(f" is below {least}"))
    return row.select("evaluated", "passed", F.when(rate >= least, rate).otherwise(F.raise_error(said).cast("double")).alias("rate"))


def match_answer(source: Column, answer: Column, least: float = 0.9) -> Column:
    """Whether an answer is grounded: its normalised text is in the source's, or the two are alike; similarity runs on the rest only."""
    from tessera.operators.quality import ratio

    a, s = T.loose_norm(answer), T.loose_norm(source)
    near = F.when((a != "") & ~F.contains(s, a) & (2 * F.least(F.length(a), F.length(s)) >= least * (F.length(a) + F.length(s))), F.struct(s, a))
    return (a != "") & (F.contains(s, a) | F.when(near.isNotNull(), ratio(s, a) >= least).otherwise(False))
