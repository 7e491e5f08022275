"""Helpers that the training-data operators share: sampling, calibration, components; tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.sources.shared import discard, materialise, shared_dir

__all__ = ["calibration", "connected_components", "discard", "fit_logistic", "held_out", "materialise", "shared_dir", "train_rows"]


def train_rows(docs: DataFrame, labels: DataFrame, label_col: str, mod: int, held: int, holds: bool, bound: int) -> DataFrame:
    """(label, text) of labelled rows that a model may learn from, ``bound`` ids a class at most.

    A row is open to learning if crc32(doc_id as text) mod ``mod`` equals ``held`` exactly when ``holds`` is True. Ids are
    chosen by their hash, so the set of at most twice ``bound`` ids is small enough to broadcast, and texts are read in place,
    not shuffled. Of equal texts in a class one row stays. Labels other than 0 and 1, null texts and null ids are left out.
    """
    rest = F.crc32(F.col("doc_id").cast("string")) % F.lit(mod)
    open_ids = (
        labels.select("doc_id", F.col(label_col).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1))
        .filter(rest == held if holds else rest != held)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = [open_ids.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound) for k in (0, 1)]
    rows = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(chosen[0].union(chosen[1])), "doc_id")
    return rows.groupBy("label", F.xxhash64("text").alias("h")).agg(F.first("text").alias("text")).select("label", "text")


def held_out(id_col: Column, mod: int, held: int) -> Column:
    """True if crc32(id as text) mod ``mod`` is ``held``; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string")) % F.lit(mod) == held, F.lit(False))


def fit_logistic(x, y, l2: float = 1e-3, steps: int = 60, balanced: bool = True):
    """Weights (bias last) of an L2-penalised logistic regression by Newton's method; balanced: classes weigh alike."""
    import numpy as np

    x = np.column_stack([np.asarray(x, float), np.ones(len(x))])
    y = np.asarray(y, float)
    w = np.zeros(x.shape[1])
    if not len(y) or y.min() == y.max():
        return w
    weight = np.where(y > 0, 0.5 / y.mean(), 0.5 / (1 - y.mean())) if balanced else np.ones(len(y))
    pen = l2 * len(y) * np.eye(len(w))
    pen[-1, -1] = 1e-9 * len(y)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + pen @ w
        hess = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + pen
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def calibration(scores, y, bins: int = 10) -> tuple[float, float, list[tuple[int, float, float]]]:
    """Brier score, expected calibration error, and (rows, mean score, share of ones) of each bin of scores that holds any."""
    import numpy as np

    scores, y = np.asarray(scores, float), np.asarray(y, float)
    place = np.minimum((scores * bins).astype(int), bins - 1)
    table = [(int((place == k).sum()), float(scores[place == k].mean()), float(y[place == k].mean())) for k in range(bins) if (place == k).any()]
    return float(((scores - y) ** 2).mean()), sum(n * abs(p - t) for n, p, t in table) / len(y), table


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(node, component) of the nodes that edges name; component is the smallest node reachable.

    Alternating large-star and small-star rounds, each written to the shared folder. A hub's rows meet in
    an equi-join with one row a key, which adaptive execution can split. Null ends and self loops are ignored.
    """
    e = edges.filter(F.col(src).isNotNull() & F.col(dst).isNotNull()).select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
    e = materialise(e.filter("u <> v").distinct(), "edges")

    def mark(t: DataFrame):
        return tuple(t.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    seen = mark(e)
    while seen[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        after = materialise(small.select("x.u", "x.v").filter("u <> v").distinct(), "edges")
        now = mark(after)
        discard(e)
        e = after
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v"), F.col("v")).distinct())
