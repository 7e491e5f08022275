"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Index: each vector less the centre is zero-padded to ``spread`` times its length, rotated by a fixed random rotation and kept as
the signs of its components, packed in 64-bit words, with two correction scalars: its norm, and the inner product of its unit
vector with its code. Search: the rotated query is rounded to four bits a component, kept as four packed planes; the product of
a code and the query is then the population counts of code and plane, and over the second scalar it estimates the inner product.
Its error is within ``bound`` standard deviations of a known size, that of the rounding included. In each block a query's ``4 k``
best guesses are scored exactly first, in double precision; from then on a vector is reranked if its upper bound reaches the
query's ``k``-th best exact score so far. ``bound=inf`` reranks all rows, which is the exact answer.

The centre is the mean of at most ``SAMPLE`` vectors, chosen by the hash of their id. Every vector is indexed. Rows are dealt in
turn into blocks and queries into groups, of ``CELL`` components each; all pairs of block and group are the groups of one
cogrouped plan, so that the plan, what a task holds and what the driver sees stay alike at any size. Each pair keeps k a query.

Nulls: vectors that are null, zero, or hold null or non-finite components, and rows with a null id, take no part. Vectors of
different lengths are searched apart, each among its own. Repeated ids are candidates of their own, but never their own
neighbours; a repeated query id asks once, by the least of its vectors. Ties go to the smaller id. Further columns are ignored.
Empty tables give no rows.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialise

SAMPLE = 10_000
CELL = 1 << 18  # components of a block of rows, and of a group of queries
BESIDE, STRIDE = 64, 4096  # queries and rows that are estimated at once
FIRST = 4  # times k best guesses are scored before there is a floor
PLANES = 4  # bits of a query's component


@lru_cache(maxsize=2)
def rotation(n: int, seed: int = 7) -> np.ndarray:
    """A fixed random rotation of n dimensions."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, n)))
    return q * np.sign(np.diag(r))


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("vec_id").isNotNull() & v.isNotNull() & finite & F.exists(v, lambda x: x != 0))


def _centres(rows: DataFrame) -> dict[int, np.ndarray]:
    """The mean vector by length, of at most SAMPLE vectors in all."""
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select(F.size("v").alias("n"), F.posexplode("v"))
    out: dict[int, np.ndarray] = {}
    for r in picked.groupBy("n", "pos").agg(F.avg("col").alias("m")).collect():
        out.setdefault(r.n, np.zeros(r.n))[r.pos] = r.m
    return out


def _spread(n: int) -> int:
    """Code bits a component: enough that a code has 256 at least, in whole words."""
    spread = max(1, -(-256 // max(1, n)))
    while n * spread % 64:
        spread += 1
    return spread


def _turned(x: np.ndarray, spread: int) -> np.ndarray:
    n = x.shape[1]
    return x @ rotation(n * spread)[:n]


def encoded(x: np.ndarray, spread: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed codes (bytes), norms and fits of vectors less the centre."""
    norm = np.linalg.norm(x, axis=1)
    u = _turned(x, spread) / np.where(norm > 0, norm, 1)[:, None]
    fit = np.abs(u).sum(1) / np.sqrt(u.shape[1])
    return np.packbits(u >= 0, axis=1), norm, np.where(fit > 0, fit, 1.0)


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, dict[int, np.ndarray]]:
    """(vec_id, v, n, place, code, norm, fit) of every usable row, written to the shared folder, and the centres.

    place: a row's turn in its task, from a start that differs by task; blocks and groups are dealt by it.
    """
    rows = usable(vectors, id_col, vector_col)
    centres = _centres(rows)

    def run(batches):
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId() * 7919
        for b in batches:
            size = np.diff(b.column(1).offsets.to_numpy()) if b.num_rows else np.empty(0, np.int64)
            for n in np.unique(size).tolist():
                own = b.filter(pa.array(size == n))
                for at in range(0, own.num_rows, 4096):
                    part = own.slice(at, 4096)
                    x = np.array(part.column(1).flatten()).reshape(part.num_rows, -1)
                    codes, norm, fit = encoded(x - centres.get(n, 0.0), _spread(n))
                    k = part.num_rows
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(1), pa.array(np.full(k, n), pa.int32()), pa.array(np.arange(turn, turn + k), pa.int64()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(norm), pa.array(fit)],
                        ["vec_id", "v", "n", "place", "code", "norm", "fit"],
                    )
                    turn += k

    return materialise(rows.mapInArrow(run, "vec_id long, v array<double>, n int, place long, code binary, norm double, fit double"), "codes"), centres


def exact(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each row summed alike, so that equal vectors score alike."""
    return (v * q).sum(axis=1)


class Planes:
    """Queries rounded to PLANES bits a component, packed by bit: count() is their product with codes, by population counts."""

    def __init__(self, q: np.ndarray, spread: int):
        turned = _turned(q, spread)
        self.bits = turned.shape[1]
        self.low = turned.min(1)
        top = (1 << PLANES) - 1
        self.step = np.maximum((turned.max(1) - self.low) / top, 1e-300)
        level = np.clip(np.rint((turned - self.low[:, None]) / self.step[:, None]), 0, top).astype(np.uint8)
        self.words = np.stack([np.packbits(level >> k & 1, axis=1).view(np.uint64) for k in range(PLANES)], 1)
        self.total = self.low * self.bits + self.step * level.sum(1)
        self.slack = self.step * np.sqrt(self.bits / 12)  # of the rounding, a standard deviation

    def products(self, codes: np.ndarray, a: int, b: int) -> np.ndarray:
        """Sums of the components of queries a to b, with the signs of the codes (rows of 64-bit words): (queries, codes)."""
        out = np.zeros((b - a, len(codes)), np.uint32)
        for k in range(PLANES):
            count = np.zeros((b - a, len(codes)), np.uint16)
            for w in range(codes.shape[1]):
                count += np.bitwise_count(codes[:, w] & self.words[a:b, k, w, None])
            out += count.astype(np.uint32) << np.uint32(k)
        ones = np.bitwise_count(codes).sum(1, dtype=np.float64)
        return 2 * (self.low[a:b, None] * ones + self.step[a:b, None] * out) - self.total[a:b, None]


class _Best:
    """The k best (score, id) of each query so far."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = [np.empty(0)] * n
        self.id = [np.empty(0, np.int64)] * n
        self.floor = np.full(n, -np.inf)

    def add(self, q: int, score: np.ndarray, ids: np.ndarray) -> None:
        score, ids = np.concatenate([self.score[q], score]), np.concatenate([self.id[q], ids])
        order = np.lexsort((ids, -score))[: self.k]
        self.score[q], self.id[q] = score[order], ids[order]
        if len(order) == self.k:
            self.floor[q] = score[order[-1]]


def _meet(rows: pa.Table, asked: pa.Table, centre: np.ndarray | float, n: int, k: int, bound: float) -> pa.Table:
    """The k best of a block of index rows for each query of a group."""
    spread = _spread(n)
    flat = lambda x: np.array(x.combine_chunks().flatten()).reshape(-1, n)
    ids, v, qid, q = rows.column("vec_id").to_numpy(), flat(rows.column("v")), asked.column("query_id").to_numpy(), flat(asked.column("q"))
    codes = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint64).reshape(len(ids), -1)
    norm, fit = rows.column("norm").to_numpy(), rows.column("fit").to_numpy()
    planes = Planes(q, spread)
    size, at_centre = np.linalg.norm(q, axis=1), (q * centre).sum(1)
    scale = norm / fit / np.sqrt(planes.bits)
    spare = np.sqrt(np.maximum(0, 1 - fit**2) / max(1, planes.bits - 1)) * norm / fit
    best, counts = _Best(len(qid), k), np.zeros(len(qid), np.int64)

    def rescore(i: int, pick: np.ndarray) -> None:
        pick = pick[ids[pick] != qid[i]]
        counts[i] += len(pick)
        best.add(i, exact(v[pick], q[i]), ids[pick])

    for at in range(0, len(ids), STRIDE):
        here = slice(at, at + STRIDE)
        for a in range(0, len(qid), BESIDE):
            b = min(a + BESIDE, len(qid))
            guess = planes.products(codes[here], a, b) * scale[here] + at_centre[a:b, None]
            err = np.hypot(size[a:b, None] * spare[here], planes.slack[a:b, None] * scale[here])
            high = guess + (bound * err if np.isfinite(bound) else np.inf) + 1e-9 * (np.abs(guess) + size[a:b, None] * norm[here])
            for i in np.flatnonzero(np.isneginf(best.floor[a:b])):
                # the best guesses come first: from then on an exact score is the floor
                m = high.shape[1]
                pick = np.argpartition(-guess[i], FIRST * k)[: FIRST * k + 1] if m > FIRST * k + 1 else np.arange(m)
                high[i, pick] = -np.inf
                rescore(a + i, at + pick)
            r, c = np.nonzero((high >= best.floor[a:b, None]) & (high > -np.inf))
            ends = np.searchsorted(r, np.arange(b - a + 1))
            for i in np.flatnonzero(np.diff(ends)):
                rescore(a + i, at + c[ends[i] : ends[i + 1]])
    took = [len(x) for x in best.id]
    return pa.table({"query_id": pa.array(np.repeat(qid, took)), "vec_id": pa.array(np.concatenate([*best.id, np.empty(0, np.int64)])), "score": pa.array(np.concatenate([*best.score, np.empty(0)])), "reranked": pa.array(np.repeat(counts, took))})


def search(index: DataFrame, centres: dict[int, np.ndarray], queries: DataFrame, k: int = 20, bound: float = 3.0, cell: int = CELL) -> DataFrame:
    """(query_id, rank, vec_id, score, reranked) of the k nearest of each query (columns vec_id, v, place), its own id apart.

    reranked: how many vectors of its block were scored exactly for the query that found the neighbour.
    """
    spark = index.sparkSession
    sizes = index.groupBy("n").count().join(queries.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("asked")), "n").collect()
    cells = [(r.n, -(-r["count"] * r.n // cell), -(-r.asked * r.n // cell)) for r in sizes]  # a row a length of vectors
    dealt = F.broadcast(spark.createDataFrame(cells, "n int, blocks long, groups long"))
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c).cast("int") - 1))
    rows = index.join(dealt, "n").select("n", F.pmod("place", "blocks").cast("int").alias("b"), every("groups").alias("g"), "vec_id", "v", "code", "norm", "fit")
    named = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"), F.col("place").alias("turn"), F.size("v").alias("n"))
    asked = named.join(dealt, "n").select(F.col("n").alias("qn"), every("blocks").alias("qb"), F.pmod("turn", "groups").cast("int").alias("qg"), "query_id", "q")

    def run(key, left, right):
        n = key[0].as_py()
        if not left.num_rows or not right.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64()), "reranked": pa.array([], pa.int64())})
        return _meet(left, right, centres.get(n, 0.0), n, k, bound)

    out = rows.groupBy("n", "b", "g").cogroup(asked.groupBy("qn", "qb", "qg")).applyInArrow(run, "query_id long, vec_id long, score double, reranked long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return out.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", "reranked")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", bound: float = 3.0) -> DataFrame:
    """The k nearest of each row whose id is divisible by ``every``, among all other rows."""
    index, centres = build_index(vectors, id_col, vector_col)
    queries = index.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min(F.struct("v", "place")).alias("x")).select("vec_id", "x.v", "x.place")
    return search(index, centres, queries, k, bound)
