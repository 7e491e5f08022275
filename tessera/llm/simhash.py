"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. At two differing bits at most, one segment has none
(pigeonhole), and the segment after it has two at most. The binary Golay code (23, 12, 7) is perfect: every 23-bit word is
within three bits of just one codeword. A segment's keys are the indices of the codewords to which the segment itself and
its one-bit neighbours decode (one to six of them); two segments that differ in two bits or fewer have a neighbour in
common, thus an index. So (position, exact segment, Golay index of the next segment) is a join key that loses no link.
Candidates are verified by their differing bits. Buckets of more than ``bucket`` fingerprints are linked through the
one-bit neighbours of their members instead (two fingerprints at two bits or fewer share one), so no bucket emits all pairs.

For pairs many bits apart, ``soft_keys`` takes two Golay indices a key from votes whose strengths count, see nearcopies.

Nulls: a null text counts as empty; no word gives fingerprint zero, linked like any other. Rows with a null id keep a row;
they belong to their group but never name it. Repeated rows each keep a row. Further columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import connected_components, discard, materialise

#: Fixed value: generator polynomial of the Golay code, x^11+x^10+x^6+x^5+x^4+x^2+1.
GOLAY_POLY = 0b110001110101
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # shift, bits
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
VOTE_STEP = 1 << 18  # shingles voted at once, so that a very long text needs no more memory


def fingerprint(text: str | None, words: int = 3) -> int:
    """Unsigned SimHash of the whole text: the majority of the bits of its shingles' hashes, repeats included."""
    w = (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not w:
        return 0
    n = max(1, len(w) - words + 1)
    votes = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, n, VOTE_STEP):
        raw = b"".join([digest(b" ".join(w[i : i + words]), 42) for i in range(at, min(n, at + VOTE_STEP))])
        votes += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(votes * 2 > n).view(">u8")[0])


def _syndrome(v: np.ndarray) -> np.ndarray:
    for k in range(11, -1, -1):
        v = np.where(v >> (11 + k) & 1, v ^ (GOLAY_POLY << k), v)
    return v


@lru_cache
def _leaders() -> np.ndarray:
    """The error pattern of three bits or fewer for each of the 2048 syndromes."""
    errors = np.array([sum(1 << b for b in c) for k in range(4) for c in combinations(range(23), k)], np.int64)
    out = np.zeros(2048, np.int64)
    out[_syndrome(errors)] = errors
    return out


def golay_index(v: np.ndarray) -> np.ndarray:
    """12-bit index of the codeword nearest to each 23-bit word."""
    return (v ^ _leaders()[_syndrome(v)]) >> 11


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For unsigned fingerprints: the rows and the keys (position, exact segment, index of the next segment)."""
    seg = [((fp >> np.uint64(s)) & np.uint64((1 << n) - 1)).astype(np.int64) for s, n in SEGMENTS]
    rows, keys = [], []
    for s in range(3):
        nxt = (s + 1) % 3
        flips = np.array([0] + [1 << b for b in range(SEGMENTS[nxt][1])], np.int64)
        index = np.sort(golay_index(seg[nxt][:, None] ^ flips[None, :]), axis=1)
        fresh = np.ones_like(index, bool)
        fresh[:, 1:] = index[:, 1:] != index[:, :-1]
        r, c = np.nonzero(fresh)
        rows.append(r)
        keys.append((np.int64(s) << 40) | (seg[s][r] << 12) | index[r, c])
    return np.concatenate(rows), np.concatenate(keys)


@lru_cache
def _codeword_signs() -> np.ndarray:
    """24 x 2048: the codewords of the code extended by a parity bit, as signs; one of each two complements."""
    v = np.arange(4096) << 11
    bits = (v ^ _syndrome(v))[:, None] >> np.arange(23) & 1
    bits = np.column_stack([bits, bits.sum(1) & 1])
    return np.ascontiguousarray(1 - 2 * bits[bits[:, 0] == 0].T, np.float32)


def soft_golay_index(votes: np.ndarray) -> np.ndarray:
    """12-bit index of the extended codeword nearest to each row of 24 votes; a weak vote is overruled before a strong one."""
    out = np.empty(len(votes), np.int64)
    for at in range(0, len(votes), 512):
        d = votes[at : at + 512] @ _codeword_signs()
        k = np.abs(d).argmax(1)
        out[at : at + 512] = k * 2 + (d[np.arange(len(d)), k] < 0)
    return out


def vote_rows(rows: int, bits: int) -> np.ndarray:
    """The votes that shingles cast: rounded normal deviates, whole numbers so that sums are exact in any order."""
    table = np.random.default_rng(42).standard_normal((rows, bits), np.float32)
    table *= 32
    return np.rint(table, out=table)


def cast_votes(hashes: np.ndarray, rows: int) -> np.ndarray:
    """How often each of the ``rows`` (a power of two) of a vote table counts for a set of 64-bit shingle hashes: a shingle takes a row or its negative."""
    place = (hashes >> np.uint64(65 - rows.bit_length())).astype(np.int64)
    sign = 1.0 - 2.0 * (hashes >> np.uint64(64 - rows.bit_length()) & np.uint64(1))
    return np.bincount(place, sign, rows).astype(np.float32)


def soft_keys(votes: np.ndarray) -> np.ndarray:
    """(texts, tables) keys of (texts, 48 * tables) summed votes, 256 tables at most: table, then the indices of two segments of 24."""
    index = soft_golay_index(votes.reshape(-1, 24)).reshape(len(votes), -1, 2)
    table = np.arange(index.shape[1], dtype=np.int64)
    return (table << 24 | index[:, :, 0] << 12 | index[:, :, 1]).astype(np.uint32).view(np.int32)


def sign_bits(votes: np.ndarray) -> np.ndarray:
    """(texts, bits / 64) signed longs: the fingerprint, one bit a vote."""
    return np.packbits(votes > 0, axis=1).view(">i8").astype(np.int64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint of each row's whole text, as a signed long."""

    def run(batches):
        for b in batches:
            fp = np.fromiter((fingerprint(t.as_py(), words) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, fp long")


def fingerprint_links(fps: DataFrame, bucket: int = 64) -> tuple[DataFrame, DataFrame]:
    """(a, b) of distinct fingerprints (column fp) that differ in two bits or fewer, or that a chain of such links joins; and the
    written table that they come from."""

    def run(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(fp), 20_000):
                part = fp[at : at + 20_000]
                rows, keys = golay_keys(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(part[rows])], ["key", "fp"])

    keys = fps.select("fp").mapInArrow(run, "key long, fp long")
    full = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    hits = materialise(keys.join(full, "key"), "golay")
    small = hits.filter(F.col("n") <= bucket)
    pairs = (
        small.select("key", F.col("fp").alias("a"))
        .join(small.select("key", F.col("fp").alias("b")), "key")
        .filter("a < b and bit_count(a ^ b) <= 2")
        .select("a", "b")
    )
    dense = hits.filter(F.col("n") > bucket).select("fp").distinct()
    near = dense.select("fp", F.explode(F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(1 << i if i < 63 else -(1 << 63))) for i in range(64)])).alias("mid"))
    # a neighbourhood has 65 fingerprints at most
    stars = near.groupBy("mid").agg(F.min("fp").alias("a"), F.collect_list("fp").alias("bs")).filter("size(bs) > 1")
    stars = stars.select("a", F.explode("bs").alias("b")).filter("a <> b")
    return pairs.union(stars), hits


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, bucket: int = 64) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the smallest id of the row's group."""
    fps = materialise(fingerprints(docs, id_col, text_col, words), "fingerprints")
    each = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    links, hits = fingerprint_links(each, bucket)
    groups = connected_components(links, "a", "b")
    discard(hits)
    rooted = each.join(groups.select(F.col("node").alias("fp"), F.col("component").alias("root")), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.select("fp", "root").join(named, "root").select("fp", "component_id")
    return fps.join(of, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
