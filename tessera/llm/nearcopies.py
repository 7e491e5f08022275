"""Near copies for the pipeline: groups of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

The method is that of simhash, with a radius as wide as the similarity asks for: at exactly 0.8 the sets' angle is 27 degrees, so
a bit differs with a probability of 0.15, far beyond two bits of 64. Each text has 48 * TABLES SimHash votes. A join key is a table
with the Golay indices of its two segments of 24 votes, decoded by the votes' strengths: two texts at 0.8 have an index in common
with a probability of 0.267, both with 0.0715, thus no key of 176 with some 3 in a million; closer ones are likelier to meet. Candidates
must then differ in at most RADIUS of 128 fingerprint bits, and two that alone share a key in at most HALF of the first 64 (at 0.8
they exceed either less than once in 10^6), and are verified by the exact similarity of their texts. First each text is compared with STARS texts of its buckets, those that most buckets hold. Then buckets
of up to ``bucket`` texts compare all pairs of different components. The texts of larger buckets that still hold several components
are open: they go through an exact join, so buckets need not compare two of them. Two sets of the similarity share one of their rarest shingles, early enough for their sizes, so each
text looks only at few of its own shingles, by classes of the other's size (``prefix_keys``). Of a join key only rows outside its
largest component are compared, with those of other components. That join ends on parities: of a set, PARITIES bits, each flipped by
every shingle that falls to its place. Sets that differ in d shingles differ in d bits at most, so two that differ in more bits than
alike ones may in shingles are not alike, for certain. Up to some 800 shingles that leaves few pairs below 0.75; of 1,500 shingles
a quarter was left in a trial, of 4,000 all (see README), and those are verified as before. So a large group of copies costs no
square of its size, and no pair of a bucket goes unseen whose link could still join two components. Texts that are somewhat like a
large group are still compared with all of it that share a key, bit by bit.

Words are split at ASCII white space, ASCII letters lowered, as for op1; a text of fewer than five words is one shingle. Nulls
count as empty, and texts without words are copies of one another. A node is the 64-bit hash of a text, so equal texts are one.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import connected_components, discard, materialise
from .simhash import LOWER, cast_votes, sign_bits, soft_keys, vote_rows

WORDS, TABLES = 5, 176
VOTE_ROWS = 1 << 10  # rows of the table that votes are taken from
RADIUS, HALF = 44, 26  # of 128 bits, of the first 64
STARS = 12  # centres that a text is compared with at first
WEIGHTS = 1 << 18  # places of the counts by which shingles are ordered
PARITIES = 1 << 10  # bits of a set, in longs of 64
STEP = 16  # texts whose votes are counted at once
_RNG = np.random.default_rng(42)
PLACES = _RNG.integers(0, 1 << 63, WORDS, np.uint64) << np.uint64(1) | np.uint64(1)
NODE = "xxhash64(coalesce(cast(text as string), ''))"


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LOWER).split()


def shingles(text: str | None) -> set:
    w = _words(text)
    return set(zip(*(w[k:] for k in range(WORDS)))) if len(w) >= WORDS else {tuple(w)} if w else set()


def alike(a: set, b: set) -> bool:
    """Jaccard similarity of 0.8 or more, in whole numbers."""
    if 5 * min(len(a), len(b)) < 4 * max(len(a), len(b)):
        return False
    common = len(a & b)
    return 5 * common >= 4 * (len(a) + len(b) - common)


def shingle_hashes(text: str | None) -> np.ndarray:
    """A hash of each shingle, got from those of its words, each once."""
    w = _words(text)
    if not w:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, w), np.uint64, len(w))
    n = max(1, len(w) - WORDS + 1)
    s = np.zeros(n, np.uint64)
    for k in range(min(WORDS, len(w))):
        s += h[k : k + n] * PLACES[k]
    s ^= s >> np.uint64(29)
    return np.unique(s * PLACES[0])


def prints(texts: list, table: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Of each text the number of shingles, the fingerprint of 128 bits as two longs, and a key a table."""
    sets = [shingle_hashes(t) for t in texts]
    votes = np.stack([cast_votes(s, VOTE_ROWS) for s in sets]) @ table
    return [len(s) for s in sets], sign_bits(votes[:, :128]), soft_keys(votes)


def _prints(texts: DataFrame) -> DataFrame:
    def run(batches):
        table = vote_rows(VOTE_ROWS, 48 * TABLES)  # not kept beyond the task
        for b in batches:
            for at in range(0, b.num_rows, STEP):
                part = b.slice(at, STEP)
                size, bits, keys = prints(part.column(1).to_pylist(), table)
                each = pa.array(np.arange(0, keys.size + 1, TABLES), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int32()), pa.array(bits[:, 0]), pa.array(bits[:, 1]), pa.ListArray.from_arrays(each, pa.array(keys.ravel()))],
                    ["node", "size", "f0", "f1", "keys"],
                )

    return texts.mapInArrow(run, "node long, size int, f0 long, f1 long, keys array<int>")


CLOSE = f"5 * least(size, other.size) >= 4 * greatest(size, other.size) and bit_count(f0 ^ other.f0) + bit_count(f1 ^ other.f1) <= {RADIUS}"


def _members(printed: DataFrame) -> DataFrame:
    """A row for each key of a text that another text has too, but for two whose fingerprints are far apart: key, n texts of the key, and the text's node, size, f0, f1 and times, its number of such keys."""
    keys = printed.select("node", "f0", F.explode("keys").alias("key"))
    # of the two texts of a key, bit_xor gives the bits that differ: most that meet by chance end here
    full = keys.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor("f0").alias("x")).filter(f"n > 2 or n = 2 and bit_count(x) <= {HALF}").select("key", "n")
    shared = materialise(keys.select("node", "key").join(full, "key"), "golay-shared")
    marks = shared.groupBy("node").agg(F.count("*").alias("times")).join(printed.select("node", "size", "f0", "f1"), "node")
    members = materialise(shared.join(marks, "node").select("key", "n", "node", "size", "f0", "f1", "times"), "golay-members")
    discard(shared)
    return members


def _stars(members: DataFrame) -> DataFrame:
    """(a, b): each text with STARS centres of its buckets at most, those that most buckets hold."""
    centre = members.groupBy("key").agg(F.max_by(F.struct("times", "node", "size", "f0", "f1"), F.struct("times", "node")).alias("other"))
    spokes = members.join(centre, "key").filter(F.expr(f"node <> other.node and {CLOSE}")).select("node", F.struct("other.times", "other.node").alias("to"))
    of = spokes.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("to"), asc=False), 1, STARS).alias("to"))  # TABLES at most
    return of.select("node", F.explode("to.node").alias("to")).select(F.least("node", "to").alias("a"), F.greatest("node", "to").alias("b"))


def _across(small: DataFrame) -> DataFrame:
    """(a, b) of texts of one bucket that are of different components; not of two open texts, which the exact join compares."""
    other = small.select("key", F.struct("node", "component", "open", "size", "f0", "f1").alias("other"))
    return small.join(other, "key").filter(F.expr(f"node < other.node and component <> other.component and not (open and other.open) and {CLOSE}")).select(F.col("node").alias("a"), F.col("other.node").alias("b"))


def _verified(pairs: DataFrame, texts: DataFrame, label: str) -> DataFrame:
    """The (a, b) of pairs whose texts are alike."""

    def run(batches):
        for b in batches:
            held, last, keep = None, None, []
            for x, s, t in zip(b.column(0).to_pylist(), b.column(2), b.column(3), strict=True):
                if x != last:
                    last, held = x, shingles(s.as_py())
                keep.append(alike(held, shingles(t.as_py())))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    both = pairs.distinct().join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b").join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    return materialise(both.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long"), label)


def overlap(a: int, b: int) -> int:
    """The shingles that sets of these sizes must have in common to be alike."""
    return -(-4 * (a + b) // 9)


def size_class(n: int) -> int:
    return int(math.log(n) / math.log(1.05)) if n else -1


@lru_cache(maxsize=4096)
def least_size(c: int) -> int:
    """The least size of a class."""
    n = max(1, int(1.05**c) - 1)
    while size_class(n) < c:
        n += 1
    return n


def prefix_keys(n: int) -> list[tuple[int, int]]:
    """(class, k) of a set of n shingles: it can be alike to a smaller one of the class only if one of its first k shingles is
    among the first own_prefix() of that one, in any order that all sets share."""
    out = []
    for c in range(size_class(max(1, -(-4 * n // 5))), size_class(n) + 1):
        least = max(least_size(c), -(-4 * n // 5))
        if least <= n:
            out.append((c, n - overlap(n, least) + 1))
    return out


def own_prefix(n: int) -> int:
    """As prefix_keys(), for the smaller set of a pair."""
    return n - overlap(n, n) + 1


def _hashes(text: str | None) -> np.ndarray:
    """The hashes of a text's shingles, each once."""
    return np.fromiter({xxhash.xxh64_intdigest(b"\0".join(x)) for x in shingles(text)}, np.uint64)


def parities(hashes: np.ndarray) -> np.ndarray:
    """PARITIES bits as longs: of each place whether an odd number of the hashes falls to it."""
    held = np.bincount((hashes >> np.uint64(32)).astype(np.int64) % PARITIES, minlength=PARITIES)
    return np.packbits((held & 1).astype(bool)).view(">i8").astype(np.int64)


def _weights(texts: DataFrame) -> np.ndarray:
    """How many shingles of all the texts fall into each of WEIGHTS places: an order by it has the rare ones first."""

    def run(batches):
        held = np.zeros(WEIGHTS, np.int64)
        for b in batches:
            for t in b.column(0):
                np.add.at(held, (_hashes(t.as_py()) % np.uint64(WEIGHTS)).astype(np.int64), 1)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], ["at", "n"])

    out = np.zeros(WEIGHTS, np.int64)
    for r in texts.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).collect():  # WEIGHTS rows at most
        out[r["at"]] = r.n
    return out


def _near_by_prefix(texts: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b) of texts of different components that may be alike: all pairs that are, and few others."""
    weights = texts.sparkSession.sparkContext.broadcast(_weights(texts))
    odd = [f"p{i}" for i in range(PARITIES // 64)]

    def run(batches):
        for b in batches:
            for node, c, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                h = _hashes(t.as_py())
                w = weights.value[(h % np.uint64(WEIGHTS)).astype(np.int64)]
                order = np.lexsort((h, w))
                own, n = h[order].view(np.int64), len(h)
                alone = int((w == 1).sum())  # these come first, and no other text has them
                parts = [(own_prefix(n), size_class(n), False), *((m, k, True) for k, m in prefix_keys(n))] if n else []
                took = [max(0, m - alone) for m, *_ in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(pa.array(np.full(sum(took), x), pa.int64()) for x in (node, c, n)),
                        pa.array(np.concatenate([own[:0], *(own[alone : alone + m] for m in took)]), pa.int64()),
                        pa.array(np.repeat([k for _, k, _ in parts], took), pa.int32()),
                        pa.array(np.repeat([x for *_, x in parts], took).astype(bool)),
                        *(pa.array(np.full(sum(took), x), pa.int64()) for x in parities(h)),
                    ],
                    ["node", "component", "size", "s", "class", "larger", *odd],
                )

    of = texts.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "text")
    keys = materialise(of.mapInArrow(run, f"node long, component long, size long, s long, class int, larger boolean, {' long, '.join(odd)} long"), "prefixes")
    key = ["s", "class"]
    mixed = keys.groupBy(*key).agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select(*key)
    held = materialise(keys.join(mixed, key), "mixed-prefixes")
    main = held.groupBy(*key, "component").count().groupBy(*key).agg(F.max_by("component", F.struct("count", "component")).alias("main"))
    rest = held.join(main, key).filter("component <> main").select(*key, "main", F.struct("node", "component", "larger", "size", *odd).alias("x"))
    # two rows outside the main component meet once, in the order of their nodes
    once = "component <> x.component and larger <> x.larger and (component = main or x.node < node)"
    apart = " + ".join(f"bit_count({p} ^ x.{p})" for p in odd)
    across = rest.join(held, key).filter(f"{once} and 9 * ({apart}) <= size + x.size")
    return across.select(F.least("x.node", "node").alias("a"), F.greatest("x.node", "node").alias("b"))


def groups(docs: DataFrame, bucket: int = 64) -> DataFrame:
    """(node, component) of the texts that have near copies; the component is the smallest node of the group."""
    texts = docs.select(F.expr(NODE).alias("node"), F.col("text").cast("string").alias("text"))
    printed = materialise(_prints(texts).dropDuplicates(["node"]), "prints")
    members = _members(printed)
    discard(printed)
    known = materialise(texts.join(members.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")), "near-texts")
    stars = materialise(_stars(members).distinct(), "stars")
    links = _verified(stars, known, "near-links")
    found = connected_components(links, "a", "b")
    named = members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    large = named.filter(F.col("n") > bucket).select("key", "node", "component")
    split = large.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("key")
    open_ = materialise(large.join(split, "key", "left_semi").select("node").distinct(), "open-texts")
    small = named.filter(F.col("n") <= bucket).join(open_.withColumn("open", F.lit(True)), "node", "left")
    pairs = _across(small.withColumn("open", F.coalesce("open", F.lit(False))))
    if not open_.isEmpty():
        pairs = pairs.union(_near_by_prefix(known.join(open_, "node", "left_semi"), found))
    more = _verified(pairs.join(stars, ["a", "b"], "left_anti"), known, "near-links")
    if not more.isEmpty():
        found = connected_components(links.union(more), "a", "b")
    for table in (members, known, stars, links, open_, more):
        discard(table)
    return found
