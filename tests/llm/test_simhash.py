import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.shared import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, cur = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            if cur:
                words.append(cur)
            cur = ""
        else:
            cur += c
    if not words:
        return 0
    sh = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_components(ids, fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 2:
                root[find(i)] = find(j)
    best = {}
    for i, d in enumerate(ids):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return [best.get(find(i)) for i in range(len(ids))]


def test_golay_keys_lose_no_close_pair():
    rng = np.random.default_rng(1)
    fp = rng.integers(0, 2**64, 300, dtype=np.uint64)
    for flips in (0, 1, 2):
        other = fp.copy()
        for _ in range(flips):
            other ^= np.uint64(1) << rng.integers(0, 64, len(fp)).astype(np.uint64)
        r1, k1 = simhash.golay_keys(fp)
        r2, k2 = simhash.golay_keys(other)
        a, b = set(zip(r1.tolist(), k1.tolist())), set(zip(r2.tolist(), k2.tolist()))
        assert {r for r, _ in a & b} == set(range(len(fp)))
    words = np.arange(1 << 12) << 11
    assert len(set(simhash.golay_index(rng.integers(0, 1 << 23, 200_000)).tolist())) == 1 << 12 and words.size


@pytest.mark.parametrize("bucket", [64, 2])
def test_against_brute_force(spark, bucket):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefghij") + rng.choice("klmnop") for _ in range(n)) for n in (5, 60, 60, 200, 400)]
    texts = [None, "", " \t\n", "One", "one", "one two", "ONE\ttwo", "É x", "é x"]
    for b in base:
        for _ in range(25):
            w = b.split()
            if rng.random() < 0.7:
                w[rng.randrange(len(w))] = "zz%d" % rng.randrange(9)
            texts.append(" ".join(w))
    rows = [(None if i == 3 else i * 7 % 1000, t, None, "doc_id", None) for i, t in enumerate(texts)]
    rows += rows[10:14]
    got = simhash.near_duplicates(spark.createDataFrame(rows, SCHEMA), bucket=bucket).collect()
    fps = [slow_fingerprint(r[1]) for r in rows]
    want = sorted(((str(r[0]), format(f, "016x"), str(c)) for r, f, c in zip(rows, fps, slow_components([r[0] for r in rows], fps))))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_dense_bucket(spark):
    base = random.Random(5).getrandbits(63)
    fps = {base}
    for i in range(12):
        for j in range(12):
            fps.add(base ^ (1 << i) ^ (1 << (j + 40)))
    fps |= {base ^ 0b111 << 20}
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    got = {}
    for bucket in (4, 10_000):
        links = simhash.fingerprint_links(df, bucket)[0]
        comp = connected_components(links, "a", "b")
        got[bucket] = {(r.node, r.component) for r in comp.collect()}
    assert got[4] == got[10_000]


def test_empty_table(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(1000, 1100)] + [(None, 3), (7, 7)]
    got = {(r.node, r.component) for r in connected_components(spark.createDataFrame(chain, "x long, y long"), "x", "y").collect()}
    assert got == {(i, 100) for i in range(100, 161)} | {(5, 5)} | {(i, 5) for i in range(1000, 1100)}


def test_whole_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    fps = [slow_fingerprint(t) for _, t in rows]
    want = {(i, format(f, "016x"), c) for (i, _), f, c in zip(rows, fps, slow_components([i for i, _ in rows], fps))}
    got = simhash.near_duplicates(docs.withColumn("fp", F.lit(1)).withColumn("key", F.lit("x")))
    assert {tuple(r) for r in got.collect()} == want
