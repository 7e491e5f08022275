import random

import pytest

import corpus_pipeline as C
from tessera.llm import nearcopies as N

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def slow_shingles(t):
    w = (t or "").lower().split()
    return {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def slow_components(texts):
    sets, root = [slow_shingles(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a == b or len(a & b) >= 0.8 * len(a | b):
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    return root


def sample():
    rng = random.Random(7)
    texts = [None, "", " \n", "one", "One", "one two"]
    for n in (12, 60, 60, 200, 600):
        base = [rng.choice("abcdefghij") + rng.choice("klmnop") + str(rng.randrange(90)) for _ in range(n)]
        for _ in range(30):
            w = list(base)
            for _ in range(rng.randrange(1 + n // 25)):
                w[rng.randrange(n)] = "zz%d" % rng.randrange(999)
            texts.append(" ".join(w))
    return texts


@pytest.mark.parametrize("bucket", [64, 3])
def test_groups_against_brute_force(spark, bucket):
    texts = sample()
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    of = {r.node: r.component for r in N.groups(docs, bucket).collect()}
    nodes = [r.node for r in docs.selectExpr("doc_id", f"{N.NODE} as node").orderBy("doc_id").collect()]
    got, want = [of.get(n, n) for n in nodes], slow_components(texts)
    assert len(set(got)) == len(set(want)) == len(set(zip(got, want)))


def family(n, words, seed):
    """Texts that are one text with words changed: some of them alike, others not, and pairs apart from the rest."""
    rng = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for i in rng.sample(range(words), rng.randrange(1, words // 12)):
            w[i] = f"z{rng.randrange(10**6)}"
        out.append(" ".join(w))
        if rng.random() < 0.1:
            out.append(out[-1] + " tail")
    return out


def test_a_large_family_of_somewhat_like_texts(spark):
    texts = family(150, 120, 3) + family(40, 60, 4)
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], SCHEMA)
    of = {r.node: r.component for r in N.groups(docs, 8).collect()}
    nodes = [r.node for r in docs.selectExpr("doc_id", f"{N.NODE} as node").orderBy("doc_id").collect()]
    got, want = [of.get(n, n) for n in nodes], slow_components(texts)
    assert 5 < len(set(want)) < len(texts) and len(set(got)) == len(set(want)) == len(set(zip(got, want)))


def test_prefixes_lose_no_like_pair():
    rng = random.Random(1)
    for _ in range(3000):
        universe = list(range(rng.randrange(3, 60)))
        a = set(rng.sample(universe, rng.randrange(1, len(universe) + 1)))
        b = set(x for x in a if rng.random() < 0.93) | set(rng.sample(universe, rng.randrange(0, 3)))
        if not b or not N.alike(a, b):
            continue
        small, large = sorted((a, b), key=len)
        own = sorted(small)[: N.own_prefix(len(small))]
        k = dict(N.prefix_keys(len(large)))[N.size_class(len(small))]
        assert set(own) & set(sorted(large)[:k])
    assert all(N.size_class(N.least_size(c)) == c and N.size_class(N.least_size(c) - 1) < c for c in map(N.size_class, (1, 2, 5, 40, 999, 10**6)))


def test_stage_drops_a_copy_with_a_few_changed_words(spark):
    words = [f"word{i}" for i in range(300)]
    near, far = list(words), list(words)
    for i in range(20, 300, 60):
        near[i] = f"other{i}"
    for i in range(20, 300, 20):
        far[i] = f"other{i}"
    rows = [(i, " ".join(w), None, None, None) for i, w in ((5, words), (7, near), (9, far))]
    assert sorted(r.doc_id for r in C.drop_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), "").collect()) == [5, 9]


def test_one_row_a_group_where_ids_repeat(spark):
    one, two, three = (" ".join(f"{x}{i}" for i in range(80)) for x in "abc")
    rows = [(1, one, "x"), (1, two, "x"), (1, three, "x"), (2, one, "x"), (2, two, "x"), (2, two.upper(), "x"), (3, three, "x"), (3, three, "x"), (None, one, "x"), (None, one, "x")]
    docs = spark.createDataFrame([(i, t, s, None, None) for i, t, s in rows], SCHEMA)
    got = C.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in got.collect()) == sorted([("1", one), ("1", two), ("1", three), ("None", one), ("None", one)])
