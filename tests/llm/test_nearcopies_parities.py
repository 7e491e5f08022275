"""Texts somewhat like a large group cost the near-duplicate stage hardly a row, and no alike pair is lost."""

import random

import numpy as np

from tessera.llm import nearcopies as N


def test_parities_never_part_more_shingles_than_differ():
    rng = np.random.default_rng(3)
    for n, d in ((0, 1), (1, 0), (40, 9), (150, 32), (150, 60), (5000, 1200)):
        for _ in range(20):
            a, more = rng.integers(0, 1 << 63, n, np.uint64), rng.integers(0, 1 << 63, d, np.uint64)
            b = np.concatenate([a[d // 2 :], more[: d - d // 2]])
            apart = sum(bin(int(x) & (1 << 64) - 1).count("1") for x in N.parities(a) ^ N.parities(b))
            assert apart <= len(set(a.tolist()) ^ set(b.tolist())) and (apart > 0 or d == 0 or n > 1000)


def test_rows_of_texts_somewhat_like_a_large_group(spark):
    rng, base, texts = random.Random(11), [f"w{i}" for i in range(150)], []
    for _ in range(90):  # alike: a word or two left out
        gone = set(rng.sample(range(150), rng.randrange(1, 3)))
        texts.append(" ".join(w for i, w in enumerate(base) if i not in gone))
    for _ in range(90):  # two passages left out, too far from the whole; some are alike to each other
        at, to = rng.randrange(10, 60), rng.randrange(80, 130)
        texts.append(" ".join(base[:at] + base[at + 12 : to] + base[to + 12 :]))
    texts = sorted(set(texts))
    of = spark.createDataFrame([(t,) for t in texts], "text string").selectExpr(f"{N.NODE} as node", "text").cache()
    node = {r.text: r.node for r in of.collect()}
    whole = [t for t in texts if len(t.split()) > 140]
    found = spark.createDataFrame([(node[t], min(node[x] for x in whole)) for t in whole], "node long, component long")
    sets, want, near = {t: N.shingles(t) for t in texts}, set(), 0
    for i, a in enumerate(texts):
        for b in texts[:i]:
            if not (a in whole and b in whole):
                common = len(sets[a] & sets[b])
                near += common >= 0.75 * (len(sets[a]) + len(sets[b]) - common)
                if N.alike(sets[a], sets[b]):
                    want.add((min(node[a], node[b]), max(node[a], node[b])))
    got = [tuple(r) for r in N._near_by_prefix(of, found).collect()]
    assert want <= set(got) and len(want) > 50
    assert len(set(got)) <= near  # nothing far from alike is left to be verified
