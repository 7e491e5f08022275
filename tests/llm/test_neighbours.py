import numpy as np
import pytest

from tessera.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, label int, v string, score string"


def slow(rows, every, k):
    ok = [(i, np.array(e, np.float32).astype(float)) for i, e, *_ in rows if i is not None and e and None not in e and np.isfinite(np.array(e, float)).all() and any(e)]
    out = {}
    for q, x in {i: e for i, e in ok if i % every == 0}.items():
        best = sorted((-float((e * x).sum()), i) for i, e in ok if i != q)[:k]
        out[q] = [(i, -s) for s, i in best]
    return out


def answers(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for x in out.values():
        assert [r for r, *_ in sorted(x)] == list(range(1, len(x) + 1))
    return {q: [(i, s) for _, i, s in sorted(x)] for q, x in out.items()}


def test_rotation_keeps_products():
    x = np.random.default_rng(0).standard_normal((10, 16))
    y = N._turned(x, 4)
    assert y.shape == (10, 64) and np.allclose(x @ x.T, y @ y.T)


def test_estimates_hold_their_bounds():
    rng = np.random.default_rng(1)
    x, q = rng.standard_normal((3000, 64)), rng.standard_normal((20, 64))
    norm = np.linalg.norm(x, axis=1)
    u = N._turned(x, 4) / norm[:, None]
    fit = np.abs(u).sum(1) / 16
    guess = (N._turned(q, 4) @ np.sign(u).T) * (norm / fit / 16)
    slack = np.linalg.norm(q, axis=1)[:, None] * norm * np.sqrt(1 - fit**2) / fit / np.sqrt(255)
    off = np.abs(guess - q @ x.T) / slack
    assert (off <= 3).mean() > 0.99 and abs(np.mean((guess - q @ x.T) / slack)) < 0.05


def test_odd_rows_ties_and_copies(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist(), 1, None, "s") for i in range(300)]
    rows += [(i, rows[7][1], 1, None, None) for i in range(300, 420)]  # copies: ties go to the smaller id
    rows += [(500, None, 0, None, None), (520, [0.0] * 8, 0, None, None), (540, [1.0, None] * 4, 0, None, None), (560, [float("nan")] * 8, 0, None, None), (580, [float("inf")] * 8, 0, None, None), (600, [1.0] * 3, 0, None, None), (None, [1.0] * 8, 0, None, None), (620, [], 0, None, None)]
    rows += [rows[3]]
    got = answers(N.nearest(spark.createDataFrame(rows, SCHEMA)))
    want = slow([r for r in rows if r[0] != 600], 20, 20)
    assert 600 not in got  # the only vector of its length has no others to find
    assert got.keys() == want.keys()
    ids = {q: [i for i, _ in x] for q, x in got.items()}
    assert np.mean([len(set(ids[q]) & {i for i, _ in want[q]}) / len({i for i, _ in want[q]}) for q in want]) > 0.97
    for q in want:
        if set(ids[q]) == {i for i, _ in want[q]}:
            assert ids[q] == [i for i, _ in want[q]] and np.allclose([s for _, s in got[q]], [s for _, s in want[q]], atol=1e-9)


@pytest.mark.parametrize("n", [0, 1, 5])
def test_few_rows(spark, n):
    rows = [(i * 20, [float(i + 1), 2.0], 0, None, None) for i in range(n)]
    got = answers(N.nearest(spark.createDataFrame(rows, SCHEMA)))
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in slow(rows, 20, 20).items() if x}


def test_planes_count_what_products_sum():
    rng = np.random.default_rng(5)
    x, q = rng.standard_normal((700, 64)), rng.standard_normal((9, 64))
    codes, norm, fit = N.encoded(x, 4)
    p = N.Planes(q, 4)
    got = p.products(codes.view(np.uint64), 0, 9)
    turned = N._turned(q, 4)
    rounded = p.low[:, None] + p.step[:, None] * np.rint((turned - p.low[:, None]) / p.step[:, None])
    signs = np.unpackbits(codes, axis=1)[:, :256] * 2.0 - 1
    assert np.allclose(got, rounded @ signs.T) and codes.shape[1] * 8 == 256
    assert [N._spread(n) * n % 64 for n in (1, 3, 8, 64, 100, 768)] == [0] * 6 and N._spread(768) == 1
    guess, err = got * (norm / fit / 16), np.linalg.norm(q, axis=1)[:, None] * np.sqrt((1 - fit**2) / 255) * norm / fit + p.slack[:, None] * norm / fit / 16
    assert (np.abs(guess - q @ x.T) <= 3 * err).mean() > 0.995


def test_lengths_apart_and_repeated_queries(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(8 if i % 3 else 5).astype(np.float32).tolist(), 0, None, None) for i in range(120)]
    rows += [(40, [1.0] * 8, 0, None, None), (60, rows[60][1], 0, None, None)]
    got = answers(N.nearest(spark.createDataFrame(rows, SCHEMA), bound=float("inf")))
    for q, found in got.items():
        own = min(np.array(e, np.float32).astype(float).tolist() for i, e, *_ in rows if i == q)
        best = sorted((-float((np.array(own) * np.array(e, np.float32).astype(float)).sum()), i) for i, e, *_ in rows if i != q and len(e) == len(own))[:20]
        assert [i for i, _ in found] == [i for _, i in best]


def test_most_rows_are_not_rescored(spark):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(64).astype(np.float32).tolist(), 0, None, None) for i in range(20_000)]
    index, centres = N.build_index(spark.createDataFrame(rows, SCHEMA))
    queries = index.filter("vec_id % 1000 = 0").select("vec_id", "v", "place")
    found = N.search(index, centres, queries, cell=1 << 19).groupBy("query_id").agg({"reranked": "max"}).collect()
    assert len(found) == 20 and np.mean([r[1] for r in found]) < 0.1 * 8192


def test_recall_on_the_whole_table(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = slow([(r.vec_id, r.embedding) for r in table.collect()], 20, 20)
    index, centres = N.build_index(table)
    queries = index.filter("vec_id % 20 = 0").select("vec_id", "v", "place")
    for cell in (N.CELL, 1000):  # in one block and group, and in several
        got = answers(N.search(index, centres, queries, cell=cell))
        assert got.keys() == want.keys()
        assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / len(want[q]) for q in want]) >= 0.98
    whole = answers(N.search(index, centres, queries, bound=float("inf"), cell=1000))
    assert {q: [i for i, _ in x] for q, x in whole.items()} == {q: [i for i, _ in x] for q, x in want.items()}
