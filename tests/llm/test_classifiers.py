import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import quality, toxicity
from tessera.llm.shared import calibration, fit_logistic

SCHEMA = "doc_id long, text string, lang string, score string, label string"
BIG = "/root/testdata/sf0.1"


@pytest.mark.parametrize("module,column,mod,held,least", [(quality, "quality", 3, 1, 0.97), (toxicity, "toxic", 5, 0, 0.97)])
def test_held_out_accuracy(spark, module, column, mod, held, least):
    docs, labels = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    out = module.classify(docs, labels)
    rows = out.join(labels, "doc_id").select("doc_id", "held_out", "score", "predicted", F.col(column).alias("y")).collect()
    assert out.count() == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == held) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    kept = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == r.y for r in kept]) >= least
    brier, error, table = calibration([r.score for r in kept], [r.y for r in kept])
    print(module.__name__, "accuracy", np.mean([r.predicted == r.y for r in kept]), "Brier", brier, "calibration error", error, table)
    assert brier <= 0.03 and error <= 0.03 and sum(n for n, *_ in table) == len(kept)


def test_held_out_labels_are_not_learnt(spark):
    docs = spark.createDataFrame([(i, f"text {'good' if i % 2 else 'vile'} {i} word" * 3, None, None, None) for i in range(200)], SCHEMA)
    flip = spark.createDataFrame([(i, (i % 2) ^ (zlib.crc32(str(i).encode()) % 5 == 0), (i % 2) ^ (zlib.crc32(str(i).encode()) % 3 == 1)) for i in range(200)], "doc_id long, toxic int, quality int")
    plain = spark.createDataFrame([(i, i % 2, i % 2) for i in range(200)], "doc_id long, toxic int, quality int")
    for m in (toxicity, quality):
        a, b = ({(r.doc_id, round(r.score, 9)) for r in m.classify(docs, x).collect()} for x in (plain, flip))
        assert a == b


def test_folding_and_exceptions():
    m = toxicity.Model({" idiot ": 3.0, " trash ": 3.0, " clow": 2.0}, [1.0, 1.0, -2.0])
    a = m.automaton()
    hits = lambda t: m.features(t, a)[2]
    for t in ("idiot", "IDI0T!", "1d1ot", "іdіоt", "ｉｄｉｏｔ", "id​iot", "some idiot, trash"):
        assert hits(t) == 1 + ("trash" in t)
    for t in ("ídiot", "i\u0336diot", "ídіot", "ɪdiot", "|diot", "!diot", "you !d|ot go", "ɪᴅɪᴏᴛ", "1DI0T", "id!ot", "idiot!go", "wow!idiot"):
        assert hits(t) == 1, t
    loser = toxicity.Model({" loser ": 3.0}, [1.0, 1.0, -2.0])
    for t in ("1oser", "|oser", "!oser", "lo5er", "l0s3r", "ioser"):
        assert loser.features(t, loser.automaton())[2] == 1, t
    assert hits("the trash can is full") == 0 and hits("clowns") == 1 and hits("idiotic") == 0 and hits("") == hits(None) == 0
    assert m.features("idiot " * 3, a)[0] == 9.0 and m.features("idiot", a)[1] == 300.0


def test_lexicon_against_plain_search(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    m = toxicity.train(docs, labels)

    def slow(text):
        best = (0.0, 0.0, 0)
        for t in toxicity.ways(text):
            hits = {}
            for p, w in m.patterns.items():
                p, at = p.replace("l", "i"), -1
                while (at := t.find(p, at + 1)) >= 0:
                    hits[at] = max(w, hits.get(at, 0))
            for e in m.exceptions:
                e, at = e.replace("l", "i"), -1
                while (at := t.find(e, at + 1)) >= 0:
                    hits = {k: w for k, w in hits.items() if not at <= k < at + len(e)}
            total = sum(hits.values())
            best = max(best, (total, 100 * total / max(1, len(t.split())), len(hits)))
        return 1 / (1 + np.exp(-(m.weights[0] * np.log1p(best[0]) + m.weights[1] * np.log1p(best[1]) + m.weights[2]))), best[2]

    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: (r.score, r.hits) for r in toxicity.score(docs, m).collect()}
    assert got.keys() == texts.keys()
    for i, t in texts.items():
        want = slow(t)
        assert got[i][1] == want[1] and abs(got[i][0] - want[0]) < 1e-9


def test_lexicon_choice_against_counts():
    counts = [(" bad", 40, 1, 38, 0), (" badl", 39, 1, 38, 0), (" good", 10, 500, 12, 480), (" rare", 1, 0, 1, 0), (" half", 60, 0, 1, 9), (" vile ", 30, 0, 31, 1)]
    got = toxicity.choose(counts, 100, 1000, 3, np.log(8))
    assert got == {p: round(np.log((t1 + t2 + 0.5) / 101) - np.log((c1 + c2 + 0.5) / 1001), 6) for p, t1, c1, t2, c2 in counts if p in (" badl", " vile ")}


def test_scores_are_those_of_the_compressed_sizes(spark, sf):
    import zstandard

    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    m = quality.train(docs, labels)

    def size(part, raw):
        return len(zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(raw), write_content_size=False, write_dict_id=False).compress(part))

    def slow(text):
        raw = (text or "").encode()
        parts = [raw[i : i + quality.BLOCK] for i in range(0, len(raw), quality.BLOCK)]
        if not parts:
            return 1 / (1 + np.exp(-m.weights[3])), 0.0
        g, b = [size(p, m.good) for p in parts], [size(p, m.bad) for p in parts]
        low = min([1.0, *((y - x) / (x + y) for k, (p, x, y) in enumerate(zip(parts, g, b)) if len(p) >= 128 or not k)])
        d = sum(b) - sum(g)
        z = 10 * (m.weights[0] * d / (sum(b) + sum(g)) + m.weights[1] * low + m.weights[2] * d / len(raw)) + m.weights[3]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), d / (sum(b) + sum(g))

    texts = {r.doc_id: r.text for r in docs.collect()}
    got = {r.doc_id: (r.score, r.difference) for r in quality.score(docs, m).collect()}
    assert got.keys() == texts.keys()
    for i, t in sorted(texts.items())[:120]:
        assert np.allclose(got[i], slow(t), atol=1e-9)


def test_ties_and_repeated_rows_score_alike(spark):
    docs = spark.createDataFrame([(i % 3, "the same text again", None, None, None) for i in range(9)], SCHEMA)
    labels = spark.createDataFrame([(0, 1, 1), (1, 0, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    for m in (quality, toxicity):
        got = m.classify(docs, labels).collect()
        assert len(got) == 9 and len({r.score for r in got}) == 1


@pytest.mark.parametrize("module", [quality, toxicity])
def test_odd_tables(spark, module):
    labels = spark.createDataFrame([(None, 1, 0), (1, None, None), (3, 7, 9), (2, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(None, None, "a", "b", None), (1, "", None, None, None), (2, "x " * 50_000, None, None, None), (2, "again idiot", None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = module.classify(docs, labels).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got) and [r.held_out for r in got if r.doc_id is None] == [False]
    assert module.classify(docs.limit(0), labels).count() == 0 and module.classify(docs, labels.limit(0)).count() == 4
    if module is toxicity:
        left = toxicity.reject(docs, labels)
        assert left.columns == docs.columns and sorted(r.text or "" for r in left.collect())[:2] == ["", ""]


def test_logistic_regression_finds_the_boundary():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((500, 2))
    w = fit_logistic(x, x[:, 0] - x[:, 1] > 0.3)
    assert np.mean((x @ w[:2] + w[2] > 0) == (x[:, 0] - x[:, 1] > 0.3)) > 0.97 and not fit_logistic(x, np.ones(500)).any()
