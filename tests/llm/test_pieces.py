import random

import pytest

from tessera.llm import pieces as P

SCHEMA = "doc_id long, text string, ids string, n_tokens string, lang string"
ODD = [None, "", " ", "  a  b\n\nc\té ", "日本語のテキスト、長い文", "aaaa" * 50, "ab" * 3000, "   " * 7 + "x", "é😀 x", "<s>[INST] <0x41>", "http://a.b/c?d=e&f=g" * 30, "\n", "x\n\n\n", "a▁b"]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=P.default_model())


@pytest.fixture(scope="module")
def v():
    return P.vocabulary(P.default_model())


def texts(spark, sf):
    rng = random.Random(1)
    out = [t or "" for t in ODD]
    out += ["".join(rng.choice("abcdefghijklmnop  \n.,éß日") for _ in range(300)) for _ in range(100)]
    out += ["".join(rng.choice(["the", "in", "er", "an", "re", " ", "ing", "x"]) for _ in range(300)) for _ in range(60)]
    return out + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]


def test_equals_the_library(spark, sf, library, v):
    for t in texts(spark, sf):
        assert v.encode(t) == library.encode(t)
        assert v.decode(v.encode(t)) == t.replace(P.MARK, " ")


def test_stream_equals_the_whole_and_commits_early(spark, sf, library, v):
    for t in texts(spark, sf):
        if t:
            assert list(v.search(P.MARK + t.replace(" ", P.MARK))) == library.encode(t)
    taken = 0

    def feed():
        nonlocal taken
        for c in P.MARK + "the quick brown fox ".replace(" ", P.MARK) * 500:
            taken += 1
            yield c

    ids = v.search(feed())
    next(ids)
    assert taken <= 4 * v.longest
    for _ in range(1000):
        next(ids)
    assert taken < 10_500


def test_window_stays_bounded(library, v):
    v.widest = 0
    text = "abcdefgh" * 25_000  # one stream without a boundary between its pieces known beforehand
    assert v.encode(text) == library.encode(text)
    assert 0 < v.widest <= 4 * v.longest


def test_scripts_without_spaces_are_cut_between_characters(library, v, monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("日本語中文字漢かなカナあいうабвгд،ال한글😀") for _ in range(60_000))
    v.widest = 0
    assert v.encode(text) == library.encode(text) and v.widest < 200
    monkeypatch.setattr(P, "BLOCK", 100)
    assert v.encode(text[:5000]) == library.encode(text[:5000])


def test_ten_million_characters(library, v, monkeypatch):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randrange(1, 14))) for _ in range(100_000)]
    text = " ".join(rng.choice(words) for _ in range(1_250_000)) + "  \n end"
    held = []
    plain = v.searched
    monkeypatch.setattr(v, "searched", lambda streams: held.append(max(map(len, streams), default=0)) or plain(streams))
    ids, n = v.encode_batch([text, None, "short"])
    want = library.encode(text)
    assert len(text) > 9_000_000 and n.tolist() == [len(want), 0, len(library.encode("short"))] and ids[: len(want)].tolist() == want
    assert max(held) <= 2 * v.longest  # all goes through the search, in streams of bounded length


def test_blocks_of_a_long_text_join(library, v, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 50)
    for t in ("one two  three   four " * 30, " " * 300 + "x", "\u2581 a" * 60, "y" * 400, "日本 " * 50):
        assert v.encode(t) == library.encode(t) and "".join(v._blocks(t)) == t.replace(" ", P.MARK)


def test_distinct_words_and_a_full_table_of_pairs(library, monkeypatch):
    monkeypatch.setattr(P, "PAIRS", 500)
    own, rng = P.Vocabulary(P.default_model()), random.Random(5)
    for t in (" ".join("".join(rng.choice("abcdeéxyz日0\n") for _ in range(rng.randrange(1, 12))) for _ in range(3000)) for _ in range(3)):
        assert own.encode(t) == library.encode(t)


def test_tables(spark, sf, library):
    rows = [(i, t, "a", "b", None) for i, t in enumerate(ODD)] + [(None, "x", None, None, None), (3, ODD[3], None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = P.encode(docs).collect()
    assert sorted((str(r.doc_id), r.ids) for r in got) == sorted((str(i), library.encode(t or "")) for i, t, *_ in rows)
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in got)
    back = {(r.doc_id, r.text) for r in P.decode(P.encode(docs)).collect()}
    assert back == {(i, (t or "").replace(P.MARK, " ")) for i, t, *_ in rows}
    assert sorted((str(r.doc_id), r.n_tokens) for r in P.digest(docs).collect()) == sorted((str(r.doc_id), r.n_tokens) for r in got)
    assert P.encode(docs.limit(0)).count() == P.digest(docs.limit(0)).count() == 0
