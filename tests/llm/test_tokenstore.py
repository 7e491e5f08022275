import random
import zlib

import numpy as np
import pytest

from tessera.llm import tokenstore as T

SCHEMA = "doc_id long, text string, lang string, part long, root string"
ODD = [None, "", " ", "  ", "a", " a", "a  b", "a \n b", "x\n\n y", "  x", "é 日本 😀 ", "it's  I'll", "<|endoftext|>", "a <|endoftext|> b", "t\t u", "1 2  33 ", "word " * 900]


def slow(texts, tool):
    return [[*tool.encode(t or "", add_special_tokens=False).ids, 0] for t in texts]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def tool():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(T.default_tokenizer())


def test_encoder_equals_the_library(tool, spark, sf):
    rng = random.Random(2)
    texts = ODD + ["".join(rng.choice("ab'sZ1,. \n\té日") for _ in range(80)) for _ in range(300)]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    enc = T.Encoder(T.default_tokenizer())
    assert [np.frombuffer(x, enc.kind).tolist() + [0] for x in enc.encode_batch(texts)] == slow(texts, tool)


def test_chunks_join_to_the_whole_and_cut_alike():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 50_000, 20_000)
    ends = T.cuts(ids)
    assert ends[-1] == len(ids) and ends == sorted(set(ends)) and max(np.diff([0, *ends])) <= T.MOST
    moved = T.cuts(np.concatenate([rng.integers(0, 50_000, 777), ids]))
    assert len({e - 777 for e in moved} & set(ends)) > 0.9 * len(ends)
    assert T.cuts(ids[:0]) == [] and T.cuts(np.zeros(5000, int))[-1] == 5000


def test_checksums_join():
    a, b = b"some bytes", bytes(range(200))
    assert T.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert T.crc_join(0, zlib.crc32(b), len(b)) == zlib.crc32(b)


def test_round_trip(spark, tool):
    rows = [(i * 3 % 50 if i != 4 else None, t, None, i, "r") for i, t in enumerate(ODD)] + [(7, "copy of a text", None, 1, "x")] * 3
    path = T.write(spark.createDataFrame(rows, SCHEMA))
    got = T.digests(spark, path).collect()
    ids = {(r.doc_id, r.start): r.ids for r in T.read(spark, path).collect()}
    assert len(got) == len(rows) == len(ids) and T.verify(spark, path)
    start = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == start and r.n_tokens == len(ids[r.doc_id, r.start]) and r.ids_crc32 == crc(ids[r.doc_id, r.start])
        start += r.n_tokens
    assert [r.doc_id for r in sorted(got, key=lambda r: r.start)] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    assert sorted(ids.values()) == sorted(slow([r[1] for r in rows], tool))


def test_damage_is_seen(spark):
    path = T.write(spark.createDataFrame([(1, "one two three", None, 1, "x")], SCHEMA))
    bad = spark.createDataFrame([(T.address(b"other"), 1, b"\1\0")], "address binary, n int, data binary")
    bad.write.mode("append").parquet(f"{path}/chunks")
    with pytest.raises(Exception, match="address"):
        T.digests(spark, path).collect()


def test_a_wrong_manifest_is_seen(spark):
    for change in ({"start": 5}, {"root": b"0" * 16}, {"n_tokens": 99}):
        path = T.write(spark.createDataFrame([(1, "one two three", None, 1, "x"), (2, "four", None, 1, "x")], SCHEMA))
        rows = [{**r.asDict(), **change} for r in spark.read.parquet(f"{path}/manifest").collect()]
        assert T.verify(spark, path) and T.digests(spark, path).count() == 2
        spark.createDataFrame(rows, "part long, documents long, n_tokens long, start long, root binary").write.mode("overwrite").parquet(f"{path}/manifest")
        with pytest.raises(ValueError, match="manifest"):
            T.digests(spark, path)


def test_rows_of_one_id_spread_over_parts(spark):
    docs = spark.range(4000).selectExpr("cast(null as bigint) as doc_id", "concat('text ', id % 3) as text", "'a' as lang", "id as part", "'r' as root")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        path = T.write(docs)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{path}/manifest").count() > 1
    got = T.digests(spark, path).collect()
    assert len(got) == 4000 and len({r.start for r in got}) == 4000 and max(r.start for r in got) == sum(r.n_tokens for r in got) - max(got, key=lambda r: r.start).n_tokens


def test_many_distinct_words_and_very_long_texts(tool):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzABCé0123456789'-.,") for _ in range(rng.randrange(1, 16)))
    texts = [" ".join(word() for _ in range(20_000)), "x" * 300_000, " " * 50_000 + "y", "日本語" * 30_000, "\n\n".join(word() for _ in range(5000)), ". , ".join(word() for _ in range(5000))]
    enc = T.Encoder(T.default_tokenizer())
    assert [np.frombuffer(x, enc.kind).tolist() + [0] for x in enc.encode_batch(texts)] == slow(texts, tool)
    assert all(len(x) <= T.LONG for x in enc.known)


def test_empty_table(spark):
    path = T.write(spark.createDataFrame([], SCHEMA))
    assert T.digests(spark, path).count() == 0 and T.verify(spark, path)


def test_whole_table(spark, sf, tool):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want, start = set(), 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = slow([r.text], tool)[0]
        want.add((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert {tuple(r) for r in T.digests(spark, T.write(docs)).collect()} == want
