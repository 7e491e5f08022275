import time

from pyspark.sql import functions as F

from tessera.functions import udf as U
from tessera.operators import chunking as K
from tessera.operators import convert as C
from tessera.operators import models as M
from tessera.streaming import sessions as W


def test_replies_are_asked_once(spark, tmp_path):
    rows = spark.createDataFrame([(1, "p"), (2, "p"), (3, None), (4, "other")], "i int, p string")
    store = str(tmp_path / "replies")
    a = {(r.i, r.reply) for r in M.complete(rows, F.col("p"), store=store).collect()}
    assert a == {(1, "reply to 1 characters?"), (2, "reply to 1 characters?"), (3, None), (4, "reply to 5 characters?")}

    class Dead:
        def complete(self, prompts):
            raise AssertionError("asked again")

    assert {(r.i, r.reply) for r in M.complete(rows, F.col("p"), Dead, store).collect()} == a


def test_scores_and_audit(spark):
    rows = spark.createDataFrame([("a b", "a b c"), ("x", "y"), (None, None)], "q string, a string")
    got = [r.s for r in rows.select(M.fit_scores(F.col("q"), F.col("a")).alias("s")).collect()]
    assert got == [0.953, 0.047, 0.047]
    assert M.audit(rows, F.col("q").isNotNull() | F.lit(True)).collect()[0].rate == 1.0 and M.audit(rows.limit(0), F.lit(True)).collect()[0].rate == 1.0
    try:
        M.audit(rows, F.col("q") == "x").collect()
        raise AssertionError
    except Exception as e:  # noqa: BLE001
        assert "below" in str(e)
    src = spark.createDataFrame([("It is so, they said.", "IT is so"), ("abcdefghijklmnopqrst", "abcdefghijklmnopqrsX"), ("abc", "xyz"), ("abc", "")], "s string, a string")
    assert [r.m for r in src.select(M.match_answer(F.col("s"), F.col("a")).alias("m")).collect()] == [True, True, False, False]


def test_conversion(spark):
    chunks = spark.createDataFrame([(1, 'An"n', "a.txt"), (2, "Bob", "b.txt")], "chunk_id int, speaker string, source_file string")
    segs = spark.createDataFrame([("a.txt", 0, 0.0, "Ann", "Hi. There."), ("a.txt", 1, 2.55, "Bob", "Yes.")], "source_file string, seq int, start double, speaker string, text string")
    got = {r.chunk_id: r for r in C.conversations(chunks, C.transcripts(segs), "ann").collect()}
    assert got[1].primary_speaker_hit and got[1].transcript_status == "TRANSCRIPT_LOADED" and not got[2].primary_speaker_hit
    assert "ANN: Hi. There.\n[2.6] BOB: Yes." in got[1].messages[1].content or "[2.5] BOB" in got[1].messages[1].content
    assert "Transcript chunk 2 from b.txt" in got[2].messages[1].content
    assert all(r.c == [] for r in C.conversations(chunks, C.transcripts(segs)).select(C.conversation_checks(F.col("messages")).alias("c")).collect())
    long = spark.createDataFrame([("One two. Three four five. Six.",), ("x" * 90,), ("short",)], "t string")
    assert [r.t for r in long.select(C.sentence_budget(F.col("t"), 6).alias("t")).collect()] == ["One two. Three four five.", "", "short"]
    assert [t for t, _ in K.pack("Aa bb. Cc dd. " + "z" * 50 + ". End.", 5, K.Quarters())] == ["Aa bb. Cc dd.", "z" * 20, "z" * 20, "z" * 10 + ".", "End."]


def test_sessions_in_batch_and_stream(spark, tmp_path):
    rows = spark.sql("select 1 as k, timestamp'2024-01-01 00:00:00' + make_dt_interval(0, 0, m) as ts from values (0), (10), (200), (205) t(m)")
    want = {(1, 2)}
    assert {(r.k, r.n) for r in W.sessions(rows, "k", "ts", "30 minutes").collect()} == want
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = W.sessions(stream, "k", "ts", "30 minutes").writeStream.format("memory").queryName("sessions_out").outputMode("complete").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert {(r.k, r.n) for r in spark.table("sessions_out").collect()} == want


def merged(spark, tmp_path, rows, name, want, **options):
    rows.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = W.capped_merge(stream, max_length=10, **options).writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    try:
        q.processAllAvailable() if not options.get("quiet_ms") else None
        until = time.time() + 60
        while time.time() < until and (got := {(r["first"], r.n, r.text) for r in spark.table(name).collect()}) != want:
            time.sleep(0.5)
    finally:
        q.stop()
    return got


ROWS = [(1, 0, 0.0, 1.0, "aa"), (1, 1, 1.5, 2.0, "bb"), (1, 2, 9.0, 10.0, "cc"), (1, 3, 10.0, 11.0, "d" * 8), (1, 4, 11.0, 12.0, "e")]
SEGMENTS = "episode_id long, seq long, start double, end double, text string"


def test_capped_merge_stream(spark, tmp_path):
    want = {(0, 2, "aa bb"), (2, 1, "cc")}
    assert merged(spark, tmp_path, spark.createDataFrame(ROWS, SEGMENTS), "merged_out", want, quiet_ms=None) == want


def test_quiet_keys_are_sent_and_unknown_times_end_a_group(spark, tmp_path):
    rows = [*ROWS, (1, 5, float("nan"), 13.0, "f"), (1, 6, 13.5, float("nan"), "g"), (1, 7, 13.6, 14.0, None)]
    want = {(0, 2, "aa bb"), (2, 1, "cc"), (3, 2, "dddddddd e"), (5, 2, "f g"), (7, 1, "")}
    assert merged(spark, tmp_path, spark.createDataFrame(rows, SEGMENTS), "merged_quiet", want, quiet_ms=1000) == want


def test_late_rows_are_passed_over(spark):
    import pandas as pd

    held = {}

    class State:
        exists, hasTimedOut = property(lambda s: "x" in held), False
        get = property(lambda s: held["x"])

        def update(self, x):
            held["x"] = x

    fold = {}

    class Frame:
        schema = spark.createDataFrame([], SEGMENTS).schema

        def groupBy(self, key):
            return self

        def applyInPandasWithState(self, f, *rest):
            fold["f"] = f

    W.capped_merge(Frame(), quiet_ms=None)
    batch = lambda *rows: list(fold["f"]((1,), iter([pd.DataFrame(rows, columns=["episode_id", "seq", "start", "end", "text"])]), State()))[0].values.tolist()
    assert batch((1, 5, 5.0, 6.0, "b"), (1, 2, 2.0, 3.0, "a")) == [[1, 2, 1, "a"]]  # a batch is put in order
    assert batch((1, 4, 3.5, 4.0, "late"), (1, 9, 20.0, 21.0, "c")) == [[1, 5, 1, "b"]]


def test_prompts(spark):
    from tessera.operators import prompts as R

    row = spark.sql("select named_struct('name', 'f', 'returns', 'int', 'parameters', array(named_struct('name', 'a', 'type', 'str', 'required', true), named_struct('name', 'b', 'type', 'int', 'required', false))) as t, array('x', 'math') as path, array(named_struct('start', 61.0D, 'end', 62.0D, 'speaker', 'A', 'text', 'hi')) as s")
    got = row.select(R.signature(F.col("t")).alias("sig"), R.topic_prompt(F.col("path"), 3, F.lit(""), R.bullets(F.col("path"))).alias("p"), R.window_prompt(F.col("s"), ["A"], 2).alias("w"), R.fit_prompt(F.lit("q"), F.lit(None), F.lit("s")).alias("f")).collect()[0]
    assert got.sig == "f(a: str, b: int = None) -> int" and "Domain: educational" in got.p and "x -> math" in got.p and "- x\n- math" in got.p
    assert "[01:01–01:02] A: hi" in got.w and "Answer: \n" in got.f
    assert R.sample_prompts(row.select("path"), 1, "S").collect()[0].prompt.startswith("S\n")
