"""Audits, replies, chunks, samples, graphs and sources: cases that the registered queries do not reach."""

import json
import time

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import udf as U
from tessera.operators import audit as A
from tessera.operators import chunking as K
from tessera.operators import formats as X
from tessera.operators import models as M
from tessera.operators import quality as Q
from tessera.operators import replies as E
from tessera.operators import samples as Z
from tessera.operators import segments as S
from tessera.operators import topics as P
from tessera.sources import files as D

SIDE = "record_index long, pair_id string, episode_id string, question string, answer string, answer_speaker string, source_spans_text string, fit_score_ce double, gates struct<pairfit_passed:boolean,speaker_check_passed:boolean>"


def test_empty_tables_have_defined_results(spark):
    none = spark.createDataFrame([], SIDE)
    assert A.audit_rates(A.audit_rows(none, none, ["a"])).filter("total = 0").count() == 6
    assert tuple(A.gating_metrics(none).first()) == (0, 0, 1.0, 0.0, None)
    assert A.leakage_report(none, none).first().overlap == [] and A.reasons(none.withColumn("drop_reason", F.lit(None).cast("string"))).count() == 0
    assert tuple(Q.rank_percentile(spark.createDataFrame([], "t int"), "t", 0.95).first()) == (0, 0.0, 0)
    assert Q.sample(spark.range(100), "id", 0.0).count() == 0 and Q.sample(spark.range(100), "id", 2.0).count() == 100
    assert A.example_statistics(spark.createDataFrame([], "messages array<struct<role:string,content:string>>")).first().per_sample == 0.0
    assert P.root_paths(spark.createDataFrame([], "parent_id int, child_id int"), spark.createDataFrame([], "id int")).count() == 0
    assert K.numbered(spark.createDataFrame([], "seq int"), ["seq"]).count() == 0


def test_nulls_and_clashing_names_in_an_audit(spark):
    rows = [(i, None, None, None, None, None, None, None, None) for i in range(3)] + [(3, "p", "e", "What?", "It is so", "Ann", "it IS, so!", 0.7, (True, True)), (4, "q", "e", "What?", "It is so", "Ann", "it is so", float("nan"), (True, True))]
    d = spark.createDataFrame(rows, SIDE).withColumn("duplicates", F.lit(1)).withColumn("i", F.lit(2)).withColumn("f", F.lit(3))
    got = {r.record_index: r for r in A.audit_rows(d, d, ["ANN"]).collect()}
    assert len(got) == 5 and got[3].reasons == ["duplication: Exact duplicate found at index 4"] and got[4].duplication.endswith("index 3") and got[4].fit_score
    assert got[0].duplication is None and len(got[0].reasons) == 3 and got[0].fit_score is None


def test_saved_audit_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def passed(i):
        seen.add(1)
        return i % 4 != 0

    rows = spark.range(40).withColumnRenamed("id", "record_index").withColumn("passed", F.udf(passed, "boolean")("record_index"))
    audited = rows.withColumns({c: F.when(~F.col("passed"), F.lit("bad, \"so\"")) for c in A.CHECKS}).withColumn("reasons", F.when(~F.col("passed"), F.array(F.lit("bad, \"so\""))).otherwise(F.array().cast("array<string>")))
    A.save_audit(audited, str(tmp_path))
    assert seen.value == 40
    failed = spark.read.option("header", True).option("escape", '"').csv(f"{tmp_path}/failures").collect()
    assert {(int(r.record_index), r.failure_reasons) for r in failed} == {(i, 'bad, "so"') for i in range(0, 40, 4)}
    assert {(r.check, r.passed, r.total) for r in spark.read.json(f"{tmp_path}/report").collect()} == {(c, 30, 40) for c in (*A.CHECKS, "overall")}


def test_rates_of_many_copies_compare_no_pairs(spark):
    rows = spark.range(20_000).selectExpr("id AS record_index", "'p' AS pair_id", "'e' AS episode_id", "'Q' || id || '?' AS question", "CASE WHEN id % 2 = 0 THEN 'the same answer of half of all rows' ELSE md5('' || id) END AS answer", "'Ann' AS answer_speaker",
                                          "'x' AS source_spans_text", "0.7D AS fit_score_ce", "named_struct('pairfit_passed', true, 'speaker_check_passed', true) AS gates")
    rates = A.audit_rates(A.audit_rows(rows, rows, ["Ann"]))
    assert "Pandas" not in rates.select("check", "passed").filter("check = 'duplication'")._jdf.queryExecution().executedPlan().toString().replace("ArrowEvalPython", "")
    assert {r.check: r.passed for r in rates.collect()}["duplication"] == 10_000


def test_percentile_and_thresholds_against_sorting(spark):
    import random

    rng = random.Random(1)
    for values in ([rng.randrange(10**9) for _ in range(3000)], [rng.random() * 1e-6 for _ in range(500)], [7] * 50, [1, 2], [0.1, 1e18, -5.0]):
        rows = spark.createDataFrame([(float(v),) for v in values], "v double")
        for p in (0.0, 0.5, 0.95, 1.0):
            assert Q.rank_percentile(rows, "v", p).first().value == sorted(map(float, values))[round((len(values) - 1) * p)]
    ids = spark.range(20_000)
    order = [r.id for r in ids.orderBy(Q.hash_rank(F.col("id"), 7)).collect()]
    for k in (1, 5000, 12_345, 20_000):
        cut = Q._cut(ids, "id", 7, k, few=16)
        assert {r.id for r in ids.filter(Q.hash_rank(F.col("id"), 7) <= cut).collect()} == set(order[:k])
    zeros = spark.createDataFrame([(0,), (0,), (5,)], "t int")
    assert Q.rank_percentile(zeros, "t", 0.0, skip_zero=True).first().value == 5


def test_long_chains_lose_no_path_and_hold_no_cycle(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(50)], "parent_id int, child_id int")
    got = P.root_paths(chain, spark.createDataFrame([(0,)], "id int")).collect()
    assert [r.path for r in got] == [list(range(51))]
    assert P.cyclic_nodes(chain).count() == 0


def test_white_space_takes_time_in_proportion(spark):
    row = spark.createDataFrame([("a" + " " * 200_000 + "b",), ("  x ",), (None,)], "t string")
    began = time.time()
    got = [r.s for r in row.select(T.strip(F.col("t")).alias("s")).collect()]
    assert got[1:] == ["x", ""] and len(got[0]) == 200_002 and time.time() - began < 10


def test_bad_samples_give_null_and_good_ones_stay(spark):
    good = {"question": "q", "tool_used": "f", "answer": "a"}
    bad = [
        {**good, "available_tools": [{"description": "no name"}, "x", 3]}, {**good, "available_tools": {"a": 1}}, {**good, "chain_of_thought": "c", "reasoning_trace": [{"thought": "t"}, "x"]}, {**good, "additional_tools": "x"},
        {**good, "tool_input": 7, "tool_output": [1]}, {**good, "available_tools": [{"name": "f", "parameters": "x"}]}, {**good, "tool_used": ["x"]},
    ]
    texts = [json.dumps(x) for x in bad] + ["[1]", "null", "{", "[" * 100_000, None, json.dumps(good)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, s string")
    for name in ("single_tool_call", "tool_calling", "xlam_v2"):
        got = {r.i: r.x for r in rows.select("i", X.FORMATS[name](F.col("s")).alias("x")).collect()}
        assert len(got) == len(texts) and (name == "xlam_v2" or got[len(texts) - 1] is not None) and all(got[i] is None for i in range(len(bad), len(texts) - 1))
    steps = rows.filter("i = 2").select(X.tool_calling(F.col("s"))["messages"].alias("m")).first().m
    assert "Step 1: t" in steps[1].content
    turns = [{"from": "human", "value": "a"}, {"from": "function_call", "value": '{"name": "f", "arguments": {}}'}, {"from": "observation", "value": "b"}, {"from": "gpt", "value": "c"}]
    odd = [json.dumps({"turns": turns, "available_tools": t}) for t in ("x", {"a": 1}, [{"x": 1}], [{"name": "f"}])]
    got = [r.x for r in spark.createDataFrame([(t,) for t in odd], "s string").select(X.xlam_v2(F.col("s")).alias("x")).collect()]
    assert got[0] is None and got[1] is None and got[2].tools == "[]" and json.loads(got[3].tools)[0]["name"] == "f"


def test_lists_and_numbers_in_text():
    assert U.parse_list('["a", null, true, 1]') == ["a", "None", "True", "1"] and U.parse_list("x [1, [2]] y") == ["1", "[2]"] and U.parse_list("[" * 5000) == [] and U.parse_list(None) == [] and U.parse_list('{"a": 1}') == []
    one = lambda t: U._LOOSE.sub(U._plain_number, t)
    assert one('{"a": 1:30.5, "b": 007, "c": 0.5, "d": "2:10", "e": 0}') == '{"a": 90.5, "b": 7, "c": 0.5, "d": "2:10", "e": 0}'
    assert one('{"t": 12:34:56}') == '{"t": 12:34:56}'


def test_tokens_of_a_tokenizer(spark):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    rows = spark.createDataFrame([("hello world again",), ("",), (None,), ("  a  ",)], "t string")
    enc = U._ranks(ranks, public_tokenizers.PATTERN)
    got = rows.select("t", U.tokenizer_counts(F.col("t"), ranks, public_tokenizers.PATTERN).alias("n"), U.tokenizer_cut(F.col("t"), 2, ranks, public_tokenizers.PATTERN).alias("c")).collect()
    for r in got:
        ids = enc.encode_ordinary(r.t or "")
        assert r.n == len(ids) and r.c == enc.decode(ids[:2])

    class Coder:
        def __init__(self):
            self.enc = U._ranks(ranks, public_tokenizers.PATTERN)

        def encode(self, t):
            return self.enc.encode_ordinary(t)

        def decode(self, x):
            return self.enc.decode(x)

    text = "One two three. " * 5 + "word " * 60 + ". End!"
    got = spark.createDataFrame([(text,)], "t string").select(K.chunk_text(F.col("t"), 12, Coder).alias("x")).first().x
    assert [(c.text, c.tokens) for c in got] == K.pack(text, 12, Coder()) and all(c.tokens <= 12 for c in got)
    assert " ".join(c.text for c in got).replace(" ", "") == text.replace(" ", "")


def test_chunks_of_odd_white_space_equal_the_sql(spark, tmp_path):
    import random

    import duckdb

    from tessera.plans import source_queries as Y

    rng = random.Random(3)
    parts = ["word", " ", "\n", "\t", ". ", ".\n", "! ", "?\r\n", "\x0b", "\xa0", "\u2003", " " * 30, "x" * 90, "é", "\x1f", "\x85", "\u3000", "😀", ".", "\x01"]
    texts = ["", "   ", None, "a", "\n", "x" * 799 + "\n" + "y" * 10, "x" * 400 + " " * 1700 + "y" * 900, "\x01"] + ["".join(rng.choices(parts, k=rng.choice([3, 40, 300]))) for _ in range(300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    got = sorted(map(tuple, Y.q_chunk_text(spark, str(tmp_path)).select("doc_id", "chunk", "text", "tokens").collect()))
    assert got == sorted(con.execute(f"SELECT doc_id, chunk, text, tokens FROM ({Y.ORACLE_SQL['q_chunk_text']})").fetchall())
    assert K.pack("x" * 799 + "\n" + "y" * 10, 200, K.Quarters())[0] == ("x" * 799, 200)  # the operator itself trims all white space


def test_segments_of_files_in_many_blocks(spark, tmp_path):
    values = [json.dumps({"episode_id": "e", "text": f"line {i} " + "x" * (i % 50)}) if i % 7 else "" for i in range(2000)]
    (tmp_path / "a.jsonl").write_text("\n".join(values) + "\n")
    (tmp_path / "b.jsonl").write_text("\n".join(values[:10]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = D.lines(spark, str(tmp_path)).collect()
        blocks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    by = {}
    for r in got:
        by.setdefault(r.source_path.rsplit("/", 1)[1], {})[r.line] = r.value
    assert blocks > 10 and [by["a.jsonl"][i + 1] for i in range(2000)] == values and [by["b.jsonl"][i + 1] for i in range(10)] == values[:10] and len(by["a.jsonl"]) == 2000


def test_config_tools_and_uploads(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"a": {"args": {"x": 1}, "y": 2}, "b": 3}')
    assert D.config(spark, str(tmp_path / "c.json")) == {"a": {"y": 2, "x": 1}, "b": 3}
    (tmp_path / "t.json").write_text('[{"name": "f"}, {"description": "no name"}]')
    assert [r.name for r in D.tools(spark, str(tmp_path / "t.json")).collect()] == ["f"]
    (tmp_path / "bad.json").write_text('{"other": 1}')
    with pytest.raises(ValueError):
        D.tools(spark, str(tmp_path / "bad.json"))
    (tmp_path / "t.yaml").write_text("tools: []\n")
    try:
        import yaml  # noqa: F401

        assert D.tools(spark, str(tmp_path / "t.yaml")).count() == 0
    except ImportError:
        with pytest.raises(ValueError, match="YAML"):
            D.tools(spark, str(tmp_path / "t.yaml"))

    class Hub:
        def upload(self, files, name, card):
            if name == "bad":
                raise OSError("no network")
            return {"status": "success", "message": f"{len(files)} to {name}"}

    spark.range(3).coalesce(1).write.json(str(tmp_path / "out"))
    assert D.upload(spark, str(tmp_path / "out"), "set", "card", Hub()) == {"status": "success", "message": "1 to set"}
    assert D.upload(spark, str(tmp_path / "out"), "bad", "card", Hub())["status"] == "error"


def judge():
    class Judge:
        """Supports an answer if the prompt holds it twice (in answer and source), and suggests a better question once."""

        def complete(self, prompts):
            out = []
            for p in prompts:
                good = "Why" not in p
                out.append(None if "silent" in p else json.dumps({"is_supported": good, "is_good_question": True, "reason": "r", "suggested_question": "What is alpha" if "alpha" in p else ""}))
            return out

        def score(self, pairs):
            return [3.0 if "alpha" in a or "fine" in b else -3.0 for a, b in pairs]

    return Judge


def test_two_passes_of_the_pair_judge(spark):
    rows = spark.createDataFrame([(1, "What is fine?", "fine", "fine", None), (2, "Why?", "alpha fine", "alpha fine", "alpha fine"), (3, "Why?", "beta", "beta", None), (4, "What is silent?", "fine silent", "silent", "c")], "i int, question string, answer string, source string, context string")
    got = {r.i: (r.fit.status, r.fit.question, r.attempts) for r in E.evaluate(rows, judge()).collect()}
    assert got == {1: ("accepted", "What is fine?", 1), 2: ("accepted", "What is alpha?", 2), 3: ("rejected", None, 1), 4: ("error", None, 1)}


def broken():
    class Broken:
        """The first reply of a prompt is no JSON, the next one is."""

        def complete(self, prompts):
            return ['{"a": 1, "b": "x"}' if "did not fit" in p else "sorry" if "never" not in p else '{"b": "y"}' for p in prompts]

    return Broken


def test_structured_replies_are_asked_again(spark):
    rows = spark.createDataFrame([(1, "ask"), (2, "never")], "i int, p string")
    got = {r.i: r.value for r in E.structured(rows, F.col("p"), "struct<a:int,b:string>", broken(), 3, ("a",)).collect()}
    assert (got[1].a, got[1].b) == (1, "x") and got[2].a == 1
    assert E.structured(rows, F.col("p"), "struct<a:int>", broken(), 1, ("a",)).filter("value is null").count() == 2


def writer():
    class Writer:
        def complete(self, prompts):
            return ['```json\n[{"question": "Q?", "answer": "A", "answer_speaker": "S", "citations": [{"speaker": "S", "start": 01:05, "end": 70}]}, {"question": "", "answer": "x"}]\n```' if "hello" in p else "nothing" for p in prompts]

    return Writer


def test_pairs_of_windows_trims_and_speakers(spark):
    seg = "struct<seq:int,start:double,end:double,speaker:string,text:string>"
    w = spark.createDataFrame([("w1", [(0, 0.0, 1.0, "S", "hello")]), ("w2", [(0, 0.0, 1.0, "S", "bye")])], f"window_id string, segments array<{seg}>")
    got = E.generate_pairs(w, ["S"], 2, writer()).collect()
    assert [(r.window_id, r.sample_index, r.pair.question, r.pair.citations[0].start) for r in got] == [("w1", 0, "Q?", 65.0)]

    class Trimmer:
        def complete(self, prompts):
            return ['{"answer_trimmed": "two three", "allowed": true, "reason": " ok "}' for _ in prompts]

    rows = spark.createDataFrame([("q", "one two three four", "S"), ("q", "one", "S")], "question string, answer string, answer_speaker string")
    got = E.trim_answers(rows, 2, Trimmer).orderBy(F.length("answer")).collect()
    assert got[0].trim is None and got[1].trim.start_char == 4 and got[1].trim.end_char == 13
    assert {(r.speaker_check.allowed, r.speaker_check.reason) for r in E.check_speakers(rows, ["S"], Trimmer).collect()} == {(True, "ok")}


def test_parameters_examples_and_positions(spark):
    assert Z.creation_errors(1, 1, 1, "basic", ("basic",)) == [] and len(Z.creation_errors(0, 0, 1, "x", ("basic",))) == 3 and len(Z.creation_errors(3, 2, 5, "basic", ("basic",))) == 1
    rows = spark.createDataFrame([(i, f"s{i}") for i in range(5)], "record_index int, sample string")
    assert Z.choose(rows, 10, F.col("sample")).count() == 5 and Z.choose(rows, 2, F.col("sample"), 1).count() == 2 and Z.at(rows, 3).first().sample == "s3"
    talk = spark.createDataFrame([([("user", "long enough text"), ("assistant", "long enough reply")],), ([("user", "hi")],), (None,)], "messages array<struct<role:string,content:string>>")
    kept, row = A.good_examples(talk, 0.3)
    assert kept.count() == 1 and tuple(row.first()) == (3, 1, 1 / 3, True)


def test_answers_grounded_or_alike(spark):
    rows = spark.createDataFrame([("a b c", "A, b c!"), ("abcdefghijklmnopqrst", "abcdefghijklmnopqrsX"), ("abc", "xyz"), (None, "a"), ("a", None), ("", "")], "s string, a string")
    assert [r.g for r in rows.select(A.grounded(F.col("a"), F.col("s")).alias("g")).collect()] == [True, True, False, False, False, False]


def test_graph_growth_keeps_ids_in_order(spark):
    nodes, edges = spark.createDataFrame([(0, "r"), (1, "a")], "id int, topic string"), spark.createDataFrame([(0, 1)], "parent_id int, child_id int")
    plan = spark.createDataFrame([(1, 2, "c", [0, 9]), (1, 1, "b", [3]), (0, 1, "no leaf", [])], "parent_id int, rank int, topic string, connections array<int>")
    n, e = P.grow(nodes, edges, plan)
    assert sorted(map(tuple, n.collect())) == [(0, "r"), (1, "a"), (2, "b"), (3, "c")] and sorted(map(tuple, e.collect())) == [(0, 1), (0, 3), (1, 2), (1, 3)]


def test_folds_pass_over_hot_episodes_in_batches(spark):
    rows = spark.range(30_000).select(F.lit(1).alias("episode_id"), F.col("id").alias("seq"), F.col("id").cast("double").alias("start"), (F.col("id") + 0.5).alias("end"), F.lit("A").alias("speaker"), F.lit("word").alias("text"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    try:
        got = S.merge_with_cap(rows, 1.0, 99).groupBy("n").count().collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.n, r["count"]) for r in got} == {(20, 1500)}


def test_model_clients_are_made_once_a_task(spark, tmp_path):
    mark = str(tmp_path / "made")

    class Counting(M.StubClient):
        def __init__(self):
            with open(mark, "a") as f:
                f.write("x")

    rows = spark.range(5000).repartition(2).selectExpr("cast(id as string) as q", "'a' as a")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        rows.select(M.fit_scores(F.col("q"), F.col("a"), Counting).alias("s")).agg(F.sum("s")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(open(mark).read()) == 2
