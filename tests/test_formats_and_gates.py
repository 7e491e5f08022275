import json
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import udf as U
from tessera.operators import chunking as K
from tessera.operators import formats as X
from tessera.operators import gates as G
from tessera.operators import quality as Q
from tessera.operators import records as R
from tessera.operators import topics as P
from tessera.sources import files as D


def one(spark, expr, *values):
    row = spark.createDataFrame([values or ("",)], ", ".join(f"c{i} string" for i in range(max(1, len(values)))))
    out = row.select(expr(*[F.col(f"c{i}") for i in range(len(values))]).alias("x")).collect()[0].x
    return out.asDict(True) if hasattr(out, "asDict") else out


def fmt(spark, name, sample, **options):
    return one(spark, lambda s: X.FORMATS[name](s, **options), json.dumps(sample))


TALK = [{"role": "system", "content": "Be kind"}, {"role": "user", "content": "2+2?"}, {"role": "assistant", "content": "It is. Answer: 4"}]


def test_alpaca(spark):
    assert fmt(spark, "alpaca", {"messages": TALK}) == {"instruction": "Be kind", "input": "2+2?", "output": "It is. Answer: 4"}
    assert fmt(spark, "alpaca", {"messages": TALK[1:]}) == {"instruction": "2+2?", "input": None, "output": "It is. Answer: 4"}
    assert fmt(spark, "alpaca", {"question": "q", "final_answer": "a", "chain_of_thought": "c"}, template="### {instruction}") == {"instruction": "### q", "input": None, "output": "c\n\na"}
    assert fmt(spark, "alpaca", {"prompt": "p", "result": "r"}, empty_input=True) == {"instruction": "p", "input": "", "output": "r"}
    assert fmt(spark, "alpaca", {"x": "p"}) is None and fmt(spark, "alpaca", {"question": ""}) is None


def test_chat_texts(spark):
    assert fmt(spark, "chatml", {"messages": TALK[1:2]}, default_system="S")["text"] == "<|im_start|>system\nS\n<|im_end|>\n<|im_start|>user\n2+2?\n<|im_end|>"
    assert fmt(spark, "im_format", {"question": "q", "answer": "a"})["text"] == "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_end|>"
    assert [m["role"] for m in fmt(spark, "unsloth", {"messages": TALK})["conversations"]] == ["user", "assistant"]
    assert fmt(spark, "unsloth", {"messages": []}) is None and fmt(spark, "im_format", {"other": 1}) is None
    h = fmt(spark, "harmony", {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "t", "tool_calls": [{"function": {"name": "f"}}, {"function": {"name": "g"}}]}, {"role": "assistant", "content": "w", "thinking": "x"}]})["text"]
    assert "<|start|>assistant<|channel|>commentary<|recipient|>functions.f<|message|>\nt" in h and "functions.g" in h and "<|channel|>analysis<|message|>\nw" in h


def test_grpo_reasoning(spark):
    last = lambda s: fmt(spark, "grpo", s)["messages"][-1]["content"]
    assert last({"messages": TALK}) == "<start_working_out>It is.<end_working_out><SOLUTION>4</SOLUTION>"
    assert last({"question": "q", "answer": "5"}) == "<start_working_out>Let me solve this step by step.<end_working_out><SOLUTION>5</SOLUTION>"
    assert last({"messages": TALK[:2], "reasoning_trace": [{"thought": "a", "action": "b"}, {"thought": "c", "action": "c"}], "final_answer": "9"}) == "<start_working_out>a b c<end_working_out><SOLUTION>9</SOLUTION>"
    assert fmt(spark, "unsloth_grpo", {"messages": [TALK[1], {"role": "assistant", "content": "<think> r </think> done"}]})["conversations"][1]["content"] == "<think>\nr\n</think>\n\ndone"


def test_tools(spark):
    sample = {"question": "w?", "tool_used": "get_weather", "tool_input": "{'location': 'Rome'}", "tool_output": "{\"t\": 3}", "answer": "cold", "available_tools": [{"name": "get_weather", "description": "d", "parameters": [{"name": "location", "type": "str", "description": "p"}]}]}
    x = fmt(spark, "single_tool_call", {**sample, "additional_tools": [{"name": "f", "arguments": {}, "result": "ok"}]})["messages"]
    assert [m["role"] for m in x] == ["system", "user", "assistant", "tool", "assistant", "tool", "assistant"]
    assert x[2]["content"] == 'I\'ll check the weather in Rome for you.\n\n<tool_call>\n{"name": "get_weather", "arguments": {"location": "Rome"}}\n</tool_call>' and x[3]["content"] == '{"t": 3}' and x[5]["content"] == '{"result": "ok"}'
    y = fmt(spark, "tool_calling", {**sample, "tool_input": "plain", "result_interpretation": "so"})["messages"]
    assert '"arguments": {"input": "plain"}' in y[2]["content"] and y[-1]["content"] == "so\n\ncold" and y[0]["content"].endswith("</tools>")
    assert fmt(spark, "tool_calling", {"question": "q"}) is None
    call = {"from": "function_call", "value": '{"name": "f", "arguments": {}}'}
    turns = [{"from": "human", "value": "a"}, call, {"from": "observation", "value": "b"}, {"from": "gpt", "value": "c"}]
    good = {"turns": turns, "available_tools": [{"name": "f"}], "domain_policy": "", "system": "s"}
    z = fmt(spark, "xlam_v2", good)
    assert z["system"] == "s" and len(z["conversations"]) == 4 and json.loads(z["tools"])[0]["description"] == "Function f"
    assert fmt(spark, "xlam_v2", {**good, "turns": turns[1:]}) is None and fmt(spark, "xlam_v2", {**good, "turns": [turns[0], call, turns[3]]}) is None and fmt(spark, "xlam_v2", {**good, "available_tools": []}) is None


def test_gates(spark):
    ok = lambda r: one(spark, G.training_record, json.dumps(r))
    assert ok({"messages": TALK}) == [] and "only_messages" in ok({"messages": TALK, "x": 1}) and "not_empty" in ok({"messages": []}) and "assistant_last" in ok({"messages": TALK[:2]}) and "types" in ok({"messages": [{"role": "assistant", "content": 3}]})
    assert one(spark, G.trim, "one two three", "two").items() >= {"start_char": 4, "end_char": 7}.items() and one(spark, G.trim, "one", "one") is None
    valid = lambda q, c, a: one(spark, T.valid_question, q, c, a)
    assert valid("What is it?", "ctx", "ans") and not valid("What is it", "ctx", "ans") and valid("odd alpha beta gamma delta?", None, "x") and not valid("odd alpha beta gamma delta?", "c", "x") and valid("cats 3 alpha beta gamma delta?", "cat", "x")
    assert not valid(" ".join(["is"] * 26) + "?", "c", "a")
    assert one(spark, T.may_rephrase, "You said that things fall apart") and not one(spark, T.may_rephrase, "“What a day it was") and not one(spark, T.may_rephrase, "short")
    assert one(spark, G.reasoning_lines, "a\n 1. b\nreasoning: c") == ["1. b", "reasoning: c"]
    assert one(spark, lambda r, e: Q.failure_kind(r, e), "", "Connection lost") == "api_errors" and one(spark, lambda r, e: Q.failure_kind(r, e), " ", "") == "empty_responses"


def test_text_udfs(spark):
    assert U.span_in("He said “Yes, now” again", '"Yes, now"') == (9, 17) and U.span_in("He said: yes now. Go", "yes now.") == (9, 16) and U.span_in("unknown", "know") is None and U.span_in("a b", "...") is None
    assert U.parse_list("x ['a', 'it's'] y") == ["a", "it’s"] and U.parse_list("none") == [] and U.parse_list("[1, [2]]") == ["1", "[2]"]
    assert " ".join(t for t, _ in K.pack("One. Two three. " + "x" * 90, 10, K.Quarters())).replace(" ", "") == ("One. Two three. " + "x" * 90).replace(" ", "")
    assert one(spark, U.clock_numbers, '{"start": 1:30, "n": 07}') == '{"start": 90.0, "n": 7}'
    assert one(spark, R.math_answer, "1,234.5678") == "1234.57" and one(spark, R.math_answer, "2, 3") == "2" and one(spark, R.math_answer, "x") is None
    assert one(spark, T.fingerprint, "A, b!", "C") == one(spark, T.fingerprint, "a b", "c?")


def test_split_has_a_validation_row_and_keeps_keys_together(spark):
    rows = spark.createDataFrame([(i // 3, i) for i in range(60)], "k long, v long")
    out = Q.split(rows, "k", 0.9).groupBy("k").agg(F.countDistinct("split").alias("n"), F.first("split").alias("s")).collect()
    assert all(r.n == 1 for r in out) and sum(r.s == "train" for r in out) == 18
    assert {r.split for r in Q.split(rows.filter("k < 2"), "k", 1.0).collect()} == {"train", "val"}
    assert Q.sample(rows, "v", 0.03, 50).count() == 50 and Q.sample(rows.limit(0), "v").count() == 0
    texts = ["the quick brown fox jumps over", "the quick brown fox jumps over!", "else entirely, no relation here", "rehtona text", "another text"] + ["x" * 40 + c for c in "abc"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    want = {(i, j) for i, a in enumerate(texts) for j, b in enumerate(texts) if i != j and SequenceMatcher(None, a, b).ratio() >= 0.95}
    for block in (2000, 3):
        assert {(r.key_a, r.key_b) for r in Q.near_duplicates(df, "k", "t", df, block=block).collect()} == want


def test_alike_texts_of_all_lengths_against_brute_force(spark, monkeypatch):
    import random

    rng = random.Random(5)

    def edited(t, n):
        t = list(t)
        for _ in range(n):
            i = rng.randrange(len(t) + 1)
            t[i : i + rng.randrange(2)] = rng.choice(["", "q", "é", "ab"])
        return "".join(t)

    made = [lambda n: "".join(rng.choice("ab") for _ in range(n)), lambda n: "".join(rng.choice("0123456789abcdef😀") for _ in range(n)), lambda n: ("head of all texts, " + "".join(rng.choice("xyz") for _ in range(7)) * n)[:n], lambda n: "a" * n]
    texts = ["", None]
    for n in (1, 2, 9, 10, 19, 20, 32, 38, 39, 60, 199, 230, 700):
        for make in made:
            t = make(n)
            texts += [t, t] + [edited(t, rng.randrange(1 + n // 12)) for _ in range(2)] + [t[n // 20 :], t[: n - n // 30]]
    rows = list(enumerate(texts)) + [(3, texts[3]), (4, texts[20])]
    df = spark.createDataFrame(rows, "k long, t string")
    picked = df.filter("k % 2 = 0")
    for least in (0.95, 0.9, 0.8):
        want = {(i, j) for i, a in rows if i % 2 == 0 and a for j, b in rows if i != j and b and 2 * min(len(a), len(b)) >= least * len(a + b) and SequenceMatcher(None, a, b).ratio() >= least}
        for heavy in (Q.HEAVY, 1e-9):
            monkeypatch.setattr(Q, "HEAVY", heavy)
            got = [(r.key_a, r.key_b) for r in Q.near_duplicates(df, "k", "t", picked, least, 100).collect()]
            assert set(got) == want and len(want) > 200
        first = {r.key_a: r.key_b for r in Q.first_alike(df, "k", "t", picked, least).collect()}
        assert first == {i: min(j for x, j in want if x == i) for i in {x for x, _ in want}}


def test_alike_texts_are_met_by_keys_and_copies_are_not_listed(spark, monkeypatch):
    monkeypatch.setattr(Q, "_compared", lambda *a: (_ for _ in ()).throw(AssertionError("all pairs")))
    rows = spark.range(30_000).selectExpr("id AS k", "CASE WHEN id % 3 = 0 THEN 'one and the same answer' ELSE md5(id - id % 3 || '') || CASE WHEN id % 3 = 2 THEN 'z' ELSE '' END END AS t")
    got = {r.key_a: r.key_b for r in Q.first_alike(rows, "k", "t", rows).collect()}
    assert got == {i: (3 if i == 0 else 0) if i % 3 == 0 else i + 1 if i % 3 == 1 else i - 1 for i in range(30_000)}


def test_near_duplicates_make_no_blocks_of_all_pairs(spark):
    rows = spark.range(2_000).selectExpr("id % 1000 || CASE WHEN id < 1000 THEN '' ELSE 'c' END AS k", "substr(md5('' || id % 1000), 1, 31) || CASE WHEN id < 1000 THEN 'y' ELSE 'z' END AS t")
    found = Q.near_duplicates(rows, "k", "t", rows.filter("k LIKE '%7'"), block=400)
    assert "CoGroup" not in found._jdf.queryExecution().executedPlan().toString()
    assert {(r.key_a, r.key_b, r.ratio) for r in found.collect()} == {(str(i), f"{i}c", 0.96875) for i in range(7, 1000, 10)}


def test_topics(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "b"), ("a", "d")], "parent_id string, child_id string")
    assert {r.id for r in P.cyclic_nodes(e).collect()} == {"b", "c"}
    paths = {"".join(r.path) for r in P.root_paths(e, spark.createDataFrame([("a",)], "id string")).collect()}
    assert paths == {"ad"}
    tree = P.build_tree(spark, "r", spark.createDataFrame([("r", 1, "x")], "parent string, rank int, child string"), 2, 2)
    assert {tuple(r.path) for r in tree.collect()} == {("r", a, f"subtopic_{i}_for_{a}") for a in ("x", "subtopic_2_for_r") for i in (1, 2)}
    assert P.fits(4, 2, 2, 3) == (True, []) and P.fits(5, 2, 2, 3) == (False, [(1, 8), (2, 4), (4, 2)])


def test_files(spark, tmp_path):
    p = tmp_path / "ep1.jsonl"
    p.write_text('{"text": " hi ", "start": "x", "speaker": ""}\n\n{"episode_id": "e", "text": "b", "start": 1, "end": 2.5, "speaker": "S"}\n')
    rows = D.segments(spark, str(p)).orderBy("seq").collect()
    assert [(r.episode_id, r.seq, r.speaker, r.text) for r in rows] == [("ep1", 1, "Unknown", "hi"), ("e", 3, "S", "b")] and rows[0].start != rows[0].start and rows[1].end == 2.5
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n{oops\n')
    assert [r.valid for r in D.jsonl(spark, str(tmp_path / "bad.jsonl")).collect()] == [True, False]
    try:
        D.jsonl(spark, str(tmp_path / "bad.jsonl"), strict=True).collect()
        raise AssertionError
    except Exception as e:  # noqa: BLE001
        assert "line 2" in str(e)
    t = tmp_path / "t.txt"
    t.write_text("intro\n[00:10] Ann: hello\nmore\n[01:00] Bob: bye\n")
    assert [(r.speaker, r.text) for r in D.transcript(spark, str(t)).orderBy("seq").collect()] == [("speaker_0", "intro"), ("Ann", "hello more"), ("Bob", "bye")]
    D.write_jsonl(spark.createDataFrame([(2, None), (1, "x")], "i int, s string"), str(tmp_path / "out"), "i", one_file=True)
    got = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert got == [{"i": 1, "s": "x"}, {"i": 2, "s": None}]
    m = D.manifest(spark, [str(p)])
    assert m.collect()[0].records == 2 and D.same_manifest(m, m).count() == 0
    assert [r.value for r in D.audit_table(spark.createDataFrame([("a", None)], "p string, q string")).orderBy("k").collect()] == ["| p | q |", "| --- | --- |", "| a | - |"]


def test_graph_bounds_are_not_passed_over_in_silence(spark):
    chain = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(8)], "parent_id string, child_id string")
    root = spark.createDataFrame([("n0",)], "id string")
    with pytest.raises(ValueError):
        P.cyclic_nodes(chain, 2)
    assert P.cyclic_nodes(chain).count() == 0
    with pytest.raises(ValueError):
        P.root_paths(chain, root, 8)
    assert [len(r.path) for r in P.root_paths(chain, root, 9).collect()] == [9]
