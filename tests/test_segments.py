"""Segment operators against plain Python folds, on random episodes."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import segments as S

SCHEMA = "episode_id long, seq long, start double, end double, speaker string, text string"


def episodes(n=30, seed=1):
    rng, rows = random.Random(seed), []
    for e in range(n):
        at = 0.0
        for k in range(rng.randrange(1, 14)):
            at += rng.choice([0.0, 0.5, 0.875, 1.0, 1.5, 3.0])  # exact in binary
            end = at + rng.randrange(1, 5)
            a, b = (float("nan"), float("nan")) if rng.random() < 0.08 else (at, end)
            rows.append((e, k, a, b, rng.choice(["A", "B", "a"]), rng.choice(["", "hi there", "what is it now?", "x" * 40, "How so. Fine."])))
            at = end
    return rows


def fold(rows, fits):
    out = []
    for r in rows:
        if out and out[-1][-1][0] == r[0] and fits(out[-1], r):
            out[-1].append(r)
        else:
            out.append([r])
    return sorted((g[0][0], g[0][1], len(g), " ".join(x[5] for x in g)) for g in out)


def near(gap):
    return lambda g, r: r[2] - g[-1][3] <= gap


@pytest.mark.parametrize("gap", [0.875, 1.0, 1.5])
def test_gap_merge(spark, gap):
    rows = episodes()
    got = S.merge_by_gap(spark.createDataFrame(rows, SCHEMA), gap).select("episode_id", "seq", "n", "text").collect()
    assert sorted(map(tuple, got)) == fold(rows, near(gap))


def test_gap_merge_with_cap(spark):
    rows = episodes(seed=2)
    fits = lambda g, r: near(1.5)(g, r) and len(" ".join(x[5] for x in g)) + 1 + len(r[5]) <= 60
    got = S.merge_with_cap(spark.createDataFrame(rows, SCHEMA), 1.5, 60).select("episode_id", "seq", "n", "text").collect()
    assert sorted(map(tuple, got)) == fold(rows, fits)


def test_merge_of_chunks_under_a_cap(spark):
    rows = [(1, i, s, "t" * (4 * n), n) for i, (s, n) in enumerate([("A", 3), ("A", 4), ("A", 3), ("B", 1), ("A", 9), ("A", 20)])]
    got = S.merge_small_chunks(spark.createDataFrame(rows, "episode_id long, seq long, speaker string, text string, token_count int"), 10).orderBy("seq").collect()
    assert [(r.seq, r.speaker) for r in got] == [(0, "A"), (2, "A"), (3, "B"), (4, "A"), (5, "A")]


def test_windows_shrink_to_the_budget(spark):
    rows = episodes(20, 3)
    wins = S.anchor_windows(spark.createDataFrame(rows, SCHEMA), ["a"], 3)
    got = {r.window_id: ([s.seq for s in r.segments], r.anchor_index) for r in S.shrink_windows(wins, 40).collect()}
    line = lambda r: (lambda t: f"[{t(r[2])}–{t(r[3])}] {r[4]}: {r[5]}")(lambda x: "?:??" if math.isnan(x) else f"{int(x // 60):02d}:{int(x % 60):02d}")
    want = {}
    for e in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == e]
        for i, r in enumerate(own):
            if r[4].lower() != "a":
                continue
            a, b = max(0, i - 3), min(len(own), i + 4)
            while b - a > 1 and max(1, len("\n".join(line(x) for x in own[a:b])) // 4) > 40:
                if i - a >= b - i - 1:
                    a += 1
                else:
                    b -= 1
            want[f"{e}|{r[1]}"] = ([x[1] for x in own[a:b]], i - a)
    assert got == want


def test_question_context_and_mining(spark):
    rows = [(1, 0, 0.0, 1.0, "B", "Old words."), (1, 1, 1.0, 2.0, "A", "mine"), (1, 2, 2.0, 3.0, "B", "First part."), (1, 3, 3.0, 4.0, "B", "Is it so? Yes."), (1, 4, 4.0, 5.0, "B", "  "), (1, 5, 5.0, 6.0, "A", "answer")]
    w = S.mine_question(S.question_context(S.anchor_windows(spark.createDataFrame(rows, SCHEMA), ["A"], 5)))
    got = {r.window_id: (r.context, r.context_speaker, r.local_question) for r in w.collect()}
    assert got == {"1|1": ("Old words.", "B", None), "1|5": ("First part. Is it so? Yes.", "B", "Is it so?")}
    cue = spark.createDataFrame([(1, 0, 0.0, 1.0, "B", "So let me ask: you went home. Right."), (1, 1, 1.0, 2.0, "A", "yes")], SCHEMA)
    assert [r.local_question for r in S.mine_question(S.anchor_windows(cue, ["A"], 2)).collect()] == ["you went home.?"]


def test_overlap_includes_both_ends(spark):
    rows = [(1, 0, 0.0, 1.0, "A", "one"), (1, 1, 1.0, 2.0, "a", "two"), (1, 2, float("nan"), 2.0, "A", "no"), (1, 3, 5.0, 6.0, "A", "far"), (1, 4, 2.0, 3.0, "B", "other")]
    segs = spark.createDataFrame(rows, SCHEMA)
    cites = spark.createDataFrame([(1, 1, "A", 1.0, 1.0), (1, 2, "A", 8.0, 9.0), (1, 3, "A", float("nan"), 1.0)], "episode_id long, cite long, speaker string, c_start double, c_end double")
    assert [(r.cite, r.span) for r in S.overlap_join(cites, segs).collect()] == [(1, "one two")]
    w = S.anchor_windows(segs, ["B"], 9).select(S.overlapping_text(F.lit("A"), F.lit(1.0), F.lit(1.0)).alias("x"))
    assert [r.x for r in w.collect()] == ["one two"]


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    for f in (S.merge_by_gap, S.merge_with_cap, S.merge_same_speaker, S.first_seen_speakers, lambda d: S.turn_windows(d, 0), lambda d: S.shrink_windows(S.anchor_windows(d, ["A"]), 10)):
        assert f(none).count() == 0
