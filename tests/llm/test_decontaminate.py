import itertools
import random

import pytest

from tessera.llm import decontaminate as D

SCHEMA = "doc_id long, text string, item_id string, matches string"


def slow(docs, items, least=13):
    """Every diagonal of every pair, the best stretch by the same scores."""
    out = set()
    for i, t in docs:
        d = D.tokens(t)
        for k, b in items:
            item = D.tokens(b)
            top = 0
            for shift in range(-len(item) + 1, len(d)):
                gain = run = length = same = 0
                for j in range(max(0, -shift), min(len(item), len(d) - shift)):
                    e = item[j] == d[j + shift]
                    run, length, same = (run + 1, length + 1, same + 1) if e else (run - D.WRONG, length + 1, same)
                    if run <= 0:
                        run = length = same = 0
                    if run > gain:
                        gain, best = run, (length, same)
                if gain and (best[0] >= min(least, len(item)) or 5 * best[1] > 4 * len(item)) and (len(item) >= D.SPAN or best[1] == len(item)):
                    top = max(top, best[1])
            if top:
                out.add((i, k))
    return out


def test_any_two_substitutions_in_thirteen_leave_a_seed():
    for bad in itertools.combinations(range(13), 2):
        assert any(not {s + k for k in m} & set(bad) for m in D.MASKS for s in range(13 - D.SPAN + 1))


def test_every_stretch_that_can_score_best_holds_a_hit():
    def stretches(n):
        """Places of the substitutions of which no beginning and no end scores under zero."""
        open_ = [(0, frozenset())]
        for i in range(n):
            open_ = [(g + 1, bad) for g, bad in open_] + [(g - D.WRONG, bad | {i}) for g, bad in open_ if g >= D.WRONG]
        for _, bad in open_:
            score, fine = 0, True
            for i in reversed(range(n)):
                score += -D.WRONG if i in bad else 1
                fine = fine and score >= 0
            if fine:
                yield bad

    for n in range(D.SPAN, 31):
        assert all(any(not any(s + k in bad for k in m) for m in D.MASKS for s in range(n - m[-1])) for bad in stretches(n)), n


def test_documents_that_begin_or_end_inside_an_item():
    words = [f"w{i}" for i in range(12)]
    seeds = D.Seeds.of([(1, " ".join(words))])
    for part in (words[2:], words[:10], ["x", *words[2:]], [*words[:10], "y"], words):
        assert [x[0] for x in seeds.overlaps(" ".join(part), 13)] == [0], part
    assert seeds.overlaps(" ".join(words[3:]), 13) == []


def test_repeated_words_take_time_in_proportion_to_the_diagonals():
    import time

    n = 3000
    for text, item in (("the " * n, "the " * n), ("a b " * n, "b a " * (n // 2)), ("the " * n + "end", "the " * 200 + "stop")):
        seeds = D.Seeds.of([(1, item)])
        began = time.time()
        got = seeds.overlaps(text, 13)
        assert got and time.time() - began < 5
    small = "to be or " * 9
    want = slow([(1, small)], [(2, "be or to be or to be or to be or to be")])
    assert {(1, 2)} == want and D.Seeds.of([(2, "be or to be or to be or to be or to be")]).overlaps(small, 13)[0][4] == 13


def test_scripts_without_spaces():
    text = "これは秘密の試験問題の文章であり訓練には使わないこと"
    seeds = D.Seeds.of([(1, text)])
    assert [x[0] for x in seeds.overlaps("前置き。" + text[:12] + "X" + text[13:] + "後書き", 13)] == [0]
    assert seeds.overlaps("全く別の内容を述べる長い文章がここに続いている", 13) == [] and D.tokens("ab 日本c") == ["ab", "日", "本", "c"]


def test_items_of_one_text_and_very_long_texts(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(1, "word " * 300_000 + item, "x", None), (2, "clean", None, None)], SCHEMA)
    items = spark.createDataFrame([(i, item) for i in range(30)], "item_id long, text string")
    for block in (10**6, 200):
        assert sorted((r.doc_id, r.item_id, r.matches) for r in D.find(docs, items, block_chars=block).collect()) == [(1, i, 20) for i in range(30)]
        assert [r.doc_id for r in D.remove(docs, items, block_chars=block).collect()] == [2]


@pytest.mark.parametrize("block_chars", [10**6, 300])
def test_against_every_diagonal(spark, block_chars):
    rng = random.Random(4)
    word = lambda: rng.choice("abcdefgh") + rng.choice("ijklmn")
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((1, 4, 8, 9, 13, 20, 30, 60))]
    docs = [(0, None), (1, ""), (2, "aj"), (3, " ".join(word() for _ in range(300)))]
    for k, b in items[1:]:
        for wrong in (0, 1, 2):  # a word in 13 each
            w = b.split()
            for i in rng.sample(range(len(w)), min(wrong * max(1, len(w) // 13), len(w) - 1)):
                w[i] = "zz"
            fill = " ".join(rng.choice("pqrstu") + rng.choice("vwxyz") for _ in range(40))
            docs.append((len(docs), f"{fill} {' '.join(w).upper()}, {fill}"))
    docs.append((docs[-1][0], docs[-1][1]))
    d = spark.createDataFrame([(i, t, "x", None) for i, t in docs], SCHEMA)
    b = spark.createDataFrame([*items, (None, None), items[3], (70, "")], "item_id long, text string")
    got = [(r.doc_id, r.item_id) for r in D.find(d, b, block_chars=block_chars).collect()]
    want = slow(docs, items[1:])
    one = {(i, k) for i, k in got if k == 0}
    assert {x for x in got} - one == want and len(got) - len([x for x in got if x[1] == 0]) >= len(want)
    left = D.remove(d, spark.createDataFrame(items[1:], "item_id long, text string"), block_chars=block_chars)
    assert sorted(r.doc_id for r in left.collect()) == sorted(i for i, _ in docs if i not in {x for x, _ in want}) and left.columns == d.columns


def test_empty_tables(spark):
    d, b = spark.createDataFrame([(1, "x", "i", "m")], SCHEMA), spark.createDataFrame([], "item_id long, text string")
    assert D.find(d, b).count() == 0 and D.remove(d, b).count() == 1 and D.find(d.limit(0), b).count() == 0
