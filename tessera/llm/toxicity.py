"""Toxicity by a weighted lexicon that Aho-Corasick matches in folded text.

Folding: decomposed (NFKD) without marks, lower case, homoglyphs to Latin letters, digits and signs that stand for letters to
those letters, everything else that is no letter to a space. A one stands for i as well as l, so these two fold to one letter. An
exclamation mark or bar before a letter may be a letter or a mark; a text that has any is matched both ways, and the heavier way
counts. The lexicon holds word beginnings and whole words with a weight, the log odds of their document frequency in toxic and
clean labelled rows. Matches inside an exception phrase do not count. A text's features are its summed weight and that weight per
hundred words; a logistic regression turns them into the score.

Nulls: a null text counts as empty; its score is that of a text without matches. Repeated rows each keep a row; equal texts score
alike. Without labelled rows of both classes the lexicon is SEED alone, with fixed weights. Further columns are ignored. Empty
tables give no rows.
"""

from __future__ import annotations

import bisect
import json
import math
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, fit_logistic, held_out, materialise, train_rows

#: Letters that look like Latin ones, and digits and signs written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԛ": "q", "ԝ": "w", "α": "a", "ε": "e", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
    "ø": "o", "đ": "d", "ł": "l", "ħ": "h", "ŧ": "t", "ɪ": "i", "ʀ": "r", "ɴ": "n", "ʟ": "l", "ʏ": "y", "ʙ": "b", "ɢ": "g",
    "ʜ": "h", "ᴀ": "a", "ᴄ": "c", "ᴅ": "d", "ᴇ": "e", "ᴊ": "j", "ᴋ": "k", "ᴍ": "m", "ᴏ": "o", "ᴘ": "p", "ᴛ": "t", "ᴜ": "u",
    "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ɩ": "i", "ɛ": "e", "ɔ": "o",
}
SUBSTITUTIONS = {"0": "o", "1": "i", "l": "i", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "€": "e"}
STROKES = re.compile(r"[!|](?=[^\W_])")  # that may stand for i or l
INVISIBLE = "​‌‍⁠﻿­"
#: Words that insult a person, and phrases in which they do not.
SEED = ("idiot", "moron", "imbecile", "stupid", "scum", "loser", "worthless", "pathetic", "disgusting", "trash", "clown")
EXCEPTIONS = ("trash can", "trash bin", "class clown", "clown fish", "worthless currency", "loser bracket", "white trash bag")
SEED_WEIGHT = 3.0
LEAST, MOST = 3, 12  # letters of a word beginning that may enter the lexicon


class _Fold(dict):
    def __missing__(self, c: int) -> str:
        s = chr(c)
        out = HOMOGLYPHS.get(s, s)
        out = SUBSTITUTIONS.get(out) or ("" if s in INVISIBLE or unicodedata.category(s) == "Mn" else out if out.isalpha() else " ")
        self[c] = out
        return out


_FOLD = _Fold()
_MERGED = str.maketrans({"l": "i"})


def fold(text: str | None) -> str:
    """The folded text: words of letters with single spaces between and around them."""
    t = text or ""
    if not t.isascii():
        t = unicodedata.normalize("NFKD", t)
    return " " + " ".join(t.lower().translate(_FOLD).split()) + " "


def ways(text: str | None) -> list[str]:
    """The folded text, and the one with strokes as letters where there are any."""
    t = text or ""
    return [fold(t), fold(STROKES.sub("i", t))] if ("!" in t or "|" in t) and STROKES.search(t) else [fold(t)]


@dataclass
class Model:
    """patterns: folded word beginnings (leading space) and whole words (spaces at both ends) with their weights."""

    patterns: dict[str, float]
    weights: list[float]
    exceptions: list[str] = field(default_factory=lambda: [fold(x) for x in EXCEPTIONS])

    def automaton(self):
        import ahocorasick

        out = ahocorasick.Automaton()
        for p, w in self.patterns.items():
            out.add_word(p.translate(_MERGED), (len(p), w))
        for p in self.exceptions:
            out.add_word(p, (len(p), None))
        out.make_automaton()
        return out

    def features(self, text: str | None, automaton) -> tuple[float, float, int]:
        """Summed weight, weight per hundred words, and matches; of the ways to read the text the heaviest."""
        return max(self._matched(t, automaton) for t in ways(text))

    def _matched(self, t: str, automaton) -> tuple[float, float, int]:
        """Of matches that begin at one word the heaviest counts."""
        found: dict[int, float] = {}
        free: list[tuple[int, int]] = []
        for end, (n, w) in automaton.iter(t):
            start = end - n + 1
            if w is None:
                free.append((start, end))
            elif w > found.get(start, 0):
                found[start] = w
        if free:
            starts = sorted(found)
            for a, b in free:
                for s in starts[bisect.bisect_left(starts, a) : bisect.bisect_left(starts, b)]:
                    found.pop(s, None)
        total = math.fsum(found.values())
        return total, 100 * total / max(1, t.count(" ") - 1), len(found)

    def score(self, total: float, rate: float) -> float:
        z = self.weights[0] * math.log1p(total) + self.weights[1] * math.log1p(rate) + self.weights[2]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _beginnings(text: str) -> set[str]:
    out: set[str] = set()
    for w in set(fold(text).split()):
        for k in range(LEAST, min(MOST, len(w)) + 1):
            out.add(" " + w[:k])
        if len(w) >= LEAST:
            out.add(" " + w + " ")
    return out


def choose(counts: list[tuple], n_toxic: int, n_clean: int, least_docs: int, odds: float, z: float = 6.0) -> dict[str, float]:
    """The lexicon of (pattern, toxic and clean documents of the one half, toxic and clean documents of the other).

    A pattern must be far likelier in toxic documents in both halves, and by ``z`` standard deviations in all; of patterns that
    say the same the longest stays: one goes if another, longer by a letter, holds 95 % of its toxic documents.
    """
    prior = n_toxic / (n_toxic + n_clean)
    good = {}
    for p, t1, c1, t2, c2 in counts:
        t, c = t1 + t2, c1 + c2
        expected = (t + c) * prior
        w = math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))
        both = min(t1 / (c1 + 0.5), t2 / (c2 + 0.5)) * n_clean >= 3 * n_toxic
        if both and t >= least_docs and w >= odds and t - expected >= z * math.sqrt(expected):
            good[p] = (t, w)
    longer: dict[str, int] = {}
    for p, (t, _) in good.items():
        longer[p[:-1]] = max(longer.get(p[:-1], 0), t)
    return {p: round(w, 6) for p, (t, w) in sorted(good.items()) if longer.get(p, 0) < 0.95 * t}


def train(docs: DataFrame, labels: DataFrame, bound: int = 4000, mod: int = 5, held: int = 0, most_patterns: int = 4000) -> Model:
    """Lexicon and weights from labelled rows that are not held out, about ``bound`` rows a class at most.

    Copies would count a text's words many times, so of rows that share the least hash of their word pairs one a class stays.
    """

    def thin(batches):
        import xxhash

        for b in batches:
            out = []
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                w = fold(t).split()
                out.append((min((xxhash.xxh32_intdigest(f"{a} {c}") for a, c in zip(w, w[1:])), default=0), y, t))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.string()))], ["sketch", "label", "text"])

    rows = train_rows(docs, labels, "toxic", mod, held, False, bound).mapInArrow(thin, "sketch long, label int, text string")
    rows = materialise(rows.groupBy("sketch", "label").agg(F.min("text").alias("text")).select("label", "text"), "toxic-rows")
    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        discard(rows)
        return Model({fold(w): SEED_WEIGHT for w in SEED}, [1.0, 1.0, -3.0])

    def count(batches):
        import xxhash

        seen: list[Counter] = [Counter() for _ in range(4)]
        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                seen[2 * (xxhash.xxh32_intdigest(t.encode("utf-8", "surrogatepass")) & 1) + (y == 0)].update(_beginnings(t))
        keys = list(set().union(*seen))
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), *(pa.array([x[k] for k in keys], pa.int64()) for x in seen)], ["p", "t1", "c1", "t2", "c2"])

    least_docs = max(3, math.ceil(0.01 * n_toxic))
    table = rows.mapInArrow(count, "p string, t1 long, c1 long, t2 long, c2 long").groupBy("p").agg(*(F.sum(x).alias(x) for x in ("t1", "c1", "t2", "c2")))
    t, c = F.col("t1") + F.col("t2"), F.col("c1") + F.col("c2")
    table = table.filter((t >= least_docs) & (t * n_clean > 8 * c * n_toxic)).orderBy(F.desc(t / (c + 1)), "p").limit(most_patterns)
    patterns = choose([tuple(r) for r in table.collect()], n_toxic, n_clean, least_docs, math.log(8))
    for w in SEED:
        p = fold(w)
        if not any(p.startswith(q) for q in patterns):
            patterns[p] = SEED_WEIGHT
    model = Model(patterns, [0.0, 0.0, 0.0])

    def measure(batches):
        a = model.automaton()
        for b in batches:
            x = [model.features(t, a) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v[0] for v in x], pa.float64()), pa.array([v[1] for v in x], pa.float64())], ["label", "total", "rate"])

    seen = rows.mapInArrow(measure, "label int, total double, rate double").collect()
    discard(rows)
    x = np.log1p([(r.total, r.rate) for r in seen])
    model.weights = [float(v) for v in fit_logistic(x, [r.label for r in seen], balanced=False)]
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, hits, rate) of every row."""
    said = json.dumps([model.patterns, model.weights, model.exceptions])

    def run(batches):
        m = Model(*json.loads(said))
        a = m.automaton()
        for b in batches:
            x = [m.features(t.as_py(), a) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([m.score(v[0], v[1]) for v in x], pa.float64()), pa.array([v[2] for v in x], pa.int64()), pa.array([v[1] for v in x], pa.float64())],
                ["doc_id", "score", "hits", "rate"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, hits long, rate double")


def classify(docs: DataFrame, labels: DataFrame, mod: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted, hits, rate): trained on the rows that are not held out, applied to every row."""
    out = score(docs, train(docs, labels, mod=mod, held=held))
    return out.select("doc_id", held_out(F.col("doc_id"), mod, held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "hits", "rate")


def reject(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, mod: int = 5, held: int = 0) -> DataFrame:
    """The rows of docs, with their columns, whose score is under the threshold: a filter that reads each text once."""
    model = train(docs, labels, mod=mod, held=held)
    said = json.dumps([model.patterns, model.weights, model.exceptions])

    def run(batches):
        m = Model(*json.loads(said))
        a = m.automaton()
        for b in batches:
            kept = [m.score(*m.features(t.as_py(), a)[:2]) < threshold for t in b.column("text")]
            yield b.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
