"""Benchmark decontamination by spaced-seed hashing.

Texts become lower-case word tokens; of the scripts that put no space between words (Chinese characters and kana) each character
is a token. Fixed masks of six positions in a span of nine hash the tokens of every place of the benchmark and of the documents,
blind to the positions between; equal hashes are a hit. Around a hit the two texts are laid side by side, and the stretch that
scores best (one for an equal token, minus four for another, so over 80 % are equal) is the overlap. It counts from ``least``
tokens on, or if it has over 80 % of a shorter benchmark item. Every stretch of 9 to 30 tokens that can score best holds a hit
(tests/llm goes through them). Items of 9 to 12 tokens also use three masks of three positions, of which two substitutions leave
one, whether or not the document begins or ends inside the item; shorter items use the masks' positions that they have, and must
match whole.

The benchmark is laid out in blocks of ``block_chars`` characters; each block's seeds, of bounded size, go to the executors, and
documents pass by once a block. Only words of the block's own vocabulary can hit, so all others share one number. Seeds that both
texts repeat give their differences of place, each once, not the pairs of places.

Nulls: null texts have no tokens, neither side; an item with a null id still rejects documents. Repeated documents each keep a
row, and repeated items count once; items of one text under several ids are each reported. Of overlaps with one item the one with
most equal tokens counts, of equals the first in the document. Empty tables give no rows (find) or all rows (remove). Further
columns are kept by remove().
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, materialise

#: The masks, as the positions that count.
MASKS = ((0, 3, 4, 6, 7, 8), (0, 1, 2, 3, 5, 8))
SPAN, SURE = 9, 13  # tokens of a mask's span, and tokens that hold a hit at two substitutions
#: For items of SPAN to SURE - 1 tokens, thirds of the span, of which two substitutions leave one.
THIRDS = ((0, 1, 2), (3, 4, 5), (6, 7, 8))
_ALONE = "\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(f"[{_ALONE}]|[^\\W{_ALONE}]+")
HOT = 4096  # pairs of places of one seed from which their differences are marked instead
MIX = tuple(0x9E3779B97F4A7C15 * k | 1 for k in (3, 7, 19, 41, 83, 167, 331, 661, 1327))
WRONG = 4  # an equal token scores 1, another costs this much


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def _hash(ids: np.ndarray, mask: tuple[int, ...], n: int) -> np.ndarray:
    """The masked hash at each of n places; places where a counted token is unknown (0) give 0."""
    out = np.zeros(n, np.uint64)
    known = np.ones(n, bool)
    for k in mask:
        part = ids[k : k + n]
        known &= part > 0
        out += part.astype(np.uint64) * np.uint64(MIX[k] % 2**64)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(32)
    return np.where(known, out | np.uint64(1), np.uint64(0))


@dataclass
class Seeds:
    """A block of the benchmark: item ids and tokens, vocabulary, and by mask (short ones last) sorted hashes with their places."""

    ids: list
    items: list[np.ndarray]
    vocabulary: dict[str, int]
    tables: list[tuple[tuple[int, ...], np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list[tuple]) -> Seeds:
        vocabulary: dict[str, int] = {}
        ids, items = [], []
        for i, text in rows:
            t = tokens(text)
            if t:
                ids.append(i)
                items.append(np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for w in t], np.int64))
        used = [MASKS if len(t) >= SURE else (*THIRDS, *MASKS) if len(t) >= SPAN else tuple({tuple(k for k in m if k < len(t)) for m in MASKS}) for t in items]
        masks = {m for own in used for m in own}
        tables = []
        for m in sorted(masks, key=lambda m: (-len(m), m)):
            hs, own, place = [], [], []
            for k, t in enumerate(items):
                if m in used[k]:
                    n = len(t) - SPAN + 1 if len(t) >= SURE else 1
                    hs.append(_hash(t, m, n))
                    own.append(np.full(n, k))
                    place.append(np.arange(n))
            if hs:
                h = np.concatenate(hs)
                order = np.argsort(h, kind="stable")
                tables.append((m, h[order], np.concatenate(own)[order], np.concatenate(place)[order]))
        return cls(ids, items, vocabulary, tables)

    def _shifts(self, doc: np.ndarray) -> list[tuple[int, int]]:
        """(item, place in the text less place in the item) of all hits, each once, in order."""
        padded = np.concatenate([np.zeros(SPAN - 1, np.int64), doc, np.zeros(SPAN - 1, np.int64)])
        seen: list[np.ndarray] = []
        wide = 1 << 32
        for mask, hashes, own, place in self.tables:
            n = len(padded) - mask[-1]
            if n <= 0:
                continue
            h = _hash(padded, mask, n)
            at = np.flatnonzero(h)
            left = np.searchsorted(hashes, h[at])
            hit = left < len(hashes)
            at, left = at[hit], left[hit]
            same = hashes[left] == h[at]
            at, left = at[same], left[same]
            if not len(at):
                continue
            right = np.searchsorted(hashes, h[at], "right")
            at = at - (SPAN - 1)
            seed, back, times = np.unique(left, return_inverse=True, return_counts=True)
            hot = times[back] * (right - left) > HOT
            a, k = left[~hot], (right - left)[~hot]
            pick = np.repeat(a - np.cumsum(k) + k, k) + np.arange(k.sum())
            seen.append(own[pick] * wide + np.repeat(at[~hot], k) - place[pick] + wide // 2)
            for x in np.unique(left[hot]):
                b = right[left == x][0]
                mine = at[left == x]
                for item in np.unique(own[x:b]):
                    theirs = place[x:b][own[x:b] == item]
                    marks = np.zeros(len(doc) + len(self.items[item]) + 2 * SPAN, bool)
                    off = len(self.items[item]) + SPAN
                    few, many, sign = (theirs, mine, -1) if len(theirs) <= len(mine) else (mine, theirs, 1)
                    for p in few.tolist():
                        marks[(many - p + off) if sign < 0 else (p - many + off)] = True
                    seen.append(item * wide + np.flatnonzero(marks) - off + wide // 2)
        if not seen:
            return []
        keys = np.unique(np.concatenate(seen))
        return list(zip((keys // wide).tolist(), (keys % wide - wide // 2).tolist()))

    def overlaps(self, text: str | None, least: int, first: bool = False) -> list[tuple[int, int, int, int, int]]:
        """(item, place in the text, place in the item, length, equal tokens): the best overlap with each item; first: of any one."""
        get = self.vocabulary.get
        doc = np.array([get(w, 0) for w in tokens(text)], np.int64)
        best: dict[int, tuple[int, int, int, int, int]] = {}
        for k, shift in self._shifts(doc):
            item = self.items[k]
            if k in best and best[k][4] == len(item):
                continue  # the whole item, and no place before it has more
            a, b = max(0, shift), min(len(doc), shift + len(item))
            equal = doc[a:b] == item[a - shift : b - shift]
            gain = np.concatenate([[0], np.cumsum(np.where(equal, 1, -WRONG))])
            low = np.minimum.accumulate(gain)
            end = int(np.argmax(gain - low))
            start = int(np.argmin(gain[: end + 1]))
            length, same = end - start, int(equal[start:end].sum())
            if length < min(least, len(item)) and 5 * same <= 4 * len(item):
                continue
            if len(item) < SPAN and same < len(item):
                continue
            found = (k, a + start, a + start - shift, length, same)
            if first:
                return [found]
            if k not in best or (same, -found[1]) > (best[k][4], -best[k][1]):
                best[k] = found
        return sorted(best.values())


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple]]:
    """The distinct items in blocks: each is collected alone and has block_chars characters on average, at most."""
    rows = materialise(benchmark.select(F.col(item_col).alias("i"), F.col(text_col).cast("string").alias("t")).filter("t is not null").distinct(), "benchmark-items")
    total = rows.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-total // block_chars)
    for k in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == k)
        yield [tuple(r) for r in part.orderBy("i", "t").collect()]
    discard(rows)


def find(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", least: int = 13, block_chars: int = 4_000_000) -> DataFrame:
    """(doc_id, item_id, doc_token, item_token, length, matches): each document's best overlap with each item it overlaps."""
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, doc_token long, item_token long, length long, matches long"
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for rows in _blocks(benchmark, item_col, "text", block_chars):
        sent = spark.sparkContext.broadcast(Seeds.of(rows))

        def run(batches, sent=sent):
            seeds = sent.value
            for b in batches:
                found = [(i, seeds.ids[k], *x) for i, t in zip(b.column(0).to_pylist(), b.column(1)) for k, *x in seeds.overlaps(t.as_py(), least)]
                cols = list(zip(*found, strict=True)) if found else [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["doc_id", "item_id", "doc_token", "item_token", "length", "matches"])

        part = text.mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else spark.createDataFrame([], schema)


def remove(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", least: int = 13, block_chars: int = 4_000_000) -> DataFrame:
    """The rows of docs, with their columns, that overlap no benchmark item."""
    for rows in _blocks(benchmark, item_col, "text", block_chars):
        sent = docs.sparkSession.sparkContext.broadcast(Seeds.of(rows))

        def run(batches, sent=sent):
            seeds = sent.value
            for b in batches:
                yield b.filter(pa.array([not seeds.overlaps(t.as_py(), least, True) for t in b.column("text")], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
