"""SentencePiece encoding and decoding by a streaming Viterbi search.

In a byte-pair vocabulary a text's encoding is the one path of pieces in which every adjacent pair is stable, which means that
the merges leave the pair as it is. All prefixes have such a path too, and it ends in one piece; so the search keeps, for each
position, the length of its last piece, and finds the next position's among the pieces that end there and are stable after what
stands before them. Only positions within the longest piece of the front can be built on. Whenever the paths back from all of
these meet at a boundary, the pieces before it are final: their ids go out, and the search forgets them. So memory is bounded by
the longest piece and the distance between such boundaries, not by the text.

Where two neighbouring characters stand together in no piece, all paths meet whatever else the text holds. These boundaries (at
spaces and line ends, and between most characters of scripts that put no space between words) need no looking back, so what lies
between two of them is a stream of its own. Streams of up to
``2 * longest`` characters are advanced side by side, a character at a time, in numpy (``searched``); a longer one goes through
``search``, which holds a window and commits as above. Equal streams of one batch of texts are searched once; nothing is
remembered from batch to batch but which pairs of pieces are stable. Batches are bounded in bytes, and a text over that bound is
taken in blocks that end at such boundaries.

Decoding joins the pieces, turns the space mark into a space and drops the one put before the text. Characters outside the
vocabulary become byte pieces and come back from them. A text that holds the space mark itself (U+2581) gets a space there.

Nulls: a null text counts as empty, which has no ids. Repeated rows each keep a row. Further columns are ignored. An empty table
gives no rows. A text without any boundary is one stream, whatever its length.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
PAIRS = 1 << 19  # pairs of pieces of which a worker remembers whether they are stable
BATCH, ROWS = 1 << 20, 1000  # bytes and rows of the texts that are searched together
BLOCK = 1 << 20  # characters of a long text that are taken at once, up to the next boundary
NEVER = float("-inf")


class Table:
    """Non-negative 63-bit keys with small numbers, looked up many at once: open addressing over arrays."""

    def __init__(self, room: int):
        self.bits = max(4, (4 * room - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.int32)
        self.held, self.room = 0, room

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where there is none."""
        at = self._slots(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.values[at], -1)
        left = np.flatnonzero((seen != keys) & (seen >= 0))
        while len(left):  # the next place, until the key or an empty one
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[left]]
            hit = seen == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (seen >= 0)]
        return out

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Adds distinct keys that the table lacks; a full table is emptied first."""
        if self.held + len(keys) > self.room:
            self.keys[:] = -1
            self.held = 0
        self.held += len(keys)
        mask = len(self.keys) - 1
        for k, slot, v in zip(keys.tolist(), self._slots(keys).tolist(), values.tolist()):
            while self.keys[slot] >= 0:
                slot = slot + 1 & mask
            self.keys[slot], self.values[slot] = k, v


class Vocabulary:
    """The pieces of a byte-pair model file with byte fallback and identity normalisation."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.ids = {p: i for i, p in enumerate(names) if not special[i]}
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(names) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.raw = [bytes([int(p[3:5], 16)]) if sp.is_byte(i) else b"" if special[i] else p.replace(MARK, " ").encode() for i, p in enumerate(names)]
        self.longest = max(map(len, self.ids))
        self.together = {a + b for p in self.ids for a, b in zip(p, p[1:])}
        assert not any(x[1] == MARK and x[0] != MARK for x in self.together), "a piece goes on past a space"
        alone = "\n" if not any("\n" in x for x in self.together) else ""
        self.cut = re.compile(f"{MARK}+[^{MARK}{alone}]*|[^{MARK}{alone}]+" + f"|{alone}" * bool(alone))
        self.solid: dict[int, bool] = {}
        self.widest = 0  # characters that search() has held at most
        # by every ending of every piece: the id if it is a piece that merging makes of its characters, else -1
        self.fits = dict.fromkeys((p[k:] for p in self.ids for k in range(len(p))), -1)
        self.fits.update((p, i) for p, i in self.ids.items() if len(p) == 1 or self.merged(p) == [p])
        self._lay_out(names)

    def _lay_out(self, names: list[str]) -> None:
        """The endings as a trie read backwards: a table from (node, character) to node, and the id at each node."""
        letters = sorted({c for p in self.ids for c in p})
        self.letter = np.zeros(0x110000, np.uint16)  # 0: in no piece
        self.letter[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.fan = len(letters) + 1
        number = {e: i for i, e in enumerate(sorted(self.fits, key=len), 1)}
        self.at_node = np.full(len(number) + 1, -1, np.int32)
        keys, values = np.empty(len(number), np.int64), np.empty(len(number), np.int32)
        for e, i in number.items():
            self.at_node[i] = self.fits[e]
            keys[i - 1] = (number[e[1:]] if len(e) > 1 else 0) * self.fan + int(self.letter[ord(e[0])])
            values[i - 1] = i
        self.trie = Table(len(number))
        self.trie.put(keys, values)
        self.names = names
        self.pairs = Table(PAIRS)
        self.pieces = pa.array(self.raw, pa.binary())

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves of a short text: the best-scored neighbours first, of equals the leftmost."""
        parts = list(text)
        score = self.score.get
        gain = [score(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while gain and (best := max(gain)) > NEVER:
            i = gain.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del gain[i]
            if i:
                gain[i - 1] = score(parts[i - 1] + parts[i], NEVER)
            if i < len(gain):
                gain[i] = score(parts[i] + parts[i + 1], NEVER)
        return parts

    def stable(self, left: str, right: str, key: int) -> bool:
        """Whether merging leaves the two pieces as they are; key tells the pair."""
        out = self.merged(left + right) == [left, right]
        if len(self.solid) >= PAIRS:
            self.solid.clear()
        self.solid[key] = out
        return out

    def _step(self, text: str, end: int, last: list[int], names: list[int], before: str, first: int) -> None:
        """Finds the last piece of the path that ends at ``end``: appends its length to last and its id to names.

        before, first: the piece that stands before the text, and its id (-1 if it is in no vocabulary, -2 if there is none).
        """
        fits, solid = self.fits, self.solid
        found = []
        i = end - 1
        while i >= 0:
            f = fits.get(text[i:end])
            if f is None:
                break
            if f >= 0:
                found.append((i, f))
            i -= 1
        for i, f in reversed(found):
            left = names[i] if i else first
            if left == -2:
                break
            if left >= 0:
                key = left << 20 | f
                same = solid.get(key)
                if same is None:
                    same = self.stable(text[i - last[i] : i] if i else before, text[i:end], key)
                if not same:
                    continue
            break  # nothing merges with a character outside the vocabulary
        else:
            i, f = end - 1, -1
        last.append(end - i)
        names.append(f)

    def spelled(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        if i is not None:
            return [i]
        if not self.bytes:
            return [self.unknown]
        return [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]

    def search(self, chars: Iterable[str]) -> Iterator[int]:
        """Ids of a stream of characters, each as soon as all surviving paths agree on it."""
        longest = self.longest
        window, before, first = "", "", -2  # what is not yet committed, and the piece before it
        last, names = [0], [-2]  # by position in the window: length and id of the last piece of the path that ends there
        for c in chars:
            window += c
            end = len(window)
            self.widest = max(self.widest, end)
            self._step(window, end, last, names, before, first)
            if end >= 2 * longest:
                agreed = self._agreed(last, end)
                if agreed:
                    yield from self._spelled(window, last, names, agreed)
                    before, first = window[agreed - last[agreed] : agreed], names[agreed]
                    window, last, names = window[agreed:], [0, *last[agreed + 1 :]], [-2, *names[agreed + 1 :]]
        yield from self._spelled(window, last, names, len(window))

    def _stable(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves each pair of pieces (ids) as it is."""
        key = left.astype(np.int64) << 20 | right
        known = self.pairs.get(key)
        if (known < 0).any():
            fresh = np.unique(key[known < 0])
            found = [self.merged(self.names[k >> 20] + self.names[k & 0xFFFFF]) == [self.names[k >> 20], self.names[k & 0xFFFFF]] for k in fresh.tolist()]
            for at in range(0, len(fresh), PAIRS):
                self.pairs.put(fresh[at : at + PAIRS], np.array(found[at : at + PAIRS], np.int32))
            left = np.flatnonzero(known < 0)
            known[left] = np.array(found, np.int32)[np.searchsorted(fresh, key[left])]
        return known > 0

    def searched(self, streams: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of streams of 1 to 2 * longest characters, one after the other, and how many each has.

        All streams take a step together; those that have ended drop out. A stream ends at a boundary on which all paths agree,
        so its ids are committed there.
        """
        n = np.fromiter(map(len, streams), np.int64, len(streams))
        order = np.argsort(-n, kind="stable")
        starts = np.cumsum(n) - n
        flat = np.frombuffer("".join(streams).encode("utf-32-le", "surrogatepass"), np.uint32)
        width = int(n.max(initial=0))
        n, starts = n[order], starts[order]
        live = [int(np.searchsorted(-n, -e, "right")) for e in range(width + 1)]  # streams that reach a position
        chars = np.zeros((width, len(n)), np.int64)
        for e in range(width):
            chars[e, : live[e + 1]] = self.letter[flat[starts[: live[e + 1]] + e]]
        last = np.ones((width + 1, len(n)), np.int8)  # by position: length and id of the last piece of the path that ends there
        names = np.full((width + 1, len(n)), -1, np.int32)
        for e in range(1, width + 1):
            rows, node, found = np.arange(live[e]), np.zeros(live[e], np.int64), []
            for k in range(1, min(e, self.longest) + 1):
                node = self.trie.get(node * self.fan + chars[e - k, rows])
                there = node >= 0
                rows, node = rows[there], node[there]
                if not len(rows):
                    break
                f = self.at_node[node]
                whole = f >= 0
                found.append((k, rows[whole], f[whole]))
            open_ = np.ones(live[e], bool)
            for k, rows, f in reversed(found):  # the longest piece that is stable after what stands before it
                free = open_[rows]
                rows, f = rows[free], f[free]
                left = names[e - k, rows]
                good = left < 0 if e > k else np.ones(len(rows), bool)
                ask = np.flatnonzero(~good)
                if len(ask):
                    good[ask] = self._stable(left[ask], f[ask])
                rows = rows[good]
                last[e, rows], names[e, rows], open_[rows] = k, f[good], False
        path = np.full((len(n), width), -2, np.int32)
        at, rows, column = n.copy(), np.arange(len(n)), width
        while len(rows):
            column -= 1
            path[rows, column] = names[at[rows], rows]
            at[rows] -= last[at[rows], rows]
            rows = rows[at[rows] > 0]
        back = np.empty(len(n), np.int64)
        back[order] = np.arange(len(n))
        path = path[back]
        counts = (path > -2).sum(1)
        ids = path[path > -2]
        if (ids < 0).any():  # characters outside the vocabulary: their bytes
            ids, counts = self._with_bytes(streams, ids, counts)
        return ids, counts

    def _with_bytes(self, streams: list[str], ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        out, took, ends = [], counts.copy(), np.cumsum(counts)
        for i in np.flatnonzero(np.bincount(np.repeat(np.arange(len(counts)), counts)[ids < 0], minlength=len(counts))).tolist():
            own, at, spelt = ids[ends[i] - counts[i] : ends[i]].tolist(), 0, []
            for x in own:
                size = 1 if x < 0 else len(self.names[x])
                spelt += [x] if x >= 0 else self.spelled(streams[i][at : at + 1])
                at += size
            out.append((i, spelt))
            took[i] = len(spelt)
        wide, at = np.empty(took.sum(), np.int32), np.cumsum(took)
        odd = dict(out)
        same = np.ones(len(counts), bool)
        same[list(odd)] = False
        wide[np.repeat(same, took)] = ids[np.repeat(same, counts)]
        for i, spelt in out:
            wide[at[i] - took[i] : at[i]] = spelt
        return wide, took

    def _agreed(self, last: list[int], end: int) -> int:
        """The furthest boundary that is on the paths back from every position on which a piece can still build."""
        fronts = set(range(max(0, end - self.longest + 1), end + 1))
        while len(fronts) > 1:
            p = max(fronts)
            fronts.discard(p)
            fronts.add(p - last[p] if p else 0)
        return fronts.pop()

    def _spelled(self, text: str, last: list[int], names: list[int], end: int) -> list[int]:
        """The ids on the path back from ``end``, in the order of the text."""
        out: list[int] = []
        while end > 0:
            i = names[end]
            out += [i] if i >= 0 else self.spelled(text[end - last[end] : end])[::-1]
            end -= last[end]
        return out[::-1]

    def _blocks(self, text: str) -> Iterator[str]:
        """A text, spaces as marks, in blocks of BLOCK characters and the rest up to a boundary."""
        at = 0
        while at < len(text):
            end = at + BLOCK
            while end < len(text) and text[end - 1 : end + 1].replace(" ", MARK) in self.together:
                end += 1
            yield text[at:end].replace(" ", MARK)
            at = end

    def _apart(self, stream: str) -> list[str]:
        """A stream cut wherever two neighbours stand together in no piece."""
        cuts = [0, *(i + 1 for i, x in enumerate(map(add, stream, stream[1:])) if x not in self.together), len(stream)]
        return [stream[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode_batch(self, texts: list[str | None] | pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, one after the other, and how many each has."""
        rows, blocks = [], []
        for i, t in enumerate(texts.to_pylist() if isinstance(texts, pa.Array) else texts):
            for k, b in enumerate(self._blocks(t or "")):
                rows.append(i)
                blocks.append(MARK + b if k == 0 else b)
        streams = [self.cut.findall(b) for b in blocks]
        for i, s in enumerate(streams):
            if max(map(len, s)) > 2 * self.longest:
                streams[i] = [y for x in s for y in (self._apart(x) if len(x) > 2 * self.longest else (x,))]
        coded = pa.array(list(chain.from_iterable(streams)), pa.string()).dictionary_encode()
        distinct, each = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        size = np.fromiter(map(len, distinct), np.int64, len(distinct))
        short, long = np.flatnonzero(size <= 2 * self.longest).tolist(), np.flatnonzero(size > 2 * self.longest).tolist()
        ids, counts = self.searched([distinct[i] for i in short])
        held = [np.fromiter(self.search(distinct[i]), np.int32) for i in long]
        counts = np.concatenate([counts, np.array([len(x) for x in held], np.int64)])
        place = np.empty(len(distinct), np.int64)
        place[short + long] = np.arange(len(distinct))
        each = place[each]
        found = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(counts)]), pa.array(np.concatenate([ids, *held]), pa.int32()))
        n = np.zeros(len(texts), np.int64)
        np.add.at(n, np.repeat(np.array(rows, np.int64), [len(s) for s in streams]), counts[each])
        return found.take(pa.array(each)).flatten().to_numpy(), n

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: Iterable[int]) -> str:
        raw = self.raw
        return b"".join([raw[i] for i in ids]).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a model file, read once a worker."""
    return Vocabulary(path)


def default_model() -> str:
    """The public byte-pair model with byte fallback."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ROWS rows and BATCH bytes of text, a longer text alone."""
    for b in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            n = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BATCH, "right")) - at
            n = max(1, min(ROWS, n))
            yield b.slice(at, n)
            at += n


def _round_trips(v: Vocabulary, texts: pa.Array, ids: np.ndarray, n: np.ndarray) -> list[bool]:
    """Whether the ids of each text decode to it."""
    said = pc.cast(v.pieces, pa.large_binary()).take(pa.array(ids))
    ends = np.frombuffer(said.buffers()[1], np.int64)[: len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
    data = memoryview(said.buffers()[2]) if len(ids) and said.buffers()[2] is not None else b""
    at = ends[np.concatenate([[0], np.cumsum(n)])].tolist()
    out = []
    for t, a, b in zip(texts.to_pylist(), at, at[1:]):
        out.append(bytes(data[a + 1 : b]) == (t or "").replace(MARK, " ").encode("utf-8", "surrogatepass"))
    return out


def encode(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>, n_tokens, round_trip): round_trip tells whether decoding gives the text again."""

    def run(batches):
        v = vocabulary(model or default_model())
        for b in _slices(batches):
            ids, n = v.encode_batch(b.column(1))
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids, pa.int32())), pa.array(n, pa.int64()), pa.array(_round_trips(v, b.column(1), ids, n), pa.bool_())],
                ["doc_id", "ids", "n_tokens", "round_trip"],
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, ids array<int>, n_tokens long, round_trip boolean")


def digest(docs: DataFrame, model: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, round_trip): as encode(), with the ids' checksum (little-endian, 32 bits) in their place."""

    def run(batches):
        v = vocabulary(model or default_model())
        for b in _slices(batches):
            ids, n = v.encode_batch(b.column(1))
            raw, at = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B"), (4 * np.concatenate([[0], np.cumsum(n)])).tolist()
            sums = [zlib.crc32(raw[x:y]) for x, y in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(sums, pa.int64()), pa.array(_round_trips(v, b.column(1), ids, n), pa.bool_())], ["doc_id", "n_tokens", "ids_crc32", "round_trip"]
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean")


def decode(tokens: DataFrame, model: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from ids; null ids give an empty text."""

    def run(batches):
        v = vocabulary(model or default_model())
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([v.decode(x.as_py() or ()) for x in b.column(1)], pa.string())], ["doc_id", "text"])

    return tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids")).mapInArrow(run, "doc_id long, text string")
