"""Token ids in a content-addressed store.

Encoding: the ids of whole texts as the ``tokenizers`` library gives them, without special tokens, an end id after each document.
They are got from the library word by word, which is the same: the tokenizer first splits a text by its own pattern, and merges
nothing across those splits (tests/llm compares with the library over whole texts, of many distinct words and of none). So a text
is cut where the pattern always splits, before a single space; each distinct cut of a batch is split and encoded once, and cuts of
up to LONG characters are remembered a while, in two tables of bounded size.

Chunks: a rolling hash over the last WINDOW ids ends a chunk wherever its low bits are zero, between LEAST and MOST ids; equal
passages thus cut alike, wherever they stand. A chunk's address is the BLAKE2b digest of its bytes; chunks of one address are
stored once. A recipe lists a document's addresses; its root is the Merkle root over them. Recipes lie in ascending document
order, in parts; a manifest row gives each part's documents, ids, first id and the Merkle root over its documents' roots.

Files (Parquet): ``chunks`` (address, n, data), ``recipes`` (part, place, doc_id, n_tokens, local_start, root, addresses) and
``manifest`` (part, documents, n_tokens, start, root). Data are little-endian ids of ``width`` bytes, 2 where the vocabulary allows.

Nulls: a null text counts as empty and has the end id alone. Null ids come first in the order. Rows that repeat an id follow each
other in the order of their roots. Empty tables give empty files. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import shared_dir

WINDOW, LEAST, MOST, BITS = 8, 128, 4096, 9
REMEMBERED, LONG = 450_000, 40  # cuts of text in each of two tables, and their characters at most
SPECIAL = "<|endoftext|>"
#: Fixed value: the pattern by which byte-level tokenizers find words.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space before a space, or a comma or stop that is not after a letter or digit, and what is kept for own use.
_SPACE = r"\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_ODD = rf"[{_SPACE}] |(?:^|[^\p{{L}}\p{{N}}])[.,]|\x00|<\|endoftext\|>"


class Encoder:
    """Encodes whole texts with a byte-level tokenizer file; remembers what each cut of text encodes to."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a worker has one core
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_file(path)
        size = self.tool.get_vocab_size()
        self.width = 2 if size <= 1 << 16 else 4
        self.kind = np.dtype("<u2" if self.width == 2 else "<u4")
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.opens = np.zeros(size, bool)  # ids of tokens that begin with a space
        for token, i in self.tool.get_vocab().items():
            self.opens[i] = token.startswith("Ġ")

    def _alike(self, words: list[str]) -> list[bytes]:
        """The packed ids of words of which each begins with its only space, so that they can be told apart in one text's ids."""
        out: list[bytes] = []
        for at in range(0, len(words), 512):
            group = words[at : at + 512]
            ids = np.array(self.tool.encode_batch_fast(["".join(group)], add_special_tokens=False)[0].ids, self.kind)
            starts = (np.flatnonzero(self.opens[ids]) * self.width).tolist()
            if len(starts) == len(group):
                raw = ids.tobytes()
                out += [raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)])]
            else:
                out += self._each(group)
        return out

    def _each(self, words: list[str]) -> list[bytes]:
        return [np.array(x.ids, self.kind).tobytes() for x in self.tool.encode_batch_fast(words, add_special_tokens=False)]

    def _spell(self, cuts: list[str]) -> list[bytes]:
        """The packed ids of cuts that are more than one word of letters, by the words that the tokenizer's own pattern finds."""
        apart = [_WORDS.findall(c[1:] if c[:1] == "\0" else c if c[:1] in (",", ".") and c else " " + c) for c in cuts]
        words = {w for ws in apart for w in ws}
        alike = [w for w in words if w[0] == " " and len(w) > 1 and not w[1].isspace()]
        rest = list(words.difference(alike))
        table = dict(zip(alike, self._alike(alike))) | dict(zip(rest, self._each(rest)))
        return [b"".join([table[w] for w in ws]) for ws in apart]

    def encode_batch(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        """The packed ids of each text.

        Texts are cut, and distinct cuts told apart, in Arrow; each distinct cut of the batch is then looked up once, and what
        the cuts encode to is laid out in the order of the texts, so that a text's ids are one stretch of the bytes.
        """
        array = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        odd = pc.match_substring_regex(array, _ODD)
        plain = pc.replace_substring(pc.replace_substring(array.filter(pc.invert(odd)), ",", " ,"), ".", " .")
        # what begins with a comma or stop, and what has a zero before it, has no space before it
        cuts = [pc.split_pattern(pc.binary_join_element_wise("\0", plain, ""), " ")]
        order = np.argsort(odd.to_numpy(zero_copy_only=False), kind="stable")
        special: dict[int, bytes] = {}
        loose = []
        for i in order[len(plain) :].tolist():
            t = array[i].as_py()
            if SPECIAL in t:
                special[i] = np.array(self.tool.encode(t, add_special_tokens=False).ids, self.kind).tobytes()
            loose.append([] if i in special else ["\0" + w for w in _WORDS.findall(t)])
        parts = pa.concat_arrays([*cuts, pa.array(loose, pa.list_(pa.string()))])
        coded = parts.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        got = list(map(self.known.get, distinct))
        missing = [i for i, x in enumerate(got) if x is None]
        older = self.older.get
        lost = [(i, older(distinct[i])) for i in missing]
        fresh = {distinct[i]: raw for i, raw in lost if raw is not None}
        for i, raw in lost:
            got[i] = raw
        unseen = [i for i, raw in lost if raw is None]
        one = [i for i in unseen if distinct[i].isalpha()]
        more = [i for i in unseen if not distinct[i].isalpha()]
        for at, found in ((one, self._alike([" " + distinct[i] for i in one])), (more, self._spell([distinct[i] for i in more]))):
            fresh.update(zip([distinct[i] for i in at], found))
            for i, raw in zip(at, found):
                got[i] = raw
        fresh = {x: raw for x, raw in fresh.items() if len(x) <= LONG}
        if len(self.known) + len(fresh) > REMEMBERED:  # what is still used moves on into the new table
            self.older, self.known = self.known, fresh
        else:
            self.known.update(fresh)
        laid = pa.array(got, pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(laid.buffers()[1], np.int64)[laid.offset : laid.offset + len(laid) + 1] if len(laid) else np.zeros(1, np.int64)
        data = memoryview(laid.buffers()[2]) if len(laid) and laid.buffers()[2] is not None else b""
        at = ends[np.asarray(parts.offsets) - parts.offsets[0].as_py()]
        out = [b""] * len(array)
        for k, i in enumerate(order.tolist()):
            out[i] = special[i] if i in special else bytes(data[at[k] : at[k + 1]])
        return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cuts(ids: np.ndarray) -> list[int]:
    """The ends of the chunks of an id stream."""
    n = len(ids)
    if n <= LEAST:
        return [n] if n else []
    gear = ids.astype(np.uint32) * np.uint32(0x9E3779B1)
    gear ^= gear >> np.uint32(15)
    h = gear.copy()
    power = 1
    for k in range(1, WINDOW):
        power = power * 0x85EBCA6B % 2**32
        h[k:] += gear[: n - k] * np.uint32(power)
    marks = (np.flatnonzero(h >> np.uint32(32 - BITS) == 0) + 1).tolist()
    out, start = [], 0
    for m in marks:
        while m - start > MOST:
            start += MOST
            out.append(start)
        if m - start >= LEAST:
            out.append(m)
            start = m
    while n - start > MOST:
        start += MOST
        out.append(start)
    if start < n:
        out.append(n)
    return out


def address(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def merkle(leaves: list[bytes]) -> bytes:
    """The root over the leaves in order; a level's odd one goes up as it is. Leaves and inner nodes hash apart."""
    level = [address(b"\0" + x) for x in leaves] or [address(b"")]
    while len(level) > 1:
        level = [address(b"\1" + level[i] + level[i + 1]) if i + 1 < len(level) else level[i] for i in range(0, len(level), 2)]
    return level[0]


@lru_cache(maxsize=4096)
def _shift(n: int) -> tuple[tuple[int, ...], ...]:
    """Tables by four bits: what a checksum becomes when n zero bytes follow."""
    zero = zlib.crc32(bytes(n))
    basis = [zlib.crc32(bytes(n), 1 << b) ^ zero for b in range(32)]
    out = []
    for k in range(8):
        row = [0] * 16
        for v in range(1, 16):
            low = v & -v
            row[v] = row[v ^ low] ^ basis[4 * k + low.bit_length() - 1]
        out.append(tuple(row))
    return tuple(out)


def crc_join(a: int, b: int, n: int) -> int:
    """The CRC-32 of two byte strings joined, from theirs and the second one's length."""
    for k, row in enumerate(_shift(n)):
        b ^= row[a >> 4 * k & 15]
    return b


def _slices(b: pa.RecordBatch, rows: int = 2000, size: int = 1 << 23):
    """A batch in slices of a few rows and about ``size`` bytes of text, a longer text alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < b.num_rows:
        before = ends[at - 1] if at else 0
        n = int(np.searchsorted(ends, before + size, "right")) - at
        n = max(1, min(rows, n))
        yield b.slice(at, n)
        at += n


def write(docs: DataFrame, path: str | None = None, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> str:
    """Encodes the documents into a store in a folder that all executors share; returns its path."""
    spark = docs.sparkSession
    path = path or f"{shared_dir(spark)}/tessera-tokens-{uuid.uuid4().hex}"
    file = tokenizer or default_tokenizer()

    def run(batches):
        enc = encoder(file)
        end = np.array([end_id], enc.kind).tobytes()
        seen: set[bytes] = set()
        for b in batches:
            for part in _slices(b):
                n, roots, keys, fresh, ends = [], [], [], [], [0]
                if len(seen) > 2_000_000:
                    seen.clear()
                for raw in enc.encode_batch(part.column(1)):
                    raw += end
                    ids = np.frombuffer(raw, enc.kind)
                    own, a = [], 0
                    for c in cuts(ids):
                        data = raw[a * enc.width : c * enc.width]
                        a = c
                        key = address(data)
                        own.append(key)
                        if key not in seen:  # a task's first sight of a chunk carries it
                            seen.add(key)
                            fresh.append((key, len(data) // enc.width, data))
                    n.append(len(ids))
                    roots.append(merkle(own))
                    keys.append(b"".join(own))
                    ends.append(len(fresh))
                held = pa.StructArray.from_arrays([pa.array([x[i] for x in fresh], k) for i, k in enumerate((pa.binary(), pa.int32(), pa.binary()))], ["address", "n", "data"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(roots, pa.binary()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), held)],
                    ["doc_id", "n_tokens", "root", "addresses", "fresh"],
                )

    schema = "doc_id long, n_tokens long, root binary, addresses binary, fresh array<struct<address:binary,n:int,data:binary>>"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)
    zstd = {"compression": "zstd"}
    rows.write.parquet(f"{path}/encoded", **zstd)
    rows = spark.read.schema(schema).parquet(f"{path}/encoded")
    chunks = rows.select(F.explode("fresh").alias("c")).groupBy("c.address").agg(F.first("c.n").alias("n"), F.first("c.data").alias("data"))
    chunks.write.parquet(f"{path}/chunks", **zstd)

    def place(batches):
        from pyspark import TaskContext

        part, at, start = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            n = np.array(b.column(1).to_pylist(), np.int64)
            starts = start + np.cumsum(n) - n
            k = b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, part)), pa.array(np.arange(at, at + k)), *b.columns[:2], pa.array(starts), *b.columns[2:]], ["part", "place", "doc_id", "n_tokens", "local_start", "root", "addresses"])
            at, start = at + k, start + int(n.sum())

    # rows of one id and root are alike but for their place, which ``turn`` settles, so many of them need not meet in one part
    order = [F.col("doc_id").asc_nulls_first(), "root", "turn"]
    ordered = rows.select("doc_id", "n_tokens", "root", "addresses", F.monotonically_increasing_id().alias("turn")).repartitionByRange(*order).sortWithinPartitions(*order).drop("turn")
    ordered.mapInArrow(place, "part long, place long, doc_id long, n_tokens long, local_start long, root binary, addresses binary").write.parquet(f"{path}/recipes", **zstd)
    manifest(spark, path).write.parquet(f"{path}/manifest")
    _drop(spark, f"{path}/encoded")
    return path


def _drop(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The manifest that the recipes call for: a row a part, from sums alone."""

    def roots(key, table):
        table = table.sort_by("place")
        return pa.table({"part": [key[0].as_py()], "documents": [table.num_rows], "n_tokens": [sum(table.column("n_tokens").to_pylist())], "root": pa.array([merkle(table.column("root").to_pylist())], pa.binary())})

    recipes = spark.read.parquet(f"{path}/recipes")
    parts = recipes.select("part", "place", "n_tokens", "root").groupBy("part").applyInArrow(roots, "part long, documents long, n_tokens long, root binary")
    rows, start = [], 0
    for r in sorted(parts.collect()):  # as many rows as the recipes have parts
        rows.append((r.part, r.documents, r.n_tokens, start, bytes(r.root)))
        start += r.n_tokens
    return spark.createDataFrame(rows, "part long, documents long, n_tokens long, start long, root binary")


def verify(spark: SparkSession, path: str) -> bool:
    """Whether the stored manifest is the one that the recipes call for."""
    kept = spark.read.parquet(f"{path}/manifest")
    return sorted(map(tuple, kept.collect())) == sorted(map(tuple, manifest(spark, path).collect()))


def _uses(recipes: DataFrame) -> DataFrame:
    """(root, k, address) of the distinct recipes."""
    each = recipes.groupBy("root").agg(F.first("addresses").alias("addresses"))
    at = F.sequence(F.lit(0), (F.length("addresses") / 16).cast("int") - 1)
    return each.filter(F.length("addresses") > 0).select("root", "addresses", F.explode(at).alias("k")).select("root", "k", F.col("addresses").substr(F.col("k") * 16 + 1, F.lit(16)).alias("address"))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, from the files.

    The manifest is checked first: its roots, sums and starts must be those of the recipes. Each chunk is read once: its address is
    checked against its data, and the checksum of its ids taken. Recipes join the checksums, which are combined in order, and
    their Merkle root is checked. A manifest or document that doesn't fit fails the query.
    """
    if not verify(spark, path):
        raise ValueError("the manifest is not what the recipes make")
    width = F.length("data") / F.col("n")

    def check(batches):
        for b in batches:
            out = []
            for a, n, d in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                if address(d) != a:
                    raise ValueError(f"chunk {a.hex()} does not hold what its address says")
                out.append(zlib.crc32(np.frombuffer(d, "<u2" if len(d) == 2 * n else "<u4").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.int64())], ["address", "n", "crc"])

    chunks = spark.read.parquet(f"{path}/chunks").filter(width.isNotNull()).select("address", "n", "data").mapInArrow(check, "address binary, n int, crc long")
    recipes = spark.read.parquet(f"{path}/recipes")

    def combine(batches):
        for b in batches:
            out = []
            for root, used in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                used.sort(key=lambda x: x["k"])
                if merkle([x["address"] for x in used]) != root:
                    raise ValueError(f"recipe {root.hex()} is not what its chunks make")
                crc = n = 0
                for x in used:
                    crc = crc_join(crc, x["crc"], 4 * x["n"])
                    n += x["n"]
                out.append((n, crc))
            n, crc = zip(*out, strict=True) if out else ((), ())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64())], ["root", "n_read", "ids_crc32"])

    found = _uses(recipes).join(chunks, "address").groupBy("root").agg(F.collect_list(F.struct("k", "address", "n", "crc")).alias("used")).mapInArrow(combine, "root binary, n_read long, ids_crc32 long")
    parts = F.broadcast(spark.read.parquet(f"{path}/manifest").select("part", F.col("start").alias("part_start")))  # a row a part
    out = recipes.drop("addresses").join(parts, "part").join(found, "root", "left")
    whole = F.when(F.coalesce(F.col("n_read"), F.lit(-1)) == F.col("n_tokens"), F.col("n_tokens")).otherwise(F.raise_error(F.lit("a recipe's chunks are missing")).cast("long"))
    return out.select("doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), whole.alias("n_tokens"), "ids_crc32")


def read(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids array<long>) of each document, rebuilt from the files."""

    def build(batches):
        for b in batches:
            rows = []
            for used in b.column(1).to_pylist():
                used.sort(key=lambda x: x["k"])
                rows.append(np.concatenate([np.frombuffer(x["data"], "<u2" if len(x["data"]) == 2 * x["n"] else "<u4") for x in used]).astype(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.int64()))], ["root", "ids"])

    recipes, chunks = spark.read.parquet(f"{path}/recipes"), spark.read.parquet(f"{path}/chunks")
    built = _uses(recipes).join(chunks, "address").groupBy("root").agg(F.collect_list(F.struct("k", "n", "data")).alias("used")).mapInArrow(build, "root binary, ids array<long>")
    parts = F.broadcast(spark.read.parquet(f"{path}/manifest").select("part", F.col("start").alias("part_start")))
    return recipes.join(parts, "part").join(built, "root").select("doc_id", (F.col("part_start") + F.col("local_start")).alias("start"), "ids")
