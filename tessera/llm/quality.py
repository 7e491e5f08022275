"""Quality by compression: zstandard dictionaries of good and of bad labelled text.

A text is cut into blocks of ``BLOCK`` bytes; each is compressed with either dictionary. The difference of the summed sizes says
which dictionary knows the text better; it is normalised by the sum of the sizes, by the text's bytes, and in the block where the
bad dictionary does best. A logistic regression on these three differences, and on nothing else, gives the calibrated score.
Blocks keep a dictionary's effect alike in short and long texts.

Nulls: a null text counts as empty; an empty text has the features zero and the score that goes with them. Equal texts score
alike. Repeated rows each keep a row. Without labelled rows of both classes every score is 0.5. Further columns are ignored.
Empty tables give no rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, fit_logistic, held_out, materialise, train_rows

BLOCK = 2048
LEVEL = 3


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: list[float]

    def compressors(self):
        """The compressors with the good and the bad dictionary."""
        out = []
        for raw in (self.good, self.bad):
            d = zstandard.ZstdCompressionDict(raw)
            d.precompute_compress(level=LEVEL)
            out.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_dict_id=False))
        return tuple(out)

    def score(self, x) -> float:
        z = float(np.dot(self.weights[:-1], x)) + self.weights[-1]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def features(text: str | None, tools) -> tuple[float, float, float]:
    """Size differences (bad less good) over the sum of the sizes, of the block where it is least, and over the text's bytes."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not raw:
        return 0.0, 0.0, 0.0
    good, bad = tools
    g = b = 0
    low = 1.0
    for at in range(0, len(raw), BLOCK):
        part = raw[at : at + BLOCK]
        x, y = len(good.compress(part)), len(bad.compress(part))
        g, b = g + x, b + y
        if len(part) >= 128 or at == 0:
            low = min(low, (y - x) / (x + y))
    return 10 * (b - g) / (b + g), 10 * low, 10 * (b - g) / len(raw)


def _blocks(rows: DataFrame, per_class: int) -> dict[int, list[bytes]]:
    """At most ``per_class`` blocks a class, chosen by their hash among all blocks of the training rows."""

    def run(batches):
        import xxhash

        for b in batches:
            out = []
            for y, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                raw = t.encode("utf-8", "surrogatepass")
                out += [(y, xxhash.xxh32_intdigest(p), p) for p in {raw[i : i + BLOCK] for i in range(0, len(raw), BLOCK)} if len(p) >= 32]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], k) for i, k in enumerate((pa.int32(), pa.int64(), pa.binary()))], ["label", "h", "part"])

    parts = rows.mapInArrow(run, "label int, h long, part binary")
    return {k: [bytes(r.part) for r in parts.filter(F.col("label") == k).orderBy("h", "part").limit(per_class).collect()] for k in (0, 1)}


def _dictionary(parts: list[bytes], size: int) -> bytes:
    try:
        return zstandard.train_dictionary(size, parts, level=LEVEL).as_bytes()
    except zstandard.ZstdError:  # too few samples: their text itself serves as the dictionary
        return b"".join(parts)[-size:]


def train(docs: DataFrame, labels: DataFrame, bound: int = 4000, blocks: int = 3000, size: int = 112_640, mod: int = 3, held: int = 1) -> Model:
    """Dictionaries and calibration from labelled rows that are not held out.

    ``bound``: rows a class at most (about), ``blocks``: blocks a class in a dictionary's training, ``size``: its bytes.
    Half the rows train the dictionaries, the other half the calibration, which thus sees texts new to the dictionaries.
    """
    rows = materialise(train_rows(docs, labels, "quality", mod, held, False, bound).withColumn("half", F.pmod(F.xxhash64("text", F.lit(7)), F.lit(2))), "quality-rows")
    parts = _blocks(rows.filter("half = 0").select("label", "text"), blocks)
    if not parts[0] or not parts[1]:
        discard(rows)
        return Model(b"good", b"bad", [0.0] * 4)
    model = Model(_dictionary(parts[1], size), _dictionary(parts[0], size), [0.0] * 4)

    def run(batches):
        tools = model.compressors()
        for b in batches:
            x = [features(t, tools) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float64()))], ["label", "x"])

    seen = rows.filter("half = 1").select("label", "text").mapInArrow(run, "label int, x array<double>").collect()
    discard(rows)
    if seen:
        model.weights = [float(v) for v in fit_logistic([r.x for r in seen], [r.label for r in seen], balanced=False)]
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, difference) of every row."""

    def run(batches):
        tools = model.compressors()
        for b in batches:
            x = [features(t.as_py(), tools) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([model.score(v) for v in x], pa.float64()), pa.array([v[0] / 10 for v in x], pa.float64())], ["doc_id", "score", "difference"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, "doc_id long, score double, difference double")


def classify(docs: DataFrame, labels: DataFrame, mod: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted, difference): trained on the rows that are not held out, applied to every row."""
    out = score(docs, train(docs, labels, mod=mod, held=held))
    return out.select("doc_id", held_out(F.col("doc_id"), mod, held).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "difference")
