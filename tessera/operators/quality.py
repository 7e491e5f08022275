"""Sampling, splits, leakage, duplicates, roll-ups and statistics over records.

Order is explicit: records carry an index or key, and anything seeded is a hash of seed and key, so results do not depend on
partitioning, and nothing needs all rows in one task.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.sources.shared import discard, materialise

#: What an error of a remote service says.
SERVICE_ERRORS = ("timeout", "rate limit", "connection")


def hash_rank(key: Column, seed: int) -> Column:
    """A key's place in the seeded order: 16 hex digits that sort."""
    return F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), key.cast("string")), 256), 1, 16)


def _cut(df: DataFrame, key_col: str, seed: int, k: int, digits: int = 3, few: int = 4096) -> str:
    """The k-th least hash, by counts of its leading digits: the range that holds it is halved 12 bits a pass, until ``few`` are left.

    Each pass is a partial aggregate of 4,096 groups; no task sorts or holds the rows.
    """
    rows = df.select(hash_rank(F.col(key_col), seed).alias("h"))
    head, before = "", 0
    while len(head) < 16:
        own = rows.filter(F.startswith("h", F.lit(head)))
        n = min(len(head) + digits, 16)
        left = 0
        for r in own.groupBy(F.substring("h", 1, n).alias("p")).count().orderBy("p").collect():
            if before + r["count"] >= k:
                head, left = r.p, r["count"]
                break
            before += r["count"]
        if left <= few:
            return rows.filter(F.startswith("h", F.lit(head))).orderBy("h").limit(k - before).agg(F.max("h")).first()[0]
    return head


def sample(df: DataFrame, key_col: str, rate: float = 0.03, least: int = 50, seed: int = 7) -> DataFrame:
    """The max(least, round(n * rate)) rows of least hash; none at a rate of zero or less, all at one or more."""
    rate = min(rate, 1.0)
    n = df.count() if rate > 0 else 0
    k = min(n, max(least, round(n * rate)))
    if k <= 0:
        return df.limit(0)
    return df if k == n else df.filter(hash_rank(F.col(key_col), seed) <= _cut(df, key_col, seed, k))


def split(df: DataFrame, key_col: str, train: float = 0.9, seed: int = 7) -> DataFrame:
    """Adds ``split``: int(n * train) keys of least hash are train, one key at least is val (two keys or more given)."""
    keys = df.select(key_col).distinct()
    n = keys.count()
    k = min(int(n * train), n - 1) if n > 1 else int(n * train)
    cut = _cut(keys, key_col, seed, k) if k > 0 else ""
    return df.withColumn("split", F.when(hash_rank(F.col(key_col), seed) <= F.lit(cut), "train").otherwise("val"))


def bucket_split(df: DataFrame, key_col: str, train_percent: int = 90, seed: int = 7) -> DataFrame:
    """As split(), by a bucket of the hash: no pass before, and a key's side never changes as others come."""
    return df.withColumn("split", F.when(T.hash_mod(F.concat(F.lit(f"{seed}:"), F.col(key_col).cast("string")), 100) < train_percent, "train").otherwise("val"))


def leakage(a: DataFrame, b: DataFrame, key_col: str) -> DataFrame:
    """Keys on both sides."""
    return a.select(key_col).intersect(b.select(key_col))


def align(left: DataFrame, right: DataFrame, index: str = "record_index") -> DataFrame:
    """Rows of two files by position, with ``aligned``: both sides have the row."""
    l, r = left.withColumn("_l", F.lit(1)), right.withColumn("_r", F.lit(1))
    return l.join(r, index, "full").withColumn("aligned", F.col("_l").isNotNull() & F.col("_r").isNotNull()).drop("_l", "_r")


def exact_duplicates(df: DataFrame, key_col: str, fingerprint: Column) -> DataFrame:
    """(key, first_key, copies): rows whose fingerprint an earlier key has too. Groups are counted, never listed."""
    rows = df.select(F.col(key_col).alias("key"), fingerprint.alias("f"))
    groups = rows.groupBy("f").agg(F.min("key").alias("first_key"), F.count("*").alias("copies")).filter("copies > 1")
    return rows.join(groups, "f").filter("key <> first_key").select(F.col("key").alias(key_col), "first_key", "copies")


def ratio(a: Column, b: Column) -> Column:
    """Similarity of two texts by matching blocks, 0 to 1; a bound on their characters is tried first."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series([SequenceMatcher(None, p or "", q or "").ratio() for p, q in zip(x, y)])

    run.__annotations__ = {"x": pd.Series, "y": pd.Series, "return": pd.Series}
    return F.pandas_udf(run, "double")(a, b)


#: The widest spread of edits for which pieces are the keys, the texts whose pieces are counted, the share of them that
#: makes a piece heavy, the parts that a heavy piece is dealt into, and the keys a batch.
SPREAD, COUNTED, HEAVY, PARTS, KEYS = 0.25, 20_000, 0.01, 16, 50_000


def distinct_texts(df: DataFrame, text_col: str, sample: DataFrame) -> DataFrame:
    """(id, t, picked): each text of both frames but null and empty ones once, in the shared folder; whether the sample has it."""
    own = lambda d, p: d.select(F.col(text_col).alias("t"), F.lit(p).alias("picked")).filter("t is not null and t <> ''")
    every = own(df, False).union(own(sample, True)).groupBy("t").agg(F.max("picked").alias("picked"))
    return materialise(every.select(F.monotonically_increasing_id().alias("id"), "t", "picked"), "texts")


def _keys(least: float, heavy: dict, side: str):
    """An Arrow function, whole in itself, from (id, t) to (piece, part, id, n, low, high, z0 to z3): keys with the first and last place of the piece, and
    counts of characters in 16 bins. side: ``row`` gives as many disjoint pieces as edits and one more, the least frequent first;
    ``picked`` all pieces that such a row may have; ``all`` all disjoint pieces."""
    import math

    import numpy as np
    import pyarrow as pa

    sizes: dict[int, list[int]] = {}

    def edits(n: int) -> int:
        """The most characters that a text of n characters and an alike one have unmatched, both counted."""
        return int(n * 2 * (1 - least) / least + 1e-6)

    def size(n: int) -> int:
        """The length of a text's pieces, a fifth more of them at least than are needed: one, two or three times a power of two, so that
        alike texts have few different ones. 0 if only an equal text can be alike."""
        most = max(1, int(n / (1.2 * (edits(n) + 1))))
        return max(x << k for x in (1, 2, 3) for k in range(most.bit_length()) if x << k <= most) if edits(n) else 0

    def pieces(t: str) -> tuple[list[str], list[int]]:
        n = len(t)
        if side == "picked":
            if n not in sizes:
                low, high = math.ceil(n * least / (2 - least) - 1e-6), int(n * (2 - least) / least + 1e-6)
                sizes[n] = sorted({size(m) for m in range(low, high + 1)} - {0})
            return [t[i : i + q] for q in sizes[n] for i in range(n - q + 1)], [i for q in sizes[n] for i in range(n - q + 1)]
        q = size(n)
        at = list(range(0, n - q + 1, q)) if q else []
        if side == "row":
            if heavy:
                at.sort(key=lambda i: heavy.get(t[i : i + q], 0))
            at = sorted(at[: edits(n) + 1])
        return [t[i : i + q] for i in at], at

    def run(batches):
        keys, parts, lows, highs = [], [], [], []
        ids, lengths, bins, times = [], [], [], []

        def flush():
            each = lambda x, k: np.repeat(np.array(x, k), times, axis=0)
            z = each(np.array(bins, np.int64).reshape(-1, 4), np.int64)
            arrays = [pa.array(keys, pa.string()), pa.array(parts, pa.int32()), pa.array(each(ids, np.int64)), pa.array(each(lengths, np.int32)), pa.array(lows, pa.int32()), pa.array(highs, pa.int32()), *[pa.array(z[:, i]) for i in range(4)]]
            for x in (keys, parts, lows, highs, ids, lengths, bins, times):
                x.clear()
            return pa.RecordBatch.from_arrays(arrays, ["piece", "part", "id", "n", "low", "high", "z0", "z1", "z2", "z3"])

        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found, at = pieces(t)
                if not found:
                    continue
                last, first = dict(zip(found, at)), dict(zip(reversed(found), reversed(at)))
                began = len(keys)
                for piece, high in last.items():
                    if heavy.get(piece, 0) < HEAVY:
                        keys.append(piece), parts.append(0), lows.append(first[piece]), highs.append(high)
                        continue
                    for part in range(PARTS) if side == "picked" else (i % PARTS,):
                        keys.append(piece), parts.append(part), lows.append(first[piece]), highs.append(high)
                code = np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32)
                bins.append(np.minimum(np.bincount((code + (code >> 6) * 9) & 15, minlength=16), 65535).astype("<u2").view("<i8"))
                ids.append(i), lengths.append(len(t)), times.append(len(keys) - began)
                if len(keys) >= KEYS:
                    yield flush()
        if keys:
            yield flush()

    return run


_KEY = "piece string, part int, id long, n int, low int, high int, z0 long, z1 long, z2 long, z3 long"


def alike_texts(texts: DataFrame, least: float = 0.95, block: int = 2000) -> DataFrame:
    """(a, b, ratio): for each picked text of distinct_texts(), every other text whose ratio reaches ``least``. Exact.

    Two texts with d characters unmatched share one of any d + 1 disjoint pieces of either, moved by d places at most; so a few pieces
    of each text meet all pieces of the picked ones in a join. Lengths, places and counts of characters part chance meetings, and what
    is left goes to the matcher. Which pieces are taken depends on counts over some texts, the result does not; the pieces that many
    texts have are dealt into parts. Where ``least`` allows so many edits that pieces are too short, blocks are compared instead.
    """
    picked = texts.filter("picked")
    if 2 * (1 - least) / least > SPREAD:
        return _compared(texts.select(F.col("id").alias("key"), "t"), picked.select(F.col("id").alias("k"), F.col("t").alias("s")), least, block)
    total = texts.count()
    some = texts.filter(F.pmod(F.xxhash64("t"), F.lit(-(-total // COUNTED))) == 0) if total > COUNTED else texts
    counted = some.select("id", "t").mapInArrow(_keys(least, {}, "all"), _KEY).groupBy("piece").count().filter("count > 8").orderBy(F.desc("count")).limit(COUNTED).collect()
    held = max(1, min(total, COUNTED))
    heavy = {r.piece: r["count"] / held for r in counted}
    a = picked.select("id", "t").mapInArrow(_keys(least, heavy, "picked"), _KEY).hint("merge").alias("a")
    b = texts.select("id", "t").mapInArrow(_keys(least, heavy, "row"), _KEY).alias("b")
    n = F.col("a.n") + F.col("b.n")
    half = n * (least / 2) - 1e-6
    bins = lambda s, z, i: F.shiftright(F.col(f"{s}.z{z}"), 16 * i).bitwiseAND(F.lit(65535))
    apart = sum((F.abs(bins("a", z, i) - bins("b", z, i)) for z in range(4) for i in range(4)), F.lit(0))
    near = (F.col("a.id") != F.col("b.id")) & (F.least("a.n", "b.n") >= half) & (F.col("a.low") - F.col("b.high") <= F.col("a.n") - half) & (F.col("b.low") - F.col("a.high") <= F.col("b.n") - half)
    met = a.join(b, (F.col("a.piece") == F.col("b.piece")) & (F.col("a.part") == F.col("b.part")) & near & (apart <= n - 2 * half))
    pairs = met.select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    left = picked.select(F.col("id").alias("a"), F.col("t").alias("s"))
    both = pairs.join(left.hint("merge"), "a").join(texts.select(F.col("id").alias("b"), "t").hint("merge"), "b")
    return both.select("a", "b", "s", "t").mapInPandas(_matched(least), "a long, b long, ratio double")


def _counter():
    """A function, whole in itself, that counts a text's characters in 128 bins."""
    import numpy as np

    return lambda t: np.bincount(np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) % 128, minlength=128)


def _matched(least: float):
    """A function from (a, b, s, t) to (a, b, ratio) of the pairs whose ratio reaches ``least``; counts of characters bound it first."""
    counts = _counter()

    def run(batches):
        from difflib import SequenceMatcher

        import numpy as np

        for x in batches:
            found = []
            for a, b, s, t in zip(x["a"].tolist(), x["b"].tolist(), x["s"], x["t"]):
                if 2 * np.minimum(counts(s), counts(t)).sum() >= least * (len(s) + len(t)):
                    r = SequenceMatcher(None, s, t).ratio()
                    if r >= least:
                        found.append((a, b, r))
            yield pd.DataFrame(found, columns=["a", "b", "ratio"])

    return run


def _compared(rows: DataFrame, picked: DataFrame, least: float, block: int) -> DataFrame:
    """(a, b, ratio) of all pairs of rows (key, t) and picked rows (k, s), equal keys left out, that reach ``least``.

    Picked rows are dealt into groups and rows into blocks of about ``block``; all pairs of group and block are the groups of one
    cogrouped plan. A row meets a group by two bounds that lose nothing (lengths, then counts of characters, both at least the
    ratio), in one matrix operation, and only what they leave is compared.
    """
    from difflib import SequenceMatcher

    import numpy as np

    counts = _counter()
    n_groups, n_blocks = max(1, -(-picked.count() // block)), max(1, -(-rows.count() // block))
    deal = lambda c, t, n: F.pmod(F.xxhash64(c, t), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = picked.withColumn("g", deal("k", "s", n_groups)).withColumn("b", every(n_blocks))
    b = rows.withColumn("bb", deal("key", "t", n_blocks)).withColumn("gg", every(n_groups))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            table = np.array([counts(t) for t in left["s"]])
            sizes = table.sum(1)
            own, texts = left["k"].tolist(), left["s"].tolist()
            for key, t in zip(right["key"].tolist(), right["t"]):
                mine = counts(t)
                n = mine.sum()
                close = np.flatnonzero(2 * np.minimum(sizes, n) >= least * (sizes + n))
                close = close[2 * np.minimum(table[close], mine).sum(1) >= least * (sizes[close] + n)]
                for i in close:
                    if own[i] != key:
                        r = SequenceMatcher(None, texts[i], t).ratio()
                        if r >= least:
                            found.append((own[i], key, r))
        return pd.DataFrame(found, columns=["a", "b", "ratio"])

    return a.groupBy("g", "b").cogroup(b.groupBy("gg", "bb")).applyInPandas(run, "a long, b long, ratio double")


def members(df: DataFrame, key_col: str, text_col: str, texts: DataFrame) -> DataFrame:
    """(id, key): the distinct keys of each text of distinct_texts()."""
    rows = df.select(F.col(key_col).alias("key"), F.col(text_col).alias("t"))
    return rows.join(texts.select("id", "t").hint("merge"), "t").select("id", "key").distinct()


def links(texts: DataFrame, least: float, block: int = 2000) -> DataFrame:
    """alike_texts() and each picked text with itself: the matcher gives equal texts 1, whatever characters it passes over, since the
    first of the longest runs lies on the diagonal and grows to both ends."""
    own = texts.filter("picked").select(F.col("id").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("ratio")).filter(F.lit(1.0 >= least))
    return alike_texts(texts, least, block).union(own)


def near_duplicates(df: DataFrame, key_col: str, text_col: str, sample: DataFrame, least: float = 0.95, block: int = 2000) -> DataFrame:
    """(key_a, key_b, ratio): for each row of the sample (same columns), every other row whose text's ratio reaches ``least``.
    Repeated rows count once; null and empty texts are alike to none. Texts are compared once, however many rows have them."""
    texts = distinct_texts(df, text_col, sample)
    left = members(sample, key_col, text_col, texts).select(F.col("id").alias("a"), F.col("key").alias("key_a"))
    right = members(df, key_col, text_col, texts).select(F.col("id").alias("b"), F.col("key").alias("key_b"))
    found = links(texts, least, block).join(left.hint("merge"), "a").join(right.hint("merge"), "b")
    return found.filter("key_a <> key_b").select("key_a", "key_b", "ratio")


def first_alike(df: DataFrame, key_col: str, text_col: str, sample: DataFrame, least: float = 0.95) -> DataFrame:
    """(key_a, key_b): for each key of the sample the least other key that near_duplicates() would give, the pairs not listed."""
    texts = distinct_texts(df, text_col, sample)
    left = members(sample, key_col, text_col, texts).select(F.col("id").alias("a"), F.col("key").alias("key_a"))
    two = lambda rows, by: rows.withColumn("r", F.row_number().over(Window.partitionBy(by).orderBy("key"))).filter("r <= 2")
    least_two = two(members(df, key_col, text_col, texts), "id").select(F.col("id").alias("b"), "key")
    met = two(links(texts, least).join(least_two.hint("merge"), "b").select("a", "key").distinct(), "a")
    out = materialise(left.join(met.hint("merge"), "a").filter("key_a <> key").groupBy("key_a").agg(F.min("key").alias("key_b")), "alike")
    discard(texts)
    return out


def role_statistics(turns: DataFrame, id_col: str, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(role, messages, share, avg_chars) over all messages, whatever the roles are."""
    by = turns.groupBy(F.col(role_col).alias("role")).agg(F.count("*").alias("messages"), F.sum(F.length(T.given(F.col(text_col)))).alias("chars"))
    total = F.sum("messages").over(Window.partitionBy(F.lit(0)))  # a row a role
    return by.select("role", "messages", (F.col("messages") / total).alias("share"), (F.col("chars") / F.col("messages")).alias("avg_chars"))


def set_statistics(turns: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
    """(samples, messages, avg_messages, avg_chars) of a whole set."""
    row = turns.groupBy(id_col).agg(F.count("*").alias("m"), F.sum(F.length(T.given(F.col(text_col)))).alias("c")).agg(F.count("*").alias("samples"), F.coalesce(F.sum("m"), F.lit(0)).alias("messages"), F.coalesce(F.sum("c"), F.lit(0)).alias("c"))
    mean = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return row.select("samples", "messages", mean("messages", "samples").alias("avg_messages"), mean("c", "messages").alias("avg_chars"))


def kth_value(values: DataFrame, col: str, k: int, bins: int = 4096) -> float | None:
    """The k-th least of a numeric column (from 1), by histograms of a narrowing range; no task sorts or holds the rows."""
    rows = values.select(F.col(col).cast("double").alias("v")).filter("v is not null and not isnan(v)")
    low, high = rows.agg(F.min("v"), F.max("v")).first()
    before = 0
    while low is not None and low < high:
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            break
        place = F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1))
        held = rows.filter(F.col("v").between(low, high)).groupBy(place.alias("p")).agg(F.count("*").alias("n"), F.min("v").alias("a"), F.max("v").alias("b"))
        for r in held.orderBy("p").collect():
            if before + r.n >= k:
                low, high = r.a, r.b
                break
            before += r.n
    return low


def rank_percentile(values: DataFrame, col: str, p: float, skip_zero: bool = False) -> DataFrame:
    """(n, mean, value): the value of rank round((n - 1) * p), halves to even; zeros where there are no values.

    skip_zero leaves out counts of zero, as a summary of tokens does.
    """
    rows = values.filter(F.col(col).isNotNull() & (F.col(col) != 0 if skip_zero else F.lit(True)))
    n, mean = rows.agg(F.count("*"), F.avg(col)).first()
    value = kth_value(rows, col, round((n - 1) * p) + 1) if n else 0.0
    kind = values.schema[col].dataType.simpleString()
    out = values.sparkSession.createDataFrame([(n, mean or 0.0, float(value or 0.0))], "n long, mean double, value double")
    return out.select("n", "mean", F.col("value").cast(kind).alias("value"))


def histogram(df: DataFrame, value: Column, width: int) -> DataFrame:
    return df.groupBy((F.floor(value / width) * width).alias("bucket")).agg(F.count("*").alias("n"))


def roll_up(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, passed, total, rate) of boolean checks in one pass."""
    row = df.agg(F.count("*").alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in checks.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in checks)
    return row.selectExpr("total", f"stack({len(checks)}, {pairs}) AS (check, passed)").select("check", "passed", "total", F.when(F.col("total") > 0, F.col("passed") / F.col("total")).alias("rate"))


def failure_kind(response: Column, error: Column) -> Column:
    """The category of a failed generation: by the error if there is one, else by what the response looks like."""
    low, said = F.lower(error), T.given(response)
    by_error = F.when(F.contains(low, F.lit("authentication")) | F.contains(low, F.lit("api key")), "authentication_error").when(F.contains(low, F.lit("schema")), "invalid_schema").when(low.rlike("|".join(SERVICE_ERRORS)), "api_errors").otherwise("other_errors")
    by_text = F.when(T.blank(said), "empty_responses").when(said.rlike(r"[{}\[\]]"), "json_parsing_errors").otherwise("malformed_responses")
    return F.when(error.isNotNull() & (error != ""), by_error).otherwise(by_text)


def failure_summary(df: DataFrame, response_col: str, error_col: str, key_col: str, examples: int = 3) -> DataFrame:
    """(kind, n, examples): counts and the first examples, cut at 200 characters."""
    rows = df.select(failure_kind(F.col(response_col), F.col(error_col)).alias("kind"), F.col(key_col).alias("k"), F.substring(F.coalesce(F.nullif(F.col(error_col), F.lit("")), T.given(F.col(response_col))), 1, 200).alias("e"))
    w = Window.partitionBy("kind").orderBy("k")
    first = rows.withColumn("r", F.row_number().over(w)).filter(F.col("r") <= examples)
    first = first.groupBy("kind").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "e"))), lambda x: x["e"]).alias("examples"))
    return rows.groupBy("kind").agg(F.count("*").alias("n")).join(first, "kind")
