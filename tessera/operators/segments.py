"""Utterance operators: merging across gaps, windows around an anchor, span overlap, question context and mining.

A segment is a row of (episode_id, seq, start, end, speaker, text); ``seq`` orders an episode. Times are seconds, NaN or null where
unknown. Every operator partitions by episode, so no episode flows into another, and episodes are the unit of distribution.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tessera.functions import text as T

#: Openings of a question and phrases that lead into one.
INTERROGATIVES = "who what why how where when which whom whose".split()
CUES = ("let me ask", "the question is", "the question then is", "what i am wondering", "are you saying", "would you say", "could it be that", "am i right that", "is it fair to say")


def from_conversations(turns: DataFrame) -> DataFrame:
    """Segments of a conversation table (conv_id, turn, role, text), with times derived from the texts' lengths: sixteenths of a
    second, which doubles hold exactly, so that sums do not depend on their order."""
    dur = F.length("text") / F.lit(16.0)
    pause = ((F.col("conv_id") * 7 + F.col("turn") * 13) % 5) * F.lit(0.5)
    w = Window.partitionBy("conv_id").orderBy("turn")
    end = F.sum(dur + pause).over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = turns.select("conv_id", "turn", "role", "text", dur.alias("dur"), end.alias("end"))
    return rows.select(F.col("conv_id").alias("episode_id"), F.col("turn").alias("seq"), (F.col("end") - F.col("dur")).alias("start"), "end", F.col("role").alias("speaker"), "text")


def ordered_text(order: Column, text: Column, sep: str = " ") -> Column:
    """Texts joined in the order of a column."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), T.given(text).alias("t")))), lambda x: x["t"]), sep)


def _islands(segments: DataFrame, breaks: Column, keys: tuple[str, ...] = ("episode_id",)) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy("seq")
    return segments.withColumn("island", F.sum(F.when(F.lag("seq").over(w).isNull() | F.coalesce(breaks, F.lit(True)), 1).otherwise(0)).over(w))


def combine(islands: DataFrame, sep: str = " ") -> DataFrame:
    """One row an island: texts joined in order, least start, greatest end, the first row's speaker."""
    return islands.groupBy("episode_id", "island").agg(
        F.min("seq").alias("seq"), F.count("*").alias("n"), F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("speaker", "seq").alias("speaker"), ordered_text(F.col("seq"), F.col("text"), sep).alias("text")
    )


def merge_by_gap(segments: DataFrame, max_gap: float = 1.0) -> DataFrame:
    """Segments merged while the gap to the one before is ``max_gap`` or less; an unknown time ends a group."""
    w = Window.partitionBy("episode_id").orderBy("seq")
    gap = F.col("start") - F.lag("end").over(w)
    return combine(_islands(segments, ~(~F.isnan(gap) & (gap <= max_gap))))


def numbered_by_fold(rows: DataFrame, cols: tuple[str, ...], fold: Callable[[tuple | None, tuple], tuple[bool, tuple]]) -> DataFrame:
    """rows with ``island``: fold(state, values) tells whether a row joins the open group, and the state after it.

    Rows are sorted within their partition and pass by once, in Arrow batches; only the open group's state is held, never an
    episode. The state is None at an episode's first row.
    """
    schema = StructType([*rows.schema.fields, StructField("island", LongType())])
    at = [rows.columns.index(c) for c in ("episode_id", *cols)]

    def run(batches):
        episode, state, n = object(), None, 0
        for b in batches:
            ids = []
            for e, *values in zip(*(b.column(i).to_pylist() for i in at)):
                if e != episode:
                    episode, state, n = e, None, 0
                joins, state = fold(state, values)
                n += not joins
                ids.append(n)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(ids, pa.int64())], [*b.schema.names, "island"])

    return rows.repartition("episode_id").sortWithinPartitions("episode_id", "seq").mapInArrow(run, schema)


def merge_with_cap(segments: DataFrame, max_gap: float = 1.0, max_length: int = 1200) -> DataFrame:
    """As merge_by_gap, and a group's joined text stays within ``max_length``."""

    def fold(state, row):
        start, end, size = row
        if state and start is not None and state[0] is not None and start - state[0] <= max_gap and state[1] + 1 + size <= max_length:
            return True, (end, state[1] + 1 + size)
        return False, (end, size)

    sized = segments.withColumn("_size", F.length(T.given(F.col("text"))))
    return combine(numbered_by_fold(sized, ("start", "end", "_size"), fold).drop("_size"))


def merge_same_speaker(segments: DataFrame, merge_gap: float = 1.0) -> DataFrame:
    """Neighbours of one speaker merged if the gap is small or a time is unknown; the last known end counts."""
    w = Window.partitionBy("episode_id").orderBy("seq")
    known = F.last("end", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    gap = F.col("start") - known
    return combine(_islands(segments, (F.lag("speaker").over(w) != F.col("speaker")) | (gap.isNotNull() & ~(gap <= merge_gap))))


def merge_small_chunks(chunks: DataFrame, max_tokens: int = 800) -> DataFrame:
    """Chunks (episode_id, seq, speaker, text, token_count) of one speaker merged while their tokens stay under the cap."""

    def fold(state, row):
        speaker, tokens = row
        if state and speaker == state[0] and state[1] + (tokens or 0) < max_tokens:
            return True, (speaker, state[1] + (tokens or 0))
        return False, (speaker, tokens or 0)

    merged = numbered_by_fold(chunks.select("episode_id", "seq", "speaker", "text", "token_count"), ("speaker", "token_count"), fold)
    out = merged.groupBy("episode_id", "island").agg(F.min("seq").alias("seq"), F.min_by("speaker", "seq").alias("speaker"), ordered_text(F.col("seq"), F.col("text"), "\n").alias("text"))
    return out.withColumn("token_count", T.count_tokens(F.col("text")))


def turn_windows(segments: DataFrame, max_turns: int) -> DataFrame:
    """Tumbling windows of ``max_turns`` rows (0 or less: one window), with their place and number."""
    w = Window.partitionBy("episode_id").orderBy("seq")
    at = F.lit(0) if max_turns <= 0 else F.floor((F.row_number().over(w) - 1) / max_turns).cast("int")
    return segments.withColumn("window_index", at)


def first_seen_speakers(segments: DataFrame) -> DataFrame:
    """Each episode's speakers in the order in which they first speak."""
    seen = segments.groupBy("episode_id", "speaker").agg(F.min("seq").alias("first"))
    return seen.groupBy("episode_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "speaker"))), lambda x: x["speaker"]).alias("speakers"))


def anchor_windows(segments: DataFrame, speakers: list[str], context_turns: int = 2, stride: int = 1) -> DataFrame:
    """A window of neighbours around every ``stride``-th row of the speakers: (episode_id, window_id, anchor_index, segments)."""
    w = Window.partitionBy("episode_id").orderBy("seq")
    near = w.rowsBetween(-context_turns, context_turns)
    is_anchor = F.lower(T.given(F.col("speaker"))).isin([s.lower() for s in speakers])
    rows = segments.select(
        "episode_id", "seq", is_anchor.alias("is_anchor"), F.least(F.row_number().over(w) - 1, F.lit(context_turns)).alias("anchor_index"),
        F.sum(is_anchor.cast("int")).over(w).alias("nth"), F.collect_list(F.struct("seq", "start", "end", "speaker", "text")).over(near).alias("segments"),
    )
    rows = rows.filter(F.col("is_anchor") & ((F.col("nth") - 1) % max(1, stride) == 0))
    return rows.select("episode_id", F.concat_ws("|", F.col("episode_id").cast("string"), F.col("seq").cast("string")).alias("window_id"), "anchor_index", "segments")


def shrink_windows(windows: DataFrame, max_tokens: int) -> DataFrame:
    """Windows cut row by row until their rendered rows fit the budget; the longer side gives, of equals the left one.

    The number of cuts is bounded by the window, so the cut is a fold over a sequence: no row leaves the JVM.
    """
    seg = F.col("segments")
    size = F.transform(seg, lambda s: F.length(T.format_segment(s["start"], s["end"], s["speaker"], s["text"])))
    rows = windows.withColumn("sizes", size)

    def fits(a):
        part = F.slice(F.col("sizes"), a["lo"] + 1, a["hi"] - a["lo"])
        chars = F.aggregate(part, F.lit(0), lambda x, y: x + y) + a["hi"] - a["lo"] - 1
        return F.greatest(F.lit(1), F.floor(chars / 4).cast("int")) <= max_tokens

    def step(a, _):
        done = (a["hi"] - a["lo"] <= 1) | fits(a)
        left = ~done & (F.col("anchor_index") - a["lo"] >= a["hi"] - F.col("anchor_index") - 1)
        return F.struct((a["lo"] + left.cast("int")).alias("lo"), (a["hi"] - (~done & ~left).cast("int")).alias("hi"))

    first = F.struct(F.lit(0).alias("lo"), F.size(seg).alias("hi"))
    cut = F.aggregate(F.sequence(F.lit(1), F.size(seg)), first, step)
    rows = rows.withColumn("cut", cut)
    return rows.select("episode_id", "window_id", (F.col("anchor_index") - F.col("cut.lo")).alias("anchor_index"), F.slice(seg, F.col("cut.lo") + 1, F.col("cut.hi") - F.col("cut.lo")).alias("segments"))


def question_context(windows: DataFrame) -> DataFrame:
    """Adds ``context`` and ``context_speaker``: the run of another speaker before the anchor, 60 words or a little more.

    Walking back from the anchor: blank rows are passed over; the anchor's speaker is passed over until something is
    collected and then ends the run, as any third speaker does.
    """
    before = F.reverse(F.slice("segments", F.lit(1), F.col("anchor_index")))
    speaker = F.lower(F.get("segments", F.col("anchor_index"))["speaker"])
    start = F.struct(F.lit(False).alias("done"), F.lit(None).cast("string").alias("who"), F.array().cast("array<string>").alias("texts"))

    def step(a, s):
        t = T.strip(s["text"])
        own = F.lower(s["speaker"]) == speaker
        other = a["who"].isNotNull() & (F.lower(s["speaker"]) != F.lower(a["who"]))
        passed = a["done"] | (t == "")
        stop = ~passed & F.when(own, F.size(a["texts"]) > 0).otherwise(other)
        take = ~passed & ~own & ~other
        texts = F.when(take, F.array_prepend(a["texts"], t)).otherwise(a["texts"])
        full = take & (T.count_words(F.array_join(texts, " ")) >= 60)
        return F.struct((a["done"] | stop | full).alias("done"), F.when(take, F.coalesce(a["who"], s["speaker"])).otherwise(a["who"]).alias("who"), texts.alias("texts"))

    found = windows.withColumn("x", F.when(F.col("anchor_index") > 0, F.aggregate(before, start, step)))
    return found.withColumn("context", F.when(F.size("x.texts") > 0, F.array_join("x.texts", " "))).withColumn("context_speaker", F.when(F.size("x.texts") > 0, F.col("x.who"))).drop("x")


def recent_other_turns(anchor_speaker: Column, n: int) -> Column:
    """The last ``n`` non-blank rows before the anchor by others than the speaker, newest first."""
    before = F.reverse(F.slice("segments", F.lit(1), F.col("anchor_index")))
    before = F.when(F.col("anchor_index") > 0, before)
    return F.slice(F.filter(before, lambda s: (F.lower(s["speaker"]) != F.lower(anchor_speaker)) & (T.strip(s["text"]) != "")), 1, n)


def word_marks(x: Column) -> Column:
    """Words of letters, digits, underscores, apostrophes and hyphens."""
    return F.size(F.regexp_extract_all(T.given(x), F.lit(r"(?U)\b[\w'-]+\b"), F.lit(0)))


def mine_question(windows: DataFrame, max_turns: int = 3) -> DataFrame:
    """Adds ``local_question``: of recent other turns the first sentence with a question mark, else one that opens as a
    question, else the first sentence after a cue phrase; each with a question mark at its end and 25 words at most."""
    anchor = F.get("segments", F.col("anchor_index"))["speaker"]
    turns = recent_other_turns(anchor, max(1, max_turns))

    def pick(parts: Column, keep) -> Column:
        clean = F.transform(F.filter(parts, keep), T.ends_as_question)
        return F.get(F.filter(clean, lambda s: word_marks(s) <= T.MOST_WORDS), 0)

    parts = F.flatten(F.transform(turns, lambda s: T.sentences(s["text"], ellipsis=True)))
    opens = r"(?i)^\s*(" + "|".join(INTERROGATIVES) + r")\b"
    tails = F.flatten(F.transform(turns, lambda s: F.flatten(F.array(*[
        T.sentences(F.when(F.instr(F.lower(s["text"]), c) > 0, F.regexp_replace(F.substring(s["text"], F.instr(F.lower(s["text"]), c) + len(c), F.length(s["text"])), r"^[ :,-]+|[ :,-]+$", "")), ellipsis=True) for c in CUES
    ]))))
    found = F.coalesce(pick(parts, lambda s: F.contains(s, F.lit("?"))), pick(parts, lambda s: s.rlike(opens)), pick(tails, lambda s: s != ""))
    return windows.withColumn("local_question", found)


def overlapping_text(speaker: Column, start: Column, end: Column) -> Column:
    """The texts of the window's rows of a speaker that overlap a time span, ends included, joined; null if there are none."""
    hit = F.filter("segments", lambda s: (F.lower(s["speaker"]) == F.lower(speaker)) & ~F.isnan(s["start"]) & ~F.isnan(s["end"]) & (s["end"] >= start) & (s["start"] <= end) & (T.strip(s["text"]) != ""))
    return F.when(~F.isnan(start) & ~F.isnan(end) & (F.size(hit) > 0), F.array_join(F.transform(hit, lambda s: T.strip(s["text"])), " "))


def overlap_join(citations: DataFrame, segments: DataFrame) -> DataFrame:
    """Citations (episode_id, cite, speaker, c_start, c_end) with the ordered text of the segments they overlap."""
    s = segments.select("episode_id", F.lower("speaker").alias("who"), "seq", "start", "end", "text").filter(~F.isnan("start") & ~F.isnan("end") & (T.strip(F.col("text")) != ""))
    c = citations.filter(~F.isnan("c_start") & ~F.isnan("c_end")).withColumn("who", F.lower("speaker"))
    return c.join(s, ["episode_id", "who"]).filter("end >= c_start and start <= c_end").groupBy("episode_id", "cite").agg(F.count("*").alias("n"), ordered_text(F.col("seq"), T.strip(F.col("text"))).alias("span"))


def refine_question(local: Column, local_source: Column, context: Column, model: Column, rephrased: Column, answer: Column, guard: int = 30) -> Column:
    """The first valid question of the cascade as (question, origin, used): local, context, model, rephrased, model with a mark."""
    none = F.lit(None).cast("struct<question:string,origin:string,used:boolean>")

    def option(q: Column, origin: str, used: bool = False) -> Column:
        return F.struct(q.alias("question"), F.lit(origin).alias("origin"), F.lit(used).alias("used"))

    marked = lambda q: F.when(F.endswith(q, F.lit("?")), q).otherwise(F.concat(q, F.lit("?")))
    usable = T.strip(F.coalesce(context, local_source))
    may = local.isNull() & (F.length(usable) >= guard) & T.may_rephrase(usable)
    m = T.strip(model)
    return F.coalesce(
        F.when((T.strip(local) != "") & T.valid_question(marked(T.strip(local)), local_source, answer), option(marked(T.strip(local)), "local")),
        F.when(T.is_question(context) & T.valid_question(marked(context), context, answer), option(marked(context), "context")),
        F.when(T.is_question(m) & T.valid_question(marked(m), context, answer), option(marked(m), "model")),
        F.when(may & T.valid_question(rephrased, usable, answer), option(rephrased, "model", True)),
        F.when((m != "") & T.valid_question(marked(m), context, answer), option(marked(m), "model")),
        none,
    )


