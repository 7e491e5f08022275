"""Conversion of analysed chunks to channel conversations, and the chain's validators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import segments as S
from tessera.operators.formats import field, filled
from tessera.operators.gates import failing, message_order, reasoning_lines

#: The constant channels and the system prompt of converted records.
SYMBOLIC = "Deep spiritual significance revealed through symbolic interpretation"
PATTERNS, THEMES = ("Theological pattern", "Symbolic motif"), ("Divine relationship", "Human condition")
SUMMARY = "Symbolic and theological analysis of transcript content"
PROMPT = (
    "You are an expert symbolic theologian with deep knowledge of biblical symbolism, archetypal patterns, and theological interpretation."
    " Analyze the provided transcript text and provide comprehensive symbolic analysis."
)


def sentence_budget(x: Column, most: int) -> Column:
    """The text if it fits the budget of tokens, else its sentences from the first on while they fit (none, if the first doesn't)."""
    parts = F.split(T.given(x), r"(?<=[.!?])\s+")
    start = F.struct(F.lit("").alias("t"), F.lit(False).alias("full"))

    def step(a, s):
        longer = F.when(a["t"] == "", s).otherwise(F.concat(a["t"], F.lit(" "), s))
        full = a["full"] | (T.count_tokens(T.strip(longer)) > most)
        return F.struct(F.when(full, a["t"]).otherwise(longer).alias("t"), full.alias("full"))

    return F.when(T.count_tokens(x) <= most, x).otherwise(T.strip(F.aggregate(parts, start, step, lambda a: a["t"])))


def plain(x: Column, default: str) -> Column:
    """A value without quotes and backslashes, line ends as spaces."""
    return F.translate(F.regexp_replace(F.coalesce(x, F.lit(default)), "\n", " "), '"\\\r', "")


def transcripts(segments: DataFrame, key: str = "source_file") -> DataFrame:
    """(source_file, transcript): each file's rows as ``[12.5] SPEAKER: words`` lines in order."""
    at = F.when(F.col("start") > 0, F.concat(F.lit("["), F.format_string("%.1f", F.col("start")), F.lit("] "))).otherwise("")
    line = F.concat(at, F.upper("speaker"), F.lit(": "), T.given(F.col("text")))
    return segments.groupBy(key).agg(S.ordered_text(F.col("seq"), line, "\n").alias("transcript"))


def conversations(chunks: DataFrame, texts: DataFrame, primary: str = "", most: int = 1400) -> DataFrame:
    """Channel conversations of chunks (chunk_id, speaker, source_file, ...) with their file's transcript, or a placeholder."""
    rows = chunks.join(texts, "source_file", "left")
    source, speaker = plain(F.col("source_file"), "unknown.txt"), plain(F.col("speaker"), "unknown")
    chunk = F.col("chunk_id").cast("string")
    body = F.coalesce(filled(F.col("transcript")), F.concat(F.lit("Transcript chunk "), chunk, F.lit(" from "), source))
    user = F.concat(F.lit("Analyze the following source and produce a symbolic narrative summary.\n\n[source_file="), source, F.lit(", chunk_id="), chunk, F.lit(", speaker="), speaker, F.lit("]\n\n<<<TRANSCRIPT>>>\n"), sentence_budget(body, most), F.lit("\n<<<END TRANSCRIPT>>>\n"))
    system = PROMPT + (f"\n\n🎯 ANALYSIS FOCUS: Prefer interpretations voiced by {primary}; treat other speakers as context. If {primary} absent, maintain a consistent voice." if primary else "")
    none = F.lit(None).cast("string")
    analysis = F.to_json(F.struct(F.lit(SYMBOLIC).alias("symbolic_meaning"), F.array(*map(F.lit, PATTERNS)).alias("archetypal_patterns"), F.array(*map(F.lit, THEMES)).alias("theological_themes")))
    final = F.to_json(F.struct(F.lit(SUMMARY).alias("summary")))
    m = lambda r, c, a, f: F.struct(F.lit(r).alias("role"), c.alias("content"), a.alias("analysis"), f.alias("final"))
    status = F.when(filled(F.col("transcript")).isNotNull(), "TRANSCRIPT_LOADED").otherwise("TRANSCRIPT_ERROR")
    hit = (F.lower(speaker) == primary.lower()) if primary else F.lit(False)
    return rows.select("chunk_id", status.alias("transcript_status"), hit.alias("primary_speaker_hit"), F.array(m("system", F.lit(system), none, none), m("user", user, none, none), m("assistant", none, analysis, final)).alias("messages"))


def conversation_checks(messages: Column, final_cap: int = 512) -> Column:
    """Failing checks of a converted conversation: order of roles, channels filled (text or object), final within the cap and
    free of lines that open as reasoning does."""
    said = F.get(F.filter(messages, lambda m: m["role"] == "assistant"), 0)
    return failing(
        order=message_order(messages), analysis=~T.blank(said["analysis"]) & (said["analysis"] != "{}"), final=~T.blank(said["final"]) & (said["final"] != "{}"),
        cap=T.count_tokens(said["final"]) <= final_cap, markers=F.size(reasoning_lines(F.coalesce(field(said["final"], "summary"), said["final"]))) == 0,
    )


def analysis_fields(s: Column) -> Column:
    """The fields of a record whose names speak of symbols, archetypes, patterns, themes or theology, as a map; null if there are none."""
    held = F.map_filter(F.from_json(s, "map<string,string>"), lambda k, v: F.lower(k).rlike("symbol|archetyp|pattern|theme|theolog") & F.coalesce(T.strip(v) != "", F.lit(False)))
    return F.when(F.size(held) > 0, held)


def repair(s: Column) -> Column:
    """Messages of a completed analysis record's JSON: system, user by its text, assistant with the channels it names or, for the
    analysis, the fields that speak of it."""
    user = F.coalesce(*[filled(field(s, k)) for k in ("user", "text", "transcript", "content")], F.lit(""))
    final = F.coalesce(*[filled(field(s, k)) for k in ("final", "summary", "symbolic_summary")], F.lit(""))
    analysis = F.coalesce(filled(field(s, "analysis")), F.to_json(analysis_fields(s)), F.lit(""))
    none = F.lit(None).cast("string")
    m = lambda r, c, a, f: F.struct(F.lit(r).alias("role"), c.alias("content"), a.alias("analysis"), f.alias("final"))
    return F.array(m("system", F.lit(PROMPT), none, none), m("user", user, none, none), m("assistant", none, analysis, final))
