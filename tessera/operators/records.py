"""Record building: variants and connectors, training and sidecar records, channel records, adapters from segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import segments as S
from tessera.operators.formats import field, filled, has
from tessera.operators.gates import provenance_holds

#: Verbs and motifs of connector sentences, and labels of lines that belong to the analysis.
VERBS = ("signals", "expresses", "reveals", "echoes", "maps to")
MOTIFS = ("order vs chaos", "sacrifice and renewal", "fall and redemption", "exile and return")
LABELS = {"Symbolic reasoning:": "symbolic_meaning", "Archetypal patterns:": "archetypal_patterns", "Theological themes:": "theological_themes"}


def variant(pair_id: Column, ratio: float, seed: int) -> Column:
    """A or B by the pair's bucket of a hundred."""
    r = max(0.0, min(1.0, ratio))
    if r in (0.0, 1.0):
        return F.lit("B" if r else "A")
    return F.when(T.hash_mod(F.concat(pair_id, F.lit(f":{seed}")), 100) < int(r * 100), "B").otherwise("A")


def connectors(speaker: Column, seed: Column, most: int = 2, cap: int = 200) -> Column:
    """Connector sentences chosen by the seed's hash: one to ``most``, as long as they fit the cap."""
    if most <= 0 or cap <= 0:
        return F.array().cast("array<string>")
    h = T.hash_int(seed)
    n = F.least(F.lit(most), (h % most).cast("int") + 1)
    who = F.coalesce(filled(T.strip(speaker)), F.lit("These lines"))
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), ((h + i) % len(names)).cast("int") + 1)
    made = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.when((i == n - 1) & (n > 1), F.concat(F.lit("It leaves a question about "), pick(MOTIFS, i), F.lit("."))).otherwise(
        F.concat(who, F.lit(" "), pick(VERBS, i), F.lit(" "), pick(MOTIFS, i), F.lit(" within the cited lines."))))
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("size"), F.lit(False).alias("full"))

    def step(a, s):
        size = a["size"] + F.length(s) + (F.size(a["out"]) > 0).cast("int")
        full = a["full"] | (size > cap)
        return F.struct(F.when(full, a["out"]).otherwise(F.array_append(a["out"], s)).alias("out"), F.when(full, a["size"]).otherwise(size).alias("size"), full.alias("full"))

    return F.aggregate(made, start, step, lambda a: a["out"])


def training_record(question: Column, answer: Column, system: str | None = None) -> Column:
    """A struct with ``messages`` alone."""
    m = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    ms = [m("user", question), m("assistant", answer)]
    return F.struct(F.array(*([m("system", F.lit(system))] if system else []), *ms).alias("messages"))


def build_pairs(pairs: DataFrame, ratio: float = 0.2, seed: int = 7, most: int = 2, cap: int = 200) -> DataFrame:
    """Training and sidecar structs of accepted pairs (pair_id, episode_id, window_id, sample_index, question, answer, speaker,
    spans array<string>, sources, fit_score, flags); pairs whose answer is not its spans and connectors get a drop_reason and no records."""
    mode = variant(F.col("pair_id"), ratio, seed)
    rows = pairs.withColumn("mode", mode).withColumn("links", F.when(F.col("mode") == "B", connectors(F.col("speaker"), F.col("pair_id"), most, cap)).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("mode", F.when(F.size("links") > 0, F.col("mode")).otherwise("A"))
    whole = F.trim(F.concat_ws(" ", F.col("answer"), F.array_join("links", " ")))
    holds = provenance_holds(F.col("spans"), whole, F.array_join("links", " "))
    rows = rows.withColumn("drop_reason", F.when(~F.coalesce(holds, F.lit(False)), "provenance"))
    gates = F.struct(F.col("questionify_used"), F.col("answer_trimmed"), F.lit(True).alias("speaker_check_passed"), F.coalesce(F.col("fit_score") >= 0.5, F.lit(False)).alias("pairfit_passed"))
    made = F.struct(F.col("mode").alias("mode"), F.size("links").alias("connector_sentences"), F.length(F.array_join("links", " ")).alias("paraphrase_chars"), F.col("sources").alias("quoted_spans"), F.col("spans").alias("answer_spans_text"))
    side = F.struct("pair_id", "episode_id", "window_id", "sample_index", F.col("speaker").alias("answer_speaker"), "question", whole.alias("answer"), "sources", F.col("sources").alias("target_spans"), F.array_join("spans", " ").alias("source_spans_text"), F.lit(True).alias("answer_found_in_source"), F.col("fit_score").alias("fit_score_ce"), gates.alias("gates"), made.alias("composition"))
    kept = F.col("drop_reason").isNull()
    return rows.select("pair_id", "drop_reason", F.when(kept, training_record(F.col("question"), whole)).alias("training"), F.when(kept, side).alias("sidecar"))


def flat_analysis(x: Column, strict: bool = True) -> Column:
    """Analysis JSON (text or object) as blocks of text; strict: strings lose their outer white space."""
    lists = lambda k, label: F.concat(F.lit(label), filled(F.array_join(F.from_json(field(x, k), "array<string>"), ", ")))
    blocks = F.concat_ws("\n\n", F.concat(F.lit("Symbolic reasoning:\n"), filled(field(x, "symbolic_meaning"))), lists("archetypal_patterns", "Archetypal patterns: "), lists("theological_themes", "Theological themes: "))
    plain = T.given(F.coalesce(F.from_json(F.concat(F.lit('{"v":'), x, F.lit("}")), "struct<v:string>")["v"], x))
    is_object = F.json_object_keys(x).isNotNull()
    return F.when(is_object, T.strip(blocks) if strict else blocks).otherwise(T.strip(plain) if strict else plain)


def flat_final(x: Column, fallback: Column | None = None) -> Column:
    """Final JSON (text or object): its first filled field of summary, symbolic_summary and final, else the fallback."""
    of = F.coalesce(*[filled(T.strip(field(x, k))) for k in ("summary", "symbolic_summary", "final")], T.strip(fallback) if fallback is not None else F.lit(""))
    plain = F.coalesce(F.from_json(F.concat(F.lit('{"v":'), x, F.lit("}")), "struct<v:string>")["v"], x)
    return F.when(F.json_object_keys(x).isNotNull(), of).otherwise(T.strip(plain))


def flatten_channels(messages: Column) -> Column:
    """Messages (role, content, analysis, final) with flat channels; content goes where both channels are filled."""

    def one(m):
        a, f = flat_analysis(m["analysis"], strict=False), flat_final(m["final"])
        both = ~T.blank(a) & ~T.blank(f)
        said = m["role"] == "assistant"
        return F.struct(m["role"].alias("role"), F.when(said & both, F.lit(None)).otherwise(m["content"]).alias("content"), F.when(said & m["analysis"].isNotNull(), a).otherwise(m["analysis"]).alias("analysis"), F.when(said & m["final"].isNotNull(), f).otherwise(m["final"]).alias("final"))

    return F.transform(messages, one)


def flattened(messages: Column) -> Column:
    """(messages, modified): flatten_channels(), and whether it changed anything."""
    out = flatten_channels(messages)
    return F.struct(out.alias("messages"), (~out.eqNullSafe(messages)).alias("modified"))


def move_leaked(analysis: Column, summary: Column) -> Column:
    """(analysis, summary): lines of the summary with an analysis label move to the analysis map, unless it has the field."""
    lines = F.split(T.given(summary), "\n")
    leaked = lambda line: F.lit(False) | T.strip(line).rlike("^(" + "|".join(LABELS) + ")")
    first = lambda label: F.get(F.filter(F.transform(lines, T.strip), lambda line: F.startswith(line, F.lit(label))), 0)
    pairs = [F.struct(F.lit(k).alias("key"), first(label).alias("line"), F.lit(label).alias("label")) for label, k in LABELS.items()]
    moved = F.filter(F.array(*pairs), lambda p: p["line"].isNotNull())
    found = F.map_from_entries(F.transform(moved, lambda p: F.struct(p["key"], T.strip(F.replace(p["line"], p["label"], F.lit(""))))))
    base = F.coalesce(analysis, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    fresh = F.map_filter(found, lambda k, v: ~F.map_contains_key(base, k))
    clean = T.strip(F.array_join(F.filter(lines, lambda line: ~leaked(line)), "\n"))
    return F.struct(F.map_concat(base, fresh).alias("analysis"), F.when(F.size(moved) > 0, clean).otherwise(summary).alias("summary"))


def conversation_records(segments: DataFrame, max_turns: int = 0, roles: tuple[str, str] = ("user", "assistant")) -> DataFrame:
    """Channel records of two-speaker windows: the first speaker asks, the second answers, neighbours of one role are one turn.

    (episode_id, window_index, windows_total, strategy, messages, user_tokens_max, final_tokens_sum); windows of one speaker
    or of more than two are told by one voice.
    """
    rows = S.turn_windows(segments, max_turns)
    speakers = S.first_seen_speakers(segments)
    rows = rows.join(speakers, "episode_id").withColumn("two", F.size("speakers") == 2)
    rows = rows.withColumn("role", F.when(~F.col("two") | (F.col("speaker") == F.element_at("speakers", 1)), roles[0]).otherwise(roles[1]))
    w = Window.partitionBy("episode_id", "window_index").orderBy("seq")
    rows = rows.withColumn("run", F.sum(F.when(F.lag("role").over(w) == F.col("role"), 0).otherwise(1)).over(w))
    turns = rows.groupBy("episode_id", "window_index", "two", "speakers", "run").agg(F.first("role").alias("role"), S.ordered_text(F.col("seq"), F.col("text"), "\n").alias("text"))
    m = F.transform(F.array_sort(F.collect_list(F.struct("run", "role", "text"))), lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))
    out = turns.groupBy("episode_id", "window_index", "two", "speakers").agg(m.alias("turns"))
    prompt = F.concat(F.lit("Episode "), F.col("episode_id").cast("string"), F.lit(" with "), F.array_join("speakers", ", "))
    body = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    said = F.filter(body, lambda x: x["role"] == roles[1])
    asked = F.transform(F.filter(body, lambda x: x["role"] == roles[0]), lambda x: T.count_tokens(x["content"]))
    return out.select(
        "episode_id", "window_index", F.count("*").over(Window.partitionBy("episode_id")).alias("windows_total"), F.when(F.col("two"), "two_speaker").otherwise("flattened").alias("strategy"),
        F.concat(F.array(F.struct(F.lit("system").alias("role"), prompt.alias("content"))), body).alias("messages"), F.coalesce(F.array_max(asked), F.lit(0)).alias("user_tokens_max"),
        F.aggregate(F.transform(said, lambda x: T.count_tokens(x["content"])), F.lit(0), lambda a, b: a + b).alias("final_tokens_sum"),
    )


def chunk_variants(chunks: DataFrame) -> DataFrame:
    """Each chunk as base, abbreviated and detailed, with a variant_index."""
    kinds = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(v).alias("v")) for i, v in enumerate(("base", "abbreviated", "detailed"))])
    return chunks.withColumn("k", F.explode(kinds)).withColumn("variant_index", F.col("k.i")).withColumn("variant", F.col("k.v")).drop("k")


def with_system(messages: Column, content: Column) -> Column:
    """Messages with a system message put first."""
    return F.array_prepend(messages, F.struct(F.lit("system").alias("role"), content.alias("content")))


def only_role(messages: Column, role: str) -> Column:
    """The messages of a role, null if there are none."""
    kept = F.filter(messages, lambda m: m["role"] == role)
    return F.when(F.size(kept) > 0, kept)


def completed(rows: DataFrame, sample_col: str = "sample") -> DataFrame:
    """The rows whose JSON says that they are completed."""
    return rows.filter(has(F.col(sample_col), "status") & (field(F.col(sample_col), "status") == "completed"))


def math_answer(x: Column) -> Column:
    """The first of a comma-and-space list; scientific notation stays; a plain number without thousands' commas, with three
    decimals or more rounded half up to two; null if it is no number."""
    first = F.trim(F.get(F.split(x, ", "), 0))
    plain = F.replace(first, F.lit(","), F.lit(""))
    number = plain.try_cast("decimal(38,10)")
    long = plain.rlike(r"\.\d{3,}$")
    return F.when(first.rlike(r"(?i)^[+-]?\d+(\.\d+)?e[+-]?\d+$"), first).when(plain.rlike(r"^[+-]?\d+(\.\d+)?$"), F.when(long, F.round(number, 2).cast("decimal(38,2)").cast("string")).otherwise(plain))
