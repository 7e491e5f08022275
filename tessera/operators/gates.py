"""Gates and validators: predicates over pairs, training records, sidecars and channel records.

Each validator returns an array of the names of the checks that fail, so one pass gives both verdict and reasons.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators.formats import field, has

#: Openings of lines that show reasoning, and fields that a sidecar and its gates must have.
REASONING_MARKS = r"(?i)^(Reasoning:|Let's think|\d+\.|\*\s*\d+\.)"
SIDECAR_FIELDS = ("pair_id", "episode_id", "window_id", "sample_index", "answer_speaker", "question", "answer", "sources", "target_spans", "fit_score_ce", "gates")
GATES = ("questionify_used", "answer_trimmed", "speaker_check_passed", "pairfit_passed")


def failing(**checks: Column) -> Column:
    """Names of the checks (true: passed) that fail; a null check fails."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]), lambda x: x.isNotNull())


def allowed_speaker(speaker: Column, allowed: list[str]) -> Column:
    return F.lower(T.given(speaker)).isin([s.lower() for s in allowed])


def kept_speaker(speaker: Column, include: list[str] = (), exclude: list[str] = ()) -> Column:
    """An include list decides alone, else an exclude list; an empty speaker is out."""
    s = F.lower(T.strip(speaker))
    rule = s.isin([x.lower() for x in include]) if include else ~s.isin([x.lower() for x in exclude]) if exclude else F.lit(True)
    return (s != "") & rule


def in_time(start: Column, end: Column, low: float | None, high: float | None) -> Column:
    """Whether a row overlaps a time slice; no bound where a bound is null."""
    return (F.lit(True) if low is None else F.coalesce(end > low, F.lit(False))) & (F.lit(True) if high is None else F.coalesce(start < high, F.lit(False)))


def answer_in_source(source: Column, answer: Column) -> Column:
    a = T.loose_norm(answer)
    return (a != "") & F.contains(T.loose_norm(source), a)


def provenance_holds(spans: Column, answer: Column, connectors: Column | None = None) -> Column:
    """The normalised answer is the joined spans, with the connectors after them if there are any."""
    joined = F.array_join(spans, " ")
    whole = joined if connectors is None else F.concat_ws(" ", joined, T.strip(connectors))
    return T.provenance_norm(whole) == T.provenance_norm(answer)


def trim(original: Column, candidate: Column) -> Column:
    """(text, start_char, end_char) of a candidate that is a strictly shorter stretch of the original; else null."""
    c, at = T.strip(candidate), F.instr(original, T.strip(candidate))
    good = (c != "") & (at > 0) & (F.length(c) < F.length(original))
    return F.when(good, F.struct(c.alias("text"), (at - 1).alias("start_char"), (at - 1 + F.length(c)).alias("end_char")))


def pair_fit(supported: Column, good: Column, score: Column, threshold: float = 0.5) -> Column:
    """passed, retry (a supported answer that a better question may fit) or failed."""
    ok = supported & good & (score >= threshold)
    return F.when(F.coalesce(ok, F.lit(False)), "passed").when(F.coalesce(supported, F.lit(False)), "retry").otherwise("failed")


def fit_consistent(passed: Column, score: Column, threshold: float = 0.5) -> Column:
    """passed says what the score says; not tested without a score."""
    return score.isNull() | (~F.isnan(score) & score.between(0.0, 1.0) & (F.coalesce(passed, F.lit(False)) == (score >= threshold)))


def training_record(s: Column) -> Column:
    """Failing checks of a training record's JSON: only ``messages``, not empty, text roles and contents, an assistant last."""
    raw = F.from_json(field(s, "messages"), "array<string>")
    ms = F.from_json(field(s, "messages"), "array<struct<role:string,content:string>>")
    texts = F.forall(raw, lambda m: F.coalesce(has(m, "role", "content"), F.lit(False)))
    typed = F.forall(raw, lambda m: F.schema_of_variant(F.try_variant_get(F.try_parse_json(m), "$.role", "variant")).isin("STRING") & F.schema_of_variant(F.try_variant_get(F.try_parse_json(m), "$.content", "variant")).isin("STRING"))
    return failing(only_messages=F.array_join(F.json_object_keys(s), ",") == "messages", not_empty=F.size(raw) > 0, fields=texts, types=typed, assistant_last=F.try_element_at(ms, F.lit(-1))["role"] == "assistant")


def sidecar_record(s: Column) -> Column:
    """Failing checks of a sidecar record's JSON."""
    g = lambda k: field(s, f"gates.{k}") == "true"
    q, score = field(s, "question"), field(s, "fit_score_ce").cast("double")
    used = F.coalesce(g("questionify_used"), F.lit(False))
    return failing(
        fields=has(s, *SIDECAR_FIELDS), gates=has(field(s, "gates"), *GATES), fit=~F.coalesce(g("pairfit_passed"), F.lit(False)) | F.coalesce(score >= 0.5, F.lit(False)),
        origin=~used | F.coalesce(field(s, "question_origin") == "model", F.lit(False)), question=~used | (F.endswith(q, F.lit("?")) & (T.count_words(q) <= 25)),
        found=(F.coalesce(field(s, "composition.mode"), F.lit("")) != "A") | F.coalesce(field(s, "answer_found_in_source") == "true", F.lit(False)),
    )


def channel_record(messages: Column, user_cap: int = 512, final_cap: int = 512) -> Column:
    """Failing checks of messages (role, content, analysis, final): three at least, system first, caps, channels filled."""
    said = F.filter(messages, lambda m: m["role"] == "assistant")
    return failing(
        three=F.size(messages) >= 3, system_first=F.try_element_at(messages, F.lit(1))["role"] == "system",
        user_cap=F.forall(messages, lambda m: (m["role"] != "user") | (T.count_tokens(m["content"]) <= user_cap)),
        analysis=F.forall(said, lambda m: ~T.blank(m["analysis"])), final=F.forall(said, lambda m: ~T.blank(m["final"]) & (T.count_tokens(m["final"]) <= final_cap)),
    )


def message_order(messages: Column) -> Column:
    """The first three roles are system, user and assistant."""
    return F.array_join(F.transform(F.slice(messages, 1, 3), lambda m: m["role"]), ",") == "system,user,assistant"


def reasoning_lines(x: Column) -> Column:
    """Lines that open as reasoning does (a heading, a numbered step), cut at 50 characters with three dots."""
    found = F.filter(F.transform(F.split(T.given(x), "\n"), T.strip), lambda line: line.rlike(REASONING_MARKS))
    return F.transform(found, lambda line: F.when(F.length(line) > 50, F.concat(F.substring(line, 1, 50), F.lit("..."))).otherwise(line))


def composition(s: Column, most_connectors: int = 2, most_chars: int = 200) -> Column:
    """Failing checks of a sidecar's composition: mode A has no connectors, mode B some within the caps, spans are quoted."""
    mode, n, chars = field(s, "composition.mode"), field(s, "composition.connector_sentences").cast("int"), field(s, "composition.paraphrase_chars").cast("int")
    spans = F.from_json(field(s, "composition.quoted_spans"), "array<struct<speaker:string,start:string,end:string>>")
    return failing(
        mode=mode.isin("A", "B"), connectors=F.when(mode == "A", n == 0).otherwise(n.between(1, most_connectors)), chars=F.when(mode == "A", chars == 0).otherwise(chars.between(1, most_chars)), spans=F.size(spans) > 0,
        numbers=F.forall(spans, lambda x: (x["start"].isNull() | x["start"].try_cast("double").isNotNull()) & (x["end"].isNull() | x["end"].try_cast("double").isNotNull())),
    )


def sample_valid(s: Column) -> Column:
    """A JSON object that is not empty; messages, if there, a list that is not empty, without the role ``invalid``; some value filled."""
    roles = F.from_json(field(s, "messages"), "array<struct<role:string,content:string>>")
    filled = F.exists(F.map_values(F.from_json(s, "map<string,string>")), lambda v: F.coalesce((T.strip(v) != "") & ~v.isin("[]", "{}"), F.lit(False)))
    talk = ~has(s, "messages") | ((F.size(roles) > 0) & F.forall(roles, lambda m: F.coalesce(m["role"] != "invalid", F.lit(True))))
    return F.coalesce((F.size(F.json_object_keys(s)) > 0) & talk & filled, F.lit(False))
