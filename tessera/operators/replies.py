"""Model stages from prompt to decision: prompts, replies parsed as columns, one retry with a suggested question, error classes.

A reply is text that may hold JSON, fenced or bare. A parser gives a struct, null where the reply is none; truth follows the
loose rule of such judges: a field counts as true if it is there and is neither false, null, zero nor empty. The client's calls
are ``models.complete`` and ``models.fit_scores``; everything here is expressions over their results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import udf as U
from tessera.operators import gates as G
from tessera.operators import models as M
from tessera.operators import prompts as P
from tessera.operators.formats import field, has

REPHRASE = "Turn the context into one question of at most 25 words that it could answer. Use only its words.\n\nCONTEXT:\n{context}"
TRIM = "Question: {question}\nAnswer: {answer}\n\nCut the answer to the stretch of it that still answers the question. Reply with JSON: answer_trimmed."
SPEAKER = "Allowed speakers: {allowed}\nSpeaker: {speaker}\nAnswer:\n{answer}\n\nSay as JSON whether the answer is by an allowed speaker alone (allowed, reason)."
AUDIT = "Record:\n{record}\n\nSay as JSON whether it passes (pass), what its issues are (issues) and one comment (comment)."
MOST_ISSUES = 6
NO_SCORE, NO_VERDICT, REFUSED, BAD_IDEA = "no score of fit", "the judge's reply is no JSON", "the judge refuses the pair", "the suggested question is not valid"
CLOSE = 0.45  # a supported pair from this score on may be retried with the suggested question

#: Words in an error's text, by class, in order of precedence.
ERROR_CLASSES = {
    "authentication": ("api key", "api_key", "unauthorized", "authentication", "401"),
    "rate_limit": ("rate limit", "too many requests", "429", "quota"),
    "timeout": ("timeout", "timed out", "deadline"),
    "network": ("connection", "network", "unreachable", "reset by peer"),
    "model": ("model not found", "does not exist", "404"),
    "context_length": ("context length", "maximum context", "too long", "token limit"),
    "schema": ("schema", "validation", "json"),
}
PASSING = ("rate_limit", "timeout", "network")  # worth another try


def payload(reply: Column) -> Column:
    """The JSON object in a reply; null if there is none."""
    x = T.json_payload(reply)
    return F.when(F.json_object_keys(x).isNotNull(), x)


def truthy(x: Column, name: str) -> Column:
    v = F.lower(field(x, name))
    return F.coalesce(~v.isin("", "false", "null", "0", "0.0", "[]", "{}"), F.lit(False))


def stripped(x: Column, name: str) -> Column:
    """A field's text without outer white space; null if it is blank."""
    return F.nullif(T.strip(field(x, name)), F.lit(""))


def verdict(reply: Column) -> Column:
    """(is_supported, is_good_question, reason, suggested_question) of a judge's reply."""
    x = payload(reply)
    return F.when(x.isNotNull(), F.struct(truthy(x, "is_supported").alias("is_supported"), truthy(x, "is_good_question").alias("is_good_question"), stripped(x, "reason").alias("reason"), stripped(x, "suggested_question").alias("suggested_question")))


def trimmed(reply: Column) -> Column:
    """The shorter answer that a reply proposes."""
    return stripped(payload(reply), "answer_trimmed")


def speaker_verdict(reply: Column) -> Column:
    """(allowed, reason)."""
    x = payload(reply)
    return F.when(x.isNotNull(), F.struct(truthy(x, "allowed").alias("allowed"), stripped(x, "reason").alias("reason")))


def audit_verdict(reply: Column) -> Column:
    """(passed, issues, comment); issues that are no list count as none, six at most."""
    x = payload(reply)
    issues = F.coalesce(F.slice(F.from_json(field(x, "issues"), "array<string>"), 1, MOST_ISSUES), F.array().cast("array<string>"))
    return F.when(x.isNotNull(), F.struct(truthy(x, "pass").alias("passed"), issues.alias("issues"), T.given(stripped(x, "comment")).alias("comment")))


def pairs(reply: Column) -> Column:
    """The question and answer pairs of a generation reply: a JSON list, or an object with ``pairs``; null if it is neither."""
    kind = "array<struct<question:string,answer:string,answer_speaker:string,analysis:string,citations:array<struct<speaker:string,start:double,end:double>>>>"
    x = U.clock_numbers(T.json_payload(reply))
    listed = F.when(F.startswith(T.strip(x), F.lit("[")), F.from_json(x, kind)).otherwise(F.from_json(field(x, "pairs"), kind))
    return F.filter(listed, lambda p: T.given(p["question"]).isNotNull() & (T.strip(p["question"]) != "") & (T.strip(p["answer"]) != ""))


def generate_pairs(windows: DataFrame, speakers: list[str], n: int, make: Callable = M.StubClient, store: str | None = None) -> DataFrame:
    """A row a pair: windows (window_id, segments) asked for n pairs, replies parsed; windows without a usable reply give none."""
    asked = M.complete(windows, P.window_prompt(F.col("segments"), speakers, n), make, store)
    return asked.select("*", F.posexplode(pairs(F.col("reply"))).alias("sample_index", "pair")).drop("reply")


def rephrase(rows: DataFrame, context: Column, make: Callable = M.StubClient, store: str | None = None) -> DataFrame:
    """rows with ``rephrased``: a model's question for contexts that may be rephrased, with a question mark; else null."""
    asked = M.complete(rows.withColumn("_may", T.may_rephrase(context)), F.when(T.may_rephrase(context), P.fill(REPHRASE, context=context)), make, store)
    return asked.withColumn("rephrased", F.when(F.col("_may") & (T.strip(F.col("reply")) != ""), T.ends_as_question(F.col("reply")))).drop("_may", "reply")


def trim_answers(rows: DataFrame, least_words: int = 60, make: Callable = M.StubClient, store: str | None = None) -> DataFrame:
    """rows (question, answer) with ``trim``: (text, start_char, end_char) of long answers that a model shortens to a stretch of them."""
    long = T.count_words(F.col("answer")) > least_words
    asked = M.complete(rows, F.when(long, P.fill(TRIM, question=F.col("question"), answer=F.col("answer"))), make, store)
    return asked.withColumn("trim", F.when(long, G.trim(F.col("answer"), trimmed(F.col("reply"))))).drop("reply")


def check_speakers(rows: DataFrame, allowed: list[str], make: Callable = M.StubClient, store: str | None = None) -> DataFrame:
    """rows (answer_speaker, answer) with ``speaker_check``: (allowed, reason)."""
    asked = M.complete(rows, P.fill(SPEAKER, allowed=F.lit(", ".join(allowed)), speaker=F.col("answer_speaker"), answer=F.col("answer")), make, store)
    return asked.withColumn("speaker_check", speaker_verdict(F.col("reply"))).drop("reply")


def decide(question: Column, answer: Column, reference: Column, judged: Column, score: Column, least: float = 0.5) -> Column:
    """(status, question, reason) of a pair's first judgement: accepted, retry (with the suggested question), rejected or error.

    A retry needs a valid suggestion, and a pair that is either not supported as it stands or close below the score.
    """
    good = judged["is_supported"] & judged["is_good_question"]
    idea = T.ends_as_question(judged["suggested_question"])
    out = lambda status, q, why: F.struct(F.lit(status).alias("status"), q.alias("question"), why.alias("reason"))
    none = F.lit(None).cast("string")
    said = F.coalesce(judged["reason"], F.lit(REFUSED))
    return (
        F.when(score.isNull(), out("rejected", none, F.lit(NO_SCORE)))
        .when(judged.isNull(), out("error", none, F.lit(NO_VERDICT)))
        .when(good & (score >= least), out("accepted", T.strip(question), none))
        .when(judged["suggested_question"].isNull(), out("rejected", none, said))
        .when(~T.valid_question(idea, reference, answer), out("rejected", none, F.lit(BAD_IDEA)))
        .when(~good | ((score >= CLOSE) & (score < least)), out("retry", idea, none))
        .otherwise(out("rejected", none, said))
    )


def second(question: Column, judged: Column, score: Column, least: float = 0.5) -> Column:
    """The judgement of a retried question: no third try."""
    good = judged["is_supported"] & judged["is_good_question"] & (score >= least)
    out = lambda status, q, why: F.struct(F.lit(status).alias("status"), q.alias("question"), why.alias("reason"))
    none = F.lit(None).cast("string")
    return (
        F.when(score.isNull(), out("rejected", none, F.lit(NO_SCORE)))
        .when(judged.isNull(), out("error", none, F.lit(NO_VERDICT)))
        .when(good, out("accepted", question, none))
        .otherwise(out("rejected", none, F.coalesce(judged["reason"], F.lit(REFUSED))))
    )


def evaluate(rows: DataFrame, make: Callable = M.StubClient, store: str | None = None, enabled: bool = True, least: float = 0.5) -> DataFrame:
    """rows (question, answer, source, context) with ``fit``: (status, question, reason) and ``attempts``.

    Two passes: all rows are scored and judged; only those that may be retried are scored and judged again. Not enabled: skipped.
    """
    if not enabled:
        return rows.withColumn("fit", F.struct(F.lit("skipped").alias("status"), F.col("question").alias("question"), F.lit(None).cast("string").alias("reason"))).withColumn("attempts", F.lit(0))
    reference = F.coalesce(F.nullif(F.col("context"), F.lit("")), F.col("source"))

    def judged(d: DataFrame, question: Column, active: Column, n: int) -> DataFrame:
        asked = M.complete(d, F.when(active, P.fit_prompt(question, F.col("answer"), F.col("source"))), make, store)
        return asked.withColumn(f"_j{n}", verdict(F.col("reply"))).withColumn(f"_s{n}", F.when(active, M.fit_scores(question, F.col("answer"), make))).drop("reply")

    one = judged(rows, T.strip(F.col("question")), F.lit(True), 1)
    one = one.withColumn("_d", decide(F.col("question"), F.col("answer"), reference, F.col("_j1"), F.col("_s1"), least))
    again = F.col("_d.status") == "retry"
    two = judged(one, F.col("_d.question"), again, 2)
    fit = F.when(again, second(F.col("_d.question"), F.col("_j2"), F.col("_s2"), least)).otherwise(F.col("_d"))
    return two.withColumn("fit", fit).withColumn("attempts", F.when(again, 2).otherwise(1)).drop("_d", "_j1", "_s1", "_j2", "_s2")


def error_class(error: Column) -> Column:
    """The class of a client's error by its text; unknown if no word tells, null without an error."""
    low = F.lower(error)
    out = F.lit("unknown")
    for name, words in reversed(list(ERROR_CLASSES.items())):
        out = F.when(low.rlike("|".join(words)), name).otherwise(out)
    return F.when(error.isNotNull() & (error != ""), out)


def worth_retrying(error: Column) -> Column:
    return F.coalesce(error_class(error).isin(*PASSING), F.lit(False))


def structured(rows: DataFrame, prompt: Column, kind: str, make: Callable = M.StubClient, tries: int = 3, required: tuple[str, ...] = ()) -> DataFrame:
    """rows with ``value``: a reply parsed as a struct type, asked again up to ``tries`` times where it doesn't parse or lacks a
    required field; null if no try gives one. Only rows still open are asked in each round."""
    out, value = rows, F.lit(None).cast(kind)
    for k in range(tries):
        open_ = F.lit(True) if k == 0 else F.col("_value").isNull()
        said = F.concat(prompt, F.lit("" if k == 0 else f"\n\nThe reply to try {k} did not fit. Answer with JSON alone."))
        asked = M.complete(out, F.when(open_, said), make)
        x = payload(F.col("reply"))
        value = F.when(has(x, *required), F.from_json(x, kind)) if required else F.from_json(x, kind)
        out = asked.withColumn("_value", value if k == 0 else F.coalesce("_value", value)).drop("reply")
    return out.withColumnRenamed("_value", "value")
