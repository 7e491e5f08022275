"""Prompts as columns: templates with named places, filled from a row; examples, tools and topic paths as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T

WINDOW = "Write {n} question and answer pairs as a JSON list.\nOnly these speakers may answer: {speakers}.\nEach pair has question, answer, answer_speaker, analysis and citations.\n\nTranscript:\n{transcript}"
FIT = "Question: {question}\nAnswer: {answer}\nSource:\n{source}\n\nSay as JSON whether the source supports the answer and whether the question is good, and suggest a better one."
TOPICS = "Domain: {domain}\nName {n} subtopics of: {path}\nExamples:\n{examples}"
SAMPLE = "{system}\n{instructions}\nTopic: {path}\nTools:\n{tools}\nExamples:\n{examples}"


def fill(template: str, **values: Column) -> Column:
    """The template with each {name} replaced by its column; nulls as empty text."""
    out = F.lit(template)
    for name, v in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), T.given(v.cast("string")))
    return out


def window_prompt(segments: Column, speakers: list[str], n: int, template: str = WINDOW) -> Column:
    """A prompt for a window: its rows rendered, a line each."""
    lines = F.array_join(F.transform(segments, lambda s: T.format_segment(s["start"], s["end"], s["speaker"], s["text"])), "\n")
    return fill(template, n=F.lit(n), speakers=F.lit(", ".join(speakers)), transcript=lines)


def fit_prompt(question: Column, answer: Column, source: Column, template: str = FIT) -> Column:
    return fill(template, question=question, answer=answer, source=source)


def topic_prompt(path: Column, n: int, system: Column, examples: Column, template: str = TOPICS) -> Column:
    """A prompt to expand a topic path; the domain comes from the system prompt and the path."""
    joined = F.array_join(path, " -> ")
    return fill(template, domain=T.domain(F.concat_ws(" ", system, F.array_join(path, " "))), n=F.lit(n), path=joined, examples=examples)


def signature(tool: Column) -> Column:
    """name(param: type, optional: type = None) -> returns, of a tool struct."""
    one = lambda p: F.concat(p["name"], F.lit(": "), p["type"], F.when(F.coalesce(p["required"], F.lit(True)), "").otherwise(" = None"))
    return F.concat(tool["name"], F.lit("("), F.array_join(F.transform(tool["parameters"], one), ", "), F.lit(") -> "), T.given(tool["returns"]))


def bullets(items: Column) -> Column:
    """Texts as lines with a dash."""
    return F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")


def sample_prompts(paths: DataFrame, n: int, system: str = "", instructions: str = "", seed: int = 7, template: str = SAMPLE) -> DataFrame:
    """(path, prompt) of n paths of least seeded hash; fails where there are fewer."""
    from tessera.operators.quality import hash_rank

    if paths.count() < n:
        raise ValueError(f"fewer than {n} topic paths")
    rows = paths.orderBy(hash_rank(F.array_join("path", "\u0001"), seed)).limit(n)
    return rows.withColumn("prompt", fill(template, system=F.lit(system), instructions=F.lit(instructions), path=F.array_join("path", " -> "), tools=F.lit(""), examples=F.lit("")))
