"""Samples as JSON text: typed parses, function calls, chat messages, checks before and after a format, examples and choices.

Samples differ in their fields, so they stay JSON text and every operation here is an expression over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import formats as X
from tessera.operators import gates as G
from tessera.operators.quality import hash_rank

#: The roles of chat messages by the actor of a turn; fields of the typed samples.
CHAT_ROLES = {"human": "user", "gpt": "assistant", "function_call": "assistant", "observation": "user"}
COT = "struct<question:string,chain_of_thought:string,final_answer:string>"
STRUCTURED = "struct<messages:array<struct<role:string,content:string>>,reasoning_trace:array<struct<thought:string,action:string>>,final_answer:string>"
QA = "struct<question:string,answer:string,final_answer:string,context:string>"
TALK = "struct<messages:array<struct<role:string,content:string>>>"
ROLES = ("system", "user", "assistant", "tool", "function")
NUMBER = r"[+-]?\d[\d,]*(\.\d+)?"


def data_of(sample: Column) -> Column:
    """The sample's own object: what a wrapper holds under ``data``, else the sample; null if it is no JSON object."""
    inner = F.when(F.json_object_keys(X.field(sample, "data")).isNotNull() & (F.size(F.json_object_keys(sample)) == 1), X.field(sample, "data"))
    return F.when(F.json_object_keys(sample).isNotNull(), F.coalesce(inner, sample))


def as_conversation(sample: Column) -> Column:
    """The messages if the sample has some and all have a known role and a content."""
    x = F.from_json(sample, TALK)["messages"]
    good = (F.size(x) > 0) & F.forall(x, lambda m: F.coalesce(m["role"].isin(*ROLES) & m["content"].isNotNull(), F.lit(False)))
    return F.when(F.coalesce(good, F.lit(False)), x)


def as_qa(sample: Column) -> Column:
    """(question, answer, final_answer, context) if there is a question and an answer of either kind."""
    return F.when(X.is_qa(sample), F.from_json(sample, QA))


def as_structured(sample: Column) -> Column:
    """(messages, reasoning_trace, final_answer) if all three are there."""
    return F.when(X.has(sample, "messages", "reasoning_trace", "final_answer"), F.from_json(sample, STRUCTURED))


def kind_of(sample: Column) -> Column:
    """The first type that a sample fits: structured, conversation, qa, generic; null if it is no JSON object."""
    return (
        F.when(F.json_object_keys(sample).isNull(), F.lit(None)).when(as_structured(sample).isNotNull(), "structured").when(as_conversation(sample).isNotNull(), "conversation")
        .when(as_qa(sample).isNotNull(), "qa").otherwise("generic")
    )


def add_samples(data: DataFrame, more: DataFrame, col: str = "sample") -> tuple[DataFrame, DataFrame]:
    """All valid samples of both, and those that are not, with why: bag union, repeats stay."""
    rows = data.select(col).unionByName(more.select(col)).withColumn("_ok", G.sample_valid(F.col(col)))
    why = F.when(F.json_object_keys(F.col(col)).isNull(), "not a JSON object").otherwise("empty or invalid messages or values")
    return rows.filter("_ok").drop("_ok"), rows.filter(~F.coalesce("_ok", F.lit(False))).select(col, why.alias("reason"))


def at(data: DataFrame, index: int, col: str = "record_index") -> DataFrame:
    """The row at a position."""
    return data.filter(F.col(col) == index)


def function_calls(sample: Column) -> Column:
    """array<struct<name, arguments>> of the function_call turns that are JSON with a name, in order; arguments as JSON text."""
    said = F.transform(F.filter(X.xlam_turns(sample), lambda t: t["from"] == "function_call"), lambda t: t["value"])
    return F.transform(F.filter(said, lambda v: X.has(v, "name")), lambda v: F.struct(X.field(v, "name").alias("name"), X.field(v, "arguments").alias("arguments")))


def chat_messages(sample: Column, system: Column | None = None) -> Column:
    """Turns as chat messages (role, content), a filled system text first."""
    roles = F.create_map(*[F.lit(x) for pair in CHAT_ROLES.items() for x in pair])
    turns = F.filter(X.xlam_turns(sample), lambda t: t["from"].isin(*CHAT_ROLES))
    talk = F.transform(turns, lambda t: X.message(roles[t["from"]], T.given(t["value"])))
    told = X.filled(system if system is not None else X.field(sample, "system"))
    return F.when(told.isNotNull(), F.array_prepend(talk, X.message("system", told))).otherwise(talk)


def chat_text(messages: Column, ask: bool = False) -> Column:
    """Messages between start and end tokens, a line end after each; ask: the assistant's turn is opened."""
    text = F.array_join(F.transform(messages, lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n"), T.given(m["content"]), F.lit("<|im_end|>\n"))), "")
    return F.concat(text, F.lit("<|im_start|>assistant\n")) if ask else text


def input_ok(name: str, s: Column) -> Column:
    """Whether a sample has what a format needs."""
    ms = X.messages(s)
    role = lambda r: F.coalesce(F.exists(ms, lambda m: m["role"] == r), F.lit(False))
    talk = F.coalesce(F.size(ms) > 0, F.lit(False))
    ask, reply = X.first_of(s, "instruction", "prompt", "question", "input", "query", "problem", "task"), X.first_of(s, "output", "response", "answer", "solution", "result", "final_answer")
    pair = ask.isNotNull() & reply.isNotNull()
    tool = X.has(s, "question", "tool_used") & (X.has(s, "answer") | X.has(s, "final_answer"))
    rules = {
        "alpaca": (talk & role("user")) | (X.has(s, "instruction", "output")) | X.is_qa(s) | pair, "chatml": talk | X.is_qa(s) | pair,
        "harmony": talk | X.is_qa(s) | pair, "grpo": (talk & role("user")) | X.is_qa(s) | pair, "unsloth": F.coalesce(F.size(X.extract_messages(s)) > 0, F.lit(False)),
        "unsloth_grpo": talk | pair, "im_format": F.coalesce(F.size(X.extract_messages(s)) > 0, F.lit(False)), "single_tool_call": tool, "tool_calling": tool, "xlam_v2": X.xlam_valid(s),
    }
    return F.coalesce(rules[name], F.lit(False))


def output_ok(name: str, out: Column) -> Column:
    """Whether a formatted struct holds what its format promises.

    alpaca: filled instruction and output; chatml, im_format, harmony: balanced start and end tokens; grpo: every reply has both tag
    pairs in order and a number in its solution (grpo_numeric) or any solution; the conversations: a known role and text each.
    """
    text = lambda: T.given(out["text"])
    times = lambda x, w: F.size(F.split(x, w)) - 1
    if name == "alpaca":
        ok = (T.given(out["instruction"]) != "") & (T.given(out["output"]) != "")
    elif name in ("chatml", "im_format"):
        ok = (times(text(), r"<\|im_start\|>") > 0) & (times(text(), r"<\|im_start\|>") == times(text(), r"<\|im_end\|>"))
    elif name == "harmony":
        ok = (times(text(), r"<\|start\|>") > 0) & (times(text(), r"<\|start\|>") == times(text(), r"<\|end\|>"))
    elif name in ("grpo", "grpo_numeric"):
        inner = NUMBER if name == "grpo_numeric" else r".+?"
        rule = f"(?s){X.THINK}.*?{X.UNTHINK}.*?{X.SOLVE}\\s*{inner}\\s*{X.UNSOLVE}"
        said = F.filter(out["messages"], lambda m: m["role"] == "assistant")
        ok = (F.size(said) > 0) & F.forall(said, lambda m: m["content"].rlike(rule))
    elif name == "xlam_v2":
        ok = (F.size(out["conversations"]) > 0) & F.forall(out["conversations"], lambda t: t["from"].isin(*CHAT_ROLES) & t["value"].isNotNull()) & F.try_parse_json(out["tools"]).isNotNull() & out["system"].isNotNull()
    else:
        talk = out["messages"] if name in ("single_tool_call", "tool_calling") else out["conversations"]
        ok = (F.size(talk) > 0) & F.forall(talk, lambda m: m["role"].isin(*ROLES) & (T.given(m["content"]) != ""))
    return F.coalesce(ok, F.lit(False))


def choose(rows: DataFrame, n: int, key: Column, seed: int = 7) -> DataFrame:
    """n rows of least seeded hash (all, if there are fewer): few-shot examples, or records to look at."""
    return rows.orderBy(hash_rank(key, seed), key).limit(n)


def creation_errors(steps: int, batch: int, paths: int | None, kind: str, kinds: tuple[str, ...]) -> list[str]:
    """What is wrong with the parameters of a generation run."""
    out = []
    if steps < 1:
        out.append("steps must be positive")
    if batch < 1:
        out.append("batch size must be positive")
    if kind not in kinds:
        out.append(f"unknown conversation type {kind}")
    if paths is not None and steps * batch > paths:
        out.append(f"{steps * batch} samples need as many topic paths, {paths} are there")
    return out


def template_name(kind: Column, style: Column) -> Column:
    """The prompt template by conversation type and reasoning style: chains of thought have a mathematical form of their own."""
    cot = F.when(kind.isin("cot_freetext", "cot_structured", "cot_hybrid"), F.when(style == "mathematical", F.concat(kind, F.lit("_mathematical"))).otherwise(kind))
    tools = F.when(kind.isin("tool_calling", "agent_cot_tools", "agent_cot_hybrid", "agent_cot_multi_turn", "xlam_multi_turn"), kind)
    return F.coalesce(cot, tools, F.when(kind == "structured", kind), F.lit("basic"))


def missed(prompts: DataFrame, replies: DataFrame, key: str) -> DataFrame:
    """The prompts without a usable reply, to be asked again."""
    return prompts.join(replies.filter("reply is not null").select(key).distinct(), key, "left_anti")
