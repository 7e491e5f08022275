"""Sources and sinks: JSONL with line numbers, transcripts, tables of topics and tools, ordered writers, manifests.

Line numbers come from the blocks of a file: each block's lines are numbered by itself, and start after the lines of the blocks
before it, of which only the counts meet. So a file may be of any size, and its blocks are read apart. Documents that are one
JSON value (a transcript, a graph, a tool file) are read whole.
"""

from __future__ import annotations

import json
import os
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.functions import text as T


def lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(source_path, line, value) of text files, lines counted from 1, blank ones included."""
    paths = [path] if isinstance(path, str) else path
    raw = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    own = raw.withColumn("k", F.row_number().over(Window.partitionBy("source_path", "block").orderBy("at")))
    counts = spark.read.text(paths).groupBy(F.col("_metadata.file_path").alias("source_path"), F.col("_metadata.file_block_start").alias("block")).count()
    before = counts.withColumn("before", F.coalesce(F.sum("count").over(Window.partitionBy("source_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = own.join(before.select("source_path", "block", "before"), ["source_path", "block"])
    return out.select("source_path", (F.col("k") + F.col("before")).cast("int").alias("line"), "value")


def jsonl(spark: SparkSession, path: str | list[str], strict: bool = False) -> DataFrame:
    """(source_path, line, value, valid) of the lines that are not blank; strict: the query fails at the first bad line."""
    rows = lines(spark, path).filter(T.strip(F.col("value")) != "").withColumn("valid", F.try_parse_json("value").isNotNull())
    if strict:
        said = F.concat(F.lit("bad JSON in "), F.col("source_path"), F.lit(" line "), F.col("line").cast("string"))
        rows = rows.withColumn("value", F.when(F.col("valid"), F.col("value")).otherwise(F.raise_error(said).cast("string")))
    return rows


def stem(path: Column) -> Column:
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")


def segments(spark: SparkSession, path: str | list[str], min_chars: int = 0, speaker: str = "Unknown") -> DataFrame:
    """Segments of transcript JSONL: the episode defaults to the file's stem, missing times are NaN, order is the line."""
    kind = "struct<episode_id:string,start:string,end:string,speaker:string,text:string>"
    x = jsonl(spark, path, strict=True).withColumn("x", F.from_json("value", kind))
    return x.select(
        F.coalesce(F.nullif("x.episode_id", F.lit("")), stem(F.col("source_path"))).alias("episode_id"), F.col("line").alias("seq"), T.to_number(F.col("x.start")).alias("start"), T.to_number(F.col("x.end")).alias("end"),
        F.coalesce(F.nullif("x.speaker", F.lit("")), F.lit(speaker)).alias("speaker"), T.strip(F.col("x.text")).alias("text"), "source_path",
    ).filter(F.length("text") >= min_chars)


def timed_segments(spark: SparkSession, path: str | list[str], min_chars: int = 0) -> DataFrame:
    """segments() of ``min_chars`` or more, unnamed speakers ``unknown``, seq by start (unknown times last), then line."""
    rows = segments(spark, path, min_chars, "unknown")
    late = F.coalesce(F.nanvl("start", F.lit(float("inf"))), F.lit(float("inf")))
    return rows.withColumn("seq", F.row_number().over(Window.partitionBy("source_path").orderBy(late, "seq")))


def whole_transcript(spark: SparkSession, path: str) -> DataFrame:
    """Segments (source_path, seq, start, end, speaker, text) of files of either kind: .json is a list or an object with
    ``segments``; any other file is one segment of ``speaker_0``."""
    kind = "array<struct<start:double,end:double,speaker:string,text:string>>"
    raw = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("source_path"), "value")
    found = F.coalesce(F.from_json(F.get_json_object("value", "$.segments"), kind), F.from_json("value", kind))
    none = F.lit(None).cast("double")
    one = F.array(F.struct(none.alias("start"), none.alias("end"), F.lit("speaker_0").alias("speaker"), F.col("value").alias("text")))
    said = F.when(F.endswith("source_path", F.lit(".json")), found).otherwise(one)
    return raw.select("source_path", F.posexplode(said).alias("seq", "s")).select("source_path", "seq", "s.*")


def transcript(spark: SparkSession, path: str) -> DataFrame:
    """Segments of one transcript: a JSON list, an object with ``segments``, or text with ``[hh:mm] SPEAKER: words`` lines.

    A text line that names no speaker goes on with the line before it.
    """
    if path.endswith(".json"):
        kind = "array<struct<start:double,end:double,speaker:string,text:string>>"
        raw = spark.read.text(path, wholetext=True).select(F.coalesce(F.from_json(F.get_json_object("value", "$.segments"), kind), F.from_json("value", kind)).alias("s"))
        return raw.select(F.posexplode("s").alias("seq", "s")).select("seq", "s.*")
    rule = r"^\[(\d+):(\d{2})\]\s*([^:]+):\s*(.*)$"
    rows = lines(spark, path).filter(T.strip(F.col("value")) != "").withColumn("named", F.col("value").rlike(rule))
    rows = rows.withColumn("seq", F.sum(F.col("named").cast("int")).over(Window.partitionBy("source_path").orderBy("line")))
    own = F.when(F.col("named"), F.regexp_extract("value", rule, 4)).otherwise(T.strip(F.col("value")))
    start = F.regexp_extract("value", rule, 1).try_cast("int") * 3600.0 + F.regexp_extract("value", rule, 2).try_cast("int") * 60.0
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", own.alias("t")))), lambda x: x["t"]), " ")
    return rows.groupBy("source_path", "seq").agg(F.max(start).alias("start"), F.min_by(F.when(F.col("named"), F.trim(F.regexp_extract("value", rule, 3))).otherwise("speaker_0"), "line").alias("speaker"), joined.alias("text"))


def topic_paths(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The (path) rows and the failed generations of a topic tree's JSONL."""
    rows = jsonl(spark, path).filter("valid")
    got = rows.select(F.from_json(F.get_json_object("value", "$.path"), "array<string>").alias("path")).filter("path is not null")
    return got, rows.select(F.get_json_object("value", "$.failed_generation").alias("failed_generation")).filter("failed_generation is not null")


def topic_graph(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, topic, is_root) and edges (parent_id, child_id) of a graph's JSON."""
    kind = "struct<nodes:map<string,struct<id:int,topic:string,children:array<int>>>,root_id:int>"
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", kind).alias("g"))
    nodes = whole.select(F.col("g.root_id").alias("root"), F.explode(F.map_values("g.nodes")).alias("n")).select("n.*", (F.col("n.id") == F.col("root")).alias("is_root"))
    return nodes.select("id", "topic", "is_root"), nodes.select(F.col("id").alias("parent_id"), F.explode("children").alias("child_id")).distinct()


def _parsed(path: str, text: str):
    """What a JSON or, where a YAML reader is installed, a YAML file holds."""
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as e:
            raise ValueError(f"{path}: no YAML reader is installed; use JSON") from e
        return yaml.safe_load(text)
    return json.loads(text)


TOOL = "name string, description string, category string, returns string, parameters array<struct<name:string,type:string,description:string,required:boolean>>"


def tools(spark: SparkSession, path: str) -> DataFrame:
    """Tools (tool_index, name, ...) of a JSON or YAML file: a list, or an object with ``tools``; those without a name are left out.

    A tool file is a configuration of at most a few thousand entries, read on the driver.
    """
    text = spark.read.text(path, wholetext=True).first()[0]
    held = _parsed(path, text)
    held = held.get("tools") if isinstance(held, dict) else held
    if not isinstance(held, list):
        raise ValueError(f"{path}: neither a list nor an object with tools")
    rows = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(held)], "tool_index int, value string")
    return rows.select("tool_index", F.from_json("value", TOOL).alias("t")).select("tool_index", "t.*").filter("name is not null")


def tool_errors(definition: Column) -> Column:
    """What is wrong with one tool's JSON: names of failing checks."""
    from tessera.operators.gates import failing

    x = F.from_json(definition, TOOL)
    named = F.forall(F.coalesce(x["parameters"], F.array().cast(TOOL_PARAMETERS)), lambda p: F.coalesce(T.strip(p["name"]) != "", F.lit(False)) & F.coalesce(p["type"], F.lit("str")).isin(*PARAMETER_TYPES))
    return failing(json=F.json_object_keys(definition).isNotNull(), name=T.strip(x["name"]) != "", description=T.strip(x["description"]) != "", parameters=named)


TOOL_PARAMETERS = "array<struct<name:string,type:string,description:string,required:boolean>>"
#: The types that a tool's parameter may have.
PARAMETER_TYPES = ("str", "int", "float", "bool", "list", "dict")


def config(spark: SparkSession, path: str) -> dict:
    """A run's configuration from JSON or YAML, on the driver; sections that hold their settings under ``args``, as older files do,
    are unwrapped."""
    held = _parsed(path, spark.read.text(path, wholetext=True).first()[0])
    if not isinstance(held, dict):
        raise ValueError(f"{path}: a configuration is an object")
    return {k: {**{a: b for a, b in v.items() if a != "args"}, **v["args"]} if isinstance(v, dict) and isinstance(v.get("args"), dict) else v for k, v in held.items()}


def write_jsonl(df: DataFrame, path: str, order: str | None = None, one_file: bool = False) -> None:
    """One JSON object a line, nulls written; ordered by a column, range-partitioned unless one file is asked for."""
    rows = df.select(*([F.col(order).alias("_o")] if order else []), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("value"))
    rows = rows.coalesce(1).sortWithinPartitions("_o") if one_file and order else rows.coalesce(1) if one_file else rows.orderBy("_o") if order else rows
    rows.select("value").write.mode("overwrite").text(path)


def ascii_json(value: Column) -> Column:
    """JSON text with every character over ASCII as an escape of its UTF-16 units."""
    units = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")
    spelt = F.array_join(F.transform(F.split(value, ""), lambda c: F.when(c.rlike(r"[^\x00-\x7f]"), units(c)).otherwise(c)), "")
    return F.when(value.rlike(r"[^\x00-\x7f]"), spelt).otherwise(value)


def squeezed_json(df: DataFrame) -> DataFrame:
    """(value): rows as ASCII JSON with runs of white space in one space."""
    return df.select(F.regexp_replace(ascii_json(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})), r"\s+", " ").alias("value"))


def channel_records(df: DataFrame) -> DataFrame:
    """(value) lines from (system, user, analysis, final, metadata): fails where a channel is empty."""
    filled = ~T.blank(F.col("analysis")) & ~T.blank(F.col("final"))
    none = F.lit(None).cast("string")
    m = lambda r, c, a, f: F.struct(F.lit(r).alias("role"), c.alias("content"), a.alias("analysis"), f.alias("final"))
    said = F.array(m("system", F.col("system"), none, none), m("user", F.col("user"), none, none), m("assistant", none, F.col("analysis"), F.col("final")))
    return df.select(F.when(filled, F.to_json(F.struct(said.alias("messages"), "metadata"))).otherwise(F.raise_error(F.lit("analysis and final must not be empty")).cast("string")).alias("value"))


def audit_table(df: DataFrame) -> DataFrame:
    """(value): lines of a Markdown table, a dash where a value is missing, headed by a line each for names and rule."""
    spark = df.sparkSession
    head = spark.createDataFrame([(0, "| " + " | ".join(df.columns) + " |"), (1, "|" + " --- |" * len(df.columns))], "k int, value string")
    cells = F.concat_ws(" | ", *[F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("-")) for c in df.columns])
    return head.union(df.select(F.lit(2).alias("k"), F.concat(F.lit("| "), cells, F.lit(" |")).alias("value")))


def manifest(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, sha256, records) of files: hash of the bytes and lines that are not blank."""
    raw = spark.read.format("binaryFile").load(paths)
    n = F.size(F.filter(F.split(F.decode("content", "utf-8"), "\n"), lambda x: F.trim(x) != ""))
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("sha256"), n.alias("records"))


def same_manifest(now: DataFrame, then: DataFrame) -> DataFrame:
    """Rows in which two manifests differ; none if nothing changed."""
    a, b = now.select("file", F.col("sha256").alias("now")), then.select("file", F.col("sha256").alias("then"))
    return a.join(b, "file", "full").filter(~F.col("now").eqNullSafe(F.col("then")))


def sidecar_path(training: str) -> str | None:
    """The sidecar beside a training file: sidecar_NAME, or NAME_metadata as older runs wrote it."""
    folder, name = os.path.split(training)
    base, ext = os.path.splitext(name)
    for guess in (f"sidecar_{name}", f"{base}_metadata{ext}"):
        if os.path.exists(os.path.join(folder, guess)):
            return os.path.join(folder, guess)
    return None


class Uploader(Protocol):
    """A hub that takes files; implementations bring their own network client."""

    def upload(self, files: list[str], name: str, card: str) -> dict[str, str]:
        """Puts the files under a name with a card; returns status (success or error) and message."""


def upload(spark: SparkSession, path: str, name: str, card: str, hub: Uploader) -> dict[str, str]:
    """A written table's part files, handed to a hub; an error is reported, not raised."""
    found = [r[0] for r in spark.read.format("binaryFile").load(path).select("path").orderBy("path").collect()]  # names alone
    if not found:
        return {"status": "error", "message": f"{path} holds no files"}
    try:
        return hub.upload(found, name, card)
    except Exception as e:  # noqa: BLE001
        return {"status": "error", "message": str(e)}
