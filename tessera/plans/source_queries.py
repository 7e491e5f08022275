"""Queries of sources and sinks: files are written to the shared folder from the tables, and read back by the readers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators import chunking as K
from tessera.operators import prompts
from tessera.operators import topics as P
from tessera.plans.tables import registrar, table
from tessera.sources import files as D
from tessera.sources.shared import shared_dir

QUERIES, ORACLE_SQL, query = registrar()


def _folder(spark, name: str) -> str:
    return f"{shared_dir(spark)}/tessera-{name}-{uuid.uuid4().hex}"


def _write(rows: DataFrame, path: str, *order: str) -> str:
    """rows (value and the order) as one text file."""
    rows.coalesce(1).sortWithinPartitions(*order).select("value").write.text(path)
    return path


def _lines(spark, sf_dir):
    """Conversations as lines of a transcript file, a blank line after the first turn of every fifth, with fields left out."""
    c = table(spark, sf_dir, "conversations")
    start = F.when(F.col("turn") % 3 == 0, F.lit(None)).otherwise((F.col("conv_id") * 100 + F.col("turn")).cast("double"))
    x = F.struct(F.col("conv_id").cast("string").alias("episode_id"), start.alias("start"), (F.col("conv_id") * 100.0 + F.col("turn") + 0.5).alias("end"), F.when(F.col("turn") % 4 != 3, F.col("role")).alias("speaker"), F.concat(F.lit("  "), "text").alias("text"))
    blank = (F.col("conv_id") % 5 == 0) & (F.col("turn") == 0)
    values = F.when(blank, F.array(F.to_json(x), F.lit(""))).otherwise(F.array(F.to_json(x)))
    return c.select("conv_id", "turn", F.posexplode(values).alias("k", "value"))


_LINES = """l AS (SELECT *, (sum(1 + (conv_id % 5 = 0 AND turn = 0)::INT) OVER (ORDER BY conv_id, turn ROWS UNBOUNDED PRECEDING) - (conv_id % 5 = 0 AND turn = 0)::INT)::BIGINT AS line,
    CASE WHEN turn % 3 = 0 THEN NULL ELSE (conv_id * 100 + turn)::DOUBLE END AS s FROM conversations)"""


@query(f"WITH {_LINES} SELECT conv_id::VARCHAR AS episode_id, line::INTEGER AS seq, s IS NULL AS no_start, conv_id * 100.0::DOUBLE + turn + 0.5::DOUBLE AS \"end\", CASE WHEN turn % 4 = 3 THEN 'Unknown' ELSE role END AS speaker, md5(trim(text)) AS text FROM l")
def q_jsonl_segments(spark, sf_dir):
    path = _write(_lines(spark, sf_dir), _folder(spark, "segments"), "conv_id", "turn", "k")
    return D.segments(spark, path).select("episode_id", "seq", F.isnan("start").alias("no_start"), "end", "speaker", F.md5("text").alias("text"))


@query(f"WITH {_LINES} SELECT conv_id::VARCHAR AS episode_id, row_number() OVER (ORDER BY coalesce(s, 'inf'::DOUBLE), line)::INTEGER AS seq, CASE WHEN turn % 4 = 3 THEN 'unknown' ELSE role END AS speaker, md5(trim(text)) AS text FROM l WHERE length(trim(text)) >= 120")
def q_timed_segments(spark, sf_dir):
    path = _write(_lines(spark, sf_dir), _folder(spark, "timed"), "conv_id", "turn", "k")
    return D.timed_segments(spark, path, 120).select("episode_id", "seq", "speaker", F.md5("text").alias("text"))


@query("SELECT conv_id::VARCHAR AS episode_id, count(*) AS n, md5(string_agg(trim(text), '|' ORDER BY turn)) AS texts FROM conversations GROUP BY conv_id")
def q_transcript_globs(spark, sf_dir):
    path = _folder(spark, "globs")
    rows = _lines(spark, sf_dir)
    for k in range(2):
        rows.filter(F.col("conv_id") % 2 == k).repartitionByRange(3, "conv_id").sortWithinPartitions("conv_id", "turn", "k").select("value").write.text(f"{path}/part{k}")
    read = D.segments(spark, [f"{path}/part0/*.txt", f"{path}/part1/*.txt"])
    order = F.transform(F.array_sort(F.collect_list(F.struct("source_path", "seq", "text"))), lambda x: x["text"])
    return read.groupBy("episode_id").agg(F.count("*").alias("n"), F.md5(F.array_join(order, "|")).alias("texts"))


@query("SELECT row_number() OVER (ORDER BY doc_id)::INTEGER AS line, doc_id % 4 <> 0 AS valid, CASE WHEN doc_id % 4 <> 0 THEN lang END AS lang FROM documents")
def q_jsonl_valid(spark, sf_dir):
    whole = F.to_json(F.struct("doc_id", "lang"))
    rows = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("doc_id") % 4 == 0, F.substring(whole, 1, 9)).otherwise(whole).alias("value"))
    read = D.jsonl(spark, _write(rows, _folder(spark, "jsonl"), "doc_id"))
    return read.select("line", "valid", F.when(F.col("valid"), F.get_json_object("value", "$.lang")).alias("lang"))


@query("SELECT (row_number() OVER (ORDER BY n_nationkey) - 1)::INTEGER AS seq, n_nationkey::DOUBLE AS start, n_name AS speaker, n_name || '!' AS text FROM nation UNION ALL SELECT 0, NULL, 'speaker_0', string_agg(r_name || chr(10), '' ORDER BY r_name) FROM region")
def q_whole_transcript(spark, sf_dir):
    path = _folder(spark, "whole")
    n = table(spark, sf_dir, "nation")
    said = F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name", F.concat("n_name", F.lit("!")).alias("c")))), lambda x: F.struct(x["n_nationkey"].cast("double").alias("start"), (x["n_nationkey"] + 1).cast("double").alias("end"), x["n_name"].alias("speaker"), x["c"].alias("text")))
    n.agg(said.alias("segments")).coalesce(1).write.json(f"{path}/list")
    _write(table(spark, sf_dir, "region").select(F.col("r_name").alias("value")), f"{path}/text", "value")
    return D.whole_transcript(spark, f"{path}/*").select("seq", "start", "speaker", "text")


@query(
    """WITH c AS (SELECT *, turn % 3 <> 1 AS named FROM conversations), i AS (SELECT *, sum(named::INT) OVER (ORDER BY conv_id, turn ROWS UNBOUNDED PRECEDING)::BIGINT AS seq FROM c)
    SELECT seq, max(CASE WHEN named THEN (conv_id % 24) * 3600.0::DOUBLE + (turn % 60) * 60.0::DOUBLE END) AS start, max(CASE WHEN named THEN role END) AS speaker, md5(string_agg(replace(trim(text), chr(10), ' '), ' ' ORDER BY conv_id, turn)) AS text FROM i GROUP BY seq"""
)
def q_transcript_lines(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    head = F.format_string("[%02d:%02d] %s: ", F.col("conv_id") % 24, F.col("turn") % 60, F.col("role"))
    rows = c.select("conv_id", "turn", F.concat(F.when(F.col("turn") % 3 == 1, "").otherwise(head), F.replace("text", F.lit("\n"), F.lit(" "))).alias("value"))
    return D.transcript(spark, _write(rows, _folder(spark, "lines"), "conv_id", "turn")).select("seq", "start", "speaker", F.md5("text").alias("text"))


@query("SELECT r_name || '>' || n_name AS path FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'failed: ' || r_name FROM region")
def q_topic_files(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    paths = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.array("r_name", "n_name").alias("path"))
    rows, failed = P.tree_rows(paths, r.select(F.concat(F.lit("failed: "), "r_name").alias("failed_generation")))
    got, bad = D.topic_paths(spark, _write(rows.union(failed), _folder(spark, "topics"), "value"))
    return got.select(F.array_join("path", ">").alias("path")).union(bad.select("failed_generation"))


@query(
    """WITH k AS (SELECT r_regionkey + 1 AS id, string_agg((100 + n_nationkey)::VARCHAR, ',' ORDER BY n_nationkey) AS children FROM region JOIN nation ON n_regionkey = r_regionkey GROUP BY 1)
    SELECT 0 AS id, 'world' AS topic, true AS is_root, string_agg((r_regionkey + 1)::VARCHAR, ',' ORDER BY r_regionkey) AS children, '' AS parents FROM region
    UNION ALL SELECT (r_regionkey + 1)::INTEGER, r_name, false, coalesce(children, ''), '0' FROM region LEFT JOIN k ON id = r_regionkey + 1
    UNION ALL SELECT (100 + n_nationkey)::INTEGER, n_name, false, '', (n_regionkey + 1)::VARCHAR FROM nation"""
)
def q_graph_file(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    kids = n.groupBy((F.col("n_regionkey") + 1).cast("int").alias("id")).agg(F.sort_array(F.collect_list((F.col("n_nationkey") + 100).cast("int"))).alias("children"))
    empty = F.array().cast("array<int>")
    nodes = r.agg(F.sort_array(F.collect_list((F.col("r_regionkey") + 1).cast("int"))).alias("children")).select(F.lit(0).alias("id"), F.lit("world").alias("topic"), "children")
    nodes = nodes.unionByName(r.select((F.col("r_regionkey") + 1).cast("int").alias("id"), F.col("r_name").alias("topic")).join(kids, "id", "left").withColumn("children", F.coalesce("children", empty)))
    nodes = nodes.unionByName(n.select((F.col("n_nationkey") + 100).cast("int").alias("id"), F.col("n_name").alias("topic"), empty.alias("children")))
    held = nodes.agg(F.to_json(F.struct(F.map_from_entries(F.collect_list(F.struct(F.col("id").cast("string"), F.struct("id", "topic", "children")))).alias("nodes"), F.lit(0).alias("root_id"))).alias("value"))
    found, edges = D.topic_graph(spark, _write(held, _folder(spark, "graph"), "value"))
    out = P.graph_json(found, edges).join(found.select("id", "is_root"), "id")
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",")
    return out.select("id", "topic", "is_root", text("children").alias("children"), text("parents").alias("parents"))


@query(
    """WITH w(i, name) AS (VALUES (0, 'NATION_12'), (1, 'NOWHERE'), (2, 'NATION_2'), (3, 'NATION_18')), t AS (SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS k, * FROM nation WHERE n_name IS NOT NULL)
    SELECT k::INTEGER AS tool_index, n_name AS name, 'r' || n_regionkey AS category, n_name || '(key: int, mode: str' || CASE WHEN n_nationkey % 2 = 0 THEN ' = None' ELSE '' END || ') -> row' AS signature FROM t JOIN w ON name = n_name"""
)
def q_tools_file(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    param = lambda name, kind, need: F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"), F.lit("").alias("description"), need.alias("required"))
    tool = F.struct(F.col("n_name").alias("name"), F.lit("d").alias("description"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("category"), F.lit("row").alias("returns"), F.array(param("key", "int", F.lit(True)), param("mode", "str", F.col("n_nationkey") % 2 == 1)).alias("parameters"))
    held = n.agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", tool.alias("t")))), lambda x: x["t"]).alias("tools"))).alias("value"))
    tools = D.tools(spark, _write(held, _folder(spark, "tools"), "value"))
    picked = P.pick_tools(tools, ["NATION_12", "NOWHERE", "NATION_2", "NATION_18"])
    return picked.select("tool_index", "name", "category", prompts.signature(F.struct("name", "parameters", "returns")).alias("signature"))


@query("SELECT 'r' || n_regionkey AS category, count(*) AS tools, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def q_tool_categories(spark, sf_dir):
    tools = table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("category"))
    return P.categories(tools).select("category", "tools", F.array_join("names", ",").alias("names"))


@query("SELECT doc_id, array_to_string(list_filter([CASE doc_id % 5 WHEN 0 THEN 'json' END, CASE WHEN doc_id % 5 IN (0, 1) THEN 'name' END, CASE WHEN doc_id % 5 IN (0, 2) THEN 'description' END, CASE WHEN doc_id % 5 = 3 THEN 'parameters' END], lambda x: x IS NOT NULL), ',') AS errors FROM documents")
def q_tool_definitions(spark, sf_dir):
    k = F.col("doc_id") % 5
    param = F.array(F.struct(F.lit("a").alias("name"), F.when(k == 3, "complex").otherwise("int").alias("type")))
    x = F.to_json(F.struct(F.when(k == 1, " ").otherwise(F.col("source")).alias("name"), F.when(k != 2, F.col("lang")).alias("description"), param.alias("parameters")))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(D.tool_errors(F.when(k == 0, "no tool").otherwise(x)), ",").alias("errors"))


@query("SELECT r_name AS section, 'key' AS setting, r_regionkey::VARCHAR AS value FROM region UNION ALL SELECT r_name, 'name', r_name FROM region WHERE r_regionkey % 2 = 0")
def q_config_file(spark, sf_dir):
    r = table(spark, sf_dir, "region").orderBy("r_regionkey")
    settings = F.when(F.col("r_regionkey") % 2 == 0, F.to_json(F.struct(F.struct(F.col("r_regionkey").alias("key")).alias("args"), F.col("r_name").alias("name")))).otherwise(F.to_json(F.struct(F.struct(F.col("r_regionkey").alias("key")).alias("args"))))
    text = r.agg(F.concat(F.lit("{"), F.array_join(F.collect_list(F.concat(F.lit('"'), "r_name", F.lit('": '), settings)), ", "), F.lit("}")).alias("value"))
    held = D.config(spark, _write(text, _folder(spark, "config"), "value"))
    return spark.createDataFrame([(s, k, str(v)) for s, x in held.items() for k, v in x.items()], "section string, setting string, value string")


_UNITS = "CASE WHEN ord(c) < 128 THEN c WHEN ord(c) < 65536 THEN '\\u' || lpad(lower(to_hex(ord(c))), 4, '0') ELSE '\\u' || lower(to_hex(55296 + (ord(c) - 65536) // 1024)) || '\\u' || lower(to_hex(56320 + (ord(c) - 65536) % 1024)) END"


@query(
    f"""WITH j AS (SELECT doc_id, '{{"doc_id":' || doc_id || ',"text":' || to_json(text)::VARCHAR || ',"source":' || to_json(source)::VARCHAR || '}}' AS v FROM documents)
    SELECT doc_id, md5(regexp_replace(CASE WHEN regexp_matches(v, '[^\\x00-\\x7f]') THEN array_to_string(list_transform(string_split(v, ''), lambda c: {_UNITS}), '') ELSE v END, '\\s+', ' ', 'g')) AS value FROM j"""
)
def q_dataset_file(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    value = F.regexp_replace(D.ascii_json(F.to_json(F.struct("doc_id", "text", "source"))), r"\s+", " ")
    return rows.select("doc_id", F.md5(value).alias("value"))


@query(
    """SELECT doc_id, '{"messages":[{"role":"system","content":"s"},{"role":"user","content":"' || source || '"},{"role":"assistant","analysis":"' || lang || '","final":"f' || doc_id || '"}],"metadata":{"id":' || doc_id || '}}' AS value FROM documents"""
)
def q_channel_lines(spark, sf_dir):
    rows = table(spark, sf_dir, "documents").select(F.lit("s").alias("system"), F.col("source").alias("user"), F.col("lang").alias("analysis"), F.concat(F.lit("f"), F.col("doc_id").cast("string")).alias("final"), F.struct(F.col("doc_id").alias("id")).alias("metadata"))
    out = D.channel_records(rows)
    return out.select(F.get_json_object("value", "$.metadata.id").cast("long").alias("doc_id"), "value")


@query("SELECT '| doc_id | lang | note |' AS value UNION ALL SELECT '| --- | --- | --- |' UNION ALL SELECT '| ' || doc_id || ' | ' || lang || ' | ' || CASE WHEN doc_id % 3 = 0 THEN '-' ELSE source END || ' |' FROM documents")
def q_audit_table(spark, sf_dir):
    note = F.when(F.col("doc_id") % 3 == 0, F.when(F.col("doc_id") % 2 == 0, "")).otherwise(F.col("source"))
    return D.audit_table(table(spark, sf_dir, "documents").select("doc_id", "lang", note.alias("note"))).select("value")


@query("""SELECT sha256(string_agg('{"doc_id":' || doc_id || ',"lang":"' || lang || '","gap":null}' || chr(10), '' ORDER BY doc_id)) AS sha256, count(*)::INTEGER AS records, 0::BIGINT AS changed FROM documents""")
def q_manifest(spark, sf_dir):
    path = _folder(spark, "manifest")
    D.write_jsonl(table(spark, sf_dir, "documents").select("doc_id", "lang", F.lit(None).cast("string").alias("gap")), path, "doc_id", one_file=True)
    now = D.manifest(spark, [f"{path}/*.txt"])
    changed = D.same_manifest(now, D.manifest(spark, [f"{path}/*.txt"])).count()
    return now.select("sha256", "records", F.lit(changed).cast("long").alias("changed"))


@query(
    """WITH n AS (SELECT *, 'r' || n_regionkey AS p FROM nation), l AS (SELECT '    n' || n_nationkey || '["' || n_name || ' ' || p || '"]' AS line FROM n)
    SELECT line FROM l UNION ALL SELECT '    ' || p || ' --> n' || n_nationkey FROM n
    UNION ALL SELECT '    w["one two three four five six<br>seven eight nine ten eleven<br>averyveryverylongwordthatstandsaloneintheline<br>x"]'"""
)
def q_graph_drawing(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    node = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"))
    up = F.concat(F.lit("r"), F.col("n_regionkey").cast("string"))
    long = spark.createDataFrame([("w", "one two three four five six seven eight nine ten eleven averyveryverylongwordthatstandsaloneintheline x")], "id string, topic string")
    return P.mermaid(n.select(node.alias("id"), F.concat_ws(" ", "n_name", up).alias("topic")).union(long), n.select(up.alias("parent_id"), node.alias("child_id")))


_CUT = """d AS (SELECT {key}, list_filter(list_transform(string_split(regexp_replace(trim({text}), '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s FROM {src}),
    u AS (SELECT {key}, i AS k, s[i] AS t, length(s[i]) // 4 AS n FROM (SELECT {key}, s, unnest(range(1, len(s) + 1)) AS i FROM d)),
    f AS (SELECT {key}, k, t, n, CASE WHEN n > {most} THEN ceil(n / {most})::BIGINT ELSE 1 END AS runs, 0::BIGINT AS first, CASE WHEN n > {most} THEN -1 ELSE n END AS held FROM u WHERE k = 1
      UNION ALL SELECT {ukey}, u.k, u.t, u.n, CASE WHEN u.n > {most} THEN ceil(u.n / {most})::BIGINT ELSE 1 END,
        CASE WHEN u.n <= {most} AND f.held >= 0 AND f.held + u.n <= {most} THEN f.first ELSE f.first + f.runs END,
        CASE WHEN u.n > {most} THEN -1 WHEN f.held >= 0 AND f.held + u.n <= {most} THEN f.held + u.n ELSE u.n END
      FROM f JOIN u ON {on} AND u.k = f.k + 1),
    p AS (SELECT {key}, first + r AS chunk, k, trim(substr(t, (4 * {most} * r + 1)::BIGINT, CASE WHEN r = runs - 1 THEN length(t) ELSE 4 * {most} END::BIGINT)) AS t, CASE WHEN n > {most} THEN least({most}, n - {most} * r) ELSE n END AS n FROM (SELECT *, unnest(range(0, runs)) AS r FROM f)),
    chunks AS (SELECT {key}, chunk::INTEGER AS chunk, string_agg(t, ' ' ORDER BY k) AS t, sum(n)::INTEGER AS tokens FROM p GROUP BY {key}, chunk)"""


@query(f"WITH RECURSIVE {_CUT.format(key='doc_id', ukey='u.doc_id', on='u.doc_id = f.doc_id', text='text', src='documents', most=200)} SELECT doc_id, chunk, md5(t) AS text, tokens FROM chunks")
def q_chunk_text(spark, sf_dir):
    cut = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(K.chunk_text(F.col("text"), 200, sql=True)).alias("chunk", "x"))
    return cut.select("doc_id", "chunk", F.md5("x.text").alias("text"), F.col("x.tokens").alias("tokens"))


@query(
    f"""WITH RECURSIVE c AS (SELECT conv_id, turn, role, text, (conv_id * 50 + turn * 8)::DOUBLE AS a, (conv_id * 50 + turn * 8 + 8)::DOUBLE AS b, CASE WHEN turn % 5 = 4 THEN 'speaker_0' ELSE role END AS who FROM conversations),
    {_CUT.format(key='conv_id, turn', ukey='u.conv_id, u.turn', on='u.conv_id = f.conv_id AND u.turn = f.turn', text='text', src='c', most=50)},
    n AS (SELECT conv_id, turn, count(*) AS n FROM chunks GROUP BY ALL)
    SELECT c.conv_id::VARCHAR AS source_file, c.turn AS seq, chunk, role || CASE WHEN chunk > 0 THEN '_chunk_' || (chunk + 1) ELSE '' END AS speaker, md5(t) AS text, CASE WHEN c.turn % 4 = 1 THEN NULL ELSE a + chunk * ((b - a) / n) END AS start_time, role = 'user' AS is_primary, tokens AS token_count,
      'chunk_' || lpad((row_number() OVER (PARTITION BY c.conv_id ORDER BY c.turn, chunk) - 1)::VARCHAR, 4, '0') AS id
    FROM chunks JOIN c USING (conv_id, turn) JOIN n USING (conv_id, turn)"""
)
def q_transcript_chunks(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    a = (F.col("conv_id") * 50 + F.col("turn") * 8).cast("double")
    told = F.col("turn") % 5 == 4
    rows = c.select(F.col("conv_id").cast("string").alias("source_file"), F.col("turn").alias("seq"), F.when(F.col("turn") % 4 != 1, a).alias("start"), (a + 8.0).alias("end"), F.when(told, "speaker_0").otherwise(F.col("role")).alias("speaker"), F.when(told, F.concat("role", F.lit(": "), "text")).otherwise(F.concat(F.lit(" "), "text")).alias("text"))
    rows = rows.unionByName(rows.limit(3).withColumn("text", F.lit("  ")))
    out = K.numbered(K.transcript_chunks(rows, "USER", 50), ["seq", "chunk"], "source_file")
    return out.select("source_file", "seq", "chunk", "speaker", F.md5("text").alias("text"), "start_time", "is_primary", "token_count", "id")


@query("SELECT 'chunk_' || CASE WHEN k < 10000 THEN lpad(k::VARCHAR, 4, '0') ELSE k::VARCHAR END AS id, doc_id FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS k FROM documents)")
def q_chunk_array(spark, sf_dir):
    path = _folder(spark, "chunks")
    K.write_chunks(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seq"), F.col("doc_id").cast("string").alias("text"), F.col("source").alias("source_file")), path, ["seq"])
    x = F.from_json("value", "struct<id:string,text:string>")
    return spark.read.text(path).select(x.alias("x")).select("x.id", F.col("x.text").cast("long").alias("doc_id"))


@query("SELECT conv_id, turn, (length(text) // 16 + (conv_id + turn) % 3)::DOUBLE AS start, conv_id % 4 AS i, (length(text) // 16 + (conv_id + turn) % 3 + (conv_id % 4) * (turn + 1) / 4.0)::DOUBLE AS first, (length(text) // 16 + (conv_id + turn) % 3 + (conv_id % 4 + 1) * (turn + 1) / 4.0)::DOUBLE AS last FROM conversations")
def q_interpolated_times(spark, sf_dir):
    start = (F.floor(F.length("text") / 16) + (F.col("conv_id") + F.col("turn")) % 3).cast("double")
    first, last = K.interpolate(F.col("start"), F.col("end"), F.col("i"), F.lit(4))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", start.alias("start"), (start + F.col("turn") + 1).alias("end"), (F.col("conv_id") % 4).alias("i"))
    return rows.select("conv_id", "turn", "start", "i", first.alias("first"), last.alias("last"))
