"""Queries of records, formats, splits, quality control and topics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import udf as U
from tessera.operators import formats as X
from tessera.operators import gates as G
from tessera.operators import quality as Q
from tessera.operators import records as R
from tessera.operators import topics as P
from tessera.plans.tables import PAIRS_SQL, SEGMENTS_SQL, pairs, registrar, segments, table

QUERIES, ORACLE_SQL, query = registrar()
_HASH = "('0x' || substr(sha256({x}), 1, 16))::UBIGINT"


@query(f"SELECT doc_id, CASE WHEN {_HASH.format(x=chr(39) + 'p' + chr(39) + ' || doc_id || ' + chr(39) + ':7' + chr(39))} % 100 < 20 THEN 'B' ELSE 'A' END AS mode FROM documents")
def q_variant_bucket(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", R.variant(F.concat(F.lit("p"), F.col("doc_id").cast("string")), 0.2, 7).alias("mode"))


_VERBS, _MOTIFS = (f"[{', '.join(chr(39) + v + chr(39) for v in x)}]" for x in (R.VERBS, R.MOTIFS))


@query(
    f"""WITH h AS (SELECT doc_id, source, {_HASH.format(x='doc_id::VARCHAR')} AS h FROM documents),
    s AS (SELECT doc_id, CASE WHEN h % 2 = 0 THEN source || ' ' || {_VERBS}[(h % 5)::INTEGER + 1] || ' ' || {_MOTIFS}[(h % 4)::INTEGER + 1] || ' within the cited lines.' ELSE
      source || ' ' || {_VERBS}[(h % 5)::INTEGER + 1] || ' ' || {_MOTIFS}[(h % 4)::INTEGER + 1] || ' within the cited lines.|It leaves a question about ' || {_MOTIFS}[((h + 1) % 4)::INTEGER + 1] || '.' END AS t FROM h)
    SELECT doc_id, CASE WHEN length(t) > 100 THEN split_part(t, '|', 1) ELSE t END AS connectors FROM s"""
)
def q_connector_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(R.connectors(F.col("source"), F.col("doc_id").cast("string"), 2, 100), "|").alias("connectors"))


@query(f"""WITH {PAIRS_SQL} SELECT pair_id, seq % 4 <> 0 AS holds FROM pairs""")
def q_provenance(spark, sf_dir):
    spans = F.array(F.regexp_extract("answer", r"^\S+", 0), F.regexp_replace("answer", r"^\S+\s*", ""))
    said = F.when(F.col("seq") % 4 != 0, F.replace("answer", F.lit(" "), F.lit("  "))).otherwise(F.concat("answer", F.lit(" more")))
    return pairs(spark, sf_dir).select("pair_id", G.provenance_holds(spans, said).alias("holds"))


_ORDER = "substr(sha256('7:' || {k}), 1, 16)"


@query(f"""WITH k AS (SELECT DISTINCT conv_id FROM conversations), r AS (SELECT conv_id, row_number() OVER (ORDER BY {_ORDER.format(k='conv_id')}) AS r, count(*) OVER () AS n FROM k)
    SELECT conv_id, CASE WHEN r <= least(floor(n * 0.9), n - 1) THEN 'train' ELSE 'val' END AS split FROM r""")
def q_hash_split(spark, sf_dir):
    keys = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    return Q.split(keys, "conv_id", 0.9, 7)


@query(f"""SELECT conv_id, turn, CASE WHEN ({_HASH.format(x=chr(39) + '7:' + chr(39) + ' || conv_id')} % 100) < 90 THEN 'train' ELSE 'val' END AS split FROM conversations""")
def q_bucket_split(spark, sf_dir):
    return Q.bucket_split(table(spark, sf_dir, "conversations"), "conv_id").select("conv_id", "turn", "split")


@query(f"""WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {_ORDER.format(k='doc_id')}) AS r, count(*) OVER () AS n FROM documents) SELECT doc_id FROM r WHERE r <= least(n, greatest(50, round_even(n * 0.03, 0)))""")
def q_qc_sample(spark, sf_dir):
    return Q.sample(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


@query("SELECT item_id FROM benchmark INTERSECT SELECT doc_id FROM documents")
def q_leakage(spark, sf_dir):
    return Q.leakage(table(spark, sf_dir, "benchmark").select("item_id"), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("item_id")), "item_id")


@query("SELECT coalesce(l.doc_id, r.doc_id) AS record_index, l.doc_id IS NOT NULL AND r.doc_id IS NOT NULL AS aligned FROM (SELECT item_id AS doc_id FROM benchmark) l FULL JOIN (SELECT doc_id FROM labels) r ON l.doc_id = r.doc_id")
def q_positional_align(spark, sf_dir):
    l = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("record_index"), "text")
    return Q.align(l, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("record_index"), "quality")).select("record_index", "aligned")


@query("""WITH f AS (SELECT doc_id, md5(substr(lower(trim(regexp_replace(regexp_replace('|' || text, '[^\\p{L}\\p{N}_\\s]', '', 'g'), '\\s+', ' ', 'g'))), 1, 200)) AS f FROM documents), g AS (SELECT f, min(doc_id) AS first_key, count(*) AS copies FROM f GROUP BY f HAVING count(*) > 1)
    SELECT doc_id, first_key, copies FROM f JOIN g USING (f) WHERE doc_id <> first_key""")
def q_exact_dup(spark, sf_dir):
    return Q.exact_duplicates(table(spark, sf_dir, "documents"), "doc_id", T.fingerprint(F.lit(""), F.col("text")))


@query(f"""WITH {PAIRS_SQL}, r AS (SELECT question LIKE '%?' AS q, length(answer) <= 2000 AS a, score >= 0.5 AS s FROM pairs)
    SELECT * FROM (SELECT 'question' AS "check", count_if(q) AS passed, count(*) AS total FROM r UNION ALL SELECT 'answer', count_if(a), count(*) FROM r UNION ALL SELECT 'score', count_if(s), count(*) FROM r)""")
def q_qc_rollup(spark, sf_dir):
    checks = {"question": F.endswith("question", F.lit("?")), "answer": F.length("answer") <= 2000, "score": F.col("score") >= 0.5}
    return Q.roll_up(pairs(spark, sf_dir), checks).select("check", "passed", "total")


@query("SELECT role, count(*) AS messages, round(count(*) / sum(count(*)) OVER (), 6) AS share, round(sum(length(text)) / count(*), 6) AS avg_chars FROM conversations GROUP BY role")
def q_role_stats(spark, sf_dir):
    r = Q.role_statistics(table(spark, sf_dir, "conversations"), "conv_id")
    return r.select("role", "messages", F.round("share", 6).alias("share"), F.round("avg_chars", 6).alias("avg_chars"))


@query("""WITH t AS (SELECT length(text) // 4 AS v, row_number() OVER (ORDER BY length(text) // 4) AS r, count(*) OVER () AS n, avg(length(text) // 4) OVER () AS m FROM conversations)
    SELECT n, round(max(m), 6) AS mean, max(v)::INTEGER AS value FROM t WHERE r = round_even((n - 1) * 0.95, 0) + 1 GROUP BY n""")
def q_token_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(T.count_tokens(F.col("text")).alias("tokens"))
    return Q.rank_percentile(rows, "tokens", 0.95).select("n", F.round("mean", 6).alias("mean"), "value")


@query("SELECT (length(text) // 800 * 200)::BIGINT AS bucket, count(*) AS n FROM documents GROUP BY 1")
def q_histogram(spark, sf_dir):
    return Q.histogram(table(spark, sf_dir, "documents"), F.floor(F.length("text") / 4), 200)


@query("""WITH c AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'bad Schema here' WHEN 1 THEN 'a Timeout' WHEN 2 THEN 'odd' ELSE NULL END AS e, CASE doc_id % 5 WHEN 3 THEN '{' || source ELSE '' END AS r FROM documents),
    k AS (SELECT doc_id, CASE WHEN e LIKE '%Schema%' THEN 'invalid_schema' WHEN e LIKE '%Timeout%' THEN 'api_errors' WHEN e IS NOT NULL THEN 'other_errors' WHEN r = '' THEN 'empty_responses' ELSE 'json_parsing_errors' END AS kind, coalesce(e, r) AS x FROM c),
    f AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY doc_id) AS i FROM k)
    SELECT kind, count(*) AS n, string_agg(x, '|' ORDER BY doc_id) FILTER (WHERE i <= 3) AS examples FROM f GROUP BY kind""")
def q_failure_summary(spark, sf_dir):
    d = F.col("doc_id") % 5
    e = F.when(d == 0, "bad Schema here").when(d == 1, "a Timeout").when(d == 2, "odd")
    rows = table(spark, sf_dir, "documents").select("doc_id", e.alias("e"), F.when(d == 3, F.concat(F.lit("{"), "source")).otherwise("").alias("r"))
    return Q.failure_summary(rows, "r", "e", "doc_id").select("kind", "n", F.array_join("examples", "|").alias("examples"))


def _samples(spark, sf_dir):
    """Conversations as JSON samples, of several shapes by conv_id: messages, question and answer, instruction and output."""
    c = table(spark, sf_dir, "conversations")
    ms = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    g = c.groupBy("conv_id").agg(ms.alias("messages"), F.min_by("text", "turn").alias("a"), F.max_by("text", "turn").alias("b"))
    k = F.col("conv_id") % 3
    sample = F.when(k == 0, F.to_json(F.struct("messages"))).when(k == 1, F.to_json(F.struct(F.col("a").alias("question"), F.col("b").alias("answer"), F.lit("why").alias("chain_of_thought")))).otherwise(F.to_json(F.struct(F.col("a").alias("instruction"), F.col("b").alias("output"), F.lit("ctx").alias("input"))))
    return g.select("conv_id", sample.alias("sample"))


_SAMPLES = """m AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS ms, arg_min(text, turn) AS a, arg_max(text, turn) AS b, conv_id % 3 AS k FROM conversations GROUP BY conv_id)"""
_OF = lambda role: f"list_transform(list_filter(ms, lambda x: x.role = '{role}'), lambda x: x.content)"


@query(
    f"""WITH {_SAMPLES}, u AS (SELECT *, {_OF('system')}[1] AS sys, {_OF('user')} AS us, {_OF('assistant')} AS said FROM m)
    SELECT conv_id, CASE k WHEN 0 THEN coalesce(nullif(sys, ''), us[1], '') ELSE a END AS instruction,
      CASE k WHEN 0 THEN nullif(array_to_string(CASE WHEN coalesce(sys, '') <> '' THEN us ELSE us[2:] END, ' '), '') WHEN 2 THEN 'ctx' END AS input,
      CASE k WHEN 0 THEN array_to_string(said, ' ') WHEN 1 THEN 'why' || chr(10) || chr(10) || b ELSE b END AS output FROM u"""
)
def q_fmt_alpaca(spark, sf_dir):
    return _samples(spark, sf_dir).select("conv_id", X.alpaca(F.col("sample")).alias("x")).select("conv_id", "x.*")


_TALK = """t AS (SELECT conv_id, CASE k WHEN 0 THEN ms WHEN 1 THEN [{'role': 'user', 'content': a}, {'role': 'assistant', 'content': %s}] ELSE [{'role': 'user', 'content': %s}, {'role': 'assistant', 'content': b}] END AS ms FROM m)"""


@query(
    f"""WITH {_SAMPLES}, c AS (SELECT conv_id, k, CASE k WHEN 0 THEN list_filter(ms, lambda x: trim(x.content) <> '') WHEN 1 THEN [{{'role': 'user', 'content': a}}, {{'role': 'assistant', 'content': 'why' || chr(10) || chr(10) || b}}] ELSE [{{'role': 'user', 'content': a}}, {{'role': 'assistant', 'content': b}}] END AS ms FROM m)
    SELECT conv_id, array_to_string(list_transform(ms, lambda x: '<|im_start|>' || x.role || chr(10) || x.content || chr(10) || '<|im_end|>'), chr(10)) AS text FROM c"""
)
def q_fmt_chatml(spark, sf_dir):
    return _samples(spark, sf_dir).select("conv_id", X.chatml(F.col("sample")).alias("x")).select("conv_id", "x.text")


_PLAIN = _TALK % ("b", "a || chr(10) || chr(10) || 'Input: ctx'")


@query(f"WITH {_SAMPLES}, {_PLAIN} SELECT conv_id, array_to_string(list_transform(list_filter(ms, lambda x: x.role <> 'system'), lambda x: '<|im_start|>' || x.role || chr(10) || x.content || '<|im_end|>'), chr(10)) AS text FROM t")
def q_fmt_im(spark, sf_dir):
    return _samples(spark, sf_dir).select("conv_id", X.im_format(F.col("sample")).alias("x")).select("conv_id", "x.text")


@query(f"WITH {_SAMPLES}, {_PLAIN} SELECT conv_id, array_to_string(list_transform(list_filter(ms, lambda x: x.role <> 'system'), lambda x: x.role || '=' || x.content), '|') AS talk FROM t")
def q_fmt_unsloth(spark, sf_dir):
    x = X.unsloth(F.col("sample"))["conversations"]
    return _samples(spark, sf_dir).select("conv_id", F.array_join(F.transform(x, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|").alias("talk"))


@query(
    f"""WITH {_SAMPLES}, s AS (SELECT conv_id, CASE k WHEN 0 THEN list_transform(list_filter(ms, lambda x: x.role <> 'system' AND trim(x.content) <> ''), lambda x: '<|start|>' || x.role || CASE WHEN x.role = 'assistant' THEN '<|channel|>final' ELSE '' END || '<|message|>' || chr(10) || x.content || chr(10) || '<|end|>')
      WHEN 1 THEN ['<|start|>user<|message|>' || chr(10) || a || chr(10) || '<|end|>', '<|start|>assistant<|channel|>analysis<|message|>' || chr(10) || 'why' || chr(10) || '<|end|>', '<|start|>assistant<|channel|>final<|message|>' || chr(10) || b || chr(10) || '<|end|>']
      ELSE ['<|start|>user<|message|>' || chr(10) || a || chr(10) || '<|end|>', '<|start|>assistant<|channel|>final<|message|>' || chr(10) || b || chr(10) || '<|end|>'] END AS l FROM m)
    SELECT conv_id, array_to_string(list_concat(['<|start|>system<|message|>' || chr(10) || 'You are ChatGPT, a large language model trained by OpenAI.' || chr(10) || 'Knowledge cutoff: 2024-06' || chr(10) || 'Reasoning: medium' || chr(10) || '# Valid channels: analysis, commentary, final' || chr(10) || '<|end|>'], l), chr(10)) AS text FROM s"""
)
def q_fmt_harmony(spark, sf_dir):
    return _samples(spark, sf_dir).select("conv_id", X.harmony(F.col("sample")).alias("x")).select("conv_id", "x.text")


@query(f"""WITH {_SAMPLES}, q AS (SELECT conv_id, CASE k WHEN 0 THEN coalesce({_OF('user')}[1], '') WHEN 1 THEN a ELSE a || chr(10) || chr(10) || 'Input: ctx' END AS q, CASE k WHEN 0 THEN coalesce({_OF('assistant')}[1], '') WHEN 1 THEN '<think>' || chr(10) || 'why' || chr(10) || '</think>' || chr(10) || chr(10) || b ELSE b END AS r FROM m)
    SELECT conv_id, array_to_string(list_filter([CASE WHEN q <> '' THEN 'user=' || q END, CASE WHEN r <> '' THEN 'assistant=' || r END], lambda x: x IS NOT NULL), '|') AS talk FROM q""")
def q_fmt_unsloth_grpo(spark, sf_dir):
    x = X.unsloth_grpo(F.col("sample"))["conversations"]
    return _samples(spark, sf_dir).select("conv_id", F.array_join(F.transform(x, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|").alias("talk"))


def _tool_samples(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    tool = F.array(F.struct(F.lit("calculator").alias("name"), F.lit("adds").alias("description"), F.array(F.struct(F.lit("expression").alias("name"), F.lit("str").alias("type"), F.lit("sum").alias("description"))).alias("parameters")))
    turns = F.array(*[F.struct(F.lit(a).alias("from"), b.alias("value")) for a, b in (("human", F.col("source")), ("function_call", F.concat(F.lit('{"name": "calculator", "arguments": {"expression": "'), F.col("doc_id").cast("string"), F.lit('"}}'))), ("observation", F.col("doc_id").cast("string")), ("gpt", F.col("lang")))])
    s = F.struct(F.col("source").alias("question"), F.lit("calculator").alias("tool_used"), F.concat(F.lit("{'expression': '"), F.col("doc_id").cast("string"), F.lit("'}")).alias("tool_input"), F.col("doc_id").cast("string").alias("tool_output"), F.col("lang").alias("answer"), tool.alias("available_tools"), turns.alias("turns"))
    return d.select("doc_id", F.to_json(s).alias("sample"))


@query("SELECT doc_id, '<think>I need to use a tool to help answer this question.</think><tool_call>' || chr(10) || '{\"name\": \"calculator\", \"arguments\": {\"expression\": \"' || doc_id || '\"}}' || chr(10) || '</tool_call>' AS call, '<tool_response>' || chr(10) || doc_id || chr(10) || '</tool_response>' AS result FROM documents")
def q_fmt_tools(spark, sf_dir):
    x = X.tool_calling(F.col("sample"))["messages"]
    return _tool_samples(spark, sf_dir).select("doc_id", F.get(x, 2)["content"].alias("call"), F.get(x, 3)["content"].alias("result"))


@query("""SELECT doc_id, 4 AS n, '[{"name": "calculator", "description": "adds", "parameters": {"type": "object", "properties": {"expression": {"type": "string", "description": "sum"}}, "required": ["expression"]}}]' AS tools FROM documents""")
def q_fmt_xlam(spark, sf_dir):
    return _tool_samples(spark, sf_dir).select("doc_id", X.xlam_v2(F.col("sample")).alias("x")).select("doc_id", F.size("x.conversations").alias("n"), "x.tools")


@query("SELECT f.format, count(*) AS total, count_if(CASE f.format WHEN 'unsloth_grpo' THEN true WHEN 'single_tool_call' THEN false ELSE true END) AS formatted FROM (SELECT DISTINCT conv_id FROM conversations), (VALUES ('alpaca'), ('chatml'), ('grpo'), ('unsloth_grpo'), ('single_tool_call')) f(format) GROUP BY f.format")
def q_format_statistics(spark, sf_dir):
    names = ["alpaca", "chatml", "grpo", "unsloth_grpo", "single_tool_call"]
    return X.statistics(X.apply(_samples(spark, sf_dir), names), names).select("format", "total", "formatted")


@query("""WITH m AS (SELECT conv_id, list(role ORDER BY turn) AS roles, count_if(text IS NULL) AS bad FROM conversations GROUP BY conv_id) SELECT conv_id, roles[-1] = 'assistant' AND bad = 0 AND conv_id % 3 = 0 AS valid FROM m""")
def q_validate_messages(spark, sf_dir):
    return _samples(spark, sf_dir).select("conv_id", (F.size(G.training_record(F.col("sample"))) == 0).alias("valid"))


@query(f"""WITH {PAIRS_SQL} SELECT pair_id, score < 0.5 AND seq % 2 = 1 AS fails_fit FROM pairs""")
def q_validate_sidecar(spark, sf_dir):
    gates = F.struct(F.lit(False).alias("questionify_used"), F.lit(False).alias("answer_trimmed"), F.lit(True).alias("speaker_check_passed"), (F.col("seq") % 2 == 1).alias("pairfit_passed"))
    side = F.struct("pair_id", F.col("episode_id").cast("string").alias("episode_id"), F.col("pair_id").alias("window_id"), F.lit(0).alias("sample_index"), F.col("speaker").alias("answer_speaker"), "question", "answer", F.array().alias("sources"), F.array().alias("target_spans"), F.col("score").alias("fit_score_ce"), gates.alias("gates"))
    return pairs(spark, sf_dir).select("pair_id", F.array_contains(G.sidecar_record(F.to_json(side)), "fit").alias("fails_fit"))


@query(f"""WITH {PAIRS_SQL} SELECT pair_id, CASE WHEN seq % 4 = 0 THEN 'provenance' END AS drop_reason, CASE WHEN seq % 4 <> 0 THEN score >= 0.5 END AS pairfit_passed FROM pairs""")
def q_build_records(spark, sf_dir):
    rows = pairs(spark, sf_dir).withColumn("spans", F.array(F.when(F.col("seq") % 4 == 0, F.concat("answer", F.lit(" more"))).otherwise(F.col("answer"))))
    rows = rows.select("pair_id", F.col("episode_id").cast("string").alias("episode_id"), F.col("pair_id").alias("window_id"), F.lit(0).alias("sample_index"), "question", "answer", "speaker", "spans", F.array(F.struct("speaker", "start", "end")).alias("sources"), F.col("score").alias("fit_score"), F.lit(False).alias("questionify_used"), F.lit(False).alias("answer_trimmed"))
    return R.build_pairs(rows).select("pair_id", "drop_reason", "sidecar.gates.pairfit_passed")


@query("""SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Symbolic reasoning:' || chr(10) || source || chr(10) || chr(10) || 'Archetypal patterns: a, b' WHEN 1 THEN source ELSE '' END AS analysis, CASE doc_id % 2 WHEN 0 THEN lang ELSE 'plain' END AS final FROM documents""")
def q_flatten_channels(spark, sf_dir):
    d = F.col("doc_id")
    a = F.when(d % 3 == 0, F.to_json(F.struct(F.col("source").alias("symbolic_meaning"), F.array(F.lit("a"), F.lit("b")).alias("archetypal_patterns")))).when(d % 3 == 1, F.col("source")).otherwise("{}")
    f = F.when(d % 2 == 0, F.to_json(F.struct(F.lit(" ").alias("summary"), F.col("lang").alias("final")))).otherwise(" plain ")
    return table(spark, sf_dir, "documents").select("doc_id", R.flat_analysis(a).alias("analysis"), R.flat_final(f).alias("final"))


@query("SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN source ELSE 'kept' END AS symbolic_meaning, lang AS summary FROM documents")
def q_move_leaked(spark, sf_dir):
    base = F.when(F.col("doc_id") % 2 == 1, F.create_map(F.lit("symbolic_meaning"), F.lit("kept")))
    x = R.move_leaked(base, F.concat(F.col("lang"), F.lit("\n Symbolic reasoning: "), F.col("source")))
    return table(spark, sf_dir, "documents").select("doc_id", x.alias("x")).select("doc_id", F.col("x.analysis")["symbolic_meaning"].alias("symbolic_meaning"), "x.summary")


@query(
    f"""WITH {SEGMENTS_SQL}, w AS (SELECT *, (row_number() OVER (PARTITION BY episode_id ORDER BY seq) - 1) // 4 AS window_index FROM seg),
    s AS (SELECT episode_id, count(DISTINCT speaker) AS n FROM seg GROUP BY episode_id)
    SELECT DISTINCT w.episode_id, w.window_index::INTEGER AS window_index, (max(w.window_index) OVER (PARTITION BY w.episode_id) + 1) AS windows_total, CASE WHEN n = 2 THEN 'two_speaker' ELSE 'flattened' END AS strategy FROM w JOIN s ON w.episode_id = s.episode_id"""
)
def q_adapter_records(spark, sf_dir):
    return R.conversation_records(segments(spark, sf_dir), 4).select("episode_id", "window_index", "windows_total", "strategy")


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN '1.5e10' WHEN 1 THEN (doc_id * 1000)::VARCHAR ELSE (doc_id + 0.13)::DECIMAL(18,2)::VARCHAR END AS answer FROM documents")
def q_math_answer(spark, sf_dir):
    d = F.col("doc_id")
    x = F.when(d % 3 == 0, "1.5e10, 2").when(d % 3 == 1, F.when(d == 0, "0").otherwise(F.concat(d.cast("string"), F.lit(",000")))).otherwise(F.concat(d.cast("string"), F.lit(".125")))
    return table(spark, sf_dir, "documents").select("doc_id", R.math_answer(x).alias("answer"))


def _graph(spark, sf_dir):
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    s = table(spark, sf_dir, "supplier")
    edges = n.select(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent_id"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("child_id"))
    edges = edges.union(s.select(F.concat(F.lit("n"), F.col("s_nationkey").cast("string")), F.concat(F.lit("s"), F.col("s_suppkey").cast("string"))))
    return r.select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("id")), edges


@query("""SELECT 'r' || n_regionkey || '>n' || n_nationkey || coalesce('>s' || s_suppkey, '') AS path FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey""")
def q_graph_paths(spark, sf_dir):
    roots, edges = _graph(spark, sf_dir)
    return P.root_paths(edges, roots).select(F.array_join("path", ">").alias("path"))


@query("""SELECT DISTINCT unnest(['r' || n_regionkey, 'n' || n_nationkey]) AS id FROM nation WHERE n_nationkey % 5 = 0""")
def q_graph_cycle(spark, sf_dir):
    _, edges = _graph(spark, sf_dir)
    back = table(spark, sf_dir, "nation").filter("n_nationkey % 5 = 0").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("parent_id"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("child_id"))
    return P.cyclic_nodes(P.add_edges(edges, back))


@query("""SELECT r_name || '>' || coalesce(n_name, 'subtopic_' || i || '_for_' || r_name) AS path FROM region, range(1, 8) t(i) LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS k FROM nation) n ON n.n_regionkey = region.r_regionkey AND n.k = i""")
def q_tree_level(spark, sf_dir):
    from pyspark.sql import Window

    r = table(spark, sf_dir, "region")
    kids = table(spark, sf_dir, "nation").join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("parent"), F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey")).alias("rank"), F.col("n_name").alias("child"))
    return P.expand(r.select(F.array("r_name").alias("path")), kids, 7).select(F.array_join("path", ">").alias("path"))


@query("""SELECT n_name AS name, CASE WHEN n_nationkey % 3 = 0 THEN 'later' ELSE 'first' END AS description FROM nation""")
def q_tool_override_union(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    a = n.select(F.col("n_name").alias("name"), F.lit("first").alias("description"), F.col("n_nationkey").alias("i"))
    return P.merge_tools([a, n.filter("n_nationkey % 3 = 0").select(F.col("n_name").alias("name"), F.lit("later").alias("description"), F.col("n_nationkey").alias("i"))], "i")


@query("SELECT doc_id, ['a', source] AS items FROM documents")
def q_list_in_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", U.list_in(F.concat(F.lit("so: ['a', '"), "source", F.lit("'] end"))).alias("items"))


@query("SELECT conv_id, len(list_filter(list(role), lambda r: r = 'user')) AS n FROM conversations GROUP BY conv_id HAVING count_if(role = 'user') > 0 AND conv_id % 3 = 0")
def q_filter_by_role(spark, sf_dir):
    return _samples(spark, sf_dir).select("conv_id", F.size(R.only_role(X.messages(F.col("sample")), "user")).cast("long").alias("n")).filter("n > 0")


@query(
    """WITH r AS (SELECT doc_id::VARCHAR AS k, doc_id AS d, md5(doc_id::VARCHAR) AS t FROM documents UNION ALL SELECT 'c' || doc_id, doc_id, substr(md5(doc_id::VARCHAR), 1, 31) || 'z' FROM documents WHERE doc_id % 5 = 0),
    s AS (SELECT k, d, t FROM (SELECT *, row_number() OVER (ORDER BY substr(sha256('7:' || k), 1, 16)) AS i, count(*) OVER () AS n FROM r) WHERE i <= least(n, greatest(50, round_even(n * 0.1, 0))))
    SELECT s.k AS key_a, r.k AS key_b, 0.96875::DOUBLE AS ratio FROM s JOIN r ON s.d = r.d AND s.k <> r.k"""
)
def q_near_dup_answers(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("k"), F.md5(F.col("doc_id").cast("string")).alias("answer"), "doc_id")
    rows = d.select("k", "answer").union(d.filter("doc_id % 5 = 0").select(F.concat(F.lit("c"), "k"), F.concat(F.substring("answer", 1, 31), F.lit("z"))))
    return Q.near_duplicates(rows, "k", "answer", Q.sample(rows, "k", 0.1), block=400)


_MARK, _NUMBER = "(?is)^(.*?)(?:answer|solution):\\s*(.*)$", "(?s)^(.*?)([+-]?[0-9.,]+)\\s*$"
_PART = lambda i: f"CASE WHEN regexp_matches(c, '{_MARK}') THEN trim(regexp_extract(c, '{_MARK}', {i}), ' ' || chr(10) || chr(13) || chr(9)) WHEN regexp_matches(c, '{_NUMBER}') THEN trim(regexp_extract(c, '{_NUMBER}', {i}), ' ' || chr(10) || chr(13) || chr(9)) WHEN contains(c, '.') THEN trim({('substr(c, 1, length(c) - length(string_split(c, chr(46))[-1]) - 1)', 'string_split(c, chr(46))[-1]')[i - 1]}, ' ' || chr(10) || chr(13) || chr(9)) ELSE trim(c, ' ' || chr(10) || chr(13) || chr(9)) END"
_TAGGED = lambda a, b: f"'{X.THINK}' || {a} || '{X.UNTHINK}{X.SOLVE}' || {b} || '{X.UNSOLVE}'"


@query(
    f"""WITH c AS (SELECT conv_id, turn, role, text AS c, text FROM conversations), w AS (SELECT conv_id, turn, role, text, {_PART(1)} AS a, {_PART(2)} AS b FROM c),
    t AS (SELECT conv_id, count_if(role = 'system') AS led, string_agg(role || '=' || CASE WHEN role = 'assistant' AND a <> '' AND b <> '' THEN {_TAGGED('a', 'b')} ELSE text END, '|' ORDER BY turn) AS m, arg_min(text, turn) AS q, arg_max(text, turn) AS r FROM w GROUP BY conv_id)
    SELECT conv_id, CASE WHEN conv_id % 3 = 0 AND led > 0 THEN '' ELSE 'system={X.GRPO_PROMPT}|' END || CASE conv_id % 3 WHEN 0 THEN m WHEN 1 THEN 'user=' || q || '|assistant=' || {_TAGGED("'why'", 'r')} ELSE 'user=ctx|assistant=' || {_TAGGED(f"'{X.STEP_BY_STEP}'", 'r')} END AS talk FROM t"""
)
def q_fmt_grpo(spark, sf_dir):
    x = X.grpo(F.col("sample"))["messages"]
    return _samples(spark, sf_dir).select("conv_id", F.array_join(F.transform(x, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|").alias("talk"))


@query("""SELECT doc_id, 5 AS n, 'I''ll calculate ' || doc_id || ' for you.' || chr(10) || chr(10) || '<tool_call>' || chr(10) || '{"name": "calculator", "arguments": {"expression": "' || doc_id || '"}}' || chr(10) || '</tool_call>' AS call, doc_id::VARCHAR AS result FROM documents""")
def q_fmt_single_tool(spark, sf_dir):
    x = X.single_tool_call(F.col("sample"))["messages"]
    return _tool_samples(spark, sf_dir).select("doc_id", F.size(x).alias("n"), F.get(x, 2)["content"].alias("call"), F.get(x, 3)["content"].alias("result"))


@query("SELECT doc_id, doc_id % 4 <> 0 AS one, doc_id % 4 <> 0 AS many, doc_id % 5 <> 0 AS xlam FROM documents")
def q_fmt_bad_samples(spark, sf_dir):
    """Samples of which every fourth is no tool sample and every fifth has tools that are no list; none fails the query."""
    d = F.col("doc_id")
    rows = _tool_samples(spark, sf_dir).withColumn("sample", F.when(d % 5 == 0, F.regexp_replace("sample", '"available_tools":\\[', '"available_tools":"oops","x":[')).otherwise(F.col("sample")))
    s = F.when(d % 4 == 0, F.regexp_replace("sample", '"question"', '"other"')).otherwise(F.col("sample"))
    return rows.select("doc_id", X.single_tool_call(s).isNotNull().alias("one"), X.tool_calling(s).isNotNull().alias("many"), X.xlam_v2(F.col("sample")).isNotNull().alias("xlam"))
