"""Queries of audits, model stages, samples, conversion and graph growth."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import udf as U
from tessera.operators import audit as A
from tessera.operators import convert as C
from tessera.operators import formats as X
from tessera.operators import gates as G
from tessera.operators import models as M
from tessera.operators import prompts
from tessera.operators import quality as Q
from tessera.operators import records as R
from tessera.operators import replies as E
from tessera.operators import samples as Z
from tessera.operators import segments as S
from tessera.operators import topics as P
from tessera.plans.tables import PAIRS_SQL, SEGMENTS_SQL, pairs, registrar, segments, table

QUERIES, ORACLE_SQL, query = registrar()
_NORM = lambda x: f"lower(trim(regexp_replace(regexp_replace({x}, '[^\\p{{L}}\\p{{N}}_\\s]', '', 'g'), '\\s+', ' ', 'g')))"
_ORDER = "substr(sha256('7:' || {k}), 1, 16)"


# ------------------------------------------------------------------ audits


def _sides(spark, sf_dir):
    """Documents as sidecar rows: answers that repeat by language or stand alone, spans, speakers, gates and scores by the id."""
    d = F.col("doc_id")
    answer = F.when(d % 10 == 3, F.md5("lang")).when(d % 10 == 7, F.concat(F.substring(F.md5(((d - d % 10)).cast("string")), 1, 31), F.lit("z"))).when(d % 10 == 0, F.md5(d.cast("string"))).otherwise(F.md5(F.concat(F.lit("x"), d.cast("string"))))
    answer = F.when(d % 10 == 9, F.concat(answer, F.repeat(F.md5(F.concat(F.lit("y"), d.cast("string"))), F.lit(70)))).otherwise(answer)
    question = F.concat("source", F.when(d % 6 == 0, ".").otherwise("?"))
    score = F.when(d % 8 != 5, ((d * 37) % 120) / 100.0)
    gates = F.struct((d % 3 != 0).alias("pairfit_passed"), (d % 30 != 0).alias("speaker_check_passed"))
    return table(spark, sf_dir, "documents").select(
        d.alias("record_index"), d.cast("string").alias("pair_id"), F.col("lang").alias("episode_id"), question.alias("question"), answer.alias("answer"), F.when(d % 9 == 4, "Somebody").otherwise("Ann Lee").alias("answer_speaker"),
        F.when(d % 4 == 2, "else").otherwise(F.concat(F.lit("so: "), answer, F.lit(", yes"))).alias("source_spans_text"), score.alias("fit_score_ce"), gates.alias("gates"),
    )


_SIDES = """side AS (SELECT doc_id AS i, doc_id::VARCHAR AS pair_id, source || CASE WHEN doc_id % 6 = 0 THEN '.' ELSE '?' END AS question,
    CASE doc_id % 10 WHEN 3 THEN md5(lang) WHEN 7 THEN substr(md5((doc_id - doc_id % 10)::VARCHAR), 1, 31) || 'z' WHEN 0 THEN md5(doc_id::VARCHAR) ELSE md5('x' || doc_id) END || CASE WHEN doc_id % 10 = 9 THEN repeat(md5('y' || doc_id), 70) ELSE '' END AS answer,
    CASE WHEN doc_id % 9 = 4 THEN 'Somebody' ELSE 'Ann Lee' END AS speaker, doc_id % 4 <> 2 AS has_span, CASE WHEN doc_id % 8 <> 5 THEN ((doc_id * 37) % 120) / 100.0::DOUBLE END AS score, doc_id % 3 <> 0 AS fit, doc_id % 30 <> 0 AS checked FROM documents)"""
_AUDITED = f"""WITH {_SIDES},
    picked AS (SELECT i FROM (SELECT i, row_number() OVER (ORDER BY {_ORDER.format(k='i')}) AS r, count(*) OVER () AS n FROM side) WHERE r <= least(n, greatest(50, round_even(n * 0.2, 0)))),
    twins AS (SELECT a.i, min(b.i) AS j FROM side a JOIN side b ON a.i <> b.i AND (a.answer = b.answer OR (a.i % 10 IN (0, 7) AND b.i % 10 IN (0, 7) AND a.i // 10 = b.i // 10)) WHERE a.i % 10 <> 9 AND b.i % 10 <> 9 GROUP BY a.i),
    r AS (SELECT s.i, CASE WHEN NOT s.has_span THEN 'groundedness: Answer not found in source spans' END AS a,
      CASE WHEN s.question NOT LIKE '%?' THEN 'format: Question does not end with ''?''' WHEN length(s.answer) > 2000 THEN 'format: Answer too long: ' || length(s.answer) || ' characters' END AS b, CASE WHEN s.speaker <> 'Ann Lee' THEN 'speaker: Invalid speaker: somebody' END AS c,
      CASE WHEN s.score IS NOT NULL AND NOT (s.score <= 1.0 AND s.fit = (s.score >= 0.5)) THEN 'fit_score: Fit score does not agree with the gate' END AS d,
      CASE WHEN j IS NOT NULL THEN 'duplication: ' || CASE WHEN {_NORM("s.question || '|' || s.answer")} = {_NORM("o.question || '|' || o.answer")} THEN 'Exact' ELSE 'Near-' END || CASE WHEN {_NORM("s.question || '|' || s.answer")} = {_NORM("o.question || '|' || o.answer")} THEN ' duplicate' ELSE 'duplicate' END || ' found at index ' || j END AS e
      FROM side s JOIN picked USING (i) LEFT JOIN twins t ON t.i = s.i LEFT JOIN side o ON o.i = t.j)"""


def _audited(spark, sf_dir):
    rows = _sides(spark, sf_dir)
    return A.audit_rows(rows, Q.sample(rows, "record_index", 0.2), ["ann lee"])


@query(f"{_AUDITED} SELECT i AS record_index, concat_ws('; ', a, b, c, d, e) AS reasons, concat_ws('', a, b, c, d, e) = '' AS passed FROM r")
def q_qc_audit(spark, sf_dir):
    return _audited(spark, sf_dir).select("record_index", F.array_join("reasons", "; ").alias("reasons"), "passed")


@query(f"""{_AUDITED}, n AS (SELECT count(*) AS t, count_if(a IS NULL) AS a, count_if(b IS NULL) AS b, count_if(c IS NULL) AS c, count_if(d IS NULL) AS d, count_if(e IS NULL) AS e, count_if(coalesce(a, b, c, d, e) IS NULL) AS o FROM r)
    SELECT * FROM (SELECT 'groundedness' AS "check", a AS passed, t AS total FROM n UNION ALL SELECT 'format', b, t FROM n UNION ALL SELECT 'speaker', c, t FROM n UNION ALL SELECT 'fit_score', d, t FROM n UNION ALL SELECT 'duplication', e, t FROM n UNION ALL SELECT 'overall', o, t FROM n)""")
def q_qc_rates(spark, sf_dir):
    return A.audit_rates(_audited(spark, sf_dir)).select("check", "passed", "total")


@query(f"{_AUDITED} SELECT i AS record_index, pair_id, concat_ws('; ', a, b, c, d, e) AS failure_reasons FROM r JOIN side USING (i) WHERE coalesce(a, b, c, d, e) IS NOT NULL")
def q_qc_files(spark, sf_dir):
    from tessera.plans.source_queries import _folder

    path = _folder(spark, "audit")
    A.save_audit(_audited(spark, sf_dir), path)
    read = spark.read.option("header", True).option("escape", '"').csv(f"{path}/failures")
    return read.select(F.col("record_index").cast("long").alias("record_index"), "pair_id", "failure_reasons")


@query(f"WITH {_SIDES} SELECT count(*) AS total, count(score) AS scored, min(score) AS least, max(score) AS greatest, round(avg(score), 9) AS average FROM side")
def q_gating_metrics(spark, sf_dir):
    return A.gating_metrics(_sides(spark, sf_dir)).withColumn("average", F.round("average", 9))


@query(
    f"""WITH {_SIDES}, v AS (SELECT *, i % 5 = 0 AS val FROM side), k AS (SELECT count(*) AS n FROM (SELECT pair_id FROM v WHERE NOT val INTERSECT SELECT pair_id FROM v WHERE val OR i % 100 = 1)),
    c AS (SELECT avg(checked::INT) FILTER (NOT val) >= 0.95 AND avg(checked::INT) FILTER (val OR i % 100 = 1) >= 0.95 AS a, avg((score IS NOT NULL)::INT) FILTER (NOT val) >= 0.95 AND avg((score IS NOT NULL)::INT) FILTER (val OR i % 100 = 1) >= 0.95 AS b, count_if(speaker <> 'Ann Lee') = 0 AS s, max(n) = 0 AS l FROM v, k)
    SELECT * FROM (SELECT 'speaker_rate' AS "check", a AS passed FROM c UNION ALL SELECT 'score_rate', b FROM c UNION ALL SELECT 'speakers', s FROM c UNION ALL SELECT 'no_leakage', l FROM c UNION ALL SELECT 'go', a AND b AND s AND l FROM c)"""
)
def q_go(spark, sf_dir):
    rows = _sides(spark, sf_dir)
    i = F.col("record_index")
    return A.go(rows.filter(i % 5 != 0), rows.filter((i % 5 == 0) | (i % 100 == 1)), ["Ann Lee"])


@query(f"WITH {_SIDES}, b AS (SELECT i FROM side WHERE speaker <> 'Ann Lee' ORDER BY i LIMIT 10) SELECT speaker AS item, count(*) AS n FROM side GROUP BY speaker UNION ALL SELECT 'f:' || i || ': Somebody', 0 FROM b")
def q_speaker_audit(spark, sf_dir):
    rows = _sides(spark, sf_dir).withColumn("source_path", F.lit("f")).withColumnRenamed("record_index", "line")
    counts, bad = A.speaker_audit(rows, ["Ann Lee"])
    return counts.select(F.col("speaker").alias("item"), "n").union(bad.select("invalid", F.lit(0).cast("long")))


@query(f"WITH {_SIDES}, o AS (SELECT pair_id FROM side WHERE i % 3 = 0 AND i % 4 = 0) SELECT (SELECT count(*) FROM side WHERE i % 3 = 0) AS train_count, (SELECT count(*) FROM side WHERE i % 4 = 0) AS val_count, (SELECT count(*) FROM o) AS overlap_count, (SELECT string_agg(pair_id, ',' ORDER BY pair_id) FROM (SELECT * FROM o ORDER BY pair_id LIMIT 10)) AS overlap")
def q_leakage_report(spark, sf_dir):
    rows = _sides(spark, sf_dir)
    out = A.leakage_report(rows.filter("record_index % 3 = 0"), rows.filter("record_index % 4 = 0"))
    return out.withColumn("overlap", F.array_join("overlap", ","))


@query("""WITH n AS (SELECT max(doc_id) + 1 AS n FROM labels), u AS (SELECT doc_id AS i, doc_id, true AS t FROM labels UNION ALL SELECT item_id + n, item_id, false FROM benchmark, n)
    SELECT i AS record_index, doc_id AS id, t AS is_train FROM u WHERE i IN (SELECT doc_id * 3 FROM documents)""")
def q_lookup_by_offset(spark, sf_dir):
    train = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("record_index"), F.col("doc_id").alias("id"))
    val = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("record_index"), F.col("item_id").alias("id"))
    return A.lookup(A.union_by_offset(train, val), table(spark, sf_dir, "documents").select((F.col("doc_id") * 3).alias("record_index"))).select("record_index", "id", "is_train")


@query(f"""WITH {_SIDES}, b AS (SELECT count_if(i % 50 = 7) AS j, count_if(i % 50 = 7 OR i % 40 = 9 OR i % 70 = 11) AS a, count_if(i % 50 = 7) AS st, count_if(speaker <> 'Ann Lee' AND i % 70 <> 11) AS sp FROM side)
    SELECT * FROM (SELECT 'not_empty' AS "check", 0::BIGINT AS bad FROM b UNION ALL SELECT 'json', j FROM b UNION ALL SELECT 'structure', st FROM b UNION ALL SELECT 'aligned', a FROM b UNION ALL SELECT 'speakers', sp FROM b)""")
def q_file_checks(spark, sf_dir):
    i = F.col("record_index")
    rows = _sides(spark, sf_dir)
    asked = F.when(i % 40 == 9, F.lit("other?")).otherwise(F.col("question"))
    t = F.to_json(F.struct(F.array(X.message("user", asked), X.message("assistant", F.col("answer"))).alias("messages")))
    t = rows.select("record_index", F.when(i % 50 == 7, "{oops").otherwise(t).alias("value"), (i % 50 != 7).alias("valid"))
    s = rows.filter(i % 70 != 11).select("record_index", F.to_json(F.struct("pair_id", "question", "answer", "answer_speaker")).alias("value"), F.lit(True).alias("valid"))
    return A.file_checks(t, s, ["ann lee"]).select("check", "bad")


_TALKS = "t AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS ms FROM conversations GROUP BY conv_id)"


def _talks(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    ms = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return c.groupBy("conv_id").agg(ms.alias("messages"))


_FIT = "len(ms) >= 2 AND len(list_filter(ms, lambda m: m.role = 'user')) > 0 AND len(list_filter(ms, lambda m: m.role = 'assistant')) > 0 AND len(list_filter(ms, lambda m: length(m.content) < 60)) = 0"


@query(f"WITH {_TALKS} SELECT count(*) AS total, count_if({_FIT}) AS kept, count_if({_FIT}) / count(*) >= 0.5 AS enough FROM t")
def q_example_quality(spark, sf_dir):
    fit = A.example_quality(_talks(spark, sf_dir), least_chars=60)
    row = _talks(spark, sf_dir).agg(F.count("*").alias("total"), F.count_if(fit).alias("kept"))
    return row.withColumn("enough", F.col("kept") / F.col("total") >= 0.5)


@query("SELECT count(DISTINCT conv_id) AS samples, sum(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')))::BIGINT AS tokens FROM conversations")
def q_example_statistics(spark, sf_dir):
    return A.example_statistics(_talks(spark, sf_dir)).select("samples", "tokens")


@query("SELECT count(DISTINCT conv_id) AS samples, count(*) AS messages, round(count(*) / count(DISTINCT conv_id), 9) AS avg_messages, round(sum(length(text)) / count(*), 9) AS avg_chars FROM conversations")
def q_set_statistics(spark, sf_dir):
    out = Q.set_statistics(table(spark, sf_dir, "conversations"), "conv_id")
    return out.withColumns({c: F.round(c, 9) for c in ("avg_messages", "avg_chars")})


@query(f"""WITH {PAIRS_SQL}, r AS (SELECT CASE WHEN seq % 4 = 0 THEN 'provenance' WHEN score < 0.2 THEN 'fit' END AS reason FROM pairs) SELECT reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY reason""")
def q_drop_reasons(spark, sf_dir):
    why = F.when(F.col("seq") % 4 == 0, "provenance").when(F.col("score") < 0.2, "fit")
    return A.reasons(pairs(spark, sf_dir).withColumn("drop_reason", why))


@query(f"WITH {PAIRS_SQL} SELECT min(score) AS least, round(avg(score), 9) AS average, max(score) AS greatest FROM pairs")
def q_score_statistics(spark, sf_dir):
    return A.score_statistics(pairs(spark, sf_dir), "score").withColumn("average", F.round("average", 9))


# ------------------------------------------------------------------ model stages


@query(
    """WITH d AS (SELECT doc_id, doc_id % 3 <> 0 AS s, doc_id % 4 <> 0 AS g, lang, source FROM documents)
    SELECT doc_id, CASE WHEN doc_id % 11 <> 0 THEN s END AS supported, CASE WHEN doc_id % 11 <> 0 THEN g END AS good, CASE WHEN doc_id % 11 <> 0 THEN lang END AS reason, CASE WHEN doc_id % 11 <> 0 AND doc_id % 2 = 0 THEN source END AS suggested,
      CASE WHEN doc_id % 11 <> 0 THEN source END AS trimmed, CASE WHEN doc_id % 11 <> 0 THEN s END AS allowed, CASE WHEN doc_id % 11 <> 0 THEN g END AS passed, CASE WHEN doc_id % 11 <> 0 THEN CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'a,b,c,d,e,f' END END AS issues FROM d"""
)
def q_reply_verdicts(spark, sf_dir):
    d = F.col("doc_id")
    issues = F.when(d % 5 == 0, F.lit('"none"')).otherwise(F.lit('["a","b","c","d","e","f","g"]'))
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    yes = lambda c: F.when(c, F.lit("true")).otherwise(F.lit("false"))
    body = F.concat(
        F.lit('{"is_supported": '), yes(d % 3 != 0), F.lit(', "is_good_question": '), F.when(d % 4 != 0, F.lit('"yes"')).otherwise(F.lit("0")), F.lit(', "reason": '), q(F.concat(F.lit(" "), "lang")), F.lit(', "suggested_question": '), q(F.when(d % 2 == 0, F.col("source")).otherwise("")),
        F.lit(', "answer_trimmed": '), q(F.concat("source", F.lit(" "))), F.lit(', "allowed": '), yes(d % 3 != 0), F.lit(', "pass": '), yes(d % 4 != 0), F.lit(', "issues": '), issues, F.lit("}"),
    )
    reply = F.when(d % 11 == 0, F.lit("I cannot say.")).when(d % 2 == 0, F.concat(F.lit("Sure:\n```json\n"), body, F.lit("\n```"))).otherwise(body)
    rows = table(spark, sf_dir, "documents").select("doc_id", E.verdict(reply).alias("v"), E.trimmed(reply).alias("trimmed"), E.speaker_verdict(reply).alias("s"), E.audit_verdict(reply).alias("a"))
    return rows.select("doc_id", F.col("v.is_supported").alias("supported"), F.col("v.is_good_question").alias("good"), "v.reason", F.col("v.suggested_question").alias("suggested"), "trimmed", "s.allowed", "a.passed", F.array_join("a.issues", ",").alias("issues"))


_EXTRAS = ", ".join(f"'{w}'" for w in T.ALLOWED_EXTRAS)
_WORDS = lambda x: f"list_distinct(list_filter(list_transform(regexp_extract_all(lower({x}), '[A-Za-z0-9'']+'), lambda w: replace(w, '''', '')), lambda w: w <> ''))"
_COUNT = lambda x: f"len(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> ''))"


def _valid(q: str, context: str, answer: str) -> str:
    """SQL of a valid question; a null context leaves out the test of words."""
    new = f"len(list_filter({_WORDS(q)}, lambda x: NOT regexp_matches(x, '^[0-9]+$') AND NOT list_contains(list_concat({_WORDS(f'coalesce({context}, {chr(39)}{chr(39)}) || {chr(39)} {chr(39)} || {answer}')}, [{_EXTRAS}]), x) AND NOT list_contains(list_concat({_WORDS(f'coalesce({context}, {chr(39)}{chr(39)}) || {chr(39)} {chr(39)} || {answer}')}, [{_EXTRAS}]), regexp_replace(x, 's+$', ''))))"
    return f"(trim({q}) LIKE '%?' AND {_COUNT(f'substr(trim({q}), 1, length(trim({q})) - 1)')} <= 25 AND ({context} IS NULL OR {new} <= 4))"


@query(
    f"""WITH {PAIRS_SQL}, j AS (SELECT pair_id, trim(question) AS question, answer, context, score, seq % 7 = 0 AS bad, seq % 3 <> 0 AND episode_id % 4 <> 0 AS good, CASE WHEN episode_id % 2 = 0 THEN 'What is ' || split_part(context, ' ', 1) || '?' END AS idea FROM pairs),
    d AS (SELECT pair_id, CASE WHEN bad THEN 'error' WHEN good AND score >= 0.5 THEN 'accepted' WHEN idea IS NULL THEN 'rejected' WHEN NOT {_valid('idea', 'context', 'answer')} THEN 'invalid' WHEN NOT good OR score BETWEEN 0.45 AND 0.49 THEN 'retry' ELSE 'rejected' END AS s, question, idea FROM j)
    SELECT pair_id, CASE s WHEN 'invalid' THEN 'rejected' ELSE s END AS status, CASE s WHEN 'accepted' THEN question WHEN 'retry' THEN idea END AS question,
      CASE s WHEN 'error' THEN 'the judge''s reply is no JSON' WHEN 'rejected' THEN 'no' WHEN 'invalid' THEN 'the suggested question is not valid' END AS reason FROM d"""
)
def q_pairfit_decision(spark, sf_dir):
    good = (F.col("seq") % 3 != 0) & (F.col("episode_id") % 4 != 0)
    idea = F.when(F.col("episode_id") % 2 == 0, F.concat(F.lit("What is "), F.substring_index("context", " ", 1)))
    x = F.to_json(F.struct(good.alias("is_supported"), F.lit(True).alias("is_good_question"), F.lit("no").alias("reason"), F.coalesce(idea, F.lit("")).alias("suggested_question")))
    judged = E.verdict(F.when(F.col("seq") % 7 == 0, "no JSON").otherwise(x))
    out = E.decide(F.col("question"), F.col("answer"), F.col("context"), judged, F.col("score"))
    return pairs(spark, sf_dir).select("pair_id", out.alias("d")).select("pair_id", "d.status", "d.question", "d.reason")


_STARTERS = ", ".join(f"'{w}'" for w in T.QUESTION_STARTERS)
_IS_QUESTION = lambda x: f"(trim({x}) <> '' AND (trim({x}) LIKE '%?' OR replace(regexp_extract(lower(trim({x})), '[a-z0-9' || chr(39) || ']+'), chr(39), '') IN ({_STARTERS})))"
_MARKED = lambda x: f"CASE WHEN {x} LIKE '%?' THEN {x} ELSE {x} || '?' END"


@query(
    f"""WITH {PAIRS_SQL}, r AS (SELECT pair_id, context, answer, trim(question) AS m, {_MARKED('trim(question)')} AS mq, {_MARKED('context')} AS cq, seq % 3 = 0 AS own, 'What is ' || array_to_string(string_split(context, ' ')[1:3], ' ') || '?' AS re FROM pairs),
    v AS (SELECT *, {_valid('mq', 'context', 'answer')} AS mv, {_valid('cq', 'context', 'answer')} AS cv, {_valid('re', 'context', 'answer')} AS rv,
      trim(context) <> '' AND NOT contains(context, '?') AND length(trim(context)) BETWEEN 30 AND 220 AND NOT regexp_matches(lower(regexp_replace(trim(context), '^[ "''(\\[{{-]+', '')), '^({'|'.join(T.BLOCKED_PREFIXES)})( |$)') AS may FROM r),
    c AS (SELECT pair_id, mq, cq, re, CASE WHEN own AND m <> '' AND mv THEN 1 WHEN {_IS_QUESTION('context')} AND cv THEN 2 WHEN {_IS_QUESTION('m')} AND mv THEN 3 WHEN NOT own AND may AND rv THEN 4 WHEN m <> '' AND mv THEN 5 END AS k FROM v)
    SELECT pair_id, CASE k WHEN 2 THEN cq WHEN 4 THEN re ELSE CASE WHEN k IS NOT NULL THEN mq END END AS question, CASE k WHEN 1 THEN 'local' WHEN 2 THEN 'context' ELSE CASE WHEN k IS NOT NULL THEN 'model' END END AS origin, CASE WHEN k IS NOT NULL THEN k = 4 END AS used FROM c"""
)
def q_refined_question(spark, sf_dir):
    rows = pairs(spark, sf_dir)
    local = F.when(F.col("seq") % 3 == 0, F.col("question"))
    again = F.concat(F.lit("What is "), F.substring_index("context", " ", 3), F.lit("?"))
    best = S.refine_question(local, F.col("context"), F.col("context"), F.col("question"), again, F.col("answer"))
    return rows.select("pair_id", best.alias("x")).select("pair_id", "x.question", "x.origin", "x.used")


@query(f"WITH {PAIRS_SQL} SELECT pair_id, 'error' AS status, 1 AS attempts FROM pairs UNION ALL SELECT pair_id || '+', 'skipped', 0 FROM pairs")
def q_pairfit_stage(spark, sf_dir):
    rows = pairs(spark, sf_dir).select("pair_id", "question", "answer", F.col("answer").alias("source"), "context")
    off = E.evaluate(rows, enabled=False).select(F.concat("pair_id", F.lit("+")).alias("pair_id"), "fit.status", "attempts")
    return E.evaluate(rows).select("pair_id", "fit.status", "attempts").union(off)


@query(f"""WITH {PAIRS_SQL} SELECT pair_id, CASE WHEN trim(context) <> '' AND NOT contains(context, '?') AND length(trim(context)) BETWEEN 8 AND 220 AND NOT regexp_matches(lower(regexp_replace(trim(context), '^[ "''(\\[{{-]+', '')), '^({'|'.join(T.BLOCKED_PREFIXES)})( |$)') THEN 'reply to ' || length(replace(q, '{{context}}', context)) || ' characters?' END AS rephrased FROM pairs, (SELECT '{E.REPHRASE}' AS q)""")
def q_rephrased(spark, sf_dir):
    return E.rephrase(pairs(spark, sf_dir), F.col("context")).select("pair_id", "rephrased")


@query(f"""WITH {PAIRS_SQL} SELECT pair_id, replace(replace(replace('{prompts.FIT}', '{{question}}', question), '{{answer}}', answer), '{{source}}', context) AS prompt FROM pairs""")
def q_prompts(spark, sf_dir):
    return pairs(spark, sf_dir).select("pair_id", prompts.fit_prompt(F.col("question"), F.col("answer"), F.col("context")).alias("prompt"))


@query(f"""WITH {PAIRS_SQL}, w AS (SELECT pair_id, 6.0::DOUBLE * len(list_intersect(a, b)) / greatest(1, len(a)) - 3.0::DOUBLE AS x FROM (SELECT pair_id, list_distinct(list_filter(regexp_split_to_array(lower(question), '\\s+'), lambda w: w <> '')) AS a, list_distinct(list_filter(regexp_split_to_array(lower(answer), '\\s+'), lambda w: w <> '')) AS b FROM pairs))
    SELECT pair_id, round_even(1 / (1 + exp(-x)), 3) AS score FROM w""")
def q_fit_scores(spark, sf_dir):
    return pairs(spark, sf_dir).select("pair_id", M.fit_scores(F.col("question"), F.col("answer")).alias("score"))


@query("SELECT doc_id, CASE doc_id % 8 WHEN 0 THEN 'authentication' WHEN 1 THEN 'rate_limit' WHEN 2 THEN 'timeout' WHEN 3 THEN 'network' WHEN 4 THEN 'context_length' WHEN 5 THEN 'schema' WHEN 6 THEN 'unknown' END AS kind, doc_id % 8 IN (1, 2, 3) AS again FROM documents")
def q_error_classes(spark, sf_dir):
    said = F.get(F.array(*map(F.lit, ("Bad API key given", "HTTP 429: slow down", "Request timed out", "Connection refused", "Maximum context reached", "JSON validation of the reply", "odd", ""))), (F.col("doc_id") % 8).cast("int"))
    return table(spark, sf_dir, "documents").select("doc_id", E.error_class(said).alias("kind"), E.worth_retrying(said).alias("again"))


@query("SELECT doc_id, (doc_id % 60) * 60 + (doc_id % 7)::DOUBLE AS start, doc_id % 10 + 0.5 AS n, CASE WHEN doc_id % 2 = 0 THEN 2 ELSE 1 END AS pairs FROM documents")
def q_pairs_in_reply(spark, sf_dir):
    d = F.col("doc_id")
    one = F.concat(F.lit('{"question": "Q?", "answer": "'), "lang", F.lit('", "citations": [{"speaker": "A", "start": '), F.format_string("%02d:%02d", d % 60, d % 7), F.lit(', "end": '), F.format_string("0%d.5", d % 10), F.lit("}]}"))
    empty = F.lit('{"question": " ", "answer": "x"}')
    reply = F.when(d % 2 == 0, F.concat(F.lit("```json\n["), one, F.lit(","), one, F.lit(","), empty, F.lit("]\n```"))).otherwise(F.concat(F.lit('{"pairs": ['), one, F.lit("]}")))
    x = table(spark, sf_dir, "documents").select("doc_id", E.pairs(reply).alias("p"))
    c = F.get(F.get("p", 0)["citations"], 0)
    return x.select("doc_id", c["start"].alias("start"), c["end"].alias("n"), F.size("p").alias("pairs"))


@query("SELECT doc_id, '{\"start\": ' || ((doc_id % 60) * 60 + doc_id % 60)::DOUBLE || ', \"n\": ' || doc_id || ', \"s\": \"1:30\"}' AS value FROM documents")
def q_clock_numbers(spark, sf_dir):
    d = F.col("doc_id")
    raw = F.concat(F.lit('{"start": '), F.format_string("%d:%02d", d % 60, d % 60), F.lit(', "n": 00'), d.cast("string"), F.lit(', "s": "1:30"}'))
    return table(spark, sf_dir, "documents").select("doc_id", U.clock_numbers(raw).alias("value"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN ['a', 'None', 'True', source] WHEN 1 THEN ['x''y', source] WHEN 2 THEN ['it’s', source] ELSE [] END AS items FROM documents")
def q_lists_in_text(spark, sf_dir):
    k = F.col("doc_id") % 4
    raw = F.when(k == 0, F.concat(F.lit('["a", null, true, "'), "source", F.lit('"]'))).when(k == 1, F.concat(F.lit('so ["x\'y",\n "'), "source", F.lit('"] end]'))).when(k == 2, F.concat(F.lit("so ['it's', '"), "source", F.lit("']"))).otherwise(F.concat(F.lit("[broken "), "source"))
    return table(spark, sf_dir, "documents").select("doc_id", U.list_in(raw).alias("items"))


# ------------------------------------------------------------------ samples


def _mixed(spark, sf_dir):
    """Documents as samples of six shapes by id, a seventh that is no JSON."""
    d = F.col("doc_id")
    ms = F.array(X.message("user", F.col("source")), X.message(F.when(d % 7 == 6, "invalid").otherwise("assistant"), F.col("lang")))
    trace = F.array(F.struct(F.lit("t").alias("thought"), F.lit("a").alias("action")))
    shapes = [
        F.to_json(F.struct(ms.alias("messages"))), F.to_json(F.struct(F.col("source").alias("question"), F.col("lang").alias("answer"))), F.to_json(F.struct(ms.alias("messages"), trace.alias("reasoning_trace"), F.lit("9").alias("final_answer"))),
        F.to_json(F.struct(F.struct(F.col("source").alias("instruction"), F.col("lang").alias("output")).alias("data"))), F.concat(F.lit('{"x": "'), "source", F.lit('"}')), F.concat(F.lit("no "), "source"), F.to_json(F.struct(ms.alias("messages"))),
    ]
    out = shapes[-1]
    for k in range(6):
        out = F.when(d % 7 == k, shapes[k]).otherwise(out)
    return table(spark, sf_dir, "documents").select("doc_id", out.alias("sample"))


@query("SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'conversation' WHEN 1 THEN 'qa' WHEN 2 THEN 'structured' WHEN 5 THEN NULL ELSE 'generic' END AS kind, CASE doc_id % 7 WHEN 3 THEN source END AS inner_instruction FROM documents")
def q_sample_kinds(spark, sf_dir):
    return _mixed(spark, sf_dir).select("doc_id", Z.kind_of(F.col("sample")).alias("kind"), F.when(F.col("doc_id") % 7 == 3, X.field(Z.data_of(F.col("sample")), "instruction")).alias("inner_instruction"))


@query("SELECT 'valid' AS side, count(*) FILTER (doc_id % 7 NOT IN (5, 6)) + count(*) FILTER (doc_id % 2 = 0 AND doc_id % 7 NOT IN (5, 6)) AS n FROM documents UNION ALL SELECT 'not a JSON object', count(*) FILTER (doc_id % 7 = 5) + count(*) FILTER (doc_id % 2 = 0 AND doc_id % 7 = 5) FROM documents UNION ALL SELECT 'empty or invalid messages or values', count(*) FILTER (doc_id % 7 = 6) + count(*) FILTER (doc_id % 2 = 0 AND doc_id % 7 = 6) FROM documents")
def q_add_samples(spark, sf_dir):
    rows = _mixed(spark, sf_dir)
    good, bad = Z.add_samples(rows, rows.filter("doc_id % 2 = 0"))
    return good.agg(F.lit("valid").alias("side"), F.count("*").alias("n")).union(bad.groupBy(F.col("reason").alias("side")).agg(F.count("*").alias("n")))


def _turns(spark, sf_dir):
    d = F.col("doc_id")
    call = F.when(d % 3 == 0, F.concat(F.lit('{"name": "f", "arguments": {"k": "'), "lang", F.lit('"}}'))).when(d % 3 == 1, F.lit("{bad")).otherwise(F.lit('{"name": "g"}'))
    turn = lambda who, v: F.struct(F.lit(who).alias("from"), v.alias("value"))
    turns = F.array(turn("human", F.col("source")), turn("function_call", call), turn("observation", F.lit("o")), turn("gpt", F.col("lang")), turn("other", F.lit("z")))
    return table(spark, sf_dir, "documents").select("doc_id", F.to_json(F.struct(turns.alias("turns"), F.when(d % 2 == 0, "sys").otherwise("").alias("system"))).alias("sample"))


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'f{\"k\":\"' || lang || '\"}' WHEN 2 THEN 'g' ELSE '' END AS calls FROM documents")
def q_function_calls(spark, sf_dir):
    calls = F.transform(Z.function_calls(F.col("sample")), lambda c: F.concat_ws("", c["name"], c["arguments"]))
    return _turns(spark, sf_dir).select("doc_id", F.array_join(calls, ",").alias("calls"))


@query("""SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN '<|im_start|>system' || chr(10) || 'sys<|im_end|>' || chr(10) ELSE '' END || '<|im_start|>user' || chr(10) || source || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) ||
    CASE doc_id % 3 WHEN 0 THEN '{"name": "f", "arguments": {"k": "' || lang || '"}}' WHEN 1 THEN '{bad' ELSE '{"name": "g"}' END || '<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || 'o<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || lang || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS text FROM documents""")
def q_chat_text(spark, sf_dir):
    return _turns(spark, sf_dir).select("doc_id", Z.chat_text(Z.chat_messages(F.col("sample")), ask=True).alias("text"))


@query("""SELECT doc_id, k IN (0, 1, 2, 6) AS alpaca, k IN (0, 1, 2, 6) AS chatml, k IN (0, 1, 2, 6) AS grpo, k IN (0, 1, 2, 6) AS harmony, k IN (0, 1, 2, 6) AS im_format, false AS single_tool_call, false AS tool_calling, k IN (0, 1, 2, 6) AS unsloth, k IN (0, 1, 2, 6) AS unsloth_grpo, false AS xlam_v2 FROM (SELECT doc_id, doc_id % 7 AS k FROM documents)""")
def q_format_inputs(spark, sf_dir):
    return _mixed(spark, sf_dir).select("doc_id", *[Z.input_ok(n, F.col("sample")).alias(n) for n in X.FORMATS])


@query("""SELECT doc_id, k IN (0, 1, 2) AS alpaca, k IN (0, 1, 2, 6) AS chatml, k IN (0, 1, 2) AS grpo, k = 2 AS grpo_numeric, k IN (0, 1, 2, 6) AS im_format FROM (SELECT doc_id, doc_id % 7 AS k FROM documents)""")
def q_format_outputs(spark, sf_dir):
    s = F.col("sample")
    made = {n: X.FORMATS[n](s) for n in ("alpaca", "chatml", "im_format")}
    trace = X.FORMATS["grpo"](F.when(F.col("doc_id") % 7 == 2, F.regexp_replace(s, '"assistant"', '"tool"')).otherwise(s))
    out = _mixed(spark, sf_dir).select("doc_id", *[v.alias(f"_{n}") for n, v in made.items()], trace.alias("_grpo"))
    return out.select("doc_id", *[Z.output_ok(n, F.col(f"_{n}")).alias(n) for n in made], Z.output_ok("grpo", F.col("_grpo")).alias("grpo"), Z.output_ok("grpo_numeric", F.col("_grpo")).alias("grpo_numeric"))


@query(f"SELECT doc_id FROM documents ORDER BY {_ORDER.format(k='doc_id')}, doc_id LIMIT 20")
def q_choose(spark, sf_dir):
    return Z.choose(table(spark, sf_dir, "documents").select("doc_id"), 20, F.col("doc_id"))


@query(f"SELECT 'Topic: r' || r_regionkey || ' -> ' || n_name AS prompt FROM nation JOIN region ON r_regionkey = n_regionkey ORDER BY {_ORDER.format(k='(' + chr(39) + 'r' + chr(39) + ' || r_regionkey || chr(1) || n_name)')} LIMIT 7")
def q_sampled_paths(spark, sf_dir):
    paths = table(spark, sf_dir, "nation").select(F.array(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), F.col("n_name")).alias("path"))
    return prompts.sample_prompts(paths, 7, template="Topic: {path}").select("prompt")


@query("SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'cot_freetext_mathematical' WHEN 1 THEN 'cot_freetext' WHEN 2 THEN 'tool_calling' WHEN 3 THEN 'structured' WHEN 4 THEN 'basic' ELSE 'basic' END AS template FROM documents")
def q_prompt_template(spark, sf_dir):
    k = (F.col("doc_id") % 6).cast("int")
    kind = F.get(F.array(*map(F.lit, ("cot_freetext", "cot_freetext", "tool_calling", "structured", "basic", "odd"))), k)
    return table(spark, sf_dir, "documents").select("doc_id", Z.template_name(kind, F.when(k == 0, "mathematical").otherwise("general")).alias("template"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def q_missed_prompts(spark, sf_dir):
    replies = table(spark, sf_dir, "labels").select("doc_id", F.when(F.col("quality") == 1, "ok").alias("reply"))
    return Z.missed(table(spark, sf_dir, "documents").select("doc_id"), replies, "doc_id")


@query("SELECT steps, batch, steps * batch <= 64 AS fits, CASE WHEN steps * batch <= 64 THEN '' ELSE '1x64,2x32,4x16' END AS combos, least(batch, 64) AS shown FROM (SELECT r_regionkey + 1 AS steps, (r_regionkey + 1) * 7 AS batch FROM region)")
def q_path_requirements(spark, sf_dir):
    rows = []
    for (k,) in table(spark, sf_dir, "region").select("r_regionkey").collect():  # a handful of settings
        steps, batch = k + 1, (k + 1) * 7
        ok, combos = P.fits(steps, batch, 4, 3)
        rows.append((steps, batch, ok, ",".join(f"{a}x{b}" for a, b in combos), min(batch, 4**3)))
    return spark.createDataFrame(rows, "steps int, batch int, fits boolean, combos string, shown int")


# ------------------------------------------------------------------ records and conversion


@query(
    f"""WITH {SEGMENTS_SQL}, f AS (SELECT episode_id, string_agg('[' || printf('%.1f', "start") || '] ' || upper(speaker) || ': ' || text, chr(10) ORDER BY seq) AS t FROM (SELECT episode_id, seq, speaker, text, seq + 0.5 AS "start" FROM seg) GROUP BY episode_id)
    SELECT conv_id AS chunk_id, CASE WHEN conv_id % 3 <> 0 THEN 'TRANSCRIPT_LOADED' ELSE 'TRANSCRIPT_ERROR' END AS transcript_status, conv_id % 2 = 0 AS primary_speaker_hit,
    md5('Analyze the following source and produce a symbolic narrative summary.' || chr(10) || chr(10) || '[source_file=' || conv_id || ', chunk_id=' || conv_id || ', speaker=' || CASE WHEN conv_id % 2 = 0 THEN 'An n' ELSE 'Bob' END || ']' || chr(10) || chr(10) || '<<<TRANSCRIPT>>>' || chr(10)
      || CASE WHEN conv_id % 3 <> 0 THEN t ELSE 'Transcript chunk ' || conv_id || ' from ' || conv_id END || chr(10) || '<<<END TRANSCRIPT>>>' || chr(10)) AS user
    FROM (SELECT DISTINCT conv_id FROM conversations) JOIN f ON episode_id = conv_id"""
)
def q_conversations(spark, sf_dir):
    segs = segments(spark, sf_dir).select(F.col("episode_id").cast("string").alias("source_file"), "seq", (F.col("seq") + 0.5).cast("double").alias("start"), "speaker", "text")
    chunks = segs.select("source_file").distinct().withColumn("chunk_id", F.col("source_file").cast("long")).withColumn("speaker", F.when(F.col("chunk_id") % 2 == 0, 'An"\nn').otherwise("Bob"))
    out = C.conversations(chunks, C.transcripts(segs.filter(F.col("source_file").cast("long") % 3 != 0)), "an n", most=10_000_000)
    return out.select("chunk_id", "transcript_status", "primary_speaker_hit", F.md5(F.get("messages", 1)["content"]).alias("user"))


@query(
    """WITH RECURSIVE d AS (SELECT doc_id, text, list_filter(string_split(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: true) AS s FROM documents),
    f AS (SELECT doc_id, 1 AS k, CASE WHEN length(trim(s[1])) // 4 > 100 THEN '' ELSE s[1] END AS t, length(trim(s[1])) // 4 > 100 AS shut FROM d
      UNION ALL SELECT f.doc_id, k + 1, CASE WHEN length(trim(CASE WHEN t = '' THEN s[k + 1] ELSE t || ' ' || s[k + 1] END)) // 4 > 100 THEN t ELSE CASE WHEN t = '' THEN s[k + 1] ELSE t || ' ' || s[k + 1] END END,
        length(trim(CASE WHEN t = '' THEN s[k + 1] ELSE t || ' ' || s[k + 1] END)) // 4 > 100 FROM f JOIN d USING (doc_id) WHERE NOT shut AND k < len(s)),
    l AS (SELECT doc_id, arg_max(t, k) AS t FROM f GROUP BY doc_id)
    SELECT doc_id, md5(CASE WHEN length(text) // 4 <= 100 THEN text ELSE trim(t) END) AS text FROM d JOIN l USING (doc_id)"""
)
def q_sentence_budget(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(C.sentence_budget(F.col("text"), 100)).alias("text"))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 5 = 1 THEN 'order' END, CASE WHEN doc_id % 5 = 2 THEN 'analysis' END, CASE WHEN doc_id % 5 = 3 THEN 'cap' END, CASE WHEN doc_id % 5 = 4 THEN 'markers' END], lambda x: x IS NOT NULL), ',') AS failing FROM documents")
def q_conversation_checks(spark, sf_dir):
    k = F.col("doc_id") % 5
    none = F.lit(None).cast("string")
    m = lambda r, c, a=none, f=none: F.struct(r.alias("role"), c.alias("content"), a.alias("analysis"), f.alias("final"))
    final = F.when(k == 3, F.repeat(F.lit("word"), 600)).when(k == 4, F.concat("lang", F.lit("\nReasoning: so"))).otherwise(F.col("lang"))
    ms = F.array(m(F.when(k == 1, "user").otherwise("system"), F.lit("s")), m(F.lit("user"), F.col("source")), m(F.lit("assistant"), none, F.when(k == 2, "{}").otherwise("why"), final))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(C.conversation_checks(ms), ",").alias("failing"))


@query("SELECT doc_id, source AS \"user\", CASE doc_id % 3 WHEN 0 THEN 'given' WHEN 1 THEN '{\"symbolic_meaning\":\"' || lang || '\"}' ELSE '' END AS analysis, lang AS final FROM documents WHERE doc_id % 4 <> 0")
def q_repaired(spark, sf_dir):
    d = F.col("doc_id")
    s = F.to_json(F.struct(F.when(d % 4 == 0, "open").otherwise("completed").alias("status"), F.col("source").alias("transcript"), F.when(d % 3 == 0, "given").alias("analysis"), F.when(d % 3 == 1, F.col("lang")).alias("symbolic_meaning"), F.col("lang").alias("summary")))
    done = R.completed(table(spark, sf_dir, "documents").select("doc_id", s.alias("sample")))
    ms = C.repair(F.col("sample"))
    return done.select("doc_id", F.get(ms, 1)["content"].alias("user"), F.get(ms, 2)["analysis"].alias("analysis"), F.get(ms, 2)["final"].alias("final"))


@query("SELECT doc_id, v AS variant, i::INTEGER AS variant_index, md5(substr(source || repeat(' ' || lang, (CASE i WHEN 0 THEN 5 WHEN 1 THEN 12 ELSE 10 END)), 1, 40)) AS text FROM documents, (VALUES (0, 'base'), (1, 'abbreviated'), (2, 'detailed')) x(i, v)")
def q_variants(spark, sf_dir):
    rows = R.chunk_variants(table(spark, sf_dir, "documents").select("doc_id", "source", "lang"))
    padded = F.substring(F.concat("source", F.expr("repeat(concat(' ', lang), case variant_index when 0 then 5 when 1 then 12 else 10 end)")), 1, 40)
    return rows.select("doc_id", "variant", "variant_index", F.md5(padded).alias("text"))


@query("SELECT doc_id, CASE WHEN length(source) // 4 >= 10 THEN substr(source, 1, 40) ELSE substr(source || repeat(' and more of it', n), 1, 40) END AS text FROM (SELECT doc_id, source, least(12, greatest(0, ceil((40 - length(source)) / 15.0)))::INTEGER AS n FROM documents)")
def q_padded_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", U.to_length(F.col("source"), 10, "and more of it", 12).alias("text"))


@query("""SELECT doc_id, 'system=told|user=' || source || '|assistant=' || lang AS talk, doc_id % 2 = 0 AS modified FROM documents""")
def q_with_system(spark, sf_dir):
    none = F.lit(None).cast("string")
    ms = R.with_system(F.array(X.message("user", F.col("source")), X.message("assistant", F.col("lang"))), F.lit("told"))
    full = F.transform(ms, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"), F.when((m["role"] == "assistant") & (F.col("doc_id") % 2 == 0), F.lit('{"symbolic_meaning": "x"}')).otherwise(none).alias("analysis"), F.when((m["role"] == "assistant") & (F.col("doc_id") % 2 == 0), F.lit('{"summary": "y"}')).otherwise(none).alias("final")))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(F.transform(ms, lambda m: F.concat(m["role"], F.lit("="), m["content"])), "|").alias("talk"), R.flattened(full)["modified"].alias("modified"))


_LOOSE = lambda x: "trim(regexp_replace(translate(lower(" + x + "), '!\"#$%&''()*+,-./:;<=>?@[\\]^_`{|}~', ''), '\\s+', ' ', 'g'))"


@query(f"""WITH {PAIRS_SQL} SELECT pair_id, seq % 3 <> 2 AS found FROM pairs""")
def q_answer_match(spark, sf_dir):
    k = F.col("seq") % 3
    source = F.concat(F.lit("Before. "), "answer", F.lit(" After."))
    said = F.when(k == 0, F.replace("answer", F.lit(" "), F.lit("  "))).when(k == 1, F.concat(F.lit("before "), "answer", F.lit(" aftex"))).otherwise(F.reverse(F.col("answer")))
    return pairs(spark, sf_dir).select("pair_id", M.match_answer(source, said).alias("found"))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN k = 0 THEN 'three' END, CASE WHEN k = 1 THEN 'system_first' END, CASE WHEN k = 2 THEN 'user_cap' END, CASE WHEN k = 3 THEN 'analysis' END, CASE WHEN k = 4 THEN 'final' END], lambda x: x IS NOT NULL), ',') AS failing FROM (SELECT doc_id, doc_id % 6 AS k FROM documents)")
def q_channel_checks(spark, sf_dir):
    k = F.col("doc_id") % 6
    none = F.lit(None).cast("string")
    m = lambda r, c, a=none, f=none: F.struct(F.lit(r).alias("role"), c.alias("content"), a.alias("analysis"), f.alias("final"))
    user = m("user", F.when(k == 2, F.repeat(F.lit("abcd"), 600)).otherwise(F.col("source")))
    said = m("assistant", none, F.when(k == 3, " ").otherwise("why"), F.when(k == 4, F.repeat(F.lit("abcd"), 600)).otherwise(F.col("lang")))
    ms = F.when(k == 0, F.array(m("system", F.lit("s")), said)).when(k == 1, F.array(user, said, user)).otherwise(F.array(m("system", F.lit("s")), user, said))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(G.channel_record(ms), ",").alias("failing"))


@query("SELECT doc_id, array_to_string(list_filter([CASE WHEN k = 1 THEN 'mode' END, CASE WHEN k = 2 THEN 'connectors' END, CASE WHEN k = 3 THEN 'chars' END, CASE WHEN k = 4 THEN 'spans' END, CASE WHEN k = 5 THEN 'numbers' END], lambda x: x IS NOT NULL), ',') AS failing FROM (SELECT doc_id, doc_id % 7 AS k FROM documents)")
def q_composition_checks(spark, sf_dir):
    k = F.col("doc_id") % 7
    spans = F.when(k == 4, F.lit("[]")).when(k == 5, F.lit('[{"speaker":"a","start":"x","end":1}]')).otherwise(F.lit('[{"speaker":"a","start":0.5,"end":1}]'))
    mode = F.when(k == 1, "C").when(k == 0, "A").otherwise("B")
    n, chars = F.when(k == 0, 0).when(k == 2, 9).otherwise(1), F.when(k == 0, 0).when(k == 3, 999).otherwise(50)
    s = F.concat(F.lit('{"composition": {"mode": "'), mode, F.lit('", "connector_sentences": '), n.cast("string"), F.lit(', "paraphrase_chars": '), chars.cast("string"), F.lit(', "quoted_spans": '), spans, F.lit("}}"))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(G.composition(s), ",").alias("failing"))


@query("SELECT doc_id, doc_id % 7 NOT IN (5, 6) AS valid FROM documents")
def q_sample_valid(spark, sf_dir):
    return _mixed(spark, sf_dir).select("doc_id", G.sample_valid(F.col("sample")).alias("valid"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Because of ' || lang || '.' WHEN 1 THEN 'so it is' WHEN 2 THEN 'First. ' || source ELSE lang || ' alone' END AS reasoning, CASE doc_id % 4 WHEN 0 THEN source WHEN 1 THEN doc_id || '.5' WHEN 2 THEN 'then ' || lang ELSE lang || ' alone' END AS answer FROM documents""")
def q_split_reasoning(spark, sf_dir):
    k = F.col("doc_id") % 4
    x = F.when(k == 0, F.concat(F.lit("Because of "), "lang", F.lit(". ANSWER: "), "source")).when(k == 1, F.concat(F.lit("so it is "), F.col("doc_id").cast("string"), F.lit(".5 "))).when(k == 2, F.concat(F.lit("First. "), "source", F.lit(". then "), "lang")).otherwise(F.concat("lang", F.lit(" alone")))
    return table(spark, sf_dir, "documents").select("doc_id", X.split_reasoning(x).alias("x")).select("doc_id", "x.reasoning", "x.answer")


@query("SELECT doc_id, ['string', 'integer', 'number', 'boolean', 'array', 'object', 'string'][(doc_id % 7)::INTEGER + 1] AS schema_type, ['string', 'number', 'boolean[]', 'any[]', 'any', 'object', 'number'][(doc_id % 7)::INTEGER + 1] AS script FROM documents")
def q_type_names(spark, sf_dir):
    k = (F.col("doc_id") % 7).cast("int")
    python = F.get(F.array(*map(F.lit, ("str", "int", "float", "bool", "list", "dict", "odd"))), k)
    kind = F.get(F.array(*map(F.lit, ("string", "integer", "array", "array", "odd", "object", "number"))), k)
    return table(spark, sf_dir, "documents").select("doc_id", X.param_type(python).alias("schema_type"), X.script_type(kind, F.when(k == 2, "boolean")).alias("script"))


@query("SELECT doc_id, 'ab 12 ' || lower(lang) || ' \"q\" ...x' AS form FROM documents")
def q_normal_form(spark, sf_dir):
    x = F.concat(F.lit(" ,“Ａｂ\t １２  "), F.upper("lang"), F.lit(" “Q” …x”! "))
    return table(spark, sf_dir, "documents").select("doc_id", U.normal_form(x).alias("form"))


@query("SELECT conv_id, turn, conv_id AS episode_id, turn AS window_index, substr(sha256(text), 1, 16) AS digest, substr(text, 1, 40) AS cut FROM conversations")
def q_cache_key(spark, sf_dir):
    k = T.cache_key(F.col("conv_id"), F.col("turn"), F.col("text"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", k.alias("k"), U.cut_tokens(F.col("text"), 10).alias("cut")).select("conv_id", "turn", "k.*", "cut")


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) = '' AS blank, md5(regexp_replace(text, '\\s+', ' ', 'g')) AS squeezed, source || '?' AS asked, CASE WHEN doc_id % 3 = 0 THEN (doc_id * 1.5)::DOUBLE END AS number, 3 AS words FROM documents")
def q_small_helpers(spark, sf_dir):
    t = F.col("text")
    number = T.to_number(F.when(F.col("doc_id") % 3 == 0, (F.col("doc_id") * F.lit(1.5)).cast("string")).otherwise("x"), missing_as_nan=False)
    return table(spark, sf_dir, "documents").select("doc_id", T.blank(t).alias("blank"), F.md5(T.squeeze(t)).alias("squeezed"), T.ends_as_question(F.concat(F.lit(" "), "source")).alias("asked"), number.alias("number"), S.word_marks(F.lit("it's well-known, éa!")).alias("words"))


# ------------------------------------------------------------------ graphs


@query(
    """WITH l1 AS (SELECT r_regionkey + 1 AS id, r_name AS topic FROM region), l2 AS (SELECT 5 + row_number() OVER (ORDER BY n_regionkey, n_nationkey) AS id, n_name AS topic, n_regionkey + 1 AS up FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS k FROM nation) WHERE k <= 3),
    e AS (SELECT 0 AS p, id AS c FROM l1 UNION SELECT up, id FROM l2 UNION SELECT 2, id FROM l2)
    SELECT id::INTEGER AS id, topic, coalesce(string_agg(p::VARCHAR, ',' ORDER BY p), '') AS parents FROM (SELECT 0 AS id, 'world' AS topic UNION ALL SELECT * FROM l1 UNION ALL SELECT id, topic FROM l2) LEFT JOIN e ON c = id GROUP BY id, topic"""
)
def q_graph_growth(spark, sf_dir):
    r, n = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")

    def propose(leaves, degree):
        first = r.select(F.lit(0).alias("parent_id"), (F.col("r_regionkey") + 1).alias("rank"), F.col("r_name").alias("topic"), F.array().cast("array<int>").alias("connections"))
        w = F.row_number().over(P.Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
        # connections to a node that is there (2), one that is not (900)
        more = n.select((F.col("n_regionkey") + 1).cast("int").alias("parent_id"), w.alias("rank"), F.col("n_name").alias("topic"), F.array(F.lit(2), F.lit(900)).alias("connections"))
        return first.union(more).join(leaves.select(F.col("id").alias("parent_id")), "parent_id", "left_semi")

    root = spark.createDataFrame([(0, "world")], "id int, topic string")
    nodes, edges = P.expand_graph(root, spark.createDataFrame([], "parent_id int, child_id int"), lambda x, d: propose(x, d).filter((F.col("parent_id") == 0) | (F.col("rank") <= 3)), 5, 2)
    return P.graph_json(nodes, edges).select("id", "topic", F.array_join(F.transform("parents", lambda x: x.cast("string")), ",").alias("parents"))


@query("SELECT 1 AS depth, count(*) AS nodes FROM region UNION ALL SELECT 2, count(*) FROM nation UNION ALL SELECT 3, count(*) FROM supplier")
def q_tree_levels(spark, sf_dir):
    r, n, s = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    paths = s.join(n, F.col("s_nationkey") == F.col("n_nationkey"), "right").join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    paths = paths.select(F.filter(F.array("r_name", "n_name", F.col("s_suppkey").cast("string")), lambda x: x.isNotNull()).alias("path"))
    return P.level_counts(paths)


@query("SELECT 'n' || n_nationkey AS id FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM supplier) UNION ALL SELECT 's' || s_suppkey FROM supplier")
def q_graph_leaves(spark, sf_dir):
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    name = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nodes = n.select(name("n", "n_nationkey").alias("id")).union(s.select(name("s", "s_suppkey")))
    return P.leaves(nodes, s.select(name("n", "s_nationkey").alias("parent_id"), name("s", "s_suppkey").alias("child_id")))
