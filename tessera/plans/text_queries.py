"""Queries of the scalar text functions, over documents and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.functions import udf as U
from tessera.operators import gates as G
from tessera.plans.tables import CLOCK, PAIRS_SQL, SEGMENTS_SQL, pairs, registrar, segments, table

QUERIES, ORACLE_SQL, query = registrar()
_EXTRAS = ", ".join(f"'{w}'" for w in T.ALLOWED_EXTRAS)
_STARTERS = ", ".join(f"'{w}'" for w in T.QUESTION_STARTERS)
_WORDS = lambda x: f"list_distinct(list_filter(list_transform(regexp_extract_all(lower({x}), '[A-Za-z0-9'']+'), lambda w: replace(w, '''', '')), lambda w: w <> ''))"
_COLLAPSE = lambda x: f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"
_COUNT = lambda x: f"len(list_filter(regexp_split_to_array({x}, '\\s+'), lambda w: w <> ''))"
_QUOTES = "translate({x}, chr(8216) || chr(8217) || chr(8220) || chr(8221) || chr(8208) || chr(8209) || chr(8210) || chr(8211) || chr(8212), '''''\"\"-----')"


@query("SELECT conv_id AS episode_id, turn AS seq, trim(text) AS text, role AS speaker FROM conversations WHERE text IS NOT NULL AND length(trim(text)) >= 40")
def q_scan_clean(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("episode_id"), F.col("turn").alias("seq"), T.strip(F.col("text")).alias("text"), F.col("role").alias("speaker"))
    return rows.filter(F.length("text") >= 40)


@query(f"SELECT doc_id, {_COLLAPSE(chr(39).join(['translate(lower(text), ', '!\"#$%&' + chr(39) + chr(39) + '()*+,-./:;<=>?@[\\]^_`{|}~', ', ', chr(39) + ')']))} AS loose, lower({_COLLAPSE(_QUOTES.format(x='text'))}) AS quoted, md5({_COLLAPSE('replace(replace(lower(text), chr(8230), chr(46) || chr(46) || chr(46)), chr(8594), chr(45) || chr(62))')}) AS provenance FROM documents")
def q_normalisers(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", T.loose_norm(t).alias("loose"), T.quote_norm(t).alias("quoted"), F.md5(T.provenance_norm(t)).alias("provenance"))


@query(f"SELECT doc_id, md5(substr(lower({_COLLAPSE(chr(114) + 'egexp_replace(source || ' + chr(39) + '|' + chr(39) + ' || text, ' + chr(39) + '[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}_' + chr(92) + 's]' + chr(39) + ', ' + chr(39) * 2 + ', ' + chr(39) + 'g' + chr(39) + ')')}), 1, 200)) AS fingerprint FROM documents")
def q_norm_fingerprint(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.fingerprint(F.col("source"), F.col("text")).alias("fingerprint"))


@query(r"SELECT doc_id, len(s)::INTEGER AS n, md5(array_to_string(s, '|')) AS pieces FROM (SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(trim(text), '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x)), lambda x: x <> '') AS s FROM documents)")
def q_sentence_split(spark, sf_dir):
    s = T.sentences(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", s.alias("s")).select("doc_id", F.size("s").alias("n"), F.md5(F.array_join("s", "|")).alias("pieces"))


@query(f"SELECT doc_id, greatest(1, length(text) // 4)::INTEGER AS tokens, {_COUNT('text')}::INTEGER AS words, {_COUNT('text')} > 60 AS long FROM documents")
def q_token_budget(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", T.count_tokens(t, 1).alias("tokens"), T.count_words(t).alias("words"), (T.count_words(t) > 60).alias("long"))


@query(f"SELECT doc_id, len(w)::INTEGER AS n, md5(array_to_string(list_sort(w), ' ')) AS words FROM (SELECT doc_id, {_WORDS('text')} AS w FROM documents)")
def q_word_set(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", T.word_set(F.col("text")).alias("w")).select("doc_id", F.size("w").alias("n"), F.md5(F.array_join(F.array_sort("w"), " ")).alias("words"))


@query(f"WITH {PAIRS_SQL} SELECT pair_id, trim(question) <> '' AND (trim(question) LIKE '%?' OR replace(regexp_extract(lower(trim(question)), '[a-z0-9'']+'), '''', '') IN ({_STARTERS})) AS is_question FROM pairs")
def q_is_question(spark, sf_dir):
    return pairs(spark, sf_dir).select("pair_id", T.is_question(F.col("question")).alias("is_question"))


@query(
    f"""WITH {PAIRS_SQL}, w AS (SELECT pair_id, trim(question) AS q, {_WORDS('question')} AS qw, list_concat({_WORDS("context || ' ' || answer")}, [{_EXTRAS}]) AS pool FROM pairs),
    n AS (SELECT pair_id, q, len(list_filter(qw, lambda x: NOT regexp_matches(x, '^[0-9]+$') AND NOT list_contains(pool, x) AND NOT list_contains(pool, regexp_replace(x, 's+$', ''))))::INTEGER AS new FROM w)
    SELECT pair_id, new AS new_words, q LIKE '%?' AND {_COUNT('substr(q, 1, length(q) - 1)')} <= 25 AND new <= 4 AS valid FROM n"""
)
def q_validate_question(spark, sf_dir):
    q, known = T.strip(F.col("question")), F.concat_ws(" ", "context", "answer")
    return pairs(spark, sf_dir).select("pair_id", F.size(T.new_words(q, known)).alias("new_words"), T.valid_question(F.col("question"), F.col("context"), F.col("answer")).alias("valid"))


@query(
    f"""WITH {PAIRS_SQL} SELECT pair_id, trim(context) <> '' AND NOT contains(context, '?') AND length(trim(context)) BETWEEN 8 AND 220
    AND NOT regexp_matches(lower(regexp_replace(trim(context), '^[ "''(\\[{{-]+', '')), '^({'|'.join(T.BLOCKED_PREFIXES)})( |$)') AS may FROM pairs"""
)
def q_questionify_gate(spark, sf_dir):
    return pairs(spark, sf_dir).select("pair_id", T.may_rephrase(F.col("context")).alias("may"))



@query(f"""WITH {SEGMENTS_SQL}, r AS (SELECT *, round("start", 3) AS a, round("end", 3) AS b FROM seg) SELECT episode_id, seq, '[' || {CLOCK.format(x='a')} || '–' || {CLOCK.format(x='b')} || '] ' || speaker || ': ' || text AS line FROM r""")
def q_format_segment(spark, sf_dir):
    return segments(spark, sf_dir).select("episode_id", "seq", T.format_segment(F.round("start", 3), F.round("end", 3), F.col("speaker"), F.col("text")).alias("line"))


@query("SELECT doc_id, (('0x' || substr(sha256(doc_id || ':42'), 1, 16))::UBIGINT % 100)::INTEGER AS bucket, substr(sha256(text), 1, 16) AS digest, round(1 / (1 + exp(-((doc_id % 13) - 6)::DOUBLE)), 3) AS score FROM documents")
def q_hash_bucket(spark, sf_dir):
    score = F.round(T.sigmoid(((F.col("doc_id") % 13) - 6).cast("double")), 3)
    return table(spark, sf_dir, "documents").select("doc_id", T.hash_mod(F.concat(F.col("doc_id").cast("string"), F.lit(":42")), 100).alias("bucket"), F.substring(F.sha2("text", 256), 1, 16).alias("digest"), score.alias("score"))


@query(r"SELECT doc_id, coalesce(nullif(regexp_extract(x, '^([\p{L}\p{N}_]+):', 1), ''), nullif(trim(regexp_extract(x, '^\[(.*?)\]', 1)), ''), nullif(regexp_extract(x, '^([\p{L}\p{N}_]+)\s*-', 1), ''), 'unknown') AS speaker FROM (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN source || ': ' WHEN 1 THEN '[' || source || '] ' WHEN 2 THEN source || ' - ' ELSE '' END || lang || '!' AS x FROM documents)")
def q_speaker_of_line(spark, sf_dir):
    x = F.when(F.col("doc_id") % 4 == 0, F.concat("source", F.lit(": "))).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("["), "source", F.lit("] "))).when(F.col("doc_id") % 4 == 2, F.concat("source", F.lit(" - "))).otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", T.speaker_of(F.concat(x, "lang", F.lit("!"))).alias("speaker"))


@query("SELECT doc_id, CASE WHEN regexp_matches(lower(x), 'math|calculus|algebra|geometry|equation') THEN 'educational' WHEN regexp_matches(lower(x), 'programming|code|software|python|algorithm') THEN 'technical' WHEN regexp_matches(lower(x), 'chat|conversation|talk|friendly|assistant') THEN 'conversational' ELSE 'general' END AS domain FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'Some Math ' WHEN 1 THEN 'python ' WHEN 2 THEN 'a talk ' ELSE '' END || source AS x FROM documents)")
def q_domain(spark, sf_dir):
    lead = F.when(F.col("doc_id") % 5 == 0, "Some Math ").when(F.col("doc_id") % 5 == 1, "python ").when(F.col("doc_id") % 5 == 2, "a talk ").otherwise("")
    return table(spark, sf_dir, "documents").select("doc_id", T.domain(F.concat(lead, "source")).alias("domain"))


@query("SELECT doc_id, source AS payload FROM documents")
def q_json_payload(spark, sf_dir):
    fenced = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("Here:\n```json\n"), "source", F.lit("\n```\nend"))).when(F.col("doc_id") % 3 == 1, F.concat(F.lit(" ```\n"), "source", F.lit(" ```"))).otherwise(F.concat(F.lit("  "), "source", F.lit("\n")))
    return table(spark, sf_dir, "documents").select("doc_id", T.json_payload(fenced).alias("payload"))


@query(r"SELECT doc_id, len(x)::INTEGER AS marks FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda l: trim(l)), lambda l: regexp_matches(l, '(?i)^(Reasoning:|Let''s think|\d+\.|\*\s*\d+\.)')) AS x FROM (SELECT doc_id, text || chr(10) || CASE doc_id % 3 WHEN 0 THEN '1. first' WHEN 1 THEN ' reasoning: x' ELSE 'none' END AS text FROM documents))")
def q_reasoning_markers(spark, sf_dir):
    extra = F.when(F.col("doc_id") % 3 == 0, "1. first").when(F.col("doc_id") % 3 == 1, " reasoning: x").otherwise("none")
    return table(spark, sf_dir, "documents").select("doc_id", F.size(G.reasoning_lines(F.concat("text", F.lit("\n"), extra))).alias("marks"))


@query(
    f"""WITH {PAIRS_SQL}, t AS (SELECT pair_id, answer, trim(CASE WHEN seq % 2 = 0 THEN split_part(answer, '.', 1) ELSE question END, ' .,!?;:"' || chr(39) || chr(10) || chr(13) || chr(9)) AS part FROM pairs), p AS (SELECT *, CASE WHEN part <> '' THEN instr(lower(answer), lower(part)) ELSE 0 END AS pos FROM t),
    o AS (SELECT pair_id, pos, length(part) AS n, pos > 0 AND substr(answer, pos, length(part)) = part AND NOT regexp_matches(substr(answer, pos + length(part), 1), '[\\p{{L}}\\p{{N}}]') AND NOT (pos > 1 AND regexp_matches(substr(answer, pos - 1, 1), '[\\p{{L}}\\p{{N}}]')) AS ok FROM p)
    SELECT pair_id, CASE WHEN ok THEN pos - 1 END::INTEGER AS start, CASE WHEN ok THEN pos - 1 + n END::INTEGER AS "end" FROM o"""
)
def q_verbatim_span(spark, sf_dir):
    rows = pairs(spark, sf_dir)
    part = F.when(F.col("seq") % 2 == 0, F.substring_index("answer", ".", 1)).otherwise(F.col("question"))
    return rows.select("pair_id", U.verbatim_span(F.col("answer"), part).alias("x")).select("pair_id", "x.start", "x.end")
