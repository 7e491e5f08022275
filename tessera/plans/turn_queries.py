"""Queries of the segment operators, over conversations and events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import gates as G
from tessera.operators import segments as S
from tessera.streaming import sessions as W
from tessera.plans.tables import CLOCK, PAIRS_SQL, SEGMENTS_SQL, pairs, registrar, segments, table

QUERIES, ORACLE_SQL, query = registrar()


def _rounded(df):
    return df.select("episode_id", "seq", "n", F.round("start", 2).alias("start"), F.round("end", 2).alias("end"), F.md5("text").alias("text"))


_GROUPS = """SELECT episode_id, min(seq) AS seq, count(*) AS n, round(min("start"), 2) AS "start", round(max("end"), 2) AS "end", md5(string_agg(text, ' ' ORDER BY seq)) AS text FROM {x} GROUP BY episode_id, island"""


@query(
    f"""WITH {SEGMENTS_SQL}, g AS (SELECT *, "start" - lag("end") OVER w AS gap FROM seg WINDOW w AS (PARTITION BY episode_id ORDER BY seq)),
    i AS (SELECT *, sum(CASE WHEN gap <= 1.0 THEN 0 ELSE 1 END) OVER (PARTITION BY episode_id ORDER BY seq) AS island FROM g) {_GROUPS.format(x='i')}"""
)
def q_gap_merge(spark, sf_dir):
    return _rounded(S.merge_by_gap(segments(spark, sf_dir)))


@query(
    f"""WITH RECURSIVE {SEGMENTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY seq) AS k FROM seg),
    f AS (SELECT episode_id, seq, "start", "end", text, k, 1 AS island, length(text) AS size FROM r WHERE k = 1
      UNION ALL SELECT r.episode_id, r.seq, r."start", r."end", r.text, r.k, f.island + CASE WHEN r."start" - f."end" <= 1.5 AND f.size + 1 + length(r.text) <= 1200 THEN 0 ELSE 1 END,
        CASE WHEN r."start" - f."end" <= 1.5 AND f.size + 1 + length(r.text) <= 1200 THEN f.size + 1 + length(r.text) ELSE length(r.text) END
      FROM f JOIN r ON r.episode_id = f.episode_id AND r.k = f.k + 1) {_GROUPS.format(x='f')}"""
)
def q_gap_merge_capped(spark, sf_dir):
    return _rounded(S.merge_with_cap(segments(spark, sf_dir), 1.5, 1200))


_SAME = "SELECT episode_id, min(seq) AS seq, count(*) AS n, arg_min(speaker, seq) AS speaker, md5(string_agg(text, ' ' ORDER BY seq)) AS text FROM i GROUP BY episode_id, island"


@query(
    f"""WITH {SEGMENTS_SQL}, p AS (SELECT conv.*, conv."start" - lag("end") OVER w AS gap, lag(speaker) OVER w AS before FROM (SELECT episode_id, seq, "start", "end", CASE WHEN seq % 3 = 0 THEN 'user' ELSE speaker END AS speaker, text FROM seg) conv WINDOW w AS (PARTITION BY episode_id ORDER BY seq)),
    i AS (SELECT *, sum(CASE WHEN before = speaker AND (gap IS NULL OR gap <= 1.5) THEN 0 ELSE 1 END) OVER (PARTITION BY episode_id ORDER BY seq) AS island FROM p) {_SAME}"""
)
def q_consecutive_merge(spark, sf_dir):
    rows = segments(spark, sf_dir).withColumn("speaker", F.when(F.col("seq") % 3 == 0, "user").otherwise(F.col("speaker")))
    return S.merge_same_speaker(rows, 1.5).select("episode_id", "seq", "n", "speaker", F.md5("text").alias("text"))


@query(
    f"""WITH {SEGMENTS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY seq) AS r FROM seg),
    a AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY seq) AS k FROM n WHERE speaker = 'assistant')
    SELECT a.episode_id || '|' || a.seq AS window_id, least(a.r - 1, 2)::INTEGER AS anchor_index, count(*)::INTEGER AS n, md5(string_agg(b.text, ' ' ORDER BY b.seq)) AS text
    FROM a JOIN n b ON a.episode_id = b.episode_id AND b.r BETWEEN a.r - 2 AND a.r + 2 WHERE (a.k - 1) % 2 = 0 GROUP BY a.episode_id, a.seq, a.r"""
)
def q_anchor_windows(spark, sf_dir):
    w = S.anchor_windows(segments(spark, sf_dir), ["Assistant"], 2, 2)
    return w.select("window_id", "anchor_index", F.size("segments").alias("n"), F.md5(F.array_join(F.transform("segments", lambda s: s["text"]), " ")).alias("text"))


@query(f"""WITH {SEGMENTS_SQL} SELECT episode_id, seq, ((row_number() OVER (PARTITION BY episode_id ORDER BY seq) - 1) // 3)::INTEGER AS window_index FROM seg""")
def q_turn_windows(spark, sf_dir):
    return S.turn_windows(segments(spark, sf_dir), 3).select("episode_id", "seq", "window_index")


@query(f"""WITH {SEGMENTS_SQL}, f AS (SELECT episode_id, speaker, min(seq) AS first FROM seg GROUP BY 1, 2) SELECT episode_id, string_agg(speaker, ',' ORDER BY first, speaker) AS speakers FROM f GROUP BY episode_id""")
def q_first_seen_speakers(spark, sf_dir):
    return S.first_seen_speakers(segments(spark, sf_dir)).select("episode_id", F.array_join("speakers", ",").alias("speakers"))


@query(
    f"""WITH {SEGMENTS_SQL}, c AS (SELECT episode_id, seq AS cite, speaker, round("start", 3) - 5.0::DOUBLE AS a, round("end", 3) + 20.0::DOUBLE AS b FROM seg)
    SELECT c.episode_id, c.cite, count(*) AS n, md5(string_agg(trim(s.text), ' ' ORDER BY s.seq)) AS span FROM c JOIN seg s ON s.episode_id = c.episode_id AND s.speaker = c.speaker
    AND round(s."end", 3) >= c.a AND round(s."start", 3) <= c.b AND trim(s.text) <> '' GROUP BY 1, 2"""
)
def q_span_overlap(spark, sf_dir):
    rows = segments(spark, sf_dir).withColumn("start", F.round("start", 3)).withColumn("end", F.round("end", 3))
    cites = rows.select("episode_id", F.col("seq").alias("cite"), "speaker", (F.col("start") - 5.0).alias("c_start"), (F.col("end") + 20.0).alias("c_end"))
    return S.overlap_join(cites, rows).select("episode_id", "cite", "n", F.md5("span").alias("span"))


@query(f"""WITH {PAIRS_SQL}, t AS (SELECT pair_id, answer, split_part(answer, '.', 1) || '.' AS cand FROM pairs) SELECT pair_id, instr(answer, cand)::INTEGER - 1 AS start_char, (instr(answer, cand) - 1 + length(cand))::INTEGER AS end_char FROM t WHERE instr(answer, cand) > 0 AND length(cand) < length(answer) AND trim(cand) = cand""")
def q_trim_substring(spark, sf_dir):
    cand = F.concat(F.substring_index("answer", ".", 1), F.lit("."))
    return pairs(spark, sf_dir).withColumn("x", G.trim(F.col("answer"), cand)).filter("x is not null").select("pair_id", "x.start_char", "x.end_char")


@query(f"""WITH {PAIRS_SQL} SELECT pair_id, CASE WHEN seq % 4 <> 0 AND seq % 3 <> 0 AND score >= 0.5 THEN 'passed' WHEN seq % 4 <> 0 THEN 'retry' ELSE 'failed' END AS fit, (score >= 0.5) = (episode_id % 2 = 0) AS consistent FROM pairs""")
def q_pair_fit(spark, sf_dir):
    fit = G.pair_fit(F.col("seq") % 4 != 0, F.col("seq") % 3 != 0, F.col("score"))
    return pairs(spark, sf_dir).select("pair_id", fit.alias("fit"), G.fit_consistent(F.col("episode_id") % 2 == 0, F.col("score")).alias("consistent"))


@query(f"""WITH {SEGMENTS_SQL} SELECT episode_id, seq FROM seg WHERE speaker IN ('user', 'system') AND "end" > 10.0 AND "start" < 60.0""")
def q_speaker_time_filter(spark, sf_dir):
    rows = segments(spark, sf_dir)
    return rows.filter(G.kept_speaker(F.col("speaker"), include=["User", "System"]) & G.in_time(F.col("start"), F.col("end"), 10.0, 60.0)).select("episode_id", "seq")


@query(
    """WITH e AS (SELECT user_id, event_id, ts, epoch_us(ts) AS us FROM events), g AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us, event_id) AS gap FROM e),
    i AS (SELECT *, sum(CASE WHEN gap <= 3600000000 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY us, event_id) AS island FROM g)
    SELECT user_id, min(event_id) AS first_id, count(*) AS n, max(us) - min(us) AS span_us FROM i GROUP BY user_id, island"""
)
def q_event_gap_merge(spark, sf_dir):
    from pyspark.sql import Window

    e = table(spark, sf_dir, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    w = Window.partitionBy("user_id").orderBy("us", "event_id")
    e = e.withColumn("new", F.when(F.col("us") - F.lag("us").over(w) <= 3_600_000_000, 0).otherwise(1)).withColumn("island", F.sum("new").over(w))
    return e.groupBy("user_id", "island").agg(F.min("event_id").alias("first_id"), F.count("*").alias("n"), (F.max("us") - F.min("us")).alias("span_us")).drop("island")


_AROUND = f"""{SEGMENTS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY episode_id ORDER BY seq) AS r FROM seg), a AS (SELECT *, episode_id || '|' || seq AS window_id FROM n WHERE speaker = 'assistant')"""


@query(
    f"""WITH RECURSIVE {_AROUND}, win AS (SELECT window_id, least(a.r - 1, 3) AS anchor, list(b.seq ORDER BY b.seq) AS seqs, list(length('[' || {CLOCK.format(x='b."start"')} || '-' || {CLOCK.format(x='b."end"')} || '] ' || b.speaker || ': ' || b.text) ORDER BY b.seq) AS sizes
      FROM a JOIN n b ON a.episode_id = b.episode_id AND b.r BETWEEN a.r - 3 AND a.r + 3 GROUP BY window_id, a.r),
    c AS (SELECT *, 0::BIGINT AS lo, len(seqs)::BIGINT AS hi FROM win
      UNION ALL SELECT window_id, anchor, seqs, sizes, lo + (anchor - lo >= hi - anchor - 1)::INT, hi - (anchor - lo < hi - anchor - 1)::INT FROM c WHERE hi - lo > 1 AND greatest(1, (list_sum(sizes[lo + 1 : hi]) + hi - lo - 1) // 4) > 300)
    SELECT window_id, arg_min(anchor - lo, hi - lo)::INTEGER AS anchor_index, arg_min(seqs[lo + 1 : hi], hi - lo) AS seqs FROM c GROUP BY window_id"""
)
def q_shrunk_windows(spark, sf_dir):
    w = S.shrink_windows(S.anchor_windows(segments(spark, sf_dir), ["assistant"], 3), 300)
    return w.select("window_id", "anchor_index", F.transform("segments", lambda s: s["seq"]).alias("seqs"))


@query(
    f"""WITH RECURSIVE {_AROUND}, b AS (SELECT window_id, a.r - b.r AS k, b.speaker, trim(b.text) AS t FROM a JOIN n b ON a.episode_id = b.episode_id AND b.r BETWEEN a.r - 4 AND a.r - 1),
    f AS (SELECT window_id, 0::BIGINT AS k, false AS done, NULL::VARCHAR AS who, []::VARCHAR[] AS texts FROM a
      UNION ALL SELECT window_id, k, done OR (NOT passed AND CASE WHEN own THEN len(texts) > 0 ELSE other END) OR (take AND len(list_filter(regexp_split_to_array(array_to_string(list_prepend(t, texts), ' '), '\\s+'), lambda w: w <> '')) >= 60),
        CASE WHEN take THEN coalesce(who, speaker) ELSE who END, CASE WHEN take THEN list_prepend(t, texts) ELSE texts END
      FROM (SELECT *, NOT passed AND NOT own AND NOT other AS take FROM (SELECT f.window_id, b.k, f.done, f.who, f.texts, b.speaker, b.t, f.done OR b.t = '' AS passed, b.speaker = 'assistant' AS own, coalesce(b.speaker <> f.who, false) AS other FROM f JOIN b ON b.window_id = f.window_id AND b.k = f.k + 1))),
    l AS (SELECT window_id, arg_max(who, k) AS who, arg_max(texts, k) AS texts FROM f GROUP BY window_id)
    SELECT window_id, CASE WHEN len(texts) > 0 THEN who END AS context_speaker, CASE WHEN len(texts) > 0 THEN md5(array_to_string(texts, ' ')) END AS context FROM l"""
)
def q_question_context(spark, sf_dir):
    return S.question_context(S.anchor_windows(segments(spark, sf_dir), ["assistant"], 4)).select("window_id", "context_speaker", F.md5("context").alias("context"))


_CUT = lambda x: f"list_filter(list_transform(string_split(regexp_replace(trim({x}), '([.!?…])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda y: trim(y)), lambda y: y <> '')"


@query(
    f"""WITH {_AROUND}, m AS (SELECT * REPLACE (CASE WHEN (episode_id + seq) % 5 = 1 THEN 'So let me ask: ' ELSE '' END || CASE WHEN (episode_id + seq) % 3 = 0 THEN regexp_replace(text, '\\.\\s', '? ', 'g') ELSE text END AS text) FROM n),
    b AS (SELECT window_id, m.text, row_number() OVER (PARTITION BY window_id ORDER BY m.r DESC) AS t FROM a JOIN m ON a.episode_id = m.episode_id AND m.r BETWEEN a.r - 4 AND a.r - 1 WHERE m.speaker <> 'assistant' AND trim(m.text) <> ''),
    s AS (SELECT window_id, t, {_CUT('b.text')} AS parts, CASE WHEN instr(lower(b.text), 'let me ask') > 0 THEN {_CUT("regexp_replace(substr(b.text, instr(lower(b.text), 'let me ask') + 10), '^[ :,-]+|[ :,-]+$', '', 'g')")} ELSE [] END AS tails FROM (SELECT window_id, t, text FROM b WHERE t <= 3) b),
    p AS (SELECT window_id, t, i, parts[i] AS x FROM (SELECT window_id, t, parts, unnest(range(1, len(parts) + 1)) AS i FROM s)), q AS (SELECT window_id, t, i, tails[i] AS x FROM (SELECT window_id, t, tails, unnest(range(1, len(tails) + 1)) AS i FROM s)),
    c AS (SELECT window_id, 1 AS pass, t, i, x FROM p WHERE contains(x, '?') UNION ALL SELECT window_id, 2, t, i, x FROM p WHERE regexp_matches(x, '(?i)^\\s*({'|'.join(S.INTERROGATIVES)})([^\\p{{L}}\\p{{N}}_]|$)') UNION ALL SELECT window_id, 3, t, i, x FROM q),
    d AS (SELECT window_id, pass, t, i, CASE WHEN x LIKE '%?' THEN x ELSE x || '?' END AS x FROM c), e AS (SELECT window_id, arg_min(x, (pass, t, i)) AS x FROM d WHERE len(regexp_extract_all(x, '[\\p{{L}}\\p{{N}}_]([\\p{{L}}\\p{{N}}_''-]*[\\p{{L}}\\p{{N}}_])?')) <= 25 GROUP BY window_id)
    SELECT a.window_id, e.x AS local_question FROM a LEFT JOIN e ON a.window_id = e.window_id"""
)
def q_mined_question(spark, sf_dir):
    k = F.col("episode_id") + F.col("seq")
    asked = F.when(k % 3 == 0, F.regexp_replace("text", r"\.\s", "? ")).otherwise(F.col("text"))
    rows = segments(spark, sf_dir).withColumn("text", F.concat(F.when(k % 5 == 1, "So let me ask: ").otherwise(""), asked))
    return S.mine_question(S.anchor_windows(rows, ["assistant"], 4)).select("window_id", "local_question")


@query(
    f"""WITH RECURSIVE {SEGMENTS_SQL}, r AS (SELECT episode_id, seq, text, CASE WHEN seq % 3 = 0 THEN 'user' ELSE speaker END AS who, length(text) // 4 AS t, row_number() OVER (PARTITION BY episode_id ORDER BY seq) AS k FROM seg),
    f AS (SELECT *, 1 AS island, t AS total FROM r WHERE k = 1
      UNION ALL SELECT r.*, f.island + CASE WHEN r.who = f.who AND f.total + r.t < 300 THEN 0 ELSE 1 END, CASE WHEN r.who = f.who AND f.total + r.t < 300 THEN f.total + r.t ELSE r.t END FROM f JOIN r ON r.episode_id = f.episode_id AND r.k = f.k + 1)
    SELECT episode_id, min(seq) AS seq, arg_min(who, seq) AS speaker, (length(string_agg(text, chr(10) ORDER BY seq)) // 4)::INTEGER AS token_count FROM f GROUP BY episode_id, island"""
)
def q_merged_chunks(spark, sf_dir):
    rows = segments(spark, sf_dir).withColumn("speaker", F.when(F.col("seq") % 3 == 0, "user").otherwise(F.col("speaker"))).withColumn("token_count", T.count_tokens(F.col("text")))
    return S.merge_small_chunks(rows, 300).select("episode_id", "seq", "speaker", "token_count")


@query(
    """WITH e AS (SELECT user_id, epoch_us(ts) AS us FROM events), g AS (SELECT *, us - lag(us) OVER (PARTITION BY user_id ORDER BY us) AS gap FROM e),
    i AS (SELECT *, sum(CASE WHEN gap < 3600000000 THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS island FROM g)
    SELECT user_id, min(us) AS start_us, max(us) + 3600000000 AS end_us, count(*) AS n FROM i GROUP BY user_id, island"""
)
def q_sessions(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    return W.sessions(e, "user_id", "ts").select("user_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "n")
