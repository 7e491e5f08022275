"""Audits over aligned training and sidecar records: the five checks, gating metrics, go or no-go, speakers, strict file checks.

Sidecar frames have the columns pair_id, episode_id, question, answer, answer_speaker, source_spans_text, fit_score_ce and gates
(struct); a column that is absent counts as null. Every verdict is a row or a column, so an audit is one or two aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import quality as Q
from tessera.sources.shared import discard, materialise

CHECKS = ("groundedness", "format", "speaker", "fit_score", "duplication")
MOST_WORDS, MOST_CHARS = 50, 2000
GROUNDED, PAIR_FIT = 0.9, 0.5
#: What failing checks say.
UNGROUNDED, UNFIT = "Answer not found in source spans", "Fit score does not agree with the gate"
NO_MARK, LONG_QUESTION, NO_ANSWER, LONG_ANSWER = "Question does not end with '?'", "Question too long: ", "Empty answer", "Answer too long: "
BAD_SPEAKER, SAME, NEAR = "Invalid speaker: ", "Exact duplicate found at index ", "Near-duplicate found at index "


def said(ok: Column, reason: Column | str) -> Column:
    """The reason of a check that fails; null where it passes."""
    return F.when(~F.coalesce(ok, F.lit(False)), reason if isinstance(reason, Column) else F.lit(reason))


def grounded(answer: Column, spans: Column, least: float = GROUNDED) -> Column:
    """The normalised answer stands in the normalised spans, or the two are alike; similarity is computed where lengths allow it."""
    a, s = T.word_norm(F.lower(answer)), T.word_norm(spans)
    near = F.when(~F.contains(s, a) & (2 * F.least(F.length(a), F.length(s)) >= least * (F.length(a) + F.length(s))), F.lit(True))
    alike = F.when(near, Q.ratio(F.when(near, a), F.when(near, s)) >= least).otherwise(False)
    return (T.given(answer) != "") & (T.given(spans) != "") & (F.contains(s, a) | alike)


def format_reason(question: Column, answer: Column) -> Column:
    q, a = T.given(question), T.given(answer)
    words = T.count_words(q)
    return (
        F.when(~F.endswith(q, F.lit("?")), NO_MARK)
        .when(words > MOST_WORDS, F.concat(F.lit(LONG_QUESTION), words.cast("string"), F.lit(" words")))
        .when(a == "", NO_ANSWER)
        .when(F.length(a) > MOST_CHARS, F.concat(F.lit(LONG_ANSWER), F.length(a).cast("string"), F.lit(" characters")))
    )


def fit_consistent(passed: Column, score: Column) -> Column:
    """Not tested without a score or a verdict; else the score is in range and says what the verdict says."""
    return passed.isNull() | score.isNull() | (~F.isnan(score) & score.between(0.0, 1.0) & (passed == (score >= PAIR_FIT)))


def first_duplicates(rows: DataFrame, sampled: DataFrame, index: str = "record_index", least: float = 0.95) -> DataFrame:
    """(index, duplicate_of, exact): for each sampled row the first other row with the same fingerprint or an alike answer.

    rows: index, question, answer. Equal fingerprints meet in a join of counted groups, alike answers in first_alike().
    """
    own = materialise(rows.filter(T.given(F.col("answer")) != "").select(F.col(index).alias("i"), T.fingerprint(F.col("question"), F.col("answer")).alias("f")), "fingerprints")
    groups = own.groupBy("f").agg(F.min("i").alias("first"), F.count("*").alias("n")).filter("n > 1")
    second = own.join(groups, "f").filter("i > first").groupBy("f").agg(F.min("i").alias("second"))
    groups = groups.join(second, "f")
    picked = sampled.select(F.col(index).alias("i"))
    exact = own.join(picked, "i", "left_semi").join(groups, "f").select("i", F.when(F.col("i") == F.col("first"), F.col("second")).otherwise(F.col("first")).alias("j"), F.lit(True).alias("exact"))
    alike = Q.first_alike(rows.select(F.col(index).alias("i"), "answer"), "i", "answer", sampled.select(F.col(index).alias("i"), "answer"), least)
    hits = exact.union(alike.select(F.col("key_a").alias("i"), F.col("key_b").alias("j"), F.lit(False).alias("exact")))
    found = hits.groupBy("i").agg(F.min(F.struct("j", (~F.col("exact")).alias("fuzzy"))).alias("x"))
    out = materialise(found.select(F.col("i").alias(index), F.col("x.j").alias("duplicate_of"), (~F.col("x.fuzzy")).alias("exact")), "duplicates")
    discard(own)
    discard(alike)
    return out


def audit_rows(rows: DataFrame, sampled: DataFrame, speakers: list[str], index: str = "record_index") -> DataFrame:
    """The sampled rows with a reason column a check (null: passed), ``reasons`` and ``passed``."""
    dup = first_duplicates(rows, sampled, index)
    out = sampled.join(dup, index, "left")
    gates = F.col("gates.pairfit_passed")
    score = F.col("fit_score_ce").cast("double")
    reasons = {
        "groundedness": said(grounded(F.col("answer"), F.col("source_spans_text")), UNGROUNDED),
        "format": format_reason(F.col("question"), F.col("answer")),
        "speaker": said(F.lower(T.given(F.col("answer_speaker"))).isin([s.lower() for s in speakers]), F.concat(F.lit(BAD_SPEAKER), F.lower(T.given(F.col("answer_speaker"))))),
        "fit_score": said(fit_consistent(gates, score), UNFIT),
        "duplication": F.when(F.col("duplicate_of").isNotNull(), F.concat(F.when(F.col("exact"), SAME).otherwise(NEAR), F.col("duplicate_of").cast("string"))),
    }
    out = out.withColumns(reasons)
    listed = F.filter(F.array(*[F.concat(F.lit(f"{c}: "), F.col(c)) for c in CHECKS]), lambda x: x.isNotNull())
    return out.withColumn("reasons", listed).withColumn("passed", F.size("reasons") == 0).drop("duplicate_of", "exact")


def audit_rates(audited: DataFrame) -> DataFrame:
    """(check, passed, total, rate) of the five checks and of all together."""
    return Q.roll_up(audited, {**{c: F.col(c).isNull() for c in CHECKS}, "overall": F.col("passed")})


def save_audit(audited: DataFrame, path: str, index: str = "record_index") -> None:
    """The rates as JSON under path/report, the failing rows as CSV with a header under path/failures."""
    cols = [index, *[c for c in ("is_train", "pair_id", "episode_id", "answer_speaker", "question") if c in audited.columns]]
    kept = materialise(audited.select(*cols, *[c for c in CHECKS if c not in cols], "reasons", "passed"), "audit")
    audit_rates(kept).coalesce(1).write.mode("overwrite").json(f"{path}/report")
    failed = kept.filter("not passed").select(*cols, F.array_join("reasons", "; ").alias("failure_reasons"))
    failed.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{path}/failures")
    discard(kept)


def union_by_offset(train: DataFrame, val: DataFrame, index: str = "record_index") -> DataFrame:
    """Validation rows after the training rows: their index goes on where the training file's ends; ``is_train`` tells which."""
    n = train.agg(F.coalesce(F.max(index) + 1, F.lit(0))).first()[0]
    after = val.withColumn(index, F.col(index) + F.lit(n))
    return train.withColumn("is_train", F.lit(True)).unionByName(after.withColumn("is_train", F.lit(False)))


def lookup(union: DataFrame, wanted: DataFrame, index: str = "record_index") -> DataFrame:
    """The rows of union_by_offset() at the wanted indices."""
    return union.join(wanted.select(index), index)


def gating_metrics(sidecars: DataFrame) -> DataFrame:
    """(total, scored, least, greatest, average) of the fit scores in one pass; 1 and 0 as bounds where none is there."""
    s = F.col("fit_score_ce").cast("double")
    return sidecars.agg(F.count("*").alias("total"), F.count(s).alias("scored"), F.coalesce(F.min(s), F.lit(1.0)).alias("least"), F.coalesce(F.max(s), F.lit(0.0)).alias("greatest"), F.avg(s).alias("average"))


def score_statistics(scores: DataFrame, col: str) -> DataFrame:
    """(least, average, greatest) of a batch of scores."""
    return scores.agg(F.min(col).alias("least"), F.avg(col).alias("average"), F.max(col).alias("greatest"))


def reasons(dropped: DataFrame, col: str = "drop_reason") -> DataFrame:
    """(reason, n) of rows that were dropped."""
    return dropped.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("reason")).agg(F.count("*").alias("n"))


def speaker_audit(sidecars: DataFrame, allowed: list[str], most: int = 10, file: str = "source_path", line: str = "line") -> tuple[DataFrame, DataFrame]:
    """(speaker, n, allowed), names compared as they are, and the first ``most`` rows of other names as file:line: name."""
    name = T.given(F.col("answer_speaker"))
    counts = sidecars.groupBy(name.alias("speaker")).agg(F.count("*").alias("n")).withColumn("allowed", F.col("speaker").isin(allowed))
    bad = sidecars.filter(~name.isin(allowed)).orderBy(file, line).limit(most)
    return counts, bad.select(F.concat(F.col(file), F.lit(":"), F.col(line).cast("string"), F.lit(": "), name).alias("invalid"))


def leakage_report(train: DataFrame, val: DataFrame, key: str = "pair_id", most: int = 10) -> DataFrame:
    """(train_count, val_count, overlap_count, overlap) of distinct keys; the first ``most`` of those on both sides."""
    side = lambda d, s: d.filter(T.given(F.col(key)) != "").select(F.col(key).alias("k"), F.lit(s).alias("s"))
    by = side(train, 1).union(side(val, 2)).groupBy("k").agg(F.bit_or("s").alias("s"))
    n = by.agg(F.count_if(F.col("s") != 2).alias("train_count"), F.count_if(F.col("s") != 1).alias("val_count"), F.count_if(F.col("s") == 3).alias("overlap_count"))
    first = [r.k for r in by.filter("s = 3").select("k").orderBy("k").limit(most).collect()]
    kind = train.schema[key].dataType.simpleString()
    return n.withColumn("overlap", F.array(*map(F.lit, first)).cast(f"array<{kind}>"))


def go(train: DataFrame, val: DataFrame, allowed: list[str], least: float = 0.95) -> DataFrame:
    """(check, passed) of a release: rates of the speaker gate and of filled scores on both sides, no other speakers, no leakage."""
    both = train.withColumn("_t", F.lit(True)).unionByName(val.withColumn("_t", F.lit(False)), allowMissingColumns=True)
    gate, score = F.coalesce(F.col("gates.speaker_check_passed"), F.lit(False)), F.col("fit_score_ce").isNotNull()
    n = lambda side, ok: F.count_if(ok & (F.col("_t") == side)) / F.greatest(F.count_if(F.col("_t") == side), F.lit(1))
    row = both.agg(
        ((n(True, gate) >= least) & (n(False, gate) >= least)).alias("speaker_rate"), ((n(True, score) >= least) & (n(False, score) >= least)).alias("score_rate"),
        (F.count_if(~T.given(F.col("answer_speaker")).isin(allowed)) == 0).alias("speakers"),
    )
    row = row.withColumn("no_leakage", F.lit(leakage_report(train, val).first().overlap_count == 0))
    row = row.withColumn("go", F.col("speaker_rate") & F.col("score_rate") & F.col("speakers") & F.col("no_leakage"))
    return row.selectExpr("stack(5, 'speaker_rate', speaker_rate, 'score_rate', score_rate, 'speakers', speakers, 'no_leakage', no_leakage, 'go', go) AS (check, passed)")


def file_checks(training: DataFrame, sidecar: DataFrame, allowed: list[str], index: str = "record_index") -> DataFrame:
    """(check, passed, bad): strict checks of a pair of files read by ``files.jsonl`` with an index column.

    not_empty: both hold rows; json: every line parses; structure: records have their fields; aligned: every index stands on both
    sides with the same question; speakers: only allowed ones. bad counts the rows that fail (1 where the file itself does).
    """
    from tessera.operators.formats import field, has

    t, s = training.select(F.col(index).alias("i"), F.col("value").alias("t"), F.col("valid").alias("tv")), sidecar.select(F.col(index).alias("i"), F.col("value").alias("s"), F.col("valid").alias("sv"))
    both = t.join(s, "i", "full")
    question = F.get(F.filter(F.from_json(field(F.col("t"), "messages"), "array<struct<role:string,content:string>>"), lambda m: m["role"] == "user"), 0)["content"]
    off = lambda c: F.count_if(F.coalesce(c, F.lit(True)))
    row = both.agg(
        (F.when(F.count("t") == 0, 1).otherwise(0) + F.when(F.count("s") == 0, 1).otherwise(0)).cast("long").alias("not_empty"),
        F.count_if((F.col("tv") == False) | (F.col("sv") == False)).alias("json"),  # noqa: E712
        off((F.col("t").isNotNull() & ~has(F.col("t"), "messages")) | (F.col("s").isNotNull() & ~has(F.col("s"), "pair_id", "question", "answer", "answer_speaker"))).alias("structure"),
        off(F.col("t").isNull() | F.col("s").isNull() | ~question.eqNullSafe(field(F.col("s"), "question"))).alias("aligned"),
        F.count_if(F.col("s").isNotNull() & ~F.coalesce(F.lower(field(F.col("s"), "answer_speaker")).isin([x.lower() for x in allowed]), F.lit(False))).alias("speakers"),
    )
    names = ("not_empty", "json", "structure", "aligned", "speakers")
    return row.selectExpr(f"stack({len(names)}, {', '.join(f'{chr(39)}{n}{chr(39)}, {n}' for n in names)}) AS (check, bad)").select("check", (F.col("bad") == 0).alias("passed"), "bad")


def example_quality(samples: DataFrame, messages: str = "messages", least_chars: int = 10) -> Column:
    """Whether a conversation is fit to serve as an example: two messages at least, both sides, every content long enough."""
    ms = F.col(messages)
    return F.coalesce((F.size(ms) >= 2) & F.exists(ms, lambda m: m["role"] == "user") & F.exists(ms, lambda m: m["role"] == "assistant") & F.forall(ms, lambda m: F.length(T.given(m["content"])) >= least_chars), F.lit(False))


def good_examples(samples: DataFrame, threshold: float = 0.8, messages: str = "messages") -> tuple[DataFrame, DataFrame]:
    """The samples that are fit, and (total, kept, rate, enough): whether their share reaches the threshold."""
    fit = example_quality(samples, messages)
    row = samples.agg(F.count("*").alias("total"), F.count_if(fit).alias("kept"))
    rate = F.when(F.col("total") > 0, F.col("kept") / F.col("total")).otherwise(0.0)
    return samples.filter(fit), row.select("total", "kept", rate.alias("rate"), (rate >= threshold).alias("enough"))


def example_statistics(samples: DataFrame, messages: str = "messages") -> DataFrame:
    """(samples, tokens, per_sample): words of all contents, in all and on average."""
    words = F.aggregate(F.transform(F.col(messages), lambda m: T.count_words(m["content"])), F.lit(0), lambda a, b: a + b)
    return samples.agg(F.count("*").alias("samples"), F.coalesce(F.sum(words), F.lit(0)).alias("tokens")).withColumn("per_sample", F.when(F.col("samples") > 0, F.col("tokens") / F.col("samples")).otherwise(0.0))
