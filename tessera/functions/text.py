"""Scalar text functions as Spark expressions: normalisers, tokens, sentences, questions, hashes.

All take and return Columns and stay inside Catalyst. A null text behaves as an empty one unless stated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: First words of a question, words that a question may add freely, and words that no context to rephrase begins with.
QUESTION_STARTERS = "who what when where why how is are was were do does did can could should would will may might shall have has had".split()
ALLOWED_EXTRAS = (
    "a about all and any are be can could do does did for from had has have how i if in is it let lets may might of on should"
    " shall that the their them these they this those to us was we were what when where which who why will with would you your"
).split()
BLOCKED_PREFIXES = "who what when where why how which do does did can will should".split()
NEW_WORDS, MOST_WORDS = 4, 25
#: ASCII punctuation; and quotes and dashes with their ASCII forms.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
FANCY, ASCII = "\u2018\u2019\u201c\u201d\u2010\u2011\u2012\u2013\u2014", "''\"\"-----"
#: Keywords of the prompt domains, in order of precedence.
DOMAINS = {
    "educational": ("math", "calculus", "algebra", "geometry", "equation"),
    "technical": ("programming", "code", "software", "python", "algorithm"),
    "conversational": ("chat", "conversation", "talk", "friendly", "assistant"),
}


#: Fixed value: white space, as it is stripped off the ends.
WHITE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def given(x: Column) -> Column:
    return F.coalesce(x, F.lit(""))


def strip(x: Column) -> Column:
    """White space off both ends."""
    return F.btrim(given(x), F.lit(WHITE))


def collapse(x: Column) -> Column:
    """Runs of white space to one space, none at the ends."""
    return strip(F.regexp_replace(given(x), r"\s+", " "))


def squeeze(x: Column) -> Column:
    """Runs of white space to one space, ends kept."""
    return F.regexp_replace(given(x), r"\s+", " ")


def loose_norm(x: Column) -> Column:
    """Lower case, ASCII punctuation deleted, white space collapsed."""
    return collapse(F.translate(F.lower(given(x)), PUNCTUATION, ""))


def quote_norm(x: Column) -> Column:
    """Fancy quotes and dashes to ASCII, white space collapsed, lower case."""
    return F.lower(collapse(F.translate(given(x), FANCY, ASCII)))


def provenance_norm(x: Column) -> Column:
    """Lower case, ASCII quotes, ellipsis as three dots, arrow as two characters, white space collapsed."""
    plain = F.translate(F.lower(given(x)), "“”‘’", "\"\"''")
    return collapse(F.replace(F.replace(plain, F.lit("…"), F.lit("...")), F.lit("→"), F.lit("->")))


def word_norm(x: Column) -> Column:
    """Everything but letters, digits, underscores and white space deleted, white space collapsed, lower case."""
    return F.lower(collapse(F.regexp_replace(given(x), r"(?U)[^\w\s]", "")))


def fingerprint(question: Column, answer: Column) -> Column:
    """MD5 of the first 200 characters of the normalised pair."""
    return F.md5(F.substring(word_norm(F.concat(given(question), F.lit("|"), given(answer))), 1, 200))


def word_set(x: Column) -> Column:
    """Distinct lower-case words of letters, digits and apostrophes, the apostrophes removed."""
    found = F.regexp_extract_all(F.lower(given(x)), F.lit("[A-Za-z0-9']+"), F.lit(0))
    return F.array_distinct(F.filter(F.transform(found, lambda w: F.translate(w, "'", "")), lambda w: w != ""))


def count_words(x: Column) -> Column:
    """Words between white space."""
    return F.size(F.filter(F.split(given(x), r"\s+"), lambda w: w != ""))


def count_tokens(x: Column, least: int = 0) -> Column:
    """A quarter of the characters, ``least`` at least: the estimate where no tokenizer is given."""
    return F.greatest(F.lit(least), F.floor(F.length(given(x)) / 4).cast("int"))


def sentences(x: Column, ellipsis: bool = False) -> Column:
    """Pieces that end with a full stop, exclamation or question mark (or ellipsis) before white space; blank ones left out."""
    marks = "[.!?…]" if ellipsis else "[.!?]"
    return F.filter(F.transform(F.split(strip(x), rf"(?<={marks})\s+"), strip), lambda s: s != "")


def format_time(seconds: Column) -> Column:
    """MM:SS, minutes unbounded; ?:?? if there is no time or a negative one."""
    bad = seconds.isNull() | F.isnan(seconds) | (seconds < 0)
    whole = F.floor(seconds).cast("long")
    return F.when(bad, "?:??").otherwise(F.format_string("%02d:%02d", F.floor(whole / 60), whole % 60))


def format_segment(start: Column, end: Column, speaker: Column, text: Column) -> Column:
    return F.concat(F.lit("["), format_time(start), F.lit("–"), format_time(end), F.lit("] "), given(speaker), F.lit(": "), given(text))


def hash_int(seed: Column) -> Column:
    """The first 8 bytes of the seed's SHA-256 as an unsigned integer."""
    return F.conv(F.substring(F.sha2(seed, 256), 1, 16), 16, 10).cast("decimal(20,0)")


def hash_mod(seed: Column, n: int) -> Column:
    return (hash_int(seed) % n).cast("int")


def ends_as_question(x: Column) -> Column:
    """The text with a question mark at its end."""
    s = strip(x)
    return F.when(F.endswith(s, F.lit("?")), s).otherwise(F.concat(s, F.lit("?")))


def is_question(x: Column) -> Column:
    """Ends with a question mark or begins with a word that opens questions."""
    s = strip(x)
    first = F.translate(F.regexp_extract(F.lower(s), "[a-z0-9']+", 0), "'", "")
    return (s != "") & (F.endswith(s, F.lit("?")) | first.isin(QUESTION_STARTERS))


def new_words(question: Column, known: Column) -> Column:
    """Words of the question that are no number, not known, no free word, nor either without its last s."""
    pool = F.array_union(word_set(known), F.array(*[F.lit(w) for w in ALLOWED_EXTRAS]))
    words = F.filter(word_set(question), lambda w: ~w.rlike("^[0-9]+$"))
    return bound(pool, lambda p: F.filter(F.array_except(words, p), lambda w: ~F.array_contains(p, F.rtrim(w, F.lit("s")))))


def valid_question(question: Column, context: Column, answer: Column) -> Column:
    """Ends with a question mark, 25 words at most, and at most four new words (not tested without a context)."""
    s = strip(question)
    short = count_words(F.substring(s, F.lit(1), F.length(s) - 1)) <= MOST_WORDS
    known = F.concat(given(context), F.lit(" "), given(answer))
    return (s != "") & F.endswith(s, F.lit("?")) & short & (context.isNull() | (F.size(new_words(s, known)) <= NEW_WORDS))


def may_rephrase(x: Column) -> Column:
    """Whether a context may be sent to be rephrased: 8 to 220 characters, no question mark, no interrogative first."""
    s = strip(x)
    bare = F.lower(F.regexp_replace(s, "^[ \"'“”‘’¿¡(\\[{-]+", ""))
    blocked = bare.rlike("^(" + "|".join(BLOCKED_PREFIXES) + ")( |$)")
    return (s != "") & ~F.contains(s, F.lit("?")) & F.length(s).between(8, 220) & ~blocked


def domain(x: Column) -> Column:
    """The first domain of which the text has a keyword, else general."""
    out, low = F.lit("general"), F.lower(given(x))
    for name, keys in reversed(list(DOMAINS.items())):
        out = F.when(low.rlike("|".join(keys)), name).otherwise(out)
    return out


def cache_key(episode: Column, index: Column, context: Column) -> Column:
    return F.struct(episode.alias("episode_id"), index.alias("window_index"), F.substring(F.sha2(given(context), 256), 1, 16).alias("digest"))


def json_payload(x: Column) -> Column:
    """What a fenced block holds, or the whole text."""
    s = strip(x)
    inner = F.regexp_extract(s, r"(?s)```(?:json)?\s*(.*?)\s*```", 1)
    return F.when(s.rlike(r"(?s)```(?:json)?\s*.*?\s*```"), strip(inner)).otherwise(strip(F.regexp_replace(s, r"(?s)^```[^\n]*\n|\n?```$", "")))


def speaker_of(x: Column) -> Column:
    """The speaker that a line names: a word before a colon, in square brackets, or before a dash; else unknown."""
    s = strip(x)
    tries = [(F.when(s.rlike(p), strip(F.regexp_extract(s, p, 1)))) for p in (r"(?U)^(\w+):", r"^\[(.*?)\]", r"(?U)^(\w+)\s*-")]
    return F.coalesce(*tries, F.lit("unknown"))


def sigmoid(x: Column) -> Column:
    """The logistic function, between 0 and 1."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def to_number(x: Column, missing_as_nan: bool = True) -> Column:
    """A double; what is none is NaN, or null."""
    out = x.cast("string").try_cast("double")
    return F.coalesce(out, F.lit(float("nan"))) if missing_as_nan else out


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), the value computed once a row, however often and in whatever lambda it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def blank(x: Column) -> Column:
    return strip(x) == ""
