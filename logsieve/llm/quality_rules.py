"""Line-first quality rules, in SQL expressions only.

Every line of a text is judged on its own: navigation (separators between its words), boilerplate
(stock phrases in a short line), symbols, shouting, and prose without any punctuation. Lines that fail,
and lines equal to an earlier one, are taken out; a document that loses more than half of its characters
is rejected. Notices of a licence or of rights are taken out like other boilerplate, but say nothing against the text
beside them, so they do not count as lost. Documents also fail the base rules if they have fewer than ten words or if over a fifth of
their words lie in five-word windows that the text holds twice.

All of it works inside the row: no shuffle, and memory in proportion to one text. Windows are compared by
64-bit hashes. What lambdas refer to repeatedly is computed once per row (see ``with_once``).

Defined results: a null or empty text has no words and is rejected; a text without failing or repeated
lines stays as it is, to the last blank; repeated rows give repeated results; columns named like an added
one are replaced; an empty table gives no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsieve.functions.once import with_once
from logsieve.llm.base import columns, quoted, without

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
REPEAT_PERCENT = 20
# A document may lose at most this share of its characters (but white space), in percent.
LOSS_PERCENT = 50

# Words that only separate others.
SEPARATORS = ["|", "»", "«", ">", ">>", "/", "•", "·", "::", "–", "—"]
# A line is navigation if this share of its words, in percent, separate others.
NAVIGATION_PERCENT = 25
# A line fails if this share of its characters, in percent, are symbols.
SYMBOL_PERCENT = 12
# Stock phrases, in lower case; a line of at most BOILERPLATE_WORDS words that holds one fails.
NOTICES = ["all rights reserved", "licensed under the"]
BOILERPLATE = [
    *NOTICES,
    "accept cookies",
    "click here",
    "cookie policy",
    "enable javascript",
    "log in to",
    "privacy policy",
    "read more",
    "share this",
    "sign up for",
    "subscribe to",
    "terms of service",
    "terms of use",
]
BOILERPLATE_WORDS = 30
# A line of at least so many words without any of these marks is no prose.
PROSE_WORDS = 12
MARKS = ".,;:!?…。，、"
# Shouted lines have at least so many words.
SHOUT_WORDS = 3


SPACE_PATTERN = r"[ \t\n\x0b\f\r]+"
SYMBOL_PATTERN = "[" + SYMBOLS.replace("&", r"\&").replace("|", r"\|") + "]"
# A document fails if this share of its words, in percent, equal the word before.
STUTTER_PERCENT = 30


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE_PATTERN), "")


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACES)) != ""


def line_parts(line: Column) -> Column:
    """What the rules ask of a line, each computed once."""
    return F.struct(
        line.alias("line"),
        words(line).alias("words"),
        F.regexp_count(line, F.lit(SYMBOL_PATTERN)).alias("symbols"),
    )


def is_notice(part: Column) -> Column:
    return (F.size(part["words"]) <= BOILERPLATE_WORDS) & part["line"].rlike("(?i)" + "|".join(NOTICES))


def line_fails(part: Column) -> Column:
    line, n = part["line"], F.size(part["words"])
    navigation = F.size(F.filter(part["words"], lambda w: w.isin(SEPARATORS))) * 100 >= n * NAVIGATION_PERCENT
    phrase = line.rlike("(?i)" + "|".join(BOILERPLATE))
    shouting = ~line.rlike(r"\p{Ll}") & line.rlike(r"\p{Lu}")
    return (
        (part["symbols"] * 100 >= F.length(line) * SYMBOL_PERCENT)
        | ((n >= 3) & navigation)
        | ((n <= BOILERPLATE_WORDS) & phrase)
        | ((n >= SHOUT_WORDS) & shouting)
        | ((n >= PROSE_WORDS) & ~line.rlike(f"[{MARKS}]"))
    )


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_failed_lines, clean_text and kept."""
    added = [
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "n_failed_lines",
        "clean_text",
        "kept",
    ]
    kept = without(docs, added)
    whole = F.coalesce(F.col(quoted(text)), F.lit(""))
    df = docs.select(F.struct(*columns(docs, kept)).alias("row"), whole.alias("text"))
    lines = F.filter(F.split(F.col("text"), "\n"), has_word)
    df = with_once(df, "parts", F.transform(lines, line_parts))
    df = with_once(df, "good", F.filter("parts", lambda p: ~line_fails(p)))
    df = with_once(df, "clean", F.array_distinct(F.col("good.line")))
    df = with_once(df, "words", F.flatten("parts.words"))
    as_it_was = F.size("clean") == F.size("parts")
    notices = F.aggregate(
        F.filter("parts", is_notice), F.lit(0).cast("long"), lambda total, p: total + F.length(F.array_join(p["words"], ""))
    )
    df = df.select(
        "row",
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda total, p: total + p["symbols"]).alias("n_symbols"),
        (F.size("parts") - F.size(F.array_distinct(F.col("parts.line")))).cast("long").alias("n_dup_lines"),
        (F.size("parts") - F.size("good")).cast("long").alias("n_failed_lines"),
        F.when(as_it_was, F.col("text")).otherwise(F.array_join("clean", "\n")).alias("clean_text"),
        F.when(as_it_was, F.lit(0)).alias("lost"),
        notices.alias("notices"),
        "words",
    )
    df = with_once(df, "hashes", F.transform("words", lambda w: F.xxhash64(w)))
    stutter = F.size(F.filter("hashes", lambda h, i: h.eqNullSafe(F.get("hashes", i - 1))))
    df = df.drop("words").withColumns({"n_words": F.size("hashes").cast("long"), "stutter": stutter})
    df = with_once(df, "windows", _windows())
    df = with_once(df.drop("hashes"), "sorted", _in_order())
    df = with_once(df.drop("windows"), "starts", _repeated())
    df = df.drop("sorted").withColumn("n_repeat_words", _covered()).drop("starts")
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * REPEAT_PERCENT)
    solid = F.length(F.regexp_replace("clean_text", SPACE_PATTERN, ""))
    lost = F.coalesce("lost", F.col("word_chars") - solid - F.col("notices"))
    df = df.withColumn("base_failed", failed).withColumn(
        "kept",
        ~F.col("base_failed")
        & (lost * 100 <= F.col("word_chars") * LOSS_PERCENT)
        & (F.col("stutter") * 100 <= F.col("n_words") * STUTTER_PERCENT),
    )
    return df.select(*(F.col("row")[c].alias(c) for c in kept), *added)


def _windows() -> Column:
    """A hash of each five words in a row, from the words' hashes."""
    n = F.size("hashes")
    at = lambda i, k: F.get("hashes", i + k)
    starts = F.slice("hashes", F.lit(1), F.greatest(n - (WINDOW - 1), F.lit(0)))
    return F.transform(starts, lambda h, i: F.xxhash64(h, *(at(i, k) for k in range(1, WINDOW))))


def _in_order() -> Column:
    """Hashes and places in order, for texts that repeat a window; else nothing."""
    pairs = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    return F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.array_sort(pairs)).otherwise(
        F.slice(pairs, 1, 0)
    )


def _repeated() -> Column:
    """Places of windows that are found twice or more."""
    near = lambda k, d: F.coalesce(F.get("sorted", k + d)["h"], F.lit(None))
    again = F.filter("sorted", lambda e, k: e["h"].eqNullSafe(near(k, -1)) | e["h"].eqNullSafe(near(k, 1)))
    return F.array_sort(F.transform(again, lambda e: e["i"]))


def _covered() -> Column:
    """How many words the windows at these places cover."""
    step = F.transform(
        "starts", lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get("starts", k + 1) - i, F.lit(WINDOW)))
    )
    return F.aggregate(step, F.lit(0).cast("long"), lambda total, n: total + n)
