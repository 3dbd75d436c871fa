"""Line-first quality rules (DataFrame functions only, no shuffle).

Each line is judged alone, failing lines go, and a document that loses too
much of its text is rejected.  Everything is one projection over the scan:
a document's words and lines are arrays of its own row, so no key is shuffled
and no group of documents meets anywhere.

Defined results: a null text counts as empty (no words, ``base_failed``);
blank lines are neither kept nor lost; rows are independent, so repeated
rows, null ids and extra columns pass through unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the base metrics.
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"
SPACE = r"[\x09-\x0D ]+"
VISIBLE = r"[^\x09-\x0D ]"

#: A document is rejected when its failing lines hold more than this share of its visible characters.
MAX_LOST = 0.5
#: Lines of up to so many words may do without a sentence end (titles, list items).
TITLE_WORDS = 12
#: Most punctuation and symbols, as a share of the visible characters of a line.
MAX_PUNCTUATION = 0.2
#: Boilerplate phrases count only in lines of up to so many words.
BOILERPLATE_WORDS = 40

SENTENCE_END = r"[.!?\x{2026}\x{3002}\x{FF01}\x{FF1F}\x{061F}\x{0964}]"
PUNCTUATION = r"[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]"
SEPARATOR = r" (\||>|/|\x{00BB}|\x{203A}|\x{2022}|\x{00B7}) "
#: At least three separators with at most four words between two of them.
MIN_SEPARATORS = 3
WORDS_PER_SEPARATOR = 4
NAVIGATION = (
    r"^(home|menu|search|next|next page|previous|previous page|back to top|read more|skip to content|"
    r"share|print|log in|login|sign in|sign up|register)[ .!>\x{00BB}]*$"
)
BOILERPLATE = (
    r"all rights reserved|cookie policy|uses cookies|use of cookies|accept cookies|privacy policy|"
    r"terms of use|terms of service|terms and conditions|enable javascript|javascript is disabled|"
    r"lorem ipsum|subscribe to our|powered by wordpress|newsletter sign|click here to"
)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times; a plain alias may be inlined into each use."""
    return F.transform(F.array(value), body)[0]


def _paired(values: Column, step: int) -> Column:
    """hash(v[i], v[i + step]) for every i."""
    return let(
        values,
        lambda v: F.zip_with(
            F.slice(v, 1, F.size(v) - step),
            F.slice(v, F.lit(1 + step), F.size(v) - step),
            lambda a, b: F.xxhash64(a, b),
        ),
    )


def _covered(windows: Column) -> Column:
    """Words under the windows whose hash occurs twice or more in the array."""

    def of_sorted(s: Column) -> Column:
        same = F.zip_with(
            F.slice(s, 1, F.size(s) - 1), F.slice(s, 2, F.size(s) - 1), lambda a, b: a["h"] == b["h"]
        )
        flagged = let(
            same,
            lambda e: F.zip_with(
                F.concat(F.array(F.lit(False)), e), F.concat(e, F.array(F.lit(False))), lambda a, b: a | b
            ),
        )
        starts = F.filter(
            F.zip_with(s, flagged, lambda a, hit: F.when(hit, a["i"])), lambda i: i.isNotNull()
        )
        return F.aggregate(
            F.sort_array(starts),
            F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
            lambda acc, i: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW), i - acc["last"])).alias("n"), i.alias("last")
            ),
            lambda acc: acc["n"],
        )

    return let(
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), of_sorted
    )


def n_repeat_words(fours: Column) -> Column:
    """Words in windows of eight that are found twice or more, from the hashes of all runs of four.

    An eight-word window can only recur where a four-word run recurs, so most
    texts are done after one duplicate test.
    """
    repeated = let(
        _paired(fours, 4),
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_covered(w)),
    )
    unique = F.size(F.array_distinct(fours)) == F.size(fours)
    return F.when((F.size(fours) <= WINDOW - 3) | unique, F.lit(0)).otherwise(repeated)


def _count(text: Column, pattern: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def _spaces(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))


def failing_rule(line: Column) -> Column:
    """Name of the first rule that a line breaks, or null; a line has one word more than blanks."""

    def judge(m: Column) -> Column:
        size, words, separators = m["size"], m["spaces"] + 1, m["separators"]
        return (
            F.when(_count(line, PUNCTUATION) > MAX_PUNCTUATION * (size - m["spaces"]), F.lit("punctuation"))
            .when(
                (separators >= MIN_SEPARATORS) & (words - separators <= WORDS_PER_SEPARATOR * (separators + 1)),
                F.lit("navigation"),
            )
            .when((words <= 3) & F.lower(F.trim(line)).rlike(NAVIGATION), F.lit("navigation"))
            .when((words <= BOILERPLATE_WORDS) & F.lower(line).rlike(BOILERPLATE), F.lit("boilerplate"))
            .when((words > TITLE_WORDS) & ~line.rlike(SENTENCE_END), F.lit("punctuation"))
        )

    facts = F.struct(
        F.length(line).alias("size"),
        _spaces(line).alias("spaces"),
        F.regexp_count(line, F.lit(SEPARATOR)).alias("separators"),
    )
    return let(facts, judge)


def measure(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per document: base metrics, line verdicts, ``clean_text`` and ``kept``."""
    body = F.coalesce(F.col(text), F.lit(""))
    flat = body
    for code in range(0x09, 0x0E):
        flat = F.replace(flat, F.lit(chr(code)), F.lit(" "))
    flat = F.trim(F.regexp_replace(flat, "  +", " "))
    base = docs.select(F.col(id_col), body.alias("_t"), flat.alias("_flat"))
    words = F.transform(F.split("_flat", " ", -1), lambda w: F.xxhash64(w))
    words = F.when(F.col("_flat") != "", words).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("_t", "\n", -1), lambda s: s.rlike(VISIBLE))
    judged = F.transform(lines, lambda s: F.struct(s.alias("line"), failing_rule(s).alias("rule")))
    # Each step reads the one before more than once, so the optimizer keeps them apart.
    steps = base.select("*", words.alias("_h"), judged.alias("_j"))
    pairs = F.zip_with(
        F.slice("_h", 1, F.greatest(F.size("_h") - 1, F.lit(0))),
        F.slice("_h", 2, F.size("_h")),
        lambda a, b: F.xxhash64(a, b),
    )
    n_pairs = F.greatest(F.size("_2") - 2, F.lit(0))
    fours = F.zip_with(
        F.slice("_2", 1, n_pairs), F.slice("_2", F.lit(3), F.size("_2")), lambda a, b: F.xxhash64(a, b)
    )
    steps = steps.select("*", pairs.alias("_2")).select("*", fours.alias("_4"))
    failing = F.filter("_j", lambda r: r["rule"].isNotNull())
    good = F.transform(F.filter("_j", lambda r: r["rule"].isNull()), lambda r: r["line"])
    lost = F.aggregate(
        failing, F.lit(0), lambda n, r: n + F.length(r["line"]) - _spaces(r["line"])
    )
    distinct = F.size(F.array_distinct(F.transform("_j", lambda r: r["line"])))
    out = steps.select(
        id_col,
        F.size("_h").cast("long").alias("n_words"),
        (F.length("_flat") - _spaces(F.col("_flat"))).cast("long").alias("word_chars"),
        _count(F.col("_t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_j") - distinct).cast("long").alias("n_dup_lines"),
        n_repeat_words(F.col("_4")).cast("long").alias("n_repeat_words"),
        F.size("_j").cast("long").alias("n_lines"),
        F.size(failing).cast("long").alias("n_lines_removed"),
        lost.cast("long").alias("lost_chars"),
        F.array_join(good, "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return out.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("lost_chars") <= MAX_LOST * F.col("word_chars"))
    )
