"""Quality rules: a threshold table compiled into one Spark projection.

Everything is built from DataFrame functions; no user function runs. Words are
maximal runs of ``[^\\x20\\x09-\\x0D]``. Defined results for odd input: null text
counts as no words (all measures 0, base_failed true, kept false); an empty
table gives an empty table; repeated rows each get their own row; further
columns of the input, whatever their names, don't take part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed set: characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: The white space that separates words, as a Java regex class.
SPACE = r"[\x20\x09-\x0D]"

#: (measure, percent of which base, verdict when the share is above). A document is kept if no row fires.
THRESHOLDS = [
    ("n_symbols", "word_chars", 8, "symbols among the characters of words"),
    ("n_dup_lines", "n_lines", 60, "lines equal to an earlier line"),
    ("n_long_words", "n_words", 10, "words over 40 characters"),
]
#: A text in which no word is a stop word is rejected only from this many words on.
STOP_FROM = 100
#: Very common short words of the corpus languages.
STOP_WORDS = (
    "the of and to in that is was for it with as on be are this by from or an a "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur "
    "el los del las por con una su para es al lo como y se no"
).split()

LONG_WORD = 40


def words_of(text: Column) -> Column:
    """The words of a text; no words for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), lambda w: w != "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once: a lambda variable, where an expression would be repeated."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _covered(sorted_grams: Column, width: int) -> Column:
    """Words inside windows whose key occurs twice or more, from (key, start) pairs in order."""
    twice = lambda at: F.array_sort(
        F.transform(
            F.filter(
                F.transform(
                    at,
                    lambda x, k: F.struct(
                        x["i"].alias("i"),
                        (
                            F.coalesce(F.get(at, k - 1)["g"] == x["g"], F.lit(False))
                            | F.coalesce(F.get(at, k + 1)["g"] == x["g"], F.lit(False))
                        ).alias("twice"),
                    ),
                ),
                lambda x: x["twice"],
            ),
            lambda x: x["i"],
        )
    )
    # starts in order: each repeated window adds the words up to the previous one's end, width at most
    added = lambda starts: F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-1).alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.least(F.lit(width), s + width - a["end"])).cast("long").alias("n"), (s + width).cast("int").alias("end")
        ),
        lambda a: a["n"],
    )
    return let(sorted_grams, lambda at: let(twice(at), added))


def repeated_words(words: Column, width: int = 5) -> Column:
    """Words that lie in some ``width``-word window found twice or more in the text, the first included.

    A window's key is the 64-bit hash of its words. Most texts repeat no window,
    which one hash set shows; only the others pay for the sort.
    """
    zero = F.lit(0).cast("long")
    keys = lambda w: F.transform(
        F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)])
    )
    pairs = lambda g: F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
    counted = lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), zero).otherwise(_covered(pairs(g), width))
    return F.when(F.size(words) < width, zero).otherwise(let(words, lambda w: let(keys(w), counted)))


def measure(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``carry`` and the measures of each text, in narrow projections only."""
    base = docs.select(
        *[F.col(f"`{c}`") for c in carry],
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("__text"),
    )
    split = base.select(*[F.col(f"`{c}`") for c in carry], "__text", words_of(F.col("__text")).alias("__words"))
    t, w = F.col("__text"), F.col("__words")
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    stops = F.array(*[F.lit(x) for x in dict.fromkeys(STOP_WORDS)])
    out = split.select(
        *[F.col(f"`{c}`") for c in carry],
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(t, " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("__lines"),
        repeated_words(w).alias("n_repeat_words"),
        F.arrays_overlap(F.transform(w, lambda x: F.lower(x)), stops).alias("has_stop"),
        F.size(F.filter(w, lambda x: F.length(x) > LONG_WORD)).cast("long").alias("n_long_words"),
    )
    return out.select(
        *[F.col(f"`{c}`") for c in carry],
        "n_words",
        "word_chars",
        "n_symbols",
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.size("__lines").cast("long").alias("n_lines"),
        "n_long_words",
        "has_stop",
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def verdict(thresholds: list[tuple] = THRESHOLDS) -> Column:
    """The threshold table as one boolean expression: true if no row fires."""
    fired = F.lit(False)
    for part, whole, percent, _ in thresholds:
        fired = fired | (100 * F.col(part) > percent * F.col(whole))
    return ~(fired | ((F.col("n_words") >= STOP_FROM) & ~F.col("has_stop")))


def quality_rules(docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` for each row of ``docs``."""
    return (
        measure(docs, text, carry)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & verdict())
    )


def keep_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns unchanged."""
    cols = docs.columns
    marked = quality_rules(docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("__row"), F.col("text").alias("text")), carry=("__row",))
    return marked.where("kept").select(*[F.col("__row").getField(c).alias(c) for c in cols])
