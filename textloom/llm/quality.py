"""Quality rules on lines first, then on documents, in DataFrame functions alone.

Every line is judged by itself: it fails if it is navigation, boilerplate, mostly symbols, or a
short piece without closing punctuation.  Navigation and boilerplate are told by density, in lines of
any length: separators, or phrases of notices, for the number of words.  Failing lines are removed, and
a document that loses more than ``MAX_LOST_PERCENT`` of its characters in words is rejected.  Before
that, documents of too few words or of too many repeated words are rejected as a whole.

Windows of words are compared by 64-bit hashes of their words.

Defined results: a null text has no words; an empty text fails for its few words; a line without
words is neither counted nor judged; repeated rows are judged alike; other columns pass unread
unless named in ``keep``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
MAX_LOST_PERCENT = 50
MAX_SYMBOL_PERCENT = 15
SHORT_LINE_WORDS = 4
# A menu has two separators at least, and few words between them; a notice has a phrase for so many words.
MIN_SEPARATORS, MAX_ITEM_WORDS, MAX_PHRASE_WORDS = 2, 8, 40

# Phrases of page furniture and notices.
BOILERPLATE = (
    r"(?i)(\ball rights reserved\b|\bterms of (use|service)\b|\bprivacy policy\b|\bcookie policy\b"
    r"|\buses? cookies\b|\bsign up\b|\blog ?in\b|\bsubscribe\b|\bclick here\b|\blorem ipsum\b"
    r"|\benable javascript\b|^licensed under\b|^released under\b|^this work is licensed under\b)"
)
SEPARATOR = r" [|»›>] "
LINK = r"^(home|menu|skip to content|next|previous|back to top)$"
CLOSED = r"[.!?:;…。！？][\"'”’»)\]]*\s*$"


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once per row: lambdas would repeat it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(WHITE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+")
    )


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def word_chars_of(text: Column) -> Column:
    return F.length(without(text, WHITE)).cast("long")


def repeated_words(words: Column) -> Column:
    """Words that lie in a window found twice or more, the first one included."""

    def pairs(left: Column, right: Column) -> Column:
        return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))

    def shifted(array: Column, by: int) -> tuple[Column, Column]:
        n = F.size(array) - by
        return F.slice(array, F.lit(1), n), F.slice(array, F.lit(1 + by), n)

    def windows(hashes: Column) -> Column:
        """Hashes of two neighbours, of two such pairs, and of those with the fifth word."""

        def fives(fours: Column) -> Column:
            n = F.size(fours) - 1
            return pairs(F.slice(fours, F.lit(1), n), F.slice(hashes, F.lit(WINDOW), n))

        return let(
            pairs(*shifted(hashes, 1)), lambda twos: let(pairs(*shifted(twos, 2)), fives)
        )

    def covered(found: Column) -> Column:
        places = F.array_sort(found)
        return let(
            places,
            lambda p: F.aggregate(
                F.transform(
                    p,
                    lambda at, i: F.least(
                        F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - at, F.lit(WINDOW))
                    ),
                ),
                F.lit(0),
                lambda total, n: total + n,
            ),
        )

    def twice(hashes: Column) -> Column:
        paired = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(
            paired,
            lambda s: F.transform(
                F.filter(
                    s,
                    lambda x, i: F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce((i > 0) & (F.get(s, i - 1)["h"] == x["h"]), F.lit(False)),
                ),
                lambda x: x["i"],
            ),
        )

    def count(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            covered(twice(hashes))
        )

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(
        let(hashed, lambda h: let(windows(h), count))
    ).cast("long")


def line_passes(line: Column) -> Column:
    """Whether a line stays; a line without words does."""

    def passes(bare: Column) -> Column:
        count = F.length(bare) - F.length(without(bare, SYMBOLS))
        symbols = 100 * count > MAX_SYMBOL_PERCENT * F.length(bare)
        return (bare == "") | ~(symbols | let(F.size(F.split(bare, r"[\x20\x09-\x0D]+")), furniture(bare)))

    return let(F.btrim(line, F.lit(WHITE)), passes)


def furniture(bare: Column):
    """Of a number of words: whether a trimmed line with so many is a menu, a notice or a loose piece."""

    def says(words: Column) -> Column:
        separators = F.regexp_count(bare, F.lit(SEPARATOR))
        menu = (separators >= MIN_SEPARATORS) & (words <= MAX_ITEM_WORDS * (separators + 1))
        notice = MAX_PHRASE_WORDS * F.regexp_count(bare, F.lit(BOILERPLATE)) >= words
        loose = (words <= SHORT_LINE_WORDS) & ~bare.rlike(CLOSED)
        return menu | bare.rlike(LINK) | notice | loose

    return says


def clean_lines(text: Column) -> Column:
    """The text without its failing lines."""
    return F.array_join(F.filter(F.split(text, "\n", -1), line_passes), "\n")


def judge(
    df: DataFrame, text: str = "text", keep: Sequence[str] = ("doc_id",), cleaned: str | None = None
) -> DataFrame:
    """``keep``, the counts, ``base_failed, kept`` and, if named, the cleaned text of every row."""
    source = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)], F.coalesce(F.col(text), F.lit("")).alias("_text"))
    lines = F.filter(F.split("_text", "\n", -1), lambda s: F.btrim(s, F.lit(WHITE)) != "")
    counted = source.select(
        *[F.col(f"_k{i}") for i in range(len(keep))],
        let(
            words_of(F.col("_text")),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeated")
            ),
        ).alias("_w"),
        word_chars_of(F.col("_text")).alias("word_chars"),
        (F.length("_text") - F.length(without(F.col("_text"), SYMBOLS))).cast("long").alias("n_symbols"),
        let(lines, lambda s: F.size(s) - F.size(F.array_distinct(s))).cast("long").alias("n_dup_lines"),
        clean_lines(F.col("_text")).alias("_cleaned"),
    )
    measured = counted.select(
        *[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)],
        F.col("_w.n").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.col("_w.repeated").alias("n_repeat_words"),
        word_chars_of(F.col("_cleaned")).alias("_left"),
        "_cleaned",
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    lost = F.col("word_chars") - F.col("_left")
    verdict = 100 * lost <= MAX_LOST_PERCENT * F.col("word_chars")
    out = measured.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & verdict)
    if cleaned:
        out = out.withColumn(cleaned, F.col("_cleaned"))
    return out.drop("_left", "_cleaned")
