"""Cleaning and tokenising of text columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

from tidings.functions.binding import let

# Every character that Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Cell texts that the usual CSV readers treat as missing.
MISSING_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
WORD = r"[\p{L}\p{N}_]{2,}"


def py_strip(c: Column) -> Column:
    """Strip all Unicode white space, not only U+0020."""
    return F.btrim(c, F.lit(WHITESPACE))


def is_empty(c: Column) -> Column:
    """Null or blank."""
    return F.coalesce(py_strip(c), F.lit("")) == ""


def missing_to_null(c: Column, tokens: Iterable[str] = MISSING_TOKENS) -> Column:
    return F.when(~c.isin(*tokens), c)


def normalize_label(c: Column) -> Column:
    """`" A (x)"` becomes `"A"`."""
    return py_strip(F.substring_index(c, "(", 1))


def to_number(c: Column) -> Column:
    """Text to double; anything that is not a plain decimal number is null.

    `try_cast` alone would also accept `1d` and `1.5f`.
    """
    text = py_strip(c.cast("string"))
    return F.when(
        text.rlike(NUMBER) | text.rlike(r"^(?i)[+-]?inf(inity)?$"),
        text.try_cast("double"),
    )


def gold_text(c: Column) -> Column:
    """Gold cells are never null: missing becomes the empty string."""
    return py_strip(F.coalesce(c.cast("string"), F.lit("")))


def none_if_empty(c: Column) -> Column:
    """Blank and the words null/none (any case) become null; others are stripped."""
    text = py_strip(c)
    return F.when(~F.lower(text).isin("", "null", "none"), text)


def null_ish(c: Column) -> Column:
    """Only the exact texts `""` and `"null"` become null; nothing is stripped."""
    return F.when(~c.isin("", "null"), c)


def clamp01(c: Column) -> Column:
    """Number clamped to [0, 1]; unparsable is 0."""
    value = F.coalesce(to_number(c), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))


def model_key(path: Column) -> Column:
    """Model name from a file path, without `all_` and a `_YYYYMMDD_n` suffix."""
    name = F.regexp_extract(path, r"([^/]*)/*$", 1)
    stem = F.regexp_replace(name, r"^(.+)\.[^.]+$", "$1")
    return F.regexp_replace(
        F.regexp_replace(stem, r"^all_", ""), r"^(.*)_\d{8}_\d+$", "$1"
    )


def lines(c: Column) -> Column:
    """Non-blank trimmed lines of a text, in order."""
    parts = F.transform(F.split(c, r"\R|[\x1c-\x1e]"), py_strip)
    return F.filter(parts, lambda line: line != "")


def word_tokens(c: Column, stop_words: Iterable[str] = ()) -> Column:
    """Lower-cased runs of two or more word characters, without stop words."""
    found = F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))
    stop = sorted(set(stop_words))
    if not stop:
        return found
    return F.filter(found, lambda w: ~w.isin(*stop))


def word_ngrams(tokens: Column) -> Column:
    """Unigrams followed by bigrams of neighbouring tokens."""

    def both(found: Column) -> Column:
        pairs = F.zip_with(
            found,
            F.slice(found, F.lit(2), F.greatest(F.size(found), F.lit(1))),
            lambda a, b: F.when(b.isNotNull(), F.concat_ws(" ", a, b)),
        )
        return F.concat(found, F.filter(pairs, lambda p: p.isNotNull()))

    return let(tokens, both)


def char_ngrams(c: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams inside white-space words padded by one space per side.

    The words are put on lines of their own, where `.` cannot leave the word;
    the look-ahead takes the n-gram at every position and the `.` after it
    moves on by one code point. A padded word shorter than n gives none.
    """
    words = F.regexp_replace(F.lower(c), rf"[{WHITESPACE}]+", " \n ")
    padded = F.concat(F.lit(" "), words, F.lit(" "))
    padded = F.regexp_replace(padded, r"(^ +\n)|(\n +$)", "")
    return let(
        padded,
        lambda p: F.concat(
            *[
                F.regexp_extract_all(p, F.lit(rf"(?=(.{{{n}}}))."), F.lit(1))
                for n in range(low, high + 1)
            ]
        ),
    )


def term_counts(terms: Column) -> Column:
    """Array of terms to array of `(term, tf)`, without a shuffle.

    The terms of one text are sorted and cut into runs, so the cost stays
    near-linear in the text however long it is.
    """

    def runs(ordered: Column) -> Column:
        size = F.size(ordered)
        starts = F.filter(
            F.sequence(F.lit(0), F.greatest(size - 1, F.lit(0))),
            lambda k: (k < size)
            & ((k == 0) | (F.get(ordered, k) != F.get(ordered, k - 1))),
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda begin, k: F.struct(
                    F.get(ordered, begin).alias("term"),
                    (F.coalesce(F.get(s, k + 1), size) - begin).alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(terms), runs)
