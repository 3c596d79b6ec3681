"""Text statistics as column expressions (JVM-side, no Python).

``measure`` binds the words and lines of a text once and returns one struct, so
that every statistic reads the same arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import as_row, let, named

# Characters that separate words, turned into blanks before splitting.
GAPS = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    for gap in GAPS:                     # replacing is much cheaper than translating
        text = F.replace(text, F.lit(gap), F.lit(" "))
    return F.filter(F.split(text, " "), lambda w: w != "")


def repeated_positions(w: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more: sort the
    windows (by a 64-bit hash of their words) with their places, keep those with
    an equal neighbour, count the places covered."""
    def covered(s: Column) -> Column:
        starts = F.transform(
            F.filter(s, lambda x, k: (x["h"] == F.get(s, k + 1)["h"]) | (F.coalesce(x["h"] == F.get(s, k - 1)["h"], F.lit(False)))),
            lambda x: x["i"])
        return let(starts, lambda a: F.size(F.array_distinct(F.concat(
            a, F.transform(a, lambda i: i + 1), F.transform(a, lambda i: i + 2)))))

    windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
        F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(let(F.sort_array(windows), covered))


def lines_with_words(text: Column) -> Column:
    """The ``\\n``-separated lines that hold a word."""
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" " + GAPS)) != "")


# Character classes that are counted, each by a mark that stands for it.
CLASSES = {"n_symbols": "#*$%&|<>", "n_upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "n_digits": "0123456789", "n_bangs": "!",
           "n_ends": ".?", "n_commas": ","}


def class_counts(t: Column, names) -> list[Column]:
    """Characters of each class: one translation to marks, then a length
    difference per mark. Marks that stand in the text itself become blanks."""
    marks = {n: chr(1 + k) for k, n in enumerate(CLASSES)}
    pairs = [(c, marks[n]) for n in names for c in CLASSES[n]] + [(m, " ") for m in marks.values()]
    marked = F.translate(t, "".join(a for a, _ in pairs), "".join(b for _, b in pairs))
    return [let(marked, lambda x: F.struct(*[
        (F.length(x) - F.length(F.replace(x, F.lit(marks[n]), F.lit("")))).cast("long").alias(n) for n in names])).alias("c")]


def measure(text: Column, classes) -> Column:
    """Struct of counts of one text (null counts as empty); ``with_measures``
    turns it into columns."""
    t = F.coalesce(text, F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda s, x: s + F.length(x)).alias("word_chars"),
            F.size(F.array_distinct(w)).cast("long").alias("n_distinct"),
            repeated_positions(w).cast("long").alias("n_repeat_words"))

    def of_lines(x: Column) -> Column:
        return F.struct(F.size(x).cast("long").alias("n_lines"),
                        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"))

    return F.struct(let(words(t), of_words).alias("w"), let(lines_with_words(t), of_lines).alias("l"),
                    F.length(t).cast("long").alias("n_chars"), *class_counts(t, classes))


MEASURES = {**{n: f"w.{n}" for n in ("n_words", "word_chars", "n_distinct", "n_repeat_words")},
            **{n: f"l.{n}" for n in ("n_lines", "n_dup_lines")}, "n_chars": "n_chars",
            **{n: f"c.{n}" for n in CLASSES}}


def with_measures(docs: DataFrame, text: str, cols: list[str], names) -> DataFrame:
    """``cols`` as a struct ``__row`` and the measurements ``names``. The struct
    of counts goes through a generator, so the optimiser cannot compute it once
    per use."""
    counts = measure(named(text), [n for n in CLASSES if n in names])
    m = docs.select(as_row(cols, "__row"),
                    F.explode(F.array(counts)).alias("__m"))
    return m.select("__row", *[F.col(f"__m.{MEASURES[n]}").alias(n) for n in names])
