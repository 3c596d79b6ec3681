"""Quality rules as a bitmask ledger.

``ledger`` evaluates every rule once per document and stores the measurements and
one integer whose bit *k* says that rule *k* failed. A *policy* is a versioned
mask of the rules that count; ``apply_policy`` decides with one bitwise operation
and never looks at the text again. ``ablation`` aggregates the ledger by its
failure bits (at most 2^rules rows, combined before the shuffle) and tells for
every rule of a policy how many documents fail it, fail only it, and would be
kept without it.

Everything is built from column functions; there is no Python on the data path.

Defined results: a null text is empty (no words, fails the shortest-text rule);
repeated rows are judged each; an empty table gives an empty ledger and an
ablation of zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import of_row
from .textstats import with_measures

# name -> failure condition over the measurements. The order fixes the bits;
# new rules are added at the end.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_lines", "n_chars",
            "n_upper", "n_bangs")


def _rules() -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("too_few_words", c("n_words") < 50),
        ("repeated_windows", 100 * c("n_repeat_words") > 50 * c("n_words")),
        ("symbols_per_word", 10 * c("n_symbols") > 3 * c("n_words")),
        ("duplicate_lines", (10 * c("n_dup_lines") > 5 * c("n_lines")) & (c("n_dup_lines") >= 3)),
        ("word_length", (c("word_chars") < 2 * c("n_words")) | (c("word_chars") > 15 * c("n_words"))),
        ("capitals", 10 * c("n_upper") > 4 * c("n_chars")),
        ("exclamations", 10 * c("n_bangs") > 3 * c("n_words")),
        ("few_distinct_words", (20 * c("n_distinct") < c("n_words")) & (c("n_words") >= 200)),
    ]


RULES = ("too_few_words", "repeated_windows", "symbols_per_word", "duplicate_lines", "word_length", "capitals",
         "exclamations", "few_distinct_words")
BIT = {name: 1 << k for k, name in enumerate(RULES)}


def mask_of(*names: str) -> int:
    return sum(BIT[n] for n in names)


# Versioned policies: masks of the rules whose failure rejects a document.
POLICIES = {
    "base": mask_of("too_few_words", "repeated_windows"),
    "v1": mask_of(*RULES),
}


def ledger(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all), the measurements and ``fail_bits``.
    Columns of ``docs`` named like new ones are replaced."""
    new = [*MEASURES, "fail_bits"]
    cols = [c for c in (keep if keep is not None else docs.columns) if c not in new]
    flat = with_measures(docs, text, cols, MEASURES)
    bits = F.lit(0).cast("long")
    for name, failed in _rules():
        bits = bits.bitwiseOR(F.when(failed, F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
    return flat.select(*of_row(cols, "__row"), *MEASURES, bits.alias("fail_bits"))


def apply_policy(rows: DataFrame, version: str = "v1", name: str = "kept") -> DataFrame:
    """``rows`` with a boolean: no rule of the policy failed."""
    return rows.withColumn(name, F.col("fail_bits").bitwiseAND(F.lit(POLICIES[version])) == 0)


def ablation(rows: DataFrame, version: str = "v1") -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail no other rule
    of the policy, and documents kept with and without the rule."""
    mask = POLICIES[version]
    groups = rows.groupBy("fail_bits").agg(F.count("*").alias("n"))
    names = [n for n in RULES if BIT[n] & mask]
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    one = groups.agg(total(bits == 0).alias("kept"),
                     *[total(bits.bitwiseAND(F.lit(BIT[n])) != 0).alias(f"f_{n}") for n in names],
                     *[total(bits == BIT[n]).alias(f"o_{n}") for n in names])
    return one.select(F.explode(F.array(*[F.struct(F.lit(version).alias("policy"), F.lit(n).alias("rule"),
                                                   F.col(f"f_{n}").alias("n_failed"), F.col(f"o_{n}").alias("n_only"),
                                                   F.col("kept").alias("n_kept"),
                                                   (F.col("kept") + F.col(f"o_{n}")).alias("n_kept_without")) for n in names]))
                      .alias("r")).select("r.*")
