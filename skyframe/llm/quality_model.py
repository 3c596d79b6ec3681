"""Quality classifier: a sparse ensemble of rules.

Statistics of every text are column expressions. Shallow trees of a random forest
are grown on the labelled rows; every path from a root to a node becomes a
conjunctive rule over the statistics, and an L1-penalised logistic regression
over the rule indicators keeps the few that matter. The kept rules and weights
are compiled into one Spark column expression, so scoring is a projection.

Both fits run distributed over all labelled rows that are given. Defined results:
null and empty texts have statistics of zero and are scored like any other;
without labelled rows, or with one class only, the score is that class's share
(0.5 without rows); repeated rows are scored each.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from .common import named, of_row, written
from .textstats import MEASURES, with_measures

TREES = 16
DEPTH = 3
L1 = 0.002
ROUNDS = 60


def _ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))


def statistics() -> dict[str, Column]:
    """name -> statistic over the counted measurements of a text."""
    return {
        "log_words": F.log1p(F.col("n_words").cast("double")),
        "word_length": _ratio("word_chars", "n_words"),
        "distinct_share": _ratio("n_distinct", "n_words"),
        "repeat_share": _ratio("n_repeat_words", "n_words"),
        "symbols_per_word": _ratio("n_symbols", "n_words"),
        "upper_share": _ratio("n_upper", "n_chars"),
        "digit_share": _ratio("n_digits", "n_chars"),
        "bangs_per_word": _ratio("n_bangs", "n_words"),
        "ends_per_word": _ratio("n_ends", "n_words"),
        "commas_per_word": _ratio("n_commas", "n_words"),
        "dup_line_share": _ratio("n_dup_lines", "n_lines"),
        "words_per_line": _ratio("n_words", "n_lines"),
    }


def describe(docs: DataFrame, text: str, cols: list[str]) -> DataFrame:
    """``cols`` (as struct ``__row``) and the statistics of every text."""
    counted = with_measures(docs, text, cols, list(MEASURES))
    return counted.select("__row", *[c.cast("double").alias(n) for n, c in statistics().items()])


def rules_of(debug: str, names: list[str]) -> list[tuple[tuple[str, bool, float], ...]]:
    """All paths of the trees in a forest's text form, as conjunctions of
    ``(statistic, is-greater, threshold)``; bounds on the same statistic are
    joined, so equal rules are found equal."""
    found: dict[tuple, int] = {}
    path: list[tuple[str, bool, float]] = []
    for line in debug.splitlines():
        m = re.match(r"(\s*)(If|Else) \(feature (\d+) (<=|>) ([-+0-9.eE]+)\)", line)
        if line.lstrip().startswith("Tree "):
            path, base = [], None
        if not m:
            continue
        indent = len(m.group(1))
        base = indent if base is None else base
        del path[indent - base:]
        path.append((names[int(m.group(3))], m.group(4) == ">", float(m.group(5))))
        bounds: dict[tuple[str, bool], float] = {}
        for n, greater, at in path:
            old = bounds.get((n, greater))
            bounds[n, greater] = at if old is None else (max if greater else min)(old, at)
        rule = tuple(sorted((n, g, at) for (n, g), at in bounds.items()))
        found[rule] = found.get(rule, 0) + 1
    return sorted(found, key=lambda r: (-found[r], len(r), r))


def condition(rule) -> Column:
    out = F.lit(True)
    for n, greater, at in rule:
        out = out & ((F.col(n) > at) if greater else (F.col(n) <= at))
    return out


class Model:
    """Weighted rules: ``score`` is the compiled column expression."""

    def __init__(self, intercept: float, weights: list[tuple[tuple, float]]):
        self.intercept, self.weights = intercept, weights

    def score(self) -> Column:
        total = F.lit(float(self.intercept))
        for rule, w in self.weights:
            total = total + F.when(condition(rule), F.lit(float(w))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def train(described: DataFrame, label: str = "label") -> Model:
    """Fit on rows with the statistics and ``label`` (0 or 1). ``described``
    should be a written table: it is read several times."""
    names = list(statistics())
    rows = described.where(F.col(label).isin(0, 1)).withColumn("__label", F.col(label).cast("double"))
    n, ones = rows.agg(F.count("*"), F.sum("__label")).first()
    if not n or ones in (0, n):
        share = 0.5 if not n else ones / n
        share = min(max(share, 0.001), 0.999)
        return Model(math.log(share / (1 - share)), [])
    features = rows.withColumn("__features", array_to_vector(F.array(*names)))
    forest = RandomForestClassifier(featuresCol="__features", labelCol="__label", numTrees=TREES, maxDepth=DEPTH, maxBins=64,
                                    featureSubsetStrategy="onethird", seed=17).fit(features)
    rules = rules_of(forest.toDebugString, names)
    flags = rows.select("__label", array_to_vector(F.array(*[condition(r).cast("double") for r in rules])).alias("__features"))
    fit = LogisticRegression(featuresCol="__features", labelCol="__label", elasticNetParam=1.0, regParam=L1, maxIter=ROUNDS,
                             standardization=False).fit(flags)
    return Model(fit.intercept, [(r, w) for r, w in zip(rules, fit.coefficients.toArray()) if w != 0.0])


def score(docs: DataFrame, labelled: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
          keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """Learn from ``labelled`` (key, label) and score all ``docs``: ``keep``
    columns (default: all) plus ``name``. Of several labels of one key the
    smallest counts."""
    cols = [c for c in (keep if keep is not None else docs.columns) if c != name]
    stats = written(describe(docs.withColumn("__key", named(key)), text, [*dict.fromkeys([*cols, "__key"])]), "text-statistics")
    labels = (labelled.where(F.col(key).isNotNull() & F.col(label).isNotNull())
              .groupBy(F.col(key).alias("__label_key")).agg(F.min(label).alias("label")))
    known = written(stats.join(labels, F.col("__row.__key") == F.col("__label_key")).drop("__row", "__label_key"), "labelled")
    model = train(known)
    return stats.select(*of_row(cols, "__row"), model.score().alias(name))
