"""Corpus pipeline: language id, line dedup, near-duplicate removal, secret
redaction and packing over ``documents``. Every stage takes the documents its
predecessor kept; all but the last return the columns of ``documents``. Null texts,
and texts without letters, go in the first stage (they have no language); what each
stage does with the cases left is said in its docstring."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyframe.llm import stages
from skyframe.llm.common import documents, written

STAGES = [
    ("language_id", stages.language_stage),
    ("line_dedup", stages.line_stage),
    ("simhash_dedup", stages.simhash_stage),
    ("secret_scan", stages.secret_stage),
    ("best_fit_packing", stages.packing_stage),
]

# SQL can express neither the learned language model nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what each one returns is written as Parquet and
    read again as the next one's documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
