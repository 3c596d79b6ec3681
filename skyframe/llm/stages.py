"""The stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import language_id as LI, line_dedup as LD, packing as PK, secret_scan as SS, simhash as SH
from .common import as_row, of_row
from .queries import language_model


def language_stage(spark, docs, sf_dir):
    """Documents without a recognisable language go, however short or long they
    are: a null text, no letters, or no letter n-gram in common with any landmark
    (score 0). The columns stay as they are."""
    rows = docs.select(as_row(docs.columns), F.col("text"))
    scored = LI.identify(rows, language_model(docs), keep=["row"])
    return scored.where((F.col("lang_pred") != LI.UNDETERMINED) & (F.col("score") > 0)).select(*of_row(docs.columns))


def _with_text(columns, text):
    """The columns (fields of ``row``) with another text and its length in code points."""
    old = {c: F.col("row").getField(c).alias(c) for c in columns if c != "text"}
    return [text.alias("text") if c == "text" else
            F.coalesce(F.length(text).cast("long"), old[c]).alias("n_chars") if c == "n_chars" else old[c] for c in columns]


def line_stage(spark, docs, sf_dir):
    """Later copies of repeated line runs are deleted; a document that consists
    of nothing else goes. Null and empty texts stay as they are."""
    out = LD.dedup_lines(docs.select(as_row(docs.columns), "doc_id", "text"), keep=["row"])
    out = out.where(F.col("n_deleted").isNull() | (F.btrim("kept", F.lit(" \n" + LD.BLANKS)) != ""))
    return out.select(*_with_text(docs.columns, F.col("kept")))


def simhash_stage(spark, docs, sf_dir):
    """One document of every group of near-duplicates stays: the smallest id.
    Rows that share an id, or have none, are told apart by their texts. Null and
    empty texts have the fingerprint zero and are one group."""
    return SH.keep_first(docs)


def secret_stage(spark, docs, sf_dir):
    """Every span is replaced by a mark; no document goes, null and empty texts
    stay as they are."""
    # the other columns travel as one struct, so none can clash, and the text goes once each way
    others = [c for c in docs.columns if c != "text"]
    found = SS.find_secrets(docs.select(as_row(others), "text"), keep=["row"])
    return found.select(*_with_text(docs.columns, F.col("redacted")))


def packing_stage(spark, docs, sf_dir):
    """Token pieces with their place in the packed sequences; a null or empty
    text is one piece, its end id."""
    out = PK.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
