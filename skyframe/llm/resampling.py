"""Target-distribution importance resampling with parallel sorting by regular sampling.

Each run of one to ``runs`` words is a feature, its crc32 modulo ``buckets`` its
bucket. Bucket counts of the raw and of the target texts give one gain per bucket;
a document's weight is the floored mean of the gains that its features pick from
that array. The weight plus Gumbel noise drawn from the document's id is its score,
and the highest scores are a draw without replacement.

Ranks come from a parallel sort by regular sampling: every task sorts its own rows
into a run and writes it; the rows at regular places of all runs (at most
``SAMPLES`` and one per run) give regular splitters; the segments between splitters
are exchanged and merged locally; and the rows before a segment, from one count per
segment, make its places exact ranks. Segments beyond the draw are only counted.

The driver holds one count per bucket, the samples and one count per segment.

Defined results: a null text has no words; a document without features has weight
0; a null id counts as '' for the noise and is the last among ties; rows with the
same score and id follow by their features, repeated rows in any order; an
empty table draws nothing.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .common import as_row, carried, named, of_row, packed_rows, ship, written

ship(__name__)

CACHE = 300_000             # features whose buckets a task remembers
SAMPLES = 1 << 16           # bound of the regular samples
SEGMENT_ROWS = 1024         # rows of a segment, until there are MAX_SEGMENTS
MAX_SEGMENTS = 4096

# bytes of a word: digits, letters (A-Z lower-cased) and everything beyond ASCII
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


class Buckets(dict):
    """Bucket of a feature, remembered up to a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.buckets
        return bucket


def feature_buckets(text: str | None, known: Buckets, runs: int) -> tuple[int, np.ndarray]:
    """Number of words, and the buckets of all features."""
    words = (text or "").encode("utf-8").translate(FOLD).split()
    found = list(map(known.__getitem__, words))
    for n in range(2, runs + 1):
        found.extend(known[b" ".join(x)] for x in zip(*[words[i:] for i in range(n)]))
    return len(words), np.array(found, dtype=np.int64)


def bucket_counts(texts: DataFrame, text: str = "text", runs: int = 1, buckets: int = 10000) -> np.ndarray:
    """Features of each bucket over all texts. A task adds its texts up first, so
    it sends one row per bucket at most."""
    def count(batches):
        known, total = Buckets(buckets), np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for part in packed_rows(batch):
                for t in part.column("text").to_pylist():
                    total += np.bincount(feature_buckets(t, known, runs)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    rows = (texts.select(named(text).alias("text")).mapInArrow(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")).collect())         # at most ``buckets`` rows
    out = np.zeros(buckets, dtype=np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the log ratio of the smoothed target and raw shares, floored."""
    n, (s, t) = len(raw), (x.astype(np.float64) for x in (raw, target))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, text: str = "text", keep: list[str] | None = None, runs: int = 1) -> DataFrame:
    """A struct ``row`` of the ``keep`` columns plus ``n_words``, ``n_features`` and ``weight``."""
    cols = keep if keep is not None else docs.columns
    src = docs.select(as_row(cols), named(text).alias("text"))

    def run(batches):
        known = Buckets(len(gain))
        for batch in batches:
            for part in packed_rows(batch):
                words, features, weight = [], [], []
                for t in part.column("text").to_pylist():
                    n, found = feature_buckets(t, known, runs)
                    words.append(n)
                    features.append(len(found))
                    weight.append(int(gain[found].sum()) // len(found) if len(found) else 0)
                yield pa.RecordBatch.from_arrays([part.column("row"), *[pa.array(x, pa.int64()) for x in (words, features, weight)]],
                                                 names=["row", "n_words", "n_features", "weight"])

    return src.mapInArrow(run, carried(src, "row", "n_words long, n_features long, weight long"))


def with_noise(rows: DataFrame, key, seed: int):
    """``rows`` plus ``score``: the weight and Gumbel noise of the key's hash, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return rows.withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(uniform))))


def ranked(rows: DataFrame, order: list[str], draw) -> DataFrame:
    """``rows`` plus ``rank``: exact places 1, 2, ... of the first ``draw(n)`` of
    all n rows in ascending ``order`` (long columns without nulls); null behind
    them. Rows equal in ``order`` get different places."""
    n_order = len(order) + 1
    # runs: each task's rows sorted and numbered, written once, so the numbers stay as they are
    runs = written(rows.sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id()), "sorted-runs")
    n = runs.count()
    take, keys = draw(n), [*order, "place"]
    if not take:
        return runs.drop("place").withColumn("rank", F.lit(None).cast("long"))
    stride = -(-n // SAMPLES)
    at = F.col("place").bitwiseAND(F.lit((1 << 33) - 1))     # place within the run
    sample = runs.where(at % stride == stride - 1).select(*keys).collect()
    sample = np.array([tuple(r) for r in sample], dtype=np.int64).reshape(-1, n_order)
    sample = sample[np.lexsort(sample.T[::-1])]
    segments = max(1, min(MAX_SEGMENTS, -(-n // SEGMENT_ROWS)))
    splitters = sample[(np.arange(1, segments) * len(sample) // segments)] if len(sample) else sample
    splitters = np.unique(splitters, axis=0)

    def deal(batches):
        for batch in batches:
            mine = np.column_stack([np.asarray(batch.column(k)).astype(np.int64) for k in keys])
            both = np.concatenate([splitters, mine])
            by = np.lexsort(both.T[::-1])                    # a splitter is the first of its segment
            before = np.cumsum(by < len(splitters))
            segment = np.empty(len(both), dtype=np.int32)
            segment[by] = before
            yield batch.append_column("segment", pa.array(segment[len(splitters):]))

    fields = StructType([*runs.schema.fields, StructField("segment", IntegerType())])
    dealt = written(runs.mapInArrow(deal, fields), "segments")
    counts = dict(dealt.groupBy("segment").count().collect())                # one row per segment
    first, before = {}, 0
    for s in sorted(counts):
        if before >= take:
            break
        first[s] = before
        before += counts[s]
    last = max(first)
    starts = F.create_map(*[x for s, b in first.items() for x in (F.lit(s), F.lit(b).cast("long"))])
    merged = dealt.where(F.col("segment") <= last).withColumn("rank", starts[F.col("segment")] + F.row_number().over(
        Window.partitionBy("segment").orderBy(*keys)))
    merged = merged.withColumn("rank", F.when(F.col("rank") <= take, F.col("rank")))
    rest = dealt.where(F.col("segment") > last).withColumn("rank", F.lit(None).cast("long"))
    return merged.unionByName(rest).drop("place", "segment")


def resample(docs: DataFrame, target: DataFrame, text: str = "text", key: str = "doc_id", target_text: str = "text",
             keep: list[str] | None = None, runs: int = 1, buckets: int = 10000, seed: int = 2024, percent: int = 10,
             min_words: int = 20) -> DataFrame:
    """``keep`` columns (default: all) plus ``n_features``, ``weight``, ``score``
    and ``rank`` (null: not drawn). Of the documents of ``min_words`` words or more
    ``percent`` in a hundred are drawn. Columns of ``docs`` named like new ones are
    replaced."""
    new = ["n_features", "weight", "score", "rank"]
    cols = [c for c in (keep if keep is not None else docs.columns) if c not in new]
    gain = gains(bucket_counts(docs, text, runs, buckets), bucket_counts(target, target_text, runs, buckets))
    src = docs.select(F.struct(*[named(c).alias(c) for c in cols], named(key).alias("__key")).alias("both"), named(text).alias("text"))
    scored = weigh(src, gain, "text", ["both"], runs)
    id_ = F.col("row.both.__key")
    scored = with_noise(scored, id_, seed).select(
        F.col("row.both").alias("row"), "n_words", "n_features", "weight", "score", (-F.col("score")).alias("down"),
        id_.isNull().cast("long").alias("no_id"), F.coalesce(id_.cast("long"), F.lit(0)).alias("id"))
    scored = written(scored, "scored")
    enough = F.col("n_words") >= min_words
    drawn = ranked(scored.where(enough), ["down", "no_id", "id", "n_features"], lambda n: percent * n // 100)
    short = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(short).select(*of_row(cols), *new)
