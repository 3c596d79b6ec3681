"""Line dedup: repeated runs of lines, by prefix doubling over line ids.

The corpus is a sequence of line ids per document, and a suffix starts at every
line. Distributed prefix doubling names, for k = 1, 2, 4, ..., the first k lines of
a suffix: suffixes with the same name are an interval of the suffix array whose
longest common prefix is k lines or more. The name is the interval's *first*
position (smallest document id, then line number); the name of 2k lines is the
class of the pair (name of k here, name of k further on). Only positions whose k
lines occur twice or more go on to 2k.

A run counts from ``MIN_CHARS`` characters besides white space. A repeated run of
any length is covered by its smallest countable runs: from each of its lines
forward and backward, the fewest lines that hold ``MIN_CHARS``. These have at most
two per line and a length of their own, so the interval of *exactly* that common
prefix is named by two overlapping doubled names (the first and the last 2^j of its
lines), and every member but the first position is a later copy. Overlapping later
copies join to the maximal repeated runs, which are deleted; first copies stay. So
a line goes exactly if some run of ``MIN_CHARS`` around it starts at an earlier
place of the corpus too, whatever else its lines have in common with other places.

Runs travel as pairs of start and end: the lines of a run are never listed. The
rounds of doubling end with the longest smallest run, not with the longest
repeated one. Names shared by many positions are joined by
``common.join_by_share``, so the commonest line is not one task's work. Tables of
positions are merged whatever their size: their files are up to 17 times smaller
than their rows in memory, and Spark, which goes by the files, would broadcast several.

A line is the text between ``\\n``; lines are equal when they are equal without
the white space at their ends. Defined results: a null or empty text has no runs;
a null document id sorts last; rows with the same id and the same text are one
document (both get the same verdict); a text may lose all its lines.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import as_row, freed, join_by_share, let, named, of_row, packed_rows, ship, written

ship(__name__)

MIN_CHARS = 20
BLANKS = " \t\x0b\x0c\r"
LAST = (1 << 63) - 1
PLACE = ["o", "d", "p"]


def _document(key: str, text: str) -> list[Column]:
    """(o, d): the order of a document and a hash that tells documents of one id apart."""
    return [F.coalesce(named(key).cast("long"), F.lit(LAST)).alias("o"), F.xxhash64(named(key), named(text)).alias("d")]


def smallest_runs(chars: np.ndarray, min_chars: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the fewest lines from it forward, and up to it backward,
    that hold ``min_chars`` characters; 0 where there are not so many."""
    n = len(chars)
    before = np.concatenate([[0], np.cumsum(chars)])
    end = np.searchsorted(before, before[:-1] + min_chars, side="left")     # first place with enough behind it
    forward = np.where(end <= n, np.maximum(end - np.arange(n), 1), 0)
    start = np.searchsorted(before, before[1:] - min_chars, side="right") - 1
    backward = np.where(before[1:] >= min_chars, np.maximum(np.arange(1, n + 1) - start, 1), 0)
    return forward, backward


def line_table(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = MIN_CHARS) -> DataFrame:
    """(o, d, p, h, c, forward, backward): document, line number, a 128-bit hash of
    the line, and the lines of its smallest runs."""
    def run(batches):
        import xxhash
        for batch in batches:
            for part in packed_rows(batch, 4 << 20):
                sizes, digests, forward, backward = [], [], [], []
                for t in part.column("text").to_pylist():
                    lines = [x.strip(BLANKS) for x in t.split("\n")]
                    sizes.append(len(lines))
                    digests.extend(xxhash.xxh3_128_digest(x.encode("utf-8")) for x in lines)
                    a, b = smallest_runs(np.fromiter(map(len, lines), np.int64, len(lines)), min_chars)
                    forward.append(a)
                    backward.append(b)
                of = pa.array(np.repeat(np.arange(part.num_rows), sizes))
                h = np.frombuffer(b"".join(digests), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [part.column("o").take(of), part.column("d").take(of), pa.array(np.concatenate([np.arange(s, dtype=np.int32) for s in sizes])),
                     pa.array(h[:, 0].copy()), pa.array(h[:, 1].copy()),
                     *[pa.array(np.concatenate(x).astype(np.int32)) for x in (forward, backward)]],
                    names=["o", "d", "p", "h", "c", "forward", "backward"])

    rows = docs.where(named(text).isNotNull() & (named(text) != "")).select(*_document(key, text), named(text).alias("text"))
    return written(rows.mapInArrow(freed(run), "o long, d long, p int, h long, c long, forward int, backward int"), "lines")


def _first(rows: DataFrame, by: list[str]) -> DataFrame:
    """``rows`` whose class (columns ``by``) holds two positions or more, with
    the first position of the class as ``f`` in place of ``by``."""
    keyed = rows.withColumn("key", F.struct(*by)).drop(*by)
    heads = (keyed.groupBy("key").agg(F.min(F.struct(*PLACE)).alias("f"), F.count("*").alias("size")).where("size > 1"))
    return join_by_share(keyed, written(heads, "classes"), "key", "size").where(F.col("f").isNotNull()).drop("key")


def doubled(first: DataFrame, longest: int) -> list[DataFrame]:
    """Level j: positions whose 2^j lines occur twice or more with their name
    ``f``, for all 2^j up to ``longest``; ``first`` is level 0."""
    levels, k = [first.select(*PLACE, "f")], 1
    while 2 * k <= longest:
        here = levels[-1]
        ahead = here.select("o", "d", (F.col("p") - k).alias("p"), F.col("f").alias("g"))
        pairs = here.hint("merge").join(ahead, PLACE)
        levels.append(written(_first(pairs, ["f", "g"]), f"rank-{2 * k}"))
        k *= 2
    return levels


def later_copies(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = MIN_CHARS) -> DataFrame:
    """(o, d, s, e): smallest runs, lines s to e - 1, that start earlier as well."""
    lines = line_table(docs, text, key, min_chars)
    # repeated rows are one document: from here on every position is one row
    first = written(_first(lines, ["h", "c"]).dropDuplicates(PLACE), "rank-1")
    runs = first.select("o", "d", F.inline(F.array(
        F.struct(F.col("p"), F.col("forward").alias("size")),
        F.struct((F.col("p") - F.col("backward") + 1).alias("p"), F.col("backward").alias("size"))))).where("size > 0").distinct()
    runs = written(runs, "smallest-runs")
    longest = runs.agg(F.max("size")).first()[0] or 0
    later = F.col("f") != F.struct(*PLACE)
    out = runs.where("size = 1").hint("merge").join(first.select(*PLACE, "f"), PLACE).where(later).select("o", "d", "p", "size")
    for j, level in enumerate(doubled(first, longest)):
        k = 1 << j
        if k == 1:
            continue                                        # runs of one line: above
        own = runs.where((F.col("size") >= k) & (F.col("size") < 2 * k))
        tail = level.select("o", "d", F.col("p").alias("at"), F.col("f").alias("g"))
        here = own.hint("merge").join(level, PLACE).withColumn("at", F.col("p") + F.col("size") - k)
        both = here.hint("merge").join(tail, ["o", "d", "at"]).drop("at")
        same = _first(both.withColumn("lines", F.col("size")), ["lines", "f", "g"])
        out = out.unionByName(same.where(later).select("o", "d", "p", "size"))
    return out.select("o", "d", F.col("p").alias("s"), (F.col("p") + F.col("size")).alias("e"))


def deleted_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = MIN_CHARS) -> DataFrame:
    """(o, d, gone): per document its deleted lines as sorted, disjoint pairs
    (s, e) of first line and the line after the last one."""
    ends = later_copies(docs, text, key, min_chars).groupBy("o", "d", "e").agg(F.min("s").alias("s"))
    # overlapping and touching pairs are merged: a pair that starts behind all ends so far opens a new one
    order = Window.partitionBy("o", "d").orderBy("s", "e")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = ends.withColumn("new", F.coalesce((F.col("s") > reach).cast("long"), F.lit(1).cast("long")))
    parts = (opened.withColumn("part", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("o", "d", "part").agg(F.min("s").alias("s"), F.max("e").alias("e")))
    return parts.groupBy("o", "d").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("gone"))


def dedup_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_chars: int = MIN_CHARS,
                keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus ``n_lines``, ``n_deleted`` and
    ``n_runs`` (null where no line goes), and ``kept``: the text without the deleted
    lines, each of which takes its line break along. Columns of ``docs`` named like
    new ones are replaced."""
    new = ["n_lines", "n_deleted", "n_runs", "kept"]
    cols = [c for c in (keep if keep is not None else docs.columns) if c not in new]
    gone = deleted_lines(docs, text, key, min_chars)
    tagged = docs.select(as_row(cols), named(text).alias("text"), *_document(key, text))
    # what stays: the lines from the end of one pair to the start of the next one
    edges = lambda at: F.concat(
        F.array(F.struct(F.lit(0).alias("s"), F.lit(0).alias("e"))), F.col("gone"),
        F.array(F.struct(at.alias("s"), at.alias("e"))))
    kept = let(F.split("text", "\n"), lambda xs: let(edges(F.size(xs)), lambda gs: F.array_join(F.flatten(F.transform(
        F.sequence(F.lit(1), F.size(gs) - 1),
        lambda i: F.slice(xs, F.get(gs, i - 1)["e"] + 1, F.get(gs, i)["s"] - F.get(gs, i - 1)["e"]))), "\n")))
    found = F.col("gone").isNotNull()
    return tagged.join(gone, ["o", "d"], "left").select(
        *of_row(cols), F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n_lines"),
        F.when(found, F.aggregate("gone", F.lit(0), lambda n, g: n + g["e"] - g["s"])).cast("long").alias("n_deleted"),
        F.when(found, F.size("gone")).cast("long").alias("n_runs"), F.when(found, kept).otherwise(F.col("text")).alias("kept"))
