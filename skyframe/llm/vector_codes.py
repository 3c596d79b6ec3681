"""Vector code compression: product codes in exact integers, assigned along a trie.

Components become floor(``SCALE`` * x); a vector is cut into equal parts, and each
part position has a codebook. It starts as the parts of the smallest ids; a round
assigns every part to its nearest entry and moves the entries to the floored means.

The rounds work on the *distinct* parts of a position with their counts, counted
before the shuffle and sorted by range, so that a task holds a lexicographic run:
the leaves of a trie over its parts. The trie is visited depth first. A node
carries its distances to all entries, added up over the dimensions from the root;
parts that share a prefix share these sums, and children only add the dimension
they differ in. Leaves whose path has no further branch are finished many at a
time. A leaf takes the nearest entry and adds its part, times its count, to that
entry's sums; a task returns one row per used entry. The visit holds at most
``LEAVES`` rows of distances for each level of the trie.

Only codebooks and one row of sums per entry reach the driver.

Defined results: rows whose vector is null, empty, holds null or non-finite
components, or differs in length from the most frequent length take no part; a
null id is kept, counts as the largest and has its code like any other; rows with
one id are ordered by their vectors; ties go to the lower entry; fewer rows than
entries make a smaller codebook; an empty table has no codes. A length that the
number of parts does not divide raises ValueError. Distances are exact up to
components of 131,000 in size (2^27 after scaling); larger ones raise.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import as_row, carried, join_by_share, named, of_row, ship, written

ship(__name__)

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
LEAVES = 1024               # rows of distances held at once for a level of the trie
LARGEST = 1 << 27
BLOCK = 1 << 16             # sorted parts of a trie
NEW = ["code", "error"]


def integers(vector: str) -> Column:
    """The scaled components; null where the vector takes no part."""
    v = named(vector).cast("array<double>")
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    bounded = lambda x: F.when(F.abs(x) * SCALE <= LARGEST, F.floor(x * SCALE)).otherwise(
        F.raise_error(F.lit("a component is too large for exact distances")).cast("long"))
    return F.when(finite & (F.size(v) > 0), F.transform(v, bounded).cast("array<int>"))


class Trie:
    """Nearest entries of lexicographically sorted distinct parts."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        self.plain = self.entries.astype(np.float64)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of each part."""
        self.parts = parts.astype(np.int64)
        # whole numbers below 2^53 are exact in double precision, so matrix products may be used
        largest = max(int(np.abs(self.parts).max(initial=0)), int(np.abs(self.entries).max(initial=0)))
        self.exact = 4 * largest * largest * max(1, parts.shape[1]) < 1 << 53
        self.code = np.zeros(len(parts), dtype=np.int64)
        self.distance = np.zeros(len(parts), dtype=np.int64)
        if len(parts):
            self._visit(0, len(parts), 0, np.zeros(len(self.entries), dtype=np.int64))
        return self.code, self.distance

    def _take(self, at: np.ndarray, sums: np.ndarray) -> None:
        best = sums.argmin(axis=1)                           # the lowest entry among equals
        self.code[at] = best
        self.distance[at] = sums[np.arange(len(best)), best]

    def _visit(self, lo: int, hi: int, depth: int, sums: np.ndarray) -> None:
        """Rows lo to hi share ``depth`` dimensions, whose distances are ``sums``."""
        if depth == self.parts.shape[1]:
            self._take(np.arange(lo, hi), np.broadcast_to(sums, (hi - lo, len(sums))))
            return
        value = self.parts[lo:hi, depth]
        start = np.concatenate([[0], np.flatnonzero(value[1:] != value[:-1]) + 1])
        stop = np.concatenate([start[1:], [hi - lo]])
        for first in range(0, len(start), LEAVES):
            a, b = start[first:first + LEAVES], stop[first:first + LEAVES]
            step = value[a][:, None] - self.entries[None, :, depth]
            children = sums + step * step
            alone = np.flatnonzero(b - a == 1)
            if len(alone):                                   # no further branch: down to the leaves together
                at, own = lo + a[alone], children[alone]
                if self.exact:
                    x, e = self.parts[at, depth + 1:].astype(np.float64), self.plain[:, depth + 1:]
                    own = own + ((x * x).sum(axis=1)[:, None] - 2 * (x @ e.T) + (e * e).sum(axis=1))
                else:
                    for d in range(depth + 1, self.parts.shape[1]):
                        step = self.parts[at, d][:, None] - self.entries[None, :, d]
                        own += step * step
                self._take(at, own)
            for k in np.flatnonzero(b - a > 1):
                self._visit(lo + int(a[k]), lo + int(b[k]), depth + 1, children[k])


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def distinct_parts(vectors: DataFrame, parts: int) -> DataFrame:
    """(position, part, n), sorted within ranges of (position, part)."""
    width = F.size("x") / parts
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.struct(
        i.alias("position"), F.slice("x", (i * width).cast("int") + 1, width.cast("int")).alias("part")))
    rows = vectors.select(F.inline(cut)).groupBy("position", "part").agg(F.count("*").alias("n"))
    return written(written(rows, "parts").repartitionByRange("position", "part").sortWithinPartitions("position", "part"), "sorted-parts")


def round_sums(parts: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(position, entry, n, sums): what the parts assigned to an entry add up to."""
    width = books[0].shape[1]

    def assign(batches):
        tries = [Trie(b) for b in books]
        sums = np.zeros((len(books), len(books[0]), width), dtype=np.int64)
        n = np.zeros(sums.shape[:2], dtype=np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                some = batch.slice(lo, BLOCK)
                position, x, count = np.asarray(some.column("position")), _matrix(some.column("part")), np.asarray(some.column("n"))
                for p in np.unique(position):
                    own = np.flatnonzero(position == p)
                    code, _ = tries[p].nearest(x[own])
                    np.add.at(sums[p], code, x[own].astype(np.int64) * count[own][:, None])
                    np.add.at(n[p], code, count[own])
        at = np.argwhere(n > 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[:, 0].astype(np.int32)), pa.array(at[:, 1].astype(np.int32)), pa.array(n[n > 0]),
             pa.array(list(sums[n > 0]), pa.list_(pa.int64()))], names=["position", "entry", "n", "sums"])

    tasks = parts.mapInArrow(assign, "position int, entry int, n long, sums array<bigint>")
    return tasks.groupBy("position", "entry").agg(F.sum("n").alias("n"), F.array(
        *[F.sum(F.get("sums", F.lit(i))) for i in range(width)]).alias("sums"))


def fit(vectors: DataFrame, key: str, parts: int, entries: int, rounds: int) -> list[np.ndarray]:
    """The codebooks of (``key``, x): one matrix (entry, dimension) per part."""
    first = written(vectors.select(F.col(key).alias("id"), "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries), "first-entries")
    start = np.array([r["x"] for r in first.orderBy(F.col("id").asc_nulls_last(), "x").collect()], dtype=np.int64)
    if not len(start):
        return []
    books = list(np.split(start, parts, axis=1))
    table = distinct_parts(vectors, parts)
    for _ in range(rounds):
        for r in round_sums(table, books).collect():         # one row per entry
            books[r["position"]][r["entry"]] = [s // r["n"] for s in r["sums"]]
    return books


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def compress(rows: DataFrame, vector: str = "embedding", key: str = "vec_id", keep: list[str] | None = None, parts: int = PARTS,
             entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """``keep`` columns (default: all) plus ``code`` (two hex digits a part) and
    ``error`` (squared distances, summed), and the codebooks. Columns of ``rows``
    named like new ones are replaced."""
    if not 1 <= entries <= 256:
        raise ValueError("a code of two hex digits has 1 to 256 entries")
    cols = [c for c in (keep if keep is not None else rows.columns) if c not in NEW]
    usable = rows.select(as_row(cols), named(key).alias("key"), integers(vector).alias("x")).where(F.col("x").isNotNull())
    usable = written(usable, "vectors")
    lengths = usable.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), "length").first()
    length = lengths["length"] if lengths else 0
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut into {parts} equal parts")
    usable = usable.where(F.size("x") == length)
    books = fit(usable, "key", parts, entries, rounds)

    def encode(batches):
        tries = [Trie(b) for b in books]
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                some = batch.slice(lo, BLOCK)
                x = _matrix(some.column("x"))
                code, error = np.zeros((len(x), len(tries)), dtype=np.uint8), np.zeros(len(x), dtype=np.int64)
                for p, (trie, own) in enumerate(zip(tries, np.split(x, parts, axis=1))):
                    different, of = np.unique(own, axis=0, return_inverse=True)
                    best, distance = trie.nearest(different)
                    code[:, p], error = best[of.ravel()], error + distance[of.ravel()]
                yield pa.RecordBatch.from_arrays([some.column("row"), pa.array([c.tobytes().hex() for c in code], pa.string()),
                                                  pa.array(error)], names=["row", *NEW])

    out = usable.drop("key").mapInArrow(encode, carried(usable, "row", "code string, error long"))
    return out.select(*of_row(cols), *NEW), books


def with_label_error(coded: DataFrame, label: str) -> DataFrame:
    """``coded`` plus ``label_error``: the error summed over rows of one label,
    nulls together."""
    totals = written(coded.groupBy(named(label).alias(label)).agg(F.sum("error").alias("label_error"), F.count("*").alias("__n")), "label-errors")
    return join_by_share(coded, totals, label, "__n")
