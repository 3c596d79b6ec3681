"""SimHash near-duplicate detection with anchor-point covering.

A fingerprint has 64 bits. Two blocks of 23 bits are each covered by the binary
Golay code: every 23-bit word lies within 3 bits of exactly one code word, its
*anchor*. A fingerprint is at home at the pair of anchors of its two blocks. A
fingerprint that differs from it in at most ``t`` bits (e1 of them in the first
block, e2 in the second, e1 + e2 <= t) lies within 3 + e1 and 3 + e2 bits of those
anchors; so each fingerprint is also replicated to every pair of code words within
the covering radius plus its share of the threshold. Fingerprints are compared
only where a home meets a replica at the same anchor pair. The number of replicas
per fingerprint is bounded (61 on average for t = 2), whatever the data.

Only distinct fingerprints take part, each with its smallest document id, so a
group of exact copies is one row. Components are found by repeated large-star /
small-star steps over the links, written as tables after every round.

Defined results: null and empty texts have fingerprint 0 and are linked like any
other; a null document id counts as larger than every other; repeated rows are
fingerprinted each and share a component; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_row, freed, named, of_row, packed_rows, ship, written

ship(__name__)

SHINGLE = 3
MAX_BITS = 2
RADIUS = 3                              # covering radius of the code
LENGTH = 23
GENERATOR = 0b101011100011              # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1
BLOCKS = (0, LENGTH)                    # first bit of each covered block


def code_words() -> np.ndarray:
    """The 4096 words of the binary Golay code: multiples of its generator."""
    words = np.zeros(4096, dtype=np.int64)
    m = np.arange(4096)
    for b in range(12):
        words ^= np.where((m >> b) & 1, GENERATOR << b, 0)
    return words


class Anchors:
    """For every 11-bit syndrome: the error patterns of weight at most
    ``RADIUS + MAX_BITS`` with that syndrome, by weight."""

    def __init__(self, bits: int = MAX_BITS):
        self.bits = bits
        v = np.arange(1 << LENGTH, dtype=np.int64)
        weight = np.bitwise_count(v)
        v = v[weight <= RADIUS + bits]
        weight = np.bitwise_count(v)
        order = np.lexsort((weight, self.syndrome(v)))
        self.errors, self.weight = v[order], weight[order]
        self.first = np.searchsorted(self.syndrome(self.errors), np.arange((1 << 11) + 1))
        s = np.arange(1 << 11)
        # patterns of weight <= RADIUS + e, for e = 0..bits, per syndrome
        self.upto = np.stack([self.first[s] + np.array([np.searchsorted(self.weight[a:b], RADIUS + e, side="right")
                                                        for a, b in zip(self.first[:-1], self.first[1:])])
                              for e in range(bits + 1)], axis=1)

    @staticmethod
    def syndrome(v: np.ndarray) -> np.ndarray:
        """Remainder modulo the generator polynomial."""
        v = v.copy()
        for b in range(LENGTH - 1, 10, -1):
            v ^= np.where((v >> b) & 1, GENERATOR << (b - 11), 0)
        return v

    def near(self, block: np.ndarray, extra: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, anchor) for every code word within RADIUS + extra of each block."""
        s = self.syndrome(block)
        a, b = self.first[s], self.upto[s, extra]
        n = b - a
        row = np.repeat(np.arange(len(block)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(a, n)
        return row, block[row] ^ self.errors[at]

    def cover(self, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, anchor pair, home) of every fingerprint: its home, and all
        pairs within the radius plus shares of the threshold that add up."""
        mask = (1 << LENGTH) - 1
        u = fp.view(np.uint64)
        one, two = ((u >> np.uint64(b)).astype(np.int64) & mask for b in BLOCKS)
        rows, pairs, homes = [], [], []
        for e1 in range(self.bits + 1):
            r1, c1 = self.near(one, e1)
            if e1:                                          # only those at distance exactly RADIUS + e1
                far = np.bitwise_count(c1 ^ one[r1]) == RADIUS + e1
                r1, c1 = r1[far], c1[far]
            r2, c2 = self.near(two, self.bits - e1)
            n2 = np.bincount(r2, minlength=len(fp))
            start2 = np.cumsum(n2) - n2
            times = n2[r1]
            row = np.repeat(r1, times)
            at = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(start2[r1], times)
            a, b = np.repeat(c1, times), c2[at]
            rows.append(row)
            pairs.append((a << LENGTH) | b)
            homes.append((np.bitwise_count(a ^ one[row]) <= RADIUS) & (np.bitwise_count(b ^ two[row]) <= RADIUS))
        return np.concatenate(rows), np.concatenate(pairs), np.concatenate(homes)


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    import xxhash
    words = (text or "").encode("utf-8").lower().split()    # ASCII case and ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = map(b" ".join, zip(*[words[k:] for k in range(shingle)]))
    digest = xxhash.xxh64_digest
    h = np.frombuffer(b"".join([digest(p, 42) for p in parts]), dtype=np.uint8).reshape(-1, 8)
    total = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(h), 1 << 14):
        total += np.unpackbits(h[lo:lo + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(h)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) of every row; the hash tells rows of one id apart."""
    def run(batches):
        for batch in batches:
            for part in packed_rows(batch):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"),
                     pa.array([fingerprint(t, shingle) for t in part.column("text").to_pylist()], pa.int64())],
                    names=["doc_id", "text_hash", "fp"])

    src = docs.select(named(key).cast("long").alias("doc_id"), F.xxhash64(named(text)).alias("text_hash"), named(text).alias("text"))
    return src.mapInArrow(freed(run), "doc_id long, text_hash long, fp long")


def links(distinct: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(a, b), a < b: distinct fingerprints that differ in at most ``bits`` bits."""
    def run(batches):
        anchors = Anchors(bits)
        for batch in batches:
            fp = np.asarray(batch.column("fp")).astype(np.int64)
            for lo in range(0, len(fp), 4096):
                row, pair, home = anchors.cover(fp[lo:lo + 4096])
                yield pa.RecordBatch.from_arrays([pa.array(pair), pa.array(fp[lo:lo + 4096][row]), pa.array(home)],
                                                 names=["anchor", "fp", "home"])

    covered = distinct.select("fp").mapInArrow(freed(run), "anchor long, fp long, home boolean")
    homes = covered.where("home").select("anchor", F.col("fp").alias("a"))
    all_ = covered.select(F.col("anchor"), F.col("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits
    # Spark sizes both sides like the fingerprints they are made from, about 60 times too low: never broadcast
    met = homes.hint("merge").join(all_, ["anchor"]).where(close & (F.col("a") != F.col("b")))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that is reachable, for every node
    of an edge (a, b). Large-star and small-star steps until nothing changes;
    each step is one aggregation and one join, and paths shrink to stars in
    about log(path length) rounds."""
    pairs = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(),
                    "edges")
    state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while state[0]:
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(low.select("u", F.col("m").alias("v"))).where("u <> v")
                 .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        pairs = written(small, "stars")
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == tuple(state):
            break
        state = now
    return (pairs.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
            .union(pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
                    bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, text_hash, fp, component, component_id) per row; ``component_id``
    is the smallest document id that is reachable over links of at most ``bits``
    bits (null where no row of the group has an id), ``component`` the smallest
    fingerprint."""
    prints = written(fingerprints(docs, text, key, shingle), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")), "distinct")
    found = components(links(distinct, bits))
    member = distinct.join(found, distinct["fp"] == found["node"], "left").select(
        distinct["fp"], "first", F.coalesce("component", distinct["fp"]).alias("component"))
    smallest = member.groupBy("component").agg(F.min("first").alias("component_id"))
    known = member.join(smallest, "component").select("fp", "component", "component_id")
    return prints.join(known, "fp").select("doc_id", "text_hash", "fp", "component", "component_id")


def keep_first(docs: DataFrame, text: str = "text", key: str = "doc_id", shingle: int = SHINGLE,
               bits: int = MAX_BITS) -> DataFrame:
    """Of every group of near-duplicates one row of ``docs``: the smallest id
    (null ids last), then the smallest text hash; of repeated rows any one."""
    found = near_duplicates(docs, text, key, shingle, bits)
    first = found.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("k"))
    first = first.select(F.col("k.doc_id").alias("__first_id"), F.col("k.text_hash").alias("__first_hash"))
    tagged = docs.select(as_row(docs.columns), named(key).cast("long").alias("id"), F.xxhash64(named(text)).alias("hash"))
    kept = tagged.join(first, tagged["id"].eqNullSafe(first["__first_id"]) & (tagged["hash"] == first["__first_hash"]), "left_semi")
    return kept.dropDuplicates(["id", "hash"]).select(*of_row(docs.columns))
