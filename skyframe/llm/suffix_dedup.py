"""Removal of repeated substrings: every byte that lies in a ``LENGTH``-byte string
that starts anywhere else too, in the same document or another.

Sorting the suffixes of the whole corpus is out of reach; but a window of LENGTH
bytes needs comparing only with windows that share its *anchor*, the smallest
hash of a ``GRAM``-byte substring inside it (equal windows have equal anchors at
equal places). So suffixes (window starts) fall into buckets by anchor:

1. Every text is cut into the runs of window starts that share an anchor (about
   two per LENGTH - GRAM bytes). Only (bucket, context hash, place) is shuffled,
   counted per distinct context before the shuffle.
2. A bucket with one occurrence of one context holds no repeats and ends there;
   a context that is alone in its bucket but occurs again is repeated as a whole.
   For the other buckets the context bytes (less than 2 * LENGTH of them) are
   fetched once per *distinct* context, so copies, however many, are one row.
3. One bucket after the other is sorted (*blockwise*): windows by their first and
   last ``PERIOD`` bytes; ties that go deeper are resolved by precomputed ranks of
   the *difference-cover sample*: the positions whose remainder modulo PERIOD lies
   in a difference cover D are ranked by their next LENGTH - PERIOD bytes, and any
   two windows have a common shift below PERIOD that takes both onto sample
   positions, so one look at two ranks decides. Memory is one bounded block of
   buckets, not a suffix array: a bucket of more than HOT_ROWS distinct contexts (a
   frequent passage below LENGTH bytes with ever other neighbours) is not sorted as
   a whole. Its windows become rows dealt out by (bucket, 128-bit digest of the
   window) and counted per digest, so it spreads over all tasks; one window is about
   one row of a context's up to LENGTH - GRAM + 1, and none is left out.
4. A window that equals another one marks its bytes; marks of a document are
   joined, and the kept bytes are cut out.

Texts are UTF-8 bytes, judged on the input. Defined results: a null text is empty;
texts shorter than LENGTH lose nothing; equal texts lose all their bytes when they
have LENGTH bytes or more; rows with null or repeated ids are judged each.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import as_row, carried, join_by_share, named, of_row, packed_rows, ship, written

ship(__name__)

LENGTH = 200
GRAM = 32
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)      # a perfect difference set modulo 31: every remainder is a difference
BLOCK_ROWS = 6000                   # contexts that are sorted together (whole buckets)
HOT_ROWS = 2000                     # contexts of a bucket that is still sorted as a whole
PIECE = 2 << 20                     # bytes of texts handled at once
PLACE_BITS = 24                     # places in a stretch of text whose anchors are found at once
MIX = np.uint64(0x9E3779B97F4A7C15)


def shift_table() -> np.ndarray:
    """SHIFT[i, j]: the least s below PERIOD with (i + s) and (j + s) in the cover."""
    inside = np.zeros(PERIOD, dtype=bool)
    inside[list(COVER)] = True
    i, j, s = np.ogrid[:PERIOD, :PERIOD, :PERIOD]
    return np.argmax(inside[(i + s) % PERIOD] & inside[(j + s) % PERIOD], axis=2)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes from every position (GRAM is a power of
    two: the hash of 2m bytes comes from the two halves)."""
    table = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    h, m = table[data], 1
    while m < GRAM:
        base = np.uint64(pow(0xD6E8FEB86659FD93, m, 1 << 64))
        h = h[:-m] * base + h[m:]
        m *= 2
    h ^= h >> np.uint64(29)
    h *= MIX
    h ^= h >> np.uint64(32)
    return h


def window_runs(data: np.ndarray, ends: np.ndarray):
    """Runs of window starts that share an anchor, for concatenated texts that
    end at ``ends``: (anchor hash, first window start, last window start)."""
    most = (1 << PLACE_BITS) - LENGTH
    parts = []
    for lo in range(0, max(len(data) - LENGTH + 1, 0), most):       # a very long text goes in stretches
        part = data[lo:lo + most + LENGTH - 1]
        h = gram_hashes(part)
        width = LENGTH - GRAM + 1
        low = np.uint64((1 << PLACE_BITS) - 1)
        key = (h & ~low) | np.arange(len(h), dtype=np.uint64)       # ties go to the leftmost place
        m = 1
        while 2 * m <= width:
            key = np.minimum(key[:-m], key[m:])
            m *= 2
        key = np.minimum(key[:len(key) - (width - m)], key[width - m:])
        owner = (key & low).astype(np.int64)
        start = lo + np.arange(len(owner))
        stop = ends[np.searchsorted(ends, start, side="right").clip(max=len(ends) - 1)]
        valid = start + LENGTH <= stop                              # windows never cross texts
        change = owner[1:] != owner[:-1]
        first, last = valid.copy(), valid.copy()
        first[1:] &= ~valid[:-1] | change
        last[:-1] &= ~valid[1:] | change
        a, b = np.flatnonzero(first), np.flatnonzero(last)
        parts.append((h[owner[a]], lo + a, lo + b))
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*parts))


def block_hashes(data: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[a:b] per row: differences of the prefix sums of
    value * BASE^place, moved to place 0 by the inverse of BASE^a (modulo 2^64)."""
    base = 0xD1342543DE82EF95
    values = np.random.default_rng(977).integers(1, 1 << 63, 256, dtype=np.uint64)
    power = np.full(len(data) + 1, base, dtype=np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * power[:-1], out=sums[1:])
    back = np.full(len(data) + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
    back[0] = 1
    back = np.cumprod(back, dtype=np.uint64)
    out = (sums[b] - sums[a]) * back[a]
    out ^= out >> np.uint64(31)
    return out * MIX + (b - a).astype(np.uint64)


def _texts(part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = [x or b"" for x in part.column("raw").to_pylist()]
    sizes = np.array([len(x) for x in raw], dtype=np.int64)
    ends = np.cumsum(sizes)
    return np.frombuffer(b"".join(raw), dtype=np.uint8), ends - sizes, ends


def runs_of_texts(batches):
    """(bucket, context, u, place): per run of windows its anchor hash, the hash
    of its bytes, the text it is in, and first window * 2^16 + windows."""
    for batch in batches:
        for part in packed_rows(batch, PIECE, "raw"):
            data, starts, ends = _texts(part)
            bucket, a, b = window_runs(data, ends)
            if not len(a):
                continue
            row = np.searchsorted(ends, a, side="right")
            context = block_hashes(data, a, b + LENGTH)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.view(np.int64)), pa.array(context.view(np.int64)), part.column("u").take(pa.array(row)),
                 pa.array(((a - starts[row]) << 16) + (b - a + 1))], names=["bucket", "context", "u", "place"])


def contexts_of_texts(batches):
    """(bucket, context, copies, bytes) for the runs that a text is asked for."""
    names = ["bucket", "context", "copies", "bytes"]
    for batch in batches:
        for part in packed_rows(batch, PIECE, "raw"):
            raw, held = part.column("raw").to_pylist(), []
            for r, asked in enumerate(part.column("asked").to_pylist()):
                for x in asked:
                    at, n = x["place"] >> 16, x["place"] & 0xFFFF
                    held.append((x["bucket"], x["context"], x["copies"], raw[r][at:at + n + LENGTH - 1]))
                if len(held) > 20000 or r == part.num_rows - 1:
                    types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([h[k] for h in held], t) for k, t in enumerate(types)], names=names)
                    held = []


def windows_of_texts(batches):
    """(bucket, context, copies, at, digest): every window of the runs that a
    text is asked for."""
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    for batch in contexts_of_texts(batches):
        for lo in range(0, batch.num_rows, 500):
            part = batch.slice(lo, 500)
            rows = []
            for b, c, n, block in zip(*(part.column(k).to_pylist() for k in ("bucket", "context", "copies", "bytes"))):
                rows += [(b, c, n, at, hashlib.blake2b(block[at:at + LENGTH], digest_size=16).digest())
                         for at in range(len(block) - LENGTH + 1)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                             names=["bucket", "context", "copies", "at", "digest"])


def _rows_of(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` bytes from every position as one fixed-size string each."""
    view = np.lib.stride_tricks.sliding_window_view(data, size)[at]
    return np.ascontiguousarray(view).view(f"S{size}").ravel()


def repeated_windows(bucket: np.ndarray, blocks: list[bytes]) -> list[np.ndarray]:
    """Per context: which of its windows equal a window of another context of
    the same bucket (or another window of their own).

    Suffixes of all contexts are ordered by (bucket, first PERIOD bytes, last
    PERIOD bytes); what is still tied is split by pivots, comparing the ranks of
    difference-cover samples at the common shift of window and pivot."""
    size = np.array([len(x) for x in blocks], dtype=np.int64)
    start = np.cumsum(size) - size
    data = np.frombuffer(b"".join(blocks), dtype=np.uint8)
    count = size - LENGTH + 1
    out = np.zeros(int(count.sum()), dtype=bool)
    owner = np.repeat(np.arange(len(blocks)), count)
    first = np.cumsum(count) - count
    place = np.arange(len(owner)) - first[owner]                # window start inside its context
    at = start[owner] + place
    # ranks of the cover sample: LENGTH - PERIOD bytes from every position of the cover
    deep = LENGTH - PERIOD
    spots = size - deep + 1
    holder = np.repeat(np.arange(len(blocks)), spots)
    spot = np.arange(len(holder)) - (np.cumsum(spots) - spots)[holder]
    chosen = np.isin(spot % PERIOD, COVER)
    sample = (start[holder] + spot)[chosen]
    _, rank = np.unique(_rows_of(data, sample, deep), return_inverse=True)
    rank_at = np.full(len(data), -1, dtype=np.int64)
    rank_at[sample] = rank
    # groups of windows with equal bucket and equal first and last PERIOD bytes
    head = _codes(data, at)
    tail = _codes(data, at + LENGTH - PERIOD)
    order = np.lexsort((tail, head, bucket[owner]))
    same = np.zeros(len(order), dtype=bool)
    x, y = order[1:], order[:-1]
    same[1:] = (head[x] == head[y]) & (tail[x] == tail[y]) & (bucket[owner[x]] == bucket[owner[y]])
    group = np.cumsum(~same) - 1
    shift = shift_table()
    active, group = order, group
    while len(active):
        n = np.bincount(group)
        some = n[group] > 1                                     # a window alone is no repeat
        active, group = active[some], group[some]
        if not len(active):
            break
        _, heads, group = np.unique(group, return_index=True, return_inverse=True)
        pivot = active[heads][group]
        s = shift[place[active] % PERIOD, place[pivot] % PERIOD]
        mine, theirs = rank_at[at[active] + s], rank_at[at[pivot] + s]
        equal = mine == theirs
        hits = np.bincount(group, weights=equal).astype(np.int64)
        out[active[equal & (hits[group] > 1)]] = True
        rest = ~equal                                           # the others: smaller and larger ones apart
        active, group = active[rest], 2 * group[rest] + (mine > theirs)[rest]
        _, group = np.unique(group, return_inverse=True)
        turn = np.argsort(group, kind="stable")
        active, group = active[turn], group[turn]
    return np.split(out, first[1:]) if len(first) else []


def _codes(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Dense ranks of the PERIOD bytes from every position."""
    return np.unique(_rows_of(data, at, PERIOD), return_inverse=True)[1]


def sorted_buckets(batches):
    """(bucket, context, windows): rows come sorted by bucket; whole buckets are
    gathered to blocks of less than BLOCK_ROWS + HOT_ROWS contexts and sorted."""
    def emit(buckets, contexts, copies, blocks):
        found = repeated_windows(np.array(buckets, dtype=np.int64), blocks)
        b, c, spans = [], [], []
        for k, own in enumerate(found):
            if copies[k] > 1:
                own = np.ones(len(own), dtype=bool)             # the context itself stands elsewhere too
            if own.any():
                edge = np.flatnonzero(np.diff(np.concatenate([[0], own.view(np.int8), [0]])))
                b.append(buckets[k])
                c.append(contexts[k])
                spans.append(edge.astype(np.int32))
        return pa.RecordBatch.from_arrays([pa.array(b, pa.int64()), pa.array(c, pa.int64()), pa.array(spans, pa.list_(pa.int32()))],
                                          names=["bucket", "context", "windows"])

    held: tuple[list, list, list, list] = ([], [], [], [])
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in ("bucket", "context", "copies", "bytes"))):
            if len(held[0]) >= BLOCK_ROWS and row[0] != held[0][-1]:
                yield emit(*held)
                held = ([], [], [], [])
            for column, value in zip(held, row):
                column.append(value)
    if held[0]:
        yield emit(*held)


def _edges(ats: str) -> Column:
    """[a, b, a, b, ...]: the runs [a, b) of sorted distinct numbers."""
    starts = F.filter(ats, lambda x, i: (i == 0) | (F.get(F.col(ats), i - 1) < x - 1))
    ends = F.transform(F.filter(ats, lambda x, i: (i == F.size(ats) - 1) | (F.get(F.col(ats), i + 1) > x + 1)), lambda x: x + 1)
    return F.flatten(F.zip_with(starts, ends, lambda a, b: F.array(a, b)))


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(u, spans): per text (u, raw) with repeats, the byte ranges [start, end,
    start, end, ...] that its repeated windows cover."""
    # not written: finding the runs twice costs less than a table of them all
    runs = texts.where(F.octet_length("raw") >= LENGTH).select("raw", "u").mapInArrow(
        runs_of_texts, "bucket long, context long, u long, place long")
    # buckets with two runs or more; mixed: of different contexts
    buckets = (runs.groupBy("bucket").agg(F.count("*").alias("n"), F.min("context").alias("lo"), F.max("context").alias("hi"))
               .where("n > 1").select("bucket", "n", (F.col("lo") != F.col("hi")).alias("mixed")))
    # a bucket of a large share of the runs is spread over all tasks
    live = written(join_by_share(runs, written(buckets, "buckets"), "bucket", "n").where(F.col("mixed").isNotNull())
                   .select("bucket", "context", "u", "place", "mixed"), "live")
    # distinct contexts, combined before the shuffle, each with one text that holds it
    contexts = written(live.groupBy("bucket", "context", "mixed").agg(
        F.count("*").alias("copies"), F.min("u").alias("u"), F.min_by("place", "u").alias("place")), "contexts")
    several = contexts.where("mixed")
    hot = written(several.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > HOT_ROWS).select("bucket"), "hot")
    crowded = several.join(hot, "bucket", "left_semi")

    def whole(rows):
        return rows.select("bucket", "context", F.array(
            F.lit(0), F.col("place").bitwiseAND(F.lit(0xFFFF)).cast("int")).alias("windows"))

    def asked(rows):
        # the same exchange of the texts (with all columns) serves these joins and the last one
        wanted = rows.groupBy("u").agg(F.collect_list(F.struct("bucket", "context", "copies", "place")).alias("asked"))
        return texts.join(wanted, "u").select("row", "raw", "asked")

    mixed = (asked(several.join(hot, "bucket", "left_anti"))
             .mapInArrow(contexts_of_texts, "bucket long, context long, copies long, bytes binary")
             .repartition("bucket").sortWithinPartitions("bucket")
             .mapInArrow(sorted_buckets, "bucket long, context long, windows array<int>"))
    found = whole(contexts.where("not mixed")).unionByName(mixed)
    if not hot.isEmpty():
        windows = asked(crowded).mapInArrow(
            windows_of_texts, "bucket long, context long, copies long, at int, digest binary")
        marked = (windows.withColumn("n", F.count("*").over(Window.partitionBy("bucket", "digest")))
                  .where("n > 1 AND copies = 1").groupBy("bucket", "context")
                  .agg(F.sort_array(F.collect_list("at")).alias("ats"))
                  .select("bucket", "context", _edges("ats").alias("windows")))
        # a context that stands elsewhere too is repeated as a whole
        found = found.unionByName(whole(crowded.where("copies > 1"))).unionByName(marked)
    # windows [a, b) of a run cover the bytes [at + a, at + b + LENGTH - 1)
    at = F.shiftright("place", 16)
    spans = F.transform("windows", lambda x, i: at + x + F.when(i % 2 == 1, F.lit(LENGTH - 1)).otherwise(F.lit(0)))
    return (live.join(found, ["bucket", "context"]).select("u", spans.alias("spans"))
            .groupBy("u").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def cut(raw: bytes, spans: list[int]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal removed runs, the rest) for ranges [s, e, s, e, ...]."""
    pairs = sorted(zip(spans[::2], spans[1::2]))
    kept, at, removed, n = [], 0, 0, 0
    end = -1
    for s, e in pairs:
        if s > end:
            n += 1
            kept.append(raw[at:s])
            removed += e - s
            end = at = e
        elif e > end:
            removed += e - end
            end = at = e
    kept.append(raw[at:])
    return removed, n, b"".join(kept)


def remove_repeats(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: all) plus n_bytes, n_removed, n_spans, kept
    (binary) and kept_sha256. Columns of ``docs`` named like new ones are replaced."""
    new = ["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    cols = [c for c in (keep if keep is not None else docs.columns) if c not in new]
    raw = F.coalesce(named(text), F.lit("")).cast("binary")
    # ids may be null or repeated: a text is known by its place in the input
    rows = docs.select(as_row(cols), raw.alias("raw"), F.monotonically_increasing_id().alias("u"))
    spans = repeated_spans(rows)

    def apply(batches):
        for batch in batches:
            for part in packed_rows(batch, PIECE, "raw"):
                got = []
                for b, own in zip(*(part.column(n).to_pylist() for n in ("raw", "spans"))):
                    removed, n, rest = cut(b, own or [])
                    got.append((len(b), removed, n, rest, hashlib.sha256(rest).hexdigest()))
                types = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([part.column("row")] + [pa.array([g[k] for g in got], t) for k, t in enumerate(types)],
                                                 names=["row", *new])

    joined = rows.join(spans, "u", "left").select("row", "raw", "spans")
    out = joined.mapInArrow(apply, carried(rows, "row", "n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"))
    return out.select(*of_row(cols), *new)
