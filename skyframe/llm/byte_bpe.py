"""Byte-level BPE encoding and decoding with public merge ranks.

Long texts are cut into overlapping chunks that are pre-tokenised in parallel.
A chunk that starts inside a pre-token may begin with wrong boundaries, but from
the first position where its boundaries meet those of the chunk before it
(*resynchronise*) both agree; there the chunks are stitched. Where an overlap
holds no common boundary (a very long run without one), the stitcher goes on
matching from the last certain boundary until it meets the next chunk's. The
pieces are then encoded one by one: merge the adjacent pair of lowest rank,
leftmost first, until none is left. Decoding concatenates the bytes of the ids.

Texts of one chunk never leave their task; only chunks of longer texts are
shuffled, by (text, chunk) for matching and by text for stitching.

Defined results: a null text is empty; an empty text has no tokens; repeated rows
are encoded each.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_row, carried, named, of_row, packed_rows, ship

ship(__name__)

CHUNK = 16384               # code points of a chunk
OVERLAP = 512               # more of them, shared with the next chunk
CACHE = 400_000             # pieces whose ids a task remembers
SHORT = 48                  # bytes of a piece that is merged together with others


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: repeatedly merge the adjacent pair of the lowest
    rank (the leftmost among equals). Parts are a linked list, candidate pairs a
    heap, so a long piece costs n log n."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    after = list(range(1, n + 1))           # start of the next part
    before = list(range(-1, n - 1))         # start of the part before
    end = list(range(1, n + 1))             # end of the part that starts here
    alive = [True] * n
    heap = []
    for i in range(n - 1):
        r = ranks.get(piece[i:i + 2])
        if r is not None:
            heap.append((r, i, i + 2))
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or j >= n or end[j] != stop:
            continue                        # one of the two parts has changed since
        alive[j] = False
        end[i] = stop
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
            r = ranks.get(piece[i:end[after[j]]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[after[j]]))
        h = before[i]
        if h >= 0:
            r = ranks.get(piece[h:stop])
            if r is not None:
                heapq.heappush(heap, (r, h, stop))
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


class Merges:
    """Merges many short pieces at a time. Symbols of all pieces lie in one array;
    a round merges, in every piece that still can, its adjacent pair of lowest
    rank (the leftmost), and looks up only the pairs that the merge made."""

    NONE = (1 << 32) - 1

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for whole, rank in ranks.items():
            for i in range(1, len(whole)):
                left = ranks.get(whole[:i])
                if left is not None:
                    right = ranks.get(whole[i:])
                    if right is not None:
                        keys.append(left << 32 | right)
                        values.append(rank)
        self.keys, self.values = np.array(keys, dtype=np.int64), np.array(values, dtype=np.int64)
        order = np.argsort(self.keys)
        self.keys, self.values = np.append(self.keys[order], np.iinfo(np.int64).max), np.append(self.values[order], self.NONE)
        self.first = np.array([ranks[bytes([c])] for c in range(256)], dtype=np.int64)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.values[at], self.NONE)

    def __call__(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece (none is empty) as little-endian 32-bit integers."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        symbol = self.first[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        own = np.repeat(np.arange(len(pieces)), sizes)
        rank = np.full(len(symbol), self.NONE, dtype=np.int64)
        inner = np.flatnonzero(own[1:] == own[:-1])
        rank[inner] = self._rank(symbol[inner], symbol[inner + 1])
        done_own, done = [], []
        while len(own):
            start = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            length = np.diff(np.append(start, len(own)))
            least = np.repeat(np.minimum.reduceat(rank, start), length)
            over = least == self.NONE                       # nothing left to merge in these pieces
            done_own.append(own[over])
            done.append(symbol[over])
            rest = ~over
            symbol, own, rank, least = symbol[rest], own[rest], rank[rest], least[rest]
            at = np.flatnonzero(rank == least)
            if not len(at):
                break
            at = at[np.append(True, own[at][1:] != own[at][:-1])]
            symbol[at] = rank[at]                           # the id of a token is its rank
            stays = np.ones(len(own), dtype=bool)
            stays[at + 1] = False
            symbol, own, rank = symbol[stays], own[stays], rank[stays]
            at = at - np.arange(len(at))                    # each merge before took one symbol away
            changed = np.concatenate([at, at[at > 0] - 1])
            last = np.minimum(changed + 1, len(own) - 1)
            pair = (own[last] == own[changed]) & (last > changed)
            rank[changed] = self.NONE
            rank[changed[pair]] = self._rank(symbol[changed[pair]], symbol[changed[pair] + 1])
        own, symbol = np.concatenate(done_own or [own]), np.concatenate(done or [symbol])
        order = np.argsort(own, kind="stable")
        raw = symbol[order].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(own, minlength=len(pieces)))).tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Merge ranks, the pre-token pattern, and a bounded memory of pieces."""

    def __init__(self, ranks_path: str, pattern: str):
        import regex
        self.ranks = load_ranks(ranks_path)
        self.pattern = regex.compile(pattern)
        self.merges = Merges(self.ranks)
        self.known: dict[str, bytes] = {}
        tokens = sorted(self.ranks, key=self.ranks.get)
        self.size = np.zeros(max(self.ranks.values(), default=0) + 1, dtype=np.int64)
        self.size[[self.ranks[t] for t in tokens]] = [len(t) for t in tokens]
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def _learn(self, pieces: set[str]) -> None:
        """Remember the ids of pieces not met before."""
        if len(self.known) + len(pieces) > CACHE:
            self.known = {}
        new = list(pieces.difference(self.known))
        raw = [p.encode("utf-8") for p in new]
        short = [i for i, b in enumerate(raw) if len(b) <= SHORT]
        self.known.update(zip([new[i] for i in short], self.merges([raw[i] for i in short])))
        for p, b in zip(new, raw):
            if len(b) > SHORT:
                merged = merge(b, self.ranks)
                self.known[p] = struct.pack(f"<{len(merged)}I", *merged)

    def encode_all(self, found: list[list[str]]) -> list[bytes]:
        """The ids of each list of pieces as little-endian 32-bit integers."""
        pieces = list(itertools.chain.from_iterable(found))
        self._learn(set(pieces))
        ids = list(map(self.known.__getitem__, pieces))
        raw = b"".join(ids)
        sizes = np.append(0, np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))))
        ends = sizes[np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))].tolist()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def encode_pieces(self, pieces: list[str]) -> bytes:
        return b"".join(b for lo in range(0, len(pieces), CACHE // 2) for b in self.encode_all([pieces[lo:lo + CACHE // 2]]))

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the ids, concatenated; a block of ids at a time."""
        out = []
        for lo in range(0, len(ids), 1 << 20):
            own = np.frombuffer(ids[lo:lo + (1 << 20)], dtype="<u4")
            size = self.size[own]
            ends = np.cumsum(size)
            out.append(self.bytes[np.repeat(self.start[own] - ends + size, size) + np.arange(ends[-1])].tobytes())
        return b"".join(out)


def boundaries(chunk: str, pattern) -> list[int]:
    """Starts of the pre-tokens of a chunk, and its end."""
    at = [m.start() for m in pattern.finditer(chunk)]
    at.append(len(chunk))
    return at


def stitch(text: str, chunks: list[tuple[int, int, list[int]]], pattern) -> list[int]:
    """Boundaries of the whole text from those of its overlapping chunks
    ``(start, end, boundaries relative to start)`` in order.

    A boundary of the first chunk is certain when the text after it that the
    pattern can look at lies inside the chunk; the last pre-token of a chunk
    that is not the last one is not certain."""
    start, end, own = chunks[0]
    out = [start + b for b in own]
    for start, end, own in chunks[1:]:
        stop = out.pop()                            # the end of a chunk need not be a boundary of the text
        while len(out) > 1 and out[-1] > stop - 2:
            out.pop()
        if len(out) > 1:                            # nor is the end of its last pre-token certain
            out.pop()
        mine = {start + b for b in own}
        meet, k = None, len(out) - 1
        while k >= 0 and out[k] >= start:
            if out[k] in mine:
                meet = k
            k -= 1
        if meet is None:                            # go on from the last certain boundary until they meet
            while out[-1] < end and out[-1] not in mine:
                out.append(pattern.match(text, out[-1]).end())
            meet = len(out) - 1
        at = out[meet]
        if at < end:
            del out[meet:]
            out.extend(start + b for b in own if start + b >= at)
    return out


def _digest(ids: bytes, encoder: Encoder):
    return (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(encoder.decode(ids)).hexdigest())


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep: list[str] | None = None,
           with_ids: bool = True, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``keep`` columns (default: all) plus ``n_tokens``, ``ids`` (binary,
    little-endian 32-bit; null unless ``with_ids``), ``ids_sha256`` and
    ``decoded_sha256`` (of the decoded bytes). Columns of ``docs`` named like
    new ones are replaced."""
    new = ["n_tokens", "ids", "ids_sha256", "decoded_sha256"]
    cols = [c for c in (keep if keep is not None else docs.columns) if c not in new]
    src = docs.select(F.coalesce(named(text), F.lit("")).alias("text"), as_row(cols))
    fields = carried(src, "row", "n_tokens long, ids binary, ids_sha256 string, decoded_sha256 string")

    def result(rows, ids, encoder):
        digests = [_digest(x, encoder) for x in ids]
        return pa.RecordBatch.from_arrays(
            [rows, pa.array([d[0] for d in digests], pa.int64()), pa.array(ids if with_ids else [None] * len(ids), pa.binary()),
             pa.array([d[1] for d in digests], pa.string()), pa.array([d[2] for d in digests], pa.string())],
            names=["row", *new])

    def whole(batches):
        encoder = Encoder(ranks_path, pattern)
        for batch in batches:
            for part in packed_rows(batch, 2 << 20):
                yield result(part.column("row"), encoder.encode_all([encoder.pattern.findall(t) for t in part.column("text").to_pylist()]), encoder)

    def match(batches):
        import regex
        compiled = regex.compile(pattern)
        for batch in batches:
            for part in packed_rows(batch, column="chunk"):
                found = [boundaries(c, compiled) for c in part.column("chunk").to_pylist()]
                yield part.append_column("bounds", pa.array(found, pa.list_(pa.int32())))

    def join(batches):
        encoder = Encoder(ranks_path, pattern)
        for batch in batches:
            for one in range(batch.num_rows):
                part = batch.slice(one, 1)
                parts = sorted(part.column("parts").to_pylist()[0], key=lambda p: p["start"])
                text = "".join(p["chunk"][:chunk] for p in parts[:-1]) + parts[-1]["chunk"]
                cuts = stitch(text, [(p["start"], p["start"] + len(p["chunk"]), p["bounds"]) for p in parts], encoder.pattern)
                ids = encoder.encode_pieces([text[a:b] for a, b in zip(cuts, cuts[1:])])
                yield result(part.column("row"), [ids], encoder)

    def cut(batches):
        for batch in batches:
            for one in range(batch.num_rows):
                part = batch.slice(one, 1)
                t = part.column("text")[0].as_py()
                starts = range(0, len(t) - overlap, chunk)
                for lo in range(0, len(starts), 64):
                    some = starts[lo:lo + 64]
                    rows = part.column("row").take(pa.array([0] * len(some), pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [rows, pa.array(part.column("key").to_pylist() * len(some), pa.int64()), pa.array(some, pa.int64()),
                         pa.array([t[s:s + chunk + overlap] for s in some], pa.string())],
                        names=["row", "key", "start", "chunk"])

    size = F.length("text")
    short = src.where(size <= chunk + overlap).mapInArrow(whole, fields)
    # ids may be null or repeated, so the key of a long text is made from the row's place in the input
    long = src.where(size > chunk + overlap).withColumn("key", F.monotonically_increasing_id())
    chunks = (long.mapInArrow(cut, carried(src, "row", "key long, start long, chunk string"))
              .withColumn("row", F.when(F.col("start") == 0, F.col("row")))
              .repartition("key", "start"))
    matched = chunks.mapInArrow(match, carried(chunks, "row", "key long, start long, chunk string, bounds array<int>"))
    stitched = (matched.groupBy("key").agg(F.max_by("row", -F.col("start")).alias("row"),
                                           F.collect_list(F.struct("start", "chunk", "bounds")).alias("parts"))
                .mapInArrow(join, fields))
    out = short.unionByName(stitched)
    return out.select(*of_row(cols), *new)
