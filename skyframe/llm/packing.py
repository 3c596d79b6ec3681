"""Best-fit packing of token pieces into sequences of a fixed capacity.

Documents are tokenised, closed with the end id 0 and cut into pieces only where
they are longer than the capacity. The plan works on the *histogram* of piece
lengths (at most ``capacity`` counts, whatever the number of documents):

1. exact complements: from the longest length down, the gap it leaves is looked
   up in an index of single lengths, pair sums and triple sums
   (:class:`SumIndex`), and combinations that fill the gap exactly are consumed
   as often as the availability counts allow;
2. what is left is packed best fit: the longest length first, the gap filled by
   the longest available length that fits, again and again.

A plan line (*pattern*) says which lengths share a sequence and how many such
sequences there are. Each consumption uses up some length, so the plan has few
thousand lines at most. Pieces are numbered within their length (counts per salt
and length; a length has one salt more per ``SALT_ROWS`` pieces, so that the
commonest length is spread over as many tasks as it needs) and the plan line of a
number gives its sequence and offset.

Defined results: a null text counts as empty; an empty document is one piece of
length 1 (its end id); repeated rows are packed each; no rows give no plan.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import as_row, carried, freed, named, of_row, packed_rows, ship, written

ship(__name__)

CAPACITY = 2048
SALTS = 16                  # numbering of a length is spread over so many groups at least,
SALT_ROWS = 1 << 16         # and over one more per so many pieces
CACHE = 300_000             # texts between blanks (and words) whose ids a task remembers
BLOCK = 8 << 20             # bytes of text whose distinct parts are looked up together
END = b"\0\0\0\0"

# Fixed value: the word pattern that the tokenizer file states.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


# How the file spells bytes: visible Latin-1 characters stand for themselves, the
# other bytes, in order, are the characters from 256 on.
_SHOWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
VISIBLE = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _SHOWN)}


class WordTokenizer:
    """Ids of the tokenizer file, remembered per word.

    No token of this vocabulary crosses white space, so a text is the
    concatenation of its parts between ASCII blanks. Parts of visible Latin-1
    characters (nothing to compose) are lower-cased and split by the file's word
    pattern here; every other part, and every part that holds an added token of
    the file ('<|endoftext|>'), goes to the library. New words go to the merge
    model of the file, spelled in the visible characters it has for bytes."""

    def __init__(self, path: str):
        import os
        import regex
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = regex.compile(WORD + "| ")
        added = [regex.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.other = regex.compile("|".join([r"[^ -~\xa1-\xff]", *added]))
        self.words: dict[str, bytes] = {}
        self.parts: dict[bytes, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def _learn_words(self, new: list[str]) -> None:
        tokens = self.tokenizer.model.tokenize
        for lo in range(0, len(new), 1 << 7):              # the merge model's answers are large objects
            words = new[lo:lo + (1 << 7)]
            spelled = words
            if not "".join(words).isascii():
                spelled = [w if w.isascii() else w.encode("utf-8").decode("latin-1").translate(VISIBLE) for w in words]
            found = list(map(tokens, spelled))
            raw = np.array([t.id for ts in found for t in ts], dtype="<u4").tobytes()
            ends = (4 * np.cumsum(list(map(len, found)), dtype=np.int64)).tolist()
            self.words.update(zip(words, [raw[a:b] for a, b in zip([0, *ends], ends)]))

    def _learn(self, parts: list[bytes]) -> None:
        plain = [p for p in parts if p.isalpha()]           # ASCII letters: one word, only to be lower-cased
        if plain:
            words = b" ".join(plain).lower().decode("ascii").split(" ")
            self._learn_words(list(set(words).difference(self.words)))
            self.parts.update(zip(plain, map(self.words.__getitem__, words)))
            parts = [p for p in parts if not p.isalpha()]
        joined = b" ".join(parts).decode("utf-8")
        if self.other.search(joined):
            texts = joined.split(" ")
            for p, t in zip(parts, texts):
                if self.other.search(t):
                    self.parts[p] = self._ids(t).tobytes()
            parts = [p for p, t in zip(parts, texts) if p not in self.parts]
            joined = b" ".join(parts).decode("utf-8")
        if not parts:
            return
        pieces = self.pieces.findall(joined.lower())
        self._learn_words(list(set(pieces).difference(self.words, (" ",))))
        self.words[" "] = b""                               # a part ends where no id is added
        ids = list(map(self.words.__getitem__, pieces))
        raw = b"".join(ids)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        ends = [*np.cumsum(sizes)[sizes == 0].tolist(), len(raw)]
        self.parts.update(zip(parts, [raw[a:b] for a, b in zip([0, *ends], ends)], strict=True))

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text (null: none) as little-endian 32-bit integers.

        Parts are looked up once per distinct part of the block; their ids are
        then gathered into one buffer, in which a text is a slice."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
        parts = split.flatten().cast(pa.large_binary()).dictionary_encode()
        used = parts.dictionary.to_pylist()
        known = list(map(self.parts.get, used))
        unknown = [p for p, ids in zip(used, known) if ids is None]
        if len(self.parts) + len(unknown) > CACHE:          # forget, but keep what this block needs
            self.parts = {p: ids for p, ids in zip(used, known) if ids is not None}
        if len(self.words) > CACHE:
            self.words = {}
        if unknown:
            self._learn(unknown)
            known = map(self.parts.__getitem__, used)
        ids = pa.array(known, pa.large_binary()).take(parts.indices)
        _, ends, raw = ids.buffers()
        ends = np.frombuffer(ends, np.int64, len(ids) + 1) if len(ids) else np.zeros(1, np.int64)
        cuts = ends[split.offsets.to_numpy()].tolist()
        return [raw[a:b].to_pybytes() if a < b else b"" for a, b in zip(cuts, cuts[1:])]


def tokenize(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None,
             capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: ``keep`` columns (default: all), ``piece``, ``start``,
    ``length``, ``ids`` (binary) and ``ids_crc32``. Columns of ``docs`` named
    like new ones are replaced."""
    new = ["piece", "start", "length", "ids", "ids_crc32"]
    cols = [c for c in (keep if keep is not None else docs.columns) if c not in new]
    src = docs.select(named(text).alias("text"), as_row(cols))

    def run(batches):
        tokens = WordTokenizer(path)
        for batch in batches:
            for part in packed_rows(batch, BLOCK):
                out: dict[str, list] = {n: [] for n in ("at", *new)}
                for r, ids in enumerate(tokens.encode(part.column("text"))):
                    ids += END
                    for k, lo in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[lo:lo + 4 * capacity]
                        for n, v in zip(out, (r, k, lo // 4, len(cut) // 4, cut, zlib.crc32(cut))):
                            out[n].append(v)
                rows = part.column("row").take(pa.array(out["at"], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [rows, pa.array(out["piece"], pa.int32()), pa.array(out["start"], pa.int64()),
                     pa.array(out["length"], pa.int64()), pa.array(out["ids"], pa.binary()), pa.array(out["ids_crc32"], pa.int64())],
                    names=["row", *new])

    out = src.mapInArrow(freed(run), carried(src, "row", "piece int, start long, length long, ids binary, ids_crc32 long"))
    return out.select(*of_row(cols), *new)


class SumIndex:
    """Sums of one, two and three available lengths, up to the capacity.

    Every pair is stored under its sum, pairs of well supplied lengths first; a
    triple is found under its sum as a single length whose complement is the sum
    of a stored pair. Counts (``have``) only fall while the index is used, so a
    pair at the head of its list that has run out is passed over for good."""

    def __init__(self, have: np.ndarray):
        self.have = have
        capacity = len(have) - 1
        lengths = np.flatnonzero(have)
        one, other = np.nonzero(np.tri(len(lengths), dtype=bool) & (lengths[:, None] + lengths < capacity))
        longer, shorter = lengths[one], lengths[other]
        ok = (longer != shorter) | (have[longer] > 1)
        longer, shorter = longer[ok], shorter[ok]
        order = np.lexsort((-np.minimum(have[longer], have[shorter]), longer + shorter))
        self.longer, self.shorter = longer[order], shorter[order]
        bounds = np.searchsorted(self.longer + self.shorter, np.arange(capacity + 2))
        self.head, self.end = bounds[:-1].copy(), bounds[1:]

    def holds(self, lengths: list[int]) -> bool:
        return all(self.have[x] >= lengths.count(x) for x in set(lengths))

    def single(self, total: int, base: list[int]) -> list[int] | None:
        return [total] if self.holds([*base, total]) else None

    def pair(self, total: int, base: list[int]) -> list[int] | None:
        for k in range(self.head[total], self.end[total]):
            found = [int(self.longer[k]), int(self.shorter[k])]
            if self.holds([*base, *found]):
                return found
            if k == self.head[total] and not self.holds(found):
                self.head[total] += 1
        return None

    def triple(self, total: int, base: list[int]) -> list[int] | None:
        first = np.arange(total - 2, 0, -1)
        for x in first[(self.have[first] > 0) & (self.head < self.end)[total - first]].tolist():
            found = self.pair(total - x, [*base, x])
            if found:
                return [x, *found]
        return None

    def fill(self, total: int, base: list[int]) -> list[int] | None:
        """Lengths of the sum ``total`` that are there beside ``base``, as few as can be."""
        return self.single(total, base) or self.pair(total, base) or self.triple(total, base)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Patterns ``(lengths that share a sequence, number of such sequences)``
    that use up ``counts`` (length -> pieces)."""
    have = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in counts.items():
        have[length] = n
    out: list[tuple[list[int], int]] = []

    def take(lengths: list[int]) -> None:
        need: dict[int, int] = {}
        for x in lengths:
            need[x] = need.get(x, 0) + 1
        times = min(int(have[x]) // k for x, k in need.items())
        for x, k in need.items():
            have[x] -= k * times
        out.append((lengths, times))

    index = SumIndex(have)
    for longest in range(capacity, 0, -1):
        while have[longest] > 0:
            rest = index.fill(capacity - longest, [longest]) if longest < capacity else []
            if rest is None:
                break
            take([longest, *rest])
    for longest in range(capacity, 0, -1):                 # what fills no gap exactly: best fit
        while have[longest] > 0:
            lengths = [longest]
            have[longest] -= 1
            gap = capacity - longest
            while gap > 0:
                fits = np.flatnonzero(have[1:gap + 1])
                if not len(fits):
                    break
                x = int(fits[-1]) + 1
                lengths.append(x)
                have[x] -= 1
                gap -= x
            for x in lengths:
                have[x] += 1
            take(lengths)
    return out


def place(pieces: DataFrame, order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (with a column ``length``; a table that reads the same each
    time) plus ``sequence_id`` and ``offset``. ``order`` names the columns that
    number pieces of one length; they should tell rows apart, also repeated ones.
    Those whose names start with two underscores are left out of the result."""
    own_columns = [c for c in pieces.columns if c not in order or not c.startswith("__")]
    # at most ``capacity`` counts
    totals = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    many = [x for n, c in totals.items() if c >= SALT_ROWS
            for x in (F.lit(n).cast("long"), F.lit(SALTS + c // SALT_ROWS).cast("long"))]
    salts = F.coalesce(F.create_map(*many)[F.col("length")], F.lit(SALTS)) if many else F.lit(SALTS).cast("long")
    salted = pieces.withColumn("__salt", F.pmod(F.xxhash64(*order), salts).cast("int"))
    # pieces with a smaller salt of the same length; distributed like the numbering
    # below, so either this small side is broadcast or one exchange serves both
    before = salted.groupBy("length", "__salt").agg(F.count("*").alias("n")).select("length", "__salt", (F.sum("n").over(
        Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("__before"))
    lines, first, used = [], 0, {}
    for lengths, times in plan(totals, capacity):
        at = 0
        for slot, length in enumerate(lengths):
            # the slots of one length in one pattern take runs of numbers one after the other
            lo = used.get(length, 0)
            lines.append((length, lo, first, at))
            used[length] = lo + times
            at += length
        first += times
    by_length: dict[int, np.ndarray] = {}
    for length in used:                                     # lines of a length come in the order of their numbers
        by_length[length] = np.array([x[1:] for x in lines if x[0] == length], dtype=np.int64)
    numbered = (salted.join(before, ["length", "__salt"])
                .withColumn("__rank", F.col("__before") + F.row_number().over(
                    Window.partitionBy("length", "__salt").orderBy(*order)) - 1)
                .select(as_row(own_columns), "length", "__rank"))

    def assign(batches):
        for batch in batches:
            length, rank = (np.asarray(batch.column(c)) for c in ("length", "__rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for x in np.unique(length):
                at, own = np.flatnonzero(length == x), by_length[int(x)]
                line = own[np.searchsorted(own[:, 0], rank[at], side="right") - 1]
                sequence[at] = line[:, 1] + rank[at] - line[:, 0]
                offset[at] = line[:, 2]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(sequence), pa.array(offset)],
                                             names=["row", "sequence_id", "offset"])

    placed = numbered.mapInArrow(assign, carried(numbered, "row", "sequence_id long, offset long"))
    return placed.select(*of_row(own_columns), "sequence_id", "offset")


def pack(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id", keep: list[str] | None = None,
         capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Tokenise, cut and pack: one row per piece with its sequence and offset."""
    pieces = tokenize(docs, path, text, keep if keep is not None else [key], capacity)
    if not with_ids:
        pieces = pieces.drop("ids")
    # written with a number of its own per row: repeated rows spread over the salts too
    pieces = written(pieces.withColumn("__row_number", F.monotonically_increasing_id()), "pieces")
    return place(pieces, ["__row_number"], capacity)
