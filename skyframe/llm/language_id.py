"""Language identification with a string kernel.

A text is the set of its letter n-grams of length 1 to 3 (a blended-spectrum
*presence* kernel): ``k(x, y) = |X & Y| / sqrt(|X| |Y|)``. Landmark texts, drawn
per language from the labelled rows, give the Nystroem features
``phi(x) = k(x, landmarks) K_mm^(-1/2)``; a kernel ridge regression per language
(one versus rest) is fitted on those features from Gram sums that Spark adds up
over the training rows. Prediction packs the presence vectors of many texts into
one matrix and scores them with two matrix products per block.

Memory per task: one block of texts (``BLOCK_BYTES``), one presence matrix of
``BLOCK_ROWS`` x landmark n-grams, and one n-gram table of 2^18 flags.

Defined results: a null text, or one without any letter, gets ``und`` and score
0. Without labelled rows every text gets ``und`` and score 0. Ties between
languages go to the alphabetically first one. Rows with a null id are scored
like any other; repeated rows are repeated in the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_row, carried, freed, named, of_row, packed_rows, ship, text_column

ship(__name__)

UNDETERMINED = "und"
SAMPLE_PER_LANG = 600       # bound of the training sample: expected rows per language
LANDMARKS_PER_LANG = 12     # bound of the landmark texts per language,
LANDMARKS = 768             # lowered where all languages together would have more (one each at least)
RIDGE = 1e-3
BLOCK_BYTES = 4 << 20
BLOCK_ROWS = 128
SYMBOLS = 64                # 0: no letter; 1..55: frequent letters; 56..63: other letters by code block
FREQUENT = 55


def letter_table(landmark_texts: list[str]) -> np.ndarray:
    """Code point -> symbol. Lower-cased letters; the most frequent letters of
    the landmark texts have a symbol of their own."""
    counts: dict[str, int] = {}
    for t in landmark_texts:
        for c in t.lower():
            if c.isalpha():
                counts[c] = counts.get(c, 0) + 1
    own = sorted(counts, key=lambda c: (-counts[c], c))[:FREQUENT]
    symbol = {c: i + 1 for i, c in enumerate(own)}
    table = np.zeros(0x110000, dtype=np.int32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            low = c.lower()[0]
            table[cp] = symbol.get(low, FREQUENT + 1 + (ord(low) >> 7) % (SYMBOLS - FREQUENT - 1))
    return table


def presence(text: str | None, table: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Sorted codes of the distinct n-grams (n = 1..3) that hold a letter. Runs
    of characters that are no letters count as one gap symbol."""
    if not text:
        return np.zeros(0, dtype=np.int64)
    s = table[np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)]
    keep = np.ones(len(s), dtype=bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    s = s[keep]
    s = np.concatenate([[0], s, [0, 0]])
    if not s.any():
        return np.zeros(0, dtype=np.int64)
    two = s[:-1] * SYMBOLS + s[1:]
    three = two[:-1] * SYMBOLS + s[2:]
    flags[three] = True
    tri = np.flatnonzero(flags)
    flags[tri] = False
    # every 1-gram and 2-gram with a letter stands at the head of some 3-gram
    bi = np.unique(tri // SYMBOLS)
    uni = np.unique(bi // SYMBOLS)
    uni = uni[uni > 0]
    base = SYMBOLS ** 3
    return np.concatenate([tri, base + bi, base + SYMBOLS ** 2 + uni])


class Landmarks:
    """Landmark texts as a vocabulary of n-grams and a presence matrix."""

    def __init__(self, texts: list[str]):
        self.table = letter_table(texts)
        self.flags = np.zeros(SYMBOLS ** 3, dtype=bool)
        sets = [presence(t, self.table, self.flags) for t in texts]
        sets = [x for x in sets if len(x)]
        vocab = np.unique(np.concatenate(sets)) if sets else np.zeros(0, dtype=np.int64)
        size = SYMBOLS ** 3 + SYMBOLS ** 2 + SYMBOLS
        self.column = np.full(size, -1, dtype=np.int32)
        self.column[vocab] = np.arange(len(vocab))
        self.matrix = np.zeros((len(vocab), len(sets)), dtype=np.float32)
        for j, x in enumerate(sets):
            self.matrix[self.column[x], j] = 1.0 / np.sqrt(len(x))
        self.count = len(sets)

    def kernel(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(k(text, landmarks), whether the text has a letter), by matrix
        product over blocks of presence vectors."""
        out = np.zeros((len(texts), self.count), dtype=np.float64)
        some = np.zeros(len(texts), dtype=bool)
        for lo in range(0, len(texts), BLOCK_ROWS):
            part = texts[lo:lo + BLOCK_ROWS]
            block = np.zeros((len(part), self.matrix.shape[0]), dtype=np.float32)
            for r, t in enumerate(part):
                x = presence(t, self.table, self.flags)
                if len(x):
                    some[lo + r] = True
                    cols = self.column[x]
                    block[r, cols[cols >= 0]] = 1.0 / np.sqrt(len(x))
            out[lo:lo + len(part)] = block @ self.matrix
        return out, some


class Model:
    """Landmarks, the Nystroem map and the ridge weights per language."""

    def __init__(self, landmark_texts: list[str], langs: list[str]):
        self.texts, self.langs = landmark_texts, langs
        self.weights: np.ndarray | None = None

    def __getstate__(self):
        return {"texts": self.texts, "langs": self.langs, "weights": self.weights}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def landmarks(self) -> Landmarks:
        if "_landmarks" not in self.__dict__:
            self._landmarks = Landmarks(self.texts)
        return self._landmarks

    def score(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        if not self.langs or self.weights is None:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        k, some = self.landmarks().kernel(texts)
        values = k @ self.weights
        best = values.argmax(axis=1)
        score = np.clip(values[np.arange(len(texts)), best], 0.0, 1.0)
        return ([self.langs[b] if s else UNDETERMINED for b, s in zip(best, some)],
                np.where(some, score, 0.0))


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
          sample_per_lang: int = SAMPLE_PER_LANG, landmarks_per_lang: int = LANDMARKS_PER_LANG) -> Model:
    """Fit on ``labelled`` (text, lang). The training sample is drawn by the
    hash of the key, about ``sample_per_lang`` rows per language; the landmarks
    are its rows with the smallest hashes. Gram sums are added up by Spark."""
    rows = (labelled.select(named(text).alias("text"), named(lang).alias("lang"),
                            F.xxhash64(named(key), F.lit("sample")).alias("h"))
            .where(F.col("lang").isNotNull() & F.col("text").isNotNull()))
    counts = rows.groupBy("lang").count().collect()          # one row per language
    if not counts:
        return Model([], [])
    langs = sorted(r["lang"] for r in counts)
    landmarks_per_lang = max(1, min(landmarks_per_lang, LANDMARKS // len(langs)))
    unit = (F.col("h") / F.lit(2.0 ** 64)) + 0.5

    def below(per_lang):
        share = F.create_map(*[x for r in counts for x in (F.lit(r["lang"]), F.lit(min(1.0, per_lang / r["count"])))])
        return unit <= share[F.col("lang")]

    chosen = (rows.where(F.col("lang").isin(langs)).where(below(4.0 * landmarks_per_lang))
              .groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct("h", "text"))), 1, landmarks_per_lang)
                                   .alias("some")).orderBy("lang").collect())
    texts = [r["text"] for row in chosen for r in row["some"]]
    model = Model(texts, langs)
    sample = rows.where(F.col("lang").isin(langs)).where(below(float(sample_per_lang)))
    m, c = model.landmarks().count, len(langs)
    if m == 0:
        return Model([], [])

    def gram(batches):
        marks, total = model.landmarks(), np.zeros((m, m + c))
        for batch in batches:
            for part in packed_rows(batch, BLOCK_BYTES):
                k, some = marks.kernel(part.column("text").to_pylist())
                y = np.zeros((part.num_rows, c))
                for r, l in enumerate(part.column("lang").to_pylist()):
                    y[r, langs.index(l)] = 1.0
                k, y = k[some], y[some]
                total += np.hstack([k.T @ k, k.T @ y])
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(m, dtype=np.int32)),
                                          "v": pa.array(list(total), pa.list_(pa.float64()))})

    # m rows of m + c sums in all, however many rows take part: a row is cut into
    # pieces, whose arrays are added up component by component
    cells = sample.select("text", "lang").mapInArrow(freed(gram), "i int, v array<double>")
    add = lambda old, new: F.when(F.size(old) == 0, new).otherwise(F.zip_with(old, new, lambda a, b: a + b))
    cells = cells.groupBy("i").agg(F.aggregate(F.collect_list("v"), F.array().cast("array<double>"), add).alias("v")).collect()
    total = np.zeros((m, m + c))
    for r in cells:
        total[r["i"]] = r["v"]
    marks = model.landmarks()
    kmm = marks.matrix.astype(np.float64).T @ marks.matrix.astype(np.float64)
    val, vec = np.linalg.eigh(kmm)
    root = vec @ np.diag(1.0 / np.sqrt(np.maximum(val, 1e-6))) @ vec.T      # K_mm^(-1/2)
    gram_phi = root @ total[:, :m] @ root
    ridge = RIDGE * max(np.trace(gram_phi) / m, 1e-12)
    model.weights = root @ np.linalg.solve(gram_phi + ridge * np.eye(m), root @ total[:, m:])
    return model


def identify(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
             pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``keep`` columns (default: all) plus the predicted language and a score.
    Columns of ``docs`` named like the two new ones are replaced."""
    cols = [c for c in (keep if keep is not None else docs.columns) if c not in (pred, score)]
    # a text that is kept goes to Python once, as a field of its row
    field, row = (text, "__row") if text in cols else ("__text", None)
    src = docs.select(*([] if row else [named(text).alias("__text")]), as_row(cols, "__row"))

    def run(batches):
        for batch in batches:
            for part in packed_rows(batch, BLOCK_BYTES, field, row):
                langs, values = model.score(text_column(part, field, row).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("__row"), pa.array(langs, pa.string()), pa.array(values, pa.float64())],
                    names=["__row", "__pred", "__score"])

    out = src.mapInArrow(freed(run), carried(src, "__row", "__pred string, __score double"))
    return out.select(*of_row(cols, "__row"), F.col("__pred").alias(pred),
                      F.col("__score").alias(score))
