"""Secret scan: fixed patterns plus a guess-cost estimate for passwords.

Three pattern kinds (``assign``, ``access``, ``hex``) are found everywhere in the
text. Values that stand in a credential context (``pwd: ...``, ``login = ...``,
the password of a URL) and reach beyond the pattern matches are rated by the number
of guesses an attacker needs: a dynamic programme finds the cheapest segmentation
of the value into dictionary words, dates, repeats, keyboard walks and brute-force
spans. The dictionary holds common password words and the most frequent words of
the corpus, counted over all documents outside credential values. Values that cost
at least ``MIN_LOG10_GUESSES`` are reported as kind ``guess``. Every pattern match stays in the result.

Positions are code points, ends exclusive. Defined results: null and empty texts
have no spans; texts of any length are scanned whole; repeated rows are scanned
each.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import as_row, carried, freed, named, of_row, packed_rows, ship, written

ship(__name__)

MIN_LOG10_GUESSES = 9.0     # values that cost less are placeholders, dates or plain words
DICTIONARY = 20000          # most frequent corpus words that are taken as plain words
MIN_DOCS = 5                # documents that hold such a word at least
WALK_MAX = 24               # keys of a keyboard walk
JOIN = math.log10(2)        # cost of one more segment
KINDS = ("assign", "access", "hex", "guess")

# Fixed values of the task: the three patterns and their shortest lengths.
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_MIN = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_MIN = 18
HEX = re.compile(r"[0-9a-f]{16,}")           # a maximal run of [0-9a-f]+ with 16 or more characters
ASSIGN_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

# Credential contexts whose values the guess cost is computed for.
CONTEXT = re.compile(
    r"""(?ai:\b(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api_?key|credentials?|auth|login|pin))["']?[ \t]*[:=][ \t]*["']?([^\s"'<>,;]{4,})"""
    r"""|://[^\s:/@]+:([^\s/@]{4,})@""")
CONTEXT_KEYS = (b"pass", b"pwd", b"secret", b"token", b"apikey", b"api_key", b"credential", b"auth", b"login",
                b"pin", b"://")

# Common password words, the most frequent first (rank = guesses).
WORDS = ("password admin welcome login secret qwerty letmein monkey dragon master sunshine princess football "
         "baseball shadow superman batman summer winter spring autumn hello love money test guest root user "
         "default changeme access pass computer internet service server database mysql oracle backup public "
         "private company office london paris berlin jordan michael daniel thomas charlie jessica ashley hunter "
         "soccer hockey tiger eagle falcon phoenix ginger pepper cookie cheese flower purple orange silver golden "
         "diamond freedom trustno matrix killer ranger buster harley mustang ferrari mercedes porsche maggie "
         "please this that with from have your the and for you not are was all can").split()
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LEET = str.maketrans("@4830!1$5+7", "aabeoiisstt")


def _walks() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    at = {c: (x, y) for y, row in enumerate(KEY_ROWS) for x, c in enumerate(row)}
    for a, (x, y) in at.items():
        near[a] = {b for b, (u, v) in at.items() if a != b and abs(v - y) <= 1 and abs(u - x) <= 1}
    return near


NEAR = _walks()
RANK = {w: i + 1 for i, w in enumerate(WORDS)}
LONGEST_WORD = 24           # letters of a word
DATE = re.compile(r"(?a:(?:19|20)\d\d(?:[-./]?(?:0[1-9]|1[0-2])(?:[-./]?(?:0[1-9]|[12]\d|3[01]))?)?"
                  r"|(?:0?[1-9]|[12]\d|3[01])[-./](?:0?[1-9]|1[0-2])[-./](?:19|20)?\d\d)")


def _alphabet(value: str) -> float:
    size = 0
    size += 26 * any("a" <= c <= "z" for c in value)
    size += 26 * any("A" <= c <= "Z" for c in value)
    size += 10 * any("0" <= c <= "9" for c in value)
    size += 33 * any(c.isascii() and not c.isalnum() for c in value)
    size += 100 * any(not c.isascii() for c in value)
    return math.log10(max(size, 2))


def segments(value: str, ranks: dict[str, int] = RANK):
    """The spans other than brute force: (start, end, log10 guesses). Words,
    plain or with letters written as digits, dates, keyboard walks of at most
    ``WALK_MAX`` keys, and repeats (from the start of the repeated run)."""
    n = len(value)
    low = value.lower()
    plain = low.translate(LEET)
    one = _alphabet(value)
    for i in range(n):
        for j in range(i + 3, min(n, i + LONGEST_WORD) + 1):
            for form, extra in ((low, 0.0), (plain, math.log10(4))):
                rank = ranks.get(form[i:j])
                if rank:
                    case = 0.0
                    if value[i:j] != low[i:j]:
                        case = math.log10(2) * (1 if value[i:j].istitle() or value[i:j].isupper() else j - i)
                    yield i, j, math.log10(rank) + extra + case
        m = DATE.match(value, i)
        if m:
            yield i, m.end(), math.log10(120) + (math.log10(365) if m.end() - i > 4 else 0.0)
        j = i + 1
        while j < min(n, i + WALK_MAX) and low[j] in NEAR.get(low[j - 1], ()):
            j += 1
            if j - i >= 3:
                yield i, j, math.log10(40 * (j - i)) + 0.3 * (j - i - 2)
        for unit in range(1, min(8, (n - i) // 2) + 1):
            if i >= unit and value[i - unit:i] == value[i:i + unit]:
                continue
            j = i + unit
            while value[j:j + unit] == value[i:i + unit]:
                j += unit
                if j - i >= 3:
                    yield i, j, unit * one + math.log10((j - i) // unit)


def log10_guesses(value: str, ranks: dict[str, int] = RANK) -> float:
    """log10 of the guesses for the cheapest segmentation of ``value``, by
    dynamic programming over its ends. Every segment costs ``JOIN`` on top of
    its own guesses; a brute-force span costs one symbol of the value's
    alphabet per character."""
    n = len(value)
    if n == 0:
        return 0.0
    one = _alphabet(value)
    edges: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]      # end -> (start, log10 guesses)
    for i, j, guesses in segments(value, ranks):
        edges[j].append((i, guesses))
    least = [0.0] + [math.inf] * n                                         # of the first i characters
    brute = math.inf                                                       # of those, ending in a brute-force span
    for i in range(1, n + 1):
        brute = one + min(brute, least[i - 1] + JOIN)
        least[i] = min([brute] + [least[start] + guesses + JOIN for start, guesses in edges[i]])
    return least[n]


def scan(text: str | None, threshold: float = MIN_LOG10_GUESSES, ranks: dict[str, int] = RANK) -> tuple[list[tuple[int, int, int]], float]:
    """(spans as (start, kind index, end), in order; the largest guess cost
    among the credential values of the text, 0 without any)."""
    if not text:
        return [], 0.0
    raw = text.encode("utf-8", "replace").lower()                          # lower-cases ASCII only
    base: list[tuple[int, int, int]] = []
    if any(k in raw for k in ASSIGN_KEYS):
        base += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if b"akia" in raw:
        base += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    base += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    most, found = 0.0, []
    if any(k in raw for k in CONTEXT_KEYS):
        base.sort()
        starts, ends = [], []                                              # the base spans, overlapping ones joined
        for s, _, e in base:
            if ends and s <= ends[-1]:
                ends[-1] = max(ends[-1], e)
            else:
                starts.append(s)
                ends.append(e)
        for m in CONTEXT.finditer(text):
            g = 1 if m.group(1) is not None else 2
            cost = log10_guesses(m.group(g), ranks)
            most = max(most, cost)
            at = bisect.bisect_right(starts, m.start(g)) - 1
            if cost >= threshold and (at < 0 or ends[at] < m.end(g)):      # not wholly inside base spans
                found.append((m.start(g), 3, m.end(g)))
    return sorted(base + found), most


def _named(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def redact(text: str | None, spans) -> str | None:
    """The text with every span (overlaps joined) replaced by a mark."""
    if text is None or not spans:
        return text
    out, at = [], 0
    end = -1
    for s, _, e in spans:
        if s >= end:
            out.append(text[at:max(s, at)])
            out.append("[SECRET]")
        end = max(end, e)
        at = max(at, e)
    out.append(text[at:])
    return "".join(out)


# The credential values (CONTEXT) for Java, to leave them out of the word counts.
NO_VALUES = (r"""(?i)\b(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api_?key|credentials?|auth|login|pin)["']?[ \t]*[:=]"""
             r"""[ \t]*["']?[^\s"'<>,;]+|://\S*""")


def word_ranks(docs: DataFrame, text: str = "text") -> dict[str, int]:
    """Word -> rank: the common password words, then the words that stand in most
    documents (``MIN_DOCS`` at least) outside credential values: those of as many
    documents as a cut says, which leaves ``DICTIONARY`` words at most. The cut is
    found from the number of words of each document count."""
    words = F.array_distinct(F.split(F.lower(F.regexp_replace(named(text), NO_VALUES, " ")), r"[^\p{L}]+"))
    found = (docs.select(F.explode(words).alias("w")).where(F.length("w").between(3, LONGEST_WORD))
             .groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCS))
    found = written(found, "words")
    # counts in steps of about one percent: a few thousand rows, whatever the corpus
    by_count = found.groupBy(F.floor(64 * F.log2("n")).alias("step")).agg(F.count("*").alias("words"), F.min("n").alias("n"))
    cut, words_so_far = None, 0
    for r in by_count.orderBy(F.desc("step")).collect():
        words_so_far += r["words"]
        if words_so_far > DICTIONARY:
            break
        cut = r["n"]
    chosen = found.where(F.col("n") >= cut).collect() if cut is not None else []
    ranks = dict(RANK)
    for r in sorted(chosen, key=lambda r: (-r["n"], r["w"])):
        ranks.setdefault(r["w"], len(ranks) + 1)
    return ranks


FIELDS = ("n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long, "
          "max_log10_guesses double, redacted string")


def find_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None,
                 threshold: float = MIN_LOG10_GUESSES, with_text: bool = True) -> DataFrame:
    """``keep`` columns (default: all) plus the span counts, the digest of the
    pattern spans, all spans, the guess cost and the redacted text. Columns of
    ``docs`` named like new ones are replaced."""
    new = [f.split()[0] for f in FIELDS.split(", ")]
    cols = [c for c in (keep if keep is not None else docs.columns) if c not in new]
    src = docs.select(named(text).alias("__text"), as_row(cols, "__row"))
    ranks = word_ranks(docs, text)

    def run(batches):
        for batch in batches:
            for part in packed_rows(batch, column="__text"):
                out = {n: [] for n in new}
                for t in part.column("__text").to_pylist():
                    spans, most = scan(t, threshold, ranks)
                    base = [x for x in spans if x[1] < 3]
                    for k, n in enumerate(("n_assign", "n_access", "n_hex")):
                        out[n].append(sum(x[1] == k for x in base))
                    out["base_sha256"].append(hashlib.sha256(_named(base).encode()).hexdigest())
                    out["spans"].append(_named(spans))
                    out["n_guess"].append(len(spans) - len(base))
                    out["max_log10_guesses"].append(most)
                    out["redacted"].append(redact(t, spans) if with_text else None)
                types = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64(), pa.float64(), pa.string()]
                yield pa.RecordBatch.from_arrays([part.column("__row")] + [pa.array(out[n], t) for n, t in zip(new, types)],
                                                 names=["__row", *new])

    out = src.mapInArrow(freed(run), carried(src, "__row", FIELDS))
    return out.select(*of_row(cols, "__row"), *new)
