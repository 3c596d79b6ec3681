"""Duplicate operators against brute force: substrings, SimHash, line runs."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from helpers import corpus, frame, odd_texts, rows, sentence
from skyframe.llm import line_dedup as LD, simhash as SH, suffix_dedup as SD


def brute_repeats(texts, length):
    seen = {}
    for b in texts:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((len(b), sum(gone), runs, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def test_repeated_substrings(spark):
    data = [d for d in corpus(5) if d[1] is None or len(d[1]) < 30000]
    base = "".join(chr(97 + (i * i * 7 + i // 3) % 26) for i in range(700))
    extra = [base, "q" + base[100:299], "r" + base[100:300], base[:250] + "zz" + base[400:650], "é" * 150, "ab" * 120, base[350:] + base[350:]]
    data += rows(extra, 800)
    out = SD.remove_repeats(frame(spark, data), keep=["doc_id", "text"]).collect()
    key = lambda d: (d[0] is None, d[0] or 0, d[1] or "")
    data.sort(key=key)
    out.sort(key=lambda r: key((r["doc_id"], r["text"])))
    expect = brute_repeats([(d[1] or "").encode() for d in data], 200)
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out] == expect
    assert sum(r["n_removed"] > 0 for r in out) > 5
    assert SD.remove_repeats(frame(spark, [])).count() == 0


def test_hot_bucket_is_not_sorted_as_a_whole(spark, monkeypatch):
    """Passages below and above LENGTH bytes in every text, with other neighbours each time."""
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    short, long = word(180), word(230)
    texts = [word(150) + short + word(150) for _ in range(60)] + [word(90) + long + word(90) for _ in range(30)]
    texts += ["x" + texts[0][20:], texts[1], texts[2][:400] + "q", texts[70][30:], "ab" * 150]
    data = rows(texts)
    monkeypatch.setattr(SD, "BLOCK_ROWS", 8)
    monkeypatch.setattr(SD, "HOT_ROWS", 4, raising=False)
    sort = SD.repeated_windows

    def bounded(bucket, blocks):
        assert len(blocks) < 8 + 4
        return sort(bucket, blocks)

    monkeypatch.setattr(SD, "repeated_windows", bounded)
    out = sorted(SD.remove_repeats(frame(spark, data), keep=["doc_id"]).collect(), key=lambda r: r["doc_id"])
    assert [(r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out] == brute_repeats(
        [t.encode() for t in texts], 200)


def test_cover_sees_every_pair_of_remainders():
    s = SD.shift_table()
    for i in range(SD.PERIOD):
        for j in range(SD.PERIOD):
            assert (i + s[i, j]) % SD.PERIOD in SD.COVER and (j + s[i, j]) % SD.PERIOD in SD.COVER


def test_deep_ties_are_split_by_cover_ranks():
    a, b, c = b"A" * 90, b"B" * 30, b"C" * 90
    blocks = [a + b"x" + b + c, a + b"y" + b + c, a + b"x" + b + c, a + b"z" + b + c + b"tail"]
    found = SD.repeated_windows(np.zeros(4, np.int64), blocks)
    want = []
    every = [x[i:i + 200] for x in blocks for i in range(len(x) - 199)]
    for x in blocks:
        want.append([every.count(x[i:i + 200]) > 1 for i in range(len(x) - 199)])
    assert [list(f) for f in found] == want


def brute_fp(t):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    parts = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(p.encode(), seed=42) for p in parts]
    return sum(1 << b for b in range(64) if h and 2 * sum((x >> b) & 1 for x in h) > len(h))


def test_simhash_components(spark):
    data = corpus(7)
    out = SH.near_duplicates(frame(spark, data)).collect()
    assert len(out) == len(data)
    texts = {}
    for d in data:
        texts.setdefault(d[0], brute_fp(d[1]))
    for r in out:
        assert r["fp"] & (2 ** 64 - 1) == texts[r["doc_id"]]
    fps = sorted(set(texts.values()))
    group = {f: f for f in fps}
    for _ in fps:
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    least = {}
    for i, f in texts.items():
        if i is not None:
            least[group[f]] = min(i, least.get(group[f], i))
    assert all(r["component_id"] == least.get(group[texts[r["doc_id"]]]) for r in out)
    assert SH.near_duplicates(frame(spark, [])).count() == 0


def test_anchor_cover_meets_every_close_pair():
    rng = np.random.default_rng(2)
    words = SH.code_words()
    assert len(set(words.tolist())) == 4096 and min(int(w).bit_count() for w in words if w) == 7
    fp = rng.integers(-(1 << 63), 1 << 63, 200, dtype=np.int64)
    other = fp.copy()
    for k in range(200):
        for b in rng.choice(64, k % 3, replace=False):
            other[k] ^= np.int64(-(1 << 63)) if b == 63 else np.int64(1 << int(b))
    anchors = SH.Anchors()
    row, pair, home = anchors.cover(fp)
    at_home = {int(r): int(p) for r, p, h in zip(row, pair, home) if h}
    assert len(at_home) == 200 and int(home.sum()) == 200
    row2, pair2, _ = anchors.cover(other)
    near = set(zip(row2.tolist(), pair2.tolist()))
    assert len(near) == len(row2)                                   # no anchor pair twice
    assert all((k, at_home[k]) in near for k in range(200))


def test_replicas_are_not_broadcast(spark, tmp_path):
    """About 61 anchors a fingerprint, which Spark sizes like one: the join of few rows is a merge too, and finds all close pairs."""
    rng = random.Random(21)
    fps = {rng.getrandbits(64) - (1 << 63) for _ in range(40)}
    fps |= {x ^ (1 << rng.randrange(62)) ^ (1 << rng.randrange(62)) for x in fps}
    spark.createDataFrame([(x,) for x in fps], "fp long").write.parquet(str(tmp_path / "fps"))    # a file, so its size is known
    found = SH.links(spark.read.parquet(str(tmp_path / "fps")))
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    close = {(a, b) for a in fps for b in fps if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= SH.MAX_BITS}
    assert {(r.a, r.b) for r in found.collect()} == close and len(close) > 30


def test_simhash_chain_components(spark):
    """A path of links, and stars, come out as one component each."""
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(-5, 200)]
    out = {r["node"]: r["component"] for r in SH.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(41)) and all(out[100 + k] == 100 for k in range(30)) and out[200] == -5 == out[-5]


def brute_lines(data, least):
    """Deleted lines per (doc_id, text): every pair of positions is compared, and
    from each position the longest run that an earlier one starts too goes."""
    docs = sorted({(d[0], d[1]) for d in data if d[1]}, key=lambda d: (d[0] is None, d[0] or 0))
    lines = [[x.strip(" \t\x0b\x0c\r") for x in d[1].split("\n")] for d in docs]
    places = [(k, p) for k, own in enumerate(lines) for p in range(len(own))]
    gone = {}
    for at, (k, p) in enumerate(places):
        longest = 0
        for j, q in places[:at]:
            m = 0
            while p + m < len(lines[k]) and q + m < len(lines[j]) and lines[k][p + m] == lines[j][q + m]:
                m += 1
            longest = max(longest, m)
        if sum(map(len, lines[k][p:p + longest])) >= least:
            gone.setdefault(docs[k], set()).update(range(p, p + longest))
    return gone


def test_line_runs(spark):
    data = corpus(9)
    block = "alpha beta\ngamma\n\ndelta epsilon zeta eta\n"
    data += rows([block + "one", "two\n" + block + block, "gamma\n\ndelta epsilon zeta eta", "same\nsame\nsame\nsame\nsame", "Ok.\nOk.",
                  "\n".join(f"row {i % 7} of seven" for i in range(40))], 700)
    rng = random.Random(2)
    short = ["a", "", " b", "b ", "cc cc", "dd dd dd", "eight ch", "a line of twenty chars or more"]
    data += rows(["\n".join(rng.choice(short) for _ in range(rng.randint(1, 25))) for _ in range(25)], 800)
    check_lines(spark, data, 5)
    assert LD.dedup_lines(frame(spark, [])).count() == 0


def check_lines(spark, data, least):
    clashing = {"kept": "x", "a.b": 1, "__gone": 2, "__o": 3, "row": 4, "f": 5, "size": 6}
    docs = frame(spark, data)
    for name, value in clashing.items():
        docs = docs.withColumn(name, F.lit(value))
    out = LD.dedup_lines(docs).collect()
    assert len(out) == len(data) and out[0]["a.b"] == 1 and out[0]["f"] == 5
    want = brute_lines(data, LD.MIN_CHARS)
    for r in out:
        gone = want.get((r["doc_id"], r["text"]), set())
        assert (r["n_deleted"] or 0) == len(gone), r["text"]
        assert (r["n_runs"] or 0) == sum(x - 1 not in gone for x in gone)
        if r["text"] is not None:
            assert r["kept"] == "\n".join(x for i, x in enumerate(r["text"].split("\n")) if i not in gone)
    assert sum(bool(r["n_deleted"]) for r in out) >= least


def test_run_whose_prefix_stands_earlier_too(spark):
    a, b, c, x, y = (f"line {n}." for n in "abcxy")         # three lines of eight characters count, two do not
    check_lines(spark, rows(["\n".join(t) for t in ([a, b, x], [y, a, b, c, "z"], ["w", a, b, c, "v"])]), 1)


@pytest.mark.parametrize("seed", range(3))
def test_random_lines(spark, seed):
    rng = random.Random(seed)
    check_lines(spark, rows(["\n".join(rng.choice(["abc", "defghi", "", "jklmnopqr"]) for _ in range(rng.randint(1, 18)))
                             for _ in range(14)]), 1)


def test_long_texts_of_repeated_lines(spark):
    """50000 equal or periodic lines: about 1.25e9 (line, run) pairs if runs were listed line by line."""
    n = 50000
    texts = ["\n".join(["the same"] * n), "\n" * n + "the end", "\n".join(f"row {i % 7} of seven" for i in range(n))]
    out = {r["doc_id"]: r for r in LD.dedup_lines(frame(spark, rows(texts))).collect()}
    assert [out[i]["n_runs"] for i in range(3)] == [1, None, 1]
    assert out[0]["n_deleted"] == n - 1 and out[0]["kept"] == "the same"
    assert out[1]["n_deleted"] is None and out[1]["kept"] == texts[1]
    assert out[2]["n_deleted"] == n - 7 and out[2]["kept"] == "\n".join(texts[2].split("\n")[:7])


def test_tables_of_positions_are_merged(spark, tmp_path):
    """The written tables are small files of many rows: only hot keys may be broadcast, and their rows are spread."""
    rng = random.Random(31)
    shared = [sentence(rng, "en", 8) for _ in range(6)] + ["a", "b"]
    data = rows(["\n".join(rng.choice(shared) for _ in range(12)) for _ in range(40)])
    frame(spark, data).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    plan = LD.later_copies(docs)._jdf.queryExecution().executedPlan().toString().split("\n")
    assert len([x for x in plan if "SortMergeJoin" in x]) > 4
    assert all("__hot_key" in x for x in plan if "BroadcastHashJoin" in x)
    cold = [x for x in plan if "SortMergeJoin" in x and "__cold_key" in x]
    assert cold and all("__cold_spread" in x and "= 0" not in x for x in cold)
    check_lines(spark, data, 5)


def test_one_row_stays_of_every_group(spark):
    """Rows without an id, rows of one id with different texts, repeated rows."""
    rng = random.Random(9)
    one, two, three = (sentence(rng, "en", 40) for _ in range(3))
    data = [(None, one, "en", "s", 1), (None, two, "en", "s", 1), (4, three, "en", "s", 1), (4, one, "en", "s", 1),
            (4, three, "en", "s", 1), (2, three + " ", "en", "s", 1), (7, None, "en", "s", 0), (8, "", "en", "s", 0)]
    kept = SH.keep_first(frame(spark, data).withColumn("__id", F.lit("mine")))
    assert kept.columns[-1] == "__id"
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        [(True, 0, two), (False, 4, one), (False, 2, three + " "), (False, 7, "")])
