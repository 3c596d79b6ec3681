"""URL filter, importance resampling and vector codes against plain versions."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import corpus, frame, rows
from skyframe.llm import resampling as RS, url_filter as UF, vector_codes as VC
from skyframe.llm.common import join_by_share

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
         ("a.b.example.com", "/de/x", "allow"), ("com", "/de/", "allow"), ("org", "/fr/", "block"), ("", "/", "block"), (None, "/", "block")]
LISTED = ["ads.example.com/en/1", "x.org", "shop.example.org/Fr", "", None]


def brute_verdict(url):
    m = re.search("://", url or "")
    rest = url[m.end():] if m else ""
    host = re.match("[^/?#]*", rest).group()
    path = re.match("[^?#]*", rest[len(host):]).group()
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in RULES if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, _, rule, verdict = max(fits)
        return host, path, rule, verdict
    key = host + path.rstrip("/")
    return host, path, None, "block" if key and key in LISTED else "allow"


def urls(n=400):
    rng = random.Random(4)
    odd = [None, "", "no scheme", "http://", "://", "http://?q", "http://net", "http://net/", "HTTP://X.NET/a", "http://xnet/a",
           "http://EXAMPLE.net/en/1?x=/de/", "http://example.net/EN/1", "a://b://example.com/de/1", "http://x.org//", "http://x.org",
           "http://net:80/", "http://\u0130.net/é", "http://a.b.example.com/de/x1", "http://q.a.b.example.com/de/y", "http://.net/",
           "http://" + "a." * 3000 + "net/x", "http://x.org/" + "p" * 50000, "http://x\n.net/\na", "http://user@net/a"]
    hosts = ["ads.example.com", "x.org", "www.x.org", "shop.example.org", "m.example.net", "example.com", "net", "a.b.example.com", "hot.example.net"]
    return odd + [f"{rng.choice(['http', 'https'])}://{rng.choice(hosts + ['hot.example.net'] * 6)}/{rng.choice(['en', 'de', 'fr', 'Fr'])}"
                  f"{rng.choice(['', '/', '/1', '/1/', '/x?y', '#z'])}" for _ in range(n)]


def test_url_filter_matches_brute_force(spark):
    data = [(i, u, "h", "x", "y") for i, u in enumerate(urls())] + [(None, "http://net/a", None, None, None), (3, "http://net/a", "h", "x", "y")]
    pages = spark.createDataFrame(data, "page_id long, url string, `a.b` string, hits string, verdict string").repartition(3)
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    listed = spark.createDataFrame([(u, "block") for u in LISTED], "canonical string, verdict string")
    out = UF.filter_urls(pages, rules, listed)
    assert out.columns == ["page_id", "url", "a.b", "hits", "host", "path", "rule", "verdict"]
    got = sorted(map(repr, ((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in out.collect())))
    assert got == sorted(repr((d[0], *brute_verdict(d[1]))) for d in data)
    nothing = UF.filter_urls(pages, rules.limit(0), listed.limit(0), keep=["page_id"])
    assert {r["verdict"] for r in nothing.collect()} == {"allow"}
    assert UF.filter_urls(pages.limit(0), rules, listed).count() == 0


def test_url_filter_needs_no_python(spark):
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    listed = spark.createDataFrame([(u, "block") for u in LISTED], "canonical string, verdict string")
    plan = UF.filter_urls(pages, rules, listed)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_bloom_filter_holds_its_keys_and_few_others(spark):
    keys = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    words, blocks = UF.bloom_filter(keys)
    probe = spark.range(30000).select("id", UF.may_hold(words, blocks, F.concat(F.lit("k"), "id")).alias("hit"))
    assert probe.where("id < 3000 and not hit").count() == 0
    assert probe.where("id >= 3000 and hit").count() < 0.03 * 27000
    one, few = UF.bloom_filter(keys.limit(0))
    assert few == 1 and spark.range(5).where(UF.may_hold(one, few, F.col("id").cast("string"))).count() == 0


def test_join_by_share_splits_hot_keys(spark):
    data = [(None if i % 3 == 0 else "hot" if i % 3 == 1 else f"k{i}", i) for i in range(900)]
    table = spark.createDataFrame(data, "k string, `a.b` int")
    counts = table.groupBy("k").agg(F.count("*").alias("n"), F.max("`a.b`").alias("top")).where("k is null or k <> 'k2'")
    out = {r["a.b"]: r["top"] for r in join_by_share(table, counts, "k", "n").collect()}
    top = {}
    for k, i in data:
        top[k] = max(top.get(k, 0), i)
    assert out == {i: None if k == "k2" else top[k] for k, i in data}


def brute_resample(docs, target, runs=1, buckets=10000, seed=2024, percent=10, min_words=20):
    def features(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        return words, [zlib.crc32(" ".join(words[i:i + n]).encode()) % buckets for n in range(1, runs + 1) for i in range(len(words) - n + 1)]
    s, t = [0] * buckets, [0] * buckets
    for text in docs:
        for b in features(text[1])[1]:
            s[b] += 1
    for text in target:
        for b in features(text)[1]:
            t[b] += 1
    S, T = sum(s), sum(t)
    out = []
    for doc_id, text in docs:
        words, f = features(text)
        gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in f]
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain) // len(gain) if gain else 0
        out.append((doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words)))
    enough = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    take = percent * len(enough) // 100
    drawn = [(*r[:4], k + 1) for k, r in enumerate(enough[:take])]
    return drawn + [(*r[:4], None) for r in enough[take:]] + [(*r[:4], None) for r in out if r[4] < min_words]


@pytest.mark.parametrize("runs,percent,segment", [(1, 10, 1024), (2, 40, 7), (1, 100, 5)])
def test_resampling_matches_brute_force(spark, monkeypatch, runs, percent, segment):
    monkeypatch.setattr(RS, "SEGMENT_ROWS", segment)
    monkeypatch.setattr(RS, "SAMPLES", 50)
    data = corpus(n=150) + [(9000, "same words " * 20, None, None, None)] * 60
    docs = frame(spark, data).repartition(5).withColumn("rank", F.lit("mine")).withColumn("a.b", F.lit(1)).withColumn("row", F.lit(2))
    target = [d[1] for d in data[:9]] + [None, ""]
    out = RS.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), runs=runs, percent=percent)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "a.b", "row", "n_features", "weight", "score", "rank"]
    got = [(r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in out.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, brute_resample([d[:2] for d in data], target, runs, percent=percent)))


def test_resampling_of_empty_tables(spark):
    empty, some = frame(spark, []), frame(spark, corpus(n=30))
    assert RS.resample(empty, some).count() == 0
    assert RS.resample(some, empty).where("rank is not null").count() > 0
    short = RS.resample(frame(spark, rows([None, "", "one two"])), some).collect()
    assert [(r["n_features"], r["weight"], r["rank"]) for r in sorted(short, key=lambda r: r["n_features"])][:2] == [(0, 0, None)] * 2


def brute_codes(data, parts=4, entries=256, rounds=4):
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in data
            if v and all(x is not None and math.isfinite(x) for x in v)]
    size = max(sorted({len(v) for _, v, _ in kept}), key=[len(v) for _, v, _ in kept].count)
    kept = [r for r in kept if len(r[1]) == size]
    width = size // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[r[1][p * width:(p + 1) * width] for r in first] for p in range(parts)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for _, v, _ in kept:
                part = v[p * width:(p + 1) * width]
                groups.setdefault(nearest(part, books[p])[1], []).append(part)
            for k, own in groups.items():
                books[p][k] = [sum(c) // len(own) for c in zip(*own)]
    coded, errors = [], {}
    for i, v, label in kept:
        best = [nearest(v[p * width:(p + 1) * width], books[p]) for p in range(parts)]
        coded.append((i, "".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best), label))
        errors[label] = errors.get(label, 0) + coded[-1][2]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, code, error, errors[label]) for i, code, error, label in coded], digest


def vectors(n, dim, rng, grid):
    """Vectors on a grid, so that parts share prefixes, tie and repeat."""
    out = [(i, [rng.randint(-grid, grid) / 8 for _ in range(dim)], rng.choice([None, 1, 2, 3])) for i in range(n)]
    out += [(n + 1, None, 1), (n + 2, [], 1), (n + 3, [None] * dim, 1), (n + 4, [float("nan")] * dim, 1), (n + 5, [float("inf")] * dim, 1),
            (n + 6, [0.5] * (dim + 4), 1), (None, out[0][1], None), out[2], (3, out[5][1], 2), (n + 7, [0.0] * dim, 9)]
    return out + [(n + 10 + i, out[7][1], 4) for i in range(n // 3)]


@pytest.mark.parametrize("n,dim,grid,leaves", [(120, 8, 2, 3), (300, 16, 40, 1024), (20, 4, 1, 1)])
def test_vector_codes_match_brute_force(spark, monkeypatch, n, dim, grid, leaves):
    monkeypatch.setattr(VC, "LEAVES", leaves)
    data = vectors(n, dim, random.Random(n), grid)
    table = spark.createDataFrame([(*r, "x", "y") for r in data], "vec_id long, embedding array<float>, label int, code string, `a.b` string")
    coded, books = VC.compress(table.repartition(3), entries=64)
    assert coded.columns == ["vec_id", "embedding", "label", "a.b", "code", "error"]
    out = VC.with_label_error(coded, "label").collect()
    want, digest = brute_codes(data, entries=64)
    assert sorted(map(repr, ((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in out))) == sorted(map(repr, want))
    assert VC.codebooks_digest(books) == digest


def test_vector_codes_of_odd_tables(spark):
    table = "vec_id long, embedding array<float>, label int"
    coded, books = VC.compress(spark.createDataFrame([], table))
    assert books == [] and VC.with_label_error(coded, "label").count() == 0
    with pytest.raises(ValueError):
        VC.compress(spark.createDataFrame([(1, [1.0, 2.0, 3.0], 1)], table))
    with pytest.raises(Exception, match="too large"):
        VC.compress(spark.createDataFrame([(1, [1e9] * 4, 1)], table))[0].count()


@pytest.mark.parametrize("scale", [1, 1 << 25])
def test_trie_is_the_plain_nearest_entry(scale):
    rng = np.random.default_rng(3)
    parts = np.unique(rng.integers(-3, 4, (500, 5)), axis=0) * scale
    entries = rng.integers(-3, 4, (40, 5)) * scale
    code, distance = VC.Trie(entries).nearest(parts)
    all_ = ((parts[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (code == all_.argmin(axis=1)).all() and (distance == all_.min(axis=1)).all()
