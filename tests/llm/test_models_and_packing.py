"""Nearest neighbours, packing, quality model and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import corpus, frame, rows, sentence
from skyframe.llm import ann as NN, packing as PK, quality_model as QM

VEC = "vec_id long, embedding array<float>, label int"


def check_neighbours(out, ids, full, k=20):
    """Recall against brute force; ranks, order and scores of every query."""
    got, hits, total = {}, 0, 0
    for r in out:
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    queries = np.flatnonzero(ids % 20 == 0)
    assert sorted(got) == sorted(ids[queries].tolist())
    rows = {}
    for at, i in enumerate(ids.tolist()):
        rows.setdefault(i, []).append(at)
    for at in queries:
        s = full @ full[at]
        s[at] = -np.inf
        best = Counter(ids[np.lexsort((ids, -s))[:k]].tolist())
        own = sorted(got[ids[at]])
        assert [x for x, _, _ in own] == list(range(1, k + 1))
        assert all((a[2], -a[1]) >= (b[2], -b[1]) for a, b in zip(own, own[1:]))
        for _, v, score in own:
            assert min(abs(score - full[j] @ full[at]) for j in rows[v]) < 1e-9
        hits += (best & Counter(v for _, v, _ in own)).total()
        total += k
    return hits / total


def test_neighbours_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 1500)] + 0.3 * rng.normal(size=(1500, 16))).astype(np.float32)
    data = [(i, [float(v) for v in x[i]], 0) for i in range(1500)]
    data += [(2000, None, 0), (2020, [0.0] * 16, 0), (2040, [float("nan")] * 16, 0), (2060, [None] + [1.0] * 15, 0),
             (2080, [float("inf")] + [1.0] * 15, 0), (None, data[0][1], 0), data[5], (1600, data[20][1], 0), (2100, [1.0], 0), (2120, [], 0)]
    table = spark.createDataFrame(data, VEC).withColumn("a.b", F.lit(1)).withColumn("part", F.lit(2))
    ids, full = np.array([*range(1500), 5, 1600]), np.vstack([x, x[5], x[20]]).astype(np.float64)
    assert check_neighbours(NN.search(table, F.col("id") % 20 == 0).collect(), ids, full) >= 0.9
    # every part visited: exact, however many parts there are
    assert check_neighbours(NN.search(table, F.col("id") % 20 == 0, part_rows=60, target=1).collect(), ids, full) == 1.0


@pytest.mark.parametrize("kind", ["clusters", "gaussian"])
def test_neighbours_recall_with_fewer_visits_than_parts(spark, kind):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(6000, 32))
    if kind == "clusters":
        x = rng.normal(size=(60, 32))[rng.integers(0, 60, 6000)] + 0.5 * x
    x = x.astype(np.float32)
    table = spark.createDataFrame([(i, [float(c) for c in v], 0) for i, v in enumerate(x)], VEC)
    vectors = NN.usable(table, "vec_id", "embedding")
    router, dim = NN.build(vectors, part_rows=150)
    assert router.parts == 40 and dim == 32
    visits = np.bincount(router.visited(x[::20].astype(np.float64))[0])
    assert visits.mean() < (0.85 if kind == "gaussian" else 0.4) * router.parts
    recall = check_neighbours(NN.search(table, F.col("id") % 20 == 0, part_rows=150).collect(), np.arange(6000), x.astype(np.float64))
    assert recall >= 0.9, recall


def test_neighbours_small_tables(spark):
    assert NN.search(spark.createDataFrame([], VEC), F.col("id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)], VEC)
    assert [(r["rank"], r["vec_id"]) for r in NN.search(few, F.col("id") % 20 == 0).orderBy("rank").collect()] == [(1, 1), (2, 2)]


def test_tokens_and_packing(spark):
    data = corpus(11)
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    out = PK.pack(frame(spark, data), path, keep=["doc_id"]).collect()
    want = []
    for d in data:
        ids = np.array(library.encode(d[1] or "", add_special_tokens=False).ids + [0], dtype="<u4")
        want += [(d[0] if d[0] is not None else -1, k, lo, len(ids[lo:lo + 2048]), zlib.crc32(ids[lo:lo + 2048].tobytes()))
                 for k, lo in enumerate(range(0, len(ids), 2048))]
    got = [(r["doc_id"] if r["doc_id"] is not None else -1, r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out]
    assert sorted(got) == sorted(want)
    seq = {}
    for r in out:
        seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in seq.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(seq) <= -(-sum(x[3] for x in want) // 2048) + 1
    assert PK.pack(frame(spark, []), path).count() == 0


def test_added_tokens_as_the_library_reads_them(spark):
    path = P.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["a<|endoftext|>b and <|startoftext|> c", "<|endoftext|>", "<|ENDOFTEXT|> é<|endoftext|>", "plain words"]
    out = {r["doc_id"]: r for r in PK.pack(frame(spark, rows(texts)), path, keep=["doc_id"]).collect()}
    for i, t in enumerate(texts):
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [0], dtype="<u4")
        assert (out[i]["length"], out[i]["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))


def test_frequent_length_of_repeated_rows_is_spread(spark, monkeypatch):
    monkeypatch.setattr(PK, "SALT_ROWS", 8)
    out = PK.pack(frame(spark, [(1, "the same words again", "en", "web", 20)] * 300), P.path("word_bpe_49k.json"), keep=["doc_id"])
    assert "__row_number" not in out.columns
    rows = out.collect()
    places = {(r["sequence_id"], r["offset"]) for r in rows}
    assert len(rows) == len(places) == 300
    assert len({r["sequence_id"] for r in rows}) == -(-sum(r["length"] for r in rows) // 2048)


def test_plan_uses_every_piece_once_and_fills_gaps():
    rng = random.Random(5)
    counts = {}
    for _ in range(4000):
        n = min(2048, int(rng.lognormvariate(5.5, 1.0)) + 1)
        counts[n] = counts.get(n, 0) + 1
    lines = PK.plan(counts)
    used, total = {}, 0
    for lengths, times in lines:
        assert times > 0 and sum(lengths) <= 2048
        total += times
        for x in lengths:
            used[x] = used.get(x, 0) + times
    assert used == counts
    assert total <= 1.01 * -(-sum(k * n for k, n in counts.items()) // 2048) + 1
    assert PK.plan({}) == [] and PK.plan({2048: 3}) == [([2048], 3)]
    assert sum(t for _, t in PK.plan({1025: 5})) == 5 and sum(t for _, t in PK.plan({512: 9})) == 3


def test_quality_model(spark):
    rng = random.Random(8)
    good = [sentence(rng, "en", 60) for _ in range(60)]
    bad = [" ".join(["spam!!"] * rng.randint(20, 80)) for _ in range(30)] + ["*** ### " * 30] * 10
    data = rows(good + bad + [None, ""]) + [(None, "x", None, None, None), rows(good)[0]]
    labels = spark.createDataFrame([(i, 1 if i < 60 else 0, 0) for i in range(100) if i % 3] + [(1, 1, 0), (None, 0, 0), (5, None, 0)],
                                   "doc_id long, quality int, toxic int")
    out = QM.score(frame(spark, data), labels, keep=["doc_id"]).collect()
    assert len(out) == len(data) and all(0.0 <= r["score"] <= 1.0 for r in out)
    held = [(r["score"] >= 0.3) == (r["doc_id"] < 60) for r in out if r["doc_id"] is not None and r["doc_id"] < 100 and r["doc_id"] % 3 == 0]
    assert sum(held) / len(held) > 0.95
    one = QM.score(frame(spark, data), labels.where("quality = 1"), keep=["doc_id"]).first()
    assert one["score"] > 0.9
    assert QM.score(frame(spark, data), labels.limit(0), keep=["doc_id"]).first()["score"] == 0.5


def test_rules_from_tree_text():
    text = """RandomForestClassificationModel: uid=x, numTrees=1
  Tree 0 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 1 <= 2.0)
      Predict: 0.0
     Else (feature 1 > 2.0)
      Predict: 1.0
    Else (feature 0 > 0.5)
     Predict: 1.0
"""
    rules = QM.rules_of(text, ["a", "b"])
    assert set(rules) == {(("a", False, 0.5),), (("a", True, 0.5),), (("a", False, 0.5), ("b", False, 2.0)),
                          (("a", False, 0.5), ("b", True, 2.0))}


def test_pipeline_stages(spark):
    import corpus_pipeline
    data = corpus(13) + rows(["token = 'abcdef0123456789' " + sentence(random.Random(1))], 950)
    docs = frame(spark, data).withColumn("extra", F.lit("kept"))
    ids = {d[0] for d in data}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name == "best_fit_packing":
            assert {r["doc_id"] for r in out.select("doc_id").collect()} <= ids
            break
        assert out.columns == docs.columns, name
        rows_out = out.collect()
        if name == "simhash_dedup":
            assert len({r["doc_id"] for r in rows_out}) == len(rows_out)
        if name == "secret_scan":
            text = next(r["text"] for r in rows_out if r["doc_id"] == 950)
            assert "abcdef0123456789" not in text and "[SECRET]" in text
        docs = spark.createDataFrame(rows_out, docs.schema)
    empty = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, "").count() == 0


def test_sum_index_finds_a_filling_where_one_is_there():
    """Against all combinations of one to three lengths, under their counts."""
    from itertools import combinations_with_replacement as some
    rng = np.random.default_rng(8)
    for _ in range(20):
        have = rng.integers(0, 3, 41) * rng.integers(0, 2, 41)
        have[0] = 0
        index = PK.SumIndex(have)
        lengths = [x for x in range(1, 41) if have[x]]
        for base in rng.choice(lengths, 12).tolist():
            if have[base]:
                total = 40 - base
                fits = [c for k in (1, 2, 3) for c in some(lengths, k)
                        if sum(c) == total and all(have[x] >= [base, *c].count(x) for x in c)]
                found = index.fill(total, [base])
                assert (found is None) == (not fits)
                if found:
                    assert tuple(sorted(found)) in fits and len(found) == len(fits[0])
                    have[found[0]] -= 1                     # counts fall while the index is used


def test_tokeniser_blocks():
    """Null, empty and blank texts, blanks at both ends and parts seen in an earlier block."""
    import pyarrow as pa
    path = P.path("word_bpe_49k.json")
    tokens, library = PK.WordTokenizer(path), Tokenizer.from_file(path)
    for texts in ([None, "", " \n\t ", "  one Two three\n"], [], ["two one", None, "Été one's 12 \U0001f600 "]):
        got = tokens.encode(pa.array(texts, pa.string()))
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == \
            [library.encode(t or "", add_special_tokens=False).ids for t in texts]
