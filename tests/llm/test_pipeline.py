"""The pipeline's rows against plain steps, and the two learned models against
their definitions."""

import math
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import corpus, frame, rows, sentence
from skyframe.llm import language_id as LI, quality_model as QM, secret_scan as SS
from skyframe.llm.queries import language_model
from test_duplicates import brute_fp, brute_lines

BLANK = " \n\t\x0b\x0c\r"


def plain_pipeline(spark, data):
    """(doc_id, piece, start, length, crc) of every piece; language decisions and
    the dictionary of the secret scan are the fitted ones."""
    docs = frame(spark, data)
    scored = LI.identify(docs, language_model(docs), keep=["doc_id", "text"]).collect()
    spoken = {(r["doc_id"], r["text"]) for r in scored if r["lang_pred"] != "und" and r["score"] > 0}
    assert all(any(c.isalpha() for c in t) for _, t in spoken)
    left = [d for d in data if (d[0], d[1]) in spoken]
    gone = brute_lines(left, 20)
    kept = []
    for d in left:
        out = gone.get((d[0], d[1]), set())
        text = "\n".join(x for i, x in enumerate(d[1].split("\n")) if i not in out)
        if not out or text.strip(BLANK):
            kept.append((d[0], text))
    prints = [brute_fp(t) for _, t in kept]
    group = list(range(len(kept)))
    for _ in range(len(kept)):                              # smallest index over chains of links
        old = list(group)
        for i in range(len(kept)):
            for j in range(len(kept)):
                if (prints[i] ^ prints[j]).bit_count() <= 2:
                    group[i] = group[j] = min(group[i], group[j])
        if old == group:
            break
    best = {}
    for i, (doc, text) in enumerate(kept):
        key = (doc is None, doc or 0)
        if group[i] not in best or key < best[group[i]][0]:
            best[group[i]] = (key, doc, text)
    one = [(doc, text) for _, doc, text in best.values()]
    ranks = SS.word_ranks(spark.createDataFrame(one, "doc_id long, text string"))
    tokenizer = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out = []
    for doc, text in one:
        clean = SS.redact(text, SS.scan(text, ranks=ranks)[0])
        ids = np.array([*tokenizer.encode(clean, add_special_tokens=False).ids, 0], dtype="<u4")
        for k, lo in enumerate(range(0, len(ids), 2048)):
            part = ids[lo:lo + 2048]
            out.append((doc, k, lo, len(part), zlib.crc32(part.tobytes())))
    return out


def test_run_matches_plain_steps(spark, tmp_path):
    import corpus_pipeline
    rng = random.Random(3)
    data = corpus(13, n=40)
    data += rows(["token = 'abcdef0123456789' " + sentence(rng), "Hi", "ok", "Avec.", "password: hunter2\n" + sentence(rng, "en", 3000),
                  "log 1\nlog 1\nlog 1\n" + sentence(rng), sentence(rng, "de", 40), "42 ??"], 900)
    frame(spark, data).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = plain_pipeline(spark, data)
    assert sorted(map(repr, ((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got))) == sorted(map(repr, want))
    assert {900, 901, 902, 903} <= {r["doc_id"] for r in got} and 907 not in {r["doc_id"] for r in got}
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(sequences) <= -(-sum(r["length"] for r in got) // 2048) + 1


def test_stages_with_clashing_columns(spark):
    import corpus_pipeline
    docs = frame(spark, corpus(5, n=12))
    names = ["a.b", "__gone", "__o", "__pred_lang", "row", "part", "kept", "score", "n_lines", "c`d"]
    for i, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(i))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        assert [out.first()[n] for n in names] == list(range(len(names))), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()


@pytest.mark.parametrize("operator", ["secret_scan", "byte_bpe", "suffix_dedup", "quality_rules", "quality_model", "language_id"])
def test_operators_carry_clashing_columns(spark, operator):
    from skyframe.llm import byte_bpe as BB, quality_rules as QR, suffix_dedup as SD
    docs = frame(spark, corpus(6, n=9)).withColumn("a.b", F.lit(7)).withColumn("row", F.lit(8)).withColumn("key", F.lit(9))
    out = {"secret_scan": lambda: SS.find_secrets(docs), "suffix_dedup": lambda: SD.remove_repeats(docs), "quality_rules": lambda: QR.ledger(docs),
           "byte_bpe": lambda: BB.encode(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN),
           "quality_model": lambda: QM.score(docs, spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")),
           "language_id": lambda: LI.identify(docs, language_model(docs))}[operator]()
    got = out.collect()
    assert len(got) == docs.count() and {(r["a.b"], r["row"], r["key"]) for r in got} == {(7, 8, 9)}


def test_kernel_is_the_share_of_common_ngrams(spark):
    texts = ["The cat.", "cat the", "Ünd dér?", "x", "a  b\n\nc", "12", None, "ﬁn de la fin " * 50]
    marks = LI.Landmarks(["the cat sat on the mat", "und der die das", "le chat de la fin", "12 34"])
    assert marks.count == 3

    def grams(t):
        s, out = [0], set()
        for c in t or "":
            code = int(marks.table[ord(c)])
            if code or s[-1]:
                s.append(code)
        s += [0] if s[-1] else []
        for n in (1, 2, 3):
            for i in range(len(s) - n + 1):
                if any(s[i:i + n]):
                    out.add((n, *s[i:i + n]))
        # a gap before the first and behind the last letter counts twice at the end
        return out
    got, some = marks.kernel(texts)
    assert some.tolist() == [any(c.isalpha() for c in t or "") for t in texts]
    again, _ = marks.kernel(["the cat sat on the mat", "und der die das", "le chat de la fin"])
    assert np.allclose(np.diag(again), 1.0) and np.allclose(again, again.T, atol=1e-6)
    words = ["the cat sat on the mat", "und der die das", "le chat de la fin"]
    for r, t in enumerate(texts):
        for c, m in enumerate(words):
            x, y = grams(t), grams(m)
            share = len(x & y) / math.sqrt(len(x) * len(y)) if x else 0.0
            assert abs(got[r, c] - share) < 0.08


def test_more_languages_than_the_old_bound(spark):
    """Every language with labelled rows takes part."""
    rng = random.Random(2)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 4 * 210)]
    data = []
    for lang in range(205):
        own = letters[4 * lang:4 * lang + 4]
        data += [(len(data) + i, " ".join("".join(rng.choice(own) for _ in range(3)) for _ in range(8)), f"l{lang:03d}", "s", 1) for i in range(2)]
    model = LI.train(frame(spark, data), landmarks_per_lang=2)
    assert len(model.langs) == 205


def test_compiled_score_is_the_rules_sum(spark):
    names = list(QM.statistics())[:2]
    weights = [(((names[0], True, 3.0),), 0.7), (((names[0], False, 9.0), (names[1], True, 0.2)), -1.3)]
    data = [(float(a), b / 4) for a in range(12) for b in range(5)] + [(None, 0.5)]
    out = spark.createDataFrame(data, f"`{names[0]}` double, `{names[1]}` double").withColumn("score", QM.Model(0.25, weights).score()).collect()
    for a, b, score in out:
        total = 0.25 + (0.7 if a is not None and a > 3 else 0) + (-1.3 if a is not None and a <= 9 and b > 0.2 else 0)
        assert abs(score - 1 / (1 + math.exp(-total))) < 1e-12
