"""Small fixtures and brute-force versions for the training-data operators."""

from __future__ import annotations

import random

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])

SYLLABLES = {"en": "the ing er on th re an ed nd ha".split(), "de": "sch ung ein keit ver ich tz pf ü ß".split(),
             "fr": "eau oi que ment ère é ai ou le ç".split()}


def sentence(rng, lang="en", words=12):
    s = SYLLABLES[lang]
    return " ".join("".join(rng.choice(s) for _ in range(rng.randint(1, 4))) for _ in range(words)).capitalize() + "."


def odd_texts():
    """Null, empty, blank, very long, without letters, without blanks, odd characters."""
    return [None, "", " ", "\n\n", "12 34 !!", "a", "x" * 40000, "ab " * 9000, "Éa İ ſ   \x00\x1c\x85 😀 naïve ﬁ",
            "line one\nline two\n\nline one", "\t\x0b\x0c\r tabs \r\n"]


def rows(texts, start=0, lang=None):
    return [(start + i, t, lang, "s", None if t is None else len(t)) for i, t in enumerate(texts)]


def frame(spark, data):
    return spark.createDataFrame(data, DOCS)


def corpus(seed=1, n=60):
    """Prose in three languages with copies, near copies, shared passages and odd rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        out.append((i, "\n".join(sentence(rng, lang, rng.randint(4, 30)) for _ in range(rng.randint(1, 8))), lang))
    shared = sentence(rng, "en", 70)
    texts = [t for _, t, _ in out]
    texts += [texts[0], texts[0], texts[3] + " more", texts[4] + "\n" + shared, shared + "\n" + texts[5], shared]
    langs = [l for _, _, l in out] + ["en"] * 6
    odd = odd_texts()
    data = [(i, t, l, "s", len(t)) for i, (t, l) in enumerate(zip(texts, langs))]
    data += rows(odd, len(data))
    data += [(None, texts[1], None, None, None), data[2], data[2]]          # null id, repeated rows
    return data
