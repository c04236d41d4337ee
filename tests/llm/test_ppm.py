"""Byte context trees against plain sums, and as a language filter."""

import functools
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from ticksmith.llm import ppm


def plain_length(train: list[bytes], text: bytes, order: int) -> float:
    """Code length by the definition: counts after every context, escapes by method C with exclusion."""
    after: dict[bytes, Counter] = {}
    for t in train:
        t = b" " * order + t
        for k in range(order, len(t)):
            for d in range(order + 1):
                after.setdefault(t[k - d:k], Counter())[t[k]] += 1

    @functools.cache
    def p(context: bytes | None, c: int) -> float:
        if context is None:
            return 1 / 256
        shorter = context[1:] if context else None
        here = after.get(context)
        if not here:
            return p(shorter, c)
        n, d = sum(here.values()), len(here)
        if c in here:
            return here[c] / (n + d)
        return d / (n + d) * p(shorter, c) / sum(p(shorter, z) for z in range(256) if z not in here)

    text = b" " * order + text
    return -sum(np.log2(p(text[k - order:k], text[k])) for k in range(order, len(text)))


def test_code_lengths_equal_plain_sums(monkeypatch):
    rng = random.Random(4)
    train = [bytes(rng.choice(b"abc \xc3\xa9") for _ in range(300)) for _ in range(4)] + [b""]
    texts = [b"abca cbzab", b"", b"\xff\x00", "été ça".encode(), bytes(rng.choice(b"abcxyz") for _ in range(60))]
    model = ppm.Model(["a", "b"], [ppm.grow(train), ppm.grow([b"zzz"])], [9.0, 9.0])
    want = [[plain_length(own, t, ppm.ORDER) for own in (train, [b"zzz"])] for t in texts]
    got = model.code_lengths(texts)
    assert np.allclose(got, want, rtol=1e-5)
    monkeypatch.setattr(ppm, "PART", 16)               # texts in pieces, and a memory that forgets
    monkeypatch.setattr(ppm, "MEMO", 16)
    again = ppm.Model(model.langs, model.trees, [9.0, 9.0])
    assert np.allclose(again.code_lengths(texts * 3), np.concatenate([got] * 3), rtol=1e-6)
    assert np.allclose(ppm.Model(["x"], [ppm.grow([])], [9.0]).code_lengths([b"abc", b""]), [[24], [0]])


def invented(rng: random.Random, letters: str, words: int = 120) -> list[str]:
    return ["".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(words)]


def spoken(spark, tongues: dict, texts: int, seed: int):
    rng = random.Random(seed)
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randint(15, 60))) + ".", lang)
            for k, (lang, words) in enumerate((lang, w) for lang, w in tongues.items() for _ in range(texts))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_two_cyrillic_languages_and_an_unlearned_one(spark):
    rng = random.Random(7)
    tongues = {"x1": invented(rng, "абвгдежзиклмнопрст"), "x2": invented(rng, "абвгдежзиклмнопрст"), "la": invented(rng, "abcdefghilmnopst")}
    docs = spoken(spark, tongues, 40, 1)
    model = ppm.train(docs.where("lang <> 'la'"), F.col("doc_id") % 4 != 0)
    assert model.langs == ["x1", "x2"]
    got = ppm.predict(docs, model).join(docs, "doc_id").where("doc_id % 4 = 0").collect()
    assert all(r.lang_pred == r.lang and r.score > 0.99 for r in got if r.lang != "la")
    assert sum(r.fits for r in got if r.lang != "la") >= 0.95 * 20 and not any(r.fits for r in got if r.lang == "la")
    upper = ppm.predict(docs.withColumn("text", F.upper("text")), model).collect()
    same = {r.doc_id: r.code_bits for r in ppm.predict(docs, model).collect()}
    assert all(np.isclose(r.code_bits, same[r.doc_id]) for r in upper)


def test_two_hundred_languages_are_sparse(spark):
    rng = random.Random(8)
    tongues = {f"l{k:03}": invented(rng, "".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 12)), 40) for k in range(200)}
    docs = spoken(spark, tongues, 12, 2).repartition(4)
    model = ppm.train(docs, F.col("doc_id") % 6 != 0)
    assert len(model.langs) == 200
    held = sum(x.nbytes for t in model.trees for x in t[:4])
    assert held < 200 * 300_000                                # far below a dense table of contexts each
    got = ppm.predict(docs, model).join(docs, "doc_id").where("doc_id % 6 = 0")
    assert got.where("lang_pred = lang").count() >= 0.98 * got.count()


def test_odd_texts_and_tables(spark):
    schema = "doc_id long, text string, lang string, fits int"                 # fits: a clashing extra column
    odd = [(1, None, "a", 0), (2, "", "a", 0), (3, " 12 !? ", "a", 0), (4, "one", None, 0), (4, "one", None, 0), (None, "one two", "b", 0),
           (2**53 + 1, "two " * 50_000, "b", 0)]
    docs = spark.createDataFrame(odd, schema)
    got = sorted(((r.doc_id, r.lang_pred, r.score, r.fits) for r in ppm.predict(docs, ppm.train(docs, F.lit(True))).collect()), key=str)
    assert len(got) == 7 and all(0 <= s <= 1 for _, _, s, _ in got)
    by = {i: (lang, s, f) for i, lang, s, f in got}
    assert by[1] == by[2] == by[3] == ("und", 0.0, False) and by[2**53 + 1][0] == "b" and by[None][0] == "b"
    none = ppm.train(docs.limit(0), F.lit(True))
    assert {(r.lang_pred, r.score) for r in ppm.predict(docs, none).collect()} == {("und", 0.0)}
    assert ppm.predict(docs.limit(0), none).count() == 0
