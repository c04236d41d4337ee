"""The divergence audit against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ticksmith.llm import divergence, queries

from .test_llm import DOCS, empty, odd_docs


def plain(rows, min_docs):
    docs = [(r.lang or "", r.source or "", re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r.text or "").encode().lower())) for r in rows]
    seen, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        seen[lang].update(set(words))
        count[lang, source].update(words)
    kept = {lang: sorted(t for t, n in c.items() if n >= min_docs) for lang, c in seen.items()}
    out = []
    for lang, source in count:
        terms = kept[lang]
        p = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in terms) + 5 * len(terms)) for t in terms}
        own = p(count[lang, source])
        whole = p(sum((c for (la, _), c in count.items() if la == lang), Counter()))
        pairs = []
        for la, item in count:
            if la == lang and item != source:
                other = p(count[la, item])
                pairs.append((sum(abs(own[t] - other[t]) for t in terms), item.encode()))
        more = [(own[t] - whole[t], t) for t in terms if count[lang, source][t] and own[t] > whole[t]]
        for part, found, top in (("pair", pairs, None), ("term", more, 50)):
            ranked = sorted(found, key=lambda x: (-x[0], x[1]))[:top]
            out += [(lang, source, part, item.decode(), value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def many_docs(spark):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 4))) for _ in range(120)]
    rows = [(i, " ".join(rng.choice(vocabulary[: 20 + 10 * (i % 11)]) + rng.choice(["", ",", "3", "'s", " X_y"]) for _ in range(rng.randrange(60))),
             rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", None, "", "ä"]), 1, "r") for i in range(260)]
    return odd_docs(spark).unionByName(spark.createDataFrame(rows, DOCS))


def values(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r.rank) for r in df.collect())


def test_audit_equals_plain_counting(spark):
    docs = many_docs(spark)
    got = values(divergence.audit(docs.repartition(5)))
    assert got == plain(docs.collect(), 30)
    assert {r[2] for r in got} == {"pair", "term"} and len({r[0] for r in got}) == 3


def test_small_shards_rounds_tiles_and_flushes_change_nothing(spark, monkeypatch):
    """Many shards in many broadcast rounds, tiles of two sources, tasks that hand on their sums early."""
    docs = many_docs(spark)
    want = plain(docs.collect(), 3)
    for name, value in (("SHARD_TERMS", 7), ("BROADCAST_BYTES", 900), ("TILE", 2), ("HELD_TERMS", 20), ("DENSE_SLOTS", 30)):
        monkeypatch.setattr(divergence, name, value)
    shards = divergence.build_shards(divergence.kept_terms(docs.fillna("", ["lang", "source"]).withColumn("text", docs.text.cast("binary")), 3))
    dealt, rounds = divergence._rounds(shards)
    assert rounds > 2 and shards.count() > 20
    assert values(divergence.audit(docs, 3)) == want


def test_recount_hands_on_lists_not_places(spark):
    """A row for every shard that a source has terms of, not one for every term; the counts in it are the plain ones."""
    docs = many_docs(spark).fillna("", ["lang", "source"]).withColumn("text", F.col("text").cast("binary"))
    shards = divergence.build_shards(divergence.kept_terms(docs, 3))
    rows = divergence.recount(docs.repartition(5), shards).collect()
    assert len({(r.lang, r.source, r.part) for r in rows}) == len(rows)
    assert sum(len(r.slot) for r in rows) > 20 * len(rows)
    stored = {(r.lang, r.part): divergence.Shard.unpack(r.sizes, r.bits, r.terms, r.ends).terms.to_pylist() for r in shards.collect()}
    got = {(r.lang, r.source, stored[r.lang, r.part][slot]): n for r in rows for slot, n in zip(r.slot, r.n)}
    want = Counter()
    for r in docs.collect():
        want.update((r.lang, r.source, t) for t in re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", bytes(r.text or b"").lower()))
    kept = {(lang, t) for (lang, _), terms in stored.items() for t in terms}
    assert got == {k: n for k, n in want.items() if (k[0], k[2]) in kept}


def test_blocks_cut_every_text_whole(spark, monkeypatch):
    """Blocks of a few bytes, so a text has a block of its own, change nothing."""
    docs = many_docs(spark)
    want = plain(docs.collect(), 3)
    for name, value in (("BLOCK_BYTES", 9), ("HELD_TERMS", 40), ("DENSE_SLOTS", 30), ("BATCH", 3)):
        monkeypatch.setattr(divergence, name, value)
    assert values(divergence.audit(docs, 3)) == want


def test_block_of_odd_texts():
    texts = [None, b"", b"A a b", b"12 ,.", "Éé É z\x00z".encode(), b"a", b"B"]
    block = divergence.Block(texts)
    words = block.words.to_pylist()
    assert [(d, words[w]) for d, w in zip(block.doc.tolist(), block.word.tolist())] == [
        (k, t) for k, text in enumerate(texts) for t in re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or b"").lower())]
    assert [x.tolist() for x in divergence.Block([None, b"1"]).found(np.zeros(2, np.int64), once=True)] == [[], [], []]


def test_terms_beyond_the_top_are_cut_by_value_only(spark):
    """More terms than the top in a shard: ties of the last value all reach the ranking."""
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(140)]
    rows = [(i, " ".join(words[i % 2::2]), "en", "ab"[i % 2], 1, "") for i in range(80)]
    docs = spark.createDataFrame(rows, DOCS)
    got = values(divergence.audit(docs))
    assert got == plain(docs.collect(), 30) and sum(r[2] == "term" for r in got) == 100


def test_languages_without_kept_terms_have_zero_pairs(spark):
    docs = spark.createDataFrame([(1, "one", "en", "a", 1, ""), (2, None, "en", "b", 1, ""), (3, "x", "de", "a", 1, "")], DOCS)
    assert values(divergence.audit(docs)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_empty_table(spark):
    got = divergence.audit(empty(spark))
    assert got.collect() == [] and got.columns == ["lang", "source", "part", "item", "value", "rank"]


@pytest.mark.parametrize("n", [0, 1, 2, 500, 5_000])
def test_perfect_hash_is_minimal_and_verified(n):
    terms = [b"t%d" % i for i in range(n)]
    of = lambda ts: np.array([xxhash.xxh3_64_intdigest(t) for t in ts], np.uint64)
    shard = divergence.Shard.unpack(*divergence.Shard.build(terms, of(terms)).pack())
    assert sorted(shard.slots(terms, of(terms)).tolist()) == list(range(n))
    others = [b"u%d" % i for i in range(1_000)]
    assert (shard.slots(others, of(others)) == -1).all()
    assert len(shard.bits) <= 5 * n + 40


def test_equal_hashes_are_told_apart():
    """Terms whose 64-bit hashes are equal never part on a level; they are listed."""
    terms = [b"a", b"b", b"c", b"d"]
    hashes = np.array([7, 7, 9, 7], np.uint64)
    shard = divergence.Shard.unpack(*divergence.Shard.build(terms, hashes).pack())
    assert sorted(shard.slots(terms, hashes).tolist()) == [0, 1, 2, 3]
    assert shard.slots([b"e"], np.array([7], np.uint64)).tolist() == [-1]


def test_share_is_exact():
    n = np.array([0, 1, 5, 10**12, 8 * 10**15, 3], np.int64)
    assert divergence.share(n, 9 * 10**15).tolist() == [int(x) * 10**9 // (9 * 10**15) for x in n]


def test_query_reads_the_table(spark, tmp_root):
    many_docs(spark).write.parquet(f"{tmp_root}/documents.parquet")
    assert values(queries.op11(spark, tmp_root)) == plain(many_docs(spark).collect(), 30)
