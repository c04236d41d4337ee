"""Training-data operators against brute force on small tables with odd rows."""

import gzip
import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticksmith.llm import (fingerprints, jaccard, langid, licenses, mixing, neardup, packing, quality, queries, toxicity,
                           warc)
from ticksmith.llm.common import components, fold, read

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string"   # row: a clashing extra column


def odd_docs(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    base = [" ".join(word() for _ in range(60)) for _ in range(6)]
    texts = [None, "", "  \n ", "one", "two words", *base, base[0], base[0].upper(), base[1].rsplit(" ", 1)[0],
             base[2] + " tail", base[3].replace(" ", "\t", 5), "é" * 50, "x " * 20_000, "MIT License", "the Apache LICENSE, mit license"]
    rows = [(i, t, "en", "s" + str(i % 3) if i % 7 else None, None, "r") for i, t in enumerate(texts)]
    rows += [rows[5], (None, base[4], None, None, None, None), (None, "alone here without an id at all", None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def reach(nodes, links):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n
    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_many_tasks(spark, monkeypatch):
    """A chain, a star and equal, self and null links, dealt over several contracting tasks."""
    from ticksmith.llm import common
    monkeypatch.setattr(common, "CONTRACT", 7)
    links = [(i, i + 1) for i in range(100, 140)] + [(500, 500 + i) for i in range(30)] + [(-3, 900), (-3, 900), (7, 7), (None, 8)]
    df = spark.createDataFrame(links, "a long, b long").repartition(6)
    got = {r.node: r.component for r in common.components(df).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{500 + i: 500 for i in range(30)}, -3: -3, 900: -3}
    assert common.components(df.where("a = 7")).count() == 0


def test_components_match_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 460)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = reach({x for p in links for x in p}, links)
    assert all(got.get(n, n) == c for n, c in want.items())


# ------------------------------------------------------------------ 1

def test_neardup_equals_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 16))
    rows = []
    for i in range(150):
        v = base[i % 12] + rng.normal(size=16) * rng.choice([0.0, 0.02, 0.12, 0.2])
        rows.append((i, v.astype(np.float32).tolist(), i % 2 if i % 11 else None))
    rows += [(200, None, 0), (201, [0.0] * 16, 0), (202, [float("nan")] * 16, 0), (203, [1.0, None] + [0.0] * 14, 0),
             (204, [1.0, 2.0], 0), (205, [2.0, 4.0], 0), (206, rows[1][1], 1), (207, [3 * x for x in rows[1][1]], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neardup.near_duplicates(df).collect()}
    good = [(i, np.array(v, float), x) for i, v, x in rows if x is not None and v is not None and None not in v
            and np.isfinite(v).all() and np.any(v)]
    links = [(a[0], b[0]) for k, a in enumerate(good) for b in good[k + 1:] if a[2] == b[2] and len(a[1]) == len(b[1])
             and a[1] @ b[1] / (np.linalg.norm(a[1]) * np.linalg.norm(b[1])) >= 0.98]
    degree, comp = Counter(x for p in links for x in p), reach([r[0] for r in rows], links)
    assert got == {i: (degree[i], c, c == i) for i, c in comp.items()}
    assert len(links) > 50
    assert neardup.near_duplicates(df.limit(0)).count() == 0


def test_neardup_null_component_links_with_nothing(spark):
    """Nulls inside a vector are skipped by hashes; such a row still links with nothing."""
    rows = [(1, [1.0, 2.0, 3.0], 0), (2, [1.0, 2.0, 3.0], 0), (3, [1.0, None, 2.0, 3.0], 0), (4, [1.0, 2.0, None, 3.0], 0), (5, [], 0),
            (6, [-0.0, 1.0, 0.0], 0), (7, [0.0, 1.0, 0.0], 0), (8, [1.0, float("inf"), 2.0, 3.0], 0), (None, [1.0, None, 2.0, 3.0], 0)]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept)
           for r in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    alone = {i: (0, i, True) for i in (3, 4, 5, 8)}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 6: (1, 6, True), 7: (1, 6, False), None: (0, None, False), **alone}


def test_neardup_ids_that_collide_are_dealt_again(spark, monkeypatch):
    """Class ids of a hash with many collisions: the next salt is taken, results stay exact."""
    asked = []
    whole = neardup.class_hash

    def poor(salt):
        asked.append(salt)
        return whole(salt) % 2 if salt < 2 else whole(salt)
    monkeypatch.setattr(neardup, "class_hash", poor)
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist() if i < 10 else None, 0) for i in range(10)]
    rows += [(100 + i, [2 * x for x in v], 0) for i, v, _ in rows]
    got = {r.vec_id: (r.n_links, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    assert got == {**{i: (1, i) for i in range(10)}, **{100 + i: (1, i) for i in range(10)}} and max(asked) == 2


def test_neardup_blocks_count_every_link_once(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = np.random.default_rng(8)
    base = rng.normal(size=16)
    rows = [(i, (base + rng.normal(size=16) * 1e-3).astype(np.float32).tolist(), 1) for i in range(30)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(29, 0)}


# ------------------------------------------------------------------ 2

def test_licenses_count_every_place(spark):
    got = {r.doc_id: r for r in licenses.scan(odd_docs(spark).where("doc_id is not null")).collect()}
    texts = {r.doc_id: r.text or "" for r in odd_docs(spark).collect()}
    for i, r in got.items():
        import re
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[i]))
        at = [(k, x) for k in range(len(words)) for p, x in licenses.BASE.items() if words[k:k + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(words), len(at))
        assert (r.first_word, r.last_word) == (min((k for k, _ in at), default=None), max((k for k, _ in at), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in at}))
    assert licenses.scan(empty(spark)).count() == 0


@pytest.mark.parametrize("text, value, labels", [
    ("MIT", 1.0, {"mit"}), ("GPL-2.0-only OR MIT", 1.0, {"gpl", "mit"}), ("GPL-3.0+ AND Apache-2.0", 0.4, {"gpl", "apache"}),
    ("GPL-2.0 WITH Classpath-exception-2.0", 0.6, {"gpl"}), ("MIT or GPL-2.0 and AGPL-3.0", 1.0, {"mit", "gpl", "agpl"}),
    ("(MIT or GPL-2.0) and AGPL-3.0", 0.3, {"mit", "gpl", "agpl"})])
def test_expressions(text, value, labels):
    assert licenses.evaluate(text) == (value, labels)


@pytest.mark.parametrize("text", ["", "MIT OR", "(MIT", "MIT)", "MIT GPL-2.0", "AND MIT", "()"])
def test_malformed_expressions(text):
    with pytest.raises(ValueError):
        licenses.evaluate(text)


def test_tag_expression_is_evaluated():
    r = licenses.scan_text(b"/* SPDX-License-Identifier: MIT OR GPL-2.0 */ code", licenses.automaton())
    assert r[5] == "gpl,mit" and r[6] == 1.0 and r[7] == ["MIT OR GPL-2.0"]


@pytest.mark.parametrize("text, expression, labels", [
    ("Apache-2.0 Copyright 2020 X", "Apache-2.0", "apache"), ("MIT OR GPL-2.0. This file is free", "MIT OR GPL-2.0", "gpl,mit"),
    ("(MIT OR BSD-2-Clause) (see LICENSE)", "(MIT OR BSD-2-Clause)", "bsd,mit"), ("GPL-2.0 WITH Classpath-exception-2.0 All code", None, "gpl"),
    ("MIT and", "MIT and", "unknown"), ("(MIT GPL-2.0)", "(MIT GPL-2.0)", "unknown"), ("MIT) rest", None, "unknown"), ("", "", "unknown")])
def test_prose_after_a_tag_is_left_out(text, expression, labels):
    r = licenses.scan_text(b"x SPDX-License-Identifier: " + text.encode(), licenses.automaton())
    assert r[5] == labels and (expression is None or r[7] == [expression])


# ------------------------------------------------------------------ 3, 5, 7

def test_crf_messages_equal_enumeration():
    rng = np.random.default_rng(2)
    odds, pairs = rng.normal(size=5), rng.normal(size=(2, 2))
    total = np.zeros((5, 2))
    for code in range(32):
        y = [code >> k & 1 for k in range(5)]
        w = np.exp(sum(o for o, k in zip(odds, y) if k) + sum(pairs[a, b] for a, b in zip(y, y[1:])))
        for k in range(5):
            total[k, y[k]] += w
    got, _, _ = quality.chain(np.concatenate([odds, odds[:1]]), np.array([5, 1]), pairs)
    assert np.allclose(got[:5], np.log(total[:, 1] / total[:, 0])) and np.isclose(got[5], odds[0])


@pytest.mark.parametrize("name, label, least", [("op3_quality_crf", "quality", 0.9), ("op5_toxicity_ftrl", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    got = queries.REGISTRY[name](spark, sf).join(read(spark, sf, "labels"), "doc_id").where("held_out")
    assert got.select(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0] >= least


def test_ppm_code_lengths_equal_direct_sums():
    rng = np.random.default_rng(4)
    s, order = langid.SYMBOLS, langid.ORDER
    symbols = langid.base_symbols()
    train = bytes(rng.choice(list(b"abc "), 3000))
    x = symbols[np.frombuffer(b"   " + train, np.uint8)].astype(int)
    counts = np.zeros(s ** (order + 1), np.float32)
    for k in range(len(x) - order):
        counts[int(np.polyval(x[k:k + order + 1], s))] += 1
    model = langid.Model(symbols, ["a"], [counts])
    after = [Counter() for _ in range(order + 1)]
    for k in range(order, len(x)):
        for d in range(order + 1):
            after[d][tuple(x[k - d:k + 1])] += 1

    def p(context, c):
        if context is None:
            return 1 / s
        here = {t[-1]: n for t, n in after[len(context)].items() if t[:-1] == context}
        shorter = context[1:] if context else None
        if not here:
            return p(shorter, c)
        n, d = sum(here.values()), len(here)
        if c in here:
            return here[c] / n * (n / (n + d))
        return d / (n + d) * p(shorter, c) / sum(p(shorter, z) for z in range(s) if z not in here)

    text = b"abca cbzab"
    y = [0, 0, 0, *symbols[np.frombuffer(text, np.uint8)].astype(int).tolist()]
    want = -sum(np.log2(p(tuple(y[k - order:k]), y[k])) for k in range(order, len(y)))
    assert np.isclose(model.code_lengths([text])[0, 0], want, rtol=1e-4)


def test_language_held_out_and_odd_texts(spark):
    sf = "/root/testdata/sf0.01"
    docs = read(spark, sf, "documents")
    model = langid.train(docs, langid.learn_fold())
    got = langid.predict(docs, model).join(docs, "doc_id").where(~langid.learn_fold())
    assert got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97
    odd = {r.doc_id: r.lang_pred for r in langid.predict(odd_docs(spark), model).collect() if r.doc_id is not None}
    assert odd[0] == odd[1] == odd[2] == "und" and odd[3] != "und"
    assert {r.lang_pred for r in langid.predict(odd_docs(spark), langid.train(empty(spark), F.lit(True))).collect()} == {"und"}


def test_models_on_odd_and_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for model, score, value in ((quality.train, quality.score, 0.5), (toxicity.train, toxicity.score, 0.0)):
        none = model(odd_docs(spark), labels, F.lit(True))
        assert {r.score for r in score(odd_docs(spark), none).collect()} == {value}
    some = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(3, 12)] + [(None, 1, True)], "doc_id long, quality int, toxic boolean")
    some = some.withColumn("toxic", F.col("toxic").cast("int"))
    for module in (quality, toxicity):
        got = module.score(odd_docs(spark), module.train(odd_docs(spark), some, F.lit(True))).collect()
        assert len(got) == odd_docs(spark).count() and all(0 <= r.score <= 1 for r in got)


# ------------------------------------------------------------------ 4

def test_chunk_ids_equal_whole_tokenizer():
    from tokenizers import Tokenizer
    path = queries.tokenizer_file()
    whole, own = Tokenizer.from_file(path), packing.ChunkIds(path, most=50)
    texts = ["Hello, World's 123 été!!", "a\tb\x0bc d e", "é ́x İı ΑΣ ς ǅ", "<|endoftext|>x <|startoftext|>", "",
             " \n\n ", "naïve co-op … “quoted” 日本語 🙂", "don't we'll I'M x\x1cy", "ÀÉÎ " * 30]
    for text in texts:
        assert np.frombuffer(own.encode(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_packing_round_trip(spark):
    path = queries.tokenizer_file()
    docs = odd_docs(spark)
    got = packing.pack(docs, path, group=8).collect()
    ids = packing.ChunkIds(path)
    want = Counter()
    for r in docs.collect():
        whole = np.append(np.frombuffer(ids.encode(r.text or ""), "<u4"), [2]).astype("<u4")
        for s in range(0, len(whole), 4096):
            want[(r.doc_id, s, len(whole[s:s + 4096]), zlib.crc32(whole[s:s + 4096].tobytes()), len(whole))] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack(empty(spark), path).count() == 0


def test_packing_keeps_large_ids_beside_a_null(spark):
    """Ids above 2^53 in the group of a null id come back as they were."""
    ids = [2**53 + 1, None, 2**63 - 1, -2**63, 5, None]
    docs = spark.createDataFrame([(i, f"text {k}") for k, i in enumerate(ids)], "doc_id long, text string")
    got = packing.pack(docs, queries.tokenizer_file()).collect()
    assert Counter(r.doc_id for r in got) == Counter(ids) and len({r.sequence_id for r in got}) == 1


def test_first_fit_equals_plain_scan():
    rng = random.Random(3)
    lengths = sorted((rng.randint(1, 100) for _ in range(300)), reverse=True)
    free, want = [], []
    for n in lengths:
        k = next((k for k, f in enumerate(free) if f >= n), len(free))
        if k == len(free):
            free.append(100)
        want.append((k, 100 - free[k]))
        free[k] -= n
    assert list(zip(*packing.first_fit_decreasing(lengths, 100))) == want


# ------------------------------------------------------------------ 6

def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    return {tuple(words[k:k + 4]) for k in range(max(1, len(words) - 3))}


def test_jaccard_equals_all_pairs(spark):
    rows = odd_docs(spark).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(odd_docs(spark)).collect()), key=str)
    sets = [(r.doc_id, shingles(r.text)) for r in rows if r.doc_id is not None]
    links = [(a, b) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1:] if x and y and 100 * len(x & y) >= 85 * len(x | y)]
    comp = reach([i for i, _ in sets], links)
    known = {frozenset(s): comp[i] for i, s in reversed(sets) if s}
    want = sorted(((r.doc_id, len(shingles(r.text)), comp[r.doc_id] if r.doc_id is not None else known.get(frozenset(shingles(r.text))))
                   for r in rows), key=str)
    assert got == want
    assert jaccard.near_duplicates(empty(spark)).count() == 0


def test_tries_equal_all_pairs_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    rng = random.Random(9)
    vocab = [f"w{k}" for k in range(400)]
    docs = []
    for g in range(3):
        base = [rng.choice(vocab) for _ in range(rng.choice([20, 60, 200]))]
        for _ in range(25):
            own = list(base)
            for _ in range(rng.randint(0, 3)):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            docs.append(" ".join(own[:rng.randint(len(own) * 4 // 5, len(own))]))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(docs)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard.near_duplicates(df).collect()}
    sets = [shingles(t) for t in docs]
    links = [(a, b) for a in range(len(sets)) for b in range(a + 1, len(sets))
             if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    assert got == reach(range(len(sets)), links)


def test_one_document_of_each_group_stays(spark):
    kept = jaccard.keep_one(odd_docs(spark))
    assert kept.columns == odd_docs(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    comp = {r.doc_id: r.component_id for r in jaccard.near_duplicates(odd_docs(spark)).collect()}
    assert sorted(i for i in ids if i is not None) == sorted({c for i, c in comp.items() if i is not None})


# ------------------------------------------------------------------ 8

def test_mix_targets_and_copies(spark):
    rng = random.Random(6)
    rows = [(i, "w " * rng.choice([0, 1, 5, 40, 300]), rng.choice(["a", "b", "c", None])) for i in range(600)]
    rows += [(i, "w " * 5, "tiny") for i in range(700, 703)] + [rows[3]] * 3 + [(None, None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.plan(df).collect()
    assert len(got) == len(rows)
    size = Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    full, target = set(), {}
    while True:                       # the rule as stated: cap, then share the excess by weight
        left = sum(size.values()) - sum(3 * size[s] for s in full)
        share = sum(weight[s] for s in order if s not in full)
        target = {s: 3 * size[s] if s in full else left * weight[s] / share for s in order}
        over = {s for s in order if s not in full and target[s] > 3 * size[s]}
        if not over:
            break
        full |= over
    taken = Counter()
    for r in got:
        assert np.isclose(r.target, target[r.source]) and r.source_size == size[r.source]
        assert r.taken == r.copies * r.size and r.copies <= 3
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 300 for s in order)
    again = {r.row: r.taken for r in mixing.plan(df.repartition(7)).collect()}
    assert again == {r.row: r.taken for r in got}
    mixed = mixing.mix(df)
    assert mixed.columns == df.columns and mixed.count() == sum(r.copies for r in got)
    assert mixing.plan(empty(spark)).count() == 0


# ------------------------------------------------------------------ 9

def test_fingerprints_of_edited_texts(spark):
    docs = odd_docs(spark)
    got = fingerprints.neighbours(docs).collect()
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (-(r[0] if r[0] is not None else -1 << 63), r[1]))
    want = Counter()
    for k, (i, t) in enumerate(rows):
        n, after = len(t) // 3, rows[(k + 1) % len(rows)][1]
        want[(i, len(t), hashlib.sha256((t[:len(t) - n] + after[:n]).encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    texts = {i: t for i, t in rows}
    prints = defaultdict(set)
    for r in got:
        if r.doc_id is not None:
            prints[texts[r.doc_id]].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values())
    assert fingerprints.neighbours(empty(spark)).count() == 0


def test_shared_substrings_share_phrases():
    rng = random.Random(2)
    text = bytes(rng.choice(b"abcdefghij ") for _ in range(6000))
    a, b = fingerprints.sketches([text, b"shifted by some bytes " + text])
    assert fingerprints.likeness(a[None], b[None])[0] > 0.85
    c = fingerprints.sketches([bytes(rng.choice(b"abcdefghij ") for _ in range(6000))])
    assert fingerprints.likeness(a[None], c)[0] < 0.1


# ------------------------------------------------------------------ 10

def test_warc_round_trip(spark):
    pages = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://c/\r\nX: y", None), (4, "http://d/", ""),
             (5, "http://e/", "line\r\n\r\nWARC/1.1\r\n" * 50), (5, "http://e/", "line\r\n\r\nWARC/1.1\r\n" * 50), (None, "n", "<p>x</p>"),
             (7, "http://é/", "é" * 100_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    index = warc.write_archives(df, archive_bytes=600)
    got = {(r.page_id, r.record_type, r.payload_bytes, r.refers_to, r.digest_ok): r for r in warc.read_records(index).collect()}
    first = {}
    for i, _, h in pages:
        first[h or ""] = min(x for x, _, z in pages if x is not None and (z or "") == (h or ""))
    want = {(i, "response" if i == first[h or ""] else "revisit", len((h or "").encode()), None if i == first[h or ""] else first[h or ""], True)
            for i, _, h in pages}
    assert set(got) == want
    for (i, kind, *_), r in got.items():
        if kind == "response":
            assert r.payload.decode() in {h or "" for x, _, h in pages if x == i}
    one = warc.read_records(index.where("page_id = 7")).collect()
    assert len(one) == 1 and one[0].payload_bytes == 200_000
    archive = index.select("archive").first().archive.removeprefix("file:")
    assert gzip.open("/" + archive.lstrip("/")).read().startswith(b"WARC/1.1\r\n")
    assert warc.read_records(warc.write_archives(df.limit(0))).count() == 0


def test_warc_stores_payloads_once(spark):
    """Beside the archives, the shared folder holds light rows alone, and no
    archive passes its size, whatever share of the records ties."""
    rng = random.Random(10)
    text = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=4000))
    hot = text()
    pages = [(i, f"http://{i}/", text()) for i in range(300)] + [(None, "http://n/", hot)] * 60
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    shared, sizes = Path(warc.shared_path(spark, "x").removeprefix("file:")).parent, {}
    before = set(shared.rglob("*"))
    index = warc.write_archives(df, archive_bytes=100_000)
    made = [p for p in shared.rglob("*") if p not in before and p.is_file()]
    for r in index.collect():
        sizes[r.archive] = max(sizes.get(r.archive, 0), r.offset + r.length)
    assert index.count() == 360 and max(sizes.values()) <= 100_000
    assert all(os.path.getsize(a.removeprefix("file:")) == n for a, n in sizes.items())
    assert sum(p.stat().st_size for p in made) < 1.25 * sum(sizes.values())
    assert Counter(r.payload.decode() for r in warc.read_records(index).collect()) == Counter(h for _, _, h in pages)


def test_joined_ranges():
    assert warc.joined_ranges([(0, 5), (5, 5), (200, 5)], gap=10, run=100) == [(0, 10, [0, 1]), (200, 5, [2])]


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline
    docs = read(spark, SMALL, "documents")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.materialise(stage(spark, before, SMALL), "t-" + name)
        assert after.columns == docs.columns, name
        if name != "mix":
            assert after.count() <= before.count()
        before = after
    comp = {r.doc_id: r.component_id for r in jaccard.near_duplicates(before.dropDuplicates(["doc_id"])).collect()}
    assert all(i == c for i, c in comp.items())
    packed = corpus_pipeline.STAGES[-1][1](spark, before, SMALL)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == set(comp)


def test_stages_keep_columns_of_any_name_and_kind(spark):
    """Input columns named _score and _lang, a map and a dotted name pass through the filtering stages; a text is scored once."""
    import corpus_pipeline
    docs = read(spark, SMALL, "documents").withColumns({"_score": F.lit("s"), "_lang": F.lit(7), "m": F.create_map(F.lit("k"), F.col("doc_id")),
                                                       "a.b": F.lit(1)})
    docs = docs.unionByName(docs.where("doc_id < 20"))           # repeated rows
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, docs, SMALL)
        if name == "language":
            plan = after._jdf.queryExecution().executedPlan().toString()
            assert plan.count("ArrowEvalPython [") == 1 and plan.split("ArrowEvalPython [")[1].split("]")[0].count("of(") == 1
        docs = corpus_pipeline.materialise(after, "t-cols-" + name)
    assert {"_score", "_lang", "m", "a.b"} <= set(docs.columns) and docs.count() > 50
    assert docs.where("_score <> 's' or _lang <> 7 or m['k'] <> doc_id").count() == 0
    assert docs.groupBy("doc_id").count().where("count > 1").count() == 0


def five_word_groups(rows):
    """Smallest doc_id of each document's group, from all pairs at five words and 0.8."""
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = {tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    ids = sorted(sets)
    return reach(ids, [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b]
                       and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])])


def test_near_duplicate_stage_equals_all_pairs_at_five_words(spark):
    import corpus_pipeline
    rng = random.Random(12)
    vocab = [f"v{k}" for k in range(5000)]
    rows = []
    for g in range(8):
        base = [rng.choice(vocab) for _ in range(rng.choice([60, 200, 500]))]
        rows.append(base)
        for share in (0.78, 0.82, 0.84, 0.9):                # one end cut off, or words appended
            rows += [base[:int(share * len(base))], base + [rng.choice(vocab) for _ in range(int(len(base) / share) - len(base))]]
        for share in (0.0205, 0.022, 0.03):                  # one-word edits, evenly scattered
            own = list(base)
            for k in range(10, len(own), int(1 / share)):
                own[k] = "edited"
            rows.append(own)
    rows = [(i, " ".join(w)) for i, w in enumerate(rows)]
    rng.shuffle(rows)
    comp = five_word_groups(rows)
    kept = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string"), SMALL)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(comp.values()))
    pair = spark.createDataFrame([(1, " ".join(vocab[:200])), (2, " ".join(vocab[:164]))], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.one_of_each(spark, pair, SMALL).collect()] == [1]      # 160 of 196 shingles shared


def mix_targets(size):
    """Words per source as the mix rule states them: weights 5, 2, 1 in order, at most three times what there is."""
    order = sorted((s for s in size if s is not None)) + [None] * (None in size)
    weight, full = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}, set()
    while True:
        left, share = sum(size.values()) - sum(3 * size[s] for s in full), sum(weight[s] for s in order if s not in full)
        target = {s: 3 * size[s] if s in full else left * weight[s] / share for s in order}
        over = {s for s in order if s not in full and target[s] > 3 * size[s]}
        if not over:
            return target
        full |= over


def test_run_equals_plain_python_per_stage(spark, tmp_root):
    import corpus_pipeline
    from tokenizers import Tokenizer
    docs = read(spark, SMALL, "documents")
    long = [r for r in docs.collect() if len((r.text or "").split()) >= 100][:12]
    cut = [r.asDict() | {"doc_id": 10 ** 6 + k, "text": " ".join(r.text.split()[:round(0.83 * len(r.text.split()))])} for k, r in enumerate(long)]
    docs.unionByName(spark.createDataFrame([tuple(c[x] for x in docs.columns) for c in cut], docs.schema)).write.parquet(f"{tmp_root}/documents.parquet")
    read(spark, SMALL, "labels").write.parquet(f"{tmp_root}/labels.parquet")
    docs = read(spark, tmp_root, "documents")
    got = corpus_pipeline.run(spark, tmp_root).collect()
    good = {r.doc_id for r in quality.score(docs, queries.quality_model(spark, docs, tmp_root)).collect() if r.score >= queries.QUALITY_KEEP}
    docs = docs.where(F.col("doc_id").isin(list(good)))
    known = {r.doc_id for r in langid.predict(docs, langid.train(docs, langid.learn_fold())).collect()
             if r.lang_pred != "und" and r.score >= corpus_pipeline.LANGUAGE_KEEP}
    rows = {r.doc_id: r for r in docs.collect() if r.doc_id in known}
    comp = five_word_groups([(i, r.text) for i, r in rows.items()])
    kept = {i: r for i, r in rows.items() if comp[i] == i}
    assert 0 < len(kept) < len(rows)
    words = {i: len((r.text or "").split()) for i, r in kept.items()}
    size, taken, copies = Counter(), Counter(), Counter(r.doc_id for r in got if r.start == 0)
    for i, r in kept.items():
        size[r.source] += words[i]
        taken[r.source] += copies[i] * words[i]
    target = mix_targets(size)
    assert set(copies) <= set(kept) and max(copies.values()) <= 3
    assert all(abs(taken[s] - target[s]) <= max(words[i] for i, r in kept.items() if r.source == s) for s in size)
    whole, want = Tokenizer.from_file(queries.tokenizer_file()), Counter()
    for i, n in copies.items():
        ids = np.append(np.array(whole.encode(kept[i].text or "", add_special_tokens=False).ids, "<u4"), [2]).astype("<u4")
        for s in range(0, len(ids), 4096):
            want[(i, s, zlib.crc32(ids[s:s + 4096].tobytes()))] += n
    assert Counter((r.doc_id, r.start, r.ids_crc32) for r in got) == want


def test_held_out_toxicity_by_class(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.REGISTRY["op5_toxicity_ftrl"](spark, sf).join(read(spark, sf, "labels"), "doc_id").where("held_out").collect()
    toxic, clean = [r.predicted for r in rows if r.toxic], [r.predicted for r in rows if r.toxic == 0]
    assert sum(toxic) >= 0.5 * len(toxic) > 0 and sum(clean) <= 0.05 * len(clean)      # a model that never says toxic has recall 0


def test_folds(spark):
    got = spark.createDataFrame([(3,), (None,)], "doc_id long").select(fold("doc_id", 4).alias("f")).collect()
    assert [r.f for r in got] == [zlib.crc32(b"3") % 4, 0]
