"""Periodic runs against a plain scan of every period."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from ticksmith.llm import periodic, queries

from .test_llm import DOCS, empty, odd_docs


def plain_runs(words, least=12):
    """Every maximal stretch with a period, by the smallest one."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(least, 2 * q):
                found.setdefault((s, i + q), q)
            i = max(i, s + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and words:
        a = g % len(words)
        p = 1 + (len(words) - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
    runs = plain_runs(words)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_plain_scan(seed, monkeypatch):
    """Random texts side by side, few letters, some of them periodic; small pieces of the grid."""
    rng = random.Random(seed)
    monkeypatch.setattr(periodic, "GRID", rng.choice([3, 50, 400_000]))
    texts = []
    for _ in range(rng.randint(1, 8)):
        words = [rng.randrange(rng.choice([1, 2, 3, 8])) for _ in range(rng.choice([0, 1, 2, 5, 20, 60, 150]))]
        if len(words) > 20 and rng.random() < 0.5:
            a = rng.randrange(len(words))
            p = 1 + rng.randrange(max(1, (len(words) - a) // 2))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        texts.append(words)
    least = rng.choice([2, 4, 12])
    owner, *run = periodic.find_runs(np.array(sum(texts, []), dtype=np.int64), np.array([len(t) for t in texts]), least)
    for k, words in enumerate(texts):
        assert list(zip(*(x[owner == k].tolist() for x in run))) == plain_runs(words, least)


def test_extensions_equal_letter_by_letter():
    rng = np.random.default_rng(4)
    for letters in (1, 2, 5):
        text = rng.integers(0, letters, 300)
        text[150:250] = text[100:200]
        laid = np.concatenate([[0], text, [0]])
        fence = np.zeros(len(laid), bool)
        fence[[0, -1]] = True
        grammar = periodic.Grammar(laid, fence)
        x, y = np.triu_indices(300, 1)
        pick = rng.choice(len(x), 3000, replace=False)
        x, y = x[pick] + 1, y[pick] + 1
        for forward in (True, False):
            got = grammar.extend(x, y, forward)
            for i, j, n in zip(x.tolist(), y.tolist(), got.tolist()):
                want = 0
                while (j + want <= 300 and laid[i + want] == laid[j + want]) if forward else (i - want > 1 and laid[i - 1 - want] == laid[j - 1 - want]):
                    want += 1
                assert n == want


def test_grammar_shrinks_to_one_symbol_a_text():
    laid = np.zeros(4_098, np.int64)
    laid[1:-1] = np.random.default_rng(1).integers(0, 50, 4_096)
    fence = np.zeros(len(laid), bool)
    fence[[0, -1]] = True
    grammar = periodic.Grammar(laid, fence)
    assert len(grammar.symbols[-1]) == 3
    assert sum(map(len, grammar.symbols)) < 10 * len(laid)


def test_query_equals_plain_scan(spark, tmp_root):
    """op12 over odd rows: nulls, empty and long texts, repeated rows, ids that are edited, many blocks."""
    rng = random.Random(9)
    line = " ".join(rng.choice("abcdefgh") + str(rng.randrange(9)) for _ in range(25))
    rows = [(i, " ".join(rng.choice(["a", "b", "c", "dd", "é"]) for _ in range(rng.randrange(90))), "en", "s", None, "r") for i in range(150)]
    rows += [(900, f"{line}\n{line}\n{line}", None, None, None, None), (901, "x " * 700, "en", "s", 1, "r"), (2**60 + 1, line + " " + line, "en", "s", 1, "r")]
    docs = odd_docs(spark).where("doc_id is null or doc_id <> 17").unionByName(spark.createDataFrame(rows, DOCS))
    docs.repartition(3).write.parquet(f"{tmp_root}/documents.parquet")
    got = [tuple(r) for r in queries.op12(spark, tmp_root).collect()]
    want = [plain_row(r.doc_id, r.text) for r in docs.collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r[:2]) + (r[6], r[7])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert sum(r[1] > 0 for r in want) > 10


def test_blocks_do_not_change_results(spark, monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK_WORDS", 30)
    docs = odd_docs(spark)
    small = sorted(map(str, periodic.periodic_runs(docs).collect()))
    monkeypatch.undo()
    assert small == sorted(map(str, periodic.periodic_runs(docs).collect()))


def test_empty_table(spark, tmp_root):
    empty(spark).write.parquet(f"{tmp_root}/documents.parquet")
    assert queries.op12(spark, tmp_root).collect() == []
