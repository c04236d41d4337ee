"""Personal data: base against plain patterns, network and chain against numeric and enumerated versions."""

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticksmith.llm import pii, queries
from ticksmith.llm.common import read

from .test_llm import DOCS, SMALL, empty, odd_docs


def plain_base(text):
    """The contract's patterns as they stand."""
    ok = lambda d: sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1])) % 10 == 0
    digits = lambda t: re.sub("[^0-9]", "", t)
    found = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda t: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda t: all(int(x) <= 255 for x in t.split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda t: 13 <= len(digits(t)) <= 19 and ok(digits(t))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda t: 9 <= len(digits(t)) <= 15)]
    return [(kind, m.start(), m.end()) for kind, pattern, good in found for m in re.finditer(pattern, text) if good(m.group())]


@pytest.mark.parametrize("seed", range(30))
def test_base_equals_plain_patterns(seed):
    rng = random.Random(seed)
    pieces = ["a@b.c", "@", ".", "x_y%z+1-", "é", "1.2.3.4", "300.1.1.1", "0001.2.3.04", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567",
              "+49 30 1234567890123456", " ", "  ", "-", "+", "12", "..", "a.b@c-d.e.f.", "@b.c@d.e", "9", "\n", "😀", "1.2.3.4.5.6.7.8", "+12", "٣"]
    for _ in range(60):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(14)))
        assert pii.base_spans(text) == plain_base(text), text


def test_base_on_long_runs():
    """Long stretches of one class end in time that grows with their length."""
    for text in ("a" * 300_000, "1" * 300_000, "+" * 100_000, "1." * 100_000, "a@" * 100_000, "+1 " + "2" * 200_000):
        pii.base_spans(text)
    assert pii.base_spans("0" * 5_000 + "1.2.3.4") == [("ip", 0, 5_007)]


def double(seed):
    rng = np.random.default_rng(seed)
    p = pii.new_parameters(seed, np.float64)
    p["pairs"], p["first"] = rng.normal(size=p["pairs"].shape), rng.normal(size=p["first"].shape)
    return p, rng


def test_gradient_equals_differences(monkeypatch):
    monkeypatch.setattr(pii, "WIDTH", 7)
    p, rng = double(1)
    x, sizes = pii.encode(["ab@1 .x", "x9", "+1 2"])
    y = pii.label_rows(["ab@1 .x", "x9", "+1 2"], [[("email", 0, 4)], [], [("phone", 0, 3)]])
    _, grads = pii.loss_and_gradient(p, x, sizes, y)
    for name, a in p.items():
        picks = [np.unravel_index(i, a.shape) for i in rng.choice(a.size, min(a.size, 25), replace=False)]
        if name == "wx":
            picks += [(way, c, k) for way in (0, 1) for c in set(x.ravel().tolist()) for k in (0, 20, 40, 60)]
        for at in picks:
            old, eps = a[at], 1e-5
            a[at] = old + eps
            up = pii.loss_and_gradient(p, x, sizes, y)[0]
            a[at] = old - eps
            down = pii.loss_and_gradient(p, x, sizes, y)[0]
            a[at] = old
            assert abs((up - down) / (2 * eps) - grads[name][at]) < 1e-6, (name, at)


def test_chain_equals_enumeration():
    rng = np.random.default_rng(2)
    e, pairs, first = rng.normal(size=(2, 4, 5)), rng.normal(size=(5, 5)), rng.normal(size=5)
    ahead, back, whole = pii.forward_backward(e, pairs, first)
    best = pii.viterbi(e, pairs, first)
    for k in range(2):
        paths = list(itertools.product(range(5), repeat=4))
        scores = np.array([first[q[0]] + sum(e[k, t, q[t]] for t in range(4)) + sum(pairs[q[t], q[t + 1]] for t in range(3)) for q in paths])
        assert tuple(best[k]) == paths[int(scores.argmax())]
        weight = np.exp(scores - whole[k])
        assert abs(weight.sum() - 1) < 1e-9
        for t in range(4):
            for label in range(5):
                want = sum(w for w, q in zip(weight, paths) if q[t] == label)
                assert abs(np.exp(ahead[k, t, label] + back[k, t, label] - whole[k]) - want) < 1e-9


def test_decoded_labels_never_start_inside():
    p, _ = double(3)
    x, sizes = pii.encode(["call 555-1234 or 1.2.3.4", "", "@" * pii.WIDTH])
    path = pii.viterbi(pii.emissions(p, pii.lstm(p, x)["hidden"], sizes), p["pairs"] + pii.FORBIDDEN, p["first"] + pii.STARTS)
    for row, n in zip(path, sizes):
        assert (row[n:] == 0).all()
        for before, here in zip([0, *row], row):
            assert here % 2 == 1 or here == 0 or before in (here, here - 1)


@pytest.mark.parametrize("seed", range(25))
def test_reconciled_set_is_the_best(seed):
    rng = random.Random(seed)
    spans = [(rng.choice(pii.KINDS), a := rng.randrange(30), a + rng.randint(1, 9), rng.randrange(900, 1000) / 1000) for _ in range(rng.randrange(11))]
    base = [("ip", a := rng.randrange(30), a + 2) for _ in range(rng.randrange(2))]
    got = pii.reconcile(spans, base)
    apart = lambda rows: all(p[2] <= q[1] or q[2] <= p[1] for p, q in itertools.combinations(rows, 2))
    free = [s for s in spans if apart([s, base[0]])] if base else spans
    best = max((sum(s[3] for s in c) for n in range(len(free) + 1) for c in itertools.combinations(free, n) if apart(c)), default=0)
    assert apart(got) and set(got) <= set(free) and abs(sum(s[3] for s in got) - best) < 1e-9


def test_windows_hold_every_trigger():
    rng = random.Random(4)
    for n in (0, 1, 95, 96, 97, 144, 145, 1_000):
        text = "".join(rng.choice("ab 1") if rng.random() < 0.05 else "x" for _ in range(n))
        starts = pii.windows_of(text)
        last = max(0, -(-(n - pii.WIDTH) // pii.STRIDE)) * pii.STRIDE
        want = [s for s in range(0, last + 1, pii.STRIDE) if pii.TRIGGER.search(text[s:s + pii.WIDTH])]
        assert starts == want and (not n or last + pii.WIDTH >= n)


@pytest.fixture(scope="module")
def learned(spark):
    """Learned from three quarters of the windows of a small table; the rest is held out."""
    texts = [r.text for r in read(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    windows = sorted({t[a:a + pii.WIDTH] for t in texts if t for a in pii.windows_of(t)})
    random.Random(1).shuffle(windows)
    cut = len(windows) * 3 // 4
    return pii.fit(windows[:cut], epochs=30), windows[cut:]


def test_held_out_free_forms(learned):
    """Free forms written into held-out windows: most are found whole, look-alikes and plain text give next to nothing."""
    model, windows = learned
    texts, spans = pii.lessons(windows * 4, seed=77)
    base = [pii.base_spans(t) for t in texts]
    more = [{s for s in own if s not in b and s[0] != "card" or s[0] == "card" and s not in b and pii.is_card(t[s[1]:s[2]])}
            for own, b, t in zip(spans, base, texts)]
    got = [{s[:3] for s in row} for row in pii.added_spans(model, texts, base)]
    hit, wanted, found = sum(len(a & b) for a, b in zip(got, more)), sum(map(len, more)), sum(map(len, got))
    assert wanted >= 50 and hit / wanted >= 0.6 and hit / max(found, 1) >= 0.85, (hit, wanted, found)


def test_query_equals_base_and_keeps_it(spark, tmp_root):
    """op13 over odd rows: counts and digest are the base's, and every base span is among all spans."""
    rows = [(50 + i, t, "en", "s", 1, "r") for i, t in enumerate(
        ["é mail a.b@c.de, 10.0.0.1 and +1 (555) 123-4567", "4111 1111 1111 1111 a@b.c a@b.c", "x" * 5_000 + " 1.2.3.4 " + "y " * 3_000 + "9.9.9.9", "😀 1.2.3.4"])]
    docs = odd_docs(spark).unionByName(spark.createDataFrame(rows, DOCS))
    docs.write.parquet(f"{tmp_root}/documents.parquet")
    got = sorted(map(tuple, queries.op13(spark, tmp_root).collect()), key=str)
    want = []
    for r in docs.collect():
        base = plain_base(r.text or "")
        counts = [sum(s[0] == k for s in base) for k in pii.KINDS]
        want.append((r.doc_id, *counts, hashlib.sha256(",".join("%s:%d:%d" % s for s in base).encode()).hexdigest()))
    assert [r[:6] for r in got] == sorted(want, key=str)
    by_id = {r[0]: r[6].split(",") for r in got}
    for r in docs.collect():
        if r.doc_id is not None:
            assert {"%s:%d:%d" % s for s in plain_base(r.text or "")} <= set(by_id[r.doc_id])


def test_clean_texts_stay_clean(spark, learned):
    docs = read(spark, SMALL, "documents").where(~F.col("text").rlike("[0-9@]"))
    assert docs.count() > 100
    assert pii.scan(docs, learned[0]).where(F.size("spans") > 0).count() == 0


def test_sample_does_not_depend_on_partitions(spark, monkeypatch):
    docs = read(spark, SMALL, "documents")
    samples = [[tuple(r) for r in pii.sample_windows(docs.repartition(k), 20).collect()] for k in (1, 7)]
    assert samples[0] == samples[1] and len(samples[0]) == 20


def test_tables_without_windows(spark, tmp_root):
    assert pii.train(empty(spark)) is None
    plain = spark.createDataFrame([(1, "no sign at all", None, None, None, None), (None, None, None, None, None, None)], DOCS)
    assert pii.train(plain) is None
    assert [tuple(r) for r in pii.scan(plain, None).orderBy("doc_id").collect()] == [(None, []), (1, [])]
    empty(spark).write.parquet(f"{tmp_root}/documents.parquet")
    assert queries.op13(spark, tmp_root).collect() == []


def test_mask():
    assert pii.mask("ab 1.2.3.4 cd a@b.c", [("email", 14, 19), ("ip", 3, 10), ("phone", 5, 8)]) == "ab <ip> cd <email>"
