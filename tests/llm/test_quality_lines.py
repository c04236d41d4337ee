"""Hidden line labels of the quality classifier, against enumeration."""

import itertools

import numpy as np
import pytest

from ticksmith.llm import quality


def enumerated(odds: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals and expected pairs of one chain, over all its labellings."""
    labellings = list(itertools.product((0, 1), repeat=len(odds)))
    scores = np.array([np.dot(x, odds) + sum(pairs[a, b] for a, b in itertools.pairwise(x)) for x in labellings])
    mass = np.exp(scores - scores.max())
    mass /= mass.sum()
    joint = np.zeros(4)
    for x, m in zip(labellings, mass):
        for a, b in itertools.pairwise(x):
            joint[2 * a + b] += m
    return mass @ np.array(labellings), joint


def test_expectations_equal_enumeration():
    rng = np.random.default_rng(1)
    counts = np.array([4, 1, 6])
    odds, pairs = rng.normal(size=11), rng.normal(size=(2, 2))
    marginals, joint = quality.Expectation(np.zeros((1, 11), np.int16), counts)(odds, pairs)
    want = [enumerated(part, pairs) for part in np.split(odds, [4, 5])]
    assert np.allclose(marginals, np.concatenate([w[0] for w in want]))
    assert np.allclose(joint, sum(w[1] for w in want))


def test_hidden_gradient_equals_differences_of_the_loss():
    rng = np.random.default_rng(2)
    counts, y = np.array([3, 1, 5]), np.array([1, 0, 0])
    odds, pairs, weight = rng.normal(size=9), rng.normal(size=(2, 2)), rng.integers(1, 30, 9).astype(float)

    def loss(odds, pairs):
        ends = np.cumsum(counts)[:-1]
        total = 0.0
        for o, w, label in zip(np.split(odds, ends), np.split(weight, ends), y):
            mean = np.average(enumerated(o, pairs)[0], weights=w)
            total -= np.log(mean if label else 1 - mean)
        return total

    expect = quality.Expectation(np.zeros((1, 9), np.int16), counts)
    by_line, by_pair, mean_loss = quality.hidden_gradient(expect, odds, pairs, y, weight)
    assert mean_loss == pytest.approx(loss(odds, pairs) / 3)
    for k in range(9):
        up = np.eye(9)[k] * 1e-5
        assert by_line[k] == pytest.approx((loss(odds + up, pairs) - loss(odds - up, pairs)) / 2e-5, abs=1e-5)
    for k in range(4):
        up = (np.eye(4)[k] * 1e-5).reshape(2, 2)
        assert by_pair[k] == pytest.approx((loss(odds, pairs + up) - loss(odds, pairs - up)) / 2e-5, abs=1e-5)


def test_spliced_texts_switch_labels_within():
    rng = np.random.default_rng(3)
    words = "the river carries old boats past a quiet town where people mend their nets".split()
    good_line = lambda: " ".join(rng.choice(words, 12)) + "."                       # noqa: E731
    bad_line = lambda: "".join(rng.choice(list("$$#%|<>=0123456789"), 40))          # noqa: E731
    y = np.arange(160) % 2
    texts = ["\n".join((good_line if k else bad_line)() for _ in range(rng.integers(1, 9))).encode() for k in y]
    model = quality.fit(texts, y)
    right = 0
    for _ in range(20):
        text = "\n".join([good_line() for _ in range(6)] + [bad_line() for _ in range(6)])
        label = model.marginals([text.encode()])[0] > 0
        right += label[:6].sum() + (~label[6:]).sum()
    assert right >= 0.9 * 240


def test_measures_do_not_depend_on_blocks(monkeypatch):
    texts = ["Ünder ÀÉ the ROOF\n\n12 34|x\n".encode(), b"", ("à" * 500 + "É" * 300 + "!?" * 40).encode(), b"plain words here " * 30]
    whole = quality.measures(texts)
    monkeypatch.setattr(quality.blocks, "__defaults__", (16,))
    for a, b in zip(whole, quality.measures(texts)):
        assert np.array_equal(a, b)
    assert [list(range(9))[s] for s in quality.blocks([9, 1, 1, 1, 20, 0, 0, 3, 2], 3)] == [[0], [1, 2, 3], [4], [5, 6, 7], [8]]
