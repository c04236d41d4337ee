"""Personal data: fixed patterns, and a character model for what they miss.

The base finds addresses, IP numbers, card numbers and phone numbers by
pattern and check (Luhn, parts up to 255, digit counts).  The method adds
spans of the same kinds in forms without a pattern: a bidirectional LSTM over
characters gives label scores, a CRF their transitions (outside, begin and
inside of each kind), both trained in numpy by exact gradients.

Training takes the ``WINDOWS`` different windows of smallest hash that hold a
trigger (a digit, an at sign or a bracketed "at"), labelled by the base, and
writes labelled spans in free forms (``disguise``) into copies of them.  The
fit is one task, bounded by that.

Windows of ``WIDTH`` characters start every ``STRIDE`` characters.  A span
holds a trigger by definition, so windows without one are outside throughout
and are not run.  Each window is decoded by Viterbi; a span at an inner edge
is left to the window beside it.  A text's spans are then reconciled at once:
base spans stay, and of the others the non-overlapping set of greatest total
posterior is taken.  An added span must pass the check of its kind and have a
mean posterior of ``SURE``.

Defined results: a null or empty text has no spans; a null id stays null;
repeated rows are worked each; positions are code points; without a window to
learn from nothing is added; other columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

import heapq
import random
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, ship

KINDS = ["email", "ip", "card", "phone"]
WIDTH, STRIDE = 96, 48
WINDOWS = 2_000              # windows to learn from, at most
EPOCHS, BATCH, RATE, HIDDEN = 6, 64, 0.02, 16
SURE = 0.9
SEED = 2_741
SCHEMA = "doc_id long, spans array<struct<kind: string, start: long, end: long, base: boolean, score: double>>"

# fixed values: patterns of the base (the address is found from its at sign, an IP number from the start of its digits)
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TRIGGER = re.compile(r"[0-9@]|[\[(]at[\])]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def is_card(text: str) -> bool:
    digits = _digits(text)
    return 13 <= len(digits) <= 19 and luhn(digits)


def is_phone(text: str) -> bool:
    return 9 <= len(_digits(text)) <= 15


def is_ip(text: str) -> bool:
    parts = re.findall("[0-9]+", text)
    return len(parts) == 4 and all(map(_small, parts))


def is_address(text: str) -> bool:
    return bool(re.search(r"@|[\[(]at[\])]", text)) and bool(re.search(r"\.|[\[(]dot[\])]", text))


CHECKS = dict(zip(KINDS, (is_address, is_ip, is_card, is_phone)))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the base by kind as listed, then start."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at)
        start = at
        if domain:
            while start > free and text[start - 1] in LOCAL:
                start -= 1
        if domain and start < at:
            out.append(("email", start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if is_ip(m.group())]
    out += [("card", m.start(), m.end()) for m in CARD.finditer(text) if is_card(m.group())]
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if is_phone(m.group())]
    return out


# ------------------------------------------------------------------ labels and characters

LABELS = 1 + 2 * len(KINDS)         # outside, then begin and inside of each kind
BEGIN = {kind: 1 + 2 * k for k, kind in enumerate(KINDS)}
FORBIDDEN = np.zeros((LABELS, LABELS))
for _k in BEGIN.values():           # inside only after begin or inside of its kind
    FORBIDDEN[:, _k + 1] = -1e4
    FORBIDDEN[[_k, _k + 1], _k + 1] = 0.0
STARTS = np.where([k % 2 == 0 and k > 0 for k in range(LABELS)], -1e4, 0.0)

_CLASS = np.arange(130)             # ASCII signs each their own class
_CLASS[48:58], _CLASS[97:123], _CLASS[65:91] = 48, 97, 65
CLASSES, PAD = 130, 129


def encode(windows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Character classes, padded to ``WIDTH``, and lengths."""
    out = np.full((len(windows), WIDTH), PAD, np.int64)
    for k, w in enumerate(windows):
        points = np.frombuffer(w.encode("utf-32-le", "replace"), np.uint32)
        out[k, :len(points)] = _CLASS[np.minimum(points, 128)]
    return out, np.array([len(w) for w in windows])


def label_rows(windows: list[str], spans: list[list[tuple[str, int, int]]]) -> np.ndarray:
    """Label of every character; of overlapping spans the first holds."""
    out = np.zeros((len(windows), WIDTH), np.int64)
    for k, own in enumerate(spans):
        for kind, start, end in own:
            if not out[k, start:end].any():
                out[k, start:end] = BEGIN[kind] + 1
                out[k, start] = BEGIN[kind]
    return out


def disguise(rng: random.Random) -> tuple[str, str | None]:
    """A made-up text and its kind: a free form, or a look-alike of no kind."""
    word = lambda n=6: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, n)))
    num = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    form = rng.randrange(14)
    if form < 3:
        at, dot = rng.choice([(" [at] ", " [dot] "), (" (at) ", " (dot) "), ("[at]", "[dot]"), ("(at)", "."), (" @ ", ".")])
        return f"{word()}{rng.choice(['', '.' + word(), num(2)])}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', word(3)])}", "email"
    if form < 5:
        dot = rng.choice(["[.]", " . ", "(.)"])
        return dot.join(str(rng.randrange(256)) for _ in range(4)), "ip"
    if form < 7:
        digits = num(15)
        digits += next(c for c in "0123456789" if luhn(digits + c))
        return rng.choice([".", "/", "_"]).join(digits[i:i + 4] for i in range(0, 16, 4)), "card"
    if form < 10:
        a, b, c = num(3), num(3), num(4)
        return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"00{rng.randrange(1, 99)} {a} {b}{c}"]), "phone"
    return rng.choice([num(rng.randint(1, 8)), f"20{num(2)}-{num(2)}-{num(2)}", f"{num(1)}.{num(2)}.{num(1)}", f"{num(2)}:{num(2)}:{num(2)}",
                       f"{num(3)},{num(3)},{num(3)}", f"{num(5)}.{num(2)}", "".join(rng.choice("0123456789abcdef") for _ in range(40)),
                       f"@{word()}", f"{num(3)}-{num(2)}", f"({num(4)})", f"{word()}@", f"{num(4)} {num(4)}", f"#{num(5)}"]), None


def lessons(windows: list[str], seed: int = SEED) -> tuple[list[str], list[list[tuple[str, int, int]]]]:
    """The windows with their base spans, and copies in which a made-up text
    stands at some space.  Any 13 to 19 digits count as a card here: a shape
    can be learned, the Luhn sum is checked afterwards."""
    rng = random.Random(seed)
    texts, spans = [], []

    def shapes(text: str) -> list[tuple[str, int, int]]:
        cards = [("card", m.start(), m.end()) for m in CARD.finditer(text) if 13 <= len(_digits(m.group())) <= 19]
        return [s for s in base_spans(text) if s[0] != "card"] + cards

    for w in windows:
        texts.append(w)
        spans.append(shapes(w))
        text, kind = disguise(rng)
        spaces = [i for i, c in enumerate(w) if c == " "] or [len(w)]
        at = rng.choice(spaces)
        copy = (w[:at] + " " + text + " " + w[at + 1:])[:WIDTH]
        own = shapes(copy)
        start, end = at + 1, at + 1 + len(text)
        if kind and end <= WIDTH and not any(s < end and start < e for _, s, e in own):
            own.append((kind, start, end))
        if end <= WIDTH:
            texts.append(copy)
            spans.append(own)
    return texts, spans


# ------------------------------------------------------------------ the network

def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


NETWORK = ("wx", "wh", "b")      # single precision; the chain is in double


def new_parameters(seed: int = SEED, kind: type = np.float32) -> dict[str, np.ndarray]:
    """Both directions are stacked on the first axis of wx, wh and b."""
    rng = np.random.default_rng(seed)
    b = np.zeros((2, 1, 4 * HIDDEN))
    b[..., HIDDEN:2 * HIDDEN] = 1.0          # gates: in, forget, out, then the candidate
    return {"wx": rng.normal(0, 0.3, (2, CLASSES, 4 * HIDDEN)).astype(kind), "wh": rng.normal(0, 0.2, (2, HIDDEN, 4 * HIDDEN)).astype(kind),
            "b": b.astype(kind), "wo": rng.normal(0, 0.2, (2 * HIDDEN, LABELS)), "bo": np.zeros(LABELS), "pairs": np.zeros((LABELS, LABELS)), "first": np.zeros(LABELS)}


def lstm(p: dict, x: np.ndarray) -> dict[str, np.ndarray]:
    """Both directions over ``x`` (texts, time): inputs, gates, cells, states."""
    n, steps = x.shape
    both = np.stack([x, x[:, ::-1]])
    kind = p["wx"].dtype
    gates = np.empty((steps, 2, n, 4 * HIDDEN), kind)
    cell, state = np.zeros((steps + 1, 2, n, HIDDEN), kind), np.zeros((steps + 1, 2, n, HIDDEN), kind)
    tanh_cell = np.empty((steps, 2, n, HIDDEN), kind)
    h3 = 3 * HIDDEN
    for t in range(steps):
        z = np.stack([p["wx"][0, both[0, :, t]], p["wx"][1, both[1, :, t]]]) + state[t] @ p["wh"] + p["b"]
        g = gates[t]
        g[..., :h3] = _sigmoid(z[..., :h3])
        g[..., h3:] = np.tanh(z[..., h3:])
        cell[t + 1] = g[..., HIDDEN:2 * HIDDEN] * cell[t] + g[..., :HIDDEN] * g[..., h3:]
        tanh_cell[t] = np.tanh(cell[t + 1])
        state[t + 1] = g[..., 2 * HIDDEN:h3] * tanh_cell[t]
    hidden = np.concatenate([state[1:, 0], state[:0:-1, 1]], axis=2).transpose(1, 0, 2)
    return {"both": both, "gates": gates, "cell": cell, "state": state, "tanh_cell": tanh_cell, "hidden": hidden}


def lstm_gradient(p: dict, kept: dict, d_hidden: np.ndarray) -> dict[str, np.ndarray]:
    """Back through time: gradients of wx, wh and b."""
    steps, _, n, _ = kept["gates"].shape
    d_out = np.stack([d_hidden[:, :, :HIDDEN], d_hidden[:, ::-1, HIDDEN:]]).transpose(2, 0, 1, 3)
    d_out = d_out.astype(p["wx"].dtype)
    d_state, d_cell = (np.zeros((2, n, HIDDEN), d_out.dtype) for _ in range(2))
    dz = np.empty_like(kept["gates"])
    h3 = 3 * HIDDEN
    for t in range(steps - 1, -1, -1):
        g, tc = kept["gates"][t], kept["tanh_cell"][t]
        i, f, o, c = g[..., :HIDDEN], g[..., HIDDEN:2 * HIDDEN], g[..., 2 * HIDDEN:h3], g[..., h3:]
        d_state = d_state + d_out[t]
        d_cell = d_cell + d_state * o * (1 - tc * tc)
        dz[t, ..., :HIDDEN] = d_cell * c * i * (1 - i)
        dz[t, ..., HIDDEN:2 * HIDDEN] = d_cell * kept["cell"][t] * f * (1 - f)
        dz[t, ..., 2 * HIDDEN:h3] = d_state * tc * o * (1 - o)
        dz[t, ..., h3:] = d_cell * i * (1 - c * c)
        d_cell = d_cell * f
        d_state = dz[t] @ p["wh"].transpose(0, 2, 1)
    d_wx = np.zeros_like(p["wx"])
    for way in (0, 1):               # rows of one character class lie together, so each is one sum
        of = kept["both"][way].T.ravel()
        order = np.argsort(of, kind="stable")
        seen, first = np.unique(of[order], return_index=True)
        d_wx[way][seen] = np.add.reduceat(dz[:, way].reshape(-1, 4 * HIDDEN)[order], first, axis=0)
    return {"wx": d_wx, "wh": np.einsum("twnh,twnk->whk", kept["state"][:-1], dz, optimize=True), "b": dz.sum(axis=(0, 2))[:, None, :]}


def emissions(p: dict, hidden: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Label scores of every character; padding is outside."""
    out = hidden @ p["wo"] + p["bo"]
    out[np.arange(out.shape[1]) >= sizes[:, None]] = np.array([0.0] + [-1e4] * (LABELS - 1))
    return out


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis, keepdims=True))).squeeze(axis)


def forward_backward(e: np.ndarray, pairs: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log messages of both directions, and the log partition."""
    n, steps, _ = e.shape
    ahead, back = np.empty_like(e), np.zeros_like(e)
    ahead[:, 0] = first + e[:, 0]
    for t in range(1, steps):
        ahead[:, t] = _log_sum(ahead[:, t - 1, :, None] + pairs, 1) + e[:, t]
    for t in range(steps - 2, -1, -1):
        back[:, t] = _log_sum(pairs + (e[:, t + 1] + back[:, t + 1])[:, None, :], 2)
    return ahead, back, _log_sum(ahead[:, -1], 1)


def viterbi(e: np.ndarray, pairs: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Best labels of every window; of equal paths that of smaller labels at the end."""
    n, steps, _ = e.shape
    best, back = first + e[:, 0], np.empty(e.shape, np.int8)
    for t in range(1, steps):
        through = best[:, :, None] + pairs
        back[:, t] = through.argmax(1)
        best = through.max(1) + e[:, t]
    out = np.empty((n, steps), np.int64)
    out[:, -1] = best.argmax(1)
    for t in range(steps - 1, 0, -1):
        out[:, t - 1] = back[np.arange(n), t, out[:, t]]
    return out


def loss_and_gradient(p: dict, x: np.ndarray, sizes: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean negative log likelihood of the labels, and its exact gradient."""
    n, steps = x.shape
    kept = lstm(p, x)
    e = emissions(p, kept["hidden"], sizes)
    pairs, first = p["pairs"] + FORBIDDEN, p["first"] + STARTS
    ahead, back, whole = forward_backward(e, pairs, first)
    rows, times = np.arange(n)[:, None], np.arange(steps)[None, :]
    gold = e[rows, times, y].sum(1) + first[y[:, 0]] + pairs[y[:, :-1], y[:, 1:]].sum(1)
    excess = np.exp(ahead + back - whole[:, None, None])
    excess[rows, times, y] -= 1.0
    d_first = excess[:, 0].sum(0) / n
    joint = np.zeros((LABELS, LABELS))
    for t in range(steps - 1):
        joint += np.exp(ahead[:, t, :, None] + pairs + (e[:, t + 1] + back[:, t + 1] - whole[:, None])[:, None, :]).sum(0)
    np.add.at(joint, (y[:, :-1].ravel(), y[:, 1:].ravel()), -1.0)
    excess[times.repeat(n, 0) >= sizes[:, None]] = 0.0      # padding is fixed
    excess /= n
    grads = lstm_gradient(p, kept, excess @ p["wo"].T)
    grads |= {"wo": np.einsum("ntk,ntl->kl", kept["hidden"], excess, optimize=True), "bo": excess.sum((0, 1)), "pairs": joint / n, "first": d_first}
    return float((whole - gold).mean()), grads


def fit(windows: list[str], epochs: int = EPOCHS, seed: int = SEED) -> dict[str, np.ndarray]:
    """Adam on shuffled batches, the gradient's norm bounded by 5, the rate
    falling to a tenth."""
    texts, spans = lessons(windows, seed)
    x, sizes = encode(texts)
    y = label_rows(texts, spans)
    p = new_parameters(seed)
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    rng = np.random.default_rng(seed)
    steps = epochs * -(-len(texts) // BATCH)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for i in range(0, len(order), BATCH):
            at = order[i:i + BATCH]
            _, grads = loss_and_gradient(p, x[at], sizes[at], y[at])
            norm = np.sqrt(sum((g * g).sum() for g in grads.values()))
            step += 1
            rate = RATE * (1 - 0.9 * step / steps)
            for k, g in grads.items():
                g = g * min(1.0, 5.0 / max(norm, 1e-12))
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                p[k] = (p[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.99 ** step)) + 1e-8)).astype(p[k].dtype)
    return p


# ------------------------------------------------------------------ windows and reconciliation

def windows_of(text: str) -> list[int]:
    """Starts of the windows that hold a trigger."""
    last = max(0, -(-(len(text) - WIDTH) // STRIDE))
    out = set()
    for m in TRIGGER.finditer(text):
        a, b = m.span()
        out.update(range(max(0, -(-(b - WIDTH) // STRIDE)), min(last, a // STRIDE) + 1))
    return [k * STRIDE for k in sorted(out)]


def decode(p: dict, windows: list[str]) -> list[list[tuple[str, int, int, float]]]:
    """Spans of every window by Viterbi, each with its mean posterior."""
    x, sizes = encode(windows)
    e = emissions(p, lstm(p, x)["hidden"], sizes)
    pairs, first = p["pairs"] + FORBIDDEN, p["first"] + STARTS
    path = viterbi(e, pairs, first)
    ahead, back, whole = forward_backward(e, pairs, first)
    own = np.exp(np.take_along_axis(ahead + back, path[:, :, None], 2)[:, :, 0] - whole[:, None])
    out = [[] for _ in windows]
    for k in np.flatnonzero((path > 0).any(1)).tolist():
        row, n = path[k], int(sizes[k])
        for start in np.flatnonzero(row % 2 == 1).tolist():
            end = start + 1
            while end < n and row[end] == row[start] + 1:
                end += 1
            out[k].append((KINDS[(row[start] - 1) // 2], start, end, float(own[k, start:end].mean())))
    return out


def reconcile(found: list[tuple[str, int, int, float]], base: list[tuple[str, int, int]]) -> list[tuple[str, int, int, float]]:
    """The non-overlapping set of greatest total posterior among spans that
    touch no base span; a span found twice has its greater posterior."""
    best: dict[tuple, float] = {}
    for kind, start, end, score in found:
        best[start, end, kind] = max(score, best.get((start, end, kind), 0.0))
    spans = sorted(((s, e, k, v) for (s, e, k), v in best.items() if not any(a < e and s < b for _, a, b in base)),
                   key=lambda r: (r[1], r[0], KINDS.index(r[2])))
    ends = [r[1] for r in spans]
    total, taken = [0.0], []
    for i, (start, _, _, score) in enumerate(spans):
        before = int(np.searchsorted(ends[:i], start, side="right"))
        with_it = total[before] + score
        taken.append((with_it > total[-1], before))
        total.append(max(with_it, total[-1]))
    out, i = [], len(spans)
    while i:
        use, before = taken[i - 1]
        if use:
            start, end, kind, score = spans[i - 1]
            out.append((kind, start, end, score))
        i = before if use else i - 1
    return out[::-1]


def added_spans(p: dict | None, texts: list[str], base: list[list[tuple[str, int, int]]]) -> list[list[tuple[str, int, int, float]]]:
    """What the model adds to the base spans of the texts."""
    where = [(k, at) for k, t in enumerate(texts) for at in windows_of(t)] if p else []
    found = [[] for _ in texts]
    for i in range(0, len(where), 256):
        part = where[i:i + 256]
        for (k, at), spans in zip(part, decode(p, [texts[k][at:at + WIDTH] for k, at in part])):
            text = texts[k]
            for kind, start, end, score in spans:
                a, b = at + start, at + end
                if (start == 0 and at > 0) or (end == WIDTH and b < len(text)):
                    continue
                if score >= SURE and TRIGGER.search(text, a, b) and CHECKS[kind](text[a:b]):
                    found[k].append((kind, a, b, score))
    return [reconcile(f, b) if f else [] for f, b in zip(found, base)]


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by its kind in angle brackets;
    overlapping spans as one, by the first's kind."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


# ------------------------------------------------------------------ Spark

def sample_windows(docs: DataFrame, most: int = WINDOWS) -> DataFrame:
    """``hash``, ``text``: the ``most`` different windows with a trigger whose
    hashes are smallest; a task hands on its own ``most`` smallest."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, str] = {}
        heap: list[int] = []         # largest first
        for batch in batches:
            for value in batch.column(0):
                text = value.as_py()
                for at in windows_of(text) if text else []:
                    own = text[at:at + WIDTH]
                    h = xxhash.xxh3_64_intdigest(own.encode()) >> 1
                    if h in held or (len(heap) >= most and h >= -heap[0]):
                        continue
                    held[h] = own
                    heapq.heappush(heap, -h)
                    if len(heap) > most:
                        del held[-heapq.heappop(heap)]
        yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int64()), pa.array(list(held.values()), pa.string())], names=["hash", "text"])

    return arrow_rows("hash long, text string", make, docs.select("text")).distinct().orderBy("hash", "text").limit(most)


def train(docs: DataFrame, most: int = WINDOWS) -> dict[str, np.ndarray] | None:
    """Parameters learned from the sample, in one task; None without windows."""
    def learn(rows: pd.DataFrame) -> pd.DataFrame:
        p = fit(rows.sort_values(["hash", "text"])["text"].tolist())
        return pd.DataFrame({"name": list(p), "shape": [list(a.shape) for a in p.values()], "values": [a.ravel().tolist() for a in p.values()]})

    ship(docs.sparkSession)
    found = (sample_windows(docs, most).groupBy(F.lit(0).alias("fit"))
             .applyInPandas(learn, "name string, shape array<long>, values array<double>").collect())     # one row per parameter
    return {r["name"]: np.array(r["values"], np.float32 if r["name"] in NETWORK else np.float64).reshape(r["shape"]) for r in found} or None


def scan(docs: DataFrame, model: dict[str, np.ndarray] | None) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, base, score) of every text:
    by kind as listed, then start.  Base spans have score 1."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = held.value
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [t.as_py() or "" for t in part.column(1)]
                base = [base_spans(t) if TRIGGER.search(t) else [] for t in texts]
                rows = []
                for own, more in zip(base, added_spans(p, texts, base)):
                    both = [(*s, True, 1.0) for s in own] + [(k, s, e, False, v) for k, s, e, v in more]
                    rows.append(sorted(both, key=lambda s: (KINDS.index(s[0]), s[1])))
                flat = [s for r in rows for s in r]
                types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.float64()]
                names = ["kind", "start", "end", "base", "score"]
                struct = pa.StructArray.from_arrays([pa.array([s[c] for s in flat], t) for c, t in enumerate(types)], names=names)
                ends = pa.array(np.cumsum([0] + [len(r) for r in rows]), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, struct)], names=["doc_id", "spans"])

    return arrow_rows(SCHEMA, make, docs.select(F.col("doc_id").cast("long"), "text"))
