"""Source divergence audit: how far the sources of a language differ in the
terms they use, by a perfect-hash recount.

1. Document frequencies of all terms are counted exactly (each task adds up
   its own texts first, cut into terms a block at a time) and terms below
   ``min_docs`` go.
2. The kept terms of a language are dealt by hash into shards of about
   ``SHARD_TERMS``; a task builds a minimal perfect hash of each: levels of
   bit arrays in which every term that meets no other sets its bit, a term's
   slot being the number of bits before its own.  Terms are stored in slot
   order, so a look-up is verified against the stored term.
3. The shards are broadcast, at most about ``BROADCAST_BYTES`` at a time: a
   vocabulary beyond that takes further rounds over the texts.  The recount
   increments a dense row of slots per (language, source); a task
   hands its rows on, a list of slots and counts a shard, when they reach
   ``DENSE_SLOTS``.

Shares are in billionths, smoothed by ``SMOOTH`` a term, in exact integers.
``pair`` sums the differences of two sources over all kept terms, from dense
rows of one shard for two tiles of about ``TILE`` sources at a time; ``term``
lists the terms that a source has more often than its language.

Defined results: null text, lang and source count as ''; repeated rows are
documents each; a source without kept terms takes part with zero counts; a
language without kept terms has pair values of 0; other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, materialise, mix64, ship

MIN_DOCS = 30
SMOOTH = 5
TOP = 50

SHARD_TERMS = 4_000
BROADCAST_BYTES = 32 << 20
BLOCK_BYTES = 8 << 20        # of text that a task cuts into terms at a time
HELD_TERMS = 1_000_000       # terms of blocks that a task adds up before it hands them on
DENSE_SLOTS = 6_000_000
BATCH = 50_000               # values of a batch that a task hands on
TILE = 64
LEVELS = 32                  # then terms of equal hashes are listed

# one byte to one byte: a letter to its lower case, the rest of ASCII to a space
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))

SHARD = "lang string, part long, parts long, n long, sizes binary, bits binary, terms binary, ends binary"
LISTS = ", slot array<int>, n array<long>"


def binaries(data: bytes | np.ndarray, ends: np.ndarray) -> pa.Array:
    """Values that lie end to end in ``data``."""
    ends = np.concatenate([np.zeros(1, np.int64), ends])
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])


def stored_terms(terms: bytes, ends: bytes) -> pa.Array:
    return binaries(terms, np.frombuffer(ends, np.int64))


def hashes_of(terms: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms.to_pylist()), np.uint64, len(terms))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys, ascending, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([np.ones(min(1, len(keys)), bool), keys[1:] != keys[:-1]]))
    return keys[first], np.diff(np.append(first, len(keys)))


class Shard:
    """Minimal perfect hash of some terms, with the terms in slot order."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, terms: pa.Array):
        self.sizes, self.bits, self.terms = sizes, bits, terms
        self.before = np.cumsum(bits) - bits
        hashed = int(bits.sum())
        self.listed = {t: hashed + k for k, t in enumerate(terms[hashed:].to_pylist())}

    @classmethod
    def build(cls, terms: list[bytes], hashes: np.ndarray) -> Shard:
        left, sizes, levels, order = np.arange(len(terms)), [], [], []
        while len(left) and len(sizes) < LEVELS:
            size = 2 * len(left) + 1
            at = (mix64(hashes[left] + np.uint64(len(sizes) + 1)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            own = alone[at]
            order.append(left[own][np.argsort(at[own])])
            left = left[~own]
            sizes.append(size)
            levels.append(alone)
        order.append(left)
        return cls(np.array(sizes, np.int64), np.concatenate(levels) if levels else np.zeros(0, bool),
                   pa.array([terms[i] for i in np.concatenate(order).tolist()], pa.large_binary()))

    def slots(self, terms: list[bytes] | pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Slot of every term, -1 for a term that is not stored."""
        terms = terms if isinstance(terms, pa.Array) else pa.array(terms, pa.large_binary())
        out = np.full(len(terms), -1, np.int64)
        left, base = np.arange(len(terms)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = base + (mix64(hashes[left] + np.uint64(level + 1)) % np.uint64(size)).astype(np.int64)
            hit = self.bits[at]
            out[left[hit]] = self.before[at[hit]]
            left = left[~hit]
            base += size
        hit = np.flatnonzero(out >= 0)
        same = pc.equal(self.terms.take(pa.array(out[hit])), terms.take(pa.array(hit)))
        out[hit[~same.to_numpy(zero_copy_only=False)]] = -1
        if self.listed:
            for i in np.flatnonzero(out < 0).tolist():
                out[i] = self.listed.get(terms[i].as_py(), -1)
        return out

    def pack(self) -> tuple[bytes, bytes, bytes, bytes]:
        terms = self.terms.to_pylist()
        ends = np.cumsum([len(t) for t in terms], dtype=np.int64)
        return self.sizes.tobytes(), np.packbits(self.bits).tobytes(), b"".join(terms), ends.tobytes()

    @classmethod
    def unpack(cls, sizes: bytes, bits: bytes, terms: bytes, ends: bytes) -> Shard:
        sizes = np.frombuffer(sizes, np.int64)
        return cls(sizes, np.unpackbits(np.frombuffer(bits, np.uint8), count=int(sizes.sum())).astype(bool), stored_terms(terms, ends))


class Block:
    """Some texts cut into terms: the different terms (``words``), and for
    every place in the texts its word's number (``word``) and its text's
    (``doc``)."""

    def __init__(self, texts: list[bytes | None]):
        texts = [t or b"" for t in texts]
        raw = np.frombuffer(b" ".join([b"", *texts, b""]).translate(_FOLD), np.uint8)
        inside = raw != 32
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        terms = binaries(raw[inside], np.cumsum(ends - starts)).dictionary_encode()
        self.words, self.word = terms.dictionary, terms.indices.to_numpy().astype(np.int64)
        first = np.cumsum([1, *(len(t) + 1 for t in texts)])
        self.doc = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(starts, first)))

    def found(self, group: np.ndarray, once: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For a number of every text: ascending pairs of such a number and a
        word, and their places (``once``: their texts)."""
        kinds = max(1, len(self.words))
        if once:
            doc, word = np.divmod(_runs(self.doc * kinds + self.word)[0], kinds)
        else:
            doc, word = self.doc, self.word
        pairs, n = _runs(group[doc] * kinds + word)
        return *np.divmod(pairs, kinds), n


def blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[Block, list[pa.Array]]]:
    """Blocks of about ``most`` bytes of text, the last column, with the other
    columns."""
    held, size = [], 0

    def block() -> tuple[Block, list[pa.Array]]:
        table = pa.Table.from_batches(held)
        return Block(table.column(-1).to_pylist()), [c.combine_chunks() for c in table.columns[:-1]]

    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).fill_null(0).to_numpy(zero_copy_only=False))
        at, before = 0, 0
        while at < batch.num_rows:
            to = min(batch.num_rows, 1 + int(np.searchsorted(sizes, before + most - size)))
            held.append(batch.slice(at, to - at))
            size += int(sizes[to - 1]) - before
            at, before = to, int(sizes[to - 1])
            if size >= most:
                yield block()
                held, size = [], 0
    if held:
        yield block()


def document_counts(docs: DataFrame) -> DataFrame:
    """``lang``, ``term``, ``n`` (documents with the term), partial sums per
    task."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        added = lambda: pa.concat_tables(held).group_by(["lang", "term"], use_threads=False).aggregate([("n", "sum")]).rename_columns(
            {"n_sum": "n"}).select(["lang", "term", "n"])
        for block, (lang,) in blocks(batches, BLOCK_BYTES):
            langs = lang.dictionary_encode()
            own, word, n = block.found(langs.indices.to_numpy().astype(np.int64), once=True)
            held.append(pa.table({"lang": langs.dictionary.take(pa.array(own)), "term": block.words.take(pa.array(word)).cast(pa.binary()), "n": n}))
            size += len(n)
            if size >= HELD_TERMS:
                held = [added()]
                size = held[0].num_rows
                if 2 * size >= HELD_TERMS:
                    yield from held[0].to_batches(BATCH)
                    held, size = [], 0
        if held:
            yield from added().to_batches(BATCH)

    return arrow_rows("lang string, term binary, n long", make, docs.select("lang", "text"))


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """``lang``, ``term``, ``hash``."""
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("hash", pa.array(hashes_of(batch.column("term")).view(np.int64)))

    counted = document_counts(docs).groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_docs)
    return materialise(arrow_rows("lang string, term binary, hash long", make, counted.select("lang", "term")), "kept-terms")


def build_shards(kept: DataFrame) -> DataFrame:
    parts = kept.groupBy("lang").agg(F.ceil(F.count("*") / SHARD_TERMS).alias("parts"))

    def build(key, table):
        hashes = table.column("hash").to_numpy().view(np.uint64)
        shard = Shard.build(table.column("term").to_pylist(), hashes)
        names = ["lang", "part", "parts", "n", "sizes", "bits", "terms", "ends"]
        types = [pa.string()] + [pa.int64()] * 3 + [pa.binary()] * 4
        values = [key[0].as_py(), key[1].as_py(), table.column("parts")[0].as_py(), len(shard.terms), *shard.pack()]
        return pa.Table.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names=names)

    ship(kept.sparkSession)
    dealt = kept.join(parts, "lang").withColumn("part", F.pmod("hash", "parts"))
    return materialise(dealt.groupBy("lang", "part").applyInArrow(build, SHARD), "term-shards")


def _rounds(shards: DataFrame) -> tuple[DataFrame, int]:
    """Shards dealt into rounds, none above the broadcast bound unless it is
    one shard."""
    weight = F.octet_length("terms") + F.octet_length("ends") + F.octet_length("bits")
    total, most = shards.agg(F.sum(weight), F.max(weight)).first()
    if total is None:
        return shards, 0
    rounds = max(1, -(-total // BROADCAST_BYTES))
    while True:
        dealt = shards.withColumn("round", F.pmod(F.xxhash64("lang", "part"), F.lit(rounds)))
        worst = dealt.groupBy("round").agg(F.sum(weight).alias("w"), F.count("*").alias("c")).where("c > 1").agg(F.max("w")).first()[0]
        if (worst or 0) <= max(BROADCAST_BYTES, 2 * most):
            return dealt, rounds
        rounds *= 2


class _LangShards:
    """Shards of one language in one round, their slots laid end to end."""

    def __init__(self, packed: dict[int, tuple]):
        self.parts = next(iter(packed.values()))[0]
        self.own = np.array(sorted(packed), np.int64)
        self.shards = [Shard.unpack(*packed[p][1:]) for p in self.own.tolist()]
        self.base = np.cumsum([0, *(len(s.terms) for s in self.shards)])
        self.size = int(self.base[-1])

    def places(self, terms: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Place of every term, -1 for terms of no shard here."""
        out = np.full(len(terms), -1, np.int64)
        part = hashes.view(np.int64) % self.parts
        order = np.argsort(part, kind="stable")
        lo, hi = np.searchsorted(part[order], self.own), np.searchsorted(part[order], self.own, side="right")
        for k, shard in enumerate(self.shards):
            at = order[lo[k]:hi[k]]
            if len(at):
                slot = shard.slots(terms.take(pa.array(at)), hashes[at])
                out[at] = np.where(slot < 0, -1, slot + self.base[k])
        return out

    def split(self, row: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Part, slots and counts above 0 of every shard that has any."""
        for part, a, b in zip(self.own.tolist(), self.base, self.base[1:]):
            slot = np.flatnonzero(row[a:b])
            if len(slot):
                yield part, slot, row[a:b][slot]


def _lists(rows: list[tuple[tuple, np.ndarray, np.ndarray]], keys: dict[str, pa.DataType]) -> pa.RecordBatch:
    """Rows of a key, its slots and their counts."""
    ends = pa.array(np.cumsum([0, *(len(slot) for _, slot, _ in rows)]), pa.int32())
    joined = lambda k, t: pa.array(np.concatenate([r[k] for r in rows]), t)
    return pa.RecordBatch.from_arrays([pa.array([r[0][k] for r in rows], t) for k, t in enumerate(keys.values())]
                                      + [pa.ListArray.from_arrays(ends, joined(1, pa.int32())), pa.ListArray.from_arrays(ends, joined(2, pa.int64()))],
                                      names=[*keys, "slot", "n"])


def merged(lists: DataFrame, *keys: str) -> DataFrame:
    """Sums of ``slot``, ``n`` lists by ``keys``.  Lists arrive sorted by key
    and are added to one dense row, so a task holds one key at a time."""
    types = {k: pa.int64() if k == "part" else pa.string() for k in keys}

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, row, out, size = None, np.zeros(0, np.int64), [], 0
        for batch in batches:
            for key, slot, n in zip(zip(*(batch.column(k).to_pylist() for k in keys)), batch.column("slot"), batch.column("n")):
                slot, n = slot.values.to_numpy(), n.values.to_numpy()
                if key != now:
                    if now is not None:
                        at = np.flatnonzero(row)
                        out.append((now, at, row[at]))
                        size += len(at)
                    if size >= BATCH:
                        yield _lists(out, types)
                        out, size = [], 0
                    now, row = key, np.zeros(0, np.int64)
                if len(slot) and slot.max() >= len(row):
                    row = np.concatenate([row, np.zeros(int(slot.max()) + 1 - len(row), np.int64)])
                row[slot] += n
        if now is not None:
            at = np.flatnonzero(row)
            yield _lists([*out, (now, at, row[at])], types)

    schema = ", ".join(f"{k} {'long' if k == 'part' else 'string'}" for k in keys) + LISTS
    return arrow_rows(schema, make, lists.select(*keys, "slot", "n").repartition(*keys).sortWithinPartitions(*keys))


def _recount(docs: DataFrame, rows: list) -> DataFrame:
    """One round: occurrences of the shards' terms, partial sums per task."""
    packed = defaultdict(dict)
    for r in rows:
        packed[r.lang][r.part] = (r.parts, r.sizes, r.bits, r.terms, r.ends)
    held = docs.sparkSession.sparkContext.broadcast(dict(packed))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = {lang: _LangShards(own) for lang, own in held.value.items()}
        dense: dict[tuple, np.ndarray] = {}
        keys = {"lang": pa.string(), "source": pa.string(), "part": pa.int64()}

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), row in dense.items():
                out = [((lang, source, part), slot, n) for part, slot, n in shards[lang].split(row)]
                if out:
                    yield _lists(out, keys)
            dense.clear()

        size = 0
        for block, (lang, source) in blocks(batches, BLOCK_BYTES):
            langs, sources = lang.dictionary_encode(), source.dictionary_encode()
            of, lang_names, source_names = len(sources.dictionary), langs.dictionary.to_pylist(), sources.dictionary.to_pylist()
            group, word, n = block.found(langs.indices.to_numpy().astype(np.int64) * of + sources.indices.to_numpy())
            hashes = hashes_of(block.words)
            for k, name in enumerate(lang_names):
                a, b = np.searchsorted(group, [k * of, (k + 1) * of])
                if a == b or name not in shards:
                    continue
                used = np.unique(word[a:b])
                place = shards[name].places(block.words.take(pa.array(used)), hashes[used])[np.searchsorted(used, word[a:b])]
                cuts = [0, *(np.flatnonzero(np.diff(group[a:b])) + 1).tolist(), b - a]
                for c, d in zip(cuts, cuts[1:]):
                    key = name, source_names[group[a + c] - k * of]
                    if key not in dense:
                        if size >= DENSE_SLOTS:
                            yield from rows()
                            size = 0
                        dense[key] = np.zeros(shards[name].size, np.int64)
                        size += shards[name].size
                    good = place[c:d] >= 0
                    dense[key][place[c:d][good]] += n[a + c:a + d][good]
        yield from rows()

    found = arrow_rows("lang string, source string, part long" + LISTS, make, docs.select("lang", "source", "text"))
    out = materialise(merged(found, "lang", "source", "part"), "term-counts")
    held.destroy()
    return out


def recount(docs: DataFrame, shards: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``part``, ``slot``, ``n``: a row for every shard
    that the source has terms of, with lists of their slots and occurrences."""
    dealt, rounds = _rounds(shards)
    out = docs.sparkSession.createDataFrame([], "lang string, source string, part long" + LISTS)
    for k in range(rounds):
        out = out.unionByName(_recount(docs, dealt.where(F.col("round") == k).collect()))
    return out


def share(n: np.ndarray, total: int) -> np.ndarray:
    """floor(n * 10^9 / total) exactly (n <= total < 9 * 10^15): three steps
    of long division."""
    out, left = np.zeros_like(n), n
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // total
        left = left % total
    return out


def _tiled(groups: DataFrame) -> DataFrame:
    """``groups`` with its language's number of ``tiles`` and its ``tile``."""
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    return groups.join(tiles, "lang").withColumn("tile", F.pmod(F.xxhash64("source"), "tiles"))


def pair_values(groups: DataFrame, shards: DataFrame, counts: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` (another source), ``value``."""
    rows = (_tiled(groups).join(shards.select("lang", "part", F.col("n").alias("slots")), "lang", "left")
            .join(counts, ["lang", "source", "part"], "left")
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
            .select("lang", F.coalesce("part", F.lit(-1).cast("long")).alias("part"), F.least("tile", "other").alias("low"),
                    F.greatest("tile", "other").alias("high"), "tile", "source", F.coalesce("slots", F.lit(0).cast("long")).alias("slots"),
                    (F.col("total") + SMOOTH * F.col("kinds")).alias("total"), "slot", "n"))

    def differ(key, table):
        lang, low, high = key[0].as_py(), key[2].as_py(), key[3].as_py()
        names, tile = table.column("source").to_pylist(), table.column("tile").to_numpy()
        width = table.column("slots")[0].as_py()
        shares = np.zeros((len(names), width), np.int64)
        for k, (total, slot, n) in enumerate(zip(table.column("total").to_pylist(), table.column("slot"), table.column("n"))):
            own = np.full(width, SMOOTH, np.int64)
            if slot.is_valid:
                own[slot.values.to_numpy()] += n.values.to_numpy()
            if width:
                shares[k] = share(own, total)
        left, right, value = [], [], []
        for k in range(len(names)):
            at = np.flatnonzero(tile == high) if low != high else np.arange(k + 1, len(names))
            if low != high and tile[k] != low:
                continue
            value.append(np.abs(shares[at] - shares[k]).sum(1))
            left += [names[k]] * len(at)
            right += [names[i] for i in at.tolist()]
        value = np.concatenate(value) if value else np.zeros(0, np.int64)
        return pa.Table.from_arrays([pa.array([lang] * 2 * len(left), pa.string()), pa.array(left + right, pa.string()),
                                     pa.array(right + left, pa.string()), pa.array(np.concatenate([value, value]), pa.int64())],
                                    names=["lang", "source", "item", "value"])

    ship(groups.sparkSession)
    found = rows.groupBy("lang", "part", "low", "high").applyInArrow(differ, "lang string, source string, item string, value long")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def term_values(groups: DataFrame, shards: DataFrame, counts: DataFrame, top: int) -> DataFrame:
    """``lang``, ``source``, ``item`` (a term that the source has more often
    than its language), ``value``: of every shard the terms that may be among
    the source's ``top``, those with the ``top``-th value included."""
    of_lang = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.max("kinds").alias("kinds"), F.ceil(F.count("*") / TILE).alias("tiles"))
    own = counts.join(_tiled(groups), ["lang", "source"]).select("lang", "part", "tile", "source", "slot", "n", "total")
    whole = (merged(counts, "lang", "part").join(shards.select("lang", "part", "terms", "ends"), ["lang", "part"]).join(of_lang, "lang")
             .withColumn("tile", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
             .select("lang", "part", "tile", "slot", "n", "lang_total", "kinds", "terms", "ends"))

    def more(key, own, whole):
        names, items, found = [], [], []
        for total, kinds, terms, ends, slot, n in zip(*(whole.column(c) for c in ("lang_total", "kinds", "terms", "ends", "slot", "n"))):
            terms, kinds = stored_terms(terms.as_py(), ends.as_py()), SMOOTH * kinds.as_py()
            q = np.zeros(len(terms), np.int64)
            q[slot.values.to_numpy()] = share(n.values.to_numpy() + SMOOTH, total.as_py() + kinds)
            for source, mine, slot, n in zip(*(own.column(c) for c in ("source", "total", "slot", "n"))):
                slot = slot.values.to_numpy()
                value = share(n.values.to_numpy() + SMOOTH, mine.as_py() + kinds) - q[slot]
                least = max(1, np.partition(value, -top)[-top]) if len(value) > top else 1
                good = value >= least
                names += [source.as_py()] * int(good.sum())
                items.append(terms.take(pa.array(slot[good])))
                found.append(value[good])
        return pa.table({"lang": pa.array([key[0].as_py()] * len(names), pa.string()), "source": pa.array(names, pa.string()),
                         "item": pa.chunked_array(items, pa.large_binary()).cast(pa.binary()),
                         "value": pa.array(np.concatenate(found) if found else [], pa.int64())})

    ship(groups.sparkSession)
    keys = ("lang", "part", "tile")
    out = own.groupBy(*keys).cogroup(whole.groupBy(*keys)).applyInArrow(more, "lang string, source string, item binary, value long")
    return out.withColumn("item", F.col("item").cast("string"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part`` (pair or term), ``item``, ``value``,
    ``rank``."""
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source")), F.col("text").cast("binary").alias("text"))
    shards = build_shards(kept_terms(docs, min_docs))
    counts = recount(docs, shards)
    kinds = shards.groupBy("lang").agg(F.sum("n").alias("kinds"))
    own = counts.select("lang", "source", F.aggregate("n", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = materialise(docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(kinds, "lang", "left")
                         .fillna(0, ["total", "kinds"]), "term-groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = lambda df, part: df.withColumn("part", F.lit(part)).withColumn("rank", F.row_number().over(order))
    return (ranked(pair_values(groups, shards, counts), "pair")
            .unionByName(ranked(term_values(groups, shards, counts, top), "term").where(F.col("rank") <= top))
            .select("lang", "source", "part", "item", "value", "rank"))
