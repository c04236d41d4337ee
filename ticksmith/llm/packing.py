"""Packing: first-fit decreasing with a tournament tree of bin capacities,
run on its own in randomised groups of documents.

A document is tokenised, ended by ``end_id`` and cut at multiples of the
sequence length, so at most its last piece is shorter than a sequence.  The
pieces (a few numbers each; the ids stay where they are) are dealt to groups
by a seeded hash.  Groups have a bounded expected size at any corpus size,
and each is packed in one task.

Tokenising goes by the chunk between two spaces or line ends.  No
pre-token of the vocabulary spans white space, so the ids of a text are
those of its chunks in turn; each distinct chunk is encoded once per worker.

Defined results: a null or empty text is the end id alone; repeated rows are
packed each; ties are ordered by document, start and checksum; an empty
table gives no pieces; a null doc_id is kept as null; extra columns are
ignored.
"""

from __future__ import annotations

import math
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, kept, materialise, ship

SEQUENCE = 4096
END_ID = 2
GROUP = 4096              # expected pieces in a group
SEED = 20_011
MOST_CHUNKS = 500_000     # chunks, and words, remembered by a worker

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


# chunks of these characters alone are normalised by lower-casing only
PLAIN = re.compile("[\x21-\x7e\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
# ---- fixed values: the pre-token pattern of the vocabulary file
PRE_TOKEN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the letters from 256 on, in turn."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + k) for k, b in enumerate(hidden)}


def little_endian(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class ChunkIds:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    A chunk of plain Latin characters is lower-cased, split into pre-tokens
    and looked up word by word, a new word going to the tokenizer's model;
    any other chunk goes through the whole tokenizer."""

    def __init__(self, tokenizer_file: str, most: int = MOST_CHUNKS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.most = most

    def word(self, word: str) -> bytes:
        if len(self.words) >= self.most:
            self.words.clear()
        spelled = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        ids = self.words[word] = little_endian([t.id for t in self.model.tokenize(spelled)])
        return ids

    def chunk(self, chunk: str) -> bytes:
        if PLAIN.fullmatch(chunk) and "<|" not in chunk:
            known = self.words
            return b"".join([known.get(w) or self.word(w) for w in PRE_TOKEN.findall(chunk.lower())])
        return little_endian(self.tokenizer.encode(chunk, add_special_tokens=False).ids)

    def encode(self, text: str) -> bytes:
        own = text.replace("\n", " ").split(" ")
        known = self.chunks
        try:
            return b"".join([known[c] for c in own])
        except KeyError:
            pass
        if len(known) >= self.most:
            known.clear()
        for c in own:
            if c not in known:
                known[c] = self.chunk(c)
        return b"".join([known[c] for c in own])


def encoder(tokenizer_file: str) -> ChunkIds:
    """One encoder per worker process, until it works for another operator."""
    return kept(("encoder", tokenizer_file), lambda: ChunkIds(tokenizer_file))


def cut(ids: bytes, sequence: int) -> list[tuple[int, int, int]]:
    """(start, length, crc32) of each piece."""
    step = 4 * sequence
    return [(i // 4, len(part := ids[i:i + step]) // 4, zlib.crc32(part)) for i in range(0, len(ids), step)]


def pieces(docs: DataFrame, tokenizer_file: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Every document as pieces of at most ``sequence`` ids."""
    end = little_endian([end_id])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(tokenizer_file)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            rows = []
            for doc, text in zip(ids, texts):
                whole = ids_of.encode(text) + end
                rows += [(doc, *piece, len(whole) // 4) for piece in cut(whole, sequence)]
            columns = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                             names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return arrow_rows(PIECES, make, docs.select(F.col("doc_id").cast("long"), "text"), keep=True)


def first_fit_decreasing(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each item; ``lengths`` descending.  A tournament
    tree holds the largest free capacity below each node, so the first bin
    that fits is found in log(bins) steps."""
    leaves = 1
    while leaves < max(1, len(lengths)):
        leaves *= 2
    free = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for length in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if free[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - free[node])
        free[node] -= length
        while node > 1:
            node //= 2
            free[node] = max(free[2 * node], free[2 * node + 1])
    return bins, offsets


def pack(docs: DataFrame, tokenizer_file: str, sequence: int = SEQUENCE, end_id: int = END_ID, group: int = GROUP,
         seed: int = SEED) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.  The pieces are
    written once to the shared folder; their number sets the number of
    groups."""
    ship(docs.sparkSession)
    cuts = materialise(pieces(docs, tokenizer_file, sequence, end_id), "pieces")
    groups = max(1, math.ceil(cuts.count() / group))
    dealt = cuts.withColumn("pack_group", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "start", "ids_crc32", "doc_tokens"),
                                                 F.lit(groups)))

    def fit(table):                  # Arrow keeps 64-bit ids beside nulls
        order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=order))
        bins, offsets = first_fit_decreasing(table.column("length").to_pylist(), sequence)
        sequences = table.column("pack_group").to_numpy() * (1 << 31) + np.asarray(bins, np.int64)
        return (table.drop_columns(["pack_group"]).append_column("sequence_id", pa.array(sequences))
                .append_column("offset", pa.array(np.asarray(offsets, np.int64))))

    return dealt.groupBy("pack_group").applyInArrow(fit, PIECES + ", sequence_id long, offset long")
