"""License scans: Aho-Corasick phrases, shunting-yard licence expressions.

A text is read as a stream of words (A-Z lower-cased; a word is a run of
digits, letters and non-ASCII characters).  One Aho-Corasick automaton over
that stream finds every place of every notice phrase and of the words of an
identifier tag, overlapping places included.  The expression after a tag is
parsed by a shunting-yard parser (with > and > or) and evaluated.

Defined results: a null or empty text has no words, no places, empty labels
and the score of an unknown licence; a malformed expression gives the label
``unknown``; repeated rows are scanned each on their own; extra columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows

# ---- fixed values: base phrases and labels (given)
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# ---- fixed values: notice phrases of this method
NOTICES = {
    "bsd license": "bsd",
    "redistribution and use in source and binary forms": "bsd",
    "permission is hereby granted free of charge": "mit",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "isc license": "isc",
    "this is free and unencumbered software": "unlicense",
    "creative commons attribution": "cc-by",
    "all rights reserved": "proprietary",
}
# ---- fixed values: identifier families and how freely a text under them may be used; an identifier is of a family if it
# is its name, or that name, a hyphen and more (the longest such name holds)
FAMILIES = {
    "0bsd": 1.0, "afl": 1.0, "apache": 1.0, "artistic": 0.9, "blueoak": 1.0, "boost": 1.0, "bsd": 1.0, "bsl": 1.0, "cc0": 1.0, "curl": 1.0,
    "ecl": 1.0, "hpnd": 1.0, "icu": 1.0, "ijg": 1.0, "isc": 1.0, "libpng": 1.0, "mit": 1.0, "mit-0": 1.0, "ms-pl": 0.9, "mulanpsl": 1.0, "ncsa": 1.0,
    "ntp": 1.0, "ofl": 0.9, "openssl": 0.9, "pddl": 1.0, "php": 0.9, "postgresql": 1.0, "psf": 1.0, "python": 1.0, "ruby": 0.9, "tcl": 1.0,
    "unicode": 1.0, "unlicense": 1.0, "upl": 1.0, "vim": 0.9, "w3c": 1.0, "wtfpl": 1.0, "x11": 1.0, "zlib": 1.0, "zpl": 1.0,
    "cc-by": 0.9, "odc-by": 0.9, "apsl": 0.7, "cddl": 0.7, "cpl": 0.7, "epl": 0.7, "ipl": 0.7, "lppl": 0.7, "mpl": 0.7, "ms-rl": 0.7,
    "cecill-c": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "odbl": 0.5, "cecill": 0.4, "eupl": 0.4, "gfdl": 0.4, "gpl": 0.4, "osl": 0.4,
    "sleepycat": 0.4, "agpl": 0.3, "sspl": 0.2, "cc-by-nd": 0.2, "cc-by-nc": 0.1, "busl": 0.1, "licenseref": 0.0, "proprietary": 0.0}
# ---- fixed values: families under another label
LABELS = {"0bsd": "bsd", "mit-0": "mit", "licenseref": "proprietary"}
# ---- fixed values: exceptions of the licence list; a known one lifts strong copyleft
EXCEPTIONS = {
    "389-exception", "asterisk-exception", "autoconf-exception-2.0", "autoconf-exception-3.0", "autoconf-exception-generic",
    "autoconf-exception-macro", "bison-exception-1.24", "bison-exception-2.2", "bootloader-exception", "classpath-exception-2.0",
    "clisp-exception-2.0", "cryptsetup-openssl-exception", "digirule-foss-exception", "ecos-exception-2.0", "fawkes-runtime-exception",
    "fltk-exception", "font-exception-2.0", "freertos-exception-2.0", "gcc-exception-2.0", "gcc-exception-3.1", "gnat-exception",
    "gnu-javamail-exception", "gpl-3.0-linking-exception", "gpl-3.0-linking-source-exception", "gpl-cc-1.0", "i2p-gpl-java-exception",
    "lgpl-3.0-linking-exception", "libtool-exception", "linux-syscall-note", "llgpl", "llvm-exception", "lzma-exception", "mif-exception",
    "ocaml-lgpl-linking-exception", "occt-exception-1.0", "openjdk-assembly-exception-1.0", "openvpn-openssl-exception",
    "ps-or-pdf-font-exception-20170817", "qpl-1.0-inria-2004-exception", "qt-gpl-exception-1.0", "qt-lgpl-exception-1.1",
    "qwt-exception-1.0", "shl-2.0", "shl-2.1", "swift-exception", "u-boot-exception-2.0", "universal-foss-exception-1.0",
    "vsftpd-openssl-exception", "wxwindows-exception-3.1", "x11vnc-openssl-exception"}
UNKNOWN = 0.5
EXCEPTION_FREEDOM = 0.6          # a linking exception lifts strong copyleft this far
TAG = "spdx license identifier"
TAG_TEXT = re.compile(rb"spdx-license-identifier\s*:[ \t]*((?:(?!spdx-license-identifier)[^\r\n])*)", re.I)
TOKEN = re.compile(r"\(|\)|[^\s()]+")
BINDING = {"or": 1, "and": 2, "with": 3}

# A-Z lower-cased; bytes outside 0-9, a-z and non-ASCII become spaces
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))

SCHEMA = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
          "score double, expressions array<string>, findings array<struct<label:string,phrase:string,word:long>>")


def family_of(identifier: str) -> str | None:
    """The longest family name that the identifier begins with."""
    parts = identifier.lower().rstrip("+").split("-")
    return next((name for k in range(len(parts), 0, -1) if (name := "-".join(parts[:k])) in FAMILIES), None)


def label_of(identifier: str) -> str:
    family = family_of(identifier)
    return LABELS.get(family, family) if family else "unknown"


def freedom_of(label: str) -> float:
    return FAMILIES.get(label, UNKNOWN)


def postfix(expression: str) -> list[str]:
    """Shunting-yard.  Raises ValueError on a malformed expression."""
    out: list[str] = []
    stack: list[str] = []
    operand_next = True
    for token in TOKEN.findall(expression):
        low = token.lower()
        if low in BINDING:
            if operand_next:
                raise ValueError("operator without an operand")
            while stack and stack[-1] in BINDING and BINDING[stack[-1]] >= BINDING[low]:
                out.append(stack.pop())
            stack.append(low)
            operand_next = True
        elif token == "(":
            if not operand_next:
                raise ValueError("operand before a bracket")
            stack.append(token)
        elif token == ")":
            if operand_next:
                raise ValueError("empty bracket")
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                raise ValueError("unbalanced bracket")
            stack.pop()
        else:
            if not operand_next:
                raise ValueError("two operands in a row")
            out.append(token)
            operand_next = False
    if operand_next or "(" in stack:
        raise ValueError("unfinished expression")
    return out + stack[::-1]


def leading(text: str) -> str:
    """The expression a text begins with: all before the first operand or
    bracket that follows a complete expression (an operand was last, every
    bracket is closed)."""
    depth, operand_next = 0, True
    for token in TOKEN.finditer(text):
        low = token[0].lower()
        if not operand_next and depth == 0 and low not in BINDING and low != ")":
            return text[:token.start()].rstrip()
        depth += (low == "(") - (low == ")")
        if low in BINDING:
            operand_next = True
        elif low not in "()":
            operand_next = False
    return text


def evaluate(expression: str) -> tuple[float, set[str]]:
    """(freedom, labels): ``or`` lets the reader choose the freer side,
    ``and`` binds to the stricter, ``with`` a known exception lifts strong
    copyleft; an unknown one changes nothing."""
    stack: list[tuple[float, set[str], str]] = []
    for token in postfix(expression):
        if token not in BINDING:
            family = family_of(token)
            stack.append((freedom_of(family), {label_of(token)}, token.lower()))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            lifted = max(left[0], EXCEPTION_FREEDOM) if right[2] in EXCEPTIONS else left[0]
            stack.append((lifted, left[1], ""))
        else:
            pick = max if token == "or" else min
            stack.append((pick(left[0], right[0]), left[1] | right[1], ""))
    return stack[0][:2]


def tag_expression(raw: bytes) -> str:
    """The expression after a tag, without the end of a comment or the prose that follows it."""
    text = raw.decode("utf-8", "replace")
    return leading(re.split(r"\*/|-->|#}|[;,\"']", text)[0].strip()).rstrip(".")


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in {**NOTICES, **BASE, TAG: ""}.items():
        found.add_word(f" {phrase} ", (phrase, label, len(phrase) + 2))
    found.make_automaton()
    return found


def scan_text(data: bytes, phrases: ahocorasick.Automaton) -> tuple:
    words = data.translate(WORD_BYTES).split()
    stream = b" ".join([b"", *words, b""])
    hits = [(end - n + 1, phrase, label) for end, (phrase, label, n) in phrases.iter(stream.decode("latin-1"))]
    if not hits:
        return len(words), 0, None, None, "", "", UNKNOWN, [], []
    spaces = np.flatnonzero(np.frombuffer(stream, np.uint8) == 32)
    starts = np.searchsorted(spaces, [h[0] for h in hits]).tolist()
    places = [{"label": h[2], "phrase": h[1], "word": w} for h, w in zip(hits, starts) if h[2]]
    base = [p for p in places if p["phrase"] in BASE]
    labels = {p["label"] for p in places}
    expressions, freedom = [], [freedom_of(x) for x in labels]
    if any(h[1] == TAG for h in hits):
        for raw in TAG_TEXT.findall(data):
            expressions.append(tag_expression(raw))
            try:
                value, named = evaluate(expressions[-1])
            except ValueError:
                value, named = UNKNOWN, {"unknown"}
            freedom.append(value)
            labels |= named
    at = [p["word"] for p in base]
    return (len(words), len(base), min(at, default=None), max(at, default=None), ",".join(sorted({p["label"] for p in base})),
            ",".join(sorted(labels)), min(freedom, default=UNKNOWN), expressions, places)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    phrases = automaton()
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "expressions", "findings"]
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string()), pa.list_(pa.struct(
        [("label", pa.string()), ("phrase", pa.string()), ("word", pa.int64())]))]
    for batch in batches:
        found = [scan_text(x.as_py() or b"", phrases) for x in batch.column(1)]
        columns = list(zip(*found)) if found else [[]] * len(names)
        yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))],
                                         names=["doc_id", *names])


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts and labels, the expressions found and
    every place of every phrase."""
    return arrow_rows(SCHEMA, _scan, docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")))
