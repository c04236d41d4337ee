"""Families, exceptions and several tags a line."""

import pytest

from ticksmith.llm import licenses


def test_every_tag_of_a_line_is_read():
    r = licenses.scan_text(b"// SPDX-License-Identifier: MIT SPDX-License-Identifier: GPL-2.0-only\nspdx-license-identifier: Zlib", licenses.automaton())
    assert r[7] == ["MIT", "GPL-2.0-only", "Zlib"] and r[5] == "gpl,mit,zlib" and r[6] == 0.4


@pytest.mark.parametrize("text, value, labels", [
    ("Zlib", 1.0, {"zlib"}), ("GPL-2.0 WITH nonsense", 0.4, {"gpl"}), ("AGPL-3.0-only WITH gcc-exception-3.1", 0.6, {"agpl"}),
    ("MIT WITH LLVM-exception", 1.0, {"mit"}), ("CC-BY-NC-4.0", 0.1, {"cc-by-nc"}), ("CC-BY-4.0", 0.9, {"cc-by"}), ("0BSD", 1.0, {"bsd"}),
    ("CECILL-C", 0.6, {"cecill-c"}), ("CECILL-2.1", 0.4, {"cecill"}), ("LicenseRef-Ours AND MIT", 0.0, {"proprietary", "mit"}),
    ("GPLX-1.0", 0.5, {"unknown"}), ("(GPL-2.0 WITH Classpath-exception-2.0) OR Never-Heard", 0.6, {"gpl", "unknown"})])
def test_families_and_exceptions(text, value, labels):
    assert licenses.evaluate(text) == (value, labels)
