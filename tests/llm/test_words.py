import re

import numpy as np
import pyarrow as pa
import pytest

from tallymark.llm import words
from tallymark.llm.words import ALPHANUMERIC, SPACED, hash_words, slices, windows

TEXTS = ["One two  THREE", None, "", "é\tÉ one", "  ", "a-b_c1", "x" * 5000 + " one", "two", "ß\x0bone\x1fz", "—one—"]
PATTERNS = {"spaced": (SPACED, r"[^\x20\x09-\x0D]+"), "alnum": (ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")}


def lowered(text):
    return (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


@pytest.mark.parametrize("name", sorted(PATTERNS))
@pytest.mark.parametrize("block", [1, 7, 64, 1 << 20])
def test_words_are_those_of_the_pattern(monkeypatch, name, block):
    monkeypatch.setattr(words, "BLOCK_BYTES", block)
    letters, pattern = PATTERNS[name]
    expected = [re.findall(pattern, lowered(t)) for t in TEXTS]
    hashes, first = hash_words(pa.array(TEXTS), letters)
    assert np.diff(first).tolist() == [len(e) for e in expected]
    by_word = {}
    for word, h in zip((w for e in expected for w in e), hashes.tolist()):
        assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_sliced_columns_and_windows():
    array = pa.array(["zz", "a b c", "b c"]).slice(1)
    hashes, first = hash_words(array, SPACED)
    assert first.tolist() == [0, 3, 5]
    pairs = windows(hashes, 2)
    assert pairs[1] == pairs[3] and len(set(pairs.tolist())) == 3
    assert windows(hashes, 6).tolist() == []
    assert hash_words(pa.array([], pa.string()), SPACED)[1].tolist() == [0]
    assert hash_words(pa.array([None], pa.string()), SPACED)[1].tolist() == [0, 0]


def test_slices_hold_every_row(monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (3, 30, 0, 4, 9, 1)] + [None]})
    parts = [p.column("text").to_pylist() for p in slices(batch, "text")]
    assert [t for p in parts for t in p] == batch.column("text").to_pylist() and len(parts) > 2
    assert list(slices(batch.slice(0, 0), "text")) == []
