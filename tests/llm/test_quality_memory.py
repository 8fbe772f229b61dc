"""Sums of neighbours and rows of words hold little at a time."""

import tracemalloc

import numpy as np

from quartier.llm import quality


def test_neighbours_are_added_in_small_parts():
    size = 60_000
    place, sign = quality._index_vectors(size)
    w = np.random.default_rng(3).permutation(size)
    w[::1000] = -1
    table = np.zeros((size, quality.DIM), np.float32)
    tracemalloc.start()
    quality._add_neighbours(table, w, place, sign)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 35e6                   # sums of all words alone are 23 MB, twice
    want = np.zeros_like(table)
    for gap in (-2, -1, 1, 2):
        at = np.arange(max(0, -gap), size - max(0, gap))
        a, b = w[at], w[at + gap]
        ok = (a >= 0) & (b >= 0)
        for j in range(quality.SPARSE):
            np.add.at(want, (a[ok], place[b[ok], j]), sign[b[ok], j])
    assert np.array_equal(table, want)


def test_shared_rows_are_remembered_up_to_a_bound(monkeypatch):
    monkeypatch.setattr(quality, "_MEMORY", 5)
    own = {b"the": quality.ENDINGS, b"cat": quality.ENDINGS + 1}
    words = quality.Words(own)
    for i in range(100):
        rows, found = words.rows(f"the new{i}word cat")
        assert rows[0] == own[b"the"] and rows[-1] == own[b"cat"]
        assert all(r < quality.ENDINGS for r in rows[1:-1]) and len(words) + len(words.shared) <= len(own) + 6
        assert np.array_equal(rows, quality.Words(own).rows(f"the new{i}word cat")[0])
    assert len(own) == 2


def test_rare_words_are_remembered_by_ending():
    """Words met once cost no memory of their own; forms are those of the plain rule."""
    def plain(word):
        if len(word) <= 3 or not (word[:1].isalpha() or word[0] > 127):
            return word[:4]
        lower = word.lower()
        shape = b"u" if word == word.upper() else b"l" if word == lower else b"t"
        return shape + b":" + lower[-3:]

    words = quality.Words({})
    words.rows(" ".join(f"{a}{b}{c}ing" for a in "bcdfgh" for b in "aeiou" for c in "klmnprst"))
    assert len(words.shared) == 1 and not len(words)
    for word in (b"ABCD", b"abcd", b"Abcd", b"aBCD", b"abcD", "éàüö".encode(), "Éabc".encode(),
                 "éABC".encode(), "日本".encode(), b"12345", b"1", b"--==--", b"abc", b"ABC"):
        assert quality._form(word) == plain(word)


def test_neighbours_are_summed_in_chunks_of_little_memory():
    size = 40_000
    place, sign = quality._index_vectors(size)
    rng = np.random.default_rng(4)
    w = rng.integers(0, size, quality._CHUNK)
    table = np.zeros((size, quality.DIM), np.float32)
    tracemalloc.start()
    quality._add_neighbours(table, w, place, sign)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 50e6                   # 28 MB; 111 MB with chunks of 500 000 words
