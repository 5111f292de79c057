"""Hashes, windows and prefixes of the shared word scan and the join's index keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import decontaminate, ngram_join, wordscan as ws  # noqa: F401

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab c\n\té", max_size=40)), max_size=12)


@given(TEXTS, st.integers(1, 30))
@settings(max_examples=60, deadline=None)
def test_words_are_those_of_bytes_split(texts, block):
    found = []
    for first, last, data, starts in ws.blocks(pa.array(texts, pa.string()), block):
        begins, ends, before = ws.words(data, starts, ws.WHITE)
        raw = data.tobytes()
        for i in range(last - first):
            found.append([raw[a:b] for a, b in zip(begins[before[i] : before[i + 1]], ends[before[i] : before[i + 1]])])
    assert found == [(t or "").encode().split() for t in texts]


@given(st.lists(st.sampled_from([b"a", b"b", b"cc"]), min_size=1, max_size=40), st.integers(1, 6))
@settings(max_examples=60, deadline=None)
def test_equal_windows_have_equal_hashes(words, size):
    data = np.frombuffer(b" ".join(words), np.uint8)
    begins, ends, _ = ws.words(data, np.array([0, len(data)]), ws.WHITE)
    hashes = ws.window_hashes(ws.hashes(data, begins, ends), size)
    windows = [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]
    assert len(set(zip(windows, hashes.tolist()))) == len(set(windows)) == len(set(hashes.tolist()))


def _sets(seed: int):
    """A set and a variant at or above the threshold, or just below it."""
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 300))
    own = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
    drop = int(rng.integers(0, max(1, len(own) // 5) + 1))
    extra = np.unique(rng.integers(0, 1 << 63, int(rng.integers(0, len(own) // 8 + 1)), dtype=np.uint64))
    other = np.union1d(rng.permutation(own)[drop:], extra)
    return rng, own, other


def test_similar_sets_share_an_index_key_whatever_the_frequencies():
    threshold, similar = (80, 100), 0
    for seed in range(400):
        rng, own, other = _sets(seed)
        if not len(own) or not len(other):
            continue
        levels = {int(t): int(rng.choice([0, 3, 7, 9])) for t in np.union1d(own, other)}
        keys = [ngram_join.index_keys(s, np.array([levels[int(t)] for t in s]), threshold) for s in (own, other)]
        both = len(np.intersect1d(own, other))
        if 100 * both >= 80 * (len(own) + len(other) - both):
            similar += 1
            assert len(np.intersect1d(*keys)), seed
            assert ngram_join.may_link(ngram_join.bitmap(own), len(own), ngram_join.bitmap(other)[None, :], np.array([len(other)]), threshold)[0]
    assert similar > 100


def test_bitmaps_rule_out_unlike_sets():
    rng = np.random.default_rng(3)
    own, other = (np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64)) for _ in range(2))
    assert not ngram_join.may_link(ngram_join.bitmap(own), 400, ngram_join.bitmap(other)[None, :], np.array([400]), (80, 100))[0]
