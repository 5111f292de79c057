"""Periodic runs against a search of every period at every place."""

from __future__ import annotations

import hashlib
import re
import time
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import periodic_runs

SPACE = r"[^\x20\x09-\x0D]+"


def _smallest_period(words):
    return next(q for q in range(1, len(words) + 1) if words[q:] == words[:-q] or q == len(words))


def _runs(words, least_length=6, least_exponent=4):
    out, n = [], len(words)
    for q in range(1, n // least_exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least_length, least_exponent * q) and _smallest_period(words[i : i + length]) == q:
                out.append((i, length, q))
            i = j
    return sorted(out)


def _collapsed(words, runs):
    gone = {i for a, length, q in runs for i in range(a + q, a + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def _found(texts, **options):
    firsts = np.r_[0, np.cumsum([len(t) for t in texts])]
    names = {w: k for k, w in enumerate(sorted({w for t in texts for w in t}))}
    ids = np.array([names[w] for t in texts for w in t], np.int64)
    out = [[] for _ in texts]
    for start, length, period in zip(*(x.tolist() for x in periodic_runs.runs_of(ids, firsts, **options))):
        k = int(np.searchsorted(firsts, start, "right")) - 1
        out[k].append((start - int(firsts[k]), length, period))
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text("ab", max_size=60), st.builds(lambda u, k, v: u * k + v, st.text("abc", min_size=1, max_size=6), st.integers(1, 9), st.text("abc", max_size=8))), min_size=1, max_size=4))
def test_every_run_once(texts):
    assert _found(texts) == [_runs(t) for t in texts]
    assert _found(texts, least_length=2, least_exponent=2) == [_runs(t, 2, 2) for t in texts]


def test_blocks_of_positions(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BLOCK_POSITIONS", 4)
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab"), 150, p=[0.9, 0.1])) for _ in range(20)] + ["abc" * 40, "a" * 90]
    assert _found(texts) == [_runs(t) for t in texts]


@pytest.mark.parametrize("unit", ["a", "ab", "abcabd"])
def test_long_runs_in_seconds(unit):
    text = "xyz" + unit * (120_000 // len(unit)) + "q"
    began = time.monotonic()
    assert _found([text]) == [[(3, 120_000, len(unit))]]
    assert time.monotonic() - began < 20


def _want(rows):
    out = Counter()
    for doc_id, text in rows:
        words = re.findall(SPACE, text or "")
        runs = _runs(words)
        top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
        out[doc_id, len(words), tuple(runs), top, _collapsed(words, runs)] += 1
    return out


def _got(df):
    return Counter((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), None if r.strongest is None else tuple(r.strongest), r.collapsed) for r in df.collect())


def test_odd_rows(spark, odd_docs, no_docs):
    more = [(20, "la la la la la la la"), (21, "x " * 5), (22, "a b " * 4 + "c d e " * 4), (23, " é ü" * 6), (23, "la " * 9), (None, "la " * 9)]
    docs = odd_docs.filter("doc_id is null or doc_id <> 6").unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    assert _got(periodic_runs.find_runs(docs)) == _want([(r.doc_id, r.text) for r in docs.collect()])
    long = periodic_runs.find_runs(odd_docs.filter("doc_id = 6")).first()
    assert [tuple(r) for r in long.runs] == [(0, 60_000, 977)] and long.collapsed == " ".join(f"v{i}" for i in range(977))
    assert periodic_runs.find_runs(no_docs).count() == 0
    clash = spark.createDataFrame([("la " * 9, "k", 1, 2)], ["my text", "a.id", "runs", "text"])
    assert periodic_runs.find_runs(clash, "a.id", "my text").first().n_words == 9


def test_query_on_the_smallest_tables(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for doc_id, text in docs:
        words = re.findall(SPACE, text or "")
        h = zlib.crc32(str(doc_id).encode())
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        if n > 1500:
            continue  # too slow here; covered above
        runs = _runs(words)
        top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        milli = None if top[0] is None else 1000 * top[1] // top[2]
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        want[doc_id] = (len(runs), *top, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(_collapsed(words, runs).encode()).hexdigest())
    got = {r[0]: tuple(r)[1:] for r in periodic_runs.op12_periodic_runs(spark, small_dir).collect()}
    assert len(got) == len(docs) and sum(x[0] > 0 for x in want.values()) > 10
    assert {k: got[k] for k in want} == want
