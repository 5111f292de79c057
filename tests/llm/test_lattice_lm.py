"""The lattice model against sums over every segmentation, and counts against plain Python."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import lattice_lm

PIECES = public_tokenizers.path("piece_bpe_32k.model")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def lattice():
    return lattice_lm.Lattice(PIECES)


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def _paths(lattice, text):
    """Every segmentation of a short text as the pieces it takes, by plain recursion."""
    if not text:
        return [[]]
    out = []
    for k in range(1, len(text) + 1):
        piece = lattice.model.pieces.get(text[:k])
        if piece is not None:
            out += [[piece, *rest] for rest in _paths(lattice, text[k:])]
    if text[0] not in lattice.model.pieces:
        spelt = [int(lattice.model.bytes[b]) for b in text[0].encode()]
        out += [spelt + rest for rest in _paths(lattice, text[1:])]
    return out


WORDS = ["the", "a", "pieces", "Überall", "日本語", "\U0001f600x", "…", "qqqq", "b\x00c", "lattice", "▁", "l▁l"]


def test_marginals_and_expected_counts(lattice):
    times = np.arange(1, len(WORDS) + 1).astype(float)
    counts = np.zeros(lattice.size + 1)
    got = lattice.marginals(*lattice_lm.spelt(pa.array(WORDS)), times, counts)
    want = np.zeros(lattice.size + 1)
    for k, word in enumerate(WORDS):
        paths = _paths(lattice, "▁" + word)
        logs = np.array([lattice.weights[p].sum() for p in paths])
        total = np.logaddexp.reduce(logs)
        assert math.isclose(got[k], total, rel_tol=1e-12)
        for path, log in zip(paths, logs):
            np.add.at(want, path, times[k] * math.exp(log - total))
    assert np.allclose(counts, want, rtol=1e-9, atol=1e-12)


def test_long_words_go_alone(lattice, monkeypatch):
    words = ["pieces" * 9, "日本語\U0001f600" * 12, "ab"]
    times, one, other = np.array([2.0, 3.0, 1.0]), np.zeros(lattice.size + 1), np.zeros(lattice.size + 1)
    want = lattice.marginals(*lattice_lm.spelt(pa.array(words)), times, one)
    monkeypatch.setattr(lattice_lm, "LONG", 5)
    got = lattice.marginals(*lattice_lm.spelt(pa.array(words)), times, other)
    assert np.allclose(got, want, rtol=1e-12) and np.allclose(one, other, rtol=1e-9, atol=1e-12)
    assert lattice.marginals(*lattice_lm.spelt(pa.array([], pa.string()))).size == 0


def test_probabilities_add_up_and_learning_helps(spark, lattice, small_dir):
    assert lattice.crossing == 0 and math.isclose(np.exp(lattice.weights).sum(), 1, rel_tol=1e-9)
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    learnt = F.col("doc_id") % 2 == 0
    counts = lattice_lm.word_counts(docs, learnt)
    held_out = counts.filter("n > c").selectExpr("word", "n - c as n").toPandas()
    asked = lattice_lm.spelt(pa.array(held_out["word"]))
    totals = []
    for rounds in (0, 1, 2):
        model = lattice_lm.learn_lattice(counts, docs.filter(learnt).count(), PIECES, rounds)
        assert math.isclose(np.exp(model.weights).sum(), 1, rel_tol=1e-9)
        totals.append(float(model.marginals(*asked) @ held_out["n"].to_numpy()))
    assert totals[0] < totals[1] < totals[2]


def _want(rows, learnt, lattice):
    c = Counter(w for doc_id, text in rows if learnt(doc_id) for w in _words(text))
    ends = sum(learnt(doc_id) for doc_id, _ in rows)
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    out = defaultdict(list)
    for doc_id, text in rows:
        words = _words(text)
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        score = lattice.weights[-1] / math.log(10)
        if words:
            score += lattice.marginals(*lattice_lm.spelt(pa.array(words))).sum() / math.log(10)
        out[doc_id].append((len(words) + 1, sum(c[w] > 0 for w in words) + (ends > 0), n, base, score))
    return out


def _same(got, want):
    assert sum(map(len, want.values())) == len(got)
    mine = defaultdict(list)
    for r in got:
        mine[r.doc_id].append((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score))
    assert set(mine) == set(want)
    for key, rows in want.items():
        for a, b in zip(sorted(mine[key]), sorted(rows)):
            assert a[:3] == b[:3] and np.allclose(a[3:], b[3:], rtol=1e-9, atol=1e-9), key


@pytest.mark.parametrize("frequent", [1, 8, lattice_lm.FREQUENT])
def test_scores_of_odd_rows(spark, odd_docs, frequent):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    learnt = F.col("doc_id") % 3 != 0
    got = lattice_lm.score_texts(odd_docs, PIECES, learnt, frequent=frequent)
    model = lattice_lm.learn_lattice(lattice_lm.word_counts(odd_docs, learnt), sum(i is not None and i % 3 != 0 for i, _ in rows), PIECES)
    _same(got.collect(), _want(rows, lambda i: i is not None and i % 3 != 0, model))


def test_nothing_to_learn_from_and_other_names(spark, odd_docs, no_docs):
    docs = spark.createDataFrame([("a b", "k", 1, 2), (None, "j", 1, 2)], ["my text", "my.id", "row", "word"])
    got = {r[0]: r for r in lattice_lm.score_texts(docs, PIECES, F.lit(False), "my.id", "my text").collect()}
    assert got["j"].n_tokens == 1 and got["k"].n_tokens == 3
    assert got["k"].n_known == got["k"].base_score == got["k"].train_tokens == 0 and got["k"].score < got["j"].score < 0
    assert lattice_lm.score_texts(no_docs, PIECES, F.lit(True)).count() == 0


def test_query_on_the_smallest_tables(spark, small_dir):
    import zlib

    docs = spark.read.parquet(f"{small_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    learnt = lambda i: zlib.crc32(str(i).encode()) % 7 != 2
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    model = lattice_lm.learn_lattice(lattice_lm.word_counts(docs, fold), sum(learnt(i) for i, _ in rows), PIECES)
    got = lattice_lm.op13_lattice_lm(spark, small_dir).collect()
    assert all(r.held_out == (not learnt(r.doc_id)) for r in got)
    _same(got, _want(rows, learnt, model))
