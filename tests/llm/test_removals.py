"""Removing rows by id and text, whatever the other columns are called; blocks that a search skips."""

from __future__ import annotations

import tracemalloc

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, substring_dedup, toxicity
from ledgerloom.llm.tables import BATCH_SETTING, without_texts

COLUMNS = ["my.id", "the text", "bad_id", "BAD_HASH", "__bad_id", "text_hash", "id"]


@pytest.fixture(scope="module")
def clashing(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    rows = [(1, passage, 7, "x", 1, 2, 3), (1, "clean text", 1, "y", 1, 2, 3), (2, None, 2, None, 2, 2, 3), (None, passage, None, None, None, None, None)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` {t}" for c, t in zip(COLUMNS, ["long", "string", "long", "string", "long", "long", "long"])))


def test_only_the_named_text_of_an_id_goes(spark, clashing):
    bad = clashing.filter("`the text` like 'w0%'").select(F.col("`my.id`").alias("id"), F.xxhash64("the text").alias("text_hash"))
    left = without_texts(clashing, bad, "my.id", "the text")
    assert left.columns == COLUMNS
    assert [tuple(r) for r in left.orderBy("`my.id`").collect()] == [(1, "clean text", 1, "y", 1, 2, 3), (2, None, 2, None, 2, 2, 3)]


def test_contaminated_and_toxic_rows_of_such_tables(spark, clashing):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20)))], "item_id long, text string")
    left = decontaminate.drop_contaminated(clashing, items, id_col="my.id", text_col="the text")
    assert left.columns == COLUMNS and {r[0] for r in left.collect()} == {1, 2} and left.count() == 2
    labels = spark.createDataFrame([(1, 1), (2, 0)], "`my.id` long, toxic int")
    assert toxicity.drop_toxic(clashing, labels, "my.id", "the text").columns == COLUMNS


def test_blocks_are_skipped_on_the_given_table(spark, small_dir):
    """The index of the labelled texts, asked with texts that it holds and others."""
    path = small_dir.replace("sf0.001", "sf0.01")
    docs = duckdb.sql(f"select doc_id, text from '{path}/documents.parquet' where text is not null order by doc_id").fetchall()
    bags = [toxicity.np.unique([hash(w) for w in text.lower().split()], return_counts=True) for _, text in docs]
    known, flat = np.unique(np.concatenate([b for b, _ in bags]), return_inverse=True)
    have = np.bincount(flat, minlength=len(known))
    ends = np.r_[0, np.cumsum([len(b) for b, _ in bags])]
    idf = np.log((1 + len(bags)) / (1 + have)) + 1
    vectors = []
    for k, (_, counts) in enumerate(bags):
        terms = flat[ends[k] : ends[k + 1]]
        w = (1 + np.log(counts)) * idf[terms]
        vectors.append((terms, w / np.sqrt((w**2).sum()) if len(w) else w))
    n = 800
    index = toxicity.Examples.of(vectors[:n], np.zeros(n), np.ones(n), 0.1, len(known))
    for terms, weights in vectors[:60] + vectors[n : n + 60]:
        found, cosines = index.nearest(terms, weights, 10)
        whole = np.zeros(len(known))
        whole[terms] = weights
        every = np.sort([whole[t] @ w for t, w in vectors[:n]])[::-1][:10].round(12)
        assert np.allclose(cosines, every[every > 0], atol=1e-9)
    assert 0 < index.read < index.blocks
    print(f"read {index.read} of {index.blocks} blocks")


def test_memory_of_the_vote_task():
    """Per example, frequent terms take four bytes each; the packed postings and those of the others are not held."""
    n, frequent, rare = 2048, 256, 20_000
    rng = np.random.default_rng(5)
    terms = [np.unique(np.r_[rng.integers(0, frequent, 40), frequent + rng.integers(0, rare, 100)]) for _ in range(n)]
    places, terms = np.repeat(np.arange(n, dtype=np.int32), [len(x) for x in terms]), np.concatenate(terms).astype(np.int32)
    by_term = np.lexsort((places, terms))
    labels = np.arange(n) % 2.0
    model = toxicity.Model(places[by_term], terms[by_term], np.ones(len(terms), np.int32), np.ones(frequent + rare), labels, np.ones(n), 0.5, np.zeros(frequent + rare))
    weights = 1 / np.sqrt(np.bincount(places))[places]
    matrix = np.zeros((n, frequent + rare))
    matrix[places, terms] = weights
    asked = np.arange(100, 150)
    index, (sizes, own, own_weights) = model.index(asked)
    assert len(index.dense) == frequent and not model.packed
    assert sizes.tolist() == np.bincount(places)[asked].tolist() and own.tolist() == terms[(places >= 100) & (places < 150)].tolist()
    held = sum(x.nbytes for x in vars(index).values() if isinstance(x, np.ndarray))
    assert held < 4 * n * frequent + 32 * len(terms) + 32 * (frequent + rare)
    found, cosines, _ = next(index.nearest_of(np.r_[0, np.cumsum(sizes)], own, own_weights, 10, [[i] for i in asked]))
    truth = (matrix @ matrix[100]).round(12)
    truth[100] = 0
    best = np.lexsort((np.arange(n), -truth))[:10]
    assert found.tolist() == best.tolist() and np.allclose(cosines, truth[best], atol=1e-11)


def test_buckets_are_sorted_in_pieces(monkeypatch):
    """Finding repeats takes less than 12 bytes a window beyond its rows, and pieces change no result."""
    n_docs, each = 400, 1000
    rng = np.random.default_rng(7)
    hashes = rng.integers(0, 1 << 62, (n_docs, each)) * 4 + 1
    hashes[1::2, :50] = hashes[::2, :50]  # every second document repeats some of the one before
    rows = [pa.RecordBatch.from_pydict({"bucket": pa.array([0], pa.int32()), "flagged": [False], "doc_ids": [[i]], "counts": pa.array([[each]], pa.list_(pa.int32())), "hashes": [hashes[i]]}) for i in range(n_docs)]
    found = {}
    for most in (1 << 30, 1 << 14):
        monkeypatch.setattr(substring_dedup, "PIECE_WINDOWS", most)
        tracemalloc.start()
        batches = list(substring_dedup._find_repeats(4)(iter(rows)))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        found[most] = [b.to_pydict() for b in batches]
    assert peak < 12 * n_docs * each
    assert found[1 << 14] == found[1 << 30]
    dealt = sorted((d, n) for part in found[1 << 14] for ids, counts in zip(part["doc_ids"], part["counts"]) for d, n in zip(ids, counts))
    assert dealt == [(i, 50) for i in range(1, n_docs, 2)]


def test_texts_are_scored_in_small_batches(spark, clashing, monkeypatch):
    """What goes to a task at once is bounded by bytes of texts while documents are dropped."""
    seen, kept = [], toxicity.without_texts
    monkeypatch.setattr(toxicity, "without_texts", lambda *args: (seen.append(spark.conf.get(BATCH_SETTING)), kept(*args))[1])
    before = spark.conf.get(BATCH_SETTING)
    labels = spark.createDataFrame([(1, 1), (2, 0)], "`my.id` long, toxic int")
    assert toxicity.drop_toxic(clashing, labels, "my.id", "the text").columns == COLUMNS
    assert seen == [str(8 << 20)] and spark.conf.get(BATCH_SETTING) == before
