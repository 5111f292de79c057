"""Inverted lists and pivots against the exact search."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import cells, inverted, pivots
from ledgerloom.operators import vectors as vec

SCHEMA = "id long, embedding array<float>"


def _frame(spark, rows, name="id"):
    return spark.createDataFrame([(i, None if v is None else [float(x) for x in v]) for i, v in rows], SCHEMA).withColumnRenamed("id", name)


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 24))
    return centres[rng.integers(0, 40, 3000)] + 0.15 * rng.normal(size=(3000, 24))


@pytest.fixture(scope="module")
def items(spark, clustered):
    return _frame(spark, enumerate(clustered)).cache()


@pytest.fixture(scope="module")
def queries(spark, clustered):
    return _frame(spark, [(i, clustered[i]) for i in range(0, 3000, 50)], "query_id").cache()


def _hits(df):
    return sorted((r.query_id, r["rank"], r.id, r.cosine) for r in df.select("query_id", "rank", "id", "cosine").collect())


def _odd(rows, dims=24):
    """Zero vectors, equal vectors, opposite ones, no id and no vector."""
    rows = list(rows)
    return [*rows, (9000, np.zeros(dims)), (9001, np.zeros(dims)), (9002, rows[0][1]), (9003, rows[0][1]), (9004, -rows[1][1]), (9005, None), (None, rows[2][1])]


@pytest.mark.parametrize("most", [(16_384, 100_000), (7, 120)])
def test_pivots_equal_the_exact_search(spark, clustered, most):
    held = _frame(spark, _odd(enumerate(clustered[:700])))
    asked = _frame(spark, _odd((i, clustered[i]) for i in range(0, 1400, 35)), "query_id")
    counted = {}
    got = pivots.pivot_top_k(asked, held, 7, block_queries=most[0], chunk_vectors=most[1], counted=counted)
    want = vec.top_k(asked, held, 7)
    assert _hits(got) == _hits(want)
    assert 0 < counted["met"] < counted["all"]


def test_few_cells_are_met_in_clustered_vectors(queries, items):
    counted = {}
    assert _hits(pivots.pivot_top_k(queries, items, 10, counted=counted)) == _hits(vec.top_k(queries, items, 10))
    assert counted["met"] < 0.2 * counted["all"]


@pytest.mark.parametrize("seed", range(3))
def test_bounds_hold(seed):
    rng = np.random.default_rng(seed)
    x, q = (m / np.linalg.norm(m, axis=1)[:, None] for m in (rng.normal(size=(800, 5)), rng.normal(size=(60, 5))))
    centres = cells.k_means(x, 12)
    cell, radius = cells.nearest(x, centres)
    number = np.unique(cell)
    bounds = pivots.Bounds(number, centres[number], *(np.array([f(radius[cell == c]) for c in number]) for f in (len, min, max)))
    lower = bounds.lower(q)
    for j, c in enumerate(number):
        nearest = np.sqrt(cells.squared_distances(q, x[cell == c]).min(axis=1))
        assert (lower[:, j] <= nearest + 1e-7).all()
    assert (lower > 0.3).any()


def test_small_and_empty_collections(spark):
    none = _frame(spark, [])
    one = _frame(spark, [(1, [1.0, 0.0]), (2, None)])
    asked = _frame(spark, [(7, [1.0, 1.0]), (8, [0.0, 0.0])], "query_id")
    for held in (none, one, _frame(spark, [(3, [0.0, 0.0]), (1, [0.0, 0.0])])):
        assert _hits(pivots.pivot_top_k(asked, held, 3)) == _hits(vec.top_k(asked, held, 3))
    assert pivots.pivot_top_k(none.withColumnRenamed("id", "query_id"), one, 3).count() == 0
    assert inverted.fit_lists(none) is None


@pytest.fixture(scope="module")
def stored(spark, items, tmp_path_factory):
    lists = inverted.fit_lists(items)
    path = str(tmp_path_factory.mktemp("lists"))
    inverted.write_lists(inverted.code_items(items, lists), path, 3000)
    return lists, spark.read.parquet(path)


def test_lists_hold_every_item_once(stored, items):
    lists, coded = stored
    assert sorted(r.id for r in coded.select("id").collect()) == list(range(3000))
    assert coded.filter(F.length("code") != len(lists.words)).isEmpty()
    assert coded.join(items.withColumnRenamed("embedding", "own"), "id").filter("own <> embedding").isEmpty()


def test_lists_find_nine_tenths_of_the_neighbours(stored, queries, items):
    lists, coded = stored
    found, exact = inverted.ivf_top_k(queries, coded, lists), vec.top_k(queries, items)
    assert vec.recall(found, exact).agg(F.avg("recall")).first()[0] >= 0.9
    cosines = {(q, i): c for q, _, i, c in _hits(exact)}
    assert all(cosines[q, i] == c for q, _, i, c in _hits(found) if (q, i) in cosines)
    # most cells are not visited, and few hits are compared by whole vectors
    assert lists.visits <= len(lists.centres) // 3 and lists.depth < 300


def test_both_ways_of_meeting_find_the_same(stored, queries):
    lists, coded = stored
    scanned = _hits(inverted.ivf_top_k(queries, coded, lists))
    assert scanned == _hits(inverted.ivf_top_k(queries, coded, lists, block_queries=8, chunk_vectors=64))
    every = inverted.ivf_top_k(queries, coded, lists, visits=len(lists.centres), depth=3000)
    assert {(q, r) for q, r, *_ in _hits(every)} == {(q, r) for q, r, *_ in scanned}


def test_odd_rows_in_lists(spark, clustered):
    held = _frame(spark, [*_odd(enumerate(clustered[:200])), (0, clustered[1])])
    lists = inverted.fit_lists(held)
    coded = inverted.code_items(held, lists)
    assert coded.count() == 200 + 5 + 1
    asked = _frame(spark, _odd([(0, clustered[0]), (1, clustered[1]), (2, clustered[2])]), "query_id")
    found = inverted.ivf_top_k(asked, coded, lists, 5, visits=len(lists.centres), depth=300)
    assert _hits(found) == _hits(vec.top_k(asked, held.filter("id is not null"), 5))


def test_a_hot_cell_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inverted, "LIST_FILE_ROWS", 100)
    held = _frame(spark, [(i, [1.0, 0.001 * (i % 7)]) for i in range(1000)])
    lists = inverted.fit_lists(held, n_cells=1)
    # small pieces would be put together at run time
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "false")
    try:
        inverted.write_lists(inverted.code_items(held, lists), str(tmp_path / "hot"), 1000)
    finally:
        spark.conf.set(setting, before)
    assert len(list((tmp_path / "hot" / "cell=0").glob("*.parquet"))) > 3


def test_a_task_holds_a_bounded_number_of_hits(stored, queries, monkeypatch):
    lists, coded = stored
    whole = inverted.ivf_top_k(queries, coded, lists)
    want = {(r["query_id"], r["id"], r["rank"]) for r in whole.collect()}
    monkeypatch.setattr(inverted, "HELD_HITS", 3 * lists.depth)
    monkeypatch.setattr(cells, "QUERY_ROWS", 7)
    again = inverted.ivf_top_k(queries, coded, lists, chunk_vectors=150)
    assert {(r["query_id"], r["id"], r["rank"]) for r in again.collect()} == want
