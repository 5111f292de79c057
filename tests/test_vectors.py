from __future__ import annotations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import vectors as vec
from ledgerloom.session import scratch_path


def frame(spark, matrix, name):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{name} bigint, embedding array<float>")


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    items = rng.normal(size=(400, 8)).astype("float32")
    items[100:230] = items[100]   # a third of the items are copies of one
    items[7] = 0
    queries = rng.normal(size=(23, 8)).astype("float32")
    queries[5] = items[100]
    queries[6] = 0
    return frame(spark, items, "id").repartition(5).cache(), frame(spark, queries, "query_id").cache(), items, queries


def brute(items, queries, k):
    """All pairs, sorted by rounded cosine and id."""
    def unit(m):
        m = m.astype("float64")
        n = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    cos = np.round(unit(queries) @ unit(items).T, vec.PLACES) + 0.0
    out = []
    for q, row in enumerate(cos):
        order = sorted(range(len(row)), key=lambda i: (-row[i], i))[:k]
        out += [(q, i, rank) for rank, i in enumerate(order, 1)]
    return sorted(out)


def hits(df):
    return sorted((r.query_id, r.id, r["rank"]) for r in df.select("query_id", "id", "rank").collect())


@pytest.mark.parametrize("k", [1, 10, 500])
def test_exact_equals_brute_force(data, k):
    items, queries, m, q = data
    assert hits(vec.top_k(queries, items, k)) == brute(m, q, k)


def test_blocked_search_equals_brute_force(data):
    items, queries, m, q = data
    got = vec.top_k(queries, items, 10, block_queries=4, chunk_vectors=60)
    assert hits(got) == brute(m, q, 10)


def test_small_score_steps_change_nothing(data, monkeypatch):
    items, queries, m, q = data
    monkeypatch.setattr(vec, "SCORE_CELLS", 200)
    monkeypatch.setattr(vec._Best, "PENDING", 15)
    best = vec._Best(10)
    block = vec._Block(np.arange(len(q)), vec._unit_rows(q.astype("float64")))
    vec._score_all(best, block, vec._unit_rows(m.astype("float64")), np.arange(len(m)).astype(object))
    best.compact()
    pairs = sorted(zip(best.q.tolist(), best.id.tolist()))
    assert pairs == sorted((a, b) for a, b, _ in brute(m, q, 10))


def test_bucket_search_finds_only_true_neighbours_and_fills_up(spark, data):
    items, queries, m, q = data
    hashes = vec.bucket_hash(items, tables=4, width=2)
    path = scratch_path(spark, "test-index")
    vec.write_bucket_index(vec.bucket_index(items, hashes), path)
    index = spark.read.parquet(path)
    k = 10

    # by hand: items sharing a bucket in some table
    tables = {r.id: r.buckets for r in hashes.buckets(items).collect()}
    asked = {r.query_id: r.buckets for r in hashes.buckets(queries).collect()}
    ranked_all = {}
    for a, b, rank in brute(m, q, len(m)):
        ranked_all.setdefault(a, []).append((rank, b))
    want = []
    for a, mine in asked.items():
        near = [b for _, b in sorted(ranked_all[a]) if any(x == y for x, y in zip(mine, tables[b]))]
        want += [(a, b, i) for i, b in enumerate(near[:k], 1)]
    assert hits(vec.bucket_top_k(queries, index, hashes, k)) == sorted(want)
    blocked = vec.bucket_top_k(queries, index, hashes, k, block_queries=4, chunk_vectors=30)
    assert hits(blocked) == sorted(want)

    full = vec.approx_top_k(queries, items, k, index=index, hashes=hashes)
    counts = {r.query_id: r["count"] for r in full.groupBy("query_id").count().collect()}
    assert set(counts.values()) == {k} and len(counts) == len(q)
    quality = vec.recall(full, vec.top_k(queries, items, k)).agg(F.avg("recall")).first()[0]
    assert quality > 0.5


def test_fewer_items_than_k(spark, data):
    _, queries, m, q = data
    few = frame(spark, m[:3], "id")
    assert hits(vec.top_k(queries, few, 10)) == brute(m[:3], q, 10)
    assert vec.top_k(queries, few.limit(0), 10).count() == 0
    assert vec.top_k(queries.limit(0), few, 10).count() == 0


def test_mixed_dimensions_are_refused(spark, data):
    _, queries, _, _ = data
    mixed = spark.createDataFrame([(1, [1.0] * 8), (2, [1.0] * 3)], "id bigint, embedding array<float>").coalesce(1)
    with pytest.raises(Exception, match="different lengths"):
        vec.top_k(queries, mixed, 1).collect()


def test_embedding_counts_words(spark):
    df = spark.createDataFrame([(1, "Heart heart failure"), (2, ""), (3, None), (4, "123 !")], "id int, document string")
    got = {r.id: np.array(r.embedding) for r in vec.embed(df).collect()}
    assert np.isclose(np.linalg.norm(got[1]), 1, atol=1e-6) and sorted(got[1][got[1] > 0].round(4)) == [0.4472, 0.8944]
    assert all(not got[i].any() for i in (2, 3, 4))


def test_model_slot_gets_batches(spark):
    def load():
        def run(texts):
            assert len(texts) <= 4
            return np.array([[len(t), 1.0] for t in texts])

        return run

    df = spark.createDataFrame([(i, "x" * i) for i in range(10)], "id int, document string")
    got = {r.id: list(r.embedding) for r in vec.embed(df, encoder=load, batch_size=4).collect()}
    assert got == {i: [float(i), 1.0] for i in range(10)}


def test_items_fill_in_missing_values(spark):
    df = spark.createDataFrame(
        [("NCT1", None, None, None, None, None, None, None, [0.0], "doc")],
        "nct_id string, brief_title string, overall_status string, phase string, conditions string, "
        "lead_sponsor string, enrollment_count bigint, is_recruiting boolean, embedding array<float>, document string",
    )
    m = vec.item_rows(df).first().metadata
    assert (m.brief_title, m.enrollment_count, m.is_recruiting) == ("", 0, False)


def test_missing_vectors_and_ids_are_left_out(spark, data):
    _, queries, m, q = data
    more = spark.createDataFrame([(None, [9.0] * 8), (999, None)], "id bigint, embedding array<float>")
    items = frame(spark, m, "id").unionByName(more).coalesce(1)
    asked = queries.unionByName(spark.createDataFrame([(77, None)], "query_id bigint, embedding array<float>"))
    assert hits(vec.top_k(asked, items, 5)) == brute(m, q, 5)
    assert hits(vec.top_k(asked, items, 5, block_queries=4, chunk_vectors=60)) == brute(m, q, 5)


def test_index_files_are_bounded(spark, data):
    """However many tasks write it, the index has one file per shard that has rows."""
    items = data[0]
    hashes = vec.bucket_hash(items)
    path = scratch_path(spark, "test-index")
    index = vec.bucket_index(items.repartition(7), hashes)
    vec.write_bucket_index(index, path)
    stored = spark.read.parquet(path)
    shards = stored.select("table_no", "shard").distinct().count()
    assert len(stored.inputFiles()) == shards and stored.count() == index.count()


def test_few_pairs_are_scored_in_full(monkeypatch):
    rng = np.random.default_rng(3)
    items, queries = rng.normal(size=(30_000, 24)), rng.normal(size=(700, 24))
    items[20_000:20_050] = items[5]  # equal vectors rank by id
    items[7] = 0
    items[9] = np.nan
    queries[0], queries[1] = items[5], 0
    unit, asked = vec._unit_rows(items), vec._unit_rows(queries)
    ids = rng.permutation(30_000)
    full = []
    add = vec._Best.add
    monkeypatch.setattr(vec._Best, "add", lambda self, q, score, those: (full.append(len(q)), add(self, q, score, those))[1])
    best = vec._Best(10)
    block = vec._Block(np.arange(700), asked)
    for at in range(0, 30_000, 9_000):
        vec._score_all(best, block, unit[at : at + 9_000], ids[at : at + 9_000])
    best.compact()
    scores = np.round(asked @ unit.T, 10) + 0.0
    scores[:, 9] = -np.inf
    for q in range(700):
        want = np.lexsort((ids, -scores[q]))[:10]
        assert best.id[best.q == q].tolist() == ids[want].tolist()
        np.testing.assert_allclose(best.score[best.q == q], scores[q][want], atol=2e-10)
    # the zero query ties with all; the others meet few in full
    assert sum(full) < 30_000 + 700 * 200


def test_ids_are_sorted_once_a_piece():
    compared = []

    class Id(str):
        def __lt__(self, other):
            compared.append(1)
            return str.__lt__(self, other)

    rng = np.random.default_rng(4)
    unit, asked = vec._unit_rows(rng.normal(size=(5_000, 8))), vec._unit_rows(rng.normal(size=(600, 8)))
    unit[4_000:4_020] = unit[3]  # equal vectors rank by id
    asked[0] = unit[3]
    ids = np.array([Id(f"n{i:05}") for i in rng.permutation(5_000)], dtype=object)
    best = vec._Best(10)
    vec._score_all(best, vec._Block(np.arange(600), asked), unit, ids)
    sorts = len(compared)
    best.compact()
    assert sorts < 2 * 5_000 * np.log2(5_000)
    scores = np.round(asked @ unit.T, 10) + 0.0
    for q in range(600):
        want = sorted(range(5_000), key=lambda i: (-scores[q, i], str(ids[i])))[:10]
        assert best.id[best.q == q].tolist() == [ids[i] for i in want]


def test_short_vectors_go_in_larger_pieces():
    def head(width):
        return pa.table({"embedding": pa.array([[0.0] * width], pa.list_(pa.float32()))})

    assert vec._piece_sizes(head(64), vec.BLOCK_QUERIES) == (131_072, 262_144)
    assert vec._piece_sizes(head(1_024), vec.BLOCK_QUERIES) == (vec.BLOCK_QUERIES, vec.CHUNK_VECTORS)
