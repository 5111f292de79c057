"""Approximate nearest vectors: inverted lists of coded vectors, re-ranked exactly.

The collection is cut into cells around centres (``cells``). Of every vector the list of its
cell holds what is left after taking off the centre, cut into parts, each part as the number
of its nearest code word: one byte a part. A search reads the codes of the cells nearest to
each query, takes the best by them, and only these are compared by their whole vectors.

Centres and code words are fitted on a bounded sample (``cells.SAMPLE_VECTORS``); every vector
is coded. How many cells a search visits and how many hits it compares exactly is measured on
the same sample: enough to keep a ``target`` share of its nearest neighbours.

Vectors without an id or of null are not coded. Zero vectors are, and are near to nothing.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import cells
from ledgerloom.operators.sizing import fits_broadcast
from ledgerloom.operators.vectors import (
    BLOCK_QUERIES,
    CHUNK_VECTORS,
    PLACES,
    SCORE_CELLS,
    _Best,
    _complete,
    _matrix,
    _ranked,
    _unit_rows,
    _vectors,
)
from ledgerloom.session import written

register_pickle_by_value(sys.modules[__name__])

CODE_WORDS = 256
PART_DIMS = 4
# Queries of the sample that visits and depth are measured with.
MEASURED = 512
MOST_DEPTH = 1_000
# Hits by code that a task holds at once; queries of more are searched in turns.
HELD_HITS = 1_000_000


@dataclass(frozen=True)
class Lists:
    """Centres, code words of each part, and how far a search goes."""

    centres: np.ndarray
    words: tuple[np.ndarray, ...]
    visits: int
    depth: int

    def parts(self) -> list[slice]:
        ends = np.cumsum([0, *(w.shape[1] for w in self.words)])
        return [slice(a, b) for a, b in zip(ends[:-1], ends[1:])]

    def codes(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cell of each vector, and the code of what is left of it."""
        cell, _ = cells.nearest(unit, self.centres)
        rest = unit - self.centres[cell]
        numbers = [cells.nearest(rest[:, part], words)[0] for part, words in zip(self.parts(), self.words)]
        return cell, np.stack(numbers, axis=1).astype(np.uint8)

    def decoded(self, cell: np.ndarray, codes: np.ndarray) -> np.ndarray:
        return self.centres[cell] + np.hstack([words[codes[:, i]] for i, words in enumerate(self.words)])

    def order(self, unit: np.ndarray) -> np.ndarray:
        """The cells by distance from each vector."""
        return np.argsort(cells.squared_distances(unit, self.centres), axis=1, kind="stable")


def fit_lists(
    items: DataFrame,
    item_id: str = "id",
    vector: str = "embedding",
    n_cells: int | None = None,
    part_dims: int = PART_DIMS,
    k: int = 10,
    target: float = 0.97,
    most: int = cells.SAMPLE_VECTORS,
) -> Lists | None:
    """Lists for a collection, fitted on at most ``most`` of its vectors; None without any."""
    sample, n = cells.bounded_sample(items, item_id, vector, most)
    if not len(sample):
        return None
    centres = cells.k_means(sample, n_cells or cells.cells_for(n, len(sample)))
    rest = sample - centres[cells.nearest(sample, centres)[0]]
    dims = sample.shape[1]
    edges = [*range(0, dims, part_dims), dims]
    words = tuple(cells.k_means(rest[:, a:b], CODE_WORDS) for a, b in zip(edges, edges[1:]))
    lists = Lists(centres, words, len(centres), MOST_DEPTH)
    visits, depth = _measured(lists, sample, n, k, target)
    return Lists(centres, words, visits, depth)


def _measured(lists: Lists, sample: np.ndarray, n: int, k: int, target: float) -> tuple[int, int]:
    """Cells to visit and hits to compare, for a ``target`` share of the sample's neighbours."""
    k = min(k, len(sample) - 1)
    if k < 1:
        return len(lists.centres), 1
    asked = sample[:MEASURED]
    cell, codes = lists.codes(sample)
    coded = lists.decoded(cell, codes)
    scores, about = asked @ sample.T, asked @ coded.T
    for x in (scores, about):
        np.fill_diagonal(x, -np.inf)  # a query is no neighbour of its own
    near = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    place = np.argsort(lists.order(asked), axis=1)
    visits = np.sort(np.take_along_axis(place, cell[near], axis=1).ravel()) + 1
    rank = np.argsort(np.argsort(-about, axis=1), axis=1)
    depth = np.sort(np.take_along_axis(rank, near, axis=1).ravel()) + 1
    # both lose a little; each keeps the root of the target
    last = min(len(visits) - 1, int(np.ceil(target**0.5 * len(visits))))
    # the whole collection is as much denser around a query as it is larger than the sample
    wanted = depth[last] * max(1.0, n / len(sample)) ** 0.5
    return int(visits[last]), int(min(MOST_DEPTH, max(2 * k, np.ceil(wanted))))


def code_items(items: DataFrame, lists: Lists, item_id: str = "id", vector: str = "embedding") -> DataFrame:
    """(id, cell, code, embedding) of every item; write it with ``write_lists``."""
    own = _vectors(items, item_id, vector, "id")
    shared = items.sparkSession.sparkContext.broadcast(lists)

    def code(batch: pa.RecordBatch, unit: np.ndarray) -> pa.RecordBatch:
        cell, codes = shared.value.codes(unit)
        packed = pa.array([row.tobytes() for row in codes], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cell.astype(np.int32)), packed, batch.column("embedding")], names=["id", "cell", "code", "embedding"])

    schema = T.StructType(
        [own.schema["id"], T.StructField("cell", T.IntegerType()), T.StructField("code", T.BinaryType()), own.schema["embedding"]]
    )
    return own.mapInArrow(cells.task_of_cells(code), schema)


LIST_FILE_ROWS = 1_000_000


def write_lists(coded: DataFrame, path: str, rows: int) -> None:
    """One folder per cell; its rows are spread by id over as many files as a million rows each
    make of the whole, so a cell that holds a third of all rows is written by many tasks."""
    files = max(1, -(-rows // LIST_FILE_ROWS))
    coded.repartition("cell", F.pmod(F.xxhash64("id"), F.lit(files))).write.mode("overwrite").partitionBy("cell").parquet(path)


def _score_lists(best: _Best, unit: np.ndarray, qs: np.ndarray, coded: np.ndarray, ids: np.ndarray) -> None:
    step = max(1, SCORE_CELLS // max(1, len(qs)))
    for a in range(0, len(ids), step):
        best.add_scores(np.round(unit[qs] @ coded[a : a + step].T, PLACES) + 0.0, ids[a : a + step], qs)


def _gathered(batches, most: int):
    """The rows in tables of about ``most``."""
    held, n = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            n += batch.num_rows
        if n >= most:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _code_matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1)


def ivf_top_k(
    queries: DataFrame,
    stored: DataFrame,
    lists: Lists,
    k: int = 10,
    query_id: str = "query_id",
    vector: str = "embedding",
    visits: int | None = None,
    depth: int | None = None,
    block_queries: int = BLOCK_QUERIES,
    chunk_vectors: int = CHUNK_VECTORS,
) -> DataFrame:
    """(query_id, id, cosine, rank) of stored items (``code_items``) near each query.

    Cosines are exact; a neighbour outside the visited cells, or not among the ``depth`` best
    by code, is missed. Up to ``block_queries`` queries travel to the tasks that read the
    codes; more of them meet the codes of their cells in bounded pieces.
    """
    visits, depth = visits or lists.visits, max(k, depth or lists.depth)
    queries = _vectors(queries, query_id, vector, "query_id")
    codes = stored.select("id", "cell", "code")
    head = queries.limit(block_queries + 1).toArrow()
    find = _by_scan if head.num_rows <= block_queries else _by_pieces
    hits = find(queries, codes, lists, visits, depth, head, block_queries, chunk_vectors)
    order = Window.partitionBy("query_id").orderBy(F.col("cosine").desc(), "id")
    best = hits.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= depth)
    best = written(best.select("query_id", "id", "cell").distinct(), "coded-hits")
    return _ranked(_exact(best, queries, stored), k)


def _hit_schema(queries: DataFrame, items: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", items.schema["id"].dataType),
            T.StructField("cosine", T.DoubleType()),
            T.StructField("cell", T.IntegerType()),
        ]
    )


def _by_scan(queries, codes, lists, visits, depth, head, block_queries, chunk_vectors) -> DataFrame:
    asked = _complete(head, "query_id")
    query_ids, unit = asked.column("query_id"), _unit_rows(_matrix(asked.column("embedding")))
    wanted: dict[int, np.ndarray] = {}
    if len(unit):
        near = np.concatenate([lists.order(unit[a : a + cells.QUERY_ROWS])[:, :visits] for a in range(0, len(unit), cells.QUERY_ROWS)])
        order = np.argsort(near, axis=None, kind="stable")
        flat = near.ravel()[order]
        heads = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]])
        for a, b in zip(heads, [*heads[1:], len(flat)]):
            wanted[int(flat[a])] = order[a:b] // near.shape[1]
    shared = queries.sparkSession.sparkContext.broadcast((lists, unit, wanted, query_ids.to_pylist()))
    query_type = head.schema.field("query_id").type

    def scan(batches):
        own, unit, wanted, names = shared.value
        step = max(1, HELD_HITS // depth)
        for held in _gathered(batches, chunk_vectors):
            # rows in order of id, so that their numbers rank like the ids
            ids = held.column("id").to_numpy()
            by_id = np.argsort(ids, kind="stable")
            ids, cell, codes = ids[by_id], held.column("cell").to_numpy()[by_id], _code_matrix(held.column("code"))[by_id]
            order = np.argsort(cell, kind="stable")
            heads = np.flatnonzero(np.r_[True, np.diff(cell[order]) != 0])
            for first in range(0, len(unit), step):
                best = _Best(depth)
                for a, b in zip(heads, [*heads[1:], len(order)]):
                    rows = order[a:b]
                    qs = wanted.get(int(cell[rows[0]]), np.zeros(0, np.int64))
                    qs = qs[np.searchsorted(qs, first) : np.searchsorted(qs, first + step)]
                    if len(qs):
                        _score_lists(best, unit, qs, own.decoded(cell[rows], codes[rows]), rows)
                best.compact()
                row = best.id.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([names[q] for q in best.q], query_type),
                        pa.array(ids[row].tolist(), held.schema.field("id").type),
                        pa.array(best.score, pa.float64()),
                        pa.array(cell[row], pa.int32()),
                    ],
                    names=["query_id", "id", "cosine", "cell"],
                )

    # read from the folders of these cells only; at most as many as there are centres
    return codes.filter(F.col("cell").isin(sorted(wanted))).mapInArrow(scan, _hit_schema(queries, codes))


def _by_pieces(queries, codes, lists, visits, depth, head, block_queries, chunk_vectors) -> DataFrame:
    shared = queries.sparkSession.sparkContext.broadcast(lists)

    def visit(batches):
        for batch in cells.small(batches):
            batch = _complete(batch, "query_id")
            if not batch.num_rows:
                continue
            near = shared.value.order(_unit_rows(_matrix(batch.column("embedding"))))[:, :visits]
            rows = pa.array(np.repeat(np.arange(batch.num_rows), near.shape[1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("query_id").take(rows), batch.column("embedding").take(rows), pa.array(near.ravel().astype(np.int32))],
                names=["query_id", "embedding", "cell"],
            )

    schema = T.StructType([queries.schema["query_id"], queries.schema["embedding"], T.StructField("cell", T.IntegerType())])
    visiting = queries.mapInArrow(visit, schema)

    def score(chunk: pa.Table, block: pa.Table) -> pa.Table:
        best = _Best(depth)
        if chunk.num_rows and block.num_rows:
            unit = _unit_rows(_matrix(block.column("embedding")))
            cell = chunk.column("cell").to_numpy()
            coded = shared.value.decoded(cell, _code_matrix(chunk.column("code")))
            _score_lists(best, unit, np.arange(len(unit)), coded, chunk.column("id").to_numpy())
        best.compact()
        names = block.column("query_id").to_pylist()
        cell_no = chunk.column("cell")[0].as_py() if chunk.num_rows else 0
        return pa.table(
            {
                "query_id": pa.array([names[q] for q in best.q], block.schema.field("query_id").type),
                "id": pa.array(best.id.tolist(), chunk.schema.field("id").type),
                "cosine": pa.array(best.score, pa.float64()),
                "cell": pa.array(np.full(len(best.q), cell_no, np.int32)),
            }
        )

    return cells.in_pieces(codes, visiting, "id", "query_id", score, _hit_schema(queries, codes), chunk_vectors, block_queries)


def _exact(hits: DataFrame, queries: DataFrame, stored: DataFrame) -> DataFrame:
    """(query_id, id, cosine) of hits by their whole vectors."""
    some = [r["cell"] for r in hits.select("cell").distinct().collect()]  # at most one per centre
    vectors = stored.filter(F.col("cell").isin(some)).select("id", "cell", F.col("embedding").alias("theirs"))
    small = (lambda df: F.broadcast(df) if fits_broadcast(df) else df)
    asked = queries.filter(F.col("query_id").isNotNull()).withColumnRenamed("embedding", "mine")
    pairs = vectors.join(small(hits), ["id", "cell"]).join(small(asked), "query_id").select("query_id", "id", "mine", "theirs")

    def compare(batches):
        for batch in batches:
            if batch.num_rows:
                mine, theirs = (_unit_rows(_matrix(batch.column(c))) for c in ("mine", "theirs"))
                cosine = np.round((mine * theirs).sum(axis=1), PLACES) + 0.0
                yield pa.RecordBatch.from_arrays([batch.column("query_id"), batch.column("id"), pa.array(cosine)], names=["query_id", "id", "cosine"])

    schema = T.StructType([pairs.schema["query_id"], pairs.schema["id"], T.StructField("cosine", T.DoubleType())])
    return pairs.mapInArrow(compare, schema)
