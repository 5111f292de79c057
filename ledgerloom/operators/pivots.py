"""Exact nearest vectors of many queries by pivots: a query meets only cells that can matter.

Vectors of length 1 lie in cells around pivots (``cells``); of each cell its number of items
and their least and largest distance from the pivot are known. For a query q

* the items of a cell are no nearer than the difference of q's distance from the pivot and
  the cell's distances from it (triangle inequality), nor nearer than the plane halfway
  between that pivot and q's own one, on whose far side they lie;
* after the first round, in which q meets the cells nearest to it that hold k items, its
  k-th best is known, and only cells that can hold something nearer are met in the second.

Items are never copied for other queries: they meet the queries by cells, and only a cell with
very many queries is met in several pieces. Results are those of ``vectors.top_k``.

Zero vectors have no direction. Zero items score 0 with everything, so the k smallest ids of
them stand for all; a zero query scores 0 with everything and gets the k smallest ids.
"""

from __future__ import annotations

import sys
from typing import NamedTuple

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
    _Best,
    _Block,
    _complete,
    _hit_schema,
    _matrix,
    _ranked,
    _score_all,
    _unit_rows,
    _vectors,
)
from ledgerloom.session import written

register_pickle_by_value(sys.modules[__name__])

# Rounded cosines within this of each other may be equal.
SLACK = 1e-9


class Bounds(NamedTuple):
    """Pivots of the cells that hold items, with their numbers, sizes and distances."""

    number: np.ndarray
    pivots: np.ndarray
    size: np.ndarray
    least: np.ndarray
    most: np.ndarray

    def first(self, unit: np.ndarray, k: int) -> list[np.ndarray]:
        """The nearest cells of each query that hold ``k`` items together."""
        near = np.argsort(cells.squared_distances(unit, self.pivots), axis=1, kind="stable")
        enough = np.cumsum(self.size[near], axis=1) >= k
        stop = np.where(enough.any(axis=1), enough.argmax(axis=1), len(self.number) - 1)
        return [row[: end + 1] for row, end in zip(near, stop)]

    def lower(self, unit: np.ndarray) -> np.ndarray:
        """No item of a cell is nearer to a query than this distance."""
        squared = cells.squared_distances(unit, self.pivots)
        distance, own = np.sqrt(squared), squared.argmin(axis=1)
        apart = np.sqrt(cells.squared_distances(self.pivots, self.pivots))[own]
        with np.errstate(divide="ignore", invalid="ignore"):
            plane = (squared - squared[np.arange(len(own)), own][:, None]) / (2 * apart)
        plane = np.where(apart > 0, plane, 0.0)
        return np.maximum(np.maximum(distance - self.most, self.least - distance), np.maximum(plane, 0))


def _measure(assigned: DataFrame, centres: np.ndarray) -> Bounds:
    rows = assigned.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("radius").alias("least"), F.max("radius").alias("most")).toPandas()  # one row a cell
    rows = rows.sort_values("cell")
    number = rows["cell"].to_numpy(np.int64)
    return Bounds(number, centres[number], *(rows[c].to_numpy(np.float64) for c in ("n", "least", "most")))


def assign(items: DataFrame, centres: np.ndarray) -> DataFrame:
    """(id, embedding, cell, radius): the nearest pivot and the distance from it; zero vectors have cell -1."""
    shared = items.sparkSession.sparkContext.broadcast(centres)

    def work(batch: pa.RecordBatch, unit: np.ndarray) -> pa.RecordBatch:
        cell, radius = cells.nearest(unit, shared.value)
        cell[(unit == 0).all(axis=1)] = -1
        return pa.RecordBatch.from_arrays([batch.column("id"), batch.column("embedding"), pa.array(cell.astype(np.int32)), pa.array(radius)], names=["id", "embedding", "cell", "radius"])

    schema = T.StructType([items.schema["id"], items.schema["embedding"], T.StructField("cell", T.IntegerType()), T.StructField("radius", T.DoubleType())])
    return items.mapInArrow(cells.task_of_cells(work), schema)


def visits(queries: DataFrame, bounds: Bounds, k: int, reached: bool) -> DataFrame:
    """(query_id, embedding, cell): the cells of the first round, or, with the k-th best cosine
    of each query in ``reached`` (null if it has none), the further ones of the second."""
    shared = queries.sparkSession.sparkContext.broadcast(bounds)

    def work(batches):
        own = shared.value
        for batch in cells.small(batches):
            batch = _complete(batch, "query_id")
            if not batch.num_rows or not len(own.number):
                continue
            unit = _unit_rows(_matrix(batch.column("embedding")))
            met = own.first(unit, k)
            if reached:
                worst = batch.column("reached").to_numpy(zero_copy_only=False).astype(float)
                # cosine c of vectors of length 1 is a distance of sqrt(2 - 2c)
                within = np.where(np.isnan(worst), np.inf, np.maximum(0, 2 - 2 * worst))
                open_ = own.lower(unit) ** 2 <= within[:, None] + SLACK
                for row, done in zip(open_, met):
                    row[done] = False
                met = [np.flatnonzero(row) for row in open_]
            rows = pa.array(np.repeat(np.arange(batch.num_rows), [len(m) for m in met]))
            cell = own.number[np.concatenate(met)].astype(np.int32) if len(rows) else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("query_id").take(rows), batch.column("embedding").take(rows), pa.array(cell)], names=["query_id", "embedding", "cell"])

    schema = T.StructType([queries.schema["query_id"], queries.schema["embedding"], T.StructField("cell", T.IntegerType())])
    return queries.mapInArrow(work, schema)


def _meet(assigned: DataFrame, visiting: DataFrame, k: int, block_queries: int, chunk_vectors: int) -> DataFrame:
    def score(chunk: pa.Table, block_table: pa.Table) -> pa.Table:
        best = _Best(k)
        unit = _unit_rows(_matrix(block_table.column("embedding"))) if block_table.num_rows else np.zeros((0, 0))
        block = _Block(block_table.column("query_id").to_numpy(), unit)
        if chunk.num_rows and len(unit):
            _score_all(best, block, _unit_rows(_matrix(chunk.column("embedding"))), chunk.column("id").to_numpy())
        return best.rows(block, chunk.schema.field("id").type, block_table.schema.field("query_id").type)

    # only cells that some query visits are shuffled
    return cells.in_pieces(assigned, visiting, "id", "query_id", score, _hit_schema(visiting, assigned), chunk_vectors, block_queries)


def pivot_top_k(
    queries: DataFrame,
    items: DataFrame,
    k: int = 10,
    query_id: str = "query_id",
    item_id: str = "id",
    vector: str = "embedding",
    n_cells: int | None = None,
    block_queries: int = BLOCK_QUERIES,
    chunk_vectors: int = CHUNK_VECTORS,
    counted: dict | None = None,
) -> DataFrame:
    """(query_id, id, cosine, rank): the exact k nearest items of every query.

    ``counted``, if given, gets the number of (query, cell) meetings of both rounds, of all
    that there could be.
    """
    queries = _vectors(queries, query_id, vector, "query_id")
    items = _vectors(items, item_id, vector, "id").filter(F.col("id").isNotNull())
    sample, n = cells.bounded_sample(items)
    least_ids = items.filter(F.col("embedding").isNotNull()).select("id").orderBy("id").limit(k)
    if not len(sample):  # no vectors, or zero vectors only
        return _ranked(_all_zero(queries, least_ids), k)
    # the pivots stand for cells; what they are fitted on does not change results
    centres = cells.k_means(sample, n_cells or cells.cells_for(n, len(sample)))
    assigned = assign(items, centres)
    bounds = _measure(assigned.filter("cell >= 0").select("cell", "radius"), centres)
    plain = _with_direction(queries, True)

    met = visits(plain, bounds, k, False)
    near = assigned.filter("cell >= 0").drop("radius")
    first = written(_best_of(_meet(near, met, k, block_queries, chunk_vectors), k), "first-round")
    worst = first.filter(F.col("_rank") == k).select("query_id", F.col("cosine").alias("reached"))
    asked = plain.join(F.broadcast(worst) if fits_broadcast(worst) else worst, "query_id", "left")
    again = written(visits(asked, bounds, k, True), "further-cells")
    if counted is not None:
        counted.update(met=met.count() + again.count(), all=plain.count() * len(bounds.number))
    second = _meet(near, again, k, block_queries, chunk_vectors)
    zeros = assigned.filter("cell = -1").select("id").orderBy("id").limit(k)
    hits = first.drop("_rank").unionByName(second)
    hits = hits.unionByName(_all_zero(plain, zeros)).unionByName(_all_zero(_with_direction(queries, False), least_ids))
    return _ranked(hits, k)


def _best_of(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("cosine").desc(), "id")
    return hits.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= k)


def _with_direction(queries: DataFrame, has: bool) -> DataFrame:
    some = F.exists("embedding", lambda x: x != 0)
    return queries.filter(F.col("query_id").isNotNull() & (some if has else ~some))


def _all_zero(queries: DataFrame, ids: DataFrame) -> DataFrame:
    """Every query with each of at most k ids, at cosine 0."""
    found = ids.agg(F.collect_list("id").alias("ids"))
    # one row of at most k ids
    return queries.select("query_id", F.lit(True).alias("_one")).join(F.broadcast(found.withColumn("_one", F.lit(True))), "_one").select("query_id", F.explode("ids").alias("id"), F.lit(0.0).alias("cosine"))
