"""Voronoi cells of a vector collection: centres from a bounded sample, and pieces of cells.

Vectors are scaled to length 1; a vector belongs to the nearest centre. The centres are all
that the driver holds of the vectors, besides the sample while they are fitted.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.sizing import fits_broadcast
from ledgerloom.operators.vectors import _complete, _matrix, _unit_rows
from ledgerloom.session import written

register_pickle_by_value(sys.modules[__name__])

# Vectors that are fitted on; a cell's centre is the mean of some 16 of them at least.
SAMPLE_VECTORS = 32_768
MOST_CELLS = 2_048
ROUNDS = 8
# Rows of a distance matrix at a time.
STEP = 4_096
# Queries whose distances from all centres a task holds at once.
QUERY_ROWS = 512


def bounded_sample(items: DataFrame, item_id: str = "id", vector: str = "embedding", most: int = SAMPLE_VECTORS) -> tuple[np.ndarray, int]:
    """At most ``most`` unit vectors, chosen by a hash of the id, and the number of all items.

    The same ids give the same sample on any partitioning. Zero vectors have no direction
    and are left out, as are those with null components.
    """
    own = items.select(F.col(item_id).alias("id"), F.col(vector).alias("embedding")).filter(
        F.col("id").isNotNull() & F.col("embedding").isNotNull()
    )
    n = own.count()
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    # a fifth more than wanted, so that the exact cut sorts no more than that
    share = min(1.0, 1.2 * most / max(n, 1) + 64 / max(n, 1))
    near = own.filter(place < int(share * (1 << 30))).orderBy(place, "id").limit(most)
    rows = near.select("embedding").toArrow()
    sample = _unit_rows(_matrix(rows.column("embedding"))) if rows.num_rows else np.zeros((0, 0))
    return sample[(sample != 0).any(axis=1) & np.isfinite(sample).all(axis=1)], n


def squared_distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (centres * centres).sum(1)[None, :] - 2 * (x @ centres.T)
    return np.maximum(d, 0)


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of each row, and the distance to it."""
    cell, distance = np.zeros(len(x), np.int64), np.zeros(len(x))
    for a in range(0, len(x), STEP):
        d = squared_distances(x[a : a + STEP], centres)
        cell[a : a + STEP] = d.argmin(1)
        distance[a : a + STEP] = np.sqrt(d.min(1))
    return cell, distance


def k_means(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Centres of ``x``; one that loses all its rows takes the row farthest from its own."""
    k = max(1, min(k, len(x)))
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        cell, distance = nearest(x, centres)
        counts = np.bincount(cell, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        some = counts > 0
        centres[some] = sums[some] / counts[some][:, None]
        empty = np.flatnonzero(~some)
        centres[empty] = x[np.argsort(-distance)[: len(empty)]]
    return centres


def cells_for(n: int, sample: int, most: int = MOST_CELLS) -> int:
    """About the square root of the number of items, as far as the sample carries it."""
    return int(max(1, min(most, round(n**0.5), sample // 16 or 1)))


def small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``QUERY_ROWS``."""
    for batch in batches:
        for at in range(0, batch.num_rows, QUERY_ROWS):
            yield batch.slice(at, QUERY_ROWS)


def task_of_cells(work):
    """A ``mapInArrow`` function that gives ``work`` the batch's ids and unit vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = _complete(batch)
            if batch.num_rows:
                yield work(batch, _unit_rows(_matrix(batch.column("embedding"))))

    return run


def in_pieces(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    score,
    schema,
    left_most: int,
    right_most: int,
    place: str = "cell",
) -> DataFrame:
    """Rows of both sides that have the same ``place`` meet in a cogroup, in bounded pieces.

    A place of very many rows on one side is cut by a hash of that side's key; the other
    side's rows are copied to each of its pieces. Places of one side only are left out.
    """
    # hashed pieces vary in size, so aim at half of what a piece may hold
    sizes = left.groupBy(place).agg(F.count(F.lit(1)).alias("_l")).join(right.groupBy(place).agg(F.count(F.lit(1)).alias("_r")), place)
    pieces = written(
        sizes.select(place, F.ceil(F.col("_l") * 2 / left_most).cast("int").alias("_lefts"), F.ceil(F.col("_r") * 2 / right_most).cast("int").alias("_rights")),
        "pieces",
    )
    if fits_broadcast(pieces):
        pieces = F.broadcast(pieces)

    def cut(df: DataFrame, key: str, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        every: Column = F.explode(F.sequence(F.lit(0), F.col(other_n) - 1))
        return df.join(pieces, place).withColumn(own, F.pmod(F.xxhash64(key), F.col(own_n)).cast("int")).withColumn(other, every).drop(own_n, other_n)

    keys = [place, "_left", "_right"]
    return (
        cut(left, left_key, "_left", "_lefts", "_right", "_rights")
        .groupBy(keys)
        .cogroup(cut(right, right_key, "_right", "_rights", "_left", "_lefts").groupBy(keys))
        .applyInArrow(score, schema)
    )
