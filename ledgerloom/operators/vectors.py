"""Embedding a text column and finding the nearest vectors, exactly or by buckets.

Both searches send the same shape through Spark: every task scores its own batches
of vectors against a block of queries, keeps its k best per query, and only those
rows are shuffled for the final ranking. No task ever holds or emits all pairs.

Ranking is by cosine similarity rounded to 10 places, then by id, so equal vectors
rank the same on any partitioning. A zero vector has similarity 0 to everything.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.ml.feature import BucketedRandomProjectionLSH, CountVectorizerModel, Normalizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import clipped, search_text, term_buckets
from ledgerloom.operators.sizing import fits_broadcast
from ledgerloom.session import written

# Executors need no copy of this package: what tasks run is sent along with them.
register_pickle_by_value(sys.modules[__name__])

# Queries one block may hold: with 1,024 dimensions, 128 MB of doubles.
BLOCK_QUERIES = 16_384
# Vectors one group of the blocked search may hold.
CHUNK_VECTORS = 100_000
# Of short vectors the exact search puts more into a piece, so there are fewer copies and
# fewer hits of pieces to rank: places a piece of queries and one of items may hold (64 and
# 128 MB of doubles), where that still makes so many groups for each core.
BLOCK_CELLS, CHUNK_CELLS = 8 << 20, 16 << 20
GROUPS_A_CORE = 4
# Scores one step of a task may hold (32 MB of doubles).
SCORE_CELLS = 4_000_000
PLACES = 10
# A tile of the exact search is small enough for a core's cache.
TILE_QUERIES, TILE_ITEMS = 256, 2_048
# Pairs scored in full at once, and what rounding bounds and scores may add.
EXACT_PAIRS = 65_536
SCORE_SLACK = 1e-6


# -- corpus and embedding -------------------------------------------------------------


def corpus_texts(
    df: DataFrame,
    key: str = "nct_id",
    summary: str = "brief_summary",
    columns: Sequence[str] = ("brief_title", "conditions", "phase", "overall_status"),
    summary_chars: int | None = None,
    min_summary_chars: int = 0,
    text: str = "document",
) -> DataFrame:
    """Records with a key and a summary, with the text to embed.

    The whole summary is used unless ``summary_chars`` asks for a shorter one;
    ``min_summary_chars`` leaves out summaries that are not longer than that.
    """
    kept = df.filter(F.col(key).isNotNull() & F.col(summary).isNotNull())
    if min_summary_chars:
        kept = kept.filter(F.length(summary) > min_summary_chars)
    return kept.withColumn(text, search_text(columns, summary, summary_chars))


def _unit_length(df: DataFrame, source: str, out: str, dtype: str) -> DataFrame:
    """Adds an ML vector column scaled to length 1 as an array; zero vectors stay zero."""
    scaled = Normalizer(p=2.0, inputCol=source, outputCol="_scaled").transform(df)
    return scaled.withColumn(out, vector_to_array("_scaled", dtype)).drop("_scaled")


def embed(
    df: DataFrame,
    text: str = "document",
    vector: str = "embedding",
    dims: int = 64,
    encoder: Callable[[], Callable[[list[str]], np.ndarray]] | None = None,
    batch_size: int = 64,
) -> DataFrame:
    """Adds a vector per text.

    Without an encoder: hashed word counts scaled to length 1, counted row by row
    (no shuffle, no Python). It matches words, not meaning. With one: ``encoder()``
    is called once per Python worker and returns a function from a list of texts to
    a matrix; texts go to it in batches of ``batch_size``.
    """
    if encoder is None:
        counter = CountVectorizerModel.from_vocabulary(
            [str(i) for i in range(dims)], inputCol="_buckets", outputCol="_counts"
        )
        counted = counter.transform(
            df.withColumn("_buckets", term_buckets(F.coalesce(text, F.lit("")), dims))
        )
        return _unit_length(counted, "_counts", vector, "float32").drop("_buckets", "_counts")

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        run = encoder()
        for texts in batches:
            values = texts.fillna("").tolist()
            parts = [
                np.asarray(run(values[i : i + batch_size]), dtype="float32")
                for i in range(0, len(values), batch_size)
            ]
            yield pd.Series([row for part in parts for row in part])

    return df.withColumn(vector, encode(F.col(text)))


def item_rows(
    df: DataFrame,
    key: str = "nct_id",
    text: str = "document",
    vector: str = "embedding",
    title_chars: int | None = 200,
    conditions_chars: int | None = 200,
    sponsor_chars: int | None = 100,
) -> DataFrame:
    """(id, embedding, document, metadata) rows as the vector collection stores them."""
    return df.select(
        F.col(key).alias("id"),
        F.col(vector).alias("embedding"),
        F.col(text).alias("document"),
        F.struct(
            clipped(key, None).alias("nct_id"),
            clipped("brief_title", title_chars).alias("brief_title"),
            clipped("overall_status", None).alias("overall_status"),
            clipped("phase", None).alias("phase"),
            clipped("conditions", conditions_chars).alias("conditions"),
            clipped("lead_sponsor", sponsor_chars).alias("lead_sponsor"),
            F.coalesce(F.col("enrollment_count"), F.lit(0)).cast("int").alias("enrollment_count"),
            F.coalesce(F.col("is_recruiting"), F.lit(False)).alias("is_recruiting"),
        ).alias("metadata"),
    )


def collection_info(items: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row: vectors, smallest and largest dimension (equal when uniform)."""
    return items.agg(
        F.count(F.lit(1)).alias("collection_size"),
        F.min(F.size(vector)).alias("min_dims"),
        F.max(F.size(vector)).alias("max_dims"),
    )


# -- scoring inside a task ------------------------------------------------------------


class _Block(NamedTuple):
    """Queries of one block: ids, unit vectors and, for bucket search, bucket numbers."""

    ids: np.ndarray
    unit: np.ndarray
    buckets: np.ndarray | None = None


def _matrix(column, dtype: str = "float64") -> np.ndarray:
    """List column (no NULL rows) to a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    n = len(column)
    if n == 0:
        return values.reshape(0, 0)
    width = len(values) // n
    if width * n != len(values) or not bool(
        np.all(column.value_lengths().to_numpy(zero_copy_only=False) == width)
    ):
        raise ValueError("vectors of different lengths in one collection")
    return values.reshape(n, width)


def _unit_rows(m: np.ndarray) -> np.ndarray:
    norm = np.sqrt((m * m).sum(axis=1))
    return np.divide(m, norm[:, None], out=np.zeros_like(m), where=norm[:, None] > 0)


def _block_of(table: pa.Table, with_buckets: bool = False) -> _Block:
    table = _complete(table, "query_id")
    buckets = None
    if with_buckets:
        buckets = _matrix(table.column("buckets"), "int64")
    return _Block(
        table.column("query_id").to_numpy(),
        _unit_rows(_matrix(table.column("embedding"))),
        buckets,
    )


class _Best:
    """The k best (query, id) seen so far, as flat arrays, and rows not yet compared."""

    PENDING = 50_000

    def __init__(self, k: int, by_arrival: bool = False) -> None:
        """``by_arrival``: the ids of a query come in ascending order, so none are compared."""
        self.k, self.by_arrival = k, by_arrival
        self.q = np.empty(0, dtype="int64")
        self.score = np.empty(0)
        self.id = np.empty(0, dtype=object)
        self._pending: list[tuple] = []
        self._waiting = 0

    def add(self, q: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self._pending.append((q, score, ids))
        self._waiting += len(q)
        if self._waiting > max(self.PENDING, len(self.q)):
            self.compact()

    def compact(self) -> None:
        """Compares the waiting rows with the kept ones."""
        if not self._pending:
            return
        parts = [(self.q, self.score, self.id), *self._pending] if len(self.q) else self._pending
        q, score, ids = (np.concatenate(column) for column in zip(*parts))
        self._pending, self._waiting = [], 0
        if self.by_arrival:
            order = np.lexsort((-score, q))
        else:
            order = np.argsort(ids, kind="stable")
            order = order[np.lexsort((-score[order], q[order]))]
        q, score, ids = q[order], score[order], ids[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        keep = place < self.k
        self.q, self.score, self.id = q[keep], score[keep], ids[keep]

    def floors(self, queries: int) -> np.ndarray:
        """The k-th best score of each query so far, -inf where there are fewer."""
        self.compact()
        out = np.full(queries, -np.inf)
        place = np.arange(len(self.q)) - np.searchsorted(self.q, self.q)
        last = place == self.k - 1
        out[self.q[last]] = self.score[last]
        return out

    def add_scores(self, scores: np.ndarray, ids: np.ndarray, q_of_row: np.ndarray | None = None) -> None:
        """Scores as (query x vector), -inf where a pair does not count.

        Keeps what can still be among the best.
        """
        n = scores.shape[1]
        wanted = scores > -np.inf
        if n > self.k:
            floor = np.partition(scores, n - self.k, axis=1)[:, n - self.k]
            wanted &= scores >= floor[:, None]
        q, v = np.nonzero(wanted)
        self.add(q if q_of_row is None else q_of_row[q], scores[q, v], ids[v])

    def rows(self, block: _Block, id_type: pa.DataType, query_type: pa.DataType) -> pa.Table:
        self.compact()
        return pa.table(
            {
                "query_id": pa.array(block.ids, type=query_type).take(pa.array(self.q)),
                "id": pa.array(self.id, type=id_type),
                "cosine": pa.array(self.score, type=pa.float64()),
            }
        )


def _score_all(best: _Best, block: _Block, unit: np.ndarray, ids: np.ndarray) -> None:
    """Every query with every item: first in single precision, by tiles; only pairs that can
    still be among the best, whatever the rounding of that, are scored in full."""
    finite = np.isfinite(unit).all(axis=1)
    if not finite.all():
        unit, ids = unit[finite], ids[finite]
    # in the order of the ids, their places stand for them
    order = np.argsort(ids, kind="stable")
    unit, ids = unit[order], ids[order]
    rough_q, rough_i = block.unit.astype(np.float32), unit.astype(np.float32)
    # of vectors of length 1: what a sum of so many products in single precision can be off
    slack = (unit.shape[1] + 4) * 2.0**-23 + SCORE_SLACK
    kept, known, refresh = _Best(best.k, by_arrival=True), best.floors(len(rough_q)), 1
    least = (known - slack).astype(np.float32)
    # used again by every tile: fresh memory would take as long as the products
    space, marks = np.empty(TILE_QUERIES * TILE_ITEMS, np.float32), np.empty(TILE_QUERIES * TILE_ITEMS, bool)
    for tile_no, i in enumerate(range(0, len(ids), TILE_ITEMS), 1):
        items = rough_i[i : i + TILE_ITEMS].T
        n = items.shape[1]
        for j in range(0, len(rough_q), TILE_QUERIES):
            asked = rough_q[j : j + TILE_QUERIES]
            tile = np.matmul(asked, items, out=space[: len(asked) * n].reshape(len(asked), n))
            bar = least[j : j + TILE_QUERIES]
            fresh = np.flatnonzero(bar == -np.inf)
            if len(fresh) and n > best.k:
                bar = bar.copy()
                bar[fresh] = np.partition(tile[fresh], n - best.k, axis=1)[:, n - best.k] - 2 * slack
            open_ = np.greater_equal(tile, bar[:, None], out=marks[: tile.size].reshape(tile.shape))
            q, v = np.divmod(np.flatnonzero(open_), n)
            q, v = q + j, v + i
            for at in range(0, len(q), EXACT_PAIRS):
                some, those = q[at : at + EXACT_PAIRS], v[at : at + EXACT_PAIRS]
                kept.add(some, np.round(np.einsum("ij,ij->i", block.unit[some], unit[those]), PLACES) + 0.0, those)
        # what is seen doubles between these
        if tile_no == refresh:
            least = (np.maximum(known, kept.floors(len(rough_q))) - slack).astype(np.float32)
            refresh *= 2
    kept.compact()
    if len(kept.q):
        best.add(kept.q, kept.score, ids[kept.id])


def _score_bucket(
    best: _Best,
    block: _Block,
    qs: np.ndarray,
    unit: np.ndarray,
    buckets: np.ndarray,
    ids: np.ndarray,
    table_no: int,
) -> None:
    """Items and queries of one bucket; pairs that met in an earlier table are skipped."""
    step = max(1, SCORE_CELLS // max(1, len(qs)))
    for i in range(0, len(ids), step):
        scores = np.round(block.unit[qs] @ unit[i : i + step].T, PLACES) + 0.0
        mine, theirs = block.buckets[qs][:, None, :table_no], buckets[i : i + step][None, :, :table_no]
        scores[(mine == theirs).any(axis=2)] = -np.inf
        best.add_scores(scores, ids[i : i + step], qs)


def _hit_schema(queries: DataFrame, items: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("id", items.schema["id"].dataType),
            T.StructField("cosine", T.DoubleType()),
        ]
    )


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.col("cosine").desc(), F.col("id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _vectors(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    return df.select(F.col(key).alias(name), F.col(vector).alias("embedding"))


def _complete(rows, name: str = "id"):
    """Rows with an id and a vector. Tested here and not by a filter in the query, for
    which Spark would compute a vector that is not stored a second time."""
    return rows.filter(pc.and_(pc.is_valid(rows.column(name)), pc.is_valid(rows.column("embedding"))))


# -- exact search ---------------------------------------------------------------------


def top_k(
    queries: DataFrame,
    items: DataFrame,
    k: int = 10,
    query_id: str = "query_id",
    item_id: str = "id",
    vector: str = "embedding",
    block_queries: int = BLOCK_QUERIES,
    chunk_vectors: int | None = None,
) -> DataFrame:
    """(query_id, id, cosine, rank): the exact k nearest items of every query.

    Up to ``block_queries`` queries are sent to the tasks as one block, and the items
    stay where they are. More queries than that never pass through the driver: both
    sides are cut into bounded pieces that meet pairwise in a cogroup. Scoring a pair
    of pieces takes far longer than shipping it, so the copies made for that do not
    decide the run time. ``chunk_vectors`` bounds both sides' pieces with ``block_queries``;
    by default a piece holds as many vectors as its memory allows for their length.
    """
    queries = _vectors(queries, query_id, vector, "query_id")
    items = _vectors(items, item_id, vector, "id")
    head = queries.limit(block_queries + 1).toArrow()
    if head.num_rows <= block_queries:
        hits = _scan_with_block(queries, items, head, k)
    else:
        larger = _piece_sizes(head, block_queries) if chunk_vectors is None else None
        hits = _blocked(queries, items, k, block_queries, chunk_vectors or CHUNK_VECTORS, larger)
    return _ranked(hits, k)


def _piece_sizes(head: pa.Table, block_queries: int) -> tuple[int, int]:
    """Queries and items a piece may hold, by the length of their vectors."""
    width = max(1, pc.max(pc.list_value_length(head.column("embedding"))).as_py() or 1)
    return max(block_queries, BLOCK_CELLS // width), max(CHUNK_VECTORS, CHUNK_CELLS // width)


def _scan_with_block(queries: DataFrame, items: DataFrame, head: pa.Table, k: int) -> DataFrame:
    schema = _hit_schema(queries, items)
    shared = queries.sparkSession.sparkContext.broadcast(tuple(_block_of(head)))
    query_type = head.schema.field("query_id").type

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, best, id_type = _Block(*shared.value), _Best(k), None

        def score(waiting: list[pa.RecordBatch]) -> None:
            rows = _complete(pa.Table.from_batches(waiting))
            if rows.num_rows and len(block.ids):
                _score_all(best, block, _unit_rows(_matrix(rows.column("embedding"))), rows.column("id").to_numpy())

        waiting, places = [], 0
        for batch in batches:
            id_type = batch.schema.field("id").type
            waiting.append(batch)
            places += len(batch.column("embedding").flatten())
            if places > SCORE_CELLS:
                score(waiting)
                waiting, places = [], 0
        if waiting:
            score(waiting)
        if id_type is not None:
            yield from best.rows(block, id_type, query_type).to_batches()

    return items.mapInArrow(scan, schema)


def _blocked(
    queries: DataFrame, items: DataFrame, k: int, block_queries: int, chunk_vectors: int, larger: tuple[int, int] | None = None
) -> DataFrame:
    schema = _hit_schema(queries, items)
    # hashed pieces vary in size, so aim at half of what a piece may hold
    asked, stored = queries.count(), items.count()

    def pieces(block: int, chunk: int) -> tuple[int, int]:
        return max(1, -(-2 * asked // block)), max(1, -(-2 * stored // chunk))

    blocks, chunks = pieces(block_queries, chunk_vectors)
    if larger is not None:
        few = pieces(*larger)
        if few[0] * few[1] >= GROUPS_A_CORE * queries.sparkSession.sparkContext.defaultParallelism:
            blocks, chunks = few

    def spread(df: DataFrame, own: str, own_n: int, key: str, other: str, other_n: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64(key), F.lit(own_n)).cast("int")).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_n - 1)))
        )

    # rows without an id can't be hits; they would all fall in one piece
    left = spread(items.dropna(subset=["id"]), "_chunk", chunks, "id", "_block", blocks)
    right = spread(queries.dropna(subset=["query_id"]), "_block", blocks, "query_id", "_chunk", chunks)

    def score(chunk: pa.Table, block_table: pa.Table) -> pa.Table:
        chunk, block, best = _complete(chunk), _block_of(block_table), _Best(k)
        if chunk.num_rows and len(block.ids):
            _score_all(
                best, block, _unit_rows(_matrix(chunk.column("embedding"))), chunk.column("id").to_numpy()
            )
        return best.rows(
            block, chunk.schema.field("id").type, block_table.schema.field("query_id").type
        )

    return (
        left.groupBy("_chunk", "_block")
        .cogroup(right.groupBy("_chunk", "_block"))
        .applyInArrow(score, schema)
    )


# -- bucket search --------------------------------------------------------------------


@dataclass(frozen=True)
class BucketHash:
    """Random-projection hash functions; vectors close in angle tend to share buckets."""

    model: object
    tables: int
    width: int

    def buckets(self, df: DataFrame, vector: str = "embedding") -> DataFrame:
        """Adds ``buckets``: one bucket number per table, for the unit vectors."""
        plain = df.withColumn("_plain", array_to_vector(F.col(vector).cast("array<double>")))
        unit = Normalizer(p=2.0, inputCol="_plain", outputCol="_unit").transform(plain)
        hashed = self.model.transform(unit)
        parts = [vector_to_array(F.col("_hashes")[i])[0].cast("bigint") for i in range(self.tables * self.width)]
        numbers = [
            F.xxhash64(*parts[t * self.width : (t + 1) * self.width]) for t in range(self.tables)
        ]
        return hashed.withColumn("buckets", F.array(*numbers)).drop(
            "_plain", "_unit", "_hashes"
        )


def bucket_hash(
    items: DataFrame,
    vector: str = "embedding",
    tables: int = 8,
    width: int = 2,
    bucket_length: float | None = None,
    seed: int = 17,
) -> BucketHash:
    """Hash functions for the items' dimension; of the data one row is read.

    A bucket of a table is a cell of ``width`` random projections: more width makes
    smaller buckets (take more for larger collections, whose nearest vectors are
    nearer), more tables find more of the neighbours. The default length is two standard
    deviations of a projected unit vector.
    """
    one = items.filter(F.col(vector).isNotNull()).limit(1)
    one = written(one.select(F.col(vector).cast("array<double>").alias("_v")), "one-vector")
    if bucket_length is None:
        first = one.first()
        bucket_length = 2.0 / (len(first["_v"]) ** 0.5 if first else 1.0)
    lsh = BucketedRandomProjectionLSH(
        inputCol="_unit",
        outputCol="_hashes",
        bucketLength=bucket_length,
        numHashTables=tables * width,
        seed=seed,
    )
    return BucketHash(lsh.fit(one.select(array_to_vector("_v").alias("_unit"))), tables, width)


SHARDS = 64


def bucket_index(
    items: DataFrame, hashes: BucketHash, item_id: str = "id", vector: str = "embedding"
) -> DataFrame:
    """Items once per table, with the bucket they fall in.

    Write it partitioned by (table_no, shard): a search then reads only the shards its
    queries fall in. A bucket with very many items is just many rows of one shard,
    which Spark reads in as many tasks as its files need.
    """
    hashed = hashes.buckets(_vectors(items, item_id, vector, "id").dropna())
    # the outer form: Spark does not compute the buckets once more to test for emptiness
    return hashed.select(
        "id", "embedding", "buckets", F.posexplode_outer("buckets").alias("table_no", "bucket")
    ).withColumn("shard", F.pmod("bucket", F.lit(SHARDS)).cast("int"))


SHARD_FILE_ROWS = 1_000_000


def write_bucket_index(index: DataFrame, path: str, rows: int | None = None) -> None:
    """One file per shard, more of them for every million rows that a shard holds on average.

    ``rows``: the number of index rows, counted if not given.
    """
    if rows is None:
        rows = index.select("id").count()
    files = max(1, -(-rows // (SHARDS * SHARD_FILE_ROWS)))
    part = F.pmod(F.xxhash64("id"), F.lit(files))
    dealt = index.repartition("table_no", "shard", part)
    dealt.write.mode("overwrite").partitionBy("table_no", "shard").parquet(path)


def bucket_top_k(
    queries: DataFrame,
    index: DataFrame,
    hashes: BucketHash,
    k: int = 10,
    query_id: str = "query_id",
    vector: str = "embedding",
    block_queries: int = BLOCK_QUERIES,
    chunk_vectors: int = CHUNK_VECTORS,
) -> DataFrame:
    """(query_id, id, cosine, rank) among items sharing a bucket with the query.

    A pair sharing several buckets is scored in the first of them only, so nothing
    has to be made distinct afterwards. A query may get fewer than k hits here.
    """
    queries = hashes.buckets(_vectors(queries, query_id, vector, "query_id").dropna())
    head = queries.limit(block_queries + 1).toArrow()
    if head.num_rows <= block_queries:
        return _ranked(_scan_buckets(queries, index, head, k), k)
    return _ranked(_blocked_buckets(queries, index, k, block_queries, chunk_vectors), k)


def _blocked_buckets(
    queries: DataFrame, index: DataFrame, k: int, block_queries: int, chunk_vectors: int
) -> DataFrame:
    """Every bucket in bounded pieces; a bucket with very many items gets more of them."""
    schema = _hit_schema(queries, index)
    place = ["table_no", "bucket"]
    queries = queries.select("*", F.posexplode("buckets").alias(*place))
    index = index.select("id", "embedding", "buckets", *place)
    sizes = index.groupBy(place).agg(F.count(F.lit(1)).alias("_items")).join(
        queries.groupBy(place).agg(F.count(F.lit(1)).alias("_queries")), place
    )
    # hashed pieces vary in size, so aim at half of what a piece may hold
    pieces = written(
        sizes.select(
            *place,
            F.ceil(F.col("_items") * 2 / chunk_vectors).cast("int").alias("_chunks"),
            F.ceil(F.col("_queries") * 2 / block_queries).cast("int").alias("_blocks"),
        ),
        "bucket-pieces",
    )
    if fits_broadcast(pieces):
        pieces = F.broadcast(pieces)

    def spread(df: DataFrame, key: str, own: str, own_n: str, other: str, other_n: str) -> DataFrame:
        return (
            df.join(pieces, place)
            .withColumn(own, F.pmod(F.xxhash64(key), F.col(own_n)).cast("int"))
            .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other_n) - 1)))
            .drop(own_n, other_n)
        )

    def score(chunk: pa.Table, block_table: pa.Table) -> pa.Table:
        best = _Best(k)
        id_type, query_type = chunk.schema.field("id").type, block_table.schema.field("query_id").type
        block = _block_of(block_table, with_buckets=block_table.num_rows > 0)
        if chunk.num_rows and len(block.ids):
            _score_bucket(
                best,
                block,
                np.arange(len(block.ids)),
                _unit_rows(_matrix(chunk.column("embedding"))),
                _matrix(chunk.column("buckets"), "int64"),
                chunk.column("id").to_numpy(),
                chunk.column("table_no")[0].as_py(),
            )
        return best.rows(block, id_type, query_type)

    keys = [*place, "_chunk", "_block"]
    return (
        spread(index, "id", "_chunk", "_chunks", "_block", "_blocks")
        .groupBy(keys)
        .cogroup(spread(queries, "query_id", "_block", "_blocks", "_chunk", "_chunks").groupBy(keys))
        .applyInArrow(score, schema)
    )


def _scan_buckets(queries: DataFrame, index: DataFrame, head: pa.Table, k: int) -> DataFrame:
    schema = _hit_schema(queries, index)
    block = _block_of(head, with_buckets=head.num_rows > 0)
    wanted: dict[tuple[int, int], list[int]] = {}
    if block.buckets is not None:
        for q, row in enumerate(block.buckets):
            for t, b in enumerate(row):
                wanted.setdefault((t, int(b)), []).append(q)
    shared = queries.sparkSession.sparkContext.broadcast(
        (tuple(block), {key: np.array(qs) for key, qs in wanted.items()})
    )
    query_type = head.schema.field("query_id").type

    # at most block_queries x tables rows, and only their shards are read
    keys = (
        queries.select(F.posexplode("buckets").alias("table_no", "bucket"))
        .withColumn("shard", F.pmod("bucket", F.lit(SHARDS)).cast("int"))
        .distinct()
    )
    candidates = index.join(F.broadcast(keys), ["table_no", "shard", "bucket"], "left_semi").select(
        "id", "embedding", "buckets", "table_no"
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (parts, wanted), best, id_type = shared.value, _Best(k), None
        block = _Block(*parts)
        for batch in batches:
            id_type = batch.schema.field("id").type
            batch = _complete(batch)
            if not batch.num_rows:
                continue
            unit = _unit_rows(_matrix(batch.column("embedding")))
            buckets = _matrix(batch.column("buckets"), "int64")
            table_no = batch.column("table_no").to_numpy()
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            own = np.take_along_axis(buckets, table_no[:, None].astype("int64"), axis=1)[:, 0]
            # sorted by cell once, so a cell's rows are a slice however many cells there are
            order = np.lexsort((own, table_no))
            cells = np.stack([table_no[order], own[order]], axis=1)
            starts = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]).any(1)])
            for start, end in zip(starts, [*starts[1:], len(order)]):
                t, b = cells[start]
                qs = wanted.get((int(t), int(b)))
                if qs is None:
                    continue
                rows = order[start:end]
                _score_bucket(best, block, qs, unit[rows], buckets[rows], ids[rows], int(t))
        if id_type is not None:
            yield from best.rows(block, id_type, query_type).to_batches()

    return candidates.mapInArrow(scan, schema)


def approx_top_k(
    queries: DataFrame,
    items: DataFrame,
    k: int = 10,
    query_id: str = "query_id",
    item_id: str = "id",
    vector: str = "embedding",
    tables: int = 8,
    width: int = 2,
    bucket_length: float | None = None,
    seed: int = 17,
    index: DataFrame | None = None,
    hashes: BucketHash | None = None,
) -> DataFrame:
    """Bucket search; queries left with fewer than k hits are answered exactly.

    Give a stored ``index`` with its ``hashes`` to search without hashing the items.
    """
    if hashes is None:
        hashes = bucket_hash(items, vector, tables, width, bucket_length, seed)
    if index is None:
        index = bucket_index(items, hashes, item_id, vector)
    found = written(bucket_top_k(queries, index, hashes, k, query_id, vector), "bucket-hits")
    # fewer than k: too few items share a bucket with the query
    counts = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"))
    full = counts.filter(F.col("_n") >= k).select("query_id")
    short = queries.withColumnRenamed(query_id, "query_id").join(full, "query_id", "left_anti")
    exact = top_k(short, items, k, "query_id", item_id, vector)
    return found.join(full, "query_id", "left_semi").unionByName(exact)


def recall(approximate: DataFrame, exact: DataFrame) -> DataFrame:
    """Per query: share of the exact hits that the approximate search found."""
    both = exact.select("query_id", "id").join(
        approximate.select("query_id", "id", F.lit(1).alias("_found")), ["query_id", "id"], "left"
    )
    return both.groupBy("query_id").agg(F.avg(F.coalesce("_found", F.lit(0))).alias("recall"))


def compare_hits(keyword: DataFrame, semantic: DataFrame, key: str = "nct_id") -> DataFrame:
    """Two result lists side by side: in both, keyword only or semantic only."""
    left = keyword.select(F.col(key).alias("_k")).withColumn("_in_k", F.lit(True))
    right = semantic.select(F.col(key).alias("_s"), "rank").withColumn("_in_s", F.lit(True))
    return left.join(right, F.col("_k") == F.col("_s"), "full_outer").select(
        F.coalesce("_k", "_s").alias(key),
        F.when(F.col("_in_k") & F.col("_in_s"), "both")
        .when(F.col("_in_k"), "keyword_only")
        .otherwise("semantic_only")
        .alias("found_by"),
        F.col("rank").alias("semantic_rank"),
    )


def reembed_changed(
    items: DataFrame,
    feed: DataFrame,
    key: str = "nct_id",
    summary_chars: int | None = None,
    dims: int = 64,
    encoder: Callable[[], Callable[[list[str]], np.ndarray]] | None = None,
) -> DataFrame:
    """The collection after a merge: changed records embedded anew, the rest kept.

    Only the change feed is embedded. A changed record that no longer has a text
    leaves the collection.
    """
    current = feed.filter(F.col("_change_type").isin("insert", "update_postimage"))
    fresh = item_rows(embed(corpus_texts(current, key, summary_chars=summary_chars), dims=dims, encoder=encoder), key)
    gone = current.select(F.col(key).alias("id"))
    if fits_broadcast(gone):
        gone = F.broadcast(gone)
    return items.join(gone, "id", "left_anti").unionByName(fresh)
