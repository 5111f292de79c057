"""Exact top-k by inner product, from sorted lists read in order only.

Candidates are taken in blocks. A block has a list for every dimension, sorted by that
component; a query with a positive weight reads it from its upper end, one with a negative
weight from its lower end (no random access). Every query takes the lists by |its component| x
the list's spread, ``LISTS`` of them at a step: the new ones are read to half their depth,
those of the step before to their ends. Many queries go on together, as products of matrices,
until most candidates are out; the next ones read as many lists before they ask for bounds.
After each such step every candidate has

* an upper bound: the sum of what is read of it, of the reading position where it is not yet
  met, of the far best end of unread lists; or, if that is less, the exact part and the
  product of the lengths of what is left of the query and of the candidate;
* a lower bound in the same way, from the lists' worst ends.

The k-th largest lower bound, or the k-th score from earlier blocks, is the score to reach.
Candidates whose upper bounds don't reach it are out; a query stops in a block as soon as few
are left (``FEW`` times k), and only for those the rest is resolved to final scores. ``Reader``
counts the entries read and those there are.

Rows are dealt by (query block, candidate group): a task holds one query block and one
candidate block at a time, however large its group is, and gives k rows per query. The k
best of all groups are a window rank. Nothing is broadcast or gathered.

Defined results: rows with a null id take no part, nor do null or empty vectors or such
with null components, or components of ``MOST_COMPONENT`` in size or more, whose products would
not fit a score; vectors of different lengths are not compared; a candidate of the
query's own id is left out; rows of the same id each count; ties go to the smaller id; an
empty table gives no rows; other columns are not used. Sums of products from 2**53 on are
taken in whole numbers of any size, without bounds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import wordscan as ws
from ledgerloom.llm.tables import table

QUERY_ROWS = 1024
BLOCK_ROWS = 2048
LISTS = 8
FEW = 4
# Queries that go on together, as products of matrices, until a step leaves each ALONE candidates of a
# block; the next ones read as many lists before they ask, a step less if it left under ALONE_EARLY.
TOGETHER = 64
ALONE, ALONE_EARLY = 400, 40
MOST_COMPONENT = 1 << 27
_FOUND = "query_id long, found_id long, score long"


class Block:
    """Candidates by rows and by lists, and the lists as far as they are read to half their depth."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        n = len(rows)
        self.ids, self.rows, self.columns = ids, rows, np.ascontiguousarray(rows.T)
        in_order = np.sort(self.columns, axis=1)
        self.low, self.high = in_order[:, 0], in_order[:, -1]
        self.middle = in_order[:, (n - 1) // 2], in_order[:, n - 1 - (n - 1) // 2]
        self.squares = self.columns * self.columns
        # from the upper end for positive weights, from the lower for negative ones: what is not
        # met stands for the reading position, or for the worst end
        lower_half, upper_half = (x[:, None] for x in self.middle)
        top, bottom = self.columns >= upper_half, self.columns <= lower_half
        self.tops = np.maximum(self.columns, upper_half), np.where(top, self.columns, self.low[:, None])
        self.bottoms = np.minimum(self.columns, lower_half), np.where(bottom, self.columns, self.high[:, None])
        self.met = top.sum(1), bottom.sum(1)


class Reader:
    """The k best candidates so far of one block of queries.

    ``straight``: the steps that are read before the bounds are first asked.
    """

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, lists: int = LISTS):
        self.ids, self.queries, self.k, self.lists = ids, queries, k, lists
        self.best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in ids]
        self.least = np.full(len(ids), -np.inf)
        self.entries = self.entries_read = self.straight = 0

    def _keep(self, q: int, ids: np.ndarray, scores: np.ndarray) -> None:
        found, scores = np.r_[self.best[q][0], ids], np.r_[self.best[q][1], scores.astype(np.int64)]
        order = np.lexsort((found, -scores))[: self.k]
        self.best[q] = found[order], scores[order]
        if len(order) == self.k:
            self.least[q] = scores[order[-1]]

    def read(self, ids: np.ndarray, candidates: np.ndarray) -> None:
        n, dims = candidates.shape
        whole = np.abs(self.queries).max(initial=0) * np.abs(candidates).max(initial=0) * dims < 1 << 53
        if not whole or n <= FEW * self.k:
            for q, (own, query) in enumerate(zip(self.ids, self.queries)):
                mine = ids != own  # rows of the query's own id, however many, take no part
                scores = candidates[mine] @ query if whole else candidates[mine].astype(np.int64).astype(object) @ query.astype(np.int64).astype(object)
                self._keep(q, ids[mine], scores.astype(np.int64))
            self.entries += len(self.ids) * n * dims
            self.entries_read += len(self.ids) * n * dims
            return
        block = Block(ids, candidates)
        for a in range(0, len(self.ids), TOGETHER):
            self._read_together(block, a, min(len(self.ids), a + TOGETHER))

    def _read_together(self, block: Block, a: int, b: int) -> None:
        """The queries from ``a`` to ``b`` together until few candidates are open, then one by one."""
        own, queries, n, dims = self.ids[a:b], self.queries[a:b], *block.rows.shape
        # the best and the worst entry of each list
        ends = queries * block.high, queries * block.low
        order = np.argsort(-np.abs(queries) * (block.high - block.low), axis=1, kind="stable")
        rest_best, rest_worst, rest_square = (
            np.pad(np.cumsum(np.take_along_axis(x, order, 1)[:, ::-1], axis=1)[:, ::-1], ((0, 0), (0, 1))) for x in (np.maximum(*ends), np.minimum(*ends), queries**2)
        )
        rest_length = np.sqrt(rest_square)
        place = np.argsort(order, axis=1, kind="stable")
        mine = block.ids != own[:, None]  # rows of the query's own id, however many, take no part
        # whole steps whose bounds left much open to the queries before are read without asking
        last = (dims - 1) // self.lists
        self.straight = max(0, min(self.straight, last))
        while True:
            done, after = self.straight * self.lists, min(dims, (self.straight + 1) * self.lists)
            is_read, is_new = (place < done).astype(np.float64), (place >= done) & (place < after)
            exact = (queries * is_read) @ block.columns
            left = block.squares.sum(0) - is_read @ block.squares
            up, down = np.maximum(queries * is_new, 0), np.minimum(queries * is_new, 0)
            # not met in the upper half: at most the reading position, at least the worst end
            upper = up @ block.tops[0] + down @ block.bottoms[0] + rest_best[:, after, None]
            lower = up @ block.tops[1] + down @ block.bottoms[1] + rest_worst[:, after, None]
            length = rest_length[:, done, None] * np.sqrt(np.maximum(left, 0)) * (1 + 1e-9) + 1e-6
            upper, lower = exact + np.minimum(upper, length), exact + np.maximum(lower, -length)
            lower[~mine] = -np.inf
            reach = np.maximum(self.least[a:b], np.partition(lower, n - self.k, axis=1)[:, n - self.k])
            open_ = (upper >= reach[:, None]) & mine
            each = open_.sum() / len(queries)
            if each <= ALONE or self.straight == last:
                break
            self.straight += 1
        self.straight -= int(each < ALONE_EARLY)
        self.entries += len(queries) * n * dims
        self.entries_read += int(mine.sum()) * done + int((is_new * np.where(queries < 0, block.met[1], block.met[0])).sum())
        for i in range(len(queries)):
            rows = np.flatnonzero(open_[i])
            query, row_exact, row_left, at = queries[i], exact[i, rows], left[i, rows], done
            rests = rest_best[i], rest_worst[i], rest_length[i]
            if len(rows) > FEW * self.k:
                # to the lists' ends; only candidates that are still open are looked at
                now = order[i, done:after]
                part = block.rows[np.ix_(rows, now)]
                self.entries_read += int((np.where(query[now] < 0, part > block.middle[0][now], part < block.middle[1][now])).sum())
                row_exact, row_left, at = row_exact + part @ query[now], row_left - (part * part).sum(1), after
            rows, row_exact, at = self._narrow(block, a + i, order[i], rests, rows, row_exact, row_left, at)
            rest = order[i, at:]
            if len(rest) and len(rows):
                row_exact = row_exact + block.rows[np.ix_(rows, rest)] @ query[rest]
                self.entries_read += len(rest) * len(rows)
            if len(rows):
                self._keep(a + i, block.ids[rows], row_exact)

    def _narrow(self, block: Block, q: int, order: np.ndarray, rests, rows: np.ndarray, exact: np.ndarray, left: np.ndarray, done: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Step by step the lists of one query from ``done`` on, for candidates that are open."""
        query, dims, (rest_best, rest_worst, rest_length) = self.queries[q], len(order), rests
        while len(rows) > FEW * self.k and done < dims:
            now = order[done : done + self.lists]
            values = block.rows[np.ix_(rows, now)]
            part = values * query[now]
            half = np.where(query[now] > 0, query[now] * block.middle[1][now], query[now] * block.middle[0][now])
            worst = np.minimum(query[now] * block.high[now], query[now] * block.low[now])
            met = part >= half
            self.entries_read += int(met.sum())
            after = min(dims, done + self.lists)
            upper = np.where(met, part, half).sum(1) + rest_best[after]
            lower = np.where(met, part, worst).sum(1) + rest_worst[after]
            length = rest_length[done] * np.sqrt(np.maximum(left, 0)) * (1 + 1e-9) + 1e-6
            upper, lower = exact + np.minimum(upper, length), exact + np.maximum(lower, -length)
            reach = max(self.least[q], np.partition(lower, len(lower) - self.k)[len(lower) - self.k])
            open_ = upper >= reach
            rows, exact, left, values, part, met = rows[open_], exact[open_], left[open_], values[open_], part[open_], met[open_]
            if len(rows) > FEW * self.k:
                self.entries_read += int((~met).sum())
                exact, left, done = exact + part.sum(1), left - (values * values).sum(1), after
        return rows, exact, done

    def found(self) -> pa.RecordBatch:
        counts = [len(ids) for ids, _ in self.best]
        ids = np.concatenate([ids for ids, _ in self.best])
        scores = np.concatenate([s for _, s in self.best])
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.ids, counts)), pa.array(ids), pa.array(scores)], names=["query_id", "found_id", "score"])


def _search(k: int, lists: int):
    """Rows come ordered by (dims, query block, group), queries before candidates."""

    @ws.released
    def search(batches):
        key, queries, reader, held, size = None, [], None, [], 0

        def read_held():
            nonlocal reader, held, size
            if not queries or not held:
                return
            if reader is None:
                reader = Reader(np.concatenate([q[0] for q in queries]), np.vstack([q[1] for q in queries]), k, lists)
            ids, rows = np.concatenate([h[0] for h in held]), np.vstack([h[1] for h in held])
            for a in range(0, len(ids), BLOCK_ROWS):
                reader.read(ids[a : a + BLOCK_ROWS], rows[a : a + BLOCK_ROWS])
            held, size = [], 0

        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
            cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1)]) if len(keys) else []
            for a, b in zip(cuts, [*cuts[1:], len(keys)]):
                if key != tuple(keys[a, :3]):
                    read_held()
                    if reader is not None:
                        yield reader.found()
                    key, queries, reader, held, size = tuple(keys[a, :3]), [], None, [], 0
                part = batch.slice(a, b - a)
                rows = part.column(5).flatten().to_numpy().reshape(b - a, int(keys[a, 0])).astype(np.float64)
                into = queries if keys[a, 3] == 0 else held
                into.append((part.column(4).to_numpy(), rows))
                if into is held:
                    size += b - a
                    if size >= BLOCK_ROWS:
                        read_held()
        read_held()
        if reader is not None:
            yield reader.found()

    return search


def exact_topk(candidates: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "vector", lists: int = LISTS) -> DataFrame:
    """Each query's ``k`` highest inner products: query_id, rank, ``id_col``, score.

    Both frames hold ``id_col`` and ``vector_col``, an array of whole numbers below
    ``MOST_COMPONENT`` in size.
    """
    usable = f"`{id_col}` is not null and size(`{vector_col}`) > 0 and forall(`{vector_col}`, x -> x is not null and abs(x) < {MOST_COMPONENT})"

    def rows(df):
        return df.filter(usable).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<bigint>").alias("vector"), F.size(f"`{vector_col}`").alias("dims"))

    candidates, queries = rows(candidates), rows(queries)
    n, n_queries = candidates.count(), queries.count()
    query_blocks = max(1, -(-n_queries // QUERY_ROWS))
    # groups only as far as the query blocks leave cores idle: each adds k rows per query
    tasks = int(candidates.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    groups = max(1, min(-(-n // BLOCK_ROWS), -(-tasks // query_blocks)))
    spread = F.xxhash64("id", "vector")
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    sides = queries.select("dims", F.pmod(spread, F.lit(query_blocks)).cast("int").alias("block"), every(groups).alias("group"), F.lit(0).alias("side"), "id", "vector").union(
        candidates.select("dims", every(query_blocks).alias("block"), F.pmod(spread, F.lit(groups)).cast("int").alias("group"), F.lit(1).alias("side"), "id", "vector")
    )
    dealt = sides.repartition(max(tasks, query_blocks * groups), "dims", "block", "group").sortWithinPartitions("dims", "block", "group", "side")
    found = dealt.mapInArrow(_search(k, lists), _FOUND)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "found_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", F.col("found_id").alias(id_col), "score")


def whole_numbers(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """``vector``: floor(scale * x) of every component; null if a component is null or not
    finite, or if one would be ``MOST_COMPONENT`` in size or more."""
    x = F.col(f"`{vector_col}`")
    usable = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double") * scale) < MOST_COMPONENT - 1))
    return vectors.select(F.col(f"`{id_col}`").alias("vec_id"), F.when(usable, F.transform(x, lambda v: F.floor(v.cast("double") * scale))).alias("vector"))


def op4_exact_topk(spark, d):
    vectors = whole_numbers(table(spark, d, "embeddings"), 64, "vec_id", "embedding")
    return exact_topk(vectors, vectors.filter("vec_id % 20 = 0"), 20)


OP4_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 20
"""
