"""Removal of word windows that already occur in a document of a smaller id.

Every window of ``window`` consecutive words gets two Rabin-Karp hashes. One deals it to
a bucket, the other is counted there. Windows are first reduced within each task's chunk
to one row per window text: what a hot passage sends to its bucket is a row a chunk, not a
row a document. A bucket finds the smallest document of each window; the windows of every
other document are its removals. The documents are then joined with their removals, their
windows hashed once more, and overlapping removals merged into maximal intervals.

Buckets grow in number with the words, so a bucket's size is bounded. Their hash and the
counted one are independent, together some 80 bits at large scale.

Defined results: a null or empty text has no words; rows of the same id form no pair of
documents, so a window that only they share stays; a null id counts as larger than all
others; columns named ``n_words``, ``n_removed`` and ``spans`` are replaced, all other
columns are kept; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import wordscan as ws
from ledgerloom.llm.tables import table, tasks_for, text_batches
from ledgerloom.session import written

CHUNK_WINDOWS = 1_000_000
BUCKET_CHARS = 12 << 20
# a bucket is sorted in pieces of about so many windows
PIECE_WINDOWS = 1 << 18
NULL_ID = (1 << 63) - 1

_DEALT = "bucket int, flagged boolean, doc_ids array<long>, counts array<int>, hashes array<long>"


def _windows_of(texts: pa.Array, window: int):
    """First row, last row, word begins, words before each text, and each text's windows."""
    for first, last, data, starts in ws.blocks(texts):
        begins, ends, before = ws.words(data, starts, ws.WHITE)
        word = ws.hashes(data, begins, ends)
        counts = np.maximum(np.diff(before) - window + 1, 0)
        places = ws.ragged(before[:-1], counts)
        yield first, last, data, starts, begins, before, counts, places, word


def _order(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Puts hashes, documents and any further columns in order of hash and document, one by one in
    place of the old ones; then which rows are the first of their hash, and which of a larger
    document than the hash's smallest without repeating the row before."""
    order = np.lexsort((columns[1], columns[0]))
    for i in range(len(columns)):
        columns[i] = columns[i][order]
    h, d = columns[:2]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    later = np.zeros(len(h), bool)
    later[1:] = ~new[1:] & (d[1:] != d[:-1])
    return new, later


def _part(docs: np.ndarray, n: int) -> np.ndarray:
    return (ws.mix(docs.astype(np.uint64)) % np.uint64(n)).astype(np.int64)


def _by_key(columns: list[np.ndarray], n: int, flagged: bool) -> pa.RecordBatch:
    """Of hashes, documents and keys, which are taken out of the list, one row per key: its
    documents, how many hashes each has there, and the hashes."""
    ids, counts, flat, per_key, per_row = ws.grouped_from(columns, n)
    some = per_key > 0
    return pa.RecordBatch.from_arrays(
        [pa.array(np.flatnonzero(some).astype(np.int32)), pa.array(np.full(some.sum(), flagged)), ws.lists(ids, per_key[some]), ws.lists(counts, per_key[some]), ws.lists(flat.view(np.int64), per_row[some])],
        names=["bucket", "flagged", "doc_ids", "counts", "hashes"],
    )


def _deal(window: int, n_buckets: int):
    """A task's windows by bucket; those already known to repeat are flagged."""

    def rows(held):
        # each column is let go as soon as the next one is made of it
        columns = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        new, later = _order(columns)
        known = [x[later] for x in columns[:2]]
        for i in range(len(columns)):
            columns[i] = columns[i][new]
        columns.append((columns.pop() % np.uint64(n_buckets)).astype(np.int32))
        yield _by_key(columns, n_buckets, flagged=False)
        if len(known[1]):
            yield _by_key([*known, _part(known[1], n_buckets)], n_buckets, flagged=True)

    @ws.released
    def deal(batches):
        held, size = [], 0
        for batch in batches:
            ids = batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            for first, last, _, _, _, before, counts, places, word in _windows_of(batch.column(1), window):
                if not len(places):
                    continue
                held.append((ws.window_hashes(word, window, 1)[places], np.repeat(ids[first:last], counts), ws.window_hashes(word, window, 2)[places]))
                size += len(places)
                del places, word
                if size >= CHUNK_WINDOWS:
                    yield from rows(held)
                    size = 0
        if held:
            yield from rows(held)

    return deal


def _row(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The hashes of a row, its documents, and how many hashes each has."""
    docs, counts, hashes = (batch.column(j)[i].values.to_numpy() for j in (2, 3, 4))
    return hashes.view(np.uint64), docs, counts


def _each_key(batches, use):
    """``use(rows)`` for each key, its rows as ``_row`` gives them, which it empties; rows come ordered by key."""
    held, current = [], None
    for batch in batches:
        for i, key in enumerate(batch.column(0).to_pylist()):
            if key != current and held:
                yield from use(held)
            current = key
            held.append(_row(batch, i))
    if held:
        yield from use(held)


def _pieces(rows: list, most: int):
    """Hashes and the document of each, by ranges of the hash, ascending, of about ``most`` each."""
    bits = np.uint64((max(1, -(-sum(len(h) for h, _, _ in rows) // most)) - 1).bit_length())
    for piece in range(1 << int(bits)):
        held = []
        for h, docs, counts in rows:
            mine = np.flatnonzero(h >> (np.uint64(64) - bits) == piece) if bits else slice(None)
            held.append((h[mine], np.repeat(docs, counts)[mine]))
        columns = [np.concatenate(x) for x in zip(*held)]
        del held
        yield columns


def _find_repeats(n_parts: int):
    """Per bucket the windows of all but the first document, dealt to parts by document."""

    def repeats(rows):
        found = []
        for columns in _pieces(rows, PIECE_WINDOWS):
            _, later = _order(columns)
            found.append([x[later] for x in columns])
        rows.clear()
        columns = [np.concatenate(x) for x in zip(*found)]
        found.clear()
        if len(columns[1]):
            columns.append(_part(columns[1], n_parts))
            yield _by_key(columns, n_parts, flagged=True)

    @ws.released
    def find(batches):
        counted = []

        def split():
            for batch in batches:
                flagged = batch.column(1).to_numpy(zero_copy_only=False)
                if flagged.any():  # dealt by document already
                    counted.append(batch.filter(pa.array(flagged)))
                yield batch.filter(pa.array(~flagged))

        for out in _each_key(split(), repeats):
            yield from counted
            counted.clear()
            yield out
        yield from counted

    return find


@ws.released
def _gather(batches):
    """Per part, ordered by it: one row per document with all its repeated windows."""

    def rows(held):
        columns = [np.concatenate(x) for x in zip(*((h, np.repeat(docs, counts)) for h, docs, counts in held))]
        held.clear()
        columns.append(np.zeros(len(columns[1]), np.int8))
        ids, counts, flat, _, _ = ws.grouped_from(columns, 1)
        yield pa.RecordBatch.from_arrays([pa.array(ids), ws.lists(flat.view(np.int64), counts)], names=["doc_id", "__hits"])

    yield from _each_key(batches, rows)


def _cut(window: int, text_at: int, hits_at: int, names: list[str]):
    """Texts without the covered words, the counts and the removed intervals (in words)."""

    @ws.released
    def cut(batches):
        for batch in batches:
            hits = batch.column(hits_at)
            has = hits.is_valid().to_numpy(zero_copy_only=False)
            for first, last, data, starts, begins, before, counts, places, word in _windows_of(batch.column(text_at), window):
                own = ws.window_hashes(word, window, 1)
                texts, removed, spans = [], [], []
                raw = data.tobytes()
                for i in range(first, last):
                    a, b = before[i - first], before[i - first + 1]
                    start, end = starts[i - first], starts[i - first + 1]
                    n = counts[i - first]
                    at = np.flatnonzero(np.isin(own[a : a + n], hits[i].values.to_numpy().view(np.uint64))) if has[i] and n else ()
                    if not len(at):
                        texts.append(raw[start:end])
                        removed.append(0)
                        spans.append([])
                        continue
                    new = np.flatnonzero(np.r_[True, at[1:] > at[:-1] + window])
                    lows, highs = at[new], at[np.r_[new[1:], len(at)] - 1] + window
                    place = np.r_[begins[a:b], end]
                    kept = [raw[x:y] for x, y in zip(np.r_[start, place[highs]], np.r_[place[lows], end])]
                    texts.append(b"".join(kept))
                    removed.append(int((highs - lows).sum()))
                    spans.append([{"start": int(x), "end": int(y)} for x, y in zip(lows, highs)])
                columns = [c.slice(first, last - first) for j, c in enumerate(batch.columns) if j != hits_at]
                text = pa.array(texts, pa.binary()).cast(pa.string())
                nulls = batch.column(text_at).slice(first, last - first).is_null()
                columns[text_at] = pa.compute.if_else(nulls, pa.scalar(None, pa.string()), text)
                columns += [
                    pa.array(np.diff(before)),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def remove_repeated_spans(docs: DataFrame, window: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the words covered by a window that a smaller id has as well.

    Adds ``n_words``, ``n_removed`` and ``spans``, the removed intervals in words. A text
    without removals is left as it is, white space included; else what stands between the
    first removed word and the next kept one goes.
    """
    own = ("n_words", "n_removed", "spans")
    docs = docs.drop(*own)
    key = F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NULL_ID))
    keyed = docs.select(key.alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    chars = keyed.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n_buckets = tasks_for(docs, chars, BUCKET_CHARS)
    with text_batches(docs.sparkSession):
        dealt = keyed.mapInArrow(_deal(window, n_buckets), _DEALT)
        repeats = dealt.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_find_repeats(n_buckets), _DEALT)
        gathered = repeats.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_gather, "doc_id long, __hits array<long>")
        hits = written(gathered, "repeats")
    # the other columns travel as one struct, under names that can't clash
    rest = [c for c in docs.columns if c != text_col]
    carried = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("__rest"), F.col(f"`{text_col}`").alias("__text"), key.alias("__key"))
    joined = carried.join(hits, F.col("__key") == hits["doc_id"], "left").select("__rest", "__text", "__hits")
    span = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
    schema = T.StructType([joined.schema["__rest"], T.StructField("__text", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("spans", span)])
    cut = joined.mapInArrow(_cut(window, 1, 2, schema.names), schema)
    return cut.select(*[F.col("__text").alias(c) if c == text_col else F.col(f"__rest.`{c}`") for c in docs.columns], *own)


def op6_substring_dedup(spark, d):
    """Digests of the kept words, joined by one space."""
    cut = remove_repeated_spans(table(spark, d, "documents").select("doc_id", "text"))
    kept = F.regexp_replace(F.coalesce("text", F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.trim(kept), 256).alias("kept_sha256"))


WORDS_SQL = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"
OP6_SQL = f"""
WITH words AS MATERIALIZED (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words),
windows AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(list_slice(w, i, i + 49), ' ')) AS k FROM places),
firsts AS (SELECT k, min(doc_id) AS least FROM windows GROUP BY k),
covered AS (
  SELECT DISTINCT doc_id, j FROM (
    SELECT doc_id, unnest(range(i, i + 50)) AS j FROM windows JOIN firsts USING (k) WHERE least < doc_id)),
each_word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM words),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS t
  FROM each_word ANTI JOIN covered USING (doc_id, j) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""
