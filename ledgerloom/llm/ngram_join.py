"""Near-duplicate classes: an exact Jaccard join of word n-gram sets.

Method: token-combination prefixes. The tokens (n-gram hashes) of a text are ordered from
rare to frequent. A rare token of the prefix is indexed alone, frequent ones in pairs of
the same partition of tokens, and the prefix is extended by as many tokens as pairs can
miss, so that any two texts at the threshold share an index key:

    the prefix is the shortest one with
    #rare + sum over partitions of (#frequent - 1) >= n - ceil(threshold * n) + 1.

The number of partitions follows the size of the set, in ranges of a factor four; a set
near a range's end is indexed for both ranges. Sets under ``SMALL_SET`` take every token
as a rare one.

Steps, each over all rows:

1. One pass over the texts: set size and a hash of the whole set (texts of equal sets are
   one class from here on), and how many texts of different sets each task's chunk has of
   every token; tokens are cut to 32 bits within their bucket and summed there. The
   ``MOST_FREQUENT`` first of those with ``LEAST_COUNT`` or more are sent to all tasks. This
   orders the tokens and is no matter of right or wrong.
2. A second pass: index keys of every class, dealt to buckets. Short posting lists give
   all their pairs, long ones the pairs with a few pivots, and are kept.
3. Pairs are compared by parity bitmaps first: bits set an odd number of times by the
   tokens. The bits in which two maps differ are at most the tokens in which the sets do,
   so no pair at the threshold is lost. What is left is verified on whole texts: rows are
   dealt by the first of a pair, salted, and read in order, so a task holds one set at a
   time.
4. Components of the links. A long list whose members are all in one component is done.
   Of others, all members outside the list's largest component are compared by bitmap with
   each other, list by list, and with that component, once for all its lists, in bounded
   pieces. Of each member and component the first ``4`` possible partners are verified and
   components joined; lists in which there were more, and none of those given has linked, are
   taken again with ``64 ...`` of them.

Classes are named by a 64-bit hash of their set; with n different sets about
n**2 / 2**65 of them are expected to share a name.

Defined results: a null or empty text has no tokens and is linked with nothing; a text of
fewer words than ``width`` is one token; documents of null id are kept, with the size of
their set and a null component; rows of the same id are one document per different set;
an empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import wordscan as ws
from ledgerloom.llm.tables import small, table, tasks_for, text_batches
from ledgerloom.session import written

CHUNK_TOKENS = 1_000_000
MOST_FREQUENT = 1 << 20
LEAST_COUNT = 8
FREQUENT_LEVEL = 6  # floor(log2(count)): from 64 documents on
SMALL_SET = 32
SHORT_LIST = 24
PIVOTS = 2
LIST_PART = 1024
OUTSIDE_PIECE = 256
LIST_PIECE = 512
PAIRS_PER_GROUP = 128
BUCKET_CHARS = 12 << 20

_U = np.uint64


def shingle_sets(texts: pa.Array, width: int):
    """First and last row, and the sorted set of n-gram hashes of each text."""
    for first, last, data, starts in ws.blocks(texts):
        data = ws.LOWER[data]
        begins, ends, before = ws.words(data, starts, ws.WHITE)
        word = ws.hashes(data, begins, ends)
        grams = ws.window_hashes(word, width)
        sets = []
        for a, b in zip(before[:-1], before[1:]):
            n = b - a
            if n >= width:
                sets.append(np.unique(grams[a : b - width + 1]))
            else:  # the whole of a short text, told from longer n-grams by its length
                sets.append(ws.mix(ws.window_hashes(word[a:b], n) + _U(n)) if n else np.zeros(0, _U))
        yield first, last, sets


def class_of(tokens: np.ndarray) -> int:
    """A signed 64-bit name of a set of tokens."""
    return int(ws.mix(ws.mix(tokens ^ _U(0x9E3779B97F4A7C15)).sum(dtype=_U, keepdims=True) + _U(len(tokens))).view(np.int64)[0])


def short_token(tokens: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of a token and its lower 32 bits, as one number."""
    bucket = ws.mix(tokens) % _U(n_buckets)
    return ((bucket << _U(32)) | (tokens & _U(0xFFFFFFFF))).view(np.int64)


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """A parity bitmap of at least two bits per token, as 64-bit words."""
    bits = 256
    while bits < 2 * len(tokens):
        bits *= 2
    odd = np.bincount((ws.mix(tokens ^ _U(0x5BD1E995)) & _U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def may_link(bits: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray, threshold: tuple[int, int]) -> np.ndarray:
    """Which of ``others`` (rows of equal length) the bitmaps don't rule out."""
    top, whole = threshold
    width = min(bits.shape[0], others.shape[1])
    while bits.shape[0] > width:
        bits = bits[: bits.shape[0] // 2] ^ bits[bits.shape[0] // 2 :]
    while others.shape[1] > width:
        half = others.shape[1] // 2
        others = others[:, :half] ^ others[:, half:]
    apart = np.bitwise_count((others ^ bits).view(_U)).sum(1, dtype=np.int64)
    # both <= (size + other - apart) / 2, and whole * both >= top * (size + other - both)
    return (whole + top) * (size + sizes - apart) >= 2 * top * (size + sizes)


def _scan(width: int, n_buckets: int):
    """Per text its size and class; per chunk and bucket the tokens and their counts."""
    names = ["doc_id", "text_hash", "n", "class", "bits", "bucket", "tokens", "counts"]
    map_type = pa.list_(pa.int64())

    def summed(sets):
        tokens, counts = np.unique(short_token(np.concatenate(sets), n_buckets), return_counts=True)
        bucket = tokens >> 32
        per_bucket = np.bincount(bucket, minlength=n_buckets)
        some = np.flatnonzero(per_bucket)
        none = pa.nulls(len(some), pa.int64())
        low = (tokens & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
        yield pa.RecordBatch.from_arrays([none, none, none, none, pa.nulls(len(some), map_type), pa.array(some.astype(np.int32)), ws.lists(low, per_bucket[some]), ws.lists(np.minimum(counts, 32767).astype(np.int16), per_bucket[some])], names=names)

    @ws.released
    def scan(batches):
        held, seen, size = [], set(), 0
        for batch in batches:
            for first, last, sets in shingle_sets(batch.column(1), width):
                classes = [class_of(s) if len(s) else None for s in sets]
                n = last - first
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), batch.column(2).slice(first, n), pa.array([len(s) for s in sets], pa.int64()), pa.array(classes, pa.int64()), pa.array([bitmap(s) for s in sets], map_type), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int32())), pa.nulls(n, pa.list_(pa.int16()))], names=names)
                for c, s in zip(classes, sets):
                    if c is not None and c not in seen:
                        seen.add(c)
                        held.append(s)
                        size += len(s)
                if size >= CHUNK_TOKENS:
                    yield from summed(held)
                    held, seen, size = [], set(), 0
        if held:
            yield from summed(held)

    return scan


@ws.released
def _frequent(batches):
    """Per bucket, ordered by it: the tokens of ``LEAST_COUNT`` texts or more."""

    def out(bucket, tokens, counts):
        tokens, back = np.unique(np.concatenate(tokens), return_inverse=True)
        totals = np.bincount(back, np.concatenate(counts), len(tokens)).astype(np.int64)
        often = totals >= LEAST_COUNT
        key = (np.int64(bucket) << 32) | tokens[often].view(np.uint32).astype(np.int64)
        return pa.RecordBatch.from_pydict({"token": key, "count": totals[often]})

    current, tokens, counts = None, [], []
    for batch in batches:
        for i, bucket in enumerate(batch.column(0).to_pylist()):
            if bucket != current and tokens:
                yield out(current, tokens, counts)
                tokens, counts = [], []
            current = bucket
            tokens.append(batch.column(1)[i].values.to_numpy())
            counts.append(batch.column(2)[i].values.to_numpy())
    if tokens:
        yield out(current, tokens, counts)


def _units_needed(n: int, threshold: tuple[int, int]) -> int:
    top, whole = threshold
    return n - -(-top * n // whole) + 1


def _ranges(n: int, threshold: tuple[int, int]) -> list[int]:
    """The partition counts for which a set of ``n`` tokens is indexed; 0: every token is rare."""
    top, whole = threshold
    found, low, parts = [], SMALL_SET, 4
    if n * top < SMALL_SET * whole:
        found.append(0)
    while low <= n:
        if low <= n and n * top < 4 * low * whole:
            found.append(parts)
        low, parts = 4 * low, 4 * parts
    return found


def index_keys(tokens: np.ndarray, levels: np.ndarray, threshold: tuple[int, int]) -> np.ndarray:
    """The keys of one set; ``levels``: 0 for rare tokens, higher for frequent ones."""
    n = len(tokens)
    order = np.lexsort((tokens, levels))
    tokens, levels = tokens[order], levels[order]
    need, keys = _units_needed(n, threshold), []
    rare = int(np.searchsorted(levels, FREQUENT_LEVEL))
    for parts in _ranges(n, threshold):
        if parts == 0 or rare >= need:
            keys.append(tokens[:need])
            continue
        # the token itself chooses its partition, by bits that the order doesn't use up
        part = (ws.mix(tokens[rare:] ^ _U(parts)) % _U(parts)).astype(np.int64)
        by_part = np.argsort(part, kind="stable")
        first = np.zeros(n - rare, bool)
        first[by_part[np.r_[True, part[by_part][1:] != part[by_part][:-1]]]] = True
        units = rare + np.cumsum(~first)
        end = int(np.searchsorted(units, need)) + 1
        keys.append(tokens[:rare])
        own, part = tokens[rare : rare + end], part[:end]
        by_part = np.argsort(part, kind="stable")
        own, part = own[by_part], part[by_part]
        for d in range(1, end):
            same = part[d:] == part[:-d]
            if not same.any():
                break
            low, high = np.minimum(own[:-d], own[d:])[same], np.maximum(own[:-d], own[d:])[same]
            keys.append(ws.mix(ws.mix(low) + high + _U(parts)))
    return np.unique(np.concatenate(keys)) if len(keys) > 1 else keys[0]


def _post(width: int, threshold: tuple[int, int], n_buckets: int, frequent):
    """Index keys of each class, once per task, dealt by key."""
    names = ["bucket", "classes", "sizes", "counts", "keys"]

    def rows(held):
        keys = np.concatenate([k for k, _, _ in held])
        sizes = {c: n for _, c, n in held}
        owners = np.repeat(np.array([c for _, c, _ in held], np.int64), [len(k) for k, _, _ in held])
        bucket = (ws.mix(keys) % _U(n_buckets)).astype(np.int64)
        classes, counts, flat, per_key, per_row = ws.grouped(bucket, owners, keys, n_buckets)
        some = per_key > 0
        own = np.array([sizes[c] for c in classes.tolist()], np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(some).astype(np.int32)), ws.lists(classes, per_key[some]), ws.lists(own, per_key[some]), ws.lists(counts, per_key[some]), ws.lists(flat.view(np.int64), per_row[some])], names=names)

    @ws.released
    def post(batches):
        known, level = frequent.value
        held, seen, size = [], set(), 0
        for batch in batches:
            for _, _, sets in shingle_sets(batch.column(1), width):
                for s in sets:
                    if not len(s):
                        continue
                    c = class_of(s)
                    if c in seen:
                        continue
                    seen.add(c)
                    levels = np.zeros(len(s), np.int8)
                    if len(known):
                        short = short_token(s, n_buckets)
                        at = np.minimum(np.searchsorted(known, short), len(known) - 1)
                        levels = np.where(known[at] == short, level[at], 0)
                    keys = index_keys(s, levels, threshold)
                    held.append((keys, c, len(s)))
                    size += len(keys)
                if size >= CHUNK_TOKENS // 2:
                    yield from rows(held)
                    held, seen, size = [], set(), 0
        if held:
            yield from rows(held)

    return post


def _pair_up(threshold: tuple[int, int]):
    """Candidate pairs of every key's list; long lists are kept beside their pivots' pairs."""
    top, whole = threshold
    names = ["a", "b", "key", "classes"]

    def rows(held):
        keys, classes, sizes = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((classes, keys))
        keys, classes, sizes = keys[order], classes[order], sizes[order].astype(np.int64)
        # a class posted by several tasks
        keep = np.r_[True, (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1])]
        keys, classes, sizes = keys[keep], classes[keep], sizes[keep]
        new = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        lengths = np.diff(np.r_[new, len(keys)])
        length = np.repeat(lengths, lengths)
        rank = np.arange(len(keys)) - np.repeat(new, lengths)
        found = []
        for d in range(1, SHORT_LIST):
            left = np.flatnonzero((length > rank + d) & (length <= SHORT_LIST))
            found.append((left, left + d))
        for p in range(PIVOTS):
            right = np.flatnonzero((length > SHORT_LIST) & (rank > p))
            found.append((right - rank[right] + p, right))
        left, right = (np.concatenate(x) for x in zip(*found))
        fits = whole * np.minimum(sizes[left], sizes[right]) >= top * np.maximum(sizes[left], sizes[right])
        pairs = np.unique(np.stack([classes[left[fits]], classes[right[fits]]], axis=1), axis=0) if fits.any() else np.zeros((0, 2), np.int64)
        n = len(pairs)
        if n:
            empty = pa.nulls(n, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(n, pa.int64()), empty], names=names)
        kept = length > SHORT_LIST
        if kept.any():
            cut = np.flatnonzero(kept & (rank % LIST_PART == 0))
            counts = np.minimum(length[cut] - rank[cut], LIST_PART)
            n = len(cut)
            yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.array(keys[cut].view(np.int64)), ws.lists(classes[kept], counts)], names=names)

    @ws.released
    def pair_up(batches):
        held, current = [], None
        for batch in batches:
            for i, bucket in enumerate(batch.column(0).to_pylist()):
                if bucket != current and held:
                    yield from rows(held)
                    held = []
                current = bucket
                classes, sizes, counts, keys = (batch.column(j)[i].values.to_numpy() for j in range(1, 5))
                held.append((keys.view(_U), np.repeat(classes, counts), np.repeat(sizes, counts)))
        if held:
            yield from rows(held)

    return pair_up


def _verify(width: int, threshold: tuple[int, int]):
    """Rows come ordered by (a, salt, side): the text of ``a``, then those of its partners."""
    top, whole = threshold

    @ws.released
    def verify(batches):
        group, own = None, None
        for batch in batches:
            a, salt, side, wanted = (batch.column(i).to_pylist() for i in range(4))
            linked = []
            for first, _, sets in shingle_sets(batch.column(4), width):
                for i, tokens in enumerate(sets, first):
                    if not len(tokens) or class_of(tokens) != wanted[i]:
                        continue  # another text of the same id
                    if (a[i], salt[i]) != group:
                        group, own = (a[i], salt[i]), None
                    if side[i] == 0:
                        own = tokens
                    elif own is not None:
                        both = len(np.intersect1d(own, tokens, assume_unique=True))
                        if whole * both >= top * (len(own) + len(tokens) - both):
                            linked.append((a[i], wanted[i]))
            if linked:
                x, y = zip(*linked)
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], names=["a", "b"])

    return verify


def _prune(threshold: tuple[int, int]):
    """The pairs whose bitmaps don't rule them out."""

    @ws.released
    def prune(batches):
        for batch in batches:
            n_a, n_b = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a, b = batch.column(4)[i].values.to_numpy(), batch.column(5)[i].values.to_numpy()
                keep[i] = may_link(a, n_a[i], b[None, :], np.array([n_b[i]]), threshold)[0]
            yield batch.select([0, 1]).filter(pa.array(keep))

    return prune


def possible(pairs: DataFrame, named: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) that may be similar enough by their bitmaps."""
    first, second = (named.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("bits").alias(f"bits_{x}")) for x in ("a", "b"))
    both = pairs.join(first, "a").join(second, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    return both.mapInArrow(_prune(threshold), "a long, b long")


def verified(pairs: DataFrame, named: DataFrame, docs: DataFrame, width: int, threshold: tuple[int, int]) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough.

    ``named``: class and its document's id; ``docs``: doc_id and text.
    """
    per_group = pairs.groupBy("a").agg(F.count("*").alias("n"))
    salts = F.greatest(F.lit(1), F.ceil(F.col("n") / PAIRS_PER_GROUP)).cast("int")
    sized = per_group.select("a", salts.alias("salts"))
    partners = pairs.join(sized, "a").select("a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), F.lit(1).alias("side"), F.col("b").alias("class"))
    own = sized.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("side"), F.col("a").alias("class"))
    members = written(partners.union(own).join(named.select("class", "doc_id"), "class").select("a", "salt", "side", "class", "doc_id"), "members")
    texts = docs.join(small(members), "doc_id").select("a", "salt", "side", "class", "text")
    n = members.count()
    dealt = texts.repartition(tasks_for(docs, n, 4096), "a", "salt").sortWithinPartitions("a", "salt", "side")
    return dealt.mapInArrow(_verify(width, threshold), "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label``, the least node that it reaches, for every node of a link."""
    both = written(links.select(F.col("a").alias("x"), F.col("b").alias("y")).union(links.select("b", "a")), "links")
    labels = written(both.groupBy(F.col("x").alias("node")).agg(F.least(F.min("y"), F.col("x")).alias("label")), "labels")
    while True:
        near = both.join(labels, F.col("y") == F.col("node")).groupBy(F.col("x").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("next"))
        far = labels.select(F.col("node").alias("next"), F.col("label").alias("far"))
        moved = written(lower.join(far, "next").select("node", F.least("next", "far").alias("label"), F.col("label").alias("old")), "labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels


def _compare_across(threshold: tuple[int, int], most: int):
    """Rows come ordered by (key, chunk, part, side): members outside the largest component,
    then a part of the list. Gives of each of the first and each other component the first
    ``most`` possible partners, and whether there were more."""

    @ws.released
    def compare(batches):
        group, outside = None, []
        for batch in batches:
            key, chunk, part, side, classes, labels, sizes = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(7))
            ids = np.stack([key, chunk, part, side], axis=1)
            cuts = np.flatnonzero(np.r_[True, (ids[1:] != ids[:-1]).any(1)]) if len(ids) else []
            for a, b in zip(cuts, [*cuts[1:], len(ids)]):
                if group != tuple(ids[a, :3]):
                    group, outside = tuple(ids[a, :3]), []
                bits = [batch.column(7)[i].values.to_numpy() for i in range(a, b)]
                if side[a] == 0:
                    outside += zip(classes[a:b].tolist(), labels[a:b].tolist(), sizes[a:b].tolist(), bits)
                    continue
                widths = np.array([len(x) for x in bits])
                found = []
                for width in np.unique(widths):
                    rows = a + np.flatnonzero(widths == width)
                    maps = np.stack([bits[i - a] for i in rows])
                    for c, label, size, own in outside:
                        there = rows[may_link(own, size, maps, sizes[rows], threshold) & (labels[rows] != label)]
                        if len(there):
                            found.append((np.full(len(there), c), classes[there], labels[there]))
                if not found:
                    continue
                x, y, label = (np.concatenate(z) for z in zip(*found))
                order = np.lexsort((ws.mix(x.view(_U) ^ y.view(_U)), label, x))
                x, y, label = x[order], y[order], label[order]
                new = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (label[1:] != label[:-1])])
                lengths = np.diff(np.r_[new, len(x)])
                rank = np.arange(len(x)) - np.repeat(new, lengths)
                keep = rank < most
                x, y, more = x[keep], y[keep], np.repeat(lengths > most, lengths)[keep]
                yield pa.RecordBatch.from_pydict({"key": np.full(len(x), group[0]), "a": np.minimum(x, y), "b": np.maximum(x, y), "more": more})

    return compare


@ws.released
def _count_labels(batches):
    """How many classes of each label a batch has of each key."""
    for batch in batches:
        held = batch.column(1)
        if isinstance(held, pa.ChunkedArray):
            held = held.combine_chunks()
        labels = np.repeat(batch.column(0).to_numpy(), held.value_lengths().to_numpy())
        pairs, counts = np.unique(np.stack([labels, held.flatten().to_numpy()], axis=1), axis=0, return_counts=True)
        yield pa.RecordBatch.from_pydict({"label": pairs[:, 0], "key": pairs[:, 1], "n": counts})


def _pieces(outside: DataFrame, listed: DataFrame) -> DataFrame:
    """Rows (key, class, label, n, bits) of both sides, dealt so that all of a key meet in
    bounded pieces: a chunk of ``outside`` before a part of ``listed``."""
    sizes = outside.groupBy("key").agg(F.ceil(F.count("*") / OUTSIDE_PIECE).cast("int").alias("chunks"))
    sizes = sizes.join(listed.groupBy("key").agg(F.ceil(F.count("*") / LIST_PIECE).cast("int").alias("parts")), "key")
    sizes = small(written(sizes, "pieces"))
    spread, each = F.xxhash64("class"), (lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1)))
    columns = ("key", "chunk", "part", "side", "class", "label", "n", "bits")
    first = outside.join(sizes, "key").withColumn("chunk", F.pmod(spread, "chunks").cast("int")).withColumn("part", each("parts")).withColumn("side", F.lit(0))
    second = listed.join(sizes, "key").withColumn("part", F.pmod(spread, "parts").cast("int")).withColumn("chunk", each("chunks")).withColumn("side", F.lit(1))
    rows = first.select(*columns).union(second.select(*columns))
    n = int(outside.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(n, "key", "chunk", "part").sortWithinPartitions("key", "chunk", "part", "side")


def _across(keyed: DataFrame, open_keys: DataFrame | None, labels: DataFrame, named: DataFrame, threshold: tuple[int, int], most: int) -> tuple[DataFrame, DataFrame]:
    """Possible pairs of members of different components, of lists that have more than one.

    ``keyed``: every class with the keys of its lists. A list's members outside its largest
    component are compared with each other, and with that component as a whole: its members
    are met once, not list by list. Gives the pairs, and each list's key and largest component.
    """
    mapped = written(keyed.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("label", "class")), "labelled")
    counts = mapped.select("label", "keys").mapInArrow(_count_labels, "label long, key long, n long").groupBy("key", "label").agg(F.sum("n").alias("n"))
    if open_keys is not None:
        counts = counts.join(small(open_keys), "key", "left_semi")
    counts = written(counts, "label-counts")
    largest = written(counts.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), F.count("*").alias("labels")).filter("labels > 1").select("key", "largest"), "largest")
    minor = counts.alias("c").join(largest.alias("l"), (F.col("c.key") == F.col("l.key")) & (F.col("c.label") != F.col("l.largest"))).select("c.key", "c.label", "largest")
    wanted = minor.groupBy("label").agg(F.collect_set("key").alias("minor_keys"))
    inner = mapped.join(wanted, "label").select("class", "label", F.explode(F.array_intersect("keys", "minor_keys")).alias("key"))
    about = named.select("class", "n", "bits")
    outside = written(inner.join(small(largest), "key").join(about, "class"), "outside")

    # with the largest component of their list as a whole
    against = outside.dropDuplicates(["class", "largest"]).select(F.col("largest").alias("key"), "class", "label", "n", "bits")
    whole = mapped.select("class", "label").join(small(against.select(F.col("key").alias("label")).distinct()), "label", "left_semi").join(about, "class")
    whole = whole.select(F.col("label").alias("key"), "class", "label", "n", "bits")
    # and with the other members outside it
    several = minor.groupBy("key").agg(F.count("*").alias("minors")).filter("minors > 1").select("key")
    inside = outside.select("key", "class", "label", "n", "bits").join(small(several), "key", "left_semi")
    schema = "key long, a long, b long, more boolean"
    with_largest = _pieces(against, whole).mapInArrow(_compare_across(threshold, most), schema).withColumn("whole", F.lit(True))
    among = _pieces(inside, inside).mapInArrow(_compare_across(threshold, most), schema).withColumn("whole", F.lit(False))
    return with_largest.union(among), largest


def near_duplicates(docs: DataFrame, width: int = 5, threshold: tuple[int, int] = (80, 100), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``id_col``, ``n_shingles``, ``component_id``, the smallest id that links
    reach, and ``text_hash``. ``threshold``: a fraction, as two whole numbers."""
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    hashed = own.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    with text_batches(spark):
        chars = own.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
        n_buckets = tasks_for(docs, chars, BUCKET_CHARS)
        scanned = written(hashed.mapInArrow(_scan(width, n_buckets), "doc_id long, text_hash long, n long, class long, bits array<long>, bucket int, tokens array<int>, counts array<short>"), "shingles")
        sized = scanned.filter("tokens is null").select("doc_id", "text_hash", "n", "class")
        named = written(scanned.filter("tokens is null").filter("class is not null and doc_id is not null").groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("bits").alias("bits")), "classes")

        chunks = scanned.filter("tokens is not null").select("bucket", "tokens", "counts")
        counts = chunks.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_frequent, "token long, count long")
        top = counts.orderBy(F.desc("count"), "token").limit(MOST_FREQUENT).toPandas()
        tokens = top["token"].to_numpy(np.int64)
        level = np.floor(np.log2(np.maximum(top["count"].to_numpy(np.float64), 1))).astype(np.int8)
        order = np.argsort(tokens)
        frequent = spark.sparkContext.broadcast((tokens[order], level[order]))

        posted = own.filter("doc_id is not null").mapInArrow(_post(width, threshold, n_buckets, frequent), "bucket int, classes array<long>, sizes array<int>, counts array<int>, keys array<long>")
        paired = written(posted.repartition(n_buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_pair_up(threshold), "a long, b long, key long, classes array<long>"), "pairs")
        pairs = written(paired.filter("a is not null").select("a", "b").distinct(), "distinct-pairs")
        tried = written(possible(pairs, named, threshold), "possible")
        links = written(verified(tried, named, own, width, threshold), "links")
        labels, most = components(links), 4
        members = paired.filter("key is not null").select("key", F.explode("classes").alias("class"))
        # as many keys as a text's prefix has at most
        keyed = written(members.groupBy("class").agg(F.collect_set("key").alias("keys")), "keyed")
        open_keys = None
        while not keyed.isEmpty() and (open_keys is None or not open_keys.isEmpty()):
            found, largest = _across(keyed, open_keys, labels, named, threshold, most)
            across = written(found, "across")
            new = written(across.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), "untried")
            if not new.isEmpty():
                tried = tried.union(new)
                links = links.union(written(verified(new, named, own, width, threshold), "links"))
                labels = components(links)
            # where all possible partners were given, or one of them has linked, nothing is left
            cut = across.filter("more").select("key", "a", "b", "whole")
            for side in ("a", "b"):
                label = labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
                cut = cut.join(label, side, "left").withColumn(f"label_{side}", F.coalesce(f"label_{side}", side))
            left = written(cut.filter("label_a <> label_b").select("key", "whole").distinct(), "left")
            by_whole = largest.join(left.filter("whole").select(F.col("key").alias("largest")), "largest", "left_semi").select("key")
            open_keys, most = written(left.filter("not whole").select("key").union(by_whole).distinct(), "open-keys"), most * 16
        frequent.unpersist()

    least = named.join(labels.withColumnRenamed("node", "class"), "class", "left").withColumn("label", F.coalesce("label", "class"))
    smallest = least.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_class = least.join(smallest, "label").select("class", "component_id")
    result = sized.join(by_class, "class", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return result.select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), "text_hash")


def op3_ngram_join(spark, d):
    return near_duplicates(table(spark, d, "documents")).drop("text_hash")
