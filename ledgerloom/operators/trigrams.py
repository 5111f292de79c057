"""Keyword search that reads only what can match: posting lists of three-letter pieces.

Records are stored in blocks, a folder each, and of every three consecutive characters
("grams") of their lower-cased texts there is a posting list per block, of the records that
have it. Lists stand in files by a hash of the gram, sorted by gram, so a lookup reads little of
them. A search combines the lists of the grams that every match must have, opens only the
blocks with records left, and tests these exactly as ``search.keyword_search`` does.

Of a pattern, the needed grams are those of its literal parts: all parts of a sequence, any
branch of an alternative. A keyword of under three characters, or a pattern without literal
parts, needs none, and all blocks are read.

New records are added as further blocks; nothing written before is touched.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator, Sequence
from functools import reduce
from re import _constants as sre
from re import _parser as sre_parser

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.search import TEXT_COLUMNS, keyword_search
from ledgerloom.operators.sizing import fits_broadcast
from ledgerloom.session import shuffles_dropped, write_table, written

register_pickle_by_value(sys.modules[__name__])

BLOCK_RECORDS = 100_000
# Characters whose grams are listed at once.
RUN_CHARS = 2_000_000
SHARDS = 64
# Blocks whose lists of a shard one task writes.
SPAN_BLOCKS = 64
SIZE = 3
NUMBER, BLOCK = "_number", "_block"

LISTS = f"gram string, {BLOCK} int, numbers array<bigint>, shard int"

# What a match must have: a gram, ("and", parts) or ("or", parts); None is nothing in particular.
Needed = str | tuple | None


# -- what a keyword needs -------------------------------------------------------------


def _all(parts: Sequence[Needed]) -> Needed:
    some = [p for p in parts if p is not None]
    return ("and", some) if len(some) > 1 else some[0] if some else None


def _any(parts: Sequence[Needed]) -> Needed:
    return None if None in parts else ("or", list(parts)) if len(parts) > 1 else parts[0]


def grams_of(text: str) -> list[str]:
    text = text.lower()
    return list(dict.fromkeys(text[i : i + SIZE] for i in range(len(text) - SIZE + 1)))


def _of_pattern(parsed) -> Needed:
    parts: list[Needed] = []
    run = ""

    def close() -> None:
        nonlocal run
        parts.extend(grams_of(run))
        run = ""

    for op, arg in parsed:
        if op is sre.LITERAL:
            run += chr(arg)
            continue
        if op is sre.SUBPATTERN and not (arg[1] or arg[2]) and all(o is sre.LITERAL for o, _ in arg[3]):
            run += "".join(chr(a) for _, a in arg[3])  # a group around plain characters
            continue
        close()
        if op is sre.SUBPATTERN:
            parts.append(_of_pattern(arg[3]))
        elif op is sre.BRANCH:
            parts.append(_any([_of_pattern(branch) for branch in arg[1]]))
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT) and arg[0] >= 1:
            parts.append(_of_pattern(arg[2]))
        # anything else may match without a character of its own that is known here
    close()
    return _all(parts)


def needed_grams(keyword: str, mode: str = "literal") -> Needed:
    if mode == "literal":
        return _all(grams_of(keyword))
    if mode != "regex":
        raise ValueError(f"unknown mode: {mode}")
    return _of_pattern(sre_parser.parse(keyword))


def _flat(needed: Needed) -> list[str]:
    if needed is None:
        return []
    return [needed] if isinstance(needed, str) else list(dict.fromkeys(g for p in needed[1] for g in _flat(p)))


# -- writing --------------------------------------------------------------------------


def _code_points(column: pa.Array) -> np.ndarray:
    wide = column.cast(pa.large_string())
    ends = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    data = wide.buffers()[2].slice(ends[0], ends[-1] - ends[0]).to_pybytes() if ends[-1] > ends[0] else b""
    return np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)


def _lists_of(texts: Sequence[pa.Array], numbers: np.ndarray) -> pa.RecordBatch | None:
    """(gram, numbers): the posting lists of some records, from their lower-cased texts."""
    points, record = [], []
    for column in texts:
        points.append(_code_points(column.fill_null("")))
        record.append(np.repeat(np.arange(len(column)), pc.fill_null(pc.utf8_length(column), 0).to_numpy(zero_copy_only=False)))
    # a column's texts stand one after the other: a gram lies within one record of one column
    place = np.concatenate([r + len(numbers) * i for i, r in enumerate(record)])
    points = np.concatenate(points)
    used = np.zeros(int(points.max(initial=0)) + 1, bool)
    used[points] = True
    alphabet, letters = np.flatnonzero(used), (np.cumsum(used) - 1)[points]
    inside = np.flatnonzero(place[: 1 - SIZE] == place[SIZE - 1 :]) if len(place) >= SIZE else np.zeros(0, np.int64)
    if not len(inside):
        return None
    gram = (letters[inside] * len(alphabet) + letters[inside + 1]) * len(alphabet) + letters[inside + 2]
    if len(alphabet) ** SIZE * len(numbers) >= 1 << 62:
        kinds, gram = np.unique(gram, return_inverse=True)
    else:
        kinds = None
    found = np.sort(gram * len(numbers) + place[inside] % len(numbers))
    found = found[np.r_[True, found[1:] != found[:-1]]]
    gram, row = found // len(numbers), found % len(numbers)
    heads = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]])
    own = gram[heads] if kinds is None else kinds[gram[heads]]
    spelt = np.stack([own // len(alphabet) ** 2, own // len(alphabet) % len(alphabet), own % len(alphabet)], axis=1)
    joined = alphabet[spelt].astype(np.uint32).tobytes().decode("utf-32-le")
    names = [joined[i : i + SIZE] for i in range(0, len(joined), SIZE)]
    lists = pa.ListArray.from_arrays(pa.array(np.r_[heads, len(row)].astype(np.int32)), pa.array(numbers[row], pa.int64()))
    return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), lists], names=["gram", "numbers"])


def posting_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(gram, block, numbers) of each run of records of one block, of about ``RUN_CHARS``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        block, numbers = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        texts = [batch.column(i) for i in range(2, batch.num_columns)]
        chars = np.cumsum(sum(pc.fill_null(pc.utf8_length(t), 0).to_numpy(zero_copy_only=False).astype(np.int64) for t in texts))
        run = (chars - 1) // RUN_CHARS
        heads = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (block[1:] != block[:-1])])
        for start, end in zip(heads, [*heads[1:], batch.num_rows]):
            lists = _lists_of([t.slice(start, end - start) for t in texts], numbers[start:end])
            if lists is not None:
                own = pa.array(np.full(lists.num_rows, block[start], np.int32))
                yield pa.RecordBatch.from_arrays([lists.column(0), own, lists.column(1)], names=["gram", BLOCK, "numbers"])


def _write(df: DataFrame, base: str, columns: Sequence[str], block_records: int, first_block: int) -> None:
    spark = df.sparkSession
    records, lists = f"{base}/records", f"{base}/grams"
    with shuffles_dropped(spark):
        n = df.count()
    blocks = max(1, -(-n // block_records))
    # by place, not by content: rows repeated ever so often fill all blocks alike
    spread = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks))
    placed = df.withColumn(BLOCK, spread.cast("int") + first_block)
    dealt = placed.repartition(BLOCK).withColumn(NUMBER, F.monotonically_increasing_id())
    write_table(dealt, records, "append", [BLOCK])
    stored = spark.read.schema(dealt.schema).parquet(records).filter(F.col(BLOCK) >= first_block)
    lowered = stored.select(BLOCK, NUMBER, *[F.lower(F.col(c)).alias(f"t{i}") for i, c in enumerate(columns)])
    parts = lowered.mapInArrow(posting_parts, f"gram string, {BLOCK} int, numbers array<bigint>")
    # dealt once: a shard's lists of some blocks are made, sorted and written by one task
    dealing = {"shard": F.pmod(F.xxhash64("gram"), F.lit(SHARDS)).cast("int"), "_span": F.floor((F.col(BLOCK) - first_block) / SPAN_BLOCKS)}
    dealt_parts = parts.withColumns(dealing).repartition(SHARDS * -(-blocks // SPAN_BLOCKS), "shard", "_span")
    # a list holds at most the records of a block
    posted = dealt_parts.groupBy("shard", "_span", "gram", BLOCK).agg(F.sort_array(F.flatten(F.collect_list("numbers"))).alias("numbers"))
    write_table(posted.drop("_span").sortWithinPartitions("shard", "gram"), lists, "append", ["shard"])


def write_index(df: DataFrame, base: str, columns: Sequence[str] = TEXT_COLUMNS, block_records: int = BLOCK_RECORDS) -> None:
    """Stores the records of ``df`` in blocks, with the posting lists of ``columns``."""
    df.sparkSession.createDataFrame([(df.schema.json(),)], "schema string").write.text(f"{base}/schema")
    _write(df, base, columns, block_records, 0)


def add_records(df: DataFrame, base: str, columns: Sequence[str] = TEXT_COLUMNS, block_records: int = BLOCK_RECORDS) -> None:
    """Adds records as further blocks."""
    held = read_records(df.sparkSession, base).agg(F.max(BLOCK)).first()[0]
    _write(df, base, columns, block_records, 0 if held is None else held + 1)


def read_records(spark: SparkSession, base: str, blocks: Sequence[int] | None = None) -> DataFrame:
    """The stored records with their block and number; of the given blocks, only their folders
    are listed and read."""
    path = f"{base}/records"
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{base}/schema").first()[0]))
    schema = schema.add(NUMBER, T.LongType()).add(BLOCK, T.IntegerType())
    paths = [path] if blocks is None else [f"{path}/{BLOCK}={b}" for b in sorted(blocks)]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


# -- searching ------------------------------------------------------------------------


def _combined(needed: Needed, lists: Column) -> Column:
    """The numbers that have what is needed, from a map of gram to numbers."""
    none = F.array().cast("array<bigint>")
    if isinstance(needed, str):
        return F.coalesce(F.element_at(lists, F.lit(needed)), none)
    kind, parts = needed
    how = F.array_intersect if kind == "and" else F.array_union
    return reduce(how, [_combined(p, lists) for p in parts])


def possible_records(spark: SparkSession, base: str, keyword: str, mode: str = "literal") -> DataFrame | None:
    """(_block, _number) of the records that have the needed grams; None if none are needed."""
    needed = needed_grams(keyword, mode)
    grams = _flat(needed)
    if not grams:
        return None
    asked = spark.createDataFrame([(g,) for g in grams], "gram string").select(F.pmod(F.xxhash64("gram"), F.lit(SHARDS)).cast("int").alias("shard"))
    shards = sorted({r["shard"] for r in asked.collect()})  # at most one per gram of the keyword
    posted = spark.read.schema(LISTS).parquet(f"{base}/grams").filter(F.col("shard").isin(shards) & F.col("gram").isin(grams))
    # a block's lists of the asked grams
    by_block = posted.groupBy(BLOCK).agg(F.map_from_entries(F.collect_list(F.struct("gram", "numbers"))).alias("lists"))
    found = by_block.select(BLOCK, _combined(needed, F.col("lists")).alias("numbers")).filter(F.size("numbers") > 0)
    return found.select(BLOCK, F.explode("numbers").alias(NUMBER))


def index_search(spark: SparkSession, base: str, keyword: str, columns: Sequence[str] = TEXT_COLUMNS, mode: str = "literal") -> DataFrame:
    """The rows that ``search.keyword_search`` gives of the stored records.

    ``columns``: those of the index, or some of them.
    """
    if mode == "regex" and keyword:
        re.compile(keyword)
    possible = possible_records(spark, base, keyword, mode) if keyword else None
    if possible is None:
        return keyword_search(read_records(spark, base), keyword, columns, mode).drop(BLOCK, NUMBER)
    possible = written(possible, "possible")
    blocks = [r[BLOCK] for r in possible.select(BLOCK).distinct().collect()]  # at most one per block
    if not blocks:
        return read_records(spark, base).limit(0).drop(BLOCK, NUMBER)
    opened = read_records(spark, base, blocks)
    kept = opened.join(F.broadcast(possible) if fits_broadcast(possible) else possible, [BLOCK, NUMBER], "left_semi")
    return keyword_search(kept, keyword, columns, mode).drop(BLOCK, NUMBER)
