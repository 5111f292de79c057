"""Many keywords at once: an Aho-Corasick automaton over a table of terms.

One pass over the texts finds every occurrence of every term, however many terms there are.
The automaton is built once per task from the terms, which travel with the tasks while they
are measured to be small; a larger table is cut into parts, each a pass of its own.

Terms and texts are lower-cased. An empty or null term finds nothing, a repeated one counts
once; occurrences may overlap; a null text has none.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.cloudpickle import register_pickle_by_value
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators.search import TEXT_COLUMNS
from ledgerloom.operators.sizing import measured_bytes
from ledgerloom.session import written

register_pickle_by_value(sys.modules[__name__])

# Bytes of the terms that one pass may carry; an automaton takes some fifty times as much.
TERM_BYTES = 8 << 20


def automaton(terms: Sequence[str]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for number, term in enumerate(terms):
        found.add_word(term, number)
    found.make_automaton()
    return found


def _one_pass(texts: DataFrame, terms: list[str]) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value
        machine = automaton(names)
        for batch in batches:
            rows, found, counts = [], [], []
            columns = [batch.column(i).to_pylist() for i in range(1, batch.num_columns)]
            for row, values in enumerate(zip(*columns)):
                hits = Counter(number for text in values if text for _, number in machine.iter(text))
                rows += [row] * len(hits)
                found += [names[number] for number in hits]
                counts += hits.values()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(found, pa.string()), pa.array(counts, pa.int64())],
                names=["key", "term", "occurrences"],
            )

    schema = T.StructType([texts.schema["key"], T.StructField("term", T.StringType()), T.StructField("occurrences", T.LongType())])
    return texts.mapInArrow(count, schema)


def count_terms(
    df: DataFrame,
    terms: DataFrame,
    key: str = "nct_id",
    columns: Sequence[str] = TEXT_COLUMNS,
    term: str = "term",
    pass_bytes: int = TERM_BYTES,
) -> DataFrame:
    """(``key``, term, occurrences) of every term that stands in any of the columns."""
    wanted = terms.select(F.lower(F.col(term)).alias("term")).filter("length(term) > 0").distinct()
    wanted = written(wanted, "terms")
    passes = max(1, -(-measured_bytes(wanted) // pass_bytes))
    texts = df.select(F.col(key).alias("key"), *[F.lower(F.col(c)).alias(f"t{i}") for i, c in enumerate(columns)])
    found = []
    for k in range(passes):
        own = wanted if passes == 1 else wanted.filter(F.pmod(F.xxhash64("term"), F.lit(passes)) == k)
        part = [r["term"] for r in own.collect()]  # about `pass_bytes`
        if part:
            found.append(_one_pass(texts, part))
    if not found:
        found = [texts.limit(0).select("key", F.lit("").alias("term"), F.lit(0).cast("bigint").alias("occurrences"))]
    return reduce(DataFrame.unionByName, found).withColumnRenamed("key", key)


def split_known(
    df: DataFrame,
    known: DataFrame,
    labels: str = "conditions",
    label: str = "label",
    sep: str = ", ",
    out: str = "label_list",
) -> DataFrame:
    """Adds ``out``: the labels of a joined text, those with the separator inside kept whole.

    ``known`` is a table of labels. Of all ways to put the pieces between separators together,
    that with the fewest labels is taken, where a label of several pieces has to be a known one;
    among these the one whose first labels are longest. Only labels with a separator inside
    travel with the tasks.
    """
    joined = known.select(F.trim(F.col(label)).alias("label")).filter(F.contains("label", F.lit(sep))).distinct()
    joined = written(joined, "joined-labels")
    if measured_bytes(joined) > TERM_BYTES:
        raise ValueError(f"more than {TERM_BYTES} bytes of labels with {sep!r} inside")
    names = df.sparkSession.sparkContext.broadcast({r["label"] for r in joined.collect()})  # measured above

    @F.udf(T.ArrayType(T.StringType()), useArrow=True)
    def cut(text: str | None) -> list[str] | None:
        return None if text is None else fewest(text.split(sep), names.value, sep)

    return df.withColumn(out, cut(F.col(labels)))


def fewest(pieces: list[str], known: set[str], sep: str) -> list[str]:
    """The pieces put together to as few labels as the known ones allow."""
    longest = max((name.count(sep) + 1 for name in known), default=1)
    n = len(pieces)
    # from the end: labels needed for the rest, and how many pieces the first of them takes
    need, take = [0] * (n + 1), [1] * n
    for i in range(n - 1, -1, -1):
        need[i] = 1 + need[i + 1]
        for size in range(2, min(longest, n - i) + 1):
            if 1 + need[i + size] <= need[i] and sep.join(pieces[i : i + size]).strip() in known:
                need[i], take[i] = 1 + need[i + size], size
    out, i = [], 0
    while i < n:
        out.append(sep.join(pieces[i : i + take[i]]).strip())
        i += take[i]
    return out
