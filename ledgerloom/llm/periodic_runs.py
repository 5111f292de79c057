"""Periodic runs of words, by uniting suffixes in order of descending common prefixes.

1. The words of a block of texts become exact numbers; prefix doubling sorts the suffixes of
   each text. Only suffixes that share their first words with another one of their text
   are carried on, the others are in no run.
2. Neighbours in that order are edges weighted by their longest common prefix (LCP). Kruskal's
   algorithm takes the edges by descending LCP and unites the classes of their suffixes with
   union-find; a class holds its positions in order, and the smaller one is moved into
   the larger one.
3. Two positions that become neighbours in a class by this, at a distance d of at most the
   LCP l, are a seed: the d + l words from the first on have period d, and no smaller
   one, as that would have put another position between the two; nor can they be extended
   to the right. A seed that can't be extended to the left either is a run. Every run has
   exactly one such seed, its first two positions at distance of its period.

Memory is bounded by the block, and for a longer text by its number of words times the
logarithm of its longest common prefix.

Defined results: a null text has no words, and its collapsed text is empty; ties for the
strongest run go to the smallest start, then the smallest period; equal rows get equal
results, one by one; an empty table gives no rows; other columns are not used. Strengths are
compared as doubles, which is exact below 2**26 words a text.
"""

from __future__ import annotations

from bisect import bisect_right
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import wordscan as ws
from ledgerloom.llm.tables import table, text_batches

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
BLOCK_POSITIONS = 1024
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUN_SQL = "struct<start: long, length: long, period: long>"

_first = itemgetter(0)


def word_numbers(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number of each word, equal for equal words only."""
    return ws.packed(data, begins, ends).dictionary_encode().indices.to_numpy().astype(np.int64)


def _heads(keys: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """The order of the keys (last one first), and which of the ordered ones begin a group."""
    order = np.lexsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = False
    for key in keys:
        held = key[order]
        new[1:] |= held[1:] != held[:-1]
    return order, new


def neighbours(ids: np.ndarray, texts: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours among the sorted suffixes of each text, and their LCP of ``least`` words or more.

    ``texts`` and ``ends``: the text of each position, and where that text ends.
    """
    none = np.zeros(0, np.int64)
    n = len(ids)
    order, new = _heads((ids, texts))
    # the rank of a suffix: where its group begins in the order
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if n else none
    rank = np.empty(n, np.int32)
    rank[order] = head
    levels, step, kept = [rank], 1, none
    while True:
        sizes = np.bincount(rank, minlength=n)
        active = np.flatnonzero(sizes[rank] > 1)
        if step <= least:  # groups of at most `least` words: those that can still be wanted
            kept, start_level = active, len(levels) - 1
        if not len(active):
            break
        after = active + step
        inside = after < ends[active]
        second = np.where(inside, rank[np.minimum(after, n - 1)], -1)
        order, new = _heads((second, rank[active]))
        old = rank[active][order]
        first_of_old = np.flatnonzero(np.r_[True, old[1:] != old[:-1]])
        offset = np.arange(len(old)) - np.repeat(first_of_old, np.diff(np.r_[first_of_old, len(old)]))
        at = np.flatnonzero(new)[np.cumsum(new) - 1]
        rank = rank.copy()
        rank[active[order]] = old + offset[at]
        levels.append(rank)
        step *= 2
    if not len(kept):
        return none, none, none
    kept = kept[np.argsort(rank[kept], kind="stable")]
    i, j = kept[:-1], kept[1:]
    same = levels[start_level][i] == levels[start_level][j]
    i, j = i[same], j[same]
    x, y, lcp = i.copy(), j.copy(), np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        ok = (x < ends[i]) & (y < ends[j])
        ok[ok] = levels[k][x[ok]] == levels[k][y[ok]]
        for moved in (x, y, lcp):
            moved[ok] += 1 << k
    long = lcp >= least
    return i[long], j[long], lcp[long]


def seeds(left: np.ndarray, right: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Rows (position, position, LCP) of newly adjacent positions at a distance within the LCP."""
    order = np.argsort(-lcp, kind="stable")
    places, named = np.unique(np.r_[left[order], right[order]], return_inverse=True)
    at = places.tolist()
    a_of, b_of = named[: len(order)].tolist(), named[len(order) :].tolist()
    parent = list(range(len(at)))
    # the positions of a class in order, in blocks
    held = [[[x]] for x in at]
    size = [1] * len(at)
    found = []
    for a, b, near in zip(a_of, b_of, lcp[order].tolist()):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        if size[a] < size[b]:
            a, b = b, a
        parent[b] = a
        size[a] += size[b]
        blocks, moving = held[a], held[b]
        held[b] = None
        moving = moving[0] if len(moving) == 1 else [x for block in moving for x in block]
        last = -1
        for k, place in enumerate(moving):
            of = bisect_right(blocks, place, key=_first) - 1 if len(blocks) > 1 else 0
            of = max(of, 0)
            block = blocks[of]
            to = bisect_right(block, place)
            if to and block[to - 1] != last and place - block[to - 1] <= near:
                found.append((block[to - 1], place, near))
            after = block[to] if to < len(block) else blocks[of + 1][0] if of + 1 < len(blocks) else None
            if after is not None and after - place <= near and (k + 1 == len(moving) or after < moving[k + 1]):
                found.append((place, after, near))
            block.insert(to, place)
            if len(block) > BLOCK_POSITIONS:
                half = len(block) // 2
                blocks[of : of + 1] = [block[:half], block[half:]]
            last = place
    return np.array(found, np.int64).reshape(-1, 3)


def runs_of(ids: np.ndarray, firsts: np.ndarray, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of every run, by start and period; ``firsts``: where each text
    begins in the words ``ids``, and where the last one ends."""
    sizes = np.diff(firsts)
    texts, ends = np.repeat(np.arange(len(sizes)), sizes), np.repeat(firsts[1:], sizes)
    # a run of period q has an LCP of its length less q: no less than this
    periods = np.arange(1, least_length + 1)
    least = max(1, int((np.maximum(least_length, least_exponent * periods) - periods).min()))
    found = seeds(*neighbours(ids, texts, ends, least))
    i, j, lcp = found.T
    period = j - i
    length = period + lcp
    whole = (length >= least_length) & (length >= least_exponent * period)
    begins = firsts[texts[i]] == i
    whole &= begins | (ids[i - 1] != ids[j - 1])
    start, length, period = i[whole], length[whole], period[whole]
    order = np.lexsort((period, start))
    return start[order], length[order], period[order]


def _find_task(least_length: int, least_exponent: int):
    @ws.released
    def find(batches):
        for batch in batches:
            for first, last, data, starts in ws.blocks(batch.column(1)):
                begins, ends, firsts = ws.words(data, starts, ws.WHITE)
                start, length, period = runs_of(word_numbers(data, begins, ends), firsts, least_length, least_exponent)
                text = np.searchsorted(firsts, start, "right") - 1
                counts = np.bincount(text, minlength=last - first)
                own = pa.StructArray.from_arrays([pa.array(x) for x in (start - firsts[text], length, period)], fields=list(RUN))
                # strongest of each text: ties go to the first in order
                order = np.lexsort((np.arange(len(text)), -(length / period), text))
                best = np.full(last - first, -1)
                best[text[order[::-1]]] = order[::-1]
                strongest = own.take(pa.array(best, mask=best < 0))
                # places that repeat what stands a period before them
                edge = np.zeros(len(begins) + 1, np.int64)
                np.add.at(edge, start + period, 1)
                np.add.at(edge, start + length, -1)
                keep = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                sizes = ends[keep] - begins[keep] + 1  # with a space after each word
                spaced = np.r_[data, np.uint8(32)][ws.ragged(begins[keep], sizes)]
                after = np.cumsum(sizes)
                spaced[after - 1] = 32
                at, raw = np.r_[0, after][np.searchsorted(keep, firsts)], spaced.tobytes()
                collapsed = pa.array([raw[a : max(a, b - 1)] for a, b in zip(at[:-1], at[1:])], pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(np.diff(firsts)), ws.lists_of(own, counts), strongest, collapsed],
                    names=["id", "n_words", "runs", "strongest", "collapsed"],
                )

    return find


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """Per document: ``id_col``, n_words, runs (by start, then period), the strongest of them,
    and the text collapsed to what no run repeats."""
    if least_exponent < 2:
        raise ValueError("a run repeats its period once at least")
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    found = own.mapInArrow(_find_task(least_length, least_exponent), f"id {kind}, n_words long, runs array<{RUN_SQL}>, strongest {RUN_SQL}, collapsed string")
    return found.withColumnRenamed("id", id_col)


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``doc_id`` and text; a tenth of the documents, by a hash of the id, repeats its words from
    some place on with some period."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    split = docs.select("doc_id", "text", h.alias("h"), F.floor(h / 10).alias("g"))
    words: Column = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    split = split.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("words"))
    a = F.col("g") % F.col("n")
    split = split.withColumn("a", F.when(F.col("n") > 0, a).cast("int"))
    period = 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    split = split.withColumn("p", period.cast("int")).withColumn("rest", F.col("n") - F.col("a"))
    unit = F.slice("words", F.col("a") + 1, F.col("p"))
    repeated = F.flatten(F.array_repeat(unit, F.ceil(F.col("rest") / F.col("p")).cast("int")))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), F.col("rest"))), " ")
    return split.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), planted).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, d):
    with text_batches(spark):
        found = find_runs(with_planted_runs(table(spark, d, "documents")))
    top = [F.col(f"strongest.{x}").alias(x) for x in ("start", "length", "period")]
    milli = F.floor(1000 * F.col("strongest.length") / F.col("strongest.period")).alias("exponent_milli")
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n"))))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), *top, milli, F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
