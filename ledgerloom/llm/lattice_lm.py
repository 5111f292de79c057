"""Language-model scores of texts: the marginal probability over all subword segmentations.

A text is its words, lower-cased in A-Z, and one end. The pieces of an existing vocabulary
have unigram probabilities; a word's probability is the sum over all ways to spell it, with
the space symbol before it, from pieces. A character that is no piece is spelt by its bytes.

1. One pass counts every word of the corpus, in all texts and in those to learn from; the
   table of words grows with the corpus and stays in the shared folder.
2. A vocabulary's own scores are the first probabilities: those of a unigram model as they
   are, those of a BPE model, which are ranks, by Zipf's law. Each of ``ROUNDS`` rounds spells
   every learnt word in all ways by them (forward and backward recursion in log space) and
   takes the expected counts of the pieces, with ``PRIOR`` counts of the first probabilities.
   The driver gathers one number a piece, whatever the corpus.
3. The forward recursion gives every distinct word its probability, once.
4. A second pass over the texts adds up the words' terms. The words with at least one in
   ``FREQUENT`` of all tokens, thus at most that many, travel with the tasks; all others are
   joined by word, so no key holds more than that share of the tokens.

Words of a lattice go through the recursions together, one position a step; a word of more
than ``LONG`` characters goes through alone, its arcs in pieces of that length. No piece of
a word vocabulary crosses a space; those that do are left out (``crossing``).

Defined results: a null or empty text is its end alone; without texts to learn from the base
score is log10 of 1/(0 + 1) = 0 a token and the model keeps its first probabilities; texts
of null id are scored, not learnt from; equal rows are scored one by one; an empty table
gives no rows; other columns are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import wordscan as ws
from ledgerloom.llm.piece_transducer import SPACE, PieceModel
from ledgerloom.llm.tables import Shared, table, text_batches
from ledgerloom.session import written

ROUNDS = 2
PRIOR = 0.01
FREQUENT = 1 << 18
FREQUENT_BYTES = 64
LONG = 1 << 17
ZIPF_SHIFT = 2.7


class Lattice:
    """Pieces as a trie with log probabilities, and the recursions over their lattices."""

    def __init__(self, path: str):
        model = self.model = PieceModel(path)
        n = self.size = len(model.score)
        names = model.pieces
        self.crossing = sum(chr(SPACE) in piece[1:] and bool(piece.strip(chr(SPACE))) for piece in names)
        ids = np.fromiter(names.values(), np.int64, len(names))
        self.spelling = np.r_[ids, np.unique(model.bytes)]  # the pieces that spell
        p = np.zeros(n + 1)  # the last one is the end of a text
        if model.bpe:
            rank = np.argsort(np.argsort(-model.score[ids], kind="stable"))
            p[ids] = 1 / (rank + ZIPF_SHIFT)
        else:
            p[ids] = np.exp(model.score[ids])
        p[np.unique(model.bytes)] = p[n] = p[ids].min()
        self.first = p / p.sum()
        self.weights = np.log(np.maximum(self.first, 1e-300))

    def learn(self, counts: np.ndarray) -> None:
        """Probabilities from expected counts, those of the end last."""
        total = counts.sum()
        if total:
            p = (counts + PRIOR * total * self.first) / (total * (1 + PRIOR))
            self.weights = np.log(np.maximum(p, 1e-300))

    def arcs(self, codes: np.ndarray, ends: np.ndarray, spelt: np.ndarray | None = None):
        """Begin, end, piece and weight of every arc that begins at the positions ``spelt`` (all
        if None); piece -1 - code is a character spelt by bytes. ``ends``: where the word of
        each position ends."""
        at = np.arange(len(codes)) if spelt is None else spelt
        columns = self.model._column(codes)
        node, place = np.zeros(len(at), np.int64), at
        found, alone = [], np.ones(len(codes), bool)
        depth = 0
        while len(at):
            node = self.model.step(node, codes[place], columns[place]).astype(np.int64)
            on = node >= 0
            at, place, node = at[on], place[on], node[on]
            piece = self.model.ends[node]
            whole = piece >= 0
            if not depth:
                alone[at[whole]] = False
            found.append((at[whole], place[whole] + 1, piece[whole]))
            place = place + 1
            on = place < ends[at]
            at, place, node = at[on], place[on], node[on]
            depth += 1
        chars = np.flatnonzero(alone) if spelt is None else spelt[alone[spelt]]
        found.append((chars, chars + 1, -1 - codes[chars]))
        begin, end, piece = (np.concatenate(x) for x in zip(*found))
        weight = self.weights[np.maximum(piece, 0)]
        odd = piece < 0
        if odd.any():
            distinct, back = np.unique(-1 - piece[odd], return_inverse=True)
            weight[odd] = np.array([self.weights[self.model.bytes[list(chr(c).encode())]].sum() for c in distinct])[back]
        return begin, end, piece, weight

    def spread(self, counts: np.ndarray, piece: np.ndarray, amount: np.ndarray) -> None:
        """Adds the amounts of arcs to the counts of their pieces."""
        plain = piece >= 0
        counts += np.bincount(piece[plain], amount[plain], len(counts))
        codes, back = np.unique(-1 - piece[~plain], return_inverse=True)
        for code, n in zip(codes, np.bincount(back, amount[~plain], len(codes))):
            np.add.at(counts, self.model.bytes[list(chr(code).encode())], n)

    def marginals(self, codes: np.ndarray, starts: np.ndarray, times: np.ndarray | None = None, counts: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each word, the code points between two ``starts``.

        With ``counts``: the expected counts of the pieces in all words, the word i
        ``times[i]`` times, are added to it.
        """
        sizes = np.diff(starts)
        out = np.zeros(len(sizes))
        for k in np.flatnonzero(sizes > LONG):
            out[k] = self._long(codes[starts[k] : starts[k + 1]], None if counts is None else times[k], counts)
        short = np.flatnonzero(sizes <= LONG)
        sizes = sizes[short]
        codes = codes[ws.ragged(starts[:-1][short], sizes)]
        ends = np.cumsum(sizes)
        word = np.repeat(np.arange(len(sizes)), sizes)
        begin, end, piece, weight = self.arcs(codes, np.repeat(ends, sizes))
        own = word[begin]
        first = (ends - sizes)[own]
        # a word of n characters has n + 1 places
        a, b = begin + own, end + own
        forward = np.full(len(codes) + len(sizes), -np.inf)
        zero = ends - sizes + np.arange(len(sizes))
        forward[zero] = 0
        self._recur(forward, a, b, weight, end - first)
        out[short] = forward[zero + sizes]
        if counts is not None:
            backward = np.full(len(forward), -np.inf)
            backward[zero + sizes] = 0
            self._recur(backward, b, a, weight, sizes[own] - (begin - first))
            self.spread(counts, piece, np.exp(forward[a] + weight + backward[b] - out[short][own]) * times[short][own])
        return out

    @staticmethod
    def _recur(values: np.ndarray, of: np.ndarray, to: np.ndarray, weight: np.ndarray, step: np.ndarray) -> None:
        """Log sums over the arcs into each place, step by step."""
        order = np.lexsort((to, step))
        of, to, weight, step = of[order], to[order], weight[order], step[order]
        new = np.flatnonzero(np.r_[True, to[1:] != to[:-1]]) if len(to) else np.zeros(0, np.int64)
        last = int(step[-1]) if len(step) else 0
        cuts, firsts = np.searchsorted(step, np.arange(1, last + 2)), np.searchsorted(step[new], np.arange(1, last + 2))
        for k in range(last):
            x, y = cuts[k], cuts[k + 1]
            if x < y:
                heads = new[firsts[k] : firsts[k + 1]]
                values[to[heads]] = np.logaddexp.reduceat(values[of[x:y]] + weight[x:y], heads - x)

    def _long(self, codes: np.ndarray, times: float | None, counts: np.ndarray | None) -> float:
        """The recursions of one word, with the arcs of ``LONG`` positions at a time."""
        n = len(codes)
        ends = np.full(n, n)
        forward = np.full(n + 1, -np.inf)
        forward[0] = 0

        def parts(order):
            for first in order:
                begin, end, piece, weight = self.arcs(codes, ends, np.arange(first, min(n, first + LONG)))
                by = np.argsort(begin, kind="stable")
                begin, end, piece, weight = begin[by], end[by], piece[by], weight[by]
                yield np.r_[np.flatnonzero(np.r_[True, begin[1:] != begin[:-1]]), len(begin)], begin, end, piece, weight

        for heads, begin, end, _, weight in parts(range(0, n, LONG)):
            for x, y in zip(heads[:-1], heads[1:]):
                forward[end[x:y]] = np.logaddexp(forward[end[x:y]], forward[begin[x]] + weight[x:y])
        if counts is not None:
            backward = np.full(n + 1, -np.inf)
            backward[n] = 0
            for heads, begin, end, piece, weight in parts(reversed(range(0, n, LONG))):
                for x, y in zip(heads[-2::-1], heads[:0:-1]):
                    backward[begin[x]] = np.logaddexp.reduce(weight[x:y] + backward[end[x:y]])
                self.spread(counts, piece, np.exp(forward[begin] + weight + backward[end] - forward[n]) * times)
        return forward[n]


def spelt(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of words end to end, the space symbol before each, and their starts."""
    sizes = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    codes = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).astype(np.int64)
    starts = np.r_[0, np.cumsum(sizes)]
    return np.insert(codes, starts[:-1], SPACE), starts + np.arange(len(starts))


def _lowered(data: np.ndarray, starts: np.ndarray):
    """The words of a block as numbers, the distinct words, and the words before each text."""
    data = ws.LOWER[data]
    begins, ends, firsts = ws.words(data, starts, ws.WHITE)
    coded = ws.packed(data, begins, ends).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, firsts


@ws.released
def _count_words(batches):
    for batch in batches:
        learnt = batch.column(0).to_numpy(zero_copy_only=False).astype(bool)
        for first, last, data, starts in ws.blocks(batch.column(1)):
            numbers, words, firsts = _lowered(data, starts)
            own = np.repeat(learnt[first:last], np.diff(firsts))
            every, known = np.bincount(numbers, minlength=len(words)), np.bincount(numbers[own], minlength=len(words))
            yield pa.RecordBatch.from_arrays([words.cast(pa.string()), pa.array(known), pa.array(every)], names=["word", "c", "n"])


def word_counts(docs: DataFrame, learnt: Column, text_col: str = "text") -> DataFrame:
    """Per distinct word: ``c``, its tokens in texts to learn from, and ``n``, those in all texts."""
    with text_batches(docs.sparkSession):
        own = docs.select(F.coalesce(learnt, F.lit(False)).alias("learnt"), F.col(f"`{text_col}`").alias("text"))
        counted = own.mapInArrow(_count_words, "word string, c long, n long")
        return written(counted.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "word-counts")


def _expect(lattice):
    """The expected counts of the pieces in all words of a task."""

    @ws.released
    def expect(batches):
        own = lattice.value
        counts = np.zeros(own.size + 1)
        for batch in batches:
            codes, starts = spelt(batch.column(0))
            own.marginals(codes, starts, batch.column(1).to_numpy().astype(float), counts)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["piece", "amount"])

    return expect


def learn_lattice(counts: DataFrame, ends: int, path: str, rounds: int = ROUNDS) -> Lattice:
    """A lattice whose probabilities come from ``word_counts``; ``ends``: texts to learn from."""
    lattice, spark = Lattice(path), counts.sparkSession
    for _ in range(rounds):
        expected = counts.filter("c > 0").select("word", "c").mapInArrow(_expect(Shared(spark, lattice)), "piece int, amount double")
        rows = expected.groupBy("piece").agg(F.sum("amount").alias("amount")).toArrow()  # one row a piece
        amounts = np.zeros(lattice.size + 1)
        amounts[rows["piece"].to_numpy()] = rows["amount"].to_numpy()
        amounts[-1] = ends
        lattice.learn(amounts)
    return lattice


def _measure(lattice):
    @ws.released
    def measure(batches):
        own = lattice.value
        for batch in batches:
            logs = own.marginals(*spelt(batch.column(0))) / np.log(10)
            yield batch.append_column("log_p", pa.array(logs))

    return measure


class FrequentWords:
    """Words by their hash, with their counts and log probabilities."""

    def __init__(self, words: pa.Array, c: np.ndarray, log_p: np.ndarray):
        keys = self._keys(words)
        order = np.argsort(keys, kind="stable")
        self.keys, self.words, self.c, self.log_p = keys[order], words.take(pa.array(order)), c[order], log_p[order]

    @staticmethod
    def _keys(words: pa.Array) -> np.ndarray:
        words = words.cast(pa.large_binary())
        _, offsets, data = words.buffers()
        offsets = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1] if len(words) else np.zeros(1, np.int64)
        data = np.frombuffer(data or b"", np.uint8)[offsets[0] : offsets[-1]]
        return ws.hashes(data, offsets[:-1] - offsets[0], offsets[1:] - offsets[0])

    def find(self, words: pa.Array) -> np.ndarray:
        """The place of each word, -1 if it is none of these; equal hashes are looked at again."""
        if not len(self.keys) or not len(words):
            return np.full(len(words), -1)
        keys = self._keys(words)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        same = (self.keys[at] == keys) & pc.equal(self.words.take(pa.array(at)), words).to_numpy(zero_copy_only=False)
        return np.where(same, at, -1)


ADDED = "n_tokens long, n_known long, base_score double, score double"


def _add_up(frequent, base_of, end):
    """Per text a row of what the frequent words and the end add, and a row of each other word."""

    @ws.released
    def add_up(batches):
        held = frequent.value
        base = base_of(held.c)
        for batch in batches:
            ids, row = batch.column(0), batch.column(1).to_numpy()
            for first, last, data, starts in ws.blocks(batch.column(2)):
                numbers, words, firsts = _lowered(data, starts)
                words, size = words.cast(pa.large_string()), last - first
                text = np.repeat(np.arange(size), np.diff(firsts))
                at = held.find(words)[numbers]
                known = at >= 0
                sums = [np.bincount(text[known], x[at[known]], size) for x in (held.c > 0, base, held.log_p)]
                n_tokens = np.diff(firsts) + 1
                own = [n_tokens, sums[0].astype(np.int64) + end[0], sums[1] + end[1], sums[2] + end[2]]
                pairs, times = np.unique(text[~known] * max(1, len(words)) + numbers[~known], return_counts=True)
                of, word = np.divmod(pairs, max(1, len(words)))
                none, n = pa.nulls(len(pairs)), len(pairs)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.concat_arrays([pa.array(row[first:last]), pa.array(row[first:last][of])]),
                        pa.concat_arrays([ids.slice(first, size), none.cast(ids.type)]),
                        # no word has a space: these find none, and are spread like words
                        pa.concat_arrays([pa.array([f" {x}" for x in row[first:last].tolist()], pa.string()), words.take(pa.array(word)).cast(pa.string())]),
                        pa.concat_arrays([pa.array(np.zeros(size, np.int64)), pa.array(times.astype(np.int64))]),
                        *(pa.concat_arrays([pa.array(x), none.cast(pa.array(x).type)]) for x in own),
                    ],
                    names=["row", "id", "word", "times", "n_tokens", "n_known", "base_score", "score"],
                )

    return add_up


def score_texts(docs: DataFrame, path: str, learnt: Column, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, frequent: int = FREQUENT) -> DataFrame:
    """Per document: ``id_col``, n_tokens, n_known, train_tokens, base_score and score (log10).

    ``learnt``: whether a row of ``docs`` may be learnt from.
    """
    spark = docs.sparkSession
    counts = word_counts(docs, learnt, text_col)
    ends = docs.filter(F.coalesce(learnt, F.lit(False))).count()
    totals = counts.agg(F.sum("c"), F.count_if(F.col("c") > 0), F.sum("n")).first()
    learnt_words, distinct, every = (int(x or 0) for x in totals)
    n, v = learnt_words + ends, distinct + (ends > 0)
    lattice = learn_lattice(counts, ends, path, rounds)
    measured = written(counts.mapInArrow(_measure(Shared(spark, lattice)), "word string, c long, n long, log_p double"), "words")
    # at most `frequent` words of bounded length
    often = measured.filter((F.col("n") * frequent >= every) & (F.octet_length("word") <= FREQUENT_BYTES)).select("word", "c", "log_p").toArrow()
    words = often["word"].combine_chunks() if often.num_rows else pa.array([], pa.string())
    held = Shared(spark, FrequentWords(words.cast(pa.large_string()), often["c"].to_numpy(), often["log_p"].to_numpy()))

    def base_of(c):
        return np.log10((c + 1) / (n + v + 1))

    end = (int(ends > 0), float(base_of(ends)), float(lattice.weights[-1] / np.log(10)))
    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(f"`{id_col}`").alias("id"), F.monotonically_increasing_id().alias("row"), F.col(f"`{text_col}`").alias("text"))
    with text_batches(spark):
        parts = own.mapInArrow(_add_up(held, base_of, end), f"row long, id {kind}, word string, times long, {ADDED}")
        terms = measured.select("word", "c", "log_p").hint("merge")
        met = parts.join(terms, "word", "left")
        times, c = F.col("times"), F.col("c")
        met = met.select(
            "row",
            "id",
            "n_tokens",
            F.coalesce("n_known", F.when(c > 0, times)).alias("n_known"),
            F.coalesce("base_score", times * F.log10((c + 1) / F.lit(float(n + v + 1)))).alias("base_score"),
            F.coalesce("score", times * F.col("log_p")).alias("score"),
        )
        sums = [F.sum(x).alias(x) for x in ("n_tokens", "n_known", "base_score", "score")]
        scored = met.groupBy("row").agg(F.max("id").alias("id"), *sums)
    scored = scored.withColumn("train_tokens", F.lit(n).cast("long"))
    return scored.select(F.col("id").alias(id_col), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op13_lattice_lm(spark, d):
    import public_tokenizers

    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    scored = score_texts(table(spark, d, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ~held_out)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
