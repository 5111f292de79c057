"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

1. Labelled rows: of each label at most ``examples`` ids, those of the smallest hashes; then
   their distinct texts, at most ``examples`` of each label, and of these, label by label in
   turn, as many as have ``POSTINGS`` distinct terms together. These are the documented
   bounds of what is fitted; the share of each label is counted over all labelled rows.
2. Terms are all words of the examples. Document frequencies are counted over all documents
   in one pass over their whole texts.
3. The examples' unit vectors stand in a block-max inverted index: examples in blocks of
   ``BLOCK``, similar ones together; a term's postings by block, each block with the term's
   largest weight in it. A text's bound for a block is the sum of those maxima. Blocks are
   read by descending bounds until none left can reach the k-th best cosine; the others are
   skipped. The postings of terms that over ``DENSE_SHARE`` of the examples have would be no
   shorter than a matrix; they stand as one, and its product with many texts at once
   is part of the bounds, in single precision. What is within the error of that (``MARGIN``)
   is scored again, so the k nearest are exact (ties to the earlier example).
4. The neighbours vote for their labels, each for the labelled rows that it stands for. The
   weight of a vote is the part of the cosine that comes from terms telling the labels
   apart (by ``TELLING`` at least), and ``PLAIN`` of the fourth power of the whole cosine; there are ``PRIOR_VOTES``
   of the label's overall share besides. A logistic curve fitted on the examples' own votes,
   each without its own id, turns votes into probabilities. The neighbours are given as
   evidence.

Texts are read twice and nothing of their size is written. The tasks get the index as a
broadcast of at most ``POSTINGS`` postings.

Defined results: a null or empty text, or one that shares no term with any example, gets the
score of the overall share; rows without a label or of null id are no examples; several
labels of one document each count, the same label of it once; rows of the same id and text
are one example, different texts of one id are several; no document is held against
examples of its own id, as those were not when the curve was fitted; without both labels among the
examples every score is the overall share (0 without labels); rows of the same id are
scored one by one; an empty table gives no rows; other columns are not used, whatever they
are called.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import wordscan as ws
from ledgerloom.llm.tables import Shared, first_of_each, table, text_batches, without_texts
from ledgerloom.session import written

EXAMPLES = 4096
POSTINGS = 4_000_000
HALF_CHI2 = 40.0
TELLING = 0.01
BLOCK = 32
FIRST_BLOCKS = 24
DENSE_SHARE = 0.06
DENSE_TERMS = 2048
MARGIN = 1e-5
TOGETHER = 64
VOTES_TASK = 1024
NEIGHBOURS = 50
PRIOR_VOTES = 0.02
PLAIN = 0.1

_U = np.uint64
# letters a-z, digits and whatever isn't ASCII make up words
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True


def _terms(texts: pa.Array):
    """Per block: first row, the terms end to end, and the row of each (from 0)."""
    for first, _, data, starts in ws.blocks(texts):
        data = ws.LOWER[data]
        begins, ends = ws.runs(_INSIDE[data], starts)
        yield first, ws.hashes(data, begins, ends), np.searchsorted(starts, begins, "right") - 1


class Vocabulary:
    """The places of known terms, sorted hashes, by their first bits."""

    def __init__(self, terms: np.ndarray):
        self.size, bits = len(terms), min(22, max(1, len(terms).bit_length()))
        self.terms, self.shift = np.r_[terms, ~_U(0)], _U(64 - bits)
        self.first = np.searchsorted(terms, np.arange(1 << bits).astype(_U) << self.shift).astype(np.int32)

    def find(self, terms: np.ndarray) -> np.ndarray:
        """The place of each term, -1 if it is not known."""
        found, open_ = np.full(len(terms), -1), np.arange(len(terms))
        at = self.first[terms >> self.shift]
        while len(open_):
            held = self.terms[at]
            same = (held == terms) & (at < self.size)
            found[open_[same]] = at[same]
            on = held < terms
            open_, at, terms = open_[on], at[on] + 1, terms[on]
        return found

    def bags(self, texts: pa.Array):
        """Per block: the row, place and count of each known term of each text, in order."""
        for first, terms, rows in _terms(texts):
            at = self.find(terms)
            hit = at >= 0
            every, counts = np.unique(rows[hit] * max(1, self.size) + at[hit], return_counts=True)
            yield first + every // max(1, self.size), every % max(1, self.size), counts


@ws.released
def _bags_of_examples(batches):
    """The distinct terms of each text and how often it has them."""
    for batch in batches:
        keys, counts, sizes = [np.zeros(0, _U)], [np.zeros(0, np.int32)], np.zeros(batch.num_rows, np.int64)
        for first, terms, rows in _terms(batch.column(3)):
            order = np.lexsort((terms, rows))
            terms, rows = terms[order], rows[order]
            new = np.flatnonzero(np.r_[True, (terms[1:] != terms[:-1]) | (rows[1:] != rows[:-1])]) if len(terms) else np.zeros(0, np.int64)
            keys.append(terms[new])
            counts.append(np.diff(np.r_[new, len(terms)]).astype(np.int32))
            sizes += np.bincount(first + rows[new], minlength=batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], ws.lists(np.concatenate(keys).view(np.int64), sizes), ws.lists(np.concatenate(counts), sizes)], names=["doc_id", "label", "text_hash", "terms", "counts"])


def together(ends: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """An order of the vectors in which those that share terms stand near each other."""
    some = np.flatnonzero(ends[:-1] < ends[1:])
    keys = np.zeros((2, len(ends) - 1), _U)
    for k, key in enumerate(keys):
        key[some] = np.minimum.reduceat(ws.mix(terms.astype(_U) * _U(2) + _U(k + 1)), ends[some]) if len(some) else 0
    return np.lexsort((np.arange(len(ends) - 1), keys[1], keys[0]))


class Examples:
    """A block-max inverted index of labelled unit vectors.

    ``read`` and ``blocks`` count the blocks read so far and those there were to read;
    ``telling``: how far each term tells the labels apart.
    """

    def __init__(self, postings: list[np.ndarray], labels: np.ndarray, stands_for: np.ndarray, share: float, n_terms: int, telling: np.ndarray | None = None, order: np.ndarray | None = None):
        """``postings``: places, terms and weights, by term, then by place, which are taken out of
        the list to let them go; ``order``: the example at each place, its own number if not given."""
        places, terms, weights = postings
        postings.clear()
        self.labels, self.stands_for, self.share = labels, stands_for, share
        self.telling = np.zeros(n_terms) if telling is None else telling
        n = len(labels)
        self.order = np.arange(n) if order is None else order
        self.place = np.argsort(self.order)
        self.n_blocks = -(-n // BLOCK)
        have = np.bincount(terms, minlength=n_terms)
        often = np.argsort(-have, kind="stable")[:DENSE_TERMS]
        often = often[have[often] > DENSE_SHARE * n]
        self.column = np.full(n_terms, -1, np.int32)
        self.column[often] = np.arange(len(often))
        # the postings of the terms that tell the labels apart, for the votes
        apart = np.flatnonzero((self.telling >= TELLING)[terms])
        self.told = self.order[places[apart]]
        self.told_weight = weights[apart] * self.telling[terms[apart]]
        self.told_begin = np.r_[0, np.cumsum(np.bincount(terms[apart], minlength=n_terms))]
        # those of the frequent terms, as a matrix and by example
        rare = (self.column < 0)[terms]
        common = np.flatnonzero(~rare)
        at, column = places[common], self.column[terms[common]]
        self.dense = np.zeros((len(often), self.n_blocks * BLOCK), np.float32)
        self.dense[column, at] = weights[common]
        by_place = np.argsort(at, kind="stable")
        self.common, self.common_weight = column[by_place].astype(np.int16), weights[common[by_place]]
        self.common_begin = np.r_[0, np.cumsum(np.bincount(at, minlength=self.n_blocks * BLOCK))]
        del common, at, column, by_place
        self.at, self.weight, of = places[rare], weights[rare], terms[rare]
        del places, weights, terms, rare
        # the postings of a term in a block, and the largest weight among them, rounded up
        block = (self.at // BLOCK).astype(np.int32)
        new = np.ones(len(of), bool)
        new[1:] = (block[1:] != block[:-1]) | (of[1:] != of[:-1])
        new = np.flatnonzero(new).astype(np.int32)
        self.entry_block, self.entry_begin = block[new].astype(np.min_scalar_type(self.n_blocks)), new
        self.entry_size = np.diff(np.r_[new, len(of)]).astype(np.min_scalar_type(BLOCK))
        self.begin = np.r_[0, np.cumsum(np.bincount(of[new], minlength=n_terms))]
        del block, of
        self.entry_most = np.nextafter(np.maximum.reduceat(self.weight, new).astype(np.float32), np.float32(2)) if len(new) else np.zeros(0, np.float32)
        self.n_terms, self.slope, self.offset = n_terms, 1.0, 0.0
        self.read = self.blocks = 0

    @classmethod
    def of(cls, vectors: list[tuple[np.ndarray, np.ndarray]], *args, **options) -> Examples:
        """An index of (terms, weights), one pair for each example."""
        ends = np.r_[0, np.cumsum([len(t) for t, _ in vectors])].astype(np.int64)
        terms, weights = (np.concatenate([v[k] for v in vectors] or [np.zeros(0)]) for k in (0, 1))
        terms = terms.astype(np.int32)
        order = together(ends, terms)
        places = np.repeat(np.argsort(order), np.diff(ends))
        by_term = np.lexsort((places, terms))
        return cls([places[by_term], terms[by_term], weights[by_term]], *args, order=order, **options)

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the highest cosine above 0, and the cosines."""
        return next(self.nearest_of(np.r_[0, len(terms)], terms, weights, k, [[without] if without >= 0 else []]))[:2]

    def nearest_of(self, ends: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, without=None):
        """``nearest`` of many vectors, end to end, with the part of each cosine that tells the
        labels apart; vector i lies from ``ends[i]`` to ``ends[i + 1]`` and is not held against
        the examples ``without[i]``."""
        column = self.column[terms]
        for a in range(0, len(ends) - 1, TOGETHER):
            b = min(len(ends) - 1, a + TOGETHER)
            inside = np.flatnonzero(column[ends[a] : ends[b]] >= 0) + ends[a]
            asked = np.zeros((b - a, len(self.dense)))
            asked[np.searchsorted(ends[a : b + 1], inside, "right") - 1, column[inside]] = weights[inside]
            about = asked.astype(np.float32) @ self.dense
            for i in range(a, b):
                own, w = terms[ends[i] : ends[i + 1]], weights[ends[i] : ends[i + 1]]
                rare = column[ends[i] : ends[i + 1]] < 0
                places = self.place[without[i]] if without is not None and len(without[i]) else []
                found, exact = self._read(about[i - a], asked[i - a], own[rare], w[rare], k, places)
                counts = self.told_begin[own + 1] - self.told_begin[own]
                told = ws.ragged(self.told_begin[own], counts)
                telling = np.bincount(self.told[told], self.told_weight[told] * np.repeat(w, counts), len(self.labels))[found]
                yield found, exact, telling

    def _read(self, about: np.ndarray, asked: np.ndarray, terms: np.ndarray, weights: np.ndarray, k: int, without) -> tuple[np.ndarray, np.ndarray]:
        """The k nearest examples and their cosines. ``about`` holds the part of the frequent
        terms ``asked`` in single precision; that of ``terms`` is read block by block."""
        counts = self.begin[terms + 1] - self.begin[terms]
        entries, weight = ws.ragged(self.begin[terms], counts), np.repeat(weights.astype(np.float32), counts)
        owner = np.repeat(np.arange(len(terms), dtype=np.int32), counts)
        blocks = self.entry_block[entries]
        bounds = about.reshape(-1, BLOCK).max(axis=1) + np.bincount(blocks, self.entry_most[entries] * weight, self.n_blocks)
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]  # a block of bound 0 shares no term
        seen, rare = np.zeros(self.n_blocks, bool), np.zeros(len(about))
        least, done, step = 0.0, 0, FIRST_BLOCKS
        while done < len(order):
            now = order[done : done + step]
            now = now[bounds[now] >= least - MARGIN]
            if not len(now):
                break
            chosen = np.zeros(self.n_blocks, bool)
            chosen[now] = True
            mine = np.flatnonzero(chosen[blocks])
            hit, of = entries[mine], owner[mine]
            sizes = self.entry_size[hit].astype(np.int64)
            postings = ws.ragged(self.entry_begin[hit], sizes)
            rare += np.bincount(self.at[postings], self.weight[postings] * np.repeat(weights[of], sizes), len(rare))
            seen |= chosen
            held = about + rare
            held[without] = 0
            some = held.reshape(-1, BLOCK)[seen].ravel()
            least = np.partition(some, len(some) - k)[len(some) - k] if len(some) > k else 0.0
            done, step = done + len(now), 8 * step
        self.read, self.blocks = self.read + done, self.blocks + self.n_blocks
        if not done:
            return np.zeros(0, np.int64), np.zeros(0)
        at = np.flatnonzero(np.repeat(seen, BLOCK) & (held > 0) & (held >= least - MARGIN))
        sizes = self.common_begin[at + 1] - self.common_begin[at]
        common = ws.ragged(self.common_begin[at], sizes)
        dense = np.bincount(np.repeat(np.arange(len(at)), sizes), self.common_weight[common] * asked[self.common[common]], len(at))
        found, exact = self.order[at], (rare[at] + dense).round(12)
        first = np.lexsort((found, -exact))[:k]
        return found[first], exact[first]

    def vote(self, found: np.ndarray, cosines: np.ndarray, telling: np.ndarray) -> float:
        weight = (telling + PLAIN * cosines**4) * self.stands_for[found]
        weight = weight / (self.stands_for[found].mean() if len(found) else 1.0)
        return float((weight @ self.labels[found] + PRIOR_VOTES * self.share) / (weight.sum() + PRIOR_VOTES))

    def probability(self, vote: np.ndarray) -> np.ndarray:
        vote = np.clip(vote, 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(vote / (1 - vote)) + self.offset)))

    def calibrate(self, votes: np.ndarray) -> None:
        """Newton's method for the logistic curve over the examples' votes."""
        x = np.clip(votes, 1e-6, 1 - 1e-6)
        x = np.stack([np.log(x / (1 - x)), np.ones(len(x))], axis=1)
        w = self.stands_for / self.stands_for.sum() * len(votes)
        # smoothed targets and a small penalty keep the curve finite where labels are split cleanly
        y = np.where(self.labels == 1, 1 - 1e-3, 1e-3)
        beta = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ beta))
            gradient = x.T @ (w * (y - p)) - 0.01 * (beta - [1, 0])
            step = np.linalg.solve((x * (w * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2), gradient)
            beta += np.clip(step, -1, 1)
            if np.abs(step).max() < 1e-9:
                break
        if beta[0] > 0:
            self.slope, self.offset = beta


def unit_vectors(rows: np.ndarray, terms: np.ndarray, counts: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The weights of the terms of ``n`` texts, each text's of length 1."""
    # in place: the index is built of millions of them
    weights = np.log(counts)
    weights += 1
    weights *= weight[terms]
    weights /= np.sqrt(np.bincount(rows, weights * weights, n))[rows]
    return weights


def same_id(ids: pa.Array, example_ids: np.ndarray) -> list[np.ndarray]:
    """The examples of each id."""
    order = np.argsort(example_ids, kind="stable")
    asked, held = ids.fill_null(0).to_numpy(zero_copy_only=False), example_ids[order]
    ends = np.where(ids.is_valid().to_numpy(zero_copy_only=False), np.searchsorted(held, asked, "right"), 0)
    return [order[a:b] for a, b in zip(np.searchsorted(held, asked), ends)]


def _docs_with(vocabulary):
    """How many of a task's texts have each term, and (term -1) how many texts there are."""

    @ws.released
    def count(batches):
        known, n = vocabulary.value, 0
        total = np.zeros(known.size, np.int64)
        for batch in batches:
            n += batch.num_rows
            for _, terms, _ in known.bags(batch.column(0)):
                total += np.bincount(terms, minlength=known.size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": np.r_[-1, at].astype(np.int32), "n": np.r_[n, total[at]]})

    return count


class Model:
    """What the tasks build the index from, packed; examples stand in the order of the blocks."""

    def __init__(self, places: np.ndarray, terms: np.ndarray, counts: np.ndarray, weight: np.ndarray, labels: np.ndarray, stands_for: np.ndarray, share: float, telling: np.ndarray):
        # postings by term, then by place
        self.have = np.bincount(terms, minlength=len(weight)).astype(np.int32)
        self.packed = [zlib.compress(x.astype(np.int32).tobytes(), 1) for x in (places, counts)]
        self.weight, self.labels, self.stands_for, self.share, self.telling = weight, labels, stands_for, share, telling
        self.slope, self.offset = 1.0, 0.0

    def postings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, terms and weights, by term."""
        places, counts = (np.frombuffer(zlib.decompress(x), np.int32) for x in self.packed)
        terms = np.repeat(np.arange(len(self.have), dtype=np.int32), self.have)
        return places, terms, unit_vectors(places, terms, counts, self.weight, len(self.labels))

    def index(self, asked: np.ndarray | None = None) -> tuple[Examples, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The index, and of the examples ``asked`` (a run of places) the sizes, terms and weights
        of their vectors. The packed postings go, as a task needs them once."""
        places, terms, weights = self.postings()
        self.packed, mine = [], np.zeros(0, np.int64)
        if asked is not None:
            mine = np.flatnonzero((places >= asked[0]) & (places <= asked[-1]))
            mine = mine[np.argsort(places[mine], kind="stable")]  # by example, then by term
        sizes = np.bincount(places[mine] - asked[0], minlength=len(asked)) if len(mine) else np.zeros(0 if asked is None else len(asked), np.int64)
        own = sizes, terms[mine], weights[mine]
        postings = [places, terms, weights]
        del places, terms, weights, mine
        index = Examples(postings, self.labels, self.stands_for, self.share, len(self.weight), self.telling)
        index.slope, index.offset = self.slope, self.offset
        ws.give_back()
        return index, own


def _score(vocabulary, model, example_ids, k: int):
    @ws.released
    def score(batches):
        known, ids, built = vocabulary.value, example_ids.value, model.value
        (examples, _), weights_of = built.index(), built.weight
        plain = float(examples.probability(np.array([examples.share]))[0]) if len(examples.labels) else examples.share
        kind = pa.struct([("example", pa.int64()), ("label", pa.int32()), ("cosine", pa.float64())])
        for batch in batches:
            scores, sizes, near = np.full(batch.num_rows, plain), np.zeros(batch.num_rows, np.int64), [(np.zeros(0, np.int64), np.zeros(0))]
            without = same_id(batch.column(0), ids)
            for rows, terms, counts in known.bags(batch.column(2)) if len(examples.labels) else ():
                some, rows = np.unique(rows, return_inverse=True)
                weights = unit_vectors(rows, terms, counts, weights_of, len(some))
                nearest = examples.nearest_of(np.searchsorted(rows, np.arange(len(some) + 1)), terms, weights, k, [without[i] for i in some])
                for i, (found, cosines, telling) in zip(some, nearest):
                    scores[i] = examples.probability(np.array([examples.vote(found, cosines, telling)]))[0]
                    sizes[i] = len(found)
                    near.append((found, cosines))
            found, cosines = (np.concatenate(x) for x in zip(*near))
            parts = [pa.array(ids[found], pa.int64()) if len(ids) else pa.array([], pa.int64()), pa.array(examples.labels[found].astype(np.int32), pa.int32()), pa.array(cosines, pa.float64())]
            evidence = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.StructArray.from_arrays(parts, fields=list(kind)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), evidence], names=["doc_id", "text_hash", "score", "evidence"])

    return score


def _own_votes(model, example_ids, k: int):
    """Each example's vote without its own id; a task has a run of ``VOTES_TASK`` examples at most."""

    @ws.released
    def vote(batches):
        at, ids = np.concatenate([np.zeros(0, np.int64), *(batch.column(0).to_numpy() for batch in batches)]), example_ids.value
        if len(at):
            index, (sizes, terms, weights) = model.value.index(at)
            found = index.nearest_of(np.r_[0, np.cumsum(sizes)], terms, weights, k, same_id(pa.array(ids[at]), ids))
            yield pa.RecordBatch.from_pydict({"example": at, "vote": np.array([index.vote(*x) if len(x[0]) else index.share for x in found])})

    return vote


def label_weight(ones: np.ndarray, zeros: np.ndarray, n_ones: int, n_zeros: int) -> np.ndarray:
    """How far each term tells the labels apart, from the examples of either label that have it."""
    a, b, n = ones.astype(np.float64), zeros.astype(np.float64), float(n_ones + n_zeros)
    apart = np.abs(np.log((a + 0.5) / (n_ones + 1.0)) - np.log((b + 0.5) / (n_zeros + 1.0)))
    chi2 = n * (a * n_zeros - b * n_ones) ** 2 / (float(max(n_ones, 1)) * max(n_zeros, 1) * (a + b) * np.maximum(n - a - b, 1e-9))
    return apart * (chi2 / (chi2 + HALF_CHI2)) ** 2


def choose_examples(own: DataFrame, known: DataFrame, examples: int) -> DataFrame:
    """doc_id, label, text_hash and text of the examples, at most ``examples`` of each label."""
    # at most 2 * examples rows of three numbers
    chosen = F.broadcast(written(first_of_each(known.distinct(), "label", examples, "doc_id"), "labelled"))
    pairs = written(own.select("doc_id", "text_hash").join(chosen, "doc_id").distinct(), "labelled-texts")
    kept = F.broadcast(written(first_of_each(pairs, "label", examples, "doc_id", "text_hash"), "chosen"))
    same = own.join(kept, ["doc_id", "text_hash"]).select("doc_id", "label", "text_hash", "text")
    return same.groupBy("doc_id", "label", "text_hash").agg(F.first("text").alias("text"))


def _within(label: np.ndarray, sizes: np.ndarray, most: int) -> np.ndarray:
    """The rows that fit into ``most`` terms, taken from both labels in turn."""
    turn = np.empty(len(label), np.int64)
    for one in (0, 1):
        at = np.flatnonzero(label == one)
        turn[at] = np.arange(len(at))
    order = np.lexsort((label, turn))
    fits = np.cumsum(sizes[order]) <= most
    return np.sort(order[fits])


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", examples: int = EXAMPLES, neighbours: int = NEIGHBOURS, postings: int = POSTINGS) -> DataFrame:
    """Per document: ``id_col``, ``text_hash``, ``score`` (0 to 1) and ``evidence``, the nearest
    examples. ``labels``: the rows (``id_col``, ``label_col`` 0 or 1) to learn from."""
    spark = docs.sparkSession
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text_col}`")).alias("text_hash"), F.col(f"`{text_col}`").alias("text"))
    known = labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label")).filter("doc_id is not null and label in (0, 1)")
    totals = dict(known.groupBy("label").count().collect())
    every = sum(totals.values())
    share = totals.get(1, 0) / every if every else 0.0

    with text_batches(spark):
        texts = written(choose_examples(own, known, examples).mapInArrow(_bags_of_examples, "doc_id long, label int, text_hash long, terms array<long>, counts array<int>"), "examples")
    # at most 2 * examples rows of four numbers; then the terms of those that fit, at most `postings`
    order = (F.xxhash64("doc_id"), "doc_id", "text_hash", "label")
    sized = texts.select("doc_id", "label", "text_hash", F.size("terms").alias("size")).orderBy(*order).toArrow()
    label, ids, sizes = (sized[x].to_numpy().astype(np.int64) for x in ("label", "doc_id", "size"))
    fits = _within(label, sizes, postings)
    if len(fits) < len(label):
        numbers = pa.Table.from_pydict({"doc_id": ids[fits], "label": label[fits].astype(np.int32), "text_hash": sized["text_hash"].to_numpy()[fits]})
        texts = texts.join(F.broadcast(spark.createDataFrame(numbers)), ["doc_id", "label", "text_hash"], "left_semi")
    label, ids, sizes = label[fits], ids[fits], sizes[fits]
    by_label = np.bincount(label, minlength=2)
    if by_label.min() == 0:  # nothing to tell apart
        label, ids, sizes = label[:0], ids[:0], sizes[:0]
        terms, counts = np.zeros(0, _U), np.zeros(0, np.int32)
    else:
        near = texts.orderBy(*order).select("terms", "counts").toArrow()
        terms = near["terms"].combine_chunks().flatten().to_numpy().view(_U)
        counts = near["counts"].combine_chunks().flatten().to_numpy()
        del near
    rows = np.repeat(np.arange(len(label), dtype=np.int32), sizes)
    hashes = np.unique(terms)
    terms = np.searchsorted(hashes, terms).astype(np.int32)
    vocabulary = Shared(spark, Vocabulary(hashes))

    with text_batches(spark):
        per_term = own.select("text").mapInArrow(_docs_with(vocabulary), "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # one row a term
    at, n = per_term["term"].to_numpy(), per_term["n"].to_numpy()
    n_docs, docs_with = int(n[at < 0].sum()), np.zeros(len(hashes))
    docs_with[at[at >= 0]] = n[at >= 0]
    ones = np.bincount(terms[label[rows] == 1], minlength=len(hashes))
    telling = label_weight(ones, np.bincount(terms, minlength=len(hashes)) - ones, *(int(x) for x in by_label[::-1]))
    weight = np.log((1 + n_docs) / (1 + docs_with)) + 1

    # similar examples stand together, and their postings by term
    ends = np.r_[0, np.cumsum(sizes)]
    order = together(ends, terms)
    label, ids = label[order], ids[order]
    places = np.argsort(order).astype(np.int32)[rows]
    by_term = np.lexsort((places, terms))
    stands_for = np.array([totals[x] / by_label[x] for x in label], np.float64)
    model = Model(places[by_term], terms[by_term], counts[by_term], weight, label.astype(np.float64), stands_for, share, telling)
    del rows, places, terms, counts, by_term
    if len(label):
        # every task builds the index first
        asked = spark.range(0, len(label), 1, -(-len(label) // VOTES_TASK))
        votes = asked.mapInArrow(_own_votes(Shared(spark, model), Shared(spark, ids), neighbours), "example long, vote double").toArrow().sort_by("example")
        none = np.zeros(0, np.int32)
        curve = Examples([none, none, none], model.labels, stands_for, share, 0)
        curve.calibrate(votes["vote"].to_numpy())
        model.slope, model.offset = float(curve.slope), float(curve.offset)
    shared = vocabulary, Shared(spark, model), Shared(spark, ids)
    scored = own.mapInArrow(_score(*shared, neighbours), "doc_id long, text_hash long, score double, evidence array<struct<example: long, label: int, cosine: double>>")
    return scored.withColumnRenamed("doc_id", id_col)


def _fold(id_col: str, folds: int) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5, **options) -> DataFrame:
    """``docs`` without those of a score of ``least`` or more, all columns kept."""
    bad = score_toxicity(docs, labels, id_col, text_col, **options).filter(F.col("score") >= least)
    with text_batches(docs.sparkSession):  # all texts are scored within it
        return without_texts(docs, bad.select(F.col(f"`{id_col}`").alias("id"), "text_hash"), id_col, text_col)


def training_labels(labels: DataFrame) -> DataFrame:
    """The rows that may be learnt from: a fifth of the ids is held out."""
    return labels.filter(_fold("doc_id", 5) != 0)


def op10_toxicity(spark, d):
    scored = score_toxicity(table(spark, d, "documents"), training_labels(table(spark, d, "labels")))
    held_out = F.coalesce(_fold("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
