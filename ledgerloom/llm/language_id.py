"""Language of texts by a bidirectional gated recurrent network over bytes, in numpy.

Texts are cut into windows of ``WINDOW`` bytes. Two recurrent layers read each window, one
from each end; from both states every position gets a probability of each language. A
document's probabilities are the mean over all its positions, so whole texts count and
very long ones are just more windows. Windows of many documents go through the network
together, one step per position.

The network is trained by backpropagation through time on the driver, on a bounded sample:
per language at most ``DOCS`` different documents (id and text), the first in order of a hash
of these, and of each at most ``WINDOWS_PER_DOC`` windows spread over it.

Defined results: null texts and texts without a letter are ``und`` with score 0; so is
every text if nothing is known to learn from; documents without a language or of null id
are not learnt from; a tie goes to the language that comes first by name; rows of the same
id are labelled one by one; an empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import wordscan as ws
from ledgerloom.llm.tables import Shared, first_of_each, small, table
from ledgerloom.session import written

WINDOW = 96
HIDDEN = 8
DOCS = 600
WINDOWS_PER_DOC = 8
STEPS = 400
BATCH = 128
RATE = 0.02
BATCH_WINDOWS = 4096


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


class Network:
    """Parameters: per direction byte inputs, recurrent weights; one output layer for both."""

    def __init__(self, n_labels: int, hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        h = self.hidden = hidden
        self.p = {}
        for d in ("f", "b"):
            self.p[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32)
            self.p[f"u{d}"] = (rng.normal(0, 1, (h, 3 * h)) / np.sqrt(h)).astype(np.float32)
            self.p[f"x{d}"][:, :h] -= 1.0  # slow at first: states last longer
        self.p["v"] = rng.normal(0, 0.3, (2 * h, n_labels)).astype(np.float32)
        self.p["c"] = np.zeros(n_labels, np.float32)

    def _layer(self, d: str, codes: np.ndarray, valid: np.ndarray | None, keep: bool):
        """States of one direction over (positions, windows); gates too if ``keep``."""
        h, x, u = self.hidden, self.p[f"x{d}"], self.p[f"u{d}"]
        steps, n = codes.shape
        states = np.zeros((steps + 1, n, h), np.float32)
        gates = np.zeros((steps, n, 4 * h), np.float32) if keep else None
        order = range(steps) if d == "f" else range(steps - 1, -1, -1)
        uz, un = np.ascontiguousarray(u[:, : 2 * h]), np.ascontiguousarray(u[:, 2 * h :])
        last = states[steps]  # zeros
        for t in order:
            a = x[codes[t]]
            zr = _sigmoid(a[:, : 2 * h] + last @ uz)
            z, r = zr[:, :h], zr[:, h:]
            m = last @ un
            new = np.tanh(a[:, 2 * h :] + r * m)
            state = states[t]
            np.subtract(last, new, out=state)
            state *= z
            state += new
            if valid is not None:
                state *= valid[t][:, None]
            if keep:
                gates[t] = np.concatenate([zr, new, m], axis=1)
            last = state
        return states, gates

    def forward(self, codes: np.ndarray, valid: np.ndarray | None = None, keep: bool = False):
        """Probabilities of every position, (positions, windows, labels)."""
        steps, n = codes.shape
        f, gf = self._layer("f", codes, valid, keep)
        b, gb = self._layer("b", codes, valid, keep)
        both = np.concatenate([f[:steps], b[:steps]], axis=2).reshape(steps * n, -1)
        logits = both @ self.p["v"] + self.p["c"]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        probabilities = logits.reshape(steps, n, -1)
        return (probabilities, both, (f, gf), (b, gb)) if keep else probabilities

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Backpropagation through time of the mean cross entropy of all positions."""
        steps, n = codes.shape
        h = self.hidden
        probabilities, both, f, b = self.forward(codes, keep=True)
        error = probabilities.reshape(steps * n, -1).copy()
        error[np.arange(steps * n), np.tile(labels, steps)] -= 1
        error /= steps * n
        grads = {"v": both.T @ error, "c": error.sum(0)}
        into = (error @ self.p["v"].T).reshape(steps, n, 2 * h)
        for d, (states, gates), own in (("f", f, into[:, :, :h]), ("b", b, into[:, :, h:])):
            u = self.p[f"u{d}"]
            back = range(steps - 1, -1, -1) if d == "f" else range(steps)
            d_inputs = np.zeros((steps, n, 3 * h), np.float32)
            d_u = np.zeros_like(u)
            later = np.zeros((n, h), np.float32)
            for t in back:
                t_last = (t - 1 if t else steps) if d == "f" else t + 1  # the row of zeros at the ends
                last = states[t_last]
                z, r, new, m = (gates[t][:, i * h : (i + 1) * h] for i in range(4))
                d_state = own[t] + later
                d_new = d_state * (1 - z) * (1 - new * new)
                d_z = d_state * (last - new) * z * (1 - z)
                d_r = d_new * m * r * (1 - r)
                d_m = d_new * r
                d_zr = np.concatenate([d_z, d_r], axis=1)
                d_inputs[t] = np.concatenate([d_zr, d_new], axis=1)
                d_u[:, : 2 * h] += last.T @ d_zr
                d_u[:, 2 * h :] += last.T @ d_m
                later = d_state * z + d_zr @ u[:, : 2 * h].T + d_m @ u[:, 2 * h :].T
            d_x = np.zeros_like(self.p[f"x{d}"])
            np.add.at(d_x, codes.reshape(-1), d_inputs.reshape(steps * n, -1))
            grads[f"x{d}"], grads[f"u{d}"] = d_x, d_u
        return grads

    def train(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 8) -> None:
        """Adam on batches in which every label is as frequent; ``windows``: (n, WINDOW) bytes."""
        rng = np.random.default_rng(seed)
        own = [np.flatnonzero(labels == k) for k in range(self.p["c"].size)]
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            chosen = np.concatenate([rng.choice(x, -(-batch // len(own))) for x in own])
            grads = self.gradients(np.ascontiguousarray(windows[chosen].T), labels[chosen])
            size = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for k, g in grads.items():
                g = g * min(1.0, 1.0 / max(size, 1e-12))
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.p[k] -= now * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)


def _sample_windows(window: int, per_doc: int):
    """Windows spread evenly over each text, with the text's label."""

    @ws.released
    def sample(batches):
        for batch in batches:
            languages, texts = batch.column(0).to_pylist(), batch.column(1)
            out = []
            for language, text in zip(languages, texts):
                data = text.as_buffer().to_pybytes()
                n = max(1, min(per_doc, len(data) // window))
                for start in np.linspace(0, max(0, len(data) - window), n).astype(int):
                    out.append((language, data[start : start + window].ljust(window)))
            if out:
                a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, pa.binary())], names=["lang", "piece"])

    return sample


def has_letter(texts: list[bytes]) -> np.ndarray:
    return np.array([any(map(str.isalpha, t.decode())) for t in texts], bool)


def document_probabilities(network: Network, texts: pa.Array, window: int = WINDOW):
    """Per block of texts: first and last row, bytes, starts, and mean probabilities."""
    for first, last, data, starts in ws.blocks(texts):
        lengths = np.diff(starts)
        counts = -(-lengths // window)
        owner = np.repeat(np.arange(last - first), counts)
        begin = np.repeat(starts[:-1] - (np.cumsum(counts) - counts) * window, counts) + np.arange(len(owner)) * window
        sums = np.zeros((last - first, network.p["c"].size))
        padded = np.r_[data, np.zeros(window, np.uint8)]
        for a in range(0, len(owner), BATCH_WINDOWS):
            at, whose = begin[a : a + BATCH_WINDOWS], owner[a : a + BATCH_WINDOWS]
            places = np.arange(window)[:, None] + at[None, :]
            valid = places < starts[whose + 1][None, :]
            # full windows need no mask
            for rows, mask in ((valid[-1], None), (~valid[-1], valid)):
                if not rows.any():
                    continue
                codes = padded[places[:, rows]]
                if mask is None:
                    total = network.forward(codes).sum(0)
                else:
                    own = mask[:, rows].astype(np.float32)
                    total = (network.forward(codes, own) * own[:, :, None]).sum(0)
                np.add.at(sums, whose[rows], total)
        yield first, last, data, starts, sums / np.maximum(lengths, 1)[:, None]


def _label(network, languages: list[str]):
    @ws.released
    def label(batches):
        model = network.value
        for batch in batches:
            for first, last, data, starts, means in document_probabilities(model, batch.column(1)) if model else _blank(batch.column(1)):
                raw = data.tobytes()
                known = has_letter([raw[a:b] for a, b in zip(starts[:-1], starts[1:])]) & bool(languages)
                best = means.argmax(1)
                names = [languages[k] if ok else "und" for k, ok in zip(best, known)]
                scores = np.where(known, means.max(1), 0.0)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(names, pa.string()), pa.array(np.clip(scores, 0, 1))], names=["doc_id", "lang_pred", "score"])

    return label


def _blank(texts: pa.Array):
    for first, last, data, starts in ws.blocks(texts):
        yield first, last, data, starts, np.zeros((last - first, 1))


def train_language_id(known: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", docs: int = DOCS, per_doc: int = WINDOWS_PER_DOC, steps: int = STEPS, hidden: int = HIDDEN) -> tuple[Network | None, list[str]]:
    """A network and its languages, learnt from a bounded sample of ``known``."""
    usable = known.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").alias("text")).filter("id is not null and lang is not null and text is not null").filter(F.col("text").rlike("\\p{L}"))
    # ids first: whole texts are read for the chosen documents only
    numbered = usable.withColumn("text_hash", F.xxhash64("text"))
    chosen = written(first_of_each(numbered.select("id", "lang", "text_hash").distinct(), "lang", docs, "id", "text_hash"), "language-sample")
    same = numbered.join(small(chosen), ["id", "lang", "text_hash"])
    texts = same.groupBy("id", "lang", "text_hash").agg(F.first("text").alias("text")).select("lang", "text")
    rows = texts.mapInArrow(_sample_windows(WINDOW, per_doc), "lang string, piece binary").orderBy("lang", F.xxhash64("piece"), "piece").toArrow()
    languages = sorted(set(rows["lang"].to_pylist()))
    if not languages:
        return None, []
    labels = np.searchsorted(languages, rows["lang"].to_numpy())
    windows = np.frombuffer(b"".join(rows["piece"].to_pylist()), np.uint8).reshape(-1, WINDOW)
    network = Network(len(languages), hidden)
    network.train(windows, labels, steps)
    return network, languages


def identify_languages(docs: DataFrame, network: Network | None, languages: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``id_col``, ``lang_pred`` and ``score``, its mean probability."""
    own = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    shared = Shared(docs.sparkSession, network)
    kind = docs.schema[id_col].dataType.simpleString()
    return own.mapInArrow(_label(shared, languages), f"doc_id {kind}, lang_pred string, score double").withColumnRenamed("doc_id", id_col)


def op7_language_id(spark, d):
    docs = table(spark, d, "documents")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    network, languages = train_language_id(docs.filter(fold != 2))
    found = identify_languages(docs, network, languages)
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")
