"""Licences of files: TF-IDF cosine of lines and whole files to templates, then inheritance.

1. The document frequency of every template word is counted over all whole files. A word
   outside the templates weighs as one that a single file has.
2. Every line, and every file as a whole, is compared with every template by the cosine of
   the TF-IDF vectors of its words. Only lines that hold a distinctive word can reach the
   threshold: what is left of a template without its distinctive words has a norm below
   the threshold's share, so the cosine of a line without any is below it too. So most
   lines are passed over, and none is lost.
3. The best line gives a file its own licence. A file is a licence file of its directory
   if its name says so (``NAMES``) or the whole of it reaches the threshold.
4. A file without its own licence takes that of the nearest directory above it that has a
   licence file: directories, not files, are joined with all their ancestors, and files
   with their directory's result.

Defined results: null or empty texts have no licence of their own but inherit; a null path
is an own licence's only source; equal cosines go to the template that comes first by
name, in a directory to the smaller path; equal paths are judged one by one; an empty
table gives no rows; all columns are kept, those named ``licence``, ``similarity``,
``via`` and ``directory`` replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import wordscan as ws
from ledgerloom.llm.tables import Shared, small, table
from ledgerloom.session import written

THRESHOLD = 0.6
NAMES = "(?i)^(licen[sc]e|copying|unlicen[sc]e)([-._].*)?$"

# Names of licences and how headers state them.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, v. 2.0.",
}

_U = np.uint64
_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[97:123] = _INSIDE[128:] = True


def _words(texts: pa.Array):
    """Per block: first row, last row, word hashes, line and row of each word; lines are numbered through."""
    for first, last, data, starts in ws.blocks(texts):
        data = ws.LOWER[data]
        begins, ends = ws.runs(_INSIDE[data], starts)
        lines = np.zeros(len(data) + 1, np.int64)
        lines[1:] = np.cumsum(data == 10)
        # a text begins a new line, whatever the one before ended with
        row = np.searchsorted(starts, begins, "right") - 1
        yield first, last, ws.hashes(data, begins, ends), lines[begins] + row, row


class Templates:
    """Unit TF-IDF vectors of the templates, and their distinctive words."""

    def __init__(self, templates: dict[str, str], threshold: float):
        self.names, self.threshold = sorted(templates), threshold
        texts = pa.array([templates[n] for n in self.names])
        words, rows = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
        for first, _, found, _, row in _words(texts):
            words.append(found)
            rows.append(first + row)
        words, rows = np.concatenate(words), np.concatenate(rows)
        self.known = np.unique(words)
        self.tf = np.zeros((len(self.names), len(self.known)))
        np.add.at(self.tf, (rows, np.searchsorted(self.known, words)), 1)

    def find(self, words: np.ndarray) -> np.ndarray:
        """The place of each word among the templates' words, -1 if it is none."""
        at = np.minimum(np.searchsorted(self.known, words), len(self.known) - 1)
        return np.where(self.known[at] == words, at, -1)

    def weigh(self, docs_with: np.ndarray, n_docs: int) -> None:
        self.idf = np.log((1 + n_docs) / (1 + docs_with)) + 1
        self.other_idf = np.log((1 + n_docs) / 2) + 1
        self.unit = self.tf * self.idf
        self.unit /= np.maximum(np.sqrt((self.unit**2).sum(1)), 1e-12)[:, None]
        self.distinctive = np.zeros(len(self.known), bool)
        for row in self.unit:
            order = np.argsort(row, kind="stable")  # the lightest words stay out while they may
            common = np.sqrt(np.cumsum(row[order] ** 2)) < self.threshold - 1e-9
            self.distinctive[order[~common & (row[order] > 0)]] = True

    def best(self, groups: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each group of words that reaches the threshold: group, template, cosine."""
        places = self.find(words)
        has = places >= 0
        has[has] = self.distinctive[places[has]]
        some = np.unique(groups[has])
        keep = np.isin(groups, some)
        groups, words, places = np.searchsorted(some, groups[keep]), words[keep], places[keep]
        order = np.lexsort((words, groups))
        groups, words, places = groups[order], words[order], places[order]
        new = np.flatnonzero(np.r_[True, (groups[1:] != groups[:-1]) | (words[1:] != words[:-1])]) if len(words) else np.zeros(0, np.int64)
        tf = np.diff(np.r_[new, len(words)])
        groups, places = groups[new], places[new]
        weight = tf * np.where(places >= 0, self.idf[places], self.other_idf)
        norm = np.sqrt(np.bincount(groups, weight**2, len(some)))
        dots = np.zeros((len(some), len(self.names)))
        known = places >= 0
        np.add.at(dots, groups[known], weight[known, None] * self.unit[:, places[known]].T)
        cosine = np.round(dots / np.maximum(norm, 1e-12)[:, None], 9)
        top = cosine.argmax(1)
        value = cosine[np.arange(len(some)), top]
        enough = value >= self.threshold
        return some[enough], top[enough], value[enough]


def _count(templates):
    @ws.released
    def count(batches):
        own = templates.value
        total, n = np.zeros(len(own.known), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for _, _, words, _, row in _words(batch.column(0)):
                at = own.find(words)
                pairs = np.unique(row[at >= 0] * len(own.known) + at[at >= 0])
                total += np.bincount(pairs % len(own.known), minlength=len(total))
        yield pa.RecordBatch.from_pydict({"word": np.arange(-1, len(total)), "n": np.r_[n, total]})

    return count


def _compare(templates):
    """Per file: its best line's template and cosine, and those of the whole file."""

    @ws.released
    def compare(batches):
        own = templates.value
        names = pa.array([*own.names, None], pa.string())
        for batch in batches:
            n = batch.num_rows
            licence, cosine = np.full((2, n), len(own.names)), np.zeros((2, n))
            for first, _, words, line, row in _words(batch.column(1)):
                for kind, groups in enumerate((line, row)):
                    found, top, value = own.best(groups, words)
                    if kind == 0:
                        found = row[np.searchsorted(line, found)]  # lines stand in the order of rows
                    # best first, then by template
                    order = np.lexsort((top, -value, found))
                    at, first_of = np.unique(found[order], return_index=True)
                    licence[kind, first + at] = top[order][first_of]
                    cosine[kind, first + at] = value[order][first_of]
            yield pa.RecordBatch.from_arrays([batch.column(0), names.take(pa.array(licence[0])), pa.array(cosine[0]), names.take(pa.array(licence[1])), pa.array(cosine[1])], names=["file", "line_licence", "line_cosine", "file_licence", "file_cosine"])

    return compare


def scan_licences(files: DataFrame, templates: dict[str, str] | None = None, threshold: float = THRESHOLD, path_col: str = "path", text_col: str = "text") -> DataFrame:
    """``files`` without their texts, with ``licence``, ``similarity``, ``via`` (own, directory
    or null) and the ``directory`` that a licence is inherited from."""
    spark = files.sparkSession
    own = ("licence", "similarity", "via", "directory")
    model = Templates(templates or TEMPLATES, threshold)
    counts = files.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(_count(Shared(spark, model)), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()  # one row a word
    by_word = {r["word"]: r["n"] for r in counts}
    model.weigh(np.array([by_word.get(i, 0) for i in range(len(model.known))]), by_word.get(-1, 0))

    rest = [c for c in files.columns if c != text_col and (c not in own or c == path_col)]
    key = F.struct(*[F.col(f"`{c}`") for c in rest])
    found = files.select(key.alias("file"), F.col(f"`{text_col}`").alias("text"))
    result = T.StructType([found.schema["file"], *[T.StructField(f"{k}_{v}", t()) for k in ("line", "file") for v, t in (("licence", T.StringType), ("cosine", T.DoubleType))]])
    compared = written(found.mapInArrow(_compare(Shared(spark, model)), result), "licences")
    path = F.col(f"file.`{path_col}`")
    folder = F.when(path.isNotNull(), F.regexp_replace(path, "/?[^/]*$", ""))
    placed = compared.select("*", path.alias("path"), folder.alias("folder"))

    name = F.regexp_extract("path", "[^/]*$", 0)
    stated = F.coalesce(F.when(F.col("file_licence").isNotNull(), F.struct("file_cosine", "file_licence")), F.when(name.rlike(NAMES) & F.col("line_licence").isNotNull(), F.struct(F.col("line_cosine").alias("file_cosine"), F.col("line_licence").alias("file_licence"))))
    held = placed.filter("folder is not null").select("folder", "path", stated.alias("stated")).filter("stated is not null")
    by_folder = held.groupBy("folder").agg(F.min_by("stated", F.struct((-F.col("stated.file_cosine")).alias("c"), "path", "stated.file_licence")).alias("stated"))

    folders = placed.filter("folder is not null").select("folder").distinct()
    parts = F.split("folder", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    chain = folders.select("folder", F.explode(F.array_distinct(above)).alias("ancestor"))
    meets = chain.join(by_folder.withColumnRenamed("folder", "ancestor"), "ancestor")
    nearest = meets.groupBy("folder").agg(F.max_by(F.struct("ancestor", "stated"), F.length("ancestor")).alias("near"))
    judged = placed.join(small(nearest), "folder", "left")
    mine = F.col("line_licence").isNotNull() | F.col("file_licence").isNotNull()
    line_first = F.col("line_licence").isNotNull()
    return judged.select(
        *[F.col(f"file.`{c}`").alias(c) for c in rest],
        F.when(mine, F.when(line_first, F.col("line_licence")).otherwise(F.col("file_licence"))).otherwise(F.col("near.stated.file_licence")).alias("licence"),
        F.when(mine, F.when(line_first, F.col("line_cosine")).otherwise(F.col("file_cosine"))).otherwise(F.col("near.stated.file_cosine")).alias("similarity"),
        F.when(mine, "own").when(F.col("near").isNotNull(), "directory").alias("via"),
        F.when(~mine, F.col("near.ancestor")).alias("directory"),
    )


def op2_licences(spark, d):
    """Documents as files: source and language are their directories, the id their name."""
    docs = table(spark, d, "documents")
    name = F.col("doc_id").cast("string")
    files = docs.select("doc_id", F.concat_ws("/", "source", "lang", name).alias("path"), "text")
    return scan_licences(files).select("doc_id", "path", "licence", F.round("similarity", 6).alias("similarity"), "via", "directory")
