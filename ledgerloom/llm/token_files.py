"""Token ids as flat unsigned integer files with 64-bit document offsets.

Documents are dealt by ranges of their id and sorted; each task encodes its range and
writes one shard: ``*.bin`` (ids, unsigned 16 or 32 bits, little endian) and ``*.idx``
(document ids, then the n + 1 offsets of the documents in the shard, both 64 bits). The
table of shards holds the prefix sums of their sizes, so that a document's global start is
its shard's base plus its local offset. Files are read back memory-mapped where the folder
is a local path, else by ranges through the same file system interface.

A repeated task writes files of another name; the table of shards, committed by Spark,
names the files that count.

Encoding is that of the tokenizers library. Texts are cut where the tokenizer itself
always cuts (white space; in plain words also between letters, digits and the rest), and
each different piece is encoded once by the library while it is in a bounded cache. A tokenizer
that cuts in other ways is refused.

Defined results: a null text is an empty one and consists of the end id alone; documents
of the same id stand in order of a hash of their texts; null ids come first; an empty table gives
no shard and no rows; other columns of the input are not used.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm import wordscan as ws
from ledgerloom.llm.tables import tasks_for

SHARD_CHARS = 24 << 20
NULL_ID = -(1 << 63)

SHARD_SCHEMA = "shard long, file string, dtype string, n_docs long, n_tokens long"

# letters 1, digits 2, other ASCII 3, characters of special tokens and contractions 4
_KIND = np.full(256, 3, np.uint8)
_KIND[65:91] = _KIND[97:123] = 1
_KIND[48:58] = 2
_KIND[[39, 60, 124]] = 4
_KIND[128:] = 5
_PLAIN = re.compile(rb"(?:[^'<|\x80-\xff]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _pieces(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes to encode, and begins and ends of independently encoded pieces."""
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) if len(data) else np.zeros(0, np.int64)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = 1
    inside = ~ws.WHITE[data]
    begins, ends = ws.runs(inside, starts)
    odd_before = np.r_[0, np.cumsum(kind >= 4)]
    odd = odd_before[ends] > odd_before[begins]
    step = np.zeros(len(data) + 1, np.int8)
    np.add.at(step, begins[odd], 1)
    np.add.at(step, ends[odd], -1)
    plain = np.cumsum(step[:-1]) == 0
    cut = plain.copy()
    cut[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    begins, ends = ws.runs(inside, starts, cut & inside)
    return np.where(plain, ws.LOWER[data], data), begins, ends


def check_tokenizer(path: str) -> None:
    """Raises for a tokenizer that cuts texts in another way than ``_pieces`` does."""
    import json

    with open(path, encoding="utf-8") as f:
        held = json.load(f)
    kinds = {k: [x["type"] for x in (held.get(k) or {}).get(parts, [])] for k, parts in (("normalizer", "normalizers"), ("pre_tokenizer", "pretokenizers"))}
    split = next((x for x in (held.get("pre_tokenizer") or {}).get("pretokenizers", []) if x["type"] == "Split"), {})
    if kinds != {"normalizer": ["NFC", "Replace", "Lowercase"], "pre_tokenizer": ["Split", "ByteLevel"]} or (split.get("behavior"), split.get("invert")) != ("Removed", True):
        raise ValueError(f"{path}: only tokenizers that lower-case and split at words, white space dropped, are covered")


class Encoder:
    """Encodes Arrow text batches with a file of the tokenizers library."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end_id = end_id
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.dtype = "<u2" if max([end_id, *vocab.values()]) < 1 << 16 else "<u4"
        self.suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        self.closes = np.zeros(max(vocab.values()) + 1, bool)
        if self.suffix:
            self.closes[[i for token, i in vocab.items() if token.endswith(self.suffix)]] = True
        self.cache = ws.PieceCache()

    def _each(self, pieces: list[str]) -> tuple[list[int], list[int]]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        return [len(x) for x in found], [i for x in found for i in x]

    def _new(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Plain pieces end in one closing id each, so many are encoded as one text."""
        counts = np.zeros(len(pieces), np.int64)
        plain = [i for i, p in enumerate(pieces) if _PLAIN.fullmatch(p)] if self.suffix else []
        text = b" ".join([pieces[i] for i in plain]).decode()
        ids = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.int64)
        closing = np.flatnonzero(self.closes[ids]) + 1
        if len(closing) == len(plain) and (not len(plain) or closing[-1] == len(ids)):
            counts[plain] = np.diff(np.r_[0, closing])
        else:
            plain, ids = [], ids[:0]
        is_plain = np.zeros(len(pieces), bool)
        is_plain[plain] = True
        others = np.flatnonzero(~is_plain)
        other_counts, other_ids = self._each([pieces[i].decode() for i in others])
        counts[others] = other_counts
        flat = np.zeros(counts.sum(), np.int64)
        from_plain = np.repeat(is_plain, counts)
        flat[from_plain], flat[~from_plain] = ids, other_ids
        return counts, flat

    def encode(self, texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """First and last row, ids end to end with end ids, and the length of each text."""
        for first, last, data, starts in ws.blocks(texts):
            data, begins, ends = _pieces(data, starts)
            raw = data.tobytes()
            ids, counts = self.cache.encode(ws.hashes(data, begins, ends), lambda at: self._new([raw[a:b] for a, b in zip(begins[at].tolist(), ends[at].tolist())]))  # noqa: B023
            before = np.r_[0, np.cumsum(counts)][np.searchsorted(begins, starts)]
            yield first, last, np.insert(ids, before[1:], self.end_id).astype(self.dtype), np.diff(before) + 1


def _shard_writer(folder: str, tokenizer: str, end_id: int):
    @ws.released
    def write(batches):
        store, base = pafs.FileSystem.from_uri(folder)
        shard = TaskContext.get().partitionId()
        name = f"part-{shard:06d}-{uuid.uuid4().hex}"
        encoder, out, doc_ids, lengths = None, None, [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                encoder = Encoder(tokenizer, end_id)
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}.bin")
            doc_ids.append(batch.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False))
            for _, _, ids, counts in encoder.encode(batch.column(1)):
                out.write(ids.tobytes())
                lengths.append(counts)
        if out is None:
            return
        out.close()
        ends = np.cumsum(np.concatenate(lengths))
        with store.open_output_stream(f"{base}/{name}.idx") as index:
            index.write(np.concatenate(doc_ids).astype("<i8").tobytes())
            index.write(np.r_[0, ends].astype("<i8").tobytes())
        yield pa.RecordBatch.from_pydict({"shard": [shard], "file": [f"{base}/{name}"], "dtype": [encoder.dtype], "n_docs": [len(ends)], "n_tokens": [int(ends[-1])]})

    return write


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the documents' ids under ``folder``, a path or URI that all executors reach.

    Returns the table of shards with ``first_doc`` and ``first_token``, the prefix sums,
    also kept as Parquet in ``folder``/shards.
    """
    check_tokenizer(tokenizer)
    spark = docs.sparkSession
    uri = folder if "://" in folder else f"file://{folder}"
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    chars = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    tie = F.xxhash64("text")
    ordered = docs.repartitionByRange(tasks_for(docs, chars, SHARD_CHARS), "doc_id", tie).sortWithinPartitions("doc_id", tie)
    written = ordered.mapInArrow(_shard_writer(uri, tokenizer, end_id), SHARD_SCHEMA)
    written.write.parquet(f"{folder}/written")
    # one row a shard
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = spark.read.schema(SHARD_SCHEMA).parquet(f"{folder}/written").withColumns({f"first_{x}": F.coalesce(F.sum(f"n_{x}s").over(before), F.lit(0)) for x in ("doc", "token")})
    shards.write.parquet(f"{folder}/shards")
    return spark.read.parquet(f"{folder}/shards")


def open_shard(uri: str, file: str, dtype: str, n_docs: int):
    """Document ids, offsets and a reader of token ranges of one shard."""
    store, _ = pafs.FileSystem.from_uri(uri)
    if isinstance(store, pafs.LocalFileSystem):
        index, ids = np.memmap(f"{file}.idx", "<i8", "r"), np.memmap(f"{file}.bin", dtype, "r")
        return index[:n_docs], index[n_docs:], lambda a, b: ids[a:b]
    with store.open_input_file(f"{file}.idx") as f:
        index = np.frombuffer(f.read(), "<i8")
    source, width = store.open_input_file(f"{file}.bin"), np.dtype(dtype).itemsize
    return index[:n_docs], index[n_docs:], lambda a, b: np.frombuffer(source.read_at((b - a) * width, a * width), dtype)


READ_DOCS = 4096


def _read(uri: str, columns, fields: list[str]):
    """A task that gives ``columns(doc offsets, ids)`` for blocks of a shard's documents."""

    @ws.released
    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                doc_ids, offsets, tokens = open_shard(uri, row["file"], row["dtype"], row["n_docs"])
                for a in range(0, len(doc_ids), READ_DOCS):
                    local = np.asarray(offsets[a : a + READ_DOCS + 1])
                    own = np.asarray(doc_ids[a : a + READ_DOCS])
                    values = [pa.array(own, mask=own == NULL_ID), pa.array(local[:-1] + row["first_token"]), pa.array(np.diff(local))]
                    yield pa.RecordBatch.from_arrays([*values, columns(local, tokens)], names=fields)

    return read


def _checksums(local, tokens):
    return pa.array([zlib.crc32(tokens(a, b).astype("<u4").tobytes()) for a, b in zip(local[:-1], local[1:])], pa.int64())


def _lists(local, tokens):
    values = pa.array(tokens(int(local[0]), int(local[-1])).astype(np.int32))
    return pa.ListArray.from_arrays(pa.array((local - local[0]).astype(np.int32)), values)


def read_token_files(spark: SparkSession, folder: str, what: str = "ids") -> DataFrame:
    """One row per document, from the files: doc_id, start, n_tokens and ``ids``, or their
    checksum ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers)."""
    shards = spark.read.parquet(f"{folder}/shards")
    uri = folder if "://" in folder else f"file://{folder}"
    columns, kind = {"ids": (_lists, "array<int>"), "ids_crc32": (_checksums, "long")}[what]
    dealt = shards.select("file", "dtype", "n_docs", "first_token").repartition(max(1, shards.count()))
    fields = ["doc_id", "start", "n_tokens", what]
    return dealt.mapInArrow(_read(uri, columns, fields), f"doc_id long, start long, n_tokens long, {what} {kind}")


def op5_token_files(spark, d):
    import public_tokenizers

    from ledgerloom.llm.tables import table
    from ledgerloom.session import scratch_path

    folder = scratch_path(spark, "token-files")
    write_token_files(table(spark, d, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), 1)
    return read_token_files(spark, folder, "ids_crc32")
