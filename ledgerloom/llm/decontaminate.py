"""Benchmark passages in documents, by winnowed fingerprints, in DataFrame functions only.

Words of both sides are hashed, k-grams of hashes combined, and of every window of
consecutive k-grams those of the smallest hash are kept as fingerprints (all of them in a
tie). With ``k + w - 1`` equal to the passage length, every shared passage shares a
fingerprint. A document's different fingerprints meet an item's in a join, and a hit is
extended to all passages that the two share: the passages of documents with hits are joined
with those of the items, each different one once, so a word repeated ever so often on both
sides makes no more rows than the document has words. Equality of the words decides. Items
shorter than a passage are one passage themselves; they are looked up by their whole length,
one length at a time, as far as such items exist.

The documents are read twice: once for their fingerprints, once for the words of those
that have a hit. The items' side of each join is broadcast where it is measured to be
small, else shuffled. Items of equal text are searched once.

Defined results: a null or empty text has no words and no hits, whether document or item;
the words hit by an item of null id count, its id isn't listed; rows of the same id are
judged one by one, rows of the same id and text alike; an empty benchmark gives no hits, an
empty table no rows; other columns are not used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tables import small, table, without_texts
from ledgerloom.session import written

PASSAGE_WORDS = 13
GRAM_WORDS = 6
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_of(text: Column) -> Column:
    """Lower-cases A-Z only, then takes the words; null gives an empty array."""
    text = F.coalesce(text, F.lit(""))
    lowered = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once; Spark would repeat it at each mention."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _zipped(array: Column, other: Column, by: int, how) -> Column:
    """``how`` of each element and the one of ``other`` that stands ``by`` places on."""
    return F.zip_with(array, F.slice(other, F.lit(by + 1), F.size(other)), how)


def grams(hashed: Column, size: int) -> Column:
    """A hash of every ``size`` consecutive elements.

    Built from hashes of 2, 4, 8 ... elements, so the work per word grows with log(size).
    """

    def combine(a, b):
        return F.xxhash64(a, b)

    def finish(gram: Column, done: int, parts: dict) -> Column:
        if done == size:
            return F.slice(gram, F.lit(1), F.greatest(F.size(hashed) - F.lit(size - 1), F.lit(0)))
        width = max(w for w in parts if w <= size - done)
        return _bound(_zipped(gram, parts[width], done, combine), lambda g: finish(g, done + width, parts))

    def grow(parts: dict) -> Column:
        width = max(parts)
        if 2 * width > size:
            return finish(parts[width], width, parts)
        return _bound(_zipped(parts[width], parts[width], width, combine), lambda p: grow({**parts, 2 * width: p}))

    return grow({1: hashed})


def _over_windows(values: Column, width: int, how, use, done: int = 1) -> Column:
    """``use`` of ``how`` (least or greatest) over each element and its ``width - 1`` next ones."""
    if done == width:
        return use(values)
    by = min(done, width - done)
    step = _zipped(values, values, by, lambda a, b: how(a, b))
    return _bound(step, lambda v: _over_windows(v, width, how, use, done + by))


def fingerprints(hashed: Column, passage: int = PASSAGE_WORDS, gram: int = GRAM_WORDS) -> Column:
    """A k-gram's hash where it is the least of some window, else null, for every k-gram.

    Texts with fewer words than a passage get an empty array.
    """
    width = passage - gram + 1
    filler = F.array_repeat(F.lit(None).cast("long"), width - 1)

    def kept(g: Column) -> Column:
        windows = F.greatest(F.size(g) - F.lit(width - 1), F.lit(0))

        def raise_(lowest: Column) -> Column:
            # each window's least hash, moved to the places that the window covers
            placed = F.concat(filler, F.slice(lowest, F.lit(1), windows))
            return _bound(placed, lambda p: _over_windows(p, width, F.greatest, lambda top: F.zip_with(g, top, lambda a, b: F.when(a == b, a))))

        return _over_windows(g, width, F.least, raise_)

    return F.when(F.size(hashed) < passage, F.array().cast("array<long>")).otherwise(_bound(grams(hashed, gram), kept))


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _items(benchmark: DataFrame, id_col: str, text_col: str, passage: int) -> DataFrame:
    """One row per different text with words: ``item``, ``ids``, ``words``, ``length`` (of its passages)."""
    same = benchmark.groupBy(F.col(f"`{text_col}`").alias("text")).agg(F.collect_set(F.col(f"`{id_col}`").cast("string")).alias("ids"))
    words = same.select(F.md5("text").alias("item"), "ids", words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    return words.withColumn("length", F.least(F.size("words"), F.lit(passage)))


def _passages(words: Column, length: Column) -> Column:
    """Every ``length`` consecutive words; none of fewer words."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - length + 1, F.lit(1)))
    return F.when(F.size(words) >= length, F.transform(starts, lambda i: F.slice(words, i, length))).otherwise(F.array().cast("array<array<string>>"))


def _lookup(docs: DataFrame, items: DataFrame, passage: int, gram: int, length: int) -> tuple[DataFrame, DataFrame]:
    """Printed documents (an array ``prints``) and items (rows) for passages of ``length`` words."""
    own = items.filter(F.col("length") == length).select("item", _hashed(F.col("words")).alias("hashed"))
    hashed = F.col("hashed")
    prints = fingerprints(hashed, passage, gram) if length == passage else grams(hashed, length)
    docs, own = docs.withColumn("prints", prints).drop("hashed"), own.withColumn("prints", prints)
    rows = own.select("item", F.explode(F.array_distinct("prints")).alias("print")).filter("print is not null")
    return docs, rows


def find_contamination(docs: DataFrame, benchmark: DataFrame, passage: int = PASSAGE_WORDS, gram: int = GRAM_WORDS, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Per document: ``id_col``, ``text_hash``, ``n_words``, ``n_hit`` (words inside any
    passage of an item) and ``items``, the sorted ids of the items with passages."""
    items = written(_items(benchmark, item_id_col, item_text_col, passage), "benchmark")
    short = [r["length"] for r in items.filter(F.col("length") < passage).select("length").distinct().collect()]  # at most passage - 1
    text = F.col(f"`{text_col}`")
    keyed = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.xxhash64(text).alias("text_hash"), words_of(text).alias("words"))
    hashed = keyed.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"), _hashed(F.col("words")).alias("hashed"))

    found = []
    for length in [passage, *sorted(short)]:
        printed, rows = _lookup(hashed, items, passage, gram, length)
        rows = rows.withColumn("is_print", F.lit(True))
        # each different print of a document, and a row that stands for the document itself
        different = F.transform(F.array_compact(F.array_distinct("prints")), lambda h: F.struct(h.alias("print"), F.lit(False).alias("whole")))
        itself = F.struct(F.xxhash64("text_hash", "doc_id").alias("print"), F.lit(True).alias("whole"))
        spread = printed.select("doc_id", "text_hash", "n_words", F.inline(F.concat(different, F.array(itself))))
        met = spread.join(small(rows), (spread["print"] == rows["print"]) & (spread["whole"] != rows["is_print"]), "left")
        hits = met.filter("item is not null or whole").select("doc_id", "text_hash", "n_words", "whole", "item", F.lit(length).alias("length"))
        found.append(written(hits, "hits"))
    whole = found[0].filter("whole").select("doc_id", "text_hash", "n_words")
    hits = reduce(DataFrame.union, found).filter("item is not null")

    # the passages of documents with hits, of the lengths of the items that they hit
    by_doc = hits.groupBy("doc_id", "text_hash").agg(F.collect_set("length").alias("lengths"))  # at most `passage` of them
    held = by_doc.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), "lengths")
    same_row = keyed["doc_id"].eqNullSafe(held["hit_id"]) & (keyed["text_hash"] == held["hit_hash"])
    near = keyed.join(small(held), same_row).select("doc_id", "text_hash", "words", F.explode("lengths").alias("length"))
    places = near.select("doc_id", "text_hash", "length", F.posexplode(_passages(F.col("words"), F.col("length"))).alias("start", "words"))
    of_items = items.select("item", "length", F.explode(F.array_distinct(_passages(F.col("words"), F.col("length")))).alias("words"))
    passages = places.join(small(of_items), ["length", "words"]).select("doc_id", "text_hash", "item", "length", "start").distinct()

    order = Window.partitionBy("doc_id", "text_hash").orderBy("start", "length", "item").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("length")
    covered = passages.withColumn("new", F.greatest(F.lit(0), end - F.greatest("start", F.coalesce(F.max(end).over(order), F.lit(0)))))
    words = covered.groupBy("doc_id", "text_hash").agg(F.sum("new").alias("n_hit"))
    ids = passages.select("doc_id", "text_hash", "item").distinct().join(small(items.select("item", "ids")), "item")
    named = ids.select("doc_id", "text_hash", F.explode_outer("ids").alias("id")).groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("id")).alias("items"))
    judged = words.alias("w").join(named.alias("n"), F.col("w.doc_id").eqNullSafe(F.col("n.doc_id")) & (F.col("w.text_hash") == F.col("n.text_hash"))).select("w.doc_id", "w.text_hash", "n_hit", "items")
    result = whole.alias("d").join(judged.alias("j"), F.col("d.doc_id").eqNullSafe(F.col("j.doc_id")) & (F.col("d.text_hash") == F.col("j.text_hash")), "left")
    none = F.array().cast("array<string>")
    return result.select(F.col("d.doc_id").alias(id_col), "d.text_hash", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"), F.coalesce("items", none).alias("items"))


def contaminated(n_words: str = "n_words", n_hit: str = "n_hit") -> Column:
    """A twentieth of the words, at least one, lies in passages of the benchmark."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the contaminated ones, all columns kept."""
    bad = find_contamination(docs, benchmark, id_col=id_col, text_col=text_col, **options).filter(contaminated())
    return without_texts(docs, bad.select(F.col(f"`{id_col}`").alias("id"), "text_hash"), id_col, text_col)


def op1_decontaminate(spark, d):
    judged = find_contamination(table(spark, d, "documents"), table(spark, d, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256)
    return judged.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), digest.alias("items_sha256"), contaminated().alias("contaminated"))


_SQL_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
CONTAMINATION_SQL = """
items AS (SELECT item_id, {words} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS k
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
doc_words AS MATERIALIZED (SELECT doc_id, {words} AS w FROM {docs}),
lengths AS (SELECT DISTINCT n FROM item_windows),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM doc_words, lengths)),
met AS MATERIALIZED (SELECT doc_id, item_id, n, i FROM doc_windows JOIN item_windows USING (n, k)),
hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM met) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS ids FROM met GROUP BY doc_id),
judged AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
         sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
  FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id))
"""
OP1_SQL = "WITH " + CONTAMINATION_SQL.format(words=_SQL_WORDS, docs="documents") + "SELECT * FROM judged"
