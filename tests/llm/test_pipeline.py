"""The pipeline on the smallest tables, stage by stage."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.session import written


def test_stages(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = written(stage(spark, docs, small_dir), name)
        seen[name] = docs.count()
        if name != "sentencepiece":
            assert docs.columns == columns
        assert docs.select("doc_id").subtract(before.select("doc_id")).isEmpty()
    assert seen["ngram_join"] < seen["toxicity"] <= before.sparkSession.read.parquet(f"{small_dir}/documents.parquet").count()
    assert seen["substring_dedup"] == seen["ngram_join"] and seen["sentencepiece"] == seen["decontaminate"]
    assert docs.filter(F.col("ids").isNull()).isEmpty()


def test_stages_of_odd_rows(spark, small_dir, odd_docs):
    docs = odd_docs.select("doc_id", "text", F.lit("x").alias("lang"), F.lit("s").alias("source"), F.col("n").alias("n_chars"))
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small_dir), name)
    assert docs.filter("doc_id = 2").isEmpty()
    assert {r.doc_id for r in docs.filter("size(ids) = 0").collect()} >= {3, 4}


def test_an_empty_table(spark, small_dir):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, small_dir), name)
    assert docs.count() == 0


def test_repeated_rows_and_ids(spark, small_dir):
    """A copied row of an id takes none of its other texts along; of equal rows one stays."""
    base = " ".join(f"w{i}" for i in range(120))
    rows = [(1, base), (2, base), (2, "another text of the same id"), (2, "another text of the same id"), (3, base + " end"), (3, None), (3, None), (None, base), (None, base), (4, "")]
    docs = spark.createDataFrame([(i, t, "x", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.drop_near_duplicates(spark, docs, small_dir)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in left.collect()), key=str)
    assert got == sorted([(1, base), (2, "another text of the same id"), (3, None), (3, None), (None, base), (4, "")], key=str)


def test_other_columns_may_clash(spark, small_dir):
    """Columns named like those that the stages make."""
    docs = spark.read.parquet(f"{small_dir}/documents.parquet").limit(20)
    clashing = docs.withColumns({c: F.lit(7) for c in ("id", "text_hash", "bad_id", "bad_hash", "n_words", "class", "__bad_id")})
    for _, stage in corpus_pipeline.STAGES[:4]:
        left = stage(spark, clashing, small_dir)
        assert left.columns == clashing.columns
        left.count()
