"""From raw documents to token ids, in stages that are each written and read again.

Every stage takes all that the one before kept and returns the columns of ``documents``
(the last one: ids). Documents are told apart by ``doc_id`` and text.

Defined results: null and empty texts and rows of null id stay until the last stage, where a
text without pieces has no ids; of rows of the same id and text one is left by the second stage;
ties go to the smaller id; an empty table gives no rows. Stages use the columns of
``documents`` only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, ngram_join, piece_transducer, substring_dedup, toxicity
from ledgerloom.llm.tables import table, without_texts
from ledgerloom.session import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the nearest labelled examples call toxic go."""
    return toxicity.drop_toxic(docs, toxicity.training_labels(table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates the document of the smallest id stays.

    Rows of an id are told apart by their texts; of rows of the same id and text that has
    words one stays.
    """
    groups = written(ngram_join.near_duplicates(docs), "groups")
    later = groups.filter(F.col("component_id") != F.col("doc_id")).select(F.col("doc_id").alias("id"), "text_hash")
    kept = without_texts(docs, later)
    again = groups.filter("n_shingles > 0").groupBy("doc_id", "text_hash").agg(F.count("*").alias("rows")).filter("rows > 1")
    again = written(again.select(F.col("doc_id").alias("id"), "text_hash"), "repeated")
    if again.isEmpty():
        return kept
    repeated = without_texts(kept, again, how="left_semi").dropDuplicates(["doc_id", "text"])
    return without_texts(kept, again).unionByName(repeated)


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that a smaller id has are cut out of the texts."""
    cut = substring_dedup.remove_repeated_spans(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in benchmark passages go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of the texts."""
    import public_tokenizers

    encoded = piece_transducer.encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return encoded.withColumn("n_ids", F.size("ids").cast("long"))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_duplicates),
    ("substring_dedup", cut_repeated_spans),
    ("decontaminate", drop_contaminated),
    ("sentencepiece", encode_pieces),
]

# The first stage's scores and the last one's ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
