"""Registered queries over vectors, context and retrieval measures."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.contract.views import (
    label_centroids,
    question_view,
    silver_days,
    silver_view,
    table,
)
from ledgerloom.fixed_values import SILVER_COLUMNS
from ledgerloom.operators import cdc, inverted, pivots, search
from ledgerloom.operators import context as ctx
from ledgerloom.operators import vectors as vec
from ledgerloom.functions import search_text, similarity_percent
from ledgerloom.plans.ask import ask, build_items, retrieve
from ledgerloom.session import scratch_path, written
from ledgerloom.sinks.tables import append_runs, read_runs, rebuild_items, run_rows


def _entries(df, key, vector="embedding"):
    """Non-zero places of every vector, rounded.

    The outer form of explode: the plain one makes Spark test the array for emptiness
    first, which would compute every vector twice.
    """
    return (
        df.select(key, F.posexplode_outer(vector).alias("bucket", "weight"))
        .filter("weight <> 0")
        .withColumn("weight", F.round(F.col("weight").cast("double"), 6))
    )


def search_texts(spark, d):
    """The long and the short text form, each with its summary length."""
    silver = silver_view(spark, d).filter("brief_summary is not null")
    long_form = ("brief_title", "conditions", "phase", "overall_status")
    return silver.select(
        "nct_id",
        search_text(long_form, "brief_summary", 500).alias("long_text"),
        search_text(("brief_title", "conditions"), "brief_summary", 400).alias("short_text"),
        F.length(search_text(long_form, "brief_summary")).alias("whole_chars"),
    )


def embed_text(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    return _entries(vec.embed(docs, text="text"), "doc_id")


def vector_items(spark, d):
    """The stored collection, read back."""
    path = scratch_path(spark, "items")
    rebuild_items(build_items(silver_view(spark, d)), path)
    return spark.read.parquet(path).select("id", "metadata.*", F.length("document").alias("chars"))


def collection_info(spark, d):
    return vec.collection_info(table(spark, d, "embeddings"))


def _label_hits(spark, d, k=10):
    vectors = table(spark, d, "embeddings").withColumnRenamed("vec_id", "id")
    return vec.top_k(label_centroids(spark, d), vectors, k)


def vector_top_k(spark, d):
    return _label_hits(spark, d).select(
        "query_id", "id", "rank", similarity_percent("cosine").alias("similarity")
    )


def label_precision(spark, d):
    vectors = table(spark, d, "embeddings").withColumnRenamed("vec_id", "id")
    labels = label_centroids(spark, d).select("query_id", "label")
    return ctx.label_precision(_label_hits(spark, d), labels, vectors)


def vector_top_k_lsh(spark, d):
    """Bucket search over a stored index, with its recall against the exact search."""
    queries, vectors = _asked_and_stored(spark, d)
    hashes = vec.bucket_hash(vectors)
    path = scratch_path(spark, "bucket-index")
    vec.write_bucket_index(vec.bucket_index(vectors, hashes), path)
    found = vec.approx_top_k(queries, vectors, 10, index=spark.read.parquet(path), hashes=hashes)
    exact = vec.top_k(queries, vectors, 10)
    return found.join(vec.recall(found, exact), "query_id").select(
        "query_id", "id", "rank", similarity_percent("cosine").alias("similarity"), "recall"
    )


def _asked_and_stored(spark, d):
    """Every fiftieth vector as a query, and all vectors."""
    vectors = table(spark, d, "embeddings").withColumnRenamed("vec_id", "id")
    return vectors.filter("id % 50 = 0").withColumnRenamed("id", "query_id"), vectors


def _ivf_hits(spark, d):
    """Hits by inverted lists, with the number of coded vectors."""
    queries, vectors = _asked_and_stored(spark, d)
    lists = inverted.fit_lists(vectors)
    path = scratch_path(spark, "inverted-lists")
    inverted.write_lists(inverted.code_items(vectors, lists), path, vectors.count())
    stored = spark.read.parquet(path)
    return inverted.ivf_top_k(queries, stored, lists), stored


def vector_top_k_ivf(spark, d):
    """Search of inverted lists of coded vectors, re-ranked by whole vectors."""
    found, _ = _ivf_hits(spark, d)
    return found.select("query_id", "id", "rank", similarity_percent("cosine").alias("similarity"))


def vector_recall_ivf(spark, d):
    """One row: queries, coded vectors, and whether nine tenths of the exact hits are found."""
    found, stored = _ivf_hits(spark, d)
    queries, vectors = _asked_and_stored(spark, d)
    shares = vec.recall(found, pivots.pivot_top_k(queries, vectors))
    counts = stored.agg(F.count("code").alias("coded"))
    return shares.agg(F.count(F.lit(1)).alias("queries"), (F.avg("recall") >= 0.9).alias("recall_reached")).join(counts)


def vector_top_k_pivots(spark, d):
    """Exact hits of every fiftieth vector; queries meet only cells that can hold neighbours."""
    queries, vectors = _asked_and_stored(spark, d)
    found = pivots.pivot_top_k(queries, vectors)
    return found.select("query_id", "id", "rank", similarity_percent("cosine").alias("similarity"))


def _items(spark, d):
    return written(build_items(silver_view(spark, d)), "items")


def _records(spark, d, k=10):
    """Every user turn asked against the corpus."""
    return retrieve(question_view(spark, d), _items(spark, d), k)


def retrieved_records(spark, d):
    return _records(spark, d).drop("similarity_raw")


def keyword_vs_semantic(spark, d):
    items = _items(spark, d)
    question = table(spark, d, "part").agg(F.max("p_name").alias("question")).select(
        F.lit(1).alias("query_id"), "question"
    )
    asked = vec.embed(question, text="question")
    semantic = vec.top_k(asked, items, 10).withColumnRenamed("id", "nct_id")
    corpus = vec.corpus_texts(silver_view(spark, d))
    keyword = search.first_rows(search.any_keyword(corpus, ["widget", "ring"], "conditions"), 10)
    return vec.compare_hits(keyword, semantic)


def rag_context(spark, d):
    return ctx.build_context(_records(spark, d), ctx.FULL_FORM)


def rag_context_tracked(spark, d):
    return ctx.build_context(_records(spark, d), ctx.TRACKED_FORM)


def rag_prompt(spark, d):
    contexts = ctx.build_context(_records(spark, d, 8), ctx.MATCH_FORM)
    return ctx.build_prompts(question_view(spark, d), contexts, ctx.MATCH_FORM).select(
        "query_id", "prompt"
    )


def keyword_context(spark, d):
    """Context of the light dashboard: first matches of a keyword, with summaries."""
    hits = search.keyword_or_all(silver_view(spark, d), "red widget", 8)
    ranked = hits.withColumns({"query_id": F.lit(1), "rank": F.col("nct_id")})
    return ctx.build_context(ranked, ctx.SUMMARY_FORM)


def retrieval_metrics(spark, d):
    return ctx.retrieval_metrics(_records(spark, d))


def retrieval_tags(spark, d):
    return ctx.run_tags(question_view(spark, d), _records(spark, d))


def retrieval_eval(spark, d):
    return ctx.evaluate(_records(spark, d, 5), questions=question_view(spark, d))


def ask_prompts(spark, d):
    """Questions to prompts of the full and of the tracked form, in one run each."""
    items, questions = _items(spark, d), question_view(spark, d)
    forms = (("full", ctx.FULL_FORM), ("tracked", ctx.TRACKED_FORM))
    parts = [ask(questions, items, form=form).prompts.select(F.lit(name).alias("form"), "query_id", "prompt") for name, form in forms]
    return parts[0].unionAll(parts[1])


def corpus_with_long_summaries(spark, d):
    """The short text form, of records whose summary is longer than a few characters."""
    silver = silver_view(spark, d)
    columns = ("brief_title", "conditions")
    kept = vec.corpus_texts(silver, columns=columns, summary_chars=400, min_summary_chars=10)
    return kept.select("nct_id", "document")


def run_comparison(spark, d):
    return ctx.compare_runs(question_view(spark, d), ctx.retrieval_metrics(_records(spark, d)))


def run_log(spark, d):
    """One logged row per question, appended and read back."""
    items = _items(spark, d)
    questions = question_view(spark, d)
    records = written(retrieve(questions, items), "records")
    path = scratch_path(spark, "runs")
    rows = run_rows(
        questions,
        ctx.retrieval_metrics(records),
        ctx.run_tags(questions, records),
        ctx.build_context(records, ctx.TRACKED_FORM),
        vec.collection_info(items),
        "hashed-words-64",
        10,
        "user-turns",
    )
    append_runs(rows, path)
    return read_runs(spark, path).drop("context")


def citation_check(spark, d):
    """Answers made of retrieved ids, a repeated one, an unknown one and a broken one."""
    records = written(_records(spark, d), "records")
    first = records.filter("rank = 1").select("query_id", F.col("nct_id").alias("a"))
    last = records.filter("rank = 10").select("query_id", F.col("nct_id").alias("b"))
    answers = first.join(last, "query_id").select(
        "query_id",
        F.concat(
            F.lit("See "), "a", F.lit(", again "), "a", F.lit("; also "), "b",
            F.lit(" but not NCT99999999 or NCT123."),
        ).alias("answer"),
    )
    return ctx.citation_check(answers, records)


def incremental_reembed(spark, d):
    """The collection of the first delivery brought up to date by the change feed."""
    target, delta = silver_days(spark, d)
    feed = cdc.change_feed(cdc.pair_changes(target, delta), SILVER_COLUMNS)
    items = vec.reembed_changed(build_items(target), feed)
    return _entries(items, "id").groupBy("id").agg(
        F.count("weight").alias("places"),
        # whole millionths: a sum of doubles would depend on their order
        F.sum(F.round(F.col("weight") * 1_000_000).cast("bigint")).alias("weight_millionths"),
    )


QUERIES = {
    "search_texts": search_texts,
    "embed_text": embed_text,
    "vector_items": vector_items,
    "collection_info": collection_info,
    "vector_top_k": vector_top_k,
    "label_precision": label_precision,
    "vector_top_k_lsh": vector_top_k_lsh,
    "vector_top_k_ivf": vector_top_k_ivf,
    "vector_recall_ivf": vector_recall_ivf,
    "vector_top_k_pivots": vector_top_k_pivots,
    "retrieved_records": retrieved_records,
    "keyword_vs_semantic": keyword_vs_semantic,
    "rag_context": rag_context,
    "rag_context_tracked": rag_context_tracked,
    "rag_prompt": rag_prompt,
    "keyword_context": keyword_context,
    "retrieval_metrics": retrieval_metrics,
    "retrieval_tags": retrieval_tags,
    "retrieval_eval": retrieval_eval,
    "ask_prompts": ask_prompts,
    "corpus_with_long_summaries": corpus_with_long_summaries,
    "run_comparison": run_comparison,
    "run_log": run_log,
    "citation_check": citation_check,
    "incremental_reembed": incremental_reembed,
}
