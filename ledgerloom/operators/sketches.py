"""Profiles of columns from small mergeable sketches, one row per column and load.

A load's rows are read once. Of every column its sketch row holds the number of rows and of
missing values, a sketch of the distinct values (HyperLogLog, some 3 % off at the default size),
of text columns the heavy hitters (frequent items), of whole-number columns the quantiles (KLL,
some 1 % of rank off). Rows of many loads are merged without going back to the records, so a
profile of all of them costs no group-by of every value. ``exact_profile`` counts for certain.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_BUCKETS = 12
QUANTILE_SIZE = 400
TRACKED = 1_000


def load_sketches(df: DataFrame, texts: Sequence[str], numbers: Sequence[str], load: str) -> DataFrame:
    """The sketch rows of one load: a single pass over ``df``."""
    parts = [F.count(F.lit(1)).alias("rows")]
    for c in (*texts, *numbers):
        parts += [F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"), F.hll_sketch_agg(F.col(c), LOG_BUCKETS).alias(f"distinct_{c}")]
    parts += [F.expr(f"approx_top_k_accumulate(`{c}`, {TRACKED})").alias(f"heavy_{c}") for c in texts]
    parts += [F.kll_sketch_agg_bigint(F.col(c).cast("bigint"), QUANTILE_SIZE).alias(f"quantiles_{c}") for c in numbers]
    one = df.agg(*parts)
    heavy_type = one.schema[f"heavy_{texts[0]}"].dataType if texts else None

    def row(c: str):
        heavy = F.col(f"heavy_{c}") if c in texts else F.lit(None).cast(heavy_type) if heavy_type is not None else F.lit(None).cast("string")
        quantiles = F.col(f"quantiles_{c}") if c in numbers else F.lit(None).cast("binary")
        return F.struct(
            F.lit(load).alias("load"),
            F.lit(c).alias("column_name"),
            F.col("rows").alias("row_count"),
            F.col(f"nulls_{c}").alias("nulls"),
            F.col(f"distinct_{c}").alias("distinct"),
            quantiles.alias("quantiles"),
            heavy.alias("heavy"),
        )

    return one.select(F.inline(F.array(*[row(c) for c in (*texts, *numbers)])))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row per column of all loads; loads merged before may be merged again."""
    merged = sketches.groupBy("column_name").agg(
        F.lit("merged").alias("load"),
        F.sum("row_count").alias("row_count"),
        F.sum("nulls").alias("nulls"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_bigint("quantiles").alias("quantiles"),
    )
    # apart: of a column without heavy hitters there is nothing to combine
    heavy = sketches.filter("heavy is not null").groupBy("column_name").agg(F.expr("approx_top_k_combine(heavy)").alias("heavy"))
    return merged.join(F.broadcast(heavy), "column_name", "left")  # one row per column


def sketch_profile(merged: DataFrame, shares: Sequence[float] = (0.25, 0.5, 0.75), k: int = 5) -> DataFrame:
    """column_name, row_count, nulls, about how many distinct values, quantiles and top values."""
    asked = F.array(*[F.lit(s) for s in shares])
    return merged.select(
        "column_name",
        "row_count",
        "nulls",
        F.hll_sketch_estimate("distinct").alias("distinct_values"),
        F.when(F.col("quantiles").isNotNull() & (F.kll_sketch_get_n_bigint("quantiles") > 0), F.kll_sketch_get_quantile_bigint("quantiles", asked)).alias("quantiles"),
        F.when(F.col("heavy").isNotNull(), F.expr(f"approx_top_k_estimate(heavy, {k})")).alias("top_values"),
    )


def exact_profile(df: DataFrame, texts: Sequence[str], numbers: Sequence[str], shares: Sequence[float] = (0.25, 0.5, 0.75), k: int = 5) -> DataFrame:
    """The same columns, counted: a group-by of every value."""
    out = None
    for c in (*texts, *numbers):
        known = df.filter(F.col(c).isNotNull())
        facts = df.agg(F.lit(c).alias("column_name"), F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(c).isNull()).alias("nulls"), F.count_distinct(c).alias("distinct_values"))
        if c in numbers:
            asked = ", ".join(str(s) for s in shares)
            more = known.agg(F.expr(f"percentile_disc({shares[0]}) within group (order by `{c}`)").alias("_"), F.expr(f"transform(percentile(`{c}`, array({asked})), x -> cast(floor(x) as bigint))").alias("quantiles")).drop("_")
            more = more.withColumn("top_values", F.lit(None).cast("array<struct<item: string, count: bigint>>"))
        else:
            counts = known.groupBy(F.col(c).alias("item")).agg(F.count(F.lit(1)).alias("count"))
            top = counts.orderBy(F.desc("count"), "item").limit(k)
            more = top.agg(F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("n"), "item"))).alias("t"))
            more = more.select(F.lit(None).cast("array<bigint>").alias("quantiles"), F.transform("t", lambda x: F.struct(x["item"].alias("item"), (-x["n"]).alias("count"))).alias("top_values"))
        part = facts.crossJoin(F.broadcast(more))  # one row each
        out = part if out is None else out.unionByName(part)
    return out
