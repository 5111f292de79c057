"""Sketches of loads against exact counts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import sketches
from ledgerloom.session import scratch_path


@pytest.fixture(scope="module")
def loads(spark):
    """Three loads with common and own values, a hot one, and missing ones."""
    def load(k):
        i = F.col("id") + k * 3_000
        name = F.when(i % 3 == 0, "hot").when(i % 50 == 1, None).otherwise(F.concat(F.lit("v"), (F.pmod(F.xxhash64(i), F.lit(900))).cast("string")))
        return spark.range(4_000).select(name.alias("name"), F.when(i % 10 != 0, F.pmod(F.xxhash64(i), F.lit(100_000))).alias("amount"))

    return [load(k) for k in range(3)]


def test_merged_loads_are_within_the_bounds(spark, loads):
    path = scratch_path(spark, "test-sketches")
    for k, df in enumerate(loads):
        sketches.load_sketches(df, ["name"], ["amount"], f"load {k}").write.mode("append").parquet(path)
    every = loads[0].union(loads[1]).union(loads[2])
    found = {r.column_name: r for r in sketches.sketch_profile(sketches.merge_sketches(spark.read.parquet(path))).collect()}
    exact = {r.column_name: r for r in sketches.exact_profile(every, ["name"], ["amount"]).collect()}
    for c in ("name", "amount"):
        assert (found[c].row_count, found[c].nulls) == (exact[c].row_count, exact[c].nulls) == (12_000, every.filter(F.col(c).isNull()).count())
        assert abs(found[c].distinct_values / exact[c].distinct_values - 1) < 0.05
    top = found["name"].top_values
    assert top[0]["item"] == "hot" and abs(top[0]["count"] / exact["name"].top_values[0]["count"] - 1) < 0.01
    values = sorted(r.amount for r in every.filter("amount is not null").collect())
    for share, q in zip((0.25, 0.5, 0.75), found["amount"].quantiles):
        rank = sum(v <= q for v in values) / len(values)
        assert abs(rank - share) < 0.02
    assert found["name"].quantiles is None and found["amount"].top_values is None


def test_merging_in_steps_is_merging_at_once(spark, loads):
    parts = [sketches.load_sketches(df, ["name"], ["amount"], str(k)) for k, df in enumerate(loads)]
    steps = sketches.merge_sketches(parts[0].unionByName(parts[1])).unionByName(parts[2])
    at_once = sketches.merge_sketches(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    one, other = (sketches.sketch_profile(sketches.merge_sketches(x) if x is steps else x).select("column_name", "row_count", "nulls", "distinct_values").orderBy("column_name").collect() for x in (steps, at_once))
    assert one == other


def test_an_empty_load(spark, loads):
    empty = sketches.load_sketches(loads[0].limit(0), ["name"], ["amount"], "none")
    found = {r.column_name: r for r in sketches.sketch_profile(sketches.merge_sketches(empty)).collect()}
    assert found["name"].row_count == found["amount"].distinct_values == 0 and found["amount"].quantiles is None
