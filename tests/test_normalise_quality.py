from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Observation
from pyspark.errors import PySparkValueError
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import date_of, fingerprint, label_or_unknown
from ledgerloom.operators import quality
from ledgerloom.operators.dedupe import dedupe_latest
from ledgerloom.operators.normalise import normalise, unparsed_counts
from ledgerloom.sources.pages import raw_schema

TS = "2024-01-01 00:00:00"


def raw(spark, *rows):
    base = dict.fromkeys(raw_schema().fieldNames())
    nullable = T.StructType([T.StructField(f.name, f.dataType) for f in raw_schema().fields])
    return spark.createDataFrame([tuple({**base, **r}.values()) for r in rows], nullable)


def test_typed_load_rejects_a_missing_key(spark):
    with pytest.raises(PySparkValueError):
        spark.createDataFrame([(None,) * len(raw_schema())], raw_schema())


def test_partial_and_bad_dates(spark):
    rows = spark.createDataFrame([("2024-03",), ("2024",), ("soon",), (None,), ("",)], "d string")
    got = [r[0] for r in rows.select(date_of("d")).collect()]
    assert got == [dt.date(2024, 3, 1), dt.date(2024, 1, 1), None, None, None]


def test_normalise_cleans_and_derives(spark):
    r = normalise(
        raw(
            spark,
            {
                "nct_id": "NCT1",
                "brief_title": "  A title ",
                "overall_status": " recruiting ",
                "study_type": "Interventional",
                "start_date": "2024-03",
                "completion_date": "2024-02-20",
                "lead_sponsor": None,
            },
        ),
        TS,
    ).first()
    assert (r.brief_title, r.overall_status, r.is_recruiting, r.is_completed) == (
        "A title",
        "RECRUITING",
        True,
        False,
    )
    assert r.duration_days == -10 and r.is_interventional and r._update_count == 0


def test_missing_status_gives_missing_flags(spark):
    r = normalise(raw(spark, {"nct_id": "NCT1"}), TS).first()
    assert r.is_recruiting is None and r.is_interventional is None and r.duration_days is None


def test_fingerprint_skips_null_unless_told(spark):
    rows = spark.createDataFrame([(None, "2024"), ("2024", None)], "a string, b string")
    plain = {r[0] for r in rows.select(fingerprint(["a", "b"])).collect()}
    kept = {r[0] for r in rows.select(fingerprint(["a", "b"], null_token="")).collect()}
    assert len(plain) == 1 and len(kept) == 2


@pytest.mark.parametrize("field", ["nct_id", "overall_status", "enrollment_count", "completion_date", "lead_sponsor"])
def test_each_hash_field_counts(spark, field):
    full = {
        "nct_id": "NCT1",
        "overall_status": "COMPLETED",
        "enrollment_count": 5,
        "completion_date": "2024-01-01",
        "lead_sponsor": "S",
    }
    changed = {**full, field: {"enrollment_count": 6, "completion_date": "2024-01-02"}.get(field, "X")}
    hashes = {r._record_hash for r in normalise(raw(spark, full, changed), TS).collect()}
    assert len(hashes) == 2


def test_title_is_not_in_the_hash(spark):
    rows = raw(spark, {"nct_id": "NCT1", "brief_title": "a"}, {"nct_id": "NCT1", "brief_title": "b"})
    assert len({r._record_hash for r in normalise(rows, TS).collect()}) == 1


def test_unparsed_counts(spark):
    rows = raw(spark, {"nct_id": "a", "start_date": "soon"}, {"nct_id": "b", "start_date": ""})
    assert unparsed_counts(rows).first().start_date == 1


def test_blank_and_null_labels_are_unknown(spark):
    rows = spark.createDataFrame([(None,), (" ",), ("P1",)], "p string")
    assert [r[0] for r in rows.select(label_or_unknown("p")).collect()] == ["Unknown", "Unknown", "P1"]


# -- rules ----------------------------------------------------------------------------


def silver(spark, *rows):
    return normalise(raw(spark, *rows), TS)


def test_null_result_fails_a_rule_and_stops_the_gate(spark):
    report = quality.run_rules(silver(spark, {"nct_id": "NCT1", "brief_title": None}))
    by_rule = {r.rule: r for r in report.collect()}
    assert by_rule["brief_title_not_null"].failing_rows == 1
    assert by_rule["status_is_known"].failing_rows == 1
    assert by_rule["enrollment_non_negative"].passed and by_rule["completion_after_start"].passed
    with pytest.raises(quality.QualityGateError, match="brief_title_not_null"):
        quality.gate(report)


def test_warnings_do_not_stop_the_gate(spark):
    quality.gate(
        quality.run_rules(
            silver(spark, {"nct_id": "NCT1", "brief_title": "long enough", "enrollment_count": -1})
        )
    )


def test_empty_input(spark):
    empty = silver(spark, {"nct_id": "NCT1"}).limit(0)
    for r in quality.run_rules(empty).collect():
        assert r.passed and r.pass_rate == 0.0 and r.failing_rows == 0
    assert quality.duplicate_count(empty).first().duplicates == 0


def test_quarantine_loses_no_rows(spark):
    rows = silver(
        spark,
        {"nct_id": "NCT1", "brief_title": "long enough"},
        {"nct_id": "XX", "brief_title": "abc"},
        {"nct_id": "NCT2", "brief_title": None},
    )
    kept, aside = quality.quarantine(rows)
    assert [r.nct_id for r in kept.collect()] == ["NCT1"]
    assert {r.nct_id: tuple(r.failed_rules) for r in aside.collect()} == {
        "XX": ("nct_id_format_valid", "brief_title_not_null"),
        "NCT2": ("brief_title_not_null",),
    }


def test_expectations_drop_and_count(spark):
    rows = silver(
        spark,
        {"nct_id": "NCT1", "brief_title": "long enough", "enrollment_count": -4},
        {"nct_id": "bad", "brief_title": "long enough"},
        {"nct_id": "NCT3", "brief_title": None},
    )
    seen = Observation("seen")
    kept = quality.expect(rows, observation=seen)
    assert [r.nct_id for r in kept.collect()] == ["NCT1"]
    assert seen.get == {
        "rows_in": 3,
        "failed_valid_nct_id": 1,
        "failed_has_title": 1,
        "failed_positive_enrollment": 1,
    }


def test_duplicate_count_takes_null_as_one_key(spark):
    rows = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "nct_id string")
    assert quality.duplicate_count(rows).first().duplicates == 2


def test_raw_validation_ignores_null_in_prefix_test(spark):
    rows = spark.createDataFrame([("NCT1",), ("x",), (None,)], "nct_id string")
    r = quality.raw_validation(rows).first()
    assert (r.total_rows, r.column_count, r.null_keys, r.malformed_keys) == (3, 1, 1, 1)


# -- newest copy ----------------------------------------------------------------------


def test_newest_delivery_wins_on_any_partitioning(spark):
    rows = [("k", f"2024-01-{d:02d}", None, f"h{d}") for d in range(1, 20)] + [("other", None, None, "z")]
    df = spark.createDataFrame(rows, "nct_id string, ingestion_ts string, last_update_date date, _record_hash string")
    for parts in (1, 3, 7):
        got = {r.nct_id: r._record_hash for r in dedupe_latest(df.repartition(parts)).collect()}
        assert got == {"k": "h19", "other": "z"}


def test_equal_times_break_by_hash(spark):
    rows = [("k", "t", None, h) for h in ("b", "c", "a")]
    df = spark.createDataFrame(rows, "nct_id string, ingestion_ts string, last_update_date date, _record_hash string")
    assert [r._record_hash for r in dedupe_latest(df.repartition(3)).collect()] == ["c"]


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).select(
        F.concat(F.lit("k"), F.floor(F.rand(1)).cast("string")).alias("nct_id"), F.col("id").cast("string").alias("ingestion_ts"),
        F.lit(None).cast("date").alias("last_update_date"), F.lit("h").alias("_record_hash"),
    )
    plan = dedupe_latest(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
