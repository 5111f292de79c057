from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import context as ctx
from ledgerloom.sinks.tables import run_rows
from ledgerloom.operators import gold, search

COLUMNS = "nct_id string, brief_title string, conditions string, brief_summary string, overall_status string, phase string"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            ("NCT1", "C++ study", "Diabetes Mellitus, Type 2", "heart", "RECRUITING", "P1"),
            ("NCT2", "Other", None, "HEART failure", "COMPLETED", None),
            ("NCT3", None, "asthma", None, "RECRUITING", "P2"),
        ],
        COLUMNS,
    )


def ids(df):
    return sorted(r.nct_id for r in df.collect())


def test_keyword_is_literal_unless_asked(rows):
    assert ids(search.keyword_search(rows, "c++")) == ["NCT1"]
    assert ids(search.keyword_search(rows, "HEART")) == ["NCT1", "NCT2"]
    assert ids(search.keyword_search(rows, "he.rt")) == []
    assert ids(search.keyword_search(rows, "he.rt", mode="regex")) == ["NCT1", "NCT2"]
    assert ids(search.keyword_search(rows, "")) == ["NCT1", "NCT2", "NCT3"]
    with pytest.raises(Exception):
        search.keyword_search(rows, "c++(", mode="regex")


def test_facets(rows):
    assert ids(search.facet_search(rows)) == ["NCT1", "NCT3"]
    assert ids(search.facet_search(rows, {"overall_status": [], "phase": ["P2"]})) == ["NCT3"]
    assert [r.phase for r in search.facet_values(rows, "phase").collect()] == ["P1", "P2"]


def test_fallback(rows):
    assert ids(search.keyword_or_all(rows, "asthma")) == ["NCT3"]
    assert ids(search.keyword_or_all(rows, "nothing like it", n=2)) == ["NCT1", "NCT2"]
    assert ids(search.keyword_or_all(rows.limit(0), "x")) == []


def test_labels_with_commas(spark, rows):
    from_text = {r.condition for r in gold.explode_labels(rows, min_length=1).collect()}
    assert from_text == {"Diabetes Mellitus", "Type 2", "asthma"}
    arrays = rows.select(F.array("conditions").alias("conditions"))
    from_arrays = {r.condition for r in gold.explode_labels(arrays, min_length=1).collect()}
    assert from_arrays == {"Diabetes Mellitus, Type 2", "asthma"}


def test_repeated_label_counts_twice_unless_asked(spark):
    df = spark.createDataFrame([("abc, abc", 5, True)], "conditions string, enrollment_count bigint, is_recruiting boolean")
    plain = gold.exploded_analytics(df).first()
    once = gold.exploded_analytics(df, distinct_labels=True).first()
    assert (plain.trial_count, plain.total_patients_enrolled) == (2, 10)
    assert (once.trial_count, once.total_patients_enrolled) == (1, 5)


def test_kpis_on_nothing_and_blank_sponsors(spark):
    schema = "lead_sponsor string, enrollment_count bigint, is_recruiting boolean, is_completed boolean, duration_days int"
    empty = gold.kpis(spark.createDataFrame([], schema)).first()
    assert (empty.total_trials, empty.total_enrollment, empty.recruitment_rate) == (0, 0, None)
    df = spark.createDataFrame([(s, 1, True, False, -3) for s in ("A", "", " ", None)], schema)
    assert gold.kpis(df).first().unique_sponsors == 1
    assert gold.kpis(df, count_null=True).first().unique_sponsors == 4
    assert gold.kpis(df).first().avg_duration == -3


HITS = (
    "query_id int, rank int, nct_id string, brief_title string, overall_status string, phase string, conditions string, "
    "lead_sponsor string, enrollment_count int, is_recruiting boolean, similarity double, similarity_raw double, document string"
)


@pytest.fixture(scope="module")
def records(spark):
    def hit(q, rank, sim, recruiting):
        return (q, rank, f"NCT{rank:08d}", "T", "S", "P", "C", "Org", 12345, recruiting, round(sim, 1), sim, "d" * 450)

    return spark.createDataFrame(
        [hit(1, 2, 50.126, True), hit(1, 1, 60.004, False), hit(2, 1, 10.0, False)], HITS
    ).repartition(3)


def test_context_text(records):
    got = {r.query_id: r.context for r in ctx.build_context(records).collect()}
    first, second = got[1].split("\n---\n")
    assert first == (
        "\nTRIAL 1 (Relevance: 60.0%)\nNCT ID     : NCT00000001\nTitle      : T\nStatus     : S\n"
        "Recruiting : No\nPhase      : P\nConditions : C\nSponsor    : Org\nEnrollment : 12,345 patients\n"
        "Summary    : " + "d" * 400 + "\n"
    )
    assert "Recruiting : YES - Currently Recruiting" in second


def test_metrics_and_tags(spark, records):
    m = {r.query_id: r for r in ctx.retrieval_metrics(records).collect()}
    assert (m[1].top1_similarity, m[1].min_similarity, m[1].avg_similarity) == (60.0, 50.13, 55.07)
    assert (m[1].recruiting_trials_found, m[1].trials_retrieved) == (1, 2)
    questions = spark.createDataFrame([(1, "q" * 120), (2, "short")], "query_id int, question string")
    tags = {r.query_id: r for r in ctx.run_tags(questions, records).collect()}
    assert tags[1].high_confidence and tags[1].recruiting_found and len(tags[1].query) == 100
    assert not tags[2].high_confidence and not tags[2].recruiting_found


def test_prompt_of_a_question_without_hits(spark, records):
    questions = spark.createDataFrame([(9, "any?")], "query_id int, question string")
    p = ctx.build_prompts(questions, ctx.build_context(records), ctx.TRACKED_FORM).first()
    assert p.prompt == "Question: any?\n\nTrials:\n"


def test_a_question_without_hits_counts(spark, records):
    questions = spark.createDataFrame([(1, "one"), (2, "two"), (3, "no hits")], "query_id int, question string")
    tags = {r.query_id: r for r in ctx.run_tags(questions, records).collect()}
    assert tags[3].recruiting_found is False and tags[3].high_confidence is False
    metrics = ctx.retrieval_metrics(records)
    lines = {r.query: r for r in ctx.compare_runs(questions, metrics).collect()}
    assert lines["no hits"].top1_similarity == 0 and lines["Averages"].top1_similarity == 23.3
    scores = ctx.evaluate(records, questions=questions).first()
    assert (scores.queries_tested, scores.avg_top1_similarity) == (3, 23.3)
    contexts = ctx.build_context(records)
    size = spark.createDataFrame([(5,)], "collection_size long")
    rows = {r.query_id: r for r in run_rows(questions, metrics, ctx.run_tags(questions, records), contexts, size, "e", 10, "run").collect()}
    assert len(rows) == 3 and rows["3"].top1_similarity is None and rows["3"].recruiting_found is False


@pytest.mark.parametrize(
    "answer, cited, supported, share",
    [
        ("see NCT00000001", 1, 1, 1.0),
        ("NCT00000001 NCT00000001 NCT99999999", 2, 1, 0.5),
        ("NCT0001 only", 0, 0, None),
        (None, 0, 0, None),
    ],
)
def test_citations(spark, records, answer, cited, supported, share):
    answers = spark.createDataFrame([(1, answer)], "query_id int, answer string")
    r = ctx.citation_check(answers, records).first()
    assert (r.cited, r.supported, r.supported_share) == (cited, supported, share)
