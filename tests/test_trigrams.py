"""The posting index and the automaton against plain search; labels with separators inside."""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.operators import keywords, trigrams
from ledgerloom.operators.search import keyword_search

COLUMNS = ("brief_title", "conditions", "brief_summary")


@pytest.fixture(scope="module")
def records(spark):
    words = "heart lung kidney liver brain study trial phase renal cardiac acute chronic".split()
    rows = [(f"NCT{i:05d}", f"{words[i % 12]} {words[i % 7]} {i}", None if i % 9 == 0 else f"{words[i % 5]}, rare{i}" , f"Summary of {words[(i * 7) % 12]}\nline {i}.") for i in range(900)]
    rows += [("NCTodd", "ÉTÉ Ünïcode 日本語テスト", "a.b*c (d)", "x" * 5000 + " needle " + "y" * 5000), (None, None, None, None), ("NCTdup", "heart", "", ""), ("NCTdup", "heart", "", "")]
    return spark.createDataFrame(rows, "nct_id string, brief_title string, conditions string, brief_summary string").cache()


@pytest.fixture(scope="module")
def base(records, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trigrams"))
    trigrams.write_index(records, path, block_records=60)
    return path


def _rows(df):
    return Counter(tuple(r) for r in df.select("nct_id", *COLUMNS).collect())


@pytest.mark.parametrize(
    ("keyword", "mode"),
    [("heart", "literal"), ("Rare77", "literal"), ("needle", "literal"), ("été ünï", "literal"), ("日本語", "literal"), ("a.b*c", "literal"), ("ea", "literal"), ("", "literal"), ("no such thing", "literal"),
     ("rare(11|22)\\b", "regex"), ("(heart|lung) (study|trial)", "regex"), ("kidn.y", "regex"), ("(nee)dle", "regex"), ("x+ needle", "regex"), ("(?:abc)?needle", "regex"), ("[hl]eart", "regex"), ("^summary of (renal|acute)", "regex"), ("line 8[0-9]{2}\\.", "regex"), (".", "regex"), ("rare(?=77)", "regex")],
)
def test_same_rows_as_plain_search(spark, records, base, keyword, mode):
    assert _rows(trigrams.index_search(spark, base, keyword, mode=mode)) == _rows(keyword_search(records, keyword, mode=mode))


def test_few_files_are_read(spark, base):
    every = set(spark.read.parquet(f"{base}/records").inputFiles())
    for keyword, mode, most in (("rare101", "literal", 1), ("needle", "literal", 1), ("rare(101|202)$", "regex", 2)):
        read = {f for f in trigrams.index_search(spark, base, keyword, mode=mode).inputFiles() if "/records/" in f}
        assert read < every and 1 <= len(read) <= most < len(every) / 4
    lists = trigrams.possible_records(spark, base, "needle")
    assert "PartitionFilters: [shard" in lists._jdf.queryExecution().toString() and lists.count() == 1


def test_records_are_added(spark, records, tmp_path):
    path = str(tmp_path)
    trigrams.write_index(records.limit(0), path)
    assert trigrams.index_search(spark, path, "heart").count() == 0
    before = set()
    for part in (records.filter("nct_id < 'NCT00500'"), records.filter("nct_id >= 'NCT00500' or nct_id is null")):
        trigrams.add_records(part, path, block_records=100)
        files = set(spark.read.parquet(f"{path}/records").inputFiles())
        assert before <= files
        before = files
    assert _rows(trigrams.index_search(spark, path, "heart")) == _rows(keyword_search(records, "heart"))


@settings(max_examples=200, deadline=None)
@given(st.from_regex(re.compile(r"(ab|[cd]e)+f?(ghi){1,2}x*"), fullmatch=True), st.text("abcdefghi ", max_size=8))
def test_a_match_has_what_its_pattern_needs(match, around):
    def has(needed, grams):
        if needed is None:
            return True
        if isinstance(needed, str):
            return needed in grams
        return (all if needed[0] == "and" else any)(has(p, grams) for p in needed[1])

    grams = set(trigrams.grams_of(around + match + around))
    assert has(trigrams.needed_grams(r"(ab|[cd]e)+f?(ghi){1,2}x*", "regex"), grams)
    assert has(trigrams.needed_grams(match), grams)


def test_every_occurrence_of_every_term(spark, records):
    terms = spark.createDataFrame([("Heart",), ("heart",), ("art",), ("aa",), ("日本",), ("",), (None,), ("nothing here",), (" ",)], "term string")
    docs = records.unionByName(spark.createDataFrame([("NCTa", "aaaa", None, "AAA")], records.schema))
    want = Counter()
    for r in docs.collect():
        for term in ("heart", "art", "aa", "日本", "nothing here", " "):
            n = sum(len(re.findall(f"(?={re.escape(term)})", (r[c] or "").lower())) for c in COLUMNS)
            if n:
                want[r.nct_id, term, n] += 1
    for pass_bytes in (1 << 20, 40):
        got = Counter(tuple(r) for r in keywords.count_terms(docs, terms, pass_bytes=pass_bytes).select("nct_id", "term", "occurrences").collect())
        assert got == want
    assert keywords.count_terms(docs, terms.limit(0)).count() == 0


def test_labels_with_separators_stay_whole(spark):
    known = spark.createDataFrame([("Diabetes Mellitus, Type 2",), ("Type 2",), ("Anemia, Iron Deficiency, Acute",), ("Flu",)], "label string")
    rows = [("Flu, Diabetes Mellitus, Type 2, Cold",), ("Type 2, Flu",), ("Anemia, Iron Deficiency, Acute",), ("Anemia, Iron Deficiency",), (None,), ("",), ("Diabetes Mellitus, Type 2, Diabetes Mellitus, Type 2",)]
    got = [r.label_list for r in keywords.split_known(spark.createDataFrame(rows, "conditions string"), known).collect()]
    assert got == [["Flu", "Diabetes Mellitus, Type 2", "Cold"], ["Type 2", "Flu"], ["Anemia, Iron Deficiency, Acute"], ["Anemia", "Iron Deficiency"], None, [""], ["Diabetes Mellitus, Type 2"] * 2]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from("abc"), min_size=1, max_size=7), st.sets(st.lists(st.sampled_from("abc"), min_size=2, max_size=3).map(", ".join), max_size=5))
def test_fewest_labels(pieces, known):
    def ways(rest):
        if not rest:
            return [[]]
        out = []
        for k in range(1, len(rest) + 1):
            name = ", ".join(rest[:k])
            if k == 1 or name in known:
                out += [[name, *more] for more in ways(rest[k:])]
        return out

    got = keywords.fewest(pieces, known, ", ")
    assert got in ways(pieces) and len(got) == min(map(len, ways(pieces)))


def test_a_run_of_records_gives_one_list_per_gram():
    texts = ["red widget", None, "Stra\u00dfe \U0001f600\U0001f601x", "", "wi", "red widget red"] * 20
    titles = ["dget", "a\x00bc", None, "\U0001f600\U0001f601x", "", "q"] * 20
    numbers = list(range(1 << 40, (1 << 40) + 120))
    blocks = [0] * 70 + [1] * 50
    whole = pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(numbers), pa.array(texts), pa.array(titles)], names=["b", "n", "t0", "t1"])
    found = [r for part in trigrams.posting_parts(iter([whole.slice(0, 0), whole.slice(3)])) for r in part.to_pylist()]
    want = {}
    for block, number, *columns in list(zip(blocks, numbers, texts, titles))[3:]:
        for gram in {g for c in columns if c for g in (c[i : i + 3] for i in range(len(c) - 2))}:
            want.setdefault((gram, block), []).append(number)
    assert {(r["gram"], r["_block"]): r["numbers"] for r in found} == want
    assert len(found) == len(want)


def test_records_cut_into_runs_have_all_their_grams(monkeypatch):
    monkeypatch.setattr(trigrams, "RUN_CHARS", 7)
    texts = ["abcd", "abc", "xbcde" * 9, None, "abcab"]
    batch = pa.RecordBatch.from_arrays([pa.array([2] * 5, pa.int32()), pa.array(range(5)), pa.array(texts)], names=["b", "n", "t0"])
    found = {}
    for part in trigrams.posting_parts(iter([batch])):
        for r in part.to_pylist():
            found.setdefault(r["gram"], set()).update(r["numbers"])
    assert found == {g: {k for k, t in enumerate(texts) if t and g in t} for t in texts if t for g in trigrams.grams_of(t)}
