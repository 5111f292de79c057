"""Fill-in-the-middle against plain Python, and the round trip."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ledgerloom.llm import fill_in_middle as fim


def _moved(doc_id, text, seed="1", rate=90, spm_rate=20):
    text = text or ""
    n = len(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return doc_id, n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def _got(df):
    return Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"seed": "x", "rate": 100, "spm_rate": 100}, {"rate": 0}])
def test_odd_rows(spark, odd_docs, options):
    docs = odd_docs
    for text in ("a <P> b", "<S>", "<<S", "S>M><", "\U0001f600́é\x00z" * 9, "<P", "日本" * 40):
        docs = docs.unionByName(spark.createDataFrame([(hash(text) % 1000, text)], "doc_id long, text string"), allowMissingColumns=True)
    want = Counter(_moved(r.doc_id, r.text, **options) for r in docs.collect())
    moved = fim.fill_in_middle(docs, **options)
    assert _got(moved) == want
    back = Counter((r.doc_id, r.text) for r in fim.restore_texts(moved).collect())
    assert back == Counter((r.doc_id, r.text or "") for r in docs.collect())


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(fim, "PART_BYTES", 7)
    text = "aé日\U0001f600<" * 50
    for a, b in ((0, 0), (3, 100), (250, 250), (17, 18)):
        numbers = [pa.array([x], pa.int64()) for x in (a, b, 0, 99)]
        ((_, _, n, form, pre, mid, out),) = fim.reorder(pa.array([text]), numbers, 90, 20)
        assert (n.to_pylist(), form.to_pylist(), pre.to_pylist(), mid.to_pylist()) == ([250], ["psm"], [a], [b - a])
        assert out.to_pylist() == [f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}"]
        assert fim.restored(out, form).to_pylist() == [text]


def test_very_long_text(spark):
    text = "".join(np.random.default_rng(3).choice(list("ab é日\n"), 3_000_000))
    docs = spark.createDataFrame([(5, text)], "doc_id long, text string")
    moved = fim.fill_in_middle(docs, rate=100)
    assert _got(moved) == Counter([_moved(5, text, rate=100)])
    assert fim.restore_texts(moved).first().text == text


def test_other_columns_and_names(spark, no_docs):
    assert fim.restore_texts(fim.fill_in_middle(no_docs)).count() == 0
    docs = spark.createDataFrame([("k", "some text here", "x", 3, "y")], ["my.id", "the text", "form", "n", "output"])
    row = fim.fill_in_middle(docs, "my.id", "the text", rate=100).first()
    assert tuple(row) == _moved("k", "some text here", rate=100)
