"""Operators beyond SQL, against brute force on whole small tables or odd rows."""

from __future__ import annotations

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from ledgerloom.llm import (
    decontaminate,
    exact_topk,
    language_id,
    licences,
    ngram_join,
    piece_transducer,
    substring_dedup,
    token_files,
    toxicity,
    url_filter,
)
from ledgerloom.session import scratch_path

BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


# -- op1 ---------------------------------------------------------------------


def _words(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def _contamination(docs, items):
    out = []
    for doc_id, text in docs:
        words, hit, found = _words(text), set(), set()
        for item_id, item in items:
            own = _words(item)
            n = min(13, len(own))
            windows = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
            for i in range(len(words) - n + 1) if n else ():
                if tuple(words[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    if item_id is not None:
                        found.add(str(item_id))
        out.append((doc_id, len(words), len(hit), tuple(sorted(found))))
    return Counter(out)


def test_contamination(spark, odd_docs):
    base = [f"w{i}" for i in range(120)]
    items = [(1, " ".join(base[40:70])), (2, " ".join(base[3:15])), (3, "Two"), (4, None), (5, ""), (None, " ".join(base[90:110])), (11, " ".join(base[40:70])), (12, "...")]
    docs = odd_docs  # a very long text among them
    found = decontaminate.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    got = Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found.collect())
    assert got == _contamination(_rows(docs), items)


def test_repeated_words_and_overlaps(spark):
    texts = ["a " * 40, "b " * 5 + "a " * 20, " ".join("xyz"[i % 3] for i in range(50)), "a b " * 13]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = [(1, "a " * 15), (2, "x y z " * 6), (3, "b a " * 7)]
    found = decontaminate.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found.collect()) == _contamination(_rows(docs), items)


def test_words_repeated_ever_so_often(spark):
    """A word, a pair and a stretch of words repeated on both sides: rows as many as words."""
    import time

    texts = ["la " * 50_000, "la lu " * 20_000, "x " + "a b c d e f g h i j k l m n o " * 3_000, "la " * 12]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(1, "la " * 30_000), (2, "lu la " * 9_000), (3, "a b c d e f g h i j k l m n o " * 40)], "item_id long, text string")
    began = time.monotonic()
    found = {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in decontaminate.find_contamination(docs, items).collect()}
    assert found == {0: (50_000, 50_000, ["1"]), 1: (40_000, 40_000, ["2"]), 2: (45_001, 45_000, ["3"]), 3: (12, 0, [])}
    assert time.monotonic() - began < 60


def test_contamination_of_nothing(spark, odd_docs, no_docs):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(no_docs, empty).count() == 0
    assert {r.n_hit for r in decontaminate.find_contamination(odd_docs, empty).collect()} == {0}
    assert decontaminate.drop_contaminated(odd_docs, empty).count() == odd_docs.count()


# -- op2 ---------------------------------------------------------------------


def _cosine(words, template, idf, other):
    a, b = (Counter(x) for x in (words, template))
    wa, wb = ({t: n * idf.get(t, other) for t, n in c.items()} for c in (a, b))
    dot = sum(v * wb[t] for t, v in wa.items() if t in wb)
    return dot / math.sqrt(sum(v * v for v in wa.values()) * sum(v * v for v in wb.values()) or 1.0)


def test_licences(spark):
    split = lambda t: re.findall(r"[a-z0-9\x80-\U0010ffff]+", t.lower())
    files = [
        ("a/LICENSE", "Some words of nobody.\nReleased under the MIT License."),
        ("a/b/x.py", "import os sys json math\nreleased under the mit license\nand many more words of its own than a statement has in a file"),
        ("a/b/y.py", "nothing here"),
        ("a/b/c/COPYING.txt", "Licensed under the Apache License, Version 2.0."),
        ("a/b/c/d/z.py", None),
        ("a/b/c/e.py", ""),
        ("top.py", "the under is a version of work"),
        ("a/b/y.py", "nothing here"),
        (None, "Licensed under CC BY-NC 4.0."),
    ]
    df = spark.createDataFrame([(p, t, "mine") for p, t in files], "path string, text string, licence string")
    got = licences.scan_licences(df).collect()
    n = len(files)
    with_word = Counter(w for _, t in files for w in set(split(t or "")))
    idf = defaultdict(float, {w: math.log((1 + n) / (1 + with_word[w])) + 1 for t in licences.TEMPLATES.values() for w in split(t)})
    other = math.log((1 + n) / 2) + 1
    for path, text in files:
        best = max(((round(_cosine(split(line), split(t), idf, other), 9), name) for line in (text or "").split("\n") if split(line) for name, t in licences.TEMPLATES.items()), default=(0, None))
        rows = [r for r in got if r.path == path]
        if best[0] >= licences.THRESHOLD:
            assert {(r.licence, round(r.similarity, 9), r.via) for r in rows} == {(best[1], best[0], "own")}
    by_path = {r.path: (r.licence, r.via, r.directory) for r in got}
    assert len(got) == n
    assert by_path["a/b/y.py"] == ("MIT", "directory", "a")
    assert by_path["a/b/c/d/z.py"] == by_path["a/b/c/e.py"] == ("Apache-2.0", "directory", "a/b/c")
    assert by_path["top.py"] == (None, None, None)
    assert by_path[None][0] == "CC-BY-NC-4.0"
    assert licences.scan_licences(df.limit(0)).count() == 0


# -- op3 ---------------------------------------------------------------------


def _components(docs):
    sets, n = {}, []
    for doc_id, text in docs:
        w = (text or "").encode().lower().split()
        s = frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset({tuple(w)} if w else ())
        n.append((doc_id, len(s)))
        if doc_id is not None:
            sets[doc_id] = s
    label = {i: i for i in sets}

    def find(i):
        return i if label[i] == i else find(label[i])

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            x, y = sets[a], sets[b]
            both = len(x & y) if x and y else 0
            if both and 100 * both >= 80 * (len(x) + len(y) - both):
                p, q = sorted((find(a), find(b)))
                label[q] = p
    return Counter((i, k, None if i is None else find(i)) for i, k in n)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(odd_docs).collect())
    assert got == _components(_rows(odd_docs))
    assert ngram_join.near_duplicates(no_docs).count() == 0


def test_near_duplicates_of_a_large_group(spark, monkeypatch):
    """Copies with edits: some reach the smallest id only through others; lists are long."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(160):
        words = list(base)
        for at in rng.choice(150, int(rng.integers(0, 6)), replace=False):
            words[at] = f"x{rng.integers(1 << 30)}"
        docs.append((int(i), " ".join(words[: int(rng.integers(128, 151))])))
    monkeypatch.setattr(ngram_join, "SHORT_LIST", 4)
    monkeypatch.setattr(ngram_join, "FREQUENT_LEVEL", 3)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(df).collect())
    assert got == _components(docs)


# -- op4 ---------------------------------------------------------------------


def test_top_k(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in rng.normal(0, 0.3, 6)]) for i in range(400)]
    rows += [(7, rows[9][1]), (401, None), (402, []), (403, [float("nan")] * 6), (404, [None] + [0.1] * 5), (None, [0.1] * 6), (405, [0.5] * 3), (420, [1e300] * 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = exact_topk.whole_numbers(df, 64, "vec_id", "embedding")
    got = Counter((r.query_id, r.rank, r.vec_id, r.score) for r in exact_topk.exact_topk(vectors, vectors.filter("vec_id % 20 = 0"), 5).collect())
    usable = [(i, np.floor(64 * np.array(v)).astype(int)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) and abs(x) < 1e6 for x in v)]
    want = Counter()
    for q, x in usable:
        if q % 20 == 0:
            best = sorted((-int(x @ y), c) for c, y in usable if c != q and len(y) == len(x))[:5]
            want.update((q, k + 1, c, -s) for k, (s, c) in enumerate(best))
    assert got == want
    assert exact_topk.exact_topk(vectors.limit(0), vectors.limit(0), 5).count() == 0


@pytest.mark.parametrize("lists", [1, 5, 100])
def test_bounds_lose_nothing(lists):
    """Clustered vectors: most queries stop before the lists' ends."""
    rng = np.random.default_rng(2)
    centres = rng.integers(-60, 60, (8, 16))
    rows = np.vstack([c + rng.integers(-6, 6, (300, 16)) for c in centres]).astype(float)
    ids, queries = np.arange(len(rows)), rows[::97]
    reader = exact_topk.Reader(ids[::97], queries, 10, lists)
    for a in range(0, len(rows), 700):
        reader.read(ids[a : a + 700], rows[a : a + 700])
    assert reader.entries_read < 0.7 * reader.entries
    for q, (found, _) in zip(ids[::97], reader.best):
        scores = rows @ rows[q]
        want = sorted((-s, i) for i, s in zip(ids, scores) if i != q)[:10]
        assert found.tolist() == [i for _, i in want]


def test_most_candidates_are_shut_out_for_many_queries_at_once(monkeypatch):
    """Random vectors, whose bounds close late: a query goes on alone with the few that are left."""
    rng = np.random.default_rng(5)
    rows = rng.integers(-60, 60, (6000, 32)).astype(float)
    ids, alone = np.arange(6000) // 2, []  # every id twice
    narrow = exact_topk.Reader._narrow
    monkeypatch.setattr(exact_topk.Reader, "_narrow", lambda *x: alone.append(len(x[5])) or narrow(*x))
    reader = exact_topk.Reader(ids[::40], rows[::40], 7)
    for a in range(0, 6000, 2000):
        reader.read(ids[a : a + 2000], rows[a : a + 2000])
    assert len(alone) == 3 * 150 and sum(alone) <= 150 * 3 * exact_topk.ALONE
    for q, x, (found, scores) in zip(ids[::40], rows[::40], reader.best):
        want = sorted((-int(s), i) for i, s in zip(ids.tolist(), rows @ x) if i != q)[:7]
        assert list(zip((-scores).tolist(), found.tolist())) == want


@pytest.mark.parametrize("path", ["sf0.001", "sf0.1"])
def test_lists_are_not_read_to_their_ends_on_the_given_vectors(path):
    import duckdb

    found = duckdb.sql(f"select vec_id, embedding from '/root/testdata/{path}/embeddings.parquet' order by vec_id").fetchall()
    ids, rows = np.array([i for i, _ in found]), np.floor(64 * np.array([v for _, v in found], np.float64))
    asked = np.flatnonzero(ids % 20 == 0)
    reader = exact_topk.Reader(ids[asked], rows[asked], 20)
    reader.read(ids, rows)
    for q, (best, scores) in zip(asked, reader.best):
        want = sorted((-int(s), i) for i, s in zip(ids.tolist(), rows @ rows[q]) if i != ids[q])[:20]
        assert list(zip((-scores).tolist(), best.tolist())) == want
    share = reader.entries_read / reader.entries
    print(f"share of entries read: {share:.3f}")
    assert share < 1


def test_sums_beyond_doubles_are_exact():
    big = (1 << 27) - 1
    rows = np.array([[big, big - k, 1] for k in range(300)], np.float64)
    reader = exact_topk.Reader(np.array([0]), rows[:1], 3)
    reader.read(np.arange(300), rows)
    want = [big * big + big * (big - k) + 1 for k in (1, 2, 3)]
    assert reader.best[0][0].tolist() == [1, 2, 3] and reader.best[0][1].tolist() == want


@pytest.mark.parametrize("lists", [1, 4, 100])
def test_many_rows_of_a_query_id_hide_no_neighbour(lists):
    """A third of the rows have the query's id and the highest scores."""
    rng = np.random.default_rng(3)
    rows = rng.integers(-60, 60, (600, 8)).astype(float)
    ids = np.arange(600)
    ids[::3] = 0
    rows[::3] = 60 * np.sign(rows[0]) + rng.integers(0, 2, (200, 8))
    reader = exact_topk.Reader(np.array([0, 0, 1]), rows[[0, 3, 1]], 10, lists)
    for a in range(0, 600, 200):
        reader.read(ids[a : a + 200], rows[a : a + 200])
    for q, x, (found, _) in zip([0, 0, 1], rows[[0, 3, 1]], reader.best):
        want = sorted((-s, i) for i, s in zip(ids, rows @ x) if i != q)[:10]
        assert found.tolist() == [i for _, i in want]


# -- op5 ---------------------------------------------------------------------


def _check_files(spark, docs, rows):
    from tokenizers import Tokenizer

    folder = scratch_path(spark, "token-files")
    token_files.write_token_files(docs, folder, BPE, 1)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_token_files(spark, folder, "ids_crc32").collect()]
    ids = {(r.start): r.ids for r in token_files.read_token_files(spark, folder).collect()}
    encoder, start, want = Tokenizer.from_file(BPE), 0, []
    for r in sorted(got, key=lambda r: r[1]):
        assert zlib.crc32(np.array(ids[r[1]], "<u4").tobytes()) == r[3] and r[1] == start
        start += r[2]
    for doc_id, text in rows:
        own = [*encoder.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc_id, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    assert Counter((a, c, d) for a, _, c, d in got) == Counter(want)
    order = [a for a, *_ in sorted(got, key=lambda r: r[1])]
    assert order == sorted(order, key=lambda i: (i is not None, i))


def test_token_files(spark, odd_docs, no_docs):
    _check_files(spark, odd_docs, _rows(odd_docs))
    _check_files(spark, no_docs, [])


def test_token_files_of_hard_texts(spark):
    texts = ["don't can't I'LL it's", "<|endoftext|> x<|startoftext|>y <|ENDOFTEXT|>", "É é e\u0301 ﬁ ½ ² ×2 ÷", "a\u00a0b\u2003c", "1234,567.89!!?", "“quotes”—dash…", "日本語 中文", "x\x00y\x1fz", "ÀÖØöø ÿ", "'s 'S 't"]
    rows = list(enumerate(texts))
    _check_files(spark, spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_tokenizers_that_cut_in_other_ways_are_refused(spark, odd_docs):
    with pytest.raises(ValueError, match="lower-case"):
        token_files.write_token_files(odd_docs, scratch_path(spark, "refused"), public_tokenizers.path("byte_bpe_50k.json"), 50256)
    token_files.check_tokenizer(BPE)


# -- op6 ---------------------------------------------------------------------


def _kept(docs, window):
    least = {}
    big = 1 << 63
    for doc_id, text in docs:
        w = (text or "").encode().split()
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            least[k] = min(least.get(k, big), big if doc_id is None else doc_id)
    out = []
    for doc_id, text in docs:
        w = (text or "").encode().split()
        gone = set()
        for i in range(len(w) - window + 1):
            if least[tuple(w[i : i + window])] < (big if doc_id is None else doc_id):
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [3, 50])
def test_substring_removal(odd_docs, no_docs, window):
    docs = odd_docs.filter("doc_id is null or doc_id <> 6") if window == 3 else odd_docs
    found = substring_dedup.remove_repeated_spans(docs, window)
    assert found.columns == ["doc_id", "text", "n", "class", "n_words", "n_removed", "spans"]
    got, spans = [], 0
    for r in found.collect():
        got.append((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()))
        assert r.n_removed == sum(s.end - s.start for s in r.spans)
        spans += len(r.spans)
    assert Counter(got) == _kept(_rows(docs), window) and spans
    assert substring_dedup.remove_repeated_spans(no_docs).count() == 0


def test_texts_without_removals_stay_as_they_are(spark):
    rows = [(1, " a\n\nb  c "), (2, "a b\tc d e"), (3, "x\n a b c\n y z ")]
    found = substring_dedup.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()
    assert {r.doc_id: r.text for r in found} == {1: " a\n\nb  c ", 2: "d e", 3: "x\n y z "}


def test_windows_are_dealt_in_a_few_columns_of_memory():
    """Ids and both hashes of a window take 24 bytes; ordering and dealing them may take twice as much again."""
    rng = np.random.default_rng(6)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 5000, 400)) for _ in range(2200)]
    texts += texts[:300]  # of larger ids
    batch = pa.RecordBatch.from_pydict({"doc_id": np.arange(len(texts)), "text": texts})
    deal = substring_dedup._deal(50, 7)
    list(deal(iter([batch.slice(0, 5)])))  # powers are made once
    windows = len(texts) * 351
    tracemalloc.start()
    try:
        dealt = sum(len(out.column(4).values) for out in deal(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert dealt == windows  # those of the last 300 texts are known to repeat
    assert peak < 100 * windows


# -- op7 ---------------------------------------------------------------------


def test_a_hot_id_breaks_no_bound(spark):
    """One id with very many rows: the sample holds different documents only."""
    rows = [(1, f"un texte {i % 9}", "fr") for i in range(20_000)] + [(i, f"a text {i}", "en") for i in range(2, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    seen = []
    real = language_id.Network.train
    language_id.Network.train = lambda self, windows, labels, *a, **k: seen.append(np.bincount(labels))
    try:
        language_id.train_language_id(docs, docs=5, per_doc=2)
    finally:
        language_id.Network.train = real
    assert seen[0].tolist() == [5, 5]


def test_language_id(spark, small_dir, odd_docs, no_docs):
    docs = spark.read.parquet(f"{small_dir}/documents.parquet")
    known = docs.filter("crc32(cast(cast(doc_id as string) as binary)) % 4 <> 2")
    network, languages = language_id.train_language_id(known, steps=200)
    found = {r.doc_id: r for r in language_id.identify_languages(docs, network, languages).collect()}
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held_out = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([found[i].lang_pred == truth[i] for i in held_out]) >= 0.9
    assert all(0 <= r.score <= 1 for r in found.values())
    odd = language_id.identify_languages(odd_docs, network, languages).collect()
    assert len(odd) == odd_docs.count()
    assert {r.lang_pred for r in odd if r.doc_id in (3, 4, 5)} == {"und"}
    assert language_id.identify_languages(no_docs, network, languages).count() == 0
    assert language_id.train_language_id(no_docs.withColumnRenamed("class", "lang")) == (None, [])
    assert {r.lang_pred for r in language_id.identify_languages(odd_docs, None, []).collect()} == {"und"}


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    network = language_id.Network(3, 4)
    network.p = {k: v.astype(np.float64) for k, v in network.p.items()}
    codes, labels = rng.integers(0, 20, (12, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    grads = network.gradients(codes, labels)

    def loss():
        return -np.log(network.forward(codes)[:, np.arange(5), labels]).mean()

    for name, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept = network.p[name][at]
        network.p[name][at] = kept + 1e-2
        up = loss()
        network.p[name][at] = kept - 1e-2
        assert abs((up - loss()) / 2e-2 - g[at]) < 2e-3 * max(1, abs(g[at])), name
        network.p[name][at] = kept


# -- op8 ---------------------------------------------------------------------


def test_urls(spark):
    urls = [None, "", "example.net/en/", "http://", "https://Example.NET/en/1?x#y", "https://example.net/en", "http://a.b.net", "http://a.net/", "http://net/x", "http://xnet/y", "http://x.example.com/de/a", "http://myexample.com/de/a", "ftp://w.org/fr/?q=//net/", "http://w.org?/fr/", "http://w.org#a/fr/", "http://u@x.net:80/a", "a://b://c.net/d", "http://net./x", "http://ÄB.net/é"]
    pages = spark.createDataFrame([(i // 2, u, "r") for i, u in enumerate(urls + urls)], "page_id long, url string, rule string")
    rules = spark.createDataFrame(url_filter.CONTRACT_RULES, "host string, path string, action string")
    got = Counter((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(pages, rules).collect())
    want = Counter()
    for i, u in enumerate(urls + urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        whole = re.match(r"[^?#]*", rest)[0]
        host = re.match(r"[^/]*", whole)[0]
        path, host = whole[len(host) :], host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        fits = [(len(h), len(p), h + p, v) for h, p, v in url_filter.CONTRACT_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        want[(i // 2, host, path, best[2], best[3])] += 1
    assert got == want
    assert {r.verdict for r in url_filter.judge_urls(pages, rules.limit(0), default="allow").collect()} == {"allow"}
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0


def test_the_filter_passes_every_listed_key(spark):
    rules = spark.range(5000).selectExpr("concat('h', id, '.com') as host", "'/' as path", "'block' as action")
    n_blocks = 320
    blocks = url_filter.bloom_blocks(rules, n_blocks)
    probes = spark.range(10_000).selectExpr("concat('h', id, '.com') as host_end", "'/' as path_start")
    passed = {r.host_end for r in url_filter.possible_hits(probes, blocks, n_blocks).collect()}
    assert {f"h{i}.com" for i in range(5000)} <= passed
    assert len(passed) < 6000


# -- op9 ---------------------------------------------------------------------


def test_pieces(spark, small_dir, odd_docs, no_docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    hard = ["a  b", "   ", "▁x ▁", "<s></s><0x41>", "梦😀", "\ufffd", "aaaaaaaaaaaaaaaaa", "foo();\n\n\tbar", "1999 2000", "e\u0301"]
    docs = odd_docs.select("doc_id", "text", "class").union(spark.createDataFrame([(100 + i, t, "c") for i, t in enumerate(hard)], "doc_id long, text string, class string"))
    docs = docs.union(spark.read.parquet(f"{small_dir}/documents.parquet").selectExpr("doc_id + 1000", "text", "lang"))
    encoded = piece_transducer.encode_pieces(docs, PIECES)
    assert {r.round_trip for r in piece_transducer.encode_pieces(docs, PIECES, check_col="round_trip").collect()} == {True}
    assert encoded.columns == ["doc_id", "class", "ids"]
    want = Counter((i, tuple(sp.encode(t or ""))) for i, t in _rows(docs))
    assert Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect()) == want
    decoded = piece_transducer.decode_pieces(encoded, PIECES)
    assert Counter(_rows(decoded)) == Counter((i, (t or "").replace("▁", " ")) for i, t in _rows(docs))
    assert piece_transducer.encode_pieces(no_docs, PIECES).count() == 0


# -- op10 --------------------------------------------------------------------


def test_nearest_examples_are_exact():
    rng = np.random.default_rng(4)
    vectors = []
    for _ in range(500):
        terms = np.sort(rng.choice(60, int(rng.integers(0, 8)), replace=False))
        w = rng.random(len(terms)) + 0.1
        vectors.append((terms, w / np.sqrt((w**2).sum()) if len(w) else w))
    index = toxicity.Examples.of(vectors, np.zeros(500), np.ones(500), 0.1, 60)
    dense = np.zeros((500, 60))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for i in range(0, 500, 7):
        t, w = vectors[i]
        if not len(t):
            continue
        found, cosines = index.nearest(t, w, 9)
        scores = np.round(dense @ dense[i], 12)
        want = sorted((-s, j) for j, s in enumerate(scores) if s > 0)[:9]
        assert np.allclose(cosines, [-s for s, _ in want])
        assert set(found[cosines > cosines[-1] + 1e-9]) <= {j for _, j in want}


def test_toxicity(spark, odd_docs, no_docs):
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(400)]
    rows, labels = [], []
    for i in range(600):
        text, bad = list(rng.choice(words, 60)), i % 6 == 0
        if bad:
            for at in rng.choice(60, 3):
                text[at] = rng.choice(["vilest", "vilely", "nasty", "horrid"])
        rows.append((i, " ".join(text)))
        labels.append((i, int(bad), "x"))
    labels += [(None, 1, "x"), (5, None, "x"), (5, 0, "x"), (9999, 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int, score string")
    scored = toxicity.score_toxicity(docs, toxicity.training_labels(known)).collect()
    held_out = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(scored) == 600 and held_out
    assert all((r.score >= 0.5) == (r.doc_id % 6 == 0) for r in held_out)
    assert all(r.evidence for r in scored if r.score >= 0.5)
    assert toxicity.drop_toxic(docs, known).count() == 500
    odd = toxicity.score_toxicity(odd_docs, known).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score < 0.5 for r in odd)
    assert toxicity.score_toxicity(no_docs, known).count() == 0
    assert {r.score for r in toxicity.score_toxicity(odd_docs, known.limit(0)).collect()} == {0.0}


def test_texts_without_telling_terms_are_searched(spark):
    """Few labels tell no term apart; the nearest example is found by all terms all the same."""
    rows = [(i, " ".join(f"t{i}x{j}" for j in range(8)) + " shared words") for i in range(20)]
    rows += [(100 + i, text.replace("shared words", "")) for i, text in rows[:20]]
    docs = spark.createDataFrame([*rows, (300, "nothing of theirs")], "doc_id long, text string")
    known = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(20)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in toxicity.score_toxicity(docs, known).collect()}
    for i in range(20):
        best = max(found[100 + i].evidence, key=lambda e: e.cosine)
        assert (best.example, best.label) == (i, int(i % 4 == 0)) and best.cosine > 0.5
        assert (found[100 + i].score >= 0.5) == (i % 4 == 0)
    assert found[300].evidence == []


def test_cosines_are_those_of_all_terms(spark):
    """Against brute force: all words, idf of all documents."""
    rng = np.random.default_rng(8)
    words = [f"{a}{b}" for a in ("stem", "root", "leafage", "x") for b in range(30)]
    texts = {i: " ".join(rng.choice(words, int(rng.integers(1, 40)))) for i in range(90)}
    labels = {i: int(rng.random() < 0.4) for i in range(60)}
    bags = {i: Counter(t.split()) for i, t in texts.items()}
    known = sorted({t for i in labels for t in bags[i]}, key=str)
    have = lambda ids: np.array([sum(t in bags[i] for i in ids) for t in known])
    weight = np.log(91 / (1 + have(texts))) + 1
    vectors = np.array([[1 + math.log(bags[i][t]) if bags[i][t] else 0 for t in known] for i in texts]) * weight
    vectors /= np.maximum(np.sqrt((vectors**2).sum(1)), 1e-12)[:, None]
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    scored = toxicity.score_toxicity(docs, spark.createDataFrame(list(labels.items()), "doc_id long, toxic int"), neighbours=7)
    for r in scored.collect():
        want = np.sort([vectors[i] @ vectors[r.doc_id] for i in range(60) if i != r.doc_id])[::-1][:7]
        assert np.allclose([e.cosine for e in r.evidence], want[want > 0])
        assert all(abs(vectors[e.example] @ vectors[r.doc_id] - e.cosine) < 1e-9 for e in r.evidence)


def test_repeated_rows_crowd_out_no_example(spark):
    """One labelled id with more rows than the bound, and every row twice: both labels stay."""
    rows = [(i, f"{'vile nasty' if i % 2 else 'kind gentle'} w{i}") for i in range(16)] * 2
    rows += [(0, f"kind gentle copy{i}") for i in range(40)] + [(50, "vile nasty"), (51, "kind gentle")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([(i, i % 2) for i in range(16)] * 3, "doc_id long, toxic int")
    found = toxicity.score_toxicity(docs, known, examples=8).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.score >= 0.5 for r in found if r.doc_id >= 50} == {50: True, 51: False}
    near = next(r.evidence for r in found if r.doc_id == 50)
    assert {e.label for e in near if e.cosine > 0.5} == {1} and len({e.example for e in near if e.label}) == len([e for e in near if e.label])
