import hashlib
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from logquarry.llm import wu_manber as W
from tests.llm.cases import MEDIUM, ROWS, documents, frame, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text, items, window=10):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words, hit, found = WORD.findall(low(text)), set(), set()
    for item, body in items:
        own = WORD.findall(low(body))
        size = min(window, len(own))
        for i in range(len(own) - size + 1 if own else 0):
            for at in range(len(words) - size + 1):
                if words[at : at + size] == own[i : i + size]:
                    hit.update(range(at, at + size))
                    found.add(item)
    return len(words), hit, found


def test_query(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{MEDIUM}/{name}.parquet'")
    got = rows(W.op8_wu_manber(spark, MEDIUM))
    assert got == sorted(con.execute(W.OP8_SQL).fetchall(), key=repr)
    assert sum(r[-1] for r in got) > 10


WORDS = st.lists(st.sampled_from(["a", "b", "A", "é", "É", "ab", "1"]), max_size=30).map(" ".join)


@settings(max_examples=300, deadline=None)
@given(WORDS, st.lists(WORDS, max_size=4), st.integers(1, 6))
def test_search_finds_every_occurrence(text, bodies, window):
    items = [(f"i{k}", b) for k, b in enumerate(bodies)]
    tables = W.searches([(k, b.encode()) for k, b in items], window)
    words = W.words_of(text.encode())
    spans, found = W.hits(words, tables)
    count, hit, want = brute(text, items, window)
    assert len(words) == count and found == want
    assert {k for b, e in spans for k in range(b, e)} == hit
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_clean_text_is_skipped():
    """The window moves nine words on where a pair of words is in no pattern."""
    search = W.Search(10, {tuple(b"p%d" % i for i in range(10)): ["x"]})
    looked = []
    key = search._key
    search._key = lambda words, end: looked.append(end) or key(words, end)
    assert list(search.occurrences([b"w%d" % i for i in range(10_000)])) == []
    assert len(looked) < 10_000 / 8


@pytest.mark.parametrize("portion,scan", [(1, 8), (1, 1), (1, 2), (60, 8), (2_000_000, 8)])
def test_portions_of_a_large_test_set(spark, monkeypatch, portion, scan):
    monkeypatch.setattr(W, "SEARCH_BYTES", portion)
    monkeypatch.setattr(W, "SCAN_SEARCHES", scan)
    items = [("i1", "so it goes on " * 4), ("i2", "the QUICK brown"), ("i3", "One"), ("i3", "far away"), ("i4", ""), ("10", "it goes on so it goes on so it goes on so")]
    docs = frame(spark)
    got = W.find_passages(docs, spark.createDataFrame(items, "item_id string, text string")).collect()
    want = []
    for key, text, *_ in ROWS:
        if text and len(text) > 100_000:
            continue
        count, hit, found = brute(text, items)
        want.append((key, text, count, len(hit), sorted(found)))
    got = [
        (r.doc_id, r.text, r.n_words, sum(s.end - s.begin for s in r.spans), r["items"])
        for r in got
        if not r.text or len(r.text) <= 100_000
    ]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_digest_of_items(spark):
    got = W.op8_wu_manber(spark, MEDIUM).filter("n_items = 0").first()
    assert got.items_sha256 == hashlib.sha256(b"").hexdigest()


def test_clean_documents_stay(spark):
    docs = documents(spark, MEDIUM)
    benchmark = spark.read.parquet(f"{MEDIUM}/benchmark.parquet")
    bad = {r.doc_id for r in W.op8_wu_manber(spark, MEDIUM).filter("contaminated").collect()}
    kept = {r.doc_id for r in W.remove_contaminated(docs, benchmark).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - bad and bad
