import re
from collections import Counter, defaultdict

import pytest

from logquarry.llm import mixing as M
from tests.llm.cases import SMALL, documents, rows


def targets(sizes, weights, passes=3):
    """Shares of the sum of sizes by weight, none above ``passes`` times its size, source by source."""
    out, left = [0.0] * len(sizes), float(sum(sizes))
    open_ = {k for k, size in enumerate(sizes) if size}
    while open_:
        unit = left / sum(weights[k] for k in open_)
        full = {k for k in open_ if unit * weights[k] > passes * sizes[k]}
        for k in full or open_:
            out[k] = float(passes * sizes[k]) if full else unit * weights[k]
        if not full:
            break
        left -= sum(out[k] for k in full)
        open_ -= full
    return out


@pytest.mark.parametrize(
    "sizes,want",
    [
        ([100, 100, 100], [187.5, 75.0, 37.5]),
        # The first stops at three times its size; what is left is shared 2 to 1.
        ([10, 100, 100], [30.0, 120.0, 60.0]),
        # Then the second stops as well.
        ([10, 20, 180], [30.0, 60.0, 120.0]),
        ([0, 5], [0.0, 5.0]),
        ([], []),
        ([0], [0.0]),
    ],
)
def test_targets(spark, sizes, want):
    assert targets(sizes, [5, 2, 1]) == want
    df = spark.createDataFrame([(i, chr(97 + i), n) for i, n in enumerate(sizes)], "doc_id long, source string, size long")
    found = sorted(M.source_table(df).collect())
    assert [r.target for r in found] == pytest.approx(want) and [r.k for r in found] == list(range(len(sizes)))


def test_many_sources(spark):
    """In the order of code points over all parts, null last, with sums of their slots."""
    names = [f"s{i * 7919 % 3_000}" for i in range(3_000)] + ["\U0001f389", "\uffee", "", None]
    data = [(i, s, i * i % 400) for i, s in enumerate(names)]
    found = M.source_table(spark.createDataFrame(data, "doc_id long, source string, size long"), block=16).collect()
    found.sort(key=lambda r: r.k)
    order = sorted((n for n in names if n is not None), key=lambda n: n.encode()) + [None]
    assert [r.source for r in found] == order and [r.k for r in found] == list(range(len(names)))
    sizes = {s: n for _, s, n in data}
    want = targets([sizes[n] for n in order], [M.WEIGHTS[k % 3] for k in range(len(order))])
    assert [r.target for r in found] == pytest.approx(want)
    until = 0
    for r in found:
        quota = min(int(r.target + 0.5), 3 * r.words)
        assert r.quota == quota and r.blocks == -(-r.words // 16)
        assert r.slots == (quota // r.words * r.blocks + -(-(quota % r.words) // 16) if r.words else 0)
        until += r.slots
        assert r.until == until


@pytest.mark.parametrize("folder", ["many", "small"])
def test_more_sources_than_are_broadcast(spark, monkeypatch, folder):
    if folder == "many":
        df = spark.createDataFrame([(i, f"s{i % 500}", i % 90) for i in range(3_000)], "doc_id long, source string, size long")
    else:
        df = M.sized_rows(documents(spark), "doc_id", "source", "text")
    few = [rows(f) for f in M.mix(df)]
    monkeypatch.setattr(M, "BROADCAST_SOURCES", 0)
    assert [rows(f) for f in M.mix(df)] == few


def test_query(spark):
    docs = {r.doc_id: r for r in documents(spark).collect()}
    got = M.op3_golden_mix(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    sizes, taken, target = Counter(), Counter(), {}
    for r in got:
        assert r["size"] == len(re.findall("[^\x20\x09-\x0d]+", docs[r.doc_id].text))
        assert 0 <= r.taken <= 3 * r["size"]
        sizes[r.source] += r["size"]
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(r.source_size == sizes[r.source] for r in got)
    names = sorted(sizes)
    want = targets([sizes[n] for n in names], [M.WEIGHTS[k % 3] for k in range(len(names))])
    assert [target[n] for n in names] == pytest.approx(want)
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[n] - target[n]) <= 1 for n in names)


def test_reruns_agree(spark):
    docs = documents(spark)
    first = rows(M.mix(M.sized_rows(docs, "doc_id", "source", "text"))[0])
    second = rows(M.mix(M.sized_rows(docs.repartition(13), "doc_id", "source", "text"))[0])
    assert first == second


@pytest.mark.parametrize("block,piece", [(1, 20_000), (7, 3), (256, 50)])
def test_the_mix_takes_what_it_says(spark, monkeypatch, block, piece):
    """Pieces of a source run through its documents over and over, none left out."""
    monkeypatch.setattr(M, "PIECE_ROWS", piece)
    data = [(i, f"s{i % 4}", (i * 37) % 60) for i in range(200)] + [(900, None, 5), (901, None, 0), (5, "s1", 5)]
    df = spark.createDataFrame(data, "doc_id long, source string, size long")
    taken, mixed = M.mix(df, block=block)
    taken, mixed = taken.collect(), mixed.collect()
    sums = Counter()
    covered = defaultdict(Counter)
    for p in mixed:
        key = (p.doc_id, p.source, p["size"])
        sums[key] += p.words
        assert p.words <= block
        for w in range(p.first_word, p.first_word + p.words):
            covered[key][w] += 1
    by_source = Counter()
    for r in taken:
        key = (r.doc_id, r.source, r["size"])
        assert sums[key] == r.taken
        by_source[r.source] += r.taken
        passes = covered[key].values()
        # Every word as often as the others, but for one pass that ends within the document.
        assert not passes or max(passes) - (min(passes) if len(passes) == r["size"] * r.copies else 0) <= 1
    for r in taken:
        assert abs(by_source[r.source] - r.target) <= 1


def test_every_stretch_is_near_the_weights(spark):
    data = [(i, f"s{i % 3}", 1_000) for i in range(90)]
    _, mixed = M.mix(spark.createDataFrame(data, "doc_id long, source string, size long"), block=100)
    order = [s for _, s in sorted((p.slot, p.source) for p in mixed.collect())]
    for begin in range(0, len(order) - 160, 80):
        share = Counter(order[begin : begin + 160])
        assert abs(share["s0"] - 100) <= 6 and abs(share["s1"] - 40) <= 6 and abs(share["s2"] - 20) <= 6


def test_ranks_are_gapless(spark):
    slots = (70_000, 3, 131_000, 0, 1)
    data = [(k, n, sum(slots[: k + 1])) for k, n in enumerate(slots)]
    got = M._schedule(spark.createDataFrame(data, "k long, slots long, until long"))
    got = got.groupBy("k").agg({"rank": "max", "*": "count"}).collect()
    assert {r.k: (r["max(rank)"], r["count(1)"]) for r in got} == {
        0: (69_999, 70_000), 1: (2, 3), 2: (130_999, 131_000), 4: (0, 1)
    }


def test_documents_as_often_as_taken(spark):
    docs = documents(spark)
    got = Counter(r.doc_id for r in M.mixed_documents(docs).collect())
    taken, _ = M.mix(M.sized_rows(docs, "doc_id", "source", "text"))
    for r in taken.collect():
        assert got[r.doc_id] == (int(r.taken / r["size"] + 0.5) if r["size"] else 0)
