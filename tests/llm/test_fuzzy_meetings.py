"""op4's second round: lines that share a passage and little else, of which there are many to a key."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from logquarry.llm import edit_limits
from logquarry.llm import fuzzy_lines as L
from tests.llm.cases import frame
from tests.llm.test_fuzzy_long import edits, mixed
from tests.llm.test_fuzzy_recall import edits as edits_up_to
from tests.llm.test_fuzzy_recall import groups_of

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def sharing(rng, n, own=20, passage=30):
    """Lines with a passage in common, each between words of its own."""
    word = lambda: "".join(rng.choices(LETTERS, k=5))
    common = [word() for _ in range(passage)]
    lines = []
    for _ in range(n):
        k = rng.randint(0, own)
        lines.append(" ".join([*[word() for _ in range(k)], *common, *[word() for _ in range(own - k)]]))
    return lines


def changed(rng, line, words):
    parts = line.split(" ")
    for k in rng.sample(range(len(parts)), words):
        parts[k] = "".join(rng.choices(LETTERS, k=5))
    return " ".join(parts)


def test_no_table_has_a_row_for_each_pair(spark, monkeypatch):
    """All pairs of a key that were near in print were written, joined with both texts and compared."""
    rng = random.Random(3)
    lines = sharing(rng, 250)
    lines += [changed(rng, line, 2) for line in lines[:20]]
    written, store = [], L.stored
    monkeypatch.setattr(L, "stored", lambda df, label: written.append((label, (out := store(df, label)).count())) or out)
    groups = groups_of(spark, lines)
    assert all(groups[lines[k]] == groups[lines[250 + k]] for k in range(20))
    assert len(set(groups.values())) == 250
    # 250 * 249 / 2 pairs are 31,125; a line has about a dozen keys.
    assert max(n for _, n in written) < 30 * len(lines), written


def rows(lines, keys, blocks):
    """The rows of ``L._compared`` as a task gets them; ``keys`` by line, ``blocks`` by key."""
    prints, _ = L.sketches(lines)
    out = []
    for n, line in enumerate(lines):
        high, low = prints[n].view(np.int64).tolist()
        for key in keys[n]:
            for other in range(blocks[key]):
                own = n % blocks[key]
                i, j = min(own, other), max(own, other)
                out.append((key, i, j, own, n, n // 2 if n < 10 else n, len(line), high, low, sorted(keys[n]), line))
    out.sort(key=lambda r: r[:3])
    names = ["key", "i", "j", "own", "h", "root", "length", "high", "low", "keys", "norm"]
    kinds = [pa.int64(), *[pa.int32()] * 3, pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.string()]
    return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)


@pytest.mark.parametrize(("blocks", "portion"), [(1, 1 << 20), (3, 1 << 20), (4, 7), (1, 1)])
def test_groups_of_blocks_find_every_similar_pair_once(monkeypatch, blocks, portion):
    monkeypatch.setattr(L, "GATHERED_PAIRS", portion)
    monkeypatch.setattr(edit_limits, "FEW_LANES", 0)
    rng = random.Random(blocks)
    lines = sharing(rng, 25, own=10, passage=15)
    lines += [changed(rng, rng.choice(lines), rng.randint(1, 7)) for _ in range(35)]
    lines += ["".join(rng.choices("ab ", k=rng.randint(3, 9))).strip() or "a" for _ in range(10)]
    keys = [{7, *rng.sample([5, 11, 13], rng.randint(0, 3))} - ({7} if n % 9 == 0 else set()) or {5} for n in range(len(lines))]
    table = rows(lines, keys, {5: 1, 7: blocks, 11: 2, 13: 1})
    prints, _ = L.sketches(lines)
    root = [n // 2 if n < 10 else n for n in range(len(lines))]
    want = []
    for x, y in combinations(range(len(lines)), 2):
        bits = int(np.bitwise_count(prints[x] ^ prints[y]).sum())
        short, long = sorted((len(lines[x]), len(lines[y])))
        near = short >= 0.8 * long - 1e-9 and (bits < L.MOST_BITS or long <= 4 * L.FEW_CHARS)
        most = int(0.2 * long + 1e-9)
        if keys[x] & keys[y] and root[x] != root[y] and near and edits_up_to(lines[x], lines[y], most) <= most:
            want.append(tuple(sorted((root[x], root[y]))))
    found = L._links(table, 0.8)
    got = sorted(tuple(sorted(p)) for p in zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True))
    assert got == sorted(want) and len(want) > 10


@pytest.mark.parametrize("windowed", [1 << 11, 100])
def test_windows_never_rule_out_too_much(monkeypatch, windowed):
    for name, value in (("FEW_LANES", 0), ("LANES", 16), ("WEIGHED", 3), ("WINDOWED", windowed)):
        monkeypatch.setattr(edit_limits, name, value)
    rng = random.Random(windowed)
    sizes = [0, 1, 30, 63, 64, 65, 127, 128, 129, 200, 321]
    letters = ["ab", "abcde ", "abcdefghijklmnopqrstuvwxyzäé🎉 ", "".join(map(chr, range(200, 400)))]
    pairs = [mixed(rng, rng.choice(letters), rng.choice(sizes)) for _ in range(300)]
    texts = [t for pair in pairs for t in pair]
    a = np.arange(len(pairs)) * 2
    n = np.array([edits(x, y) for x, y in pairs])
    some = edit_limits.Texts(texts)
    assert some.left(a, a + 1, n).tolist() == list(range(len(pairs)))
    assert some.left(a + 1, a, n).tolist() == list(range(len(pairs)))
    most = np.array([int(0.2 * max(len(x), len(y)) + 1e-9) for x, y in pairs])
    assert set(np.flatnonzero(n <= most)) <= set(some.left(a, a + 1, most).tolist())
    assert edit_limits.Texts([]).left(a[:0], a[:0], n[:0]).tolist() == []


def test_windows_rule_out_lines_that_share_a_passage():
    """Characters alone ruled out few of them."""
    lines = sharing(random.Random(5), 60, own=35)
    a, b = np.array(list(combinations(range(len(lines)), 2))).T
    most = np.full(len(a), int(0.2 * len(lines[0])))
    some = edit_limits.Texts(lines)
    assert some._by_counts(a, b, most).mean() > 0.9
    assert len(some.left(a, b, most)) < 0.1 * len(a)


def test_places_are_looked_up_with_or_without_position(spark):
    docs = frame(spark, [(1, "Ab  c\n\nsecond; LINE\nthird ΑΣ.\n🎉", None, None, None), (2, None, None, None, None), (3, "other", None, None, None)])
    lines = L.line_table(docs).filter("length > 0")
    want = {n for n in ["ab c", "second line", "third ας", "🎉", "other"]}
    for columns in (["h", "text_hash", "pos"], ["h", "text_hash"]):
        found = {r.h: r.norm for r in L._texts(docs, lines.select(columns), "doc_id", "text").collect()}
        assert set(found.values()) == want and all(L.line_hash(n) == h for h, n in found.items())
    one = lines.filter("doc_id = 1 and pos = 2").select("h", "text_hash", "pos")
    assert [r.norm for r in L._texts(docs, one, "doc_id", "text").collect()] == ["second line"]
