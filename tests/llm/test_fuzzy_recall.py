"""Recall of op4's links on edit similarity alone, over all pairs of lines; the prints have no say."""

import random
import zlib

import numpy as np

from logquarry.llm import fuzzy_lines as L
from tests.llm.cases import SMALL, documents, find, frame, join


def edits(a, b, most):
    """Edits, or more than ``most``."""
    codes, at = np.array([ord(c) for c in b]), np.arange(len(b) + 1)
    row = at
    for i, x in enumerate(a, 1):
        new = np.minimum(row[1:] + 1, row[:-1] + (codes != ord(x)))
        new = np.concatenate(([i], new))
        row = np.minimum.accumulate(new - at) + at
        if row.min() > most:
            break
    return int(row.min() if i < len(a) else row[-1])


def similar(norms):
    """All pairs at 0.8 or more. An edit changes four runs of four characters at most, which leaves few to try."""
    norms = sorted(norms, key=len)
    lengths = np.array([len(n) for n in norms])
    grams = np.zeros((len(norms), 4096), np.int16)
    for k, n in enumerate(norms):
        np.add.at(grams[k], [zlib.crc32(n[i : i + 4].encode()) % 4096 for i in range(len(n) - 3)], 1)
    for j in range(len(norms)):
        low = int(np.searchsorted(lengths, 0.8 * lengths[j] - 1e-9))
        most = int(0.2 * lengths[j] + 1e-9)
        gone = np.maximum(grams[j] - grams[low:j], 0).sum(axis=1)
        for i in low + np.flatnonzero(gone <= 4 * most):
            if edits(norms[i], norms[j], most) <= most:
                yield norms[i], norms[j]


def groups_of(spark, norms):
    """Line to the place of the first line of its group, from which lines go when each is a text."""
    docs = frame(spark, [(k, n, None, None, None) for k, n in enumerate(norms)])
    lines = L.stored(L.line_table(docs), "lines")
    distinct = lines.selectExpr("h", "length", "high", "low", "struct(text_hash) AS first").dropDuplicates(["h"])
    roots = {r.h: r.root for r in L.similar_lines(docs, lines, distinct, "doc_id", "text", L.SIMILARITY).collect()}
    return {norms[r.doc_id]: roots.get(r.h, r.h) for r in lines.collect()}


def recall(spark, norms):
    norms = sorted(set(norms))
    pairs, got = list(similar(norms)), groups_of(spark, norms)
    at = {n: k for k, n in enumerate(norms)}
    parent = list(range(len(norms)))
    for a, b in pairs:
        join(parent, at[a], at[b])
    # No group reaches beyond what brute force links.
    first = {}
    assert all(find(parent, at[n]) == find(parent, at[first.setdefault(root, n)]) for n, root in got.items())
    return len(pairs), sum(got[a] == got[b] for a, b in pairs)


def test_recall_on_documents(spark):
    norms = [n for r in documents(spark).collect() for n in L.normalised(r.text or "") if n]
    n, found = recall(spark, norms)
    print("documents", n, found)
    assert n > 40 and found >= 0.95 * n


def test_recall_with_changed_words(spark):
    """One word of ten to one of fifty; with whole-word prints of 3 bits 3 % to 50 % were candidates."""
    rng, norms = random.Random(2), []
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8)))
    for size in (10, 20, 50) * 40:
        base = [word() for _ in range(size)]
        other = list(base)
        other[rng.randrange(size)] = word()
        norms += [" ".join(base), " ".join(other)]
    n, found = recall(spark, norms)
    print("words", n, found)
    assert n > 100 and found >= 0.98 * n
