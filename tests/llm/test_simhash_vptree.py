import random
import re

import numpy as np
import xxhash

from logquarry.llm import simhash_vptree as S
from logquarry.llm.common import components
from tests.llm.cases import ROWS, SMALL, documents, find, frame, join


def brute_print(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """Index of row to index of the first row reachable."""
    parent = list(range(len(prints)))
    values = np.array(prints, np.uint64)
    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 4):
            join(parent, i, int(j))
    return [find(parent, i) for i in range(len(values))]


def test_query(spark):
    docs = {r.doc_id: r.text for r in documents(spark).collect()}
    ids = sorted(docs)
    prints = [brute_print(docs[d]) for d in ids]
    want = {d: (f"{p:016x}", ids[k]) for d, p, k in zip(ids, prints, brute_components(prints), strict=True)}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.op1_simhash_vptree(spark, SMALL).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)


def test_fingerprints():
    texts = [None, "", " \t", "a", "A b", "é É", "a b c d", "a b c d e a b c d e", "x y z\x0bq w\x1cv", "w " * 999]
    assert [S.simhash(t and t.encode()) & (1 << 64) - 1 for t in texts] == [brute_print(t) for t in texts]


def planted(seed, groups, size, noise):
    """Fingerprints in chains of small steps, and others at random."""
    rng = random.Random(seed)
    out = {rng.getrandbits(64) for _ in range(noise)}
    for _ in range(groups):
        value = rng.getrandbits(64)
        for _ in range(rng.randint(1, size)):
            for _ in range(rng.randint(0, 5)):
                value ^= 1 << rng.randrange(64)
            out.add(value)
    return sorted(out)


def test_trees_find_every_link(spark, monkeypatch):
    monkeypatch.setattr(S, "LEAF_ROWS", 20)
    for seed, task_rows in ((1, 16_000), (2, 60)):
        # Small tasks deal a shard out in pairs of blocks.
        monkeypatch.setattr(S, "TASK_ROWS", task_rows)
        prints = planted(seed, 150, 12, 1_500)
        signed = np.array(prints, np.uint64).view(np.int64).tolist()
        df = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(5)
        links = S.similar_fingerprints(df, len(prints))
        assert links.count() < 40 * len(prints)
        roots = {r.a: r.root for r in components(links).collect()}
        got = {}
        for k, p in enumerate(signed):
            got.setdefault(roots.get(p, p), []).append(k)
        want = {}
        for k, root in enumerate(brute_components(prints)):
            want.setdefault(root, []).append(k)
        assert sorted(got.values()) == sorted(want.values())


def test_a_dense_group_gives_a_star(spark, monkeypatch):
    """Thousands of fingerprints within reach of each other, in all pairs of blocks."""
    monkeypatch.setattr(S, "TASK_ROWS", 500)
    prints = [sum(1 << b for b in (i, j)) for i in range(64) for j in range(i)]
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = S.similar_fingerprints(df, len(prints))
    assert links.count() < 60 * len(prints)
    assert components(links).select("root").distinct().count() == 1


def test_rows_meet_in_a_shard():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1 << 21, 3_000, dtype=np.uint64)
    tree = S.fit_tree(values[:500], 6)
    row, shard, own = S.shards_of(values, tree, 6, 1)
    assert np.array_equal(np.sort(row[own]), np.arange(3_000))
    home = dict(zip(row[own], shard[own], strict=True))
    seen = set(zip(row.tolist(), shard.tolist(), strict=True))
    near = [(i, int(j)) for i in range(3_000) for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 1)]
    assert len(near) > 30
    assert all((i, home[j]) in seen or (j, home[i]) in seen for i, j in near)
    assert len(row) < 64 * 3_000 / 4


def test_components_of_long_chains(spark):
    rng = random.Random(5)
    names = rng.sample(range(10_000), 400)
    chains = [names[:1], names[1:3], names[3:200], names[200:]]
    edges = [(a, b) for c in chains for a, b in zip(c, c[1:], strict=False)]
    rng.shuffle(edges)
    df = spark.createDataFrame([*edges, (5, 5), *edges[:20]], "a long, b long")
    got = {r.a: r.root for r in components(df).collect()}
    assert got == {x: min(c) for c in chains for x in c if x != min(c)}


def test_one_of_each_group(spark):
    got = sorted(((r.doc_id, r.text) for r in S.one_of_each_group(frame(spark)).collect()), key=repr)
    by_print = {}
    for key, text, *_ in ROWS:
        by_print.setdefault(brute_print(text), []).append((key is None, key, text))
    prints = list(by_print)
    groups = {}
    for k, root in enumerate(brute_components(prints)):
        groups.setdefault(root, []).extend(by_print[prints[k]])
    assert len(got) == len(groups)
    # The smallest id of the group; of two texts with it, either.
    for group in groups.values():
        least = min((missing, key or 0) for missing, key, _ in group)
        assert any((key is None, key or 0) == least and (key, text) in got for _, key, text in group)
