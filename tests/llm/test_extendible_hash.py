import hashlib
import re

import duckdb
import pytest

from logquarry.llm import extendible_hash as E
from tests.llm.cases import MEDIUM, ROWS, frame, rows


def test_query(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{MEDIUM}/documents.parquet'")
    got = E.op2_extendible_hash(spark, MEDIUM)
    assert rows(got) == sorted(con.execute(E.OP2_SQL).fetchall(), key=repr)


@pytest.mark.parametrize("hash_bits,bucket_rows", [(64, 50_000), (64, 2), (3, 2), (1, 1)])
def test_collisions_are_chained(spark, hash_bits, bucket_rows):
    """With a hash of few bits most texts collide; results stay."""
    found = E.exact_duplicates(frame(spark), bucket_rows=bucket_rows, hash_bits=hash_bits)
    norm = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = {}
    for key, text, *_ in ROWS:
        groups.setdefault(norm(text), []).append(key)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in sorted(ids, key=repr):
            now = i == keep and not kept
            kept |= now
            want.append((i, keep, len(ids), now, hashlib.sha256(text.encode()).hexdigest()))
    assert rows(found) == sorted(want, key=repr)


def test_directory_doubles_until_buckets_fit(spark):
    keys = spark.range(1000).selectExpr("IF(id < 600, id * 8, id) AS h")
    found = E.directory(keys, bucket_rows=100, max_depth=8).collect()
    assert all(r.entries <= 100 or r.depth == 8 for r in found)
    sizes = {}
    for (h,) in keys.collect():
        sizes.setdefault(h % 256, 0)
        sizes[h % 256] += 1
    assert {r.address for r in found} == set(sizes)
    for r in found:
        count = lambda d: sum(n for a, n in sizes.items() if a % 2**d == r.address % 2**d)  # noqa: E731, B023
        assert r.bucket == r.address % 2**r.depth
        assert r.entries == count(r.depth)
        assert r.depth == 0 or count(r.depth - 1) > 100


def test_index_has_a_chain_per_hash(spark):
    entries = spark.range(400).selectExpr("id AS doc_id", "id % 7 AS h", "cast(id % 100 AS string) AS sha")
    index = E.build_index(entries, bucket_rows=10, max_depth=4).collect()
    assert len(index) == 400 // 4 * 4 or len(index) == len({(i % 7, i % 100) for i in range(400)})
    chains = {}
    for r in index:
        chains.setdefault(r.h, []).append(r.chain)
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in chains.values())


def test_main_path_is_native(spark):
    text = E.op2_extendible_hash(spark, MEDIUM)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)
