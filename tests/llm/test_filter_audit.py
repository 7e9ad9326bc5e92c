import random
import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from logquarry.llm import filter_audit as A
from tests.llm.cases import CLASHING, COLUMNS, MEDIUM, ROWS, SMALL, documents, frame

LABELS = "doc_id bigint, quality int, toxic int"


def brute(docs, labels):
    """Rows by applying the filters one after the other to the documents themselves."""
    first = {}
    for key, text, _ in docs:
        if key is not None:
            first[text or ""] = min(key, first.get(text or "", key))
    found = []
    for key, value, part in docs:
        text = value or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": key is not None and key > first[text],
        }
        said = [x for x in labels if x[0] == key and key is not None]
        found.append((part or "", {f for f in fails if fails[f]}, any(x[1] == 1 for x in said), any(x[2] == 1 for x in said)))
    out, total = {}, Counter()
    for part in {d[0] for d in found}:
        for order in permutations("ABCDE"):
            left = [d for d in found if d[0] == part]
            everything = left
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[1]]
                left = [d for d in left if x not in d[1]]
                total[part, x] += len(gone)
                out[part, "".join(order), step] = [
                    len(left),
                    len(gone),
                    sum(x in d[1] for d in everything) - len(gone),
                    sum(d[1] == {x} for d in everything),
                    sum(d[2] for d in gone),
                    sum(d[3] for d in gone),
                ]
    return {(*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


ORDER = [
    "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
]


def rows(df):
    found = [tuple(r) for r in df.select(*ORDER).collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_query(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in documents(spark).collect()]
    labels = [tuple(r) for r in spark.read.parquet(f"{SMALL}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    got = rows(A.op13_filter_diagrams(spark, SMALL))
    assert got == brute(docs, labels) and len(got) == 600 * len({d[2] for d in docs})


def test_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{MEDIUM}/{name}.parquet'")
    cursor = con.execute(A.OP13_SQL)
    want = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT"}
    got = A.op13_filter_diagrams(spark, MEDIUM)
    assert {d[0]: str(d[1]) for d in cursor.description} == {c: want[t] for c, t in got.dtypes}
    assert [d[0] for d in cursor.description] == ORDER
    assert rows(got) == set(cursor.fetchall())


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_rows(spark, clashing):
    """Nulls, empty and very long texts, repeated rows and ids, clashing columns."""
    labels = [(1, 1, 0), (6, 0, 1), (6, 1, None), (8, None, 1), (None, 1, 1), (99, 1, 1)]
    docs = frame(spark, clashing=clashing)
    said = spark.createDataFrame(labels, LABELS)
    if clashing:
        for name in [*CLASHING, "part", "mask", "digest", "first", "good"]:
            said = said.selectExpr("*", f"'kept' AS `{name}`")
            if name not in docs.columns:
                docs = docs.selectExpr("*", f"'kept' AS `{name}`")
    got = rows(A.audit(A.labelled(A.failure_masks(docs), said)))
    assert got == brute([(r[0], r[1], r[2]) for r in ROWS], labels)


def test_no_rows_and_only_nulls(spark):
    said = spark.createDataFrame([], LABELS)
    assert A.audit(A.labelled(A.failure_masks(frame(spark, [])), said)).collect() == []
    docs = spark.createDataFrame([(None,) * 5, (1, None, None, None, None), (2, "", None, None, None)], COLUMNS)
    got = rows(A.audit(A.labelled(A.failure_masks(docs), said)))
    assert got == brute([(None, None, None), (1, None, None), (2, "", None)], [])


def test_diagrams_of_any_masks():
    rng = random.Random(3)
    for levels in (1, 2, 3, 4, 6):
        for _ in range(20):
            counts = {m: (rng.randint(0, 3), rng.randint(0, 1), 0) for m in range(1 << levels) if rng.random() < 0.5}
            if not any(map(any, counts.values())):
                continue
            diagram, seen = A.Diagram(counts, levels), set()
            for level in [None, *A.plain_changes(levels)]:
                if level is not None:
                    diagram.swap(level)
                seen.add(tuple(diagram.order))
                assert all(diagram.reaching(m) == counts.get(m, (0, 0, 0)) for m in range(1 << levels))
                # Reduced: no two nodes of a level are equal, none of them is empty.
                for unique in diagram.unique:
                    assert len(set(unique.values())) == len(unique) and (0, 0) not in unique
                    assert all(diagram.edges[node] == edges for edges, node in unique.items())
                passed = 0
                for bit, kept, removed in diagram.steps():
                    earlier, passed = passed, passed | 1 << bit
                    assert kept == tuple(map(sum, zip((0, 0, 0), *[c for m, c in counts.items() if not m & passed])))
                    gone = [c for m, c in counts.items() if not m & earlier and m >> bit & 1]
                    assert removed == tuple(map(sum, zip((0, 0, 0), *gone)))
            assert len(seen) == len(list(permutations(range(levels))))


def test_shared_parts():
    same = {m: (1, 0, 0) for m in range(32)}
    # All masks alike: one node a level.
    assert [len(u) for u in A.Diagram(same, 5).unique] == [1] * 5


def test_any_partitions(spark):
    docs, said = frame(spark), spark.createDataFrame([(6, 1, 1)], LABELS)
    first, second = (rows(A.audit(A.labelled(A.failure_masks(docs.repartition(n)), said))) for n in (1, 7))
    assert first == second
