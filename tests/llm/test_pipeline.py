"""The pipeline against plain loops over the documents."""

import re
from collections import Counter

import __spark_entry__ as contract
import corpus_pipeline
from logquarry.llm import kneser_ney, queries
from tests.llm.cases import SMALL, documents
from tests.llm.test_mixing import targets
from tests.llm.test_simhash_vptree import brute_components, brute_print
from tests.llm.test_wu_manber import brute


def test_registered():
    numbers = [int(n[2:].split("_")[0]) for n in queries.QUERIES]
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    assert {*queries.QUERIES, "pipeline"} <= set(contract.queries())
    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.ORACLE_SQL is None
    assert len(corpus_pipeline.STAGES) == 5


def expected(spark):
    """Rows by stage: languages by the same models, everything else by loops."""
    docs = {r.doc_id: r for r in documents(spark).collect()}
    models = kneser_ney.train(documents(spark))
    docs = {k: r for k, r in docs.items() if not models.judge(r.text)[2]}
    yield set(docs)
    ids = sorted(docs)
    roots = brute_components([brute_print(docs[k].text) for k in ids])
    docs = {k: docs[k] for n, k in enumerate(ids) if roots[n] == n}
    yield set(docs)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = {k: r for k, r in docs.items() if not brute(r.text, items)[1]}
    yield set(docs)
    sizes = Counter()
    for r in docs.values():
        sizes[r.source] += len(words_of(r.text))
    yield docs, sizes


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text)


def test_stages(spark):
    found, docs = [], documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, SMALL), f"test-{name}")
        found.append(docs)
    languages, distinct, clean, (kept, sizes) = expected(spark)
    for got, want in zip(found, (languages, distinct, clean), strict=False):
        assert Counter(r.doc_id for r in got.collect()) == Counter(want)
    mixed = found[3].collect()
    names = sorted(sizes)
    goal = dict(zip(names, targets([sizes[n] for n in names], [(5, 2, 1)[k % 3] for k in range(len(names))]), strict=True))
    taken, longest = Counter(), Counter()
    for r in mixed:
        assert (r.text, r.lang) == (kept[r.doc_id].text, kept[r.doc_id].lang)
        taken[r.source] += len(words_of(r.text))
    for r in kept.values():
        longest[r.source] = max(longest[r.source], len(words_of(r.text)))
    # Whole documents: off by half of one at most.
    assert all(abs(taken[n] - goal[n]) <= longest[n] / 2 + 1 for n in names)
    last = found[4].collect()
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in mixed)
    per_shard = Counter(r.shard for r in last)
    assert set(per_shard) == set(range(16)) and max(per_shard.values()) - min(per_shard.values()) <= 1
    assert len({(r.shard, r.slot) for r in last}) == len(last)


def test_run_and_flags(spark):
    whole = corpus_pipeline.run(spark, SMALL)
    assert whole.columns == [*documents(spark).columns, "shard", "slot"]
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert sorted(tuple(r) for r in whole.collect()) == sorted(tuple(r) for r in docs.collect())
