import math
import zlib

import numpy as np
import pytest

from logquarry.llm import kneser_ney as K
from tests.llm.cases import MEDIUM, ROWS, documents, frame


@pytest.fixture(scope="module")
def models(spark):
    return K.train(documents(spark, MEDIUM))


def test_query(spark):
    docs = {r.doc_id: r for r in documents(spark, MEDIUM).collect()}
    got = K.op9_kneser_ney(spark, MEDIUM).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert len(held) > 150
    assert sum(r.lang_pred == docs[r.doc_id].lang for r in held) >= 0.98 * len(held)
    assert not any(r.rejected for r in got)


def test_nothing_is_learned_from_held_out_rows(spark, models):
    docs = documents(spark, MEDIUM)
    hidden = docs.selectExpr(
        "doc_id", "IF(crc32(string(doc_id)) % 5 = 0, 'zzz', text) AS text", "IF(crc32(string(doc_id)) % 5 = 0, 'xx', lang) AS lang"
    )
    again = K.train(hidden)
    assert again.langs == models.langs == ["de", "en", "es", "fr"]
    for order in range(1, K.ORDER + 1):
        assert np.array_equal(again.keys[order], models.keys[order])
        assert np.array_equal(again.logs[order], models.logs[order])
    assert again.scale == models.scale


def counts_of(text):
    return np.unique(K.grams_of(K.symbols_of(text)), return_counts=True)


def test_probabilities_sum_to_one():
    models = K.fit(["x", "y"], [counts_of("abracadabra abba cab"), counts_of("the cat sat on that mat")])
    symbols = np.unique(np.concatenate([models.keys[1]]))
    unknown = np.array([0x3000 + k for k in range(1)], np.uint64)
    for context in ("abr", "the", "zzz", " a", "ab"):
        packed = K.grams_of(np.array([ord(c) for c in context.rjust(3)], np.uint16), 3)[-1]
        last = np.concatenate((symbols, unknown))
        grams = (np.uint64(packed) << np.uint64(16)) | last
        total = np.exp(models.log_p(grams, 4).astype(float)).sum(axis=0)
        assert np.allclose(total, 1, atol=1e-4), (context, total)


def brute_p(order, context, symbol, texts, vocabulary):
    """Interpolated Kneser-Ney by its definition, on lists of n-grams."""
    if order == 0:
        return 1 / vocabulary
    padded = " " * (K.ORDER - 1) + texts
    kinds = [padded[k : k + K.ORDER] for k in range(len(texts))]
    for _ in range(K.ORDER - order):
        kinds = [g[1:] for g in set(kinds)]
    n = {g: kinds.count(g) for g in set(kinds)}
    once, twice = sum(c == 1 for c in n.values()), sum(c == 2 for c in n.values())
    d = once / (once + 2 * twice) if once and twice else 0.5
    followers = {g: c for g, c in n.items() if g[:-1] == context}
    lower = brute_p(order - 1, context[1:], symbol, texts, vocabulary)
    if not followers:
        return lower
    total = sum(followers.values())
    return max(n.get(context + symbol, 0) - d, 0) / total + d * len(followers) / total * lower


def test_same_as_the_definition():
    text = "abracadabra abba cab a"
    models = K.fit(["x"], [counts_of(text)])
    for gram in ("abra", "   a", "cadz", "zzzz", "bba ", "ab b"):
        grams = K.grams_of(np.array([ord(c) for c in gram], np.uint16), 4)[-1:]
        want = brute_p(4, gram[:3], gram[3], text, models.vocabulary)
        assert math.isclose(math.exp(models.log_p(grams, 4)[0, 0]), want, rel_tol=1e-4), gram


def test_undecided(spark, models):
    texts = [None, "", " ", "123 %%% 456", "🎉🎉", "١٢٣"]
    for text in texts:
        assert models.judge(text) == ("und", 0.0, True)
    assert models.judge("x")[0] in models.langs
    assert models.judge("это совсем другой язык, которого модели не знают " * 5)[2]


def test_nothing_to_learn_from(spark):
    for data in ([], [(5, "some text", None, None, None)]):
        docs = frame(spark, data)
        found = K.identify(frame(spark), K.train(docs)).collect()
        assert {(r.lang_pred, r.score, r.rejected) for r in found} == {("und", 0.0, True)}


def test_long_texts_are_scored_whole(models, monkeypatch):
    text = "Die und der einer ist von " * 3_000 + "the and that with " * 4_000
    whole = models.entropies(K.symbols_of(text))
    monkeypatch.setattr(K, "_CHUNK", 777)
    assert np.allclose(models.entropies(K.symbols_of(text)), whole)


def test_rejected_rows_go(spark):
    kept = K.keep_identified(documents(spark, MEDIUM).unionByName(frame(spark, [(-1, "123", "en", "s", 3), (-2, None, "en", "s", 3)])))
    assert sorted(r.doc_id for r in kept.collect()) == list(range(1_000))


def test_symbols():
    assert K.symbols_of("Ab,  c1D!").tolist() == [ord(c) for c in "ab c d "]
    assert K.symbols_of("ÉÀ").tolist() == [ord("é"), ord("à")]
    assert len(K.symbols_of(ROWS[7][1])) > 0
