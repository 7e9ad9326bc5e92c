import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from logquarry.llm import hidden_markov as M
from tests.llm.cases import CLASHING, COLUMNS, MEDIUM, ROWS, SMALL, documents, frame



def left_out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2


def held(key):
    return key is not None and zlib.crc32(str(key).encode()) % 7 == 2


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def tokens(text):
    out, word = [], ""
    for c in lower(text) + " ":
        if c in " \t\n\x0b\x0c\r":
            out += [word] if word else []
            word = ""
        else:
            word += c
    return [*out, None]


def base_rows(data):
    """(doc_id, held_out, n_tokens, n_known, N, base_score) by the formula."""
    counts = Counter(t for key, text in data if not held(key) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for key, text in data:
        found = tokens(text)
        base = math.fsum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in found)
        out.append((key, held(key), len(found), sum(counts[t] > 0 for t in found), total, base))
    return out


def compare(got, data):
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "boolean", *["bigint"] * 3, *["double"] * 2]
    order = lambda r: (repr(r[0]), r[2], r[5])
    found, want = sorted(map(tuple, got.collect()), key=order), sorted(base_rows(data), key=order)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert all(r[5] == pytest.approx(w[5], rel=1e-9, abs=1e-9) for r, w in zip(found, want, strict=True))
    assert all(math.isfinite(r[6]) and r[6] <= 1e-9 for r in found)
    return found


@pytest.fixture(scope="module")
def scored(spark):
    return M.op12_baum_welch(spark, MEDIUM).cache()


def test_query(spark, scored):
    rows = compare(scored, [(r.doc_id, r.text) for r in documents(spark, MEDIUM).collect()])
    unseen = [r for r in rows if r[1]]
    # Better than add-one counts, on texts that it has not learned from, by 0.3 a token and nearly everywhere.
    assert sum(r[6] - r[5] for r in unseen) > 0.3 * sum(r[2] for r in unseen)
    assert sum(r[6] > r[5] for r in unseen) > 0.9 * len(unseen)


def plain_score(text, known, model, counts):
    """By loops over words and states, from the counts of all words."""
    state, total = list(model.start), 0.0
    for k, token in enumerate(tokens(text)):
        key, share = None if token is None else M.word_key(token.encode()), 1.0
        if key is None:
            symbol = 0
        elif key in known.words[: known.own]:
            symbol = 1 + known.words.index(key)
        else:
            group = zlib.crc32(key[-3:]) % M.SHARED
            symbol = 1 + known.own + group
            rest = [c for w, c in counts.items() if w not in known.words[: known.own] and zlib.crc32(w[-3:]) % M.SHARED == group]
            share = (counts.get(key, 0) + 1) / (sum(rest) + len(rest) + 1)
        if k:
            state = [sum(a * model.step[i][j] for i, a in enumerate(state)) for j in range(len(state))]
        state = [a * model.emit[j][symbol] * share for j, a in enumerate(state)]
        total += math.log10(sum(state))
        state = [a / sum(state) for a in state]
    return total


@pytest.mark.parametrize("own,most", [(16_384, 1 << 18), (20, 60), (0, 0), (5, 5)])
def test_scores_by_loops(spark, own, most):
    """Whichever words have symbols of their own, or counts that tasks know."""
    data = [*[(r[0], r[1]) for r in ROWS if len(r[1] or "") < 300], (20, "abc " * 30 + "z" * 70 + " Zzz " + "z" * 70)]
    docs = frame(spark, [(k, t, None, None, None) for k, t in data]).coalesce(1)
    got = M.language_model_scores(docs, left_out(), states=3, portions=2, own_words=own, known_words=most)
    found = compare(got, data)
    counts = {bytes(r.word): r.n for r in M.word_counts(docs.filter(~F.coalesce(left_out(), F.lit(False))).select("text")).collect()}
    table = M.stored(M.word_counts(docs.filter(~F.coalesce(left_out(), F.lit(False))).select("text")), "words")
    known = M.vocabulary(table, sum(not held(k) for k, _ in data), own, most)
    assert len(known.words) <= most and known.own <= own
    assert known.plain().sum() == pytest.approx(1)
    portion = F.when(~F.coalesce(left_out(), F.lit(False)), F.pmod(F.xxhash64("doc_id", "text"), F.lit(2)).cast("int")).otherwise(-1)
    read = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.lit(False).alias("held_out"), portion.alias("portion"), "text")
    model = M.train(M.by_portion(M.encode(read, known)), known, 3, 2)
    for part, axis in ((model.emit, 1), (model.step, 1), (model.start, 0), (model.any, 0)):
        assert np.allclose(part.sum(axis=axis), 1) and (part > 0).all()
    want = sorted((repr(k), len(tokens(t)), plain_score(t, known, model, counts)) for k, t in data)
    assert [(repr(r[0]), r[2]) for r in found] == [w[:2] for w in want]
    assert sorted(round(r[6], 6) for r in found) == sorted(round(w[2], 6) for w in want)


def small_model(rng, states, symbols):
    share = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return M.Model(
        share(rng.random(states), 0), share(rng.random((states, states)), 1), share(rng.random((states, symbols)), 1), share(rng.random(states), 0)
    )


def test_expected_counts_by_all_paths():
    rng = np.random.default_rng(4)
    model, sizes = small_model(rng, 3, 4), np.array([5, 3, 3, 1])
    tokens_ = rng.integers(0, 4, sizes.sum())
    starts, whole = np.cumsum(sizes) - sizes, np.array([True, False, True, True])
    first, steps, emitted, likelihood = M.expected_counts(tokens_, starts, sizes, whole, model)
    first_, steps_, emitted_, likelihood_ = np.zeros(3), np.zeros((3, 3)), np.zeros((3, 4)), 0.0
    for begin, size, full in zip(starts, sizes, whole, strict=True):
        seen, paths = tokens_[begin : begin + size], {}
        for path in product(range(3), repeat=int(size)):
            p = (model.start if full else model.any)[path[0]]
            for k, z in enumerate(path):
                p *= model.emit[z, seen[k]] * (model.step[path[k - 1], z] if k else 1)
            paths[path] = p
        total = sum(paths.values())
        likelihood_ += math.log(total)
        for path, p in paths.items():
            first_[path[0]] += p / total * full
            for k, z in enumerate(path):
                emitted_[z, seen[k]] += p / total
                if k:
                    steps_[path[k - 1], z] += p / total
    for a, b in ((first, first_), (steps, steps_), (emitted, emitted_)):
        assert np.allclose(a, b)
    assert likelihood == pytest.approx(likelihood_)


def test_rounds_raise_the_likelihood():
    rng = np.random.default_rng(8)
    model, sizes = small_model(rng, 4, 9), np.sort(rng.integers(1, 40, 50))[::-1]
    tokens_ = rng.integers(0, 9, sizes.sum())
    before = -np.inf
    for _ in range(8):
        first, steps, emitted, likelihood = M.expected_counts(tokens_, np.cumsum(sizes) - sizes, sizes, np.ones(50, bool), model)
        assert likelihood >= before
        before = likelihood
        model = M.Model(first / first.sum(), steps / steps.sum(axis=1, keepdims=True), emitted / emitted.sum(axis=1, keepdims=True), model.any)


@pytest.mark.parametrize("piece", [1, 2, 7, 50, 1 << 15])
def test_likelihoods_of_long_texts_are_exact(piece):
    rng = np.random.default_rng(6)
    model, sizes = small_model(rng, 4, 6), np.array([1, 180, 3, 50, 51, 7])
    tokens_ = rng.integers(0, 6, sizes.sum()).astype(np.uint16)
    want, at = [], 0
    for size in sizes:
        state, total = model.start, 0.0
        for k in range(size):
            state = (state @ model.step if k else state) * model.emit[:, tokens_[at + k]]
            total += math.log10(state.sum())
            state = state / state.sum()
        want.append(total)
        at += size
    assert np.allclose(M.likelihoods(tokens_, sizes, model, piece), want, rtol=1e-12)


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_rows(spark, clashing):
    """Nulls, empty and very long texts, repeated rows and ids, clashing columns."""
    docs = frame(spark, clashing=clashing)
    for name in ["portion", "held_out", "rare", "word"] if clashing else []:
        if name not in CLASHING:
            docs = docs.selectExpr("*", f"'kept' AS `{name}`")
    compare(M.language_model_scores(docs, left_out(), states=4, portions=3), [r[:2] for r in ROWS])


@pytest.mark.parametrize("data", [[], [(None, None)], [(1, None), (2, "")], [(k, "a b") for k in range(9) if held(k)]])
def test_little_to_learn_from(spark, data):
    docs = spark.createDataFrame([(k, t, None, None, None) for k, t in data], COLUMNS)
    compare(M.language_model_scores(docs, left_out(), portions=2), data)


def test_reruns_agree(spark):
    docs = documents(spark, SMALL)
    first, second = (sorted(map(tuple, M.language_model_scores(docs, left_out(), portions=3).collect())) for _ in range(2))
    assert first == second
