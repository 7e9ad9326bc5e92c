"""Verdicts of op4 on long lines, and on many pairs at once."""

import random
import time

import numpy as np
import pytest

from logquarry.llm import edit_limits
from logquarry.llm import fuzzy_lines as L
from tests.llm.cases import frame
from tests.llm.test_fuzzy_lines import edits


def line_and_copies():
    """A line of 45,000 characters, one with a letter changed in a third of its words, one with those words replaced."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6))
    words = [word() for _ in range(6_500)]
    few = [w[:2] + "0" + w[3:] if k % 30 < 10 else w for k, w in enumerate(words)]
    many = [word() if k % 30 < 10 else w for k, w in enumerate(words)]
    return tuple(map(" ".join, (words, few, many)))


def test_long_lines_are_measured():
    line, few, many = line_and_copies()
    # Aligned words alone would tell them apart.
    assert L._aligned(line, few) > 0.2 * len(line)
    assert L.are_similar(line, few, 0.8) and L.are_similar(few, line, 0.8)
    assert not L.are_similar(line, many, 0.8)


def test_long_lines_are_linked(spark):
    line, few, many = line_and_copies()
    docs = frame(spark, [(k, t, None, None, None) for k, t in enumerate((line, few, many, "alone"))])
    assert {r.doc_id: r.dropped for r in L.repeated_lines(docs).collect()} == {0: [], 1: [0], 2: [], 3: []}


@pytest.mark.parametrize("strip", [1, 7, 2048])
def test_strips_by_rows(monkeypatch, strip):
    monkeypatch.setattr(L, "STRIP", strip)
    rng = random.Random(strip)
    for _ in range(300):
        x = rng.choices("abc é🎉", k=rng.randint(0, 40))
        y = [c for c in x if rng.random() > 0.15] + rng.choices("abc é🎉", k=rng.randint(0, 5))
        x, y = "".join(x), "".join(y[k:] + y[:k] if (k := rng.randint(0, 3)) else y)
        n = edits(x, y)
        for most in (0, 2, len(x) // 3, 100):
            got = L._edits(x, y, most)
            assert got == n if n <= most else got > most


def mixed(rng, letters, n):
    """Two texts of about n characters, anything from equal to unrelated."""
    x, p = rng.choices(letters, k=n), rng.choice([0, 0.05, 0.15, 0.2, 0.25, 0.5, 1])
    y = []
    for c in x:
        change = rng.randrange(3) if rng.random() < p else 3
        y += {0: [rng.choice(letters)], 1: [c, rng.choice(letters)], 2: [], 3: [c]}[change]
    k = rng.choice([0, 0, 0, rng.randint(0, len(y))])
    return "".join(x), "".join(y[k:] + y[:k])


@pytest.mark.parametrize(("steps", "words", "look"), [(1 << 13, 1 << 22, 32), (8, 1 << 22, 1), (64, 500, 5)])
def test_many_pairs_at_once(monkeypatch, steps, words, look):
    for name, value in (("STEP_WORDS", steps), ("TABLE_WORDS", words), ("LOOK", look)):
        monkeypatch.setattr(edit_limits, name, value)
    rng = random.Random(steps)
    sizes = [0, 1, 2, 5, 30, 63, 64, 65, 127, 128, 129, 200, 321]
    pairs = [mixed(rng, rng.choice(["ab", "abcde ", "abcdefghijklmnopqrstuvwxyzäé🎉 "]), rng.choice(sizes)) for _ in range(400)]
    xs, ys = zip(*pairs, strict=True)
    n = np.array([edits(x, y) for x, y in pairs])
    for share in (0, 0.05, 0.2, 0.6, 1):
        most = np.array([int(share * max(len(x), len(y)) + 1e-9) for x, y in pairs])
        assert (edit_limits.within(list(xs), list(ys), most) == (n <= most)).all()
    assert edit_limits.within(list(xs), list(ys), n).all()
    assert not edit_limits.within(list(xs), list(ys), n - 1).any()
    assert edit_limits.within([], [], np.zeros(0)).tolist() == []


def test_unlike_pairs_are_settled_together():
    """Pairs that share half their words were compared one by one, 1 ms each."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5))
    xs, ys = [], []
    for _ in range(1_500):
        words = [word() for _ in range(90)]
        xs.append(" ".join(words))
        ys.append(" ".join(w if k % 10 < 5 else word() for k, w in enumerate(words)))
    begin = time.process_time()
    alone = [L._edits(x, y, 107) <= 107 for x, y in zip(xs, ys, strict=True)]
    middle = time.process_time()
    assert L.verdicts(xs, ys, 0.8).tolist() == alone
    assert time.process_time() - middle < 0.5 * (middle - begin)


def test_pairs_of_other_characters_are_not_compared(monkeypatch):
    """Lines that share a passage but not the characters of the rest were compared all the same."""
    rng = random.Random(6)
    passage = "".join(rng.choices("abcdefgh ", k=300))
    own = ["".join(rng.choices(letters, k=300)) for letters in ("ijklmn ", "opqrst ", "éêçà🎉 ")]
    xs, ys = zip(*[(passage + own[i], passage + own[j]) for i in range(3) for j in range(3) if i != j], strict=True)
    monkeypatch.setattr(edit_limits, "_block", lambda *_: pytest.fail("compared"))
    assert not L.verdicts(list(xs), list(ys), 0.8).any()


@pytest.mark.parametrize("counted", [1, 3, 1 << 7])
def test_characters_never_count_too_much(monkeypatch, counted):
    monkeypatch.setattr(edit_limits, "COUNTED", counted)
    rng = random.Random(counted)
    # Of these, "!" and "a" are of one kind, as are "🎉" and "É".
    pairs = [mixed(rng, rng.choice(["ab", "a!É🎉\ud800", "abcde "]), rng.choice([0, 1, 2, 30, 65])) for _ in range(200)]
    least = edit_limits._least(*map(list, zip(*pairs, strict=True)))
    assert all(abs(len(x) - len(y)) <= k <= edits(x, y) for k, (x, y) in zip(least, pairs, strict=True))
    assert edit_limits._least(["aab", "", "xy"], ["abb", "abc", "yx"]).tolist() == [1, 3, 0]
