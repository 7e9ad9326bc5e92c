"""Lines with digits or without letters, in op4."""

from logquarry.llm import fuzzy_lines as L
from tests.llm.cases import frame


def dropped(spark, texts):
    docs = frame(spark, [(k, t, None, None, None) for k, t in texts.items()])
    return {r.doc_id: r.dropped for r in L.repeated_lines(docs).collect()}


def test_numbers_tell_lines_apart(spark):
    got = dropped(spark, {1: "total 17\nx = 4\n2024", 2: "Total 98230114\nx = 907531\n1999", 3: "total: 17"})
    assert got == {1: [], 2: [], 3: [0]}


def test_repeats_without_letters_go(spark):
    got = dropped(spark, {1: "12 34\n-----\n\n  ", 2: "12,34\n -----\n\n=====", 3: " \n=====\n12 34"})
    assert got == {1: [], 2: [0, 1], 3: [1, 2]}
