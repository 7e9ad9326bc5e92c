import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from logquarry.llm import token_counts as T
from logquarry.session import scratch_folder
from tests.llm.cases import MEDIUM, ROWS, documents, frame, rows

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = Tokenizer.from_file(PATH)


def library(texts):
    return [len(e.ids) for e in PLAIN.encode_batch(list(texts), add_special_tokens=False)]


def test_query(spark):
    texts = {r.doc_id: r.text for r in documents(spark, MEDIUM).collect()}
    want = dict(zip(texts, library(texts.values()), strict=True))
    got = T.op6_digest_cache(spark, MEDIUM).collect()
    assert {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got} == {
        d: (len(t.encode()), want[d], want[d] > 1024) for d, t in texts.items()
    }


with open(PATH, "rb") as _file:
    PIECES = T.counter(_file.read(), ".json")
PARTS = st.sampled_from(
    [" ", "  ", "\n", "\n\n", " \n", "\t", "\r\n", "\xa0", " ", "　", "a", "don't", "it's", "'", "S", "é", "É",
     "ñandú", "ǆ", "×", "÷", "ß", "ɏ", "ɐ", "中文", "🎉", "é", "1", "²", "½", "...", "!?", "<|endoftext|>", "<|", "|>", "\x00", "\x7f", "\x85"]
)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.one_of(PARTS, st.text(max_size=4)), max_size=25).map("".join))
def test_pieces_count_as_the_library_does(text):
    assert isinstance(PIECES, T._Pieces)
    text = text.encode("utf-8", "ignore").decode()
    assert PIECES.count([text]) == library([text])


def test_memory_of_pieces_is_bounded(monkeypatch):
    monkeypatch.setattr(T, "MEMO_PIECES", 10)
    texts = ["some words of a text " * 3, "other " * 5 + "things", ""]
    for _ in range(3):
        assert PIECES.count(texts) == library(texts)
    assert len(PIECES.memo) <= 10


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers(spark, name):
    docs = frame(spark, [r for r in ROWS if r[4] != 200_000])
    cache = scratch_folder(spark, "cache")
    got = {(r.doc_id, r.n_bytes): r.n_tokens for r in T.count_tokens(docs, public_tokenizers.path(name), cache).collect()}
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        count = lambda t: len(model.encode(t, num_threads=1))
    else:
        model = Tokenizer.from_file(public_tokenizers.path(name))
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    assert got == {(r[0], len((r[1] or "").encode())): count(r[1] or "") for r in ROWS if r[4] != 200_000}


def test_only_misses_are_encoded(spark):
    cache = scratch_folder(spark, "cache")
    first = rows(T.count_tokens(frame(spark, ROWS[:7]), PATH, cache))
    kept = spark.read.parquet(cache)
    assert kept.count() == len({r[1] or "" for r in ROWS[:7]})
    # What the cache says is believed; new texts are added to it.
    kept.selectExpr("tokenizer", "digest", "n_tokens + 1000 AS n_tokens").write.mode("append").parquet(cache)
    again = rows(T.count_tokens(frame(spark, ROWS), PATH, cache))
    assert [r for r in again if r[0] in {x[0] for x in first}] == [(a, b, c + 1000) for a, b, c in first]
    assert spark.read.parquet(cache).select("digest").distinct().count() == len({r[1] or "" for r in ROWS})


def test_another_tokenizer_has_its_own_counts(spark):
    cache = scratch_folder(spark, "cache")
    T.count_tokens(frame(spark), PATH, cache).collect()
    T.count_tokens(frame(spark), public_tokenizers.path("word_bpe_49k.json"), cache).collect()
    assert spark.read.parquet(cache).groupBy("tokenizer").count().count() == 2
