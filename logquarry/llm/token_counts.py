"""Token counts through a cache of digests.

The cache is a table of (tokenizer digest, content digest, count). Rows are joined to it by
narrow digests; only texts whose digest is missing are gathered, one of each, encoded, and
their counts appended.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from importlib.metadata import version
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import attach, stored, table
from logquarry.session import scratch_folder

TOKEN_LIMIT = 1_024
#: Texts are picked for encoding by so many bits of their digest, a broadcast of that many rows.
PICK_BITS = 16
#: Pieces of text whose counts a worker remembers.
MEMO_PIECES = 400_000
#: Between two of these (visible ASCII, Latin letters with accents) a single blank always
#: begins a new token of a byte-level vocabulary, and a single line end is one of its own.
_SEEN = "[!-~À-ÖØ-öø-ɏ]"
_LINE_END = re.compile(f"(?<={_SEEN})\n(?={_SEEN})")
_BLANK = re.compile(f"(?<={_SEEN}) (?={_SEEN})")


class _Pieces:
    """Counts for byte-level vocabularies, which never join what those blanks keep apart."""

    def __init__(self, tokenizer, added: list[str]):
        self.tokenizer, self.added = tokenizer, added
        self.memo: dict[str, int] = {}

    def count(self, texts: list[str]) -> list[int]:
        memo, whole, parts, fresh = self.memo, {}, [], set()
        for k, text in enumerate(texts):
            if any(a in text for a in self.added):
                whole[k] = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
                parts.append([])
                continue
            pieces = []
            for line in _LINE_END.split(text):
                first, *rest = _BLANK.split(line)
                pieces += ["\n", first, *(" " + p for p in rest)]
            parts.append(pieces[1:])
            fresh.update(p for p in pieces[1:] if p not in memo)
        new = sorted(fresh)
        encoded = self.tokenizer.encode_batch(new, add_special_tokens=False)
        memo.update(zip(new, (len(e.ids) for e in encoded), strict=True))
        out = [whole.get(k, 0) + sum(map(memo.__getitem__, p)) for k, p in enumerate(parts)]
        if len(memo) > MEMO_PIECES:
            memo.clear()
        return out


class _Tokenizers:
    def __init__(self, tokenizer):
        self.tokenizer = tokenizer

    def count(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]


class _SentencePiece:
    def __init__(self, processor):
        self.processor = processor

    def count(self, texts: list[str]) -> list[int]:
        return [len(ids) for ids in self.processor.encode(texts, num_threads=1)]


def _splits_at_blanks(settings: dict) -> bool:
    """Whether nothing but a plain byte-level split comes before the merges."""
    pre = settings.get("pre_tokenizer") or {}
    return (
        settings.get("normalizer") is None
        and pre.get("type") == "ByteLevel"
        and pre.get("use_regex", True)
        and not pre.get("add_prefix_space")
        and not any(t.get("lstrip") or t.get("rstrip") for t in settings.get("added_tokens", []))
    )


@lru_cache(maxsize=1)
def counter(content: bytes, kind: str):
    """A counter for a tokenizer file, ``.json`` or ``.model``, by its library."""
    if kind == ".model":
        import sentencepiece

        return _SentencePiece(sentencepiece.SentencePieceProcessor(model_proto=content))
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_buffer(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    settings = json.loads(content)
    if not _splits_at_blanks(settings):
        return _Tokenizers(tokenizer)
    return _Pieces(tokenizer, [t["content"] for t in settings.get("added_tokens", [])])


def tokenizer_digest(content: bytes, kind: str) -> str:
    library = version("sentencepiece" if kind == ".model" else "tokenizers")
    return hashlib.sha256(content + f"{kind} {library}".encode()).hexdigest()


_CACHE = "tokenizer string, digest string, n_tokens long"


def _cached(spark, cache: str, tokenizer: str) -> DataFrame:
    found = spark.read.schema(_CACHE).parquet(cache).filter(F.col("tokenizer") == tokenizer)
    # Two runs at once may both have added a text.
    return found.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_chars: int = 2_000_000,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` for every row.

    ``cache`` is a folder on shared storage; it is made if it isn't there. Content is the
    text with null as empty: anything more would change what some tokenizer sees.
    """
    spark = docs.sparkSession
    content, kind = Path(tokenizer_path).read_bytes(), Path(tokenizer_path).suffix
    name = tokenizer_digest(content, kind)
    spark.createDataFrame([], _CACHE).write.mode("append").parquet(cache)
    text = F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(text, 256).alias("digest")
    rows = stored(
        docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), digest),
        "digests",
    )
    distinct = stored(rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")), "distinct")
    misses = distinct.join(_cached(spark, cache, name), "digest", "left_anti").select("digest")

    pick = F.conv(F.substring("digest", 1, PICK_BITS // 4), 16, 10).cast("int").alias("pick")
    wanted = F.broadcast(misses.select(pick).distinct())
    # One text of each digest, reduced before it moves.
    texts = (
        docs.select(digest, text.alias("text"))
        .withColumn("pick", pick)
        .join(wanted, "pick", "left_semi")
        .drop("pick")
        .dropDuplicates(["digest"])
        .join(misses, "digest", "left_semi")
    )
    shared = spark.sparkContext.broadcast(content)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(shared.value, kind).count
        for batch in batches:
            found, some, chars = [], [], 0
            for value in batch.column(1):
                some.append(value.as_py())
                chars += len(some[-1])
                if chars > batch_chars:
                    found += count(some)
                    some, chars = [], 0
            found += count(some)
            columns = [pa.array([name] * len(found)), batch.column(0), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["tokenizer", "digest", "n_tokens"])

    texts.select("digest", "text").mapInArrow(encode, _CACHE).write.mode("append").parquet(cache)
    counts = distinct.join(_cached(spark, cache, name), "digest")
    return attach(rows, counts, ["digest"], max(1, rows.count())).select("doc_id", "n_bytes", "n_tokens")


def op6_digest_cache(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    cache = scratch_folder(spark, "token-cache")
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = count_tokens(table(spark, sf_dir, "documents"), path, cache)
    return found.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)
