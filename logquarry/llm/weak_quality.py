"""Text quality without hand-made labels.

Simple labellers vote good, bad or nothing on each document. Expectation-maximisation finds
how far each can be trusted from how they agree, and so the chance that a document is good
given its votes. These chances train a linear scorer on hashed words and word shapes, which
also judges documents that no labeller has an opinion on.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import stored, table

#: The scorer is trained on about so many rows, chosen by hash. Votes are counted on all rows.
SAMPLE_ROWS = 6_000
FEATURE_BITS = 15
ROUNDS = 200
PASSES = 30
_SHAPE = bytes(
    65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256)
)
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ODD = bytes(c for c in b"#$%&*+<=>@\\^_`{|}~")
_RUNS = re.compile(rb"([aA0])\1+")

#: Each labeller: bad beyond the first limit, good within the second (None: it only ever says
#: bad). Measures are shares unless said otherwise. Kinds of junk overlap in several of them.
LABELLERS = (
    ("odd_signs", 0.03, None),
    ("capitals", 0.4, None),
    ("exclamations", 0.02, None),
    ("unclean_words", 0.3, 0.1),
    ("unended_lines", 0.5, 0.25),
    ("commonest_word", 0.2, None),
    ("repeated_pairs", 0.5, 0.25),
    ("repeated_lines", 0.4, None),
    ("digits", 0.2, None),
    ("words_per_end", 60.0, 30.0),
)
#: A word of letters with at most one mark of punctuation on either side, in bytes.
_CLEAN = re.compile(rb"[\"'(]?[A-Za-z\x80-\xff]+(?:['-][A-Za-z\x80-\xff]+)*[.,;:!?)\"']?")


def measures(data: bytes, words: list[bytes]) -> list[float]:
    """What the labellers look at, in their order; all 0 without words."""
    if not words:
        return [0.0] * len(LABELLERS)
    length, n = len(data), len(words)
    letters = length - len(data.translate(None, _UPPER + _UPPER.lower()))
    lines = [line.strip() for line in data.split(b"\n") if line.strip()]
    pairs = n - 1
    return [
        (length - len(data.translate(None, _ODD))) / length,
        (length - len(data.translate(None, _UPPER))) / max(1, letters),
        data.count(b"!") / length,
        sum(1 for w in words if not _CLEAN.fullmatch(w)) / n,
        sum(1 for line in lines if line[-1:] not in b".!?:") / len(lines),
        # Too few words say nothing about repeats.
        max(Counter(words).values()) / n if n >= 20 else 0.0,
        1 - len(set(zip(words, words[1:], strict=False))) / pairs if n >= 20 else 0.3,
        1 - len(set(lines)) / len(lines),
        (length - len(data.translate(None, b"0123456789"))) / length,
        n / max(1, data.count(b".") + data.count(b"!") + data.count(b"?")),
    ]


def votes(found: list[float]) -> int:
    """The votes as one number in base 3: 0 none, 1 good, 2 bad."""
    out = 0
    for value, (_, bad, good) in zip(found, LABELLERS, strict=True):
        out = 3 * out + (2 if value > bad else 1 if good is not None and value <= good else 0)
    return out


def unpacked(patterns: np.ndarray) -> np.ndarray:
    powers = 3 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return patterns[:, None] // powers % 3


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Chance that a document with each pattern of votes is good.

    Labellers are taken as independent given the truth. It starts near the votes, so good
    stays good, and counts are smoothed.
    """
    cast = unpacked(patterns)
    # A vote for bad is the rarer and says more.
    for_good, for_bad = (cast == 1).sum(axis=1), 3 * (cast == 2).sum(axis=1)
    good = (1 + for_good) / (2 + for_good + for_bad)
    weight = counts / max(1, counts.sum())
    for _ in range(rounds):
        share = np.clip((weight * good).sum(), 0.01, 0.99)
        log_odds = np.full(len(patterns), np.log(share / (1 - share)))
        for k in range(cast.shape[1]):
            for vote in range(3):
                mine = cast[:, k] == vote
                a = ((weight * good)[mine].sum() + 1e-3) / ((weight * good).sum() + 3e-3)
                b = ((weight * (1 - good))[mine].sum() + 1e-3) / ((weight * (1 - good)).sum() + 3e-3)
                log_odds[mine] += np.log(a / b)
        new = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
        if np.abs(new - good).max(initial=0) < 1e-6:
            return new
        good = new
    return good


def features(data: bytes, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed shares of lower-case words and of word shapes; one half of the range for each."""
    half = 1 << (FEATURE_BITS - 1)
    shapes = _RUNS.sub(rb"\1", data.translate(_SHAPE)).split()
    index, share = [], []
    for base, counts in ((0, Counter(words)), (half, Counter(shapes))):
        index += [base + zlib.crc32(w) % half for w in counts]
        share += [np.sqrt(c / max(1, len(words))) for c in counts.values()]
    return np.array(index, np.int32), np.array(share, np.float32)


def train_scorer(rows: list[tuple[np.ndarray, np.ndarray]], goods: np.ndarray, passes: int = PASSES) -> np.ndarray:
    """Weights, the last for the constant, by adaptive gradient steps on soft labels."""
    size = (1 << FEATURE_BITS) + 1
    weights, squares = np.zeros(size), np.full(size, 1e-6)
    order = np.random.default_rng(0)
    for _ in range(passes):
        for k in order.permutation(len(rows)):
            index, share = rows[k]
            z = weights[-1] + (weights[index] * share).sum()
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - goods[k]
            gradient = error * share + 1e-6 * weights[index]
            np.add.at(squares, index, gradient * gradient)
            step = 0.1 * gradient / np.sqrt(squares[index])
            np.subtract.at(weights, index, step)
            squares[-1] += error * error
            weights[-1] -= 0.1 * error / np.sqrt(squares[-1])
    return weights


def _voted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1).cast(pa.binary()):
                data = value.as_py() or b""
                out.append(votes(measures(data, data.lower().split())))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64())], ["draw", "votes"])

    draw = F.pmod(F.xxhash64(id_col, F.lit("quality")), F.lit(1 << 20)).alias("draw")
    return docs.select(draw, F.col(text_col).alias("text")).mapInArrow(run, "draw long, votes long")


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[np.ndarray, dict[int, float]]:
    """Weights of the scorer, and for each pattern of votes the chance of being good.

    Vote patterns are counted over all rows; there are 3 ** len(LABELLERS) at most.
    """
    counted = _voted(docs, id_col, text_col).groupBy("votes").agg(F.count(F.lit(1)).alias("n")).toPandas()
    total = int(counted["n"].sum())
    patterns, counts = counted["votes"].to_numpy(np.int64), counted["n"].to_numpy(np.float64)
    order = np.argsort(patterns)
    patterns, counts = patterns[order], counts[order]
    chances = dict(zip(patterns.tolist(), estimate(patterns, counts).tolist(), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("votes", pa.int64()), ("i", pa.list_(pa.int32())), ("x", pa.list_(pa.float32()))])
        for batch in batches:
            out = []
            for key, value in zip(batch.column(0), batch.column(1).cast(pa.binary()), strict=True):
                data = value.as_py() or b""
                words = data.lower().split()
                index, share = features(data, words)
                out.append({"id": key.as_py(), "votes": votes(measures(data, words)), "i": index, "x": share})
            yield pa.RecordBatch.from_pylist(out, schema)

    most = int((1 << 20) * min(1.0, SAMPLE_ROWS / max(1, total)))
    hashed = F.xxhash64(id_col, F.lit("quality"))
    sample = docs.select(hashed.alias("id"), F.col(text_col).alias("text")).filter(
        F.pmod("id", F.lit(1 << 20)) < most
    )
    rows = sample.mapInArrow(run, "id long, votes long, i array<int>, x array<float>").toPandas()
    rows = rows.sort_values(["id", "votes"], kind="stable")
    goods = np.array([chances.get(v, 0.5) for v in rows["votes"]])
    pairs = [(np.asarray(i, np.int32), np.asarray(x, np.float32)) for i, x in zip(rows["i"], rows["x"], strict=True)]
    return train_scorer(pairs, goods), chances


_known: dict[str, np.ndarray] = {}


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, votes, score)`` for every row; a text without words scores 0."""
    shared, name = docs.sparkSession.sparkContext.broadcast(weights), uuid4().hex
    schema = docs.select(id_col, F.lit(0).cast("long").alias("votes"), F.lit(0.0).alias("score")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if name not in _known:
                _known.clear()
                _known[name] = shared.value
            w, cast, out = _known[name], [], []
            for value in batch.column(1).cast(pa.binary()):
                data = value.as_py() or b""
                words = data.lower().split()
                index, share = features(data, words)
                z = w[-1] + (w[index] * share).sum()
                cast.append(votes(measures(data, words)))
                out.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))) if words else 0.0)
            columns = [pa.array(cast, pa.int64()), pa.array(out, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return docs.select(id_col, F.col(text_col).alias("text_")).mapInArrow(run, schema)


def op10_weak_labels(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    weights, _ = fit(docs)
    return score(docs, weights).select("doc_id", "score", (F.col("score") >= 0.5).alias("keep"))
