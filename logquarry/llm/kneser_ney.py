"""Language identification by interpolated Kneser-Ney models of letters.

One model per language, all kept in sorted arrays of packed n-grams: four symbols of 16 bits
make a key of 64, so shifts give the context and masks the shorter n-gram. The language with
the lowest cross-entropy per symbol wins. How sure that is, and when a text is too unlike
its language, is calibrated on rows that the models have not seen.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import stored, table

ORDER = 4
#: The models are fitted on about so many rows per language, chosen by hash, and calibrated
#: on at most a third as many others. Prediction covers all rows.
SAMPLE_ROWS = 1_200
#: So many languages share arrays of n-grams; with more of them, each portion has its own.
PORTION_LANGS = 16
#: Calibration rejects nothing that looks like a labelled row: a winner less likely than
#: MARGIN times the least likely right winner there (MIN_SCORE at most), or a text whose
#: cross-entropy lies more standard deviations above that of its language than 1 / MARGIN
#: times the most seen there (MAX_DEVIATIONS at least).
MIN_SCORE = 0.5
MAX_DEVIATIONS = 8.0
MARGIN = 0.5
_CHUNK = 200_000
_BLANK = 32


@lru_cache(maxsize=1)
def _symbols() -> tuple[np.ndarray, np.ndarray]:
    """Code point to symbol (letters and marks in lower case, else a blank), and letters."""
    symbol = np.full(0x110000, _BLANK, np.uint16)
    letter = np.zeros(0x110000, bool)
    for code in range(0x110000):
        char = chr(code)
        kind = unicodedata.category(char)[0]
        if kind in "LM":
            low = ord(char.lower()) if len(char.lower()) == 1 else code
            symbol[code] = low if low < 0xE000 else 0xE000 + low % 0x1FFF
            letter[code] = kind == "L"
    return symbol, letter


def symbols_of(text: str) -> np.ndarray | None:
    """Symbols with single blanks between words, or None if the text has no letter."""
    symbol, letter = _symbols()
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not letter[codes].any():
        return None
    found = symbol[codes]
    blank = found == _BLANK
    kept = ~blank
    kept[1:] |= blank[1:] & ~blank[:-1]
    return found[kept]


def grams_of(symbols: np.ndarray, order: int = ORDER) -> np.ndarray:
    """Packed n-grams that end at each symbol; the text begins after blanks."""
    padded = np.concatenate((np.full(order - 1, _BLANK, np.uint64), symbols.astype(np.uint64)))
    grams = np.zeros(len(symbols), np.uint64)
    for k in range(order):
        grams = (grams << np.uint64(16)) | padded[k : k + len(symbols)]
    return grams


def _mask(order: int) -> np.uint64:
    return np.uint64((1 << 16 * order) - 1)


@dataclass
class Models:
    """For each order the n-grams seen in any language, and contexts, with a column per language."""

    langs: list[str]
    vocabulary: int = 1
    keys: dict[int, np.ndarray] = field(default_factory=dict)
    logs: dict[int, np.ndarray] = field(default_factory=dict)
    contexts: dict[int, np.ndarray] = field(default_factory=dict)
    backoffs: dict[int, np.ndarray] = field(default_factory=dict)
    scale: float = 1.0
    mean: np.ndarray | None = None
    deviation: np.ndarray | None = None
    typical: np.ndarray | None = None
    least_score: float = MIN_SCORE
    most_deviations: float = MAX_DEVIATIONS

    def log_p(self, grams: np.ndarray, order: int) -> np.ndarray:
        """Log-probabilities of the last symbols, a row for each n-gram."""
        if order not in self.keys:
            return np.full((len(grams), len(self.langs)), -math.log(self.vocabulary), np.float32)
        keys = self.keys[order]
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1)
        out = self.logs[order][at]
        missed = np.flatnonzero(keys[at] != grams)
        if len(missed):
            rest = grams[missed]
            lower = self.log_p(rest & _mask(order - 1), order - 1)
            out[missed] = self._backoff(rest >> np.uint64(16), order) + lower
        return out

    def _backoff(self, contexts: np.ndarray, order: int) -> np.ndarray:
        """What a context leaves to shorter n-grams; all of it where it was not seen."""
        known = self.contexts[order]
        at = np.minimum(np.searchsorted(known, contexts), len(known) - 1)
        return np.where((known[at] == contexts)[:, None], self.backoffs[order][at], np.float32(0))

    def entropies(self, symbols: np.ndarray) -> np.ndarray:
        """Nats per symbol for each language."""
        grams, total = grams_of(symbols), np.zeros(len(self.langs))
        for begin in range(0, len(grams), _CHUNK):
            total += self.log_p(grams[begin : begin + _CHUNK], ORDER).sum(axis=0, dtype=np.float64)
        return -total / len(grams)

    def judge(self, text: str | None) -> tuple[str, float, bool]:
        """Language, how sure, and whether to reject it."""
        symbols = symbols_of(text) if text and self.langs else None
        if symbols is None:
            return "und", 0.0, True
        entropy = self.entropies(symbols)
        best = int(entropy.argmin())
        score = self.score(entropy, best)
        unlike = self.deviations(entropy[best], best, len(symbols)) > self.most_deviations
        return self.langs[best], score, score < self.least_score or unlike

    def score(self, entropy: np.ndarray, lang: int) -> float:
        return float(1 / np.exp(np.minimum(self.scale * (entropy[lang] - entropy), 500)).sum())

    def deviations(self, entropy: float, lang: int, length: int) -> float:
        """How far the cross-entropy is above what is usual; short texts scatter more."""
        if self.mean is None or np.isnan(self.mean[lang]):
            return 0.0
        spread = self.deviation[lang] * math.sqrt(1 + self.typical[lang] / length)
        return float((entropy - self.mean[lang]) / spread)


@dataclass
class Portions(Models):
    """Models of many languages, a portion of them at a time."""

    parts: list[Models] = field(default_factory=list)

    def entropies(self, symbols: np.ndarray) -> np.ndarray:
        return np.concatenate([part.entropies(symbols) for part in self.parts])


def fit(
    langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]], vocabulary: int | None = None
) -> Models:
    """Models from the counts of ORDER-grams: for each language sorted keys and how often.

    ``vocabulary`` is that of all languages, where these are only a portion.
    """
    models = Models(langs)
    # Below the highest order a count is the number of symbols that an n-gram follows.
    by_order = {ORDER: counts}
    for order in range(ORDER - 1, 0, -1):
        by_order[order] = [
            np.unique(keys & _mask(order), return_counts=True) for keys, _ in by_order[order + 1]
        ]
    models.vocabulary = vocabulary or 1 + len(np.unique(np.concatenate([k for k, _ in by_order[1]])))
    if not any(len(keys) for keys, _ in counts):
        return models
    for order in range(1, ORDER + 1):
        keys = np.unique(np.concatenate([k for k, _ in by_order[order]]))
        contexts = np.unique(keys >> np.uint64(16))
        lower = np.exp(models.log_p(keys & _mask(order - 1), order - 1).astype(np.float64))
        chance, left = np.zeros_like(lower), np.zeros((len(contexts), len(langs)))
        for k, (own, n) in enumerate(by_order[order]):
            once, twice = int((n == 1).sum()), int((n == 2).sum())
            discount = once / (once + 2 * twice) if once and twice else 0.5
            at, place = np.searchsorted(keys, own), np.searchsorted(contexts, own >> np.uint64(16))
            sums = np.bincount(place, n, len(contexts))
            kinds = np.bincount(place, minlength=len(contexts))
            left[:, k] = np.where(sums > 0, discount * kinds / np.maximum(sums, 1), 1.0)
            chance[at, k] = (n - discount) / sums[place]
        chance += left[np.searchsorted(contexts, keys >> np.uint64(16))] * lower
        models.keys[order], models.contexts[order] = keys, contexts
        models.logs[order] = np.log(chance).astype(np.float32)
        models.backoffs[order] = np.log(left).astype(np.float32)
    return models


def calibrate(models: Models, truth: np.ndarray, lengths: np.ndarray, entropies: np.ndarray) -> None:
    """Scale of the scores, and the usual cross-entropy of each language, from unseen rows."""
    if not len(truth):
        return
    found = []
    for scale in (1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0):
        margin = scale * (entropies[np.arange(len(truth)), truth][:, None] - entropies)
        found.append((np.log(np.exp(np.minimum(margin, 500)).sum(axis=1)).mean(), scale))
    models.scale = min(found)[1]
    own = entropies[np.arange(len(truth)), truth]
    sizes = [own[truth == k] for k in range(len(models.langs))]
    models.mean = np.array([x.mean() if len(x) > 1 else np.nan for x in sizes])
    # No narrower than a tenth of a nat, for languages with few or very even rows.
    models.deviation = np.array([max(x.std(), 0.1) if len(x) > 1 else np.nan for x in sizes])
    models.typical = np.array(
        [np.median(lengths[truth == k]) if len(x) > 1 else 1.0 for k, x in enumerate(sizes)]
    )
    right = [k for k in range(len(truth)) if entropies[k].argmin() == truth[k]]
    scores = [models.score(entropies[k], truth[k]) for k in right]
    far = [models.deviations(own[k], truth[k], lengths[k]) for k in right]
    models.least_score = min([MIN_SCORE, *(MARGIN * x for x in scores)])
    models.most_deviations = max([MAX_DEVIATIONS, *(x / MARGIN for x in far)])


def fold(id_col: str) -> Column:
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(5))


def train(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Models:
    """Models from labelled rows of the folds 1 to 4; fold 1 only calibrates.

    Counting runs on Spark; what comes to the driver are the n-gram kinds and the calibration
    rows of a sample with SAMPLE_ROWS per language.
    """
    known = docs.select(
        fold(id_col).alias("fold"),
        F.col(lang_col).alias("lang"),
        F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 20)).alias("draw"),
    ).filter("fold <> 0 and lang is not null and text is not null")
    rows = known.groupBy("lang").count().collect()
    langs = sorted(r.lang for r in rows)
    if not langs:
        return Models([])
    place = {lang: k for k, lang in enumerate(langs)}
    limits = [(place[r["lang"]], r["lang"], SAMPLE_ROWS / r["count"] * (1 << 20)) for r in rows]
    chosen = docs.sparkSession.createDataFrame(limits, "k int, lang string, most double")
    sample = known.join(F.broadcast(chosen), "lang").filter("draw < most")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (symbols := symbols_of(text)) is not None:
                    keys, n = np.unique(grams_of(symbols), return_counts=True)
                    columns = [np.full(len(keys), k, np.int32), keys.view(np.int64), n.astype(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["k", "gram", "n"])

    counted = (
        sample.filter("fold > 1")
        .select("k", "text")
        .mapInArrow(count, "k int, gram long, n long")
        .groupBy("k", "gram")
        .agg(F.sum("n").alias("n"))
    )
    if len(langs) > PORTION_LANGS:
        counted = stored(counted, "grams")
        vocabulary = 1 + counted.select(F.col("gram").bitwiseAND(F.lit(0xFFFF))).distinct().count()
        parts = []
        for begin in range(0, len(langs), PORTION_LANGS):
            some = langs[begin : begin + PORTION_LANGS]
            parts.append(fit(some, _collected(counted, begin, len(some)), vocabulary))
        if vocabulary == 1:
            return Models([])
        models = Portions(langs, vocabulary, parts=parts)
    else:
        counts = _collected(counted, 0, len(langs))
        if not any(len(keys) for keys, _ in counts):
            return Models([])
        models = fit(langs, counts)
    shared, name = docs.sparkSession.sparkContext.broadcast(models), uuid4().hex

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (symbols := symbols_of(text)) is not None:
                    out.append((k, len(symbols), _shared(name, shared).entropies(symbols).tolist()))
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("k", "length", "entropies"), x, strict=True)) for x in out],
                pa.schema([("k", pa.int32()), ("length", pa.int64()), ("entropies", pa.list_(pa.float64()))]),
            )

    found = (
        sample.filter("fold = 1")
        .select("k", "text")
        .mapInArrow(measure, "k int, length long, entropies array<double>")
        .toPandas()
    )
    if len(found):
        calibrate(
            models, found["k"].to_numpy(), found["length"].to_numpy(), np.stack(found["entropies"].to_list())
        )
    return models


def _collected(counted: DataFrame, begin: int, size: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted n-grams and how often, for each of ``size`` languages from ``begin`` on."""
    found, out = counted.filter(F.col("k").between(begin, begin + size - 1)).toPandas(), []
    for k in range(begin, begin + size):
        own = found[found["k"] == k]
        keys, n = own["gram"].to_numpy(np.int64).view(np.uint64), own["n"].to_numpy(np.int64)
        order = np.argsort(keys)
        out.append((keys[order], n[order]))
    return out


_known: dict[str, Models] = {}


def _shared(name: str, broadcast) -> Models:
    """The broadcast models, one set at a time in each Python worker."""
    if name not in _known:
        _known.clear()
        _known[name] = broadcast.value
    return _known[name]


def identify(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, lang_pred, score, rejected)`` for every row, from its text alone.

    Texts that are null or have no letter, and all texts if there was nothing to learn from,
    are ``und`` with score 0 and rejected.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast(models), uuid4().hex
    kept = docs.select(id_col, F.col(text_col).alias("text_"))
    schema = docs.select(
        id_col,
        F.lit("").alias("lang_pred"),
        F.lit(0.0).alias("score"),
        F.lit(False).alias("rejected"),
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_shared(name, shared).judge(t.as_py()) for t in batch.column(1)]
            lang, score, rejected = zip(*found, strict=True) if found else ((), (), ())
            columns = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return kept.mapInArrow(run, schema)


def keep_identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    models = train(docs, id_col, text_col, lang_col)
    packed = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col(text_col).alias("text_")
    )
    return identify(packed, models, "row", "text_").filter("not rejected").select("row.*")


def op9_kneser_ney(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(docs))
    held_out = F.coalesce(fold("doc_id") == 0, F.lit(False))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
