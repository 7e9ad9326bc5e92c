"""Language-model scores by a hidden Markov model over words.

Words are counted over all texts to learn from. The commonest have symbols of their own, the
others share a symbol with those that end alike, and a word's share of its symbol is known from
the counts. Baum-Welch re-estimates what the hidden states emit and which follow which: each
task runs the scaled forward and backward recursions over its texts, and Spark adds up the
expected counts. The texts are learned from portion by portion, so that the states part early,
and then all together. The scaled forward recursion gives the exact likelihood of a text.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, pairwise
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import stored, table
from logquarry.session import scratch_folder

STATES = 16
#: Words with a symbol of their own, and symbols that rarer words share, by their last bytes.
OWN_WORDS = 16_384
SHARED = 2_048
ENDING = 3
#: Words whose counts every task knows, of up to LONG_WORD bytes; others are looked up by a join.
KNOWN_WORDS = 1 << 18
LONG_WORD = 64
#: Portions of the texts, each learned from once before all are.
PORTIONS = 32
#: How fast a portion's counts fade: the n-th has the weight (n + 2) ** -FADE when it comes.
FADE = 0.6
#: Words that the plain distribution weighs in each state.
PRIOR = 1_000.0
#: Counts are added up as whole numbers of this many to one, so that no order matters.
PARTS = 1 << 16
#: Distinct words that a task counts before it passes them on.
COUNTED_WORDS = 400_000
#: Tokens of texts that are looked up together, at the least.
LOOKED_UP = 100_000
#: Tokens in memory at a time; longer texts are cut to be learned from, and scored in pieces.
SLICE_TOKENS = 600_000
PIECE_TOKENS = 1 << 15
END = 0


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").lower().split()


def word_key(word: bytes) -> bytes:
    """The word, or a digest that no word is like if it is a long one."""
    return word if len(word) <= LONG_WORD else b"\n" + hashlib.sha256(word).digest()


def shared_symbol(key: bytes) -> int:
    return zlib.crc32(key[-ENDING:]) % SHARED


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n)`` over all ``texts`` (text), a row for each distinct word; no ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[pa.RecordBatch]:
            words = list(map(word_key, counts))
            columns = [pa.array(words, pa.binary()), pa.array(list(counts.values()), pa.int64())]
            counts.clear()
            return pa.RecordBatch.from_arrays(columns, ["word", "n"])

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()):
                words = iter(words_of(text.as_py()))
                while some := list(islice(words, COUNTED_WORDS)):
                    counts.update(some)
                    if len(counts) >= COUNTED_WORDS:
                        yield found()
        yield found()

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """What tasks know of the counts: the commonest words, and the sums of all.

    ``words`` have falling counts; the first ``own`` have the symbols from 1 on. ``rest_n`` and
    ``rest_words`` are, per shared symbol, the tokens and the words without an own one.
    """

    words: list[bytes]
    counts: np.ndarray
    own: int
    rest_n: np.ndarray
    rest_words: np.ndarray
    texts: int
    total: int
    distinct: int

    @property
    def symbols(self) -> int:
        return 1 + self.own + SHARED

    def plain(self) -> np.ndarray:
        """The smoothed share of each symbol; a shared one has a word more, the unknown one."""
        n = np.concatenate(([self.texts], self.counts[: self.own], self.rest_n + self.rest_words))
        return (n + 1) / (n + 1).sum()


def vocabulary(
    counts: DataFrame, texts: int, own_words: int = OWN_WORDS, known_words: int = KNOWN_WORDS
) -> Vocabulary:
    """The Vocabulary of stored ``counts`` (word, n): at most ``known_words`` of them come here."""
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).first()
    levels = counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))
    least, found = None, 0
    # Counts from the highest down, as far as all words of a count fit; so no more rows than words.
    for level in levels.orderBy(F.desc("n")).limit(known_words).collect():
        found += level.words
        if found > known_words:
            break
        least = level.n
    found = counts.filter(F.lit(False) if least is None else F.col("n") >= least).toArrow()
    known = sorted(zip((-n for n in found.column("n").to_pylist()), found.column("word").to_pylist(), strict=True))
    symbol = F.pmod(F.crc32(F.substring("word", -ENDING, ENDING)), F.lit(SHARED)).alias("symbol")
    rest_n, rest_words = np.zeros(SHARED), np.zeros(SHARED)
    for row in counts.groupBy(symbol).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")).collect():
        rest_n[row.symbol], rest_words[row.symbol] = row.n, row.words
    for n, word in known[:own_words]:
        rest_n[shared_symbol(word)] += n
        rest_words[shared_symbol(word)] -= 1
    return Vocabulary(
        [word for _, word in known],
        np.array([-n for n, _ in known], np.int64),
        min(own_words, len(known)),
        rest_n,
        rest_words,
        texts,
        texts + (sums.n or 0),
        sums.words + (texts > 0),
    )


class _Table(dict):
    """Places of words, -1 for those that are not in it."""

    def __missing__(self, word: bytes) -> int:
        return -1


_built: dict[str, tuple] = {}


def _tables(name: str, shared) -> tuple:
    """Look-up tables of a broadcast Vocabulary, built once in each Python worker."""
    if name not in _built:
        _built.clear()
        v: Vocabulary = shared.value
        places = _Table(zip(v.words, range(len(v.words)), strict=True))
        groups = np.array([shared_symbol(w) for w in v.words[v.own :]], np.int64)
        symbol = np.concatenate((np.arange(1, 1 + v.own), 1 + v.own + groups)).astype(np.uint16)
        logs = np.log10(v.counts + 1.0)
        rest = np.log10(v.rest_n + v.rest_words + 1)
        inside = np.concatenate((np.zeros(v.own), logs[v.own :] - rest[groups]))
        _built[name] = places, symbol, logs, inside, rest
    return _built[name]


_ENCODED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, inside double,"
    " symbols binary, rare array<binary>, times array<int>, portion int"
)


def encode(read: DataFrame, known: Vocabulary) -> DataFrame:
    """``read`` (row, doc_id, held_out, portion, text) as symbols, each row with its sums.

    ``logs`` has log10(count + 1) of the tokens that tasks know, ``inside`` the logarithms of the
    shares of tokens in shared symbols; ``rare`` are the words, and how often, that lack their
    count + 1 in both.
    """
    shared, name = read.sparkSession.sparkContext.broadcast(known), uuid4().hex
    first, end = 1 + known.own, np.log10(known.texts + 1.0)
    names = [x.split()[0] for x in _ENCODED.split(", ")]

    def looked_up(words: list[bytes], counts: np.ndarray) -> list[pa.Array]:
        places, symbol, logs, inside, rest = _tables(name, shared)
        texts = len(counts)
        at = np.fromiter(map(places.__getitem__, words), np.int64, len(words))
        row = np.repeat(np.arange(texts), counts)
        # Long words are known by their digests.
        missing = np.flatnonzero(at < 0)
        keys = [word_key(words[i]) for i in missing]
        at[missing] = [places[k] if k[:1] == b"\n" else -1 for k in keys]
        keys = [k for k, i in zip(keys, missing, strict=True) if at[i] < 0]
        seen, missing = at >= 0, np.flatnonzero(at < 0)
        groups = np.array([shared_symbol(k) for k in keys], np.int64)
        codes = np.zeros(len(words) + texts, np.uint16)
        place = np.arange(len(words)) + row
        codes[place[seen]] = symbol[at[seen]]
        codes[place[missing]] = first + groups
        ends = np.cumsum(counts + 1)
        # Without rows, the sums would be integers.
        per_text = lambda rows, values: np.bincount(rows, values, texts).astype(float)
        within = per_text(row[seen], inside[at[seen]]) - per_text(row[missing], rest[groups])
        rare, times, cuts = [], [], [0]
        for i, j in pairwise(np.searchsorted(row[missing], np.arange(texts + 1)).tolist()):
            own = Counter(keys[i:j])
            rare += own
            times += own.values()
            cuts.append(len(rare))
        offsets = np.concatenate(([0], 2 * ends)).astype(np.int32)
        cuts = pa.array(cuts, pa.int32())
        return [
            pa.array(counts + 1),
            pa.array(np.bincount(row[seen], minlength=texts) + (known.texts > 0)),
            pa.array(per_text(row[seen], logs[at[seen]]) + end),
            pa.array(within),
            pa.Array.from_buffers(pa.binary(), texts, [None, pa.py_buffer(offsets), pa.py_buffer(codes)]),
            pa.ListArray.from_arrays(cuts, pa.array(rare, pa.binary())),
            pa.ListArray.from_arrays(cuts, pa.array(times, pa.int32())),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, words, counts = 0, [], []
            for k, text in enumerate(batch.column(4).cast(pa.binary()), 1):
                own = words_of(text.as_py())
                words += own
                counts.append(len(own))
                if len(words) >= LOOKED_UP or k == len(batch):
                    part = batch.slice(begin, k - begin)
                    made = looked_up(words, np.array(counts, np.int64))
                    yield pa.RecordBatch.from_arrays([*part.columns[:3], *made, part.column(3)], names=names)
                    begin, words, counts = k, [], []

    return read.select("row", "doc_id", "held_out", "portion", "text").mapInArrow(run, _ENCODED)


def by_portion(encoded: DataFrame) -> DataFrame:
    """Like ``stored``, in a folder for each portion, so that a round reads its own only."""
    spark = encoded.sparkSession
    path = scratch_folder(spark, "symbols")
    encoded.write.partitionBy("portion").parquet(path)
    return spark.read.schema(encoded.schema).parquet(path)


@dataclass
class Model:
    """First state, next state by state, symbols by state; ``any`` is the state a cut text goes on in."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray
    any: np.ndarray


def _slices(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Indices of sequences by falling length, about SLICE_TOKENS together."""
    order = np.argsort(-lengths, kind="stable")
    ends = np.cumsum(lengths[order]) // SLICE_TOKENS
    return (part for part in np.split(order, np.flatnonzero(np.diff(ends)) + 1) if len(part))


def _active(lengths: np.ndarray) -> np.ndarray:
    """How many of the sequences, by falling length, have a token at each place."""
    return len(lengths) - np.searchsorted(lengths[::-1], np.arange(lengths[0]), side="right")


def expected_counts(tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray, whole: np.ndarray, model: Model):
    """Expected counts of first states, of steps and of symbols, and the log likelihood.

    Sequence k, by falling length, is ``tokens`` from ``starts[k]`` on. One that is not
    ``whole`` goes on from another: its first state is not counted as one.
    """
    emit, step, kind = model.emit, model.step, model.emit.dtype
    states, back = len(emit), np.ascontiguousarray(model.step.T)
    active = _active(lengths)
    # A row per state and a column per sequence, as far as they go.
    forward, scales, ids = [], [], []
    state = np.where(whole, model.start[:, None], model.any[:, None]).astype(kind)
    for t, m in enumerate(active):
        ids.append(tokens[starts[:m] + t])
        here = emit.take(ids[-1], axis=1)
        here *= state if t == 0 else back @ state[:, :m]
        scales.append(here.sum(axis=0))
        here /= scales[-1]
        forward.append(here)
        state = here
    steps = np.zeros((states, states))
    later = None
    for t in range(len(active) - 1, -1, -1):
        backward = np.ones((states, active[t]), kind)
        if later is not None:
            m = active[t + 1]
            seen = emit.take(ids[t + 1], axis=1)
            seen *= later
            seen /= scales[t + 1]
            steps += forward[t][:, :m] @ seen.T
            backward[:, :m] = step @ seen
            forward[t + 1] *= later
        later = backward
    forward[0] *= later
    first = forward[0][:, whole].sum(axis=1, dtype=float)
    symbols = np.concatenate(ids).astype(np.intp)
    emitted = np.stack([np.bincount(symbols, np.concatenate([f[k] for f in forward]), emit.shape[1]) for k in range(states)])
    return first, steps * step, emitted, float(np.log(np.concatenate(scales), dtype=float).sum())


def _learned(encoded: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """The expected counts over all rows of ``encoded``, and the log10 likelihood.

    Rows (symbol, a number per state) are added up by Spark: a symbol's, -1 for first states,
    -2 - k for steps from state k. There are no more of them than symbols and states.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    states = len(model.start)
    names = [f"s{k}" for k in range(states)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        emit = own.emit.astype(np.float32)
        own = Model(own.start.astype(np.float32), own.step.astype(np.float32), emit, own.any.astype(np.float32))
        first, steps, emitted, likelihood = np.zeros(states), np.zeros((states, states)), np.zeros(emit.shape), 0.0
        for batch in batches:
            column = batch.column(0)
            lengths = np.array([len(b.as_buffer()) // 2 for b in column], np.int64)
            tokens = np.frombuffer(b"".join(b.as_buffer() for b in column), np.uint16)
            starts = np.cumsum(lengths) - lengths
            # Long texts in pieces.
            pieces = -(-lengths // PIECE_TOKENS)
            place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begins = np.repeat(starts, pieces) + place * PIECE_TOKENS
            sizes = np.minimum(np.repeat(starts + lengths, pieces) - begins, PIECE_TOKENS)
            for some in _slices(sizes):
                a, b, c, d = expected_counts(tokens, begins[some], sizes[some], place[some] == 0, own)
                first, steps, emitted, likelihood = first + a, steps + b, emitted + c, likelihood + d
        used = np.flatnonzero(emitted.any(axis=0))
        rows = np.vstack((first, steps, np.full(states, likelihood / np.log(10) / states), emitted[:, used].T))
        symbol = np.concatenate((-1 - np.arange(states + 2), used)).astype(np.int32)
        whole = np.rint(rows * PARTS).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(symbol), *map(pa.array, whole.T)], ["symbol", *names])

    schema = "symbol int, " + ", ".join(f"{n} long" for n in names)
    sums = encoded.select("symbols").mapInArrow(run, schema).groupBy("symbol").agg(*[F.sum(n).alias(n) for n in names])
    found = sums.toArrow()
    shared.unpersist()
    symbol = found.column("symbol").to_numpy()
    values = np.stack([found.column(n).to_numpy() for n in names], axis=1) / PARTS
    emitted, other = np.zeros(model.emit.shape), np.zeros((states + 2, states))
    emitted[:, symbol[symbol >= 0]] = values[symbol >= 0].T
    other[-1 - symbol[symbol < 0]] = values[symbol < 0]
    return other[0], other[1:-1], emitted, float(other[-1].sum())


def _shares(counts: np.ndarray, axis: int) -> np.ndarray:
    return counts / counts.sum(axis=axis, keepdims=True)


def train(encoded: DataFrame, known: Vocabulary, states: int = STATES, portions: int = PORTIONS, seed: int = 12) -> Model:
    """A model of the rows of ``encoded`` that are in a portion.

    One round for each portion and one over all. A round's counts are scaled to the corpus and
    faded into those before; the last round's stand alone, so the result is a Baum-Welch step
    over all rows. Without rows the states are alike.
    """
    plain, random = known.plain(), np.random.default_rng(seed)
    noise = np.exp(random.standard_normal((states, known.symbols)))
    model = Model(
        np.full(states, 1 / states),
        _shares(np.ones((states, states)) + np.eye(states) * states / 2, 1),
        _shares(plain * noise, 1),
        np.full(states, 1 / states),
    )
    learned = encoded.filter("portion >= 0")
    kept = None
    for number in [*range(portions), None] if known.texts else []:
        some = learned if number is None else learned.filter(F.col("portion") == number)
        first, steps, emitted, _ = _learned(some, model)
        tokens = emitted.sum()
        if not tokens:
            continue
        share = 1.0 if kept is None or number is None else (number + 2) ** -FADE
        now = [c / tokens for c in (first, steps, emitted)]
        kept = now if kept is None else [(1 - share) * a + share * b for a, b in zip(kept, now, strict=True)]
        first, steps, emitted = (c * known.total for c in kept)
        model = Model(
            _shares(first + 1, 0),
            _shares(steps + 1, 1),
            _shares(emitted + PRIOR * plain, 1),
            _shares(emitted.sum(axis=1) + 1, 0),
        )
    return model


def _run(tokens: np.ndarray, starts: np.ndarray, lengths: np.ndarray, state: np.ndarray, model: Model):
    """The scaled forward recursion on columns of states, each its first token's, and its logs."""
    logs, last, back = np.zeros(len(starts)), np.zeros(state.shape), np.ascontiguousarray(model.step.T)
    for t, m in enumerate(_active(lengths)):
        here = model.emit.take(tokens[starts[:m] + t], axis=1)
        here *= state if t == 0 else back @ state[:, :m]
        scale = here.sum(axis=0)
        here /= scale
        logs[:m] += np.log10(scale)
        last[:, :m] = state = here
    return last, logs


def likelihoods(tokens: np.ndarray, lengths: np.ndarray, model: Model, piece: int = PIECE_TOKENS) -> np.ndarray:
    """The exact log10 likelihood of each sequence; they are laid end to end in ``tokens``.

    Long sequences are taken in pieces side by side: what a piece makes of each state that it
    may begin in, combined piece by piece.
    """
    states, out = len(model.start), np.zeros(len(lengths))
    starts = np.cumsum(lengths) - lengths
    for some in _slices(np.minimum(lengths, piece)):
        begin, size = starts[some], np.minimum(lengths[some], piece)
        last, out[some] = _run(tokens, begin, size, np.tile(model.start[:, None], len(some)), model)
        for k in np.flatnonzero(lengths[some] > piece):
            now, at = last[:, k], some[k]
            begins = np.arange(starts[at] + piece, starts[at] + lengths[at], piece)
            sizes = np.minimum(starts[at] + lengths[at] - begins, piece)
            for part in np.array_split(np.arange(len(begins)), max(1, len(begins) // 16)):
                row = np.repeat(part, states)
                ends, logs = _run(tokens, begins[row], sizes[row], np.tile(model.step.T, len(part)), model)
                ends, logs = ends.T.reshape(-1, states, states), logs.reshape(-1, states)
                for by_state, log in zip(ends, logs, strict=True):
                    top = log.max()
                    now = (now * 10 ** (log - top)) @ by_state
                    out[at] += top + np.log10(now.sum())
                    now /= now.sum()
    return out


def _scored(encoded: DataFrame, model: Model) -> DataFrame:
    """``encoded`` without symbols, with the ``hidden`` log10 likelihood of its symbols."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    columns = ["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "inside"]
    schema = encoded.select(*columns, F.lit(0.0).alias("hidden")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            symbols = batch.column(len(columns))
            lengths = np.array([len(b.as_buffer()) // 2 for b in symbols], np.int64)
            tokens = np.frombuffer(b"".join(b.as_buffer() for b in symbols), np.uint16)
            hidden = pa.array(likelihoods(tokens, lengths, shared.value))
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], hidden], names=schema.names)

    return encoded.select(*columns, "symbols").mapInArrow(run, schema)


def language_model_scores(
    docs: DataFrame,
    held_out: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    states: int = STATES,
    portions: int = PORTIONS,
    own_words: int = OWN_WORDS,
    known_words: int = KNOWN_WORDS,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` for every row.

    The model learns from the rows that are not ``held_out`` (null: they are not). A text is its
    words, A-Z in lower case, and an end; a null or empty one is the end alone. ``n_known`` of
    its tokens were seen. ``base_score`` is the log10 of each token's add-one share, summed;
    ``score`` the log10 likelihood of the text: of its symbols by the model, and of its words
    within shared symbols by add-one shares. Repeated rows and ids stay apart.
    """
    held = F.coalesce(held_out, F.lit(False))
    text = F.col(text_col).alias("text")
    texts = docs.filter(~held).select(text)
    counts = stored(word_counts(texts), "words")
    known = vocabulary(counts, texts.count(), own_words, known_words)

    portion = F.when(~held, F.pmod(F.xxhash64(id_col, text_col), F.lit(portions)).cast("int")).otherwise(-1)
    read = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).cast("long").alias("doc_id"),
        held.alias("held_out"),
        portion.alias("portion"),
        text,
    )
    # Written once: from here on a row keeps its number.
    encoded = by_portion(encode(read, known))
    model = train(encoded, known, states, portions)
    scored = _scored(encoded, model)

    # Words that tasks do not know: unseen ones have the logarithm 0 and find no count.
    rare = encoded.filter(F.size("rare") > 0).select("row", F.inline(F.arrays_zip("rare", "times")))
    least = int(known.counts.min(initial=np.iinfo(np.int64).max))
    found = rare.join(counts.filter(F.col("n") < least), F.col("rare") == F.col("word")).groupBy("row")
    looked_up = found.agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_logs")
    )
    none = F.lit(0.0)
    whole = scored.join(looked_up, "row", "left").withColumn("more_logs", F.coalesce("more_logs", none))
    slots = float(np.log10(known.total + known.distinct + 1.0))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("logs") + F.col("more_logs") - F.col("n_tokens") * slots).alias("base_score"),
        (F.col("hidden") + F.col("inside") + F.col("more_logs")).alias("score"),
    )


def op12_baum_welch(spark, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return language_model_scores(table(spark, sf_dir, "documents"), held_out)
