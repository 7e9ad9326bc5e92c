"""Whitening of embeddings: principal components by Chebyshev-filtered subspace iteration.

The covariance is never formed. A block of vectors is multiplied by it in passes over the
data: each task adds up X'(XQ) of its centred rows, and the sums, as small as the block, are
what moves. A Chebyshev polynomial of the covariance, by its three-term recurrence, damps the
unwanted part of the spectrum; QR and Rayleigh-Ritz turn the block to the eigenvectors, and
their residuals, from the same pass, say when they are exact. A Lanczos vector travels in the
block to find the lower end of the spectrum, which makes the damped interval a narrow one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logquarry.llm.common import stored, table

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Residuals, as shares of the largest eigenvalue: what is aimed at, and what is certified.
GOAL, CERTIFIED = 2e-14, 1e-10
MAX_CYCLES = 200
MAX_DEGREE = 12
#: How much a filter may favour the first component over the last wanted one, in the first
#: cycle, when all columns hold all components, and later on.
FIRST_SPREAD, SPREAD = 1e7, 1e12
#: Numbers of a block of rows.
BLOCK_NUMBERS = 1 << 18
#: Partial sums meet in so many groups before the driver adds them up.
SLOTS = 16
#: Doubles hold integers up to here; larger entries are cut off.
_LARGEST = 1 << 53


def integer_rows(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, x)``: the rows without null and non-finite entries, each entry an integer.

    The entry c becomes floor(64 c) + 1000000, or about 2 ** 53 where it is beyond that.
    """
    schema = rows.select(F.col(id_col).alias("vec_id"), F.array(F.lit(0).cast("long")).alias("x")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
            for length in np.unique(lengths[lengths > 0]).tolist():
                mine = pa.array(lengths == length)
                values = lists.filter(mine).flatten().fill_null(np.nan).to_numpy(zero_copy_only=False)
                values = values.reshape(-1, length)
                whole = np.isfinite(values).all(axis=1)
                x = np.clip(np.floor(SCALE * values[whole]), -_LARGEST, _LARGEST).astype(np.int64) + SHIFT
                ids = batch.column(0).filter(mine).filter(pa.array(whole))
                ends = pa.array(np.arange(len(x) + 1) * length, pa.int32())
                vectors = pa.ListArray.from_arrays(ends, pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([ids, vectors], ["vec_id", "x"])

    read = rows.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("c"))
    return read.mapInArrow(run, schema)


def _matrix(lists: pa.Array) -> np.ndarray:
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), -1) if len(lists) else values.reshape(0, 0)


def _blocks(vectors: DataFrame, dimension: int) -> DataFrame:
    """The vectors ``x`` as rows of bytes, many vectors in each."""
    most = max(1, BLOCK_NUMBERS // dimension)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0))
            cut = [x[i : i + most].tobytes() for i in range(0, len(x), most)]
            yield pa.RecordBatch.from_arrays([pa.array(cut, pa.binary())], ["block"])

    return vectors.select("x").mapInArrow(run, "block binary")


def _summed(blocks: DataFrame, dimension: int, shape: tuple[int, ...], kind: type, work: Callable) -> np.ndarray:
    """The sum of ``work(x)`` over all blocks: within tasks, then groups of tasks, then here."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, kind)
        for block in chain.from_iterable(batch.column(0) for batch in batches):
            total += work(np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dimension))
        at = TaskContext.get().partitionId()
        columns = [pa.array([at % SLOTS], pa.int32()), pa.array([at], pa.int32()), pa.array([total.tobytes()])]
        yield pa.RecordBatch.from_arrays(columns, ["slot", "at", "sums"])

    def add(group: pa.Table) -> pa.Table:
        parts = group.sort_by("at").column("sums")
        total = sum(np.frombuffer(p.as_buffer(), kind) for p in parts)
        return pa.table({"slot": group.column("slot")[:1], "sums": pa.array([total.tobytes()])})

    partial = blocks.mapInArrow(run, "slot int, at int, sums binary")
    found = partial.groupBy("slot").applyInArrow(add, "slot int, sums binary").collect()
    total = sum((np.frombuffer(r.sums, kind) for r in sorted(found, key=lambda r: r.slot)), np.zeros(1, kind))
    return np.broadcast_to(total, (int(np.prod(shape)),)).reshape(shape)


class Covariance:
    """The covariance of the fit list, as what it makes of a block of vectors.

    A mean is an integer and a rest below one, so centred entries are exact but for rounding.
    """

    def __init__(self, vectors: DataFrame, dimension: int):
        self.dimension, self.passes = dimension, 0
        self.blocks = stored(_blocks(vectors, dimension), "blocks")
        low = (1 << 26) - 1

        def count(x: np.ndarray) -> np.ndarray:
            # Two halves: neither sum overflows.
            return np.vstack((np.full(dimension, len(x)), (x >> 26).sum(axis=0), (x & low).sum(axis=0)))

        n, high, rest = self._pass((3, dimension), np.int64, count).tolist()
        self.n = n[0]
        self.sums = [(h << 26) + r for h, r in zip(high, rest, strict=True)]
        self.mean = np.array([s // self.n for s in self.sums], np.int64)
        self.rest = np.array([s % self.n for s in self.sums], np.int64)

    def _pass(self, shape: tuple[int, ...], kind: type, work: Callable) -> np.ndarray:
        self.passes += 1
        return _summed(self.blocks, self.dimension, shape, kind, work)

    def trace(self) -> float:
        centre = _centre(self.mean, self.rest, self.n)
        return float(self._pass((1,), np.float64, lambda x: np.array([np.square(centre(x)).sum()]))[0] / self.n)

    def times(self, block: np.ndarray) -> np.ndarray:
        centre = _centre(self.mean, self.rest, self.n)

        def work(x: np.ndarray) -> np.ndarray:
            y = centre(x)
            return y.T @ (y @ block)

        return self._pass(block.shape, np.float64, work) / self.n

    def of_projected(self, axes: np.ndarray) -> np.ndarray:
        """The covariance of the rows projected on ``axes``."""
        centre, width = _centre(self.mean, self.rest, self.n), axes.shape[1] + 1

        def work(x: np.ndarray) -> np.ndarray:
            y = np.hstack((centre(x) @ axes, np.ones((len(x), 1))))
            return y.T @ y

        found = self._pass((width, width), np.float64, work) / self.n
        return found[:-1, :-1] - np.outer(found[:-1, -1], found[:-1, -1])


def _centre(mean: np.ndarray, rest: np.ndarray, n: int) -> Callable[[np.ndarray], np.ndarray]:
    return lambda x: (x - mean) - rest / n


class Probe:
    """A Lanczos recurrence for the lower end of the spectrum, one step in each pass."""

    def __init__(self, dimension: int, random: np.random.Generator):
        self.basis = np.zeros((dimension, 0))
        self.diagonal, self.beside, self.random = [], [0.0], random
        self.vector = self._fresh()

    def _fresh(self) -> np.ndarray:
        z = self.random.standard_normal(len(self.basis))
        for _ in range(2):
            z -= self.basis @ (self.basis.T @ z)
        return z / np.linalg.norm(z)

    def feed(self, product: np.ndarray) -> None:
        """Takes the covariance times ``vector``; the next one is in ``vector``, None at the end."""
        self.basis = np.column_stack((self.basis, self.vector))
        self.diagonal.append(float(self.vector @ product))
        size = np.linalg.norm(product)
        for _ in range(2):
            product = product - self.basis @ (self.basis.T @ product)
        beside = float(np.linalg.norm(product))
        if self.basis.shape[1] == len(self.basis):
            self.beside.append(0.0)
            self.vector = None
        elif beside <= 1e-12 * size:
            self.beside.append(0.0)
            self.vector = self._fresh()
        else:
            self.beside.append(beside)
            self.vector = product / beside

    def lowest(self) -> float:
        """A bound for the least eigenvalue seen, never below 0."""
        inner = self.beside[1:-1]
        values, vectors = np.linalg.eigh(np.diag(self.diagonal) + np.diag(inner, 1) + np.diag(inner, -1))
        return max(0.0, float(values[0] - abs(self.beside[-1] * vectors[-1, 0])))


@dataclass
class Whitening:
    """Unit eigenvectors as columns, by falling eigenvalue; ``residual`` as a share of the largest."""

    n: int
    mean: np.ndarray
    rest: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    passes: int
    identity_error: float = 0.0

    @property
    def axes(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def _ritz(block: np.ndarray, product: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values by size, their vectors and what the covariance makes of them."""
    inner = block.T @ product
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    return values, block @ turn, product @ turn


def subspace(times: Callable[[np.ndarray], np.ndarray], dimension: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, float]:
    """The ``wanted`` largest eigenvalues, their vectors and their largest residual.

    ``times`` multiplies a block by a symmetric matrix without negative eigenvalues. Twice as
    many vectors are iterated as wanted. The cycles end when residuals are down to rounding;
    if they stay above CERTIFIED, there is no result but an error.
    """
    random = np.random.default_rng(seed)
    size = min(dimension, 2 * wanted)
    probe = Probe(dimension, random)

    def multiplied(block: np.ndarray) -> np.ndarray:
        if probe.vector is None:
            return times(block)
        product = times(np.column_stack((block, probe.vector)))
        probe.feed(product[:, -1])
        return product[:, :-1]

    block = np.linalg.qr(random.standard_normal((dimension, size)))[0]
    values, block, product = _ritz(block, multiplied(block))
    spread, before = FIRST_SPREAD, np.inf
    for _ in range(MAX_CYCLES):
        largest = max(values[0], np.finfo(float).tiny)
        apart = np.linalg.norm(product - block * values, axis=0)[:wanted] / largest
        residual = float(apart.max())
        # Below CERTIFIED, a cycle that gains little has come to the limits of rounding.
        if residual <= GOAL or residual <= CERTIFIED and residual > before / 4:
            return values[:wanted], block[:, :wanted], residual
        before = residual
        done = int((apart <= GOAL).argmin())
        filtered = _filtered(multiplied, block, values, done, wanted, probe.lowest(), spread)
        block = np.linalg.qr(np.hstack((block[:, :done], filtered)))[0]
        values, block, product = _ritz(block, multiplied(block))
        spread = SPREAD
    raise ArithmeticError(f"after {MAX_CYCLES} cycles residuals are {residual:.1e} of the largest eigenvalue")


def _filtered(
    times: Callable, block: np.ndarray, values: np.ndarray, done: int, wanted: int, low: float, spread: float
) -> np.ndarray:
    """The columns of ``block`` from ``done`` on, through a Chebyshev polynomial.

    It is small from ``low`` to the least Ritz value, and grows fast above. Columns before
    ``done`` are eigenvectors already: they are kept out, and so is what they would outgrow.
    """
    locked, new, top = block[:, :done], block[:, done:], values[done]
    # Not so narrow that two steps favour the first column beyond the spread.
    high = max(values[-1], 4 * top / np.sqrt(spread))
    low = low if low < high else 0.0
    middle, half = (high + low) / 2, (high - low) / 2
    place = lambda value: float(np.arccosh(max(1.0, (value - middle) / half)))
    degree = int(np.clip(np.log(spread) / max(place(top) - place(values[wanted - 1]), 1e-3), 2, MAX_DEGREE))

    def shifted(x: np.ndarray) -> np.ndarray:
        y = times(x) - middle * x
        return y - locked @ (locked.T @ y)

    # Scaled by its value at the largest eigenvalue, so that nothing overflows.
    scale = first = half / max(top - middle, half)
    old, new = new, shifted(new) * (scale / half)
    for _ in range(degree - 1):
        later = 1 / (2 / first - scale)
        old, new = new, shifted(new) * (2 * later / half) - (scale * later) * old
        scale = later
    return new


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of ``rows`` (vec_id, x), as integer_rows gives them; None without rows.

    It is fitted on the distinct vectors of the commonest length (the longer one of two that
    are as common). There are no components beyond the rank: a single vector has none.
    """
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if not first:
        return None
    covariance = Covariance(rows.filter(F.size("x") == first.d).select("x").distinct(), first.d)
    trace = covariance.trace()
    values, vectors, residual = np.zeros(0), np.zeros((first.d, 0)), 0.0
    if trace > 0:
        values, vectors, residual = subspace(covariance.times, first.d, min(components, first.d))
        real = values > 1e-12 * values[0]
        values, vectors = values[real], vectors[:, real]
    # Either sign is right; the largest entry is made positive, so that reruns agree.
    tops = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[tops, np.arange(len(tops))])
    found = Whitening(
        covariance.n, covariance.mean, covariance.rest, vectors, values, trace, residual, covariance.passes
    )
    if len(values):
        error = covariance.of_projected(found.axes) - np.eye(len(values))
        found.identity_error = float(np.abs(error).max())
        found.passes = covariance.passes
    return found


def deviations(x: np.ndarray, mean: np.ndarray, rest: np.ndarray, n: int) -> list[int | None]:
    """Per row the exact sum of (n x - S) ** 2; None where it is beyond a long."""
    y = x - mean
    most = n * (int(np.abs(y).max(initial=0)) + 1)
    if x.shape[1] * most * most < 1 << 63:
        return np.square(n * y - rest).sum(axis=1).tolist()
    whole = y.astype(object) * n - rest.astype(object)
    return [s if s < 1 << 63 else None for s in (whole * whole).sum(axis=1)]


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """A row for each of ``rows`` (vec_id, x) of the model's length and each component.

    ``(vec_id, component, n, deviation, whitened, explained, identity_error)``; repeated rows
    and ids stay apart, a null id stays null.
    """
    count, dimension = len(model.values), len(model.mean)
    shared = rows.sparkSession.sparkContext.broadcast(
        (model.mean, model.rest, model.n, model.axes, model.values / model.trace if count else model.values)
    )
    schema = rows.select(
        "vec_id",
        F.lit(0).alias("component"),
        F.lit(0).cast("long").alias("n"),
        F.expr("cast(null as bigint)").alias("deviation"),
        *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")],
    ).schema
    error = model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mean, rest, n, axes, shares = shared.value
        centre = _centre(mean, rest, n)
        for batch in batches:
            x = _matrix(batch.column(1))
            if not len(x) or not count:
                continue
            every, size = np.repeat(np.arange(len(x)), count), len(x) * count
            columns = [
                batch.column(0).take(pa.array(every)),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                pa.array(np.full(size, n)),
                pa.array(deviations(x, mean, rest, n), pa.int64()).take(pa.array(every)),
                pa.array((centre(x) @ axes).ravel()),
                pa.array(np.tile(shares, len(x))),
                pa.array(np.full(size, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.filter(F.size("x") == dimension).mapInArrow(run, schema)


def whitened(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``whiten`` with a model fitted on the same ``rows``.

    Rows with a null vector or a null or non-finite entry go, as do vectors of another length
    than the commonest one. An empty table gives no rows, nor do vectors that are all equal.
    """
    read = stored(integer_rows(rows, id_col, vec_col), "vectors")
    model = fit(read, components)
    if model is None:
        empty = Whitening(1, np.zeros(1, int), np.zeros(1, int), np.zeros((1, 0)), np.zeros(0), 1.0, 0.0, 0)
        return whiten(read, empty)
    return whiten(read, model)


def op11_chebyshev_whitening(spark, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
