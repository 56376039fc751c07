"""Whitening of embeddings by hierarchical merging of singular value decompositions.

Each partition decomposes its centred vectors and keeps all singular values and right vectors, the number of vectors and
their exact sums. Two such states are merged by stacking both, scaled by their singular values, with one row more that
corrects for the difference of the means, and decomposing the stack again. Nothing is truncated, so the last state has
the decomposition of all vectors. A state is as large as the square of the number of dimensions, whatever the input.
"""

from __future__ import annotations

from decimal import Decimal
from fractions import Fraction
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftvault.llm.common import column, stage

#: Entries become whole numbers of 1 / SCALE, rounded down.
SCALE = 256
#: States that are merged in one task.
FAN_IN = 8
#: Entries of a block that is decomposed at once.
BLOCK_ENTRIES = 1 << 22
_STATE = "part long, n long, sums array<decimal(38,0)>, singular array<double>, vectors array<double>"
_STATE_ARROW = pa.schema([
    ("part", pa.int64()), ("n", pa.int64()), ("sums", pa.list_(pa.decimal128(38, 0))), ("singular", pa.list_(pa.float64())), ("vectors", pa.list_(pa.float64())),
])
_MOST = 2**63 - 1


class State(NamedTuple):
    """n vectors with exact sums; singular values and right vectors of the vectors less their mean."""

    n: int
    sums: list[int]
    singular: np.ndarray
    vectors: np.ndarray

    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def row(self, part: int) -> pa.RecordBatch:
        values = [[part], [self.n], [[Decimal(s) for s in self.sums]], [self.singular.tolist()], [self.vectors.ravel().tolist()]]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _STATE_ARROW)], schema=_STATE_ARROW)

    @staticmethod
    def read(row: dict) -> State:
        singular = np.array(row["singular"], float)
        return State(row["n"], [int(s) for s in row["sums"]], singular, np.array(row["vectors"], float).reshape(len(singular), -1))


def exact_sums(x: np.ndarray) -> list[int]:
    """The sums of whole numbers by column, whatever their size."""
    small = not x.size or int(np.abs(x.astype(float)).max()) < _MOST // (2 * len(x))
    return [int(s) for s in (x if small else x.astype(object)).sum(axis=0)]


def decomposed(x: np.ndarray) -> State:
    """The state of the rows of a matrix of whole numbers."""
    sums = exact_sums(x)
    _, singular, vectors = np.linalg.svd(x - np.array([s / len(x) for s in sums]), full_matrices=False)
    return State(len(x), sums, singular, vectors)


def merged(a: State, b: State) -> State:
    """The state of the vectors of both. Beside the two it takes one row: the difference of the means, which is exact
    until it is rounded once, times the root of n_a n_b / (n_a + n_b)."""
    apart = [float(Fraction(p * b.n - q * a.n, a.n * b.n)) for p, q in zip(a.sums, b.sums)]
    correction = np.array([apart]) * (a.n * b.n / (a.n + b.n)) ** 0.5
    stacked = np.vstack([a.singular[:, None] * a.vectors, b.singular[:, None] * b.vectors, correction])
    _, singular, vectors = np.linalg.svd(stacked, full_matrices=False)
    return State(a.n + b.n, [p + q for p, q in zip(a.sums, b.sums)], singular, vectors)


def merged_all(states: list[State]) -> State:
    """States merged in pairs, round by round."""
    while len(states) > 1:
        states = [merged(*states[i : i + 2]) if i + 1 < len(states) else states[i] for i in range(0, len(states), 2)]
    return states[0]


def whole_numbers(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """vec_id and x, the vector in whole numbers, of the rows whose vector has neither null nor non-finite entries."""
    c = column(vector)
    sound = c.isNotNull() & F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    x = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE).cast("long"))
    return embeddings.filter(sound).select("vec_id", x.alias("x"))


def _padded(x: Column, dims: int) -> Column:
    return F.concat(x, F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size(x)))


def matrix(lists: pa.ListArray, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), dims)


def _decompose(dims: int):
    def task(batches):
        state, step = None, max(dims, BLOCK_ENTRIES // dims)
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                block = decomposed(matrix(batch.column(0).slice(at, step), dims))
                state = block if state is None else merged(state, block)
        if state is not None:
            yield state.row(TaskContext.get().partitionId())

    return task


def _merge(table: pa.Table) -> pa.Table:
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    return pa.Table.from_batches([merged_all([State.read(r) for r in rows]).row(rows[0]["part"] // FAN_IN)])


class Whitening(NamedTuple):
    """Where whitening moves and turns vectors to. components: unit vectors, by falling variance; explained: their shares
    of the trace; identity_error: how far the covariance of the whitened fit list is from the identity."""

    n: int
    sums: list[int]
    variances: np.ndarray
    components: np.ndarray
    explained: np.ndarray
    identity_error: float

    def whiten(self, x: np.ndarray) -> np.ndarray:
        return (x - np.array([s / self.n for s in self.sums])) @ (self.components / np.sqrt(self.variances)[:, None]).T


def fit_whitening(fit: DataFrame, components: int = 4) -> Whitening | None:
    """The whitening of a table of distinct vectors x of whole numbers, all of one length; None where there is none.

    States are merged FAN_IN at a time in a tree over partitions. The driver gets one row: the sums and the first
    `components` vectors. Components without variance, as of fewer vectors than components, are left out.
    """
    dims = fit.agg(F.max(F.size("x"))).first()[0]
    if not dims:
        return None
    states = stage(fit.select("x").mapInArrow(_decompose(dims), _STATE), "whitening-states")
    left = states.agg(F.max("part")).first()[0]
    while left:
        states = states.groupBy(F.floor(F.col("part") / FAN_IN).alias("_group")).applyInArrow(_merge, _STATE)
        left //= FAN_IN
    top = stage(states, "whitening-top").select(
        "n", "sums", "singular", F.slice("vectors", 1, components * dims).alias("vectors"), F.aggregate("singular", F.lit(0.0), lambda acc, s: acc + s * s).alias("trace")
    )
    row = top.first()
    singular = np.array(row.singular[:components])
    kept = int((singular > singular[0] * dims * np.finfo(float).eps).sum()) if row.trace > 0 else 0
    singular, vectors = singular[:kept], np.array(row.vectors, float).reshape(-1, dims)[:kept]
    model = Whitening(row.n, [int(s) for s in row.sums], singular**2 / row.n, vectors, singular**2 / row.trace, 0.0) if kept else None
    return model._replace(identity_error=_identity_error(fit, model, dims)) if model else None


def _identity_error(fit: DataFrame, model: Whitening, dims: int) -> float:
    """The largest entry of the whitened vectors' covariance less the identity, measured over the fit list."""
    k = len(model.variances)

    def task(batches):
        sums = np.zeros((k + 1, k))
        for batch in batches:
            z = model.whiten(matrix(batch.column(0), dims))
            sums += np.vstack([z.sum(axis=0)[None, :], z.T @ z])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * (k + 1))), pa.array(sums.ravel())], names=["at", "value"])

    total = fit.select("x").mapInArrow(task, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    sums = np.array([r.value for r in total.orderBy("at").collect()]).reshape(k + 1, k) / model.n
    return float(np.abs(sums[1:] - np.outer(sums[0], sums[0]) - np.eye(k)).max())


_WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
_WHITENED_ARROW = pa.schema([
    ("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64()),
])


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Of each row the exact sum of (n x - sum)^2; None where a long does not hold it."""
    largest = n * int(np.abs(x.astype(float)).max(initial=0)) + max(map(abs, sums))
    small = largest * largest * x.shape[1] < _MOST
    apart = (x if small else x.astype(object)) * n - np.array(sums, np.int64 if small else object)
    return [int(d) if d <= _MOST else None for d in (apart * apart).sum(axis=1)]


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """A row for each row of (vec_id, x) and component: vec_id, component (from 1), n, deviation, whitened, explained,
    identity_error."""
    k, dims = len(model.variances), model.components.shape[1]

    def task(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, m = matrix(batch.column(1), dims), batch.num_rows
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.repeat(pa.scalar(model.n, pa.int64()), m * k),
                pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(each)), pa.array(model.whiten(x).ravel()), pa.array(np.tile(model.explained, m)),
                pa.repeat(pa.scalar(model.identity_error), m * k),
            ], schema=_WHITENED_ARROW)

    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x").mapInArrow(task, _WHITENED)


def whiten_embeddings(embeddings: DataFrame, vector: str = "embedding", components: int = 4) -> DataFrame:
    """A row for each row of embeddings with a sound vector and each of the first components, as `whiten` gives them.

    Rows whose vector is null or holds null or non-finite entries are dropped. Each distinct vector counts once in the
    fit, so rows repeated often change nothing, and are combined before the shuffle. Vectors shorter than the longest
    one end in zeros. A null vec_id stays null, repeated ones have a row each. Components without variance have no
    rows: an empty table, or one distinct vector, gives an empty result. Other columns are not looked at.
    """
    rows = whole_numbers(embeddings, vector)
    fit = stage(rows.select("x").distinct(), "whitening-fit")
    shortest, longest = fit.agg(F.min(F.size("x")), F.max(F.size("x"))).first()
    if shortest != longest:
        rows = rows.select("vec_id", _padded(F.col("x"), longest).alias("x"))
        fit = stage(fit.select(_padded(F.col("x"), longest).alias("x")).distinct(), "whitening-fit")
    model = fit_whitening(fit, components)
    return whiten(rows, model) if model else embeddings.sparkSession.createDataFrame([], _WHITENED)
