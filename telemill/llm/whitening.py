"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries c become integers floor(256 c); each distinct vector counts once. The covariance is never
built: a pass over the centred vectors multiplies it with a block of columns, partition by
partition, and only dimensions x columns come back. A round applies a Chebyshev polynomial of the
covariance to the block by its three-term recurrence. The polynomial is small on the unwanted part
of the spectrum and grows steeply above it. Then QR and Rayleigh-Ritz give eigenvalues and
vectors, and rounds go on until residuals certify them: residual over gap bounds a vector's error.
The block is widened when rounds don't end, in the last resort to all dimensions, where
Rayleigh-Ritz is the whole eigenproblem.

Null vectors and vectors with null or non-finite entries are dropped. The dimension is the length
that most of the others have (the larger of two alike); other lengths are dropped as well. An
integer beyond a long is held at the long's end. Repeated rows are returned each by itself.
Directions without variance have no component, so equal vectors only, or none, give no
components and empty arrays. ``deviation`` is exact, and null beyond a long. Only the id and
vector columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import arrow_map, arrow_schema, as_batch, stored

SCALE = 256
EXTRA = 8  # columns of the block beyond the components wanted
DEGREE = 8  # of the polynomial
ROUNDS = 12  # before the block is widened
CERTAIN = 1e-12  # residual over gap
ROUNDING = 64 * np.finfo(float).eps  # residual over the largest eigenvalue that rounding leaves
CELLS = 1 << 20  # numbers handled at a time


@dataclass
class Whitening:
    """Mean as sums over n, eigenvalues (falling), unit eigenvectors as columns, and their certificate."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residuals: np.ndarray
    identity_error: float
    passes: int

    @property
    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def integers(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the usable rows: x holds the integers in as few bytes as the row needs, after
    one byte that says how many each takes. Written once, as fit and result both read it."""
    rows = vectors.select(vectors[id_col].alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v")).filter("v IS NOT NULL")
    rows = rows.filter(F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    size = common["size"] if common else 0

    def work(batch):
        flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
        with np.errstate(over="ignore"):
            whole = np.clip(np.floor(SCALE * flat), -(2.0**63), 2.0**63 - 1024)
        x = whole.astype(np.int64).reshape(batch.num_rows, size)
        yield {"vec_id": batch.column(0), "x": [_packed(row) for row in x]}

    kind = rows.schema["vec_id"].dataType.simpleString()
    return stored(arrow_map(rows.filter(F.size("v") == size), work, f"vec_id {kind}, x binary"), "integers")


def _packed(row: np.ndarray) -> bytes:
    width = next(w for w in (1, 2, 4, 8) if w == 8 or len(row) == 0 or -(1 << 8 * w - 1) <= row.min() and row.max() < 1 << 8 * w - 1)
    return bytes([width]) + row.astype(f"<i{width}").tobytes()


def _unpacked(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, integers of these rows) for the rows of each width, a bounded number at a time."""
    values = column.to_pylist()
    widths = np.array([v[0] for v in values], np.int64)
    for width in (1, 2, 4, 8):
        own = np.flatnonzero(widths == width)
        step = max(1, CELLS * width // max(1, len(values[own[0]]))) if len(own) else 1
        for at in range(0, len(own), step):
            part = own[at : at + step]
            body = b"".join(values[i][1:] for i in part)
            yield part, np.frombuffer(body, f"<i{width}").reshape(len(part), -1)


def fit_list(rows: DataFrame) -> DataFrame:
    """The distinct vectors, many to a row: (width, x) with the bytes of vectors of one width.

    Copies are dropped before the shuffle and after it; only distinct vectors move.
    """
    def work(batch):
        parts = [(x.dtype.itemsize, np.ascontiguousarray(x).tobytes()) for _, x in _unpacked(batch.column(0))]
        yield {"width": [w for w, _ in parts], "x": [b for _, b in parts]}

    return stored(arrow_map(rows.select("x").distinct(), work, "width int, x binary"), "fit-list")


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for width, body in zip(batch.column(0), batch.column(1)):
            yield np.frombuffer(body.as_buffer(), f"<i{width.as_py()}").reshape(-1, size)


def _totals(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number and exact sums per dimension of the fit list."""
    fields = arrow_schema("place int, n long, total string")

    def run(batches):
        n, total = 0, [0] * size
        for x in _blocks(batches, size):
            n += len(x)
            own = x.sum(axis=0, dtype=np.int64) if x.dtype.itemsize < 8 else x.astype(object).sum(axis=0)
            total = [a + int(b) for a, b in zip(total, own)]
        yield as_batch({"place": range(size), "n": [n] * size, "total": list(map(str, total))}, fields)

    parts = fit.mapInArrow(run, "place int, n long, total string").groupBy("place")
    rows = parts.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # one per dimension
    sums = {r["place"]: int(r["total"]) for r in rows}
    return (rows[0]["n"], [sums[i] for i in range(size)]) if rows else (0, [0] * size)


class Passes:
    """Products over the centred fit list; ``count`` tells how many passes were made."""

    def __init__(self, fit: DataFrame, n: int, sums: list[int]):
        self.fit, self.n, self.size, self.count = fit, n, len(sums), 0
        self.mean = np.array([s / n for s in sums])

    def _summed(self, work, height: int, width: int) -> np.ndarray:
        """The sum over all blocks of a height x width matrix that ``work`` makes of centred vectors."""
        size, mean = self.size, self.mean
        schema = "place int, " + ", ".join(f"c{k} double" for k in range(width))
        fields = arrow_schema(schema)

        def run(batches):
            out = np.zeros((height, width))
            for x in _blocks(batches, size):
                out += work(x - mean)
            yield as_batch({"place": range(height)} | {f"c{k}": out[:, k] for k in range(width)}, fields)

        rows = self.fit.mapInArrow(run, schema).groupBy("place").agg(*[F.sum(f"c{k}") for k in range(width)]).collect()  # height rows
        self.count += 1
        out = np.zeros((height, width))
        for r in rows:
            out[r[0]] = r[1:]
        return out / self.n

    def product(self, columns: np.ndarray) -> np.ndarray:
        """The covariance times the columns."""
        return self._summed(lambda x: x.T @ (x @ columns), self.size, columns.shape[1])

    def trace(self) -> float:
        return float(self._summed(lambda x: (x * x).sum(axis=0)[:, None], self.size, 1).sum())

    def identity_error(self, matrix: np.ndarray) -> float:
        """How far the covariance of the projected vectors is from the identity."""
        k = matrix.shape[1]
        if not k:
            return 0.0
        both = self._summed(lambda x: np.vstack(((p := x @ matrix).T @ p, p.sum(axis=0))), k + 1, k)
        return float(np.abs(both[:k] - np.outer(both[k], both[k]) - np.eye(k)).max())


def filtered(passes: Passes, block: np.ndarray, times: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of the covariance times the block, damping [low, high], scaled at ``top``.

    ``times`` is the covariance times the block, known already.
    """
    half, middle = (high - low) / 2, (high + low) / 2
    first = last = half / (top - middle)
    before, now = block, (times - middle * block) * (first / half)
    for _ in range(degree - 1):
        scale = 1 / (2 / first - last)
        before, now = now, 2 * (passes.product(now) - middle * now) * (scale / half) - last * scale * before
        last = scale
    return now


def eigenpairs(passes: Passes, wanted: int, trace: float, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, their vectors and residuals, certified."""
    d, draw = passes.size, np.random.default_rng(seed)
    width = min(d, wanted + EXTRA)
    block = np.linalg.qr(draw.standard_normal((d, width)))[0]
    rounds = 0
    while True:
        times = passes.product(block)
        small = block.T @ times
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, times = block @ turn, times @ turn
        residuals = np.linalg.norm(times - block * values, axis=0)[:wanted]
        apart = np.abs(values[:wanted, None] - values[None, :])
        apart[np.arange(wanted), np.arange(wanted)] = np.inf
        certain = residuals <= np.maximum(CERTAIN * apart.min(axis=1), ROUNDING * max(values[0], 0.0))
        if certain.all() or width == d:
            return values[:wanted], block[:, :wanted], residuals
        rounds += 1
        if rounds % ROUNDS == 0:
            width = d if 2 * width >= d else 2 * width
            block = np.linalg.qr(np.hstack((block, draw.standard_normal((d, width - block.shape[1])))))[0]
            continue
        high = float(np.clip(values[-1], trace * 1e-15, values[0] / 2 if values[-1] >= values[0] else values[-1]))
        block = np.linalg.qr(filtered(passes, block, times, 0.0, high, values[0], DEGREE))[0]


def fit(rows: DataFrame, components: int = 4) -> Whitening | None:
    """Learn from the rows of ``integers``; None without rows."""
    one = rows.select((F.length("x") - 1).alias("bytes"), F.ascii(F.substring("x", 1, 1).cast("string")).alias("width")).first()
    if one is None:
        return None
    size = one["bytes"] // one["width"]
    if size == 0:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, np.zeros(0), 0.0, 0)
    distinct = fit_list(rows)
    n, sums = _totals(distinct, size)
    passes = Passes(distinct, n, sums)
    trace = passes.trace()
    values, vectors, residuals = np.zeros(0), np.zeros((size, 0)), np.zeros(0)
    if trace > 0:
        values, vectors, residuals = eigenpairs(passes, min(components, size), trace)
        own = values > trace * 1e-12 * size  # beyond rounding
        values, vectors, residuals = values[own], vectors[:, own], residuals[own]
    error = passes.identity_error(vectors / np.sqrt(values))
    return Whitening(n, sums, values, vectors, trace, residuals, error, passes.count)


def whiten(rows: DataFrame, model: Whitening | None) -> DataFrame:
    """(vec_id, deviation, whitened) for every row of ``integers``, in one pass."""
    n, sums, matrix = (model.n, model.sums, model.matrix) if model else (0, [], np.zeros((0, 0)))
    mean = np.array([s / n for s in sums]) if n else np.zeros(len(sums))
    most = max(map(abs, sums), default=0)

    def deviations(x: np.ndarray) -> list[int | None]:
        reach = n * int(np.abs(x.astype(np.float64)).max(initial=0.0) + 1) + most
        if reach * reach * max(1, len(sums)) < 1 << 62:
            off = x.astype(np.int64) * n - np.array(sums, np.int64)
            return (off * off).sum(axis=1).tolist()
        exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def work(batch):
        deviation, white = [0] * batch.num_rows, [[]] * batch.num_rows
        for own, x in _unpacked(batch.column(1)) if sums else ():
            for i, v, w in zip(own, deviations(x), ((x - mean) @ matrix).tolist()):
                deviation[i], white[i] = v, w
        yield {"vec_id": batch.column(0), "deviation": deviation, "whitened": white}

    kind = rows.schema["vec_id"].dataType.simpleString()
    return arrow_map(rows, work, f"vec_id {kind}, deviation long, whitened array<double>")
