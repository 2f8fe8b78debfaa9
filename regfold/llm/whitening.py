"""Embedding whitening from polarised covariances (operator 11).

Each entry c becomes the integer x = floor(64 c) + 1000000. The covariance of two dimensions is never a sum of
products. By polarisation, 2 cov(i, j) = var(i + j) - var(i) - var(j), so a pass adds up squares only: one sum for
every dimension and one for every sum of two dimensions. All of it is exact integer arithmetic:

  * first pass: n and the sums S, hence m, the integer nearest to S / n, and the rest r = S - n m;
  * second pass: Q, the sums of (x_i - m_i)^2 and of ((x_i - m_i) + (x_j - m_j))^2. The values are centred
    before they are squared, to within half a unit; what is left is exact too, as
    sum (n x - S)^2 = n^2 sum (x - m)^2 - n r^2, for a dimension and for a sum of two alike.

The D (D + 1) / 2 exact sums give the covariance matrix, each entry rounded once, and ``eigh`` its components. Two more
passes project the exactly centred vectors: one measures the covariance of what comes out, one writes it. Only
matrices of D x D numbers reach the driver, whatever the number of vectors.

Cases: rows whose vector is null or empty or holds null or non-finite components are dropped. Vectors of another length
are another space: every length is fitted by itself, with its own n (their number is taken to be small). A
component without variance has whitened values null and is left out of ``identity_error``. Entries beyond 2^40 / 64 in
size count as that bound, so that all sums fit 38 digits. Ids may be null or repeat: every row counts. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regfold.llm.common import map_batches

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
LARGEST = 1 << 40  # of an entry times SCALE
ROWS = 1024  # vectors handled at once
DECIMAL = pa.decimal128(38, 0)


@dataclass
class Space:
    """What is known of the vectors of one length."""

    n: int
    centre: np.ndarray  # m
    rest: list[int]  # r = S - n m
    total: float = 0.0  # trace of the covariance
    values: np.ndarray | None = None  # eigenvalues, falling
    vectors: np.ndarray | None = None  # one component a column
    error: float | None = None  # of the whitened values' covariance against the identity

    def projected(self, d: np.ndarray) -> np.ndarray:
        """Whitened values of centred integers ``d``; nan for components without variance."""
        centred = d - np.array([r / self.n for r in self.rest])
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, centred @ self.vectors / np.sqrt(self.values), np.nan)

    def deviations(self, d: np.ndarray) -> list[int]:
        """Sum over dimensions of (n x - S)^2, exact."""
        largest = self.n * (int(np.abs(d).max(initial=0)) + 1)
        if largest * largest * max(1, d.shape[1]) < 2**63:
            y = self.n * d - np.array(self.rest, dtype=np.int64)
            return (y * y).sum(axis=1).tolist()
        rest = np.array(self.rest, dtype=object)
        return [int(((self.n * row.astype(object) - rest) ** 2).sum()) for row in d]


def _usable(vectors: DataFrame) -> DataFrame:
    value = F.col("embedding")
    bad = F.exists(value, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return vectors.filter(value.isNotNull() & (F.size(value) > 0) & ~bad).select(
        "vec_id", value.cast("array<double>").alias("vector"))


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integers x of at most ``ROWS`` vectors of one length at a time."""
    for batch in batches:
        lists = batch.column(1)
        size = np.diff(lists.offsets.to_numpy())
        for dim in np.unique(size):
            members = np.flatnonzero(size == dim)
            for a in range(0, len(members), ROWS):
                own = pa.array(members[a : a + ROWS])
                c = lists.take(own).flatten().to_numpy().reshape(-1, int(dim))
                x = np.floor(np.clip(c, -LARGEST / SCALE, LARGEST / SCALE) * SCALE).astype(np.int64) + OFFSET
                yield batch.column(0).take(own), x


def _exact_sum(squares: np.ndarray) -> np.ndarray:
    """Column sums of squares, exact; Python integers where 64 bits could overflow."""
    return (squares * squares).sum(axis=0) if int(np.abs(squares).max(initial=0)) ** 2 * len(squares) < 2**63 else (
        squares.astype(object) ** 2).sum(axis=0)


def _records(totals: dict[tuple, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Rows (dim, i, j, n, total) of sums kept as {(dim, i): (n, sums for j = i, i + 1, ...)}."""
    for (dim, i), (n, sums) in totals.items():
        k = len(sums)
        yield pa.record_batch([pa.array([dim] * k, pa.int32()), pa.array([i] * k, pa.int32()),
                               pa.array(range(i, i + k), pa.int32()), pa.array([n] * k, pa.int64()),
                               pa.array([int(v) for v in sums], DECIMAL)], names=["dim", "i", "j", "n", "total"])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length: number of vectors and the sum of each dimension."""
    totals: dict[tuple, tuple] = {}
    for _, x in _integers(batches):
        key = (x.shape[1], 0)
        n, sums = totals.get(key, (0, np.zeros(x.shape[1], dtype=object)))
        totals[key] = (n + len(x), sums + x.sum(axis=0))
    yield from _records(totals)


def _squares(batches: Iterator[pa.RecordBatch], spaces: dict[int, Space]) -> Iterator[pa.RecordBatch]:
    """Per length: sums of squares of each centred dimension (j = i) and of each sum of two."""
    totals: dict[tuple, tuple] = {}
    for _, x in _integers(batches):
        dim = x.shape[1]
        d = x - spaces[dim].centre
        for i in range(dim):
            pairs = d[:, i:] + d[:, i : i + 1]
            pairs[:, 0] = d[:, i]
            n, sums = totals.get((dim, i), (0, np.zeros(dim - i, dtype=object)))
            totals[dim, i] = (n + len(x), sums + _exact_sum(pairs))
    yield from _records(totals)


def _moments(batches: Iterator[pa.RecordBatch], spaces: dict[int, Space]) -> Iterator[pa.RecordBatch]:
    """Per length: sums and sums of products of the whitened values, which have mean 0 but for rounding."""
    totals: dict[int, np.ndarray] = {}
    for _, x in _integers(batches):
        dim = x.shape[1]
        w = spaces[dim].projected(x - spaces[dim].centre)
        w = np.column_stack([np.ones(len(w)), w])
        totals[dim] = totals.get(dim, 0.0) + w.T @ w
    for dim, m in totals.items():
        i, j = np.triu_indices(len(m))
        yield pa.record_batch([pa.array(np.full(len(i), dim), pa.int32()), pa.array(i, pa.int32()),
                               pa.array(j, pa.int32()), pa.array(m[i, j], pa.float64())],
                              names=["dim", "i", "j", "total"])


def _write(batches: Iterator[pa.RecordBatch], spaces: dict[int, Space], out: int) -> Iterator[pa.RecordBatch]:
    for ids, x in _integers(batches):
        space = spaces[x.shape[1]]
        d = x - space.centre
        w = space.projected(d)[:, :out]
        k, n = w.shape[1], len(w)
        share = space.values[:k] / space.total if space.total else np.full(k, np.nan)
        offsets = pa.array(np.arange(n + 1) * k, pa.int32())

        def lists(v: np.ndarray, offsets: pa.Array = offsets) -> pa.Array:
            return pa.ListArray.from_arrays(offsets, pa.array(v.ravel(), pa.float64(), mask=np.isnan(v.ravel())))

        yield pa.record_batch(
            [ids, pa.array([x.shape[1]] * n, pa.int32()), pa.array([space.n] * n, pa.int64()),
             pa.array(space.deviations(d), DECIMAL), lists(w), lists(np.tile(share, (n, 1))),
             pa.array([space.error] * n, pa.float64())],
            names=["vec_id", "dim", "n", "deviation", "whitened", "explained", "identity_error"])


def _total(src: DataFrame, fn: Callable, total: str) -> dict[int, list]:
    """Partial sums of every task added up by Spark: {dim: rows}. A row per dimension or pair reaches the driver."""
    schema = "dim int, i int, j int, " + ("n long, " if total != "double" else "") + f"total {total}"
    keep = [F.sum("n").alias("n")] if total != "double" else []
    out: dict[int, list] = {}
    for r in map_batches(src, fn, schema).groupBy("dim", "i", "j").agg(*keep, F.sum("total").alias("total")).collect():
        out.setdefault(r["dim"], []).append(r)
    return out


def covariance(space: Space, sums: list, dim: int) -> np.ndarray:
    """The covariance matrix, every entry from exact integers and rounded once."""
    n, r = space.n, space.rest
    square = {(s["i"], s["j"]): int(s["total"]) for s in sums}
    # n^3 times the variance of a dimension or of the sum of two
    var = {(i, j): n * n * q - n * (r[i] if i == j else r[i] + r[j]) ** 2 for (i, j), q in square.items()}
    out = np.empty((dim, dim))
    for i, j in var:
        out[i, j] = out[j, i] = (var[i, i] / n**3 if i == j else (var[i, j] - var[i, i] - var[j, j]) / (2 * n**3))
    return out


def fit(vectors: DataFrame, components: int = COMPONENTS) -> dict[int, Space]:
    """What whitens the vectors of each length; measured on all of them."""
    src = _usable(vectors)
    spaces = {}
    for dim, rows in _total(src, _sums, "decimal(38,0)").items():
        sums = [int(r["total"]) for r in sorted(rows, key=lambda r: r["j"])]
        n = rows[0]["n"]
        centre = [(2 * s + n) // (2 * n) for s in sums]
        spaces[dim] = Space(n, np.array(centre, dtype=np.int64), [s - n * m for s, m in zip(sums, centre, strict=True)])
    for dim, rows in _total(src, lambda it: _squares(it, spaces), "decimal(38,0)").items():
        cov = covariance(spaces[dim], rows, dim)
        values, vectors_ = np.linalg.eigh(cov)
        values, vectors_ = values[::-1], vectors_[:, ::-1]
        sign = np.sign(vectors_[np.abs(vectors_).argmax(axis=0), np.arange(dim)])
        spaces[dim].total = float(np.trace(cov))
        noise = dim * np.finfo(float).eps * max(0.0, float(values[0]))
        spaces[dim].values = np.where(values > noise, values, 0.0)[:components]
        spaces[dim].vectors = (vectors_ * sign)[:, :components]
    for dim, rows in _total(src, lambda it: _moments(it, spaces), "double").items():
        space = spaces[dim]
        m = np.zeros((len(space.values) + 1,) * 2)
        for r in rows:
            m[r["i"], r["j"]] = m[r["j"], r["i"]] = r["total"] / space.n
        cov = m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:])
        live = np.flatnonzero(space.values > 0)
        if len(live):
            space.error = float(np.abs(cov[np.ix_(live, live)] - np.eye(len(live))).max())
    return spaces


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, dim, n, deviation decimal(38,0), whitened and explained (an entry per component) and identity_error."""
    spaces = fit(vectors, components)
    kind = dict(vectors.dtypes)["vec_id"]
    return map_batches(_usable(vectors), lambda it: _write(it, spaces, components),
                       f"vec_id {kind}, dim int, n long, deviation decimal(38,0), whitened array<double>, "
                       "explained array<double>, identity_error double")
