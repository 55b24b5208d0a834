"""Embedding whitening: float32 eigenvectors of a distributed covariance, refined by products in higher precision."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

#: An entry c becomes the whole number floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
#: Whole numbers from here on are not taken, so that differences of two fit a long.
TOO_LARGE = float(1 << 61)
#: Partial sums of tasks that are added up in one group.
PARTS = 64
#: Rounds of refinement at most; each squares the error, so three are usual.
ROUNDS = 10
#: Rows that are handed out at once, each as often as there are components.
_OUT_ROWS = 4_096


# ---- eigenvectors --------------------------------------------------------

def _slices(m: np.ndarray, axis: int, bits: int) -> list[np.ndarray]:
    """`m` as a sum of double matrices whose entries have `bits` bits below the largest along `axis`."""
    out = []
    for _ in range(-(-64 // bits)):
        top = np.abs(m).max(axis=axis, keepdims=True)
        if not top.any():
            break
        unit = np.ldexp(np.longdouble(1), np.frexp(top)[1] - bits)
        part = np.rint(m / unit) * unit
        out.append(part.astype(np.float64))
        m = m - part
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b to extended precision, from double products without rounding.

    Both sides are cut into slices so short that a sum of products of two
    slices is exact in double; the slices' products are added in extended precision.
    """
    bits = (52 - int(a.shape[1]).bit_length()) // 2
    left, right = _slices(a, 1, bits), _slices(b, 0, bits)
    total = np.zeros((a.shape[0], b.shape[1]), np.longdouble)
    for at in range(len(left) + len(right) - 2, -1, -1):  # small ones first
        for i in range(max(0, at - len(right) + 1), min(at, len(left) - 1) + 1):
            total += left[i] @ right[at - i]
    return total


def _clusters(values: np.ndarray, close: float) -> list[slice]:
    """Runs of two or more falling values that follow each other within `close`."""
    starts = np.flatnonzero(np.append(True, values[:-1] - values[1:] > close))
    ends = np.append(starts[1:], len(values))
    return [slice(i, j) for i, j in zip(starts.tolist(), ends.tolist()) if j - i > 1]


def refined(a: np.ndarray, x: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, int]:
    """Eigenvalues of symmetric `a`, falling, its eigenvectors near the columns of `x`, and the rounds it took.

    The iteration of Ogita and Aishima: with R = I - X'X and S = X'AX, X grows
    by XE, where E follows from R, S and the differences of the
    eigenvalues, and the error is squared.  Where eigenvalues are nearer to
    each other than what S and R leave open, E only makes the vectors orthogonal;
    the vectors of such a cluster are then turned among themselves by the
    eigenvectors of A - mu I on the space they span.  That
    problem is small and its numbers are as small as the cluster is wide, so
    double precision tells apart what the first solution could not.
    """
    size = len(a)
    scale = np.abs(a).max()
    a = a / scale
    x = x.astype(np.longdouble)
    values = np.zeros(size, np.longdouble)
    took, before = 0, np.inf
    for took in range(1, rounds + 1):
        r = np.eye(size) - product(x.T, x)
        s = product(x.T, product(a, x))
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, values, r, s = x[:, order], values[order], r[np.ix_(order, order)], s[np.ix_(order, order)]
        left = 2 * (np.linalg.norm((s - np.diag(values)).astype(np.float64), 2)
                    + np.abs(values).max() * np.linalg.norm(r.astype(np.float64), 2))
        close = max(left, size * 2.0 ** -60)
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= close
        x = x + product(x, np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap)))
        if left < size * 2.0 ** -58 or took > 3 and left > before / 2:
            break  # what is left is rounding
        before = left
        for group in _clusters(values, close):
            part = x[:, group]
            inner = product(part.T, product(a, part) - values[group].mean() * part)
            top = max(np.abs(inner).max(), np.finfo(np.float64).tiny)
            turn = np.linalg.eigh(((inner + inner.T) / (2 * top)).astype(np.float64))[1][:, ::-1]
            x[:, group] = product(part, turn.astype(np.longdouble))
    return values * scale, x, took


def eigenvectors(covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and unit eigenvectors, as columns, in double precision.

    The first solution is one in float32.  The largest entry of a vector is positive.
    """
    a = covariance.astype(np.longdouble)
    top = np.abs(a).max() if a.size else 0
    if not top:
        return np.zeros(len(a)), np.eye(len(a))
    first = np.linalg.eigh((a / top).astype(np.float32))[1][:, ::-1]
    values, x, _ = refined(a, first)
    order = np.argsort(-values, kind="stable")
    values, x = values[order], x[:, order]
    x = x * np.sign(x[np.abs(x).argmax(0), np.arange(len(a))])
    return values.astype(np.float64), x.astype(np.float64)


# ---- the table -----------------------------------------------------------

def _usable(lists: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are vectors of `width` finite entries that fit, and those as whole numbers."""
    lists = lists.cast(pa.list_(pa.float64()))
    right = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False) == width
    flat = lists.filter(pa.array(right)).flatten().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(flat.reshape(-1, width) * SCALE)
        fits = (np.abs(scaled) < TOO_LARGE).all(1)
    right[right] = fits
    return right, scaled[fits].astype(np.int64) + SHIFT


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per width that occurs: number of vectors and sums per dimension."""
    found: dict[int, list] = {}
    for batch in batches:
        lists = batch.column(0)
        widths = pc.unique(pc.list_value_length(lists)).to_pylist()
        for width in [w for w in widths if w]:
            _, x = _usable(lists, width)
            n, sums = found.setdefault(width, [0, [0] * width])
            # Whole numbers of any size: high and low halves are added apart.
            high, low = (x >> 31).sum(0).tolist(), (x & (1 << 31) - 1).sum(0).tolist()
            found[width] = [n + len(x), [s + (h << 31) + l for s, h, l in zip(sums, high, low)]]
    for width, (n, sums) in found.items():
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([width] * width, pa.int32()), pa.array(range(width), pa.int32()),
                 pa.array([n] * width, pa.int64()), pa.array(map(Decimal, sums), pa.decimal128(38, 0))],
                names=["width", "place", "n", "total"])


@dataclass
class Centre:
    """Number and sums of the vectors, and their mean as a whole number and a rest."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.whole = np.array([round(Fraction(s, self.n)) for s in self.sums], np.int64)
        self.rest = np.array([float(Fraction(s, self.n) - int(w)) for s, w in zip(self.sums, self.whole)])

    @property
    def width(self) -> int:
        return len(self.sums)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n; the large parts cancel as whole numbers."""
        return (x - self.whole).astype(np.float64) - self.rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over the dimensions of (n x - S) squared, exact whatever the size."""
        shift = np.array([self.n * int(w) - s for w, s in zip(self.whole, self.sums)], object)
        apart = x - self.whole
        largest = (int(np.abs(apart).max(initial=0)) + 1) * self.n
        if self.width * largest * largest < 1 << 63:
            return ((apart * self.n + shift.astype(np.int64)) ** 2).sum(1).tolist()
        return ((apart.astype(object) * self.n + shift) ** 2).sum(1).tolist()


def fit_centre(vectors: DataFrame) -> Centre | None:
    """Number and sums over the vectors of the commonest width; None without any."""
    parts = vectors.mapInArrow(_sums, "width int, place int, n long, total decimal(38,0)")
    added = parts.groupBy("width", "place").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total"))
    # One row per dimension and width; the first place of a width tells how common it is.
    common = added.where("place = 0").orderBy(F.desc("n"), F.desc("width")).select("width", "n").first()
    if common is None:
        return None
    rows = added.where(F.col("width") == common.width).select("place", "total").collect()
    return Centre(common.n, [int(r.total) for r in sorted(rows, key=lambda r: r.place)])


def _added(rows: pa.Table) -> pa.Table:
    """The rows of one group as one: the sum of their values, in order of their parts."""
    rows = rows.sort_by("part")
    values = np.stack([v.values.to_numpy() for v in rows.column("values").combine_chunks()])
    return pa.table({"row": rows.column("row").slice(0, 1), "part": pa.array([int(rows.column("part")[0].as_py()) % PARTS], pa.int64()),
                     "values": pa.array([values.sum(0)], pa.list_(pa.float64()))})


def moments(vectors: DataFrame, centre: Centre, matrix: np.ndarray | None = None) -> np.ndarray:
    """Covariance, with divisor n, of the centred vectors, or of their products with `matrix`.

    Vectors are centred before they are multiplied.  A task adds up one
    matrix; the matrices of all tasks are added row by row by Spark, in two steps, so that
    no group holds more than a share of the tasks.  The driver gets the one sum.
    """
    size = (centre.width if matrix is None else matrix.shape[1]) + 1

    def each(batches):
        total = np.zeros((size, size))
        for batch in batches:
            y = centre.centred(_usable(batch.column(0), centre.width)[1])
            y = y if matrix is None else y @ matrix
            y = np.hstack([y, np.ones((len(y), 1))])
            total += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array([TaskContext.get().partitionId()] * size, pa.int64()),
             pa.array(list(total), pa.list_(pa.float64()))], names=["row", "part", "values"])

    schema = "row int, part long, values array<double>"
    parts = vectors.mapInArrow(each, schema)
    some = parts.groupBy("row", F.expr(f"part % {PARTS}").alias("_share")).applyInArrow(lambda rows: _added(rows), schema)
    added = some.groupBy("row").applyInArrow(lambda rows: _added(rows), schema).toArrow().sort_by("row")
    total = np.stack([v.values.to_numpy() for v in added.column("values").combine_chunks()]).astype(np.longdouble) / centre.n
    # What rounding has left of the mean.
    mean = total[-1, :-1]
    return total[:-1, :-1] - np.outer(mean, mean)


def whiten(table: DataFrame, vector: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error of every usable row and component.

    Entries become the whole numbers x = floor(64 c) + 1000000.  Rows whose vector
    is null or empty, holds null, non-finite or entries of 2**55 and more, or has
    another width than most rows (of equally common widths the larger counts) are
    left out; so a table may be empty or give no row.  Repeated rows, and rows without a
    key, are rows like others.  `deviation` is a decimal of 38 places, null if it needs more.

    The covariance V is summed by Spark; its eigenvectors are found on the
    driver, which gets width x width numbers, whatever the rows.  A component
    without variance (its value is rounding alone) has whitened null and explained 0;
    without any variance explained and identity_error are null.
    identity_error is measured on the whitened rows in a pass of its own.
    """
    spark = table.sparkSession
    rows = table.select(F.col(key).alias("key"), F.col(vector).cast("array<double>").alias("vector"))
    schema = (f"`{key}` {rows.schema['key'].dataType.simpleString()}, component int, n long, deviation decimal(38,0), "
              "whitened double, explained double, identity_error double")
    vectors = rows.select("vector")
    centre = fit_centre(vectors)
    if centre is None:
        return spark.createDataFrame([], schema)
    covariance = moments(vectors, centre)
    values, x = eigenvectors(covariance)
    values, x = values[:components], x[:, :components]
    trace = float(np.trace(covariance))
    varied = values > trace * centre.width * 2.0 ** -52
    matrix = x / np.sqrt(np.where(varied, values, 1))
    error = None
    if varied.any():
        identity = moments(vectors, centre, matrix[:, varied])
        error = float(np.abs(identity - np.eye(int(varied.sum()))).max())
    explained = [float(v) / trace if ok else 0.0 for v, ok in zip(values, varied)] if trace > 0 else [None] * len(values)
    width, names = len(values), [key, "component", "n", "deviation", "whitened", "explained", "identity_error"]

    def each(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, _OUT_ROWS):
                batch = whole.slice(at, _OUT_ROWS)
                usable, found = _usable(batch.column(1), centre.width)
                rows = len(found)
                z = centre.centred(found) @ matrix
                deviations = [Decimal(d) if d < 10 ** 38 else None for d in centre.deviations(found)]
                again = pa.array(np.repeat(np.arange(rows), width))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).filter(pa.array(usable)).take(again),
                     pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), rows)),
                     pa.array(np.full(rows * width, centre.n, np.int64)),
                     pa.array(deviations, pa.decimal128(38, 0)).take(again),
                     pa.array(z.ravel(), pa.float64(), mask=np.tile(~varied, rows)),
                     pa.array(explained * rows, pa.float64()),
                     pa.array([error] * (rows * width), pa.float64())], names=names)

    return rows.mapInArrow(each, schema)
