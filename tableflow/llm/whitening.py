"""Embedding whitening by spectral divide-and-conquer with QDWH polar decompositions.

Entries become whole numbers x = floor(64 c) + 1000000 (beyond 2^53 either way they stay there), so sums are exact. Two
aggregations over all vectors give their number and sums, then the covariance of the exactly centred entries; only these,
a few numbers for each pair of dimensions, reach the driver. There the polar factor of the covariance less a shift is the
sign of every eigenvalue against it: it gives the projectors on two invariant subspaces, which are split again until
each holds one component or equal eigenvalues alone. The components go to all tasks, which whiten their rows; a further aggregation over
the whitened rows measures how far their covariance is from the identity.

Vectors that are null or empty, or hold null or non-finite entries, are dropped, and so are those of another length than most (of
lengths as frequent the greatest). Rows without an id and repeated rows take part, each by itself. A component without variance
(its eigenvalue is not above the rounding of the largest) has whitened 0 and takes no part in identity_error; where nothing varies, explained is 0. Components
of equal eigenvalues are some orthonormal basis of theirs. An empty table gives an empty result; other columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
_EPS = np.finfo(float).eps
#: Sums are kept in two parts of so many bits, so that neither overflows.
_LOW = 26


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley steps."""
    m = len(a)
    x = a / max(np.abs(a).sum(axis=1).max(), np.finfo(float).tiny)
    r = np.linalg.qr(x, mode="r")
    try:
        low = 1 / (np.linalg.norm(np.linalg.inv(r), 1) * np.sqrt(m))
    except np.linalg.LinAlgError:
        low = _EPS
    low = min(max(low, _EPS), 1.0)
    for _ in range(30):
        s = low * low
        d = np.cbrt(4 * (1 - s) / (s * s))
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(8 - 4 * d + 8 * (2 - s) / (s * root), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        before = x
        if wc > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(m)]))[0]
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:m] @ q[m:].T)
        else:
            inner = np.eye(m) + wc * (x.T @ x)
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(inner, x.T).T
        x = (x + x.T) / 2
        low = min(low * (wa + wb * s) / (1 + wc * s), 1.0)
        if abs(1 - low) < 10 * _EPS and np.linalg.norm(x - before) <= np.cbrt(5 * _EPS):
            break
    return x


def _halves(a: np.ndarray, shift: float, rng: np.random.Generator, tiny: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the subspaces above and below the shift; None if it does not part them cleanly."""
    m = len(a)
    upper = (polar(a - shift * np.eye(m)) + np.eye(m)) / 2
    k = round(float(np.trace(upper)))
    if not 0 < k < m:
        return None
    basis = np.linalg.qr(upper @ rng.standard_normal((m, k)))[0]
    for _ in range(2):
        basis = np.linalg.qr(upper @ basis)[0]
    whole = np.linalg.qr(basis, mode="complete")[0]
    above, below = whole[:, :k], whole[:, k:]
    return (above, below) if np.abs(above.T @ a @ below).max() <= tiny else None


def spectral(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of a symmetric matrix in falling order, and unit eigenvectors in columns."""
    d, rng = len(v), np.random.default_rng(0)
    tiny = 20 * d * _EPS * max(float(np.linalg.norm(v)), np.finfo(float).tiny)
    found: list[np.ndarray] = []
    stack = [np.eye(d)]
    while stack:
        basis = stack.pop()
        a = basis.T @ v @ basis
        a, m = (a + a.T) / 2, len(a)
        if m == 1:
            found.append(basis)
            continue
        diagonal = np.sort(np.diag(a))
        # between the middle entries, then elsewhere: a shift that is an eigenvalue itself parts nothing
        shifts = [(diagonal[(m - 1) // 2] + diagonal[m // 2]) / 2, diagonal.mean(), *(diagonal[1:] + diagonal[:-1]) / 2]
        radius = np.abs(a - np.diag(np.diag(a))).sum(axis=1).max()
        shifts += [diagonal.mean() + f * (diagonal[-1] - diagonal[0] + radius) for f in rng.uniform(-0.5, 0.5, 20)]
        if np.linalg.norm(a - diagonal.mean() * np.eye(m)) <= tiny / 20:
            found.append(basis)  # one eigenvalue, so any basis
            continue
        for shift in shifts:
            if (parts := _halves(a, float(shift), rng, tiny)) is not None:
                stack += [basis @ parts[0], basis @ parts[1]]
                break
        else:
            found.append(basis)  # eigenvalues that no shift tells apart in double precision
    q = np.hstack(found)
    q = _refined(v, np.linalg.qr(q)[0])
    e = np.einsum("ij,ij->j", q, v @ q)
    order = np.argsort(-e, kind="stable")
    return e[order], q[:, order]


def _refined(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """One correction to first order: what the bases of nested subspaces have gathered in rounding goes."""
    s = q.T @ v @ q
    e = np.diag(s)
    gap = e[None, :] - e[:, None]
    safe = np.abs(gap) > 1e6 * _EPS * max(np.abs(e).max(), np.finfo(float).tiny)
    turn = np.where(safe, (s + s.T) / 2 / np.where(safe, gap, 1), 0)
    np.fill_diagonal(turn, 0)
    return np.linalg.qr(q + q @ turn)[0]


@dataclass(frozen=True)
class Whitening:
    """What is fitted: the number of vectors, their exact sums, the components in columns and all their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray

    @property
    def live(self) -> np.ndarray:
        """Which components have a variance above rounding."""
        return self.values > len(self.values) * _EPS * max(self.values[0], 0) if len(self.values) else np.zeros(0, bool)

    @property
    def explained(self) -> np.ndarray:
        trace = self.values.sum()
        return np.maximum(self.values, 0) / trace if trace > 0 else np.zeros(len(self.values))

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exact."""
        if len(x) and self.n * int(np.abs(x).max()) + max(map(abs, self.sums), default=0) >= 1 << 62:
            return np.array([[self.n * v - s for v, s in zip(row, self.sums, strict=True)] for row in x.tolist()], object)
        return self.n * x - np.array([int(s) for s in self.sums], np.int64)

    def whiten(self, far: np.ndarray, k: int) -> np.ndarray:
        """Centred vectors on the first k components, each to unit variance."""
        scale = np.where(self.live[:k], 1 / np.sqrt(np.where(self.live[:k], self.values[:k], 1)), 0)
        return (far / self.n).astype(float) @ (self.vectors[:, :k] * scale)


def matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and whole numbers x of the vectors that are usable and so long."""
    sizes = np.array([0 if s is None else s for s in pc.list_value_length(column).to_pylist()], np.int64) if column.null_count else pc.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(sizes) - sizes
    rows = np.flatnonzero(sizes == width) if width else np.zeros(0, np.int64)
    c = flat[starts[rows][:, None] + np.arange(width)] if len(rows) else np.zeros((0, width))
    good = np.isfinite(c).all(axis=1)
    return rows[good], (np.floor(np.clip(c[good] * SCALE, -(2.0**53), 2.0**53))).astype(np.int64) + OFFSET


def _usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))


def _totals(df: DataFrame, each, width: int) -> np.ndarray:
    """The sum of each(batch) (an array of numbers) over all batches, added up on Spark: one row a task and number, one a number in the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in common.slices(batch):
                found = each(part)
                total = found if total is None else total + found
        if total is not None:
            yield common.record({"values": [total]}, f"values array<{'long' if total.dtype == np.int64 else 'double'}>")

    kind = "long" if each.exact else "double"
    rows = df.mapInArrow(run, f"values array<{kind}>").select(F.posexplode("values").alias("place", "value"))
    out = np.zeros(width, np.int64 if each.exact else float)
    for r in rows.groupBy("place").agg(F.sum("value").alias("value")).collect():  # as many rows as there are numbers
        out[r["place"]] = r["value"]
    return out


class _Sums:
    """Number of vectors, and the sums of their entries in two parts."""

    exact = True

    def __init__(self, width: int):
        self.width = width

    def __call__(self, b: pa.RecordBatch) -> np.ndarray:
        x = matrix(b.column("vector"), self.width)[1]
        return np.concatenate([[len(x)], (x >> _LOW).sum(axis=0), (x & ((1 << _LOW) - 1)).sum(axis=0)]).astype(np.int64)


class _Products:
    """Sums of products of every two entries of the centred vectors, or of the whitened ones, and their own sums."""

    exact = False

    def __init__(self, model: Whitening, k: int | None):
        self.model, self.k = model, k

    def __call__(self, b: pa.RecordBatch) -> np.ndarray:
        far = self.model.deviations(matrix(b.column("vector"), len(self.model.sums))[1])
        y = (far / self.model.n).astype(float) if self.k is None else self.model.whiten(far, self.k)
        return np.concatenate([(y.T @ y)[np.triu_indices(y.shape[1])], y.sum(axis=0)])


def _covariance(df: DataFrame, model: Whitening, k: int | None) -> np.ndarray:
    m = len(model.sums) if k is None else k
    pairs = m * (m + 1) // 2
    total = _totals(df, _Products(model, k), pairs + m)
    v = np.zeros((m, m))
    v[np.triu_indices(m)] = total[:pairs] / model.n
    mean = total[pairs:] / model.n  # nothing but rounding
    return np.triu(v) + np.triu(v, 1).T - np.outer(mean, mean)


def fit(df: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id") -> Whitening:
    """Components of all usable vectors."""
    rows = _usable(df, id_col, vector_col)
    finite = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    lengths = rows.where(finite & (F.size("vector") > 0)).groupBy(F.size("vector").alias("width")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("width")).first()
    if most is None:
        return Whitening(0, (), np.zeros(0), np.zeros((0, 0)))
    width = most["width"]
    total = [int(v) for v in _totals(rows, _Sums(width), 2 * width + 1)]
    sums = tuple((hi << _LOW) + lo for hi, lo in zip(total[1 : width + 1], total[width + 1 :], strict=True))
    bare = Whitening(total[0], sums, np.zeros(0), np.zeros((0, 0)))
    return Whitening(total[0], sums, *spectral(_covariance(rows, bare, None)))


def whitened(df: DataFrame, model: Whitening, components: int = COMPONENTS, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """vec_id, deviation (text of a whole number), whitened (array): one row for each usable vector."""
    k = min(components, len(model.values))
    schema = "vec_id long, deviation string, whitened array<double>"

    def run(b: pa.RecordBatch) -> dict | None:
        rows, x = matrix(b.column("vector"), len(model.sums))
        if not len(rows):
            return None
        far = model.deviations(x)
        if far.dtype != object and int(np.abs(far).max()) ** 2 * far.shape[1] >= 1 << 63:
            far = far.astype(object)
        return {"vec_id": b.column("vec_id").take(pa.array(rows)), "deviation": [str(v) for v in (far * far).sum(axis=1).tolist()], "whitened": list(model.whiten(far, k))}

    return common.map_arrow(_usable(df, id_col, vector_col), run, schema)


def identity_error(df: DataFrame, model: Whitening, components: int = COMPONENTS, vector_col: str = "embedding", id_col: str = "vec_id") -> float:
    """The largest entry of the whitened vectors' covariance less the identity, over the components that have a variance."""
    k = min(components, int(model.live.sum()))
    if not k:
        return 0.0
    return float(np.abs(_covariance(_usable(df, id_col, vector_col), model, k) - np.eye(k)).max())


def whiten(df: DataFrame, components: int = COMPONENTS, vector_col: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each usable vector and component.

    deviation is NULL where it does not fit a long.
    """
    model = fit(df, vector_col, id_col)
    error = identity_error(df, model, components, vector_col, id_col)
    rows = whitened(df, model, components, vector_col, id_col)
    share = F.array(*[F.lit(float(x)) for x in model.explained[:components]]) if len(model.values) else F.array().cast("array<double>")
    each = rows.select("vec_id", F.expr("try_cast(deviation AS long)").alias("deviation"), F.posexplode("whitened").alias("place", "whitened"))
    return each.select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("place")).alias("explained"), F.lit(error).alias("identity_error"),
    )
