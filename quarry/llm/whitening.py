"""Whitening of embeddings on components found by spectrum slicing.

Spark sums the first and second moments of the distinct vectors; what reaches
the driver is one d x d covariance. Its leading eigenvalues are isolated by
counting: the inertia of V - sI, read from an LDL' factorisation, tells how many
eigenvalues lie above s. Inside an interval with one eigenvalue Rayleigh quotient
iteration converges cubically, and two more counts certify its number.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.pandas.types import to_arrow_schema

from quarry.llm.common import written

COMPONENTS = 16
GRID = 64                # an entry c counts as floor(GRID * c) + SHIFT
SHIFT = 1_000_000
REACH = float(2 ** 60)   # entries beyond REACH / GRID count as that
EPS = float(np.finfo(np.float64).eps)


# --- eigenpairs by spectrum slicing ------------------------------------------------

def inertia(a: np.ndarray) -> tuple[int, int]:
    """Numbers of positive and of negative eigenvalues of a symmetric matrix, from
    the pivots of an LDL' factorisation with 1 x 1 and 2 x 2 pivots."""
    a = np.array(a, dtype=np.float64)
    n, k, up, down = len(a), 0, 0, 0
    grow = (1 + np.sqrt(17)) / 8
    while k < n:
        s = a[k:, k:]
        d = s[0, 0]
        r = 1 + int(np.argmax(np.abs(s[1:, 0]))) if n - k > 1 else 0
        big = abs(s[r, 0]) if r else 0.0
        two = False
        if max(abs(d), big) == 0:
            k += 1          # a zero column: a zero pivot
            continue
        if abs(d) < grow * big:
            column = np.abs(s[:, r])
            column[r] = 0
            rival = column.max()
            if abs(d) * rival >= grow * big * big:
                pass
            elif abs(s[r, r]) >= grow * rival:
                s[[0, r]] = s[[r, 0]]
                s[:, [0, r]] = s[:, [r, 0]]
            else:
                two = True
                if r != 1:
                    s[[1, r]] = s[[r, 1]]
                    s[:, [1, r]] = s[:, [r, 1]]
        if two:             # chosen only where the block's determinant is negative
            block, c = s[:2, :2].copy(), s[2:, :2].copy()
            if len(c):
                s[2:, 2:] -= c @ np.linalg.solve(block, c.T)
            up, down, k = up + 1, down + 1, k + 2
        else:
            d, c = s[0, 0], s[1:, 0].copy()
            if len(c):
                s[1:, 1:] -= np.outer(c, c / d)
            up, down, k = up + (d > 0), down + (d < 0), k + 1
    return up, down


class Slicer:
    """Leading eigenpairs of a symmetric non-negative matrix, largest first."""

    def __init__(self, v: np.ndarray):
        self.v = (v + v.T) / 2
        self.eye = np.eye(len(v))
        self.top = float(np.max(np.sum(np.abs(self.v), axis=1), initial=0.0)) * (1 + 4 * EPS)
        self.floor = 8 * len(v) * EPS * self.top     # eigenvalues closer than that are one cluster
        self.counts: dict[float, int] = {}

    def above(self, s: float) -> int:
        """How many eigenvalues exceed ``s``."""
        if s not in self.counts:
            self.counts[s] = inertia(self.v - s * self.eye)[0]
        return self.counts[s]

    def interval(self, k: int) -> tuple[float, float]:
        """``lo < e_k <= hi`` with as few other eigenvalues inside as counts can tell."""
        lo = max((s for s, c in self.counts.items() if c >= k), default=-self.top - 1e-300)
        hi = min((s for s, c in self.counts.items() if c < k), default=self.top)
        while hi - lo > self.floor and (self.counts.get(lo, -1) != k or self.counts.get(hi, -1) != k - 1):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if self.above(mid) >= k else (lo, mid)
            if self.counts.get(hi, -1) == -1:
                self.above(hi)
        return lo, hi

    def solve(self, s: float, x: np.ndarray) -> np.ndarray:
        for bump in (0.0, EPS * self.top, 3 * EPS * self.top):
            try:
                y = np.linalg.solve(self.v - (s + bump) * self.eye, x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all():
                return y
        return x

    def rayleigh(self, lo: float, hi: float, found: np.ndarray, seed: int) -> tuple[float, np.ndarray] | None:
        """Rayleigh quotient iteration that has to stay inside ``(lo, hi]``."""
        rng = np.random.default_rng(seed)
        x = clean(rng.standard_normal(len(self.v)), found)
        for _ in range(2):
            x = clean(self.solve((lo + hi) / 2, x), found)
        best = np.inf
        e = float(x @ self.v @ x)
        for _ in range(20):
            if not lo - self.floor <= e <= hi + self.floor:
                return None
            left = float(np.linalg.norm(self.v @ x - e * x))
            if left <= 4 * EPS * self.top or left >= best / 2:
                break
            best = left
            x = clean(self.solve(e, x), found)
            e = float(x @ self.v @ x)
        return (e, x) if left <= 64 * len(self.v) * EPS * self.top else None

    def cluster(self, lo: float, hi: float, found: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
        """``m`` eigenpairs that no count can tell apart: inverse iteration on a block."""
        x = np.random.default_rng(m).standard_normal((len(self.v), m))
        for _ in range(6):
            x = x - found @ (found.T @ x)
            x = np.linalg.qr(self.solve((lo + hi) / 2, x))[0]
        x = np.linalg.qr(x - found @ (found.T @ x))[0]
        e = np.einsum("ij,ij->j", x, self.v @ x)
        order = np.argsort(-e, kind="stable")
        return e[order], x[:, order]

    def leading(self, count: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``count`` largest eigenvalues that are not zero, and unit eigenvectors."""
        d = len(self.v)
        values, vectors = np.zeros(0), np.zeros((d, 0))
        least = 100 * d * EPS * self.top
        while len(values) < min(count, d):
            k = len(values) + 1
            lo, hi = self.interval(k)
            if hi <= least:
                break
            pair = None
            while pair is None and hi - lo > self.floor and self.above(lo) == k:
                pair = self.rayleigh(lo, hi, vectors, k)
                if pair is not None:
                    # certify the number: k - 1 eigenvalues above, k from just below on
                    near = 2 * self.floor
                    if self.above(pair[0] + near) != k - 1 or self.above(pair[0] - near) != k:
                        pair = None
                if pair is None:
                    mid = (lo + hi) / 2
                    lo, hi = (mid, hi) if self.above(mid) >= k else (lo, mid)
            if pair is None:
                m = max(1, min(self.above(lo) - (k - 1), d - len(values)))
                e, x = self.cluster(lo, hi, vectors, m)
            else:
                e, x = np.array([pair[0]]), pair[1][:, None]
            values, vectors = np.append(values, e), np.hstack([vectors, x])
        keep = values[:count] > least
        return values[:count][keep], vectors[:, :count][:, keep]


def clean(x: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Unit vector of ``x`` without its part along the found eigenvectors."""
    x = x / np.max(np.abs(x))
    for _ in range(2):
        x = x - found @ (found.T @ x)
    return x / np.linalg.norm(x)


def leading_eigenpairs(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    v = np.asarray(v, dtype=np.float64)
    scale = float(np.max(np.abs(v), initial=0.0))
    if not scale:
        return np.zeros(0), np.zeros((len(v), 0))
    values, vectors = Slicer(v / scale).leading(count)
    return values * scale, vectors


# --- the model, fitted by Spark ----------------------------------------------------

@dataclass
class Whitening:
    """What a fit leaves: numbers that depend on the dimension only."""
    dim: int
    n: int                       # distinct vectors
    sums: list[int]              # exact sums per dimension
    values: np.ndarray           # eigenvalues, falling
    vectors: np.ndarray          # unit eigenvectors in columns
    trace: float
    identity_error: float = 0.0
    whole: np.ndarray = field(init=False)   # integer part of the mean
    part: np.ndarray = field(init=False)    # what is left over, as n-ths

    def __post_init__(self):
        self.whole = np.array([s // self.n if self.n else 0 for s in self.sums], dtype=np.int64)
        self.part = np.array([s - self.n * int(w) for s, w in zip(self.sums, self.whole)], dtype=np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.part / max(self.n, 1)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> tuple[list, list]:
        """Sum over the dimensions of ``(n x - S)^2``: as 64-bit numbers (null where
        they do not fit) and, for those, the digits."""
        rough = np.sum((self.centred(x) * self.n) ** 2, axis=1)
        small = rough < 2.0 ** 62
        steps = np.where(small[:, None], x - self.whole, 0)
        exact = np.sum((self.n * steps - np.where(small[:, None], self.part, 0)) ** 2, axis=1)
        fits, digits = exact.tolist(), [None] * len(x)
        for i in np.flatnonzero(~small).tolist():
            total = sum((self.n * int(a) - s) ** 2 for a, s in zip(x[i], self.sums))
            fits[i] = total if total < 2 ** 63 else None
            digits[i] = None if total < 2 ** 63 else str(total)
        return fits, digits


def vectors_of(batch: pa.RecordBatch, name: str, dim: int) -> np.ndarray:
    col = batch.column(batch.schema.get_field_index(name))
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def grid_vectors(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """Rows ``key, x`` with the integer vectors, and their dimension (the commonest
    length, the larger one on a tie; 0 for none)."""
    c = F.col("v")
    finite = F.forall(c, lambda e: e.isNotNull() & ~F.isnan(e.cast("double"))
                      & (F.abs(e.cast("double")) < F.lit(float("inf"))))
    rows = df.select(F.col(key).alias("key"), F.col(vector).alias("v")).where(c.isNotNull()).where(finite)
    common = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).where("dim > 0") \
                 .orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    dim = int(common[0]["dim"]) if common else 0

    def place(e):
        scaled = F.lit(float(GRID)) * e.cast("double")
        return F.floor(F.greatest(F.least(scaled, F.lit(REACH)), F.lit(-REACH))).cast("long") + F.lit(SHIFT)
    return rows.where(F.size("v") == dim).select("key", F.transform("v", place).alias("x")), dim


def exact_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sums per dimension (d rows reach the driver)."""
    def run(batches):
        n, total = 0, [0] * dim
        for b in batches:
            x = vectors_of(b, "x", dim)
            n += len(x)
            high, low = (x >> 30).sum(axis=0).tolist(), (x & ((1 << 30) - 1)).sum(axis=0).tolist()
            total = [t + (h << 30) + lo for t, h, lo in zip(total, high, low)]
        kind = pa.decimal128(38, 0)
        import decimal
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
             pa.array([decimal.Decimal(t) for t in total], kind)], names=["i", "n", "s"])
    rows = fit.mapInArrow(run, "i int, n long, s decimal(38,0)").groupBy("i") \
              .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    if not rows:
        return 0, [0] * dim
    got = {r["i"]: r for r in rows}
    return int(got[0]["n"]), [int(got[i]["s"]) for i in range(dim)]


def second_moments(fit: DataFrame, dim: int, width: int, view) -> np.ndarray:
    """Sum over all vectors of ``y y'`` for ``y = (view(x), 1)``: every partition
    multiplies its vectors, Spark adds the entries."""
    size = width + 1

    def run(batches):
        total = np.zeros((size, size))
        for b in batches:
            x = vectors_of(b, "x", dim)
            y = np.hstack([view(x), np.ones((len(x), 1))])
            total += y.T @ y
        at = np.arange(size)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(at, size), pa.int32()), pa.array(np.tile(at, size), pa.int32()),
             pa.array(total.ravel(), pa.float64())], names=["i", "j", "s"])
    out = np.zeros((size, size))
    for r in fit.mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = r["s"]
    return out


def covariance(moments: np.ndarray, n: int) -> np.ndarray:
    mean = moments[:-1, -1] / n
    return moments[:-1, :-1] / n - np.outer(mean, mean)


def fit_whitening(grid: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening:
    """Fit on each distinct vector of ``grid(x)`` once. Three passes over the
    distinct vectors: exact sums, centred products, and the products of the
    whitened vectors, which measure the result."""
    fit = written(grid.select("x").distinct(), "whitening-fit")
    n, sums = exact_sums(fit, dim)
    model = Whitening(dim, n, sums, np.zeros(0), np.zeros((dim, 0)), 0.0)
    if n < 2:
        return model
    v = covariance(second_moments(fit, dim, dim, model.centred), n)
    values, vectors = leading_eigenpairs(v, min(components, n - 1))
    model.values, model.vectors, model.trace = values, vectors, float(np.trace(v))
    if len(values):
        w = covariance(second_moments(fit, dim, len(values), model.project), n)
        model.identity_error = float(np.max(np.abs(w - np.eye(len(values)))))
    return model


def apply_whitening(grid: DataFrame, model: Whitening) -> DataFrame:
    """One row per vector and component for ``grid(key, x)``."""
    k = len(model.values)
    fields = ("component int, n long, deviation long, whitened double, explained double, identity_error double, "
              "deviation_digits string")
    schema = StructType([grid.schema["key"], *StructType.fromDDL(fields).fields])
    if not k:
        return grid.sparkSession.createDataFrame([], schema)
    arrow = to_arrow_schema(schema)
    share = model.values / model.trace

    def run(batches):
        for b in batches:
            x = vectors_of(b, "x", model.dim)
            fits, digits = model.deviations(x)
            rows = len(x)
            each = np.repeat(np.arange(rows), k)
            cols = [b.column(b.schema.get_field_index("key")).take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                    pa.array(np.full(rows * k, model.n), pa.int64()),
                    pa.array(fits, pa.int64()).take(pa.array(each)),
                    pa.array(model.project(x).ravel(), pa.float64()),
                    pa.array(np.tile(share, rows), pa.float64()),
                    pa.array(np.full(rows * k, model.identity_error), pa.float64()),
                    pa.array(digits, pa.string()).take(pa.array(each))]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)
    return grid.mapInArrow(run, schema)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: ``key, component, n, deviation, whitened,
    explained, identity_error, deviation_digits``.

    An entry c counts as ``floor(64 c) + 1000000``. The fit takes each distinct
    vector once; its covariance has divisor n. Components are numbered from 1 by
    falling eigenvalue; those with eigenvalue zero (constant or dependent
    dimensions, fewer vectors than dimensions) have no whitened value and give no
    rows. ``deviation`` is exact; where it does not fit 64 bits it is null and
    ``deviation_digits`` holds it.

    Rows whose vector is null, empty or holds null or non-finite entries are
    dropped, as are rows whose length is not the commonest one (the larger on a
    tie). Entries beyond 2^60 / 64 count as that. Repeated rows are returned each
    and weigh once in the fit; a null key is kept; an empty table, one distinct
    vector or a table of equal vectors gives no rows; other columns are ignored.
    """
    grid, dim = grid_vectors(df, key, vector)
    model = fit_whitening(grid, dim, components)
    return apply_whitening(grid, model).withColumnRenamed("key", key)
