"""Leading singular values and vectors by subspace iteration.

Every pass multiplies the rows with a block of vectors and back: a task sums
``x (x . B)`` over its rows, Spark adds the tasks' blocks. The products are kept
with the blocks they came from, orthogonalised against all of them, and searched
together for the best values (a block Krylov space), which takes far fewer passes
than iterating one block. The d x d matrix never exists; the driver holds d x m
numbers, m a small multiple of k. The rows' mean, when taken off, is folded into
the products.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import to_double_array

EXTRA = 8           # vectors iterated beyond those asked for: they speed up the last ones
TOLERANCE = 1e-11   # residual of each vector, relative to the largest eigenvalue, that ends the passes
KEPT_BLOCKS = 8     # blocks searched together before the space is cut down to the best vectors


@dataclass
class Subspace:
    values: np.ndarray      # singular values, falling
    vectors: np.ndarray     # d x k, unit columns
    mean: np.ndarray        # zero if not centred
    rows: int
    passes: int


def _sums(rows: DataFrame, dim: int, width: int, fn) -> np.ndarray:
    """Sum of ``fn(x)`` (dim x width) over all batches of rows."""
    def run(batches):
        total = np.zeros((dim, width))
        for b in batches:
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            if len(x):
                total += fn(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                         names=["i", "s"])
    parts = rows.mapInArrow(run, "i int, s array<double>")
    summed = parts.select("i", F.posexplode("s").alias("j", "s")).groupBy("i", "j").agg(F.sum("s").alias("s"))
    out = np.zeros((dim, width))
    for r in summed.collect():      # dim x width numbers
        out[r["i"], r["j"]] = r["s"]
    return out


def leading_subspace(df: DataFrame, vec: str, k: int, centred: bool = True, passes: int = 300, seed: int = 1) -> Subspace:
    """The ``k`` largest singular values of the matrix of the rows' vectors (less
    their mean if ``centred``) and the right singular vectors.

    Null vectors are left out; all others must have one length. Passes end when
    every vector solves its equation to a relative 1e-11, or after ``passes``.
    Values that are zero are returned as such."""
    rows = df.where(F.col(vec).isNotNull()).select(to_double_array(vec).alias("x"))
    head = rows.agg(F.count("*").alias("n"), F.max(F.size("x")).alias("d")).first()
    n, dim = head["n"], head["d"] or 0
    k = min(k, dim)
    if not n or not k:
        return Subspace(np.zeros(0), np.zeros((dim, 0)), np.zeros(dim), n, 0)
    mean = _sums(rows, dim, 1, lambda x: x.sum(axis=0)[:, None])[:, 0] / n if centred else np.zeros(dim)
    width = min(dim, k + EXTRA)
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, width)))[0]
    basis, images, done = np.zeros((dim, 0)), np.zeros((dim, 0)), 0
    for done in range(1, passes + 1):
        b = block

        def product(x, b=b):
            y = x - mean
            return y.T @ (y @ b)
        basis, images = np.hstack([basis, b]), np.hstack([images, _sums(rows, dim, b.shape[1], product)])
        # the best values in the whole space: its own small eigenproblem
        small = basis.T @ images
        e, u = np.linalg.eigh((small + small.T) / 2)
        e, u = np.maximum(e[::-1], 0.0), u[:, ::-1]
        vectors = basis @ u
        left = images @ u - vectors * e
        if basis.shape[1] >= dim or np.linalg.norm(left[:, :k], axis=0).max() <= TOLERANCE * max(e[0], 1e-300):
            break
        if basis.shape[1] >= KEPT_BLOCKS * width:
            basis, images, left = vectors[:, :width], images @ u[:, :width], left[:, :width]
        # the next block: what the products hold beyond the space
        block = _beyond(left[:, :width], basis)
        if not block.shape[1]:
            break
    # a fixed sign: the largest entry of a vector is positive
    vectors = vectors[:, :k]
    sign = np.sign(vectors[np.argmax(np.abs(vectors), axis=0), np.arange(k)])
    return Subspace(np.sqrt(e[:k]), vectors * np.where(sign == 0, 1, sign), mean, n, done)


def _beyond(x: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``x`` has outside ``basis``."""
    size = np.linalg.norm(x, axis=0)
    x = x[:, size > 0] / size[size > 0]
    for _ in range(2):
        x = x - basis @ (basis.T @ x)
    q, r = np.linalg.qr(x)
    q = q[:, np.abs(np.diag(r)) > 1e-10][:, :len(basis) - basis.shape[1]]
    q = q - basis @ (basis.T @ q)
    return np.linalg.qr(q)[0] if q.shape[1] else q


def project_rows(df: DataFrame, vec: str, model: Subspace, keep: list[str], out: str = "projected") -> DataFrame:
    """Each row's coordinates on the vectors, next to the kept columns: one matrix
    product per batch."""
    v, mean = model.vectors, model.mean

    @F.pandas_udf("array<double>")
    def onto(x: pd.Series) -> pd.Series:
        have = x.notna()
        if not have.any():
            return pd.Series([None] * len(x), dtype=object)
        done = iter((np.vstack(x[have].to_numpy()).astype(np.float64) - mean) @ v)
        return pd.Series([next(done) if h else None for h in have], dtype=object)
    return df.select(*keep, onto(to_double_array(vec)).alias(out))
