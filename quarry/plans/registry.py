"""Registered queries (one per SURVEY section-2 operator or operator group)
and their DuckDB oracle SQL.

Every query takes ``(spark, sf_dir)``, reads the given tables (or fixtures
Spark derives from them) in full and returns a DataFrame whose columns are
named exactly as in the oracle SQL. Floating results are rounded to 6 digits
on both sides so summation order does not change the value hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
DIGITS = 6
# Values are first rounded to 9 digits so that last-bit noise from a different
# summation order collapses onto the same decimal before the final rounding
# (a value within 1e-15 of a 6-digit tie would otherwise round both ways).
NOISE_DIGITS = 9


def query(name: str, sql: str | None = None):
    """Register a Spark query under ``name`` with an optional oracle SQL."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = _two_step_round(sql)
        return fn
    return deco


def _two_step_round(sql: str) -> str:
    """Rewrite every ``round(x, 6)`` of the oracle SQL as
    ``round(round(x, 9), 6)`` (the same two steps ``rounded`` applies)."""
    out, i, key = [], 0, "round("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        last_comma = -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                last_comma = k
            k += 1
        inner = sql[j + len(key):k - 1]
        digits = sql[last_comma + 1:k - 1].strip() if last_comma >= 0 else ""
        out.append(sql[i:j])
        if digits == str(DIGITS):
            arg = _two_step_round(sql[j + len(key):last_comma])
            out.append(f"round(round({arg}, {NOISE_DIGITS}), {DIGITS})")
        else:
            out.append(key + _two_step_round(inner) + ")")
        i = k


def _round_like_sql(c, digits: int):
    """``round(x * 10^d) / 10^d`` in double arithmetic (ties away from zero),
    the way the SQL engine rounds a DOUBLE, so equal inputs give equal bits."""
    m = float(10 ** digits)
    return F.round(c * F.lit(m)) / F.lit(m)


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double/float column (the oracle SQL rounds the same ones)."""
    return df.select(*[_round_like_sql(_round_like_sql(F.col(c).cast("double"), NOISE_DIGITS), digits).alias(c)
                       if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


_MODELS: dict = {}


def cached_model(spark: SparkSession, key: tuple, build: Callable[[], object]):
    """A fitted model shared by the queries that need it. It is kept for one
    session and one state of the data (the newest file times under the path), so
    changed data is fitted anew."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(key[-1])
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    state = tuple(sorted((str(f.getPath()), f.getModificationTime()) for f in fs.listStatus(path)))
    full = (spark.sparkContext.applicationId, *key, state)
    if full not in _MODELS:
        _MODELS[full] = build()
    return _MODELS[full]


def _load_modules() -> None:
    # Importing the query modules fills QUERIES / ORACLE.
    from quarry.plans import (q_core, q_files, q_models, q_solvers, q_stream, q_text)  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_modules()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_modules()
    return dict(ORACLE)
