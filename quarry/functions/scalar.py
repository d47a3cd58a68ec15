"""Scalar column functions (SURVEY FN-*): all JVM-side expressions, which
keep rows inside the JVM (array lambdas are interpreted, not part of whole-stage codegen). Vectors are ``array<double>`` columns; use
``pyspark.ml.functions.array_to_vector`` at the boundary to ``pyspark.ml``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- strings -----------------------------------------------------------------
def split_java(c, sep: str) -> Column:
    """FN-1: split on a literal separator dropping trailing empty fields
    (Java ``String.split`` semantics; Spark's ``split`` keeps them)."""
    import re
    c = _c(c)
    esc = re.escape(sep)
    trimmed = F.regexp_replace(c, f"(?:{esc})+$", "")
    parts = F.split(trimmed, esc)
    # only separators -> no fields; empty input -> one empty field
    return (F.when(c == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(parts))


def chars(c) -> Column:
    """FN-2: split into single characters."""
    return F.split(_c(c), "")


def dot(a, b) -> Column:
    """FN-10: dot product of two equal-length numeric arrays."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def norm2(a) -> Column:
    return F.sqrt(F.aggregate(F.transform(_c(a), lambda x: x.cast("double") * x.cast("double")),
                              F.lit(0.0), lambda acc, v: acc + v))


def cosine(a, b) -> Column:
    """FN-11: cosine similarity; NULL when either norm is 0."""
    den = norm2(a) * norm2(b)
    return F.when(den != 0, F.try_divide(dot(a, b), den))


def sq_distance(a, b) -> Column:
    """FN-13: squared Euclidean distance."""
    return F.aggregate(F.zip_with(_c(a), _c(b), lambda x, y: (x.cast("double") - y.cast("double"))
                                  * (x.cast("double") - y.cast("double"))),
                       F.lit(0.0), lambda acc, v: acc + v)


def elementwise(a, b) -> Column:
    """FN-14: element-wise product."""
    return F.zip_with(_c(a), _c(b), lambda x, y: x.cast("double") * y.cast("double"))


def approx_equal(a, b, tol: float = 1e-6, strict_len: bool = False) -> Column:
    """FN-15: |(|x| - |y|)| <= tol for every zipped pair (sign ignored). Arrays
    are cut to the shorter one unless ``strict_len``."""
    a, b = _c(a), _c(b)
    n = F.least(F.size(a), F.size(b))
    close = F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n),
                       lambda x, y: F.abs(F.abs(x.cast("double")) - F.abs(y.cast("double"))) <= tol)
    ok = F.forall(close, lambda v: v)
    if strict_len:
        ok = ok & (F.size(a) == F.size(b))
    return ok


def to_double_array(a) -> Column:
    return F.transform(_c(a), lambda x: x.cast("double"))


def vec_min(a) -> Column:
    """FN-16."""
    return F.array_min(_c(a))


def vec_max(a) -> Column:
    return F.array_max(_c(a))


def fmt_batch_time(ts, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """FN-17: format a (window / batch) start time."""
    return F.date_format(_c(ts), pattern)
