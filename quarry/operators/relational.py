"""Joins, aggregates, ranking, sorting, set and sampling operators
(SURVEY JN-*, AGG-*, WIN-*, SRT-*, SET-*, SMP-*).

Aggregations rely on Spark's partial (map-side) hash aggregation, so a hot key
is combined before the shuffle. Joins are left to Catalyst + AQE (runtime
broadcast conversion, skew-partition splitting); an explicit broadcast is only
placed on a side with a checked size (``sized_broadcast``).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordered import prefix_sums, rank_within_groups
from quarry.session import sized_broadcast


# --- joins -------------------------------------------------------------------
def join_inner(a: DataFrame, b: DataFrame, on: str | list[str]) -> DataFrame:
    """JN-1/2/6: inner equi-join on one or more key columns."""
    return a.join(b, on, "inner")


def join_lookup(fact: DataFrame, dim: DataFrame, on: str | list[str], keep_missing: bool = True) -> DataFrame:
    """JN-3: fact -> dimension lookup. The dimension is broadcast only when
    the optimizer proves it small; a missing key gives NULLs (``left``) or
    drops the row (``inner``)."""
    return fact.join(sized_broadcast(dim), on, "left" if keep_missing else "inner")


def count_less_than_pairs(df: DataFrame, col: str, as_type: str = "int") -> DataFrame:
    """JN-5: ``SELECT count(*) FROM t a JOIN t b ON cast(a.c) < cast(b.c)``
    without the nested-loop join: count rows per value, then each value pairs
    with every row of a smaller value (a distributed running sum)."""
    per = (df.select(F.col(col).try_cast(as_type).alias("_v")).where(F.col("_v").isNotNull())
           .groupBy("_v").agg(F.count("*").alias("_n")))
    cum = prefix_sums(per, ["_v"], ["_n"], prefix="_before", inclusive=False)
    # The number of pairs outgrows a long at a few billion rows: add up as decimals.
    wide = F.col("_n").cast("decimal(19,0)") * F.col("_before_n").cast("decimal(19,0)")
    return cum.agg(F.coalesce(F.sum(wide), F.lit(0)).cast("decimal(38,0)").alias("num"))


# --- aggregates ----------------------------------------------------------------
def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    """AGG-1."""
    return df.agg(F.count("*").alias(name))


def count_by(df: DataFrame, keys: str | list[str], name: str = "n") -> DataFrame:
    """AGG-2 / TXT-5: count per key, combined map-side."""
    keys = [keys] if isinstance(keys, str) else keys
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def sum_of(df: DataFrame, col: str, name: str = "total") -> DataFrame:
    """AGG-3."""
    return df.agg(F.sum(col).alias(name))


def count_distinct(df: DataFrame, col: str, name: str = "n_distinct", approx: bool = False) -> DataFrame:
    """AGG-4 (exact, or HyperLogLog++ for streams / very large cardinality)."""
    f = F.approx_count_distinct(col) if approx else F.count_distinct(col)
    return df.agg(f.alias(name))


def distinct_values(df: DataFrame, cols: str | list[str]) -> DataFrame:
    """AGG-5 / SET-2."""
    cols = [cols] if isinstance(cols, str) else cols
    return df.select(*cols).distinct()


def group_lists(df: DataFrame, key: str, value: str, name: str = "values") -> DataFrame:
    """AGG-6: sorted list of values per key. Only for groups whose size is
    bounded by construction (e.g. genres per item); unbounded groups should be
    processed as rows (see ``rank_per_group``)."""
    return df.groupBy(key).agg(F.array_sort(F.collect_list(value)).alias(name))


def value_range(df: DataFrame, col: str) -> DataFrame:
    """AGG-7 / TXT-8: global (min, max) of a numeric column, or of the values
    stored in an array column."""
    dtype = dict(df.dtypes)[col]
    lo, hi = (F.array_min(col), F.array_max(col)) if dtype.startswith("array") else (F.col(col), F.col(col))
    return df.agg(F.min(lo).alias("min_value"), F.max(hi).alias("max_value"))


def mean_of(df: DataFrame, expr: Column, name: str = "mean") -> DataFrame:
    """AGG-8."""
    return df.agg(F.avg(expr).alias(name))


def column_summary(df: DataFrame, col: str) -> DataFrame:
    """AGG-9: per-position mean/min/max/non-zeros/variance of an array column.
    One row per position; the explode is combined map-side per position."""
    e = df.select(F.posexplode(col).alias("dim", "_x")).withColumn("_x", F.col("_x").cast("double"))
    return e.groupBy("dim").agg(F.avg("_x").alias("mean"), F.min("_x").alias("min"),
                                F.max("_x").alias("max"),
                                F.count(F.when(F.col("_x") != 0, 1)).alias("num_nonzeros"),
                                F.var_samp("_x").alias("variance"))


def fraction_where(df: DataFrame, pred: Column, scale: float = 1.0, name: str = "fraction") -> DataFrame:
    """AGG-10: ``scale * (rows satisfying pred) / rows``."""
    return df.agg((F.avg(F.when(pred, 1.0).otherwise(0.0)) * scale).alias(name))


def join_values(df: DataFrame, value: str, by: list[str], sep: str = ",",
                name: str = "ids") -> DataFrame:
    """AGG-11: sorted values joined by ``sep`` per group (``by``), e.g. per
    source file; the list size is bounded by the group, never the whole table,
    so there must be a group."""
    if not by:
        raise ValueError("join_values needs a group; the whole table would become one value")
    return df.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(F.col(value).cast("string"))), sep)
                               .alias(name))


# --- window / ranking -----------------------------------------------------------
def top_n_per_group(df: DataFrame, group: str | list[str], order: list, n: int, name: str = "rank") -> DataFrame:
    """WIN-1: first ``n`` rows per group. ``row_number() <= n`` lets Spark put a
    per-partition group limit before the shuffle, so a hot group ships at
    most ``n`` rows per map task."""
    group = [group] if isinstance(group, str) else group
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def rank_per_group(df: DataFrame, group: str | list[str], order: list, name: str = "rank") -> DataFrame:
    """WIN-2: full 1-based ranking inside each group, hot groups spread over
    several tasks (see ``ordered.rank_within_groups``)."""
    group = [group] if isinstance(group, str) else group
    return rank_within_groups(df, group, order, name)


def running_sum(df: DataFrame, group: str | list[str], order: list, col: str, name: str) -> DataFrame:
    """WIN-3: running total inside a group whose size is bounded (e.g. the
    first K positions of a ranked list)."""
    group = [group] if isinstance(group, str) else group
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(col).over(w))


# --- sorts / limits ----------------------------------------------------------------
def sort_desc(df: DataFrame, col: str, *tiebreak: str) -> DataFrame:
    """SRT-1: global sort, descending, with a deterministic tie-break."""
    return df.orderBy(F.desc(col), *[F.asc(t) for t in tiebreak])


def top_k(df: DataFrame, order: list, k: int, offset: int = 0) -> DataFrame:
    """SRT-2/3/5/6: ``k`` best rows after skipping ``offset`` (bounded
    per-partition heaps: TakeOrderedAndProject)."""
    out = df.orderBy(*order)
    if offset:
        out = out.offset(offset)
    return out.limit(k)


def preview(df: DataFrame, order: list, n: int = 5) -> DataFrame:
    """SRT-6: the first ``n`` rows in an explicit order (``first`` / ``take``)."""
    return top_k(df, order, n)


def most_popular(df: DataFrame, key: str, group: list[str] | None = None) -> DataFrame:
    """SRT-4: the most frequent ``key`` (ties -> smallest key) per group;
    counts are combined map-side, then one ``max_by`` per group."""
    whole = not group
    if whole:  # a constant key: empty input gives no row (a global agg gives a NULL row)
        df, group = df.withColumn("_all", F.lit(0)), ["_all"]
    per = df.groupBy(*group, key).agg(F.count("*").alias("_n"))
    out = (per.groupBy(*group)
           .agg(F.min_by(F.col(key), F.struct(-F.col("_n"), F.col(key))).alias(key),
                F.max("_n").alias("n")))
    return out.drop("_all") if whole else out


# --- set / sampling -------------------------------------------------------------
def union_all(frames: list[DataFrame]) -> DataFrame:
    """SET-1."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def sample_rows(df: DataFrame, fraction: float, seed: int, key: str, with_replacement: bool = True) -> DataFrame:
    """SMP-1: a seeded sample that depends on the key alone, not on partitions
    or cores (the built-in sampler draws per partition). Without replacement a
    row is taken if its hash is below ``fraction``; with replacement it is taken
    as often as the Poisson quantile of its hash says."""
    u = hash_unit(key, seed)
    if not with_replacement:
        return df.where(u < fraction)
    return (df.withColumn("_times", poisson_quantile(u, fraction)).where("_times > 0")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_copy"))


def poisson_steps(mean: float) -> list[float]:
    """Cumulative probabilities of 0, 1, 2, ... events, as far as a hash in a
    million can tell them apart."""
    out, p, total, k = [], math.exp(-mean), 0.0, 0
    while total < 1 - 1e-7 and k < 1000:
        total += p
        out.append(total)
        k += 1
        p *= mean / k
    return out


def poisson_quantile(u: Column, mean: float) -> Column:
    """The number of Poisson events whose cumulative probability first exceeds ``u``."""
    return sum((F.when(u >= F.lit(c), 1).otherwise(0) for c in poisson_steps(mean)), F.lit(0))


def hash_unit(key, seed: int) -> Column:
    """Deterministic pseudo-random number in [0, 1) from an integer key
    (multiplicative hashing; reproducible in any SQL engine)."""
    # h = (k * 2654435761 + seed) mod p with p = 1000003, reduced first so no
    # intermediate leaves the long range for any key (2654435761 mod p = 427799)
    k = F.col(key) if isinstance(key, str) else key
    r = F.pmod(k.cast("long"), F.lit(1000003))
    return F.pmod(r * F.lit(427799) + F.lit(seed), F.lit(1000003)) / F.lit(1000003.0)


def pick_by_hash(df: DataFrame, key: str, seed: int, group: list[str] | None = None) -> DataFrame:
    """SMP-1 (reproducible): one row per group, the one with the smallest hash."""
    group = group or []
    rest = [c for c in df.columns if c not in group]
    row = F.struct(hash_unit(key, seed).alias("_h"), F.col(key).alias("_k"), F.struct(*rest).alias("_row"))
    picked = df.groupBy(*group).agg(F.min(row).alias("_p"))  # a NULL group is a group too
    return picked.where(F.col("_p").isNotNull()).select(
        *[F.col(c) if c in group else F.col("_p._row")[c].alias(c) for c in df.columns])


def split_rows(df: DataFrame, weights: list[float], seed: int, key: str) -> list[DataFrame]:
    """SMP-2: weighted split by the hash of the key: every row is in one part,
    the same one whatever the partitions."""
    u, total, parts, lo = hash_unit(key, seed), sum(weights), [], 0.0
    for i, w in enumerate(weights):
        hi = lo + w / total
        inside = u >= lo if i == len(weights) - 1 else (u >= lo) & (u < hi)
        parts.append(df.where(inside))
        lo = hi
    return parts


def split_by_hash(df: DataFrame, key: str, train_fraction: float, seed: int) -> tuple[DataFrame, DataFrame]:
    """SMP-2 (stable): hash-based split, identical on every run and engine."""
    u = hash_unit(key, seed)
    return df.where(u < train_fraction), df.where(u >= train_fraction)
