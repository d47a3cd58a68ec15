"""k-means by Lloyd's rounds with distance bounds.

A row keeps an upper bound on the distance to its centre and a lower bound on that
to any other between rounds. Both are moved by how far the centres moved, and as
long as they stay apart the row keeps its centre without a distance computed. The
result is that of plain Lloyd, round by round. Centres are k x d model numbers:
they travel as literals, and one aggregate a round brings their sums back.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import sq_distance, to_double_array
from quarry.operators.cluster import centers_literal
from quarry.operators.relational import hash_unit
from quarry.session import cut_lineage

SLACK = 1e-9            # bounds must differ by this share before a distance is skipped
CUT_EVERY = 5           # rounds between two checkpoints of the rows' state


@dataclass
class Lloyd:
    """Centres after the last round and a report per round: cost and distances
    computed when the rows were assigned, rows that changed their centre."""
    centers: list[list[float]]
    rounds: list[tuple[int, float, int, int]] = field(default_factory=list)

    def report(self, spark) -> DataFrame:
        return spark.createDataFrame(self.rounds, "round int, cost double, changed long, distances long")


def _distances(v: Column, centers: list[list[float]]) -> Column:
    return F.transform(centers_literal(centers), lambda c: F.sqrt(sq_distance(v, c)))


def first_by_hash(df: DataFrame, key: str, vec: str, k: int, seed: int = 1) -> list[list[float]]:
    """The vectors of the ``k`` rows with the smallest key hashes (ties by key)."""
    rows = df.select(to_double_array(vec).alias("v"), F.col(key).alias("k"), hash_unit(key, seed).alias("u"))
    return [list(r["v"]) for r in rows.orderBy("u", "k").limit(k).collect()]


def seed_candidates(df: DataFrame, key: str, vec: str, k: int, rounds: int = 3, factor: float = 2.0, seed: int = 1) -> DataFrame:
    """k-means|| candidates ``(key, v, round)``: the row with the smallest hash, then
    in every round each row with probability ``factor k d^2 / cost``, where d is its
    distance to the candidates so far. The draw is the key's hash, so it does not
    depend on partitions; about ``factor k`` rows a round reach the driver."""
    rows = df.select(F.col(key).alias("key"), to_double_array(vec).alias("v"))
    first = rows.withColumn("u", hash_unit("key", seed)).orderBy("u", "key").limit(1).drop("u").collect()
    chosen = [(r["key"], list(r["v"]), 0) for r in first]
    for i in range(1, rounds + 1):
        if not chosen:
            break
        near = F.array_min(F.transform(centers_literal([c[1] for c in chosen]), lambda c: sq_distance("v", c)))
        cost = rows.agg(F.sum(near).alias("c")).first()["c"]
        if not cost:
            break
        picked = rows.withColumn("d", near).where(hash_unit("key", seed + i * 386_413) < F.lit(factor * k / cost) * F.col("d"))
        chosen += [(r["key"], list(r["v"]), i) for r in picked.select("key", "v").orderBy("key").collect()]
    return df.sparkSession.createDataFrame(chosen, "key long, v array<double>, round int")


def seed_centers(df: DataFrame, key: str, vec: str, k: int, rounds: int = 3, factor: float = 2.0, seed: int = 1) -> list[list[float]]:
    """``k`` starting centres: each candidate weighs as many rows as are nearest to
    it; then, one by one, the candidate whose weight times squared distance to the
    chosen ones is largest. Fewer than ``k`` if there are fewer different vectors."""
    points = [list(r["v"]) for r in seed_candidates(df, key, vec, k, rounds, factor, seed).orderBy("round", "key").collect()]
    if not points:
        return []
    near = _distances(to_double_array(vec), points)
    weigh = df.select((F.array_position(near, F.array_min(near)) - 1).cast("int").alias("c")).groupBy("c").agg(F.count("*").alias("n"))
    weight = {r["c"]: r["n"] for r in weigh.collect()}      # one row per candidate
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    first = max(range(len(points)), key=lambda i: (weight.get(i, 0), -i))
    out, left = [first], {i: gap(points[i], points[first]) for i in range(len(points))}
    while len(out) < k:
        best = max(left, key=lambda i: (weight.get(i, 0) * left[i], -i))
        if weight.get(best, 0) * left[best] <= 0:
            break
        out.append(best)
        left = {i: min(d, gap(points[i], points[best])) for i, d in left.items()}
    return [points[i] for i in out]


def _full(v: Column, centers: list[list[float]]) -> Column:
    """(centre, distance, distance to the next best) of a row; the first centre on ties."""
    d = _distances(v, centers)
    at = F.array_position(d, F.array_min(d)).cast("int")
    other = F.array_min(F.filter(d, lambda x, i: i + 1 != at))
    return F.struct((at - 1).alias("c"), F.array_min(d).alias("up"), F.coalesce(other, F.lit(float("inf"))).alias("low"))


def lloyd(df: DataFrame, vec: str, centers: list[list[float]], rounds: int = 10, bounded: bool = True) -> Lloyd:
    """``rounds`` rounds from the given centres (fewer once no row changes its
    centre). Rows with a null vector are left out; a centre without rows stays where
    it is. ``bounded=False`` computes every distance (the same result)."""
    k = len(centers)
    if not k:
        return Lloyd([])
    rows = df.where(F.col(vec).isNotNull()).select(to_double_array(vec).alias("v"))
    # Costs come from sums about the overall mean, so they need no distances.
    whole = rows.groupBy(F.size("v").alias("d")).agg(Summarizer.mean(array_to_vector("v")).alias("m")).select(vector_to_array("m").alias("m")).first()
    if whole is None:       # no rows: the centres stay
        return Lloyd([list(map(float, c)) for c in centers])
    mid = list(whole["m"])
    rows = rows.withColumn("q", sq_distance(F.col("v"), F.array(*[F.lit(float(x)) for x in mid])))
    state = rows.withColumn("c", F.lit(-1)).withColumn("up", F.lit(float("inf"))).withColumn("low", F.lit(0.0))
    kept, result = None, Lloyd([list(map(float, c)) for c in centers])
    moved = [0.0] * k
    for i in range(1, rounds + 1):
        now = result.centers
        own = F.sqrt(sq_distance(F.col("v"), F.element_at(centers_literal(now), F.col("c") + 1)))
        shift = F.element_at(F.array(*[F.lit(x) for x in moved]), F.col("c") + 1)
        # another centre came nearer by at most the largest shift of the others
        others = F.element_at(F.array(*[F.lit(max([m for j, m in enumerate(moved) if j != c], default=0.0)) for c in range(k)]), F.col("c") + 1)
        fresh = F.struct(*[x.alias(n) for x, n in ((_full(F.col("v"), now), "f"), (F.lit(k).cast("long"), "n"))])
        if i == 1 or not bounded:
            step = fresh
        else:
            low = F.col("low") - others
            apart = lambda up: up * (1 + SLACK) < low
            same = lambda up, n: F.struct(F.struct(F.col("c").alias("c"), up.alias("up"), low.alias("low")).alias("f"),
                                          F.lit(n).cast("long").alias("n"))
            tight = F.struct(F.struct(F.col("c").alias("c"), F.col("_own").alias("up"), low.alias("low")).alias("f"),
                             F.lit(1).cast("long").alias("n"))
            again = F.struct(F.col("_all.f").alias("f"), (F.col("_all.n") + 1).alias("n"))
            state = state.withColumn("_own", F.when(~apart(F.col("up") + shift), own))
            state = state.withColumn("_all", F.when(F.col("_own").isNotNull() & ~apart(F.col("_own")), fresh))
            step = F.when(F.col("_own").isNull(), same(F.col("up") + shift, 0)).when(F.col("_all").isNull(), tight).otherwise(again)
        nxt = state.withColumn("_s", step).select(
            "v", "q", F.col("_s.f.c").alias("c"), F.col("_s.f.up").alias("up"), F.col("_s.f.low").alias("low"),
            (F.col("_s.f.c") != F.col("c")).cast("long").alias("_changed"), F.col("_s.n").alias("_n"))
        nxt = cut_lineage(nxt) if i % CUT_EVERY == 0 else nxt.persist(StorageLevel.MEMORY_AND_DISK)
        # one row per centre: count, mean, squared norms about it, changes, distances
        got = nxt.groupBy("c").agg(F.count("*").alias("rows"), Summarizer.mean(array_to_vector("v")).alias("m"),
                                   F.sum("_changed").alias("changed"), F.sum("_n").alias("n"), F.sum("q").alias("q")) \
                 .select("c", "rows", vector_to_array("m").alias("m"), "changed", "n", "q").collect()
        cost = sum(_cost(r["rows"], r["q"], r["m"], now[r["c"]], mid) for r in got)
        result.rounds.append((i, cost, sum(r["changed"] for r in got), sum(r["n"] for r in got)))
        if i > 1 and not result.rounds[-1][2]:
            _let_go(nxt, kept)
            return result
        means = {r["c"]: list(r["m"]) for r in got}
        result.centers = [means.get(c, now[c]) for c in range(k)]
        moved = [math.dist(a, b) for a, b in zip(now, result.centers)]
        _let_go(kept)
        kept, state = nxt, nxt.select("v", "q", "c", "up", "low")
    _let_go(kept)
    return result


def _cost(rows: int, q: float, mean: list[float], center: list[float], mid: list[float]) -> float:
    """Sum of the squared distances of ``rows`` rows to ``center``, of their mean and
    the sum ``q`` of their squared distances to ``mid``."""
    c = [x - y for x, y in zip(center, mid)]
    return q + rows * sum(x * (x - 2 * (m - y)) for x, m, y in zip(c, mean, mid))


def _let_go(*frames) -> None:
    for f in frames:
        if f is not None and f.storageLevel.useMemory:
            f.unpersist()
