"""Logistic regression by gradient descent.

Each step is one aggregate over the training rows (partial sums per task, combined
by Spark); only the sums, a few numbers per run, reach the driver. All runs of a
sweep (step sizes, penalties, updaters) take their step in the same pass, so a
sweep reads the data as often as a single fit.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


UPDATERS = ("simple", "l1", "l2")
# The rows of step i are those whose (key mod P) * (A + i B) mod P is small.
BATCH_PRIME, BATCH_A, BATCH_B = 1_000_003, 7_919, 104_729


@dataclass(frozen=True)
class Run:
    """One fit of a sweep. ``fraction`` below 1 makes mini-batches: each step takes
    the rows whose key hash falls into that step's interval."""
    name: str
    step: float = 1.0
    updater: str = "simple"
    reg: float = 0.0
    fraction: float = 1.0

    def __post_init__(self):
        if self.updater not in UPDATERS:
            raise ValueError(f"updater {self.updater!r} is none of {UPDATERS}")
        if not 0 < self.fraction <= 1:
            raise ValueError("fraction must lie in (0, 1]")

    def penalty(self, w: list[float]) -> float:
        """Of the weights without the intercept, which comes first."""
        if self.updater == "l2":
            return self.reg / 2 * sum(x * x for x in w[1:])
        return self.reg * sum(abs(x) for x in w[1:]) if self.updater == "l1" else 0.0

    def update(self, w: list[float], gradient: list[float], i: int) -> list[float]:
        """Weights after step ``i`` (from 1), whose length is ``step / sqrt(i)``."""
        eta = self.step / math.sqrt(i)
        moved = [a - eta * g for a, g in zip(w, gradient)]
        if self.updater == "l2":
            moved[1:] = [a * (1 - eta * self.reg) - eta * g for a, g in zip(w[1:], gradient[1:])]
        elif self.updater == "l1":
            moved[1:] = [math.copysign(max(0.0, abs(a) - eta * self.reg), a) + 0.0 for a in moved[1:]]
        return moved


def margin(features: list[str], w: list[float]) -> Column:
    out = F.lit(float(w[0]))
    for f, x in zip(features, w[1:]):
        out = out + F.lit(float(x)) * F.col(f)
    return out


def probability(features: list[str], w: list[float]) -> Column:
    """Probability of class 1."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin(features, w)))


def in_batch(key: str, i: int, fraction: float) -> Column:
    p = BATCH_PRIME
    u = F.pmod(F.pmod(F.col(key), F.lit(p)) * F.lit((BATCH_A + i * BATCH_B) % p), F.lit(p)) / F.lit(float(p))
    return u < F.lit(fraction)


def usable(df: DataFrame, features: list[str], label: str) -> DataFrame:
    """Rows with a label and every feature."""
    cond = F.col(label).isNotNull()
    for f in features:
        cond = cond & F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double"))
    return df.where(cond)


def descend(df: DataFrame, features: list[str], runs: list[Run], iterations: int = 10, label: str = "label",
            key: str | None = None) -> DataFrame:
    """History of every run: ``(run, iteration, n, loss, weights)``.

    ``loss`` is the mean logistic loss of the step's rows plus the penalty, both at
    the weights before the step; ``weights`` are those after it, the intercept
    first (it is not penalised). All start at zero. Rows without a label or with a
    null or NaN feature are left out; a step without rows (n = 0) has a null loss
    and leaves the weights. ``key`` (an integer column) picks mini-batches.
    """
    if any(r.fraction < 1 for r in runs) and not key:
        raise ValueError("mini-batches need a key")
    if len({r.name for r in runs}) != len(runs):
        raise ValueError("runs need different names")
    rows = usable(df, features, label)
    rows = rows.select(F.col(label).cast("double").alias("_y"), *([F.col(key).cast("long").alias("_key")] if key else []),
                       *[F.col(f).cast("double").alias(f"_x{j}") for j, f in enumerate(features)])
    xs = [f"_x{j}" for j in range(len(features))]
    weights = {r.name: [0.0] * (len(features) + 1) for r in runs}
    history = []
    for i in range(1, iterations + 1):
        sums = []
        for k, r in enumerate(runs):
            m = margin(xs, weights[r.name])
            off = F.lit(1.0) / (F.lit(1.0) + F.exp(-m)) - F.col("_y")
            loss = F.greatest(m, F.lit(0.0)) + F.log(F.lit(1.0) + F.exp(-F.abs(m))) - F.col("_y") * m
            taken = in_batch("_key", i, r.fraction) if r.fraction < 1 else F.lit(True)
            each = [loss, off, *[off * F.col(x) for x in xs]]
            sums += [F.count(F.when(taken, 1)).alias(f"n{k}"),
                     *[F.sum(F.when(taken, e)).alias(f"s{k}_{j}") for j, e in enumerate(each)]]
        got = rows.agg(*sums).first()     # one row: a few numbers per run
        for k, r in enumerate(runs):
            n, w = got[f"n{k}"], weights[r.name]
            loss = None
            if n:
                loss = got[f"s{k}_0"] / n + r.penalty(w)
                weights[r.name] = r.update(w, [got[f"s{k}_{j + 1}"] / n for j in range(len(w))], i)
            history.append((r.name, i, n, loss, list(weights[r.name])))
    return df.sparkSession.createDataFrame(history, "run string, iteration int, n long, loss double, weights array<double>")


def final_weights(history: DataFrame) -> dict[str, list[float]]:
    """Weights of each run after its last step (one short row per run and step)."""
    last: dict[str, tuple[int, list[float]]] = {}
    for r in history.collect():
        if r["iteration"] > last.get(r["run"], (0, []))[0]:
            last[r["run"]] = (r["iteration"], list(r["weights"]))
    return {name: w for name, (_, w) in last.items()}


def score_runs(df: DataFrame, features: list[str], weights: dict[str, list[float]], digits: int = 9) -> DataFrame:
    """CLS-7: every row of ``df`` once per run: ``run, score, prediction``. The
    score is the probability of class 1, rounded so that equal rows tie."""
    rows = usable(df, features, features[0]) if features else df
    each = F.array(*[F.struct(F.lit(name).alias("run"), F.round(probability(features, w), digits).alias("score"))
                     for name, w in weights.items()])
    out = rows.select("*", F.inline(each))
    return out.withColumn("prediction", (F.col("score") > 0.5).cast("double"))


def scale_like(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """FEA-1 without leaking: ``cols`` of ``df`` by the training rows' mean and
    standard deviation (one row of numbers); a constant column becomes 0."""
    got = train.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_samp(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    out = df
    for i, c in enumerate(cols):
        m, s = got[f"m{i}"], got[f"s{i}"]
        out = out.withColumn(c, (F.col(c) - F.lit(m)) / F.lit(s) if s else F.when(F.col(c).isNotNull(), F.lit(0.0)))
    return out
