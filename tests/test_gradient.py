import math

import numpy as np
import pytest

from quarry.operators import gradient as G

COLS = ["a", "b"]


def data(n=300, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 2))
    y = (x @ [1.5, -1.0] + 0.3 + rng.logistic(size=n) > 0).astype(float)
    return x, y


def frame(spark, x, y):
    return spark.createDataFrame([(i, float(a), float(b), float(c)) for i, ((a, b), c) in enumerate(zip(x, y))],
                                 "id long, a double, b double, label double")


def by_hand(x, y, run, iterations):
    z = np.hstack([np.ones((len(x), 1)), x])
    w, out = np.zeros(3), []
    for i in range(1, iterations + 1):
        a = (G.BATCH_A + i * G.BATCH_B) % G.BATCH_PRIME
        take = np.array([run.fraction >= 1 or (k % G.BATCH_PRIME * a % G.BATCH_PRIME) / G.BATCH_PRIME < run.fraction for k in range(len(x))])
        m = z[take] @ w
        p = 1 / (1 + np.exp(-m))
        pen = {"simple": 0, "l1": run.reg * np.abs(w[1:]).sum(), "l2": run.reg / 2 * (w[1:] ** 2).sum()}[run.updater]
        loss = float(np.mean(np.logaddexp(0, m) - y[take] * m) + pen)
        g, eta = z[take].T @ (p - y[take]) / take.sum(), run.step / math.sqrt(i)
        new = w - eta * g
        if run.updater == "l2":
            new[1:] -= eta * run.reg * w[1:]
        if run.updater == "l1":
            new[1:] = np.sign(new[1:]) * np.maximum(0, np.abs(new[1:]) - eta * run.reg)
        w = new
        out.append((int(take.sum()), loss, w.copy()))
    return out


RUNS = [G.Run("full", 2.0), G.Run("mini", fraction=0.3), G.Run("l1", updater="l1", reg=0.05), G.Run("l2", 0.5, "l2", 0.2),
        G.Run("mini l1", 0.7, "l1", 0.01, 0.5)]


def test_every_step_equals_the_formulas(spark):
    x, y = data()
    got = G.descend(frame(spark, x, y), COLS, RUNS, 12, key="id").collect()
    assert len(got) == 12 * len(RUNS)
    for run in RUNS:
        want = by_hand(x, y, run, 12)
        for r in (r for r in got if r["run"] == run.name):
            n, loss, w = want[r["iteration"] - 1]
            assert r["n"] == n and math.isclose(r["loss"], loss, rel_tol=1e-10) and np.allclose(r["weights"], w, atol=1e-10)


def test_loss_falls_and_beats_the_prior(spark):
    x, y = data()
    h = [r["loss"] for r in G.descend(frame(spark, x, y), COLS, [G.Run("full")], 30).orderBy("iteration").collect()]
    assert all(a >= b for a, b in zip(h, h[1:])) and h[0] == pytest.approx(math.log(2))
    prior = y.mean()
    assert h[-1] < -(prior * math.log(prior) + (1 - prior) * math.log(1 - prior))


def test_odd_rows_empty_batches_and_wrong_arguments(spark):
    df = spark.createDataFrame([(1, 1.0, None, 1.0), (2, 0.0, 1.0, None), (3, float("nan"), 1.0, 0.0), (None, 1.0, 1.0, 1.0)],
                               "id long, a double, b double, label double")
    (r,) = G.descend(df, COLS, [G.Run("x")], 1).collect()
    assert r["n"] == 1
    (r,) = G.descend(df, COLS, [G.Run("x", fraction=1e-9)], 1, key="id").collect()
    assert r["n"] == 0 and r["loss"] is None and r["weights"] == [0.0, 0.0, 0.0]
    assert G.descend(df.limit(0), COLS, [G.Run("x")], 2).count() == 2
    for bad in (lambda: G.Run("x", updater="l3"), lambda: G.Run("x", fraction=0), lambda: G.descend(df, COLS, [G.Run("x", fraction=0.5)]),
                lambda: G.descend(df, COLS, [G.Run("x"), G.Run("x")])):
        with pytest.raises(ValueError):
            bad()


def test_scores_and_scaling(spark):
    x, y = data(50)
    df = frame(spark, x, y)
    s = {(r["run"], r["id"]): r for r in G.score_runs(df, COLS, {"u": [0.1, 1.0, 2.0], "v": [0.0, 0.0, 0.0]}).collect()}
    for i in range(50):
        assert s["u", i]["score"] == pytest.approx(1 / (1 + math.exp(-(0.1 + x[i, 0] + 2 * x[i, 1]))), abs=1e-9)
        assert s["v", i]["score"] == 0.5 and s["v", i]["prediction"] == 0.0
    train = df.where("id < 30")
    z = {r["id"]: r for r in G.scale_like(train, df, ["a"]).collect()}
    m, sd = x[:30, 0].mean(), x[:30, 0].std(ddof=1)
    assert z[45]["a"] == pytest.approx((x[45, 0] - m) / sd)
