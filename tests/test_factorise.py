"""Lloyd's rounds, normal equations, inner-product search, subspace iteration."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import inner_product as I
from quarry.operators import lloyd as L
from quarry.operators import normal_equations as N
from quarry.operators import subspace as S

VEC = "id long, v array<double>"


def clouds(n=240, d=5, seed=1, k=6):
    rng = np.random.default_rng(seed)
    return rng.standard_normal((k, d))[rng.integers(0, k, n)] * 6 + rng.standard_normal((n, d))


def vectors(spark, x):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], VEC)


def plain_lloyd(x, c, rounds):
    c, report, last = np.array(c), [], None
    for _ in range(rounds):
        d = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
        a = d.argmin(axis=1)
        changed = len(x) if last is None else int((a != last).sum())
        report.append((float(d.min(axis=1).sum()), changed))
        if last is not None and not changed:
            break
        c, last = np.array([x[a == j].mean(axis=0) if (a == j).any() else c[j] for j in range(len(c))]), a
    return c, report


@pytest.mark.parametrize("bounded", [True, False])
def test_rounds_equal_plain_lloyd(spark, bounded):
    x = clouds() + 1000.0        # far from the origin: costs must not cancel
    start = x[:6].tolist()
    m = L.lloyd(vectors(spark, x), "v", start, 12, bounded)
    c, report = plain_lloyd(x, start, 12)
    assert np.allclose(m.centers, c) and len(m.rounds) == len(report)
    assert [r[2] for r in m.rounds] == [r[1] for r in report]
    assert np.allclose([r[1] for r in m.rounds], [r[0] for r in report], rtol=1e-7)


def test_bounds_skip_distances(spark):
    x = clouds(600)
    df, start = vectors(spark, x), x[:6].tolist()
    fast, slow = L.lloyd(df, "v", start, 8), L.lloyd(df, "v", start, 8, bounded=False)
    assert np.allclose(fast.centers, slow.centers)
    assert all(r[3] == 600 * 6 for r in slow.rounds)
    assert sum(r[3] for r in fast.rounds[1:]) < 0.5 * sum(r[3] for r in slow.rounds[1:])


def test_lloyd_odd_input(spark):
    x = clouds(50)
    df = vectors(spark, x).unionByName(spark.createDataFrame([(900, None)], VEC))
    far = [x[0].tolist(), [1e6] * 5]
    m = L.lloyd(df, "v", far, 3)
    assert m.centers[1] == far[1] and np.allclose(m.centers[0], x.mean(axis=0))
    assert L.lloyd(df, "v", [], 3).centers == []
    assert L.lloyd(df.limit(0), "v", far, 2).centers == far
    one = L.lloyd(vectors(spark, np.ones((20, 3))), "v", [[1.0] * 3, [1.0] * 3], 3)
    assert one.centers == [[1.0] * 3] * 2 and one.rounds[-1][1] == 0


def test_seeding_covers_the_clouds(spark):
    x = clouds(300, 3, 5, 4) * 10
    df = vectors(spark, x)
    c = L.seed_centers(df, "id", "v", 4, rounds=4)
    assert len(c) == 4
    m = L.lloyd(df, "v", c, 15)
    best = min(plain_lloyd(x, x[np.random.default_rng(s).choice(300, 4, replace=False)], 30)[1][-1][0] for s in range(10))
    assert m.rounds[-1][1] <= best * 1.05
    again = L.seed_centers(df.repartition(7), "id", "v", 4, rounds=4)
    assert again == c
    assert L.seed_centers(df.limit(0), "id", "v", 4) == []
    assert len(L.seed_centers(vectors(spark, np.ones((10, 2))), "id", "v", 3)) == 1


def ratings(spark, n=30, m=20, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(u, i, float(rng.normal(3, 1))) for u in range(n) for i in range(m) if rng.random() < 0.4 or u == 0]
    return rows, spark.createDataFrame(rows, "user long, item long, rating double")


@pytest.mark.parametrize("chunk", [4096, 3])
def test_solves_equal_least_squares(spark, chunk):
    rows, df = ratings(spark)
    q = np.random.default_rng(1).standard_normal((20, 4))
    items = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(q)], "id long, features array<double>")
    got = {r["id"]: r for r in N.solve_factors(df, items, 0.3, chunk=chunk).collect()}
    for u in range(30):
        own = [(i, r) for a, i, r in rows if a == u]
        a = q[[i for i, _ in own]]
        x = np.linalg.solve(a.T @ a + 0.3 * len(own) * np.eye(4), a.T @ np.array([r for _, r in own]))
        assert got[u]["n"] == len(own) and np.allclose(got[u]["features"], x, atol=1e-9)
    users = N.solve_factors(df, items, 0.3, chunk=chunk).select("id", "features")
    res = N.residuals(df, users, items, 0.3).collect()
    assert len(res) == 30 and max(r["residual"] for r in res) < 1e-10
    # a wrong vector does not pass
    wrong = users.select("id", F.transform("features", lambda x: x * 1.01).alias("features"))
    assert min(r["residual"] for r in N.residuals(df, wrong, items, 0.3).collect()) > 1e-3


def test_equations_are_summed_in_stripes(spark, monkeypatch):
    """Stripes of users hold fewer factors on disk, leave no shuffle file and change no number."""
    from quarry import session
    rows, df = ratings(spark)
    more = spark.createDataFrame([(None, 1, 2.0), (3, None, 2.0), (3, 77, 2.0), (77, 2, 1.0)], df.schema)
    q = np.random.default_rng(1).standard_normal((20, 4)).astype(np.float32)
    items = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(q)], "id long, features array<float>")
    users = spark.createDataFrame([(u, [1.0, float(u), 0.5, 0.0]) for u in range(30)], "id long, features array<double>")
    seen, stored = [], session.stored
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return disk.getAllBlocks().mkString(",").count("shuffle_")

    def watched(part, name):
        before = files()
        out = stored(part, name)
        seen.append((name, files() - before))
        return out
    monkeypatch.setattr(session, "stored", watched)
    got = []
    monkeypatch.setattr(session, "STRIPES", 3)
    monkeypatch.setattr(N, "BUCKET", 20)
    for most, chunk in ((1 << 30, 4096), (4000, 3)):
        monkeypatch.setattr(session, "STRIPE_BYTES", most)
        solved = {r["id"]: r["features"] for r in N.solve_factors(df.unionAll(more), items, 0.3, chunk=chunk).collect()}
        off = {r["id"]: (r["n"], r["residual"]) for r in N.residuals(df.unionAll(more), users, items, 0.3, chunk=chunk).collect()}
        p = N.by_users(df.unionAll(more), users, items, lambda x: x.groupBy("user").count()).collect()
        got.append((solved, off, sorted(map(tuple, p))))
    assert {name: len([1 for x in seen if x[0] == name]) for name, _ in seen} == {"sums": 4, "residuals": 4, "predictions": 4}
    assert all(left <= 0 for _, left in seen)
    for solved, off, p in got:
        assert p == [(u, sum(a == u for a, _, _ in rows)) for u in range(30)] and set(off) == set(range(30)) and set(solved) == set(range(30)) | {77}
        for u in range(30):
            own = [(i, r) for a, i, r in rows if a == u]
            a, b, x = q[[i for i, _ in own]].astype(float), np.array([r for _, r in own]), np.array([1.0, u, 0.5, 0.0])
            want = np.linalg.norm(a.T @ (a @ x - b) + 0.3 * len(own) * x) / np.linalg.norm(a.T @ b)
            assert off[u][0] == len(own) and np.isclose(off[u][1], want, rtol=1e-9)
            assert np.allclose(solved[u], np.linalg.solve(a.T @ a + 0.3 * len(own) * np.eye(4), a.T @ b), atol=1e-9)


def test_tiles_after_each_other_give_the_same_lists(spark, monkeypatch):
    """The stripes of some tiles are compared after those of the others, in stored parts."""
    from quarry import session
    x = np.random.default_rng(7).standard_normal((300, 6))
    df, seen, stored = vectors(spark, x), [], session.stored
    monkeypatch.setattr(session, "stored", lambda part, name: seen.append(name) or stored(part, name))
    run = lambda: sorted(map(tuple, I.top_inner(df, df, 5, "id", "v", block=16, first=16, stripe=2, tile=40).collect()))
    want = run()
    assert not seen
    monkeypatch.setattr(session, "STRIPE_BYTES", 20_000)
    monkeypatch.setattr(session, "STRIPES", 3)
    assert run() == want and seen == ["compared"] * 3
    best = [[int(j) for j in np.argsort(-(x @ v))[:5]] for v in x]
    assert [r[2] for r in want] == [j for own in best for j in own]


def test_alternating_lowers_the_error_and_new_users_fold_in(spark):
    rows, df = ratings(spark)
    err = []
    for it in (1, 4):
        u, i = N.alternate(df, 3, it, 0.05)
        p = N.predict(df, u, i)
        err.append(p.agg(F.avg((F.col("prediction") - F.col("rating")) ** 2)).first()[0])
    assert err[1] < err[0]
    new = spark.createDataFrame([(99, i, r) for a, i, r in rows if a == 0], "user long, item long, rating double")
    fold = N.solve_factors(new, i, 0.05).first()
    own = u.where("id = 0").first()
    assert np.allclose(fold["features"], own["features"], atol=1e-6)
    assert N.solve_factors(df.limit(0), i, 0.1).count() == 0


def brute_top(q, v, k, skip_self):
    out = []
    for a in range(len(q)):
        s = sorted((-float(I._scores(q[a:a + 1], v[b:b + 1])[0, 0]), b) for b in range(len(v)) if not (skip_self and a == b))
        out += [(a, p + 1, b, -x) for p, (x, b) in enumerate(s[:k])]
    return out


@pytest.mark.parametrize("skip_self", [False, True])
def test_inner_products_equal_brute_force(spark, skip_self):
    rng = np.random.default_rng(7)
    v = rng.standard_normal((300, 6)) * rng.lognormal(0, 1, 300)[:, None]
    v[10] = v[20] = v[30]          # ties
    v[40] = 0
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(v)], "id long, features array<double>")
    got = sorted(tuple(r) for r in I.top_inner(df, df, 5, skip_self=skip_self, block=16, first=32, stripe=2, tile=50).collect())
    assert got == brute_top(v, v, 5, skip_self)


def test_blocks_are_skipped(spark):
    rng = np.random.default_rng(8)
    v = rng.standard_normal((4000, 8))
    v *= np.sort(rng.lognormal(0, 1.2, 4000))[::-1][:, None] / np.linalg.norm(v, axis=1)[:, None]
    q = rng.standard_normal((50, 8))
    heaps, skipped = I.search(np.arange(50), q, np.arange(4000), v, 10, block=100)
    assert skipped > 0.5 * 50 * 40
    best = np.argsort(-(q @ v.T), axis=1, kind="stable")[:, :10]
    assert (heaps.item == best).all()


def test_inner_products_odd_input(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0])], "id long, features array<double>")
    rows = sorted(tuple(r) for r in I.top_inner(df, df, 5).collect())
    assert rows == [(1, 1, 1, 1.0), (1, 2, 3, 0.0), (3, 1, 1, 0.0), (3, 2, 3, 0.0)]
    assert I.top_inner(df, df.limit(0), 5).count() == 0 and I.top_inner(df.limit(0), df, 5).count() == 0


def test_blocks_of_equal_length_are_skipped(spark):
    # all of length 1: no norm excludes a block, only where it lies does
    rng = np.random.default_rng(9)
    v = np.repeat(rng.standard_normal((40, 16)), 100, axis=0) + 0.05 * rng.standard_normal((4000, 16))
    v /= np.linalg.norm(v, axis=1)[:, None]
    q = v[::80]
    heaps, skipped = I.search(np.arange(50), q, np.arange(4000), v, 10, block=100)
    assert skipped > 0.8 * 50 * 40
    assert (heaps.item == np.lexsort((np.broadcast_to(np.arange(4000), (50, 4000)), -I._scores(q, v)), axis=1)[:, :10]).all()


@pytest.mark.parametrize("skip_self", [False, True])
def test_inner_products_with_copies_and_broken_vectors(spark, skip_self):
    rng = np.random.default_rng(10)
    v = np.repeat(rng.standard_normal((12, 4)), 30, axis=0) + 0.1 * rng.standard_normal((360, 4))
    v /= np.linalg.norm(v, axis=1)[:, None]
    v[100:220] = v[100]            # more copies than a stripe holds
    v[300:310] = 0
    ids = [i // 2 if i < 20 else i for i in range(360)]       # the first ids stand twice
    rows = [(i, r.tolist()) for i, r in zip(ids, v)]
    broken = [(900, [float("nan"), 0.0, 0.0, 0.0]), (901, [float("inf"), 0.0, 0.0, 0.0]), (902, [None, 1.0, 1.0, 1.0]), (903, None)]
    df = spark.createDataFrame(rows + broken, "id long, features array<double>")
    got = sorted(tuple(r) for r in I.top_inner(df, df, 4, skip_self=skip_self, block=8, first=16, stripe=2, tile=30).collect())
    scores = I._scores(v, v)
    want = []
    for a, i in enumerate(ids):
        best = sorted((-float(scores[a, b]), ids[b]) for b in range(360) if not (skip_self and ids[b] == i))[:4]
        want += [(i, p + 1, b, -s) for p, (s, b) in enumerate(best)]
    assert got == sorted(want)


@pytest.mark.parametrize("d,k,centred", [(40, 5, True), (40, 40, True), (12, 3, False), (6, 10, True)])
def test_values_equal_a_dense_solver(spark, d, k, centred):
    rng = np.random.default_rng(d)
    x = rng.standard_normal((200, d)) * np.linspace(1, 1.3, d) + 4
    m = S.leading_subspace(vectors(spark, x), "v", k, centred)
    y = x - x.mean(axis=0) if centred else x
    s = np.linalg.svd(y, compute_uv=False)[:k]
    assert np.allclose(m.values, s, rtol=1e-9) and len(m.values) == min(k, d)
    assert np.allclose(m.vectors.T @ m.vectors, np.eye(len(s)), atol=1e-10)
    assert np.allclose(np.linalg.norm(y @ m.vectors, axis=0), s, rtol=1e-8)
    p = S.project_rows(vectors(spark, x), "v", m, ["id"]).collect()
    assert np.allclose(np.array([r["projected"] for r in sorted(p, key=lambda r: r["id"])]), y @ m.vectors)


def test_low_rank_wide_and_empty(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((60, 2)) @ rng.standard_normal((2, 90))
    m = S.leading_subspace(vectors(spark, x), "v", 4, False)
    s = np.linalg.svd(x, compute_uv=False)
    assert np.allclose(m.values[:2], s[:2]) and (m.values[2:] < 1e-5 * s[0]).all()
    assert len(S.leading_subspace(vectors(spark, x).limit(0), "v", 4).values) == 0
    withnull = vectors(spark, x).unionByName(spark.createDataFrame([(999, None)], VEC))
    assert np.allclose(S.leading_subspace(withnull, "v", 2, False).values, s[:2])
    assert S.project_rows(withnull, "v", m, ["id"]).where("id = 999").first()["projected"] is None


def test_residuals_of_hot_users_in_chunks(spark):
    r = np.random.default_rng(5)
    rows = [(int(u), int(i), float(r.uniform(1, 5))) for u, n in ((1, 300), (2, 7), (3, 40)) for i in r.integers(0, 60, n)]
    df = spark.createDataFrame(rows, "user long, item long, rating double")
    items = spark.createDataFrame([(i, r.normal(size=3).tolist()) for i in range(60)], "id long, features array<double>")
    users = spark.createDataFrame([(u, r.normal(size=3).tolist()) for u in (1, 2, 3)], "id long, features array<double>")
    whole, cut = ({x["id"]: (x["n"], x["residual"]) for x in N.residuals(df, users, items, 0.3, chunk=c).collect()} for c in (4096, 16))
    assert {u: n for u, (n, _) in whole.items()} == {1: 300, 2: 7, 3: 40}
    assert all(cut[u][0] == n and abs(cut[u][1] - x) < 1e-9 for u, (n, x) in whole.items())
