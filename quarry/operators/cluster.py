"""k-means clustering (SURVEY KM-*).

Model fitting is ``pyspark.ml.clustering.KMeans`` (distributed Lloyd
iterations, k-means|| initialisation). The pieces that have an exact answer
(centres as group means, assignment to given centres, WCSS, reports) are plain
column expressions: the centres are a model of k x d numbers, so they travel
as literals inside the expression exactly like a fitted model is shipped to
the executors, and no join or cross product with the data is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.scalar import sq_distance, to_double_array


def centroids(df: DataFrame, vec: str, group: str, out: str = "center") -> DataFrame:
    """KM-2 (exact): mean vector per group. Positions are combined map-side;
    the per-group list has one entry per dimension (bounded by the width)."""
    e = df.select(group, F.posexplode(vec).alias("_dim", "_x"))
    m = e.groupBy(group, "_dim").agg(F.avg(F.col("_x").cast("double")).alias("_x"))
    return (m.groupBy(group)
            .agg(F.array_sort(F.collect_list(F.struct("_dim", "_x"))).alias("_s"))
            .select(group, F.transform("_s", lambda s: s["_x"]).alias(out)))


def centers_literal(centers: list[list[float]]) -> Column:
    return F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])


def assign(df: DataFrame, vec: str, centers: list[list[float]], out: str = "cluster",
           dist: str | None = "distance") -> DataFrame:
    """KM-3: index of the nearest centre (first on ties) and its squared
    distance (KM-5 / FN-13)."""
    lit = centers_literal(centers)
    v = to_double_array(vec)
    d = F.transform(lit, lambda c: sq_distance(v, c))
    res = df.withColumn("_d", d)
    res = res.withColumn(out, (F.array_position("_d", F.array_min("_d")) - 1).cast("int"))
    if dist:
        res = res.withColumn(dist, F.array_min("_d"))
    return res.drop("_d")


def wcss(df: DataFrame, vec: str, centers: list[list[float]], name: str = "wcss") -> DataFrame:
    """KM-4: within-cluster sum of squared distances to the nearest centre."""
    a = assign(df, vec, centers, "_c", "_dist")
    return a.agg(F.sum("_dist").alias(name))


def assign_report(df: DataFrame, vec: str, centers: list[list[float]], keep: list[str]) -> DataFrame:
    """KM-5: the kept columns (id, title, genres, ...) with the nearest centre
    and the squared distance to it."""
    return assign(df, vec, centers, "cluster", "distance").select(*keep, "cluster", "distance")


def collect_centers(cent: DataFrame, key: str, col: str = "center") -> tuple[list, list[list[float]]]:
    """Centres of a fitted/exact model to the driver (k rows of d numbers)."""
    rows = cent.orderBy(key).collect()
    return [r[key] for r in rows], [list(r[col]) for r in rows]


def fit_kmeans(df: DataFrame, vec: str, k: int, max_iter: int = 10, runs: int = 1, seed: int = 1,
               tol: float = 1e-4):
    """KM-1: k-means; ``runs`` restarts with different seeds keep the model
    with the lowest training cost. Returns (model, cost)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    data = df.select(array_to_vector(to_double_array(vec)).alias("features")) \
        if dict(df.dtypes)[vec].startswith("array") else df.select(F.col(vec).alias("features"))
    data = data.persist()
    best = None
    try:
        for r in range(runs):
            m = KMeans(k=k, maxIter=max_iter, seed=seed + r, tol=tol, featuresCol="features").fit(data)
            cost = m.summary.trainingCost
            if best is None or cost < best[1]:
                best = (m, cost)
    finally:
        data.unpersist()
    return best


def model_centers(model) -> list[list[float]]:
    """KM-2 from a fitted model."""
    return [list(map(float, c)) for c in model.clusterCenters()]


def sweep_k(train: DataFrame, test: DataFrame, vec: str, ks: list[int], max_iter: int = 10,
            runs: int = 1, seed: int = 1) -> DataFrame:
    """KM-7: (k, wcss on held-out rows, training cost) for several k; the best of
    ``runs`` restarts each."""
    spark = train.sparkSession
    rows = []
    train, test = train.persist(), test.persist()
    try:
        for k in ks:
            m, fitted = fit_kmeans(train, vec, k, max_iter, runs, seed)
            cost = wcss(test, vec, model_centers(m)).first()["wcss"]
            rows.append((k, float(cost) if cost is not None else None, float(fitted)))
    finally:
        train.unpersist()
        test.unpersist()
    return spark.createDataFrame(rows, "k int, wcss double, train_cost double")
