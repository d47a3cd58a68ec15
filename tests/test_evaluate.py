"""Exact metrics against the library evaluators and hand-computed cases."""
import math

from pyspark.sql import functions as F

from quarry.operators import evaluate as ev


def _scored(spark):
    rows = [(0.9, 1.0), (0.8, 1.0), (0.8, 0.0), (0.7, 1.0), (0.5, 0.0), (0.5, 1.0), (0.5, 0.0),
            (0.3, 0.0), (0.2, 1.0), (0.1, 0.0), (0.1, 0.0)]
    return spark.createDataFrame(rows, "score double, label double")


def test_auc_matches_library(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = _scored(spark)
    lib = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    roc = ev.roc_auc(df, "score").first()[0]
    pr = ev.pr_auc(df, "score").first()[0]
    assert math.isclose(roc, lib.setMetricName("areaUnderROC").evaluate(df), rel_tol=1e-12)
    assert math.isclose(pr, lib.setMetricName("areaUnderPR").evaluate(df), rel_tol=1e-12)


def test_auc_all_equal_scores(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 0.0), (1.0, 1.0)], "score double, label double")
    assert ev.roc_auc(df, "score").first()[0] == 0.5


def test_weighted_f1_matches_library(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    rows = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (2.0, 1.0), (2.0, 2.0), (2.0, 2.0), (0.0, 2.0), (1.0, 1.0)]
    df = spark.createDataFrame(rows, "prediction double, label double")
    lib = MulticlassClassificationEvaluator(metricName="f1").evaluate(df)
    assert math.isclose(ev.weighted_f1(df, "prediction").first()[0], lib, rel_tol=1e-12)
    assert math.isclose(ev.accuracy(df, "prediction").first()[0], 5 / 8)


# Worked by hand: user 1 has hits at places 2 and 5, user 2 nothing to find,
# user 3 hits at places 1 and 2.
HAND_AP = {2: {1: (1 / 2) / 2, 2: 1.0, 3: (1 / 1 + 2 / 2) / 2},
           3: {1: (1 / 2) / 3, 2: 1.0, 3: (1 / 1 + 2 / 2) / 3},
           10: {1: (1 / 2 + 2 / 5) / 3, 2: 1.0, 3: (1 / 1 + 2 / 2) / 4}}


def test_average_precision_by_hand(spark):
    predicted = {1: [5, 3, 9, 1, 7], 2: [2, 4, 6], 3: [8, 1]}
    actual = {1: [3, 7, 11], 2: [], 3: [8, 1, 2, 4]}
    prows = [(u, it, i + 1) for u, lst in predicted.items() for i, it in enumerate(lst)]
    arows = [(u, it) for u, lst in actual.items() for it in lst]
    p = spark.createDataFrame(prows, "user int, item int, pos int")
    a = spark.createDataFrame(arows, "user int, item int")
    for k in (2, 3, 10):
        got = {r["user"]: r["ap"] for r in ev.average_precision(p, a, k).collect()}
        for u in predicted:
            assert math.isclose(got[u], HAND_AP[k][u]), (u, k)


def test_map_at_several_cuts_equals_one_by_one(spark):
    ranked = spark.createDataFrame([(it, i + 1) for i, it in enumerate([4, 2, 9, 1, 3, 7, 5])], "item int, pos long")
    a = spark.createDataFrame([(1, 2), (1, 5), (2, 9), (2, 4), (2, 1), (3, 99)], "user int, item int")
    got = {r["k"]: r["map"] for r in ev.mean_average_precision(a, ranked, [2, 6]).collect()}
    for k in (2, 6):
        one = ev.map_at_k(ev.average_precision_shared_list(a, ranked, k)).first()[0]
        assert math.isclose(got[k], one)


def test_auc_with_counts_beyond_a_long_product(spark):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 1.0)], "score double, label double")
    per = ev.ranking_metrics(df, "score").first()
    assert per["roc_auc"] == 1.0 and per["pr_auc"] == 1.0
    big = spark.sql("SELECT 6000000000L AS n").select((F.col("n").cast("double") * F.col("n").cast("double")).alias("x"))
    assert big.first()[0] > 2 ** 63


def test_map_full_matches_ranking_evaluator(spark):
    from pyspark.ml.evaluation import RankingEvaluator
    ranking = [4, 2, 9, 1, 3, 7, 5]
    actual = {1: [2, 5], 2: [9, 4, 1], 3: [7]}
    pos = spark.createDataFrame([(it, i + 1) for i, it in enumerate(ranking)], "item int, pos long")
    a = spark.createDataFrame([(u, it) for u, lst in actual.items() for it in lst], "user int, item int")
    got = ev.map_full(a, pos).first()[0]
    lists = spark.createDataFrame([([float(x) for x in ranking], [float(x) for x in lst]) for lst in actual.values()],
                                  "prediction array<double>, label array<double>")
    lib = RankingEvaluator(metricName="meanAveragePrecision").evaluate(lists)
    assert math.isclose(got, lib, rel_tol=1e-12)


def test_mse_rmse_and_library(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (2.0, 4.0)], "predicted double, rating double")
    r = ev.mse_rmse(df).first()
    assert math.isclose(r["mse"], 5 / 3) and math.isclose(r["rmse"], math.sqrt(5 / 3))
    mse, rmse = ev.mse_rmse_library(df)
    assert math.isclose(mse, r["mse"]) and math.isclose(rmse, r["rmse"])


def test_standardise(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, c double")
    r = [(a, b) for a, b in ev.standardise(df, ["x", "c"]).select("x", "c").collect()]
    assert [a for a, _ in r] == [-1.0, 0.0, 1.0] and all(b == 0.0 for _, b in r)
    centred = ev.standardise(df, ["x"], with_std=False).select("x").collect()
    assert [c[0] for c in centred] == [-1.0, 0.0, 1.0]


def test_compare_models_rows(spark):
    df = _scored(spark).withColumn("neg", -F.col("score"))
    out = {r["model"]: r for r in ev.compare_models(df, {"s": "score", "n": "neg"}).collect()}
    assert math.isclose(out["s"]["roc_auc"] + out["n"]["roc_auc"], 1.0)


def test_edge_cases_do_not_fail(spark):
    one_class = spark.createDataFrame([(0.3, 1.0), (0.7, 1.0)], "score double, label double")
    assert ev.roc_auc(one_class, "score").first()[0] is None
    no_pos = spark.createDataFrame([(0.3, 0.0), (0.7, 0.0)], "score double, label double")
    assert ev.pr_auc(no_pos, "score").first()[0] is None
    empty = spark.createDataFrame([], "prediction double, label double")
    assert ev.weighted_f1(empty, "prediction").first()[0] is None
    assert ev.accuracy(empty, "prediction").first()[0] is None


def test_empty_actual_scores_one(spark):
    p = spark.createDataFrame([(1, 10, 1)], "user int, item int, pos int")
    a = spark.createDataFrame([], "user int, item int")
    assert ev.average_precision(p, a, 10).first()["ap"] == 1.0
