"""Outputs of fitted models, and invariants that a wrong model does not pass."""
import math

import pytest
from pyspark.sql import functions as F

from quarry.operators import evaluate as E
from quarry.plans import q_solvers as Q
from tests.conftest import SF_MID, SF_SMALL


def test_losses(spark):
    rows = [(1.0, 0.9), (1.0, 0.6), (0.0, 0.2), (0.0, 1.0)]
    df = spark.createDataFrame(rows, "label double, score double")
    r = E.log_loss(df, "score").first()
    want = -(math.log(0.9) + math.log(0.6) + math.log(0.8) + math.log(1e-15)) / 4
    assert r["log_loss"] == pytest.approx(want, rel=1e-2) and r["prior_loss"] == pytest.approx(math.log(2))
    h = E.hinge_loss(spark.createDataFrame([(1.0, 2.0), (1.0, 0.5), (0.0, -0.5), (0.0, 1.0)], "label double, m double"), "m").first()
    assert h["hinge_loss"] == pytest.approx((0 + 0.5 + 0.5 + 2) / 4) and h["prior_loss"] == pytest.approx(1.0)
    one = E.log_loss(spark.createDataFrame([(1.0, 0.5)], "label double, score double"), "score").first()
    assert one["prior_loss"] == 0.0


def test_right_models_pass_and_wrong_ones_do_not(spark):
    rows = Q._library_scores(spark, SF_MID).where("not held_out")
    right = {r["model"]: r["below_prior"] for r in Q.losses_below_prior(rows).collect()}
    assert right == {m: True for m in ("logistic", "scaled", "category", "svm", "tree")}
    flipped = rows.withColumn("score", F.when(F.col("model") == "svm", -F.col("score")).otherwise(1 - F.col("score")))
    assert not any(r["below_prior"] for r in Q.losses_below_prior(flipped).collect())
    constant = rows.withColumn("score", F.when(F.col("model") == "svm", F.lit(1.0)).otherwise(F.lit(0.5)))
    assert not any(r["below_prior"] for r in Q.losses_below_prior(constant).collect())


def test_predictions_and_metrics_are_values(spark):
    p = Q.model_predictions(spark, SF_SMALL)
    assert set(p.columns) == {"model", "doc_id", "label", "score", "prediction"} and p.select("model").distinct().count() == 5
    m = {r["model"]: r for r in Q.model_metrics(spark, SF_SMALL).collect()}
    for name, r in m.items():
        own = p.where(F.col("model") == name)
        assert r["accuracy"] == pytest.approx(own.where("label = prediction").count() / own.count())
        assert 0 <= r["roc_auc"] <= 1 and 0 <= r["pr_auc"] <= 1
    v = Q.vectors_of_words(spark, SF_SMALL).first()
    assert len(v["vector"]) == 100


def test_singular_values_are_those_of_the_library(spark):
    from quarry.operators import reduce as rd
    from quarry.plans import fixtures as fx
    mine = [r["value"] for r in Q.singular_value_table(spark, SF_SMALL).orderBy("i").collect()]
    v = rd.centre(rd.to_vectors(fx.vectors(spark, SF_SMALL), "embedding"), "features", "c")
    theirs, _ = rd.svd(v, 10, "c")
    assert mine == pytest.approx(theirs, rel=1e-9)
