"""Classifiers, feature pipelines and parameter sweeps (SURVEY CLS-*, FEA-*, TUN-*).

Estimators are ``pyspark.ml`` (distributed fits; only coefficients reach the
driver). Metrics come from ``quarry.operators.evaluate`` (exact, distributed).
A sweep is a short driver loop over parameter values, each value one set of
Spark jobs over a cached training frame.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.evaluate import ranking_metrics
from quarry.operators.relational import union_all
from quarry.session import cut_lineage


def features_pipeline(numeric: list[str], category: str | None = None, scale: bool = False,
                      with_mean: bool = True, numeric_first: bool = False):
    """FEA-1/3: [category one-hot (all levels)] ++ numbers, optionally
    standardised, assembled into ``features``."""
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
    stages, cols = [], []
    if category:
        stages += [StringIndexer(inputCol=category, outputCol="_cat_idx", stringOrderType="alphabetAsc",
                                 handleInvalid="keep"),
                   OneHotEncoder(inputCol="_cat_idx", outputCol="_cat_vec", dropLast=False)]
        cols.append("_cat_vec")
    cols = cols + numeric if not numeric_first else numeric + cols
    out = "_raw" if scale else "features"
    stages.append(VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep"))
    if scale:
        stages.append(StandardScaler(inputCol="_raw", outputCol="features", withMean=with_mean, withStd=True))
    return stages


def fit(df: DataFrame, estimator, stages: list | None = None):
    """Fit ``stages + [estimator]`` as one Pipeline."""
    from pyspark.ml import Pipeline
    return Pipeline(stages=[*(stages or []), estimator]).fit(df)


def logistic(max_iter: int = 10, reg: float = 0.0):
    """CLS-1: logistic regression (L-BFGS)."""
    from pyspark.ml.classification import LogisticRegression
    return LogisticRegression(maxIter=max_iter, regParam=reg, labelCol="label", featuresCol="features")


def svm(max_iter: int = 10, reg: float = 0.0):
    """CLS-3: linear SVM."""
    from pyspark.ml.classification import LinearSVC
    return LinearSVC(maxIter=max_iter, regParam=reg, labelCol="label", featuresCol="features")


def bayes(smoothing: float = 1.0):
    """CLS-5: multinomial naive Bayes (features must be non-negative)."""
    from pyspark.ml.classification import NaiveBayes
    return NaiveBayes(smoothing=smoothing, modelType="multinomial", labelCol="label", featuresCol="features")


def tree(max_depth: int = 5, impurity: str = "entropy"):
    """CLS-6: decision tree classifier."""
    from pyspark.ml.classification import DecisionTreeClassifier
    return DecisionTreeClassifier(maxDepth=max_depth, impurity=impurity, labelCol="label", featuresCol="features")


def fit_logistic(df: DataFrame, max_iter: int = 10, reg: float = 0.0, stages: list | None = None):
    """CLS-1: fitted logistic-regression pipeline."""
    return fit(df, logistic(max_iter, reg), stages)


def predict(model, df: DataFrame) -> DataFrame:
    """CLS-7: batch prediction (adds ``prediction`` and the score columns)."""
    return model.transform(df)


def logistic_gd(n_features: int, max_iter: int = 10, step: float = 1.0, seed: int = 7):
    """CLS-2: logistic regression by gradient descent with a step size: a network
    without hidden layer (softmax of one linear layer), solved by ``gd`` in the
    JVM. The only estimator here whose step size can be varied."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    return MultilayerPerceptronClassifier(layers=[n_features, 2], solver="gd", stepSize=step, maxIter=max_iter, seed=seed,
                                          labelCol="label", featuresCol="features")


def positive_score(pred: DataFrame, out: str = "score") -> DataFrame:
    """Probability (or raw margin) of class 1 as a double column."""
    from pyspark.ml.functions import vector_to_array
    col = "probability" if "probability" in pred.columns else "rawPrediction"
    return pred.withColumn(out, vector_to_array(col)[1])


def scored_models(preds: dict[str, DataFrame], label: str = "label", name: str = "model") -> DataFrame:
    """(name, label, prediction, score) rows of several models' predictions."""
    return union_all([positive_score(p).select(F.lit(n).alias(name), F.col(label).alias("label"), "prediction", "score")
                      for n, p in preds.items()])


def fit_features(train: DataFrame, test: DataFrame, stages: list) -> tuple[DataFrame, DataFrame]:
    """The feature stages fitted once on ``train`` and applied to both sides."""
    from pyspark.ml import Pipeline
    model = Pipeline(stages=stages).fit(train)
    return model.transform(train), model.transform(test)


def sweep(train: DataFrame, test: DataFrame, make: Callable[[object], object], values: list,
          param: str, stages: list | None = None, label: str = "label") -> DataFrame:
    """TUN-1..6: one fit per parameter value on features fitted once; the scores
    of all values are evaluated together: (param, accuracy, pr_auc, roc_auc).
    ``train`` is a share of the rows and ``test`` the rest."""
    tr, te = fit_features(train, test, stages or [])
    tr, te = tr.persist(), te.persist()
    try:
        preds = {str(v): make(v).fit(tr).transform(te) for v in values}
        rows = cut_lineage(scored_models(preds, label, param))
    finally:
        tr.unpersist()
        te.unpersist()
    return ranking_metrics(rows, "score", "label", [param], pred="prediction")
