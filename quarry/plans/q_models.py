"""Registered model and metric queries: REC-*, EVL-*, FEA-*, CLS-*, TUN-*,
KM-*, DIM-*.

Exact pieces are compared value by value. A fitted model's numbers have no SQL
form: its queries return the rows it must have and booleans that its numbers
satisfy (errors below a baseline, metrics equal to the library's evaluators,
costs that fall, projections equal up to sign), and the SQL says ``true``."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import scalar as fn
from quarry.operators import classify as cl
from quarry.operators import cluster as km
from quarry.operators import evaluate as ev
from quarry.operators import recommend as rc
from quarry.operators import reduce as rd
from quarry.operators import relational as rel
from quarry.operators import shape as sh
from quarry.operators.ordered import global_index
from quarry.plans import fixtures as fx
from quarry.plans.q_core import _BASELINE_SQL, CENTROIDS_SQL, USER, baseline_predictions, label_centroids
from quarry.plans.registry import cached_model, query, rounded
from quarry.session import cut_lineage, few_partitions, stored

W = fx.with_fixtures
ITEM = 7          # the item whose neighbours are listed
THRESHOLD = 7.0   # score threshold turning SCORED into a hard prediction
K = 10

# FIXED VALUES: parameters of the fits and sweeps, in the programs' order.
ALS = {"rank": 50, "max_iter": 10, "reg": 0.01}
ALS_FOR_CLUSTERS = {"rank": 50, "max_iter": 10, "reg": 0.1}
AP_CUTS = [10, 2000]
ITERATIONS = [1, 5, 10, 50]
STEPS = [0.001, 0.01, 0.1, 1.0, 10.0]
PENALTIES = [0.001, 0.01, 0.1, 1.0, 10.0]
DEPTHS = [1, 2, 3, 4, 5, 10, 20]
SMOOTHINGS = [0.001, 0.01, 0.1, 1.0, 10.0]
HOLDOUT_PENALTIES = [0.0, 0.001, 0.0025, 0.005, 0.01]
CLUSTER_COUNTS = [2, 3, 4, 5, 10, 20]


# --- recommendation: exact pieces ----------------------------------------------------


@query("rec06_similar_items", f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a FROM embeddings)
, q AS (SELECT a AS b FROM v WHERE vec_id = {ITEM})
, s AS (SELECT vec_id, list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b)))
               AS similarity FROM v, q WHERE vec_id <> {ITEM})
SELECT vec_id, round(similarity, 6) AS similarity FROM s ORDER BY similarity DESC, vec_id LIMIT {K}""")
def similar_items(spark, sf):
    v = fx.vectors(spark, sf).select("vec_id", fn.to_double_array("embedding").alias("v"))
    return rounded(rc.similar_items(v, ITEM, K, "vec_id", "v"))


def _pairs(spark, sf):
    """(user, item, rating, predicted); the base tables are read once."""
    return baseline_predictions(cut_lineage(fx.ratings(spark, sf)))


@query("rec07_squared_error", W(_BASELINE_SQL + f"""
SELECT r.item, round(pow(p.predicted - r.rating, 2), 6) AS squared_error
FROM ratings r JOIN pred p ON r."user" = p."user" AND r.item = p.item
WHERE r."user" = {USER} ORDER BY r.item LIMIT 1""", "ratings"))
def squared_error(spark, sf):
    first = rel.top_k(sh.lookup(_pairs(spark, sf), "user", USER), ["item"], 1)
    return rounded(first.select("item", ev.squared_error(F.col("predicted"), F.col("rating")).alias("squared_error")))


_MSE_SQL = W(_BASELINE_SQL + """
SELECT round(avg(pow(p.predicted - r.rating, 2)), 6) AS mse, round(sqrt(avg(pow(p.predicted - r.rating, 2))), 6) AS rmse
FROM ratings r JOIN pred p ON r."user" = p."user" AND r.item = p.item""", "ratings")


@query("rec08_mse_rmse", _MSE_SQL)
def mse_rmse(spark, sf):
    return rounded(ev.mse_rmse(_pairs(spark, sf)))


@query("rec09_mse_rmse_library", _MSE_SQL)
def mse_rmse_library(spark, sf):
    mse, rmse = ev.mse_rmse_library(cut_lineage(_pairs(spark, sf)))
    return rounded(spark.createDataFrame([(float(mse), float(rmse))], "mse double, rmse double"))


_POP_SQL = """
, pop AS (SELECT item, count(*) AS n FROM ratings GROUP BY item)
, ranked AS (SELECT item, row_number() OVER (ORDER BY n DESC, item) AS pos FROM pop)
, na AS (SELECT "user", count(*) AS na FROM ratings GROUP BY "user")
"""


def _ap_sql(k: int) -> str:
    return f"""
, hits{k} AS (SELECT r."user", k.pos, row_number() OVER (PARTITION BY r."user" ORDER BY k.pos) AS h
             FROM ratings r JOIN ranked k ON r.item = k.item WHERE k.pos <= {k})
, ap{k} AS (SELECT na."user", coalesce(sum(h / pos), 0) / least(na.na, {k}) AS ap
           FROM na LEFT JOIN hits{k} h ON na."user" = h."user" GROUP BY na."user", na.na)
"""


def _popularity(spark, sf, k):
    r = cut_lineage(fx.ratings(spark, sf).select("user", "item"))
    return r, ev.top_k_positions(rel.count_by(r, "item"), "item", [F.desc("n"), F.asc("item")], k)


@query("rec10_average_precision", W(_POP_SQL + _ap_sql(K) + f"""
SELECT "user", round(ap, 6) AS ap FROM ap{K}""", "ratings"))
def average_precision(spark, sf):
    r, ranked = _popularity(spark, sf, K)
    return rounded(ev.average_precision_shared_list(r, ranked, K))


@query("rec11_map_at_k", W(_POP_SQL + _ap_sql(10) + _ap_sql(2000) + """
SELECT 10 AS k, round(avg(ap), 6) AS map FROM ap10 UNION ALL SELECT 2000, round(avg(ap), 6) FROM ap2000""",
                               "ratings"))
def map_at_k(spark, sf):
    r, ranked = _popularity(spark, sf, max(AP_CUTS))
    return rounded(ev.mean_average_precision(r, ranked, AP_CUTS))


@query("rec12_map_full", W(_POP_SQL + """
, hits AS (SELECT r."user", k.pos, row_number() OVER (PARTITION BY r."user" ORDER BY k.pos, k.item) AS h
           FROM ratings r JOIN ranked k ON r.item = k.item)
SELECT round(avg(ap), 6) AS map FROM (SELECT "user", sum(h / pos) / count(*) AS ap FROM hits GROUP BY "user")""",
                               "ratings"))
def map_full(spark, sf):
    r = cut_lineage(fx.ratings(spark, sf).select("user", "item"))
    # a full ranking of every item: distributed global positions, not one task
    pos = global_index(rel.count_by(r, "item"), [F.desc("n"), F.asc("item")], "pos").withColumn("pos", F.col("pos") + 1)
    return rounded(ev.map_full(r, pos))


# --- recommendation: ALS ---------------------------------------------------------------------


def rated(spark, sf):
    """The ratings, joined and averaged once per session and data path."""
    return cached_model(spark, ("ratings", sf), lambda: stored(fx.ratings(spark, sf), "ratings"))


def _als(spark, sf):
    return cached_model(spark, ("als", sf), lambda: rc.Recommender(rated(spark, sf), **ALS))


def _finite(vec):
    return F.forall(vec, lambda x: ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)


def _factors_sql(col: str) -> str:
    return W(f"""SELECT DISTINCT {col} AS id, {ALS['rank']} AS rank, true AS usable FROM ratings""", "ratings")


@query("rec01_fit_als", _factors_sql('"user"'))
def fit_als(spark, sf):
    """User factors of the fitted model (rank 50, 10 iterations, 0.01): one finite
    vector that is not zero per user."""
    users, _ = _als(spark, sf).factors()
    return users.select("id", F.size("features").alias("rank"), _finite("features").alias("usable"))


@query("rec13_factor_tables", _factors_sql("item"))
def factor_tables(spark, sf):
    _, items = _als(spark, sf).factors()
    return items.select("id", F.size("features").alias("rank"), _finite("features").alias("usable"))


@query("rec03_predict_pairs", W("""
SELECT "user", item, round(rating, 6) AS rating, true AS predicted FROM ratings""", "ratings"))
def predict_pairs(spark, sf):
    p = _als(spark, sf).predict(rated(spark, sf))
    return rounded(p.select("user", "item", "rating", (F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("predicted")))


@query("rec04_recommend", W(f"""
SELECT {USER}::BIGINT AS "user", unnest(range(1, least({K}, (SELECT count(DISTINCT item) FROM ratings)) + 1)) AS pos,
       true AS titled, true AS in_order FROM (SELECT DISTINCT "user" FROM ratings WHERE "user" = {USER})""", "ratings"))
def recommend(spark, sf):
    """One user's best items with titles, best first."""
    users = fx.ratings(spark, sf).select("user").where(F.col("user") == USER).distinct()
    top = rel.join_lookup(_als(spark, sf).top(users, K), fx.titles(spark, sf).withColumnRenamed("id", "item"), "item")
    before = F.lag("score").over(Window.partitionBy("user").orderBy("pos"))  # K rows per user
    return top.select("user", F.col("pos").cast("long").alias("pos"), F.col("title").isNotNull().alias("titled"),
                      (before.isNull() | (before >= F.col("score"))).alias("in_order"))


@query("rec05_recommend_all", W(f"""
SELECT "user", least({K}, (SELECT count(DISTINCT item) FROM ratings))::BIGINT AS n, true AS in_order, true AS no_repeat
FROM (SELECT DISTINCT "user" FROM ratings)""", "ratings"))
def recommend_all(spark, sf):
    """REC-5 / JN-4: top-K of every user from the blocked all-pairs scoring."""
    top = _als(spark, sf).top_all(K)
    rows = F.array_sort(F.collect_list(F.struct("pos", "score", "item")))  # K per user
    return top.groupBy("user").agg(rows.alias("r")).select(
        "user", F.size("r").cast("long").alias("n"),
        F.forall(F.sequence(F.lit(2), F.greatest(F.size("r"), F.lit(2))),
                 lambda i: F.coalesce(F.try_element_at("r", i - 1)["score"] >= F.try_element_at("r", i)["score"], F.lit(True))).alias("in_order"),
        (F.size(F.array_distinct(F.transform("r", lambda x: x["item"]))) == F.size("r")).alias("no_repeat"))


@query("rec_als_metrics", W("""
SELECT count(*) AS n, true AS below_spread, true AS map_in_range FROM ratings""", "ratings"))
def als_metrics(spark, sf):
    """ALS on its training pairs: its RMSE is below the ratings' own spread, and
    MAP@10 of its top-10 lists lies in (0, 1]."""
    m, r = _als(spark, sf), rated(spark, sf)
    err = m.predict(r).agg(F.count("*").alias("n"), F.avg(ev.squared_error(F.col("prediction"), F.col("rating"))).alias("mse"),
                           F.var_pop("rating").alias("spread"))
    ap = ev.map_at_k(ev.average_precision(m.top_all(K), r.select("user", "item"), K)).first()["map"]  # one number
    return err.select("n", (F.col("mse") < F.col("spread")).alias("below_spread"),
                      F.lit(ap is not None and 0 < ap <= 1).alias("map_in_range"))


@query("rec06_factor_items", W(f"""
SELECT unnest(range(1, least({K}, (SELECT count(DISTINCT item) FROM ratings) - 1) + 1)) AS pos,
       true AS titled, true AS another, true AS in_order""", "ratings"))
def factor_items(spark, sf):
    """Items most similar to the first one by ALS factors, with titles."""
    _, items = _als(spark, sf).factors()
    items = cut_lineage(items)
    first = items.agg(F.min("id")).first()[0]
    top = rel.join_lookup(rc.similar_items(items, first, K), fx.titles(spark, sf), "id")
    w = Window.orderBy(F.desc("similarity"), "id")  # K rows
    before = F.lag("similarity").over(w)
    return top.select(F.row_number().over(w).cast("long").alias("pos"), F.col("title").isNotNull().alias("titled"),
                      (F.col("id") != F.lit(first)).alias("another"),
                      (before.isNull() | (before >= F.col("similarity"))).alias("in_order"))


# --- evaluation metrics (exact) -----------------------------------------------------------

_PRED_SQL = f"CASE WHEN score > {THRESHOLD} THEN 1.0 ELSE 0.0 END"


@query("evl01_accuracy", W(f"""
SELECT round(avg(CASE WHEN {_PRED_SQL} = label THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM scored""",
                           "labelled", "scored"))
def accuracy(spark, sf):
    s = fx.scored(spark, sf).withColumn("predicted", sh.threshold("score", THRESHOLD))
    return rounded(ev.accuracy(s, "predicted"))


def _roc_sql(score: str) -> str:
    return f"""(SELECT (sum(CASE WHEN label > 0.5 THEN lo + (ties - 1) / 2.0 END) - P * (P + 1) / 2.0) / (P * N)
  FROM (SELECT label, rank() OVER (ORDER BY {score}) AS lo, count(*) OVER (PARTITION BY {score}) AS ties,
               sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) OVER () AS P,
               sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) OVER () AS N FROM scored) GROUP BY P, N)"""


def _pr_sql(score: str) -> str:
    return f"""(SELECT sum((rec - coalesce(prev_rec, 0)) * (prec + coalesce(prev_prec, prec)) / 2) FROM (
  SELECT tp / (tp + fp) AS prec, tp / P AS rec,
         lag(tp / (tp + fp)) OVER (ORDER BY s DESC) AS prev_prec, lag(tp / P) OVER (ORDER BY s DESC) AS prev_rec
  FROM (SELECT s, sum(p) OVER (ORDER BY s DESC) AS tp, sum(n) OVER (ORDER BY s DESC) AS fp,
               sum(p) OVER () AS P FROM (
          SELECT {score} AS s, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS p,
                 sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS n FROM scored GROUP BY {score}))))"""


@query("evl02_roc_auc", W(f"SELECT round({_roc_sql('score')}, 6) AS roc_auc", "labelled", "scored"))
def roc_auc(spark, sf):
    return rounded(ev.roc_auc(fx.scored(spark, sf), "score"))


@query("evl03_pr_auc", W(f"SELECT round({_pr_sql('score')}, 6) AS pr_auc", "labelled", "scored"))
def pr_auc(spark, sf):
    return rounded(ev.pr_auc(fx.scored(spark, sf), "score"))


@query("evl04_weighted_f1", W(f"""
, pr AS (SELECT label, {_PRED_SQL} AS pred FROM scored)
, st AS (SELECT k, (SELECT count(*) FROM pr WHERE label = k AND pred = k) AS tp,
                (SELECT count(*) FROM pr WHERE pred = k) AS np, (SELECT count(*) FROM pr WHERE label = k) AS nl
         FROM (SELECT DISTINCT label AS k FROM pr))
, f AS (SELECT nl, CASE WHEN np > 0 THEN tp / np ELSE 0 END AS p, tp / nl AS r FROM st)
SELECT round(sum(nl * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / sum(nl), 6) AS weighted_f1
FROM f""", "labelled", "scored"))
def weighted_f1(spark, sf):
    s = fx.scored(spark, sf).withColumn("predicted", sh.threshold("score", THRESHOLD))
    return rounded(ev.weighted_f1(s, "predicted"))


_MODEL_SCORES = {"chars": "n_chars", "words": "n_words", "toxic": "toxic"}


@query("evl05_compare_models", W("\nUNION ALL ".join(
    f"SELECT '{m}' AS model, round({_pr_sql(c)}, 6) AS pr_auc, round({_roc_sql(c)}, 6) AS roc_auc"
    for m, c in _MODEL_SCORES.items()), "labelled", "scored"))
def compare_models(spark, sf):
    return rounded(ev.compare_models(fx.scored(spark, sf), _MODEL_SCORES))


@query("fea01_standardise", W("""
SELECT doc_id, round((n_chars - avg(n_chars) OVER ()) / stddev_samp(n_chars) OVER (), 6) AS n_chars,
       round((n_words - avg(n_words) OVER ()) / stddev_samp(n_words) OVER (), 6) AS n_words,
       round((toxic - avg(toxic) OVER ()) / stddev_samp(toxic) OVER (), 6) AS toxic FROM labelled""", "labelled"))
def standardise(spark, sf):
    cols = ["n_chars", "n_words", "toxic"]
    return rounded(ev.standardise(fx.labelled(spark, sf), cols).select("doc_id", *cols))


# --- classifiers ----------------------------------------------------------------------------------

NUMS = ["n_chars", "n_words", "toxic"]
_TEST_U = "(((doc_id % 1000003) * 427799 + 123) % 1000003) / 1000003.0"


def _split(spark, sf):
    train, test = rel.split_by_hash(few_partitions(cut_lineage(fx.labelled(spark, sf))), "doc_id", 0.6, 123)
    return train, test


def _checked(rows, name: str, spark):
    """(name, n_test, n_positive, in_range, as_library) of scored rows: the exact
    metrics lie in [0, 1] and equal the library's evaluators. One row per model."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    rows = cut_lineage(rows)
    mine = {r[name]: r for r in ev.ranking_metrics(rows, "score", "label", [name], pred="prediction").collect()}
    counts = {r[name]: r for r in rows.groupBy(name).agg(F.count("*").alias("n"), F.sum("label").alias("p")).collect()}
    lib = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    out = []
    for k, m in sorted(mine.items()):
        own = rows.where(F.col(name) == k)
        roc, pr = (lib.setMetricName(x).evaluate(own) for x in ("areaUnderROC", "areaUnderPR"))
        close = abs(roc - m["roc_auc"]) < 1e-9 and abs(pr - m["pr_auc"]) < 1e-9
        fits = all(0.0 <= m[x] <= 1.0 for x in ("accuracy", "roc_auc", "pr_auc"))
        out.append((k, int(counts[k]["n"]), float(counts[k]["p"]), fits, close))
    return spark.createDataFrame(out, f"{name} string, n_test long, n_positive double, in_range boolean, as_library boolean")


def _checked_sql(name: str, values: list) -> str:
    listed = ", ".join(f"('{v}')" for v in values)
    return W(f"""
SELECT v.{name}, t.n_test, t.n_positive, true AS in_range, true AS as_library
FROM (VALUES {listed}) v({name}), (SELECT count(*) AS n_test, sum(label) AS n_positive FROM labelled WHERE {_TEST_U} >= 0.6) t""",
             "labelled")


def _eval(spark, sf, **models):
    """Fit (estimator, stages) per name on the training side, check on the rest."""
    train, test = _split(spark, sf)
    preds = {n: cl.fit(train, est, stages).transform(test) for n, (est, stages) in models.items()}
    return _checked(cl.scored_models(preds), "model", spark)


@query("cls01_logistic", _checked_sql("model", ["logistic"]))
def logistic(spark, sf):
    return _eval(spark, sf, logistic=(cl.logistic(10), cl.features_pipeline(NUMS)))


def _scaled(spark, sf):
    train, test = _split(spark, sf)
    return cl.fit_features(train, test, cl.features_pipeline(NUMS, "lang", scale=True))


def _width(df) -> int:
    row = df.select(F.size(vector_to_array("features")).alias("n")).first()
    return row["n"] if row else 1


@query("cls02_logistic_gd", _checked_sql("model", ["logistic_gd"]))
def logistic_gd(spark, sf):
    """Logistic regression by gradient steps on scaled category and numbers."""
    tr, te = _scaled(spark, sf)
    m = cl.logistic_gd(_width(tr), 10, 1.0).fit(tr)
    return _checked(cl.scored_models({"logistic_gd": m.transform(te)}), "model", spark)


@query("cls03_svm", _checked_sql("model", ["svm"]))
def svm(spark, sf):
    return _eval(spark, sf, svm=(cl.svm(10), cl.features_pipeline(NUMS, scale=True)))


@query("cls04_svm_raw_scores", W(f"""
SELECT doc_id, label, true AS scored FROM labelled WHERE {_TEST_U} >= 0.6""", "labelled"))
def svm_raw(spark, sf):
    """SVM (100 iterations) raw margins on held-out rows, threshold cleared."""
    train, test = _split(spark, sf)
    model = cl.fit(train, cl.svm(100), cl.features_pipeline(NUMS, scale=True))
    score = vector_to_array("rawPrediction")[1]
    return model.transform(test).select("doc_id", "label", (score.isNotNull() & ~F.isnan(score)).alias("scored"))


@query("cls05_bayes", _checked_sql("model", ["bayes"]))
def bayes(spark, sf):
    return _eval(spark, sf, bayes=(cl.bayes(1.0), cl.features_pipeline(NUMS)))


@query("cls06_tree", _checked_sql("model", ["tree"]))
def tree(spark, sf):
    return _eval(spark, sf, tree=(cl.tree(5, "entropy"), cl.features_pipeline(NUMS)))


@query("cls07_predict", W(f"""
SELECT doc_id, label, true AS is_class FROM labelled WHERE {_TEST_U} >= 0.6""", "labelled"))
def predict(spark, sf):
    train, test = _split(spark, sf)
    model = cl.fit_logistic(train, 10, stages=cl.features_pipeline(NUMS))
    return cl.predict(model, test).select("doc_id", "label", F.col("prediction").isin(0.0, 1.0).alias("is_class"))


@query("evl05_fitted_models", _checked_sql("model", ["bayes", "logistic", "svm", "tree"]))
def fitted_models(spark, sf):
    """EVL-5: the four fitted classifiers in one table."""
    plain, scaled = cl.features_pipeline(NUMS), cl.features_pipeline(NUMS, scale=True)
    return _eval(spark, sf, logistic=(cl.logistic(10), plain), svm=(cl.svm(10), scaled), bayes=(cl.bayes(1.0), plain),
                 tree=(cl.tree(5, "entropy"), plain))


@query("fea02_scaled_vs_unscaled", _checked_sql("model", ["unscaled", "scaled"]))
def scaled_vs_unscaled(spark, sf):
    return _eval(spark, sf, unscaled=(cl.logistic(10), cl.features_pipeline(NUMS)),
                 scaled=(cl.logistic(10), cl.features_pipeline(NUMS, scale=True)))


@query("fea03_category_model", _checked_sql("model", ["category+numbers"]))
def category_model(spark, sf):
    return _eval(spark, sf, **{"category+numbers": (cl.logistic(10), cl.features_pipeline(NUMS, category="lang", scale=True))})


@query("fea04_category_bayes", _checked_sql("model", ["category bayes"]))
def category_bayes(spark, sf):
    return _eval(spark, sf, **{"category bayes": (cl.bayes(1.0), cl.features_pipeline([], category="lang"))})


def _sweep(spark, sf, make, values, param, stages):
    train, test = _split(spark, sf)
    tr, te = cl.fit_features(train, test, stages)
    tr, te = cut_lineage(tr), cut_lineage(te)  # the stages are fitted and applied once
    return _checked(cl.scored_models({str(v): make(v, tr).fit(tr).transform(te) for v in values}, name=param), param, spark)


@query("tun01_iterations", _checked_sql("iterations", ITERATIONS))
def sweep_iterations(spark, sf):
    return _sweep(spark, sf, lambda v, _: cl.logistic(v), ITERATIONS, "iterations",
                  cl.features_pipeline(NUMS, "lang", scale=True))


@query("tun02_step_size", _checked_sql("step", STEPS))
def sweep_step(spark, sf):
    """Step sizes of the gradient solver, on scaled category and numbers."""
    return _sweep(spark, sf, lambda v, tr: cl.logistic_gd(_width(tr), 10, v), STEPS, "step",
                  cl.features_pipeline(NUMS, "lang", scale=True))


@query("tun03_l2", _checked_sql("penalty", PENALTIES))
def sweep_l2(spark, sf):
    return _sweep(spark, sf, lambda v, _: cl.logistic(10, v), PENALTIES, "penalty",
                  cl.features_pipeline(NUMS, "lang", scale=True))


@query("tun04_depth", _checked_sql("depth", DEPTHS))
def sweep_depth(spark, sf):
    return _sweep(spark, sf, lambda v, _: cl.tree(v, "entropy"), DEPTHS, "depth", cl.features_pipeline(NUMS))


@query("tun05_smoothing", _checked_sql("smoothing", SMOOTHINGS))
def sweep_smoothing(spark, sf):
    return _sweep(spark, sf, lambda v, _: cl.bayes(v), SMOOTHINGS, "smoothing", cl.features_pipeline([], category="lang"))


@query("tun06_holdout", _checked_sql("penalty", HOLDOUT_PENALTIES))
def sweep_holdout(spark, sf):
    """Train on 60 %, choose on the rest; the split is by key hash, so it is the
    same on any cluster."""
    return _sweep(spark, sf, lambda v, _: cl.logistic(10, v), HOLDOUT_PENALTIES, "penalty",
                  cl.features_pipeline(NUMS, "lang", scale=True))


# --- clustering: exact pieces on label centroids ----------------------------------------------

_KM_SQL = CENTROIDS_SQL + """
, cidx AS (SELECT label AS clabel, row_number() OVER (ORDER BY label) - 1 AS cluster, center FROM centroids)
, v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS a FROM embeddings)
, d AS (SELECT vec_id, label, cluster,
               list_sum(list_transform(list_zip(a, center), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS dist
        FROM v, cidx)
, best AS (SELECT vec_id, label, cluster::INTEGER AS cluster, dist AS distance FROM (
             SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, cluster) AS r FROM d) WHERE r = 1)
"""


def _assigned(spark, sf):
    _, centers = km.collect_centers(label_centroids(spark, sf), "label")  # k x d model numbers
    return km.assign(fx.vectors(spark, sf), "embedding", centers)


@query("km02_centroids", "WITH dummy AS (SELECT 1)" + CENTROIDS_SQL + """
SELECT label, (dim - 1)::INTEGER AS dim, round(x, 6) AS value FROM m""")
def centroids(spark, sf):
    c = label_centroids(spark, sf)
    return rounded(c.select("label", F.posexplode("center").alias("dim", "value")))


@query("km03_assign", "WITH dummy AS (SELECT 1)" + _KM_SQL + "SELECT vec_id, cluster FROM best")
def assign(spark, sf):
    return _assigned(spark, sf).select("vec_id", "cluster")


@query("km04_wcss", "WITH dummy AS (SELECT 1)" + _KM_SQL + "SELECT round(sum(distance), 6) AS wcss FROM best")
def wcss(spark, sf):
    _, centers = km.collect_centers(label_centroids(spark, sf), "label")
    return rounded(km.wcss(fx.vectors(spark, sf), "embedding", centers))


@query("km05_assign_report", "WITH dummy AS (SELECT 1)" + _KM_SQL + """
SELECT vec_id, label, cluster, round(distance, 6) AS distance FROM best""")
def assign_report(spark, sf):
    _, centers = km.collect_centers(label_centroids(spark, sf), "label")
    return rounded(km.assign_report(fx.vectors(spark, sf), "embedding", centers, ["vec_id", "label"]))


@query("km06_closest_per_cluster", "WITH dummy AS (SELECT 1)" + _KM_SQL + """
SELECT cluster, vec_id, round(distance, 6) AS distance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY distance, vec_id) AS rank FROM best) WHERE rank <= 20""")
def closest_per_cluster(spark, sf):
    a = _assigned(spark, sf)
    top = rel.top_n_per_group(a, "cluster", ["distance", "vec_id"], 20)
    return rounded(top.select("cluster", "vec_id", "distance", F.col("rank").cast("long")))


@query("prj11_annotate_line", "WITH dummy AS (SELECT 1)" + _KM_SQL + """
SELECT vec_id, concat_ws(' ', vec_id, cluster) AS line FROM best""")
def annotate_line(spark, sf):
    a = _assigned(spark, sf)
    return a.select("vec_id", sh.annotate_line(F.col("vec_id").cast("string"), "cluster").alias("line"))


# --- clustering on ALS factors ------------------------------------------------------------------


def _factors(spark, sf):
    def build():
        users, items = rc.Recommender(rated(spark, sf), **ALS_FOR_CLUSTERS).factors()
        return {"users": cut_lineage(users), "items": cut_lineage(items)}
    return cached_model(spark, ("als-for-clusters", sf), build)


def _factor_clusters(spark, sf, entity: str):
    f = _factors(spark, sf)[entity]
    m = cached_model(spark, ("factor-clusters", entity, sf), lambda: km.fit_kmeans(f, "features", 5, 10, runs=3)[0])
    return km.assign(f, "features", km.model_centers(m))


@query("km05_factor_report", W("""
, rated AS (SELECT DISTINCT item AS id FROM ratings)
, e AS (SELECT id, unnest(flags) AS flag, generate_subscripts(flags, 1) - 1 AS pos FROM items)
, d AS (SELECT e.id, string_agg(g.name, ' ' ORDER BY e.pos) AS genres
        FROM e JOIN genres g ON e.pos = g.idx WHERE flag = '1' GROUP BY e.id)
SELECT r.id, i.title, coalesce(d.genres, '') AS genres, true AS assigned
FROM rated r JOIN items i ON r.id = i.id LEFT JOIN d ON r.id = d.id""", "genres", "ratings", "items"))
def factor_report(spark, sf):
    """ALS factors -> k-means -> items with title, genres, cluster and distance."""
    a = _factor_clusters(spark, sf, "items")
    named = sh.decode_flags(fx.items(spark, sf), fx.genres(spark, sf))
    ok = F.col("cluster").between(0, 4) & (F.col("distance") >= 0)
    return a.join(named, "id").select("id", "title", "genres", ok.alias("assigned"))


@query("km06_factor_closest", """
SELECT entity, true AS at_most_20, true AS ranked FROM (VALUES ('items'), ('users')) v(entity)""")
def factor_closest(spark, sf):
    """The 20 members closest to each centre, for items and for users."""
    rows = []
    for entity in ("items", "users"):
        top = rel.top_n_per_group(_factor_clusters(spark, sf, entity), "cluster", ["distance", "id"], 20)
        per = top.groupBy("cluster").agg(F.count("*").alias("n"), F.max("rank").alias("last"))
        rows.append(per.agg(F.bool_and(F.col("n") <= 20).alias("at_most_20"), F.bool_and(F.col("n") == F.col("last")).alias("ranked"))
                    .select(F.lit(entity).alias("entity"), "at_most_20", "ranked"))
    return rel.union_all(rows)


@query("km07_sweep_k", f"""
SELECT entity, k, true AS scored, true AS not_above_first
FROM (VALUES ('items'), ('users')) v(entity), (SELECT unnest({CLUSTER_COUNTS})::INTEGER AS k) s""")
def sweep_k(spark, sf):
    """WCSS on held-out factors for several k (best of 3 restarts each), items and
    users; the training cost never rises above that of the smallest k."""
    rows = []
    for entity, f in _factors(spark, sf).items():
        train, test = rel.split_by_hash(f, "id", 0.6, 123)
        s = km.sweep_k(train, test, "features", CLUSTER_COUNTS, 10, 3)
        first = s.orderBy("k").first()["train_cost"]
        rows.append(s.select(F.lit(entity).alias("entity"), "k", (F.col("wcss") > 0).alias("scored"),
                             (F.col("train_cost") <= F.lit(first)).alias("not_above_first")))
    return rel.union_all(rows)


# --- clustering / reduction with fitted models -----------------------------------------------------


def _vectors_ml(spark, sf):
    return rd.to_vectors(fx.vectors(spark, sf), "embedding")


@query("km01_fit_kmeans", """
SELECT run, cluster, (SELECT max(len(embedding)) FROM embeddings)::INTEGER AS dim, true AS not_above_cost
FROM (VALUES ('10 iterations, best of 3'), ('100 iterations')) v(run), (SELECT unnest(range(0, 5))::INTEGER AS cluster) c""")
def fit_kmeans(spark, sf):
    """k=5 by 10 iterations (best of 3 restarts) and by 100; one row per centre.
    The exact sum of squared distances to the centres is no more than the cost the
    model reports (that of its last assignment, before the centres moved)."""
    v = cut_lineage(fx.vectors(spark, sf))
    out = []
    for run, iterations, runs in (("10 iterations, best of 3", 10, 3), ("100 iterations", 100, 1)):
        m, cost = km.fit_kmeans(v, "embedding", 5, iterations, runs=runs)
        centers = km.model_centers(m)
        exact = km.wcss(v, "embedding", centers).first()["wcss"]
        out += [(run, i, len(c), exact <= cost * (1 + 1e-9)) for i, c in enumerate(centers)]
    return spark.createDataFrame(out, "run string, cluster int, dim int, not_above_cost boolean")


def _centred(spark, sf):
    return cut_lineage(rd.centre(_vectors_ml(spark, sf), "features", "centred").select("vec_id", "centred"))


def _components(v) -> int:
    return min(10, len(v.select(vector_to_array("centred")).first()[0]))


@query("dim02_pca", """
SELECT vec_id, least(10, len(embedding)) AS n, true AS as_components FROM embeddings""")
def pca(spark, sf):
    """Projection on the first components: equal to the dot products with them."""
    v = _centred(spark, sf)
    model, proj = rd.pca(v, _components(v), "centred")
    again = rd.project(proj, model.pc.toArray(), "centred")
    p = vector_to_array("pca")
    return again.select("vec_id", F.size(p).cast("long").alias("n"),
                        F.forall(F.zip_with(p, "projected", lambda a, b: F.abs(a - b)), lambda x: x < 1e-9).alias("as_components"))


@query("dim02_covariance", """
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
SELECT a.i::INTEGER AS i, b.i::INTEGER AS j, round(covar_samp(a.x, b.x), 6) AS value
FROM e a JOIN e b USING (vec_id) GROUP BY 1, 2""")
def covariance(spark, sf):
    return rounded(rd.covariance(_vectors_ml(spark, sf)))


@query("dim03_svd", """
SELECT i::INTEGER AS i, true AS positive, true AS descending
FROM (SELECT unnest(range(1, (SELECT least(10, max(len(embedding))) FROM embeddings) + 1)) AS i)""")
def svd(spark, sf):
    v = _centred(spark, sf)
    s, _ = rd.svd(v, _components(v), "centred")
    return spark.createDataFrame([(i + 1, x > 0, i == 0 or s[i - 1] >= x) for i, x in enumerate(s)],
                                 "i int, positive boolean, descending boolean")


@query("dim04_project", """
SELECT vec_id, least(10, len(embedding)) AS n, true AS as_pca FROM embeddings""")
def project(spark, sf):
    """Rows times V (U x diag(s), with ids) equal PCA's projection up to sign."""
    v = _centred(spark, sf)
    k = _components(v)
    _, vt = rd.svd(v, k, "centred")
    both = rd.project(rd.pca(v, k, "centred")[1], vt, "centred")
    same = F.forall(F.zip_with(vector_to_array("pca"), "projected", lambda a, b: F.abs(F.abs(a) - F.abs(b))), lambda x: x < 1e-6)
    return both.select("vec_id", F.size("projected").cast("long").alias("n"), same.alias("as_pca"))


@query("dim05_singular_values", """
SELECT i::INTEGER AS i, true AS positive, true AS descending
FROM (SELECT unnest(range(1, (SELECT least(300, max(len(embedding))) FROM embeddings) + 1)) AS i)""")
def singular_values(spark, sf):
    v = _centred(spark, sf)
    d = len(v.select(vector_to_array("centred")).first()[0])
    s = rd.singular_values(v, min(300, d), "centred")
    before = F.lag("value").over(Window.orderBy("i"))  # at most 300 rows
    return s.select("i", (F.col("value") > 0).alias("positive"), (before.isNull() | (before >= F.col("value"))).alias("descending"))
