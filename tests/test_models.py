"""Model invariants (fitted models have no exact oracle)."""
import math

import numpy as np
from pyspark.sql import functions as F

from quarry.functions.scalar import approx_equal
from quarry.operators import cluster as km
from quarry.operators import recommend as rc
from quarry.operators import reduce as rd
from quarry.plans import fixtures as fx
from tests.conftest import SF_SMALL


def test_kmeans_near_points_share_cluster(spark):
    pts = [[0.0, 0.0, 0.0], [0.1, 0.1, 0.1], [0.2, 0.2, 0.2], [9.0, 9.0, 9.0], [9.1, 9.1, 9.1], [9.2, 9.2, 9.2]]
    df = spark.createDataFrame([(p,) for p in pts], "v array<double>")
    m, cost = km.fit_kmeans(df, "v", 2, 20, runs=2)
    centers = km.model_centers(m)
    probe = spark.createDataFrame([([0.2] * 3,), ([0.25] * 3,), ([8.0] * 3,)], "v array<double>")
    c = [r["cluster"] for r in km.assign(probe, "v", centers).collect()]
    assert c[0] == c[1] != c[2]
    assert math.isclose(km.wcss(df, "v", centers).first()[0], cost, rel_tol=1e-9)


def test_wcss_falls_with_k(spark):
    v = fx.vectors(spark, SF_SMALL)
    costs = {r["k"]: r["wcss"] for r in km.sweep_k(v, v, "embedding", [2, 5, 10], 10).collect()}
    assert costs[2] > costs[5] > costs[10]


def test_svd_and_pca(spark):
    v = rd.centre(rd.to_vectors(fx.vectors(spark, SF_SMALL), "embedding"), "features", "c")
    s, vt = rd.svd(v, 5, "c")
    assert all(a >= b for a, b in zip(s, s[1:]))
    assert np.allclose(vt.T @ vt, np.eye(5), atol=1e-8)
    model, proj = rd.pca(v, 5, "c")
    from pyspark.ml.functions import vector_to_array
    pairs = rd.project(proj, vt, "c").select("vec_id", vector_to_array("pca").alias("a"), F.col("projected").alias("b"))
    assert pairs.select("vec_id").distinct().count() == v.count()
    assert pairs.where(~approx_equal("a", "b", 1e-6)).count() == 0


def test_als_beats_mean_baseline(spark):
    r = fx.ratings(spark, SF_SMALL)
    m = rc.Recommender(r, rank=10, max_iter=10, reg=0.1)
    pred = m.predict(r)
    rmse = math.sqrt(pred.agg(F.avg(F.pow(F.col("prediction") - F.col("rating"), 2))).first()[0])
    mean = r.agg(F.avg("rating")).first()[0]
    base = math.sqrt(r.agg(F.avg(F.pow(F.col("rating") - F.lit(mean), 2))).first()[0])
    assert rmse < base
    recs = m.top_all(5)
    assert recs.groupBy("user").count().where("count > 5").count() == 0


def test_als_deletes_the_files_of_earlier_iterations(spark):
    """While a fit runs, files of a few iterations lie on disk, not those of all."""
    def shuffles():
        return spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    r = spark.createDataFrame([(u, i, float((3 * u + i) % 5 + 1)) for u in range(30) for i in range(20)], "user int, item int, rating double")
    left = []
    for iterations in (3, 9):
        before = shuffles()
        model = rc.fit_als(r, rank=2, max_iter=iterations)
        left.append(shuffles() - before)
        assert model.userFactors.count() == 30
    assert left[1] <= left[0] + 4      # two shuffles an iteration


def test_als_keeps_the_files_of_one_iteration(spark):
    """The files of an iteration are gone when the next one has its factors: of a fit of
    four, those of the ratings' blocks and of the last user factors are left."""
    def shuffles():
        ids = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().keys().toSeq().mkString(",")
        return {int(x) for x in ids.split(",") if x}
    r = spark.createDataFrame([(u, i, float((3 * u + i) % 5 + 1)) for u in range(30) for i in range(20)], "user int, item int, rating double")
    before = shuffles()
    model = rc.fit_als(r, rank=2, max_iter=4)
    assert len(shuffles() - before) < 5
    assert model.userFactors.count() == 30


def test_als_blocks_bound_what_a_task_receives(spark, monkeypatch):
    """Ten blocks as long as the factors that one receives fit; more for more ratings."""
    assert rc.als_blocks(600_000, 15_000, 20_000, 50) == rc.als_blocks(36_000_000, 900_000, 1_200_000, 50) == rc.als_blocks(0, 0, 0, 50) == 10
    many = rc.als_blocks(216_000_000, 5_400_000, 7_200_000, 50)
    for m in (5_400_000, 7_200_000):
        assert m * -math.expm1(-216_000_000 / many / m) * 240 <= rc.BLOCK_BYTES < m * 240
    seen, fit = [], rc.fit_als
    monkeypatch.setattr(rc, "fit_als", lambda *a, **p: seen.append(p["blocks"]) or fit(*a, **p))
    monkeypatch.setattr(rc, "BLOCK_BYTES", 600)
    r = spark.createDataFrame([(u, i, float((3 * u + i) % 5 + 1)) for u in range(30) for i in range(20)], "user long, item long, rating double")
    m = rc.Recommender(r, rank=2, max_iter=2, reg=0.1)
    assert seen[0] > 10 and m.predict(r).count() == 600


def test_all_pairs_are_the_librarys(spark, monkeypatch):
    """Every user's list has the library's scores, without the library's pair by pair search."""
    rng = np.random.default_rng(5)
    r = spark.createDataFrame([(u, i, float(rng.integers(1, 6))) for u in range(40) for i in range(25) if rng.random() < 0.6], "user long, item long, rating double")
    m = rc.Recommender(r, rank=3, max_iter=3, reg=0.1)
    lib = {x["user_idx"]: [y["rating"] for y in x["recommendations"]] for x in m.model.recommendForAllUsers(4).collect()}
    monkeypatch.setattr(type(m.model), "recommendForAllUsers", None)
    got = rc.recommend_all(m.model, 4, "item_idx").collect()
    assert {x["user_idx"] for x in got} == set(lib) and len(got) == 160
    for x in got:
        assert math.isclose(x["score"], lib[x["user_idx"]][x["pos"] - 1], rel_tol=1e-5, abs_tol=1e-6)


def test_similar_items_skips_self(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 1.0]), (4, [1.0, 0.05])],
                              "id int, features array<double>")
    got = [r["id"] for r in rc.similar_items(v, 1, 2).collect()]
    assert got == [4, 2]
    # an equal vector of another item is the best neighbour, never the item itself
    twin = v.union(spark.createDataFrame([(0, [0.9, 0.1])], "id int, features array<double>"))
    assert [r["id"] for r in rc.similar_items(twin, 2, 2).collect()] == [0, 4]


def test_libsvm_svm_raw_scores_auc(spark, tmp_dir):
    """SRC-4 + CLS-4: vectors written as LibSVM, read back, 60/40 split,
    linear SVM (100 iterations) raw margins, area under ROC."""
    import os

    from quarry.operators import classify as cl
    from quarry.operators.evaluate import roc_auc
    from quarry.operators.relational import split_rows
    from quarry.sources.readers import read_libsvm
    v = rd.to_vectors(fx.vectors(spark, SF_SMALL), "embedding")
    data = v.select((F.col("label") >= 5).cast("double").alias("label"), "features")
    out = os.path.join(tmp_dir, "libsvm")
    data.write.format("libsvm").save(out)
    back = read_libsvm(spark, out, 64)
    assert back.count() == data.count()
    train, test = split_rows(back.withColumn("key", F.monotonically_increasing_id()), [0.6, 0.4], 11, "key")
    model = cl.fit(train, cl.svm(100))
    from pyspark.ml.functions import vector_to_array
    scores = model.transform(test).select("label", vector_to_array("rawPrediction")[1].alias("score"))
    auc = roc_auc(scores, "score").first()[0]
    assert 0.0 <= auc <= 1.0


def test_nearest_words_exact_matches_library(spark):
    from quarry.operators import text as tx
    arrays = tx.doc_token_arrays(fx.docs(spark, SF_SMALL), tx.term_stats(fx.tokens(spark, SF_SMALL)))
    m = tx.word_vectors(arrays, size=20, min_count=2)
    word = m.getVectors().orderBy("word").first()["word"]
    lib = {r["word"] for r in tx.nearest_words(m, word, 5).collect()}
    exact = {r["word"] for r in tx.nearest_words_exact(m.getVectors(), word, 5).collect()}
    assert len(lib & exact) >= 4


def test_token_arrays_keep_text_order(spark):
    """The tokens fed to the model are the filtered text, in order."""
    from quarry.operators import text as tx
    docs = spark.createDataFrame([(1, "alpha beta gamma Alpha the beta, gamma alpha"), (2, "beta x9 gamma delta alpha")],
                                 "doc_id long, text string").repartition(2)
    kept = tx.term_stats(tx.tokens_word(docs))
    got = {r["doc_id"]: r["tokens"] for r in tx.doc_token_arrays(docs, kept).collect()}
    assert got == {1: "alpha beta gamma alpha beta gamma alpha".split(), 2: "beta gamma alpha".split()}


def test_recommender_keeps_64bit_ids(spark):
    big = 10 ** 12
    r = spark.createDataFrame([(big + u, 2 * big + i, float((u * i) % 5 + 1)) for u in range(6) for i in range(5)],
                              "user long, item long, rating double")
    m = rc.Recommender(r, rank=2, max_iter=3, reg=0.1)
    users, items = m.factors()
    assert {x["id"] for x in users.collect()} == {big + u for u in range(6)}
    assert {x["id"] for x in items.collect()} == {2 * big + i for i in range(5)}
    assert m.predict(r).count() == 30
    top = m.top(spark.createDataFrame([(big + 1,)], "user long"), 3).collect()
    assert len(top) == 3 and all(x["item"] >= 2 * big for x in top)


def test_dense_ids_for_64bit_keys(spark):
    big = 10 ** 12
    r = spark.createDataFrame([(big + u, big * 2 + i, float(u + i)) for u in range(5) for i in range(4)],
                              "user long, item long, rating double")
    r1, users = rc.dense_ids(r, "user", "u")
    r2, items = rc.dense_ids(r1, "item", "i")
    assert sorted(x["u"] for x in users.collect()) == list(range(5))
    m = rc.fit_als(r2.select("u", "i", "rating"), rank=2, max_iter=3, user="u", item="i")
    assert m.userFactors.count() == 5


def test_hash_unit_no_overflow(spark):
    from quarry.operators.relational import hash_unit
    df = spark.createDataFrame([(9_000_000_000_000_000,), (7,)], "k long")
    vals = [r[0] for r in df.select(hash_unit("k", 42)).collect()]
    assert all(0.0 <= v < 1.0 for v in vals)
    assert vals[1] == ((7 * 2654435761 + 42) % 1000003) / 1000003.0


def test_kept_words_and_arrays_need_no_row_per_document(spark):
    from quarry.operators import text as tx
    docs = spark.createDataFrame([(1, "en", "Cat sat the a1 cat x"), (2, "en", "sat dog-fox dog"), (2, "en", "fox the"), (None, "en", "owl cat"), (3, "en", None)],
                                 "doc_id long, topic string, text string")
    tokens = tx.tokens_word(docs)
    words = tx.kept_words(tokens)
    assert {r["tok"]: r["n"] for r in words.collect()} == {"cat": 3, "sat": 2, "dog": 2, "fox": 2}
    assert {r["tok"] for r in tx.term_stats(tokens).select("tok").distinct().collect()} == {"cat", "sat", "dog", "fox"}
    assert tx.kept_words(tokens)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    plain, clean = ({r["doc_id"]: r["tokens"] for r in tx.doc_token_arrays(docs, words, clean=c).collect()} for c in (False, True))
    assert plain == clean and clean[1] == ["cat", "sat", "cat"] and clean[None] == ["cat"] and sorted(clean[2]) == ["dog", "dog", "fox", "fox", "sat"]


def test_kept_frequencies_send_no_row_per_document_and_word(spark):
    """The rows of the full tokenizer, also for documents without an id, with one that
    repeats, and for higher limits of rareness; words are counted where their document lies."""
    import re

    from quarry.operators import text as tx
    from quarry.session import by_key
    d = spark.createDataFrame([(1, "Red blue once the 4you"), (1, "blue red"), (2, "green blue twice"), (None, "twice nulls sky"),
                               (None, "sky alone"), (3, ""), (4, None), (5, "green green only")], "doc_id long, text string")
    rows = lambda x: sorted(map(str, x.select("doc_id", "tok", "tf").collect()))
    tokens = tx.tokens_word(d).where("tok <> 'once'").unionAll(spark.createDataFrame([(9, "solo")], "doc_id long, tok string"))
    for below in (1, 2, 3, 4):
        assert rows(tx.kept_frequencies(tokens, rare_below=below)) == rows(tx.term_stats(tokens, rare_below=below))
    kept = tx.kept_frequencies(tx.tokens_word(by_key(d, "doc_id")))
    assert rows(kept) == rows(tx.term_stats(tx.tokens_word(d))) != []
    sent = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", kept._jdf.queryExecution().executedPlan().toString())
    assert sent and not any("doc_id" in x and "tok" in x for x in sent)


def test_short_jobs_of_a_fit_meet_few_partitions(spark, tmp_dir):
    from quarry.plans import q_models, q_solvers
    docs = spark.range(600).selectExpr("id AS doc_id", "repeat('a b ', cast(id % 5 AS int)) AS text", "'en' AS lang", "'web' AS source", "id AS n_chars")
    docs.repartition(30).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.range(0, 600, 2).selectExpr("id AS doc_id", "cast(id % 4 / 2 AS int) AS quality", "0 AS toxic").write.parquet(f"{tmp_dir}/labels.parquet")
    for module in (q_models, q_solvers):
        train, test = module._split(spark, tmp_dir)
        assert train.rdd.getNumPartitions() == test.rdd.getNumPartitions() == 1
        rows = {r["doc_id"]: r["n_words"] for r in train.unionByName(test).collect()}
        assert rows == {i: 2.0 * (i % 5) + 1 for i in range(0, 600, 2)}


def test_words_of_a_fit_are_made_once(spark, monkeypatch):
    """Fits read their documents' words several times; they read what was made once."""
    from quarry.operators import text as tx
    from quarry.plans import q_text
    made, make = [], tx.doc_token_arrays
    monkeypatch.setattr(tx, "doc_token_arrays", lambda *a, **p: made.append(1) or make(*a, **p))
    a, b = q_text.stored_arrays(spark, SF_SMALL), q_text.stored_arrays(spark, SF_SMALL)
    assert len(made) <= 1 and "Exchange" not in a._jdf.queryExecution().executedPlan().toString()
    rows = lambda d: sorted((r["doc_id"], r["tokens"]) for r in d.collect())
    assert rows(a) == rows(b) == rows(q_text.token_arrays(spark, SF_SMALL)) != []
    kept, seen = q_text.stored, []
    monkeypatch.setattr(q_text, "stored", lambda d, name: seen.append(name) or kept(d, name))
    assert q_text.topic_classifier(spark, SF_SMALL).count() == 2 and seen == ["train-words"]
