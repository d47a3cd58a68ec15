import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import term_bayes as B
from quarry.session import by_key

TRAIN = [(1, "x", "a a b"), (2, "x", "a c"), (3, "y", "c c d"), (4, "y", "d"), (5, "z", ""), (6, None, "a b"), (7, "x", "a a a")]
TEST = [(10, "a b"), (11, "c d new"), (12, ""), (13, "new words"), (14, "a a c d b")]


def terms(spark, rows):
    out = [(k, t, float(n)) for k, text in rows for t, n in Counter(text.split()).items()]
    return spark.createDataFrame(out, "doc_id long, term string, x double")


def by_hand(s):
    docs = [(c, Counter(t.split())) for _, c, t in TRAIN if c]
    classes = sorted({c for c, _ in docs})
    vocab = {t for _, d in docs for t in d}
    out = {}
    for k, text in TEST:
        for c in classes:
            own = sum((d for e, d in docs if e == c), Counter())
            score = math.log((sum(e == c for e, _ in docs) + s) / (len(docs) + s * len(classes)))
            for t in text.split():
                if t in vocab:
                    score += math.log((own[t] + s) / (sum(own.values()) + s * len(vocab)))
            out[k, c] = score
    return out


@pytest.mark.parametrize("s", [0.01, 1.0, 10.0])
def test_scores_equal_the_formula(spark, s):
    train = spark.createDataFrame([(k, c) for k, c, _ in TRAIN], "doc_id long, label string")
    model = B.fit(terms(spark, [(k, t) for k, _, t in TRAIN]), train, s)
    test = spark.createDataFrame([(k,) for k, _ in TEST], "doc_id long")
    got = {(r["doc_id"], r["label"]): r["log_score"] for r in B.log_scores(model, terms(spark, TEST), test).collect()}
    want = by_hand(s)
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], abs_tol=1e-9) for k in want)
    scores = B.log_scores(model, terms(spark, TEST), test)
    best = {r["doc_id"]: r["prediction"] for r in B.predictions(scores).collect()}
    for k, _ in TEST:
        assert best[k] == min("xyz", key=lambda c: (-round(want[k, c], 9), c))
    p = {r["doc_id"]: r["score"] for r in B.probability(scores, "x").collect()}
    for k, _ in TEST:
        assert math.isclose(p[k], math.exp(want[k, "x"]) / sum(math.exp(want[k, c]) for c in "xyz"), rel_tol=1e-9)


def test_library_agrees_on_dense_counts(spark):
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import VectorAssembler
    rows = [(i, float(i % 3 == 0), float(i % 5), float((i * 7) % 4), 1.0) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, label double, a double, b double, c double")
    lib = NaiveBayes(smoothing=0.5, modelType="multinomial").fit(VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df))
    long = df.select("doc_id", F.inline(F.array(*[F.struct(F.lit(x).alias("term"), F.col(x).alias("x")) for x in "abc"])))
    mine = B.fit(long, df, 0.5)
    assert [c for c, _, _ in mine.classes] == [0.0, 1.0]
    assert [p for _, p, _ in mine.classes] == pytest.approx(list(lib.pi))


def test_empty_tables_and_wrong_smoothing(spark):
    train = spark.createDataFrame([], "doc_id long, label string")
    none = terms(spark, [(1, "a")]).limit(0)
    model = B.fit(none, train)
    assert B.log_scores(model, none, spark.createDataFrame([(1,)], "doc_id long")).count() == 0
    with pytest.raises(ValueError):
        B.fit(none, train, 0.0)


def test_class_counts_are_what_the_fit_sums(spark):
    """Summed by class where the rows lie, also for keys that repeat, with other labels or none."""
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (1, "b"), (2, "a"), (3, None), (3, "b"), (4, None)], "doc_id long, label string")
    rows = spark.createDataFrame([(1, "x", 2.0), (1, "y", 1.0), (2, "x", 1.0), (3, "x", 4.0), (4, "z", 5.0), (5, "x", 9.0)], "doc_id long, term string, x double")
    sums = B.class_counts(rows, docs)
    known = {(r["term"], r["label"]): r["x"] for r in sums.collect()}
    assert known == {("x", "a"): 3.0, ("y", "a"): 1.0, ("x", "b"): 8.0, ("y", "b"): 2.0, ("x", None): 4.0, ("z", None): 5.0}
    per = {r["term"]: (r["n"], r["df"]) for r in sums.groupBy("term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")).collect()}
    assert per == {"x": (7.0, 3), "y": (1.0, 1), "z": (5.0, 1)}
    one, two = B.fit(rows, docs, 0.5), B.fit_sums(sums.where("label is not null").select("term", "label", "x"), docs, 0.5)
    assert one.classes == two.classes
    assert sorted(map(tuple, one.weights.collect())) == sorted(map(tuple, two.weights.collect()))


def test_topic_rows_are_not_sent_by_document_and_term(spark):
    """Words are counted where their document lies: the fit sends texts and one row per
    term and class, no row per document and term."""
    d = spark.createDataFrame([(i, "ab"[i % 2], f"w{i % 7} w{i % 3} common") for i in range(40)], "doc_id long, label string, text string")
    rows = by_key(d, "doc_id").select("doc_id", F.explode(F.split("text", " ")).alias("term")).groupBy("doc_id", "term").agg(F.count("*").cast("double").alias("x"))
    plan = B.class_counts(rows, d)._jdf.queryExecution().executedPlan().toString()
    sent = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert len(sent) == 3 and not any("doc_id" in x and "term" in x for x in sent)
