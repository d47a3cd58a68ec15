"""Multinomial naive Bayes in closed form over long-form rows (SURVEY CLS-5, TXT-11,
TXT-12, FEA-4, TUN-5).

A row is (key, term, x): a term's weight in a document, a category's 1, or a
number under its column's name. Fitting is one aggregation per (class, term);
scoring is one join on the term. No hashing, so no two terms collide, and no
vector as wide as the vocabulary.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import by_key, cut_lineage


@dataclass
class TermBayes:
    """``weights(term, label, w)``: what a unit of the term adds to a class's score
    over an unseen term; the classes' numbers, one entry per class."""
    weights: DataFrame
    vocabulary: DataFrame
    classes: list[tuple[object, float, float]]     # label, log prior, log-likelihood of an unseen term
    smoothing: float


def fit(rows: DataFrame, docs: DataFrame, smoothing: float = 1.0, key: str = "doc_id", label: str = "label",
        term: str = "term", x: str = "x") -> TermBayes:
    """``docs(key, label)``: the training documents, also those without a term;
    ``rows(key, term, x)``: their weights, which must not be negative.

    likelihood = (sum of x of class and term + s) / (sum of x of class + s V),
    prior = (documents of class + s) / (documents + s C). Only the C class totals
    reach the driver. Null labels, terms and weights are left out."""
    known = rows.where(F.col(term).isNotNull() & F.col(x).isNotNull()).select(key, F.col(term).alias("term"), F.col(x).cast("double").alias("x"))
    labels = docs.where(F.col(label).isNotNull()).select(key, F.col(label).alias("label"))
    return fit_sums(known.join(labels, key).groupBy("term", "label").agg(F.sum("x").alias("x")), docs, smoothing, label)


def fit_sums(sums: DataFrame, docs: DataFrame, smoothing: float = 1.0, label: str = "label") -> TermBayes:
    """The same from ``sums(term, label, x)``, the weights summed by term and class."""
    if smoothing <= 0:
        raise ValueError("smoothing must be positive")
    docs = docs.where(F.col(label).isNotNull()).select(F.col(label).alias("label"))
    per = cut_lineage(sums)
    vocabulary = per.select("term").distinct()
    v = vocabulary.count()
    sums = {r["label"]: r["x"] for r in per.groupBy("label").agg(F.sum("x").alias("x")).collect()}
    sizes = {r["label"]: r["n"] for r in docs.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    classes = [(c, log((n + smoothing) / (total + smoothing * len(sizes))),
                log(smoothing / (sums.get(c, 0.0) + smoothing * v)) if v else 0.0) for c, n in sorted(sizes.items())]
    weights = per.select("term", "label", F.log((F.col("x") + smoothing) / F.lit(float(smoothing))).alias("w"))
    return TermBayes(weights, vocabulary, classes, smoothing)


def class_counts(rows: DataFrame, docs: DataFrame, key: str = "doc_id", label: str = "label", term: str = "term", x: str = "x") -> DataFrame:
    """``(term, label, x, n, df)`` of ``rows(key, term, x)``, one per key and term: ``x`` is
    the sum that ``fit`` takes; ``n`` and ``df`` sum the weights and count the rows of the
    keys that come with this label first, so over all labels each row counts once. Rows
    that lie by key (``session.by_key``) are combined where they are; only one row per
    term and class is sent."""
    each = by_key(docs, key).groupBy(key, F.col(label).alias("label")).agg(F.count("*").alias("_m"))
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.col("label").asc_nulls_last()))   # a document's labels
    each = each.withColumn("_f", (first == 1).cast("long"))
    met = rows.select(key, F.col(term).alias("term"), F.col(x).alias("x")).join(each.hint("shuffle_hash"), key)
    return met.groupBy("term", "label").agg(F.sum(F.col("x") * F.col("_m")).alias("x"), F.sum(F.col("x") * F.col("_f")).alias("n"),
                                            F.sum("_f").alias("df"))


def log_scores(model: TermBayes, rows: DataFrame, docs: DataFrame, key: str = "doc_id", term: str = "term", x: str = "x") -> DataFrame:
    """``(key, label, log_score)`` of every document and class. Terms the fit has not
    seen are left out; a document without a known term gets the priors. A fit
    without a class scores nothing."""
    if not model.classes:
        return docs.select(key, F.lit(None).cast("string").alias("label"), F.lit(0.0).alias("log_score")).limit(0)
    known = rows.where(F.col(x).isNotNull()).select(key, F.col(term).alias("term"), F.col(x).cast("double").alias("x"))
    # One join finds a term's weights in all classes that have it; the unseen
    # classes' part needs just the document's sum of known weights.
    per_term = model.weights.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("label", "w"))).alias("ws"))
    met = known.join(per_term.hint("shuffle_hash"), "term")
    gained = [F.sum(F.col("x") * F.coalesce(F.try_element_at("ws", F.lit(c)), F.lit(0.0))).alias(f"g{i}")
              for i, (c, _, _) in enumerate(model.classes)]
    sums = met.groupBy(key).agg(F.sum("x").alias("t"), *gained)
    zero = F.lit(0.0)
    each = [F.struct(F.lit(c).alias("label"), (F.lit(prior) + F.coalesce("t", zero) * F.lit(unseen) + F.coalesce(f"g{i}", zero)).alias("log_score"))
            for i, (c, prior, unseen) in enumerate(model.classes)]
    return docs.select(key).join(sums, key, "left").select(key, F.inline(F.array(*each)))


def predictions(scores: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, prediction, log_score)``: the class with the best score, the first on a
    tie (scores are compared to nine digits)."""
    best = scores.groupBy(key).agg(F.min(F.struct((-F.round("log_score", 9)).alias("s"), "label", "log_score")).alias("b"))
    return best.select(key, F.col("b.label").alias("prediction"), F.col("b.log_score").alias("log_score"))


def probability(scores: DataFrame, positive, key: str = "doc_id") -> DataFrame:
    """``(key, score)``: the normalised probability of one class."""
    top = scores.groupBy(key).agg(F.max("log_score").alias("_top"), F.collect_list(F.struct("label", "log_score")).alias("_s"))
    part = lambda s: F.exp(s["log_score"] - F.col("_top"))
    whole = F.aggregate("_s", F.lit(0.0), lambda a, s: a + part(s))
    own = F.aggregate(F.filter("_s", lambda s: s["label"] == F.lit(positive)), F.lit(0.0), lambda a, s: a + part(s))
    return top.select(key, (own / whole).alias("score"))
