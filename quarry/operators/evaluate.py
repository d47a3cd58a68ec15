"""Exact evaluation metrics as DataFrame jobs.

* ROC AUC: tie-averaged ranks (Mann-Whitney) from per-score counts and a
  distributed running sum; equals the trapezoid ROC of the library.
* PR AUC: trapezoid over distinct scores (descending) with the first
  precision extended to recall 0, as the library's binary metrics do.
* AP@K / MAP: the hits of each user are found by an equi-join of the actual
  pairs with the predicted positions; the running hit count is a window over
  at most K rows per user (or a distributed group rank for full rankings).
  No per-user list is ever collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.ordered import prefix_sums, rank_within_groups
from quarry.operators.relational import running_sum
from quarry.session import sized_broadcast


def _is_pos(label: str) -> Column:
    return (F.col(label) > 0.5).cast("long")


def ranking_metrics(df: DataFrame, score: str, label: str = "label", by: list[str] | None = None,
                    pred: str | None = None) -> DataFrame:
    """EVL-2/3 (and EVL-1 with ``pred``): ``roc_auc`` and ``pr_auc`` of each group
    of ``by`` (few: one per model or parameter value), in one pass.

    Rows are counted per distinct score; one distributed running sum over
    (group, score) gives the positives and negatives below each score. Ties count
    one half in ROC; PR is the trapezoid over distinct scores with the first
    precision extended to recall 0. Counts enter products as doubles, so
    billions of rows do not overflow."""
    by = by or []
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("_all"))
    hit = (F.col(pred) == F.col(label)).cast("long") if pred else F.lit(0).cast("long")
    pos = _is_pos(label)
    per = (df.groupBy(key.alias("_g"), F.col(score).alias("_s"))
           .agg(F.sum(pos).alias("_p"), F.sum(1 - pos).alias("_n"), F.sum(hit).alias("_hit"), F.count("*").alias("_rows")))
    cum = prefix_sums(per, ["_g", "_s"], ["_p", "_n"], prefix="_below", inclusive=False)
    whole = cum.groupBy("_g").agg(F.sum("_p").alias("_all_p"), F.sum("_n").alias("_all_n"), F.min("_below_p").alias("_p0"),
                                  F.min("_below_n").alias("_n0"))
    c = cum.join(F.broadcast(whole), "_g")  # one row per group
    p, n = F.col("_p").cast("double"), F.col("_n").cast("double")
    below = (F.col("_below_n") - F.col("_n0")).cast("double")
    tp, fp = (F.col("_all_p") - F.col("_below_p") + F.col("_p0")).cast("double"), F.col("_all_n") - below
    prec = F.try_divide(tp, tp + fp)
    before = F.when(tp - p + fp - n == 0, prec).otherwise(F.try_divide(tp - p, tp - p + fp - n))
    total_p, total_n = F.col("_all_p").cast("double"), F.col("_all_n").cast("double")
    out = c.groupBy("_g").agg(
        F.sum(F.try_divide(p * (below + 0.5 * n), total_p * total_n)).alias("roc_auc"),
        F.sum(F.try_divide(p, total_p) * (prec + before) / 2).alias("pr_auc"),
        (F.sum("_hit") / F.sum("_rows")).alias("accuracy"))
    return out.select(*[F.col("_g")[b].alias(b) for b in by], *(["accuracy"] if pred else []), "pr_auc", "roc_auc")


def roc_auc(df: DataFrame, score: str, label: str = "label", name: str = "roc_auc") -> DataFrame:
    """EVL-2: area under ROC; ties count one half (one row, NULL without rows)."""
    return ranking_metrics(df, score, label).agg(F.max("roc_auc").alias(name))


def pr_auc(df: DataFrame, score: str, label: str = "label", name: str = "pr_auc") -> DataFrame:
    """EVL-3: area under the precision-recall curve."""
    return ranking_metrics(df, score, label).agg(F.max("pr_auc").alias(name))


def accuracy(df: DataFrame, pred: str, label: str = "label", name: str = "accuracy") -> DataFrame:
    """EVL-1 / FLT-9: share of rows whose prediction equals the label."""
    return df.agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias(name))


def weighted_f1(df: DataFrame, pred: str, label: str = "label", name: str = "weighted_f1") -> DataFrame:
    """EVL-4: per-class F1 weighted by the class's share of true labels."""
    cm = df.groupBy(F.col(label).alias("_l"), F.col(pred).alias("_p")).agg(F.count("*").alias("_c"))
    tp = cm.where(F.col("_l") == F.col("_p")).select(F.col("_l").alias("_k"), F.col("_c").alias("_tp"))
    lab = cm.groupBy(F.col("_l").alias("_k")).agg(F.sum("_c").alias("_lab"))
    prd = cm.groupBy(F.col("_p").alias("_k")).agg(F.sum("_c").alias("_prd"))
    per = lab.join(tp, "_k", "left").join(prd, "_k", "left").fillna(0, ["_tp", "_prd"])
    p = F.when(F.col("_prd") > 0, F.try_divide(F.col("_tp"), F.col("_prd"))).otherwise(0.0)
    r = F.try_divide(F.col("_tp"), F.col("_lab"))
    f1 = F.when(p + r > 0, F.try_divide(2 * p * r, p + r)).otherwise(0.0)
    return per.agg(F.try_divide(F.sum(f1 * F.col("_lab")), F.sum("_lab")).alias(name))


def compare_models(df: DataFrame, scores: dict[str, str], label: str = "label") -> DataFrame:
    """EVL-5 / SET-1: one (model, pr_auc, roc_auc) row per score column, from one
    pass over the molten (model, score, label) rows."""
    rows = F.array(*[F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("score"), F.col(label).alias("label"))
                     for m, c in scores.items()])
    return ranking_metrics(df.select(F.inline(rows)), "score", "label", ["model"])


def squared_error(predicted: Column, actual: Column) -> Column:
    """REC-7."""
    return F.pow(predicted - actual, 2)


def mse_rmse(pairs: DataFrame, predicted: str = "predicted", actual: str = "rating") -> DataFrame:
    """REC-8: mean squared error and its root over joined pairs."""
    return (pairs.agg(F.avg(squared_error(F.col(predicted), F.col(actual))).alias("mse"))
            .withColumn("rmse", F.sqrt("mse")))


def mse_rmse_library(pairs: DataFrame, predicted: str = "predicted", actual: str = "rating") -> tuple[float, float]:
    """REC-9: the same numbers from ``RegressionEvaluator`` (cross-check)."""
    from pyspark.ml.evaluation import RegressionEvaluator
    ev = RegressionEvaluator(predictionCol=predicted, labelCol=actual)
    return ev.setMetricName("mse").evaluate(pairs), ev.setMetricName("rmse").evaluate(pairs)


def average_precision(predicted: DataFrame, actual: DataFrame, k: int, user: str = "user",
                      item: str = "item", pos: str = "pos", users: DataFrame | None = None,
                      empty_actual: float = 1.0) -> DataFrame:
    """REC-10: AP@K per user.

    ``predicted``: (user, item, pos) with pos 1.. (rows beyond ``k`` ignored);
    ``actual``: (user, item). ``users`` (default: users of ``predicted``)
    fixes the population; a user without actual items scores
    ``empty_actual`` (1.0 like the reference; the library uses 0).
    """
    pred = predicted.where(F.col(pos) <= k).select(user, item, pos)
    hits = pred.join(actual.select(user, item), [user, item])
    hits = running_sum(hits.withColumn("_one", F.lit(1)), user, [pos], "_one", "_h")  # <= k rows per user
    per_user = hits.groupBy(user).agg(F.sum(F.col("_h") / F.col(pos)).alias("_score"))
    sizes = actual.groupBy(user).agg(F.count("*").alias("_na"))
    pop = (users if users is not None else predicted.select(user)).distinct()
    out = pop.join(sizes, user, "left").join(per_user, user, "left")
    ap = (F.when(F.coalesce(F.col("_na"), F.lit(0)) == 0, F.lit(empty_actual))
          .otherwise(F.try_divide(F.coalesce(F.col("_score"), F.lit(0.0)), F.least(F.col("_na"), F.lit(k)))))
    return out.select(user, ap.alias("ap"))


def top_k_positions(scores: DataFrame, item: str, order: list, k: int | None, pos: str = "pos") -> DataFrame:
    """A single ranked list (item, pos) of bounded length ``k``."""
    w = Window.orderBy(*order)
    # the ranked list has at most k rows: TakeOrderedAndProject then number it
    top = scores.orderBy(*order).limit(k)
    return top.withColumn(pos, F.row_number().over(w)).select(item, pos)


def average_precision_shared_list(actual: DataFrame, ranked: DataFrame, k: int, user: str = "user",
                                  item: str = "item", pos: str = "pos") -> DataFrame:
    """REC-10 when every user gets the same ranked list (e.g. popularity):
    only the user's actual items that appear in the list are joined, the
    list (``k`` rows) is broadcast; no user x item product is formed."""
    users = actual.select(user).distinct()
    predicted = actual.join(sized_broadcast(ranked.where(F.col(pos) <= k)), item).select(user, item, pos)
    return average_precision(predicted, actual, k, user, item, pos, users=users)


def mean_average_precision(actual: DataFrame, ranked: DataFrame, ks: list[int], user: str = "user",
                           item: str = "item", pos: str = "pos") -> DataFrame:
    """REC-11 for several cut-offs at once when every user gets the same ranked
    list: (k, map). The pairs are joined and the hits numbered once, at the
    largest cut-off; a hit's number does not depend on the cut-off."""
    hits = actual.join(sized_broadcast(ranked.where(F.col(pos) <= max(ks))), item).select(user, pos)
    w = Window.partitionBy(user).orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.count("*").over(w) / F.col(pos)  # <= max(ks) rows per user
    per = hits.withColumn("_share", share).groupBy(user).agg(
        *[F.sum(F.when(F.col(pos) <= k, F.col("_share"))).alias(f"_s{k}") for k in ks])
    sizes = actual.groupBy(user).agg(F.count("*").alias("_n"))
    aps = [F.avg(F.coalesce(F.col(f"_s{k}"), F.lit(0.0)) / F.least(F.col("_n"), F.lit(k))).alias(f"_m{k}") for k in ks]
    one = sizes.join(per, user, "left").agg(*aps)
    return one.select(F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"_m{k}").alias("map")) for k in ks])))


def map_at_k(ap: DataFrame, name: str = "map") -> DataFrame:
    """REC-11: mean of per-user AP (denominator: users with recommendations)."""
    return ap.agg(F.avg("ap").alias(name))


def map_full(actual: DataFrame, positions: DataFrame, user: str = "user", item: str = "item",
             pos: str = "pos", name: str = "map") -> DataFrame:
    """REC-12: untruncated MAP (library definition: divide by the number of
    relevant items) when each item has one position in a full ranking.

    Each actual item is a hit at its position; its hit count is its rank
    among the user's actual items, computed with a distributed group rank so
    a very active user is not one task."""
    hits = actual.select(user, item).join(positions.select(item, pos), item)
    ranked = rank_within_groups(hits, [user], [pos, item], "_h")
    per_user = ranked.groupBy(user).agg((F.sum(F.col("_h") / F.col(pos)) / F.count("*")).alias("_ap"))
    users = actual.select(user).distinct()
    return users.join(per_user, user, "left").agg(F.avg(F.coalesce("_ap", F.lit(0.0))).alias(name))


def standardise(df: DataFrame, cols: list[str], with_mean: bool = True, with_std: bool = True,
                suffix: str = "") -> DataFrame:
    """FEA-1: (x - mean) / sample std (std 0 -> 0.0). The statistics are one
    aggregate row (2 numbers per column) applied as literals, like a fitted
    scaler model."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"m_{c}"), F.stddev_samp(c).alias(f"s_{c}")]
    st = df.agg(*aggs).first()
    out = df
    for c in cols:
        x = F.col(c)
        if with_mean:
            x = x - F.lit(st[f"m_{c}"])
        if with_std:
            s = st[f"s_{c}"]
            x = x / F.lit(s) if s else F.lit(0.0)
        out = out.withColumn(c + suffix, x)
    return out


def log_loss(df: DataFrame, score: str, label: str = "label", by: list[str] | None = None) -> DataFrame:
    """Mean logistic loss of probabilities of class 1 and that of always answering the
    share of positives: ``by.., log_loss, prior_loss``. Scores are kept 1e-15 away from
    0 and 1."""
    p = F.greatest(F.lit(1e-15), F.least(F.lit(1 - 1e-15), F.col(score)))
    hit = _is_pos(label)
    share = F.avg(hit.cast("double"))
    part = lambda q: F.when(q > 0, -q * F.log(q)).otherwise(0.0)
    return df.groupBy(*(by or [])).agg(F.avg(F.when(hit == 1, -F.log(p)).otherwise(-F.log(1 - p))).alias("log_loss"), share.alias("_q")) \
             .select(*(by or []), "log_loss", (part(F.col("_q")) + part(1 - F.col("_q"))).alias("prior_loss"))


def hinge_loss(df: DataFrame, margin: str, label: str = "label", by: list[str] | None = None) -> DataFrame:
    """Mean hinge loss of margins for class 1 and that of the best constant margin:
    ``by.., hinge_loss, prior_loss``."""
    sign = F.when(_is_pos(label) == 1, 1.0).otherwise(-1.0)
    share = F.avg(_is_pos(label).cast("double"))
    return df.groupBy(*(by or [])).agg(F.avg(F.greatest(F.lit(0.0), 1 - sign * F.col(margin))).alias("hinge_loss"),
                                       (2 * F.least(share, 1 - share)).alias("prior_loss"))
