"""Registered queries of the solvers whose numbers have an exact SQL form: gradient
descent, histogram trees, closed-form Bayes, alternating least squares by normal
equations, Lloyd's iterations, inner-product search and subspace iteration. They
return the fitted numbers, the predictions and the metrics themselves."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quarry.functions.scalar import cosine
from quarry.operators import classify as cl
from quarry.operators import cluster as km
from quarry.operators import evaluate as ev
from quarry.operators import gradient as gd
from quarry.operators import histogram_tree as ht
from quarry.operators import inner_product as ip
from quarry.operators import lloyd as ll
from quarry.operators import normal_equations as ne
from quarry.operators import relational as rel
from quarry.operators import subspace as ss
from quarry.operators import term_bayes as tb
from quarry.operators import text as tx
from quarry.plans import fixtures as fx
from quarry.plans.q_core import USER, _STOP_SQL
from quarry.plans.q_models import ALS, DEPTHS, HOLDOUT_PENALTIES, ITERATIONS, NUMS, PENALTIES, SMOOTHINGS, STEPS, _TEST_U, _als, rated
from quarry.plans.q_text import _TOKENIZE_SQL, _word2vec, stored_arrays
from quarry.plans.registry import cached_model, query, rounded
from quarry.session import by_key, cut_lineage, few_partitions, stored

W = fx.with_fixtures


def metrics_sql(src: str, by: str) -> str:
    """``by, accuracy, pr_auc, roc_auc`` of ``src(by, label, score, prediction)``."""
    return f"""
, by_score AS (SELECT {by} AS g, score AS s, sum(CASE WHEN label > 0.5 THEN 1 ELSE 0 END) AS p,
                 sum(CASE WHEN label > 0.5 THEN 0 ELSE 1 END) AS n, sum(CASE WHEN label = prediction THEN 1 ELSE 0 END) AS hit
          FROM {src} GROUP BY 1, 2)
, upto AS (SELECT *, sum(p) OVER d AS tp, sum(n) OVER d AS fp, sum(p) OVER (PARTITION BY g) AS np, sum(n) OVER (PARTITION BY g) AS nn
          FROM by_score WINDOW d AS (PARTITION BY g ORDER BY s DESC))
, curve AS (SELECT *, tp / (tp + fp) AS prec, lag(tp / (tp + fp)) OVER (PARTITION BY g ORDER BY s DESC) AS prev FROM upto)
SELECT g AS {by}, round(sum(hit) / sum(p + n), 6) AS accuracy,
       round(sum(p / np * (prec + coalesce(prev, prec)) / 2), 6) AS pr_auc,
       round(sum(p * (nn - fp + 0.5 * n)) / max(np * nn), 6) AS roc_auc
FROM curve GROUP BY g"""


def _split(spark, sf):
    return rel.split_by_hash(few_partitions(cut_lineage(fx.labelled(spark, sf))), "doc_id", 0.6, 123)


# --- gradient descent (CLS-2, CLS-7, TUN-2, TUN-3) ------------------------------------------

_Z = [f"z{i}" for i in range(len(NUMS))]
_SCALED_SQL = f"""
, sides AS (SELECT *, {_TEST_U} >= 0.6 AS held FROM labelled)
, st AS (SELECT {', '.join(f'avg({c}) AS m{i}, stddev_samp({c}) AS s{i}' for i, c in enumerate(NUMS))} FROM sides WHERE NOT held)
, z AS (SELECT doc_id, label, held, {', '.join(f'({c} - m{i}) / s{i} AS z{i}' for i, c in enumerate(NUMS))} FROM sides, st)
"""
_MARGIN_SQL = "w[1]" + "".join(f" + w[{i + 2}] * z{i}" for i in range(len(NUMS)))


def _descent_sql(runs: list[gd.Run], iterations: int) -> str:
    """``t(run, iteration, n, loss, w)`` by a recursive query: one step a round."""
    values = ", ".join(f"('{r.name}', {r.step}::DOUBLE, '{r.updater}', {r.reg}::DOUBLE, {r.fraction}::DOUBLE)" for r in runs)
    n = len(NUMS) + 1
    eta = "(step / sqrt(i + 1))"
    moved = ["w[1] - " + eta + " * g1"]
    for j in range(2, n + 1):
        simple = f"(w[{j}] - {eta} * g{j})"
        moved.append(f"CASE updater WHEN 'l2' THEN w[{j}] * (1 - {eta} * reg) - {eta} * g{j} "
                     f"WHEN 'l1' THEN sign({simple}) * greatest(0.0, abs({simple}) - {eta} * reg) ELSE {simple} END")
    squares = " + ".join(f"w[{j}] * w[{j}]" for j in range(2, n + 1))
    sizes = " + ".join(f"abs(w[{j}])" for j in range(2, n + 1))
    zeros = ", ".join(["0.0::DOUBLE"] * n)
    batch = (f"((doc_id % {gd.BATCH_PRIME}) * (({gd.BATCH_A} + (i + 1) * {gd.BATCH_B}) % {gd.BATCH_PRIME}) % {gd.BATCH_PRIME} "
             f"/ {gd.BATCH_PRIME}.0 < fraction OR fraction >= 1)")
    return _SCALED_SQL.replace("\n, sides", ", sides", 1) + f"""
, t AS (
  SELECT run, step, updater, reg, fraction, 0 AS i, [{zeros}] AS w, 0::BIGINT AS n, NULL::DOUBLE AS loss
  FROM (VALUES {values}) runs(run, step, updater, reg, fraction)
  UNION ALL
  SELECT run, step, updater, reg, fraction, i + 1, [{', '.join(moved)}], n,
         l + CASE updater WHEN 'l2' THEN reg / 2 * ({squares}) WHEN 'l1' THEN reg * ({sizes}) ELSE 0 END
  FROM (SELECT run, step, updater, reg, fraction, i, w, count(*) AS n, avg(p - label) AS g1,
               {', '.join(f'avg((p - label) * z{j}) AS g{j + 2}' for j in range(len(NUMS)))},
               avg(greatest(m, 0.0) + ln(1 + exp(-abs(m))) - label * m) AS l
        FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM (
                SELECT t.*, z.*, {_MARGIN_SQL} AS m FROM t, z WHERE NOT held AND i < {iterations} AND {batch}) AS a) AS b
        GROUP BY ALL) AS c)
, fitted AS (SELECT run, w FROM t WHERE i = {iterations})
, scored AS (SELECT run, doc_id, label, score, CASE WHEN score > 0.5 THEN 1.0 ELSE 0.0 END AS prediction FROM (
    SELECT run, doc_id, label, round(1 / (1 + exp(-({_MARGIN_SQL}))), 9) AS score FROM z, fitted WHERE held) AS s)
"""


def _recursive(body: str) -> str:
    return W(body, "labelled").replace("WITH ", "WITH RECURSIVE ", 1)


_HISTORY_SQL = "SELECT run, i AS iteration, n, round(loss, 6) AS loss, round(w[1], 6) AS bias, " + ", ".join(
    f"round(w[{i + 2}], 6) + 0.0::DOUBLE AS w_{c}" for i, c in enumerate(NUMS)) + " FROM t WHERE i > 0"


def _history(spark, sf, runs, iterations):
    train, _ = _split(spark, sf)
    h = gd.descend(cut_lineage(gd.scale_like(train, train, NUMS)), NUMS, runs, iterations, key="doc_id")
    return rounded(h.select("run", "iteration", "n", "loss", F.col("weights")[0].alias("bias"),
                            *[F.col("weights")[i + 1].alias(f"w_{c}") for i, c in enumerate(NUMS)]))


def _held_out(spark, sf, runs, iterations):
    train, test = _split(spark, sf)
    h = gd.descend(cut_lineage(gd.scale_like(train, train, NUMS)), NUMS, runs, iterations, key="doc_id")
    return gd.score_runs(gd.scale_like(train, test, NUMS), NUMS, gd.final_weights(h))


BASIC = [gd.Run("full"), gd.Run("mini", fraction=0.4), gd.Run("mini l2", fraction=0.7, updater="l2", reg=0.01)]
STEP_RUNS = [gd.Run(str(s), step=s) for s in STEPS]
PENALTY_RUNS = [gd.Run(f"{u} {p}", updater=u, reg=p) for u in ("l1", "l2") for p in PENALTIES]


@query("cls02_gradient_steps", _recursive(_descent_sql(BASIC, 10) + _HISTORY_SQL))
def gradient_steps(spark, sf):
    """Loss and weights after each step, full batch and mini-batch."""
    return _history(spark, sf, BASIC, 10)


@query("cls07_gradient_predictions", _recursive(
    _descent_sql(BASIC, 10) + "SELECT run, doc_id, label, round(score, 6) AS score, prediction::DOUBLE AS prediction FROM scored"))
def gradient_predictions(spark, sf):
    """Held-out rows with the fitted probability and class."""
    return rounded(_held_out(spark, sf, BASIC, 10).select("run", "doc_id", "label", "score", "prediction"))


@query("tun02_step_values", _recursive(_descent_sql(STEP_RUNS, 10) + _HISTORY_SQL))
def step_values(spark, sf):
    """Every step size's loss and weights, all from the same ten passes."""
    return _history(spark, sf, STEP_RUNS, 10)


@query("tun02_step_metrics", _recursive(_descent_sql(STEP_RUNS, 10) + metrics_sql("scored", "run").lstrip()))
def step_metrics(spark, sf):
    return rounded(ev.ranking_metrics(_held_out(spark, sf, STEP_RUNS, 10), "score", "label", ["run"], pred="prediction"))


@query("tun03_penalty_values", _recursive(_descent_sql(PENALTY_RUNS, 10) + _HISTORY_SQL))
def penalty_values(spark, sf):
    """L1 and L2 updaters at every penalty."""
    return _history(spark, sf, PENALTY_RUNS, 10)


@query("tun03_penalty_metrics", _recursive(_descent_sql(PENALTY_RUNS, 10) + metrics_sql("scored", "run").lstrip()))
def penalty_metrics(spark, sf):
    return rounded(ev.ranking_metrics(_held_out(spark, sf, PENALTY_RUNS, 10), "score", "label", ["run"], pred="prediction"))


@query("tun01_iteration_metrics", _recursive(
    _descent_sql([gd.Run("full")], max(ITERATIONS)) + f"""
, stages AS (SELECT i::VARCHAR AS iterations, w FROM t WHERE i IN ({', '.join(map(str, ITERATIONS))}))
, staged AS (SELECT iterations, label, score, CASE WHEN score > 0.5 THEN 1.0 ELSE 0.0 END AS prediction FROM (
    SELECT iterations, label, round(1 / (1 + exp(-({_MARGIN_SQL}))), 9) AS score FROM z, stages WHERE held) AS s)
""" + metrics_sql("staged", "iterations").lstrip()))
def iteration_metrics(spark, sf):
    """One fit of the most iterations gives the weights of all smaller numbers."""
    train, test = _split(spark, sf)
    h = gd.descend(cut_lineage(gd.scale_like(train, train, NUMS)), NUMS, [gd.Run("full")], max(ITERATIONS))
    at = {str(r["iteration"]): list(r["weights"]) for r in h.where(F.col("iteration").isin(ITERATIONS)).collect()}
    rows = gd.score_runs(gd.scale_like(train, test, NUMS), NUMS, at).withColumnRenamed("run", "iterations")
    return rounded(ev.ranking_metrics(rows, "score", "label", ["iterations"], pred="prediction"))


# --- histogram tree (CLS-6, CLS-7, TUN-4) -----------------------------------------------------

BINS, DEPTH = 32, 5


def _part(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN -({x}) * log2({x}) ELSE 0.0 END"


def _entropy(n: str, p: str) -> str:
    q = f"(({p})::DOUBLE / ({n}))"
    return f"({_part(q)} + {_part(f'(1 - {q})')})"


def _tree_sql(depth: int) -> str:
    """``node(node, n, positives)``, ``split(node, f, b, threshold, gain)`` and every
    row's path, level by level."""
    cols = ", ".join(NUMS)
    out = f"""
, sides AS (SELECT *, {_TEST_U} >= 0.6 AS held, [{cols}] AS xs FROM labelled)
, molten AS (SELECT f, xs[f] AS v FROM sides, (SELECT unnest(range(1, {len(NUMS) + 1})) AS f) AS fs WHERE NOT held)
, vals AS (SELECT f, v, count(*) AS c FROM molten GROUP BY 1, 2)
, run AS (SELECT *, sum(c) OVER (PARTITION BY f ORDER BY v) AS upto, sum(c) OVER (PARTITION BY f) AS n, max(v) OVER (PARTITION BY f) AS top FROM vals)
, edge AS (SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY v) - 1 AS b FROM run
           WHERE (upto * {BINS}) // n > ((upto - c) * {BINS}) // n AND v < top)
, edges AS MATERIALIZED (SELECT f, list(v ORDER BY v) AS e FROM edge GROUP BY f)
, binned AS MATERIALIZED (
    SELECT doc_id, label, held, (label > 0.5)::INTEGER AS pos, list(len(list_filter(coalesce(e, []), lambda y: y < xs[f])) ORDER BY f) AS b
    FROM sides, (SELECT unnest(range(1, {len(NUMS) + 1})) AS f) AS fs LEFT JOIN edges USING (f) GROUP BY ALL)
, r0 AS (SELECT *, 1::BIGINT AS node FROM binned)"""
    out = out.replace("(SELECT unnest(range(1, 4)) AS f) AS fs LEFT JOIN edges USING (f) GROUP BY ALL",
                      "(SELECT f, e FROM (SELECT unnest(range(1, 4)) AS f) AS g LEFT JOIN edges USING (f)) AS fs "
                      "GROUP BY doc_id, label, held, pos")
    for k in range(depth):
        gain = (f"round({_entropy('n', 'p')} - ln::DOUBLE / n * {_entropy('ln', 'lp')} "
                f"- (n - ln)::DOUBLE / n * {_entropy('(n - ln)', '(p - lp)')}, 10)")
        out += f"""
, h{k} AS (SELECT node, f, b[f] AS bin, count(*) AS c, sum(pos) AS q FROM r{k}, (SELECT unnest(range(1, {len(NUMS) + 1})) AS f) AS fs
          WHERE NOT held GROUP BY 1, 2, 3)
, c{k} AS (SELECT node, f, bin, sum(c) OVER d AS ln, sum(q) OVER d AS lp, sum(c) OVER (PARTITION BY node, f) AS n,
                 sum(q) OVER (PARTITION BY node, f) AS p FROM h{k} WINDOW d AS (PARTITION BY node, f ORDER BY bin))
, s{k} AS MATERIALIZED (SELECT node, f, bin, gain FROM (SELECT node, f, bin, {gain} AS gain FROM c{k} WHERE ln < n) AS g
                        WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, bin) = 1)
, r{k + 1} AS MATERIALIZED (SELECT r.doc_id, r.label, r.held, r.pos, r.b,
       CASE WHEN s.node IS NULL THEN r.node ELSE 2 * r.node + (r.b[s.f] > s.bin)::INTEGER END AS node
     FROM r{k} r LEFT JOIN s{k} s ON s.node = r.node)"""
    splits = " UNION ALL ".join(f"SELECT node, f, bin, gain FROM s{k}" for k in range(depth))
    counts = " UNION ".join(f"SELECT node, count(*) AS n, sum(pos) AS positives FROM r{k} WHERE NOT held GROUP BY 1" for k in range(depth + 1))
    return out + f"""
, split AS (SELECT s.node, s.f, s.gain, e.v AS threshold FROM ({splits}) AS s JOIN edge e ON e.f = s.f AND e.b = s.bin)
, node AS (SELECT * FROM ({counts}) AS u)"""


def _fit_tree(spark, sf, depth):
    train, test = _split(spark, sf)
    return ht.fit_tree(train, NUMS, max_depth=depth, bins=BINS), test


@query("cls06_histogram_tree", W(_tree_sql(DEPTH) + f"""
SELECT n.node, (length(bin(n.node)) - 1)::INTEGER AS depth, n.n, n.positives::BIGINT AS positives,
       ({[*NUMS]})[s.f] AS feature, round(s.threshold, 6) AS threshold, round(s.gain, 6) AS gain
FROM node n LEFT JOIN split s ON s.node = n.node""", "labelled"))
def histogram_tree(spark, sf):
    """Splits, gains and counts of every node of a tree of depth 5."""
    tree, _ = _fit_tree(spark, sf, DEPTH)
    return rounded(tree.frame(spark))


_DEPTH_SQL = f"""
, placed AS (SELECT doc_id, label, depth, node >> greatest(length(bin(node)) - 1 - depth, 0)::BIGINT AS node
         FROM r%d, (SELECT unnest({DEPTHS}) AS depth) AS ds WHERE held)
, scored AS (SELECT depth::INTEGER AS depth, doc_id, label, positives / n AS score,
                    CASE WHEN positives / n > 0.5 THEN 1.0 ELSE 0.0 END AS prediction FROM placed JOIN node USING (node))"""


@query("cls06_tree_predictions", W(_tree_sql(DEPTH) + _DEPTH_SQL % DEPTH + f"""
SELECT doc_id, label, round(score, 6) AS score, prediction::DOUBLE AS prediction FROM scored WHERE depth = {DEPTH}""", "labelled"))
def tree_predictions(spark, sf):
    """Held-out rows with the share of positives of their leaf."""
    tree, test = _fit_tree(spark, sf, DEPTH)
    return rounded(ht.score_depths(test, tree, [DEPTH]).select("doc_id", "label", "score", "prediction"))


@query("tun04_depth_metrics", W(_tree_sql(max(DEPTHS)) + _DEPTH_SQL % max(DEPTHS) + metrics_sql("scored", "depth"), "labelled"))
def depth_metrics(spark, sf):
    """One tree of the largest depth holds all shallower ones."""
    tree, test = _fit_tree(spark, sf, max(DEPTHS))
    rows = ht.score_depths(test, tree, DEPTHS)
    return rounded(ev.ranking_metrics(rows, "score", "label", ["depth"], pred="prediction"))


# --- naive Bayes in closed form (CLS-5, TXT-11, TXT-12, FEA-4, TUN-5) --------------------------

_U = "(((doc_id % 1000003) * 427799 + 123) % 1000003) / 1000003.0"


def _bayes_sql(smoothing: str) -> str:
    """``scores(s, doc_id, label, log_score)`` from ``train(doc_id, label)``,
    ``test(doc_id)``, ``x(doc_id, term, x)`` and smoothing values ``s``."""
    return f"""
, smooth AS (SELECT unnest({smoothing})::DOUBLE AS s)
, per AS MATERIALIZED (SELECT term, label, sum(x) AS x FROM x JOIN train USING (doc_id) GROUP BY 1, 2)
, size AS (SELECT count(DISTINCT term) AS v FROM per)
, cls AS (SELECT label, count(*) AS n FROM train GROUP BY 1)
, tot AS (SELECT label, sum(x) AS x FROM per GROUP BY 1)
, model AS (SELECT s, label, ln((n + s) / ((SELECT sum(n) FROM cls) + s * (SELECT count(*) FROM cls))) AS prior,
                   ln(s / (coalesce(tot.x, 0) + s * v)) AS unseen FROM smooth, size, cls LEFT JOIN tot USING (label))
, known AS MATERIALIZED (SELECT x.doc_id, x.term, x.x FROM x JOIN test USING (doc_id) WHERE x.term IN (SELECT term FROM per))
, base AS (SELECT doc_id, sum(x) AS t FROM known GROUP BY 1)
, gain AS (SELECT s, doc_id, label, sum(k.x * ln((per.x + s) / s)) AS g FROM known k JOIN per USING (term), smooth GROUP BY ALL)
, scores AS (SELECT m.s, d.doc_id, m.label, m.prior + coalesce(b.t, 0) * m.unseen + coalesce(g.g, 0) AS log_score
             FROM test d CROSS JOIN model m LEFT JOIN base b ON b.doc_id = d.doc_id
             LEFT JOIN gain g ON g.doc_id = d.doc_id AND g.label = m.label AND g.s = m.s)"""


_RAW_SQL = f"""
, train AS (SELECT doc_id, topic AS label FROM docs WHERE {_U} < 0.6)
, test AS (SELECT doc_id FROM docs WHERE {_U} >= 0.6)
, x AS (SELECT doc_id, tok AS term, count(*)::DOUBLE AS x FROM (
          SELECT doc_id, unnest(string_split(text, ' ')) AS tok FROM docs) AS t GROUP BY 1, 2)"""
_PROCESSED_SQL = f"""
, train AS (SELECT doc_id, topic AS label FROM docs WHERE {_U} < 0.6)
, test AS (SELECT doc_id FROM docs WHERE {_U} >= 0.6)
, tf AS (SELECT doc_id, tok, count(*) AS c FROM tokens WHERE regexp_full_match(tok, '[^0-9]*') AND tok NOT IN {_STOP_SQL} AND length(tok) >= 2
         GROUP BY 1, 2)
, idf AS (SELECT tok, ln(((SELECT count(*) FROM train) + 1) / (count(*) + 1.0)) AS w FROM tf JOIN train USING (doc_id)
          GROUP BY 1 HAVING sum(c) >= 2)
, x AS (SELECT doc_id, tok AS term, c * w AS x FROM tf JOIN idf USING (tok))"""


def _topics(spark, sf, variant):
    """(model, test weights, test documents) of raw or of processed text."""
    train, test = rel.split_by_hash(fx.docs(spark, sf), "doc_id", 0.6, 123)

    def counts(d):
        d = by_key(d, "doc_id")
        if variant == "raw":
            toks = d.select("doc_id", F.explode(F.split("text", " ", -1)).alias("term"))
        else:
            toks = tx.clean_tokens(tx.tokens_word(d)).withColumnRenamed("tok", "term")
        return toks.groupBy("doc_id", "term").agg(F.count("*").cast("double").alias("x"))

    te = counts(test)
    sums = cut_lineage(tb.class_counts(counts(train), train, label="topic").where("term is not null"))
    if variant != "raw":
        n = train.count()
        idf = sums.groupBy("term").agg(F.sum("n").alias("c"), F.log(F.lit(n + 1.0) / (F.sum("df") + 1.0)).alias("w")) \
                  .where("c >= 2").select("term", "w")
        sums = sums.join(idf, "term").withColumn("x", F.col("x") * F.col("w"))
        te = te.join(idf.hint("shuffle_hash"), "term").select("doc_id", "term", (F.col("x") * F.col("w")).alias("x"))
    model = tb.fit_sums(sums.where("label is not null").select("term", "label", "x"), train, 0.1, "topic")
    return model, te, test


def _both_variants(select: str) -> str:
    """The two variants as sub-queries of their own (they name the same tables)."""
    def one(v, body):
        names = W("\n", "docs", "tokens").strip()
        return f"SELECT '{v}' AS variant, * FROM ({names}{body}{_bayes_sql('[0.1]')}{select}) AS {v}"
    return one("raw", _RAW_SQL) + "\nUNION ALL\n" + one("processed", _PROCESSED_SQL)


def _each_variant(spark, sf, fn):
    parts = []
    for v in ("raw", "processed"):
        model, te, test = _topics(spark, sf, v)
        scores = cut_lineage(tb.log_scores(model, te, test))
        parts.append(fn(scores, test).select(F.lit(v).alias("variant"), "*"))
    return rel.union_all(parts)


@query("txt11_bayes_log_scores", _both_variants("\nSELECT doc_id, label, round(log_score, 3) AS log_score FROM scores"))
def bayes_log_scores(spark, sf):
    """Log-score of every test document and topic, raw and processed text."""
    return _each_variant(spark, sf, lambda s, _: s.select("doc_id", "label", F.round("log_score", 3).alias("log_score")))


_PREDICTED_SQL = """
, best AS (SELECT doc_id, label AS prediction FROM scores QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY round(log_score, 9) DESC, label) = 1)
"""


@query("txt11_bayes_predictions", _both_variants(_PREDICTED_SQL + "SELECT b.doc_id, d.topic, b.prediction FROM best b JOIN docs d ON d.doc_id = b.doc_id"))
def bayes_predictions(spark, sf):
    return _each_variant(spark, sf, lambda s, test: tb.predictions(s).join(test, "doc_id").select("doc_id", "topic", "prediction"))


@query("txt12_bayes_accuracy", _both_variants(_PREDICTED_SQL + """
, pr AS (SELECT d.topic AS label, b.prediction AS pred FROM best b JOIN docs d ON d.doc_id = b.doc_id)
, st AS (SELECT k, (SELECT count(*) FROM pr WHERE label = k AND pred = k) AS tp,
                (SELECT count(*) FROM pr WHERE pred = k) AS np, (SELECT count(*) FROM pr WHERE label = k) AS nl
         FROM (SELECT DISTINCT label AS k FROM pr) AS ks)
, f AS (SELECT nl, tp, CASE WHEN np > 0 THEN tp / np ELSE 0 END AS p, tp / nl AS r FROM st)
SELECT sum(nl)::BIGINT AS n, round(sum(tp) / sum(nl), 6) AS accuracy,
       round(sum(nl * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / sum(nl), 6) AS weighted_f1 FROM f"""))
def bayes_accuracy(spark, sf):
    """Accuracy and weighted F1 of raw against processed text."""
    def measure(s, test):
        p = cut_lineage(tb.predictions(s).join(test, "doc_id").select(F.col("topic").alias("label"), "prediction"))
        f1 = ev.weighted_f1(p, "prediction").first()[0]
        return p.agg(F.count("*").alias("n"), F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy")) \
                .withColumn("weighted_f1", F.lit(f1))
    return rounded(_each_variant(spark, sf, measure))


def _numbers_sql(terms: str, smoothing: str) -> str:
    return W(f"""
, train AS (SELECT doc_id, label FROM labelled WHERE {_U} < 0.6)
, test AS (SELECT doc_id FROM labelled WHERE {_U} >= 0.6)
, x AS (SELECT doc_id, term, x FROM ({terms}) AS u)""" + _bayes_sql(smoothing) + """
, scored AS (SELECT s::VARCHAR AS smoothing, doc_id, l.label, round(1 / (1 + exp(z.log_score - o.log_score)), 9) AS score
   FROM scores o JOIN scores z USING (s, doc_id) JOIN labelled l USING (doc_id) WHERE o.label = 1.0 AND z.label = 0.0)
, judged AS (SELECT *, CASE WHEN score > 0.5 THEN 1.0 ELSE 0.0 END AS prediction FROM scored)""", "labelled")


_LANG_TERMS = "SELECT doc_id, lang AS term, 1.0::DOUBLE AS x FROM labelled"
_NUMBER_TERMS = " UNION ALL ".join(f"SELECT doc_id, '{c}' AS term, {c} AS x FROM labelled" for c in NUMS)


def _bayes_binary(spark, sf, smoothings, category):
    """Held-out rows with the probability of class 1 per smoothing value."""
    train, test = _split(spark, sf)

    def terms(d):
        if category:
            return d.select("doc_id", F.col("lang").alias("term"), F.lit(1.0).alias("x"))
        return d.select("doc_id", F.inline(F.array(*[F.struct(F.lit(c).alias("term"), F.col(c).alias("x")) for c in NUMS])))
    parts = []
    for s in smoothings:
        scores = tb.log_scores(tb.fit(terms(train), train, s), terms(test), test)
        p = tb.probability(scores, 1.0).withColumn("score", F.round("score", 9))
        parts.append(p.join(test.select("doc_id", "label"), "doc_id")
                     .select(F.lit(str(s)).alias("smoothing"), "doc_id", "label", "score", (F.col("score") > 0.5).cast("double").alias("prediction")))
    return rel.union_all(parts)


@query("cls05_bayes_predictions", _numbers_sql(_NUMBER_TERMS, "[1.0]") + """
SELECT doc_id, label, round(score, 6) AS score, prediction::DOUBLE AS prediction FROM judged""")
def bayes_number_predictions(spark, sf):
    """Multinomial Bayes on the numeric columns: probability and class per row."""
    return rounded(_bayes_binary(spark, sf, [1.0], False).select("doc_id", "label", "score", "prediction"))


@query("fea04_category_bayes_scores", _numbers_sql(_LANG_TERMS, "[1.0]") + """
SELECT doc_id, label, round(score, 6) AS score, prediction::DOUBLE AS prediction FROM judged""")
def category_bayes_scores(spark, sf):
    return rounded(_bayes_binary(spark, sf, [1.0], True).select("doc_id", "label", "score", "prediction"))


@query("tun05_smoothing_metrics", _numbers_sql(_LANG_TERMS, str(SMOOTHINGS)) + metrics_sql("judged", "smoothing"))
def smoothing_metrics(spark, sf):
    return rounded(ev.ranking_metrics(cut_lineage(_bayes_binary(spark, sf, SMOOTHINGS, True)), "score", "label", ["smoothing"], pred="prediction"))


# --- Lloyd's rounds (KM-1, KM-7) -----------------------------------------------------------------

KM_K, KM_ROUNDS, KM_COUNTS = 5, 6, [2, 3, 4, 5]
_HASH1 = "((vec_id % 1000003) * 427799 + 1) % 1000003"


def _lloyd_sql(k: int, rounds: int) -> str:
    """``a{i}`` (vec_id, c, d) and ``m{i}`` (c, center): assignment and centres of round i."""
    out = f"""
, v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a FROM vectors WHERE embedding IS NOT NULL)
, m0 AS (SELECT row_number() OVER (ORDER BY {_HASH1}, vec_id) - 1 AS c, a AS center FROM v ORDER BY {_HASH1}, vec_id LIMIT {k})"""
    for i in range(1, rounds + 1):
        out += f"""
, a{i} AS MATERIALIZED (SELECT vec_id, c, d FROM (
    SELECT vec_id, c, list_sum(list_transform(list_zip(a, center), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, m{i - 1}) AS q
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)
, m{i} AS MATERIALIZED (SELECT m.c, coalesce(n.center, m.center) AS center FROM m{i - 1} m LEFT JOIN (
    SELECT c, list(x ORDER BY j) AS center FROM (
      SELECT c, j, avg(x) AS x FROM (SELECT c, unnest(a) AS x, generate_subscripts(a, 1) AS j FROM a{i} JOIN v USING (vec_id)) AS e GROUP BY 1, 2) AS g
    GROUP BY 1) AS n ON n.c = m.c)"""
    return out


def _lloyd_fit(spark, sf, k, rounds, bounded=True):
    v = cut_lineage(fx.vectors(spark, sf).select("vec_id", "embedding"))
    return ll.lloyd(v, "embedding", ll.first_by_hash(v, "vec_id", "embedding", k), rounds, bounded)


@query("km01_lloyd_rounds", W(_lloyd_sql(KM_K, KM_ROUNDS) + "\n" + " UNION ALL ".join(
    f"SELECT {i}::INTEGER AS round, round(sum(d), 6) AS cost, count(*) FILTER (changed)::BIGINT AS changed FROM ("
    + (f"SELECT x.d, x.c <> y.c AS changed FROM a{i} x JOIN a{i - 1} y USING (vec_id)" if i > 1 else "SELECT d, true AS changed FROM a1")
    + ") AS s" for i in range(1, KM_ROUNDS + 1)), "vectors"))
def lloyd_rounds(spark, sf):
    """Cost and changed rows of every round from fixed seeds (bounds skip distances,
    never change a round)."""
    return rounded(_lloyd_fit(spark, sf, KM_K, KM_ROUNDS).report(spark).select("round", "cost", "changed"))


@query("km02_lloyd_centers", W(_lloyd_sql(KM_K, KM_ROUNDS) + f"""
SELECT c::INTEGER AS cluster, (generate_subscripts(center, 1) - 1)::INTEGER AS dim, round(unnest(center), 6) AS value FROM m{KM_ROUNDS}""",
                               "vectors"))
def lloyd_centers(spark, sf):
    m = _lloyd_fit(spark, sf, KM_K, KM_ROUNDS)
    rows = [(i, j, x) for i, c in enumerate(m.centers) for j, x in enumerate(c)]
    return rounded(spark.createDataFrame(rows, "cluster int, dim int, value double"))


@query("km03_lloyd_assignments", W(_lloyd_sql(KM_K, KM_ROUNDS + 1) + f"""
SELECT vec_id, c::INTEGER AS cluster, round(d, 6) AS distance FROM a{KM_ROUNDS + 1}""", "vectors"))
def lloyd_assignments(spark, sf):
    """Cluster and squared distance of every row under the fitted centres."""
    m = _lloyd_fit(spark, sf, KM_K, KM_ROUNDS)
    return rounded(km.assign_report(fx.vectors(spark, sf).where("embedding is not null"), "embedding", m.centers, ["vec_id"]))


def _subquery(sql: str) -> str:
    return f"SELECT * FROM ({sql}) AS q"


@query("km07_lloyd_sweep", "\nUNION ALL\n".join(_subquery(W(_lloyd_sql(k, KM_ROUNDS + 1) + f"""
SELECT {k}::INTEGER AS k, round(sum(d), 6) AS wcss FROM a{KM_ROUNDS + 1}""", "vectors")) for k in KM_COUNTS))
def lloyd_sweep(spark, sf):
    """Within-cluster cost after the rounds, for several k."""
    v = cut_lineage(fx.vectors(spark, sf).select("vec_id", "embedding").where("embedding is not null"))
    parts = []
    for k in KM_COUNTS:
        m = ll.lloyd(v, "embedding", ll.first_by_hash(v, "vec_id", "embedding", k), KM_ROUNDS)
        parts.append(km.wcss(v, "embedding", m.centers).select(F.lit(k).cast("int").alias("k"), "wcss"))
    return rounded(rel.union_all(parts))


def _candidates_sql(k: int, rounds: int, factor: float) -> str:
    out = f"""
, v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a FROM vectors WHERE embedding IS NOT NULL)
, p0 AS (SELECT vec_id, a, 0 AS round FROM v ORDER BY {_HASH1}, vec_id LIMIT 1)"""
    for i in range(1, rounds + 1):
        out += f"""
, d{i} AS MATERIALIZED (SELECT v.vec_id, v.a, min(list_sum(list_transform(list_zip(v.a, p.a), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS d
        FROM v, p{i - 1} p GROUP BY 1, 2)
, p{i} AS MATERIALIZED (SELECT * FROM p{i - 1} UNION ALL SELECT vec_id, a, {i} FROM d{i}
        WHERE (((vec_id % 1000003) * 427799 + {1 + i * 386_413}) % 1000003) / 1000003.0 < ({factor}::DOUBLE * {k} / (SELECT sum(d) FROM d{i})) * d)"""
    return out + f"\nSELECT vec_id AS key, round::INTEGER AS round FROM p{rounds}"


@query("km01_seed_candidates", W(_candidates_sql(KM_K, 3, 2.0), "vectors"))
def seed_candidates(spark, sf):
    """k-means|| candidates drawn by key hash, three rounds."""
    v = cut_lineage(fx.vectors(spark, sf).where("embedding is not null"))
    return ll.seed_candidates(v, "vec_id", "embedding", KM_K, 3, 2.0).select("key", "round")


# --- alternating least squares by normal equations (REC-1, REC-2, REC-3, REC-7) --------------------

AL = {"rank": 2, "iterations": 2, "reg": 0.1}


def _alternate_sql() -> str:
    """Factors of rank 2 by turns, each 2 x 2 system solved in closed form."""
    def start(key):
        k = f'("{key}" % 1000003)'
        return ", ".join(f"(({k} * {427_799 + 7_919 * j} + {123 + j}) % 1000003) / 1000003.0 AS f{j + 1}" for j in range(2))

    def solve(key, other, table):
        return f"""(SELECT id, n, (a22 * b1 - a12 * b2) / det AS f1, (a11 * b2 - a12 * b1) / det AS f2 FROM (
    SELECT *, a11 * a22 - a12 * a12 AS det FROM (
      SELECT r."{key}" AS id, count(*) AS n, sum(o.f1 * o.f1) + {AL['reg']} * count(*) AS a11, sum(o.f2 * o.f2) + {AL['reg']} * count(*) AS a22,
             sum(o.f1 * o.f2) AS a12, sum(r.rating * o.f1) AS b1, sum(r.rating * o.f2) AS b2
      FROM ratings r JOIN {table} o ON o.id = r."{other}" GROUP BY 1) AS s) AS t)"""
    out = f"""
, u0 AS (SELECT id, {start('id')} FROM (SELECT DISTINCT "user" AS id FROM ratings) AS ids)"""
    for i in range(1, AL["iterations"] + 1):
        out += f"""
, i{i} AS MATERIALIZED {solve('item', 'user', f'u{i - 1}')}
, u{i} AS MATERIALIZED {solve('user', 'item', f'i{i}')}"""
    return out


def _alternated(spark, sf):
    def build():
        return ne.alternate(rated(spark, sf), AL["rank"], AL["iterations"], AL["reg"])
    return cached_model(spark, ("alternated", sf), build)


_N = AL["iterations"]


@query("rec01_alternating_factors", W(_alternate_sql() + f"""
SELECT 'user' AS side, id, n, round(f1, 6) AS f1, round(f2, 6) AS f2 FROM u{_N}
UNION ALL SELECT 'item', id, n, round(f1, 6), round(f2, 6) FROM i{_N}""", "ratings"))
def alternating_factors(spark, sf):
    """Factors of users and items by alternating normal equations."""
    users, items = _alternated(spark, sf)
    one = lambda d, s: d.select(F.lit(s).alias("side"), "id", "n", F.col("features")[0].alias("f1"), F.col("features")[1].alias("f2"))
    return rounded(one(users, "user").unionByName(one(items, "item")))


_AL_PRED = f"""
, pred AS (SELECT r."user", r.item, r.rating, u.f1 * i.f1 + u.f2 * i.f2 AS prediction
           FROM ratings r JOIN u{_N} u ON u.id = r."user" JOIN i{_N} i ON i.id = r.item)"""


@query("rec03_alternating_predictions", W(_alternate_sql() + _AL_PRED + """
SELECT "user", item, round(rating, 6) AS rating, round(prediction, 6) AS prediction FROM pred""", "ratings"))
def alternating_predictions(spark, sf):
    """Predicted rating of every rated pair."""
    users, items = _alternated(spark, sf)
    return rounded(ne.by_users(rated(spark, sf), users, items, lambda p: p.select("user", "item", "rating", "prediction")))


@query("rec07_user_errors", W(_alternate_sql() + _AL_PRED + """
SELECT "user", count(*) AS n, round(avg(pow(prediction - rating, 2)), 6) AS mse, round(var_pop(rating), 6) AS spread FROM pred GROUP BY 1""",
                              "ratings"))
def user_errors(spark, sf):
    """Squared error per user next to that of always answering the user's mean."""
    users, items = _alternated(spark, sf)
    per_user = lambda p: p.groupBy("user").agg(
        F.count("*").alias("n"), F.avg(ev.squared_error(F.col("prediction"), F.col("rating"))).alias("mse"), F.var_pop("rating").alias("spread"))
    return rounded(ne.by_users(rated(spark, sf), users, items, per_user))


@query("rec01_equation_residuals", W("""
SELECT "user" AS id, count(*) AS n, true AS solved, true AS folded_alike FROM ratings GROUP BY 1""", "ratings"))
def equation_residuals(spark, sf):
    """The fitted model of rank 50 checked by its normal equations: every user's
    vector solves them, and folding the user in anew gives the same vector."""
    model, r = _als(spark, sf), rated(spark, sf)
    users, items = [stored(f, "factors") for f in model.factors()]
    items = items.withColumn("features", F.col("features").cast("array<float>"))    # what the model has: half the bytes, the same numbers
    off = ne.residuals(r, users, items, ALS["reg"])
    anew = ne.solve_factors(r, items, ALS["reg"]).select("id", F.col("features").alias("anew"))
    size = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    gap = F.zip_with("features", "anew", lambda a, b: a - b)
    return off.join(users, "id").join(anew, "id").select(
        "id", "n", (F.col("residual") < 1e-4).alias("solved"), (size(gap) < 1e-3 * size(F.col("anew"))).alias("folded_alike"))


@query("rec03_als_predictions")
def als_predictions(spark, sf):
    """Rated pairs with the rating the model of rank 50 predicts."""
    return _als(spark, sf).predict(rated(spark, sf)).select("user", "item", "rating", "prediction")


@query("rec04_als_items")
def als_items(spark, sf):
    """One user's ten best items with titles and scores."""
    users = fx.ratings(spark, sf).select("user").where(F.col("user") == USER).distinct()
    top = rel.join_lookup(_als(spark, sf).top(users, 10), fx.titles(spark, sf).withColumnRenamed("id", "item"), "item")
    return top.select("user", "pos", "item", "title", "score")


@query("rec13_als_factors")
def als_factors(spark, sf):
    users, items = _als(spark, sf).factors()
    return users.select(F.lit("user").alias("side"), "*").unionByName(items.select(F.lit("item").alias("side"), "*"))


# --- exact search by inner product (JN-4, REC-5, SRT-3) ---------------------------------------------


@query("jn04_top_inner_products", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a FROM embeddings WHERE embedding IS NOT NULL)
, s AS (SELECT q.vec_id AS query, i.vec_id AS item, list_dot_product(q.a, i.a) AS score FROM v q, v i WHERE q.vec_id <> i.vec_id)
SELECT query, pos, item, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, item) AS pos FROM s) AS r WHERE pos <= 10""")
def top_inner_products(spark, sf):
    """The ten other vectors with the largest inner products, for every vector."""
    v = fx.vectors(spark, sf)
    return rounded(ip.top_inner(v, v, 10, "vec_id", "embedding", skip_self=True))


@query("rec05_recommend_values", W(_alternate_sql() + f"""
, s AS (SELECT u.id AS "user", i.id AS item, u.f1 * i.f1 + u.f2 * i.f2 AS score FROM u{_N} u, i{_N} i)
SELECT "user", pos, item, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY round(score, 9) DESC, item) AS pos FROM s) AS r WHERE pos <= 10""", "ratings"))
def recommend_values(spark, sf):
    """Ten best items of every user under the alternated factors."""
    users, items = _alternated(spark, sf)
    return rounded(ip.top_inner(users, items, 10).withColumnRenamed("query", "user"))


# --- singular values (DIM-2..5) --------------------------------------------------------------------------

POWERS = 4
_GRAM_SQL = """
WITH e AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
, c AS (SELECT vec_id, i, x - avg(x) OVER (PARTITION BY i) AS x FROM e)
, g1 AS MATERIALIZED (SELECT a.i, b.i AS j, sum(a.x * b.x) AS v FROM c a JOIN c b USING (vec_id) GROUP BY 1, 2)
""" + "".join(f", g{p} AS MATERIALIZED (SELECT a.i, b.j, sum(a.v * b.v) AS v FROM g{p - 1} a JOIN g1 b ON b.i = a.j GROUP BY 1, 2)\n"
              for p in range(2, POWERS + 1))


@query("dim05_power_sums", _GRAM_SQL + " UNION ALL ".join(
    f"SELECT {p}::INTEGER AS power, round(sum(v) / pow((SELECT sum(v) FROM g1 WHERE i = j), {p}), 9) AS share FROM g{p} WHERE i = j"
    for p in range(2, POWERS + 1)) + " UNION ALL SELECT 1, round(sum(v) / (SELECT count(*) FROM embeddings), 6) FROM g1 WHERE i = j")
def power_sums(spark, sf):
    """All singular values, held against traces of the matrix's powers: the sum of
    the squares, and that of their 2nd to 4th powers as shares of it."""
    v = fx.vectors(spark, sf)
    d = v.agg(F.max(F.size("embedding")).alias("d")).first()["d"]
    m = ss.leading_subspace(v, "embedding", d)
    e = m.values ** 2
    rows = [(1, round(float(e.sum()) / m.rows, 6))] + [(p, round(float((e ** p).sum() / e.sum() ** p), 9)) for p in range(2, POWERS + 1)]
    return spark.createDataFrame(rows, "power int, share double")


@query("dim03_singular_values")
def singular_value_table(spark, sf):
    """The ten largest singular values and the share of the variance of each."""
    m = ss.leading_subspace(fx.vectors(spark, sf), "embedding", 10)
    return spark.createDataFrame([(i + 1, float(x)) for i, x in enumerate(m.values)], "i int, value double")


@query("dim04_projected_rows")
def projected_rows(spark, sf):
    """Every vector's coordinates on the ten leading singular vectors."""
    v = fx.vectors(spark, sf)
    return ss.project_rows(v, "embedding", ss.leading_subspace(v, "embedding", 10), ["vec_id"])


# --- the library's classifiers: predictions, metrics, and losses a wrong model misses ---------------------


def _library_models():
    plain, scaled = cl.features_pipeline(NUMS), cl.features_pipeline(NUMS, scale=True)
    both = cl.features_pipeline(NUMS, category="lang", scale=True)
    return {"logistic": (cl.logistic(10), plain), "scaled": (cl.logistic(10), scaled), "category": (cl.logistic(10), both),
            "svm": (cl.svm(100), scaled), "tree": (cl.tree(5, "entropy"), plain)}


def _library_scores(spark, sf):
    """Every model's scores of all rows: ``model, doc_id, held_out, label, score, prediction``."""
    def build():
        train, test = _split(spark, sf)
        parts = []
        for name, (estimator, stages) in _library_models().items():
            model = cl.fit(train, estimator, stages)
            for held, side in ((False, train), (True, test)):
                parts.append(cl.positive_score(model.transform(side)).select(
                    F.lit(name).alias("model"), "doc_id", F.lit(held).alias("held_out"), "label", "score", "prediction"))
        return cut_lineage(rel.union_all(parts))
    return cached_model(spark, ("library-scores", sf), build)


@query("cls07_model_predictions")
def model_predictions(spark, sf):
    """Held-out rows with the score and class each fitted model gives them."""
    return _library_scores(spark, sf).where("held_out").drop("held_out")


@query("evl05_model_metrics")
def model_metrics(spark, sf):
    """Accuracy and areas under both curves of each fitted model on held-out rows."""
    return ev.ranking_metrics(_library_scores(spark, sf).where("held_out"), "score", "label", ["model"], pred="prediction")


@query("cls01_training_losses", W(f"""
SELECT model, count(*) AS n, true AS below_prior FROM labelled, (VALUES ('logistic'), ('scaled'), ('category'), ('svm'), ('tree')) m(model)
WHERE {_TEST_U} < 0.6 GROUP BY 1""", "labelled"))
def training_losses(spark, sf):
    """On the rows a model was fitted on its own loss lies below that of the best
    constant answer (flipped or constant scores do not pass)."""
    return losses_below_prior(_library_scores(spark, sf).where("not held_out"))


def losses_below_prior(rows):
    logs = ev.log_loss(rows.where("model <> 'svm'"), "score", by=["model"]).withColumnRenamed("log_loss", "loss")
    hinge = ev.hinge_loss(rows.where("model = 'svm'"), "score", by=["model"]).withColumnRenamed("hinge_loss", "loss")
    size = rows.groupBy("model").agg(F.count("*").alias("n"))
    return logs.unionByName(hinge).join(size, "model").select("model", "n", (F.col("loss") < F.col("prior_loss")).alias("below_prior"))


def _sweep_losses(spark, sf, values, make):
    """``(value, loss)``: training log-loss per parameter value, features fitted once."""
    train, _ = _split(spark, sf)
    tr, _ = cl.fit_features(train, train, cl.features_pipeline(NUMS, "lang", scale=True))
    tr = cut_lineage(tr)
    rows = cl.scored_models({str(i): make(v).fit(tr).transform(tr) for i, v in enumerate(values)}, name="i")
    out = {int(r["i"]): r["log_loss"] for r in ev.log_loss(rows, "score", by=["i"]).collect()}
    return [(float(v), float(out[i])) for i, v in enumerate(values)]


_SWEEPS = {"iterations": (ITERATIONS, lambda v: cl.logistic(int(v)), -1), "penalty": (PENALTIES, lambda v: cl.logistic(100, v), 1),
           "holdout penalty": (HOLDOUT_PENALTIES, lambda v: cl.logistic(100, v), 1)}


@query("tun01_training_losses", " UNION ALL ".join(
    f"SELECT '{name}' AS sweep, unnest({[float(v) for v in values]})::DOUBLE AS value, true AS in_order"
    for name, (values, _, _) in _SWEEPS.items()))
def sweep_losses(spark, sf):
    """TUN-1, TUN-3, TUN-6: training loss falls with iterations and rises with the
    penalty, value by value."""
    out = []
    for name, (values, make, sign) in _SWEEPS.items():
        got = _sweep_losses(spark, sf, values, make)
        out += [(name, v, i == 0 or sign * (loss - got[i - 1][1]) >= -1e-9) for i, (v, loss) in enumerate(got)]
    return spark.createDataFrame(out, "sweep string, value double, in_order boolean")


@query("tun03_library_metrics")
def library_sweep_metrics(spark, sf):
    """Held-out metrics of the library's logistic regression per penalty."""
    train, test = _split(spark, sf)
    return cl.sweep(train, test, lambda v: cl.logistic(100, v), sorted({*PENALTIES, *HOLDOUT_PENALTIES}), "penalty",
                    cl.features_pipeline(NUMS, "lang", scale=True))


@query("txt13_vectors")
def vectors_of_words(spark, sf):
    """The fitted vector of every word."""
    return _word2vec(spark, sf).getVectors().select("word", vector_to_array("vector").alias("vector"))


@query("txt13_neighbours_are_closer", W(_TOKENIZE_SQL + """
SELECT count(*) > 0 AS any_words, true AS closer FROM tk""", "tokens"))
def neighbours_are_closer(spark, sf):
    """Words that often stand together are closer to each other than the same words
    paired at random (the pairs shifted by one)."""
    arrays = stored_arrays(spark, sf)
    pairs = arrays.select(F.explode(F.zip_with(F.slice("tokens", 1, F.greatest(F.size("tokens") - 1, F.lit(0))),
                                               F.slice("tokens", 2, F.greatest(F.size("tokens") - 1, F.lit(0))),
                                               lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("p")).select("p.a", "p.b").where("a <> b")
    v = cut_lineage(_word2vec(spark, sf).getVectors().select("word", vector_to_array("vector").alias("v")))
    known = rel.count_by(pairs, ["a", "b"]).join(v.select(F.col("word").alias("a")), "a", "left_semi") \
               .join(v.select(F.col("word").alias("b")), "b", "left_semi")
    top = rel.top_k(known, [F.desc("n"), "a", "b"], 200).collect()      # 200 rows
    if len(top) < 2:
        return spark.createDataFrame([(bool(top), True)], "any_words boolean, closer boolean")
    rows = [(r["a"], r["b"], top[(i + 1) % len(top)]["b"]) for i, r in enumerate(top)]
    named = lambda c: v.select(F.col("word").alias(c), F.col("v").alias(f"v{c}"))
    both = spark.createDataFrame(rows, "a string, b string, c string").join(named("a"), "a").join(named("b"), "b").join(named("c"), "c")
    got = both.agg(F.avg(cosine("va", "vb")).alias("near"), F.avg(cosine("va", "vc")).alias("far")).first()
    return spark.createDataFrame([(True, got["near"] > got["far"])], "any_words boolean, closer boolean")
