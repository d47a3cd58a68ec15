"""Registered text queries (TXT-*, FN-12)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators import relational as rel
from quarry.operators import text as tx
from quarry.operators.evaluate import weighted_f1
from quarry.plans import fixtures as fx
from quarry.plans.q_core import _STOP_SQL
from quarry.plans.registry import cached_model, query, rounded
from quarry.session import by_key, cut_lineage, files_freed, stored
from quarry.sources.readers import from_rows

W = fx.with_fixtures
ANCHOR = "en"

# FIXED VALUES: the two word lists the text program weighs.
WORD_LISTS = [("common", "you"), ("common", "do"), ("common", "we"),
              ("uncommon", "telescope"), ("uncommon", "legislation"), ("uncommon", "investment")]

_TOKENIZE_SQL = f"""
, filt AS (SELECT * FROM tokens WHERE regexp_full_match(tok, '[^0-9]*'))
, rare AS (SELECT tok FROM filt GROUP BY tok HAVING count(*) < 2)
, tk AS (SELECT doc_id, topic, tok FROM filt
         WHERE tok NOT IN {_STOP_SQL} AND length(tok) >= 2 AND tok NOT IN (SELECT tok FROM rare))
"""
_TFIDF_SQL = _TOKENIZE_SQL + """
, tf AS (SELECT doc_id, tok, count(*) AS tf FROM tk GROUP BY doc_id, tok)
, df AS (SELECT tok, count(*) AS df FROM tf GROUP BY tok)
, nd AS (SELECT count(*) AS n FROM documents)
, tfidf AS (SELECT doc_id, tf.tok, tf, ln(((SELECT n FROM nd) + 1) / (df + 1)) AS idf,
                   tf * ln(((SELECT n FROM nd) + 1) / (df + 1)) AS tfidf
            FROM tf JOIN df ON tf.tok = df.tok)
"""


def kept_stats(spark, sf):
    """(doc_id, tok, tf, df) of the tokens the full tokenizer keeps."""
    return tx.term_stats(fx.tokens(spark, sf))


def kept_counts(spark, sf):
    """(doc_id, tok, tf) of the same."""
    return tx.kept_frequencies(tx.tokens_word(by_key(fx.docs(spark, sf), "doc_id")))


def exact_tfidf(spark, sf):
    n = fx.docs(spark, sf).count()  # corpus size: one scalar
    return tx.tfidf_exact(fx.tokens(spark, sf), n), n


@query("txt01_tokens_space", """
SELECT tok, count(*) AS n FROM (SELECT lower(unnest(string_split(text, ' '))) AS tok FROM documents) GROUP BY tok""")
def tokens_space(spark, sf):
    return rel.count_by(tx.tokens_space(fx.docs(spark, sf)), "tok")


@query("txt02_tokens_word", W("""
SELECT count(*) AS n_tokens, count(DISTINCT tok) AS n_distinct FROM tokens""", "tokens"))
def tokens_word(spark, sf):
    t = tx.tokens_word(fx.docs(spark, sf))
    return t.agg(F.count("*").alias("n_tokens"), F.count_distinct("tok").alias("n_distinct"))


@query("txt03_tokenize", W(_TOKENIZE_SQL + """
SELECT doc_id, tok, count(*) AS tf FROM tk GROUP BY doc_id, tok""", "tokens"))
def tokenize(spark, sf):
    return kept_counts(spark, sf)


@query("txt04_token_report", W(f"""
, c AS (SELECT tok, count(*) AS n FROM tokens WHERE regexp_full_match(tok, '[^0-9]*') GROUP BY tok)
, s AS (SELECT 'raw' AS step, tok, n FROM c
        UNION ALL SELECT 'no_stop', tok, n FROM c WHERE tok NOT IN {_STOP_SQL}
        UNION ALL SELECT 'sized', tok, n FROM c WHERE tok NOT IN {_STOP_SQL} AND length(tok) >= 2
        UNION ALL SELECT 'no_rare', tok, n FROM c WHERE tok NOT IN {_STOP_SQL} AND length(tok) >= 2 AND n >= 2)
SELECT step, tok, n, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY step ORDER BY n DESC, tok) AS rank FROM s) WHERE rank <= 20""",
                                 "tokens"))
def token_report(spark, sf):
    return tx.token_report(fx.tokens(spark, sf), 20)


@query("txt05_docs_per_topic", "SELECT lang AS topic, count(*) AS n FROM documents GROUP BY lang ORDER BY n DESC")
def docs_per_topic(spark, sf):
    return rel.sort_desc(rel.count_by(fx.docs(spark, sf), "topic"), "n", "topic")


@query("txt07_tfidf_exact", W(_TFIDF_SQL + """
SELECT doc_id, tok, tf, round(idf, 6) AS idf, round(tfidf, 6) AS tfidf FROM tfidf""", "tokens"))
def tfidf_exact(spark, sf):
    t, _ = exact_tfidf(spark, sf)
    return rounded(t)


@query("txt08_value_range", W(_TFIDF_SQL + """
SELECT round(min(tfidf), 6) AS min_value, round(max(tfidf), 6) AS max_value FROM tfidf""", "tokens"))
def value_range(spark, sf):
    t, _ = exact_tfidf(spark, sf)
    return rounded(rel.value_range(t, "tfidf"))


_WORDS_SQL = ", ".join(f"('{a}', '{b}')" for a, b in WORD_LISTS)


@query("txt09_weigh_terms", W(_TFIDF_SQL + f"""
, words(list, tok) AS (VALUES {_WORDS_SQL})
SELECT w.list, w.tok, round(ln(((SELECT n FROM nd) + 1) / (coalesce(df.df, 0) + 1)), 6) AS weight
FROM words w LEFT JOIN df ON w.tok = df.tok""", "tokens"))
def weigh_terms(spark, sf):
    n = fx.docs(spark, sf).count()
    words = from_rows(spark, WORD_LISTS, "list string, tok string")
    listed = fx.tokens(spark, sf).where(F.col("tok").isin([w for _, w in WORD_LISTS]))  # six words, before any shuffle
    df = tx.term_stats(listed).groupBy("tok").agg(F.max("df").alias("df"))
    return rounded(tx.weigh_terms(words, df, n))


_PICK = "(((doc_id % 1000003) * 427799 + {seed}) % 1000003) / 1000003.0"


@query("txt10_topic_similarity", W(_TFIDF_SQL + f"""
, picks AS (SELECT topic, arg_min(doc_id, {_PICK.format(seed=42)}) AS doc_id FROM docs GROUP BY topic)
, second AS (SELECT topic, arg_min(doc_id, {_PICK.format(seed=43)}) AS doc_id FROM docs
             WHERE topic = '{ANCHOR}' GROUP BY topic)
, anchor AS (SELECT doc_id FROM picks WHERE topic = '{ANCHOR}')
, pairs AS (SELECT '{ANCHOR}' AS topic_a, (SELECT doc_id FROM anchor) AS doc_a, topic AS topic_b, doc_id AS doc_b
            FROM (SELECT * FROM picks WHERE topic <> '{ANCHOR}' UNION ALL SELECT * FROM second))
, norms AS (SELECT doc_id, sqrt(sum(tfidf * tfidf)) AS nrm FROM tfidf GROUP BY doc_id)
, dots AS (SELECT p.doc_a, p.doc_b, sum(a.tfidf * b.tfidf) AS dot
           FROM (SELECT DISTINCT doc_a, doc_b FROM pairs) p JOIN tfidf a ON a.doc_id = p.doc_a
           JOIN tfidf b ON b.doc_id = p.doc_b AND a.tok = b.tok GROUP BY p.doc_a, p.doc_b)
SELECT p.topic_a, p.doc_a, p.topic_b, p.doc_b,
       round(CASE WHEN na.nrm * nb.nrm <> 0 THEN coalesce(d.dot, 0) / (na.nrm * nb.nrm) END, 6) AS cosine
FROM pairs p LEFT JOIN dots d ON p.doc_a = d.doc_a AND p.doc_b = d.doc_b
LEFT JOIN norms na ON na.doc_id = p.doc_a LEFT JOIN norms nb ON nb.doc_id = p.doc_b""", "docs", "tokens"))
def topic_similarity(spark, sf):
    t, _ = exact_tfidf(spark, sf)
    return rounded(tx.topic_similarity(fx.docs(spark, sf), t, ANCHOR))


# --- model path -------------------------------------------------------------------


def token_arrays(spark, sf, docs=None, kept=None):
    """Kept tokens of each document in text order."""
    docs = fx.docs(spark, sf) if docs is None else docs
    kept = tx.kept_words(fx.tokens(spark, sf)) if kept is None else kept
    return tx.doc_token_arrays(docs, kept, keep=["topic"], clean=True)


def _stored(c):
    """Stored entries of a sparse (or dense) vector column, as array<double>."""
    return F.unwrap_udt(c)["values"]


@query("txt06_hashed_tf", W(_TOKENIZE_SQL + """
SELECT doc_id, count(*)::DOUBLE AS n_tokens, true AS terms_fit FROM tk GROUP BY doc_id""", "tokens"))
def hashed_tf(spark, sf):
    """Hashed term frequencies (2^18 wide): the stored counts add up to the
    document's tokens and there are no more of them than distinct tokens."""
    tf = tx.hashed_tf(token_arrays(spark, sf))
    v = _stored("tf")
    fit = (F.size(v) <= F.size(F.array_distinct("tokens"))) & (F.size(v) >= 1)
    return tf.select("doc_id", F.aggregate(v, F.lit(0.0), lambda a, x: a + x).alias("n_tokens"), fit.alias("terms_fit"))


@query("txt07_tfidf_library", W(_TFIDF_SQL + """
SELECT doc_id, true AS in_range FROM tfidf GROUP BY doc_id""", "tokens"))
def tfidf_library(spark, sf):
    """Library IDF on hashed TF: every stored weight lies between 0 and the
    weight of the document's commonest term if that were in one document."""
    arrays = cut_lineage(token_arrays(spark, sf))   # read by the fit, the weights and the count
    model, t = tx.tfidf(arrays)
    n = arrays.count()
    w, tf = _stored("tfidf"), _stored("tf")
    top = F.array_max(tf) * F.log(F.lit((n + 1) / 2.0)) + F.lit(1e-9)
    return t.select("doc_id", ((F.array_min(w) >= 0) & (F.array_max(w) <= top)).alias("in_range"))


_SPLIT_U = "(((doc_id % 1000003) * 427799 + 123) % 1000003) / 1000003.0"


@query("txt11_topic_classifier", W(f"""
, filt AS (SELECT * FROM tokens WHERE regexp_full_match(tok, '[^0-9]*'))
, rare AS (SELECT tok FROM filt WHERE {_SPLIT_U} < 0.6 GROUP BY tok HAVING count(*) >= 2)
, seen AS (SELECT DISTINCT doc_id FROM filt WHERE tok NOT IN {_STOP_SQL} AND length(tok) >= 2 AND tok IN (SELECT tok FROM rare))
SELECT 'tfidf' AS variant, count(*) AS n_test, true AS beats_largest FROM seen WHERE {_SPLIT_U} >= 0.6
UNION ALL SELECT 'raw', count(*), true FROM documents WHERE {_SPLIT_U} >= 0.6""", "tokens"))
def topic_classifier(spark, sf):
    """Naive Bayes on TF-IDF (processed tokens) and on raw TF (whitespace
    tokens). The split comes first; which tokens are rare is decided on the
    training documents alone. Both variants must beat always answering the
    largest topic of the test documents, in accuracy and weighted F1."""
    train, test = rel.split_by_hash(fx.docs(spark, sf), "doc_id", 0.6, 123)
    kept = cut_lineage(tx.kept_words(tx.tokens_word(train)))
    rows = []
    for variant in ("tfidf", "raw"):
        if variant == "raw":
            tr, te = [d.select("doc_id", "topic", F.split("text", " ").alias("tokens")) for d in (train, test)]
        else:
            # the stages of the fit read the training words three times: they are made once
            tr, te = [tx.doc_token_arrays(d, kept, keep=["topic"], clean=True) for d in (train, test)]
            tr = stored(tr, "train-words")
        pred = cut_lineage(tx.topic_classifier(tr, te, use_idf=variant == "tfidf").select("label", "prediction"))
        classes = pred.groupBy("label").agg(F.count("*").alias("c"), F.sum((F.col("label") == F.col("prediction")).cast("long")).alias("h"))
        n = F.sum("c").cast("double")
        f1 = weighted_f1(pred, "prediction").first()[0]  # one number
        rows.append(classes.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n_test"),
                                ((F.sum("h") / n > F.max("c") / n) & (F.lit(f1) > F.max("c") / n)).alias("beats_largest"))
                    .select(F.lit(variant).alias("variant"), "n_test", "beats_largest"))
    return rel.union_all(rows)


def stored_arrays(spark, sf):
    """``token_arrays`` made once, in the partitions they have: the fit reads them twice,
    its check once more."""
    def build():
        with files_freed(spark):
            return cut_lineage(token_arrays(spark, sf))
    return cached_model(spark, ("token-arrays", sf), build)


def _word2vec(spark, sf):
    """One fit per session and data path serves both word-vector queries."""
    return cached_model(spark, ("word2vec", sf), lambda: tx.word_vectors(stored_arrays(spark, sf)))


@query("txt13_word_vectors", W(_TOKENIZE_SQL + """
SELECT tok AS word, count(*) AS n, 100 AS dim, true AS usable FROM tk GROUP BY tok HAVING count(*) >= 5""", "tokens"))
def word_vectors(spark, sf):
    """Word2Vec (size 100, seed 42) over the kept tokens in text order: every
    word seen five times or more has a finite vector that is not zero."""
    counts = tx.kept_words(fx.tokens(spark, sf)).withColumnRenamed("tok", "word")
    v = _word2vec(spark, sf).getVectors().withColumn("v", vector_to_array("vector"))
    usable = F.forall("v", lambda x: ~F.isnan(x)) & F.exists("v", lambda x: x != 0)
    return v.join(counts, "word", "left").select("word", "n", F.size("v").alias("dim"), usable.alias("usable"))


# FIXED VALUES: the words whose neighbours the text program lists.
NAMED_WORDS = ["hockey", "legislation"]


@query("txt14_nearest_words", W(_TOKENIZE_SQL + f"""
, vocab AS (SELECT tok, count(*) AS n FROM tk GROUP BY tok HAVING count(*) >= 5)
, asked AS (SELECT tok FROM (SELECT tok FROM vocab ORDER BY n DESC, tok LIMIT 1)
            UNION SELECT tok FROM vocab WHERE tok IN ('{"', '".join(NAMED_WORDS)}'))
SELECT tok AS asked, unnest(range(1, least(20, (SELECT count(*) FROM vocab) - 1) + 1)) AS pos, true AS as_exact
FROM asked""", "tokens"))
def nearest_words(spark, sf):
    """20 nearest words to the named words that occur and to the commonest one;
    the library's similarities equal the exact cosines."""
    m = _word2vec(spark, sf)
    vectors = cut_lineage(m.getVectors())
    counts = tx.kept_words(fx.tokens(spark, sf)).where("n >= 5")
    top = rel.top_k(counts, [F.desc("n"), F.asc("tok")], 1).first()
    named = {r["word"] for r in vectors.where(F.col("word").isin(NAMED_WORDS)).select("word").collect()}
    rows = []
    for word in sorted({*named, *([top["tok"]] if top else [])}):
        lib = tx.nearest_words(m, word, 20).select("word", F.col("similarity").alias("lib"))
        exact = tx.nearest_words_exact(vectors, word, 20)
        # both lists have at most 20 rows
        nth = lambda d, c: d.withColumn("pos", F.row_number().over(Window.orderBy(F.desc(c), "word")).cast("long"))
        both = nth(exact, "similarity").join(nth(lib, "lib").drop("word"), "pos")
        rows.append(both.select(F.lit(word).alias("asked"), "pos", (F.abs(F.col("lib") - F.col("similarity")) < 1e-4).alias("as_exact")))
    return rel.union_all(rows) if rows else spark.createDataFrame([], "asked string, pos long, as_exact boolean")


@query("agg06_group_lists", W(_TOKENIZE_SQL + """
SELECT doc_id, string_agg(DISTINCT tok, ' ' ORDER BY tok) AS tokens FROM tk GROUP BY doc_id""", "tokens"))
def group_lists(spark, sf):
    """AGG-6 on a group bounded by construction: each document's sorted
    distinct kept tokens (never a list per user or per key of unbounded size)."""
    lists = rel.group_lists(kept_counts(spark, sf), "doc_id", "tok", "values")
    return lists.select("doc_id", F.array_join("values", " ").alias("tokens"))


@query("txt03_kept_tokens", W(_TOKENIZE_SQL + "SELECT tok, count(*) AS n FROM tk GROUP BY tok", "tokens"))
def kept_tokens(spark, sf):
    """TXT-3 on the token rows themselves (an anti join drops the rare ones)."""
    return rel.count_by(tx.tokenize(tx.tokens_word(fx.docs(spark, sf))), "tok")
