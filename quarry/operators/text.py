"""Text mining (SURVEY TXT-*).

Tokens are kept in long form ``(doc_id, tok)``: explode + filters are narrow,
counts are partial aggregates, the rare-token removal is an anti join (AQE
splits hot tokens), and exact TF-IDF / cosine are equi-joins on the term. The
model path (hashed TF, IDF, naive Bayes, Word2Vec) uses ``pyspark.ml`` on
per-document token arrays, whose size is bounded by the document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators import relational as rel
from quarry.operators import shape as sh
from quarry.session import by_key, cut_lineage

NO_DIGITS = "[^0-9]*"
HASH_DIM = 1 << 18


def tokens_space(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """TXT-1: whitespace tokens, lower-cased (empties kept, as split gives them)."""
    keep = keep or ["doc_id"]
    return sh.explode_tokens(docs, text, " ", "tok", keep).withColumn("tok", F.lower("tok"))


def tokens_word(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """TXT-2: tokens between runs of non-word characters, lower-cased; the
    empty leading token of a split is dropped."""
    keep = keep or ["doc_id"]
    t = sh.explode_tokens(docs, text, r"\W+", "tok", keep).where(F.col("tok") != "")
    return t.withColumn("tok", F.lower("tok"))


def clean_tokens(tokens: DataFrame, stopwords: list[str] = sh.STOPWORDS, min_len: int = 2, tok: str = "tok") -> DataFrame:
    """The filters of TXT-3 that look at the token alone: no digit, no stop word,
    at least ``min_len`` long."""
    return sh.min_length(sh.drop_stopwords(sh.filter_matches(tokens, tok, NO_DIGITS), tok, stopwords), tok, min_len)


def tokenize(tokens: DataFrame, stopwords: list[str] = sh.STOPWORDS, rare_below: int = 2,
             min_len: int = 2, tok: str = "tok") -> DataFrame:
    """TXT-3: digits-free, not a stop word, not rare (corpus count below
    ``rare_below`` after the digit filter), at least ``min_len`` long."""
    t = sh.filter_matches(tokens, tok, NO_DIGITS)
    rare = sh.rare_keys(t, tok, rare_below)
    t = sh.drop_stopwords(t, tok, stopwords)
    t = sh.min_length(t, tok, min_len)
    return sh.drop_keys(t, rare, tok)


def token_report(tokens: DataFrame, k: int = 20, tok: str = "tok") -> DataFrame:
    """TXT-4: the top ``k`` tokens after each filtering step."""
    counts = rel.count_by(sh.filter_matches(tokens, tok, NO_DIGITS), tok)
    rare = counts.where(F.col("n") < 2).select(tok)
    steps = [("raw", counts)]
    no_stop = sh.drop_stopwords(counts, tok)
    steps.append(("no_stop", no_stop))
    sized = sh.min_length(no_stop, tok, 2)
    steps.append(("sized", sized))
    steps.append(("no_rare", sh.drop_keys(sized, rare, tok)))
    out = []
    for name, df in steps:
        top = rel.top_k(df, [F.desc("n"), F.asc(tok)], k)
        out.append(top.select(F.lit(name).alias("step"), tok, "n"))
    ranked = rel.union_all(out)
    # rank inside each step: at most k rows per step
    return rel.top_n_per_group(ranked, "step", [F.desc("n"), F.asc(tok)], k, "rank") \
        .withColumn("rank", F.col("rank").cast("long"))


def term_frequencies(tokens: DataFrame, doc: str = "doc_id", tok: str = "tok") -> DataFrame:
    """(doc, tok, tf): combined map-side."""
    return tokens.groupBy(doc, tok).agg(F.count("*").alias("tf"))


def term_stats(tokens: DataFrame, stopwords: list[str] = sh.STOPWORDS, rare_below: int = 2, min_len: int = 2,
               doc: str = "doc_id", tok: str = "tok") -> DataFrame:
    """TXT-3 in one pass over the text, aggregated: (doc, tok, tf, df) for the
    tokens ``tokenize`` keeps.

    The stop-word and length filters drop whole token types and never change
    a kept token's corpus count, so "rare" (count below ``rare_below`` after
    the digit filter) is decided from the per-token totals of the filtered
    (doc, tok) counts: one partial aggregate and one join on the term, no
    second tokenizing pass and no anti join against the raw stream."""
    tf = term_frequencies(clean_tokens(tokens, stopwords, min_len, tok), doc, tok)
    stats = tf.groupBy(tok).agg(F.sum("tf").alias("_total"), F.count("*").alias("df"))
    return (tf.join(stats.where(F.col("_total") >= rare_below), tok)
            .select(doc, tok, "tf", "df"))


def kept_frequencies(tokens: DataFrame, stopwords: list[str] = sh.STOPWORDS, rare_below: int = 2, min_len: int = 2,
                     doc: str = "doc_id", tok: str = "tok") -> DataFrame:
    """(doc, tok, tf) of the tokens ``tokenize`` keeps, for tokens that lie by document
    (``session.by_key``): no row per (doc, tok) is sent.

    A rare word occurs in fewer than ``rare_below`` rows, so the documents it is in
    are as few; (doc, rare word) pairs are sent to the documents and meet the counts
    in the one aggregate that makes them."""
    words = clean_tokens(tokens, stopwords, min_len, tok)
    rare = words.groupBy(tok).agg(F.count("*").alias("_n"), F.min(doc).alias(doc)).where(F.col("_n") < rare_below)
    if rare_below > 2:      # a rare word can be in more than one document
        rare = words.join(rare.select(tok), tok)
    both = words.select(doc, tok, F.lit(1).cast("long").alias("_c"), F.lit(False).alias("_r")).unionAll(
        by_key(rare, doc).select(doc, tok, F.lit(0).cast("long").alias("_c"), F.lit(True).alias("_r")))
    return both.groupBy(doc, tok).agg(F.sum("_c").alias("tf"), F.max("_r").alias("_r")).where(~F.col("_r")).select(doc, tok, "tf")


def kept_words(tokens: DataFrame, stopwords: list[str] = sh.STOPWORDS, rare_below: int = 2, min_len: int = 2,
               tok: str = "tok") -> DataFrame:
    """(tok, n): the words ``tokenize`` keeps and how often each occurs. Counts are
    combined before the one shuffle; no row per document leaves a task."""
    n = clean_tokens(tokens, stopwords, min_len, tok).groupBy(tok).agg(F.count("*").alias("n"))
    return n.where(F.col("n") >= rare_below)


def tfidf_exact(tokens: DataFrame, n_docs: int, doc: str = "doc_id", tok: str = "tok") -> DataFrame:
    """TXT-7 (exact, long form): (doc, tok, tf, idf, tfidf) of the tokens kept
    by the full tokenizer."""
    st = term_stats(tokens, doc=doc, tok=tok)
    idf = F.log((F.lit(n_docs) + 1) / (F.col("df") + 1))
    return st.select(doc, tok, "tf", idf.alias("idf"), (F.col("tf") * idf).alias("tfidf"))


def weigh_terms(word_lists: DataFrame, idf: DataFrame, n_docs: int, tok: str = "tok") -> DataFrame:
    """TXT-9: TF-IDF weight of each listed word (tf = 1); an unseen word has
    df = 0. The word lists are small; the idf table is joined on the term."""
    j = word_lists.join(idf.select(tok, "df"), tok, "left")
    w = F.log((F.lit(n_docs) + 1) / (F.coalesce(F.col("df"), F.lit(0)) + 1))
    return j.select(*word_lists.columns, w.alias("weight"))


def sparse_cosine(weights: DataFrame, pairs: DataFrame, doc: str = "doc_id", tok: str = "tok",
                  w: str = "tfidf") -> DataFrame:
    """FN-12: cosine of long-form sparse vectors for the given (doc_a, doc_b)
    pairs: dot by an equi-join on (pair, term), norms by aggregation."""
    p = pairs.select("doc_a", "doc_b").distinct()
    # only documents that take part in a pair (a semi join against a list
    # bounded by the number of pairs) are normed and joined
    used = p.select(F.col("doc_a").alias(doc)).union(p.select(F.col("doc_b").alias(doc))).distinct()
    weights = weights.join(used, doc, "left_semi")
    norms = weights.groupBy(doc).agg(F.sqrt(F.sum(F.col(w) * F.col(w))).alias("_norm"))
    a = weights.select(F.col(doc).alias("doc_a"), tok, F.col(w).alias("_wa"))
    b = weights.select(F.col(doc).alias("doc_b"), tok, F.col(w).alias("_wb"))
    dots = (p.join(a, "doc_a").join(b, ["doc_b", tok])
            .groupBy("doc_a", "doc_b").agg(F.sum(F.col("_wa") * F.col("_wb")).alias("_dot")))
    na = norms.select(F.col(doc).alias("doc_a"), F.col("_norm").alias("_na"))
    nb = norms.select(F.col(doc).alias("doc_b"), F.col("_norm").alias("_nb"))
    out = p.join(dots, ["doc_a", "doc_b"], "left").join(na, "doc_a", "left").join(nb, "doc_b", "left")
    cos = F.when(F.col("_na") * F.col("_nb") != 0,
                 F.try_divide(F.coalesce(F.col("_dot"), F.lit(0.0)), F.col("_na") * F.col("_nb")))
    return out.select("doc_a", "doc_b", cos.alias("cosine"))


def topic_similarity(docs: DataFrame, weights: DataFrame, anchor_topic: str, seed: int = 42,
                     second_seed: int = 43, doc: str = "doc_id", topic: str = "topic") -> DataFrame:
    """TXT-10: one document per topic picked by hash; the anchor topic's pick
    compared with a second pick of its own topic and with every other topic's
    pick.

    The picks are one row per topic (bounded by the topic count), so they are
    read once; the weights are then restricted to the picked documents with an
    IN list that the optimizer pushes into the term-frequency side (the
    document-frequency side still covers the whole corpus), and materialised
    once for the norm and both join sides."""
    spark = docs.sparkSession
    ids = docs.select(doc, topic)
    picks = {r[topic]: r[doc] for r in rel.pick_by_hash(ids, doc, seed, [topic]).collect()}
    schema = f"topic_a string, doc_a long, topic_b string, doc_b long"
    if anchor_topic not in picks:
        return spark.createDataFrame([], schema + ", cosine double")
    second = rel.pick_by_hash(ids.where(F.col(topic) == anchor_topic), doc, second_seed, [topic]).first()
    others = [(t, d) for t, d in sorted(picks.items()) if t != anchor_topic] + [(anchor_topic, second[doc])]
    anchor = picks[anchor_topic]
    pairs = spark.createDataFrame([(anchor_topic, anchor, t, d) for t, d in others], schema)
    used = sorted({anchor, *[d for _, d in others]})
    picked = cut_lineage(weights.where(F.col(doc).isin(used)))
    sims = sparse_cosine(picked, pairs, doc)
    return pairs.join(sims, ["doc_a", "doc_b"], "left").select("topic_a", "doc_a", "topic_b", "doc_b", "cosine")


def doc_token_arrays(docs: DataFrame, kept: DataFrame, doc: str = "doc_id", text: str = "text", tok: str = "tok",
                     keep: list[str] | None = None, clean: bool = False) -> DataFrame:
    """Per-document token arrays in the order of the text (bounded by the
    document): the words of ``text`` that are in ``kept``, one row per word.

    Words carry their position through the join with the kept ones and each
    document's array is sorted by it, so word windows mean what they meant in the
    text and the result does not depend on the shuffle. A document without a kept
    word has no row. ``clean``: no kept word is a stop word, has a digit or is
    shorter than two letters, so such words are dropped before the shuffle."""
    keep = keep or []
    words = (docs.select(doc, *keep, F.posexplode(F.split(text, r"\W+")).alias("_pos", tok))
             .where(F.col(tok) != "").withColumn(tok, F.lower(tok)))
    if clean:
        words = clean_tokens(words, sh.STOPWORDS, 2, tok)
    rows = words.join(kept.select(tok).distinct(), tok).groupBy(doc, *keep).agg(
        F.array_sort(F.collect_list(F.struct("_pos", tok))).alias("_t"))
    return rows.select(doc, *keep, F.transform("_t", lambda x: x[tok]).alias("tokens"))


def hashed_tf(arrays: DataFrame, dim: int = HASH_DIM, col: str = "tokens", out: str = "tf") -> DataFrame:
    """TXT-6: hashed term frequencies (sparse vector of width ``dim``)."""
    from pyspark.ml.feature import HashingTF
    return HashingTF(inputCol=col, outputCol=out, numFeatures=dim).transform(arrays)


def tfidf(arrays: DataFrame, dim: int = HASH_DIM, col: str = "tokens"):
    """TXT-7 (library): fitted IDF model and the TF-IDF frame."""
    from pyspark.ml.feature import IDF
    tf = hashed_tf(arrays, dim, col)
    model = IDF(inputCol="tf", outputCol="tfidf").fit(tf)
    return model, model.transform(tf)


def topic_classifier(train: DataFrame, test: DataFrame, label_col: str = "topic", col: str = "tokens",
                     use_idf: bool = True, smoothing: float = 0.1, dim: int = HASH_DIM) -> DataFrame:
    """TXT-11/12: naive Bayes over hashed TF (-IDF) fitted on the training
    documents only; returns the test predictions with numeric labels."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import NaiveBayes
    from pyspark.ml.feature import IDF, HashingTF, StringIndexer
    stages = [StringIndexer(inputCol=label_col, outputCol="label", handleInvalid="keep",
                            stringOrderType="alphabetAsc"),
              HashingTF(inputCol=col, outputCol="tf", numFeatures=dim)]
    if use_idf:
        stages.append(IDF(inputCol="tf", outputCol="features"))
        feats = "features"
    else:
        feats = "tf"
    stages.append(NaiveBayes(featuresCol=feats, labelCol="label", smoothing=smoothing, modelType="multinomial"))
    model = Pipeline(stages=stages).fit(train)
    return model.transform(test)


def word_vectors(arrays: DataFrame, col: str = "tokens", size: int = 100, seed: int = 42, min_count: int = 5,
                 partitions: int = 8):
    """TXT-13: Word2Vec model, trained in ``partitions`` tasks whose vectors are
    averaged after each pass."""
    from pyspark.ml.feature import Word2Vec
    return Word2Vec(inputCol=col, outputCol="w2v", vectorSize=size, seed=seed, minCount=min_count,
                    numPartitions=partitions).fit(arrays)


def nearest_words(model, word: str, k: int = 20) -> DataFrame:
    """TXT-14: the ``k`` words closest to ``word`` by cosine."""
    return model.findSynonyms(word, k)


def nearest_words_exact(vectors: DataFrame, word: str, k: int = 20) -> DataFrame:
    """TXT-14 exact check: cosine of every word vector with the query word's
    (one vector to the driver), top ``k`` excluding the word itself."""
    from pyspark.ml.functions import vector_to_array

    from quarry.functions.scalar import cosine
    v = vectors.select("word", vector_to_array("vector").alias("v"))
    q = v.where(F.col("word") == word).first()
    if q is None:
        return v.limit(0).select("word", F.lit(0.0).alias("similarity"))
    qv = F.array(*[F.lit(float(x)) for x in q["v"]])
    sims = v.where(F.col("word") != word).select("word", cosine("v", qv).alias("similarity"))
    return rel.top_k(sims, [F.desc("similarity"), F.asc("word")], k)

