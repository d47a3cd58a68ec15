"""Registered relational queries: PRJ, FLT, JN, AGG, WIN, SRT, SET, SMP, FN."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import scalar as fn
from quarry.operators import relational as rel
from quarry.operators import shape as sh
from quarry.plans import fixtures as fx
from quarry.plans.registry import query, rounded
from quarry.session import cut_lineage, read_table

W = fx.with_fixtures
USER = 789  # the user the recommender program inspects
TOPN = 20

# --- projections ----------------------------------------------------------------


@query("prj01_take_fields", W("""
SELECT string_split(value, chr(9))[1] AS f0, string_split(value, chr(9))[2] AS f1,
       string_split(value, chr(9))[3] AS f2 FROM raw_rows""", "labelled", "raw_rows"))
def take_fields(spark, sf):
    return sh.take_fields(fx.raw_rows(spark, sf), "value", "\t", 3)


_PARSE_SQL = """
, f AS (SELECT list_transform(string_split(value, chr(9)), lambda x: replace(x, '"', '')) AS f FROM raw_rows)
, p AS (SELECT f[1] AS id, f[4] AS category,
               list_transform(f[5:len(f) - 1],
                              lambda x: CASE WHEN x = '?' THEN 0.0 ELSE TRY_CAST(x AS DOUBLE) END) AS nums,
               TRY_CAST(f[len(f)] AS DOUBLE) AS label FROM f)
"""


@query("prj02_parse_labelled", W(_PARSE_SQL + """
SELECT id::BIGINT AS doc_id, category, round(nums[1], 6) AS n_chars, round(nums[2], 6) AS n_words,
       round(nums[3], 6) AS toxic, len(nums)::BIGINT AS n_nums, label FROM p""", "labelled", "raw_rows"))
def parse_labelled(spark, sf):
    p = sh.cast_fields(sh.parse_labelled(fx.raw_rows(spark, sf)), {"id": "long"})
    return rounded(p.select(F.col("id").alias("doc_id"), "category",
                            F.col("nums")[0].alias("n_chars"), F.col("nums")[1].alias("n_words"),
                            F.col("nums")[2].alias("toxic"), F.size("nums").cast("long").alias("n_nums"),
                            "label"))


@query("prj05_clamp_min", W(_PARSE_SQL + """
SELECT id::BIGINT AS doc_id, round(greatest(nums[1], 0.0), 6) AS n_chars,
       round(greatest(nums[2], 0.0), 6) AS n_words FROM p""", "labelled", "raw_rows"))
def clamp(spark, sf):
    p = sh.parse_labelled(fx.raw_rows(spark, sf), clamp=True)
    return rounded(p.select(F.col("id").cast("long").alias("doc_id"),
                            F.col("nums")[0].alias("n_chars"), F.col("nums")[1].alias("n_words")))


@query("prj06_assemble", W("""
SELECT doc_id, label, len([n_chars, n_words, toxic])::BIGINT AS n_features,
       round(n_chars + n_words + toxic, 6) AS feature_sum FROM labelled""", "labelled"))
def assemble(spark, sf):
    from pyspark.ml.functions import vector_to_array
    a = sh.assemble(fx.labelled(spark, sf), ["n_chars", "n_words", "toxic"])
    arr = vector_to_array("features")
    return rounded(a.select("doc_id", "label", F.size(arr).cast("long").alias("n_features"),
                            F.aggregate(arr, F.lit(0.0), lambda s, x: s + x).alias("feature_sum")))


@query("prj08_parent_dir", """
SELECT page_id, string_split(url, '/')[-2] AS topic FROM pages""")
def parent_dir(spark, sf):
    return fx.paths(spark, sf).select("page_id", sh.parent_dir("url").alias("topic"))


@query("prj09_strip_prefix", """
SELECT page_id, CASE WHEN starts_with(url, 'https://') THEN substr(url, 9) ELSE url END AS path FROM pages""")
def strip_prefix(spark, sf):
    return fx.paths(spark, sf).select("page_id", sh.strip_prefix("url", "https://").alias("path"))


@query("prj12_decode_flags", W("""
, e AS (SELECT id, title, unnest(flags) AS flag, generate_subscripts(flags, 1) - 1 AS pos FROM items)
, d AS (SELECT id, string_agg(g.name, ' ' ORDER BY e.pos) AS genres
        FROM e JOIN genres g ON e.pos = g.idx WHERE flag = '1' GROUP BY id)
SELECT i.id, i.title, coalesce(d.genres, '') AS genres FROM items i LEFT JOIN d ON i.id = d.id""",
                                    "genres", "items"))
def decode_flags(spark, sf):
    return sh.decode_flags(fx.items(spark, sf), fx.genres(spark, sf))


@query("prj14_one_hot", W("""
, idx AS (SELECT lang, row_number() OVER (ORDER BY lang) - 1 AS i FROM (SELECT DISTINCT lang FROM labelled))
, n AS (SELECT count(*) AS n FROM idx)
SELECT l.doc_id,
       array_to_string(list_transform(range(0, (SELECT n FROM n)),
                       lambda x: CASE WHEN x = idx.i THEN '1' ELSE '0' END), ',') AS one_hot,
       ((SELECT n FROM n) + 3)::BIGINT AS n_features
FROM labelled l JOIN idx ON l.lang = idx.lang""", "labelled"))
def one_hot(spark, sf):
    lab = fx.labelled(spark, sf)
    idx = sh.index_values(lab, "lang", "i")
    n = idx.count()  # width of the encoding: one scalar
    oh = sh.one_hot(F.col("i"), n)
    j = lab.join(idx, "lang")
    feats = F.concat(oh, F.array("n_chars", "n_words", "toxic"))
    return j.select("doc_id", F.array_join(F.transform(oh, lambda x: x.cast("int").cast("string")), ",")
                    .alias("one_hot"), F.size(feats).cast("long").alias("n_features"))


@query("prj15_index_values", """
SELECT source, row_number() OVER (ORDER BY source) - 1 AS idx FROM (SELECT DISTINCT source FROM documents)""")
def index_values(spark, sf):
    return sh.index_values(read_table(spark, sf, "documents"), "source", "idx")


@query("prj16_fmt_pct", W("""
SELECT lang, printf('%.4f%%', avg(label) * 100.0) AS pct FROM labelled GROUP BY lang""", "labelled"))
def fmt_pct(spark, sf):
    return fx.labelled(spark, sf).groupBy("lang").agg(sh.fmt_pct(F.avg("label")).alias("pct"))


# --- filters -----------------------------------------------------------------------


@query("flt01_filter_contains", W("""
SELECT 'a' AS needle, count(*) AS n FROM lines WHERE contains(value, 'a')
UNION ALL SELECT 'b', count(*) FROM lines WHERE contains(value, 'b')""", "lines"))
def filter_contains(spark, sf):
    ln = fx.lines(spark, sf)
    return rel.union_all([rel.row_count(sh.filter_contains(ln, "value", s)).select(F.lit(s).alias("needle"), "n")
                          for s in ("a", "b")])


@query("flt02_drop_empty", W("SELECT count(*) AS n FROM lines WHERE length(value) > 0", "lines"))
def drop_empty(spark, sf):
    return rel.row_count(sh.drop_empty(fx.lines(spark, sf), "value"))


@query("flt03_filter_matches", W("""
SELECT topic, count(*) AS n, count(DISTINCT tok) AS n_distinct FROM tokens
WHERE regexp_full_match(tok, '[^0-9]*') GROUP BY topic""", "tokens"))
def filter_matches(spark, sf):
    t = sh.filter_matches(fx.tokens(spark, sf), "tok", "[^0-9]*")
    return t.groupBy("topic").agg(F.count("*").alias("n"), F.count_distinct("tok").alias("n_distinct"))


_STOP_SQL = "(" + ", ".join(f"'{w}'" for w in sh.STOPWORDS) + ")"


@query("flt04_drop_stopwords", W(f"""
SELECT topic, count(*) AS n FROM tokens WHERE tok NOT IN {_STOP_SQL} GROUP BY topic""", "tokens"))
def drop_stopwords(spark, sf):
    return rel.count_by(sh.drop_stopwords(fx.tokens(spark, sf), "tok"), "topic")


@query("flt05_min_length", W("""
SELECT topic, count(*) AS n FROM tokens WHERE length(tok) >= 2 GROUP BY topic""", "tokens"))
def min_length(spark, sf):
    return rel.count_by(sh.min_length(fx.tokens(spark, sf), "tok", 2), "topic")


@query("flt06_rare_keys", W("""
SELECT tok FROM tokens GROUP BY tok HAVING count(*) < 2""", "tokens"))
def rare_keys(spark, sf):
    return sh.rare_keys(fx.tokens(spark, sf), "tok", 2)


@query("flt07_drop_keys", W("""
, rare AS (SELECT tok FROM tokens GROUP BY tok HAVING count(*) < 2)
SELECT topic, count(*) AS n FROM tokens t WHERE tok NOT IN (SELECT tok FROM rare) GROUP BY topic""", "tokens"))
def drop_keys(spark, sf):
    """Tokens are counted per (topic, token) first, so the text is read once and
    the anti join sees one row per topic and token."""
    per = cut_lineage(rel.count_by(fx.tokens(spark, sf), ["topic", "tok"], "c"))
    rare = per.groupBy("tok").agg(F.sum("c").alias("n")).where("n < 2").select("tok")
    return sh.drop_keys(per, rare, "tok").groupBy("topic").agg(F.sum("c").alias("n"))


# FIXED VALUES: the text the reference tests tokens against is the printed set.
_STOP_STRING = "Set(" + ", ".join(sh.STOPWORDS) + ")"


@query("flt08_drop_substrings", W(f"""
SELECT topic, count(*) AS n FROM tokens WHERE NOT contains('{_STOP_STRING}', tok) GROUP BY topic""", "tokens"))
def drop_substrings(spark, sf):
    words = spark.createDataFrame([(w,) for w in ["Set", *sh.STOPWORDS]], "word string")
    return rel.count_by(sh.drop_substrings(fx.tokens(spark, sf), "tok", words, "word"), "topic")


@query("flt10_threshold", W("""
SELECT label, CASE WHEN score > 7.0 THEN 1.0 ELSE 0.0 END AS predicted, count(*) AS n
FROM scored GROUP BY 1, 2""", "labelled", "scored"))
def threshold(spark, sf):
    s = fx.scored(spark, sf).withColumn("predicted", sh.threshold("score", 7.0))
    return rel.count_by(s, ["label", "predicted"])


@query("flt11_lookup_top_k", W(f"""
SELECT r.item, r.rating, i.title FROM ratings r LEFT JOIN items i ON r.item = i.id
WHERE r."user" = {USER} ORDER BY r.rating DESC, r.item LIMIT 10""", "genres", "ratings", "items"))
def lookup_top_k(spark, sf):
    """FLT-11 + SRT-5 + JN-3: one user's 10 best-rated items with titles."""
    r = sh.lookup(fx.ratings(spark, sf), "user", USER)
    best = rel.top_k(r, [F.desc("rating"), F.asc("item")], 10)
    titles = fx.titles(spark, sf).withColumnRenamed("id", "item")
    return rounded(rel.join_lookup(best, titles, "item").select("item", "rating", "title"))


# --- joins ---------------------------------------------------------------------------

_BASELINE_SQL = """
, um AS (SELECT "user", avg(rating) AS um FROM ratings GROUP BY "user")
, im AS (SELECT item, avg(rating) AS im FROM ratings GROUP BY item)
, pred AS (SELECT r."user", r.item, (um.um + im.im) / 2 AS predicted
           FROM ratings r JOIN um ON r."user" = um."user" JOIN im ON r.item = im.item)
"""


def baseline_predictions(r):
    """A deterministic (user, item) -> predicted rating: mean of the user's
    and the item's average rating, next to the rating itself. ``r`` is a
    materialised ratings table. Used where an exact oracle is needed."""
    um = r.groupBy("user").agg(F.avg("rating").alias("um"))
    im = r.groupBy("item").agg(F.avg("rating").alias("im"))
    return (r.join(um, "user").join(im, "item")
            .select("user", "item", "rating", ((F.col("um") + F.col("im")) / 2).alias("predicted")))


@query("jn01_join_composite", W(_BASELINE_SQL + """
SELECT r."user", r.item, round(r.rating, 6) AS rating, round(p.predicted, 6) AS predicted
FROM ratings r JOIN pred p ON r."user" = p."user" AND r.item = p.item""", "ratings"))
def join_composite(spark, sf):
    r = cut_lineage(fx.ratings(spark, sf))  # the base tables are read once
    return rounded(rel.join_inner(r, baseline_predictions(r).drop("rating"), ["user", "item"]))


@query("jn02_join_single", W("""
SELECT r.item, i.title, count(*) AS n, round(avg(r.rating), 6) AS mean_rating
FROM ratings r JOIN items i ON r.item = i.id GROUP BY r.item, i.title""", "genres", "ratings", "items"))
def join_single(spark, sf):
    it = fx.titles(spark, sf).withColumnRenamed("id", "item")
    j = rel.join_inner(fx.ratings(spark, sf), it, "item")
    return rounded(j.groupBy("item", "title").agg(F.count("*").alias("n"), F.avg("rating").alias("mean_rating")))


@query("jn05_count_less_than_pairs", W("""
SELECT count(a.ID) AS num FROM pairs a JOIN pairs b ON TRY_CAST(a.ID AS INTEGER) < TRY_CAST(b.ID AS INTEGER)""",
                                       "pairs"))
def count_less_than(spark, sf):
    return rel.count_less_than_pairs(fx.pairs(spark, sf), "ID")


# --- aggregates ----------------------------------------------------------------------


@query("agg01_row_count", W("SELECT count(*) AS n FROM lines", "lines"))
def row_count(spark, sf):
    return rel.row_count(fx.lines(spark, sf))


@query("agg02_count_by", W("SELECT tok, count(*) AS n FROM tokens GROUP BY tok", "tokens"))
def count_by(spark, sf):
    return rel.count_by(fx.tokens(spark, sf), "tok")


@query("agg03_sum", W("SELECT round(sum(price), 6) AS total FROM purchases", "purchases"))
def sum_of(spark, sf):
    return rounded(rel.sum_of(fx.purchases(spark, sf), "price"))


@query("agg04_count_distinct", W('SELECT count(DISTINCT "user") AS n_distinct FROM purchases', "purchases"))
def count_distinct(spark, sf):
    return rel.count_distinct(fx.purchases(spark, sf), "user")


@query("agg05_distinct_values", "SELECT DISTINCT lang, source FROM documents")
def distinct_values(spark, sf):
    return rel.distinct_values(read_table(spark, sf, "documents"), ["lang", "source"])


@query("agg07_value_range", """
SELECT round(min(list_min(embedding))::DOUBLE, 6) AS min_value,
       round(max(list_max(embedding))::DOUBLE, 6) AS max_value FROM embeddings""")
def value_range(spark, sf):
    return rounded(rel.value_range(fx.vectors(spark, sf), "embedding"))


@query("agg08_mean_of", W("SELECT round(avg(pow(rating, 2)), 6) AS mean FROM ratings", "ratings"))
def mean_of(spark, sf):
    return rounded(rel.mean_of(fx.ratings(spark, sf), F.pow("rating", 2)))


@query("agg09_column_summary", """
WITH e AS (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
SELECT dim::INTEGER AS dim, round(avg(x), 6) AS mean, round(min(x), 6) AS min, round(max(x), 6) AS max,
       count(*) FILTER (WHERE x <> 0) AS num_nonzeros, round(var_samp(x), 6) AS variance
FROM e GROUP BY dim""")
def column_summary(spark, sf):
    return rounded(rel.column_summary(fx.vectors(spark, sf), "embedding"))


@query("agg10_fraction_where", """
SELECT round(4.0 * avg(CASE WHEN embedding[1] * embedding[1] + embedding[2] * embedding[2] < 1
                       THEN 1.0 ELSE 0.0 END), 6) AS fraction FROM embeddings""")
def fraction_where(spark, sf):
    """The Monte-Carlo count-and-scale core, re-aimed at stored points."""
    e = fx.vectors(spark, sf)
    x, y = F.col("embedding")[0], F.col("embedding")[1]
    return rounded(rel.fraction_where(e, x * x + y * y < 1, 4.0))


# --- window / ranking -------------------------------------------------------------------


@query("win01_top_n_per_group", W("""
SELECT "user", item, round(rating, 6) AS rating, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, item) AS rank FROM ratings)
WHERE rank <= 3""", "ratings"))
def top_n_per_group(spark, sf):
    r = rel.top_n_per_group(fx.ratings(spark, sf), "user", [F.desc("rating"), F.asc("item")], 3)
    return rounded(r.withColumn("rank", F.col("rank").cast("long")))


@query("win02_rank_per_group", W("""
SELECT "user", item, row_number() OVER (PARTITION BY "user" ORDER BY rating DESC, item) AS rank
FROM ratings""", "ratings"))
def rank_per_group(spark, sf):
    r = rel.rank_per_group(fx.ratings(spark, sf), "user", [F.desc("rating"), F.asc("item")])
    return r.select("user", "item", "rank")


# --- sorts / limits -----------------------------------------------------------------------


@query("srt01_sort_desc", W("""
SELECT product, count(*) AS n FROM purchases GROUP BY product ORDER BY n DESC, product""", "purchases"))
def sort_desc(spark, sf):
    return rel.sort_desc(rel.count_by(fx.purchases(spark, sf), "product"), "n", "product")


@query("srt02_top_k", W(f"""
SELECT tok, count(*) AS n FROM tokens GROUP BY tok ORDER BY n DESC, tok LIMIT {TOPN}""", "tokens"))
def top_k(spark, sf):
    return rel.top_k(rel.count_by(fx.tokens(spark, sf), "tok"), [F.desc("n"), F.asc("tok")], TOPN)


@query("srt04_most_popular", W("""
SELECT "user", product, n FROM (
  SELECT "user", product, count(*) AS n,
         row_number() OVER (PARTITION BY "user" ORDER BY count(*) DESC, product) AS r
  FROM purchases GROUP BY "user", product) WHERE r = 1""", "purchases"))
def most_popular(spark, sf):
    return rel.most_popular(fx.purchases(spark, sf), "product", ["user"])


@query("srt06_preview", W("""
SELECT "user", item, round(rating, 6) AS rating FROM ratings ORDER BY "user", item LIMIT 5""", "ratings"))
def preview(spark, sf):
    return rounded(rel.preview(fx.ratings(spark, sf), ["user", "item"], 5))


# --- sampling ---------------------------------------------------------------------------------

_HASH = "(((doc_id % 1000003) * 427799 + {seed}) % 1000003) / 1000003.0"


_POISSON_SQL = " + ".join(f"(CASE WHEN u >= {c!r}::DOUBLE THEN 1 ELSE 0 END)" for c in rel.poisson_steps(0.1))


@query("smp01_sample_rows", f"""
SELECT doc_id, topic FROM (SELECT *, unnest(range(0, {_POISSON_SQL})) AS copy FROM (
  SELECT doc_id, lang AS topic, {_HASH.format(seed=42)} AS u FROM documents))""")
def sample_rows(spark, sf):
    """Seeded Poisson sample with replacement, the same on any cluster."""
    d = read_table(spark, sf, "documents").select("doc_id", F.col("lang").alias("topic"))
    return rel.sample_rows(d, 0.1, 42, "doc_id")


@query("smp01_pick_by_hash", f"""
SELECT lang AS topic, arg_min(doc_id, {_HASH.format(seed=42)}) AS doc_id FROM documents GROUP BY lang""")
def pick_by_hash(spark, sf):
    return rel.pick_by_hash(fx.docs(spark, sf).select("doc_id", "topic"), "doc_id", 42, ["topic"])


@query("smp02_split_rows", f"""
SELECT CASE WHEN {_HASH.format(seed=123)} < 0.6 THEN 'train' ELSE 'test' END AS part, doc_id FROM documents""")
def split_rows(spark, sf):
    """Weighted split by key hash, the same on any cluster."""
    a, b = rel.split_rows(read_table(spark, sf, "documents").select("doc_id"), [0.6, 0.4], 123, "doc_id")
    return a.select(F.lit("train").alias("part"), "doc_id").unionByName(
        b.select(F.lit("test").alias("part"), "doc_id"))


@query("smp02_split_by_hash", f"""
SELECT CASE WHEN {_HASH.format(seed=123)} < 0.6 THEN 'train' ELSE 'test' END AS part, count(*) AS n
FROM documents GROUP BY 1""")
def split_by_hash(spark, sf):
    a, b = rel.split_by_hash(fx.docs(spark, sf), "doc_id", 0.6, 123)
    return rel.union_all([rel.row_count(a).select(F.lit("train").alias("part"), "n"),
                          rel.row_count(b).select(F.lit("test").alias("part"), "n")])


# --- scalar functions ------------------------------------------------------------------------


@query("fn01_split_java", """
SELECT conv_id, turn, (CASE WHEN text = '' THEN 1 WHEN rtrim(text, chr(10)) = '' THEN 0
        ELSE len(string_split(rtrim(text, chr(10)), chr(10))) END)::BIGINT AS n_fields FROM conversations""")
def split_java(spark, sf):
    c = read_table(spark, sf, "conversations")
    return c.select("conv_id", "turn", F.size(fn.split_java("text", "\n")).cast("long").alias("n_fields"))


@query("fn02_chars", """
SELECT token, count(*) AS n FROM (SELECT unnest(string_split(text, '')) AS token FROM conversations)
GROUP BY token""")
def chars(spark, sf):
    c = read_table(spark, sf, "conversations")
    return rel.count_by(c.select(F.explode(fn.chars("text")).alias("token")), "token")


@query("fn03_strings", """
SELECT p_partkey, lower(p_name) AS lower_name, instr(p_name, 'red')::BIGINT AS red_at,
       starts_with(p_brand, 'Brand#1') AS brand1, replace(p_name, ' ', '_') AS snake,
       length(p_name)::BIGINT AS name_len, concat_ws('-', p_brand, p_type) AS brand_type FROM part""")
def strings(spark, sf):
    p = read_table(spark, sf, "part")
    return p.select("p_partkey", F.lower("p_name").alias("lower_name"),
                    F.instr("p_name", "red").cast("long").alias("red_at"),
                    F.col("p_brand").startswith("Brand#1").alias("brand1"),
                    F.replace("p_name", F.lit(" "), F.lit("_")).alias("snake"),
                    F.length("p_name").cast("long").alias("name_len"),
                    F.concat_ws("-", "p_brand", "p_type").alias("brand_type"))


@query("fn08_math", """
SELECT l_orderkey, l_linenumber, round(pow(l_quantity, 2), 6) AS q2, round(sqrt(l_extendedprice), 6) AS root,
       round(abs(l_discount - 0.05), 6) AS dev, round(least(l_tax, l_discount), 6) AS lo,
       round(greatest(l_tax, l_discount), 6) AS hi FROM lineitem""")
def math_fns(spark, sf):
    li = read_table(spark, sf, "lineitem")
    return rounded(li.select("l_orderkey", "l_linenumber", F.pow("l_quantity", 2).alias("q2"),
                             F.sqrt("l_extendedprice").alias("root"), F.abs(F.col("l_discount") - 0.05).alias("dev"),
                             F.least("l_tax", "l_discount").alias("lo"), F.greatest("l_tax", "l_discount").alias("hi")))


@query("fn09_arrays", """
WITH t AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
SELECT doc_id, len(w)::BIGINT AS n, w[1] AS first, w[-1] AS last, list_contains(w, 'the') AS has_the,
       array_to_string(w[1:3], ' ') AS head3, len(list_concat(w, ['END']))::BIGINT AS n_plus FROM t""")
def arrays(spark, sf):
    d = read_table(spark, sf, "documents").select("doc_id", F.split("text", " ").alias("w"))
    w = F.col("w")
    return d.select("doc_id", F.size(w).cast("long").alias("n"), F.element_at(w, 1).alias("first"),
                    F.element_at(w, -1).alias("last"), F.array_contains(w, "the").alias("has_the"),
                    F.array_join(F.slice(w, 1, 3), " ").alias("head3"),
                    F.size(F.concat(w, F.array(F.lit("END")))).cast("long").alias("n_plus"))


def label_centroids(spark, sf):
    """KM-2 (exact): mean vector per label, one row per label."""
    from quarry.operators.cluster import centroids
    return centroids(fx.vectors(spark, sf), "embedding", "label")


CENTROIDS_SQL = """
, e AS (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS dim FROM embeddings)
, m AS (SELECT label, dim, avg(x) AS x FROM e GROUP BY label, dim)
, centroids AS (SELECT label, list(x ORDER BY dim) AS center FROM m GROUP BY label)
"""


@query("fn10_vector_functions", "WITH dummy AS (SELECT 1)" + CENTROIDS_SQL + """
, v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS a, c.center AS b
        FROM embeddings JOIN centroids c USING (label))
SELECT vec_id, round(list_dot_product(a, b), 6) AS dot,
       round(list_dot_product(a, b) / (sqrt(list_dot_product(a, a)) * sqrt(list_dot_product(b, b))), 6) AS cosine,
       round(list_sum(list_transform(list_zip(a, b), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 6) AS sq_dist,
       round(list_zip(a, b)[1][1] * list_zip(a, b)[1][2], 6) AS prod_first,
       list_bool_and(list_transform(list_zip(a, list_transform(a, lambda x: -x)),
                                    lambda p: abs(abs(p[1]) - abs(p[2])) <= 1e-6)) AS same_up_to_sign,
       len(a)::BIGINT AS size, round(list_min(a), 6) AS min, round(list_max(a), 6) AS max
FROM v""")
def vector_functions(spark, sf):
    """FN-10/11/13/14/15/16 of each vector against its label centroid."""
    v = fx.vectors(spark, sf).select("vec_id", "label", fn.to_double_array("embedding").alias("a"))
    c = label_centroids(spark, sf).select("label", F.col("center").alias("b"))
    j = v.join(c, "label")
    neg = F.transform("a", lambda x: -x)
    return rounded(j.select("vec_id", fn.dot("a", "b").alias("dot"), fn.cosine("a", "b").alias("cosine"),
                            fn.sq_distance("a", "b").alias("sq_dist"),
                            fn.elementwise("a", "b")[0].alias("prod_first"),
                            fn.approx_equal("a", neg).alias("same_up_to_sign"),
                            F.size("a").cast("long").alias("size"), fn.vec_min("a").alias("min"),
                            fn.vec_max("a").alias("max")))
