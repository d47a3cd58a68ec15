"""Test fixtures derived from the driver's tables (see FIXTURES.md, part B).

Each fixture has a Spark builder ``name(spark, sf_dir) -> DataFrame`` and the
same derivation in DuckDB SQL (``SQL[name]``, usable as a CTE body), so every
registered query reads the given tables and grows with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.shape import index_values
from quarry.session import read_table, sized_broadcast, spread

TAB = "\t"


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user long, item long, rating double): mean quantity a customer bought of a part."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (li.join(o, li.l_orderkey == o.o_orderkey)
            .groupBy(F.col("o_custkey").cast("long").alias("user"),
                     F.col("l_partkey").cast("long").alias("item"))
            .agg(F.avg("l_quantity").alias("rating")))


def genres(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name string, idx int): distinct part types numbered in value order."""
    types = read_table(spark, sf_dir, "part").select(F.col("p_type").alias("name"))
    return index_values(types, "name", "idx").select("name", F.col("idx").cast("int"))


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id long, title string), for lookups that need no genres."""
    return read_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("id"), F.col("p_name").alias("title"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id long, title string, flags array<string>): a 0/1 flag per genre."""
    g = genres(spark, sf_dir)
    n = g.count()  # one scalar: the flag width
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    return (part.join(sized_broadcast(g), part.p_type == g.name)  # g: one row per type
            .select(F.col("p_partkey").cast("long").alias("id"),
                    F.col("p_name").alias("title"),
                    F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                                lambda i: F.when(i == F.col("idx"), "1").otherwise("0")).alias("flags")))


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    # words are counted before the join: where labels are too many to broadcast, no text is shuffled
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", F.size(F.split("text", " ")).alias("n_words"))
    lab = read_table(spark, sf_dir, "labels")
    return (lab.join(docs, "doc_id")
            .select("doc_id",
                    F.col("quality").cast("double").alias("label"),
                    "lang", "source",
                    F.col("n_chars").cast("double").alias("n_chars"),
                    F.col("n_words").cast("double").alias("n_words"),
                    F.col("toxic").cast("double").alias("toxic")))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled(spark, sf_dir).withColumn("score", F.round(F.log(F.col("n_chars") + 1), 1))


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tab-separated, quoted text lines in the classifier-file layout:
    "doc_id" "source" "doc<id>" "lang" "n_chars" "n_words" "toxic" "quality".
    n_words becomes ``?`` on every 10th id, n_chars is negated on every 7th."""
    lb = labelled(spark, sf_dir)
    q = lambda c: F.concat(F.lit('"'), c.cast("string"), F.lit('"'))
    n_chars = F.when(F.col("doc_id") % 7 == 0, -F.col("n_chars")).otherwise(F.col("n_chars"))
    n_words = F.when(F.col("doc_id") % 10 == 0, F.lit("?")).otherwise(F.col("n_words").cast("long").cast("string"))
    return lb.select(F.concat_ws(
        TAB, q(F.col("doc_id")), q(F.col("source")), q(F.concat(F.lit("doc"), F.col("doc_id"))),
        q(F.col("lang")), q(n_chars.cast("long")), q(n_words), q(F.col("toxic").cast("long")),
        q(F.col("label").cast("long"))).alias("value"))


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("topic"), "text")
    return spread(d)


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, topic, tok): non-word split, lower-cased, empties dropped."""
    d = docs(spark, sf_dir)
    return (d.select("doc_id", "topic", F.explode(F.split("text", r"\W+")).alias("tok"))
            .where(F.col("tok") != "")
            .select("doc_id", "topic", F.lower("tok").alias("tok")))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user, product, price, ts). ``ts`` stays a wall-clock timestamp
    (timestamp_ntz): windows and formatting then do not depend on the session
    time zone. Streams cast it to ``timestamp`` for watermarks."""
    e = read_table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("user"), F.col("event_type").alias("product"),
                    F.col("value").alias("price"), "ts")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations").select("text")
    dc = read_table(spark, sf_dir, "documents").select("text")
    both = spread(conv.unionByName(dc))
    return both.select(F.explode(F.split("text", "\n")).alias("value"))


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "pages").select("page_id", "url")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("ID"))


# --- the same fixtures in DuckDB SQL (CTE bodies) ---------------------------
SQL = {
    "ratings": """SELECT o.o_custkey::BIGINT AS "user", l.l_partkey::BIGINT AS item,
                         avg(l.l_quantity) AS rating
                  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                  GROUP BY 1, 2""",
    "genres": """SELECT p_type AS name, (row_number() OVER (ORDER BY p_type) - 1)::INTEGER AS idx
                 FROM (SELECT DISTINCT p_type FROM part)""",
    "labelled": """SELECT l.doc_id, l.quality::DOUBLE AS label, d.lang, d.source,
                          d.n_chars::DOUBLE AS n_chars,
                          len(string_split(d.text, ' '))::DOUBLE AS n_words,
                          l.toxic::DOUBLE AS toxic
                   FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "docs": "SELECT doc_id, lang AS topic, text FROM documents",
    "vectors": "SELECT vec_id, embedding, label FROM embeddings",
    "purchases": """SELECT user_id AS "user", event_type AS product, value AS price, ts
                    FROM events""",
    "paths": "SELECT page_id, url FROM pages",
    "pairs": "SELECT p_size::VARCHAR AS ID FROM part",
}
SQL["items"] = f"""SELECT p.p_partkey::BIGINT AS id, p.p_name AS title,
       list_transform(range(0, (SELECT count(*) FROM ({SQL['genres']}))),
                      lambda i: CASE WHEN i = g.idx THEN '1' ELSE '0' END) AS flags
FROM part p JOIN ({SQL['genres']}) g ON p.p_type = g.name"""
SQL["scored"] = f"SELECT *, round(ln(n_chars + 1), 1) AS score FROM ({SQL['labelled']})"
SQL["raw_rows"] = f"""SELECT concat_ws(chr(9),
    '"' || doc_id || '"', '"' || source || '"', '"doc' || doc_id || '"', '"' || lang || '"',
    '"' || (CASE WHEN doc_id % 7 = 0 THEN -n_chars ELSE n_chars END)::BIGINT || '"',
    '"' || (CASE WHEN doc_id % 10 = 0 THEN '?' ELSE n_words::BIGINT::VARCHAR END) || '"',
    '"' || toxic::BIGINT || '"', '"' || label::BIGINT || '"') AS value
FROM ({SQL['labelled']})"""
SQL["tokens"] = """SELECT doc_id, topic, lower(tok) AS tok FROM (
    SELECT doc_id, lang AS topic, unnest(regexp_split_to_array(text, '\\W+')) AS tok FROM documents)
  WHERE tok <> ''"""
SQL["lines"] = """SELECT unnest(string_split(text, chr(10))) AS value FROM (
    SELECT text FROM conversations UNION ALL SELECT text FROM documents)"""


def with_fixtures(body: str, *names: str) -> str:
    """Prefix ``body`` with CTEs for the named fixtures."""
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in names)
    return f"WITH {ctes}\n{body}" if names else body
