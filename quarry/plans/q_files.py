"""File sources and sinks (SRC-*, SNK-*, AGG-11, KM-8): the given tables are
written to the shared folder in the layouts the programs read, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.operators import relational as rel
from quarry.operators import shape as sh
from quarry.operators.reduce import pixel_vectors, to_vectors
from quarry.plans import fixtures as fx
from quarry.plans.q_models import _KM_SQL, _assigned
from quarry.plans.registry import query, rounded
from quarry.session import read_table, scratch_path, sized_broadcast
from quarry.sources import readers, sinks

W = fx.with_fixtures
NEEDLE = "red"
FILE_ROWS = 50  # documents in a whole-text file


@query("src01_lines", W("""
SELECT count(*) AS n, count(*) FILTER (WHERE contains(value, 'a')) AS with_a FROM lines""", "lines"))
def lines(spark, sf):
    """SRC-1 + SNK-1: text lines out and in again, then counted and searched."""
    path = scratch_path(spark, "lines")
    sinks.write_lines(fx.lines(spark, sf), path)
    back = readers.read_lines(spark, path)
    return back.agg(F.count("*").alias("n"), F.count(F.when(F.col("value").contains("a"), 1)).alias("with_a"))


@query("src02_documents", """
SELECT 'topic=' || lang AS topic, sum(length(text) + 1)::BIGINT AS chars FROM documents GROUP BY lang""")
def documents(spark, sf):
    """SRC-2 + PRJ-8: whole files in topic folders; the topic is the folder."""
    path = scratch_path(spark, "topics")
    (fx.docs(spark, sf).select("topic", "text").write.partitionBy("topic")
     .option("maxRecordsPerFile", FILE_ROWS).text(path))
    back = readers.read_documents(spark, f"{path}/*")
    return back.groupBy("topic").agg(F.sum(F.char_length("text")).alias("chars"))


@query("src03_delimited", """
SELECT p_partkey, p_name, p_size::BIGINT AS p_size, round(p_retailprice::DOUBLE, 6) AS p_retailprice FROM part""")
def delimited(spark, sf):
    """SRC-3: pipe-separated records with a schema."""
    path = scratch_path(spark, "delimited")
    p = read_table(spark, sf, "part").select("p_partkey", "p_name", F.col("p_size").cast("long").alias("p_size"),
                                             F.col("p_retailprice").cast("double").alias("p_retailprice"))
    p.write.option("sep", "|").csv(path)
    return rounded(readers.read_delimited(spark, path, "|", "p_partkey long, p_name string, p_size long, p_retailprice double"))


@query("src03_fields", """
SELECT p_partkey::VARCHAR AS key, 3 AS n_fields FROM part""")
def fields(spark, sf):
    """SRC-3 without a schema: one array of fields per line."""
    path = scratch_path(spark, "fields")
    sinks.write_lines(read_table(spark, sf, "part").select(F.concat_ws("|", F.col("p_partkey").cast("string"), "p_brand", "p_type")), path)
    back = readers.read_delimited(spark, path, "|")
    return back.select(F.element_at("fields", 1).alias("key"), F.size("fields").alias("n_fields"))


@query("src04_libsvm", """
SELECT label::DOUBLE AS label, count(*) AS n, round(sum(list_sum(list_transform(embedding, lambda x: x::DOUBLE))), 4) AS total
FROM embeddings GROUP BY label""")
def libsvm(spark, sf):
    """SRC-4: vectors written as LibSVM and read back."""
    from pyspark.ml.functions import vector_to_array
    path = scratch_path(spark, "libsvm")
    v = to_vectors(fx.vectors(spark, sf), "embedding").select(F.col("label").cast("double").alias("label"), "features")
    v.write.format("libsvm").save(path)
    back = readers.read_libsvm(spark, path).withColumn("a", vector_to_array("features"))
    total = F.sum(F.aggregate("a", F.lit(0.0), lambda s, x: s + x))
    return back.groupBy("label").agg(F.count("*").alias("n"), F.round(total, 4).alias("total"))


@query("src05_category_ids", f"""
SELECT p_partkey::VARCHAR AS id FROM part WHERE contains(p_name, '{NEEDLE}')""")
def category_ids(spark, sf):
    """SRC-5 + FLT-1 + AGG-11: ids of matching rows of ``part-*`` files, joined per
    file; a decoy file of another name is not read. The per-file lists are taken
    apart again so that the result does not depend on the files."""
    path = scratch_path(spark, "parts")
    p = read_table(spark, sf, "part")
    cols = [F.col("p_partkey").cast("string"), *[F.lit(f"x{i}") for i in range(1, 9)], F.col("p_name")]
    sinks.write_lines(p.select(F.concat_ws(readers.PART_SEP, *cols)), path)
    per_file = readers.category_ids(spark, path, NEEDLE)
    return per_file.select(F.explode(F.split("ids", ",")).alias("id"))


@query("km08_save_assignments", "WITH dummy AS (SELECT 1)" + _KM_SQL + """
SELECT concat_ws(' ', vec_id, cluster) AS value FROM best""")
def save_assignments(spark, sf):
    """KM-8 + SNK-1: annotated points saved as text."""
    path = scratch_path(spark, "assigned")
    sinks.write_lines(_assigned(spark, sf).select(sh.annotate_line(F.col("vec_id").cast("string"), "cluster")), path)
    return readers.read_lines(spark, path)


@query("snk05_csv", """
SELECT dim::INTEGER AS dim, round(avg(x), 6) AS mean FROM (
  SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings) GROUP BY dim""")
def csv(spark, sf):
    """SNK-5: a vector's (index, value) rows as CSV."""
    path = scratch_path(spark, "csv")
    sinks.write_csv(rel.column_summary(fx.vectors(spark, sf), "embedding").select("dim", "mean"), path)
    return rounded(spark.read.schema("dim int, mean double").option("header", True).csv(path))


# SRC-6 + DIM-1: a pixel is the vector's component in 256 grey steps.
_GREY_SQL = "greatest(0, least(255, floor((x::DOUBLE + 1) * 127.5)))::INTEGER"


@query("src06_images", f"""
SELECT vec_id, len(embedding) AS n, array_to_string(list_transform(embedding, lambda x: {_GREY_SQL}), ' ') AS pixels
FROM embeddings WHERE embedding IS NOT NULL""")
def images(spark, sf):
    """Vectors written as image files, read with the image source, turned into pixel
    vectors again."""
    v = fx.vectors(spark, sf).where("embedding is not null")
    width = v.agg(F.max(F.size("embedding")).alias("d")).first()["d"]
    grey = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") + 1) * 127.5))).cast("int"))
    raw = F.unhex(F.array_join(F.transform(grey, lambda x: F.lpad(F.hex(x), 2, "0")), ""))
    path = scratch_path(spark, "images")
    sinks.write_images(v.select("vec_id", raw.alias("raw")), path, "vec_id", "raw", width, 1)
    back = pixel_vectors(readers.read_images(spark, path), width, 1)
    key = F.regexp_extract("origin", r"([0-9]+)\.png$", 1).cast("long")
    return back.select(key.alias("vec_id"), F.size("pixels").cast("long").alias("n"),
                       F.array_join(F.transform("pixels", lambda x: x.cast("int").cast("string")), " ").alias("pixels"))


@query("src07_literal_rows", W("""
SELECT w.word, w.weight, count(*) AS n FROM tokens t JOIN (VALUES ('the', 1.5::DOUBLE), ('de', 2.5), ('und', -1.0), ('nowhere', 0.0)) w(word, weight)
ON t.tok = w.word GROUP BY 1, 2""", "tokens"))
def literal_rows(spark, sf):
    """A literal word list joined with the corpus' tokens."""
    words = readers.from_rows(spark, [("the", 1.5), ("de", 2.5), ("und", -1.0), ("nowhere", 0.0)], "word string, weight double")
    t = fx.tokens(spark, sf)
    return t.join(sized_broadcast(words), t.tok == words.word).groupBy("word", "weight").agg(F.count("*").alias("n"))
