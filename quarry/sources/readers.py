"""Batch sources.

Every reader is a ``spark.read`` call with an explicit schema where the
layout is known, so the scan is planned without inference passes and column
pruning / filter pushdown reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.shape import parent_dir

# FIXED VALUES: the column delimiter of the category part files (byte 0x01).
PART_SEP = "\x01"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1: one row per line (``value``). Split sizes follow
    ``spark.sql.files.maxPartitionBytes``; there is no per-call minimum."""
    return spark.read.text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """SRC-2: one row per file: (file_path, topic = parent folder, text).
    ``wholetext`` must be passed to ``text()`` itself."""
    df = spark.read.text(path, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("file_path"),
                     parent_dir(F.col("_metadata.file_path")).alias("topic"),
                     F.col("value").alias("text"))


def read_delimited(spark: SparkSession, path: str, sep: str, schema: str | None = None,
                   quote: str = "", header: bool = False) -> DataFrame:
    """SRC-3: delimited records. With a schema, fields are typed (malformed
    values become NULL); without one, each line becomes ``fields array<string>``
    (ragged rows keep every field)."""
    if schema is None:
        import re
        return spark.read.text(path).select(F.split("value", re.escape(sep)).alias("fields"))
    return (spark.read.schema(schema).option("sep", sep).option("quote", quote)
            .option("header", header).option("mode", "PERMISSIVE").csv(path))


def read_libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    """SRC-4: ``label index:value ...`` rows -> (label double, features vector)."""
    r = spark.read.format("libsvm")
    if num_features:
        r = r.option("numFeatures", num_features)
    return r.load(path)


def read_part_files(spark: SparkSession, path: str, n_fields: int = 10) -> DataFrame:
    """SRC-5: only ``part-*`` files of a folder, fields separated by 0x01,
    plus the file each row came from."""
    schema = ", ".join(f"c{i} string" for i in range(n_fields))
    df = (spark.read.schema(schema).option("sep", PART_SEP).option("quote", "")
          .option("pathGlobFilter", "part-*").csv(path))
    return df.withColumn("file_path", F.col("_metadata.file_path"))


def read_images(spark: SparkSession, path: str, drop_invalid: bool = False) -> DataFrame:
    """SRC-6: image files -> ``image`` struct (origin, height, width,
    nChannels, mode, data). A file that is no image gives a row with size -1,
    so unreadable inputs can be counted; ``drop_invalid`` leaves them out."""
    return spark.read.format("image").option("dropInvalid", drop_invalid).load(path)


def from_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """SRC-7: small literal frames (word lists, parameters)."""
    return spark.createDataFrame(rows, schema)


def category_ids(spark: SparkSession, path: str, needle: str, id_field: int = 0, name_field: int = 9,
                 sep: str = ",") -> DataFrame:
    """SRC-5 + FLT-1 + AGG-11: ids of the part-file rows whose search name
    contains ``needle``, joined per source file (the list is bounded by one
    file, never the whole folder)."""
    from quarry.operators.relational import join_values
    parts = read_part_files(spark, path, max(id_field, name_field) + 1)
    hits = parts.where(F.col(f"c{name_field}").contains(needle))
    return join_values(hits, f"c{id_field}", ["file_path"], sep, "ids")
