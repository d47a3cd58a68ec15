"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard scores every key; the highest score owns the record. A new shard can
only win records for itself, so growing from n to n+1 shards moves about
1/(n+1) of the rows and none between old shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT = 0x5EED


def _score(key: Column, shard: Column, weight: Column) -> Column:
    """Weighted rendezvous score ``w / -ln(u)`` with u in (0, 1) from a 64-bit hash."""
    u = (F.shiftrightunsigned(F.xxhash64(key, shard, F.lit(SALT)), 11).cast("double") + F.lit(0.5)) / F.lit(2.0 ** 53)
    return weight / -F.log(u)


def _best(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    """struct(score, shard) of the winning shard among ``first .. first+len-1``."""
    table = F.array(*[F.lit(float(w)) for w in weights])
    return F.array_max(F.transform(
        F.sequence(F.lit(0), F.lit(len(weights) - 1)),
        lambda i: F.struct(_score(key, i + F.lit(first), F.element_at(table, i + 1)).alias("score"),
                           (i + F.lit(first)).alias("shard"))))


def rendezvous_shards(df: DataFrame, key: str = "doc_id", text: str = "text",
                      weights: Sequence[float] = (1.0,) * 40, new_weight: float = 1.0,
                      sub_buckets: int = 256) -> DataFrame:
    """One row per input row: ``key, size, text_crc32, law, shard, slot, grown_shard``.

    * ``shard``: rendezvous winner among ``len(weights)`` weighted shards. It
      depends on the key and the shard list alone (law ``key``).
    * ``grown_shard``: the winner when one shard of ``new_weight`` is added.
    * ``size``: UTF-8 bytes of the text plus 16; a null text has no bytes, so
      its size is 16 and its CRC is that of no bytes (0).
    * ``slot``: gapless place in the shard from 0. Shards are numbered in
      ``sub_buckets`` hashed pieces: piece counts (at most shards x pieces rows,
      so broadcast) give each piece its offset, and a window numbers the rows of
      one piece. No task ever holds a whole shard.

    A null key is a key like any other; repeated rows get slots of their own;
    other columns of the input are ignored; an empty table gives no rows.
    """
    n = len(weights)
    k = F.col("__k")
    # An empty side has no bytes; text enters only through its size and CRC.
    t = F.coalesce(F.col("__t"), F.lit(""))
    base = df.select(F.col(key).alias("__k"), F.col(text).cast("string").alias("__t"))
    won = base.withColumn("__old", _best(k, weights)) \
              .withColumn("__new", F.struct(_score(k, F.lit(n), F.lit(float(new_weight))).alias("score"),
                                            F.lit(n).alias("shard")))
    rows = won.select(
        k,
        (F.octet_length(t) + 16).cast("long").alias("size"),
        F.crc32(t.cast("binary")).cast("long").alias("text_crc32"),
        F.col("__old.shard").cast("int").alias("shard"),
        F.greatest("__old", "__new")["shard"].cast("int").alias("grown_shard"),
        F.pmod(F.xxhash64(k, F.lit(SALT + 1)), F.lit(sub_buckets)).cast("int").alias("__sub"))
    counts = rows.groupBy("shard", "__sub").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("shard").orderBy("__sub").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "__sub", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    place = Window.partitionBy("shard", "__sub").orderBy("__k", "text_crc32", "size")
    placed = rows.withColumn("__rn", F.row_number().over(place)) \
                 .join(F.broadcast(offsets), ["shard", "__sub"])
    return placed.select(
        F.col("__k").alias(key), "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("__off") + F.col("__rn") - 1).cast("long").alias("slot"), "grown_shard")
