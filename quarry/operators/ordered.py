"""Distributed running sums and global positions over a sorted column.

A window with an ``orderBy`` but no ``partitionBy`` moves every row into a
single task. Operators that need a global order (dense indexes, rank-based
AUC, the inequality-join count, ranks inside very large groups) use the
helpers here instead:

1. range-partition the rows on the order key (ties land in one partition);
2. running sums inside each partition with an ordinary partitioned window;
3. per-partition totals -> exclusive running sum over the partitions (one
   row per partition, so its size is bounded by the partition count and it
   is safe to broadcast) -> added back as an offset.

The range-partitioned frame is checkpointed to the shared checkpoint folder
so both branches read identical partitions even if a task is retried.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import cut_lineage


def _partitions(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(df: DataFrame, order_cols: list, sum_cols: list[str],
                prefix: str = "cum_", inclusive: bool = True,
                num_partitions: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` = running total of ``c`` in global ``order_cols`` order.

    ``order_cols`` must define a total order over the rows (add a key to break
    ties) when ``inclusive`` sums per row are wanted; for distinct order values
    after an aggregation this holds by construction.
    """
    n = _partitions(df, num_partitions)
    ranged = df.repartitionByRange(n, *order_cols).withColumn("_pid", F.spark_partition_id())
    ranged = cut_lineage(ranged)
    w = (Window.partitionBy("_pid").orderBy(*order_cols)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = ranged.select("*", *[F.sum(c).over(w).alias(f"_loc_{c}") for c in sum_cols])
    totals = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_pid", *[F.coalesce(F.sum(f"_tot_{c}").over(before), F.lit(0))
                                      .alias(f"_off_{c}") for c in sum_cols])
    # offsets holds one row per range partition: bounded, so broadcast it.
    out = local.join(F.broadcast(offsets), "_pid")
    for c in sum_cols:
        total = F.col(f"_loc_{c}") + F.col(f"_off_{c}")
        out = out.withColumn(f"{prefix}{c}", total if inclusive else total - F.col(c))
    drop = ["_pid"] + [f"_loc_{c}" for c in sum_cols] + [f"_off_{c}" for c in sum_cols]
    return out.drop(*drop)


def global_index(df: DataFrame, order_cols: list, name: str = "pos",
                 num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the global order (rows must be totally
    ordered by ``order_cols``).

    Rows are sorted inside their range partition, so a row's place there is the
    low part of its generated id and no window (and no second shuffle) is
    needed; the partitions' sizes give the offsets."""
    n = _partitions(df, num_partitions)
    ranged = (df.repartitionByRange(n, *order_cols).sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    ranged = cut_lineage(ranged)
    sizes = ranged.groupBy("_pid").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # offsets holds one row per range partition: bounded, so broadcast it.
    return (ranged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_at") + F.col("_off")).drop("_pid", "_at", "_off"))


# A group of more rows is ranked over several tasks.
HOT_GROUP_ROWS = 1_000_000


def rank_within_groups(df: DataFrame, group_cols: list[str], order_cols: list,
                       name: str = "rank", num_partitions: int | None = None,
                       hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """1-based row number inside each group without putting a hot group in one task.

    Groups of up to ``hot_rows`` rows are numbered by an ordinary window. Larger
    ones are at most rows / ``hot_rows`` many: their rows are numbered globally in
    (group, order) order, which spreads each over several range partitions, and
    the group's first position is subtracted. NULL groups are groups.
    """
    base = cut_lineage(df)
    small = Window.partitionBy(*group_cols).orderBy(*order_cols)
    heavy = base.groupBy(*group_cols).agg(F.count("*").alias("_n")).where(F.col("_n") > hot_rows)
    heavy = cut_lineage(heavy.select(*[F.col(c).alias(f"_hot_{c}") for c in group_cols]))
    if heavy.isEmpty():
        return base.withColumn(name, F.row_number().over(small).cast("long"))
    same = lambda side: reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{side}{c}")) for c in group_cols])
    # rows / hot_rows groups at most, so their names can be broadcast
    light = base.join(F.broadcast(heavy), same("_hot_"), "left_anti").withColumn(name, F.row_number().over(small).cast("long"))
    idx = global_index(base.join(F.broadcast(heavy), same("_hot_"), "left_semi"), [*group_cols, *order_cols], "_gpos",
                       num_partitions)
    first = idx.groupBy(*[F.col(c).alias(f"_first_{c}") for c in group_cols]).agg(F.min("_gpos").alias("_gfirst"))
    ranked = (idx.join(F.broadcast(first), same("_first_"))
              .withColumn(name, F.col("_gpos") - F.col("_gfirst") + 1).select(*base.columns, name))
    return light.unionByName(ranked)
