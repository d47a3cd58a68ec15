"""Distributed running sums / ranks against single-machine brute force,
including a key that holds a third of all rows."""
import pandas as pd
from pyspark.sql import functions as F

from quarry.operators.ordered import global_index, prefix_sums, rank_within_groups


def test_prefix_sums_match_cumsum(spark):
    rows = [(i, (i * 7) % 5) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, w int")
    out = prefix_sums(df, ["k"], ["w"], num_partitions=7).toPandas().sort_values("k")
    exp = pd.DataFrame(rows, columns=["k", "w"]).sort_values("k")
    assert out["cum_w"].tolist() == exp["w"].cumsum().tolist()
    ex = prefix_sums(df, [F.desc("k")], ["w"], inclusive=False, num_partitions=3).toPandas().sort_values(
        "k", ascending=False)
    assert ex["cum_w"].tolist() == (exp.sort_values("k", ascending=False)["w"].cumsum()
                                    - exp.sort_values("k", ascending=False)["w"]).tolist()


def test_global_index_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 3).alias("v"))
    out = global_index(df, ["v"], num_partitions=9).toPandas().sort_values("v")
    assert out["pos"].tolist() == list(range(1000))


def test_rank_within_groups_hot_key(spark):
    # group 0 holds a third of the rows
    rows = [(0 if i % 3 == 0 else i % 17, i, (i * 31) % 101) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, id int, s int")
    out = rank_within_groups(df, ["g"], [F.desc("s"), F.asc("id")], "r", num_partitions=8, hot_rows=500).toPandas()
    plain = rank_within_groups(df, ["g"], [F.desc("s"), F.asc("id")], "r").toPandas()
    key = ["g", "id"]
    assert out.sort_values(key)["r"].tolist() == plain.sort_values(key)["r"].tolist()
    p = pd.DataFrame(rows, columns=["g", "id", "s"]).sort_values(["g", "s", "id"], ascending=[True, False, True])
    p["r"] = p.groupby("g").cumcount() + 1
    m = out.merge(p, on=["g", "id", "s"], suffixes=("", "_exp"))
    assert len(m) == 3000 and (m["r"] == m["r_exp"]).all()


def test_rank_keeps_a_hot_null_group(spark):
    df = spark.createDataFrame([(None if i % 2 else i % 5, i) for i in range(400)], "g int, id int")
    out = rank_within_groups(df, ["g"], ["id"], "r", num_partitions=6, hot_rows=100).toPandas()
    assert len(out) == 400
    hot = out[out["g"].isna()].sort_values("id")
    assert hot["r"].tolist() == list(range(1, 201))


def test_empty_input(spark):
    df = spark.createDataFrame([], "k int, w int")
    assert prefix_sums(df, ["k"], ["w"]).count() == 0
