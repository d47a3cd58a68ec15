"""Joins, aggregates and sorts, with the rewrites checked against the
literal (nested-loop) form."""
from pyspark.sql import functions as F

from quarry.operators import relational as rel


def test_count_less_than_pairs_equals_nested_loop(spark):
    vals = [str(v) for v in [5, 3, 3, 9, 1, 5, 5, 7]] + ["x", None]
    df = spark.createDataFrame([(v,) for v in vals], "ID string")
    df.createOrReplaceTempView("tablea")
    fast = rel.count_less_than_pairs(df, "ID").first()["num"]
    # the query as written, a nested-loop join
    slow = spark.sql("SELECT count(a.ID) AS num FROM tablea a JOIN tablea b "
                     "ON try_cast(a.ID AS int) < try_cast(b.ID AS int)").first()["num"]
    assert fast == slow == 24


def test_count_less_than_pairs_beyond_a_long(spark):
    from quarry.operators.ordered import prefix_sums
    per = spark.createDataFrame([(1, 5_000_000_000), (2, 5_000_000_000)], "_v int, _n long")
    cum = prefix_sums(per, ["_v"], ["_n"], prefix="_before", inclusive=False)
    wide = F.col("_n").cast("decimal(19,0)") * F.col("_before_n").cast("decimal(19,0)")
    assert int(cum.agg(F.sum(wide)).first()[0]) == 25 * 10 ** 18


def test_samplers_do_not_depend_on_partitions(spark):
    df = spark.range(0, 3000).withColumnRenamed("id", "k")
    for make in (lambda d: rel.sample_rows(d, 0.3, 42, "k"), lambda d: rel.sample_rows(d, 0.3, 42, "k", False),
                 lambda d: rel.split_rows(d, [0.6, 0.4], 123, "k")[0]):
        a, b = (sorted(r[0] for r in make(df.repartition(n)).collect()) for n in (3, 16))
        assert a == b and 0 < len(a) < 3000
    parts = rel.split_rows(df, [3.0, 2.0, 5.0], 7, "k")
    assert sorted(r[0] for p in parts for r in p.collect()) == list(range(3000))


def test_null_group_is_kept(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "g string, k long")
    assert {r["g"] for r in rel.pick_by_hash(df, "k", 1, ["g"]).collect()} == {None, "a"}
    got = sorted((str(r["g"]), r["k"], r["rank"]) for r in rel.rank_per_group(df, "g", [F.desc("k")]).collect())
    assert got == [("None", 1, 2), ("None", 2, 1), ("a", 3, 1)]


def test_join_values_needs_a_group(spark):
    import pytest
    with pytest.raises(ValueError):
        rel.join_values(spark.range(3), "id", [])


def test_count_less_than_pairs_empty(spark):
    df = spark.createDataFrame([], "ID string")
    assert rel.count_less_than_pairs(df, "ID").first()["num"] == 0


def test_most_popular_ties_and_empty(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "p string")
    r = rel.most_popular(df, "p").collect()
    assert [(x["p"], x["n"]) for x in r] == [("a", 2)]
    assert rel.most_popular(df.limit(0), "p").count() == 0


def test_top_n_per_group_and_offset(spark):
    df = spark.createDataFrame([(g, i) for g in range(3) for i in range(50)], "g int, i int")
    out = rel.top_n_per_group(df, "g", [F.desc("i")], 2).collect()
    assert sorted((r["g"], r["i"]) for r in out) == [(g, i) for g in range(3) for i in (48, 49)]
    t = rel.top_k(df.where("g = 0"), [F.desc("i")], 3, offset=1).collect()
    assert [r["i"] for r in t] == [48, 47, 46]


def test_group_lists_and_join_values(spark):
    df = spark.createDataFrame([(1, 3), (1, 1), (2, 2)], "k int, v int")
    got = {r["k"]: r["values"] for r in rel.group_lists(df, "k", "v").collect()}
    assert got == {1: [1, 3], 2: [2]}
    j = {r["k"]: r["ids"] for r in rel.join_values(df, "v", ["k"]).collect()}
    assert j == {1: "1,3", 2: "2"}


def test_hash_split_is_stable_and_complete(spark):
    df = spark.range(0, 2000)
    a, b = rel.split_by_hash(df, "id", 0.6, 123)
    assert a.count() + b.count() == 2000
    assert a.join(b, "id").count() == 0
    a2, _ = rel.split_by_hash(df, "id", 0.6, 123)
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in a2.collect())


def test_column_summary(spark):
    df = spark.createDataFrame([([1.0, 0.0],), ([3.0, 0.0],)], "v array<double>")
    rows = {r["dim"]: r for r in rel.column_summary(df, "v").collect()}
    assert rows[0]["mean"] == 2.0 and rows[0]["num_nonzeros"] == 2 and rows[1]["num_nonzeros"] == 0
