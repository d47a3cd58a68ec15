"""Row shaping, filters and scalar functions: edge cases and brute force."""
from pyspark.sql import functions as F

from quarry.functions import scalar as fn
from quarry.operators import shape as sh


def test_split_java_drops_trailing_empties(spark):
    df = spark.createDataFrame([("a\tb\t\t",), ("",), ("\t\t",), ("x",)], "s string")
    got = [r[0] for r in df.select(fn.split_java("s", "\t").alias("p")).collect()]
    assert got == [["a", "b"], [""], [], ["x"]]


def test_missing_marker_and_clamp(spark):
    df = spark.createDataFrame([('"1"\t"c"\t"x"\t"cat"\t"?"\t"-2.5"\t"3"\t"1"',)], "value string")
    r = sh.parse_labelled(df).first()
    assert r["category"] == "cat" and r["nums"] == [0.0, -2.5, 3.0] and r["label"] == 1.0
    r2 = sh.parse_labelled(df, clamp=True).first()
    assert r2["nums"] == [0.0, 0.0, 3.0]


def test_bad_number_is_null_not_error(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    assert df.select(sh.fill_marker("s")).first()[0] is None


def test_parent_dir_and_prefix(spark):
    df = spark.createDataFrame([("file:/data/news/sport/1.txt",), ("x",)], "p string")
    rows = df.select(sh.parent_dir("p"), sh.strip_prefix("p", "file:")).collect()
    assert rows[0][0] == "sport" and rows[0][1] == "/data/news/sport/1.txt"
    assert rows[1][0] is None and rows[1][1] == "x"


def test_drop_substrings_equals_nested_loop(spark):
    toks = ["the", "he", "e", "cat", "at", "set", "et", "s", "to", "xyz", "a"]
    words = spark.createDataFrame([(w,) for w in ["Set", "the", "at", "to"]], "word string")
    df = spark.createDataFrame([(t,) for t in toks], "tok string")
    got = sorted(r[0] for r in sh.drop_substrings(df, "tok", words, "word").collect())
    text = "Set(the, at, to)"
    assert got == sorted(t for t in toks if t not in text)


def test_index_values_dense_and_ordered(spark):
    df = spark.createDataFrame([(v,) for v in ["b", "a", "c", "a", None, "b"]], "v string")
    got = {r["v"]: r["idx"] for r in sh.index_values(df, "v").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_decode_flags_in_flag_order(spark):
    items = spark.createDataFrame([(1, "t1", ["0", "1", "1"]), (2, "t2", ["0", "0", "0"])],
                                  "id int, title string, flags array<string>")
    look = spark.createDataFrame([("Action", 0), ("Comedy", 1), ("Drama", 2)], "name string, idx int")
    got = {r["id"]: r["genres"] for r in sh.decode_flags(items, look).collect()}
    assert got == {1: "Comedy Drama", 2: ""}
    untitled = spark.createDataFrame([(3, None, ["1", "0", "1"]), (4, "t", None)], items.schema)
    assert {r["id"]: r["genres"] for r in sh.decode_flags(untitled, look).collect()} == {3: "Action Drama", 4: ""}


def test_vector_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0], [-1.0, -2.0, -3.0], [0.0, 0.0, 0.0])],
                               "a array<double>, b array<double>, z array<double>")
    r = df.select(fn.cosine("a", "a").alias("self"), fn.cosine("a", "z").alias("zero"),
                  fn.approx_equal("a", "b").alias("eq"), fn.dot("a", "b").alias("dot"),
                  fn.sq_distance("a", "b").alias("d")).first()
    assert abs(r["self"] - 1.0) < 1e-12 and r["zero"] is None and r["eq"] is True
    assert r["dot"] == -14.0 and r["d"] == 56.0


def test_approx_equal_cuts_to_shorter(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 0.0], [1.0, 2.0, 3.0])], "a array<double>, b array<double>")
    r = df.select(fn.approx_equal("a", "b"), fn.approx_equal("a", "b", strict_len=True)).first()
    assert r[0] is True and r[1] is False


def test_one_hot(spark):
    df = spark.createDataFrame([(2,)], "i int")
    assert df.select(sh.one_hot(F.col("i"), 4)).first()[0] == [0.0, 0.0, 1.0, 0.0]
