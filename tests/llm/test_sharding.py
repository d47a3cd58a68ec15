import zlib

from quarry.llm import sharding as S
from tests.conftest import SF_MID


def test_law_slots_and_growth(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    rows = S.rendezvous_shards(docs).collect()
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(rows) == len(text)
    slots = {}
    for r in rows:
        b = (text[r["doc_id"]] or "").encode()
        assert r["size"] == len(b) + 16 and r["text_crc32"] == zlib.crc32(b) and r["law"] == "key"
        assert r["grown_shard"] in (r["shard"], 40)  # a new shard only takes rows into itself
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(40))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    moved = sum(r["grown_shard"] == 40 for r in rows)
    assert 0 < moved < 3 * len(rows) / 41
    # the key and the shard list alone decide
    half = docs.where("doc_id % 2 = 0").repartition(3)
    again = {r["doc_id"]: (r["shard"], r["grown_shard"]) for r in S.rendezvous_shards(half).collect()}
    assert all(again[r["doc_id"]] == (r["shard"], r["grown_shard"]) for r in rows if r["doc_id"] % 2 == 0)


def test_growing_step_by_step_is_the_larger_list(spark):
    df = spark.range(2000).selectExpr("id AS doc_id", "'x' AS text")
    grown = {r["doc_id"]: r["grown_shard"] for r in S.rendezvous_shards(df, weights=[1.0] * 5).collect()}
    direct = {r["doc_id"]: r["shard"] for r in S.rendezvous_shards(df, weights=[1.0] * 6).collect()}
    assert grown == direct


def test_weights_steer_the_share(spark):
    df = spark.range(6000).selectExpr("id AS doc_id", "'x' AS text")
    n = {r["shard"]: r["n"] for r in S.rendezvous_shards(df, weights=[1.0, 2.0, 3.0]).groupBy("shard").count()
         .withColumnRenamed("count", "n").collect()}
    assert abs(n[0] - 1000) < 150 and abs(n[1] - 2000) < 200 and abs(n[2] - 3000) < 200


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, None, 5), (None, "é", 5), (2, "", 5)], "doc_id long, text string, shard int")
    rows = S.rendezvous_shards(df, weights=[1.0] * 3).collect()
    assert len(rows) == 4
    assert sorted(r["size"] for r in rows) == [16, 16, 16, 18]
    assert {r["text_crc32"] for r in rows if r["doc_id"] is not None} == {0}
    assert S.rendezvous_shards(df.limit(0)).count() == 0


def test_plan_is_native(spark):
    plan = S.rendezvous_shards(spark.read.parquet(f"{SF_MID}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_the_winner_is_the_largest_score_recomputed(spark):
    """Scores by an implementation of the hash outside Spark."""
    import math
    import struct

    import xxhash

    def score(key, shard, weight):
        h = xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), h)
        h = xxhash.xxh64_intdigest(struct.pack("<i", S.SALT), h)
        return weight / -math.log(((h >> 11) + 0.5) / 2.0 ** 53)
    weights = [1.0, 2.5, 0.5, 1.0, 3.0]
    df = spark.range(-200, 800).selectExpr("id AS doc_id", "'x' AS text")
    for r in S.rendezvous_shards(df, weights=weights, new_weight=2.0).collect():
        scores = [score(r["doc_id"], i, w) for i, w in enumerate([*weights, 2.0])]
        assert r["shard"] == max(range(5), key=lambda i: scores[i]) and r["grown_shard"] == max(range(6), key=lambda i: scores[i])


def test_a_hot_key_is_numbered_without_gaps(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS doc_id", "cast(id AS string) AS text")
    rows = S.rendezvous_shards(df, weights=[1.0] * 4).collect()
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert len({r["shard"] for r in rows if r["doc_id"] == 7}) == 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and len(rows) == 3000
