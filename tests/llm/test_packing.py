import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from quarry.llm import packing as P
from tests.conftest import SF_SMALL

ODD = ["it's  we'll\n\n don't", "a b  c　​ d", "x\x1cy\x1d z\x85q", "日本語 テキスト 123½ Ⅷ", "  lead and trail  ",
       "é combining \U0001f600\U0001f600", "<|endoftext|> inside <|endoftext|>", "\t\ttabs\r\nand 'S 'LL", "١٢٣ ๓", "",
       "word" * 500, "''''s s' 's", "A\x0bB\x0cC"]


def test_ids_equal_the_tokenizer():
    tok = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    ids, n = P.encoder(P.TOKENIZER).encode(ODD)
    cut = np.cumsum(n)
    for i, t in enumerate(ODD):
        assert ids[cut[i] - n[i]:cut[i]].tolist() == tok.encode(t, add_special_tokens=False).ids, t


def check(rows, docs, capacity):
    tok = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    for d, t in docs:
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        parts = sorted(by_doc[d], key=lambda r: r["piece"])
        assert [r["piece"] for r in parts] == list(range(len(parts)))
        assert [r["start"] for r in parts] == np.cumsum([0] + [r["length"] for r in parts[:-1]]).tolist()
        assert sum(r["length"] for r in parts) == len(ids)
        assert all(r["length"] == capacity for r in parts[1:])
        for r in parts:
            assert r["ids_crc32"] == zlib.crc32(ids[r["start"]:r["start"] + r["length"]].tobytes())
    return len(by_seq)


def test_pack_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text")
    rows = P.pack_documents(docs).collect()
    total = sum(r["length"] for r in rows)
    n = check(rows, [tuple(r) for r in docs.collect()], P.CAPACITY)
    assert n <= 1.15 * -(-total // P.CAPACITY) + 16


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, 3), (2, "", 3), (3, "a b c " * 9000, 3), (4, "x", 3)],
                               "doc_id long, text string, item int")
    rows = P.pack_documents(df).collect()
    check(rows, [(1, None), (2, ""), (3, "a b c " * 9000), (4, "x")], P.CAPACITY)
    assert P.pack_documents(df.limit(0)).count() == 0
    again = P.pack_documents(df.where("doc_id = 4").unionAll(df.where("doc_id = 4"))).collect()
    assert len(again) == 2 and len({(r["sequence_id"], r["offset"]) for r in again}) == 2


def placed(spark, sizes, per_node, capacity=2048):
    items = spark.createDataFrame([(i, int(s)) for i, s in enumerate(sizes)], "item long, size long")
    rows = P.pack_items(items, capacity, per_node).collect()
    assert sorted(r["item"] for r in rows) == list(range(len(sizes)))
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], int(sizes[r["item"]])))
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(bins)


def test_many_nodes_pack_as_well_as_one(spark):
    r = np.random.default_rng(2)
    for sizes in (r.integers(1, 2048, 4000), np.minimum(r.lognormal(5.5, 1, 4000).astype(int) + 1, 2047)):
        one = len(P.best_fit(np.sort(sizes)[::-1], 2048)[2])
        assert placed(spark, sizes, 1000) <= 1.01 * one
        assert placed(spark, sizes, 200) <= 1.04 * one      # 20 nodes, then fewer


def test_no_bin_is_given_up_while_something_fits(spark):
    # Items that fit with none of their kind, and late fillers for all of them:
    # far more underfull bins than a node holds.
    r = np.random.default_rng(3)
    large, small = r.integers(1100, 1990, 3000), r.integers(20, 58, 5000)
    sizes = np.concatenate([large, small])
    one = len(P.best_fit(np.sort(sizes)[::-1], 2048)[2])
    assert one == 3000 and placed(spark, sizes, 100) == 3000
    # nothing fits anything: one round is enough, nothing is lost
    assert placed(spark, np.full(1000, 1100), 50) == 1000
    # everything fits everything
    assert placed(spark, np.full(2000, 2), 50) <= 3


def test_what_can_still_merge():
    assert P.mergeable({}, 100, 0) == (0, 0) and P.mergeable({50: 1}, 100, 0) == (0, 0)
    assert P.mergeable({10: 3, 80: 5, 91: 4}, 100, 0) == (90, 8)     # 91 has no room for 10
    assert P.mergeable({60: 5, 70: 5}, 100, 0) == (0, 0)
    # a round that changed little: one half and one host decide the rest
    assert P.mergeable({10: 1, 60: 500, 70: 500}, 100, 1001) == (60, 501)


def test_another_tokenizer_encodes_whole_texts():
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    enc = P.encoder("word_bpe_49k.json")
    ids, n = enc.encode(ODD)
    assert not enc.by_word and P.encoder(P.TOKENIZER).by_word
    assert ids.tolist() == [i for t in ODD for i in tok.encode(t, add_special_tokens=False).ids]


def test_hot_and_null_keys(spark):
    df = spark.createDataFrame([(None, "one two")] * 40 + [(7, "three")] * 40, "doc_id long, text string")
    rows = P.pack_documents(df, capacity=8).collect()
    assert len(rows) == 80 and sum(r["doc_id"] is None for r in rows) == 40
    assert len({(r["sequence_id"], r["offset"]) for r in rows}) == 80
