"""The pipeline against its stages done by hand, and on awkward tables."""
import corpus_pipeline
from quarry.llm import jaccard_join, language_crf, repetition, suffix_dedup
from tests.conftest import SF_SMALL
from tests.llm.test_jaccard_join import brute as near_brute
from tests.llm.test_packing import check
from tests.llm.test_repetition import brute as quality_brute
from tests.llm.test_suffix_dedup import brute as suffix_brute


def test_each_stage_against_its_brute_force(spark):
    from quarry.llm.common import written
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "quality_rules", "ngram_jaccard_join",
                                                       "suffix_array_dedup", "best_fit_packing"]
    rows = lambda d: {r["doc_id"]: r["text"] for r in d.collect()}

    model = language_crf.fit(docs)
    a = written(stages["language_id"](spark, docs, SF_SMALL), "t1")
    p = language_crf.predict(model, [r["text"] for r in docs.collect()], judge=True)
    want = {r["doc_id"] for r, s, n in zip(docs.collect(), p["score"], p["in_learned"]) if n and s >= language_crf.MIN_SCORE}
    assert a.columns == docs.columns and set(rows(a)) == want

    b = written(stages["quality_rules"](spark, a, SF_SMALL), "t2")
    short = {k: t for k, t in rows(a).items() if len(t) < 4000}  # the brute force is quadratic
    assert b.columns == docs.columns
    assert {k for k in rows(b) if k in short} == {k for k, t in short.items() if quality_brute(t)[-1]}

    c = written(stages["ngram_jaccard_join"](spark, b, SF_SMALL), "t3")
    assert c.columns == docs.columns
    assert set(rows(c)) == {k for k, cls, _, _ in near_brute(sorted(rows(b).items())) if k == cls}

    d = written(stages["suffix_array_dedup"](spark, c, SF_SMALL), "t4")
    assert d.columns == docs.columns
    removed = {k: n for k, _, n, _, _ in suffix_brute(sorted(rows(c).items()))}
    before, after = rows(c), rows(d)
    for k, n in removed.items():
        cut = len(before[k].encode()) - len(after[k].encode())
        assert n <= cut <= n + 3 * 20 if n else after[k] == before[k]  # bytes of characters cut in two go too

    packed = stages["best_fit_packing"](spark, d, SF_SMALL).collect()
    check(packed, sorted(after.items()), 2048)


def test_stages_on_awkward_rows(spark):
    words = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, words, "en", None, 5), (4, words, "en", "s", 5),
            (4, words, "en", "s", 5), (5, "x" * 300_000, "en", "s", 300_000), (6, words.upper(), None, "s", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (df, df.limit(0), df.where("text is null")):
        out = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SF_SMALL)
            assert out.columns == df.columns
        assert corpus_pipeline.STAGES[-1][1](spark, out, SF_SMALL).count() >= 0
    kept = jaccard_join.drop_near_duplicates(repetition.keep_good(df)).collect()
    assert len(kept) == 1
    assert {r["doc_id"] for r in suffix_dedup.without_repeats(df).collect()} == {1, 2, 4, 5, 6, None}
