"""Phrase collocations from merged counting quotient filters.

Shards of text are cut into words once and kept as local word numbers. The words
that are frequent enough get global ids, every shard counts its n-grams of such
ids in a quotient filter, and the filters of many shards are merged level by
level: a level merges up to ``FAN`` shards and cuts the result by the next bits
of the permuted n-gram, so groups stay as large as one shard's filter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import counted_broadcast, regroup_arrow, text_batches, written
from quarry.llm.quotient_filter import QuotientFilter, U, ones
from quarry.operators.ordered import global_index

LEAST = 30              # occurrences of a candidate
TOP = 2000              # phrases reported per language
INSIDE = 80             # a phrase is dropped if this share (%) of it lies in a longer candidate
SCALE = 2_000_000       # score of a phrase whose parts never occur without it, halved
NO_LANG = "und"
SHARD = 8_000_000       # bytes of text of a shard
CHUNK = 1_000_000       # bytes cut into words at a time
COUNTED = 2_000_000     # words counted in one filter (shards of a task are counted together up to that)
FAN = 256               # filters merged by one task
LEAST_BITS = 16         # per word id

# What ends a piece becomes a line end, the tab a blank, A-Z are lower-cased.
SIGNS = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz\n\n\n\n\n\n\n\n\n ")
WORD = re.compile(rb"[^ \n]+|\n")
WORDS = ["w1", "w2", "w3", "w4"]


@contextmanager
def arrow_rows(spark: SparkSession, n: int) -> Iterator[None]:
    """Hand at most ``n`` rows at once to Python while a table of large rows is written."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    have = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        yield
    finally:
        spark.conf.set(key, have)


# --- words ----------------------------------------------------------------------

class _Codes(dict):
    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        return code


def to_planes(x: np.ndarray) -> bytes:
    """All lowest bytes, then all second ones and so on: small numbers pack well."""
    return x.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(raw) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T).reshape(-1).view("<i4")


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Word numbers of all texts from 1 on, 0 where a piece or text ends, and the words."""
    codes = _Codes({b"\n": 0})
    parts, held, size = [], [], 0
    for i, t in enumerate(texts):
        held.append(t)
        size += len(t)
        if size >= CHUNK or i == len(texts) - 1:
            found = WORD.findall(b"\n".join([*held, b""]).translate(SIGNS))
            parts.append(np.fromiter(map(codes.__getitem__, found), dtype=np.int32, count=len(found)))
            held, size = [], 0
    return np.concatenate([np.zeros(0, np.int32), *parts]), list(codes)[1:]


def _shards(batches):
    """One row a shard: its word numbers, and of each word the language, the text
    and the occurrences."""
    base, at = TaskContext.get().partitionId() << 33, 0
    for held in regroup_arrow(batches, "text", SHARD):
        langs = held.column("lang").to_pylist()
        texts: dict[str, list[bytes]] = {}
        for lang, t in zip(langs, held.column("text").to_pylist()):
            if t:
                texts.setdefault(lang, []).append(t.encode())
        codes, lang_of, words = [], [], []
        for lang in sorted(texts):
            own, found = word_codes(texts.pop(lang))
            codes.append(np.where(own, own + len(words), 0))
            lang_of += [lang] * len(found)
            words += [w.decode() for w in found]
        if words:
            every = np.concatenate(codes)
            n = np.bincount(every, minlength=len(words) + 1)[1:]
            # the commonest words get the smallest numbers: they pack best
            order = np.argsort(-n, kind="stable")
            number = np.zeros(len(words) + 1, dtype="<i4")
            number[order + 1] = np.arange(1, len(words) + 1)
            lang_of, words = [lang_of[i] for i in order.tolist()], [words[i] for i in order.tolist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([base + at], pa.int64()), pa.array([to_planes(number[every])], pa.binary()),
                 pa.array([lang_of], pa.list_(pa.string())), pa.array([words], pa.list_(pa.string())),
                 pa.array([n[order]], pa.list_(pa.int64()))], names=["shard", "codes", "langs", "words", "counts"])
            at += 1


def word_shards(df: DataFrame, lang: str, text: str) -> DataFrame:
    spark = df.sparkSession
    text_batches(spark)
    src = df.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"),
                    F.col(text).cast("string").alias("text"))
    return written(src.mapInArrow(_shards, "shard long, codes binary, langs array<string>, words array<string>, "
                                           "counts array<long>"), "phrase-shards", "zstd")


def frequent_words(shards: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """``(id, lang, word, f)`` of the words that occur ``least`` times, ids from 1,
    and ``(lang, n)``, all word occurrences."""
    each = shards.select(F.explode(F.arrays_zip("langs", "words", "counts")).alias("w")) \
                 .select(F.col("w.langs").alias("lang"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    words = written(each.groupBy("lang", "word").agg(F.sum("n").alias("f")), "phrase-words")
    totals = written(words.groupBy("lang").agg(F.sum("f").alias("n")), "phrase-totals")
    known = global_index(words.where(F.col("f") >= least), ["lang", "word"], "id")
    return written(known.select((F.col("id") + 1).alias("id"), "lang", "word", "f"), "phrase-vocabulary"), totals


# --- n-grams --------------------------------------------------------------------

def half_bits(words: int, bits: int) -> int:
    """Bits of each half of a packed n-gram."""
    return -(-words * bits // 2)


def packed_grams(ids: np.ndarray, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """All runs of 2, 3 and 4 ids without a 0, packed into two halves."""
    n, step = len(ids), U(bits)
    wide = np.concatenate([ids, np.zeros(3, ids.dtype)])
    some = wide > 0
    pair = lambda at: (wide[at].astype(U) << step) | wide[at + 1]
    at = np.flatnonzero(some[:n] & some[1:n + 1])
    yield 2, wide[at].astype(U), wide[at + 1].astype(U)
    at = at[some[at + 2]]
    half, last = U(half_bits(3, bits)), pair(at + 1)
    yield 3, (wide[at].astype(U) << (U(2 * bits) - half)) | (last >> half), last & ones(int(half))
    at = at[some[at + 3]]
    yield 4, pair(at), pair(at + 2)


def unpacked_grams(words: int, hi: np.ndarray, lo: np.ndarray, bits: int) -> list[np.ndarray]:
    """The word ids, 0 behind the last."""
    b, mask, none = U(bits), ones(bits), np.zeros(len(hi), U)
    if words == 2:
        return [hi, lo, none, none]
    if words == 4:
        return [hi >> b, hi & mask, lo >> b, lo & mask]
    half = U(half_bits(3, bits))
    rest = U(2 * bits) - half
    last = ((hi & ones(int(rest))) << half) | lo
    return [hi >> rest, last >> b, last & mask, none]


FILTERS = "words int, block long, place long, filter binary"


def _filters(bits: int, cut: int):
    """Quotient filters of the shards, cut by the first ``cut`` bits."""
    def emit(held: list[np.ndarray], place: int) -> Iterator[pa.RecordBatch]:
        for words, hi, lo in packed_grams(np.concatenate(held), bits):
            parts = QuotientFilter.of(hi, lo, half_bits(words, bits)).split(cut)
            yield pa.RecordBatch.from_arrays(
                [pa.array([words] * len(parts), pa.int32()), pa.array([v for v, _ in parts], pa.int64()),
                 pa.array([place] * len(parts), pa.int64()), pa.array([f.to_bytes() for _, f in parts], pa.binary())],
                names=["words", "block", "place", "filter"])

    def run(batches):
        held, size, place = [], 0, 0
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            for i in range(b.num_rows):
                codes = from_planes(cols["codes"][i].as_buffer())
                known = cols["known"].slice(i, 1).flatten()
                local, ids = (x.to_numpy(zero_copy_only=False) for x in known.flatten())
                table = np.zeros(int(codes.max(initial=0)) + 1, dtype=np.uint32)
                table[local] = ids
                place = place if held else cols["place"][i].as_py()
                held += [table[codes], np.zeros(1, np.uint32)]
                size += len(codes)
                if size >= COUNTED:
                    yield from emit(held, place)
                    held, size = [], 0
        if held:
            yield from emit(held, place)
    return run


def _merged(table: pa.Table) -> tuple[int, int, int, QuotientFilter]:
    f = QuotientFilter.merge([QuotientFilter.from_bytes(x) for x in table.column("filter").to_pylist()])
    return (*(table.column(c)[0].as_py() for c in ("words", "block", "place")), f)


def _merge_and_cut(cut: int):
    def run(table: pa.Table) -> pa.Table:
        words, block, place, f = _merged(table)
        parts = f.split(cut)
        return pa.table({"words": pa.array([words] * len(parts), pa.int32()),
                         "block": pa.array([(block << (p.prefix - f.prefix)) | v for v, p in parts], pa.int64()),
                         "place": pa.array([place] * len(parts), pa.int64()),
                         "filter": pa.array([p.to_bytes() for _, p in parts], pa.binary())})
    return run


def _merge_and_read(bits: int, least: int):
    def run(table: pa.Table) -> pa.Table:
        words, block, _, f = _merged(table)
        hi, lo, n = f.at_least(least).entries(block)
        ids = unpacked_grams(words, hi, lo, bits)
        return pa.table({**{w: pa.array(x.astype(np.int64)) for w, x in zip(WORDS, ids)}, "a": pa.array(n, pa.int64())})
    return run


def frequent_phrases(shards: DataFrame, vocabulary: DataFrame, least: int, fan: int = FAN) -> DataFrame:
    """``(w1, w2, w3, w4, a)``: phrases of 2 to 4 words that occur ``least`` times
    (word ids, 0 behind the last word). A frequent phrase has frequent words only,
    so all other words just separate."""
    spark = shards.sparkSession
    bits = max(LEAST_BITS, int(vocabulary.agg(F.max("id")).first()[0] or 0).bit_length())
    if bits > 32:
        raise ValueError("word ids of more than 32 bits")
    count = max(1, shards.count())
    own = shards.select("shard", F.posexplode(F.arrays_zip("langs", "words"))) \
                .select("shard", (F.col("pos") + 1).alias("code"), F.col("col.langs").alias("lang"), F.col("col.words").alias("word"))
    known = own.join(vocabulary, ["lang", "word"]).groupBy("shard") \
               .agg(F.collect_list(F.struct("code", "id")).alias("known"))     # at most the words of one shard
    ready = shards.select("shard", "codes").join(known, "shard") \
                  .select("codes", "known", F.pmod(F.xxhash64("shard"), F.lit(count)).alias("place"))
    # `count` filters, then `count / fan` groups of them, and so on down to one
    cut = min(fan.bit_length() - 1, (count - 1).bit_length())
    with arrow_rows(spark, 2):
        now = ready.mapInArrow(_filters(bits, cut), FILTERS)
        count = -(-count // fan)
        while count > 1:
            cut = min(fan.bit_length() - 1, (count - 1).bit_length())
            grouped = now.withColumn("place", F.expr(f"place div {fan}")).groupBy("words", "block", "place")
            now = grouped.applyInArrow(_merge_and_cut(cut), FILTERS)
            count = -(-count // fan)
        return written(now.withColumn("place", F.lit(0).cast("long")).groupBy("words", "block", "place")
                       .applyInArrow(_merge_and_read(bits, least), "w1 long, w2 long, w3 long, w4 long, a long"),
                       "phrase-candidates")


# --- scores ---------------------------------------------------------------------

def _ids(*names: str):
    """A struct w1..w4 of the named ids, zeros behind."""
    cols = [F.col(n) for n in names] + [F.lit(0).cast("long")] * (4 - len(names))
    return F.struct(*[c.alias(w) for c, w in zip(cols, WORDS)])


def _exact(c: str):
    return F.col(c).cast("decimal(20,0)")


def scored_phrases(phrases: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(w1..w4, a, l, r, score)`` by each phrase's lowest-scoring cut."""
    counts = phrases.select(*WORDS, F.col("a").alias("f")).unionByName(
        vocabulary.select(F.col("id").alias("w1"), *[F.lit(0).cast("long").alias(w) for w in WORDS[1:]], "f"))
    cuts = [F.when(last, F.struct(F.lit(k).alias("k"), _ids(*WORDS[:k]).alias("p"), _ids(*WORDS[k:]).alias("q")))
            for k, last in ((1, F.lit(True)), (2, F.col("w3") > 0), (3, F.col("w4") > 0))]
    rows = phrases.select(*WORDS, "a", F.explode(F.array_compact(F.array(*cuts))).alias("c"))
    for part, name in (("p", "l"), ("q", "r")):
        side = counts.select(*[F.col(w).alias(f"{part}{i}") for i, w in enumerate(WORDS)], F.col("f").alias(name))
        rows = rows.select("*", *[F.col(f"c.{part}.{w}").alias(f"{part}{i}") for i, w in enumerate(WORDS)]) \
                   .join(side, [f"{part}{i}" for i in range(4)]).drop(*[f"{part}{i}" for i in range(4)])
    rows = rows.withColumn("t", _exact("l") + _exact("r")).withColumn("s", _exact("a") * F.lit(SCALE).cast("decimal(8,0)"))
    rows = rows.withColumn("score", F.expr("s div t"))
    best = rows.groupBy(*WORDS, "a").agg(F.min(F.struct("score", "c.k", "l", "r")).alias("b"))
    return best.select(*WORDS, "a", "b.l", "b.r", "b.score")


def not_inside(phrases: DataFrame, inside: int) -> DataFrame:
    """Phrases of which less than ``inside`` percent lie in one longer phrase."""
    three, four = F.col("w3") > 0, F.col("w4") > 0
    parts = F.array_compact(F.array(
        F.when(three, _ids("w1", "w2")), F.when(three, _ids("w2", "w3")), F.when(four, _ids("w3", "w4")),
        F.when(four, _ids("w1", "w2", "w3")), F.when(four, _ids("w2", "w3", "w4"))))
    within = phrases.where(three).select(F.explode(parts).alias("p"), F.col("a").alias("f")) \
                    .groupBy(*[F.col(f"p.{w}").alias(w) for w in WORDS]).agg(F.max("f").alias("f"))
    return phrases.join(within, WORDS, "left").where(
        F.col("f").isNull() | (_exact("f") * 100 < _exact("a") * F.lit(inside).cast("decimal(8,0)"))).drop("f")


def mine_collocations(df: DataFrame, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP,
                      inside: int = INSIDE, fan: int = FAN) -> DataFrame:
    """The ``top`` phrases of every language: ``lang, rank, phrase, a, l, r, n, score``.

    A phrase is 2 to 4 words of one piece of a text and counts ``a >= least``
    times, overlaps included. A cut into two parts scores ``2000000 a / (l + r)``,
    rounded down, where ``l`` and ``r`` are the counts of the parts; the
    lowest-scoring cut counts (the first of equal ones). Phrases that lie to
    ``inside`` percent in one longer candidate are dropped. Counts are exact and
    cover all texts; products run in decimals of 38 digits. Equal scores rank by
    count, then by the phrase's UTF-8 bytes. ``n``: all words of the language.

    Memory: the words of some shards (about ``COUNTED``, or one longer text), or
    ``fan`` slices of filters. Null language is ``und``, null or empty text has no words,
    repeated rows count each, an empty table gives no rows; other columns are
    ignored.
    """
    shards = word_shards(df, lang, text)
    vocabulary, totals = frequent_words(shards, least)
    phrases = frequent_phrases(shards, vocabulary, least, fan)
    first = vocabulary.select(F.col("id").alias("w1"), "lang", F.col("word").alias("v1"))
    left = written(not_inside(scored_phrases(phrases, vocabulary), inside).join(first, "w1"), "phrase-scores")
    # Only phrases that reach the last place's score and count need their words.
    # (a language's window sees `top` rows a task: Spark limits it before the shuffle)
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    last = left.select("lang", "score", "a", F.row_number().over(best).alias("p")).where(F.col("p") <= top) \
               .groupBy("lang").agg(F.min(F.struct("score", "a")).alias("last"))
    # One row a language; sent to the phrases, which else would meet by language.
    last = counted_broadcast(written(last, "phrase-last"), 64)
    rows = left.join(last, "lang").where(F.struct("score", "a") >= F.col("last")).drop("last")
    for i in (2, 3, 4):
        rows = rows.join(vocabulary.select(F.col("id").alias(f"w{i}"), F.col("word").alias(f"v{i}")), f"w{i}", "left")
    rows = rows.select("lang", F.concat_ws(" ", "v1", "v2", "v3", "v4").alias("phrase"), "a", "l", "r", "score") \
               .join(counted_broadcast(totals, 64), "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top) \
               .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


ORACLE_SQL = f"""
WITH texts AS (
  SELECT coalesce(lang, '{NO_LANG}') AS lang,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents WHERE text IS NOT NULL),
pieces AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM words, (VALUES (1), (2), (3), (4)) AS lengths(k)) AS placed),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE k >= 2 AND f >= {LEAST}),
cuts AS (
  SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS p, array_to_string(w[c + 1:k], ' ') AS q
  FROM (SELECT *, unnest(range(1, k)) AS c FROM candidates) AS each),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, c, x.f AS l, y.f AS r, (({SCALE}::HUGEINT * a) // (x.f + y.f))::BIGINT AS score
  FROM cuts JOIN counts x ON x.lang = cuts.lang AND x.phrase = cuts.p JOIN counts y ON y.lang = cuts.lang AND y.phrase = cuts.q),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
parts AS (
  SELECT lang, a AS f, array_to_string(w[i:i + m - 1], ' ') AS part
  FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM candidates, (VALUES (2), (3)) AS sizes(m) WHERE m < k) AS inner_parts),
within AS (SELECT lang, part, max(f) AS f FROM parts GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN within ON within.lang = best.lang AND within.part = best.phrase
  WHERE within.f IS NULL OR 100::HUGEINT * within.f < {INSIDE}::HUGEINT * best.a)
SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals ON totals.lang = kept.lang
QUALIFY rank <= {TOP}
"""
