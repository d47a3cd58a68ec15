"""Row shaping and filters (SURVEY PRJ-*, FLT-*).

All operators are column expressions or narrow DataFrame transforms; none of
them shuffles except ``index_values`` (distinct + distributed numbering),
``rare_keys`` (partial aggregate) and the anti joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.ordered import global_index


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- projections -------------------------------------------------------------
def take_fields(df: DataFrame, col: str, sep: str, n: int, names: list[str] | None = None) -> DataFrame:
    """PRJ-1: split ``col`` on the regex ``sep`` and keep the first ``n`` fields."""
    parts = F.slice(F.split(F.col(col), sep), 1, n)
    names = names or [f"f{i}" for i in range(n)]
    return df.select(*[F.try_element_at(parts, F.lit(i + 1)).alias(names[i]) for i in range(n)])


def cast_fields(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """PRJ-2: typed casts that give NULL instead of failing (ANSI mode)."""
    return df.select(*[F.expr(f"try_cast(`{c}` AS {types[c]})").alias(c) if c in types else F.col(c)
                       for c in df.columns])


def strip_quotes(c) -> Column:
    """PRJ-3: remove every double quote."""
    return F.translate(_c(c), '"', "")


def fill_marker(c, marker: str = "?", default: float = 0.0) -> Column:
    """PRJ-4: ``marker`` -> ``default``; other text parsed as double."""
    c = _c(c)
    return F.when(c == marker, F.lit(default)).otherwise(c.try_cast("double"))


def clamp_min(c, lo: float = 0.0) -> Column:
    """PRJ-5: values below ``lo`` become ``lo``."""
    return F.greatest(_c(c), F.lit(lo))


def parse_labelled(df: DataFrame, col: str = "value", sep: str = "\t", first_num: int = 4,
                   category_at: int = 3, clamp: bool = False) -> DataFrame:
    """PRJ-3/4/6/7: classifier text line -> (category, nums array<double>, label).

    Fields are split, quotes stripped; fields ``first_num`` .. n-2 are numbers
    (``?`` = 0.0, optionally clamped at 0) and the last field is the label.
    """
    f = F.transform(F.split(F.col(col), sep), lambda x: strip_quotes(x))
    n = F.size(f)
    nums = F.transform(F.slice(f, first_num + 1, n - first_num - 1), lambda x: fill_marker(x))
    if clamp:
        nums = F.transform(nums, lambda x: clamp_min(x))
    return df.select(F.element_at(f, 1).alias("id"),
                     F.element_at(f, category_at + 1).alias("category"),
                     nums.alias("nums"),
                     F.element_at(f, -1).try_cast("double").alias("label"))


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """PRJ-6: numeric columns -> ``vector`` column (for pyspark.ml)."""
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.array(*[F.col(c).cast("double") for c in cols])))


def parent_dir(c) -> Column:
    """PRJ-8: second-to-last '/' segment of a path or URL (NULL if none)."""
    return F.try_element_at(F.split(_c(c), "/"), F.lit(-2))


def strip_prefix(c, prefix: str) -> Column:
    """PRJ-9: drop ``prefix`` where the value starts with it."""
    c = _c(c)
    return F.when(c.startswith(prefix), F.substring(c, len(prefix) + 1, 1 << 30)).otherwise(c)


def annotate_line(line, value) -> Column:
    """PRJ-11: ``line + " " + value``."""
    return F.concat_ws(" ", _c(line), _c(value).cast("string"))


def decode_flags(items: DataFrame, lookup: DataFrame, flags: str = "flags",
                 name: str = "name", idx: str = "idx", out: str = "genres") -> DataFrame:
    """PRJ-12/13: 0/1 flag array -> space-joined names of the set flags.

    The lookup has one row per flag position (as many as the array is wide); its
    names become a literal array and each row is decoded in place: no join, no
    shuffle, and no other column takes part."""
    rows = {r[idx]: r[name] for r in lookup.select(idx, name).collect()}  # the flag width
    names = F.array(*[F.lit(rows.get(i)) for i in range(max(rows, default=-1) + 1)]) if rows else F.array().cast("array<string>")
    hits = F.filter(F.zip_with(flags, names, lambda f, n: F.when(f == "1", n)), lambda x: x.isNotNull())
    return items.select(*[c for c in items.columns if c != flags],
                        F.coalesce(F.array_join(hits, " "), F.lit("")).alias(out))


def one_hot(idx, n: int) -> Column:
    """PRJ-14: dense 0/1 array of width ``n`` with a 1 at ``idx``."""
    i0 = _c(idx)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.when(i == i0, 1.0).otherwise(0.0))


def index_values(df: DataFrame, col: str, out: str = "idx") -> DataFrame:
    """PRJ-15: distinct values of ``col`` numbered 0.. in value order.

    Distributed: distinct (partial aggregate) then a range-partitioned global
    position, never a single-task window or a driver-side dictionary.
    """
    d = df.select(col).where(F.col(col).isNotNull()).distinct()
    return global_index(d, [col], out)


def fmt_pct(c, digits: int = 4) -> Column:
    """PRJ-16: ``x * 100`` formatted as ``12.3456%``."""
    return F.format_string(f"%.{digits}f%%", _c(c) * 100.0)


def explode_tokens(df: DataFrame, col: str, sep: str, out: str = "tok", keep: list[str] | None = None) -> DataFrame:
    """PRJ-17: one row per token of ``col`` split on the regex ``sep``."""
    keep = keep or []
    return df.select(*keep, F.explode(F.split(F.col(col), sep)).alias(out))


# --- filters -----------------------------------------------------------------
def filter_contains(df: DataFrame, col: str, s: str) -> DataFrame:
    """FLT-1: rows whose ``col`` contains the literal ``s``."""
    return df.where(F.col(col).contains(s))


def drop_empty(df: DataFrame, col: str) -> DataFrame:
    """FLT-2."""
    return df.where(F.length(col) > 0)


def filter_matches(df: DataFrame, col: str, pattern: str) -> DataFrame:
    """FLT-3: full-string regex match (``pattern`` is anchored here)."""
    return df.where(F.col(col).rlike(f"^(?:{pattern})$"))


# FIXED VALUES: the stop-word list of the text program, in its own order.
STOPWORDS = ["the", "a", "an", "of", "or", "in", "for", "by", "on", "but", "is", "not",
             "with", "as", "was", "if", "they", "are", "this", "and", "it", "have", "from",
             "at", "my", "be", "that", "to"]


def drop_stopwords(df: DataFrame, col: str, words: list[str] = STOPWORDS) -> DataFrame:
    """FLT-4: drop rows whose value is in a fixed list (a literal IN set)."""
    return df.where(~F.col(col).isin(list(words)))


def min_length(df: DataFrame, col: str, n: int = 2) -> DataFrame:
    """FLT-5."""
    return df.where(F.length(col) >= n)


def rare_keys(df: DataFrame, col: str, below: int = 2) -> DataFrame:
    """FLT-6: keys whose total count is < ``below`` (map-side combined count)."""
    return df.groupBy(col).count().where(F.col("count") < below).select(col)


def drop_keys(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """FLT-7 / JN-7: left anti join (AQE splits a hot key on the left side)."""
    return df.join(keys, on, "left_anti")


def substrings(words: DataFrame, col: str, out: str = "sub") -> DataFrame:
    """Every non-empty substring of every word, one row each (distinct)."""
    n = F.length(F.col(col))
    starts = F.sequence(F.lit(1), F.greatest(n, F.lit(1)))
    pairs = F.flatten(F.transform(starts, lambda s: F.transform(
        F.sequence(F.lit(1), F.greatest(n - s + 1, F.lit(1))),
        lambda ln: F.substring(F.col(col), s, ln))))
    return words.select(F.explode(pairs).alias(out)).where(F.length(out) > 0).distinct()


def drop_substrings(df: DataFrame, col: str, words: DataFrame, word_col: str) -> DataFrame:
    """FLT-8: drop a token if it is a substring of any listed word.

    Rewritten from a nested-loop ``contains`` into an equi anti join against
    all substrings of the listed words.
    """
    subs = substrings(words, word_col, "_sub")
    return df.join(subs, F.col(col) == F.col("_sub"), "left_anti")


def threshold(c, t: float = 0.5) -> Column:
    """FLT-10: ``1.0`` if score > t else ``0.0``."""
    return F.when(_c(c) > t, 1.0).otherwise(0.0)


def lookup(df: DataFrame, col: str, value) -> DataFrame:
    """FLT-11: point lookup (a pushed-down equality filter)."""
    return df.where(F.col(col) == value)
