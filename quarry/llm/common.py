"""Helpers shared by the training-data operators: written intermediate tables,
size-aware regrouping of Arrow batches, complete key groups out of sorted
partitions, and connected components by graph contraction."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import BROADCAST_LIMIT_BYTES, read_table, scratch_path

# Rows Spark hands to Python at once. Texts are long, so the batch is kept small;
# ``regroup`` joins small batches up to a byte budget.
ARROW_ROWS = 256


def text_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small (a session setting, lowered only)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    have = int(spark.conf.get(key, "10000"))
    if have <= 0 or have > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: lineage
    is cut, rows are computed once, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*frames: DataFrame) -> None:
    """Delete tables that ``written`` made in this run and nothing reads any more."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            jvm = df.sparkSession.sparkContext._jvm
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            fs = folder.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration())
            fs.delete(folder, True)


def regroup(batches: Iterable[pd.DataFrame], column: str, budget: int = 1_000_000) -> Iterator[pd.DataFrame]:
    """Join consecutive batches until their texts reach ``budget`` characters."""
    held: list[pd.DataFrame] = []
    size = 0
    for pdf in batches:
        if not len(pdf):
            continue
        held.append(pdf)
        size += int(pdf[column].str.len().fillna(0).sum()) + len(pdf)
        if size >= budget:
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def complete_groups(batches: Iterable[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Frames that hold only whole groups, out of a partition sorted by ``keys``.

    Memory is one batch plus one group. Callers bound the group size.
    """
    rest: list[pd.DataFrame] = []
    for pdf in batches:
        if not len(pdf):
            continue
        last = pdf[keys].iloc[-1]
        same = np.ones(len(pdf), dtype=bool)
        for k in keys:
            same &= (pdf[k] == last[k]).to_numpy()
        if same.all() and (not rest or all(rest[-1][k].iloc[-1] == last[k] for k in keys)):
            rest.append(pdf)
            continue
        done = pd.concat([*rest, pdf[~same]], ignore_index=True)
        if len(done):
            yield done
        rest = [pdf[same]]
    if rest:
        yield pd.concat(rest, ignore_index=True)


def starts_of(sorted_keys: list[np.ndarray]) -> np.ndarray:
    """Start offsets (and the end) of the runs of equal keys in sorted arrays."""
    n = len(sorted_keys[0])
    change = np.zeros(max(n - 1, 0), dtype=bool)
    for a in sorted_keys:
        change |= a[1:] != a[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [n]]) if n else np.zeros(1, dtype=np.int64)


def spanning_edges(n: int, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """A forest (at most n-1 edges) that joins what the given edges join."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for a, b in zip(left.tolist(), right.tolist()):
        ra, rb = root(a), root(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
            out.append((min(a, b), max(a, b)))
    return out


def counted_broadcast(df: DataFrame, row_bytes: int, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast ``df`` if its rows of about ``row_bytes`` bytes fit the limit (the size
    of a compressed file says little about that). ``df`` should be a written table,
    whose rows are counted from its footers."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def components(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of ``edges(a, b)``: rows ``(node, label)`` for every
    node that occurs in an edge; the label is the smallest node of the component.

    Each round every node points at its smallest neighbour (a partial
    aggregation, so a node with very many edges is no hot spot), pointers are
    doubled, and the edges are rewritten between the pointed-at nodes; edges
    inside a merged group vanish. The graph shrinks by a factor each round and
    every round is written to the shared folder.
    """
    spark = edges.sparkSession
    e = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                .where("a <> b").distinct(), f"{name}-edges")
    labels = written(e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
                     .select("node", F.col("node").alias("label")), f"{name}-labels")
    while not e.isEmpty():
        old = [e, labels]
        both = e.union(e.select("b", "a"))
        point = both.groupBy(F.col("a").alias("x")).agg(F.min("b").alias("m")) \
            .select("x", F.least("x", "m").alias("y"))
        point = written(point, f"{name}-point")
        old.append(point)
        for _ in range(2):
            nxt = point.select(F.col("x").alias("y"), F.col("y").alias("z"))
            point = point.join(nxt, "y", "left").select("x", F.coalesce("z", "y").alias("y"))
        point = written(point, f"{name}-jump")
        old.append(point)
        # A giant component is one label of very many rows; a small pointer table
        # goes to them instead of all of them to one task.
        small = counted_broadcast(point, 16)
        labels = written(
            labels.join(small.withColumnRenamed("x", "label"), "label", "left")
            .select("node", F.coalesce("y", "label").alias("label")), f"{name}-labels")
        pa = small.select(F.col("x").alias("a"), F.col("y").alias("ya"))
        pb = small.select(F.col("x").alias("b"), F.col("y").alias("yb"))
        e = written(e.join(pa, "a").join(pb, "b")
                    .select(F.least("ya", "yb").alias("a"), F.greatest("ya", "yb").alias("b"))
                    .where("a <> b").distinct(), f"{name}-edges")
        forget(*old)        # every table of this round has been read
    forget(e)
    return labels


def map_pandas(df: DataFrame, fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str) -> DataFrame:
    """``mapInPandas`` with small text batches."""
    text_batches(df.sparkSession)
    return df.mapInPandas(fn, schema)


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, or a longer one that no column has (names compare without case)."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def with_results(df: DataFrame, text: str, fn: Callable[[list], dict[str, np.ndarray]], fields: str,
                 budget: int = 1_000_000) -> tuple[DataFrame, dict[str, str]]:
    """Append what ``fn(texts)`` computes for each row to all columns of ``df``.

    Arrow batches are joined up to ``budget`` bytes, ``fn`` gets their texts as a
    list of ``str`` or ``None`` and returns one array per field. Rows keep their
    other columns untouched, so nothing is joined back by an id. Returns the
    frame and the names the fields got (never a clash with the input's names).
    """
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructField, StructType

    text_batches(df.sparkSession)
    out = StructType.fromDDL(fields)
    names, taken = {}, list(df.columns)
    for f in out.fields:
        names[f.name] = free_name(taken, f"__{f.name}")
        taken.append(names[f.name])
    at = df.columns.index(text)
    # Every column gets a plain unique name on the way through Python, so inputs
    # with equal or odd names pass.
    inner = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    text_name = f"c{at}"
    schema = StructType([*inner.schema.fields, *[StructField(names[f.name], f.dataType) for f in out.fields]])
    kinds = [(f.name, names[f.name], to_arrow_type(f.dataType)) for f in out.fields]

    def run(batches):
        for held in regroup_arrow(batches, text_name, budget):
            got = fn(held.column(text_name).to_pylist())
            cols = [held.column(i) for i in range(held.num_columns)]
            cols += [pa.array(got[f], type=kind) for f, _, kind in kinds]
            yield from pa.Table.from_arrays(cols, names=[*held.column_names, *[n for _, n, _ in kinds]]).to_batches()

    res = inner.withColumn(text_name, F.col(text_name).cast("string")).mapInArrow(run, schema)
    return res.toDF(*df.columns, *[n for _, n, _ in kinds]), names


def regroup_arrow(batches, text_name: str, budget: int):
    """Join record batches until their text bytes reach ``budget``."""
    import pyarrow as pa

    held, size = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        size += b.column(text_name).nbytes + 64 * b.num_rows
        if size >= budget:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)
