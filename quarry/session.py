"""Session construction and small plan-level helpers shared by every module.

Everything here is configuration a Spark user would write: AQE on, skew-join
splitting on, UTC session time, UI off. Partition counts are left to AQE; the
initial ``spark.sql.shuffle.partitions`` is sized for the target cluster by the
caller (tests use 8).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest dimension side we are willing to broadcast by explicit hint. Sides
# without a provable bound are left to the optimizer / AQE, which use their
# own runtime size checks.
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024
STRIPE_BYTES = 1 << 30      # bytes that ``by_stripes`` lets lie in shuffle files at one time,
STRIPES = 16                # unless that took more passes over the rows than these

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of frames that are no longer referenced are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "quarry", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared (HDFS/object-store) folder and is
    used as is; without it this raises, since a machine-local folder cannot be
    read by other executors. Only a ``local`` master (unit tests, a laptop) gets
    a scratch folder of our own.
    """
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf = tempfile.mkdtemp(prefix="quarry-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf)
    spark.sparkContext.setCheckpointDir(conf)
    return spark.sparkContext.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (for written tables
    that cut lineage, stream checkpoints and test outputs)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def files_freed(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a query made and run inside are deleted when it ends, not
    when the driver happens to collect its plan."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if was is None else spark.conf.set(key, was)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read back: lineage
    is cut like by ``cut_lineage``, in fewer bytes, and no shuffle file is left."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    with files_freed(spark):
        df.select("*").write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_stripes(rows: DataFrame, key: str, row_bytes: int, fn: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """``fn`` over the rows of some keys after the other, stored and united. ``row_bytes``:
    what ``fn`` shuffles for each row; the files of one stripe are deleted before the
    next one starts. All rows of a key (null is one, too) are in one stripe."""
    stripes = min(STRIPES, max(1, -(-rows.count() * row_bytes // STRIPE_BYTES)))
    out = None
    for i in range(stripes):
        part = stored(fn(rows.where(F.pmod(F.xxhash64(key), F.lit(stripes)) == i) if stripes > 1 else rows), name)
        out = part if out is None else out.unionByName(part)
    return out


def estimated_bytes(df: DataFrame) -> int | None:
    """Optimizer's size estimate for ``df`` (None if it cannot be read)."""
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        # py4j hands a Scala BigInt over as a Python int (or as an object)
        return int(size) if isinstance(size, int) else int(size.toString())
    except Exception:  # pragma: no cover - depends on the JVM bridge
        return None


def sized_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast hint only when the optimizer proves the side is small.

    Above the limit (or without an estimate) the frame is returned untouched
    and the join falls back to a shuffle join, which AQE may still convert to
    a broadcast at runtime from real shuffle statistics.
    """
    size = estimated_bytes(df)
    if size is not None and size <= limit:
        return F.broadcast(df)
    return df


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan over the cores when the source has fewer splits than the
    cluster has task slots (e.g. one large row group), before CPU-heavy
    per-row work such as tokenizing. On a real input of many files the split
    count already exceeds the slots and this is a no-op (no extra shuffle)."""
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    try:
        have = df.rdd.getNumPartitions()
    except Exception:  # pragma: no cover
        return df
    return df.repartition(want) if have < want else df


def few_partitions(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """A checkpointed frame of narrow rows in as many partitions as its rows need, not
    as many as the source was read in: a fit runs hundreds of short jobs over it, and
    each pays for every partition. Nothing is shuffled."""
    return df.coalesce(max(1, -(-df.count() // rows)))


def by_key(df: DataFrame, key: str) -> DataFrame:
    """Rows of one key in one partition, as many as a shuffle has: what is grouped by
    the key and more columns afterwards moves no further. For rows that are fewer
    than what is made of them (documents before they are split into words)."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))
