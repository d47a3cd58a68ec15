"""Scale guards: the broadcast hint needs a proven small side, and scans are
only spread when they have fewer splits than task slots."""
from quarry.session import estimated_bytes, sized_broadcast, spread


def _has_hint(df):
    return "broadcast" in df._jdf.queryExecution().analyzed().toString().lower()


class _Cluster:
    """Just enough of a session: a cluster master without a checkpoint folder."""
    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default


def test_checkpoint_folder_is_required_off_local():
    import pytest

    from quarry.session import ensure_checkpoint_dir
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(_Cluster)


def test_sized_broadcast_only_below_limit(spark):
    small = spark.range(0, 10)
    assert estimated_bytes(small) is not None
    assert _has_hint(sized_broadcast(small, limit=1 << 20))
    assert not _has_hint(sized_broadcast(small, limit=1))


def test_spread_is_a_noop_with_enough_splits(spark):
    slots = spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, numPartitions=slots * 2)
    assert spread(many) is many
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one).rdd.getNumPartitions() == slots
