"""Session settings the package relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that decide results or scale behaviour. The master, memory and
#: executor counts are left to spark-submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Several stateful levels in one streaming query keep their windows off-heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Upload changes instead of whole files at each batch, and skip the look-up
    # that only serves a row counter.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def sized_for(shuffle_bytes: int, partition_bytes: int = 256 * 2**20) -> dict[str, str]:
    """Keyword settings of :func:`build_session` for an expected shuffle volume.

    The count is the upper bound AQE merges small partitions from; streaming
    state is fixed to it at the first start.
    """
    count = max(200, min(100_000, -(-shuffle_bytes // partition_bytes)))
    return {"spark__sql__shuffle__partitions": str(count)}


def build_session(
    app: str = "meterfold", master: str | None = None, **settings: str
) -> SparkSession:
    """Return a session with :data:`DEFAULTS`; ``settings`` win over them.

    Keyword names use ``__`` for the dots of a Spark key.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    wanted = dict(DEFAULTS)
    wanted.update({k.replace("__", "."): v for k, v in settings.items()})
    for key, value in wanted.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
