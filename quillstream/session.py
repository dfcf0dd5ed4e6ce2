"""Session settings shared by batch jobs, streams and tests."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that hold at any size.  AQE merges small shuffle partitions and splits skewed
# joins, but never splits an aggregation, so the starting width follows the input size.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Streaming state lives off-heap and on disk instead of in the task heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Each batch then uploads its changes, not a snapshot of all state.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# A gradient over 262,144 terms is a 2 MB array.  With small G1 regions each one
# is allocated outside the young generation; large regions avoid that.
LARGE_REGIONS = "-XX:G1HeapRegionSize=32m"


# Input that one partition of a shuffle stands for before AQE merges the small ones.
BYTES_PER_PARTITION = 512 << 20


def starting_width(input_bytes: int) -> int:
    """Shuffle partitions to start with for an input of that size, 200 at least."""
    return max(200, -(-input_bytes // BYTES_PER_PARTITION))


def build_session(
    app: str = "quillstream",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Create (or reuse) a session.  ``master`` stays unset under spark-submit.

    Give ``input_bytes``, the size of the largest input, unless it is small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(BASE_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if input_bytes:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            starting_width(input_bytes))
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(app: str = "quillstream-local", cores: str = "*",
                  memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """One-machine session for tests and the benchmark."""
    return build_session(
        app,
        master=f"local[{cores}]",
        shuffle_partitions=shuffle_partitions,
        conf={
            "spark.driver.memory": memory,
            "spark.driver.extraJavaOptions": LARGE_REGIONS,
            "spark.ui.enabled": "false",
            "spark.driver.host": "127.0.0.1",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )
