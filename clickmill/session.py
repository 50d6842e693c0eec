"""Session settings and the shared folder for intermediate data."""

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

CLUSTER_CONF = {
    # Start wide and let adaptive execution merge small shuffle partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Hash instead of sort in joins once all partitions are known to be this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Larger splits combine more rows before a shuffle, until their groups spill.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Sketches of this many keys per task, 4 KB each at most, before it sorts instead.
    "spark.sql.objectHashAggregate.sortBased.fallbackThreshold": "20000",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.shuffle.io.retryWait": "10s",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}

STREAM_CONF = {
    # A stateful query keeps the partition count of its first start for good.
    "spark.sql.shuffle.partitions": "2000",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(builder: SparkSession.Builder, *confs: dict) -> SparkSession.Builder:
    """Apply CLUSTER_CONF, then the given settings, to a session builder."""
    for conf in (CLUSTER_CONF, *confs):
        for key, value in conf.items():
            builder = builder.config(key, value)
    return builder


_own_folders: list[tempfile.TemporaryDirectory] = []  # removed when the process ends


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the folder named by spark.checkpoint.dir, which all executors share.

    A local session that names none gets one temporary folder for as long as the process
    lives; on a cluster that would be out of the other machines' reach.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _own_folders.append(tempfile.TemporaryDirectory(prefix="run-", ignore_cleanup_errors=True))
        shared = _own_folders[-1].name
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/clickmill/{label}-{uuid4().hex}"
