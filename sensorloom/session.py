"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Needed for right results: wire timestamps are UTC, and keyed timers need RocksDB.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Defaults for speed; a cluster overrides them.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the required run-time settings to a session somebody else built."""
    for name, value in REQUIRED.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build(app: str = "sensorloom", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RECOMMENDED, **REQUIRED, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
