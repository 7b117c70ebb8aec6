"""Session defaults: the runtime settings that the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every query relies on; all times are UTC.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # HotSpot never compiles methods of more bytecode; the rule cascade in one such method runs
    # interpreted. Beyond it, Spark generates the operators one by one, in small methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def ensure_session(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume (idempotent)."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_local_session(app: str = "ingestry", cores: int = 8, partitions: int = 8) -> SparkSession:
    """Local session used by tests and the bench (never by library code on a cluster)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return ensure_session(spark)
