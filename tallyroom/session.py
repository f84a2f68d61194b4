"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# UTC keeps instants and civil dates aligned; ANSI makes a bad cast fail the
# job instead of turning a value into NULL.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Capturing the Python call site of every column doubles plan-building time.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Lists of order ids reach Parquet's Bloom filters up to this length.
    "spark.sql.parquet.pushdown.inFilterThreshold": "500",
    # Lets gap sessions merge on the map side before their shuffle.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
}


def apply_required_conf(spark: SparkSession) -> SparkSession:
    """Pin the settings that change results on an already running session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def shuffle_partitions_for(shuffled_bytes: int, target_mb: int = 128, minimum: int = 8) -> int:
    """Initial shuffle partitions for a known shuffle volume; AQE merges small ones.

    AQE only coalesces, so the starting count has to suit the largest shuffle:
    100 TB at the default of 200 would mean 500 GB per task.
    """
    return max(minimum, -(-shuffled_bytes // (target_mb * 1024 * 1024)))


def build_session(app_name: str = "tallyroom", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_CONF, **REQUIRED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
