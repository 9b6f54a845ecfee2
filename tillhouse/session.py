"""Session helpers. On a cluster the session comes from spark-submit; these are
the settings the library relies on, and the ones used by tests and the bench."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every query may assume; all of them can be set on a running session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key also where that costs one more shuffle afterwards,
    # as in joins that follow one another on the same key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def local_session(name: str = "tillhouse", cpus: int | str = "*", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # Recording the Python line of every expression makes plans slow to build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the queries rely on to a session we were given."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark
