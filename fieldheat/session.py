"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Dates and hours of readings are UTC throughout, so the session must be too.
# The other settings are Spark's own run-time answers to skew and small partitions.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small shuffles keep one task per core: nearest-station search and gap filling grow after them.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    # Tasks that write few partitions (seasons) keep a file open for each and do not sort their rows by them, which spills.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "20g", app: str = "fieldheat") -> SparkSession:
    """A single-machine session for tests and benchmarks; clusters bring their own."""
    partitions = "8" if cores == "*" else str(cores)
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        # A whole computation compiles a few hundred classes; keep them for the next one.
        .config("spark.sql.codegen.cache.maxEntries", "2000")
    )
    for name, value in RUNTIME_SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
