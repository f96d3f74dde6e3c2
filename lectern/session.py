"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings this package relies on; sizes stay with the cluster's own defaults."""
    return (
        builder.config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
        # Arrow batches are rows: keep them small because one row may be a whole article.
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
    )


def local_session(cores: int | str = 8, memory: str = "16g", app: str = "lectern") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
