"""How much data a plan reads, asked before choosing how to run it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TASK_BYTES = 128 * 1024 * 1024
#: Rows of one Arrow batch.
BATCH_ROWS = 1024
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> SparkSession:
    """Let tasks send whole texts to Python in batches of at most ``rows`` rows: a row may be a long text."""
    if not 0 < int(spark.conf.get(BATCH_SETTING)) <= rows:
        spark.conf.set(BATCH_SETTING, str(rows))
    return spark


def scanned_bytes(df: DataFrame) -> int | None:
    """Size of the files behind ``df`` from the file listing; None when it is not file-backed.

    Only file metadata is read, on the driver, and only for a plan of few files: a plan of many is
    large enough for every decision made here.
    """
    files = df.inputFiles()
    if not files or len(files) >= _cores(df):
        return None
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
    total = 0
    for name in files:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(name))
        total += path.getFileSystem(conf).getFileStatus(path).getLen()
    return total


def _cores(df: DataFrame) -> int:
    return df.sparkSession.sparkContext.defaultParallelism


def spread_small_scan(df: DataFrame) -> DataFrame:
    """Use all cores for heavy per-row work on an input of few, small files.

    The shuffle this adds moves less than one task's worth of file bytes per core. A larger input is
    returned as it is: its own splits already fill the cluster.
    """
    total = scanned_bytes(df)
    cores = _cores(df)
    if total is None or total >= cores * TASK_BYTES:
        return df
    return df.repartition(cores)
