"""Intermediate tables in the shared folder the cluster names for checkpoints."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Of Parquet files: whole texts take two thirds of what Spark's default takes.
CODEC = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session without one gets a folder of its own."""
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getConf().get(SETTING)
    if not folder and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="lectern-")
        spark.conf.set(SETTING, folder)
    if not folder:
        raise ValueError(f"{SETTING} must name a folder that all executors share")
    return folder.rstrip("/")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files; else they stay until the driver happens to collect its garbage."""
    held = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if held is None else spark.conf.set(_CLEANUP, held)


class Scratch:
    """A folder of its own for one job's stages, removed when closed, at the latest when Python exits.

    A stage is an ordinary Parquet table on shared storage, so losing an executor after it was
    written loses nothing.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/lectern-{uuid.uuid4().hex}"
        atexit.register(self._discard)

    def path(self, name: str | None = None) -> str:
        return f"{self.root}/{name or uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str | None = None) -> DataFrame:
        """Materialise ``df`` and return it as read back."""
        path = self.path(name)
        with passing_shuffles(self.spark):
            df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def close(self) -> None:
        atexit.unregister(self._discard)
        remove(self.spark, self.root)

    def _discard(self) -> None:
        with contextlib.suppress(Exception):  # the JVM may be gone already
            remove(self.spark, self.root)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _file_system(spark, path)
    fs.delete(where, True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _file_system(spark, path)
    return fs.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    fs, where = _file_system(spark, path)
    return [entry.getPath().getName() for entry in fs.listStatus(where)] if fs.exists(where) else []


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, where = _file_system(spark, source)
    goal = _file_system(spark, target)[1]
    fs.mkdirs(goal.getParent())
    if not fs.rename(where, goal):
        raise OSError(f"cannot move {source} to {target}")
