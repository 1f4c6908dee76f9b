"""Stage tables: results written once and read back by later stages."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession

#: A task that writes holds a row group in memory, outside of what Spark accounts for.
ROW_GROUP_BYTES = 16 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; where that is unset, one in the warehouse.

    A warehouse on the driver's own disk is no shared folder, so a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_stages"
    on_disk = file_system(spark, folder)[0].getUri().getScheme() == "file"
    if on_disk and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; it is removed at the end of the driver program."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_discard_quietly, spark, path)
    return path


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path in its form."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, place = file_system(spark, path)
    return fs.exists(place)


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Move a file to a name in one step; parents are made, and a file of that name is replaced."""
    java = spark._jvm.org.apache.hadoop.fs
    fs, place = file_system(spark, target)
    fs.mkdirs(place.getParent())
    overwrite = spark.sparkContext._gateway.new_array(java.Options.Rename, 1)
    overwrite[0] = java.Options.Rename.OVERWRITE
    context = java.FileContext.getFileContext(fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    context.rename(fs.makeQualified(java.Path(source)), fs.makeQualified(place), overwrite)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stage table; nothing may read it any more."""
    fs, place = file_system(spark, path)
    fs.delete(place, True)


def _discard_quietly(spark: SparkSession, path: str) -> None:
    with suppress(Exception):  # the session may have ended
        discard(spark, path)


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """What a query shuffles is deleted when it ends, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a stage table and read it back: its lineage ends at files that survive lost executors."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    with _shuffles_deleted(spark):
        df.write.option("parquet.block.size", str(ROW_GROUP_BYTES)).parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    fs, place = file_system(spark, path)
    table.stage_path, table.stage_bytes = path, fs.getContentSummary(place).getLength()
    return table


class Stages:
    """Stage tables of one job, deleted at its end; a result that is read later is written by ``stage``.

    >>> with Stages() as stages:
    ...     step = stages.write(df, "step")
    ...     result = stage(step.groupBy("k").count(), "result")
    """

    def __init__(self) -> None:
        self.own: list[DataFrame] = []

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *_) -> None:
        for table in self.own:
            discard(table.sparkSession, table.stage_path)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """A stage table that is deleted when the job ends."""
        self.own.append(stage(df, name))
        return self.own[-1]

    def drop(self, table: DataFrame) -> None:
        """Delete a stage table before the job ends."""
        self.own = [other for other in self.own if other is not table]
        discard(table.sparkSession, table.stage_path)
