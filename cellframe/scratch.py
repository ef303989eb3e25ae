"""Where intermediate files go: the cluster's shared folder."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, or where that is unset a folder of the warehouse.

    Both are shared by the driver and the executors; the warehouse path may lie in
    any file system that Spark reads.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark)}/cellframe/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing lazy reads any more."""
    system, target = _file_system(spark, path)
    system.delete(target, True)


def make_dir(spark: SparkSession, path: str) -> None:
    system, target = _file_system(spark, path)
    system.mkdirs(target)


def path_exists(spark: SparkSession, path: str) -> bool:
    system, target = _file_system(spark, path)
    return system.exists(target)


def entries(spark: SparkSession, path: str) -> list[str]:
    """The names right below a folder; none if there is no such folder."""
    system, target = _file_system(spark, path)
    return [f.getPath().getName() for f in system.listStatus(target)] if system.exists(target) else []


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it exists already. Of several callers one is told true."""
    system, target = _file_system(spark, path)
    system.mkdirs(target.getParent())
    if system.getScheme() == "file":  # Hadoop's own check and creation are two steps here
        return spark.sparkContext._jvm.java.io.File(target.toUri().getPath()).createNewFile()
    try:
        system.create(target, False).close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in str(error.java_exception):
            raise
        return False
    return True


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, target = _file_system(spark, path)
    stream = system.create(target, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file; nothing if it has gone meanwhile."""
    system, target = _file_system(spark, path)
    try:
        stream = system.open(target)
    except Py4JJavaError as error:
        if "FileNotFound" not in str(error.java_exception):
            raise
        return ""
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_dir(spark: SparkSession, fresh: str, path: str) -> None:
    """Put a complete folder in the place of another one."""
    system, target = _file_system(spark, path)
    _, source = _file_system(spark, fresh)
    _, aside = _file_system(spark, f"{fresh}-old")
    if system.exists(target) and not system.rename(target, aside):
        # Else the fresh folder would end up inside the old one.
        raise OSError(f"cannot move {path} aside")
    if not system.rename(source, target):
        system.rename(aside, target)
        raise OSError(f"cannot move {fresh} to {path}")
    system.delete(aside, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back; this cuts its lineage."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
