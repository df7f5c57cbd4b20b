"""Session-level helpers: the shared scratch folder and folder listing."""

from __future__ import annotations

import tempfile
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

SHARED_DIR_SETTING = "spark.checkpoint.dir"

_local_base: dict[str, str] = {}


def is_local(spark: SparkSession) -> bool:
    """True when driver and executors share one machine."""
    return spark.conf.get("spark.master", "local").startswith("local")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder the session shares between driver and executors.

    Only a local session without the setting falls back to a temporary folder;
    on a cluster a machine-local folder would lose data with its executor.
    """
    base = spark.conf.get(SHARED_DIR_SETTING, None)
    if not base:
        if not is_local(spark):
            raise RuntimeError(f"set {SHARED_DIR_SETTING} to a folder every executor can reach")
        base = _local_base.setdefault("dir", "") or tempfile.mkdtemp(prefix="docferry-")
        _local_base["dir"] = base
    return f"{base.rstrip('/')}/docferry/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str, files: int | None = None) -> tuple[DataFrame, str]:
    """Cut lineage: write ``df`` as a parquet table in the shared folder (at most ``files`` of them), read it back."""
    path = scratch_dir(df.sparkSession, label)
    (df if files is None else df.coalesce(files)).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, hidden ones left out, sorted; works on any Hadoop file system."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(n for n in names if not n.startswith((".", "_")))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _file_system(spark, source)
    if not fs.rename(source_path, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def make_dir(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)


def create_new(spark: SparkSession, path: str) -> bool:
    """Create an empty file unless it is there; of several drivers that try at once, one gets True.

    As atomic as the file system: HDFS and local folders are, some object stores are not.
    """
    fs, target = _file_system(spark, path)
    fs.mkdirs(target.getParent())
    try:
        if fs.getUri().getScheme() == "file":
            # Hadoop's local file system looks first and creates then; the system call does both at once.
            files, attributes = spark._jvm.java.nio.file.Files, spark._jvm.java.nio.file.attribute.FileAttribute
            local = spark._jvm.java.io.File(fs.makeQualified(target).toUri().getPath()).toPath()
            files.createFile(local, spark.sparkContext._gateway.new_array(attributes, 0))
        else:
            fs.create(target, False).close()
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def seconds_since_touched(spark: SparkSession, path: str) -> float:
    fs, target = _file_system(spark, path)
    return time.time() - fs.getFileStatus(target).getModificationTime() / 1000


def touch(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.setTimes(target, int(time.time() * 1000), -1)
