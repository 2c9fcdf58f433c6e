"""Which paths exist, on whatever file system Spark reads them from."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path``, which may be a glob pattern, names anything."""
    files, hadoop_path = _file_system(spark, path)
    return bool(files.globStatus(hadoop_path))


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file at ``path``."""
    files, hadoop_path = _file_system(spark, path)
    files.create(hadoop_path, True).close()


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder; ``target`` must not exist."""
    files, hadoop_path = _file_system(spark, path)
    target_path = _file_system(spark, target)[1]
    if files.exists(target_path) or not files.rename(hadoop_path, target_path):
        raise OSError(f"cannot move {path} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    files, hadoop_path = _file_system(spark, path)
    if files.exists(hadoop_path) and not files.delete(hadoop_path, True):
        raise OSError(f"cannot delete {path}")


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path``, in one listing; none when it is missing."""
    files, hadoop_path = _file_system(spark, path)
    if not files.exists(hadoop_path):
        return []
    return [s.getPath().getName() for s in files.listStatus(hadoop_path) if s.isFile()]


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none when it is missing."""
    files, hadoop_path = _file_system(spark, path)
    if not files.exists(hadoop_path):
        return []
    return [s.getPath().getName() for s in files.listStatus(hadoop_path) if s.isDirectory()]
