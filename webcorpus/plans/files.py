"""The few file-system calls the stored index needs, on any Hadoop file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def length(spark: SparkSession, path: str) -> int:
    """Bytes of a file; 0 where there is none."""
    fs, jpath = _fs(spark, path)
    return fs.getFileStatus(jpath).getLen() if fs.exists(jpath) else 0


def children(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def remove(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.delete(jpath, True)


def qualify(spark: SparkSession, base: str, paths: list[str]) -> list[str]:
    """Full paths as Spark reports them for the files it reads: relative ones are below ``base``,
    absolute ones without a scheme on the default file system."""

    def full(path: str) -> str:
        fs, jpath = _fs(spark, path)
        return fs.makeQualified(jpath).toString().rstrip("/")

    below = f"{full(base)}/" if base else ""
    root = full("/")

    def one(path: str) -> str:
        if path.startswith("/"):
            return root + path
        if path.startswith("file://"):
            return full(path)
        return path if ":/" in path else below + path

    return [one(path) for path in paths]
