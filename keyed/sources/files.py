"""Small file helpers on Hadoop's FileSystem, so that table records work on any store Spark can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_root(spark: SparkSession) -> str:
    """A folder of this application inside the shared folder the cluster names in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="keyed-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/keyed-{spark.sparkContext.applicationId}"


def resolve(prefix: str | None, name: str) -> str:
    """Relative names get the prefix; absolute paths and URIs are used as they are."""
    if not prefix or name.startswith("/") or "://" in name:
        return name
    return f"{prefix.rstrip('/')}/{name}"


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _open(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _open(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def bytes_under(spark: SparkSession, paths: list[str]) -> int:
    total = 0
    for path in paths:
        fs, p = _open(spark, path)
        total += fs.getContentSummary(p).getLength()
    return total


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _open(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Write under a temporary name, then rename: readers see the whole text or nothing."""
    fs, target = _open(spark, path)
    temp = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(temp, False)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if fs.exists(target) or not fs.rename(temp, target):
        raise RuntimeError(f"another writer has already published {path}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)
