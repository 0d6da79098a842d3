"""Named files through Spark's own file systems, so any path that Spark reads works."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    fs, place = _at(spark, path)
    fs.delete(place, True)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, sorted."""
    fs, place = _at(spark, pattern)
    return sorted(x.getPath().toString() for x in fs.globStatus(place) or [])


def _gone_at_exit(spark: SparkSession, path: str) -> None:
    """The driver's JVM deletes the folder when it ends, a stopped session or not."""
    fs, place = _at(spark, path)
    fs.mkdirs(place)
    fs.deleteOnExit(place)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one where none is set, as in tests."""
    context = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not found:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="weftline-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(found)
        _gone_at_exit(spark, context.getCheckpointDir())  # a folder of this application in it
    return found.rstrip("/")


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive executors, and go when dropped or when the driver ends."""

    def __init__(self, spark: SparkSession):
        self.spark, self.root = spark, f"{shared_dir(spark)}/weftline-{uuid.uuid4().hex}"
        _gone_at_exit(spark, self.root)

    def put(self, name: str, df: DataFrame, codec: str = "snappy") -> DataFrame:
        """The table as read back. Shuffle files of its making go at once, not when the driver collects garbage: nothing reads them again."""
        path, conf = f"{self.root}/{name}", self.spark.conf
        before = conf.get(_CLEANUP, "false")
        conf.set(_CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", codec).parquet(path)
        finally:
            conf.set(_CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str = "") -> None:
        delete(self.spark, f"{self.root}/{name}" if name else self.root)


def joined(spark: SparkSession, parts: list[str], path: str, head: str = "") -> None:
    """One file of several, in their order; bytes go through the driver, never held there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, place = _at(spark, path)
    out = fs.create(place, True)
    try:
        out.write(bytearray(head.encode()))
        for part in parts:
            source, at = _at(spark, part)
            lines = source.open(at)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(lines, out, conf, False)
            finally:
                lines.close()
    finally:
        out.close()


def write_text(lines: DataFrame, path: str, header: str | None = None) -> None:
    """The file ``path``: a header, if any, and the lines (value) in the order of their partitions."""
    spark, parts = lines.sparkSession, f"{path}.{uuid.uuid4().hex}"
    lines.write.text(parts)
    try:
        joined(spark, listed(spark, f"{parts}/part-*"), path, "" if header is None else header + "\n")
    finally:
        delete(spark, parts)


def visible(spark: SparkSession, path: str) -> str:
    """The path, or a copy in the shared folder if its name is one that Spark skips."""
    name = path.rsplit("/", 1)[-1]
    if not name.startswith((".", "_")):
        return path
    copy = f"{shared_dir(spark)}/copy-{uuid.uuid4().hex}/{name.lstrip('._')}"
    joined(spark, [path], copy)
    return copy
