"""Folders that the driver and all executors share, and files in them."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Byte code of a method beyond which HotSpot does not compile it.
HUGE = 8000


def new_folder(spark: SparkSession, name: str = "files") -> str:
    """The name of a folder that is not there yet, in the folder of ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="folioworks-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path, as the JVM has them."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def stored(frame: DataFrame, name: str = "table") -> DataFrame:
    """The rows, written once to the shared folder."""
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def compiled(frame: DataFrame) -> DataFrame:
    """``frame``, whose session now gives up generated methods that are too long for the JVM to compile.

    Longer ones, of many expressions over text, would be interpreted, which takes
    several times as long as the same expressions in methods of their own. The
    setting is read when the frame runs, so it stays.
    """
    key, conf = "spark.sql.codegen.hugeMethodLimit", frame.sparkSession.conf
    if int(conf.get(key, "65535")) > HUGE:
        conf.set(key, HUGE)
    return frame


@contextmanager
def splits_of(spark: SparkSession, n_bytes: int) -> Iterator[None]:
    """Files are read in splits of so many bytes, by what runs in here."""
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, n_bytes)
    try:
        yield
    finally:
        spark.conf.set(key, before)
