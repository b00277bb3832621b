"""One text file of rows in order, written and hashed by executors.

The order is cut into ranges, each written by a task as a numbered part. The file
system puts the parts together where it can (``concat`` of a distributed one). In
a shared folder of the ``file`` scheme each part is copied to its place in the file by
a task of its own; elsewhere one task copies their lines in order. The hash of a byte
sequence is sequential by nature: one task reads the file's lines as a stream,
sorted on disk beyond its memory. The driver sees names of parts and the digest.
"""

from __future__ import annotations

import hashlib
import os
import shutil
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..errors import ExportError
from .shared import file_system

#: Lines to a range.
RANGE = 1_000_000


def _parts(spark: SparkSession, folder: str) -> list[str]:
    """The files of a folder that a text writer has made, in the order of their tasks."""
    system, there = file_system(spark, folder)
    names = [status.getPath() for status in system.listStatus(there)]
    return [p.toString() for p in sorted((p for p in names if p.getName().startswith("part-")), key=lambda p: p.getName())]


def lines_in_order(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``at, data``: the lines of files as bytes, all in one task, in the order of the files' names and of their places."""
    rows = spark.read.option("lineSep", "\n").text(paths)
    at = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row"))
    placed = rows.select(at.alias("at"), F.col("value").cast("binary").alias("data"), F.col("_metadata.file_size").alias("size"))
    return placed.coalesce(1).sortWithinPartitions("at")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256, bytes and lines of what arrives in order; whether the last line ends with a line feed tells the file's size."""
    digest, n_bytes, n_lines, size = hashlib.sha256(), 0, 0, 0
    for batch in batches:
        for data, whole in zip(batch.column("data").to_pylist(), batch.column("size").to_pylist(), strict=True):
            if n_lines:
                digest.update(b"\n")
            digest.update(data)
            n_bytes += len(data) + 1
            n_lines, size = n_lines + 1, whole
    if n_lines and size == n_bytes:
        digest.update(b"\n")
    yield pa.RecordBatch.from_pydict({"sha256": [digest.hexdigest()], "n_bytes": [size], "n_lines": [n_lines]}, pa.schema([("sha256", pa.string()), ("n_bytes", pa.int64()), ("n_lines", pa.int64())]))


def digest_of_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``sha256, n_bytes, n_lines`` of one text file."""
    return lines_in_order(spark, path).select("data", "size").mapInArrow(_digest, "sha256 string, n_bytes long, n_lines long")


def size_of_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row: ``n_bytes, n_lines`` of one text file, read in its splits."""
    rows = spark.read.option("lineSep", "\n").text(path).select(F.col("_metadata.file_size").alias("size"))
    return rows.agg(F.coalesce(F.max("size"), F.lit(0)).alias("n_bytes"), F.count("*").alias("n_lines"))


def _local(path: str) -> str:
    """The name of a file of the ``file`` scheme."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def _into(target: str):
    """A ``mapInArrow`` body: copies parts to their places in a file, and tells how many bytes."""

    def body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copied = 0
            for part, at in zip(batch.column("part").to_pylist(), batch.column("at").to_pylist(), strict=True):
                with open(part, "rb") as source, open(target, "r+b") as file:
                    file.seek(at)
                    shutil.copyfileobj(source, file, 1 << 20)
                    copied += file.tell() - at
            yield pa.RecordBatch.from_pydict({"copied": [copied]}, pa.schema([("copied", pa.int64())]))

    return body


def _placed(spark: SparkSession, parts: list[str], path: str) -> bool:
    """Copy all parts to their places in one file, a task each; whether the file system is one of shared names."""
    system, there = file_system(spark, path)
    if system.getScheme() != "file":
        return False
    sizes = [file_system(spark, part)[0].getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(part)).getLen() for part in parts]
    places = [0, *accumulate(sizes)][:-1]
    target = _local(path)
    os.makedirs(os.path.dirname(target) or ".", exist_ok=True)
    open(target, "wb").close()
    rows = spark.createDataFrame(list(zip(map(_local, parts), places, strict=True)), "part string, at long")
    copied = rows.repartition(min(len(parts), 400)).mapInArrow(_into(target), "copied long").agg(F.sum("copied")).first()[0]
    if copied != sum(sizes) or os.path.getsize(target) != sum(sizes):
        raise ExportError("cannot write", path=path, error="the parts are not all in the file")
    return True


def _moved(spark: SparkSession, part: str, path: str) -> None:
    system, target = file_system(spark, path)
    if target.getParent() is not None:
        system.mkdirs(target.getParent())
    system.delete(target, False)
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(part), target):
        raise ExportError("cannot write", path=path, error="the file system does not move the parts there")
    # A local file's check sums would fail it once anything else edits it.
    system.delete(spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.crc"), False)


def _joined(spark: SparkSession, parts: list[str]) -> bool:
    """Append all parts to the first, by the file system alone; whether it can."""
    if len(parts) == 1:
        return True
    system, first = file_system(spark, parts[0])
    rest = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(parts) - 1)
    for i, part in enumerate(parts[1:]):
        rest[i] = spark._jvm.org.apache.hadoop.fs.Path(part)
    try:
        system.concat(first, rest)
    except (Py4JJavaError, PySparkException):
        return False
    return True


def write_lines(frame: DataFrame, line: Column, path: str, *order: Column | str, lines: int = RANGE, most: int = 10_000) -> None:
    """``line`` of all rows as one file at ``path``, in ``order`` or as the rows lie, a line feed after each.

    Lines hold no line feed; they may be binary, and are written as they are.
    Parts are of some ``lines``, or larger if they would be more than ``most``.
    """
    spark = frame.sparkSession
    folder = f"{path}.parts"
    try:
        rows = frame
        if order:
            ranges = max(1, min(most, -(-frame.count() // lines)))
            rows = frame.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        rows.select(line.cast("string").alias("value")).write.mode("overwrite").option("lineSep", "\n").text(folder)
        parts = _parts(spark, folder)
        if not parts:
            spark.createDataFrame([], "value string").coalesce(1).write.mode("overwrite").text(folder)
            parts = _parts(spark, folder)
        if parts and not _joined(spark, parts):
            copied = f"{path}.copied"
            if _placed(spark, parts, copied):
                _moved(spark, copied, path)
                file_system(spark, folder)[0].delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)
                return
            lines_in_order(spark, folder).select(F.col("data").cast("string").alias("value")).write.mode("overwrite").option("lineSep", "\n").text(copied)
            _moved(spark, _parts(spark, copied)[0], path)
            file_system(spark, copied)[0].delete(spark._jvm.org.apache.hadoop.fs.Path(copied), True)
        elif parts:
            _moved(spark, parts[0], path)
        else:
            system, target = file_system(spark, path)
            system.create(target, True).close()
        file_system(spark, folder)[0].delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)
    except (Py4JJavaError, PySparkException, OSError) as error:
        raise ExportError("cannot write", path=path, error=str(error)[:500]) from error
