"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of text that go to Python at once.
BATCH = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_checkpoints(spark: SparkSession) -> None:
    """Make the context write to the cluster's shared folder.

    The folder comes from ``spark.checkpoint.dir``; only a local session that
    names none gets a folder of its own.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="folioworks-checkpoints-")
    context.setCheckpointDir(folder)


class _Areas(threading.local):
    """Folders written inside the scratch areas that a thread has open, innermost last."""

    def __init__(self):
        self.open: list[list[str]] = []


_AREAS = _Areas()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of whatever file system it is in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores behind it until no column of ``frame`` has it, in whatever case."""
    taken, out = {c.lower() for c in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """An area whose tables are deleted at its end.

    What it yields stores a frame for after the area, in the area around it;
    outside of all areas a table stays until the checkpoint folder is cleared,
    as the frames that read it may be used at any time.
    """
    _AREAS.open.append([])
    outer = len(_AREAS.open) - 2
    try:
        yield lambda frame: _written(frame, outer)[1]
    finally:
        for path in _AREAS.open.pop():
            delete(spark, path)


def _written(frame: DataFrame, area: int) -> tuple[str, DataFrame]:
    spark = frame.sparkSession
    shared_checkpoints(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"
    if area >= 0:
        _AREAS.open[area].append(path)
    frame.write.parquet(path)
    return path, spark.read.schema(frame.schema).parquet(path)


def stored_at(frame: DataFrame) -> tuple[str, DataFrame]:
    """As ``stored``, with the table's path before it."""
    return _written(frame, len(_AREAS.open) - 1)


def stored(frame: DataFrame) -> DataFrame:
    """The rows of ``frame``, written once as a table in the shared checkpoint folder; this cuts its lineage."""
    return stored_at(frame)[1]


#: A key is hot from one in so many of all rows on, and from ``LEAST_HOT`` rows on.
HOT, LEAST_HOT = 4096, 1000


def join_sized(rows: DataFrame, sized: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """``rows`` joined to ``sized``, which has one row a key and in ``n`` how many ``rows`` have that key.

    Keys of more than one in ``HOT`` of the ``total`` rows, of which there are
    less than ``HOT``, are broadcast, so their rows stay where they are; the
    others meet by a shuffle. No key is null.
    """
    limit = max(LEAST_HOT, total // HOT)
    hot = sized.where(F.col(n) > limit)
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    cold = marked.where("_hot is null").select(rows.columns).join(sized.where(F.col(n) <= limit), keys)
    return marked.where("_hot").drop("_hot").unionByName(cold)


def small_batches(frame: DataFrame) -> DataFrame:
    """``frame``, whose session now hands Python a few texts at a time.

    Arrow's default of 10,000 rows to a batch is 30 MB and more of text, kept
    several times over by the JVM and each worker; the rows are read one by one
    anyway.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = frame.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH:
        conf.set(key, BATCH)
    return frame


def map_rows(frame: DataFrame, body: Callable, schema) -> DataFrame:
    """``mapInArrow`` over small batches."""
    return small_batches(frame).mapInArrow(body, schema)


def fold_id(column: str):
    """CRC-32 of an id as text, the basis of every train and test split here."""
    return F.crc32(F.col(column).cast("string"))


def per_row(schema: pa.Schema, function: Callable[..., tuple], *columns: str):
    """A ``mapInArrow`` body that calls ``function`` on each row's ``columns``.

    The function returns one value for each field of ``schema``. Input columns
    that the schema names first are the caller's business: they are passed too.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in columns), strict=True)
            out = [function(*row) for row in rows]
            values = list(zip(*out, strict=True)) if out else [() for _ in schema]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, type=f.type) for v, f in zip(values, schema, strict=True)], schema=schema
            )

    return run
