"""Every line has its place in reading order."""

from __future__ import annotations

import duckdb
from pyspark.sql import functions as F

from folioworks.functions import ids
from folioworks.operators import lines as L
from folioworks.plans import catalog


def test_every_line_has_its_place(spark):
    folder = "/root/testdata/sf0.001"
    database = duckdb.connect()
    for name in ("orders", "lineitem"):
        database.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    due = database.execute(catalog.ORACLES["reading_order"]).fetchall()
    got = [tuple(r) for r in catalog.QUERIES["reading_order"](spark, folder).collect()]
    assert len(got) > 200 and sorted(r[2] for r in got) == list(range(1, len(got) + 1))
    assert sorted(got) == sorted(due)
    first = [tuple(r) for r in catalog.QUERIES["reading_order_first"](spark, folder).collect()]
    assert sorted(first) == sorted(r for r in got if r[2] <= 200)


def test_places_follow_the_sort(spark):
    rows = [(p, i, f"{p}:{k}") for k, (p, i) in enumerate([("f10r", 2), ("f10r", 1), ("f2v", 1), ("odd", 1), ("f85v3", 1), ("f85v1", 4), ("f2r", 1), ("f2r", 1), ("another", 7), (None, 1)])]
    frame = spark.createDataFrame(rows, "page_id string, line_index int, line_id string").repartition(3)
    order = [r.line_id for r in frame.orderBy(ids.reading_order(F.col("page_id"), F.col("line_index")), "line_id").collect()]
    assert [r.line_id for r in L.with_places(frame, "line_id").orderBy("place").collect()] == order
