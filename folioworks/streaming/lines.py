"""The text operators over streams: the same columns, counts by event-time window.

Cleaning and checks of a line need no state, so they run on a stream as they do
on a table. Counts are windowed aggregates with a watermark, so state is bounded
by the window and the lateness allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import charset, text


def cleaned(lines: DataFrame, raw: str = "text") -> DataFrame:
    """``lines`` with clean text, flags and counts; stateless."""
    checked = charset.checked_text(F.col("text_clean"))
    flagged = lines.withColumn("text_clean", text.clean_for_analysis(F.col(raw)))
    return flagged.withColumns({
        "has_uncertain": text.is_uncertain(F.col(raw)),
        "has_illegible": text.is_illegible(F.col(raw)),
        "char_count": charset.letter_count(checked),
        "word_count": charset.word_count(checked),
        "is_clean": charset.is_clean(F.col("text_clean")),
    })


def windowed_counts(rows: DataFrame, time: str, *by: str, window: str = "1 hour", late: str = "10 minutes", value: str | None = None) -> DataFrame:
    """Rows (and the sum of a value) by tumbling window and keys; later rows than ``late`` are left out."""
    sums = [F.count("*").alias("n")] + ([F.sum(value).alias("total")] if value else [])
    return rows.withWatermark(time, late).groupBy(F.window(time, window).alias("window"), *by).agg(*sums).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n", *(["total"] if value else []))


def once_per_id(rows: DataFrame, key: str, time: str, late: str = "10 minutes") -> DataFrame:
    """Rows whose key was not seen within the watermark."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def write_batches(rows: DataFrame, path: str, checkpoint: str, **options):
    """Append the stream's rows to a Parquet table, once each."""
    return rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append").options(**options).start(path)
