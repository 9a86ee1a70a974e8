"""Structured Streaming forms: windowed counts, late data, duplicates, ingestion, and drift over a sliding look-back."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from skein.operators.relational import shared_dir


def parquet_stream(spark: SparkSession, path: str, per_trigger: int | None = None) -> DataFrame:
    """A file stream over a parquet directory or a single file."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    local = path.removeprefix("file://")
    # a file stream reads directories or patterns: a single file is given as a pattern that only it matches
    df = reader.parquet(f"{os.path.dirname(path)}/{os.path.basename(path)[:-1]}[{path[-1]}]" if os.path.isfile(local) else path)
    # event time needs instants: local times are read in the session's zone
    return df.select(*[F.col(c).cast("timestamp").alias(c) if kind == "timestamp_ntz" else F.col(c) for c, kind in df.dtypes])


def run_now(df: DataFrame, name: str, mode: str, checkpoint: str | None = None) -> DataFrame:
    """Process what is there and return the result: every trigger's rows are written to the shared folder, nothing is held by the driver.

    In complete mode the last trigger's rows are the result, in the others those of all triggers.
    """
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}"

    def one(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/rows/epoch={0 if mode == 'complete' else epoch}")

    writer = df.writeStream.outputMode(mode).foreachBatch(one).option("checkpointLocation", checkpoint or f"{path}/checkpoint").trigger(availableNow=True)
    writer.start().awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")


def tumbling(events: DataFrame, time: str = "ts", width: str = "1 hour", late: str = "10 minutes", key: str = "event_type") -> DataFrame:
    """Counts and sums per window and key."""
    w = events.withWatermark(time, late).groupBy(F.window(time, width), key)
    return w.agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("window_start"), key, "n", "total")


def sliding(events: DataFrame, time: str = "ts", width: str = "7 days", step: str = "1 day", late: str = "1 hour") -> DataFrame:
    w = events.withWatermark(time, late).groupBy(F.window(time, width, step))
    return w.agg(F.count("*").alias("n"), F.avg("value").alias("mean")).select(F.col("window.start").alias("window_start"), "n", "mean")


def sessions(events: DataFrame, time: str = "ts", key: str = "user_id", gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    df = events.withWatermark(time, late) if events.isStreaming else events
    s = df.groupBy(F.session_window(time, gap), key).agg(F.count("*").alias("n"))
    return s.select(key, F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), "n")


def without_repeats(events: DataFrame, keys: list[str], time: str = "ts", late: str = "1 hour") -> DataFrame:
    """Rows whose key was not seen within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def running_totals(events: DataFrame, key: str = "user_id", value: str = "value") -> DataFrame:
    """A custom stateful operator: events and total of each key so far, emitted with every batch."""

    def update(k: tuple, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total = state.get if state.exists else (0, 0.0)
        for pdf in pdfs:
            n, total = n + len(pdf), total + float(pdf[value].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [k[0]], "n": [n], "total": [total]})

    kind = events.schema[key].dataType.simpleString()
    return events.select(key, value).groupBy(key).applyInPandasWithState(update, f"{key} {kind}, n long, total double", "n long, total double", "update", GroupStateTimeout.NoTimeout)


def ingest(stream: DataFrame, transform, path: str, checkpoint: str):
    """Run a batch transform over every micro-batch and keep its rows; the checkpoint makes it resume where it stopped."""

    def one(batch: DataFrame, epoch: int) -> None:
        # one directory per epoch: a batch that runs again after a failure replaces its own rows
        transform(batch).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
