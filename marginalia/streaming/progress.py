"""Progress events as a stream: running totals, windows, streaks of failures, and a keyed state table."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marginalia.sources.versions import Versions

EVENTS = "ts timestamp, file_path string, entry_key string, host string, status string, message string"


def events(spark: SparkSession, folder: str, schema: str = EVENTS, per_trigger: int = 100) -> DataFrame:
    """Appended JSON lines as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).json(folder)


def totals(stream: DataFrame) -> DataFrame:
    """Rows by status so far."""
    return stream.groupBy("status").agg(F.count("*").alias("n"))


def windowed(stream: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by status in windows of event time; what comes later than `late` is dropped by the watermark."""
    return stream.withWatermark("ts", late).groupBy(F.window("ts", width).alias("w"), "status").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "status", "n")


def breakers(stream: DataFrame, limit: int = 3) -> DataFrame:
    """(host, streak, open): consecutive failures of each host so far; open when there are `limit`. One row a host and batch that changed it."""

    def step(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        streak = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values("ts")
        for status in rows["status"]:
            streak = streak + 1 if status == "failed" else 0
        state.update((streak,))
        yield pd.DataFrame({"host": [key[0]], "streak": [streak], "open": [streak >= limit]})

    return stream.groupBy("host").applyInPandasWithState(step, "host string, streak long, open boolean", "streak long", "update", "NoTimeout")


def keep_latest(stream: DataFrame, state_path: str, checkpoint: str, keys: list[str], order: str, fanout: int = 4):
    """Starts a query that keeps each key's last row, by `order`, as a table below `state_path`; read it with latest_state.

    A batch adds one run of its keys, and `fanout` runs of a level become one of the next, with one row a key: a row is written once a level, and disk follows the
    state. The number of the last batch stands in the table's version, so a batch that comes again changes nothing, and one that failed before its version was
    in place left nothing that is read. Readers see the version before or after a batch, and files of the one before stay until the next.
    """

    def merge(batch: DataFrame, number: int) -> None:
        table = Versions(batch.sparkSession, state_path)
        parent, at = table.read()
        if at.get("batch", -1) >= number:
            return
        levels: list[list[str]] = at.get("levels", [])
        schema = at.get("schema") or batch.schema.json()
        run, level = table.written(_last_rows(batch, keys, order), "run"), 0
        while True:
            if len(levels) <= level:
                levels.append([])
            levels[level].append(run)
            if len(levels[level]) < fanout:
                break
            run = table.written(_last_rows(batch.sparkSession.read.parquet(*levels[level]).select(*batch.columns), keys, order), "run")
            levels[level], level = [], level + 1
        table.commit(parent, {"batch": number, "levels": levels, "schema": schema, "keys": keys, "order": order})
        table.vacuum(keep=2)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _last_rows(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*[c for c in rows.columns if c not in keys]), order).alias("r")).select(*keys, "r.*")


def latest_state(spark: SparkSession, state_path: str) -> DataFrame:
    """Each key's last row at the table's latest version."""
    at = Versions(spark, state_path).read()[1]
    schema = StructType.fromJson(json.loads(at["schema"]))
    runs = [r for level in at["levels"] for r in level]
    return _last_rows(spark.read.parquet(*runs).select(*schema.fieldNames()), at["keys"], at["order"])
