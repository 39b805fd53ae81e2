"""Views over the log of attempts, and consistency of entries and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import text as T


def latest(log: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Each key's columns in its last row: one aggregate, which combines before the shuffle."""
    best = F.max_by(F.struct(*columns), F.struct(*order)).alias("_b")
    return log.groupBy(*keys).agg(best).select(*keys, "_b.*")


def distinct_by_status(log: DataFrame, group: str, key: str, state: str, states: list[str]) -> DataFrame:
    """Distinct keys in all and by status, for each group."""
    return log.groupBy(group).agg(F.countDistinct(key).alias("total"), *[F.countDistinct(F.when(F.col(state) == s, F.col(key))).alias(s) for s in states])


def retry_candidates(log: DataFrame, keys: list[str], order: list[str], before: Column, state: str = "status", at: str = "ts") -> DataFrame:
    """Keys whose last attempt failed before a time."""
    return latest(log, keys, order, [state, at]).where((F.col(state) == "failed") & (F.col(at) < before))


def failure_counts(log: DataFrame, keys: list[str], state: str = "status") -> DataFrame:
    """Failures of each key and the seconds to wait after them."""
    n = F.count_if(F.col(state) == "failed")
    return log.groupBy(*keys).agg(n.alias("failures")).withColumn("backoff", T.backoff(F.col("failures")))


def daily(log: DataFrame, at: str, state: str, states: list[str], days: int) -> DataFrame:
    """Counts of each of the last `days` days that have rows."""
    out = log.groupBy(F.to_date(at).alias("day")).agg(F.count("*").alias("total"), *[F.count_if(F.col(state) == s).alias(s) for s in states])
    return out.orderBy(F.desc("day")).limit(days)


def update_latest(log: DataFrame, keys: list[str], order: list[Column], changes: dict[str, Column]) -> DataFrame:
    """The log with columns changed in each key's last row."""
    last = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1
    return log.withColumn("_last", last).withColumns({c: F.when(F.col("_last"), v).otherwise(F.col(c)) for c, v in changes.items()}).drop("_last")


def never_tried(entries: DataFrame, log: DataFrame, keys: list[str]) -> DataFrame:
    return entries.join(log.select(*keys).distinct(), keys, "left_anti")


def bijection(entries: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """One row: entries, files, matched entries, entries without file, orphaned files, and the score in percent.

    entries and files: one row each a key; matching is a full outer join, so each side moves once.
    """
    e = entries.select(key).withColumn("_e", F.lit(1))
    f = files.select(key).distinct().withColumn("_f", F.lit(1))
    both = e.join(f, key, "full_outer")
    total, matched = F.count("_e"), F.countDistinct(F.when(F.col("_e").isNotNull() & F.col("_f").isNotNull(), F.col(key)))
    return both.agg(
        total.alias("entries"), F.countDistinct(F.when(F.col("_f").isNotNull(), F.col(key))).alias("files"), matched.alias("matched"),
        F.count_if(F.col("_e").isNotNull() & F.col("_f").isNull()).alias("missing_files"), F.count_if(F.col("_e").isNull()).alias("orphaned_files"), T.percent(matched, total, 2).alias("score"),
    )


def upsert(state: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The state after insert-or-replace: of equal keys the new row, of several new rows the last by _ord if they have it."""
    n = rows
    if "_ord" in rows.columns:
        n = rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("_ord")))).where("_n = 1").drop("_n", "_ord")
    return state.join(n.select(*keys), keys, "left_anti").unionByName(n)


def runs(rows: DataFrame, group: str, order: list[str], breaks: Column) -> DataFrame:
    """Islands of consecutive rows where `breaks` is false: group, run, length, first and last of the first order column."""
    w = Window.partitionBy(group).orderBy(*order)
    island = F.sum(F.when(breaks, 1).otherwise(0)).over(w)
    return rows.withColumns({"_run": island, "_b": breaks}).where(~F.col("_b")).groupBy(group, F.col("_run").alias("run")).agg(F.count("*").alias("length"), F.min(order[0]).alias("first"), F.max(order[0]).alias("last"))


def pacing(rows: DataFrame, group: str, order: list[str], seconds: Column) -> DataFrame:
    """Rows that came sooner than `seconds` after the one before in their group; adds wait, the seconds between."""
    at = order[0]
    before = F.lag(at).over(Window.partitionBy(group).orderBy(*order))
    gap = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(before.cast("timestamp"))
    return rows.withColumn("wait", gap / 1e6).where(F.col("wait") < seconds)


def sortedness(rows: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Inversions of value along the order: group, rows, inversions."""
    before = F.lag(value).over(Window.partitionBy(group).orderBy(order))
    return rows.withColumn("_b", before).groupBy(group).agg(F.count("*").alias("n"), F.count_if(F.col("_b") < F.col(value)).alias("inversions"))


def batches(rows: DataFrame, order: list[str], size: int, name: str = "batch") -> DataFrame:
    """Adds batch: consecutive numbers of `size` rows each, in the given (unique) order.

    Rows are dealt into buckets by quantiles of the first order column, which a task evaluated again finds the same, and ranks come from
    each bucket's own and the rows of the buckets before. So no task holds all rows, and only counts by bucket are collected by one.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = order[0]
    cuts = rows.agg(F.percentile_approx(by, [k / parts for k in range(1, parts)], 10000)).first()[0] if parts > 1 else None
    bucket = F.lit(0)
    for c in sorted(set(cuts or [])):
        bucket = bucket + F.when(F.col(by) > F.lit(c), 1).otherwise(0)
    dealt = rows.withColumn("_p", bucket)
    counts = dealt.groupBy("_p").agg(F.count("*").alias("_c"))
    offsets = counts.withColumn("_o", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_c")
    ranked = dealt.withColumn("_i", F.row_number().over(Window.partitionBy("_p").orderBy(*order)) - 1).join(offsets, "_p")
    return ranked.withColumn(name, F.floor((F.col("_i") + F.col("_o")) / size)).drop("_p", "_i", "_o")
