"""Prefix scans over ordered groups of any size: each group is spread over tasks, and only a summary of each part is carried on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.sources import workspace


def _dealt(rows: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """rows, staged, with _part: dealt by ranges of (group, order), so a part's rows of a group come before those of the next part. Ranges come from a
    sample, so what they made is kept rather than made twice."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return workspace.staged(rows.repartitionByRange(parts, *group, *order).withColumn("_part", F.spark_partition_id()), "ranges")


def _with_summary(rows: DataFrame, summary: DataFrame, keys: list[str]) -> DataFrame:
    """rows with the columns of the summary of their (group, part); groups may be null."""
    renamed = summary.withColumnsRenamed({k: f"_k{n}" for n, k in enumerate(keys)})
    on = reduce(Column.__and__, [rows[k].eqNullSafe(renamed[f"_k{n}"]) for n, k in enumerate(keys)])
    return rows.join(renamed, on).drop(*[f"_k{n}" for n in range(len(keys))])


def prefix(rows: DataFrame, group: list[str], order: list[Column], value: Column, aggregate, name: str, own: bool = True) -> DataFrame:
    """rows with the aggregate (F.sum or F.max) of value over the rows of their group before them, and with `own` over themselves too; null if there are none.

    rows have _part as ranked() leaves it: parts of a group follow one another in the order. A part carries on one number.
    """
    keys = [*group, "_part"]
    held = rows.withColumn("_v", value)
    inside = aggregate("_v").over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0 if own else -1))
    parts = held.groupBy(*keys).agg(aggregate("_v").alias("_of"))
    earlier = aggregate("_of").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    both = _with_summary(held.withColumn("_in", inside), parts.select(*keys, earlier.alias("_earlier")), keys)
    total = F.greatest("_in", "_earlier") if aggregate is F.max else F.coalesce(F.col("_in") + F.col("_earlier"), F.col("_in"), F.col("_earlier"))
    return both.select(*rows.columns, total.alias(name))


def ranked(rows: DataFrame, group: list[str], order: list[Column], name: str = "rank", keep_part: bool = False) -> DataFrame:
    """rows, staged, with their rank from 0 in their group; ties are ranked too, in any order. A rank is the one within a part and the rows of the parts before."""
    dealt = _dealt(rows, group, order)
    keys = [*group, "_part"]
    counts = dealt.groupBy(*keys).agg(F.count("*").alias("_c"))
    before = F.coalesce(F.sum("_c").over(Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = dealt.withColumn("_own", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1)
    out = _with_summary(own, counts.select(*keys, before.alias("_before")), keys)
    made = workspace.staged(out.select(*rows.columns, (F.col("_own") + F.col("_before")).alias(name), *(["_part"] if keep_part else [])), "ranked")
    workspace.drop(dealt)
    return made


def paced(rows: DataFrame, group: list[str], order: list[Column], at: Column, interval: Column, name: str = "slot") -> DataFrame:
    """rows, staged, with the slot of each: the later of its arrival and the slot before it in its group plus the interval of that one.

    at and interval: whole numbers of one unit; a null or negative interval counts as 0, a null arrival as no wait of its own. order must begin with the arrival and be
    unique. With P the intervals before a row, slot - P = max of arrival - P over the row and those before it: a sum and a maximum, so a part
    carries on two numbers, and a hot group uses all tasks.
    """
    dealt = _dealt(rows.withColumns({"_at": at.cast("long"), "_wait": F.greatest(F.coalesce(interval.cast("long"), F.lit(0)), F.lit(0))}), group, order)
    keys = [*group, "_part"]
    inside = Window.partitionBy(*keys).orderBy(*order)
    own = dealt.withColumn("_p", F.coalesce(F.sum("_wait").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    own = own.withColumn("_lead", F.col("_at") - F.col("_p"))
    parts = own.groupBy(*keys).agg(F.sum("_wait").alias("_sum"), F.max("_lead").alias("_max"))
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_off", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
    parts = parts.withColumn("_carried", F.max(F.col("_max") - F.col("_off")).over(earlier)).select(*keys, "_off", "_carried")
    led = own.withColumn("_led", F.max("_lead").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    slot = F.col("_off") + F.col("_p") + F.greatest(F.col("_led") - F.col("_off"), F.col("_carried"))
    made = workspace.staged(_with_summary(led, parts, keys).select(*rows.columns, slot.alias(name)), "paced")
    workspace.drop(dealt)
    return made
