"""Set reconciliation between a source and what is held."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def classify(source: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """(key, class) of distinct keys: matched, missing (only in the source), extra (only held)."""
    s = source.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_s", F.lit(True))
    h = held.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_h", F.lit(True))
    both = s.join(h, key, "full_outer")
    return both.select(key, F.when(F.col("_s") & F.col("_h"), "matched").when(F.col("_s"), "missing").otherwise("extra").alias("class"))


def missing_in_order(rows: DataFrame, other: DataFrame, key: str, order: str) -> DataFrame:
    """Rows whose key the other side lacks; their order is a column."""
    return rows.join(other.select(key), key, "left_anti").orderBy(order)


def marked(rows: DataFrame, other: DataFrame, key: str, name: str = "matched") -> DataFrame:
    """rows with a flag that tells whether the other side has their key: a mark join as one left join on distinct keys."""
    return rows.join(other.select(key).distinct().withColumn(name, F.lit(True)), key, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def any_key(files: DataFrame, entries: DataFrame, path: str, candidates: list[str]) -> DataFrame:
    """files with matched: some entry names their path in any of the candidate columns.

    The alternatives become rows of one column, so the existence test stays an equi-join.
    """
    named = entries.select(F.explode(F.array_compact(F.array(*candidates))).alias(path))
    return marked(files, named, path)


def split_by_reason(rows: DataFrame, reasons: list[tuple[Column, str]], name: str = "reason") -> DataFrame:
    """Adds the first reason that holds, null for rows that are ready."""
    out = F.lit(None).cast("string")
    for condition, reason in reversed(reasons):
        out = F.when(condition, reason).otherwise(out)
    return rows.withColumn(name, out)


def canonical(rows: DataFrame, key: str, target: str) -> DataFrame:
    """key, target: the only distinct target, empty if there are several."""
    found = rows.where(F.col(target).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(target)).alias("_t"))
    return found.select(key, F.when(F.size("_t") == 1, F.get("_t", F.lit(0))).otherwise("").alias(target))


def deduplicated_source(records: DataFrame, key: str, order: list[Column], valid: Column) -> DataFrame:
    """Valid records, the first of each key in the given order."""
    w = Window.partitionBy(key).orderBy(*order)
    return records.where(valid).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def anti(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(other.select(*keys).distinct(), keys, "left_anti")
