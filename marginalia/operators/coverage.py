"""Coverage of fields by file, group and in all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions import text as T


def cube(rows: DataFrame, file: str, group: str, fields: dict[str, Column]) -> DataFrame:
    """level, name, n, and for each field the count of rows that have it and their percentage: one pass for files, groups and the total."""
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(k) for k, c in fields.items()]
    sets = rows.groupingSets([[F.col(file)], [F.col(group)], []], F.col(file), F.col(group)).agg(F.grouping_id().alias("__g"), F.count("*").alias("n"), *counts)
    level = F.when(F.col("__g") == 1, "file").when(F.col("__g") == 2, "group").otherwise("total")
    return sets.select(level.alias("level"), F.coalesce(F.col(file).cast("string"), F.col(group).cast("string"), F.lit("")).alias("name"), "n", *fields, *[T.percent(F.col(k), F.col("n"), 2).alias(f"{k}_pct") for k in fields])


def best_and_worst(rows: DataFrame, value: str, tie: str, n: int) -> DataFrame:
    """The first and the last `n` rows by a value: adds side. Both are top-k sorts, not full ones."""
    return rows.orderBy(F.desc(value), tie).limit(n).withColumn("side", F.lit("best")).unionByName(rows.orderBy(F.asc(value), tie).limit(n).withColumn("side", F.lit("worst")))


def canonical_order(names: Column, first: list[str]) -> Column:
    """Field names: the listed ones in that order, then the others sorted."""
    head = F.filter(F.array(*[F.lit(n) for n in first]), lambda n: F.array_contains(names, n))
    return F.concat(head, F.array_sort(F.array_except(names, F.array(*[F.lit(n) for n in first]))))
