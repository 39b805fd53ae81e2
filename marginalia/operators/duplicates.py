"""Duplicates and collisions, by aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import text as T


def multiplicity(rows: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """Groups of equal keys with at least `least` rows: keys, n."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def long_multiplicity(rows: DataFrame, keys: list[str], text: str, least: int = 2) -> DataFrame:
    """multiplicity on `keys` and a long text: rows are counted by the text's two hashes, and only texts that repeat are moved once more."""
    hashed = rows.withColumns({"_h1": F.xxhash64(text), "_h2": F.xxhash64(F.lit(text), text)})
    counted = hashed.groupBy(*keys, "_h1", "_h2").agg(F.count("*").alias("_n")).where(F.col("_n") >= least)
    same = hashed["_h1"] == counted["_h1"]
    for k in ["_h2", *keys]:
        same = same & hashed[k].eqNullSafe(counted[k])
    return hashed.join(counted, same, "left_semi").groupBy(*keys, text).agg(F.count("*").alias("n")).where(F.col("n") >= least)


def global_collisions(rows: DataFrame, key: str, container: str, signature: list[str]) -> DataFrame:
    """Keys in several containers under several signatures: key, containers, signatures, list (sorted, joined)."""
    distinct = rows.select(key, container, F.struct(*signature).alias("_s")).where(F.col(container).isNotNull()).distinct()
    one = distinct.groupBy(key, container).agg(F.collect_set("_s").alias("_s"))
    out = one.groupBy(key).agg(F.count("*").alias("containers"), F.size(F.array_distinct(F.flatten(F.collect_list("_s")))).cast("long").alias("signatures"), F.array_join(F.array_sort(F.collect_list(F.col(container).cast("string"))), ", ").alias("container_list"))
    return out.where("containers > 1 and signatures > 1")


def duplicate_titles(stats: DataFrame) -> DataFrame:
    """Entries of a file with one title and author signature, or title and year if no authors: file_path, title_norm, basis, n, entry_key.

    Titles that many works share don't count, nor groups whose entries all have an identifier of their own.
    """
    names = T.author_signature(F.col("author_raw"), lettered=True)
    rows = stats.where((F.col("title_norm") != "") & ~F.trim("title_norm").isin(*T.GENERIC_TITLES)).withColumn("names", names)
    rows = rows.withColumn("basis", F.when(F.col("names") != "", F.col("names")).when(F.col("year") != "", F.col("year"))).where("basis is not null")
    rows = rows.withColumn("id", F.nullif(F.coalesce(F.nullif("doi", F.lit("")), F.col("url_fp")), F.lit("")))
    out = rows.groupBy("file_path", "title_norm", "basis").agg(F.count("*").alias("n"), F.countDistinct("id").alias("ids"), F.count("id").alias("with_id"), F.min_by("entry_key", "entry_idx").alias("entry_key"))
    return out.where("n > 1 and not (with_id = n and ids = n)").drop("ids", "with_id")


def best_row(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first in the given order, which must be total."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def last_duplicate(entries: DataFrame) -> DataFrame:
    """The entry that a key means in its file: the last one."""
    return best_row(entries, ["file_path", "entry_key"], [F.desc("entry_idx")])


def unambiguous(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, value (null where several values share the key)."""
    return rows.where(T.filled(key)).groupBy(key).agg(F.when(F.countDistinct(value) == 1, F.min(value)).alias(value))


def signatures(entries: DataFrame) -> DataFrame:
    """entry_key, the set of its signatures over all files."""
    f = F.col("fields")
    return entries.groupBy("entry_key").agg(F.collect_set(T.entry_signature(f["year"], f["title"], f["author"])).alias("signatures"))
