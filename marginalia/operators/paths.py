"""Files and paths: fingerprints, moves, export plans, staleness, and small tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import text as T

MIB = 1 << 20


def quick_md5(content: Column, size: Column) -> Column:
    """MD5 of the whole content up to 2 MiB, else of its first and last MiB."""
    ends = F.concat(F.substring(content, 1, MIB), F.substring(content, -MIB, MIB))
    return F.md5(F.when(size > 2 * MIB, ends).otherwise(content))


def migrated(rows: DataFrame, path: str, moves: dict[str, str]) -> DataFrame:
    """rows with paths rewritten by a constant table; adds unmapped: an old-style path that the table lacks."""
    new = F.col(path)
    for old, to in moves.items():
        new = F.when(F.col(path) == old, to).otherwise(new)
    return rows.withColumn("unmapped", F.col(path).like("by-%") & ~F.col(path).isin(*moves)).withColumn(path, new)


def export_plan(rows: DataFrame, source: str, order: list[Column]) -> DataFrame:
    """Adds target: each source file's name, numbered from the second on where several have it."""
    name = F.element_at(F.split(source, "/"), -1)
    n = F.row_number().over(Window.partitionBy("_name").orderBy(*order))
    stem, suffix = F.regexp_extract("_name", r"^(.*?)(\.[^.]*)?$", 1), F.regexp_extract("_name", r"^(.*?)(\.[^.]*)?$", 2)
    out = rows.withColumn("_name", name).withColumn("_n", n)
    return out.withColumn("target", F.when(F.col("_n") == 1, F.col("_name")).otherwise(F.concat(stem, F.lit("_"), (F.col("_n") - 1).cast("string"), suffix))).drop("_name", "_n")


def scanned(state: DataFrame, scan: DataFrame, key: str, now: Column, seconds: int = 60) -> DataFrame:
    """A table of files after a scan: key, seen_at, status. What the scan lacks and was not seen for `seconds` is deleted."""
    new = scan.select(key).distinct().withColumn("_new", F.lit(True))
    both = state.select(key, "seen_at", "status").join(new, key, "full_outer")
    gone = F.col("_new").isNull() & (F.unix_timestamp(now) - F.unix_timestamp("seen_at") > seconds)
    return both.select(key, F.when(F.col("_new"), now).otherwise(F.col("seen_at")).alias("seen_at"), F.when(F.col("_new"), "present").when(gone, "deleted").otherwise(F.col("status")).alias("status"))


def venue_and_year(path: Column) -> tuple[Column, Column]:
    """Of `.../<venue>/<year>.<suffix>`; empty and null where the path has another shape."""
    pattern = r"([a-z0-9-]+)/((?:19|20)\d\d)\.[a-z]+$"
    return F.regexp_extract(path, pattern, 1), F.nullif(F.regexp_extract(path, pattern, 2), F.lit("")).cast("int")


def targets(tokens: DataFrame, column: str, first: int = 1900, last: int = 2100) -> DataFrame:
    """`venue:year` tokens as venue, year, valid."""
    venue, year = F.lower(F.trim(F.split_part(column, F.lit(":"), F.lit(1)))), F.split_part(column, F.lit(":"), F.lit(2)).try_cast("int")
    return tokens.select(column, venue.alias("venue"), year.alias("year"), (T.filled(venue) & F.coalesce(year.between(first, last), F.lit(False))).alias("valid"))


def venue_targets(policies: DataFrame, years: list[int]) -> DataFrame:
    """Venue policies (venue, file_template, params) for each year: the parameters with the year, and the file's path."""
    rows = policies.withColumn("year", F.explode(F.array(*[F.lit(y) for y in years])))
    return rows.select("venue", "year", F.replace("file_template", F.lit("{year}"), F.col("year").cast("string")).alias("file_path"), F.map_concat(F.map_filter("params", lambda k, v: k != "year"), F.create_map(F.lit("year"), F.col("year").cast("string"))).alias("params"))


def distinct_ignoring_case(words: Column) -> Column:
    """Keywords in the order first seen, one of those that differ in case only."""
    lower = F.transform(words, lambda w: F.lower(w))
    return F.filter(words, lambda w, i: F.array_position(lower, F.lower(w)) == i + 1)


def workers(threads: int) -> dict[str, int]:
    """How many documents of each tier to read at once."""
    article = 1 if threads <= 2 else max(2, min(8, threads // 2))
    return {"article": article, "medium": max(1, min(4, article // 2)), "long": max(1, min(2, threads // 12)), "huge": 1}


def tier_plan(threads: int, wanted: dict[str, int] | None = None, seconds: dict[str, float] | None = None) -> dict[str, tuple[int, float]]:
    """Workers and time limit of each tier: wanted workers above 0 count, else the automatic ones; a longer tier never has a shorter limit."""
    auto, wanted = workers(threads), wanted or {}
    seconds = {"article": 1200.0, "medium": 1200.0, "long": 3600.0, "huge": 7200.0} | (seconds or {})
    out, least = {}, 1.0
    for tier in ("article", "medium", "long", "huge"):
        least = max(least, float(seconds[tier]))
        out[tier] = (wanted[tier] if wanted.get(tier, 0) > 0 else auto[tier], least)
    return out | {"unknown": out["medium"]}
