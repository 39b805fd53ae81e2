"""Field-level decisions, work planning, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.functions import text as T

DECISION = "array<struct<field:string,value:string,confidence:double,reason:string,evidence:struct<adapter:string,url:string,sha256:string>>>"


def missing_fields(fields: Column, targets: list[str], provided: list[str] | None = None) -> Column:
    """Target fields, in order, that are blank and that the adapter can provide."""
    names = F.array(*[F.lit(t) for t in targets if provided is None or t in provided])
    return F.filter(names, lambda n: ~T.filled(F.element_at(fields, n)))


def planned(entries: DataFrame, missing: Column, group: str, order: list[Column], n: int | None = None, overwrite: bool = False) -> DataFrame:
    """Entries with missing_fields that have any, the first `n` of each group."""
    out = entries.withColumn("missing_fields", missing)
    if not overwrite:
        out = out.where(F.size("missing_fields") > 0)
    if n is not None:
        out = out.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_n") <= n).drop("_n")
    return out


def reason(field: Column, old: Column, new: Column, url: Column, domains: list[str], protected: list[str], overwrite: bool, least_words: int = 25) -> Column:
    """Why a proposed value is not taken; null if it is.

    In this order: empty, domain not allowed, short abstract, same text, protected field, not overwritten. A url on the same host may be repaired.
    """
    repair = (field == "url") & T.same_host(old, new)
    return (
        F.when(~T.filled(new), "empty")
        .when(~T.host_in(T.host(url), domains), "domain_not_allowed")
        .when((field == "abstract") & (T.word_count(new) < least_words), "short_abstract")
        .when(T.filled(old) & T.equivalent(old, new), "equivalent")
        .when(T.filled(old) & field.isin(*protected) & ~repair, "protected_mismatch")
        .when(T.filled(old) & F.lit(not overwrite) & ~repair, "not_overwritten")
    )


def decisions(entries: DataFrame, keys: list[str], records: DataFrame, targets: list[str], domains: list[str], protected: list[str], overwrite: bool = False) -> DataFrame:
    """(keys, status, applied, skipped, reasons) of entries (keys, fields) and their source records (keys, adapter, source_url, fields).

    The target fields are laid out as an array in the row, decided, and gathered again without a shuffle; the join on the keys is the only exchange.
    """
    met = entries.join(records.select(*keys, "adapter", "source_url", F.col("fields").alias("new")), keys, "left")
    one = [F.struct(F.lit(t).alias("field"), F.col("new")[t].alias("value"), reason(F.lit(t), F.col("fields")[t], F.col("new")[t], F.col("source_url"), domains, protected, overwrite).alias("reason")) for t in targets]
    out = met.withColumn("_d", F.array(*one))
    applied = F.filter("_d", lambda d: d["reason"].isNull())
    status = F.when(F.col("new").isNull(), "unresolved").when(F.size(applied) > 0, "planned_update").otherwise("skipped")
    skipped = F.filter("_d", lambda d: d["reason"].isNotNull())
    proposals = F.transform(applied, lambda d: F.struct(d["field"].alias("field"), d["value"].alias("value"), F.lit(1.0).alias("confidence"), F.lit("source").alias("reason"), F.struct(F.col("adapter"), F.col("source_url").alias("url"), F.sha2(d["value"], 256).alias("sha256")).alias("evidence")))
    return out.select(*keys, status.alias("status"), "adapter", F.transform(applied, lambda d: d["field"]).alias("applied"), F.transform(skipped, lambda d: d["field"]).alias("skipped"), F.transform(skipped, lambda d: d["reason"]).alias("reasons"), proposals.alias("proposals"))


def merged(rows: DataFrame, key: str, order: Column, values: list[str], conflicting: list[str]) -> DataFrame:
    """One row for each key: the first filled value of each column in the given order, and conflict if a column of `conflicting` has two."""
    first = [F.min_by(F.col(v), F.when(T.present(F.col(v).cast("string")), order)).alias(v) for v in values]
    clash = F.lit(False)
    for c in conflicting:
        clash = clash | (F.countDistinct(F.nullif(F.col(c).cast("string"), F.lit(""))) > 1)
    return rows.groupBy(key).agg(*first, clash.alias("conflict"))


def merged_record(existing: Column, overrides: Column, extra: Column) -> Column:
    """A field map: overrides replace, extra fields only fill, blanks go."""
    fill = F.map_filter(extra, lambda k, v: ~F.map_contains_key(existing, k) & ~F.map_contains_key(overrides, k))
    kept = F.map_filter(existing, lambda k, v: ~F.map_contains_key(overrides, k))
    return F.map_filter(F.map_concat(kept, overrides, fill), lambda k, v: T.filled(v))


def ordered_union(a: Column, b: Column) -> Column:
    """Topics of both, in the order first seen."""
    return F.array_distinct(F.concat(a, b))


def chosen_adapter(hint: Column, supports: list[tuple[str, Column]]) -> Column:
    """The hinted adapter if it can, else the first that can."""
    hinted, first = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, able in reversed(supports):
        hinted = F.when((hint == name) & able, name).otherwise(hinted)
        first = F.when(able, name).otherwise(first)
    return F.coalesce(hinted, first)
