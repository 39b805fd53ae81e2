"""Keys of entries: disambiguation, renames and their references."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia.operators.scans import prefix, ranked
from marginalia.sources import workspace


def _bound(taken: DataFrame, bases: DataFrame) -> DataFrame:
    """(base, number, signature) of taken keys (key, signature) in every way in which they are one of the bases and a number."""
    digits = F.length(F.regexp_extract("key", "([0-9]*)$", 1))
    ways = taken.withColumn("_j", F.explode(F.sequence(F.lit(0), F.least(digits, F.lit(9)))))
    number = F.when(F.col("_j") == 0, "0").otherwise(F.expr("right(key, _j)"))
    ways = ways.select(F.expr("left(key, length(key) - _j)").alias("base"), number.alias("_t"), "signature", "_j").where("_j = 0 or _t not like '0%'")
    return ways.select("base", F.col("_t").cast("long").alias("number"), "signature").join(bases, "base", "left_semi").distinct()


def claimed(rows: DataFrame, scope: list[str], base: str, order: list[str], signature: str | None = None, taken: DataFrame | None = None, name: str = "key", rounds: int = 8) -> DataFrame:
    """rows with key, as if they came one after the other in the given order: each takes its base, or the base and the least number from 1, that no row before it in its scope has,
    whatever that row's base, and that `taken` (key, signature) doesn't bind to other signatures only. A null base gets no key.

    Rounds of claims. Every row claims the least key that may be its own; of rows that claim one key the first keeps it for the time being, and the others go on. As
    keys only go to earlier rows, and rows only to later keys, this ends with what the order alone would give. The j-th row of a base that goes on from a
    number can end no earlier than j numbers on, unless `taken` binds a number before that to its own signature; so rows of one base start at their rank, and
    where one goes on, those after it are pushed on with it. Rounds are needed only where bases meet ("a" with 11 and "a1" with 1) and at taken keys,
    whose runs of numbers are passed in one step.

    Large bases that interleave ("a" and "a1" with thousands of rows each) would need a round for nearly every clash. Where clashes are left after `rounds`, the rows of
    those families (bases that differ in their last digits) are given keys in order instead, each family by one task that streams its rows and holds its keys.
    """
    rows = workspace.staged(rows, "unkeyed")  # read three times, and its bases may be dear to make
    sig = F.col(signature).cast("string") if signature else F.lit(None).cast("string")
    first = ranked(rows.where(F.col(base).isNotNull()), [*scope, base], [F.col(c) for c in order], "_rank", keep_part=True)
    state = first.withColumns({"_o": F.struct(*order, base, "_rank"), "_sig": sig, "_mine": F.array().cast("array<long>")})
    runs = None
    if taken is not None:
        bases = rows.select(F.col(base).alias("base")).distinct()
        bound = workspace.staged(_bound(taken.select("key", F.col("signature").cast("string").alias("signature")), bases), "bound")
        run = F.col("number") - F.row_number().over(Window.partitionBy("base").orderBy("number"))
        runs = bound.select("base", "number").distinct().withColumn("_run", run).groupBy(F.col("base").alias("_rb"), "_run").agg(F.min("number").alias("_from"), F.max("number").alias("_to")).drop("_run")
        own = bound.groupBy(F.col("base").alias("_ob"), F.col("signature").alias("_os")).agg(F.collect_set("number").alias("_own"))
        state = state.join(own, (F.col(base) == F.col("_ob")) & (F.col("_sig") == F.col("_os")), "left").withColumn("_mine", F.coalesce("_own", "_mine")).drop("_own", "_ob", "_os")
    state = state.withColumn("_n", F.least("_rank", F.array_min("_mine")).cast("long"))  # least() passes over a null
    group, along, plain = [*scope, base], [F.col("_rank")], F.size("_mine") == 0
    state = prefix(state, group, along, plain.cast("long"), F.sum, "_place", own=False).withColumn("_place", F.coalesce("_place", F.lit(0)))
    columns = state.columns
    done: DataFrame | None = None
    turn = 0
    while True:
        turn += 1
        # rows without a number of their own take rising numbers, so each is at least as far behind an earlier one as it stands
        pushed = prefix(state, group, along, F.when(plain, F.col("_n") - F.col("_place")), F.max, "_lead")
        state = pushed.withColumn("_n", F.when(plain, F.col("_lead") + F.col("_place")).otherwise(F.col("_n"))).select(*columns)
        if runs is not None:
            there = state.join(runs, (F.col(base) == F.col("_rb")) & F.col("_n").between(F.col("_from"), F.col("_to")), "left")
            mine = F.array_min(F.filter("_mine", lambda x: x.between(F.col("_n"), F.col("_to"))))
            state = there.withColumn("_n", F.coalesce(mine, F.col("_to") + 1, F.col("_n"))).select(*columns)
        key = F.concat(base, F.when(F.col("_n") > 0, F.col("_n").cast("string")).otherwise(F.lit("")))
        judged = state.withColumn("_key", key).withColumn("_best", F.min("_o").over(Window.partitionBy(*scope, "_key")))
        after = F.row_number().over(Window.partitionBy(*scope, "_key", base).orderBy("_o")) - (F.col("_best")[base] == F.col(base)).cast("int")
        judged = judged.withColumns({"_lost": F.col("_o") != F.col("_best"), "_after": after})
        next_ = F.least(F.col("_n") + F.col("_after"), F.array_min(F.filter("_mine", lambda x: x > F.col("_n"))))
        before, done = done, workspace.staged(judged.withColumn("_n", F.when(F.col("_lost"), next_).otherwise(F.col("_n"))).select(*columns, F.col("_key").alias("_claim"), "_lost"), "claims")
        if before is not None:
            workspace.drop(before)
        if done.where("_lost").isEmpty():
            break
        if turn >= rounds:
            before, done = done, workspace.staged(_in_order(done, scope, base, bound if taken is not None else None), "claims")
            workspace.drop(before)
            break
        state = done.select(*columns)
    workspace.drop(first)
    if taken is not None:
        workspace.drop(bound)
    rest = [c for c in rows.columns if c != name]
    none = rows.where(F.col(base).isNull()).select(*rest, F.lit(None).cast("string").alias(name))
    return done.select(*rest, F.col("_claim").alias(name)).unionByName(none)


def _in_order(claims: DataFrame, scope: list[str], base: str, bound: DataFrame | None) -> DataFrame:
    """claims, with _claim given out one by one in the families that still have clashes."""
    names = claims.columns
    root = F.regexp_replace(base, "[0-9]+$", "")
    claims = claims.withColumns({"_family": F.struct(*scope, root.alias("_root")), "_base": F.col(base), "_bound": F.lit(None).cast("string")})
    families = claims.where("_lost").select("_family").distinct()
    left = claims.join(families, "_family", "left_semi")
    if bound is not None:  # a family's bound keys come before its rows
        key = F.concat("base", F.when(F.col("number") > 0, F.col("number").cast("string")).otherwise(F.lit("")))
        keys = bound.select(F.regexp_replace("base", "[0-9]+$", "").alias("_root"), key.alias("_bound"), F.col("signature").alias("_sig")).distinct()
        keys = keys.join(families.select("_family", F.col("_family._root").alias("_root")), "_root").drop("_root")
        left = left.unionByName(keys, allowMissingColumns=True)
    order = [F.col("_family"), F.asc_nulls_first("_o")]
    dealt = left.repartition("_family").sortWithinPartitions(*order)
    place = {c: k for k, c in enumerate(dealt.columns)}

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family, used, held, least = None, set(), {}, {}
        for batch in batches:
            given = []
            columns = [batch.column(place[c]).to_pylist() for c in ("_family", "_base", "_sig", "_mine", "_bound")]
            for of, b, sig, mine, bound_key in zip(*columns):
                if of != family:
                    family, used, held, least = of, set(), {}, {}
                if bound_key is not None:
                    held.setdefault(bound_key, set()).add(sig)
                    given.append(None)
                    continue
                key_of = lambda n, b=b: f"{b}{n}" if n else b
                n = least.get(b, 0)
                while key_of(n) in used or key_of(n) in held:
                    n += 1
                least[b] = n  # numbers before it are used, or bound
                n = min([m for m in mine if key_of(m) not in used] + [n])
                used.add(key_of(n))
                given.append(key_of(n))
            out = batch.set_column(place["_claim"], "_claim", pa.array(given, pa.string()))
            yield out.filter(pc.is_valid(out.column(place["_claim"])))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    made = dealt.mapInArrow(give, schema)
    return claims.join(families, "_family", "left_anti").select(*names).unionByName(made.select(*names))


def suffixed(rows: DataFrame, base: str, order: list[str], name: str = "key") -> DataFrame:
    """Adds key, unique over all rows: the base for the first row that has it, else the base and the least free number (see claimed)."""
    return claimed(rows, [], base, order, name=name)


def disambiguated(entries: DataFrame, taken: DataFrame) -> DataFrame:
    """(file_path, entry_idx, base, signature, key): keys unique in their file, and not bound to other signatures elsewhere; taken: (key, signature)."""
    return claimed(entries, ["file_path"], "base", ["entry_idx"], "signature", taken).select("file_path", "entry_idx", "base", "signature", "key")


def rename_map(changes: DataFrame, preferred: Column) -> DataFrame:
    """(old, new, ambiguous): the only new key, else the only one among preferred rows, else the first by ord; changes: (old, new, ord)."""
    rows = changes.withColumn("_p", preferred)
    out = rows.groupBy("old").agg(F.countDistinct("new").alias("n"), F.min_by("new", "ord").alias("first"), F.countDistinct(F.when(F.col("_p"), F.col("new"))).alias("pn"), F.min_by(F.when(F.col("_p"), F.col("new")), F.when(F.col("_p"), F.col("ord"))).alias("pfirst"))
    return out.select("old", F.when((F.col("n") > 1) & (F.col("pn") == 1), F.col("pfirst")).otherwise(F.col("first")).alias("new"), (F.col("n") > 1).alias("ambiguous"))


def with_renamed_references(rows: DataFrame, id_col: str, list_col: str, renames: DataFrame, separators: str = "[,;]") -> DataFrame:
    """rows with the keys of a reference list renamed: split, joined on the key, gathered in order."""
    parts = rows.select(id_col, F.posexplode(F.transform(F.split(list_col, separators), lambda k: F.trim(k))).alias("_pos", "old"))
    named = parts.join(renames.select("old", "new"), "old", "left").withColumn("_k", F.coalesce("new", "old"))
    joined = named.groupBy(id_col).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_k"))), lambda s: s["_k"]), ", ").alias(list_col))
    return rows.drop(list_col).join(joined, id_col, "left")


def conflicting(entries: DataFrame, signatures: DataFrame) -> DataFrame:
    """Entries whose key is bound to other signatures only; entries: (entry_key, signature), signatures: (entry_key, signatures)."""
    return entries.join(signatures, "entry_key").where(~F.array_contains("signatures", F.col("signature")))
