"""Near duplicates by min-max hashing: candidates from bands of minima and maxima, links confirmed on whole sets.

Under each of PERMUTATIONS permutations a set keeps its least and its greatest value, so a signature of twice as many
values costs one evaluation for two. A band is both values of two permutations: sets of similarity J share it with
probability J**4, and 32 bands miss a pair of similarity 0.85 with probability 6e-11.

Equal sets are one node. Inside a bucket no step makes all pairs: leaders are compared with the members of
other components, links join components, and leaders that met every member retire. It ends when each bucket
has one component left, so every pair of a bucket is either in one component or was compared, or cannot reach the threshold
by an exact bound: in buckets of more than BIG nodes, on shingles that no other node of any such bucket has; in all buckets, on the
bits in which the parities of two sets differ, each of which some shingle of one set alone must have turned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm import common
from marginalia.llm.common import gram_hashes, mix, run_hashes, stream, word_hashes
from marginalia.llm.substring_dedup import _batches

PERMUTATIONS = 64
ROWS = 4
BIG = 16
PARITIES = 8  # longs of a set's parity bits
_A = stream(0xF00D, PERMUTATIONS) | np.uint64(1)
_B = stream(0xBEEF, PERMUTATIONS)
_BITS = [f"p{i}" for i in range(PARITIES)]


def shingle_sets(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted within it, and where each set starts (n + 1 numbers)."""
    words, firsts = word_hashes(texts, lower=True)
    grams = gram_hashes(words, k)
    sets = []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        if b - a >= k:
            sets.append(np.unique(grams[a : b - k + 1]))
        else:
            sets.append(run_hashes(words, np.array([a]), np.array([b - a])) if b > a else grams[:0])
    sizes = np.array([len(s) for s in sets], np.int64)
    return (np.concatenate(sets) if sets else grams[:0]), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def minmax(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Minima and maxima under each permutation, of sets that are not empty: (sets, 2 * PERMUTATIONS)."""
    out = np.empty((len(starts), 2 * PERMUTATIONS), np.uint64)
    for j in range(PERMUTATIONS):
        turned = values * _A[j] + _B[j]
        out[:, 2 * j] = np.minimum.reduceat(turned, starts)
        out[:, 2 * j + 1] = np.maximum.reduceat(turned, starts)
    return out


def bands(signature: np.ndarray) -> np.ndarray:
    """A hash of each band: (sets, bands)."""
    n = signature.shape[1] // ROWS
    place = stream(0xBAAD, ROWS) | np.uint64(1)
    key = np.tile(stream(0xBA2D, n), (len(signature), 1))
    for r in range(ROWS):
        key = mix(key + signature[:, r::ROWS] * place[r])
    return key


def parities(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of sets that are not empty, bits that each shingle turns one of: (sets, PARITIES).

    Sets of sizes n and m whose bits differ in d places have at least d shingles that are not in both, so they share (n + m - d) / 2 at most.
    """
    spot = mix(values + np.uint64(99))
    lane, bit = spot % np.uint64(PARITIES), np.uint64(1) << (spot >> np.uint64(58))
    return np.stack([np.bitwise_xor.reduceat(np.where(lane == k, bit, np.uint64(0)), starts) for k in range(PARITIES)], axis=1)


def _prints(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """128 bits that name each set."""
    out = np.zeros((len(firsts) - 1, 2), np.uint64)
    full = np.flatnonzero(np.diff(firsts))
    if len(full):
        for k in range(2):
            out[full, k] = np.add.reduceat(mix(values + np.uint64(77 + k)), firsts[full])
    return out


def _names(prints: np.ndarray) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(prints), [None, pa.py_buffer(np.ascontiguousarray(prints).tobytes())]).cast(pa.binary())


def _lists(has: np.ndarray, rows: np.ndarray) -> pa.Array:
    """One list a set: the next of `rows` where the set has one, else no items."""
    ends = np.concatenate(([0], np.cumsum(np.where(has, rows.shape[1], 0))))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.ascontiguousarray(rows).reshape(-1).view(np.int64)))


def signatures(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc, v, n, bands, parity) of (doc, text): the set's name and size, its bands and its parity bits (both without items for an empty set)."""

    @common.frugal
    def emit(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(rows, 1 << 21):
            values, firsts = shingle_sets(texts, k)
            n = np.diff(firsts)
            full = np.flatnonzero(n)
            keys = bands(minmax(values, firsts[full])) if len(full) else np.zeros((0, 2 * PERMUTATIONS // ROWS), np.uint64)
            bits = parities(values, firsts[full]) if len(full) else np.zeros((0, PARITIES), np.uint64)
            lists = [_lists(n > 0, rows) for rows in (keys, bits)]
            yield pa.record_batch([batch.column(0), _names(_prints(values, firsts)), pa.array(n), *lists], names=["doc", "v", "n", "bands", "parity"])

    return docs.mapInArrow(emit, "doc long, v binary, n long, bands array<long>, parity array<long>")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """(v, n, items) of (v, text); rows whose text has another name are left out."""

    @common.frugal
    def emit(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(rows, 1 << 21):
            values, firsts = shingle_sets(texts, k)
            own = _names(_prints(values, firsts))
            held = pa.ListArray.from_arrays(pa.array(firsts.astype(np.int32)), pa.array(values.view(np.int64)))
            made = pa.record_batch([own, pa.array(np.diff(firsts)), held], names=["v", "n", "items"])
            yield made.filter(pa.compute.equal(own, batch.column(0).cast(pa.binary())))

    return docs.mapInArrow(emit, "v binary, n long, items array<long>").dropDuplicates(["v"])


@common.tidy
def components(edges: DataFrame) -> DataFrame:
    """(v, c): the least node of each node's component, by large and small stars; edges: (x, y), none from a node to itself.

    Each round is two joins; a hub's rows are split by the skew join. It ends when the edges are stars: no node is both a centre and a
    point, nor a point of two centres. Nodes without an edge are not returned.
    """
    edges = edges.select(F.greatest("x", "y").alias("x"), F.least("x", "y").alias("y")).distinct()
    edges = common.staged(edges, "edges")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).where("x != y")
        large = common.staged(large, "large-star")  # with repeats, but no more rows than edges
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").select(F.col("y").alias("x"), F.col("m").alias("y")).unionByName(least.select("x", F.col("m").alias("y")))
        edges = common.staged(small.where("x != y").distinct(), "small-star")
    return edges.select(F.col("x").alias("v"), F.col("y").alias("c"))


def _stars(edges: DataFrame) -> bool:
    """Whether every node of the edges (x > y) is either the point x of one edge or a centre y."""
    ends = edges.select(F.col("x").alias("v"), F.lit(1).alias("point"), F.lit(0).alias("centre"))
    ends = ends.unionByName(edges.select(F.col("y").alias("v"), F.lit(0).alias("point"), F.lit(1).alias("centre")))
    nodes = ends.groupBy("v").agg(F.sum("point").alias("points"), F.max("centre").alias("centre"))
    return not nodes.where("points + centre > 1").take(1)


def _reach(percent: int, inter: str, n1: str, n2: str) -> str:
    """percent * union <= 100 * intersection."""
    return f"{100 + percent} * {inter} >= {percent} * ({n1} + {n2})"


@common.tidy
def near_components(docs: DataFrame, percent: int = 85, k: int = 5) -> DataFrame:
    """(doc, n, component): docs is (doc long, text string); component is the least doc of those that links reach."""
    found = common.staged(signatures(docs, k), "signatures")
    nodes = found.where("n > 0").groupBy("v", "n").agg(F.min(F.struct("doc", "bands", "parity")).alias("r")).select("v", "n", "r.*")
    nodes = common.staged(nodes, "nodes")
    rows = nodes.select("v", F.explode("bands").alias("b"))
    shared = common.staged(rows.groupBy("b").agg(F.count("*").alias("m")).where("m > 1"), "shared-bands")
    held = nodes.select("v", "n", *(F.col("parity")[i].alias(p) for i, p in enumerate(_BITS)))
    members = common.staged(common.likely(rows, "b", shared).join(shared, "b").join(held, "v"), "members")
    labels = _linked(docs, nodes, members, percent, k) if members.take(1) else None
    rows = found.select("doc", "n", "v")
    if labels is not None:
        rows = rows.join(labels, "v", "left").select("doc", "n", F.coalesce("c", "v").alias("c"))
    else:
        rows = rows.withColumnRenamed("v", "c")
    least = common.staged(rows.where("n > 0").groupBy("c").agg(F.min("doc").alias("component")), "components")
    rows = rows.join(least, "c", "left")
    return rows.select("doc", "n", F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc")).alias("component"))


def _linked(docs: DataFrame, nodes: DataFrame, members: DataFrame, percent: int, k: int) -> DataFrame | None:
    """(v, c) of the nodes that have a link; None if there is no link."""
    wanted = common.staged(nodes.join(members.select("v").distinct(), "v", "left_semi").select("v", "doc"), "wanted")
    texts = common.likely(docs, "doc", wanted)
    texts = texts.join(wanted, texts["doc"].eqNullSafe(wanted["doc"])).select("v", "text")
    sets = common.sorted_run(_sets(texts, k), ["v"])  # every turn joins pairs with them twice

    big = sets.join(members.where(F.col("m") > BIG).select("v").distinct(), "v", "left_semi")
    alone = big.select("v", F.explode("items").alias("h")).groupBy("h").agg(F.count("*").alias("c"), F.min("v").alias("v")).where("c = 1")
    alone = alone.groupBy("v").agg(F.count("*").alias("u"))
    # The counts hold among nodes of big buckets only: in a small bucket, a shingle of `alone` may be shared with a node that is in no big one.
    bound = F.when(F.col("m") > BIG, F.col("n") - F.coalesce("u", F.lit(0))).otherwise(F.col("n"))
    members = members.join(alone, "v", "left").select("b", "v", "n", bound.alias("e"), F.col("v").alias("c"), *_BITS)
    labels = tested = None
    turn = 0
    while True:
        members = _open(members, percent, turn)
        if not members.take(1):
            return labels
        pairs = _leader_pairs(members, percent)
        if tested is not None:
            pairs = pairs.join(tested, ["x", "y"], "left_anti")
        pairs = common.staged(pairs, "pairs")
        one, two = (sets.select(F.col("v").alias(v), F.col("n").alias(f"n{v}"), F.col("items").alias(f"i{v}")) for v in "xy")
        met = pairs.join(one, "x").join(two, "y")
        met = met.select("x", "y", "nx", "ny", F.size(F.array_intersect("ix", "iy")).cast("long").alias("inter"))
        met = common.staged(met.select("x", "y", F.expr(_reach(percent, "inter", "nx", "ny")).alias("linked")), "compared")
        tested = met.select("x", "y") if tested is None else tested.unionByName(met.select("x", "y"))
        new = met.where("linked").select("x", "y")
        if new.take(1):
            labels = components(new if labels is None else new.unionByName(labels.select(F.col("v").alias("x"), F.col("c").alias("y"))))
            members = members.drop("c").join(labels, "v", "left").withColumn("c", F.coalesce("c", "v"))
        members = common.staged(members.where("not lead").select("b", "v", "n", "e", "c", *_BITS), "members-left")
        turn += 1


def _open(members: DataFrame, percent: int, turn: int) -> DataFrame:
    """Members of buckets that hold more than one component and that may still link, with the mark of this turn's leaders.

    A bucket's first leader is the member with the smallest share of shingles that are its own. After that, leaders
    are members outside the bucket's largest component, up to 16 times as many a turn, and lead all their buckets.
    """
    size = members.groupBy("b", "c").agg(F.count("*").alias("k"), F.min("n").alias("least"))
    bucket = size.groupBy("b").agg(F.count("*").alias("cs"), F.min("least").alias("least"), F.max(F.struct("k", "c")).alias("major")).where("cs > 1")
    live = members.join(common.staged(bucket, "buckets"), "b").where(_reach(percent, "e", "n", "least"))
    share = ((F.col("n") - F.col("e")) / F.col("n")).alias("share")
    if turn:
        ranked = live.where(F.col("c") != F.col("major.c"))
        salt = F.pmod(F.xxhash64("v", F.lit(turn)), F.lit(16**turn))
    else:
        ranked, salt = live, F.lit(0)
    best = ranked.groupBy("b", salt.alias("salt")).agg(F.min(F.struct(share, F.col("v"))).alias("best"))
    best = best.select("b", F.col("best.v").alias("v"))  # the first turn has one a bucket
    where, best = (["v"], best.select("v").distinct()) if turn else (["b", "v"], best)
    lead = common.staged(best.withColumn("lead", F.lit(True)), "leaders")
    live = live.select("b", "v", "n", "e", "c", *_BITS).join(lead, where, "left").withColumn("lead", F.coalesce("lead", F.lit(False)))
    return common.staged(live, "members-open")


def _leader_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(x, y), x < y, of each leader with the members of other components of its buckets.

    A pair that shares several buckets is made in the least of those that its leader leads, so the join makes each pair once.
    """
    node = Window.partitionBy("v")  # at most one row a band
    met = members.select("b", "v", "n", "e", "c", *_BITS, F.collect_set("b").over(node).alias("own"))
    lead = members.where("lead").select("b", *(F.col(c).alias(f"l{c}") for c in ("v", "n", "e", "c", *_BITS)), F.collect_set("b").over(node).alias("led"))
    least = F.array_min(F.array_intersect("own", "led"))
    differ = " + ".join(f"bit_count({p} ^ l{p})" for p in _BITS)
    may = F.expr(_reach(percent, "least(e, le)", "n", "ln")) & F.expr(_reach(percent, f"(n + ln - ({differ})) / 2", "n", "ln"))
    met = met.join(lead, (met["b"] == lead["b"]) & (met["c"] != lead["lc"]) & may & (met["b"] == least))
    return met.select(F.least("v", "lv").alias("x"), F.greatest("v", "lv").alias("y")).distinct()


def near_dedup(docs: DataFrame, percent: int = 85, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row.

    Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased; the set is the distinct shingles of `k` words, or the whole sequence
    of fewer. Rows whose sets have 100 * intersection >= percent * union are linked; component_id is the least id
    that links reach. Null and wordless texts are linked with nothing: component_id is their own id. A component whose ids are
    all null has a null component_id; rows are kept where the id equals component_id, nulls included, so rows
    that repeat an id are kept together. Empty tables give no rows; extra columns are left out.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"))
    out = near_components(rows, percent, k)
    return out.select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("doc").eqNullSafe(F.col("component")).alias("kept"))
