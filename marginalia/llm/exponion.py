"""Exact centroid clustering by Exponion search over whole-number vectors."""

from __future__ import annotations

import hashlib
import math
import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm import common

ROWS = 4096
_EXACT = float(1 << 53)
_SLACK = 1e-9
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
#: A block: up to ROWS vectors with what is known of each: its centroid, and bounds on the distances to that and to any other.
BLOCK = "ids array<long>, wide boolean, vectors binary, centroid binary, upper binary, lower binary, sums array<struct<centroid:int,part:int,limb:int,value:long>>"


class Vectors:
    """Whole-number vectors. Narrow ones have 16-bit components; wide ones are held as doubles of components / scale, where a component of any size fits."""

    def __init__(self, data: bytes, wide: bool, dims: int, scale: int) -> None:
        self.wide, self.scale = wide, scale
        self.held = np.frombuffer(data, np.float64 if wide else np.int16).reshape(-1, dims)
        with np.errstate(over="ignore"):
            self.near = self.held * float(scale) if wide else self.held.astype(np.float64)

    @staticmethod
    def packed(x: np.ndarray, scale: int) -> tuple[bytes, bool]:
        with np.errstate(over="ignore"):
            units = np.floor(x * scale)
        if not x.size or np.abs(units).max() < 1 << 15:
            return units.astype(np.int16).tobytes(), False
        return np.where(np.isfinite(units), units / scale, x).tobytes(), True

    def whole(self, rows: np.ndarray) -> np.ndarray:
        """The given rows as Python's whole numbers."""
        held = self.held[rows].ravel().tolist()
        made = [_scaled(v, self.scale) for v in held] if self.wide else held
        return np.array(made, object).reshape(len(rows), -1)


def _scaled(v: float, scale: int) -> int:
    over, under = v.as_integer_ratio()
    return over * scale // under


class Centroids:
    """Centroids, and for each the others sorted by their distance to it."""

    def __init__(self, whole: list[list[int]], before: Centroids | None = None) -> None:
        self.whole = np.array(whole, object).reshape(len(whole), -1)
        self.near = np.array([[_double(c) for c in row] for row in whole]).reshape(self.whole.shape)
        # a distance beyond the doubles counts as the greatest of them, as all uses need it from below
        apart = np.array([[min(sys.float_info.max, _root(sum((a - b) ** 2 for a, b in zip(x, y)))) for y in whole] for x in whole]).reshape(len(whole), len(whole))
        own = apart.copy()
        np.fill_diagonal(own, -1)
        self.order = np.argsort(own, axis=1, kind="stable")  # the centroid itself is first
        self.apart = np.take_along_axis(apart, self.order, 1)
        self.nearest = self.apart[:, 1] if len(whole) > 1 else np.full(len(whole), np.inf)
        self.moved = np.zeros(len(whole)) if before is None else np.array([_root(sum((a - b) ** 2 for a, b in zip(x, y))) for x, y in zip(whole, before.whole)])
        self.names = [hashlib.sha256(",".join(map(str, row)).encode()).hexdigest() for row in whole]


def _double(x: int) -> float:
    try:
        return float(x)
    except OverflowError:
        return np.inf if x > 0 else -np.inf


def _root(square: int) -> float:
    """The root of a whole number, infinite beyond the doubles."""
    return float(square) ** 0.5 if square < 1 << 1000 else _double(math.isqrt(square))


class Search:
    """The nearest centroids of a block's vectors, with the bounds that the last search left."""

    def __init__(self, centroids: Centroids) -> None:
        self.c = centroids
        self.scanned = 0

    def squares(self, v: Vectors, rows: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distances of rows to centroids `which`, and how far each may be off; not finite where doubles don't reach."""
        self.scanned += len(rows) * len(which)
        x, c = v.near[rows], self.c.near[which]
        with np.errstate(over="ignore", invalid="ignore"):
            size = (x * x).sum(1)[:, None] + (c * c).sum(1)[None]
            square = size - 2 * (x @ c.T)
            off = np.where(size < _EXACT / 4, 0.0, size * (1e-15 * (4 * x.shape[1] + 16)))
        return square, off

    def best(self, v: Vectors, rows: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each row: the nearest of the centroids `which` (ties: the smaller number), the distance to that from above, to the next from below."""
        square, off = self.squares(v, rows, which)
        with np.errstate(invalid="ignore"):
            low, high = np.nan_to_num(square - off, nan=0.0, posinf=np.inf), np.nan_to_num(square + off, nan=np.inf, posinf=np.inf)
        by = np.argsort(which)
        at = by[np.argmin(low[:, by], axis=1)]
        n = np.arange(len(rows))
        rivals = low <= high[n, at][:, None]
        unsure = np.flatnonzero((rivals.sum(1) > 1) & ((off > 0) | ~np.isfinite(square)).any(1))
        low, high = np.sqrt(np.maximum(low, 0)), np.sqrt(np.maximum(high, 0))
        for r in unsure.tolist():
            exact = self.exact(v, rows[[r]], which)[0]
            at[r] = min(range(len(which)), key=lambda k: (exact[k], which[k]))
            high[r] = [_root(e) for e in exact]
            low[r] = np.minimum(high[r], sys.float_info.max)
        upper = high[n, at] * (1 + _SLACK)
        low[n, at] = sys.float_info.max
        return which[at], upper, low.min(1) * (1 - _SLACK)

    def exact(self, v: Vectors, rows: np.ndarray, which: np.ndarray) -> list[list[int]]:
        return [[sum((a - b) ** 2 for a, b in zip(x, c)) for c in self.c.whole[which].tolist()] for x in v.whole(rows).tolist()]

    def all_(self, v: Vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.best(v, np.arange(len(v.held)), np.arange(len(self.c.whole)))

    def again(self, v: Vectors, own: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same for vectors whose centroids were `own` before these moved.

        A vector stays where its upper bound is under the lower bound on all others, or under half the way to its centroid's nearest
        other. Else the upper bound is made anew; if it doesn't settle it, only the centroids within 2 * upper + that way of its centroid are
        scanned, which the nearest two are among. The ball is closed, and the tests are strict, so ties are always scanned.
        """
        moved = self.c.moved
        most = int(np.argmax(moved))
        others = np.where(own == most, np.partition(moved, -2)[-2] if len(moved) > 1 else 0.0, moved[most])
        own, upper, lower = own.copy(), (upper + moved[own]) * (1 + _SLACK), np.maximum(lower - others * (1 + _SLACK), 0)
        settled = np.maximum(lower, self.c.nearest[own] / 2 * (1 - _SLACK))
        left = np.flatnonzero(~(upper < settled))
        for a in np.unique(own[left]).tolist():
            rows = left[own[left] == a]
            square, off = self.squares(v, rows, np.array([a]))
            with np.errstate(invalid="ignore"):
                upper[rows] = np.sqrt(np.nan_to_num(np.maximum(square + off, 0), nan=np.inf, posinf=np.inf)[:, 0]) * (1 + _SLACK)
            rows = rows[~(upper[rows] < settled[rows])]
            reach = (2 * upper[rows] + self.c.nearest[a]) * (1 + _SLACK)
            inside = np.searchsorted(self.c.apart[a], reach, "right")
            rings = np.ceil(np.log2(np.maximum(inside, 1))).astype(int)  # rows whose balls hold about as many centroids go together
            for ring in np.unique(rings).tolist():
                some = rows[rings == ring]
                which = self.c.order[a][: min(1 << ring, len(self.c.whole))]
                own[some], upper[some], lower[some] = self.best(v, some, which)
        return own, upper, lower


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """A whole number as (limb, value) with the sum of value << (32 * limb)."""
    sign, value, limb = (-1 if value < 0 else 1), abs(value), 0
    while value:
        if value & 0xFFFFFFFF:
            yield limb, sign * (value & 0xFFFFFFFF)
        value >>= 32
        limb += 1


class Sums:
    """Exact sums by (centroid, part); a part is a dimension, or COUNT, or INERTIA."""

    COUNT, INERTIA = -1, -2

    def __init__(self) -> None:
        self.of: defaultdict[tuple[int, int], int] = defaultdict(int)

    def add_vectors(self, v: Vectors, own: np.ndarray) -> None:
        for a, n in enumerate(np.bincount(own).tolist()):
            if n:
                self.of[a, self.COUNT] += n
                rows = np.flatnonzero(own == a)
                total = v.whole(rows).sum(0).tolist() if v.wide else v.held[rows].sum(0, dtype=np.int64).tolist()
                for d, s in enumerate(total):
                    self.of[a, d] += s

    def rows(self) -> list[dict]:
        return [{"centroid": a, "part": d, "limb": limb, "value": x} for (a, d), s in self.of.items() for limb, x in _limbs(s)]


def _collected(table: DataFrame) -> dict[tuple[int, int], int]:
    """The sums of all tasks: a row for each centroid, part and limb."""
    rows = table.where("sums is not null").select(F.explode("sums").alias("s")).select("s.*").groupBy("centroid", "part", "limb").agg(F.sum("value").alias("value"))
    out: defaultdict[tuple[int, int], int] = defaultdict(int)
    for r in rows.collect():
        out[r["centroid"], r["part"]] += r["value"] << (32 * r["limb"])
    return out


def _clamped(x: int) -> int:
    return max(_LEAST, min(_MOST, x))


def _sum_row(sums: Sums) -> pa.RecordBatch:
    return _batch([(None, None, None, None, None, None, sums.rows())])


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    limb = pa.struct([("centroid", pa.int32()), ("part", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])
    kinds = [("ids", pa.list_(pa.int64())), ("wide", pa.bool_()), ("vectors", pa.binary()), ("centroid", pa.binary()), ("upper", pa.binary()), ("lower", pa.binary()), ("sums", pa.list_(limb))]
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds])


def _first_round(rows: DataFrame, centroids: Centroids, dims: int, scale: int) -> DataFrame:
    """Blocks of (id, x), assigned by a scan of all centroids."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)

    @common.frugal
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, search = Sums(), Search(shared.value)
        for whole in batches:
            for at in range(0, len(whole), ROWS):
                batch = whole.slice(at, ROWS)
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
                wide = (np.abs(x) >= (1 << 15) / scale - 1).any(1)
                for part in (np.flatnonzero(~wide), np.flatnonzero(wide)):  # a wide vector doesn't widen the others
                    if len(part):
                        data, is_wide = Vectors.packed(x[part], scale)
                        v = Vectors(data, is_wide, dims, scale)
                        own, upper, lower = search.all_(v)
                        sums.add_vectors(v, own)
                        yield _batch([(batch.column(0).take(pa.array(part)).to_pylist(), is_wide, data, own.astype(np.int32).tobytes(), upper.tobytes(), lower.tobytes(), None)])
        yield _sum_row(sums)

    return rows.mapInArrow(made, BLOCK)


def _opened(batch: pa.RecordBatch, dims: int, scale: int) -> Iterator[tuple]:
    for r in batch.to_pylist():
        v = Vectors(r["vectors"], r["wide"], dims, scale)
        yield r, v, np.frombuffer(r["centroid"], np.int32), np.frombuffer(r["upper"]), np.frombuffer(r["lower"])


def _next_round(table: DataFrame, centroids: Centroids, dims: int, scale: int) -> DataFrame:
    shared = table.sparkSession.sparkContext.broadcast(centroids)

    @common.frugal
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, search = Sums(), Search(shared.value)
        for batch in batches:
            for r, v, own, upper, lower in _opened(batch, dims, scale):
                own, upper, lower = search.again(v, own, upper, lower)
                sums.add_vectors(v, own)
                yield _batch([(r["ids"], r["wide"], r["vectors"], own.astype(np.int32).tobytes(), upper.tobytes(), lower.tobytes(), None)])
        yield _sum_row(sums)

    return table.where("ids is not null").mapInArrow(made, BLOCK)


def _measured(table: DataFrame, centroids: Centroids, dims: int, scale: int, inertia: bool) -> DataFrame:
    """(vec_id, cluster, distance) of the blocks; or with `inertia` one row of sums a task."""
    shared = table.sparkSession.sparkContext.broadcast(centroids)

    def distances(search: Search, v: Vectors, own: np.ndarray) -> list[int]:
        out = np.zeros(len(own), object)
        for a in np.unique(own).tolist():
            rows = np.flatnonzero(own == a)
            square, off = search.squares(v, rows, np.array([a]))
            if (off == 0).all() and np.isfinite(square).all():
                out[rows] = square[:, 0].astype(np.int64).tolist()
            else:
                out[rows] = [e[0] for e in search.exact(v, rows, np.array([a]))]
        return out.tolist()

    @common.frugal
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, search = Sums(), Search(shared.value)
        for batch in batches:
            for r, v, own, _, _ in _opened(batch, dims, scale):
                found = distances(search, v, own)
                if not inertia:
                    yield pa.record_batch([pa.array(r["ids"], pa.int64()), pa.array(own), pa.array([_clamped(d) for d in found], pa.int64())], names=["vec_id", "cluster", "distance"])
                    continue
                for a, d in zip(own.tolist(), found):
                    sums.of[a, Sums.INERTIA] += d
        if inertia:
            yield _sum_row(sums)

    return table.where("ids is not null").mapInArrow(made, BLOCK if inertia else "vec_id long, cluster int, distance long")


def _start(rows: DataFrame, clusters: int, seed: str, scale: int) -> list[list[int]]:
    """The vectors of the smallest hashes of seed and id; equal hashes by component, null ids last."""
    place = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256)
    first = rows.select(place.alias("place"), "x").orderBy(F.asc_nulls_last("place"), "x").limit(clusters).collect()
    return [[_scaled(c, scale) for c in r["x"]] for r in first]


@common.tidy
def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64, clusters: int = 40, rounds: int = 5, seed: str = "2:", scale: int = 256) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256): Lloyd's rounds from fixed starts, exact in whole numbers.

    Rows whose vector has exactly `dims` components, none null or not finite, take part, each component x as floor(scale * x) of the double. Centroids
    start as the vectors with the smallest sha256 of seed and id (all, if there are fewer). Each round assigns every vector to the nearest centroid,
    ties to the smaller number, and moves each centroid that has vectors to floor(sum / count) by component. At the end vectors are
    assigned once more. distance is squared; inertia sums it over the cluster and over all. Rows that repeat an id or a vector each
    take part; null ids do too, but start no centroid while other rows are left. An empty table gives no rows. Sums and distances
    are whole numbers of any size, shown as the nearest long. scale is a power of two.

    Search: Exponion. The vectors lie in blocks with their centroid and two bounds a vector, written anew each round without a shuffle, so that
    only the task of a lost executor is repeated. Tasks add up exact sums; the driver gets one number for each centroid and dimension (and 32 bits
    of size), whatever the rows.
    """
    x = F.col(vector_col).cast("array<double>")
    fits = x.isNotNull() & (F.size(x) == dims) & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.where(fits).select(F.col(id_col).cast("long").alias("id"), x.alias("x"))
    start = _start(rows, clusters, seed, scale)
    if not start:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).cast("long").alias("cluster_inertia"), F.lit(0).cast("long").alias("inertia"), F.lit("").alias("centroid_sha256"))
    now = Centroids(start)
    table = common.staged(_first_round(rows, now, dims, scale), "clusters")
    for _ in range(rounds):
        sums, before = _collected(table), now
        whole = [[sums[a, d] // sums[a, Sums.COUNT] for d in range(dims)] if sums[a, Sums.COUNT] else row for a, row in enumerate(before.whole.tolist())]
        if whole == before.whole.tolist():
            break  # nothing moves any more, so no later round would change an assignment
        now = Centroids(whole, before)
        old, table = table, common.staged(_next_round(table, now, dims, scale), "clusters")
        common.release(old)
    sums = _collected(_measured(table, now, dims, scale, inertia=True))
    of = [sums[a, Sums.INERTIA] for a in range(len(start))]
    known = F.array(*[F.struct(F.lit(_clamped(i)).cast("long").alias("inertia"), F.lit(name).alias("name")) for i, name in zip(of, now.names)])
    own = F.get(known, F.col("cluster"))
    found = _measured(table, now, dims, scale, inertia=False)
    return found.select("vec_id", "cluster", "distance", own["inertia"].alias("cluster_inertia"), F.lit(_clamped(sum(of))).cast("long").alias("inertia"), own["name"].alias("centroid_sha256"))


def oracle_sql(dims: int = 64, clusters: int = 40, rounds: int = 5, seed: str = "2:", scale: int = 256) -> str:
    """The rows of cluster() for `embeddings`, with every distance of every round."""
    steps = [
        f"""x AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor({scale} * c::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
        xd AS (SELECT r, unnest(v) AS x, unnest(range({dims})) AS d FROM x),
        c0 AS (SELECT (row_number() OVER (ORDER BY sha256('{seed}' || vec_id), v) - 1)::INT AS k, v FROM x ORDER BY k LIMIT {clusters})"""
    ]
    for n in range(rounds + 1):
        steps.append(f"a{n} AS (SELECT r, k, s FROM (SELECT r, k, list_sum(list_transform(list_zip(x.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS s FROM x, c{n} c) QUALIFY row_number() OVER (PARTITION BY r ORDER BY s, k) = 1)")
        if n < rounds:
            steps.append(
                f"""m{n} AS (SELECT k, list(m ORDER BY d) AS v FROM (SELECT k, d, ((sum(x) - (sum(x) % count(*) + count(*)) % count(*)) // count(*))::BIGINT AS m FROM a{n} JOIN xd USING (r) GROUP BY k, d) GROUP BY k),
        c{n + 1} AS (SELECT k, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (k))"""
            )
    last = rounds
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, k AS cluster, s AS distance, (sum(s) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(s) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM a{last} JOIN x USING (r) JOIN c{last} c USING (k)"""
