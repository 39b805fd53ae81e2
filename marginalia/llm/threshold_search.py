"""Exact top-k inner products by Fagin's threshold algorithm over sorted per-dimension lists."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP = 8
_SAFE = float(1 << 62)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


class Lists:
    """Distinct vectors and, for each dimension, their order by component; equal vectors share a row and keep the ids that can matter.

    Vectors are whole numbers, held as doubles of 1 / scale of them. Where all of a block's products fit, sums are made in 64-bit integers, else
    in Python's.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, scale: int = 1) -> None:
        self.scale = scale
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], np.ascontiguousarray(vectors[order]) + 0.0
        _, first, which = np.unique(vectors.view(np.dtype((np.void, vectors.itemsize * vectors.shape[1]))).ravel(), return_index=True, return_inverse=True)
        self.largest = float(np.abs(vectors).max()) * scale if vectors.size else 0.0  # may be infinite
        self.vectors = self._whole(vectors[first], self.largest < _SAFE)
        by = np.argsort(which, kind="stable")
        cuts = np.searchsorted(which[by], np.arange(len(first) + 1))
        self.ids = [self._kept(ids[by[a:z]], k) for a, z in zip(cuts[:-1], cuts[1:])]
        self.rising = np.argsort(vectors[first], axis=0, kind="stable")
        self.wide: np.ndarray | None = None
        self.read = 0

    def _whole(self, vectors: np.ndarray, fits: bool) -> np.ndarray:
        if fits:
            return (vectors * self.scale).astype(np.int64)
        parts = (x.as_integer_ratio() for x in vectors.ravel().tolist())
        return np.array([over * self.scale // under for over, under in parts], object).reshape(vectors.shape)

    @staticmethod
    def _kept(ids: np.ndarray, k: int) -> np.ndarray:
        """Of ids in order: the least k + 1, each at most k times. A query leaves out one of them, so k stay if there are so many."""
        if len(ids) <= k:
            return ids
        values, counts = np.unique(ids, return_counts=True)
        return np.repeat(values[: k + 1], np.minimum(counts[: k + 1], k))

    def top(self, query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        """The k best (score, id), ties to smaller ids, without rows of the id `own`.

        All lists are read downwards in the direction that the query's sign makes best. Each new row's score comes from its
        whole vector. It ends when the sum of the components at the present depth, which no unread row exceeds, is
        below the kth score; an equal sum goes on, for a smaller id could tie.
        """
        n = len(self.vectors)
        with np.errstate(over="ignore", invalid="ignore"):
            vectors, fits = self.vectors, bool(self.largest * (np.abs(query).sum() * self.scale) < _SAFE)
        if not fits and vectors.dtype != object:
            if self.wide is None:
                self.wide = self.vectors.astype(object)
            vectors = self.wide
        query = self._whole(query, fits)
        dims = np.flatnonzero(query)
        weight = query[dims]
        up = (weight > 0).astype(bool)
        seen = np.zeros(n, bool)
        rows, scores = np.zeros(0, np.int64), query[:0]
        held: list[tuple[int, int]] = []
        depth, step = 0, STEP
        while depth < n:
            end = min(n, depth + step)
            part = np.empty((end - depth, len(dims)), np.int64)
            part[:, up] = self.rising[n - end : n - depth, dims[up]][::-1]
            part[:, ~up] = self.rising[depth:end, dims[~up]]
            new = np.unique(part) if len(dims) else np.arange(n)
            new = new[~seen[new]]
            seen[new] = True
            rows, scores = self._near(np.concatenate((rows, new)), np.concatenate((scores, vectors[new] @ query)), k)
            held = self._best(rows, scores, own, k)
            if not len(dims):
                break
            bound = int((weight * vectors[part[-1], dims]).sum())
            if len(held) == k and held[-1][0] > bound:
                break
            depth, step = end, step * 2
        self.read += int(seen.sum())
        return held

    def _near(self, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Without the rows that k + 1 others beat (one of these may be the query's own)."""
        if len(rows) <= 4 * k:
            return rows, scores
        cut = np.sort(scores)[len(scores) - k - 1] if scores.dtype == object else np.partition(scores, len(scores) - k - 1)[len(scores) - k - 1]
        near = (scores >= cut).astype(bool)
        return rows[near], scores[near]

    def _best(self, rows: np.ndarray, scores: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
        found = [(-int(s), int(i)) for r, s in zip(rows.tolist(), scores.tolist()) for i in self.ids[r].tolist() if i != own]
        return [(-s, i) for s, i in sorted(found)[:k]]


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * component) / scale as a double, which is exact for a power of two; only rows with an id and with a vector
    without null and non-finite components."""
    x = F.col(vector_col).cast("array<double>")
    whole = x.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    # floor() gives a long and would cut doubles beyond 2**63, which have no fraction anyway
    units = F.transform(x, lambda c: F.when(F.abs(c * scale) < 2.0**62, F.floor(c * scale).cast("double") / scale).otherwise(c))
    return vectors.where(whole & F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), units.alias("v"))


def top_k(vectors: DataFrame, is_query, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024, block: int = 8192, chunk: int = 1 << 16) -> DataFrame:
    """(query_id, rank, vec_id, score): of every row where `is_query` (a condition on vec_id) holds, the k best rows of other ids.

    Score: inner product of quantised vectors; vectors of unequal length count as filled up with zeros. Every row is a candidate, rows that
    repeat an id too; queries that repeat an id share one list of k. Scores are ranked as whole numbers of any size, and shown
    as the nearest long where they are beyond 64 bits. scale is a power of two. Candidates are dealt into blocks by
    the hash of their rows, and a task makes the lists of its block once and then takes the queries one batch after the other, so memory
    follows the block. Only for more than `chunk` queries a block goes to several tasks. Each query's best of all blocks meet at the end.
    Fewer candidates give fewer rows; an empty table gives none.
    """
    rows = quantised(vectors, id_col, vector_col, scale)
    size = rows.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q"), F.max(F.size("v")).alias("d")).first()
    blocks, chunks, width = -(-size["n"] // block) or 1, -(-size["q"] // chunk) or 1, max(1, size["d"] or 1)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [np.pad(np.asarray(x, float), (0, width - len(x))).tobytes() for x in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(data, pa.binary())], names=["vec_id", "v"])

    rows = rows.mapInArrow(packed, "vec_id long, v binary")
    at = F.xxhash64("vec_id", "v")
    candidates = rows.withColumns({"asks": F.lit(False), "block": F.pmod(at, F.lit(blocks)), "chunk": F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))})
    queries = rows.where(is_query).withColumns({"asks": F.lit(True), "chunk": F.pmod(at, F.lit(chunks)), "block": F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))})
    columns = ["vec_id", "v", "asks", (F.col("block") * chunks + F.col("chunk")).alias("task")]
    dealt = candidates.select(*columns).unionByName(queries.select(*columns)).repartition(blocks * chunks, "task").sortWithinPartitions("task", "asks")

    def matrix(data: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(data), float).reshape(len(data), width)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by task, candidates before queries."""
        task = lists = None
        ids: list[int] = []
        data: list[bytes] = []
        for batch in batches:
            cuts = batch.column("task").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero((np.diff(cuts) != 0) | (asks[1:] != asks[:-1])) + 1).tolist(), len(batch)]
            out: list[tuple[int, int, str]] = []
            for a, z in zip(edges[:-1], edges[1:]):
                if a == z:
                    continue
                if cuts[a] != task:
                    task, lists, ids, data = cuts[a], None, [], []
                part = batch.slice(a, z - a)
                if not asks[a]:
                    ids += part.column("vec_id").to_pylist()
                    data += part.column("v").to_pylist()
                    continue
                if lists is None and ids:
                    lists, data = Lists(np.array(ids, np.int64), matrix(data), k, scale), []
                if lists is not None:
                    for own, query in zip(part.column("vec_id").to_pylist(), matrix(part.column("v").to_pylist())):
                        out += [(own, i, s) for s, i in lists.top(query, own, k)]
            yield pa.record_batch([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([_sortable(o[2]) for o in out], pa.string()), pa.array([min(_MOST, max(_LEAST, o[2])) for o in out], pa.int64())], names=["query_id", "vec_id", "place", "score"])

    found = dealt.mapInArrow(search, "query_id long, vec_id long, place string, score long")
    best = F.slice(F.sort_array(F.collect_list(F.struct("place", F.col("vec_id").alias("i"), "score"))), 1, k)
    ranked = found.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("pos", "b"))
    return ranked.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("b.i").alias("vec_id"), F.col("b.score").alias("score"))


def _sortable(score: int) -> str:
    """A text whose order is that of falling scores, for whole numbers of any size."""
    digits = f"{abs(score):x}"
    text = f"{len(digits):04x}{digits}"
    return "b" + text if score < 0 else "a" + text.translate(_TURNED)


_TURNED = str.maketrans("0123456789abcdef", "fedcba9876543210")
