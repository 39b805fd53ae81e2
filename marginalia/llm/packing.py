"""Best-fit packing planned on the histogram of lengths; documents take the planned slots by their rank within a length."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.llm import common
from marginalia.llm.tokens import batch_tokenizer, in_groups

END = 2


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def token_pieces(docs: DataFrame, path: str, most: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most `most` tokens: doc_id, piece, start, length, ids_crc32.

    A document is its text's ids, as the library `tokenizers` makes them from the file at `path`, and the id 2 (null text: only that). Longer ones are cut so that all pieces but the
    first are full.
    """

    @common.frugal
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = batch_tokenizer(path)
        for batch in batches:
            doc, text = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            row, piece, start, length, crc = [], [], [], [], []
            for a, b in in_groups(text):
                for k, ids in enumerate(of.ids(text[a:b]), a):
                    ids = np.append(ids, np.uint32(END)).astype("<u4")
                    at, end, n = 0, (len(ids) - 1) % most + 1, 0
                    while at < len(ids):
                        row.append(k)
                        piece.append(n)
                        start.append(at)
                        length.append(end - at)
                        crc.append(zlib.crc32(ids[at:end].tobytes()))
                        at, end, n = end, end + most, n + 1
            yield pa.record_batch([doc.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan(counts: dict[int, int], most: int) -> list[tuple[int, int, int, int, int]]:
    """Best-fit decreasing over counts of lengths: runs (length, first rank, ranks, first sequence, offset).

    Sequences that hold the same lengths are one group (room, first number, how many). A length goes to the
    group with the least room that still fits, as many to a sequence as fit, so a step handles a whole group and the plan
    grows with the number of lengths and not with the number of documents.
    """
    rooms: list[int] = []
    groups: dict[int, list[tuple[int, int]]] = {}
    runs, sequences = [], 0

    def put(room: int, first: int, n: int) -> None:
        if not n or not room:
            return
        if room not in groups:
            bisect.insort(rooms, room)
            groups[room] = []
        groups[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            k = bisect.bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, n = groups[room].pop()
                if not groups[room]:
                    del groups[room]
                    rooms.pop(k)
            else:
                room = most
                first, n = sequences, -(-left // (most // length))
                sequences += n
            each = room // length
            full = min(n, left // each)
            for j in range(each if full else 0):
                runs.append((length, rank + j * full, full, first, most - room + j * length))
            left -= full * each
            rank += full * each
            put(room - each * length, first, full)
            first, n = first + full, n - full
            if n and left:  # left < each
                for j in range(left):
                    runs.append((length, rank + j, 1, first, most - room + j * length))
                put(room - left * length, first, 1)
                rank, left, first, n = rank + left, 0, first + 1, n - 1
            put(room, first, n)
    return runs


@common.tidy
def pack(pieces: DataFrame, most: int = 1024) -> DataFrame:
    """Adds sequence_id and offset to pieces that have a length of 1 to `most`.

    The driver gets only the histogram, `most` numbers, and sends the plan back, whose size depends on `most` alone. Ranks
    within a length come from counts by (bucket, length): a bucket is a share of the rows, so a length that a third of all
    pieces have is dealt over all tasks. Equal rows take ranks in any order. Empty input gives no rows.
    """
    spark = pieces.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = common.staged(pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int")), "pieces")
    counted = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    counted = common.staged(counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "lengths")
    runs = plan({r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("n").alias("n")).collect()}, most)
    runs.sort()
    table = np.array(runs, np.int64).reshape(-1, 5)
    shift = np.int64(1 << 48)
    shared = spark.sparkContext.broadcast((table[:, 0] * shift + table[:, 1], table[:, 1], table[:, 3], table[:, 4]))

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, first_rank, first_sequence, offset = shared.value
        for batch in batches:
            rank, length = batch.column("rank").to_numpy(), batch.column("length").to_numpy()
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            out = {name: batch.column(name) for name in ("doc_id", "piece", "start", "length", "ids_crc32")}
            yield pa.record_batch(out | {"sequence_id": pa.array(first_sequence[at] + rank - first_rank[at]), "offset": pa.array(offset[at])})

    within = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = pieces.withColumn("rank", F.row_number().over(within)).join(counted.select("bucket", "length", "before").hint("merge"), ["bucket", "length"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") - 1 + F.col("before")).cast("long").alias("rank"))
    return ranked.mapInArrow(slots, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, most: int = 1024, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents as pieces of at most `most` tokens with their places; see token_pieces and pack."""
    return pack(token_pieces(docs, path or vocabulary(), most, id_col, text_col), most)
