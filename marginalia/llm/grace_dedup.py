"""Exact dedup by Grace hashing: recursive partitioning, then open-addressing tables that compare whole content."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FANOUT_BITS = 4

Record = tuple[bytes, bytes, "int | None", int]


class OpenTable:
    """Open addressing with linear probing; equal hashes count as equal only if the whole contents are."""

    def __init__(self) -> None:
        self.slots: list[int] = [-1] * 64
        self.rows: list[list] = []
        self.content = 0

    def _place(self, digest: bytes, text: bytes) -> tuple[int, int]:
        mask = len(self.slots) - 1
        at = int.from_bytes(digest[-8:], "big") & mask
        while (row := self.slots[at]) >= 0:
            held = self.rows[row]
            if held[0] == digest and held[1] == text:
                return at, row
            at = (at + 1) & mask
        return at, -1

    def add(self, digest: bytes, text: bytes, top: int | None, n: int) -> None:
        at, row = self._place(digest, text)
        if row >= 0:
            held = self.rows[row]
            held[2] = top if held[2] is None else held[2] if top is None else max(held[2], top)
            held[3] += n
            return
        self.slots[at] = len(self.rows)
        self.rows.append([digest, text, top, n])
        self.content += len(text) + 200
        if 2 * len(self.rows) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            for k, held in enumerate(self.rows):
                mask = len(self.slots) - 1
                at = int.from_bytes(held[0][-8:], "big") & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = k


def grace(records: Iterable[Record], budget: int, folder: str, level: int = 0) -> Iterator[list]:
    """Groups of equal content, as [digest, text, largest id, rows].

    While the table holds at most `budget` bytes all stays in memory. Beyond, what it holds and what
    still comes is partitioned by the next four bits of the digest to spill files in `folder` (a path or a URI), and each file is
    treated likewise. The files live as long as this call.
    """
    table, records = OpenTable(), iter(records)
    for record in records:
        table.add(*record)
        if table.content > budget and len(table.rows) > 1 and level < 40:
            break
    else:
        yield from table.rows
        return
    store, root = pyarrow.fs.FileSystem.from_uri(folder)
    spill = f"{root.rstrip('/')}/grace-{uuid.uuid4().hex}"
    store.create_dir(spill, recursive=True)
    try:
        paths = [f"{spill}/{k:x}" for k in range(1 << FANOUT_BITS)]
        files = [store.open_output_stream(p, buffer_size=1 << 18) for p in paths]
        try:
            def put(record) -> None:
                byte = record[0][level // 2]
                pickle.dump(tuple(record), files[byte >> 4 if level % 2 == 0 else byte & 15], protocol=5)

            for held in table.rows:
                put(held)
            del table
            for record in records:
                put(record)
        finally:
            for f in files:
                f.close()
        for p in paths:
            yield from grace(_unpickled(store, p), budget, folder, level + 1)
            store.delete_file(p)
    finally:
        store.delete_dir(spill)


def _unpickled(store: pyarrow.fs.FileSystem, path: str) -> Iterator[Record]:
    with store.open_input_stream(path, buffer_size=1 << 18) as f:
        while True:
            try:
                yield pickle.load(f)
            except EOFError:
                return


def normalised(text: Column) -> Column:
    """Text with A-Z lower-cased and nothing else changed; null counts as empty."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 48 << 20) -> DataFrame:
    """Groups of equal normalised texts: digest (sha256), keep_id, group_size; one row per distinct text.

    Copies are first combined within each task, so that a text that a third of all rows share reaches
    its bucket as one record per task and flush. The shuffle on the digest is the first level of the Grace
    partitioning; a bucket over `budget` bytes is partitioned further, to spill files in the shared
    folder, through pyarrow's file systems (paths and the URIs that it knows; an unknown one is an error). They belong to one attempt of one
    task, as Spark's own spills do: a lost executor's task starts anew. Null ids rank below all others.
    """
    folder = common.shared_dir(docs.sparkSession)
    folder = "file://" + folder.removeprefix("file:") if folder.startswith("file:/") and not folder.startswith("file:///") else folder
    rows = docs.select(F.col(id_col).cast("long").alias("top"), normalised(F.col(text_col)).alias("text"))
    rows = rows.select("top", F.unhex(F.sha2("text", 256)).alias("digest"), F.col("text").cast("binary").alias("text"))

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = OpenTable()

        def flushed() -> pa.RecordBatch:
            digest, text, top, n = zip(*table.rows)
            return pa.record_batch([pa.array(digest, pa.binary()), pa.array(text, pa.binary()), pa.array(top, pa.int64()), pa.array(n, pa.int64())], names=["digest", "text", "top", "n"])

        for batch in batches:
            for top, digest, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                table.add(digest, text, top, 1)
                if table.content > budget // 4:
                    yield flushed()
                    table = OpenTable()
        if table.rows:
            yield flushed()

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Record]:
            for batch in batches:
                yield from zip(*(batch.column(k).to_pylist() for k in range(4)))

        out: list[tuple] = []

        def flushed() -> pa.RecordBatch:
            digest, top, n = zip(*out)
            return pa.record_batch([pa.array(digest, pa.binary()), pa.array(top, pa.int64()), pa.array(n, pa.int64())], names=["digest", "keep_id", "group_size"])

        for digest, _, top, n in grace(records(), budget, folder):
            out.append((digest, top, n))
            if len(out) >= 20000:
                yield flushed()
                out.clear()
        if out:
            yield flushed()

    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.mapInArrow(combined, "digest binary, text binary, top long, n long").repartition(parts, "digest")
    return dealt.mapInArrow(merged, "digest binary, keep_id long, group_size long")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = 48 << 20) -> DataFrame:
    """Each row's group of equal texts: id, keep_id, group_size, kept, text_sha256.

    Of equal texts the row with the largest id stays. Rows that repeat an id and its text are all marked kept;
    in a group whose ids are all null keep_id is null and the rows are kept. An empty table gives no rows;
    extra columns are left out and may have any name.
    """
    groups = exact_groups(docs, id_col, text_col, budget)
    members = docs.select(F.col(id_col).alias("doc_id"), F.sha2(normalised(F.col(text_col)), 256).alias("text_sha256"))
    members = members.withColumn("digest", F.unhex("text_sha256"))
    joined = members.join(groups, "digest")
    return joined.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
