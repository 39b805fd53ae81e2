"""What the operators of this subpackage share: staging tables and vectorised text hashing."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import functools
import gc
import hashlib
import sys
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_WHITE = b" \t\n\x0b\x0c\r"
_CHUNK = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir.

    Where that is unset, a local session (one machine, tests) gets a folder made for it, and a cluster an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: executors need a folder that all of them share")
        found = tempfile.mkdtemp(prefix="marginalia-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/marginalia/{name}-{uuid.uuid4().hex}"


#: The tables of each open scope, innermost last: their session, place, and name in the catalogue, if any. Threads have scopes of their own.
_scopes: contextvars.ContextVar[tuple[list[tuple[SparkSession, str, str | None]], ...]] = contextvars.ContextVar("scopes", default=())


def _delete(spark: SparkSession, path: str, name: str | None) -> None:
    if name:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextlib.contextmanager
def scope():
    """Deletes the tables staged inside it when it ends; a result of these must be staged outside or be read before."""
    outer, own = _scopes.get(), []
    _scopes.set((*outer, own))
    try:
        yield
    finally:
        _scopes.set(outer)
        for made in own:
            _delete(*made)


def release(df: DataFrame) -> None:
    """Deletes a table that staged() or sorted_run() returned (or the result of a tidy operator), once nothing reads it any more; other frames are left alone."""
    made = getattr(df, "_marginalia_table", None)
    if made:
        for tables in _scopes.get():
            if made in tables:
                tables.remove(made)
        _delete(*made)
        df._marginalia_table = None


def tidy(operator):
    """operator, with its result staged and every other table of its run deleted."""

    @functools.wraps(operator)
    def run(*args, **kwargs) -> DataFrame:
        with scope():
            made = operator(*args, **kwargs)
            return staged(made, operator.__name__, outside=True)

    return run


def staged(df: DataFrame, name: str, by: str | None = None, outside: bool = False) -> DataFrame:
    """df as a table written in the shared folder: cuts lineage and survives a lost executor.

    The shuffle files that made it are released, so disk holds one stage at a time. With `by`, rows lie in one folder for each value of
    that column. The table belongs to the innermost scope, or with `outside` to the one around that.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    schema = df.schema
    made = (spark, path, None)
    if len(_scopes.get()) > outside:
        _scopes.get()[-1 - outside].append(made)
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    del df, writer
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(schema).parquet(path)
    out._marginalia_table = made
    return out


def sorted_run(df: DataFrame, keys: list[str]) -> DataFrame:
    """df as a table of the session's catalogue (to be read by this session; other drivers need a shared metastore), its files in the shared folder, in buckets by the keys and sorted in each, so that joins on the keys with another run, or with rows
    that a shuffle dealt by them, don't move it again. Belongs to the innermost scope."""
    spark = df.sparkSession
    path, name = fresh_path(spark, "run"), f"marginalia_run_{uuid.uuid4().hex}"
    made = (spark, path, name)
    if _scopes.get():
        _scopes.get()[-1].append(made)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").bucketBy(parts, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    out = spark.table(name)
    out._marginalia_table = made
    return out


def frugal(work):
    """A function for mapInArrow that gives freed memory back to the system at its task's end, as workers live on beside the executor's heap."""

    @functools.wraps(work)
    def run(batches):
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)

    return run


def dealt(df: DataFrame, parts: int | None = None) -> DataFrame:
    """Rows dealt evenly over tasks, for work whose time follows the rows rather than the file blocks."""
    return df.repartition(parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def likely(rows: DataFrame, column: str, found: DataFrame, words: int = 1 << 19) -> DataFrame:
    """rows without most of those whose `column` is not in found's column of that name, nulls included; a join after it decides.

    What is broadcast is a bitmap of 64 * words hashes, so its size is bounded; a row whose hash some value of found has stays. A join of a large
    table with a small part of its keys so moves that part, and not the large table.
    """
    spot = F.pmod(F.xxhash64(column), F.lit(64 * words))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (spot % 64).cast("int"))
    bits = found.select(F.floor(spot / 64).alias("_word"), bit.alias("_bit")).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    held = rows.withColumns({"_word": F.floor(spot / 64), "_bit": bit}).join(F.broadcast(bits), "_word")
    return held.where(F.col("_bits").bitwiseAND(F.col("_bit")) != 0).select(*rows.columns)


def doc_crc(column: str):
    """crc32 of the id as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def mix(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix(np.uint64(seed) + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[list(WORD_WHITE)] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
_TURN = stream(0x7EA5E, 4) | np.uint64(1)
_LONG = 128


@functools.cache
def _point_values() -> np.ndarray:
    return stream(0xC0DE, sys.maxunicode + 1)


_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        have = np.full(max(n, _CHUNK), base, dtype=np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if n <= 2 * _CHUNK:
            _powers[int(base)] = have
    return have[:n]


def point_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every span [start, end) of code points, by prefix sums of one polynomial.

    Different spans can be made that share it: callers compare the contents.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(points) + 1, np.uint64)
    np.cumsum(_point_values()[points] * _power(_BASE, len(points)), out=sums[1:])
    h = (sums[ends] - sums[starts]) * _power(_INVERSE, len(points))[starts]
    return mix(h + (ends - starts).astype(np.uint64))


def byte_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two 64-bit hashes, made apart from one another, of every span [start, end) of bytes: (2, spans).

    Eight bytes at a time go through the finaliser of splitmix64, so no sum of bytes cancels; spans over _LONG bytes take both halves
    of a BLAKE2b digest.
    """
    size = (ends - starts).astype(np.int64)
    out = np.empty((2, len(starts)), np.uint64)
    if not len(starts):
        return out
    padded = np.concatenate((buf, np.zeros(8, np.uint8)))
    lanes = np.ndarray((len(buf) + 1,), "<u8", padded, strides=(1,))
    for k in range(2):
        out[k] = mix(size.astype(np.uint64) * _TURN[k] + _TURN[k + 2])
    lane = lanes[starts] & _KEEP[np.minimum(size, 8)]
    for k in range(2):
        out[k] = mix(out[k] ^ (lane * _TURN[k]))
    live = np.flatnonzero((size > 8) & (size <= _LONG))
    at, left = starts[live] + 8, size[live] - 8
    while len(live):
        lane = lanes[at] & _KEEP[np.minimum(left, 8)]
        for k in range(2):
            out[k, live] = mix(out[k, live] ^ (lane * _TURN[k]))
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    for j in np.flatnonzero(size > _LONG).tolist():
        out[:, j] = np.frombuffer(hashlib.blake2b(buf[starts[j] : ends[j]].tobytes(), digest_size=16).digest(), "<u8")
    return out


def word_hashes(texts: list[bytes], lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes (see byte_hashes) of the words `[^\\x20\\x09-\\x0D]+` of whole texts, and each text's first word (n + 1 numbers).

    Works through the texts in pieces cut at white space, so memory follows the piece and not the text.
    """
    out, counts = [], []
    at, size = 0, 0
    group: list[bytes] = []

    def flush() -> None:
        if not group:
            return
        buf = np.frombuffer(b"\n".join(group) + b"\n", np.uint8)
        if lower:
            buf = _LOWER[buf]
        white = _IS_WHITE[buf]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], white)).view(np.int8)))
        starts, ends = edge[::2], edge[1::2]
        out.append(byte_hashes(buf, starts, ends))
        firsts = np.concatenate(([0], np.cumsum([len(t) + 1 for t in group])))
        counts.extend(np.diff(np.searchsorted(starts, firsts)).tolist())
        group.clear()

    for text in texts:
        if len(text) > _CHUNK:
            flush()
            size = 0
            before = len(counts)
            at = 0
            while at < len(text):
                end = min(len(text), at + _CHUNK)
                while end < len(text) and text[end] not in WORD_WHITE:
                    end += 1
                group.append(text[at:end])
                flush()
                at = end
            counts[before:] = [sum(counts[before:])]
            continue
        group.append(text)
        size += len(text)
        if size > _CHUNK:
            flush()
            size = 0
    flush()
    hashes = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.uint64)
    return hashes, np.concatenate(([0], np.cumsum(counts))).astype(np.int64)


def _places(seed: int, k: int) -> np.ndarray:
    return stream(0xA11CE + seed, 2 * k) | np.uint64(1)


def gram_hashes(words: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every k words in a row (over text borders as well: callers mask those), from both hashes of each word."""
    n = words.shape[1] - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64((seed * 0x9E3779B97F4A7C15 + k) & (2**64 - 1)), np.uint64)
    place = _places(seed, k)
    for j in range(k):
        h += words[0, j : j + n] * place[2 * j]
        h += words[1, j : j + n] * place[2 * j + 1]
    return mix(h)


def run_hashes(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every run of `size` words from `start`; for short runs, as a run of k words costs k steps."""
    most = int(sizes.max()) if len(sizes) else 0
    place = _places(seed, max(1, most))
    h = mix(sizes.astype(np.uint64) + np.uint64(seed + 1))
    for j in range(most):
        on = np.flatnonzero(sizes > j)
        at = starts[on] + j
        h[on] += words[0, at] * place[2 * j] + words[1, at] * place[2 * j + 1]
    return mix(h)
