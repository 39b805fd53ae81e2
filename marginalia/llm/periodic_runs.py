"""Periodic runs of words, by heavy and light lag counts and island scans."""

from __future__ import annotations

import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm import common

_PIECE = 1 << 20
_BATCH = 64


def pieces(text: bytes, size: int = _PIECE) -> Iterator[list[bytes]]:
    """The words `[^\\x20\\x09-\\x0D]+` of a text, some at a time; a cut never falls inside a word."""
    at = 0
    while at < len(text):
        end = min(len(text), at + size)
        while end < len(text) and text[end] not in common.WORD_WHITE:
            end += 1
        yield text[at:end].split()
        at = end


def word_ids(parts: Iterable[list[bytes]]) -> np.ndarray:
    """A number for each word of a text's pieces: equal numbers if and only if the words are equal."""
    known: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
    return np.concatenate([np.zeros(0, np.int32), *(np.fromiter(map(known.__getitem__, part), np.int32, len(part)) for part in parts)])


def _heavy(count: np.ndarray, size: int) -> np.ndarray:
    """The words of these counts that are better counted by transforms of this size.

    A transform costs some size * log(size) steps; light words cost a step a pair, and a round for each number of places apart, as long
    as the most frequent of them asks for. The words are split where the sum is least, so no word's pairs grow with its square.
    """
    most = np.sort(count)[::-1].astype(float)
    pairs = np.append(np.cumsum((most * most)[::-1])[::-1], 0)
    most = np.append(most, 0)
    cost = np.arange(len(most)) * (2000.0 + size * size.bit_length() / 4) + most * 2000 + pairs
    return np.flatnonzero(count > most[np.argmin(cost)])


def lag_counts(ids: np.ndarray, most: int) -> np.ndarray:
    """For each lag from 0 to `most`: at how many places a word stands again that many words later (lag 0 is left at 0).

    The autocorrelation of each heavy word's places is made by FFT, whose rounding is far under one half, and the spectra are added
    before the one way back. The pairs of light words are counted one by one, by how many places of the same word lie between them.
    """
    n = len(ids)
    out = np.zeros(most + 1, np.int64)
    count = np.bincount(ids)
    size = 1 << (n + most).bit_length()
    heavy = _heavy(count, size)
    if len(heavy):
        spectrum = np.zeros(size // 2 + 1)
        some = max(1, _PIECE // size)
        for at in range(0, len(heavy), some):
            wave = np.fft.rfft(ids == heavy[at : at + some, None], size)
            spectrum += (wave.real**2 + wave.imag**2).sum(0)
        out += np.rint(np.fft.irfft(spectrum, size)[: most + 1]).astype(np.int64)
    light = count > 1
    light[heavy] = False
    place = np.argsort(ids, kind="stable")
    place = place[light[ids[place]]]
    word = ids[place]
    left, apart, lags, held = np.arange(len(place)), 1, [], 0
    while len(left := left[left < len(place) - apart]):
        lag = place[left + apart] - place[left]
        near = (word[left + apart] == word[left]) & (lag <= most)  # places further apart are no nearer
        left, apart = left[near], apart + 1
        lags.append(lag[near])
        held += len(left)
        if held > _PIECE:
            out += np.bincount(np.concatenate(lags), minlength=most + 1)
            lags, held = [], 0
    if held:
        out += np.bincount(np.concatenate(lags), minlength=most + 1)
    out[0] = 0
    return out


def _prime_divisors(q: int) -> list[int]:
    out, p = [], 2
    while p * p <= q:
        if q % p == 0:
            out.append(p)
            while q % p == 0:
                q //= p
        p += 1
    return out + [q] * (q > 1)


def runs_of(ids: np.ndarray, least: int = 6, times: int = 4) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period.

    A run is a stretch with smallest period q, of at least max(least, times * q) words, that no neighbouring word extends keeping q.
    It has max(least - q, (times - 1) * q) matches in a row at lag q, so only lags with so many matches in all are scanned for islands.
    A stretch of that length whose smallest period is less than q has one that divides q, and is a run of that. times must be at least 2.

    A run of m words with period d also matches itself m - q times at each multiple q of d. Of these at most d - 1 at each end
    can belong to a run whose smallest period is q (a longer common part would have period d throughout), so the others are taken off the
    count of q: a long run doesn't bring a scan for each multiple of its period.
    """
    most = len(ids) // times
    if len(ids) < least or not most:
        return []
    lag = np.arange(most + 1)
    enough = np.maximum(np.maximum(least - lag, (times - 1) * lag), 1)
    count, found = lag_counts(ids, most), []
    for q in np.flatnonzero(count >= enough).tolist():
        if count[q] < enough[q]:
            continue
        match = np.zeros(len(ids) - q + 2, bool)
        np.equal(ids[q:], ids[:-q], out=match[1:-1])
        edge = np.flatnonzero(match[1:] != match[:-1])
        start, size = edge[::2], edge[1::2] - edge[::2]
        wide = np.flatnonzero(size >= enough[q])
        for a, m in zip(start[wide].tolist(), size[wide].tolist()):
            span = ids[a : a + m + q]
            if not any(np.array_equal(span[q // p :], span[: -(q // p)]) for p in _prime_divisors(q)):
                found.append((a, m + q, q))
                count[2 * q :: q] -= np.maximum(m + q - lag[2 * q :: q] - 2 * (q - 1), 0)
    return sorted(found, key=lambda r: (r[0], r[2]))


def dropped(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of n words some run contains after its first period."""
    step = np.zeros(n + 1, np.int64)
    for a, m, q in runs:
        step[a + q] += 1
        step[a + m] -= 1
    return np.cumsum(step[:-1]) > 0


def repeating(n: int, key: int) -> tuple[int, int] | None:
    """(a, p) if the text of n words with this number is to go on from word a with period p, else None."""
    if key % 10 or not n:
        return None
    g = key // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = 6, times: int = 4, planted: bool = False) -> DataFrame:
    """All columns of docs, with n_words, n_runs, runs (start, length, period), collapsed (the text's words without those that a run repeats,
    joined by one space) and runs_sha256, collapsed_sha256.

    Words are `[^\\x20\\x09-\\x0D]+` of the whole text, compared as they are; a null text has none. With `planted`, one document of ten, by
    the crc32 of its id as text, goes on from a word on with a period first (see repeating), as if its text were such; a null id is never among these.
    Rows are independent: repeated rows and ids give equal results, an empty table gives none. Columns of docs with the names of added ones are replaced.

    Nothing is shuffled. A task holds one text with one number a word; its words are made some at a time.
    """
    added = {"n_words": "long", "n_runs": "long", "runs": "array<struct<start:long,length:long,period:long>>", "collapsed": "string", "runs_sha256": "string", "collapsed_sha256": "string"}
    rest = [c for c in docs.columns if c not in added]

    @common.frugal
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), _BATCH):
                batch = whole.slice(at, _BATCH)
                out = [_searched((text or "").encode(), key, least, times) for text, key in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
                kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])), pa.string(), pa.string(), pa.string()]
                yield pa.record_batch([batch.column(0), *(pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds))], names=["rest", *added])

    key = common.doc_crc(id_col) if planted else F.lit(None).cast("long")
    packed = docs.select(F.struct(F.lit(1).alias("__m_one"), *[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col(text_col).cast("string").alias("text"), key.alias("key"))
    made = packed.mapInArrow(found, f"rest {packed.schema['rest'].dataType.simpleString()}, " + ", ".join(f"{c} {t}" for c, t in added.items()))
    return made.select(*[F.col(f"rest.`{c}`") for c in rest], *added)


def _searched(text: bytes, key: int | None, least: int, times: int) -> tuple:
    parts = list(pieces(text)) if len(text) <= _PIECE else None  # the words of a longer text are made anew rather than held
    ids = word_ids(parts or pieces(text))
    again = repeating(len(ids), key) if key is not None else None
    source = np.arange(len(ids))
    if again:
        a, p = again
        source[a:] = a + (source[a:] - a) % p
        ids = ids[source]
    runs = runs_of(ids, least, times)
    kept, at = [], 0
    left = source[~dropped(len(ids), runs)]
    if again and len(left) > 1 and (np.diff(left) <= 0).any():
        words = [w for part in parts or pieces(text) for w in part]
        kept = [b" ".join([words[k] for k in left.tolist()])]
    else:
        for part in parts or pieces(text):
            a, z = np.searchsorted(left, (at, at + len(part)))
            if z > a:
                kept.append(b" ".join(part if z - a == len(part) else [part[k - at] for k in left[a:z].tolist()]))
            at += len(part)
    collapsed = b" ".join(kept)
    listed = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
    sha = lambda x: hashlib.sha256(x).hexdigest()
    return len(ids), len(runs), [dict(zip(("start", "length", "period"), r)) for r in runs], collapsed.decode(), sha(listed.encode()), sha(collapsed)


def longest(runs: str = "runs"):
    """The run of greatest length; ties: smallest start, then smallest period. Null without a run."""
    by = F.transform(runs, lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length")))
    return F.array_min(by)
