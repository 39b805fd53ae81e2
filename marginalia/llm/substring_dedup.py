"""Substring dedup by seed and extend: winnowed anchors join documents, and matches extend to both sides of an anchor.

An anchor is the least hash of SEED words in a window of `length` words (the rightmost, if several). It depends on the
window's words alone, so equal windows choose the same anchor at the same place. An occurrence of an anchor comes with all
windows that chose it, and these reach over a segment on both sides. Occurrences whose anchor is found once are
done. For the others whole segments are compared first: every occurrence but the first of a segment is a repeat.
Only where an anchor has several different segments, the first occurrence of each is extended window by window. So no
step makes pairs, and what each shuffles is at most one row a window of repeated text. Segments and windows are told apart by
two 64-bit hashes, each made from two independent hashes of each word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm import common
from marginalia.llm.common import gram_hashes, run_hashes, word_hashes

SEED = 8
LAST = (1 << 63) - 1


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def anchors(words: np.ndarray, firsts: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Of every occurrence of an anchor: its hash, text, first window and number of windows (windows as word numbers)."""
    m = words.shape[1] - length + 1
    none = np.zeros(0, np.int64)
    if m <= 0:
        return none.view(np.uint64), none, none, none
    grams = gram_hashes(words, SEED)
    best, place = grams[:m].copy(), np.zeros(m, np.int64)
    for j in range(1, length - SEED + 1):
        other = grams[j : j + m]
        less = other <= best
        np.copyto(best, other, where=less)
        place[less] = j
    text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
    at = np.flatnonzero(text[:m] == text[length - 1 :])
    if not len(at):
        return none.view(np.uint64), none, none, none
    place = at + place[at]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(place) != 0) | (np.diff(at) != 1))))
    return best[at[new]], text[at[new]], at[new], np.diff(np.append(new, len(at)))


def _batches(rows: Iterator[pa.RecordBatch], most: int = 1 << 21) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of batches with about `most` bytes of text; the text is column 1."""
    for batch in rows:
        text = [(t or "").encode() for t in batch.column(1).to_pylist()]
        at = size = 0
        for k, t in enumerate(text):
            size += len(t)
            if size >= most or k == len(text) - 1:
                yield batch.slice(at, k + 1 - at), text[at : k + 1]
                at, size = k + 1, 0


def _occurrences(docs: DataFrame, length: int) -> DataFrame:
    """(a, s, s2, doc, i, n): anchor, two hashes of its segment, document, first window, windows."""

    @common.frugal
    def emit(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(rows):
            words, firsts = word_hashes(texts)
            a, text, i, n = anchors(words, firsts, length)
            s, s2 = (run_hashes(words, i, n + length - 1, k) for k in range(2))
            yield pa.record_batch([signed(a), signed(s), signed(s2), batch.column(0).take(pa.array(text)), pa.array((i - firsts[text]).astype(np.int32)), pa.array(n.astype(np.int32))], names=["a", "s", "s2", "doc", "i", "n"])

    return docs.mapInArrow(emit, "a long, s long, s2 long, doc long, i int, n int")


def _anchor_counts(docs: DataFrame, length: int) -> DataFrame:
    @common.frugal
    def emit(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in _batches(rows):
            a, n = np.unique(anchors(*word_hashes(texts), length)[0], return_counts=True)
            yield pa.record_batch([signed(a), pa.array(n)], names=["a", "n"])

    return docs.mapInArrow(emit, "a long, n long").groupBy("a").agg(F.sum("n").alias("n"))


def _windows(found: DataFrame, length: int) -> DataFrame:
    """(w1, w2, doc, i) of the windows of given occurrences; found: (doc, text, at array<struct<i, n>>)."""

    @common.frugal
    def emit(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _batches(rows):
            words, firsts = word_hashes(texts)
            spans = batch.column(2)
            flat = spans.flatten()
            text = np.repeat(np.arange(len(spans)), np.diff(spans.offsets.to_numpy()))
            i, n = flat.field("i").to_numpy().astype(np.int64), flat.field("n").to_numpy().astype(np.int64)
            fits = i + n + length - 1 <= np.diff(firsts)[text]
            text, i, n = text[fits], i[fits], n[fits]
            step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            i, text = np.repeat(i, n) + step, np.repeat(text, n)
            at = firsts[text] + i
            w1, w2 = (run_hashes(words, at, np.full(len(at), length), k) for k in range(2))
            yield pa.record_batch([signed(w1), signed(w2), batch.column(0).take(pa.array(text)), pa.array(i.astype(np.int32))], names=["w1", "w2", "doc", "i"])

    return found.mapInArrow(emit, "w1 long, w2 long, doc long, i int")


@common.tidy
def repeats(docs: DataFrame, length: int = 20) -> DataFrame:
    """(doc, i, e, s): words [i, e) of a document are covered by windows that also start earlier; s is their hash.

    docs: (doc long, text string). Sides that are summed are tables before they are joined, so that adaptive execution can split the
    rows of a frequent anchor, segment or window over tasks.
    """
    counts = common.staged(_anchor_counts(docs, length).where("n > 1").select("a"), "anchors")
    found = common.staged(_occurrences(docs, length).join(counts, "a", "left_semi"), "occurrences")
    segment = ["a", "s", "s2"]
    segments = common.staged(found.groupBy(*segment).agg(F.min(F.struct("doc", "i", "n")).alias("first"), F.count("*").alias("times")), "segments")

    known = segments.where("times > 1").select(*segment, F.col("first.doc").alias("fd"), F.col("first.i").alias("fi"))
    copies = found.join(known, segment).where("doc > fd or (doc = fd and i > fi)")
    copies = copies.select("doc", "i", (F.col("i") + F.col("n") + length - 1).alias("e"), "s")

    several = segments.groupBy("a").agg(F.count("*").alias("c")).where("c > 1").select("a")
    firsts = segments.join(several, "a", "left_semi").select("first.*").groupBy("doc").agg(F.collect_list(F.struct("i", "n")).alias("at"))
    windows = common.staged(_windows(docs.join(firsts, "doc").select("doc", "text", "at"), length), "windows")
    first = windows.groupBy("w1", "w2").agg(F.min(F.struct("doc", "i")).alias("first"), F.count("*").alias("times")).where("times > 1")
    first = common.staged(first.select("w1", "w2", F.col("first.doc").alias("fd"), F.col("first.i").alias("fi")), "first-windows")
    later = windows.join(first, ["w1", "w2"]).where("doc > fd or (doc = fd and i > fi)")
    return copies.unionByName(later.select("doc", "i", (F.col("i") + length).alias("e"), F.col("w1").alias("s")))


def remove_repeats(docs: DataFrame, length: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Adds n_words, n_removed, kept_text (kept words joined by one space) and kept_sha256 to docs.

    A word goes if a window of `length` words covers it whose words also start earlier: in a document of smaller id, or earlier
    in the same one. Rows that repeat an id don't count as earlier than one another at the same start; null ids come
    last. Null, empty and short texts lose nothing. An empty table gives no rows. Columns of docs with one of the
    added names are replaced.
    """
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST))
    keyed = docs.select(ident.alias("doc"), F.col(text_col).cast("string").alias("text"))
    spans = repeats(keyed, length).groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("i", "e", "s"))).alias("__m_spans"))
    added = ["n_words", "n_removed", "kept_text", "kept_sha256"]
    rest = [c for c in docs.columns if c not in added and c != text_col]
    joined = docs.withColumn("__m_doc", ident).join(spans.withColumnRenamed("doc", "__m_doc"), "__m_doc", "left")
    joined = joined.select("__m_spans", F.col(text_col).cast("string").alias("text"), F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"))

    @common.frugal
    def kept(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            n_words, n_removed, out, sha = [], [], [], []
            for spans, text in zip(batch.column(0), batch.column(1).to_pylist()):
                words = (text or "").encode().split()
                n_words.append(len(words))
                removed = 0
                if spans.is_valid:
                    values = spans.values
                    i, e = (values.field(k).to_numpy().astype(np.int64) for k in ("i", "e"))
                    s = values.field("s").to_numpy().view(np.uint64)
                    hashes, _ = word_hashes([text.encode()] if text else [])
                    fits = e <= len(words)
                    i, e, s = i[fits], e[fits], s[fits]
                    own = run_hashes(hashes, i, e - i) == s
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, i[own], 1)
                    np.add.at(change, e[own], -1)
                    gone = np.cumsum(change)[:-1] > 0
                    removed = int(gone.sum())
                    words = [w for w, x in zip(words, gone.tolist()) if not x]
                whole = b" ".join(words)
                n_removed.append(removed)
                out.append(whole.decode())
                sha.append(hashlib.sha256(whole).hexdigest())
            yield pa.record_batch([batch.column(2), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(out, pa.string()), pa.array(sha, pa.string()), batch.column(1)], names=["rest", *added, "text"])

    kind = joined.schema["rest"].dataType.simpleString() if rest else None
    if not rest:
        joined = joined.withColumn("rest", F.struct(F.lit(1).alias("x")))
        kind = "struct<x:int>"
    made = joined.mapInArrow(kept, f"rest {kind}, n_words long, n_removed long, kept_text string, kept_sha256 string, text string")
    return made.select(*[F.col(f"rest.`{c}`") for c in rest], F.col("text").alias(text_col), *added)
