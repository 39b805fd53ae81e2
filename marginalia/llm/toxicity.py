"""Toxicity from the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index, distance-weighted votes.

All words of the examples are terms. A plain TF-IDF cosine ranks by topic and language first and finds few toxic texts (see the README
for figures), so a term's weight is its TF-IDF times its relevance: the square of its log odds between the classes, smoothed, and less
the less sure these are (see relevance). That leaves every term and every example in the index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm import common
from marginalia.llm.common import byte_hashes

BLOCK = 64
SMOOTH = 5.0
DOUBT = 3.0
_CHARS = 1 << 20


def term_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Terms of whole texts and the text of each: lower-cased runs of letters."""
    data = [t.lower().encode() for t in texts]
    buf = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    letter = (buf >= 128) | ((buf >= 97) & (buf <= 122))
    edge = np.flatnonzero(np.diff(np.concatenate(([False], letter)).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    firsts = np.cumsum([0] + [len(d) + 1 for d in data])
    text = np.searchsorted(firsts, starts, side="right") - 1
    return byte_hashes(buf, starts, ends)[0], text


def _parts(rows: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    for batch in rows:
        texts = [t or "" for t in batch.column(column).to_pylist()]
        at = size = 0
        for k, t in enumerate(texts):
            size += len(t)
            if size >= _CHARS or k == len(texts) - 1:
                yield batch.slice(at, k + 1 - at), texts[at : k + 1]
                at, size = k + 1, 0


def _counted(text: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term, count), sorted by text and term."""
    order = np.lexsort((term, text))
    text, term = text[order], term[order]
    first = np.flatnonzero(np.concatenate(([True], (np.diff(text) != 0) | (term[1:] != term[:-1]))[: len(text)]))
    return text[first], term[first], np.diff(np.append(first, len(text)))


def _bags(texts: list[str], terms: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, term number, count) of the known terms, sorted."""
    h, text = term_hashes(texts)
    if not len(terms) or not len(h):
        none = np.zeros(0, np.int64)
        return none, none, none
    at = np.minimum(np.searchsorted(terms, h), len(terms) - 1)
    known = terms[at] == h
    return _counted(text[known], at[known])


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ..., of every range of `size` places, laid end to end."""
    return np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))


@dataclass
class Index:
    """Unit vectors of the examples, by term, in blocks of BLOCK examples with each term's greatest weight in each block that has it.

    Examples are laid out by their strongest term, so that a query's strong terms are dense in few blocks.
    """

    terms: np.ndarray
    weight: np.ndarray  # of a term: its inverse document frequency times its relevance
    ids: np.ndarray
    labels: np.ndarray
    rows_weight: np.ndarray
    cells: np.ndarray  # (term, block) pairs: where a term's start
    block: np.ndarray  # of a cell
    maxima: np.ndarray  # of a cell
    starts: np.ndarray  # of a cell, in rows/values
    rows: np.ndarray
    values: np.ndarray
    curve: tuple[np.ndarray, np.ndarray]
    prior: float
    k: int

    def vector(self, term: np.ndarray, count: np.ndarray) -> np.ndarray:
        w = (1 + np.log(count)) * self.weight[term]
        norm = np.sqrt((w * w).sum())
        return w / norm if norm > 0 else w

    def nearest(self, term: np.ndarray, weight: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of greatest cosine above 0 (ties: first in the index), exactly.

        Blocks are read in the order of their bounds until no bound reaches the kth cosine.
        """
        first = self.cells[term]
        size = self.cells[term + 1] - first
        cell, weight = _spread(first, size), np.repeat(weight, size)
        block = self.block[cell]
        bound = np.bincount(block, weights=weight * self.maxima[cell])
        order = np.argsort(-bound, kind="stable")
        order = order[: np.searchsorted(-bound[order], 0)]
        best_row, best = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 4
        while at < len(order):
            kth = best[-1] - 1e-9 if len(best) == self.k else 0.0
            if bound[order[at]] < kth:
                break
            chosen = np.zeros(len(bound), bool)
            chosen[order[at : at + step]] = True
            chosen &= bound >= kth
            at, step = at + step, 4 * step
            here = chosen[block]
            some = cell[here]
            n = self.starts[some + 1] - self.starts[some]
            place = _spread(self.starts[some], n)
            total = np.bincount(self.rows[place], weights=np.repeat(weight[here], n) * self.values[place])
            found = np.flatnonzero(total)
            score = total[found]
            if skip >= 0:
                found, score = found[found != skip], score[found != skip]
            row, score = np.concatenate((best_row, found)), np.concatenate((best, score))
            if len(row) > 4 * self.k:
                near = score >= np.partition(score, len(score) - self.k)[len(score) - self.k] - 1e-9
                row, score = row[near], score[near]
            top = np.lexsort((row, -np.round(score, 9)))[: self.k]
            best_row, best = row[top], score[top]
        return best_row, best

    def vote(self, row: np.ndarray, cosine: np.ndarray) -> float:
        """The share of the toxic among the neighbours, by 1 / (0.05 + distance) less what that is at distance 1, and one vote for the prior.

        So neighbours that share next to nothing with the text decide nothing.
        """
        if not len(row):
            return self.prior
        w = self.rows_weight[row] * (1 / (0.05 + np.maximum(0.0, 1 - cosine)) - 1 / 1.05)
        return float(((w * self.labels[row]).sum() + self.prior) / (w.sum() + 1))

    def calibrated(self, vote: float) -> float:
        return float(np.interp(vote, *self.curve)) if len(self.curve[0]) else vote


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-decreasing curve of least squares through (x, y) with weights, by pooling neighbours that disagree.

    A pool counts two rows more that have its mean x as their y, so that few rows don't make a probability of 0 or 1.
    """
    order = np.argsort(x, kind="stable")
    pools: list[list[float]] = []
    for xi, yi, wi in zip(x[order].tolist(), y[order].tolist(), w[order].tolist()):
        pools.append([yi * wi, wi, xi, xi])
        while len(pools) > 1 and (pools[-2][3] == pools[-1][2] or pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]):
            top = pools.pop()
            pools[-1] = [pools[-1][0] + top[0], pools[-1][1] + top[1], pools[-1][2], top[3]]
    xs = [v for p in pools for v in p[2:]]
    ys = [(p[0] + p[2] + p[3]) / (p[1] + 2) for p in pools for _ in range(2)]
    return np.array(xs), np.maximum.accumulate(np.array(ys)) if ys else np.array(ys)


def _empty(prior: float, k: int) -> Index:
    none, zero = np.zeros(0), np.zeros(1, np.int64)
    whole = none.astype(np.int64)
    return Index(none.astype(np.uint64), none, whole, none, none, zero, whole, none, zero, whole, none, (none, none), prior, k)


def fit(docs: DataFrame, marks: DataFrame, per_class: int = 2000, k: int = 15) -> Index:
    """Learns from docs (doc_id, text) with marks (doc_id, toxic); all of docs gives the document frequencies.

    Rows of equal text and label are one example. Of each class about `per_class` examples are taken, those of least text hash (the hash
    only thins evenly, it is no input); an example counts as many as its class was thinned by. Their ids, bounded by that, are broadcast to
    find their texts. All their words are terms. The driver gets the examples' words, the tasks their index. Log odds of a term come from
    the examples, inverse document frequencies from all of docs. Ids decide nothing: examples are ordered by their texts.
    """
    text = [F.xxhash64("text").alias("h1"), F.xxhash64(F.lit("text"), "text").alias("h2")]
    known = docs.where("doc_id is not null and text is not null").select("doc_id", *text)
    labelled = known.join(marks.select("doc_id", (F.col("toxic") > 0).cast("int").alias("toxic")), "doc_id")
    labelled = common.staged(labelled.groupBy("h1", "h2", "toxic").agg(F.min("doc_id").alias("doc_id")), "labelled")
    total = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    prior = total.get(1, 0) / max(1, sum(total.values()))
    if len(total) < 2:
        return _empty(prior, k)
    share = {y: min(1.0, per_class / n) for y, n in total.items()}
    cut = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]) * (1 << 30)
    chosen = labelled.where(F.pmod("h1", F.lit(1 << 30)) < cut)
    found = docs.where("text is not null").select("doc_id", "text", *text)
    examples = found.join(F.broadcast(chosen), ["doc_id", "h1", "h2"]).dropDuplicates(["h1", "h2", "toxic"])

    @common.frugal
    def words(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _parts(rows, 4):
            h, text = term_hashes(texts)
            text, term, count = _counted(text, h)
            bounds = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32))
            lists = [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in (term.view(np.int64), count.astype(np.int32))]
            yield pa.record_batch([*(batch.column(j) for j in range(4)), *lists], names=["doc_id", "toxic", "h1", "h2", "term", "count"])

    rows = examples.select("doc_id", "toxic", "h1", "h2", "text").mapInArrow(words, "doc_id long, toxic int, h1 long, h2 long, term array<long>, count array<int>").toArrow().combine_chunks()
    rows = rows.sort_by([("h1", "ascending"), ("h2", "ascending"), ("toxic", "ascending")])
    labels = rows["toxic"].to_numpy()
    lists = rows["term"].combine_chunks()
    size = lists.value_lengths().to_numpy()
    term, count = lists.flatten().to_numpy().view(np.uint64), rows["count"].combine_chunks().flatten().to_numpy()
    n = np.bincount(labels, minlength=2)
    if not n.all() or not len(term):
        return _empty(prior, k)
    terms, term = np.unique(term, return_inverse=True)
    example = np.repeat(np.arange(len(labels)), size)
    idf = inverse_frequencies(docs, terms)
    a = np.bincount(term, weights=labels[example], minlength=len(terms))
    b = np.bincount(term, minlength=len(terms)) - a
    return _index(terms, idf * relevance(a, b, n), rows["doc_id"].to_numpy(), labels, {y: total[y] / n[y] for y in (0, 1)}, example, term, count, k)


def relevance(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of terms in `a` toxic and `b` clean examples of n[1] and n[0]: squared log odds, times z / (z + DOUBT) for their squared z-score z.

    A word of a few clean texts has log odds as large as a marker's, as clean texts are many, but is far less sure: among few examples, the plain
    square let clean neighbours that share only topic words outvote a marker.
    """
    odds = n[1] / n.sum()
    toxic, clean = a + SMOOTH * odds, b + SMOOTH * (1 - odds)
    square = np.log(toxic / clean * (1 - odds) / odds) ** 2
    z = square / (1 / toxic + 1 / clean)
    return square * z / (z + DOUBT)


def inverse_frequencies(docs: DataFrame, terms: np.ndarray) -> np.ndarray:
    """ln((1 + documents) / (1 + documents with the term)) + 1, over all of docs."""

    @common.frugal
    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(terms) + 1, np.int64)
        for _, texts in _parts(rows, 0):
            df[:-1] += np.bincount(_bags(texts, terms)[1], minlength=len(terms))
            df[-1] += len(texts)
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(at.astype(np.int64)), pa.array(df[at])], names=["at", "n"])

    df = np.zeros(len(terms) + 1)
    found = docs.select("text").mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    df[found["at"].to_numpy()] = found["n"].to_numpy()
    return np.log((1 + df[-1]) / (1 + df[:-1])) + 1


def _index(terms: np.ndarray, weight: np.ndarray, ids: np.ndarray, labels: np.ndarray, of_class: dict[int, float], example: np.ndarray, term: np.ndarray, count: np.ndarray, k: int) -> Index:
    """The index over the examples that have a term, given (example, term, count) sorted; the others give the prior of texts without any."""
    value = (1 + np.log(count)) * weight[term]
    norm = np.sqrt(np.bincount(example, weights=value * value, minlength=len(labels)))
    row_weight = np.where(labels > 0, of_class[1], of_class[0])
    without = norm == 0
    overall = (row_weight * labels).sum() / row_weight.sum()
    prior = float(((row_weight * labels)[without].sum() + overall) / (row_weight[without].sum() + 1))
    fits = ~without[example]
    example, term, value = example[fits], term[fits], value[fits] / norm[example[fits]]
    has = np.flatnonzero(~without)
    by = np.lexsort((-value, example))
    strongest = np.zeros(len(labels), np.int64)
    firsts = by[np.searchsorted(example[by], has)] if len(has) else has
    strongest[has] = term[firsts]
    order = has[np.lexsort((has, strongest[has]))]
    row_of = np.zeros(len(labels), np.int64)
    row_of[order] = np.arange(len(order))
    row = row_of[example]
    place = np.lexsort((row, term))
    blocks = max(1, -(-len(order) // BLOCK))
    key = term[place] * blocks + row[place] // BLOCK
    starts = np.flatnonzero(np.concatenate(([True], np.diff(key) != 0))[: len(key)])
    cell = key[starts]
    maxima = np.maximum.reduceat(value[place], starts) if len(starts) else np.zeros(0)
    cells = np.searchsorted(cell, np.arange(len(terms) + 1) * blocks)
    starts = np.append(starts, len(key))
    y = labels[order].astype(float)
    out = Index(terms, weight, ids[order], y, row_weight[order], cells, (cell % blocks).astype(np.int32), maxima, starts, row[place].astype(np.int32), value[place], (np.zeros(0), np.zeros(0)), prior, k)
    cut = np.searchsorted(example, np.arange(len(labels) + 1))
    votes = [out.vote(*out.nearest(term[cut[j] : cut[j + 1]], value[cut[j] : cut[j + 1]], skip=at)) for at, j in enumerate(order.tolist())]
    if votes:
        out.curve = isotonic(np.array(votes), y, out.rows_weight)
    return out


def score(docs: DataFrame, index: Index, evidence: int = 3, keep_text: bool = True) -> DataFrame:
    """Adds score, predicted and evidence (the nearest examples: doc_id, cosine, toxic) to docs, which has a column text.

    Without keep_text the text is not among the result's columns, and does not come back from the workers.

    A text without any term of the examples gets the share of toxic rows among the examples without terms, smoothed by the share among all;
    null and empty texts too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(index)
    added = ("score", "predicted", "evidence")
    rest = [c for c in docs.columns if c not in added and c != "text"]
    order = [c for c in docs.columns if c not in added and (c != "text" or keep_text)]

    @common.frugal
    def scored(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        known: dict[bytes, tuple[float, list]] = {}
        for batch, texts in _parts(rows, 1):
            out: list[tuple[float, list]] = [(index.prior, [])] * len(texts)
            text, term, count = _bags(texts, index.terms)
            cuts = np.flatnonzero(np.diff(text, prepend=-1))
            for a, z in zip(cuts.tolist(), [*cuts[1:].tolist(), len(text)]):
                key = hashlib.blake2b(term[a:z].tobytes() + count[a:z].tobytes(), digest_size=16).digest()
                if key not in known:
                    if len(known) > 5000:
                        known.clear()
                    row, cosine = index.nearest(term[a:z], index.vector(term[a:z], count[a:z]))
                    shown = [{"doc_id": int(index.ids[r]), "cosine": float(c), "toxic": int(index.labels[r])} for r, c in zip(row[:evidence], cosine)]
                    known[key] = index.calibrated(index.vote(row, cosine)) if len(row) else index.prior, shown
                out[text[a]] = known[key]
            score = np.clip([s for s, _ in out], 0, 1)
            kept = [batch.column(1)] if keep_text else []
            yield pa.record_batch([batch.column(0), *kept, pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array([e for _, e in out], pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())])))], names=["rest", *(["text"] if keep_text else []), *added])

    packed = docs.select(F.struct(F.lit(1).alias("__m_one"), *[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col("text").cast("string").alias("text"))
    made = packed.mapInArrow(scored, f"rest {packed.schema['rest'].dataType.simpleString()}, {'text string, ' if keep_text else ''}score double, predicted int, evidence array<struct<doc_id:long,cosine:double,toxic:int>>")
    return made.select(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in order], *added)


def held_out():
    return F.pmod(common.doc_crc("doc_id"), F.lit(5)) == 0


def toxicity(docs: DataFrame, labels: DataFrame, keep_text: bool = True, **parameters) -> DataFrame:
    """docs (doc_id, text and more) with held_out, score, predicted and evidence.

    Learns from the labelled rows that are not held out (crc32 of the id as text, modulo 5, not 0); a document that
    labels list more than once counts as toxic if any row says so. Null ids are never learnt from and are not held out. Without
    any labelled row of both classes every score is the labelled share of toxic rows, or 0. Scores depend on texts alone.
    """
    marks = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    with common.scope():
        index = fit(docs.select("doc_id", F.col("text").cast("string").alias("text")), marks.where(~held_out()), **parameters)
    return score(docs.withColumn("held_out", F.coalesce(held_out(), F.lit(False))), index, keep_text=keep_text)
