"""Language identification by a byte convolutional network, trained in numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marginalia.llm import common

WINDOW = 256
_PERHAPS = re.compile(r"[^\W\d_]")
_AT_ONCE = 256


def has_letter(text: str) -> bool:
    """Whether a code point of the text is in Unicode's category L (the pattern alone also takes numbers such as ½)."""
    return any(m[0].isalpha() for m in _PERHAPS.finditer(text))


class ByteCNN:
    """Byte embedding, filters of several widths with ReLU, max pooling over a window, softmax."""

    def __init__(self, classes: list[str], widths: tuple[int, ...] = (2, 3, 4), filters: int = 16, size: int = 8, seed: int = 7) -> None:
        r = np.random.default_rng(seed)
        self.classes, self.widths = classes, widths
        self.p = {"E": r.normal(0, 0.5, (256, size)), "b": np.zeros(len(classes))}
        for w in widths:
            self.p[f"W{w}"] = r.normal(0, (2 / (w * size)) ** 0.5, (w * size, filters))
            self.p[f"c{w}"] = np.zeros(filters)
        self.p["U"] = r.normal(0, 0.1, (filters * len(widths), len(classes)))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _patches(self, e: np.ndarray, w: int) -> np.ndarray:
        n, length, size = e.shape
        view = np.lib.stride_tricks.as_strided(e, (n, length - w + 1, w * size), e.strides)
        return view.reshape(n * (length - w + 1), w * size)

    def _pooled(self, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        e = np.ascontiguousarray(self.p["E"][x])
        pooled, where = [], []
        for w in self.widths:
            h = (self._patches(e, w) @ self.p[f"W{w}"]).reshape(len(x), x.shape[1] - w + 1, -1)
            at = h.argmax(1) if self.training else None
            top = h.max(1) + self.p[f"c{w}"]
            pooled.append(np.maximum(top, 0))
            where.append(at)
        return np.concatenate(pooled, 1), where

    training = False

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(windows, classes) of windows of bytes."""
        out = []
        for a in range(0, len(x), _AT_ONCE):
            z = self._pooled(x[a : a + _AT_ONCE])[0] @ self.p["U"] + self.p["b"]
            z = np.exp(z - z.max(1, keepdims=True))
            out.append(z / z.sum(1, keepdims=True))
        return np.concatenate(out) if out else np.zeros((0, len(self.classes)), np.float32)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross-entropy of windows x with classes y, by each parameter."""
        n, size = len(x), self.p["E"].shape[1]
        self.training = True
        pooled, where = self._pooled(x)
        self.training = False
        z = pooled @ self.p["U"] + self.p["b"]
        z = np.exp(z - z.max(1, keepdims=True))
        dz = z / z.sum(1, keepdims=True)
        dz[np.arange(n), y] -= 1
        dz /= n
        g = {"U": pooled.T @ dz, "b": dz.sum(0), "E": np.zeros_like(self.p["E"])}
        dh = (dz @ self.p["U"].T) * (pooled > 0)
        at = 0
        for w, top in zip(self.widths, where):
            d = dh[:, at : at + top.shape[1]]
            at += top.shape[1]
            bytes_ = x[np.arange(n)[:, None, None], top[:, :, None] + np.arange(w)]  # (windows, filters, w)
            patch = self.p["E"][bytes_].reshape(n, top.shape[1], w * size)
            g[f"W{w}"] = np.einsum("bfk,bf->kf", patch, d)
            g[f"c{w}"] = d.sum(0)
            back = d[:, :, None] * self.p[f"W{w}"].T[None]
            np.add.at(g["E"], bytes_.reshape(-1), back.reshape(-1, size))
        return g

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = 500, batch: int = 64, rate: float = 0.01, seed: int = 11) -> None:
        """Adam on the cross-entropy of windows x with classes y."""
        r = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for step in range(1, steps + 1):
            pick = r.integers(0, len(x), batch)
            g = self.gradients(x[pick], y[pick])
            lr = rate * min(1, 2 * (1 - step / (steps + 1)))
            for k in self.p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.99 * s[k] + 0.01 * g[k] ** 2
                self.p[k] -= (lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.99**step)) + 1e-7)).astype(np.float32)


def windows(data: bytes) -> np.ndarray:
    """The whole text in windows of WINDOW bytes; the last is filled up with zeros."""
    n = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def fit(learnt: DataFrame, per_language: int = 1500, windows_each: int = 4) -> ByteCNN | None:
    """A network from (text, lang): about `per_language` distinct texts of each language, chosen by their hash, and `windows_each` windows of each.

    These bound what the driver gets for a language. None if there is no labelled text.
    """
    learnt = learnt.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"), F.xxhash64(F.lit("text"), "text").alias("h2"))
    with common.scope():
        distinct = common.staged(learnt.groupBy("lang", "h", "h2").agg(F.lit(1).alias("one")).drop("one"), "learnt")
        # a text that repeats counts once, so that what the driver gets is bounded whatever repeats
        cut = (F.least(F.lit(1.0), per_language / F.count("*")) * (1 << 30)).alias("cut")
        shares = distinct.groupBy("lang").agg(cut)
        chosen = distinct.join(shares, "lang").where(F.pmod("h", F.lit(1 << 30)) < F.col("cut")).select("lang", "h", "h2")
        sample = learnt.join(chosen, ["lang", "h", "h2"]).dropDuplicates(["lang", "h", "h2"]).select("text", "lang")
        return _trained(sample, windows_each)


def _trained(sample: DataFrame, windows_each: int) -> ByteCNN | None:
    def picked(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            lang, out = [], []
            for text, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if has_letter(text):
                    data = windows(text.encode())
                    r = np.random.default_rng(len(text))
                    for k in r.permutation(len(data))[:windows_each]:
                        lang.append(name)
                        out.append(data[k].tobytes())
            yield pa.record_batch([pa.array(lang, pa.string()), pa.array(out, pa.binary())], names=["lang", "w"])

    found = sorted((r["lang"], bytes(r["w"])) for r in sample.mapInArrow(picked, "lang string, w binary").collect())
    if not found:
        return None
    classes = sorted({c for c, _ in found})
    of = {c: [w for name, w in found if name == c] for c in classes}
    most = max(map(len, of.values()))
    even = [(k, w) for k, c in enumerate(classes) for w in (of[c] * -(-most // len(of[c])))[:most]]
    network = ByteCNN(classes)
    network.train(np.frombuffer(b"".join(w for _, w in even), np.uint8).reshape(-1, WINDOW), np.array([k for k, _ in even]))
    return network


def identify(docs: DataFrame, network: ByteCNN | None) -> DataFrame:
    """Adds lang_pred and score to docs, which has a column text: the class of greatest mean probability over all windows, and that mean.

    Null texts and texts without a letter are `und` with score 0, and so is every text if nothing was learnt.
    """
    shared = docs.sparkSession.sparkContext.broadcast(network)
    rest = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def named(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = shared.value
        for batch in rows:
            lang, score = ["und"] * len(batch), np.zeros(len(batch))
            texts = batch.column(1).to_pylist()
            group: list[tuple[int, bytes]] = []
            size = 0

            def flush() -> None:
                if not group:
                    return
                cut = [windows(d) for _, d in group]
                filled = [np.minimum(WINDOW, len(d) - WINDOW * np.arange(len(c))) for (_, d), c in zip(group, cut)]
                p = network.probabilities(np.concatenate(cut)) * np.concatenate(filled)[:, None]
                p = np.add.reduceat(p, np.cumsum([0] + [len(c) for c in cut[:-1]]), axis=0)
                for (k, d), row in zip(group, p / p.sum(1, keepdims=True)):
                    lang[k], score[k] = network.classes[int(row.argmax())], float(row.max())
                group.clear()

            for k, text in enumerate(texts):
                if network and text and has_letter(text):
                    group.append((k, text.encode()))
                    size += len(text)
                    if size > 1 << 20:
                        flush()
                        size = 0
            flush()
            yield pa.record_batch([batch.column(0), pa.array(lang), pa.array(np.clip(score, 0, 1))], names=["rest", "lang_pred", "score"])

    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col("text").cast("string").alias("text"))
    made = packed.mapInArrow(named, f"rest {packed.schema['rest'].dataType.simpleString()}, lang_pred string, score double")
    return made.select(*[F.col(f"rest.`{c}`") for c in rest], "lang_pred", "score")


def held_out():
    return F.pmod(common.doc_crc("doc_id"), F.lit(4)) == 2


def language(docs: DataFrame, **parameters) -> DataFrame:
    """docs (doc_id, text, lang and more) with held_out, lang_pred and score.

    Learns from texts whose lang is not null and whose id's crc32 (as text) modulo 4 is not 2; null ids are neither held out nor
    learnt from. Predictions depend on texts alone.
    """
    network = fit(docs.where(~held_out()), **parameters)
    return identify(docs.withColumn("held_out", F.coalesce(held_out(), F.lit(False))), network)
