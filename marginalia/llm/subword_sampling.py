"""SentencePiece encoding and decoding, and distinct sampled segmentations by Gumbel top-k over the lattice.

The lattice of a text has a node at each code point and an arc for each piece that fits. A segmentation's
weight is the product of its pieces' weights. Perturbed A-star search: each partial segmentation carries the log mass of
all its completions, known exactly from one backward pass, and the greatest Gumbel-perturbed weight among
them; a parent's maximum is dealt to its children conditionally, so the best-first search pops whole
segmentations in the order of their perturbed weights. That is sampling without replacement, without listing them.
"""

from __future__ import annotations

import functools
import heapq
import math
import random
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
_KNOWN_WORDS = 50_000


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A SentencePiece model's pieces with log weights.

    Merge-ranked pieces have no probabilities, so rank r weighs as 1 / (r + 1) ** power (Zipf's law). Single bytes stand for characters
    without a piece and weigh as the rarest piece each.
    """

    def __init__(self, path: str, power: float = 1.0) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        sp, n = self.model, self.model.vocab_size()
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
        ranked = sorted((i for i in range(n) if i not in special), key=lambda i: (-sp.get_score(i), i))
        self.weight = {sp.id_to_piece(i): (i, -power * math.log(r + 1)) for r, i in enumerate(ranked, 1)}
        self.floor = -power * math.log(len(ranked) + 1)
        self.longest = max(map(len, self.weight))
        self.text_of = {i: p for p, (i, _) in self.weight.items()}
        self.byte_of = {i: b for b, i in enumerate(self.bytes)}
        self.words: dict[str, list] = {}

    def prepared(self, text: str) -> str:
        """The text as the model sees it: a space before it, spaces as SPACE; empty stays empty."""
        return SPACE + text.replace(" ", SPACE) if text else ""

    def word_arcs(self, word: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """From each place of a word: (code points, log weight, ids) of the pieces that fit."""
        if word in self.words:
            return self.words[word]
        out = []
        for a in range(len(word)):
            arcs = []
            for z in range(a + 1, min(len(word), a + self.longest) + 1):
                if found := self.weight.get(word[a:z]):
                    arcs.append((z - a, found[1], (found[0],)))
            if not arcs or arcs[0][0] != 1:
                raw = word[a].encode("utf-8", "replace")
                arcs.insert(0, (1, self.floor * len(raw), tuple(self.bytes[b] for b in raw)))
            out.append(arcs)
        if len(self.words) >= _KNOWN_WORDS:
            self.words.clear()
        self.words[word] = out
        return out

    def arcs(self, text: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """Arcs of a prepared text. Pieces hold SPACE only at their start or are runs of it, so words part the lattice."""
        out, at = [], 0
        while at < len(text):
            end = at
            while end < len(text) and text[end] == SPACE:
                end += 1
            stop = text.find(SPACE, end)
            stop = len(text) if stop < 0 else stop
            out += self.word_arcs(text[at:stop])
            at = stop
        return out

    def encode(self, text: str) -> list[int]:
        """The model's own segmentation."""
        return self.model.encode(text)

    def decode(self, ids: list[int]) -> str:
        """The text of any segmentation; bytes that are no UTF-8 become U+FFFD."""
        out = bytearray()
        for i in ids:
            if i in self.byte_of:
                out.append(self.byte_of[i])
            else:
                out += self.text_of[i].encode()
        text = out.decode("utf-8", "replace").replace(SPACE, " ")
        return text[1:] if text.startswith(" ") else text


@functools.cache
def pieces(path: str, power: float = 1.0) -> Pieces:
    return Pieces(path, power)


def masses(arcs: list) -> list[float]:
    """Log of the summed weights of all segmentations from each place to the end."""
    beta = [0.0] * (len(arcs) + 1)
    for a in range(len(arcs) - 1, -1, -1):
        values = [w + beta[a + n] for n, w, _ in arcs[a]]
        top = max(values)
        beta[a] = top if len(values) == 1 else top + math.log(sum([math.exp(v - top) for v in values]))
    return beta


def sample(arcs: list, k: int, seed: int) -> tuple[list[tuple[float, float, list[int]]], float]:
    """The k + 1 segmentations of greatest perturbed log probability, as k of (perturbed, log probability, ids) and the last's perturbed value.

    That value is -inf if there are no more than k segmentations; k of them or fewer come in the order of perturbed values.
    """
    beta = masses(arcs)
    draw = random.Random(seed)
    end, whole = len(arcs), beta[0]
    log, exp, uniform = math.log, math.exp, draw.random

    def gumbel(mean: float) -> float:
        return mean - log(-log(draw.random() or 5e-324))

    root = gumbel(0.0)
    heap = [(-root, 0, 0, 0.0, None)]
    best = [-math.inf] * k + [root]  # the k + 1 greatest maxima of disjoint subtrees so far: what is less can't be among the results
    found, count = [], 1
    while heap:
        negative, _, at, weight, path = heapq.heappop(heap)
        top = -negative
        while at < end:  # the child that inherits the maximum goes on at once
            choices = arcs[at]
            if len(choices) == 1:
                n, w, ids = choices[0]
                at, weight, path = at + n, weight + w, (path, ids)
                continue
            base = weight - whole
            drawn = [base + w + beta[at + n] - log(-log(uniform() or 5e-324)) for n, w, _ in choices]
            most = max(drawn)
            first = drawn.index(most)
            least = best[0]
            for j, g in enumerate(drawn):
                if j == first or most - g > 0.7 and g + 0.7 < least:  # its value is less than g + ln 2
                    continue
                n, w, ids = choices[j]
                v = top - g + log(-math.expm1(g - most)) if g < most else -math.inf
                value = top - max(0.0, v) - math.log1p(exp(-abs(v))) if v > -math.inf else top
                if value >= least:
                    heapq.heappush(heap, (-value, count, at + n, weight + w, (path, ids)))
                    heapq.heapreplace(best, value)
                    least = best[0]
                    count += 1
            n, w, ids = choices[first]
            at, weight, path = at + n, weight + w, (path, ids)
        if len(found) == k:
            return found, top
        parts = []
        while path:
            path, ids = path
            parts.append(ids)
        found.append((top, weight - whole, [i for ids in reversed(parts) for i in ids]))
    return found, -math.inf


def inclusion(log_probability: float, threshold: float) -> float:
    """The probability that a perturbed weight passes the threshold: a sample's weight in estimates is probability / inclusion."""
    return 1.0 if threshold == -math.inf else -math.expm1(-math.exp(min(700.0, log_probability - threshold)))


def sampled_segmentations(rows: DataFrame, key_cols: list[str], text_col: str = "text", k: int = 3, seed: int = 20, power: float = 1.0, path: str | None = None) -> DataFrame:
    """One row for each sampled segmentation of each text: all columns but the text's, and sample (from 1), ids, log_prob, perturbed, inclusion, round_trip.

    Segmentations of a row are distinct; a text with fewer than `k` gives all it has, and a null or empty text gives one, of no
    pieces. Draws are seeded by crc32 of the row's key columns and `seed`, so they don't depend on the partitioning,
    and rows that repeat a key draw alike. round_trip says that the ids decode to the
    very text; a text that holds SPACE itself does not come back, as the model reads that as a blank. Whole texts are
    segmented; memory follows one text. Columns of rows that have an added name are replaced.
    """
    path = path or model_path()
    added = ["sample", "ids", "log_prob", "perturbed", "inclusion", "round_trip"]
    rest = [c for c in rows.columns if c not in added and c != text_col]
    key = F.crc32(F.to_json(F.struct(*[F.col(f"`{c}`") for c in key_cols]), {"ignoreNullFields": "false"}).cast("binary"))
    packed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rest]).alias("rest"), F.col(text_col).cast("string").alias("text"), key.alias("key"))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = pieces(path, power)
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                row, out = [], {c: [] for c in added}
                for r, (text, key) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())):
                    text = text or ""
                    found, threshold = sample(of.arcs(of.prepared(text)), k, zlib.crc32(str(seed).encode(), key))
                    for j, (perturbed, log_prob, ids) in enumerate(found, 1):
                        row.append(r)
                        for c, v in zip(added, (j, ids, log_prob, perturbed, inclusion(log_prob, threshold), of.decode(ids) == text)):
                            out[c].append(v)
                kinds = (pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.float64(), pa.float64(), pa.bool_())
                yield pa.record_batch([batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(out[c], t) for c, t in zip(added, kinds))], names=["rest", *added])

    made = packed.mapInArrow(emit, f"rest {packed.schema['rest'].dataType.simpleString()}, sample int, ids array<int>, log_prob double, perturbed double, inclusion double, round_trip boolean")
    return made.select(*[F.col(f"rest.`{c}`") for c in rest], *added)
