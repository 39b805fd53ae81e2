"""Byte-level BPE ids of whole texts, a batch at a time: split into pieces with numpy, tokenize each distinct piece once."""

from __future__ import annotations

import functools
import os
import re
import sys
import unicodedata
from array import array

import numpy as np
import pandas as pd

from marginalia.llm.common import point_hashes

#: Fixed values of the vocabulary's split pattern: what may follow an apostrophe in one piece, and white space.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
WHITE = (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_MAX_KNOWN = 80_000
_AT_ONCE = 1 << 14


@functools.cache
def _classes() -> np.ndarray:
    """Of each code point: 0 white space, 1 letter, 2 number, 3 other."""
    of = {"L": 1, "N": 2}
    out = np.array([of.get(unicodedata.category(chr(c))[0], 3) for c in range(sys.maxunicode + 1)], np.uint8)
    out[list(WHITE)] = 0
    return out


def piece_starts(cp: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Where the pieces of the split pattern start, in code points of texts laid end to end; firsts: each text's start."""
    kind = _classes()[cp]
    n = len(cp)
    first = np.zeros(n, bool)
    first[firsts[firsts < n]] = True
    before = np.concatenate(([9], kind[:-1])).astype(np.uint8)
    before[first] = 9
    start = first | (kind != before)
    meets = np.flatnonzero((kind != 0) & (before == 0))  # a word after white space
    start[meets - 1] = True
    start[meets[cp[meets - 1] == 0x20]] = False
    quote = np.flatnonzero((cp == 0x27) & start)
    for at in quote.tolist():
        for tail in CONTRACTIONS:
            end = at + 1 + len(tail)
            if end <= n and not first[at + 1 : end].any() and all(cp[at + 1 + k] == ord(x) for k, x in enumerate(tail)):
                start[at + 1] = False
                if end < n and not start[end]:
                    start[end] = True
                break
    return np.flatnonzero(start)


def _distinct(cp: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each piece the number of its content, and of each content one piece that has it. The pieces follow one another without gaps.

    Hashes propose equal pieces, and whole contents are compared; pieces that only share a hash are told apart one by one.
    """
    which, distinct = pd.factorize(point_hashes(cp, starts, ends))
    where = np.empty(len(distinct), np.int64)
    where[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    size = ends - starts
    other = size[where[which]] != size
    first = np.where(other, starts, starts[where[which]])
    same = cp[np.repeat(first - starts, size) + np.arange(len(cp))] == cp
    other |= ~np.logical_and.reduceat(same, starts)
    if other.any():
        apart: dict[bytes, int] = {}
        more = []
        for k in np.flatnonzero(other).tolist():
            content = cp[starts[k] : ends[k]].tobytes()
            if content not in apart:
                apart[content] = len(where) + len(more)
                more.append(k)
            which[k] = apart[content]
        where = np.append(where, more).astype(np.int64)
    return which, where


class BatchTokenizer:
    """Ids of texts by a file of the `tokenizers` library (byte-level BPE), without the tokens that it would add around a text.

    The library makes all ids. It is asked for each distinct piece of the split pattern once, as a piece alone gives the ids that it has
    in a text. The pieces of late are remembered: _MAX_KNOWN, and as many that came before and were used since. The file's added tokens are found in texts as the library finds them: a text
    is split at them first.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the tasks are the parallel part
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = {}
        for number, token in self.tokenizer.get_added_tokens_decoder().items():
            if token.lstrip or token.rstrip or token.single_word:
                raise ValueError(f"added tokens that take in what is around them are not supported: {token.content}")
            self.added[token.content] = np.array([number], np.uint32)
        self.split = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def _encoded(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces. Joined by an added token, which no piece holds and which parts what is around it, they are one call to the library."""
        out = []
        for at in range(0, len(pieces), _AT_ONCE):
            some = pieces[at : at + _AT_ONCE]
            if not self.added:
                out += [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                continue
            token, number = next(iter(self.added.items()))
            ids = np.array(self.tokenizer.encode_batch_fast([token.join(some)], add_special_tokens=False)[0].ids, np.uint32)
            raw, cuts = ids.tobytes(), (4 * np.flatnonzero(ids == number)).tolist()
            out += [raw[a:z] for a, z in zip([0, *(c + 4 for c in cuts)], [*cuts, len(raw)])]
        return out

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > _MAX_KNOWN:
            self.known, self.before = {}, self.known
        known, before = self.known, self.before
        new = [p for p in pieces if p not in known]
        if new:
            asked = []
            for p in new:
                if found := before.get(p):
                    known[p] = found
                else:
                    asked.append(p)
            asked = list(dict.fromkeys(asked))
            known.update(zip(asked, self._encoded(asked)))
        return [known[p] for p in pieces]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """Of each text its ids, as unsigned 32-bit numbers."""
        if not self.split or not any(token in t for token in self.added for t in texts):
            return self._ids(texts)
        parts = [self.split.split(t) for t in texts]
        plain = iter(self._ids([x for p in parts for x in p[::2]]))
        return [np.concatenate([self.added[x] if k % 2 else next(plain) for k, x in enumerate(p)]) for p in parts]

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        whole = "".join(texts)
        if not whole:
            return [np.zeros(0, np.uint32) for _ in texts]
        lengths = np.array([len(t) for t in texts], np.int64)
        firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
        cp = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = piece_starts(cp, firsts)
        ends = np.append(starts[1:], len(cp))
        which, where = _distinct(cp, starts, ends)
        found = self._pieces([whole[a:b] for a, b in zip(starts[where].tolist(), ends[where].tolist())])
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), np.uint32)
        of_piece = sizes[which]
        ends_at = np.cumsum(of_piece)
        source = np.repeat((np.cumsum(sizes) - sizes)[which] - (ends_at - of_piece), of_piece) + np.arange(int(ends_at[-1]))
        out = flat[source]
        until = np.concatenate(([0], ends_at))[np.searchsorted(starts, firsts + lengths)]
        return np.split(out, until[:-1])


@functools.cache
def batch_tokenizer(path: str) -> BatchTokenizer:
    """One for each worker process, so that pieces stay known from task to task."""
    return BatchTokenizer(path)


def in_groups(texts: list[str], most: int = 1 << 20):
    """(from, to) of consecutive texts with about `most` characters together."""
    at, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(texts):
        yield at, len(texts)
