"""Plain versions of the operators, over rows in memory."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def near(rows, percent=85, k=5):
    """(n, component) of each (id, text)."""
    sets = []
    for _, t in rows:
        w = WORD.findall((t or "").translate(FOLD))
        sets.append(frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(sets[a] & sets[b])
            if i and 100 * i >= percent * (len(sets[a]) + len(sets[b]) - i):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for x, (d, _) in enumerate(rows):
        least[find(x)].append(d)
    low = {c: min((d for d in ds if d is not None), default=None) for c, ds in least.items()}
    return [(len(sets[x]), low[find(x)] if sets[x] else rows[x][0]) for x in range(len(rows))]


def repeats(rows, length=20):
    """(n_words, n_removed, kept text) of each (id, text); null ids last."""
    last = 1 << 63
    docs = [(last if d is None else d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, w in docs:
        for i in range(len(w) - length + 1):
            g = tuple(w[i : i + length])
            first[g] = min(first.get(g, (d, i)), (d, i))
    out = []
    for d, w in docs:
        gone = set()
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < (d, i):
                gone.update(range(i, i + length))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def lines(rows, least=10, chars=1):
    """(n_lines, n_dropped, kept text) of each (id, text); equal rows count once."""
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    seen = defaultdict(set)
    for d, t in rows:
        for x in (t or "").split("\n"):
            seen[key(x)].add((d, t))
    bad = {k for k, ds in seen.items() if len(k) >= chars and len(ds) >= least}
    out = []
    for _, t in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if key(x) not in bad]
        out.append((len(all_), len(all_) - len(kept), "\n".join(kept)))
    return out


def exact(rows):
    """(keep_id, size, sha) of each (id, text)."""
    norm = [(t or "").translate(FOLD) for _, t in rows]
    groups = defaultdict(list)
    for (d, _), t in zip(rows, norm):
        groups[t].append(d)
    return [(max((d for d in groups[t] if d is not None), default=None), len(groups[t]), sha(t)) for t in norm]
