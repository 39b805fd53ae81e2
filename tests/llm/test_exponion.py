import hashlib
import threading
from fractions import Fraction

import numpy as np
import pytest

from marginalia.llm import common, exponion


def plain(rows, dims, clusters, rounds, seed="2:", scale=256):
    """Lloyd's rounds in fractions and Python's whole numbers, with every distance."""
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(c is not None and np.isfinite(c) for c in v):
            kept.append((i, v, tuple((Fraction(c) * scale).__floor__() for c in v)))
    first = sorted((i is None, hashlib.sha256(f"{seed}{i}".encode()).hexdigest() if i is not None else "", v, w) for i, v, w in kept)[:clusters]
    c = [w for *_, w in first]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda w: min((square(w, m), k) for k, m in enumerate(c))[::-1]
    for _ in range(rounds):
        own = [nearest(w)[0] for *_, w in kept]
        for k in range(len(c)):
            of = [w for (*_, w), a in zip(kept, own) if a == k]
            if of:
                c[k] = tuple(sum(x) // len(of) for x in zip(*of))
    found = [nearest(w) for *_, w in kept]
    shown = lambda x: max(-(1 << 63), min((1 << 63) - 1, x))
    total = sum(d for _, d in found)
    return sorted(((i, k, shown(d), shown(sum(e for a, e in found if a == k)), shown(total), hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest()) for (i, *_), (k, d) in zip(kept, found)), key=str)


def run(spark, rows, dims, clusters, rounds):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster string").repartition(3)
    return sorted(map(tuple, exponion.cluster(df, dims=dims, clusters=clusters, rounds=rounds).collect()), key=str)


def table(vectors):
    return [(k, None if v is None else [None if c is None else float(c) for c in v], "clash") for k, v in enumerate(vectors)]


R = np.random.default_rng(4)
CASES = {
    "spread": [R.normal(size=4) for _ in range(300)],
    "grid with ties": [[x / 2, y / 2, 0, 0] for x in range(12) for y in range(12)],
    "one hot vector": [[1, 2, 3, 4]] * 250 + [R.normal(size=4) for _ in range(50)],
    "left out": [[1, 2, 3], None, [1, 2, 3, None], [1, 2, 3, np.nan], [1, 2, 3, np.inf], [1, 2, 3, 4, 5], [], [1, 2, 3, 4], [-1e-300, 0, 0.1, -0.1]],
    "wide among narrow": [R.normal(size=4) for _ in range(60)] + [R.normal(size=4) * 1e9 for _ in range(20)] + [[1e15, 1e15 + 1, 0, 0], [1e15 + 2, 1e15, 0, 0]],
    "beyond doubles": [R.normal(size=4) for _ in range(30)] + [[1e308, -1e308, 1, 0], [1.7e308, 0, 0, 0], [1e200, 1, 1, 1], [1e200, 1, 1, 2], [-1e160, 0, 0, 0]],
}


@pytest.mark.parametrize("name", CASES)
def test_equals_plain_rounds(spark, name):
    rows = table(CASES[name])
    assert run(spark, rows, 4, 7, 5) == plain([r[:2] for r in rows], 4, 7, 5)


def test_one_cluster_and_null_or_repeated_ids(spark):
    rows = [(3, [1.0, 2.0], ""), (3, [5.0, 2.0], ""), (None, [9.0, 9.0], ""), (4, [1.0, 2.0], ""), (None, [0.0, 0.5], "")]
    for clusters in (1, 2, 9):
        assert run(spark, rows, 2, clusters, 3) == plain([r[:2] for r in rows], 2, clusters, 3)


def test_empty_table(spark):
    assert run(spark, [], 4, 7, 5) == [] and run(spark, table([None, [1]]), 4, 7, 5) == []


def test_bounds_spare_scans_and_hold(spark):
    """Later rounds compute fewer distances than all, and the bounds are bounds."""
    r = np.random.default_rng(6)
    middles = r.normal(size=(20, 8)) * 30
    x = np.floor((middles[r.integers(0, 20, 2000)] + r.normal(size=(2000, 8))) * 4)
    v = exponion.Vectors(*exponion.Vectors.packed(x, 1), 8, 1)
    start = x[:20].astype(int).tolist()
    search = exponion.Search(now := exponion.Centroids(start))
    own, upper, lower = search.all_(v)
    for _ in range(4):
        moved = [np.floor(x[own == k].mean(0)).astype(int).tolist() if (own == k).any() else now.whole[k].tolist() for k in range(20)]
        now = exponion.Centroids(moved, now)
        search = exponion.Search(now)
        own, upper, lower = search.again(v, own, upper, lower)
        far = np.sqrt(((x[:, None] - np.array(moved)[None]) ** 2).sum(2))
        assert (own == far.argmin(1)).all() and (upper >= far.min(1)).all()
        far[np.arange(len(x)), own] = np.inf
        assert (lower <= far.min(1)).all()
    assert search.scanned < 0.25 * x.shape[0] * 20


def test_limbs():
    for x in (0, 5, -5, 1 << 32, -(1 << 70) + 3, 10**300):
        assert sum(v << (32 * n) for n, v in exponion._limbs(x)) == x


def test_scopes_of_two_threads_keep_their_tables(spark):
    """Each thread's scope deletes its own tables and no other's."""
    inside, leave, seen = threading.Event(), threading.Event(), {}

    def one():
        with common.scope():
            kept = common.staged(spark.range(5), "a")
            inside.set()
            leave.wait(60)
            seen["first"] = kept.count()

    def two():
        inside.wait(60)
        with common.scope():
            seen["second"] = common.staged(spark.range(7), "b").count()
        leave.set()

    threads = [threading.Thread(target=f) for f in (one, two)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert seen == {"first": 5, "second": 7}


def test_release(spark):
    with common.scope():
        kept, gone = common.staged(spark.range(5), "a"), common.staged(spark.range(6), "b")
        common.release(gone)
        common.release(spark.range(3))
        assert kept.count() == 5
        with pytest.raises(Exception):
            gone.count()
