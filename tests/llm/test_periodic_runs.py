import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginalia.llm import common, periodic_runs, queries

from .brute import WORD, sha


def plain_runs(words, least=6, times=4):
    """Every run, by trying all stretches of each period and its smallest period by definition."""
    out, n = [], len(words)
    for q in range(1, n // times + 1):
        a = 0
        while a + q < n:
            z = a
            while z + q < n and words[z] == words[z + q]:
                z += 1
            if z > a and z + q - a >= max(least, times * q):
                span = words[a : z + q]
                smallest = next(p for p in range(1, len(span) + 1) if all(span[i] == span[i + p] for i in range(len(span) - p)))
                if smallest == q:
                    out.append((a, len(span), q))
            a = max(z, a) + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain(doc_id, text):
    """The contract's row of a document, word by word."""
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    run = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *run, sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = common.table(spark, sf, "documents").select("doc_id", "text").collect()
    got = queries.op13_periodic_runs(spark, sf)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(plain(d, t) for d, t in docs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 9)), max_size=6))
def test_runs_of_random_repeats(parts):
    ids = [x for word, times in parts for x in word * times]
    assert periodic_runs.runs_of(np.array(ids, np.int32)) == plain_runs(ids)


@pytest.mark.parametrize("kinds", [1, 3, 40, 3000])
def test_lag_counts(kinds):
    r = np.random.default_rng(kinds)
    ids = (r.integers(0, kinds, 3000) * r.integers(0, 2, 3000)).astype(np.int32)
    got = periodic_runs.lag_counts(ids, 750)
    assert got.tolist() == [0] + [int((ids[q:] == ids[:-q]).sum()) for q in range(1, 751)]


def test_heavy_and_light_words_are_both_counted():
    count = np.array([5000, 3, 2, 2, 1])
    assert periodic_runs._heavy(count, 8192).tolist() == [0]
    assert len(periodic_runs._heavy(np.ones(50, np.int64), 64)) == 0


def test_words_of_pieces():
    r = random.Random(3)
    text = "".join(r.choice(["a", "bc", "é", " ", "\n", "\x0b", "\x85", "\xa0"]) for _ in range(4000)).encode()
    words = [w.encode() for w in WORD.findall(text.decode())]
    assert [w for part in periodic_runs.pieces(text, 7) for w in part] == words
    ids = periodic_runs.word_ids(periodic_runs.pieces(text, 7))
    assert len(ids) == len(words) and len(set(zip(ids.tolist(), words))) == len(set(words)) == len(set(ids.tolist()))


def test_odd_rows(spark, odd_docs, odd_rows, no_docs):
    got = periodic_runs.periodic_runs(odd_docs, planted=True)
    assert set(odd_docs.columns) <= set(got.columns)
    want = sorted(plain(d, t)[1:2] + plain(d, t)[6:] for d, t, *_ in odd_rows if len(t or "") < 10**5 and d is not None)
    rows = got.where("length(coalesce(text, '')) < 100000 and doc_id is not null").select("n_runs", "runs_sha256", "collapsed_sha256").collect()
    assert sorted(map(tuple, rows)) == want
    assert got.count() == len(odd_rows) and got.where("doc_id is null").collect()[0].collapsed == "null id text"
    assert periodic_runs.periodic_runs(no_docs).count() == 0


def test_long_text_with_a_hot_word(spark):
    text = "x " * 200_000 + " ".join(f"w{k % 50}" for k in range(100_000))
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = periodic_runs.periodic_runs(docs).collect()[0]
    assert [tuple(r) for r in row.runs] == [(0, 200_000, 1), (200_000, 100_000, 50)]
    assert row.collapsed == "x " + " ".join(f"w{k}" for k in range(50))
    assert row.collapsed_sha256 == hashlib.sha256(row.collapsed.encode()).hexdigest()


def test_longest_ties(spark):
    docs = spark.createDataFrame([(1, "a a a a a a b c c c c c c"), (2, "z")], "doc_id long, text string")
    rows = periodic_runs.periodic_runs(docs).withColumn("best", periodic_runs.longest()).select("doc_id", F.col("best.start"), "n_runs").orderBy("doc_id").collect()
    assert [tuple(r) for r in rows] == [(1, 0, 2), (2, None, 0)]
