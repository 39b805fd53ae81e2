import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marginalia.llm import common, grace_dedup, line_dedup, minmax_dedup, substring_dedup

from . import brute
from .conftest import DOCS, sentence


def pairs(rows):
    return [(r[0], r[1]) for r in rows]


# --- hashing -----------------------------------------------------------------------------------------------------------


def test_word_hashes_do_not_depend_on_chunks(odd_rows, monkeypatch):
    texts = [(t or "").encode() for _, t in pairs(odd_rows)]
    h, firsts = common.word_hashes(texts, lower=True)
    words = [brute.WORD.findall((t or "").translate(brute.FOLD)) for _, t in pairs(odd_rows)]
    assert np.diff(firsts).tolist() == [len(w) for w in words]
    flat = [x for w in words for x in w]
    for one in h:
        assert len(set(flat)) == len(np.unique(one)) and len(set(zip(flat, one.tolist()))) == len(set(flat))
    monkeypatch.setattr(common, "_CHUNK", 997)
    again, f2 = common.word_hashes(texts, lower=True)
    assert (again == h).all() and (f2 == firsts).all()


# --- exact dedup -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("budget", [48 << 20, 400])
def test_exact_dedup(odd_docs, odd_rows, budget):
    rows = pairs(odd_rows)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in grace_dedup.exact_dedup(odd_docs, budget=budget).collect())
    assert got == Counter((d, *k[:2], d == k[0], k[2]) for (d, _), k in zip(rows, brute.exact(rows)))


def test_grace_recursion_and_content(tmp_path):
    r = random.Random(1)
    records = [(bytes([r.randrange(4) for _ in range(32)]), b"t%d" % r.randrange(50), r.randrange(100), 1) for _ in range(3000)]
    clash = b"\0" * 32
    records += [(clash, b"one", 1, 1), (clash, b"two", 2, 1), (clash, b"one", None, 1)]
    want = {}
    for d, t, top, n in records:
        old = want.get((d, t), (None, 0))
        want[d, t] = (max((x for x in (old[0], top) if x is not None), default=None), old[1] + n)
    for budget in (1 << 30, 2000):
        got = {(x[0], x[1]): (x[2], x[3]) for x in grace_dedup.grace(records, budget, str(tmp_path))}
        assert got == want
    assert not list(tmp_path.iterdir())


def test_exact_dedup_empty(no_docs):
    assert grace_dedup.exact_dedup(no_docs).count() == 0


# --- line dedup --------------------------------------------------------------------------------------------------------


def line_rows():
    r = random.Random(3)
    common_lines = [" Subscribe NOW\t", "ÉCOLE", "école", "9 lines only", "", "  "]
    rows = [(k, "\n".join(r.sample(common_lines[:3], 2) + [sentence(r, 3)] + ([""] if k % 2 else [])) if k % 7 else None) for k in range(60)]
    rows += [(100 + k, "9 lines only\nself " + str(k)) for k in range(9)] + [(200, "subscribe now"), (200, "subscribe now"), (None, "SUBSCRIBE now\nx"), (201, "self 1\nself 1\nself 1")]
    return rows


@pytest.mark.parametrize("batches,fanout", [(1, 3), (4, 3), (7, 2)])
def test_line_dedup(spark, batches, fanout):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_lines", F.lit("old")).withColumn("pos", F.lit(1))
    out = line_dedup.drop_frequent_lines(df, batches=batches, fanout=fanout)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect())
    assert got == Counter((d, *x) for (d, _), x in zip(rows, brute.lines(rows)))
    assert out.columns == ["doc_id", "pos", "text", "n_lines", "n_dropped"]


def test_line_dedup_odd(odd_docs, odd_rows, no_docs):
    rows = pairs(odd_rows)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_frequent_lines(odd_docs, min_docs=2).collect())
    assert got == Counter((d, *x) for (d, _), x in zip(rows, brute.lines(rows, 2)))
    assert line_dedup.drop_frequent_lines(no_docs).count() == 0


def test_line_dedup_has_no_python(odd_docs):
    plan = line_dedup.drop_frequent_lines(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_runs_are_not_shuffled_again(spark):
    """Rows dealt by key meet a run without another exchange of the run."""
    keys = lambda *k: spark.createDataFrame([(x, x) for x in k], "k1 long, k2 long")
    runs = line_dedup.LineRuns(spark, limit=2)
    with common.scope():
        runs.add(keys(1, 2, 3).groupBy("k1", "k2").count().withColumnRenamed("count", "n"))
        plan = runs.unseen(keys(1, 5).groupBy("k1", "k2").count())._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_runs_find_unseen_keys(spark):
    runs = line_dedup.LineRuns(spark, limit=3, fanout=2)
    batch = lambda *k: spark.createDataFrame([(x, x, 1) for x in k], "k1 long, k2 long, n long")
    for keys in ((1, 2), (2, 3), (2, 4), (5,)):
        runs.add(batch(*keys))
    assert {r.k1 for r in runs.unseen(batch(1, 2, 5, 6)).collect()} == {6}
    assert {r.k1 for r in runs.frequent().collect()} == {2}
    assert all(len(level) < 2 for level in runs.levels)


# --- near dedup --------------------------------------------------------------------------------------------------------


def near_rows(n=160):
    """Chains of near copies, copies, and unrelated texts."""
    r = random.Random(9)
    rows, k = [], 0
    for _ in range(n // 8):
        words = sentence(r, r.choice([3, 8, 30, 90])).split()
        for _ in range(8):
            rows.append((k * 7 % 1009, " ".join(words)))
            k += 1
            words = list(words)
            for _ in range(r.choice([0, 1, 1, 2])):
                words[r.randrange(len(words))] = sentence(r, 1)
    return rows


@pytest.mark.parametrize("percent", [80, 85])
def test_near_dedup(spark, percent):
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minmax_dedup.near_dedup(df, percent).collect()}
    assert got == {d: (n, c, c == d) for (d, _), (n, c) in zip(rows, brute.near(rows, percent))}


def test_near_dedup_large_group(spark):
    """One large group in which few pairs are linked: buckets over the size that uses the bound on unique shingles."""
    r = random.Random(2)
    words = sentence(r, 80).split()
    rows = []
    for k in range(120):
        w = list(words)
        for i in r.sample(range(80), r.choice([0, 1, 2, 3, 4, 6])):
            w[i] = sentence(r, 1) + str(k)
        rows.append((k, " ".join(w)))
    got = {x.doc_id: x.component_id for x in minmax_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: c for (d, _), (_, c) in zip(rows, brute.near(rows))}


def test_near_dedup_common_passage(spark):
    """Pairs of near copies whose texts also hold a passage of all documents: often just one of a pair is in a big bucket."""
    r = random.Random(11)
    passage, rows = sentence(r, 68), []
    for p in range(600):
        w = sentence(r, 100).split()
        other = w[:12] + ["changed"] + w[13:70] + ["other"] + w[71:]
        rows += [(2 * p, passage + " " + " ".join(w)), (2 * p + 1, passage + " " + " ".join(other))]
    pairs = [rows[k : k + 2] for k in range(0, len(rows), 2)]
    want = {d: c for two in pairs for (d, _), (_, c) in zip(two, brute.near(two))}
    assert len(set(want.values())) == 600 and len({c for _, c in brute.near([two[0] for two in pairs])}) == 600
    got = {x.doc_id: x.component_id for x in minmax_dedup.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


def test_near_dedup_odd(odd_docs, odd_rows, no_docs):
    rows = pairs(odd_rows)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minmax_dedup.near_dedup(odd_docs).collect())
    assert got == Counter((d, n, c, d == c) for (d, _), (n, c) in zip(rows, brute.near(rows)))
    assert minmax_dedup.near_dedup(no_docs).count() == 0


def test_parities_never_rule_out_shared_shingles():
    """The bound holds for sets of any overlap, one in the other and equal ones too, and is sharp where few shingles differ."""
    r = np.random.default_rng(5)
    for size in (1, 3, 40, 500, 9000):
        pool = r.integers(0, 1 << 63, 3 * size, dtype=np.uint64)
        for shared in {0, 1, size // 2, size - 1, size} - {-1}:
            a, b = np.unique(pool[:size]), np.unique(np.concatenate((pool[:shared], pool[size : 2 * size - shared], pool[2 * size : 2 * size + shared // 9])))
            if not len(b):
                continue
            p = minmax_dedup.parities(np.concatenate((a, b)), np.array([0, len(a)]))
            differ = sum(int(x).bit_count() for x in p[0] ^ p[1])
            inter, apart = len(np.intersect1d(a, b)), len(np.setxor1d(a, b))
            assert inter <= (len(a) + len(b) - differ) / 2
            assert differ >= 0.8 * apart or apart > 64


def test_minmax_is_unbiased():
    r = np.random.default_rng(4)
    x = r.integers(0, 1 << 63, 400, dtype=np.uint64) * np.uint64(2)
    a, b = np.unique(x[:330]), np.unique(x[70:])
    got = minmax_dedup.minmax(np.concatenate((a, b)), np.array([0, len(a)]))
    assert abs((got[0] == got[1]).mean() - 260 / 400) < 0.15


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (5, 4), (9, 8), (8, 7), (7, 6), (6, 3)], "x long, y long")
    got = {r.v: r.c for r in minmax_dedup.components(edges).collect()}
    assert got == {2: 1, 3: 1, 6: 1, 7: 1, 8: 1, 9: 1, 5: 4}


def thue_morse(n):
    """A word and its mirror image, which share every polynomial hash modulo a power of two."""
    one = "".join("ab"[k.bit_count() % 2] for k in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("n", [64, 128, 2048])
def test_words_of_one_polynomial_hash_are_told_apart(spark, n):
    r = random.Random(12)
    one, two = thue_morse(n)
    base = sentence(r, 30).split()
    rows = [(k, " ".join([*base[:10], w, *base[10:]])) for k, w in enumerate((one, two))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in minmax_dedup.near_dedup(df, 85).collect()}
    assert got == {d: x for (d, _), x in zip(rows, brute.near(rows, 85))} and got[1][1] == 1
    got = {x.doc_id: (x.n_words, x.n_removed, x.kept_text) for x in substring_dedup.remove_repeats(df).collect()}
    assert got == {d: x for (d, _), x in zip(rows, brute.repeats(rows))}


# --- substring dedup ---------------------------------------------------------------------------------------------------


def passage_rows():
    r = random.Random(6)
    passages = [sentence(r, n).split() for n in (19, 20, 21, 50, 200)]
    rows = []
    for k in range(80):
        w = sentence(r, r.choice([0, 5, 40])).split()
        for _ in range(r.randrange(4)):
            p = r.choice(passages)
            a = r.randrange(3)
            w += p[a:] + sentence(r, r.choice([0, 1, 7])).split()
        rows.append((k * 13 % 997, " ".join(w)))
    rows.append((998, " ".join(["same"] * 100)))
    return rows


def test_substring_dedup(spark):
    rows = passage_rows()
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {d: x for (d, _), x in zip(rows, brute.repeats(rows))}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in out} == want
    assert sum(x[1] for x in want.values()) > 1000 and all(r.kept_sha256 == brute.sha(r.kept_text) for r in out)


def test_substring_dedup_odd(odd_docs, odd_rows, no_docs):
    rows = pairs(odd_rows)
    out = substring_dedup.remove_repeats(odd_docs)
    assert "own" in out.columns
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in out.collect())
    assert got == Counter((d, *x) for (d, _), x in zip(rows, brute.repeats(rows)))
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_only_the_two_columns(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert substring_dedup.remove_repeats(df.select("doc_id", "text")).first().kept_text == "a b"
    assert DOCS


def test_likely_loses_no_row(spark):
    """Rows with a key that was found stay, null keys included; most others go."""
    rows = spark.range(20_000).selectExpr("if(id = 0, null, id) AS k", "id AS other")
    got = [r.k for r in common.likely(rows, "k", rows.where("k IS NULL OR k % 1000 = 7").select("k"), words=1 << 12).collect()]
    assert {None, *range(7, 20_000, 1000)} <= set(got) and len(got) < 200
    assert common.likely(rows, "k", rows.where("k < 0").select("k")).count() == 0


def test_near_dedup_moves_no_text_without_a_shared_band(spark):
    """Texts that share no band are not shuffled, though no join is small enough to be broadcast by its size."""
    rng = random.Random(4)
    texts = [" ".join(f"{rng.getrandbits(40):010x}" for _ in range(2000)) for _ in range(200)]
    df = spark.createDataFrame([*enumerate(texts), (200, texts[0] + " more")], "doc_id long, text string")
    sc, was = spark.sparkContext, spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    store = sc._jsc.sc().statusStore()

    def moved() -> int:
        stages = store.stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
        return sum(stages.apply(k).shuffleWriteBytes() for k in range(stages.size()))

    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        before = moved()
        got = {r.doc_id: r.component_id for r in minmax_dedup.near_dedup(df).collect()}
        sent = moved() - before
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert got == {**{k: k for k in range(200)}, 200: 0}
    assert sent < sum(map(len, texts)) / 2
