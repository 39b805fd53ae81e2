import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marginalia.operators import coverage, decide, duplicates, keys, matching, reconcile, rules, scans, tracking


def entries(spark, *rows):
    return spark.createDataFrame([("a.bib", k, t, key, f) for k, (t, key, f) in enumerate(rows)], "file_path string, entry_idx int, entry_type string, entry_key string, fields map<string,string>")


def test_lint(spark):
    got = rules.lint(entries(spark, ("article", "Bad", {"author": "A and others", "title": "T", "year": "20x", "url": "ftp://x", "pdf": "http://x/y", "arxiv": "1"}), ("book", "li2020deep", {"author": "A", "title": "T", "publisher": "P", "year": "2020"}))).collect()
    assert [r.issue_type for r in got if r.entry_idx == 0] == ["missing_required_fields", "invalid_year", "placeholder_authors", "invalid_url_scheme", "invalid_url_scheme", "pdf_field_suspicious", "arxiv_field_suspicious", "key_format", "key_format"]
    assert not [r for r in got if r.entry_idx == 1]


def test_lint_talks(spark):
    df = entries(spark, ("article", "li2020deep", {"author": "A", "title": "T", "journal": "J", "year": "2020", "url": "https://x/forum?id=1", "pdf": "https://x/pdf?id=2"})).withColumn("file_path", F.lit("c/orals/v/2021.bib"))
    assert {r.issue_type for r in rules.lint(df, oral="/orals/").collect()} == {"oral_entry_type", "oral_note", "oral_year_mismatch", "oral_openreview_id_mismatch"}


def test_cap(spark):
    df = spark.range(5).select(F.lit("error").alias("severity"), F.when(F.col("id") < 4, "a").otherwise("b").alias("issue_type"), "id")
    got = sorted((r.issue_type, r.id, r.severity, r.suppressed) for r in rules.capped(df, [F.col("id")], 3).collect() if r.id is not None)
    assert got == [("a", 0, "error", None), ("a", 1, "error", None), ("a", 2, "error", None), ("b", 4, "error", None)]
    assert rules.capped(df, [F.col("id")], 3).where("suppressed = 1").count() == 1


def test_predicates(spark):
    row = spark.range(1).select(
        rules.transient(F.lit("HTTP status 503")), rules.transient(F.lit("http 404")), rules.transient(F.lit(None).cast("string")), rules.counts_toward_abort(F.lit("failed"), F.lit("http 404")),
        rules.response_problem(F.lit(200), F.lit("ok feed"), ["<feed"], []), rules.response_problem(F.lit(429), F.lit(""), [], []), rules.page_tier(F.lit(51)), rules.page_tier(F.lit(None).cast("int")),
        rules.pdf_problem(F.lit(b"%PDF-1.4" + b"x" * 1200 + b"%%EOF"), F.lit(1213)), rules.pdf_problem(F.lit(b"x"), F.lit(1)), rules.required_subset(F.array(F.lit("a")), ["a", "b"]), rules.multiset_contains(F.array(F.lit("a"), F.lit("a")), F.array(F.lit("a"), F.lit("a"))),
    )
    assert list(row.first()) == [True, False, True, False, "required_marker_missing", "rate_limited", "medium", "unknown", None, "too small", False, True]


def test_duplicate_titles(spark):
    df = entries(spark, ("article", "a", {"title": "Deep {N}ets?", "author": "A Li"}), ("article", "b", {"title": "deep nets", "author": "B Li"}), ("article", "c", {"title": "Editorial", "author": "A Li"}), ("article", "d", {"title": "editorial", "author": "A Li"}))
    got = duplicates.duplicate_titles(rules.profile_entries(df).withColumn("title_norm", F.trim("title_norm"))).collect()
    assert [(r.title_norm, r.n, r.entry_key) for r in got] == [("deep nets", 2, "a")]


def test_cascade_stops_at_ambiguity(spark):
    left = spark.createDataFrame([(1, "k1", "t1"), (2, None, "t2"), (3, "", "t9"), (4, "kx", "t3")], "id int, k string, t string")
    right = spark.createDataFrame([(10, "k1", "t2"), (11, "k2", "t3"), (12, "k3", "t3")], "rid int, k string, t string")
    got = {r.id: (r.rid, r.stage, r.matches) for r in matching.cascade(left, right, "id", "rid", [("key", left["k"], F.col("k")), ("title", left["t"], F.col("t"))]).collect()}
    assert got == {1: (10, "key", 1), 2: (10, "title", 1), 3: (None, None, None), 4: (None, "title", 2)}


def test_rules_and_intervals(spark):
    df = spark.createDataFrame([("a/b.bib",), ("c.bib",)], "p string")
    got = [(r.rule, r.role) for r in matching.first_rule(df, [{"pattern": "^a/", "role": "x"}, {"pattern": "bib$", "role": "y"}], F.col("p")).orderBy("p").collect()]
    assert got == [(0, "x"), (1, "y")]
    hosts = spark.createDataFrame([("api.x.org",), ("x.org",), ("y.org",)], "h string")
    assert [r.interval for r in matching.longest_suffix(hosts, F.col("h"), {"x.org": 2.0, "api.x.org": 3.0}, 1.0).orderBy("h").collect()] == [3.0, 2.0, 1.0]


def test_fuzzy(spark):
    df = spark.createDataFrame([(1, "deep nets for all", "deep nets for all", 5), (1, "deep nets for all", "shallow", 6), (2, "abcd", "abce", 7), (2, "abcd", "abcf", 8)], "id int, l string, r string, rid int")
    assert [(r.id, r.rid) for r in matching.fuzzy_unique(df, ["id"], "l", "r", "rid").collect()] == [(1, 5)]


def test_reconcile(spark):
    a, b = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert {(r.k, r["class"]) for r in reconcile.classify(a, b, "k").collect()} == {(1, "missing"), (2, "matched"), (3, "extra")}
    files = spark.createDataFrame([("p",), ("q",)], "path string")
    e = spark.createDataFrame([("x", "p"), (None, None)], "a string, b string")
    assert {(r.path, r.matched) for r in reconcile.any_key(files, e, "path", ["a", "b"]).collect()} == {("p", True), ("q", False)}


def test_decisions(spark):
    e = spark.createDataFrame([("a", {"title": "Old", "url": "http://x.org/1"}), ("b", {})], "k string, fields map<string,string>")
    r = spark.createDataFrame([("a", "src", "https://x.org/z", {"title": "OLD!", "url": "https://x.org/2", "abstract": "too short", "doi": "10.1/x"})], "k string, adapter string, source_url string, fields map<string,string>")
    got = {x.k: x for x in decide.decisions(e, ["k"], r, ["title", "url", "abstract", "doi"], ["x.org"], ["title", "url"]).collect()}
    assert got["a"].status == "planned_update" and got["a"].applied == ["url", "doi"] and got["a"].reasons == ["equivalent", "short_abstract"]
    assert got["b"].status == "unresolved"
    assert got["a"].proposals[1].evidence.adapter == "src"


def test_merge(spark):
    df = spark.createDataFrame([("k", 1, "", "A"), ("k", 2, "x", "B")], "k string, o int, v string, t string")
    assert [tuple(r) for r in decide.merged(df, "k", F.col("o"), ["v"], ["t"]).collect()] == [("k", "x", True)]
    row = spark.range(1).select(decide.merged_record(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("")), F.create_map(F.lit("a"), F.lit("2")), F.create_map(F.lit("a"), F.lit("3"), F.lit("c"), F.lit("4"))))
    assert row.first()[0] == {"a": "2", "c": "4"}


def test_key_numbers(spark):
    e = spark.createDataFrame([("f", 0, "k", "s1"), ("f", 1, "k", "s2"), ("f", 2, "k", "s3")], "file_path string, entry_idx int, base string, signature string")
    taken = spark.createDataFrame([("k", "k", "other"), ("k", "k2", "s2")], "base string, key string, signature string")
    assert [r.key for r in keys.disambiguated(e, taken).orderBy("entry_idx").collect()] == ["k1", "k2", "k3"]
    renames = spark.createDataFrame([("a", "z")], "old string, new string")
    rows = spark.createDataFrame([(1, "b, a;c")], "id int, l string")
    assert keys.with_renamed_references(rows, "id", "l", renames).first().l == "b, z, c"
    changes = spark.createDataFrame([("o", "n1", 0, "x"), ("o", "n2", 1, "y"), ("p", "q", 2, "x")], "old string, new string, ord int, t string")
    assert {(r.old, r.new, r.ambiguous) for r in keys.rename_map(changes, F.col("t") == "y").collect()} == {("o", "n2", True), ("p", "q", False)}


def sequential(rows, taken=()):
    """Keys given out one after the other: rows (file, idx, base, signature) by file and idx."""
    bound, used, out = {}, {}, {}
    for key, signature in taken:
        bound.setdefault(key, set()).add(signature)
    for f, i, base, signature in sorted(rows, key=lambda r: r[:2]):
        n, key = 0, base
        while key in used.setdefault(f, set()) or key in bound and signature not in bound[key]:
            n += 1
            key = f"{base}{n}"
        used[f].add(key)
        out[f, i] = key
    return out


ENTRIES = "file_path string, entry_idx int, base string, signature string"


def test_keys_across_bases(spark):
    assert [r.key for r in keys.suffixed(spark.createDataFrame([(0, "a"), (1, "a"), (2, "a1")], "o int, b string"), "b", ["o"]).orderBy("o").collect()] == ["a", "a1", "a11"]
    e = spark.createDataFrame([("f", 0, "a", "s"), ("f", 1, "a", "t")], ENTRIES)
    taken = spark.createDataFrame([("a1", "other")], "key string, signature string")
    assert [r.key for r in keys.disambiguated(e, taken).orderBy("entry_idx").collect()] == ["a", "a2"]


@pytest.mark.parametrize("seed", range(2))
def test_keys_equal_a_sequential_run(spark, seed):
    r = random.Random(seed)
    bases = ["a", "a1", "a11", "a12", "a2", "b", "b0", "b01", "1", "11"]
    rows = [(r.choice("fg"), i, r.choice(bases), r.choice("stuv")) for i in range(60)]
    taken = list({(r.choice(bases) + r.choice(["", "1", "2", "3", "4", "11", "12", "30"]), r.choice("stuvw")) for _ in range(15)})
    e = spark.createDataFrame(rows, ENTRIES).repartition(3)
    bound = spark.createDataFrame(taken, "key string, signature string")
    for rounds in (1, 100):  # families in order after one round, and rounds alone
        got = keys.claimed(e, ["file_path"], "base", ["entry_idx"], "signature", bound, rounds=rounds)
        assert {(x.file_path, x.entry_idx): x.key for x in got.collect()} == sequential(rows, taken)


def test_a_hot_base_and_null_bases(spark):
    rows = [("f", i, "hot" if i % 3 else None if i % 2 else "hot1", "s") for i in range(120)]
    taken = [(f"hot{n}", "x") for n in range(2, 40)]
    got = keys.disambiguated(spark.createDataFrame(rows, ENTRIES), spark.createDataFrame(taken, "key string, signature string")).collect()
    want = sequential([r for r in rows if r[2]], taken)
    assert {(x.file_path, x.entry_idx): x.key for x in got if x.base} == want and sum(x.key is None for x in got) == sum(r[2] is None for r in rows)


def test_ranks_of_spread_groups(spark):
    df = spark.range(2000).select((F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 > 0, F.col("id") * 7 % 2000).alias("o"))
    rows = scans.ranked(df, ["g"], [F.asc_nulls_first("o")]).collect()
    for g in range(3):
        mine = sorted((x for x in rows if x.g == g), key=lambda x: x["rank"])
        assert [x["rank"] for x in mine] == list(range(len(mine)))
        order = [-1 if x.o is None else x.o for x in mine]
        assert order == sorted(order)


def test_slots_equal_a_sequential_loop(spark):
    r = random.Random(3)
    rows = [(n, "hot" if n % 4 else r.choice(["a", None]), r.choice([r.randint(0, 4000), n]), r.choice([0, 1, 5, None, -3])) for n in range(1500)]
    df = spark.createDataFrame(rows, "id long, host string, at long, wait long").repartition(3)
    got = scans.paced(df, ["host"], [F.col("at"), F.col("id")], F.col("at"), F.col("wait"))
    want, next_ = {}, {}
    for n, host, at, wait in sorted(rows, key=lambda x: (x[2], x[0])):
        want[n] = max(at, next_.get(host, at))
        next_[host] = want[n] + max(wait or 0, 0)
    assert {x.id: x.slot for x in got.collect()} == want
    dealt = scans._dealt(df, ["host"], [F.col("at"), F.col("id")])
    assert dealt.where("host = 'hot'").select("_part").distinct().count() >= int(spark.conf.get("spark.sql.shuffle.partitions")) - 1  # other hosts may have a part


def test_tracking(spark):
    log = spark.createDataFrame([("f", "a", 1, "failed"), ("f", "a", 2, "success"), ("f", "b", 1, "failed"), ("f", "b", 2, "failed")], "file string, key string, ts int, status string")
    assert {(r.key, r.status) for r in tracking.latest(log, ["file", "key"], ["ts"], ["status"]).collect()} == {("a", "success"), ("b", "failed")}
    assert {(r.key, r.failures, r.backoff) for r in tracking.failure_counts(log, ["key"]).collect()} == {("a", 1, 4.0), ("b", 2, 8.0)}
    state = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    new = spark.createDataFrame([("b", 2, 0), ("b", 3, 1), ("c", 4, 0)], "k string, v int, _ord int")
    assert {tuple(r) for r in tracking.upsert(state, new, ["k"]).collect()} == {("a", 1), ("b", 3), ("c", 4)}
    e, f = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("b",), ("b",), ("c",)], "k string")
    assert tuple(tracking.bijection(e, f, "k").first()) == (2, 2, 1, 1, 1, 50.0)


def test_batches_are_consecutive(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7 % 1000).alias("k"))
    got = [r.batch for r in tracking.batches(df, ["k"], 100).orderBy("k").collect()]
    assert got == [k // 100 for k in range(1000)]


def test_coverage(spark):
    df = spark.createDataFrame([("f1", "g", "x"), ("f2", "g", None)], "f string, g string, v string")
    got = {(r.level, r.name): (r.n, r.has, r.has_pct) for r in coverage.cube(df, "f", "g", {"has": F.col("v").isNotNull()}).collect()}
    assert got == {("file", "f1"): (1, 1, 100.0), ("file", "f2"): (1, 0, 0.0), ("group", "g"): (2, 1, 50.0), ("total", ""): (2, 1, 50.0)}


def test_exceptions(spark):
    rows = spark.createDataFrame([("k", "a/b", "x"), ("z", "a", "x")], "key string, path string, adapter string")
    ledger = spark.createDataFrame([("k", None, None, "any", dt.date(2030, 1, 1)), ("k", "a/", None, "path", dt.date(2020, 1, 1))], "key string, path_contains string, adapter string, reason string, review_after date")
    got = {r.key: (r.exception, r.expired) for r in matching.with_exception(rows, ledger, "key", "path", "adapter", F.lit("2024-01-01").cast("date")).collect()}
    assert got == {"k": ("path", True), "z": (None, False)}


def test_exceptions_do_not_depend_on_the_order_or_size_of_the_ledger(spark):
    rows = spark.createDataFrame([("k", "a/b", "x")], "key string, path string, adapter string")
    schema = "key string, path_contains string, adapter string, reason string, review_after date"
    two = [("k", None, None, "same", dt.date(2030, 1, 1)), ("k", None, None, "same", dt.date(2020, 1, 1))]
    more = [(f"other{n}", None, None, "r", None) for n in range(1001)]
    for ledger in (two, two[::-1], two + more, more + two[::-1]):
        got = matching.with_exception(rows, spark.createDataFrame(ledger, schema), "key", "path", "adapter", F.lit("2024-01-01").cast("date")).collect()
        assert [(r.exception, r.expired) for r in got] == [("same", True)]
