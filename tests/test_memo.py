import datetime as dt

from pyspark.sql import functions as F

from marginalia.operators import rules
from marginalia.sources import memo

DAY = dt.datetime(2024, 1, 1)
SCHEMA = "url string, status_code int, text string, fetched_at timestamp"


def rows(spark, *made):
    return spark.createDataFrame([(u, c, t, None if d is None else DAY + dt.timedelta(days=d)) for u, c, t, d in made], SCHEMA)


def test_memo_merges_expires_and_drops_poison(spark, tmp_path):
    kept = memo.Memo(spark, str(tmp_path), fanout=2)
    assert kept.table().count() == 0
    kept.remember(rows(spark, ("a", 200, "one", 0), ("b", 404, "gone", 0), ("c", 503, "x", 0), ("d", 200, "Verify you are HUMAN", 0), ("e", 0, "", 0), ("f", 200, None, 1), (None, 200, "x", 1), ("g", 200, "x", None)))
    read = lambda **k: {r.url: (r.status_code, r.text) for r in kept.table(**k).collect()}
    assert read() == {"a": (200, "one"), "b": (404, "gone"), "f": (200, "")}
    first = kept.versions.read()[0]
    opened = kept.table(version=first)
    kept.remember(rows(spark, ("a", 200, "two", 3), ("a", 429, "later", 9), ("b", 404, "older", -1)))
    assert read() == {"a": (200, "two"), "b": (404, "gone"), "f": (200, "")}
    assert {r.url: r.text for r in opened.collect()} == {"a": "one", "b": "gone", "f": ""}  # a reader of the version before
    since = F.lit("2024-01-02").cast("timestamp")
    assert read(since=since) == {"a": (200, "two"), "f": (200, "")}
    asked = spark.createDataFrame([("a", 1), ("z", 2), ("b", 3)], "url string, n int")
    assert {(r.n, r.text) for r in kept.known(asked, since).collect()} == {(1, "two"), (2, None), (3, None)}
    kept.remember(rows(spark, ("z", 200, "zz", 5)), since)
    kept.remember(rows(spark, ("y", 200, "yy", 5)), since)
    assert [len(x) for x in kept.versions.read()[1]["levels"]] == [0, 0, 1]
    kept.versions.vacuum()
    assert read() == {"a": (200, "two"), "f": (200, ""), "y": (200, "yy"), "z": (200, "zz")}  # b went with its runs


def test_counters_of_the_same_pass(spark):
    made = [("f", 0, "article", "k2020x", {"title": "T", "year": "20x", "url": "ftp://x"}), ("f", 1, "misc", "K", {"title": " ", "pdf": "https://x/y.pdf"}), ("g", 0, "book", "b2021y", {"abstract": "a"})]
    entries = spark.createDataFrame(made, "file_path string, entry_idx int, entry_type string, entry_key string, fields map<string,string>")
    issues, seen, found = rules.counted_lint(entries)
    got = issues.collect()
    want = rules.lint(entries).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert found.get == {"issues": len(want), "errors": sum(r.severity == "error" for r in want), "warnings": sum(r.severity == "warning" for r in want)}
    assert seen.get == {"entries": 3} | {f"with_{n}": sum(bool((f.get(n) or "").strip()) for *_, f in made) for n in rules.READY}
