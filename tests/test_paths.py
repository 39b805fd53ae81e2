import datetime as dt
import hashlib

from pyspark.sql import functions as F

from marginalia.operators import paths
from marginalia.sources import register


def test_quick_md5(spark):
    big = bytes(range(256)) * 10000
    df = spark.createDataFrame([(b"abc",), (big,)], "c binary")
    got = [r.h for r in df.select(paths.quick_md5(F.col("c"), F.length("c")).alias("h")).collect()]
    assert got == [hashlib.md5(b"abc").hexdigest(), hashlib.md5(big[: paths.MIB] + big[-paths.MIB :]).hexdigest()]


def test_moves_and_exports(spark):
    df = spark.createDataFrame([("by-x/a.bib",), ("by-y/b.bib",), ("c.bib",)], "p string")
    assert [(r.p, r.unmapped) for r in paths.migrated(df, "p", {"by-x/a.bib": "a.bib"}).orderBy("p").collect()] == [("a.bib", False), ("by-y/b.bib", True), ("c.bib", False)]
    files = spark.createDataFrame([("x/a.pdf", 1), ("y/a.pdf", 2), ("z/a.pdf", 3), ("b", 4)], "s string, o int")
    assert [r.target for r in paths.export_plan(files, "s", [F.col("o")]).orderBy("o").collect()] == ["a.pdf", "a_1.pdf", "a_2.pdf", "b"]


def test_scan(spark):
    t = dt.datetime(2024, 1, 1)
    state = spark.createDataFrame([("a", t, "present"), ("b", t, "present"), ("c", t + dt.timedelta(minutes=9, seconds=30), "present")], "k string, seen_at timestamp, status string")
    scan = spark.createDataFrame([("a",), ("d",), ("d",)], "k string")
    got = {r.k: r.status for r in paths.scanned(state, scan, "k", F.lit(t + dt.timedelta(minutes=10))).collect()}
    assert got == {"a": "present", "b": "deleted", "c": "present", "d": "present"}


def test_tokens(spark):
    df = spark.createDataFrame([("ICML:2020",), ("x:1",), (":2020",)], "t string")
    assert [(r.venue, r.year, r.valid) for r in paths.targets(df, "t").collect()] == [("icml", 2020, True), ("x", 1, False), ("", 2020, False)]
    row = spark.range(1).select(*paths.venue_and_year(F.lit("a/orals/icml/2021.bib")), paths.distinct_ignoring_case(F.array(F.lit("A"), F.lit("b"), F.lit("a"))))
    assert list(row.first()) == ["icml", 2021, ["A", "b"]]
    policies = spark.createDataFrame([("v", "c/v/{year}.bib", {"year": "0", "x": "1"})], "venue string, file_template string, params map<string,string>")
    assert [(r.file_path, r.params) for r in paths.venue_targets(policies, [2020, 2021]).collect()] == [("c/v/2020.bib", {"x": "1", "year": "2020"}), ("c/v/2021.bib", {"x": "1", "year": "2021"})]
    assert paths.workers(2)["article"] == 1 and paths.workers(24) == {"article": 8, "medium": 4, "long": 2, "huge": 1}


def test_registered_functions(spark):
    register.register(spark)
    rows = spark.sql("SELECT t.entry_key, t.fields['year'] AS y FROM VALUES ('@misc{a, year = 2020} @misc{b, year = {2021}}') AS s(x), LATERAL parse_citations(s.x) AS t").collect()
    assert [tuple(r) for r in rows] == [("a", "2020"), ("b", "2021")]
    assert spark.sql("SELECT exact_normal_form('A &amp; {B}') AS x, balanced_braces('a}') AS y").first() == ("a b", "a")
