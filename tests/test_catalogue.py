"""Each query against its SQL on the smallest tables."""

import difflib
import math
import os
import random

import duckdb
import pytest

from marginalia.plans import catalogue

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET timezone = 'UTC'")
    for t in os.listdir(SF):
        path = f"{SF}/{t}" + ("/*.parquet" if os.path.isdir(f"{SF}/{t}") else "")
        con.sql(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{path}'")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])

    def one(v):
        if v is None or isinstance(v, float) and math.isnan(v):
            return None
        return round(float(v), 6) if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)

    return sorted((tuple(one(r[k]) for k in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.queries()))
def test_query(spark, duck, name):
    got = catalogue.queries()[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    sql = catalogue.oracle_sql().get(name)
    if sql is None:
        assert got.columns
        return
    want = duck.sql(sql)
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got.columns, rows) == canonical(want.columns, want.fetchall())


def test_no_cartesian_plans(spark):
    for name, f in catalogue.queries().items():
        plan = f(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name


def test_fuzzy_block_matches_all_documents_on_whole_texts(spark, tmp_path):
    r = random.Random(3)
    texts = [" ".join("".join(r.choice("bdgklmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 3))) for _ in range(60)) for _ in range(8)]
    end = " ".join(reversed(texts[7].split()[25:]))
    texts[7] = " ".join(texts[0].split()[:30]) + " " + end  # the opening of another text, then something else
    rows = [(0, texts[0]), (2, texts[0]), (4, texts[1]), (6, texts[1] + " more"), (1, texts[2]), (3, texts[2] + " changed")]
    rows += [(5, texts[3]), (7, texts[3]), (9, texts[3]), (10, texts[4]), (12, texts[4] + " a"), (13, texts[4] + " b"), (15, texts[5]), (17, texts[6]), (18, texts[7]), (19, ""), (20, None)]
    rows = [(d, t, "en", "s") for d, t in rows] + [(30, texts[5], "fr", "s"), (31, texts[5], "en", "t"), (33, texts[6], None, "s"), (34, texts[6], None, "s"), (35, texts[6], None, "u"), (36, texts[6] + " z", None, "u")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    want = {}
    for d, t, *block in rows:
        found = []
        for e, u, *other in rows:
            if t and u and d != e and block == other:
                found.append((1.0 if t == u else difflib.SequenceMatcher(None, t, u).ratio(), e))
        found.sort(key=lambda x: (-x[0], x[1]))
        exact = [e for s, e in found if s == 1]
        if exact:
            if len(exact) == 1:
                want[d] = (exact[0], 1.0)
        elif found and found[0][0] >= 0.9 and (len(found) == 1 or found[0][0] - found[1][0] >= 0.12 or found[1][0] <= 0.8):
            want[d] = (found[0][1], found[0][0])
    assert {0, 1, 2, 3, 4, 6, 33, 34, 35, 36} <= set(want) and not {5, 10, 15, 18, 30, 31} & set(want)
    got = catalogue.queries()["fuzzy_block_unique"](spark, str(tmp_path)).collect()
    assert len(got) == len(want) and {x.doc_id: (x.match_id, x.score) for x in got} == want
