import math
import random
import re

import pytest
from pyspark.sql import functions as F

from marginalia.llm import licence_index as L

from .brute import FOLD

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain(texts, templates=L.TEMPLATES, around=5):
    """(n_words, matches) of each text, by trying every template at every place."""
    docs = [WORD.findall((t or "").translate(FOLD)) for t in texts]
    idf = {w: math.floor(1000 * (math.log((len(docs) + 1) / (sum(w in d for d in docs) + 1)) + 1)) for t in templates for w in t.split()}
    out = []
    for d in docs:
        found = []
        for t in templates:
            ws = t.split()
            total = sum(idf[w] for w in ws)
            for at in range(1 - len(ws), len(d)):
                got = sum(idf[w] for p, w in enumerate(ws) if 0 <= at + p < len(d) and d[at + p] == w)
                part = " " + " ".join(d[max(0, at - around) : at + len(ws) + around]) + " "
                if 100 * got >= t.least * total and all(f" {p} " in part for p in t.phrases):
                    found.append((t.label, t.base, at, got / total))
        out.append((len(d), sorted(found)))
    return out


@pytest.fixture(scope="module")
def texts():
    r = random.Random(8)
    noise = lambda n: " ".join(r.choice(["the", "license", "free", "words", "copy", "under", "of", "public", "und", "naïve"]) for _ in range(n))
    made = [None, "", " -- ", "CC BY", "cc-by-nc 4.0", "cc by cc by", "cc\nby", "ccby", "Kcc by", "© 2020. All Rights Reserved.", "all rights, reserved all rights reserved"]
    for t in L.NOTICES:
        words = t.split()
        made += [t.words, t.words.upper(), noise(9) + " " + t.words + ", " + noise(4), ". ".join(words[2:]), noise(3) + " " + " ".join(words[:-2])]
        made += [" ".join(w if r.random() < 0.85 else "other" for w in words) for _ in range(3)]
        made += [" ".join(words[: len(words) // 2] + ["inserted"] + words[len(words) // 2 :])]
    return made + [noise(60) for _ in range(20)] + ["CC BY", "x " * 30000 + "cc by " + "y " * 30000]


def test_matches_equal_every_place_tried(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = {r.doc_id: (r.n_words, sorted(map(tuple, r.matches))) for r in L.scan(docs).select("doc_id", "n_words", "matches").collect()}
    want = plain([t if len(t or "") < 50000 else t[59980:60020] for t in texts])
    for k, (n, found) in enumerate(want):
        if len(texts[k] or "") < 50000:
            assert rows[k] == (n, found), texts[k]
    last = rows[len(texts) - 1]
    assert last[0] == 60002 and last[1] == [("cc-by", True, 30000, 1.0)]


def test_index_loses_no_match():
    """Without the words that the index lists for a template, what may still stand at a place is too little."""
    r = random.Random(1)
    for _ in range(50):
        weight = {w: r.randint(1000, 9000) for t in L.TEMPLATES for w in t.split()}
        listed = L.postings(L.TEMPLATES, weight)
        for k, t in enumerate(L.TEMPLATES):
            here = {p for _, n, p in listed if n == k}
            rest = sum(weight[w] for p, w in enumerate(t.split()) if p not in here)
            assert 100 * rest < t.least * sum(weight[w] for w in t.split())
            lightest = max((weight[w] for p, w in enumerate(t.split()) if p not in here), default=0)
            assert all(weight[t.split()[p]] >= lightest for p in here)


def test_report_and_odd_rows(spark, odd_docs, odd_rows, no_docs):
    docs = odd_docs.withColumns({"n_words": F.lit("old"), "matches": F.lit("old")})
    docs = docs.withColumn("text", F.when(F.col("doc_id") == 7, "All rights reserved, CC BY; all rights reserved").otherwise(F.col("text")))
    got = L.scan(docs)
    assert got.columns == [c for c in docs.columns if c not in ("n_words", "matches")] + ["n_words", "matches"]
    rows = got.select("doc_id", *[c.alias(n) for n, c in L.report().items()]).collect()
    assert len(rows) == len(odd_rows)
    one = [tuple(r)[1:] for r in rows if r.doc_id == 7]
    assert one == [(3, 0, 5, "cc-by,reserved", "cc-by,reserved", 1.0)]
    assert all(tuple(r)[1:] == (0, None, None, "", "", 0.0) for r in rows if r.doc_id != 7)
    assert L.scan(no_docs).count() == 0


def test_plan_has_no_shuffle_of_texts_and_no_python(spark, odd_docs):
    plan = L.scan(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
