import os
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from marginalia.llm import common, queries, toxicity

from . import brute
from .test_models import check_places

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in os.listdir(SF):
        con.sql(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{SF}/{t}" + ("/*.parquet'" if os.path.isdir(f"{SF}/{t}") else "'"))
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query(spark, duck, name):
    got = queries.queries()[name](spark, SF)
    want = duck.sql(queries.oracle_sql()[name])
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    rows = Counter(tuple(r[c] for c in order) for r in got.collect())
    assert rows == Counter(tuple(r[want.columns.index(c)] for c in order) for r in want.fetchall())


@pytest.mark.parametrize("name,columns", [("op1_toxicity", ["doc_id", "held_out", "score", "predicted"]), ("op5_language_id", ["doc_id", "held_out", "lang_pred", "score"]), ("op3_site_style_text", ["page_id", "url", "text", "n_chars"]), ("op7_subword_sampling", ["conv_id", "turn", "sample"]), ("op9_best_fit_packing", ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])])
def test_columns(spark, name, columns):
    got = queries.queries()[name](spark, SF)
    assert got.columns[: len(columns)] == columns and got.count() > 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    labels = common.table(spark, sf, "labels")
    rows = queries.op1_toxicity(spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.9
    rows = queries.op5_language_id(spark, sf).join(common.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert np.mean([r.lang_pred == r.lang for r in rows]) > 0.97


def test_toxic_stage_rejects_marked_documents(spark):
    docs, labels = common.table(spark, SF, "documents"), common.table(spark, SF, "labels")
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, SF).collect()}
    marked = {r.doc_id for r in docs.where(r"lower(text) rlike '\\b(loser|trash|scum|disgusting)s?\\b'").collect()}
    clean = {r.doc_id for r in labels.where("toxic = 0").collect()} - marked
    assert len(marked) >= 7 and not kept & marked
    assert len(kept & clean) > 0.85 * len(clean)


def test_stages(spark):
    """Each stage against its plain version, on what its predecessor kept."""
    docs = common.table(spark, SF, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["toxicity", "line_dedup", "near_dedup", "substring_dedup", "packing"]

    def run(name):
        nonlocal docs
        docs = common.staged(steps[name](spark, docs, SF), name)
        return docs.collect()

    predicted = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, common.table(spark, SF, "labels")).collect()}
    out = run("toxicity")
    assert docs.columns == corpus_pipeline.COLUMNS and {r.doc_id: r.text for r in out} == {d: t for d, t in rows.items() if not predicted[d]}
    rows = [(r.doc_id, r.text) for r in out]
    out = run("line_dedup")
    assert docs.columns == corpus_pipeline.COLUMNS and {r.doc_id: r.text for r in out} == {d: x[2] for (d, _), x in zip(rows, brute.lines(rows))}
    assert all(r.n_chars == len(r.text) for r in out)
    rows = [(r.doc_id, r.text) for r in out]
    out = run("near_dedup")
    assert docs.columns == corpus_pipeline.COLUMNS and {r.doc_id for r in out} == {d for (d, _), (_, c) in zip(rows, brute.near(rows, 80)) if d == c}
    rows = [(r.doc_id, r.text) for r in out]
    out = run("substring_dedup")
    assert docs.columns == corpus_pipeline.COLUMNS and {r.doc_id: r.text for r in out} == {d: x[2] if x[1] else t for (d, t), x in zip(rows, brute.repeats(rows))}
    kept = {r.doc_id for r in out}
    out = run("packing")
    assert {r.doc_id for r in out} == kept
    check_places(out, 1024)


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).where(F.col("length") > 0).count() > 0
