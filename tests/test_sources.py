import json

import pytest
from pyspark.sql import functions as F

from marginalia.sources import bibfile, config, records
from marginalia.streaming import progress

FILE = r"""% a header @article{no, title = {x}}
@comment{kept: yes}
@string{j = "Journal of " # {Things}}
@preamble{"\newcommand"}
@article{li2020deep, author = {Li, {\'E}va and M{\"u}ller, Bo},
  title = {The {D}eep $\{x\}$ {Net}}, journal = j, year = 2020,
  note = "quoted {"} brace" # { and more},
}
@Book(bo2021x, title={T}, title={U})
@misc{broken, title = {open}
"""


def test_parser():
    blocks = list(bibfile.parse(FILE))
    assert [b["block_type"] for b in blocks] == ["comment", "string", "preamble", "entry", "entry", "error"]
    e = blocks[3]
    assert e["entry_key"] == "li2020deep" and e["fields"]["author"] == "Li, Éva and Müller, Bo" and e["fields"]["journal"] == "Journal of Things"
    assert e["fields"]["year"] == "2020" and e["fields"]["title"] == r"The {D}eep $\{x\}$ {Net}" and e["fields"]["note"] == 'quoted {"} brace and more'
    assert blocks[4]["fields"] == {"title": "U"} and blocks[4]["entry_type"] == "book"


def test_files(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.bib").write_text(FILE)
    (tmp_path / "a/y.bib").write_text("generated from DBLP XML dump\n@misc{k1, title={A}}\n@misc{k1, title={B}}\n")
    (tmp_path / "a/z.txt").write_text("@misc{no}")
    files = bibfile.read_files(spark, [str(tmp_path / "a")])
    blocks = bibfile.blocks(files)
    entries = bibfile.entries(blocks)
    assert sorted((r.entry_idx, r.entry_key) for r in entries.collect()) == [(0, "k1"), (0, "li2020deep"), (1, "bo2021x"), (1, "k1")]
    stats = {r.file_path[-5:]: (r.parse_ok, r.entry_count, r.generated) for r in bibfile.file_table(files, blocks).collect()}
    assert stats == {"x.bib": (False, 2, False), "y.bib": (True, 2, True)}
    assert {(r.line, r.entry_key) for r in bibfile.light_scan(files).collect()} >= {(2, "k1"), (3, "k1"), (5, "li2020deep")}
    assert bibfile.without_comments(blocks, "kept:").where("block_type = 'comment'").count() == 1
    assert bibfile.without_comments(blocks, "other:").where("block_type = 'comment'").count() == 0


def test_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([("f", 0, "article", "k", {"year": "2020", "title": "A {B} \\{c\\}", "author": "X", "zeta": "z"}), ("f", 1, "misc", "m", {"title": "T"})], "file_path string, entry_idx int, entry_type string, entry_key string, fields map<string,string>")
    text = bibfile.files_of(bibfile.rendered(rows))
    assert text.first().value.startswith("@article{k,\n  author = {X},\n  title = {A {B} \\{c\\}},\n  year = {2020},\n  zeta = {z},\n}\n\n@misc")
    again = bibfile.entries(bibfile.blocks(text))
    assert [(r.entry_key, r.fields) for r in again.orderBy("entry_idx").collect()] == [(r.entry_key, r.fields) for r in rows.collect()]
    before = bibfile.blocks(text)
    assert bibfile.write_checked(spark, rows, before, str(tmp_path / "ok")).count() == 0
    assert bibfile.write_checked(spark, rows.where("entry_idx = 0"), before, str(tmp_path / "lost")).count() == 1


def test_catalog(spark):
    payload = json.dumps({"results": [{"id": 1, "name": "A &amp; B", "authors": [{"fullname": "X  Y"}], "decision": "Accept (poster)", "eventtype": "Poster", "visible": True}, {"id": 2, "name": "C", "authors": [{"fullname": "Z"}], "decision": "Reject", "eventtype": "Poster", "visible": True}, {"id": 3, "name": "D", "authors": [], "decision": "Accept", "eventtype": "Poster", "visible": False}]})
    abstracts = spark.createDataFrame([("1", "about")], "source_id string, abstract string")
    rows = records.accepted(records.catalog(spark.createDataFrame([(payload,)], "payload string"), abstracts)).collect()
    assert [(r.source_id, r.title, r.abstract, r.reason) for r in sorted(rows, key=lambda r: r.source_id)] == [("1", "A & B", "about", None), ("2", "C", None, "not_accepted"), ("3", "D", None, "hidden")]


def test_xml(spark):
    feed = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/2101.00001v1</id><title>A\n B</title><author><name>X Y</name></author><published>2021-01-01</published></entry></feed>'
    assert [tuple(r) for r in records.atom(spark.createDataFrame([(feed,)], "feed string")).collect()] == [("2101.00001", "A B", ["X Y"], 2021, 0)]
    tei = "<TEI xmlns='x'><teiHeader><fileDesc><titleStmt><title>T</title></titleStmt><sourceDesc><biblStruct><author><persName><surname>Li</surname></persName></author></biblStruct></sourceDesc></fileDesc><profileDesc><abstract>a</abstract></profileDesc></teiHeader><text><body>body text</body><back><listBibl><biblStruct/><biblStruct/></listBibl></back></text></TEI>".replace("'", '"')
    r = records.tei_features(spark.createDataFrame([(tei,)], "tei string")).first()
    assert (r.title, r.has_abstract, r.body_text_chars, r.reference_count, r.first_author_surname) == ("T", True, 9, 2, "li")


def test_small_payloads(spark):
    row = spark.range(1).select(records.unwrapped(F.lit('{"a": {"value": "x"}}'), "a"), records.unwrapped(F.lit('{"a": "y"}'), "a"), records.json_object(F.lit("{broken"), "a string")["a"], records.pdf_title(F.lit(b"%PDF /Title (On the deep nets) x")), records.accepted_venue(F.lit("Conf 2021 poster"), F.lit(2021)))
    assert list(row.first()) == ["x", "y", None, "On the deep nets", True]
    page = spark.createDataFrame([('<a href="/1">One <b>x</b></a> <a class="c" href="/2">Two</a>',)], "p string")
    assert [tuple(r) for r in records.listing(page, "p").collect()] == [("/1", "One x"), ("/2", "Two")]


def test_log_export(spark):
    log = spark.createDataFrame([("f", "b", "2024-01-02 00:00:00", "ok"), ("f", "a", "2024-01-01T00:00:00", "ok")], "file_path string, entry_key string, timestamp string, status string")
    lines = records.exported_log(log)
    assert [json.loads(r.value)["entry_key"] for r in lines.collect()] == ["a", "b"]
    assert records.imported_log(log, lines).count() == 0 and records.imported_log(log.where("entry_key = 'a'"), lines).count() == 1


def test_policy():
    p = config.load_policy('issue_limit = 0\n[[rule]]\npattern = "collections/**/*.bib"\nrole = "curated"\ntopics = ["{stem}"]\n[[exception]]\nkey = "k"\nreason = "r"\n[[exception]]\nkey = "x"\n')
    assert p.issue_limit == 1 and len(p.exceptions) == 1
    assert config.resolve("collections/a/deep-nets.bib", p.rules).topics == ("deep-nets",) and config.resolve("x.bib", p.rules) is None
    assert config.problems(config.FileRule("x", "derived", None, ("Bad Slug",))) == ["derived files have no topics", "not a slug: Bad Slug"]
    with pytest.raises(ValueError):
        config.load_policy("nope = 1")
    (at, body), = config.inline_blocks('x\n@COMMENT{meta: subject=ml, topics_append=["a}", "b"]}', "meta")
    assert at == 2 and config.inline_fields(body) == {"subject": "ml", "topics_append": ["a}", "b"]}


def test_streams(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    rows = [("2024-01-01T00:00:00", "h", "failed"), ("2024-01-01T00:01:00", "h", "failed"), ("2024-01-01T00:02:00", "h", "failed"), ("2024-01-01T00:00:00", "g", "ok")]
    (folder / "1.json").write_text("".join(json.dumps({"ts": t, "host": h, "status": s, "entry_key": h, "file_path": "f"}) + "\n" for t, h, s in rows))
    q = progress.breakers(progress.events(spark, str(folder))).writeStream.format("memory").queryName("breakers").outputMode("update").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.sql("SELECT * FROM breakers").collect()} == {("h", 3, True), ("g", 0, False)}
    q = progress.totals(progress.events(spark, str(folder))).writeStream.format("memory").queryName("totals").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert {tuple(r) for r in spark.sql("SELECT * FROM totals").collect()} == {("failed", 3), ("ok", 1)}
    progress.keep_latest(progress.events(spark, str(folder)), str(tmp_path / "state"), str(tmp_path / "cp"), ["entry_key"], "ts").awaitTermination(120)
    assert progress.latest_state(spark, str(tmp_path / "state")).count() == 2


def test_blocks_of_many_small_files_are_held_in_bounded_batches(spark, monkeypatch):
    from marginalia.sources import bibfile, bibsource

    made = spark.sparkContext.accumulator(0)
    plain = bibsource._batch

    def counted(rows, schema):
        assert len(rows) <= bibsource.BATCH
        made.add(1)
        return plain(rows, schema)

    monkeypatch.setattr(bibsource, "_batch", counted)
    text = " ".join(f"@misc{{k{k}, title = {{t{k}}}}}" for k in range(50))
    files = spark.range(300, numPartitions=1).selectExpr("concat('f', id) AS file_path", f"'{text}' AS value")
    found = bibfile.blocks(files)
    assert found.where("fields['title'] = 't7'").count() == 300 and made.value == 8  # 15,000 blocks, 2,000 a batch


def test_atom_entries_are_parsed_once_and_as_xpath_does(spark):
    from marginalia.sources import records

    entry = '<entry><x a:b="1"/><id>http://arxiv.org/abs/2301.00001v2</id><title>A <i>b</i> &amp; c</title><author><name>Ann</name></author><author><name/></author><id>x</id></entry>'
    rows = spark.createDataFrame([(1, f"<feed>{entry}<entry></entry></feed>")], "k int, feed string")
    got = records.atom(rows, "feed", ["k"])
    assert [tuple(r) for r in got.orderBy("rank").collect()] == [(1, "2301.00001", "A b & c", ["Ann"], None, 0), (1, "", "", [], None, 1)]
    assert "xpath" not in got._jdf.queryExecution().optimizedPlan().toString()
