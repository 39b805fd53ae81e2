import pyarrow.fs
import pytest
from pyspark.sql import functions as F

from marginalia.sources import bibfile, bibsource

from .test_sources import FILE

ENTRIES = "file_path string, entry_idx int, entry_type string, entry_key string, fields map<string,string>, raw string"


def rows(spark, files=3, each=4, title="T"):
    made = [(f"d/f{k}.bib", i, "article", f"k{k}x{i}", {"title": f"{title} {{{i}}}", "year": str(2000 + i), "zz": "\\{a\\}"}, None) for k in range(files) for i in range(each)]
    return spark.createDataFrame(made, ENTRIES).repartition(3)


def names(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


def test_round_trip(spark, tmp_path):
    bibsource.write(rows(spark), str(tmp_path))
    assert names(tmp_path) == ["d/f0.bib", "d/f1.bib", "d/f2.bib"]
    got = bibsource.read(spark, str(tmp_path))
    key = lambda df: sorted((r.file_path.rpartition("/")[2], r.entry_idx, r.entry_type, r.entry_key, sorted(r.fields.items())) for r in df.collect())
    assert key(got) == key(rows(spark))
    whole = bibfile.rendered(rows(spark))
    text = {r.file_path: r.value for r in bibfile.files_of(whole).collect()}
    assert (tmp_path / "d/f1.bib").read_text() == text["d/f1.bib"] + "\n"
    again = bibsource.read(spark, str(tmp_path))
    bibsource.write(again, str(tmp_path), mode="overwrite")
    assert key(bibsource.read(spark, str(tmp_path))) == key(rows(spark))


def test_blocks_equal_the_parser(spark, tmp_path):
    for n in range(5):
        (tmp_path / f"x{n}.bib").write_text(FILE)
    (tmp_path / "empty.bib").write_text("")
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden/y.bib").write_text(FILE)
    got = bibsource.read(spark, str(tmp_path), rows="blocks", bytes="700")
    assert got.rdd.getNumPartitions() > 1
    want = bibfile.blocks(bibfile.read_files(spark, [str(tmp_path)], exclude="_hidden").withColumn("file_path", F.regexp_replace("file_path", "^file:/*", "/")))
    key = lambda df: sorted((str(r.file_path), r.block_idx, r.block_type, str(r.value), str(r.fields), r.raw, str(r.error)) for r in df.collect())
    assert key(got) == key(want)


def test_priority_exclusion_and_pushed_paths(spark, tmp_path):
    bibsource.write(rows(spark), str(tmp_path))
    reader = bibsource.BibReader({"path": f"{tmp_path}/d/f2.bib,{tmp_path}", "exclude": "f1"})
    assert [p.rpartition("/")[2] for part in reader.partitions() for p in part.paths] == ["f2.bib", "f0.bib"]
    left = list(reader.pushFilters([bibsource.EqualTo(("file_path",), f"{tmp_path}/d/f0.bib"), bibsource.EqualTo(("entry_key",), "k")]))
    assert len(left) == 1 and [p for part in reader.partitions() for p in part.paths] == [f"{tmp_path}/d/f0.bib"]
    got = bibsource.read(spark, str(tmp_path)).where(F.col("file_path") == f"{tmp_path}/d/f0.bib")
    assert {r.entry_key for r in got.collect()} == {f"k0x{i}" for i in range(4)}


def test_append_replaces_and_leaves_others(spark, tmp_path):
    bibsource.write(rows(spark), str(tmp_path))
    bibsource.write(rows(spark, files=1, title="New"), str(tmp_path))
    assert names(tmp_path) == ["d/f0.bib", "d/f1.bib", "d/f2.bib"]
    assert "New" in (tmp_path / "d/f0.bib").read_text() and "New" not in (tmp_path / "d/f1.bib").read_text()
    bibsource.write(rows(spark, files=2, title="Over"), str(tmp_path), mode="overwrite")
    assert names(tmp_path) == ["d/f0.bib", "d/f1.bib"]


def test_failing_checks_leave_the_old_files(spark, tmp_path):
    bibsource.write(rows(spark), str(tmp_path))
    before = {n: (tmp_path / n).read_text() for n in names(tmp_path)}
    broken = rows(spark).withColumn("fields", F.when(F.col("entry_key") == "k2x3", F.create_map(F.lit("title"), F.lit("open {"))).otherwise(F.col("fields")))
    for bad, why in [(rows(spark, each=2), "would replace"), (broken, "does not parse"), (rows(spark).withColumn("entry_idx", F.lit(0)), "in order")]:
        with pytest.raises(Exception, match=why):
            bibsource.write(bad, str(tmp_path), rollback=str(tmp_path / "_back"))
        assert {n: (tmp_path / n).read_text() for n in names(tmp_path) if not n.startswith("_back")} == before
    assert any(n.endswith(".candidate") for n in names(tmp_path / "_back")) and any(n.endswith(".original") for n in names(tmp_path / "_back"))
    bibsource.write(rows(spark, each=2), str(tmp_path), fewer="true")
    assert bibsource.read(spark, str(tmp_path)).count() == 6


def test_killed_task_leaves_the_old_files(spark, tmp_path):
    bibsource.write(rows(spark), str(tmp_path))
    before = {n: (tmp_path / n).read_text() for n in names(tmp_path)}

    def dies(batches):
        import os

        for b in batches:
            yield b
            if "d/f2.bib" in b.column(0).to_pylist():
                os._exit(1)

    ordered = rows(spark, title="New").repartition(3, "file_path").sortWithinPartitions("file_path", "entry_idx")
    with pytest.raises(Exception):
        ordered.mapInArrow(dies, ENTRIES).write.format("bib").option("path", str(tmp_path)).mode("append").save()
    assert {n: (tmp_path / n).read_text() for n in names(tmp_path)} == before


def test_two_tasks_of_one_file_abort(spark, tmp_path):
    bibsource.register(spark)
    with pytest.raises(Exception, match="several tasks wrote"):
        rows(spark, files=1).repartition(2, "entry_idx").sortWithinPartitions("entry_idx").write.format("bib").option("path", str(tmp_path)).mode("append").save()
    assert names(tmp_path) == []


def test_failed_move_puts_all_back(spark, tmp_path, monkeypatch):
    bibsource.write(rows(spark), str(tmp_path))
    before = {n: (tmp_path / n).read_text() for n in names(tmp_path)}
    schema = rows(spark).schema
    writer = bibsource.BibWriter({"path": str(tmp_path)}, schema, True)
    message = writer.write(iter(sorted(map(tuple, rows(spark, title="New").collect()), key=lambda r: r[:2])))
    message.files[2] = ("/nowhere/at all", *message.files[2][1:])
    with pytest.raises(OSError):
        writer.commit([message])
    assert {n: (tmp_path / n).read_text() for n in names(tmp_path)} == before


def test_raw_texts_stay(spark, tmp_path):
    (tmp_path / "x.bib").write_text('@string{j = "J"}\n@comment{c}\n@misc{a,  title={A}, journal = j}\n@misc{b, title={B}}\n')
    got = bibsource.read(spark, str(tmp_path))
    changed = got.withColumns({"raw": F.when(F.col("entry_key") == "a", F.col("raw")), "fields": F.map_concat(F.map_filter("fields", lambda k, v: k != "title"), F.create_map(F.lit("title"), F.lit("N")))})
    bibsource.write(changed, str(tmp_path), raw="true")
    assert (tmp_path / "x.bib").read_text() == '@string{j = "J"}\n\n@comment{c}\n\n@misc{a,  title={A}, journal = j}\n\n@misc{b,\n  title = {N},\n}\n'
    assert isinstance(pyarrow.fs.FileSystem.from_uri(str(tmp_path))[0], pyarrow.fs.LocalFileSystem)
