import random

import pytest
from pyspark.sql import functions as F

from marginalia.functions import text as T
from marginalia.operators import duplicates, maintained, rules
from marginalia.sources import bibfile
from marginalia.sources.versions import Conflict, Versions


def entry(r):
    key = r.choice("abcde") + r.choice(["", "2020"])
    return f"@{r.choice(['article', 'misc'])}{{{key},\n title = {{Title {r.choice('xyz')}}},\n author = {{{r.choice(['Li, Bo', 'Ng, Al', ''])}}},\n year = {r.choice(['2020', '2021', '20x'])}{r.choice([',', ', url = {ftp://x}'])}\n}}\n"


def text(r):
    return "".join(entry(r) for _ in range(r.randint(0, 6))) + r.choice(["", "", "@misc{open, a = {"])


def full(spark, files):
    """The results of a run over all files."""
    df = spark.createDataFrame(list(files.items()), "file_path string, value string")
    blocks = bibfile.blocks(df)
    entries = bibfile.entries(blocks)
    f = F.col("fields")
    signed = entries.withColumn("s", T.entry_signature(f["year"], f["title"], f["author"]))
    return {
        "duplicate_keys": duplicates.multiplicity(entries, ["file_path", "entry_key"]),
        "collisions": duplicates.global_collisions(signed, "entry_key", "file_path", ["s"]).select("entry_key", "containers", "signatures"),
        "duplicate_titles": duplicates.duplicate_titles(rules.profile_entries(entries)).select("file_path", "title_norm", "basis", "n"),
        "issues": rules.lint(entries).groupBy("severity", "issue_type").agg(F.count("*").alias("n")),
        "files": bibfile.file_table(df.withColumns({"size": F.lit(0), "mtime": F.lit(0)}), blocks).select("file_path", "sha256", "entry_count", "error_message"),
    }


def same(spark, kept, files):
    for name, want in full(spark, files).items():
        got = getattr(kept, name)()
        assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect())), name


def test_updates_equal_full_runs(spark, tmp_path):
    r = random.Random(7)
    files = {f"f{k}": text(r) for k in range(8)}
    kept = maintained.Maintained(spark, str(tmp_path), fanout=3)
    frame = lambda: spark.createDataFrame(list(files.items()), "file_path string, value string")
    assert kept.update(frame()) == {"added": 8, "changed": 0, "gone": 0, "same": 0}
    same(spark, kept, files)
    for turn in range(4):
        changed = r.sample(sorted(files), 2)
        for k in changed:
            files[k] = text(r) + f"% {turn}\n"
        del files[r.choice([k for k in files if k not in changed])]
        files[f"g{turn}"] = text(r)
        said = kept.update(frame())
        assert said == {"added": 1, "changed": 2, "gone": 1, "same": len(files) - 3}
        if turn in (1, 3):
            same(spark, kept, files)
    before = kept.versions.read()
    assert kept.update(frame())["same"] == len(files) and kept.versions.read() == before
    kept.versions.vacuum()
    same(spark, kept, files)


def test_an_update_reads_only_changed_files(spark, tmp_path):
    files = {f"f{k}": f"@misc{{k{k}, title={{T}}}}\n" for k in range(5)}
    kept = maintained.Maintained(spark, str(tmp_path))
    kept.update(spark.createDataFrame(list(files.items()), "file_path string, value string"))
    files["f2"] = "@misc{other, title={T}}\n"
    kept.update(spark.createDataFrame(list(files.items()), "file_path string, value string"))
    last = kept.versions.read()[1]["facts"][-1]
    assert {x.file_path for x in spark.read.parquet(last).select("file_path").distinct().collect()} == {"f2"}
    assert {x.entry_key for x in kept.collisions().collect()} == set() and kept.files().where("entry_count = 1").count() == 5


def test_nothing_yet_and_no_files(spark, tmp_path):
    kept = maintained.Maintained(spark, str(tmp_path))
    assert kept.duplicate_keys().count() == 0 and kept.files().count() == 0
    empty = spark.createDataFrame([], "file_path string, value string")
    assert kept.update(empty) == {"added": 0, "changed": 0, "gone": 0, "same": 0}
    kept.update(spark.createDataFrame([("f", None), ("g", "@misc{a}")], "file_path string, value string"))
    assert sorted((x.file_path, x.entry_count) for x in kept.files().collect()) == [("f", 0), ("g", 1)]
    kept.update(empty)
    assert kept.files().count() == 0 and kept.sums("key").count() == 0


def test_versions(spark, tmp_path):
    v = Versions(spark, str(tmp_path))
    assert v.read() == (0, {})
    path = v.written(spark.range(3), "a")
    assert v.commit(0, {"runs": [path]}) == 1
    with pytest.raises(Conflict):
        v.commit(0, {"runs": []})
    other = v.written(spark.range(4), "a")
    unnamed = v.written(spark.range(5), "a")
    assert v.commit(1, {"runs": [other]}) == 2
    assert v.read(1)[1] == {"runs": [path]} and v.read()[1] == {"runs": [other]}
    assert set(v.vacuum()) == {path, unnamed} and spark.read.parquet(other).count() == 4 and v.numbers() == [2]
