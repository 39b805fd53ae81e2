import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marginalia.sources import bibchunks, bibfile

from .test_sources import FILE

PIECES = ["@article{k,\n title = {a {b}\n c},\n year = 2020}\n", "@misc(p, note = {x)\n})\n", "% @book{no,\n title={c}}\n", "@\nbook\n {z,\n t = {deep {er {and {er\n}}}}}\n", "@comment{say @article{in, t={1}}\n}\n", "}\n", "{\n", ")\n", "@ \n", "@word\n", "\\{\n", "text\n", '@string{m = "one", n = m # "two"}\n', "@string{m = m # {!}\n}\n", "@misc{u, a = m, b = n # m}\n", "@preamble{m # \"p\"}\n", "@misc{bad, = 3}\n", "\n"]


def whole(text):
    return [(b["block_type"], b["raw"]) for b in bibfile.parse(text)]


def by_chunks(parts):
    """The blocks' texts by transitions of each part, composed."""
    state, open_, out = bibchunks.BETWEEN, "", []
    for text in parts:
        walk = bibchunks.Walk(text, state)
        told = {a: (b, c) for a, b, c in bibchunks.transitions(text, {*bibchunks.LIKELY, state})}
        assert told[state] == (walk.end, walk.carried)
        if state != bibchunks.BETWEEN:
            open_ += text if walk.head is None else text[: walk.head]
            if not walk.carried:
                out += [(b["block_type"], b["raw"]) for b in bibchunks.parsed(open_)]
        out += [(b["block_type"], b["raw"]) for a, z in walk.blocks for b in bibchunks.parsed(text[a:z])]
        if not walk.carried:
            open_ = text[walk.tail :]
        state = walk.end
    return out + [(b["block_type"], b["raw"]) for b in bibchunks.parsed(open_)] * (state != bibchunks.BETWEEN)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14), st.sets(st.integers(0, 60)))
def test_composed_transitions_find_the_same_blocks(pieces, cuts):
    text = "".join(pieces)
    parts = [[]]
    for n, line in enumerate(text.splitlines(keepends=True)):
        if n in cuts and parts[-1]:
            parts.append([])
        parts[-1].append(line)
    assert by_chunks(["".join(p) for p in parts if p]) == whole(text)


def rows(df):
    return sorted((r.file_path.rpartition("/")[2], r.block_idx, r.block_type, r.name, r.value, r.entry_type, r.entry_key, str(sorted((r.fields or {}).items())), r.raw, r.error) for r in df.collect())


@pytest.mark.parametrize("size,split", [(30, "128m"), (1 << 20, "300b"), (200, "700b")])
def test_files_in_chunks_equal_whole_files(spark, tmp_path, size, split):
    r = random.Random(size)
    for n in range(3):
        (tmp_path / f"f{n}.bib").write_text("".join(r.choice(PIECES) for _ in range(60)))
    (tmp_path / "g.bib").write_text(FILE)
    (tmp_path / "e.bib").write_text("")
    deep = "@misc{deep, t = " + "{\n" * 9 + "x\n" + "}\n" * 9 + "}\n"
    (tmp_path / "h.bib").write_text(deep * 3 + "@misc{last, t = {é🙂}}\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = rows(bibchunks.blocks(spark, [str(tmp_path)], size))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = rows(bibfile.blocks(bibfile.read_files(spark, [str(tmp_path)])))
    assert got == want


def test_one_file_goes_to_many_tasks(spark, tmp_path):
    (tmp_path / "one.bib").write_text('@string{j = "Journal"}\n' + "".join(f"@article{{k{n},\n title = {{T {n}}},\n journal = j\n}}\n" for n in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        assert bibchunks.lines(spark, [str(tmp_path)]).select("start").distinct().count() >= 6
        got = bibchunks.blocks(spark, [str(tmp_path)], 5000).where("block_type = 'entry'")
        assert got.where(F.col("fields")["journal"] == "Journal").count() == 3000
        assert [r.entry_key for r in got.orderBy("block_idx").collect()] == [f"k{n}" for n in range(3000)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_blocks_over_borders_are_parsed_once_and_files_are_read_no_more(spark, tmp_path):
    """Later steps read the joined blocks from a staged table, so only the last parse is left in the plan, and the files may go."""
    file = tmp_path / "one.bib"
    file.write_text('@string{j = "Journal"}\n' + "".join(f"@article{{k{n},\n title = {{T {n}}},\n journal = j\n}}\n" for n in range(200)))
    want = rows(bibfile.blocks(bibfile.read_files(spark, [str(tmp_path)])))
    found = bibchunks.found(bibchunks.lines(spark, [str(tmp_path)]), 50)
    assert found.where("kind = 'begins'").count() > 50
    file.unlink()
    got = bibchunks.numbered(found)
    assert got._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert rows(got) == want
