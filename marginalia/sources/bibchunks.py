"""Citation files of any size, each parsed by many tasks: the blocks that bibfile.blocks finds in whole texts.

Spark reads the files as lines, in splits; a task cuts a split into chunks at line ends. Where a block begins depends on all that stands before it, so each chunk
tells, for every state that its first character may meet, the state it leaves (a transition); transitions are composed along a file, and then every chunk is
parsed from the state that it truly meets. A block that goes over chunk borders is put together from its fragments.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.operators import scans
from marginalia.sources import bibfile, bibsource, workspace

CHUNK = 4 << 20
#: States at a line's start: between blocks; after "@" or "@kind" that a brace may follow; inside a block that } or ) closes, by depth.
BETWEEN, AT, KIND = "O", "@", "@k"
LIKELY = (BETWEEN, AT, KIND, "}0", "}1", "}2", ")0", ")1")
_OPENED = re.compile(r"@\s*(?:[A-Za-z]+\s*)?\Z")
_REST_OF = {AT: re.compile(r"\s*[A-Za-z]+\s*([{(])"), KIND: re.compile(r"\s*([{(])")}
_WAITS = {AT: re.compile(r"\s*(?:[A-Za-z]+\s*)?\Z"), KIND: re.compile(r"\s*\Z")}
CHUNKS = "file_path string, start long, sub int"
#: A block's text: the number of its first row in the chunk, how many rows it makes, its kind, and the bare words that its values name.
TEXTS = f"{CHUNKS}, idx int, rows int, kind string, part string, raw string, bare array<string>"


def _close(text: str, at: int, close: str, depth: int) -> tuple[int, int]:
    """Where a block closes that is `depth` braces deep at `at`, else -1 and the depth at the end."""
    end = bibfile.block_end(text, at, close, depth)
    return (end, 0) if end >= 0 else (-1, ~end)


def _closing(brace: str) -> str:
    return "}" if brace == "{" else ")"


class Walk:
    """Where the blocks of a chunk lie, when it begins in a given state.

    head: how much of the chunk belongs to a block that began before (None: all of it). blocks: (start, end) of whole blocks. tail: where a block begins that the chunk
    doesn't end (or what may be one). end: the state at the end. carried: whether the block from before still goes on.
    """

    def __init__(self, text: str, state: str, known: Walk | None = None) -> None:
        self.head: int | None = 0
        self.blocks: list[tuple[int, int]] = []
        self.tail, self.end, self.carried = len(text), BETWEEN, False
        at = 0
        if state in _REST_OF:
            m = _REST_OF[state].match(text)
            if m:
                at = self._first(text, m.end(), _closing(m[1]), 0)
            elif _WAITS[state].match(text):
                self.head, self.carried = None, True
                self.end = KIND if text.strip() else state
                return
        elif state != BETWEEN:
            at = self._first(text, 0, state[0], int(state[1:]))
        if at < 0:
            return
        seen = {a: k for k, (a, _) in enumerate(known.blocks)} if known else {}
        while m := bibfile.HEADER.search(text, at):
            if m.start() in seen:  # from here on as in the known walk
                self.blocks += known.blocks[seen[m.start()] :]
                self.tail, self.end = known.tail, known.end
                return
            if text[text.rfind("\n", 0, m.start()) + 1 : m.start()].lstrip().startswith("%"):
                at = m.end()
                continue
            close = _closing(m[2])
            end, depth = _close(text, m.end(), close, 0)
            if end < 0:
                self.tail, self.end = m.start(), f"{close}{depth}"
                return
            self.blocks.append((m.start(), end + 1))
            at = end + 1
        m = _OPENED.search(text, at)
        if m and not text[text.rfind("\n", 0, m.start()) + 1 : m.start()].lstrip().startswith("%"):
            self.tail, self.end = m.start(), KIND if m[0][1:].strip() else AT

    def _first(self, text: str, at: int, close: str, depth: int) -> int:
        end, depth = _close(text, at, close, depth)
        if end < 0:
            self.head, self.end, self.carried = None, f"{close}{depth}", True
            return -1
        self.head = end + 1
        return end + 1


def transitions(text: str, states: Iterable[str]) -> Iterator[tuple[str, str, bool]]:
    """(state met, state left, carried) of a chunk for each of the states."""
    plain = Walk(text, BETWEEN)
    for state in states:
        walk = plain if state == BETWEEN else Walk(text, state, plain)
        yield state, walk.end, walk.carried


_TOLD = pa.schema([("file_path", pa.string()), ("start", pa.int64()), ("sub", pa.int32()), ("from_state", pa.string()), ("to_state", pa.string()), ("carried", pa.bool_())])


def _told(path: str, start: int, sub: int, text: str, states: Iterable[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_TOLD.names, (path, start, sub, *t))) for t in transitions(text, states)], schema=_TOLD)


def chunks(lines: Iterator[pa.RecordBatch], size: int = CHUNK) -> Iterator[tuple[str, int, int, str]]:
    """(file_path, start, sub, text) from lines (file_path, start, value) as a task reads them: its lines of one split lie together and in order."""
    key, sub, held, n = None, 0, [], 0
    for batch in lines:
        ends = [tuple(batch.column(c)[k].as_py() for c in range(2)) for k in (0, -1)] if len(batch) else []
        # a batch of one split, as most are, names it once: its path is longer than many a line
        names = ends[:1] * len(batch) if ends[:1] == ends[1:] else zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
        for (path, start), value in zip(names, batch.column(2).to_pylist()):
            if (path, start) != key or n >= size:
                if held:
                    yield (*key, sub, "\n".join(held) + "\n")
                key, sub, held, n = (path, start), sub + 1 if (path, start) == key else 0, [], 0
            held.append(value)
            n += len(value) + 1
    if held:
        yield (*key, sub, "\n".join(held) + "\n")


def lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file_path, start, value): the lines of .bib files with where their split starts."""
    read = spark.read.option("lineSep", "\n").text(paths, pathGlobFilter="*.bib", recursiveFileLookup=True)
    return read.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("start"), "value")


def met_states(read: DataFrame, size: int = CHUNK) -> DataFrame:
    """(file_path, start, sub, met, owner_start, owner_sub, unknown), staged: the state that each chunk truly meets, and the chunk where the block that goes on in it began.

    All chunks tell their transitions for the likely states at once. Where composing them along a file comes to a state that a chunk was not asked for,
    it is asked for that and the composition goes on, as often as it takes; files with blocks nested deeper at a border than the likely states need that.
    One group of the composition holds one file's transitions, some hundred bytes for each chunk of `size` characters.
    """
    asked = "from_state string, to_state string, carried boolean"

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, start, sub, text in chunks(batches, size):
            yield _told(path, start, sub, text, LIKELY)

    def compose(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        of: dict[tuple[int, int], dict[str, tuple[str, bool]]] = {}
        for r in group.itertuples(index=False):
            of.setdefault((r.start, r.sub), {})[r.from_state] = (r.to_state, r.carried)
        state, owner, out = BETWEEN, (None, None), []
        for at in sorted(of):
            out.append((key[0], *at, state, *owner, state not in of[at]))
            if state not in of[at]:
                break
            state, carried = of[at][state]
            owner = owner if carried else at if state != BETWEEN else (None, None)
        return pd.DataFrame(out, columns=["file_path", "start", "sub", "met", "owner_start", "owner_sub", "unknown"]).astype({"owner_start": "Int64", "owner_sub": "Int64"})

    made = workspace.staged(read.mapInArrow(tell, f"{CHUNKS}, {asked}"), "transitions")
    told = [made]
    while True:
        every = told[0]
        for more in told[1:]:
            every = every.unionByName(more)
        found = every.groupBy("file_path").applyInPandas(compose, f"{CHUNKS}, met string, owner_start long, owner_sub long, unknown boolean").withColumn("owner_sub", F.col("owner_sub").cast("int"))
        found = workspace.staged(found, "met")
        open_ = found.where("unknown").select("file_path", "start", "sub", "met")
        if open_.isEmpty():
            for t in told:
                workspace.drop(t)
            return found

        def tell_asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for path, start, sub, text, met in zip(*(batch.column(k).to_pylist() for k in range(5))):
                    yield _told(path, start, sub, text, [met])

        # only the files that wait are read again, and only the asked chunks' texts are moved
        texts = _texts(read.join(open_.select("file_path").distinct(), "file_path", "left_semi"), size).join(open_, ["file_path", "start", "sub"])
        told.append(workspace.staged(texts.select("file_path", "start", "sub", "text", "met").mapInArrow(tell_asked, f"{CHUNKS}, {asked}"), "asked"))
        workspace.drop(found)


def _texts(read: DataFrame, size: int) -> DataFrame:
    """(file_path, start, sub, text) of each chunk."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, start, sub, text in chunks(batches, size):
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([start], pa.int64()), pa.array([sub], pa.int32()), pa.array([text])], names=["file_path", "start", "sub", "text"])

    return read.mapInArrow(cut, f"{CHUNKS}, text string")


class _Bare(dict):
    """Macros that remember which bare words were looked up."""

    def __init__(self, *args) -> None:
        super().__init__(*args)
        self.asked: set[str] = set()

    def get(self, key, default=None):
        self.asked.add(key)
        return super().get(key, default)


def parsed(text: str, macros: dict[str, str] | None = None) -> Iterator[dict]:
    """The blocks of a text that begins with a header, with the bare words of each."""
    if bibfile.HEADER.match(text):
        known = _Bare(macros or {})
        for b in bibfile.parse(text, known):
            yield b | {"bare": sorted(known.asked)}


_TEXT = pa.schema([("file_path", pa.string()), ("start", pa.int64()), ("sub", pa.int32()), ("idx", pa.int32()), ("rows", pa.int32()), ("kind", pa.string()), ("part", pa.string()), ("raw", pa.string()), ("bare", pa.list_(pa.string()))])


def _text_row(place: tuple, idx: int, raw: str, found: list[dict]) -> dict:
    return dict(zip(_TEXT.names, (*place, idx, len(found), found[0]["block_type"], None, raw, found[-1]["bare"])))


def blocks(spark: SparkSession, paths: list[str], size: int = CHUNK) -> DataFrame:
    """bibfile.BLOCKS of the .bib files below the paths, equal to bibfile.blocks of their whole texts; a file's size is no task's limit.

    Texts are read twice, and shuffled twice by chunk: with the state that it meets, and with the macros that its blocks name. A block's number comes from the counts of the chunks before. Macros
    are resolved by name and place: bare words are joined with the definitions before them. The definitions of one file are one group. A block itself, also one that
    never closes, is put together in one task. Text that does not end in a line feed is read as if it did. The staged blocks stay in the shared
    folder, as the result reads them.
    """
    return blocks_of(lines(spark, paths), size)


def blocks_of(read: DataFrame, size: int = CHUNK) -> DataFrame:
    """blocks() of files read as lines (file_path, start, value); start orders the splits of a file, whose lines lie together and in order."""
    return numbered(found(read, size))


def found(read: DataFrame, size: int = CHUNK) -> DataFrame:
    """TEXTS of the blocks of blocks_of(), staged, fragments of blocks over borders apart. The files themselves are not read any more after this."""
    met = met_states(read, size)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Whole blocks as rows; fragments of others as rows of the chunk that owns them, of kind begins or more."""
        for batch in batches:
            for path, start, sub, text, state, owner_start, owner_sub in zip(*(batch.column(k).to_pylist() for k in range(7))):
                walk, out, n = Walk(text, state), [], 0
                part = f"{start:020d}/{sub:010d}"  # fragments are put in order by the chunk that they come from
                if state != BETWEEN:
                    out.append(dict(zip(_TEXT.names, (path, owner_start, owner_sub, 0, 0, "more", part, text if walk.head is None else text[: walk.head], []))))
                for a, z in walk.blocks:
                    found = list(parsed(text[a:z]))
                    if found:
                        out.append(_text_row((path, start, sub), n, text[a:z], found))
                    n += len(found)
                    if len(out) >= 2000:
                        yield pa.RecordBatch.from_pylist(out, schema=_TEXT)
                        out = []
                if walk.tail < len(text):
                    out.append(dict(zip(_TEXT.names, (path, start, sub, n, 0, "begins", part, text[walk.tail :], []))))
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=_TEXT)

    texts = _texts(read, size).join(met, ["file_path", "start", "sub"]).select("file_path", "start", "sub", "text", "met", "owner_start", "owner_sub")
    rows = workspace.staged(texts.mapInArrow(cut, TEXTS), "blocks")
    workspace.drop(met)
    return rows


def numbered(rows: DataFrame) -> DataFrame:
    """bibfile.BLOCKS of what found() returns. Blocks over borders are put together and parsed once, and staged: four later steps read them."""
    fragments = rows.where("kind in ('begins', 'more')")
    place = ["file_path", "start", "sub"]
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "raw"))), lambda s: s["raw"]), "")
    joined = fragments.groupBy(*place).agg(text.alias("text"), F.max(F.when(F.col("kind") == "begins", F.col("idx"))).alias("first"))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, sub, text, first in zip(*(batch.column(k).to_pylist() for k in range(5))):
                found = list(parsed(text))
                if found:
                    yield pa.RecordBatch.from_pylist([_text_row((path, start, sub), first, text, found)], schema=_TEXT)

    every = rows.where("kind not in ('begins', 'more')").unionByName(workspace.staged(joined.mapInArrow(whole, TEXTS), "joined"))

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, before, raw, macros in zip(*(batch.column(k).to_pylist() for k in range(4))):
                out += [{"file_path": path, "block_idx": before + k} | b for k, b in enumerate(parsed(raw, dict(macros or ())))]
            for at in range(0, len(out), 2000):
                yield bibsource._batch(out[at : at + 2000], bibsource._ARROW["blocks"])

    known = every.join(_of_chunks(every, place), place)
    return known.select("file_path", (F.col("_before") + F.col("idx")).cast("int").alias("n"), "raw", F.col("_macros")[F.col("idx")].alias("m")).mapInArrow(final, bibfile.BLOCKS)


def _of_chunks(rows: DataFrame, place: list[str]) -> DataFrame:
    """(*place, _before, _macros) of each chunk: the rows of the chunks before it in the file, and for its blocks that name macros, by their number, the last
    definitions before them. One row a chunk, so the texts are moved once to meet it."""

    def resolve(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        macros: dict[str, str] = {}
        out = []
        for r in group.sort_values(["start", "sub", "idx"]).itertuples(index=False):
            out += [(r.file_path, r.start, r.sub, r.idx, b["name"], b["value"]) for b in list(bibfile.parse(r.raw, macros))]
        return pd.DataFrame(out, columns=["file_path", "start", "sub", "idx", "name", "value"])

    counts = rows.groupBy(*place).agg(F.sum("rows").alias("_n"))
    before = F.coalesce(F.expr("sum(_n) OVER (PARTITION BY file_path ORDER BY start, sub ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"), F.lit(0))
    defined = rows.where("kind = 'string'").select(*place, "idx", "raw").groupBy("file_path").applyInPandas(resolve, f"{CHUNKS}, idx int, name string, value string")
    asks = rows.where("size(bare) > 0").select(*place, "idx", F.explode("bare").alias("name"))
    asks = asks.join(defined.select("file_path", "name").distinct(), ["file_path", "name"], "left_semi")
    none = F.lit(None).cast("struct<start:long,sub:int,idx:int,value:string>")
    # definitions and uses of a name in the order of the file; a running maximum carries the last definition on, however often a name is used
    both = defined.select(*place, "idx", "name", F.struct(*place[1:], "idx", "value").alias("_def")).unionByName(asks.withColumn("_def", none))
    names = ["file_path", "name"]
    dealt = scans.ranked(both, names, [*[F.col(c) for c in (*place[1:], "idx")], F.col("_def").isNotNull()], "_r", keep_part=True)  # a block's own definitions come after its uses
    last = scans.prefix(dealt, names, [F.col("_r")], F.col("_def"), F.max, "_last").where("_def is null and _last is not null")
    of_block = last.groupBy(*place, "idx").agg(F.map_from_entries(F.collect_list(F.struct("name", F.col("_last.value")))).alias("m"))
    of_chunk = of_block.groupBy(*place).agg(F.map_from_entries(F.collect_list(F.struct("idx", "m"))).alias("_macros"))
    return counts.withColumn("_before", before).drop("_n").join(of_chunk, place, "left")
