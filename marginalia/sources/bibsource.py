"""Citation files as a data source of Spark: `spark.read.format("bib")` and `df.write.format("bib")`, after register(spark).

Files are found and opened by pyarrow's file systems (local paths, hdfs, s3, gs). Reading: one partition holds files of about `bytes` together. Writing is
in two phases: tasks write new texts beside the folder's files and check them; the driver moves them into place when every task has ended well.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, In, InputPartition, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import StructType

from marginalia.sources import bibfile

BATCH = 2000
MARK = "_bib-"
_STRINGS = pa.map_(pa.string(), pa.string())
_ARROW = {
    "entries": pa.schema([("file_path", pa.string()), ("entry_idx", pa.int32()), ("entry_type", pa.string()), ("entry_key", pa.string()), ("fields", _STRINGS), ("raw", pa.string())]),
    "blocks": pa.schema([("file_path", pa.string()), ("block_idx", pa.int32()), *[(c, pa.string()) for c in ("block_type", "name", "value", "entry_type", "entry_key")], ("fields", _STRINGS), ("raw", pa.string()), ("error", pa.string())]),
}


def register(spark: SparkSession) -> None:
    """Makes the format known to the session, and lets the session push filters into Python sources, which it does not by default."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BibSource)


class BibSource(DataSource):
    """Options for reading: path (a folder, a file, or several joined by a comma, in their priority), rows (entries or blocks), exclude (a regular
    expression on paths), bytes. For writing: path, fewer, comments, rollback, raw, trailing_comma, separator; see BibWriter."""

    @classmethod
    def name(cls) -> str:
        return "bib"

    def schema(self) -> str:
        return bibfile.BLOCKS if self.options.get("rows") == "blocks" else bibfile.ENTRIES

    def reader(self, schema: StructType) -> BibReader:
        return BibReader(dict(self.options))

    def writer(self, schema: StructType, overwrite: bool) -> BibWriter:
        return BibWriter(dict(self.options), schema, overwrite)


def listed(paths: list[str], exclude: str | None = None) -> list[tuple[str, int]]:
    """(path, size) of each .bib file below the paths, in the priority of the paths; a file found twice counts once. Folders and files of a write
    that has not ended are passed over."""
    found: dict[str, int] = {}
    for p in paths:
        store, root = pyarrow.fs.FileSystem.from_uri(p)
        prefix = p[: len(p) - len(root)] if p.endswith(root) else ""
        head = store.get_file_info(root)
        infos = [head] if head.type == pyarrow.fs.FileType.File else store.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
        for f in sorted(infos, key=lambda f: f.path):
            if f.type == pyarrow.fs.FileType.File and f.path.endswith(".bib") and not re.search(r"/[_.][^/]*(/|$)", f.path[len(root) :]):
                if not (exclude and re.search(exclude, f.path)):
                    found.setdefault(prefix + f.path, f.size)
    return list(found.items())


def text_of(path: str) -> str:
    store, at = pyarrow.fs.FileSystem.from_uri(path)
    with store.open_input_stream(at) as f:
        return f.read().decode("utf-8", errors="replace")


@dataclass
class Files(InputPartition):
    paths: list[str]


class BibReader(DataSourceReader):
    """Partitions by files. Filters on file_path (=, IN, prefix) leave files unread."""

    def __init__(self, options: dict[str, str]) -> None:
        self.rows = options.get("rows", "entries")
        self.paths = options["path"].split(",")
        self.exclude = options.get("exclude")
        self.bytes = int(options.get("bytes", 32 << 20))
        self.only: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In, StringStartsWith)) and f.attribute == ("file_path",):
                self.only.append(f)
            else:
                yield f

    def _wanted(self, path: str) -> bool:
        return all(path == f.value if isinstance(f, EqualTo) else path in f.value if isinstance(f, In) else path.startswith(f.value) for f in self.only)

    def partitions(self) -> list[Files]:
        out, size = [], 0
        for path, n in listed(self.paths, self.exclude):
            if self._wanted(path):
                if not out or size + n > self.bytes:
                    out.append(Files([]))
                    size = 0
                out[-1].paths.append(path)
                size += n
        return out or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        schema, rows = _ARROW[self.rows], []
        for path in partition.paths:
            n = 0
            for k, b in enumerate(bibfile.parse(text_of(path))):
                if self.rows == "entries":
                    if b["block_type"] != "entry":
                        continue
                    row = {"file_path": path, "entry_idx": n} | b
                else:
                    row = {"file_path": path, "block_idx": k} | b
                n += 1
                rows.append(row)
                if len(rows) >= BATCH:
                    yield _batch(rows, schema)
                    rows = []
        if rows:
            yield _batch(rows, schema)


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    value = lambda r, c: list(r[c].items()) if c == "fields" and r.get(c) is not None else r.get(c)
    return pa.record_batch([pa.array([value(r, f.name) for r in rows], f.type) for f in schema], schema=schema)


def rendered_entry(kind: str, key: str, fields: dict[str, str], trailing_comma: bool = True) -> str:
    """The canonical text of an entry, as bibfile.rendered makes it."""
    order = {n: k for k, n in enumerate(bibfile.FIELD_ORDER)}
    names = sorted(fields, key=lambda n: (order.get(n, 999), n))
    body = ",\n".join(f"  {n} = {{{fields[n]}}}" for n in names)
    return f"@{kind}{{{key},\n{body}" + (",\n}" if trailing_comma else "\n}")


@dataclass
class Written(WriterCommitMessage):
    #: (staged path, name below the folder, sha256, entries) of each file of a task
    files: list[tuple[str, str, str, int]]


class IntegrityError(ValueError):
    """A new text must not take a file's place."""


class BibWriter(DataSourceWriter):
    """Writes rows (file_path, entry_idx, entry_type, entry_key, fields, and raw if it is there) as one file for each file_path.

    A file's rows must lie in one task, together and in order: see write(). A task writes its files under a passing name of its own attempt, reads each back and
    checks it: it must parse without errors into the keys that were written, with no fewer entries than the file that it is to replace (unless `fewer` is
    true) and with at most `comments` comments more. With `raw`, rows that have a raw text are written as it stands, and so is what stands around
    them in the old file: comments, preambles and macros go first. Nothing of the folder is touched before the driver has every task's message. It then moves old
    files aside and new ones in, puts all back if a move fails, and deletes what was aside at the end. A failed or killed task, or two that wrote
    one file, abort the job: the old files stay. Where a check fails and `rollback` names a folder, the old and the new text are copied there.

    Mode append leaves other files of the folder alone, overwrite removes the .bib files that were not written anew.
    """

    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool) -> None:
        flag = lambda name, default: options.get(name, default).lower() == "true"
        self.folder = options["path"].rstrip("/")
        self.stage = f"{self.folder}/{MARK}{uuid.uuid4().hex}"
        self.overwrite, self.names = overwrite, schema.fieldNames()
        self.fewer, self.raw, self.trailing_comma = flag("fewer", "false"), flag("raw", "false"), flag("trailing_comma", "true")
        self.comments, self.separator, self.rollback = int(options.get("comments", 0)), options.get("separator", "\n\n"), options.get("rollback")
        missing = {"file_path", "entry_idx", "entry_type", "entry_key", "fields"} - set(self.names)
        if missing:
            raise ValueError(f"columns are missing: {sorted(missing)}")

    def _below(self, file_path: str) -> str:
        plain = lambda p: re.sub(r"^[a-z0-9]+:/*(?=/)", "", p)
        path, folder = plain(file_path), plain(self.folder)
        name = (path[len(folder) :] if path.startswith(folder + "/") else path).lstrip("/")
        if not name or ".." in name.split("/"):
            raise ValueError(f"not a path below the folder: {file_path!r}")
        return name

    def write(self, iterator: Iterator) -> Written:
        store, at = pyarrow.fs.FileSystem.from_uri(self.stage)
        at = f"{at}/{uuid.uuid4().hex}"
        done: list[tuple[str, str, str, int]] = []
        path, rows, last = None, [], None

        def finish() -> None:
            if path is not None:
                done.append(self._put(store, at, len(done), path, rows))

        for row in iterator:
            r = dict(zip(self.names, row))
            if r["file_path"] != path:
                finish()
                path, rows, last = r["file_path"], [], None
            if last is not None and r["entry_idx"] <= last:
                raise IntegrityError(f"{path}: entries are not in order, or repeat a number")
            last = r["entry_idx"]
            rows.append(r)
        finish()
        return Written(done)

    def _put(self, store: pyarrow.fs.FileSystem, at: str, n: int, path: str, rows: list[dict]) -> tuple[str, str, str, int]:
        name = self._below(path)
        old_at = pyarrow.fs.FileSystem.from_uri(self.folder)[1] + "/" + name
        had = store.get_file_info(old_at).type == pyarrow.fs.FileType.File
        old = text_of(f"{self.folder}/{name}") if had else ""
        before = list(bibfile.parse(old))
        keep_raw = lambda r: self.raw and r.get("raw")
        parts = [b["raw"] for b in before if b["block_type"] in ("comment", "preamble", "string")] if self.raw else []
        parts = list(dict.fromkeys(parts))  # one @string block may define several macros
        parts += [r["raw"] if keep_raw(r) else rendered_entry(r["entry_type"], r["entry_key"], r["fields"] or {}, self.trailing_comma) for r in rows]
        text = self.separator.join(parts) + "\n"
        after = list(bibfile.parse(text))
        kinds = lambda blocks, kind: sum(b["block_type"] == kind for b in blocks)
        problem = None
        if kinds(after, "error"):
            problem = "the new text does not parse: " + next(b["error"] for b in after if b["block_type"] == "error")
        elif [b["entry_key"] for b in after if b["block_type"] == "entry"] != [r["entry_key"] for r in rows]:
            problem = "the new text holds other entries than were written"
        elif len(rows) < kinds(before, "entry") and not self.fewer:
            problem = f"{len(rows)} entries would replace {kinds(before, 'entry')}"
        elif kinds(after, "comment") > kinds(before, "comment") + self.comments:
            problem = "comments would be added"
        if problem:
            if self.rollback:
                _store(f"{self.rollback.rstrip('/')}/{name}.{uuid.uuid4().hex}.original", old)
                _store(f"{self.rollback.rstrip('/')}/{name}.{uuid.uuid4().hex}.candidate", text)
            raise IntegrityError(f"{name}: {problem}")
        staged = f"{at}/{n}.bib"
        store.create_dir(at, recursive=True)
        with store.open_output_stream(staged) as f:
            f.write(text.encode())
        return staged, name, hashlib.sha256(text.encode()).hexdigest(), len(rows)

    def commit(self, messages: list[Written | None]) -> None:
        files = [f for m in messages if m for f in m.files]
        names = [name for _, name, _, _ in files]
        if len(set(names)) < len(names):
            self.abort(messages)
            raise IntegrityError(f"several tasks wrote {sorted({n for n in names if names.count(n) > 1})[:20]}; deal rows by file_path")
        store, root = pyarrow.fs.FileSystem.from_uri(self.folder)
        stage = pyarrow.fs.FileSystem.from_uri(self.stage)[1]
        gone = {p[len(self.folder) + 1 :] for p, _ in listed([self.folder])} - set(names) if self.overwrite and store.get_file_info(root).type == pyarrow.fs.FileType.Directory else set()
        aside: list[str] = []
        placed: list[str] = []
        try:
            for name in [*names, *sorted(gone)]:
                if store.get_file_info(f"{root}/{name}").type == pyarrow.fs.FileType.File:
                    store.create_dir(f"{stage}/old/{name}".rpartition("/")[0], recursive=True)
                    store.move(f"{root}/{name}", f"{stage}/old/{name}")
                    aside.append(name)
            for staged, name, _, _ in files:
                store.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                store.move(staged, f"{root}/{name}")
                placed.append(name)
        except Exception:
            for name in placed:
                store.delete_file(f"{root}/{name}")
            for name in aside:
                store.move(f"{stage}/old/{name}", f"{root}/{name}")
            self.abort(messages)
            raise
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        """Deletes what was staged; the folder's own files are as commit() left them."""
        store, stage = pyarrow.fs.FileSystem.from_uri(self.stage)
        if store.get_file_info(stage).type == pyarrow.fs.FileType.Directory:
            store.delete_dir(stage)


def _store(path: str, text: str) -> None:
    store, at = pyarrow.fs.FileSystem.from_uri(path)
    store.create_dir(at.rpartition("/")[0], recursive=True)
    with store.open_output_stream(at) as f:
        f.write(text.encode())


def write(entries: DataFrame, folder: str, mode: str = "append", **options: str) -> None:
    """entries as files below `folder`, dealt by file and in order; a file is one task's work, as it is one stream of bytes."""
    register(entries.sparkSession)
    dealt = entries.repartition("file_path").sortWithinPartitions("file_path", "entry_idx")
    dealt.write.format("bib").options(path=folder, **options).mode(mode).save()


def read(spark: SparkSession, folder: str, **options: str) -> DataFrame:
    register(spark)
    return spark.read.format("bib").options(**options).load(folder)
