"""Citation files: a parser written from scratch, a renderer, light scans, and the tables that they fill.

Contract of the parser: entries, comments, preambles and string macros; braced, quoted and bare values; `#` joins; macros are expanded;
the first field may stand on the header line; `%` lines outside of entries are skipped; braces inside values stay and
must balance; an escaped brace is text; field names are lower-cased, of repeated fields the last wins; accent commands become letters.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marginalia.sources import workspace

ENTRIES = "file_path string, entry_idx int, entry_type string, entry_key string, fields map<string,string>, raw string"
BLOCKS = "file_path string, block_idx int, block_type string, name string, value string, entry_type string, entry_key string, fields map<string,string>, raw string, error string"
# Accent commands and their combining marks, commands that are letters, and the order of fields in a canonical file.
MARKS = {"`": "̀", "'": "́", "^": "̂", "~": "̃", "=": "̄", "u": "̆", ".": "̇", '"': "̈", "r": "̊", "H": "̋", "v": "̌", "d": "̣", "c": "̧", "k": "̨"}
LETTERS = {"ss": "ß", "ae": "æ", "AE": "Æ", "oe": "œ", "OE": "Œ", "o": "ø", "O": "Ø", "l": "ł", "L": "Ł", "aa": "å", "AA": "Å", "i": "ı", "j": "ȷ"}
FIELD_ORDER = ["author", "title", "booktitle", "journal", "editor", "series", "volume", "number", "pages", "publisher", "address", "organization", "school", "institution", "year", "month", "doi", "url", "pdf"]
ACCENT = re.compile(r"\{?\\([`'^~=.\"])\s*\{?\\?([a-zA-Z])\}?\}?|\{?\\([uvHcdkr])(?:\s+([a-zA-Z])|\s*\{\\?([a-zA-Z])\})\}?")
LETTER = re.compile(r"\{\\(ss|ae|AE|oe|OE|o|O|l|L|aa|AA|i|j)\}|\\(ss|ae|AE|oe|OE|o|O|l|L|aa|AA|i|j)(?![a-zA-Z])\s?")
HEADER = re.compile(r"@\s*([A-Za-z]+)\s*([{(])")


def unicode_text(value: str) -> str:
    """Accent and letter commands as letters."""

    def accent(m: re.Match) -> str:
        mark, letter = (m[1], m[2]) if m[1] else (m[3], m[4] or m[5])
        return unicodedata.normalize("NFC", letter + MARKS[mark])

    return LETTER.sub(lambda m: LETTERS[m[1] or m[2]], ACCENT.sub(accent, value)) if "\\" in value else value


# A set of characters comes first, so that the text between marks is passed quickly; a backslash takes the character after it.
_MARKS = {"}": re.compile(r"[{}\\](?:(?<=\\).)?", re.S), ")": re.compile(r"[{})\\](?:(?<=\\).)?", re.S)}


def block_end(text: str, at: int, close: str, depth: int = 0) -> int:
    """Where a block that was opened before `at`, and is `depth` braces deep there, closes; ~depth at the end if it doesn't. Braces nest, escaped ones don't count."""
    for m in _MARKS[close].finditer(text, at):
        c = m[0]
        if c == "{":
            depth += 1
        elif c == "}" and depth:
            depth -= 1
        elif c == close and not depth:
            return m.start()
    return ~depth


def value(text: str, at: int, macros: dict[str, str]) -> tuple[str, int]:
    """A field value from `at`: parts joined by #; returns it and where it ends."""
    parts = []
    while True:
        while at < len(text) and text[at].isspace():
            at += 1
        if at < len(text) and text[at] == "{":
            end = block_end(text, at + 1, "}")
            if end < 0:
                raise ValueError("a value does not close")
            parts.append(text[at + 1 : end])
            at = end + 1
        elif at < len(text) and text[at] == '"':
            end, depth = at + 1, 0
            while end < len(text) and (text[end] != '"' or depth):
                depth += {"{": 1, "}": -1}.get(text[end], 0)
                end += 2 if text[end] == "\\" else 1
            parts.append(text[at + 1 : end])
            at = end + 1
        else:
            m = re.compile(r"[^\s,#{}()\"]+").match(text, at)
            if not m:
                raise ValueError("a value is missing")
            parts.append(macros.get(m[0].lower(), m[0]))
            at = m.end()
        m = re.compile(r"\s*#").match(text, at)
        if not m:
            return "".join(parts), at
        at = m.end()


def fields(body: str, macros: dict[str, str]) -> dict[str, str]:
    """`name = value` pairs, split by commas."""
    out, at = {}, 0
    while m := re.compile(r"[\s,]*([^\s=,{}\"#%'()]+)\s*=").match(body, at):
        found, at = value(body, m.end(), macros)
        out[m[1].lower()] = unicode_text(found)
    if body[at:].strip(" \t\r\n,"):
        raise ValueError(f"not a field: {body[at:].strip()[:40]}")
    return out


def parse(text: str, macros: dict[str, str] | None = None) -> Iterator[dict]:
    """Blocks of a file in order: entry, comment, preamble, string, error. macros: those known before; definitions are added to them."""
    macros = {} if macros is None else macros
    at = 0
    while m := HEADER.search(text, at):
        line = text.rfind("\n", 0, m.start()) + 1
        if text[line : m.start()].lstrip().startswith("%"):
            at = m.end()
            continue
        kind, close = m[1].lower(), "}" if m[2] == "{" else ")"
        end = block_end(text, m.end(), close)
        if end < 0:
            yield {"block_type": "error", "error": f"{kind} does not close", "raw": text[m.start() :]}
            return
        body, raw, at = text[m.end() : end], text[m.start() : end + 1], end + 1
        try:
            if kind == "comment":
                yield {"block_type": "comment", "value": body, "raw": raw}
            elif kind == "preamble":
                yield {"block_type": "preamble", "value": value(body, 0, macros)[0], "raw": raw}
            elif kind == "string":
                for name, v in fields(body, macros).items():
                    macros[name] = v
                    yield {"block_type": "string", "name": name, "value": v, "raw": raw}
            else:
                key, _, rest = body.partition(",")
                yield {"block_type": "entry", "entry_type": kind, "entry_key": key.strip(), "fields": fields(rest, macros), "raw": raw}
        except ValueError as e:
            yield {"block_type": "error", "error": str(e), "raw": raw}


def blocks(files: DataFrame, path_col: str = "file_path", text_col: str = "value") -> DataFrame:
    """All blocks of files (path, whole text)."""
    from marginalia.sources.bibsource import _ARROW, BATCH, _batch  # it builds on this module

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        for batch in batches:
            for at in range(len(batch)):  # a file at a time: a task holds the blocks of BATCH rows, however many files a batch has
                path, text = (batch.column(c)[at].as_py() for c in range(2))
                for k, b in enumerate(parse(text or "")):
                    rows.append({"file_path": path, "block_idx": k} | b)
                    if len(rows) >= BATCH:
                        yield _batch(rows, _ARROW["blocks"])
                        rows = []
        if rows:
            yield _batch(rows, _ARROW["blocks"])

    return files.select(path_col, text_col).mapInArrow(emit, BLOCKS)


def read_files(spark: SparkSession, paths: list[str], exclude: str | None = None) -> DataFrame:
    """(file_path, value, size, mtime, ord): whole files below paths, in the priority of the paths; exclude: a regular expression on the path."""
    parts = []
    for k, p in enumerate(paths):
        one = spark.read.text(p, wholetext=True, pathGlobFilter="*.bib", recursiveFileLookup=True)
        parts.append(one.select(F.col("_metadata.file_path").alias("file_path"), "value", F.col("_metadata.file_size").alias("size"), F.col("_metadata.file_modification_time").alias("mtime"), F.lit(k).alias("ord")))
    out = parts[0]
    for one in parts[1:]:
        out = out.unionByName(one)
    out = out.withColumn("_n", F.row_number().over(Window.partitionBy("file_path").orderBy("ord"))).where("_n = 1").drop("_n")
    return out.where(~F.col("file_path").rlike(exclude)) if exclude else out


def entries(found: DataFrame) -> DataFrame:
    """The entries of blocks, numbered within their file."""
    rows = found.where("block_type = 'entry'")
    n = F.row_number().over(Window.partitionBy("file_path").orderBy("block_idx")) - 1
    return rows.select("file_path", n.cast("int").alias("entry_idx"), "entry_type", "entry_key", "fields", "raw")


def file_table(files: DataFrame, found: DataFrame) -> DataFrame:
    """One row a file: parse_ok, entry_count, error_message, mtime, size, sha256, generated."""
    of = found.groupBy("file_path").agg(F.count_if(F.col("block_type") == "entry").alias("entry_count"), F.min(F.when(F.col("block_type") == "error", F.col("error"))).alias("error_message"))
    head = F.lower(F.concat_ws("\n", F.slice(F.split("value", "\n"), 1, 8)))
    out = files.select("file_path", "size", "mtime", F.sha2(F.encode("value", "UTF-8"), 256).alias("sha256"), head.contains("generated from dblp xml dump").alias("generated"))
    out = out.join(of, "file_path", "left").withColumn("entry_count", F.coalesce("entry_count", F.lit(0)))
    return out.withColumn("parse_ok", F.col("error_message").isNull())


def light_scan(files: DataFrame) -> DataFrame:
    """(file_path, line, entry_key) of header lines, by pattern alone; other blocks than entries are left out."""
    lines = files.select("file_path", F.posexplode(F.split("value", "\n")).alias("pos", "l"))
    key = F.regexp_extract("l", r"(?i)^\s*@(?!string|preamble|comment)[a-z]+\s*\{\s*([^,\s]+)", 1)
    return lines.select("file_path", (F.col("pos") + 1).alias("line"), key.alias("entry_key")).where("entry_key <> ''")


def rendered(rows: DataFrame, first: list[str] | None = None, trailing_comma: bool = True, indent: str = "  ") -> DataFrame:
    """Adds bib, the canonical text of each entry: fields in the given order, then the others by name."""
    order = F.create_map(*[v for k, n in enumerate(first or FIELD_ORDER) for v in (F.lit(n), F.lit(k))])
    items = F.array_sort(F.transform(F.map_entries("fields"), lambda e: F.struct(F.coalesce(F.element_at(order, e["key"]), F.lit(999)).alias("r"), e["key"].alias("k"), e["value"].alias("v"))))
    lines = F.transform(items, lambda e: F.concat(F.lit(indent), e["k"], F.lit(" = {"), e["v"], F.lit("}")))
    body = F.array_join(lines, ",\n")
    return rows.withColumn("bib", F.concat(F.lit("@"), "entry_type", F.lit("{"), "entry_key", F.lit(",\n"), body, F.lit(",\n}" if trailing_comma else "\n}")))


def files_of(rows: DataFrame, order: str = "entry_idx", separator: str = "\n\n") -> DataFrame:
    """(file_path, value): each file's entries (with bib) as one text, in order."""
    return rows.groupBy("file_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, "bib"))), lambda s: s["bib"]), separator).alias("value"))


def guard(before: DataFrame, after: DataFrame, more_comments: int = 0) -> DataFrame:
    """Files whose rewrite must not be taken: entries lost, or more comments than allowed. before and after: blocks."""
    count = lambda df, s: df.groupBy("file_path").agg(F.count_if(F.col("block_type") == "entry").alias(f"e{s}"), F.count_if(F.col("block_type") == "comment").alias(f"c{s}"), F.count_if(F.col("block_type") == "error").alias(f"x{s}"))
    both = count(before, 0).join(count(after, 1), "file_path", "left").fillna(0)
    return both.where((F.col("e1") < F.col("e0")) | (F.col("c1") > F.col("c0") + more_comments) | (F.col("x1") > 0))


def write_checked(spark: SparkSession, rows: DataFrame, before: DataFrame, folder: str) -> DataFrame:
    """Renders rows and writes the files that pass the guard to `folder`, one .bib file for each file_path; returns those that fail it.

    The new texts are staged beside the folder, parsed anew and compared with `before` first. A file that passes is written under a
    passing name, what it replaces is kept as a rollback copy until the new one is in place, and is put back if that fails. A file that fails
    the guard is left as it is. Files are put one by one; bibsource.write puts all or none.
    """
    made = workspace.staged(files_of(rendered(rows)), "rewritten")
    try:
        bad = workspace.staged(guard(before, blocks(made)).select("file_path"), "rejected")
        good = made.join(bad, "file_path", "left_anti")
        written = good.select("file_path", "value").mapInPandas(_putter(folder), "file_path string").count()
    finally:
        workspace.drop(made)
    return bad.withColumn("written", F.lit(written).cast("long"))


def _putter(folder: str):
    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        for frame in frames:
            for path, text in zip(frame["file_path"], frame["value"]):
                to = f"{root.rstrip('/')}/{path.lstrip('/')}"
                store.create_dir(to.rpartition("/")[0], recursive=True)
                new, old = f"{to}.{uuid.uuid4().hex}.new", f"{to}.{uuid.uuid4().hex}.rollback"
                with store.open_output_stream(new) as f:
                    f.write((text + "\n").encode())
                had = store.get_file_info(to).type == pyarrow.fs.FileType.File
                if had:
                    store.copy_file(to, old)
                try:
                    store.move(new, to)
                except OSError:
                    if had:
                        store.move(old, to)
                    raise
                if had:
                    store.delete_file(old)
            yield frame[["file_path"]]

    return put


def without_comments(found: DataFrame, keep: str) -> DataFrame:
    """Blocks without the comments, but for one that starts with `keep`; files with several of those stay as they are."""
    kept = (F.col("block_type") == "comment") & F.startswith(F.trim("value"), F.lit(keep))
    n = found.groupBy("file_path").agg(F.count_if(kept).alias("_n"))
    return found.join(n, "file_path").where((F.col("block_type") != "comment") | kept | (F.col("_n") > 1)).drop("_n")
