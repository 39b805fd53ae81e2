"""Duplicate, collision and rule counts that follow the files: an update reads the files that changed and no others.

Counting maintenance: every result is a sum of what each file adds to it. The facts that a file has added are kept. When its sha256 changes, they are taken off and the new ones
added, so the sums stay those of a run over all files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import text as T
from marginalia.operators import duplicates, rules
from marginalia.sources import bibfile
from marginalia.sources.versions import Versions

FACTS = "file_path string, version long, view string, a string, b string, c string, n long"
PLACE = ["view", "a", "b", "c"]


def facts(files: DataFrame) -> DataFrame:
    """(file_path, view, a, b, c, n): what whole files (file_path, value) add.

    Views: key (entry key, file), binding (entry key, file, signature), title (file, normal title, basis; only those that repeat), lint (severity, issue type, file), file (path; its
    entries), error (path, the first error by text).
    """
    blocks = bibfile.blocks(files)
    entries = bibfile.entries(blocks)
    f = F.col("fields")
    none = F.lit(None).cast("string")

    def view(rows: DataFrame, name: str, a: Column, b: Column, c: Column, n: Column) -> DataFrame:
        return rows.groupBy("file_path", F.lit(name).alias("view"), a.cast("string").alias("a"), b.cast("string").alias("b"), c.cast("string").alias("c")).agg(n.cast("long").alias("n"))

    keys = view(entries, "key", F.col("entry_key"), F.col("file_path"), none, F.count("*"))
    signature = T.entry_signature(f["year"], f["title"], f["author"])
    bindings = view(entries, "binding", F.col("entry_key"), F.col("file_path"), signature, F.count("*"))
    titles = view(duplicates.duplicate_titles(rules.profile_entries(entries)), "title", F.col("file_path"), F.col("title_norm"), F.col("basis"), F.max("n"))
    lint = view(rules.lint(entries), "lint", F.col("severity"), F.col("issue_type"), F.col("file_path"), F.count("*"))
    error = F.min(F.when(F.col("block_type") == "error", F.col("error")))
    of = blocks.groupBy("file_path").agg(error.alias("e"), F.count_if(F.col("block_type") == "entry").alias("n"))
    held = view(of, "file", F.col("file_path"), none, none, F.sum("n"))
    errors = view(of.where("e is not null"), "error", F.col("file_path"), F.col("e"), none, F.count("*"))
    return reduce(DataFrame.unionByName, [keys, bindings, titles, lint, held, errors])


class Maintained:
    """The maintained results below a folder.

    Three logs make up a version: files (path, sha256, the version that read it last, or gone), facts (in a folder for each update) and sums (the changes of each update). When a log has `fanout`
    runs, they become one, without what was taken off; so reading costs a sum over few runs, and disk follows what the files hold. Versions are those of sources.versions.
    """

    def __init__(self, spark: SparkSession, folder: str, fanout: int = 6) -> None:
        self.spark, self.versions, self.fanout = spark, Versions(spark, folder), fanout

    def _files(self, runs: list[str]) -> DataFrame:
        """(file_path, sha256, version) of the files that are there."""
        if not runs:
            return self.spark.createDataFrame([], "file_path string, sha256 string, version long")
        rows = self.spark.read.schema("file_path string, sha256 string, version long").parquet(*runs)
        last = rows.groupBy("file_path").agg(F.max_by(F.struct("sha256", "version"), "version").alias("r"))
        return last.select("file_path", "r.*").where("sha256 is not null")

    def update(self, files: DataFrame) -> dict[str, int]:
        """Brings the results up to the files (file_path, value), which are all that there are now: path and whole text, one row each.

        Returns how many were added, changed, gone and left alone. Without a change there is no new version.
        """
        parent, at = self.versions.read()
        number = parent + 1
        runs = {name: list(at.get(name, [])) for name in ("files", "facts", "sums")}
        now = files.select("file_path", F.sha2(F.encode(F.coalesce("value", F.lit("")), "UTF-8"), 256).alias("now"))
        both = now.join(self._files(runs["files"]), "file_path", "full_outer")
        kind = F.when(F.col("sha256").isNull(), "added").when(F.col("now").isNull(), "gone").when(F.col("now") != F.col("sha256"), "changed").otherwise("same")
        marked = self.versions.written(both.select("file_path", "now", "version", kind.alias("kind")), "marked")
        found = self.spark.read.parquet(marked)
        counts = {"added": 0, "changed": 0, "gone": 0, "same": 0} | {r["kind"]: r["count"] for r in found.groupBy("kind").count().collect()}
        if counts["added"] + counts["changed"] + counts["gone"]:
            changed = found.where("kind in ('added', 'changed')")
            new = facts(files.join(changed.select("file_path"), "file_path", "left_semi").select("file_path", F.coalesce("value", F.lit("")).alias("value")))
            new_run = self.versions.written(new.withColumn("version", F.lit(number).cast("long")).select("file_path", "version", *PLACE, "n"), "facts")
            delta = self._facts([new_run]).select(*PLACE, "n")
            off = found.where("kind in ('changed', 'gone')").select("file_path", "version")
            if runs["facts"]:
                old = self._facts(runs["facts"]).join(off, ["file_path", "version"], "left_semi")
                delta = delta.unionByName(old.select(*PLACE, (-F.col("n")).alias("n")))
            delta = delta.groupBy(*PLACE).agg(F.sum("n").alias("n")).where("n <> 0")
            log = found.where("kind <> 'same'").select("file_path", F.col("now").alias("sha256"), F.lit(number).cast("long").alias("version"))
            runs["files"].append(self.versions.written(log, "files"))
            runs["facts"].append(new_run)
            runs["sums"].append(self.versions.written(delta, "sums"))
            self.versions.commit(parent, self._compacted(runs))
        self.versions.delete([marked])
        return counts

    def _facts(self, runs: list[str]) -> DataFrame:
        return self.spark.read.schema(FACTS).parquet(*runs)

    def _sums(self, runs: list[str]) -> DataFrame:
        rows = self.spark.read.schema("view string, a string, b string, c string, n long").parquet(*runs)
        return rows.groupBy(*PLACE).agg(F.sum("n").alias("n")).where("n <> 0")

    def _compacted(self, runs: dict[str, list[str]]) -> dict[str, list[str]]:
        files = self._files(runs["files"])
        if len(runs["facts"]) >= self.fanout:  # a file's facts of an older version than its last are no one's
            runs["facts"] = [self.versions.written(self._facts(runs["facts"]).join(files.select("file_path", "version"), ["file_path", "version"], "left_semi"), "facts")]
        if len(runs["sums"]) >= self.fanout:
            runs["sums"] = [self.versions.written(self._sums(runs["sums"]), "sums")]
        if len(runs["files"]) >= self.fanout:
            runs["files"] = [self.versions.written(files, "files")]
        return runs

    def sums(self, view: str) -> DataFrame:
        """(a, b, c, n) of a view at the latest version."""
        runs = self.versions.read()[1].get("sums", [])
        if not runs:
            return self.spark.createDataFrame([], "a string, b string, c string, n long")
        return self._sums(runs).where(F.col("view") == view).drop("view")

    def duplicate_keys(self) -> DataFrame:
        """(file_path, entry_key, n) of keys that repeat in a file."""
        return self.sums("key").where("n > 1").select(F.col("b").alias("file_path"), F.col("a").alias("entry_key"), "n")

    def collisions(self) -> DataFrame:
        """(entry_key, containers, signatures) of keys in several files under several signatures."""
        out = self.sums("binding").groupBy(F.col("a").alias("entry_key")).agg(F.countDistinct("b").alias("containers"), F.countDistinct("c").alias("signatures"))
        return out.where("containers > 1 and signatures > 1")

    def duplicate_titles(self) -> DataFrame:
        return self.sums("title").select(F.col("a").alias("file_path"), F.col("b").alias("title_norm"), F.col("c").alias("basis"), "n")

    def issues(self) -> DataFrame:
        """(severity, issue_type, n)."""
        return self.sums("lint").groupBy(F.col("a").alias("severity"), F.col("b").alias("issue_type")).agg(F.sum("n").alias("n"))

    def files(self) -> DataFrame:
        """(file_path, sha256, entry_count, error_message) of every file."""
        held = self._files(self.versions.read()[1].get("files", []))
        of = self.sums("file").select(F.col("a").alias("file_path"), F.col("n").alias("entry_count"))
        errors = self.sums("error").select(F.col("a").alias("file_path"), F.col("b").alias("error_message"))
        return held.join(of, "file_path", "left").join(errors, "file_path", "left").select("file_path", "sha256", F.coalesce("entry_count", F.lit(0)).alias("entry_count"), "error_message")
