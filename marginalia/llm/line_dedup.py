"""Line dedup by levelled sorted runs of line hashes. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = " \t\n\x0b\x0c\r"
KEY = ["k1", "k2"]


def line_key(line: Column) -> Column:
    """The line without `[\\x20\\x09-\\x0D]` at both ends and with A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(WHITE)), UPPER, LOWER)


def _hash_input(line: Column) -> Column:
    """A text that is equal for two lines if and only if their keys are, and cheap to make.

    Lower-casing touches more than A-Z in other than ASCII text, so that is taken byte by byte as ISO-8859-1: there
    lower() maps lead bytes only, and no two UTF-8 texts that differ in more than A-Z meet.
    """
    key = F.trim(line, F.lit(WHITE))
    plain = F.octet_length(key) == F.length(key)
    return F.when(plain, F.lower(key)).otherwise(F.lower(F.decode(F.encode(key, "UTF-8"), "ISO-8859-1")))


class LineRuns:
    """Sorted runs of (key, documents), in levels, as tables in the shared folder that lie in buckets by key.

    Each new batch is merge-anti-joined with the settled runs, whose keys have been found in `limit` documents already. What is left
    is merge-joined with the open runs for the documents counted so far and becomes a run of its own: keys that reach the limit with it
    are settled, the others are open. When a level holds `fanout` runs, they are compacted into one run of the next level, without the keys
    settled meanwhile, so a key is rewritten once a level. Runs are never shuffled again.
    """

    def __init__(self, spark: SparkSession, limit: int, fanout: int = 3) -> None:
        self.spark, self.limit, self.fanout = spark, limit, fanout
        self.levels: list[list[DataFrame]] = []
        self.settled: list[DataFrame] = []

    def _unsettled(self, counts: DataFrame) -> DataFrame:
        for run in self.settled:
            counts = counts.join(run.hint("merge"), KEY, "left_anti")
        return counts

    def unseen(self, batch: DataFrame) -> DataFrame:
        """The batch's keys that no run holds."""
        batch = self._unsettled(batch)
        for run in (r for level in self.levels for r in level):
            batch = batch.join(run.select(*KEY).hint("merge"), KEY, "left_anti")
        return batch

    def add(self, counts: DataFrame) -> None:
        """Adds a batch: (k1, k2, n), one row a key."""
        left = self._unsettled(counts).withColumn("total", F.col("n"))
        for run in (r for level in self.levels for r in level):
            before = run.withColumnRenamed("n", "before").hint("merge")
            left = left.join(before, KEY, "left").select(*KEY, "n", (F.col("total") + F.coalesce("before", F.lit(0))).alias("total"))
        made = common.sorted_run(left, KEY)
        self.settled.append(made.where(F.col("total") >= self.limit).select(*KEY))
        self._put(0, made.where(F.col("total") < self.limit).select(*KEY, "n"))

    def _put(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = reduce(DataFrame.unionByName, self.levels[level]).groupBy(*KEY).agg(F.sum("n").alias("n"))
            merged = common.sorted_run(self._unsettled(merged), KEY)
            self.levels[level] = []
            if len(self.settled) >= self.fanout:
                self.settled = [common.sorted_run(self.frequent(), KEY)]
            self._put(level + 1, merged)

    def frequent(self) -> DataFrame:
        """The keys found in at least `limit` documents over all batches."""
        return reduce(DataFrame.unionByName, self.settled)


@common.tidy
def frequent_positions(rows: DataFrame, doc: list[str], min_docs: int, batches: int, fanout: int) -> DataFrame:
    """(*doc, bad): of each document the positions of lines that at least `min_docs` documents have; rows: (*doc, k1, k2, at)."""
    rows = common.staged(rows.withColumn("batch", F.pmod(F.xxhash64(*doc), F.lit(batches)).cast("int")), "lines", by="batch")
    runs = LineRuns(rows.sparkSession, min_docs, fanout)
    for b in range(batches):
        runs.add(rows.where(F.col("batch") == b).groupBy(*KEY).agg(F.count("*").alias("n")))
    frequent = common.staged(runs.frequent(), "frequent")
    return rows.join(frequent, KEY, "left_semi").groupBy(*doc).agg(F.flatten(F.collect_list("at")).alias("bad"))


def drop_frequent_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 3) -> DataFrame:
    """All columns of docs, with text rewritten, and n_lines, n_dropped.

    Lines whose key (see line_key) has at least `min_chars` code points and is found in at least `min_docs`
    documents go everywhere; others stay, joined by a line feed. Each row counts as one document; rows that repeat id and text count once. A null or empty text
    is one empty line, which never counts if min_chars is at least 1; the result is then the empty text. Rows with a null
    or repeated id are treated by their own text. An empty table gives no rows. Columns of docs whose names clash with the
    added ones are replaced.

    The documents come in `batches` batches, which LineRuns takes in turn; a pass splits them all into keys and positions before.
    Lines are told apart by 128 bits. Only keys and positions are shuffled, and texts once, by id.
    """
    lines = F.split(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "\n", -1)
    own = [F.col(id_col).alias("__m_id"), F.xxhash64(text_col).alias("__m_h1"), F.xxhash64(F.lit("text"), text_col).alias("__m_h2")]
    doc = ["__m_id", "__m_h1", "__m_h2"]
    rows = docs.select(*own, F.posexplode(lines).alias("pos", "line"))
    rows = rows.where(F.length(F.trim("line", F.lit(WHITE))) >= min_chars).withColumn("x", _hash_input(F.col("line")))
    rows = rows.select(*doc, "pos", F.xxhash64("x").alias("k1"), F.xxhash64(F.lit("line"), "x").alias("k2"))
    rows = rows.groupBy(*doc, *KEY).agg(F.collect_set("pos").alias("at"))
    bad = frequent_positions(rows, doc, min_docs, batches, fanout).withColumnRenamed("bad", "__m_bad")
    bad = bad.withColumnsRenamed({"__m_id": "__m_bid", "__m_h1": "__m_b1", "__m_h2": "__m_b2"})
    added = {"n_lines", "n_dropped", text_col}
    base = docs.select("*", *own)
    joined = base.join(bad, base["__m_id"].eqNullSafe(bad["__m_bid"]) & (base["__m_h1"] == bad["__m_b1"]) & (base["__m_h2"] == bad["__m_b2"]), "left")
    joined = joined.withColumn("__m_lines", lines).withColumn("__m_bad", F.coalesce("__m_bad", F.array().cast("array<int>")))
    good = F.array_except(F.sequence(F.lit(0), F.size("__m_lines") - 1), F.col("__m_bad"))
    left = F.when(F.size("__m_bad") == 0, F.coalesce(F.col(text_col).cast("string"), F.lit(""))).otherwise(F.array_join(F.transform(good, lambda p: F.get("__m_lines", p)), "\n"))
    keep = [F.col(f"`{c}`") for c in docs.columns if c not in added]
    return joined.select(*keep, left.alias(text_col), F.size("__m_lines").cast("long").alias("n_lines"), F.size("__m_bad").cast("long").alias("n_dropped"))
