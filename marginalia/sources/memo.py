"""A memo of responses by url: a versioned table that merges, expires and drops what is poisoned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.operators import rules
from marginalia.sources.versions import Versions

ROW = "digest string, url string, status_code int, text string, fetched_at timestamp"
# Texts that show a refusal or a wait instead of an answer.
POISON = ["too many requests:", "surpassing the limit of", "please try again in", "the server responded with the following message", "attention required! | cloudflare", "cf-chl-", "verify you are human"]


def poisoned(code: Column, text: Column) -> Column:
    """A response that must not be remembered: none at all, one that may pass by itself, a server's error, or a refusal in its text."""
    code = F.coalesce(code, F.lit(0))
    return code.isin(0, 408, 425, 429) | (code >= 500) | rules.has_any(text, POISON)


def _last(rows: DataFrame) -> DataFrame:
    """One row a url: the latest, and of one instant the one that sorts last."""
    rest = [c for c in rows.columns if c not in ("digest", "url")]
    return rows.groupBy("digest", "url").agg(F.max(F.struct("fetched_at", "status_code", "text")).alias("r")).select("digest", "url", *[F.col(f"r.{c}") for c in rest])


class Memo:
    """The remembered responses below a folder. remember() adds a run of one version; `fanout` runs of a level become one of the next, in which each url stands
    once and what has expired, or is poisoned, is left out. Readers see the version that they opened, whole, also while a merge is written.
    """

    def __init__(self, spark: SparkSession, folder: str, fanout: int = 4) -> None:
        self.spark, self.versions, self.fanout = spark, Versions(spark, folder), fanout

    def _read(self, runs: list[str]) -> DataFrame:
        return self.spark.read.schema(ROW).parquet(*runs) if runs else self.spark.createDataFrame([], ROW)

    @staticmethod
    def _usable(rows: DataFrame, since: Column | None) -> DataFrame:
        rows = rows.where(~poisoned(F.col("status_code"), F.col("text")))
        return rows if since is None else rows.where(F.col("fetched_at") >= since)

    def remember(self, responses: DataFrame, since: Column | None = None) -> int:
        """Adds responses (url, status_code, text, fetched_at) that are worth it; null urls and times are passed over. since: what is older has expired, and
        goes when its runs are merged. Returns the version."""
        parent, at = self.versions.read()
        rows = responses.where("url is not null and fetched_at is not null")
        rows = rows.select(F.sha2("url", 256).alias("digest"), "url", F.col("status_code").cast("int").alias("status_code"), F.coalesce("text", F.lit("")).alias("text"), F.col("fetched_at").cast("timestamp").alias("fetched_at"))
        levels = [list(x) for x in at.get("levels", [])]
        run, level = self.versions.written(_last(self._usable(rows, since)), "run"), 0
        while True:
            if len(levels) <= level:
                levels.append([])
            levels[level].append(run)
            if len(levels[level]) < self.fanout:
                break
            run = self.versions.written(_last(self._usable(self._read(levels[level]), since)), "run")
            levels[level], level = [], level + 1
        return self.versions.commit(parent, {"levels": levels})

    def table(self, since: Column | None = None, version: int | None = None) -> DataFrame:
        """(digest, url, status_code, text, fetched_at) of one version, the latest if none is named: each url's last response that has not expired."""
        levels = self.versions.read(version)[1].get("levels", [])
        return _last(self._usable(self._read([r for level in levels for r in level]), since))

    def known(self, urls: DataFrame, since: Column | None = None) -> DataFrame:
        """The rows of urls (url and more) with status_code, text and fetched_at of their remembered response, null if there is none. Only the asked digests' rows
        are gathered."""
        levels = self.versions.read()[1].get("levels", [])
        asked = urls.withColumn("digest", F.sha2("url", 256))
        held = self._usable(self._read([r for level in levels for r in level]), since).join(asked.select("digest").distinct(), "digest", "left_semi")
        return asked.join(_last(held).drop("url"), "digest", "left").drop("digest")
