"""Queries over stores that a run writes and reads: the citation source, chunked parsing, maintained counts.

What they write lies below the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marginalia.operators import keys, maintained, scans
from marginalia.plans.catalogue import query, read
from marginalia.plans.forms import CITED_SQL, cited
from marginalia.sources import bibchunks, bibsource, memo, workspace


#: Documents as entries: what would unbalance a value, or be read as a command, is blanked.
TEXT_SQL = r"regexp_replace(coalesce(text, ''), '[{}\\]', ' ', 'g')"


def _text():
    return F.regexp_replace(F.coalesce("text", F.lit("")), r"[{}\\]", " ")


@query(f"""SELECT coalesce(lang, 'none') || '/d' || (doc_id // 100) || '.bib' AS file_path, (row_number() OVER (PARTITION BY coalesce(lang, 'none'), doc_id // 100 ORDER BY doc_id) - 1)::INT AS entry_idx,
    'd' || doc_id AS entry_key, source, md5({TEXT_SQL}) AS digest FROM documents""")
def citation_source_round_trip(spark, sf_dir):
    """Documents as entries of many files: written by the data source, with its checks and its commit, and read by it."""
    path = F.concat(F.coalesce("lang", F.lit("none")), F.lit("/d"), F.floor(F.col("doc_id") / 100).cast("string"), F.lit(".bib"))
    n = F.row_number().over(Window.partitionBy("file_path").orderBy("doc_id")) - 1
    rows = read(spark, sf_dir, "documents").withColumn("file_path", path)
    fields = F.map_filter(F.create_map(F.lit("source"), F.col("source"), F.lit("abstract"), _text()), lambda k, v: v.isNotNull())
    entries = rows.select("file_path", n.cast("int").alias("entry_idx"), F.lit("misc").alias("entry_type"), F.concat(F.lit("d"), "doc_id").alias("entry_key"), fields.alias("fields"))
    folder = workspace.fresh(spark, "citations")
    bibsource.write(entries, folder)
    name = F.regexp_extract("file_path", "[^/]*/[^/]*$", 0)
    return bibsource.read(spark, folder).select(name.alias("file_path"), "entry_idx", "entry_key", F.col("fields")["source"].alias("source"), F.md5(F.col("fields")["abstract"]).alias("digest"))


@query(f"""SELECT 'd' || doc_id AS entry_key, 'From ' || coalesce(source, '') AS title, md5({TEXT_SQL}) AS digest FROM documents""")
def chunked_citation_blocks(spark, sf_dir):
    """Documents as entries of a few large files, each after a macro that the next one redefines, cut into chunks that the longest entries are larger than."""
    rows = read(spark, sf_dir, "documents")
    macro = F.concat(F.lit('@string{s = "From " # {'), F.coalesce("source", F.lit("")), F.lit("}}\n"))
    value = F.concat(macro, F.lit("@misc{d"), "doc_id", F.lit(",\n title = s,\n abstract = {"), _text(), F.lit("}\n}"))
    folder = workspace.fresh(spark, "texts")
    rows.select(value.alias("value")).write.text(folder)
    lines = spark.read.option("lineSep", "\n").text(folder).select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("start"), "value")
    found = bibchunks.found(lines, size=20_000)
    workspace.delete(spark, folder)
    blocks = bibchunks.numbered(found).where("block_type = 'entry'")
    return blocks.select("entry_key", F.col("fields")["title"].alias("title"), F.md5(F.col("fields")["abstract"]).alias("digest"))


@query(f"""WITH {CITED_SQL}, n AS (SELECT file_path, 'k' || (id % 23) AS entry_key, title, id, regexp_extract(file_path, '[0-9]+')::INT AS f FROM c),
    now AS (SELECT file_path, entry_key, CASE WHEN f % 4 = 1 THEN title || ' Revised' ELSE title END AS title FROM n WHERE f % 5 <> 0)
    SELECT entry_key, count(DISTINCT file_path) AS containers, count(DISTINCT lower(title)) AS signatures, count(*) AS entries FROM now GROUP BY 1 HAVING containers > 1 AND signatures > 1""")
def maintained_collisions(spark, sf_dir):
    """Key collisions after an update in which a fifth of the files goes and some change, with the entries of each key."""
    number = F.regexp_extract("file_path", "[0-9]+", 0).cast("int")

    def files(changed: bool) -> DataFrame:
        rows = cited(spark, sf_dir)
        title = F.when((number % 4 == 1) & F.lit(changed), F.concat("title", F.lit(" Revised"))).otherwise(F.col("title"))
        entry = F.concat(F.lit("@misc{k"), (F.col("id") % 23).cast("string"), F.lit(", title = {"), title, F.lit("}}"))
        texts = rows.groupBy("file_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("id", entry.alias("e")))), lambda s: s["e"]), "\n").alias("value"))
        return texts.where(number % 5 != 0) if changed else texts

    kept = maintained.Maintained(spark, workspace.fresh(spark, "maintained"))
    kept.update(files(False))
    kept.update(files(True))
    entries = kept.sums("key").groupBy(F.col("a").alias("entry_key")).agg(F.sum("n").alias("entries"))
    return kept.collisions().join(entries, "entry_key")


@query("""WITH RECURSIVE b AS (SELECT row_number() OVER (ORDER BY doc_id) AS i, doc_id, coalesce(lang, 'paper') || (n_chars % 14) AS base FROM documents),
    most AS (SELECT max(n) + count(*) + 2 AS m FROM (SELECT count(*) AS n FROM b GROUP BY base)),
    g AS (SELECT 0::BIGINT AS i, []::VARCHAR[] AS used, NULL::BIGINT AS doc_id, NULL::VARCHAR AS base, NULL::VARCHAR AS key
          UNION ALL SELECT i, list_append(used, k), doc_id, base, k
          FROM (SELECT b.i, used, b.doc_id, b.base, CASE WHEN list_contains(used, b.base) THEN b.base || list_filter(range(1, m), lambda x: NOT list_contains(used, b.base || x))[1] ELSE b.base END AS k FROM g JOIN b ON b.i = g.i + 1, most))
    SELECT doc_id, base, key FROM g WHERE i > 0""")
def keys_across_bases(spark, sf_dir):
    """Keys of bases that end in digits, so that one base and a number may be another base; the SQL gives them out one by one."""
    base = F.concat(F.coalesce("lang", F.lit("paper")), (F.col("n_chars") % 14).cast("string"))
    return keys.suffixed(read(spark, sf_dir, "documents").select("doc_id", base.alias("base")), "base", ["doc_id"])


@query("""WITH e AS (SELECT event_id, event_type, epoch_us(ts) AS came, ts, CASE event_type WHEN 'error' THEN 7200 ELSE 60 * (user_id % 5) END * 1000000 AS wait FROM events),
    p AS (SELECT *, coalesce(sum(wait) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS p FROM e)
    SELECT event_id, event_type, (p + max(came - p) OVER (PARTITION BY event_type ORDER BY ts, event_id) - came)::BIGINT AS waits FROM p""")
def paced_requests(spark, sf_dir):
    """Each event as a request to the host of its type, planned at its slot: how many microseconds it waits."""
    rows = read(spark, sf_dir, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    wait = F.when(F.col("event_type") == "error", 7200).otherwise(60 * (F.col("user_id") % 5)) * 1_000_000
    planned = scans.paced(rows.select("event_id", "event_type", "ts", at.alias("at"), wait.alias("wait")), ["event_type"], [F.col("ts"), F.col("event_id")], F.col("at"), F.col("wait"))
    return planned.select("event_id", "event_type", (F.col("slot") - F.col("at")).alias("waits"))


RESPONSES_SQL = f"""one AS (SELECT page_id, url, CASE WHEN page_id % 9 = 4 THEN 503 WHEN page_id % 9 = 5 THEN 404 ELSE 200 END AS code, html AS text, TIMESTAMP '2024-01-01' + INTERVAL (page_id % 40) DAY AS came FROM pages WHERE url IS NOT NULL),
    two AS (SELECT page_id, url, CASE WHEN page_id % 7 = 3 THEN 429 ELSE 200 END AS code, 'again ' || text AS text, came + INTERVAL 2 DAY AS came FROM one WHERE length(text) % 3 = 0),
    kept AS (SELECT * FROM one UNION ALL SELECT * FROM two)"""


@query(f"""WITH {RESPONSES_SQL}, ok AS (SELECT * FROM kept WHERE code NOT IN (0, 408, 425, 429) AND code < 500 AND came >= TIMESTAMP '2024-01-11'
      AND NOT ({" OR ".join(f"contains(lower(text), '{m}')" for m in memo.POISON)})),
    best AS (SELECT url, max({{'came': came, 'code': code, 'text': text}}) AS r FROM ok GROUP BY url)
    SELECT url, r.code::INT AS status_code, md5(r.text) AS digest, r.came AS fetched_at FROM best""")
def response_memo(spark, sf_dir):
    """Captured pages remembered, then some of them again: the last usable response of each url."""
    at = F.expr("TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(CAST(page_id % 40 AS INT))")
    code = F.when(F.col("page_id") % 9 == 4, 503).when(F.col("page_id") % 9 == 5, 404).otherwise(200)
    one = read(spark, sf_dir, "pages").where("url is not null").select("page_id", "url", code.alias("status_code"), F.col("html").alias("text"), at.alias("fetched_at"))
    two = one.where(F.length("text") % 3 == 0).select("url", F.when(F.col("page_id") % 7 == 3, 429).otherwise(200).alias("status_code"), F.concat(F.lit("again "), "text").alias("text"), F.expr("fetched_at + INTERVAL 2 DAYS").alias("fetched_at"))
    kept = memo.Memo(spark, workspace.fresh(spark, "memo"), fanout=2)
    since = F.lit("2024-01-11").cast("timestamp")
    kept.remember(one.drop("page_id"), since)
    kept.remember(two, since)
    return kept.table(since).select("url", "status_code", F.md5("text").alias("digest"), "fetched_at")
