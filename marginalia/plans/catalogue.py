"""The operators bound to the supplied tables, each with SQL for DuckDB that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.functions import similarity as S
from marginalia.functions import text as T
from marginalia.operators import coverage, decide, duplicates, keys, matching, reconcile, rules, tracking
from marginalia.sources import workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict:
    from marginalia.plans import forms, stores  # noqa: F401  their queries register here

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from marginalia.plans import forms, stores  # noqa: F401

    return dict(SQL)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def norm_sql(x: str) -> str:
    folded = f"regexp_replace(translate(lower(regexp_replace({x}, '[{{}}]', '', 'g')), 'àáâäãéèêëíìîïóòôöõúùûüñçß', 'aaaaaeeeeiiiiooooouuuunc'), '[^\\x00-\\x7F]', '', 'g')"
    return f"trim(regexp_replace(regexp_replace({folded}, '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g'))"


def spaces_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


HOST_SQL = "lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1))"
FINGERPRINT_SQL = "regexp_replace(regexp_replace(lower(trim(url)), '^https?://', ''), '/+$', '')"

# --- the log that several queries read: events as attempts -------------------------------------------------------------

LOG_SQL = """log AS (SELECT event_id, 'f' || (event_id % 7) AS file_path, user_id AS entry_key, ts, event_type, value,
    CASE WHEN event_type IN ('purchase', 'signup') THEN 'success' WHEN event_type = 'error' THEN 'failed' ELSE 'skipped' END AS status FROM events)"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    state = F.when(F.col("event_type").isin("purchase", "signup"), "success").when(F.col("event_type") == "error", "failed").otherwise("skipped")
    return e.select("event_id", F.concat(F.lit("f"), F.col("event_id") % 7).alias("file_path"), F.col("user_id").alias("entry_key"), "ts", "event_type", "value", state.alias("status"))


# --- duplicates and rules ----------------------------------------------------------------------------------------------


@query(f"SELECT lang, {norm_sql('text')} AS text_norm, count(*) AS n FROM documents WHERE {norm_sql('text')} <> '' GROUP BY ALL HAVING count(*) > 1")
def duplicate_title_in_group(spark, sf_dir):
    rows = T.with_normal(read(spark, sf_dir, "documents").select("lang", "text"), "text", "text_norm").where("text_norm <> ''")
    return duplicates.long_multiplicity(rows, ["lang"], "text_norm")


@query("SELECT conv_id, role, count(*) AS n FROM conversations GROUP BY ALL HAVING count(*) > 1")
def duplicate_key_in_file(spark, sf_dir):
    return duplicates.multiplicity(read(spark, sf_dir, "conversations"), ["conv_id", "role"])


@query("""SELECT l_partkey, count(DISTINCT l_suppkey) AS containers, count(DISTINCT (l_returnflag, l_linestatus)) AS signatures,
    array_to_string(list_sort(list_distinct(list(l_suppkey::VARCHAR))), ', ') AS container_list FROM lineitem GROUP BY 1
    HAVING count(DISTINCT l_suppkey) > 1 AND count(DISTINCT (l_returnflag, l_linestatus)) > 1""")
def duplicate_key_global(spark, sf_dir):
    return duplicates.global_collisions(read(spark, sf_dir, "lineitem"), "l_partkey", "l_suppkey", ["l_returnflag", "l_linestatus"])


MISSING_SQL = "concat_ws(', ', CASE WHEN trim(coalesce(text, '')) = '' THEN 'text' END, CASE WHEN lang IS NULL THEN 'lang' END, CASE WHEN quality IS NULL THEN 'quality' END, CASE WHEN toxic IS NULL THEN 'toxic' END)"


def _missing(spark, sf_dir) -> DataFrame:
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    lacks = rules.found((~T.filled("text"), "text"), (F.col("lang").isNull(), "lang"), (F.col("quality").isNull(), "quality"), (F.col("toxic").isNull(), "toxic"))
    return rows.select("doc_id", "lang", F.array_join(lacks, ", ").alias("missing"))


@query(f"SELECT doc_id, {MISSING_SQL} AS missing FROM documents LEFT JOIN labels USING (doc_id) WHERE {MISSING_SQL} <> ''")
def missing_required_fields(spark, sf_dir):
    return _missing(spark, sf_dir).where("missing <> ''").select("doc_id", "missing")


PART_KEY_SQL = "regexp_replace(p_brand, ' ', '', 'g') || (1900 + p_size) || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE lower(split_part(p_name, ' ', 1)) END"
KEY_ISSUES_SQL = f"""k AS (SELECT p_partkey, {PART_KEY_SQL} AS k, (1900 + p_size + p_partkey % 2)::VARCHAR AS y FROM part),
    ki AS (SELECT p_partkey, k, 'only a-z and 0-9 may stand in a key' AS message FROM k WHERE NOT regexp_matches(k, '^[a-z0-9]+$')
    UNION ALL SELECT p_partkey, k, 'no year in the key' FROM k WHERE NOT regexp_matches(k, '[0-9]{{4}}')
    UNION ALL SELECT p_partkey, k, 'key and entry differ in the year' FROM k WHERE regexp_extract(k, '([0-9]{{4}})', 1) NOT IN ('', y)
    UNION ALL SELECT p_partkey, k, 'nothing follows the year in the key' FROM k WHERE regexp_matches(k, '[0-9]{{4}}') AND length(regexp_extract(k, '^(.*?[0-9]{{4}})', 1)) = length(k))"""


def _part_keys(spark, sf_dir) -> DataFrame:
    word = F.when(F.col("p_partkey") % 3 == 0, "").otherwise(F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))))
    key = F.concat(F.regexp_replace("p_brand", " ", ""), (1900 + F.col("p_size")).cast("string"), word)
    rows = read(spark, sf_dir, "part").select("p_partkey", key.alias("k"), (1900 + F.col("p_size") + F.col("p_partkey") % 2).cast("string").alias("y"))
    return rows.select("p_partkey", "k", F.explode(rules.key_findings(F.col("k"), F.col("y"))).alias("message"))


@query(f"WITH {KEY_ISSUES_SQL} SELECT * FROM ki")
def key_format_issues(spark, sf_dir):
    return _part_keys(spark, sf_dir)


ISSUES_SQL = f"""{KEY_ISSUES_SQL},
    d AS (SELECT doc_id, lang, {norm_sql("text")} AS t FROM documents),
    issues AS (SELECT 'warning' AS severity, 'duplicate_title_in_file' AS issue_type, lang AS entry_key FROM (SELECT lang, t FROM d WHERE t <> '' GROUP BY ALL HAVING count(*) > 1)
    UNION ALL SELECT 'error', 'missing_required_fields', doc_id::VARCHAR FROM documents LEFT JOIN labels USING (doc_id) WHERE {MISSING_SQL} <> ''
    UNION ALL SELECT 'warning', 'key_format', p_partkey::VARCHAR FROM ki)"""


def _issues(spark, sf_dir) -> DataFrame:
    one = lambda df, severity, kind, key: df.select(F.lit(severity).alias("severity"), F.lit(kind).alias("issue_type"), F.col(key).cast("string").alias("entry_key"))
    parts = [one(duplicate_title_in_group(spark, sf_dir), "warning", "duplicate_title_in_file", "lang"), one(missing_required_fields(spark, sf_dir), "error", "missing_required_fields", "doc_id"), one(_part_keys(spark, sf_dir), "warning", "key_format", "p_partkey")]
    return reduce(DataFrame.unionByName, parts)


@query(f"""WITH {ISSUES_SQL} SELECT 'severity' AS level, severity AS name, count(*) AS n FROM issues GROUP BY severity
    UNION ALL SELECT 'issue_type', issue_type, count(*) FROM issues GROUP BY issue_type UNION ALL SELECT 'all', '', count(*) FROM issues""")
def lint_summary_by_severity(spark, sf_dir):
    return rules.summary(_issues(spark, sf_dir))


@query(f"""WITH {ISSUES_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY issue_type ORDER BY entry_key) AS n, count(*) OVER (PARTITION BY issue_type) AS c FROM issues)
    SELECT severity, issue_type, entry_key, NULL::BIGINT AS suppressed FROM r WHERE n <= 200
    UNION ALL SELECT 'issue_limit_reached', issue_type, NULL, any_value(c) - 200 FROM r WHERE c > 200 GROUP BY issue_type""")
def issue_cap_per_type(spark, sf_dir):
    return rules.capped(_issues(spark, sf_dir), [F.col("entry_key")], 200)


# --- urls and pages ----------------------------------------------------------------------------------------------------


@query(f"SELECT page_id, {FINGERPRINT_SQL} AS fingerprint, {HOST_SQL} AS host, count(*) OVER (PARTITION BY {HOST_SQL}) AS same_host FROM pages")
def url_fingerprint(spark, sf_dir):
    rows = read(spark, sf_dir, "pages").select("page_id", T.url_fingerprint("url").alias("fingerprint"), T.host("url").alias("host"))
    return rows.join(rows.groupBy("host").agg(F.count("*").alias("same_host")), "host")


@query(f"""WITH p AS (SELECT page_id, url, regexp_replace(trim(url), '#.*$', '') AS u, {HOST_SQL} AS host FROM pages),
    q AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(u, '\\?(.*)$', 1), '&'), lambda x: regexp_matches(x, '^[^=]+=.+$') AND NOT starts_with(lower(x), 'utm_'))) AS kept FROM p)
    SELECT page_id, CASE WHEN host = '' THEN '' ELSE host || regexp_replace(regexp_extract(u, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+([^?]*)', 1), '/+$', '') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END END AS fingerprint FROM q""")
def url_query_canonical(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.query_fingerprint("url").alias("fingerprint"))


@query(f"SELECT page_id, {HOST_SQL} AS host, ({HOST_SQL} <> '') AND (ends_with({HOST_SQL}, '.example.org') OR {HOST_SQL} = 'example.org' OR ends_with({HOST_SQL}, '.example.net') OR {HOST_SQL} = 'example.net') AS allowed FROM pages")
def domain_allowlist(spark, sf_dir):
    rows = read(spark, sf_dir, "pages").select("page_id", T.host("url").alias("host"))
    return rows.withColumn("allowed", T.host_in(F.col("host"), ["example.org", "example.net"]))


@query(f"SELECT {HOST_SQL} AS host, count(*) AS pages, count(*) * (count(*) - 1) // 2 AS pairs, min(page_id) AS first_page, max(page_id) AS last_page FROM pages GROUP BY 1 HAVING count(*) > 1 AND host <> ''")
def same_host_pairs(spark, sf_dir):
    """Pairs of pages on one host: as classes with their size, for the pairs of a hot host grow with its square."""
    rows = read(spark, sf_dir, "pages").select("page_id", T.host("url").alias("host")).where("host <> ''")
    n = F.count("*")
    return rows.groupBy("host").agg(n.alias("pages"), F.expr("count(*) * (count(*) - 1) div 2").alias("pairs"), F.min("page_id").alias("first_page"), F.max("page_id").alias("last_page")).where("pages > 1")


PATH_SQL = "regexp_extract(regexp_replace(lower(url), '^[a-z][a-z0-9+.-]*://[^/?#]*', ''), '^([^?#]*)', 1)"


@query(f"SELECT page_id, regexp_matches({PATH_SQL}, '\\.pdf$|/pdf/|/pdf$') OR regexp_matches(regexp_extract(lower(url), '\\?([^#]*)', 1), 'format=pdf|download=pdf|pdf=') AS is_pdf FROM pages")
def pdf_url_heuristic(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.pdf_like("url").alias("is_pdf"))


@query("SELECT page_id, regexp_matches(url, '(?i)^https?://') AS http, starts_with(url, 'https:') AS https FROM pages")
def url_scheme_rule(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.col("url").rlike("(?i)^https?://").alias("http"), F.startswith("url", F.lit("https:")).alias("https"))


TITLE_SQL = spaces_sql("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)")


@query(f"SELECT page_id, {TITLE_SQL} AS title FROM pages")
def html_title_extract(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.spaces(F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)).alias("title"))


STRIP_SQL = "trim(regexp_replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g'))"


@query(f"SELECT page_id, CASE WHEN {STRIP_SQL} = '' THEN 0 ELSE len(string_split({STRIP_SQL}, ' ')) END AS words, length({STRIP_SQL}) AS chars FROM pages")
def html_strip_tags_wordcount(spark, sf_dir):
    rows = read(spark, sf_dir, "pages").select("page_id", T.strip_tags("html").alias("t"))
    return rows.select("page_id", T.word_count("t").alias("words"), F.length("t").alias("chars"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_prop_extract(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.coalesce(F.get_json_object("props", "$.k.value"), F.get_json_object("props", "$.k")).alias("k"))


@query(f"""SELECT page_id, CASE WHEN regexp_matches(url, '^https://blog\\.') THEN 0 WHEN regexp_matches(url, 'example\\.org') THEN 1 WHEN regexp_matches(url, '.') THEN 2 END AS rule,
    CASE WHEN regexp_matches(url, '^https://blog\\.') THEN 'blog' WHEN regexp_matches(url, 'example\\.org') THEN 'org' WHEN regexp_matches(url, '.') THEN 'other' END AS role FROM pages""")
def first_rule_wins(spark, sf_dir):
    table = [{"pattern": r"^https://blog\.", "role": "blog"}, {"pattern": r"example\.org", "role": "org"}, {"pattern": ".", "role": "other"}]
    return matching.first_rule(read(spark, sf_dir, "pages"), table, F.col("url")).select("page_id", "rule", "role")


@query()
def brace_balance(spark, sf_dir):
    rows = read(spark, sf_dir, "pages").select("page_id", "html", T.balanced_braces("html").alias("clean"))
    return rows.select("page_id", (F.length("html") - F.length("clean")).alias("dropped"))


# --- tracking ----------------------------------------------------------------------------------------------------------

@query(f"WITH {LOG_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY file_path, entry_key ORDER BY ts DESC, event_id DESC) AS n FROM log) SELECT file_path, entry_key, status, ts, event_id FROM r WHERE n = 1")
def latest_status(spark, sf_dir):
    return tracking.latest(log(spark, sf_dir), ["file_path", "entry_key"], ["ts", "event_id"], ["status", "ts", "event_id"])


@query(f"""WITH {LOG_SQL} SELECT file_path, count(DISTINCT entry_key) AS total, count(DISTINCT CASE WHEN status = 'success' THEN entry_key END) AS success,
    count(DISTINCT CASE WHEN status = 'failed' THEN entry_key END) AS failed, count(DISTINCT CASE WHEN status = 'skipped' THEN entry_key END) AS skipped FROM log GROUP BY 1""")
def enrichment_stats(spark, sf_dir):
    return tracking.distinct_by_status(log(spark, sf_dir), "file_path", "entry_key", "status", ["success", "failed", "skipped"])


@query(f"""WITH {LOG_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY file_path, entry_key ORDER BY ts DESC, event_id DESC) AS n FROM log)
    SELECT file_path, entry_key, status, ts FROM r WHERE n = 1 AND status = 'failed' AND ts < TIMESTAMP '2024-01-25 00:00:00'""")
def retry_candidates(spark, sf_dir):
    return tracking.retry_candidates(log(spark, sf_dir), ["file_path", "entry_key"], ["ts", "event_id"], F.lit("2024-01-25 00:00:00").cast("timestamp_ntz"))


@query(f"WITH {LOG_SQL}, c AS (SELECT file_path, entry_key, count(*) FILTER (status = 'failed') AS failures FROM log GROUP BY ALL) SELECT *, least(2 * pow(2, failures), 300)::DOUBLE AS backoff FROM c")
def retry_counts_backoff(spark, sf_dir):
    return tracking.failure_counts(log(spark, sf_dir), ["file_path", "entry_key"])


@query(f"""WITH {LOG_SQL} SELECT ts::DATE::VARCHAR AS day, count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (status = 'skipped') AS skipped
    FROM log GROUP BY 1 ORDER BY 1 DESC LIMIT 10""")
def recent_activity_daily(spark, sf_dir):
    return tracking.daily(log(spark, sf_dir), "ts", "status", ["success", "failed", "skipped"], 10).withColumn("day", F.col("day").cast("string"))


@query(f"""WITH {LOG_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY file_path, entry_key ORDER BY ts DESC, event_id DESC) AS n FROM log)
    SELECT event_id, CASE WHEN n = 1 THEN 'checked' ELSE status END AS status FROM r""")
def update_latest_only(spark, sf_dir):
    out = tracking.update_latest(log(spark, sf_dir), ["file_path", "entry_key"], [F.desc("ts"), F.desc("event_id")], {"status": F.lit("checked")})
    return out.select("event_id", "status")


def _files(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))


@query("""SELECT count(o_orderkey) AS entries, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS files, count(DISTINCT CASE WHEN f THEN o_orderkey END) AS matched, count(*) FILTER (NOT f) AS missing_files,
    (SELECT count(DISTINCT l_orderkey) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS orphaned_files, round(100.0 * count(DISTINCT CASE WHEN f THEN o_orderkey END)::DOUBLE / count(o_orderkey), 2) AS score
    FROM (SELECT o_orderkey, o_orderkey IN (SELECT l_orderkey FROM lineitem) AS f FROM orders)""")
def bijection_stats(spark, sf_dir):
    return tracking.bijection(read(spark, sf_dir, "orders"), _files(spark, sf_dir), "o_orderkey")


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def entries_missing_file(spark, sf_dir):
    return reconcile.anti(read(spark, sf_dir, "orders"), _files(spark, sf_dir), ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


@query("""SELECT l_orderkey AS o_orderkey, sum(l_quantity) AS size FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1 ORDER BY size DESC""")
def orphaned_files_by_size(spark, sf_dir):
    files = read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_quantity").alias("size"))
    return reconcile.anti(files, read(spark, sf_dir, "orders").where("o_orderstatus <> 'P'"), ["o_orderkey"]).orderBy(F.desc("size"))


@query("SELECT o_orderpriority, count(*) AS n, sum(CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem) THEN 1 ELSE 0 END)::BIGINT AS with_file FROM orders GROUP BY 1")
def stats_by_file_mark_join(spark, sf_dir):
    rows = reconcile.marked(read(spark, sf_dir, "orders"), _files(spark, sf_dir), "o_orderkey", "has_file")
    return rows.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_if("has_file").alias("with_file"))


TOP_SQL = """g AS (SELECT o_orderpriority || '/' || year(o_orderdate) AS name, count(*) AS n, count(*) FILTER (o_orderkey IN (SELECT l_orderkey FROM lineitem)) AS found FROM orders GROUP BY 1),
    p AS (SELECT name, n, found, round(100.0 * found::DOUBLE / n, 1) AS coverage FROM g)"""


@query(f"WITH {TOP_SQL} SELECT * FROM (SELECT *, 'best' AS side FROM p ORDER BY coverage DESC, name LIMIT 5) UNION ALL SELECT * FROM (SELECT *, 'worst' AS side FROM p ORDER BY coverage, name LIMIT 5)")
def top_n_coverage(spark, sf_dir):
    rows = reconcile.marked(read(spark, sf_dir, "orders"), _files(spark, sf_dir), "o_orderkey", "has_file")
    name = F.concat("o_orderpriority", F.lit("/"), F.year("o_orderdate").cast("string"))
    groups = rows.groupBy(name.alias("name")).agg(F.count("*").alias("n"), F.count_if("has_file").alias("found")).withColumn("coverage", T.percent(F.col("found"), F.col("n"), 1))
    return coverage.best_and_worst(groups, "coverage", "name", 5)


@query("""SELECT CASE WHEN grouping(source) = 0 THEN 'file' WHEN grouping(lang) = 0 THEN 'group' ELSE 'total' END AS level, coalesce(source, lang, '') AS name, count(*) AS n,
    count(*) FILTER (quality IS NOT NULL) AS labelled, count(*) FILTER (trim(coalesce(text, '')) <> '') AS text,
    round(100.0 * count(*) FILTER (quality IS NOT NULL)::DOUBLE / count(*), 2) AS labelled_pct, round(100.0 * count(*) FILTER (trim(coalesce(text, '')) <> '')::DOUBLE / count(*), 2) AS text_pct
    FROM documents LEFT JOIN labels USING (doc_id) GROUP BY GROUPING SETS ((source), (lang), ())""")
def coverage_grouping_sets(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").join(read(spark, sf_dir, "labels"), "doc_id", "left")
    rows = rows.select("source", "lang", F.col("quality").isNotNull().alias("has_label"), T.filled("text").alias("has_text"))
    return coverage.cube(rows, "source", "lang", {"labelled": F.col("has_label"), "text": F.col("has_text")})


# --- reconciliation and matching ---------------------------------------------------------------------------------------


@query("""SELECT CASE WHEN o.k IS NULL THEN 'extra' WHEN l.k IS NULL THEN 'missing' ELSE 'matched' END AS class, count(*) AS n
    FROM (SELECT o_orderkey AS k FROM orders WHERE o_orderkey % 3 <> 0) o FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey % 2 = 0) l ON o.k = l.k GROUP BY 1""")
def reconcile_full_outer(spark, sf_dir):
    source, held = read(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0"), _files(spark, sf_dir).where("o_orderkey % 2 = 0")
    return reconcile.classify(source, held, "o_orderkey").groupBy("class").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) ORDER BY o_orderkey")
def missing_in_order(spark, sf_dir):
    return reconcile.missing_in_order(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), _files(spark, sf_dir), "o_orderkey", "o_orderkey")


@query("""WITH a AS (SELECT s_suppkey AS k, count(*) AS n, min(s_suppkey) AS r FROM supplier GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS n, min(s_suppkey) AS r FROM supplier GROUP BY 1)
    SELECT c_custkey, CASE WHEN a.n = 1 THEN a.r WHEN a.n IS NULL AND b.n = 1 THEN b.r END AS s_suppkey, CASE WHEN a.n IS NOT NULL THEN 'key' WHEN b.n IS NOT NULL THEN 'nation' END AS stage, coalesce(a.n, b.n) AS matches
    FROM customer LEFT JOIN a ON a.k = c_custkey LEFT JOIN b ON b.k = c_nationkey""")
def cascade_match(spark, sf_dir):
    return matching.cascade(read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier"), "c_custkey", "s_suppkey", [("key", F.col("c_custkey"), F.col("s_suppkey")), ("nation", F.col("c_nationkey"), F.col("s_nationkey"))])


@query("""WITH r AS (SELECT event_id, 'f' || (event_id % 7) AS path, event_type, user_id FROM events)
    SELECT event_id, CASE WHEN event_type = 'error' AND contains(path, 'f1') THEN 'outage' WHEN event_type = 'error' THEN 'known' WHEN event_type = 'view' AND user_id % 2 = 0 THEN 'even' END AS exception,
    coalesce(CASE WHEN event_type = 'error' AND contains(path, 'f1') THEN DATE '2024-06-01' WHEN event_type = 'error' THEN DATE '2023-06-01' WHEN event_type = 'view' AND user_id % 2 = 0 THEN DATE '2023-01-01' END < DATE '2024-01-15', false) AS expired FROM r""")
def exception_ledger(spark, sf_dir):
    rows = read(spark, sf_dir, "events").select("event_id", F.concat(F.lit("f"), F.col("event_id") % 7).alias("path"), "event_type", (F.col("user_id") % 2).cast("string").alias("adapter"))
    ledger = spark.sql("""SELECT * FROM VALUES ('error', 'f1', CAST(NULL AS STRING), 'outage', DATE '2024-06-01'), ('error', NULL, NULL, 'known', DATE '2023-06-01'),
        ('view', NULL, '0', 'even', DATE '2023-01-01') AS t(key, path_contains, adapter, reason, review_after)""")
    return matching.with_exception(rows, ledger, "event_type", "path", "adapter", F.lit("2024-01-15").cast("date")).select("event_id", "exception", "expired")


@query(f"""WITH r AS (SELECT doc_id, lang, {MISSING_SQL} AS m FROM documents LEFT JOIN labels USING (doc_id)), n AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS k FROM r WHERE m <> '')
    SELECT doc_id, lang, m AS missing FROM n WHERE k <= 20""")
def plan_missing_fields(spark, sf_dir):
    rows = _missing(spark, sf_dir)
    lacks = F.filter(F.split("missing", ", "), lambda x: x != "")
    return decide.planned(rows, lacks, "lang", [F.col("doc_id")], 20).select("doc_id", "lang", "missing")


@query(f"""WITH m AS (SELECT doc_id, lang, text, url, html, {norm_sql("coalesce(lang, '')")} AS old_lang FROM documents LEFT JOIN pages ON doc_id = page_id),
    v AS (SELECT doc_id, url, text, coalesce(lang, '') AS old, regexp_extract(url, '/(en|de|fr|es)/', 1) AS new, regexp_extract(coalesce(html, ''), '(?s)<title>(.*?)</title>', 1) AS title FROM m),
    r AS (SELECT doc_id, url, CASE WHEN url IS NULL OR trim(coalesce(new, '')) = '' THEN 'empty' WHEN NOT ends_with({HOST_SQL}, '.example.com') THEN 'domain_not_allowed' WHEN trim(old) <> '' AND {norm_sql("old")} = {norm_sql("new")} THEN 'equivalent' WHEN trim(old) <> '' THEN 'protected_mismatch' END AS r1,
          CASE WHEN url IS NULL OR trim(title) = '' THEN 'empty' WHEN NOT ends_with({HOST_SQL}, '.example.com') THEN 'domain_not_allowed' END AS r2 FROM v)
    SELECT doc_id, CASE WHEN url IS NULL THEN 'unresolved' WHEN r1 IS NULL OR r2 IS NULL THEN 'planned_update' ELSE 'skipped' END AS status,
           concat_ws(',', CASE WHEN r1 IS NULL THEN 'lang' END, CASE WHEN r2 IS NULL THEN 'title' END) AS applied, concat_ws(',', r1, r2) AS reasons FROM r""")
def field_decisions(spark, sf_dir):
    entries = read(spark, sf_dir, "documents").select("doc_id", F.create_map(F.lit("lang"), "lang").alias("fields"))
    title = F.regexp_extract(F.coalesce("html", F.lit("")), r"(?s)<title>(.*?)</title>", 1)
    records = read(spark, sf_dir, "pages").select(F.col("page_id").alias("doc_id"), F.lit("pages").alias("adapter"), F.col("url").alias("source_url"), F.create_map(F.lit("lang"), F.regexp_extract("url", "/(en|de|fr|es)/", 1), F.lit("title"), title).alias("fields"))
    out = decide.decisions(entries, ["doc_id"], records, ["lang", "title"], ["example.com"], ["lang"])
    return out.select("doc_id", "status", F.array_join("applied", ",").alias("applied"), F.array_join("reasons", ",").alias("reasons"))


@query("""SELECT l_partkey, arg_min(l_returnflag, (l_orderkey, l_linenumber)) AS l_returnflag, arg_min(l_linestatus, (l_orderkey, l_linenumber)) AS l_linestatus, count(DISTINCT l_returnflag) > 1 AS conflict FROM lineitem GROUP BY 1""")
def merge_conflicts(spark, sf_dir):
    return decide.merged(read(spark, sf_dir, "lineitem"), "l_partkey", F.struct("l_orderkey", "l_linenumber"), ["l_returnflag", "l_linestatus"], ["l_returnflag"])


@query("""SELECT md5(lower(coalesce(text, ''))) AS digest, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY md5(lower(coalesce(text, ''))) ORDER BY n_chars DESC, doc_id) = 1""")
def richest_row_dedup(spark, sf_dir):
    """Of documents of one whole text the longest; an aggregate on structs, which combines before the shuffle."""
    rows = read(spark, sf_dir, "documents").select(F.md5(F.encode(F.lower(F.coalesce("text", F.lit(""))), "UTF-8")).alias("digest"), "doc_id", "n_chars")
    best = F.max_by(F.struct("doc_id", "n_chars"), F.struct(F.coalesce("n_chars", F.lit(-1)), -F.col("doc_id")))
    return rows.groupBy("digest").agg(best.alias("b")).select("digest", "b.*")


@query("SELECT o_orderkey, year(o_orderdate) AS y FROM orders ORDER BY y DESC, o_orderkey")
def sort_by_year_desc(spark, sf_dir):
    rows = read(spark, sf_dir, "orders").select("o_orderkey", T.sort_year(F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), F.month("o_orderdate").cast("string"))).alias("y"))
    return rows.orderBy(F.desc("y"), "o_orderkey")


@query("""WITH r AS (SELECT o_custkey, o_orderdate, lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS b FROM orders) SELECT o_custkey, count(*) AS n, count(*) FILTER (b < o_orderdate) AS inversions FROM r GROUP BY 1""")
def sortedness_check(spark, sf_dir):
    return tracking.sortedness(read(spark, sf_dir, "orders"), "o_custkey", "o_orderkey", "o_orderdate")


@query("SELECT p_partkey, ((row_number() OVER (ORDER BY p_partkey) - 1) // 20)::BIGINT AS batch FROM part")
def batches(spark, sf_dir):
    return tracking.batches(read(spark, sf_dir, "part").select("p_partkey"), ["p_partkey"], 20).select("p_partkey", F.col("batch").cast("long").alias("batch"))


#: By hand, apart from the list that the operators use.
STOP_SQL = "('a', 'about', 'against', 'an', 'and', 'as', 'at', 'between', 'by', 'during', 'for', 'from', 'in', 'into', 'of', 'on', 'or', 'over', 'the', 'to', 'under', 'via', 'with', 'without')"
KEYED_SQL = f"""w AS (SELECT doc_id, lang, list_filter(string_split({norm_sql("text")}, ' '), lambda x: x <> '') AS ws FROM documents),
    c AS (SELECT doc_id, coalesce(lang, 'paper') || (1990 + doc_id % 30) AS head, list_filter(ws, lambda x: length(x) > 2 AND x NOT IN {STOP_SQL}) AS good, ws FROM w),
    base AS (SELECT doc_id, head || coalesce(good[1], ws[1], 'paper') AS base FROM c)"""


def _bases(spark, sf_dir) -> DataFrame:
    rows = T.with_normal(read(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "text", "t")
    found = lambda pattern: F.nullif(F.regexp_extract("t", pattern, 1), F.lit(""))
    good = found(f"(?:^| )(?!(?:{'|'.join(T.STOPWORDS)})(?: |$))([a-z0-9]{{3,}})")
    word = F.coalesce(good, found("([a-z0-9]+)"), F.lit("paper"))
    return rows.select("doc_id", F.concat(F.coalesce("lang", F.lit("paper")), (1990 + F.col("doc_id") % 30).cast("string"), word).alias("base"))


@query(f"WITH {KEYED_SQL} SELECT doc_id, base AS key FROM base")
def synthesize_key(spark, sf_dir):
    return _bases(spark, sf_dir).withColumnRenamed("base", "key")


@query(f"WITH {KEYED_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY doc_id) - 1 AS k FROM base) SELECT doc_id, base, CASE WHEN k = 0 THEN base ELSE base || k END AS key FROM n")
def key_suffix_disambiguation(spark, sf_dir):
    return keys.suffixed(_bases(spark, sf_dir), "base", ["doc_id"])


@query("""WITH l AS (SELECT o_custkey, list_transform(list_sort(list(o_orderkey)), lambda k: CASE WHEN k % 5 = 0 THEN 'new' || k ELSE k::VARCHAR END) AS ks FROM orders GROUP BY 1) SELECT o_custkey, array_to_string(ks, ', ') AS related FROM l""")
def rename_propagation(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    rows = orders.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda k: k.cast("string")), "; ").alias("related"))
    renames = orders.where("o_orderkey % 5 = 0").select(F.col("o_orderkey").cast("string").alias("old"), F.concat(F.lit("new"), "o_orderkey").alias("new"))
    return keys.with_renamed_references(rows, "o_custkey", "related", renames)


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, year(o_orderdate) AS a, year(l_shipdate) AS b, o_orderpriority, CASE WHEN l_linestatus = 'O' THEN '1-URGENT' ELSE '' END AS w FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT l_orderkey, l_linenumber, CASE abs(a - b) WHEN 0 THEN 1.0 WHEN 1 THEN 0.95 WHEN 2 THEN 0.6 ELSE 0.1 END::DOUBLE AS year_score, CASE WHEN w = '' THEN 0.5 WHEN w = o_orderpriority THEN 1.0 ELSE 0.0 END::DOUBLE AS author_score FROM p""")
def year_author_score(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    want = F.when(F.col("l_linestatus") == "O", "1-URGENT").otherwise("")
    return rows.select("l_orderkey", "l_linenumber", S.year_score(F.year("o_orderdate"), F.year("l_shipdate")).alias("year_score"), S.author_score(want, F.array("o_orderpriority")).alias("author_score"))


WORDS_SQL = f"list_distinct(list_filter(string_split({norm_sql('text')}, ' '), lambda x: x <> ''))"


@query(f"""WITH c AS (SELECT conv_id, turn, {WORDS_SQL} AS ws FROM conversations)
    SELECT a.conv_id, a.turn, round(CASE WHEN len(a.ws) + len(b.ws) = 0 THEN 0 ELSE len(list_intersect(a.ws, b.ws))::DOUBLE / (len(a.ws) + len(b.ws) - len(list_intersect(a.ws, b.ws))) END, 6) AS jaccard
    FROM c a JOIN c b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def token_jaccard(spark, sf_dir):
    """Shared words of each turn and the next: the pairs come from a unique key, so a block never squares."""
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", T.words(T.normal("text")).alias("ws"))
    after = rows.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("ws").alias("next"))
    return rows.join(after, ["conv_id", "turn"]).select("conv_id", "turn", F.round(S.jaccard(F.col("ws"), F.col("next")), 6).alias("jaccard"))


@query(f"""WITH b AS (SELECT item_id, {WORDS_SQL} AS ws FROM benchmark), d AS (SELECT doc_id, {WORDS_SQL} AS ws FROM documents),
    p AS (SELECT item_id, doc_id, len(list_intersect(b.ws, d.ws)) AS shared, len(b.ws) AS bn, len(d.ws) AS dn FROM b, d),
    s AS (SELECT item_id, doc_id, shared, round(shared::DOUBLE / (bn + dn - shared), 6) AS jaccard FROM p WHERE shared > 0)
    SELECT item_id, doc_id, shared, jaccard FROM s QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY jaccard DESC, shared DESC, doc_id) = 1""")
def ranked_best_candidate(spark, sf_dir):
    items = read(spark, sf_dir, "benchmark").select("item_id", T.words(T.normal("text")).alias("iw"))
    docs = T.with_normal(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", "t").select("doc_id", T.words("t").alias("dw"))
    pairs = matching.token_overlap(items, docs, "item_id", "doc_id", "iw", "dw").withColumn("jaccard", F.round("jaccard", 6))
    return matching.ranked_best(pairs, ["item_id"], [F.desc("jaccard"), F.desc("shared"), F.asc("doc_id")]).select("item_id", "doc_id", "shared", "jaccard")


@query("SELECT doc_id, sha1(coalesce(lang, '') || '␟' || coalesce(source, '') || '␟' || coalesce(n_chars::VARCHAR, '') || '␟' || coalesce(text, '')) AS fingerprint FROM documents")
def fingerprint_sha1(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", S.fingerprint(F.col("lang"), F.col("source"), F.col("n_chars"), F.col("text")).alias("fingerprint"))


@query("SELECT tier, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM (SELECT n_chars, CASE WHEN n_chars IS NULL OR n_chars <= 0 THEN 'unknown' WHEN n_chars <= 500 THEN 'article' WHEN n_chars <= 1500 THEN 'medium' WHEN n_chars <= 5000 THEN 'long' ELSE 'huge' END AS tier FROM documents) GROUP BY 1")
def page_tier_buckets(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select(rules.page_tier(F.col("n_chars"), (500, 1500, 5000)).alias("tier"), "n_chars")
    return rows.groupBy("tier").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


#: Messages of failures, one after the other by event, and by hand which of them may pass by themselves and which count as an outage.
FAILURES = [
    ("", True, True), ("HTTP status 503", True, True), ("http 404", False, False), ("http 408", True, True), ("HTTP 425 too early", True, True), ("http 429", True, True), ("http 500", True, True), ("http 502", True, True),
    ("http 504", True, True), ("read timed out", True, True), ("Timeout waiting", True, True), ("temporarily gone", True, True), ("Connection refused", True, True), ("ChunkedEncodingError()", True, True),
    ("ContentDecodingError()", True, True), ("Name or service not known", True, True), ("Temporary failure in name resolution", True, True), ("connection reset by peer", True, True), ("connection aborted", True, True),
    ("Broken pipe", True, True), ("SSL handshake failure", True, True), ("unexpected content-type text/html", False, False), ("invalid pdf", False, False), ("no candidate urls", False, False), ("something else", False, True),
    ("http status 403", False, True), ("http 4290", True, True),
]
FAILURES_SQL = "[" + ", ".join(f"{{'m': '{m}', 't': {str(t).lower()}, 'a': {str(a).lower()}}}" for m, t, a in FAILURES) + "]"


@query(f"WITH e AS (SELECT event_id, event_type, {FAILURES_SQL}[event_id % {len(FAILURES)} + 1] AS f FROM events) SELECT event_id, f.m AS message, f.t AS transient, f.a AND event_type = 'error' AS outage FROM e")
def failure_classifier(spark, sf_dir):
    messages = F.array(*[F.lit(m) for m, *_ in FAILURES])
    state = F.when(F.col("event_type") == "error", "failed").otherwise("done")
    rows = read(spark, sf_dir, "events").select("event_id", state.alias("state"), F.get(messages, (F.col("event_id") % len(FAILURES)).cast("int")).alias("message"))
    return rows.select("event_id", "message", rules.transient(F.col("message")).alias("transient"), rules.counts_toward_abort(F.col("state"), F.col("message")).alias("outage"))


@query(f"""WITH {LOG_SQL}, r AS (SELECT *, sum(CASE WHEN status <> 'failed' THEN 1 ELSE 0 END) OVER (PARTITION BY entry_key ORDER BY ts, event_id) AS run FROM log)
    SELECT entry_key, run::BIGINT AS run, count(*) AS length, min(ts) AS first, max(ts) AS last FROM r WHERE status = 'failed' GROUP BY entry_key, run""")
def consecutive_failure_runs(spark, sf_dir):
    return tracking.runs(log(spark, sf_dir), "entry_key", ["ts", "event_id"], F.col("status") != "failed")


@query("""WITH r AS (SELECT event_id, event_type, user_id, ts, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY event_type, user_id ORDER BY ts, event_id))) / 1e6 AS wait FROM events) SELECT event_id, event_type, user_id, wait FROM r WHERE wait < 600""")
def host_pacing_violations(spark, sf_dir):
    rows = read(spark, sf_dir, "events").withColumn("kind", F.struct("event_type", "user_id"))
    return tracking.pacing(rows, "kind", ["ts", "event_id"], F.lit(600)).select("event_id", "event_type", "user_id", "wait")


CLEAN_SQL = spaces_sql(r"regexp_replace(regexp_replace(text, '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '\\[nt]', ' ', 'g')")


@query(f"SELECT doc_id, sha1({CLEAN_SQL}) AS clean FROM documents")
def control_char_clean(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.sha1(F.encode(T.without_controls("text"), "UTF-8")).alias("clean"))


@query(f"SELECT doc_id, CASE WHEN {spaces_sql('text')} = '' THEN 0 ELSE len(string_split({spaces_sql('text')}, ' ')) END AS words FROM documents WHERE words < 25")
def short_abstract_rejection(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.word_count("text").alias("words")).where("words < 25")


@query()
def fuzzy_block_unique(spark, sf_dir):
    """Each document with the one other document of its language and source whose whole normal text fits: a single copy, else the best ratio.

    Copies are one text: they are matched by counting, and only texts without a copy are compared with the others of their block. Of a
    text with copies two ids are enough to make it ambiguous.
    """
    docs = T.with_normal(read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), "text", "title")
    docs = docs.select("doc_id", F.struct("lang", "source").alias("block"), "title").where("title <> ''")
    texts = docs.groupBy("block", "title").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    ids = F.array_distinct(F.array("first", "last"))
    copies = texts.where("n = 2").select("first", "last", F.explode(ids).alias("doc_id"))
    copies = copies.select("doc_id", F.when(F.col("doc_id") == F.col("first"), F.col("last")).otherwise(F.col("first")).alias("match_id"), F.lit(1.0).alias("score"))
    texts = texts.select("block", "title", "first", ids.alias("ids"), (F.col("n") == 1).alias("asks"))
    least, gap, second = 0.90, 0.12, 0.80
    # Only a text with one match of `least` can fit, and of those alone the others above `second` count. Two ids less than `gap` from 1 rule a text out.
    alike = matching.alike_texts(texts, "block", "title", "first", "ids", "asks", least, enough=least)
    top = workspace.staged(alike.groupBy("name").agg(F.sum(F.size("ids")).alias("n")).where("n = 1").select(F.col("name").alias("first"), F.lit(True).alias("one")), "top")
    for table in alike._reads:
        workspace.drop(table)
    texts = texts.drop("asks").join(top, "first", "left").withColumn("asks", F.coalesce("one", F.lit(False)))
    alike = matching.alike_texts(texts, "block", "title", "first", "ids", "asks", second, enough=1 - gap, levels=3)
    scored = alike.select(F.col("name").alias("doc_id"), F.explode("ids").alias("match_id"), "score")
    return matching.best_scored(scored, ["doc_id"], "match_id", least, gap, second).select("doc_id", "match_id", "score").unionByName(copies)
