"""The queries of this subpackage: each applies one operator, with production parameters, to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marginalia.llm import exponion, grace_dedup, language_id, licence_index, line_dedup, minmax_dedup, packing, periodic_runs, site_style, substring_dedup, subword_sampling, threshold_search, toxicity
from marginalia.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.toxicity(docs, table(spark, sf_dir, "labels"), keep_text=False).select("doc_id", "held_out", "score", "predicted", "evidence")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language_id.language(docs).select("doc_id", "held_out", "lang_pred", "score")


def op2_threshold_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return threshold_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op3_site_style_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style.main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op7_subword_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = subword_sampling.sampled_segmentations(table(spark, sf_dir, "conversations"), ["conv_id", "turn"], k=3)
    ids = F.crc32(F.concat_ws(",", F.transform("ids", lambda i: i.cast("string"))).cast("binary"))
    return rows.select("conv_id", "turn", "sample", F.size("ids").cast("long").alias("n_pieces"), ids.alias("ids_crc32"), "log_prob", "perturbed", "inclusion", "round_trip")


def op4_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_dedup.near_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), percent=85, k=5)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_frequent_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grace_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.remove_repeats(docs, length=20).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op11_exponion_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exponion.cluster(table(spark, sf_dir, "embeddings"), dims=64, clusters=40, rounds=5, seed="2:", scale=256)


def op12_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licence_index.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", *[c.alias(name) for name, c in licence_index.report().items()])


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), planted=True)
    best = periodic_runs.longest()
    run = [best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"), F.expr("1000 * best.length div best.period").alias("exponent_milli")]
    return found.withColumn("best", best).select("doc_id", "n_runs", *run, "runs_sha256", "collapsed_sha256")


def queries() -> dict:
    return {f.__name__: f for f in (op1_toxicity, op2_threshold_top_k, op3_site_style_text, op4_minmax_near_dedup, op5_language_id, op6_line_dedup, op7_subword_sampling, op8_exact_dedup, op9_best_fit_packing, op10_substring_dedup, op11_exponion_clusters, op12_licence_scan, op13_periodic_runs)}


LINE_KEY = r"translate(trim(l, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def oracle_sql() -> dict[str, str]:
    return {
        "op11_exponion_clusters": exponion.oracle_sql(),
        "op12_licence_scan": licence_index.oracle_sql(),
        "op6_line_dedup": f"""
            WITH d AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
            lines AS (SELECT r, doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS l, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM d),
            keyed AS (SELECT r, doc_id, {{'d': doc_id, 't': sha256(text)}} AS document, l, pos, {LINE_KEY} AS k FROM lines),
            bad AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT document) >= 10)
            SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (k IN (SELECT k FROM bad)) AS n_dropped,
                   sha256(coalesce(string_agg(l, chr(10) ORDER BY pos) FILTER (k NOT IN (SELECT k FROM bad)), '')) AS kept_sha256
            FROM keyed GROUP BY r""",
        "op8_exact_dedup": """
            WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents),
            g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
        "op2_threshold_top_k": """
            WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS v FROM embeddings
                       WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
            s AS (SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v::DOUBLE[], d.v::DOUBLE[])::BIGINT AS score FROM x q JOIN x d ON q.vec_id <> d.vec_id WHERE q.vec_id % 100 = 0)
            SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
            FROM s QUALIFY rank <= 10""",
        "op4_minmax_near_dedup": """
            WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
            sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i : i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
            n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
            p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM sh a JOIN sh b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
            e AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * i >= 85 * (a.n + b.n - i)),
            both_ways AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
            reach AS (SELECT doc_id AS s, doc_id AS t FROM n UNION SELECT s, y FROM reach JOIN both_ways ON t = x),
            c AS (SELECT s AS doc_id, min(t) AS component_id FROM reach GROUP BY s)
            SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id, coalesce(c.component_id, d.doc_id) = d.doc_id AS kept
            FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)""",
        "op10_substring_dedup": """
            WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
            win AS (SELECT doc_id, i, array_to_string(ws[i : i + 19], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM w)),
            rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
            gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM rep),
            words AS (SELECT doc_id, unnest(ws) AS t, generate_subscripts(ws, 1) AS p FROM w),
            kept AS (SELECT doc_id, string_agg(t, ' ' ORDER BY p) AS k, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
            SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)""",
    }
