"""More operators bound to the supplied tables, each with SQL that gives the same rows: citation files, normal forms, identifiers, rules, tables of state.

Citation texts are made from the rows of `part`, so the SQL knows what a parser must find without parsing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions import similarity as S
from marginalia.functions import text as T
from marginalia.operators import duplicates, matching, paths, reconcile, rules, tracking
from marginalia.plans.catalogue import LOG_SQL, log, norm_sql, query, read, spaces_sql
from marginalia.sources import bibfile, records

# --- citation files ------------------------------------------------------------------------------------------------------

HEADER = '% made for tests\n@comment{bibmeta: role = "curated"}\n@string{pub = "Wide " # {Press}}\n@preamble{"\\newcommand{\\x}{y}"}\n'
CITED_SQL = """c AS (SELECT p_partkey AS id, 'f' || (p_partkey // 50) || '.bib' AS file_path, CASE p_partkey % 3 WHEN 0 THEN 'article' WHEN 1 THEN 'inproceedings' ELSE 'book' END AS entry_type,
    lower(regexp_replace(p_type, '[^A-Za-z]', '', 'g')) || (1990 + p_size) || 'k' || p_partkey AS entry_key, 'On ' || p_name || ' {' || p_brand || '}' AS title, 'Müller, ' || p_type || ' and Doe ' || p_size AS author, (1990 + p_size)::VARCHAR AS year FROM part)"""


def cited(spark, sf_dir) -> DataFrame:
    """(id, file_path, entry_type, entry_key, title, author, year, bib): `part` as citations, and each as a parser may meet it."""
    kind = F.when(F.col("p_partkey") % 3 == 0, "article").when(F.col("p_partkey") % 3 == 1, "inproceedings").otherwise("book")
    year = (1990 + F.col("p_size")).cast("string")
    key = F.concat(F.lower(F.regexp_replace("p_type", "[^A-Za-z]", "")), year, F.lit("k"), F.col("p_partkey").cast("string"))
    rows = read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.concat(F.lit("f"), F.floor(F.col("p_partkey") / 50).cast("string"), F.lit(".bib")).alias("file_path"), kind.alias("entry_type"), key.alias("entry_key"),
        F.concat(F.lit("On "), "p_name", F.lit(" {"), "p_brand", F.lit("}")).alias("title"), F.concat(F.lit('M{\\"u}ller, '), "p_type", F.lit(" and Doe "), F.col("p_size").cast("string")).alias("author"), year.alias("year"),
    )
    bib = F.concat(F.lit("@"), F.upper("entry_type"), F.lit("{ "), "entry_key", F.lit(', TITLE = "'), "title", F.lit('",\n  author={'), "author", F.lit("},\n  publisher = pub # { Inc},\n  year = "), "year", F.lit(",\n}"))
    return rows.withColumn("bib", bib)


def citation_files(spark, sf_dir) -> DataFrame:
    files = bibfile.files_of(cited(spark, sf_dir), "id")
    return files.withColumn("value", F.concat(F.lit(HEADER), "value"))


@query(f"WITH {CITED_SQL} SELECT file_path, (row_number() OVER (PARTITION BY file_path ORDER BY id) - 1)::INT AS entry_idx, entry_type, entry_key, title, author, year, 'Wide Press Inc' AS publisher FROM c")
def parse_citations(spark, sf_dir):
    f = F.col("fields")
    rows = bibfile.entries(bibfile.blocks(citation_files(spark, sf_dir)))
    return rows.select("file_path", "entry_idx", "entry_type", "entry_key", *[f[n].alias(n) for n in ("title", "author", "year", "publisher")])


@query(f"""WITH {CITED_SQL}, n AS (SELECT file_path, count(*) AS n FROM c GROUP BY 1) SELECT file_path, 'entry' AS block_type, n FROM n
    UNION ALL SELECT file_path, unnest(['comment', 'string', 'preamble', 'error']), unnest([1, 1, 1, 1]) FROM n""")
def citation_blocks(spark, sf_dir):
    """Kinds of blocks a file, with one entry that never closes at its end."""
    files = citation_files(spark, sf_dir).withColumn("value", F.concat("value", F.lit("\n@article{open, title = {never closed")))
    return bibfile.blocks(files).groupBy("file_path", "block_type").agg(F.count("*").alias("n"))


RENDERED_SQL = "'@' || entry_type || '{' || entry_key || ',' || chr(10) || '  author = {' || author || '},' || chr(10) || '  title = {' || title || '},' || chr(10) || '  publisher = {Wide Press Inc},' || chr(10) || '  year = {' || year || '},' || chr(10) || '}'"


@query(f"WITH {CITED_SQL} SELECT file_path, entry_key, sha256({RENDERED_SQL}) AS digest FROM c")
def render_citations(spark, sf_dir):
    rows = bibfile.rendered(bibfile.entries(bibfile.blocks(citation_files(spark, sf_dir))))
    return rows.select("file_path", "entry_key", F.sha2("bib", 256).alias("digest"))


@query(f"WITH {CITED_SQL} SELECT file_path, count(*) AS entries, 0 AS changed FROM c GROUP BY 1")
def citation_round_trip(spark, sf_dir):
    """Entries parsed, rendered and parsed again: none is lost and no field changes."""
    before = bibfile.entries(bibfile.blocks(citation_files(spark, sf_dir)))
    after = bibfile.entries(bibfile.blocks(bibfile.files_of(bibfile.rendered(before))))
    same = lambda df: df.select("file_path", "entry_idx", F.to_json(F.struct("entry_type", "entry_key", F.array_sort(F.map_entries("fields")).alias("f"))).alias("x"))
    both = same(before).join(same(after).withColumnRenamed("x", "y"), ["file_path", "entry_idx"], "full_outer")
    return both.groupBy("file_path").agg(F.count("y").alias("entries"), F.count_if(~F.col("x").eqNullSafe(F.col("y"))).cast("int").alias("changed"))


@query(f"WITH {CITED_SQL} SELECT file_path, entry_key, (5 + 6 * (row_number() OVER (PARTITION BY file_path ORDER BY id) - 1))::INT AS line FROM c")
def citation_key_lines(spark, sf_dir):
    """Header lines found by pattern; an entry takes five lines and a blank one follows."""
    return bibfile.light_scan(citation_files(spark, sf_dir)).select("file_path", "entry_key", F.col("line").cast("int").alias("line"))


TEXTS_SQL = "t AS (SELECT file_path, string_agg('@' || upper(entry_type) || '{ ' || entry_key || ', TITLE = \"' || title || '\",' || chr(10) || '  author={' || replace(author, 'ü', '{\\\"u}') || '},' || chr(10) || '  publisher = pub # { Inc},' || chr(10) || '  year = ' || year || ',' || chr(10) || '}', chr(10) || chr(10) ORDER BY id) AS value, count(*) AS n FROM c GROUP BY 1)"


@query(f"WITH {CITED_SQL}, {TEXTS_SQL} SELECT file_path, n AS entry_count, true AS parse_ok, starts_with(file_path, 'f1') AS generated, sha256('% ' || CASE WHEN starts_with(file_path, 'f1') THEN 'Generated from DBLP XML dump' ELSE 'x' END || chr(10) || '@string{{pub = \"Wide \" # {{Press}}}}' || chr(10) || value) AS sha256 FROM t")
def citation_file_table(spark, sf_dir):
    files = bibfile.files_of(cited(spark, sf_dir), "id")
    head = F.when(F.startswith("file_path", F.lit("f1")), "Generated from DBLP XML dump").otherwise("x")
    files = files.withColumn("value", F.concat(F.lit("% "), head, F.lit('\n@string{pub = "Wide " # {Press}}\n'), "value")).withColumns({"size": F.octet_length("value"), "mtime": F.lit(None).cast("timestamp")})
    return bibfile.file_table(files, bibfile.blocks(files)).select("file_path", "entry_count", "parse_ok", "generated", "sha256")


@query(f"WITH {CITED_SQL}, b AS (SELECT file_path, 'k' || (id % 7) AS entry_key, id, title FROM c) SELECT file_path, entry_key, arg_max(title, id) AS title FROM b GROUP BY ALL")
def last_of_repeated_keys(spark, sf_dir):
    rows = cited(spark, sf_dir).select("file_path", F.concat(F.lit("k"), (F.col("id") % 7).cast("string")).alias("entry_key"), F.col("id").alias("entry_idx"), "title")
    return duplicates.last_duplicate(rows).select("file_path", "entry_key", "title")


@query(f"WITH {CITED_SQL} SELECT title AS volume, CASE WHEN count(DISTINCT entry_type) = 1 THEN min(entry_type) END AS entry_type FROM c GROUP BY 1")
def unambiguous_index(spark, sf_dir):
    return duplicates.unambiguous(cited(spark, sf_dir).select(F.col("title").alias("volume"), "entry_type"), "volume", "entry_type")


@query(f"""WITH {CITED_SQL}, s AS (SELECT 'k' || (id % 11) AS entry_key, year || '|' || {norm_sql("title")} || '|' || 'muller ' || regexp_extract(author, '([0-9]+)$', 1) AS sig FROM c)
    SELECT entry_key, count(DISTINCT sig) AS signatures, md5(string_agg(DISTINCT sig, ';' ORDER BY sig)) AS digest FROM s GROUP BY 1""")
def key_signatures(spark, sf_dir):
    fields = F.create_map(F.lit("year"), "year", F.lit("title"), "title", F.lit("author"), F.replace("author", F.lit('{\\"u}'), F.lit("ü")))
    rows = cited(spark, sf_dir).select(F.concat(F.lit("k"), (F.col("id") % 11).cast("string")).alias("entry_key"), fields.alias("fields"))
    out = duplicates.signatures(rows)
    return out.select("entry_key", F.size("signatures").cast("long").alias("signatures"), F.md5(F.array_join(F.array_sort("signatures"), ";")).alias("digest"))


LINT_SQL = """e AS (SELECT p_partkey AS id, 'f' || (p_partkey % 5) AS file_path, CASE WHEN p_partkey % 4 = 0 THEN 'Article' ELSE 'inproceedings' END AS kind,
    CASE WHEN p_partkey % 2 = 0 THEN 'Key_' || p_partkey ELSE 'smith' || (1990 + p_size) || 'word' END AS k, p_name AS title, CASE WHEN p_partkey % 3 = 0 THEN 'A. Smith and others' ELSE 'A. Smith' END AS author,
    CASE WHEN p_partkey % 7 = 0 THEN '99' ELSE (1990 + p_size)::VARCHAR END AS y, CASE WHEN p_partkey % 5 = 0 THEN 'ftp://x.org/a' ELSE 'https://x.org/a' END AS url,
    CASE p_partkey % 4 WHEN 0 THEN 'https://x.org/pdf/1' WHEN 1 THEN 'https://x.org/a.pdf' WHEN 2 THEN 'https://x.org/pdf?id=3' ELSE '' END AS pdf FROM part)"""


def lint_entries(spark, sf_dir) -> DataFrame:
    p, size = F.col("p_partkey"), (1990 + F.col("p_size")).cast("string")
    fields = {
        "title": F.col("p_name"), "author": F.when(p % 3 == 0, "A. Smith and others").otherwise("A. Smith"), "year": F.when(p % 7 == 0, "99").otherwise(size),
        "url": F.when(p % 5 == 0, "ftp://x.org/a").otherwise("https://x.org/a"), "pdf": F.when(p % 4 == 0, "https://x.org/pdf/1").when(p % 4 == 1, "https://x.org/a.pdf").when(p % 4 == 2, "https://x.org/pdf?id=3").otherwise(""),
    }
    key = F.when(p % 2 == 0, F.concat(F.lit("Key_"), p.cast("string"))).otherwise(F.concat(F.lit("smith"), size, F.lit("word")))
    made = F.create_map(*[x for k, v in fields.items() for x in (F.lit(k), v)])
    return read(spark, sf_dir, "part").select(F.concat(F.lit("f"), (p % 5).cast("string")).alias("file_path"), p.alias("entry_idx"), F.when(p % 4 == 0, "Article").otherwise("inproceedings").alias("entry_type"), key.alias("entry_key"), made.alias("fields"))


@query(f"""WITH {LINT_SQL} SELECT file_path, id AS entry_idx, unnest(list_filter(['missing_required_fields', CASE WHEN y = '99' THEN 'invalid_year' END,
    CASE WHEN contains(author, 'others') THEN 'placeholder_authors' END, CASE WHEN starts_with(url, 'ftp') THEN 'invalid_url_scheme' END, CASE WHEN pdf = 'https://x.org/pdf/1' THEN 'pdf_field_suspicious' END], lambda x: x IS NOT NULL)) AS issue_type FROM e""")
def lint_entry_rules(spark, sf_dir):
    """The linter's findings on entries that lack a journal or a book title, by kind; those on keys are in lint_key_rules."""
    return rules.lint(lint_entries(spark, sf_dir)).where("issue_type <> 'key_format'").select("file_path", "entry_idx", "issue_type")


@query(f"""WITH {LINT_SQL} SELECT id AS entry_idx, unnest(list_filter([CASE WHEN k <> lower(k) THEN 'upper case in an entry key' END, CASE WHEN regexp_matches(k, '[-_.]') THEN 'dash, underscore or dot in an entry key' END,
    CASE WHEN NOT regexp_matches(k, '^[a-z][a-z0-9]*[0-9]{{4}}[a-z0-9]+$') THEN 'entry key is not author, year and keyword in a row' END, CASE WHEN length(y) = 4 AND NOT contains(k, y) THEN 'entry key without the year of its entry' END], lambda x: x IS NOT NULL)) AS message FROM e""")
def lint_key_rules(spark, sf_dir):
    return rules.lint(lint_entries(spark, sf_dir)).where("issue_type = 'key_format'").select("entry_idx", "message")


# --- normal forms --------------------------------------------------------------------------------------------------------


@query(f"SELECT doc_id, md5({norm_sql('text')}) AS normal, md5(replace({norm_sql('text')}, ' ', '')) AS compact, md5({spaces_sql('text')}) AS spaced FROM documents")
def normal_forms(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.md5(T.normal("text")).alias("normal"), F.md5(T.compact("text")).alias("compact"), F.md5(F.encode(T.spaces("text"), "UTF-8")).alias("spaced"))


@query(f"SELECT conv_id, turn, coalesce({norm_sql('text')} = {norm_sql('b')}, false) AS same, coalesce({norm_sql('text')} <> '' AND {norm_sql('b')} <> '' AND (starts_with({norm_sql('text')}, {norm_sql('b')}) OR starts_with({norm_sql('b')}, {norm_sql('text')})), false) AS prefix FROM (SELECT *, CASE turn % 3 WHEN 0 THEN '{{' || text || '}}!' WHEN 1 THEN text || ' more' ELSE 'other' END AS b FROM conversations)")
def equivalent_texts(spark, sf_dir):
    other = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("{"), "text", F.lit("}!"))).when(F.col("turn") % 3 == 1, F.concat("text", F.lit(" more"))).otherwise("other")
    rows = read(spark, sf_dir, "conversations").withColumn("b", other)
    no = F.lit(False)
    return rows.select("conv_id", "turn", F.coalesce(T.equivalent("text", "b"), no).alias("same"), F.coalesce(T.prefix_equivalent("text", "b"), no).alias("prefix"))


@query("SELECT p_partkey, 'A ' || p_name || ' of ' || p_brand || ' and ' || p_type || ' x' AS title FROM part")
def latex_arguments(spark, sf_dir):
    x = F.concat(F.lit(r"{A}  \emph{"), "p_name", F.lit(r"} \textbf{of \textit{"), "p_brand", F.lit(r"}} and\\ {"), "p_type", F.lit(r"}\footnotesize x"))
    return read(spark, sf_dir, "part").select("p_partkey", T.strip_latex(x).alias("title"))


@query("SELECT p_partkey, 'cafe ' || regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g') || ' ' || p_size AS title FROM part")
def entities_and_decomposition(spark, sf_dir):
    x = F.concat(F.lit(r"Caf&eacute; \emph{\textbf{"), "p_brand", F.lit("}} &#38; "), F.col("p_size").cast("string"))
    return read(spark, sf_dir, "part").select("p_partkey", T.unescape_fold(x).alias("title"))


@query("""SELECT c_custkey, 'customer doe' AS signature, 'customer' AS first_surname, 'customer' AS token, CASE WHEN c_custkey % 3 = 0 THEN true ELSE false END AS placeholder FROM customer""")
def author_names(spark, sf_dir):
    c = F.col("c_custkey")
    names = F.concat(F.lit("Customer, A. "), c.cast("string"), F.lit(" and Jane van Doe"))
    who = F.when(c % 3 == 0, F.concat(F.lit("C"), c.cast("string"), F.lit(" and others"))).otherwise(F.col("c_name"))
    return read(spark, sf_dir, "customer").select("c_custkey", T.author_signature(names).alias("signature"), T.first_surname(names).alias("first_surname"), T.author_token(names).alias("token"), T.placeholder_author(who).alias("placeholder"))


@query("""SELECT p_partkey, 'smith' || (1990 + p_size) || split_part(p_name, ' ', 1) AS key, (1990 + p_size)::INT AS key_year, regexp_matches('smith' || (1990 + p_size) || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE 'x' END, '^[a-z][a-z0-9]*[0-9]{4}[a-z0-9]+$') AS canonical FROM part""")
def synthesised_keys(spark, sf_dir):
    """A key of author, year and the first word of the name that is no stopword (none of these names has one); the year is read from it again."""
    y = (1990 + F.col("p_size")).cast("string")
    key = T.synthesised_key(F.lit("Smith, A. and Doe, B."), F.concat(y, F.lit("-05-01")), F.col("p_name"))
    short = F.concat(F.lit("smith"), y, F.when(F.col("p_partkey") % 2 == 0, "").otherwise("x"))
    return read(spark, sf_dir, "part").select("p_partkey", key.alias("key"), T.key_year(key, 2100).alias("key_year"), T.canonical_key(short).alias("canonical"))


@query("SELECT o_orderkey, year(o_orderdate)::INT AS y, lower(strftime(o_orderdate, '%b')) AS month, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS iso, o_orderkey % 4 = 0 AS is_date FROM orders")
def dates_of_texts(spark, sf_dir):
    day, at = F.date_format("o_orderdate", "yyyy-MM-dd"), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    text = F.when(F.col("o_orderkey") % 4 == 0, day).otherwise(F.concat(F.lit("on "), day))
    return read(spark, sf_dir, "orders").select("o_orderkey", T.year(F.concat(F.lit("printed "), day)).alias("y"), T.month_name(day).alias("month"), T.iso_timestamp(at).alias("iso"), T.iso_date(text).isNotNull().alias("is_date"))


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN event_id % 90 ELSE 3600 * (event_id % 5) END::BIGINT AS wait, least(2 * pow(2, event_id % 12), 300)::DOUBLE AS backoff, round(100.0 * (event_id % 7) / 7, 1)::DOUBLE AS pct FROM events""")
def retry_after_values(spark, sf_dir):
    e, now = F.col("event_id"), F.lit("2024-01-01 00:00:00").cast("timestamp")
    at = F.concat(F.lit("Mon, 01 Jan 2024 0"), (e % 5).cast("string"), F.lit(":00:00 GMT"))
    value = F.when(e % 2 == 0, (e % 90).cast("string")).otherwise(at)
    return read(spark, sf_dir, "events").select("event_id", T.retry_after(value, now).alias("wait"), T.backoff(e % 12).alias("backoff"), T.percent(e % 7, F.lit(7), 1).alias("pct"))


# --- urls, identifiers, paths --------------------------------------------------------------------------------------------


@query("""SELECT p_partkey, '10.1234/' || lower(p_type) || '.' || p_partkey AS doi, '2301.' || lpad((p_partkey % 100000)::VARCHAR, 5, '0') AS arxiv, 'Ab_' || p_partkey AS forum, 'W' || p_partkey AS openalex, 'Q' || p_partkey AS wikidata,
    'doi:10.1234/' || lower(p_type) || '.' || p_partkey || ',openalex:W' || p_partkey AS identifiers FROM part""")
def identifiers_of_texts(spark, sf_dir):
    p, kind = F.col("p_partkey").cast("string"), F.col("p_type")
    five = F.lpad((F.col("p_partkey") % 100000).cast("string"), 5, "0")
    doi = T.doi(F.concat(F.lit(" https://doi.org/10.1234/"), kind, F.lit("."), p))
    arxiv = T.arxiv_id(F.lit(""), F.concat(F.lit("arXiv:2301."), five, F.lit("v3")), F.lit("2301.99999"))
    work = T.openalex_id(F.concat(F.lit("https://openalex.org/w"), p))
    return read(spark, sf_dir, "part").select(
        "p_partkey", doi.alias("doi"), arxiv.alias("arxiv"), T.forum_id(F.concat(F.lit("https://openreview.net/forum?x=1&id=Ab_"), p), "openreview.net").alias("forum"), work.alias("openalex"),
        T.wikidata_id(F.concat(F.lit("https://www.wikidata.org/wiki/q"), p, F.lit("?x=1"))).alias("wikidata"), F.array_join(T.identifiers(("doi", doi), ("none", F.lit("")), ("openalex", work)), ",").alias("identifiers"),
    )


@query("SELECT p_partkey, '10.5555/' || lower(p_type) AS doi FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT p_partkey, '' FROM part WHERE p_partkey % 2 = 1")
def wikidata_doi_claims(spark, sf_dir):
    p = F.col("p_partkey").cast("string")
    claim = F.concat(F.lit('{"P356": [{"mainsnak": {"datavalue": {"value": "10.5555/'), "p_type", F.lit('"}}}]}'))
    payload = F.concat(F.lit('{"entities": {"Q'), p, F.lit('": {"claims": '), F.when(F.col("p_partkey") % 2 == 0, claim).otherwise("{}"), F.lit("}}}"))
    return read(spark, sf_dir, "part").select("p_partkey", T.wikidata_doi(payload, F.concat(F.lit("Q"), p)).alias("doi"))


@query("""SELECT page_id, regexp_replace(trim(url), '#.*$', '') AS canonical, count(*) OVER (PARTITION BY regexp_replace(trim(url), '#.*$', '')) AS n FROM pages""")
def canonical_urls(spark, sf_dir):
    """Scheme and host are in lower case again after they were made upper case, and a fragment is gone."""
    head = F.regexp_extract(F.trim("url"), r"^([^:]*://[^/?#]+)", 1)
    url = F.concat(F.upper(head), F.substr(F.regexp_replace(F.trim("url"), "#.*$", ""), F.length(head) + 1), F.lit("#part"))
    rows = read(spark, sf_dir, "pages").select("page_id", T.canonical_url(url).alias("canonical"))
    return rows.join(rows.groupBy("canonical").agg(F.count("*").alias("n")), "canonical")


@query("""SELECT p_partkey, 'docs/' || p_partkey || '.pdf' AS path, ':docs/' || p_partkey || '.pdf:pdf' AS field, p_partkey || '_' || regexp_replace(p_brand, '[^A-Za-z0-9._-]+', '_', 'g') AS name,
    CASE p_partkey % 3 WHEN 0 THEN 'article' WHEN 1 THEN 'phdthesis' ELSE 'misc' END || '/k' || p_partkey || '/k' || p_partkey || '.pdf' AS place, regexp_replace(lower(p_brand), '[^a-z0-9]+', '-', 'g') AS slug FROM part""")
def attachment_paths(spark, sf_dir):
    p = F.col("p_partkey").cast("string")
    kind = F.when(F.col("p_partkey") % 3 == 0, "Article").when(F.col("p_partkey") % 3 == 1, "PhdThesis").otherwise("poster")
    path = T.attachment_path(F.concat(F.lit(":docs/"), p, F.lit(".pdf:PDF;:other.pdf:PDF")))
    return read(spark, sf_dir, "part").select(
        "p_partkey", path.alias("path"), T.attachment_field(path).alias("field"), T.safe_filename(F.concat(F.lit("._"), p, F.lit(" / "), "p_brand")).alias("name"),
        T.document_path(kind, F.concat(F.lit("k"), p), True).alias("place"), T.slug("p_brand").alias("slug"),
    )


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'https://x.org/a.pdf' WHEN 1 THEN 'https://x.org/pdf?id=7' WHEN 2 THEN 'https://x.org/pdf/9' ELSE '' END
    || CASE WHEN p_partkey % 2 = 0 THEN ' https://doi.org/10.1/x' ELSE '' END AS urls FROM part""")
def derived_pdf_urls(spark, sf_dir):
    p = F.col("p_partkey") % 4
    url = F.when(p == 0, "https://x.org/a.pdf").when(p == 1, "https://x.org/forum?id=7").when(p == 2, "https://x.org/abs/9").otherwise("https://x.org/home")
    found = T.derived_urls(url, F.when(p % 2 == 0, "10.1/x").otherwise(""), F.lit(""))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(found, " ").alias("urls"))


@query("""SELECT p_partkey, lower(p_type) AS venue, CASE WHEN p_size % 2 = 0 THEN (1990 + p_size)::INT END AS year, p_size % 2 = 0 AS valid FROM part""")
def target_tokens(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select("p_partkey", F.concat("p_type", F.lit(":"), F.when(F.col("p_size") % 2 == 0, (1990 + F.col("p_size")).cast("string")).otherwise("soon")).alias("token"))
    made = paths.targets(rows.select("token").distinct(), "token")
    return rows.join(made, "token").select("p_partkey", "venue", "year", "valid")


@query("""SELECT o_orderkey, 'venue' || (o_orderkey % 9) AS venue, year(o_orderdate)::INT AS year FROM orders""")
def venue_of_paths(spark, sf_dir):
    path = F.concat(F.lit("conferences/venue"), (F.col("o_orderkey") % 9).cast("string"), F.lit("/"), F.year("o_orderdate").cast("string"), F.lit(".bib"))
    venue, year = paths.venue_and_year(path)
    return read(spark, sf_dir, "orders").select("o_orderkey", venue.alias("venue"), year.alias("year"))


@query("""WITH s AS (SELECT p_partkey, 'd' || p_partkey || '/' || (p_partkey % 10) || '.pdf' AS path, (p_partkey % 10)::VARCHAR AS stem, row_number() OVER (PARTITION BY p_partkey % 10 ORDER BY p_partkey) AS n FROM part)
    SELECT p_partkey, CASE WHEN n = 1 THEN stem || '.pdf' ELSE stem || '_' || (n - 1) || '.pdf' END AS target FROM s""")
def export_targets(spark, sf_dir):
    rows = read(spark, sf_dir, "part").select("p_partkey", F.concat(F.lit("d"), F.col("p_partkey").cast("string"), F.lit("/"), (F.col("p_partkey") % 10).cast("string"), F.lit(".pdf")).alias("path"))
    return paths.export_plan(rows, "path", [F.col("p_partkey")]).select("p_partkey", "target")


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'new/a.bib' WHEN 1 THEN 'by-venue/b.bib' ELSE 'plain.bib' END AS path, p_partkey % 4 = 1 AS unmapped FROM part""")
def migrated_paths(spark, sf_dir):
    p = F.col("p_partkey") % 4
    rows = read(spark, sf_dir, "part").select("p_partkey", F.when(p == 0, "by-venue/a.bib").when(p == 1, "by-venue/b.bib").otherwise("plain.bib").alias("path"))
    return paths.migrated(rows, "path", {"by-venue/a.bib": "new/a.bib"}).select("p_partkey", "path", "unmapped")


# --- rules on records ----------------------------------------------------------------------------------------------------


@query("""SELECT doc_id, CASE WHEN n = 0 AND k THEN 'warning:missing' WHEN n = 0 THEN 'failed:missing' WHEN n < 50 THEN 'warning:short' WHEN n > 1000 THEN 'warning:long' END AS abstract, CASE doc_id % 3 WHEN 0 THEN 'missing' WHEN 1 THEN 'invalid' END AS openalex
    FROM (SELECT doc_id, doc_id % 2 = 0 AS k, len(list_filter(string_split_regex(trim(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '\\s+'), lambda w: w <> '')) AS n FROM documents)""")
def abstract_and_id_checks(spark, sf_dir):
    d = F.col("doc_id")
    work = F.when(d % 3 == 0, " ").when(d % 3 == 1, "w12").otherwise(F.concat(F.lit("W"), d.cast("string")))
    kind = F.when(d % 2 == 0, "Book").otherwise("article")
    return read(spark, sf_dir, "documents").select("doc_id", rules.abstract_problem(F.col("text"), kind).alias("abstract"), rules.openalex_problem(work).alias("openalex"))


@query("""SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'rate_limited' WHEN 1 THEN 'http 404' WHEN 2 THEN 'rejected_marker' WHEN 3 THEN 'required_marker_missing' WHEN 4 THEN 'rate_limited' END AS problem,
    CASE WHEN event_id % 2 = 0 THEN 'failed' WHEN event_id % 3 = 0 THEN 'warning' ELSE 'passed' END AS state FROM events""")
def response_checks(spark, sf_dir):
    k = F.col("event_id") % 6
    code = F.when(k == 0, 429).when(k == 1, 404).otherwise(200)
    body = F.when(k == 2, "<feed> Access Denied").when(k == 3, "nothing").when(k == 4, "<feed> Too Many Requests").otherwise("<feed>")
    some = lambda c: F.when(c, F.array(F.lit("x"))).otherwise(F.array().cast("array<string>"))
    state = rules.status(some(F.col("event_id") % 2 == 0), some(F.col("event_id") % 3 == 0))
    return read(spark, sf_dir, "events").select("event_id", rules.response_problem(code, body, ["<feed"], ["access denied"]).alias("problem"), state.alias("state"))


@query("""SELECT event_id, event_id % 2 = 0 AND ((event_id % 5 < 2 AND event_id % 3 = 0) OR (event_id % 5 = 2 AND event_id % 7 = 0)) AS first_run, event_id % 2 = 0 AND ((event_id % 5 < 2 AND event_id % 3 = 0) OR event_id % 5 = 2) AS no_retry FROM events""")
def resumable_work(spark, sf_dir):
    e = F.col("event_id")
    state = F.when(e % 5 == 0, "downloaded").when(e % 5 == 1, "relinked").when(e % 5 == 2, "failed").otherwise("planned")
    args = (e % 2 == 0, state, e % 3 == 0, e % 7 == 0)
    return read(spark, sf_dir, "events").select("event_id", rules.resumable(*args, True).alias("first_run"), rules.resumable(*args, False).alias("no_retry"))


@query("""SELECT p_partkey, p_partkey % 3 <> 0 AS subset, p_partkey % 2 = 0 AS multiset FROM part""")
def containment_checks(spark, sf_dir):
    p = F.col("p_partkey")
    got = F.when(p % 3 == 0, F.array(F.lit("title"))).otherwise(F.array(F.lit("year"), F.lit("title")))
    stored = F.when(p % 2 == 0, F.array(F.lit("a"), F.lit("a"), F.lit("b"))).otherwise(F.array(F.lit("a"), F.lit("b")))
    return read(spark, sf_dir, "part").select("p_partkey", rules.required_subset(got, ["title", "year"]).alias("subset"), rules.multiset_contains(stored, F.array(F.lit("a"), F.lit("a"))).alias("multiset"))


@query("""SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_partkey % 2 = 0 THEN 'tex_source_gate' END, CASE WHEN p_partkey % 3 = 0 THEN 'anchored_bullets' END, CASE WHEN p_partkey % 3 = 0 THEN 'anchors' END, CASE WHEN p_partkey % 5 = 0 THEN 'readthrough_log' END,
    CASE WHEN p_partkey % 7 = 0 THEN 'chunk_summary' END], lambda x: x IS NOT NULL), ',') AS lacks FROM part""")
def note_bundle_audit(spark, sf_dir):
    p = F.col("p_partkey")
    notes = F.concat(F.lit('{"tex_source_gate": '), F.when(p % 2 == 0, "false").otherwise("true"), F.lit(', "readthrough_complete": true, "coordinates": {"a": [], "b": [], "c": []}}'))
    ledger = F.when(p % 3 == 0, F.repeat(F.lit("- Anchor: x\n"), 4)).otherwise(F.repeat(F.lit("- Anchor: x\n"), 12))
    log_ = F.concat(F.lit('{"completed": true, "chunks_total": 2, "chunks_completed": '), F.when(p % 5 == 0, "1").otherwise("2"), F.lit(', "chunks": [{"id": "1", "summary": "found"}, {"id": "2", "summary": "'), F.when(p % 7 == 0, " ").otherwise("also"), F.lit('"}]}'))
    return read(spark, sf_dir, "part").select("p_partkey", F.array_join(rules.note_audit(notes, ledger, log_), ",").alias("lacks"))


@query("""SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'too small' WHEN 1 THEN 'no header' WHEN 2 THEN 'no end mark' END AS problem, md5(repeat('x', 10) || p_name) AS digest FROM part""")
def pdf_bytes_checks(spark, sf_dir):
    k, fill = F.col("p_partkey") % 4, F.repeat(F.lit("a"), 1200)
    content = F.when(k == 0, "%PDF-1.4 %%EOF").when(k == 1, F.concat(F.lit("GIF89"), fill, F.lit("%%EOF"))).when(k == 2, F.concat(F.lit("%PDF-1.4"), fill)).otherwise(F.concat(F.lit("%PDF-1.4"), fill, F.lit("%%EOF\n"))).cast("binary")
    small = F.concat(F.repeat(F.lit("x"), 10), "p_name").cast("binary")
    return read(spark, sf_dir, "part").select("p_partkey", rules.pdf_problem(content, F.octet_length(content)).alias("problem"), paths.quick_md5(small, F.octet_length(small)).alias("digest"))


@query("""SELECT p_partkey, p_partkey % 4 AS k, round(least(1.0, 0.72 * (p_partkey % 10) / 10 + 0.18 + 0.05 + CASE WHEN p_partkey % 2 = 0 THEN 0.05 ELSE 0 END), 6)::DOUBLE AS confidence, (p_partkey % 10) / 10 >= 0.8 AS accepted FROM part""")
def match_confidence(spark, sf_dir):
    title, p = (F.col("p_partkey") % 10) / 10, F.col("p_partkey")
    score = S.confidence(title, F.lit(1.0), F.lit(0.5), F.when(p % 2 == 0, 0.05).otherwise(0.0))
    return read(spark, sf_dir, "part").select("p_partkey", (p % 4).alias("k"), F.round(score, 6).alias("confidence"), S.accepted(title, score, 0.8, 0.5).alias("accepted"))


@query("""SELECT page_id, CASE WHEN host LIKE '%.a.example.org' OR host = 'a.example.org' THEN 3.0 WHEN host LIKE '%.example.org' OR host = 'example.org' THEN 1.5 ELSE 0.2 END::DOUBLE AS interval FROM
    (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'b.a.example.org' WHEN 1 THEN 'example.org' WHEN 2 THEN 'nota.example.org' ELSE 'else.net' END AS host FROM pages)""")
def host_intervals(spark, sf_dir):
    k = F.col("page_id") % 4
    name = F.when(k == 0, "b.a.example.org").when(k == 1, "example.org").when(k == 2, "nota.example.org").otherwise("else.net")
    return matching.longest_suffix(read(spark, sf_dir, "pages"), name, {"example.org": 1.5, "a.example.org": 3.0}, 0.2).select("page_id", "interval")


# --- feeds and documents -------------------------------------------------------------------------------------------------


@query("""SELECT p_partkey, unnest([0, 1])::INT AS rank, unnest(['2301.0' || lpad((p_partkey % 10000)::VARCHAR, 4, '0'), '2302.00001']) AS id, unnest([p_name || ' & more', 'Second']) AS title, unnest(['Ann Lee,Bo Ray', 'Cy']) AS authors, unnest([2023, 2024])::INT AS year FROM part""")
def atom_entries(spark, sf_dir):
    one = lambda i, t, names, y: F.concat(F.lit("<entry><id>http://arxiv.org/abs/"), i, F.lit("v2</id><title> "), t, F.lit(" </title>" + "".join(f"<author><name>{n}</name></author>" for n in names) + f"<published>{y}-01-02T00:00:00Z</published></entry>"))
    number = F.concat(F.lit("2301.0"), F.lpad((F.col("p_partkey") % 10000).cast("string"), 4, "0"))
    feed = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), one(number, F.concat("p_name", F.lit(" &amp;\n more")), ["Ann Lee", "Bo Ray"], 2023), one(F.lit("2302.00001"), F.lit("Second"), ["Cy"], 2024), F.lit("</feed>"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a short row makes a long feed: time follows the rows, not the bytes that a scan's tasks are cut by
    rows = read(spark, sf_dir, "part").select("p_partkey", "p_name").repartition(parts, "p_partkey").select("p_partkey", feed.alias("feed"))
    return records.atom(rows, "feed", ["p_partkey"]).withColumn("authors", F.array_join("authors", ","))


@query("""SELECT p_partkey, p_name AS title, p_partkey % 2 = 0 AS has_abstract, (p_partkey % 5)::INT AS reference_count, 'lee' AS first_author_surname, 1.0::DOUBLE AS title_similarity, p_partkey % 3 = 0 AS first_author_match FROM part""")
def tei_documents(spark, sf_dir):
    p = F.col("p_partkey")
    abstract = F.when(p % 2 == 0, "<abstract><p>Short.</p></abstract>").otherwise("<abstract/>")
    tei = F.concat(
        F.lit('<TEI xmlns="http://www.tei-c.org/ns/1.0"><teiHeader><fileDesc><titleStmt><title>'), "p_name", F.lit("</title></titleStmt><sourceDesc><author><persName><surname>Lee</surname></persName></author></sourceDesc></fileDesc><profileDesc>"), abstract,
        F.lit("</profileDesc></teiHeader><text><body><p>Words.</p></body><back><listBibl>"), F.expr("repeat('<biblStruct/>', cast(p_partkey % 5 as int))"), F.lit("</listBibl></back></text></TEI>"),
    )
    rows = records.tei_features(read(spark, sf_dir, "part").select("p_partkey", "p_name", tei.alias("tei")))
    rows = records.tei_match(rows, F.col("p_name"), F.when(p % 3 == 0, "Lee, Ann").otherwise("Ray, Bo"))
    return rows.select("p_partkey", "title", "has_abstract", "reference_count", "first_author_surname", "title_similarity", "first_author_match")


# --- tables of state -----------------------------------------------------------------------------------------------------


@query(f"""WITH {LOG_SQL}, s AS (SELECT entry_key, 'old' AS state FROM log GROUP BY 1), n AS (SELECT entry_key, arg_max(event_type, event_id) AS state FROM log WHERE file_path = 'f3' GROUP BY 1)
    SELECT entry_key, coalesce(n.state, s.state) AS state FROM s LEFT JOIN n USING (entry_key)""")
def upsert_state(spark, sf_dir):
    rows = log(spark, sf_dir)
    state = rows.select("entry_key").distinct().withColumn("state", F.lit("old"))
    new = rows.where("file_path = 'f3'").select("entry_key", F.col("event_type").alias("state"), F.col("event_id").alias("_ord"))
    return tracking.upsert(state, new, ["entry_key"])


@query(f"WITH {LOG_SQL} SELECT DISTINCT entry_key FROM log WHERE entry_key NOT IN (SELECT entry_key FROM log WHERE file_path = 'f2' AND status = 'failed')")
def never_tried_entries(spark, sf_dir):
    rows = log(spark, sf_dir)
    return tracking.never_tried(rows.select("entry_key").distinct(), rows.where("file_path = 'f2' and status = 'failed'"), ["entry_key"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'present' WHEN o_orderkey % 2 = 0 THEN 'deleted' ELSE 'present' END AS status FROM orders""")
def scanned_files(spark, sf_dir):
    """Orders as known files: a third is scanned again, of the rest every other was last seen long ago."""
    now = F.lit("2024-01-01 00:10:00").cast("timestamp")
    seen = F.when(F.col("o_orderkey") % 2 == 0, F.lit("2024-01-01 00:00:00")).otherwise(F.lit("2024-01-01 00:09:30")).cast("timestamp")
    state = read(spark, sf_dir, "orders").select("o_orderkey", seen.alias("seen_at"), F.lit("present").alias("status"))
    return paths.scanned(state, state.where("o_orderkey % 3 = 0"), "o_orderkey", now).select("o_orderkey", "status")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 2 END::INT AS tier FROM customer""")
def two_tier_candidates(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey")
    return matching.two_tiers(rows.where("c_custkey % 3 = 0"), rows, ["c_custkey"])


@query(f"""WITH {LOG_SQL} SELECT count(*) AS n, min(event_id) AS first, max(event_id) AS last FROM log WHERE event_id % 4 = 1""")
def imported_log_rows(spark, sf_dir):
    """A log exported as JSON lines and imported where a quarter of it is missing."""
    rows = log(spark, sf_dir).select("file_path", "entry_key", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"), "event_id")
    new = records.imported_log(rows.where("event_id % 4 <> 1"), records.exported_log(rows))
    return new.agg(F.count("*").alias("n"), F.min("event_id").alias("first"), F.max("event_id").alias("last"))


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber = 1)")
def unmatched_entries(spark, sf_dir):
    held = read(spark, sf_dir, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"))
    return reconcile.anti(read(spark, sf_dir, "orders").where("o_orderkey % 2 = 0"), held, ["o_orderkey"]).select("o_orderkey", "o_custkey")


def _kept(x: Column) -> Column:
    return F.array_join(paths.distinct_ignoring_case(x), ",")


@query("SELECT p_partkey, p_type || ',Other' || CASE WHEN lower(p_name) = lower(p_type) THEN '' ELSE ',' || p_name END AS keywords FROM part")
def keywords_ignoring_case(spark, sf_dir):
    words = F.array("p_type", F.lower("p_type"), F.lit("Other"), F.upper(F.lit("other")), "p_name")
    return read(spark, sf_dir, "part").select("p_partkey", _kept(words).alias("keywords"))
