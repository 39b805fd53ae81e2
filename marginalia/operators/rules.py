"""Quality rules: arrays of findings in one pass over the rows, a cap per kind, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from marginalia.functions import text as T

# The fields that each entry type must have, by profile.
REQUIRED = {
    "scan": {"inproceedings": ["author", "title", "booktitle", "year"]},
    "strict": {
        "article": ["author", "title", "journal", "year"],
        "book": ["author", "title", "publisher", "year"],
        "incollection": ["author", "title", "booktitle", "publisher", "year"],
        "inproceedings": ["author", "title", "booktitle", "year"],
        "mastersthesis": ["author", "title", "school", "year"],
        "phdthesis": ["author", "title", "school", "year"],
        "techreport": ["author", "title", "institution", "year"],
    },
    "enriched": {
        "article": ["author", "title", "journal", "year"],
        "book": ["author", "title", "publisher", "year"],
        "inbook": ["author", "title", "pages", "publisher", "year"],
        "incollection": ["author", "title", "booktitle", "publisher", "year"],
        "inproceedings": ["author", "title", "booktitle", "year"],
        "mastersthesis": ["author", "title", "school", "year"],
        "misc": ["title", "year"],
        "phdthesis": ["author", "title", "school", "year"],
        "techreport": ["author", "title", "institution", "year"],
        "unpublished": ["author", "title", "note"],
    },
}
# Texts of failures that may pass by themselves, and of those that won't.
TRANSIENT = ("http 408", "http 425", "http 429", "http 500", "http 502", "http 503", "http 504", "timed out", "timeout", "temporar", "connection", "chunkedencodingerror", "contentdecodingerror", "name or service not known", "temporary failure in name resolution", "connection reset", "connection aborted", "broken pipe", "ssl")
PERMANENT = ("http 4", "unexpected content-type", "invalid pdf", "no candidate url")


def found(*checks: tuple[Column, Column | str]) -> Column:
    """The array of what holds: (condition, value) in order."""
    return F.array_compact(F.array(*[F.when(c, F.lit(v) if isinstance(v, str) else v) for c, v in checks]))


def missing(fields: Column, names: list[str]) -> Column:
    """Those of names that a field map lacks or has blank, in order."""
    return found(*[(~T.filled(fields[n]), n) for n in names])


def key_findings(key: Column, year: Column) -> Column:
    """What is wrong with a key by the scan's rules."""
    digits = F.regexp_extract(key, r"(\d{4})", 1)
    ends = F.length(F.regexp_extract(key, r"^(.*?\d{4})", 1)) == F.length(key)
    checks = found(
        (~key.rlike("^[a-z0-9]+$"), "only a-z and 0-9 may stand in a key"),
        (digits == "", "no year in the key"),
        ((digits != "") & (F.coalesce(year, F.lit("")) != "") & (digits != year), "key and entry differ in the year"),
        ((digits != "") & ends, "nothing follows the year in the key"),
    )
    return F.when(F.coalesce(key, F.lit("")) == "", F.array(F.lit("no key"))).otherwise(checks)


def strict_key_findings(key: Column, expected: Column) -> Column:
    """What is wrong with a key that must have author, year and keyword."""
    shaped = T.canonical_key(F.lower(key))
    checks = found(
        (key != F.lower(key), "upper-case letters in the key"),
        (key.rlike("[^a-zA-Z0-9]"), "other characters than letters and digits in the key"),
        (~shaped & ~key.rlike(r"\d{4}"), "no year of four digits in the key"),
        (~shaped & key.rlike(r"\d{4}"), "not author, year and keyword in a row"),
        (shaped & expected.rlike(r"^\d{4}$") & ~key.contains(expected), "key and entry differ in the year"),
    )
    return F.when(~T.filled(key), F.array(F.lit("no key"))).otherwise(checks)


def lint_key_findings(key: Column, year: Column) -> Column:
    """What is wrong with a key by the linter's rules: case, separators, shape, and the entry's year inside."""
    checks = found(
        (key != F.lower(key), "upper case in an entry key"),
        (key.rlike(r"[-_.]"), "dash, underscore or dot in an entry key"),
        (~T.canonical_key(key), "entry key is not author, year and keyword in a row"),
        (F.coalesce(year, F.lit("")).rlike(r"^(19|20)\d{2}$") & ~F.contains(key, F.coalesce(year, F.lit(""))), "entry key without the year of its entry"),
    )
    return F.when(F.coalesce(key, F.lit("")) == "", F.array(F.lit("entry without a key"))).otherwise(checks)


def pdf_link(url: Column) -> Column:
    """The linter's test of a PDF link: narrower than text.pdf_like."""
    u = F.lower(F.coalesce(url, F.lit("")))
    return F.endswith(u, F.lit(".pdf")) | u.contains("/pdf?") | u.contains("arxiv.org/pdf/")


def openalex_problem(value: Column) -> Column:
    """Why an entry has no usable OpenAlex id: null if it has one."""
    v = F.trim(F.coalesce(value, F.lit("")))
    return F.when(v == "", "missing").when(~v.rlike(r"^W\d+$"), "invalid")


def abstract_problem(abstract: Column, kind: Column, least: int = 50, most: int = 1000) -> Column:
    """What is wrong with an abstract, as severity:problem; null if nothing. Books and misc entries may lack one."""
    n = T.word_count(abstract)
    may = F.lower(F.coalesce(kind, F.lit(""))).isin("book", "misc")
    return F.when((n == 0) & may, "warning:missing").when(n == 0, "failed:missing").when(n < least, "warning:short").when(n > most, "warning:long")


def issue(severity: str, code: str, message: Column | str) -> Column:
    return F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("issue_type"), (F.lit(message) if isinstance(message, str) else message).alias("message"))


def lint(entries: DataFrame, profile: str = "strict", oral: str = "") -> DataFrame:
    """(file_path, entry_idx, entry_key, rule, severity, issue_type, message) of entries (file_path, entry_idx, entry_type, entry_key, fields).

    One pass, no shuffle. oral: a part of the path of the files whose entries must be talks.
    """
    f = {n: F.trim(F.coalesce(F.col("fields")[n], F.lit(""))) for n in ("url", "pdf", "arxiv", "note", "year", "author")}
    kind = F.lower(F.trim("entry_type"))
    needs = F.lit(None).cast("array<string>")
    for name, names in REQUIRED[profile].items():
        needs = F.when(kind == name, missing(F.col("fields"), names)).otherwise(needs)
    checks: list[tuple[Column, Column]] = [
        (F.size(needs) > 0, issue("error", "missing_required_fields", F.concat(kind, F.lit(" lacks "), F.array_join(needs, ", ")))),
        ((f["year"] != "") & ~f["year"].rlike(r"^(19|20)\d{2}$"), issue("error", "invalid_year", F.concat(F.lit("not a year from 1900 to 2099: "), f["year"]))),
        (F.lower(f["author"]).contains("and others") | F.lower(f["author"]).contains("others}"), issue("warning", "placeholder_authors", "the list of authors ends in a stand-in")),
    ]
    for name in ("url", "pdf", "arxiv"):
        checks.append(((f[name] != "") & ~f[name].rlike("(?i)^https?://"), issue("error", "invalid_url_scheme", F.concat(F.lit(f"{name} is no web address: "), f[name]))))
    checks += [
        ((f["pdf"] != "") & ~pdf_link(f["pdf"]), issue("warning", "pdf_field_suspicious", F.concat(F.lit("pdf leads to no PDF by its looks: "), f["pdf"]))),
        ((f["arxiv"] != "") & ~F.lower(f["arxiv"]).contains("arxiv.org/abs/"), issue("warning", "arxiv_field_suspicious", F.concat(F.lit("arxiv leads to no abstract page: "), f["arxiv"]))),
    ]
    if oral:
        stem = F.regexp_extract("file_path", r"([^/]*)\.[^./]*$", 1)
        of_url, of_pdf = T.forum_id(f["url"]), T.forum_id(f["pdf"])
        talk = F.col("file_path").contains(oral)
        checks += [
            (talk & (kind != "inproceedings"), issue("error", "oral_entry_type", "a talk that is no inproceedings")),
            (talk & (f["url"] == ""), issue("error", "oral_missing_url", "a talk without url")),
            (talk & (f["pdf"] == ""), issue("error", "oral_missing_pdf", "a talk without pdf")),
            (talk & (F.lower(f["note"]) != "oral"), issue("warning", "oral_note", "a talk whose note is not Oral")),
            (talk & (f["year"] != "") & (f["year"] != stem), issue("error", "oral_year_mismatch", F.concat_ws(" ", F.lit("a talk of"), f["year"], F.lit("in the file of"), stem))),
            (talk & ((of_url == "") != (of_pdf == "")), issue("warning", "oral_mixed_openreview_links", "only one of url and pdf leads to the review site")),
            (talk & (of_url != "") & (of_pdf != "") & (of_url != of_pdf), issue("error", "oral_openreview_id_mismatch", F.concat(F.lit("url id ("), of_url, F.lit(") and pdf id ("), of_pdf, F.lit(") differ")))),
        ]
    keys = F.transform(lint_key_findings(F.trim("entry_key"), f["year"]), lambda m: issue("warning", "key_format", m))
    every = F.concat(found(*checks), keys)
    return entries.select("file_path", "entry_idx", "entry_key", F.posexplode(every).alias("rule", "i")).select("file_path", "entry_idx", "entry_key", "rule", "i.*")


#: Fields whose presence tells how ready entries are for the later steps.
READY = ("title", "author", "year", "url", "pdf", "abstract", "doi", "file")


def counted_lint(entries: DataFrame, profile: str = "strict", oral: str = "") -> tuple[DataFrame, Observation, Observation]:
    """lint(), with counters that the same pass fills: of the entries (entries, and with_<field> for each of READY), and of the issues (issues, errors, warnings).

    The observations can be read when an action on the issues has ended; they count what that one scan met, so nothing is read a second time.
    """
    seen, made = Observation("entries"), Observation("issues")
    rows = entries.observe(seen, F.count(F.lit(1)).alias("entries"), *[F.count_if(T.filled(F.col("fields")[n])).alias(f"with_{n}") for n in READY])
    issues = lint(rows, profile, oral)
    counters = [F.count(F.lit(1)).alias("issues"), F.count_if(F.col("severity") == "error").alias("errors"), F.count_if(F.col("severity") == "warning").alias("warnings")]
    return issues.observe(made, *counters), seen, made


def profile_entries(entries: DataFrame) -> DataFrame:
    """One row of statistics an entry: what it has, its normal title and author, DOI, and link fingerprint."""
    f = lambda n: F.coalesce(F.col("fields")[n], F.lit(""))
    has = lambda n: T.present(F.col("fields")[n])
    link = F.when(has("url"), f("url")).otherwise(f("pdf"))
    return entries.select(
        "file_path", "entry_idx", "entry_key", F.lower("entry_type").alias("entry_type"), F.trim(f("year")).alias("year"), T.normal(f("title"), trim_first=True).alias("title_norm"), f("author").alias("author_raw"),
        T.doi(f("doi")).alias("doi"), T.url_fingerprint(link).alias("url_fp"), has("author").alias("has_author"), has("title").alias("has_title"), has("booktitle").alias("has_booktitle"), has("url").alias("has_url"), has("pdf").alias("has_pdf"), has("file").alias("has_file"),
    )


def capped(issues: DataFrame, order: list[Column], limit: int = 200, kind: str = "issue_type") -> DataFrame:
    """The first `limit` issues of each kind in the given order, and an `issue_limit_reached` row for each kind that has more.

    Adds `suppressed`: null but for the latter. The ranking stops at `limit` rows a kind before the shuffle; the overflow is an
    aggregate of its own.
    """
    first = issues.withColumn("_n", F.row_number().over(Window.partitionBy(kind).orderBy(*order))).where(F.col("_n") <= limit).drop("_n").withColumn("suppressed", F.lit(None).cast("long"))
    over = issues.groupBy(kind).agg((F.count("*") - limit).alias("suppressed")).where("suppressed > 0")
    rest = [F.lit("issue_limit_reached").alias(c) if c == "severity" else F.col(c) if c == kind else F.lit(None).cast(issues.schema[c].dataType).alias(c) for c in issues.columns]
    return first.unionByName(over.select(*rest, "suppressed"))


def summary(issues: DataFrame) -> DataFrame:
    """Counts by severity, by kind and in all, in one pass: level, name, n."""
    sets = issues.groupingSets([[F.col("severity")], [F.col("issue_type")], []], F.col("severity"), F.col("issue_type"))
    out = sets.agg(F.count("*").alias("n"), F.grouping_id().alias("g"))
    return out.select(F.when(F.col("g") == 1, "severity").when(F.col("g") == 2, "issue_type").otherwise("all").alias("level"), F.coalesce("severity", "issue_type", F.lit("")).alias("name"), "n")


def status(failed: Column, warned: Column) -> Column:
    """failed before warning before passed."""
    return F.when(F.size(failed) > 0, "failed").when(F.size(warned) > 0, "warning").otherwise("passed")


def transient(message: Column) -> Column:
    """A failure that may pass; an empty message counts as one."""
    m = F.lower(F.coalesce(message, F.lit("")))
    out = (m == "") | m.rlike(r"\bhttp(?:\s+status)?\s+(408|425|429|500|502|503|504)\b")
    for marker in TRANSIENT:
        out = out | m.contains(marker)
    return out


def counts_toward_abort(state: Column, message: Column) -> Column:
    """A failure that hints at an outage: transient or unknown, not one of the source's own."""
    m = F.lower(F.coalesce(message, F.lit("")))
    own = F.lit(False)
    for marker in PERMANENT:
        own = own | m.contains(marker)
    return (state == "failed") & (transient(message) | ~own)


def has_any(text: Column, markers: list[str]) -> Column:
    low, out = F.lower(F.coalesce(text, F.lit(""))), F.lit(False)
    for m in markers:
        out = out | low.contains(m.lower())
    return out


def response_problem(code: Column, body: Column, require_any: list[str], reject_any: list[str]) -> Column:
    """Why a response is not usable: null if it is."""
    return (
        F.when((code == 429) | has_any(body, ["too many requests", "rate limit"]), "rate_limited")
        .when((code < 200) | (code >= 300), F.concat(F.lit("http "), code.cast("string")))
        .when(has_any(body, reject_any) if reject_any else F.lit(False), "rejected_marker")
        .when(~has_any(body, require_any) if require_any else F.lit(False), "required_marker_missing")
    )


def pdf_problem(content: Column, size: Column) -> Column:
    """Why bytes are no whole PDF: null if they are one."""
    head = F.substring(content, 1, 5).cast("string")
    tail = F.decode(F.substring(content, -4096, 4096), "ISO-8859-1")
    return F.when(size < 1024, "too small").when(head != "%PDF-", "no header").when(~tail.contains("%%EOF"), "no end mark")


def page_tier(pages: Column, limits: tuple[int, int, int] = (50, 150, 500)) -> Column:
    a, m, l = limits
    return F.when(pages.isNull() | (pages <= 0), "unknown").when(pages <= a, "article").when(pages <= m, "medium").when(pages <= l, "long").otherwise("huge")


def required_subset(got: Column, required: list[str]) -> Column:
    return F.size(F.array_except(F.array(*[F.lit(r) for r in required]), F.coalesce(got, F.array().cast("array<string>")))) == 0


def multiset_contains(stored: Column, wanted: Column) -> Column:
    """Every string of `wanted` is in `stored` at least as often."""
    times = lambda a, x: F.size(F.filter(a, lambda y: y == x))
    return F.forall(wanted, lambda x: times(stored, x) >= times(wanted, x))


def resumable(same: Column, state: Column, files_exist: Column, permanent: Column, retry_failed: bool) -> Column:
    """Work already done: the same fingerprint and an end state whose files exist, or a failure that needn't be tried again."""
    done = state.isin("downloaded", "already_present", "relinked", "moved") & files_exist
    return same & (done | ((state == "failed") & (permanent | F.lit(not retry_failed))))


def note_audit(notes: Column, ledger: Column, log: Column) -> Column:
    """What a bundle of reading notes lacks: gates, labels, anchored bullets, anchors, a summary of each chunk."""
    bullets = F.size(F.regexp_extract_all(ledger, F.lit(r"(?m)^- Anchor:"), F.lit(0)))
    anchors = F.size(F.regexp_extract_all(ledger, F.lit(r"(?i)anchor"), F.lit(0)))
    labels = F.size(F.regexp_extract_all(F.get_json_object(notes, "$.coordinates"), F.lit(r'"[^"]+"\s*:'), F.lit(0)))
    done = F.from_json(log, "completed boolean, chunks_completed int, chunks_total int, chunks array<struct<id string, summary string>>")
    return found(
        (F.coalesce(F.get_json_object(notes, "$.tex_source_gate"), F.lit("")).isin("", "false"), "tex_source_gate"),
        (F.coalesce(F.get_json_object(notes, "$.readthrough_complete"), F.lit("")).isin("", "false"), "readthrough_complete"),
        (F.coalesce(labels, F.lit(0)) < 3, "coordinates"),
        (F.coalesce(bullets, F.lit(0)) < 12, "anchored_bullets"),
        (F.coalesce(anchors, F.lit(0)) < 10, "anchors"),
        (~F.coalesce(done["completed"] & (done["chunks_completed"] == done["chunks_total"]), F.lit(False)), "readthrough_log"),
        (F.coalesce(F.exists(done["chunks"], lambda c: ~T.filled(c["summary"])), F.lit(False)), "chunk_summary"),
    )
