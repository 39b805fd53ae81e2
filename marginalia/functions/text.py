"""Column expressions over citation text: normal forms, names, keys, urls, identifiers, attachment fields.

All are built-in functions and stay in generated code, but for `unescape_fold`, which needs Unicode decomposition, and `with_normal`, which is `normal` of whole texts.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Accented letters and what they fold to.
ACCENTED = "àáâäãéèêëíìîïóòôöõúùûüñçß"
FOLDED = "aaaaaeeeeiiiiooooouuuunc"
# Words that are no keywords, titles that many works share, and keywords that say nothing. They are sets: their order says nothing.
STOPWORDS = ("a", "about", "against", "an", "and", "as", "at", "between", "by", "during", "for", "from", "in", "into", "of", "on", "or", "over", "the", "to", "under", "via", "with", "without")
GENERIC_TITLES = ("addendum", "announcement", "corrigendum", "editorial", "erratum", "publisher s note")
GENERIC_KEYWORDS = ("approach", "article", "method", "paper", "research", "study")

type Text = Column | str


def col(x: Text) -> Column:
    return F.col(x) if isinstance(x, str) else x


def filled(x: Text) -> Column:
    """True unless null or blank: the reading of missing values that strips."""
    return F.trim(F.coalesce(col(x), F.lit(""))) != ""


def present(x: Text) -> Column:
    """True unless null or empty: white space counts as present."""
    return F.coalesce(col(x), F.lit("")) != ""


def spaces(x: Text) -> Column:
    """Runs of white space become one blank; trimmed."""
    return F.trim(F.regexp_replace(col(x), r"\s+", " "))


def fold(x: Text) -> Column:
    """Lower case, accents folded by the fixed table, other non-ASCII dropped."""
    return F.regexp_replace(F.translate(F.lower(col(x)), ACCENTED, FOLDED), r"[^\x00-\x7F]", "")


def strip_commands(x: Text) -> Column:
    """LaTeX commands removed and their arguments kept, by dropping commands and braces."""
    return F.regexp_replace(F.regexp_replace(col(x), r"\\[a-zA-Z]+\*?\s*|\\[^a-zA-Z]", ""), r"[{}]", "")


def strip_latex(x: Text, depth: int = 4) -> Column:
    """LaTeX commands replaced by their arguments, innermost first, `depth` levels deep; other braces and commands dropped."""
    out = col(x)
    for _ in range(depth):
        out = F.regexp_replace(out, r"\\[a-zA-Z]+\*?\s*\{([^{}]*)\}", "$1")
    out = F.regexp_replace(out, r"\\[a-zA-Z]+\*?|\\[^a-zA-Z\s]", " ")
    return spaces(F.regexp_replace(out, r"[{}]", ""))


def normal(x: Text, latex: bool = False, trim_first: bool = False, keep: str = "a-z0-9 ") -> Column:
    """One builder for the normal forms of titles and names.

    latex: strip commands before. trim_first: trim before punctuation becomes blanks, so a trailing blank can stay. keep: the
    characters that stay.
    """
    out = fold(strip_latex(x) if latex else F.regexp_replace(col(x), r"[{}]", ""))
    if trim_first:
        return F.regexp_replace(F.regexp_replace(F.trim(out), rf"[^{keep}]", " "), " +", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(out, rf"[^{keep}]", " "), " +", " "))


_FOLDS = [(a, b) for a, b in zip(ACCENTED, FOLDED)]
_SPACED = bytes(c if chr(c).isdigit() or "a" <= chr(c) <= "z" else 32 for c in range(128)) + bytes([32]) * 128


def with_normal(rows: DataFrame, text: str, name: str) -> DataFrame:
    """rows with normal(text) in place of the text: each text is folded once, whatever filters and joins follow, and many times as fast as by expressions."""

    def one(t: str | None) -> str | None:
        if t is None:
            return None
        t = t.lower().replace("{", "").replace("}", "")
        if not t.isascii():
            for a, b in _FOLDS:
                t = t.replace(a, b)
        return b" ".join(t.encode("ascii", "ignore").translate(_SPACED).split()).decode()

    def fold_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                made = pa.array([one(t) for t in part.column(k).to_pylist()], pa.string())
                yield pa.RecordBatch.from_arrays([made if i == k else part.column(i) for i in range(part.num_columns)], names=names)

    k = rows.columns.index(text)
    names = [name if c == text else c for c in rows.columns]
    schema = ", ".join(f"`{n}` {f.dataType.simpleString()}" for n, f in zip(names, rows.schema))
    return rows.mapInArrow(fold_all, schema)


def compact(x: Text) -> Column:
    """The normal form without blanks."""
    return F.replace(normal(x), F.lit(" "), F.lit(""))


@F.pandas_udf(StringType())
def unescape_fold(x: pd.Series) -> pd.Series:
    """Entities decoded, LaTeX arguments kept to any depth, compatibility decomposition to ASCII, normal form."""

    def one(v):
        if v is None:
            return None
        v, before = html.unescape(v), None
        while v != before:
            before, v = v, re.sub(r"\\[a-zA-Z]+\*?\s*\{([^{}]*)\}", r"\1", v)
        v = re.sub(r"\\[a-zA-Z]+\*?|\\[^a-zA-Z\s]", " ", v).replace("{", "").replace("}", "")
        v = unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().lower()
        return " ".join(re.sub(r"[^a-z0-9 ]", " ", v).split())

    return x.map(one)


@F.pandas_udf(StringType())
def balanced_braces(x: pd.Series) -> pd.Series:
    """The text without the braces that have no partner; an escaped brace is text."""

    def one(v):
        if v is None:
            return None
        drop, open_ = set(), []
        k = 0
        while k < len(v):
            if v[k] == "\\":
                k += 2
                continue
            if v[k] == "{":
                open_.append(k)
            elif v[k] == "}":
                open_.pop() if open_ else drop.add(k)
            k += 1
        drop |= set(open_)
        return "".join(c for k, c in enumerate(v) if k not in drop)

    return x.map(one)


def word_count(x: Text) -> Column:
    t = spaces(F.coalesce(col(x), F.lit("")))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, " ")))


def words(x: Text) -> Column:
    """Distinct words of a normal form, in order."""
    return F.array_distinct(F.filter(F.split(col(x), " "), lambda w: w != ""))


def equivalent(a: Text, b: Text) -> Column:
    return normal(a) == normal(b)


def prefix_equivalent(a: Text, b: Text) -> Column:
    x, y = normal(a), normal(b)
    return (x != "") & (y != "") & (F.startswith(x, y) | F.startswith(y, x))


def without_controls(x: Text) -> Column:
    """Control characters, end-of-file marks, literal \\n and \\t, and runs of white space become one blank."""
    return spaces(F.regexp_replace(F.regexp_replace(col(x), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", ""), r"\\[nt](?![a-zA-Z])", " "))


def strip_tags(x: Text) -> Column:
    """Tags become blanks, the five basic entities are decoded, white space collapses."""
    out = F.regexp_replace(col(x), r"<[^>]+>", " ")
    for name, value in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(name), F.lit(value))
    return spaces(out)


def meta_value(page: Text, name: str) -> Column:
    """The content of the first meta element of that name."""
    return F.regexp_extract(col(page), rf'(?is)<meta\s+[^>]*name="{re.escape(name)}"[^>]*content="([^"]*)"', 1)


def meta_values(page: Text, name: str) -> Column:
    return F.regexp_extract_all(col(page), F.lit(rf'(?is)<meta\s+[^>]*name="{re.escape(name)}"[^>]*content="([^"]*)"'), F.lit(1))


def slug(x: Text) -> Column:
    return F.regexp_replace(F.regexp_replace(fold(x), r"[^a-z0-9]+", "-"), r"^-+|-+$", "")


def safe_filename(x: Text) -> Column:
    return F.regexp_replace(F.regexp_replace(col(x), r"[^A-Za-z0-9._-]+", "_"), r"^[._]+", "")


# --- names -------------------------------------------------------------------------------------------------------------


def authors(x: Text) -> Column:
    """The authors of an author field."""
    return F.filter(F.transform(F.split(spaces(x), r"(?i) and "), lambda a: F.trim(a)), lambda a: a != "")


def surname(author: Text) -> Column:
    """The last word of what stands before a comma, or of the whole name."""
    a = F.trim(normal(author, keep="a-z0-9, "))
    return F.coalesce(F.element_at(F.split(F.trim(F.split_part(a, F.lit(","), F.lit(1))), " "), -1), F.lit(""))


def lettered_surname(author: Text) -> Column:
    """The last word that has a letter, so that numbers which tell namesakes apart don't count."""
    a = normal(author, latex=True)
    return F.coalesce(F.element_at(F.filter(F.split(a, " "), lambda w: w.rlike("[a-z]")), -1), F.lit(""))


def author_signature(x: Text, lettered: bool = False) -> Column:
    return F.array_join(F.transform(authors(x), lettered_surname if lettered else surname), " ")


def placeholder_author(x: Text) -> Column:
    """Names that stand for others: `and others`, `et al`."""
    return F.coalesce(normal(x).rlike(r"(^|and )others$|\bet al\b|^anonymous$|^unknown$"), F.lit(False))


def first_surname(x: Text) -> Column:
    """The first author's surname; empty for a placeholder."""
    return F.when(placeholder_author(x), "").otherwise(F.coalesce(surname(F.get(authors(x), F.lit(0))), F.lit("")))


# --- years and dates ---------------------------------------------------------------------------------------------------


def year(x: Text) -> Column:
    """The first 19xx or 20xx of a text; null without any."""
    return F.nullif(F.regexp_extract(col(x).cast("string"), r"((?:19|20)\d\d)", 1), F.lit("")).cast("int")


def sort_year(x: Text) -> Column:
    """A year or the first of a range; 0 for anything else."""
    return F.coalesce(F.trim(F.split_part(col(x), F.lit("-"), F.lit(1))).try_cast("int"), F.lit(0))


def month_name(date: Text) -> Column:
    return F.lower(F.date_format(F.expr(f"try_to_date({date})") if isinstance(date, str) else F.try_to_date(date), "MMM"))


def iso_timestamp(x: Text) -> Column:
    """`yyyy-MM-dd hh:mm:ss` as ISO with a T; other text unchanged."""
    return F.when(col(x).rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d"), F.regexp_replace(col(x), r"^(\S+) ", "$1T")).otherwise(col(x))


def iso_date(x: Text) -> Column:
    return F.when(col(x).rlike(r"^\d{4}-\d\d-\d\d$"), F.try_to_date(col(x)))


def retry_after(x: Text, now: Column) -> Column:
    """Seconds of a Retry-After value, given as a number or an HTTP date."""
    at = F.try_to_timestamp(F.regexp_replace(col(x), r"^\w+, | GMT$", ""), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.when(col(x).rlike(r"^\d+$"), col(x).cast("long")).otherwise(F.greatest(F.lit(0), F.unix_timestamp(at) - F.unix_timestamp(now)))


def backoff(failures: Column, base: int = 2, most: int = 300) -> Column:
    return F.least(F.lit(base) * F.pow(F.lit(2), failures), F.lit(most))


def percent(part: Column, whole: Column, digits: int | None = None) -> Column:
    out = F.when(whole > 0, F.lit(100.0) * part / whole).otherwise(F.lit(0.0))
    return F.round(out, digits) if digits is not None else out


# --- keys --------------------------------------------------------------------------------------------------------------


def keywords(title: Text, n: int = 5) -> Column:
    """Distinct title words over two letters that aren't stopwords, then the other words, `n` at most."""
    every = words(normal(title, latex=True))
    found = F.filter(every, lambda w: (F.length(w) > 2) & ~w.isin(*STOPWORDS))
    return F.slice(F.array_distinct(F.concat(found, every)), 1, n)


def author_token(author: Text) -> Column:
    """The first author's surname in letters and digits, `paper` without one."""
    first = F.trim(F.split_part(F.coalesce(F.get(authors(author), F.lit(0)), F.lit("")), F.lit(","), F.lit(1)))
    token = F.regexp_replace(fold(F.element_at(F.split(first, r"\s+"), -1)), "[^a-z0-9]+", "")
    return F.when(token == "", "paper").otherwise(token)


def year_token(published: Text) -> Column:
    return F.coalesce(year(published).cast("string"), F.lit("0000"))


def synthesised_key(author: Text, published: Text, title: Text) -> Column:
    """Author, year and keyword; a key that would start with a digit gets a p."""
    key = F.concat(author_token(author), year_token(published), F.coalesce(F.get(keywords(title, 1), F.lit(0)), F.lit("paper")))
    return F.when(key.rlike("^[a-z]"), key).otherwise(F.concat(F.lit("p"), key))


def suggested_keys(author: Text, published: Text, title: Text, n: int = 3) -> Column:
    found = F.filter(keywords(title, max(3, 2 * n)), lambda w: ~w.isin(*GENERIC_KEYWORDS))
    return F.slice(F.transform(found, lambda w: F.concat(author_token(author), year_token(published), w)), 1, n)


def key_year(key: Text, last: int) -> Column:
    """The first plausible year of a key (1500 to `last`), else the first four digits."""
    found = F.transform(F.regexp_extract_all(col(key), F.lit(r"(\d{4})"), F.lit(1)), lambda y: y.cast("int"))
    return F.coalesce(F.get(F.filter(found, lambda y: y.between(1500, last)), F.lit(0)), F.get(found, F.lit(0)))


def entry_signature(published: Text, title: Text, author: Text) -> Column:
    return F.concat_ws("|", F.coalesce(year(published).cast("string"), F.lit("")), normal(title), author_signature(author))


def canonical_key(key: Text) -> Column:
    """author, year, keyword: lower-case letters and digits that start with a letter, with four digits inside."""
    return F.coalesce(col(key).rlike(r"^[a-z][a-z0-9]*\d{4}[a-z0-9]+$"), F.lit(False))


# --- urls and identifiers ----------------------------------------------------------------------------------------------


def url_fingerprint(x: Text) -> Column:
    """Lower case, without scheme and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(col(x))), r"^https?://", ""), r"/+$", "")


def host(x: Text) -> Column:
    return F.lower(F.regexp_extract(col(x), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def canonical_url(x: Text) -> Column:
    """Scheme and host in lower case, protocol-relative urls over https, no fragment."""
    u = F.regexp_replace(F.regexp_replace(F.trim(col(x)), r"#.*$", ""), r"^//", "https://")
    head = F.regexp_extract(u, r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    return F.concat(F.lower(head), F.substr(u, F.length(head) + 1))


def query_fingerprint(x: Text) -> Column:
    """Host, path and the sorted query without utm_ and blank parameters; empty unless the url has scheme and host."""
    u = F.regexp_replace(F.trim(col(x)), r"#.*$", "")
    path = F.regexp_replace(F.regexp_extract(u, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+([^?]*)", 1), r"/+$", "")
    query = F.split(F.regexp_extract(u, r"\?(.*)$", 1), "&")
    kept = F.array_sort(F.filter(query, lambda q: q.rlike(r"^[^=]+=.+$") & ~F.lower(q).startswith("utm_")))
    return F.when(host(x) == "", "").otherwise(F.concat(host(x), path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def host_in(host_: Column, domains: list[str]) -> Column:
    """A host is a domain or below it; no domains allow all, an empty host none."""
    if not domains:
        return F.lit(True)
    out = F.lit(False)
    for d in domains:
        out = out | (host_ == d) | F.endswith(host_, F.lit("." + d))
    return (host_ != "") & out


def same_host(a: Text, b: Text) -> Column:
    return (host(a) != "") & (host(a) == host(b))


def pdf_like(x: Text) -> Column:
    """A url whose path or query names a PDF."""
    u = F.lower(F.coalesce(col(x), F.lit("")))
    path = F.regexp_extract(F.regexp_replace(u, r"^[a-z][a-z0-9+.-]*://[^/?#]*", ""), r"^([^?#]*)", 1)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return path.rlike(r"\.pdf$|/pdf/|/pdf$") | query.rlike(r"format=pdf|download=pdf|pdf=")


def doi(x: Text) -> Column:
    """A DOI without resolver or `doi:`, in lower case; empty if there is none."""
    return F.lower(F.regexp_extract(F.trim(col(x)), r"(?i)(10\.\d{4,9}/[^\s\"<>]+)", 1))


def arxiv_id(*candidates: Text) -> Column:
    """The first arXiv id of several fields in the order of their precedence, without its version."""
    pattern = r"(?i)(?:^|arxiv[.:/]|abs/|pdf/)\s*(\d{4}\.\d{4,5}|[a-z-]+(?:\.[a-z]{2})?/\d{7})(?:v\d+)?"
    return F.lower(F.coalesce(*[F.nullif(F.regexp_extract(F.coalesce(col(c), F.lit("")), pattern, 1), F.lit("")) for c in candidates], F.lit("")))


def forum_id(x: Text, host_name: str | None = None) -> Column:
    """The id parameter of a url, of a given host if one is named."""
    found = F.regexp_extract(col(x), r"[?&]id=([A-Za-z0-9_-]+)", 1)
    return found if host_name is None else F.when(F.endswith(host(x), F.lit(host_name)), found).otherwise("")


def openalex_id(x: Text) -> Column:
    """The OpenAlex work id of a url or of the id itself; empty if there is none."""
    return F.upper(F.regexp_extract(F.trim(col(x)), r"(?i)(?:^|openalex\.org/(?:works/)?)(W\d+)/?$", 1))


def wikidata_id(x: Text) -> Column:
    """The entity id of a wikidata.org url; empty for other urls."""
    path = F.regexp_extract(F.trim(col(x)), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+([^?#]*)", 1)
    entity = F.upper(F.regexp_extract(path, r"/([Qq]\d+)/*$", 1))
    return F.when(host(x).isin("wikidata.org", "www.wikidata.org"), entity).otherwise("")


def wikidata_doi(payload: Text, entity: Text) -> Column:
    """The first DOI claim (P356) of an entity's JSON; empty if it has none."""
    found = F.from_json(F.get_json_object(col(payload), "$.entities"), "map<string,struct<claims:struct<P356:array<struct<mainsnak:struct<datavalue:struct<value:string>>>>>>>")
    return F.coalesce(doi(F.get(F.element_at(found, col(entity))["claims"]["P356"], F.lit(0))["mainsnak"]["datavalue"]["value"]), F.lit(""))


def identifiers(*columns: tuple[str, Column]) -> Column:
    """Distinct `scheme:value` of the identifiers that are there, in the order given."""
    return F.array_distinct(F.array_compact(F.array(*[F.when(present(c), F.concat(F.lit(s + ":"), c)) for s, c in columns])))


def attachment_path(x: Text) -> Column:
    """The path of a `:path:type` attachment field, or of a bare path; the first of several."""
    first = F.split_part(F.trim(col(x)), F.lit(";"), F.lit(1))
    return F.when(first.rlike(r"^[^:]*:.+:[A-Za-z]+$"), F.regexp_extract(first, r"^[^:]*:(.+):[A-Za-z]+$", 1)).otherwise(first)


def attachment_paths(x: Text) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(col(x), F.lit("")), ";"), attachment_path), lambda p: p != "")


def attachment_field(path: Text, kind: str = "pdf") -> Column:
    return F.concat(F.lit(":"), col(path), F.lit(f":{kind}"))


# Entry types that have a folder of their name; others go to misc.
FOLDERS = "article book booklet conference inbook incollection inproceedings manual mastersthesis masterthesis misc online phdthesis phdproposal proceedings techreport unpublished".split()


def document_path(kind: Text, key: Text, nested: bool, suffix: str = "pdf") -> Column:
    """Where a document belongs: folder/key.pdf, or folder/key/key.pdf if nested."""
    folder = F.when(F.lower(col(kind)).isin(*FOLDERS), F.lower(col(kind))).otherwise("misc")
    return F.concat_ws("/", folder, *([col(key)] if nested else []), F.concat(col(key), F.lit(f".{suffix}")))


def derived_urls(url: Text, doi_: Text, arxiv: Text) -> Column:
    """PDF candidates of an entry: of its arXiv id, of a forum page, of its landing page, of its DOI."""
    forum = forum_id(url)
    return F.array_distinct(
        F.array_compact(
            F.array(
                F.when(pdf_like(url), canonical_url(url)),
                F.when(present(arxiv), F.concat(F.lit("https://arxiv.org/pdf/"), col(arxiv))),
                F.when(present(forum) & col(url).contains("/forum?"), F.regexp_replace(col(url), r"/forum\?", "/pdf?")),
                F.when(col(url).rlike(r"/abs/|/abstract/"), F.regexp_replace(col(url), r"/abs(tract)?/", "/pdf/")),
                F.when(present(doi_), F.concat(F.lit("https://doi.org/"), col(doi_))),
            )
        )
    )
