"""Captured payloads as rows: JSON catalogs and search results, listing pages, Atom feeds, TEI, PDF bytes, CSV and JSON files."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from xml.parsers import expat

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

from marginalia.functions import similarity as S
from marginalia.functions import text as T


def unwrapped(payload: Column, name: str) -> Column:
    """A field of a payload that holds plain values or {"value": ...}."""
    return F.coalesce(F.get_json_object(payload, f"$.{name}.value"), F.get_json_object(payload, f"$.{name}"))


def catalog(papers: DataFrame, abstracts: DataFrame | None = None) -> DataFrame:
    """One row a result of catalog payloads (payload): source_id, title, authors, decision, kind, visible, url, abstract.

    abstracts: (source_id, abstract); an inline abstract is the fallback.
    """
    kind = "struct<results:array<struct<id:bigint,name:string,abstract:string,authors:array<struct<fullname:string>>,decision:string,eventtype:string,visible:boolean,virtualsite_url:string,paper_url:string>>>"
    rows = papers.select(F.explode(F.from_json("payload", kind)["results"]).alias("r"))
    rows = rows.select(
        F.col("r.id").cast("string").alias("source_id"), T.strip_tags("r.name").alias("title"), F.transform("r.authors", lambda a: T.spaces(a["fullname"])).alias("authors"), F.col("r.decision").alias("decision"),
        F.col("r.eventtype").alias("kind"), F.coalesce("r.visible", F.lit(False)).alias("visible"), F.coalesce("r.virtualsite_url", "r.paper_url").alias("url"), F.col("r.abstract").alias("inline"),
    )
    if abstracts is not None:
        rows = rows.join(abstracts, "source_id", "left").withColumn("abstract", F.coalesce("abstract", "inline"))
    else:
        rows = rows.withColumnRenamed("inline", "abstract")
    return rows.drop("inline")


def accepted(rows: DataFrame) -> DataFrame:
    """Adds reason: why a catalog row is not taken, null for accepted posters that are complete."""
    reason = F.when(~F.col("visible"), "hidden").when(~F.lower(F.coalesce("kind", F.lit(""))).contains("poster"), "no_poster").when(~F.lower(F.coalesce("decision", F.lit(""))).startswith("accept"), "not_accepted").when(~T.filled("title") | (F.size("authors") < 1), "incomplete")
    return rows.withColumn("reason", reason)


def accepted_venue(venue: Column, year: Column) -> Column:
    """A venue text of an accepted work: no submission, withdrawal or rejection, and the year is named."""
    v = F.lower(F.coalesce(venue, F.lit("")))
    return (v != "") & ~v.rlike("submitted to|withdrawn|reject|desk") & F.contains(v, year.cast("string"))


def record_problems(source_id: Column, title: Column, authors: Column, booktitle: Column, year: Column) -> Column:
    return F.array_compact(F.array(F.when(~T.filled(source_id), "source_id"), F.when(~T.filled(title), "title"), F.when(F.size(F.coalesce(authors, F.array().cast("array<string>"))) < 1, "authors"), F.when(~T.filled(booktitle), "booktitle"), F.when(F.coalesce(year, F.lit(0)) < 1900, "year")))


def candidates(responses: DataFrame) -> DataFrame:
    """Search results (payload) as candidates: id, title, authors, year, rank."""
    kind = "struct<results:array<struct<id:string,title:string,publication_year:int,authorships:array<struct<author:struct<display_name:string>>>,locations:array<struct<landing_page_url:string>>>>>"
    rows = responses.select("query", F.posexplode(F.from_json("payload", kind)["results"]).alias("rank", "r"))
    url = F.get(F.filter(F.transform("r.locations", lambda l: l["landing_page_url"]), lambda u: u.isNotNull()), F.lit(0))
    return rows.select("query", F.coalesce(url, "r.id").alias("id"), "r.title", F.transform("r.authorships", lambda a: a["author"]["display_name"]).alias("authors"), F.col("r.publication_year").alias("year"), "rank")


def listing(pages: DataFrame, page_col: str, pattern: str = r'<a[^>]+href="([^"]+)"[^>]*>(.*?)</a>') -> DataFrame:
    """(href, title) of the links of listing pages."""
    both = F.arrays_zip(F.regexp_extract_all(F.col(page_col), F.lit("(?is)" + pattern), F.lit(1)).alias("href"), F.regexp_extract_all(F.col(page_col), F.lit("(?is)" + pattern), F.lit(2)).alias("title"))
    return pages.select(F.explode(both).alias("z")).select("z.href", T.strip_tags("z.title").alias("title"))


@F.pandas_udf(StructType().add("id", "string").add("title", "string").add("authors", ArrayType(StringType())).add("published", "string"))
def _entry(entries: pd.Series) -> pd.DataFrame:
    """What xpath_string gives for id, title and published of an entry, and the text nodes of its authors' names, by one parse."""

    def one(e: str) -> tuple:
        made, parser = ET.TreeBuilder(), expat.ParserCreate()
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = made.start, made.end, made.data
        parser.Parse(e, True)
        root = made.close()
        text = lambda name: "".join(root.find(name).itertext()) if root.find(name) is not None else ""
        nodes = [t for n in root.findall("author/name") for t in (n.text, *(c.tail for c in n)) if t]
        return text("id"), text("title"), nodes, text("published")

    return pd.DataFrame([one(e) for e in entries], columns=["id", "title", "authors", "published"])


def atom(feeds: DataFrame, column: str = "feed", keys: list[str] | None = None) -> DataFrame:
    """Entries of Atom feeds: the feed's keys, id, title, authors, year, rank."""
    plain = F.regexp_replace(F.regexp_replace(F.col(column), r'\sxmlns(:\w+)?="[^"]*"', ""), r"<(/?)\w+:", "<$1")
    keys = keys or []
    rows = feeds.select(*keys, F.posexplode(F.regexp_extract_all(plain, F.lit(r"(?s)(<entry>.*?</entry>)"), F.lit(1))).alias("rank", "e"))
    rows = rows.select(*keys, "rank", _entry("e").alias("p"))
    return rows.select(*keys, T.arxiv_id("p.id").alias("id"), T.spaces("p.title").alias("title"), F.col("p.authors").alias("authors"), T.year("p.published").alias("year"), "rank")


def tei_features(rows: DataFrame, column: str = "tei") -> DataFrame:
    """Adds title, has_abstract, body_text_chars, reference_count, first_author_surname of TEI documents."""
    plain = F.regexp_replace(F.col(column), r'\sxmlns(:\w+)?="[^"]*"', "")
    got = lambda p: T.spaces(F.xpath_string(plain, F.lit(p)))
    return rows.withColumns({
        "title": got("//titleStmt/title"), "has_abstract": got("//abstract") != "", "body_text_chars": F.length(got("//text/body")),
        "reference_count": F.xpath_int(plain, F.lit("count(//listBibl/biblStruct)")), "first_author_surname": F.lower(got("(//sourceDesc//author/persName/surname)[1]")),
    })


def tei_match(features: DataFrame, title: Column, author: Column) -> DataFrame:
    """Adds to tei_features how they fit an entry: title_similarity, bib_first_author_surname, first_author_match (null without both names)."""
    name = T.first_surname(author)
    both = (name != "") & (F.col("first_author_surname") != "")
    out = features.withColumn("title_similarity", S.sequence_ratio(T.normal("title"), T.normal(title))).withColumn("bib_first_author_surname", name)
    return out.withColumn("first_author_match", F.when(both, T.normal("first_author_surname") == name))


def pdf_title(content: Column) -> Column:
    """The title in the first two million bytes of a PDF, if it is plausible: 3 to 40 words, mostly letters."""
    found = T.spaces(F.regexp_extract(F.decode(F.substring(content, 1, 2_000_000), "ISO-8859-1"), r"/Title\s*\(([^)]*)\)", 1))
    letters = F.length(F.regexp_replace(found, "[^A-Za-z]", "")) / F.greatest(F.length(found), F.lit(1))
    return F.when(T.word_count(found).between(3, 40) & (letters >= 0.55), found).otherwise("")


def binary_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """(path, modificationTime, length, content) of files; without content the bytes aren't read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)


def json_object(x: Column, kind: str) -> Column:
    """A JSON object by schema; an empty one where it can't be read."""
    return F.coalesce(F.from_json(x, kind, {"mode": "PERMISSIVE"}), F.from_json(F.lit("{}"), kind))


def csv_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, multiLine=True, escape='"')


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True, escape='"')


def write_jsonl(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)


def exported_log(log: DataFrame) -> DataFrame:
    """Sorted JSON lines of a log, with times in ISO form."""
    return log.withColumn("timestamp", T.iso_timestamp("timestamp")).orderBy("timestamp", "file_path", "entry_key").select(F.to_json(F.struct(*log.columns)).alias("value"))


def imported_log(log: DataFrame, lines: DataFrame) -> DataFrame:
    """The rows of JSON lines that the log doesn't have by file, key and time."""
    new = lines.select(F.from_json("value", log.schema).alias("r")).select("r.*").withColumn("timestamp", T.iso_timestamp("timestamp")).dropDuplicates(["file_path", "entry_key", "timestamp"])
    return new.join(log.withColumn("timestamp", T.iso_timestamp("timestamp")).select("file_path", "entry_key", "timestamp"), ["file_path", "entry_key", "timestamp"], "left_anti")
