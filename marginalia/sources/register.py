"""The parser and the exact text functions under names, for SQL."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from marginalia.functions import similarity, text
from marginalia.sources import bibfile


class ParseCitations:
    """Blocks of a citation text: SELECT * FROM parse_citations(text), also as LATERAL."""

    def eval(self, content: str) -> Iterator[tuple]:
        for k, b in enumerate(bibfile.parse(content or "")):
            yield k, b["block_type"], b.get("entry_type"), b.get("entry_key"), b.get("fields"), b.get("raw"), b.get("error")


BLOCK = "block_idx int, block_type string, entry_type string, entry_key string, fields map<string,string>, raw string, error string"


def register(spark: SparkSession) -> None:
    """parse_citations (table function), exact_normal_form, balanced_braces, sequence_ratio."""
    spark.udtf.register("parse_citations", udtf(ParseCitations, returnType=BLOCK))
    spark.udf.register("exact_normal_form", text.unescape_fold)
    spark.udf.register("balanced_braces", text.balanced_braces)
    spark.udf.register("sequence_ratio", similarity.sequence_ratio)
