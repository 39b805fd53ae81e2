"""Licence scans by a positional index of rare words. DataFrame functions only."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between words of a text without A-Z.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UNIT = 1000


@dataclass(frozen=True)
class Template:
    """A licence passage: words (lower case, by single spaces), the percentage of their weight that must stand at one relative position, and key
    phrases that must all stand in the same part of the file. A base phrase stands word by word."""

    label: str
    words: str
    least: int = 70
    phrases: tuple[str, ...] = ()
    base: bool = False

    def split(self) -> list[str]:
        return self.words.split(" ")


# The phrases of the contract.
BASE = (
    Template("cc-by", "cc by", 100, ("cc by",), True),
    Template("gpl", "general public license", 100, ("general public license",), True),
    Template("reserved", "all rights reserved", 100, ("all rights reserved",), True),
)
# Well-known notices of licences.
NOTICES = (
    Template("mit", "released under the mit license", 70, ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 70, ("permission is hereby granted", "free of charge")),
    Template("mit", "licensed under the mit license", 70, ("mit license",)),
    Template("apache-2.0", "licensed under the apache license version 2 0", 70, ("apache license", "2 0")),
    Template("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", 70, ("except in compliance with the license",)),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", 70, ("gnu general public license", "version 3")),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", 70, ("gnu general public license", "version 2")),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", 70, ("redistribute it and or modify", "general public license")),
    Template("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", 70, ("redistribute it and or modify", "lesser general public license")),
    Template("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", 70, ("mozilla public license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", 70, ("redistribution and use", "following conditions")),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 70, ("with or without fee",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain", 70, ("public domain",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", 70, ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", 70, ("cc by sa",)),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license", 70, ("creative commons attribution",)),
    Template("cc0", "cc0 1 0 universal public domain dedication", 70, ("cc0",)),
)
TEMPLATES = BASE + NOTICES


def words(text: Column) -> Column:
    """The words `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the whole text with A-Z lower-cased; null has none."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    # lower() touches more than A-Z beyond ASCII
    low = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(low, BETWEEN, -1), "")


def weights(docs: DataFrame, vocabulary: list[str], words_col: str) -> dict[str, int]:
    """The inverse document frequency of each word of the vocabulary over all of docs: ln((documents + 1) / (documents with it + 1)) + 1, in
    units of 1 / UNIT. The driver gets one count a word of the vocabulary, which the templates bound.
    """
    own = F.array_distinct(F.filter(words_col, lambda w: w.isin(vocabulary)))
    counts = docs.select(F.explode(F.array_append(own, "")).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    n = {r["w"]: r["n"] for r in counts.collect()}
    return {w: math.floor(UNIT * (math.log((n.get("", 0) + 1) / (n.get(w, 0) + 1)) + 1)) for w in vocabulary}


def postings(templates: tuple[Template, ...], weight: dict[str, int]) -> list[tuple[str, int, int]]:
    """(word, template, position) of each template's rarest words, as many as any match must hold one of.

    A match may lack less than the weight of these words together, so looking up no others loses no match.
    """
    out = []
    for t, template in enumerate(templates):
        of = [weight[w] for w in template.split()]
        may_lack, held = sum(of) * (100 - template.least), 0
        for p in sorted(range(len(of)), key=lambda p: (-of[p], p)):
            out.append((template.split()[p], t, p))
            held += 100 * of[p]
            if held > may_lack:
                break
    return out


def matches(words_col: str, templates: tuple[Template, ...], weight: dict[str, int], around: int = 5) -> Column:
    """array<struct<label, base, start, share>>: where the words of a row hold a template, in no given order.

    Each word of the row that the index lists gives places (template, start) by its position less that in the template. At each distinct place the
    weight of the template's words that stand right there is summed over the whole template; with `least` percent, and with every key
    phrase between `around` words before and after it, the place is a match. start may be negative where a file begins inside a passage.
    """
    index = postings(templates, weight)
    ws = F.col(words_col)
    entries = F.array(*[F.struct(F.lit(w).alias("w"), F.lit(t).alias("t"), F.lit(p).alias("p")) for w, t, p in index])
    table = F.array(
        *[
            F.struct(
                F.lit(t.label).alias("label"),
                F.lit(t.base).alias("base"),
                F.array(*[F.struct(F.lit(w).alias("w"), F.lit(weight[w]).alias("weight")) for w in t.split()]).alias("words"),
                F.lit(sum(weight[w] for w in t.split())).alias("total"),
                F.lit(t.least).alias("least"),
                F.array(*[F.lit(f" {p} ") for p in t.phrases]).cast("array<string>").alias("phrases"),
            )
            for t in templates
        ]
    )
    looked_up = F.array_compact(F.transform(ws, lambda w, i: F.when(w.isin(sorted({w for w, _, _ in index})), i)))
    places = F.flatten(F.transform(looked_up, lambda i: F.transform(F.filter(entries, lambda e: e["w"] == F.get(ws, i)), lambda e: F.struct(e["t"].alias("t"), (i - e["p"]).alias("at")))))

    def judged(place: Column) -> Column:
        template, at = F.get(table, place["t"]), place["at"]
        right = F.transform(template["words"], lambda x, p: F.when(F.get(ws, at + p) == x["w"], x["weight"]).otherwise(0))
        first = F.greatest(at - around, F.lit(0))
        part = F.concat(F.lit(" "), F.array_join(F.slice(ws, first + 1, at + F.size(template["words"]) + around - first), " "), F.lit(" "))
        return F.struct(template.alias("template"), at.alias("start"), F.aggregate(right, F.lit(0), lambda a, x: a + x).alias("matched"), part.alias("part"))

    enough = lambda m: (100 * m["matched"] >= m["template"]["least"] * m["template"]["total"]) & F.forall(m["template"]["phrases"], lambda p: F.contains(m["part"], p))
    found = F.filter(F.transform(F.array_distinct(places), judged), enough)
    return F.transform(found, lambda m: F.struct(m["template"]["label"].alias("label"), m["template"]["base"].alias("base"), m["start"].cast("long").alias("start"), (m["matched"] / m["template"]["total"]).alias("share")))


def scan(docs: DataFrame, text_col: str = "text", templates: tuple[Template, ...] = TEMPLATES, around: int = 5) -> DataFrame:
    """All columns of docs, with n_words and matches (see matches).

    Texts are whole; null and empty ones have no words and no match. Rows are independent of one another but for the weights, which count
    every row of docs, repeated ones too; an empty table gives none. Columns of docs with the names of added ones are replaced.

    docs is read twice: once for the document frequencies of the templates' words, and once to match. Nothing is shuffled but one count a
    word and task. Templates are a bounded table that the caller gives; words and phrases must be in lower case.
    """
    vocabulary = sorted({w for t in templates for w in t.split()})
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), words(F.col(text_col)).alias("words"))
    weight = weights(held, vocabulary, "words")
    rest = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("n_words", "matches")]
    return held.select(*rest, F.size("words").cast("long").alias("n_words"), matches("words", templates, weight, around).alias("matches"))


def report(matches_col: str = "matches") -> dict[str, Column]:
    """n_base, first_word, last_word, base_labels, labels and score (the greatest share, 0 without a match) of scanned rows."""
    all_ = F.col(matches_col)
    base = F.filter(all_, lambda m: m["base"])
    listed = lambda ms: F.array_join(F.array_sort(F.array_distinct(F.transform(ms, lambda m: m["label"]))), ",")
    starts = F.transform(base, lambda m: m["start"])
    score = F.coalesce(F.array_max(F.transform(all_, lambda m: m["share"])), F.lit(0.0))
    return {"n_base": F.size(base).cast("long"), "first_word": F.array_min(starts), "last_word": F.array_max(starts), "base_labels": listed(base), "labels": listed(all_), "score": score}


def oracle_sql(templates: tuple[Template, ...] = TEMPLATES, around: int = 5) -> str:
    """The rows of report() for `documents`, by summing the weights at every relative position of any word of a template."""
    quoted = lambda x: "'" + x + "'"
    rows = ", ".join(f"({k}, {quoted(t.label)}, {str(t.base).lower()}, {t.least}, string_split({quoted(t.words)}, ' '), [{', '.join(map(quoted, t.phrases))}]::VARCHAR[])" for k, t in enumerate(templates))
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
        tp AS (SELECT * FROM (VALUES {rows}) v(t, label, base, least, tws, phrases)),
        tw AS (SELECT t, unnest(tws) AS w, unnest(range(len(tws))) AS p FROM tp),
        w AS (SELECT r, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM d),
        df AS (SELECT w, count(DISTINCT r) AS n FROM w SEMI JOIN tw USING (w) GROUP BY w),
        idf AS (SELECT w, floor({UNIT} * (ln(((SELECT count(*) FROM d) + 1) / (coalesce(n, 0) + 1)) + 1))::BIGINT AS idf FROM (SELECT DISTINCT w FROM tw) LEFT JOIN df USING (w)),
        total AS (SELECT t, sum(idf)::BIGINT AS total FROM tw JOIN idf USING (w) GROUP BY t),
        m AS (SELECT r, t, i - p AS place, sum(idf)::BIGINT AS matched FROM w JOIN tw USING (w) JOIN idf USING (w) GROUP BY r, t, i - p),
        ok AS (SELECT r, label, base, place, matched / total AS share FROM m JOIN tp USING (t) JOIN total USING (t) JOIN d USING (r) WHERE 100 * matched >= least * total
               AND len(list_filter(phrases, lambda x: NOT contains(' ' || array_to_string(ws[greatest(place - {around}, 0) + 1 : place + len(tws) + {around}], ' ') || ' ', ' ' || x || ' '))) = 0),
        f AS (SELECT r, count(*) FILTER (base) AS n_base, min(place) FILTER (base) AS first_word, max(place) FILTER (base) AS last_word, array_to_string(list_sort(list_distinct(list(label) FILTER (base))), ',') AS base_labels,
              array_to_string(list_sort(list_distinct(list(label))), ',') AS labels, max(share) AS score FROM ok GROUP BY r)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
        FROM d LEFT JOIN f USING (r)"""
