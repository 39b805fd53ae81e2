"""The normal form of whole texts, folded once a row."""

import random

from marginalia.functions import text as T
from marginalia.operators import keys


def test_whole_texts_have_the_same_normal_form(spark):
    r = random.Random(5)
    letters = "abz09 {}ÀéÉßẞñÇïİKÅøΣ\n\t\x00-_.,😀  "
    texts = [None, "", " ", "{}", "é{É} ß"] + ["".join(r.choice(letters) for _ in range(r.randint(1, 60))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    want = {x.i: x.n for x in rows.select("i", T.normal("t").alias("n")).collect()}
    got = {x.i: x.n for x in T.with_normal(rows, "t", "n").collect()}
    assert got == want


def test_bases_of_keys_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    rows = spark.createDataFrame([(k, None if k % 9 == 0 else f"b{k % 4}") for k in range(90)], "i long, base string").mapInArrow(count, "i long, base string")
    got = keys.suffixed(rows, "base", ["i"]).collect()
    assert len(got) == 90 and len({r.key for r in got if r.key}) == 80 and made.value == 90
