import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use themselves, as columns of the input.
CLASHING = ["score", "kept", "rest", "evidence", "n_words", "n_lines", "batch", "doc", "held_out", "lang_pred", "sample", "v", "__m_x", "component_id", "keep_id", "n", "own", "a"]


def sentence(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice("bcdfglmnprst") + r.choice("aeiou") for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Null, blank and very long texts, ties, copies, near copies, repeated rows and a null id."""
    r = random.Random(5)
    base, long = sentence(r, 120), sentence(r, 60000)
    words = base.split()
    near = " ".join(words[:60] + ["other"] + words[61:])
    texts = [base, base, base.upper(), near, None, "", " \n\t", "one two", "ONE two", long, long + " end", "line\nline\n" + sentence(r, 30), sentence(r, 40) + "\nline", "É " + sentence(r, 50), "x" * 5000, "a\x0bb\x0cc\rd e", "🙂 漢字 " + sentence(r, 25)]
    rows = [(k, t, ["en", "fr", None][k % 3], f"s{k % 2}", len(t or "")) for k, t in enumerate(texts)]
    rows += [rows[0], rows[4], (None, "null id text", "en", "s", 12), (3, "the same id with another text", "en", "s", 5)]
    return rows


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(odd_rows, DOCS)
    return df.withColumns({c: F.lit("extra") for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
