from pyspark.sql import functions as F

from marginalia.functions import similarity as S
from marginalia.functions import text as T


def values(spark, *columns, **given):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in given.items()] or [F.lit(1).alias("x")])
    return list(row.select(*[c.alias(f"c{k}") for k, c in enumerate(columns)]).first())


def test_normal_forms(spark):
    a, b, c, d = values(spark, T.normal("x"), T.normal("x", trim_first=True), T.normal("y", latex=True), T.compact("x"), x=" {D}eep Élan? ", y=r"The \emph{big \textbf{one}} \& more")
    assert (a, b, c, d) == ("deep elan", "deep elan ", "the big one more", "deepelan")


def test_exact_normal_form(spark):
    assert values(spark, T.unescape_fold(F.col("x")), x=r"A &amp; \emph{\textbf{ﬁne}} {B}")[0] == "a fine b"


def test_braces(spark):
    assert values(spark, T.balanced_braces(F.col("x")), x=r"a } {b} { \{ c")[0] == r"a  {b}  \{ c"


def test_words(spark):
    assert values(spark, T.word_count("x"), T.word_count("y"), x=" a  b\nc ", y="  ") == [3, 0]


def test_names(spark):
    got = values(spark, T.surname("x"), T.first_surname("y"), T.author_signature("y"), T.author_signature("z", lettered=True), T.first_surname("w"), x="van Dyk, Anna", y="Ada Lovelace and Bob {\\'E}toile", z="Wei Li 0001 and Ann Bo", w="others")
    assert got == ["dyk", "lovelace", "lovelace etoile", "li bo", ""]


def test_placeholder_authors(spark):
    assert values(spark, *(T.placeholder_author(F.lit(x)) for x in ("A and others", "A et al.", "Ann Other")))[:3] == [True, True, False]


def test_keys(spark):
    got = values(spark, T.synthesised_key("a", "y", "t"), T.suggested_keys("a", "y", "t"), T.synthesised_key(F.lit(""), F.lit(""), F.lit("")), T.canonical_key(F.lit("smith2020deep")), T.canonical_key(F.lit("Smith2020")), T.key_year(F.lit("x9999a2020b"), 2030), a="Smith, Ann and Bo Li", y="May 2020", t="A Study of the Deep Method and Deep Nets")
    assert got == ["smith2020study", ["smith2020deep", "smith2020nets", "smith2020a"], "paper0000paper", True, False, 2020]


def test_urls(spark):
    got = values(
        spark, T.url_fingerprint(F.lit(" HTTPS://Ex.org/A/ ")), T.query_fingerprint(F.lit("http://ex.org/a/?b=2&utm_x=1&a=1&c=#f")), T.canonical_url(F.lit("//Ex.Org/A#x")), T.host(F.lit("https://u@Ex.org:80/x")),
        T.host_in(F.lit("a.ex.org"), ["ex.org"]), T.host_in(F.lit("bex.org"), ["ex.org"]), T.pdf_like(F.lit("http://x/pdf?id=1")), T.pdf_like(F.lit("http://x/a.html")), T.same_host(F.lit("http://A/x"), F.lit("https://a/y")),
    )
    assert got == ["ex.org/a", "ex.org/a?a=1&b=2", "https://ex.org/A", "ex.org", True, False, True, False, True]


def test_identifiers(spark):
    got = values(spark, T.doi(F.lit("https://doi.org/10.1000/AbC.1")), T.arxiv_id(F.lit(""), F.lit("https://arxiv.org/abs/2101.00001v2")), T.forum_id(F.lit("https://x.net/forum?id=Ab_1&n=2")), T.attachment_path(F.lit(":a/b.pdf:pdf;:c:pdf")), T.attachment_paths(F.lit(":a:pdf;b")), T.document_path(F.lit("Article"), F.lit("k"), True))
    assert got == ["10.1000/abc.1", "2101.00001", "Ab_1", "a/b.pdf", ["a", "b"], "article/k/k.pdf"]


def test_years_and_dates(spark):
    got = values(spark, T.year(F.lit("c. 1999-2003")), T.year(F.lit("none")), T.sort_year(F.lit("2023-2024")), T.sort_year(F.lit("x")), T.iso_timestamp(F.lit("2024-01-02 03:04:05")), T.month_name(F.lit("2024-03-01")), T.backoff(F.lit(3)), T.retry_after(F.lit("12"), F.current_timestamp()))
    assert got == [1999, None, 2023, 0, "2024-01-02T03:04:05", "mar", 16.0, 12]


def test_cleaning(spark):
    assert values(spark, T.without_controls(F.lit("a\x01 b\\n \n c")), T.strip_tags(F.lit("<b>a</b>&amp;<i>b</i>")), T.slug(F.lit("Ünï code!")), T.meta_value(F.lit('<meta name="t" content="v">'), "t")) == ["a b c", "a & b", "uni-code", "v"]


def test_scores(spark):
    import difflib

    got = values(spark, S.sequence_ratio(F.lit("deep nets"), F.lit("deep net")), S.jaccard(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"))), S.year_score(F.lit(2000), F.lit(2002)), S.author_score(F.lit("x"), F.array(F.lit("y"))), S.confidence(F.lit(1.0), F.lit(1.0), F.lit(1.0), 0.03))
    assert got == [difflib.SequenceMatcher(None, "deep nets", "deep net").ratio(), 0.5, 0.6, 0.0, 1.0]
