import pytest
from pyspark.sql import functions as F

from vacancia.functions import text as T


def test_clean_basic_strips_unicode_blanks(one):
    assert one(T.clean_basic("x"), x=" \t Data ÉNG  \n") == "data éng"
    assert one(T.clean_basic("x"), x=None) == ""


def test_clean_strict_keeps_the_double_blank_of_a_deleted_sign(one):
    assert one(T.clean_strict("x"), x=" A &  B/C+, #1.é ") == "a  bc+, #1."


@pytest.mark.parametrize("raw, want", [
    ("Acme Pvt Ltd", "acme"), ("Limited Brands Inc", "brands"), ("Incline LLP", "incline"),
    ("Foo Private Limited", "foo"), ("ltd", ""), (None, ""),
])
def test_company_norm(one, raw, want):
    assert one(T.company_norm("x"), x=raw) == want


def test_html_text_drops_scripts_and_undoes_entities(one):
    html = "<p>A&amp;B<br/> C &lt;x&gt;</p><script>var t='</p>';</script><!-- no --><style>p{}</style>&nbsp;d"
    assert one(T.html_text("x"), x=html) == "A&B C <x> d"


def test_entities_are_undone_once(one):
    assert one(T.html_text("x"), x="&amp;lt;") == "&lt;"


def test_coerce_text(one):
    assert one(T.coerce_text("x"), x='["a", "b c", 3]') == "a, b c, 3"
    assert one(T.coerce_text("x"), x="  plain ") == "plain"
    assert one(T.coerce_text("x"), x=None) is None


def test_tokens_are_unicode_words_of_two_characters(one):
    assert one(T.tokens("x"), x="Éa über-x C++ a_b 9 10") == ["éa", "über", "a_b", "10"]


def test_bigrams_form_after_stop_words_go(spark):
    df = spark.createDataFrame([("data of the engineer role",), ("solo",), ("",)], "t string")
    words = df.select(T.content_words("t", ["of", "the"]).alias("w"))
    got = [r[0] for r in words.select(T.with_bigrams("w")).collect()]
    assert got == [
        ["data", "engineer", "role", "data engineer", "engineer role"], ["solo"], []]


def test_job_id_treats_null_as_empty(spark):
    import hashlib

    df = spark.createDataFrame([("Éa", None, "X", "s")], "job_title string, company string, location string, source string")
    want = hashlib.md5("éaxs".encode()).hexdigest()
    assert df.select(T.job_id()).first()[0] == want


def test_percent_rounds_half_to_even_and_guards_zero(spark):
    df = spark.createDataFrame([(1, 800), (3, 800), (1, 0)], "a long, b long")
    assert [r[0] for r in df.select(T.percent("a", "b")).collect()] == [0.12, 0.38, None]


def test_score_band_edges(spark):
    df = spark.createDataFrame([(0.0,), (39.9,), (40.0,), (70.0,), (None,)], "v double")
    assert [r[0] for r in df.select(T.score_band("v")).collect()] == [
        "0-40", "0-40", "40-70", "70-100", None]


def test_document_text_prints_null_as_empty(one):
    doc = T.document_text([("Title", F.col("a")), ("Pay", F.col("b"))])
    assert one(doc, a="x", b=None) == "Title: x\nPay: "


def test_strip_takes_what_the_pattern_takes(spark):
    codes = [*range(0x20), *range(0x7F, 0x100), 0x1680, 0x180E, *range(0x2000, 0x2070), 0x3000, 0xFEFF]
    rows = spark.createDataFrame([(f"{chr(c)} a{chr(c)}b {chr(c)}\n",) for c in codes], "x string")
    assert rows.filter(T.strip("x") != F.regexp_replace("x", T.EDGE_SPACE, "")).isEmpty()


def test_text_left_is_told_as_by_the_cleaned_text(spark):
    texts = [None, "", " ", "é", "é é", "ltd", " Pvt  LTD. ", "l&td", "inc-llp", "Incline", "acme ltd", "+", "private", "é inc"]
    rows = spark.createDataFrame([(x,) for x in texts], "x string")
    told = rows.select(T.strict_left("x") == (T.clean_strict("x") != ""), T.company_left("x") == (T.company_norm("x") != ""))
    assert {tuple(r) for r in told.collect()} == {(True, True)}
    # The suffixes are cut where no other letter tells, not in every row.
    plan = rows.select(T.company_left("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert " OR " in plan


def test_visible_text_of_plain_values(one):
    assert one(T.html_text("x"), x=" plain  text ") == "plain text"
    assert one(T.html_text(F.concat("x", F.lit("&amp;<i>b</i>"))), x="a") == "a& b"
    assert one(T.html_text("x"), x=None) is None
