import pytest

from vacancia import dictionaries as D
from vacancia.functions import enrich as E


def test_substring_skills_overmatch_and_sort(one):
    assert one(E.skills_substring("x"), x="Digital MySQL") == ["git", "mysql", "sql"]
    assert one(E.skills_substring("x"), x=None) == []


def test_word_skills_respect_boundaries(one):
    assert one(E.skills_word("x"), x="digital MySQL, Scikit-Learn; power bi.") == [
        "mysql", "power bi", "scikit-learn"]
    assert one(E.skills_word("x"), x="ésql sqlé sql_") == []


@pytest.mark.parametrize("title, role", [
    ("Storage Admin", "GenAI Engineer"), ("ETL Lead", "Data Engineer"),
    ("Tableau Developer", "Data Analyst / BI"), ("Java Developer", "Software / Backend"),
    ("Chef", "Other"), (None, "Other"),
])
def test_role_v3_first_rule_wins(one, title, role):
    assert one(E.role_v3("x"), x=title) == role


def test_role_v2(one):
    assert one(E.role_v2("x"), x="Business Analyst - Spark") == "data analyst"


@pytest.mark.parametrize("text, v2, v3, years", [
    ("0-2 Yrs", "fresher", "Fresher", 0), ("2 years", "0-2 years", "0-2 Years", 2),
    ("up to 5", "3-5 years", "3-5 Years", 5), ("8+", "6-10 years", "6-8 Years", 8),
    ("10 - 12", "6-10 years", "9+ Years", 10), ("11", "10+ years", "9+ Years", 11),
    ("not stated", "not specified", "Not Mentioned", None), (None, "not specified", "Not Mentioned", None),
    ("9" * 30, "10+ years", "9+ Years", None),
])
def test_experience(one, text, v2, v3, years):
    assert one(E.exp_bucket("x", D.EXPERIENCE_V2), x=text) == v2
    assert one(E.exp_bucket("x"), x=text) == v3
    assert one(E.exp_min("x"), x=text) == years


@pytest.mark.parametrize("text, want", [
    ("3-6.5 Lacs PA", (300000.0, 650000.0, 475000.0)), ("12 LPA", (1200000.0, 1200000.0, 1200000.0)),
    ("5,00,000", (5.0, 0.0, 2.5)), ("Salary Not Disclosed 5", (None, None, None)),
    ("na", (None, None, None)), ("", (None, None, None)), (None, (None, None, None)),
    ("negotiable", (None, None, None)), ("45000", (45000.0, 45000.0, 45000.0)),
])
def test_salary(one, text, want):
    assert tuple(one(E.salary("x"), x=text)) == want


def test_salary_can_keep_thousands_together(one):
    assert tuple(one(E.salary("x", strip_thousands=True), x="5,00,000 - 6,00,000")) == (
        500000.0, 600000.0, 550000.0)


def test_skills_split_drops_single_characters(one):
    assert one(E.skills_split("x"), x="SQL / R| Power BI ;x, ") == ["sql", "power bi"]


@pytest.mark.parametrize("raw, want", [
    ("['Python', 'Power BI']", ["python", "power bi"]), ('["a, b", \'c\']', ["a, b", "c"]),
    ("Python, SQL,,", ["python", "sql"]), ("Python", ["python"]), ("  ", []), (None, []), ("[]", []),
])
def test_skills_parse(one, raw, want):
    assert one(E.skills_parse("x"), x=raw) == want


def test_skills_parse_loose(one):
    assert one(E.skills_parse_loose("x"), x="['A b', \"c\"]|d; ") == ["a b", "c", "d"]
    assert one(E.skills_parse_loose("x", ","), x="a|b, c") == ["a|b", "c"]


def test_phrase_hits_allow_any_blank_between_words(one):
    assert one(E.phrase_hits("x", ["power bi", "sql"]), x="Power \t BI, nosql") == ["power bi"]


def test_raw_tokens(one):
    assert one(E.raw_tokens("x"), x=" Python,sql | power\nbi ") == ["python", "sql", "power", "bi"]


def test_has_skill_modes(spark):
    df = spark.createDataFrame([("sql", ["mysql"], "MySQL")], "s string, o array<string>, t string")
    got = [df.select(E.has_skill("s", "o", "t", m)).first()[0] for m in ("exact", "substring", "either")]
    assert got == [False, True, True]
