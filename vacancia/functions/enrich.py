"""Derived posting attributes: skills, role, experience and salary."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vacancia import dictionaries as D
from vacancia.functions.text import (
    NOT_WORD, SPACE, blank, clean_basic, col, escape, once, strip, whole_word,
)


def contains_any(c: Column, words) -> Column:
    test = F.lit(False)
    for w in words:
        test = test | c.contains(w)
    return test


def _lowered(c) -> Column:
    """Enough for substring and whole-word tests, which edge blanks cannot change."""
    return F.lower(blank(c))


_SEPARATOR = "\u0001"


def _listed(hits) -> Column:
    """Array of the values whose test holds; ``hits`` is a list of (test, value).

    Joined text cut again, not a filtered array: a lambda would leave generated code
    and evaluate the tested text once per value.
    """
    joined = F.concat_ws(_SEPARATOR, *[F.when(test, F.lit(value)) for test, value in hits])
    found = F.split(F.nullif(joined, F.lit("")), _SEPARATOR)
    return F.coalesce(found, F.array().cast("array<string>"))


def skills_substring(text, dictionary=D.SKILLS_SUBSTRING) -> Column:
    """Sorted dictionary terms found anywhere in the text ("git" hits "digital")."""
    t = _lowered(text)
    return _listed([(t.contains(k), k) for k in sorted(set(dictionary))])


def skills_word(text, dictionary=D.SKILLS_WORD) -> Column:
    """Sorted dictionary terms found as whole words.

    The cheap substring test runs first, so most regexes are never evaluated;
    each pattern is a literal and compiles once per task.
    """
    t = _lowered(text)
    return _listed(
        [(t.contains(k) & t.rlike(whole_word(k)), k) for k in sorted(set(dictionary))]
    )


def phrase_hits(text, dictionary) -> Column:
    """Terms found as whole phrases, any run of blanks between their words."""
    t = _lowered(text)
    hits = []
    for k in sorted({d.lower().strip() for d in dictionary} - {""}):
        body = f"{SPACE}+".join(escape(w) for w in k.split(" "))
        hits.append((t.rlike(f"(^|{NOT_WORD}){body}($|{NOT_WORD})"), k))
    return _listed(hits)


def raw_tokens(text) -> Column:
    """Pieces of a profile text between commas, bars and blanks."""
    parts = F.split(F.lower(col(text)), f"(?:,|\\||{SPACE})+")
    return F.filter(parts, lambda p: p != "")


def skills_split(c) -> Column:
    """Raw skill text cut at ``, / | ;`` with one-character pieces dropped."""
    parts = F.transform(F.split(F.lower(col(c)), "[,/|;]"), strip)
    return F.filter(parts, lambda p: F.length(p) > 1)


def skills_parse(c) -> Column:
    """List literal, comma text or a single value as a lower-cased list."""
    value = strip(col(c))
    inner = F.regexp_replace(value, r"^\[|\]$", "")
    literal = F.regexp_extract_all(inner, F.lit("""('[^']*'|"[^"]*"|[^,'"]+)"""), 1)
    literal = F.transform(literal, lambda x: strip(F.regexp_replace(strip(x), "^['\"]|['\"]$", "")))
    parts = F.transform(F.split(value, ","), strip)
    is_list = value.startswith("[") & value.endswith("]")
    out = F.when(is_list, literal).when(value.contains(","), parts).otherwise(F.array(value))
    out = F.transform(F.filter(out, lambda x: x != ""), F.lower)
    return F.when(col(c).isNull(), F.array().cast("array<string>")).otherwise(out)


def skills_parse_loose(c, delimiters: str = ",|;") -> Column:
    """Lower, delete brackets and quotes, cut at the delimiters, drop blanks."""
    value = F.translate(F.lower(F.coalesce(col(c), F.lit(""))), "[]'\"", "")
    parts = F.transform(F.split(value, f"[{delimiters}]"), strip)
    return F.filter(parts, lambda p: p != "")


def has_skill(skill, owned=None, text=None, mode: str = "either") -> Column:
    """Does a profile have ``skill``: ``exact`` list, ``substring`` of text, or ``either``."""
    skill = col(skill)
    exact = F.array_contains(col(owned), skill) if owned is not None else F.lit(False)
    inside = F.contains(F.lower(col(text)), skill) if text is not None else F.lit(False)
    return {"exact": exact, "substring": inside, "either": exact | inside}[mode]


def role(title, rules, default: str) -> Column:
    """First rule whose keyword is a substring of the cleaned title."""
    t = _lowered(title)
    out = None
    for name, words in rules.items():
        test = contains_any(t, words)
        out = F.when(test, name) if out is None else out.when(test, name)
    return out.otherwise(default)


def role_v2(title, rules=D.ROLES_V2, default=D.ROLE_DEFAULT_V2) -> Column:
    return role(title, rules, default)


def role_v3(title, rules=D.ROLES_V3, default=D.ROLE_DEFAULT_V3) -> Column:
    return role(title, rules, default)


def _first_integer(c) -> Column:
    return F.regexp_extract(blank(c), "([0-9]+)", 1)


def exp_min(c) -> Column:
    """First integer in the text; NULL when there is none (or it exceeds 64 bits)."""
    return _first_integer(c).try_cast("bigint")


def exp_bucket(c, labels=D.EXPERIENCE_V3) -> Column:
    """Bucket of the minimum years: the number of bounds below them picks the label."""
    # A double keeps absurdly long digit runs in the open-ended bucket.
    years = _first_integer(c).try_cast("double")
    position = (years > 0).cast("int")
    for bound, _ in labels["bounds"]:
        position = position + (years > bound).cast("int")
    names = [
        labels["missing"], labels["zero"], *[name for _, name in labels["bounds"]], labels["above"],
    ]
    return F.element_at(
        F.array(*[F.lit(n) for n in names]), F.coalesce(position + 2, F.lit(1))
    )


def salary(c, strip_thousands: bool = False) -> Column:
    """Struct (salary_min, salary_max, salary_avg) from free text.

    The first two numbers are the range, one number is both ends, lakh units
    scale by 100,000. Thousands commas cut a number in two unless
    ``strip_thousands`` is set.
    """

    def numbers(text: Column) -> Column:
        hidden = text.isin(D.SALARY_EXACT_BLANK) | contains_any(text, D.SALARY_HIDDEN)
        scale = F.when(contains_any(text, D.SALARY_LAKH_WORDS), D.LAKH).otherwise(1.0)
        found = F.regexp_extract_all(text, F.lit(r"([0-9]+(?:\.[0-9]+)?)"), 1)
        return F.when(~hidden, once(scale, lambda s: F.transform(F.slice(found, 1, 2), lambda n: n.cast("double") * s)))

    def ends(pair: Column) -> Column:
        low = F.get(pair, F.lit(0))
        high = F.coalesce(F.get(pair, F.lit(1)), low)
        return F.struct(
            low.alias("salary_min"), high.alias("salary_max"), ((low + high) / 2).alias("salary_avg"))

    text = clean_basic(c)
    if strip_thousands:
        text = F.regexp_replace(text, "([0-9]),(?=[0-9])", "$1")
    # Each step once a row: as plain expressions every end of the range would hold all of them, many times over.
    return once(once(text, numbers), ends)


def matched_terms(text, dictionary) -> Column:
    """Positions (as text) of the dictionary terms contained in the text.

    Categories are numbered through, so a position names one term; ``term_at`` gives
    it back. The dictionary is configuration: the theta join is a projection.
    """
    t = F.lower(col(text))
    words = [w for group in dictionary.values() for w in group]
    return _listed([(t.contains(w.lower()), str(i)) for i, w in enumerate(words)])


def term_at(position, dictionary) -> Column:
    """Struct (category, searched_role, role_position) of a matched position."""
    at = col(position).cast("int")
    pairs = [(c, w) for c, group in dictionary.items() for w in group]
    return F.struct(
        F.element_at(F.array(*[F.lit(c) for c, _ in pairs]), at + 1).alias("category"),
        F.element_at(F.array(*[F.lit(w) for _, w in pairs]), at + 1).alias("searched_role"),
        at.alias("role_position"),
    )
