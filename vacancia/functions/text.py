"""Text expressions. All of them stay inside whole-stage code generation."""

from __future__ import annotations

import re
import string
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from vacancia.dictionaries import COMPANY_SUFFIXES

# Blank characters as the usual Unicode-aware strip() sees them; plain \s is ASCII here.
SPACE = r"[\s\x0b\x1c-\x1f\x85\p{Z}]"
EDGE_SPACE = f"^{SPACE}+|{SPACE}+$"
# The same characters one by one, for trimming without a pattern.
BLANKS = "".join(map(chr, [
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
# Spelled-out classes test one bit per character; a class mixing ranges and single
# characters was measured 25 times slower.
PLAIN = string.ascii_letters + string.digits
NOT_WORD = r"[^\p{L}\p{N}_]"
_NOT_STRICT = f"[^{string.ascii_lowercase}{string.digits},+.# ]"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank(c) -> Column:
    """NULL as empty text."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c) -> Column:
    return F.btrim(col(c), F.lit(BLANKS))


def squeeze(c) -> Column:
    return F.regexp_replace(col(c), f"{SPACE}+", " ")


def escape(term: str) -> str:
    """Escape a dictionary term for both Java and RE2 regular expressions."""
    return re.sub(r"([\\.^$|?*+()\[\]{}-])", r"\\\1", term)


def whole_word(term: str) -> str:
    """Pattern for a term not touching another letter, digit or underscore."""
    return f"(^|{NOT_WORD}){escape(term)}($|{NOT_WORD})"


def clean_basic(c) -> Column:
    return strip(F.lower(blank(c)))


def clean_strict(c) -> Column:
    """Lower, strip, squeeze blanks, then drop everything outside ``a-z0-9,+.# ``."""
    return F.regexp_replace(squeeze(clean_basic(c)), _NOT_STRICT, "")


def company_norm(c, suffixes=COMPANY_SUFFIXES) -> Column:
    pattern = "|".join(rf"\b{s}\b" for s in suffixes)

    def without(t: Column) -> Column:
        found = reduce(or_, [t.contains(s) for s in suffixes], F.lit(False))
        return F.when(found, F.regexp_replace(t, pattern, "")).otherwise(t)

    return strip(squeeze(once(clean_strict(c), without)))


def strict_left(c) -> Column:
    """``clean_strict(c) != ""``, mostly told by the first character: a blank between others stays too."""
    return clean_basic(c).rlike(rf"[{string.ascii_lowercase}{string.digits},+.#]|{SPACE}")


def company_left(c, suffixes=COMPANY_SUFFIXES) -> Column:
    """``company_norm(c) != ""``: a kept character that no suffix has tells without cutting suffixes."""
    sure = "".join(x for x in f"{string.ascii_lowercase}{string.digits},+.#" if x not in "".join(suffixes))
    return F.lower(blank(c)).rlike(f"[{escape(sure)}]") | (company_norm(c, suffixes) != "")


def joined(*cols, sep: str = " ") -> Column:
    return F.concat_ws(sep, *[blank(c) for c in cols])


def combined_text(title="job_title", skills="skills", description="description", clean=True):
    prepare = clean_basic if clean else blank
    return F.concat_ws(" ", *[prepare(c) for c in (title, skills, description)])


def recommendation_text(
    fields=("job_title", "role_category", "skills", "description", "location", "experience"),
) -> Column:
    text = F.lower(joined(*fields))
    text = F.regexp_replace(text, rf"[^{PLAIN}+#.\s]", " ")
    return F.regexp_replace(text, r"\s+", " ")


def dedup_key(title, company, location) -> Column:
    return F.concat_ws("|", clean_strict(title), company_norm(company), clean_strict(location))


def job_id(title="job_title", company="company", location="location", source="source"):
    """md5 of the four lower-cased fields, no separator; NULL counts as empty text."""
    return F.md5(F.lower(F.concat(*[blank(c) for c in (title, company, location, source)])))


def coerce_text(c) -> Column:
    """A JSON array as ``a, b`` text, anything else as trimmed text.

    The column holds the raw JSON fragment of a list-or-string field.
    """
    c = col(c)
    items = F.from_json(c, "array<string>")
    return F.when(c.startswith("["), F.array_join(items, ", ")).otherwise(strip(c))


# Entities in the order they are undone; the ampersand goes last.
_ENTITIES = [
    ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
    ("&#39;", "'"), ("&amp;", "&"),
]


def visible(t: Column) -> Column:
    """``html_text`` of a column or lambda variable: the value is read several times."""
    text = t
    for pattern in (r"(?s)<!--.*?-->", r"(?is)<script.*?</script>", r"(?is)<style.*?</style>",
                    r"(?is)<template.*?</template>", r"<[^>]*>"):
        text = F.regexp_replace(text, pattern, " ")
    for entity, char in _ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    marked = t.contains("<") | t.contains("&")
    return strip(squeeze(F.when(marked, text).otherwise(t)))


def html_text(c) -> Column:
    """Visible text of an HTML fragment: comments, scripts and tags go, blanks collapse."""
    return visible(F.col(c)) if isinstance(c, str) else once(c, visible)


def document_text(parts) -> Column:
    """Labelled lines ``Label: value``; ``parts`` is a list of (label, column)."""
    return F.concat_ws(
        "\n", *[F.concat(F.lit(f"{label}: "), blank(c)) for label, c in parts]
    )


def rounded(c, places: int = 2) -> Column:
    """Round half to even on the scaled double, the rule of numeric arrays in Python."""
    scale = float(10**places)
    return F.rint(col(c) * scale) / scale


def percent(part, whole, places: int = 2) -> Column:
    return rounded(col(part) / F.nullif(col(whole), F.lit(0)) * 100, places)


def to_number(c) -> Column:
    return col(c).try_cast("double")


def score_band(c, bands=None, top=None) -> Column:
    from vacancia.dictionaries import SCORE_BAND_TOP, SCORE_BANDS

    out = None
    for bound, label in bands or SCORE_BANDS:
        test = col(c) < bound
        out = F.when(test, label) if out is None else out.when(test, label)
    return F.when(col(c).isNotNull(), out.otherwise(top or SCORE_BAND_TOP))


def tokens(c) -> Column:
    """Lower-cased word tokens of at least two characters."""
    words = F.split(F.lower(blank(c)), f"{NOT_WORD}+")
    return F.filter(words, lambda w: F.length(w) > 1)


def content_words(c, stop_words=()) -> Column:
    """Tokens without the stop words."""
    words = F.split(F.lower(blank(c)), f"{NOT_WORD}+")
    stops = sorted(stop_words)
    if not stops:
        return tokens(c)
    return F.filter(words, lambda w: (F.length(w) > 1) & ~w.isin(stops))


def with_bigrams(words) -> Column:
    """The words followed by every pair of neighbours, as "a b"."""
    words = col(words)
    heads = F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0)))
    pairs = F.transform(heads, lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1)))
    return F.concat(words, pairs)


def run_starts(ordered) -> Column:
    """Positions in a sorted array where a new value begins.

    ``ordered`` must be a stored column: the lambda reads it once per element.
    """
    ordered = col(ordered)
    at = F.when(F.size(ordered) > 0, F.sequence(F.lit(0), F.size(ordered) - 1))
    return F.filter(
        at, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
    )


def run_lengths(ordered, starts) -> Column:
    """Array of (term, tf) from a sorted array and its run starts."""
    ordered, starts = col(ordered), col(starts)
    return F.transform(starts, lambda i, k: F.struct(
        F.get(ordered, i).alias("term"),
        (F.coalesce(F.get(starts, k + 1), F.size(ordered)) - i).cast("bigint").alias("tf"),
    ))
