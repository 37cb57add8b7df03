"""The phrase join for large dictionaries against looking for every phrase in every row."""

import random
from collections import Counter

from vacancia.operators import joins


def test_a_hundred_thousand_phrases(spark):
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(900)]
    phrases = {" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(110_000)}
    phrases = sorted(phrases)[:100_000] + ["a", "é", "of the", "the"]
    rows = [(i, " ".join(rng.choices(words + ["of", "The"], k=rng.randint(0, 25))), rng.choice([None, "of the", "X"])) for i in range(60)]
    rows += [(60, None, None), (61, "", ""), (61, "", ""), (62, "of THE of the" * 3000, None)]
    df = spark.createDataFrame(rows, "id long, title string, skills string").repartition(3)
    table = spark.createDataFrame(list(enumerate(phrases)) + [(-1, None), (-2, ""), (-3, "the")], "n long, phrase string")
    got = Counter((r.id, r.n) for r in joins.match_phrases(df, table, "phrase", ["title", "skills"]).collect())
    want = Counter()
    for i, title, skills in rows:
        text = f"{title or ''} {skills or ''}".lower()
        want.update((i, n) for n, p in [*enumerate(phrases), (-3, "the")] if p in text)
    assert got == want and len(got) > 3000


def test_equals_the_projection_of_a_small_dictionary(spark):
    dictionary = {"Data": ["data engineer", "sql"], "Web": ["react", "js"]}
    df = spark.createDataFrame([(1, "Senior Data Engineer (SQL)"), (2, "React/JS"), (3, "cook"), (4, None)], "id long, title string")
    table = spark.createDataFrame([(c, p) for c, ps in dictionary.items() for p in ps], "category string, phrase string")
    got = {(r.id, r.phrase) for r in joins.match_phrases(df, table, "phrase", ["title"]).collect()}
    assert got == {(r.id, r.searched_role) for r in joins.match_roles(df, dictionary, ["title"]).collect()}
    assert joins.match_phrases(df, table.limit(0), "phrase", ["title"]).collect() == []
    assert joins.match_phrases(df.limit(0), table, "phrase", ["title"]).collect() == []
