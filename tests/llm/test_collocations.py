"""Collocations against counting every phrase where it stands."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vacancia.llm import collocations


def by_definition(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = lang if lang is not None else "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\n-\r]", lowered):
            words = [w for w in re.split(r"[ \t]+", piece) if w]
            totals[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    counts[lang][tuple(words[i:i + m])] += 1
    out = []
    for lang, f in counts.items():
        found = {g: a for g, a in f.items() if len(g) > 1 and a >= least}
        ranked = []
        for g, a in found.items():
            inside = any(len(o) > len(g) and b >= a and any(o[i:i + len(g)] == g for i in range(len(o)))
                         for o, b in found.items())
            if not inside:
                score, k = min((1000 * a * totals[lang] // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g)))
                ranked.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mined(df, **settings):
    return sorted(tuple(r) for r in collocations.mine(df, **settings).collect())


@pytest.mark.parametrize("slot_bits", [4, 22])
def test_equals_definition(spark, monkeypatch, slot_bits):
    """With 16 slots hardly a pair is recognised as rare: the weights stay the same."""
    rng = random.Random(slot_bits)
    vocabulary = ["a", "B", "of", "The", "é", "漢字", "x" * 90, "|"] + [f"w{i}" for i in range(30)]
    rows = []
    for _ in range(300):
        words = [w for _ in range(rng.randrange(12)) for w in (
            rng.choices(["new york city hall", "in the", rng.choice(vocabulary)], [1, 2, 6]))]
        rows.append(("".join(w + rng.choice([" ", " ", "  ", "\t", ". ", "\n", "\r", ","]) for w in words),
                     rng.choice(["en", "de", None, "und"])))
    monkeypatch.setattr(collocations, "_HELD", 500)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    got = mined(df, least=4, top=25, slot_bits=slot_bits)
    assert len(got) > 20 and got == by_definition(rows, 4, 25)


def test_rare_triples_of_frequent_pairs_have_no_rows(spark):
    """All 64 pairs are frequent, no triple is: a row per pair, not one per place."""
    rng = random.Random(5)
    rows = [(" ".join(rng.choices("abcdefgh", k=12)), "en") for _ in range(300)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    found = collocations.edges(df, 30, 22).collect()
    assert len(found) == 64 and sum(r.n for r in found) == 300 * 11
    assert mined(df, least=30, slot_bits=22) == by_definition(rows, 30, 2000)


def test_ties_at_the_end_of_a_language(spark):
    rows = [(f"p{i} q{i}", "en") for i in range(30) for _ in range(2)]
    got = mined(spark.createDataFrame(rows, "text string, lang string"), least=2, top=7, slot_bits=12)
    assert got == by_definition(rows, 2, 7) and len(got) == 7


def test_odd(spark, odd):
    rows = [(r.text, r.lang) for r in odd.collect()]
    assert mined(odd, least=2, slot_bits=16) == by_definition(rows, 2, 2000)
    assert mined(odd.limit(0), slot_bits=10) == []


def test_scores_past_64_bits(spark):
    rows = [(10 ** 15, 10 ** 16, 10 ** 15 + 7, 10 ** 15 + 9), (100, 10 ** 16, 100, 101), (7, 21, 8, 8)]
    df = spark.createDataFrame(rows, "a long, n long, l long, r long")
    got = df.select(collocations.cut_score(*map(F.col, "anlr")).cast("long")).collect()
    assert [r[0] for r in got] == [1000 * a * n // (x * y) for a, n, x, y in rows]
