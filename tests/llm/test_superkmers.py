"""Substring dedup against a dictionary of all windows."""

import random

import pytest

from vacancia.llm import superkmers


def brute(rows, k=13):
    """Kept words of (doc_id, text) rows; equal rows are one document."""
    least = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        if d is not None:
            for i in range(len(w) - k + 1):
                key = tuple(w[i:i + k])
                least[key] = min(least.get(key, d), d)
    out = []
    for d, w in split:
        gone = set()
        if d is not None:
            for i in range(len(w) - k + 1):
                if least[tuple(w[i:i + k])] < d:
                    gone.update(range(i, i + k))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), b" ".join(kept).decode()))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[3]))


def corpus(seed, n, vocabulary):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["é", "漢字", "a\tb", "x\ny", "  z"]
    passages = [" ".join(rng.choices(words, k=rng.randint(10, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        kind = rng.random()
        if rows and kind < 0.2:
            rows.append((i, rng.choice(rows)[1]))
        elif rows and kind < 0.4:
            w = (rng.choice(rows)[1] or "").split(" ")
            w[rng.randrange(len(w))] = "edit"
            rows.append((i, " ".join(w)))
        else:
            rows.append((i, " ".join(rng.choices(words, k=rng.randint(0, 60)) + [rng.choice(passages)]
                                     + rng.choices(words, k=rng.randint(0, 30)))))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,vocabulary", [(1, 3), (2, 40), (3, 4000)])
def test_equals_all_windows(spark, monkeypatch, seed, vocabulary):
    monkeypatch.setattr(superkmers, "_FLUSH", 2000)
    rows = corpus(seed, 300, vocabulary)
    rows += [(5, "other text of an id that repeats " * 4), rows[0], (None, rows[3][1]), (9999, None), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [tuple(r) for r in superkmers.dedup(df).collect()]
    assert order(got) == order(brute(rows))


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = [tuple(r) for r in superkmers.dedup(odd).collect()]
    assert order(got) == order(brute(rows))
    assert superkmers.dedup(odd.limit(0)).collect() == []


def test_common_words(spark):
    df = spark.createDataFrame([(f"the the the w{i} v{i}",) for i in range(400)], "text string").repartition(4)
    words, size = superkmers.common_words(df, 0.1)
    assert len(words) == 1 and size > 400 * 15
