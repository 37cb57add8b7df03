"""Fingerprints: the edited text by hand, likeness by its meaning, and the plan."""

import hashlib
import random

from pyspark.sql import functions as F

from vacancia.llm import syncmers


def expected(rows):
    """(doc_id, n_chars, sha256 of the edited text) with ids ascending, nulls first."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (d, t) in enumerate(rows):
        half = len(t) // 2
        edited = t[:len(t) - half] + rows[(i + 1) % len(rows)][1][:half]
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    return out


def texts(seed, n):
    rng = random.Random(seed)
    return [(i * 7 + (i > n // 2) * 100_000, " ".join(f"wö{rng.randrange(3000)}" for _ in range(rng.randrange(1, 200))))
            for i in range(n)]


def test_edited_text(spark):
    rows = texts(1, 300)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = syncmers.compare(df).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == sorted(expected(rows))
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.n_chars > 600:
            assert 0.3 < r.near_edited < 0.7 and r.near_next < 0.05
    one = syncmers.compare(df.limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1


def test_odd_rows(spark, odd):
    got = syncmers.compare(odd).collect()
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == sorted((d or -1, len(t or "")) for d, t in rows)
    texts_of = dict((d, t) for d, t in rows if d is not None)
    prints = {}
    for r in got:
        if r.doc_id is not None:
            assert prints.setdefault(texts_of[r.doc_id] or "", r.fingerprint) == r.fingerprint
    assert len(set(prints.values())) == len(prints)
    assert syncmers.compare(odd.limit(0)).collect() == []


def test_anchors_are_free_of_context_and_closed(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    df = spark.createDataFrame([(f"a b c d {passage} e f",), (f"{passage}",), (f"x {passage}",)], "text string")
    found = [set(r.a) for r in syncmers.with_anchors(df, "text", "a").collect()]
    assert found[1] <= found[0] and found[1] <= found[2] and len(found[1]) >= 10
    pairs = spark.range(59).select(F.xxhash64(F.concat(F.lit("p"), "id"), F.concat(F.lit("p"), F.col("id") + 1)))
    h = [r[0] for r in pairs.collect()]
    closed = [i for i in range(len(h) - syncmers.K + 2) if min(h[i:i + syncmers.K - 1]) in (h[i], h[i + syncmers.K - 2])]
    assert len(closed) == len(found[1])


def test_places(spark):
    df = spark.createDataFrame([([1, 5, 9], [5, 7, 1])], "a array<long>, b array<long>")
    assert df.select(syncmers.shared_places("a", "b")).first()[0] == [(0, 2), (1, 0)]


def test_no_python_in_the_plan(spark, odd):
    plan = syncmers.compare(odd.select("doc_id", "text"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
