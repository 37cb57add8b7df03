"""The Jaccard join against all pairs, and its signatures against their promise."""

import pathlib
import random

import numpy as np
import pytest

from vacancia.llm import common, partenum
from vacancia.llm.components import components


def shingles(text, w):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + w]) for i in range(max(1, len(words) - w + 1)))


def brute(rows, w, percent):
    sets = [shingles(t, w) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and (a == b or rows[i][0] is not None and rows[j][0] is not None) \
                    and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1], r[2] is None, r[2] or 0))


def families(seed, n, edits):
    """Texts with chains and stars of near copies around the threshold."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.7:
            words = rng.choice(rows)[1].split(" ")
            for _ in range(rng.randint(0, max(1, int(edits * len(words))))):
                k = rng.randrange(len(words))
                if rng.random() < 0.5:
                    words[k] = f"e{rng.randrange(9)}"
                else:
                    words.insert(k, f"i{rng.randrange(9)}")
        else:
            words = [f"W{rng.randrange(500)}" for _ in range(rng.choice([1, 2, 3, 8, 11, 12, 20, 30, 60, 200]))]
        rows.append((i * 3 % n if n % 3 else i, " ".join(words)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,edits,w,percent", [(1, 0.02, 3, 90), (2, 0.05, 3, 90), (3, 0.05, 5, 80), (4, 0.1, 1, 90)])
def test_equals_all_pairs(spark, monkeypatch, seed, edits, w, percent):
    monkeypatch.setattr(partenum, "_BLOCK", 5 if seed % 2 else 1024)
    rows = families(seed, 250, edits)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [tuple(r) for r in partenum.link(df, w, percent).collect()]
    assert order(got) == order(brute(rows, w, percent))


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = [tuple(r) for r in partenum.link(odd).collect()]
    assert order(got) == order(brute(rows, 3, 90))
    assert partenum.link(odd.limit(0)).collect() == []


def test_original_without_an_id_does_not_part_its_copies(spark):
    rng = random.Random(6)
    rows = []
    for family in range(6):
        words = [f"f{family}w{i}" for i in range(200)]
        rows.append((None, " ".join(words)))
        for copy in range(5):
            edited = list(words)
            edited[rng.randrange(200)] = f"e{copy}"
            rows.append((family * 10 + copy, " ".join(edited)))
        rows.append((None, rows[-1][1]))
    rows.sort(key=lambda r: r[0] is not None)  # originals first: the smallest nodes
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = [tuple(r) for r in partenum.link(df, 3, 90).collect()]
    assert order(got) == order(brute(rows, 3, 90))


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    for percent in (80, 90, 95):
        bands = partenum.Bands(percent)
        for n in [*range(2, 60), 90, 300, 1000]:
            a = rng.integers(0, 1 << 63, n, np.uint64)
            lost = (100 - percent) * n // 100  # the most that may be missing
            for drop in {lost, lost // 2}:
                b = a[drop:]
                if not len(b) or len(b) == n or 100 * len(b) < percent * n:
                    continue
                s, who = partenum.signatures(np.concatenate([np.sort(a), np.sort(b)]), np.array([n, len(b)]), bands)
                assert set(s[who == 0].tolist()) & set(s[who == 1].tolist()), (percent, n, drop)


def test_components(spark):
    rng = random.Random(2)
    edges = [(f"{i:04d}", f"{i + 1:04d}") for i in range(100)] + [
        (f"{rng.randrange(200, 400):04d}", f"{rng.randrange(200, 400):04d}") for _ in range(120)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def test_small_tables_of_components_are_one_file(spark, monkeypatch):
    """A round on few edges writes a file a table, however many shuffle partitions there are."""
    paths, fresh = [], common.session.scratch_path
    monkeypatch.setattr(common.session, "scratch_path", lambda *a: paths.append(fresh(*a)) or paths[-1])
    kept = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "6")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        edges = [(f"{i:04d}", f"{i + 1:04d}") for i in range(12)]
        got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert got == {f"{i:04d}": "0000" for i in range(13)}
    assert len(paths) > 4 and {len(list(pathlib.Path(p).glob("*.parquet"))) for p in paths} == {1}


def test_histograms_bound_differences_and_new_pivots_reach_links():
    import pyarrow as pa

    rng = np.random.default_rng(8)
    for percent in (80, 90):
        base = [rng.integers(0, 1 << 63, 200, np.uint64) * np.uint64(2) for _ in range(4)]
        sets = []
        for _ in range(120):  # four families of near copies, the first near the pivot
            b = base[rng.integers(4)].copy()
            k = rng.integers(0, 30)
            b[rng.choice(200, k, replace=False)] = rng.integers(0, 1 << 63, k, np.uint64)
            sets.append(np.unique(b))
        p = np.unique(base[0])
        bound = lambda a, b: int(np.abs(np.subtract(*partenum._folded(
            [partenum.histogram(a).tobytes(), partenum.histogram(b).tobytes()]))).sum())
        far = [bound(p, x) > partenum._allowed(len(p) + len(x), percent) for x in sets]
        table = pa.table({
            "x": [str(i) for i in range(len(sets))], "root": [str(i) for i in range(len(sets))], "n": [len(x) for x in sets], "far": far,
            "hist": [partenum.histogram(x).tobytes() for x in sets], "block": [0] * len(sets), "i": [0] * len(sets),
            "j": [0] * len(sets)})
        made = partenum._new_pairs(table, percent)
        assert len(made) <= 8 * len(sets)
        stars = {}
        for a, b in made:
            stars.setdefault(a, set()).add(b)
        near = {str(i) for i in range(len(sets)) if not far[i]}
        for i in range(len(sets)):
            for j in range(i):
                differ = len(np.setxor1d(sets[i], sets[j]))
                assert bound(sets[i], sets[j]) <= differ
                both = (len(sets[i]) + len(sets[j]) - differ) // 2
                if 100 * both >= percent * (both + differ):
                    x, y = str(i), str(j)
                    assert (x in near and y in near) or y in stars.get(x, ()) or x in stars.get(y, ()) or any(
                        x in s and y in s for s in stars.values())


def test_members_just_beyond_the_limit_share_few_pivots():
    """Copies of one text, each too far from every other one: pairs grow with the members."""
    import pyarrow as pa

    made = {}
    for members in (100, 400):
        rng = np.random.default_rng(3)
        base = rng.integers(0, 1 << 63, 400, np.uint64) * np.uint64(2)
        sets = []
        for _ in range(members):
            b = base.copy()
            b[rng.choice(400, 27, replace=False)] = rng.integers(0, 1 << 63, 27, np.uint64) * np.uint64(2)
            sets.append(np.unique(b))
        names = [str(i) for i in range(members)]
        table = pa.table({
            "x": names, "root": names, "n": [len(x) for x in sets], "far": [True] * members,
            "hist": [partenum.histogram(x).tobytes() for x in sets], "block": [0] * members, "i": [0] * members,
            "j": [0] * members})
        made[members] = partenum._new_pairs(table, 80)
        covered = np.zeros((members, members), bool)
        stars = {}
        for x, y in made[members]:
            covered[int(x), int(y)] = covered[int(y), int(x)] = True
            stars.setdefault(x, []).append(int(y))
        for s in stars.values():
            covered[np.ix_(s, s)] = True
        rows = partenum._folded([partenum.histogram(x).tobytes() for x in sets])
        sizes = np.array([len(x) for x in sets])
        for i in range(members):
            close = np.abs(rows - rows[i]).sum(1) <= partenum._allowed(sizes + sizes[i], 80)
            assert covered[i][close & (np.arange(members) != i)].all()
    assert 399 <= len(made[400]) <= 8 * 400  # one pivot with all others at least


def test_prefixes_are_signed_for_the_band_two_sets_share():
    """Sets of neighbouring bands that agree where a choice is empty still meet; far sizes do not."""
    bands = partenum.Bands(80)
    rng = np.random.default_rng(5)
    common = np.sort(rng.integers(0, 1 << 63, 3000, np.uint64))
    sets = [common[:n] for n in (40, 44, 48, 300, 3000)]
    sig, who = partenum.signatures(np.concatenate(sets), np.array([len(s) for s in sets]), bands)
    held = [set(sig[who == i].tolist()) for i in range(len(sets))]
    assert held[0] & held[1] and held[1] & held[2]
    assert not held[0] & held[3] and not held[3] & held[4]
