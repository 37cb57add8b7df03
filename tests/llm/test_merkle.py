"""The manifest against building the tree by hand, and its proofs against the root."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vacancia.llm import merkle, queries

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def leaf_of(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climbed(nodes, at):
    """(top, siblings of ``at`` level by level) of a run of digests."""
    found = []
    while len(nodes) > 1:
        first = at // 8 * 8
        found += [n for i, n in enumerate(nodes[first:first + 8], first) if i != at]
        nodes, at = [sha("".join(nodes[i:i + 8])) for i in range(0, len(nodes), 8)], at // 8
    return nodes[0], found


def by_definition(rows):
    """{(lang, key, leaf): (subroot, root, siblings)} of (lang, key, leaf) rows."""
    runs = {}
    for lang, key, leaf in sorted(rows, key=lambda r: (r[0] is not None, (r[0] or "").encode(), r[1] is not None, r[1] or 0, r[2])):
        runs.setdefault(lang, []).append((lang, key, leaf))
    subroots = [climbed([r[2] for r in run], 0)[0] for run in runs.values()]
    out = {}
    for i, run in enumerate(runs.values()):
        root, above = climbed(subroots, i)
        for at, row in enumerate(run):
            subroot, below = climbed([r[2] for r in run], at)
            out[row] = (subroot, root, below + above)
    return out


def manifest_of(spark, rows):
    return merkle.build(spark.createDataFrame(rows, "lang string, key long, leaf string"), "lang", "key")


def check(proved, want):
    got = {}
    for r in proved.withColumn("folded", merkle.fold(F.col("leaf"), "proof")).collect():
        assert r.folded == r.root
        got[r.lang, r.key, r.leaf] = (r.subroot, r.root, [s for step in r.proof for s in step.siblings])
    assert got == want


@pytest.mark.parametrize("part", [1, 5, 64, 4096])
def test_proofs_of_any_partition(spark, part):
    rows = [("en", 7 * i % 1000, sha(f"e{i}")) for i in range(585)] + [(None, i, sha(f"n{i}")) for i in range(9)]
    rows += [("de", None, sha("x")), ("de", 3, sha("y"))] + [(f"l{i}", i, sha(f"l{i}")) for i in range(70)]
    manifest = manifest_of(spark, rows if part > 1 else rows[500:])
    check(merkle.prove(manifest, part_leaves=part), by_definition(rows if part > 1 else rows[500:]))


def test_proofs_of_some_leaves_fetch_the_missing_union(spark):
    rows = [("en", i, sha(str(i))) for i in range(200)]
    manifest, want = manifest_of(spark, rows), by_definition(rows)
    some = merkle.Manifest(manifest.leaves.filter("key IN (3, 4, 77, 199)"), manifest.nodes)
    check(merkle.prove(some), {k: v for k, v in want.items() if k[1] in (3, 4, 77, 199)})


def test_missing_is_minimal():
    """Full runs need nothing below themselves; no node is both derived and fetched."""
    assert [(x, m.tolist()) for x, m in merkle.missing(np.arange(64), 128)] == [
        (0, []), (1, []), (2, [1])]
    assert [(x, m.tolist()) for x, m in merkle.missing(np.array([0, 1, 17]), 20)] == [
        (0, [2, 3, 4, 5, 6, 7, 16, 18, 19]), (1, [1])]


def test_changed_leaf_is_found(spark):
    rows = [("en", i, sha(str(i))) for i in range(30)]
    proved = merkle.prove(manifest_of(spark, rows)).withColumn("folded", merkle.fold(F.lit(sha("other")), "proof"))
    assert proved.filter("folded = root").count() == 0


def test_odd(spark, odd):
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = odd.withColumn("leaf", merkle.digest(*map(F.col, fields))).withColumnsRenamed({"doc_id": "key"})
    want = by_definition([(r.lang, r.key, r.leaf) for r in rows.collect()])
    assert {r.leaf for r in rows.collect()} == {leaf_of(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in odd.collect()}
    proved = merkle.prove(merkle.build(rows.drop("text", "labels"), "lang", "key"))
    assert proved.count() == odd.count()  # equal rows are leaves of their own
    assert {(r.lang, r.key, r.leaf) for r in proved.collect()} == set(want)
    assert {r.root for r in proved.collect()} == {next(iter(want.values()))[1]}
    assert merkle.prove(merkle.build(rows.limit(0), "lang", "key")).collect() == []
    alone = merkle.prove(merkle.build(rows.limit(1), "lang", "key")).first()
    assert alone.leaf == alone.subroot == alone.root and alone.proof == []


def test_query_finds_the_tampered(spark):
    rows = queries.QUERIES["op12_merkle_manifest"](spark, "/root/testdata/sf0.001").collect()
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    import zlib
    for r in rows:
        d = docs[r.doc_id]
        changed = "".join(c.lower() if "A" <= c <= "Z" else c for c in d.text or "")
        assert r.leaf == leaf_of(d.doc_id, d.source, d.lang, d.n_chars, d.text)
        assert r.verified == (zlib.crc32(str(d.doc_id).encode()) % 3 != 0 or changed == (d.text or ""))
    assert len({r.root for r in rows}) == 1 and {r.verified for r in rows} == {True, False}
