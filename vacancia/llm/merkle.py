"""Merkle manifest of a dataset, with octopus multiproofs for partitions of leaves.

A row's leaf is the digest of its fields, each with its length before it. The leaves of a
group (a language, say) stand in key order; every ``ARITY`` consecutive nodes have a parent
until one is left, the group's subroot; subroots, in group order, likewise give the root.

Proofs are made a partition of neighbouring leaves at a time. From its own coordinates alone
a partition works out which nodes it can derive and which it cannot: the minimal union of
missing siblings over all its leaves and levels. These it fetches once, by one join; then it
derives the interiors its leaves share and hands each leaf its own siblings. A leaf and its
proof give the root by :func:`fold`, in DataFrame functions, away from the manifest.

Nulls in any field are ``-``; empty texts have length 0. Null groups are a group, the first;
null keys come first in theirs; equal keys go by digest, so repeated rows are leaves of their
own. Further columns do not matter. An empty table has no leaves, no root and no proofs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import ship, stored
from vacancia.llm.order import placed

ARITY = 8
#: Leaves of a partition that is proved at once.
PART_LEAVES = ARITY ** 4
TOP = -1  # the tree of subroots
_COORD = "tree long, part long, of long, level int, place long"
_PROOF = pa.list_(pa.struct([("place", pa.int32()), ("siblings", pa.list_(pa.string()))]))


class Manifest(NamedTuple):
    """``leaves``: key, others, leaf, tree, place, width; ``nodes``: tree, level, place, digest, width."""

    leaves: DataFrame
    nodes: DataFrame


def digest(*fields: Column) -> Column:
    """Lower-case hex SHA-256 of the fields, each its UTF-8 length and value, or ``-`` if null."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")), F.lit(":"), f.cast("string")), F.lit("-"))
             for f in fields]
    return F.sha2(F.concat(*parts), 256)


def _levels(bottom: DataFrame) -> list[DataFrame]:
    """(tree, place, digest, width) of every level above ``bottom``; single nodes stay as they are."""
    width = bottom.agg(F.max("width")).first()[0] or 0
    levels, level = [], bottom
    while width > 1:
        run = F.array_sort(F.collect_list(F.struct("place", "digest")))
        level = stored(
            level.filter("width > 1").groupBy("tree", F.expr(f"place div {ARITY}").alias("place")).agg(
                F.sha2(F.concat_ws("", F.transform(run, lambda x: x.digest)), 256).alias("digest"),
                F.ceil(F.first("width") / ARITY).alias("width")), f"nodes-{len(levels)}")
        levels.append(level)
        width = -(-width // ARITY)
    return levels


def build(rows: DataFrame, group: str, key: str, leaf: str = "leaf") -> Manifest:
    """The manifest of ``rows``, which carry their digests in ``leaf``."""
    leaves = placed(stored(rows, "digests"), group, F.col(key).asc_nulls_first(), F.col(leaf))
    names = leaves.select(F.col(group).alias("_name")).distinct().withColumn("_all", F.lit(0))
    groups = placed(names, "_all", F.col("_name").asc_nulls_first()).select(
        "_name", F.col("place").alias("tree"), F.col("width").alias("trees"))
    leaves = stored(leaves.join(groups, F.col(group).eqNullSafe(F.col("_name"))).drop("_name"), "leaves")
    bottom = leaves.select("tree", "place", F.col(leaf).alias("digest"), "width")
    found = [bottom, *_levels(bottom)]
    nodes = _numbered(found)
    roots = stored(nodes.filter("width = 1").select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), "digest"), "subroots")
    roots = roots.withColumn("width", F.lit(roots.count()).cast("long"))
    return Manifest(leaves, nodes.unionByName(_numbered([roots, *_levels(roots)])))


def _numbered(levels: list[DataFrame]) -> DataFrame:
    out = None
    for i, level in enumerate(levels):
        rows = level.select("tree", F.lit(i).alias("level"), "place", "digest", "width")
        out = rows if out is None else out.unionByName(rows)
    return out


def missing(places: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(level, places) of the nodes that leaves at ``places`` need and cannot derive."""
    known, level = np.unique(places), 0
    while width > 1:
        parents = np.unique(known // ARITY)
        children = (parents[:, None] * ARITY + np.arange(ARITY)).ravel()
        yield level, np.setdiff1d(children[children < width], known, assume_unique=True)
        known, width, level = parents, -(-width // ARITY), level + 1


def _wanted(table: pa.Table) -> pa.Table:
    """Coordinates that one partition of leaves has to fetch, its subroot's siblings included."""
    tree, part, trees = (table.column(c)[0].as_py() for c in ("tree", "part", "trees"))
    runs = [(tree, *x) for x in missing(table["place"].to_numpy(), table["width"][0].as_py())]
    runs += [(TOP, *x) for x in missing(np.array([tree]), trees)]
    places = np.concatenate([p for *_, p in runs]) if runs else np.empty(0, np.int64)
    sizes = [len(p) for *_, p in runs]
    n = len(places)
    return pa.table({
        "tree": pa.array(np.full(n, tree, np.int64)), "part": pa.array(np.full(n, part, np.int64)),
        "of": pa.array(np.repeat([t for t, *_ in runs], sizes).astype(np.int64)),
        "level": pa.array(np.repeat([x for _, x, _ in runs], sizes).astype(np.int32)),
        "place": pa.array(places.astype(np.int64))})


def _derive(known: dict[int, str], fetched: dict[tuple[int, int], str], width: int) -> list[dict[int, str]]:
    """Digests by place of every level, from the bottom: derived ones and fetched ones."""
    for (level, place), value in fetched.items():
        if level == 0:
            known[place] = value
    own, level, out = set(known), 0, [known]
    while width > 1:
        parents = {p // ARITY for p in own}
        above = {p: hashlib.sha256("".join(
            known[c] for c in range(p * ARITY, min((p + 1) * ARITY, width))).encode()).hexdigest() for p in parents}
        own, width, level = parents, -(-width // ARITY), level + 1
        for (at, place), value in fetched.items():
            if at == level:
                above[place] = value
        known = above
        out.append(known)
    return out


def _path(place: int, width: int, levels: list[dict[int, str]]) -> list[tuple[int, list[str]]]:
    """(place in its run, the run's others) from the bottom to the top."""
    steps, level = [], 0
    while width > 1:
        first = place - place % ARITY
        steps.append((place - first, [levels[level][c] for c in range(first, min(first + ARITY, width)) if c != place]))
        place, width, level = place // ARITY, -(-width // ARITY), level + 1
    return steps


def prove(manifest: Manifest, leaf: str = "leaf", part_leaves: int = PART_LEAVES) -> DataFrame:
    """The leaves with ``subroot``, ``root`` and ``proof``: a step for each level.

    Leaves may be a part of the manifest's (filter ``manifest.leaves``): partitions then fetch
    more of their siblings. A step has the node's place in its run and the run's others.
    """
    ship(manifest.leaves.sparkSession)
    leaves = manifest.leaves.withColumn("part", F.expr(f"place div {part_leaves}"))
    slim = leaves.select("tree", "part", "place", "width", "trees")
    wanted = slim.groupBy("tree", "part").applyInArrow(_wanted, _COORD)
    nodes = manifest.nodes.select(F.col("tree").alias("of"), "level", "place", "digest")
    fetched = wanted.join(nodes, ["of", "level", "place"])

    def expand(own: pa.Table, got: pa.Table) -> pa.Table:
        tree, width, trees = (own[c][0].as_py() for c in ("tree", "width", "trees"))
        by_tree: dict[int, dict] = {tree: {}, TOP: {}}
        for of, level, place, value in zip(*(got[c].to_pylist() for c in ("of", "level", "place", "digest")), strict=True):
            by_tree[of][level, place] = value
        places = own["place"].to_pylist()
        inner = _derive(dict(zip(places, own[leaf].to_pylist(), strict=True)), by_tree[tree], width)
        subroot = inner[-1][0]
        outer = _derive({tree: subroot}, by_tree[TOP], trees)
        above = _path(tree, trees, outer)
        proofs = [[{"place": p, "siblings": s} for p, s in _path(x, width, inner) + above] for x in places]
        out = own.select(kept)
        for name, column in (("subroot", pa.array([subroot] * len(places))),
                             ("root", pa.array([outer[-1][0]] * len(places))), ("proof", pa.array(proofs, _PROOF))):
            out = out.append_column(name, column)
        return out

    kept = [c for c in manifest.leaves.columns if c not in ("tree", "trees", "place", "width")]
    schema = ", ".join(f"`{c}` {leaves.schema[c].dataType.simpleString()}" for c in kept)
    return leaves.groupBy("tree", "part").cogroup(fetched.groupBy("tree", "part")).applyInArrow(
        expand, f"{schema}, subroot string, root string, proof array<struct<place:int,siblings:array<string>>>")


def fold(leaf: Column, proof: Column | str) -> Column:
    """The root that a leaf and its proof give."""
    step = lambda node, x: F.sha2(F.concat_ws("", F.concat(
        F.slice(x.siblings, F.lit(1), x.place), F.array(node),
        F.slice(x.siblings, x.place + 1, F.lit(ARITY)))), 256)
    return F.aggregate(proof, leaf, step)


def siblings_digest(proof: Column | str) -> Column:
    """Digest of all siblings of a proof, left to right, bottom to top."""
    return F.sha2(F.concat_ws("", F.flatten(F.transform(proof, lambda x: x.siblings))), 256)
