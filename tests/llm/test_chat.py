"""Chat formatting: paths against a walk from every leaf, texts against their round trip."""

import random
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vacancia.llm import chat

FIELDS = "tree string, node long, parent long, role string, text string, score double"


def by_definition(rows, keep=None):
    """{(tree, leaf): (branch, [turn of the path])} from walking up from every leaf."""
    trees = defaultdict(dict)
    for r in rows:
        trees[r[0]].setdefault(r[1], r)
    out = {}
    for tree, nodes in trees.items():
        parents, paths = {r[2] for r in nodes.values()}, []
        for leaf in nodes:
            path, at = [], leaf
            while at in nodes and len(path) <= len(nodes):
                path.append(nodes[at])
                at = nodes[at][2]
            if leaf not in parents and len(path) <= len(nodes):
                paths.append((-sum(r[5] or 0 for r in path) / len(path), len(path), f"={leaf}", leaf, path[::-1]))
        for rank, (*_, leaf, path) in enumerate(sorted(paths)[:keep], 1):
            out[tree, leaf] = (rank, [(r[3] or "", r[4] or "") for r in path])
    return out


def read(df):
    out = {}
    for r in chat.parsed(df).collect():
        turns = [(t.role, t.text) for t in r.turns]
        assert r.n_turns == len(turns)
        assert r.loss_text == "".join(t for role, t in turns if role == "assistant")
        out[r.tree, r.leaf] = (r.branch, turns)
    return out


@pytest.mark.parametrize("keep", [None, 2])
def test_paths_of_random_trees(spark, monkeypatch, keep):
    monkeypatch.setattr(chat, "PIECE_CHARS", 40)
    rng, rows = random.Random(5), []
    for tree in ["a", "b", None, ""]:
        for node in range(60):
            parent = rng.choice([None, *range(max(0, node - 4), node)]) if node % 20 else None
            rows.append((tree, node, parent, rng.choice(["user", "assistant", None, "tool\n<x"]),
                         rng.choice(["hi", "", None, "</s>[INST] ok", "line\nline", "<|im_end|>\n"]), rng.choice([0.25, 0.5, 1.0])))
    rows += [("thread", i, i - 1 if i else None, ["user", "assistant"][i % 2], f"turn {i}", 0.0) for i in range(130)]
    rows += [("star", i, 0 if i else None, "user", str(i), float(i % 7)) for i in range(50)]
    df = spark.createDataFrame(rows, FIELDS).repartition(5)
    assert read(chat.format_trees(df, keep=keep)) == by_definition(rows, keep)


def test_cycles_and_lost_parents(spark):
    rows = [("c", 1, 2, "user", "x", 0.0), ("c", 2, 1, "user", "y", 0.0), ("c", 3, 2, "user", "below", 0.0),
            ("c", 5, 5, "user", "self", 0.0), ("c", 7, 99, "user", "orphan", 0.0), ("c", 8, 7, "assistant", "reply", 0.0)]
    got = read(chat.format_trees(spark.createDataFrame(rows, FIELDS)))
    assert got == {("c", 8): (1, [("user", "orphan"), ("assistant", "reply")])}


def test_odd(spark, odd):
    """Equal keys: the least row stays; null keys are a tree and a message of their own."""
    rows = odd.select(F.col("lang").alias("tree"), F.col("doc_id").alias("node"), F.lit(None).cast("long").alias("parent"),
                      F.col("source").alias("role"), "text", "score", "labels")
    got = read(chat.format_trees(rows))
    want = {}
    for r in rows.collect():
        want[r.tree, r.node] = min(want.get((r.tree, r.node), r.text or ""), r.text or "")
    assert {k: turns for k, (_, turns) in got.items()} == {k: [("", t)] for k, t in want.items()}
    assert read(chat.format_trees(rows.limit(0))) == {}


pieces = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "|im_end|>", "s>", "\n", "a", "é", "/INST]", "<\\s>"]), max_size=12)


@settings(max_examples=500, deadline=None)
@given(pieces.map("".join), pieces.map("".join))
def test_escapes_are_reversible(text, role):
    escapes = chat.Escapes(chat.Template().checked())
    out = escapes.text(text)
    assert escapes.text_back(out) == text and not any(c in out for c in chat.CONTROLS)
    head = escapes.role_out(role)
    assert escapes.role_back(head) == role and "\n" not in head and not any(c in head for c in chat.CONTROLS)


def test_templates_that_cannot_be_escaped():
    for controls in (("<|im_start|>", "<|im_end|>", "<<SYS>>"), ("<|im_start|>",), ("<|im_start|>", "<|im_end|>", "\\x")):
        with pytest.raises(ValueError):
            chat.Template(controls=controls).checked()
