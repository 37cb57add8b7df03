"""Chat formatting of reply trees: root-to-leaf paths ranked, each chosen one a conversation.

A message names its parent. Jumps to the 2nd, 4th, 8th ... ancestor come from joining the
table with itself until no message has a further one, so a thread of n messages takes log n
joins, however it branches. The jumps lead every leaf to its root, summing scores on the way;
branches of a tree are ranked by mean score; the chosen ones are walked again, now keeping
every message passed. No message is a row more often than chosen paths go through it.

A turn is ``open + role + "\\n" + text + close``. Control strings inside texts get a backslash
after their first character, and one more for each one that stands there already, so texts
come back exactly. In roles backslashes, line ends and opening characters are escaped.
The loss mask is a list of code point ranges, the text of each turn of a learned role.

Null trees and ids are values like others, null texts and roles are empty, null scores are 0.
A message whose parent is null or absent is a root; messages on or below a cycle of parents
have no root and are in no path. Of rows of equal tree and id the least by role, text and
parent stays. Further columns do not matter; an empty table gives no conversation.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.bpe import slices
from vacancia.llm.common import ship, stored

#: Strings that chat templates in public use give a meaning.
CONTROLS = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]")
#: Characters of a formatted piece from which on the next turn begins another.
PIECE_CHARS = 1 << 20


class Template(NamedTuple):
    """Marks around turns; ``controls`` are escaped in texts, the marks among them."""

    opening: str = "<|im_start|>"
    closing: str = "<|im_end|>\n"
    controls: tuple[str, ...] = CONTROLS
    learned: tuple[str, ...] = ("assistant",)

    def checked(self) -> Template:
        firsts = {c[0] for c in self.controls}
        if any("\\" in c or len(c) < 2 or firsts & set(c[1:]) for c in self.controls):
            raise ValueError("control strings need a first character of their own and no backslash")
        if not {self.opening, self.closing.rstrip("\n")} <= set(self.controls):
            raise ValueError("both marks must be control strings")
        return self


class Escapes:
    """Reversible escaping under a template."""

    def __init__(self, template: Template):
        self.firsts = "".join(sorted({c[0] for c in template.controls}))
        forms = [(re.escape(f), "|".join(re.escape(c[1:]) for c in template.controls if c[0] == f)) for f in self.firsts]
        self.plain, self.marked = (
            re.compile("|".join(f"{first}{slashes}(?:{tails})" for first, tails in forms)) for slashes in (r"\\*", r"\\+"))
        self.role = re.compile(f"[\\\\\n{re.escape(self.firsts)}]")

    def text(self, text: str) -> str:
        return self.plain.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)

    def text_back(self, text: str) -> str:
        return self.marked.sub(lambda m: m[0][0] + m[0][2:], text)

    def role_out(self, role: str) -> str:
        return self.role.sub(lambda m: "\\n" if m[0] == "\n" else "\\\\" if m[0] == "\\" else f"\\{self.firsts.index(m[0])}", role)

    def role_back(self, role: str) -> str:
        return re.sub(r"\\(.)", lambda m: {"n": "\n", "\\": "\\"}.get(m[1]) or self.firsts[int(m[1])], role)


# ---------------------------------------------------------------- paths

def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """(tree, node, up, total) tables: the 1st, 2nd, 4th ... ancestor and the scores passed.

    ``total`` sums the scores of the ancestors up to ``up``.
    """
    scores = nodes.select("tree", F.col("node").alias("up"), F.col("score").alias("total"))
    jump = stored(nodes.select("tree", "node", F.col("parent").alias("up")).join(scores, ["tree", "up"]), "jump-0")
    count, jumps = jump.count(), []
    while count and len(jumps) < 62:
        jumps.append(jump)
        further = jump.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"))
        jump = stored(jump.join(further, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"), (F.col("total") + F.col("more")).alias("total")),
            f"jump-{len(jumps)}")
        before, count = count, jump.count()
        if before == count:  # only messages on or below cycles go on
            break
    return jumps


def branches(nodes: DataFrame, jumps: list[DataFrame], keep: int | None = None) -> DataFrame:
    """(tree, leaf, depth, score, branch): leaves with a root, best mean score first.

    ``keep`` branches of a tree stay, all if None; ties go to the shorter, then the lesser leaf.
    """
    inner = jumps[0].select("tree", F.col("up").alias("leaf")).distinct() if jumps else None
    at = nodes.select("tree", F.col("node").alias("leaf"), F.col("score").alias("sum"))
    if inner is not None:
        at = at.join(inner, ["tree", "leaf"], "left_anti")
    at = at.withColumns({"node": F.col("leaf"), "depth": F.lit(1).cast("long")})
    for j, jump in reversed(list(enumerate(jumps))):
        at = at.join(jump, ["tree", "node"], "left").select(
            "tree", "leaf", F.coalesce("up", "node").alias("node"),
            (F.col("depth") + F.when(F.col("up").isNull(), 0).otherwise(1 << j)).alias("depth"),
            (F.col("sum") + F.coalesce("total", F.lit(0.0))).alias("sum"))
    roots = nodes.filter("parent IS NULL").select("tree", "node")
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "depth", "leaf")
    ranked = at.join(roots, ["tree", "node"], "left_semi").withColumn("score", F.col("sum") / F.col("depth")).withColumn(
        "branch", F.row_number().over(best))
    return (ranked if keep is None else ranked.filter(F.col("branch") <= keep)).select(
        "tree", "leaf", "depth", "score", "branch")


def walked(chosen: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(tree, branch, node, turn): every message of the chosen paths, the root's turn is 0."""
    at = chosen.select("tree", "branch", F.col("leaf").alias("node"), (F.col("depth") - 1).alias("turn"))
    for j, jump in reversed(list(enumerate(jumps))):
        stays = F.struct("node", "turn")
        goes = F.when(F.col("up").isNotNull(), F.struct(F.col("up").alias("node"), (F.col("turn") - (1 << j)).alias("turn")))
        at = at.join(jump, ["tree", "node"], "left").select(
            "tree", "branch", F.explode(F.array_compact(F.array(stays, goes))).alias("x")).select("tree", "branch", "x.*")
    return at


def _numbered(messages: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str | None) -> DataFrame:
    """Messages under string keys that no null can clash with, one for each key."""
    named = lambda c: F.concat(F.lit("="), F.col(c).cast("string"))
    rows = messages.select(
        F.coalesce(named(tree), F.lit("-")).alias("tree"), F.coalesce(named(node), F.lit("-")).alias("node"),
        named(parent).alias("parent"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
        (F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)).alias("score"),
        F.col(tree).alias("tree_id"), F.col(node).alias("leaf_id"))
    first = F.row_number().over(Window.partitionBy("tree", "node").orderBy("role", "text", "parent", "score"))
    return rows.withColumn("_n", first).filter("_n = 1").drop("_n")


# ---------------------------------------------------------------- formatting

_PIECE = pa.schema([("tree", pa.string()), ("branch", pa.int32()), ("turn", pa.int64()), ("turns", pa.int64()),
                    ("body", pa.string()), ("spans", pa.list_(pa.int64()))])


def _pieces(template: Template):
    """Consecutive turns of a path, formatted and joined up to ``PIECE_CHARS``."""
    escapes = Escapes(template)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        held, parts = None, []
        for batch in batches:
            for tree, branch, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and ((tree, branch) != (held["tree"], held["branch"]) or size > PIECE_CHARS):
                    yield held | {"body": "".join(parts)}
                    held = None
                if not held:
                    held, parts, size = {"tree": tree, "branch": branch, "turn": turn, "turns": 0, "spans": []}, [], 0
                head, body = f"{template.opening}{escapes.role_out(role)}\n", escapes.text(text)
                parts += [head, body, template.closing]
                if role in template.learned:
                    held["spans"] += [size + len(head), size + len(head) + len(body)]
                size += len(head) + len(body) + len(template.closing)
                held["turns"] += 1
        if held:
            yield held | {"body": "".join(parts)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for piece in pieces(batches):
            rows.append(piece)
            size += len(piece["body"])
            if size > PIECE_CHARS:
                yield pa.RecordBatch.from_pylist(rows, _PIECE)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _PIECE)

    return run


def format_trees(messages: DataFrame, tree: str = "tree", node: str = "node", parent: str = "parent", role: str = "role",
                 text: str = "text", score: str | None = "score", keep: int | None = None,
                 template: Template = Template()) -> DataFrame:  # noqa: B008 (a constant)
    """One row for each chosen path of each tree.

    Columns: tree, leaf, branch (rank from 1), score, n_turns, formatted, loss (ranges
    ``[start, stop)`` of code points of ``formatted``). Pieces of a path are formatted where
    its turns lie in order, so a very long thread is the work of many tasks; its row is joined
    from pieces.
    """
    ship(messages.sparkSession)
    rows = stored(_numbered(messages, tree, node, parent, role, text, score), "messages")
    nodes = rows.select("tree", "node", "parent", "score")
    known = nodes.select("tree", F.col("node").alias("parent"))
    orphans = nodes.filter("parent IS NOT NULL").join(known, ["tree", "parent"], "left_anti").select("tree", "node")
    nodes = stored(nodes.join(orphans.withColumn("lost", F.lit(True)), ["tree", "node"], "left").select(
        "tree", "node", F.when(F.col("lost").isNull(), F.col("parent")).alias("parent"), "score"), "nodes")
    jumps = _jumps(nodes)
    chosen = stored(branches(nodes, jumps, keep), "branches")
    turns = walked(chosen, jumps).join(rows.select("tree", "node", "role", "text"), ["tree", "node"])
    by_turn = ["tree", "branch", "turn"]
    pieces = turns.select(*by_turn, "role", "text").repartitionByRange(*by_turn).sortWithinPartitions(*by_turn).mapInArrow(
        _pieces(template.checked()),
        "tree string, branch int, turn long, turns long, body string, spans array<long>")
    whole = pieces.groupBy("tree", "branch").agg(
        F.sum("turns").alias("n_turns"), F.array_sort(F.collect_list(F.struct("turn", "body", "spans"))).alias("pieces"))
    start = "aggregate(slice(pieces, 1, i), 0L, (n, x) -> n + length(x.body))"
    whole = whole.select(
        "tree", "branch", "n_turns", F.expr("concat_ws('', transform(pieces, x -> x.body))").alias("formatted"),
        F.expr(f"flatten(transform(pieces, (p, i) -> transform(p.spans, s -> s + {start})))").alias("edges"))
    loss = F.expr("transform(sequence(0, size(edges) div 2 - 1), i -> struct(edges[2 * i] AS start, edges[2 * i + 1] AS stop))")
    names = rows.select("tree", F.col("node").alias("leaf"), "tree_id", "leaf_id")
    return (
        whole.join(chosen, ["tree", "branch"]).join(names, ["tree", "leaf"])
        .select(F.col("tree_id").alias("tree"), F.col("leaf_id").alias("leaf"), "branch", "score", "n_turns", "formatted",
                F.when(F.size("edges") > 0, loss).otherwise(F.expr("array()").cast(
                    "array<struct<start:bigint,stop:bigint>>")).alias("loss")))


def read_back(formatted: str, loss: list[tuple[int, int]], template: Template = Template()) -> tuple[list[tuple[str, str]], list[str]]:  # noqa: B008
    """(turns as role and text, texts under the loss mask) of a formatted conversation."""
    escapes, turns, at = Escapes(template), [], 0
    while at < len(formatted):
        end = formatted.index("\n", at)
        role = formatted[at + len(template.opening):end]
        stop = formatted.index(template.closing, end + 1)
        turns.append((escapes.role_back(role), escapes.text_back(formatted[end + 1:stop])))
        at = stop + len(template.closing)
    return turns, [escapes.text_back(formatted[a:b]) for a, b in loss]


def parsed(conversations: DataFrame, template: Template = Template()) -> DataFrame:  # noqa: B008
    """``conversations`` with ``turns`` and ``loss_text`` (texts under the mask, joined), read from ``formatted``."""
    ship(conversations.sparkSession)
    kind = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    at = conversations.columns.index("formatted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at):
            turns, texts = [], []
            for formatted, loss in zip(batch["formatted"].to_pylist(), batch["loss"].to_pylist(), strict=True):
                found, learned = read_back(formatted, [(x["start"], x["stop"]) for x in loss], template)
                turns.append([{"role": r, "text": t} for r, t in found])
                texts.append("".join(learned))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(turns, kind), pa.array(texts, pa.string())],
                names=[*batch.schema.names, "turns", "loss_text"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in conversations.schema.fields)
    return conversations.mapInArrow(run, f"{fields}, turns array<struct<role:string,text:string>>, loss_text string")
