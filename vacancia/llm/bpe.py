"""Byte-level BPE: overlapping chunk encoding, and decoding to raw bytes.

Texts of more than ``chunk`` code points become overlapping chunks that tasks pre-tokenise
in parallel. Neighbours are stitched at the first pre-token boundary that both have in
their overlap, from where on both cut alike; text between two stitches is a piece, and
pieces are encoded in parallel and their ids joined. Shorter texts are one piece. Where
neighbours share no boundary, the pieces are joined before encoding, so ids never depend
on the chunks.

Null and empty texts have no ids. Equal long texts are encoded once, by their digest, so a
large group of copies is no group here. Repeated rows and ids, null ids and further columns
do not matter; lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.common import ship

_BEFORE_SPACE = r"[\s\x0b\x{85}\p{Z}] "  # a space after white space
_NO_EDGE = r"^$|[\s\x0b\x{85}\p{Z}]$"  # empty, or white space at the end


class Encoder:
    """A rank file, with a word table for text blocks.

    Between a non-space and a space every pattern of this kind has a boundary, so a text
    without white space before a space is cut at its spaces; each distinct word of a block
    is encoded once and its ids are gathered. Other texts go through the library whole.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, special: dict[str, int]):
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
        self.special = special
        self.raw = [b""] * (max([*ranks.values(), *special.values()]) + 1)
        for piece, rank in ranks.items():
            self.raw[rank] = piece
        for piece, rank in special.items():
            self.raw[rank] = piece.encode()
        self.sizes = np.array([len(x) for x in self.raw], np.int64)

    def one(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        ids = (self.library.encode(text, allowed_special="all") if self.special
               else self.library.encode_ordinary(text))
        return np.array(ids, "<u4").tobytes()

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, counts) of distinct words, each after a space, in one call of the library.

        Tokens are told apart by their bytes: boundaries before spaces hold in any text.
        """
        odd = pc.match_substring_regex(words, _NO_EDGE).to_numpy(zero_copy_only=False)
        even = words.filter(pa.array(~odd))
        line = pc.binary_join(pa.ListArray.from_arrays([0, len(even)], even), " ")[0].as_py()
        ids = np.array(self.library.encode_ordinary(" " + line) if len(even) else [], np.uint32)
        ends = np.cumsum(pc.binary_length(even).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        stops = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
        counts = np.zeros(len(words), np.int64)
        counts[~odd] = np.diff(stops, prepend=0)
        if not odd.any():
            return ids, counts
        single = {i: np.frombuffer(self.one(" " + words[i].as_py()), "<u4") for i in np.flatnonzero(odd).tolist()}
        counts[list(single)] = [len(x) for x in single.values()]
        out, starts = np.empty(int(counts.sum()), np.uint32), np.cumsum(counts) - counts
        out[np.repeat(~odd, counts)] = ids
        for i, x in single.items():
            out[starts[i]:starts[i] + len(x)] = x
        return out, counts

    def block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, where each text's ids start) of a string array without nulls."""
        whole = pc.match_substring_regex(texts, _BEFORE_SPACE)
        for token in self.special:
            whole = pc.or_(whole, pc.match_substring(texts, token))
        split = pc.split_pattern(pc.if_else(whole, "", texts), " ")
        offsets = np.asarray(split.offsets)
        words = split.flatten()
        heads = words.take(pa.array(offsets[:-1])).to_pylist()
        for i in np.flatnonzero(whole.to_numpy(zero_copy_only=False)).tolist():
            heads[i] = texts[i].as_py()
        coded = words.dictionary_encode()
        rows = np.array(coded.indices)
        rows[offsets[:-1]] = len(coded.dictionary) + np.arange(len(heads))  # the first has no space
        ids, counts = self.words(coded.dictionary)
        first = [self.one(h) for h in heads]
        flat = np.concatenate([ids, np.frombuffer(b"".join(first), "<u4")])
        counts = np.concatenate([counts, np.fromiter(map(len, first), np.int64, len(first)) // 4])
        begins = np.cumsum(counts) - counts
        counts = counts[rows]
        ends = np.cumsum(counts)
        gather = np.repeat(begins[rows] - (ends - counts), counts)
        gather += np.arange(len(gather))
        return flat[gather], np.concatenate([[0], ends])[offsets]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _visible_bytes() -> dict[str, int]:
    """Byte-level vocabularies write each byte as a visible character."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@functools.lru_cache(maxsize=4)
def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a file, loaded once in each worker.

    A rank file has no special tokens. Of a byte-level JSON file, whose ids follow its
    merges, the added tokens are special and found in texts.
    """
    with open(path, "rb") as lines:
        if not path.endswith(".json"):
            return Encoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}, pattern, {})
        found = json.load(lines)
    special = {t["content"]: t["id"] for t in found["added_tokens"]}
    byte = _visible_bytes()
    ranks = {bytes(byte[c] for c in piece): i for piece, i in found["model"]["vocab"].items() if piece not in special}
    return Encoder(ranks, pattern, special)


def slices(batches: Iterator[pa.RecordBatch], column: int, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``limit`` bytes of one text column; a longer text is alone."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            base = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def _encode(df: DataFrame, path: str, pattern: str) -> DataFrame:
    """Column ``text`` to ``ids``, keeping the others."""
    ship(df.sparkSession)
    others = [f for f in df.schema.fields if f.name != "text"]
    at = df.columns.index("text")

    def run(batches):
        coder = encoder(path, pattern)
        for batch in slices(batches, at):
            ids, starts = coder.block(pc.fill_null(batch.column(at).cast(pa.string()), ""))
            data = pa.py_buffer(np.ascontiguousarray(ids, "<u4").tobytes())
            made = pa.Array.from_buffers(
                pa.binary(), batch.num_rows, [None, pa.py_buffer((starts * 4).astype(np.int32).tobytes()), data])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in others), made], names=[*(f.name for f in others), "ids"])

    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in others), "ids binary"])
    return df.mapInArrow(run, schema)


def boundaries(pattern: regex.Pattern, text: str, complete: bool) -> list[int]:
    """Ends of the pre-tokens; of a cut text without the last, which may go on."""
    ends = [m.end() for m in pattern.finditer(text)]
    return ends if complete else ends[:-2]


def _pieces(long: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """(key, piece, text) of (key, text): chunks stitched where their boundaries agree."""
    chunks = long.select(
        "key", F.ceil(F.length("text") / chunk).cast("int").alias("n"),
        F.explode(F.expr(
            f"transform(sequence(0, cast(ceil(length(text) / {chunk}) AS int) - 1),"
            f" i -> struct(i, substring(text, i * {chunk} + 1, {chunk + overlap}) AS text))")).alias("c"),
    ).select("key", "n", "c.i", "c.text").repartition("key", "i")

    def run(batches):
        compiled = regex.compile(pattern)
        for batch in batches:
            rows = batch.to_pylist()
            out = []
            for r in rows:
                ends = boundaries(compiled, r["text"], r["i"] + 1 == r["n"])
                # After a non-space and a space any start has met the true boundaries.
                sure = r["i"] == 0 or regex.search(r"\S ", r["text"], 0, chunk) is not None
                out.append(r | {"heads": [e for e in ends if e <= overlap],
                                "tails": [e - chunk for e in ends if chunk < e] if sure else []})
            yield pa.RecordBatch.from_pylist(out, pa.schema([
                ("key", pa.string()), ("n", pa.int32()), ("i", pa.int32()), ("text", pa.string()),
                ("heads", pa.list_(pa.int32())), ("tails", pa.list_(pa.int32()))]))

    cut = chunks.mapInArrow(run, "key string, n int, i int, text string, heads array<int>, tails array<int>")
    order = Window.partitionBy("key").orderBy("i")
    cut = (
        cut.withColumn("stop", F.array_min(F.array_intersect("tails", F.lead("heads").over(order))))
        .withColumn("start", F.lag("stop").over(order))
        .withColumn("piece", F.sum(F.when(F.col("start").isNull(), 0).otherwise(1)).over(order)))
    part = F.expr(f"substring(text, coalesce(start, 0) + 1,"
                  f" {chunk} + coalesce(stop, 0) - coalesce(start, 0))")
    return (
        cut.select("key", "piece", F.struct("i", part.alias("text")).alias("part"))
        .groupBy("key", "piece")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("part")), lambda p: p.text), "").alias("text")))


def _join_ids(parts: DataFrame) -> DataFrame:
    """(key, ids) of (key, list of (piece, ids))."""

    def run(batches):
        for batch in batches:
            made = [b"".join(p["ids"] for p in sorted(row, key=lambda p: p["piece"]))
                    for row in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], names=["key", "ids"])

    return parts.mapInArrow(run, "key string, ids binary")


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = 1 << 15, overlap: int = 1 << 10,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids) for each row; ids are little-endian unsigned 32-bit integers."""
    rows = docs.selectExpr(f"`{doc_id}` doc_id", f"coalesce(`{text}`, '') text")
    short = _encode(rows.filter(F.length("text") <= chunk), path, pattern)
    long = rows.filter(F.length("text") > chunk).withColumn("key", F.sha2("text", 256))
    once = long.select("key", "text").dropDuplicates(["key"])
    pieces = _encode(_pieces(once, pattern, chunk, overlap), path, pattern)
    gathered = _join_ids(pieces.groupBy("key").agg(F.collect_list(F.struct("piece", "ids")).alias("parts")))
    return short.select("doc_id", "ids").unionByName(
        long.select("doc_id", "key").join(gathered, "key").select("doc_id", "ids"))


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with the raw bytes of its ids as column ``decoded``."""
    ship(encoded.sparkSession)

    def run(batches):
        coder = encoder(path, pattern)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            for i in range(0, batch.num_rows, 1000):
                part = batch.slice(i, 1000)
                made = [None if x is None else coder.decode(x) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(made, pa.binary())], names=[*part.schema.names, "decoded"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")
