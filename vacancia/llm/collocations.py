"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are grams one word shorter than the longest, edges are longest grams between overlapping
nodes, weighted by their places. Every place of a piece is one row: the longest gram that
begins there, shorter than the others only where the piece ends. Tasks add equal rows before
the shuffle. Weights of shorter grams are never counted but derived: what flows through a node
is the sum of its edges and of the rows that end in it, and so on down to pairs. Paths on
which nothing branches are compacted: a gram whose weight is also that of a longer one around
it has no place of its own and is dropped.

A pair of words below the least count is in no phrase that reaches it, so pieces end there
too; a triple below it is in none either, so no gram goes on through one. Pairs, then triples of
such pairs, are counted in ``2 ** SLOT_BITS`` slots of their hash, whose bits (a fixed 32 MB each) are
broadcast: slots that reach the count hold all frequent ones, the few rare ones among them only
cost rows. The weights of all grams that reach the count are exact.

A-Z are lower-cased. Pieces end at ``.,;:!?`` and line ends (``\\n`` to ``\\r``), words at spaces and
tabs. Everything is within a language, null ones are ``und``. Null, empty and blank texts have no
words; repeated rows count each time; ids and further columns do not matter; an empty table
gives an empty one. Words are told apart by 64 hash bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vacancia.llm.common import blocks, mixed, segment_hashes, ship, stored

#: Fixed values of the contract: piece ends and word ends.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"
UNKNOWN = "und"

ORDER = 5
PRUNED = (2, 3)  # grams whose rare ones end what is counted
SLOT_BITS = 28
BUCKET_BITS = 20  # slots of a bucket
_BLOCK = 1 << 21
_HELD = 1 << 21  # rows a task adds up before it passes them on
_STEP = np.uint64(0x9FB21C651E98DF25)
_WORDS = [f"w{i}" for i in range(1, ORDER + 1)]

_KIND = np.zeros(256, np.uint8)
_KIND[list(WORD_ENDS)] = 1
_KIND[list(PIECE_ENDS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _seed(lang: str) -> np.uint64:
    return np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))


class Tokens:
    """Words of some texts: where they lie, their hashes within their language, their pieces."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        data = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
        self.data = _LOWER[data]
        kind = _KIND[data]
        gap = kind > 0
        self.starts = np.flatnonzero(gap[:-1] & ~gap[1:]) + 1
        self.ends = np.flatnonzero(~gap[:-1] & gap[1:]) + 1
        begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
        names, which = np.unique(np.array(langs, object), return_inverse=True)
        self.langs = list(names)
        self.lang = which[np.searchsorted(begins, self.starts, "right") - 1]
        seeds = np.array([_seed(x) for x in names], np.uint64)
        self.words = mixed(segment_hashes(self.data, self.starts, self.ends) ^ seeds[self.lang])
        self.words[self.words == 0] = 1  # 0 is no word
        pieces = np.cumsum(kind == 2)[self.starts]
        self.joined = pieces[1:] == pieces[:-1]  # to the next word

    def slots(self, places: np.ndarray, m: int, slot_bits: int) -> np.ndarray:
        """Slots of the grams of ``m`` words from these places."""
        key = self.words[places]
        for j in range(1, m):
            key = mixed(key * _STEP + self.words[places + j])
        return key >> np.uint64(64 - slot_bits)

    def going(self, most: int, bits: list[np.ndarray], slot_bits: int) -> list[np.ndarray]:
        """By length, from 2 to ``most``: do so many words from a place stand in a piece, none of their
        grams in a slot whose bit is unset? ``bits`` are those of pairs, triples and so on."""
        on, out = self.joined, []
        for m in range(2, most + 1):
            on = on[:-1] & on[1:] if m > 2 else on.copy()
            if m - 2 < len(bits):
                places = np.flatnonzero(on)
                slot = self.slots(places, m, slot_bits)
                byte = bits[m - 2][(slot >> np.uint64(3)).astype(np.int64)]
                on[places] = (byte >> (7 - (slot & np.uint64(7))).astype(np.uint8)) & 1 > 0
            out.append(on)
        return out


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[Tokens]:
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for first, texts in blocks(batch.column(0).to_pylist(), _BLOCK):
            yield Tokens(texts, langs[first:first + len(texts)])


def _uniques(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted keys, first place of each, summed counts)."""
    order = np.argsort(keys, kind="stable")
    heads = np.flatnonzero(np.diff(keys[order], prepend=~keys[order][:1]))
    return keys[order[heads]], order[heads], np.add.reduceat(counts[order], heads) if len(heads) else counts[:0]


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, word, id, n): every word and its hash, added in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, counts, words, langs = [], [], [], []

        def made() -> pa.RecordBatch:
            key, at, n = _uniques(np.concatenate(ids), np.concatenate(counts))
            flat, names = np.concatenate(words), np.concatenate(langs)
            ids[:], counts[:], words[:], langs[:] = [key], [n], [flat[at]], [names[at]]
            return pa.RecordBatch.from_arrays(
                [pa.array(langs[0], pa.string()), pa.array([w.decode("utf-8", "replace") for w in words[0]]),
                 pa.array(key.view(np.int64)), pa.array(n)], names=["lang", "word", "id", "n"])

        for t in _tokens(batches):
            key, at, n = _uniques(t.words, np.ones(len(t.words), np.int64))
            whole = t.data.tobytes()
            found = np.empty(len(at), object)
            found[:] = [whole[a:b] for a, b in zip(t.starts[at].tolist(), t.ends[at].tolist(), strict=True)]
            ids.append(key)
            counts.append(n)
            words.append(found)
            langs.append(np.array(t.langs, object)[t.lang[at]])
            if sum(map(len, ids)) > _HELD:
                batch = made()
                if batch.num_rows > _HELD // 2:
                    yield batch
                    ids, counts, words, langs = [], [], [], []
        if ids:
            yield made()

    return docs.mapInArrow(run, "lang string, word string, id long, n long").groupBy("lang", "word", "id").agg(
        F.sum("n").alias("n"))


def frequent_slots(docs: DataFrame, least: int, slot_bits: int = SLOT_BITS, shorter: Sequence[Broadcast] = ()) -> np.ndarray:
    """Bits of the slots whose pairs occur ``least`` times or more, all together.

    With the bits of ``shorter`` grams, of pairs first, it is the next longer grams, as far as
    they go on through set bits. Tasks send sorted slots and counts, packed by ranges of slots; a range is a dense array in
    its bucket's task, whatever the input, and comes back as bits.
    """
    low, m = min(BUCKET_BITS, slot_bits), len(shorter) + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, counts, press = [], [], zstandard.ZstdCompressor(level=1)
        bits = [x.value for x in shorter]

        def packed() -> Iterator[pa.RecordBatch]:
            key, _, n = _uniques(np.concatenate(slots), np.concatenate(counts))
            cuts = np.searchsorted(key, np.arange(0, (1 << slot_bits) + 1, 1 << low).astype(np.uint64))
            for bucket in np.flatnonzero(np.diff(cuts)).tolist():
                a, b = cuts[bucket], cuts[bucket + 1]
                inner = np.diff(key[a:b] & np.uint64((1 << low) - 1), prepend=np.uint64(0)).astype("<u4")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([bucket]), pa.array([press.compress(inner.tobytes() + n[a:b].astype("<u4").tobytes())])],
                    names=["bucket", "packed"])

        for t in _tokens(batches):
            places = np.flatnonzero(t.going(m, bits, slot_bits)[-1])
            key, _, n = _uniques(t.slots(places, m, slot_bits), np.ones(len(places), np.int64))
            slots.append(key)
            counts.append(n)
            if sum(map(len, slots)) > 2 * _HELD:
                yield from packed()
                slots, counts = [], []
        if slots:
            yield from packed()

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        total, opened = np.zeros(1 << low, np.int64), zstandard.ZstdDecompressor()
        for part in table["packed"].to_pylist():
            both = np.frombuffer(opened.decompress(part), "<u4")
            inner, n = both[:len(both) // 2], both[len(both) // 2:]
            total[np.cumsum(inner)] += n
        return pa.table({"bucket": [key[0].as_py()], "bits": pa.array([np.packbits(total >= least).tobytes()])})

    rows = docs.mapInArrow(run, "bucket long, packed binary").groupBy("bucket").applyInArrow(
        add, "bucket long, bits binary").collect()
    bits = np.zeros(max(1, (1 << slot_bits) // 8), np.uint8)
    width = max(1, (1 << low) // 8)
    for row in rows:  # as many as there are ranges of slots, whatever the input
        bits[row.bucket * width:(row.bucket + 1) * width] = np.frombuffer(row.bits, np.uint8)
    return bits


def edges(docs: DataFrame, least: int, slot_bits: int = SLOT_BITS) -> DataFrame:
    """(lang, w1 ... w5, n): the longest gram from each place, null where its piece has ended.

    Places whose piece ends with their own word have no row.
    """
    shared = []
    for _ in PRUNED:
        shared.append(docs.sparkSession.sparkContext.broadcast(frequent_slots(docs, least, slot_bits, tuple(shared))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, parts, held = [x.value for x in shared], [], 0

        def made() -> pa.RecordBatch:
            grams, lang, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
            key = np.zeros(len(grams), np.uint64)
            for j in range(ORDER):
                key = mixed(key * _STEP + grams[:, j])
            _, at, n = _uniques(key, counts)
            parts[:] = [(grams[at], lang[at], n)]
            absent = grams[at] == 0
            return pa.RecordBatch.from_arrays(
                [pa.array(lang[at], pa.string()),
                 *(pa.array(grams[at][:, j].view(np.int64), mask=absent[:, j]) for j in range(ORDER)), pa.array(n)],
                names=["lang", *_WORDS, "n"])

        for t in _tokens(batches):
            going = t.going(ORDER, bits, slot_bits)
            places = np.flatnonzero(going[0])
            if not len(places):
                continue
            grams = np.zeros((len(places), ORDER), np.uint64)
            grams[:, 0], grams[:, 1] = t.words[places], t.words[places + 1]
            for j, on in enumerate(going[1:], 2):
                longer = np.flatnonzero(np.append(on, np.zeros(j, bool))[places])
                grams[longer, j] = t.words[places[longer] + j]
            parts.append((grams, np.array(t.langs, object)[t.lang[places]], np.ones(len(places), np.int64)))
            held += len(places)
            if held > _HELD:
                batch = made()
                held = batch.num_rows
                if held > _HELD // 2:
                    yield batch
                    parts, held = [], 0
        if parts:
            yield made()

    columns = ", ".join(f"{w} long" for w in _WORDS)
    return docs.mapInArrow(run, f"lang string, {columns}, n long").groupBy("lang", *_WORDS).agg(F.sum("n").alias("n"))


def flows(edge_rows: DataFrame, least: int) -> DataFrame:
    """(lang, gram array<long>, a): grams of two words or more that occur ``least`` times."""
    level = edge_rows.filter(F.col(_WORDS[-1]).isNotNull())
    found = [level]
    for m in range(ORDER - 1, 1, -1):
        kept = ["lang", *_WORDS[:m]]
        ended = edge_rows.filter(F.col(_WORDS[m - 1]).isNotNull() & F.col(_WORDS[m]).isNull())
        through = level.select(*kept, "n").unionByName(ended.select(*kept, "n"))
        level = stored(through.groupBy(*kept).agg(F.sum("n").alias("n")), f"flow-{m}")
        found.append(level)
    out = None
    for m, level in zip(range(ORDER, 1, -1), found, strict=True):
        rows = level.filter(F.col("n") >= least).select("lang", F.array(*_WORDS[:m]).alias("gram"), F.col("n").alias("a"))
        out = rows if out is None else out.unionByName(rows)
    return out


def cut_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)), exact for counts below 10**17."""
    wide = lambda c: c.cast("decimal(17,0)")
    above = (wide(a) * wide(n)).cast("decimal(34,0)") * F.lit(1000).cast("decimal(4,0)")
    return F.call_function("div", above, (wide(left) * wide(right)).cast("decimal(34,0)"))


def mine(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, top: int = 2000,
         slot_bits: int = SLOT_BITS) -> DataFrame:
    """The ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(text).cast("string").alias("text"),
                       F.coalesce(F.col(lang).cast("string"), F.lit(UNKNOWN)).alias("lang"))
    words = stored(count_words(docs), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    grams = stored(flows(stored(edges(docs, least, slot_bits), "edges"), least), "grams")
    known = grams.select("gram", "a").unionByName(
        words.filter(F.col("n") >= least).select(F.array("id").alias("gram"), F.col("n").alias("a")))

    # Compaction: a longer gram of the same weight takes every place of the shorter one.
    size = F.size("gram")
    around = grams.filter(size > 2).select(
        F.explode(F.array(F.slice("gram", F.lit(1), size - 1), F.slice("gram", F.lit(2), size - 1))).alias("gram"), "a")
    own = grams.join(around, ["gram", "a"], "left_anti")

    cuts = own.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).withColumns(
        {"left": F.slice("gram", F.lit(1), F.col("k")), "right": F.slice("gram", F.col("k") + 1, size - F.col("k"))})
    lefts, rights = (known.select(F.col("gram").alias(s), F.col("a").alias(x)) for s, x in (("left", "l"), ("right", "r")))
    scored = cuts.join(lefts, "left").join(rights, "right").join(F.broadcast(totals), "lang")
    # As many rows as languages: the totals are small whatever the texts.
    best = scored.groupBy("lang", "gram").agg(F.min(F.struct(
        cut_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")).alias("score"), "k", "a", "l", "r", "n")).alias("cut"))
    best = stored(best.select("lang", "gram", "cut.*"), "scored")

    by_rank = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = best.withColumn("_rank", F.rank().over(by_rank)).filter(F.col("_rank") <= top)  # ties at the end stay
    spelled = first.select("lang", "gram", F.posexplode("gram").alias("at", "id")).join(
        words.filter(F.col("n") >= least).select("id", "word"), "id")
    phrases = spelled.groupBy("lang", "gram").agg(F.concat_ws(" ", F.transform(
        F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x.word)).alias("phrase"))
    ordered = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return first.join(phrases, ["lang", "gram"]).withColumn("rank", F.row_number().over(ordered).cast("long")).filter(
        F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
