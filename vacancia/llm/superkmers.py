"""Substring dedup: windows of k words counted in buckets of shared minimisers.

The minimiser of a window is its least word by hash, with very common words last.
Consecutive windows of one minimiser travel as one packed string to the minimiser's bucket,
where sorting finds every window's smallest document id. A string seen in several
documents of a task goes once, for the smallest of them; windows of the others are known to
be covered, so a passage or text with very many copies is one string from each task. Words
of more than about one in 20,000 are common: passages that many documents share then meet
only where they are equal, not where each goes on differently.

Windows are told apart by 128 hash bits. Rows of equal id and text count as one document,
so ids may repeat; rows without an id neither cover nor lose words. Null and short texts lose
nothing. Further columns do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import blocks, mixed, segment_hashes, ship, spread, stored, words_of

COMMON = 1 / 20_000
BUCKET_BYTES = 4_000_000
_FLUSH = 12 << 20
_BLOCK = 1 << 20
_RANGES = "doc_id long, version long, starts array<int>, stops array<int>"
_INTS = pa.list_(pa.int32())


def common_words(docs: DataFrame, share: float = COMMON) -> tuple[np.ndarray, int]:
    """(hashes of words above ``share`` of all words, bytes of all texts).

    A task reports words above half the share among its own; any word above the share of
    all words has at least half of it in such reports. At most 2 / share words come back.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in blocks(batch.column(0).to_pylist(), _BLOCK):
                whole, starts, ends, _ = spread(texts)
                words, counts = np.unique(
                    segment_hashes(np.frombuffer(whole, np.uint8), starts, ends), return_counts=True)
                found = counts >= max(2, share / 2 * len(starts))
                yield pa.RecordBatch.from_arrays([
                    pa.array([0, *words[found].view(np.int64)]), pa.array([len(starts), *counts[found]], pa.int64()),
                    pa.array([len(whole), *[0] * int(found.sum())], pa.int64())], names=["word", "n", "size"])

    counted = stored(docs.select("text").mapInArrow(run, "word long, n long, size long").groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("size").alias("size")), "words")
    total = counted.filter("size > 0").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).first()
    if not total.n:
        return np.empty(0, np.uint64), total.size or 0
    rows = counted.filter(F.col("n") >= share / 2 * total.n).filter("size = 0").select("word").toArrow()
    return np.sort(rows["word"].to_numpy().astype(np.int64).view(np.uint64)), total.size


def _least(rank: np.ndarray, k: int) -> np.ndarray:
    """Minimum of every k consecutive values."""
    out, width = rank, 1
    while 2 * width <= k:
        out, width = np.minimum(out[:-width], out[width:]), 2 * width
    return np.minimum(out[:len(rank) - k + 1], out[k - width:]) if k > width else out


def _range_rows(doc: np.ndarray, version: np.ndarray, start: np.ndarray, stop: np.ndarray) -> list[pa.Array]:
    """One row for each document of word ranges, overlapping ones merged."""
    order = np.lexsort((stop, start, version, doc))
    doc, version, start, stop = doc[order], version[order], start[order], stop[order]
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (version[1:] != version[:-1])
    of = np.cumsum(other)
    # Ends so far within a document: documents are lifted apart, then compared at once.
    lift = of * (int(stop.max(initial=0)) + 1)
    reach = np.maximum.accumulate(stop + lift) - lift
    fresh = other.copy()
    fresh[1:] |= start[1:] > reach[:-1]
    heads = np.flatnonzero(fresh)
    last = np.append(heads[1:], len(doc))[:len(heads)] - 1
    offsets = pa.array(np.append(np.flatnonzero(other[heads]), len(heads)).astype(np.int32))
    firsts = np.flatnonzero(other)
    return [pa.array(doc[firsts]), pa.array(version[firsts]),
            pa.ListArray.from_arrays(offsets, pa.array(start[heads].astype(np.int32))),
            pa.ListArray.from_arrays(offsets, pa.array(reach[last].astype(np.int32)))]


class _Packer:
    """Super-k-mers of a task: equal strings meet before they travel."""

    NAMES = ["bucket", "text", "numbers", "places", "doc_id", "version", "starts", "stops"]

    def __init__(self, k: int, common: np.ndarray, buckets: int):
        self.k, self.common, self.buckets = k, common, buckets
        self.parts, self.held, self.turn = [], 0, 0
        self.press = zstandard.ZstdCompressor(level=3)

    def add(self, texts: list[bytes], ids: np.ndarray, versions: np.ndarray) -> None:
        k = self.k
        whole, starts, ends, begins = spread(texts)
        if len(starts) < k:
            return
        data = np.frombuffer(whole, np.uint8)
        word = segment_hashes(data, starts, ends)
        rank = word >> np.uint64(1)
        if len(self.common):
            near = np.minimum(np.searchsorted(self.common, word), len(self.common) - 1)
            rank = rank | ((self.common[near] == word).astype(np.uint64) << np.uint64(63))
        least = _least(rank, k)
        doc = np.repeat(np.arange(len(texts)), np.diff(begins))
        inside = doc[:len(least)] == doc[k - 1:]
        new = ~inside
        new[0] = True
        new[1:] |= (least[1:] != least[:-1]) | (doc[1:len(least)] != doc[:len(least) - 1])
        edges = np.flatnonzero(new)
        stops = np.append(edges[1:], len(least))
        real = inside[edges]
        edges, stops = edges[real], stops[real]
        if not len(edges):
            return
        a, b, of = starts[edges], ends[stops + k - 2], doc[edges]
        # Words apart by anything but one space are joined by one.
        odd = np.concatenate([[0], np.cumsum((starts[1:] - ends[:-1] != 1) | (data[ends[:-1]] != 0x20))])
        odd = odd[stops + k - 2] > odd[edges]
        self.parts.append((
            segment_hashes(data, a, b) ^ mixed((b - a).astype(np.uint64)), ids[of], versions[of],
            edges - begins[of], stops - edges + k - 1, mixed(least[edges]) % np.uint64(self.buckets),
            a, b, odd, np.full(len(edges), len(self.parts)), whole))
        self.held += len(whole)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.parts:
            return
        *columns, wholes = zip(*self.parts, strict=True)
        string, doc, version, at, size, bucket, a, b, odd, part = map(np.concatenate, columns)
        self.parts, self.held, self.turn = [], 0, self.turn + 1
        order = np.lexsort((at, version, doc, string))
        string, doc, version, at = string[order], doc[order], version[order], at[order]
        head = np.ones(len(order), bool)
        head[1:] = string[1:] != string[:-1]
        # A document after the smallest one that has the string loses all of it.
        stays = doc == doc[head][np.cumsum(head) - 1]
        gone = ~stays
        if gone.any():
            rows = _range_rows(doc[gone], version[gone], at[gone], at[gone] + size[order][gone])
            n = len(rows[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array((np.arange(n) + self.turn) % self.buckets), *(pa.nulls(n, pa.binary()) for _ in range(3)), *rows],
                names=self.NAMES)
        first = np.ones(len(order), bool)
        first[1:] = head[1:] | (doc[1:] != doc[:-1]) | (version[1:] != version[:-1])
        first, order = first[stays], order[stays]
        doc, version, at = doc[stays], version[stays], at[stays].astype("<i4")
        firsts = np.flatnonzero(first)
        many = np.diff(np.append(firsts, len(order)))
        by_bucket = np.argsort(bucket[order[firsts]], kind="stable")
        found, cuts = np.unique(bucket[order[firsts]][by_bucket], return_index=True)
        for which, rows in zip(found.tolist(), np.split(by_bucket, cuts[1:]), strict=True):
            pick = order[firsts[rows]]
            text = b"\n".join(
                b" ".join(wholes[p][x:y].split()) if z else wholes[p][x:y] for p, x, y, z in zip(
                    part[pick].tolist(), a[pick].tolist(), b[pick].tolist(), odd[pick].tolist(), strict=True))
            n = many[rows]
            places = at[np.repeat(firsts[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            numbers = np.stack([doc[firsts[rows]], version[firsts[rows]], n]).astype("<i8")
            yield pa.RecordBatch.from_arrays([
                pa.array([which], pa.int64()), pa.array([self.press.compress(text)], pa.binary()),
                pa.array([self.press.compress(numbers.tobytes())], pa.binary()),
                pa.array([self.press.compress(places.tobytes())], pa.binary()),
                pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, _INTS), pa.nulls(1, _INTS)],
                names=self.NAMES)


def _strings(docs: DataFrame, k: int, heavy: np.ndarray, buckets: int) -> DataFrame:
    """Packed strings by bucket, and ranges already known, from (doc_id, version, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(heavy)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = _Packer(k, shared.value, buckets)
        for batch in batches:
            ids, versions = (batch.column(i).to_numpy() for i in (0, 1))
            for first, texts in blocks(batch.column(2).to_pylist(), _BLOCK):
                packer.add(texts, ids[first:], versions[first:])
                if packer.held > _FLUSH:
                    yield from packer.flush()
        yield from packer.flush()

    return docs.select("doc_id", "version", "text").mapInArrow(
        run, f"bucket long, text binary, numbers binary, places binary, {_RANGES}")


def _windows(packed: bytes, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(two hashes, string, place in the string) of all windows of the lines of ``packed``."""
    whole = b"\n" + packed + b"\n"
    data = np.frombuffer(whole, np.uint8)
    starts, ends = words_of(data)
    word = segment_hashes(data, starts, ends)
    n = len(word) - k + 1
    one, two = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    other = mixed(word ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    for j in range(k):
        one = one * np.uint64(0x9FB21C651E98DF25) + word[j:j + n]
        two = two * np.uint64(0xD6E8FEB86659FD93) + other[j:j + n]
    lines = np.flatnonzero(data == 0x0A)[:-1]
    string = np.searchsorted(lines, starts) - 1
    begins = np.searchsorted(starts, lines)
    inside = string[:n] == string[k - 1:]
    string = string[:n][inside]
    return one[inside], two[inside], string, np.flatnonzero(inside) - begins[string]


def _settle(rows: list[dict], k: int) -> list[pa.Array] | None:
    """Ranges of one bucket's strings that windows of smaller ids cover."""
    opened, parts, many = zstandard.ZstdDecompressor(), [], 0
    numbers, places = [], []
    for row in rows:
        one, two, string, place = _windows(opened.decompress(row["text"]), k)
        parts.append((one, two, string + many, place))
        numbers.append(np.frombuffer(opened.decompress(row["numbers"]), "<i8").reshape(3, -1))
        places.append(np.frombuffer(opened.decompress(row["places"]), "<i4"))
        many += numbers[-1].shape[1]
    one, two, string, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    (doc, version, copies), places = np.concatenate(numbers, axis=1), np.concatenate(places)
    order = np.argsort(one, kind="stable")
    same = one[order][1:] == one[order][:-1]
    if (same & (two[order][1:] != two[order][:-1])).any():
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    smallest = np.minimum.reduceat(doc[string[order]], heads)
    covered = np.zeros(len(order), bool)
    covered[order] = np.repeat(smallest, np.diff(np.append(heads, len(order)))) < doc[string[order]]
    hit = np.flatnonzero(covered)
    if not len(hit):
        return None
    # Each covered window, at every place its string has in its document.
    s = string[hit]
    n = copies[s]
    at = places[np.repeat((np.cumsum(copies) - copies)[s] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
    start = at + np.repeat(place[hit], n)
    return _range_rows(np.repeat(doc[s], n), np.repeat(version[s], n), start, start + k)


def covered_ranges(docs: DataFrame, k: int = 13) -> DataFrame:
    """(doc_id, version, starts, stops): word ranges covered by windows of smaller ids."""
    heavy, size = common_words(docs)
    buckets = max(16, size // BUCKET_BYTES)

    def settle(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        known = table.filter(pc.is_valid(table["starts"])).select(["doc_id", "version", "starts", "stops"])
        rows = table.filter(pc.is_valid(table["text"])).select(["text", "numbers", "places"]).to_pylist()
        found = _settle(rows, k) if rows else None
        if found is None:
            return known
        return pa.concat_tables([known, pa.Table.from_arrays(
            found, names=["doc_id", "version", "starts", "stops"]).cast(known.schema)])

    packed = _strings(docs.filter("doc_id IS NOT NULL"), k, heavy, buckets)
    return packed.groupBy("bucket").applyInArrow(settle, _RANGES)


def dedup(docs: DataFrame, k: int = 13, doc_id: str = "doc_id", text: str = "text", keep_row: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) of every document; ``kept`` are its other words.

    ``keep_row`` adds the document's own columns but the text as the struct ``row``, and
    ``text``: as it was where nothing is removed, else the kept words.
    """
    ship(docs.sparkSession)
    whole = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"),
                        F.xxhash64(F.coalesce(text, F.lit(""))).alias("version"),
                        *[F.struct(*(c for c in docs.columns if c != text)).alias("row")] * keep_row)
    ranges = stored(covered_ranges(whole.select("doc_id", "version", "text"), k), "ranges")
    merged = ranges.groupBy("doc_id", "version").agg(
        F.collect_list("starts").alias("starts"), F.collect_list("stops").alias("stops"))
    both = whole.join(merged, ["doc_id", "version"], "left").select(
        "doc_id", "text", F.flatten("starts").alias("starts"), F.flatten("stops").alias("stops"), *["row"] * keep_row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for t, starts, stops in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                words = (t or "").encode("utf-8", "replace").split()
                n, removed = len(words), 0
                if starts:
                    gone = np.zeros(n + 1, np.int32)
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, stops, -1)
                    keep = np.cumsum(gone[:n]) == 0
                    removed = n - int(keep.sum())
                    words = [w for w, x in zip(words, keep.tolist(), strict=True) if x]
                kept = b" ".join(words).decode()
                out.append((n, removed, kept, kept if removed else t))
            n, removed, kept, texts = zip(*out, strict=True) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string()),
                 *batch.columns[4:], *[pa.array(texts, pa.string())] * keep_row],
                names=["doc_id", "n_words", "n_removed", "kept", *["row", "text"] * keep_row])

    row = f", row {both.schema['row'].dataType.simpleString()}, text string" if keep_row else ""
    return both.mapInArrow(run, f"doc_id long, n_words long, n_removed long, kept string{row}")
