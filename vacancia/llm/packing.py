"""Best-fit packing: best fit in tasks of mixed pieces, underfull bins merged in rounds.

Pieces are dealt out at random, so that every task has all sizes, and packed by best fit,
largest first. Bins that are full but for ``slack`` tokens are emitted; the others are dealt
out anew as items of the next round, to a ``fan_in``-th of the tasks, but to no fewer than
leave a task ``carry`` of them. So no task grows with the input, and the last one packs alone
only once the rest fits it. While more than that is open, rounds go on until no two bins
have merged, at most ``LEVELS`` times; then what is open is emitted as it is. Each round is written to the shared folder.

A document is its ids and the closing id; null and empty texts have the closing id alone.
Only longer documents are cut, so that all pieces but the first are full. Repeated rows and
ids are packed one by one, null ids stay null, further columns do not matter, an empty
table gives an empty table. Ties go by size, id, piece and checksum.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.bpe import encoder, slices
from vacancia.llm.common import ship, stored

#: Rounds that sequence numbers have room for, above 2 ** 19 tasks of 2 ** 32 bins each.
LEVELS = (1 << 12) - 1
_LEVEL_BITS = 51
_ITEM = "doc_id long, piece int, start long, length int, ids_crc32 long"
_KIND = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                   ("length", pa.int32()), ("ids_crc32", pa.int64())])


def pieces(docs: DataFrame, path: str, pattern: str, capacity: int,
           end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    ship(docs.sparkSession)
    last = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, pattern)
        for batch in slices(batches, 1):
            ids, starts = coder.block(pc.fill_null(batch.column(1).cast(pa.string()), ""))
            data, rows = memoryview(np.ascontiguousarray(ids, "<u4").tobytes()), []
            doc_ids = batch.column(0).to_pylist()
            for k, (a, b) in enumerate(zip(starts.tolist(), starts[1:].tolist(), strict=False)):
                n = b - a + 1
                at, stop = 0, (n - 1) % capacity + 1
                for piece in range(-(-n // capacity)):
                    crc = zlib.crc32(data[4 * (a + at):4 * min(a + stop, b)])
                    if stop == n:
                        crc = zlib.crc32(last, crc)
                    rows.append((doc_ids[k], piece, at, stop - at, crc))
                    at, stop = stop, stop + capacity
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _KIND, strict=True)],
                names=[f.name for f in _KIND])

    return docs.selectExpr(f"cast(`{doc_id}` AS long) doc_id", f"`{text}` text").mapInArrow(run, _ITEM)


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of positions; ``sizes`` come largest first."""
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]  # by room left
    room, bins = 0, []  # bit r of room: some bin has r left
    for i, size in enumerate(sizes):
        fitting = room >> size
        if fitting:
            left = size + (fitting & -fitting).bit_length() - 1
            b = open_bins[left].pop()
            if not open_bins[left]:
                room &= ~(1 << left)
        else:
            left, b = capacity, len(bins)
            bins.append([])
        bins[b].append(i)
        if left > size:
            open_bins[left - size].append(b)
            room |= 1 << (left - size)
    return bins


def _round(bins: DataFrame, capacity: int, slack: int) -> DataFrame:
    """Bins of each partition packed as items; ``done`` marks those to be emitted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = [m for batch in batches for m in batch.column(0).to_pylist()]
        sized = sorted(
            ((sum(x["length"] for x in m), m) for m in items),
            key=lambda s: (-s[0], [(x["doc_id"] is None, x["doc_id"] or 0, x["piece"], x["ids_crc32"]) for x in s[1]]))
        made = [(sum(sized[i][0] for i in b), [x for i in b for x in sized[i][1]])
                for b in best_fit([s for s, _ in sized], capacity)]
        made.sort(key=lambda b: b[0])
        place = TaskContext.get().partitionId()
        for at in range(0, len(made), 10_000):
            part = made[at:at + 10_000]
            yield pa.RecordBatch.from_arrays([
                pa.array([size >= capacity - slack for size, _ in part]),
                pa.array([(place << 32) + at + i for i in range(len(part))], pa.int64()),
                pa.array([m for _, m in part], pa.list_(_KIND)),
                pa.array([[0, *itertools.accumulate(x["length"] for x in m[:-1])] for _, m in part],
                         pa.list_(pa.int64()))], names=["done", "bin", "members", "offsets"])

    return bins.select("members").mapInArrow(
        run, f"done boolean, bin long, members array<struct<{_ITEM}>>, offsets array<long>")


def pack(items: DataFrame, capacity: int, slack: int = 4, fan_in: int = 8, carry: int = 50_000) -> DataFrame:
    """``items`` of :func:`pieces` with ``sequence_id, offset``."""
    items = stored(items, "pieces")
    full = items.filter(F.col("length") == capacity).select(
        *items.columns, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    members = F.array(F.struct(*items.columns)).alias("members")
    bins = items.filter(F.col("length") < capacity).select(members, F.monotonically_increasing_id().alias("bin"))
    count, level, emitted = bins.count(), 1, [full]
    places = max(1, items.rdd.getNumPartitions(), -(-count // carry))
    while True:
        dealt = bins.repartition(places, F.xxhash64("bin", F.lit(level)))
        made = stored(_round(dealt, capacity, slack), f"bins-{level}")
        total, still_open = made.agg(F.count("*"), F.count(F.when(~F.col("done"), 1))).first()
        fewer = min(places, max(1, -(-places // fan_in), -(-still_open // carry)))
        last = places == 1 or not still_open or (fewer == places and total == count) or level == LEVELS
        emitted.append(
            (made if last else made.filter("done"))
            .select((F.lit(level << _LEVEL_BITS) + F.col("bin")).alias("sequence_id"),
                    F.explode(F.arrays_zip("members", "offsets")).alias("x"))
            .select("x.members.*", "sequence_id", F.col("x.offsets").alias("offset")))
        if last:
            break
        bins, count, places, level = made.filter("NOT done"), still_open, fewer, level + 1
    out = emitted[0]
    for df in emitted[1:]:
        out = out.unionByName(df)
    return out
