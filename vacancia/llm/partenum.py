"""N-gram Jaccard join by PartEnum signatures.

Sets of w-word shingles that are similar enough differ in at most k shingles, k known from
their sizes. Sizes fall into bands; a set signs for its own band and the next, so that
similar sets sign for one band together. For a band the shingle domain is hashed into
groups of three partitions, as many groups as leave one group of any similar pair with at
most one differing partition. A signature is what a set has in two of the three partitions
of a group: all three choices are signed, so similar sets share a signature. A set with
nothing in some choice also signs each shingle of its prefix (the smallest hashes, as many
as any similar set must hit) for that band, which is exact for pairs that agree in empty choices only.

Signatures meet in buckets, where the first holder of each is the pivot of the others.
Histograms of the sets' hashes give a lower bound of their difference: members beyond it are
compared with each other by these, and may become pivots of their own. Exact similarity of
what is left is checked on whole sets. Members of a pivot that are not all
in one component then are compared with each other by their differences to the pivot, in
blocks that return a forest of links. Equal sets are one class before all this.

Texts are lower-cased (A-Z); fewer than w words are one shingle; empty and null texts have
an empty set and are linked with nothing. Rows without an id sign nothing: they are linked as
equal sets only, by the name of their set.
Repeated rows and ids and further columns do not matter. Hashes of shingles have 64
bits, of classes 128.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import blocks, mixed, segment_hashes, ship, spread, stored
from vacancia.llm.components import components

CHOICES = ((0, 1), (0, 2), (1, 2))  # two of a group's three partitions
_FLUSH = 48 << 20
_BLOCK = 1024  # members of a pivot in one task
_BUCKET_CHARS = 4_000_000
RADII = (1, 2, 4, 16)  # of new pivots, in limits of a link
_U = np.uint64


class Bands:
    """Size bands, and the groups of partitions of each, for similarity ``percent``."""

    def __init__(self, percent: int, largest: int = 1 << 30):
        self.percent = percent
        first = percent // (100 - percent)  # smaller sets are similar only if equal
        lows = [max(1, first)]
        while lows[-1] <= largest:
            lows.append(lows[-1] * 100 // percent + 1)
        self.lows = np.array(lows)
        high = self.lows[1:] - 1  # of each band
        # Signing for a band: sets of the band below it up to those they may be similar to.
        reach = high + np.minimum(high * 100 // percent, high * 2)
        differ = reach * (100 - percent) // (100 + percent)
        self.groups = np.concatenate([[1], differ // 2 + 1])  # a differing pair in each but one

    def of(self, sizes: np.ndarray) -> np.ndarray:
        """Band of each size, -1 for sizes that only equal sets are similar to."""
        return np.searchsorted(self.lows, sizes, "right") - 1

    def prefix(self, size: int) -> int:
        return size - -(-size * self.percent // 100) + 1


def shingle_sets(texts: list[bytes], w: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, sizes): sorted distinct shingle hashes of each lower-cased text, in a row."""
    whole, starts, ends, begins = spread(texts)
    word = segment_hashes(np.frombuffer(whole, np.uint8), starts, ends)
    counts = np.diff(begins)
    made = np.maximum(counts - w + 1, np.minimum(counts, 1))
    hashes, at = np.empty(int(made.sum()), np.uint64), np.cumsum(made) - made
    long = counts >= w
    n = max(0, len(word) - w + 1)
    rolled = np.zeros(n, np.uint64)
    for j in range(w):
        rolled = rolled * _U(0x9FB21C651E98DF25) + word[j:j + n]
    doc = np.repeat(np.arange(len(texts)), counts)
    inside = doc[:n] == doc[w - 1:w - 1 + n] if n else np.empty(0, bool)
    hashes[np.repeat(long, made)] = mixed(rolled[inside])
    for i in np.flatnonzero((counts > 0) & ~long).tolist():
        h = counts[i]
        for x in word[begins[i]:begins[i + 1]].tolist():
            h = (int(h) * 0xD6E8FEB86659FD93 + x) & 0xFFFFFFFFFFFFFFFF
        hashes[at[i]] = mixed(np.array([h], np.uint64))[0]
    for a, b in zip(at.tolist(), (at + made).tolist(), strict=True):
        hashes[a:b].sort()
    of = np.repeat(np.arange(len(texts)), made)
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (of[1:] != of[:-1])
    return hashes[new], np.bincount(of[new], minlength=len(texts))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of runs of ``sizes`` values."""
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def digests(hashes: np.ndarray, sizes: np.ndarray) -> list[str]:
    """128-bit name of each set; "" for empty sets."""
    one, two = _sums(mixed(hashes), sizes), _sums(mixed(hashes ^ _U(0x5851F42D4C957F2D)), sizes)
    return [f"{a:016x}{b:016x}" if n else "" for a, b, n in zip(one.tolist(), two.tolist(), sizes.tolist(), strict=True)]


def signatures(hashes: np.ndarray, sizes: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(signature, set) pairs of sets in a row."""
    out, who = [], []
    begins = np.cumsum(sizes) - sizes
    band = bands.of(sizes)
    place, value = mixed(hashes ^ _U(0x2545F4914F6CDD1D)), mixed(hashes)
    of = np.repeat(np.arange(len(sizes)), sizes)
    signing = band >= 0
    for step in (0, 1):
        groups = np.where(signing, bands.groups[np.maximum(band, 0) + step], 0)
        if step == 0:
            groups = np.where(band == 0, 0, groups)  # no band below the first
        cells = np.cumsum(3 * groups) - 3 * groups
        mine = groups[of] > 0
        d, p = of[mine], place[mine]
        cell = cells[d] + 3 * ((p >> _U(32)) * groups[d].astype(np.uint64) >> _U(32)).astype(np.int64) \
            + ((p & _U(0xFFFFFFFF)) * _U(3) >> _U(32)).astype(np.int64)
        total = int(3 * groups.sum())
        sums = np.zeros(total, np.uint64)
        np.add.at(sums, cell, value[mine])
        filled = np.bincount(cell, minlength=total) > 0
        owner = np.repeat(np.arange(len(sizes)), groups)
        group = np.arange(len(owner)) - (np.cumsum(groups) - groups)[owner]
        tag = mixed(((band[owner] + step).astype(np.uint64) << _U(40)) + group.astype(np.uint64))
        bare = np.zeros(len(sizes), bool)
        for c, (x, y) in enumerate(CHOICES):
            have = filled[x::3] | filled[y::3]
            out.append(mixed(sums[x::3] + sums[y::3] + tag + _U(c))[have])
            who.append(owner[have])
            bare[owner[~have]] = True
        for i in np.flatnonzero(bare).tolist():
            prefix = hashes[begins[i]:begins[i] + bands.prefix(int(sizes[i]))]
            out.append(mixed(prefix ^ mixed(_U(0x14057B7EF767814F) + np.array([band[i] + step], np.uint64))))
            who.append(np.full(len(prefix), i))
    return np.concatenate(out), np.concatenate(who)


def _lowered(texts: list[str | None]) -> list[str]:
    """A-Z lowered, nothing else."""
    return [(t or "").encode("utf-8", "replace").lower().decode() for t in texts]


def _meet(docs: DataFrame, w: int, percent: int, buckets: int) -> DataFrame:
    """Rows (a, b, cls, doc_id, n): nodes of every document, and pairs with one signature.

    A row of a document has its node as ``a`` and null as ``b``. Equal sets of one task
    and flush share a node.
    """

    def flush(place: int, sigs: list, nodes: list) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        sig, node = np.concatenate(sigs), np.concatenate(nodes)
        order = np.argsort(sig)
        sig, node = sig[order], node[order]
        # Buckets are ranges of the signature: each part is sorted already.
        cuts = np.searchsorted(sig, (np.arange(1, buckets) * (2**64 / buckets)).astype(np.uint64))
        for bucket, (s, x) in enumerate(zip(np.split(sig, cuts), np.split(node, cuts), strict=True)):
            if len(s):
                yield record(bucket, packer.compress(np.diff(s, prepend=_U(0)).tobytes()),
                             packer.compress((x - (place << 24)).astype("<u4").tobytes()), place << 24)

    def record(bucket, sigs, nodes, base, rows=None):
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int64()), pa.array([sigs], pa.binary()), pa.array([nodes], pa.binary()),
             pa.array([base], pa.int64()), *(pa.array([c], pa.list_(k)) for c, k in zip(rows or [None] * 4, kinds, strict=True))],
            names=["bucket", "sigs", "nodes", "base", "node", "cls", "doc_id", "n"])

    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(percent)
        task, part = TaskContext.get().partitionId(), 0
        seen: dict[str, int] = {}
        signed: set[str] = set()
        sigs, nodes, held = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for first, texts in blocks(_lowered(batch.column(1).to_pylist()), 1 << 20):
                hashes, sizes = shingle_sets(texts, w)
                names = digests(hashes, sizes)
                base = (task << 12 | part) << 24
                fresh = np.zeros(len(names), bool)
                for i, c in enumerate(names):
                    seen.setdefault(c, len(seen))
                    # Rows without an id do not sign: no pivot may lack an id.
                    if c and ids[first + i] is not None and c not in signed:
                        signed.add(c)
                        fresh[i] = True
                node = np.array([base + seen[c] for c in names], np.int64)
                yield record((task + first) % buckets, None, None, None,
                             [node.tolist(), names, ids[first:first + len(texts)], sizes.tolist()])
                if fresh.any():
                    s, at = signatures(hashes[np.repeat(fresh, sizes)], sizes[fresh], bands)
                    sigs.append(s)
                    nodes.append(node[fresh][at])
                held += sum(map(len, texts))
                if held > _FLUSH or len(seen) > 1 << 22:
                    yield from flush(task << 12 | part, sigs, nodes)
                    part, held, seen, signed = part + 1, 0, {}, set()
                    sigs, nodes = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        yield from flush(task << 12 | part, sigs, nodes)

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        opened = zstandard.ZstdDecompressor()
        sigs, nodes, parts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], []
        for row in table.select(["sigs", "nodes", "base"]).to_pylist():
            if row["sigs"] is not None:
                sigs.append(np.cumsum(np.frombuffer(opened.decompress(row["sigs"]), "<u8"), dtype=np.uint64))
                nodes.append(np.frombuffer(opened.decompress(row["nodes"]), "<u4").astype(np.int64) + row["base"])
        for row in table.select(["node", "cls", "doc_id", "n"]).to_pylist():
            if row["node"] is not None:
                parts.append(pa.table([
                    pa.array(row["node"], pa.int64()), pa.nulls(len(row["node"]), pa.int64()),
                    pa.array(row["cls"], pa.string()), pa.array(row["doc_id"], pa.int64()),
                    pa.array(row["n"], pa.int64())], names=names))
        sig, node = np.concatenate(sigs), np.concatenate(nodes)
        del sigs, nodes
        order = np.argsort(sig)
        sig, node = sig[order], node[order]
        del order
        shared = np.zeros(len(sig), bool)
        shared[1:] = sig[1:] == sig[:-1]
        shared[:-1] |= shared[1:]
        sig, node = sig[shared], node[shared]  # most signatures have one holder
        head = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.empty(0, np.int64)
        first = np.minimum.reduceat(node, head) if len(sig) else node
        pivot = np.repeat(first, np.diff(np.append(head, len(sig))))
        pairs = np.unique(np.stack([pivot, node], 1)[pivot != node], axis=0)
        parts.append(pa.table([
            pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.nulls(len(pairs), pa.string()),
            pa.nulls(len(pairs), pa.int64()), pa.nulls(len(pairs), pa.int64())], names=names))
        return pa.concat_tables(parts)

    names = ["a", "b", "cls", "doc_id", "n"]
    packed = docs.select("doc_id", "text").mapInArrow(
        run, "bucket long, sigs binary, nodes binary, base long, node array<long>, cls array<string>,"
             " doc_id array<long>, n array<long>")
    return packed.groupBy("bucket").applyInArrow(meet, "a long, b long, cls string, doc_id long, n long")


def _sets(docs: DataFrame, needed: DataFrame, w: int) -> DataFrame:
    """(cls, n, hist, text): one document of each needed class, with its set's histogram.

    Texts travel rather than sets: they are half as large and compress.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, texts = batch.column(1).to_pylist(), batch.column(0).to_pylist()
            for first, run in blocks(_lowered(texts), 1 << 20):
                hashes, sizes = shingle_sets(run, w)
                ends = np.cumsum(sizes)
                # An id may have several texts; only the wanted class counts.
                rows = [(c, n, histogram(hashes[e - n:e]).tobytes(), t) for c, name, e, n, t in zip(
                    wanted[first:], digests(hashes, sizes), ends.tolist(), sizes.tolist(), texts[first:], strict=False)
                    if c == name]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
                        (pa.string(), pa.int64(), pa.binary(), pa.string()))], names=["cls", "n", "hist", "text"])

    # The join has the rows of an id together: repeated rows go before their sets are made.
    rows = docs.join(needed, "doc_id").dropDuplicates(["doc_id", "cls", "text"])
    return stored(rows.select("text", "cls").mapInArrow(run, "cls string, n long, hist binary, text string"), "sets")


def histogram(hashes: np.ndarray) -> np.ndarray:
    """Counts of a set's hashes in equal ranges, a power of two of them, one byte each.

    Two sets differ in at least as many hashes as their counts differ by in all ranges.
    """
    bits = min(12, max(4, (len(hashes) // 2).bit_length()))
    return np.minimum(np.bincount((hashes >> _U(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def _folded(histograms: list[bytes]) -> np.ndarray:
    """Histograms as rows, all with the ranges of the coarsest."""
    width = min(map(len, histograms))
    return np.stack([np.frombuffer(h, np.uint8).reshape(width, -1).sum(1, dtype=np.int32) for h in histograms])


def _allowed(n, percent: int):
    """How many hashes two linked sets of together ``n`` may differ in."""
    return n * (100 - percent) // (100 + percent)


def _sorted_out(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(p, x, n, hist, far): members with their histograms; far ones cannot be linked to p."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far = [int(np.abs(np.subtract(*_folded([a, b]))).sum()) > _allowed(n + m, percent)
                   for n, a, m, b in zip(*(batch.column(c).to_pylist() for c in ("np", "hp", "n", "hist")), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("p"), batch.column("x"), batch.column("n"), batch.column("hist"), pa.array(far, pa.bool_())],
                names=["p", "x", "n", "hist", "far"])

    small = sets.select("cls", "n", "hist")
    return pairs.join(small.select(F.col("cls").alias("x"), "n", "hist"), "x").join(
        small.select(F.col("cls").alias("p"), F.col("n").alias("np"), F.col("hist").alias("hp")), "p").select(
        "p", "x", "np", "hp", "n", "hist").mapInArrow(run, "p string, x string, n long, hist binary, far boolean")


def _new_pairs(table: pa.Table, percent: int) -> list[tuple[str, str]]:
    """Pairs to check among members of one pivot of which at least one is far from it.

    Members of one component are not compared. A few pairs go as they are. Of many, far members
    become pivots until every far member is within a radius of one; a new pivot's members are
    all within that radius and the limit of a link, so that two linked ones share it (differences
    of histograms obey the triangle inequality). The radius grows until the pairs are few for
    each member: at the last one a pivot takes all members of similar size.
    """
    names, sizes, far = table["x"].to_pylist(), table["n"].to_numpy(), table["far"].to_numpy()
    _, root = np.unique(np.array(table["root"].to_pylist()), return_inverse=True)
    block, every = table["block"].to_numpy(), np.arange(len(names))
    cross = table["i"][0].as_py() != table["j"][0].as_py()
    histograms = [np.frombuffer(h, np.uint8) for h in table["hist"].to_pylist()]
    widths, folded = np.array([len(h) for h in histograms]), {}

    def alike(i: int, percent: int) -> np.ndarray:
        return 100 * np.minimum(sizes, sizes[i]) >= percent * np.maximum(sizes, sizes[i])

    def distance(i: int, to: np.ndarray) -> np.ndarray:
        """Differences of the histograms, in the ranges of the coarsest of them."""
        width = int(min(widths[i], widths[to].min()))
        if width not in folded:
            folded[width] = np.zeros((len(names), width), np.int32)
            for k in np.flatnonzero(widths >= width).tolist():
                folded[width][k] = histograms[k].reshape(width, -1).sum(1, dtype=np.int32)
        return np.abs(folded[width][to] - folded[width][i]).sum(1)

    rows, direct, most = np.flatnonzero(far).tolist(), [], 8 * len(names)
    for i in rows:
        to = alike(i, percent) & (root != root[i]) & (~far | (every > i))
        to = np.flatnonzero(to & (block != block[i]) if cross else to)
        if len(to):
            near = to[distance(i, to) <= _allowed(sizes[to] + sizes[i], percent)]
            direct += [(names[i], names[j]) for j in near.tolist()]
            if len(direct) > most:
                break
    else:
        return direct
    # Members just beyond the limit of each other would all be pivots: then the radius grows.
    for radius in RADII:
        covered, stars = np.zeros(len(names), bool), []
        for i in rows:
            if covered[i]:
                continue
            # A member's link may be as much larger or smaller again, and one limit further away.
            large = int(sizes[i]) * 100 // percent + 1
            reach = radius * _allowed(int(sizes[i]) + large, percent)
            beyond = reach + _allowed(large + large * 100 // percent + 1, percent)
            to = np.flatnonzero(alike(i, percent * percent // 100))
            d = distance(i, to)
            covered[to[(d <= reach) & alike(i, percent)[to]]] = True
            stars += [(names[i], names[j]) for j in to[d <= beyond].tolist() if j != i]
            if len(stars) > most and radius < RADII[-1]:
                break
        else:
            return stars
    return stars


def _dealt(members: DataFrame, blocks: DataFrame) -> DataFrame:
    """Members of pivots in blocks of about ``_BLOCK``, once for each two blocks to meet."""
    return (
        members.join(blocks, "p")
        .withColumn("block", F.pmod(F.xxhash64("x"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}).drop("other", "blocks"))


def _rooted(members: DataFrame, labels: DataFrame) -> DataFrame:
    """``members`` with the component of the pivot and of the member, themselves if alone."""
    root = lambda c: labels.select(F.col("node").alias(c), F.col("root").alias(f"r{c}"))
    return members.join(root("p"), "p", "left").join(root("x"), "x", "left").withColumns(
        {"p_root": F.coalesce("rp", "p"), "root": F.coalesce("rx", "x")}).drop("rp", "rx")


def _open_pivots(rooted: DataFrame, with_pivot: bool = True) -> DataFrame:
    """(p, blocks): pivots with several members, not all in one component (with the pivot's)."""
    apart = "low <> high" + " OR low <> p_root" * with_pivot
    return rooted.groupBy("p").agg(
        F.count("*").alias("m"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.first("p_root").alias("p_root")).filter(f"m > 1 AND ({apart})").select(
        "p", F.ceil(F.col("m") / _BLOCK).cast("int").alias("blocks"))


def _far_pairs(sorted_out: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(p, x): pairs to check because of members that are far from a pivot they share."""
    rooted = stored(_rooted(sorted_out, labels), "sorted-rooted")
    some_far = rooted.groupBy("p").agg(F.max("far").alias("far")).filter("far").select("p")
    open_pivots = _open_pivots(rooted, with_pivot=False).join(some_far, "p")

    def pair(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        made = _new_pairs(table.sort_by("x"), percent)
        return pa.table([pa.array([e[k] for e in made], pa.string()) for k in (0, 1)], names=["p", "x"])

    return _dealt(rooted, open_pivots).groupBy("p", "i", "j").applyInArrow(pair, "p string, x string").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, w: int, percent: int) -> DataFrame:
    """(p, x, linked, n_x, differ) of pivots and members, by exact Jaccard similarity.

    ``differ`` are the hashes that one of the two sets has, ``n_x`` the size of the member's.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [t for pair in zip(*(_lowered(batch.column(c).to_pylist()) for c in (2, 3)), strict=True) for t in pair]
            at = 0
            while at < len(both):
                size, stop = 0, at
                while stop < len(both) and (stop == at or size < 1 << 21):
                    size, stop = size + len(both[stop]) + len(both[stop + 1]), stop + 2
                hashes, sizes = shingle_sets([t.encode() for t in both[at:stop]], w)
                ends, rows = np.cumsum(sizes), []
                for i in range(0, len(sizes), 2):
                    x, y = (hashes[ends[k] - sizes[k]:ends[k]] for k in (i, i + 1))
                    differ = np.setxor1d(x, y, assume_unique=True)
                    common = (len(x) + len(y) - len(differ)) // 2
                    linked = 100 * common >= percent * (common + len(differ))
                    rows.append((linked, len(y), differ.astype("<u8").tobytes()))
                part = batch.slice(at // 2, (stop - at) // 2)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], *(pa.array([r[k] for r in rows], kind) for k, kind in enumerate(
                        (pa.bool_(), pa.int64(), pa.binary())))], names=["p", "x", "linked", "n_x", "differ"])
                at = stop

    side = lambda c: sets.select(F.col("cls").alias(c), F.col("text").alias(f"t{c}"))
    return pairs.join(side("p"), "p").join(side("x"), "x").select("p", "x", "tp", "tx").mapInArrow(
        run, "p string, x string, linked boolean, n_x long, differ binary")


def _shared(rows: list[np.ndarray]) -> np.ndarray:
    """How many hashes each two of the rows share, in strips of hashes that two rows have."""
    of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    _, at, count = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    twice = count[at] > 1
    column = (np.cumsum(count > 1) - 1)[at[twice]]
    of, width, total = of[twice], int((count > 1).sum()), np.zeros((len(rows), len(rows)), np.float32)
    for a in range(0, width, 2048):
        here = (column >= a) & (column < a + 2048)
        strip = np.zeros((len(rows), min(2048, width - a)), np.float32)
        strip[of[here], column[here] - a] = 1
        total += strip @ strip.T
    return total


def _joined_up(table: pa.Table, percent: int) -> list[tuple[str, str]]:
    """Links that connect members of one pivot, a spanning forest of them.

    With the differences to the pivot at hand, two members differ in what only one of them
    differs in.
    """
    items = [np.frombuffer(d, "<u8") for d in table["differ"].to_pylist()]
    names, sizes = table["x"].to_pylist(), table["n_x"].to_numpy()
    _, root = np.unique(np.array(table["root"].to_pylist()), return_inverse=True)
    block = table["block"].to_numpy()
    far = np.array([len(d) for d in items])
    differ = far[:, None] + far[None, :] - 2 * _shared(items)
    both = (sizes[:, None] + sizes[None, :] - differ) / 2
    linked = (100 * both >= percent * (both + differ)) & (root[:, None] != root[None, :])
    i, j = table["i"][0].as_py(), table["j"][0].as_py()
    if i != j:  # pairs inside a block are met in its own task
        linked &= block[:, None] != block[None, :]
    edges, seen = [], np.zeros(len(names), bool)
    for start in range(len(names)):
        if seen[start]:
            continue
        seen[start], reached = True, [start]
        while reached:
            x = reached.pop()
            fresh = np.flatnonzero(linked[x] & ~seen)
            seen[fresh] = True
            edges += [(names[x], names[y]) for y in fresh.tolist()]
            reached += fresh.tolist()
    return edges


def _further(tested: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): links among members of one pivot that the links to pivots leave apart.

    Only pivots with a member of another component matter. Members are dealt to blocks of
    about ``_BLOCK``, and each two blocks meet in a task, which returns a forest: neither
    rows nor memory grow with the square of a group.
    """
    rooted = _rooted(tested.select("p", "x", "n_x", "differ"), labels)
    members = _dealt(rooted, _open_pivots(rooted))

    def settle(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        edges = _joined_up(table, percent) if table.num_rows > 1 else []
        return pa.table([pa.array([e[k] for e in edges], pa.string()) for k in (0, 1)], names=["a", "b"])

    return members.groupBy("p", "i", "j").applyInArrow(settle, "a string, b string")


def link(docs: DataFrame, w: int = 3, percent: int = 90, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each document; links hold at ``percent`` and more."""
    ship(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    # Buckets grow with the texts and with the signatures of a shingle, a task's part does not.
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 8 + int(size * 8 * (100 - percent) / 100 / _BUCKET_CHARS)
    met = stored(_meet(docs, w, percent, buckets), "met")
    rows = met.filter("b IS NULL").select(F.col("a").alias("node"), "cls", "doc_id", "n")
    of = rows.filter("n > 0").select("node", "cls").distinct()
    side = lambda c, name: of.select(F.col("node").alias(c), F.col("cls").alias(name))
    pairs = stored(
        met.filter("b IS NOT NULL").select("a", "b").distinct().join(side("a", "p"), "a").join(side("b", "x"), "b")
        .filter("p <> x").select("p", "x").distinct(), "pairs")
    classes = rows.filter("n > 0 AND doc_id IS NOT NULL").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))
    needed = pairs.select(F.col("p").alias("cls")).union(pairs.select("x")).distinct().join(classes, "cls")
    sets = _sets(docs, needed, w)
    sorted_out = stored(_sorted_out(pairs, sets, percent), "sorted-out")
    near = sorted_out.filter("NOT far").select("p", "x")
    links = lambda rows: rows.filter("linked").select(F.col("p").alias("a"), F.col("x").alias("b"))
    # One pivot of each member first: most of the other pairs then lie in one component.
    tested = stored(_verified(near.groupBy("x").agg(F.min("p").alias("p")).select("p", "x"), sets, w, percent), "tested-1")
    labels = components(links(tested))
    open_near = near.join(_open_pivots(_rooted(near, labels)).select("p"), "p")
    single = _rooted(near, labels).filter("root <> p_root").select("p", "x")  # also a pivot's only member
    more = open_near.unionByName(single).unionByName(_far_pairs(sorted_out, labels, percent)).distinct()
    tested = tested.unionByName(stored(_verified(
        more.join(tested.select("p", "x"), ["p", "x"], "left_anti"), sets, w, percent), "tested-2"))
    further = stored(_further(tested, components(links(tested)), percent), "further")
    labels = components(links(tested).unionByName(further))
    grouped = rows.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "root", F.coalesce("root", "cls"))
    grouped = stored(grouped.select("doc_id", "n", "root"), "grouped")
    smallest = grouped.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return grouped.join(smallest, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(
            F.col("component_id")).alias("component_id"))
