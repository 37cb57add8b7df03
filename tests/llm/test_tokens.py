"""Byte-level BPE and packing against the libraries themselves."""

import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from vacancia.llm import bpe, packing

PATH = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")


def test_block_equals_the_libraries():
    rng = np.random.default_rng(3)
    bits = ["a", "'", "s", " ", "  ", "\n", "é", "1", ".", "<|endoftext|>", "\x0b", "\x85", "\x1c", "漢", "'ll", " the"]
    texts = ["".join(rng.choice(bits, rng.integers(0, 30))) for _ in range(3000)]
    plain = bpe.encoder(PATH, P.PATTERN)
    ids, starts = plain.block(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == plain.library.encode_ordinary_batch(texts)
    ids, starts = bpe.encoder(JSON, P.PATTERN).block(pa.array(texts))
    library = Tokenizer.from_file(JSON)
    assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [
        library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("chunk,overlap", [(1 << 15, 1 << 10), (64, 16), (40, 3)])
def test_encode_and_decode(spark, odd, chunk, overlap):
    got = bpe.decode(bpe.encode(odd, PATH, P.PATTERN, chunk, overlap), PATH, P.PATTERN).collect()
    library = bpe.encoder(PATH, P.PATTERN).library
    want = [(r.doc_id, library.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in odd.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded)) for r in got), key=key) \
        == sorted(want, key=key)


def test_encode_nothing(spark, odd):
    assert bpe.encode(odd.limit(0), PATH, P.PATTERN).collect() == []


def test_best_fit():
    sizes = sorted(np.random.default_rng(1).integers(1, 100, 2000).tolist(), reverse=True)
    bins = packing.best_fit(sizes, 100)
    assert sorted(i for b in bins for i in b) == list(range(2000))
    fills = [sum(sizes[i] for i in b) for b in bins]
    assert max(fills) <= 100 and len(bins) <= 1.01 * -(-sum(sizes) // 100)
    assert packing.best_fit([], 100) == []


@pytest.mark.parametrize("parts,carry", [(1, 50_000), (20, 50_000), (20, 3)])
def test_pack(spark, odd, parts, carry):
    capacity = 128
    items = packing.pieces(odd.repartition(parts), JSON, P.PATTERN, capacity)
    rows = packing.pack(items, capacity, fan_in=3, carry=carry).collect()
    library = Tokenizer.from_file(JSON)
    want = []
    for r in odd.collect():
        ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range((len(ids) - 1) % capacity + 1, len(ids) + 1, capacity)]
        want += [(r.doc_id, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
                 for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted(want, key=key)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        places.sort()
        assert [a for a, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= capacity
    if carry > 3:
        assert len(sequences) <= 1.05 * sum(w[3] for w in want) / capacity + 1


def test_pack_mixes_long_and_short_pieces_of_different_partitions(spark):
    rng = np.random.default_rng(2)
    sizes = [*rng.integers(1100, 1900, 400).tolist(), *rng.integers(100, 200, 1000).tolist()]
    rows = [(i, 0, 0, n, i) for i, n in enumerate(sizes)]
    items = spark.createDataFrame(spark.sparkContext.parallelize(rows, 7), packing._ITEM)
    packed = packing.pack(items, 2048, carry=50).collect()
    assert sorted((r.doc_id, r.length) for r in packed) == list(enumerate(sizes))
    assert len({r.sequence_id for r in packed}) <= 1.05 * 400


def test_pack_nothing(spark, odd):
    assert packing.pack(packing.pieces(odd.limit(0), JSON, P.PATTERN, 64), 64).collect() == []
