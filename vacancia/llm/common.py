"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from vacancia import session

#: Fixed values of the word definitions: bytes that separate words.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FILE_ROWS = 50_000
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package to the Python workers, unless their path already has it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    app = spark.sparkContext.applicationId
    if app in _shipped or root in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    made = shutil.make_archive(f"{tempfile.mkdtemp()}/vacancia", "zip", root, "vacancia")
    spark.sparkContext.addPyFile(made)
    _shipped.add(app)


def stored(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder of ``spark.checkpoint.dir``.

    A point that several readers share is computed once and survives lost executors.
    ``rows``, no fewer than ``df`` has, keep a small table from as many files as there are
    shuffle partitions; more than that it never has.
    """
    path = session.scratch_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // FILE_ROWS)))
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(texts: list[str | None], limit: int = 1 << 22) -> Iterator[tuple[int, list[bytes]]]:
    """(first index, UTF-8 texts) runs of about ``limit`` bytes; a longer text is a run alone."""
    run: list[bytes] = []
    start = size = 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace")
        if run and size + len(data) > limit:
            yield start, run
            run, start, size = [], i, 0
        run.append(data)
        size += len(data)
    if run:
        yield start, run


def joined(run: list[bytes], pad: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a run, each text after ``pad``, and where each text (with pad) starts."""
    sizes = np.fromiter((len(x) + len(pad) for x in run), np.int64, len(run))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return np.frombuffer(pad + pad.join(run), np.uint8), starts


_BLANK = np.zeros(256, bool)
_BLANK[list(BLANKS)] = True
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = []


def mixed(h: np.ndarray) -> np.ndarray:
    """Bits of 64-bit hashes stirred."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        n = max(n, 1 << 16)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)]))
                      for x in (_BASE, pow(_BASE, -1, 1 << 64))]
    return _powers


def segment_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``data[start:end]``; equal segments are equal wherever they lie."""
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts])


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words in bytes that begin and end with a blank."""
    blank = _BLANK[data]
    return np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1


def spread(run: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends, first word of each text) of texts joined by blanks."""
    whole = b"\n" + b"\n".join(run) + b"\n"
    starts, ends = words_of(np.frombuffer(whole, np.uint8))
    begins = np.cumsum([1, *(len(x) + 1 for x in run)])
    return whole, starts, ends, np.searchsorted(starts, begins)
