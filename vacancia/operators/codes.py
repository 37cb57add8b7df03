"""Product codes of unit vectors: a byte for each sub-vector, and a coarse k-means cell."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

ROUNDS = 12


class Books(NamedTuple):
    """Centroids: ``cells`` (cells x dims) and, for each part, up to 256 of its sub-vectors."""

    cells: np.ndarray
    parts: list[np.ndarray]

    def encode(self, vectors: np.ndarray) -> np.ndarray:
        out = np.empty((len(vectors), len(self.parts)), np.uint8)
        for j, (book, sub) in enumerate(zip(self.parts, self.split(vectors), strict=True)):
            out[:, j] = _closest(sub, book)
        return out

    def split(self, vectors: np.ndarray) -> list[np.ndarray]:
        return np.split(vectors, np.cumsum([b.shape[1] for b in self.parts])[:-1], axis=1)

    def decode(self, column: pd.Series) -> np.ndarray:
        """The vectors that codes stand for."""
        code = np.frombuffer(b"".join(bytes(x) for x in column), np.uint8).reshape(len(column), -1)
        return np.hstack([book[code[:, j]] for j, book in enumerate(self.parts)])


def _closest(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmin((book**2).sum(axis=1) - 2 * points @ book.T, axis=1)


def _means(points: np.ndarray, k: int) -> np.ndarray:
    """k-means from evenly spaced points; a centroid without points stays."""
    k = max(1, min(k, len(points)))
    book = points[np.arange(k) * len(points) // k].copy()
    for _ in range(ROUNDS if k < len(points) else 0):
        at = _closest(points, book)
        many = np.bincount(at, minlength=k)
        sums = np.zeros_like(book)
        np.add.at(sums, at, points)
        book[many > 0] = sums[many > 0] / many[many > 0, None]
    return book


def fit(docs: DataFrame, doc_id: str, vector: str, parts: int = 32, cells: int = 1, sample: int = 20_000) -> Books:
    """Books from ``sample`` documents, the least by a hash of their id: the only rows that reach the driver."""
    rows = docs.orderBy(F.xxhash64(doc_id), doc_id).limit(sample).select(vector).collect()
    points = np.array([r[0] for r in rows], float) if rows else np.zeros((1, parts))
    widths = np.array_split(np.arange(points.shape[1]), min(parts, points.shape[1]))
    return Books(_means(points, cells), [_means(points[:, w], 256) for w in widths])


def encode(docs: DataFrame, vector: str, books: Books) -> DataFrame:
    """``docs`` with ``cell`` and ``code``."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                points = np.vstack(frame[vector].to_numpy())
                yield frame.drop(columns=vector).assign(
                    cell=_closest(points, books.cells).astype("int32"), code=[r.tobytes() for r in books.encode(points)])

    others = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields if f.name != vector)
    return docs.mapInPandas(run, f"{others}, cell int, code binary")


def probed(queries: DataFrame, vector: str, books: Books, probes: int) -> DataFrame:
    """``queries`` once for each of their ``probes`` nearest cells, as ``cell``."""
    centres = books.cells

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                points = np.vstack(frame[vector].to_numpy())
                away = (centres**2).sum(axis=1) - 2 * points @ centres.T
                near = np.argsort(away, axis=1, kind="stable")[:, :probes]
                out = frame.iloc[np.repeat(np.arange(len(frame)), near.shape[1])]
                yield out.assign(cell=near.ravel().astype("int32"))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in queries.schema.fields)
    return queries.mapInPandas(run, f"{fields}, cell int")
