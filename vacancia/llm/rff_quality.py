"""Quality classifier: random Fourier features, ridge scores, isotonic calibration.

A document becomes a few statistics of its bytes and words. Random Fourier features
approximate a Gaussian kernel over the standardised statistics; partitions sum their part
of the normal equations and a tree adds the sums, so the driver solves one small system
whatever the rows. Training scores are counted in fixed bins; pooling adjacent violators
over the bins gives the calibration.

Null and empty texts have statistics of zero and get a score like any other. Several labels
of an id count as their mean, null labels and ids teach nothing. Without any label every
score is 0.5. Repeated rows, ties and further columns do not matter; labels, ids and other
columns are no inputs of a score.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vacancia.llm.common import BLANKS, ship, stored

FEATURES = 384
RIDGE = 0.3
BINS = 512
SEED = 17

#: Byte classes whose shares are statistics.
_CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"\n", BLANKS, b"#*$%&", b"|",
    b"<>", b"!?", b".,;:", b"'\"()[]{}", b"@/\\_-+=~^`", bytes(range(0x80, 0x100)), bytes({*range(0x20)} - {*BLANKS})]
_MEMBER = np.zeros((256, len(_CLASSES)))
for _k, _class in enumerate(_CLASSES):
    _MEMBER[list(_class), _k] = 1
WIDTH = len(_CLASSES) + 9


def statistics(texts: list[str | None]) -> np.ndarray:
    """One row of ``WIDTH`` statistics for each text."""
    out = np.zeros((len(texts), WIDTH))
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "replace")
        counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
        share = counts / max(1, len(data))
        words = data.split()
        lines = [x for x in data.split(b"\n") if x.strip()]
        n, seen = max(1, len(words)), share[share > 0]
        pairs = list(zip(words, words[1:], strict=False))
        out[i, :len(_CLASSES)] = np.sqrt(share @ _MEMBER)
        out[i, len(_CLASSES):] = (
            np.log1p(len(data)), np.log1p(len(words)), np.log1p(sum(map(len, words)) / n), len(set(words)) / n,
            len(set(pairs)) / max(1, len(pairs)), sum(map(operator.eq, words, words[1:])) / n,
            (len(lines) - len(set(lines))) / max(1, len(lines)), -(seen * np.log(seen)).sum(),
            np.log1p(max(map(len, words), default=0)))
    return out


def _fourier(x: np.ndarray, model: dict) -> np.ndarray:
    """Random Fourier features of statistics, with a constant."""
    z = np.clip((x - model["mean"]) / model["scale"], -6, 6)
    z = np.cos(z @ model["waves"] + model["shifts"]) * np.sqrt(2 / model["waves"].shape[1])
    return np.hstack([z, np.ones((len(z), 1))])


def tree_sum(rows: DataFrame, fan_in: int = 16) -> np.ndarray | None:
    """The sum of (place, blob) rows of doubles, added ``fan_in`` at a time by tasks."""

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x) for x in group["blob"])
        return pd.DataFrame({"place": [int(group["place"].iloc[0]) // fan_in], "blob": [total.tobytes()]})

    places = max(1, rows.rdd.getNumPartitions())
    while places > fan_in:
        rows = rows.groupBy(F.floor(F.col("place") / fan_in).alias("group")).applyInPandas(
            add, "place long, blob binary")
        places = -(-places // fan_in)
    found = [np.frombuffer(r.blob) for r in rows.select("blob").collect()]
    return sum(found) if found else None


def described(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, x): the statistics of each document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = statistics(batch.column(1).to_pylist())
            made = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * WIDTH, x.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], names=["doc_id", "x"])

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {dict(docs.dtypes)[doc_id]}, x array<double>")


def _matrix(batch: pa.RecordBatch, name: str = "x") -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH)


def isotonic(count: np.ndarray, total: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, values) of the increasing fit to bins with ``count`` rows, label sum ``total``."""
    blocks: list[list[float]] = []  # count, label sum, place sum
    for n, y, x in zip(count, total, at, strict=True):
        blocks.append([n, y, n * x])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    return np.array([b[2] / b[0] for b in blocks]), np.array([b[1] / b[0] for b in blocks])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
        features: int = FEATURES, ridge: float = RIDGE) -> dict | None:
    """The model, from all documents of ``docs`` that have a label; None without any."""
    target = (labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("double").alias("y"))
              .dropna().groupBy("doc_id").agg(F.avg("y").alias("y")))
    rows = stored(described(docs, doc_id, text).join(target, "doc_id").select("x", "y"), "labelled")
    moments = rows.agg(*(f(F.col("x")[i]).alias(f"{n}{i}") for i in range(WIDTH)
                         for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    if moments.m0 is None:
        return None
    rng = np.random.default_rng(SEED)
    model = {
        "mean": np.array([moments[f"m{i}"] for i in range(WIDTH)]),
        "scale": np.array([max(moments[f"s{i}"], 1e-3) for i in range(WIDTH)]),
        "waves": rng.normal(0, WIDTH ** -0.5, (WIDTH, features)), "shifts": rng.uniform(0, 2 * np.pi, features)}
    size = features + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z = _fourier(_matrix(batch), model)
            total += z.T @ np.hstack([z, batch.column("y").to_numpy()[:, None]])
        yield pa.RecordBatch.from_arrays(
            [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([total.tobytes()], pa.binary())],
            names=["place", "blob"])

    total = tree_sum(rows.mapInArrow(sums, "place long, blob binary")).reshape(size, size + 1)
    model["weights"] = np.linalg.solve(total[:, :size] + ridge * np.eye(size), total[:, size])

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = _fourier(_matrix(batch), model) @ model["weights"]
            at = np.clip((raw + 0.5) * (BINS / 2), 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column("y")], names=["bin", "y"])

    bins = (rows.mapInArrow(binned, "bin int, y double").groupBy("bin")
            .agg(F.count("*").alias("n"), F.sum("y").alias("y")).orderBy("bin").toPandas())
    model["places"], model["values"] = isotonic(
        bins["n"].to_numpy(float), bins["y"].to_numpy(), (bins["bin"].to_numpy() + 0.5) / (BINS / 2) - 0.5)
    return model


def score(docs: DataFrame, model: dict | None, doc_id: str = "doc_id", text: str = "text",
          keep_row: bool = False) -> DataFrame:
    """(doc_id, score, predicted) of each document, with its own columns as ``row`` if asked."""
    ship(docs.sparkSession)
    needed = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"),
                         *[F.struct("*").alias("row")] * keep_row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = np.full(batch.num_rows, 0.5)
            if model is not None and batch.num_rows:
                raw = _fourier(statistics(batch.column(1).to_pylist()), model) @ model["weights"]
                # The plain score breaks ties of the steps without reordering them.
                made = 0.999 * np.interp(raw, model["places"], model["values"]) + 0.001 / (1 + np.exp(-4 * raw + 2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(made), pa.array((made >= 0.5).astype(np.int32)), *batch.columns[2:]],
                names=["doc_id", "score", "predicted", *["row"] * keep_row])

    fields = {f.name: f.dataType.simpleString() for f in needed.schema}
    whole = f", row {fields['row']}" if keep_row else ""
    return needed.mapInArrow(run, f"doc_id {fields['doc_id']}, score double, predicted int{whole}")
