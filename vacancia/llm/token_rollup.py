"""Token counts as delta-maintained rollups.

A change has an old and a new state (source, lang, version, tokens); an insert has no old
one, a delete no new one, a revised count both. New states count plus one, old ones minus
one, so totals by source, language and tokenizer version are sums over signed changes.

A batch is committed under its id: its sums go to a folder of their own, then one small
row names the folder. Readers take the folders of that table, one for each id, so a batch
that is repeated, or was begun and lost, counts once. Folding puts all committed batches
into one folder and keeps their ids.

Null sources, languages and versions are groups of their own, null counts are zero. Groups
whose documents are all gone are left out of the totals. Repeated rows within a batch are
changes of their own; further columns do not matter; an empty batch is committed as such.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vacancia.llm.bpe import encoder, slices
from vacancia.llm.common import ship

KEYS = ["source", "lang", "version"]
_COMMIT = "batch string, folder string, folded array<string>"


def count_tokens(docs: DataFrame, versions: dict[str, str], pattern: str, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``tokens``: a map of version to count."""
    ship(docs.sparkSession)
    others = [f for f in docs.schema.fields if f.name != text]
    needed = docs.select(text, *(f.name for f in others))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 0):
            texts = pc.fill_null(batch.column(0).cast(pa.string()), "")
            counts = {}
            for version, path in versions.items():
                _, starts = encoder(path, pattern).block(texts)
                counts[version] = (starts[1:] - starts[:-1]).tolist()
            maps = [list(zip(counts, row, strict=True)) for row in zip(*counts.values(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(maps, pa.map_(pa.string(), pa.int64()))],
                names=[*(f.name for f in others), "tokens"])

    fields = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in others)
    return needed.mapInArrow(run, f"{fields}tokens map<string,bigint>")


def signed(changes: DataFrame) -> DataFrame:
    """(source, lang, version, docs, tokens): sums of changes (old, new), added map-side."""
    state = lambda side, sign: F.struct(
        *(F.col(f"{side}.{k}").cast("string").alias(k) for k in KEYS), F.lit(sign).alias("docs"),
        (sign * F.coalesce(F.col(f"{side}.tokens").cast("long"), F.lit(0))).alias("tokens"))
    sides = F.array_compact(F.array(F.when(F.col("old").isNotNull(), state("old", -1)),
                                    F.when(F.col("new").isNotNull(), state("new", 1))))
    return (changes.select(F.explode(sides).alias("s")).select("s.*").groupBy(*KEYS)
            .agg(F.sum("docs").cast("long").alias("docs"), F.sum("tokens").alias("tokens")))


class Rollup:
    """Totals kept in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        if not self._exists(f"{self.path}/commits/_SUCCESS"):
            spark.createDataFrame([], _COMMIT).write.mode("append").parquet(f"{self.path}/commits")

    def _exists(self, path: str) -> bool:
        jvm = self.spark._jvm
        found = jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(found)

    def _commits(self) -> list:
        """One row for each batch id or fold; the earliest folder name wins a race."""
        rows = self.spark.read.schema(_COMMIT).parquet(f"{self.path}/commits")
        first = F.row_number().over(Window.partitionBy("batch").orderBy("folder"))
        return rows.withColumn("n", first).filter("n = 1").collect()

    def _record(self, batch: str, folder: str, folded: list[str]) -> None:
        self.spark.createDataFrame([(batch, folder, folded)], _COMMIT).coalesce(1).write.mode("append").parquet(
            f"{self.path}/commits")

    @staticmethod
    def _ids(rows: list) -> set[str]:
        return {r.batch for r in rows if not r.folded} | {b for r in rows for b in r.folded or ()}

    def batches(self) -> set[str]:
        return self._ids(self._commits())

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Add a batch of (old, new) changes; False, and no effect, if its id is known."""
        if batch in self.batches():
            return False
        folder = f"{self.path}/deltas/{uuid.uuid4().hex}"
        signed(changes).write.parquet(folder)
        self._record(batch, folder, [])
        return True

    @staticmethod
    def _folders(rows: list) -> list[str]:
        folds = [r for r in rows if r.folded]
        last = max(folds, key=lambda r: (len(r.folded), r.folder), default=None)
        done = set(last.folded) if last else set()
        return [r.folder for r in rows if not r.folded and r.batch not in done] + ([last.folder] if last else [])

    def _sums(self, folders: list[str]) -> DataFrame:
        rows = self.spark.read.schema("source string, lang string, version string, docs long, tokens long")
        return rows.parquet(*folders).groupBy(*KEYS).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))

    def fold(self) -> None:
        """Put all committed batches into one folder.

        Ids and folders come from one reading of the commits: a batch that is committed
        meanwhile is in neither and stays beside the fold.
        """
        rows = self._commits()
        known = sorted(self._ids(rows))
        if not known:
            return
        folder = f"{self.path}/deltas/{uuid.uuid4().hex}"
        self._sums(self._folders(rows)).write.parquet(folder)
        self._record(f"fold-{uuid.uuid4().hex}", folder, known)

    def totals(self) -> DataFrame:
        """(source, lang, version, docs, tokens) of all committed batches."""
        folders = self._folders(self._commits())
        if not folders:
            return self.spark.createDataFrame(
                [], "source string, lang string, version string, docs long, tokens long")
        return self._sums(folders).filter("docs <> 0 OR tokens <> 0")
