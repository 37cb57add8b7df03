"""Document fingerprints from closed syncmers, in DataFrame functions alone.

A text is its words (runs without blanks). Of every window of ``K`` words, the pairs of
neighbouring words are hashed; the window is an anchor when its least pair is its first or
last one. That depends on the window alone, so equal passages have equal anchors wherever
they stand, and two of ``K - 1`` windows are anchors on average. The fingerprint is the
anchors in order of place, each once; likeness is the share of common anchors (twice the
common ones over all of both).

Null texts are empty. Texts without an anchor have the hash of the whole text as their only
one, so equal texts always have equal fingerprints. The order of documents is by id (nulls
first), then by a hash of the text; equal rows follow each other. Further columns do not
matter; an empty table gives an empty table; a single document follows itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 8  # words of a window; its pairs are K - 1


def with_anchors(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the anchors of column ``text`` as array<bigint> ``name``, in order of place."""
    inner = ", ".join(f"get(_h, i + {j})" for j in range(1, K - 2))
    covering = ", ".join(f"get(_h, i + {j})" for j in range(2, K - 1, 2))
    return (
        df.withColumn("_w", F.split(text, r"[ \t-\r]+"))
        .withColumn("_h", F.expr("transform(_w, (x, i) -> xxhash64(x, get(_w, i + 1)))"))
        # The last pair has no second word; windows end before it.
        .withColumn("_a", F.expr(
            f"array_distinct(filter(transform(_h, (x, i) -> CASE WHEN i + {K} <= size(_h)"
            f" AND least(x, get(_h, i + {K - 2})) <= least({inner}) THEN xxhash64(x, {covering}) END),"
            f" a -> a IS NOT NULL))"))
        .withColumn(name, F.when(F.size("_a") > 0, F.col("_a")).otherwise(F.array(F.xxhash64(text))))
        .drop("_w", "_h", "_a"))


def fingerprint(anchors: str) -> Column:
    """Anchors as text: 40 bits each, in hexadecimal."""
    return F.expr(f"array_join(transform({anchors}, a -> hex(a & 1099511627775)), '-')")


def likeness(a: str, b: str) -> Column:
    return 2 * F.size(F.array_intersect(a, b)) / (F.size(a) + F.size(b))


def shared_places(a: str, b: str) -> Column:
    """Anchors of both as (place in a, place in b): where two given documents agree."""
    return F.expr(
        f"filter(transform({a}, (x, i) -> struct(i AS a, cast(array_position({b}, x) - 1 AS int) AS b)), p -> p.b >= 0)")


def _followed(docs: DataFrame, cells: int) -> tuple[DataFrame, Window]:
    """``docs`` (doc_id, text) in cells of near ids, and the order in a cell.

    Each cell also gets the first row of the next one, marked as a guest, so that every
    row has its follower in its cell. Cells are equal ranges of the id; of each, one row of
    ids goes to the driver, as many as there are cells.
    """
    docs = docs.withColumn("version", F.xxhash64("text"))
    span = docs.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    cell = F.lit(0)
    if span.low is not None and span.low < span.high:
        cell = F.coalesce(F.expr(
            f"cast(width_bucket(cast(doc_id AS double), {float(span.low)!r}D, {float(span.high)!r}D, {cells}) AS int)"),
            F.lit(0))
    docs = docs.withColumn("cell", cell)
    firsts = (docs.groupBy("cell").agg(F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "version")).alias("f"))
              .select("cell", "f.doc_id", "f.version").orderBy("cell").collect())
    order = Window.partitionBy("cell").orderBy("guest", F.col("doc_id").asc_nulls_first(), "version")
    guests = [(firsts[i - 1].cell, r.doc_id, r.version) for i, r in enumerate(firsts)]
    spark = docs.sparkSession
    wanted = spark.createDataFrame(guests, "host int, g_id long, g_version long")
    # A row for each cell, and cells are bounded by the session's setting.
    found = docs.join(
        F.broadcast(wanted), F.col("doc_id").eqNullSafe(F.col("g_id")) & (F.col("version") == F.col("g_version"))).select(
        "doc_id", "text", "version", F.col("host").alias("cell"), F.lit(True).alias("guest"))
    return docs.withColumn("guest", F.lit(False)).select("doc_id", "text", "version", "cell", "guest").unionByName(
        found), order


def compare(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document beside its edited text (its end replaced by the next one's start).

    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. One shuffle by cell serves both look-aheads.
    """
    spark = docs.sparkSession
    cells = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows, order = _followed(docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text")), cells)
    rows = rows.withColumn("next", F.lead("text").over(order)).withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("edited", F.expr(
        "concat(substring(text, 1, cast(n_chars - n_chars div 2 AS int)),"
        " substring(coalesce(next, ''), 1, cast(n_chars div 2 AS int)))"))
    rows = with_anchors(with_anchors(rows, "text", "own"), "edited", "changed")
    rows = rows.select("cell", "guest", "doc_id", "version", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
                       "own", "changed", F.lead("own").over(order).alias("after"))
    return rows.filter("NOT guest").select(
        "doc_id", "n_chars", "edited_sha256", fingerprint("own").alias("fingerprint"),
        fingerprint("changed").alias("edited_fingerprint"), likeness("own", "changed").alias("near_edited"),
        likeness("own", "after").alias("near_next"))
