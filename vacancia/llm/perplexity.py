"""Quality rules and byte n-gram perplexity under a modified Kneser-Ney model.

Spark counts the byte 5-grams of the whole corpus; everything the model needs (lower-order
continuation counts, discounts, back-off weights, interpolated probabilities) follows from
that one table by joins and aggregates. A document of the corpus is judged by what the rest says:
each of its grams is valued with one of its own counts taken out. Every gram keeps its own key, its packed bytes, and
nothing is dropped: the model grows with the corpus and stays a set of tables.

To score, the table of the longest grams is cut by key into as many slices as it needs for
each to have at most ``SLICE`` entries (48 MB; the sizes are checked). A slice is broadcast as
sorted arrays, all texts are read once and each gets the sum over its grams in that slice;
then comes the next slice. Sums meet by the text's hashes, so texts are neither stored nor
shuffled. Documents outside the corpus may have grams that no slice has: these are joined to
the lower orders, level by level. Bands of each language come from quartiles over all its
documents, by what their lengths let expect; outside its band a document is rejected.

Words are runs without blanks (space, tab to carriage return). Null and empty texts have no
words: they fail the base rules and have no perplexity. Null languages are a language of
their own. Rows are independent: repeated rows and ids, null ids, further columns are fine.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vacancia.llm.bpe import slices
from vacancia.llm.common import BLANKS, blocks, joined, ship, stored

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: The mean over n words scatters as the root of 1 / n + 1 / LONG_WORDS.
LONG_WORDS = 2000
#: Distinct documents from which on a language's own spread alone sets its band.
ENOUGH = 200
#: Words at which the band of a language of fewer documents is twice as wide.
SHORT_WORDS = 25

ORDER = 5
PAD = b"\xff" * (ORDER - 1)  # in no UTF-8 text
#: Entries of the model that are broadcast at once.
SLICE = 1 << 22
_BLOCK = 1 << 20
_HELD = 1 << 21  # grams a task adds up before it passes them on
_TEXT_KEY = ["text_hash", "text_bytes"]


# ---------------------------------------------------------------- base rules

def base_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of a text."""
    text = text or ""
    data = text.encode("utf-8", "replace")
    words = data.split()  # bytes split at exactly the blanks
    blanks = len(data) - len(data.translate(None, BLANKS))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        counts, covered = Counter(windows), 0  # covered: words before it are counted
        for i, window in enumerate(windows):
            if counts[window] > 1:
                repeated += i + 3 - max(covered, i)
                covered = i + 3
    return len(words), len(text) - blanks, symbols, len(lines) - len(set(lines)), repeated


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


# ---------------------------------------------------------------- model

def _grams(data: np.ndarray) -> np.ndarray:
    """Packed grams that end at each byte but the first ones."""
    n = len(data) - len(PAD)
    out = np.zeros(n, np.uint64)
    for j in range(ORDER):
        out <<= np.uint64(8)
        out |= data[j:j + n]
    return out


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    heads = np.flatnonzero(np.diff(key[order], prepend=~key[order][:1]))
    return key[order[heads]], np.add.reduceat(count[order], heads)


def count_grams(docs: DataFrame, text: str = "text") -> DataFrame:
    """(gram, n): packed byte 5-grams of all texts, the first ones of a text after padding.

    Tasks sum by sorting before the shuffle, so a gram of a third of all rows is one row
    from each task.
    """
    ship(docs.sparkSession)

    def made(key: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(0, len(key), 1 << 18):
            yield pa.RecordBatch.from_arrays(
                [pa.array(key[i:i + (1 << 18)].view(np.int64)), pa.array(n[i:i + (1 << 18)])], names=["gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        counts: list[np.ndarray] = []
        for batch in slices(batches, 0):
            for _, texts in blocks(batch.column(0).to_pylist(), _BLOCK):
                data, _ = joined([t for t in texts if t], PAD)
                if len(data) <= len(PAD):
                    continue
                grams = np.sort(_grams(data))
                grams = grams[grams & np.uint64(0xFF) != 0xFF]  # padding is never predicted
                first = np.flatnonzero(np.diff(grams, prepend=~grams[:1]))
                keys.append(grams[first])
                counts.append(np.diff(first, append=len(grams)))
                if sum(map(len, keys)) > _HELD:
                    keys, counts = ([x] for x in _summed(keys, counts))
                    if len(keys[0]) > _HELD // 2:
                        yield from made(keys[0], counts[0])
                        keys, counts = [], []
        if keys:
            yield from made(*_summed(keys, counts))

    counted = docs.select(text).mapInArrow(run, "gram long, n long")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more."""
    row = counts.agg(*(F.count(F.when(F.col("n") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4))).first()
    if not row.n1 or not row.n2:
        return 0.5, 0.5, 0.5
    y = row.n1 / (row.n1 + 2 * row.n2)
    d = (1 - 2 * y * row.n2 / row.n1, 2 - 3 * y * row.n3 / row.n2,
         3 - 4 * y * row.n4 / row.n3 if row.n3 else 1.5)
    return tuple(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))


def _order(counts: DataFrame, lower: DataFrame | None, bits: int) -> DataFrame:
    """(gram, n, context, logp, logq, logb): one order, interpolated with the next lower.

    ``logq`` is the value with one of the gram's own counts taken out, for texts that the
    counts are from: a gram of one place then has none, and the order below one less.
    """
    d1, d2, d3 = discounts(counts)
    discount = lambda n: F.when(n == 0, 0.0).when(n == 1, d1).when(n == 2, d2).otherwise(d3)
    n, total, held = F.col("n"), F.col("total"), F.col("held")
    counts = counts.withColumn("context", F.shiftright("gram", 8))
    sums = counts.groupBy("context").agg(F.sum("n").alias("total"), F.sum(discount(n)).alias("held"))
    if lower is None:
        rows = counts.join(sums, "context").withColumns({"below": F.lit(1.0 / 256), "below_out": F.lit(1.0 / 256)})
    else:
        suffix = F.col("gram").bitwiseAND((1 << bits - 8) - 1)
        rows = counts.withColumn("suffix", suffix).join(sums, "context").join(
            lower.select(F.col("gram").alias("suffix"), F.exp("logp").alias("below"), F.exp("logq").alias("below_out")), "suffix")
    rest = held - discount(n) + discount(n - 1)
    without = F.when(n > 1, (n - 1 - discount(n - 1) + rest * F.col("below")) / (total - 1)).when(
        total > 1, rest / (total - 1) * F.col("below_out")).otherwise(F.col("below_out"))
    return rows.select(
        "gram", "n", "context", F.log((n - discount(n) + held * F.col("below")) / total).alias("logp"),
        F.log(without).alias("logq"), F.log(held / total).alias("logb"))


def fit(docs: DataFrame, text: str = "text") -> list[DataFrame]:
    """The model: for each order, from bytes to the longest grams, (gram, n, context, logp, logq, logb)."""
    counts = stored(count_grams(docs, text), "grams")
    levels = [(counts, counts.count())]
    for bits in range(8 * (ORDER - 1), 0, -8):  # continuation counts: in how many grams of the order above
        counts = counts.groupBy(F.col("gram").bitwiseAND((1 << bits) - 1).alias("gram")).agg(F.count("*").alias("n"))
        counts = stored(counts, f"grams-{bits}", levels[-1][1])
        levels.append((counts, counts.count()))
    orders, lower = [], None
    for bits, (counts, n) in zip(range(8, 8 * ORDER + 1, 8), reversed(levels), strict=True):
        lower = stored(_order(counts, lower, bits), f"order-{bits}", n)
        orders.append(lower)
    return orders


def _slices(top: DataFrame, limit: int, value: str = "logp") -> tuple[DataFrame, int]:
    """The longest grams with the slice of each, and how many slices keep all within ``limit``."""
    n = max(1, -(-top.count() // limit)) | 1  # odd, so that all bytes of a key decide
    while True:
        cut = top.select("gram", F.col(value).cast("float").alias("logp"), (F.col("gram") % n).alias("slice"))
        if n == 1 or cut.groupBy("slice").count().agg(F.max("count")).first()[0] <= limit:
            return cut, n
        n += 2


def _text_key(text: Column) -> dict[str, Column]:
    return {"text_hash": F.xxhash64(text), "text_bytes": F.coalesce(F.octet_length(text), F.lit(0))}


def _sums(texts: DataFrame, entries: pa.Table, slice_of: int, n: int, own: bool) -> DataFrame:
    """One slice: (text_hash, text_bytes, total) of each text; grams it should have but lacks.

    ``texts`` has the key and the text. With ``own`` all grams are known to be in the model.
    """
    key = entries["gram"].to_numpy().astype(np.uint64)
    order = np.argsort(key)
    shared = texts.sparkSession.sparkContext.broadcast((key[order], entries["logp"].to_numpy()[order]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, logp = shared.value
        names = [*_TEXT_KEY, "total", "gram", "n"]
        for batch in slices(batches, 2):
            hashes, sizes = batch.column(0), batch.column(1)
            for first, run_of in blocks(batch.column(2).to_pylist(), _BLOCK):
                data, starts = joined(run_of, PAD)
                grams = _grams(data)
                distinct = np.sort(grams)
                distinct = distinct[np.flatnonzero(np.diff(distinct, prepend=~distinct[:1]))]
                there = distinct & np.uint64(0xFF) != 0xFF
                if n > 1:
                    there &= distinct % np.uint64(n) == slice_of
                at = np.minimum(np.searchsorted(keys, distinct), max(len(keys) - 1, 0))
                found = there & (keys[at] == distinct) if len(keys) else np.zeros(len(distinct), bool)
                value = np.where(found, logp[at] if len(keys) else 0.0, 0.0)
                place = np.searchsorted(distinct, grams)
                # A text's places begin where its padding does; the last ones of a text have padding at their end.
                total = np.add.reduceat(np.append(value[place], 0.0), starts[:-1])
                total[np.diff(starts) <= len(PAD)] = 0.0
                m, these = len(run_of), slice(first, first + len(run_of))
                yield pa.RecordBatch.from_arrays(
                    [hashes[these], sizes[these], pa.array(total), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())], names=names)
                if not own and (lost := (there & ~found)[place]).any():
                    text = np.searchsorted(starts, np.flatnonzero(lost), "right") - 1 + first
                    yield pa.RecordBatch.from_arrays(
                        [hashes.take(pa.array(text)), sizes.take(pa.array(text)), pa.nulls(len(text), pa.float64()),
                         pa.array(grams[lost].view(np.int64)), pa.array(np.ones(len(text), np.int64))], names=names)

    done = stored(texts.mapInArrow(run, "text_hash long, text_bytes int, total double, gram long, n long"), f"sums-{slice_of}")
    shared.unpersist()
    return done


def _backed_off(grams: DataFrame, model: list[DataFrame]) -> DataFrame:
    """(gram, logp) of distinct grams outside the model, from the orders below, one join a level."""
    left, found = grams.select("gram", F.col("gram").alias("rest"), F.lit(0.0).alias("sofar")), None
    for order in range(ORDER, 0, -1):
        contexts = model[order - 1].select("context", "logb").distinct()
        left = left.withColumn("context", F.shiftright("rest", 8)).join(contexts, "context", "left").select(
            "gram", F.col("rest").bitwiseAND((1 << 8 * (order - 1)) - 1).alias("rest"),
            (F.col("sofar") + F.coalesce("logb", F.lit(0.0))).alias("sofar"))
        if order == 1:
            done = left.select("gram", (F.col("sofar") - F.log(F.lit(256.0))).alias("logp"))
        else:
            lower = model[order - 2].select(F.col("gram").alias("rest"), "logp")
            left = stored(left.join(lower, "rest", "left"), f"back-off-{order}")
            done = left.filter("logp IS NOT NULL").select("gram", (F.col("sofar") + F.col("logp")).alias("logp"))
            left = left.filter("logp IS NULL").drop("logp")
        found = done if found is None else found.unionByName(done)
    return found


def scores(texts: DataFrame, model: list[DataFrame], own: bool = False, limit: int = SLICE) -> DataFrame:
    """(text_hash, text_bytes, log_perplexity): mean negative log-probability a byte of each text with any.

    ``texts`` has text_hash, text_bytes, text. Equal texts are one row. ``own``: the model was
    fitted on these texts; no gram is new, and none vouches for itself.
    """
    cut, n = _slices(model[-1], limit, "logq" if own else "logp")
    parts = [
        _sums(texts, cut.filter(F.col("slice") == i).select("gram", "logp").toArrow(), i, n, own).withColumn("slice", F.lit(i))
        for i in range(n)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    known = every.filter("total IS NOT NULL").groupBy(*_TEXT_KEY, "slice").agg(F.max("total").alias("total"))
    if not own:
        new = stored(every.filter("gram IS NOT NULL").groupBy(*_TEXT_KEY, "slice", "gram").agg(F.sum("n").alias("n")), "new-grams")
        copies = every.filter("total IS NOT NULL").groupBy(*_TEXT_KEY, "slice").agg(F.count("*").alias("copies"))
        rest = new.join(_backed_off(new.select("gram").distinct(), model), "gram").join(copies, [*_TEXT_KEY, "slice"])
        known = known.unionByName(rest.groupBy(*_TEXT_KEY, "slice").agg(
            F.sum(F.col("n") / F.col("copies") * F.col("logp")).alias("total")))
    return known.groupBy(*_TEXT_KEY).agg(F.sum("total").alias("total")).filter("text_bytes > 0").select(
        *_TEXT_KEY, (-F.col("total") / F.col("text_bytes")).alias("log_perplexity"))


def measure(docs: DataFrame, model: list[DataFrame], doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
            own: bool = False, limit: int = SLICE) -> DataFrame:
    """Base counts, ``log_perplexity`` and the text's key of every document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
        for batch in slices(batches, 4):
            counts = list(zip(*map(base_counts, batch.column(4).to_pylist()), strict=True)) if batch.num_rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], *(pa.array(c, pa.int64()) for c in counts)], names=["doc_id", "lang", *_TEXT_KEY, *names])

    needed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(lang).cast("string").alias("lang"),
                         F.col(text).alias("text")).withColumns(_text_key(F.col("text"))).select(
        "doc_id", "lang", *_TEXT_KEY, "text")
    counted = needed.mapInArrow(
        run, "doc_id long, lang string, text_hash long, text_bytes int, n_words long, word_chars long, n_symbols long,"
             " n_dup_lines long, n_repeat_words long")
    found = scores(needed.select(*_TEXT_KEY, "text"), model, own, limit)
    return counted.join(found, _TEXT_KEY, "left")


def _scatter() -> Column:
    return F.sqrt(1 / F.greatest("n_words", F.lit(1)) + 1 / LONG_WORDS)


def bands(measured: DataFrame, width: float = 2.5, least: float = 0.1) -> DataFrame:
    """(band_lang, middle, below, above, floor): fences of a language's passing documents.

    Distances to the median are divided by the scatter that a document's length lets
    expect; ``below`` and ``above`` lie ``width`` quartile ranges outside their quartiles.
    Copies count once, or a much repeated text would be the whole band. Languages of fewer
    than ``ENOUGH`` distinct documents have no spread to judge by: their band reaches at
    least ``floor``, the share ``least`` of the median.
    """
    rows = (
        measured.filter(~base_failed(F.col("n_words"), F.col("n_repeat_words")))
        .groupBy("lang", "n_words", "word_chars", F.round("log_perplexity", 6).alias("score")).agg(F.lit(1).alias("one")))
    middles = rows.groupBy(F.col("lang").alias("band_lang")).agg(
        F.percentile_approx("score", 0.5, 10_000).alias("middle"), F.count("score").alias("documents"))
    away = (F.col("score") - F.col("middle")) / _scatter()
    q = rows.join(middles, F.col("lang").eqNullSafe(F.col("band_lang"))).groupBy("band_lang").agg(
        F.first("middle").alias("middle"), F.first("documents").alias("documents"),
        F.percentile_approx(away, [0.25, 0.75], 10_000).alias("q"))
    margin = width * (F.col("q")[1] - F.col("q")[0])
    return q.select(
        "band_lang", "middle", (F.col("q")[0] - margin).alias("below"), (F.col("q")[1] + margin).alias("above"),
        F.when(F.col("documents") < ENOUGH, least * F.col("middle")).otherwise(0.0).alias("floor"))


def judge(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
          width: float = 2.5, limit: int = SLICE) -> DataFrame:
    """Counts, ``log_perplexity, low, high, base_failed, kept`` for each document."""
    return _judged(docs, doc_id, text, lang, width, limit).drop(*_TEXT_KEY)


def _judged(docs: DataFrame, doc_id: str, text: str, lang: str, width: float, limit: int) -> DataFrame:
    measured = stored(measure(docs, fit(docs, text), doc_id, text, lang, own=True, limit=limit), "measured")
    limits = bands(measured, width)
    failed = base_failed(F.col("n_words"), F.col("n_repeat_words"))
    floor = F.col("floor") * (1 + SHORT_WORDS / F.greatest("n_words", F.lit(1)))
    inside = F.coalesce(F.col("log_perplexity").between(F.col("low"), F.col("high")), F.lit(True))
    return (
        measured.join(limits, F.col("lang").eqNullSafe(F.col("band_lang")), "left")
        .withColumns({"low": F.col("middle") - F.greatest(-F.col("below") * _scatter(), floor),
                      "high": F.col("middle") + F.greatest(F.col("above") * _scatter(), floor)})
        .withColumn("base_failed", failed).withColumn("kept", ~failed & inside)
        .drop("band_lang", "middle", "below", "above", "floor"))


def kept_rows(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
              width: float = 2.5, limit: int = SLICE) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    A verdict follows from text and language, so rows meet it by these.
    """
    good = _judged(docs, doc_id, text, lang, width, limit).filter("kept").select(
        *(F.col(c).alias(f"_{c}") for c in _TEXT_KEY), F.col("lang").alias("_lang")).distinct()
    key = _text_key(docs[text])
    same = (key["text_hash"] == F.col("_text_hash")) & (key["text_bytes"] == F.col("_text_bytes"))
    return docs.join(good, same & docs[lang].cast("string").eqNullSafe(F.col("_lang")), "left_semi")
