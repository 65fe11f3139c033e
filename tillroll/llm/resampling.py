"""Importance resampling towards a target distribution.

Texts are bags of hashed word runs of one to three words. A bucket's gain is the
log ratio of its smoothed shares among the target's features and among all
documents'; a text's weight is the sum of its features' gains, and the weight
with Gumbel noise from the id's hash is its score: the highest scores are a
sample without replacement, by weight. Features and weights are arrays over
slices of texts; only ``BUCKETS`` counts a table reach the driver.

The sample's cutoff is found by quantile sketches: two quantiles bracket it,
exact counts of the rows outside tell whether they do (if not, the bracket is
widened), and only a bracket of at most ``SORTED`` rows is sorted. Ties go by
id, then by row. The ranks come from a range shuffle of the sample alone and
the sizes of its partitions.

Null text: no words, weight 0. Texts of under ``least_words`` words are scored
but never drawn. Null ids hash as ``<seed>:`` and go after all others. Repeated
ids and rows are documents of their own, in an order fixed by the stored scores.
No target texts: gains from its smoothing alone. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.byteruns import checksums, joined, moved, runs
from tillroll.llm.common import materialize, prepare, text_buffers, text_column, text_slices

BUCKETS = 10_000
MAX_WORDS = 3       # of a feature
PART = 4 << 20
SORTED = 100_000    # rows of a bracket that is sorted
ACCURACY = 10_000   # of the quantile sketch: ranks within 1 / ACCURACY of all rows
WIDTHS = (2, 16, 128, 1024, ACCURACY)   # of brackets, in units of the sketch's error

_WORD = np.zeros(256, bool)
_WORD[ord("0"): ord("9") + 1] = True
_WORD[ord("a"): ord("z") + 1] = True
_WORD[ord("A"): ord("Z") + 1] = True
_WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_SPACE = np.array([0xE96CCF45], np.uint32)   # CRC-32 of one space


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text and bucket of every feature, and the number of words of each text."""
    offsets, data = text_buffers(texts)
    data = _LOWER[data]
    starts, ends, text = runs(offsets, _WORD[data])
    n = ends - starts
    word = checksums(data, starts, ends)
    spaced = moved(np.broadcast_to(_SPACE, len(n)), n) ^ word
    owners, found, last = [text], [word], word
    for k in range(1, MAX_WORDS):   # a run of one word more: the run before it and the next word
        last = joined(last[:-1], spaced[k:], n[k:] + 1)
        whole = text[k:] == text[:-k]
        owners.append(text[k:][whole])
        found.append(last[whole])
    return np.concatenate(owners), (np.concatenate(found) % BUCKETS).astype(np.int64), np.bincount(text, minlength=len(texts))


def count_buckets(texts: DataFrame) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    prepare(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for part in text_slices(batch, limit=PART):
                total += np.bincount(features(part.column("text"))[1], minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counts = texts.select(text_column().alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(BUCKETS, np.int64)
    for row in counts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():   # BUCKETS rows at most
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log ratio) of each bucket."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def gumbel(doc_id: Column, seed: int) -> Column:
    """floor(1000 * Gumbel noise) from the first 32 bits of the id's hash."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def score_documents(docs: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    """doc_id, n_words, n_features, weight, score of every document."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=PART):
                text, bucket, words = features(part.column("text"))
                weight = np.bincount(text, gain[bucket], part.num_rows).astype(np.int64)   # whole numbers below 2^53
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(words), pa.array(np.bincount(text, minlength=part.num_rows)), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select("doc_id", text_column().alias("text")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")
    return rows.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))


def kth_smallest(rows: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The value of rank ``k`` (from 1) of a column of whole numbers without
    nulls, and how many rows lie below it. ``rows`` is a stored table."""
    x, below, size = F.col(column), 0, rows.count()
    while size > SORTED:
        want = k - below
        # The sketch: quantiles around the wanted rank, at growing distances.
        at = [[min(1.0, max(0.0, (want / size) + side * width / ACCURACY)) for width in WIDTHS] for side in (-1, 1)]
        lows, highs = rows.agg(*(F.percentile_approx(x, F.lit(a), ACCURACY) for a in at)).first()
        for low, high in zip(lows, highs):
            # Exact counts of the rows outside the bracket: is the rank inside?
            under, to_low, to_high, upto = rows.agg(
                F.count_if(x < low), F.count_if(x <= low), F.count_if(x < high), F.count_if(x <= high)).first()
            if under < want <= upto:
                break
        if want <= to_low:
            return low, below + under
        if want > to_high:
            return high, below + to_high
        rows, below, size = rows.filter((x > low) & (x < high)), below + to_low, to_high - to_low
    values = np.array([r[0] for r in rows.select(column).orderBy(column).collect()])   # SORTED rows at most
    value = int(values[k - below - 1])
    return value, below + int(np.searchsorted(values, value))


def draw(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` first rows by ``down`` (the score's negative), ``last_id``,
    ``row``, numbered from 1 in that order as ``rank``. ``scored`` is stored."""
    rest, chosen, want = scored, F.lit(False), k
    same = F.lit(True)
    for column in ("down", "last_id", "row"):   # each among the rows that tie in those before
        value, below = kth_smallest(rest, column, want)
        chosen = chosen | (same & (F.col(column) < value))
        same = same & (F.col(column) == value)
        rest, want = rest.filter(F.col(column) == value), want - below
    drawn = scored.filter(chosen | same)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(n, part)), pa.array(np.arange(at + 1, at + n + 1))],
                                             names=[*batch.schema.names, "part", "place"])
            at += n

    keys = ["down", "last_id", "row"]
    placed = materialize(
        drawn.repartitionByRange(*keys).sortWithinPartitions(*keys).select("doc_id", "n_features", "weight", "score")
        .mapInArrow(number, "doc_id long, n_features long, weight long, score long, part long, place long"), "drawn")
    # One row a partition: how many rows come before it.
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    ranked = placed.join(before, "part").select("doc_id", "n_features", "weight", "score", (F.col("before") + F.col("place")).alias("rank"))
    left = scored.filter(~(chosen | same)).select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    return ranked.unionByName(left)


def resample(docs: DataFrame, target: DataFrame, percent: int, least_words: int = 20, seed: int = 42) -> DataFrame:
    """doc_id, n_features, weight, score of every document, and ``rank`` of
    those drawn: ``percent`` of all that have ``least_words`` words."""
    gain = gains(count_buckets(docs), count_buckets(target))
    scored = materialize(
        score_documents(docs, gain, seed).withColumns({
            "down": -F.col("score"),
            "last_id": F.coalesce("doc_id", F.lit((1 << 63) - 1)),   # null ids last
            "row": F.monotonically_increasing_id(),
        }), "scores")
    fit = scored.filter(F.col("n_words") >= least_words)
    k = percent * fit.count() // 100
    result = ["doc_id", "n_features", "weight", "score"]
    short = scored.filter(F.col("n_words") < least_words) if k else scored
    out = short.select(*result, F.lit(None).cast("long").alias("rank"))
    return draw(fit, k).unionByName(out) if k else out
