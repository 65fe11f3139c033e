"""Cross-entropy difference of two n-gram models of words.

A target model (documents labelled good and clean) and a background model (all
documents) share one vocabulary, all words of all documents, and one form. Words
are runs of anything but white space; a boundary stands before and after the
words of a text. With c the counts of a model and v the word before w

    P(w)     = (c(w) + PRIOR * b(w)) / (N + PRIOR)
    P(w | v) = (c(v w) + PRIOR * P(w)) / (c(v) + PRIOR)

where b(w), the word's share of all documents, is the base of both models and N
the tokens of the target: the background's counts are scaled to that total, so
that the priors weigh alike in both. A document's score is the mean over its
words and its end of loss under the target less loss under the background; lower
is more like the target.

Nothing is cut off or sampled: counts cover every word and pair of words of
every document, however many there are, and none of them pass through the
driver. Texts are dealt into slices by row. A slice sends each distinct gram
once with its counts, as 64 bits of hash, to the group that the hash falls to;
so the most frequent gram comes once a slice. A group sums the counts and
answers each slice in the slice's own order; the slice's second pass works out
the same grams, checks their sums, and scores its texts. The texts cross the
network once (the exchange is reused by the second pass); labels are joined to
ids alone, and a slice gets the ids of its target documents. Rows that have moved
between passes (an input that is not the same when read again) raise an error.
Only the numbers of bytes and tokens reach the driver.

Null text, and text without words: 0 tokens, score 0, no part in the counts.
Null ids (never a target) and repeated rows count and are scored like others;
labels may repeat. Without target documents the background keeps its own scale
and the target is the base alone. An empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, prepare, text_buffers, text_column, text_slices
from tillroll.llm.repeats import Words, mixed

PRIOR = 4.0
SLICE_BYTES = 8 << 20     # text of a slice
GROUP_BYTES = 8 << 20     # text whose grams a group holds on average
BOUNDARY = np.uint64(0x8000000000000001)
MOVED = "the documents changed between two reads; store them first"
_PAIR, _SINGLE = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)   # odd multiplier, mask


class Grams:
    """The tokens of some texts, the distinct grams in order of their hashes
    (``keys``), and where the word, the word before and the pair of each token
    stand there."""

    def __init__(self, texts: pa.Array):
        words = Words(texts)
        self.counts = words.counts + (words.counts > 0)       # tokens of each text
        ends = np.cumsum(self.counts)[words.counts > 0]
        n = int(self.counts.sum())
        closing = np.zeros(n, bool)
        closing[ends - 1] = True
        token = np.full(n, BOUNDARY)
        token[~closing] = words.hashes
        before = np.append(BOUNDARY, token[:-1])[:n]          # a text's first word follows the boundary of the one before
        self.keys, of = np.unique(np.concatenate([mixed(token ^ _SINGLE), mixed(before * _PAIR + token)]), return_inverse=True)
        self.word, self.pair = of[:n], of[n:]
        boundary = np.searchsorted(self.keys, mixed(np.array([BOUNDARY]) ^ _SINGLE))
        self.before = np.append(boundary, self.word[:-1])[:n]

    def times(self, chosen: np.ndarray) -> np.ndarray:
        """How often each gram occurs in the chosen texts."""
        some = np.repeat(chosen, self.counts)
        return np.bincount(self.word[some], minlength=len(self.keys)) + np.bincount(self.pair[some], minlength=len(self.keys))

    def grouped(self, groups: int) -> tuple[np.ndarray, np.ndarray]:
        """The groups that hold the keys, ascending, and where each one's start, with the end."""
        group = ((self.keys >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
        return group[first], np.append(first, len(group))


def _total(keys: np.ndarray) -> int:
    return int(keys.sum(dtype=np.uint64).view(np.int64))


def _cut(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """One binary value for each run of the array."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(bounds * values.itemsize, np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def _packed(counts: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The same for counts, most of which are 1 or 0: compressed."""
    counts = counts.astype("<i8")
    return pa.array([pa.compress(counts[a:b].tobytes(), codec="zstd", asbytes=True) for a, b in zip(bounds, bounds[1:])], pa.binary())


def _unpacked(values: pa.ChunkedArray, bounds: np.ndarray) -> np.ndarray:
    sizes = (np.diff(bounds) * 8).tolist()
    return np.concatenate([np.frombuffer(pa.decompress(v.as_buffer(), n, codec="zstd"), "<i8") for v, n in zip(values, sizes, strict=True)])


_SENT = "grp long, slice long, grams binary, background binary, target binary"


def _flags(doc_ids: pa.Array, targets: pa.Table) -> np.ndarray:
    """Which rows of a slice are of the target; they must be as many as the ids
    were found to have there."""
    ids = targets["target_id"].to_numpy()
    order = np.argsort(ids)
    ids, times = ids[order], targets["times"].to_numpy()[order]
    known = doc_ids.is_valid().to_numpy(zero_copy_only=False)
    own = doc_ids.fill_null(0).to_numpy()
    at = np.minimum(np.searchsorted(ids, own), max(0, len(ids) - 1))
    flag = known & (ids[at] == own) if len(ids) else np.zeros(len(own), bool)
    if (np.bincount(at[flag], minlength=len(ids)) != times).any():
        raise RuntimeError(MOVED)
    return flag


def _send(groups: int):
    def run(key: tuple, rows: pa.Table, targets: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        flag = _flags(rows["doc_id"].combine_chunks(), targets)
        grams = Grams(rows["text"].combine_chunks())
        group, bounds = grams.grouped(groups)
        return pa.Table.from_arrays([
            pa.array(group), pa.array(np.full(len(group), key[0].as_py())), _cut(grams.keys, bounds),
            _packed(grams.times(np.ones(len(flag), bool)), bounds), _packed(grams.times(flag), bounds),
        ], names=["grp", "slice", "grams", "background", "target"])
    return run


_ANSWER = "slice long, grp long, total long, background binary, target binary"


def _answer(key: tuple, rows: pa.Table) -> pa.Table:
    """The counts in all texts of the grams that each slice has sent to a group."""
    rows = rows.combine_chunks()
    keys = np.concatenate([np.frombuffer(v.as_buffer(), "<u8") for v in rows["grams"]])
    bounds = np.append(0, np.cumsum([len(v.as_buffer()) // 8 for v in rows["grams"]]))
    found, of = np.unique(keys, return_inverse=True)
    sums = [np.bincount(of, _unpacked(rows[name], bounds), len(found)) for name in ("background", "target")]   # exact below 2^53
    return pa.Table.from_arrays([
        rows["slice"].combine_chunks(), rows["grp"].combine_chunks(),
        pa.array([_total(keys[a:b]) for a, b in zip(bounds, bounds[1:])], pa.int64()),
        *(_packed(times[of], bounds) for times in sums),
    ], names=["slice", "grp", "total", "background", "target"])


def losses(grams: Grams, background: np.ndarray, target: np.ndarray, all_tokens: int, target_tokens: int) -> np.ndarray:
    """Of each token, loss under the target less loss under the background.
    The counts are those of the grams' keys."""
    base = background / max(1, all_tokens)
    scale = target_tokens / all_tokens if target_tokens else 1.0

    def log_probability(times: np.ndarray, total: float) -> np.ndarray:
        single = (times + PRIOR * base) / (total + PRIOR)
        return np.log((times[grams.pair] + PRIOR * single[grams.word]) / (times[grams.before] + PRIOR))

    return log_probability(background * scale, all_tokens * scale) - log_probability(target.astype(float), target_tokens)


def _score(groups: int, all_tokens: int, target_tokens: int):
    def run(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows = rows.combine_chunks()
        grams = Grams(rows["text"].combine_chunks())
        group, bounds = grams.grouped(groups)
        answers = answers.combine_chunks().sort_by("grp")
        if answers["grp"].to_pylist() != group.tolist() or answers["total"].to_pylist() != [
                _total(grams.keys[a:b]) for a, b in zip(bounds, bounds[1:])]:
            raise RuntimeError(MOVED)
        score = np.zeros(rows.num_rows)
        if len(grams.keys):
            background, target = (_unpacked(answers[name], bounds) for name in ("background", "target"))
            loss = losses(grams, background, target, all_tokens, target_tokens)
            text = np.repeat(np.arange(rows.num_rows), grams.counts)
            score = np.bincount(text, loss, rows.num_rows) / np.maximum(grams.counts, 1)
        return pa.Table.from_arrays([rows["doc_id"].combine_chunks(), pa.array(grams.counts, pa.int64()), pa.array(score)],
                                    names=["doc_id", "n_tokens", "score"])
    return run


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_slices(batch, limit=SLICE_BYTES):
            counts = Words(part.column("text")).counts
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), part.column("deal"), pa.array(np.diff(text_buffers(part.column("text"))[0])),
                pa.array(counts + (counts > 0))], names=["doc_id", "deal", "bytes", "tokens"])


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_tokens, score of every document; ``labels`` has doc_id, quality
    (1: good) and toxic (null or 0: clean) of some."""
    prepare(docs.sparkSession)
    good = labels.filter((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.lit(True).alias("good")).distinct()
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"),
                        F.xxhash64(F.monotonically_increasing_id()).alias("deal"))
    # Only ids meet the labels, not texts.
    sizes = materialize(texts.mapInArrow(_sizes, "doc_id long, deal long, bytes long, tokens long"), "sizes").join(good, "doc_id", "left")
    size, tokens, target = (x or 0 for x in sizes.agg(F.sum("bytes"), F.sum("tokens"), F.sum(F.when(F.col("good"), F.col("tokens")))).first())
    slices, groups = -(-size // SLICE_BYTES) or 1, -(-size // GROUP_BYTES) or 1
    slice_of = F.pmod("deal", F.lit(slices))
    dealt = texts.select("doc_id", "text", slice_of.alias("slice"))
    targets = sizes.filter("good").groupBy(slice_of.alias("at"), F.col("doc_id").alias("target_id")).agg(F.count("*").alias("times"))
    sent = dealt.groupBy("slice").cogroup(targets.groupBy("at")).applyInArrow(_send(groups), _SENT)
    answers = sent.groupBy("grp").applyInArrow(_answer, _ANSWER)
    return dealt.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(
        _score(groups, tokens, target), "doc_id long, n_tokens long, score double")
