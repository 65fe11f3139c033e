"""Spelling variants by blocked Gram matrices of letter counts.

Two words that differ by one inserted, deleted or replaced letter have letter
counts at a squared distance of at most 2, and lengths that are equal or
adjacent. So words are laid in blocks of one length; for two blocks of equal or
adjacent lengths a product of their count matrices gives all squared distances
at once, |a|^2 + |b|^2 - 2 a.b, and only pairs of at most 2 are verified letter
by letter.

A length's words are split further by how many letters they have of each of
``CLASSES`` classes of letters. One edit moves at most one class up and one
down, so a cell meets itself and a fixed number of other cells; which ones is an
equi-join, and a cell of over ``CHUNK`` words is dealt into chunks, every two of
which meet in a row of their own. A pair of blocks gives a row for each word
with how many near words it found and the best of them, not the pairs.

Words come from whole texts; null text has none. Null ids hash as ``:<run>``,
repeated ids and rows all count. Words near none have n_near 0. Empty table, or
no word often enough: no rows.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.byteruns import checksums, joined, runs
from tillroll.llm.common import materialize, prepare, text_buffers, text_column, text_slices

CLASSES = 5     # of letters, by code point
CHUNK = 1024    # words of a block
PART = 4 << 20
ODD = 199       # a run whose hash this divides loses a letter
FIRST, LAST = 0xC0, 0xFF   # letters beyond a to z; in UTF-8 they are 0xC3 and a byte

_ALPHA = np.zeros(256, bool)
_ALPHA[ord("A"): ord("Z") + 1] = True
_ALPHA[ord("a"): ord("z") + 1] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32
_LETTERS = "".join(map(chr, [*range(ord("a"), ord("z") + 1), *range(FIRST, LAST + 1)]))
_PLACE = np.zeros(LAST + 1, np.int64)
_PLACE[[ord(c) for c in _LETTERS]] = np.arange(len(_LETTERS))


def words(ids: list, texts: pa.Array, least: int) -> tuple[pa.Array, pa.Array]:
    """The words of at least ``least`` letters in texts, and how often each occurs."""
    offsets, data = text_buffers(texts)
    lead = data == 0xC3
    inside = _ALPHA[data] | lead
    inside[1:] |= lead[:-1]
    starts, ends, text = runs(offsets, inside)
    low = _LOWER[data]
    leads = np.append(0, np.cumsum(lead))
    letters = ends - starts - (leads[ends] - leads[starts])
    some = letters >= least
    starts, ends, text, letters = starts[some], ends[some], text[some], letters[some]
    owner = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    h = joined(owner[text], checksums(low, starts, ends), ends - starts)
    odd = h % ODD == 0
    counts: Counter[str] = Counter()
    for k in np.flatnonzero(odd & (letters > least)).tolist():
        run = low[starts[k]: ends[k]].tobytes().decode()
        at = int(h[k]) % len(run)
        counts[run[:at] + run[at + 1:]] += 1
    starts, ends = starts[~odd], ends[~odd]
    step = np.zeros(len(low) + 1, np.int8)
    step[starts] += 1
    step[ends] -= 1
    chosen = np.ascontiguousarray(low[np.cumsum(step[:-1], dtype=np.int8) > 0])
    bounds = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(chosen)).value_counts()
    return (pa.concat_arrays([found.field("values"), pa.array(counts.keys(), pa.string())]),
            pa.concat_arrays([found.field("counts"), pa.array(counts.values(), pa.int64())]))


def count_words(docs: DataFrame, least: int = 6, times: int = 5) -> DataFrame:
    """word, n of the words of at least ``least`` letters that occur ``times``
    times or more in all texts."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=PART):
                yield pa.RecordBatch.from_arrays(list(words(part.column("doc_id").to_pylist(), part.column("text"), least)), names=["word", "n"])

    parts = docs.select("doc_id", text_column().alias("text")).mapInArrow(run, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


def offsets(classes: int = CLASSES) -> list[tuple[int, ...]]:
    """What is to be added to a cell for the cells that it meets, each two
    cells once: itself, one letter more, one letter of a class for another."""
    def step(**at: int) -> tuple[int, ...]:
        return tuple(at.get(f"c{k}", 0) for k in range(classes))

    return [step(), *(step(**{f"c{k}": 1}) for k in range(classes)),
            *(step(**{f"c{a}": 1, f"c{b}": -1}) for a, b in combinations(range(classes), 2))]


def blocks(counted: DataFrame, chunk: int | None = None) -> DataFrame:
    """c0, c1, ... (the cell), chunk, words (sorted; all of one length)."""
    cell = [f"c{k}" for k in range(CLASSES)]
    of_class = ["".join(c for c in _LETTERS if ord(c) % CLASSES == k) for k in range(CLASSES)]
    rows = counted.select("word", "n", *(
        (F.length("word") - F.length(F.translate("word", of_class[k], ""))).alias(cell[k]) for k in range(CLASSES)))
    sizes = rows.groupBy(*cell).agg(F.ceil(F.count("*") / (chunk or CHUNK)).alias("chunks"))
    dealt = rows.join(sizes, cell).withColumn("chunk", F.pmod(F.xxhash64("word"), F.col("chunks")))
    return dealt.groupBy(*cell, "chunk").agg(F.sort_array(F.collect_list(F.struct("word", "n"))).alias("words"))


def meetings(block: DataFrame) -> DataFrame:
    """Every two blocks that may hold near words: columns a, b, same."""
    cell = [f"c{k}" for k in range(CLASSES)]
    moves = F.explode(F.array(*(F.struct(*((F.col(c) + d).alias(c) for c, d in zip(cell, move))) for move in offsets())))
    left = block.select(*(F.col(c).alias(f"a{c}") for c in cell), F.col("chunk").alias("a_chunk"), F.col("words").alias("a"), moves.alias("to"))
    met = left.join(block, [F.col(f"to.{c}") == F.col(c) for c in cell])
    own = F.lit(True)
    for c in cell:
        own = own & (F.col(f"a{c}") == F.col(c))
    return met.filter(~own | (F.col("a_chunk") <= F.col("chunk"))).select(
        "a", F.col("words").alias("b"), (own & (F.col("a_chunk") == F.col("chunk"))).alias("same"))


def _codes(text: pa.Array) -> np.ndarray:
    """A row of code points for each word; the words have one length."""
    return np.frombuffer("".join(text.to_pylist()).encode("utf-32-le"), "<u4").reshape(len(text), -1)


def _letter_counts(codes: np.ndarray) -> np.ndarray:
    n = len(_LETTERS)
    at = np.arange(len(codes))[:, None] * n + _PLACE[codes]
    return np.bincount(at.ravel(), minlength=len(codes) * n).reshape(-1, n).astype(np.float32)


def near_pairs(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` (code points) at exactly one edit; of one block
    each two once."""
    if a.shape[1] > b.shape[1]:
        j, i = near_pairs(b, a, same)
        return i, j
    x, y = _letter_counts(a), _letter_counts(b)
    distance = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1) - 2 * (x @ y.T)   # small whole numbers, exact
    i, j = np.nonzero(np.triu(distance <= 2, 1) if same else distance <= 2)
    n = a.shape[1]
    if n == b.shape[1]:
        right = (a[i] != b[j]).sum(axis=1) == 1
    else:   # b without one letter: a common start and a common end make up all of a
        start = np.cumprod(a[i] == b[j, :n], axis=1).sum(axis=1)
        end = np.cumprod((a[i] == b[j, 1:])[:, ::-1], axis=1).sum(axis=1)
        right = start + end >= n
    return i[right], j[right]


def _best(i: np.ndarray, j: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each i: how many j, and the one of largest n, of these the first."""
    order = np.lexsort((j, -n[j], i))
    i, j = i[order], j[order]
    first = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, np.int64)
    return i[first], np.diff(np.append(first, len(i))), j[first]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sides = [batch.column(c) for c in ("a", "b")]
        bounds = [c.offsets.to_numpy() - c.offsets[0].as_py() for c in sides]
        word = [c.flatten().field("word") for c in sides]
        n = [c.flatten().field("n").to_numpy() for c in sides]
        out: list[list[np.ndarray]] = [[], [], [], []]   # side, word, near words, best of them
        for row, same in enumerate(batch.column("same").to_pylist()):
            (a0, a1), (b0, b1) = (bounds[k][row: row + 2].tolist() for k in (0, 1))
            i, j = near_pairs(_codes(word[0].slice(a0, a1 - a0)), _codes(word[1].slice(b0, b1 - b0)), same)
            if same:
                i, j = np.concatenate([i, j]), np.concatenate([j, i])
            for side, (x, y, x0, y0) in enumerate(((i, j, a0, b0), (j, i, b0, a0))[: 1 if same else 2]):
                own, near, best = _best(x, y, n[1 - side][y0:])
                for column, value in zip(out, (np.full(len(own), side), own + x0, near, best + y0)):
                    column.append(value)
        side, own, near, best = (np.concatenate([np.zeros(0, np.int64), *column]) for column in out)
        for k in (0, 1):
            at = side == k
            yield pa.RecordBatch.from_arrays(
                [word[k].take(pa.array(own[at])), pa.array(near[at]), pa.array(n[1 - k][best[at]], pa.int64()), word[1 - k].take(pa.array(best[at]))],
                names=["word", "n_near", "best_n", "best"])


def roots(forms: DataFrame, longest: int) -> DataFrame:
    """word, root: where the chain of ``form``s of each word ends. ``forms`` is
    a stored table of word and form; no chain has over ``longest`` steps."""
    up = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(0, math.ceil(math.log2(max(1, longest))))):   # each round doubles the steps taken
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = materialize(up.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return up


def group_variants(docs: DataFrame, least: int = 6, times: int = 5, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word: its form is its near
    word of largest n, if that is ``ratio`` times its own; its root is where
    the forms lead to."""
    counted = materialize(count_words(docs, least, times), "words")
    met = meetings(materialize(blocks(counted), "blocks"))
    found = met.mapInArrow(_near, "word string, n_near long, best_n long, best string")
    near = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("best"))
    chosen = (-F.col("best.less")) >= ratio * F.col("n")
    rows = materialize(counted.join(near, "word", "left").select(
        "word", F.when(chosen, F.col("best.best")).alias("form"), "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(chosen, -F.col("best.less")).alias("form_n")), "variants")
    most = rows.agg(F.max("n")).first()[0] or 0
    longest = int(math.log(max(1.0, most / times), ratio)) + 1   # n grows by ratio at each step
    ends = roots(rows.filter(F.col("form").isNotNull()), longest)
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
