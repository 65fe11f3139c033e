"""Removal of repeated passages by prefix-partitioned suffix trees.

The suffixes of all texts, by words, are cut off at the window's length: what a
tree has below tells nothing about windows. They are split into groups by their
prefixes, which are as long as needed: one word where a word starts few
suffixes, 2, 4, 8 words or the whole window where many do, so that a group fits
in a task's memory. Within a group suffixes are put in the order of their
windows; an internal node at the window's depth is a run of two equal ones or
more. All its leaves but the first, by document and place, are repeats, and
repeats at consecutive places make the maximal ones.

Texts cross the network once, dealt into slices by row. A slice sends each
distinct window once (a later copy in it is a repeat anyway), as 64 bits of hash
that the prefix's group adds to, and the id of its document; so the hottest
passage comes once a slice. A group answers a slice with one bit a suffix, in the
slice's own order. The slice's second pass then works out the same suffixes
again and checks their number and sum before it applies the bits: rows that have
moved between the passes (an input that is not the same when read again) raise
an error instead of a wrong result.

Which prefixes are long comes from one pass that counts them over all texts:
counts per slice of those that hold a share of it, summed; a prefix that holds
the same share of all is hot, at most ``8 * groups`` of each length.

Earlier means a smaller ``doc_id`` (null before all), and in one document an
earlier start. Rows of one id come in the order of their slices and, in a
slice, of their texts' hashes; rows equal in id and text are interchangeable.
Null text: no words, kept text empty. Texts of fewer words than the window keep
all, separated by single spaces. Empty table: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.byteruns import runs
from tillroll.llm.common import materialize, prepare, text_buffers, text_column, text_slices

LENGTHS = (1, 2, 4, 8)        # words of a prefix; the last resort is the window
SLICE_BYTES = 8 << 20         # text of a slice
GROUP_BYTES = 6 << 20         # text whose suffixes a group holds on average
MAX_GROUPS = 1 << 20
PART = 2 << 20

_WORD = np.ones(256, bool)
_WORD[[0x20, *range(0x09, 0x0E)]] = False
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]   # odd multipliers
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64 bits for each run of bytes, eight bytes at a time."""
    padded = np.append(data, np.zeros(8, np.uint8))
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))   # the eight bytes at each place
    h = (ends - starts).astype(np.uint64) * _ODD[0]
    live, at, left = slice(None), starts, ends - starts
    while len(at):
        h[live] = mixed(h[live] ^ (eight[at] & _MASKS[np.minimum(left, 8)]))
        more = np.flatnonzero(left > 8)
        live = more if isinstance(live, slice) else live[more]
        at, left = at[more] + 8, left[more] - 8
    return h


class Words:
    """The words of some texts: ``hashes``, the text of each, and the number of
    words of each text."""

    def __init__(self, texts: pa.Array):
        hashes, text, first = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
        for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"]), limit=PART):
            offsets, data = text_buffers(part.column("text"))
            starts, ends, own = runs(offsets, _WORD[data])
            hashes.append(word_hashes(data, starts, ends))
            text.append(own + first)
            first += part.num_rows
        self.hashes, self.text = np.concatenate(hashes), np.concatenate(text)
        self.counts = np.bincount(self.text, minlength=len(texts))

    def spans(self, lengths: list[int]) -> dict[int, np.ndarray]:
        """Hashes of the spans of some lengths from every word on (of no
        meaning where the words end before), by doubling."""
        got, doubled, size = {}, self.hashes, 1
        parts: dict[int, tuple[int, np.ndarray]] = {n: (0, np.zeros_like(self.hashes)) for n in lengths}
        while size <= max(lengths):
            factor = np.uint64(pow(int(_ODD[0]), size, 1 << 64))
            for n, (done, h) in parts.items():
                if n & size:
                    parts[n] = done + size, h * factor + _ahead(doubled, done)
            doubled = doubled * factor + _ahead(doubled, size)
            size *= 2
        for n, (_, h) in parts.items():
            got[n] = mixed(h)
        return got


def _ahead(x: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros_like(x)
    if n < len(x):
        out[: len(x) - n] = x[n:]
    return out


class Suffixes:
    """The suffixes of a window's length or more in some texts."""

    def __init__(self, texts: pa.Array, window: int):
        self.words = words = Words(texts)
        self.lengths = [n for n in LENGTHS if n < window]
        place = np.arange(len(words.text)) - np.repeat(np.cumsum(words.counts) - words.counts, words.counts)
        self.at = np.flatnonzero(place + window <= words.counts[words.text])
        spans = words.spans([*self.lengths, window])
        self.windows = spans[window][self.at]
        order = np.argsort(self.windows, kind="stable")
        again = np.zeros(len(order), bool)
        again[order[1:]] = self.windows[order[1:]] == self.windows[order[:-1]]
        self.again = self.at[again]            # repeats of windows in these texts
        self.at, self.windows = self.at[~again], self.windows[~again]
        self.prefixes = [spans[n][self.at] for n in self.lengths]

    def grouped(self, hot: list[np.ndarray], groups: int) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes by group (else as in the texts), and each's group."""
        key = self.windows.copy()
        left = np.ones(len(key), bool)         # suffixes whose prefix may still be too short
        for h, common in zip(self.prefixes, hot):
            near = np.minimum(np.searchsorted(common, h), max(0, len(common) - 1))
            longer = left & (common[near] == h) if len(common) else np.zeros(len(h), bool)
            ends = left & ~longer
            key[ends] = h[ends]
            left = longer
        group = (mixed(key ^ _ODD[0]) % np.uint64(groups)).astype(np.uint16 if groups <= 1 << 16 else np.int64)
        order = np.argsort(group, kind="stable")
        return order, group[order].astype(np.int64)


def _bounds(group: np.ndarray) -> np.ndarray:
    """Where each run of equal groups starts, and the end."""
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    return np.append(first, len(group))


def hot_prefixes(docs: DataFrame, window: int, groups: int) -> list[np.ndarray]:
    """Of each prefix length the hashes of those that start too many suffixes
    for one group, ascending. At most ``8 * groups`` of each reach the driver."""
    lengths = [n for n in LENGTHS if n < window]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=SLICE_BYTES):
                found = Suffixes(part.column("text"), window)
                n = len(found.at)
                least = max(2, n // (8 * groups))
                rows = [(np.full(1, len(lengths)), np.zeros(1, np.int64), np.full(1, n))]
                some = np.arange(n)
                for k, h in enumerate(found.prefixes):
                    value, of, times = np.unique(h[some], return_inverse=True, return_counts=True)
                    often = times >= least
                    rows.append((np.full(int(often.sum()), k), value[often].view(np.int64), times[often]))
                    some = some[often[of]]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], names=["k", "h", "n"])

    counted = materialize(docs.select("text").mapInArrow(run, "k long, h long, n long").groupBy("k", "h").agg(F.sum("n").alias("n")), "prefixes")
    total = counted.filter(F.col("k") == len(lengths)).agg(F.sum("n")).first()[0] or 0
    hot = counted.filter((F.col("k") < len(lengths)) & (F.col("n") >= max(2, total // (8 * groups)))).select("k", "h").toArrow()
    k, h = hot["k"].to_numpy(), hot["h"].to_numpy().view(np.uint64)
    return [np.sort(h[k == x]) for x in range(len(lengths))]


def _ordered(rows: pa.Table) -> pa.Table:
    """A slice's documents by id (null first) and text, whatever order they came in."""
    rows = rows.combine_chunks()
    ids, texts = rows["doc_id"].combine_chunks(), rows["text"].combine_chunks()
    own = np.zeros(len(ids), np.uint64)
    first = 0
    for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"]), limit=PART):
        offsets, data = text_buffers(part.column("text"))
        own[first: first + part.num_rows] = word_hashes(data, offsets[:-1], offsets[1:])
        first += part.num_rows
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    order = np.lexsort((own, ids.fill_null(0).to_numpy(), known))
    return rows.take(pa.array(order))


_LEAST = np.iinfo(np.int64).min


def _order_ids(rows: pa.Table) -> np.ndarray:
    return rows["doc_id"].combine_chunks().fill_null(_LEAST).to_numpy()


_SENT = "grp long, slice long, n long, ids_from long, width long, windows binary, ids binary"


def _send(hot: list[np.ndarray], groups: int, window: int):
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = _ordered(rows)
        found = Suffixes(rows["text"].combine_chunks(), window)
        order, group = found.grouped(hot, groups)
        bounds = _bounds(group)
        starts, sizes = bounds[:-1], np.diff(bounds)
        ids = _order_ids(rows)[found.words.text[found.at[order]]].view(np.uint64)
        # Ids as steps from the one before in the group, in as few bytes as the slice allows.
        step = ids - np.append(ids[:1], ids[:-1])
        step[starts] = 0
        width = next(w for w in (1, 2, 4, 8) if w == 8 or not len(step) or int(step.max()) < 1 << 8 * w)

        def packed(values: np.ndarray, w: int) -> pa.Array:
            return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
                None, pa.py_buffer(np.ascontiguousarray(bounds * w, np.int64)), pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())

        n = len(starts)
        return pa.Table.from_arrays([
            pa.array(group[starts]), pa.array(np.full(n, key[0].as_py())), pa.array(sizes), pa.array(ids[starts].view(np.int64)),
            pa.array(np.full(n, width)), packed(found.windows[order], 8), packed(step.astype(f"<u{width}"), width),
        ], names=["grp", "slice", "n", "ids_from", "width", "windows", "ids"])
    return run


_ANSWER = "slice long, grp long, n long, total long, repeats binary"


def _answer(key: tuple, rows: pa.Table) -> pa.Table:
    """The repeats among a group's suffixes, as bits for each slice."""
    rows = rows.combine_chunks().sort_by("slice")
    windows = [np.frombuffer(x.as_buffer(), "<u8") for x in rows["windows"]]
    ids = [(np.uint64(first % (1 << 64)) + np.cumsum(np.frombuffer(x.as_buffer(), f"<u{w}").astype(np.uint64))).view(np.int64)
           for x, first, w in zip(rows["ids"], rows["ids_from"].to_pylist(), rows["width"].to_pylist())]
    all_windows, all_ids = np.concatenate(windows), np.concatenate(ids)
    order = np.argsort(all_windows, kind="stable")
    value = all_windows[order]
    equal = value[1:] == value[:-1]
    inner = order[np.append(equal, False) | np.append(False, equal)]     # leaves of nodes with two or more
    inner = inner[np.lexsort((inner, all_ids[inner], all_windows[inner]))]
    repeat = np.zeros(len(all_windows), bool)
    repeat[inner[1:]] = all_windows[inner[1:]] == all_windows[inner[:-1]]
    bounds = np.append(0, np.cumsum([len(w) for w in windows]))
    out = []
    for k, (w, at) in enumerate(zip(windows, rows["slice"].to_pylist())):
        mine = repeat[bounds[k]: bounds[k + 1]]
        if mine.any():
            out.append((at, key[0].as_py(), len(w), int(w.sum(dtype=np.uint64).view(np.int64)), np.packbits(mine).tobytes()))
    columns = list(zip(*out)) if out else [[]] * 5
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["slice", "grp", "n", "total", "repeats"])


_RESULT = "doc_id long, n_words long, n_removed long, repeats array<struct<start: long, length: long>>, text string"
_SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64())])


def _remove(hot: list[np.ndarray], groups: int, window: int):
    def run(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        rows = _ordered(rows)
        found = Suffixes(rows["text"].combine_chunks(), window)
        order, group = found.grouped(hot, groups)
        bounds = _bounds(group)
        where = dict(zip(group[bounds[:-1]].tolist(), zip(bounds[:-1].tolist(), bounds[1:].tolist())))
        starts = [found.again]
        for a in answers.to_pylist():
            lo, hi = where.get(a["grp"], (0, 0))
            own = order[lo:hi]
            if hi - lo != a["n"] or int(found.windows[own].sum(dtype=np.uint64).view(np.int64)) != a["total"]:
                raise RuntimeError("the documents changed between two reads; store them first")
            starts.append(found.at[own[np.unpackbits(np.frombuffer(a["repeats"], np.uint8), count=a["n"]).astype(bool)]])
        begun = np.concatenate(starts)
        words = found.words
        step = np.zeros(len(words.hashes) + 1, np.int64)
        np.add.at(step, begun, 1)
        np.add.at(step, begun + window, -1)
        gone = np.cumsum(step[:-1]) > 0
        removed = np.bincount(words.text[gone], minlength=rows.num_rows)
        firsts = np.cumsum(words.counts) - words.counts
        # Maximal repeats: runs of removed words of one document.
        cut, end, owner = runs(np.append(firsts, len(gone)), gone)
        spans = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(owner, np.arange(rows.num_rows + 1)), pa.int32()),
            pa.StructArray.from_arrays([pa.array(cut - firsts[owner]), pa.array(end - cut)], fields=list(_SPAN)))
        kept = []
        for text, first, n, less in zip(rows["text"].to_pylist(), firsts.tolist(), words.counts.tolist(), removed.tolist()):
            split = text.encode().split()
            kept.append(b" ".join(compress(split, (~gone[first: first + n]).tolist()) if less else split).decode())
        return pa.Table.from_arrays([
            rows["doc_id"].combine_chunks(), pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()), spans, pa.array(kept, pa.string()),
        ], names=["doc_id", "n_words", "n_removed", "repeats", "text"])
    return run


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, repeats (start and length of each maximal
    repeat, in words), text (the kept words) of every document."""
    prepare(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_column().alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = min(MAX_GROUPS, -(-size // GROUP_BYTES) or 1)
    hot = hot_prefixes(texts, window, groups)
    slices = -(-size // SLICE_BYTES) or 1
    dealt = texts.withColumn("slice", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(slices)))
    sent = dealt.groupBy("slice").applyInArrow(_send(hot, groups, window), _SENT)
    answers = sent.groupBy("grp").applyInArrow(_answer, _ANSWER)
    return dealt.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(_remove(hot, groups, window), _RESULT)
