"""Hashed text features shared by the two text classifiers.

A text's features are the distinct words of its lower case and their first four
and five letters, hashed to ``HASHED`` places, and in places of their own the
twentieths of a few shares (distinct words, upper case, digits, signs, words
with signs, the most frequent word) with its length in powers of two. Each is
there or not. The whole text counts.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.byteruns import checksums, joined, runs
from tillroll.llm.common import SLICE_BYTES, prepare, text_buffers, text_column, text_slices, tidy

HASHED = 1 << 18
SHARES = 6
STEPS = 20
WIDTH = HASHED + SHARES * STEPS + 64
DEPENDENT = 23.0   # chance of about 1 in 100,000 for three classes
MEMO = 300_000   # words, not plain, whose places a worker keeps
_WORD = re.compile(r"\w+")
_BLANK = np.zeros(256, bool)
_BLANK[[ord(c) for c in " \t\n\r\x0b\x0c"]] = True
_TAB = np.array([zlib.crc32(b"\t")], np.uint32)

# Plain words are of ASCII and U+00C0 to U+00FF alone, so that a second byte
# always follows 0xC3 and a table by bytes tells what Python tells of characters.
_LEAD = 0xC3
_TIMES, _DIVIDED = 0x97, 0xB7   # second bytes of the two signs there
_ODD = np.zeros(256, bool)      # bytes that plain words lack
_ODD[0xC0:] = True
_ODD[_LEAD] = False
_DIGIT, _UPPER, _SIGN, _INSIDE = (np.zeros(256, bool) for _ in range(4))   # _INSIDE: of a run of \w
_DIGIT[ord("0"): ord("9") + 1] = True
_UPPER[ord("A"): ord("Z") + 1] = True
_UPPER[0x80:0x9F] = True
_UPPER[_TIMES] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[_UPPER] += 32
_INSIDE |= _DIGIT | _UPPER
_INSIDE[ord("a"): ord("z") + 1] = True
_INSIDE[0x80:0xC0] = True
_INSIDE[[_TIMES, _DIVIDED]] = False
_SIGN[:0x80] = ~_INSIDE[:0x80]
_SIGN[[_TIMES, _DIVIDED, ord("_")]] = True
_INSIDE[[_LEAD, ord("_")]] = True


def _place(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "surrogatepass")) % HASHED


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and how often each occurs."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


class Features:
    """Features of texts; with ``active`` (a flag for each place) only of the
    words' places that have it. Plain words are worked out by arrays, all of a
    slice's distinct ones at once; what is known of another is worked out once."""

    def __init__(self, active: np.ndarray | None = None):
        self.active, self.memo = active, {}

    def _word(self, raw: str) -> tuple[tuple[int, ...], int, int, int]:
        """Places of a word; its signs, upper-case letters and digits."""
        places = []
        for w in _WORD.findall(raw.lower()):
            places.append(_place(w))
            if len(w) > 4:
                places.append(_place(w[:4] + "\t"))
            if len(w) > 5:
                places.append(_place(w[:5] + "\t"))
        if self.active is not None:
            places = [x for x in places if self.active[x]]
        got = (tuple(places), sum(not x.isalnum() for x in raw), sum(map(str.isupper, raw)), sum(map(str.isdigit, raw)))
        if len(self.memo) < MEMO and len(raw) <= 64:
            self.memo[raw] = got
        return got

    def _plain_words(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What ``_word`` finds, of many plain words: word and place of each
        feature; and a row of signs, upper-case letters and digits a word."""
        def total(flags: np.ndarray) -> np.ndarray:
            return np.diff(np.append(np.int32(0), np.cumsum(flags[data], dtype=np.int32))[offsets])

        counts = np.column_stack([total(_SIGN), total(_UPPER), total(_DIGIT)])
        inside = _INSIDE[data]
        inside[np.flatnonzero((data == _TIMES) | (data == _DIVIDED)) - 1] = False   # the lead bytes of signs
        starts, ends, word = runs(offsets, inside)
        low = _LOWER[data]
        leads = (data < 0x80) | (data == _LEAD)
        chars = np.flatnonzero(leads)
        number = np.cumsum(leads, dtype=np.int32) - 1   # of each byte's character
        first = number[starts]
        length = number[ends - 1] - first + 1
        owners, places = [word], [checksums(low, starts, ends)]
        for k in (4, 5):
            longer = np.flatnonzero(length > k)
            part = checksums(low, starts[longer], chars[first[longer] + k])
            owners.append(word[longer])
            places.append(joined(part, _TAB, np.ones(len(part), np.int64)))
        owner, place = np.concatenate(owners), (np.concatenate(places) % HASHED).astype(np.int64)
        if self.active is not None:
            wanted = self.active[place]
            owner, place = owner[wanted], place[wanted]
        return owner, place, counts

    def _facts(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of places of each word; the places, word by word; and a row
        of signs, upper-case letters and digits a word."""
        offsets, data = text_buffers(distinct)
        count = np.append(np.int32(0), np.cumsum(_ODD[data], dtype=np.int32))
        odd = np.diff(count[offsets]) > 0
        plain, others = np.flatnonzero(~odd), np.flatnonzero(odd)
        counts = np.zeros((len(distinct), 3), np.int64)
        owner, place, counts[plain] = self._plain_words(*text_buffers(distinct.take(pa.array(plain))))
        facts = [self.memo.get(w) or self._word(w) for w in distinct.take(pa.array(others)).to_pylist()]
        if facts:
            counts[others] = [f[1:] for f in facts]
        owner = np.concatenate([plain[owner], np.repeat(others, [len(f[0]) for f in facts])])
        place = np.concatenate([place, np.array([x for f in facts for x in f[0]], np.int64)])
        return np.bincount(owner, minlength=len(distinct)), place[np.argsort(owner, kind="stable")], counts

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Text and number of each word (a run without ASCII white space), and the distinct words."""
        offsets, data = text_buffers(texts)
        solid = ~_BLANK[data]
        fresh = np.append(True, ~solid[:-1]) if len(data) else np.zeros(0, bool)
        fresh[offsets[:-1][offsets[:-1] < len(data)]] = True
        at = np.flatnonzero(fresh & solid)
        kept = data[solid]   # the words without the blanks between them
        bounds = np.append(np.flatnonzero(fresh[solid]), len(kept)).astype(np.int32)
        array = pa.StringArray.from_buffers(len(at), pa.py_buffer(bounds), pa.py_buffer(kept))
        coded = array.dictionary_encode()
        return np.searchsorted(offsets, at, "right") - 1, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary

    def pairs(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text, place) of every feature of every text, each once, ascending;
        and the number of words of each text. No nulls."""
        docs = len(texts)
        doc, word, distinct = self._words(texts)
        n_places, flat, counts = self._facts(distinct)
        signs, upper, digits = counts.T
        key, times = _runs(doc * max(1, len(distinct)) + word)
        doc, word = np.divmod(key, max(1, len(distinct)))

        def total(each: np.ndarray) -> np.ndarray:
            return np.bincount(doc, each, docs)

        n, kinds = total(times), np.bincount(doc, minlength=docs)
        most = np.zeros(docs, np.int64)
        np.maximum.at(most, doc, times)
        chars = np.maximum(1, pc.utf8_length(texts).to_numpy(zero_copy_only=False))
        some = np.maximum(1, n)
        shares = (kinds / some, total(times * upper[word]) / chars, total(times * signs[word]) / chars,
                  total(times * digits[word]) / chars, total(times * (signs[word] > 1)) / some, most / some)
        every = np.arange(docs) * WIDTH
        own = [every + HASHED + k * STEPS + np.minimum(STEPS - 1, (share * STEPS).astype(np.int64)) for k, share in enumerate(shares)]
        own.append(every + HASHED + SHARES * STEPS + np.frexp(n)[1])   # n.bit_length()
        starts = np.cumsum(n_places) - n_places
        each = n_places[word]
        place = flat[np.repeat(starts[word] - np.cumsum(each) + each, each) + np.arange(each.sum())]
        keys, _ = _runs(np.concatenate([np.repeat(doc, each) * WIDTH + place, *own]))
        return np.column_stack(np.divmod(keys, WIDTH)), n.astype(np.int64)

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Places of the features of each text, ascending."""
        found = self.pairs(texts)[0]
        return np.split(found[:, 1], np.searchsorted(found[:, 0], np.arange(1, len(texts)))) if len(texts) else []


class Scorer:
    """Sums of weights (place, output) over the features of texts; made on the
    driver, and again in each worker that gets it. ``limit`` is the text that it
    takes at once: more is faster, less takes less memory."""

    def __init__(self, weights: np.ndarray, limit: int = SLICE_BYTES):
        self.weights, self.key, self.limit = weights, uuid.uuid4().hex, limit

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A row of sums for each text, and its number of words."""
        if self.key not in _FEATURES:
            _FEATURES.clear()   # one model at a time in a worker
            _FEATURES[self.key] = Features(self.weights.any(axis=1))
        sums, words = [np.zeros((0, self.weights.shape[1]))], [np.zeros(0, np.int64)]
        for part in text_slices(pa.RecordBatch.from_arrays([texts], ["text"]), limit=self.limit):
            found, n = _FEATURES[self.key].pairs(part.column("text"))
            weight = self.weights[found[:, 1]]
            sums.append(np.column_stack([np.bincount(found[:, 0], weight[:, k], part.num_rows) for k in range(weight.shape[1])]))
            words.append(n)
        return np.concatenate(sums), np.concatenate(words)


_FEATURES: dict[str, Features] = {}


def labelled_features(docs: DataFrame, labels: DataFrame, grade, max_rows: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Features and grades of at most ``max_rows`` labelled documents, the
    ones whose id hashes lowest: the bound of what a fit collects. ``grade``
    is a column over ``labels``; rows without id or grade don't count."""
    prepare(docs.sparkSession)
    sample = (
        labels.select("doc_id", grade.cast("int").alias("grade")).dropna()
        .orderBy(F.xxhash64("doc_id"), "doc_id", "grade").limit(max_rows)
    )
    # At most max_rows rows of 12 bytes: small at any size of the tables.
    rows = docs.select("doc_id", text_column().alias("text")).join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = Features()
        for batch in batches:
            for part in text_slices(batch):
                got = [x.astype("<i4").tobytes() for x in places(part.column("text"))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("grade"), pa.array(got, pa.binary())],
                                                 names=["doc_id", "grade", "places"])

    # Copies of an id are cut too, so that the bound holds for any documents.
    found = rows.select("doc_id", "grade", "text").mapInArrow(tidy(run), "doc_id long, grade int, places binary").limit(max_rows).collect()
    found.sort(key=lambda r: (r["doc_id"], r["grade"], bytes(r["places"])))
    return [np.frombuffer(r["places"], "<i4") for r in found], np.array([r["grade"] for r in found], np.int64)


class Design:
    """Sparse 0/1 rows over the places whose presence depends on the class: in
    ``min_rows`` rows at least, with a chi-squared statistic of ``DEPENDENT``."""

    def __init__(self, rows: list[np.ndarray], classes: np.ndarray, n_classes: int, min_rows: int):
        self.n = len(rows)
        flat = np.concatenate(rows) if rows else np.zeros(0, np.int64)
        row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        times = np.bincount(flat * n_classes + classes[row], minlength=WIDTH * n_classes).reshape(-1, n_classes)
        each = times.sum(axis=1)
        size = np.bincount(classes, minlength=n_classes)
        statistic = np.zeros(WIDTH)
        for k in np.flatnonzero(size):
            expected = each * (size[k] / self.n)
            absent = size[k] - expected
            gap = (times[:, k] - expected) ** 2
            statistic += np.where(expected > 0, gap / np.maximum(expected, 1e-9), 0) + np.where(absent > 0, gap / np.maximum(absent, 1e-9), 0)
        self.places = np.flatnonzero((each >= min_rows) & (statistic >= DEPENDENT))
        where = np.full(WIDTH, -1, np.int64)
        where[self.places] = np.arange(len(self.places))
        column = where[flat]
        self.row, self.column = row[column >= 0], column[column >= 0]

    def times(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights[self.column], self.n)

    def back(self, errors: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, errors[self.row], len(self.places))

    def spread(self, weights: np.ndarray) -> np.ndarray:
        """Weights by place, for ``text_features``."""
        out = np.zeros(WIDTH, np.float32)
        out[self.places] = weights
        return out


class Adam:
    def __init__(self):
        self.step, self.state = 0, {}

    def __call__(self, name: str, value: np.ndarray, gradient: np.ndarray, rate) -> np.ndarray:
        m, v = self.state.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        self.state[name] = m, v
        t = self.step + 1
        return value - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
