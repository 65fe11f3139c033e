"""Prefix polynomial fingerprints of texts.

With code points c_0, c_1, ... and a base b, P[i] = sum of c_j b^j over j < i,
modulo two primes below 2^31. The difference of two values answers whether two
spans are equal, wherever they lie, and a binary search over their length gives
the longest common extension of two places.

Likeness of two texts is found from their prefix arrays alone. A walk starts at
the beginning of both and takes the longest common extension of its two places.
Where that ends, it goes on at the nearest pair of places (fewest characters
passed over in both texts together, then the earlier one in the first text) that
begin equal spans of ``WINDOW`` characters, less than ``REACH`` characters ahead
in each. Where there is none, it passes over ``REACH`` characters of both, or,
if neither text has more than that left, takes the longest common end and stops.
Likeness is the number of characters taken, over the length of the longer text:
one character put in, taken out or changed costs about one character, wherever
it is. Equal texts have 1, an empty and another text 0.

Prefix arrays are built for ``BAND`` characters at a time, so memory beside the
text itself does not grow with its length. The column ``fingerprint`` sums them
up: the length, the whole text's hash and P at every multiple of a stride (a
power of two that leaves ``GRID`` / 2 to ``GRID`` of them). It tells of the text
alone, so equal texts have equal ones.

The next document in ascending ``doc_id`` is the next row of a range-sorted
partition; only each partition's last row gets its successor by a join.

Null text counts as empty: length 0, fingerprint of the empty text. Null
``doc_id``s come first; repeated ones stand in order of their text's hash. A
single document is its own next one. An empty table gives no rows; extra
columns are not carried.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import materialize, prepare, text_column, text_slices

PRIMES = (2_147_483_647, 2_147_483_629)   # fixed values: primes below 2^31
BASES = (1_000_003, 805_306_457)
INVERSES = tuple(pow(b, -1, p) for b, p in zip(BASES, PRIMES))
GRID = 32
WINDOW = 16                    # characters of the equal spans that a walk goes on at
REACH = 1 << 18                # how far ahead it looks for them
BAND = 2 * REACH + WINDOW      # characters with prefix arrays at once

_POWERS: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 ... base^(n - 1) modulo the prime; n is at most ``BAND`` here."""
    have = _POWERS.get((base, prime), np.ones(1, np.int64))
    while len(have) < n:
        step = int(have[-1]) * base % prime   # base to the power of len(have)
        have = np.concatenate([have, have * step % prime])
    _POWERS[base, prime] = have
    return have[:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)


class Prefixes:
    """Prefix arrays of a text, or of a band of it."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        self.sums = [
            np.concatenate([[0], np.cumsum((points + 1) * powers(b, p, self.n) % p)]) % p for b, p in zip(BASES, PRIMES)
        ]

    def equal(self, i: int, other: Prefixes, j: int, length: int) -> bool:
        """Whether the spans of that length from i here and j there are equal."""
        if i > j:
            return other.equal(j, self, i, length)
        for k, prime in enumerate(PRIMES):
            here = int(self.sums[k][i + length] - self.sums[k][i]) % prime
            there = int(other.sums[k][j + length] - other.sums[k][j]) % prime
            if here * pow(BASES[k], j - i, prime) % prime != there:
                return False
        return True

    def common_extension(self, i: int, other: Prefixes, j: int) -> int:
        """Length of the longest equal spans from i here and j there."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(i, other, j, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def common_end(self, i: int, other: Prefixes, j: int) -> int:
        """Length of the longest equal spans that end both, from i and j at the earliest."""
        low, high = 0, min(self.n - i, other.n - j)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(self.n - middle, other, other.n - middle, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def windows(self, start: int) -> np.ndarray:
        """Hashes of all spans of ``WINDOW`` characters from ``start`` on, free of their place."""
        n = max(0, self.n - start - WINDOW + 1)
        out = np.zeros(n, np.int64)
        for sums, inverse, prime in zip(self.sums, INVERSES, PRIMES):
            span = (sums[start + WINDOW: start + WINDOW + n] - sums[start: start + n]) % prime
            out = out << 31 | span * powers(inverse, prime, n) % prime
        return out


def held_by(keys: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Places of the keys that the others may hold: all that they do, and a few more."""
    mask = (1 << (8 * len(others)).bit_length()) - 1
    seen = np.zeros(mask + 1, bool)
    seen[others & mask] = True
    return np.flatnonzero(seen[keys & mask])


class Meetings:
    """Pairs of places, from two given ones on, that begin equal windows."""

    def __init__(self, x: Prefixes, i: int, y: Prefixes, j: int):
        self.i, self.j = i, j
        here, there = x.windows(i), y.windows(j)
        places = held_by(there, here)
        own = held_by(here, there[places])   # most windows are in one text only
        order = places[np.argsort(there[places], kind="stable")]
        low, high = (np.searchsorted(there[order], here[own], side) for side in ("left", "right"))
        met = high > low
        self.places, self.low, self.high = own[met].tolist(), low[met].tolist(), high[met].tolist()
        self.order = order.tolist()

    def nearest(self, i: int, j: int) -> tuple[int, int] | None:
        """The pair from i and j on with the fewest characters before it."""
        i, j = i - self.i, j - self.j
        best, found = 2 * REACH, None
        for k in range(bisect_left(self.places, i), len(self.places)):
            gap = self.places[k] - i
            if gap >= min(best, REACH):
                break
            at = bisect_left(self.order, j, self.low[k], self.high[k])
            if at < self.high[k] and self.order[at] - j < REACH and gap + self.order[at] - j < best:
                best = gap + self.order[at] - j
                found = self.places[k] + self.i, self.order[at] + self.j
        return found


class Spliced:
    """The start of one text and the start of another, end to end, sliced like
    one text and without a copy of either."""

    def __init__(self, first: str, cut: int, second: str, more: int):
        self.first, self.cut, self.second = first, cut, second
        self.n = cut + min(more, len(second))

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, places: slice) -> str:
        start, stop, _ = places.indices(self.n)
        return self.first[start: min(stop, self.cut)] + self.second[max(0, start - self.cut): max(0, stop - self.cut)]


def edit(text: str, after: str) -> Spliced:
    """The last quarter replaced by as much of the next text's start."""
    q = len(text) // 4
    return Spliced(text, len(text) - q, after, q)


def stride_of(n: int) -> int:
    return 1 << max(0, (max(n, 1) - 1) // GRID).bit_length()


class Print:
    """The fingerprint of a text: prefix arrays of any band of it, and their summary."""

    def __init__(self, text: str | Spliced):
        self.text, self.n = text, len(text)
        self.first = Prefixes(code_points(text[:BAND]))
        stride = stride_of(self.n)
        self.whole, grid = [0, 0], []
        for at in range(0, self.n, BAND):
            band = self.band(at)
            lift = [pow(b, at, p) for b, p in zip(BASES, PRIMES)]
            grid.append((self.whole[0] + band.sums[0][stride - at % stride:: stride] * lift[0]) % PRIMES[0])
            self.whole = [(w + int(s[-1]) * f) % p for w, s, f, p in zip(self.whole, band.sums, lift, PRIMES)]
        self.grid = np.concatenate(grid) if grid else np.zeros(0, np.int64)

    def band(self, at: int) -> Prefixes:
        return self.first if at == 0 else Prefixes(code_points(self.text[at: at + BAND]))

    def written(self) -> str:
        """Length, whole hash and grid values in hex digits."""
        return f"{self.n:x}-{self.whole[0] << 31 | self.whole[1]:016x}-" + self.grid.astype(">u4").tobytes().hex()

    def sha256(self) -> str:
        sha = hashlib.sha256()
        for at in range(0, self.n, BAND):
            sha.update(self.text[at: at + BAND].encode("utf-8", "surrogatepass"))
        return sha.hexdigest()


def common_characters(a: Print, b: Print) -> int:
    """Characters that the walk takes."""
    i = j = taken = 0
    while i < a.n and j < b.n:
        di, dj, more = _walk(a.band(i), b.band(j), a.n - i, b.n - j)
        i, j, taken = i + di, j + dj, taken + more
    return taken


def _walk(x: Prefixes, y: Prefixes, x_left: int, y_left: int) -> tuple[int, int, int]:
    """The walk from the start of two bands, until one place is ``REACH``
    characters on: the places, and the characters taken."""
    i = j = taken = sure = 0
    meetings = None
    while i < min(x.n, REACH) and j < min(y.n, REACH):
        same = max(sure, x.common_extension(i, y, j))
        i, j, taken = i + same, j + same, taken + same
        if i >= min(x.n, REACH) or j >= min(y.n, REACH):
            break
        meetings = meetings or Meetings(x, i, y, j)
        meeting = meetings.nearest(i, j)
        if meeting is None:
            if x_left - i <= REACH and y_left - j <= REACH:
                return x_left, y_left, taken + x.common_end(i, y, j)
            return i + REACH, j + REACH, taken
        (i, j), sure = meeting, WINDOW
    return i, j, taken


def likeness(a: Print, b: Print) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    if a.n == b.n and a.whole == b.whole:
        return 1.0
    return common_characters(a, b) / max(a.n, b.n)


def compare(text: str, after: str, own: Print | None = None, following: Print | None = None) -> tuple:
    """n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    own, following = own or Print(text), following or Print(after)
    new = Print(edit(text, after))
    return own.n, new.sha256(), own.written(), new.written(), likeness(own, new), likeness(own, following)


RESULT = ("n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")
_FIELDS = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]


def _in_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all rows but the last, and the texts of the first and last."""
    part = TaskContext.get().partitionId()
    names = ["doc_id", *_FIELDS, "part", "edge", "text"]
    held: tuple | None = None   # the row before: doc_id, text, its fingerprint
    opening = True

    def rows(ids: list, got: list[tuple], edges: list[str | None], texts: list[str | None]) -> pa.RecordBatch:
        columns = list(zip(*got)) if got else [[]] * 6
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), *(pa.array(c, k) for c, k in zip(columns, _KINDS)),
             pa.array([part] * len(ids), pa.int64()), pa.array(edges, pa.string()), pa.array(texts, pa.string())], names=names)

    none = (None,) * 6
    for batch in batches:
        for some in text_slices(batch, limit=4 << 20):
            ids, got = [], []
            if opening and some.num_rows:
                opening = False
                yield rows([some.column("doc_id")[0].as_py()], [none], ["first"], [some.column("text")[0].as_py()])
            for doc, text in zip(some.column("doc_id").to_pylist(), some.column("text").to_pylist()):
                own = Print(text)
                if held:
                    ids.append(held[0])
                    got.append(compare(held[1], text, held[2], own))
                held = doc, text, own
            yield rows(ids, got, [None] * len(ids), [None] * len(ids))
    if held:
        yield rows([held[0]], [none], ["last"], [held[1]])


def _at_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [compare(a, b) for a, b in zip(batch.column("text").to_pylist(), batch.column("after").to_pylist())]
        columns = list(zip(*got)) if got else [[]] * 6
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, _KINDS))],
                                         names=["doc_id", *_FIELDS])


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next of every document."""
    prepare(docs.sparkSession)
    inner = (
        docs.select("doc_id", text_column().alias("text")).withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
        .mapInArrow(_in_partition, f"doc_id long, {RESULT}, part long, edge string, text string")
    )
    inner = materialize(inner, "prints")
    # The last row of a partition goes before the first one of the next that
    # has any; the numbers of partitions are put in order, not their texts.
    firsts, lasts = inner.filter(F.col("edge") == "first"), inner.filter(F.col("edge") == "last")
    order = Window.orderBy("part")
    following = firsts.select("part").select("part", F.lead("part").over(order).alias("to"), F.min("part").over(Window.partitionBy()).alias("least"))
    to = following.select("part", F.coalesce("to", "least").alias("to"))
    pairs = (
        lasts.select("doc_id", "text", "part").join(to, "part")
        .join(firsts.select(F.col("part").alias("to"), F.col("text").alias("after")), "to")
        .select("doc_id", "text", "after")
    )
    done = inner.filter(F.col("edge").isNull()).select("doc_id", *_FIELDS)
    return done.unionByName(pairs.mapInArrow(_at_edges, f"doc_id long, {RESULT}"))
