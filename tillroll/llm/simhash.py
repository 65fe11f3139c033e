"""SimHash near-duplicate groups by pigeonhole blocks.

Equal fingerprints are one class. A fingerprint is split into ``max_bits + 2``
blocks; two that differ in ``max_bits`` places or fewer agree on two blocks at
least, so they meet under one of the pairs of blocks. Rows (pair and its bits,
fingerprint) are grouped by that key. A group of over ``GROUP`` fingerprints is
dealt into chunks and every two chunks meet in a task of their own, so no task
holds more than two chunks. Within a task every two fingerprints are compared,
and only links that join something new are given out: a spanning forest, not
all pairs. The forests of all groups connect exactly what the links connect.

Null text counts as empty: no words, fingerprint zero, linked like any other.
Null ``doc_id``s have fingerprints and components, but name none: a component
of only such rows has a null id. Repeated rows are rows of one class. An empty
table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import fresh, materialize, prepare, text_column, text_slices, tidy
from tillroll.llm.components import connected_components

SEED = 42
GROUP = 8192   # fingerprints of a chunk
LAGGED = 64    # groups up to this size are compared side by side
PART = 2 << 20


def simhash(texts: list[str], shingle: int) -> np.ndarray:
    """Fingerprints: a bit is set if over half the shingles' hashes set it."""
    from xxhash import xxh64_intdigest

    hashes: list[int] = []
    counts = np.zeros(len(texts), np.int64)
    for k, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        n = len(words) - shingle + 1
        if n <= 1:
            hashes.append(xxh64_intdigest(joined, SEED))
            counts[k] = 1
            continue
        ends = np.cumsum([len(w) + 1 for w in words])
        starts = [0, *ends[: n - 1].tolist()]
        hashes += [xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist())]
        counts[k] = n
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in = np.add.reduceat(bits, np.cumsum(counts[some]) - counts[some], axis=0, dtype=np.int64)
        ones = set_in * 2 > counts[some][:, None]
        out[some] = np.packbits(ones, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(docs: DataFrame, shingle: int = 4, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``fp`` (the fingerprint as a signed long)."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, limit=PART):
                fp = simhash(part.column("text").to_pylist(), shingle).view(np.int64)
                kept = part.drop_columns(["text"])
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(fp)], names=[*kept.schema.names, "fp"])

    rows = docs.select(*keep, text_column().alias("text"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.drop("text").schema)
    return rows.mapInArrow(tidy(run), f"{schema}, fp long")


def blocks(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) of the blocks of 64 bits."""
    n = max_bits + 2
    widths = [64 // n + (k < 64 % n) for k in range(n)]
    return [(sum(widths[:k]), w) for k, w in enumerate(widths)]


def forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that span each component of one group."""
    left, links, todo = np.arange(len(fps)), [], []
    while len(left):
        if not todo:
            todo.append(int(left[0]))
            left = left[1:]
        at = todo.pop()
        near = np.bitwise_count(fps[left] ^ fps[at]) <= max_bits
        for k in left[near].tolist():
            links.append((at, k))
            todo.append(k)
        left = left[~near]
    return links


def group_links(group: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the runs of equal ``group``, that connect all there is to
    connect. ``label`` names a member that links given out lead to."""
    n = len(fps)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    size = np.diff(np.append(first, n))
    a, b = [], []
    for f, s in zip(first[size > LAGGED].tolist(), size[size > LAGGED].tolist()):
        links = np.array(forest(fps[f: f + s], max_bits), np.int64).reshape(-1, 2) + f
        a.append(links[:, 0])
        b.append(links[:, 1])
    after = np.repeat(first + size, size) - np.arange(n) - 1   # members of the group behind this one
    at = np.flatnonzero((after > 0) & (np.repeat(size, size) <= LAGGED))
    label, lag = np.arange(n), 1
    while len(at):
        to = at + lag
        new = (np.bitwise_count(fps[at] ^ fps[to]) <= max_bits) & (label[at] != label[to])
        if new.any():
            x, y = at[new], to[new]
            a.append(x)
            b.append(y)
            low = np.minimum(label[x], label[y])
            np.minimum.at(label, x, low)
            np.minimum.at(label, y, low)
            label = label[label]
        lag += 1
        at = at[after[at] >= lag]
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64),) * 2


def _links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def give(last: bool) -> Iterator[pa.RecordBatch]:
            keys = np.concatenate([h[0] for h in held])
            fps = np.concatenate([h[1] for h in held])
            change = np.append(True, (keys[1:] != keys[:-1]).any(axis=1))
            end = len(keys) if last else int(np.flatnonzero(change)[-1])
            if end:
                x, y = group_links(np.cumsum(change[:end]), fps[:end].view(np.uint64), max_bits)
                yield pa.RecordBatch.from_arrays([pa.array(fps[x]), pa.array(fps[y])], names=["u", "v"])
            held[:] = [(keys[end:], fps[end:])]

        rows = 0
        for batch in batches:
            if batch.num_rows:
                held.append((np.column_stack([batch.column(c).to_numpy() for c in ("key", "lo", "hi")]), batch.column("fp").to_numpy()))
                rows += batch.num_rows
                if rows >= 65_536:
                    yield from give(False)
                    rows = len(held[0][0])
        if held:
            yield from give(True)
    return run


def near_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """u, v: links between distinct fingerprints (column ``fp``, distinct)
    that connect all pairs within ``max_bits``."""
    def part(block: tuple[int, int]):
        shift, width = block
        return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))

    keys = [F.lit(k << 48).cast("long").bitwiseOR(F.shiftleft(part(x), y[1])).bitwiseOR(part(y))
            for k, (x, y) in enumerate(combinations(blocks(max_bits), 2))]
    keyed = fps.select(F.explode(F.array(*keys)).alias("key"), "fp")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    chunks = F.ceil(F.col("n") / GROUP)
    own = F.pmod(F.xxhash64("fp"), chunks)
    met = (
        keyed.join(sizes, "key").withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
        .select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    )
    return met.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi").mapInArrow(_links(max_bits), "u long, v long")


def groups(prints: DataFrame, max_bits: int = 4) -> DataFrame:
    """``fp`` and ``component`` (a fingerprint that names it) of every distinct
    fingerprint of a written table with ``fp``."""
    distinct = prints.select("fp").distinct()
    roots = connected_components(near_links(distinct, max_bits))
    return distinct.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("component"))


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    prints = materialize(fingerprints(docs, shingle), "fingerprints")
    named = groups(prints, max_bits)
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(named, "fp")
    classes = materialize(classes, "classes")
    ids = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    final = classes.join(ids, "component").select("fp", "component_id")
    return prints.join(final, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One document of each component: the smallest ``doc_id`` (null ones
    last), of repeated ids the one with the smallest hash of its text, and of
    repeated rows one. All columns are kept."""
    key = F.xxhash64(text_column())
    prints = materialize(fingerprints(docs.select("doc_id", "text", key.alias("th")), shingle, ("doc_id", "th")), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")).alias("first")
    classes = prints.groupBy("fp").agg(first).join(groups(prints, max_bits), "fp")
    kept = classes.groupBy("component").agg(F.min("first").alias("first")).select(
        F.col("first.doc_id").alias("_kept_id"), F.col("first.th").alias("_kept_th"))
    same = docs["doc_id"].eqNullSafe(kept["_kept_id"]) & (key == kept["_kept_th"])
    out = docs.join(kept, same, "left_semi")
    repeated = prints.groupBy("doc_id", "th").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    if repeated.isEmpty():
        return out
    name = fresh(docs, "th")
    return out.withColumn(name, key).dropDuplicates(["doc_id", name]).drop(name)
