"""Shortest-pack-first packing over the length histogram.

Only the histogram (one row per length, at most ``capacity`` of them) reaches
the driver. Lengths are placed longest first, each on the packs that are
shortest so far, where a pack is a pattern of lengths with a count. A pattern
gives each of its slots a run of ranks, and an item finds its pack by its rank
among the items of its length. Ranks come from counts per (length, bucket), so
a length that holds a third of all items is numbered by many tasks.

A length splits at most one pattern and opens at most two, so there are at most
three patterns per length, whatever the number of documents.

A null text packs as an empty one: just the end id. Null and repeated
``doc_id``s are items like others. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.common import prepare, materialize, text_column, text_slices, tidy
from tillroll.llm.pieces import encoder

CAPACITY = 2048


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Packing patterns (count, lengths) that hold every item once."""
    by_space: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            space = max(by_space, default=0)
            if space < length:  # new packs, which take the next ones of this length until they are full
                fit = capacity // length
                for count, times in ((left // fit, fit), (1, left % fit)):
                    if count and times:
                        by_space.setdefault(capacity - times * length, []).append((count, (length,) * times))
                break
            count, lengths = by_space[space].pop()
            n = min(left, count)
            if n < count:
                by_space[space].append((count - n, lengths))
            if not by_space[space]:
                del by_space[space]
            by_space.setdefault(space - length, []).append((n, (*lengths, length)))
            left -= n
    return [p for space in sorted(by_space) for p in by_space[space]]


def rank_runs(patterns: list[tuple[int, tuple[int, ...]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted: an item of
    that length and a rank from there on lies in the sequence as far on."""
    used: dict[int, int] = {}
    runs, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            runs.append((length, used.get(length, 0), sequence, offset))
            used[length] = used.get(length, 0) + count
            offset += length
        sequence += count
    return np.array(sorted(runs), np.int64).reshape(-1, 4)


def with_ranks(items: DataFrame, order: list[str]) -> DataFrame:
    """``rank`` from 0 among the items of the same ``length``."""
    buckets = int(items.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    items = items.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    counts = items.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("length").orderBy("bucket")
    bases = counts.select("length", "bucket", (F.sum("n").over(before) - F.col("n")).alias("base"))
    own = Window.partitionBy("length", "bucket").orderBy(*order)
    numbered = items.withColumn("own", F.row_number().over(own) - 1)
    return (numbered.join(bases, ["length", "bucket"])
            .withColumn("rank", F.col("base") + F.col("own")).drop("bucket", "base", "own"))


def pack(items: DataFrame, capacity: int = CAPACITY, order: list[str] | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to items with a ``length`` between 1
    and ``capacity``. ``items`` must be a written table: it is read twice.
    ``order`` (default: all columns) numbers items of the same length."""
    spark = items.sparkSession
    histogram = {r["length"]: r["n"] for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if histogram and not (0 < min(histogram) and max(histogram) <= capacity):
        raise ValueError(f"lengths must be from 1 to {capacity}")
    runs = spark.sparkContext.broadcast(rank_runs(shortest_pack_first(histogram, capacity)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, sequence, offset = runs.value.T
        keys = (length << 40) + first
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, (batch.column("length").to_numpy() << 40) + rank, "right") - 1
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])],
                names=[*kept.schema.names, "sequence_id", "offset"])

    out = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    ranked = with_ranks(items, order or items.columns).select(*items.columns, "rank")
    return ranked.mapInArrow(tidy(place), out)


def _encode(tokenizer: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for part in text_slices(batch):
                offsets, ids = enc.encode(part.column("text"))
                docs = len(offsets) - 1
                lens = np.diff(offsets) + 1
                whole = np.empty(len(ids) + docs, "<u4")
                whole[np.arange(len(ids)) + np.repeat(np.arange(docs), lens - 1)] = ids
                ends = np.cumsum(lens)
                whole[ends - 1] = end_id
                n = -(-lens // capacity)                      # pieces of each document
                doc = np.repeat(np.arange(docs), n)
                start = (np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)) * capacity
                length = np.minimum(lens[doc] - start, capacity)
                at = (ends - lens)[doc] + start               # pieces follow one another
                bounds = np.append(at, len(whole)) * 4
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(doc)),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.BinaryArray.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(whole)]),
                    pa.array(lens[doc], pa.int64()),
                ], names=["doc_id", "start", "length", "ids", "doc_tokens"])
    return run


def token_pieces(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 1,
                 capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids (little-endian unsigned 32-bit), doc_tokens:
    each document's ids and ``end_id``, cut every ``capacity`` ids."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", text_column().alias("text")).mapInArrow(
        tidy(_encode(tokenizer, end_id, capacity)), "doc_id long, start long, length long, ids binary, doc_tokens long")


def pack_documents(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", end_id: int = 1,
                   capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece with its place: doc_id, start, length, ids_crc32,
    doc_tokens, sequence_id, offset, and the ids if asked for."""
    pieces = token_pieces(docs, tokenizer, end_id, capacity)
    pieces = pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                           *(["ids"] if with_ids else []))
    return pack(materialize(pieces, "pieces"), capacity, ["doc_id", "start", "ids_crc32"])
