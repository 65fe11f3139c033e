"""Token-id shards with a minimal perfect hash index.

Documents are dealt out by ranges of ``doc_id`` and sorted; each task writes
its run of documents as shard files of bounded size, under names that a second
attempt overwrites with the same bytes. A shard has, little-endian:

    magic "TRIDSH01" | n documents, n keys, n ids, bytes an id, levels (int64)
    doc_id int64[n] | known uint8[n] | starts int64[n + 1]
    per level: size int64, bits uint64[size / 64], ranks uint32[size / 64]
    first record uint32[keys] | fingerprint uint32[keys]
    ids (uint16 where the vocabulary allows, else uint32)

The index is a minimal perfect hash: at each level the keys that are alone on
their place set its bit, the others go on to the next level; a key's slot is
the number of bits before its own. A slot has the key's first record and a
fingerprint that turns away absent keys, so a document is found in constant
time from the raw payload. Records of one key follow one another.

Over the shards, the manifest is the index: the first and last key of each. Shards
hold ranges of keys, so ``lookup`` opens only those that a key may lie in, and reads
of each the header, the hash index (some bytes a document) and the ranges of the
documents found. The stored ``doc_id`` of a record confirms a fingerprint.

Null text: only the end id. Null ``doc_id``s come first and are records without
a key, which ``lookup`` never gives; absent keys have no row there, and a key given
twice counts once. Repeated ``doc_id``s are records one after another, in order of their
text's hash. An empty table gives no shards and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillroll.llm.common import prepare, materialize, run_path, text_column, text_slices
from tillroll.llm.pieces import encoder

MAGIC = b"TRIDSH01"
SHARD_IDS = 4 << 20   # ids in a shard file; one longer document makes a shard of its own
GAMMA = 2             # places per key of a level
RUN = 64              # records whose keys are read at once in a lookup
MAX_KEYS = 1 << 20    # keys of a lookup that go to the tasks at once; more go in blocks
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key (the finaliser of splitmix64)."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def build_levels(keys: np.ndarray) -> list[np.ndarray]:
    """Bits (as uint64 words) of each level; the keys must be distinct."""
    levels = []
    while len(keys):
        size = -(-max(64, GAMMA * len(keys)) // 64) * 64
        place = (mix(keys, len(levels) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size) == 1
        levels.append(np.packbits(alone, bitorder="little").view("<u8"))
        keys = keys[~alone[place]]
    return levels


class Index:
    def __init__(self, levels: list[np.ndarray]):
        self.levels, self.ranks, base = levels, [], 0
        for words in levels:
            ones = np.cumsum(np.bitwise_count(words).astype(np.int64))
            self.ranks.append((base + np.append(0, ones[:-1])).astype(np.uint32))
            base += int(ones[-1])

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 if no level has it; absent keys may get any."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for n, (words, ranks) in enumerate(zip(self.levels, self.ranks), 1):
            if not len(left):
                break
            place = mix(keys[left], n) % np.uint64(len(words) * 64)
            word, bit = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            hit = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = (ranks[word] + np.bitwise_count(below))[hit]
            left = left[~hit]
        return out


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 0) >> np.uint64(32)).astype("<u4")


def write_shard(doc_ids: np.ndarray, known: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of a shard; documents sorted, unknown ids first."""
    keys, first = np.unique(doc_ids[known], return_index=True)
    first += len(known) - int(known.sum())
    index = Index(build_levels(keys.view(np.uint64)))
    slots = index.slots(keys.view(np.uint64))
    record, prints = np.zeros(len(keys), "<u4"), np.zeros(len(keys), "<u4")
    record[slots], prints[slots] = first, fingerprint(keys.view(np.uint64))
    parts = [MAGIC, np.array([len(doc_ids), len(keys), len(ids), ids.dtype.itemsize, len(index.levels)], "<i8"),
             doc_ids.astype("<i8"), known.astype(np.uint8), starts.astype("<i8")]
    for words, ranks in zip(index.levels, index.ranks):
        parts += [np.array([len(words)], "<i8"), words, ranks]
    return b"".join(x if isinstance(x, bytes) else x.tobytes() for x in [*parts, record, prints, ids])


class Shard:
    """A shard's bytes, read in place."""

    def __init__(self, content: bytes):
        if content[:8] != MAGIC:
            raise ValueError("not a shard")
        self.at, self.content = 8, content
        n, keys, ids, width, levels = self._take("<i8", 5).tolist()
        self.doc_ids, self.known, self.starts = self._take("<i8", n), self._take("u1", n).astype(bool), self._take("<i8", n + 1)
        words, ranks = [], []
        for _ in range(levels):
            size = int(self._take("<i8", 1)[0])
            words.append(self._take("<u8", size))
            ranks.append(self._take("<u4", size))
        self.index = Index.__new__(Index)
        self.index.levels, self.index.ranks = words, ranks
        self.record, self.prints = self._take("<u4", keys), self._take("<u4", keys)
        self.ids = self._take(f"<u{width}", ids)

    def _take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.content, kind, n, self.at)
        self.at += out.nbytes
        return out

    def records(self, keys: np.ndarray) -> np.ndarray:
        """The first record of each key, -1 for keys that are not there."""
        unsigned = keys.astype(np.int64).view(np.uint64)
        slots = self.index.slots(unsigned)
        found = slots >= 0
        found[found] = self.prints[slots[found]] == fingerprint(unsigned[found])
        out = np.full(len(keys), -1, np.int64)
        out[found] = self.record[slots[found]]
        return out

    def get(self, record: int) -> np.ndarray:
        return self.ids[self.starts[record]: self.starts[record + 1]]


def find(file: pa.NativeFile, keys: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
    """(key, first id's place in the shard, ids) of each record of the keys,
    by ranges of an open shard file."""
    def numbers(kind: str, n: int, at: int) -> np.ndarray:
        return np.frombuffer(file.read_at(n * np.dtype(kind).itemsize, at), kind)

    head = 8 + 5 * 8
    if file.read_at(8, 0) != MAGIC:
        raise ValueError("not a shard")
    n, slots, ids, width, levels = numbers("<i8", 5, 8).tolist()
    starts, payload = head + 9 * n, file.size() - ids * width
    # A shard without documents before its hash index, which it has in common with a whole one.
    at = starts + 8 * (n + 1)
    index = MAGIC + np.array([0, slots, 0, width, levels], "<i8").tobytes() + bytes(8) + file.read_at(payload - at, at)
    records = Shard(index).records(keys)
    for key, record in zip(keys[records >= 0].tolist(), records[records >= 0].tolist()):
        while record < n:   # records of one key follow one another
            same = numbers("<i8", min(RUN, n - record), head + 8 * record) == key
            some = int(np.argmin(same)) if not same.all() else len(same)
            places = numbers("<i8", some + 1, starts + 8 * record)
            for a, b in zip(places[:-1].tolist(), places[1:].tolist()):
                yield key, a, numbers(f"<u{width}", b - a, payload + a * width)
            record += some
            if some < len(same):
                break


def _write(path: str, tokenizer: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        enc = encoder(tokenizer)
        width = "<u2" if max(enc.tok.get_vocab_size() - 1, end_id) < 1 << 16 else "<u4"
        files, root = fs.FileSystem.from_uri(path)
        task, made = TaskContext.get(), []
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def flush() -> None:
            if not held:
                return
            doc = pa.concat_arrays([h[0] for h in held])
            lens = np.concatenate([h[1] for h in held])
            name = f"part-{task.partitionId():06d}-{len(made):06d}.ids"
            known = ~doc.is_null().to_numpy(zero_copy_only=False)
            body = write_shard(doc.fill_null(0).to_numpy(), known, np.append(0, np.cumsum(lens)), np.concatenate([h[2] for h in held]))
            own = f"{root}/.{name}.{task.taskAttemptId()}"
            with files.open_output_stream(own) as f:
                f.write(body)
            if files.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
                files.move(own, f"{root}/{name}")
            else:  # from an attempt that was lost later; it has the same bytes
                files.delete_file(own)
            keys = doc.drop_null().to_numpy()   # sorted
            made.append((task.partitionId(), len(made), name, len(lens), int(lens.sum()), *([int(keys[0]), int(keys[-1])] if len(keys) else [None, None])))
            held.clear()

        size = 0
        for batch in batches:
            for part in text_slices(batch, limit=4 << 20):
                offsets, ids = enc.encode(part.column("text"))
                lens = np.diff(offsets) + 1
                whole = np.empty(len(ids) + len(lens), width)
                whole[np.arange(len(ids)) + np.repeat(np.arange(len(lens)), lens - 1)] = ids
                whole[np.cumsum(lens) - 1] = end_id
                if size and size + len(whole) > shard_ids:
                    flush()
                    size = 0
                held.append((part.column("doc_id"), lens, whole))
                size += len(whole)
        flush()
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
        columns = zip(*made) if made else [[]] * 7
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                         names=["part", "number", "shard", "n_docs", "n_ids", "first_key", "last_key"])
    return run


def write_ids(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 2, path: str | None = None,
              shard_ids: int = SHARD_IDS) -> tuple[str, DataFrame]:
    """Write the shards of all documents in ascending ``doc_id``; the folder
    and its manifest: part, number, shard, n_docs, n_ids, first_key, last_key
    (null where no document has an id), first_id (the ids of all shards before
    it)."""
    spark = docs.sparkSession
    prepare(spark)
    path = path or run_path(spark, "ids")
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    made = (
        docs.select("doc_id", text_column().alias("text")).withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
        .mapInArrow(_write(path, tokenizer, end_id, shard_ids), "part long, number long, shard string, n_docs long, n_ids long, first_key long, last_key long")
    )
    made = materialize(made, "id-shards")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard
    return path, made.withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, content in zip(batch.column("shard").to_pylist(), batch.column("content")):
            shard = Shard(content.as_buffer())
            n = len(shard.doc_ids)
            # Each key through the index; records of its key follow it.
            record = np.arange(n)
            known = np.flatnonzero(shard.known)
            first = shard.records(shard.doc_ids[known])
            fresh = np.append(True, shard.doc_ids[known][1:] != shard.doc_ids[known][:-1])[: len(known)]
            run = np.arange(len(known)) - np.maximum.accumulate(np.where(fresh, np.arange(len(known)), 0))
            record[known] = first + run
            crc = [zlib.crc32(shard.get(r).astype("<u4").tobytes()) for r in record.tolist()]
            yield pa.RecordBatch.from_arrays([
                pa.array(shard.doc_ids, pa.int64(), mask=~shard.known),
                pa.array([name] * n), pa.array(shard.starts[record]),
                pa.array(shard.starts[record + 1] - shard.starts[record]), pa.array(crc, pa.int64()),
            ], names=["doc_id", "shard", "start", "n_tokens", "ids_crc32"])


def read_ids(path: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shards."""
    spark = manifest.sparkSession
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.ids").schema(
        "path string, modificationTime timestamp, length long, content binary").load(path)
    rows = files.select(F.element_at(F.split("path", "/"), -1).alias("shard"), "content").mapInArrow(
        _read, "doc_id long, shard string, start long, n_tokens long, ids_crc32 long")
    return rows.join(manifest.select("shard", "first_id"), "shard").select(
        "doc_id", (F.col("first_id") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")


def lookup(path: str, manifest: DataFrame, keys: Iterable[int]) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document with one of the keys."""
    prepare(manifest.sparkSession)
    wanted = np.unique(np.fromiter(keys, np.int64))
    blocks = [wanted[k: k + MAX_KEYS] for k in range(0, max(1, len(wanted)), MAX_KEYS)]
    return reduce(DataFrame.unionAll, (_lookup(path, manifest, b) for b in blocks))


def _lookup(path: str, manifest: DataFrame, wanted: np.ndarray) -> DataFrame:
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = np.searchsorted(wanted, batch.column("first_key").to_numpy())
            high = np.searchsorted(wanted, batch.column("last_key").to_numpy(), "right")
            some = pa.array(high > low)
            yield pa.RecordBatch.from_arrays([*batch.select(["shard", "first_id"]).columns, pa.array(low), pa.array(high)],
                                             names=["shard", "first_id", "low", "high"]).filter(some)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(path)
        for batch in batches:
            for row in batch.to_pylist():
                with files.open_input_file(f"{root}/{row['shard']}") as file:
                    for key, at, ids in find(file, wanted[row["low"]: row["high"]]):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([key]), pa.array([row["first_id"] + at]), pa.array([len(ids)]),
                             pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), pa.array(ids.astype(np.int32)))],
                            names=["doc_id", "start", "n_tokens", "ids"])

    known = manifest.filter(F.col("first_key").isNotNull()).select("shard", "first_id", "first_key", "last_key")
    opened = known.mapInArrow(shards, "shard string, first_id long, low long, high long")
    return opened.repartition("shard").mapInArrow(fetch, "doc_id long, start long, n_tokens long, ids array<int>")
