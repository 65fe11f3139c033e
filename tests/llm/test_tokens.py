"""Token counts, packing and id files against the tokenizers library."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import awkward, documents
from tillroll.llm import id_files, packing, token_counts
from tillroll.llm.pieces import encoder, load

BYTE, WORD = "byte_bpe_50k.json", "word_bpe_49k.json"


def library(name, texts):
    return [e.ids for e in load(name).encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("name", [BYTE, WORD])
def test_pieces_give_the_library_s_ids(name):
    rnd = random.Random(3)
    some = [*" \n\t\r\x00\x1c\x85\xa0  ​　﻿᠎'sStT.,!_", *"éßñİǅΣςŉ×÷ʰ˂漢字かな٣½́̈😀",
            *[" "] * 20, *"abcdefghij", "<|endoftext|>", "<|startoftext|>", "  ", "'s", " 'll", "don't", "123 456"]
    texts = ["".join(rnd.choice(some) for _ in range(rnd.randrange(16))) for _ in range(8000)]
    texts += [t or "" for _, t in awkward()]
    want = library(name, texts)
    offsets, ids = encoder(name).encode(pa.array(texts))
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want
    assert encoder(name).count(pa.array(texts)).tolist() == [len(x) for x in want]
    assert encoder(name).count(pa.array([], pa.string())).tolist() == []


def test_counts(spark):
    rows = awkward()
    got = token_counts.count_tokens(documents(spark, rows), BYTE, limit=512).collect()
    want = Counter((i, len((t or "").encode()), n, n > 512)
                   for (i, t), n in zip(rows, map(len, library(BYTE, [t or "" for _, t in rows]))))
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == want


def test_counts_of_huge_texts_widen_overlaps(spark):
    rnd = random.Random(5)
    apart = " ".join("x" * rnd.randrange(1, 2000) for _ in range(200))       # few places to splice
    solid = "".join(rnd.choice("abc.é") for _ in range(100_000))             # none
    odd = ("a" + " " * 300 + "b\n\n" + "　" * 300) * 150
    rows = [(1, apart), (2, solid), (3, odd), (3, odd), (None, "word " * 20_000)]
    got = Counter((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(documents(spark, rows), BYTE, overlap=16).collect())
    assert got == Counter((i, len(x)) for (i, _), x in zip(rows, library(BYTE, [t for _, t in rows])))


def test_counts_of_nothing(spark):
    assert token_counts.count_tokens(documents(spark, []), BYTE).collect() == []


def check_packing(got, rows, name, end, capacity):
    docs = defaultdict(list)
    for (i, t), ids in zip(rows, library(name, [t or "" for _, t in rows])):
        docs[i].append(np.array([*ids, end], "<u4"))
    want = Counter((i, s, len(x[s: s + capacity]), zlib.crc32(x[s: s + capacity].tobytes()), len(x))
                   for i, all_of in docs.items() for x in all_of for s in range(0, len(x), capacity))
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(r.length for r in got) / (capacity * len(by)) if by else 1.0


@pytest.mark.parametrize("capacity", [64, 2048])
def test_packing(spark, capacity):
    rows = awkward()
    got = packing.pack_documents(documents(spark, rows), BYTE, 1, capacity).collect()
    assert check_packing(got, rows, BYTE, 1, capacity) > 0.9


def test_packing_of_one_length_and_of_nothing(spark):
    rows = [(k, "same text") for k in range(500)]
    got = packing.pack_documents(documents(spark, rows), BYTE, 1, 16).collect()
    assert check_packing(got, rows, BYTE, 1, 16) > 0.9
    assert packing.pack_documents(documents(spark, []), BYTE).collect() == []


def test_patterns_hold_every_item_once():
    rnd = random.Random(1)
    for capacity in (8, 100, 2048):
        hist = {n: rnd.randrange(1, 10**rnd.randrange(1, 9)) for n in rnd.sample(range(1, capacity + 1), capacity // 2)}
        patterns = packing.shortest_pack_first(hist, capacity)
        held = Counter()
        for count, lengths in patterns:
            assert count > 0 and sum(lengths) <= capacity
            for n in lengths:
                held[n] += count
        assert held == hist
        assert len(patterns) <= 3 * len(hist)


def test_packing_rejects_lengths_beyond_capacity(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(9,)], "length long"), 8)


def test_packing_keeps_ids(spark):
    row = packing.pack_documents(documents(spark, [(1, "some words")]), BYTE, 1, 64, with_ids=True).first()
    assert np.frombuffer(row.ids, "<u4").tolist() == [*library(BYTE, ["some words"])[0], 1]


@pytest.mark.parametrize("shard_ids", [1000, 1 << 22])
def test_id_files(spark, shard_ids):
    rows = awkward()
    path, manifest = id_files.write_ids(documents(spark, rows), WORD, 2, shard_ids=shard_ids)
    got = sorted(id_files.read_ids(path, manifest).collect(), key=lambda r: r.start)
    ids = {t: np.array([*x, 2], "<u4") for (_, t), x in zip(rows, library(WORD, [t or "" for _, t in rows]))}
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (i, len(ids[t]), zlib.crc32(ids[t].tobytes())) for i, t in rows)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in got]
    assert order == sorted(order, key=lambda i: (i is not None, i))


def test_id_files_of_nothing(spark):
    assert id_files.read_ids(*id_files.write_ids(documents(spark, []), WORD, 2)).collect() == []
    assert id_files.lookup(*id_files.write_ids(documents(spark, []), WORD, 2), [1, 2]).collect() == []


@pytest.mark.parametrize("shard_ids, at_once", [(300, 5), (1 << 22, 1 << 20)])
def test_lookup_gives_the_documents_of_keys(spark, monkeypatch, shard_ids, at_once):
    monkeypatch.setattr(id_files, "MAX_KEYS", at_once)
    rows = awkward() + [(77, f"one of many {k % 5}") for k in range(300)]   # one id in several shards
    path, manifest = id_files.write_ids(documents(spark, rows), WORD, 2, shard_ids=shard_ids)
    ids = {t: (*x, 2) for (_, t), x in zip(rows, library(WORD, [t or "" for _, t in rows]))}
    keys = sorted({i for i, _ in rows if i is not None})
    got = id_files.lookup(path, manifest, [*keys[::2], 77, 77, -10**15, 10**15, 10**12 + 7]).collect()
    assert Counter((r.doc_id, r.n_tokens, tuple(r.ids)) for r in got) == Counter(
        (i, len(ids[t]), ids[t]) for i, t in rows if i in {*keys[::2], 77})
    places = {(r.start, r.doc_id) for r in id_files.read_ids(path, manifest).collect()}
    assert {(r.start, r.doc_id) for r in got} <= places
    assert id_files.lookup(path, manifest, []).collect() == []


class Counted:
    """A file in memory that counts the bytes read of it."""
    def __init__(self, content):
        self.content, self.bytes = content, 0

    def size(self):
        return len(self.content)

    def read_at(self, n, at):
        self.bytes += n
        return self.content[at: at + n]


def test_lookup_reads_ranges_of_a_shard():
    rnd = np.random.default_rng(4)
    keys = np.unique(rnd.integers(-2**62, 2**62, 3000))
    lens = rnd.integers(1, 900, len(keys))
    starts = np.append(0, np.cumsum(lens))
    ids = rnd.integers(0, 49_000, starts[-1]).astype("<u2")
    file = Counted(id_files.write_shard(keys, np.ones(len(keys), bool), starts, ids))
    some = np.append(keys[[0, 5, 1700, len(keys) - 1]], [12, -7])
    got = {k: (a, x.tolist()) for k, a, x in id_files.find(file, some)}
    assert got == {int(keys[r]): (int(starts[r]), ids[starts[r]: starts[r + 1]].tolist()) for r in (0, 5, 1700, len(keys) - 1)}
    assert file.bytes < len(file.content) / 20


def test_index_is_minimal_perfect_and_turns_away_absent_keys():
    rnd = np.random.default_rng(2)
    for n in (0, 1, 2, 63, 5000):
        keys = np.unique(rnd.integers(-2**62, 2**62, n))
        starts = np.arange(len(keys) + 1) * 3
        shard = id_files.Shard(id_files.write_shard(keys, np.ones(len(keys), bool), starts, np.arange(3 * len(keys), dtype="<u4")))
        assert sorted(shard.index.slots(keys.view(np.uint64)).tolist()) == list(range(len(keys)))
        assert (shard.records(keys) == np.arange(len(keys))).all()
        assert all(shard.get(k).tolist() == [3 * k, 3 * k + 1, 3 * k + 2] for k in range(min(5, len(keys))))
        absent = np.setdiff1d(rnd.integers(-2**62, 2**62, 2000), keys)
        assert (shard.records(absent) == -1).all()
