"""Spelling variants, resampling and repeated passages against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.cases import awkward, documents
from tillroll.llm import byteruns, repeats, resampling, spelling
from tillroll.llm.common import table
from tillroll.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_checksums_of_joined_runs():
    rnd = random.Random(1)
    parts = [rnd.randbytes(rnd.choice([0, 1, 3, 40, 256, 257, 300, 5000])) for _ in range(200)]
    n = np.array([len(p) for p in parts])
    ends = np.cumsum(n)
    c = byteruns.checksums(np.frombuffer(b"".join(parts), np.uint8), ends - n, ends)
    assert c.tolist() == [zlib.crc32(p) for p in parts]
    assert byteruns.joined(c[:-1], c[1:], n[1:]).tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:])]


# --- spelling ---------------------------------------------------------------

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}
    near = defaultdict(list)
    by_gap = defaultdict(set)   # words that share a word with one letter out, or are one
    for w in n:
        for k in range(len(w) + 1):
            by_gap[w[:k] + w[k + 1:]].add(w)
    for group in by_gap.values():
        for a in group:
            near[a] += [b for b in group if one_edit(a, b)]
    form = {}
    for w in n:
        near[w] = sorted(set(near[w]), key=lambda b: (-n[b], b))
        form[w] = near[w][0] if near[w] and n[near[w][0]] >= 5 * n[w] else None
    out = Counter()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None] += 1
    return out


def variants(got):
    return Counter((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect())


def lettered(seed=3):
    """Texts of words and their misspellings, of one to four edits, in several scripts."""
    rnd = random.Random(seed)
    letters = "abcdeéèßÿ×"
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(5, 11))) for _ in range(60)]
    pool = []
    for k, w in enumerate(base):
        pool += [w] * (3 + 7 * k)
        for _ in range(6):
            v = w
            for _ in range(rnd.randrange(1, 4)):
                at = rnd.randrange(len(v) + 1)
                v = rnd.choice([v[:at] + rnd.choice(letters) + v[at:], v[:at] + v[at + 1:], v[:at] + rnd.choice(letters) + v[at + 1:]])
                pool += [v] * rnd.choice([1, 5, 9, 40])
    pool += ["Common" + "x" * 7] * 4000
    rnd.shuffle(pool)
    rows, at = [], 0
    while at < len(pool):
        n = rnd.randrange(0, 200)
        rows.append((len(rows), rnd.choice([" ", ", ", "7", "Ā", "漢"]).join(w.upper() if rnd.random() < 0.1 else w for w in pool[at: at + n])))
        at += n
    return rows


def test_variants(spark, monkeypatch):
    rows = lettered() + [(None, None), (None, "anagram margana anagram " * 9), (5, ""), (5, "Großes großes " * 9)]
    want = plain_variants(rows)
    assert sum(1 for w in want if w[1]) > 20 and any(w[2] != (w[1] or w[0]) for w in want)   # forms, and chains of them
    for chunk in (spelling.CHUNK, 2):   # many chunks, every two of which meet
        monkeypatch.setattr(spelling, "CHUNK", chunk)
        assert variants(spelling.group_variants(documents(spark, rows))) == want


def test_variants_of_awkward_rows(spark):
    rows = awkward() + [(600, "supercalifragilistic " * 6 + "x" * 5000 + " " + "x" * 5000)] * 3
    assert variants(spelling.group_variants(documents(spark, rows))) == plain_variants(rows)
    assert spelling.group_variants(documents(spark, [])).collect() == []
    assert spelling.group_variants(documents(spark, [(1, None), (2, "one two")])).collect() == []


def test_variants_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert variants(QUERIES["op11_spelling"](spark, SF)) == plain_variants(rows)


def test_near_pairs_of_blocks():
    rnd = random.Random(5)
    for n, m in ((6, 6), (6, 7), (7, 6)):
        a, b = (sorted({"".join(rnd.choice("abc") for _ in range(k)) for _ in range(150)}) for k in (n, m))
        got = spelling.near_pairs(spelling._codes(pa.array(a)), spelling._codes(pa.array(b)), False)
        assert set(zip(*(x.tolist() for x in got))) == {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if one_edit(x, y)}


def test_cells_that_meet_cover_every_edit():
    """Each two words at one edit lie in cells that meet, once."""
    rnd = random.Random(6)
    moves = set(spelling.offsets())

    def cell(w):
        return tuple(sum(ord(c) % spelling.CLASSES == k for c in w) for k in range(spelling.CLASSES))

    for _ in range(500):
        w = "".join(rnd.choice("abcdefghéèê") for _ in range(8))
        at = rnd.randrange(8)
        for v in (w[:at] + w[at + 1:], w[:at] + rnd.choice("abcdefghé") + w[at + 1:]):
            step = tuple(x - y for x, y in zip(cell(w), cell(v)))
            back = tuple(-x for x in step)
            assert (step in moves) + (back in moves) == (2 if not any(step) else 1)


# --- resampling -------------------------------------------------------------

def plain_features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
    return len(w), [zlib.crc32(" ".join(w[k: k + m]).encode()) % 10_000 for m in (1, 2, 3) for k in range(len(w) - m + 1)]


def plain_sample(rows, target, percent=5):
    docs = [(i, *plain_features(t)) for i, t in rows]
    s, t = Counter(), Counter()
    for _, _, f in docs:
        s.update(f)
    for text in target:
        t.update(plain_features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10_000) / ((s[b] + 1) * (all_t + 10_000)))) for b in s}
    scored = []
    for i, n, f in docs:
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in scored if x[1] >= 20), key=lambda x: (-x[4], x[0] is None, x[0] or 0))
    rank = {id(x): k + 1 for k, x in enumerate(able[: percent * len(able) // 100])}
    return Counter((x[0], x[2], x[3], x[4], rank.get(id(x))) for x in scored)


def sampled(got):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect())


def test_resampling(spark, monkeypatch):
    rnd = random.Random(8)
    rows = awkward() + [(700 + k, " ".join(f"w{rnd.randrange(60)}" for _ in range(rnd.randrange(15, 60)))) for k in range(400)]
    rows += [(699, " ".join(f"w{k % 60}" for k in range(25)))] * 350   # rows that tie in score and id
    target = [None, "", "w1 w2 w3 w4 W5", " ".join(f"w{k}" for k in range(30))]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    want = plain_sample(rows, target, 75)
    drawn = Counter(w[0] for w in want.elements() if w[4] is not None)
    assert sum(drawn.values()) > 250 and 0 < drawn[699] < 350   # the cutoff lies among the ties
    for kept in (resampling.SORTED, 100):   # by one sort, and by brackets
        monkeypatch.setattr(resampling, "SORTED", kept)
        assert sampled(resampling.resample(documents(spark, rows), bench, 75)) == want
    assert resampling.resample(documents(spark, []), bench, 5).collect() == []
    none = sampled(resampling.resample(documents(spark, rows[:9]), bench.limit(0), 5))
    assert none == plain_sample(rows[:9], [], 5)


def test_resampling_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert sampled(QUERIES["op12_resampling"](spark, SF)) == plain_sample(rows, [r.text for r in table(spark, SF, "benchmark").collect()])


def test_brackets_hold_every_rank(spark, monkeypatch, tmp_path):
    """Also where the sketch is far off, and for long ties."""
    accuracy = 3
    monkeypatch.setattr(resampling, "SORTED", 4)
    monkeypatch.setattr(resampling, "ACCURACY", accuracy)
    monkeypatch.setattr(resampling, "WIDTHS", (2, accuracy))
    rnd = random.Random(1)
    values = sorted([5] * 30 + [6] * 20 + [rnd.randrange(-1000, 1000) for _ in range(30)])
    spark.createDataFrame([(v,) for v in values], "x long").repartition(4).write.parquet(f"{tmp_path}/x")
    rows = spark.read.parquet(f"{tmp_path}/x")
    for k in (1, 40, 80):
        value = values[k - 1]
        assert resampling.kth_smallest(rows, "x", k) == (value, values.index(value))


# --- repeats ----------------------------------------------------------------

def plain_kept(rows, window):
    """``rows`` in the order that counts: by id, null first."""
    seen, out = set(), []
    for i, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            span = tuple(w[k: k + window])
            if span in seen:
                gone[k: k + window] = [True] * window
            seen.add(span)
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g), gone))
    return out


def passages(seed=9):
    rnd = random.Random(seed)
    shared = [" ".join(f"p{rnd.randrange(900)}" for _ in range(rnd.randrange(18, 60))) for _ in range(12)]
    rows = []
    for k in range(150):
        parts = [" ".join(rnd.choice(["the", f"w{rnd.randrange(5000)}"]) for _ in range(rnd.randrange(0, 80))) for _ in range(3)]
        parts.insert(rnd.randrange(4), rnd.choice(shared))
        rows.append((k * 7, rnd.choice([" ", "\n", " \t\x0b"]).join(parts)))
    rows += [(2000, "a " * 100), (2001, "a " * 19), (2002, "a " * 20), (2003, rows[5][1]), (2004, "  x y " * 40)]
    return rows


@pytest.mark.parametrize("groups, slices", [(1 << 30, 1 << 30), (300, 900)])
def test_repeats(spark, monkeypatch, groups, slices):
    rows = passages()
    monkeypatch.setattr(repeats, "GROUP_BYTES", groups)
    monkeypatch.setattr(repeats, "SLICE_BYTES", slices)
    want = plain_kept(sorted(rows), 20)
    got = {r.doc_id: r for r in repeats.remove_repeats(documents(spark, rows), 20).collect()}
    assert len(got) == len(rows) and sum(w[2] for w in want) > 1000
    for i, n, less, kept, gone in want:
        r = got[i]
        assert (r.n_words, r.n_removed, r.text) == (n, less, kept)
        marks = [False] * n
        for s in r.repeats:
            assert not any(marks[s.start: s.start + s.length]) and (s.start + s.length == n or not gone[s.start + s.length])
            marks[s.start: s.start + s.length] = [True] * s.length
        assert marks == gone


def test_repeats_of_awkward_rows(spark, monkeypatch):
    rows = awkward() + [(13, awkward()[0][1])] * 40 + [(-5, "a b " * 30)]
    monkeypatch.setattr(repeats, "SLICE_BYTES", 4000)
    got = repeats.remove_repeats(documents(spark, rows), 20).collect()
    key = lambda i: (i is not None, i or 0)
    # Rows of one id may come in any order; sums are the same for any.
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    many = {i for i, c in Counter(i for i, _ in rows).items() if c > 1}
    want = {i: (n, less, kept) for i, n, less, kept, _ in plain_kept(sorted(rows, key=lambda r: key(r[0])), 20) if i not in many}
    assert {r.doc_id: (r.n_words, r.n_removed, r.text) for r in got if r.doc_id not in many} == want
    copies = [r.n_removed for r in got if r.doc_id == 13]
    assert sum(r.n_words for r in got if r.doc_id == 13) == sum(len((t or "").split()) for i, t in rows if i == 13)
    assert copies.count(max(copies)) == 39   # one of them stays
    assert repeats.remove_repeats(documents(spark, [])).collect() == []
    only = repeats.remove_repeats(documents(spark, [(1, None), (2, "  a  b ")])).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.text) for r in only) == Counter([(1, 0, 0, ""), (2, 2, 0, "a b")])


def test_spans_of_words_are_equal_as_their_hashes():
    rnd = random.Random(11)
    text = " ".join(rnd.choice(["a", "b", "longerthaneightbytes1", "longerthaneightbytes2"]) for _ in range(3000))
    w = text.split()
    spans = repeats.Words(pa.array([text])).spans([1, 2, 4, 5, 8, 20])
    for n, h in spans.items():
        at = defaultdict(set)
        for k in range(len(w) - n + 1):
            at[tuple(w[k: k + n])].add(int(h[k]))
        assert all(len(x) == 1 for x in at.values()) and len(set().union(*at.values())) == len(at)


def test_long_prefixes_only_where_short_ones_are_hot(spark):
    docs = documents(spark, [(k, " ".join(random.Random(k).choice(["the", f"w{j}"]) for j in range(400))) for k in range(40)])
    hot = repeats.hot_prefixes(docs, 20, 4)
    assert [len(h) > 0 for h in hot[:3]] == [True, True, True]
    assert all(len(h) <= 32 and (np.diff(h.astype(object)) > 0).all() for h in hot)
    the = repeats.Words(pa.array(["the"])).spans([1])[1][0]
    assert the in hot[0]


def test_rows_that_move_between_passes_are_an_error():
    found = pa.table({"doc_id": pa.array([1, 2]), "text": pa.array(["a " * 30, "a " * 30])})
    answer = pa.table({"slice": [0], "grp": [0], "n": [99], "total": [0], "repeats": [b"\xff"]})
    with pytest.raises(RuntimeError):
        repeats._remove([np.zeros(0, np.uint64)] * 4, 1, 20)((pa.scalar(0),), found, answer)


def test_repeats_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    want = Counter((i, n, less, hashlib.sha256(kept.encode()).hexdigest()) for i, n, less, kept, _ in plain_kept(sorted(rows), 20))
    got = QUERIES["op13_repeats"](spark, SF).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got) == want
