"""SimHash groups, span fingerprints and top-k search against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from pyspark.sql import functions as F

from tests.llm.cases import awkward, documents, words
from tillroll.llm import simhash, span_prints, topk_search
from tillroll.llm.components import connected_components


def plain_simhash(text, shingle=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[k: k + shingle]).encode(), 42) for k in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(n, near):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in near:
        parent[find(a)] = find(b)
    return [find(x) for x in range(n)]


def near_pairs(fps, bits):
    v = np.array(fps, np.uint64)
    return [(a, a + 1 + int(b)) for a in range(len(v)) for b in np.flatnonzero(np.bitwise_count(v[a + 1:] ^ v[a]) <= bits)]


def expected(rows, bits=4):
    fps = [plain_simhash(t) for _, t in rows]
    root = roots(len(rows), near_pairs(fps, bits))
    least = defaultdict(lambda: None)
    for (i, _), r in zip(rows, root):
        if i is not None and (least[r] is None or i < least[r]):
            least[r] = i
    return Counter((i, f"{f:016x}", least[r]) for (i, _), f, r in zip(rows, fps, root))


def test_near_duplicates(spark):
    rows = awkward()
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == expected(rows)
    assert simhash.near_duplicates(documents(spark, [])).collect() == []


def test_shingles_hash_as_spark_s_xxhash64(spark):
    fp = simhash.simhash(["a b c d"], 4).view(np.int64)[0]
    assert spark.sql("SELECT xxhash64('a b c d')").first()[0] == fp


def chained(n, seed):
    """Fingerprints in chains and dense balls, some apart."""
    rnd = random.Random(seed)
    out = set()
    while len(out) < n:
        x = rnd.getrandbits(64)
        for _ in range(rnd.randrange(1, 40)):
            out.add(x)
            for b in rnd.sample(range(64), rnd.randrange(1, 6)):
                x ^= 1 << b
    return sorted(out)[:n]


def test_links_connect_all_near_pairs(spark, monkeypatch):
    fps = chained(600, 4)
    ball = [0x0123456789ABCDEF ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(a)]   # one large group
    fps = sorted(set(fps + ball))
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    pairs = near_pairs(fps, 4)
    want = roots(len(fps), pairs)
    for chunk in (simhash.GROUP, 100):   # in chunks, every two of which meet
        monkeypatch.setattr(simhash, "GROUP", chunk)
        links = simhash.near_links(table, 4).collect()
        at = {f: k for k, f in enumerate(fps)}
        found = [(at[r.u % (1 << 64)], at[r.v % (1 << 64)]) for r in links]
        assert set(found) <= {p for a, b in pairs for p in ((a, b), (b, a))}
        got = roots(len(fps), found)
        assert len({(a, b) for a, b in zip(want, got)}) == len(set(want)) == len(set(got))
    assert len(links) < len(pairs) / 2


def test_components(spark):
    rnd = random.Random(6)
    edges = [(k, k + 1) for k in range(0, 300)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000)]
    edges += [(rnd.randrange(2000, 2400), rnd.randrange(2000, 2400)) for _ in range(250)]
    edges = [(b, a) if rnd.random() < 0.5 else (a, b) for a, b in edges]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = sorted({x for e in edges for x in e})
    at = {x: k for k, x in enumerate(nodes)}
    root = roots(len(nodes), [(at[a], at[b]) for a, b in edges])
    least = {}
    for x, r in zip(nodes, root):
        least.setdefault(r, x)
    assert got == {x: least[r] for x, r in zip(nodes, root) if least[r] != x}
    assert connected_components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_one_document_of_each_group_stays(spark):
    rows = awkward()
    docs = documents(spark, rows)
    got = simhash.drop_near_duplicates(docs)
    assert got.columns == docs.columns
    kept = got.collect()
    groups = defaultdict(list)
    fps = [plain_simhash(t) for _, t in rows]
    for row, r in zip(rows, roots(len(rows), near_pairs(fps, 4))):
        groups[r].append(row)
    assert len(kept) == len(groups)
    for members in groups.values():
        mine = [(r.doc_id, r.text) for r in kept if (r.doc_id, r.text) in members]
        assert len(mine) == 1
        ids = [i for i, _ in members if i is not None]
        assert mine[0][0] == (min(ids) if ids else None)
    assert simhash.drop_near_duplicates(documents(spark, [])).collect() == []


def test_span_prints(spark):
    rows = awkward()
    order = {r.doc_id: (r.doc_id is not None, r.doc_id) for r in documents(spark, rows).select("doc_id").collect()}
    ties = {r.text: r.h for r in documents(spark, rows).select(
        "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).distinct().collect()}
    ranked = sorted(rows, key=lambda r: (*order[r[0]], ties[r[1]]) if r[0] is not None else (False, ties[r[1]]))
    got = span_prints.fingerprint_documents(documents(spark, rows)).collect()
    want = Counter()
    for (i, t), (_, after) in zip(ranked, ranked[1:] + ranked[:1]):
        t, after = t or "", after or ""
        q = len(t) // 4
        edited = t[: len(t) - q] + after[:q]
        near_edited, near_next = (by_hand(t, x) / max(len(t), len(x)) if t != x else 1.0 for x in (edited, after))
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest(), near_edited, near_next] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got) == want
    texts = {r.doc_id: r.fingerprint for r in got if r.doc_id is not None}
    assert texts[13] == texts[14] != texts[15]
    assert texts[10] == texts[11]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert all(r.near_edited > 0.6 for r in got if r.n_chars > 8)
    assert span_prints.fingerprint_documents(documents(spark, [])).collect() == []
    one = span_prints.fingerprint_documents(documents(spark, [(5, "abcdefgh")])).first()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()


def test_spans_and_common_extensions():
    rnd = random.Random(8)
    text = "".join(rnd.choice("ab") for _ in range(300))
    other = text[40:200] + "".join(rnd.choice("ab") for _ in range(100))
    a, b = (span_prints.Prefixes(span_prints.code_points(t)) for t in (text, other))
    for _ in range(300):
        i, j = rnd.randrange(len(text)), rnd.randrange(len(other))
        n = rnd.randrange(min(len(text) - i, len(other) - j))
        assert a.equal(i, b, j, n) == (text[i: i + n] == other[j: j + n])
        far = 0
        while i + far < len(text) and j + far < len(other) and text[i + far] == other[j + far]:
            far += 1
        assert a.common_extension(i, b, j) == far
    assert a.common_extension(40, b, 0) >= 160


def by_hand(a, b):
    """The walk's characters by comparing the texts themselves."""
    i = j = taken = 0
    w, reach = span_prints.WINDOW, span_prints.REACH
    where = defaultdict(list)
    for y in range(len(b) - w + 1):
        where[b[y: y + w]].append(y)
    while i < len(a) and j < len(b):
        while i < len(a) and j < len(b) and a[i] == b[j]:
            i, j, taken = i + 1, j + 1, taken + 1
        pairs = [(x - i + y - j, x, y) for x in range(i, min(i + reach, len(a) - w + 1))
                 for y in where.get(a[x: x + w], []) if j <= y < j + reach]
        if pairs:
            _, i, j = min(pairs)
        elif len(a) - i <= reach and len(b) - j <= reach:
            while len(a) > i and len(b) > j and a[-1] == b[-1]:
                a, b, taken = a[:-1], b[:-1], taken + 1
            break
        else:
            i, j = i + reach, j + reach
    return taken


def near(a, b):
    return span_prints.likeness(span_prints.Print(a), span_prints.Print(b))


@pytest.mark.parametrize("reach", [1 << 18, 40])
def test_likeness_is_that_of_a_walk_by_hand(monkeypatch, reach):
    monkeypatch.setattr(span_prints, "REACH", reach)
    monkeypatch.setattr(span_prints, "BAND", 2 * reach + span_prints.WINDOW)
    rnd = random.Random(5)
    base = words(rnd, 60)
    texts = [base, "x" + base, base[:90] + base[91:], base[150:] + base[:150], base[:100], words(rnd, 50), "a" * 90, "ab" * 60,
             "", "a", base[:200] + "\U0001f600é" + base[200:], base.replace("w1", "w2"), base[:120] + words(rnd, 20) + base[120:]]
    for a in texts:
        for b in texts:
            want = by_hand(a, b) / max(len(a), len(b)) if a != b else 1.0
            assert near(a, b) == want, (a, b)


def test_small_edits_leave_texts_alike():
    rnd = random.Random(6)
    text = words(rnd, 4500)
    n = len(text)
    changed = "".join("#" if k % 600 == 300 else c for k, c in enumerate(text))
    for other in ("#" + text, text[: n // 2] + text[n // 2 + 1:], changed, text[: n // 2] + words(rnd, 100) + text[n // 2:]):
        assert near(text, other) > 0.95 and near(other, text) > 0.95
    assert near(text, text[: n * 3 // 5]) == (n * 3 // 5) / n
    assert near(text, words(rnd, 4500, "z")) < 0.05


def test_bands_do_not_change_a_fingerprint(monkeypatch):
    text = words(random.Random(7), 500)
    whole = [span_prints.Print(t) for t in (text, span_prints.Spliced(text, 701, text[701:], 1 << 20), span_prints.edit(text, "é" * 999))]
    assert whole[0].written() == whole[1].written() != whole[2].written()
    assert whole[2].sha256() == hashlib.sha256((text[: len(text) - len(text) // 4] + "é" * (len(text) // 4)).encode()).hexdigest()
    monkeypatch.setattr(span_prints, "REACH", 20)
    monkeypatch.setattr(span_prints, "BAND", 40 + span_prints.WINDOW)
    for p in whole:
        again = span_prints.Print(p.text)
        assert again.written() == p.written() and again.sha256() == p.sha256()

def best_rows(rows, k=5):
    """(query, rank, id, score) of every query row, by Python's integers."""
    ok = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for a, (qi, q) in enumerate(ok):
        if qi % 50 == 0:
            pairs = sorted((-sum(x * y for x, y in zip(q, v)), i) for b, (i, v) in enumerate(ok) if a != b and len(v) == len(q))
            out.update((qi, at + 1, i, -s) for at, (s, i) in enumerate(pairs[:k]))
    return out


def found_rows(got):
    return Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())


def test_top_k(spark):
    rnd = random.Random(9)
    rows = [(k, [rnd.gauss(0, 1) for _ in range(8)]) for k in range(300)]
    rows += [(300 + k, rows[k][1]) for k in range(50)] + [(7, rows[8][1]), (50, [1.0] * 8), (50, [1.0] * 8)]
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, [1.0] * 8)]
    rows += [(450, [0.5] * 3), (451, [0.25] * 3), (500, []), (501, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit("other"))
    rows += [(600, rows[0][1])] * 150   # repeats of one query, a third of all rows
    rows += [(550, [9e6, 0.0, -1e200, 0.0]), (551, [1e7, 1.0, 0.0, 5.0]), (552, [-3.0, 2.0, 0.0, 1.0]), (553, [8.5e6, 0.5, 0.0, -1e3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("v", F.lit("other")).withColumn("row", F.lit("other"))
    want = best_rows(rows)
    for block in (topk_search.BLOCK, 3, 40):
        if block == 3:   # many passes: without the repeats
            few = [r for r in rows if r[0] != 600]
            assert found_rows(topk_search.top_k(df.filter("vec_id <> 600"), F.col("vec_id") % 50 == 0, 5, block=block)) == best_rows(few)
        else:
            assert found_rows(topk_search.top_k(df, F.col("vec_id") % 50 == 0, 5, block=block)) == want
    too_large = spark.createDataFrame([(0, [8e6] * 8), (1, [8e6] * 8), (2, [-8e6] * 8)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="does not fit a long"):
        topk_search.top_k(too_large, F.col("vec_id") % 50 == 0).collect()
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk_search.top_k(empty, F.col("vec_id") % 50 == 0).collect() == []
