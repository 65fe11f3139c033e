"""Quality, mixing, LM scores and licences; the pipeline's stages."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.cases import awkward, documents, labels, words
from tillroll.llm import features, license_scan, lm_score, mixing, quality
from tillroll.llm.common import table
from tillroll.llm.registry import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


def rated(n=240, seed=1):
    """Texts of three grades: repeated junk, texts with a bad word, clean ones."""
    rnd = random.Random(seed)
    rows, marks = [], []
    for k in range(n):
        grade = k % 3
        text = " ".join(f"w{rnd.randrange(100_000)}" for _ in range(80))
        if grade == 0:
            text = "JUNK!!! " * 60
        elif grade == 1:
            text += " badword badword"
        rows.append((k, text))
        marks.append((k, int(grade > 0), int(grade == 1)))
    return rows, marks


def test_grades_of_held_out_texts(spark):
    rows, marks = rated()
    docs = documents(spark, rows)
    model = quality.fit(docs, labels(spark, marks[:180]))
    assert (np.diff(model.thresholds) > 0).all()
    got = {r.doc_id: r for r in quality.grade_documents(docs, model).collect()}
    right = sum(round(got[k].expected_grade) == k % 3 for k in range(180, 240))
    assert right >= 54
    for r in got.values():
        assert r.p_ge_1 >= r.p_ge_2 and math.isclose(r.expected_grade, r.p_ge_1 + r.p_ge_2)
        assert r.accepted == (r.p_ge_1 >= quality.ACCEPT)


def test_held_out_accuracy_on_the_documents(spark):
    docs, marks = table(spark, SF2, "documents"), table(spark, SF2, "labels").toPandas().sort_values("doc_id")
    train = spark.createDataFrame(marks[::2])
    got = {r.doc_id: r for r in quality.grade_documents(docs, quality.fit(docs, train)).collect()}
    rest = marks[1::2]
    right = [got[i].accepted == bool(q) for i, q in zip(rest.doc_id, rest.quality)]
    assert sum(right) / len(right) > 0.9   # 200 texts to learn from
    clean = [got[i].accepted for i, q, t in zip(rest.doc_id, rest.quality, rest.toxic) if q and not t]
    assert sum(clean) / len(clean) > 0.95


def test_fit_ends_at_a_minimum_of_the_likelihood():
    rnd = np.random.default_rng(3)
    grades = rnd.integers(0, 3, 400)
    rows = [np.unique(np.append(rnd.integers(3, 30, 6), g if rnd.random() < 0.6 else rnd.integers(0, 3))) for g in grades]
    model = quality.fit_ordinal(rows, grades, min_rows=1)
    w, t = model.weights.astype(float), model.thresholds
    active = np.flatnonzero(w)
    assert set(active) >= {0, 2}

    def loss(w, t):
        s = np.array([w[r].sum() for r in rows])
        f = np.column_stack([np.ones(400), 1 / (1 + np.exp(-(s[:, None] - t))), np.zeros(400)])
        i = np.arange(400)
        return -np.log(f[i, grades] - f[i, grades + 1]).mean() + quality.RIDGE / 2 * (w**2).sum()

    for k in active:
        e = np.zeros(len(w))
        e[k] = 1e-4
        assert abs(loss(w + e, t) - loss(w - e, t)) / 2e-4 < 2e-3
    for k in range(2):
        e = 1e-4 * np.eye(2)[k]
        assert abs(loss(w, t + e) - loss(w, t - e)) / 2e-4 < 2e-3
    assert loss(w, t) < loss(0 * w, t) - 0.1


def test_quality_of_awkward_rows(spark):
    docs = documents(spark, awkward())
    none = quality.fit(docs, labels(spark, []))
    got = quality.grade_documents(docs, none).collect()
    assert len(got) == docs.count() and all(r.accepted for r in got)
    odd = labels(spark, [(None, 1, 0), (13, None, 1), (13, 1, None), (13, 1, None), (99_999, 0, 0), (16, 0, 1)])
    model = quality.fit(docs, odd, min_rows=1)
    assert quality.accepted(docs, model).columns == docs.columns
    assert quality.grade_documents(documents(spark, []), model).collect() == []


def test_fit_is_bounded(spark):
    rows, marks = rated()
    copies = documents(spark, rows + rows)
    places, grades = features.labelled_features(copies, labels(spark, marks), quality.rating(), 50)
    assert len(places) == len(grades) <= 50


def plain_features(text):
    """Places of a text's features and its number of words, by the definition, character by character."""
    found = [w for w in re.split("[ \t\n\r\x0b\x0c]+", text) if w]
    places = set()
    for w in found:
        for run in re.findall(r"\w+", w.lower()):
            parts = [run] + [run[:k] + "\t" for k in (4, 5) if len(run) > k]
            places |= {zlib.crc32(x.encode()) % features.HASHED for x in parts}
    chars, n, most = max(1, len(text)), max(1, len(found)), max(Counter(found).values(), default=0)
    signs = [sum(not c.isalnum() for c in w) for w in found]
    each = [sum(c.isupper() for c in text), sum(signs), sum(sum(c.isdigit() for c in w) for w in found)]
    shares = [len(set(found)) / n, *(x / chars for x in each), sum(x > 1 for x in signs) / n, most / n]
    own = {features.HASHED + k * features.STEPS + min(features.STEPS - 1, int(x * features.STEPS)) for k, x in enumerate(shares)}
    return sorted(places | own | {features.HASHED + features.SHARES * features.STEPS + len(found).bit_length()}), len(found)


def odd_texts():
    rnd = random.Random(11)
    letters = "abcdeXYZ019_.,-'!\x00\x1c\x1f\x7f×÷ÀÖØÞßàöøÿªº²µéİıœΣςǅ漢’\U0001f600" + " \t\n\r\x0b\x0c\x85\xa0"
    texts = ["", " ", "\t \n", "x" * 300 + ".", "É" * 300 + " éé", "Übergrößen, Übergröß. d'œuvre"]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randrange(90))) for _ in range(1500)]
    return texts + [f"ab{chr(c)}CDefg {chr(c)} {chr(c)}." for c in range(0x500)] + [""]


def test_features_are_those_of_the_definition():
    texts = odd_texts()
    places, n = zip(*map(plain_features, texts))
    active = np.random.default_rng(2).random(features.WIDTH) < 0.3
    for flags in (None, active):
        keep = [[x for x in p if flags is None or x >= features.HASHED or flags[x]] for p in places]
        made = features.Features(flags)
        for at in range(0, len(texts), 700):   # slices, of which later ones meet known words
            found, words_of = made.pairs(pa.array(texts[at: at + 700]))
            assert words_of.tolist() == list(n[at: at + 700])
            assert found.tolist() == [[k, x] for k, p in enumerate(keep[at: at + 700]) for x in p]
    assert features.Features().pairs(pa.array([], pa.string()))[0].tolist() == []


def test_plain_words_are_not_taken_one_by_one(monkeypatch):
    """Most words are rare, so that a call for each of them was the cost of scoring."""
    seen, word = [], features.Features._word
    monkeypatch.setattr(features.Features, "_word", lambda self, raw: seen.append(raw) or word(self, raw))
    text = " ".join(f"Word{k}, größe-{k}; (l'été_{k})×2" for k in range(500))
    made = features.Features()
    made.pairs(pa.array([text, "日本 und cœur", "", "cœur"]))
    assert sorted(seen) == ["cœur", "日本"] and sorted(made.memo) == sorted(seen)


def test_rates_meet_targets(spark):
    rows, marks = rated(300)
    docs = documents(spark, rows)
    model = mixing.fit(docs, labels(spark, marks))
    shares = {"bad": 0.1, "toxic": 0.3, "clean": 0.6}
    got = mixing.mix_documents(docs, model, shares).collect()
    assert len(got) == 300 and all(r.rate >= 0 for r in got)
    total = {d: sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in got) for d in shares}
    for d, share in shares.items():
        assert abs(total[d] / sum(total.values()) - share) < 0.002
    assert abs(total["clean"] - sum(r.n_tokens * r.p_clean for r in got)) < 0.002 * sum(total.values())
    for r in got:
        assert math.isclose(r.p_bad + r.p_toxic + r.p_clean, 1.0, rel_tol=1e-6)
        assert math.floor(r.rate) <= r.copies <= math.floor(r.rate) + 1


def test_rates_are_those_of_plain_projected_gradient(spark):
    rows, marks = rated(90)
    docs = documents(spark, rows)
    model = mixing.fit(docs, labels(spark, marks))
    got = mixing.mix_documents(docs, model, mixing.SHARES).collect()
    p = np.array([[r.p_bad, r.p_toxic, r.p_clean] for r in got])
    n = np.array([r.n_tokens for r in got])
    available = n @ p
    share = np.array(list(mixing.SHARES.values()))
    target = share / share[2] * available[2]
    r, now, moved = np.ones(len(p)), available, np.inf
    while moved > 1e-10 * available.sum():   # to the end, without momentum or a first guess
        r = np.maximum(0, r - p @ ((now - target) / available))
        before, now = now, (r * n) @ p
        moved = np.abs(now - before).max()
    assert np.allclose(r, [x.rate for x in got], atol=1e-3)


def test_token_counts_of_mixing_are_the_tokenizers(spark):
    tok = Tokenizer.from_file(public_tokenizers.path(mixing.TOKENIZER))
    got = Counter((r.doc_id, r.n_tokens) for r in mixing.mix_documents(documents(spark, awkward()), mixing.fit_domains([], np.zeros(0, int))).collect())
    assert got == Counter((i, len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in awkward())


def test_mainly_clean_documents_keep_their_copies(spark):
    """The query's own targets, on the given documents."""
    docs = table(spark, SF2, "documents")
    got = mixing.mix_documents(docs, mixing.fit(docs, table(spark, SF2, "labels"))).collect()
    total = {d: sum(r.rate * r.n_tokens * r[f"p_{d}"] for r in got) for d in mixing.SHARES}
    for d, share in mixing.SHARES.items():
        assert abs(total[d] / sum(total.values()) - share) <= 2 * mixing.CLOSE
    clean = [r for r in got if r.p_clean > 0.5]
    assert len(clean) > 500 and all(r.rate > 0.5 for r in clean)
    assert sum(r.copies == 0 for r in clean) <= 0.04 * len(clean)
    bad = [r for r in got if r.p_bad > 0.5]
    assert np.mean([r.rate for r in bad]) < 0.6


def least_squares(p, available, target):
    """Expected tokens of the best rates >= 0 (an active set of directions, to the end)."""
    scale = 1 / np.sqrt(available)
    b, rays = target * scale, p * scale
    rays = rays / np.linalg.norm(rays, axis=1, keepdims=True)
    held, x = [], np.zeros(0)
    for _ in range(1000):
        gain = rays @ (b - x @ rays[held])
        if gain.max() <= 1e-12 * np.linalg.norm(b):
            return (x @ rays[held]) / scale
        held, x = held + [int(gain.argmax())], np.append(x, 0.0)
        while True:
            z = np.linalg.lstsq(rays[held].T, b, rcond=None)[0]
            if (z > 0).all():
                x = z
                break
            x = x + (x[z <= 0] / (x[z <= 0] - z[z <= 0])).min() * (z - x)
            held, x = [h for h, v in zip(held, x) if v > 1e-14], x[x > 1e-14]
    raise AssertionError("no end")


@pytest.mark.parametrize("sharp, n", [(1.0, 400), (0.3, 400), (3.0, 9000)])
def test_rates_are_a_converged_least_squares_fit(spark, sharp, n):
    rnd = np.random.default_rng(5)
    z = rnd.normal(size=(n, 3)) / sharp * 2 + np.array([0, -4.0, 4.0])   # a rare, soft domain
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    words_ = rnd.integers(1, 2000, n)
    posts = spark.createDataFrame([(k, p[k].tolist(), int(words_[k])) for k in range(n)], "doc_id long, p array<double>, n_tokens long")
    available = words_ @ p
    for shares in (mixing.SHARES, {"bad": 0.0, "toxic": 0.02, "clean": 0.98}, {"bad": 0.001, "toxic": 0.02, "clean": 0.979},
                   {"bad": 0.3, "toxic": 0.3, "clean": 0.4}):
        target = np.array(list(shares.values())) / shares["clean"] * available[2]
        fit = mixing.fit_rates(posts, shares)
        tokens = (fit.rates(p) * words_) @ p
        assert np.allclose(tokens, fit.tokens, rtol=1e-6)
        best = least_squares(p, available, target)
        unit = np.where(target > 0, target, target.sum())
        assert (np.abs(tokens - best) <= 2 * mixing.CLOSE * unit).all()
        assert np.allclose(fit.residual, (tokens - target) / unit, atol=1e-5)


def test_mixed_keeps_clean_documents_and_emits_copies(spark):
    rnd = random.Random(2)
    rows, marks = [], []
    for k in range(600):   # a word that half of the bad texts and a part of the clean ones have: soft posteriors
        bad = k % 3 == 0
        odd = rnd.random() < (0.6 if bad else 0.15)
        rows.append((k, " ".join(f"w{rnd.randrange(300)}" for _ in range(60)) + (" odd" if odd else " even")))
        marks.append((k, int(not bad), 0))
    docs = documents(spark, rows)
    model = mixing.fit(docs, labels(spark, marks))
    shares = {"bad": 0.1, "toxic": 0.0, "clean": 0.9}
    p = {r.doc_id: r for r in mixing.mix_documents(docs, model, shares).collect()}
    kept = Counter(r.doc_id for r in mixed_rows(docs, model, shares))
    clean = {i for i, r in p.items() if r.p_clean > 0.5}
    assert 300 < len(clean) < 600 and clean <= set(kept)
    # the fit has to make up for documents that are less than clean, by second copies
    assert max(kept.values()) >= 2
    least = mixing.fit_rates(spark.createDataFrame([(i, [r.p_bad, r.p_toxic, r.p_clean], 60) for i, r in p.items()],
                                                   "doc_id long, p array<double>, n_tokens long"), shares, whole=2)
    want = {i: float(least.rates(np.array([[r.p_bad, r.p_toxic, r.p_clean]]))[0]) for i, r in p.items()}
    assert abs(sum(kept.values()) - sum(want.values())) < 0.1 * sum(want.values())


    # with a bound of 1 it only takes away
    once = Counter(r.doc_id for r in mixed_rows(docs, model, shares, most=1.0))
    assert clean <= set(once) and max(once.values()) == 1 and len(once) < 600


def mixed_rows(docs, model, shares, **more):
    got = mixing.mixed(docs, model, shares, **more)
    assert got.columns == docs.columns
    return got.collect()


def test_mixing_of_awkward_rows(spark):
    docs = documents(spark, awkward())
    model = mixing.fit(docs, labels(spark, []))
    got = mixing.mix_documents(docs, model).collect()
    assert len(got) == docs.count()
    assert all(abs(r.p_bad - 1 / 3) < 1e-6 for r in got)
    assert mixing.mixed(docs, model).columns == docs.columns
    assert mixing.mix_documents(documents(spark, []), model).collect() == []
    assert mixing.mixed(documents(spark, []), model).collect() == []


def brute_scores(rows, target_ids):
    """Scores by word and word-pair counts in plain Python."""
    def tokens(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        return [*w, None] if w else []   # None: the boundary

    def counts(texts):
        single, pair = Counter(), Counter()
        for t in texts:
            single.update(tokens(t))
            pair.update(zip([None, *tokens(t)], tokens(t)))
        return single, pair

    everything = counts(t for _, t in rows)
    chosen = counts(t for i, t in rows if i in target_ids)
    n, n_target = sum(everything[0].values()), sum(chosen[0].values())

    def model(single, pair, scale, total):
        m = lm_score.PRIOR

        def loss(v, w):
            p = (single[w] * scale + m * everything[0][w] / n) / (total + m)
            return -math.log((pair[v, w] * scale + m * p) / (single[v] * scale + m))
        return loss

    scale = n_target / n if n_target else 1
    target, background = model(*chosen, 1, n_target), model(*everything, scale, n * scale)
    return [(i, len(tokens(t)), sum(target(*g) - background(*g) for g in zip([None, *tokens(t)], tokens(t))) / max(1, len(tokens(t))))
            for i, t in rows]


def same_scores(got, want):
    key = lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])
    for a, b in zip(sorted(((r.doc_id, r.n_tokens, r.score) for r in got), key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and math.isclose(a[2], b[2], rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("size", [8 << 20, 20_000])
def test_lm_scores(spark, monkeypatch, size):
    monkeypatch.setattr(lm_score, "SLICE_BYTES", size)
    monkeypatch.setattr(lm_score, "GROUP_BYTES", size)
    marks = [(13, 1, 0), (13, 1, 0), (19, 1, None), (100, 1, 1), (101, 0, 0), (None, 1, 0), (110, None, 0)]
    same_scores(lm_score.score_documents(documents(spark, awkward()), labels(spark, marks)).collect(), brute_scores(awkward(), {13, 19}))


def test_lm_scores_of_a_hot_row(spark, monkeypatch):
    """A third of the table is one repeated row: it is dealt over the slices."""
    monkeypatch.setattr(lm_score, "SLICE_BYTES", 10_000)
    monkeypatch.setattr(lm_score, "GROUP_BYTES", 10_000)
    rows = [(1, "the same words again and again")] * 500 + [(2 + k, f"other words {k % 7} and more {k}") for k in range(1000)]
    same_scores(lm_score.score_documents(documents(spark, rows), labels(spark, [(k, 1, 0) for k in range(1, 90)])).collect(),
                brute_scores(rows, set(range(1, 90))))


def test_lm_scores_without_target_or_documents(spark):
    same_scores(lm_score.score_documents(documents(spark, awkward()), labels(spark, [])).collect(), brute_scores(awkward(), set()))
    assert lm_score.score_documents(documents(spark, []), labels(spark, [])).collect() == []
    blank = lm_score.score_documents(documents(spark, [(1, None), (2, " ")]), labels(spark, [(1, 1, 0)])).collect()
    assert sorted(tuple(r) for r in blank) == [(1, 0, 0.0), (2, 0, 0.0)]


def test_lm_scores_tell_junk_from_clean(spark):
    docs, marks = table(spark, SF2, "documents"), table(spark, SF2, "labels").toPandas().sort_values("doc_id")
    scores = {r.doc_id: r.score for r in lm_score.score_documents(docs, spark.createDataFrame(marks[::2])).collect()}
    rest = marks[1::2]
    junk = [scores[i] for i, q in zip(rest.doc_id, rest.quality) if not q]
    clean = [scores[i] for i, q in zip(rest.doc_id, rest.quality) if q]
    assert sum(j > c for j in junk for c in clean) / (len(junk) * len(clean)) > 0.9


def test_licences(spark):
    mit = license_scan._MIT
    rows = [
        (1, mit), (2, "Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(",", " ,\n")), (3, mit + " and more"),
        (4, "text\nReleased under the MIT Licence!\nmore\n# licensed under the Apache license - version 2 0"),
        (5, None), (6, ""), (7, "© 2021 us"), (None, mit), (1, mit), (8, "This is released under the MIT License."),
        (9, "MIT License\nCopyright 2019 A. B.\n" + mit.replace("non", "Non")),
    ]
    got = Counter((r.doc_id, r.license, r.line_licenses) for r in license_scan.scan(
        documents(spark, rows), license_scan.known_digests(spark)).collect())
    assert got == Counter([(1, "MIT", ""), (1, "MIT", ""), (2, "MIT", ""), (3, None, ""), (4, None, "Apache-2.0,MIT"), (5, None, ""),
                           (6, None, ""), (7, None, ""), (None, "MIT", ""), (8, None, ""), (9, "MIT", "")])
    assert license_scan.scan(documents(spark, []), license_scan.known_digests(spark)).collect() == []


def test_licences_in_other_dress(spark):
    """Texts on one line, other list marks and line ends, names and versions."""
    bsd = license_scan._BSD_HEAD + license_scan._BSD_THREE + license_scan._BSD_WARRANTY
    flat = " ".join(license_scan._MIT.split())
    rows = [
        (1, "Copyright (c) 2020 J. R. Smith and others. " + flat, "MIT"), (2, "Copyright law is hard to read\n" + license_scan._MIT, None),
        (3, "Copyright 2001 The Foo Inc.\r\nAll rights reserved.\r\n\r\n" + bsd.replace("\n", "\r"), "BSD-3-Clause"),
        (4, bsd.replace("1. ", "* ").replace("2. ", "  (b) ").replace("3. ", "- "), "BSD-3-Clause"),
        (5, license_scan._UNLICENSE.replace("non-commercial", "non-\ncommercial"), "Unlicense"),
        (6, "SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0-only"), (7, "# SPDX-License-Identifier: MPL-2.0", "MPL-2.0"),
        (8, "Released under the GNU General Public Licence v2", "GPL-2.0-only"),
        (9, "Licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1-only"),
        (10, "Licensed under CC BY-SA 3.0", "CC-BY-SA-3.0"), (11, "licence licence license", None), (12, "Copyright (c) 2020 X", None),
    ]
    known = license_scan.known_digests(spark)
    assert len({d for d, _, _ in known}) == len(known) < 2000
    got = {r.doc_id: r for r in license_scan.scan(documents(spark, [x[:2] for x in rows]), known).collect()}
    assert {i: got[i].license for i, _, _ in rows} == {i: want for i, _, want in rows}
    same = license_scan.scan(documents(spark, [(1, "license license license"), (2, "")]), known).collect()
    assert {r.doc_id: r.digest for r in same} == {1: got[11].digest, 2: got[12].digest}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_with_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    cursor = con.execute(ORACLE_SQL[name])
    names = [c[0] for c in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert Counter(map(tuple, got.select(*names).collect())) == Counter(cursor.fetchall())


def test_pipeline_on_the_documents(spark):
    docs = table(spark, SF2, "documents")
    ids = {r.doc_id for r in docs.collect()}
    marks = {r.doc_id: r for r in table(spark, SF2, "labels").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF2)
        assert kept.columns == docs.columns, name
        kept = spark.createDataFrame(kept.collect(), docs.schema)
        left = {r.doc_id for r in kept.collect()}
        assert left < ids, name
        clean = {i for i in ids if i in marks and marks[i].quality == 1 and not marks[i].toxic}
        if name != "simhash_near_dedup":
            assert len(clean - left) <= 0.02 * len(clean), (name, len(clean - left), len(clean))   # 399 labels to learn from
        docs, ids = kept, left
    junk = {i for i, r in marks.items() if r.quality == 0}
    assert not junk & ids
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF2).collect()
    assert {r.doc_id for r in packed} == ids
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF2).collect()} == ids


def test_planted_toxic_documents_do_not_reach_packing(spark, tmp_path):
    rnd = random.Random(4)
    rows, marks = [], []
    for k in range(600):
        toxic, junk = k % 60 < 3, k % 60 == 3
        text = " ".join(f"w{rnd.randrange(100_000)}" for _ in range(80)) + (" badword badword" if toxic else "")
        rows.append((k, "JUNK!!! " * (40 + k) if junk else text))
        marks.append((k, int(not junk), int(toxic)))
    documents(spark, rows, extra=False).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, marks[:480]).write.parquet(f"{tmp_path}/labels.parquet")
    docs = table(spark, str(tmp_path), "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(tmp_path)).collect(), docs.schema)
    left = {r.doc_id for r in docs.collect()}
    assert not left & {i for i, _, toxic in marks if toxic}
    clean = {i for i, good, toxic in marks if good and not toxic}
    assert len(clean - left) <= 0.02 * len(clean)


def test_mixing_stage_brings_small_languages_up_to_their_share(spark, tmp_path):
    rnd = random.Random(11)
    rows, marks = [], []
    for k in range(480):
        lang = "b" if k % 6 == 0 else "a"
        toxic = k % 40 == 1
        rows.append((k, " ".join(f"{lang}{rnd.randrange(300)}" for _ in range(60)) + (" badword" * 5 if toxic else ""), lang))
        marks.append((k, 1, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, marks[:400]).write.parquet(f"{tmp_path}/labels.parquet")
    kept = Counter(r.doc_id for r in corpus_pipeline.mixing_to_targets(spark, docs, str(tmp_path)).collect())
    clean = {k for k, _, toxic in marks if not toxic}
    assert set(kept) == clean
    size = Counter()
    for k, _, lang in rows:
        size[lang] += k in clean
    copies = Counter()
    for k, n in kept.items():
        copies[rows[k][2]] += n
    assert copies["a"] <= 1.05 * size["a"]
    want = (80 / 400) ** corpus_pipeline.LANGUAGE_POWER
    assert abs(copies["b"] / copies["a"] - want) < 0.2 * want   # coins of 80 documents
    assert max(kept.values()) >= 2
    # without languages, without documents
    one = corpus_pipeline.mixing_to_targets(spark, docs.drop("lang"), str(tmp_path))
    assert {r.doc_id for r in one.collect()} == clean and one.columns == ["doc_id", "text"]
    none = spark.createDataFrame(docs.withColumn("lang", F.lit(None).cast("string")).collect(), docs.schema)
    assert {r.doc_id for r in corpus_pipeline.mixing_to_targets(spark, none, str(tmp_path)).collect()} == clean
    assert corpus_pipeline.mixing_to_targets(spark, docs.limit(0), str(tmp_path)).collect() == []
