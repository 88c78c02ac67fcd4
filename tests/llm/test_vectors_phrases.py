"""Whitening, collocations and exact top-k against brute force, on tables with nulls, empty and long
values, ties, repeated rows and clashing column names; and on empty tables."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from lodgeflow.llm import collocations, topk_search, whitening

from . import cases

VECTORS = "vec_id long, embedding array<float>, label int, x string, n long, query long, cand long, part string"


def vectors(seed=3, n=260, dims=6):
    r = np.random.default_rng(seed)
    rows = [(int(i), [float(c) for c in np.float32(v)]) for i, v in enumerate(r.normal(0.1, 0.4, (n, dims)))]
    rows += [(1000 + i, rows[7][1]) for i in range(60)]                      # a vector that many rows hold
    rows += [(50 * i, rows[7][1]) for i in range(30, 34)]
    rows += [rows[3], rows[3], (50, [0.5] * dims), (50, [0.5] * dims), (50, [-0.25] * dims)]
    rows += [(2001, None), (2002, [0.1, None, 0.2, 0.3, 0.4, 0.5]), (2003, [math.nan] * dims), (2004, [math.inf] + [0.0] * (dims - 1)),
             (2005, []), (2050, [0.75, -0.5]), (None, [0.3] * dims)]
    return rows


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 5, 6, 7, "p") for i, v in rows], VECTORS).repartition(5)


def whole(rows, dims):
    out = []
    for i, v in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            x = [math.floor(256 * float(np.float32(c))) for c in v]
            out.append((i, x + [0] * (dims - len(x))))
    return out


@pytest.mark.parametrize("k,heads,lists,blocks", [(5, 24, 2, (2048, 512)), (5, 1, 2, (40, 3)), (3, 4, 4, (64, 8)), (400, 1, 3, (100, 5))])
def test_top_k(spark, k, heads, lists, blocks):
    rows = vectors()
    found = [(i, x) for i, x in whole(rows, 6) if i is not None]
    want = []
    for i, x in sorted({(i, tuple(x)) for i, x in found if i % 50 == 0}):
        scores = sorted((-sum(a * b for a, b in zip(x, y)), j) for j, y in found if j != i)[:k]
        want += [(i, rank, j, -s) for rank, (s, j) in enumerate(scores, 1)]
    got = topk_search.top_k(embeddings(spark, rows), k=k, heads=heads, lists=lists, block_rows=blocks[0], block_queries=blocks[1])
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_top_k_of_few(spark):
    assert topk_search.top_k(embeddings(spark, [])).collect() == []
    assert topk_search.top_k(embeddings(spark, [(50, [1.0])])).collect() == []
    assert [tuple(r) for r in topk_search.top_k(embeddings(spark, [(50, [1.0]), (7, [-1.0])])).collect()] == [(50, 1, 7, -65536)]


def test_equal_vectors_add_one_entry(spark):
    """A vector held by most rows is one candidate, with its k + 1 smallest vec_ids."""
    rows = [(i, [0.5, 0.25]) for i in range(3000)] + [(5000, [1.0, 1.0])]
    cands = topk_search.candidates(topk_search.whole_vectors(embeddings(spark, rows)), 5).collect()
    assert sorted(len(r.members) for r in cands) == [1, 6]
    assert [m.vec_id for r in cands for m in r.members if len(r.members) == 6] == list(range(6))


def whitened(spark, rows, components=4, tasks=None, monkeypatch=None):
    if tasks:
        monkeypatch.setattr(whitening, "TASK_VECTORS", tasks)
    return whitening.whiten(embeddings(spark, rows), components).collect()


@pytest.mark.parametrize("tasks", [2048, 20])
def test_whitening(spark, tasks, monkeypatch):
    rows = vectors()
    kept = whole(rows, 6)
    fit = np.array(sorted({tuple(x) for _, x in kept}))
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    values, directions = np.linalg.eigh(centred.T @ centred / n)
    values, directions = values[::-1], directions[:, ::-1]
    got = whitened(spark, rows, 4, tasks, monkeypatch)
    assert len(got) == 4 * len(kept) and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    want = Counter()
    for i, x in kept:
        want[(i, sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums)))] += 4
    assert Counter((r.vec_id, int(r.deviation)) for r in got) == want
    by_row = {}
    for i, x in kept:
        by_row.setdefault(i, []).append(np.array(x) - sums / n)
    signs = {}
    for r in got:
        e = values[r.component - 1]
        assert abs(r.explained - e / values.sum()) < 1e-9 * r.explained
        exact = [c @ directions[:, r.component - 1] / math.sqrt(e) for c in by_row[r.vec_id]]
        near = min(exact, key=lambda v: abs(abs(v) - abs(r.whitened)))
        assert abs(abs(near) - abs(r.whitened)) < 1e-9
        if abs(near) > 1e-6 and len(by_row[r.vec_id]) == 1:
            signs.setdefault(r.component, set()).add(math.copysign(1, near * r.whitened))
    assert all(len(s) == 1 for s in signs.values())


def test_whitening_without_variance(spark):
    assert whitened(spark, []) == [] and whitened(spark, [(1, None)]) == []
    one = whitened(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])
    assert [(r.n, r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in one] == [(1, None, None, None, 0)] * 4
    flat = whitened(spark, [(i, [i / 8, 1.0, i / 4]) for i in range(9)])
    assert {r.component for r in flat if r.whitened is not None} == {1}
    assert {r.component for r in flat} == {1, 2, 3} and flat[0].identity_error < 1e-9


def test_spectrum_updates():
    """Rank-one updates and merges give the scatter matrix; eigenvalues that coincide deflate."""
    r = np.random.default_rng(5)
    ties = np.vstack([np.eye(5, dtype=np.int64) * 7, -np.eye(5, dtype=np.int64) * 7, np.zeros((3, 5), np.int64)])
    for x in (ties, np.floor(256 * r.normal(size=(300, 24))).astype(np.int64), np.floor(9 * r.normal(size=(4, 12))).astype(np.int64)):
        centred = x - x.mean(axis=0)
        scatter = centred.T @ centred
        whole_list, first, second = (whitening.Spectrum.empty(x.shape[1]) for _ in range(3))
        for k, v in enumerate(x):
            whole_list.add(v)
            (first if k % 3 else second).add(v)
        first.combine(second)
        for s in (whole_list, first):
            size = np.abs(scatter).max()
            assert np.abs((s.basis.T * s.eigenvalues) @ s.basis - scatter).max() < 1e-12 * size * len(x)
            assert np.abs(s.basis @ s.basis.T - np.eye(len(s.basis))).max() < 1e-12
            assert (np.diff(s.eigenvalues) >= -1e-12 * size).all() and s.n == len(x)


def phrases_by_hand(rows, least, longest, keep):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", cases.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[(lang, tuple(words[i:i + k]))] += 1
    often = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = {}
    for (lang, p), a in often.items():
        inside = any(lang == g and len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                     for (g, q), b in often.items())
        if not inside:
            score, k = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return [(lang, rank, p.decode(), -a, left, right, n[lang], -score)
            for lang, found in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:keep], 1)]


def phrase_rows():
    rows = [("en", t) for _, t in cases.texts()] + [(None, t) for _, t in cases.texts()[::2]]
    rows += [("und", "the the the the the the the. of the of the\tof the\x0bof"), ("de", "Der Hund! der Hund, DER HUND\nder hund"),
             ("de", "größe der hund größe"), ("", "a b a b a b"), ("en", "x y z w v u " * 40), ("en", "x y z w v u " * 40)]
    return rows


@pytest.mark.parametrize("least,longest,keep,bucket,ranked", [
    (3, 5, 2000, 1_000_000, 99), (3, 5, 2000, 60, 10**6), (3, 5, 2000, 60, 0), (2, 4, 7, 400, 10**6), (5, 2, None, 30, 0)])
def test_collocations(spark, least, longest, keep, bucket, ranked, monkeypatch):
    """Frequent words by rank, and beyond that bound by bit maps."""
    monkeypatch.setattr(collocations, "RANKED", ranked)
    monkeypatch.setattr(collocations, "MERGED", 500)
    rows = [(g, t) for g, t in phrase_rows() if len(t or "") < 50_000]
    docs = spark.createDataFrame([(k, t, g, "s", 1, 2, "w") for k, (g, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, source string, n long, code long, word string").repartition(4)
    got = [tuple(r) for r in collocations.collocations(docs, keep, least, longest, bucket).collect()]
    assert sorted(got) == sorted(phrases_by_hand(rows, least, longest, keep))


def test_collocations_of_a_long_text_and_of_none(spark):
    rows = [(g, t) for g, t in phrase_rows() if len(t or "") >= 50_000][:1]
    docs = spark.createDataFrame([(1, *rows[0][::-1])], "doc_id long, text string, lang string")
    got = [tuple(r) for r in collocations.collocations(docs, 2000, 30).collect()]
    assert got and sorted(got) == sorted(phrases_by_hand(rows, 30, 5, 2000))
    assert collocations.collocations(docs.limit(0)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(1, None, None)], docs.schema)).collect() == []


def test_shared_codes_are_seen(spark, monkeypatch):
    """Words that share a code under one seed are counted under the next."""
    real, first = collocations.word_hashes, int(collocations.Hasher(1).values[0])

    def clashing(hasher, data, starts, ends):
        codes = real(hasher, data, starts, ends)
        return codes * np.uint64(0) if int(hasher.values[0]) == first else codes

    monkeypatch.setattr(collocations, "word_hashes", clashing)
    docs = spark.createDataFrame([("a b a b", "en")], "text string, lang string")
    words, seed = collocations.word_counts(docs)
    assert seed == 2 and {(r.word, r.n) for r in words.collect()} == {("a", 2), ("b", 2)}


def test_hot_words_are_spread():
    """Suffixes of a hot pair go to many buckets; those that some other word leads stay together."""
    r = np.random.default_rng(1)
    columns = r.integers(10, 10_000, (5, 4000)).astype(np.uint64)
    columns[0], columns[1] = 1, 2
    hot = columns < 3
    key, _ = collocations.routes(columns, np.full(4000, 5, np.uint8), hot)
    assert len(set((key % np.uint64(50)).tolist())) == 50
    calm, _ = collocations.routes(columns, np.full(4000, 5, np.uint8), np.zeros_like(hot))
    assert len(set(calm.tolist())) == 1
