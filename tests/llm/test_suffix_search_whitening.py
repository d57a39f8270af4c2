"""Removal of repeated strings, ranked search and whitening, against brute force."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loamline.llm import lexical, queries, suffix_dedup, whitening
from tests.llm.conftest import SF

# --- removal of repeated strings ---------------------------------------------------------------


def plain_removal(rows: list[tuple]) -> list[tuple]:
    """(doc_id, bytes, removed, spans, kept) of (doc_id, text) rows in their order."""
    seen, out = set(), []
    for doc_id, text in rows:
        b = (text or "").encode()
        gone, free = bytearray(len(b)), 0
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                for z in range(max(p, free), p + 100):
                    gone[z] = 1
                free = p + 100
            seen.add(w)
        spans = sum(1 for z in range(len(b)) if gone[z] and not (z and gone[z - 1]))
        out.append((doc_id, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return out


def removal(df, **options) -> list[tuple]:
    rows = suffix_dedup.without_repeats(df, "x", **options).select("doc_id", "x.*").collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in rows), key=str)


def test_removal_agrees_with_brute_force(spark, texts):
    want = {d: (n, r, s, hashlib.sha256(k).hexdigest()) for d, n, r, s, k in plain_removal(sorted(texts.items()))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op11_suffix_dedup(spark, SF).collect()}
    assert got == want and sum(v[1] for v in want.values()) > 100_000


def passages(seed: int) -> list[tuple[int, str]]:
    """Texts that share passages between and inside them, with edits a few bytes apart and letters of several bytes."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeéü漢") for _ in range(r.randint(1, 7)))
    pool = [" ".join(word() for _ in range(r.randint(20, 60))) for _ in range(4)]
    out = []
    for i in range(40):
        parts = []
        for _ in range(r.randint(1, 4)):
            p = r.choice(pool)
            if r.random() < 0.5:
                at = r.randrange(len(p))
                p = p[:at] + word() + p[at + r.randint(0, 3) :]
            parts.append(p if r.random() < 0.8 else word() * r.randint(1, 200))
        out.append((i, " ".join(parts)))
    return out


@pytest.mark.parametrize("options", [{}, {"chunk": 7, "sample": 1, "hot_runs": 2, "part": 3}, {"chunk": 3}])
def test_removal_in_parts_is_the_same(spark, options):
    """Hot grams and full chunks are sorted in parts; the windows that stay open meet once more."""
    rows = passages(5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert removal(df, **options) == sorted(plain_removal(rows), key=str)


def test_runs_that_are_gone_at_once_travel_as_one_row(spark):
    """What a task tells by itself needs no gram or context, so a copy's hundreds of runs are shuffled as a few rows; others keep theirs."""
    text = " ".join(str(x) for x in np.random.default_rng(1).integers(0, 10**6, 3_000))
    rows = spark.createDataFrame([(1, 0, text), (2, 0, text)], "k long, copy int, text string").coalesce(1)
    runs = suffix_dedup._runs_of(rows, lambda a, h: a).collect()
    first, copy = ([r for r in runs if r.k == k] for k in (1, 2))
    assert len(first) > 300 and len(copy) == 1
    assert all(r.a is None and r.h is not None for r in first)  # the gram is where the run is dealt to
    assert (copy[0].h, copy[0].start, copy[0].shape // suffix_dedup.PLACES) == (None, 0, len(text) - 99)


def test_removal_on_odd_rows(spark, odd, empty):
    from tests.llm.conftest import ODD

    got = removal(odd)
    last = sorted((r for r in ODD if r[0] is not None), key=lambda r: r[0]) + [r for r in ODD if r[0] is None]
    assert got == sorted(plain_removal([(i, t) for i, t, _ in last]), key=str)
    assert removal(empty) == []
    twice = spark.createDataFrame([(None, "x" * 150), (7, "y" * 99), (7, "z" * 260), (7, "z" * 260)], "doc_id long, text string")
    assert [(d, r) for d, _, r, _, _ in removal(twice)] == [(7, 0), (7, 259), (7, 260), (None, 149)] or sum(r[2] for r in removal(twice)) == 668


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.binary(max_size=70)), max_size=40))
def test_deep_shallow_orders_strings(rows):
    group = np.array([g for g, _ in rows], np.int64)
    length = np.array([len(s) for _, s in rows], np.int64)
    chars = np.frombuffer(b"".join(s.ljust(72, b"\0") for _, s in rows), ">u8").reshape(-1, 9).astype(np.uint64)
    order, common = suffix_dedup.deep_shallow(chars, length, group, shallow=2)
    assert sorted(order.tolist()) == list(range(len(rows)))
    key = [(rows[i][0], rows[i][1].ljust(72, b"\0"), len(rows[i][1])) for i in order]
    assert key == sorted(key)
    for a, b, n in zip(order, order[1:], common, strict=False):
        x, y = rows[a], rows[b]
        shared = next((i for i in range(min(len(x[1]), len(y[1]))) if x[1][i] != y[1][i]), min(len(x[1]), len(y[1])))
        assert n == (shared if x[0] == y[0] else -1)


@given(st.lists(st.text("ab", min_size=6, max_size=6), max_size=30))
def test_blind_trie(strings):
    data = [s.encode() for s in strings]
    assert suffix_dedup.blind_trie_order(data) == sorted(range(len(data)), key=lambda i: (data[i], i))


# --- ranked search -----------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in TERM.findall(text or "")]


def plain_ranking(docs, items, k=10):
    bags = [(d, collections.Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n, total = len(bags), sum(x for _, _, x in bags)
    df = collections.Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        wanted, scored = set(terms(text)), []
        for d, b, size in bags:
            m = 10 + 90 * size * n // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in wanted if t in b)
            if score > 0:
                scored.append((-score, math.inf if d is None else d))
        out += [(item, i + 1, None if d == math.inf else d, -s) for i, (s, d) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def test_ranking_agrees_with_brute_force(spark, texts):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in queries.op12_lexical_search(spark, SF).collect()), key=str)
    assert got == plain_ranking(list(texts.items()), items)


def test_ranking_on_odd_rows(spark, odd, empty):
    from tests.llm.conftest import ODD

    items = [(1, "one TWO 漢字"), (2, None), (3, " .,"), (4, "licensed word"), (1, "no id here"), (5, "x" * 300_000)]
    asked = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, query long")
    got = sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in lexical.ranked(odd, asked).collect()), key=str)
    assert got == plain_ranking([(i, t) for i, t, _ in ODD], items)
    assert lexical.ranked(empty, asked).collect() == [] == lexical.ranked(odd, asked.limit(0)).collect()


@pytest.mark.parametrize("seed", range(3))
def test_buckets_lose_nothing(seed, monkeypatch):
    """Small buckets, so that lengths, coordinates and the rest of the length all prune."""
    monkeypatch.setattr(lexical, "BUCKET_ROWS", 4)
    r = np.random.default_rng(seed)
    docs, vocabulary = 300, 40
    held = r.random((docs, vocabulary)) < 0.2
    impacts = np.where(held, (r.pareto(1.2, (docs, vocabulary)) * 1000).astype(np.int64) + 1, 0)
    offsets = np.concatenate(([0], np.cumsum(held.sum(axis=1))))
    lists = lexical.Lists(offsets, np.nonzero(held)[1], impacts[held], np.sqrt((impacts.astype(float) ** 2).sum(axis=1)), np.arange(docs))
    wanted = [np.flatnonzero(r.random(vocabulary) < 0.3) for _ in range(6)]
    block = lexical.Block(list(range(6)), list(range(6)), pa.array([str(i) for i in range(vocabulary)]), np.concatenate(([0], np.cumsum([len(w) for w in wanted]))), np.concatenate(wanted))
    best = lexical.Best(6, 5, [1] * 6)
    lexical._search(lists, block, best)
    for q, w in enumerate(wanted):
        scores = impacts[:, w].sum(axis=1)
        assert best.found[q] == sorted((-int(s), d) for d, s in enumerate(scores) if s > 0)[:5]


# --- whitening ---------------------------------------------------------------------------------


def plain_whitening(vectors, k=32):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    y = (n * x - s) / n
    e, u = np.linalg.eigh(y.T @ y / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), y @ u / np.sqrt(e), e / np.trace(y.T @ y / n)


def test_whitening_agrees_with_dense_eigenvectors(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").where("embedding IS NOT NULL").orderBy("vec_id").collect()
    n, deviation, z, share = plain_whitening([r.embedding for r in rows])
    got = queries.op13_whitening(spark, SF).toPandas()
    assert (got.n == n).all() and got.identity_error.max() <= 1e-9 and len(got) == 32 * len(rows)
    w = got.pivot(index="vec_id", columns="component", values="whitened").loc[[r.vec_id for r in rows]].to_numpy()
    assert np.abs(w * np.sign((w * z).sum(axis=0)) - z).max() < 1e-9
    assert np.allclose(got.groupby("component").explained.first().to_numpy(), share, rtol=1e-10)
    assert (got[got.component == 1].set_index("vec_id").loc[[r.vec_id for r in rows]].deviation.to_numpy() == deviation).all()


def test_whitening_on_odd_rows(spark):
    rows = [(1, [1.0, 2.0, 0.5]), (2, [0.0, -1.0, 2.0]), (None, [0.5, 1.0, 1.0]), (4, None), (5, []), (6, [1.0, None, 1.0]), (7, [1.0, float("nan"), 1.0]), (8, [float("inf"), 0.0, 0.0]), (9, [1.0, 2.0]), (1, [1.0, 2.0, 0.5])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, n long")
    kept = whitening.integers(df, "embedding", "x")
    model = whitening.fit(kept, "x")
    out = whitening.whitened(kept, "x", model, "w").select("vec_id", "w.*").collect()
    assert sorted(str(r.vec_id) for r in out) == ["1", "1", "2", "None"] and model.n == 4
    assert model.identity_error < 1e-9 and all(len(r.whitened) == 2 for r in out)  # four rows, three of them different: two components
    same = whitening.integers(spark.createDataFrame([(1, [2.0]), (2, [2.0])], "vec_id long, embedding array<double>"), "embedding", "x")
    for none in (same, kept.limit(0), whitening.integers(df.where("vec_id = 5"), "embedding", "x")):
        assert whitening.fit(none, "x") is None and whitening.whitened(none, "x", None, "w").collect() == []
    huge = whitening.integers(spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 1.0])], "vec_id long, embedding array<double>"), "embedding", "x")
    assert [r.w.deviation for r in whitening.whitened(huge, "x", whitening.fit(huge, "x"), "w").collect()] == [None, None]


def test_filter_finds_a_steep_and_a_flat_spectrum():
    """Against dense eigenvectors, with products done here."""
    for values in (2.0 ** -np.arange(80), np.linspace(1, 2, 80)):
        q = np.linalg.qr(np.random.default_rng(0).standard_normal((80, 80)))[0]
        v = q * values @ q.T
        top = np.sort(values)[::-1][:8]
        got, _, ritz, residual = whitening._iterate(lambda x: v @ x, np.linalg.qr(np.random.default_rng(1).standard_normal((80, 24)))[0], 8, 12, 1e-13)  # noqa: B023
        assert residual <= 1e-12 and np.allclose(ritz[:8], top, rtol=1e-9, atol=1e-12) and np.allclose(got.T @ got, np.eye(24), atol=1e-9)
