"""WARC, mixing, images, token files, packing and the pipeline against plain Python."""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from loamline.llm import media, mixing, packing, queries, scratch, token_store, tokens, warc

from .conftest import ODD, SF

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(t: str | None) -> np.ndarray:
    return np.array(LIBRARY.encode(t or "", add_special_tokens=False).ids + [1], "<u4")


# --- tokens ----------------------------------------------------------------------------------


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(list("abcdeE .,!'<|>0\nİ́é"))), max_size=40), max_size=4))
def test_chunks_encode_as_the_library_does(found):
    offsets, ids = tokens.encoder(PATH).encode(pa.array(found, pa.string()), 1)
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [ids_of(t).tolist() for t in found]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 5000), min_size=1, max_size=300), st.integers(0, 100))
def test_elias_fano_round_trip(steps, more):
    values = np.cumsum(steps)
    ef = token_store.EliasFano.encode(values, int(values[-1]) + 1 + more)
    assert ef.select_block(0, len(values)).tolist() == values.tolist() and [ef.select(k) for k in range(len(values))] == values.tolist()
    for first, last in ((0, 1), (len(values) // 3, len(values) // 2 + 1), (len(values) - 1, len(values) + 5), (63, 64), (64, 130)):
        assert ef.select_block(first, last).tolist() == values[first:last].tolist()


def test_elias_fano_is_small():
    values = np.cumsum(np.full(10_000, 1000))
    ef = token_store.EliasFano.encode(values, int(values[-1]) + 1)
    assert 8 * (len(ef.high) + len(ef.low) + len(ef.samples)) < 0.25 * 8 * len(values)


def test_token_files_equal_plain_ones(spark, texts):
    got = {r.doc_id: r for r in queries.op8_token_files(spark, SF).collect()}
    at = 0
    for i in sorted(texts):
        ids = ids_of(texts[i])
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_token_files_odd_rows_and_random_access(spark, odd, empty):
    manifest = token_store.write_token_files(odd, PATH)
    got = token_store.read_token_files(manifest).orderBy("start").collect()
    assert [r.doc_id for r in got][0] is None and [r.doc_id for r in got][1:] == sorted(i for i, *_ in ODD if i is not None)
    assert sum(r.n_tokens for r in got) == got[-1].start + got[-1].n_tokens and all(len(r.ids) == r.n_tokens and r.ids[-1] == 1 for r in got)
    path = manifest.orderBy("shard").first().path.removeprefix("file:")
    with open("/" + path.lstrip("/"), "rb") as f:
        shard = token_store.Shard(f)
        for k in range(shard.ends.n):
            assert shard.ids(*shard.bounds(k)).tolist() == got[k].ids
    none = token_store.write_token_files(empty, PATH)
    assert none.count() == 0 and token_store.read_token_files(none).count() == 0


# --- packing ---------------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=200))
def test_patterns_place_every_piece(lengths):
    histogram = np.bincount(lengths, minlength=33)[:33]
    patterns = packing.pack_histogram(histogram, 32)
    placed = np.zeros(33, int)
    for packs, pattern in patterns:
        assert packs > 0 and sum(n * t for n, t in pattern) <= 32
        for n, t in pattern:
            placed[n] += packs * t
    assert placed.tolist() == histogram.tolist()


def check_packing(rows, want: dict) -> None:
    """Every id in exactly one piece, sequences gapless and within the limit."""
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_seq[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    assert sorted(by_seq) == list(range(len(by_seq)))
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    for i, copies in want.items():
        pieces = sorted((r.start, r.length, r.ids_crc32) for r in by_doc[i])
        full = sorted((a, min(2048, len(ids) - a), zlib.crc32(ids[a : a + 2048].tobytes())) for ids in copies for a in range(0, len(ids), 2048))
        assert pieces == full and all(r.doc_tokens in {len(x) for x in copies} for r in by_doc[i])


def test_packing_whole_table(spark, texts):
    rows = queries.op10_packing(spark, SF).collect()
    check_packing(rows, {i: [ids_of(t)] for i, t in texts.items()})
    assert sum(r.length for r in rows) > 0.97 * 2048 * len({r.sequence_id for r in rows})


def test_packing_odd_rows(odd, empty):
    want = defaultdict(list)
    for i, t, _ in ODD:
        want[i].append(ids_of(t))
    check_packing(packing.pack(packing.pieces(odd, PATH).cache()).collect(), want)
    assert packing.pack(packing.pieces(empty, PATH)).count() == 0


# --- mixing ----------------------------------------------------------------------------------


def plain_targets(sizes: dict) -> dict:
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {}
    while open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 3 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / w for s in open_}
        for s in over:
            out[s] = 3.0 * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def test_mixing_meets_targets(spark, docs, texts):
    a, b = (sorted(map(tuple, queries.op4_mixing(spark, SF).collect())) for _ in range(2))
    assert a == b
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for i, n, _, t, k in a:
        assert n == len(texts[i].split()) and k in (0, n, 2 * n, 3 * n)
        size[source[i]] += n
        taken[source[i]] += k
        target[source[i]] = t
    want = plain_targets(size)
    for s in size:
        assert target[s] == pytest.approx(want[s], rel=1e-9) and abs(taken[s] - want[s]) < 0.1 * want[s]


def test_mixing_caps_and_odd_rows(spark, odd, empty):
    df = spark.createDataFrame([(i, "w " * n, s) for i, (n, s) in enumerate([(4, "a"), (300, "b"), (100, "c"), (7, None), (0, "d")])], "doc_id long, text string, source string")
    got = {r.source: r.m for r in mixing.with_mix(df, "m").collect()}
    want = plain_targets({"a": 4, "b": 300, "c": 100, None: 7, "d": 0})
    assert {s: m.target for s, m in got.items()} == pytest.approx(want) and got["a"].taken == 12
    out = mixing.with_mix(odd, "m").collect()
    assert len(out) == len(ODD) and all(0 <= r.m.copies <= 3 and r.m.taken == r.m.copies * r.m["size"] and r["size"] == "s" for r in out)
    assert mixing.with_mix(empty, "m").count() == 0


def test_mixing_takes_repeated_rows_one_by_one(spark):
    rows = [(1, "one two three four five six seven eight nine ten", "a")] * 1000 + [(2, "x " * 10, "b")] * 400
    out = mixing.with_mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5), "m").collect()
    want = plain_targets({"a": 10_000, "b": 4_000})
    for s in want:
        assert abs(sum(r.m.taken for r in out if r.source == s) - want[s]) <= 10
    assert len(out) == 1400 and {r.m.copies for r in out if r.source == "a"} == {0, 1} and max(r.m.copies for r in out) <= 3


def test_mixing_equals_plain_pareto_sampling(spark, docs):
    """The documents that are taken, by plain sorting of ranks drawn from the same random numbers."""
    word = mixing.word_count(F.col("text"))
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.xxhash64("text"), F.lit(7), F.lit(0).cast("long")), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    rows = docs.select("doc_id", "source", word.alias("n"), u.alias("u")).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r.n
    targets, want = plain_targets(sizes), {}
    for s, target in targets.items():
        own = [r for r in rows if r.source == s and r.n]
        words = defaultdict(int)
        for r in own:
            words[r.n.bit_length()] += r.n
        share, open_, left = {}, set(words), target
        while open_:  # shares by bit length times words, at most thrice the words
            level = left / sum(b * words[b] for b in open_)
            over = {b for b in open_ if b * level >= 3}
            share |= {b: 3.0 * words[b] for b in over} if over else {b: b * words[b] * level for b in open_}
            left -= sum(share[b] for b in over)
            open_ = open_ - over if over else set()
        copies = {b: share[b] / words[b] for b in words}
        certain = {b: math.floor(c + 1e-12) for b, c in copies.items()}
        pi = {b: copies[b] - certain[b] for b in copies}
        lack = sum(share[b] - certain[b] * words[b] for b in words)
        rank = lambda r: (o := r.u / (1 - r.u) * (1 - (p := pi[r.n.bit_length()])) / p) / (1 + o)  # noqa: E731, B023
        drawn = sorted((rank(r), r.doc_id, r) for r in own if pi[r.n.bit_length()] > 1e-12)
        head, total = set(), 0
        for _, i, r in drawn:
            if total + r.n > lack:
                break
            head.add(i)
            total += r.n
        gap = lack - total
        rest = [(abs(r.n - gap), k, i) for k, i, r in drawn if i not in head and r.n < 2 * gap]
        head |= {min(rest)[2]} if rest else set()
        want |= {r.doc_id: certain[r.n.bit_length()] + (r.doc_id in head) for r in own}
    got = {r.doc_id: r.m.copies for r in mixing.with_mix(docs, "m", keep=["doc_id"]).collect()}
    assert {i: got[i] for i in want} == want and all(not k for i, k in got.items() if i not in want)


# --- WARC ------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def pages(spark):
    long, crlf = "<p>long</p>" * 200, "WARC/1.1\r\n\r\n\r\nbody\r\n" * 60
    rows = [(1, "http://a/\r\nx", long), (2, "http://b", long), (9, None, long), (3, "http://c", "short"), (4, "http://d", "short"), (5, "http://e", None), (6, "http://f", crlf), (7, "http://f", crlf), (7, "http://f", crlf), (None, "http://g", "é" * 600)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)


def test_warc_round_trip(spark, pages, tmp_path):
    path = f"file://{tmp_path}/warc"
    warc.write_warc(pages, path)
    got = warc.assemble(warc.read_warc(spark, path)).collect()
    assert len(got) == 10 and all(len(r.requests) == 1 and len(r.metadata) == 1 for r in got)
    kinds = defaultdict(list)
    for r in got:
        key = r.metadata[0].fields["capture-key"]
        kinds[key].append((r.response.record_type, (r.response.refers_to or "").split(":")[2] if r.response.refers_to else None))
        want = {(str(p.page_id) if p.page_id is not None else ""): p.html or "" for p in pages.collect()}[key].encode()
        assert (r.response.payload_bytes, r.response.payload_digest) == (len(want), hashlib.sha1(want).hexdigest())
        assert r.response.payload is None or (bytes(r.response.payload) == want and r.response.digest_ok)
    assert kinds["9"] == [("response", None)] and kinds["1"] == kinds["2"] == [("revisit", "9")] and kinds["3"] == kinds["4"] == kinds["5"] == [("response", None)]
    assert sorted(kinds["7"]) == [("response", None), ("revisit", "7")] and kinds["6"] == [("revisit", "7")]
    for f in Path(tmp_path, "warc").glob("*.gz"):  # archives are plain WARC: every record ends as it should
        raw = gzip.decompress(f.read_bytes())
        assert not raw or raw.endswith(b"\r\n\r\n") and len(list(warc.parse_records(io.BytesIO(raw)))) % 3 == 0


def test_warc_query_and_no_rows(spark, pages):
    table = {r.page_id: r for r in queries.op3_warc(spark, SF).collect()}
    source = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert {i: (r.payload_bytes, r.payload_digest) for i, r in table.items()} == {i: (len(b), hashlib.sha1(b).hexdigest()) for i, b in source.items()}
    assert warc.assemble(warc.archive(pages.limit(0))).count() == 0


def test_warc_sizes_odd_records_and_ids(spark, tmp_path):
    rows = [(1, "http://a", "x" * (3 << 20)), (2, "http://b", "y" * (70 << 10)), (3, "http://c", "z"), (4, "http://c", "w" * (17 << 20))]
    path = f"file://{tmp_path}/warc"
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    records = warc.read_warc(spark, path)
    got = warc.assemble(records)
    assert sorted((int(r.metadata[0].fields["capture-key"]), r.response.payload_bytes) for r in got.collect()) == [(i, len(t)) for i, _, t in rows]
    nameless = records.withColumns({"record_id": F.lit(None).cast("string"), "concurrent_to": F.lit(None).cast("array<string>")})
    lone = warc.assemble(nameless).collect()
    assert len(lone) == 12 and sum(r.response is not None for r in lone) == 4 and sum(len(r.requests) for r in lone) == 4


# --- images ----------------------------------------------------------------------------------


def pictures(spark, vectors):
    """Drawn vectors as a written table with a number for each row."""
    drawn = media.drawn(spark.createDataFrame(vectors, "image_id long, v array<double>"))
    return scratch.materialize(drawn.withColumns({"picture": F.monotonically_increasing_id(), "image_class": media.class_of()}))


def described(df):
    return scratch.materialize(media.describe(df))


def frame(spark, rows):
    return spark.createDataFrame([(i, bytearray(np.rint(p).astype(np.uint8).tobytes()), p.shape[1]) for i, p in rows], "picture long, pixels binary, width int")


def vector(rng):
    return [float(x) for x in rng.normal(size=64)]


def test_copies_found_and_others_not(spark):
    out = queries.op5_media(spark, SF).collect()
    e = {r.vec_id: np.array(r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    assert sorted(r.image_id for r in out) == sorted(e)
    asked = [r for r in out if r.found is not None]
    assert {r.image_id for r in asked} == {i for i in e if i % 20 == 0} and sum(r.found > 0 and r.finders > 0 for r in asked) >= 0.95 * len(asked)
    cosine = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    assert all(cosine(e[r.finder_id], e[r.image_id]) > 0.9 for r in out if r.finders)
    assert all(r.copies_id <= r.image_id and cosine(e[r.copies_id], e[r.image_id]) > 0.9 for r in out)


def test_tables_find_what_comparing_all_corners_finds(spark):
    """Recall against brute force, over edits from none to noise and odd turns, at a share of 0.9 at least."""
    rng = np.random.default_rng(11)
    vectors = [vector(rng) for _ in range(150)]
    vectors += [[x + float(rng.normal()) * 0.05 * (i % 6) for x in vectors[i]] for i in range(100)]
    all_ = pictures(spark, list(enumerate(vectors)))
    a, q = described(all_), described(media.edited(all_.where("picture % 3 = 0")))
    got = {(r.query_id, r.match_id) for r in media.matches(q, a).collect()}
    left, right = ([(r.picture, bytes(r.corners)) for r in x.collect()] for x in (q, a))
    want = {(int(i), int(j)) for x in left for columns in media.verified([(x[1], y[1]) for y in right]) for i, j in zip(columns[0], columns[1], strict=True)}
    assert got <= want and len(want) > len(left) and len(got) >= 0.9 * len(want)


def test_keys_grow_with_the_corners():
    rng = np.random.default_rng(5)
    r = np.zeros(20_000, media.RECORD)
    for d in ("d0", "d1"):
        r[d] = rng.integers(-(2**63), 2**63, len(r))
    lengths = [media.key_length(r, n) for n in (10, 10**4, 10**6, 10**9, 10**12)]
    assert lengths == sorted(lengths) and lengths[0] < lengths[2] < lengths[4] <= 64
    assert media.key_length(r[:0], 10**6) == 8 and media.table_count(40) > media.table_count(8) >= 4
    r["d0"] = r["d1"] = 5  # all alike: no key is long enough
    assert media.key_length(r, 10**6) == 64


def test_a_corner_meets_as_many_by_chance_at_every_size():
    rng = np.random.default_rng(5)
    r = np.zeros(20_000, media.RECORD)
    for d in ("d0", "d1"):
        r[d] = rng.integers(-(2**63), 2**63, len(r))
    loads = [n * 2.0 ** -media.key_length(r, n) for n in (3000, 10_000, 40_000, 150_000, 500_000)]
    assert max(loads) <= 1.1 * media.LOAD and min(loads) >= media.LOAD / 2.2


def test_exact_copies_are_one_class_and_odd_images(spark):
    rng = np.random.default_rng(2)
    v = [vector(rng) for _ in range(3)]
    images = pictures(spark, [(0, v[0]), (1, v[1]), (2, v[0]), (3, None), (4, [None, 1.0])])
    sizes = sorted((r.image_id, r.members, r.shown) for r in media.classes(images).collect())
    assert sizes == [(0, 2, True), (1, 1, True), (3, 1, False), (4, 1, True)]
    name = {r.picture: r.image_id for r in images.collect()}
    found = media.matches(described(media.edited(images)), described(images)).collect()
    assert {(name[r.query_id], name[r.match_id]) for r in found} == {(0, 0), (0, 2), (1, 1), (2, 0), (2, 2)}
    tiny = spark.createDataFrame([(1, bytearray(9), 3), (2, bytearray(b""), 0), (3, bytearray(5), 3), (None, None, None)], "picture long, pixels binary, width int")
    assert media.describe(tiny).count() == 0 and media.describe(tiny.limit(0)).count() == 0
    none = described(tiny)
    assert media.matches(none, none).count() == 0


@pytest.mark.parametrize("n", [300, 6000])
def test_all_corners_within_the_radius_are_found(n):
    rng = np.random.default_rng(n)
    m = np.zeros(n, media.RECORD)
    for d in ("d0", "d1"):
        m[d] = rng.integers(-(2**63), 2**63, n)
        m[d][: n // 3] = m[d][0]  # a hot key
    q = m[:: n // 100].copy()
    for i in range(len(q)):  # 0 to 25 bits differ, over both halves
        for b in rng.choice(128, i % 26, replace=False):
            q[f"d{b // 64}"].view(np.uint64)[i] ^= np.uint64(1 << int(b % 64))
    apart = sum(np.bitwise_count(q[d].view(np.uint64)[:, None] ^ m[d].view(np.uint64)[None, :]).astype(int) for d in ("d0", "d1"))
    got = set(zip(*(x.tolist() for x in media.near(q, m, 20)), strict=True))
    assert got == set(zip(*(x.tolist() for x in np.nonzero(apart <= 20)), strict=True))


def test_copies_with_bits_changed_in_each_half(spark):
    rng = np.random.default_rng(4)
    a = described(pictures(spark, [(i, vector(rng)) for i in range(20)]))
    rows = []
    for x in a.collect():
        r = np.frombuffer(x.corners, media.RECORD).copy()
        for d in ("d0", "d1"):
            for b in rng.choice(64, 4, replace=False):
                r[d] ^= np.int64(1) << np.int64(b)
        rows.append((x.picture, bytearray(r.tobytes())))
    changed = scratch.materialize(spark.createDataFrame(rows, "picture long, corners binary"))
    assert {(r.query_id, r.match_id) for r in media.matches(changed, a).collect()} >= {(i, i) for i, _ in rows}


def test_near_exact_flat_and_missing_copies(spark):
    rng = np.random.default_rng(6)
    v = vector(rng)
    near = [x + 1e-2 for x in v]
    rows = [(0, v), (1, v), (2, near), *[(i, [1.0] * 64) for i in (20, 21, 40)], (3, vector(rng)), (60, None), (80, None), (100, vector(rng)), (100, v)]
    drawn = media.drawn(spark.createDataFrame(rows, "image_id long, v array<double>"))
    extra = drawn.withColumns({"picture": F.lit("taken"), "found": F.lit(1)}).select("image_id", "pixels", "width")
    out = queries.copies_found(extra).collect()
    got = sorted((r.image_id, r.first_id, r.class_size, r.copies_id, r.found if r.found is not None else -1, r.finders) for r in out)
    # two pictures share the id 100: one is a copy of 0, and both are asked for
    assert got == [
        (0, 0, 3, 0, 2, 1), (1, 0, 3, 0, -1, 1), (2, 2, 1, 0, -1, 1), (3, 3, 1, 3, -1, 0), (20, 20, 3, 20, 0, 0), (21, 20, 3, 20, -1, 0), (40, 20, 3, 20, 0, 0),
        (60, 60, 2, 60, 0, 0), (80, 60, 2, 60, 0, 0), (100, 0, 3, 0, 2, 1), (100, 100, 1, 100, 1, 1),
    ]


@pytest.mark.parametrize("degrees", [0, 17, 100])
def test_crops_of_large_pictures_at_odd_turns(spark, degrees):
    rng = np.random.default_rng(8)
    large = [np.kron(rng.integers(0, 256, (40, 40)), np.ones((8, 8))) for _ in range(3)]
    large = [(a[:-1, :-1] + a[1:, :-1] + a[:-1, 1:] + a[1:, 1:]) / 4 for a in large]
    y, x = np.mgrid[:160, :160] - 80.0
    c, s = np.cos(np.radians(degrees)), np.sin(np.radians(degrees))
    sx, sy = c * x - s * y + 170, s * x + c * y + 150
    ix, iy = sx.astype(int), sy.astype(int)
    fx, fy = sx - ix, sy - iy
    a = large[1]
    cut = (a[iy, ix] * (1 - fx) + a[iy, ix + 1] * fx) * (1 - fy) + (a[iy + 1, ix] * (1 - fx) + a[iy + 1, ix + 1] * fx) * fy
    found = media.matches(described(frame(spark, [(20, cut)])), described(frame(spark, enumerate(large)))).collect()
    best = max(found, key=lambda r: r.inliers)
    assert best.match_id == 1 and best.inliers >= 20 and all(r.inliers < best.inliers / 3 for r in found if r.match_id != 1)
    assert min(abs(best.turn * 360 / media.TURNS - degrees), 360 - abs(best.turn * 360 / media.TURNS - degrees)) <= 3


def test_many_near_copies_are_compared_with_few_and_no_link_is_lost(spark, monkeypatch):
    """Compared pairs grow with a group of near copies, not with its square, and the same pictures belong together as by all pairs."""
    plain, seen, pairs = media.compared, [], {}
    monkeypatch.setattr(media, "compared", lambda p, *a, **k: (seen.append(p.count()), plain(p, *a, **k))[1])
    for n in (100, 400):
        rng = np.random.default_rng(12)
        one, seen[:] = vector(rng), []
        vectors = [[x + float(rng.normal()) * 0.01 for x in one] for _ in range(n)] + [vector(rng) for _ in range(20)]
        all_ = pictures(spark, list(enumerate(vectors)))
        name = {r.picture: r.image_id for r in all_.collect()}
        a, q = described(all_), described(media.edited(all_.where("image_id % 5 = 0")))
        met, groups = media.searched(q, a)
        first = {r.picture: r["first"] for r in groups.collect()}
        found = {(name[r.query_id], first[r.match_id]) for r in met.collect()}
        pairs[n] = sum(seen)
        if n == 100:
            want = {(name[r.query_id], first[r.match_id]) for r in media.matches(q, a).collect()}
            assert want <= found and len({f for i, f in first.items() if name[i] < n}) < 10
    assert pairs[400] <= 5 * pairs[100]


def test_half_size_and_noisy_copies(spark):
    rng = np.random.default_rng(9)
    whole = [np.kron(rng.integers(0, 256, (24, 24)), np.ones((6, 6))) for _ in range(25)]
    half = [(a[::2, ::2] + a[1::2, ::2] + a[::2, 1::2] + a[1::2, 1::2]) / 4 for a in whole]
    noisy = [np.clip(a[10:, 12:] * 0.8 + 20 + rng.normal(0, 4, (134, 132)), 0, 255) for a in whole]
    a = described(frame(spark, enumerate(whole)))
    for edited, scale in ((half, 1), (noisy, 0)):
        found = media.matches(described(frame(spark, enumerate(edited))), a).collect()
        best = {q: max((r for r in found if r.query_id == q), key=lambda r: r.inliers) for q in {r.query_id for r in found}}
        assert sum(q == r.match_id and r.scale == scale for q, r in best.items()) >= 23 and all(q == r.match_id for q, r in best.items())


# --- pipeline --------------------------------------------------------------------------------


def test_pipeline_stages_take_effect(spark, docs, labels, texts):
    from .test_text_operators import plain_components, plain_fingerprint, plain_statistics

    assert [k for k, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "near_duplicates", "mixing", "packing"]
    step, kept = docs, []
    for _, f in corpus_pipeline.STAGES:
        step = f(spark, step, SF).cache()
        kept.append(step)
    assert all(k.columns == docs.columns for k in kept[:4])
    ids = [sorted(r.doc_id for r in k.select("doc_id").collect()) for k in kept]
    by = {r.doc_id: r for r in labels.collect()}
    assert sum(by[i].toxic for i in ids[0] if i in by) <= 0.15 * sum(r.toxic for r in by.values())
    clean = [i for i, r in by.items() if not r.toxic and r.quality]
    assert sum(i in set(ids[0]) for i in clean) >= 0.97 * len(clean)
    for i in ids[1]:
        n, *_, repeated = plain_statistics(texts[i])
        assert n >= 10 and 100 * repeated <= 20 * n
    groups = plain_components([plain_fingerprint(texts[i]) for i in ids[1]])
    assert ids[2] == sorted(ids[1][g] for g in set(groups))
    assert set(ids[3]) <= set(ids[2]) and max(map(ids[3].count, set(ids[3]))) <= 3
    want = defaultdict(list)
    for i in ids[3]:
        want[i].append(ids_of(texts[i]))
    check_packing(kept[4].collect(), want)


def test_pipeline_keeps_columns_of_any_name(spark, docs):
    names = ["_toxicity", "_quality", "_f", "_row", "_root", "_group", "_mix", "_copy", "_d", "_size"]
    step = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for _, f in corpus_pipeline.STAGES[:4]:
        step = f(spark, step, SF).cache()
    rows = step.select("doc_id", *names).collect()
    assert rows and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)


def test_pipeline_stages_on_odd_rows(spark, odd):
    """Null, empty, very long and repeated texts: every stage gives what it states, whatever comes in."""
    columns = odd.columns
    toxic, quality, near, mixed, packed = (f(spark, odd, SF).cache() for _, f in corpus_pipeline.STAGES)
    assert all(df.columns == columns for df in (toxic, quality, near, mixed)) and toxic.count() <= len(ODD)
    assert {r.doc_id for r in quality.collect()} <= {5, None, 7}  # base failures go: under ten words, or repeats
    ids = [r.doc_id for r in near.collect()]
    assert ids.count(4) == 1 and sum(i in (1, 2, 3) for i in ids) == 1
    assert {r.doc_id for r in mixed.collect()} & {1, 2, 3} == set()
    assert sum(r.length for r in packed.collect()) == sum(len(ids_of(t)) for _, t, _ in ODD)


def test_pipeline_of_no_rows(spark, docs):
    step = docs.limit(0)
    for _, f in corpus_pipeline.STAGES:
        step = f(spark, step, SF)
    assert step.count() == 0


def records_of(spark, *rows):
    full = [(kind, rid, to, None, f"u{i}", date, None, None, 0, None, None, None) for i, (kind, rid, to, date) in enumerate(rows)]
    return spark.createDataFrame(full, warc.RECORD)


def test_transactions_are_connected_in_either_direction(spark):
    got = warc.assemble(
        records_of(
            spark, ("response", "a", ["b"], "1"), ("request", "b", None, "1"), ("metadata", "c", ["a"], "1"),  # response -> request, metadata -> response
            ("response", "d", [], "1"), ("request", "e", ["d"], "1"), ("metadata", "f", ["e"], "1"),  # metadata -> request
            ("response", "g", [], "2"), ("revisit", "g", [], "1"), ("request", "h", ["g", "i"], "1"), ("metadata", "i", [], "1"),  # one id twice, several links
            ("request", "k", ["gone"], "1"), ("metadata", "l", ["gone"], "1"), ("metadata", None, ["a"], "1"), ("metadata", None, None, "1"),
        )
    ).collect()
    ids = lambda rs: sorted(str(r.record_id) for r in rs)
    told = sorted((str(r.capture_id), r.response and r.response.date, ids(r.requests), ids(r.metadata), ids(r.more)) for r in got)
    assert told == [("None", None, [], ["None"], []), ("a", "1", ["b"], ["None", "c"], []), ("d", "1", ["e"], ["f"], []), ("g", "1", ["h"], ["i"], ["g"]), ("gone", None, ["k"], ["l"], [])]


def test_repeated_headers_are_all_links():
    import io

    text = b"WARC/1.1\r\nWARC-Type: request\r\nWARC-Record-ID: <x>\r\nWARC-Concurrent-To: <a>\r\nWARC-Concurrent-To: <b>\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    head, block = next(warc.parse_records(io.BytesIO(text)))
    assert warc._row(head, block, False)["concurrent_to"] == ["a", "b"]
