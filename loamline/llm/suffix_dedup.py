"""Removal of byte strings of ``WINDOW`` bytes that also start earlier, by deep-shallow sorting of suffixes.

Sorting every suffix of a corpus would ship each byte many times. Only suffixes at anchors are sorted: of the grams of
``GRAM`` bytes in a window the one with the smallest hash, the leftmost of ties, is its anchor. Equal windows have equal anchors at equal
places, so a window can only repeat within the group of its anchor's gram. Consecutive windows of one anchor form a run, and its bytes a
context.

1. Runs with equal contexts: all but the first repeat it as a whole. Each task tells that of its own runs before any are shuffled.
2. Contexts of one gram that differ go, as bytes, to the group of the gram. There the suffixes that start at the anchor, and the
   reversed texts before it, are sorted: by multikey quicksort, on characters of eight bytes, to a shallow depth, then by a blind trie for each
   group that is still equal. Neighbours' common prefixes tell for each place of a window which windows are equal, and all
   but the first of those repeat it.
3. Groups of one gram that are too large for one sort, and those that a sample of documents shows to be hot, are sorted in parts; windows that
   are first in their part meet once more, by a 64-bit hash of their bytes within the gram's 64 bits.

Defined results. A null text counts as empty: no bytes, nothing removed. Texts below ``WINDOW`` bytes stay. Repeated rows are texts of their
own, the later ones go. Rows of one doc_id are ordered by a hash of their texts and null ids come last. Without rows the result is empty.
Rows of one doc_id are numbered in one task, so ids must be nearly unique.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.scratch import materialize, small_batches, unused
from loamline.llm.text import mix64, numbers, ragged, slices
from loamline.sources.shared import workspace

WINDOW, GRAM = 100, 32
#: Grams of a window, so places that an anchor can have in it.
PLACES = WINDOW - GRAM + 1
#: Characters of eight bytes that multikey quicksort looks at, before blind tries.
SHALLOW = 5
#: Bytes of text in a bucket of the written table, runs that a task compares by itself, and contexts sorted at a time.
BUCKET_BYTES, LOCAL_RUNS, CHUNK = 24 << 20, 1 << 20, 100_000
#: One document in so many tells hot grams: those with as many runs or more in the sample; the hottest only.
SAMPLE, HOT_RUNS, HOT_GRAMS = 64, 256, 20_000
#: Contexts of a hot gram in each part.
PART = 20_000
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


# --- runs of windows with one anchor -----------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes at each place of ``data``."""
    n = len(data) - GRAM + 1
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    word = np.array(np.ndarray((len(data),), "<u8", padded, strides=(1,)))
    h = word[:n] * _A
    for at, factor in ((8, _B), (16, _A), (24, _B)):
        h ^= h >> np.uint64(31)
        h += word[at : at + n]
        h *= factor
    h ^= h >> np.uint64(29)
    h *= _A
    return h ^ (h >> np.uint64(32))


def _anchors(h: np.ndarray) -> np.ndarray:
    """For each window the place of its smallest gram hash, by the hash's upper half, the leftmost of ties."""
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    wide, step = 1, 1
    while 2 * wide <= PLACES:
        key, wide = np.minimum(key[:-step], key[step:]), 2 * wide
        step = wide
    if wide < PLACES:
        key = np.minimum(key[: len(key) - (PLACES - wide)], key[PLACES - wide :])
    return (key & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and UTF-8 bytes of null-free texts."""
    flat = text.cast(pa.large_binary())
    flat = pa.concat_arrays([flat])
    _, ends, data = flat.buffers()
    offsets = np.frombuffer(ends, np.int64)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], raw


def _runs(text: pa.Array) -> dict[str, np.ndarray]:
    """Runs of null-free texts: text, gram hash, context hash, start, windows, and the anchor's distance from the start."""
    offsets, data = _bytes(text)
    sizes = np.diff(offsets)
    if not (sizes >= WINDOW).any():
        return {c: np.zeros(0, np.int64) for c in ("row", "a", "h", "start", "size", "lead")}
    h = _gram_hashes(data)
    anchor = _anchors(h)
    edge = np.zeros(len(data) + 1, np.int8)
    long = sizes >= WINDOW
    np.add.at(edge, offsets[:-1][long], 1)
    np.add.at(edge, offsets[1:][long] - WINDOW + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:-1], dtype=np.int8))
    place = anchor[at]
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (np.diff(at) > 1))))
    start, size = at[first], np.diff(np.concatenate((first, [len(at)])))
    place = place[first]
    length = size + WINDOW - 1
    context = mix64(length)
    for step in range(0, WINDOW + PLACES, GRAM):
        inside = step + GRAM <= length
        context = mix64(context ^ np.where(inside, h[np.where(inside, start + step, start)], 0))
    context = mix64(context ^ h[start + length - GRAM])
    row = np.searchsorted(offsets, start, "right") - 1
    return {"row": row, "a": h[place].view(np.int64), "h": context.view(np.int64), "start": start - offsets[row], "size": size, "lead": place - start}


_RUN = ("a", "h", "k", "copy", "start", "size", "lead")
#: As runs are shuffled: h is null where a run is gone, a is null where it is ``deal``, shape is size * PLACES + lead.
_RUN_TYPE = "deal long, a long, h long, k long, copy int, start int, shape long"


def _local_firsts(run: dict[str, np.ndarray], deal: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> pa.RecordBatch:
    """Runs to be dealt out by gram, and those gone since an equal context comes earlier among them: these follow one another as one, dealt out by place."""
    order = np.lexsort((run["start"], run["copy"], run["k"], run["h"], run["a"]))
    run = {c: v[order] for c, v in run.items()}
    gone = np.concatenate(([False], (run["a"][1:] == run["a"][:-1]) & (run["h"][1:] == run["h"][:-1])))[: len(order)]
    cut, run = _end_to_end({c: run[c][gone] for c in ("k", "copy", "start", "size")}), {c: v[~gone] for c, v in run.items()}
    by_place = mix64(mix64(cut["k"]) ^ cut["start"].astype(np.uint64)).view(np.int64)
    to, n, none = deal(run["a"], run["h"]), len(run["a"]), np.zeros(len(by_place), np.int64)
    both = {c: np.concatenate((run[c], cut[c])) for c in ("k", "copy", "start")}
    shape = np.concatenate((run["size"] * PLACES + run["lead"], cut["size"] * PLACES))
    a, h, last = np.concatenate((run["a"], none)), np.concatenate((run["h"], none)), np.arange(n + len(none)) >= n
    columns = {"deal": np.concatenate((to, by_place)), "a": pa.array(a, mask=last | (a == np.concatenate((to, none)))), "h": pa.array(h, mask=last)}
    return pa.RecordBatch.from_pydict({**columns, "k": both["k"], "copy": both["copy"].astype(np.int32), "start": both["start"].astype(np.int32), "shape": shape})


def _end_to_end(run: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Runs of which each begins where one of the same text ends, as one."""
    order = np.lexsort((run["start"], run["copy"], run["k"]))
    run = {c: v[order] for c, v in run.items()}
    k, copy, start, size = (run[c] for c in ("k", "copy", "start", "size"))
    first = np.flatnonzero(np.concatenate(([True], (k[1:] != k[:-1]) | (copy[1:] != copy[:-1]) | (start[1:] != start[:-1] + size[:-1])))[: len(k)])
    return {"k": k[first], "copy": copy[first], "start": start[first], "size": np.add.reduceat(size, first) if len(first) else size}


def _runs_of(texts: DataFrame, deal: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        for b in batches:
            k, copy, at = numbers(b.column("k")), numbers(b.column("copy")), 0
            for part in slices(b.column("text")):
                run = _runs(part)
                row = run.pop("row") + at
                held.append(run | {"k": k[row], "copy": copy[row]})
                at += len(part)
                if sum(len(x["a"]) for x in held) >= LOCAL_RUNS:
                    yield _local_firsts({c: np.concatenate([x[c] for x in held]) for c in _RUN}, deal)
                    held = []
        if held:
            yield _local_firsts({c: np.concatenate([x[c] for x in held]) for c in _RUN}, deal)

    return texts.select("k", "copy", "text").mapInArrow(found, _RUN_TYPE)


# --- deep-shallow sorting ----------------------------------------------------------------------


def blind_trie_order(strings: list[bytes]) -> list[int]:
    """The order of strings of one length, by insertion into a blind trie: its nodes know a depth and branching bytes only.

    A string goes down by its bytes at the nodes' depths, wherever that leads; one comparison with the leaf it comes to tells
    where it leaves the path, and there it is put in. Equal strings share a leaf in the order they came.
    """
    root: list | None = None  # a leaf is [-1, places], a node [depth, children]
    for i, s in enumerate(strings):
        if root is None:
            root = [-1, [i]]
            continue
        node = root
        while node[0] >= 0:
            node = node[1].get(s[node[0]]) or next(iter(node[1].values()))
        other = strings[node[1][0]]
        if other == s:
            node[1].append(i)
            continue
        depth = len(s) - ((int.from_bytes(s) ^ int.from_bytes(other)).bit_length() + 7) // 8
        above, node = None, root
        while 0 <= node[0] < depth:
            above, node = node, node[1][s[node[0]]]
        if node[0] == depth:
            node[1][s[depth]] = [-1, [i]]
            continue
        fork = [depth, {other[depth]: node, s[depth]: [-1, [i]]}]
        if above is None:
            root = fork
        else:
            above[1][s[above[0]]] = fork
    out: list[int] = []
    todo = [root] if root else []
    while todo:
        node = todo.pop()
        if node[0] < 0:
            out += node[1]
        else:
            todo += [node[1][b] for b in sorted(node[1], reverse=True)]
    return out


def deep_shallow(chars: np.ndarray, length: np.ndarray, group: np.ndarray, *, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """The order of strings within each group, shorter ones before those they begin, and the common prefix of each with the next.

    ``chars`` holds them as big-endian characters of eight bytes, zeros behind the end. The last of a group has -1 in common with the next.
    """
    m, depth = chars.shape
    order = np.argsort(group, kind="stable")
    # a range holds strings that are equal so far; each level sorts all ranges of two or more by their next character
    new = np.concatenate(([True], group[order][1:] != group[order][:-1]))[:m]
    for level in range(min(shallow, depth)):
        bound = np.flatnonzero(new)
        size = np.diff(np.append(bound, m))
        open_ = np.repeat(size > 1, size)
        if not open_.any():
            break
        at = np.flatnonzero(open_)
        of = np.repeat(np.arange(len(bound)), size)[at]
        c = chars[order[at], level]
        by = np.lexsort((c, of))
        order[at] = order[at][by]
        c, of = c[by], of[by]
        new[at[1:]] |= (of[1:] == of[:-1]) & (c[1:] != c[:-1])
    bound = np.flatnonzero(new)
    size = np.diff(np.append(bound, m))
    for at, n in zip(bound[size > 1].tolist(), size[size > 1].tolist(), strict=True):
        rows = order[at : at + n]
        rows = rows[np.argsort(length[rows], kind="stable")]
        if depth > shallow:
            rest = np.ascontiguousarray(chars[rows, shallow:]).astype(">u8").tobytes()
            width = 8 * (depth - shallow)
            rows = rows[blind_trie_order([rest[i * width : (i + 1) * width] for i in range(n)])]
        order[at : at + n] = rows
    common = np.full(m, -1, np.int64)
    if m > 1:
        common[:-1] = _common(chars, length, order)
        common[:-1][group[order][1:] != group[order][:-1]] = -1
    return order, common


def _common(chars: np.ndarray, length: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that neighbours in ``order`` have in common from their start."""
    shared = np.zeros(len(order) - 1, np.int64)
    same = np.ones(len(order) - 1, bool)
    for level in range(chars.shape[1]):
        x = chars[order[1:], level] ^ chars[order[:-1], level]
        lead = np.full(len(x), 8, np.int64)
        for k in range(8):
            lead -= x >> np.uint64(8 * k) > 0
        shared += np.where(same, lead, 0)
        same &= x == 0
        if not same.any():
            break
    return np.minimum(shared, np.minimum(length[order[1:]], length[order[:-1]]))


def _chars(data: np.ndarray, start: np.ndarray, length: np.ndarray, width: int, step: int = 1) -> np.ndarray:
    """``length`` bytes from each ``start``, forwards or backwards, as rows of ``width`` characters of eight bytes."""
    out = np.zeros((len(start), 8 * width), np.uint8)
    col = ragged(np.zeros(len(start), np.int64), length)
    row = np.repeat(np.arange(len(start)), length)
    out[row, col] = data[np.repeat(start, length) + step * col]
    return out.view(">u8").astype(np.uint64)


def repeats(data: np.ndarray, at: np.ndarray, lead: np.ndarray, size: np.ndarray, group: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """For each context (from ``at``, its anchor ``lead`` further) and each place j of the anchor in a window: whether the window repeats an earlier one.

    ``rank`` is the order of the contexts' anchors in the corpus.
    """
    m = len(at)
    right_length = size - lead + WINDOW - 1
    right, right_common = deep_shallow(_chars(data, at + lead, right_length, -(-WINDOW // 8)), right_length, group)
    left, left_common = deep_shallow(_chars(data, at + lead - 1, lead, -(-PLACES // 8), -1), lead, group)
    out = np.zeros((m, PLACES), bool)
    right_class, left_class = np.empty(m, np.int64), np.empty(m, np.int64)
    for j in range(PLACES):
        rows = np.flatnonzero((j <= lead) & (j > lead - size))
        if len(rows) < 2:
            continue
        right_class[right] = np.concatenate(([0], np.cumsum(right_common[:-1] < WINDOW - j)))
        left_class[left] = np.concatenate(([0], np.cumsum(left_common[:-1] < j)))
        key = right_class[rows] * m + left_class[rows]
        order = np.lexsort((rank[rows], key))
        key = key[order]
        out[rows[order[1:]], j] = key[1:] == key[:-1]
    return out


def _window_hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the WINDOW bytes from each start."""
    out = np.empty(len(start), np.uint64)
    for a in range(0, len(start), 50_000):
        part = start[a : a + 50_000]
        words = data[part[:, None] + np.arange(WINDOW)]
        words = np.concatenate((words, np.zeros((len(part), -WINDOW % 8), np.uint8)), axis=1).view("<u8")
        h = np.zeros(len(part), np.uint64)
        for k in range(words.shape[1]):
            h = mix64(h ^ words[:, k])
        out[a : a + 50_000] = h
    return out.view(np.int64)


_SPAN_TYPE = "k long, copy int, at int, length int, a long, w long"


def _sorted_groups(split: np.ndarray, chunk: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Spans of repeated windows of contexts that come sorted by gram; ``split`` has the grams whose contexts are dealt out in parts."""

    def solve(table: pa.Table, partly: set[int]) -> pa.RecordBatch:
        b = table.combine_chunks()
        a, k, copy, start, size, lead = (numbers(b[c].combine_chunks()) for c in ("a", "k", "copy", "start", "size", "lead"))
        offsets, data = _bytes(b["context"].combine_chunks())
        rank = np.empty(len(a), np.int64)
        rank[np.lexsort((start + lead, copy, k))] = np.arange(len(a))
        gone = repeats(data, offsets[:-1], lead, size, np.unique(a, return_inverse=True)[1], rank)
        # place j of the anchor is the window that starts j bytes before it: in text order, j falls
        edges = np.diff(np.pad(gone[:, ::-1].astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, first = np.nonzero(edges == 1)
        last = np.nonzero(edges == -1)[1]
        base = start + lead - (PLACES - 1)
        none = np.zeros(len(row), bool)
        parts = [(k[row], copy[row], base[row] + first, last - first + WINDOW - 1, a[row], np.zeros(len(row), np.int64), none)]
        if partly:
            of = np.isin(a, np.array(sorted(partly), np.int64))
            j = np.arange(PLACES)
            row, j = np.nonzero(of[:, None] & ~gone & (j <= lead[:, None]) & (j > (lead - size)[:, None]))
            w = _window_hashes(data, offsets[:-1][row] + lead[row] - j)
            parts.append((k[row], copy[row], start[row] + lead[row] - j, np.full(len(row), WINDOW), a[row], w, np.ones(len(row), bool)))
        k, copy, at, length, a, w, known = (np.concatenate(x) for x in zip(*parts, strict=True))
        columns = [pa.array(k), pa.array(copy.astype(np.int32)), pa.array(at.astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(a), pa.array(w, mask=~known)]
        return pa.RecordBatch.from_arrays(columns, names=["k", "copy", "at", "length", "a", "w"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, carried = [], 0, None
        for b in batches:
            held.append(b)
            rows += b.num_rows
            if rows < chunk:
                continue
            table = pa.Table.from_batches(held)
            a = numbers(table["a"].combine_chunks())
            cut = int(np.searchsorted(a == a[-1], True)) if a[0] != a[-1] else 0
            if cut:  # the last gram may go on in the next batch
                yield solve(table.slice(0, cut), _marked(split, a[:cut]) | ({carried} & {int(a[0])}))
                table = table.slice(cut)
                held, rows = table.to_batches(), table.num_rows
            if rows >= chunk:  # one gram alone fills it: sorted in parts
                carried = int(a[-1])
                yield solve(table, {carried})
                held, rows = [], 0
        if rows:
            table = pa.Table.from_batches(held)
            a = numbers(table["a"].combine_chunks())
            yield solve(table, _marked(split, a) | ({carried} & {int(a[0])}))

    return run


def _marked(split: np.ndarray, a: np.ndarray) -> set[int]:
    return set(np.intersect1d(split, a).tolist())


# --- the whole job -----------------------------------------------------------------------------


def _numbered(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """(k, copy, doc_id, text) as a written table in buckets of k, the documents' order, and how many: joins on k leave the texts where they are."""
    spark = docs.sparkSession
    small_batches(spark)
    whole = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    total = whole.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, math.ceil(total / BUCKET_BYTES))
    last = F.shiftleft(F.lit(1).cast("long"), 62) + F.pmod(F.xxhash64("text"), F.shiftleft(F.lit(1).cast("long"), 61))
    order = Window.partitionBy("k").orderBy(F.col("doc_id").isNull(), F.xxhash64("text"))
    rows = whole.withColumn("k", F.coalesce(F.col("doc_id").cast("long"), last)).repartition(buckets, "k").withColumn("copy", F.row_number().over(order) - 1)
    name, path = f"texts_{uuid.uuid4().hex}", workspace(spark, "texts")
    rows.select("k", "copy", "doc_id", "text").write.bucketBy(buckets, "k").option("path", path).saveAsTable(name)
    table = spark.table(name)
    table.schema  # noqa: B018  resolved: the catalogue's entry is not needed any more, the files stay
    spark.sql(f"DROP TABLE {name}")
    return table, buckets


def _hot(texts: DataFrame, sample: int, least: int, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams with many contexts by a sample of documents, sorted, and the parts that each is cut into."""
    some = texts.where(F.pmod(F.xxhash64("k", "copy"), F.lit(sample)) == 0)
    runs = _runs_of(some, lambda a, h: a).where("h IS NOT NULL")
    found = runs.groupBy(F.coalesce("a", "deal").alias("a")).count().where(F.col("count") >= least).orderBy(F.desc("count"), "a").limit(HOT_GRAMS).collect()
    found = sorted((r["a"], r["count"]) for r in found)
    return np.array([x for x, _ in found], np.int64), np.array([1 + n * sample // part for _, n in found], np.int64)


def _contexts(row: DataFrame, hot: np.ndarray, parts: np.ndarray) -> DataFrame:
    """The bytes of the runs that each text was asked for."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, asked, copies, k = b.column("text").cast(pa.large_binary()), b.column("asked"), numbers(b.column("copy")), numbers(b.column("k"))
            for i in range(b.num_rows):
                one = asked[i].values
                want = {c: numbers(one.field(c)) for c in ("copy", "a", "h", "start", "size", "lead")}
                mine = want.pop("copy") == copies[i]
                want = {c: v[mine] for c, v in want.items()}
                n = int(mine.sum())
                if not n:
                    continue
                data = np.frombuffer(text[i].as_buffer(), np.uint8)
                length = want["size"] + WINDOW - 1
                flat = data[ragged(want["start"], length)]
                offsets = np.concatenate(([0], np.cumsum(length))).astype(np.int32)
                context = pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])
                deal = want["a"]
                if len(hot):
                    place = np.minimum(np.searchsorted(hot, deal), len(hot) - 1)
                    part = (want["h"].view(np.uint64) % parts[place].astype(np.uint64)).astype(np.int64)
                    deal = np.where(hot[place] == deal, mix64(mix64(deal) ^ part.astype(np.uint64)).view(np.int64), deal)
                whole = {c: pa.array(want[c].astype(np.int32)) for c in ("start", "size", "lead")}
                yield pa.RecordBatch.from_pydict({"deal": pa.array(deal), "a": pa.array(want["a"]), "k": pa.array(np.full(n, k[i])), "copy": pa.array(np.full(n, copies[i], np.int32)), **whole, "context": context})

    return row.select("k", "copy", "text", "asked").mapInArrow(cut, "deal long, a long, k long, copy int, start int, size int, lead int, context binary")


def _kept(text: Column, spans: Column, copy: Column) -> Column:
    """What is left of a text without spans (copy, at, length) of its own copy, and how much went."""

    @F.arrow_udf("struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept:binary>")
    def cut(texts: pa.Array, lists: pa.Array, copies: pa.Array) -> pa.Array:
        removed, count, left, mine = [], [], [], numbers(copies)
        sizes = numbers(pc.binary_length(texts))
        for i in range(len(texts)):
            if not lists[i].is_valid:
                removed.append(0), count.append(0), left.append(texts[i].as_buffer().to_pybytes())
                continue
            one = lists[i].values
            own = numbers(one.field("copy")) == mine[i]
            at, length = numbers(one.field("at"))[own], numbers(one.field("length"))[own]
            edge = np.zeros(sizes[i] + 1, np.int64)
            np.add.at(edge, at, 1)
            np.add.at(edge, at + length, -1)
            gone = np.cumsum(edge[:-1]) > 0
            removed.append(int(gone.sum()))
            count.append(int((gone & ~np.concatenate(([False], gone[:-1]))).sum()))
            left.append(np.frombuffer(texts[i].as_buffer(), np.uint8)[~gone].tobytes())
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(left, pa.binary())], ["n_bytes", "n_removed", "n_spans", "kept"])

    return cut(text, spans, copy)


def without_repeats(
    docs: DataFrame, into: str, *, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK, sample: int = SAMPLE, hot_runs: int = HOT_RUNS, part: int = PART
) -> DataFrame:
    """(doc_id, ``into``): bytes, bytes and maximal runs removed, and the bytes kept, of every document.

    The other arguments bound what is sorted at a time; the result is the same for all of them.
    """
    texts, buckets = _numbered(docs, doc_id, text)
    hot, parts = _hot(texts, sample, hot_runs, part)

    def deal(a: np.ndarray, h: np.ndarray) -> np.ndarray:
        return np.where(np.isin(a, hot), mix64(mix64(a) ^ h.view(np.uint64)).view(np.int64), a) if len(hot) else a

    context, gram = Window.partitionBy("deal", "a", "h").orderBy("k", "copy", "start"), Window.partitionBy("deal", "a")
    runs = _runs_of(texts, deal).repartition("deal").withColumn("gone", F.col("h").isNull() | (F.row_number().over(context) > 1))
    several, own = F.min("h").over(gram) != F.max("h").over(gram), F.coalesce("a", "deal")
    if len(hot):
        several = several | own.isin(*hot.tolist()) if len(hot) <= 200 else several | _among(hot)(own)
    kept = runs.withColumn("several", F.coalesce(several, F.lit(False))).where("gone OR several")
    of_gram = [F.when(~F.col("gone"), x).alias(c) for c, x in (("a", own), ("h", F.col("h")))]
    told = kept.select(*of_gram, "k", "copy", "start", F.expr(f"CAST(shape div {PLACES} AS INT)").alias("size"), F.expr(f"CAST(shape % {PLACES} AS INT)").alias("lead"), "gone")
    told = materialize(told, "runs")
    asked = told.where("NOT gone").repartition(buckets, "k").groupBy("k").agg(F.collect_list(F.struct("copy", "a", "h", "start", "size", "lead")).alias("asked"))
    contexts = _contexts(texts.join(asked.hint("merge"), "k"), hot, parts)
    sorted_ = contexts.repartition("deal").sortWithinPartitions("deal", "a").mapInArrow(_sorted_groups(hot, chunk), _SPAN_TYPE)
    found = materialize(sorted_, "spans")
    again = found.where("w IS NOT NULL").withColumn("r", F.row_number().over(Window.partitionBy("a", "w").orderBy("k", "copy", "at"))).where("r > 1")
    whole = told.where("gone").select("k", "copy", F.col("start").alias("at"), (F.col("size") + (WINDOW - 1)).alias("length"))
    spans = whole.unionByName(found.where("w IS NULL").select("k", "copy", "at", "length")).unionByName(again.select("k", "copy", "at", "length"))
    spans = spans.repartition(buckets, "k").groupBy("k").agg(F.collect_list(F.struct("copy", "at", "length")).alias("spans"))
    joined = texts.join(spans.hint("merge"), "k", "left")
    column = unused(["doc_id", "text", "k", "copy", "spans"], into)
    return joined.select("doc_id", _kept(F.col("text"), F.col("spans"), F.col("copy")).alias(column)).withColumnRenamed(column, into)


def _among(values: np.ndarray) -> Callable[[Column], Column]:
    """Whether a long is among many: looked up in Arrow batches."""

    @F.arrow_udf("boolean")
    def found(x: pa.Array) -> pa.Array:
        return pa.array(np.isin(numbers(x), values))

    return found
