"""SimHash near-duplicates through a Gray-order hierarchical index.

1. ``with_fingerprint``: a 64-bit SimHash of the word shingles of the whole text.
2. ``linked``: distinct fingerprints are dealt to buckets by the bits they must share if they differ in
   at most ``radius`` bits. In a bucket they are sorted by Gray rank, so that neighbours share most
   bits; consecutive ones form nodes that keep the shared bits and a mask of them, nodes form
   upper nodes. The search descends pairs of nodes and drops a pair once its shared bits
   already differ in more than ``radius`` places. No pair within the radius is missed.
3. A bucket's links become a spanning forest there; ``components`` joins the forests.

A bucket above ``block`` rows is cut into parts and each pair of parts is a bucket of its own, so
that no task holds a group of unbounded size.

Defined results: a null text counts as empty; a text without words has fingerprint 0, which links
like any other; repeated doc_ids and rows keep their rows; rows with a null doc_id take part, and
their component is null only if no member has an id. No rows give no rows; other columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.components import components
from loamline.llm.scratch import materialize, small_batches
from loamline.llm.text import by_slices, lower_ascii, ragged, split_words

SEED = 42
FAN = 8

#: Lane k of _LANES[b] is bit k of byte b: eight counters of eight bits in one word.
_LANES = np.array([sum(((b >> k) & 1) << (8 * k) for k in range(8)) for b in range(256)], np.uint64)


def bit_majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per group of consecutive hashes the bits that are set in over half of them; 0 for an empty group."""
    out = np.zeros(len(counts), np.uint64)
    if not len(hashes):
        return out
    # segments of up to 255 hashes of one group, so that no lane overflows
    segments = (counts + 254) // 255
    offsets = np.cumsum(counts) - counts
    starts = np.repeat(offsets, segments) + 255 * ragged(np.zeros(len(counts), np.int64), segments)
    full = np.flatnonzero(counts)
    first = (np.cumsum(segments) - segments)[full]
    raw = hashes.view(np.uint8).reshape(-1, 8)
    for byte in range(8):
        lanes = np.add.reduceat(_LANES[raw[:, byte]], starts)
        per = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int32), first, axis=0)
        bits = np.packbits(2 * per > counts[full, None], axis=1, bitorder="little").ravel().astype(np.uint64)
        out[full] |= bits << np.uint64(8 * byte)
    return out


def fingerprints(text: pa.Array, shingle: int) -> pa.Array:
    """SimHash, as a signed 64-bit integer, of each of the null-free texts."""
    offsets, words = split_words(lower_ascii(text))
    counts = np.diff(offsets)
    # all words of the slice, separated by single spaces, in one buffer
    ends = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)) if len(ends) else ends
    lists = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.binary()))
    buffer = memoryview(pc.binary_join(lists, b" ")[0].as_buffer() if len(words) else b"")
    n = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    first = ragged(offsets[:-1], n)
    last = np.minimum(first + shingle, np.repeat(offsets[1:], n)) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(buffer[a:b], SEED) for a, b in zip(starts[first].tolist(), ends[last].tolist(), strict=True)), np.uint64, len(first))
    return pa.array(bit_majority(hashes, n).view(np.int64))


def with_fingerprint(docs: DataFrame, into: str, text: str = "text", *, shingle: int = 4) -> DataFrame:
    """``docs`` with a 64-bit SimHash column ``into``, as a signed integer."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("bigint")
    def fingerprint(column: pa.Array) -> pa.Array:
        return by_slices(column, lambda part: fingerprints(part, shingle), pa.int64())

    return docs.withColumn(into, fingerprint(F.col(text)))


def gray_rank(x: Column) -> Column:
    """The place of a 64-bit code in the sequence of reflected Gray codes."""
    for k in (1, 2, 4, 8, 16, 32):
        x = x.bitwiseXOR(F.shiftrightunsigned(x, k))
    return x


def _blocks(radius: int, n: int, bucket: int) -> list[int]:
    """Masks of bits: codes within the radius agree on all bits of one mask at least.

    64 bits are cut into blocks; some radius of them may differ, the others agree. More blocks give
    longer keys and more masks; the fewest are taken for which ``n`` even codes leave ``bucket`` in a bucket.
    """
    for parts in range(radius + 1, 13):
        cuts = [64 * i // parts for i in range(parts + 1)]
        block = [((1 << (cuts[i + 1] - cuts[i])) - 1) << cuts[i] for i in range(parts)]
        masks = [sum(block[i] for i in chosen) for chosen in combinations(range(parts), parts - radius)]
        if n / 2 ** min(m.bit_count() for m in masks) <= bucket or len(masks) > 64:
            return masks
    return masks


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def node_levels(codes: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Levels of nodes over segments of codes: (shared bits, mask of shared bits, first child, children).

    Level 0 are the codes, with all bits shared. Each next level joins FAN consecutive nodes of
    a segment, until every segment has one node. A node's mask is where all codes below agree.
    """
    full = np.full(len(codes), 2**64 - 1, np.uint64)
    levels = [(codes, full, np.arange(len(codes)), np.zeros(len(codes), np.int64))]
    sizes = np.diff(np.append(starts, len(codes)))
    while (sizes > 1).any():
        bits, mask, *_ = levels[-1]
        up = (sizes + FAN - 1) // FAN
        offsets = np.cumsum(sizes) - sizes
        first = np.repeat(offsets, up) + FAN * ragged(np.zeros(len(up), np.int64), up)
        held = np.diff(np.append(first, len(bits)))
        ones = np.bitwise_and.reduceat(bits & mask, first)
        zeros = np.bitwise_and.reduceat(~bits & mask, first)
        levels.append((ones, ones | zeros, first, held))
        sizes = up
    return levels


def close_pairs(codes: np.ndarray, starts: np.ndarray, roots: tuple[np.ndarray, np.ndarray], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of codes within the radius, from the given pairs of segments (a segment with itself: inside it)."""
    levels = node_levels(codes, starts)

    def descend(level: int, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, len(a), 1 << 14):
            x, y = a[at : at + (1 << 14)], b[at : at + (1 << 14)]
            bits, mask, first, held = levels[level]
            if level == 0:
                near = (np.bitwise_count(bits[x] ^ bits[y]) <= radius) & (x != y)
                yield x[near], y[near]
                continue
            near = (x == y) | (np.bitwise_count((bits[x] ^ bits[y]) & mask[x] & mask[y]) <= radius)
            x, y = x[near], y[near]
            n = held[x] * held[y]
            inner = ragged(np.zeros(len(x), np.int64), n)
            width = np.repeat(held[y], n)
            c, d = np.repeat(first[x], n) + inner // np.maximum(width, 1), np.repeat(first[y], n) + inner % np.maximum(width, 1)
            once = ~np.repeat(x == y, n) | (c <= d)
            yield from descend(level - 1, c[once], d[once])

    yield from descend(len(levels) - 1, *roots)


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``n`` nodes the smallest node of its component."""
    label = np.arange(n)
    for a, b in pairs:
        while len(a):
            x, y = label[a], label[b]
            low, high = np.minimum(x, y), np.maximum(x, y)
            open_ = low < high
            if not open_.any():
                break
            a, b = a[open_], b[open_]
            np.minimum.at(label, high[open_], low[open_])
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def _bucket_links(radius: int):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (key, i, j, side, Gray rank); a bucket's rows can span batches."""
        held: list[pa.RecordBatch] = []

        def work(table: pa.Table) -> Iterator[pa.RecordBatch]:
            key, i, j, side = (table[c].to_numpy() for c in ("key", "i", "j", "side"))
            codes = table["code"].to_numpy().view(np.uint64)
            bucket = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))))
            segment = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]) | (side[1:] != side[:-1]))))
            first = np.searchsorted(segment, bucket)
            many = np.diff(np.append(first, len(segment)))
            roots = np.where((i[bucket] == j[bucket]) | (many == 2), first, -1)
            other = np.where(i[bucket] == j[bucket], first, first + 1)
            ok = roots >= 0
            label = forest(len(codes), close_pairs(codes, segment, (roots[ok], other[ok]), radius))
            moved = np.flatnonzero(label != np.arange(len(codes)))
            if len(moved):
                signed = codes.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(signed[moved]), pa.array(signed[label[moved]])], ["a", "b"])

        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < 100_000:
                continue
            table = pa.Table.from_batches(held)
            key, i, j = (table[c].to_numpy() for c in ("key", "i", "j"))
            last = np.flatnonzero((key != key[-1]) | (i != i[-1]) | (j != j[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from work(table.slice(0, cut))
            held = table.slice(cut).to_batches()
        if held and sum(x.num_rows for x in held):
            yield from work(pa.Table.from_batches(held))

    return links


def linked(codes: DataFrame, *, radius: int = 4, bucket: int = 64, block: int = 2048) -> DataFrame:
    """Links (a, b) of a spanning forest per bucket over the distinct ``code`` of a table.

    Codes within ``radius`` bits end up connected, and no others. ``codes`` should be a written table: it is read twice.
    """
    masks = _blocks(radius, codes.count(), bucket)
    gray = gray_rank(F.col("code"))
    keyed = codes.select(
        "code",
        F.explode(F.array(*[F.struct(F.lit(m).alias("m"), F.col("code").bitwiseAND(F.lit(_signed(mask))).alias("bits")) for m, mask in enumerate(masks)])).alias("k"),
    ).select("code", F.xxhash64("k.m", "k.bits").alias("key"), F.col("k.m").alias("m"), F.col("k.bits").alias("bits"))
    # buckets above the block size, and how many parts each is cut into
    large = keyed.groupBy("m", "bits").agg(F.count("*").alias("n")).where(F.col("n") > block)
    large = materialize(large.select("m", "bits", F.ceil(F.col("n") / block).cast("int").alias("parts")), "large")
    keyed = keyed.join(large, ["m", "bits"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    # a hash of the code deals evenly whatever the codes share; order by Gray rank holds inside each part
    part = F.pmod(F.xxhash64("code"), F.col("parts")).cast("int")
    keyed = keyed.withColumn("part", part)
    pairs = F.when(F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda o: F.struct(F.least(o, F.col("part")).alias("i"), F.greatest(o, F.col("part")).alias("j"), (F.col("part") > o).cast("int").alias("side")),
        )
    )
    dealt = keyed.select("code", "key", F.explode(pairs).alias("p")).select("code", "key", "p.i", "p.j", "p.side")
    dealt = dealt.repartition("key", "i", "j").withColumn("rank", gray.bitwiseXOR(F.lit(_signed(1 << 63))))
    dealt = dealt.sortWithinPartitions("key", "i", "j", "side", "rank").select("key", "i", "j", "side", "code")
    return dealt.mapInArrow(_bucket_links(radius), "a bigint, b bigint")


def with_components(docs: DataFrame, fingerprint: str, into: str, *, doc_id: str = "doc_id", radius: int = 4, key: str | None = None) -> DataFrame:
    """``docs``, which should be a written table, with the smallest doc_id that links reach from each row.

    ``key``, if given, names a further column: a fingerprint that stands for the component, never null.
    """
    f, d = F.col(fingerprint), F.col(doc_id)
    codes = materialize(docs.groupBy(f.alias("code")).agg(F.min(d).alias("least")), "codes")
    roots = components(linked(codes, radius=radius))
    named = codes.join(roots.withColumnRenamed("node", "code"), "code")
    least = materialize(named.groupBy("root").agg(F.min("least").alias("lowest")), "lowest")
    far = roots.join(least, "root").select(F.col("node").alias("code"), F.col("root"), "lowest")
    # a component without any id stays null, so the root tells whether there are links
    lowest = F.when(F.col("root").isNotNull(), F.col("lowest")).otherwise(F.col("least"))
    named = codes.join(far, "code", "left").select(F.col("code").alias("_code"), F.coalesce("root", "code").alias("_root"), lowest.alias("_lowest"))
    named = materialize(named, "named")
    columns = [F.col(f"_d.`{c}`") for c in docs.columns] + ([F.col("_root").alias(key)] if key else [])
    return docs.select(F.struct("*").alias("_d"), f.alias("_code")).join(named, "_code").select(*columns, F.col("_lowest").alias(into))
