"""Packing by shortest-pack-first over the histogram of lengths.

1. ``pieces``: each document's ids are cut into full pieces of ``limit`` tokens and a rest.
2. ``pack_histogram``: lengths are placed longest first, each into the open packing patterns with the
   most room, and only the counts of patterns are kept. The driver sees the histogram (``limit``
   numbers) and the patterns, never the pieces.
3. ``pack``: pieces are ranked within their length and the patterns' places joined back by rank.

Ranks come from counts in parts: a length that a third of all pieces share is dealt over many tasks.

Defined results: a null text counts as empty (one token, its end id); repeated rows and doc_ids are packed
each by itself; no rows give no rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.scratch import materialize, small_batches
from loamline.llm.text import slices
from loamline.llm.tokens import encoder

LIMIT = 2048
#: Pieces of one length and part that one task ranks, about.
PER_PART = 1_000_000
LEAST_PARTS = 64


def pieces(docs: DataFrame, tokenizer: str, *, limit: int = LIMIT, end: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, row) per piece; ``row`` tells repeated documents apart."""
    kind = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, row bigint"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = 0
            for part in slices(batch.column("text")):
                offsets, ids = encode.encode(pc.fill_null(part, ""), end)
                ids = ids.astype("<u4")
                size = np.diff(offsets)
                n = (size + limit - 1) // limit
                owner = np.repeat(np.arange(len(size)), n)
                start = (np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)) * limit
                length = np.minimum(limit, size[owner] - start)
                from_ = offsets[owner] + start
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(from_.tolist(), (from_ + length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(at, len(part)).take(pa.array(owner)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                        pa.array(size[owner]), pa.array(row + owner),
                    ],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"],
                )
                at += len(part)
                row += len(part)

    small_batches(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(cut, kind)


def pack_histogram(histogram: np.ndarray, limit: int = LIMIT) -> list[tuple[int, tuple[tuple[int, int], ...]]]:
    """Patterns (how many packs, ((length, times), ...)) that place histogram[length] pieces of each length.

    Longest lengths first; a length goes into the open packs with the most room that hold it, as often as
    it fits there but evenly over the packs, and opens new packs for what is left.
    """
    open_: dict[int, list] = defaultdict(list)  # room -> [packs, pattern]
    done = []
    for length in range(limit, 0, -1):
        left = int(histogram[length])
        while left:
            room = max((r for r in open_ if r >= length), default=0)
            if not room:
                per = limit // length
                # pieces up to half the limit share new packs at once
                packs, rest = divmod(left, per)
                for n, times in ((packs, per), (1 if rest else 0, rest)):
                    if n:
                        _put(open_, done, limit - times * length, n, ((length, times),))
                break
            packs, pattern = open_[room].pop()
            if not open_[room]:
                del open_[room]
            if left >= packs:
                times = min(room // length, left // packs)
                _put(open_, done, room - times * length, packs, (*pattern, (length, times)))
                left -= times * packs
            else:
                _put(open_, done, room, packs - left, pattern)
                _put(open_, done, room - length, left, (*pattern, (length, 1)))
                left = 0
    return done + [x for group in open_.values() for x in map(tuple, group)]


def _put(open_: dict, done: list, room: int, packs: int, pattern: tuple) -> None:
    if room:
        open_[room].append([packs, pattern])
    else:
        done.append((packs, pattern))


def places(patterns: list[tuple[int, tuple[tuple[int, int], ...]]]) -> dict[str, np.ndarray]:
    """Where the pieces of each length go, by rank: rows sorted by (length, rank)."""
    rows, first, rank = [], 0, defaultdict(int)
    for packs, pattern in patterns:
        offset = 0
        for length, times in pattern:
            rows.append((length, rank[length], first, offset, times))
            rank[length] += packs * times
            offset += length * times
        first += packs
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "sequence", "offset", "times"), table.T, strict=True))


def pack(cut: DataFrame, *, limit: int = LIMIT) -> DataFrame:
    """``cut``, a written table of pieces, with sequence_id and offset for each piece."""
    counted = cut.groupBy("length").agg(F.count("*").alias("n")).collect()  # at most ``limit`` rows
    histogram = np.zeros(limit + 1, np.int64)
    for x in counted:
        histogram[x["length"]] = x["n"]
    table = places(pack_histogram(histogram, limit))
    parts = max(LEAST_PARTS, int(histogram.max() // PER_PART) + 1)

    keyed = cut.withColumn("part", F.pmod(F.xxhash64("row", "start"), F.lit(parts)))
    sizes = keyed.groupBy("length", "part").agg(F.count("*").alias("n"))
    order = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("length").alias("_length"), F.col("part").alias("_part"), F.coalesce(F.sum("n").over(order), F.lit(0)).alias("_before"))
    sizes = materialize(sizes, "ranks")
    number = F.row_number().over(Window.partitionBy("length", "part").orderBy("row", "start"))
    ranked = keyed.withColumn("_n", number).join(sizes, (F.col("length") == F.col("_length")) & (F.col("part") == F.col("_part")))
    ranked = ranked.withColumn("_rank", F.col("_before") + F.col("_n") - 1)

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        size, at = length.to_numpy(), rank.to_numpy()
        # the last row of the same length whose first rank is not above; rows are sorted by both
        big = np.int64(1) << np.int64(48)
        row = np.searchsorted(table["length"] * big + table["rank"], size * big + at, "right") - 1
        inner = at - table["rank"][row]
        times = table["times"][row]
        sequence = table["sequence"][row] + inner // times
        offset = table["offset"][row] + inner % times * size
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    placed = ranked.withColumn("_p", place("length", "_rank"))
    return placed.select(*[c for c in cut.columns], "_p.sequence_id", "_p.offset")
