"""Token-id files with Elias-Fano encoded document boundaries.

A shard file holds the ids of consecutive documents (ascending doc_id) as one array. Where documents end is
a non-decreasing sequence, kept in Elias-Fano form: low bits packed, high bits as unary gaps in
a bit vector, with a sampled select table, about 2 + log2(tokens / documents) bits a document in place of 64.

File layout, little-endian: magic ``LOAMTOK1``; header of eight unsigned 64-bit integers (documents, tokens,
bytes of an id, low bits, words of high bits, words of low bits, select samples, first start);
high words; low words; select samples (64-bit); doc_ids (64-bit, and a bit of nulls each, padded to bytes); ids.

Defined results: a null text counts as empty (its end id only); a null doc_id sorts first; ties of
doc_id stand in order of the text's hash; repeated rows are all written; no rows write no shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.scratch import small_batches
from loamline.llm.text import numbers, slices
from loamline.llm.tokens import encoder
from loamline.sources.shared import workspace

MAGIC = b"LOAMTOK1"
_HEAD = struct.Struct("<8Q")
#: A select sample for every so many documents.
SAMPLE = 64
#: Bytes of text that a shard holds, about.
SHARD_BYTES = 32 << 20
#: Documents whose bounds are decoded at once, and tokens that are read at once unless a document has more.
BLOCK, TOKENS = 4096, 500_000


@dataclass
class EliasFano:
    """A non-decreasing sequence of integers below ``universe``; ``select(k)`` gives the k-th."""

    n: int
    low_bits: int
    high: np.ndarray
    low: np.ndarray
    samples: np.ndarray

    @classmethod
    def encode(cls, values: np.ndarray, universe: int) -> EliasFano:
        n = len(values)
        low_bits = max(0, (max(universe, 1) // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        bits = np.zeros((int(at[-1]) // 64 + 1) * 64 if n else 0, np.uint8)
        bits[at] = 1
        high = np.packbits(bits, bitorder="little").view(np.uint64)
        rest = values & np.uint64((1 << low_bits) - 1)
        flat = ((rest[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
        flat = np.concatenate((flat, np.zeros(-len(flat) % 64, np.uint8)))
        low = np.packbits(flat, bitorder="little").view(np.uint64)
        return cls(n, low_bits, high, low, at[::SAMPLE].astype(np.uint64))

    def _low(self, k: int) -> int:
        if not self.low_bits:
            return 0
        at, end = k * self.low_bits, (k + 1) * self.low_bits
        word = int(self.low[at // 64]) | (int(self.low[at // 64 + 1]) << 64 if (end - 1) // 64 > at // 64 else 0)
        return (word >> (at % 64)) & ((1 << self.low_bits) - 1)

    def select(self, k: int) -> int:
        """The k-th value: from the nearest sample on, skip whole words by their number of ones."""
        at = int(self.samples[k // SAMPLE])
        left = k % SAMPLE
        word = at // 64
        now = int(self.high[word]) >> (at % 64) << (at % 64)
        while left >= now.bit_count():
            left -= now.bit_count()
            word += 1
            now = int(self.high[word])
        for _ in range(left):
            now &= now - 1
        place = word * 64 + (now & -now).bit_length() - 1
        return ((place - k) << self.low_bits) | self._low(k)

    def select_block(self, first: int, last: int) -> np.ndarray:
        """The values from ``first`` to before ``last``: from the sample before, only the words that hold these ones are unpacked."""
        first, last = max(0, first), min(last, self.n)
        if first >= last:
            return np.zeros(0, np.int64)
        word = int(self.samples[first // SAMPLE]) // 64
        after = (last - 1) // SAMPLE + 1
        end = int(self.samples[after]) // 64 + 1 if after < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[word:end].view(np.uint8), bitorder="little")) + word * 64
        # the sampled one is the first at or after its place; ones before it in its word belong to earlier values
        at = int(np.searchsorted(ones, int(self.samples[first // SAMPLE]))) + first % SAMPLE
        k = np.arange(first, last)
        out = (ones[at : at + last - first] - k).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits:
            place = k.astype(np.uint64) * np.uint64(self.low_bits)
            word, shift = (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)
            low = self.low[word] >> shift
            over = shift + np.uint64(self.low_bits) > np.uint64(64)
            low[over] |= self.low[word[over] + 1] << (np.uint64(64) - shift[over])
            out |= low & np.uint64((1 << self.low_bits) - 1)
        return out.astype(np.int64)


def shard_head(doc_ids: np.ndarray, known: np.ndarray, ends: np.ndarray, width: int) -> bytes:
    """All of a shard file but its ids; ``known`` tells which doc_ids are not null."""
    n, tokens = len(doc_ids), int(ends[-1]) if len(ends) else 0
    ef = EliasFano.encode(ends, tokens + 1)
    head = _HEAD.pack(n, tokens, width, ef.low_bits, len(ef.high), len(ef.low), len(ef.samples), 0)
    given = np.packbits(known.astype(np.uint8), bitorder="little").tobytes()
    return MAGIC + head + ef.high.tobytes() + ef.low.tobytes() + ef.samples.tobytes() + doc_ids.astype("<i8").tobytes() + given


class Shard:
    """Random and sequential access to a shard file."""

    def __init__(self, file) -> None:
        self.file = file
        if file.read(8) != MAGIC:
            raise ValueError("not a token shard")
        n, self.tokens, self.width, low_bits, high, low, samples, _ = _HEAD.unpack(file.read(_HEAD.size))
        part = lambda k, kind=np.uint64: np.frombuffer(file.read(k * np.dtype(kind).itemsize), kind)
        self.ends = EliasFano(n, low_bits, part(high), part(low), part(samples))
        self.doc_ids = part(n, np.int64)
        self.known = np.unpackbits(np.frombuffer(file.read((n + 7) // 8), np.uint8), bitorder="little")[:n].astype(bool)
        self.data = 8 + _HEAD.size + 8 * (high + low + samples + n) + (n + 7) // 8
        self.dtype = np.dtype(f"<u{self.width}")

    def bounds(self, k: int) -> tuple[int, int]:
        """Start and end of document ``k``."""
        return (self.ends.select(k - 1) if k else 0), self.ends.select(k)

    def cuts(self, first: int, last: int) -> np.ndarray:
        """Where the documents from ``first`` to before ``last`` begin, and where the last of them ends."""
        before = self.ends.select(first - 1) if first else 0
        return np.concatenate(([before], self.ends.select_block(first, last)))

    def ids(self, start: int, end: int) -> np.ndarray:
        self.file.seek(self.data + start * self.width)
        return np.frombuffer(self.file.read((end - start) * self.width), self.dtype)


def _open(uri: str):
    """The file system and path of a folder's URI, under the names that Spark's readers use, too."""
    kind, mark, rest = uri.partition("://")
    return fs.FileSystem.from_uri({"s3a": "s3", "s3n": "s3", "abfss": "abfs", "wasbs": "abfs"}.get(kind, kind) + mark + rest)


def write_token_files(docs: DataFrame, tokenizer: str, folder: str | None = None, *, end: int = 1, doc_id: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode every whole text and write shards of about ``shard_bytes`` of text in ascending doc_id order; returns the manifest.

    The manifest (shard, path, documents, tokens) names the files of the attempts that succeeded: a
    lost executor's half-written file is named by no row. Shards are ordered by ``shard``. Rows that repeat both doc_id
    and text stand in one shard, which streams through its task.
    """
    spark = docs.sparkSession
    small_batches(spark)
    root = folder or workspace(spark, "tokens")
    ordered = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    size = ordered.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n")).first()
    shards = max(1, ((size["bytes"] or 0) + 8 * size["n"]) // shard_bytes + 1)
    keys = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ordered = ordered.repartitionByRange(shards, *keys).sortWithinPartitions(*keys)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(tokenizer)
        system, base = _open(root)
        shard = TaskContext.get().partitionId()
        name = f"{base}/part-{shard:06d}-{uuid.uuid4().hex}"
        system.create_dir(base, recursive=True)
        ids, known, ends, total, width = [], [], [], 0, np.dtype(encode.dtype).itemsize
        # the head stands before the ids but is known after them: ids go to a file of their own first
        with system.open_output_stream(name + ".ids") as out:
            for batch in batches:
                at = 0
                for part in slices(batch.column("text")):
                    offsets, found = encode.encode(pc.fill_null(part, ""), end)
                    out.write(found.astype(f"<u{width}").tobytes())
                    ends.append(total + offsets[1:])
                    own = batch.column("id").slice(at, len(part))
                    ids.append(numbers(pc.fill_null(own, 0)))
                    known.append(pc.is_valid(own).to_numpy(zero_copy_only=False))
                    at += len(part)
                    total += len(found)
        if ids:
            with system.open_output_stream(name + ".tok") as out, system.open_input_stream(name + ".ids") as back:
                out.write(shard_head(np.concatenate(ids), np.concatenate(known), np.concatenate(ends), width))
                while block := back.read(4 << 20):
                    out.write(block)
            row = {"shard": [shard], "path": [f"{root}/{name.rsplit('/', 1)[1]}.tok"], "documents": [sum(map(len, ids))], "tokens": [total]}
            yield pa.RecordBatch.from_pydict(row)
        system.delete_file(name + ".ids")

    written = ordered.mapInArrow(write, "shard bigint, path string, documents bigint, tokens bigint")
    manifest = workspace(spark, "manifest")
    written.write.parquet(manifest)
    return spark.read.schema(written.schema).parquet(manifest)


def read_token_files(manifest: DataFrame, *, with_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document, from the shard files; ``ids`` only if asked for.

    A shard's start is the sum of the tokens of those before it, over one row per shard, and each file gets a task. Where
    documents begin and end comes from select, a block of documents at a time.
    """
    before = F.sum("tokens").over(Window.partitionBy(F.lit(0)).orderBy("shard", "path").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("path", F.coalesce(before, F.lit(0)).alias("start")).repartition(max(1, manifest.count()), "path")
    kind = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                system, name = _open(path)
                with system.open_input_file(name) as file:
                    shard = Shard(file)
                    for block in range(0, shard.ends.n, BLOCK):
                        cuts = shard.cuts(block, min(block + BLOCK, shard.ends.n))
                        at = 0
                        while at + 1 < len(cuts):
                            to = max(at + 1, int(np.searchsorted(cuts, cuts[at] + TOKENS, "right")) - 1)
                            ids = shard.ids(int(cuts[at]), int(cuts[to])).astype("<u4")
                            own = cuts[at : to + 1] - cuts[at]
                            crc = [zlib.crc32(ids[a:b]) for a, b in zip(own[:-1].tolist(), own[1:].tolist(), strict=True)]
                            docs = slice(block + at, block + to)
                            columns = {
                                "doc_id": pa.array(shard.doc_ids[docs], pa.int64(), mask=~shard.known[docs]), "start": pa.array(first + cuts[at:to]), "n_tokens": pa.array(np.diff(own)), "ids_crc32": pa.array(crc, pa.int64()),
                            }
                            if with_ids:
                                columns["ids"] = pa.ListArray.from_arrays(pa.array(own, pa.int32()), pa.array(ids, pa.int64()))
                            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
                            at = to

    return files.mapInArrow(read, kind)
