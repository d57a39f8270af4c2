"""Ranked lexical search: exact top-k inner products of impact vectors, by norm buckets.

A document is a sparse vector of integer impacts, one for each query term that it holds, and a query a vector of ones. Documents are
ordered by the length of their vectors and cut into buckets. For a query with k terms and a k-th best score so far, a
bucket whose longest vector is too short by Cauchy-Schwarz is left out, and with it all that follow. Inside a bucket coordinate bounds
tell which terms a document must hold at least one of; the scores over those, and the length of the rest, filter again.
Survivors are scored exactly, in integers.

The longest vectors of all tasks are searched first; the k-th best of their scores is where the search of the others starts.
Each task returns at most k rows a query. Queries are taken in blocks of bounded size, so what a task holds of them is bounded.

Defined results. A null or empty text has no terms, counts in no statistic and is never returned; a query without terms returns
nothing. Repeated document rows are ranked each by itself, repeated queries are answered each by itself. Equal scores go by
ascending doc_id, null ids last. Without documents or queries the result is empty.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.scratch import materialize
from loamline.llm.text import alnum_ascii, numbers, ragged, slices, words_of

#: Queries and bytes of query text in one block, unless one query is longer.
BLOCK_ITEMS, BLOCK_BYTES = 256, 1 << 20
#: Documents of a bucket at least, the ratio of lengths it spans beyond that, and documents that are bucketed together.
BUCKET_ROWS, BUCKET_RATIO, TOGETHER = 512, 1.3, 16384
#: The share of documents, longest vectors first, that is searched to find where the search of the others starts.
SEED_SHARE = 1 / 32
#: Levels of length in each doubling.
LEVELS = 8
_ORDER_LAST = 1 << 63


def _terms(text: pa.Array):
    """Terms of null-free texts: ASCII letters and digits and all beyond ASCII, A-Z lower-cased."""
    return words_of(alnum_ascii(text))


@dataclass(frozen=True)
class Block:
    """Some queries: their rows, their terms, and which terms (sorted codes) each one has."""

    rows: list[int]
    ids: list[int]
    terms: pa.Array
    offsets: np.ndarray
    codes: np.ndarray

    @staticmethod
    def of(rows: list[int], ids: list[int], texts: list[str]) -> Block:
        w = _terms(pa.array(texts, pa.string()))
        size = max(1, len(w.names))
        pairs = np.unique(w.owners().astype(np.int64) * size + w.ids)
        owner, code = pairs // size, pairs % size
        return Block(rows, ids, w.names.cast(pa.string()), np.searchsorted(owner, np.arange(len(rows) + 1)), code)


def blocks(queries: DataFrame, item_id: str, text: str) -> tuple[DataFrame, list[int]]:
    """``queries`` as a written table with their rows' numbers and blocks, and the numbers of the blocks."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = TaskContext.get().partitionId() << 33
        block, items, held = row, 0, 0
        for b in batches:
            sizes = numbers(pc.fill_null(pc.binary_length(b.column(1)), 0))
            of = []
            for size in sizes.tolist():
                if items and (items == BLOCK_ITEMS or held + size > BLOCK_BYTES):
                    block, items, held = block + 1, 0, 0
                items, held = items + 1, held + size
                of.append(block)
            at = pa.array(np.arange(row, row + len(sizes)), pa.int64())
            yield pa.RecordBatch.from_arrays([at, pa.array(of, pa.int64()), b.column(0), pc.fill_null(b.column(1), "")], names=["query", "block", "item_id", "text"])
            row += len(sizes)

    kind = queries.schema[item_id].dataType.simpleString()
    table = materialize(queries.select(item_id, F.col(text).cast("string")).mapInArrow(numbered, f"query long, block long, item_id {kind}, text string"), "items")
    return table, sorted(r[0] for r in table.select("block").distinct().toLocalIterator())


def term_vectors(docs: DataFrame, block: Block, doc_id: str, text: str) -> DataFrame:
    """(doc_id, n, codes, tf): all terms of each document, and how often it holds those of the block; in a written table."""
    vocabulary = block.terms

    @F.arrow_udf("struct<n:bigint,codes:array<int>,tf:array<bigint>>")
    def vector(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(texts):
            w = _terms(pc.fill_null(part, ""))
            code = pc.fill_null(pc.index_in(w.names.cast(pa.string()), value_set=vocabulary), -1).to_numpy(zero_copy_only=False).astype(np.int64)[w.ids]
            found = code >= 0
            size = max(1, len(vocabulary))
            pairs, tf = np.unique(w.owners()[found] * size + code[found], return_counts=True)
            offsets = pa.array(np.searchsorted(pairs // size, np.arange(len(part) + 1)), pa.int32())
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in ((pairs % size).astype(np.int32), tf.astype(np.int64))]
            out.append(pa.StructArray.from_arrays([pa.array(w.counts.astype(np.int64)), *lists], ["n", "codes", "tf"]))
        empty = pa.array([], pa.struct([("n", pa.int64()), ("codes", pa.list_(pa.int32())), ("tf", pa.list_(pa.int64()))]))
        return pa.concat_arrays(out) if out else empty

    rows = docs.select(F.col(doc_id).alias("doc_id"), vector(F.col(text)).alias("v"))
    return materialize(rows.select("doc_id", "v.n", "v.codes", "v.tf").where("n > 0"), "term vectors")


@dataclass(frozen=True)
class Statistics:
    """Documents with terms, their terms, and the weight of each term of a block."""

    documents: int
    terms: int
    weights: np.ndarray

    def impacts(self, n: np.ndarray, owner: np.ndarray, codes: np.ndarray, tf: np.ndarray) -> np.ndarray:
        """Integer impacts of the entries ``codes``, ``tf`` of documents ``owner`` with ``n`` terms."""
        scale = 90 * self.documents
        if int(n.max(initial=0)) * scale < 1 << 62:
            m = 10 + n * scale // self.terms
        else:
            m = np.array([10 + int(x) * scale // self.terms for x in n.tolist()], np.int64)
        return self.weights[codes] * (1_000_000_000 * tf // (1000 * tf + 8 * m[owner]))


def statistics(vectors: DataFrame, block: Block) -> Statistics:
    total = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(block.terms), np.int64)
    for code, count in vectors.select(F.explode("codes").alias("c")).groupBy("c").count().collect():  # one row a term of the block
        df[code] = count
    weight = [math.floor(1000 * math.log((2 * total[0] + 2) / (2 * x + 1))) for x in df.tolist()]
    return Statistics(int(total[0]), int(total[1]), np.array(weight, np.int64))


@dataclass
class Lists:
    """Sparse vectors of documents: row i has codes and impacts offsets[i]:offsets[i + 1]."""

    offsets: np.ndarray
    codes: np.ndarray
    impacts: np.ndarray
    length: np.ndarray
    doc: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch, stats: Statistics) -> Lists:
        codes, tf = batch.column("codes"), batch.column("tf")
        sizes = numbers(pc.list_value_length(codes))
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        owner = np.repeat(np.arange(len(sizes)), sizes)
        flat = numbers(codes.flatten())
        impacts = stats.impacts(numbers(batch.column("n")), owner, flat, numbers(tf.flatten()))
        length = np.sqrt(np.bincount(owner, impacts.astype(float) ** 2, len(sizes)))
        ids = batch.column("doc_id")
        known = np.array([_ORDER_LAST if x is None else x for x in ids.to_pylist()], object) if ids.null_count else numbers(ids)
        return Lists(offsets, flat, impacts, length, known)

    def take(self, rows: np.ndarray) -> Lists:
        sizes = np.diff(self.offsets)[rows]
        at = ragged(self.offsets[rows], sizes)
        return Lists(np.concatenate(([0], np.cumsum(sizes))), self.codes[at], self.impacts[at], self.length[rows], self.doc[rows])


class Bucket:
    """Documents of nearly equal length with their entries by term."""

    def __init__(self, docs: Lists, terms: int) -> None:
        self.docs, self.longest = docs, float(docs.length[0])
        self.rows = len(docs.length)
        owner = np.repeat(np.arange(self.rows), np.diff(docs.offsets))
        order = np.argsort(docs.codes, kind="stable")
        self.row, self.impact = owner[order], docs.impacts[order]
        self.at = np.searchsorted(docs.codes[order], np.arange(terms + 1))
        self.largest = np.zeros(terms, np.int64)
        np.maximum.at(self.largest, docs.codes, docs.impacts)

    def entries(self, codes: np.ndarray) -> np.ndarray:
        return ragged(self.at[codes], self.at[codes + 1] - self.at[codes])

    def survivors(self, codes: np.ndarray, least: int) -> np.ndarray:
        """Rows that may score ``least`` or more over the terms ``codes``."""
        codes = codes[self.largest[codes] > 0]
        # the terms with the smallest largest impacts cannot reach ``least`` by themselves: one of the others must be held
        by_size = codes[np.argsort(self.largest[codes], kind="stable")]
        reach = np.cumsum(self.largest[by_size])
        idle = int(np.searchsorted(reach, least, "left"))
        held = self.entries(by_size[idle:])
        rows, impact = self.row[held], self.impact[held].astype(float)
        partial = np.bincount(rows, impact, self.rows)
        met = np.bincount(rows, minlength=self.rows) > 0
        if not idle:
            return np.flatnonzero(met & (partial >= least))
        # what the idle terms may add: at most all of their largest impacts, and by Cauchy-Schwarz the length that is left
        left = np.sqrt(np.maximum(self.docs.length**2 - np.bincount(rows, impact**2, self.rows), 0)) * (1 + 1e-9) + 1
        more = np.minimum(float(reach[idle - 1]), math.sqrt(idle) * left)
        return np.flatnonzero(met & (partial + more >= least))

    def scores(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of ``rows`` over the terms marked in ``wanted``."""
        sizes = np.diff(self.docs.offsets)[rows]
        at = ragged(self.docs.offsets[rows], sizes)
        value = np.where(wanted[self.docs.codes[at]], self.docs.impacts[at], 0)
        total = np.concatenate(([0], np.cumsum(value)))
        ends = np.cumsum(sizes)
        return total[ends] - total[ends - sizes]


class Best:
    """The k best (score, doc_id) of each query so far; nothing below its start is taken."""

    def __init__(self, queries: int, k: int, least: list[int]) -> None:
        self.k, self.found = k, [[] for _ in range(queries)]
        self.least = list(least)

    def add(self, query: int, scores: np.ndarray, docs: np.ndarray) -> None:
        if len(scores) > 4 * self.k:  # ties at the k-th score stay
            edge = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, docs = scores[scores >= edge], docs[scores >= edge]
        listed = self.found[query] + list(zip((-scores).tolist(), docs.tolist(), strict=True))
        listed.sort()
        self.found[query] = listed[: self.k]
        if len(listed) >= self.k:
            self.least[query] = max(self.least[query], -self.found[query][-1][0])


def _search(lists: Lists, block: Block, best: Best) -> None:
    """Bring the documents of ``lists`` into ``best``."""
    order = np.argsort(-lists.length, kind="stable")
    order = order[lists.length[order] > 0]
    at = 0
    live = [q for q in range(len(block.rows)) if block.offsets[q + 1] > block.offsets[q]]
    terms = len(block.terms)
    marks = np.zeros(terms, bool)
    while at < len(order) and live:
        top = lists.length[order[at]]
        to = max(at + BUCKET_ROWS, int(np.searchsorted(-lists.length[order], -top / BUCKET_RATIO, "right")))
        bucket = Bucket(lists.take(order[at:to]), terms)
        still = []
        for q in live:
            codes = block.codes[block.offsets[q] : block.offsets[q + 1]]
            if math.sqrt(len(codes)) * bucket.longest * (1 + 1e-9) + 1 < best.least[q]:
                continue  # neither this bucket nor a later one
            still.append(q)
            rows = bucket.survivors(codes, best.least[q])
            if len(rows):
                marks[codes] = True
                scores = bucket.scores(rows, marks)
                marks[codes] = False
                good = scores >= best.least[q]
                if good.any():
                    best.add(q, scores[good], bucket.docs.doc[rows[good]])
        live, at = still, to


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches joined, so that buckets are worth their while."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows >= TOGETHER:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _level(length: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(length, 1)) * LEVELS).astype(np.int64)


def top(vectors: DataFrame, block: Block, stats: Statistics, k: int) -> DataFrame:
    """(query, doc_id, score) of the k best documents of each query of a block, and of few more."""

    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _gathered(batches):
            level, rows = np.unique(_level(Lists.of(b, stats).length), return_counts=True)
            yield pa.RecordBatch.from_pydict({"level": pa.array(level), "rows": pa.array(rows.astype(np.int64))})

    def search(low: int, high: int, least: list[int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            best = Best(len(block.rows), k, least)
            for b in _gathered(batches):
                lists = Lists.of(b, stats)
                level = _level(lists.length)
                _search(lists.take(np.flatnonzero((level >= low) & (level < high))), block, best)
            hits = [(block.rows[q], None if d == _ORDER_LAST else d, -s) for q, found in enumerate(best.found) for s, d in found if s < 0]
            columns = list(zip(*hits, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["query", "doc_id", "score"])

        return run

    # the longest vectors: a histogram of lengths has at most some hundred rows
    counts = {r[0]: r[1] for r in vectors.mapInArrow(levels, "level long, rows long").groupBy("level").agg(F.sum("rows")).collect()}
    cut, taken, enough = 0, 0, sum(counts.values()) * SEED_SHARE
    for level in sorted(counts, reverse=True):
        cut, taken = level, taken + counts[level]
        if taken >= max(enough, 4 * k):
            break
    kind = "query long, doc_id long, score long"
    end = 1 << 40
    seeds = materialize(best_of(vectors.mapInArrow(search(cut, end, [1] * len(block.rows)), kind), k), "seeds")
    start = dict(seeds.groupBy("query").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).select("query", "least").collect())  # one row a query of the block
    least = [max(1, start.get(row, 1)) for row in block.rows]
    rest = vectors.mapInArrow(search(0, cut, least), kind)
    return best_of(seeds.drop("rank").unionByName(rest), k)


def best_of(hits: DataFrame, k: int) -> DataFrame:
    """The k best of each query: within parts of its hits first, then of what those leave."""
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    part = F.pmod(F.xxhash64("doc_id", "score"), F.lit(32))
    few = hits.withColumn("part", part).withColumn("r", F.row_number().over(Window.partitionBy("query", "part").orderBy(*order))).where(F.col("r") <= k)
    return few.withColumn("rank", F.row_number().over(Window.partitionBy("query").orderBy(*order)).cast("int")).where(F.col("rank") <= k).select("query", "rank", "doc_id", "score")


def ranked(docs: DataFrame, queries: DataFrame, *, k: int = 10, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each query with a score above 0."""
    table, numbers_ = blocks(queries, item_id, text)
    out = None
    for number in numbers_:
        rows = table.where(F.col("block") == number).collect()  # at most BLOCK_ITEMS rows
        block = Block.of([r["query"] for r in rows], [r["item_id"] for r in rows], [r["text"] for r in rows])
        vectors = term_vectors(docs, block, doc_id, text)
        found = materialize(top(vectors, block, statistics(vectors, block), k), "found")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return table.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    return table.join(out, "query").select("item_id", "rank", "doc_id", "score")
