"""LM scoring: the likelihood of a text over all its segmentations into known subwords.

The pieces and their first weights come from an existing vocabulary; expectation maximisation over the
training words of the whole corpus refines the weights. A word's probability is the sum over
all ways to cut it into pieces, by forward recursion in log space; a text's is the product over its words and an end.
Pieces are byte strings and every single byte is a piece, so each text has a probability.
Very long words are taken place by place, in time that grows with their length.

Texts are read once, in chunks of a few megabytes. A chunk keeps each of its distinct words once; words
of all chunks meet in one shuffle that counts them and takes them to the model, and
the answers go back to their chunk, so a frequent word costs one row a chunk, not one a document. The rows of
the commonest words, which a sample of chunks tells, do not meet: their counts are summed where they stand, their answers
are broadcast. What the sample misses goes the way of all words, so it decides on time alone.

Defined results: a null text counts as empty, it holds the end only; a null doc_id counts as the
empty id when documents are held out; repeated rows and doc_ids are scored each by itself; without
training documents all counts are 0 and weights stay the vocabulary's; no rows give no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loamline.llm.scratch import materialize
from loamline.llm.text import lower_ascii, slices, words_of

_BASE = np.uint64(0x9E3779B97F4A7C55)
_FILTER_BITS = 20
#: Words that one call of the recursion works on.
WORDS = 200_000
#: Bytes beyond which a word is taken by itself, its places one after another.
LONG = 64


def vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces of a sentencepiece file as bytes, a space for the word mark, and weights from their scores.

    Scores that are ranks (of merges) are read as Zipf's law; every single byte is added.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    weight: dict[bytes, float] = {}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        piece = bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
        weight[piece] = max(weight.get(piece, 0.0), 1 / (2.7 + max(0.0, -model.get_score(i))))
    least = min(weight.values(), default=1.0)
    for b in range(256):
        weight.setdefault(bytes([b]), least)
    pieces = sorted(weight)
    return pieces, np.array([weight[p] for p in pieces])


def _hashes(data: np.ndarray) -> np.ndarray:
    """Prefix hashes of rows of bytes: column j covers the first j bytes."""
    out = np.zeros((data.shape[0], data.shape[1] + 1), np.uint64)
    for j in range(data.shape[1]):
        out[:, j + 1] = out[:, j] * _BASE + data[:, j] + np.uint64(1)
    return out


@dataclass
class Lattice:
    """Log probabilities of pieces, and where each piece is found by the hash of its bytes."""

    keys: np.ndarray  # sorted hashes
    ids: np.ndarray  # the piece of each key
    seen: np.ndarray  # a filter over the hashes' leading bits
    powers: np.ndarray
    longest: int
    logp: np.ndarray
    log_end: float

    @classmethod
    def build(cls, pieces: list[bytes], weight: np.ndarray, end: float) -> Lattice:
        longest = max(map(len, pieces))
        hashes = np.empty(len(pieces), np.uint64)
        for size in range(1, longest + 1):
            of = [i for i, p in enumerate(pieces) if len(p) == size]
            if of:
                hashes[of] = _hashes(np.array([list(pieces[i]) for i in of], np.uint64))[:, -1]
        order = np.argsort(hashes)
        if len(np.unique(hashes)) < len(hashes):
            raise ValueError("two pieces share a hash")
        seen = np.zeros(1 << _FILTER_BITS, bool)
        seen[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        powers = np.ones(longest + 1, np.uint64)
        for k in range(longest):  # on arrays, where 64-bit products wrap
            powers[k + 1 :] *= _BASE
        total = weight.sum() + end
        return cls(hashes[order], order, seen, powers, longest, np.log(weight / total), float(np.log(max(end, 1e-300) / total)))

    def _edges(self, data: np.ndarray) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
        """(from, to) -> rows that have a piece there, and the piece."""
        h = _hashes(data)
        found = {}
        for j in range(1, data.shape[1] + 1):
            for i in range(max(0, j - self.longest), j):
                x = h[:, j] - h[:, i] * self.powers[j - i]
                row = np.flatnonzero(self.seen[(x >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
                if len(row):
                    at = np.minimum(np.searchsorted(self.keys, x[row]), len(self.keys) - 1)
                    ok = self.keys[at] == x[row]
                    if ok.any():
                        found[i, j] = (row[ok], self.ids[at[ok]])
        return found

    def _forward(self, edges: dict, n: int, size: int) -> np.ndarray:
        alpha = np.full((n, size + 1), -np.inf)
        alpha[:, 0] = 0
        for j in range(1, size + 1):
            parts = [(i, *edges[i, j]) for i in range(max(0, j - self.longest), j) if (i, j) in edges]
            terms = np.full((n, len(parts)), -np.inf)
            for k, (i, row, piece) in enumerate(parts):
                terms[row, k] = alpha[row, i] + self.logp[piece]
            top = terms.max(axis=1)
            alpha[:, j] = top + np.log(np.exp(terms - top[:, None]).sum(axis=1))
        return alpha

    def _long_edges(self, word: bytes) -> list[list[tuple[int, int]]]:
        """For each place of one long word the (from, piece) of the pieces that end there."""
        data = np.frombuffer(b" " + word, np.uint8)
        h = np.zeros(len(data) + 1, np.uint64)
        at, base = 0, int(_BASE)
        for j, b in enumerate(data.tolist()):
            at = (at * base + b + 1) & 0xFFFFFFFFFFFFFFFF
            h[j + 1] = at
        ends: list[list[tuple[int, int]]] = [[] for _ in range(len(data) + 1)]
        for k in range(1, min(self.longest, len(data)) + 1):
            x = h[k:] - h[:-k] * self.powers[k]
            row = np.flatnonzero(self.seen[(x >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
            if len(row):
                place = np.minimum(np.searchsorted(self.keys, x[row]), len(self.keys) - 1)
                ok = self.keys[place] == x[row]
                for i, piece in zip(row[ok].tolist(), self.ids[place[ok]].tolist(), strict=True):
                    ends[i + k].append((i, piece))
        return ends

    def _long_forward(self, ends: list[list[tuple[int, int]]]) -> list[float]:
        alpha, logp = [0.0], self.logp.tolist()
        for found in ends[1:]:
            terms = [alpha[i] + logp[piece] for i, piece in found]
            top = max(terms)
            alpha.append(top + math.log(sum(math.exp(t - top) for t in terms)))
        return alpha

    def _long_expected(self, word: bytes, count: float, total: np.ndarray) -> None:
        ends = self._long_edges(word)
        alpha, logp, size = self._long_forward(ends), self.logp.tolist(), len(ends) - 1
        beta = [-math.inf] * size + [0.0]
        for j in range(size, 0, -1):  # beta[j] is final once all later places are done
            for i, piece in ends[j]:
                term = logp[piece] + beta[j]
                total[piece] += count * math.exp(min(0.0, alpha[i] + term - alpha[size]))
                high, low = max(beta[i], term), min(beta[i], term)
                beta[i] = high + math.log1p(math.exp(low - high))

    @staticmethod
    def _by_size(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Words of equal size as rows of bytes behind the word mark, and their places."""
        sizes = np.array([len(w) for w in words])
        for size in np.unique(sizes[sizes <= LONG]):
            rows = np.flatnonzero(sizes == size)
            data = np.frombuffer(b"".join(words[i] for i in rows), np.uint8).reshape(len(rows), size)
            yield rows, np.concatenate((np.full((len(rows), 1), 32, np.uint8), data), axis=1).astype(np.uint64)

    def log_marginals(self, words: list[bytes]) -> np.ndarray:
        """The log probability of each word, over all its segmentations."""
        out = np.zeros(len(words))
        for rows, data in self._by_size(words):
            out[rows] = self._forward(self._edges(data), len(rows), data.shape[1])[:, -1]
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self._long_forward(self._long_edges(w))[-1]
        return out

    def expected(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """How often each piece is used in the words, in expectation over segmentations."""
        total = np.zeros(len(self.logp))
        for rows, data in self._by_size(words):
            n, size = len(rows), data.shape[1]
            edges = self._edges(data)
            alpha = self._forward(edges, n, size)
            beta = np.full((n, size + 1), -np.inf)
            beta[:, size] = 0
            for i in range(size - 1, -1, -1):
                parts = [(j, *edges[i, j]) for j in range(i + 1, min(size, i + self.longest) + 1) if (i, j) in edges]
                if not parts:
                    continue
                terms = np.full((n, len(parts)), -np.inf)
                for k, (j, row, piece) in enumerate(parts):
                    terms[row, k] = self.logp[piece] + beta[row, j]
                    share = np.exp(alpha[row, i] + terms[row, k] - alpha[row, size]) * counts[rows[row]]
                    total += np.bincount(piece, share, len(total))
                top = terms.max(axis=1)
                safe = np.where(np.isfinite(top), top, 0)
                with np.errstate(divide="ignore"):
                    beta[:, i] = safe + np.log(np.exp(terms - safe[:, None]).sum(axis=1))
        for w, count in zip(words, counts, strict=True):
            if len(w) > LONG:
                self._long_expected(w, float(count), total)
        return total


def chunked(docs: DataFrame, held_out: Column, *, doc_id: str, text: str) -> DataFrame:
    """A row per few megabytes of text: its distinct words, training counts, and words by document."""
    kind = "chunk bigint, words array<string>, train array<bigint>, doc_id array<bigint>, held array<boolean>, n_words array<bigint>, starts binary, word binary, times binary"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            for part in slices(batch.column("text")):
                w = words_of(lower_ascii(pc.fill_null(part, "")))
                n, names = len(part), len(w.names)
                held = batch.column("held").slice(at, n).to_numpy(zero_copy_only=False).astype(bool)
                pair, times = np.unique(w.owners() * max(names, 1) + w.ids, return_counts=True)
                owner, word = pair // max(names, 1), pair % max(names, 1)
                learn = ~held[owner]
                train = np.bincount(word[learn], times[learn], names).astype(np.int64)
                starts = np.searchsorted(owner, np.arange(n + 1)).astype("<i4")
                row = {
                    "chunk": [chunk], "words": [w.names.cast(pa.string())], "train": [train], "doc_id": [batch.column("doc_id").slice(at, n)], "held": [held], "n_words": [w.counts],
                    "starts": [starts.tobytes()], "word": [word.astype("<u4").tobytes()], "times": [times.astype("<u4").tobytes()],
                }
                yield pa.RecordBatch.from_pydict({k: pa.array([v[0].to_pylist()] if isinstance(v[0], pa.Array) else v, _KINDS[k]) for k, v in row.items()})
                at += n
                chunk += 1

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), held_out.alias("held"))
    return rows.mapInArrow(build, kind)


_KINDS = {
    "chunk": pa.int64(), "words": pa.list_(pa.string()), "train": pa.list_(pa.int64()), "doc_id": pa.list_(pa.int64()), "held": pa.list_(pa.bool_()),
    "n_words": pa.list_(pa.int64()), "starts": pa.binary(), "word": pa.binary(), "times": pa.binary(),
}


def _in_bulk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= WORDS:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def fit(words: DataFrame, ends: int, path: str, *, rounds: int = 2) -> Lattice:
    """Piece weights after ``rounds`` of expectation maximisation over (word, c); ``ends`` texts ended.

    The driver gets one number per piece of the vocabulary a round.
    """
    pieces, weight = vocabulary(path)
    lattice = Lattice.build(pieces, weight, 0.05 * weight.sum())
    single = np.array([len(p) == 1 for p in pieces])
    for _ in range(rounds):

        def expect(batches: Iterator[pa.RecordBatch], lattice=lattice) -> Iterator[pa.RecordBatch]:
            total = np.zeros(len(lattice.logp))
            for t in _in_bulk(batches):
                total += lattice.expected(t["word"].cast(pa.binary()).to_pylist(), t["c"].to_numpy())
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "uses"])

        rows = words.mapInArrow(expect, "piece bigint, uses double").groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
        if not rows:
            break
        uses = np.where(single, 0.5, 0.01)
        for x in rows:
            uses[x["piece"]] += x["uses"]
        lattice = Lattice.build(pieces, uses, ends + 0.5)
    return lattice


def hot_words(chunks: DataFrame, least: int, *, sample: int = 256, most: int = 100_000) -> DataFrame:
    """(word): those in at least ``least`` of up to ``sample`` chunks of smallest hash, the ``most`` commonest of them, none of over 64 bytes."""
    ids = [x[0] for x in chunks.select("chunk").orderBy(F.xxhash64("chunk"), "chunk").limit(sample).collect()]
    seen = chunks.where(F.col("chunk").isin(ids)).select(F.explode("words").alias("word")).where(F.octet_length("word") <= LONG)
    return seen.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "word").limit(most).select("word")


def scored(docs: DataFrame, held_out: Column, path: str, *, doc_id: str = "doc_id", text: str = "text", rounds: int = 2, hot: int = 16) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every document.

    Training documents are those that are not held out. base_score is the smoothed word
    unigram, score the lattice's marginal, both log10. hot: in how many of 256 chunks a word must stand for
    its rows to be counted where they are; at most 100,000 words of 64 bytes are.
    """
    chunks = materialize(chunked(docs, held_out, doc_id=doc_id, text=text), "chunks")
    learned = F.aggregate(F.arrays_zip("held", "n_words"), F.lit(0).cast("long"), lambda a, x: a + F.when(x["held"], F.lit(0)).otherwise(x["n_words"] + 1))
    totals = chunks.agg(F.sum(learned).alias("n"), F.sum(F.size(F.filter("held", lambda x: ~x))).alias("ends")).first()
    n_all, ends = totals["n"] or 0, totals["ends"] or 0

    listed = chunks.select("chunk", F.posexplode(F.arrays_zip("words", "train")).alias("pos", "x")).select(F.col("x.words").alias("word"), "chunk", "pos", F.col("x.train").alias("train"))
    common = F.broadcast(materialize(hot_words(chunks, hot), "hot"))  # at most 100,000 words
    summed = materialize(listed.join(common, "word").groupBy("word").agg(F.sum("train").alias("c")), "summed")
    same = Window.partitionBy("word")
    met = listed.join(common, "word", "left_anti").select("word", "chunk", "pos", F.sum("train").over(same).alias("c"), (F.min("chunk").over(same) == F.col("chunk")).alias("first"))
    met = materialize(met, "words")
    known = met.where("first AND c > 0").select("word", "c").unionByName(summed.where("c > 0"))
    v = known.count() + (1 if ends else 0)
    lattice = fit(known, ends, path, rounds=rounds)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _in_bulk(batches):
            coded = t["word"].combine_chunks().dictionary_encode()
            coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
            value = lattice.log_marginals(coded.dictionary.cast(pa.binary()).to_pylist())[coded.indices.to_numpy()]
            columns = {c: t[c].combine_chunks() for c in t.column_names if c != "word" or "chunk" not in t.column_names}
            columns = {k: x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x for k, x in columns.items()}
            yield pa.RecordBatch.from_pydict(columns | {"value": pa.array(value)})

    answers = met.select("word", "chunk", "pos", "c").mapInArrow(answer, "chunk bigint, pos int, c bigint, value double")
    of_common = F.broadcast(materialize(summed.mapInArrow(answer, "word string, c bigint, value double"), "values"))  # as many words
    answers = answers.unionByName(listed.join(of_common, "word").select("chunk", "pos", "c", "value"))
    floor = float(np.log10(n_all + 0.5 * (v + 1)))
    end_base, end_value = float(np.log10(ends + 0.5)), lattice.log_end

    def add(chunk: pa.Table, found: pa.Table) -> pa.Table:
        count = found["c"].to_numpy()
        place = found["pos"].to_numpy()
        base, value, is_known = np.zeros(len(place)), np.zeros(len(place)), np.zeros(len(place))
        base[place], value[place], is_known[place] = np.log10(count + 0.5), found["value"].to_numpy(), count > 0
        ids, held, n_words, n_known, base_score, score = [], [], [], [], [], []
        for row in chunk.to_pylist():
            starts, word, times = np.frombuffer(row["starts"], "<i4"), np.frombuffer(row["word"], "<u4"), np.frombuffer(row["times"], "<u4").astype(np.int64)
            of = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
            total = lambda x, of=of, word=word, times=times, m=len(starts) - 1: np.bincount(of, x[word] * times, m)
            ids += row["doc_id"]
            held += row["held"]
            n_words += row["n_words"]
            n_known.append(total(is_known))
            base_score.append(total(base))
            score.append(total(value))
        tokens = np.array(n_words, np.int64) + 1
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0)
        return pa.table(
            {
                "doc_id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_()), "n_tokens": tokens, "n_known": join(n_known).round().astype(np.int64) + (ends > 0),
                "train_tokens": np.full(len(tokens), n_all, np.int64), "base_score": join(base_score) + end_base - tokens * floor, "score": (join(score) + end_value) / np.log(10),
            }
        )

    kind = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    blobs = chunks.select("chunk", "doc_id", "held", "n_words", "starts", "word", "times")
    return blobs.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(add, kind)
