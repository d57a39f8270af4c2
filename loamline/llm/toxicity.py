"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of up to three rows of a hash table: of the word and of its first four and
five letters, so that inflected forms share rows. A bucket also keeps a tag of the feature that owns it, and
other features that fall into it count as unknown (zero). Filters of several widths run over
the words, max pooling takes each filter's largest response, and a logistic layer gives the score.
Thresholds are calibrated by language, where the language is told from the text's most frequent
words, never from a column; the score is shifted so that 0.5 is the text's threshold.

Embeddings and filters are learned from a bounded sample (``SAMPLE`` documents and ``SAMPLE_BYTES`` of each label), scoring covers every
whole text. ``fit`` calibrates on the held part of the sample; ``thresholds`` does so over all labelled rows.

Defined results: a null text counts as empty and gets the score of a text without words; repeated
rows get equal scores; no rows give no rows; other columns stay. Without labels of both kinds
every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.scratch import release_memory, small_batches
from loamline.llm.text import alnum_ascii, by_slices, mix64, ragged, words_of

#: Documents of each label that the classifier is trained on, at most: those of the smallest hashes.
SAMPLE = 2_000
#: Bytes of text of each label that it is trained on, at most: the sample ends before the text that would exceed them.
SAMPLE_BYTES = 24 << 20
#: A text of more than this part of a label's bytes is long.
LONG_SHARE = 32
BUCKETS = 1 << 17
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8

#: The most frequent short words by which a text's language is told.
FUNCTION_WORDS = {
    "en": "the of and to in is that it was for on are as with they be at this have from".split(),
    "fr": "le la les des et un une que qui dans pour pas sur avec est au par elle".split(),
    "de": "der die das und ist von den mit ein eine nicht sich auf dem zu im".split(),
    "es": "el los las del y que se por con una para su al es como lo".split(),
}
LANGUAGES = [*FUNCTION_WORDS, "other"]
#: Thresholds over a whole table lie on a grid of so many steps a logit, up to so many logits from 0.
GRID, REACH = 64, 32


def word_features(names: pa.Array) -> np.ndarray:
    """Three 64-bit features of each distinct word: itself, its first four and its first five letters."""
    from xxhash import xxh64_intdigest as digest

    whole = [b"w" + x.encode() for x in names.to_pylist()]
    cut = lambda k: [b"%d" % k + x.encode() for x in pc.utf8_slice_codeunits(names, 0, k).to_pylist()]
    return np.array([[digest(x, 7) for x in form] for form in (whole, cut(4), cut(5))], np.uint64).T.reshape(len(names), 3)


@dataclass
class Model:
    """All numbers of the classifier; picklable."""

    tags: np.ndarray  # of each bucket the owner's tag, 0: none
    rows: np.ndarray  # of each bucket its row in the table
    table: np.ndarray  # embeddings, row 0 is unknown
    filters: list[np.ndarray] = field(default_factory=list)  # width x DIM x FILTERS
    biases: list[np.ndarray] = field(default_factory=list)
    out: np.ndarray | None = None
    out_bias: float = 0.0
    shift: np.ndarray | None = None  # of each language the logit of its threshold

    def lookup(self, features: np.ndarray) -> np.ndarray:
        """Rows of the table for features, 0 for those whose bucket is someone else's."""
        bucket = (features % np.uint64(BUCKETS)).astype(np.int64)
        tag = (features >> np.uint64(33)).astype(np.uint32) | np.uint32(1)
        return np.where(self.tags[bucket] == tag, self.rows[bucket], 0)

    def responses(self, vectors: np.ndarray, word: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Pooled responses of each text (0 where it is shorter than the width), and where each maximum lies.

        vectors: of distinct words; word: the distinct word at each place.
        """
        counts = np.diff(offsets)
        pooled, where = [], []
        for w, bias in zip(self.filters, self.biases, strict=True):
            width = len(w)
            n = np.maximum(counts - width + 1, 0)
            starts = ragged(offsets[:-1], n)
            best = np.zeros((len(counts), FILTERS), np.float32)
            full = np.flatnonzero(n)
            if len(full):
                part = [vectors @ w[k] for k in range(width)]  # by distinct word
                conv = part[0][word[starts]]
                for k in range(1, width):
                    conv += part[k][word[starts + k]]
                first = (np.cumsum(n) - n)[full]
                best[full] = np.maximum(np.maximum.reduceat(conv, first, axis=0) + bias, 0)
            pooled.append(best)
            where.append(starts)
        return np.concatenate(pooled, axis=1), where

    def logits(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The uncalibrated logit of label 1 for null-free texts, and each text's language."""
        w = words_of(alnum_ascii(text))
        features = word_features(w.names)
        vectors = self.table[self.lookup(features)].sum(axis=1) if len(features) else np.zeros((1, DIM), np.float32)
        pooled, _ = self.responses(vectors, w.ids, w.offsets)
        return (pooled @ self.out + self.out_bias).astype(np.float64), language_of(w)

    def score(self, text: pa.Array) -> np.ndarray:
        """The calibrated probability of label 1 for null-free texts."""
        if self.out is None:
            return np.zeros(len(text))
        logit, language = self.logits(text)
        return 1 / (1 + np.exp(-np.clip(logit - self.shift[language], -30, 30)))


def language_of(w) -> np.ndarray:
    """Per text the number in LANGUAGES of the language with the most of its function words."""
    if not len(w.ids):
        return np.full(len(w.counts), len(LANGUAGES) - 1)
    hits = []
    for listed in FUNCTION_WORDS.values():
        is_one = pc.is_in(w.names, pa.array(listed, w.names.type)).to_numpy(zero_copy_only=False).astype(np.int64)
        hits.append(w.per_text(is_one))
    hits = np.stack([*hits, np.zeros(len(w.counts), np.int64)], axis=1)
    return np.where(hits.max(axis=1) > 0, hits.argmax(axis=1), len(LANGUAGES) - 1)


@dataclass
class Sample:
    """Labelled texts as numbers of distinct words: text i has words[offsets[i]:offsets[i + 1]]."""

    features: np.ndarray  # of each distinct word
    words: np.ndarray
    offsets: np.ndarray
    label: np.ndarray
    language: np.ndarray
    pair_text: np.ndarray  # each text with each of its distinct words
    pair_word: np.ndarray


def train(s: Sample, *, epochs: int = 4, rate: float = 0.05, seed: int = 1) -> Model:
    """Fit embeddings, filters and the logistic layer by Adagrad; one text a step sees one maximum per filter."""
    n = len(s.label)
    model = Model(np.zeros(BUCKETS, np.uint32), np.zeros(BUCKETS, np.int32), np.zeros((1, DIM), np.float32))
    if not n or s.label.min() == s.label.max():
        return model
    rng = np.random.default_rng(seed)
    # presence of each feature in each text
    flat, back = np.unique(s.features.ravel(), return_inverse=True)
    back = back.reshape(s.features.shape)
    p, q = np.zeros(len(flat)), np.zeros(len(flat))
    for at in range(0, n, 256):  # features of a few texts at a time: each counts once a text
        a, b = np.searchsorted(s.pair_text, [at, at + 256])
        pair = np.unique(np.repeat(s.pair_text[a:b].astype(np.int64) * len(flat), 3) + back[s.pair_word[a:b]].ravel())
        toxic = s.label[pair // len(flat)] == 1
        p += np.bincount(pair[toxic] % len(flat), minlength=len(flat))
        q += np.bincount(pair[~toxic] % len(flat), minlength=len(flat))
    pos, neg = s.label == 1, s.label == 0
    odds = np.log((p + 0.5) / (pos.sum() + 1)) - np.log((q + 0.5) / (neg.sum() + 1))
    seen = p + q >= min(3, max(2, n // 200))
    worth = np.where(seen, np.abs(odds) * np.sqrt(p + q), 0)
    # the most telling feature of a bucket owns it
    order = np.argsort(-worth, kind="stable")
    order = order[worth[order] > 0]
    bucket = (flat[order] % np.uint64(BUCKETS)).astype(np.int64)
    _, first = np.unique(bucket, return_index=True)
    owners = order[np.sort(first)]
    bucket = (flat[owners] % np.uint64(BUCKETS)).astype(np.int64)
    model.tags[bucket] = (flat[owners] >> np.uint64(33)).astype(np.uint32) | np.uint32(1)
    model.rows[bucket] = np.arange(1, len(owners) + 1)
    table = rng.normal(0, 0.05, (len(owners) + 1, DIM)).astype(np.float32)
    # one dimension starts at the evidence of the feature, shrunk where it is thin
    table[1:, 0] = np.clip(odds[owners] * (p + q)[owners] / ((p + q)[owners] + 3), -4, 4) / 3
    table[0] = 0
    model.table = table
    row_of = model.lookup(flat)[back]
    for width in WIDTHS:
        w = rng.normal(0, 0.1, (width, DIM, FILTERS)).astype(np.float32)
        w[0, 0] += 1.0 if width == 1 else 0.5
        model.filters.append(w)
        model.biases.append(np.full(FILTERS, -0.5 if width == 1 else -0.8, np.float32))
    model.out = np.full(FILTERS * len(WIDTHS), 1.0 / (FILTERS * len(WIDTHS)), np.float32) * 2
    model.out_bias = -1.0
    model.shift = np.zeros(len(LANGUAGES))
    params = [model.table, *model.filters, *model.biases, model.out]
    memory = [np.full_like(x, 1e-2) for x in params]
    bias_memory = 1e-2

    def step(k: int, grad: np.ndarray, rows=None) -> None:
        at = (...) if rows is None else rows
        memory[k][at] += grad**2
        params[k][at] -= rate * grad / np.sqrt(memory[k][at])

    hold = mix64(np.arange(n)) % np.uint64(5) == 0 if n >= 200 else np.zeros(n, bool)
    learn = np.flatnonzero(~hold)
    weight = np.where(s.label == 1, 0.5 / max(s.label[learn].mean(), 1e-3), 0.5 / max(1 - s.label[learn].mean(), 1e-3))
    batch = 64
    for _ in range(epochs):
        mixed = rng.permutation(learn)
        for at in range(0, len(mixed), batch):
            docs = mixed[at : at + batch]
            places = ragged(s.offsets[docs], np.diff(s.offsets)[docs])
            offsets = np.concatenate(([0], np.cumsum(np.diff(s.offsets)[docs])))
            rows = row_of[s.words[places]]
            x = model.table[rows].sum(axis=1) if len(rows) else np.zeros((0, DIM), np.float32)
            counts = np.diff(offsets)
            pooled, top = [], []
            for w, bias in zip(model.filters, model.biases, strict=True):
                m = np.maximum(counts - len(w) + 1, 0)
                starts = ragged(offsets[:-1], m)
                best, arg = np.zeros((len(docs), FILTERS), np.float32), np.full((len(docs), FILTERS), -1)
                if len(starts):
                    conv = sum(x[starts + k] @ w[k] for k in range(len(w))) + bias
                    edge = np.cumsum(m) - m
                    for d in np.flatnonzero(m):
                        block = conv[edge[d] : edge[d] + m[d]]
                        arg[d] = block.argmax(axis=0)
                        best[d] = block[arg[d], np.arange(FILTERS)]
                        arg[d] = np.where(best[d] > 0, starts[edge[d]] + arg[d], -1)
                pooled.append(np.maximum(best, 0))
                top.append(arg)
            h = np.concatenate(pooled, axis=1)
            z = 1 / (1 + np.exp(-np.clip(h @ model.out + model.out_bias, -30, 30)))
            g = ((z - s.label[docs]) * weight[docs] / len(docs)).astype(np.float32)
            back_h = g[:, None] * model.out[None, :]
            gx = np.zeros_like(x)
            grads = []
            for f, (w, arg) in enumerate(zip(model.filters, top, strict=True)):
                gf = back_h[:, f * FILTERS : (f + 1) * FILTERS] * (arg >= 0)
                d, c = np.nonzero(arg >= 0)
                gw = np.zeros_like(w)
                for k in range(len(w)):
                    np.add.at(gw[k].T, c, x[arg[d, c] + k] * gf[d, c][:, None])
                    np.add.at(gx, arg[d, c] + k, w[k].T[c] * gf[d, c][:, None])
                grads.append((gw, gf.sum(axis=0)))
            step(len(params) - 1, h.T @ g)
            bias_memory += float(g.sum()) ** 2
            model.out_bias -= rate * float(g.sum()) / np.sqrt(bias_memory)
            for f, (gw, gb) in enumerate(grads):
                step(1 + f, gw)
                step(1 + len(WIDTHS) + f, gb)
            hit = np.flatnonzero(np.abs(gx).sum(axis=1) > 0)
            if len(hit):
                r, inverse = np.unique(rows[hit].ravel(), return_inverse=True)
                total = np.zeros((len(r), DIM), np.float32)
                np.add.at(total, inverse, np.repeat(gx[hit], 3, axis=0))
                step(0, total[r > 0], r[r > 0])
    _calibrate(model, s, row_of, np.flatnonzero(hold) if hold.any() else np.arange(n))
    return model


def _calibrate(model: Model, s: Sample, row_of: np.ndarray, docs: np.ndarray) -> None:
    """Per language the threshold with the fewest errors on ``docs``; few texts use all of them."""
    logits, vectors = [], model.table[row_of].sum(axis=1)
    for at in range(0, len(docs), 256):
        part = docs[at : at + 256]
        places = ragged(s.offsets[part], np.diff(s.offsets)[part])
        offsets = np.concatenate(([0], np.cumsum(np.diff(s.offsets)[part])))
        logits.append(model.responses(vectors, s.words[places], offsets)[0] @ model.out + model.out_bias)
    logit = np.concatenate(logits) if logits else np.zeros(0)
    label = s.label[docs]

    def cut(of: np.ndarray) -> float:
        order = np.argsort(logit[of])
        z, y = logit[of][order], label[of][order]
        errors = np.concatenate(([0], np.cumsum(y == 1))) + np.concatenate((np.cumsum((y == 0)[::-1])[::-1], [0]))
        best = np.flatnonzero(errors == errors.min())
        middle = best[len(best) // 2]
        low = z[middle - 1] if middle else z[0] - 2
        high = z[middle] if middle < len(z) else z[-1] + 2
        return float((low + high) / 2)

    if len(logit):
        overall = cut(np.arange(len(docs)))
        for k in range(len(LANGUAGES)):
            of = np.flatnonzero(s.language[docs] == k)
            model.shift[k] = cut(of) if len(of) >= 50 and (label[of] == 1).sum() >= 10 else overall


def labelled_sample(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, doc_id: str = "doc_id", text: str = "text") -> Sample:
    """At most ``sample`` labelled texts and ``sample_bytes`` of each kind, as features; executors send no texts.

    A doc_id with both labels counts as toxic; of copies of a doc_id one is taken. Texts of over a LONG_SHARE of the bytes come
    last, by their size, so none of them shuts out the others, and each label has one text at least.
    """
    small_batches(docs.sparkSession)
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("_label"))
    some = lambda k: one.where(F.col("_label") == k).orderBy(F.xxhash64("_id"), "_id").limit(sample)
    chosen = some(1).unionByName(some(0))
    found = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    found = found.groupBy("_id", "_label").agg(F.min("_text").alias("_text"))
    # at most ``sample`` rows of a label from here
    size = F.coalesce(F.octet_length("_text"), F.lit(0))
    order = Window.partitionBy("_label").orderBy(F.when(size > sample_bytes // LONG_SHARE, size).otherwise(0), F.xxhash64("_id"), "_id")
    found = found.withColumns({"_so_far": F.sum(size).over(order), "_nth": F.row_number().over(order)})
    found = found.where((F.col("_so_far") <= sample_bytes) | (F.col("_nth") == 1)).drop("_so_far", "_nth")

    kind = pa.struct([("f", pa.binary()), ("w", pa.binary()), ("lang", pa.int32())])

    @F.arrow_udf("struct<f:binary,w:binary,lang:int>")
    def encode(column: pa.Array) -> pa.Array:
        def one_slice(part: pa.Array) -> pa.Array:
            w = words_of(alnum_ascii(part))
            features, found = word_features(w.names), ([], [])
            for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True):
                own, place = np.unique(w.ids[a:b], return_inverse=True)
                found[0].append(features[own].tobytes())
                found[1].append(place.astype("<u4").tobytes())
            return pa.StructArray.from_arrays([pa.array(found[0], pa.binary()), pa.array(found[1], pa.binary()), pa.array(language_of(w), pa.int32())], fields=list(kind))

        return by_slices(column, one_slice, kind)

    rows = found.select("_id", "_label", encode("_text").alias("e")).select("_id", "_label", "e.*").toArrow().sort_by("_id").combine_chunks()
    # views of what came, without copies for each text
    own, (types, _) = _joined(rows["f"], np.uint64)
    placed, (sizes, offsets) = _joined(rows["w"], np.dtype("<u4"))
    types //= 3
    own = own.reshape(-1, 3)
    _, first, number = np.unique(own[:, 0], return_index=True, return_inverse=True)
    number = number.astype(np.int32)
    words = number[placed + np.repeat(np.cumsum(types) - types, sizes)]
    owner = np.repeat(np.arange(len(types), dtype=np.int32), types)
    features, label, language = own[first], rows["_label"].to_numpy().astype(np.int64), rows["lang"].to_numpy().astype(np.int64)
    del own, placed, rows
    pa.default_memory_pool().release_unused()
    return Sample(features, words, offsets, label, language, owner, number)


def _joined(column: pa.ChunkedArray, kind: np.dtype) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
    """All numbers of a column of binaries, one after another, with how many each has and where each starts and the last ends."""
    kind, parts, sizes = np.dtype(kind), [np.zeros(0, kind)], [np.zeros(0, np.int64)]
    for chunk in (x.cast(pa.large_binary()) for x in column.chunks if len(x)):
        _, ends, data = chunk.buffers()
        ends = np.frombuffer(ends, np.int64)[chunk.offset : chunk.offset + len(chunk) + 1]
        parts.append(np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view(kind) if data is not None else parts[0])
        sizes.append(np.diff(ends) // kind.itemsize)
    n = np.concatenate(sizes)
    full = [x for x in parts if len(x)]
    return full[0] if len(full) == 1 else np.concatenate(parts), (n, np.concatenate(([0], np.cumsum(n))))


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, sample_bytes: int = SAMPLE_BYTES, doc_id: str = "doc_id", text: str = "text") -> Model:
    """The classifier for the ``labels`` (doc_id, toxic 0 or 1) of ``docs``."""
    model = train(labelled_sample(docs, labels, sample=sample, sample_bytes=sample_bytes, doc_id=doc_id, text=text))
    release_memory()
    return model


def with_toxicity(docs: DataFrame, model: Model, into: str, text: str = "text") -> DataFrame:
    """``docs`` with the calibrated score ``into``, from 0 to 1."""
    small_batches(docs.sparkSession)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return by_slices(column, lambda part: pa.array(model.score(part), pa.float64()), pa.float64())

    return docs.withColumn(into, score(F.col(text)))


def with_logit(docs: DataFrame, model: Model, into: str, text: str = "text") -> DataFrame:
    """``docs`` with ``into``: the uncalibrated logit and the number of the text's language. The model must have been fitted on both labels."""
    small_batches(docs.sparkSession)
    kind = pa.struct([("logit", pa.float64()), ("language", pa.int32())])

    @F.arrow_udf("struct<logit:double,language:int>")
    def told(column: pa.Array) -> pa.Array:
        def one(part: pa.Array) -> pa.Array:
            logit, language = model.logits(part)
            return pa.StructArray.from_arrays([pa.array(logit, pa.float64()), pa.array(language, pa.int32())], fields=list(kind))

        return by_slices(column, one, kind)

    return docs.withColumn(into, told(F.col(text)))


def thresholds(told: DataFrame, labels: DataFrame) -> list[float]:
    """For each language the logit, on the grid, with the fewest errors over all labelled rows of ``told`` (doc_id, logit, language).

    Rows are counted by step of the grid in Spark, so the driver gets a bounded table however many are labelled. Few texts use all languages' rows.
    """
    one = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    step = F.floor(F.least(F.greatest("logit", F.lit(-float(REACH))), F.lit(float(REACH))) * GRID).cast("int")
    counts = told.join(one, "doc_id").groupBy("language", step.alias("step")).agg(F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") != 1).alias("clean")).collect()
    size = 2 * REACH * GRID + 1
    n = np.zeros((len(LANGUAGES), 2, size), np.int64)
    for r in counts:
        n[r["language"], :, r["step"] + REACH * GRID] = r["toxic"], r["clean"]

    def cut(toxic: np.ndarray, clean: np.ndarray) -> float:
        errors = np.concatenate(([0], np.cumsum(toxic))) + np.concatenate((np.cumsum(clean[::-1])[::-1], [0]))
        best = np.flatnonzero(errors == errors.min())
        return float(best[len(best) // 2] / GRID - REACH)

    overall = cut(*n.sum(axis=0)) if n.any() else 0.0
    return [cut(*x) if x.sum() >= 50 and x[0].sum() >= 10 else overall for x in n]


def calibrated(logit: Column, language: Column, shift: list[float]) -> Column:
    """The score of a logit, 0.5 at its language's threshold."""
    own = F.get(F.array(*[F.lit(x) for x in shift]), language)
    return 1 / (1 + F.exp(-F.least(F.greatest(logit - own, F.lit(-30.0)), F.lit(30.0))))
