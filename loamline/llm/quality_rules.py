"""Quality rules: an ordered decision list learned by sequential covering.

``with_statistics`` adds one struct of text statistics per document (an Arrow UDF that sees the
text column only). ``learn_rules`` grows and prunes conjunctions of thresholds on them from
labelled documents, and ``rule_verdict`` turns the list into one ordered ``CASE WHEN``.

Defined results: a null text counts as empty (all statistics 0, base failed); repeated rows and
doc_ids are each judged by themselves; an empty table gives an empty result; all columns of the
input stay, whatever their names. Without labels of both classes the list is empty and the verdict is
the base rule alone.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.scratch import small_batches
from loamline.llm.text import by_slices, mix64, numbers, ragged, words_of

WINDOW = 5
#: Labelled documents that the rules are learned from, at most: those of the smallest hashes.
SAMPLE = 20_000

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits", "n_long_words"]
_STRUCT = pa.struct([(c, pa.int64()) for c in COUNTS])
_DDL = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"


def repeated_words(offsets: np.ndarray, ids: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """Words of each text that lie in a window of words found twice or more in that text."""
    counts = np.diff(offsets)
    starts = ragged(offsets[:-1], np.maximum(counts - window + 1, 0))
    covered = np.zeros(len(ids) + 1, np.int32)
    if len(starts):
        owner = np.repeat(np.arange(len(counts)), np.maximum(counts - window + 1, 0))
        word = mix64(ids)
        key = mix64(owner)
        for k in range(window):
            key = key * np.uint64(0x9E3779B97F4A7C15) + word[starts + k]
            key ^= key >> np.uint64(29)
        ordered = np.sort(key)
        twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
        if len(twice):
            at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            hit = np.flatnonzero(twice[at] == key)
            # equal keys could be a collision: compare the words themselves
            real = np.column_stack([owner[hit], *(ids[starts[hit] + k] for k in range(window))])
            _, back, times = np.unique(real, axis=0, return_inverse=True, return_counts=True)
            first = starts[hit[times[back.ravel()] > 1]]
            np.add.at(covered, first, 1)
            np.add.at(covered, first + window, -1)
    inside = np.concatenate(([0], np.cumsum(np.cumsum(covered[:-1]) > 0)))
    return inside[offsets[1:]] - inside[offsets[:-1]]


def _line_counts(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and those of them that are equal to an earlier line of their text."""
    lists = pc.split_pattern(text, "\n")
    offsets = numbers(lists.offsets)
    flat = lists.values.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))
    worded = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(flat)), 0).to_numpy(zero_copy_only=False)
    line = flat.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(text)), np.diff(offsets))
    n = np.bincount(owner[worded], minlength=len(text))
    distinct = np.unique(owner[worded] * (line.max(initial=0) + 1) + line[worded]) // (line.max(initial=0) + 1)
    return n, n - np.bincount(distinct, minlength=len(text))


def text_statistics(text: pa.Array) -> pa.Array:
    """The struct of COUNTS for each of the null-free texts."""
    words = words_of(text)
    count = lambda pattern: numbers(pc.count_substring_regex(words.names, pattern))
    length = numbers(pc.utf8_length(words.names))
    lines, doubled = _line_counts(text)
    found = [
        words.counts,
        words.per_text(length),
        words.per_text(count(r"[#*$%&|<>]")),
        doubled,
        repeated_words(words.offsets, words.ids),
        lines,
        words.per_text(count(r"\p{Lu}")),
        words.per_text(count(r"[!?]")),
        words.per_text(count(r"[0-9]")),
        words.per_text((length > 20).astype(np.int64)),
    ]
    return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in found], fields=list(_STRUCT))


def _statistics_udf():
    @F.arrow_udf(_DDL)
    def statistics(text: pa.Array) -> pa.Array:
        return by_slices(text, text_statistics, _STRUCT)

    return statistics


def with_statistics(docs: DataFrame, into: str, text: str = "text") -> DataFrame:
    """``docs`` and a struct column ``into`` of counts over the whole text."""
    small_batches(docs.sparkSession)
    return docs.withColumn(into, _statistics_udf()(F.col(text)))


def base_failed(s: Column) -> Column:
    """The fixed rule: under ten words, or over a fifth of the words in repeated windows."""
    return (s["n_words"] < 10) | (F.lit(100) * s["n_repeat_words"] > F.lit(20) * s["n_words"])


def features(s: Column) -> dict[str, Column]:
    """Ratios that the learned rules compare with thresholds."""
    per_word = lambda c: s[c] / F.greatest(s["n_words"], F.lit(1))
    per_char = lambda c: s[c] / F.greatest(s["word_chars"], F.lit(1))
    return {
        "words": s["n_words"].cast("double"),
        "chars_per_word": per_word("word_chars"),
        "symbols_per_word": per_word("n_symbols"),
        "repeated_share": per_word("n_repeat_words"),
        "dup_line_share": s["n_dup_lines"] / F.greatest(s["n_lines"], F.lit(1)),
        "upper_share": per_char("n_upper"),
        "marks_per_word": per_word("n_marks"),
        "digit_share": per_char("n_digits"),
        "long_word_share": per_word("n_long_words"),
        "words_per_line": s["n_words"] / F.greatest(s["n_lines"], F.lit(1)),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        v = x[:, names.index(self.feature)]
        return v > self.threshold if self.above else v <= self.threshold

    def column(self, of: dict[str, Column]) -> Column:
        return of[self.feature] > self.threshold if self.above else of[self.feature] <= self.threshold


@dataclass(frozen=True)
class Rule:
    """Rejects a document for which all conditions hold."""

    conditions: tuple[Condition, ...]

    def holds(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        out = np.ones(len(x), bool)
        for c in self.conditions:
            out &= c.holds(x, names)
        return out


def _grow(x: np.ndarray, bad: np.ndarray, names: list[str], cuts: list[np.ndarray], longest: int) -> list[Condition]:
    """Conditions added one by one, each with the largest information gain, until none helps."""
    inside, chosen = np.ones(len(x), bool), []
    while len(chosen) < longest and (inside & ~bad).any():
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        best = (0.0, None)
        for j, at in enumerate(cuts):
            v, b = x[inside, j], bad[inside]
            slot = np.searchsorted(at, v, "left")  # v <= at[k] exactly if slot <= k
            p = np.cumsum(np.bincount(slot[b], minlength=len(at) + 1))[:-1]
            n = np.cumsum(np.bincount(slot[~b], minlength=len(at) + 1))[:-1]
            for above, pp, nn in ((False, p, n), (True, p0 - p, n0 - n)):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(pp > 0, pp * (np.log2(pp / (pp + nn)) - np.log2(p0 / (p0 + n0))), 0)
                k = int(np.argmax(gain)) if len(gain) else 0
                if len(gain) and gain[k] > best[0] + 1e-9:
                    best = (float(gain[k]), Condition(names[j], above, float(at[k])))
        if best[1] is None:
            break
        chosen.append(best[1])
        inside &= best[1].holds(x, names)
    return chosen


def fit_rules(x: np.ndarray, bad: np.ndarray, names: list[str], *, precision: float = 0.8, longest: int = 4, most: int = 16, cuts: int = 128) -> list[Rule]:
    """Sequential covering: grow a rule on two thirds, prune it on the rest, drop what it covers, repeat.

    A rule is accepted if at least ``precision`` of what it rejects is labelled bad, on all
    rows that earlier rules leave.
    """
    rules: list[Rule] = []
    left = np.ones(len(x), bool)
    fold = mix64(np.arange(len(x))) % np.uint64(3) == 0
    at = [np.unique(np.quantile(c, np.linspace(0, 1, cuts))) if len(c) else c for c in x.T]
    # midpoints generalise better than observed values
    at = [(c[1:] + c[:-1]) / 2 for c in at]
    while len(rules) < most and (left & bad & ~fold).any():
        grow, prune = left & ~fold, left & fold
        conditions = _grow(x[grow], bad[grow], names, at, longest)
        if not conditions:
            break

        def worth(k: int, conditions=conditions, prune=prune) -> float:
            hit = Rule(tuple(conditions[:k])).holds(x[prune], names)
            p, n = (hit & bad[prune]).sum(), (hit & ~bad[prune]).sum()
            return (p - n) / (p + n) if p + n else -1.0

        keep = max(range(1, len(conditions) + 1), key=lambda k: (worth(k), -k)) if prune.any() else len(conditions)
        rule = Rule(tuple(conditions[:keep]))
        hit = rule.holds(x, names) & left
        if not hit.any() or bad[hit].mean() < precision:
            rule = Rule(tuple(conditions))
            hit = rule.holds(x, names) & left
            if not hit.any() or bad[hit].mean() < precision or (hit & bad).sum() < 3:
                break
        rules.append(rule)
        left &= ~hit
    return rules


def learn_rules(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE, doc_id: str = "doc_id", text: str = "text") -> list[Rule]:
    """Rules from ``labels`` (doc_id, quality 0 or 1) joined with the texts of ``docs``.

    The labelled rows are a bounded sample: the ``sample`` smallest hashes of doc_id. A doc_id
    with labels of both kinds counts as bad.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_quality"))
        .orderBy(F.xxhash64("_id"), "_id").limit(sample)
    )
    found = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(F.broadcast(chosen), "_id")
    found = with_statistics(found, "_s", "_text")
    of = features(F.col("_s"))
    row = F.struct(base_failed(F.col("_s")).alias("_failed"), *[c.alias(n) for n, c in of.items()])
    # of copies of a labelled doc_id one row comes to the driver: one that the base rule keeps, if there is any
    rows = found.groupBy("_id", "_quality").agg(F.min(row).alias("r")).select("_id", "_quality", "r.*").toPandas()
    rows = rows[~rows["_failed"]].sort_values("_id")
    names = list(of)
    return fit_rules(rows[names].to_numpy(float), rows["_quality"].to_numpy() == 0, names)


def rule_verdict(rules: list[Rule], s: Column) -> Column:
    """The number of the first rule that rejects, from 1; 0 if none does: an ordered conditional."""
    of = features(s)
    out = None
    for k, rule in enumerate(rules, 1):
        both = rule.conditions[0].column(of)
        for c in rule.conditions[1:]:
            both = both & c.column(of)
        out = F.when(both, k) if out is None else out.when(both, k)
    return F.lit(0) if out is None else out.otherwise(0)


def judge(docs: DataFrame, rules: list[Rule], into: str, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``into``: the statistics, base_failed, rule (0: none) and kept."""
    df = with_statistics(docs, into, text)
    s = F.col(into)
    rule = rule_verdict(rules, s)
    return df.withColumn(
        into,
        F.struct(*[s[c].alias(c) for c in COUNTS], base_failed(s).alias("base_failed"), rule.alias("rule"), (~base_failed(s) & (rule == 0)).alias("kept")),
    )
