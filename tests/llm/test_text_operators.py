"""Quality rules, licence scan, SimHash, toxicity, LM scoring against plain Python."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loamline.llm import components, license_scan, lm_scoring, queries, quality_rules, simhash, text, toxicity
from loamline.llm.scratch import materialize

from .conftest import ODD, SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def plain_statistics(t: str | None) -> tuple:
    t = t or ""
    w = WORD.findall(t)
    grams = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    covered = {j for k in range(len(w) - 4) if grams[tuple(w[k : k + 5])] > 1 for j in range(k, k + 5)}
    seen, doubled = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            doubled += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), doubled, len(covered)


FIVE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_quality_statistics_equal_plain_ones(docs, texts):
    got = {r.doc_id: tuple(r.q[c] for c in FIVE) for r in quality_rules.with_statistics(docs, "q").select("doc_id", "q").collect()}
    assert got == {i: plain_statistics(t) for i, t in texts.items()}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#é", max_size=60), min_size=1, max_size=4))
def test_quality_statistics_of_any_text(found):
    got = quality_rules.text_statistics(pa.array(found)).to_pylist()
    assert [tuple(r[c] for c in FIVE) for r in got] == [plain_statistics(t) for t in found]


def test_quality_rules_separate_labels(spark, docs, labels):
    out = queries.op1_quality_rules(spark, SF).join(labels, "doc_id").where("NOT base_failed").collect()
    assert sum(r.kept == (r.quality == 1) for r in out) / len(out) > 0.95
    assert all(r.kept for r in out if r.quality == 1)


def test_quality_rules_are_one_ordered_conditional(spark, docs):
    c = quality_rules.Condition
    rules = [quality_rules.Rule((c("symbols_per_word", True, 0.5), c("words", True, 3.0))), quality_rules.Rule((c("upper_share", True, 0.9),))]
    df = spark.createDataFrame([("A## B## C## D##",), ("AB CD",), ("ab cd",)], ["text"])
    got = [r.q.rule for r in quality_rules.judge(df, rules, "q").collect()]
    assert got == [1, 2, 0]


def test_quality_without_labels_keeps_by_base_rule(spark, odd, labels):
    rules = quality_rules.learn_rules(odd, labels.limit(0))
    assert rules == []
    got = quality_rules.judge(odd, rules, "q").select("doc_id", "q.kept", "q.n_words", "size").collect()
    assert len(got) == len(ODD) and all(r.kept == (r.n_words >= 10 and r.doc_id not in (4, 8)) for r in got)


def plain_places(t: str | None) -> list[tuple[int, str]]:
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    return [(k, label) for p, label in license_scan.BASE_PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]


def test_license_places_equal_plain_ones(spark, texts):
    for r in queries.op2_license_scans(spark, SF).collect():
        places = plain_places(texts[r.doc_id])
        starts = [k for k, _ in places]
        assert (r.n_base, r.first_word, r.last_word, r.base_labels) == (len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places})))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=7), min_size=1, max_size=4), st.lists(st.integers(0, 4), max_size=14))
def test_matching_statistics(sequences, words):
    a = license_scan.SuffixAutomaton()
    for n, s in enumerate(sequences):
        a.add(s, n)
    a.finish()
    states, lengths = a.statistics(words)
    stretches = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    for i in range(len(words)):
        best = max((k for k in range(i + 2) if k == 0 or tuple(words[i - k + 1 : i + 1]) in stretches), default=0)
        assert lengths[i] == best
        if best:
            found = tuple(words[i - best + 1 : i + 1])
            shares = {(n, j): next((k for k in range(best, 0, -1) if j + 1 >= k and tuple(s[j - k + 1 : j + 1]) == found[best - k :]), 0) for n, s in enumerate(sequences) for j in range(len(s))}
            for shortest in (1, 2):
                got = list(a.stretches(states[i], best, shortest))
                assert sorted(got) == sorted((*at, k) for at, k in shares.items() if k >= shortest)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["cc", "by", "general", "public", "license", "the", "version", "3", "x", "licensed", "under", "nc", "all", "rights", "reserved"]), max_size=40))
def test_base_places_of_any_words(words):
    s = license_scan.Scanner(license_scan.TEMPLATES, license_scan.BASE_PHRASES)
    r = s.scan(pa.array([" ".join(words)])).to_pylist()[0]
    places = plain_places(" ".join(words))
    assert r["n_base"] == len(places) and r["base_labels"] == sorted({x for _, x in places})


def test_license_template_spans(spark):
    df = spark.createDataFrame([("intro text\nThis work is licensed under the GNU General Public License, version 3. more",)], ["text"])
    x = license_scan.with_licenses(df, "x").first().x
    assert x.labels == ["gpl", "gpl-3.0"] and x.score == 1.0 and [(s.first_word, s.last_word) for s in x.spans] == [(2, 13)]


def plain_best_chain(template: list[str], words: list[str], shortest: int = 3) -> float:
    """The largest share of a template that stretches of at least ``shortest`` words cover, in order in both and sharing no word."""
    n, m = len(template), len(words)
    stretches = [
        (b, a, k) for b in range(m) for a in range(n) for k in range(shortest, min(n - a, m - b) + 1) if template[a : a + k] == words[b : b + k]
    ]
    best = {}
    for b, a, k in sorted(stretches):
        best[b, a, k] = k + max((v for (pb, pa_, pk), v in best.items() if pb + pk <= b and pa_ + pk <= a and b - pb - pk <= n), default=0)
    return max(best.values(), default=0) / n


@settings(max_examples=150, deadline=None)
@example(["c", "e", "d", "f", "b", "g", "a", "h"], ["f", "b", "g", "b", "g", "a"])
@given(st.permutations(list("abcdefgh")), st.lists(st.sampled_from(list("abcdefghxy")), max_size=30))
def test_license_score_equals_the_best_chain(template, words):
    """Templates without repeats: all places of a stretch count, and single words beside stretches do not."""
    s = license_scan.Scanner({"t": [" ".join(template)]}, {})
    r = s.scan(pa.array([" ".join(words)])).to_pylist()[0]
    assert r["score"] == pytest.approx(min(1.0, plain_best_chain(list(template), words)))
    assert r["labels"] == (["t"] if r["score"] >= 0.8 else [])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=3, max_size=9), min_size=1, max_size=3), st.lists(st.sampled_from("abcx"), max_size=24))
def test_license_stretches_are_all_maximal_ones(templates, words):
    """Every place of every template, middle ones and those that another template's longer stretch hides included."""
    s = license_scan.Scanner({"t": [" ".join(t) for t in templates]}, {})
    ids = [s.vocabulary.get(w, 99) for w in words]
    matches = []
    s.scan_run(ids, 0, [], matches)
    want = set()
    for number, t in enumerate(templates):
        for a in range(len(t)):
            for b in range(len(words)):
                k = next((k for k in range(min(len(t) - a, len(words) - b) + 1) if k == min(len(t) - a, len(words) - b) or t[a + k] != words[b + k]))
                if k >= 3 and not (a and b and t[a - 1] == words[b - 1]):
                    want.add((number, a, b, k))
    assert set(matches) == want and len(matches) == len(want)


def test_license_middle_places_and_names_in_longer_names():
    s = license_scan.Scanner({"t": ["p q r a b c s t u a b c v w x a b c y z o"]}, {})
    assert s.scan(pa.array(["s t u a b c v w x"])).to_pylist()[0]["score"] == pytest.approx(9 / 21)
    assert s.scan(pa.array(["p q r s t u - a b c - v w x y z o"])).to_pylist()[0]["score"] == pytest.approx(15 / 21)
    s = license_scan.Scanner({"gpl": ["under the terms of the GNU General Public License as published"], "lgpl": ["under the terms of the GNU Lesser General Public License as published"]}, {})
    for text_, labels in (("under the terms of the GNU General Public License as published", ["gpl"]), ("under the terms of the GNU Lesser General Public License as published", ["lgpl"])):
        assert s.scan(pa.array([text_])).to_pylist()[0]["labels"] == labels
    both = s.scan(pa.array(["under the terms of the GNU Lesser General Public License as published, or under the terms of the GNU General Public License as published"])).to_pylist()[0]
    assert both["labels"] == ["gpl", "lgpl"] and len(both["spans"]) == 2


def test_license_templates_from_a_table(spark):
    table = spark.createDataFrame([("x", "one two three four"), ("x", "one two three four"), ("y", None), (None, "five six"), ("y", "six seven eight")], "label string, text string")
    t = license_scan.templates_of(table)
    assert t == {"x": ["one two three four"], "y": ["six seven eight"]} and license_scan.templates_of(table.limit(0)) == {}
    assert license_scan.with_licenses(spark.createDataFrame([("zero one two three four",)], ["text"]), "x", templates=t).first().x.labels == ["x"]
    with pytest.raises(ValueError):
        license_scan.templates_of(table, most_bytes=20)


def test_license_words_of_the_text_count_once():
    s = license_scan.Scanner({"t": ["a b c x y z a b c"]}, {})
    one, both, far = s.scan(pa.array(["a b c", "a b c then x y z then a b c", "a b c " + "q " * 40 + "x y z"])).to_pylist()
    assert (one["score"], both["score"], far["score"]) == pytest.approx((1 / 3, 1.0, 1 / 3))
    assert [(x["first_word"], x["last_word"]) for x in both["spans"]] == [(0, 10)]
    long = s.scan(pa.array(["a b c " * 20_000])).to_pylist()[0]  # many chains of one template
    assert long["n_words"] == 60_000 and long["score"] == pytest.approx(2 / 3)


def test_license_odd_rows(odd, empty):
    got = license_scan.with_licenses(odd, "x").select("doc_id", "x.*", "size").collect()
    assert len(got) == len(ODD) and all(r["size"] == "s" for r in got)
    assert all((r.n_words, r.n_base, r.score, r.labels) == (0, 0, 0.0, []) for r in got if r.doc_id in (1, 2, 3))
    assert [(r.base_labels, r.labels) for r in got if r.doc_id == 5] == [(["cc-by"], ["cc-by", "cc-by-4.0"])]
    assert license_scan.with_licenses(empty, "x").count() == 0


def test_quality_rules_equal_plain_covering():
    """The first condition is the best of all thresholds, tried one by one, and the verdicts are those of plain if-statements."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 3))
    bad = (x[:, 1] > 0.4) & (x[:, 2] < 0.3)
    names = ["p", "q", "r"]
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, 128))) for c in x.T]
    cuts = [(c[1:] + c[:-1]) / 2 for c in cuts]
    first = quality_rules._grow(x, bad, names, cuts, 1)[0]

    def gain(j, above, at):
        hit = x[:, j] > at if above else x[:, j] <= at
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        return p * (math.log2(p / (p + n)) - math.log2(bad.mean())) if p else 0.0

    best = max(gain(j, above, at) for j in range(3) for above in (False, True) for at in cuts[j])
    assert gain(names.index(first.feature), first.above, first.threshold) == pytest.approx(best)
    rules = quality_rules.fit_rules(x, bad, names)
    verdict = [any(all((row[names.index(c.feature)] > c.threshold) == c.above for c in r.conditions) for r in rules) for row in x]
    assert np.mean(np.array(verdict) == bad) > 0.95
    assert verdict == np.any([r.holds(x, names) for r in rules], axis=0).tolist()


def test_quality_verdicts_equal_plain_conditionals(spark, docs, labels, texts):
    rules = quality_rules.learn_rules(docs, labels)
    rows = quality_rules.judge(docs, rules, "q").select("doc_id", "q.*").collect()
    for r in rows:
        w, c, lines = max(r.n_words, 1), max(r.word_chars, 1), max(r.n_lines, 1)
        of = {
            "words": r.n_words, "chars_per_word": r.word_chars / w, "symbols_per_word": r.n_symbols / w, "repeated_share": r.n_repeat_words / w, "dup_line_share": r.n_dup_lines / lines, "upper_share": r.n_upper / c,
            "marks_per_word": r.n_marks / w, "digit_share": r.n_digits / c, "long_word_share": r.n_long_words / w, "words_per_line": r.n_words / lines,
        }
        hit = [k for k, rule in enumerate(rules, 1) if all((of[x.feature] > x.threshold) == x.above for x in rule.conditions)]
        assert r.rule == (hit[0] if hit else 0) and r.kept == (not r.base_failed and not hit)


def test_quality_takes_one_row_of_a_repeated_id(spark, labels):
    rows = [(i, ("good words in a row that read well number %d and so on until the end" % i) if i % 2 else "## $$ %% ## $$ %% && || ## $$ %d <> <>" % i) for i in range(200)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, quality int")
    rules = quality_rules.learn_rules(docs, marks)
    assert rules and rules == quality_rules.learn_rules(docs.dropDuplicates(), marks)


def test_toxicity_score_equals_a_plain_forward_pass(docs, labels, texts):
    m = toxicity.fit(docs, labels)
    some = [t for _, t in sorted(texts.items())][:40] + ["", "one", "one two"]
    got = m.score(pa.array(some))
    for t, score in zip(some, got, strict=True):
        words = re.sub(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]", " ", lower(t)).split(" ")
        words = [w for w in words if w]
        v = []
        for w in words:
            rows = []
            for form in (b"w" + w.encode(), b"4" + w[:4].encode(), b"5" + w[:5].encode()):
                h = xxhash.xxh64_intdigest(form, 7)
                at = h % toxicity.BUCKETS
                rows.append(m.rows[at] if m.tags[at] == (h >> 33 & 0xFFFFFFFF | 1) else 0)
            v.append(m.table[rows].sum(axis=0))
        z = m.out_bias
        for f, (filters, bias) in enumerate(zip(m.filters, m.biases, strict=True)):
            n = len(filters)
            for c in range(toxicity.FILTERS):
                all_ = [sum(float(v[i + k] @ filters[k, :, c]) for k in range(n)) + bias[c] for i in range(len(v) - n + 1)]
                z += m.out[f * toxicity.FILTERS + c] * max(0.0, *all_) if all_ else 0.0
        counts = [sum(w in listed for w in words) for listed in toxicity.FUNCTION_WORDS.values()]
        z -= m.shift[counts.index(max(counts)) if max(counts) else len(toxicity.LANGUAGES) - 1]
        assert score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-4)


def test_toxicity_sample_is_bounded_in_bytes(docs, labels):
    s = toxicity.labelled_sample(docs, labels, sample_bytes=20_000)
    whole = toxicity.labelled_sample(docs, labels)
    assert 0 < len(s.label) < len(whole.label) and s.label.min() == 0 and s.label.max() == 1


def test_lm_score_equals_a_plain_recursion(spark, docs, texts):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    counts = Counter(x for i, t in texts.items() if not held(i) for x in WORD.findall(lower(t)))
    ends = sum(not held(i) for i in texts)
    lattice = lm_scoring.fit(spark.createDataFrame(list(counts.items()), "word string, c bigint"), ends, path)
    pieces, _ = lm_scoring.vocabulary(path)
    logp = dict(zip(pieces, lattice.logp.tolist(), strict=True))
    memo = {}

    def plain(word: str) -> float:
        if word not in memo:
            x = b" " + word.encode()
            alpha = [0.0] + [-math.inf] * len(x)
            for j in range(1, len(x) + 1):
                terms = [alpha[i] + logp[x[i:j]] for i in range(max(0, j - lattice.longest), j) if x[i:j] in logp]
                alpha[j] = max(terms) + math.log(sum(math.exp(t - max(terms)) for t in terms))
            memo[word] = alpha[-1]
        return memo[word]

    got = {r.doc_id: r.score for r in lm_scoring.scored(docs, queries.remainder() == 1, path).collect()}
    for i in sorted(texts)[:150]:
        want = (sum(map(plain, WORD.findall(lower(texts[i])))) + lattice.log_end) / math.log(10)
        assert got[i] == pytest.approx(want, rel=1e-6)


def test_counts_of_common_words_where_they_stand(spark, docs):
    """Words of several chunks are summed apart from the others: the same rows, however many words are common."""
    path = queries.public_tokenizers.path("piece_bpe_32k.model")
    dealt = materialize(docs.select("doc_id", "text").where("doc_id < 60").repartition(6), "dealt")
    chunks = lm_scoring.chunked(dealt, F.lit(False), doc_id="doc_id", text="text")
    words = [set(r.words) for r in chunks.collect()]
    for least in (2, 3):
        want = {w for ws in words for w in ws if sum(w in x for x in words) >= least and len(w.encode()) <= lm_scoring.LONG}
        got = [r.word for r in lm_scoring.hot_words(chunks, least).collect()]
        assert len(got) == len(set(got)) and set(got) == want and want
    assert lm_scoring.hot_words(chunks, 2, most=3).count() == 3
    one, two, all_ = ({r.doc_id: r.asDict() for r in lm_scoring.scored(dealt, queries.remainder() == 1, path, hot=hot).collect()} for hot in (99, 2, 1))
    assert len(one) == dealt.count()
    for other in (two, all_):
        assert one.keys() == other.keys()
        assert all(other[i][k] == (pytest.approx(v, rel=1e-9) if isinstance(v, float) else v) for i, row in one.items() for k, v in row.items())


def plain_fingerprint(t: str | None) -> int:
    w = WORD.findall(lower(t or ""))
    shingles = [" ".join(w[k : k + 4]) for k in range(len(w) - 3)] if len(w) >= 4 else ([" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(codes: list[int], radius: int = 4) -> list[int]:
    parent = list(range(len(codes)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array(codes, np.uint64)
    for k in range(len(codes)):
        for j in np.flatnonzero(np.bitwise_count(a ^ a[k]) <= radius):
            x, y = find(k), find(int(j))
            parent[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(codes))]


def test_simhash_components_equal_all_pairs(spark, texts):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op7_simhash(spark, SF).collect()}
    ids = sorted(texts)
    codes = [plain_fingerprint(texts[i]) for i in ids]
    lowest = plain_components(codes)
    assert got == {i: (f"{c:016x}", ids[k]) for i, c, k in zip(ids, codes, lowest, strict=True)}


@pytest.mark.parametrize("block", [8, 2048])
def test_links_of_dense_and_sparse_codes(spark, block):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    dense = [int(base[0]) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 6), replace=False)) for _ in range(150)]
    codes = sorted({*map(int, base), *dense, 0, 1, 2**64 - 1})
    signed = [c - 2**64 if c >> 63 else c for c in codes]
    frame = spark.createDataFrame([(c,) for c in signed], "code long")
    roots = {r.node: r.root for r in components.components(simhash.linked(frame, block=block)).collect()}
    want = plain_components(codes)
    got = [roots.get(c, c) for c in signed]
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))


def test_simhash_odd_rows(odd, empty):
    out = simhash.with_components(simhash.with_fingerprint(odd, "f").cache(), "f", "component").collect()
    by = {}
    for r in out:
        by.setdefault(r.doc_id, set()).add((r.f, r.component))
    assert len(out) == len(ODD) and by[1] == by[2] == by[3] == {(0, 1)} and len(by[4]) == 1 and by[None] == {(next(iter(by[None]))[0], None)}
    assert simhash.with_components(simhash.with_fingerprint(empty, "f"), "f", "component").count() == 0


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 150)] + [(7, 7), (None, 3)]
    got = components.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len({r.root for r in got if r.node <= 200}) == 1 and len({r.root for r in got if r.node >= 1000}) == 1 and len({r.root for r in got}) == 2 and len(got) == 351


def test_toxicity_on_held_out_labels(spark, labels):
    out = queries.op9_toxicity(spark, SF).join(labels, "doc_id").collect()
    held = [r for r in out if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) / len(held) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)


def test_toxicity_without_labels_and_odd_rows(odd, empty, labels, docs):
    model = toxicity.fit(odd, labels.limit(0))
    assert [r.s for r in toxicity.with_toxicity(odd, model, "s").collect()] == [0.0] * len(ODD)
    trained = toxicity.fit(docs, labels)
    got = toxicity.with_toxicity(odd, trained, "s").select("doc_id", "s", "size").collect()
    assert len(got) == len(ODD) and len({r.s for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.with_toxicity(empty, trained, "s").count() == 0


def held(i) -> bool:
    return zlib.crc32(str(i).encode()) % 5 == 1


def test_lm_base_score_equals_plain_one(spark, texts):
    counts = Counter(x for i, t in texts.items() if not held(i) for x in [*WORD.findall(lower(t)), "\0end"])
    n, v = sum(counts.values()), len(counts)
    for r in queries.op6_lm_scoring(spark, SF).collect():
        w = [*WORD.findall(lower(texts[r.doc_id])), "\0end"]
        want = sum(math.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id), len(w), sum(counts[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, want, rel_tol=1e-9) and r.score < 0 and math.isfinite(r.score)


def test_lattice_sums_all_segmentations():
    pieces = [b" a", b"a", b"b", b"ab", b" ab", b" ", b"ba"]
    weight = np.array([3.0, 2, 1, 4, 2, 1, 5])
    lattice = lm_scoring.Lattice.build(pieces, weight, 2.0)
    p = dict(zip(pieces, weight / (weight.sum() + 2), strict=True))

    def total(x: bytes) -> float:
        return 1.0 if not x else sum(q * total(x[len(k) :]) for k, q in p.items() if x.startswith(k))

    words = [b"a", b"ab", b"aba", b"abab", b"bbaab"]
    assert np.allclose(np.exp(lattice.log_marginals(words)), [total(b" " + w) for w in words])
    # long words go another way, with the same result
    before, lm_scoring.LONG = lm_scoring.LONG, 2
    assert np.allclose(lattice.log_marginals(words), np.log([total(b" " + w) for w in words]))
    other = lattice.expected(words, np.ones(len(words)))
    lm_scoring.LONG = before
    assert np.allclose(other, lattice.expected(words, np.ones(len(words))))
    # expected uses: derivative of the log probability by the log of a piece's probability
    uses = lattice.expected(words, np.ones(len(words)))
    for k in range(len(pieces)):
        moved = lm_scoring.Lattice(**{**lattice.__dict__, "logp": lattice.logp + 1e-6 * (np.arange(len(pieces)) == k)})
        assert math.isclose((moved.log_marginals(words) - lattice.log_marginals(words)).sum() / 1e-6, uses[k], abs_tol=1e-4)


def test_lm_odd_rows(odd, empty):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    got = lm_scoring.scored(odd, F.lit(False), path).collect()
    assert len(got) == len(ODD) and sum(r.n_tokens == 1 for r in got) == 3 and all(math.isfinite(r.score) for r in got)
    assert all(r.n_known == r.n_tokens for r in got)
    none = lm_scoring.scored(odd, F.lit(True), path).collect()
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in none)
    assert lm_scoring.scored(empty, F.lit(False), path).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(max_size=30), max_size=5))
def test_words_split_at_ascii_space_only(found):
    w = text.words_of(pa.array(found, pa.string()))
    names = w.names.to_pylist()
    assert [[names[i] for i in w.ids[a:b]] for a, b in zip(w.offsets[:-1], w.offsets[1:], strict=True)] == [WORD.findall(t) for t in found]


def test_one_long_text_does_not_switch_the_classifier_off(spark, docs, labels):
    from loamline.llm import toxicity

    some = labels.where("toxic IS NOT NULL").limit(400)
    mine = docs.join(some.select("doc_id"), "doc_id", "left_semi").select("doc_id", "text")
    bound = 1 << 20
    first = [r[0] for r in spark.range(10_000_000, 10_020_000).orderBy(F.xxhash64("id")).limit(2).collect()]  # ids that sort before nearly all others
    long = spark.createDataFrame([(i, "word " * (bound // 4)) for i in first], "doc_id long, text string")
    told = some.select("doc_id", "toxic").unionByName(spark.createDataFrame([(first[0], 1), (first[1], 0)], "doc_id long, toxic int").selectExpr("doc_id", f"CAST(toxic AS {dict(some.dtypes)['toxic']}) AS toxic"))
    plain, with_long = (toxicity.labelled_sample(d, told, sample_bytes=bound) for d in (mine, mine.unionByName(long)))
    assert sorted(with_long.label.tolist()) == sorted(plain.label.tolist()) and {0, 1} == set(plain.label.tolist())
    only = toxicity.labelled_sample(long, told, sample_bytes=bound)
    assert sorted(only.label.tolist()) == [0, 1]


def test_toxicity_thresholds_count_every_labelled_row(spark):
    """Far more rows than a sample of labels holds, and the few that decide come last by any order of a sample's."""
    from loamline.llm import toxicity

    told = spark.range(9_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 2.0D ELSE -1.0D END + id % 7 / 100D AS logit", "0 AS language")
    labels = told.selectExpr("doc_id", "CAST(logit > 0 AS INT) AS toxic")
    shift = toxicity.thresholds(told, labels)
    assert len(shift) == len(toxicity.LANGUAGES) and all(-0.94 < x <= 2 for x in shift)
    more = told.unionByName(spark.range(9_000, 15_000).selectExpr("id AS doc_id", "1.0D AS logit", "0 AS language"))
    both = labels.unionByName(spark.range(9_000, 15_000).selectExpr("id AS doc_id", "0 AS toxic"))
    assert all(1 < x <= 2 for x in toxicity.thresholds(more, both))
    score = told.limit(1).select(toxicity.calibrated(F.lit(2.0), F.col("language"), [2.0] * 5).alias("s")).first().s
    assert score == 0.5 and toxicity.thresholds(told.limit(0), labels) == [0.0] * 5
