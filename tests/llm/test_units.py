"""Parts of the operators that need no Spark."""

import base64
import math
import re
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tableflow.llm import bpe, embedding_dedup, exact_dedup, language_id, licenses, ngram_join, packing, pii, suffix_dedup, toxicity

from . import brute

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    with open(MULTI, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\t\x1c\xa0aAbcdeilnorst0123½²éßñ_-.!'漢字😀́ǅ", max_size=80))
def test_bpe_equals_the_library(reference_encoding, text):
    ids = bpe.load(MULTI).encode(text)
    assert ids.tolist() == reference_encoding.encode_ordinary(text)
    assert bpe.load(MULTI).decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20000, "ab" * 9000, "=-" * 3000, " " * 5000, "", "Ünïcödé " * 500])
def test_bpe_of_very_long_pretokens(reference_encoding, text):
    assert bpe.load(MULTI).encode(text).tolist() == reference_encoding.encode_ordinary(text)


def test_both_token_libraries_agree():
    vocabulary, ranks = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
    for text in ["", "plain text, 123", "é漢字😀 \n\n  x", "a <|endoftext|> b", "word " * 300]:
        assert packing.token_ids(text, vocabulary, ranks).tolist() == packing.token_ids(text, vocabulary, None).tolist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**40 - 1), max_size=60), min_size=1, max_size=5), st.integers(40, 64))
def test_quotient_filters_merge_losslessly(parts, width):
    parts = [p + p[:5] + parts[0][:3] for p in parts]
    build = lambda x: exact_dedup.CountingQuotientFilter.build(np.array(x, np.uint64), width)
    whole = exact_dedup.CountingQuotientFilter.merge([exact_dedup.CountingQuotientFilter.loads(build(p).dumps()) for p in parts])
    flat = [v for p in parts for v in p]
    assert dict(zip(whole.fingerprints().tolist(), whole.counts().tolist())) == {v: flat.count(v) for v in set(flat)}


def test_quotient_filters_are_smaller_than_their_fingerprints():
    rng = np.random.default_rng(2)
    fp = rng.integers(0, 2**56, 70_000, dtype=np.uint64)
    counts = np.where(np.arange(70_000) % 100 == 0, 300, 1)
    f = exact_dedup.CountingQuotientFilter.build(fp, 56, counts)
    assert len(f.dumps()) < 0.75 * 8 * len(fp)
    back = exact_dedup.CountingQuotientFilter.loads(f.dumps())
    order = np.argsort(fp)
    assert (back.fingerprints() == fp[order]).all() and (back.counts() == counts[order]).all()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 3), st.integers(1, 250))
def test_deep_shallow_sort(seed, letters, n):
    rng = np.random.default_rng(seed)
    data = rng.integers(97, 97 + letters, 400).astype(np.uint8)
    data[200:300] = data[:100]
    starts = rng.integers(0, 350, n)
    order, new = suffix_dedup.deep_shallow_sort(data, starts)
    text = data.tobytes()
    want = sorted(text[s : s + 50] for s in starts)
    assert [text[starts[i] : starts[i] + 50] for i in order] == want
    assert new.tolist() == [True] + [x != y for x, y in zip(want, want[1:])]


def test_anchors_cover_every_start_once():
    texts = [b"x" * 200, b"", b"short", bytes(np.random.default_rng(1).integers(97, 105, 3000).astype(np.uint8))]
    seen = set()
    for _, _, text, begin, count, first in suffix_dedup.segments(texts):
        base = [0, 200, 200, 205]
        for t, s, n in zip(text.tolist(), begin.tolist(), count.tolist()):
            seen |= {(t + first, s - base[t + first] + k) for k in range(n)}
    assert seen == {(0, s) for s in range(151)} | {(3, s) for s in range(2951)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(0, 14), min_size=1, max_size=12), min_size=1, max_size=14))
def test_prefix_tree_finds_the_components(sets):
    arrays = [np.array(sorted(s), np.uint64) for s in sets]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    found = ngram_join.PrefixTree(arrays, 75).join()
    assert all(100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]) for i, j in found)
    assert brute.components(range(len(sets)), found) == brute.components(range(len(sets)), links)


def test_prefix_tree_leaves_a_template_at_once():
    """Sets that share a common part too small to link: no walk meets their other n-grams."""
    shared = np.arange(76, dtype=np.uint64)
    tree = ngram_join.PrefixTree([np.concatenate([shared, 1000 + 100 * i + np.arange(24, dtype=np.uint64)]) for i in range(200)], 75)
    calls = []
    check = tree._hopeless
    tree._hopeless = lambda *a: calls.append(1) or check(*a)
    assert tree.join() == [] and len(calls) <= 4 * 200


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\x0b\x0c\r\x1c\xa0aAbé", max_size=60), max_size=6), st.integers(1, 5))
def test_shingle_sets_tell_word_sequences_apart(texts, n):
    """As many hashes as there are distinct n-grams, equal ones where the n-grams are, whatever else is hashed beside them."""
    sets = ngram_join.shingle_sets([t.encode() for t in texts], n)
    plain = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", brute.fold(t))
        plain.append({tuple(w)} if 0 < len(w) < n else {tuple(w[i : i + n]) for i in range(len(w) - n + 1)})
    assert [len(s) for s in sets] == [len(p) for p in plain] and all((np.diff(s.astype(object)) > 0).all() for s in sets)
    for s, p in zip(sets, plain):
        for s2, p2 in zip(sets, plain):
            assert len(np.intersect1d(s, s2)) == len(p & p2)
    assert all((ngram_join.shingles(t.encode(), n) == s).all() for t, s in zip(texts, sets))


def test_words_across_steps(monkeypatch):
    texts = [b" ".join(b"%x" % (i * 7919 % 10007) * (1 + i % 9) for i in range(3000)), b"y" * 5000 + b" end", b"z" * 64 + b" " + b"z" * 65]
    want = ngram_join.shingle_sets(texts)
    monkeypatch.setattr(ngram_join, "STEP", 100)
    assert all((a == b).all() for a, b in zip(want, ngram_join.shingle_sets(texts)))


def test_packed_steps():
    for values in ([], [5], [0, 1, 2**40], list(range(0, 10**6, 999))):
        v = np.array(values, np.uint64)
        if len(v):
            assert ngram_join._from_steps(ngram_join._steps(v)).tolist() == values
        assert suffix_dedup.unpacked(suffix_dedup.packed(v)).tolist() == values


def test_context_tree_is_a_code():
    tree = language_id.ContextTree([b"abracadabra abracadabra", b"barbara"])
    for context in (b"abr", b"xyz", b"\n\n\n", b"bar"):
        keys = np.array([int.from_bytes(context + bytes([c]), "big") for c in range(256)], np.uint32)
        assert np.exp2(-tree.bits(keys)).sum() <= 1 + 1e-9


def test_tabled_code_lengths_equal_the_trees():
    model = language_id.Model({"en": [b"the quick brown fox " * 20], "fr": ["le renard brun à côté ".encode() * 20]})
    text = "the fox à zürich \x01".encode()
    data = b"\n\n\n" + text
    keys = np.array([int.from_bytes(data[i : i + 4], "big") for i in range(len(text))], np.uint32)
    assert np.allclose(model.code_lengths([text])[0], [tree.bits(keys).sum() for tree in model.trees], rtol=1e-4)
    assert model.predict(["le renard", "the fox", "123 …", ""])[0] == ["fr", "en", "und", "und"]


def _graded(seed, n, grades):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(n):
        k = int(rng.integers(0, 6))
        grade = int(np.clip(k - 1 + rng.integers(-1, 2), 0, grades - 1))
        rows.append((grade, [0, 1] if k else [1], np.array([float(k), 1.0]) if k else np.array([1.0])))
    return rows


def test_ordinal_fit_shares_weights():
    rows = _graded(3, 800, 4)
    grades, w, theta = toxicity.fit(rows, 2)
    assert grades == [0, 1, 2, 3] and w[0] > 1 and (np.diff(theta) > 0).all()
    model = toxicity.OrdinalModel(["bad", "the"], grades, w, theta)
    severity = model.at_least(np.array([0.0, w[0] * 2, w[0] * 5])).sum(1)
    assert severity[0] < severity[1] < severity[2] <= 3


@pytest.mark.parametrize("grades", [2, 3, 5])
def test_likelihood_is_the_cumulative_link(grades):
    """The value against plain differences of probabilities, the slope against finite differences, the fit against a stationary point."""
    rows = _graded(grades, 60, grades)
    names = sorted({g for g, _, _ in rows})
    loss = toxicity.Likelihood(rows, 2, names, 0.3)
    b = loss.start() + np.random.default_rng(1).normal(size=2 + len(names) - 1) * 0.3
    theta = loss.thresholds(b)
    assert (np.diff(theta) > 0).all()
    plain = 0.3 / 2 * (b[:2] ** 2).sum()
    for g, at, x in rows:
        s, k = float(b[:2][at] @ x), names.index(g)
        upper = 1 / (1 + math.exp(s - theta[k])) if k < len(theta) else 1.0
        lower = 1 / (1 + math.exp(s - theta[k - 1])) if k else 0.0
        plain -= math.log(upper - lower)
    value, slope = loss(b)
    assert abs(value - plain) < 1e-8 * abs(plain)
    for i in range(len(b)):
        step = np.zeros(len(b))
        step[i] = 1e-6
        assert abs((loss(b + step)[0] - loss(b - step)[0]) / 2e-6 - slope[i]) < 1e-4 * max(1, abs(slope[i]))
    _, w, theta = toxicity.fit(rows, 2)
    at = np.concatenate([w, theta[:1], np.log(np.diff(theta))])
    assert np.abs(loss(at)[1]).max() < 1e-2


def test_cut_is_where_f1_is_best():
    p, high = np.array([0.9, 0.8, 0.7, 0.3, 0.2, 0.1]), np.array([1, 1, 0, 1, 0, 0], bool)
    cut = toxicity.best_cut(p, high)
    scores = {c: (lambda r: 2 * (r & high).sum() / (r.sum() + high.sum()))(p >= c) for c in (0.95, 0.85, 0.75, 0.5, 0.25, 0.15)}
    rejected = p >= cut
    assert 2 * (rejected & high).sum() / (rejected.sum() + high.sum()) == max(scores.values())
    assert toxicity.best_cut(np.array([np.nan, 0.4]), np.array([True, False])) == 0.5


def test_features_are_words_and_their_beginnings():
    assert toxicity.words("Ächlich_x, IDIOT's 42!") == ["ächlich", "x", "idiot", "s", "42"]
    assert toxicity.parts("abcde") == ["abcde", "abc*", "abcd*"] and toxicity.parts("ab") == ["ab"]
    assert len(toxicity.parts("a" * 5000)) == 1 + toxicity.LONGEST - toxicity.SHORTEST + 1


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab@.-_+%1234567890 ()\né", max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == brute.base_spans(text)


@pytest.mark.parametrize("text", ["mail a.b@c.de, x@y.zz_q@r.st", "ip 1.2.3.4.5.6.7.8 300.1.1.1", "card 4111 1111 1111 1111 and +1 (415) 555-2671", "1" * 3000 + "@" + "a" * 3000, "a" * 5000 + "@x", "+" * 100 + "9" * 20])
def test_base_spans_of_hard_texts(text):
    assert pii.base_spans(text) == brute.base_spans(text)


def test_boosted_trees_learn():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    p = pii.BoostedTrees().fit(x[:400], y[:400]).predict(x[400:])
    assert ((p > 0.5) == y[400:]).mean() > 0.93


def test_isotonic_steps():
    p, y = np.array([0.1, 0.2, 0.3, 0.4, 0.4, 0.9]), np.array([0, 1, 0, 1, 1, 1.0])
    at, value = pii.isotonic(p, y)
    assert np.allclose(at, [0.0, 0.15, 0.35]) and value.tolist() == [0.0, 0.5, 1.0]
    found = pii.Detector(None, np.zeros(4), [(at, value)] * 4)
    assert [found.probability(0, x) for x in (0.0, 0.14, 0.25, 0.34, 0.36, 0.95)] == [0.0, 0.0, 0.5, 0.5, 1.0, 1.0]


def test_candidates_overlap_no_base_span():
    text = "call 415-555-2671 or +1 415 555 2671, bob (at) site (dot) org, a@b.org"
    base = pii.base_spans(text)
    found = pii.candidates(text, base)
    assert any(k == 0 for _, _, k in found) and any(k == 3 for _, _, k in found)
    assert all(e <= s2 or e2 <= s for s, e, _ in found for s2, e2, _ in base)
    assert pii.redact_text("x a@b.org y", [(2, 9, 0)]) == "x [email] y"


def test_patience():
    assert licenses.longest_increasing([3, 1, 2, 9, 4, 5]) == [1, 2, 4, 5]
    a = "the quick brown fox jumps over the lazy dog".split()
    b = "well the very quick brown cat jumps over the dog".split()
    pairs = licenses.align(a, b)
    assert all(a[i] == b[j] for i, j in pairs) and [a[i] for i, _ in pairs] == "the quick brown jumps over the dog".split()


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row[:]
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(row[j], before[j + 1])
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefgh"), max_size=14), st.lists(st.sampled_from("abcdefghxyz"), max_size=30))
def test_alignments_and_the_longest_common_subsequence(a, b):
    pairs = licenses.align(a, b)
    assert licenses.longest_common(a, b) == _lcs(a, b) >= len(pairs)
    assert all(a[i] == b[j] for i, j in pairs) and all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:]))


@pytest.mark.parametrize("name", sorted(licenses.TEMPLATES))
def test_edited_copies_are_found_as_brute_force_finds_them(name):
    """Words replaced, left out and inserted at random, in a longer text: reported where the longest common subsequence has the coverage and the edits leave anchors."""
    rng = np.random.default_rng(len(name))
    scanner = licenses.Scanner({name: licenses.TEMPLATES[name]}, 0.9)
    template = scanner.templates[name]
    for n_edits in (0, 1, len(template) // 12, len(template) // 4):
        body = list(template)
        for at in sorted(rng.choice(len(body), min(n_edits, len(body)), replace=False))[::-1]:
            body[at : at + 1] = [["edit"], [], [body[at], "more", "words"]][int(rng.integers(3))]
        text = ["before"] * 40 + body + ["after"] * 40
        want = _lcs(template, text) / len(template)
        found = scanner.scan(" ".join(text))
        assert bool(found) == (want >= 0.9) and all(c <= want for _, c, _, _ in found)


def test_a_full_text_beside_an_edited_copy():
    full = licenses.words(licenses.TEMPLATES["MIT-full"])
    copy = list(full)
    for at in range(5, len(copy), 24):
        copy[at] = "edited"
    found = licenses.Scanner(licenses.TEMPLATES, 0.9).scan(" ".join([*full, "and", "then", *copy]))
    assert [n for n, *_ in found] == ["MIT-full", "MIT-full"] and found[0][1] == 1.0
    sentence = licenses.words(licenses.TEMPLATES["BSD-text"])
    apart = [*sentence[:10], *["inserted"] * 12, *sentence[10:]]
    assert [n for n, *_ in licenses.Scanner(licenses.TEMPLATES, 0.9).scan(" ".join(apart))] == ["BSD-text"]


def test_templates_that_tie():
    """Two names for one text: the first by name; equal coverage apart: each."""
    two = licenses.Scanner({"B": "one two three four five", "A": "one two three four five", "C": "six seven eight nine ten"}, 0.9)
    assert [n for n, *_ in two.scan("one two three four five, six seven eight nine ten")] == ["A", "C"]


def test_license_scanner():
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.LEAST)
    noise = "lorem the of under license " * 50
    text = f"{noise}\nReleased under the MIT License.\n{noise} Licensed under the Apache License, Version 2.0. {noise}"
    assert sorted(n for n, *_ in scanner.scan(text)) == ["Apache-2.0", "MIT"]
    assert [n for n, *_ in scanner.scan(licenses.TEMPLATES["Apache-2.0-header"].replace("compliance", "conformity"))] == ["Apache-2.0-header"]
    assert len(scanner.scan("Released under the MIT License. " * 3)) == 3
    assert scanner.scan("") == [] and scanner.scan(noise) == []


def test_index_probes_and_codes():
    rng = np.random.default_rng(0)
    x = embedding_dedup.normalised(rng.normal(size=(500, 16)))
    index = embedding_dedup.Index(x, 8)
    reach = math.sqrt(0.14)
    home, probed = index.probes(x, reach, None)
    near = embedding_dedup.squared(x, x) <= reach**2
    assert all(probed[i, home[j]] for i, j in zip(*np.nonzero(near)))
    codes, error = index.encode(x - index.centres[0])
    tabled = np.sqrt(index.tabled(x[:20] - index.centres[0], codes))
    exact = np.sqrt(embedding_dedup.squared(x[:20], x))
    assert (np.abs(tabled - exact) <= error[None, :] + 1e-6).all()


def test_toxicity_words_remembered_are_few():
    """A worker that meets a hundred thousand words holds some megabytes for them, and knows their features all the same."""
    model = toxicity.OrdinalModel(["bad", "bad*", "wor*"], [0, 1], np.ones(3), np.zeros(1))
    tracemalloc.start()
    try:
        assert all(model.of_word(f"word{i}") == (2,) for i in range(100_000))
        assert tracemalloc.get_traced_memory()[1] < 8 << 20
    finally:
        tracemalloc.stop()
    assert model.of_word("badly") == (1,) and model.of_word("word7") == (2,)
