"""The operators on Spark: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tableflow.llm import bpe, components, embedding_dedup, exact_dedup, language_id, licenses, ngram_join, packing, pii, suffix_dedup, toxicity

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY, RANKS = (public_tokenizers.path(f"byte_bpe_50k.{x}") for x in ("json", "tiktoken"))
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def words(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdeilnorst"), 5)) for _ in range(n))


def fixture():
    base, passage = words(1, 120), words(2, 40)
    docs = [(1, None), (2, ""), (3, " \n\t"), (4, "short one"), (5, "SHORT one"), (6, base), (7, base.upper()), (8, base), (9, base[:300] + " " + words(3, 3) + " " + base[300:])]
    docs += [(10 + i, base.replace(base.split()[i], "edited")) for i in range(6)]
    docs += [(20 + i, f"{words(50 + i, 30)} {passage} {words(80 + i, 25)}") for i in range(8)]
    docs += [(40, "é漢字😀 " * 40 + passage), (41, words(9, 30_000)), (42, "ab " * 3000), (43, "ab " * 3000), (44, "x" * 5000), (45, "x" * 5000 + "y")]
    docs += [(50, "mail bob@example.org, 10.0.0.1, 4111 1111 1111 1111, +1 (415) 555-2671, "), (51, "Released under the MIT License."), (52, "123 456 ..."), (53, "one two three four"), (54, "one two three four")]
    return docs


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in fixture()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def clashing(docs):
    """Columns named like those that the operators make."""
    extra = ["fp", "digest", "sid", "batch", "bucket", "part", "ids", "label", "grade", "keep_id", "kept", "component_id", "root", "n", "u", "spans"]
    return docs.select("*", *[F.lit("x").alias(c) for c in extra])


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


EXACT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def test_exact_dedup(docs, empty, clashing):
    assert rows(exact_dedup.exact_dedup(docs), *EXACT) == brute.exact(fixture())
    assert rows(exact_dedup.exact_dedup(clashing), *EXACT) == brute.exact(fixture())
    assert exact_dedup.exact_dedup(empty).count() == 0
    twice = rows(exact_dedup.exact_dedup(docs.where("doc_id in (41, 53)").unionByName(docs.where("doc_id = 41"))), *EXACT[:4])
    assert twice == [(41, 41, 2, True), (41, 41, 2, True), (53, 53, 1, True)]


def test_fingerprints_meet_across_partitions(spark, monkeypatch):
    df = spark.createDataFrame([(i, "same" if i % 3 == 0 else f"text {i}") for i in range(300)], "doc_id long, text string").repartition(7)
    assert exact_dedup.exact_dedup(df).where("group_size = 100").count() == 100


def test_ngram_join(docs, empty, clashing):
    want = brute.jaccard(fixture())
    assert rows(ngram_join.jaccard_components(docs), "doc_id", "n_shingles", "component_id") == want
    assert rows(ngram_join.jaccard_components(clashing), "doc_id", "n_shingles", "component_id") == want
    assert ngram_join.jaccard_components(empty).count() == 0


def test_ngram_join_of_large_buckets(spark, monkeypatch):
    """Buckets over the block size: the same components."""
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    base = words(1, 60).split()
    rng = np.random.default_rng(4)
    texts = []
    for i in range(70):
        w = list(base)
        for at in rng.choice(60, int(rng.integers(0, 4)), replace=False):
            w[at] = f"e{rng.integers(0, 3)}"
        texts.append((i, " ".join(w[: int(rng.integers(48, 61))])))
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert rows(ngram_join.jaccard_components(df), "doc_id", "n_shingles", "component_id") == brute.jaccard(texts)


def test_suffix_dedup(docs, empty, clashing):
    digest = lambda df: rows(suffix_dedup.suffix_dedup(df).withColumn("sha", F.sha2("kept", 256)), "doc_id", "n_bytes", "n_removed", "n_spans", "sha")
    assert digest(docs) == brute.suffix(fixture())
    assert digest(clashing) == brute.suffix(fixture())
    assert digest(empty) == []


def test_suffix_dedup_of_hot_anchors(spark, monkeypatch):
    """Anchors in many batches go string by string; the result is the same."""
    monkeypatch.setattr(suffix_dedup, "HOT", 2)
    monkeypatch.setattr(suffix_dedup, "BATCH", 2000)
    monkeypatch.setattr(suffix_dedup, "SORTED", 50)
    line = words(2, 12)
    texts = [(i, f"{words(100 + i, int(5 + i % 7))} {line} {words(200 + i, 9)}") for i in range(60)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(6)
    got = rows(suffix_dedup.suffix_dedup(df).withColumn("sha", F.sha2("kept", 256)), "doc_id", "n_bytes", "n_removed", "n_spans", "sha")
    assert got == brute.suffix(texts)


def test_packing(docs, empty, clashing):
    for df in (docs, clashing):
        pieces = packing.pack(df, VOCABULARY, RANKS, window=64).collect()
        by_doc = {}
        for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
            have = by_doc.setdefault(p["doc_id"], [])
            assert p["start"] == len(have) and p["length"] * 4 == len(p["ids"])
            have += np.frombuffer(p["ids"], "<u4").tolist()
        assert by_doc == {i: packing.token_ids(t or "", VOCABULARY, None).tolist() for i, t in fixture()}
        sequences = {}
        for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
            assert p["offset"] == sequences.get(p["sequence_id"], 0)
            sequences[p["sequence_id"]] = p["offset"] + p["length"]
        assert all(n == 64 for s, n in sequences.items() if s < max(sequences)) and sorted(sequences) == list(range(len(sequences)))
    digests = packing.piece_digests(packing.pack(docs, VOCABULARY, RANKS, window=64)).collect()
    ids = {(p["doc_id"], p["start"]): p["ids"] for p in pieces}
    assert all(r["ids_crc32"] == zlib.crc32(ids[r["doc_id"], r["start"]]) for r in digests if (r["doc_id"], r["start"]) in ids)
    assert packing.pack(empty, VOCABULARY, RANKS).count() == 0
    first = packing.sequences(packing.pack(docs, VOCABULARY, RANKS, window=64)).where("sequence_id = 0").first()
    assert len(first["ids"]) == 256


def test_bpe(docs, empty, clashing):
    back = bpe.bpe_decode(bpe.bpe_encode(docs, MULTI), MULTI)
    assert rows(back, "doc_id", "text") == sorted((i, t or "") for i, t in fixture())
    want = sorted((i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in fixture())
    assert rows(bpe.bpe_round_trip(clashing, MULTI), "doc_id", "decoded_sha256") == want
    assert bpe.bpe_round_trip(empty, MULTI).count() == 0


def _first_texts(train):
    """Of each language the text that comes first by its hash."""
    drawn = train.where("text is not null and lang is not null").withColumn("draw", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)))
    return [r["t"] for r in drawn.groupBy("lang").agg(F.min_by("text", F.struct("draw", "doc_id")).alias("t")).orderBy("lang").collect()]


def test_language_id(spark, docs, empty):
    parts = {"en": "the and of with that thing there which".split(), "fr": "le la été être pour dans avec qué".split()}
    rng = np.random.default_rng(6)
    make = lambda lang: " ".join(rng.choice(parts[lang], 30))
    train = spark.createDataFrame([(i, make(lang), lang) for i, lang in enumerate(["en", "fr"] * 40)] + [(900, None, "en"), (901, "text", None)], "doc_id long, text string, lang string")
    model = language_id.train(train, per_language=20)
    test = spark.createDataFrame([(i, make(lang), lang) for i, lang in enumerate(["en", "fr"] * 20)] + [(99, None, "x"), (98, "1 2 3", "x"), (97, "", "x")], "doc_id long, text string, lang string")
    got = language_id.identify(test, model).join(test.select("doc_id", "lang"), "doc_id").collect()
    assert all(r["lang_pred"] == r["lang"] for r in got if r["lang"] != "x")
    assert all((r["lang_pred"], r["score"]) == ("und", 0.0) for r in got if r["lang"] == "x")
    assert all(0 <= r["score"] <= 1 for r in got)
    clashing = test.select("*", *[F.lit("x").alias(c) for c in ("lang_pred", "score", "draw", "place")])
    assert sorted(map(tuple, language_id.identify(clashing, model).collect())) == sorted(map(tuple, language_id.identify(test, model).collect()))
    again = language_id.train(train.select("*", *[F.lit("x").alias(c) for c in ("draw", "place", "so_far")]).repartition(5), per_language=20)
    assert all((a == b).all() for x, y in zip(again.trees, model.trees) for a, b in zip(x.counts, y.counts))  # whatever the partitions
    small = language_id.train(train, per_language=20, language_bytes=1)
    assert [int(t.counts[0].sum()) for t in small.trees] == [len(t.encode()) for t in _first_texts(train)]
    long = spark.createDataFrame([(1, make("fr") * 20_000), (2, make("en") + " " + "9" * 3_000_000)], "doc_id long, text string")
    assert {r["doc_id"]: r["lang_pred"] for r in language_id.identify(long, model).collect()} == {1: "fr", 2: "en"}
    strange = [make(x) + " " + c * n for c in "9#漢" for x in ("en", "fr") for n in (1000, 100_000)]  # bytes that neither language has
    assert model.predict(strange)[0] == ["en", "en", "fr", "fr"] * 3
    assert [sum(map(len, [t.counts[0]])) > 0 for t in language_id.train(train, per_language=20, total_bytes=2).trees] == [True, True]
    nothing = language_id.train(empty)
    assert {r["lang_pred"] for r in language_id.identify(docs, nothing).collect()} == {"und"}


def test_toxicity(spark, docs, empty):
    rng = np.random.default_rng(7)
    clean, bad = words(11, 300).split(), ["idiot", "scum", "moron", "trash"]
    def text(toxic):
        w = list(rng.choice(clean, 40))
        for at in rng.choice(40, 3 * toxic, replace=False):
            w[at] = str(rng.choice(bad))
        return " ".join(w)
    labelled = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(600)]
    d = spark.createDataFrame([x[:2] for x in labelled], "doc_id long, text string")
    labels = spark.createDataFrame([x[::2] for x in labelled] + [(5, None), (None, 1), (8, 0)], "doc_id long, toxic int")
    model = toxicity.train(d, labels, "toxic", min_docs=5)
    test = [(i, text(i % 2), i % 2) for i in range(100)] + [(200, None, 0), (201, "", 0)]
    df = spark.createDataFrame(test, "doc_id long, text string, wanted int")
    got = {r["doc_id"]: r for r in toxicity.grade(df, model).collect()}
    assert all(got[i]["rejected"] == bool(w) for i, _, w in test)
    assert min(got[i]["severity"] for i, _, w in test if w) > max(got[i]["severity"] for i, _, w in test if not w)
    assert sorted(r["doc_id"] for r in toxicity.accepted(df, model).collect()) == [i for i, _, w in test if not w]
    for none in (labels.limit(0), labels.where("toxic = 0")):
        flat = toxicity.grade(docs, toxicity.train(d, none, "toxic"))
        assert flat.where("rejected or severity <> 0").count() == 0 and flat.count() == len(fixture())
    assert toxicity.grade(empty, model).count() == 0
    clashing = df.select("*", *[F.lit("x").alias(c) for c in ("grade", "bag", "severity", "rejected")])
    assert sorted(map(tuple, toxicity.grade(clashing, model).collect())) == sorted(map(tuple, toxicity.grade(df, model).collect()))
    assert toxicity.accepted(clashing, model).count() == sum(not w for _, _, w in test)
    # of two labels, of one document or of equal words, the higher counts, in any order of the rows
    again = labels.unionByName(labels.withColumn("toxic", F.lit(0))).repartition(7)
    assert np.allclose(toxicity.train(d, again, "toxic").weights, toxicity.train(d, labels, "toxic").weights)
    long = spark.createDataFrame([(1, text(0) + " plain" * 400_000), (2, "plain " * 400_000 + text(1) + " scum" * 50)], "doc_id long, text string")
    assert {r["doc_id"]: r["rejected"] for r in toxicity.grade(long, model).collect()} == {1: False, 2: True}


def test_toxicity_of_stems_with_many_endings(spark):
    """Each form is rare, the stem is not; four languages, one of them with few positives."""
    rng = np.random.default_rng(19)
    clean = words(31, 300).split()
    stems, endings = {"de": "achlich", "fr": "réeux", "es": "bomente", "en": "worthless"}, words(32, 150).split()
    def text(lang, bad):
        w = list(rng.choice(clean, 40))
        for at in rng.choice(40, 5 * bad, replace=False):
            w[at] = stems[lang] + str(rng.choice(endings))
        return " ".join(w)
    many = {"de": 40, "fr": 40, "es": 25, "en": 150}
    labelled = [(lang, text(lang, k < n), int(k < n)) for lang, n in many.items() for k in range(10 * n)]
    d = spark.createDataFrame([(i, t) for i, (_, t, _) in enumerate(labelled)], "doc_id long, text string")
    model = toxicity.train(d, spark.createDataFrame([(i, y) for i, (_, _, y) in enumerate(labelled)], "doc_id long, toxic int"), "toxic")
    new = [(i, text(lang, bad), bad) for i, (lang, bad) in enumerate([(lang, bad) for lang in many for bad in (0, 1)] * 25)]
    out = {r["doc_id"]: r["rejected"] for r in toxicity.grade(spark.createDataFrame([x[:2] for x in new], "doc_id long, text string"), model).collect()}
    assert np.mean([out[i] for i, _, bad in new if bad]) > 0.97 and np.mean([out[i] for i, _, bad in new if not bad]) < 0.02


def test_toxicity_of_a_long_tail(spark):
    """Words in a small share of the toxic documents each, more of them than 256, and a table with few positives."""
    rng = np.random.default_rng(17)
    clean, tail = words(21, 400).split(), [f"slur{i}" for i in range(300)]
    text = lambda *bad: " ".join([*rng.choice(clean, 30), *bad])
    labelled = [(i, text(*([tail[i % 300], tail[i % 300]] if i < 3000 else [])), int(i < 3000)) for i in range(9000)]
    few = [(i, text(*(["scum"] if i < 8 else [])), int(i < 8)) for i in range(200)]
    for rows_, bad in ((labelled, tail), (few, ["scum"])):
        d = spark.createDataFrame([x[:2] for x in rows_], "doc_id long, text string")
        model = toxicity.train(d, spark.createDataFrame([x[::2] for x in rows_], "doc_id long, toxic int"), "toxic")
        new = [(i, text(w, w)) for i, w in enumerate(bad)] + [(1000 + i, text()) for i in range(100)]
        out = {r["doc_id"]: r["rejected"] for r in toxicity.grade(spark.createDataFrame(new, "doc_id long, text string"), model).collect()}
        assert out == {i: i < 1000 for i, _ in new}


def test_pii(docs, empty, clashing):
    detector = pii.train(docs)
    want = sorted((i, *[sum(s[2] == k for s in brute.base_spans(t)) for k in range(4)], hashlib.sha256(pii.written(brute.base_spans(t)).encode()).hexdigest()) for i, t in fixture())
    columns = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert rows(pii.detect(docs, detector), *columns) == want
    assert rows(pii.detect(clashing, detector), *columns) == want
    red = {r["doc_id"]: r["text"] for r in pii.redact(docs, detector).collect()}
    assert red[50] == "mail [email], [ip], [card], [phone], " and red[1] is None and red[6] == dict(fixture())[6]
    assert pii.detect(empty, pii.train(empty)).count() == 0


def test_added_spans_keep_base_spans(spark):
    rng = np.random.default_rng(8)
    texts = []
    for i in range(400):
        phone = f"+1 ({rng.integers(200, 999)}) 555-{rng.integers(1000, 9999)}"
        texts.append((i, f"{words(i, 5)} call {phone if i % 2 else phone[3:]} or pay {rng.integers(10, 99)}.{rng.integers(10, 99)} {words(i, 4)}"))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    out = {r["doc_id"]: r for r in pii.detect(df, pii.train(df)).collect()}
    for i, t in texts:
        assert set(filter(None, pii.written(brute.base_spans(t)).split(","))) <= set(out[i]["spans"].split(","))


def test_loose_forms_are_added_and_redacted(spark):
    """Planted phones and mails that the base rules do not know, in a table of any size; numbers that are no personal data stay."""
    planted = {"call (415) 555-2671 now": ("phone", "call [phone] now"), "tel 415-555-2671 or": ("phone", "tel [phone] or"), "see bob (at) example (dot) org soon": ("email", "see [email] soon"), "ask ann.lee [at] mail.example.com today": ("email", "ask [email] today")}
    stays = ["on 2021-03-04 it", "of 04.03.2021 the", 'token = "0641917ea4e9feb9c1234567890"', "paid 1.234.567 for it", "pi is 3.14159265 or", "from 1999-2003 on", "id a12345678901b"]
    for n in (1, 120):
        texts = [f"{words(i, 4)} {t} {words(i + 500, 4)}" for i in range(n) for t in [*planted, *stays]]
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        detector = pii.train(df)
        out = {r["doc_id"]: r for r in pii.detect(df, detector).collect()}
        red = {r["doc_id"]: r["text"] for r in pii.redact(df, detector).collect()}
        for i, t in enumerate(texts):
            k = i % (len(planted) + len(stays))
            was = [*planted, *stays][k]
            kind, now = list(planted.values())[k] if k < len(planted) else (None, was)
            assert (out[i]["n_added"], out[i]["spans"].split(":")[0] or None) == (int(kind is not None), kind), t
            assert red[i] == t.replace(was, now)
    assert all(r["precision"] >= 0.95 and r["recall"] > 0.8 for r in detector.report.values()), detector.report


def test_licenses(docs, empty, clashing):
    for df in (docs, clashing):
        got = {r["doc_id"]: (r["n_licenses"], r["license"]) for r in licenses.scan_licenses(df).collect()}
        assert got == {i: (1, "MIT") if i == 51 else (0, None) for i, _ in fixture()}
    assert licenses.scan_licenses(empty).count() == 0


def test_licenses_with_wide_gaps():
    """Words of a notice in order, but far apart, are no license; a copy with fewer words between its own than it may have is one."""
    scan = licenses.Scanner(licenses.TEMPLATES, licenses.LEAST).scan
    mit = "released under the mit license".split()
    spread = f"released {words(1, 3000)} under {words(2, 3000)} the {words(3, 4000)} mit {words(4, 3000)} license"
    assert scan(spread) == [] and scan(" ".join(f"{w} {words(5, 30)}" for w in mit)) == []
    most = licenses.Scanner.widest(5) - 5
    for at in range(1, 5):
        near, far = (" ".join([*mit[:at], words(6, n), *mit[at:]]) for n in (most, most + 1))
        assert [x[0] for x in scan(near)] == ["MIT"] and scan(far) == [], at
        assert [x[0] for x in scan(f"{words(7, 500)} {near} {spread} {near}")] == ["MIT", "MIT"]
    for name, text in licenses.TEMPLATES.items():
        body = licenses.words(text)
        gaps = [w for i, w in enumerate(body) for w in ([w, "in", "between"] if i % 3 == 1 else [w])]
        assert name in [x[0] for x in scan(" ".join(gaps))] or len(body) < 6, name
        assert scan(" ".join(f"{w} {words(8, 40)}" for w in body)) == [], name


def test_licenses_that_lack_their_rarest_words(spark):
    header = licenses.words(licenses.TEMPLATES["Apache-2.0-header"])
    edited = ["edited" if w in ("governing", "permissions", "compliance") else w for w in header]
    both = " ".join(header) + f" {words(1, 300)} " + " ".join(edited)
    # all but three words occur twice elsewhere, those three once and never in the notice
    apart = f" {words(2, 40)} ".join([*edited, *(w for w in edited for _ in range(2)), "governing", "permissions", "compliance"])
    once = " ".join(edited) + " " + apart
    inserted = " ".join(["Released under the", words(3, 30), "MIT License"])
    scattered = " ".join(["MIT License", words(4, 30), "released under the"])
    df = spark.createDataFrame(list(enumerate([both, once, inserted, scattered, " ".join(edited[12:])])), "doc_id long, text string")
    got = {r["doc_id"]: r for r in licenses.scan_licenses(df).collect()}
    assert (got[0]["n_licenses"], got[0]["licenses"]) == (2, "Apache-2.0-header,Apache-2.0-header")
    for i, text in enumerate([" ".join(edited), inserted]):
        name = ["Apache-2.0-header", "MIT"][i]
        whole = licenses.align(licenses.words(licenses.TEMPLATES[name]), licenses.words(text))
        assert (got[1 + i]["license"], got[1 + i]["coverage"]) == (name, len(whole) / len(licenses.words(licenses.TEMPLATES[name])))
    assert [got[i]["n_licenses"] for i in (3, 4)] == [0, 0]


def test_embeddings(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(60, 24))
    vectors = [(i, base[i].tolist(), int(i % 2)) for i in range(60)]
    vectors += [(100 + i, (base[i] + rng.normal(size=24) * 0.05 * (i % 7)).tolist(), int(i % 2)) for i in range(40)]
    vectors += [(200 + i, base[0].tolist(), 0) for i in range(5)] + [(210, base[0].tolist(), 1), (211, (base[0] * 3).tolist(), 0)]
    x = {i: np.array(v) for i, v, _ in vectors}
    bad = [(300, None, 0), (301, [0.0] * 24, 0), (302, [float("nan")] + [1.0] * 23, 0), (303, [None] + [1.0] * 23, 0), (304, base[0].tolist(), None), (305, [], 0), (306, [float("inf")] * 24, 0), (307, [1.0, 2.0], 0)]
    df = spark.createDataFrame(vectors + bad, "vec_id long, embedding array<double>, label int").withColumn("u", F.lit(1)).repartition(3)
    label = {i: k for i, _, k in vectors}
    cos = lambda a, b: float(a @ b / np.sqrt((a @ a) * (b @ b)))
    links = [(i, j) for i in x for j in x if i != j and label[i] == label[j] and cos(x[i], x[j]) >= 0.93]
    ids = sorted([*x, *[b[0] for b in bad]])
    root = brute.components(ids, links)
    want = [(i, sum(a == i for a, _ in links), root[i], root[i] == i) for i in ids]
    assert rows(embedding_dedup.near_duplicates(df, sigmas=None), "vec_id", "n_links", "component_id", "kept") == want
    found = rows(embedding_dedup.near_duplicates(df), "vec_id", "n_links", "component_id", "kept")
    assert sum(r[1] for r in found) >= 0.9 * len(links)
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0
    # an id with several vectors, vectors without an id
    more = df.drop("u").unionByName(spark.createDataFrame([(1, base[0].tolist(), 0), (None, base[0].tolist(), 0), (None, base[1].tolist(), 1)], "vec_id long, embedding array<double>, label int"))
    again = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(more).collect()}
    first = {r[0]: r for r in want}
    assert len(again) == len(want) + 1 and again[None]["n_links"] == 0 and again[None]["kept"] and again[1]["component_id"] == first[0][2]


@pytest.mark.parametrize("rank", [2, 4, 8])
def test_every_link_of_vectors_of_low_rank(spark, rank, monkeypatch):
    """Clusters and chains in few dimensions, labels of very different sizes, several lengths; also in many runs, blocks and slices."""
    rng = np.random.default_rng(rank)
    axes = np.linalg.qr(rng.normal(size=(48, rank)))[0].T
    x = [rng.normal(size=rank) @ axes for _ in range(260)]
    x += [x[i] + 0.15 * rng.normal(size=rank) @ axes for i in range(120)]
    label = [0 if i % 3 else i % 7 for i in range(len(x))]
    x += [v[:40] for v in x[:80]] + [np.ones(3 + i) for i in range(6)]
    label += label[:80] + [0] * 6
    df = spark.createDataFrame([(i, v.tolist(), k) for i, (v, k) in enumerate(zip(x, label, strict=True))], "vec_id long, embedding array<double>, label int").repartition(3)
    cos = lambda a, b: float(a @ b / np.sqrt((a @ a) * (b @ b)))
    links = [(i, j) for i in range(len(x)) for j in range(len(x)) if i != j and label[i] == label[j] and len(x[i]) == len(x[j]) and cos(x[i], x[j]) >= 0.93]
    root = brute.components(range(len(x)), links)
    n = np.bincount([a for a, _ in links], minlength=len(x))
    want = [(i, int(n[i]), root[i], root[i] == i) for i in range(len(x))]
    assert len(links) > 100 and rows(embedding_dedup.near_duplicates(df), "vec_id", "n_links", "component_id", "kept") == want
    if rank == 4:
        monkeypatch.setattr(embedding_dedup, "BLOCK", 20)
        monkeypatch.setattr(embedding_dedup, "QUERIES", 30)
        assert rows(embedding_dedup.near_duplicates(df), "vec_id", "n_links", "component_id", "kept") == want


def test_embeddings_along_few_directions(spark, monkeypatch):
    """Vectors on a plane: neighbours across a cell's border lie along the line between two centres. Also in many runs, blocks and slices."""
    rng = np.random.default_rng(12)
    angle = rng.permutation(np.concatenate([np.arange(0, 4, 0.05), 4.6 + 0.05 * np.arange(20)]))
    axes = np.linalg.qr(rng.normal(size=(64, 2)))[0].T
    x = np.stack([np.cos(angle), np.sin(angle)], 1) @ axes + rng.normal(size=(len(angle), 64)) * 1e-4
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int").repartition(3)
    cosines = x @ x.T / np.outer(*[np.sqrt((x * x).sum(1))] * 2)
    links = [(i, j) for i, j in zip(*map(np.ndarray.tolist, np.nonzero(cosines >= 0.93)), strict=True) if i != j]
    root = brute.components(range(len(x)), links)
    want = [(i, sum(a == i for a, _ in links), root[i], root[i] == i) for i in range(len(x))]
    assert rows(embedding_dedup.near_duplicates(df), "vec_id", "n_links", "component_id", "kept") == want
    monkeypatch.setattr(embedding_dedup, "BLOCK", 4)
    monkeypatch.setattr(embedding_dedup, "QUERIES", 16)
    assert rows(embedding_dedup.near_duplicates(df), "vec_id", "n_links", "component_id", "kept") == want
    monkeypatch.setattr(embedding_dedup, "TABLED", 3)  # queries by their tables, lists with the rows instead of broadcast
    monkeypatch.setattr(embedding_dedup, "SHARED_LISTS", 0)
    assert rows(embedding_dedup.near_duplicates(df), "vec_id", "n_links", "component_id", "kept") == want


def test_components(spark):
    rng = np.random.default_rng(10)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(100)] + [(7, 7), (7, None)]
    df = spark.createDataFrame(links, "a long, b long")
    real = [(a, b) for a, b in links if b is not None]
    want = brute.components({x for l in real for x in l}, real)
    assert dict(map(tuple, components.components(df).collect())) == want
    assert components.components(df.limit(0)).count() == 0


def test_components_of_hubs(spark, monkeypatch):
    """Nodes with a large share of all links, as the smallest, the greatest and a middle node, and a chain through them: dealt over tasks."""
    from tableflow.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 5)
    links = [(0, 10 + i) for i in range(150)] + [(9000, 1000 + i) for i in range(150)] + [(5000, 4900 + i) for i in range(200)] + [(159, 1003), (4000, 4001), (4001, 4002)]
    dealt = []
    real = common.spread_join
    monkeypatch.setattr(common, "spread_join", lambda *a: dealt.append(len(a[3])) or real(*a))
    df = spark.createDataFrame(links, "a long, b long").repartition(4)
    assert dict(map(tuple, components.components(df).collect())) == brute.components({x for k in links for x in k}, links)
    assert max(dealt) > 0


def test_rows_without_an_id(spark):
    """They take part like any other row; what they get is stated with each operator."""
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(1, text), (None, text), (2, text.upper()), (None, "alone " + text[:60]), (None, None)], "doc_id long, text string").repartition(3)
    count = lambda out: sorted((r["doc_id"] or 0) for r in out.select("doc_id").collect())
    for out in (bpe.bpe_encode(df, MULTI), packing.pack(df, VOCABULARY, RANKS), licenses.scan_licenses(df), pii.detect(df, pii.train(df)), toxicity.grade(df, toxicity.train(df, df.select("doc_id", F.lit(1).alias("grade")))), language_id.identify(df, language_id.train(df.withColumn("lang", F.lit("en"))))):
        assert count(out) == [0, 0, 0, 1, 2]
    plain = lambda out, *c: sorted(map(tuple, out.select(*c).collect()), key=repr)
    assert plain(exact_dedup.exact_dedup(df), "doc_id", "keep_id", "group_size", "kept") == sorted([(1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False), (None, None, 1, True), (None, None, 1, True)], key=repr)
    assert plain(ngram_join.jaccard_components(df), "doc_id", "n_shingles", "component_id") == sorted([(1, 26, 1), (2, 26, 1), (None, 26, 1), (None, 15, None), (None, 0, None)], key=repr)
    assert plain(suffix_dedup.suffix_dedup(df), "doc_id", "n_bytes", "n_removed") == sorted([(1, 109, 0), (2, 109, 0), (None, 109, 109), (None, 66, 60), (None, 0, 0)], key=repr)


def test_repeated_rows(spark):
    """Given twice, a row gets the same result twice, and counts as two where rows are counted."""
    once = [(i, t) for i, t in fixture() if i in (1, 4, 6, 9, 20, 21, 50, 51)]
    df = spark.createDataFrame(once, "doc_id long, text string")
    twice = df.unionByName(df).repartition(3)
    detector, model = pii.train(df), language_id.train(df.withColumn("lang", F.lit("en")))
    grader = toxicity.train(df, df.select("doc_id", (F.col("doc_id") > 9).cast("int").alias("grade")))
    for make in (lambda d: pii.detect(d, detector), lambda d: language_id.identify(d, model), lambda d: toxicity.grade(d, grader), lambda d: bpe.bpe_round_trip(d, MULTI), licenses.scan_licenses, ngram_join.jaccard_components, suffix_dedup.suffix_dedup):
        columns = make(df).columns
        assert sorted(map(repr, make(twice).select(*columns).collect())) == sorted(2 * list(map(repr, make(df).select(*columns).collect())))
    tokens = lambda d: {r["doc_id"]: r["n"] for r in packing.pack(d, VOCABULARY, RANKS).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert tokens(twice) == {k: 2 * n for k, n in tokens(df).items()}


def test_one_row_of_each_group_stays(spark):
    """Exact and near copies, rows repeated as a whole, an id with two texts, rows without an id, clashing columns."""
    base = words(1, 60)
    near = base.replace(base.split()[30], "edited")
    data = [(1, base), (1, base), (2, base.upper()), (3, near), (3, words(5, 40)), (4, words(6, 40)), (4, words(6, 40)), (None, base), (None, words(7, 40)), (None, words(7, 40)), (5, None), (6, "")]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in data], "doc_id long, text string, _key string, stays int").repartition(4)
    exact = exact_dedup.without_copies(df)
    assert exact.columns == df.columns
    left = sorted(((r["doc_id"], r["text"]) for r in exact.collect()), key=repr)
    assert left == sorted([(2, base.upper()), (3, near), (3, words(5, 40)), (4, words(6, 40)), (None, words(7, 40)), (6, "")], key=repr)
    kept = sorted(((r["doc_id"], r["text"]) for r in ngram_join.without_near_copies(df).collect()), key=repr)
    assert kept == sorted([(1, base), (3, words(5, 40)), (4, words(6, 40)), (None, words(7, 40)), (5, None), (6, "")], key=repr)


def test_very_common_ngrams(spark, monkeypatch):
    """A line that every document has, hot sets, small chunks and buckets: the same components."""
    monkeypatch.setattr(ngram_join, "CHUNK_SETS", 40)
    monkeypatch.setattr(ngram_join, "CHUNK_ROWS", 50)
    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join.common, "HOT_ROWS", 5)
    line = words(3, 24)
    data = [(i, f"{line} {words(100 + i, 4 + i % 9)}") for i in range(150)] + [(200 + i, line) for i in range(60)] + [(300 + i, f"{line} {words(100 + i, 4 + i % 9)} x") for i in range(30)]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    assert rows(ngram_join.jaccard_components(df), "doc_id", "n_shingles", "component_id") == brute.jaccard(data)


def test_arrow_slices():
    import pyarrow as pa

    from tableflow.llm import common

    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(["a" * 5, "a" * 50, "a", None, "aaa", "aa", "a" * 9])], ["i", "t"])
    parts = list(common.slices(batch, rows=3, size=10))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert all(p.num_rows <= 3 and (p.num_rows == 1 or sum(len(t or "") for t in p.column("t").to_pylist()) <= 10) for p in parts)
