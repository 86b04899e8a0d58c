"""The registered queries over the smallest given tables, against plain versions of their contracts."""

import base64
import hashlib
import os
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from pyspark.sql import functions as F

from tableflow.llm import licenses, toxicity
from tableflow.llm.queries import ORACLE_SQL, QUERIES

from . import brute

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()


def result(spark, name, *columns):
    return sorted(map(tuple, QUERIES[name](spark, SF).select(*columns).collect()))


def test_language(spark, documents):
    got = {i: (held, pred, score) for i, held, pred, score in result(spark, "op1_language_id", "doc_id", "held_out", "lang_pred", "score")}
    assert {i: g[0] for i, g in got.items()} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i, _, _ in documents}
    held = [(got[i][1], lang) for i, _, lang in documents if got[i][0]]
    assert np.mean([a == b for a, b in held]) > 0.95 and all(0 <= g[2] <= 1 for g in got.values())


def test_embeddings(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding, label FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    x = np.array([r[1] for r in rows], float)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    label = np.array([r[2] for r in rows])
    near = (x @ x.T >= 0.93) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    ids = [r[0] for r in rows]
    root = brute.components(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(near))])
    got = result(spark, "op2_embedding_near_dedup", "vec_id", "n_links", "component_id", "kept")
    assert got == [(i, int(n), root[i], root[i] == i) for i, n in zip(ids, near.sum(1))]


def test_exact_dedup(spark, documents):
    assert result(spark, "op3_exact_dedup", "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute.exact([d[:2] for d in documents])
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(c.execute(f"SELECT doc_id, keep_id, group_size, kept, text_sha256 FROM ({ORACLE_SQL['op3_exact_dedup']})").fetchall())
    assert want == brute.exact([d[:2] for d in documents])


def test_toxicity(spark, documents):
    assert len(result(spark, "op4_toxicity", "doc_id", "severity", "rejected")) == len(documents)


def test_toxicity_held_out(spark):
    """Labels of a third of the documents are kept from the fit: in each language most of its toxic ones are rejected, and hardly any clean one."""
    sf = "/root/testdata/sf0.1"
    if not os.path.isdir(sf):
        pytest.skip("no larger tables")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = toxicity.train(docs, labels.where(~held), "toxic")
    graded = toxicity.grade(docs.join(labels.where(held).select("doc_id", "toxic"), "doc_id"), model).join(labels, "doc_id").join(docs.select("doc_id", "lang"), "doc_id")
    shares = {(r["lang"], r["toxic"]): r["share"] for r in graded.groupBy("lang", "toxic").agg(F.avg(F.col("rejected").cast("int")).alias("share")).collect()}
    assert all(share > 0.75 if toxic else share < 0.02 for (_, toxic), share in shares.items()), shares


def test_ngram_join(spark, documents):
    assert result(spark, "op6_ngram_jaccard_join", "doc_id", "n_shingles", "component_id") == brute.jaccard([d[:2] for d in documents])


def test_licenses(spark, documents):
    got = {i: n for i, n in result(spark, "op7_license_scan", "doc_id", "n_licenses")}
    assert {i for i, n in got.items() if n} == {i for i, t, _ in documents if "icensed under" in t or "Released under the MIT" in t}


def test_licenses_by_brute_force(spark, documents):
    """Every stretch of every text against every template: whether one is covered, by the longest common subsequence."""
    scanner, want = licenses.Scanner(licenses.TEMPLATES, licenses.LEAST), set()
    for i, text, _ in documents:
        body = licenses.words(text or "")
        for template in scanner.templates.values():
            own, width, need = set(template), scanner.widest(len(template)), licenses.LEAST * len(template)
            ahead = np.cumsum([0] + [w in own for w in body])
            for a in [a for a, w in enumerate(body) if w in own and ahead[min(a + width, len(body))] - ahead[a] >= need]:
                if licenses.longest_common(template, body[a : a + width]) >= need:
                    want.add(i)
                    break
    assert {i for i, n in result(spark, "op7_license_scan", "doc_id", "n_licenses") if n} == want and want


def test_personal_data(spark, documents):
    got = result(spark, "op8_pii", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    kinds = list(brute.RULES)
    spans = {i: brute.base_spans(t) for i, t, _ in documents}
    assert got == [(i, *[sum(s[2] == k for s in spans[i]) for k in range(4)], hashlib.sha256(",".join(f"{kinds[k]}:{a}:{b}" for a, b, k in spans[i]).encode()).hexdigest()) for i, _, _ in documents]


def test_byte_bpe(spark, documents):
    got = result(spark, "op9_byte_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = {i: np.array(library.encode_ordinary(t or ""), "<u4") for i, t, _ in documents}
    assert got == [(i, len(ids[i]), hashlib.sha256(ids[i].tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _ in documents]


def test_suffix_dedup(spark, documents):
    assert result(spark, "op10_suffix_array_dedup", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.suffix([d[:2] for d in documents])


def test_packing(spark, documents):
    pieces = result(spark, "op5_packing", "sequence_id", "offset", "length", "doc_id", "start", "doc_tokens", "ids_crc32")
    at = {}
    for sequence, offset, length, *_ in pieces:
        assert offset == at.get(sequence, 0)
        at[sequence] = offset + length
    assert all(n == 1024 for s, n in at.items() if s < max(at)) and max(at.values()) <= 1024
    totals = {}
    for _, _, length, doc, *_ in pieces:
        totals[doc] = totals.get(doc, 0) + length
    assert totals == {p[3]: p[5] for p in pieces} and len(totals) == len(documents)
