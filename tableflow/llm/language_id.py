"""Language identification by prediction by partial matching.

For each language a tree of byte contexts up to three bytes long holds how often each byte followed (order 0 to 3).
A byte costs -log2 of its probability in the longest context that has seen it; on the way down every context that
hasn't seen it costs its escape probability (method C: distinct followers against all followers). A byte that
no language has seen costs the same in all of them, so many of them outvote no word. Statistics are
frozen after training, so a text's code length is exact and does not depend on what was scored before. The language
with the least code length wins; the score is its share of the posterior under equal priors.

Training reads at most ``per_language`` documents and ``language_bytes`` bytes of each language, the first by a hash of their id
and text among those whose text and language are not null (and which the caller did not hold out); the first one always. A null
text or one without a letter is ``und`` with score 0; so is every text when nothing could be learned. Ties go to the first
language by name. Code lengths of frequent byte pairs are tabled in single precision, so a length is exact to seven digits. A
row without an id is scored like any other, repeated rows give repeated results, other columns cannot clash; an empty table gives
an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

ORDER = 3
START = b"\n" * ORDER
#: Frequent byte pairs for which code lengths are tabled (fewer of them for many languages, by the bytes of the table); other positions take the trees themselves.
PAIRS, TABLE_BYTES = 1024, 64 << 20
UNKNOWN = "und"
_ASCII_LETTER = re.compile("[A-Za-z]")


class ContextTree:
    """Byte counts in contexts of 0 to ORDER bytes."""

    #: Bytes that no tree of the model has seen: they cost eight bits in each.
    strange = np.zeros(256, bool)

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"".join(START + t for t in texts), np.uint8).astype(np.uint32)
        real = np.ones(len(data), bool)
        at = np.cumsum([0] + [len(t) + ORDER for t in texts])[:-1]
        for k in range(ORDER):
            real[at + k] = False
        real[:ORDER] = False
        self.grams, self.counts, self.contexts, self.totals, self.distinct = [], [], [], [], []
        for k in range(ORDER + 1):
            key = np.zeros(len(data), np.uint32)
            for j in range(k, -1, -1):
                key[j:] |= data[: len(data) - j] << np.uint32(8 * j)
            grams, counts = np.unique(key[real], return_counts=True)
            contexts, first = np.unique(grams >> np.uint32(8), return_index=True)
            self.grams.append(grams)
            self.counts.append(counts)
            self.contexts.append(contexts)
            self.totals.append(np.add.reduceat(counts, first) if len(first) else counts)
            self.distinct.append(np.diff(np.r_[first, len(grams)]))

    def bits(self, keys: np.ndarray) -> np.ndarray:
        """Code lengths of the last byte of each four-byte key after the other three."""
        p = np.full(len(keys), 1 / 256)
        for k in range(ORDER + 1):
            if not len(self.grams[k]):
                continue
            gram = keys & np.uint32((1 << 8 * (k + 1)) - 1)
            context = (gram >> np.uint32(8)) if k else np.zeros(len(keys), np.uint32)
            c = np.minimum(np.searchsorted(self.contexts[k], context), len(self.contexts[k]) - 1)
            g = np.minimum(np.searchsorted(self.grams[k], gram), len(self.grams[k]) - 1)
            total = (self.totals[k] + self.distinct[k])[c]
            seen = np.where(self.grams[k][g] == gram, self.counts[k][g] / total, self.distinct[k][c] / total * p)
            p = np.where(self.contexts[k][c] == context, seen, p)
        return -np.log2(np.where(self.strange[keys & np.uint32(255)], 1 / 256, p))


class Model:
    def __init__(self, texts: dict[str, list[bytes]]):
        self.languages = sorted(texts)
        self.trees = [ContextTree(texts[x]) for x in self.languages]
        strange = np.ones(256, bool)
        for tree in self.trees:
            strange[tree.grams[0]] = False
        for tree in self.trees:
            tree.strange = strange
        pairs = np.zeros(65536, np.int64)
        for tree in self.trees:
            np.add.at(pairs, tree.grams[1], tree.counts[1])
        most = min(PAIRS, int((TABLE_BYTES / 4 / max(len(self.trees), 1)) ** 0.5) - 1)
        top = np.argsort(-pairs, kind="stable")[: min(most, np.count_nonzero(pairs))]
        top = np.sort(top).astype(np.uint32)
        self.pair_id = np.full(65536, len(top), np.int32)
        self.pair_id[top] = np.arange(len(top))
        n = len(top) + 1  # the last row and column: pairs that are not tabled
        self.table = np.zeros((n, n, len(self.trees)), np.float32)
        if len(top):
            keys = ((top[:, None] << np.uint32(16)) | top[None, :]).ravel()
            for i, tree in enumerate(self.trees):
                self.table[:-1, :-1, i] = tree.bits(keys).reshape(n - 1, n - 1)
        self.table = self.table.reshape(n * n, len(self.trees))

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text (rows) in each language (columns)."""
        out = np.zeros((len(texts), len(self.trees)))
        lengths = np.array([len(t) for t in texts])
        if not self.trees or not lengths.sum():
            return out
        data = np.frombuffer(START + START.join(texts), np.uint8)
        start = np.cumsum(lengths + ORDER) - lengths
        pair = (data[:-1].astype(np.uint16) << np.uint16(8)) | data[1:]
        ids = self.pair_id[pair]
        n = int(len(self.table) ** 0.5)
        for i in range(len(texts)):
            a, b = int(start[i]), int(start[i] + lengths[i])
            for at in range(a, b, 1 << 20):
                to = min(b, at + (1 << 20))
                left, right = ids[at - 3 : to - 3], ids[at - 1 : to - 1]
                out[i] += self.table[left * n + right].sum(0, dtype=np.float64)
                rare = np.flatnonzero((left == n - 1) | (right == n - 1))
                if len(rare):
                    keys = (pair[at - 3 : to - 3][rare].astype(np.uint32) << np.uint32(16)) | pair[at - 1 : to - 1][rare]
                    out[i] += [tree.bits(keys).sum() for tree in self.trees]
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        letters = [bool(_ASCII_LETTER.search(t)) or any(map(str.isalpha, t)) for t in texts]
        if not self.trees:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        bits = self.code_lengths([t.encode("utf-8", "replace") for t in texts])
        best = bits.argmin(1)
        share = 1 / np.exp2(np.clip(bits.min(1)[:, None] - bits, -1000, 0)).sum(1)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, letters, strict=True)], [float(s) if ok else 0.0 for s, ok in zip(share, letters, strict=True)]


def train(docs: DataFrame, lang_col: str = "lang", per_language: int = 300, language_bytes: int = 8 << 20, total_bytes: int = 128 << 20, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on at most per_language documents, and language_bytes bytes (of many languages fewer: total_bytes in all) but for the first document, of each language."""
    known = common.texts_of(docs, id_col, text_col, lang_col).withColumnRenamed(lang_col, "lang").where("text is not null and lang is not null")
    texts: dict[str, list[bytes]] = {}
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if counts:
        language_bytes = min(language_bytes, total_bytes // len(counts))
        scale = 1 << 30
        # twice the expected share by their hash, then the first of those: no sort of all texts
        bound = F.create_map(*[x for k, n in sorted(counts.items()) for x in (F.lit(k), F.lit(int(scale * min(1, 2 * per_language / n))))])
        some = known.withColumn("draw", F.pmod(F.xxhash64("doc_id", "text"), F.lit(scale))).where(F.col("draw") < bound[F.col("lang")])
        first = Window.partitionBy("lang").orderBy("draw", "doc_id", "text")
        so_far = F.sum(F.octet_length("text")).over(first.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        some = some.withColumns({"place": F.row_number().over(first), "so_far": so_far})
        for r in some.where((F.col("place") <= per_language) & ((F.col("so_far") <= language_bytes) | (F.col("place") == 1))).orderBy("lang", "place").collect():
            texts.setdefault(r["lang"], []).append(r["text"].encode("utf-8", "replace"))
    return Model(texts)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score for every row."""
    frozen = docs.sparkSession.sparkContext.broadcast(model)  # for each language a tree of language_bytes at most; one table of TABLE_BYTES

    def score(b: pa.RecordBatch) -> dict:
        pred, share = frozen.value.predict(common.strings(b.column("text")))
        return {"doc_id": b.column("doc_id"), "lang_pred": pred, "score": share}

    return common.map_arrow(common.texts_of(docs, id_col, text_col), score, "doc_id long, lang_pred string, score double")
