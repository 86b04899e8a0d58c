"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Pairs that can merge wait in one bucket for each merge rank; a bucket holds positions of a doubly linked list of
tokens. A two-level bitmap over the ranks tells by find-first-set which bucket is next, so picking a merge costs the
same for a pre-token of five bytes and one of five million. A merge leaves stale entries behind; they are skipped
when they are met. Within a bucket the leftmost position goes first, as a plain rank-ordered encoder does it.

Nulls and empty texts have no ids. Repeated rows give repeated results; an empty table gives an empty one.
"""

from __future__ import annotations

import base64
import hashlib
import re
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from . import common

#: Pre-tokens whose ids a worker remembers, twice; others are encoded anew, so this bounds memory and not the result.
MEMO = 500_000
#: Where Python's re and the pattern's classes agree: text without these characters may take the faster splitter.
_ODD = re.compile("[\x1c-\x1f\xb2\xb3\xb9\xbc-\xbeɐ-\U0010ffff]")
#: The same split for such text.
_PLAIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class ByteBPE:
    """Encoder and decoder over a file of ranks (base64 of the bytes, a blank, the rank; one token a line)."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.single = [self.ranks[bytes([i])] for i in range(256)]
        self.bytes_of = np.empty(max(self.ranks.values()) + 1, object)
        #: Rank of what two tokens make together, for every two that make one.
        self.pairs: dict[int, int] = {}
        for token, rank in self.ranks.items():
            self.bytes_of[rank] = token
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a << 32 | b] = rank
        self.pattern = regex.compile(pattern)
        self.plain = _PLAIN if pattern == public_tokenizers.PATTERN else None
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token.

        The rank queue lives in three locals, as its steps are too short for calls: bit w of top says that word w of
        words has a bit, and bit b of that word says that the bucket of rank 256 w + b holds positions (a heap).
        """
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        rank_of = self.pairs.get
        ids = [self.single[c] for c in piece]  # of the token that starts here; -1 when it has been merged away
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        top, words, buckets = 0, {}, {}
        left = ids[0] if ids else 0
        for i in range(1, n):
            right = ids[i]
            r = rank_of(left << 32 | right)
            left = right
            if r is not None:
                if r in buckets:
                    buckets[r].append(i - 1)  # in ascending order a list is a heap
                else:
                    buckets[r] = [i - 1]
                    words[r >> 8] = words.get(r >> 8, 0) | 1 << (r & 255)
                    top |= 1 << (r >> 8)
        while top:
            first = top & -top  # find-first-set, on both levels
            w = first.bit_length() - 1
            bits = words[w]
            low = bits & -bits
            rank = (w << 8) + low.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                if bits == low:
                    del words[w]
                    top ^= first
                else:
                    words[w] = bits ^ low
            j = after[i]
            if j >= n or ids[i] < 0 or rank_of(ids[i] << 32 | ids[j]) != rank:
                continue  # stale: one of the two has changed since
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            new = []
            if k < n:
                before[k] = i
                if (r := rank_of(rank << 32 | ids[k])) is not None:
                    new.append((r, i))
            if (h := before[i]) >= 0 and (r := rank_of(ids[h] << 32 | rank)) is not None:
                new.append((r, h))
            for r, at in new:
                if r in buckets:
                    heappush(buckets[r], at)
                else:
                    buckets[r] = [at]
                    words[r >> 8] = words.get(r >> 8, 0) | 1 << (r & 255)
                    top |= 1 << (r >> 8)
        return [x for x in ids if x >= 0]

    def split(self, text: str) -> list[str]:
        return self.plain.findall(text) if self.plain and not _ODD.search(text) else self.pattern.findall(text)

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, as unsigned 32-bit integers."""
        memo, parts = self.memo, []
        for piece in self.split(text):
            ids = memo.get(piece)
            if ids is None:
                ids = self.older.get(piece) or np.array(self.merge(piece.encode()), "<u4").tobytes()
                if len(memo) >= MEMO:
                    self.older, memo = memo, {}
                    self.memo = memo
                if len(piece) < 100:
                    memo[piece] = ids
            parts.append(ids)
        return np.frombuffer(b"".join(parts), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.bytes_of[ids].tolist())


_loaded: dict[str, ByteBPE] = {}


def load(path: str) -> ByteBPE:
    """One encoder for each file and worker."""
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]


def bpe_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the ids of every whole text."""
    return common.map_arrow(common.texts_of(docs, id_col, text_col), lambda b: {"doc_id": b.column("doc_id"), "ids": [load(path).encode(t).astype(np.int32) for t in common.strings(b.column("text"))]}, "doc_id long, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text from doc_id, ids: the exact inverse of bpe_encode."""

    def decode(b: pa.RecordBatch) -> dict:
        return {"doc_id": b.column("doc_id"), "text": [load(path).decode(np.array(x or [], np.uint32)).decode("utf-8", "replace") for x in b.column("ids").to_pylist()]}

    return common.map_arrow(encoded.select("doc_id", "ids"), decode, "doc_id long, text string")


def bpe_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one pass, digests only."""

    def digest(b: pa.RecordBatch) -> dict:
        bpe, n, ids_sha, text_sha = load(path), [], [], []
        for text in common.strings(b.column("text")):
            ids = bpe.encode(text)
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
            text_sha.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
        return {"doc_id": b.column("doc_id"), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

    return common.map_arrow(common.texts_of(docs, id_col, text_col), digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
