"""Concatenate and cut: all documents' tokens in one long row, cut into windows of a fixed length.

Two passes. The first tokenises each document once and notes its tokens' start within its partition; the ids are
kept in a table. The totals of the partitions (one row each) then become global bases by a prefix sum, and the
second pass cuts every document at the multiples of the window length. A document that crosses a boundary leaves
one record on either side. All sequences but the last are full, so there is no padding but at the very end.

Documents follow each other as the scan deals them out, so sequence numbers depend on the layout of the files; the pieces
of a document do not move apart.

Nulls count as empty texts; every document ends with the separator, so an empty one holds that id alone. A row without an id
is packed like any other. Repeated rows are packed as often as they occur. Other columns cannot clash. An empty table gives an
empty result.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

WINDOW = 1024
SEPARATOR = 0


@cache
def encoders(vocabulary: str, ranks: str | None):
    """The encoder of the vocabulary's file, a faster one of the same vocabulary where it is given as ranks, and the strings that only the first one knows."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(vocabulary)
    special = tuple(t.content for t in slow.get_added_tokens_decoder().values())
    if ranks is None:
        return slow, None, special
    import tiktoken

    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return slow, tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}), special


def token_ids(text: str, vocabulary: str, ranks: str | None) -> np.ndarray:
    """The ids by the vocabulary's file, then the separator. Both libraries give the same ids; a test compares them."""
    slow, fast, special = encoders(vocabulary, ranks)
    ids = slow.encode(text, add_special_tokens=False).ids if fast is None or any(t in text for t in special) else fast.encode_ordinary(text)
    ids.append(SEPARATOR)
    return np.array(ids, "<u4")


def tokenise(docs: DataFrame, vocabulary: str, ranks: str | None = None) -> DataFrame:
    """doc_id, part, part_start, n_tokens, ids: part_start counts the tokens before it in its partition."""
    schema = "doc_id long, part int, part_start long, n_tokens long, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for b in (part for batch in batches for part in common.slices(batch)):
            ids = [token_ids(t, vocabulary, ranks) for t in common.strings(b.column("text"))]
            n = np.array([len(x) for x in ids], np.int64)
            # ids of this vocabulary fit in two bytes
            yield common.record({"doc_id": b.column("doc_id"), "part": [part] * len(n), "part_start": total + np.cumsum(n) - n, "n_tokens": n, "ids": [x.astype("<u2" if x.max() < 65536 else "<u4").tobytes() for x in ids]}, schema)
            total += int(n.sum())

    return docs.mapInArrow(common.releasing(run), schema)


def pack(docs: DataFrame, vocabulary: str, ranks: str | None = None, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, start, length, doc_tokens, sequence_id, offset, ids: one row for each piece of a document in a sequence."""
    rows = common.saved(tokenise(common.texts_of(docs, id_col, text_col), vocabulary, ranks))
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))  # a row for each partition
    before = F.sum("total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    bases = totals.select("part", F.coalesce(before, F.lit(0)).alias("base"))
    schema = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"

    def cut(b: pa.RecordBatch) -> dict:
        out: dict[str, list] = {f.split()[0]: [] for f in schema.split(", ")}
        for doc_id, at, n, data in zip(*(b.column(c).to_pylist() for c in ("doc_id", "at", "n_tokens", "ids")), strict=True):
            ids = np.frombuffer(data, f"<u{len(data) // n}").astype("<u4")
            done = 0
            while done < n:
                sequence, offset = divmod(at + done, window)
                length = min(window - offset, n - done)
                for k, v in zip(out, (doc_id, done, length, n, sequence, offset, ids[done : done + length].tobytes()), strict=True):
                    out[k].append(v)
                done += length
        return out

    placed = rows.join(F.broadcast(bases), "part").select("doc_id", (F.col("base") + F.col("part_start")).alias("at"), "n_tokens", "ids")
    return common.map_arrow(placed, cut, schema)


def piece_digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a CRC-32 in place of their ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def sequences(pieces: DataFrame) -> DataFrame:
    """sequence_id, ids: the packed sequences themselves."""
    joined = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.aggregate(joined, F.lit(b""), lambda a, b: F.concat(a, b["ids"])).alias("ids"))


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
