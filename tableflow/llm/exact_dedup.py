"""Exact dedup with counting quotient filters.

A text is normalised by lower-casing A-Z only. The first 64 bits of its SHA-256 are its fingerprint. The leading bits name
a range, one for every ``RANGE`` rows or so; what is left splits into a quotient (which run) and a remainder (what is
stored there). Every task builds filters over its own rows, one for each range that it meets; all filters of a range are
merged at once, by sorting their sorted runs together and adding counters, so nothing is lost. Fingerprints whose merged
counter exceeds one go on to byte verification: rows are grouped by the normalised text itself. All other rows are unique,
since equal texts have equal fingerprints.

Nulls count as empty texts; empty texts are equal to each other. Of equal texts the largest doc_id stays; a row without an
id stays only where no equal text has one. Repeated rows of one doc_id count as rows: the group is as large as its rows and
each of them names that doc_id as kept (without_copies leaves one of them). Other columns cannot clash. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

_FOLD = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
#: Fingerprints a task holds before it hands on its filters, and rows for which there is one range.
FLUSH, RANGE = 1 << 20, 1 << 21
_CHUNK = 1 << 16


def _packed(values: np.ndarray, bits: int) -> bytes:
    """The lowest bits of each value, one after another."""
    places = np.arange(bits - 1, -1, -1, dtype=np.uint64)
    return b"".join(np.packbits(((values[at : at + _CHUNK, None] >> places) & np.uint64(1)).astype(np.uint8).ravel()).tobytes() for at in range(0, len(values), _CHUNK))


def _unpacked(data: bytes, bits: int, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    for at in range(0, n if bits else 0, _CHUNK):
        m = min(_CHUNK, n - at)
        flags = np.unpackbits(np.frombuffer(data, np.uint8, -(-m * bits // 8), at * bits // 8), count=m * bits).reshape(m, bits)
        for column in flags.T:
            out[at : at + m] = (out[at : at + m] << np.uint64(1)) | column
    return out


class CountingQuotientFilter:
    """A sorted multiset of fingerprints of so many bits, without empty slots.

    One bit for each quotient says whether it has a run. For each slot there are the remainder, with as many bits as the
    quotient leaves, one bit for the end of its run, and one that says that its counter is over one; those counters stand
    apart. There are about as many quotients as slots, so a fingerprint of 64 - k bits among n takes 67 - k - log2 n bits or so.
    """

    def __init__(self, width: int, quotient_bits: int, n: int, occupied: bytes, ends: bytes, counted: bytes, remainders: bytes, counters: np.ndarray):
        self.width, self.q, self.n = width, quotient_bits, n
        self.occupied, self.ends, self.counted, self.remainders, self.counters = occupied, ends, counted, remainders, counters

    @classmethod
    def build(cls, fingerprints: np.ndarray, width: int, counts: np.ndarray | None = None) -> CountingQuotientFilter:
        order = np.argsort(fingerprints, kind="stable")
        fp = fingerprints[order]
        weight = np.ones(len(fp), np.int64) if counts is None else counts[order]
        first = np.flatnonzero(np.r_[True, fp[1:] != fp[:-1]]) if len(fp) else np.zeros(0, np.int64)
        total = np.add.reduceat(weight, first) if len(fp) else np.zeros(0, np.int64)
        fp, n = fp[first], len(first)
        q = min(width, max(1, (n - 1).bit_length()))
        r = np.uint64(width - q)
        quotient = (fp >> r).astype(np.int64) if q else np.zeros(n, np.int64)
        occupied = np.zeros(1 << q, bool)
        occupied[quotient] = True
        pack = lambda flags: np.packbits(flags).tobytes()
        return cls(width, q, n, pack(occupied), pack(np.r_[quotient[1:] != quotient[:-1], True][:n]), pack(total > 1), _packed(fp, width - q), total[total > 1])

    def _flags(self, data: bytes, n: int) -> np.ndarray:
        return np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool)

    def fingerprints(self) -> np.ndarray:
        """The stored fingerprints, sorted: the filter is lossless."""
        lengths = np.diff(np.flatnonzero(self._flags(self.ends, self.n)), prepend=-1)
        quotient = np.repeat(np.flatnonzero(self._flags(self.occupied, 1 << self.q)), lengths).astype(np.uint64)
        return quotient << np.uint64(self.width - self.q) | _unpacked(self.remainders, self.width - self.q, self.n)

    def counts(self) -> np.ndarray:
        out = np.ones(self.n, np.int64)
        out[self._flags(self.counted, self.n)] = self.counters
        return out

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """All of them in one; counters of equal fingerprints add up. The sort finds their runs in order and merges them."""
        return cls.build(np.concatenate([f.fingerprints() for f in filters]), filters[0].width, np.concatenate([f.counts() for f in filters]))

    def dumps(self) -> bytes:
        kind = np.min_scalar_type(int(self.counters.max(initial=0)))
        head = np.array([self.width, self.q, self.n, len(self.counters), kind.itemsize], "<i8")
        return b"".join([head.tobytes(), self.occupied, self.ends, self.counted, self.remainders, self.counters.astype(f"<u{kind.itemsize}").tobytes()])

    @classmethod
    def loads(cls, data: bytes) -> CountingQuotientFilter:
        width, q, n, m, size = np.frombuffer(data, "<i8", 5).tolist()
        at, parts = 40, []
        for bits in (1 << q, n, n, n * (width - q)):
            parts.append(data[at : at + -(-bits // 8)])
            at += -(-bits // 8)
        return cls(width, q, n, *parts, np.frombuffer(data, f"<u{size}", m, at).astype(np.int64))


def fold(text: bytes) -> bytes:
    return text.translate(_FOLD)


def _hashed(batch: pa.RecordBatch) -> dict:
    digests = [hashlib.sha256(fold(t)).digest() for t in common.raw(batch.column("text"))]
    fp = np.frombuffer(b"".join(d[:8] for d in digests), "<u8").astype(np.uint64)
    return {"doc_id": batch.column("doc_id"), "fp": fp.view(np.int64), "digest": digests}


def duplicate_fingerprints(hashed: DataFrame, rows: int, range_rows: int | None = None) -> DataFrame:
    """The fingerprints that occur more than once, with their counts, by merged counting quotient filters (rows: how many there are)."""
    bits = max(common.partitions(hashed.sparkSession), -(-rows // (range_rows or RANGE))).bit_length()
    width, part_schema, out_schema = 64 - bits, "slot_range int, filter binary", "fp long, n long"
    low = np.uint64((1 << width) - 1)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def filters() -> pa.RecordBatch:
            fp = np.sort(np.concatenate(held))
            part = (fp >> np.uint64(width)).astype(np.int64)
            edges = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
            return common.record({"slot_range": part[edges[:-1]], "filter": [CountingQuotientFilter.build(fp[a:b] & low, width).dumps() for a, b in zip(edges[:-1], edges[1:], strict=True)]}, part_schema)

        for batch in batches:
            held.append(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= FLUSH:
                yield filters()
                held = []
        if sum(map(len, held)):
            yield filters()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(k: int, data: list[bytes]) -> pa.RecordBatch:
            whole = CountingQuotientFilter.merge([CountingQuotientFilter.loads(d) for d in data])
            n = whole.counts()
            fp = whole.fingerprints()[n > 1] | np.uint64(k) << np.uint64(width)
            return common.record({"fp": fp.view(np.int64), "n": n[n > 1]}, out_schema)

        current, now = -1, []
        for batch in batches:
            for k, data in zip(batch.column("slot_range").to_pylist(), batch.column("filter").to_pylist(), strict=True):
                if k != current and now:
                    yield close(current, now)
                    now = []
                current = k
                now.append(data)
        if now:
            yield close(current, now)

    parts = max(common.partitions(hashed.sparkSession), -(-rows // RANGE))
    return hashed.select("fp").mapInArrow(common.releasing(build), part_schema).repartition(parts, "slot_range").sortWithinPartitions("slot_range").mapInArrow(common.releasing(merge), out_schema)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per input row."""
    docs = common.texts_of(docs, id_col, text_col)
    hashed = common.saved(common.map_arrow(docs, _hashed, "doc_id long, fp long, digest binary"))
    repeated = duplicate_fingerprints(hashed, hashed.count())
    suspects = hashed.join(repeated.select("fp"), "fp", "left_semi").select("doc_id").distinct()
    folded = F.translate(F.coalesce(F.col("text"), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    # byte verification: the group's key is the whole text; long texts stay unsorted as the small side is hashed
    groups = (
        docs.join(suspects.withColumnRenamed("doc_id", "suspect").hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("suspect")), "left_semi")
        .groupBy(folded.alias("folded"))
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .select(F.unhex(F.sha2(F.col("folded").cast("binary"), 256)).alias("digest"), "keep_id", "group_size")
    )
    return hashed.join(groups, "digest", "left").select(
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("keep_id", "doc_id").eqNullSafe(F.col("doc_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, one of each group of equal texts: the one that exact_dedup keeps, one of it where it is repeated."""
    groups = exact_dedup(docs, id_col, text_col).where("group_size > 1").select("doc_id", F.col("text_sha256").alias("text_key"), F.col("kept").alias("stays"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return common.surviving(docs, groups, F.sha2(F.translate(text, string.ascii_uppercase, string.ascii_lowercase).cast("binary"), 256), id_col)
