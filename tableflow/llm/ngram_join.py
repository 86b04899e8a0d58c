"""N-gram Jaccard join by prefix trees.

A document's set holds the hashes of its distinct word n-grams. Documents with the same set are one set from then on.
Linked sets share at least ``similarity`` of the larger one, which gives an exact filter: only sets with that share of
n-grams that occur in another set can link. It runs twice, over all sets and over those left, as packed blocks of
sorted hashes; what a task finds in two of its own sets is sent once, so a very common n-gram stays small. Of the sets that
remain, the n-grams are ordered by how many sets hold them (rarest first). The larger of two linked sets, y, has their first
shared n-gram among its first |y| - ceil(similarity |y|) + 1, the smaller, x, among its first |x| - ceil(2 similarity /
(1 + similarity) |x|) + 1, since they share that much of x. An n-gram counts if some set holds it so early as a smaller one. All
sets that hold such an n-gram early meet in the bucket of the least of them, so a group of near copies meets in a few buckets
rather than in one for each n-gram.

In a bucket the sets go into a prefix tree with common n-grams first. Each set walks the tree; sets below a node share
the overlap counted on the way to it, and a subtree is left out when even all remaining n-grams that it could share cannot
reach the similarity, or when it is linked already. N-grams that no other set of the bucket has are counted in the sizes alone.
A bucket that exceeds ``BLOCK`` sets is cut into blocks which each hold the bucket's first set; sets that end up linked to
it need no further comparison among themselves, and only the rest is compared across blocks. Every link that is kept has
been counted exactly.

Words are separated by ASCII white space and lower-cased A-Z. With fewer than n words the whole sequence is the one
n-gram; null and empty texts and those without words have an empty set, link with nothing and are their own component.
Sets are known by 128 bits. Rows that repeat a doc_id are separate rows with one id. A row without an id takes part in links
and gives its component no id; where no row of a component has one, component_id is NULL. Other columns cannot clash. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .components import components

N = 5
SIMILARITY = 0.75
#: Sets of one bucket that one task compares.
BLOCK = 250
#: Sets, rows and n-grams that a task holds before it hands on its blocks.
CHUNK_SETS, CHUNK_ROWS, CHUNK_GRAMS = 60_000, 200_000, 1_000_000
#: Packed bytes of an n-gram, about.
GRAM_BYTES = 5
#: Bits of a hash that the filter compares beyond those that number all n-grams; equal ones by chance only let more sets pass.
SPARE_BITS = 13
#: Ids of documents that may be broadcast (eight bytes each); more are joined by a shuffle.
BROADCAST_IDS = 1_000_000

_FOLD = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD], np.uint64)


#: Bytes of texts that are hashed at a time (each worker holds two tables of eight times as many), and the longest word that takes the shared sums; longer ones are hashed by themselves.
STEP, LONG_WORD = 1 << 18, 64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(20).integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)  # a number for each byte
_BASE = 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER, _INVERSE = (_powers(b, STEP + LONG_WORD + 1) for b in (_BASE, pow(_BASE, -1, 1 << 64)))


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= _ODD[0]
    x ^= x >> np.uint64(29)
    x *= _ODD[3]
    x ^= x >> np.uint64(32)
    return x


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word: the polynomial of its bytes, from running sums over the text, mixed."""
    out = np.empty(len(starts), np.uint64)
    edges = np.searchsorted(starts, np.arange(0, len(data) + STEP, STEP))
    for k, (i, j) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)):
        if i < j:
            at = k * STEP
            part = data[at : at + STEP + LONG_WORD]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE[part] * _POWER[: len(part)], out=sums[1:])
            out[i:j] = (sums[np.minimum(ends[i:j] - at, len(part))] - sums[starts[i:j] - at]) * _INVERSE[starts[i:j] - at]
    for i in np.flatnonzero(ends - starts > LONG_WORD).tolist():
        out[i] = xxhash.xxh3_64_intdigest(data[starts[i] : ends[i]].tobytes())
    return _mixed(out)


def _chained(h: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k hashes that follow each other."""
    x = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        x *= _ODD[0]
        x += h[j : j + len(x)] * _ODD[1 + j % 4]
        x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x += np.uint64(k)  # a short whole sequence is no n-gram of a longer text
    return x


def shingle_sets(texts: list[bytes], n: int = N) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its word n-grams."""
    data = np.frombuffer(b" ".join([b"", *texts, b""]).translate(_FOLD), np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edge[::2], edge[1::2]
    h = _word_hashes(data, starts, ends)
    begins = np.cumsum([1, *(len(t) + 1 for t in texts)])
    first = np.searchsorted(starts, begins)  # of the words of each text
    x = _chained(h, n) if len(h) >= n else np.zeros(0, np.uint64)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        own = x[a : b - n + 1] if b - a >= n else _chained(h[a:b], b - a) if b > a else x[:0]
        own = np.sort(own)
        same = own[1:] == own[:-1]
        out.append(own[np.r_[True, ~same]] if same.any() else own)
    return out


def shingles(text: bytes, n: int = N) -> np.ndarray:
    return shingle_sets([text], n)[0]


def set_id(grams: np.ndarray) -> bytes:
    """128 bits of a set."""
    return xxhash.xxh3_128_digest(grams.tobytes())


def linked(overlap: int, a: int, b: int, percent: int) -> bool:
    """Whether sets of a and b n-grams are similar: 100 |x & y| >= percent |x | y|."""
    return 100 * overlap >= percent * (a + b - overlap)


class PrefixTree:
    """A compressed trie of sets in one order; every node knows its depth, and of the sets below it the sizes and the longest path."""

    def __init__(self, sets: list[np.ndarray], percent: int):
        self.percent = percent
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        grams, where, counts = np.unique(flat, return_inverse=True, return_counts=True)
        rank = np.empty(len(grams), np.int64)
        rank[np.lexsort((grams, -counts))] = np.arange(len(grams))  # common n-grams first: long shared paths
        common_to_some = int((counts > 1).sum())  # the others can be in no overlap
        ranked, at = rank[where], 0
        self.sets: list[np.ndarray] = []
        for s in sets:
            own = ranked[at : at + len(s)]
            self.sets.append(np.sort(own[own < common_to_some]))
            at += len(s)
        self.order = sorted(range(len(sets)), key=lambda i: self.sets[i].astype(">i8").tobytes())
        self.sizes = np.array([len(sets[i]) for i in self.order])
        self.lengths = np.array([len(self.sets[i]) for i in self.order])
        self.mask = np.zeros(len(grams), bool)
        # nodes: (labels of the edge to it, depth, first leaf, last leaf + 1, least size, greatest size, longest path, children)
        self.root = self._grow(0, len(self.order), 0)

    def _common(self, a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        return int(differ[0]) if len(differ) else n

    def _grow(self, low: int, high: int, depth: int) -> tuple:
        """The node of the leaves low to high, which agree up to depth; a work list, since paths may be long."""
        nodes: dict[tuple[int, int, int], tuple] = {}
        work = [(low, high, depth, False)]
        while work:
            lo, hi, start, ready = work.pop()
            first, last = self.sets[self.order[lo]], self.sets[self.order[hi - 1]]
            end = self._common(first, last) if hi - lo > 1 else len(first)
            children = []
            if hi - lo > 1:
                a = lo
                while a < hi and self.lengths[a] == end:  # sets that end here
                    a += 1
                while a < hi:
                    head = self.sets[self.order[a]][end]
                    left, right = a, hi  # the last leaf that goes on with the same n-gram
                    while right - left > 1:
                        mid = (left + right) // 2
                        left, right = (mid, right) if self.sets[self.order[mid]][end] == head else (left, mid)
                    children.append((a, left + 1, end))
                    a = left + 1
            if ready or not children:
                nodes[lo, hi, start] = (first[start:end], end, lo, hi, int(self.sizes[lo:hi].min()), int(self.sizes[lo:hi].max()), int(self.lengths[lo:hi].max()), [nodes.pop(c) for c in children])
            else:
                work.append((lo, hi, start, True))
                work += [(*c, False) for c in children]
        return nodes[low, high, depth]

    def _hopeless(self, size: int, overlap: int, left: int, depth: int, least: int, most: int, longest: int) -> bool:
        """Whether no set below the node can be similar, whatever follows; the bound is best for a set that ends with what can be shared."""
        more = min(left, longest - depth)
        s = min(max(depth + more, least), most)
        return not linked(overlap + min(more, s - depth), size, s, self.percent)

    def join(self) -> list[tuple[int, int]]:
        """A spanning forest of the similar pairs, as places in the list of sets."""
        n, out = len(self.order), []
        label = np.arange(n)
        for i in range(n):
            probe, size = self.sets[self.order[i]], int(self.sizes[i])
            self.mask[probe] = True
            stack = [(self.root, 0, 0)]
            while stack:
                (labels, depth, lo, hi, least, most, longest, children), overlap, used = stack.pop()
                if hi <= i or (label[lo:hi] == label[i]).all():
                    continue
                if self._hopeless(size, overlap, len(probe) - used, depth - len(labels), least, most, longest):
                    continue
                if len(labels):
                    overlap += int(np.count_nonzero(self.mask[labels]))
                    used = int(np.searchsorted(probe, labels[-1], "right"))
                    if self._hopeless(size, overlap, len(probe) - used, depth, least, most, longest):
                        continue
                stack += [(c, overlap, used) for c in children]
                a = lo
                while a < hi and self.lengths[a] == depth:
                    if label[a] != label[i] and linked(overlap, size, int(self.sizes[a]), self.percent):
                        out.append((self.order[i], self.order[a]))
                        label[label == label[a]] = label[i]
                    a += 1
            self.mask[probe] = False
        return out


#: What a chunk knows of each of its rows; place: of its set in the chunk, -1 for an empty one.
_ROW = np.dtype([("doc_id", "<i8"), ("null", "?"), ("place", "<i4"), ("key", "V16")])


class _Row(NamedTuple):
    doc_id: int | None
    sid: bytes | None
    grams: np.ndarray
    key: bytes


def _of_texts(n: int, keyed: bool) -> Callable[[pa.RecordBatch], Iterator[_Row]]:
    """The rows of a table of texts; keyed: with the MD5 of each text."""

    def rows(b: pa.RecordBatch) -> Iterator[_Row]:
        texts = common.raw(b.column("text"))
        for doc_id, text, s in zip(b.column("doc_id").to_pylist(), texts, shingle_sets(texts, n), strict=True):
            yield _Row(doc_id, set_id(s) if len(s) else None, s, hashlib.md5(text).digest() if keyed else bytes(16))

    return rows


def _of_sets(b: pa.RecordBatch) -> Iterator[_Row]:
    for sid, data in zip(b.column("sid").to_pylist(), b.column("grams").to_pylist(), strict=True):
        yield _Row(None, sid, np.frombuffer(data, np.uint64), bytes(16))


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """sid, grams (sorted, eight bytes each)."""

    def run(b: pa.RecordBatch) -> dict:
        sets = [s for s in shingle_sets(common.raw(b.column("text")), n) if len(s)]
        return {"sid": [set_id(s) for s in sets], "grams": [s.tobytes() for s in sets]}

    return common.map_arrow(docs, run, "sid binary, grams binary")


def _steps(grams: np.ndarray) -> bytes:
    """Ascending hashes: the first one, then steps of three, four or eight bytes as the widest one needs."""
    steps = np.diff(grams)
    most = int(steps.max(initial=0))
    width = 3 if most < 1 << 24 else 4 if most < 1 << 32 else 8
    return bytes([width]) + grams[:1].astype("<u8").tobytes() + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _from_steps(data: bytes) -> np.ndarray:
    width = data[0]
    raw = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    steps = np.zeros((len(raw), 8), np.uint8)
    steps[:, :width] = raw
    return np.cumsum(np.concatenate([np.frombuffer(data, "<u8", 1, 1), steps.view("<u8").ravel()]), dtype=np.uint64)


_COUNTED = "chunk long, sids binary, sizes binary, own binary, rows binary, counts binary"


def _counted(sets: DataFrame, parse: Callable[[pa.RecordBatch], Iterator[_Row]], total: int) -> DataFrame:
    """For each chunk of rows its sets, its rows, and how many n-grams of each set are in another set too (total: n-grams in all, at most)."""
    bits = min(64, max(32, total.bit_length() + SPARE_BITS))
    parts = common.partitions(sets.sparkSession, GRAM_BYTES * total)
    buckets = max(1, min(4 * parts, total // 100_000))
    schema = "bucket int, chunk long, grams binary, members binary, several binary, own binary, rows binary"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Hashes by range, sorted, each once, with the place of its set in the chunk, or a flag where several sets have it. The chunk's sets and rows come as a bucket below 0."""
        task, made = TaskContext.get().partitionId(), 0
        held: dict[bytes, np.ndarray] = {}
        places: dict[bytes, int] = {}
        rows: list[tuple] = []
        count = 0

        def chunk_rows() -> pa.RecordBatch:
            if made >> 16:
                raise OverflowError("a task has too many rows: use more partitions")
            chunk = task << 16 | made
            sizes = np.array([len(g) for g in held.values()], np.int64)
            grams = np.concatenate(list(held.values())) >> np.uint64(64 - bits) if held else np.zeros(0, np.uint64)
            members = np.repeat(np.arange(len(sizes), dtype=np.uint16), sizes)
            order = np.argsort(grams)
            grams, members = grams[order], members[order]
            first = np.r_[True, grams[1:] != grams[:-1]][: len(grams)]
            again = np.r_[~first[1:], False][: len(grams)]
            own = np.bincount(members[~first | again], minlength=len(sizes))  # found in two of the chunk's own sets
            grams, members, several = grams[first], members[first], again[first]
            bucket = ((grams >> np.uint64(bits - 32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            edges = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True]) if len(bucket) else []
            out: dict[str, list] = {"bucket": [-1 - chunk % buckets], "chunk": [chunk], "grams": [b"".join(held)], "members": [sizes.tobytes()], "several": [None], "own": [own.astype(np.uint32).tobytes()], "rows": [np.array(rows, _ROW).tobytes()]}
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                for k, v in zip(out, (int(bucket[a]), chunk, _steps(grams[a:b]), members[a:b].tobytes(), np.packbits(several[a:b]).tobytes(), None, None), strict=True):
                    out[k].append(v)
            return common.record(out, schema)

        for batch in batches:
            for b in common.slices(batch, size=2 * STEP):
                for row in parse(b):
                    if row.sid is not None and row.sid not in held:
                        places[row.sid] = len(held)
                        held[row.sid] = row.grams
                        count += len(row.grams)
                    rows.append((row.doc_id or 0, row.doc_id is None, -1 if row.sid is None else places[row.sid], row.key))
                    if len(held) >= CHUNK_SETS or len(rows) >= CHUNK_ROWS or count >= CHUNK_GRAMS:
                        yield chunk_rows()
                        held, places, rows, count, made = {}, {}, [], 0, made + 1
        if rows:
            yield chunk_rows()

    def count_shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each chunk how many n-grams of each set were seen in another chunk, in the buckets of this task."""
        shared: dict[int, np.ndarray] = {}

        def close(now: list[tuple[int, bytes, bytes, bytes]]) -> None:
            grams, members, flags, owner = [], [], [], []
            for i, (_, data, places, several) in enumerate(now):
                grams.append(_from_steps(data))
                members.append(np.frombuffer(places, np.uint16))
                flags.append(np.unpackbits(np.frombuffer(several, np.uint8), count=len(members[-1])).astype(bool))
                owner.append(np.full(len(members[-1]), i, np.int32))
            g, m, f, o = (np.concatenate(x) for x in (grams, members, flags, owner))
            order = np.argsort(g)
            g, m, f, o = g[order], m[order], f[order], o[order]
            same = g[1:] == g[:-1]
            more = (np.r_[same, False] | np.r_[False, same]) & ~f  # those with the flag are counted in their chunk
            m, o = m[more], o[more]
            order = np.argsort(o, kind="stable")
            m, o = m[order], o[order]
            for i, a, b in zip(*_runs(o), strict=True):
                chunk = now[i][0]
                c = np.bincount(m[a:b], minlength=1)
                old = shared.get(chunk, np.zeros(0, np.int64))
                n = max(len(c), len(old))
                shared[chunk] = np.pad(c, (0, n - len(c))) + np.pad(old, (0, n - len(old)))

        current, now = None, []
        for b in batches:
            for bucket, chunk, grams, members, several, own, rows in zip(*(b.column(c).to_pylist() for c in ("bucket", "chunk", "grams", "members", "several", "own", "rows")), strict=True):
                if bucket < 0:
                    yield common.record({"chunk": [chunk], "sids": [grams], "sizes": [members], "own": [own], "rows": [rows], "counts": [None]}, _COUNTED)
                    continue
                if bucket != current and now:
                    close(now)
                    now = []
                current = bucket
                now.append((chunk, grams, members, several))
        if now:
            close(now)
        for chunk, c in shared.items():
            yield common.record({"chunk": [chunk], "sids": [None], "sizes": [None], "own": [None], "rows": [None], "counts": [c.astype(np.uint32).tobytes()]}, _COUNTED)

    packed = sets.mapInArrow(common.releasing(blocks), schema).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return packed.mapInArrow(common.releasing(count_shared), _COUNTED)


def _runs(values: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Value, start and end of the runs of equal values."""
    edges = np.flatnonzero(np.r_[True, values[1:] != values[:-1], True]) if len(values) else np.zeros(1, np.int64)
    return values[edges[:-1]].tolist(), edges[:-1].tolist(), edges[1:].tolist()


def _rows_of(counted: DataFrame) -> DataFrame:
    """doc_id, n_shingles, sid (NULL without words), key, place (a number of the set that no other set has)."""

    def run(b: pa.RecordBatch) -> dict | None:
        out: dict[str, list] = {k: [] for k in ("doc_id", "n_shingles", "sid", "key", "place")}
        for chunk, sids, sizes, rows in zip(*(b.column(c).to_pylist() for c in ("chunk", "sids", "sizes", "rows")), strict=True):
            rows, sizes = np.frombuffer(rows, _ROW), np.frombuffer(sizes, np.int64)
            place = rows["place"].tolist()
            out["doc_id"] += [None if none else i for i, none in zip(rows["doc_id"].tolist(), rows["null"].tolist(), strict=True)]
            out["n_shingles"] += [0 if p < 0 else int(sizes[p]) for p in place]
            out["sid"] += [None if p < 0 else sids[16 * p : 16 * p + 16] for p in place]
            out["key"] += [k.tobytes() for k in rows["key"]]
            out["place"] += [None if p < 0 else chunk << 16 | p for p in place]
        return out

    return common.map_arrow(counted.where("rows is not null").select("chunk", "sids", "sizes", "rows"), run, "doc_id long, n_shingles long, sid binary, key binary, place long")


def _shared_enough(counted: DataFrame, percent: int) -> DataFrame:
    """sid of the sets of which enough n-grams occur in more than one set."""

    def decide(table: pa.Table) -> pa.Table:
        sids, sizes, total = b"", np.zeros(0, np.int64), np.zeros(CHUNK_SETS + 1, np.int64)
        for a, b, own, c in zip(*(table.column(k).to_pylist() for k in ("sids", "sizes", "own", "counts")), strict=True):
            if c is None:
                sids, sizes, c = a, np.frombuffer(b, np.int64), own
            c = np.frombuffer(c, np.uint32)
            total[: len(c)] += c
        passed = np.flatnonzero(100 * total[: len(sizes)] >= percent * sizes)
        return pa.table({"sid": pa.array([sids[16 * i : 16 * i + 16] for i in passed.tolist()], pa.binary())})

    return counted.drop("rows").groupBy("chunk").applyInArrow(decide, "sid binary").distinct()


def _bucket_links(groups: DataFrame, percent: int) -> DataFrame:
    """a, b: a spanning forest of the links among the sets of each (pivot, block, other)."""

    def run(table: pa.Table) -> pa.Table:
        sids, grams = table.column("sid").to_pylist(), table.column("grams").to_pylist()
        seen = dict(zip(sids, grams, strict=True))
        names = list(seen)
        pairs = PrefixTree([np.frombuffer(seen[s], np.uint64) for s in names], percent).join() if len(names) > 1 else []
        return pa.table({"a": pa.array([names[i] for i, _ in pairs], pa.int64()), "b": pa.array([names[j] for _, j in pairs], pa.int64())})

    return groups.groupBy("pivot", "block", "other").applyInArrow(run, "a long, b long")


class _Linked(NamedTuple):
    rows: DataFrame
    sets: DataFrame


def _linked(docs: DataFrame, n: int, similarity: float, keyed: bool) -> _Linked:
    """The rows (doc_id, n_shingles, sid, key), and sid, n (its rows), root (of its component) of each set."""
    percent = round(100 * similarity)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a word and what follows it have two bytes at least; short whole sequences are one n-gram
    counted = common.saved(_counted(docs, _of_texts(n, keyed), size // 2 + 1))
    rows = common.saved(_rows_of(counted))
    sets = common.saved(rows.where("sid is not null").groupBy("sid").agg(F.min("place").alias("place"), F.min("doc_id").alias("doc_id"), F.count("*").alias("n")))
    first = common.saved(_shared_enough(counted, percent))
    # one document of each set; those without an id all come, and whatever else has the same id
    some = common.saved(sets.join(first, "sid", "left_semi").select(F.col("doc_id").alias("some_id")).distinct())
    some = F.broadcast(some) if some.count() <= BROADCAST_IDS else some.hint("shuffle_hash")
    spark = docs.sparkSession
    left = _sets(docs.join(some, F.col("doc_id").eqNullSafe(F.col("some_id")), "left_semi"), n)
    left = common.saved(left.repartition(common.partitions(spark, size), "sid").dropDuplicates(["sid"]))
    held = left.agg(F.sum(F.octet_length("grams"))).first()[0] or 0
    enough = left.join(_shared_enough(_counted(left, _of_sets, held // 8), percent), "sid", "left_semi")
    # from here on a set is known by its number
    kept = common.saved(enough.join(sets.select("sid", "place"), "sid").select(F.col("place").alias("sid"), "grams"))

    def exploded(b: pa.RecordBatch) -> dict:
        own = [np.frombuffer(g, np.int64) for g in b.column("grams").to_pylist()]
        sizes = np.array([len(s) for s in own])
        return {"sid": np.repeat(b.column("sid").to_numpy(), sizes), "size": np.repeat(sizes, sizes), "gram": np.concatenate(own)}

    # tables with a row for each n-gram are dealt over as many tasks as their bytes need
    parts = common.partitions(spark, 4 * (kept.agg(F.sum(F.octet_length("grams"))).first()[0] or 0))
    grams = common.map_arrow(kept, exploded, "sid long, size long, gram long").repartition(parts, "gram")
    shared = grams.groupBy("gram").agg(F.count("*").alias("df")).where("df > 1")
    of_set = Window.partitionBy("sid")
    ranked = grams.join(shared, "gram").repartition(parts, "sid").withColumns({"n_shared": F.count("*").over(of_set), "place": F.row_number().over(of_set.orderBy("df", "gram"))})
    at = F.col("size") - F.col("n_shared") + F.col("place")  # n-grams that no other set has are rarer than all of these
    as_larger = F.col("size") - F.ceil(F.col("size") * percent / 100) + 1
    as_smaller = F.col("size") - F.ceil(F.col("size") * (2 * percent) / (100 + percent)) + 1
    meets = common.saved(ranked.where(at <= as_larger).select("gram", "sid", (at <= as_smaller).cast("int").alias("small")))
    # the least of the sets that hold the n-gram in their prefix
    least = meets.groupBy("gram").agg(F.min("sid").alias("pivot"), F.count("*").alias("n"), F.max("small").alias("small")).where("n > 1 and small = 1")
    members = common.saved(meets.join(least.select("gram", "pivot"), "gram").select("pivot", "sid").distinct())
    large = common.saved(members.groupBy("pivot").agg(F.count("*").alias("n")).where(F.col("n") > BLOCK).select("pivot", F.ceil(F.col("n") / BLOCK).alias("blocks")))
    dealt = members.join(large, "pivot", "left").withColumn("block", F.coalesce(F.pmod(F.xxhash64("sid"), F.col("blocks")), F.lit(0)))
    heads = large.select("pivot", F.col("pivot").alias("sid"), "blocks", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    once = dealt.unionByName(heads).select("pivot", "block", F.lit(-1).cast("long").alias("other"), "sid").distinct()
    links = common.saved(_bucket_links(once.join(kept, "sid"), percent))
    if not large.isEmpty():
        root = components(links)
        named = dealt.where("blocks is not null").join(root.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
        of_pivot = large.select("pivot").join(root.withColumnRenamed("node", "pivot"), "pivot", "left").select("pivot", F.coalesce("root", "pivot").alias("main"))
        rest = common.saved(named.join(of_pivot, "pivot").where("root <> main").select("pivot", "sid", "block", "blocks"))
        a = rest.select("pivot", "sid", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        wanted = rest.select("pivot", "block").distinct()
        b = named.select("pivot", "sid", F.col("block").alias("other")).join(wanted, "pivot")
        again = a.unionByName(b).select("pivot", "block", "other", "sid").distinct()
        links = common.saved(links.unionByName(_bucket_links(again.join(kept, "sid"), percent)))
    root = components(links)
    named = sets.join(root.withColumnRenamed("node", "place"), "place", "left")
    return _Linked(rows, common.saved(named.where("n > 1 or root is not null").select("sid", "n", "doc_id", F.coalesce("root", "place").alias("root"))))


def jaccard_components(docs: DataFrame, n: int = N, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id: one row per input row."""
    rows, sets = _linked(common.texts_of(docs, id_col, text_col), n, similarity, False)
    least = sets.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    small = common.saved(sets.select("sid", "root").join(least, "root").select("sid", "component_id"))
    named = common.spread_join(rows.select("sid", "doc_id", "n_shingles"), small, "sid", common.frequent(sets, "sid", rows.count()), "left")
    return named.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def without_near_copies(docs: DataFrame, n: int = N, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, one of each component: that with the smallest doc_id, of several such that with the least MD5 of its text."""
    rows, sets = _linked(common.texts_of(docs, id_col, text_col), n, similarity, True)
    of_row = common.spread_join(rows.select("sid", "doc_id", "key"), sets.select("sid", "root"), "sid", common.frequent(sets, "sid", rows.count()), "inner")
    of_row = common.saved(of_row.select("root", "doc_id", F.lower(F.hex("key")).alias("text_key")))
    known = common.saved(of_row.groupBy("root").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    hot = common.frequent(known, "root", of_row.count())
    first = common.spread_join(of_row, known.select("root", "least"), "root", hot, "inner").where(F.col("doc_id").eqNullSafe(F.col("least")))
    first = common.saved(first.groupBy("root", "doc_id").agg(F.min("text_key").alias("kept_key")).select("root", F.col("doc_id").alias("kept_id"), "kept_key"))
    groups = common.spread_join(of_row, first, "root", hot, "inner")
    groups = groups.select("doc_id", "text_key", (F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("text_key") == F.col("kept_key"))).alias("stays"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return common.surviving(docs, groups, F.md5(text.cast("binary")), id_col)
