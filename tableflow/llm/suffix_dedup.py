"""Suffix-array dedup: removes every byte of a passage that an earlier document holds too.

Each byte covered by a ``length``-byte string that also starts in a document with a smaller doc_id goes; strings are
judged on the input. The suffixes of the texts, cut at that length, have to be sorted to find the equal ones, and this is
how the work is dealt:

1. Every start of a string is given to its anchor: the position, among those within the string, whose ``GRAM`` bytes
   hash lowest. Equal strings have equal anchors, and neighbouring starts mostly share one, so a run of starts with one
   anchor is a segment of a text. Only the anchors' hashes are shuffled at first, and those of one document alone drop out.
2. Texts are dealt in batches of a few MB. A batch hands on its distinct segments with a shared anchor (the least
   and greatest document of each), dealt by the anchor. Segments of an anchor that very many batches hold are cut
   into single strings, dealt by their own content, so no anchor gathers in one task.
3. A bucket's suffixes are sorted deep-shallow: groups are refined by sorts over eight-byte words to ``SHALLOW`` bytes, and
   what still agrees is regrouped in rounds by where it parts from one leaf. Suffixes
   that are equal to the full length form a class, and its least document goes back to the batches.
4. The batches mark the bytes.

Nulls count as empty texts; shorter texts than ``length`` lose nothing. Rows that repeat a doc_id take nothing from
each other. A row without an id counts as the last one (as the greatest long, which stands for it), and such rows take nothing from
each other. Matches never cross documents. Other columns cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

LENGTH = 50
#: Bytes of an anchor, bytes that the shallow sort looks at (a multiple of eight).
GRAM, SHALLOW = 25, 24
#: Text bytes that make one batch, and for which there is one bucket of suffixes.
BATCH, BUCKET = 8 << 20, 4 << 20
#: Bits of an anchor's hash. Anchors in more batches than HOT are dealt string by string.
BITS, HOT = 48, 3000
#: Text bytes that are hashed at a time, and anchors that a task holds before it hands them on.
STEP, HELD = 1 << 20, 3 << 19
#: Strings that are sorted at a time, but for one anchor's, which stay together.
SORTED = 150_000
#: Text bytes that a task holds before it hands on its blocks.
BLOCKS = 32 << 20
#: Stands for a missing id.
LAST = (1 << 63) - 1
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def words_at(data: np.ndarray) -> np.ndarray:
    """The big-endian eight-byte word that starts at each byte of an array of bytes."""
    return np.ndarray((max(0, len(data) - 7),), ">u8", data, 0, (1,))


def segments(texts: list[bytes], length: int = LENGTH) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]]:
    """Runs of starts with one anchor: bytes of some texts, then anchor hash, text, first start and count of each run, and the first text's place."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= STEP):
            size += len(texts[end])
            end += 1
        sizes = np.array([len(t) for t in texts[at:end]])
        data = np.frombuffer(b"".join(texts[at:end]), np.uint8)
        if len(data) >= length and sizes.max(initial=0) >= length:
            yield (data, *_runs(data, sizes, length), at)
        at = end


def _runs(data: np.ndarray, sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(data) - GRAM + 1
    w = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,)).astype(np.uint64)  # the eight bytes from each place on
    h = w[:n] * _ODD[0]
    h += w[8 : n + 8] * _ODD[1]
    h += w[GRAM - 8 : n + GRAM - 8] * _ODD[2]
    h ^= h >> np.uint64(29)
    h *= _ODD[3]
    # half of the hash before the place: the least of a window is one comparison, and ties stay with the leftmost
    low = h & ~np.uint64(0xFFFFFFFF)
    low |= np.arange(n, dtype=np.uint64)
    span, have = length - GRAM + 1, 1  # anchors that a string has to choose from
    while have < span:
        by = min(have, span - have)
        low = np.minimum(low[by:], low[:-by])
        have += by
    where = low.astype(np.uint32)
    ends = np.cumsum(sizes)
    inside = np.ones(len(where), bool)
    for a, b in zip((ends - np.minimum(sizes, length - 1)).tolist(), ends.tolist(), strict=True):
        inside[a:b] = False  # no string starts so near the end of a text
    new = np.r_[True, where[1:] != where[:-1]]
    new[1:] |= ~inside[:-1]
    new &= inside
    begin = np.flatnonzero(new)
    text = np.searchsorted(ends, begin, "right")
    count = np.minimum(np.r_[begin[1:], len(data)], ends[text] - length + 1) - begin
    chosen = h[where[begin]]  # the lowest of many, so mixed again to spread over all values
    chosen ^= chosen >> np.uint64(33)
    chosen *= _ODD[1]
    chosen ^= chosen >> np.uint64(31)
    return chosen, text.astype(np.int32), begin, count


def packed(values: np.ndarray) -> bytes:
    """Ascending unsigned integers as steps of four bytes where they fit."""
    steps = np.diff(values)
    wide = bool(len(steps)) and bool(steps.max() >> np.uint64(32))
    return bytes([wide]) + values[:1].astype("<u8").tobytes() + steps.astype("<u8" if wide else "<u4").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    if len(data) < 9:
        return np.zeros(0, np.uint64)
    first, steps = np.frombuffer(data, "<u8", 1, 1), np.frombuffer(data, "<u8" if data[0] else "<u4", offset=9)
    return np.cumsum(np.concatenate([first, steps.astype(np.uint64)]), dtype=np.uint64)


def _groups(ascending: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups of equal numbers begin, and the number of each place's group."""
    new = np.r_[True, ascending[1:] != ascending[:-1]]
    return np.flatnonzero(new), np.cumsum(new) - 1


def deep_shallow_sort(data: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at starts by their first length bytes (which data has to hold), and where a new class begins in it."""
    n = len(starts)
    pad = np.concatenate([data, np.zeros(8, np.uint8)])
    w = words_at(pad)
    order = np.arange(n)
    group = np.zeros(n, np.int64)  # of each place in order; ascending
    # multikey quicksort with eight bytes as a character: sort every open group by its next character, then split it
    open_ = np.arange(n)
    shallow = min(SHALLOW, length // 8 * 8)
    for depth in range(0, shallow, 8):
        if not len(open_):
            break
        key = w[starts[order[open_]] + depth].astype(np.uint64)
        first, of = _groups(group[open_])
        mixed = np.logical_or.reduceat(key != key[first[of]], first)[of]  # the others stay one group, as they are
        if mixed.any():
            some, key, g = open_[mixed], key[mixed], group[open_[mixed]]
            rank = np.lexsort((key, g)) if depth else np.argsort(key)
            order[some], key = order[some][rank], key[rank]
            new = np.r_[True, (g[1:] != g[:-1]) | (key[1:] != key[:-1])]
            group[some] = some[np.flatnonzero(new)][np.cumsum(new) - 1]
        first, of = _groups(group[open_])
        open_ = open_[(np.diff(np.r_[first, len(open_)]) > 1)[of]]
    # blind tries: compare with one leaf of the group, branch where the two part; equal ones share the leaf
    while len(open_):
        first, of = _groups(group[open_])
        mine, other = starts[order[open_]], starts[order[open_[first[of]]]]
        part = np.full(len(open_), length)
        todo = np.arange(len(open_))
        for d in range(shallow, length, 8):
            if not len(todo):
                break
            x = w[mine[todo] + d].astype(np.uint64) ^ w[other[todo] + d].astype(np.uint64)
            apart = np.flatnonzero(x)
            x, at = x[apart], todo[apart]
            zero = sum((x < np.uint64(1) << np.uint64(8 * k)).astype(np.int64) for k in range(1, 8))
            part[at] = np.minimum(d + zero, length)
            todo = np.delete(todo, apart)
        same = part >= length
        mixed = ~np.logical_and.reduceat(same, first)[of]
        open_, same, part, mine, other = (v[mixed] for v in (open_, same, part, mine, other))
        if not len(open_):
            break
        g = group[open_]
        byte, beside = pad[np.minimum(mine + part, len(pad) - 1)].astype(np.int64), pad[np.minimum(other + part, len(pad) - 1)].astype(np.int64)
        side = np.where(same, 0, np.where(byte < beside, -1, 1))
        # below the leaf: those that part early come first; above it: those that part late
        branch = np.where(same, 0, np.where(side < 0, part, length - part) * 256 + byte)
        rank = np.lexsort((branch, side, g))
        order[open_] = order[open_][rank]
        same, side, branch = same[rank], side[rank], branch[rank]
        g = g[rank]
        new = np.r_[True, (g[1:] != g[:-1]) | (side[1:] != side[:-1]) | (branch[1:] != branch[:-1])]
        group[open_] = open_[np.flatnonzero(new)][np.cumsum(new) - 1]
        single = new & np.r_[new[1:], True]
        open_ = open_[~(single | same)]
    return order, np.r_[True, group[1:] != group[:-1]] if n else np.zeros(0, bool)


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> np.uint64(64 - 31)) * np.uint64(buckets) >> np.uint64(31)).astype(np.int64)


def _cut(sorted_key: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """value, start, end of the runs of equal values."""
    edges = np.flatnonzero(np.r_[True, sorted_key[1:] != sorted_key[:-1], True]) if len(sorted_key) else []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        yield int(sorted_key[a]), int(a), int(b)


def _shared_anchors(docs: DataFrame, buckets: int, length: int, batches: int, parts: int) -> DataFrame:
    """batch, hot, anchors: for each batch the anchors of its texts that another text has too."""
    narrow = "<u2" if batches <= 65536 else "<u4"
    shift = np.uint64(64 - BITS)
    schema, out_schema = "bucket int, anchors binary, batches binary, several binary", "batch int, hot boolean, anchors binary"

    def give(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def rows() -> pa.RecordBatch:
            a, doc, batch = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((doc, batch, a))
            a, doc, batch = a[order], doc[order], batch[order]
            new = np.r_[True, a[1:] != a[:-1]]
            other = ~new & np.r_[False, doc[1:] != doc[:-1]]  # another text of the same anchor before it
            several = np.zeros(int(new.sum()), bool)
            several[np.cumsum(new)[other] - 1] = True
            several = several[np.cumsum(new) - 1]
            keep = new | np.r_[True, batch[1:] != batch[:-1]]
            a, batch, several = a[keep], batch[keep], several[keep]
            out: dict[str, list] = {f.split()[0]: [] for f in schema.split(", ")}
            for k, lo, hi in _cut(_bucket(a << shift, buckets)):
                for name, v in zip(out, (k, packed(a[lo:hi]), batch[lo:hi].astype(narrow).tobytes(), np.packbits(several[lo:hi]).tobytes()), strict=True):
                    out[name].append(v)
            return common.record(out, schema)

        seen = size = 0
        for b in (part for batch in batches for part in common.slices(batch)):
            texts, group = common.raw(b.column("text")), b.column("batch").to_numpy()
            for _, anchor, text, _, _, first in segments(texts, length):
                text = text.astype(np.int64) + first
                held.append((anchor >> shift, text + seen, group[text].astype(np.int32)))
                size += len(anchor)
            seen += len(texts)
            if size >= HELD:
                yield rows()
                held, size = [], 0
        if size:
            yield rows()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close(now: list[tuple[bytes, bytes, bytes]]) -> pa.RecordBatch:
            a = np.concatenate([unpacked(x) for x, _, _ in now])
            group = np.concatenate([np.frombuffer(x, narrow) for _, x, _ in now])
            several = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8), count=len(g) // int(narrow[-1])).astype(bool) for _, g, x in now])
            order = np.lexsort((group, a))
            a, group, several = a[order], group[order], several[order]
            first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            n = np.diff(np.r_[first, len(a)])
            shared = np.repeat((n > 1) | np.logical_or.reduceat(several, first), n)
            hot = np.repeat(n > HOT, n)
            keep = shared & np.r_[True, (a[1:] != a[:-1]) | (group[1:] != group[:-1])]
            a, group, hot = a[keep], group[keep].astype(np.int64), hot[keep]
            order = np.lexsort((a, hot, group))
            a, group, hot = a[order], group[order], hot[order]
            out: dict[str, list] = {"batch": [], "hot": [], "anchors": []}
            for k, lo, hi in _cut(group * 2 + hot):
                for name, v in zip(out, (k // 2, bool(k % 2), packed(a[lo:hi])), strict=True):
                    out[name].append(v)
            return common.record(out, out_schema)

        current, now = None, []
        for b in batches:
            for bucket, *row in zip(*(b.column(c).to_pylist() for c in ("bucket", "anchors", "batches", "several")), strict=True):
                if bucket != current and now:
                    yield close(now)
                    now = []
                current = bucket
                now.append(tuple(row))
        if now:
            yield close(now)

    return docs.mapInArrow(give, schema).repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(meet, out_schema)


def _anchors(table: pa.Table, hot: bool) -> np.ndarray:
    found = [unpacked(x) for x, h in zip(table.column("anchors").to_pylist(), table.column("hot").to_pylist(), strict=True) if h == hot and x is not None]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _units(texts: list[bytes], shared: np.ndarray | None, hot: np.ndarray, length: int):
    """Pieces of the texts to look up: a segment, or each string of a hot anchor's. Bytes; key, text, start, strings, hash of each; the first text's place."""
    shift = np.uint64(64 - BITS)
    for data, anchor, text, begin, count, first in segments(texts, length):
        short = anchor >> shift
        is_hot = _among(short, hot)
        keep = np.flatnonzero(~is_hot if shared is None else ~is_hot & _among(short, shared))
        each = np.flatnonzero(is_hot)
        times = count[each]
        inner = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        view = memoryview(data)
        begins = np.concatenate([begin[keep], np.repeat(begin[each], times) + inner])
        counts = np.concatenate([count[keep], np.ones(len(inner), np.int64)])
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(view[a : a + k]) for a, k in zip(begins.tolist(), (counts + length - 1).tolist(), strict=True)), np.uint64, len(begins))
        key = np.concatenate([anchor[keep] >> shift << shift, hashes[len(keep) :]])
        yield data, key, np.concatenate([text[keep], np.repeat(text[each], times)]), begins, counts, hashes, first


def _blocks(docs: DataFrame) -> DataFrame:
    """batch, block: the texts of each batch from one task, compressed together."""
    schema = "batch int, block binary"

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, list[bytes]]] = []

        def rows() -> pa.RecordBatch:
            group, ids = np.concatenate([g for g, _, _ in held]), np.concatenate([i for _, i, _ in held])
            texts = [t for _, _, x in held for t in x]
            order = np.argsort(group, kind="stable")
            out: dict[str, list] = {"batch": [], "block": []}
            for k, lo, hi in _cut(group[order]):
                own = [texts[i] for i in order[lo:hi].tolist()]
                out["batch"].append(k)
                out["block"].append(_squeezed(np.array([len(own)], "<i8"), ids[order[lo:hi]].astype("<i8"), np.array([len(t) for t in own], "<i8"), *own))
            return common.record(out, schema)

        size = 0
        for b in (part for batch in it for part in common.slices(batch)):
            texts = common.raw(b.column("text"))
            held.append((b.column("batch").to_numpy(), b.column("doc_id").to_numpy(), texts))
            size += sum(map(len, texts))
            if size >= BLOCKS:
                yield rows()
                held, size = [], 0
        if held:
            yield rows()

    return docs.select("batch", "doc_id", "text").mapInArrow(run, schema)


def _squeezed(*parts) -> bytes:
    return zstandard.compress(b"".join(x if isinstance(x, bytes) else x.tobytes() for x in parts), 3)


def _texts(blocks: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Ids and texts of a batch."""
    ids, texts = [np.zeros(0, np.int64)], []
    for data in blocks.column("block").to_pylist():
        data = zstandard.decompress(data)
        n = int(np.frombuffer(data, "<i8", 1)[0])
        ids.append(np.frombuffer(data, "<i8", n, 8))
        at = 8 + 16 * n
        for size in np.frombuffer(data, "<i8", n, 8 + 8 * n).tolist():
            texts.append(data[at : at + size])
            at += size
    return np.concatenate(ids), texts


def _batch_segments(blocks: pa.Table, shared: pa.Table, buckets: int, length: int) -> pa.Table:
    """batch, bucket, segs: the batch's distinct pieces with a shared anchor, the least document of each, and whether it has several."""
    ids, texts = _texts(blocks)
    keys, hashes, owners, sizes, pieces = [], [], [], [], []
    for data, key, text, begin, count, h, first in _units(texts, _anchors(shared, False), _anchors(shared, True), length):
        order = np.argsort(h, kind="stable")
        new = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]]) if len(h) else np.zeros(0, np.int64)
        own = ids[text.astype(np.int64) + first][order]
        take = order[new]
        keys.append(key[take])
        hashes.append(h[take])
        owners.append(np.stack([np.minimum.reduceat(own, new), np.maximum.reduceat(own, new)], 1) if len(new) else np.zeros((0, 2), np.int64))
        sizes.append(count[take] + length - 1)
        raw = data.tobytes()
        pieces += [raw[a : a + n] for a, n in zip(begin[take].tolist(), sizes[-1].tolist(), strict=True)]
    out: dict[str, list] = {"batch": [], "bucket": [], "segs": []}
    if pieces:
        key, h, own, size = (np.concatenate(x) for x in (keys, hashes, owners, sizes))
        order = np.argsort(h, kind="stable")
        new = np.flatnonzero(np.r_[True, h[order][1:] != h[order][:-1]])
        low, high = np.minimum.reduceat(own[order, 0], new), np.maximum.reduceat(own[order, 1], new)
        take = order[new]
        bucket = _bucket(key[take], buckets)
        by = np.lexsort((low, bucket))
        batch = blocks.column("batch")[0].as_py()
        for k, lo, hi in _cut(bucket[by]):
            at = by[lo:hi]
            out["batch"].append(batch)
            out["bucket"].append(k)
            short = (key[take][at] >> np.uint64(17)).astype("<u2")  # tells anchors of a bucket apart, most of the time
            strings = (size[take][at] - length).astype(np.uint8)
            out["segs"].append(_squeezed(np.array([len(at)], "<i8"), short, np.diff(low[at], prepend=0).astype("<i8"), (high > low)[at].astype(np.uint8), strings, *(pieces[i] for i in take[at].tolist())))
    return pa.table({"batch": pa.array(out["batch"], pa.int32()), "bucket": pa.array(out["bucket"], pa.int32()), "segs": pa.array(out["segs"], pa.binary())})


def _least_documents(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """batch, found: for the pieces of each batch the least document of every string, where that can matter."""
    schema = "batch int, found binary"

    def close(now: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        key, h, low, several, size, owner, body = [], [], [], [], [], [], []
        for i, (_, data) in enumerate(now):
            data = zstandard.decompress(data)
            n = int(np.frombuffer(data, "<i8", 1)[0])
            key.append(np.frombuffer(data, "<u2", n, 8))
            low.append(np.cumsum(np.frombuffer(data, "<i8", n, 8 + 2 * n)))
            several.append(np.frombuffer(data, np.uint8, n, 8 + 10 * n).astype(bool))
            size.append(np.frombuffer(data, np.uint8, n, 8 + 11 * n).astype(np.int64) + length)
            body.append(np.frombuffer(data, np.uint8, offset=8 + 12 * n))
            owner.append(np.full(n, i, np.int32))
            ends = np.cumsum(size[-1]).tolist()
            view = memoryview(body[-1])
            h.append(np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip([0, *ends], ends)), np.uint64, n))
        key, h, low, several, size, owner, data = (np.concatenate(x) for x in (key, h, low, several, size, owner, body))
        begin = np.cumsum(size) - size
        order = np.argsort(key, kind="stable")
        strings = np.cumsum(size[order] - length + 1)
        start = 0
        while start < len(order):
            end = int(np.searchsorted(strings, (strings[start - 1] if start else 0) + SORTED)) + 1
            end = int(np.searchsorted(key[order], key[order[min(end, len(order)) - 1]], "right"))  # all of the last anchor
            take = order[start:end]
            yield classes([b for b, _ in now], data, begin[take], h[take], low[take], several[take], size[take], owner[take])
            start = end

    def classes(batch: list[int], data: np.ndarray, begin: np.ndarray, h: np.ndarray, low: np.ndarray, several: np.ndarray, size: np.ndarray, owner: np.ndarray) -> pa.RecordBatch:
        n = size - length + 1
        first = np.cumsum(n) - n
        piece = np.repeat(np.arange(len(n), dtype=np.int32), n)
        starts = np.repeat(begin - first, n) + np.arange(int(n.sum()))
        order, new = deep_shallow_sort(data, starts, length)
        least_of = np.minimum.reduceat(low[piece[order]], np.flatnonzero(new))
        least = np.empty(len(starts), np.int64)
        least[order] = least_of[np.cumsum(new) - 1]
        low_of_piece, high_of_piece = np.minimum.reduceat(least, first), np.maximum.reduceat(least, first)
        useful = np.flatnonzero(several | (low_of_piece < low))
        useful = useful[np.argsort(owner[useful], kind="stable")]
        flat = low_of_piece == high_of_piece
        out: dict[str, list] = {"batch": [], "found": []}
        for i, a, b in _cut(owner[useful]):
            mine = useful[a:b]
            one, many = mine[flat[mine]], mine[~flat[mine]]
            values = np.concatenate([least[first[k] : first[k] + n[k]] for k in many]) if len(many) else np.zeros(0, np.int64)
            out["batch"].append(batch[i])
            out["found"].append(b"".join([np.array([len(one), len(many)], "<i8").tobytes(), h[one].astype("<u8").tobytes(), low_of_piece[one].astype("<i8").tobytes(), h[many].astype("<u8").tobytes(), n[many].astype("<i8").tobytes(), values.astype("<i8").tobytes()]))
        return common.record(out, schema)

    current, now = None, []
    for b in batches:
        for bucket, batch, data in zip(*(b.column(c).to_pylist() for c in ("bucket", "batch", "segs")), strict=True):
            if bucket != current and now:
                yield from close(now)
                now = []
            current = bucket
            now.append((batch, data))
    if now:
        yield from close(now)


def _lookup(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sorted hashes of pieces, where their least documents start, how many there are, and those."""
    h, n, values = [], [], []
    for data in table.column("found").to_pylist():
        if data is None:
            continue
        one, many = (int(x) for x in np.frombuffer(data, "<i8", 2))
        h += [np.frombuffer(data, "<u8", one, 16), np.frombuffer(data, "<u8", many, 16 + 16 * one)]
        n += [np.ones(one, np.int64), np.frombuffer(data, "<i8", many, 16 + 16 * one + 8 * many)]
        values += [np.frombuffer(data, "<i8", one, 16 + 8 * one), np.frombuffer(data, "<i8", offset=16 + 16 * one + 16 * many)]
    if not h:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, n, values = np.concatenate(h), np.concatenate(n), np.concatenate(values)
    order = np.argsort(h, kind="stable")
    return h[order], (np.cumsum(n) - n)[order], n[order], values


def removed_bytes(texts: list[bytes], ids: np.ndarray, found: pa.Table, length: int) -> list[np.ndarray | None]:
    """For each text which of its bytes go; None for none."""
    h, at, n, values = _lookup(found)
    out: list[np.ndarray | None] = [None] * len(texts)
    if not len(h):
        return out
    for data, _, text, begin, count, own, first in _units(texts, None, _anchors(found, True), length):
        place = np.minimum(np.searchsorted(h, own), len(h) - 1)
        hit = np.flatnonzero(h[place] == own)
        if not len(hit):
            continue
        place, text, begin, count = place[hit], text[hit].astype(np.int64), begin[hit], count[hit]
        doc = ids[text + first]
        cover = np.zeros(len(data) + 1, np.int32)
        one = n[place] == 1
        whole = one & (values[at[place]] < doc)
        np.add.at(cover, begin[whole], 1)
        np.add.at(cover, begin[whole] + count[whole] + length - 1, -1)
        rest = np.flatnonzero(~one)
        times = n[place[rest]]
        inner = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        gone = values[np.repeat(at[place[rest]], times) + inner] < np.repeat(doc[rest], times)
        starts = (np.repeat(begin[rest], times) + inner)[gone]
        np.add.at(cover, starts, 1)
        np.add.at(cover, starts + length, -1)
        mask = np.cumsum(cover[:-1]) > 0
        start = 0
        for i in range(first, len(texts)):
            if start >= len(data):
                break
            own_mask = mask[start : start + len(texts[i])]
            start += len(texts[i])
            if own_mask.any():
                out[i] = own_mask
    return out


def _marked(docs: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """The texts by batch, and what was found for each batch."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = common.partitions(spark, size)
    # enough of both for all tasks, but a MB of text for each at least: every batch may send to every bucket
    buckets = max(1, -(-size // BUCKET), min(4 * parts, size >> 20))
    batches = max(1, -(-size // BATCH), min(2 * parts, size >> 20))
    dealt = docs.withColumn("batch", F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int"))
    shared = common.saved(_shared_anchors(dealt, buckets, length, batches, parts)).repartition(parts, "batch")

    def hand_on(left: pa.Table, right: pa.Table) -> pa.Table:
        return _batch_segments(left, right, buckets, length) if left.num_rows and right.num_rows else pa.table({"batch": pa.array([], pa.int32()), "bucket": pa.array([], pa.int32()), "segs": pa.array([], pa.binary())})

    # both sides of a batch in one of so many tasks
    blocks = _blocks(dealt).repartition(parts, "batch")
    pieces = blocks.groupBy("batch").cogroup(shared.groupBy("batch")).applyInArrow(hand_on, "batch int, bucket int, segs binary")
    found = pieces.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(lambda it: _least_documents(it, length), "batch int, found binary")
    found = found.withColumns({"hot": F.lit(False), "anchors": F.lit(None).cast("binary")})
    hot = shared.where("hot").withColumn("found", F.lit(None).cast("binary")).select("batch", "found", "hot", "anchors")
    return blocks, found.unionByName(hot).repartition(parts, "batch")


def suffix_dedup(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay): one row per input row."""
    texts = common.texts_of(docs, id_col, text_col).withColumn("doc_id", F.coalesce("doc_id", F.lit(LAST)))
    blocks, found = _marked(texts, length)

    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, texts = _texts(left)
        gone = removed_bytes(texts, ids, right, length) if right.num_rows else [None] * len(texts)
        spans = [0 if m is None else int(np.count_nonzero(np.diff(m.astype(np.int8), prepend=0) == 1)) for m in gone]
        kept = [t if m is None else np.frombuffer(t, np.uint8)[~m].tobytes() for t, m in zip(texts, gone, strict=True)]
        return pa.table({
            "doc_id": pa.array(ids, pa.int64(), mask=ids == LAST), "n_bytes": pa.array([len(t) for t in texts], pa.int64()), "n_removed": pa.array([len(t) - len(k) for t, k in zip(texts, kept, strict=True)], pa.int64()),
            "n_spans": pa.array(spans, pa.int64()), "kept": pa.array(kept, pa.binary()),
        })

    return blocks.groupBy("batch").cogroup(found.groupBy("batch")).applyInArrow(remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")

