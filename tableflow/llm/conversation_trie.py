"""Prefix trie over conversations: z-fast tries over sorted ranges, whose shared paths are added up.

A conversation is written as the chain of its prefixes' hashes (128 bits of BLAKE2b over the hash before it and the turn), so
equal prefixes have equal hashes and conversations that share a prefix are neighbours when chains are sorted. The chains are sorted once, by
chain and id, into ranges: equal conversations and a frequent first turn spread over as many ranges as they need. Each range
builds a z-fast trie: a compacted trie whose nodes are hashed by the prefix at their two-fattest depth, so a chain finds
the node it leaves the trie at by a binary search over depths, with one look-up a step. Chains are inserted a batch at
a time: all of a batch are located first, then each goes on from there. In the end edges are expanded to a node a depth.

Only nodes on the path that a range shares with a neighbour need others' numbers. All that is told of a node is a sum or
a minimum over the ranges that hold it: members, code points that members have from it on, code points of distinct nodes (one
range owns a shared node: the first), leaves (whether the next range goes on from a range's last conversation is known
from the first chain of that range). These few rows are added up; others are final. The hash of the ids
that end at a node is taken where they are sorted; ids of a group that goes over ranges travel on as pieces of text and are hashed in order, one piece at a time.

Results for the odd cases: turns are ordered with NULL first, then by role, then by a hash of role and text; NULL role and text
are empty; rows without a conversation's id belong to none and are left out; c % 100 has the sign of c; repeated rows are
turns of their own. An empty table has no nodes, not even a root. Other columns cannot clash. A conversation's own
turns are read as a stream, only its chain (20 bytes a turn) is held in memory.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

#: Bytes of one prefix's hash.
WIDTH = 16
#: Conversations of a hundred take up to so many turns, less one, from the first of them.
HUNDRED, SHARED = 100, 6
#: Bytes of chains in a range, and of ids' text in a piece.
RANGE_BYTES, PIECE_BYTES = 8 << 20, 1 << 20


def shared_turns(conv_id: int) -> int:
    """How many turns a conversation takes from the first of its hundred."""
    return zlib.crc32(str(conv_id).encode()) % SHARED


def chained(before: bytes, turn: bytes) -> bytes:
    return hashlib.blake2b(before + turn, digest_size=WIDTH).digest()


def _turns(df: DataFrame) -> DataFrame:
    """A row for each turn with a hash of its role and text in place of them; the lengths keep role and text apart."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    conv = F.col("conv_id").cast("long")
    return df.where(conv.isNotNull()).select(
        (conv - conv % HUNDRED).alias("base"), conv.alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)).alias("hash"), F.char_length(text).cast("int").alias("points"),
    )


def rebuilt(df: DataFrame) -> DataFrame:
    """conv_id, chain, points: every conversation with the hashes of its prefixes and the code points of its turns, both as bytes.

    A hundred of conversations comes to one task in order, its first conversation ahead; turns are read as a stream.
    """
    schema = "conv_id long, chain binary, points binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, first, conv, keep, seen = None, [], None, 0, 0
        chain: list[bytes] = []
        points: list[int] = []
        out: dict[str, list] = {"conv_id": [], "chain": [], "points": []}
        held = 0

        def close() -> None:
            nonlocal held
            if conv is not None:
                out["conv_id"].append(conv)
                out["chain"].append(b"".join(chain))
                out["points"].append(np.array(points, "<i4").tobytes())
                held += 20 * len(points) + 32

        for batch in batches:
            columns = [batch.column(c) for c in ("base", "conv_id", "hash", "points")]
            for of, c, turn, n in zip(*(x.to_pylist() for x in columns), strict=True):
                if c != conv:
                    close()
                    if of != base:
                        base, first = of, []
                    conv, seen = c, 0
                    keep = shared_turns(c)
                    chain, points = [], []
                    for t, k in first[:keep] if c != of else []:
                        chain.append(chained(chain[-1] if chain else b"", t))
                        points.append(k)
                    if held > common.SLICE_BYTES:
                        yield common.record(out, schema)
                        out, held = {k: [] for k in out}, 0
                if c == of and seen < SHARED - 1:
                    first.append((turn, n))
                seen += 1
                if c == of or seen > keep:
                    chain.append(chained(chain[-1] if chain else b"", turn))
                    points.append(n)
        close()
        if out["conv_id"]:
            yield common.record(out, schema)

    turns = _turns(df)
    dealt = turns.repartition(common.partitions(df.sparkSession), "base")
    ordered = dealt.sortWithinPartitions("base", (F.col("conv_id") != F.col("base")), "conv_id", F.col("turn").asc_nulls_first(), "role", "hash")
    return ordered.select("base", "conv_id", "hash", "points").mapInArrow(run, schema)


def fattest(low: int, high: int) -> int:
    """The number in (low, high] that the most powers of two divide."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """A compacted trie over chains of prefix hashes. Node 0 is the root; all that a node has is in lists by its number."""

    def __init__(self) -> None:
        self.low, self.high, self.chain, self.parent, self.end = [-1], [0], [b""], [-1], [-1]
        self.handles: dict[bytes, int] = {}  # by the prefix at the two-fattest depth of a node's edge
        self.edges: dict[bytes, int] = {}  # by the prefix one turn beyond the parent

    @staticmethod
    def prefix(chain: bytes, depth: int) -> bytes:
        return chain[(depth - 1) * WIDTH : depth * WIDTH]

    def locate(self, chain: bytes, above: int = 0) -> tuple[int, int]:
        """The node whose edge the chain leaves the trie on (or ends at), and the depth that they share, by fat binary search from a node above."""
        prefix, n = self.prefix, len(chain) // WIDTH
        node, low, high = above, self.high[above], n
        while low < high:
            f = fattest(low, high)
            found = self.handles.get(prefix(chain, f))
            if found is None:
                high = f - 1
            elif (e := self.high[found]) <= n and prefix(chain, e) == prefix(self.chain[found], e):
                node, low = found, e
            else:
                return found, self.common(chain, found, f)
        if self.high[node] < n:  # it may leave on an edge before that edge's handle
            child = self.edges.get(prefix(chain, self.high[node] + 1))
            if child is not None:
                return child, self.common(chain, child, self.high[node] + 1)
        return node, self.high[node]

    def common(self, chain: bytes, node: int, low: int) -> int:
        """The depth to which a chain and a node agree, given that they do to depth low."""
        high = min(len(chain) // WIDTH, self.high[node])
        while low < high:
            mid = (low + high + 1) // 2
            if self.prefix(chain, mid) == self.prefix(self.chain[node], mid):
                low = mid
            else:
                high = mid - 1
        return low

    def _node(self, low: int, high: int, chain: bytes, parent: int) -> int:
        for x, v in ((self.low, low), (self.high, high), (self.chain, chain), (self.parent, parent), (self.end, -1)):
            x.append(v)
        node = len(self.low) - 1
        self.edges[self.prefix(chain, low + 1)] = node
        self.handles[self.prefix(chain, fattest(low, high))] = node
        return node

    def insert(self, chain: bytes, above: int = 0) -> int:
        """The node that the chain ends at, made if need be; above is a node on its path."""
        node, depth = self.locate(chain, above)
        if depth < self.high[node]:  # part the edge
            low, upper = self.low[node], self.parent[node]
            del self.handles[self.prefix(self.chain[node], fattest(low, self.high[node]))]
            middle = self._node(low, depth, self.chain[node], upper)
            self.low[node], self.parent[node] = depth, middle
            self.edges[self.prefix(self.chain[node], depth + 1)] = node
            self.handles[self.prefix(self.chain[node], fattest(depth, self.high[node]))] = node
            node = middle
        n = len(chain) // WIDTH
        return self._node(depth, n, chain, node) if depth < n else node

    def insert_batch(self, chains: list[bytes]) -> list[int]:
        """Locate all of a batch in the trie as it is, then insert each from the last whole node on its path."""
        starts = []
        for c in chains:
            node, depth = self.locate(c)
            starts.append(node if depth == self.high[node] else self.parent[node])  # a node that stays on the path, whatever is inserted meanwhile
        return [self.insert(c, node) for c, node in zip(chains, starts, strict=True)]


_PARTIAL = (
    "key binary, parent binary, depth int, conv_id long, n_convs long, n_children long, n_leaves long, flow long, own long, shared boolean, under_shared boolean, parent_conv long, ends binary, part int, piece int, ids string"
)
_NO_ENDS = hashlib.sha256(b"").digest()


class _Range:
    """One sorted range: its trie, and what is known of its members."""

    def __init__(self, part: int, before: int, after: int, same_before: bool, same_after: bool, goes_on: bool):
        #: Depths to which the first chain agrees with the range before (-1: there is none) and the last one with the range after.
        self.part, self.before, self.after, self.goes_on, self.same = part, before, after, goes_on, (same_before, same_after)
        self.trie = ZFastTrie()
        self.members: dict[int, list[int]] = {}  # of a node that chains end at: how many, the least id
        self.points: dict[int, np.ndarray] = {}
        self.ends: dict[int, bytes] = {}
        self.pieces: list[tuple[int, int, str]] = []
        self.first_node = self.last_node = -1

    def add(self, groups: list[tuple[bytes, bytes, list[int], bool, bool]]) -> None:
        """groups: chain, points, ids in order, whether the group's first and last ids are here."""
        nodes = self.trie.insert_batch([g[0] for g in groups])
        for node, (chain, points, ids, opens, closes) in zip(nodes, groups, strict=True):
            if self.first_node < 0:
                self.first_node = node
            self.last_node = node
            known = self.members.get(node)
            if known is None:
                self.members[node] = [len(ids), ids[0]]
                self.points[node] = np.frombuffer(points, "<i4").astype(np.int64)
            else:
                known[0] += len(ids)
            whole = opens and closes and known is None and not (self.first_node == node and self.same[0])
            if whole:
                self.ends[node] = ids_hash(ids)
            else:
                self.pieces.append((node, len(self.pieces), ",".join(map(str, ids))))

    def rows(self) -> Iterator[dict]:
        """Partial rows of all nodes, edges expanded."""
        t = self.trie
        if not self.members:
            return
        # a group of the last chain that the next range carries on is told by its pieces
        if self.same[1] and self.last_node in self.ends:
            raise RuntimeError("a group that goes on was closed")
        count = len(t.low)
        n, least, kids, leaves = [0] * count, [None] * count, [0] * count, [0] * count
        flow, own = [0] * count, [0] * count  # at the lowest depth of a node's edge, of all below it
        on_first, on_last = self._path(self.first_node), self._path(self.last_node)
        order = sorted(range(count), key=t.high.__getitem__, reverse=True)
        out: dict[str, list] = {f.split()[0]: [] for f in _PARTIAL.split(", ")}
        pieces_of: dict[int, list[tuple[int, str]]] = {}
        for node, k, ids in self.pieces:
            pieces_of.setdefault(node, []).append((k, ids))
        tables = []
        points_of = dict(self.points)
        for node in order:
            low, high = t.low[node], t.high[node]
            has, at = self.members.get(node, (0, None))
            n[node] += has
            if at is not None:
                least[node] = at if least[node] is None else min(least[node], at)
            points = points_of.get(node)
            is_leaf = not kids[node] and not (node == self.last_node and self.goes_on)
            if is_leaf:
                leaves[node] += 1
            steps = points[max(low, 0) : high] if low >= 0 else np.zeros(1, np.int64)
            depths = np.arange(low + 1, high + 1)
            after = np.cumsum(steps[::-1])[::-1]
            # a shared node belongs to the first range that has it
            mine = (depths > self.before) | (node not in on_first)
            flows, owns = flow[node] + n[node] * after, own[node] + np.cumsum((steps * mine)[::-1])[::-1]
            tables.append((node, depths, flows, owns, mine))
            up = t.parent[node]
            if up >= 0:
                n[up] += n[node]
                least[up] = least[node] if least[up] is None else min(least[up], least[node])
                leaves[up] += leaves[node]
                flow[up] += int(flows[0])
                own[up] += int(owns[0])
                kids[up] += 1
                if t.high[up] > 0 and up not in points_of:
                    points_of[up] = points
        owned_kids = [0] * count
        for node, depths, _, _, mine in tables:
            if (up := t.parent[node]) >= 0 and mine[0]:
                owned_kids[up] += 1
        for node, depths, flows, owns, mine in tables:
            chain, parent = t.chain[node], t.parent[node]
            shared = (depths <= self.before) & (node in on_first) | (depths <= self.after) & (node in on_last)
            last = len(depths) - 1
            for i, d in enumerate(depths.tolist()):
                end = i == last
                above = i == 0
                up_shared = d > 0 and (bool(shared[i - 1]) if not above else self._shared(parent, on_first, on_last))
                row = (
                    t.prefix(chain, d) if d else b"", t.prefix(chain, d - 1) if d > 1 else b"" if d else None, d, least[node], n[node], owned_kids[node] if end else int(mine[i + 1]), leaves[node], int(flows[i]), int(owns[i]),
                    bool(shared[i]), up_shared, (least[parent] if above else least[node]) if d else None, self.ends.get(node) if end else None, None, None, None,
                )
                for k, v in zip(out, row, strict=True):
                    out[k].append(v)
                for k, ids in pieces_of.get(node, []) if end else []:
                    for name, v in zip(out, (row[0], None, d, None, 0, 0, 0, 0, 0, True, False, None, None, self.part, k, ids), strict=True):
                        out[name].append(v)
                if len(out["key"]) >= 10_000:
                    yield out
                    out = {k: [] for k in out}
        yield out

    def _path(self, node: int) -> set[int]:
        path = set()
        while node >= 0:
            path.add(node)
            node = self.trie.parent[node]
        return path

    def _shared(self, node: int, on_first: set[int], on_last: set[int]) -> bool:
        d = self.trie.high[node]
        return d <= self.before and node in on_first or d <= self.after and node in on_last


def ids_hash(ids: list[int]) -> bytes:
    return hashlib.sha256(",".join(map(str, ids)).encode()).digest()


def _agreement(a: bytes | None, b: bytes | None) -> int:
    """To how many prefixes two chains agree; -1 if there is no other."""
    if a is None or b is None:
        return -1
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[(mid - 1) * WIDTH : mid * WIDTH] == b[(mid - 1) * WIDTH : mid * WIDTH] else (low, mid - 1)
    return low


def _bounds(ranges: DataFrame) -> DataFrame:
    """part, before, after, same_before, same_after, goes_on: how each range meets its neighbours; one row a range.

    goes_on says that the next range holds the last chain or one that begins with it, so that it tells whether that is a leaf.
    """
    ends = ranges.groupBy("part").agg(F.min("chain").alias("first"), F.max("chain").alias("last"))
    order = Window.orderBy("part")
    near = ends.select("part", "first", "last", F.lag("last").over(order).alias("previous"), F.lead("first").over(order).alias("next"))

    def run(b: pa.RecordBatch) -> dict:
        first, last, previous, after = (b.column(c).to_pylist() for c in ("first", "last", "previous", "next"))
        met = [_agreement(x, y) for x, y in zip(last, after, strict=True)]
        return {
            "part": b.column("part"), "before": [_agreement(x, y) for x, y in zip(first, previous, strict=True)], "after": met, "same_before": [x == y for x, y in zip(first, previous, strict=True)],
            "same_after": [x == y for x, y in zip(last, after, strict=True)], "goes_on": [m == len(x) // WIDTH for x, m in zip(last, met, strict=True)],
        }

    return common.map_arrow(near, run, "part int, before int, after int, same_before boolean, same_after boolean, goes_on boolean")


def _partials(ranges: DataFrame, bounds: DataFrame) -> DataFrame:
    """Rows of every range's nodes, and pieces of ids (piece is not NULL)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, chain, points, ids, opens = None, None, b"", [], True
        groups: list = []
        size = 0
        for batch in batches:
            for b in common.slices(batch):
                if found is None and b.num_rows:
                    found = _Range(*(b.column(c)[0].as_py() for c in ("part", "before", "after", "same_before", "same_after", "goes_on")))
                for c, p, i in zip(b.column("chain").to_pylist(), b.column("points").to_pylist(), b.column("conv_id").to_pylist(), strict=True):
                    if c != chain or size >= PIECE_BYTES:
                        if chain is not None:
                            groups.append((chain, points, ids, opens, c != chain))
                        opens = c != chain
                        chain, points, ids, size = c, p, [], 0
                    ids.append(i)
                    size += 12
                if found is not None:
                    found.add(groups)
                    groups = []
        if found is not None:
            found.add([(chain, points, ids, opens, not found.same[1])])
            for out in found.rows():
                yield common.record(out, _PARTIAL)

    # the ranges are as they were saved: a broadcast keeps each in its partition and in its order
    return ranges.join(F.broadcast(bounds), "part").mapInArrow(run, _PARTIAL)


def _hashed_pieces(pieces: DataFrame) -> DataFrame:
    """key, ends: the hash over a group's pieces in their order, read as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        done: dict[str, list] = {"key": [], "ends": []}
        for b in batches:
            for k, ids in zip(b.column("key").to_pylist(), b.column("ids").to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        done["key"].append(key)
                        done["ends"].append(state.digest())
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
        if key is not None:
            done["key"].append(key)
            done["ends"].append(state.digest())
            yield common.record(done, "key binary, ends binary")

    dealt = pieces.repartition(common.partitions(pieces.sparkSession), "key").sortWithinPartitions("key", "part", "piece")
    return dealt.select("key", "ids").mapInArrow(run, "key binary, ends binary")


def prefix_trie(df: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row for each node of the trie."""
    chains = common.saved(rebuilt(df))
    size = chains.agg(F.coalesce(F.sum(F.octet_length("chain") + 40), F.lit(0))).first()[0]
    parts = common.partitions(df.sparkSession, size, RANGE_BYTES)
    ranges = chains.repartitionByRange(parts, "chain", "conv_id").sortWithinPartitions("chain", "conv_id")
    ranges = common.saved(ranges.withColumn("part", F.spark_partition_id()))
    rows = common.saved(_partials(ranges, _bounds(ranges)))
    nodes, pieces = rows.where("piece is null"), rows.where("piece is not null")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "flow", "own")]
    merged = nodes.where("shared").groupBy("key", "depth", "parent").agg(F.min("conv_id").alias("conv_id"), *sums, F.max("ends").alias("ends"))
    hashed = common.small_side(_hashed_pieces(pieces).withColumnRenamed("ends", "_ends"))
    merged = common.saved(merged.join(hashed, "key", "left").withColumn("ends", F.coalesce("_ends", "ends")).drop("_ends"))
    # a chain that ends within one range but in several pieces
    alone = nodes.where("not shared").join(hashed, "key", "left").withColumn("ends", F.coalesce("_ends", "ends"))
    least = common.small_side(merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("_least")))
    own = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", (F.col("flow") - F.col("own")).alias("saved_tokens"), F.lower(F.hex(F.coalesce("ends", F.lit(_NO_ENDS)))).alias("ends_sha256")]
    known = alone.where("not under_shared").select(F.col("parent_conv").alias("parent_conv_id"), *own)
    below = alone.where("under_shared").join(least, "parent").select(F.col("_least").alias("parent_conv_id"), *own)
    shared = merged.join(least, "parent", "left").select(F.when(F.col("depth") > 0, F.col("_least")).alias("parent_conv_id"), *own)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return known.unionByName(below).unionByName(shared).withColumn("depth", F.col("depth").cast("long")).select(*columns)
