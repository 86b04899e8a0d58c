"""Near-duplicate vectors by product quantisation.

Vectors are normalised; equal ones count as one with a multiplicity. A coarse quantiser (k-means on a bounded sample)
gives every vector a home list within its label, and the residual to the list's centre is coded in subspaces, a byte each; the
codes are stored with the lists. To find the neighbours of a vector, its distances to the coded members of a list are looked up
(asymmetric: only the member is quantised): a vector has one table of products with all codes of all subspaces, whatever the list, and a
member's entries are added up. Exact cosines rerank what the table lets pass.

With d the greatest distance that unit vectors at the threshold may have, a list is probed when a neighbour could live
there: moving by d can change the difference of the squared distances to two centres by 2 d times the centres'
distance at most. A member is reranked when its tabled distance is at most d plus its own quantisation error. Both bounds
lose nothing; the sample affects speed alone, and every vector is indexed and queried.

Lists are numbered so that near ones follow each other, and runs of them with about ``BLOCK`` members go to one task, so a
vector is sent once for a run and not for each of its lists. Of two lists only the vectors of the first query the second, and
what they find counts for both. A run with more members is cut in blocks, and the vectors that query it in slices of about
``QUERIES``; each block meets each slice. Counts add up over blocks, and links leave a block as a spanning forest.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing, like those without a label;
vectors of different lengths never link; lengths with few vectors have one list. A vector without a vec_id takes no part and
comes back without one. Repeated vec_ids are one vector if the rows are equal; if they differ, n_links is the greatest and
component_id the least of theirs. Other columns cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .components import components

COSINE = 0.93
#: Coarse lists (the root of the number of vectors, within these); vectors of the sample that fits them: at least, for a list, and over all lengths of vectors.
LISTS, MOST_LISTS = 16, 4096
SAMPLE, SAMPLE_A_LIST, SAMPLES = 8192, 8, 65536
#: Vectors of one length from which it gets lists of its own.
FEW = 64
#: Subspaces and codes in each.
SUBSPACES, CODES = 16, 256
#: Members and queries that one task compares, and how many queries have their tables at a time.
BLOCK, QUERIES, TABLED = 16384, 16384, 512
#: Lists of all labels together that are broadcast; more come with the rows.
SHARED_LISTS = 1_000_000
#: None is exact. A number allows a neighbour that many deviates of a move in a random direction, and loses others.
SIGMAS = None


def normalised(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors, in double precision."""
    scaled = x / np.abs(x).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def k_means(x: np.ndarray, k: int, seed: int, rounds: int = 8) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        near = squared(x, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def in_turn(centres: np.ndarray) -> np.ndarray:
    """An order in which near centres follow each other: halves by the widest direction, again and again."""
    if len(centres) < 3:
        return np.arange(len(centres))
    away = centres - centres.mean(0)
    order = np.argsort(away @ np.linalg.svd(away, full_matrices=False)[2][0], kind="stable")
    half = len(order) // 2
    return np.concatenate([part[in_turn(centres[part])] for part in (order[:half], order[half:])])


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


class Index:
    """The coarse centres and the codes of the residuals' subspaces, for vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int = LISTS, subspaces: int = SUBSPACES, codes: int = CODES, seed: int = 7):
        self.centres = k_means(sample, lists, seed) if len(sample) > 1 else np.zeros((1, sample.shape[1]))
        self.centres = self.centres[in_turn(self.centres)]
        home = squared(sample, self.centres).argmin(1)
        residuals = sample - self.centres[home]
        width = sample.shape[1]
        self.edges = np.linspace(0, width, min(subspaces, width) + 1).astype(int)
        self.books = [k_means(residuals[:, a:b], codes, seed + 1) for a, b in zip(self.edges[:-1], self.edges[1:], strict=True)]

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes (rows, subspaces) and how far each residual is from what its codes stand for."""
        codes = np.stack([squared(residuals[:, a:b], book).argmin(1) for a, b, book in zip(self.edges[:-1], self.edges[1:], self.books, strict=True)], 1)
        return codes.astype(np.uint8), np.sqrt(((residuals - self.decode(codes)) ** 2).sum(1))

    def decode(self, codes: np.ndarray) -> np.ndarray:
        return np.hstack([book[c] for book, c in zip(self.books, codes.T, strict=True)])

    def tables(self, queries: np.ndarray, kind: type = float) -> list[np.ndarray]:
        """For each subspace (codes, queries): minus twice the product of a query and what the code stands for."""
        return [(-2 * book @ queries[:, a:b].T).astype(kind) for a, b, book in zip(self.edges[:-1], self.edges[1:], self.books, strict=True)]

    @staticmethod
    def looked_up(tables: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
        """(members, queries): each member's entries of the tables, added up."""
        out = tables[0][codes[:, 0]]
        for table, column in zip(tables[1:], codes.T[1:], strict=True):
            out += table[column]
        return out

    def tabled(self, queries: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Squared asymmetric distances of query residuals to coded members."""
        own = (self.decode(codes) ** 2).sum(1)
        return np.maximum((queries * queries).sum(1)[:, None] + own[None, :] + self.looked_up(self.tables(queries), codes).T, 0)

    def bias(self, codes: np.ndarray, centre: np.ndarray) -> np.ndarray:
        """What a coded member adds to the squared distance of any query to its centre, beside the entries of the table."""
        stand = self.decode(codes)
        return (stand * (stand + 2 * centre)).sum(1)

    def probes(self, x: np.ndarray, reach: float, sigmas: float | None) -> tuple[np.ndarray, np.ndarray]:
        """Home list of each vector, and which lists could hold one within reach.

        A member of list c is nearer to c than to the home of x; a move of length reach can shift the difference of
        the squared distances to two centres by 2 * reach * (their distance) at most.
        """
        d = squared(x, self.centres)
        home = d.argmin(1)
        apart = np.sqrt(squared(self.centres, self.centres))[home]
        share = 1 if sigmas is None else min(1, sigmas / x.shape[1] ** 0.5)
        return home, d - d[np.arange(len(x)), home][:, None] <= 2 * share * reach * apart + 1e-9


class _Members(NamedTuple):
    """Members of one list: places, vectors, codes, what these leave out, the bias of each, and distances to the centre."""

    at: np.ndarray
    v: np.ndarray
    codes: np.ndarray
    error: np.ndarray
    bias: np.ndarray
    far: np.ndarray


def _within(tables: list[np.ndarray], centre: np.ndarray, queries: np.ndarray, m: _Members, cosine: float, reach: float):
    """Pairs (query place, member place) that reach the cosine; the tables are those of the queries."""
    away = np.sqrt(squared(queries, centre[None, :])[:, 0])
    d = Index.looked_up(tables, m.codes)
    d += (away**2).astype(np.float32)[None, :]
    # entries are in single precision; what that may lose is far below the slack
    near = d <= ((reach + m.error) ** 2 - m.bias + 1e-4).astype(np.float32)[:, None]
    near &= np.abs(away[None, :] - m.far[:, None]) <= reach + 1e-6
    j, i = np.nonzero(near)
    for s in range(0, len(i), 1 << 16):
        a, b = i[s : s + (1 << 16)], j[s : s + (1 << 16)]
        ok = (queries[a] * m.v[b]).sum(1) >= cosine
        yield a[ok], b[ok]


def _forest(n: int, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of links between n places: breadth first, whole neighbourhoods at a time."""
    both = np.concatenate([a, b]), np.concatenate([b, a])
    order = np.argsort(both[0], kind="stable")
    to = both[1][order]
    start = np.searchsorted(both[0][order], np.arange(n + 1))
    seen, out = np.zeros(n, bool), []
    for root in np.unique(a):
        if seen[root]:
            continue
        seen[root] = True
        work = [root]
        while work:
            u = work.pop()
            new = np.unique(to[start[u] : start[u + 1]])
            new = new[~seen[new]]
            seen[new] = True
            out += [(u, v) for v in new]
            work += list(new)
    return out


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", sigmas: float | None = SIGMAS) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vec_id (one for all rows without)."""
    reach = float(np.sqrt(2 - 2 * cosine)) + 1e-9
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast(kind).alias("v"), F.col(label_col).cast("string").alias("label"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where("vec_id is not null and label is not null and v is not null and size(v) > 0").where(finite).where(F.exists("v", lambda x: x != 0))
    # equal vectors of a label are one, under their smallest id
    distinct = common.saved(good.groupBy("label", "v").agg(F.min("vec_id").alias("u"), F.countDistinct("vec_id").alias("copies")))
    widths = {r["w"]: r["n"] for r in distinct.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).orderBy("w").collect()}
    lists = {w: int(min(MOST_LISTS, max(LISTS, n**0.5))) for w, n in widths.items() if n >= FEW}
    # of each length so many vectors by their hash, all in one job; SAMPLES bounds what comes to the driver
    wanted = {w: min(max(SAMPLE, SAMPLE_A_LIST * k), max(FEW, SAMPLES // len(lists))) for w, k in lists.items()}
    samples: dict[int, list] = {}
    if lists:
        scale = 1 << 30
        bound = F.create_map(*[x for w, n in wanted.items() for x in (F.lit(w), F.lit(int(scale * min(1, 1.5 * n / widths[w]))))])
        some = distinct.select("u", "v", F.size("v").alias("w"), F.pmod(F.xxhash64("u"), F.lit(scale)).alias("draw")).where(F.col("draw") < F.coalesce(bound[F.col("w")], F.lit(0)))
        some = some.withColumn("place", F.row_number().over(Window.partitionBy("w").orderBy("draw", "u", "v"))).where(F.col("place") <= F.create_map(*[x for w, n in wanted.items() for x in (F.lit(w), F.lit(n))])[F.col("w")])
        for r in some.orderBy("w", "place").select("w", "v").collect():
            samples.setdefault(r["w"], []).append(r["v"])
    indexes = {w: Index(normalised(np.array(samples[w], float)), lists[w]) if w in samples else Index(np.ones((1, w)) / w**0.5, 1) for w in widths}
    spark = vectors.sparkSession
    shared = spark.sparkContext.broadcast(indexes)  # MOST_LISTS + CODES vectors at most for each length that many vectors have

    def by_width(b: pa.RecordBatch):
        values = b.column("v").to_pylist()
        width = np.array([len(v) for v in values])
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            x = normalised(np.array([values[i] for i in at], float))
            yield w, at, x, shared.value[w].probes(x, reach, sigmas)

    def housed(b: pa.RecordBatch) -> dict:
        width, home = np.zeros(b.num_rows, int), np.zeros(b.num_rows, int)
        for w, at, _, (own, _) in by_width(b):
            width[at], home[at] = w, own
        return {"label": b.column("label"), "width": width, "home": home}

    of_label = ["label", "width"]
    before = Window.partitionBy(*of_label).orderBy("home").rowsBetween(Window.unboundedPreceding, -1)
    lists = common.map_arrow(distinct, housed, "label string, width int, home int").groupBy(*of_label, "home").agg(F.count("*").alias("n"))
    lists = lists.withColumn("run", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / BLOCK))
    # one row for each label and length: its lists (MOST_LISTS at most) and their runs
    runs = common.saved(lists.groupBy(*of_label).agg(F.sort_array(F.collect_list(F.struct("home", "run"))).alias("r")).select(*of_label, F.col("r.home").alias("lists"), F.col("r.run").alias("runs")))
    few = (runs.agg(F.sum(F.size("lists"))).first()[0] or 0) <= SHARED_LISTS
    known_runs = spark.sparkContext.broadcast({(r["label"], r["width"]): (np.array(r["lists"]), np.array(r["runs"])) for r in runs.collect()}) if few else None

    def place(b: pa.RecordBatch) -> dict:
        home, run, asks = np.zeros(b.num_rows, int), np.zeros(b.num_rows, int), [[]] * b.num_rows
        codes, error, bias = [b""] * b.num_rows, np.zeros(b.num_rows), np.zeros(b.num_rows)
        for w, at, x, (own, near) in by_width(b):
            index = shared.value[w]
            coded, error[at] = index.encode(x - index.centres[own])
            bias[at] = index.bias(coded, index.centres[own])
            for i, c in zip(at, coded, strict=True):
                codes[i] = c.tobytes()
            labels = b.column("label").take(pa.array(at)).to_pylist()
            first = {label: i for i, label in reversed(list(enumerate(labels)))}
            kinds = np.array([first[label] for label in labels])
            for f in np.unique(kinds):
                here = np.flatnonzero(kinds == f)
                cells, of = known_runs.value[labels[f], w] if few else (np.array(b.column(c)[at[f]].as_py()) for c in ("lists", "runs"))
                starts = np.flatnonzero(np.diff(of, prepend=-1))
                later = near[np.ix_(here, cells)] & (cells[None, :] >= own[here][:, None])
                met = np.logical_or.reduceat(later, starts, axis=1)
                for i, row in zip(here, met, strict=True):
                    home[at[i]], run[at[i]], asks[at[i]] = own[i], of[np.searchsorted(cells, own[i])], of[starts[row]]
        return {"label": b.column("label"), "width": b.column("width"), "home": home, "run": run, "asks": asks, "codes": codes, "error": error, "bias": bias, "u": b.column("u"), "copies": b.column("copies"), "v": b.column("v")}

    sized = distinct.withColumn("width", F.size("v"))
    sized = sized if few else sized.join(runs, of_label)
    known = common.saved(common.map_arrow(sized, place, f"label string, width int, home int, run long, asks array<long>, codes binary, error double, bias double, u long, copies long, v {kind}"))
    asked = known.select(*of_label, F.explode("asks").alias("run"), "u", "copies", "v", "home")
    sizes = known.groupBy(*of_label, "run").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    sizes = sizes.join(asked.groupBy(*of_label, "run").agg(F.ceil(F.count("*") / QUERIES).alias("slices")), [*of_label, "run"])
    cell = [*of_label, "run"]

    def every(n: str) -> F.Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))

    member = known.join(sizes, cell).withColumn("slice", every("slices")).select(*cell, F.pmod(F.xxhash64("u"), F.col("blocks")).alias("block"), "slice", "u", "copies", "v", "home", "codes", "error", "bias", F.lit(False).alias("asking"))
    query = asked.join(sizes, cell).withColumn("block", every("blocks")).select(*cell, "block", F.pmod(F.xxhash64("u", F.lit(1)), F.col("slices")).alias("slice"), "u", "copies", "v", "home", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("double").alias("error"), F.lit(None).cast("double").alias("bias"), F.lit(True).alias("asking"))

    def compare(table: pa.Table) -> pa.Table:
        width = table.column("width")[0].as_py()
        index = shared.value[width]
        u, copies = table.column("u").to_numpy(), table.column("copies").to_numpy()
        v = normalised(table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width))
        home, asking = table.column("home").to_numpy(), table.column("asking").to_numpy(zero_copy_only=False)
        queries = np.flatnonzero(asking)
        names, where = np.unique(u, return_inverse=True)
        n = np.zeros(len(names), np.int64)
        pairs: list[tuple[int, int]] = []
        error, bias = (table.column(c).to_numpy(zero_copy_only=False) for c in ("error", "bias"))
        stored = table.column("codes").combine_chunks()
        lists_here, held = np.unique(home[~asking]), []
        for c in lists_here:
            at = np.flatnonzero(~asking & (home == c))
            codes = np.frombuffer(b"".join(stored.take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), -1)
            held.append(_Members(at, v[at], codes, error[at], bias[at], np.sqrt(((v[at] - index.centres[c]) ** 2).sum(1))))
        for start in range(0, len(queries), TABLED):
            some = queries[start : start + TABLED]
            asks = index.probes(v[some], reach, sigmas)[1][:, lists_here] & (lists_here[None, :] >= home[some][:, None])
            tables = index.tables(v[some], np.float32)
            for c, all_of, wanted in zip(lists_here, held, asks.T, strict=True):
                sel = np.flatnonzero(wanted)
                if not len(sel):
                    continue
                own = tables if len(sel) == len(some) else [t[:, sel] for t in tables] if len(all_of.at) > CODES else None
                for part in range(0, len(all_of.at), 2048):
                    m = _Members(*[x[part : part + 2048] for x in all_of])
                    # of few members whole rows of the tables are cheaper than tables for the queries that ask
                    places = np.arange(len(some)) if own is None else sel
                    for a, b in _within(tables if own is None else own, index.centres[c], v[some[places]], m, cosine, reach):
                        a = places[a]
                        asked_it = wanted[a]
                        a, b = some[a[asked_it]], m.at[b[asked_it]]
                        other = where[a] != where[b]
                        a, b = a[other], b[other]
                        np.add.at(n, where[a], copies[b])
                        one_way = home[a] < c  # in its own list the other one asks too
                        np.add.at(n, where[b[one_way]], copies[a[one_way]])
                        pairs += _forest(len(names), where[a], where[b])
        ends = np.array(pairs, np.int64).reshape(-1, 2)
        pairs = _forest(len(names), ends[:, 0], ends[:, 1])
        hit = np.flatnonzero(n)
        return pa.table({
            "u": pa.array([*names[hit], *(names[a] for a, _ in pairs)], pa.int64()), "n": pa.array([*n[hit], *[0] * len(pairs)], pa.int64()),
            "to": pa.array([*[None] * len(hit), *(names[b] for _, b in pairs)], pa.int64()),
        })

    found = common.saved(member.unionByName(query).groupBy(*cell, "block", "slice").applyInArrow(compare, "u long, n long, to long"))
    counts = found.groupBy("u").agg(F.sum("n").alias("n"))
    root = components(found.where("to is not null"), "u", "to")
    result = distinct.join(counts, "u", "left").join(root.withColumnRenamed("node", "u"), "u", "left")
    result = result.select("label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "u").alias("component_id"))
    known_id = F.col("vec_id").isNotNull()
    ids = rows.groupBy("vec_id", "label", "v").agg(F.count("*").alias("rows"))
    return (
        ids.join(result, ["label", "v"], "left")
        .groupBy("vec_id")
        .agg(F.max(F.when(known_id, F.coalesce("n_links", F.lit(0))).otherwise(0)).alias("n_links"), F.min(F.when(known_id, F.coalesce("component_id", "vec_id"))).alias("component_id"))
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
