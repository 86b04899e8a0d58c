"""Toxicity grades by cumulative-link ordinal regression.

A text's features are its words (runs of letters and digits, lower-cased) and the beginnings of its words, from three
letters to ten: endings vary, so a stem tells grades apart where each of its forms is rare. The value of a feature is
1 + log of its count. One weight vector serves all ordered thresholds: P(grade > k) = sigmoid(w.x - theta_k), theta ascending,
and a grade's likelihood is the difference of two neighbours. The expected severity is the sum of those probabilities. Grades
are whatever integers the labels hold, two or more; with binary labels severity is the probability of the higher one.

Training reads at most ``max_rows`` labelled documents, the first by a hash of their id, and keeps every feature that tells
grades apart at some threshold: in ``min_docs`` of them at least, by a chi-square test ``min_z`` standard deviations from chance,
and by a likelihood ratio that holds for rare features too and for as many as are tested. There is no limit to their number
or to their share of the toxic documents, so small languages and a long tail of words count. Texts of equal words count once.
The probability from which a text is rejected is where the F1 measure of rejecting is best on documents outside the fit
(``FOLDS`` fits, each without one part; the features are chosen over all parts). Scoring reads every whole text.

Null and empty texts have no features and get the severity of the thresholds alone. Labels that are null are not used; when
a document or texts of equal words have several labels, the highest counts. Without labels of two grades nothing is learned:
all severities are the one grade (0 without any) and nothing is rejected. A row without an id is scored like any other.
Repeated rows give repeated results; an empty table gives an empty result. Other columns cannot clash.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Letters of the beginnings that are features.
SHORTEST, LONGEST = 3, 10
FOLDS = 3
#: Features that a task counts before it hands them on, and words of which a worker remembers the features. A worker keeps the
#: memory it once took, also for the jobs that follow; neither changes a result.
HELD, MEMO = 40_000, 30_000
_WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def parts(word: str) -> list[str]:
    """The features of a word: itself, and its beginnings, marked by a star."""
    return [word, *(word[:k] + "*" for k in range(SHORTEST, min(len(word), LONGEST + 1)))]


class OrdinalModel:
    """Shared weights, ascending thresholds, and the probability of more than the lowest grade from which a text is rejected."""

    def __init__(self, vocabulary: list[str], grades: list[int], weights: np.ndarray, thresholds: np.ndarray, cut: float = 0.5):
        self.index = {w: i for i, w in enumerate(vocabulary)}
        self.grades, self.weights, self.thresholds, self.cut = grades, weights, thresholds, cut
        self.memo: dict[str, tuple[int, ...]] = {}

    def of_word(self, word: str) -> tuple[int, ...]:
        known = self.memo.get(word)
        if known is None:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            known = self.memo[word] = tuple(i for p in parts(word) if (i := self.index.get(p)) is not None)
        return known

    def features(self, counts: dict[str, int]) -> tuple[list[int], np.ndarray]:
        """Places and values of the features of a bag of words."""
        found: Counter[int] = Counter()
        for word, n in counts.items():
            for i in self.of_word(word):
                found[i] += n
        at = sorted(found)
        return at, 1 + np.log(np.array([found[i] for i in at], float))

    def score(self, text: str) -> float:
        at, x = self.features(Counter(words(text)))
        return float(self.weights[at] @ x) if at else 0.0

    def at_least(self, scores: np.ndarray) -> np.ndarray:
        """P(grade > k) for all grades but the highest."""
        return 1 / (1 + np.exp(-np.clip(scores[:, None] - self.thresholds[None, :], -40, 40)))


Rows = list[tuple[int, list[int], np.ndarray]]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


class Likelihood:
    """Minus the penalised log-likelihood of a cumulative link, over sparse rows.

    The parameters are the weights, the first threshold, and the logarithms of the steps between thresholds, which
    keeps them in order.
    """

    def __init__(self, rows: Rows, n_features: int, grades: list[int], l2: float):
        self.y = np.searchsorted(grades, [g for g, _, _ in rows])
        self.n, self.m, self.k, self.l2 = len(rows), n_features, len(grades) - 1, l2
        self.row = np.repeat(np.arange(self.n), [len(at) for _, at, _ in rows])
        self.at = np.concatenate([np.asarray(at, int) for _, at, _ in rows])
        self.x = np.concatenate([np.asarray(x, float) for _, _, x in rows])

    def start(self) -> np.ndarray:
        """No weights, and the thresholds of the grades' own shares."""
        above = np.array([(self.y > j).mean() for j in range(self.k)])
        theta = -np.log(above / (1 - above))
        return np.concatenate([np.zeros(self.m), theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))])

    def thresholds(self, b: np.ndarray) -> np.ndarray:
        return b[self.m] + np.concatenate([[0.0], np.cumsum(np.exp(b[self.m + 1 :]))])

    def scale(self) -> np.ndarray:
        """About the diagonal of the second derivatives at the start."""
        each = np.array([np.mean(self.y > j) * np.mean(self.y <= j) for j in range(self.k)])
        return np.concatenate([np.bincount(self.at, self.x**2, self.m) * each.sum() + self.l2, self.n * each + 1e-3])

    def __call__(self, b: np.ndarray) -> tuple[float, np.ndarray]:
        w, theta = b[: self.m], self.thresholds(b)
        s = np.bincount(self.row, self.x * w[self.at], self.n)
        low, high = self.y > 0, self.y < self.k  # whether there is a threshold below and above the grade
        u, v = theta[np.minimum(self.y, self.k - 1)] - s, theta[np.maximum(self.y - 1, 0)] - s
        both = low & high
        gap = np.where(both, np.maximum(u - v, 1e-12), 1.0)
        # sigmoid(u) - sigmoid(v) = sigmoid(u) sigmoid(-v) (1 - exp(v - u))
        value = -(np.where(high, -np.logaddexp(0, -u), 0) + np.where(low, -np.logaddexp(0, v), 0) + np.where(both, np.log(-np.expm1(-gap)), 0)).sum()
        extra = np.where(both, 1 / np.expm1(np.minimum(gap, 700)), 0)
        by_u, by_v = np.where(high, _sigmoid(-u) + extra, 0), np.where(low, -_sigmoid(v) - extra, 0)
        by_theta = np.bincount(self.y[high], by_u[high], self.k) + np.bincount(self.y[low] - 1, by_v[low], self.k)
        later = np.cumsum(by_theta[::-1])[::-1]  # a step moves all thresholds that follow
        slope = np.concatenate([np.bincount(self.at, self.x * (by_u + by_v)[self.row], self.m), -later[:1], -later[1:] * np.exp(b[self.m + 1 :])])
        slope[: self.m] += self.l2 * w
        return float(value + self.l2 / 2 * (w**2).sum()), slope


def fit(rows: Rows, n_features: int, l2: float = 0.3, steps: int = 500) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Grades, weights and thresholds of the greatest penalised likelihood, by limited-memory BFGS steps."""
    grades = sorted({g for g, _, _ in rows})
    loss = Likelihood(rows, n_features, grades, l2)
    beta, diagonal = loss.start(), loss.scale()
    now, slope = loss(beta)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        move, kept = -slope, []
        for s, t in reversed(past):
            kept.append((s @ move) / (s @ t))
            move = move - kept[-1] * t
        move = move / diagonal
        for (s, t), a in zip(past, reversed(kept), strict=True):
            move = move + (a - (t @ move) / (s @ t)) * s
        size, fall = 1.0, float(slope @ move)
        while (new := loss(beta + size * move))[0] > now + 1e-4 * size * fall and size > 1e-12:
            size /= 2
        if new[0] >= now:
            break
        s, t = size * move, new[1] - slope
        if s @ t > 1e-12:
            past = [*past[-9:], (s, t)]
        beta, now, slope = beta + s, new[0], new[1]
        if np.abs(slope).max() < 1e-5 * max(1.0, loss.n**0.5):
            break
    return grades, beta[:n_features], loss.thresholds(beta)


def held_out(rows: Rows, n_features: int, folds: int = FOLDS) -> np.ndarray:
    """For each row the probability of more than the lowest grade by a fit without its fold; NaN where a fit lacks grades."""
    out, fold, lowest = np.full(len(rows), np.nan), np.arange(len(rows)) % folds, min(g for g, _, _ in rows)
    for f in range(folds):
        rest = [r for r, k in zip(rows, fold, strict=True) if k != f]
        if len({g for g, _, _ in rest}) < 2 or lowest not in {g for g, _, _ in rest}:
            continue
        _, w, theta = fit(rest, n_features)
        for i in np.flatnonzero(fold == f):
            out[i] = _sigmoid(np.array(w[rows[i][1]] @ rows[i][2] - theta[0] if rows[i][1] else -theta[0]))
    return out


def best_cut(p: np.ndarray, high: np.ndarray) -> float:
    """The probability from which rejecting has the best F1, halfway (in log-odds) to the next lower one; 0.5 without rows to tell."""
    known = ~np.isnan(p)
    p, high = np.clip(p[known], 1e-9, 1 - 1e-9), high[known]
    if not high.any() or high.all():
        return 0.5
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(high[order])
    last = np.flatnonzero(np.r_[p[1:] != p[:-1], True])  # rows of one probability are rejected together
    f1 = 2 * hits[last] / (last + 1 + high.sum())
    at = last[int(f1.argmax())]
    below = p[at + 1] if at + 1 < len(p) else p[at] / 2
    logit = (np.log(p[at] / (1 - p[at])) + np.log(below / (1 - below))) / 2
    return float(1 / (1 + np.exp(-logit)))


def train(docs: DataFrame, labels: DataFrame, grade_col: str = "grade", max_rows: int = 20_000, min_docs: int = 2, min_z: float = 3.0, id_col: str = "doc_id", text_col: str = "text") -> OrdinalModel:
    """Fit on at most max_rows labelled documents."""
    nothing = OrdinalModel([], [0], np.zeros(0), np.zeros(0))
    graded = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(grade_col).cast("int").alias("grade")).where("doc_id is not null and grade is not null")
    graded = graded.groupBy("doc_id").agg(F.max("grade").alias("grade"))
    n = graded.count()
    if not n:
        return nothing
    draw, scale = F.xxhash64("doc_id"), 1 << 30
    # a few more than enough by their hash, then the first max_rows: no sort of all labels
    some = graded.where(F.pmod(draw, F.lit(scale)) < int(scale * min(1, (1.2 * max_rows + 1000) / n))).orderBy(F.pmod(draw, F.lit(scale)), "doc_id").limit(max_rows)
    texts = common.texts_of(docs, id_col, text_col).where("text is not null").join(F.broadcast(some), "doc_id")  # max_rows ids at most
    bags = common.map_arrow(texts, lambda b: {"grade": b.column("grade"), "bag": [" ".join(f"{w} {k}" for w, k in sorted(Counter(words(t)).items())) for t in common.strings(b.column("text"))]}, "grade int, bag string")
    sample = common.saved(bags.groupBy("bag").agg(F.max("grade").alias("grade")))
    totals = {r["grade"]: r["count"] for r in sample.groupBy("grade").count().collect()}
    grades = sorted(totals)
    if len(grades) < 2:
        return OrdinalModel([], grades or [0], np.zeros(0), np.zeros(0))
    schema = "feature string, split int, n long, h long"

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """In how many bags each feature is, and in how many of them the grade is over each threshold."""
        seen: dict[str, list[int]] = {}

        def rows() -> pa.RecordBatch:
            at, table = list(seen), np.array(list(seen.values()))
            over = table[:, ::-1].cumsum(1)[:, ::-1]  # bags of that grade or a higher one
            k = table.shape[1] - 1
            return common.record({"feature": np.repeat(np.array(at, object), k), "split": np.tile(np.arange(k), len(at)), "n": np.repeat(over[:, 0], k), "h": over[:, 1:].ravel()}, schema)

        for b in batches:
            for grade_, bag in zip(b.column("grade").to_pylist(), common.strings(b.column("bag")), strict=True):
                place = grades.index(grade_)
                for feature in {p for w in bag.split(" ")[::2] if w for p in parts(w)}:
                    if (own := seen.get(feature)) is None:
                        own = seen[feature] = [0] * len(grades)
                    own[place] += 1
                if len(seen) >= HELD:
                    yield rows()
                    seen.clear()
        if seen:
            yield rows()

    seen = common.saved(sample.mapInArrow(common.releasing(counted), schema).groupBy("feature", "split").agg(F.sum("n").alias("n"), F.sum("h").alias("h")).where(f"n >= {min_docs}"))
    tested = seen.count()
    above = [sum(totals[g] for g in grades[j + 1 :]) / sum(totals.values()) for j in range(len(grades) - 1)]
    share = F.element_at(F.array(*map(F.lit, above)), F.col("split") + 1)
    spread = F.col("h") - F.col("n") * share

    def part(k: F.Column, p: F.Column) -> F.Column:
        return F.when(k > 0, k * F.log(k / (F.col("n") * p))).otherwise(0.0)

    # chance gives a ratio of r with a probability of exp(-r / 2) at most, on each side
    ratio = 2 * (part(F.col("h"), share) + part(F.col("n") - F.col("h"), 1 - share))
    passed = (spread * spread / F.col("n") >= min_z**2 * share * (1 - share)) & (ratio >= 2 * np.log(max(tested, 1)))
    vocabulary = sorted(r["feature"] for r in seen.where(passed).select("feature").distinct().collect())  # of max_rows documents at most
    shell = OrdinalModel(vocabulary, grades, np.zeros(0), np.zeros(0))

    def featured(b: pa.RecordBatch) -> dict:
        made = []
        for bag in common.strings(b.column("bag")):
            at = bag.split(" ") if bag else []
            made.append(shell.features({w: int(k) for w, k in zip(at[::2], at[1::2], strict=True)}))
        return {"grade": b.column("grade"), "at": [i for i, _ in made], "x": [x for _, x in made]}

    rows = sorted(((r["grade"], r["at"], tuple(r["x"])) for r in common.map_arrow(sample, featured, "grade int, at array<int>, x array<double>").collect()), key=lambda r: (r[1], r[2], r[0]))
    rows = [(g, at, np.array(x)) for g, at, x in rows]
    cut = best_cut(held_out(rows, len(vocabulary)), np.array([g > grades[0] for g, _, _ in rows]))
    grades, w, theta = fit(rows, len(vocabulary))
    return OrdinalModel(vocabulary, grades, w, theta, cut)


def grade(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, grade (most probable), severity (expected), toxic_probability (of more than the lowest grade), rejected (it reaches the model's cut)."""
    frozen = docs.sparkSession.sparkContext.broadcast(model)  # a weight for each feature that passed, of max_rows documents at most

    def score(b: pa.RecordBatch) -> dict:
        m: OrdinalModel = frozen.value
        p = m.at_least(np.array([m.score(t) for t in common.strings(b.column("text"))]))
        lowest = m.grades[0]
        steps = np.diff(np.array(m.grades, float))
        exact = np.hstack([np.ones((len(p), 1)), p]) - np.hstack([p, np.zeros((len(p), 1))])
        toxic = p[:, 0] if p.shape[1] else np.zeros(len(p))
        return {
            "doc_id": b.column("doc_id"), "grade": np.array(m.grades)[exact.argmax(1)], "severity": lowest + p @ steps if p.shape[1] else np.full(len(p), float(lowest)),
            "toxic_probability": toxic, "rejected": (toxic >= m.cut) & bool(p.shape[1]),
        }

    return common.map_arrow(common.texts_of(docs, id_col, text_col), score, "doc_id long, grade int, severity double, toxic_probability double, rejected boolean")


def accepted(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text is not rejected."""
    frozen = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: OrdinalModel = frozen.value
        for batch in batches:
            for b in common.slices(batch):
                p = m.at_least(np.array([m.score(t) for t in common.strings(b.column(at))]))
                yield b.filter(pa.array(p[:, 0] < m.cut if p.shape[1] else np.ones(b.num_rows, bool)))

    return docs.mapInArrow(common.releasing(run), docs.schema)
