"""Personal data by candidate generation and gradient boosting.

Base rules (email, ip, card, phone) give spans that always stay. Beside them, looser generators propose overlapping
candidates: addresses written with (at) and (dot), numbers with other separators, phones without a plus sign. Boosted
trees score the candidates from their format and their context; a candidate is taken when its calibrated probability
reaches its kind's threshold, the most probable first, if it overlaps nothing taken before.

The trees learn from at most ``max_docs`` documents, the first by a hash of their id (rows without one are not used), and from at
most twenty examples for each of them on average, the first by a hash too; short made-up texts (``made_up``) are added, so that a small table or one
without personal data learns as well. Positives are the base spans and the same data rewritten in the loose forms, where it
stands. Negatives are numbers that cannot be personal data (``impossible``: failed checks, dates, amounts, parts of longer
names), as found and as made by rewriting. Other candidates have no label and are left out of the fit. On examples outside the
fit, the scores of each kind are calibrated by isotonic regression, so that a probability is the share of personal data among
candidates so scored; a kind's threshold lies below the least score that held a precision of ``precision``, with that calibration at
a half or more, halfway to the next lower one. ``Detector.report`` gives precision and recall of each kind on those examples. What cannot be personal data is
never added.

Nulls and empty texts have no spans. A row without an id is searched like any other, repeated rows give repeated results, other
columns cannot clash. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # start, end, place in KINDS

_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: All that the three number rules can match lies within one such zone.
_ZONE = re.compile(r"[+0-9][0-9 ().+-]*")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")
#: The loose generators.
_LOOSE_EMAIL = re.compile(r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]|\.) ?[A-Za-z0-9-]{1,63}){1,8}")
_LOOSE = ((1, re.compile(r"(?<![0-9])[0-9]{1,3}(?: ?[.-] ?[0-9]{1,3}){3}(?![0-9])")), (2, re.compile(r"(?<![0-9])[0-9](?:[ .-]{0,2}[0-9]){11,18}(?![0-9])")), (3, re.compile(r"(?<![0-9])\(?[0-9](?:[ ().-]{0,2}[0-9]){6,14}(?![0-9])")))
_CUES = re.compile(r"mail|tel|phone|call|fon|ip|host|card|visa|konto|contact", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def emails(text: str) -> list[Span]:
    """Every @ with the longest local part to its left that nothing before has taken, and a domain to its right."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        if at >= done and (m := _DOMAIN.match(text, at)):
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                out.append((start, m.end(), 0))
                done = m.end()
        at = text.find("@", at + 1)
    return out


def base_spans(text: str) -> list[Span]:
    """The base rules: leftmost, not overlapping within a kind; matches that fail their check are dropped."""
    out = emails(text) if "@" in text else []
    for zone in _ZONE.finditer(text):
        a, b = zone.span()
        if b - a < 7:
            continue
        part = zone.group()
        if part.count(".") >= 3:
            out += [(a + m.start(), a + m.end(), 1) for m in _IP.finditer(part) if _octets(m.group())]
        if b - a >= 10:
            for m in _CARD.finditer(part):
                if m.end() - m.start() >= 12:
                    digits = _NOT_DIGIT.sub("", m.group())
                    if 12 <= len(digits) <= 19 and luhn(digits):
                        out.append((a + m.start(), a + m.end(), 2))
            if "+" in part:
                out += [(a + m.start(), a + m.end(), 3) for m in _PHONE.finditer(part) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


def candidates(text: str, base: list[Span]) -> list[Span]:
    """Loose proposals that overlap no base span; they may overlap each other."""
    found: list[Span] = []
    if "at)" in text or "at]" in text:
        found += [(*m.span(), 0) for m in _LOOSE_EMAIL.finditer(text)]
    for zone in _ZONE.finditer(text):
        a, b = zone.span()
        if b - a >= 7:
            a -= a > 0 and text[a - 1] == "("
            found += [(a + m.start(), a + m.end(), k) for k, rule in _LOOSE for m in rule.finditer(text[a:b])]
    if not base or not found:
        return found
    edges = np.array(sorted((s, e) for s, e, _ in base))
    reach = np.maximum.accumulate(edges[:, 1])  # the furthest end of the spans that start no later
    last = np.searchsorted(edges[:, 0], [e for _, e, _ in found]) - 1
    return [s for s, k in zip(found, last, strict=True) if k < 0 or reach[k] <= s[0]]


def _side(c: str) -> int:
    return 0 if not c else 1 if c.isspace() else 2 if c.isalpha() else 3 if c.isdigit() else 4


_DATE = re.compile(r"(?:[0-9]{4}[-./ ]{1,2}[01]?[0-9][-./ ]{1,2}[0-3]?[0-9]|[0-3]?[0-9][-./ ]{1,2}[0-3]?[0-9][-./ ]{1,2}(?:1[0-9]|20)[0-9]{2})(?:[ .-]{1,2}[0-9]{1,2})*")
_YEARS = re.compile(r"(?:(?:1[5-9]|20)[0-9]{2}[ .-]{1,2})+(?:1[5-9]|20)[0-9]{2}")
_DECIMALS = re.compile(r"[0-9]+\.[0-9]+(?: [0-9]+\.[0-9]+)?|[0-9]{1,3}(?:\.[0-9]{3})+")
_ONES = re.compile(r"[0-9](?:[^0-9]+[0-9])*")


def _joined(c: str) -> bool:
    return c == "_" or (c.isascii() and c.isalnum())


def impossible(text: str, span: Span) -> bool:
    """Whether a candidate cannot be personal data of its kind, by its form or by what it stands in."""
    start, end, kind = span
    part, left, right = text[start:end], text[start - 1 : start] if start else "", text[end : end + 1]
    if kind == 0:
        return not re.search(r"[A-Za-z]{2,}$", part)
    if _joined(left) or _joined(right) or left in ("$", "€", "£", "#") or right in ("%", "$", "€", "£"):
        return True
    digits = _NOT_DIGIT.sub("", part)
    if kind == 1:
        return not _octets(".".join(re.findall("[0-9]+", part)))
    if kind == 2:
        return not 12 <= len(digits) <= 19 or not luhn(digits) or len(set(digits)) == 1
    return not 7 <= len(digits) <= 15 or any(rule.fullmatch(part) for rule in (_DATE, _YEARS, _DECIMALS, _ONES))


def rewritten(part: str, kind: int) -> tuple[list[str], list[str]]:
    """The same data in loose forms, and numbers like it that cannot be such data."""
    digits = _NOT_DIGIT.sub("", part)
    if kind == 0:
        local, _, host = part.partition("@")
        spelled = host.replace(".", " (dot) ")
        return [f"{local} (at) {spelled}", f"{local} [at] {host.replace('.', ' [dot] ')}", f"{local}(at){host}", f"{local} (at) {host}"], [f"{local[:8]} (at) {len(host)}.{len(local)}"]
    if kind == 1:
        o = part.split(".")
        return [". ".join(o), " . ".join(o), "-".join(o)], [". ".join([*o[:3], "999"]), "-".join(["700", *o[1:]])]
    if kind == 2:
        fours = [digits[i : i + 4] for i in range(0, len(digits), 4)]
        wrong = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        return [digits, " ".join(fours), ".".join(fours), " - ".join(fours)[:40].replace(" - ", "- "), "  ".join(fours)], [wrong, ".".join(wrong[i : i + 4] for i in range(0, len(wrong), 4)), " ".join(wrong[i : i + 4] for i in range(0, len(wrong), 4))]
    country, _, rest = part[1:].partition(" ")
    national = _NOT_DIGIT.sub("", rest) if rest else digits[1:]
    a, b, c = national[:-7], national[-7:-4], national[-4:]
    forms = [f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"{a} {b} {c}", " ".join(filter(None, (country if rest else digits[:1], a, b, c))), f"00{digits}"[:15]] if a else [part[1:]]
    year, day = 1900 + int(c) % 130, 1 + int(b) % 28
    return forms, [f"{year}-{1 + day % 12:02d}-{day:02d}", f"{day:02d}.{1 + day % 12:02d}.{year}", f"{day:02d}-{1 + day % 12:02d}-{year}", f"{b}.{c}{a}", f"{day}.{b}.{b}", f"{year}-{year + 3}", " ".join(digits), f"{year} {year + 1} {year + 2}"]


def examples(text: str) -> list[tuple[bool, list[float]]]:
    """Labelled features of a text: base spans, their loose forms where they stand, and what cannot be personal data."""
    base = base_spans(text)
    out = [(True, features(text, s)) for s in base]
    out += [(False, features(text, s)) for s in candidates(text, base) if impossible(text, s)]
    for start, end, kind in base:
        left, right = text[max(0, start - 32) : start], text[end : end + 1]
        for good, forms in zip((True, False), rewritten(text[start:end], kind), strict=True):
            for form in forms:
                span = (len(left), len(left) + len(form), kind)
                if good or impossible(left + form + right, span):
                    out.append((good, features(left + form + right, span)))
    return out


def made_up(n: int = 200) -> list[str]:
    """Short texts with personal data of every kind, after a cue or after another word."""
    rng = np.random.default_rng(5)
    before = ["call ", "tel: ", "phone ", "contact ", "mail ", "card ", "host ", "the ", "an ", "and, ", "", "(", "or: "]
    after = [" or so", ".", ", then", "", ")", "\n"]
    out = []
    for i in range(n):
        first = "4" + "".join(map(str, rng.integers(0, 10, 14)))
        number = next(first + str(d) for d in range(10) if luhn(first + str(d)))
        data = (f"user{i}.x@mail{i % 7}.example.{('org', 'com', 'net')[i % 3]}", ".".join(map(str, rng.integers(1, 255, 4))), number, f"+{rng.integers(1, 99)} ({rng.integers(200, 999)}) {rng.integers(200, 999)}-{rng.integers(1000, 9999)}")[i % 4]
        out.append(before[int(rng.integers(len(before)))] + data + after[int(rng.integers(len(after)))])
    return out


def features(text: str, span: Span) -> list[float]:
    start, end, kind = span
    part = text[start:end]
    digits = _NOT_DIGIT.sub("", part)
    groups = [len(g) for g in re.split("[^0-9]+", part) if g]
    return [
        kind, len(part), len(digits), len(part) - len(digits), part.startswith("+"), bool(digits) and luhn(digits), part.count(".") == 3 and _octets("".join(c for c in part if c in "0123456789.")), "@" in part,
        len(groups), max(groups, default=0), min(groups, default=0), groups[-1] if groups else 0, "(" in part, part.count("-"), part.count("."), part.count(" "),
        _side(text[start - 1 : start]), _side(text[end : end + 1]), bool(_CUES.search(text[max(0, start - 24) : start])), any(c.isalpha() for c in part),
    ]


class BoostedTrees:
    """Logistic boosting of shallow trees over binned features."""

    def __init__(self, rounds: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 24, least: int = 5):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least
        self.start, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1], method="lower")) for c in x.T]
        binned = np.stack([np.searchsorted(k, c, side="left") for k, c in zip(cuts, x.T, strict=True)], 1)
        score = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree = self._grow(binned, cuts, y - p, p * (1 - p), np.arange(len(y)), self.depth)
            self.trees.append(tree)
            score += self._value(tree, x)
        return self

    def _grow(self, binned: np.ndarray, cuts: list, grad: np.ndarray, hess: np.ndarray, rows: np.ndarray, depth: int):
        g, h = grad[rows].sum(), hess[rows].sum()
        leaf = self.rate * g / (h + 1)
        if not depth or len(rows) < 2 * self.least:
            return leaf
        best = (1e-6, None)
        for f in range(binned.shape[1]):
            if not len(cuts[f]):
                continue
            b = binned[rows, f]
            size = len(cuts[f]) + 1
            gl, hl, nl = (np.cumsum(np.bincount(b, w, size))[:-1] for w in (grad[rows], hess[rows], None))
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            gain[(nl < self.least) | (len(rows) - nl < self.least)] = 0
            if gain.max() > best[0]:
                best = (gain.max(), (f, int(gain.argmax())))
        if best[1] is None:
            return leaf
        f, k = best[1]
        left = binned[rows, f] <= k
        return (f, float(cuts[f][k]), self._grow(binned, cuts, grad, hess, rows[left], depth - 1), self._grow(binned, cuts, grad, hess, rows[~left], depth - 1))

    def _value(self, tree, x: np.ndarray) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        f, cut, low, high = tree
        return np.where(x[:, f] <= cut, self._value(low, x), self._value(high, x))

    def predict(self, x: np.ndarray) -> np.ndarray:
        score = np.full(len(x), self.start)
        for tree in self.trees:
            score += self._value(tree, x)
        return 1 / (1 + np.exp(-np.clip(score, -40, 40)))


def isotonic(p: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ascending step function next to y by squares: from which scores on its steps hold (halfway between two of them), and their values.

    Neighbours that violate the order are pooled.
    """
    order = np.argsort(p, kind="stable")
    scores, inverse = np.unique(p[order], return_inverse=True)
    sums, counts = np.bincount(inverse, y[order]).tolist(), np.bincount(inverse).tolist()
    blocks: list[list[float]] = []  # least and greatest score, sum, count
    for x, total, n in zip(scores.tolist(), sums, counts, strict=True):
        blocks.append([x, x, total, n])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3]:
            _, high, total, n = blocks.pop()
            blocks[-1][1] = high
            blocks[-1][2] += total
            blocks[-1][3] += n
    starts = [(b[0] + a[1]) / 2 for a, b in zip(blocks, blocks[1:])]
    return np.array([0.0, *starts]), np.array([b[2] / b[3] for b in blocks])


class Detector:
    """Base rules, trees, and for each kind its calibration and threshold (over 1: the kind adds nothing)."""

    def __init__(self, trees: BoostedTrees | None, thresholds: np.ndarray, steps: list[tuple[np.ndarray, np.ndarray]] | None = None, report: dict | None = None):
        self.trees, self.thresholds, self.steps, self.report = trees, thresholds, steps or [(np.zeros(1), np.zeros(1))] * len(KINDS), report or {}

    def probability(self, kind: int, score: float) -> float:
        """The calibrated probability of a score."""
        at, value = self.steps[kind]
        return float(value[max(np.searchsorted(at, score, "right") - 1, 0)])

    def added(self, texts: list[str], bases: list[list[Span]]) -> list[list[Span]]:
        found = [[s for s in candidates(t, b) if not impossible(t, s)] for t, b in zip(texts, bases, strict=True)] if self.trees else [[]] * len(texts)
        rows = [features(t, s) for t, c in zip(texts, found, strict=True) for s in c]
        if not rows:
            return [[] for _ in texts]
        p = self.trees.predict(np.array(rows, float))
        out, at = [], 0
        for spans in found:
            mine = sorted((-self.probability(s[2], p[at + i]), -p[at + i], s) for i, s in enumerate(spans) if p[at + i] >= self.thresholds[s[2]])
            at += len(spans)
            taken: list[Span] = []
            for _, _, s in mine:
                if all(s[1] <= o[0] or o[1] <= s[0] for o in taken):
                    taken.append(s)
            out.append(taken)
        return out


def train(docs: DataFrame, max_docs: int = 3000, precision: float = 0.95, id_col: str = "doc_id", text_col: str = "text") -> Detector:
    """Fit on the spans and candidates of at most max_docs documents."""
    docs = common.texts_of(docs, id_col, text_col).where("doc_id is not null and text is not null")
    n, draw, scale = docs.count(), F.xxhash64("doc_id"), 1 << 30
    # a few more than enough by their hash, then the first max_docs ids of those
    drawn = docs.select("doc_id", F.pmod(draw, F.lit(scale)).alias("draw")).where(F.col("draw") < int(scale * min(1, (1.2 * max_docs + 500) / max(n, 1))))
    some = docs.join(F.broadcast(drawn.distinct().orderBy("draw", "doc_id").limit(max_docs).select("doc_id")), "doc_id", "left_semi")

    def featured(b: pa.RecordBatch) -> dict:
        out: dict[str, list] = {"doc_id": [], "positive": [], "x": []}
        for doc_id, text in zip(b.column("doc_id").to_pylist(), common.strings(b.column("text")), strict=True):
            for good, x in examples(text):
                out["doc_id"].append(doc_id)
                out["positive"].append(good)
                out["x"].append([float(v) for v in x])
        return out

    found = common.map_arrow(some, featured, "doc_id long, positive boolean, x array<double>")
    rows = found.orderBy(F.xxhash64("doc_id", "positive", "x"), "doc_id").limit(20 * max_docs).collect()
    made = [(i, good, [float(v) for v in x]) for i, t in enumerate(made_up()) for good, x in examples(t)]
    y = np.array([r["positive"] for r in rows] + [good for _, good, _ in made], float)
    x = np.array([r["x"] for r in rows] + [x for _, _, x in made])
    # made-up texts hold every kind in turn; whole rounds of them are in or outside the fit
    fit = np.array([r["doc_id"] % 2 == 0 for r in rows] + [i // 4 % 2 == 0 for i, _, _ in made])
    trees = BoostedTrees().fit(x[fit], y[fit])
    p, kind, good = trees.predict(x[~fit]), x[~fit, 0], y[~fit]
    thresholds, steps, report = np.full(len(KINDS), 2.0), [], {}
    for k, name in enumerate(KINDS):
        own, true = p[kind == k], good[kind == k]
        steps.append(isotonic(own, true) if len(own) else (np.zeros(1), np.zeros(1)))
        found = Detector(None, thresholds, steps)
        order = np.argsort(-own, kind="stable")
        last = np.flatnonzero(np.r_[np.diff(own[order]) != 0, True][: len(own)])  # examples of one score are taken together
        held = np.cumsum(true[order])[last] / (last + 1) >= precision
        likely = np.array([found.probability(k, own[order][i]) >= 0.5 for i in last], bool)
        if (held & likely).any():
            at = last[np.flatnonzero(held & likely)[-1]]
            thresholds[k] = (own[order][at] + (own[order][at + 1] if at + 1 < len(own) else 0.0)) / 2  # halfway to the next one
        taken = own >= thresholds[k]
        report[name] = {"examples": len(own), "precision": float(true[taken].mean()) if taken.any() else None, "recall": float(taken[true > 0].mean()) if true.any() else None}
    return Detector(trees, thresholds, steps, report)


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def detect(docs: DataFrame, detector: Detector, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts of base spans by kind, base_sha256, spans (kind:start:end, all of them), n_added."""
    frozen = docs.sparkSession.sparkContext.broadcast(detector)  # a few hundred tree nodes

    def find(b: pa.RecordBatch) -> dict:
        texts = common.strings(b.column("text"))
        bases = [base_spans(t) for t in texts]
        added = frozen.value.added(texts, bases)
        return {
            "doc_id": b.column("doc_id"), **{f"n_{k}": [sum(s[2] == i for s in base) for base in bases] for i, k in enumerate(KINDS)},
            "base_sha256": [hashlib.sha256(written(x).encode()).hexdigest() for x in bases], "spans": [written(x + y) for x, y in zip(bases, added, strict=True)], "n_added": [len(y) for y in added],
        }

    return common.map_arrow(common.texts_of(docs, id_col, text_col), find, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact_text(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the union is replaced, by the first one's kind."""
    out, at = [], 0
    for s, e, k in sorted(spans, key=lambda s: (s[0], s[2])):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k]}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, detector: Detector, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows with their text redacted; null texts stay null, other columns stay as they are."""
    frozen = docs.sparkSession.sparkContext.broadcast(detector)
    at = docs.columns.index(text_col)

    def run(batches):
        for b in (part for batch in batches for part in common.slices(batch)):
            texts = common.strings(b.column(at))
            bases = [base_spans(t) for t in texts]
            new = [redact_text(t, x + y) for t, x, y in zip(texts, bases, frozen.value.added(texts, bases), strict=True)]
            null = b.column(at).is_null().to_pylist()
            yield b.set_column(at, b.schema.field(at), pa.array([None if n else t for n, t in zip(null, new, strict=True)], b.schema.field(at).type))

    return docs.mapInArrow(common.releasing(run), docs.schema)
