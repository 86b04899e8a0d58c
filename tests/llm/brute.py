"""Plain versions of the operators' contracts, for small fixtures."""

import hashlib
import re


def fold(text):
    return (text or "").translate({k: k + 32 for k in range(65, 91)})


def components(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
    if not words:
        return frozenset()
    return frozenset([tuple(words)]) if len(words) < 5 else frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def jaccard(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[:k] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    root = components(ids, links)
    return sorted((i, len(sets[i]), root[i]) for i in ids)


def exact(docs):
    groups = {}
    for i, t in docs:
        groups.setdefault(fold(t), []).append(i)
    return sorted((i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g)


def suffix(docs, length=50):
    seen, out = {}, []
    for i, t in sorted(docs, key=lambda d: d[0]):
        b = (t or "").encode()
        gone = [False] * len(b)
        for s in range(len(b) - length + 1):
            if seen.get(b[s : s + length], i) < i:
                gone[s : s + length] = [True] * length
        for s in range(len(b) - length + 1):
            seen.setdefault(b[s : s + length], i)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out)


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    out = []
    for k, (name, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": name == "ip" and all(int(p) <= 255 for p in m[0].split(".")), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[name]
            if good:
                out.append((m.start(), m.end(), k))
    return sorted(out, key=lambda s: (s[0], s[2]))
