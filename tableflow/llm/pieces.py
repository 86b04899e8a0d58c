"""SentencePiece encoding and decoding of byte-fallback BPE models by vectorised merge rounds.

All words that a batch has for the first time lie in one flat numpy array of symbols. A round looks up the merge of every
two neighbours, takes the best score in each word by a segmented minimum, merges its occurrences from the left at the same
time and closes the gaps; words without a merge leave. The library merges one pair at a time, the leftmost of the best; a
merge whose new neighbours would merge at that score or a better one therefore ends its word's round, so every round is a
run of the library's own steps. A word that still has merges after ROUNDS rounds (long runs of pieces with one
score) is finished with a heap, which takes the same steps.

Words end where no piece of the model could reach across: before white space at first, and between two characters that no
piece holds side by side. So every text is encoded as a whole, whatever its length.

Nulls and empty texts have no ids. Repeated rows give repeated results; rows without an id take part; an empty table gives an
empty one; other columns cannot clash. Models with normalisation rules, user-defined or unused pieces, or without byte
fallback are refused when they are loaded.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

SPACE = "▁"
#: Words that a worker remembers, twice, and the longest of them; others are encoded anew, so this bounds memory and not the result.
MEMO, MEMO_CHARS = 200_000, 64
#: Rounds after which a word is finished with a heap.
ROUNDS = 192
_NONE = np.iinfo(np.int32).max

codecs.register_error("one_for_each", lambda e: ("�" * (e.end - e.start), e.end))


class _Pairs:
    """What two neighbouring symbols become: open addressing over numpy arrays, looked up for whole arrays at a time."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, (4 * len(pairs)).bit_length())
        size = 1 << self.bits
        self.keys, self.values, self.probes = np.full(size, -1, np.int64), np.full(size, -1, np.int32), 1
        keys = np.array([a << 32 | b for a, b in pairs], np.int64)
        values = np.fromiter(pairs.values(), np.int32, len(pairs))
        at = self._slot(keys)
        while len(keys):  # each free slot takes one of those that ask for it, the others move on
            free = self.keys[at] == -1
            self.keys[at[free]], self.values[at[free]] = keys[free], values[free]
            left = self.keys[at] != keys
            self.values[at[~left]] = values[~left]
            keys, values, at = keys[left], values[left], (at[left] + 1) & (size - 1)
            self.probes += bool(len(keys))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbol of every pair, -1 for none."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at = self._slot(keys)
        seen = self.keys[at]
        found = np.where(seen == keys, self.values[at], -1)
        open_ = np.flatnonzero((seen != keys) & (seen != -1))
        for _ in range(self.probes - 1):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & (len(self.keys) - 1)
            seen = self.keys[at[open_]]
            hit = seen == keys[open_]
            found[open_[hit]] = self.values[at[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
        return found


class Pieces:
    """Encoder and decoder of one model file."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, norm, kinds = model.trainer_spec, model.normalizer_spec, [p.type for p in model.pieces]
        if spec.model_type != 2 or not spec.byte_fallback or spec.treat_whitespace_as_suffix or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces or {4, 5} & set(kinds):
            raise ValueError(f"{path}: only byte-fallback BPE models without normalisation and extra pieces")
        self.prefix = norm.add_dummy_prefix
        names = [p.piece for p in model.pieces]
        normal = {n: i for i, (n, k) in enumerate(zip(names, kinds, strict=True)) if k == 1}
        # characters inside pieces that are no pieces themselves are symbols too, beyond the ids
        singles = sorted({c for n in normal for c in n} - normal.keys())
        symbols = normal | {c: len(names) + i for i, c in enumerate(singles)}
        #: Symbol of a code point; code points that no piece has are symbols beyond all others, alone in their words.
        self.beyond = len(names) + len(singles)
        self.of_char = np.arange(0x110000, dtype=np.int32) + self.beyond
        for c, i in symbols.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        scores = sorted({model.pieces[i].score for i in normal.values()}, reverse=True)
        place = {s: i for i, s in enumerate(scores)}
        #: Order of the scores, best first; equal scores share a place.
        self.rank = np.full(len(names) + 1, _NONE, np.int32)
        self.rank[list(normal.values())] = [place[model.pieces[i].score] for i in normal.values()]
        self.pair_of = {(symbols[n[:k]], symbols[n[k:]]): i for n, i in normal.items() for k in range(1, len(n)) if n[:k] in symbols and n[k:] in symbols}
        self.pairs = _Pairs(self.pair_of)
        self.beside = _Pairs({(symbols[a], symbols[b]): 1 for n in normal for a, b in zip(n, n[1:])})
        #: Whether white space always begins a word, so that texts may be cut there.
        self.cut = not any(b == SPACE != a for n in normal for a, b in zip(n, n[1:]))
        self.words = re.compile(" *[^ ]+| +")
        byte_ids = [i for i, k in enumerate(kinds) if k == 6]
        self.byte_id = np.array(sorted(byte_ids, key=lambda i: int(names[i][1:-1], 16)), np.int32)
        unknown = [i for i, k in enumerate(kinds) if k == 2]
        self.bytes_of = np.empty(len(names), object)
        self.bytes_of[:] = [b"" if k == 3 else bytes([int(n[1:-1], 16)]) if k == 6 else n.replace(SPACE, " ").encode() for n, k in zip(names, kinds, strict=True)]
        self.bytes_of[unknown] = spec.unk_surface.encode()
        self.text_of = np.array([str(i) for i in range(len(names))], object)
        self.leads = np.array([k == 1 and n.startswith(SPACE) for n, k in zip(names, kinds, strict=True)])
        self.mute = np.array([k == 3 for k in kinds])
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def merged(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of words (numbered in ascending order) after all merges, with the word of each."""
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rounds = 0
        while len(symbols):
            made = np.full(len(symbols), -1, np.int32)
            inside = np.flatnonzero(word[1:] == word[:-1])
            made[inside] = self.pairs.get(symbols[inside], symbols[inside + 1])
            rank = self.rank[made]
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[starts, len(word)])
            best = np.minimum.reduceat(rank, starts)
            active = best < _NONE
            if not active.all():
                keep = np.repeat(active, sizes)
                done.append((symbols[~keep], word[~keep]))
                symbols, word, made, rank = symbols[keep], word[keep], made[keep], rank[keep]
                starts, sizes, best = np.r_[0, np.cumsum(sizes[active])][:-1].astype(np.int64), sizes[active], best[active]
                if not len(symbols):
                    break
            if rounds >= ROUNDS:
                for at, n in zip(starts.tolist(), sizes.tolist(), strict=True):
                    rest = self._by_heap(symbols[at : at + n].tolist())
                    done.append((np.array(rest, np.int32), np.full(len(rest), word[at], word.dtype)))
                break
            rounds += 1
            wanted = np.flatnonzero(rank == np.repeat(best, sizes))
            # of candidates that follow each other directly every second one stays, from the left
            run = np.r_[True, wanted[1:] != wanted[:-1] + 1]
            first = np.flatnonzero(run)
            wanted = wanted[(np.arange(len(wanted)) - first[np.cumsum(run) - 1]) % 2 == 0]
            new, limit = made[wanted], rank[wanted]
            own = word[wanted]
            # what stands beside a merge when the library makes it: to the left all is merged already, to the right nothing
            left, right = wanted - 1, wanted + 2
            has_left = (left >= 0) & (word[np.maximum(left, 0)] == own)
            has_right = (right < len(word)) & (word[np.minimum(right, len(word) - 1)] == own)
            before = symbols[np.maximum(left, 0)]
            joined = np.r_[False, wanted[1:] == wanted[:-1] + 2] if len(wanted) else np.zeros(0, bool)
            before[joined] = new[np.flatnonzero(joined) - 1]
            spoilt = np.zeros(len(wanted), bool)
            i = np.flatnonzero(has_left)
            spoilt[i] = self.rank[self.pairs.get(before[i], new[i])] <= limit[i]
            i = np.flatnonzero(has_right)
            spoilt[i] |= self.rank[self.pairs.get(new[i], symbols[right[i]])] <= limit[i]
            if spoilt.any():  # its word goes no further in this round
                total = np.cumsum(spoilt) - spoilt
                group = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                base = np.repeat(total[group], np.diff(np.r_[group, len(own)]))
                stays = total == base
                wanted, new = wanted[stays], new[stays]
            symbols[wanted] = new
            keep = np.ones(len(symbols), bool)
            keep[wanted + 1] = False
            symbols, word = symbols[keep], word[keep]
        if not done:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        symbols, word = np.concatenate([s for s, _ in done]), np.concatenate([w for _, w in done])
        order = np.argsort(word, kind="stable")
        return symbols[order], word[order]

    def _by_heap(self, ids: list[int]) -> list[int]:
        """The same merges for one word, one at a time."""
        n, pair_of, rank = len(ids), self.pair_of.get, self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(rank[m]), i, m) for i in range(n - 1) if (m := pair_of((ids[i], ids[i + 1]))) is not None]
        heapify(heap)
        while heap:
            _, i, made = heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or pair_of((ids[i], ids[j])) != made:
                continue
            ids[i], ids[j], k = made, -1, after[j]
            after[i] = k
            for a, b in ((before[i], i), (i, k)):
                if a >= 0 and b < n and (m := pair_of((ids[a], ids[b]))) is not None:
                    heappush(heap, (int(rank[m]), a, m))
            if k < n:
                before[k] = i
        return [x for x in ids if x >= 0]

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        sizes = np.array([len(w) for w in words], np.int64)
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        points[points == 32] = ord(SPACE)
        symbols = self.of_char[points]
        of_word = np.repeat(np.arange(len(words)), sizes)
        apart = np.ones(len(symbols), bool)
        inside = np.flatnonzero(of_word[1:] == of_word[:-1])
        apart[inside + 1] = self.beside.get(symbols[inside], symbols[inside + 1]) < 0
        part = np.cumsum(apart) - 1
        owner = of_word[apart]
        symbols, part = self.merged(symbols, part)
        word = owner[part]
        missing = np.flatnonzero((symbols >= len(self.bytes_of)))
        if len(missing):  # characters without a piece, as the ids of their bytes
            chars = self._char_of(symbols[missing])
            raw = [c.encode("utf-8", "replace") for c in chars]
            count = np.ones(len(symbols), np.int64)
            count[missing] = [len(b) for b in raw]
            ends = np.cumsum(count)
            ids, word = np.repeat(symbols, count), np.repeat(word, count)
            spread = np.concatenate([np.arange(e - len(b), e) for e, b in zip(ends[missing], raw, strict=True)])
            ids[spread] = self.byte_id[np.frombuffer(b"".join(raw), np.uint8)]
        else:
            ids = symbols
        bounds = np.searchsorted(word, np.arange(len(words) + 1)).tolist()
        data = ids.astype("<u4").tobytes()
        return [data[4 * a : 4 * b] for a, b in zip(bounds, bounds[1:])]

    def _char_of(self, symbols: np.ndarray) -> list[str]:
        points = symbols - self.beyond
        inner = {int(self.of_char[ord(c)]): c for c in self._inner()} if (points < 0).any() else {}
        return [chr(p) if p >= 0 else inner[s] for p, s in zip(points.tolist(), symbols.tolist(), strict=True)]

    def _inner(self) -> list[str]:
        known = np.flatnonzero((self.of_char >= len(self.bytes_of)) & (self.of_char < self.beyond))
        return [chr(p) for p in known.tolist()]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text; words that are new are encoded together."""
        split = []
        for t in texts:
            t = f" {t}" if self.prefix and t else t
            t = t.replace(SPACE, " ")
            split.append(self.words.findall(t) if self.cut else [t] if t else [])
        known = self.memo
        new = set().union(*split).difference(known)
        known.update((w, self.older[w]) for w in new & self.older.keys())
        fresh = list(new.difference(known))
        ids_of = dict(zip(fresh, self.encode_words(fresh), strict=True))
        long = {w: ids_of.pop(w) for w in fresh if len(w) > MEMO_CHARS}
        known.update(ids_of)
        find = (lambda w: known.get(w) or long[w]) if long else known.__getitem__
        out = [np.frombuffer(b"".join(map(find, words)), "<u4") for words in split]
        if len(self.memo) > MEMO:
            self.older, self.memo = self.memo, {}
        return out

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: the space that encoding puts first is taken off, bytes that are no UTF-8 are replaced one by one."""
        silent = np.flatnonzero(self.mute[ids])
        if len(silent):  # bytes on both sides of a control piece do not join
            parts = [p for p in np.split(ids[~self.mute[ids]], silent - np.arange(len(silent))) if len(p)]
            return "".join(self._text(p, not at) for at, p in enumerate(parts))
        return self._text(ids, True)

    def _text(self, ids: np.ndarray, first: bool) -> str:
        data = b"".join(self.bytes_of[ids].tolist())
        return (data[1:] if first and self.prefix and len(ids) and self.leads[ids[0]] else data).decode("utf-8", "one_for_each")


_loaded: dict[str, Pieces] = {}


def load(path: str) -> Pieces:
    """One encoder for each file and worker."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def piece_encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the ids of every whole text."""
    schema = "doc_id long, ids array<int>"
    return common.map_arrow(common.texts_of(docs, id_col, text_col), lambda b: {"doc_id": b.column("doc_id"), "ids": [x.astype(np.int32) for x in load(path).encode(common.strings(b.column("text")))]}, schema)


def piece_decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text from doc_id, ids."""

    def decode(b: pa.RecordBatch) -> dict:
        return {"doc_id": b.column("doc_id"), "text": [load(path).decode(np.array(x or [], np.int64)) for x in b.column("ids").to_pylist()]}

    return common.map_arrow(encoded.select("doc_id", "ids"), decode, "doc_id long, text string")


def piece_round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encoding and decoding in one pass, digests only."""

    def digest(b: pa.RecordBatch) -> dict:
        pieces = load(path)
        ids = pieces.encode(common.strings(b.column("text")))
        return {
            "doc_id": b.column("doc_id"), "n_tokens": [len(x) for x in ids],
            "ids_sha256": [hashlib.sha256(",".join(pieces.text_of[x].tolist()).encode()).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(pieces.decode(x).encode()).hexdigest() for x in ids],
        }

    return common.map_arrow(common.texts_of(docs, id_col, text_col), digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
