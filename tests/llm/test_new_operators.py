"""Conversation trie, SentencePiece pieces and whitening against plain versions: nulls, ties, repeats, long and empty values, clashing columns."""

import functools
import hashlib
import os
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tableflow.llm import conversation_trie, pieces, whitening
from tableflow.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
TURNS = "conv_id long, turn long, role string, text string"
tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def trie(rows):
    """The contract, node by node, from (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            convs[c].append(((t is not None, t or 0), r, hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest(), x))
    nodes, ends = defaultdict(list), defaultdict(list)
    for c in convs:
        h, base = zlib.crc32(str(c).encode()) % 6, c - (abs(c) % 100) * (1 if c >= 0 else -1)
        turns = [(r, x) for _, r, _, x in sorted(convs.get(base, []))[:h] + sorted(convs[c])[h:]]
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for k in nodes:
        kids[k[:-1]] += bool(k)
    for k in nodes:
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(nodes[k]) - 1) * (len(k[-1][1]) if k else 0)
    hashed = lambda k: hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()
    return sorted([(min(v), len(k), min(nodes[k[:-1]]) if k else None, len(v), kids[k], leaves[k], saved[k], hashed(k)) for k, v in nodes.items()], key=lambda r: r[:2])


def nodes(df):
    return sorted(map(tuple, df.collect()), key=lambda r: r[:2])


def conversations(seed):
    rng, rows = random.Random(seed), []
    for c in rng.sample(range(-150, 700), 120):
        for t in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
            rows.append((c, rng.choice([None, 0, 0, t]) if rng.random() < 0.1 else t, rng.choice(["u", "a", None]), rng.choice(["x", "yy", "é", None, ""]) if t < 3 else rng.choice(["long " * 3, "x"])))
    rows += [(c, t, "u", "hot") for c in range(1000, 1090) for t in range(4)]  # many equal conversations
    rows += [(c, t, "u", "hot") for c in range(1100, 1110) for t in range(6)]  # and some that go on from them
    rows += [(1200, t, "a", f"turn {t}") for t in range(150)] + [(1300, t, "a", f"turn {t}") for t in range(140)]
    return rows + [(None, 1, "u", "nobody's")] * 3 + rows[:7]


@pytest.mark.parametrize(("range_bytes", "piece_bytes"), [(8 << 20, 1 << 20), (8 << 20, 60), (1500, 24), (400, 1 << 20)])
def test_trie(spark, monkeypatch, range_bytes, piece_bytes):
    """Whole, in pieces of ids, and over ranges so small that groups, paths and leaves are shared by several."""
    monkeypatch.setattr(conversation_trie, "RANGE_BYTES", range_bytes)
    monkeypatch.setattr(conversation_trie, "PIECE_BYTES", piece_bytes)
    rows = [r for r in conversations(range_bytes + piece_bytes) if range_bytes > 1500 or (r[0] or 0) < 1200]
    df = spark.createDataFrame(rows, TURNS).repartition(3).select("*", *[F.lit("x").alias(c) for c in ("base", "hash", "points", "part", "chain", "depth")])
    assert nodes(conversation_trie.prefix_trie(df)) == trie(rows)


def test_trie_odd_tables(spark):
    assert conversation_trie.prefix_trie(spark.createDataFrame([], TURNS)).count() == 0
    nobody = [(None, 1, "u", "t")]
    assert conversation_trie.prefix_trie(spark.createDataFrame(nobody, TURNS)).count() == 0
    turnless = [(c, 1, None, None) for c in range(100, 120)]  # many lose their only turn: the first of their hundred has one
    rows = turnless + [(c, 1, "u", "t") for c in range(205, 230)]  # and these have none at all, as there is no conversation 200
    assert nodes(conversation_trie.prefix_trie(spark.createDataFrame(rows, TURNS))) == trie(rows)


def test_z_fast_trie():
    """Locating and inserting in batches, against plain sets of prefixes."""
    rng = random.Random(4)
    for size in (1, 7, 300):
        t, known = conversation_trie.ZFastTrie(), {}
        for _ in range(12):
            batch = []
            for _ in range(size):
                turns = [rng.choice("ab") for _ in range(rng.randint(0, 40))]
                chain = [b""]
                for x in turns:
                    chain.append(conversation_trie.chained(chain[-1], x.encode()))
                batch.append(b"".join(chain[1:]))
            for chain, node in zip(batch, t.insert_batch(batch), strict=True):
                assert known.setdefault(chain, node) == node and t.high[node] == len(chain) // conversation_trie.WIDTH
        prefixes = {c[:k] for c in known for k in range(0, len(c) + 1, conversation_trie.WIDTH)}
        assert sum(h - low for low, h in zip(t.low, t.high)) == len(prefixes)  # every prefix on one edge
        assert len(t.handles) == len(t.low) - 1 and len(t.low) <= 2 * len(known) + 1
        for chain in known:
            assert t.locate(chain) == (known[chain], len(chain) // conversation_trie.WIDTH)


def test_fattest():
    for low in range(-1, 40):
        for high in range(max(low + 1, 1), 70):
            if low >= 0:
                assert conversation_trie.fattest(low, high) == max(range(low + 1, high + 1), key=lambda x: (x & -x, -x))


@tables
def test_trie_query(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF}/conversations.parquet'").fetchall()
    got = nodes(QUERIES["op11_conversation_prefix_trie"](spark, SF))
    assert got == trie(rows)
    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert sorted(c.execute(ORACLE_SQL["op11_conversation_prefix_trie"]).fetchall(), key=lambda r: r[:2]) == got


@functools.cache
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def texts():
    rng = random.Random(1)
    fixed = [
        "", " ", "  a  b ", "a\tb\n\nc", "ﬁ Å 　x", "日本語 🙂 \x00 end", "▁a", "a▁b", " " * 1000, "a" * 5000, "ab" * 3000, "▁" * 77 + "the" + " " * 33, "日本語版" * 500, "퟿\U0010ffff",
        "1234567890" * 300, "x" + " " * 5000 + "y", "aab" * 999, "ⓐ" * 40 + "é̂" * 99, "<s> </s> <unk> <0x41>", "-" * 3000, "=" * 4097 + "--" * 50, "\r\n" * 40, "." * 999 + "…" * 333, "the" * 20_000,
    ]
    made = ["".join(rng.choice(a) for _ in range(rng.randint(1, 200))) for a in ("abcdethaisnor  ▁\n.,1é日本-=/", "the andgi ") for _ in range(400)]
    made += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0x80, 0x7FF), rng.randint(0x3000, 0x9FFF), rng.randint(0x1F300, 0x1F9FF)])) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    return fixed + made


@pytest.mark.parametrize("rounds", [pieces.ROUNDS, 2, 0])
def test_pieces_as_the_library(monkeypatch, rounds):
    """Ids and texts as the library has them, also where words are finished with the heap early or at once."""
    monkeypatch.setattr(pieces, "ROUNDS", rounds)
    monkeypatch.setattr(pieces, "MEMO", 500)
    own, given = pieces.Pieces(MODEL), texts()
    ids = [x for at in range(0, len(given), 100) for x in own.encode(given[at : at + 100])]
    want = library().encode(given, num_threads=1)
    assert [x.tolist() for x in ids] == want
    assert [own.decode(x) for x in ids] == [library().decode(x) for x in want]


def test_pieces_of_any_ids():
    """Decoding of ids that no text gives: control pieces, broken bytes, several spaces ahead."""
    rng, own = random.Random(2), pieces.Pieces(MODEL)
    for _ in range(2000):
        ids = [rng.choice([rng.randint(0, 31_999), rng.randint(0, 258), rng.choice([259, 260, 28705])]) for _ in range(rng.randint(0, 9))]
        assert own.decode(np.array(ids, np.int64)) == library().decode(ids), ids


def test_pieces_refuse_other_models(tmp_path):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        model.ParseFromString(f.read())
    model.normalizer_spec.remove_extra_whitespaces = True
    path = tmp_path / "other.model"
    path.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError, match="byte-fallback"):
        pieces.Pieces(str(path))


def test_pieces_on_spark(spark):
    rows = [(i, t) for i, t in enumerate(texts()[:60])] + [(1000, None), (None, "no id"), (5, "again"), (5, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("x").alias(c) for c in ("ids", "n_tokens")]).repartition(3)
    encoded = pieces.piece_encode(df, MODEL)
    text = lambda t: library().decode(library().encode(t or ""))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, pieces.piece_decode(encoded, MODEL).collect()), key=key) == sorted([(i, text(t)) for i, t in rows], key=key)
    assert pieces.piece_round_trip(df.limit(0), MODEL).count() == 0


@tables
def test_pieces_query(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    ids = {i: library().encode(t or "") for i, t in rows}
    got = sorted(map(tuple, QUERIES["op12_sentencepiece"](spark, SF).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()))
    assert got == [(i, len(ids[i]), sha(",".join(map(str, ids[i]))), sha(library().decode(ids[i]))) for i, _ in rows]


def plain_whitening(vectors, k=32):
    """n, deviations, whitened up to sign, explained."""
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), [int(v) for v in x.sum(0)]
    deviation = [sum((n * int(v) - t) ** 2 for v, t in zip(row, s, strict=True)) for row in x.tolist()]
    y = (n * x - np.array(s)) / n
    e, q = np.linalg.eigh(y.T @ y / n)
    e, q = e[::-1], q[:, ::-1]
    live = e > len(e) * np.finfo(float).eps * e[0]
    return n, deviation, np.where(live, y @ q / np.sqrt(np.where(live, e, 1)), 0)[:, :k], np.maximum(e, 0) / max(e.sum(), 1e-300)


def check_whitening(got, ids, vectors, loose=1e-8):
    n, deviation, white, explained = plain_whitening(vectors)
    k = white.shape[1]
    assert len(got) == len(ids) * k
    by_id = defaultdict(dict)
    for r in got:
        by_id[r["vec_id"]][r["component"]] = r
    mine = np.array([[by_id[i][c + 1]["whitened"] for c in range(k)] for i in ids])
    assert all(by_id[i][1]["n"] == n and {r["deviation"] for r in by_id[i].values()} == {d} for i, d in zip(ids, deviation, strict=True))
    sign = np.sign((mine * white).sum(0))
    assert np.abs(mine * np.where(sign == 0, 1, sign) - white).max() < loose
    assert all(abs(by_id[ids[0]][c + 1]["explained"] - explained[c]) <= 1e-4 * explained[c] + 1e-15 for c in range(k))
    errors = {r["identity_error"] for r in got}
    assert len(errors) == 1 and errors.pop() <= 1e-4


VECTORS = "vec_id long, embedding array<float>, label int"


def test_whitening(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(400, 12)) @ rng.normal(size=(12, 12)) + rng.normal(size=12) * 50).astype(np.float32)
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(vectors)]
    odd = [(900, None, 1), (901, [], 1), (902, [1.0] * 11, 1), (903, [float("nan")] * 12, 1), (904, [float("inf")] + [1.0] * 11, 1), (905, [None] + [1.0] * 11, 1)]
    df = spark.createDataFrame(rows + odd, VECTORS).repartition(5).select("*", *[F.lit("x").alias(c) for c in ("vector", "n", "component", "whitened", "place", "deviation")])
    check_whitening(whitening.whiten(df).collect(), list(range(400)), vectors)
    again = [(None, rows[0][1], 2), (None, rows[0][1], 2)]
    assert whitening.whiten(spark.createDataFrame(rows + again, VECTORS)).count() == 402 * 12


def test_whitening_without_full_variance(spark):
    """Equal vectors, one vector, dimensions that never vary or repeat another, huge entries, no vectors."""
    assert whitening.whiten(spark.createDataFrame([(1, None, 1)], VECTORS)).count() == 0
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 1)] * 3, VECTORS)).collect()
    assert {(r["whitened"], r["explained"], r["identity_error"], r["deviation"], r["n"]) for r in one} == {(0.0, 0.0, 0.0, 0, 3)} and len(one) == 6
    rng = np.random.default_rng(6)
    half = rng.normal(size=(200, 3)).astype(np.float32)
    vectors = np.hstack([half, half[:, :1], np.full((200, 1), 7, np.float32)])
    got = whitening.whiten(spark.createDataFrame([(i, [float(c) for c in v], 1) for i, v in enumerate(vectors)], VECTORS)).collect()
    check_whitening(got, list(range(200)), vectors)
    assert {r["whitened"] for r in got if r["component"] > 3} == {0.0}
    huge = whitening.whiten(spark.createDataFrame([(1, [1e30, 1.0], 1), (2, [-1e30, 2.0], 1), (3, [0.0, 3.0], 1)], VECTORS)).collect()
    assert len(huge) == 6 and all(np.isfinite(r["whitened"]) for r in huge) and {r["deviation"] for r in huge if r["vec_id"] == 1} == {None}


def test_deviation_of_many_rows():
    """Sums that pass 64 bits stay exact."""
    model = whitening.Whitening(10**12, (10**18, -(10**18)), np.ones(2), np.eye(2))
    x = np.array([[1_000_500, 3_000_000_000]], np.int64)
    assert [int(v) for v in model.deviations(x)[0]] == [10**12 * 1_000_500 - 10**18, 10**12 * 3_000_000_000 + 10**18]


@pytest.mark.parametrize("case", ["random", "clustered", "geometric", "equal", "rank one", "zero", "blocks"])
def test_spectral_divide_and_conquer(case):
    rng = np.random.default_rng(7)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    values = {
        "random": rng.normal(size=40) ** 2, "clustered": np.r_[np.ones(15), np.full(15, 1 + 1e-9), np.full(10, 3.0)], "geometric": 2.0 ** -np.arange(40), "equal": np.full(40, 2.0),
        "rank one": np.r_[5.0, np.zeros(39)], "zero": np.zeros(40), "blocks": np.repeat([4.0, 2.0, 1.0, 0.5], 10),
    }[case]
    v = turn @ np.diag(values) @ turn.T
    v = (v + v.T) / 2
    e, q = whitening.spectral(v)
    top = max(values.max(), 1e-300)
    assert np.abs(e - np.sort(values)[::-1]).max() < 1e-13 * top and np.abs(q.T @ q - np.eye(40)).max() < 1e-13 and np.abs(v @ q - q * e).max() < 1e-13 * top
    u = whitening.polar(v - 1.7 * np.eye(40))
    assert np.abs(u @ u - np.eye(40)).max() < 1e-12 and round(float(np.trace(u))) == 2 * int((values > 1.7).sum()) - 40


@tables
def test_whitening_query(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet' ORDER BY vec_id").fetchall()
    check_whitening(QUERIES["op13_embedding_whitening"](spark, SF).collect(), [r[0] for r in rows], [r[1] for r in rows])
