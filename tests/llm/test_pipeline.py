"""The stages in order, against plain versions of each."""

import os

import public_tokenizers

import corpus_pipeline
from tableflow.llm import common, packing, pii, toxicity

from . import brute
from .test_operators import SCHEMA, words


def test_run(spark, tmp_path):
    base = words(1, 80)
    clean = [(i, words(100 + i, 50)) for i in range(60)] + [(70, base), (71, base.upper()), (72, base.replace(base.split()[40], "x")), (73, f"{words(3, 20)} a@b.org"), (74, None), (75, "")]
    toxic = [(200 + i, f"{words(300 + i, 20)} idiot scum {words(400 + i, 20)} moron idiot scum") for i in range(30)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in clean + toxic]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels = spark.createDataFrame([(i, 1, int(i >= 200)) for i, _ in clean + toxic], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, seen, str(tmp_path)).write.parquet(str(tmp_path / "out" / name))
        seen = spark.read.parquet(str(tmp_path / "out" / name))
        assert seen.columns == docs.columns, name
    model = toxicity.train(docs, labels, "toxic")
    kept = [(i, t) for i, t in clean + toxic if not model.at_least(toxicity.np.array([model.score(t or "")]))[0, 0] >= model.cut]
    assert sorted(i for i, _ in kept) == sorted(i for i, _ in clean)
    stays = {i for i, *_, k, _ in brute.exact(kept) if k}
    kept = [(i, t) for i, t in kept if i in stays]
    stays = {i for i, _, c in brute.jaccard(kept) if c == i}
    kept = sorted((i, None if t is None else pii.redact_text(t, pii.base_spans(t))) for i, t in kept if i in stays)
    assert sorted((r["doc_id"], r["text"]) for r in seen.collect()) == kept
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in seen.collect())

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    path = public_tokenizers.path
    want = {i: len(packing.token_ids(t or "", path("byte_bpe_50k.json"), None)) for i, t in kept}
    got = {}
    for p in out:
        got[p["doc_id"]] = got.get(p["doc_id"], 0) + p["length"]
    assert got == want


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rows_without_an_id_and_repeated_rows(spark, tmp_path):
    """Columns that clash with those of the stages do not pass, every kept text is packed once for each row that stays."""
    text = words(1, 40)
    rows = [(1, text), (1, text), (None, text), (None, words(2, 40)), (None, words(2, 40)), (3, words(3, 40)), (3, words(4, 40)), (4, None), (None, None)]
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t), 1, "x") for i, t in rows], f"{SCHEMA}, grade int, _key0 string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {}
    for p in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p["length"])
    path = public_tokenizers.path
    want = [(i, len(packing.token_ids(t or "", path("byte_bpe_50k.json"), None))) for i, t in [(1, text), (None, words(2, 40)), (3, words(3, 40)), (3, words(4, 40)), (4, None)]]
    assert sorted(got, key=repr) == sorted(want, key=repr) and all(sum(v) == n for (_, n), v in got.items())


def test_workers_give_back_memory(spark):
    """A Python worker lives on, but what a task has freed does not stay with it, though something above it in memory does."""

    def work(b):
        held = [b"%06d" % i * 10_000 for i in range(3000)]
        common.kept_by_a_test = bytes(len(held[0]))
        return {"pid": [os.getpid()] * b.num_rows}

    pid = common.map_arrow(spark.range(0, 1, 1, 1), work, "pid long").collect()[0][0]
    with open(f"/proc/{pid}/smaps_rollup") as f:
        anonymous = next(int(line.split()[1]) for line in f if line.startswith("Anonymous:"))
    assert anonymous < 150_000  # KB; the task held 180 MB beside what any worker has
