"""The corpus pipeline's stages on a small table, and the queries' SQL."""

import hashlib

import numpy as np
import pyarrow as pa

import corpus_pipeline
from lakeforge.llm import piece_codec, quality, queries, store

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = store.read_table(spark, SF, "documents")
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["quality_stage", "exact_stage", "near_stage", "mix_stage", "encode_stage"]
    for _, stage in corpus_pipeline.STAGES[:3]:
        before, docs = {r["doc_id"] for r in docs.collect()}, store.save(stage(spark, docs, SF), "t")
        after = [r["doc_id"] for r in docs.collect()]
        assert docs.columns == corpus_pipeline.COLUMNS and set(after) <= before and len(after) == len(set(after))
    texts = [r["text"] for r in docs.collect()]
    assert len(texts) == len(set(texts))
    mixed = store.save(corpus_pipeline.mix_stage(spark, docs, SF), "t")
    assert mixed.columns == corpus_pipeline.COLUMNS and mixed.where("n_chars <> char_length(text)").count() == 0
    out = corpus_pipeline.encode_stage(spark, mixed, SF)
    assert out.count() == mixed.count() > 0


def test_rows_are_told_apart(spark, monkeypatch):
    """Repeated rows, ids with two texts and several null ids, by all stages."""
    queries.ship(spark)
    text = {c: " ".join(f"{c}{i}" for i in range(60)) for c in "abcdefg"}
    rows = [
        (1, text["a"], "src0"), (1, text["a"], "src0"), (1, text["a"], "src1"),  # repeated rows
        (2, text["b"], "src0"), (2, text["c"], "src0"), (3, text["c"], "src0"),  # one text of 2 is an exact copy
        (4, text["b"] + " end", "src0"), (4, text["d"], "src0"),  # one text of 4 is a near copy
        (None, text["e"], "src0"), (None, text["f"], "src0"), (None, text["f"], "src0"), (None, text["g"] + " !!!", "src0"), (5, text["e"], "src0"),
        (6, None, "src0"), (6, "", "src0"),
    ]
    docs = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    model = corpus_pipeline.quality.Model(-np.eye(len(corpus_pipeline.quality.FEATURES))[corpus_pipeline.quality.FEATURES.index("bang_share")], -0.01, 0.7)
    monkeypatch.setattr(corpus_pipeline.quality, "train", lambda *_: model)
    good = store.save(corpus_pipeline.quality_stage(spark, docs, SF), "t")
    assert pairs(good) == sorted(((i, t) for i, t, _ in rows if "!" not in (t or "")), key=str)
    exact = store.save(corpus_pipeline.exact_stage(spark, good, SF), "t")
    kept = [(1, text["a"]), (2, text["b"]), (3, text["c"]), (4, text["b"] + " end"), (4, text["d"]), (5, text["e"]), (None, text["f"]), (6, "")]
    assert pairs(exact) == sorted(kept, key=str) and {r["source"] for r in exact.where("doc_id = 1").collect()} == {"src0"}
    near = store.save(corpus_pipeline.near_stage(spark, exact, SF), "t")
    kept.remove((4, text["b"] + " end"))
    assert pairs(near) == sorted(kept, key=str)
    monkeypatch.setattr(queries, "MIX", corpus_pipeline.mixing.Mix(percent=200, max_epochs=2))
    assert pairs(corpus_pipeline.mix_stage(spark, near, SF)) == sorted([k for k in kept if k[1]] * 2, key=str)
    assert pairs(corpus_pipeline.mix_stage(spark, near.union(near), SF)) == sorted([k for k in kept if k[1]] * 2, key=str)


def test_encode_stage_of_null_and_empty_texts(spark):
    queries.ship(spark)
    docs = spark.createDataFrame([(1, None, "en", "s", 0), (2, "", "en", "s", 0), (None, " a b", "en", "s", 4)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = {r["doc_id"]: r for r in corpus_pipeline.encode_stage(spark, docs, SF).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert {(got[i]["n_tokens"], got[i]["ids_sha256"], got[i]["decoded_sha256"]) for i in (1, 2)} == {(0, nothing, nothing)}
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECE_MODEL))
    ids = library.encode(" a b")
    assert got[None]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got[None]["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_empty_table(spark):
    docs = store.read_table(spark, SF, "documents").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = store.save(stage(spark, docs, SF), "t")
    assert docs.count() == 0


def test_every_operator_has_a_query():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [*(f"op{k}" for k in range(1, 14)), "pipeline"]


def test_workers_hold_one_steps_tables(spark):
    """A worker that scored texts keeps no encoder; encoding and decoding don't run side by side."""
    codec = piece_codec.codec(queries.tokenizer_path(queries.PIECE_MODEL))
    texts = ["one two three", None, "", "x" * quality.PIECE, " ".join(f"w{i}" for i in range(300))] * 2
    ids = [codec.encode(t).tolist() for t in texts]
    parts = list(quality.feature_parts(pa.array(texts)))
    assert piece_codec.codec.cache_info().currsize == 0
    assert [start for start, _ in parts] == [0, 4, 9] and np.array_equal(np.concatenate([x for _, x in parts]), quality.feature_rows(texts))
    again = piece_codec.codec(queries.tokenizer_path(queries.PIECE_MODEL))
    assert again is not codec and [again.encode(t).tolist() for t in texts] == ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = corpus_pipeline.encode_stage(spark, docs, SF)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    rows = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"]) for r in out.collect()}
    assert rows == {i: (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()) for i, x in enumerate(ids)}
