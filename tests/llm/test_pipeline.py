"""The pipeline's stages on small documents: what each keeps, in which columns, and what comes out at the end."""

import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from riskloom.llm.base import stored, table
from tests.llm.fixtures import ROWS, frame, prose


def test_stages_on_awkward_documents(spark, sf):
    rows = ROWS + [(100 + i, prose(i, 50), "en", "s") for i in range(40)] + [(300, "12 !!", "en", "s")]
    docs = frame(spark, rows)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf).cache()
        if k + 1 < len(corpus_pipeline.STAGES):
            assert out.columns == docs.columns
        ids = [r.doc_id for r in out.collect()]
        if name == "language_id":
            assert {100, 139, 1, 10} <= set(ids) and not {3, 4, 5, 300} & set(ids)
        if name == "near_duplicates":
            assert 1 in ids and 2 not in ids and {100 + i for i in range(40)} <= set(ids)
        if name == "repeated_passages":
            assert len(ids) == docs.count()
        before, docs = docs, out
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in before.where("doc_id is not null").collect()}
    for r in docs.where("doc_id is not null").collect():
        assert list(r.ids) == library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest() and r.n_tokens == len(r.ids)


def test_near_duplicates_need_no_large_broadcast(spark, sf):
    """Settings in proportion to so few documents: what Spark may take for small, and what a driver has room for."""
    rows = [(i, f"w{i} x{i * 7} y{i * 31} z", "en", "s") for i in range(16_000)]
    docs = stored(frame(spark, rows), "test-docs")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "800k", "spark.sql.maxBroadcastTableSize": "40m"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        kept = dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, sf).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert 15_000 < len(kept) <= 16_000 and len({r.doc_id for r in kept}) == len(kept)


def test_stages_on_no_documents(spark, sf):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        assert docs.count() == 0


def test_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert 0 < out.count() and table(spark, sf, "documents").count() > 0
    assert {"doc_id", "n_tokens", "ids"} <= set(out.columns)
