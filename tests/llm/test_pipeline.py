"""The pipeline against its stages done plainly, one document at a time."""

import os
import re

import pyarrow as pa
import pytest
import sentencepiece

import corpus_pipeline
from larkspur.llm import toxicity
from larkspur.llm.queries import PIECE_MODEL

from . import test_decontaminate, test_minhash, test_secrets

SMALL = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(PIECE_MODEL), reason="no tokenizer file")
def test_matches_plain_stages(spark, documents):
    labels, bench = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("labels", "benchmark"))
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    model = toxicity.learned(documents, labels)
    score = model.score(pa.array([t for _, t, _ in rows]))
    rows = [r for r, s in zip(rows, score) if s < 0.5]
    kept = {r[0] for r in test_minhash.plain([r[:2] for r in rows], 5, 80) if r[3]}
    rows = [r for r in rows if r[0] in kept]
    items = [(r.item_id, r.text) for r in bench.collect()]
    clean = {r[0] for r in test_decontaminate.plain([r[:2] for r in rows], items) if not r[2]}
    rows = [r for r in rows if r[0] in clean]
    want = {}
    encode = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL).encode
    for (i, t, _), (_, spans, _) in zip(rows, test_secrets.plain(rows, repo=0)):
        out, at = "", 0
        for a, _, b, _ in spans:
            if a >= at:
                out += t[at:a] + "[SECRET]"
            at = max(at, b)
        want[i] = encode(out + t[at:])
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert {r.doc_id: list(r.ids) for r in got} == want and all(r.n_tokens == len(r.ids) for r in got)
    assert 0 < len(want) < documents.count()


def test_stages_keep_the_columns(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == documents.columns, name
        assert [f.dataType for f in out.schema] == [f.dataType for f in documents.schema]
        docs = out
    assert not docs.where("n_chars <> length(text)").take(1)


def test_stages_take_empty_and_odd_documents(spark, documents):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, None, "en", None, 0), (1, "a", "en", None, 1)], documents.schema)
    for docs, left in ((documents.limit(0), 0), (odd, 4)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL)
        assert docs.count() == left


def test_stage_names():
    assert [re.sub("_.*", "", n) for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash", "benchmark", "secret", "sentencepiece"]
