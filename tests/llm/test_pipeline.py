"""The pipeline's stages: their order, their effect, and all rows against brute force."""

import public_tokenizers as P
import pytest
from test_partenum import brute as linked_by_hand
from test_superkmers import brute as cut_by_hand
from tokenizers import Tokenizer

import corpus_pipeline as C
from vacancia.llm import perplexity, rff_quality
from vacancia.llm.queries import quality_model

SF = "/root/testdata/sf0.001"


def test_stages():
    assert [n for n, _ in C.STAGES] == ["quality_classifier", "quality_rules", "near_copies", "repeated_passages", "packing"]


def test_rows_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = {r.doc_id for r in rff_quality.score(docs, quality_model(spark, docs, SF)).collect() if r.predicted}
    left = docs.filter(docs.doc_id.isin(sorted(good)))
    kept = {r.doc_id for r in perplexity.judge(left).collect() if r.kept}
    rows = [(r.doc_id, r.text) for r in left.collect() if r.doc_id in kept]
    first = {d for d, _, c in linked_by_hand(rows, C.WORDS, C.PERCENT) if d == c}
    rows = [r for r in rows if r[0] in first]
    assert 0 < len(rows) < docs.count()
    texts = {d: (k if gone else t) for (d, t), (_, _, gone, k) in zip(rows, cut_by_hand(rows, C.WINDOW))}
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    want = {d: len(library.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts.items()}
    got = {}
    for r in C.run(spark, SF).collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_and_empty_documents(spark, odd, k):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    name, stage = C.STAGES[k]
    for df in (docs, docs.limit(0)):
        out = stage(spark, df, SF)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert out.count() <= df.count() or name == "packing"
