"""Each stage against a plain version of what it does, on its own input."""

import corpus_pipeline
from playstream.llm import bpe, gam, mixing, pii
from playstream.llm.common import DOCUMENT_COLUMNS
from tests.conftest import SMALL
from tests.llm.helpers import odd_documents, rows, supplied
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages_in_order(spark):
    docs = supplied(spark)
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "pii_pseudonyms", "source_mixing", "bpe_encoding"]
    inputs, given = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = given
        given = stage(spark, given, SMALL).persist()
        assert name == names[-1] or given.columns == list(DOCUMENT_COLUMNS)
    passed = {r.doc_id for r in gam.quality(docs, supplied(spark, "labels")).collect() if r.predicted}
    assert {r.doc_id for r in inputs["simhash_near_dedup"].collect()} == passed
    prints = [(r.doc_id, plain_fingerprint(r.text)) for r in inputs["simhash_near_dedup"].collect()]
    first = {component for _, _, component in plain_components(prints)}
    assert {r.doc_id for r in inputs["pii_pseudonyms"].collect()} == first
    unchanged = {r.doc_id for r in pii.report(inputs["pii_pseudonyms"]).collect() if not r.n_replaced}
    before = {r.doc_id: r.text for r in inputs["pii_pseudonyms"].collect()}
    after = {r.doc_id: r.text for r in inputs["source_mixing"].collect()}
    assert before.keys() == after.keys() and {d for d in before if before[d] == after[d]} == unchanged
    copies = {r.doc_id: r.copies for r in mixing.report(inputs["source_mixing"]).collect()}
    taken = [r.doc_id for r in inputs["bpe_encoding"].collect()]
    assert {d: taken.count(d) for d in copies} == copies
    text = {r.doc_id: r.text for r in inputs["bpe_encoding"].collect()}
    codec = bpe._codec(None, None)
    result = given.collect()
    assert sorted(r.doc_id for r in result) == sorted(taken)
    for r in result:
        packed = b"".join(i.to_bytes(4, "little") for i in r.ids)
        assert codec.decode(packed).decode() == text[r.doc_id] and r.n_tokens == len(r.ids)


def test_odd_and_empty_input(spark):
    for docs in (odd_documents(spark), odd_documents(spark).limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SMALL).persist()
        assert len(rows(docs.select("doc_id"))) == docs.count()
