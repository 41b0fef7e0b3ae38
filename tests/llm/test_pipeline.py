"""The stages in order on a small table."""

import corpus_pipeline
from lumenmart.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_pass_on_documents(spark):
    docs = table(spark, SF, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == list(corpus_pipeline.COLUMNS), name
    left = docs.collect()
    assert 0 < len(left) < len(before)
    assert len({r.doc_id for r in left}) == len(left)
    assert all(set(r.text.split("\n")) <= set(before[r.doc_id].split("\n")) for r in left)


def test_run_ends_in_token_ids(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert rows and all(r.n_tokens == len(r.ids) for r in rows)
    assert len({r.doc_id for r in rows}) == len(rows)
