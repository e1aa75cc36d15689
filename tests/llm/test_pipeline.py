import corpus_pipeline
from snapfeed.llm.queries import REGISTRY

from llm_cases import SF_SMALL


def test_pipeline(spark):
    rows = REGISTRY["pipeline"](spark, SF_SMALL).collect()
    assert rows and set(rows[0].asDict()) == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}


def test_stages_take_hard_rows(spark, hard, no_docs):
    """Each stage on rows with nulls, repeats and clashing names, and on no rows."""
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, hard, SF_SMALL)
        out.collect()
        if name != "bpe":
            assert out.columns == hard.columns
        assert stage(spark, no_docs, SF_SMALL).count() == 0
