"""Every query over messy and empty tables."""

from collections import Counter

import pytest

from siltworks.llm.queries import QUERIES


@pytest.mark.parametrize("name", QUERIES)
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ("op6_url_filter", "op9_packing", "op11_centroids", "op12_vector_codes")])
def test_one_row_per_document(spark, messy, texts, name):
    rows = QUERIES[name](spark, messy).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter(i for i, _ in texts)


def test_pipeline_over_empty_and_messy_tables(spark, empty, messy, texts):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, empty).count() == 0
    ids = {r["doc_id"] for r in corpus_pipeline.run(spark, messy).select("doc_id").collect()}
    assert ids and ids <= {i for i, _ in texts}
