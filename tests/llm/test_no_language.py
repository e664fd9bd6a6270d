import pytest

import corpus_pipeline

TEXTS = ["plain words", "wörter", "12 !", "", None, "ж"]


@pytest.mark.parametrize("lang", [None, "en"])
def test_nothing_learned(spark, lang):
    """Without a language to learn from, clean texts stay: no row has one, or only one of the held-out fold."""
    from geonet.llm.language import held_out

    ids = [r[0] for r in spark.range(1000).withColumnRenamed("id", "doc_id").filter(held_out()).limit(len(TEXTS)).collect()]
    docs = spark.createDataFrame([(i, t, lang) for i, t in zip(ids, TEXTS)], "doc_id bigint, text string, lang string")
    out = corpus_pipeline.identify_language(spark, docs, "")
    assert out.columns == docs.columns
    assert {r["text"] for r in out.collect()} == {"plain words", "wörter", "ж"}
