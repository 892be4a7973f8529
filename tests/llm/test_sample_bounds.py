"""Samples are bounded in rows, also where one id has many."""

from cargolume.llm import language, quality


def repeated(spark):
    """One id with 300 equal rows and 300 different ones, and 100 other ids."""
    rows = [(1, "the same text again")] * 300 + [(1, f"text number {k} of one id") for k in range(300)] + [(k, f"plain text {k}") for k in range(2, 102)]
    return spark.createDataFrame([(d, t, "en") for d, t in rows], "doc_id long, text string, lang string")


def test_language_sample_is_bounded_in_rows(spark):
    docs = repeated(spark)
    assert language.training_rows(docs, 50).count() == 50
    every = language.training_rows(docs, 1000)
    assert every.count() == 401  # equal rows count once


def test_quality_sample_is_bounded_in_rows(spark):
    docs = repeated(spark)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 102)], "doc_id long, quality int")
    assert quality.training_rows(docs, labels, 50).count() <= 50
    every = quality.training_rows(docs, labels, 1000).collect()
    assert len(every) == len({(r.doc_id, r.text) for r in every})
