"""The language sample is the 1,500 smallest draws of each language, and no task ranks many more."""

from pyspark.sql import functions as F

from cargolume.llm import language


def test_smallest_draws_of_each_language(spark):
    docs = spark.range(9000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"),
                                    F.when(F.col("id") % 100 == 0, "de").when(F.col("id") % 3 == 0, "fr").otherwise("en").alias("lang"))
    draws = {}
    for r in language.draws(docs).collect():
        draws.setdefault(r.lang, set()).add(r.draw)
    got = {}
    for r in language.training_rows(docs).select("lang", "draw").collect():
        got.setdefault(r.lang, set()).add(r.draw)
    assert got == {lang: set(sorted(d)[:1500]) for lang, d in draws.items()}
    assert {lang: len(d) for lang, d in got.items()} == {"de": 90, "fr": 1500, "en": 1500}
