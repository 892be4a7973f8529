"""The pipeline's stages, each against plain Python on what the stage before kept."""

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as cp
from cargolume.llm import quality
from cargolume.session import materialise
from tests.llm import cases
from tests.llm.test_counts import sized, targets
from tests.llm.test_lines import brute as plain_lines
from tests.llm.test_models import reference  # noqa: F401
from tests.llm.test_near import brute as plain_near

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def results(spark):
    """The input and every stage's rows."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    docs = materialise(docs.union(cases.table(spark).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns).where("doc_id < 0")), "input")
    out = [docs]
    for name, stage in cp.STAGES:
        out.append(materialise(stage(spark, out[-1], FOLDER), name))
    return out


def test_names_and_columns(results):
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "line_dedup", "near_duplicates", "mix_sources", "tokens"]
    assert all(r.columns == results[0].columns for r in results[:-1])
    assert results[-1].columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quality_stage(spark, results):
    before, after = results[0], results[1]
    model = quality.fit(before.select("doc_id", "text"), spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r.doc_id for r in quality.scored(before, model).where("score >= 0.5").collect()}
    assert sorted(map(tuple, after.collect())) == sorted(tuple(r) for r in before.collect() if r.doc_id in good)
    assert 0 < len(good) < before.count()


def test_line_stage(results):
    before, after = results[1].collect(), results[2].collect()
    assert sorted(((r.doc_id, r.text) for r in after), key=repr) == plain_lines([(r.doc_id, r.text) for r in before])
    assert all(r.n_chars == len(r.text) for r in after)
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before)


def test_near_stage(spark, results):
    """Judged on texts with their copies, which the line stage takes away here."""
    before = results[1]
    after = cp.near_duplicates(spark, before, FOLDER).collect()
    want = {d for d, _, c in plain_near([(r.doc_id, r.text) for r in before.collect()]) if d == c}
    assert {r.doc_id for r in after} == want and len(want) < before.count()


def test_mix_stage(results):
    before, after = results[3].collect(), results[4].collect()
    rows = sized([(r.doc_id, r.text, r.source) for r in before])
    total = Counter()
    for _, s, n in rows:
        total[s] += n
    times, taken, longest = Counter(r.doc_id for r in after), Counter(), Counter()
    for d, s, n in rows:
        taken[s] += n * times[d]
        longest[s] = max(longest[s], n)
    assert set(times.values()) <= {1, 2}
    for s, t in targets(total).items():
        assert abs(taken[s] - t) <= longest[s]
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def test_token_stage(results, reference):  # noqa: F811
    before, after = results[4].collect(), results[5].collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in after) == sorted((r.doc_id, tuple(reference.encode_ordinary(r.text))) for r in before)


def test_awkward_rows_and_empty_table(spark):
    docs = cases.table(spark)
    for name, stage in cp.STAGES[1:]:
        assert stage(spark, docs, FOLDER).count() > 0, name
    for name, stage in cp.STAGES:
        assert stage(spark, cases.empty(spark), FOLDER).count() == 0, name


def test_run_reads_documents(spark):
    assert cp.run(spark, FOLDER).count() > 0
    assert public_tokenizers.PATTERN
