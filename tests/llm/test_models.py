"""Trained models on held-out rows, byte-level BPE against the tiktoken library."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from cargolume.llm import bpe, language, quality
from tests.llm import cases

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def rows_with_labels(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return docs, spark.read.parquet(f"{folder}/labels.parquet")


# --- language ---

def test_languages_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = language.op2_language_id(spark, folder)
    docs, _ = rows_with_labels(spark, folder)
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 100 and np.mean([r.lang == r.lang_pred for r in rows]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_awkward_rows(spark):
    rnd = random.Random(1)
    rows = [(k, " ".join(rnd.choice(("the and of to" if k % 2 else "der und die das").split()) for _ in range(30)), "en" if k % 2 else "de") for k in range(200)]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en"] and np.mean(model.table == 0) > 0.5  # sparse
    got = language.identified(cases.table(spark), model).collect()
    letters = [(d, t) for d, t in cases.ROWS if t and any(c.isalpha() for c in t)]
    assert len(got) == len(cases.ROWS)
    assert sorted((r.doc_id for r in got if r.lang_pred != "und"), key=repr) == sorted((d for d, _ in letters), key=repr)
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert {(r.lang_pred, r.score) for r in language.identified(cases.table(spark), None).collect()} == {("und", 0.0)}
    assert language.fit(cases.empty(spark)) is None
    assert language.identified(cases.empty(spark), model).count() == 0


def test_frequencies_over_several_slices(spark):
    """Document frequencies equal those of plain counting, however texts are cut into slices."""
    rnd = random.Random(2)
    texts = ["".join(rnd.choice("abcd ") for _ in range(rnd.choice([0, 1, 2, 5, 3000]))) for _ in range(700)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts, total = language.document_frequencies(df)
    want = np.zeros(language.GRAMS, np.int64)
    for t in texts:
        feature, _ = language.grams([t])
        want[np.unique(feature)] += 1
    assert total == len(texts) and (counts == want).all()


# --- quality ---

def test_quality_of_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = quality.op7_quality_classifier(spark, folder)
    _, labels = rows_with_labels(spark, folder)
    rows = got.join(labels, "doc_id").where("held_out AND quality IS NOT NULL").collect()
    good, bad = [r.predicted for r in rows if r.quality], [r.predicted for r in rows if not r.quality]
    assert np.mean(good) >= 0.97 and np.mean(bad) <= 0.2
    assert got.select("score").where("score < 0 OR score > 1 OR score IS NULL").count() == 0


def test_quality_awkward_rows(spark):
    rnd = random.Random(4)
    rows = [(k, " ".join(rnd.choice("fine calm good text here".split() if k % 2 else "$$$ ### buy !!".split()) for _ in range(20))) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(300)] + [(3, 1), (4, None), (None, 1), (999_999, 0)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = {r.doc_id: r.score for r in quality.scored(docs, model).collect()}
    assert np.mean([(s >= 0.5) == bool(k % 2) for k, s in got.items()]) > 0.95
    odd = quality.scored(cases.table(spark), model).collect()
    assert len(odd) == len(cases.ROWS) and all(0 <= r.score <= 1 for r in odd)
    kept = quality.accepted(cases.table(spark), model)
    assert kept.columns == cases.table(spark).columns
    assert kept.count() == sum(r.score >= 0.5 for r in odd)
    none = quality.fit(docs, labels.where("false"))
    assert {r.score for r in quality.scored(docs, none).collect()} == {0.5}
    assert quality.scored(cases.empty(spark), model).count() == 0
    again = quality.fit(docs.repartition(5), labels.repartition(3))
    assert {r.doc_id: r.score for r in quality.scored(docs, again).collect()} == got


def test_pooling_in_parts(monkeypatch):
    """Means over parts of a long run of words equal plain means."""
    rng = np.random.default_rng(0)
    vectors, n = rng.normal(size=(quality.WORDS, 4)), [0, 3, 450_000, 0, 7, 1]
    rows = rng.integers(0, quality.WORDS, sum(n))
    ends = np.cumsum([0, *n])
    got = quality.pooled(rows, ends, vectors)
    for k, (a, b) in enumerate(zip(ends[:-1], ends[1:])):
        want = vectors[rows[a:b]].mean(axis=0) if b > a else np.zeros(4)
        assert got[k, :4] == pytest.approx(want, abs=1e-5)


# --- byte-level BPE ---

@pytest.fixture(scope="module")
def reference():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_library(spark, reference):
    rnd = random.Random(9)
    alphabet = ["a", "b", "the", "ing", " ", "  ", "\n", "é", "中", "\U0001f600", "'s", "1", "!", "\x85", " ", "\x1c", "<|endoftext|>"]
    rows = cases.ROWS + [(1000 + k, "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 300)))) for k in range(100)]
    rows += [(2000, "a" * 5000), (2001, "ab" * 700 + "\n" * 900), (2002, " " * 3000)]
    tokens = bpe.encode(cases.table(spark, rows), PATH, PATTERN)
    want = sorted(((d, reference.encode_ordinary(t or "")) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, r.ids) for r in tokens.collect()), key=repr) == want
    got = bpe.digests(bpe.decode(tokens, PATH, PATTERN)).collect()
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert sorted(map(tuple, got), key=repr) == sorted(
        ((d, len(i), sha(",".join(map(str, i)).encode()), sha((t or "").encode())) for (d, t) in rows for i in [reference.encode_ordinary(t or "")]), key=repr)
    assert bpe.decode(bpe.encode(cases.empty(spark), PATH, PATTERN), PATH, PATTERN).count() == 0


def test_bpe_bucket_sizes_and_cache(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 50)
    monkeypatch.setattr(bpe, "CHUNK", 400)
    codec, rnd = bpe.Codec(PATH, PATTERN), random.Random(3)
    texts = ["".join(rnd.choice("etaoinshrdlu ") for _ in range(rnd.randint(0, 1000))) for _ in range(30)] + ["x" * 255, "x" * 256, "x" * 257]
    assert [x.tolist() for x in codec.encode(texts)] == [reference.encode_ordinary(t) for t in texts]
    pieces = [bytes(rnd.choice(b"etaoinsh") for _ in range(rnd.randint(2, 250))) for _ in range(200)]
    assert codec.encode_bytes(pieces) == [codec.merge_long(p) if p not in codec.ranks else (codec.ranks[p],) for p in pieces]
