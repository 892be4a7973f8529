"""The near-duplicate stage decides by row: null and repeated ids lose no clean row and keep no copy."""

import corpus_pipeline as cp

A = " ".join(f"alpha{k}" for k in range(40))
B = " ".join(f"beta{k}" for k in range(40))
C = " ".join(f"gamma{k}" for k in range(40))
D = " ".join(f"delta{k}" for k in range(40))


def kept(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = cp.near_duplicates(spark, docs, None)
    assert got.columns == docs.columns
    return sorted(map(tuple, got.collect()), key=repr)


def test_null_and_repeated_ids(spark):
    rows = [
        (1, A, "x"), (None, A + " more", "x"),      # the row without an id is the copy
        (None, B, "x"), (None, B, "y"),             # a group of null ids only: one stays
        (None, C, "x"),                             # clean
        (5, A + " end", "x"), (5, D, "x"),          # one text of a repeated id is a copy
        (7, "few words", "x"), (8, None, "x"), (8, None, "x"), (None, "", "x"),
    ]
    want = [(1, A, "x"), (None, B, "x"), (None, C, "x"), (5, D, "x"), (7, "few words", "x"), (8, None, "x"), (8, None, "x"), (None, "", "x")]
    assert kept(spark, rows) == sorted(want, key=repr)


def test_equal_rows_and_equal_ids(spark):
    rows = [(3, A, "x"), (3, A, "x"), (3, A + " more", "x"), (4, B, "x")]
    got = kept(spark, rows)
    assert len(got) == 2 and (4, B, "x") in got
