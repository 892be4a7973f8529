"""The audit against plain counting over all orders."""

import re
from itertools import permutations

import pytest

from cargolume.llm import interaction
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, labels):
    """rows: (doc_id, source, text); labels: (doc_id, quality, toxic)."""
    good, toxic = ({d for d, *x in labels if d is not None and x[k] == 1} for k in (0, 1))
    fails = []
    for d, s, t in rows:
        t = t or ""
        w = WORD.findall(t)
        copy = d is not None and any(e is not None and e < d and (u or "") == t for e, _, u in rows)
        checks = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), re.search("[#$%&*|]", t) is not None, copy]
        fails.append((s or "", {x for x, f in zip("ABCDE", checks) if f}, d in good, d in toxic))
    out, removals = [], {}
    for part in sorted({p for p, *_ in fails}):
        for order in map("".join, permutations("ABCDE")):
            here = [f for f in fails if f[0] == part]
            for k, x in enumerate(order):
                gone = [f for f in here if x in f[1]]
                failing = [f for f in fails if f[0] == part and x in f[1]]
                removals[part, x] = removals.get((part, x), 0) + len(gone)
                here = [f for f in here if x not in f[1]]
                out.append((part, order, k + 1, len(here), len(gone), len(failing) - len(gone), sum(f[1] == {x} for f in failing), sum(f[2] for f in gone), sum(f[3] for f in gone)))
    return sorted((*r, removals[r[0], r[1][r[2] - 1]]) for r in out)


def result(spark, docs, labels):
    schema = "doc_id long, quality int, toxic int, part string, mask int, n long"
    marked = spark.createDataFrame([(*r, "x", 1, 1) for r in labels], schema)
    return sorted(map(tuple, interaction.audit(docs, marked).collect()))


def test_every_mask(spark):
    """Texts with all 32 combinations of faults, in three parts."""
    rows, d = [], 0
    for mask in range(32):
        words = [f"w{mask}x{k}" for k in range(150 if mask & 1 else 250)]
        if mask & 2:
            words = [words[k % 40] for k in range(len(words))]
        text = " ".join(words) + (" " + "CAPS" * 60 if mask & 4 else "") + (" a|b" if mask & 8 else "")
        for copy in range(2 if mask & 16 else 1):
            rows.append((1000 * copy + d, [None, "", "s1", "s2"][mask % 4], text))
            d += 1
    labels = [(r[0], r[0] % 2, int(r[0] % 3 == 0)) for r in rows[::2]] + [(0, 1, 0), (0, 0, 1), (None, 1, 1), (1, None, None)]
    docs = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], "doc_id long, source string, text string, mask int, n int, good int")
    assert result(spark, docs, labels) == brute(rows, labels)


def test_awkward_rows(spark):
    docs = cases.table(spark)
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    labels = [(1, 1, 0), (5, 1, 1), (2, 0, 1), (None, 1, 1)]
    assert result(spark, docs, labels) == brute(rows, labels)


def test_empty_table_and_limit_kept(spark):
    assert result(spark, cases.empty(spark), [(1, 1, 0)]) == []
    assert spark.conf.get(interaction.ROW_LIMIT) == "1000000"


@pytest.mark.parametrize("labels", [[], [(1, None, None)]])
def test_no_labels(spark, labels):
    docs = cases.table(spark)
    assert all(r[-3:-1] == (0, 0) for r in result(spark, docs, labels))
