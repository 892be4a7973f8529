"""Suffix-array dedup against all windows of small corpora."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from cargolume.llm import substrings
from cargolume.llm.substrings import LENGTH, common_prefixes, deduplicated, previous_factors, suffix_order


def brute(rows, keep="none"):
    texts = [(t or "").encode() for _, t in rows]
    windows = Counter(t[i:i + LENGTH] for t in texts for i in range(len(t) - LENGTH + 1))
    first = {}
    for k in sorted(range(len(rows)), key=lambda k: rows[k][0]):
        for i in range(len(texts[k]) - LENGTH + 1):
            first.setdefault(texts[k][i:i + LENGTH], (rows[k][0], i))
    out = []
    for (d, _), t in zip(rows, texts):
        gone = bytearray(len(t))
        for i in range(len(t) - LENGTH + 1):
            w = t[i:i + LENGTH]
            if windows[w] > 1 and (keep == "none" or first[w] != (d, i)):
                gone[i:i + LENGTH] = b"\1" * LENGTH
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((d, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def corpus(seed):
    rnd = random.Random(seed)
    prose = lambda n: " ".join("".join(rnd.choice("abcdeéfgñ") for _ in range(rnd.randint(2, 8))) for _ in range(n))
    passages = [prose(n) for n in (30, 40, 45, 60, 90, 200)]
    rows = []
    for d in range(60):
        t = prose(rnd.randint(0, 60))
        for _ in range(rnd.choice([0, 0, 1, 2])):
            t += rnd.choice(passages) + prose(rnd.randint(0, 20))
        rows.append((d, t))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, rows[7][1][:-1]), (103, "x" + rows[7][1]), (104, "a" * 900), (105, "ab, " * 200),
             (106, None), (107, ""), (108, passages[0][:150]), (109, passages[5][:200]), (110, passages[5][50:250]), (111, "b" * 200), (112, "b" * 201)]
    return rows


def found(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect())


@pytest.mark.parametrize("seed,most", [(1, 1000), (2, 1)])
def test_against_all_windows(spark, seed, most):
    """most=1 sends every anchor with several contexts the way of the frequent ones."""
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, token int")
    assert found(deduplicated(df, most=most)) == brute(rows)


@pytest.mark.parametrize("most", [1000, 1])
def test_first_occurrence_stays(spark, most):
    rows = corpus(3)
    assert found(deduplicated(spark.createDataFrame(rows, "doc_id long, text string"), keep="first", most=most)) == brute(rows, "first")


def test_parts_of_long_texts(spark, monkeypatch):
    """Texts are handled in parts; a repeat that crosses them is found."""
    monkeypatch.setattr(substrings, "PART", 300)
    rows = corpus(4)[:20]
    assert found(deduplicated(spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def test_nulls_repeated_rows_and_empty_table(spark):
    rows = [(None, "a b " * 60), (5, "q" * 199), (5, "q" * 199), (6, "k" * 100 + "z" * 150), (6, "k" * 100 + "z" * 150)]
    got = deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id or 0, r.n_removed, r.n_spans) for r in got)) == [(0, 240, 1), (5, 0, 0), (5, 0, 0), (6, 250, 1), (6, 250, 1)]
    assert deduplicated(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def shared(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("text,least", [(t, m) for t in (b"", b"a", b"aaaaaaaa", b"abracadabra" * 3, b"zyxwv" * 4, bytes(random.Random(5).choices(b"ab", k=120)),
                                                         bytes(random.Random(6).choices(b"abcd", k=200))) for m in (1, 3)])
def test_previous_and_next_factors(text, least):
    """Each position's longest match that begins earlier (later), against all pairs of positions."""
    order = sorted(range(len(text)), key=lambda i: text[i:])
    common = np.array([0] * bool(order) + [shared(text[i:], text[j:]) for i, j in zip(order, order[1:])], np.int64)
    for sign in (1, -1):
        got = previous_factors(sign * np.array(order, np.int64), common, least)
        want = [max([shared(text[i:], text[j:]) for j in range(len(text)) if sign * j < sign * i], default=0) for i in order]
        assert got.tolist() == [w if w >= least else 0 for w in want]


def test_common_prefixes_and_order():
    rnd = random.Random(9)
    base = bytes(rnd.choices(b"ab\x00\xff", k=LENGTH + 40))
    raw = [base, base[:150] + bytes(rnd.choices(b"ab", k=LENGTH - 120)), base[:LENGTH], base[3:LENGTH + 20]]
    count = [len(r) - LENGTH + 1 for r in raw if len(r) >= LENGTH]
    raw = [r for r in raw if len(r) >= LENGTH]
    context, number, position, common = suffix_order(raw, count, ["d", "b", "c", "a"][:len(raw)])
    windows = [raw[c][o:o + LENGTH] for c, o in zip(context, number)]
    assert windows == sorted(windows) and len(set(position.tolist())) == sum(count)
    assert common.tolist() == [0] + [shared(a, b) for a, b in zip(windows, windows[1:])]
    assert common_prefixes(np.zeros((0, 25), ">u8")).tolist() == []
