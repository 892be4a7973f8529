"""Fill-in-middle against plain Python, and the chunks on their own."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cargolume.llm import middle
from tests.llm import cases


def plain(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return doc_id, n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def check(spark, rows, columns="doc_id long, text string, n long, form string, marked int"):
    docs = spark.createDataFrame([(d, t, 1, "x", 0) for d, t in rows], columns)
    made = middle.fill_in_middle(docs)
    got = made.withColumn("back", middle.restored(F.col("output"), F.col("form"))).collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((plain(d, t) for d, t in rows), key=repr)
    assert sorted((r.doc_id, r.back) for r in got if r.doc_id is not None) == sorted((d, t or "") for d, t in rows if d is not None)


def test_against_plain_python(spark):
    rnd = random.Random(5)
    passage = "".join(rnd.choice("abc é中\U0001f600\n<SPM>") for _ in range(3000)).replace("<S>", "").replace("<P>", "").replace("<M>", "")
    rows = []
    for d in range(200):
        own = "".join(rnd.choice("xyz ñ漢<>PSM") for _ in range(rnd.choice([0, 1, 2, 30, 500])))
        rows.append((d, rnd.choice([own, own + passage, passage + own, own + passage + own, own + rnd.choice(["<P>", "<S>", "<M>", "<P"]) + passage])))
    check(spark, rows)


def test_awkward_rows_and_empty_table(spark):
    check(spark, [*cases.ROWS, (70, "<<S"), (71, "<P"), (72, ">" * 300), (73, "é" * 20_000), (74, "x" * 100_000)])
    assert middle.fill_in_middle(cases.empty(spark)).count() == 0
    made = middle.fill_in_middle(cases.table(spark))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]


def test_marker_across_chunks():
    """Wherever a chunk ends, a marker that lies across the end is seen."""
    rnd = random.Random(1)
    for _ in range(300):
        text = "".join(rnd.choice("ab<>PSM é") for _ in range(700)).encode()
        assert middle.Chunks(("<P>", "<S>", "<M>")).cut(text, 0, 0)[-1] == any(m in text for m in (b"<P>", b"<S>", b"<M>"))


@pytest.mark.parametrize("block", [50, 1000, 1 << 20])
def test_ends_do_not_depend_on_blocks(monkeypatch, block):
    data = random.Random(2).randbytes(20_000)
    want = middle.boundaries(data)
    monkeypatch.setattr(middle, "BLOCK", block)
    assert middle.boundaries(data) == want and want[-1] == len(data)
    assert all(b - a <= middle.MOST for a, b in zip([0, *want], want))


def test_shared_passages_share_chunks():
    rnd = random.Random(3)
    passage = rnd.randbytes(30_000)
    first, second = (rnd.randbytes(k) + passage for k in (777, 1234))

    def chunks(data):
        ends = middle.boundaries(data)
        return {data[a:b] for a, b in zip([0, *ends], ends)}

    both = chunks(first) & chunks(second)
    assert sum(map(len, both)) > 0.9 * len(passage)


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(middle.xxhash, "xxh3_64_intdigest", lambda b: 0)
    chunks = middle.Chunks(("<P>",))
    assert chunks.summary(b"abc") == (3, False) and chunks.summary("é<P>".encode()) == (4, True) and chunks.summary(b"abc") == (3, False)


def test_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(middle, "CACHE_BYTES", 5_000)
    chunks = middle.Chunks(("<P>",))
    for k in range(200):
        chunks.summary(str(k).encode() * 100)
    assert chunks.held < 6_000 and sum(len(x) for x, _ in chunks.cache.values()) <= chunks.held
