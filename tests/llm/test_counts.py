"""Mixing, quality rules, exact dedup and archives on awkward rows, against plain Python."""

import base64
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from cargolume.llm import exact, mixing, rules, warc
from tests.llm import cases

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# --- mixing ---

def targets(sizes, weights=mixing.WEIGHTS, share=mixing.SHARE, epochs=mixing.EPOCHS):
    """Rounds of clamping and sharing out again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    left, open_, out = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > epochs * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = epochs * sizes[s]
            left -= out[s]
        open_ -= over
    return out


def sized(rows):
    return [(d, s, len(WORD.findall(t or ""))) for d, t, s in rows]


def test_mix_awkward_rows(spark):
    df = cases.table(spark)
    got = mixing.mix(df).collect()
    rows = sized([(r.doc_id, r.text, r.source) for r in df.collect()])
    assert sorted(((r.doc_id, r.source, r.size) for r in got), key=repr) == sorted(rows, key=repr)
    total = defaultdict(int)
    for _, s, n in rows:
        total[s] += n
    want = targets(total)
    for r in got:
        assert r.source_size == total[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.times * r.size
    assert mixing.mix(cases.empty(spark)).count() == 0


def test_mix_meets_targets_and_repeats(spark):
    rnd = random.Random(5)
    rows = [(k, " ".join("w" for _ in range(rnd.randint(0, 60))), rnd.choice(["a", "b", "b", "c", "d", "e", "e", "e", None])) for k in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(7)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)
    taken, target = Counter(), {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)
    out = Counter(r.doc_id for r in mixing.repeat_documents(df).collect())
    assert out == Counter({r.doc_id: r.times for r in got if r.times})


# --- quality rules ---

def plain_counts(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {k for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for k in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), len("".join(w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside))


def test_rule_counts(spark):
    rnd = random.Random(3)
    rows = cases.ROWS + [(100 + k, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60))) + rnd.choice(["", "\nx\nx", "\r\n#"])) for k in range(200)]
    df = cases.table(spark, rows)
    got = rules.judged(df).collect()
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got), key=repr) == sorted(
        ((d, *plain_counts(t)) for d, t in rows), key=repr)
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.quality >= 0.5)
    assert rules.judged(cases.empty(spark)).count() == 0


def test_em_finds_the_accuracies():
    """Votes drawn from known accuracies give them back, and the posterior beats the majority."""
    rng = np.random.default_rng(1)
    good = rng.random(40_000) < 0.8
    true = [0.95, 0.9, 0.8, 0.7, 0.65, 0.6]
    votes = np.array([np.where(rng.random(len(good)) < 0.3, 0, np.where((rng.random(len(good)) < a) == good, 1, -1)) for a in true]).T
    patterns = [(*map(int, p), n) for p, n in Counter(map(tuple, votes)).items()]
    share, accuracy = rules.fit(patterns, rounds=100)
    assert share == pytest.approx(0.8, abs=0.03)
    assert accuracy == pytest.approx(true, abs=0.04)
    by_em = np.array([rules.posterior(v, share, accuracy) >= 0.5 for v in votes])
    assert (by_em == good).mean() > ((votes.sum(axis=1) >= 0) == good).mean()


# --- exact dedup ---

def test_exact_groups(spark):
    df = cases.table(spark)
    rows = [(r.doc_id, r.text or "") for r in df.collect()]
    groups = defaultdict(list)
    for d, t in rows:
        groups[t].append(d)
    want = []
    for d, t in rows:
        keep = max((x for x in groups[t] if x is not None), default=None) if len(groups[t]) > 1 else d
        want.append((d, keep, len(groups[t]), d == keep, hashlib.sha256(t.encode()).hexdigest()))
    got = exact.duplicates(df).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got), key=repr) == sorted(want, key=repr)
    assert exact.duplicates(cases.empty(spark)).count() == 0


def test_filters_merge_without_loss():
    rng = np.random.default_rng(2)
    values = rng.integers(-2**63, 2**63 - 1, 3000)
    drawn = [rng.choice(values, 4000) for _ in range(3)]
    whole, merged = exact.QuotientFilter(), exact.QuotientFilter()
    whole.add(np.concatenate(drawn))
    for d in drawn:
        part = exact.QuotientFilter()
        part.add(d)
        for q, (r, c) in part.runs.items():
            merged.merge(q, r, c)
    assert whole.runs.keys() == merged.runs.keys()
    for q, (r, c) in whole.runs.items():
        assert (merged.runs[q][0] == r).all() and (merged.runs[q][1] == c).all()
    counts = Counter(int(v) for d in drawn for v in d)
    found = {(q << 52 | int(x)) - (1 << 64 if q >> 11 else 0): int(n) for q, (r, c) in whole.runs.items() for x, n in zip(r, c)}
    assert found == counts


# --- archives ---

PAGES = [(1, "http://a/x y", "<p>one</p>"), (2, None, None), (3, "http://b/é?q=1&r=%20", "<p>one</p>"), (4, "u", ""), (None, "n", "<p>one</p>"),
         (3, "http://b/again", "<p>one</p>"), (7, "line\r\nbreak: x", "a\r\n\r\nWARC/1.1\r\n\r\n" * 3), (8, "big", "z" * 700_000), (None, None, "alone"), (-5, "m", "alone2")]


def test_archive_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BUNDLE", 300)
    monkeypatch.setattr(warc, "FRAME", 100)
    df = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, payload string").repartition(2)
    got = warc.archive(df).collect()
    top = {}
    for p, _, h in PAGES:
        if p is not None:
            top[h or ""] = max(top.get(h or "", p), p)
    want = []
    for p, u, h in PAGES:
        raw = (h or "").encode()
        first = top.get(h or "")
        u = u and re.sub(r"[\r\n ]", lambda m: f"%{ord(m.group()):02X}", u)
        want.append((p, u, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if p == first else "revisit", None if p == first else first))
    assert sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) == sorted(want, key=repr)
    assert warc.archive(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_bundle_reads_one_record_by_its_index(tmp_path):
    bundle = warc.Bundle()
    for k in range(50):
        bundle.add(warc.name_of(k), warc.record(k, f"http://h/{k}", b"x" * (k * 1000), None, False))
    index = bundle.store(f"file://{tmp_path}").to_pylist()
    raw = (tmp_path / bundle.name).read_bytes()
    assert len(warc.frames(raw)) > 2
    for x in index:
        data = warc.frame_bytes(raw, x["frame"])
        head, block, end = warc.parse(data, x["offset"])
        assert head["WARC-Record-ID"] == x["record_id"] and end - x["offset"] == x["length"]
        assert block.split(b"\r\n\r\n", 1)[1] == b"x" * (warc.page_of(x["record_id"]) * 1000)
    import zstandard

    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 50
