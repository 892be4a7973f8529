"""Near duplicates against all pairs."""

import random
import re

import pytest

from cargolume.llm import near


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), d), d)
    return sorted((d, len(sets[i]), least[root(i)]) for i, (d, _) in enumerate(rows))


def corpus(seed, n=150):
    rnd = random.Random(seed)
    word = lambda: rnd.choice("abcdefghij") + str(rnd.randint(0, 60))
    passage = " ".join(word() for _ in range(40))
    bases = [[word() for _ in range(rnd.choice([3, 5, 8, 40, 90, 200]))] for _ in range(12)]
    rows = []
    for d in range(n):
        w = list(rnd.choice(bases)) if rnd.random() < 0.7 else [word() for _ in range(rnd.randint(0, 80))]
        for _ in range(rnd.choice([0, 0, 1, 2, 4, 8])):
            k = rnd.randrange(len(w) + 1)
            w[k:k + rnd.randint(0, 2)] = [word()]
        text = rnd.choice([" ", "\n", "\t "]).join(w)
        if rnd.random() < 0.3:
            text += " " + passage
        rows.append((d * 3 % 1000, text.upper() if rnd.random() < 0.1 else text))
    return rows + [(5000, ""), (5001, None), (5002, " \n"), (5003, "one two"), (5004, "One\ttwo")]


@pytest.mark.parametrize("seed,tile", [(1, 512), (2, 8)])
def test_against_all_pairs(spark, monkeypatch, seed, tile):
    """A small TILE cuts buckets into blocks; the result is the same."""
    monkeypatch.setattr(near, "TILE", tile)
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, node string")
    got = near.near_groups(df).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)


def test_empty_table(spark):
    assert near.near_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chain_links_through_the_middle(spark):
    w = [f"w{k}" for k in range(64)]
    rows = [(k + 1, " ".join(w[:60 - 4 * k] if k == 0 else w[4 * k:60 + 4 * k] if k == 1 else w[8:])) for k in range(3)]
    got = near.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)


def named(text_rows):
    """component_id by the rule for null ids: the smallest id of the group, null only where all are null."""
    sets = [shingle_set(t) for _, t in text_rows]
    keys = brute([(k, t) for k, (_, t) in enumerate(text_rows)])
    of = {k: c for k, _, c in keys}
    out = []
    for k, (d, _) in enumerate(text_rows):
        ids = [e for q, (e, _) in enumerate(text_rows) if of[q] == of[k] and e is not None]
        out.append((d, len(sets[k]), (min(ids) if ids else None) if sets[k] else d))
    return sorted(out, key=repr)


def test_null_and_repeated_ids_and_long_texts(spark):
    long = " ".join(f"w{k * 7919 % 30011}" for k in range(20_000))
    words = [f"v{k}" for k in range(60)]
    rows = [(None, " ".join(words)), (None, " ".join(words[:58])), (7, " ".join(words[1:])), (7, " ".join(words[:5])), (7, "other text here"), (None, "alone with null id"),
            (None, "twin null"), (None, "twin null"), (1, long), (2, long + " and more"), (3, long[: len(long) // 2]), (7, " ".join(words)), (None, None), (7, "")]
    got = near.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr) == named(rows)


@pytest.mark.parametrize("tile", [4, 512])
def test_texts_just_below_the_bound(spark, monkeypatch, tile):
    """They share many tokens and link with nothing; the bitmaps keep nearly all of their pairs out."""
    monkeypatch.setattr(near, "TILE", tile)
    seen, plain = [], near.tile_pairs

    def pairs(*a):
        made = plain(*a)
        seen.extend(map(tuple, made.collect()))
        return made

    monkeypatch.setattr(near, "tile_pairs", pairs)
    rnd = random.Random(3)
    base = [f"b{k}" for k in range(100)]
    rows = [(d, " ".join(base[:70] + [f"x{d}y{rnd.random()}" for _ in range(30)])) for d in range(40)] + [(100 + d, " ".join(base[d:])) for d in range(10)]
    got = near.near_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(rows)
    assert len(seen) == len(set(seen)) < 40


def test_bitmaps_bound_the_overlap():
    rnd = random.Random(8)
    hashes = near.WordHashes()
    for _ in range(200):
        base = [f"w{rnd.randint(0, 400)}" for _ in range(rnd.choice([6, 40, 300, 700]))]
        other = [w for w in base if rnd.random() < rnd.choice([0.9, 0.99])]
        x, y = (near.shingles(" ".join(w), hashes) for w in (base, other))
        if len(x) and len(y):
            both = len(set(x.tolist()) & set(y.tolist()))
            if 100 * both >= 75 * (len(x) + len(y) - both):
                bits = [int.from_bytes(near.bitmap(s), "little") for s in (x, y)]
                assert near.may_link(len(x), bits[0], len(y), bits[1])
