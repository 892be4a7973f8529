"""Line dedup against all pairs on small corpora."""

import hashlib
import random
import re

import pytest

from cargolume.llm.lines import NEAR_WORDS, without_repeated_lines

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, place string"


def near(a, b):
    n, m = len(a), len(b)
    if max(n, m) < NEAR_WORDS or abs(n - m) > 1:
        return False
    if n == m:
        return sum(x != y for x, y in zip(a, b)) <= 1
    long, short = (a, b) if n > m else (b, a)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute(rows):
    """The same by comparing every line with every earlier place."""
    lines = [((d is not None, d or 0, k), tuple(x.split())) for d, t in rows for k, x in enumerate((t or "").split("\n")) if x.split()]
    gone = {p for p, w in lines if any(q < p and (w == v or near(w, v)) for q, v in lines)}
    out = []
    for d, t in rows:
        kept = [x for k, x in enumerate(t.split("\n")) if (d is not None, d or 0, k) not in gone] if t is not None else None
        out.append((d, None if t is None else "\n".join(kept)))
    return sorted(out, key=repr)


def corpus(seed):
    rnd = random.Random(seed)
    base = [[rnd.choice("abcdefgh") + str(rnd.randint(0, 30)) for _ in range(rnd.choice([1, 3, 7, 8, 9, 15, 16, 17, 31, 32, 33, 70]))] for _ in range(25)]
    rows = []
    for d in range(60):
        lines = []
        for _ in range(rnd.randint(0, 5)):
            w = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                k, kind = rnd.randrange(len(w) + 1), rnd.randrange(3)
                w[k:k + (kind != 0)] = [] if kind == 1 else ["n" + str(rnd.randint(0, 3))]
            lines.append(rnd.choice([" ", "  "]).join(w))
        rows.append((d, "\n".join(lines)))
    return rows + [(900, None), (901, ""), (902, "\n \n"), (None, rows[3][1])]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(d, t, "en", "s", 1, "p") for d, t in rows], SCHEMA)
    got = without_repeated_lines(df)
    assert got.columns[:6] == df.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=repr) == brute(rows)


def test_one_common_template(spark):
    """All lines lack the same word: the earliest stays, whatever their number."""
    rows = [(d, f"one two three four five {d} seven eight nine") for d in range(300)]
    got = without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r.doc_id for r in got.where("text <> ''").collect()] == [0]


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "a b c"), (1, "a b c"), (2, "a b c\nd")]
    got = without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text, r.l_lines, r.l_removed) for r in got) == [(1, "a b c", 1, 0), (1, "a b c", 1, 0), (2, "d", 2, 1)]
    assert without_repeated_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_very_long_line(spark):
    words = [str(k * 7919 % 100_003) for k in range(30_000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:20_000] + words[20_001:])), (3, " ".join(words[:-2]))]
    got = without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.l_removed) for r in got) == [(1, 0), (2, 1), (3, 0)]
    assert hashlib.sha256(sorted(got)[0].text.encode()).hexdigest() == hashlib.sha256(" ".join(words).encode()).hexdigest()


def test_white_space_of_any_kind_parts_words(spark):
    """Equal words in lines with tabs, runs of spaces and blank ends are equal lines; no-break spaces belong to words."""
    texts = ["a b c d e f g h i", " a  b c\td e f g\x0bh i\r", "a b c d e f g h  x ", "\t \x0c", "", "a\u00a0b c", "a b c", "b  c d e f g h i"]
    rows = [(k, t) for k, t in enumerate(texts)] + [(50, "\n".join(texts))]
    got = without_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    plain = lambda t: t.replace("\u00a0", "\u2581")  # noqa: E731  (str.split takes it for a space)
    assert sorted(((r.doc_id, plain(r.text)) for r in got.collect()), key=repr) == brute([(d, plain(t)) for d, t in rows])


def test_a_text_is_cut_once(spark):
    """Not again, inside a lambda, for each line that stays."""
    rows = spark.createDataFrame([(1, "a b c\nd e f"), (2, "a b c")], "doc_id long, text string")
    plan = without_repeated_lines(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" in plan and not re.search(r"split\([^()]*-1\)\[lambda", plan)
