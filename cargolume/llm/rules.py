"""Quality rules by weak supervision: rules vote, EM estimates how accurate each is, the posterior decides.

Every rule looks at counts of a document and votes good (1), bad (-1) or abstains (0). Votes are reduced to counts
per vote pattern (at most 3^rules rows, whatever the corpus), on which expectation-maximisation fits the share of
good documents and each rule's accuracy when it votes. A document is kept if its posterior probability of being
good is at least `KEEP`.

Repeated words need no shuffle: a document's five-word windows are hashed (64 bits) into one array. Only where
that array has equal entries are they sorted, and the union of the repeated windows' words counted.

Defined results: null and empty texts have no words, fail the base rule and are not kept; an empty table gives no
rows; rows with equal doc_id are judged one by one.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolume.llm.common import WORD, query, stored, table, words

MIN_WORDS = 10
REPEAT_PERCENT = 20
WINDOW = 5
KEEP = 0.5
ROUNDS = 20
PRIOR, ACCURACY = 0.9, 0.8            # where EM starts
LOWEST, HIGHEST = 0.55, 0.99          # a rule is never taken for worse than chance or for perfect

# Rule: (vote bad if, vote good if), over the counts of `counted`; the same text is valid Spark SQL and ANSI SQL.
RULES = {
    "length": ("n_words < 10", "n_words >= 40"),
    "word_length": ("2 * word_chars < 5 * n_words OR word_chars > 14 * n_words", "word_chars >= 3 * n_words AND word_chars <= 10 * n_words"),
    "symbols": ("10 * n_symbols > n_words", "100 * n_symbols <= 2 * n_words"),
    "lines": ("10 * n_dup_lines > 3 * n_lines", "n_dup_lines = 0 AND n_lines >= 2"),
    "repeats": ("100 * n_repeat_words > 20 * n_words", "100 * n_repeat_words <= 5 * n_words"),
    "capitals": ("2 * n_capitals > word_chars", "5 * n_capitals <= word_chars"),
}


def with_repeated_words(d: DataFrame) -> DataFrame:
    """Adds n_repeat_words, the words inside five-word windows that occur at least twice, to a frame with words `w`.

    Each step is a column of its own, so that no array is made again for each of its elements.
    """
    n, h, at, starts = F.size("w"), F.col("h"), F.col("at"), F.col("starts")
    hashes = F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(*[F.get(F.col("w"), i + (k - 1)) for k in range(WINDOW)]))
    d = d.withColumn("h", F.when(n >= WINDOW, hashes))
    again = F.size(F.array_distinct(h)) < F.size(h)
    d = d.withColumn("at", F.when(again, F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    twice = F.filter(at, lambda a, k: (F.get(at, k - 1)["x"] == a["x"]) | (F.get(at, k + 1)["x"] == a["x"]))
    d = d.withColumn("starts", F.sort_array(F.transform(twice, lambda a: a["i"])))
    lengths = F.transform(starts, lambda s, k: F.least(F.lit(WINDOW), F.get(starts, k + 1) - s))
    return d.withColumn("n_repeat_words", F.coalesce(F.aggregate(lengths, F.lit(0).cast("long"), lambda x, y: x + y), F.lit(0))).drop("h", "at", "starts")


def counted(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that rules look at."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    d = docs.select("doc_id", text.alias("text"), words(F.col("text")).alias("w"), lines.alias("lines"))
    return with_repeated_words(d).select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words")


def voted(counts: DataFrame) -> DataFrame:
    votes = [F.when(F.expr(bad), -1).when(F.expr(good), 1).otherwise(0).alias(f"v_{name}") for name, (bad, good) in RULES.items()]
    return counts.select("*", *votes)


def fit(patterns: list[tuple], rounds=ROUNDS) -> tuple[float, list[float]]:
    """EM on (votes..., n) rows, one per pattern: the share of good documents and each rule's accuracy."""
    share, accuracy = PRIOR, [ACCURACY] * len(RULES)
    for _ in range(rounds):
        good = [posterior(p[:-1], share, accuracy) for p in patterns]
        total = sum(p[-1] for p in patterns)
        if total == 0:
            break
        share = min(max(sum(g * p[-1] for g, p in zip(good, patterns)) / total, 0.01), 0.99)
        for j in range(len(RULES)):
            cast = sum(p[-1] for p in patterns if p[j])
            right = sum((g if p[j] > 0 else 1 - g) * p[-1] for g, p in zip(good, patterns) if p[j])
            accuracy[j] = min(max(right / cast if cast else ACCURACY, LOWEST), HIGHEST)
    return share, accuracy


def posterior(votes, share, accuracy) -> float:
    up, down = share, 1 - share
    for v, a in zip(votes, accuracy):
        if v:
            up, down = (up * a, down * (1 - a)) if v > 0 else (up * (1 - a), down * a)
    return up / (up + down)


def judged(docs: DataFrame) -> DataFrame:
    """The counts of every document with votes, `quality` (posterior), base_failed and kept."""
    votes = stored(voted(counted(docs)), "rule-votes")
    names = [f"v_{n}" for n in RULES]
    patterns = [tuple(r) for r in votes.groupBy(*names).count().collect()]
    share, accuracy = fit(sorted(patterns))
    sides = []
    for prior, hit, miss in ((share, accuracy, [1 - a for a in accuracy]), (1 - share, [1 - a for a in accuracy], accuracy)):
        factors = [F.when(F.col(n) > 0, h).when(F.col(n) < 0, m).otherwise(1.0) for n, h, m in zip(names, hit, miss)]
        sides.append(reduce(lambda a, b: a * b, factors, F.lit(prior)))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return votes.select("*", (sides[0] / (sides[0] + sides[1])).alias("quality"), failed.alias("base_failed")).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= KEEP))


def _sql() -> str:
    """The counts, then the rounds of EM one after the other, in SQL."""
    names = [f"v_{n}" for n in RULES]
    votes = ",\n".join(f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END AS v_{n}" for n, (bad, good) in RULES.items())

    def side(sign):
        own = "m.share" if sign > 0 else "1 - m.share"
        return " * ".join([f"({own})"] + [f"CASE WHEN {n} = {sign} THEN m.a{j} WHEN {n} = {-sign} THEN 1 - m.a{j} ELSE 1 END" for j, n in enumerate(names)])

    steps = [f"m0 AS MATERIALIZED (SELECT {PRIOR}::DOUBLE AS share, " + ", ".join(f"{ACCURACY}::DOUBLE AS a{j}" for j in range(len(names))) + ")"]
    for r in range(ROUNDS):
        rules = ", ".join(
            f"least(greatest(coalesce(sum(CASE {n} WHEN 1 THEN g WHEN -1 THEN 1 - g END * n) / sum(CASE WHEN {n} <> 0 THEN n END), {ACCURACY}), {LOWEST}), {HIGHEST})::DOUBLE AS a{j}"
            for j, n in enumerate(names))
        steps.append(f"m{r + 1} AS MATERIALIZED (SELECT least(greatest(sum(g * n) / sum(n), 0.01), 0.99)::DOUBLE AS share, {rules} FROM (SELECT p.*, {side(1)} / ({side(1)} + {side(-1)}) AS g FROM p, m{r} m))")
    return rf"""
WITH w AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(w, i, i + 4)) AS n FROM
    (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM w WHERE len(w) >= 5)),
r AS (SELECT doc_id, count(DISTINCT k) AS n_repeat_words FROM (SELECT doc_id, unnest(generate_series(i, i + 4)) AS k FROM g WHERE n >= 2) GROUP BY doc_id),
c AS MATERIALIZED (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(regexp_extract_all(text, '\p{{Lu}}')) AS BIGINT) AS n_capitals,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
v AS MATERIALIZED (SELECT *, {votes} FROM c),
p AS MATERIALIZED (SELECT {", ".join(names)}, count(*) AS n FROM v GROUP BY ALL),
{", ".join(steps)},
f AS (SELECT v.*, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEAT_PERCENT} * n_words AS base_failed, {side(1)} / ({side(1)} + {side(-1)}) AS q FROM v, m{ROUNDS} m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND q >= {KEEP} AS kept FROM f
"""


@query("op6_quality_rules", _sql())
def op6_quality_rules(spark, folder):
    return judged(table(spark, folder, "documents", "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
