"""Filter interaction audit: what each of five filters removes in every order of applying them.

A document is a mask of the filters that it fails, so the corpus comes down to at most 32 counts per part. A recursive
query extends every prefix of filters by each unused letter, joins the part's mask cells, carries the bits applied so
far, and gives the metrics of the step at each level. Prefixes are shared by the orders that begin with them: 325 steps
a part instead of 600; orders are then read off the prefixes.

Filters (a document fails if): A under 200 words; B fewer than half of its words distinct; C over 2 in 100 code points
in A-Z; D any of `#$%&*|`; E its text equals that of a smaller doc_id anywhere in the table, removed or not.

Defined results: a null text is empty; an empty text has no words, so it fails A, not B, C or D; a null source is the
empty string; rows are counted one by one, also those of equal doc_id, and a row is no copy of a row with its own id; a
null id is never a copy and makes none; a document is good or toxic if any label of its id says so; texts of any length
are taken whole; texts are told apart by SHA-256; an empty table gives no rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cargolume.llm.common import discard, query, stored, table, words

LETTERS = "ABCDE"
COPY = 1 << LETTERS.index("E")
METRICS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"]
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def failing(text: Column, w: Column) -> dict[str, Column]:
    """Of the filters that need only the document itself: letter -> whether it fails."""
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {"A": F.size(w) < 200, "B": 100 * F.size(F.array_distinct(w)) < 50 * F.size(w),
            "C": 100 * capitals > 2 * F.length(text), "D": text.rlike(r"[#$%&*|]")}


def masked(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, good and toxic of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text")).withColumn("w", words(F.col("text")))
    bits = [F.when(fails, F.lit(1 << LETTERS.index(x))).otherwise(F.lit(0)) for x, fails in failing(F.col("text"), F.col("w")).items()]
    alone = stored(rows.select("doc_id", "part", sum(bits[1:], bits[0]).cast("int").alias("alone"), F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")), "audit-rows")
    repeated = alone.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "first")
    copy = F.when(F.col("doc_id") > F.col("first"), F.lit(COPY)).otherwise(F.lit(0))
    told = alone.join(repeated, "digest", "left").select("doc_id", "part", F.col("alone").bitwiseOR(copy).alias("mask"))
    said = labels.groupBy(F.col("doc_id").alias("l_id")).agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    cells = told.join(said, F.col("doc_id") == F.col("l_id"), "left").groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))
    cells = stored(cells, "audit-cells")
    discard(alone)
    return cells


def counted(value: str, condition: str) -> str:
    """SQL: the sum of `value` over the part's cells x for which the condition on x.mask holds."""
    return f"aggregate(c.cells, 0L, (a, x) -> a + if({condition}, x.{value}, 0L))"


def enumeration() -> str:
    """The recursive query over {cells}, a row (part, cells) per part."""
    here = "(x.mask & s.applied) = 0 AND (x.mask & s.bit) <> 0"
    metrics = {"kept": counted("n", "(x.mask & (s.applied | s.bit)) = 0"), "removed": counted("n", here),
               "redundant": counted("n", "(x.mask & s.applied) <> 0 AND (x.mask & s.bit) <> 0"),
               "unique_fails": counted("n", "x.mask = s.bit"), "good_lost": counted("good", here), "toxic_lost": counted("toxic", here)}
    letters = ", ".join(f"named_struct('letter', '{x}', 'bit', {1 << k})" for k, x in enumerate(LETTERS))
    return f"""
WITH RECURSIVE steps(part, prefix, applied, step, {", ".join(METRICS)}) AS (
  SELECT part, '', 0, 0, {", ".join("0L" for _ in METRICS)} FROM {{cells}}
  UNION ALL
  SELECT s.part, concat(s.prefix, s.letter), s.applied | s.bit, s.step + 1, {", ".join(metrics[m] for m in METRICS)}
  FROM (SELECT part, prefix, applied, step, l.letter, l.bit FROM (
      SELECT part, prefix, applied, step, explode(filter(array({letters}), x -> (applied & x.bit) = 0)) AS l
      FROM steps WHERE step < {len(LETTERS)})) s
  JOIN {{cells}} c ON s.part = c.part)
SELECT part, prefix, step, {", ".join(METRICS)} FROM steps WHERE step > 0"""


def prefix_steps(cells: DataFrame) -> DataFrame:
    """part, prefix, step and the metrics of the prefix's last filter, stored: a row for each of the 325 prefixes of a part."""
    spark = cells.sparkSession
    packed = stored(cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells")), "audit-parts")  # 32 at most
    before = spark.conf.get(ROW_LIMIT)
    spark.conf.set(ROW_LIMIT, "-1")  # the rows are 326 a part, however many parts there are
    try:
        return stored(spark.sql(enumeration(), cells=packed), "audit-steps")
    finally:
        spark.conf.set(ROW_LIMIT, before)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, filter_order and step: the METRICS of that step, and `shapley`, the filter's removals over all orders."""
    steps = prefix_steps(masked(docs, labels))
    orders = steps.where(F.col("step") == len(LETTERS)).select(
        F.col("part").alias("o_part"), F.col("prefix").alias("filter_order"), F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("o_step"))
    begun = F.substring(F.col("filter_order"), F.lit(1), F.col("o_step"))
    rows = orders.join(steps, (F.col("o_part") == F.col("part")) & (begun == F.col("prefix")))
    letter = F.substring(F.col("prefix"), -1, 1)
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", letter))).select("part", "filter_order", "step", *METRICS, "shapley")


SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (SELECT text AS f_text, min(doc_id) AS first FROM d GROUP BY text),
l AS (SELECT doc_id AS l_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
  FROM d JOIN f ON text = f_text LEFT JOIN l ON doc_id = l_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM m GROUP BY part, mask),
x(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o(filter_order, used) AS (SELECT '', 0 UNION ALL SELECT filter_order || letter, used | bit FROM o JOIN x ON used & bit = 0),
s AS (SELECT filter_order, CAST(k AS INTEGER) AS step, (SELECT bit FROM x WHERE letter = substr(filter_order, k, 1)) AS bit,
    (SELECT coalesce(sum(bit), 0) FROM x WHERE contains(substr(filter_order, 1, k - 1), letter)) AS applied
  FROM o, range(1, 6) r(k) WHERE length(filter_order) = 5),
r AS (SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER (mask & CAST(applied AS INTEGER) = 0 AND mask & bit = 0), 0) AS kept,
    coalesce(sum(n) FILTER (mask & CAST(applied AS INTEGER) = 0 AND mask & bit <> 0), 0) AS removed,
    coalesce(sum(n) FILTER (mask & CAST(applied AS INTEGER) <> 0 AND mask & bit <> 0), 0) AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
    coalesce(sum(good) FILTER (mask & CAST(applied AS INTEGER) = 0 AND mask & bit <> 0), 0) AS good_lost,
    coalesce(sum(toxic) FILTER (mask & CAST(applied AS INTEGER) = 0 AND mask & bit <> 0), 0) AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM r
"""


@query("op12_filter_interaction_audit", SQL)
def op12_filter_interaction_audit(spark, folder):
    return audit(table(spark, folder, "documents", "doc_id", "source", "text"), table(spark, folder, "labels", "doc_id", "quality", "toxic"))
