"""Mixing sources to target weights by capped water-filling.

Every source gets words in proportion to its weight. A source may be used at most `epochs` times; what it cannot
take is shared out again among the others by weight, until none is above its limit. The fixed point of those
rounds is `least(limit, level * weight)`: with the sources in order of limit / weight, the rounds clamp a prefix,
and the level after the last round is the largest of the levels that clamping 0, 1, 2, ... sources would give.

A target of r times the source's size takes every document floor(r) times, and some documents once more. Those
are the documents with the smallest seeded hashes, up to the cut at which their words come nearest to the rest
of the target. Cuts are found on sums per (source, hash cell), so no source is sorted or gathered, however large.

Defined results: a null text has size 0; a null source is a source of its own, last in order; rows with equal
doc_id get the same draw; an empty table gives no rows; a source without words gets target 0.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cargolume.llm.common import query, stored, table, word_count

WEIGHTS = (5, 2, 1)  # by order of the source's name, repeating
SHARE = 1.5          # of all words
EPOCHS = 2           # most uses of one document
SEED = "mix-1"
CELL_DIGITS = 3      # hex digits of the hash: 4,096 cells per source


def hash_cell(seed=SEED):
    return F.substring(F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(seed))),
                       1, CELL_DIGITS)


def measured(docs: DataFrame, seed=SEED) -> DataFrame:
    """doc_id, source, size and hash cell of every document: all that the mix needs from the texts."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), hash_cell(seed).alias("cell"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS) -> DataFrame:
    """source, source_size, weight and target from one row (source, source_size) per source.

    The windows hold one row per source name, never documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    order = Window.orderBy("per_weight", "place")
    before, onward = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sizes.withColumn("place", F.row_number().over(by_name)).select(
        "*", F.get(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights)).alias("weight"),
        (F.col("source_size") * epochs).alias("limit")
    ).withColumn("per_weight", F.col("limit") / F.col("weight"))
    levels = ranked.withColumn(
        "level", (share * F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
        / F.sum("weight").over(onward)
    ).withColumn("level", F.max("level").over(everything))
    return levels.select("source", "source_size", "weight",
                         F.least(F.col("limit").cast("double"), F.col("level") * F.col("weight")).alias("target"))


def source_cuts(sizes: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS) -> DataFrame:
    """Per source: t_source, source_size, target, `whole` uses of every document, and the last cell used once more."""
    cells = sizes.groupBy("source", "cell").agg(F.sum("size").alias("words"))
    targets = source_targets(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, epochs)
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target",
                       F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0)).alias("whole"))
    upto = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    return (
        cells.withColumn("middle", F.sum("words").over(upto) - F.col("words") / 2)
        .join(t, F.col("source").eqNullSafe(F.col("t_source")))
        .groupBy("t_source", "source_size", "target", "whole")
        .agg(F.max(F.when((F.col("middle") <= rest) & (F.col("whole") < epochs), F.col("cell"))).alias("cut"))
    )


def uses():
    return (F.col("whole") + F.coalesce(F.col("cell") <= F.col("cut"), F.lit(False)).cast("long")).cast("long")


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS, seed=SEED) -> DataFrame:
    """Per document: doc_id, source, size, source_size, target, times, taken (words, repeats counted)."""
    sizes = stored(measured(docs, seed), "mix-sizes")
    cuts = source_cuts(sizes, weights, share, epochs)
    return sizes.join(cuts, F.col("source").eqNullSafe(F.col("t_source"))).select(
        "doc_id", "source", "size", "source_size", "target", uses().alias("times"), (F.col("size") * uses()).alias("taken"))


def repeat_documents(docs: DataFrame, weights=WEIGHTS, share=SHARE, epochs=EPOCHS, seed=SEED) -> DataFrame:
    """The mix itself: every row of `docs`, with all its columns, as often as the mix uses it."""
    sizes = stored(measured(docs, seed), "mix-sizes")
    cuts = source_cuts(sizes, weights, share, epochs).select("t_source", "whole", "cut")
    row = docs.select("source", hash_cell(seed).alias("cell"), F.struct(*docs.columns).alias("row"))
    used = row.join(cuts, F.col("source").eqNullSafe(F.col("t_source")))
    copies = F.array_repeat(F.col("row"), uses().cast("int"))
    return used.select(F.explode(copies).alias("row")).select("row.*")


SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    substr(md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), 'null'), 'mix-1')), 1, 3) AS cell
  FROM documents),
cells AS (SELECT source, cell, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY source, cell),
s AS (SELECT source, CAST(sum(words) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place FROM cells GROUP BY source),
w AS (SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2 * source_size AS lim FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY CAST(lim AS DOUBLE) / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY CAST(lim AS DOUBLE) / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, least(CAST(lim AS DOUBLE), (max(level) OVER ()) * weight) AS target FROM l),
f AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS whole FROM t),
m AS (SELECT source, cell, sum(words) OVER (PARTITION BY source ORDER BY cell ROWS UNBOUNDED PRECEDING) - words / 2.0::DOUBLE AS middle FROM cells),
c AS (SELECT f.source, source_size, target, whole, max(CASE WHEN middle <= target - whole * source_size THEN cell END) AS cut
  FROM m JOIN f ON m.source IS NOT DISTINCT FROM f.source GROUP BY ALL)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN whole < 2 AND cell <= cut THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
"""


@query("op10_mixing", SQL)
def op10_mixing(spark, folder):
    docs = table(spark, folder, "documents", "doc_id", "source", "text")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")
