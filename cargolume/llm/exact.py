"""Exact dedup by counting quotient filters.

Each partition of fingerprints (64-bit hashes of whole texts) becomes a counting quotient filter: the quotient (top
bits) names a run, and a run holds its remainders in order with their counts. Filters merge losslessly: the sorted
remainders of equal quotients are merged and counts added. A fingerprint seen a thousand times in a partition
travels as one entry, so copies cause no skew. Only texts whose fingerprint counts above one are compared, byte by
byte (grouped by the text itself, reduced before the shuffle); all others are known to be unique.

Defined results: a null text is an empty text; of equal texts the row with the largest doc_id stays, null ids count
as smallest; rows with equal doc_id and text are one document; an empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolume.llm.common import query, table

QUOTIENT_BITS = 12


def merge_runs(remainders: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """One run from several: remainders in order, counts of equal ones added."""
    r, c = np.concatenate(remainders), np.concatenate(counts)
    order = np.argsort(r, kind="stable")
    r, c = r[order], c[order]
    starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]]) if len(r) else np.zeros(0, np.int64)
    return r[starts], np.add.reduceat(c, starts) if len(r) else c


class QuotientFilter:
    """Runs by quotient; each run is (remainders in order, their counts)."""

    def __init__(self, bits=QUOTIENT_BITS):
        self.shift = np.uint64(64 - bits)
        self.low = np.uint64((1 << (64 - bits)) - 1)
        self.runs: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add(self, fingerprints: np.ndarray):
        values, counts = np.unique(fingerprints.astype(np.int64).view(np.uint64), return_counts=True)
        quotients = (values >> self.shift).astype(np.int64)
        cuts = np.flatnonzero(np.r_[True, quotients[1:] != quotients[:-1], True]) if len(values) else []
        for a, b in zip(cuts[:-1], cuts[1:]):
            self.merge(int(quotients[a]), values[a:b] & self.low, counts[a:b].astype(np.int64))

    def merge(self, quotient: int, remainders: np.ndarray, counts: np.ndarray):
        old = self.runs.get(quotient)
        self.runs[quotient] = (remainders, counts) if old is None else merge_runs([old[0], remainders], [old[1], counts])


RUNS = pa.schema([("quotient", pa.int32()), ("remainders", pa.binary()), ("counts", pa.binary())])


def build_filters(bits):
    """Arrow batches of one column `fp` -> the partition's filter, one row per run."""

    def build(batches):
        cqf = QuotientFilter(bits)
        for b in batches:
            cqf.add(b.column(0).to_numpy(zero_copy_only=False))
        runs = sorted(cqf.runs.items())
        for k in range(0, len(runs), 256):
            part = runs[k:k + 256]
            yield pa.RecordBatch.from_pydict({
                "quotient": [q for q, _ in part], "remainders": [r.tobytes() for _, (r, _) in part],
                "counts": [c.tobytes() for _, (_, c) in part]}, schema=RUNS)
    return build


def repeated_fingerprints(bits):
    """Runs ordered by quotient -> merged, then the fingerprints that count above one."""

    def merge(batches):
        now, remainders, counts = None, [], []

        def flush():
            r, c = merge_runs(remainders, counts)
            fp = (r[c > 1] | (np.uint64(now) << np.uint64(64 - bits))).view(np.int64)
            return pa.RecordBatch.from_pydict({"fp": pa.array(fp, pa.int64())})

        for b in batches:
            for q, r, c in zip(*(x.to_pylist() for x in b.columns)):
                if q != now and now is not None:
                    yield flush()
                    remainders, counts = [], []
                now = q
                remainders.append(np.frombuffer(r, np.uint64))
                counts.append(np.frombuffer(c, np.int64))
        if now is not None:
            yield flush()
    return merge


def repeated(fingerprints: DataFrame, bits=QUOTIENT_BITS) -> DataFrame:
    """Of a frame with one long column, the values (as `fp`) that occur more than once."""
    runs = fingerprints.mapInArrow(build_filters(bits), "quotient int, remainders binary, counts binary")
    parts = runs.repartition("quotient").sortWithinPartitions("quotient")
    return parts.mapInArrow(repeated_fingerprints(bits), "fp long")


def duplicates(docs: DataFrame, bits=QUOTIENT_BITS) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256."""
    d = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    d = d.withColumn("fp", F.xxhash64("text"))
    routed = d.join(repeated(d.select("fp"), bits), "fp", "left_semi")
    groups = routed.groupBy("text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    groups = groups.select("keep_id", "group_size", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))
    rows = d.select("doc_id", F.sha2(F.encode("text", "UTF-8"), 256).alias("text_sha256"))
    return rows.join(groups, "text_sha256", "left").select(
        "doc_id", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256")


SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY h) AS kept, h AS text_sha256
FROM (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents)
"""


@query("op3_exact_dedup", SQL)
def op3_exact_dedup(spark, folder):
    return duplicates(table(spark, folder, "documents", "doc_id", "text"))
