"""Structured Streaming jobs: continuous scoring, drift counts and measures by event time."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cargolume.operators.contracts import physical_split, valid_rows
from cargolume.sources.writers import assessments, audit_rows


def run_to_end(df: DataFrame, path: str, checkpoint: str, format="parquet") -> StreamingQuery:
    """Append everything that is there now and stop; offsets and state survive in the checkpoint folder."""
    query = df.writeStream.format(format).outputMode("append").option("path", path).option(
        "checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def audit_stream(events: DataFrame, score, **provenance) -> DataFrame:
    """Valid rows, scored and flattened to the audit record; `run_audit` keeps each shipment once.

    `score` adds Delay_Risk_Probability; it may be a fitted model's transform or an expression. Impossible rows leave
    here: one of them must not use up the id of a corrected row.
    """
    return audit_rows(assessments(score(valid_rows(physical_split(events, max_weight=100.0))), **provenance))


def run_audit(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there now, once per shipment, however late it comes.

    Ids are checked against the log itself, not against a watermark: a late decision is kept, and a batch that is
    repeated after a failure adds nothing.
    """
    spark = rows.sparkSession
    spark.createDataFrame([], rows.schema).write.mode("ignore").parquet(path)

    def append(batch: DataFrame, _):
        known = batch.sparkSession.read.schema(rows.schema).parquet(path).select("shipment_id")
        batch.dropDuplicates(["shipment_id"]).join(known, "shipment_id", "left_anti").select(*rows.columns).write.mode("append").parquet(path)

    query = rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def bin_index(column: str, edges: list[float]):
    """0..len(edges): how many edges lie at or below the value."""
    out = F.lit(0)
    for e in edges:
        out = out + (F.col(column) >= e).cast("int")
    return out.alias("bin")


def bin_counts(df: DataFrame, column: str, edges: list[float], event_time="event_time", width="30 days",
               delay: str | None = None) -> DataFrame:
    """Rows per window and bin; with a delay as a stream, without it as the batch twin."""
    if delay:
        df = df.withWatermark(event_time, delay)
    return df.groupBy(F.window(event_time, width).alias("w"), bin_index(column, edges)).agg(
        F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "bin", "n")


def drift(counts: DataFrame, expected: list[float], floor=1e-4) -> DataFrame:
    """PSI and KS distance per window against the training shares of the bins.

    `counts` has at most one row per window and bin.
    """
    k = len(expected)
    per = counts.groupBy("window_start", "window_end").agg(
        F.sum("n").alias("rows"), *[F.sum(F.when(F.col("bin") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in range(k)])
    psi, ks, upto, base = F.lit(0.0), F.lit(0.0), F.lit(0.0), 0.0
    for i, e in enumerate(expected):
        share = F.col(f"n{i}") / F.col("rows")
        a, b = F.greatest(share, F.lit(floor)), F.lit(max(e, floor))
        psi = psi + (a - b) * F.ln(a / b)
        upto, base = upto + share, base + e
        ks = F.greatest(ks, F.abs(upto - base))
    return per.select("window_start", "window_end", "rows", psi.alias("psi"), ks.alias("ks"))


def training_shares(df: DataFrame, column: str, edges: list[float]) -> list[float]:
    """Share of every bin in the training rows: a handful of numbers."""
    index = bin_index(column, edges)
    got = {r["bin"]: r["n"] for r in df.groupBy(index).agg(F.count("*").alias("n")).collect()}
    total = sum(got.values()) or 1
    return [got.get(i, 0) / total for i in range(len(edges) + 1)]


def window_measures(df: DataFrame, event_time="event_time", width="30 days", delay: str | None = None) -> DataFrame:
    """The report measures per tumbling window."""
    if delay:
        df = df.withWatermark(event_time, delay)
    high = F.count_if(F.col("Risk_Level") == "High Risk")
    return df.groupBy(F.window(event_time, width).alias("w")).agg(
        F.count("*").alias("shipments"), (F.sum("CO2_Emission_kg") / 1000.0).alias("co2_tons"),
        (F.sum("CO2_Emission_kg") / 1000.0 * 50.0).alias("carbon_tax"), F.avg("Actual_Delay_Days").alias("average_delay_days"),
        (high / F.count("*")).alias("high_risk_rate")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "shipments", "co2_tons", "carbon_tax",
        "average_delay_days", "high_risk_rate")
