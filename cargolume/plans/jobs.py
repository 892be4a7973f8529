"""End-to-end jobs: star schema, training stages, batch scoring and allocation."""

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.functions.formulas import require_known_categories
from cargolume.operators import allocation, calibrate, contracts, fingerprint, metrics, model, panels, star
from cargolume.schemas import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES, RAW_COLUMNS, SCORED_COLUMNS
from cargolume.session import materialise
from cargolume.sources import readers, writers

log = logging.getLogger(__name__)
STAGES = ("evaluate", "score", "train", "all")


def build_star(raw: DataFrame, check=True) -> dict[str, DataFrame]:
    """The four tables, checked before anything is written."""
    raw = materialise(star.require_columns(raw, RAW_COLUMNS), "raw")
    tables = {"fact": star.fact_shipments(raw), "dim_vendor": star.dim_vendor(raw), "dim_route": star.dim_route(raw),
              "dim_date": star.dim_date(raw)}
    if check:
        contracts.require_integrity(contracts.star_integrity(
            tables["fact"], tables["dim_vendor"], tables["dim_route"], tables["dim_date"]))
    return tables


def run_etl(spark: SparkSession, raw_path: str, out: str, rules: list | None = None) -> dict[str, DataFrame]:
    """Read, check and write. Rows with unreadable values go to `quarantine` and are counted; a broken rule stops the load."""
    bad = readers.quarantined(spark, raw_path)
    bad.write.mode("overwrite").parquet(f"{out}/quarantine")
    kept_out = spark.read.schema(bad.schema).parquet(f"{out}/quarantine").count()
    if kept_out:
        log.warning("%d rows of %s hold unreadable values; they are in %s/quarantine", kept_out, raw_path, out)
    raw = readers.load_raw(spark, raw_path)
    contracts.require_clean(contracts.contract_report(raw, "raw_shipments", contracts.raw_rules() if rules is None else rules, unique="Shipment_ID"))
    tables = build_star(raw)
    writers.write_star(tables, out)
    return readers.load_star(spark, out)


def stored_scores(scored: DataFrame) -> DataFrame:
    """The scored table keeps two decimals and tiers the rounded value."""
    from cargolume.functions import formulas as fx

    return scored.withColumn("Delay_Risk_Probability", fx.stored_probability("probability")).withColumn(
        "Risk_Level", fx.risk_tier("Delay_Risk_Probability"))


def run_training(tables: dict[str, DataFrame], folder: str, stage="all",
                 settings: model.ModelSettings = model.ModelSettings(), repeats=20) -> dict:
    """Measure, score the past, and fit the model to deploy; a stage runs what it depends on."""
    if stage not in STAGES:
        raise ValueError(f"stage must be one of {STAGES}, got {stage!r}")
    dims = (tables["dim_vendor"], tables["dim_route"], tables["dim_date"])
    prepared = model.prepare(star.analytical_dataset(tables["fact"], *dims), settings)
    eval_model, test = model.chronological_evaluation(prepared, settings)
    walked = materialise(model.walk_forward(prepared, settings), "walk")
    folds = model.chronological_cv(walked)
    out = {"prepared": prepared, "evaluation_model": eval_model, "test": test, "chronological_cv": folds,
           "holdout_auc": metrics.roc_auc(test, "probability").first()[0],
           "report": metrics.classification_report(test, "probability"),
           "split_comparison": model.compare_split_strategies(prepared, settings),
           "weather_shift": metrics.distribution_shift(model.splits.chronological_holdout(prepared))}
    if stage == "evaluate":
        return out
    quality = metrics.metric_bundle(walked, "probability").first()
    scored = star.attach_scores(tables["fact"], stored_scores(walked)).select(*SCORED_COLUMNS)
    # Checked as a stored draft first: a failure leaves the published table as it was.
    draft = materialise(scored, "scored-draft")
    contracts.require_integrity(contracts.output_integrity(draft, tables["fact"], *dims))
    draft.write.mode("overwrite").parquet(f"{folder}/scored")
    scored = prepared.sparkSession.read.parquet(f"{folder}/scored")
    out |= {"walked": walked, "quality": quality.asDict(), "scored": scored,
            "warm_up": walked.where("warm_up").count(),
            "calibration": metrics.calibration_by_tier(stored_scores(walked))}
    if stage == "score":
        return out
    final = model.fit_model(prepared, settings)
    final.save(f"{folder}/model")
    verified = model.verify_saved(prepared.sparkSession, f"{folder}/model", final, prepared)
    marks = fingerprint.data_fingerprint(prepared.sparkSession, {**tables, "scored": scored})
    meta = run_metadata(prepared, settings, quality, out["holdout_auc"], folds, marks)
    writers.write_metadata(meta, f"{folder}/metadata")
    return out | {"model": final, "verified": verified, "fingerprint": marks, "metadata": meta,
                  "permutation_importance": model.permutation_importance(eval_model, test, repeats),
                  "impurity_importance": model.impurity_importance(prepared.sparkSession, eval_model)}


def run_metadata(prepared: DataFrame, settings, quality, holdout_auc, folds: DataFrame, marks: dict) -> DataFrame:
    """One nested row with all a consumer of the model needs."""
    cv = folds.agg(F.avg("roc_auc").alias("a"), F.stddev_pop("roc_auc").alias("s")).first()
    profile = metrics.training_profile(prepared, NUMERIC_FEATURES, CATEGORICAL_FEATURES)

    def four(x):
        return F.lit(None if x is None else round(float(x), 4)).cast("double")

    return profile.select(
        F.lit("delay_risk").alias("model_name"), F.current_timestamp().alias("trained_at"),
        F.array(*[F.lit(c) for c in settings.features]).alias("feature_order"),
        F.array(*[F.lit(c) for c in NUMERIC_FEATURES]).alias("numeric_features"),
        F.array(*[F.lit(c) for c in CATEGORICAL_FEATURES]).alias("categorical_features"),
        "categorical_levels", "numeric_ranges",
        F.struct(F.lit(P.HIGH_THRESHOLD).alias("high_risk"), F.lit(P.MEDIUM_THRESHOLD).alias("medium_risk"),
                 F.lit(P.COST_RATIO).alias("cost_fn_over_fp")).alias("thresholds"),
        F.struct(four(quality["roc_auc"]).alias("oof_roc_auc"), four(quality["brier"]).alias("oof_brier"),
                 four(quality["ece"]).alias("oof_ece"), four(holdout_auc).alias("chronological_holdout_roc_auc"),
                 four(cv["a"]).alias("chronological_cv_roc_auc_mean"),
                 four(cv["s"]).alias("chronological_cv_roc_auc_std")).alias("metrics"),
        F.struct("n_rows", "positive_rate", "date_min", "date_max").alias("training_data"),
        F.lit(marks.get("scored_table")).cast("string").alias("training_data_sha256"),
        F.lit(marks.get("source_tables")).cast("string").alias("source_tables_sha256"))


def run_batch_scoring(spark: SparkSession, model_path: str, source: str, target: str, audit: str | None = None) -> DataFrame:
    """Score a file of shipments, write the result, and append the audit rows."""
    rows = spark.read.option("header", True).csv(source) if source.rstrip("/").endswith(("csv", "_csv")) \
        else spark.read.parquet(source)
    rows = rows.select(*[F.col(c).cast("double").alias(c) if c in NUMERIC_FEATURES else F.col(c) for c in rows.columns])
    loaded = model.CalibratedForest.load(spark, model_path)
    model.score_frame(loaded, star.require_columns(rows, FEATURES)).write.mode("overwrite").option("header", True).format(
        "csv" if target.rstrip("/").endswith("csv") else "parquet").save(target)
    written = spark.read.option("header", True).csv(target) if target.rstrip("/").endswith("csv") else spark.read.parquet(target)
    if audit:
        numbers = [*NUMERIC_FEATURES, "Delay_Risk_Probability"]
        typed = written.select(*[F.col(c).cast("double").alias(c) if c in numbers else F.col(c) for c in written.columns])
        writers.append_audit(writers.audit_rows(writers.assessments(typed)), audit)
    return written


def run_allocation(tables: dict[str, DataFrame], fitted: model.CalibratedForest | None = None,
                   epsilon_kg: float | None = None, points=0, out: str | None = None, scenario="default") -> dict:
    """Guard the risk panel, then plan: a frontier, a plan under a ceiling, or the cheapest plan."""
    rows = materialise(star.allocation_input(tables["fact"], tables["dim_route"], tables["dim_vendor"]), "allocation")
    require_known_categories(rows)
    caps, quo = panels.caps_dict(panels.observed_caps(rows)), panels.status_quo(rows)
    result, risk = {"caps": caps, "status_quo": quo}, None
    if fitted is not None:
        rows = materialise(fitted.transform(rows, "Delay_Risk_Probability"), "observed")
        slope, levels = calibrate.intercepts(calibrate.fit_vehicle_calibrations(rows))
        risk = panels.risk_columns(slope, levels)
        result["guard"] = panels.require_guard(panels.calibrated_guard(rows.select("Shipment_ID", *risk)))
        grid = fitted.transform(panels.counterfactual_grid(rows.drop("Delay_Risk_Probability")), "p")
        result["raw_guard"] = panels.vehicle_guard(grid)
    wide = allocation.build_wide(rows, risk)
    if points:
        result["frontier"] = allocation.frontier(wide, caps, points)
        if out:
            for k, plan in enumerate(result["frontier"]):
                if plan.assignment is not None:
                    writers.write_plan(plan.assignment, out, f"{scenario}-{k}")
        return result
    result["plan"] = allocation.allocate(wide, caps, epsilon_kg)
    if out:
        writers.write_plan(result["plan"].assignment, out, scenario)
    return result
