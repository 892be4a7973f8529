"""Per-vehicle level calibration with one shared slope."""

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cargolume import params as P
from cargolume.errors import IntegrityError, ThinCalibrationError
from cargolume.functions import formulas as fx
from cargolume.operators.star import require_columns
from cargolume.session import literal_rows, materialise


@dataclass(frozen=True)
class VehicleCalibration:
    vehicle: str
    n_rows: int
    observed_delay_rate: float
    mean_raw_score: float
    mean_calibrated: float
    slope: float
    intercept: float


def fit_vehicle_calibrations(observed: DataFrame, score="Delay_Risk_Probability", min_rows=P.MIN_CALIBRATION_ROWS,
                             fleet=P.VEHICLES) -> dict[str, VehicleCalibration]:
    """sigmoid(a * logit(score) + b_vehicle), unpenalised, on shipments as they ran."""
    try:
        require_columns(observed, ["Actual_Delay_Days", "Vehicle_Type", score])
    except ValueError as e:
        raise ThinCalibrationError(str(e)) from e
    blank = F.col(score).isNull() | F.isnan(F.col(score).cast("double")) | F.col("Actual_Delay_Days").isNull()
    known = observed.where(F.col("Vehicle_Type").isin(list(fleet))).groupBy("Vehicle_Type").agg(
        F.count("*").alias("n"), F.count_if(blank).alias("blank")).collect()
    counts, gaps = {r["Vehicle_Type"]: r["n"] for r in known}, sum(r["blank"] for r in known)
    if gaps:
        raise IntegrityError(f"{gaps} observed shipments have no score or no delay")
    thin = {v: counts.get(v, 0) for v in fleet if counts.get(v, 0) < min_rows}
    if thin:
        raise ThinCalibrationError(f"fewer than {min_rows} observed shipments for {thin}")
    design = observed.where(F.col("Vehicle_Type").isin(list(fleet))).select(
        "Vehicle_Type", F.col(score).alias("s"), (F.col("Actual_Delay_Days") > 0).cast("double").alias("label"),
        fx.logit(score).alias("x0"),
        *[(F.col("Vehicle_Type") == v).cast("double").alias(f"x{i + 1}") for i, v in enumerate(fleet[1:])])
    # Rows alike in every input weigh as one: the fit then runs over the distinct inputs.
    cells = materialise(design.groupBy(*design.columns).agg(F.count("*").cast("double").alias("w")), "calibration")
    ready = VectorAssembler(inputCols=[f"x{i}" for i in range(len(fleet))], outputCol="features").transform(cells)
    model = LogisticRegression(regParam=0.0, standardization=False, maxIter=200, tol=1e-12, weightCol="w").fit(ready)
    slope, shifts = float(model.coefficients[0]), [0.0, *[float(c) for c in model.coefficients[1:]]]
    level = {v: float(model.intercept) + shifts[i] for i, v in enumerate(fleet)}
    fitted = fx.sigmoid(F.col("x0") * slope + fx.lookup("Vehicle_Type", level))
    w = F.col("w")
    rows = cells.groupBy("Vehicle_Type").agg(
        F.sum(w).alias("n"), (F.sum(w * F.col("label")) / F.sum(w)).alias("rate"),
        (F.sum(w * F.col("s")) / F.sum(w)).alias("raw"), (F.sum(w * fitted) / F.sum(w)).alias("fit")).collect()
    by = {r["Vehicle_Type"]: r for r in rows}
    return {v: VehicleCalibration(v, int(by[v]["n"]), by[v]["rate"], by[v]["raw"], by[v]["fit"], slope, level[v])
            for v in fleet}


def calibration_table(spark, fitted: dict[str, VehicleCalibration]) -> DataFrame:
    names = ["vehicle", "n_rows", "observed_delay_rate", "mean_raw_score", "mean_calibrated", "slope", "intercept"]
    return literal_rows(spark, names, [tuple(getattr(c, n) for n in names) for c in fitted.values()])


def intercepts(fitted: dict[str, VehicleCalibration]) -> tuple[float, dict[str, float]]:
    first = next(iter(fitted.values()))
    return first.slope, {v: c.intercept for v, c in fitted.items()}
