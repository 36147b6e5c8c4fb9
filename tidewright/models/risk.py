"""Fitting and scoring with ``pyspark.ml``."""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewright.functions.risk import safety_level
from tidewright.functions.scalars import as_literal, clip_round
from tidewright.models.metrics import evaluate, verdict
from tidewright.operators.aggregates import values_at_ranks
from tidewright.schemas import NUMERIC_FEATURES
from tidewright.session import checkpoint_dir

TARGET = "risk_score"
MIN_ROWS = 100
TARGET_RANGE = (0.0, 200.0)


@dataclass(frozen=True)
class ModelParams:
    """Settings of the three model kinds."""

    kind: str = "GBT"
    trees: int = 100
    depth: int = 10
    rate: float = 0.1
    subsample: float = 0.8
    seed: int = 42


def training_frame(features: DataFrame, until=None, min_rows: int = MIN_ROWS) -> DataFrame:
    """Rows with a plausible target, up to a date if one is given; too few of them is an error."""
    rows = features.where(F.col(TARGET).between(*TARGET_RANGE))
    if until is not None:
        rows = rows.where(F.to_date("timestamp_forecast") <= as_literal(until).cast("date"))
    # Counting stops as soon as enough rows are seen.
    enough = rows.select(TARGET).limit(min_rows).count()
    if enough < min_rows:
        raise ValueError(f"{enough} usable rows; at least {min_rows} are needed")
    return rows


def temporal_split(df: DataFrame, ts: str, train_share: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(earlier rows, later rows), cut at the time of the row at the given share.

    Rows that tie with the cut are all on the later side. The cut is an exact order statistic and
    needs no global sort.
    """
    total = df.where(F.col(ts).isNotNull()).count()
    cut = values_at_ranks(df, ts, [min(int(total * train_share), total - 1)]).first()["value"]
    moment = F.timestamp_micros(F.lit(cut)).cast(df.schema[ts].dataType)
    return df.where(F.col(ts) < moment), df.where(F.col(ts) >= moment)


def model_inputs(df: DataFrame, features: list[str] = NUMERIC_FEATURES) -> DataFrame:
    """Missing numeric features become zero; zone as text."""
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    return filled.withColumn("zona_id", F.col("zona_id").cast("string"))


def build(
    params: ModelParams = ModelParams(), features: list[str] = NUMERIC_FEATURES, zone: bool = True, regularisation: float = 1e-6
) -> Pipeline:
    """Zone codes in alphabetical order (inputs of the model unless ``zone`` is off), numeric features, and the regressor."""
    codes = StringIndexer(inputCol="zona_id", outputCol="_zone", stringOrderType="alphabetAsc", handleInvalid="keep")
    # Arithmetic drops the column's list of categories: trees take the code as a number, for any number of zones.
    number = SQLTransformer(statement="SELECT *, _zone + 0D AS zona_id_encoded FROM __THIS__")
    vector = VectorAssembler(inputCols=[*features, *(["zona_id_encoded"] if zone else [])], outputCol="inputs")
    shared = {"featuresCol": "inputs", "labelCol": TARGET, "predictionCol": "prediction"}
    if params.kind == "GBT":
        model = GBTRegressor(
            maxIter=params.trees, maxDepth=params.depth, stepSize=params.rate,
            subsamplingRate=params.subsample, seed=params.seed, checkpointInterval=10, **shared,
        )
    elif params.kind == "RF":
        model = RandomForestRegressor(numTrees=params.trees, maxDepth=params.depth, seed=params.seed, **shared)
    elif params.kind == "LR":
        # A trace of regularisation keeps the closed form solvable when features are collinear.
        model = LinearRegression(solver="normal", regParam=regularisation, **shared)
    else:
        raise ValueError(f"unknown model kind: {params.kind}")
    return Pipeline(stages=[codes, number, vector, model])


def fit_risk_model(
    train: DataFrame, params: ModelParams = ModelParams(), inputs: list[str] = NUMERIC_FEATURES, zone: bool = True, regularisation: float = 1e-6
) -> PipelineModel:
    """A fitted pipeline; the zone codes are part of it and are not refitted at scoring."""
    checkpoint_dir(train.sparkSession)
    return build(params, inputs, zone, regularisation).fit(model_inputs(train, inputs))


def input_names(model: PipelineModel) -> list[str]:
    """The features of a fitted pipeline in the order of the model's weights."""
    return list(model.stages[-2].getInputCols())


def feature_importance(model: PipelineModel, spark: SparkSession, run_id: str, as_of, kind: str = "GBT") -> DataFrame:
    """Importances in descending order, or the coefficients of a linear model by absolute value; names come from the model."""
    fitted = model.stages[-1]
    weights = fitted.coefficients if kind == "LR" else fitted.featureImportances
    names = input_names(model)
    rows = spark.createDataFrame(list(zip(names, [float(w) for w in weights.toArray()])), "feature string, importance double")
    # One row per feature, so a single window over all of them is small by construction.
    order = Window.orderBy(F.abs("importance").desc(), "feature")
    return rows.select(
        "feature", "importance", F.row_number().over(order).alias("rank"),
        F.lit(kind).alias("model_type"), F.lit(run_id).alias("run_id"), as_literal(as_of).alias("created_at"),
    )


def score(
    model: PipelineModel,
    features: DataFrame,
    as_of,
    model_version: str = "1",
    model_run_id: str = "",
    inputs: list[str] = NUMERIC_FEATURES,
) -> DataFrame:
    """Predicted score (0 to 100, two decimals) and level per zone and hour."""
    predicted = model.transform(model_inputs(features, inputs))
    clipped = predicted.withColumn("risk_score_pred", clip_round("prediction", 0.0, 100.0, 2))
    return clipped.select(
        "zona_id",
        "timestamp_forecast",
        "risk_score_pred",
        safety_level("risk_score_pred", variant="prediction").alias("safety_level_pred"),
        F.lit(model_version).alias("model_version"),
        F.lit(model_run_id).alias("model_run_id"),
        as_literal(as_of).alias("prediction_ts"),
        as_literal(as_of).alias("created_at"),
    )


@dataclass
class Training:
    """A finished training run."""

    model: PipelineModel
    run_id: str
    record: DataFrame
    importances: DataFrame
    test_predictions: DataFrame


def train(
    features: DataFrame,
    as_of,
    params: ModelParams = ModelParams(),
    train_share: float = 0.8,
    save_to: str | None = None,
    run_id: str | None = None,
    inputs: list[str] = NUMERIC_FEATURES,
    zone: bool = True,
    regularisation: float = 1e-6,
) -> Training:
    """Split, fit, evaluate and record, over any list of features. With ``save_to`` the model goes to that folder under its
    run id."""
    spark = features.sparkSession
    # Fitting reads its rows many times: compute them once, into the shared checkpoint folder.
    checkpoint_dir(spark)
    rows = training_frame(features.checkpoint())
    earlier, later = temporal_split(rows, "timestamp_forecast", train_share)
    model = fit_risk_model(earlier, params, inputs, zone, regularisation)
    sides = {
        name: model.transform(model_inputs(side, inputs)) for name, side in (("train", earlier), ("test", later))
    }
    figures = {name: evaluate(side, TARGET, "prediction").first() for name, side in sides.items()}
    run_id = run_id or uuid.uuid4().hex
    record = run_record(spark, run_id, params, train_share, figures, as_of, len(input_names(model)))
    if save_to is not None:
        model.write().overwrite().save(f"{save_to}/{run_id}")
    return Training(model, run_id, record, feature_importance(model, spark, run_id, as_of, params.kind), sides["test"])


def run_record(
    spark: SparkSession, run_id: str, params: ModelParams, train_share: float, figures: dict, as_of, num_features: int
) -> DataFrame:
    """One row with the settings and metrics of a run."""
    tr, te = figures["train"], figures["test"]
    number = lambda v: float(v) if v is not None else None
    opinion = verdict(tr["r2"] or 0.0, te["r2"] or 0.0, te["rmse"] or 0.0)
    row = [(
        run_id, params.kind, json.dumps(asdict(params), sort_keys=True), 1.0 - train_share,
        tr["n"], te["n"], num_features,
        number(te["rmse"]), number(te["mae"]), number(te["r2"]),
        number(tr["rmse"]), number(tr["mae"]), number(tr["r2"]), opinion,
    )]
    schema = (
        "run_id string, model_type string, params string, test_split double, train_records bigint, "
        "test_records bigint, num_features int, rmse double, mae double, r2 double, "
        "rmse_train double, mae_train double, r2_train double, verdict string"
    )
    return spark.createDataFrame(row, schema).withColumn("created_at", as_literal(as_of))
