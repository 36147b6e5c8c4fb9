"""Regression figures as one-pass aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OVERFIT_GAP = 0.15
HIGH_RMSE = 20.0


def error_table(pred: DataFrame, keys: list[str], actual: str = "risk_score", predicted: str = "prediction") -> DataFrame:
    """Actual and predicted value, signed and absolute error per row."""
    error = F.col(predicted) - F.col(actual)
    return pred.select(
        *keys,
        F.col(actual).alias("risk_score_real"),
        F.col(predicted).alias("risk_score_pred"),
        error.alias("error"),
        F.abs(error).alias("abs_error"),
    )


def evaluate(pred: DataFrame, actual: str, predicted: str, by: list[str] | None = None) -> DataFrame:
    """RMSE, MAE and R² in a single pass, over everything or per group (such as train and test)."""
    error = F.col(predicted) - F.col(actual)
    sums = pred.groupBy(*(by or [])).agg(
        F.count(error).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.sum(error * error).alias("_sse"),
        (F.var_pop(F.when(error.isNotNull(), F.col(actual))) * F.count(error)).alias("_sst"),
    )
    r2 = F.when(F.col("_sst") > 0, F.lit(1.0) - F.col("_sse") / F.col("_sst"))
    return sums.withColumn("r2", r2).drop("_sse", "_sst")


def verdict(train_r2: float, test_r2: float, test_rmse: float) -> str:
    """What the figures say about the fit."""
    if train_r2 - test_r2 > OVERFIT_GAP:
        return "OVERFIT"
    return "HIGH_RMSE" if test_rmse > HIGH_RMSE else "OK"
