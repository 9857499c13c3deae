"""Scores of volatility predictions against the mean of the training labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_summary(dataset: DataFrame) -> DataFrame:
    found = dataset.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.min("y").alias("min_log"), F.avg("y").alias("mean_log"), F.max("y").alias("max_log"))
    return found.select("*", *[F.exp(f"{c}_log").alias(f"{c}_vol") for c in ("min", "mean", "max")])


def baseline_predictor(dataset: DataFrame) -> DataFrame:
    """The constant prediction: the mean log-volatility over all training rows."""
    return dataset.where("split = 'train'").agg(F.avg("y").alias("mean_log")).select("mean_log", F.exp("mean_log").alias("baseline_vol"))


def evaluate(scored: DataFrame) -> DataFrame:
    """From rows (split, y, prediction), both logarithms: errors and correlations on the test split, beside the baseline's error.

    One pass: a constant's mean square error is the variance plus the square of its distance from the mean.
    """
    on = lambda split, x: F.when(F.col("split") == split, x)
    v, p = on("test", F.exp("y")), on("test", F.exp("prediction"))
    found = scored.agg(
        F.count(v).alias("rows"),
        F.sqrt(F.avg(F.pow(p - v, 2))).alias("rmse"),
        F.corr(p, v).alias("pearson"),
        F.corr(on("test", F.col("prediction")), on("test", F.col("y"))).alias("pearson_log"),
        F.exp(F.avg(on("train", F.col("y")))).alias("baseline_"),
        F.avg(v).alias("mean_"),
        F.var_pop(v).alias("spread_"),
    )
    return found.select("rows", "rmse", F.sqrt(F.col("spread_") + F.pow(F.col("baseline_") - F.col("mean_"), 2)).alias("rmse_baseline"), "pearson", "pearson_log")
