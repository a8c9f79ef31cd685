"""Job reports over result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _share(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * F.lit(100.0), whole), 1)


def job_summary(results: DataFrame, by: Sequence[str] = (), *more: Column) -> DataFrame:
    """Total, succeeded and failed rows with percentages, in all or per group.

    ``more`` are further aggregates of the same pass.
    """
    total, failed = F.count(F.lit(1)), F.count_if("error")
    return results.groupBy(*by).agg(
        total.alias("total"), (total - failed).alias("succeeded"), failed.alias("failed"),
        _share(total - failed, total).alias("succeeded_pct"),
        _share(failed, total).alias("failed_pct"), *more)


def chunk_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("chunk").agg(
        F.count_if(~F.col("error")).alias("succeeded"), F.count_if("error").alias("failed"))


def error_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("error", "error_msg", "status").agg(F.count(F.lit(1)).alias("n"))


def length_summary(df: DataFrame, text: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.length(text)).alias("mean_chars"),
                               F.count(F.lit(1)).alias("n"))


def chunk_count(df: DataFrame, chunk_size: int) -> DataFrame:
    return df.agg(F.ceil(F.count(F.lit(1)) / F.lit(chunk_size)).cast("bigint").alias("n_chunks"))


def throughput(runs: DataFrame, by: Sequence[str], rows: str = "rows_processed",
               elapsed: str = "elapsed_time") -> DataFrame:
    """Rows per second of each configuration in a run log."""
    return runs.groupBy(*by).agg(
        F.sum(rows).cast("bigint").alias("rows"), F.sum(elapsed).alias("seconds"),
        F.try_divide(F.sum(rows), F.sum(elapsed)).alias("rows_per_second"))


def token_totals(results: DataFrame, by: Sequence[str] = ("stop_reason",)) -> DataFrame:
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("input_tokens"), F.lit(0)).cast("bigint").alias("input_tokens"),
        F.coalesce(F.sum("output_tokens"), F.lit(0)).cast("bigint").alias("output_tokens"))


def linear_model(df: DataFrame, outcome: str, predictors: Sequence[str]) -> DataFrame:
    """Least squares: one row per term with estimate, error, t and p value.

    The normal equations are summed over the cluster; only the few terms come back.
    """
    features = VectorAssembler(inputCols=list(predictors), outputCol="__x", handleInvalid="skip")
    data = features.transform(df.select(
        F.col(outcome).cast("double").alias("__y"),
        *[F.col(p).cast("double").alias(p) for p in predictors]).dropna())
    fit = LinearRegression(featuresCol="__x", labelCol="__y", solver="normal",
                           regParam=0.0, standardization=False).fit(data)
    summary = fit.summary
    estimates = [fit.intercept, *fit.coefficients]
    errors = summary.coefficientStandardErrors  # the intercept's values come last
    def first_last(v):
        return [v[-1], *v[:-1]]
    rows = zip(["(Intercept)", *predictors], map(float, estimates),
               map(float, first_last(errors)), map(float, first_last(summary.tValues)),
               map(float, first_last(summary.pValues)))
    return df.sparkSession.createDataFrame(
        list(rows), "term string, estimate double, std_error double, statistic double, "
                    "p_value double")
