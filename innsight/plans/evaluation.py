"""Model quality as Spark aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.operators.ordered import running_totals


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """RMSE, MAE, R2 and MAPE with +1 in the denominator, in one pass.

    The total sum of squares is n times the population variance.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    squared = F.sum((y - p) ** 2)
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("row_count"),
        F.sqrt(squared / n).alias("rmse"),
        (F.sum(F.abs(y - p)) / n).alias("mae"),
        (1 - F.try_divide(squared, n * F.var_pop(y))).alias("r2"),
        (F.sum(F.abs((y - p) / (y + 1))) / n * 100).alias("mape"),
    )


# Value bands of the error report; (low, high] as cut by the report.
VALUE_BANDS = [(500, "Low"), (1000, "Medium"), (2500, "High")]
VALUE_LAST = "VIP"


def error_by_band(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    band = F.when(y <= 0, F.lit(None))
    for upper, name in VALUE_BANDS:
        band = band.when(y <= upper, name)
    return df.groupBy(band.otherwise(VALUE_LAST).alias("segment")).agg(
        F.count(F.lit(1)).alias("row_count"), (F.sum(F.abs(y - p)) / F.count(F.lit(1))).alias("mae")
    ).where("segment IS NOT NULL")


def _safe(num: Column, den: Column) -> Column:
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def classification_metrics(df: DataFrame, label: str = "label", score: str = "score", threshold: float = 0.5) -> DataFrame:
    """AUC from ranks with ties averaged, and precision, recall, F1 at a threshold.

    Equal scores are merged before the ordered running total, so neither a frequent
    score nor the whole table lands in one task. AUC is 0.5 when a class is missing.
    """
    y = F.col(label) == 1
    hit = F.col(score) > threshold
    per_score = df.groupBy(F.col(score).cast("double").alias("s")).agg(
        F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"), F.count_if(y & hit).alias("tp"), F.count_if(~y & hit).alias("fp"),
        F.count_if(y & ~hit).alias("fn"),
    )
    ranked = running_totals(per_score, ["s"], {"neg_upto": F.col("neg")})
    wins = F.sum(F.col("pos") * (F.col("neg_upto") - F.col("neg") + F.col("neg") / 2))
    row = ranked.agg(
        *[F.sum(c).alias(c) for c in ("pos", "neg", "tp", "fp", "fn")], wins.alias("wins")
    )
    precision, recall = _safe(F.col("tp"), F.col("tp") + F.col("fp")), _safe(F.col("tp"), F.col("tp") + F.col("fn"))
    return row.select(
        (F.col("pos") + F.col("neg")).alias("row_count"), F.coalesce(F.try_divide("wins", F.col("pos") * F.col("neg")), F.lit(0.5)).alias("auc"),
        precision.alias("precision"), recall.alias("recall"), _safe(2 * precision * recall, precision + recall).alias("f1"),
    )


def price_lift(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Mean prediction against mean actual in percent; 0 when the actual mean is 0. MAPE skips zero actuals."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    n = F.count(F.lit(1))
    error = F.sum(F.when(y != 0, F.abs((y - p) / y)))
    return df.agg(
        (F.sum(y) / n).alias("mean_actual"), (F.sum(p) / n).alias("mean_predicted"), (F.coalesce(F.try_divide(error, F.count_if(y != 0)), F.lit(0.0)) * 100).alias("mape"),
    ).withColumn(
        "revenue_lift_pct", F.coalesce(F.try_divide(F.col("mean_predicted") - F.col("mean_actual"), F.col("mean_actual")) * 100, F.lit(0.0))
    )
