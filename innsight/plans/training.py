"""Model training and scoring on Spark ML.

Training frames stay distributed; nothing is pulled to the driver but fitted models
and their metrics. Rows are split by a hash of the key, so a split is repeatable.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innsight.plans.baseline import ltv_segment

SEED = 42


@dataclass(frozen=True)
class ModelSpec:
    """What a model reads and predicts. ``positive_weight`` None means neg/pos of the data."""

    name: str
    label: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    classifier: bool = False
    positive_weight: float | None = 1.0
    max_depth: int = 5
    iterations: int = 20
    step: float = 0.1


_LISTING = ("bedrooms", "bathrooms", "max_guests", "base_price", "bookings_30d", "revenue_30d", "avg_booking_value_30d", "views_30d", "clicks_30d", "click_through_rate")
_SEASON = ("month", "quarter", "is_peak_season")

# Inputs and tree settings of the five models.
DEMAND = ModelSpec(
    "demand_predictor", "booking_count",
    ("month", "quarter", "day_of_week", "week_of_year", "is_weekend", "is_peak_season", "sin_month", "cos_month", "sin_week", "cos_week", *_LISTING), ("property_type",),
)
CONVERSION = ModelSpec("conversion_predictor", "is_converted", (*_SEASON[::2], *_LISTING), ("property_type",), True, None)
PRICE = ModelSpec("pricing_optimizer", "optimal_price", _SEASON)
LTV = ModelSpec(
    "customer_ltv_predictor", "ltv_12m",
    ("total_bookings", "total_spend", "avg_booking_value", "cancelled_bookings", "cancellation_rate", "days_since_last_booking", "avg_days_between_bookings", "tenure_days"),
    ("country", "user_type"),
)
CHURN = ModelSpec(
    "churn_predictor", "is_churned",
    ("total_bookings", "total_spend", "avg_booking_value", "cancelled_bookings", "cancellation_rate", "avg_days_between_bookings", "tenure_days"), ("user_type",), True, 3.0,
)


def split(df: DataFrame, *keys: str, share: int = 80) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows by key hash (a key is never in both)."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(100))
    return df.where(slot < share), df.where(slot >= share)


def _prepared(df: DataFrame, spec: ModelSpec) -> DataFrame:
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in spec.numeric}
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spec.categorical}
    return df.withColumns({**numbers, **texts})


def inputs_of(df: DataFrame, spec: ModelSpec, *keep: str) -> DataFrame:
    """The columns a model reads of ``df``, and those named: what is worth storing for several passes."""
    wanted = {*keep, spec.label, *spec.numeric, *spec.categorical}
    return df.select(*[c for c in df.columns if c in wanted])


MIN_BINS = 32
#: Rows of one task of a fit; trees keep all their rows cached, task by task.
ROWS_PER_TASK = 250_000


def _dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in tasks of at most about ``ROWS_PER_TASK`` by a key that few rows share, however few files they come from.

    The rows of each task are counted: a file with one row group is cut into tasks of which one reads it all.
    """
    tasks = df.groupBy(F.spark_partition_id().alias("task")).agg(F.count(F.lit(1)).alias("rows"))
    total, most = tasks.agg(F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.max("rows"), F.lit(0))).first()
    return df.repartition(math.ceil(total / ROWS_PER_TASK), *keys) if most > ROWS_PER_TASK else df


def train(df: DataFrame, spec: ModelSpec, spread: Sequence[str] = ()) -> PipelineModel:
    """Boosted trees over assembled features; category codes are stored in the pipeline.

    ``df`` is read several times, so it should be a stored table. ``spread`` names its key, by
    which many rows are dealt to tasks of bounded size.
    """
    rows = _prepared(_dealt(df, spread) if spread else df, spec).withColumn("label", F.col(spec.label).cast("double"))
    codes = [StringIndexer(inputCol=c, outputCol=f"{c}_code", stringOrderType="alphabetAsc", handleInvalid="keep") for c in spec.categorical]
    inputs = [*spec.numeric, *[f"{c}_code" for c in spec.categorical]]
    common = dict(featuresCol="features", labelCol="label", maxDepth=spec.max_depth, maxIter=spec.iterations, stepSize=spec.step, subsamplingRate=0.8, seed=SEED)
    if spec.classifier:
        weight = spec.positive_weight
        if weight is None:
            pos, neg = rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
            weight = neg / pos if pos else 1.0
        rows = rows.withColumn("weight", F.when(F.col("label") == 1, weight).otherwise(1.0))
        estimator = GBTClassifier(weightCol="weight", **common)
    else:
        estimator = GBTRegressor(**common)
    coded = Pipeline(stages=codes).fit(rows)
    # A tree needs a bin for each value of a category, the one for unseen values included.
    estimator.setMaxBins(max([MIN_BINS, *(len(m.labels) + 1 for m in coded.stages)]))
    fitted = Pipeline(stages=[VectorAssembler(inputCols=inputs, outputCol="features"), estimator]).fit(coded.transform(rows))
    return PipelineModel([*coded.stages, *fitted.stages])


def predict(model: PipelineModel, df: DataFrame, spec: ModelSpec) -> DataFrame:
    """Adds ``prediction`` (regression value, or probability of the positive class)."""
    out = model.transform(_prepared(df, spec))
    if spec.classifier:
        out = out.withColumn("prediction", vector_to_array("probability")[1])
    return out.drop("features", "rawPrediction", "probability", *[f"{c}_code" for c in spec.categorical])


def feature_importance(model: PipelineModel, spec: ModelSpec) -> list[tuple[str, float]]:
    names = [*spec.numeric, *spec.categorical]
    weights = model.stages[-1].featureImportances.toArray()
    return sorted(zip(names, (float(w) for w in weights)), key=lambda pair: -pair[1])


def score_batch(model: PipelineModel, keyed: DataFrame, spec: ModelSpec, keep: Sequence[str], scoring_date: str, scored_at: Column | None = None) -> DataFrame:
    """Predict distinct keyed rows, keep the keys, name the output and add metadata."""
    scored = predict(model, keyed, spec)
    p = F.col("prediction")
    named = {
        "demand_predictor": {"predicted_bookings": p},
        "conversion_predictor": {"conversion_probability": p, "predicted_conversion": (p > 0.5).cast("int")},
        "pricing_optimizer": {"recommended_price": p},
        "customer_ltv_predictor": {"predicted_ltv_12m": p, "ltv_segment": ltv_segment(p)},
        "churn_predictor": {"churn_score": p},
    }[spec.name]
    return scored.select(
        *keep, *[e.alias(n) for n, e in named.items()], F.lit(spec.name).alias("model_name"),
        (F.current_timestamp() if scored_at is None else scored_at).alias("scored_at"), F.lit(scoring_date).cast("date").alias("scoring_date"),
    )

