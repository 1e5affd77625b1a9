"""Fraud classifier: features, training, scoring, evaluation.

Without outside labels the label is the outcome of the rules, which are a
function of the two features: the model then learns the rules back.  Pass
``labels`` for labels from elsewhere.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paysieve.operators.velocity import COUNT_COLUMN, with_velocity
from paysieve.schemas import FEATURE_COLUMNS, PREDICTION_SERVING_COLUMNS


class SingleClassError(ValueError):
    """The training rows do not hold both classes."""


def with_label(gold: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Add the 0/1 ``label``: the rule outcome, or the one ``labels``
    (``event_id``, ``label``) gives; rows it does not cover are left out."""
    if labels is None:
        return gold.withColumn("label", F.col("is_fraud").cast("int"))
    known = labels.groupBy("event_id").agg(F.max(F.col("label").cast("int")).alias("label"))
    return gold.drop("label").join(known, "event_id")


def build_pipeline(*, max_iter: int = 10, tol: float = 1e-6, handle_invalid: str = "skip") -> Pipeline:
    """Assemble, scale to unit standard deviation, regress.  All parameters not
    named here keep Spark's defaults, as does ``tol``."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features", handleInvalid=handle_invalid),
            StandardScaler(inputCol="features", outputCol="scaledFeatures"),
            LogisticRegression(featuresCol="scaledFeatures", labelCol="label", maxIter=max_iter, tol=tol),
        ]
    )


def feature_table(labelled: DataFrame) -> DataFrame:
    """Keys, features and label alone: all that training reads."""
    return labelled.select("event_id", "user_id", *FEATURE_COLUMNS, "label")


def train(labelled: DataFrame, *, max_iter: int = 10, tol: float = 1e-6) -> PipelineModel:
    """Fit on all rows with both features; the others cannot be learnt from.

    With one class only, Spark would return zero coefficients and an infinite
    intercept; that is refused here.
    """
    rows = labelled.select(*FEATURE_COLUMNS, "label")
    usable = rows.where(
        F.col("label").isNotNull()
        & F.col("amount").isNotNull()
        & ~F.isnan("amount")
        & F.col(COUNT_COLUMN).isNotNull()
    )
    low, high = usable.agg(F.min("label"), F.max("label")).first()
    if low is None or low == high:
        raise SingleClassError(f"training needs both classes, found only {low!r}")
    return build_pipeline(max_iter=max_iter, tol=tol).fit(usable)


def score(
    model: PipelineModel, gold: DataFrame, *, velocity_seconds: int = 60
) -> DataFrame:
    """Apply the model to every row; adds Spark's five columns and
    ``fraud_probability`` (ours).

    A row with a missing feature stays, with NULL prediction and probability:
    Spark would drop it, or call it clean.  Silver is accepted too; its window
    counts are computed first.
    """
    if COUNT_COLUMN not in gold.columns:
        gold = with_velocity(gold, velocity_seconds)
    # A saved pipeline carries the setting it was trained with.
    lenient = PipelineModel(
        [s.copy().setHandleInvalid("keep") if hasattr(s, "setHandleInvalid") else s for s in model.stages]
    )
    scored = lenient.transform(gold).withColumn("fraud_probability", vector_to_array("probability")[1])
    known = ~F.isnan("fraud_probability")
    return scored.withColumn("prediction", F.when(known, F.col("prediction"))).withColumn(
        "fraud_probability", F.when(known, F.col("fraud_probability"))
    )


def serving_view(predictions: DataFrame, *, probability: bool = False) -> DataFrame:
    """The columns of the serving table; with ``fraud_probability`` if asked for."""
    return predictions.select(*PREDICTION_SERVING_COLUMNS, *["fraud_probability"] * probability)


def coefficients(model: PipelineModel) -> list[tuple[str, float]]:
    lr = model.stages[-1]
    return [*zip(FEATURE_COLUMNS, (float(c) for c in lr.coefficients)), ("intercept", float(lr.intercept))]


def split(labelled: DataFrame, *, holdout: float = 0.2, key: str = "event_id") -> tuple[DataFrame, DataFrame]:
    """(train, test) by the key's MD5: the same on every run, any layout, any engine."""
    part = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % 10_000
    edge = round(holdout * 10_000)
    return labelled.where(part >= edge), labelled.where(part < edge)


SCORE_RANGES = 1 << 16


def area_under_curve(scored: DataFrame, *, score: str = "fraud_probability", label: str = "label") -> float | None:
    """The share of (fraud, clean) pairs that the score orders rightly, ties
    counting half; None without one of the classes.

    Exact at any size: equal scores are one row, and ranges of scores, of which there are
    ``SCORE_RANGES`` at most, are added up on their own and then put in order.
    """
    grouped = scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("fraud"), F.count_if(F.col(label) == 0).alias("clean")
    )
    ranged = grouped.withColumn("range", F.floor(F.col("score") * SCORE_RANGES).cast("int"))
    before = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    own = ranged.withColumn("below", F.coalesce(F.sum("clean").over(before), F.lit(0)))
    # twice the pairs, to stay with whole numbers
    pairs = (F.col("fraud") * (2 * F.col("below") + F.col("clean"))).cast("decimal(38,0)")
    sums = own.groupBy("range").agg(F.sum("fraud").alias("fraud"), F.sum("clean").alias("clean"), F.sum(pairs).alias("pairs"))
    lower = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    across = F.col("fraud").cast("decimal(38,0)") * 2 * F.coalesce(F.sum("clean").over(lower), F.lit(0))
    twice, fraud, clean = sums.withColumn("across", across).agg(
        F.sum(F.col("pairs") + F.col("across")), F.sum("fraud"), F.sum("clean")
    ).first()
    return int(twice) / (2 * fraud * clean) if fraud and clean else None


def evaluate(model: PipelineModel, labelled: DataFrame) -> dict[str, float]:
    """AUC, confusion counts, and how many rows were left out as they cannot be scored."""
    scored = score(model, labelled)
    known = F.col("prediction").isNotNull()

    def cell(label, prediction):
        return F.count_if((F.col("label") == label) & (F.col("prediction") == prediction))

    counts = scored.agg(
        cell(1, 1).alias("tp"),
        cell(0, 1).alias("fp"),
        cell(0, 0).alias("tn"),
        cell(1, 0).alias("fn"),
        F.count_if(~known).alias("unscored"),
    ).first()
    return {"auc": area_under_curve(scored.where(known)), **counts.asDict()}
