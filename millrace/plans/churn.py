"""Predict a label from categories and numbers kept as text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.learning import evaluate, logistic_regression, score, spread, staged_classifier
from millrace.operators.quality import blank_to_number, cast_to_double, drop_missing
from millrace.operators.sampling import split_by_hash
from millrace.workspace import stage, staged


@dataclass(frozen=True)
class ChurnPlan:
    key: str
    label: str
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    #: Numeric columns stored as text that may be blank.
    numeric_text: tuple[str, ...] = ()
    train_percent: int = 80


# Columns of the customer file.
CHURN = ChurnPlan(
    key="customerID",
    label="Churn",
    categorical=(
        "gender", "Partner", "Dependents", "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity",
        "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies", "Contract",
        "PaperlessBilling", "PaymentMethod",
    ),
    numeric=("SeniorCitizen", "tenure", "MonthlyCharges", "TotalCharges"),
    numeric_text=("TotalCharges",),
)


def prepare(df: DataFrame, plan: ChurnPlan) -> DataFrame:
    """Drop incomplete rows, read the numbers, and drop rows whose numbers were blank."""
    numbers = blank_to_number(drop_missing(df), plan.numeric_text)
    others = [c for c in plan.numeric if c not in plan.numeric_text]
    return drop_missing(cast_to_double(numbers, others), plan.numeric)


def run_churn(df: DataFrame, plan: ChurnPlan = CHURN) -> tuple[PipelineModel, DataFrame, DataFrame]:
    """Fit the staged classifier on the training side; returns it with the scored test
    rows (key, label index, prediction, probability) and their metrics."""
    parts = split_by_hash(prepare(df, plan), plan.key, plan.train_percent)
    classifier = logistic_regression("features", "label", maxIter=100, regParam=0.0)
    stages = staged_classifier(plan.categorical, plan.numeric, plan.label, classifier)
    with staged(spread(parts), "churn-rows") as rows:
        model = stages.fit(rows.filter(F.col("part") == "train"))
        scored = score(model, rows.filter(F.col("part") == "test"))
        predictions = stage(scored.select(plan.key, "label", "prediction", "probability_1"), "churn-predictions")
    return model, predictions, evaluate(predictions, "label")
