"""Fraud model: training set, random forest, scoring and the rule without a model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.measures import FRAUD_CUTOFF, rule_score, score_pct, txn_type_code
from ledgerloom.operators.tables import exists

# Fixed values of the model.
TREES = 50
DEPTH = 5
SEED = 42
TEST_SHARE = 20  # percent
FEATURES = ["type_code", "amount_value"]


def training_set(txns: DataFrame) -> DataFrame:
    """Type, amount and label; a failed transaction counts as blocked fraud."""
    return txns.select(
        "txn_id",
        txn_type_code("txn_type").alias("txn_type"),
        F.col("txn_amount").alias("amount"),
        F.when(F.col("txn_status") == "FAILED", 1).otherwise(0).alias("is_fraud"),
    )


def _features(df: DataFrame, code) -> DataFrame:
    """The inputs of the model; a null amount stands as zero and :func:`score` leaves its row unscored."""
    return df.withColumn("type_code", code.cast("double")).withColumn(
        "amount_value", F.coalesce(F.col("amount").cast("double"), F.lit(0.0))
    )


def _labelled(rows: DataFrame) -> DataFrame:
    """Rows to learn from or to test on; one without an amount teaches nothing and is left out."""
    data = _features(rows.where(F.col("amount").isNotNull()), F.col("txn_type"))
    return data.withColumn("label", F.col("is_fraud").cast("double"))


def split(rows: DataFrame, row_id: str = "txn_id") -> tuple[DataFrame, DataFrame]:
    """80/20 by a hash of the row id: no sort, and the same rows on a recomputation."""
    test = F.pmod(F.xxhash64(F.lit(SEED), row_id), F.lit(100)) < TEST_SHARE
    return rows.where(~test), rows.where(test)


def fit(rows: DataFrame) -> PipelineModel:
    """``rows`` as given by :func:`training_set`."""
    data = _labelled(rows)
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featuresCol="features", labelCol="label"
    )
    return Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), forest]).fit(data)


def accuracy(model: PipelineModel, rows: DataFrame) -> float:
    data = _labelled(rows)
    return MulticlassClassificationEvaluator(metricName="accuracy").evaluate(model.transform(data))


def train(txns: DataFrame, path: str) -> float:
    """Fit on the training share, save the model, give the hold-out accuracy."""
    train_rows, test_rows = split(training_set(txns))
    model = fit(train_rows)
    model.write().overwrite().save(path)
    return accuracy(model, test_rows)


def load_model(spark: SparkSession, path: str) -> PipelineModel | None:
    """The saved model, or None where none was saved yet."""
    return PipelineModel.load(path) if exists(spark, path) else None


def score(txns: DataFrame, model: PipelineModel | None) -> DataFrame:
    """``risk_score``, ``is_fraud`` and the score in percent for ``txn_type`` and ``amount``.

    Without a model the amount rule decides. A row without an amount is not
    scored: all three are null, which is its flag. Works on batches and streams.
    """
    if model is None:
        risk = rule_score("amount")
        scored = txns.withColumn("risk_score", risk).withColumn(
            "is_fraud", F.col("risk_score") > FRAUD_CUTOFF
        )
    else:
        inputs = _features(txns, txn_type_code("txn_type", ignore_case=True))
        scored = (
            model.transform(inputs)
            .withColumn("risk_score", vector_to_array("probability")[1])
            .withColumn("is_fraud", F.col("prediction") == 1)
            .select(*txns.columns, "risk_score", "is_fraud")
        )
    known = F.col("amount").isNotNull()
    scored = scored.withColumns({c: F.when(known, F.col(c)) for c in ("risk_score", "is_fraud")})
    return scored.withColumn("risk_pct", score_pct("risk_score"))
