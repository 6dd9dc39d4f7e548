"""Logistic regression on labelled tables, fitted by Spark ML in the JVM and scored with SQL functions."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def doubles(values: list[float]) -> Column:
    """A constant array of doubles (one literal in the plan, whatever its length)."""
    return F.split(F.lit(",".join(map(repr, map(float, values)))), ",").cast("array<double>")


def strings(values: list[str]) -> Column:
    """A constant array of strings without line feeds."""
    return F.split(F.lit("\n".join(values)), "\n")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, also where the body uses it inside a loop over an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fit(spark: SparkSession, rows: DataFrame, vocabulary: list[str], classes: int, strength: float, sparse: float,
        iterations: int, tasks: int = 1) -> tuple[list[list[float]], list[float]]:
    """Weights by class and feature, and intercepts, from ``rows`` (features array<string>, label double, weight double).

    ``strength`` and ``sparse``: elastic-net penalty and its share of absolute values.  Two classes give one row of
    weights, for class 1.  ``tasks``: most tasks over the rows.
    """
    counts = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="features", outputCol="vector")
    learner = LogisticRegression(featuresCol="vector", labelCol="label", weightCol="weight", maxIter=iterations, regParam=strength,
                                 elasticNetParam=sparse, family="binomial" if classes == 2 else "multinomial")
    model = learner.fit(counts.transform(rows).coalesce(tasks))
    return model.coefficientMatrix.toArray().tolist(), [float(x) for x in model.interceptVector]
