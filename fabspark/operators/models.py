"""Table models that Spark ML trains, and batch scoring with a user-supplied predictor."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GeneralizedLinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fabspark.constants import SIGNIFICANCE
from fabspark.functions import kernels as K
from fabspark.operators.correlation import standardise
from fabspark.session import local_frame


def logistic_significance(
    df: DataFrame, class_col: str, cls, params: Sequence[str], normal="none"
) -> DataFrame:
    """Logistic fit of one class against normal rows on z-scores: coefficient and p per parameter.

    The fit is iterated over the distributed rows; the result has one row per parameter.
    """
    two = df.filter(F.col(class_col).isin(normal, cls)).dropna(subset=list(params))
    target = two.select(*params, (F.col(class_col) == cls).cast("double").alias("target"))
    z = standardise(target, params)
    features = VectorAssembler(inputCols=[f"{p}_z" for p in params], outputCol="features").transform(z)
    fit = GeneralizedLinearRegression(
        family="binomial", link="logit", labelCol="target", featuresCol="features", maxIter=200
    ).fit(features.select("features", "target"))
    summary = fit.summary
    n_coefficients = len(params) + 1
    loglik = (2 * n_coefficients - summary.aic) / 2
    rows = [
        (p, float(c), float(pv), "Yes" if pv < SIGNIFICANCE else "No", float(summary.aic), float(loglik))
        for p, c, pv in zip(params, fit.coefficients, summary.pValues)
    ]
    return local_frame(
        df.sparkSession,
        rows, "parameter string, coef double, pvalue double, significant string, aic double, loglik double"
    ).orderBy(F.desc(F.abs("coef")))


def tabular_classifier(
    df: DataFrame, features: Sequence[str], label_idx: str, weight_col: str | None = None, max_iter: int = 50, tol: float = 1e-6
) -> PipelineModel:
    """Multinomial logistic model on feature columns."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="skip"),
        LogisticRegression(
            featuresCol="_features", labelCol=label_idx, predictionCol="pred", probabilityCol="prob",
            family="multinomial", maxIter=max_iter, tol=tol, **({"weightCol": weight_col} if weight_col else {}),
        ),
    ]
    return Pipeline(stages=stages).fit(df)


def pca_features(df: DataFrame, cols: Sequence[str], k: int, out: str = "pca") -> DataFrame:
    """Add the first ``k`` principal components of the columns as an array."""
    assembled = VectorAssembler(inputCols=list(cols), outputCol="_features", handleInvalid="skip").transform(df)
    model = PCA(k=k, inputCol="_features", outputCol="_pca").fit(assembled)
    return model.transform(assembled).withColumn(out, vector_to_array("_pca")).drop("_features", "_pca")


def batch_predict(
    blob: Column, load_predictor: Callable[[], Callable[[np.ndarray], np.ndarray]], rows: int = 64, cols: int = 64
) -> Column:
    """Score maps in Arrow batches: ``struct<class_idx, prob>``.

    ``load_predictor`` runs once per batch stream on the executor and returns a function from
    ``(n, rows, cols)`` floats in [0, 1] to ``(n, classes)`` logits. A NULL map has no score.
    """
    @F.arrow_udf("struct<class_idx:int,prob:double>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        predict = load_predictor()
        for column in batches:
            bytes_, best, prob = K.byte_rows(column, rows * cols), [], []
            for start in range(0, len(bytes_), K.CHUNK):
                maps = bytes_[start:start + K.CHUNK].reshape(-1, rows, cols) / 2.0
                logits = np.asarray(predict(maps), dtype=np.float64)
                weights = np.exp(logits - logits.max(axis=1, keepdims=True))
                best.append(logits.argmax(axis=1))
                prob.append(weights.max(axis=1) / weights.sum(axis=1))
            best = np.concatenate(best or [np.zeros(0, int)])
            prob = np.concatenate(prob or [np.zeros(0)])
            yield pa.StructArray.from_arrays(
                [pa.array(best.astype(np.int32)), pa.array(prob)], names=["class_idx", "prob"]
            )

    return F.when(blob.isNotNull(), score(blob))


def pseudo_labels(scored: DataFrame, labelled: DataFrame, confidence: float = 0.95) -> DataFrame:
    """Labelled rows plus unlabelled rows scored with enough confidence, tagged by origin."""
    sure = scored.filter(F.col("prob") >= confidence)
    return labelled.withColumn("origin", F.lit("label")).unionByName(
        sure.withColumn("origin", F.lit("pseudo")), allowMissingColumns=True
    )
