"""Clustering, projection and matching with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medalyst.operators.cleaning import fill_with_mean
from medalyst.operators.ordered import nearest_marked


def scaled_features(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """Standardised feature vector; a missing value counts as its column's mean, so every row stays."""
    raw = _assembled(df, cols, "_raw")
    return StandardScaler(inputCol="_raw", outputCol=out, withMean=True, withStd=True).fit(raw).transform(raw).drop("_raw")


def _assembled(df: DataFrame, cols: Sequence[str], out: str) -> DataFrame:
    filled = [f"_filled{i}" for i in range(len(cols))]
    doubles = df.withColumns({f: F.col(c).cast("double") for f, c in zip(filled, cols)})
    complete = fill_with_mean(doubles, filled).fillna(0.0, subset=filled)      # a column without any value is constant
    return VectorAssembler(inputCols=filled, outputCol=out).transform(complete).drop(*filled)


def silhouettes(vectors: DataFrame, ks: Sequence[int], features: str = "features", seed: int = 42) -> dict[int, float]:
    """Mean silhouette of a clustering for each k."""
    scorer = ClusteringEvaluator(featuresCol=features, metricName="silhouette")
    return {k: scorer.evaluate(KMeans(k=k, seed=seed, featuresCol=features).fit(vectors).transform(vectors)) for k in ks}


def best_kmeans(vectors: DataFrame, ks: Sequence[int] = range(2, 11), features: str = "features", seed: int = 42,
                sample: float | None = None):
    """Model for the k with the best silhouette, and all silhouettes.

    ``sample`` chooses k on that fraction of the rows; the model is always fitted on all of them.
    """
    rows = vectors.select(features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        trial = rows if sample is None else rows.sample(fraction=sample, seed=seed)
        scores = silhouettes(trial, list(ks), features, seed)
        k = max(scores, key=lambda n: (scores[n], -n))
        return KMeans(k=k, seed=seed, featuresCol=features).fit(rows), scores
    finally:
        rows.unpersist()


def assigned(model, vectors: DataFrame, out: str = "cluster") -> DataFrame:
    return model.transform(vectors).withColumnRenamed("prediction", out)


def principal_components(vectors: DataFrame, n_features: int, features: str = "features", variance: float | None = None,
                         k: int | None = None):
    """PCA with ``k`` components, or as many as explain ``variance``. Returns (model, kept)."""
    model = PCA(k=k or n_features, inputCol=features, outputCol="pca").fit(vectors)
    shares = np.asarray(model.explainedVariance.toArray())
    if k is None and variance is not None:
        kept = int(np.searchsorted(np.cumsum(shares), variance - 1e-12) + 1)
        return model, min(kept, n_features)
    return model, k or n_features


def component_table(model, names: Sequence[str], n_rows: int, spark, kept: int) -> DataFrame:
    """Loadings, their share of the component, and explained variance, one row per component and feature.

    Each component's sign is set so its largest loading is positive.
    """
    pc = np.asarray(model.pc.toArray())
    shares = np.asarray(model.explainedVariance.toArray())
    eigen = shares * len(names) * n_rows / (n_rows - 1)
    rows = []
    for j in range(kept):
        axis = pc[:, j] * np.sign(pc[np.argmax(np.abs(pc[:, j])), j])
        loading = axis * np.sqrt(eigen[j])
        total = np.abs(loading).sum()
        rows += [(f"PC{j + 1}", name, float(loading[i]), float(abs(loading[i]) / total), float(shares[j]))
                 for i, name in enumerate(names)]
    return spark.createDataFrame(
        rows, "component string, feature string, loading double, importance double, explained double")


def projected(model, vectors: DataFrame, kept: int) -> DataFrame:
    """Component scores as columns pc1, pc2, ... with the sign rule of ``component_table``."""
    pc = np.asarray(model.pc.toArray())
    signs = [float(np.sign(pc[np.argmax(np.abs(pc[:, j])), j])) for j in range(kept)]
    scores = vector_to_array("pca")
    return model.transform(vectors).withColumns({f"pc{j + 1}": scores[j] * signs[j] for j in range(kept)}).drop("pca")


def matched_effect(scored: DataFrame, score: str, treated: str, outcome: str) -> DataFrame:
    """Average effect from matching each row to the other arm's nearest score (the lower one on a tie).

    Rows are reduced to one row per distinct score before anything is ordered.
    Equal scores in the other arm share their mean outcome.
    """
    is_t = F.col(treated) == 1
    y = F.col(outcome).cast("double")
    per_score = scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("s")).agg(
        F.count_if(is_t).alias("n1"), F.coalesce(F.sum(F.when(is_t, y)), F.lit(0.0)).alias("y1"),
        F.count_if(~is_t).alias("n0"), F.coalesce(F.sum(F.when(~is_t, y)), F.lit(0.0)).alias("y0"))

    def matched(arm: str, other: str) -> DataFrame:
        near = nearest_marked(per_score, F.col(f"n{other}") > 0, "s", ["s"]).where(F.col(f"n{arm}") > 0)
        low, high = F.col("at_or_before"), F.col("at_or_after")
        take_low = high.isNull() | (low.isNotNull() & (F.col("s") - low <= high - F.col("s")))
        pairs = near.withColumn("m", F.when(take_low, low).otherwise(high))
        means = per_score.where(F.col(f"n{other}") > 0).select(F.col("s").alias("m"), (F.col(f"y{other}") / F.col(f"n{other}")).alias("ym"))
        joined = pairs.join(means, "m")
        own = F.col(f"y{arm}") - F.col("ym") * F.col(f"n{arm}")
        return joined.agg(F.sum(own if arm == "1" else -own).alias("gain"), F.sum(f"n{arm}").alias("n"))

    t, c = matched("1", "0"), matched("0", "1")
    total = t.withColumn("arm", F.lit("treated")).unionByName(c.withColumn("arm", F.lit("control")))
    on_treated = F.max(F.when(F.col("arm") == "treated", F.try_divide("gain", "n")))
    return total.agg(F.try_divide(F.sum("gain"), F.sum("n")).alias("ate"), on_treated.alias("att"),
                     F.sum(F.when(F.col("arm") == "treated", F.col("n"))).alias("n_treated"),
                     F.sum(F.when(F.col("arm") == "control", F.col("n"))).alias("n_control"))


def propensity_effect(df: DataFrame, treated: str, outcome: str, covariates: Sequence[str]) -> DataFrame:
    """Logistic propensity of treatment from numeric covariates, then ``matched_effect`` on it."""
    ready = _assembled(df.withColumn(treated, F.col(treated).cast("double")), covariates, "features")
    model = LogisticRegression(labelCol=treated, featuresCol="features", maxIter=50).fit(ready)
    scored = model.transform(ready).withColumn("score", F.round(vector_to_array("probability")[1], 9))
    return matched_effect(scored, "score", treated, outcome)
