"""Clustering of cause-mix vectors and sigma outliers on the distance of
each point to its own centre."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctlens.functions.vectors import sq_distance, vector_to_array


def has_at_least(df: DataFrame, n: int) -> bool:
    """``count >= n`` without a full count."""
    return len(df.limit(n).take(n)) >= n


def fit_kmeans(features: DataFrame, k: int = 2, seed: int = 1) -> KMeansModel:
    """Fitted until no centre moves (or 100 rounds), so a centre is the mean
    of its members."""
    return KMeans(k=k, seed=seed, tol=0.0, maxIter=100, featuresCol="features", predictionCol="prediction").fit(features)


def centres_column(model: KMeansModel) -> Column:
    """Model centres as a literal ``array<array<double>>`` (k x causes, a
    model parameter).  A fit can return fewer than k centres, so lookups
    index by the prediction actually made."""
    return F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()])


def distance_to_own_centre(predictions: DataFrame, model: KMeansModel) -> DataFrame:
    centre = F.element_at(centres_column(model), F.col("prediction") + 1)
    return predictions.withColumn("distanceFromCenter", sq_distance(vector_to_array("features"), centre))


def distance_to_mean_centre(features: DataFrame) -> DataFrame:
    """Distance to one fixed centre, the mean vector of all rows (scalar
    subquery: computed once, not joined)."""
    centre = features.select(vector_to_array(Summarizer.mean(F.col("features"))).alias("c")).scalar()
    return (features.withColumn("_centre", centre)
            .withColumn("distanceFromCenter", sq_distance(vector_to_array("features"), F.col("_centre")))
            .drop("_centre"))


def distance_summary(df: DataFrame, col: str = "distanceFromCenter") -> DataFrame:
    """count, mean, sample stddev, min, max (the ``describe`` statistics)."""
    c = F.col(col)
    return df.agg(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("stddev"),
                  F.min(c).alias("min"), F.max(c).alias("max"))


def sigma_outliers(df: DataFrame, sigmas: float = 2.0, col: str = "distanceFromCenter") -> DataFrame:
    """Rows strictly above ``mean + sigmas * stddev`` of ``col``.  The
    threshold is a scalar subquery over the same rows; with one row the
    stddev is null and nothing is flagged."""
    s = distance_summary(df, col)
    threshold = s.select(F.col("mean") + F.lit(float(sigmas)) * F.col("stddev")).scalar()
    return df.filter(F.col(col) > threshold)


def kmeans_outliers(features: DataFrame, k: int = 2, seed: int = 1, sigmas: float = 2.0):
    """(predictions with distance, outliers); ``None`` pair when fewer than
    two rows (k-means needs at least two points)."""
    if not has_at_least(features, 2):
        return None, None
    model = fit_kmeans(features, k, seed)
    decorated = distance_to_own_centre(model.transform(features), model)
    return decorated, sigma_outliers(decorated, sigmas)
