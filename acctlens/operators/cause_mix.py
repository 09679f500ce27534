"""Per-server terminate-cause mix (bad-session pattern features).

stop counts per (window, server, cause)
  -> ratio of each count in its server total (``sumPerBras``)
  -> cause label index (most frequent first) -> one-hot -> scaled by ratio
  -> per-server vector sum = cause-mix vector, plus ``min(sumPerBras)``.

``scope='window'`` (default) totals per server *and window*; ``'batch'``
totals per server over the whole input, which is what a micro-batch of the
reference does when it closes several windows at once.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Interaction, OneHotEncoder, StringIndexer, StringIndexerModel
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from acctlens.functions.vectors import vector_to_array


UNKNOWN_CAUSE = "<unknown>"


def scope_keys(scope: str) -> list[str]:
    if scope == "window":
        return ["aggField1", "timestamp"]
    if scope == "batch":
        return ["aggField1"]
    raise ValueError(f"unknown scope {scope!r}")


def cause_ratio(stop_counts: DataFrame, scope: str = "window") -> DataFrame:
    """Adds ``sumPerBras`` and ``ratioInBras = value / sumPerBras``.

    Window scope: an OVER sum partitioned by (server, window) - one shuffle,
    groups hold one row per cause.  Batch scope: a server's group spans all
    its windows, so the total is a (map-side combined) aggregate joined back;
    a hot server then is a skewed join key AQE can split, not one window
    partition a single task must sort."""
    keys = scope_keys(scope)
    if scope == "window":
        df = stop_counts.withColumn("sumPerBras", F.sum("value").over(Window.partitionBy(*keys)))
    else:
        totals = stop_counts.groupBy(*keys).agg(F.sum("value").alias("sumPerBras"))
        df = stop_counts.join(totals, keys)
    return df.withColumn("ratioInBras", F.col("value") / F.col("sumPerBras"))


def feature_stages(labels: list[str] | None = None) -> list:
    """Indexer (fitted per input, or fixed ``labels`` so vectors are
    comparable across batches; causes outside of them share one further
    bucket, ``UNKNOWN_CAUSE``), one-hot without dropping the last category,
    and the ratio interaction."""
    if labels is None:
        indexer = StringIndexer(inputCol="aggField2", outputCol="terminateCauseIndex",
                                stringOrderType="frequencyDesc")
    else:
        indexer = StringIndexerModel.from_labels(labels, inputCol="aggField2", outputCol="terminateCauseIndex",
                                                 handleInvalid="keep")
    encoder = OneHotEncoder(inputCols=["terminateCauseIndex"], outputCols=["featuresNotScaled"], dropLast=False)
    scale = Interaction(inputCols=["featuresNotScaled", "ratioInBras"], outputCol="featuresScaled")
    return [indexer, encoder, scale]


def fit_features(ratios: DataFrame, labels: list[str] | None = None) -> PipelineModel:
    return Pipeline(stages=feature_stages(labels)).fit(ratios)


def model_labels(model: PipelineModel) -> list[str]:
    indexer = model.stages[0]
    return list(indexer.labels) + ([UNKNOWN_CAUSE] if indexer.getHandleInvalid() == "keep" else [])


def cause_features(ratios: DataFrame, model: PipelineModel, scope: str = "window") -> DataFrame:
    """``keys, features (vector), minSumPerBras`` - one row per server (and
    window).  ``Summarizer.sum`` is a partial/final vector aggregate."""
    keys = scope_keys(scope)
    return (model.transform(ratios).groupBy(*keys)
            .agg(Summarizer.sum(F.col("featuresScaled")).alias("features"),
                 F.min("sumPerBras").alias("minSumPerBras")))


def label_index(ratios: DataFrame, model: PipelineModel) -> DataFrame:
    """Each cause with its row count and fitted index."""
    counts = ratios.groupBy("aggField2").agg(F.count(F.lit(1)).alias("labelCount"))
    return model.stages[0].transform(counts).select(F.col("aggField2").alias("cause"), "labelCount",
                                                    F.col("terminateCauseIndex").alias("causeIndex"))


def features_long(features: DataFrame, labels: list[str], scope: str = "window", digits: int | None = 9) -> DataFrame:
    """Vector -> one row per (key, cause index) with the cause label; the
    SQL-visible form of the mix vectors."""
    keys = scope_keys(scope)
    label_arr = F.array(*[F.lit(x) for x in labels])
    df = features.select(*keys, "minSumPerBras",
                         F.posexplode(vector_to_array("features")).alias("causeIndex", "ratioSum"))
    ratio = F.round("ratioSum", digits) if digits is not None else F.col("ratioSum")
    return df.select(*keys, "causeIndex", F.element_at(label_arr, F.col("causeIndex") + 1).alias("cause"),
                     ratio.alias("ratioSum"), "minSumPerBras")


def first_keys(features: DataFrame, n: int, scope: str = "window") -> DataFrame:
    """The first ``n`` feature rows ordered by server (and window): a top-n
    (TakeOrderedAndProject), never a full sort."""
    keys = scope_keys(scope)
    return features.select(*keys).orderBy(*keys).limit(n)
