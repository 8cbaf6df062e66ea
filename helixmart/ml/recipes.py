"""Significance prediction and dimension reduction with ``pyspark.ml``."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import PCA, FeatureHasher, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixmart.session import scratch_path


def significance_model(
    df: DataFrame, categories: list[str], numbers: list[str], label: str, seed: int = 42, trees: int = 20,
    width: int = 256, depth: int = 5,
) -> PipelineModel:
    """Random forest on microbe-stimulus pairs.

    Ids are hashed to a fixed width, so the model does not grow with the vocabularies. The fitted
    model is stored and loaded again: a fresh training summary holds on to the session, which
    cannot be sent to tasks once the session has observed a write. Rows without a label are not
    learned from; the label's index is no stage of the model, so that it scores any row. Labels are
    numbered in alphabetical order.
    """
    path = scratch_path(df.sparkSession, "significance-model")
    indexer = StringIndexer(inputCol=label, outputCol="_label", handleInvalid="skip", stringOrderType="alphabetAsc")
    labelled = df.filter(F.col(label).isNotNull())
    fitted = Pipeline(
        stages=[
            FeatureHasher(inputCols=[*categories, *numbers], outputCol="_features", numFeatures=width),
            RandomForestClassifier(
                labelCol="_label", featuresCol="_features", numTrees=trees, maxDepth=depth, seed=seed,
            ),
        ]
    ).fit(indexer.fit(labelled).transform(labelled))
    fitted.write().save(path)
    return PipelineModel.load(path)


def predict(model: PipelineModel, df: DataFrame, keys: list[str]) -> DataFrame:
    scored = model.transform(df)
    return scored.select(*keys, F.col("prediction").cast("int").alias("predicted"))


def principal_components(df: DataFrame, keys: list[str], features: list[str], k: int = 2) -> DataFrame:
    """First ``k`` component scores of standardised features; a NULL counts as the feature's mean."""
    means = df.agg(*[F.avg(c).alias(c) for c in features]).first()
    df = df.withColumns({c: F.coalesce(c, F.lit(means[c])) for c in features})
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=features, outputCol="_raw", handleInvalid="skip"),
            StandardScaler(inputCol="_raw", outputCol="_scaled", withMean=True, withStd=True),
            PCA(inputCol="_scaled", outputCol="_pc", k=k),
        ]
    ).fit(df)
    scores = vector_to_array(F.col("_pc"))
    return model.transform(df).select(*keys, *[scores[i].alias(f"pc{i + 1}") for i in range(k)])
