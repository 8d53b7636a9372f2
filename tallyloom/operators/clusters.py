"""K-means over vector columns."""

from __future__ import annotations

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fit_kmeans(
    df: DataFrame, features: Column, k: int = 2, seed: int = 1
) -> tuple[KMeansModel, DataFrame]:
    """A fitted model, and the rows with their ``cluster``."""
    vectors = df.withColumn("_features", array_to_vector(features.cast("array<double>")))
    model = KMeans(
        k=k, seed=seed, featuresCol="_features", predictionCol="cluster"
    ).fit(vectors)
    return model, model.transform(vectors).drop("_features")


def squared_distances(model: KMeansModel, features: Column) -> Column:
    """Squared distances of a vector to every centre, in cluster order."""
    vector = features.cast("array<double>")
    return F.array(
        *[
            F.aggregate(
                F.zip_with(
                    vector,
                    F.array(*[F.lit(float(x)) for x in centre]),
                    lambda a, b: (a - b) * (a - b),
                ),
                F.lit(0.0),
                lambda total, part: total + part,
            )
            for centre in model.clusterCenters()
        ]
    )
