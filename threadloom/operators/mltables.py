"""Clusters, projections and classifiers over stored vectors."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from threadloom.functions.vectors import density_ratio
from threadloom.operators.ordering import sample_key

# Ten-colour categorical palette.
PALETTE = (
    "#1f77b4",
    "#ff7f0e",
    "#2ca02c",
    "#d62728",
    "#9467bd",
    "#8c564b",
    "#e377c2",
    "#7f7f7f",
    "#bcbd22",
    "#17becf",
)


def with_features(points: DataFrame, vector: str = "dense") -> DataFrame:
    return points.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))


def reduce_dimensions(points: DataFrame, k: int = 2, vector: str = "dense") -> DataFrame:
    """Principal components as ``x0 .. x{k-1}``."""
    rows = with_features(points, vector)
    model = PCA(k=k, inputCol="features", outputCol="_pc").fit(rows)
    projected = model.transform(rows).withColumn("_pc", vector_to_array("_pc"))
    return projected.withColumns({f"x{i}": F.col("_pc")[i] for i in range(k)}).drop("_pc", "features")


def cluster(points: DataFrame, n_clusters: int = 10, seed: int = 42, columns: list[str] | None = None) -> DataFrame:
    """k-means label of each row, over given columns or the dense vector."""
    if columns:
        rows = points.withColumn("features", array_to_vector(F.array(*columns)))
    else:
        rows = with_features(points)
    model = KMeans(k=n_clusters, seed=seed, featuresCol="features", predictionCol="cluster").fit(rows)
    return model.transform(rows).drop("features")


def colour_of(cluster_column: str = "cluster"):
    """Palette colour of a cluster label; labels past the palette wrap around."""
    pairs = [item for i, colour in enumerate(PALETTE) for item in (F.lit(i), F.lit(colour))]
    return F.element_at(F.create_map(*pairs), F.pmod(F.col(cluster_column), F.lit(len(PALETTE))))


def plot_table(points: DataFrame, n_clusters: int = 10, seed: int = 42) -> DataFrame:
    """x, y, text, id, cluster and colour of every point."""
    placed = cluster(reduce_dimensions(points, 2), n_clusters, seed, ["x0", "x1"])
    return placed.select(
        F.col("x0").alias("x"),
        F.col("x1").alias("y"),
        F.col("question").alias("text"),
        "id",
        "cluster",
        colour_of().alias("fill_color"),
    )


def balanced_weights(rows: DataFrame, label: str) -> DataFrame:
    """Weight n / (classes * rows of the class), attached by label."""
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("_c"))
    totals = counts.agg(F.sum("_c").alias("n"), F.count(F.lit(1)).alias("k"))
    weights = counts.select(
        label,
        (
            totals.select("n").scalar().cast("double") / (totals.select("k").scalar() * F.col("_c"))
        ).alias("weight"),
    )
    # as many rows as classes, which a classifier bounds
    return rows.join(F.broadcast(weights), label)


@dataclass
class DensityRatioClassifier:
    """Desirable-versus-undesirable classifier and its importance weights."""

    model: LogisticRegressionModel

    @classmethod
    def fit(cls, rows: DataFrame, vector: str = "dense", label: str = "label") -> DensityRatioClassifier:
        numbered = rows.withColumn(label, F.col(label).cast("double"))
        weighted = balanced_weights(with_features(numbered, vector), label)
        # regParam plays the role of 1/n for a unit inverse regularisation strength
        n = rows.count()
        learner = LogisticRegression(
            featuresCol="features",
            labelCol=label,
            weightCol="weight",
            maxIter=100,
            regParam=1.0 / max(n, 1),
            standardization=False,
        )
        return cls(learner.fit(weighted))

    def desirable_probability(self, rows: DataFrame, vector: str = "dense") -> DataFrame:
        scored = self.model.transform(with_features(rows, vector))
        return scored.withColumn("prob_desirable", vector_to_array("probability")[1]).drop(
            "features", "probability", "rawPrediction", "prediction"
        )

    def weights(self, undesirable: DataFrame, low: float = 0.5, high: float = 10.0) -> DataFrame:
        scored = self.desirable_probability(undesirable)
        return scored.withColumn("weight", density_ratio(F.col("prob_desirable"), low, high))


def hash_split(rows: DataFrame, id_col: str, test_percent: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the id: stable under recomputation."""
    bucket = F.conv(F.substring(sample_key(F.col(id_col), seed), 1, 6), 16, 10).cast("bigint") % 100
    marked = rows.withColumn("_t", bucket < test_percent)
    return marked.filter(~F.col("_t")).drop("_t"), marked.filter("_t").drop("_t")


def train_and_score(rows: DataFrame, id_col: str, vector: str, label: str, seed: int = 42) -> DataFrame:
    """Split, fit a multiclass logistic regression, and predict the test rows."""
    train, test = hash_split(with_features(rows, vector), id_col, seed=seed)
    learner = LogisticRegression(featuresCol="features", labelCol=label, maxIter=100)
    return learner.fit(train).transform(test).select(id_col, label, "prediction")
