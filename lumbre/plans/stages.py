"""The point-of-interest work from raw rows to evaluated models, stage by stage.

Each stage is saved under its own name, so it can be inspected, and picked up again, on its own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbre.functions import engagement as E
from lumbre.operators import geo, metrics, split
from lumbre.plans import models, poi
from lumbre.sources.tables import save, save_scratch

#: Clusters that label rows, as against the centres whose distances are features.
N_CLUSTERS = 17


@dataclass(frozen=True)
class Prepared:
    """Rows of all splits with every feature, and what was learned from train."""

    rows: DataFrame
    stats: poi.Stats
    clusters: list[list[float]]

    def part(self, name: str) -> DataFrame:
        return self.rows.where(F.col("split") == name)


def split_rows(engaged: DataFrame, folder: str) -> DataFrame:
    rows = save(engaged, f"{folder}/engaged")
    return save(split.stratified_split(rows, "id", "engagement_label"), f"{folder}/split")


def prepare(engaged: DataFrame, folder: str) -> Prepared:
    """Split, cluster and normalize; every statistic comes from the train split."""
    rows = split_rows(engaged, folder)
    train = rows.where("split = 'train'")
    fitted = models.fit_kmeans_all(train, [N_CLUSTERS, poi.N_CENTRES])
    clusters, centres = (fitted[k].centres for k in (N_CLUSTERS, poi.N_CENTRES))
    stats = poi.fit_stats(train, centres)
    stats.save(rows.sparkSession, f"{folder}/stats")
    featured = geo.nearest_centre(poi.preprocess(rows, stats), clusters)
    return Prepared(save(featured, f"{folder}/featured"), stats, clusters)


def assemble(prepared: Prepared, folder: str, vectors: DataFrame | None = None, key: str = "id") -> Prepared:
    """Feature vectors of 28 columns, or of these and the image vectors, joined by a key."""
    made = models.assemble(prepared.rows, poi.FEATURES, vectors, key, zeros=True).select("id", "features", "E", "engagement_label", "split")
    return Prepared(save(made, f"{folder}/assembled"), prepared.stats, prepared.clusters)


def evaluate_regression(assembled: Prepared) -> DataFrame:
    """Test (mse, mae, r2) of boosted trees for the engagement score."""
    model = models.fit_regressor(assembled.part("train"), "E")
    return metrics.regression_metrics(model.transform(assembled.part("test")), "E", "prediction")


def classified(assembled: Prepared) -> DataFrame:
    """Truth ``t`` and prediction ``p`` of boosted trees for the engagement label on the test rows, written once."""
    model = models.fit_classifier(assembled.part("train"))
    rows = model.transform(assembled.part("test")).select(
        E.label_class(F.col("engagement_label")).alias("t"), F.col("prediction").cast("int").alias("p")
    )
    return save_scratch(rows, "classified")


def evaluate_classification(assembled: Prepared) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Test report, accuracy and confusion matrix of boosted trees for the engagement label."""
    scored = classified(assembled)
    classes = list(E.LABEL_CLASSES.values())
    return (
        metrics.classification_report(scored, "t", "p"),
        metrics.accuracy(scored, "t", "p"),
        metrics.confusion_matrix(scored, "t", "p", classes),
    )
