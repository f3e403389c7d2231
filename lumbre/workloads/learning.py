"""Registered cases: clustering and boosted trees."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbre.functions import engagement as E
from lumbre.operators import geo
from lumbre.operators.kmeans import Clusters
from lumbre.plans import models, stages
from lumbre.plans import poi as plan
from lumbre.session import scratch_path
from lumbre.sources.tables import save_scratch, scan
from lumbre.workloads.entities import CENTRES, PREPROCESSED_BODY, SPLIT_SQL, TRAIN_SQL
from lumbre.workloads.registry import case
from lumbre.workloads.standins import poi_engaged, with_tables
from lumbre.workloads.support import r, rounded


def _vectors(spark: SparkSession, folder: str) -> DataFrame:
    """(part, vector): image vectors by part number; all entities of a part share the vector of its number."""
    vector = F.col("embedding").cast("array<double>").alias("vector")
    return scan(spark, folder, "embeddings").select(F.col("vec_id").alias("part"), vector)


def _with_part(rows: DataFrame) -> DataFrame:
    return rows.withColumn("part", F.split_part("id", F.lit("-"), F.lit(2)).cast("bigint"))


@case(
    "project_features",
    with_tables(
        f"""SELECT {", ".join(f'pre."{c}"' for c in plan.FEATURES[:4])}, categories_count, tags_count,
               {", ".join(f'"{c}"' for c in E.CATEGORIES)},
               {", ".join(f"dist_centroid_{i}" for i in range(plan.N_CENTRES))}
            FROM ({PREPROCESSED_BODY}) pre JOIN poi_engaged USING (id)""",
        "poi_engaged",
    ),
)
def project_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = save_scratch(poi_engaged(spark, folder).select("id", *plan.RAW), "poi-engaged")
    stats = plan.fit_stats(rows.where(F.expr(TRAIN_SQL)), CENTRES)
    return rounded(plan.preprocess(rows, stats).select(*plan.FEATURES))


@case(
    "assemble_features",
    with_tables(
        f"""SELECT id, 92 AS n_features, {r("(tier - 1) / 3::DOUBLE")} AS first_feature,
                   {r("coalesce(CAST(embedding[64] AS DOUBLE), 0)")} AS last_feature
            FROM poi LEFT JOIN embeddings ON CAST(split_part(id, '-', 2) AS BIGINT) = vec_id""",
        "poi",
    ),
)
def assemble_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = save_scratch(poi_engaged(spark, folder).select("id", *plan.RAW), "poi-engaged")
    stats = plan.fit_stats(rows.where(F.expr(TRAIN_SQL)), CENTRES)
    made = models.assemble(_with_part(plan.preprocess(rows, stats)), plan.FEATURES, _vectors(spark, folder), "part", zeros=True)
    items = vector_to_array("features")
    return rounded(
        made.select(
            "id",
            F.size(items).alias("n_features"),
            F.element_at(items, 1).alias("first_feature"),
            F.element_at(items, -1).alias("last_feature"),
        )
    )


def _split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return stages.split_rows(poi_engaged(spark, folder), scratch_path(spark, "poi"))


_TRAIN_SQL = f"FROM ({SPLIT_SQL}) WHERE split = 'train'"
SWEEP = [10, 15, 16, 17, 18, 19, 20, 30]


@case(
    "kmeans_fit",
    with_tables(
        f"SELECT {stages.N_CLUSTERS} AS clusters, count(*) AS n, true AS at_nearest, true AS at_means {_TRAIN_SQL}",
        "poi_engaged",
    ),
)
def kmeans_fit(spark: SparkSession, folder: str) -> DataFrame:
    # What must hold for a fit, whatever the starting points; the fit is saved and loaded in between.
    train = _split_rows(spark, folder).where("split = 'train'")
    found = _saved_fit(spark, train)
    assigned = geo.nearest_centre(train, found.centres, "cluster").groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.avg("locationLon").alias("lon"), F.avg("locationLat").alias("lat")
    )
    centre, size = F.get(_literal(found.centres), F.col("cluster")), F.get(_literal(found.sizes), F.col("cluster"))
    moved = F.hypot(F.col("lon") - centre[0], F.col("lat") - centre[1])
    return assigned.agg(
        F.count(F.lit(1)).cast("int").alias("clusters"),
        F.sum("n").alias("n"),
        F.bool_and(F.col("n") == size).alias("at_nearest"),
        F.bool_and(moved < 0.02).alias("at_means"),
    )


def _literal(values: list):
    return F.array(*[_literal(v) if isinstance(v, list) else F.lit(v) for v in values])


def _saved_fit(spark: SparkSession, train: DataFrame) -> Clusters:
    path = scratch_path(spark, "kmeans")
    models.fit_kmeans(train, stages.N_CLUSTERS).save(spark, path)
    return Clusters.load(spark, path)


@case("kmeans_clusters")
def kmeans_clusters(spark: SparkSession, folder: str) -> DataFrame:
    # The clusters themselves: rows next to each centre, the centre, and the cost of the whole fit.
    found = _saved_fit(spark, _split_rows(spark, folder).where("split = 'train'")).table(spark)
    return found.select("cluster", "n", F.col("centre")[0].alias("lon"), F.col("centre")[1].alias("lat"), "cost", "rounds")


@case("kmeans_k_sweep", "SELECT unnest([" + ", ".join(map(str, SWEEP)) + "]) AS k, true AS falls")
def kmeans_k_sweep(spark: SparkSession, folder: str) -> DataFrame:
    # More centres cost less, but for what the starting points make of it.
    costs = kmeans_costs(spark, folder)
    before = F.lag("training_cost").over(Window.orderBy("k"))
    return costs.select("k", F.coalesce(F.col("training_cost") <= 1.05 * before, F.lit(True)).alias("falls"))


@case("kmeans_costs")
def kmeans_costs(spark: SparkSession, folder: str) -> DataFrame:
    # The table behind an elbow plot: (k, training_cost).
    return models.k_sweep(_split_rows(spark, folder).where("split = 'train'"), SWEEP)


def _assembled(spark: SparkSession, folder: str, vectors: DataFrame | None = None) -> stages.Prepared:
    path = scratch_path(spark, "poi")
    made = stages.prepare(poi_engaged(spark, folder), path)
    return stages.assemble(replace(made, rows=_with_part(made.rows)), path, vectors, "part")


def _facts_sql(known: str, learns: str = "CASE WHEN split = 'train' THEN true END") -> str:
    return with_tables(
        f"""SELECT split AS part, count(*) AS n, {learns} AS learns FROM ({SPLIT_SQL}) JOIN (SELECT id, "E" FROM poi_engaged) USING (id)
            WHERE split IN ('train', 'test') AND {known} GROUP BY 1""",
        "poi_engaged",
    )


def _regression(made: stages.Prepared) -> DataFrame:
    """Rows of train and test with a score, and whether the trees are nearer to it on train than the mean is (errors on
    test: ``gbt_regression_metrics``)."""
    model = models.fit_regressor(made.part("train"), "E")
    rows = model.transform(made.rows.where("split in ('train', 'test') and E is not null").select("split", "E", "features"))
    error = F.avg(F.pow(F.col("prediction") - F.col("E"), 2))
    found = rows.groupBy(F.col("split").alias("part")).agg(F.count(F.lit(1)).alias("n"), error.alias("mse"), F.var_pop("E").alias("spread"))
    return found.select("part", "n", F.when(F.col("part") == "train", F.col("mse") < F.col("spread")).alias("learns"))


def _classification(made: stages.Prepared) -> DataFrame:
    """Rows of train and test, and whether the trees are right on train at least as often as the largest class and give
    every row of test one of the classes (report on test: ``gbt_classification_report``)."""
    model = models.fit_classifier(made.part("train"))
    truth = E.label_class(F.col("engagement_label"))
    rows = model.transform(made.rows.where("split in ('train', 'test')")).withColumn("t", truth)
    counts = rows.groupBy(F.col("split").alias("part"), "t").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("prediction") == F.col("t")).cast("long")).alias("right"),
        F.count_if(F.col("prediction").isin(*E.LABEL_CLASSES.values())).alias("classed"),
    )
    found = counts.groupBy("part").agg(*[F.sum(c).alias(c) for c in ("n", "right", "classed")], F.max("n").alias("largest"))
    learns = F.when(F.col("part") == "train", F.col("right") >= F.col("largest")).otherwise(F.col("classed") == F.col("n"))
    return found.select("part", "n", learns.alias("learns"))


@case("gbt_regression", _facts_sql('"E" IS NOT NULL'))
def gbt_regression(spark: SparkSession, folder: str) -> DataFrame:
    return _regression(_assembled(spark, folder))


@case("gbt_regression_vectors", _facts_sql('"E" IS NOT NULL'))
def gbt_regression_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return _regression(_assembled(spark, folder, _vectors(spark, folder)))


@case("gbt_classification", _facts_sql("true", "true"))
def gbt_classification(spark: SparkSession, folder: str) -> DataFrame:
    return _classification(_assembled(spark, folder))


@case("gbt_classification_vectors", _facts_sql("true", "true"))
def gbt_classification_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return _classification(_assembled(spark, folder, _vectors(spark, folder)))


@case("gbt_regression_metrics")
def gbt_regression_metrics(spark: SparkSession, folder: str) -> DataFrame:
    # Test errors with the metadata alone.
    return stages.evaluate_regression(_assembled(spark, folder))


@case("gbt_regression_vectors_metrics")
def gbt_regression_vectors_metrics(spark: SparkSession, folder: str) -> DataFrame:
    # Test errors with the image vectors as well.
    return stages.evaluate_regression(_assembled(spark, folder, _vectors(spark, folder)))


def _report(made: stages.Prepared) -> DataFrame:
    """Test report with the accuracy, and the row of the confusion matrix where the line is a class."""
    report, accuracy, matrix = stages.evaluate_classification(made)
    counts = matrix.withColumn("label", F.col("label").cast("string"))
    return report.join(counts, "label", "left").withColumn("accuracy", accuracy.scalar())


@case("gbt_classification_report")
def gbt_classification_report(spark: SparkSession, folder: str) -> DataFrame:
    return _report(_assembled(spark, folder))


@case("gbt_classification_vectors_report")
def gbt_classification_vectors_report(spark: SparkSession, folder: str) -> DataFrame:
    return _report(_assembled(spark, folder, _vectors(spark, folder)))
