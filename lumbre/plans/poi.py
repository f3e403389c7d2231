"""Points of interest: cleaning, engagement, splits and leak-free preprocessing."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.functions import engagement as E
from lumbre.functions import sets
from lumbre.operators import entities, geo, profile

METRICS = ["Visits", "Likes", "Dislikes", "Bookmarks"]
N_CENTRES = 10

FEATURES = [
    "tier_norm",
    "xps_norm",
    "locationLon_norm",
    "locationLat_norm",
    "categories_count",
    "tags_count",
    *E.CATEGORIES,
    *[f"dist_centroid_{i}" for i in range(N_CENTRES)],
]

#: What the features are made of.
RAW = ["tier", "xps", "locationLon", "locationLat", "categories_count", "tags_count", *E.CATEGORIES]


def clean(raw: DataFrame, order: str = "ord") -> DataFrame:
    """One row per id from raw rows whose lists are text: tags united, metrics averaged, the rest
    from the first row in input order."""
    rows = entities.parse_sets(raw, "categories", "tags")
    return entities.merge_duplicates(rows, "id", order, "tags", METRICS).drop(order)


def add_counts(df: DataFrame) -> DataFrame:
    return df.withColumns({f"{c}_count": sets.size_or_zero(F.col(c)) for c in ("categories", "tags")})


def add_engagement(df: DataFrame) -> DataFrame:
    """Signals C, S, V, the score E and the engagement label."""
    likes, dislikes, saved = F.col("Likes"), F.col("Dislikes"), F.col("Bookmarks")
    signals = {
        "C": E.commitment(likes, dislikes, saved),
        "S": E.satisfaction(likes, dislikes),
        "V": E.volume(likes, dislikes, saved),
    }
    c, s, v = F.col("C"), F.col("S"), F.col("V")
    return df.withColumns(signals).withColumns({"E": E.score(c, s, v), "engagement_label": E.label(c, s)})


def multi_hot(df: DataFrame, column: str, classes: list[str] | None = None, limit: int = 10_000) -> DataFrame:
    """One 0/1 column per member of a set column, in sorted order.

    Without ``classes`` the members are looked up; more than ``limit`` would not do as columns and
    are refused.
    """
    if classes is None:
        found = profile.elements(df, column).take(limit + 1)
        if len(found) > limit:
            raise ValueError(f"{column} has more than {limit} different members")
        classes = sorted(r["member"] for r in found)
    return df.withColumns({c: F.coalesce(F.array_contains(column, c).cast("int"), F.lit(0)) for c in classes})


def engage(cleaned: DataFrame, classes: list[str] | None = None) -> DataFrame:
    return multi_hot(add_engagement(add_counts(cleaned)), "categories", classes)


def normalize_features(df: DataFrame) -> DataFrame:
    return df.withColumns({"tier_norm": E.tier_norm(F.col("tier")), "xps_norm": E.xps_norm(F.col("xps"))})


def normalize_coordinates(df: DataFrame, lon_mean: float, lon_std: float, lat_mean: float, lat_std: float) -> DataFrame:
    return df.withColumns(
        {
            "locationLon_norm": E.z_score(F.col("locationLon"), lon_mean, lon_std),
            "locationLat_norm": E.z_score(F.col("locationLat"), lat_mean, lat_std),
        }
    )


@dataclass(frozen=True)
class Stats:
    """What preprocessing learns from the train split, and from nothing else."""

    lon_mean: float
    lon_std: float
    lat_mean: float
    lat_std: float
    centres: list[list[float]]
    dist_mean: list[float]
    dist_std: list[float]

    def save(self, spark: SparkSession, path: str) -> None:
        """One parquet row."""
        schema = (
            "lon_mean double, lon_std double, lat_mean double, lat_std double, "
            "centres array<array<double>>, dist_mean array<double>, dist_std array<double>"
        )
        spark.createDataFrame([tuple(asdict(self).values())], schema).coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Stats:
        return cls(**spark.read.parquet(path).first().asDict())


def fit_stats(train: DataFrame, centres: list[list[float]]) -> Stats:
    """Means and sample deviations of coordinates and centre distances, in one pass."""
    with_distances = geo.centre_distances(train, centres)
    named = {"lon": "locationLon", "lat": "locationLat"}
    named.update({f"d{i}": f"dist_centroid_{i}" for i in range(len(centres))})
    aggregates = []
    for short, column in named.items():
        aggregates += [F.avg(column).alias(f"{short}_mean"), F.stddev_samp(column).alias(f"{short}_std")]
    row = with_distances.agg(*aggregates).first()
    return Stats(
        row["lon_mean"],
        row["lon_std"],
        row["lat_mean"],
        row["lat_std"],
        [[float(x) for x in c] for c in centres],
        [row[f"d{i}_mean"] for i in range(len(centres))],
        [row[f"d{i}_std"] for i in range(len(centres))],
    )


def preprocess(df: DataFrame, stats: Stats) -> DataFrame:
    """All normalizations from raw columns; applying it twice changes nothing."""
    return (
        df.transform(normalize_features)
        .transform(normalize_coordinates, stats.lon_mean, stats.lon_std, stats.lat_mean, stats.lat_std)
        .transform(geo.centre_distances, stats.centres, stats.dist_mean, stats.dist_std)
    )
