"""Distances to fixed centres and nearest centre, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbre.functions.engagement import distance, z_score

Centre = tuple[float, float]


def centre_distances(
    df: DataFrame,
    centres: Sequence[Centre],
    mean: Sequence[float] | None = None,
    std: Sequence[float] | None = None,
) -> DataFrame:
    """Add ``dist_centroid_0 ...``; with means and deviations (of the train split) standardized."""
    columns = {}
    for i, centre in enumerate(centres):
        d = distance(F.col("locationLon"), F.col("locationLat"), centre)
        columns[f"dist_centroid_{i}"] = d if mean is None or std is None else z_score(d, mean[i], std[i])
    return df.withColumns(columns)


def long_distances(df: DataFrame, key: str, centres: Sequence[Centre]) -> DataFrame:
    """Every row against every centre, long: (key, centre, distance). Centres are a short fixed list."""
    at = F.array(*[F.struct(F.lit(i).alias("centre"), distance(F.col("locationLon"), F.col("locationLat"), c).alias("distance")) for i, c in enumerate(centres)])
    return df.select(key, F.explode(at).alias("x")).select(key, "x.centre", "x.distance")


def nearest_centre(df: DataFrame, centres: Sequence[Centre], name: str = "geo_cluster") -> DataFrame:
    """Add the number of the nearest centre; ties go to the lower number."""
    lon, lat = F.col("locationLon"), F.col("locationLat")
    found = F.array_min(F.array(*[F.struct(distance(lon, lat, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centres)]))
    return df.withColumn(name, F.when(lon.isNotNull() & lat.isNotNull(), found["i"]))
