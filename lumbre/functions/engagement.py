"""Engagement signals, score and label, and the scalings of the features."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (they decide the results):
VOLUME_WEIGHT = 0.0002
SCORE_WEIGHTS = {"C": 0.35, "S": 0.45, "V": 0.20}
COMMITMENT_SPLIT = 0.20
SATISFACTION_SPLIT = 0.5
TIER_RANGE = (1, 4)
XPS_MAX = 1000
LABEL_CLASSES = {-1: 0, 0: 1, 1: 2, 2: 3}
CATEGORIES = (
    "Arquitectura", "Ciencia", "Cine", "Cultura", "Escultura", "Gastronomía",
    "Historia", "Misterio", "Naturaleza", "Ocio", "Patrimonio", "Pintura",
)


def sigmoid(x: Column, w: float, b: float = 0.0) -> Column:
    return 1 / (1 + F.exp(-(F.lit(w) * x + F.lit(b))))


def centred_sigmoid(x: Column, w: float) -> Column:
    """0 at 0, towards 1 for large x."""
    return 2 * sigmoid(x, w) - 1


def commitment(likes: Column, dislikes: Column, bookmarks: Column) -> Column:
    """Bookmarks per reaction; missing where nobody reacted."""
    return F.try_divide(bookmarks.cast("double"), (likes + dislikes).cast("double"))


def satisfaction(likes: Column, dislikes: Column) -> Column:
    return F.try_divide(likes.cast("double"), (likes + dislikes).cast("double"))


def volume(likes: Column, dislikes: Column, bookmarks: Column) -> Column:
    return centred_sigmoid(bookmarks + likes + dislikes, VOLUME_WEIGHT)


def score(c: Column, s: Column, v: Column) -> Column:
    return SCORE_WEIGHTS["C"] * c + SCORE_WEIGHTS["S"] * s + SCORE_WEIGHTS["V"] * v


def label(c: Column, s: Column) -> Column:
    """-1 liked but not saved, 0 neither, 1 saved but not liked, 2 both or undefined."""
    liked, saved = s >= SATISFACTION_SPLIT, c >= COMMITMENT_SPLIT
    return F.when(liked & ~saved, -1).when(~liked & ~saved, 0).when(~liked & saved, 1).otherwise(2)


#: The same rule in SQL text over ``c`` and ``s``, made from the constants.
LABEL_SQL = f"""CASE WHEN s >= {SATISFACTION_SPLIT} AND c < {COMMITMENT_SPLIT} THEN -1
  WHEN s < {SATISFACTION_SPLIT} AND c < {COMMITMENT_SPLIT} THEN 0
  WHEN s < {SATISFACTION_SPLIT} AND c >= {COMMITMENT_SPLIT} THEN 1 ELSE 2 END"""


def label_class(value: Column) -> Column:
    """Class number 0..3 of a label; NULL for anything else."""
    pairs = [F.lit(x) for item in LABEL_CLASSES.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), value)


def tier_norm(tier: Column) -> Column:
    low, high = TIER_RANGE
    return (tier - low) / (high - low)


def xps_norm(xps: Column) -> Column:
    return xps / XPS_MAX


def z_score(x: Column, mean: float | Column, std: float | Column) -> Column:
    """0 for every value where there is no spread; a missing value stays missing."""
    mean = mean if isinstance(mean, Column) else F.lit(mean)
    std = std if isinstance(std, Column) else F.lit(std)
    return F.when(std > 0, F.try_divide(x - mean, std)).when(x.isNotNull(), F.lit(0.0))


def distance(lon: Column, lat: Column, centre: tuple[float, float]) -> Column:
    """Straight-line distance in degrees to a fixed point."""
    dx, dy = lon - F.lit(float(centre[0])), lat - F.lit(float(centre[1]))
    return F.sqrt(dx * dx + dy * dy)
