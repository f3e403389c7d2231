"""Image quality measures: one row per image, from the rows of Spark's ``image`` source."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The functions below travel to the executors themselves; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Weights of blue, green and red in the 8-bit gray value, in 1/32768.
GRAY_WEIGHTS = (3735, 19235, 9798)
GRAY_SHIFT = 15

MEASURES = [
    ("width", T.IntegerType()),
    ("height", T.IntegerType()),
    ("channels", T.IntegerType()),
    ("color_mode", T.StringType()),
    ("image_min_pixel", T.IntegerType()),
    ("image_max_pixel", T.IntegerType()),
    ("gray_image_min_pixel", T.IntegerType()),
    ("gray_image_max_pixel", T.IntegerType()),
    ("contrast", T.DoubleType()),
    ("brightness", T.DoubleType()),
    ("sharpness", T.DoubleType()),
]


def _as_bgr(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    """Pixels as blue, green, red: gray images are repeated, an alpha channel is left out."""
    pixels = np.frombuffer(data, dtype=np.uint8).reshape(height, width, channels)
    return np.repeat(pixels, 3, axis=2) if channels == 1 else pixels[:, :, :3]


def _gray(bgr: np.ndarray) -> np.ndarray:
    weighted = bgr.astype(np.int64) @ np.array(GRAY_WEIGHTS, dtype=np.int64)
    return (weighted + (1 << (GRAY_SHIFT - 1))) >> GRAY_SHIFT


def _laplacian(gray: np.ndarray) -> np.ndarray:
    """Four neighbours minus four times the pixel, mirrored at the edges without repeating them."""
    p = np.pad(gray, 1, mode="reflect")
    return p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * gray


def _measure(height: int, width: int, channels: int, data: bytes) -> tuple:
    bgr = _as_bgr(height, width, channels, data)
    gray = _gray(bgr)
    shown = bgr.shape[2]
    mode = {3: "BGR", 1: "gray"}.get(shown, "unexpected")
    return (
        width,
        height,
        shown,
        mode,
        int(bgr.min()),
        int(bgr.max()),
        int(gray.min()),
        int(gray.max()),
        float(gray.std()),
        float(gray.mean()),
        float(_laplacian(gray).var()),
    )


def image_quality(df: DataFrame, key: str, image: str = "image") -> DataFrame:
    """(key, measures ...) of every image; measures are NULL for an unreadable one.

    Pixels go no further than the task that reads them: join the result, not the images.
    """
    schema = T.StructType([df.schema[key], *[T.StructField(n, t) for n, t in MEASURES]])
    names = [n for n, _ in MEASURES]
    flat = df.select(key, *[F.col(f"{image}.{c}").alias(f"_{c}") for c in ("height", "width", "nChannels", "data")])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                _measure(int(h), int(w), int(c), data) if data is not None and h > 0 else (None,) * len(names)
                for h, w, c, data in zip(batch["_height"], batch["_width"], batch["_nChannels"], batch["_data"])
            ]
            out = pd.DataFrame(rows, columns=names, dtype=object)
            out.insert(0, key, batch[key].to_numpy())
            yield out

    return flat.mapInPandas(run, schema)
