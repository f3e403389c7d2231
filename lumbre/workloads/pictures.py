"""Registered cases on images. Each 64-number embedding is taken as the pixels of an 8 x 8 picture."""

from __future__ import annotations

import struct
import sys
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.operators import images, profile
from lumbre.session import prepare, scratch_path
from lumbre.sources.files import read_images
from lumbre.sources.tables import save_scratch, scan
from lumbre.workloads.registry import case
from lumbre.workloads.standins import poi, with_tables
from lumbre.workloads.support import per_column, r, rounded

# The functions below travel to the executors themselves; the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SIDE = 8
#: Files of a folder, at most.
FOLDER_FILES = 10_000


def _hex(value: Column) -> Column:
    return F.lpad(F.hex(value), 2, "0")


def _bgr_hex(pixels: Column) -> Column:
    """Pixel numbers as blue, green, red bytes in hexadecimal text."""
    return F.array_join(F.transform(pixels, lambda p: F.concat(_hex(p), _hex(255 - p), _hex(p * 7 % 256))), "")


def pixel_rows(spark: SparkSession, folder: str) -> DataFrame:
    pixel = F.transform("embedding", lambda v: F.floor(F.abs(v.cast("double")) * 1000).cast("bigint") % 256)
    return scan(spark, folder, "embeddings").select("vec_id", pixel.alias("pixels"))


def pictures(spark: SparkSession, folder: str) -> DataFrame:
    """(vec_id, image) with the fields of Spark's image source."""
    image = F.struct(
        F.concat(F.lit("img/"), F.col("vec_id").cast("string"), F.lit(".png")).alias("origin"),
        F.lit(SIDE).alias("height"),
        F.lit(SIDE).alias("width"),
        F.lit(3).alias("nChannels"),
        F.lit(16).alias("mode"),
        F.unhex(_bgr_hex(F.col("pixels"))).alias("data"),
    )
    return pixel_rows(spark, folder).select("vec_id", image.alias("image"))


def write_bitmaps(rows: DataFrame, path: str) -> None:
    """One bitmap file per number below ``path``, named by it; of rows with one number the first is written.

    The tasks write the files themselves, through Arrow's filesystems, into hidden folders of their own, which are renamed
    when they are full: a folder per picture would take the committer and the listing far longer than the pictures.
    """
    size = SIDE * SIDE * 3
    header = struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54 + size, 0, 0, 54, 40, SIDE, SIDE, 1, 24, 0, size, 2835, 2835, 0, 0)
    bottom_up = F.concat(*[F.slice("pixels", row * SIDE + 1, SIDE) for row in reversed(range(SIDE))])
    content = F.unhex(F.concat(F.lit(header.hex()), _bgr_hex(bottom_up)))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = rows.repartition(parts, "vec_id").select(F.col("vec_id").cast("string").alias("name"), content.alias("content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        store.create_dir(root, recursive=True)
        part, seen, hidden, folders = TaskContext.get().partitionId(), set(), "", 0
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if name in seen:
                    continue
                if len(seen) % FOLDER_FILES == 0:
                    if hidden:
                        _shown(store, hidden, f"{root}/part-{part:05d}-{folders:05d}")
                        folders += 1
                    hidden = f"{root}/_{uuid.uuid4().hex}"
                    store.create_dir(hidden)
                seen.add(name)
                with store.open_output_stream(f"{hidden}/{name}.bmp") as out:
                    out.write(b"\n" if content is None else content)  # a picture that is not known cannot be read either
        if hidden:
            _shown(store, hidden, f"{root}/part-{part:05d}-{folders:05d}")
        yield pa.RecordBatch.from_arrays([pa.array([len(seen)])], ["n"])

    files.mapInArrow(run, "n long").agg(F.sum("n")).collect()


def _shown(store: fs.FileSystem, hidden: str, folder: str) -> None:
    """Give a folder its name, unless another run of the task did."""
    if store.get_file_info(folder).type == fs.FileType.NotFound:
        store.move(hidden, folder)
    else:
        store.delete_dir(hidden)


PIXELS_SQL = """px AS (SELECT vec_id, i, CAST(floor(abs(CAST(embedding[i + 1] AS DOUBLE)) * 1000) AS BIGINT) % 256 AS p
         FROM embeddings, (SELECT unnest(generate_series(0, 63)) AS i))"""

QUALITY_SQL = f"""{PIXELS_SQL},
  gray AS (SELECT vec_id, i // 8 AS y, i % 8 AS x, p,
                  (p * 3735 + (255 - p) * 19235 + (p * 7 % 256) * 9798 + 16384) // 32768 AS g FROM px),
  lap AS (SELECT a.vec_id, a.p, a.g, u.g + d.g + l.g + r.g - 4 * a.g AS lap FROM gray a
          JOIN gray u ON u.vec_id = a.vec_id AND u.x = a.x AND u.y = abs(a.y - 1)
          JOIN gray d ON d.vec_id = a.vec_id AND d.x = a.x AND d.y = CASE a.y WHEN 7 THEN 6 ELSE a.y + 1 END
          JOIN gray l ON l.vec_id = a.vec_id AND l.y = a.y AND l.x = abs(a.x - 1)
          JOIN gray r ON r.vec_id = a.vec_id AND r.y = a.y AND r.x = CASE a.x WHEN 7 THEN 6 ELSE a.x + 1 END),
  quality AS (SELECT vec_id, 8 AS width, 8 AS height, 3 AS channels, 'BGR' AS color_mode,
                CAST(min(least(p, 255 - p, p * 7 % 256)) AS INTEGER) AS image_min_pixel,
                CAST(max(greatest(p, 255 - p, p * 7 % 256)) AS INTEGER) AS image_max_pixel,
                CAST(min(g) AS INTEGER) AS gray_image_min_pixel, CAST(max(g) AS INTEGER) AS gray_image_max_pixel,
                stddev_pop(g) AS contrast, avg(g) AS brightness, var_pop(lap) AS sharpness FROM lap GROUP BY vec_id)"""
MEASURED = ["contrast", "brightness", "sharpness"]
_ROUNDED = ", ".join(f"{r(m)} AS {m}" for m in MEASURED)


@case(
    "scan_images",
    f"""WITH {PIXELS_SQL} SELECT vec_id, 8 AS height, 8 AS width, 3 AS channels,
          string_agg(printf('%02X%02X%02X', p, 255 - p, p * 7 % 256), '' ORDER BY i) AS bytes FROM px GROUP BY vec_id""",
)
def scan_images(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(prepare(spark), "pictures")
    write_bitmaps(pixel_rows(spark, folder), path)
    found = read_images(spark, path)
    vec_id = F.substring_index(F.substring_index("main_image_path", "/", -1), ".", 1).try_cast("bigint")
    return found.select(
        vec_id.alias("vec_id"), "image.height", "image.width", F.col("image.nChannels").alias("channels"), F.hex("image.data").alias("bytes")
    )


@case("image_quality", f"WITH {QUALITY_SQL} SELECT * REPLACE ({_ROUNDED}) FROM quality")
def image_quality(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(images.image_quality(pictures(spark, folder), "vec_id"))


def _measures(spark: SparkSession, folder: str) -> DataFrame:
    """Measured once; profiles take several passes over the result, not over the pixels."""
    return save_scratch(images.image_quality(pictures(spark, folder), "vec_id"), "image-quality")


@case(
    "image_quality_profile",
    f"WITH {QUALITY_SQL}\n"
    + per_column(
        MEASURED,
        f"""{{name}} AS "column", count({{c}}) AS "count", {r("avg({c})")} AS mean, {r("stddev_samp({c})")} AS std,
            {r("min({c})")} AS min, {r("quantile_cont({c}, 0.25)")} AS q25, {r("quantile_cont({c}, 0.5)")} AS q50,
            {r("quantile_cont({c}, 0.75)")} AS q75, {r("max({c})")} AS max""",
        "quality",
    ),
)
def image_quality_profile(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.describe(_measures(spark, folder), MEASURED))


def _bins_sql(column: str) -> str:
    return f"""SELECT '{column}' AS "column", b AS bin, (SELECT count(*) FROM quality
        WHERE least(floor(({column} - e.lo) / (e.hi - e.lo) * 40), 39) = b) AS n
      FROM (SELECT min({column}) AS lo, max({column}) AS hi FROM quality) e, (SELECT unnest(generate_series(0, 39)) AS b)"""


@case("image_quality_histogram", f"WITH {QUALITY_SQL}\n" + "\nUNION ALL\n".join(_bins_sql(m) for m in MEASURED))
def image_quality_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return profile.histogram(_measures(spark, folder), MEASURED, 40).select("column", "bin", "n")


_METRICS = ["Bookmarks", "Likes", "Dislikes"]


@case(
    "image_quality_vs_metrics",
    with_tables(
        f"WITH {QUALITY_SQL},\n  both_ AS (SELECT * FROM quality JOIN poi ON id = 'poi-' || CAST(vec_id AS VARCHAR))\n"
        + "\nUNION ALL\n".join(
            f"""SELECT '{x}' AS x, '{y}' AS y, {r(f'corr({x}, CAST("{y}" AS DOUBLE))')} AS r FROM both_"""
            for x in MEASURED
            for y in _METRICS
        ),
        "poi",
    ),
)
def image_quality_vs_metrics(spark: SparkSession, folder: str) -> DataFrame:
    quality = images.image_quality(pictures(spark, folder), "vec_id")
    keyed = quality.withColumn("id", F.concat(F.lit("poi-"), F.col("vec_id").cast("string")))
    both = keyed.join(poi(spark, folder).select("id", *_METRICS), "id")
    return rounded(profile.correlations(both, [(x, y) for x in MEASURED for y in _METRICS]))
