"""CSV and image files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumbre.functions import sets
from lumbre.session import prepare

#: Columns of a point-of-interest file; lists come as text.
POI_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("shortDescription", T.StringType()),
        T.StructField("categories", T.StringType()),
        T.StructField("tags", T.StringType()),
        T.StructField("main_image_path", T.StringType()),
        T.StructField("tier", T.IntegerType()),
        T.StructField("locationLon", T.DoubleType()),
        T.StructField("locationLat", T.DoubleType()),
        T.StructField("xps", T.IntegerType()),
        T.StructField("Visits", T.LongType()),
        T.StructField("Likes", T.LongType()),
        T.StructField("Dislikes", T.LongType()),
        T.StructField("Bookmarks", T.LongType()),
    ]
)

_QUOTING = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType, escaped: bool = False) -> DataFrame:
    """CSV with a header under a given schema.

    Quoted texts of a foreign file may hold line breaks, so such a file cannot be split and is read by one task. Files
    that ``write_csv`` made have their breaks escaped (``escaped``): they are cut into as many tasks as their size asks for.
    """
    rows = prepare(spark).read.schema(schema).options(**_QUOTING, multiLine=str(not escaped).lower()).csv(path)
    texts = [f.name for f in schema if isinstance(f.dataType, T.StringType)] if escaped else []
    return rows.withColumns({c: _unescaped(F.col(c)) for c in texts}) if texts else rows


#: Rows per file at most.
ROWS_PER_FILE = 200_000


def write_csv(df: DataFrame, path: str, escaped: bool = True) -> None:
    """CSV with a header; array columns become list literals. Each task writes files of bounded length.

    Line breaks and backslashes of texts are escaped (``\\n``, ``\\r``, ``\\\\``), so that a line is a row. Without
    ``escaped`` they stand as they are, in quotes, for readers that expect them so.
    """
    texts = {f.name: F.col(f.name) for f in df.schema if isinstance(f.dataType, T.StringType)}
    texts |= {f.name: sets.literal(F.col(f.name)) for f in df.schema if isinstance(f.dataType, T.ArrayType)}
    out = df.withColumns({c: _escaped(x) if escaped else x for c, x in texts.items()}) if texts else df
    out.write.mode("overwrite").options(**_QUOTING).option("maxRecordsPerFile", ROWS_PER_FILE).csv(path)


def _escaped(text: Column) -> Column:
    for plain, written in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        text = F.replace(text, F.lit(plain), F.lit(written))
    return text


def _unescaped(text: Column) -> Column:
    """Pairs of backslashes cut the text; between them a backslash stands for a break with the letter after it."""

    def breaks(part: Column) -> Column:
        return F.replace(F.replace(part, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r"))

    cut = F.array_join(F.transform(F.split(text, r"\\\\"), breaks), "\\")
    return F.when(F.contains(text, F.lit("\\")), cut).otherwise(text)  # most texts have none


def read_images(spark: SparkSession, folder: str) -> DataFrame:
    """(main_image_path relative to ``folder``, image) of every image below it."""
    images = prepare(spark).read.format("image").option("recursiveFileLookup", "true").load(folder)
    # origins carry a scheme that the given folder may leave out
    below = folder.split(":", 1)[-1].rstrip("/") + "/"
    relative = F.substring_index(F.col("image.origin"), below, -1)
    return images.select(relative.alias("main_image_path"), "image")
