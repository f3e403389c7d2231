"""Image measures from real files, and the model plans on little data."""

import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumbre.operators.images import image_quality
from lumbre.plans import models
from lumbre.sources.files import read_images
from lumbre.sources.tables import save_bucketed
from lumbre.workloads import pictures as cases


def png(path, pixels, color_type):
    """Write an array (height, width[, channels]) as a PNG file."""
    height, width = pixels.shape[:2]
    raw = b"".join(b"\0" + pixels[y].astype(np.uint8).tobytes() for y in range(height))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, color_type, 0, 0, 0)
    path.write_bytes(b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def by_hand(rgb):
    r, g, b = (rgb[:, :, i].astype(float) for i in range(3))
    gray = np.floor(0.299 * r + 0.587 * g + 0.114 * b + 0.5)
    h, w = gray.shape
    lap = np.zeros_like(gray)
    for y in range(h):
        for x in range(w):
            up, down = gray[abs(y - 1), x], gray[y + 1 if y + 1 < h else h - 2, x]
            left, right = gray[y, abs(x - 1)], gray[y, x + 1 if x + 1 < w else w - 2]
            lap[y, x] = up + down + left + right - 4 * gray[y, x]
    return gray, lap


def test_files(spark, tmp_path):
    rng = np.random.default_rng(1)
    color = rng.integers(0, 256, (7, 5, 3))
    shade = rng.integers(0, 256, (6, 6))
    folder = tmp_path / "img"
    (folder / "deep").mkdir(parents=True)
    png(folder / "c.png", color, 2)
    png(folder / "deep" / "g.png", shade, 0)
    found = read_images(spark, str(folder))
    got = {r["main_image_path"]: r for r in image_quality(found, "main_image_path").collect()}
    assert set(got) == {"c.png", "deep/g.png"}
    for name, rgb in (("c.png", color), ("deep/g.png", np.repeat(shade[:, :, None], 3, axis=2))):
        gray, lap = by_hand(rgb)
        row = got[name]
        assert (row["height"], row["width"], row["channels"], row["color_mode"]) == (*rgb.shape[:2], 3, "BGR")
        assert (row["image_min_pixel"], row["image_max_pixel"]) == (rgb.min(), rgb.max())
        assert row["brightness"] == pytest.approx(gray.mean(), abs=0.05)
        assert row["contrast"] == pytest.approx(gray.std(), rel=1e-3)
        assert row["sharpness"] == pytest.approx(lap.var(), rel=1e-3)


def test_unreadable_image_has_no_measures(spark):
    df = spark.createDataFrame(
        [("x", (-1, -1, -1, None)), ("y", (1, 1, 4, bytearray(b"\x0a\x14\x1e\xff")))],
        "id string, image struct<height:int,width:int,nChannels:int,data:binary>",
    )
    got = {r["id"]: r for r in image_quality(df, "id").collect()}
    assert got["x"]["brightness"] is None and got["x"]["width"] is None
    assert (got["y"]["channels"], got["y"]["image_max_pixel"], got["y"]["sharpness"]) == (3, 30, 0.0)


def test_kmeans_finds_separate_groups(spark):
    rows = [(10.0 * g + 0.01 * i, -5.0 * g + 0.01 * (i % 3)) for g in range(3) for i in range(20)]
    df = spark.createDataFrame(rows, "locationLon double, locationLat double")
    centres = sorted(models.fit_kmeans(df, 3, restarts=3).centres)
    assert [round(c[0], 2) for c in centres] == [0.1, 10.1, 20.1] or np.allclose([c[0] for c in centres], [0.095, 10.095, 20.095])
    costs = [r["training_cost"] for r in models.k_sweep(df, [2, 3, 4], restarts=2).collect()]
    assert costs == sorted(costs, reverse=True)


def test_boosted_trees_learn(spark, monkeypatch):
    monkeypatch.setattr(models, "TREES", 5)
    df = spark.range(200).select(
        (F.col("id") % 4).cast("double").alias("a"),
        (F.col("id") % 7).cast("double").alias("b"),
        (F.col("id") % 4 - 1).cast("int").alias("engagement_label"),
    )
    made = models.assemble(df, ["a", "b"])
    scored = models.fit_classifier(made).transform(made)
    assert scored.where("prediction = a").count() == 200
    fitted = models.fit_regressor(made, "a").transform(made)
    assert fitted.agg(F.max(F.abs(F.col("prediction") - F.col("a")))).first()[0] < 1.0


def test_bucketed_table_joins_without_shuffle(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") % 50).alias("ivr_id"), "id")
    for name in ("left_b", "right_b"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    left, right = (save_bucketed(df, name, 4, "ivr_id") for name in ("left_b", "right_b"))
    plan = left.hint("merge").join(right, "ivr_id")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    for name in ("left_b", "right_b"):
        spark.sql(f"DROP TABLE {name}")


def test_pictures_share_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cases, "FOLDER_FILES", 4)
    pixels = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: (i * (F.col("id") + 3)) % 256)
    rows = spark.range(30).select(F.col("id").alias("vec_id"), pixels.alias("pixels"))
    unknown = spark.sql("SELECT 77L AS vec_id, CAST(NULL AS ARRAY<BIGINT>) AS pixels UNION ALL SELECT NULL, transform(sequence(0, 63), i -> CAST(i AS BIGINT))")
    cases.write_bitmaps(rows.unionAll(rows).unionAll(unknown), str(tmp_path / "p"))
    folders = [f for f in (tmp_path / "p").iterdir()]
    assert all(f.name.startswith("part-") and 1 <= len(list(f.iterdir())) <= 4 for f in folders) and len(folders) < 16
    found = {r.main_image_path.split("/")[-1]: r.image for r in read_images(spark, str(tmp_path / "p")).collect()}
    assert set(found) == {*(f"{i}.bmp" for i in range(30)), "77.bmp", "None.bmp"} and found["77.bmp"].height == -1
    for i in range(30):
        p = [j * (i + 3) % 256 for j in range(64)]
        assert bytes(found[f"{i}.bmp"].data) == bytes(v for x in p for v in (x, 255 - x, x * 7 % 256))


def test_a_folder_that_another_run_named_stays(tmp_path):
    from pyarrow import fs

    for name in ("_one", "_two"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.bmp").write_text(name)
        cases._shown(fs.LocalFileSystem(), str(tmp_path / name), str(tmp_path / "part-00000-00000"))
    assert [f.name for f in tmp_path.iterdir()] == ["part-00000-00000"]
    assert (tmp_path / "part-00000-00000" / "a.bmp").read_text() == "_one"
