"""Registered cases on points of interest: cleaning, sets, engagement, splits, preprocessing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbre.functions import engagement as E
from lumbre.functions import sets
from lumbre.operators import entities, geo, joins, profile, split
from lumbre.plans import poi as plan
from lumbre.session import prepare, scratch_path
from lumbre.sources.files import POI_SCHEMA, read_csv, write_csv
from lumbre.sources.tables import save_scratch, scan
from lumbre.workloads.registry import case
from lumbre.workloads.standins import poi, poi_engaged, poi_raw, poi_rows, poi_stage, with_tables
from lumbre.workloads.support import flat, r, rounded

LIST = "array_to_string({}, ',')"
POI_FLAT = """id, name, "shortDescription", array_to_string(categories, ',') AS categories,
       array_to_string(tags, ',') AS tags, main_image_path, tier, round("locationLon", 6) AS "locationLon",
       round("locationLat", 6) AS "locationLat", xps, "Visits", "Likes", "Dislikes", "Bookmarks" """
METRIC_LIST = '"Visits", "Likes", "Dislikes", "Bookmarks"'

# ---------------------------------------------------------------- files and saves


@case("scan_csv", with_tables(f"SELECT {POI_FLAT} FROM poi_rows", "poi_rows"))
def scan_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(prepare(spark), "poi_raw_csv")
    write_csv(poi_raw(spark, folder).drop("ord"), path)
    rows = entities.parse_sets(read_csv(spark, path, POI_SCHEMA, escaped=True), "categories", "tags")
    return rounded(flat(rows))


@case("sink_csv", with_tables(f"SELECT {POI_FLAT} FROM poi", "poi"))
def sink_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(prepare(spark), "poi_clean_csv")
    write_csv(poi(spark, folder), path)
    rows = entities.parse_sets(read_csv(spark, path, POI_SCHEMA, escaped=True), "categories", "tags")
    return rounded(flat(rows))


@case("sink_checkpoint", with_tables(f"SELECT {POI_FLAT} FROM poi", "poi"))
def sink_checkpoint(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(flat(save_scratch(poi(spark, folder), "poi_clean")))


# ---------------------------------------------------------------- filters and projections


@case(
    "filter_conjunction",
    with_tables(
        f"""SELECT id, ord, {METRIC_LIST} FROM poi_rows
            WHERE len(tags) <= 1 AND "Likes" + "Dislikes" > "Visits" - 6000""",
        "poi_rows",
    ),
)
def filter_conjunction(spark: SparkSession, folder: str) -> DataFrame:
    # The stand-in's visits are far above its reactions, hence the shifted bound.
    reactions = F.col("Likes") + F.col("Dislikes")
    rows = poi_rows(spark, folder).where((sets.size_or_zero(F.col("tags")) <= 1) & (reactions > F.col("Visits") - 6000))
    return rows.select("id", "ord", *plan.METRICS)


@case(
    "filter_derived_compare",
    with_tables('SELECT count(*) AS n FROM poi WHERE "Bookmarks" > "Likes" + "Dislikes"', "poi"),
)
def filter_derived_compare(spark: SparkSession, folder: str) -> DataFrame:
    return profile.count_where(poi(spark, folder), n=F.col("Bookmarks") > F.col("Likes") + F.col("Dislikes"))


@case("filter_equals", with_tables(f"SELECT {POI_FLAT} FROM poi WHERE name = 'red widget'", "poi"))
def filter_equals(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(flat(poi(spark, folder).where(F.col("name") == "red widget")))


@case(
    "filter_empty_array",
    with_tables(
        """SELECT id, name, count(*) OVER () AS n_empty FROM poi WHERE len(categories) = 0 ORDER BY id LIMIT 5""", "poi"
    ),
)
def filter_empty_array(spark: SparkSession, folder: str) -> DataFrame:
    # Count of all empty rows next to the first five of them.
    rows = poi(spark, folder)
    empty = rows.where(sets.size_or_zero(F.col("categories")) == 0).select("id", "name")
    count = empty.agg(F.count(F.lit(1)).alias("n_empty"))
    return profile.head(empty, "id", 5).withColumn("n_empty", count.scalar())


@case(
    "filter_in_subset",
    with_tables(
        "SELECT id, ord, xps FROM poi_rows WHERE id IN (SELECT id FROM poi_rows GROUP BY id HAVING count(*) > 1)",
        "poi_rows",
    ),
)
def filter_in_subset(spark: SparkSession, folder: str) -> DataFrame:
    rows = poi_rows(spark, folder).select("id", "ord", "xps")
    keys = rows.groupBy("id").count().where("count > 1")
    return joins.keep_matching(rows, keys, ["id"])


def _box_sql(low: float, high: float) -> str:
    return f"""SELECT id, '{low}' AS box FROM poi, (SELECT
      quantile_cont("locationLon", {low}) AS x0, quantile_cont("locationLon", {high}) AS x1,
      quantile_cont("locationLat", {low}) AS y0, quantile_cont("locationLat", {high}) AS y1 FROM poi)
      WHERE "locationLon" BETWEEN x0 - 1e-12 AND x1 + 1e-12 AND "locationLat" BETWEEN y0 - 1e-12 AND y1 + 1e-12"""


@case("filter_quantile_box", with_tables(f"{_box_sql(0.1, 0.9)} UNION ALL {_box_sql(0.25, 0.75)}", "poi"))
def filter_quantile_box(spark: SparkSession, folder: str) -> DataFrame:
    rows = poi_stage(spark, folder)
    boxes = [
        profile.inside_quantiles(rows, ["locationLon", "locationLat"], low, high).select("id", F.lit(str(low)).alias("box"))
        for low, high in ((0.1, 0.9), (0.25, 0.75))
    ]
    return boxes[0].unionByName(boxes[1])


@case("project_drop", with_tables(f"SELECT id, name, {METRIC_LIST} FROM poi", "poi"))
def project_drop(spark: SparkSession, folder: str) -> DataFrame:
    dropped = ("shortDescription", "categories", "tags", "main_image_path", "tier", "locationLon", "locationLat", "xps")
    return poi(spark, folder).drop(*dropped)


@case(
    "project_assign",
    with_tables(
        "SELECT CAST(len(tags) AS INTEGER) AS num_tags, CAST(len(categories) AS INTEGER) AS num_categories FROM poi",
        "poi",
    ),
)
def project_assign(spark: SparkSession, folder: str) -> DataFrame:
    counts = {
        "num_tags": sets.size_or_zero(F.col("tags")),
        "num_categories": sets.size_or_zero(F.col("categories")),
    }
    return poi(spark, folder).withColumns(counts).select(*counts)


@case(
    "map_label",
    with_tables(
        """SELECT id, engagement_label, CASE engagement_label WHEN -1 THEN 0 WHEN 0 THEN 1 WHEN 1 THEN 2
                  WHEN 2 THEN 3 END AS label_class FROM poi_engaged""",
        "poi_engaged",
    ),
)
def map_label(spark: SparkSession, folder: str) -> DataFrame:
    rows = poi_engaged(spark, folder)
    return rows.select("id", "engagement_label", E.label_class(F.col("engagement_label")).alias("label_class"))


# ---------------------------------------------------------------- duplicates and merging


@case(
    "duplicated_all",
    with_tables(
        "SELECT id, ord, xps FROM poi_rows QUALIFY count(*) OVER (PARTITION BY id) > 1",
        "poi_rows",
    ),
)
def duplicated_all(spark: SparkSession, folder: str) -> DataFrame:
    return entities.duplicated(poi_rows(spark, folder).select("id", "ord", "xps"), ["id"])


@case("dedupe_keep_first", with_tables(f"SELECT {POI_FLAT}, ord FROM poi_rows QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1", "poi_rows"))
def dedupe_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(flat(entities.keep_first(poi_rows(spark, folder), ["id"], ["ord"])))


@case(
    "group_mean_rounded",
    with_tables(
        'SELECT id, CAST(round_even(avg("Likes"), 0) AS BIGINT) AS "Likes" FROM poi_rows GROUP BY id', "poi_rows"
    ),
)
def group_mean_rounded(spark: SparkSession, folder: str) -> DataFrame:
    return poi_rows(spark, folder).groupBy("id").agg(entities.rounded_mean("Likes").alias("Likes"))


@case(
    "group_union_sets",
    with_tables(
        """SELECT id, array_to_string(list_sort(list_distinct(flatten(list(tags)))), ',') AS tags
           FROM poi_rows GROUP BY id""",
        "poi_rows",
    ),
)
def group_union_sets(spark: SparkSession, folder: str) -> DataFrame:
    return flat(entities.union_of_sets(poi_rows(spark, folder), "id", "tags"))


@case("merge_duplicates", with_tables(f"SELECT {POI_FLAT} FROM poi", "poi"))
def merge_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(flat(poi(spark, folder)))


@case(
    "merge_left_update",
    with_tables(
        f"""WITH agg AS (SELECT id, list_sort(list_distinct(flatten(list(tags)))) AS tags,
                                {", ".join(f'avg("{m}") AS "{m}"' for m in plan.METRICS)}
                         FROM poi_rows GROUP BY id HAVING count(*) > 1)
            SELECT p.id, p.ord, array_to_string(coalesce(agg.tags, p.tags), ',') AS tags, {", ".join(
                f'coalesce(CAST(round_even(agg."{m}", 0) AS BIGINT), p."{m}") AS "{m}"' for m in plan.METRICS)}
            FROM poi_rows p LEFT JOIN agg ON p.id = agg.id""",
        "poi_rows",
    ),
)
def merge_left_update(spark: SparkSession, folder: str) -> DataFrame:
    rows = poi_rows(spark, folder).select("id", "ord", "tags", *plan.METRICS)
    united = entities.union_of_sets(rows, "id", "tags")
    means = (
        rows.groupBy("id")
        .agg(F.count(F.lit(1)).alias("n"), *[F.avg(m).alias(m) for m in plan.METRICS])
        .where("n > 1")
        .join(united, "id")
    )
    return flat(joins.update_from(rows, means, "id", ["tags", *plan.METRICS]))


@case(
    "join_columns_by_key",
    with_tables(
        f"""SELECT p.id, p.tier, {", ".join(f'e."{c}"' for c in E.CATEGORIES)}
            FROM poi p JOIN poi_engaged e ON p.id = e.id""",
        "poi_engaged",
    ),
)
def join_columns_by_key(spark: SparkSession, folder: str) -> DataFrame:
    one_hot = poi_engaged(spark, folder).select("id", *E.CATEGORIES)
    return poi(spark, folder).select("id", "tier").join(one_hot, "id")


# ---------------------------------------------------------------- sets


@case(
    "set_difference",
    with_tables(
        """SELECT DISTINCT member FROM (SELECT unnest(categories) AS member FROM poi_rows)
           EXCEPT SELECT DISTINCT unnest(list_append(tags, CASE WHEN tags[1] = 'A' THEN categories[1] END)) AS member
           FROM poi_rows WHERE tier = 2""",
        "poi_rows",
    ),
)
def set_difference(spark: SparkSession, folder: str) -> DataFrame:
    # Categories never used as a tag; some rows of one tier carry their first category as a tag too.
    rows = poi_rows(spark, folder)
    first = F.when(F.get("tags", F.lit(0)) == "A", F.get("categories", F.lit(0)))
    tagged = rows.where("tier = 2").withColumn("tags", F.array_append("tags", first))
    return profile.elements(rows, "categories").subtract(profile.elements(tagged, "tags"))


@case(
    "set_union_rows",
    with_tables("SELECT DISTINCT member FROM (SELECT unnest(categories) AS member FROM poi)", "poi"),
)
def set_union_rows(spark: SparkSession, folder: str) -> DataFrame:
    return profile.elements(poi(spark, folder), "categories")


@case(
    "list_to_set",
    """SELECT doc_id, array_to_string(list_sort(list_distinct(string_split(lang || ',' || source || ',' || lang, ','))), ',')
              AS members FROM documents""",
)
def list_to_set(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan(spark, folder, "documents")
    return flat(rows.select("doc_id", sets.to_set(F.array("lang", "source", "lang")).alias("members")))


@case(
    "parse_list_literal",
    with_tables(
        f"SELECT id, ord, {LIST.format('categories')} AS categories, {LIST.format('tags')} AS tags FROM poi_rows",
        "poi_rows",
    ),
)
def parse_list_literal(spark: SparkSession, folder: str) -> DataFrame:
    return flat(poi_rows(spark, folder).select("id", "ord", "categories", "tags"))


@case(
    "normalize_to_set",
    with_tables(
        """SELECT id, ord, array_to_string(categories, ',') AS categories, name AS names FROM poi_rows""",
        "poi_rows",
    ),
)
def normalize_to_set(spark: SparkSession, folder: str) -> DataFrame:
    raw = poi_raw(spark, folder)
    names = sets.normalize_to_set(F.col("name"))
    return flat(raw.select("id", "ord", sets.normalize_to_set(F.col("categories")).alias("categories"), names.alias("names")))


@case(
    "array_size",
    with_tables(
        """SELECT id, CAST(len(categories) AS INTEGER) AS categories_count, CAST(len(tags) AS INTEGER) AS tags_count
           FROM poi""",
        "poi",
    ),
)
def array_size(spark: SparkSession, folder: str) -> DataFrame:
    return plan.add_counts(poi(spark, folder)).select("id", "categories_count", "tags_count")


@case(
    "explode_array",
    with_tables(
        """SELECT id, unnest(CASE WHEN len(categories) = 0 THEN [NULL] ELSE categories END) AS category, "Likes"
           FROM poi""",
        "poi",
    ),
)
def explode_array(spark: SparkSession, folder: str) -> DataFrame:
    return poi(spark, folder).select("id", F.explode_outer("categories").alias("category"), "Likes")


@case(
    "multi_hot",
    with_tables(f"SELECT id, {', '.join(chr(34) + c + chr(34) for c in E.CATEGORIES)} FROM poi_engaged", "poi_engaged"),
)
def multi_hot(spark: SparkSession, folder: str) -> DataFrame:
    return poi_engaged(spark, folder).select("id", *E.CATEGORIES)


# ---------------------------------------------------------------- engagement


@case(
    "engagement_signals",
    with_tables(f"""SELECT id, {r('"C"')} AS "C", {r('"S"')} AS "S", {r('"V"')} AS "V" FROM poi_engaged""", "poi_engaged"),
)
def engagement_signals(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(plan.add_engagement(poi(spark, folder)).select("id", "C", "S", "V"))


@case("engagement_score", with_tables(f"""SELECT id, {r('"E"')} AS "E" FROM poi_engaged""", "poi_engaged"))
def engagement_score(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(plan.add_engagement(poi(spark, folder)).select("id", "E"))


LABEL_SQL = with_tables("SELECT id, engagement_label FROM poi_engaged", "poi_engaged")


@case("engagement_label", LABEL_SQL)
def engagement_label(spark: SparkSession, folder: str) -> DataFrame:
    return plan.add_engagement(poi(spark, folder)).select("id", "engagement_label")


@case("udf_row_label", LABEL_SQL)
def udf_row_label(spark: SparkSession, folder: str) -> DataFrame:
    # The row function as a SQL function over named arguments; no Python per row.
    prepare(spark).sql(f"CREATE OR REPLACE TEMPORARY FUNCTION assign_label(c DOUBLE, s DOUBLE) RETURNS INT RETURN {E.LABEL_SQL}")
    rows = plan.add_engagement(poi(spark, folder)).drop("engagement_label")
    return rows.select("id", F.expr("assign_label(C, S)").alias("engagement_label"))


@case(
    "sigmoid",
    with_tables(
        f"""SELECT id, {r("1 / (1 + exp(-(0.001::DOUBLE * x - 4)))")} AS logistic,
                   {r("2 * (1 / (1 + exp(-(0.0005::DOUBLE * x)))) - 1")} AS centred
            FROM (SELECT id, "Likes" + "Dislikes" AS x FROM poi)""",
        "poi",
    ),
)
def sigmoid(spark: SparkSession, folder: str) -> DataFrame:
    x = F.col("Likes") + F.col("Dislikes")
    return rounded(
        poi(spark, folder).select(
            "id", E.sigmoid(x, 0.001, -4.0).alias("logistic"), E.centred_sigmoid(x, 0.0005).alias("centred")
        )
    )


MINMAX_SQL = with_tables(
    f"SELECT id, {r('(tier - 1) / 3::DOUBLE')} AS tier_norm, {r('xps / 1000::DOUBLE')} AS xps_norm FROM poi", "poi"
)


@case("minmax_fixed", MINMAX_SQL)
def minmax_fixed(spark: SparkSession, folder: str) -> DataFrame:
    rows = poi(spark, folder)
    return rounded(rows.select("id", E.tier_norm(F.col("tier")).alias("tier_norm"), E.xps_norm(F.col("xps")).alias("xps_norm")))


@case("udf_normalize_features", MINMAX_SQL)
def udf_normalize_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(poi(spark, folder).transform(plan.normalize_features).select("id", "tier_norm", "xps_norm"))


#: A train split both engines can draw: four of five tiers and points.
TRAIN_SQL = "CAST(split_part(id, '-', 2) AS BIGINT) % 5 <> 0"


def _train(df: DataFrame) -> DataFrame:
    return df.where(F.expr(TRAIN_SQL))


ZSCORE_SQL = with_tables(
    f"""WITH t AS (SELECT avg("locationLon") AS mx, stddev_samp("locationLon") AS sx,
                          avg("locationLat") AS my, stddev_samp("locationLat") AS sy FROM poi WHERE {TRAIN_SQL})
        SELECT id, {r('("locationLon" - mx) / sx')} AS "locationLon_norm",
               {r('("locationLat" - my) / sy')} AS "locationLat_norm" FROM poi, t""",
    "poi",
)


@case("zscore_from_train", ZSCORE_SQL)
def zscore_from_train(spark: SparkSession, folder: str) -> DataFrame:
    # Lazy form: the train statistics enter as one scalar subquery. Both passes read the saved rows.
    rows = save_scratch(poi(spark, folder).select("id", "locationLon", "locationLat"), "poi-places")
    both = ("locationLon", "locationLat")
    stats = [f(c).alias(f"{name}_{c}") for c in both for name, f in (("mean", F.avg), ("std", F.stddev_samp))]
    known = _train(rows).agg(F.struct(*stats).alias("stats")).scalar()
    normed = [E.z_score(F.col(c), known[f"mean_{c}"], known[f"std_{c}"]).alias(f"{c}_norm") for c in both]
    return rounded(rows.select("id", *normed))


@case("udf_normalize_coordinates", ZSCORE_SQL)
def udf_normalize_coordinates(spark: SparkSession, folder: str) -> DataFrame:
    # Fitted form: one row of statistics is taken to the driver and applied as constants.
    rows = poi_stage(spark, folder)
    s = plan.fit_stats(_train(rows), CENTRES)
    normed = rows.transform(plan.normalize_coordinates, s.lon_mean, s.lon_std, s.lat_mean, s.lat_std)
    return rounded(normed.select("id", "locationLon_norm", "locationLat_norm"))


@case(
    "deg2rad",
    with_tables(
        f"""SELECT id, {r('radians("locationLon")', 9)} AS lon_rad, {r('radians("locationLat")', 9)} AS lat_rad
            FROM poi""",
        "poi",
    ),
)
def deg2rad(spark: SparkSession, folder: str) -> DataFrame:
    rows = poi(spark, folder)
    both = rows.select("id", F.radians("locationLon").alias("lon_rad"), F.radians("locationLat").alias("lat_rad"))
    return rounded(both, digits=9)


# ---------------------------------------------------------------- centres and preprocessing

#: Centres both engines can use, standing for fitted ones.
CENTRES = [[round(-3.65 + 0.1 * i, 4), round(40.45 + 0.1 * (i * 7 % 10), 4)] for i in range(10)]
CENTRES_SQL = "centres(i, x, y) AS (VALUES " + ", ".join(
    f"({i}, CAST({x} AS DOUBLE), CAST({y} AS DOUBLE))" for i, (x, y) in enumerate(CENTRES)
) + ")"
DISTANCE_SQL = 'sqrt(("locationLon" - x) * ("locationLon" - x) + ("locationLat" - y) * ("locationLat" - y))'
LONG_DISTANCES_SQL = with_tables(
    f"WITH {CENTRES_SQL} SELECT id, i AS centre, {r(DISTANCE_SQL)} AS distance FROM poi, centres", "poi"
)


@case("join_centroids", LONG_DISTANCES_SQL)
def join_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(geo.long_distances(poi(spark, folder), "id", CENTRES))


@case(
    "euclid_distance",
    with_tables(
        f"""WITH {CENTRES_SQL} SELECT id, {r(DISTANCE_SQL)} AS distance FROM poi, centres WHERE i = 0""", "poi"
    ),
)
def euclid_distance(spark: SparkSession, folder: str) -> DataFrame:
    d = E.distance(F.col("locationLon"), F.col("locationLat"), CENTRES[0])
    return rounded(poi(spark, folder).select("id", d.alias("distance")))


@case(
    "assign_clusters",
    with_tables(
        f"""WITH {CENTRES_SQL} SELECT id, arg_min(i, ({DISTANCE_SQL}, i)) AS geo_cluster FROM poi, centres GROUP BY id""",
        "poi",
    ),
)
def assign_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return geo.nearest_centre(poi(spark, folder), CENTRES).select("id", "geo_cluster")


_NORMED = ", ".join(
    f"max(CASE WHEN i = {i} THEN {r('(d - m) / s')} END) AS dist_centroid_{i}" for i in range(len(CENTRES))
)
_NORMED_SQL = f"""WITH {CENTRES_SQL},
  far AS (SELECT id, i, {DISTANCE_SQL} AS d FROM poi, centres),
  stats AS (SELECT i, avg(d) AS m, stddev_samp(d) AS s FROM far WHERE {TRAIN_SQL} GROUP BY i)"""


@case(
    "centroid_distances",
    with_tables(f"{_NORMED_SQL} SELECT id, {_NORMED} FROM far JOIN stats USING (i) GROUP BY id", "poi"),
)
def centroid_distances(spark: SparkSession, folder: str) -> DataFrame:
    rows = poi_stage(spark, folder)
    s = plan.fit_stats(_train(rows), CENTRES)
    far = geo.centre_distances(rows, s.centres, s.dist_mean, s.dist_std)
    return rounded(far.select("id", *[f"dist_centroid_{i}" for i in range(len(CENTRES))]))


PREPROCESSED_BODY = f"""{_NORMED_SQL},
      wide AS (SELECT id, {_NORMED} FROM far JOIN stats USING (i) GROUP BY id),
      t AS (SELECT avg("locationLon") AS mx, stddev_samp("locationLon") AS sx,
                   avg("locationLat") AS my, stddev_samp("locationLat") AS sy FROM poi WHERE {TRAIN_SQL})
    SELECT wide.*, {r('(tier - 1) / 3::DOUBLE')} AS tier_norm, {r('xps / 1000::DOUBLE')} AS xps_norm,
           {r('("locationLon" - mx) / sx')} AS "locationLon_norm", {r('("locationLat" - my) / sy')} AS "locationLat_norm"
    FROM poi JOIN wide USING (id), t"""
PREPROCESSED_SQL = with_tables(PREPROCESSED_BODY, "poi")
_PREPROCESSED = ["id", *plan.FEATURES[:4], *[f"dist_centroid_{i}" for i in range(len(CENTRES))]]


@case("apply_preprocessing", PREPROCESSED_SQL)
def apply_preprocessing(spark: SparkSession, folder: str) -> DataFrame:
    rows = poi_stage(spark, folder)
    stats = plan.fit_stats(_train(rows), CENTRES)
    return rounded(plan.preprocess(plan.preprocess(rows, stats), stats).select(*_PREPROCESSED))


@case("sink_stats", PREPROCESSED_SQL)
def sink_stats(spark: SparkSession, folder: str) -> DataFrame:
    # Statistics are saved, loaded again and used.
    rows = poi_stage(spark, folder)
    path = scratch_path(prepare(spark), "stats")
    plan.fit_stats(_train(rows), CENTRES).save(spark, path)
    return rounded(plan.preprocess(rows, plan.Stats.load(spark, path)).select(*_PREPROCESSED))


# ---------------------------------------------------------------- splits

_SIZES = """counts AS (SELECT engagement_label AS label, count(*) AS n FROM poi_engaged GROUP BY 1),
  t0 AS (SELECT *, ceil(0.15::DOUBLE * sum(n) OVER ()) * n / sum(n) OVER () AS x,
                ceil(0.15::DOUBLE * sum(n) OVER ()) AS take FROM counts),
  t1 AS (SELECT label, n, floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, label::VARCHAR)
                <= take - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS test FROM t0),
  v0 AS (SELECT *, ceil(0.15::DOUBLE * sum(n - test) OVER ()) * (n - test) / sum(n - test) OVER () AS x,
                ceil(0.15::DOUBLE * sum(n - test) OVER ()) AS take FROM t1),
  v1 AS (SELECT label, n, test, floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, label::VARCHAR)
                <= take - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS val FROM v0),
  sizes AS (SELECT 'test' AS split, label, test AS n FROM v1 UNION ALL SELECT 'val', label, val FROM v1
            UNION ALL SELECT 'train', label, n - test - val FROM v1)"""


@case(
    "split_report",
    with_tables(
        f"""WITH {_SIZES} SELECT split, label, CAST(n AS BIGINT) AS n, {r("n / sum(n) OVER (PARTITION BY split)")} AS share
            FROM sizes WHERE n > 0""",
        "poi_engaged",
    ),
)
def split_report(spark: SparkSession, folder: str) -> DataFrame:
    rows = save_scratch(poi_engaged(spark, folder).select("id", "engagement_label"), "poi-labels")
    return rounded(split.split_report(split.stratified_split(rows, "id", "engagement_label"), "engagement_label"))


#: The split of every row: hash order within the label, cut at the sizes above.
SPLIT_SQL = f"""WITH {_SIZES},
  placed AS (SELECT id, engagement_label, row_number() OVER (PARTITION BY engagement_label ORDER BY
               ('0x' || substr(md5(id || '#42'), 1, 15))::BIGINT, id) AS place FROM poi_engaged)
SELECT id, engagement_label,
       CASE WHEN place <= test THEN 'test' WHEN place <= test + val THEN 'val' ELSE 'train' END AS split
FROM placed JOIN v1 ON engagement_label = label"""


@case("stratified_split", with_tables(SPLIT_SQL, "poi_engaged"))
def stratified_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = save_scratch(poi_engaged(spark, folder).select("id", "engagement_label"), "poi-labels")
    return split.stratified_split(rows, "id", "engagement_label")
