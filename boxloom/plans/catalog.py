"""Registered queries: name -> (spark, folder of tables) -> DataFrame, and their SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import functions as F

from boxloom.functions import images as I
from boxloom.functions import text as T
from boxloom.operators import audit as Q
from boxloom.operators import boxes as B
from boxloom.operators import classes as C
from boxloom.operators import duplicates as D
from boxloom.operators import evaluate as E
from boxloom.operators import metadata as M
from boxloom.operators import profile as P
from boxloom.operators import ranks as N
from boxloom.operators import release as R
from boxloom.operators import sampling as S
from boxloom.operators import splits as X
from boxloom.operators import tracks as K
from boxloom.sources import adapters as A
from boxloom.sources import readers as L
from boxloom.sources.adapters import with_tables
from boxloom.sources.scratch import new_path
from boxloom.streaming import alerts as W

QUERIES: dict = {}
SQL: dict = {}

#: Stop-alert parameters for the adapter's tracks: one frame is one second.
STOP_RULES = K.StopRules(stop_speed=3, resume_speed=5, stop_seconds=24, resume_seconds=10, window=48, max_gap=24, fps=1)
POLYGON = [(100.0, 50.0), (800.0, 80.0), (900.0, 500.0), (300.0, 400.0)]
HOMOGRAPHY = [0.02, 0.001, 1.5, 0.0005, 0.03, -2.0, 0.0001, 0.0002]


def query(sql: str | None = None, *tables: str):
    """Register a function under its name, with SQL over the domain tables that it names."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = with_tables(sql, *tables) if tables else sql.strip()
        return f

    return add


_VALID = """v AS (SELECT *, list_filter([
        CASE WHEN xmin < 0 OR ymin < 0 THEN 'NEGATIVE_COORDINATE' END, CASE WHEN xmax <= xmin OR ymax <= ymin THEN 'NON_POSITIVE_SIZE' END,
        CASE WHEN xmax > width THEN 'X_OUT_OF_BOUNDS' END, CASE WHEN ymax > height THEN 'Y_OUT_OF_BOUNDS' END], lambda x: x IS NOT NULL) AS issues FROM boxes_raw)"""
A.SQL["v"] = _VALID
A.SQL["clip"] = """clip AS (SELECT *, greatest(xmin, 0.0) AS cx0, greatest(ymin, 0.0) AS cy0, least(xmax, width::DOUBLE) AS cx1, least(ymax, height::DOUBLE) AS cy1,
    concat_ws('|', CASE WHEN xmin < 0 THEN 'LEFT_BOUNDARY_CLIPPED' END, CASE WHEN ymin < 0 THEN 'TOP_BOUNDARY_CLIPPED' END,
        CASE WHEN xmax > width THEN 'RIGHT_BOUNDARY_CLIPPED' END, CASE WHEN ymax > height THEN 'BOTTOM_BOUNDARY_CLIPPED' END) AS clip_adjustments FROM v)"""
A.SQL["lb"] = """lb AS (SELECT *, (xmax - xmin) * s AS lb_w, (ymax - ymin) * s AS lb_h, (xmax - xmin) * (ymax - ymin) / (width * height) AS area_ratio
    FROM (SELECT *, least(320.0 / width, 320.0 / height)::DOUBLE AS s FROM clip))"""
A.SQL["cat"] = """cat AS (SELECT *, CASE WHEN least(lb_w, lb_h) < 4 THEN 'EXTREMELY_TINY' WHEN least(lb_w, lb_h) < 8 THEN 'VERY_SMALL'
    WHEN least(lb_w, lb_h) < 16 THEN 'SMALL' ELSE 'USABLE' END AS lb_category,
    CASE WHEN area_ratio < 0.001 THEN 'SMALL' WHEN area_ratio < 0.02 THEN 'MEDIUM' ELSE 'LARGE' END AS size_category FROM lb)"""
_BOX = ("images", "boxes_raw", "v", "clip", "lb", "cat")


# ---- boxes, row by row


@query("SELECT image_id, annotation_id, array_to_string(issues, '|') AS issues, len(issues) = 0 AS is_valid FROM v", *_BOX[:3])
def box_validate(spark, d):
    return B.box_validate(A.boxes_raw(spark, d)).select("image_id", "annotation_id", F.array_join("issues", "|").alias("issues"), "is_valid")


@query("SELECT image_id, annotation_id, unnest(issues) AS issue FROM v", *_BOX[:3])
def box_issues_long(spark, d):
    return B.box_issues_long(A.boxes_raw(spark, d)).select("image_id", "annotation_id", "issue")


@query("SELECT image_id, annotation_id, cx0, cy0, cx1, cy1, clip_adjustments, clip_adjustments <> '' AS clip_applied, cx1 > cx0 AND cy1 > cy0 AS visible FROM clip", *_BOX[:4])
def box_clip(spark, d):
    return B.box_clip(A.boxes_raw(spark, d)).select("image_id", "annotation_id", "cx0", "cy0", "cx1", "cy1", "clip_adjustments", "clip_applied", "visible")


@query("""SELECT image_id, annotation_id, area_ratio, size_category,
    CASE WHEN area_ratio < 0.001 THEN 'FAR' WHEN area_ratio < 0.02 THEN 'MEDIUM' ELSE 'NEAR' END AS distance_proxy FROM cat""", *_BOX)
def box_geometry(spark, d):
    return B.box_geometry(A.boxes_raw(spark, d)).select("image_id", "annotation_id", "area_ratio", "size_category", "distance_proxy")


@query("SELECT image_id, annotation_id, lb_w, lb_h, lb_w * lb_h AS lb_area, lb_category FROM cat", *_BOX)
def letterbox_metrics(spark, d):
    return B.letterbox_metrics(A.boxes_raw(spark, d)).select("image_id", "annotation_id", "lb_w", "lb_h", "lb_area", "lb_category")


@query("""SELECT image_id, annotation_id, CASE WHEN s < 25 THEN '<25' WHEN s < 50 THEN '25–49' ELSE '≥50' END AS size_group
    FROM (SELECT *, least(xmax - xmin, ymax - ymin) * least(640.0::DOUBLE / width, 480.0::DOUBLE / height) AS s FROM boxes_raw)""", *_BOX[:2])
def device_size_group(spark, d):
    return B.device_size_group(A.boxes_raw(spark, d)).select("image_id", "annotation_id", "size_group")


@query("""SELECT image_id, annotation_id, printf('0 %.8f %.8f %.8f %.8f', (cx0 + cx1) / 2 / width, (cy0 + cy1) / 2 / height, (cx1 - cx0) / width, (cy1 - cy0) / height) AS label_line
    FROM clip WHERE cx1 > cx0 AND cy1 > cy0""", *_BOX[:4])
def yolo_normalize(spark, d):
    return B.yolo_normalize(B.box_clip(A.boxes_raw(spark, d)).where("visible")).select("image_id", "annotation_id", "label_line")


@query("""SELECT image_id, annotation_id, round((x - w / 2) * width, 3) AS px0, round((y - h / 2) * height, 3) AS py0, round((x + w / 2) * width, 3) AS px1, round((y + h / 2) * height, 3) AS py1
    FROM (SELECT *, round((cx0 + cx1) / 2 / width, 8) AS x, round((cy0 + cy1) / 2 / height, 8) AS y, round((cx1 - cx0) / width, 8) AS w, round((cy1 - cy0) / height, 8) AS h FROM clip WHERE cx1 > cx0 AND cy1 > cy0)""", *_BOX[:4])
def yolo_denormalize(spark, d):
    lines = B.yolo_normalize(B.box_clip(A.boxes_raw(spark, d)).where("visible"))
    return B.yolo_denormalize(lines).select("image_id", "annotation_id", *[F.round(c, 3).alias(c) for c in ("px0", "py0", "px1", "py1")])


@query("""SELECT image_id, annotation_id, mapped_class, CASE WHEN include THEN 'KEEP' WHEN handling = 'IGNORE_REGION' THEN 'IGNORE_REGION' ELSE 'REJECT' END AS action,
    CASE WHEN mapped_class IS NULL THEN 'UNMAPPED_CLASS' WHEN mapped_class <> CASE WHEN image_id % 9 = 0 THEN '' WHEN original_class IN ('AO', 'RO') THEN 'other' ELSE 'vehicle' END THEN 'CORRECTED_TO_CONFIG' ELSE 'CONSISTENT' END AS mapping_status FROM boxes_raw LEFT JOIN class_rules USING (dataset, original_class)""", "images", "boxes_raw", "class_rules")
def apply_class_rules(spark, d):
    return _mapped(spark, d).select("image_id", "annotation_id", "mapped_class", "action", "mapping_status")


@query("""SELECT image_id, annotation_id, EXISTS (SELECT 1 FROM regions r WHERE r.sequence_id = b.sequence_id AND (xmin + xmax) / 2 BETWEEN "left" AND "right"
    AND (ymin + ymax) / 2 BETWEEN top AND bottom) AS ignored FROM boxes_raw b""", "images", "boxes_raw", "regions")
def regions_contain(spark, d):
    return B.split_by_regions(A.boxes_raw(spark, d), A.regions(spark, d)).select("image_id", "annotation_id", "ignored")


@query("""WITH RECURSIVE p(k, x1, y1, x2, y2) AS (VALUES (0, 100.0, 50.0, 800.0, 80.0), (1, 800.0, 80.0, 900.0, 500.0), (2, 900.0, 500.0, 300.0, 400.0), (3, 300.0, 400.0, 100.0, 50.0)),
    f AS (SELECT o_orderkey AS image_id, l_linenumber, l_partkey, l_suppkey, CAST(l_partkey % 1000 AS DOUBLE) AS x, CAST(l_suppkey * 6 - 12 AS DOUBLE) AS y FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT image_id, l_linenumber, l_partkey, l_suppkey, bool_or(abs((x - x1) * (y2 - y1) - (y - y1) * (x2 - x1)) <= 1e-9 AND x BETWEEN least(x1, x2) - 1e-9 AND greatest(x1, x2) + 1e-9
        AND y BETWEEN least(y1, y2) - 1e-9 AND greatest(y1, y2) + 1e-9)
        OR count(*) FILTER (WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1) % 2 = 1 AS inside
    FROM f, p GROUP BY ALL""")
def point_in_polygon(spark, d):
    f = A.table(spark, d, "lineitem").selectExpr("l_orderkey AS image_id", "l_linenumber", "l_partkey", "l_suppkey", "CAST(l_partkey % 1000 AS DOUBLE) AS x", "CAST(l_suppkey * 6 - 12 AS DOUBLE) AS y")
    return f.select("image_id", "l_linenumber", "l_partkey", "l_suppkey", B.point_in_polygon(F.col("x"), F.col("y"), POLYGON).alias("inside")).distinct()


@query("""SELECT image_id, annotation_id, round((0.02 * x + 0.001 * y + 1.5) / w, 6) AS ground_x, round((0.0005 * x + 0.03 * y - 2.0) / w, 6) AS ground_y,
    round(sqrt(power((0.02 * x + 0.001 * y + 1.5) / w - 1, 2) + power((0.0005 * x + 0.03 * y - 2.0) / w - 2, 2)), 6) AS ground_range
    FROM (SELECT image_id, annotation_id, x, y, 0.0001 * x + 0.0002 * y + 1 AS w FROM (SELECT image_id, annotation_id, (xmin + xmax) / 2 AS x, ymax AS y FROM boxes_raw))""", *_BOX[:2])
def ground_project(spark, d):
    x, y = B.foot_point()
    gx, gy = B.ground_project(x, y, HOMOGRAPHY)
    out = A.boxes_raw(spark, d).select("image_id", "annotation_id", gx.alias("gx"), gy.alias("gy"))
    return out.select("image_id", "annotation_id", F.round("gx", 6).alias("ground_x"), F.round("gy", 6).alias("ground_y"), F.round(B.ground_range(F.col("gx"), F.col("gy"), (1.0, 2.0)), 6).alias("ground_range"))


# ---- joins


@query("SELECT image_id, annotation_id FROM boxes_raw WHERE NOT (sequence_id = 'SEQ7' AND track_id = 79)", *_BOX[:2])
def exclude_tracks(spark, d):
    ex = spark.createDataFrame([("SEQ7", 79)], "sequence_id string, track_id long")
    return C.exclude_tracks(A.boxes_raw(spark, d), ex)[0].select("image_id", "annotation_id")


@query("SELECT image_id FROM images WHERE image_id NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')", "images")
def images_without_boxes(spark, d):
    return C.without_partner(A.images(spark, d), A.boxes_raw(spark, d).where("original_class LIKE 'A%'"), ["image_id"]).select("image_id")


@query("""SELECT annotation_id, image_id FROM boxes_raw WHERE image_id NOT IN (SELECT image_id FROM images WHERE file_group < 5)""", *_BOX[:2])
def annotations_without_image(spark, d):
    return C.without_partner(A.boxes_raw(spark, d), A.images(spark, d).where("file_group < 5"), ["image_id"]).select("annotation_id", "image_id")


@query("""SELECT image_id, CASE WHEN b IS NULL THEN 'MISSING_LABEL' ELSE 'MISSING_IMAGE' END AS issue FROM
    (SELECT DISTINCT image_id, 1 AS a FROM images WHERE file_group <> 2) FULL JOIN (SELECT DISTINCT image_id, 1 AS b FROM boxes_raw WHERE original_class = 'NO') USING (image_id) WHERE a IS NULL OR b IS NULL""", *_BOX[:2])
def pair_check(spark, d):
    return C.pair_check(A.images(spark, d).where("file_group <> 2"), A.boxes_raw(spark, d).where("original_class = 'NO'"), ["image_id"])


@query("""SELECT relative_path, CASE WHEN a IS NULL THEN 'MISSING' WHEN e IS NULL THEN 'UNEXPECTED' WHEN e = a THEN 'MATCH' ELSE 'MODIFIED' END AS state FROM
    (SELECT 'd/' || doc_id AS relative_path, sha256(text) AS e FROM documents WHERE doc_id % 10 <> 1) FULL JOIN
    (SELECT 'd/' || doc_id AS relative_path, CASE WHEN doc_id % 10 = 2 THEN 'x' ELSE sha256(text) END AS a FROM documents WHERE doc_id % 10 <> 3) USING (relative_path)""")
def manifest_diff(spark, d):
    rows = A.table(spark, d, "documents").select("doc_id", F.concat(F.lit("d/"), "doc_id").alias("relative_path"), F.sha2("text", 256).alias("checksum"))
    other = rows.where("doc_id % 10 <> 3").withColumn("checksum", F.when(F.col("doc_id") % 10 == 2, "x").otherwise(F.col("checksum")))
    return C.manifest_diff(rows.where("doc_id % 10 <> 1"), other).select("relative_path", "state")


@query("""SELECT image_id, file_group FROM images WHERE file_group < 4 UNION ALL SELECT image_id, 9 FROM images WHERE file_group >= 4""", "images")
def append_new(spark, d):
    i = A.images(spark, d).select("image_id", "file_group")
    return C.append_new(i.where("file_group < 4"), i.where("file_group >= 2").withColumn("file_group", F.lit(9)), "image_id")


# ---- profiles


_STAT = """SELECT dataset, count(*) AS n_boxes, count(*) FILTER (WHERE len(issues) = 0) AS n_valid, count(*) FILTER (WHERE clip_adjustments <> '') AS n_clipped,
    count(*) FILTER (WHERE NOT (cx1 > cx0 AND cy1 > cy0)) AS n_invisible, count(*) FILTER (WHERE lb_category = 'EXTREMELY_TINY') AS n_extremely_tiny,
    count(*) FILTER (WHERE lb_category = 'VERY_SMALL') AS n_very_small, count(*) FILTER (WHERE lb_category = 'SMALL') AS n_small, count(*) FILTER (WHERE lb_category = 'USABLE') AS n_usable,
    count(*) FILTER (WHERE least(lb_w, lb_h) < 8) / count(*) AS under_8_ratio, avg(lb_w) AS mean_lb_w, avg(lb_h) AS mean_lb_h FROM cat GROUP BY dataset"""


@query(_STAT, *_BOX)
def bbox_statistics(spark, d):
    return P.bbox_statistics(A.boxes_raw(spark, d))


@query("""SELECT i.dataset, count(*) AS n_images, count(DISTINCT i.sequence_id) AS n_sequences, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_boxes, count(*) FILTER (WHERE n IS NULL) AS n_images_without_boxes,
    CAST(coalesce(sum(bad), 0) AS BIGINT) AS n_invalid, CAST(coalesce(sum(iss), 0) AS BIGINT) AS n_issues, max(k.n_tracks) AS n_tracks, max(k.n_classes) AS n_classes
    FROM images i LEFT JOIN (SELECT image_id, count(*) AS n, count(*) FILTER (WHERE len(issues) > 0) AS bad, sum(len(issues)) AS iss FROM v GROUP BY 1) USING (image_id)
    LEFT JOIN (SELECT dataset, count(DISTINCT (sequence_id, track_id)) AS n_tracks, count(DISTINCT original_class) AS n_classes FROM v GROUP BY 1) k ON k.dataset = i.dataset GROUP BY i.dataset""", *_BOX[:3])
def dataset_inventory(spark, d):
    return P.dataset_inventory(A.images(spark, d), A.boxes_raw(spark, d))


@query("""SELECT dataset, count(*) AS n_boxes, bool_or(track_id IS NOT NULL) AS has_tracks, bool_or(occluded) AS has_occlusion, bool_or(original_class = 'AF') AS has_af, bool_or(original_class = 'NF') AS has_nf,
    bool_or(original_class = 'NO') AS has_no, bool_or(original_class = 'RF') AS has_rf, count(*) FILTER (WHERE lb_category = 'EXTREMELY_TINY') / count(*) AS tiny_ratio,
    count(*) FILTER (WHERE lb_category <> 'USABLE') / count(*) AS small_ratio FROM cat GROUP BY dataset""", *_BOX)
def dataset_comparison(spark, d):
    return P.dataset_comparison(A.boxes_raw(spark, d))


@query("""SELECT dataset, original_class, n_boxes, mapped_class, include, handling, CASE WHEN mapped_class IS NULL THEN 'UNMAPPED_CLASS' ELSE 'CONSISTENT' END AS mapping_status
    FROM (SELECT dataset, original_class, count(*) AS n_boxes FROM boxes_raw GROUP BY ALL) LEFT JOIN class_rules USING (dataset, original_class)""", "images", "boxes_raw", "class_rules")
def class_distribution(spark, d):
    return P.class_distribution(A.boxes_raw(spark, d), A.class_rules(spark))


@query("""SELECT dataset, count(*) FILTER (WHERE len(issues) = 0) AS n_valid, count(DISTINCT CASE WHEN len(issues) > 0 THEN (image_id, annotation_id) END) AS n_invalid, CAST(sum(len(issues)) AS BIGINT) AS n_issues,
    n_invalid / (n_valid + n_invalid) AS invalid_rate FROM v GROUP BY dataset""", *_BOX[:3])
def annotation_quality(spark, d):
    return P.annotation_quality(A.boxes_raw(spark, d))


@query("SELECT dataset, count(xmax) AS n, min(xmax) AS min_value, avg(xmax) AS mean_value, median(xmax) AS median_value, max(xmax) AS max_value FROM boxes_raw GROUP BY dataset", *_BOX[:2])
def numeric_summary(spark, d):
    return P.numeric_summary(A.boxes_raw(spark, d), "xmax", "dataset")


@query("""SELECT dataset, n_boxes, count(*) AS n_images FROM (SELECT i.dataset, i.image_id, count(b.image_id) AS n_boxes FROM images i LEFT JOIN boxes_raw b USING (image_id) GROUP BY ALL) GROUP BY ALL""", *_BOX[:2])
def boxes_per_image(spark, d):
    return P.boxes_per_image(A.images(spark, d), A.boxes_raw(spark, d))


@query("""SELECT dataset, state, count(*) AS n_boxes FROM (SELECT dataset, unnest([CASE WHEN occluded THEN 'OCCLUDED' ELSE 'NOT_OCCLUDED' END, CASE WHEN truncation_ratio > 0 THEN 'TRUNCATED' ELSE 'NOT_TRUNCATED' END]) AS state
    FROM boxes_raw) GROUP BY ALL""", *_BOX[:2])
def occlusion_truncation(spark, d):
    return P.occlusion_truncation(A.boxes_raw(spark, d))


@query("""SELECT CAST(b AS INT) AS bin, e AS bin_start, count(side) AS n_boxes, count(side) FILTER (WHERE side < 25) AS n_under
    FROM (VALUES (0, 0.0::DOUBLE, 10.0), (1, 10.0, 25.0), (2, 25.0, 50.0), (3, 50.0, 100.0), (4, 100.0, 200.0), (5, 200.0, 320.0), (6, 320.0, 1e18)) t(b, e, u)
    LEFT JOIN (SELECT greatest(lb_w, lb_h) AS side FROM cat WHERE xmax > xmin AND ymax > ymin) ON side >= e AND side < u GROUP BY ALL""", *_BOX)
def bbox_size_report(spark, d):
    return P.bbox_size_report(A.boxes_raw(spark, d), spark)


@query("""SELECT dataset, side, count(*) AS n_boxes, count(*) FILTER (WHERE o < 2) AS n_under_2, quantile_cont(o, 0.05) AS p05, quantile_cont(o, 0.5) AS p50, quantile_cont(o, 0.95) AS p95 FROM (
    SELECT dataset, unnest(['LEFT', 'TOP', 'RIGHT', 'BOTTOM']) AS side, unnest([-xmin, -ymin, xmax - width, ymax - height]) AS o FROM boxes_raw WHERE xmax > xmin AND ymax > ymin) WHERE o > 0 GROUP BY ALL""", *_BOX[:2])
def clip_audit(spark, d):
    return P.clip_audit(A.boxes_raw(spark, d))


@query("""SELECT dataset, CASE WHEN k <= 0 THEN 'FULLY_OUTSIDE' WHEN k >= 0.9 THEN 'MINOR' WHEN k >= 0.5 THEN 'MODERATE' ELSE 'SEVERE' END AS severity, count(*) AS n_boxes, avg(k) AS mean_kept FROM (
    SELECT dataset, greatest(cx1 - cx0, 0) * greatest(cy1 - cy0, 0) / ((xmax - xmin) * (ymax - ymin)) AS k FROM clip WHERE xmax > xmin AND ymax > ymin AND clip_adjustments <> '') GROUP BY ALL""", *_BOX[:4])
def clip_severity(spark, d):
    return P.clip_severity(A.boxes_raw(spark, d))


@query("""SELECT dataset, CAST(sum(n - 1) AS BIGINT) AS n_surplus, count(*) FILTER (WHERE n > 1) AS n_groups FROM (SELECT dataset, count(*) AS n FROM boxes_raw GROUP BY dataset, image_id, original_class, xmin, ymin, xmax, ymax) GROUP BY dataset""", *_BOX[:2])
def duplicate_box_rows(spark, d):
    return P.duplicate_box_rows(A.boxes_raw(spark, d))


A.SQL["ext"] = """ext AS (SELECT dataset, sequence_id, track_id, min(frame_id) AS first_frame, max(frame_id) AS last_frame, count(*) AS n_boxes, min((xmin + xmax) / 2) AS min_x, max((xmin + xmax) / 2) AS max_x,
    min((ymin + ymax) / 2) AS min_y, max((ymin + ymax) / 2) AS max_y, max(width) AS width, max(height) AS height FROM boxes_raw WHERE xmax > xmin AND ymax > ymin GROUP BY ALL)"""


@query("SELECT * FROM ext", "images", "boxes_raw", "ext")
def track_extents(spark, d):
    return P.track_extents(A.boxes_raw(spark, d))


@query("""SELECT dataset, sequence_id, track_id, round(s, 9) AS extent_share, CASE WHEN s < 0.4 THEN 'HIGH' ELSE 'MEDIUM' END AS confidence FROM (
    SELECT *, sqrt(power(max_x - min_x, 2) + power(max_y - min_y, 2)) / sqrt(960.0 * 960 + 540.0 * 540) AS s FROM ext WHERE n_boxes >= 2) WHERE s < 0.8""", "images", "boxes_raw", "ext")
def stationary_candidates(spark, d):
    found = P.stationary_candidates(P.track_extents(A.boxes_raw(spark, d)), least_boxes=2, high=0.4, medium=0.8)
    return found.select("dataset", "sequence_id", "track_id", F.round("extent_share", 9).alias("extent_share"), "confidence")


@query("""SELECT dataset, sequence_id, track_id, CAST(count(*) FILTER (WHERE n > 1) AS BIGINT) AS n_repeated_frames, min(lo) <> max(hi) AS class_changes FROM (
    SELECT dataset, sequence_id, track_id, frame_id, count(*) AS n, min(original_class) AS lo, max(original_class) AS hi FROM boxes_raw GROUP BY ALL) GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE n > 1) > 0 OR min(lo) <> max(hi)""".replace("GROUP BY ALL) GROUP BY", "GROUP BY 1, 2, 3, 4) GROUP BY"), *_BOX[:2])
def track_consistency(spark, d):
    n = A.n_tasks(spark, d)
    boxes = A.boxes_raw(spark, d, min(n, max(A.STRAIGHT, n // 8)))  # of few columns: a join holds as many rows as eight tasks at most
    return P.track_consistency(A.dealt(spark, boxes, n, "dataset", "sequence_id", "track_id"))


@query("""SELECT count(*) AS n_raw, count(*) FILTER (WHERE k AND g) AS n_included, count(*) FILTER (WHERE NOT k) AS n_excluded, count(*) FILTER (WHERE k AND NOT g) AS n_invalid, true AS conserved
    FROM (SELECT coalesce(include, false) AS k, len(issues) = 0 AS g FROM v LEFT JOIN class_rules USING (dataset, original_class))""", "images", "boxes_raw", "v", "class_rules")
def conservation_check(spark, d):
    return P.conservation_check(B.box_validate(C.apply_class_rules(A.boxes_raw(spark, d), A.class_rules(spark))))


@query("""SELECT dimension, value, count(*) AS n_sequences FROM (UNPIVOT sequences ON road_type, lighting, weather, camera_view INTO NAME dimension VALUE value) GROUP BY ALL""", "images", "sequences")
def condition_distribution(spark, d):
    return P.condition_distribution(A.sequences(spark, d))


@query("""SELECT dataset, sequence_id, n_images, coalesce(n_boxes, 0) AS n_boxes, coalesce(n_boxes, 0) / n_images AS mean_boxes,
    CASE WHEN coalesce(n_boxes, 0) / n_images <= 4 THEN 'LOW' WHEN coalesce(n_boxes, 0) / n_images <= 10 THEN 'MEDIUM' ELSE 'HIGH' END AS density
    FROM (SELECT dataset, sequence_id, count(*) AS n_images FROM images GROUP BY ALL) LEFT JOIN (SELECT dataset, sequence_id, count(*) AS n_boxes FROM boxes_raw GROUP BY ALL) USING (dataset, sequence_id)""", *_BOX[:2])
def traffic_density(spark, d):
    return P.traffic_density(A.images(spark, d), A.boxes_raw(spark, d))


A.SQL["pix"] = """pix AS (SELECT 'DS' || (vec_id % 3) AS dataset, vec_id AS file_id, vec_id % 150 = 7 AS broken,
    list_transform(list_transform(embedding, lambda e: 4 * CAST(floor(least(greatest((CAST(e AS DOUBLE) + 0.5) * 64, 0), 63)) AS INT)), lambda v: CASE vec_id % 20 WHEN 1 THEN v // 8 WHEN 2 THEN 255 - v // 8 WHEN 3 THEN 0 WHEN 4 THEN 255 ELSE v END) AS p FROM embeddings)"""
A.SQL["measured"] = """measured AS (SELECT dataset, file_id, CASE WHEN broken THEN 'CORRUPT_OR_UNREADABLE' ELSE 'OK' END AS read_status, CASE WHEN NOT broken THEN list_avg(p) END AS brightness, CASE WHEN NOT broken THEN list_stddev_pop(p) END AS contrast,
    CASE WHEN NOT broken THEN list_var_pop(list_transform(list_filter(range(64), lambda k: k // 8 BETWEEN 1 AND 6 AND k % 8 BETWEEN 1 AND 6), lambda k: p[k - 7] + p[k + 9] + p[k] + p[k + 2] - 4 * p[k + 1])) END AS sharpness,
    CASE WHEN NOT broken THEN len(list_filter(p, lambda v: v < 25)) / 64 END AS dark_ratio, CASE WHEN NOT broken THEN len(list_filter(p, lambda v: v > 240)) / 64 END AS bright_ratio FROM pix)"""


def _measured(spark, d):
    i = A.pixel_images(spark, d)
    m = I.image_measures()("height", "width", "nChannels", "data")
    return i.withColumn("m", m).select("dataset", "file_id", F.when(F.col("height") < 0, "CORRUPT_OR_UNREADABLE").otherwise("OK").alias("read_status"), "m.*")


@query("SELECT dataset, file_id, read_status, round(brightness, 6) AS brightness, round(contrast, 6) AS contrast, round(sharpness, 6) AS sharpness, dark_ratio, bright_ratio FROM measured", "pix", "measured")
def image_quality(spark, d):
    rounded = [F.round(c, 6).alias(c) for c in ("brightness", "contrast", "sharpness")]
    return _measured(spark, d).select("dataset", "file_id", "read_status", *rounded, "dark_ratio", "bright_ratio")


A.SQL["low_frequencies"] = """basis AS (SELECT u, j, sum(cos(pi() * (2 * (4 * j + t) + 1) * u / 64)) AS c FROM range(8) a(u), range(8) b(j), range(4) e(t) GROUP BY u, j),
    low AS (SELECT file_id, y.u AS u, x.u AS v, round(sum(y.c * x.c * p[8 * y.j + x.j + 1]), 6) AS f FROM pix, basis y, basis x WHERE NOT broken GROUP BY ALL),
    bits AS (SELECT file_id, sum(CASE WHEN f > m THEN CAST(power(2::DOUBLE, 63 - 8 * u - v) AS HUGEINT) ELSE 0::HUGEINT END) AS h FROM low JOIN (SELECT file_id, median(f) AS m FROM low WHERE u > 0 GROUP BY 1) USING (file_id) GROUP BY 1)"""


@query("""SELECT dataset, file_id, phash, ahash FROM (SELECT dataset, file_id, CAST(CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END AS BIGINT) AS phash FROM pix LEFT JOIN bits USING (file_id)) JOIN (
    SELECT dataset, file_id, CAST(CASE WHEN h >= 9223372036854775808 THEN h - 18446744073709551616 ELSE h END AS BIGINT) AS ahash FROM (
    SELECT dataset, file_id, CASE WHEN NOT broken THEN list_sum(list_transform(range(64), lambda k: CASE WHEN p[k + 1] >= list_avg(p) THEN CAST(power(2::DOUBLE, 63 - k) AS HUGEINT) ELSE 0::HUGEINT END)) END AS h FROM pix)) USING (dataset, file_id)""", "pix", "low_frequencies")
def image_hashes(spark, d):
    return _measured(spark, d).select("dataset", "file_id", "phash", "ahash")


@query("""SELECT dataset, file_id, brightness < 5 AS black_suspect, brightness > 250 AS white_suspect, brightness < 45 AS underexposed_suspect, brightness > 220 AS overexposed_suspect, sharpness < 60 AS blur_suspect FROM measured""", "pix", "measured")
def image_suspects(spark, d):
    return M.image_suspects(_measured(spark, d)).select("dataset", "file_id", *[f"{k}_suspect" for k in ("black", "white", "underexposed", "overexposed", "blur")])


@query("""SELECT dataset, count(*) FILTER (WHERE read_status = 'OK') AS n_checked, count(*) FILTER (WHERE read_status <> 'OK') AS n_failed, round(avg(brightness), 6) AS brightness_mean, round(median(brightness), 6) AS brightness_median, round(median(sharpness), 6) AS sharpness_median,
    round(avg(contrast), 6) AS contrast_mean, round(avg(sharpness), 6) AS sharpness_mean, count(*) FILTER (WHERE brightness < 5) AS n_black, count(*) FILTER (WHERE brightness > 250) AS n_white, count(*) FILTER (WHERE brightness < 45) AS n_underexposed, count(*) FILTER (WHERE brightness > 220) AS n_overexposed, count(*) FILTER (WHERE sharpness < 60) AS n_blur
    FROM measured GROUP BY dataset""", "pix", "measured")
def image_quality_summary(spark, d):
    out = M.image_quality_summary(_measured(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("brightness_mean", "brightness_median", "contrast_mean", "sharpness_mean", "sharpness_median")})


@query("""SELECT file_id, array_to_string(list_transform(range(64), lambda k: printf('%02X', CASE WHEN k % 8 >= file_id % 4 AND k % 8 < file_id % 4 + 4 AND k // 8 >= file_id % 3 AND k // 8 < file_id % 3 + 3 THEN 0 ELSE p[k + 1] END)), '') AS pixels
    FROM pix WHERE NOT broken""", "pix")
def masked_images(spark, d):
    i = A.pixel_images(spark, d).where("height > 0")
    region = F.expr("array(named_struct('left', CAST(file_id % 4 AS DOUBLE), 'top', CAST(file_id % 3 AS DOUBLE), 'right', file_id % 4 + 3.5D, 'bottom', file_id % 3 + 2.5D))")
    return i.select("file_id", F.hex(I.mask_regions()("height", "width", "nChannels", "data", region)).alias("pixels"))


def _mapped(spark, d):
    """Boxes as their sources map them, some of them otherwise than the rules."""
    source = F.when(F.expr("image_id % 9 = 0"), "").when(F.expr("original_class IN ('AO', 'RO')"), "other").otherwise("vehicle")
    return C.apply_class_rules(A.boxes_raw(spark, d).withColumn("source_mapped_class", source), A.class_rules(spark))


def _reviewed_rules(spark):
    return A.class_rules(spark).withColumn("review_required", F.expr("original_class IN ('NO', 'AO')")).withColumn("has_track_exclusions", F.expr("original_class = 'NF'"))


def _groups(spark, d):
    """Groups of equal content, of near neighbours and of equal names."""
    f = A.fingerprints(spark, d).withColumn("name", F.expr("concat('img', file_id % 400)"))
    exact, names = (f.groupBy("dataset", c).count().where("count > 1").select("dataset", F.lit(k).alias("kind")) for c, k in (("sha256", "EXACT"), ("name", "BASENAME")))
    return exact.unionByName(names).unionByName(D.near_duplicate_consecutive(f, 0.6).select("dataset", F.lit("NEAR").alias("kind")))


def _gate(spark, d):
    return Q.quality_gate(_mapped(spark, d), M.image_suspects(_measured(spark, d)), _groups(spark, d))


A.SQL["mapping"] = """mapping AS (SELECT b.*, mapped_class, include, s.source, CASE WHEN mapped_class IS NULL THEN 'UNMAPPED_CLASS' WHEN s.source <> mapped_class THEN 'CORRECTED_TO_CONFIG' ELSE 'CONSISTENT' END AS mapping_status
    FROM clip b LEFT JOIN class_rules USING (dataset, original_class), LATERAL (SELECT CASE WHEN b.image_id % 9 = 0 THEN '' WHEN b.original_class IN ('AO', 'RO') THEN 'other' ELSE 'vehicle' END AS source) s)"""
A.SQL["gate"] = """gate AS (SELECT *, CASE WHEN n_unreadable > 0 THEN 'BLOCKED' WHEN n_underexposed + n_overexposed + n_blurred + n_invalid + n_exact_groups + n_near_groups + n_corrected + n_unmapped > 0 THEN 'REVIEW_REQUIRED' ELSE 'PASS' END AS gate FROM (
    SELECT dataset, count(DISTINCT image_id || '|' || annotation_id) FILTER (WHERE len(issues) > 0) AS n_invalid, CAST(sum(len(issues)) AS BIGINT) AS n_issues, count(*) FILTER (WHERE clip_adjustments <> '') AS n_clipped,
        count(*) FILTER (WHERE mapping_status = 'CORRECTED_TO_CONFIG') AS n_corrected, count(*) FILTER (WHERE mapping_status = 'UNMAPPED_CLASS') AS n_unmapped FROM mapping GROUP BY dataset) JOIN
    (SELECT dataset, count(*) AS n_checked, count(*) FILTER (WHERE read_status <> 'OK') AS n_unreadable, count(*) FILTER (WHERE brightness < 45) AS n_underexposed, count(*) FILTER (WHERE brightness > 220) AS n_overexposed, count(*) FILTER (WHERE sharpness < 60) AS n_blurred FROM measured GROUP BY dataset) USING (dataset) JOIN
    (SELECT dataset, count(*) AS n_exact_groups FROM (SELECT dataset, sha256 FROM fingerprints GROUP BY ALL HAVING count(*) > 1) GROUP BY dataset) USING (dataset) JOIN
    (SELECT dataset, count(*) AS n_near_groups FROM (SELECT *, lag(phash) OVER w AS p, lag(sha256) OVER w AS o FROM fingerprints WINDOW w AS (PARTITION BY dataset, sequence_id ORDER BY source_file)) WHERE round(1 - bit_count(xor(phash, p)) / 64, 6) >= 0.6 AND sha256 <> o GROUP BY dataset) USING (dataset) LEFT JOIN
    (SELECT dataset, count(*) AS names FROM (SELECT dataset, file_id % 400 FROM fingerprints GROUP BY ALL HAVING count(*) > 1) GROUP BY dataset) USING (dataset), LATERAL (SELECT coalesce(names, 0) AS n_basename_groups))"""
A.SQL["consistency"] = """consistency AS (SELECT dataset, original_class, n_boxes, coalesce(mapped_class, '') AS mapped_class, CASE WHEN mapped_class IS NULL THEN '' WHEN include AND original_class = 'NF' THEN 'TRUE_WITH_TRACK_EXCLUSION' WHEN include THEN 'TRUE' ELSE 'FALSE' END AS configured_include, source_mapped_values, n_corrected,
        CASE WHEN mapped_class IS NULL THEN 'UNMAPPED_CLASS_REVIEW_REQUIRED' WHEN original_class IN ('NO', 'AO') THEN 'DEFINED_PENDING_DATA_LEAD_APPROVAL' WHEN original_class = 'NF' THEN 'DATA_LEAD_APPROVED_WITH_TRACK_EXCLUSION' ELSE 'APPROVED' END AS mapping_status, mapped_class IS NULL OR original_class IN ('NO', 'AO') AS manual_review_required
    FROM (SELECT dataset, original_class, any_value(mapped_class) AS mapped_class, bool_or(include) AS include, count(*) AS n_boxes, string_agg(DISTINCT CASE WHEN source = '' THEN 'EMPTY' ELSE source END, '|' ORDER BY CASE WHEN source = '' THEN 'EMPTY' ELSE source END) AS source_mapped_values, count(*) FILTER (WHERE mapping_status = 'CORRECTED_TO_CONFIG') AS n_corrected FROM mapping GROUP BY dataset, original_class))"""
_AUDIT = (*_BOX[:4], "class_rules", "mapping", "pix", "measured", "fingerprints", "gate", "consistency")


@query("SELECT * EXCLUDE (names) FROM gate", *_AUDIT)
def quality_gate(spark, d):
    return _gate(spark, d)


@query("SELECT * FROM consistency", *_AUDIT)
def label_consistency(spark, d):
    return Q.label_consistency(_mapped(spark, d), _reviewed_rules(spark))


@query(f"""SELECT dataset, issue_category, issue_count, severity, scope, recommended_action, printf('QREV_%04d', row_number() OVER (ORDER BY dataset, place)) AS queue_id, 'PENDING' AS manual_review_status FROM (
    SELECT dataset, place, issue_category, severity, scope, recommended_action, CAST(CASE place {" ".join(f"WHEN {k} THEN {r[1]}" for k, r in enumerate(Q.REVIEWS))} END AS BIGINT) AS issue_count
    FROM gate LEFT JOIN (SELECT dataset, count(*) AS n FROM consistency WHERE manual_review_required GROUP BY 1) USING (dataset), LATERAL (SELECT coalesce(n, 0) AS n_pending_classes),
        (VALUES {", ".join(str((k, r[0], *r[2:])) for k, r in enumerate(Q.REVIEWS))}) t(place, issue_category, severity, scope, recommended_action)) WHERE issue_count > 0""", *_AUDIT)
def quality_review_queue(spark, d):
    return Q.quality_review_queue(_gate(spark, d), Q.label_consistency(_mapped(spark, d), _reviewed_rules(spark)))



# ---- splits and scenes


A.SQL["sp"] = """sp AS (SELECT *, CASE WHEN dataset = 'DS0' THEN 'train' WHEN sequence_id IN ('SEQ3', 'SEQ11') THEN 'cross_test' WHEN h < 0.8 THEN 'train' WHEN h < 0.9 THEN 'validation' ELSE 'cross_test' END AS split,
    CASE WHEN dataset = 'DS0' THEN 'DATASET_OVERRIDE' WHEN sequence_id IN ('SEQ3', 'SEQ11') THEN 'FIXED_CROSS_TEST' ELSE 'HASH' END AS split_reason, dataset <> 'DS0' AS evaluation_eligible
    FROM (SELECT *, CAST('0x' || substr(sha256(dataset || ':' || sequence_id), 1, 8) AS BIGINT) / 4294967295 AS h FROM sequences))"""
_SP = ("images", "sequences", "sp")


def _assigned(spark, d):
    over = spark.createDataFrame([("DS0", "train")], "dataset string, override string")
    seq = A.sequences(spark, d)
    fixed = seq.where("sequence_id IN ('SEQ3', 'SEQ11')").select("dataset", "sequence_id")
    return X.assign_split(seq, over, fixed)


@query("SELECT o_orderkey, CASE WHEN h / 4294967295 < 0.8 THEN 'train' WHEN h / 4294967295 < 0.9 THEN 'validation' ELSE 'cross_test' END AS split, CASE WHEN h % 100 < 70 THEN 'train' WHEN h % 100 < 85 THEN 'validation' ELSE 'test' END AS split_mod FROM (SELECT o_orderkey, CAST('0x' || substr(sha256('k' || o_orderkey), 1, 8) AS BIGINT) AS h FROM orders)")
def hash_split(spark, d):
    key = F.concat(F.lit("k"), F.col("o_orderkey").cast("string"))
    return A.table(spark, d, "orders").select("o_orderkey", X.hash_split(key).alias("split"), X.hash_split_mod(key).alias("split_mod"))


@query("SELECT dataset, sequence_id, split, split_reason, evaluation_eligible FROM sp", *_SP)
def assign_split(spark, d):
    return _assigned(spark, d).select("dataset", "sequence_id", "split", "split_reason", "evaluation_eligible")


@query("""SELECT dataset, split, n_sequences, n_images, n_sequences / sum(n_sequences) OVER (PARTITION BY dataset) AS sequence_share FROM (
    SELECT dataset, split, count(DISTINCT sequence_id) AS n_sequences, count(DISTINCT image_id) AS n_images FROM images JOIN sp USING (dataset, sequence_id) GROUP BY ALL)""", *_SP)
def split_distribution(spark, d):
    return X.split_distribution(C.join_split(A.images(spark, d), _assigned(spark, d).select("dataset", "sequence_id", "split")))


@query("""SELECT sequence_id, string_agg(DISTINCT split, '|' ORDER BY split) AS splits FROM sp GROUP BY sequence_id HAVING count(DISTINCT split) > 1""", *_SP)
def sequence_leakage(spark, d):
    return X.sequence_leakage(_assigned(spark, d), "sequence_id")


@query("""SELECT file_group, string_agg(DISTINCT split, '|' ORDER BY split) AS splits FROM images JOIN sp USING (dataset, sequence_id) GROUP BY file_group HAVING count(DISTINCT split) > 1""", *_SP)
def source_file_leakage(spark, d):
    rows = C.join_split(A.images(spark, d), _assigned(spark, d).select("dataset", "sequence_id", "split"))
    return X.sequence_leakage(rows, "file_group")


@query("SELECT sequence_id FROM sp WHERE split = 'train' INTERSECT SELECT sequence_id FROM sp WHERE split = 'cross_test'", *_SP)
def split_key_intersect(spark, d):
    a = _assigned(spark, d)
    return X.split_key_intersect(a.where("split = 'train'"), a.where("split = 'cross_test'"), "sequence_id")


@query("SELECT DISTINCT road_type, lighting, dataset FROM sequences EXCEPT SELECT road_type, lighting, dataset FROM sp WHERE split = 'validation'", *_SP)
def missing_coverage(spark, d):
    on = ["road_type", "lighting", "dataset"]
    return X.missing_coverage(A.sequences(spark, d).select(*on).distinct(), _assigned(spark, d).where("split = 'validation'").select(*on))


_GAP = "SELECT count(*) AS n FROM (SELECT * FROM (VALUES {values}) t(x) EXCEPT SELECT {column} FROM sp WHERE split = 'cross_test')"
_AUDIT = {
    "sequence_in_one_split": ("SELECT count(*) AS n FROM (SELECT 1 FROM sp GROUP BY dataset, sequence_id HAVING count(DISTINCT split) > 1)", "FAIL"),
    "file_in_one_split": ("SELECT count(*) AS n FROM (SELECT 1 FROM images JOIN sp USING (dataset, sequence_id) GROUP BY dataset, file_group HAVING count(DISTINCT split) > 1)", "FAIL"),
    "split_unit_is_sequence": ("SELECT count(*) AS n FROM sp WHERE sequence_id = 'SEQ9'", "FAIL"),
    "test_datasets": ("SELECT CASE WHEN count(DISTINCT dataset) < 3 THEN 1 ELSE 0 END AS n FROM sp WHERE split = 'cross_test'", "FAIL"),
    "validation_datasets": ("SELECT count(*) AS n FROM (SELECT dataset FROM sp WHERE evaluation_eligible EXCEPT SELECT dataset FROM sp WHERE split = 'validation')", "PARTIAL"),
    "test_road_types": (_GAP.format(values="('HIGHWAY'), ('URBAN'), ('RURAL'), ('TUNNEL')", column="road_type"), "PARTIAL"),
    "test_lightings": (_GAP.format(values="('DAY'), ('NIGHT')", column="lighting"), "PARTIAL"),
    "train_only_datasets": ("SELECT count(*) FILTER (WHERE dataset = 'DS0' AND (split <> 'train' OR evaluation_eligible)) + CASE WHEN count(*) FILTER (WHERE dataset = 'DS7') = 0 THEN 1 ELSE 0 END AS n FROM sp", "FAIL"),
    "fixed_test_members": ("SELECT count(*) AS n FROM sp WHERE sequence_id IN ('SEQ3', 'SEQ11', 'SEQ5') AND split <> 'cross_test'", "FAIL"),
    "main_test_collected": ("SELECT 0 AS n", "PENDING"),
    "main_test_locked": ("SELECT 1 AS n", "PENDING"),
    "split_is_known": ("SELECT count(*) AS n FROM sp WHERE split IS NULL", "FAIL"),
    "sequence_listed_once": ("SELECT count(*) AS n FROM (SELECT 1 FROM sp GROUP BY dataset, sequence_id HAVING count(*) > 1)", "FAIL"),
    "scene_is_present": ("SELECT count(*) AS n FROM sp WHERE sequence_id = 'SEQ12'", "FAIL"),
}


@query(" UNION ALL ".join(f"SELECT '{name}' AS check_name, CAST(n AS BIGINT) AS n_offenders, CASE WHEN n = 0 THEN 'PASS' ELSE '{bad}' END AS status FROM ({sql})" for name, (sql, bad) in _AUDIT.items()), *_SP)
def split_audit(spark, d):
    a = _assigned(spark, d).withColumn("split_unit", F.when(F.col("sequence_id") == "SEQ9", "FRAME").otherwise("SEQUENCE_ID"))
    policy = X.SplitPolicy(least_test_datasets=3, test_road_types=("HIGHWAY", "URBAN", "RURAL", "TUNNEL"), test_lightings=("DAY", "NIGHT"), train_only=("DS0", "DS7"), main_test_collected=True)
    scenes = A.sequences(spark, d)
    files = A.images(spark, d).withColumn("source_file", F.col("file_group").cast("string"))
    a = a.select("dataset", "sequence_id", "split", "split_unit", "evaluation_eligible")
    return X.split_audit(a, scenes.where("sequence_id <> 'SEQ12'"), files, scenes.where("sequence_id IN ('SEQ3', 'SEQ11', 'SEQ5')"), policy)


@query("""SELECT road_type, lighting, n_test, coalesce(n_train, 0) AS n_train FROM (SELECT road_type, lighting, count(*) AS n_test FROM sp WHERE split <> 'train' GROUP BY ALL)
    LEFT JOIN (SELECT road_type, lighting, count(*) AS n_train FROM sp WHERE split = 'train' GROUP BY ALL) USING (road_type, lighting) WHERE coalesce(n_train, 0) < 10""", *_SP)
def coverage_violations(spark, d):
    return X.coverage_violations(_assigned(spark, d), 10)


@query("SELECT split, dataset, road_type, count(*) AS n_sequences FROM sp GROUP BY ALL", *_SP)
def road_type_distribution(spark, d):
    return X.scene_distribution(_assigned(spark, d), ("road_type",)).withColumnRenamed("value", "road_type").drop("dimension")


@query("SELECT split, dataset, dimension, value, count(*) AS n_sequences FROM (UNPIVOT sp ON road_type, lighting, weather, camera_view INTO NAME dimension VALUE value) GROUP BY ALL", *_SP)
def scene_distribution(spark, d):
    return X.scene_distribution(_assigned(spark, d))


@query("""SELECT dimension, value, original_class, size_category, n_boxes, n_boxes / sum(n_boxes) OVER (PARTITION BY dimension, value) AS share FROM (
    SELECT dimension, value, original_class, size_category, count(*) AS n_boxes FROM cat JOIN (UNPIVOT sequences ON road_type, lighting, weather, camera_view INTO NAME dimension VALUE value) USING (dataset, sequence_id) GROUP BY ALL)""", *_BOX, "sequences")
def scene_slices(spark, d):
    return X.scene_slices(A.boxes_raw(spark, d), A.sequences(spark, d))


@query("""SELECT dataset, sequence_id, n_images, n_boxes, n_usable, n_hard, n_hard / n_boxes AS hard_ratio FROM (SELECT dataset, sequence_id, count(*) AS n_images FROM images GROUP BY ALL) LEFT JOIN (
    SELECT dataset, sequence_id, count(*) AS n_boxes, count(*) FILTER (WHERE lb_category = 'USABLE') AS n_usable, count(*) FILTER (WHERE occluded OR lb_category IN ('EXTREMELY_TINY', 'VERY_SMALL')) AS n_hard FROM cat GROUP BY ALL) USING (dataset, sequence_id)""", *_BOX)
def sequence_statistics(spark, d):
    return X.sequence_statistics(A.images(spark, d), A.boxes_raw(spark, d))


@query("""SELECT s.split, r.road_type, l.lighting, count(x.split) AS n FROM (SELECT DISTINCT CASE split WHEN 'cross_test' THEN 'test' ELSE split END AS split FROM sp UNION SELECT 'overall') s,
    (SELECT DISTINCT road_type FROM sp) r, (SELECT DISTINCT lighting FROM sp) l LEFT JOIN (SELECT *, CASE split WHEN 'cross_test' THEN 'test' ELSE split END AS g FROM sp) x
    ON (s.split = 'overall' OR x.g = s.split) AND x.road_type = r.road_type AND x.lighting = l.lighting GROUP BY ALL""", *_SP)
def heatmap(spark, d):
    return X.heatmap(_assigned(spark, d))


@query("""SELECT dataset, sequence_id, CASE WHEN sequence_id IN ('SEQ1', 'SEQ2') THEN 'validation' ELSE split END AS split FROM sp""", *_SP)
def apply_split_moves(spark, d):
    a = _assigned(spark, d).select("dataset", "sequence_id", "split")
    moves = a.where("sequence_id IN ('SEQ1', 'SEQ2')").select("dataset", "sequence_id", F.lit("validation").alias("new_split"))
    return C.apply_split_moves(a, moves)


@query("SELECT dataset, sequence_id, split AS from_split, 'validation' AS to_split FROM sp WHERE sequence_id IN ('SEQ1', 'SEQ2') AND split <> 'validation'", *_SP)
def split_moves_log(spark, d):
    a = _assigned(spark, d).select("dataset", "sequence_id", "split")
    return C.split_moves_log(a, a.where("sequence_id IN ('SEQ1', 'SEQ2')").select("dataset", "sequence_id", F.lit("validation").alias("new_split")))


@query("""SELECT image_id, coalesce(road_type, 'UNKNOWN') AS road_type, CASE WHEN road_type IS NULL THEN 'MISSING_METADATA' ELSE 'PRESENT' END AS scene_status
    FROM images LEFT JOIN (SELECT * FROM sequences WHERE lighting <> 'NIGHT') USING (dataset, sequence_id)""", "images", "sequences")
def join_scene(spark, d):
    return C.join_scene(A.images(spark, d), A.sequences(spark, d).where("lighting <> 'NIGHT'")).select("image_id", "road_type", "scene_status")


@query("""SELECT coalesce(split, 'ALL') AS split, coalesce(dataset, 'ALL') AS dataset, coalesce(original_class, 'ALL') AS original_class, count(*) AS n_boxes FROM boxes_raw JOIN sp USING (dataset, sequence_id) GROUP BY ROLLUP (split, dataset, original_class)""", "images", "boxes_raw", "sequences", "sp")
def box_by_split_source_class(spark, d):
    rows = C.join_split(A.boxes_raw(spark, d), _assigned(spark, d).select("dataset", "sequence_id", "split"))
    return P.box_by_split_source_class(rows).drop("level").na.fill("ALL")


# ---- duplicates


@query("SELECT file_id, sha256, group_size, file_id = f AS keep FROM (SELECT *, count(*) OVER (PARTITION BY sha256) AS group_size, min(file_id) OVER (PARTITION BY sha256) AS f FROM fingerprints) WHERE group_size > 1", "fingerprints")
def duplicate_groups(spark, d):
    return D.duplicate_groups(A.fingerprints(spark, d)).select("file_id", "sha256", "group_size", "keep")


@query("SELECT doc_id, content_sha, group_size, doc_id = f AS keep FROM (SELECT doc_id, sha256(text) AS content_sha, count(*) OVER (PARTITION BY sha256(text)) AS group_size, min(doc_id) OVER (PARTITION BY sha256(text)) AS f FROM documents WHERE text IS NOT NULL) WHERE group_size > 1")
def duplicate_content(spark, d):
    docs = A.table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("content_sha"))
    return D.duplicate_groups(docs, "content_sha", "doc_id")


@query("SELECT sha256, count(*) AS n_files, string_agg(DISTINCT split, '|' ORDER BY split) AS splits FROM fingerprints WHERE split IS NOT NULL GROUP BY sha256 HAVING count(DISTINCT split) > 1", "fingerprints")
def content_cross_split(spark, d):
    return D.content_cross_split(A.fingerprints(spark, d))


@query("""SELECT dataset, sequence_id, previous_file, source_file, round(1 - bit_count(xor(phash, p)) / 64, 6) AS similarity FROM (
    SELECT *, lag(source_file) OVER w AS previous_file, lag(phash) OVER w AS p, lag(sha256) OVER w AS s FROM fingerprints WINDOW w AS (PARTITION BY dataset, sequence_id ORDER BY source_file))
    WHERE round(1 - bit_count(xor(phash, p)) / 64, 6) >= 0.6 AND sha256 <> s""", "fingerprints")
def near_duplicate_consecutive(spark, d):
    return D.near_duplicate_consecutive(A.fingerprints(spark, d), least=0.6)


@query("""SELECT a.phash AS a, a.split AS split_a, b.phash AS b, b.split AS split_b, CAST(bit_count(xor(a.phash, b.phash)) AS INT) AS distance, count(*) AS n_pairs, round(1 - bit_count(xor(a.phash, b.phash)) / 64, 6) AS similarity
    FROM fingerprints a JOIN fingerprints b ON (a.phash < b.phash OR (a.phash = b.phash AND a.split < b.split)) AND bit_count(xor(a.phash, b.phash)) <= 3 AND a.split <> b.split AND a.sha256 <> b.sha256 GROUP BY ALL""", "fingerprints")
def near_duplicate_cross_split(spark, d):
    return D.near_duplicate_cross_split(A.fingerprints(spark, d))


@query("""WITH f AS (SELECT phash, count(*) AS n FROM (%s) GROUP BY phash) SELECT x.phash AS a, y.phash AS b, CAST(bit_count(xor(x.phash, y.phash)) AS INT) AS distance, x.n AS n_a, y.n AS n_b FROM f x JOIN f y
    ON x.phash < y.phash AND bit_count(xor(x.phash, y.phash)) <= 8""" % A.SQL["fingerprints"].removeprefix("fingerprints AS (").removesuffix(")"))
def near_duplicate_pairs(spark, d):
    return D.near_duplicate_pairs(A.fingerprints(spark, d))


@query("""SELECT sha256, group_size, printf('DUP_%06d', row_number() OVER (ORDER BY sha256)) AS group_id FROM (SELECT sha256, count(*) AS group_size FROM fingerprints GROUP BY sha256 HAVING count(*) > 1)""", "fingerprints")
def duplicate_group_ids(spark, d):
    groups = D.duplicate_groups(A.fingerprints(spark, d)).where("keep").select("sha256", "group_size")
    return S.numbered(groups, "DUP_", "sha256", "group_id")


# ---- samples


@query("SELECT image_id, printf('SEL_%06d', row_number() OVER (ORDER BY h)) AS selection_id FROM (SELECT image_id, sha256('s1|' || image_id) AS h FROM images ORDER BY h LIMIT 500)", "images")
def selection_ids(spark, d):
    return S.numbered(S.sample_fixed(A.images(spark, d), 500, "s1", "image_id"), "SEL_", "rank_hash", "selection_id").select("image_id", "selection_id")


@query("SELECT image_id FROM images ORDER BY sha256('s1|' || image_id) LIMIT 500", "images")
def sample_fixed(spark, d):
    return S.sample_fixed(A.images(spark, d), 500, "s1", "image_id").select("image_id")


@query("""SELECT image_id, picked FROM (SELECT image_id, 'FIRST_FRAME' AS picked FROM images QUALIFY row_number() OVER (PARTITION BY dataset, sequence_id ORDER BY frame_id) = 1) UNION ALL
    (SELECT image_id, 'FILL' FROM (SELECT *, row_number() OVER (PARTITION BY dataset, sequence_id ORDER BY frame_id) AS rn FROM images) WHERE rn > 1 ORDER BY sha256('s2|' || image_id)
        LIMIT (SELECT greatest(0, 400 - count(DISTINCT (dataset, sequence_id))) FROM images))""", "images")
def sample_cover(spark, d):
    return S.sample_cover(A.images(spark, d), 400, "s2").select("image_id", "picked")


@query("""SELECT image_id, split, dataset FROM images JOIN sp USING (dataset, sequence_id) QUALIFY row_number() OVER (PARTITION BY split, dataset ORDER BY sha256('s3|' || image_id)) <= 5""", *_SP)
def sample_quota(spark, d):
    rows = C.join_split(A.images(spark, d), _assigned(spark, d).select("dataset", "sequence_id", "split"))
    targets = rows.select("split", "dataset").distinct().withColumn("target", F.lit(5))
    return S.sample_quota(rows, targets, "s3").select("image_id", "split", "dataset")


@query("SELECT image_id, row_number() OVER (PARTITION BY dataset, sequence_id ORDER BY frame_id) AS turn FROM images", "images")
def round_robin(spark, d):
    return S.round_robin(A.images(spark, d), "dataset", "sequence_id").select("image_id", "turn")


@query("""SELECT image_id, turn, row_number() OVER (PARTITION BY road_type, weather, lighting ORDER BY sequence_id, image_id) AS stratum_turn FROM (
    SELECT image_id, dataset, sequence_id, 1 AS turn FROM images) JOIN sequences USING (dataset, sequence_id)""", "images", "sequences")
def stratified_round_robin(spark, d):
    rows = A.images(spark, d).join(A.sequences(spark, d), ["dataset", "sequence_id"]).withColumn("turn", F.lit(1))
    return N.turns(rows, "stratum_turn", "road_type", "weather", "lighting", sequence="sequence_id", order=("image_id",)).select("image_id", "turn", "stratum_turn")


A.SQL["plan"] = """allocation AS (SELECT scenario, 'DS' || d AS dataset, CASE WHEN scenario = 'small' THEN 60 + 10 * d WHEN d = 2 THEN 100000000 ELSE 300 END AS target FROM (VALUES ('small'), ('large')) t(scenario), range(3) r(d)),
    plan AS (SELECT scenario, dataset, image_id, position FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY turn, sequence_id, image_id) AS position FROM (
        SELECT *, row_number() OVER (PARTITION BY dataset, sequence_id ORDER BY frame_id) AS turn FROM images)) JOIN allocation USING (dataset) WHERE position <= target)"""


def _subset(spark, d):
    targets = [(k, f"DS{n}", 60 + 10 * n if k == "small" else 100_000_000 if n == 2 else 300) for k in ("small", "large") for n in range(3)]
    return S.subset_plan(A.images(spark, d), spark.createDataFrame(targets, "scenario string, dataset string, target long"))


@query("SELECT * FROM plan", "images", "plan")
def subset_plan(spark, d):
    """Two scenarios, one of which asks for more of a dataset than there is."""
    return _subset(spark, d)[0].select("scenario", "dataset", "image_id", "position")


@query("SELECT *, greatest(target - n_selected, 0) AS shortfall FROM (SELECT scenario, dataset, target, count(image_id) AS n_selected FROM allocation LEFT JOIN plan USING (scenario, dataset) GROUP BY ALL)", "images", "plan")
def subset_shortfall(spark, d):
    return _subset(spark, d)[1]


@query("""SELECT sequence_id, image_id FROM images QUALIFY row_number() OVER (PARTITION BY sequence_id ORDER BY file_group < 3, image_id) = 1""", "images")
def first_candidate_per_source(spark, d):
    rows = A.images(spark, d).withColumn("mapped", F.when(F.col("file_group") >= 3, "yes"))
    return S.first_candidate_per_source(rows, "sequence_id", "mapped", "image_id").select("sequence_id", "image_id")


A.SQL["turns"] = """cand AS (SELECT *, dense_rank() OVER (ORDER BY weather, camera_view, size_category, boundary) - 1 AS s FROM (
        SELECT DISTINCT weather, camera_view, size_category, clip_adjustments <> '' AS boundary, sequence_id, frame_id, track_id, sha256(sequence_id || '|' || frame_id || '|' || track_id) AS h
        FROM cat JOIN sequences USING (dataset, sequence_id) WHERE NOT list_contains(issues, 'NON_POSITIVE_SIZE'))),
    turns AS (
        SELECT CAST([] AS VARCHAR[]) AS hs, CAST([] AS VARCHAR[]) AS qs, CAST([] AS BIGINT[]) AS ss, CAST([] AS INT[]) AS cs, 1 AS c, CAST(0 AS BIGINT) AS s, false AS moved
        UNION ALL
        SELECT CASE WHEN p IS NULL THEN hs ELSE list_append(hs, p.h) END, CASE WHEN p IS NULL THEN qs ELSE list_append(qs, p.q) END, CASE WHEN p IS NULL THEN ss ELSE list_append(ss, s) END, CASE WHEN p IS NULL THEN cs ELSE list_append(cs, ([1, 2, 3, 5])[c]) END,
            CASE WHEN s = n - 1 AND p IS NULL AND NOT moved THEN c + 1 ELSE c END, (s + 1) % n, CASE WHEN s = n - 1 THEN false ELSE moved OR p IS NOT NULL END
        FROM (SELECT t.*, (SELECT max(s) + 1 FROM cand) AS n, min({'h': k.h, 'q': k.sequence_id}) FILTER (WHERE k.h IS NOT NULL) AS p FROM turns t LEFT JOIN cand k
            ON k.s = t.s AND NOT list_contains(t.hs, k.h) AND len(list_filter(t.qs, lambda x: x = k.sequence_id)) < ([1, 2, 3, 5])[t.c] GROUP BY ALL)
        WHERE c <= 4 AND len(hs) < 150)"""


@query("""SELECT DISTINCT weather, camera_view, size_category, boundary, sequence_id, frame_id, track_id, cap, queue_position FROM (
    SELECT unnest(hs) AS h, unnest(ss) AS s, unnest(cs) AS cap, unnest(range(1, len(hs) + 1)) AS queue_position FROM (SELECT * FROM turns ORDER BY len(hs) DESC LIMIT 1)) JOIN cand USING (h, s)""", *_BOX, "sequences", "turns")
def review_queue_stratified(spark, d):
    """Visible boxes for review, over strata of weather, camera, size and whether the box leaves the image."""
    rows = B.box_geometry(B.box_clip(B.box_validate(A.boxes_raw(spark, d)))).where("NOT array_contains(issues, 'NON_POSITIVE_SIZE')").withColumn("boundary", F.col("clip_applied"))
    rows = rows.select("dataset", "sequence_id", "frame_id", "track_id", "size_category", "boundary")
    rows = S.queue_candidates(rows, "dataset", "sequence_id", "size_category", "boundary").join(A.sequences(spark, d), ["dataset", "sequence_id"])
    return S.review_queue(rows, 150, "weather", "camera_view", "size_category", "boundary")


@query("""SELECT dataset, image_id, annotation_id, rn FROM (SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY image_id, annotation_id) AS rn FROM clip WHERE clip_adjustments <> '') WHERE rn <= 100""", *_BOX[:4])
def cap_examples(spark, d):
    rows = B.box_clip(A.boxes_raw(spark, d)).where("clip_applied")
    return S.cap_examples(rows, 100, "image_id", "annotation_id").select("dataset", "image_id", "annotation_id", "rn")


# ---- release


A.SQL["ex"] = """ex AS (SELECT *, CASE WHEN reason IS NULL THEN 'EXPORTED' WHEN reason = 'IGNORE_REGION' THEN 'IGNORED' ELSE 'REJECTED' END AS outcome FROM (
    SELECT * EXCLUDE (reason), CASE WHEN reason IS NULL AND row_number() OVER (PARTITION BY reason IS NULL, image_id, line ORDER BY annotation_id) > 1 THEN 'DUPLICATE_BOX' ELSE reason END AS reason FROM (
        SELECT *, printf('0 %.8f %.8f %.8f %.8f', (cx0 + cx1) / 2 / width, (cy0 + cy1) / 2 / height, (cx1 - cx0) / width, (cy1 - cy0) / height) AS line,
            CASE WHEN NOT coalesce(include, false) AND handling = 'IGNORE_REGION' THEN 'IGNORE_REGION' WHEN mapped_class IS NULL THEN 'UNMAPPED_CLASS' WHEN NOT include THEN 'CLASS_EXCLUDED'
                WHEN sequence_id = 'SEQ7' AND track_id = 79 THEN 'TRACK_EXCLUDED' WHEN list_contains(issues, 'NON_POSITIVE_SIZE') THEN 'NON_POSITIVE_SIZE' WHEN NOT (cx1 > cx0 AND cy1 > cy0) THEN 'NOT_VISIBLE_AFTER_CLIP' END AS reason
        FROM clip LEFT JOIN class_rules USING (dataset, original_class))))"""
_EX = ("images", "boxes_raw", "v", "clip", "class_rules", "ex")


def _exported(spark, d):
    excluded = spark.createDataFrame([("SEQ7", 79)], "sequence_id string, track_id long")
    return R.export_boxes(A.boxes_raw(spark, d), A.class_rules(spark), excluded, A.n_tasks(spark, d))


@query("SELECT image_id, annotation_id, outcome, reason, CASE WHEN outcome = 'EXPORTED' THEN line END AS label_line FROM ex", *_EX)
def export_boxes(spark, d):
    return _exported(spark, d).select("image_id", "annotation_id", "outcome", "reason", F.when(F.col("outcome") == "EXPORTED", F.col("label_line")).alias("label_line"))


@query("SELECT dataset, outcome, reason, count(*) AS n_boxes FROM ex GROUP BY ALL", *_EX)
def export_summary(spark, d):
    return R.export_summary(_exported(spark, d))


@query("SELECT dataset, count(*) AS n_input, count(*) FILTER (WHERE outcome = 'EXPORTED') AS n_exported, count(*) FILTER (WHERE outcome = 'REJECTED') AS n_rejected, count(*) FILTER (WHERE outcome = 'IGNORED') AS n_ignored, true AS reconciled FROM ex GROUP BY dataset", *_EX)
def reconcile(spark, d):
    return R.reconcile(_exported(spark, d))


@query("""SELECT i.dataset, i.image_id, count(line) AS n_lines, coalesce(string_agg(line, chr(10) ORDER BY line), '') AS label_text FROM images i LEFT JOIN (SELECT image_id, line FROM ex WHERE outcome = 'EXPORTED') USING (image_id) GROUP BY ALL""", *_EX)
def label_files(spark, d):
    return R.label_files(A.images(spark, d), _exported(spark, d))


@query("""SELECT image_id, coalesce(a, 0) AS n_actual, coalesce(m, 0) AS n_manifest FROM (SELECT image_id, count(*) AS a FROM ex WHERE outcome = 'EXPORTED' AND annotation_id NOT LIKE '1:%' GROUP BY 1) FULL JOIN
    (SELECT image_id, count(*) AS m FROM ex WHERE outcome = 'EXPORTED' GROUP BY 1) USING (image_id) WHERE coalesce(a, 0) <> coalesce(m, 0)""", *_EX)
def box_count_mismatch(spark, d):
    e = _exported(spark, d).where("outcome = 'EXPORTED'")
    return R.box_count_mismatch(e.where("annotation_id NOT LIKE '1:%'"), R.label_files(A.images(spark, d), e))


A.SQL["qc_manifest"] = """c AS (SELECT image_id, count(*) AS n_actual FROM ex WHERE outcome = 'EXPORTED' GROUP BY image_id),
    m AS (SELECT image_id, CASE WHEN image_id % 7 = 0 THEN 0 WHEN image_id % 5 = 0 THEN coalesce(n_actual, 0) + 1 ELSE coalesce(n_actual, 0) END AS n_manifest FROM images LEFT JOIN c USING (image_id) WHERE image_id % 11 <> 0)"""


@query("""SELECT check_name, n AS n_errors, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
    SELECT 'box_count_mismatch' AS check_name, count(*) AS n FROM m FULL JOIN c USING (image_id) WHERE CASE WHEN n_manifest > 0 THEN n_manifest ELSE 0 END <> coalesce(n_actual, 0)
    UNION ALL SELECT 'label_line_error', count(*) FROM ex WHERE outcome = 'EXPORTED' AND image_id % 13 = 0
    UNION ALL SELECT 'image_not_in_manifest', count(*) FROM images WHERE image_id % 11 = 0 AND image_id % 17 <> 0 UNION ALL SELECT 'manifest_without_image', count(*) FROM images WHERE image_id % 17 = 0 AND image_id % 11 <> 0
    UNION ALL SELECT 'negative_with_box', count(*) FROM m JOIN c USING (image_id) WHERE n_manifest = 0)""", *_EX, "qc_manifest")
def release_qc(spark, d):
    """The manifest and the lines are broken on purpose, so that every check has errors to count."""
    i, e = A.images(spark, d), _exported(spark, d)
    n = F.when(F.col("image_id") % 7 == 0, 0).when(F.col("image_id") % 5 == 0, F.col("n_lines") + 1).otherwise(F.col("n_lines"))
    manifest = R.label_files(i, e).where("image_id % 11 <> 0").withColumn("n_lines", n)
    worse = (
        F.when(F.col("image_id") % 13 != 0, F.col("label_line")).when(F.col("image_id") % 2 == 0, F.concat("label_line", F.lit(" 1"))).when(F.col("image_id") % 3 == 0, F.concat(F.lit("1"), F.substring("label_line", 2, 99)))
        .otherwise("0 0.5 0.5 nan 1.5")
    )
    return R.release_qc(i.where("image_id % 17 <> 0"), e.withColumn("label_line", worse), manifest)


@query("""SELECT dataset, coalesce(n_actual, 0) AS n_actual, coalesce(n_expected, 0) AS n_expected, CASE WHEN coalesce(n_actual, 0) = coalesce(n_expected, 0) THEN 'PASS' ELSE 'FAIL' END AS status FROM
    (SELECT dataset, count(*) AS n_actual FROM images GROUP BY dataset) FULL JOIN (SELECT * FROM (VALUES ('DS0', 5000::BIGINT), ('DS1', 10), ('DS9', 0)) t(dataset, n_expected)) USING (dataset)""", "images")
def release_contract(spark, d):
    expected = spark.createDataFrame([("DS0", 5000), ("DS1", 10), ("DS9", 0)], "dataset string, n long")
    return R.release_contract(A.images(spark, d).groupBy("dataset").agg(F.count(F.lit(1)).alias("n")), expected, ["dataset"])


# ---- scoring


@query("""SELECT p.image_id, pred_no, annotation_id, i / (a + b - i) AS iou FROM (SELECT p.image_id, pred_no, annotation_id, (least(p.xmax, l.xmax) - greatest(p.xmin, l.xmin)) * (least(p.ymax, l.ymax) - greatest(p.ymin, l.ymin)) AS i,
    (p.xmax - p.xmin) * (p.ymax - p.ymin) AS a, (l.xmax - l.xmin) * (l.ymax - l.ymin) AS b FROM predictions p JOIN labels_ l ON p.image_id = l.image_id AND p.xmin < l.xmax AND l.xmin < p.xmax AND p.ymin < l.ymax AND l.ymin < p.ymax) p""", "images", "boxes_raw", "predictions", "labels_")
def iou_candidates(spark, d):
    return E.iou_candidates(A.predictions(spark, d), A.labels(spark, d)).select("image_id", "pred_no", "annotation_id", "iou")


#: Candidates of an image are taken one after the other; ``used`` are the predictions and labels taken so far.
A.SQL["matched"] = """pairs AS (SELECT p.dataset, p.image_id, pred_no, confidence, annotation_id, i / (a + b - i) AS iou FROM (SELECT p.dataset, p.image_id, pred_no, confidence, annotation_id,
        (least(p.xmax, l.xmax) - greatest(p.xmin, l.xmin)) * (least(p.ymax, l.ymax) - greatest(p.ymin, l.ymin)) AS i, (p.xmax - p.xmin) * (p.ymax - p.ymin) AS a, (l.xmax - l.xmin) * (l.ymax - l.ymin) AS b
        FROM predictions p JOIN labels_ l ON p.image_id = l.image_id AND p.xmin < l.xmax AND l.xmin < p.xmax AND p.ymin < l.ymax AND l.ymin < p.ymax) p),
    cand AS (SELECT *, row_number() OVER (PARTITION BY image_id, threshold ORDER BY confidence DESC, pred_no, iou DESC, annotation_id DESC) AS k FROM pairs, (VALUES {thresholds}) t(threshold) WHERE iou >= threshold),
    walk AS (SELECT image_id, threshold, k, pred_no, annotation_id, iou, true AS free, ['p' || pred_no, 'l' || annotation_id] AS used FROM cand WHERE k = 1
        UNION ALL SELECT image_id, threshold, k, pred_no, annotation_id, iou, free, CASE WHEN free THEN used || ['p' || pred_no, 'l' || annotation_id] ELSE used END FROM (
            SELECT c.image_id, c.threshold, c.k, c.pred_no, c.annotation_id, c.iou, used, NOT list_contains(used, 'p' || c.pred_no) AND NOT list_contains(used, 'l' || c.annotation_id) AS free
            FROM walk w JOIN cand c ON c.image_id = w.image_id AND c.threshold = w.threshold AND c.k = w.k + 1)),
    matched AS (SELECT image_id, threshold, pred_no, annotation_id, iou FROM walk WHERE free)"""
A.SQL["matched_50"] = A.SQL["matched"].format(thresholds="(0.5::DOUBLE)")
A.SQL["matched"] = A.SQL["matched"].format(thresholds=", ".join(f"({x}::DOUBLE)" for x in E.THRESHOLDS))
_AP = """SELECT threshold, confidence, {by}, n_labels, CAST(coalesce(n_tp, 0) AS BIGINT) AS n_tp, round(coalesce(area, 0) / n_labels, 9) AS ap
    FROM (SELECT *, unnest([{thresholds}]) AS threshold FROM (SELECT {by}, count(*) AS n_labels FROM {labels} GROUP BY ALL)) CROSS JOIN (VALUES {floors}) f(confidence) LEFT JOIN (
        SELECT threshold, confidence, {by}, count(*) AS n_tp, sum(envelope) AS area FROM (
            SELECT threshold, confidence, {by}, max(n_tp / rank) OVER (PARTITION BY threshold, confidence, {by} ORDER BY rank DESC) AS envelope FROM (
                SELECT threshold, f.confidence, {by}, rank, row_number() OVER (PARTITION BY threshold, f.confidence, {by} ORDER BY rank) AS n_tp FROM {matched} JOIN (
                    SELECT {by}, image_id, pred_no, confidence AS own, row_number() OVER (PARTITION BY {by} ORDER BY confidence DESC, md5(image_id || ':' || pred_no), pred_no) AS rank FROM {predictions}) USING (image_id, pred_no)
                    CROSS JOIN (VALUES {floors}) f(confidence) WHERE own >= f.confidence))
        GROUP BY ALL) USING (threshold, confidence, {by})"""
#: Confidences from which predictions count.
FLOORS = (0.0, 0.5)
_FLOORS = ", ".join(f"({x}::DOUBLE)" for x in FLOORS)
_EVAL = ("images", "boxes_raw", "predictions", "labels_")
_ALL = _AP.format(by="dataset", labels="labels_", predictions="predictions", matched="matched", floors=_FLOORS, thresholds=", ".join(f"{x}::DOUBLE" for x in E.THRESHOLDS))
A.SQL["diag"] = """diag AS (SELECT image_id, coalesce(m, 0) AS tp, coalesce(n, 0) - coalesce(m, 0) AS fn, coalesce(p, 0) - coalesce(m, 0) AS fp FROM (SELECT image_id, count(*) AS n FROM labels_ GROUP BY 1)
    FULL JOIN (SELECT image_id, count(*) AS p FROM predictions GROUP BY 1) USING (image_id) LEFT JOIN (SELECT image_id, count(*) AS m FROM matched GROUP BY 1) USING (image_id))"""


def _rounded(df):
    return df.withColumn("ap", F.round("ap", 9))


def _scored(spark, d, thresholds=E.THRESHOLDS):
    p, t = A.predictions(spark, d), A.labels(spark, d)
    return p, t, E.match_predictions(E.iou_candidates(p, t), thresholds, A.n_tasks(spark, d))


def _found(spark, d, thresholds=E.THRESHOLDS):
    p, t = A.predictions(spark, d), A.labels(spark, d)
    return p, t, E.match_bits(E.iou_candidates(p, t), thresholds, A.n_tasks(spark, d))


@query("SELECT * FROM matched", *_EVAL, "matched_50")
def match_predictions(spark, d):
    return _scored(spark, d, (0.5,))[2].drop("confidence")


def _ap(spark, d):
    t = A.labels(spark, d)
    return _rounded(E.scored_average_precision(E.scored_predictions(A.predictions(spark, d), t, E.THRESHOLDS, A.n_tasks(spark, d)), t, "dataset", floors=FLOORS))


@query(_ALL, *_EVAL, "matched")
def average_precision(spark, d):
    return _ap(spark, d)


@query(f"SELECT dataset, confidence, round(avg(ap), 7) AS map, max(CASE WHEN threshold = 0.5 THEN ap END) AS ap50 FROM ({_ALL}) GROUP BY ALL", *_EVAL, "matched")
def map50_95(spark, d):
    return E.map50_95(_ap(spark, d), "dataset", "confidence").withColumn("map", F.round("map", 7))


@query(f"""SELECT 0.5::DOUBLE AS threshold, confidence, dataset, size_group, count(*) AS n_labels, count(*) FILTER (WHERE own >= confidence) AS n_found, count(*) FILTER (WHERE own >= confidence) / count(*) AS recall FROM (
    SELECT dataset, image_id, annotation_id, CASE WHEN s < 25 THEN '<25' WHEN s < 50 THEN '25–49' ELSE '≥50' END AS size_group
    FROM (SELECT *, least(xmax - xmin, ymax - ymin) * least(640.0::DOUBLE / 960, 480.0::DOUBLE / 540) AS s FROM labels_))
    LEFT JOIN (SELECT image_id, annotation_id, max(p.confidence) AS own FROM matched JOIN predictions p USING (image_id, pred_no) GROUP BY ALL) USING (image_id, annotation_id) CROSS JOIN (VALUES {_FLOORS}) f(confidence) GROUP BY ALL""", *_EVAL, "matched_50")
def recall_by_size(spark, d):
    _, t, m = _scored(spark, d, (0.5,))
    sized = B.device_size_group(t.withColumn("width", F.lit(960)).withColumn("height", F.lit(540)))
    return E.recall_by(sized, m, "dataset", "size_group", floors=FLOORS)


@query("SELECT * FROM diag", *_EVAL, "matched_50", "diag")
def image_diagnostics(spark, d):
    return E.image_diagnostics(*_scored(spark, d, (0.5,)), A.n_tasks(spark, d))


@query("""SELECT *, 'WORST' AS kind FROM (SELECT * FROM diag ORDER BY fn DESC, fp DESC, tp, image_id LIMIT 3) UNION ALL
    SELECT *, 'BEST' FROM (SELECT * FROM diag ORDER BY fn, fp, tp DESC, image_id LIMIT 3)""", *_EVAL, "matched_50", "diag")
def top_k_images(spark, d):
    return E.top_k_images(E.image_diagnostics(*_scored(spark, d, (0.5,)), A.n_tasks(spark, d)))


_COND = "(SELECT *, unnest(list_filter([CASE WHEN lighting = 'DAY' THEN 'DAY' END, CASE WHEN lighting = 'NIGHT' THEN 'NIGHT' END, CASE WHEN weather LIKE '%RAIN%' THEN 'RAIN' END], lambda x: x IS NOT NULL)) AS condition FROM {} JOIN sequences USING (dataset, sequence_id))"


@query(f"""SELECT condition, n_images, n_labels, CASE WHEN n_images >= 30 AND n_labels >= 100 THEN ap END AS ap, CASE WHEN n_images >= 30 AND n_labels >= 100 THEN 'MEASURED' ELSE 'NOT_MEASURED_TOO_SMALL' END AS status
    FROM ({_AP.format(by="condition", labels=_COND.format("labels_"), predictions=_COND.format("predictions"), matched="matched", floors="(0::DOUBLE)", thresholds="0.5::DOUBLE")})
    JOIN (SELECT condition, count(*) AS n_images FROM {_COND.format("images")} GROUP BY ALL) USING (condition)""", *_EVAL, "sequences", "matched_50")
def condition_metrics(spark, d):
    s = A.sequences(spark, d)
    on = ["dataset", "sequence_id"]
    t = A.labels(spark, d)
    scored, labels = (E.condition_rows(rows.join(s, on)) for rows in (E.scored_predictions(A.predictions(spark, d), t, (0.5,), A.n_tasks(spark, d)), t))
    return E.condition_metrics(_rounded(E.scored_average_precision(scored, labels, "condition", thresholds=(0.5,))), E.condition_rows(A.images(spark, d).join(s, on)))


@query("""SELECT *, n_both / n_night AS share_of_night, n_both / n_rain AS share_of_rain FROM (SELECT count(*) FILTER (WHERE lighting = 'NIGHT') AS n_night, count(*) FILTER (WHERE weather LIKE '%RAIN%') AS n_rain,
    count(*) FILTER (WHERE lighting = 'NIGHT' AND weather LIKE '%RAIN%') AS n_both FROM images JOIN sequences USING (dataset, sequence_id))""", "images", "sequences")
def condition_overlap(spark, d):
    return E.condition_overlap(A.images(spark, d).join(A.sequences(spark, d), ["dataset", "sequence_id"]))


@query("""SELECT dataset, count(*) AS n_raw, count(*) FILTER (WHERE g) AS n_ignored, count(*) FILTER (WHERE NOT g) AS n_eligible FROM (SELECT p.dataset, (xmin + xmax) / 2 BETWEEN "left" AND "right" AND (ymin + ymax) / 2 BETWEEN top AND bottom AS g
    FROM predictions p JOIN regions USING (sequence_id)) GROUP BY dataset""", "images", "boxes_raw", "predictions", "regions")
def prediction_counts(spark, d):
    return E.prediction_counts(A.predictions(spark, d), A.regions(spark, d))


# ---- tracks


A.SQL["seg"] = """seg AS (SELECT * EXCLUDE (c), CAST(sum(c) OVER (PARTITION BY sequence_id, track_id ORDER BY frame_id) AS BIGINT) AS segment FROM (
    SELECT *, CASE WHEN frame_id - lag(frame_id) OVER (PARTITION BY sequence_id, track_id ORDER BY frame_id) - 1 > 24 THEN 1 ELSE 0 END AS c FROM tracks))"""


@query("SELECT sequence_id, track_id, frame_id, segment FROM seg", "tracks", "seg")
def track_segments(spark, d):
    return K.track_segments(A.tracks(spark, d), 24).select("sequence_id", "track_id", "frame_id", "segment")


@query("""SELECT a.sequence_id, a.track_id, a.frame_id, round(median(3.6 * sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) / (a.frame_id - b.frame_id)), 6) AS speed FROM seg a LEFT JOIN seg b ON a.sequence_id = b.sequence_id AND a.track_id = b.track_id AND a.segment = b.segment
    AND a.frame_id - b.frame_id BETWEEN 24 AND 48 GROUP BY ALL""", "tracks", "seg")
def track_speed(spark, d):
    out = K.track_speed(K.track_segments(A.tracks(spark, d), 24), 48)
    return out.select("sequence_id", "track_id", "frame_id", F.round("speed", 6).alias("speed"))


#: The state machine, one point of every track a step: since when it stands (ss) or moves (ms), the open event (es to el), the one just closed (done).
A.SQL["alerts"] = """sp AS (SELECT *, row_number() OVER (PARTITION BY sequence_id, track_id ORDER BY frame_id) AS k, max(frame_id) OVER (PARTITION BY sequence_id) - 1.0 AS last FROM (
        SELECT a.sequence_id, a.track_id, a.frame_id, a.segment, a.frame_id - 1.0 AS now, sqrt(a.x * a.x + a.y * a.y) AS away,
            median(3.6 * sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) / (a.frame_id - b.frame_id)) AS v
        FROM seg a LEFT JOIN seg b ON a.sequence_id = b.sequence_id AND a.track_id = b.track_id AND a.segment = b.segment AND a.frame_id - b.frame_id BETWEEN 24 AND 48 GROUP BY ALL)),
    st AS (SELECT sequence_id, track_id, k, segment, now::DOUBLE AS now, NULL::DOUBLE AS ss, NULL::DOUBLE AS ms, NULL::STRUCT(es DOUBLE, ea DOUBLE, ev DOUBLE, er DOUBLE, el DOUBLE) AS e,
            NULL::STRUCT(es DOUBLE, ea DOUBLE, ev DOUBLE, er DOUBLE, el DOUBLE) AS done, NULL::DOUBLE AS ended, NULL::VARCHAR AS why FROM sp WHERE k = 1
        UNION ALL SELECT sequence_id, track_id, k, segment, now, CASE WHEN over THEN NULL ELSE ss END, CASE WHEN over OR opens THEN NULL ELSE ms END,
            CASE WHEN over THEN NULL WHEN opens THEN {{'es': ss, 'ea': now, 'ev': v, 'er': away, 'el': now}} WHEN e IS NOT NULL AND v IS NOT NULL THEN {{'es': e.es, 'ea': e.ea, 'ev': e.ev, 'er': e.er, 'el': now}} ELSE e END,
            CASE WHEN over THEN e ELSE gone END, CASE WHEN over THEN now ELSE was END, CASE WHEN over THEN 'MOTION_RESUMED' WHEN gone IS NOT NULL THEN 'TRACK_LOST' END FROM (
                SELECT *, e IS NULL AND v <= {stop} AND now - ss >= {stop_s} AS opens, e IS NOT NULL AND v >= {resume} AND now - ms >= {resume_s} AS over FROM (
                    SELECT * EXCLUDE (ss, ms), CASE WHEN e IS NULL AND v <= {stop} THEN coalesce(ss, now) WHEN e IS NULL AND v >= {resume} THEN NULL ELSE ss END AS ss,
                        CASE WHEN e IS NOT NULL AND v <= {stop} THEN NULL WHEN e IS NOT NULL AND v >= {resume} THEN coalesce(ms, now) ELSE ms END AS ms FROM (
                        SELECT p.sequence_id, p.track_id, p.k, p.segment, p.now::DOUBLE AS now, p.v, p.away, s.now AS was, CASE WHEN cut THEN s.e END AS gone,
                            CASE WHEN NOT cut THEN s.e END AS e, CASE WHEN NOT cut THEN s.ss END AS ss, CASE WHEN NOT cut THEN s.ms END AS ms
                        FROM (SELECT *, k + 1 AS nk FROM st) s JOIN sp p ON p.sequence_id = s.sequence_id AND p.track_id = s.track_id AND p.k = s.nk, LATERAL (SELECT p.segment <> s.segment AS cut))))),
    alerts AS (SELECT *, row_number() OVER (PARTITION BY sequence_id ORDER BY alerted_at_s, track_id) AS event_no FROM (
        SELECT sequence_id, track_id, done.es AS started_at_s, done.ea AS alerted_at_s, done.ev AS speed_kmh_at_alert, done.er AS range_m_at_alert, done.el AS last_seen_at_s, ended AS ended_at_s, why AS end_reason FROM st WHERE done IS NOT NULL
        UNION ALL SELECT sequence_id, track_id, e.es, e.ea, e.ev, e.er, e.el, CASE WHEN last - now > 24 THEN now ELSE last END, CASE WHEN last - now > 24 THEN 'TRACK_LOST' ELSE 'END_OF_REPLAY' END FROM (
            SELECT st.*, sp.last, row_number() OVER (PARTITION BY sequence_id, track_id ORDER BY k DESC) AS back FROM st JOIN sp USING (sequence_id, track_id, k)) WHERE back = 1 AND e IS NOT NULL))""".format(
    stop=STOP_RULES.stop_speed, resume=STOP_RULES.resume_speed, stop_s=STOP_RULES.stop_seconds, resume_s=STOP_RULES.resume_seconds
)
_ALERTS = ("tracks", "seg", "alerts")
_ROUNDED = ("speed_kmh_at_alert", "range_m_at_alert")


def _alerts(spark, d):
    return K.number_events(K.stop_alert_batch(A.tracks(spark, d), STOP_RULES))


@query(f"""SELECT * EXCLUDE ({", ".join(_ROUNDED)}), round(speed_kmh_at_alert, 6) AS speed_kmh_at_alert, round(range_m_at_alert, 6) AS range_m_at_alert,
    sequence_id || '_EV' || lpad(CAST(event_no AS VARCHAR), 5, '0') AS event_id FROM alerts""", *_ALERTS)
def stop_alert_batch(spark, d):
    return _alerts(spark, d).withColumns({c: F.round(c, 6) for c in _ROUNDED})


@query("SELECT sequence_id, end_reason, count(*) AS n_events, sum(ended_at_s - started_at_s) AS stopped_s, count(DISTINCT track_id) AS n_tracks FROM alerts GROUP BY ALL", *_ALERTS)
def replay_summary(spark, d):
    return K.replay_summary(_alerts(spark, d))


#: What each track should have raised: one interval from its first frame on.
A.SQL["found"] = """found AS (SELECT x.sequence_id, x.track_id, x.sequence_id || ':' || x.track_id AS expected_id, s AS expected_start_s, a.alerted_at_s, a.event_no
    FROM (SELECT sequence_id, track_id, min(frame_id)::DOUBLE AS s FROM tracks WHERE track_id % 3 = 0 GROUP BY ALL) x LEFT JOIN alerts a ON a.sequence_id = x.sequence_id AND a.track_id = x.track_id AND a.alerted_at_s BETWEEN s AND s + 200
    QUALIFY row_number() OVER (PARTITION BY x.sequence_id, x.track_id ORDER BY a.alerted_at_s) = 1)"""


def _expected(spark, d):
    return A.tracks(spark, d).groupBy("sequence_id", "track_id").agg(F.min("frame_id").alias("f")).selectExpr(
        "sequence_id", "track_id", "concat(sequence_id, ':', track_id) AS event_id", "CAST(f AS DOUBLE) AS expected_start_s", "CAST(f + 200 AS DOUBLE) AS expected_end_s",
        "if(track_id % 3 = 0, 'APPROVED', 'DRAFT') AS approval_status",
    )


@query("""SELECT sequence_id, track_id, expected_id, expected_start_s, alerted_at_s, CASE WHEN event_no IS NOT NULL THEN sequence_id || '_EV' || lpad(CAST(event_no AS VARCHAR), 5, '0') END AS event_id FROM found""", *_ALERTS, "found")
def match_expected_events(spark, d):
    return K.match_expected_events(_expected(spark, d), _alerts(spark, d))


@query("""SELECT n_expected, n_alerts, n_expected - n_matched AS n_missed, (n_alerts - n_matched) / 0.2 AS false_alerts_per_hour, mean_latency_s, 'MEASURED' AS status FROM (
    SELECT count(*) AS n_expected, count(event_no) AS n_matched, avg(alerted_at_s - expected_start_s) AS mean_latency_s FROM found), (SELECT count(*) AS n_alerts FROM alerts)""", *_ALERTS, "found")
def alert_metrics(spark, d):
    a = _alerts(spark, d)
    return K.alert_metrics(K.match_expected_events(_expected(spark, d), a), a, hours=0.2)


# ---- metadata


@query("""SELECT k, array_to_string(list_filter([CASE WHEN k % 5 = 0 THEN 'LICENSE_NOT_VERIFIED' END, CASE WHEN k % 4 IN (1, 2) THEN 'LICENSE_NAME_UNKNOWN' END, CASE WHEN k % 3 = 2 THEN 'PERMISSION_MISSING' END,
    CASE WHEN k // 4 % 4 IN (2, 3) THEN 'REDISTRIBUTION_UNKNOWN' END, CASE WHEN k % 7 = 0 THEN 'NOT_APPROVED_FOR_DOWNLOAD' END], lambda x: x IS NOT NULL), '|') AS issues,
    CASE WHEN k % 5 = 0 OR k % 4 IN (1, 2) OR k % 3 = 2 OR k // 4 % 4 IN (2, 3) OR k % 7 = 0 THEN 'BLOCKED' ELSE 'PASS' END AS result FROM (SELECT s_suppkey AS k FROM supplier)""")
def source_license_issues(spark, d):
    rows = A.table(spark, d, "supplier").selectExpr(
        "s_suppkey AS k", "nullif(s_suppkey % 5, 0) IS NOT NULL AS license_verified", "element_at(array('CC-BY', '', 'UNVERIFIED', 'CC0'), CAST(s_suppkey % 4 AS INT) + 1) AS license_name",
        "element_at(array('APPROVED', 'NOT_REQUIRED', 'PENDING'), CAST(s_suppkey % 3 AS INT) + 1) AS permission_status",
        "element_at(array('YES', 'NO', 'UNVERIFIED', NULL), CAST(s_suppkey div 4 % 4 AS INT) + 1) AS redistribution_allowed", "if(s_suppkey % 7 = 0, 'DRAFT', 'APPROVED_FOR_DOWNLOAD') AS review_status")
    return M.source_license_issues(rows).select("k", F.array_join("issues", "|").alias("issues"), "result")


def _videos(spark, d):
    return A.table(spark, d, "supplier").selectExpr(
        "s_suppkey AS video_id", "element_at(array('DAY', 'NIGHT', 'BACKLIT', 'DUSK'), CAST(s_suppkey % 4 AS INT) + 1) AS lighting", "if(s_suppkey % 3 = 0, 'RAIN', 'CLEAR') AS weather",
        "if(s_suppkey % 8 = 2, 'REVIEWED', 'APPROVED') AS backlit_review_status",
        "element_at(array(25.0D, 30.0D, 12.5D, 2.0D), CAST(s_suppkey div 4 % 4 AS INT) + 1) AS source_fps", "CAST(s_suppkey % 50 AS BIGINT) AS n_frames")


A.SQL["vid"] = """vid AS (SELECT s_suppkey AS video_id, list_filter([(['DAY', 'NIGHT', 'BACKLIT', NULL])[s_suppkey % 4 + 1], CASE WHEN s_suppkey % 3 = 0 THEN 'RAIN' END], lambda x: x IS NOT NULL) AS conditions,
    CAST(s_suppkey % 50 AS BIGINT) AS n_frames, ([25.0, 30.0, 12.5, 2.0])[s_suppkey // 4 % 4 + 1]::DOUBLE AS fps, ([5, 6, 3, 1])[s_suppkey // 4 % 4 + 1] AS step FROM supplier)"""


@query("SELECT video_id, array_to_string(list_sort(conditions), '|') AS conditions FROM vid", "vid")
def video_conditions(spark, d):
    return M.video_conditions(_videos(spark, d)).select("video_id", F.array_join(F.array_sort("conditions"), "|").alias("conditions"))


@query("SELECT video_id, c AS condition, i AS frame_index, CAST(round(i * 1000 / fps) AS BIGINT) AS timestamp_ms FROM (SELECT video_id, unnest(conditions) AS c, n_frames, fps, step FROM vid), LATERAL (SELECT unnest(range(0, n_frames, step)) AS i)", "vid")
def frame_sample_plan(spark, d):
    return M.frame_sample_plan(M.video_conditions(_videos(spark, d)), 5.0)


@query("""SELECT s_suppkey AS sample_id, CASE WHEN s_suppkey % 7 = 0 THEN 'PENDING_REVIEW' WHEN s_suppkey % 4 = 0 THEN 'FALSE_REVIEW_REJECT' WHEN s_suppkey % 4 = 1 THEN 'FALSE_PENDING_SECOND_REVIEW'
    WHEN s_suppkey // 4 % 2 = 0 THEN 'TRUE_DATA_LEAD_APPROVED' ELSE 'TRUE_WITH_CAUTION' END AS training_decision FROM supplier""")
def review_decision(spark, d):
    q = A.table(spark, d, "supplier").selectExpr("s_suppkey AS sample_id")
    decisions = q.where("sample_id % 7 <> 0").selectExpr("sample_id", "element_at(array('NON_VEHICLE', 'UNDETERMINED', 'CONFIRMED_MOTORIZED_VEHICLE', 'LIKELY_MOTORIZED_VEHICLE'), CAST(sample_id % 4 AS INT) + 1) AS visual_assessment",
        "if(sample_id div 4 % 2 = 0, 'DATA_LEAD_SIGNOFF_COMPLETED', 'OPEN') AS review_status")
    return M.review_decision(q, decisions).select("sample_id", "training_decision")


@query("SELECT dataset, sequence_id, 'weather' AS dimension, weather AS value FROM sequences WHERE weather = 'FOG' UNION ALL SELECT dataset, sequence_id, 'lighting', lighting FROM sequences WHERE lighting = 'TWILIGHT'", "images", "sequences")
def allowed_values_check(spark, d):
    known = [("weather", w) for w in ("CLEAR", "RAIN", "LIGHT_RAIN")] + [("lighting", x) for x in ("DAY", "NIGHT")]
    return M.allowed_values_check(A.sequences(spark, d), spark.createDataFrame(known, "dimension string, value string"), ["dataset", "sequence_id"], ["weather", "lighting"])


@query("SELECT 'd/' || doc_id AS relative_path, CAST(sum(c) AS BIGINT) AS n_issues FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 1 ELSE 0 END + CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END AS c FROM documents) GROUP BY ALL HAVING sum(c) > 0")
def checksum_manifest_validate(spark, d):
    rows = A.table(spark, d, "documents").select(F.concat(F.lit("d/"), "doc_id").alias("relative_path"), F.when(F.col("doc_id") % 5 == 0, "x").otherwise(F.octet_length("text").cast("string")).alias("size_bytes"),
        F.when(F.col("doc_id") % 7 == 0, "abc").otherwise(F.sha2("text", 256)).alias("sha256"))
    out = M.checksum_manifest_validate(rows).where(F.size("issues") > 0)
    return out.select("relative_path", F.size("issues").cast("bigint").alias("n_issues"))


@query("SELECT o_custkey AS id, count(*) AS n_rows FROM orders GROUP BY o_custkey HAVING count(*) > 1")
def metadata_check(spark, d):
    rows = A.table(spark, d, "orders").select(F.col("o_custkey").alias("id"))
    return M.metadata_check(rows, "id").groupBy("id").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT dataset, sequence_id, s AS overall_score, CASE WHEN s >= 4.3 THEN 'HIGHLY_RELEVANT' ELSE 'RELEVANT' END AS relevance_level FROM (SELECT *, round(least(5.0, CASE camera_view WHEN 'HIGH' THEN 4.4 ELSE 3.9 END
    + CASE WHEN lighting IN ('NIGHT', 'TWILIGHT') THEN 0.2 ELSE 0 END + CASE WHEN weather LIKE '%RAIN%' THEN 0.2 ELSE 0 END)::DOUBLE, 2) AS s FROM sequences)""", "images", "sequences")
def viewpoint_score(spark, d):
    return M.viewpoint_score(A.sequences(spark, d)).select("dataset", "sequence_id", "overall_score", "relevance_level")


@query("SELECT sequence_id, 2::BIGINT AS n_versions FROM regions WHERE \"left\" > 30", "images", "regions")
def regions_conflict(spark, d):
    r = A.regions(spark, d)
    again = r.withColumn("right", F.when(F.col("left") > 30, F.col("right") + 1).otherwise(F.col("right")))
    return M.regions_conflict(r.withColumn("reading", F.lit(1)).unionByName(again.withColumn("reading", F.lit(2))))


@query("SELECT dataset, sequence_id FROM sp WHERE sequence_id IN ('SEQ3', 'SEQ11', 'SEQ5') AND split <> 'cross_test'", *_SP)
def missing_fixed_members(spark, d):
    return M.missing_fixed_members(A.sequences(spark, d).where("sequence_id IN ('SEQ3', 'SEQ11', 'SEQ5')"), _assigned(spark, d))


@query("SELECT dataset, sequence_id, max_by(split, ordinal) AS split FROM (SELECT dataset, sequence_id, CASE image_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'cross_test' END AS split, image_id AS ordinal FROM images) GROUP BY ALL", "images")
def distinct_splits(spark, d):
    return M.distinct_splits(A.images(spark, d).selectExpr("dataset", "sequence_id", "CASE image_id % 3 WHEN 0 THEN 'train' WHEN 1 THEN 'validation' ELSE 'cross_test' END AS split", "image_id AS ordinal"))


@query("SELECT image_id, CASE WHEN file_group = 1 THEN 'EXTRA_IMAGE' ELSE 'FILTERED_BUT_STILL_COUNTED' END AS issue FROM images WHERE file_group IN (1, 2)", "images")
def manifest_reconcile(spark, d):
    i = A.images(spark, d)
    return M.manifest_reconcile(i.where("file_group <> 2"), i.where("file_group <> 1"))


@query("""SELECT image_id, CASE WHEN n = 0 THEN 'EMPTY_LABEL_NOT_LISTED' ELSE 'LISTED_BUT_HAS_BOXES' END AS issue FROM (SELECT i.image_id, i.file_group, count(x.image_id) AS n FROM images i LEFT JOIN (SELECT image_id FROM ex WHERE outcome = 'EXPORTED') x USING (image_id) GROUP BY ALL)
    WHERE (n = 0) <> (file_group = 0)""", *_EX)
def negative_reconcile(spark, d):
    i = A.images(spark, d)
    return M.negative_reconcile(R.label_files(i, _exported(spark, d)), i.where("file_group = 0"))


@query(f"""SELECT dataset, confidence, coalesce(n_images, 0) AS n_images, coalesce(n_labels, 0) AS n_labels, map, recall, CASE WHEN n_images IS NULL THEN 'NOT_MEASURED_NO_DATA' ELSE 'MEASURED' END AS status FROM (SELECT 'DS' || d AS dataset FROM range(4) t(d)) CROSS JOIN (VALUES {_FLOORS}) f(confidence)
    LEFT JOIN (SELECT dataset, count(*) AS n_images FROM images GROUP BY 1) USING (dataset)
    LEFT JOIN (SELECT dataset, confidence, round(avg(ap), 7) AS map, max(n_labels) AS n_labels, round(max(CASE WHEN threshold = 0.5 THEN n_tp END) / max(n_labels), 9) AS recall FROM ({_ALL}) GROUP BY ALL) USING (dataset, confidence)""", *_EVAL, "matched")
def metric_by_dataset(spark, d):
    expected = spark.createDataFrame([(f"DS{k}",) for k in range(4)], "dataset string")
    p, t, found = _found(spark, d)
    path = new_path(spark, "matches")  # of one matching for all thresholds
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    m = found.where(F.shiftright("bits", E.THRESHOLDS.index(0.5)).bitwiseAND(1) > 0).withColumn("threshold", F.lit(0.5))
    ap = _rounded(E.average_precision(p, t, found, "dataset", floors=FLOORS, n_tasks=A.n_tasks(spark, d)))
    out = M.metric_by_dataset(ap, E.recall_by(t, m, "dataset", floors=FLOORS), A.images(spark, d), expected, FLOORS)
    return out.withColumn("map", F.round("map", 7)).withColumn("recall", F.round("recall", 9))


@query("""SELECT dimension, value, count(*) AS n_images, CAST(sum(n) AS BIGINT) AS n_boxes FROM (UNPIVOT (SELECT i.image_id, count(b.image_id) AS n, road_type, lighting FROM images i JOIN sequences USING (dataset, sequence_id) LEFT JOIN boxes_raw b ON b.image_id = i.image_id GROUP BY ALL)
    ON road_type, lighting INTO NAME dimension VALUE value) GROUP BY ALL""", "images", "boxes_raw", "sequences")
def dataset_summary(spark, d):
    n = A.boxes_raw(spark, d).groupBy("image_id").agg(F.count(F.lit(1)).alias("n_boxes"))
    rows = A.images(spark, d).join(A.sequences(spark, d), ["dataset", "sequence_id"]).join(n, "image_id", "left").na.fill(0, ["n_boxes"])
    return M.dataset_summary(rows.select("image_id", "n_boxes", "road_type", "lighting"), ["road_type", "lighting"])


def _sessions(spark, d):
    s = A.table(spark, d, "supplier").selectExpr("if(s_suppkey % 60 = 30, '', concat('S', s_suppkey % 60)) AS session_id", "element_at(array('DAY', 'NIGHT', 'RAIN', 'FOG'), CAST(s_suppkey % 4 AS INT) + 1) AS slice",
        "if(s_suppkey % 11 = 0, 'OTHER', 'OWN') AS source", "if(s_suppkey % 13 = 0, NULL, 'TEST') AS split", "s_suppkey % 5 <> 0 AS locked",
        "if(s_suppkey % 17 = 0, 'DRAFT', 'APPROVED') AS ground_truth_status", "s_suppkey % 2 = 0 AS predictions_ready", "s_suppkey AS ordinal")
    pairs = s.where("ordinal % 60 <> 9").groupBy("session_id").agg(F.count(F.lit(1)).alias("n_pairs"))
    return M.session_qualify(s, pairs, "OWN", "TEST")


A.SQL["ses"] = """ses AS (SELECT *, len(reason) = 0 AS qualified FROM (SELECT k, a, list_filter([CASE WHEN k % 60 = 30 THEN 'MISSING_SESSION_ID' END, CASE WHEN a = 3 THEN 'INVALID_SLICE' END, CASE WHEN rn > 1 THEN 'DUPLICATE_SESSION_SLICE' END, CASE WHEN k % 11 = 0 THEN 'WRONG_SOURCE' END,
    CASE WHEN k % 13 = 0 THEN 'WRONG_SPLIT' END, CASE WHEN k % 5 = 0 THEN 'SESSION_NOT_LOCKED' END, CASE WHEN k % 17 = 0 THEN 'GROUND_TRUTH_NOT_APPROVED' END, CASE WHEN k % 60 = 9 THEN 'NO_COMPLETE_PAIRS' END], lambda x: x IS NOT NULL) AS reason
    FROM (SELECT s_suppkey AS k, s_suppkey % 4 AS a, row_number() OVER (PARTITION BY s_suppkey % 60, s_suppkey % 4 ORDER BY s_suppkey) AS rn FROM supplier)))"""


@query("SELECT k AS ordinal, array_to_string(reason, '|') AS reason, qualified FROM ses", "ses")
def session_qualify(spark, d):
    return _sessions(spark, d).select("ordinal", F.array_join("reason", "|").alias("reason"), "qualified")


@query("""SELECT slice, coalesce(n, 0) AS n_sessions, coalesce(p, 0) AS n_predicted, CASE WHEN n IS NULL AND slice = 'BACKLIT' THEN 'BLOCKED_MISSING_DATA' WHEN n IS NULL THEN 'PENDING_COLLECTION' WHEN p < n THEN 'READY_FOR_INFERENCE' ELSE 'READY_FOR_MAP_CALCULATION' END AS status
    FROM (VALUES ('DAY', 0), ('NIGHT', 1), ('RAIN', 2), ('BACKLIT', 9)) t(slice, a) LEFT JOIN (SELECT a, count(*) AS n, count(*) FILTER (WHERE k % 2 = 0) AS p FROM ses WHERE qualified GROUP BY a) USING (a)""", "ses")
def slice_readiness(spark, d):
    return M.slice_readiness(_sessions(spark, d))


@query("SELECT image_id FROM images JOIN sp USING (dataset, sequence_id) WHERE dataset = 'DS1' AND split = 'train'", *_SP)
def slice_images(spark, d):
    rows = C.join_split(A.images(spark, d), _assigned(spark, d).select("dataset", "sequence_id", "split"))
    return M.slice_images(rows, A.images(spark, d), "DS1", "train").select("image_id")


# ---- windows over events, the same functions that streams use


def _points(spark, d):
    return A.table(spark, d, "events").selectExpr("concat('CAM', user_id % 5) AS sequence_id", "user_id AS track_id", "CAST(ts AS TIMESTAMP) AS ts")


def window_starts(rows):
    return rows.select("sequence_id", F.unix_micros("window_start").alias("start_us"), F.unix_micros("window_end").alias("end_us"), "n_rows", "n_tracks")


@query("SELECT 'CAM' || (user_id % 5) AS sequence_id, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) AS start_us, epoch_us(time_bucket(INTERVAL 1 HOUR, ts)) + 3600000000 AS end_us, count(*) AS n_rows, count(DISTINCT user_id) AS n_tracks FROM events GROUP BY ALL")
def points_tumbling(spark, d):
    return window_starts(W.alerts_tumbling(_points(spark, d), "1 hour", "1 hour"))


@query("""SELECT sequence_id, b + k * 1800000000 AS start_us, b + k * 1800000000 + 3600000000 AS end_us, count(*) AS n_rows, count(DISTINCT user_id) AS n_tracks FROM (SELECT user_id, 'CAM' || (user_id % 5) AS sequence_id, epoch_us(ts) // 1800000000 * 1800000000 AS b FROM events),
    (VALUES (0), (-1)) t(k) GROUP BY ALL""")
def points_sliding(spark, d):
    return window_starts(W.alerts_sliding(_points(spark, d), "1 hour", "1 hour", "30 minutes"))


@query("""SELECT sequence_id, min(t) AS start_us, max(t) + 1800000000 AS end_us, count(*) AS n_rows, count(DISTINCT user_id) AS n_tracks FROM (SELECT *, sum(c) OVER (PARTITION BY sequence_id ORDER BY t) AS g FROM (
    SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY sequence_id ORDER BY t) > 1800000000 THEN 1 ELSE 0 END AS c FROM (SELECT user_id, 'CAM' || (user_id % 5) AS sequence_id, epoch_us(ts) AS t FROM events))) GROUP BY sequence_id, g""")
def points_session(spark, d):
    return window_starts(W.alerts_session(_points(spark, d), "1 hour", "30 minutes"))


@query("SELECT sequence_id, track_id, frame_id, x FROM tracks WHERE frame_id % 5 = 0", "tracks")
def frame_stride(spark, d):
    return W.frame_stride(A.tracks(spark, d), 5).select("sequence_id", "track_id", "frame_id", "x")


# ---- scalar functions


@query(r"""SELECT url, regexp_replace(lower(regexp_replace(url, '^[a-zA-Z]+://', '')), '^www\.', '') AS normal_url, regexp_replace(trim(regexp_replace(lower(url), '[^a-z0-9]+', '_', 'g'), '_'), '^_+', '') AS slug,
    url LIKE '/%' OR url LIKE '%..%' OR url LIKE '%:%' AS unsafe FROM pages""")
def path_functions(spark, d):
    u = F.col("url")
    return A.table(spark, d, "pages").select("url", T.normal_url(u).alias("normal_url"), T.slug(u).alias("slug"), T.unsafe_path(u).alias("unsafe"))


@query(r"""SELECT id, lower(replace(replace(p, '\', '/'), './', '')) AS path, CASE WHEN id % 3 = 0 THEN 'MVI_' || id % 7 WHEN id % 3 = 1 THEN 'cam' ELSE 'img' || lpad(CAST(id AS VARCHAR), 5, '0') END AS sequence, CASE WHEN id % 2 = 0 THEN id END AS frame,
    id % 5 IN (0, 1, 2) AS flag, CASE WHEN id % 4 = 0 THEN id / 4.0 END AS number, CASE WHEN id % 5 IN (0, 1) THEN 'OVERHEAD_TOP_DOWN' WHEN id % 5 = 2 THEN 'FRONT_DASHCAM' ELSE 'ROADSIDE_LEVEL' END AS view,
    CASE WHEN id % 5 IN (1, 4) THEN 'RAIN_OR_WET_ROAD' ELSE 'UNKNOWN' END AS weather FROM (SELECT page_id AS id, './' || CASE WHEN page_id % 3 = 0 THEN 'Data\MVI_' || page_id % 7 || '\' WHEN page_id % 3 = 1 THEN 'Data\cam\' ELSE '' END || 'IMG' || lpad(CAST(page_id AS VARCHAR), 5, '0') || '.JPG' AS p FROM pages)""")
def text_functions(spark, d):
    rows = A.table(spark, d, "pages").selectExpr(
        "page_id AS id", r"concat('./', CASE WHEN page_id % 3 = 0 THEN concat('Data\\MVI_', page_id % 7, '\\') WHEN page_id % 3 = 1 THEN 'Data\\cam\\' ELSE '' END, 'IMG', lpad(CAST(page_id AS STRING), 5, '0'), '.JPG') AS p",
        "if(page_id % 2 = 0, concat(if(page_id % 4 = 0, 'img', 'clip_f'), lpad(CAST(page_id AS STRING), greatest(5, length(CAST(page_id AS STRING))), '0')), 'frame9') AS name", "element_at(array('Yes', ' TRUE', '1', 'no', '0'), CAST(page_id % 5 AS INT) + 1) AS flag",
        "CASE page_id % 4 WHEN 0 THEN CAST(page_id / 4 AS STRING) WHEN 1 THEN 'NaN' WHEN 2 THEN '-Infinity' ELSE 'x1' END AS number",
        "element_at(array('Aerial view', 'overhead, Wet-Road', 'Dashcam clip', 'by the road', 'WET-ROAD street'), CAST(page_id % 5 AS INT) + 1) AS note")
    sequence = T.safe_sequence(F.regexp_replace("p", "^[.]/", ""))
    return rows.select("id", T.normal_path(F.col("p")).alias("path"), F.when(F.col("id") % 3 == 2, F.lower(sequence)).otherwise(sequence).alias("sequence"), T.frame_number(F.col("name")).alias("frame"), T.parse_bool(F.col("flag")).alias("flag"),
        T.finite_double(F.col("number")).alias("number"), T.note_camera_view(F.col("note")).alias("view"), T.note_weather(F.col("note")).alias("weather"))


@query("""SELECT image_id, annotation_id, round(sqrt((gx - 2) * (gx - 2) + (gy + 1) * (gy + 1)), 6) AS range_m FROM (SELECT image_id, annotation_id, (0.02 * x + 0.001 * y + 1.5) / (0.0001 * x + 0.0002 * y + 1) AS gx, (0.0005 * x + 0.03 * y - 2) / (0.0001 * x + 0.0002 * y + 1) AS gy
    FROM (SELECT image_id, annotation_id, (xmin + xmax) / 2 AS x, ymax AS y FROM boxes_raw))""", *_BOX[:2])
def ground_range(spark, d):
    gx, gy = B.ground_project(*B.foot_point(), HOMOGRAPHY)
    return A.boxes_raw(spark, d).select("image_id", "annotation_id", F.round(B.ground_range(gx, gy, (2.0, -1.0)), 6).alias("range_m"))


@query("SELECT image_id, annotation_id FROM boxes_raw WHERE (xmin + xmax) / 2 BETWEEN 96 AND 767 AND (ymin + ymax) / 2 BETWEEN 108 AND 431", *_BOX[:2])
def roi_polygon(spark, d):
    roi = B.roi_polygon({"status": "CALIBRATED", "frame_size_px": (960, 540), "normalized_polygon": [(0.1, 0.2), (0.8, 0.2), (0.8, 0.8), (0.1, 0.8)]})
    x, y = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2
    return A.boxes_raw(spark, d).where(B.point_in_polygon(x, y, roi)).select("image_id", "annotation_id")


@query("SELECT image_id, annotation_id, CASE WHEN image_id % 9 <> 0 THEN 960 END AS width, CASE WHEN image_id % 9 = 0 THEN 'MISSING_IMAGE_METADATA' END AS issue FROM boxes_raw", *_BOX[:2])
def join_image_dims(spark, d):
    return C.join_image_dims(A.boxes_raw(spark, d), A.images(spark, d).where("image_id % 9 <> 0")).select("image_id", "annotation_id", "width", "issue")


@query("SELECT image_id, split FROM images JOIN sp USING (dataset, sequence_id)", *_SP)
def join_split(spark, d):
    return C.join_split(A.images(spark, d), _assigned(spark, d).select("dataset", "sequence_id", "split")).select("image_id", "split")


def _listed(spark, d):
    i = A.images(spark, d).withColumn("source_file", F.concat("dataset", F.lit("/"), "sequence_id", F.lit("/img"), "image_id", F.lit(".jpg")))
    whole = F.col("image_id") % 10 == 0
    listed = i.where("image_id % 5 = 0").select(F.when(whole, F.concat(F.lit("./"), "source_file")).otherwise(F.concat("sequence_id", F.lit("\\IMG"), "image_id", F.lit(".jpg"))).alias("source_file"), F.lit(True).alias("selected"))
    return i, listed.unionByName(i.where("image_id % 5 = 1").select("source_file", F.lit(False).alias("selected")))


@query("""SELECT image_id, wanted, count(*) OVER (PARTITION BY wanted) AS n_matches FROM (SELECT image_id, CASE WHEN image_id % 10 = 0 THEN lower(dataset || '/' || sequence_id || '/img' || image_id || '.jpg') ELSE lower(sequence_id || '/img' || image_id || '.jpg') END AS wanted
    FROM images WHERE image_id % 5 = 0)""", "images")
def select_by_manifest(spark, d):
    return C.select_by_manifest(*_listed(spark, d), strict=False).select("image_id", "wanted", "n_matches")


@query("""SELECT wanted, error FROM (SELECT wanted, CASE WHEN count(*) > 1 THEN 'AMBIGUOUS' END AS error FROM (SELECT lower(sequence_id || '/img' || image_id || '.jpg') AS wanted FROM images WHERE image_id % 5 = 0 AND image_id % 10 <> 0) GROUP BY 1
    UNION ALL SELECT lower('gone/img' || image_id || '.jpg'), 'MISSING' FROM images WHERE image_id % 50 = 3 GROUP BY 1) WHERE error IS NOT NULL""", "images")
def selection_errors(spark, d):
    i, listed = _listed(spark, d)
    gone = i.where("image_id % 50 = 3").select(F.concat(F.lit("gone/img"), "image_id", F.lit(".jpg")).alias("source_file"), F.lit(True).alias("selected"))
    return C.selection_errors(i, listed.unionByName(gone))


@query("SELECT dataset, image_id, CASE WHEN dataset <> 'DS1' THEN sequence_id END AS sequence_id, CASE WHEN dataset = 'DS1' THEN file_group END AS file_group FROM images WHERE dataset <> 'DS2'", "images")
def union_sources(spark, d):
    i = A.images(spark, d)
    return L.union_sources(i.where("dataset = 'DS0'").select("dataset", "image_id", "sequence_id"), i.where("dataset = 'DS1'").select("dataset", "image_id", "file_group"))


def _chunks(spark, d, broken):
    """Reports of the exported boxes in three chunks, from counts that are written once; ``broken`` ones repeat, leave out, add and miscount images."""
    i, path = A.images(spark, d), new_path(spark, "labels")
    labels = R.label_files(i, _exported(spark, d)).select("image_id", "n_lines")
    labels.write.parquet(path)
    labels = spark.read.schema(labels.schema).parquet(path)
    rows = labels.select("image_id", F.col("n_lines").alias("n_boxes"), F.when(F.col("n_lines") == 0, "NO_DETECTION").otherwise("AUTO_ANNOTATED").alias("annotation_status"))
    parts = [rows.where(F.col("image_id") % 3 == k) for k in range(3)]
    if broken:
        parts[0] = parts[0].unionByName(parts[1].where("image_id % 50 = 7")).where("image_id % 40 <> 6")
        parts[1] = parts[1].withColumn("n_boxes", F.expr("n_boxes + if(image_id % 30 = 4, 1, 0)"))
        parts[2] = parts[2].unionByName(parts[2].where("image_id % 60 = 5").withColumn("image_id", F.expr("-image_id")))
        labels = labels.where("image_id % 70 <> 8")
    return parts, i, labels


A.SQL["lines"] = "lines AS (SELECT image_id, count(x.image_id) AS n FROM images LEFT JOIN (SELECT image_id FROM ex WHERE outcome = 'EXPORTED') x USING (image_id) GROUP BY ALL)"


@query("""SELECT image_id, error FROM (SELECT *, unnest([CASE WHEN image_id % 3 = 1 AND image_id % 50 = 7 AND image_id % 40 <> 6 THEN 'DUPLICATE_REPORT' END, CASE WHEN image_id % 3 = 0 AND image_id % 40 = 6 THEN 'MISSING_REPORT' END, CASE WHEN image_id % 70 = 8 THEN 'MISSING_LABEL' END,
        CASE WHEN image_id % 70 <> 8 AND image_id % 3 = 1 AND image_id % 30 = 4 AND NOT (image_id % 50 = 7 AND image_id % 40 <> 6) THEN 'COUNT_MISMATCH' END]) AS error FROM lines) WHERE error IS NOT NULL
    UNION ALL SELECT -image_id, 'EXTRA_REPORT' FROM lines WHERE image_id % 3 = 2 AND image_id % 60 = 5""", *_EX, "lines")
def chunk_errors(spark, d):
    parts, i, labels = _chunks(spark, d, broken=True)
    return R.chunk_errors(parts[0].unionByName(parts[1]).unionByName(parts[2]), i, labels, A.n_tasks(spark, d))


@query("""SELECT image_id, CASE WHEN same THEN 4 ELSE 5 END AS version, CASE WHEN n = 0 THEN 'NO_DETECTION' ELSE 'AUTO_ANNOTATED' END AS auto_annotation_status, n AS auto_box_count FROM (SELECT *, image_id % 4 = 0 AND n > 0 AS same FROM lines)
    UNION ALL SELECT -image_id, 4, 'PENDING', NULL FROM lines WHERE image_id % 90 = 1""", *_EX, "lines")
def merge_chunk_reports(spark, d):
    """The task list after a merge, run twice: some tasks know the answer already, some have no report."""
    parts, i, labels = _chunks(spark, d, broken=False)
    known = F.expr("image_id % 4 = 0 AND n_lines > 0")
    tasks = labels.select("image_id", F.lit(4).alias("version"), F.when(known, "AUTO_ANNOTATED").otherwise("PENDING").alias("auto_annotation_status"), F.when(known, F.col("n_lines")).alias("auto_box_count"))
    tasks = tasks.unionByName(i.where("image_id % 90 = 1").selectExpr("-image_id AS image_id", "4 AS version", "'PENDING' AS auto_annotation_status", "CAST(NULL AS BIGINT) AS auto_box_count"))
    n = A.n_tasks(spark, d)
    once = R.merge_chunk_reports(parts, i, labels, tasks, n)[1]
    return R.merge_chunk_reports(parts, i, labels, once, n)[1]


@query("SELECT count(*) AS n_images, CAST(sum(n) AS BIGINT) AS n_boxes, count(*) FILTER (WHERE n = 0) AS n_images_without_detections, 'PASS' AS validation FROM lines", *_EX, "lines")
def batch_summary(spark, d):
    parts, i, labels = _chunks(spark, d, broken=False)
    return R.batch_summary(R.merge_chunk_reports(parts, i, labels, labels.selectExpr("image_id", "1 AS version", "'' AS auto_annotation_status", "n_lines AS auto_box_count"), A.n_tasks(spark, d))[0])

