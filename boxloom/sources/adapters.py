"""The given tables seen as annotated images, camera tracks and fingerprints.

Each function takes the session and the folder of the tables and returns a domain table; ``SQL`` has the
same tables as DuckDB text, to be put before a query as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Boxes that one task joins and sorts, some 100 MB.
TASK_ROWS = 250_000

#: Targets to which Spark deals rows straight into files; tasks that deal to more hold their split's rows in memory.
STRAIGHT = 200


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def images(spark: SparkSession, folder: str, n: int = 0) -> DataFrame:
    """Images, dealt to ``n`` tasks as keys alone: their columns are put together after that."""
    return dealt(spark, table(spark, folder, "orders"), n, "o_orderkey").selectExpr(
        "concat('DS', o_orderkey % 3) AS dataset", "o_orderkey AS image_id", "concat('SEQ', o_custkey % 40) AS sequence_id",
        "o_orderkey AS frame_id", "960 AS width", "540 AS height", "CAST(o_orderkey % 7 AS INT) AS file_group",
    )


def least_tasks(spark: SparkSession) -> int:
    """Partitions that Spark keeps in any case: it merges the session's down to one a core."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def n_tasks(spark: SparkSession, folder: str, name: str = "lineitem") -> int:
    """Partitions for a shuffle of a table: as many as its rows ask for (counted by the files' footers), not fewer than Spark keeps."""
    return max(least_tasks(spark), -(-table(spark, folder, name).count() // TASK_ROWS))


def dealt(spark: SparkSession, rows: DataFrame, n: int, *by: str) -> DataFrame:
    """Rows dealt by columns to ``n`` tasks, so that a task holds no more as tables grow; left to Spark where those it keeps are enough."""
    return rows.repartition(n, *by) if n > least_tasks(spark) else rows


def boxes_raw(spark: SparkSession, folder: str, n: int = 0) -> DataFrame:
    """Boxes dealt by image; with more partitions the larger the table is, which steps by image keep, or ``n`` of them."""
    n = n or n_tasks(spark, folder)
    lines = table(spark, folder, "lineitem").withColumn("original_class", F.concat("l_returnflag", "l_linestatus"))
    lines = dealt(spark, lines, n, "l_orderkey").join(images(spark, folder, n), F.col("l_orderkey") == F.col("image_id"))
    return lines.selectExpr(
        "dataset", "image_id", "sequence_id", "frame_id",
        "concat_ws(':', l_linenumber, l_partkey, l_suppkey) AS annotation_id", "l_suppkey AS track_id",
        "original_class",
        "CAST(l_partkey % 1000 - 20 AS DOUBLE) AS xmin", "CAST(l_suppkey * 6 - 12 AS DOUBLE) AS ymin",
        "CAST(l_partkey % 1000 - 20 AS DOUBLE) + (CAST(l_quantity AS DOUBLE) - 2) * 4 AS xmax",
        "CAST(l_suppkey * 6 - 12 AS DOUBLE) + CAST((l_partkey % 37) * 3 - 6 AS DOUBLE) AS ymax",
        "CAST(l_tax AS DOUBLE) > 0.04 AS occluded", "CAST(l_discount AS DOUBLE) AS truncation_ratio", "width", "height",
    )


#: Class rules of the adapter, one class left unlisted.
CLASS_RULES = [
    ("AF", "vehicle", True, "EXPORT"), ("NF", "vehicle", True, "EXPORT"), ("NO", "vehicle", True, "EXPORT"),
    ("RF", "vehicle", True, "EXPORT"), ("AO", "other", False, "IGNORE_REGION"), ("RO", "other", False, "EXCLUDE"),
]


def class_rules(spark: SparkSession, folder: str = "") -> DataFrame:
    rows = [(f"DS{d}", *r) for d in range(3) for r in CLASS_RULES if (d, r[0]) != (2, "RF")]
    return spark.createDataFrame(rows, "dataset string, original_class string, mapped_class string, include boolean, handling string")


def sequences(spark: SparkSession, folder: str) -> DataFrame:
    """Scene attributes of each (dataset, sequence), from the sequence number."""
    n = "CAST(substring(sequence_id, 4) AS INT)"
    return images(spark, folder).select("dataset", "sequence_id").distinct().selectExpr(
        "dataset", "sequence_id", f"element_at(array('HIGHWAY', 'URBAN', 'RURAL'), {n} % 3 + 1) AS road_type",
        f"element_at(array('DAY', 'NIGHT', 'TWILIGHT', 'DAY'), {n} % 4 + 1) AS lighting",
        f"element_at(array('CLEAR', 'RAIN', 'LIGHT_RAIN', 'FOG', 'CLEAR'), {n} % 5 + 1) AS weather",
        f"if({n} % 2 = 0, 'HIGH', 'LOW') AS camera_view",
    )


def regions(spark: SparkSession, folder: str) -> DataFrame:
    n = "CAST(substring(sequence_id, 4) AS INT)"
    return images(spark, folder).select("sequence_id").distinct().selectExpr(
        "sequence_id", f"CAST(10 * ({n} % 7) AS DOUBLE) AS left", f"CAST(20 * ({n} % 5) AS DOUBLE) AS top",
        f"CAST(10 * ({n} % 7) + 200 AS DOUBLE) AS right", f"CAST(20 * ({n} % 5) + 150 AS DOUBLE) AS bottom",
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Every box with an area, shifted, with a confidence full of ties."""
    lines = "CAST(split(annotation_id, ':')[0] AS INT)"
    return boxes_raw(spark, folder).where("xmax > xmin AND ymax > ymin").selectExpr(
        "dataset", "sequence_id", "image_id", f"xmin + ({lines} - 3) * 2 AS xmin", "ymin", f"xmax + ({lines} - 3) * 2 AS xmax", "ymax",
        "CAST(CAST(split(annotation_id, ':')[1] AS BIGINT) % 101 AS DOUBLE) / 100 AS confidence", "annotation_id AS pred_no",
    )


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """The boxes with an area, as ground truth."""
    return boxes_raw(spark, folder).where("xmax > xmin AND ymax > ymin").select(
        "dataset", "sequence_id", "image_id", "annotation_id", "xmin", "ymin", "xmax", "ymax"
    )


def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Perceptual hashes near each other in groups, with a content hash, a sequence and a split."""
    base = "CAST(conv(substring(sha2(CAST(vec_id % 100 AS STRING), 256), 1, 15), 16, 10) AS BIGINT)"
    bits = " + ".join(f"if(embedding[{k}] > 0, 1L, 0L) * {2 ** (17 * k)}L" for k in range(4))
    return table(spark, folder, "embeddings").selectExpr(
        "concat('DS', vec_id % 3) AS dataset", "concat('SEQ', vec_id % 7) AS sequence_id", "vec_id AS file_id",
        "concat('img', lpad(CAST(vec_id AS STRING), 6, '0'), '.jpg') AS source_file",
        f"sha2(CAST(({base} ^ ({bits})) % 50 AS STRING), 256) AS sha256", f"{base} ^ ({bits}) AS phash",
        "element_at(array('train', 'validation', 'cross_test', NULL), CAST(vec_id div 100 % 4 AS INT) + 1) AS split",
    )


def pixel_images(spark: SparkSession, folder: str) -> DataFrame:
    """Vectors as grey images of 8 x 8 pixels in the columns of Spark's image source; some are unreadable, dark, bright, black or white."""
    grey = "transform(embedding, e -> 4 * CAST(floor(least(greatest((CAST(e AS DOUBLE) + 0.5) * 64, 0), 63)) AS INT))"
    grey = f"transform({grey}, v -> CASE CAST(vec_id % 20 AS INT) WHEN 1 THEN v div 8 WHEN 2 THEN 255 - v div 8 WHEN 3 THEN 0 WHEN 4 THEN 255 ELSE v END)"
    rows = table(spark, folder, "embeddings").selectExpr(
        "concat('DS', vec_id % 3) AS dataset", "vec_id AS file_id", "vec_id % 150 = 7 AS broken", f"unhex(array_join(transform({grey}, v -> lpad(hex(v), 2, '0')), '')) AS data"
    )
    return rows.selectExpr("dataset", "file_id", "if(broken, -1, 8) AS height", "if(broken, -1, 8) AS width", "1 AS nChannels", "if(broken, NULL, data) AS data")


def tracks(spark: SparkSession, folder: str) -> DataFrame:
    """One ground position a track and hour; the frame is the number of hours."""
    rows = table(spark, folder, "events").selectExpr(
        "concat('CAM', user_id % 5) AS sequence_id", "user_id AS track_id",
        "CAST(floor(unix_micros(CAST(ts AS TIMESTAMP)) / 3600000000.0) AS BIGINT) - 473352 AS frame_id", "CAST(value AS DOUBLE) AS x",
        "CAST(regexp_extract(props, '[0-9]+', 0) AS DOUBLE) / 10 AS y", "event_id",
    )
    first = rows.groupBy("sequence_id", "track_id", "frame_id").agg(F.min_by(F.struct("x", "y"), "event_id").alias("p"))
    return first.select("sequence_id", "track_id", "frame_id", "p.x", "p.y")


SQL = {
    "images": """images AS (
    SELECT 'DS' || (o_orderkey % 3) AS dataset, o_orderkey AS image_id, 'SEQ' || (o_custkey % 40) AS sequence_id,
        o_orderkey AS frame_id, 960 AS width, 540 AS height, CAST(o_orderkey % 7 AS INT) AS file_group FROM orders)""",
    "boxes_raw": """boxes_raw AS (
    SELECT dataset, image_id, sequence_id, frame_id, concat_ws(':', l_linenumber, l_partkey, l_suppkey) AS annotation_id,
        l_suppkey AS track_id, l_returnflag || l_linestatus AS original_class, CAST(l_partkey % 1000 - 20 AS DOUBLE) AS xmin,
        CAST(l_suppkey * 6 - 12 AS DOUBLE) AS ymin,
        CAST(l_partkey % 1000 - 20 AS DOUBLE) + (CAST(l_quantity AS DOUBLE) - 2) * 4 AS xmax,
        CAST(l_suppkey * 6 - 12 AS DOUBLE) + CAST((l_partkey % 37) * 3 - 6 AS DOUBLE) AS ymax,
        CAST(l_tax AS DOUBLE) > 0.04 AS occluded, CAST(l_discount AS DOUBLE) AS truncation_ratio, width, height
    FROM lineitem JOIN images ON l_orderkey = image_id)""",
    "class_rules": "class_rules AS (SELECT 'DS' || d AS dataset, r.* FROM range(3) t(d), (VALUES "
    + ", ".join(f"('{c}', '{m}', {str(i).lower()}, '{h}')" for c, m, i, h in CLASS_RULES)
    + ") r(original_class, mapped_class, include, handling) WHERE NOT (d = 2 AND original_class = 'RF'))",
    "sequences": """sequences AS (
    SELECT dataset, sequence_id, (['HIGHWAY', 'URBAN', 'RURAL'])[n % 3 + 1] AS road_type,
        (['DAY', 'NIGHT', 'TWILIGHT', 'DAY'])[n % 4 + 1] AS lighting,
        (['CLEAR', 'RAIN', 'LIGHT_RAIN', 'FOG', 'CLEAR'])[n % 5 + 1] AS weather,
        CASE WHEN n % 2 = 0 THEN 'HIGH' ELSE 'LOW' END AS camera_view
    FROM (SELECT DISTINCT dataset, sequence_id, CAST(substr(sequence_id, 4) AS INT) AS n FROM images))""",
    "regions": """regions AS (
    SELECT sequence_id, CAST(10 * (n % 7) AS DOUBLE) AS "left", CAST(20 * (n % 5) AS DOUBLE) AS top,
        CAST(10 * (n % 7) + 200 AS DOUBLE) AS "right", CAST(20 * (n % 5) + 150 AS DOUBLE) AS bottom
    FROM (SELECT DISTINCT sequence_id, CAST(substr(sequence_id, 4) AS INT) AS n FROM images))""",
    "predictions": """predictions AS (
    SELECT dataset, sequence_id, image_id, xmin + (l - 3) * 2 AS xmin, ymin, xmax + (l - 3) * 2 AS xmax, ymax,
        CAST(p % 101 AS DOUBLE) / 100 AS confidence, annotation_id AS pred_no
    FROM (SELECT *, CAST(split_part(annotation_id, ':', 1) AS INT) AS l, CAST(split_part(annotation_id, ':', 2) AS BIGINT) AS p
          FROM boxes_raw WHERE xmax > xmin AND ymax > ymin))""",
    "labels_": """labels_ AS (
    SELECT dataset, sequence_id, image_id, annotation_id, xmin, ymin, xmax, ymax FROM boxes_raw WHERE xmax > xmin AND ymax > ymin)""",
    "fingerprints": """fingerprints AS (
    SELECT *, sha256(CAST(phash % 50 AS VARCHAR)) AS sha256 FROM (
        SELECT 'DS' || (vec_id % 3) AS dataset, 'SEQ' || (vec_id % 7) AS sequence_id, vec_id AS file_id,
            'img' || lpad(CAST(vec_id AS VARCHAR), 6, '0') || '.jpg' AS source_file,
            xor(CAST(concat('0x', substr(sha256(CAST(vec_id % 100 AS VARCHAR)), 1, 15)) AS BIGINT), """
    + " + ".join(f"CASE WHEN embedding[{k + 1}] > 0 THEN {2 ** (17 * k)}::BIGINT ELSE 0 END" for k in range(4))
    + """) AS phash, (['train', 'validation', 'cross_test', NULL])[vec_id // 100 % 4 + 1] AS split FROM embeddings))""",
    "tracks": """tracks AS (
    SELECT 'CAM' || (user_id % 5) AS sequence_id, user_id AS track_id, frame_id, min_by(x, event_id) AS x, min_by(y, event_id) AS y FROM (
        SELECT *, CAST(floor(epoch_us(ts) / 3600000000.0) AS BIGINT) - 473352 AS frame_id, CAST(value AS DOUBLE) AS x, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) / 10 AS y FROM events)
    GROUP BY ALL)""",
}


def with_tables(query: str, *names: str) -> str:
    """DuckDB text of a query over domain tables, some of which may be recursive."""
    return "WITH RECURSIVE " + ",\n".join(SQL[n] for n in names) + "\n" + query.strip()
