"""Readers of annotation formats into one box schema. Malformed rows are kept apart, never dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BOX_NUMBERS = ("xmin", "ymin", "xmax", "ymax")
XML_SCHEMA = """_name string,
    sequence_attribute struct<_camera_state: string, _sence_weather: string>,
    ignored_region struct<box: array<struct<_left: double, _top: double, _width: double, _height: double>>>,
    frame array<struct<_num: bigint, _density: bigint, target_list: struct<target: array<struct<_id: bigint,
        box: struct<_left: string, _top: string, _width: string, _height: string>,
        attribute: struct<_vehicle_type: string, _truncation_ratio: string>>>>>>"""
COCO_SCHEMA = """images array<struct<id: bigint, file_name: string, width: int, height: int>>,
    categories array<struct<id: bigint, name: string>>,
    annotations array<struct<id: bigint, image_id: bigint, category_id: bigint, bbox: array<double>>>"""


def read_table_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table with a header and a declared schema; a missing file is an empty table."""
    try:
        rows = spark.read.csv(path, header=True, schema=schema, encoding="UTF-8")
        rows.schema  # noqa: B018  resolves the path
        return rows
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], schema)
        raise


def read_box_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Header-less ``image,class,x1,y1,x2,y2``: good rows, and invalid ones with their issue."""
    part = F.split("value", ",")
    rows = spark.read.text(path).where("trim(value) <> ''").select("value", part.alias("p"))
    numbers = [F.get("p", F.lit(k + 2)).try_cast("double").alias(c) for k, c in enumerate(BOX_NUMBERS)]
    rows = rows.select("value", F.size("p").alias("n"), F.get("p", F.lit(0)).alias("image"), F.get("p", F.lit(1)).alias("original_class"), *numbers)
    missing = F.lit(False)
    for c in BOX_NUMBERS:
        missing = missing | F.col(c).isNull()
    issue = F.when(F.col("n") < 6, "MALFORMED_ROW").when(missing, "NON_NUMERIC_BBOX")
    rows = rows.withColumn("issue", issue).withColumn("annotation_id", F.sha2("value", 256))
    return rows.where("issue IS NULL").drop("issue", "n", "value"), rows.where("issue IS NOT NULL").select("value", "issue")


def read_coco(
    spark: SparkSession, path: str, multi_line: bool = True, annotation_id: str = "bigint", n_tasks: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Images, and boxes with corners; a bad box or a missing image is one issue, kept on the row.

    A file is one document, or one a line if not ``multi_line``; documents may repeat their categories. These are few and
    broadcast, as boxes dealt by category would meet in as many tasks. With ``n_tasks`` boxes and images are dealt by image
    to as many tasks, for documents that the session's number does not fit.
    """
    doc = spark.read.schema(COCO_SCHEMA.replace("annotations array<struct<id: bigint", f"annotations array<struct<id: {annotation_id}")).json(path, multiLine=multi_line)
    images = doc.select(F.explode("images").alias("i")).select("i.*").withColumnRenamed("id", "image_id")
    names = doc.select(F.explode("categories").alias("c")).select(F.col("c.id").alias("category_id"), F.col("c.name").alias("name")).distinct()
    rows = doc.select(F.explode("annotations").alias("a")).select("a.*").withColumnRenamed("id", "annotation_id")
    rows, sizes = rows.join(F.broadcast(names), "category_id", "left"), images.select("image_id", "width", "height")
    if n_tasks:
        rows, sizes = rows.repartition(n_tasks, "image_id"), sizes.repartition(n_tasks, "image_id")
    rows = rows.join(sizes, "image_id", "left")
    box = [F.get("bbox", F.lit(k)) for k in range(4)]
    bad = (F.coalesce(F.size("bbox"), F.lit(0)) != 4) | F.exists("bbox", lambda x: x.isNull()) | F.col("width").isNull()
    return images, rows.select(
        "image_id", "annotation_id", "width", "height",
        F.coalesce("name", F.concat(F.lit("UNKNOWN_CATEGORY_"), "category_id")).alias("original_class"),
        box[0].alias("xmin"), box[1].alias("ymin"), (box[0] + box[2]).alias("xmax"), (box[1] + box[3]).alias("ymax"),
        F.when(bad, "MALFORMED_BBOX_OR_MISSING_IMAGE_METADATA").alias("issue"),
    )


def read_track_xml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Boxes, sequence attributes and ignored regions of track XML; boxes that fail are kept with an issue."""
    doc = spark.read.format("xml").option("rowTag", "sequence").schema(XML_SCHEMA).load(path)
    sequences = doc.select(F.col("_name").alias("sequence_id"), F.col("sequence_attribute._camera_state").alias("camera_state"), F.col("sequence_attribute._sence_weather").alias("weather"))
    regions = doc.select(F.col("_name").alias("sequence_id"), F.explode("ignored_region.box").alias("b")).select(
        "sequence_id", F.col("b._left").alias("left"), F.col("b._top").alias("top"),
        (F.col("b._left") + F.col("b._width")).alias("right"), (F.col("b._top") + F.col("b._height")).alias("bottom"),
    )
    rows = doc.select(F.col("_name").alias("sequence_id"), F.explode("frame").alias("f"))
    rows = rows.select("sequence_id", F.col("f._num").alias("frame_id"), F.explode("f.target_list.target").alias("t"))
    left, top, w, h = (F.col(f"t.box.{c}").try_cast("double") for c in ("_left", "_top", "_width", "_height"))
    issue = F.when(F.col("t.box").isNull(), "MISSING_BOX").when(left.isNull() | top.isNull() | w.isNull() | h.isNull(), "NON_NUMERIC_BBOX")
    boxes = rows.select(
        "sequence_id", "frame_id", F.col("t._id").alias("track_id"), F.col("t.attribute._vehicle_type").alias("original_class"),
        left.alias("xmin"), top.alias("ymin"), (left + w).alias("xmax"), (top + h).alias("ymax"),
        F.col("t.attribute._truncation_ratio").try_cast("double").alias("truncation_ratio"), issue.alias("issue"),
    )
    return boxes, sequences, regions


def read_yolo_labels(spark: SparkSession, path: str) -> DataFrame:
    """Lines of label files with split, image id and the parts of the line."""
    file = F.col("_metadata.file_path")
    rows = spark.read.text(path).select("value", file.alias("file"))
    part = F.split(F.trim("value"), r"\s+")
    return rows.where("trim(value) <> ''").select(
        F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("split"), F.regexp_extract("file", r"([^/]+)\.[^.]+$", 1).alias("image_id"),
        F.trim("value").alias("label_line"), F.sha2(F.concat_ws("|", "file", "value"), 256).alias("annotation_id"), F.size(part).alias("n_parts"),
    )


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images; unreadable files are marked."""
    rows = spark.read.format("image").option("dropInvalid", "false").load(path).select("image.*")
    return rows.withColumn("read_status", F.when(F.col("height") < 0, "CORRUPT_OR_UNREADABLE").otherwise("OK"))


def union_sources(*sources: DataFrame) -> DataFrame:
    """One table over sources with different columns."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out
