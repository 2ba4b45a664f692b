"""Profiles of boxes and images: counts, distributions and ratios by dataset, class, size and scene."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boxloom.operators.boxes import box_clip, box_geometry, box_validate, letterbox_metrics
from boxloom.operators.ranks import exact_quantiles


def ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b)


def numeric_summary(rows: DataFrame, column: str, *by: str) -> DataFrame:
    """Count, least, mean, median and greatest of the present numbers of each group."""
    c = F.col(column)
    sums = rows.where(c.isNotNull() & ~F.isnan(c)).groupBy(*by).agg(
        F.count(c).alias("n"), F.min(c).alias("min_value"), F.avg(c).alias("mean_value"), F.max(c).alias("max_value")
    )
    return sums.join(exact_quantiles(rows, column, {"median_value": 0.5}, *by), list(by))


def bbox_statistics(boxes: DataFrame) -> DataFrame:
    """Validate, clip and letterbox all boxes; counts, ratios and means by dataset."""
    rows = letterbox_metrics(box_geometry(box_clip(box_validate(boxes))))
    n = F.count(F.lit(1))
    return rows.groupBy("dataset").agg(
        n.alias("n_boxes"), F.count_if("is_valid").alias("n_valid"), F.count_if("clip_applied").alias("n_clipped"),
        F.count_if(~F.col("visible")).alias("n_invisible"),
        *[F.count_if(F.col("lb_category") == k).alias(f"n_{k.lower()}") for k in ("EXTREMELY_TINY", "VERY_SMALL", "SMALL", "USABLE")],
        (F.count_if(F.least("lb_w", "lb_h") < 8) / n).alias("under_8_ratio"),
        F.avg("lb_w").alias("mean_lb_w"), F.avg("lb_h").alias("mean_lb_h"),
    )


def dataset_inventory(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Images, sequences, boxes, tracks, classes, images without boxes, invalid boxes and issues by dataset.

    Boxes are reduced to one row an image before anything is joined; distinct counts use partial sums.
    """
    rows = box_validate(boxes)
    by_image = rows.groupBy("dataset", "image_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("is_valid")).alias("bad"), F.sum(F.size("issues")).alias("issues")
    )
    per_image = images.join(by_image, ["dataset", "image_id"], "left").groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_images"), F.countDistinct("sequence_id").alias("n_sequences"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_boxes"), F.count_if(F.col("n").isNull()).alias("n_images_without_boxes"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("n_invalid"), F.coalesce(F.sum("issues"), F.lit(0)).alias("n_issues"),
    )
    kinds = rows.groupBy("dataset").agg(
        F.countDistinct("sequence_id", "track_id").alias("n_tracks"), F.countDistinct("original_class").alias("n_classes")
    )
    return per_image.join(kinds, "dataset", "left")


def dataset_comparison(boxes: DataFrame) -> DataFrame:
    """Wide comparison of the datasets: which things they have, and shares of small boxes."""
    rows = letterbox_metrics(boxes)
    n = F.count(F.lit(1))
    return rows.groupBy("dataset").agg(
        n.alias("n_boxes"), F.bool_or(F.col("track_id").isNotNull()).alias("has_tracks"), F.bool_or("occluded").alias("has_occlusion"),
        *[F.bool_or(F.col("original_class") == c).alias(f"has_{c.lower()}") for c in ("AF", "NF", "NO", "RF")],
        (F.count_if(F.col("lb_category") == "EXTREMELY_TINY") / n).alias("tiny_ratio"),
        (F.count_if(F.col("lb_category").isin("EXTREMELY_TINY", "VERY_SMALL", "SMALL")) / n).alias("small_ratio"),
    )


def class_distribution(boxes: DataFrame, rules: DataFrame) -> DataFrame:
    """Boxes by dataset and class, with the rule that applies."""
    counts = boxes.groupBy("dataset", "original_class").agg(F.count(F.lit(1)).alias("n_boxes"))
    out = counts.join(rules, ["dataset", "original_class"], "left")
    return out.withColumn("mapping_status", F.when(F.col("mapped_class").isNull(), "UNMAPPED_CLASS").otherwise("CONSISTENT"))


def annotation_quality(boxes: DataFrame) -> DataFrame:
    """Distinct invalid annotations, issue count and the invalid rate by dataset."""
    rows = box_validate(boxes)
    bad = F.when(~F.col("is_valid"), F.struct("image_id", "annotation_id"))
    out = rows.groupBy("dataset").agg(
        F.count_if("is_valid").alias("n_valid"), F.countDistinct(bad).alias("n_invalid"), F.sum(F.size("issues")).alias("n_issues")
    )
    return out.withColumn("invalid_rate", ratio(F.col("n_invalid"), F.col("n_valid") + F.col("n_invalid")))


def boxes_per_image(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """How many images have how many boxes, none included."""
    n = boxes.groupBy("dataset", "image_id").agg(F.count(F.lit(1)).alias("n_boxes"))
    both = images.join(n, ["dataset", "image_id"], "left").withColumn("n_boxes", F.coalesce("n_boxes", F.lit(0)))
    return both.groupBy("dataset", "n_boxes").agg(F.count(F.lit(1)).alias("n_images"))


def occlusion_truncation(boxes: DataFrame) -> DataFrame:
    cut = F.coalesce("truncation_ratio", F.lit(0.0)) > 0
    return boxes.groupBy("dataset").agg(
        F.count_if("occluded").alias("OCCLUDED"), F.count_if(~F.col("occluded")).alias("NOT_OCCLUDED"),
        F.count_if(cut).alias("TRUNCATED"), F.count_if(~cut).alias("NOT_TRUNCATED"),
    ).unpivot("dataset", ["OCCLUDED", "NOT_OCCLUDED", "TRUNCATED", "NOT_TRUNCATED"], "state", "n_boxes")


def bbox_size_report(boxes: DataFrame, spark, edges=(0, 10, 25, 50, 100, 200, 320), threshold: int = 25) -> DataFrame:
    """Histogram of the longest letterboxed side in fixed bins, empty bins included; the last is open."""
    rows = letterbox_metrics(boxes.where("xmax > xmin AND ymax > ymin")).withColumn("side", F.greatest("lb_w", "lb_h"))
    slot = F.lit(0)
    for e in edges[1:]:
        slot = slot + (F.col("side") >= e).cast("int")
    counts = rows.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n_boxes"), F.count_if(F.col("side") < threshold).alias("n_under"))
    bins = spark.createDataFrame([(i, float(e)) for i, e in enumerate(edges)], "bin int, bin_start double")
    return bins.join(counts, "bin", "left").select("bin", "bin_start", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_boxes", "n_under")])


def clip_audit(boxes: DataFrame) -> DataFrame:
    """By dataset and side of the image: boxes over it, and exact quantiles of the overrun in pixels."""
    over = boxes.where("xmax > xmin AND ymax > ymin").select(
        "dataset", F.expr("stack(4, 'LEFT', -xmin, 'TOP', -ymin, 'RIGHT', xmax - width, 'BOTTOM', ymax - height) AS (side, overrun)")
    ).where("overrun > 0")
    counts = over.groupBy("dataset", "side").agg(F.count(F.lit(1)).alias("n_boxes"), F.count_if(F.col("overrun") < 2).alias("n_under_2"))
    return counts.join(exact_quantiles(over, "overrun", {"p05": 0.05, "p50": 0.5, "p95": 0.95}, "dataset", "side"), ["dataset", "side"])


def clip_severity(boxes: DataFrame) -> DataFrame:
    """How much of a clipped box stays: MINOR from 0.9, MODERATE from 0.5, SEVERE, FULLY_OUTSIDE."""
    rows = box_clip(boxes.where("xmax > xmin AND ymax > ymin")).where("clip_applied")
    kept = F.greatest(F.col("cx1") - F.col("cx0"), F.lit(0.0)) * F.greatest(F.col("cy1") - F.col("cy0"), F.lit(0.0))
    share = kept / ((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")))
    rows = rows.withColumn("kept_share", share)
    severity = F.when(F.col("kept_share") <= 0, "FULLY_OUTSIDE").when(F.col("kept_share") >= 0.9, "MINOR").when(F.col("kept_share") >= 0.5, "MODERATE").otherwise("SEVERE")
    return rows.groupBy("dataset", severity.alias("severity")).agg(F.count(F.lit(1)).alias("n_boxes"), F.avg("kept_share").alias("mean_kept"))


def duplicate_box_rows(boxes: DataFrame) -> DataFrame:
    """Surplus rows of equal image, class and box, by dataset."""
    same = boxes.groupBy("dataset", "image_id", "original_class", "xmin", "ymin", "xmax", "ymax").agg(F.count(F.lit(1)).alias("n"))
    return same.groupBy("dataset").agg(F.sum(F.col("n") - 1).alias("n_surplus"), F.count_if(F.col("n") > 1).alias("n_groups"))


def track_extents(boxes: DataFrame) -> DataFrame:
    """First and last frame, boxes and the extent of the centres of each track."""
    x, y = (F.col("xmin") + F.col("xmax")) / 2, (F.col("ymin") + F.col("ymax")) / 2
    return boxes.where("xmax > xmin AND ymax > ymin").groupBy("dataset", "sequence_id", "track_id").agg(
        F.min("frame_id").alias("first_frame"), F.max("frame_id").alias("last_frame"), F.count(F.lit(1)).alias("n_boxes"),
        F.min(x).alias("min_x"), F.max(x).alias("max_x"), F.min(y).alias("min_y"), F.max(y).alias("max_y"),
        F.max("width").alias("width"), F.max("height").alias("height"),
    )


def stationary_candidates(extents: DataFrame, least_boxes: int = 15, high: float = 0.005, medium: float = 0.015) -> DataFrame:
    """Tracks whose extent is a small share of the image diagonal."""
    share = F.hypot(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y")) / F.hypot(F.col("width").cast("double"), F.col("height").cast("double"))
    out = extents.where((F.col("n_boxes") >= least_boxes) & (F.col("width") > 0) & (F.col("height") > 0)).withColumn("extent_share", share)
    level = F.when(F.col("extent_share") < high, "HIGH").when(F.col("extent_share") < medium, "MEDIUM")
    return out.withColumn("confidence", level).where("confidence IS NOT NULL")


def track_consistency(boxes: DataFrame) -> DataFrame:
    """Tracks that occur twice in a frame or change their class."""
    twice = boxes.groupBy("dataset", "sequence_id", "track_id", "frame_id").agg(F.count(F.lit(1)).alias("n"), F.min("original_class").alias("lo"), F.max("original_class").alias("hi"))
    out = twice.groupBy("dataset", "sequence_id", "track_id").agg(
        F.count_if(F.col("n") > 1).alias("n_repeated_frames"), (F.min("lo") != F.max("hi")).alias("class_changes")
    )
    return out.where("n_repeated_frames > 0 OR class_changes")


def conservation_check(boxes: DataFrame) -> DataFrame:
    """raw = included + excluded + invalid, as one row; ``action`` and ``is_valid`` are on the rows."""
    keep = (F.col("action") == "KEEP")
    out = boxes.agg(
        F.count(F.lit(1)).alias("n_raw"), F.count_if(keep & F.col("is_valid")).alias("n_included"),
        F.count_if(~keep).alias("n_excluded"), F.count_if(keep & ~F.col("is_valid")).alias("n_invalid"),
    )
    return out.withColumn("conserved", F.expr("n_raw = n_included + n_excluded + n_invalid"))


def condition_distribution(sequences: DataFrame, dimensions=("road_type", "lighting", "weather", "camera_view")) -> DataFrame:
    return sequences.unpivot(["dataset", "sequence_id"], list(dimensions), "dimension", "value").groupBy("dimension", "value").agg(
        F.count(F.lit(1)).alias("n_sequences")
    )


def traffic_density(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Mean boxes an image of each sequence, as LOW (to 4), MEDIUM (to 10) or HIGH."""
    n = boxes.groupBy("dataset", "sequence_id").agg(F.count(F.lit(1)).alias("n_boxes"))
    m = images.groupBy("dataset", "sequence_id").agg(F.count(F.lit(1)).alias("n_images"))
    out = m.join(n, ["dataset", "sequence_id"], "left").withColumn("n_boxes", F.coalesce("n_boxes", F.lit(0)))
    out = out.withColumn("mean_boxes", F.col("n_boxes") / F.col("n_images"))
    return out.withColumn("density", density_bucket(F.col("mean_boxes")))


def density_bucket(mean: Column) -> Column:
    return F.when(mean <= 4, "LOW").when(mean <= 10, "MEDIUM").otherwise("HIGH")


def box_by_split_source_class(boxes: DataFrame) -> DataFrame:
    """Counts by split, dataset and class with totals of the levels above."""
    return boxes.rollup("split", "dataset", "original_class").agg(F.count(F.lit(1)).alias("n_boxes"), F.grouping_id().cast("int").alias("level"))
