"""The quality audit of annotated datasets: findings and gate, class mappings, and the queue of what people have to look at."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom.operators.boxes import box_clip, box_validate

# Categories of the review queue in their order, with the count they come from, severity, scope and action.
REVIEWS = (
    ("CORRUPT_OR_UNREADABLE", "n_unreadable", "CRITICAL", "IMAGE_SAMPLE", "QUARANTINE_AND_RECHECK_SOURCE"),
    ("INVALID_ANNOTATION", "n_invalid", "HIGH", "ANNOTATION_SCAN", "REVIEW_MALFORMED_BOX_AND_EXCLUDE_ONLY_IF_NO_VISIBLE_AREA_AFTER_CLIP"),
    ("BOUNDARY_BBOX_CLIPPED", "n_clipped", "INFO", "ANNOTATION_SCAN", "KEEP_OBJECT_AND_USE_CLIPPED_COORDINATES"),
    ("EXACT_DUPLICATE", "n_exact_groups", "HIGH", "IMAGE_SAMPLE", "KEEP_ONE_PER_CONFIRMED_DUPLICATE_GROUP"),
    ("NEAR_DUPLICATE", "n_near_groups", "MEDIUM", "IMAGE_SAMPLE", "TEMPORAL_DOWNSAMPLE_AFTER_REVIEW"),
    ("BLUR_SUSPECT", "n_blurred", "MEDIUM", "IMAGE_SAMPLE", "VISUAL_REVIEW_THEN_REJECT_OR_KEEP"),
    ("UNDEREXPOSED_SUSPECT", "n_underexposed", "MEDIUM", "IMAGE_SAMPLE", "VISUAL_REVIEW_BY_LIGHTING_SLICE"),
    ("OVEREXPOSED_SUSPECT", "n_overexposed", "MEDIUM", "IMAGE_SAMPLE", "VISUAL_REVIEW_BY_LIGHTING_SLICE"),
    ("CLASS_MAPPING_CORRECTED", "n_corrected", "HIGH", "BBOX_SAMPLE", "USE_CONFIG_MAPPING_AND_INVALIDATE_OLD_MANIFEST"),
    ("CLASS_POLICY_PENDING", "n_pending_classes", "HIGH", "CLASS_TAXONOMY", "DATA_LEAD_APPROVE_INCLUDE_AND_MAPPING"),
)
#: Any of these asks for a review.
FINDINGS = ("n_underexposed", "n_overexposed", "n_blurred", "n_invalid", "n_exact_groups", "n_near_groups", "n_corrected", "n_unmapped")


def quality_gate(boxes: DataFrame, measures: DataFrame, duplicates: DataFrame) -> DataFrame:
    """Findings by dataset and the gate: BLOCKED with an unreadable image, REVIEW_REQUIRED with any of ``FINDINGS``, else PASS.

    ``boxes`` come with ``mapping_status`` (``apply_class_rules``), ``measures`` with ``read_status`` and the flags
    of ``image_suspects``, an image a row; ``duplicates`` with a group a row and its ``kind``: EXACT, NEAR or
    BASENAME. Equal names are a hint only and ask for nothing.
    """
    rows = box_clip(box_validate(boxes))
    found = rows.groupBy("dataset").agg(
        F.countDistinct(F.when(~F.col("is_valid"), F.struct("image_id", "annotation_id"))).alias("n_invalid"), F.sum(F.size("issues")).alias("n_issues"),
        F.count_if("clip_applied").alias("n_clipped"), F.count_if(F.col("mapping_status") == "CORRECTED_TO_CONFIG").alias("n_corrected"),
        F.count_if(F.col("mapping_status") == "UNMAPPED_CLASS").alias("n_unmapped"),
    )
    ok = F.col("read_status") == "OK"
    flags = (("underexposed", "underexposed_suspect"), ("overexposed", "overexposed_suspect"), ("blurred", "blur_suspect"))
    images = measures.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_checked"), F.count_if(~ok).alias("n_unreadable"), *[F.count_if(ok & F.col(c)).alias(f"n_{k}") for k, c in flags]
    )
    groups = duplicates.groupBy("dataset").agg(*[F.count_if(F.col("kind") == k.upper()).alias(f"n_{k}_groups") for k in ("exact", "near", "basename")])
    out = found.join(images, "dataset", "full_outer").join(groups, "dataset", "full_outer")
    out = out.na.fill(0, [c for c in out.columns if c != "dataset"])
    any_finding = sum((F.col(c) for c in FINDINGS), F.lit(0)) > 0
    return out.withColumn("gate", F.when(F.col("n_unreadable") > 0, "BLOCKED").when(any_finding, "REVIEW_REQUIRED").otherwise("PASS"))


def label_consistency(boxes: DataFrame, rules: DataFrame) -> DataFrame:
    """Of each dataset and class: its boxes, what the rules say, what the sources said, and how far the mapping is approved.

    ``boxes`` come with ``mapping_status`` and ``source_mapped_class``; ``rules`` with ``include``,
    ``review_required`` and ``has_track_exclusions``.
    """
    source = F.when(F.coalesce("source_mapped_class", F.lit("")) == "", "EMPTY").otherwise(F.col("source_mapped_class"))
    rows = boxes.groupBy("dataset", "original_class").agg(
        F.count(F.lit(1)).alias("n_boxes"), F.array_join(F.sort_array(F.collect_set(source)), "|").alias("source_mapped_values"),
        F.count_if(F.col("mapping_status") == "CORRECTED_TO_CONFIG").alias("n_corrected"),
    )
    r = rules.select("dataset", "original_class", "mapped_class", "include", "review_required", "has_track_exclusions", F.lit(True).alias("_rule"))
    out = rows.join(r, ["dataset", "original_class"], "left")
    known, review = F.col("_rule").isNotNull(), F.coalesce("review_required", F.lit(True))
    exempt = F.col("include") & F.col("has_track_exclusions")
    include = F.when(~known, "").when(exempt, "TRUE_WITH_TRACK_EXCLUSION").when(F.col("include"), "TRUE").otherwise("FALSE")
    status = (
        F.when(~known, "UNMAPPED_CLASS_REVIEW_REQUIRED").when(review, "DEFINED_PENDING_DATA_LEAD_APPROVAL")
        .when(F.col("has_track_exclusions"), "DATA_LEAD_APPROVED_WITH_TRACK_EXCLUSION").otherwise("APPROVED")
    )
    return out.select(
        "dataset", "original_class", "n_boxes", F.coalesce("mapped_class", F.lit("")).alias("mapped_class"), include.alias("configured_include"),
        "source_mapped_values", "n_corrected", status.alias("mapping_status"), review.alias("manual_review_required"),
    )


def _each(values: Column, name: str) -> Column:
    return F.explode(values).alias(name)


def quality_review_queue(gate: DataFrame, labels: DataFrame) -> DataFrame:
    """What has to be reviewed, from ``quality_gate`` and ``label_consistency``: a row for each count over 0, numbered.

    Numbers go by dataset and, within one, in the order of ``REVIEWS``.
    """
    pending = labels.where("manual_review_required").groupBy("dataset").agg(F.count(F.lit(1)).alias("n_pending_classes"))
    rows = gate.join(pending, "dataset", "left").na.fill(0, ["n_pending_classes"])
    each = F.array(*[
        F.struct(
            F.lit(k).alias("place"), F.lit(category).alias("issue_category"), F.col(count).cast("bigint").alias("issue_count"),
            F.lit(severity).alias("severity"), F.lit(scope).alias("scope"), F.lit(action).alias("recommended_action"),
        )
        for k, (category, count, severity, scope, action) in enumerate(REVIEWS)
    ])
    rows = rows.select("dataset", _each(each, "x")).select("dataset", "x.*").where("issue_count > 0")
    n = F.row_number().over(Window.orderBy("dataset", "place"))  # ten rows a dataset at most
    return rows.withColumn("queue_id", F.format_string("QREV_%04d", n)).withColumn("manual_review_status", F.lit("PENDING")).drop("place")
