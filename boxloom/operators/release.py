"""Build of a one-class release and its recount: rejects with reasons, negatives, reconciliation, contract."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom.operators.boxes import box_clip, box_issues, yolo_normalize
from boxloom.operators.classes import apply_class_rules


def export_boxes(boxes: DataFrame, rules: DataFrame, exclusions: DataFrame, n_tasks: int | None = None) -> DataFrame:
    """Every raw box with ``outcome`` EXPORTED, IGNORED or REJECTED and the first ``reason`` that applies.

    The order of the reasons is class, track, number, size, clipping, duplicate. Duplicates are equal
    label lines of one image; the first annotation id stays. ``n_tasks`` is that of ``chunk_errors``: the join with the
    exclusions deals boxes by track, and the session's number need not fit the images that come after it.
    """
    excluded = exclusions.select("sequence_id", "track_id").distinct().withColumn("excluded", F.lit(True))
    rows = apply_class_rules(boxes, rules).join(excluded, ["sequence_id", "track_id"], "left")
    rows = box_clip(_dealt(rows, n_tasks)).withColumn("issues", box_issues())
    reason = (
        F.when(F.col("action") == "IGNORE_REGION", "IGNORE_REGION")
        .when(F.col("mapped_class").isNull(), "UNMAPPED_CLASS").when(F.col("action") == "REJECT", "CLASS_EXCLUDED")
        .when(F.col("excluded"), "TRACK_EXCLUDED").when(F.array_contains("issues", "NAN_OR_INFINITY"), "NAN_OR_INFINITY")
        .when(F.array_contains("issues", "NON_POSITIVE_SIZE"), "NON_POSITIVE_SIZE").when(~F.col("visible"), "NOT_VISIBLE_AFTER_CLIP")
    )
    rows = rows.withColumn("reason", reason)
    clipped = ("cx0", "cy0", "cx1", "cy1")
    rows = rows.withColumns({f"_{c}": F.when(F.col("reason").isNull(), F.col(c)) for c in clipped})  # the others have no line
    rows = yolo_normalize(rows, tuple(f"_{c}" for c in clipped)).withColumn("label_line", F.when(F.col("reason").isNull(), F.col("label_line")))
    w = Window.partitionBy("image_id", "label_line").orderBy("annotation_id")
    again = F.col("reason").isNull() & (F.row_number().over(w) > 1)
    out = rows.withColumn("reason", F.when(again, "DUPLICATE_BOX").otherwise(F.col("reason"))).drop("nx", "ny", "nw", "nh", *[f"_{c}" for c in clipped])
    outcome = F.when(F.col("reason").isNull(), "EXPORTED").when(F.col("reason") == "IGNORE_REGION", "IGNORED").otherwise("REJECTED")
    return out.withColumn("outcome", outcome).drop("issues", "excluded", "action", "include", "handling", "mapping_status")


def export_summary(exported: DataFrame) -> DataFrame:
    return exported.groupBy("dataset", "outcome", "reason").agg(F.count(F.lit(1)).alias("n_boxes"))


def reconcile(exported: DataFrame) -> DataFrame:
    """input = exported + rejected + ignored, by dataset."""
    out = exported.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_input"), *[F.count_if(F.col("outcome") == k).alias(f"n_{k.lower()}") for k in ("EXPORTED", "REJECTED", "IGNORED")]
    )
    return out.withColumn("reconciled", F.expr("n_input = n_exported + n_rejected + n_ignored"))


def label_files(images: DataFrame, exported: DataFrame) -> DataFrame:
    """One label text for each image, its lines in order; empty for images without a box (negatives)."""
    lines = exported.where("outcome = 'EXPORTED'").groupBy("image_id").agg(
        F.count(F.lit(1)).alias("n_lines"), F.array_join(F.array_sort(F.collect_list("label_line")), "\n").alias("label_text")
    )
    out = images.select("dataset", "image_id").join(lines, "image_id", "left")
    return out.select("dataset", "image_id", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("label_text", F.lit("")).alias("label_text"))


def box_count_mismatch(actual: DataFrame, manifest: DataFrame) -> DataFrame:
    """Images whose recounted boxes differ from the manifest's ``n_lines``, on either side."""
    a = actual.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_actual"))
    m = manifest.where("n_lines > 0").select("image_id", F.col("n_lines").alias("n_manifest"))
    out = m.join(a, "image_id", "full_outer").select("image_id", F.coalesce("n_actual", F.lit(0)).alias("n_actual"), F.coalesce("n_manifest", F.lit(0)).alias("n_manifest"))
    return out.where("n_actual <> n_manifest")


def label_line_errors(lines: DataFrame) -> DataFrame:
    """Error class of each label line: FIELD_COUNT, CLASS_ID, NOT_A_NUMBER, OUT_OF_RANGE or DUPLICATE_LINE; null if none."""
    part = F.split("label_line", " ")
    numbers = F.transform(F.slice(part, 2, 4), lambda x: x.try_cast("double"))
    rows = lines.withColumn("_p", part).withColumn("_n", numbers)
    w = Window.partitionBy("image_id", "label_line").orderBy("annotation_id")
    error = (
        F.when(F.size("_p") != 5, "FIELD_COUNT").when(F.col("_p")[0] != "0", "CLASS_ID")
        .when(F.exists("_n", lambda x: x.isNull() | F.isnan(x)), "NOT_A_NUMBER")
        .when(F.exists("_n", lambda x: (x < 0) | (x > 1)) | (F.col("_n")[2] <= 0) | (F.col("_n")[3] <= 0), "OUT_OF_RANGE")
        .when(F.row_number().over(w) > 1, "DUPLICATE_LINE")
    )
    return rows.withColumn("error", error).drop("_p", "_n")


def release_contract(counts: DataFrame, expected: DataFrame, on: list[str]) -> DataFrame:
    """Exact counts against expected ones: PASS or FAIL for each key of either side."""
    a, e = counts.withColumnRenamed("n", "n_actual"), expected.withColumnRenamed("n", "n_expected")
    out = e.join(a, on, "full_outer").withColumn("n_actual", F.coalesce("n_actual", F.lit(0))).withColumn("n_expected", F.coalesce("n_expected", F.lit(0)))
    return out.withColumn("status", F.when(F.col("n_actual") == F.col("n_expected"), "PASS").otherwise("FAIL"))


def release_qc(images: DataFrame, exported: DataFrame, manifest: DataFrame) -> DataFrame:
    """Recount of a release as one report: each check with its number of errors and a status."""
    lines = exported.where("outcome = 'EXPORTED'")
    listed = manifest.select("image_id").distinct()
    parts = {
        "box_count_mismatch": box_count_mismatch(lines, manifest),
        "label_line_error": label_line_errors(lines).where("error IS NOT NULL"),
        "image_not_in_manifest": images.join(listed, "image_id", "left_anti"),
        "manifest_without_image": listed.join(images, "image_id", "left_anti"),
        "negative_with_box": manifest.where("n_lines = 0").join(lines.select("image_id").distinct(), "image_id", "left_semi"),
    }
    out = None
    for name, errors in parts.items():
        one = errors.agg(F.count(F.lit(1)).alias("n_errors")).select(F.lit(name).alias("check_name"), "n_errors")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("status", F.when(F.col("n_errors") == 0, "PASS").otherwise("FAIL"))


def _dealt(rows: DataFrame, n_tasks: int | None) -> DataFrame:
    return rows.repartition(n_tasks, "image_id") if n_tasks else rows


def chunk_errors(reports: DataFrame, images: DataFrame, labels: DataFrame, n_tasks: int | None = None) -> DataFrame:
    """``image_id`` and ``error`` of chunk reports against the batch's images and its label texts (``n_lines``).

    DUPLICATE_REPORT: an image in two rows; MISSING_REPORT and EXTRA_REPORT: reports and images differ;
    MISSING_LABEL: an image without a label text; COUNT_MISMATCH: a label text of other than ``n_boxes`` lines.
    With ``n_tasks`` rows are dealt to as many tasks, for batches that the session's number does not fit.
    """
    reports, images, labels = (_dealt(rows, n_tasks) for rows in (reports, images, labels))
    r = reports.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_reports"), F.min("n_boxes").alias("n_boxes"))
    i = images.select("image_id").distinct().withColumn("is_image", F.lit(True))
    rows = r.join(i, "image_id", "full_outer").join(labels.select("image_id", "n_lines"), "image_id", "left")
    known = F.col("is_image").isNotNull()
    errors = F.array_compact(F.array(
        F.when(F.col("n_reports") > 1, "DUPLICATE_REPORT"), F.when(F.col("n_reports").isNull(), "MISSING_REPORT"), F.when(~known, "EXTRA_REPORT"),
        F.when(known & F.col("n_lines").isNull(), "MISSING_LABEL"), F.when(known & (F.col("n_lines") != F.col("n_boxes")), "COUNT_MISMATCH"),
    ))
    return rows.select("image_id", F.explode(errors).alias("error"))


def merge_chunk_reports(chunks: list[DataFrame], images: DataFrame, labels: DataFrame, tasks: DataFrame, n_tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The merged report of a batch in chunks, and its task list brought up to date; any of ``chunk_errors`` refuses both.

    A chunk has image_id, n_boxes and annotation_status. A task keeps its row and its version unless the
    report says something new of its image: then it takes status and count, and its ``version`` goes up.
    Running the same merge again changes nothing. ``n_tasks`` is that of ``chunk_errors``.
    """
    reports = chunks[0]
    for c in chunks[1:]:
        reports = reports.unionByName(c, allowMissingColumns=True)
    wrong = chunk_errors(reports, images, labels, n_tasks).groupBy("error").count().orderBy("error").collect()  # five kinds at most
    if wrong:
        raise ValueError("chunk reports are refused: " + ", ".join(f"{r['count']} {r['error']}" for r in wrong))
    news = reports.select("image_id", F.col("annotation_status").alias("_status"), F.col("n_boxes").cast("bigint").alias("_n"))
    rows = _dealt(tasks, n_tasks).join(_dealt(news, n_tasks), "image_id", "left")
    changed = F.col("_n").isNotNull() & ~(F.col("auto_annotation_status").eqNullSafe(F.col("_status")) & F.col("auto_box_count").eqNullSafe(F.col("_n")))
    updated = rows.withColumns({
        "version": F.when(changed, F.col("version") + 1).otherwise(F.col("version")),
        "auto_annotation_status": F.when(changed, F.col("_status")).otherwise(F.col("auto_annotation_status")),
        "auto_box_count": F.when(changed, F.col("_n")).otherwise(F.col("auto_box_count")),
    })
    return reports, updated.select(*tasks.columns)


def batch_summary(reports: DataFrame) -> DataFrame:
    """One row: images, boxes and images without a detection of a merged report."""
    return reports.agg(
        F.count(F.lit(1)).alias("n_images"), F.coalesce(F.sum("n_boxes"), F.lit(0)).alias("n_boxes"), F.count_if(F.col("n_boxes") == 0).alias("n_images_without_detections"), F.lit("PASS").alias("validation")
    )


def release_summary(rows: DataFrame, *dimensions: str) -> DataFrame:
    """One row for ``write_summary_json``: images and boxes in all, and nested by each value of each dimension.

    ``rows`` has an image a row with ``n_boxes``; dimensions are of closed vocabularies, such as split and dataset.
    """
    total = rows.agg(F.count(F.lit(1)).alias("n_images"), F.coalesce(F.sum("n_boxes"), F.lit(0)).alias("n_boxes"))
    for d in dimensions:
        counts = rows.groupBy(d).agg(F.count(F.lit(1)).alias("n_images"), F.sum("n_boxes").alias("n_boxes"))
        entry = F.struct(F.coalesce(F.col(d).cast("string"), F.lit("UNKNOWN")).alias("key"), F.struct("n_images", "n_boxes").alias("value"))
        nested = counts.agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(f"by_{d}"))
        total = total.withColumn("_one", F.lit(1)).join(nested.withColumn("_one", F.lit(1)), "_one").drop("_one")
    return total


def write_release(labels: DataFrame, path: str, qc: DataFrame) -> None:
    """Write label texts by dataset beside ``path``, count them there, then publish them under it in one rename.

    A QC report with a failure refuses the release, as do a folder that exists and a count that differs.
    """
    if qc.where("status <> 'PASS'").limit(1).count():
        raise ValueError("the release did not pass its checks")
    spark = labels.sparkSession
    jvm, staging = spark._jvm, f"{path.rstrip('/')}.staging-{uuid.uuid4().hex}"
    target, source = (jvm.org.apache.hadoop.fs.Path(p) for p in (path, staging))
    store = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if store.exists(target):
        raise ValueError(f"{path} exists")
    try:
        labels.write.mode("errorifexists").partitionBy("dataset").parquet(staging)
        if spark.read.schema(labels.schema).parquet(staging).count() != labels.count():
            raise ValueError("the staged release differs from its labels")
        if not store.rename(source, target):
            raise ValueError(f"{path} cannot be published")
    finally:
        store.delete(source, True)
