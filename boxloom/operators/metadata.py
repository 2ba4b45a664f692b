"""Checks and plans over metadata tables: sources, videos, sessions, reviews, manifests, vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom.operators.ranks import exact_quantiles

# Closed vocabularies of the metadata tables.
PERMITTED = ("APPROVED", "NOT_REQUIRED")
STATUSES = ("NOT_STARTED", "IN_PROGRESS", "BLOCKED", "REVIEW", "DONE", "CANCELLED")
RAINY = ("RAIN", "RAIN_OR_WET_ROAD", "RAIN_OR_SNOW")
REVIEWED = ("APPROVED", "REVIEWED")
SLICES = ("DAY", "NIGHT", "RAIN", "BACKLIT")


def reasons(**conditions: Column) -> Column:
    """The names of the conditions that hold, in order."""
    return F.array_compact(F.array(*[F.when(c, name) for name, c in conditions.items()]))


def source_license_issues(sources: DataFrame) -> DataFrame:
    """Why a source may not be downloaded; ``result`` is PASS or BLOCKED."""
    text = {c: F.coalesce(c, F.lit("")) for c in ("license_name", "permission_status", "redistribution_allowed", "review_status")}
    issues = reasons(
        LICENSE_NOT_VERIFIED=~F.coalesce("license_verified", F.lit(False)), LICENSE_NAME_UNKNOWN=text["license_name"].isin("", "UNVERIFIED"),
        PERMISSION_MISSING=~text["permission_status"].isin(*PERMITTED), REDISTRIBUTION_UNKNOWN=text["redistribution_allowed"].isin("", "UNVERIFIED"),
        NOT_APPROVED_FOR_DOWNLOAD=text["review_status"] != "APPROVED_FOR_DOWNLOAD",
    )
    out = sources.withColumn("issues", issues)
    return out.withColumn("result", F.when(F.size("issues") == 0, "PASS").otherwise("BLOCKED"))


def video_conditions(videos: DataFrame) -> DataFrame:
    """Conditions of a reviewed video, as a list; backlight without its own review raises."""
    light, weather = F.upper(F.coalesce("lighting", F.lit(""))), F.upper(F.coalesce("weather", F.lit("")))
    approved = F.upper(F.coalesce("backlit_review_status", F.lit(""))).isin(*REVIEWED)
    backlit = F.when(light != "BACKLIT", F.lit(None).cast("string")).when(approved, "BACKLIT").otherwise(F.raise_error(F.lit("BACKLIT needs a review")))
    found = F.array(F.when(light == "DAY", "DAY"), F.when(light == "NIGHT", "NIGHT"), F.when(weather.isin(*RAINY), "RAIN"), backlit)
    return videos.withColumn("conditions", F.array_compact(found))


def frame_sample_plan(videos: DataFrame, fps: float) -> DataFrame:
    """Frames to take of each video and condition: every ``round(source_fps / fps)``-th, with its time."""
    step = F.greatest(F.lit(1), F.round(F.col("source_fps") / fps)).cast("bigint")
    rows = videos.where("n_frames > 0").withColumn("frame_index", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_frames") - 1, step)))
    rows = rows.withColumn("condition", F.explode("conditions"))
    time = F.round(F.col("frame_index") * 1000 / F.col("source_fps")).cast("bigint")
    return rows.select("video_id", "condition", "frame_index", time.alias("timestamp_ms"))


def review_decision(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """The training decision that follows from a visual assessment and its sign-off."""
    out = queue.join(decisions, "sample_id", "left").withColumn("visual_assessment", F.coalesce("visual_assessment", F.lit("PENDING_REVIEW")))
    a, vehicle = F.col("visual_assessment"), F.col("visual_assessment").isin("CONFIRMED_MOTORIZED_VEHICLE", "LIKELY_MOTORIZED_VEHICLE")
    signed = F.col("review_status") == "DATA_LEAD_SIGNOFF_COMPLETED"
    return out.withColumn(
        "training_decision",
        F.when(a == "NON_VEHICLE", "FALSE_REVIEW_REJECT").when(a == "UNDETERMINED", "FALSE_PENDING_SECOND_REVIEW")
        .when(vehicle & signed, "TRUE_DATA_LEAD_APPROVED").when(vehicle, "TRUE_WITH_CAUTION").otherwise("PENDING_REVIEW"),
    )


def allowed_values_check(rows: DataFrame, vocabulary: DataFrame, key: list[str], dimensions: list[str]) -> DataFrame:
    """Values that are not in the ``(dimension, value)`` vocabulary."""
    long = rows.unpivot(key, dimensions, "dimension", "value")
    return long.join(vocabulary, ["dimension", "value"], "left_anti")


def session_qualify(sessions: DataFrame, pairs: DataFrame, source: str, split: str, slices: tuple[str, ...] = SLICES) -> DataFrame:
    """Evaluation sessions with the reasons against them; ``pairs`` counts complete image and label pairs.

    Of sessions listed twice for a slice the first by ``ordinal`` counts.
    """
    rows = sessions.join(pairs, "session_id", "left").withColumn("n_pairs", F.coalesce("n_pairs", F.lit(0).cast("bigint")))
    again = F.row_number().over(Window.partitionBy("session_id", "slice").orderBy("ordinal")) > 1
    rows = rows.withColumn("_again", again)
    out = rows.withColumn("reason", reasons(
        MISSING_SESSION_ID=F.coalesce("session_id", F.lit("")) == "", INVALID_SLICE=~F.coalesce("slice", F.lit("")).isin(*slices), DUPLICATE_SESSION_SLICE=F.col("_again"),
        WRONG_SOURCE=~F.col("source").eqNullSafe(source), WRONG_SPLIT=~F.col("split").eqNullSafe(split), SESSION_NOT_LOCKED=~F.coalesce("locked", F.lit(False)),
        GROUND_TRUTH_NOT_APPROVED=~F.col("ground_truth_status").eqNullSafe("APPROVED"), NO_COMPLETE_PAIRS=F.col("n_pairs") == 0,
    )).drop("_again")
    return out.withColumn("qualified", F.size("reason") == 0)


def slice_readiness(qualified: DataFrame, slices: tuple[str, ...] = SLICES) -> DataFrame:
    """What each required slice is ready for, from its qualified sessions and their predictions."""
    required = qualified.sparkSession.createDataFrame([(s,) for s in slices], "slice string")
    n = qualified.where("qualified").groupBy("slice").agg(F.count(F.lit(1)).alias("n_sessions"), F.count_if("predictions_ready").alias("n_predicted"))
    out = required.join(n, "slice", "left").na.fill(0, ["n_sessions", "n_predicted"])
    status = (
        F.when((F.col("n_sessions") == 0) & (F.col("slice") == "BACKLIT"), "BLOCKED_MISSING_DATA").when(F.col("n_sessions") == 0, "PENDING_COLLECTION")
        .when(F.col("n_predicted") < F.col("n_sessions"), "READY_FOR_INFERENCE").otherwise("READY_FOR_MAP_CALCULATION")
    )
    return out.withColumn("status", status)


def slice_images(images: DataFrame, labels: DataFrame, dataset: str, split: str) -> DataFrame:
    """Images of one dataset and split; one without a label raises."""
    rows = images.where((F.col("dataset") == dataset) & (F.col("split") == split))
    has = labels.select("image_id").distinct().withColumn("_has", F.lit(True))
    missing = F.raise_error(F.concat(F.lit("no label for image "), F.col("image_id").cast("string"))).cast("boolean")
    return rows.join(has, "image_id", "left").where(F.coalesce("_has", missing)).drop("_has")


def checksum_manifest_validate(manifest: DataFrame) -> DataFrame:
    """Issues of manifest rows: UNSAFE_PATH, DUPLICATE_PATH, INVALID_SIZE, INVALID_SHA256."""
    path = F.coalesce("relative_path", F.lit(""))
    n = manifest.groupBy("relative_path").agg(F.count(F.lit(1)).alias("_n"))
    rows = manifest.join(n, "relative_path", "left")
    return rows.withColumn("issues", reasons(
        UNSAFE_PATH=(path == "") | path.contains("\\") | path.startswith("/") | path.rlike(r"(^|/)\.\.(/|$)") | path.rlike("^[A-Za-z]:"),
        DUPLICATE_PATH=F.coalesce("_n", F.lit(1)) > 1, INVALID_SIZE=~F.coalesce("size_bytes", F.lit("")).rlike("^[0-9]+$"),
        INVALID_SHA256=~F.lower(F.coalesce("sha256", F.lit(""))).rlike("^[0-9a-f]{64}$"),
    )).drop("_n")


def metadata_check(rows: DataFrame, key: str, status: str | None = None, allowed: tuple[str, ...] = STATUSES) -> DataFrame:
    """Rows with an empty or repeated key, or a status outside of the vocabulary."""
    n = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    empty = F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) == ""
    conditions = {"EMPTY_ID": empty, "DUPLICATE_ID": ~empty & (F.coalesce("_n", F.lit(1)) > 1)}
    if status:
        own = F.coalesce(F.trim(status), F.lit(""))
        conditions["INVALID_STATUS"] = (own != "") & ~own.isin(*allowed)
    return rows.join(n, key, "left").withColumn("issues", reasons(**conditions)).drop("_n").where(F.size("issues") > 0)


def viewpoint_score(sequences: DataFrame) -> DataFrame:
    """Rule score of a camera view: stable and dark or wet scenes score higher; level by fixed bounds."""
    base = F.when(F.col("camera_view") == "HIGH", 4.4).otherwise(3.9)
    bonus = F.when(F.col("lighting").isin("NIGHT", "TWILIGHT"), 0.2).otherwise(0.0) + F.when(F.col("weather").contains("RAIN"), 0.2).otherwise(0.0)
    out = sequences.withColumn("overall_score", F.round(F.least(base + bonus, F.lit(5.0)), 2))
    s = F.col("overall_score")
    level = F.when(s >= 4.3, "HIGHLY_RELEVANT").when(s >= 3.5, "RELEVANT").when(s >= 2.5, "PARTIALLY_RELEVANT").when(s >= 1.5, "LOW_RELEVANCE").otherwise("EXCLUDED")
    return out.withColumn("relevance_level", level)


def regions_conflict(regions: DataFrame) -> DataFrame:
    """Sequences whose ignored regions differ between the readings (``reading``) of them."""
    per = regions.groupBy("sequence_id", "reading").agg(F.sort_array(F.collect_set(F.struct("left", "top", "right", "bottom"))).alias("r"))
    out = per.groupBy("sequence_id").agg(F.countDistinct(F.xxhash64("r")).alias("n_versions"))
    return out.where("n_versions > 1")


def missing_fixed_members(policy: DataFrame, assigned: DataFrame) -> DataFrame:
    """Fixed cross-test members that are not in the cross-test split."""
    actual = assigned.where("split = 'cross_test'").select("dataset", "sequence_id")
    return policy.select("dataset", "sequence_id").exceptAll(actual)


def distinct_splits(rows: DataFrame) -> DataFrame:
    """The last split by ``ordinal`` of each (dataset, sequence)."""
    return rows.groupBy("dataset", "sequence_id").agg(F.max_by("split", "ordinal").alias("split"))


def manifest_reconcile(actual: DataFrame, manifest: DataFrame) -> DataFrame:
    """EXTRA_IMAGE for images that no manifest lists, FILTERED_BUT_STILL_COUNTED for listed ones that are gone."""
    a, m = actual.select("image_id", F.lit(1).alias("_a")), manifest.select("image_id", F.lit(1).alias("_m"))
    issue = F.when(F.col("_m").isNull(), "EXTRA_IMAGE").when(F.col("_a").isNull(), "FILTERED_BUT_STILL_COUNTED")
    return a.join(m, "image_id", "full_outer").withColumn("issue", issue).where("issue IS NOT NULL").drop("_a", "_m")


def negative_reconcile(files: DataFrame, negatives: DataFrame) -> DataFrame:
    """Images with an empty label that the negative manifest lacks, and the other way round."""
    e = files.where("n_lines = 0").select("image_id", F.lit(1).alias("_e"))
    n = negatives.select("image_id", F.lit(1).alias("_n"))
    issue = F.when(F.col("_n").isNull(), "EMPTY_LABEL_NOT_LISTED").when(F.col("_e").isNull(), "LISTED_BUT_HAS_BOXES")
    return e.join(n, "image_id", "full_outer").withColumn("issue", issue).where("issue IS NOT NULL").drop("_e", "_n")


def metric_by_dataset(ap: DataFrame, recall: DataFrame, images: DataFrame, expected: DataFrame, floors: tuple[float, ...]) -> DataFrame:
    """mAP and recall of each expected dataset at each confidence floor, never pooled.

    ``ap`` and ``recall`` come from ``average_precision`` and ``recall_by`` with these floors. A dataset
    without images is NOT_MEASURED_NO_DATA, one without labels has neither number.
    """
    grid = expected.select("dataset").distinct().select("dataset", F.explode(F.array(*[F.lit(float(x)) for x in floors])).alias("confidence"))
    on = ["dataset", "confidence"]
    m = ap.groupBy(*on).agg(F.avg("ap").alias("map"), F.max("n_labels").alias("n_labels"))
    n = images.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_images"))
    out = grid.join(n, "dataset", "left").join(m, on, "left").join(recall.select(*on, "recall"), on, "left")
    status = F.when(F.col("n_images").isNull(), "NOT_MEASURED_NO_DATA").otherwise("MEASURED")
    return out.select(*on, F.coalesce("n_images", F.lit(0)).alias("n_images"), F.coalesce("n_labels", F.lit(0)).alias("n_labels"), "map", "recall", status.alias("status"))


def image_suspects(measures: DataFrame) -> DataFrame:
    """Measured images with flags for black, white, underexposed, overexposed and blurred ones; null where unreadable.

    The bounds are fixed values: mean brightness under 5, over 250, under 45, over 220; sharpness under 60.
    """
    b = F.col("brightness")
    return measures.withColumns({
        "black_suspect": b < 5, "white_suspect": b > 250, "underexposed_suspect": b < 45, "overexposed_suspect": b > 220, "blur_suspect": F.col("sharpness") < 60,
    })


def image_quality_summary(measures: DataFrame) -> DataFrame:
    """Means, medians and suspects of measured images by dataset."""
    ok = F.col("read_status") == "OK"
    kinds = ("black", "white", "underexposed", "overexposed", "blur")
    sums = image_suspects(measures).groupBy("dataset").agg(
        F.count_if(ok).alias("n_checked"), F.count_if(~ok).alias("n_failed"), F.avg("brightness").alias("brightness_mean"),
        F.avg("contrast").alias("contrast_mean"), F.avg("sharpness").alias("sharpness_mean"), *[F.count_if(f"{k}_suspect").alias(f"n_{k}") for k in kinds],
    )
    middle = exact_quantiles(measures, "brightness", {"brightness_median": 0.5}, "dataset").join(
        exact_quantiles(measures, "sharpness", {"sharpness_median": 0.5}, "dataset"), "dataset"
    )
    return sums.join(middle, "dataset", "left")


def dataset_summary(images: DataFrame, dimensions: list[str]) -> DataFrame:
    """Images and boxes by each value of each dimension, in one pass over grouping sets."""
    long = images.unpivot(["image_id", "n_boxes"], dimensions, "dimension", "value")
    return long.groupBy("dimension", "value").agg(F.count(F.lit(1)).alias("n_images"), F.sum("n_boxes").alias("n_boxes"))
