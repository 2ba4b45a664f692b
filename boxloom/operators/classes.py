"""Class rules, exclusions and joins of boxes with their images, splits and scenes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom.functions.text import normal_path


def apply_class_rules(boxes: DataFrame, rules: DataFrame) -> DataFrame:
    """Left join with the rules; ``action`` is KEEP, IGNORE_REGION or REJECT, with the mapping status.

    The rules decide: where boxes bring a ``source_mapped_class`` that says otherwise (null and '' are the same), the
    status is CORRECTED_TO_CONFIG. The rules are one row for each dataset and class of a closed vocabulary.
    """
    out = boxes.join(rules.withColumn("_rule", F.lit(True)), ["dataset", "original_class"], "left")
    action = F.when(F.col("include"), "KEEP").when(F.col("handling") == "IGNORE_REGION", "IGNORE_REGION").otherwise("REJECT")
    status = F.when(F.col("_rule").isNull(), "UNMAPPED_CLASS")
    if "source_mapped_class" in boxes.columns:
        blank = F.lit("")
        status = status.when(F.coalesce("source_mapped_class", blank) != F.coalesce("mapped_class", blank), "CORRECTED_TO_CONFIG")
    return out.withColumn("action", action).withColumn("mapping_status", status.otherwise("CONSISTENT")).drop("_rule")


def exclude_tracks(boxes: DataFrame, exclusions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Boxes whose (sequence, track) is not excluded, and the rejected ones with a reason."""
    on = ["sequence_id", "track_id"]
    keys = exclusions.select(*on).distinct()
    return boxes.join(keys, on, "left_anti"), boxes.join(keys, on, "left_semi").withColumn("reason", F.lit("TRACK_EXCLUDED"))


def join_split(rows: DataFrame, assignments: DataFrame) -> DataFrame:
    """Rows with the split of their (dataset, sequence); a missing assignment raises."""
    out = rows.join(assignments, ["dataset", "sequence_id"], "left")
    missing = F.raise_error(F.concat(F.lit("no split for "), "dataset", F.lit(":"), "sequence_id"))
    return out.withColumn("split", F.when(F.col("split").isNull(), missing).otherwise(F.col("split")))


def join_scene(rows: DataFrame, scenes: DataFrame) -> DataFrame:
    """Rows with scene attributes, UNKNOWN where missing, and the state of the metadata."""
    marked = scenes.withColumn("scene_status", F.lit("PRESENT"))
    out = rows.join(marked, ["dataset", "sequence_id"], "left")
    names = [c for c in scenes.columns if c not in ("dataset", "sequence_id")]
    for c in names:
        out = out.withColumn(c, F.coalesce(c, F.lit("UNKNOWN")))
    return out.withColumn("scene_status", F.coalesce("scene_status", F.lit("MISSING_METADATA")))


def without_partner(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``left`` whose key is not in ``right``."""
    return left.join(right.select(*on).distinct(), on, "left_anti")


def pair_check(images: DataFrame, labels: DataFrame, on: list[str]) -> DataFrame:
    """Keys that are missing on one side: MISSING_LABEL or MISSING_IMAGE."""
    a, b = images.select(*on).distinct().withColumn("_a", F.lit(1)), labels.select(*on).distinct().withColumn("_b", F.lit(1))
    both = a.join(b, on, "full_outer")
    issue = F.when(F.col("_b").isNull(), "MISSING_LABEL").when(F.col("_a").isNull(), "MISSING_IMAGE")
    return both.withColumn("issue", issue).where("issue IS NOT NULL").drop("_a", "_b")


def manifest_diff(expected: DataFrame, actual: DataFrame, path: str = "relative_path", value: str = "checksum") -> DataFrame:
    """MATCH, MISSING, UNEXPECTED or MODIFIED for each path of two manifests."""
    e = expected.select(path, F.col(value).alias("expected"), F.lit(1).alias("_e"))
    a = actual.select(path, F.col(value).alias("actual"), F.lit(1).alias("_a"))
    state = (
        F.when(F.col("_a").isNull(), "MISSING").when(F.col("_e").isNull(), "UNEXPECTED")
        .when(F.col("expected").eqNullSafe(F.col("actual")), "MATCH").otherwise("MODIFIED")
    )
    return e.join(a, path, "full_outer").withColumn("state", state).drop("_e", "_a")


def append_new(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``target`` and the rows of ``new`` whose key it does not know."""
    return target.unionByName(new.join(target.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def apply_split_moves(rows: DataFrame, moves: DataFrame) -> DataFrame:
    """``split`` replaced for the (dataset, sequence) pairs that ``moves`` lists with a ``new_split``; a listed pair that is not there raises."""
    on = ["dataset", "sequence_id"]
    out = rows.join(moves, on, "left").withColumn("split", F.coalesce("new_split", "split")).drop("new_split")
    absent = F.raise_error(F.concat(F.lit("no sequence "), "dataset", F.lit(":"), "sequence_id")).cast("boolean")
    known = rows.select(*on).distinct().withColumn("_known", F.lit(True))
    refused = moves.join(known, on, "left").where(F.when(F.col("_known").isNull(), absent).otherwise(F.lit(False))).select(*on)
    return out.unionByName(refused, allowMissingColumns=True).select(*rows.columns)


def split_moves_log(rows: DataFrame, moves: DataFrame) -> DataFrame:
    """What moves change: a row for each (dataset, sequence) that leaves a split, with both splits; moves to where it is already are none."""
    now = rows.select("dataset", "sequence_id", F.col("split").alias("from_split")).distinct()
    return now.join(moves.select("dataset", "sequence_id", F.col("new_split").alias("to_split")), ["dataset", "sequence_id"]).where("NOT from_split <=> to_split")


def select_by_manifest(rows: DataFrame, manifest: DataFrame, path: str = "source_file", strict: bool = True) -> DataFrame:
    """Rows whose path equals a selected manifest path, or else ends with it at a slash; ``n_matches`` by wanted path.

    A wanted path that no row or more than one has raises, if ``strict``; ``selection_errors`` lists them. A path
    is spelled out as its suffixes, so the join is on whole wanted paths and not on a bare file name that every
    sequence has.
    """
    out = _selected(rows, manifest, path)
    if not strict:
        return out
    wrong = F.raise_error(F.concat_ws(" ", F.lit("selection"), "error", "wanted")).cast("boolean")
    refused = selection_errors(rows, manifest, path).where(wrong).select("wanted")
    return out.unionByName(refused, allowMissingColumns=True).select(*out.columns)


def selection_errors(rows: DataFrame, manifest: DataFrame, path: str = "source_file") -> DataFrame:
    """Wanted paths of a manifest that are MISSING or AMBIGUOUS among the rows."""
    wanted = manifest.where("selected").select(normal_path(F.col(path)).alias("wanted")).distinct()
    n = _selected(rows, manifest, path).groupBy("wanted").agg(F.count(F.lit(1)).alias("n"))
    error = F.when(F.col("n").isNull(), "MISSING").when(F.col("n") > 1, "AMBIGUOUS")
    return wanted.join(n, "wanted", "left").withColumn("error", error).where("error IS NOT NULL").select("wanted", "error")


def _selected(rows: DataFrame, manifest: DataFrame, path: str) -> DataFrame:
    m = manifest.where("selected").select(normal_path(F.col(path)).alias("wanted")).distinct()
    r = rows.withColumn("own", normal_path(F.col(path))).withColumn("parts", F.split("own", "/"))
    suffixes = F.expr("transform(sequence(1, size(parts)), k -> array_join(slice(parts, k, size(parts)), '/'))")
    hits = r.withColumn("wanted", F.explode(suffixes)).join(m, "wanted")
    exact = F.max(F.col("own") == F.col("wanted")).over(Window.partitionBy("wanted"))
    hits = hits.withColumn("exact", exact).where("NOT exact OR own = wanted")
    return hits.withColumn("n_matches", F.count(F.lit(1)).over(Window.partitionBy("wanted"))).drop("own", "parts", "exact")


def join_image_dims(boxes: DataFrame, images: DataFrame) -> DataFrame:
    """Boxes with ``width`` and ``height`` of their image, and an ``issue`` where it has none."""
    out = boxes.drop("width", "height").join(images.select("image_id", "width", "height"), "image_id", "left")
    return out.withColumn("issue", F.when(F.col("width").isNull() | F.col("height").isNull(), "MISSING_IMAGE_METADATA"))
