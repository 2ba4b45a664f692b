"""Leakage-safe splits: assignment, audits, scene coverage and heat maps."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _head(key: Column) -> Column:
    return F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")


def hash_split(key: Column) -> Column:
    """80/10/10 by the first eight hex digits of the SHA-256, over 0xFFFFFFFF."""
    share = _head(key) / F.lit(0xFFFFFFFF)
    return F.when(share < 0.8, "train").when(share < 0.9, "validation").otherwise("cross_test")


def hash_split_mod(key: Column) -> Column:
    """70/15/15 by the same digits modulo 100."""
    slot = F.pmod(_head(key), F.lit(100))
    return F.when(slot < 70, "train").when(slot < 85, "validation").otherwise("test")


def assign_split(sequences: DataFrame, overrides: DataFrame, fixed: DataFrame) -> DataFrame:
    """Split of each (dataset, sequence): the dataset's override, a fixed cross-test member, or the hash."""
    out = sequences.join(overrides.select("dataset", "override"), "dataset", "left")
    out = out.join(fixed.select("dataset", "sequence_id", F.lit(True).alias("fixed")), ["dataset", "sequence_id"], "left")
    split = F.when(F.col("override").isNotNull(), F.col("override")).when(F.col("fixed"), "cross_test")
    reason = F.when(F.col("override").isNotNull(), "DATASET_OVERRIDE").when(F.col("fixed"), "FIXED_CROSS_TEST").otherwise("HASH")
    key = F.concat_ws(":", "dataset", "sequence_id")
    out = out.withColumn("split", split.otherwise(hash_split(key))).withColumn("split_reason", reason)
    return out.withColumn("evaluation_eligible", F.col("override").isNull()).drop("override", "fixed")


def split_distribution(rows: DataFrame) -> DataFrame:
    """Sequences, images and the share of sequences by dataset and split."""
    from pyspark.sql import Window

    out = rows.groupBy("dataset", "split").agg(F.countDistinct("sequence_id").alias("n_sequences"), F.countDistinct("image_id").alias("n_images"))
    return out.withColumn("sequence_share", F.col("n_sequences") / F.sum("n_sequences").over(Window.partitionBy("dataset")))


def sequence_leakage(rows: DataFrame, *key: str) -> DataFrame:
    """Keys (sequences by default) that are in more than one split."""
    key = key or ("dataset", "sequence_id")
    out = rows.where("split IS NOT NULL").groupBy(*key).agg(F.sort_array(F.collect_set("split")).alias("_s"))
    return out.where(F.size("_s") > 1).select(*key, F.array_join("_s", "|").alias("splits"))


def split_key_intersect(a: DataFrame, b: DataFrame, *key: str) -> DataFrame:
    """Keys of both sides, as a set operation."""
    return a.select(*key).intersect(b.select(*key))


def missing_coverage(required: DataFrame, observed: DataFrame) -> DataFrame:
    """Required combinations that were not observed."""
    return required.select(*required.columns).exceptAll(observed.select(*required.columns).distinct())


@dataclass(frozen=True)
class SplitPolicy:
    """What an assignment has to keep to."""

    units: tuple[str, ...] = ("SEQUENCE_ID", "DATASET_TRAIN_ONLY_NO_SEQUENCE")
    least_test_datasets: int = 2
    test_road_types: tuple[str, ...] = ()
    test_lightings: tuple[str, ...] = ()
    train_only: tuple[str, ...] = ()
    main_test_collected: bool = False
    main_test_locked: bool = False


def split_audit(assigned: DataFrame, scenes: DataFrame, files: DataFrame, fixed: DataFrame, policy: SplitPolicy) -> DataFrame:
    """Named checks of an assignment with the number of offenders and PASS, FAIL, PARTIAL or PENDING.

    ``assigned`` has ``split``, ``split_unit`` and ``evaluation_eligible`` of each (dataset, sequence), ``files`` the
    ``source_file`` of sequences, ``fixed`` the required test members. Gaps of coverage that more data can close are
    PARTIAL, what waits for the main test set is PENDING.
    """
    keys, spark = ["dataset", "sequence_id"], assigned.sparkSession

    def check(name, offenders, otherwise="FAIL"):
        n = offenders.agg(F.count(F.lit(1)).alias("n_offenders"))
        return n.select(F.lit(name).alias("check_name"), "n_offenders", F.when(F.col("n_offenders") == 0, "PASS").otherwise(otherwise).alias("status"))

    def wanted(values, column):
        return spark.createDataFrame([(v,) for v in values], f"{column} string")

    test = assigned.where("split = 'cross_test'")
    seen = test.join(scenes, keys)
    few = test.agg(F.greatest(F.lit(policy.least_test_datasets) - F.countDistinct("dataset"), F.lit(0)).alias("n")).where("n > 0")
    elsewhere = assigned.where(F.col("dataset").isin(*policy.train_only) & ((F.col("split") != "train") | F.col("evaluation_eligible")))
    absent = wanted(policy.train_only, "dataset").join(assigned.select("dataset").distinct(), "dataset", "left_anti")
    waiting = [(name,) for name, done in (("main_test_collected", policy.main_test_collected), ("main_test_locked", policy.main_test_locked)) if not done]
    waiting = spark.createDataFrame(waiting, "name string")
    in_files = files.select(*keys, "source_file").distinct().join(assigned.select(*keys, "split"), keys)
    checks = [
        check("sequence_in_one_split", sequence_leakage(assigned)),
        check("file_in_one_split", sequence_leakage(in_files, "dataset", "source_file")),
        check("split_unit_is_sequence", assigned.where(~F.coalesce("split_unit", F.lit("UNKNOWN")).isin(*policy.units))),
        check("test_datasets", few),
        check("validation_datasets", assigned.where("evaluation_eligible").select("dataset").distinct().exceptAll(assigned.where("split = 'validation'").select("dataset").distinct()), "PARTIAL"),
        check("test_road_types", missing_coverage(wanted(policy.test_road_types, "road_type"), seen.select("road_type")), "PARTIAL"),
        check("test_lightings", missing_coverage(wanted(policy.test_lightings, "lighting"), seen.select("lighting")), "PARTIAL"),
        check("train_only_datasets", elsewhere.select("dataset").unionByName(absent)),
        check("fixed_test_members", fixed.select(*keys).exceptAll(test.select(*keys))),
        *[check(name, waiting.where(F.col("name") == name), "PENDING") for name in ("main_test_collected", "main_test_locked")],
        check("split_is_known", assigned.where("split IS NULL OR split NOT IN ('train', 'validation', 'cross_test')")),
        check("sequence_listed_once", assigned.groupBy(*keys).count().where("count > 1")),
        check("scene_is_present", assigned.join(scenes, keys, "left_anti")),
    ]
    return reduce(DataFrame.unionByName, checks)


def coverage_violations(assigned: DataFrame, least: int = 2) -> DataFrame:
    """Combinations of road and lighting under test with fewer than ``least`` training sequences."""
    on = ["road_type", "lighting"]
    test = assigned.where("split <> 'train'").groupBy(*on).agg(F.count(F.lit(1)).alias("n_test"))
    train = assigned.where("split = 'train'").groupBy(*on).agg(F.count(F.lit(1)).alias("n_train"))
    out = test.join(train, on, "left").withColumn("n_train", F.coalesce("n_train", F.lit(0)))
    return out.where(F.col("n_train") < least)


def scene_distribution(assigned: DataFrame, dimensions=("road_type", "lighting", "weather", "camera_view")) -> DataFrame:
    long = assigned.unpivot(["split", "dataset"], list(dimensions), "dimension", "value")
    return long.groupBy("split", "dataset", "dimension", "value").agg(F.count(F.lit(1)).alias("n_sequences"))


def scene_slices(boxes: DataFrame, scenes: DataFrame, dimensions=("road_type", "lighting", "weather", "camera_view")) -> DataFrame:
    """Share of each class and size within each scene slice.

    Boxes are counted by sequence, class and size before they meet the scenes, so only counts are unpivoted.
    """
    from pyspark.sql import Window

    from boxloom.operators.boxes import box_geometry

    counts = box_geometry(boxes).groupBy("dataset", "sequence_id", "original_class", "size_category").agg(F.count(F.lit(1)).alias("n"))
    long = counts.join(scenes, ["dataset", "sequence_id"]).unpivot(["original_class", "size_category", "n"], list(dimensions), "dimension", "value")
    out = long.groupBy("dimension", "value", "original_class", "size_category").agg(F.sum("n").alias("n_boxes"))
    return out.withColumn("share", F.col("n_boxes") / F.sum("n_boxes").over(Window.partitionBy("dimension", "value")))


def sequence_statistics(images: DataFrame, boxes: DataFrame) -> DataFrame:
    """Images, boxes, size counts and the share of difficult (small or occluded) boxes a sequence."""
    from boxloom.operators.boxes import letterbox_metrics

    rows = letterbox_metrics(boxes).withColumn("hard", F.col("occluded") | F.col("lb_category").isin("EXTREMELY_TINY", "VERY_SMALL"))
    b = rows.groupBy("dataset", "sequence_id").agg(
        F.count(F.lit(1)).alias("n_boxes"), F.count_if(F.col("lb_category") == "USABLE").alias("n_usable"), F.count_if("hard").alias("n_hard")
    )
    i = images.groupBy("dataset", "sequence_id").agg(F.count(F.lit(1)).alias("n_images"))
    return i.join(b, ["dataset", "sequence_id"], "left").withColumn("hard_ratio", F.when(F.col("n_boxes") > 0, F.col("n_hard") / F.col("n_boxes")))


def heatmap(assigned: DataFrame) -> DataFrame:
    """Dense counts of sequences by road and lighting, for each split group and overall; test splits are one.

    The cells come from the distinct values of three closed vocabularies.
    """
    rows = assigned.withColumn("split", F.when(F.col("split") == "cross_test", "test").otherwise(F.col("split")))
    counts = rows.cube("split", "road_type", "lighting").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("g"))
    counts = counts.where("g IN (0, 4)").withColumn("split", F.coalesce("split", F.lit("overall"))).drop("g")
    sets = [F.collect_set(c).alias(c) for c in ("split", "road_type", "lighting")]  # of closed vocabularies
    grid = rows.agg(*sets).select(F.explode(F.array_append("split", F.lit("overall"))).alias("split"), "road_type", "lighting")
    grid = grid.withColumn("road_type", F.explode("road_type")).withColumn("lighting", F.explode("lighting"))
    return grid.join(counts, ["split", "road_type", "lighting"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
