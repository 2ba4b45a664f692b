"""Exact and near duplicates of files by content hash, name and perceptual hash."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom.sources.digests import with_sha256


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def hash_similarity(a: Column, b: Column) -> Column:
    return F.round(1 - hamming(a, b) / 64, 6)


def duplicate_groups(files: DataFrame, key: str = "sha256", order: str = "file_id") -> DataFrame:
    """Members of groups of an equal, present key: group size, and which one is kept (the first).

    Sizes come from pre-aggregated counts; groups are named by their key, so no global order is needed.
    """
    groups = files.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("group_size"), F.min(order).alias("first")).where("group_size > 1")
    return files.join(groups, key).withColumn("keep", F.col(order) == F.col("first")).drop("first")


def content_cross_split(files: DataFrame, key: str = "sha256") -> DataFrame:
    """Contents that are in more than one split."""
    out = files.where(F.col(key).isNotNull() & F.col("split").isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_files"), F.sort_array(F.collect_set("split")).alias("_s")
    )
    return out.where(F.size("_s") > 1).select(key, "n_files", F.array_join("_s", "|").alias("splits"))


def content_candidates(files: DataFrame) -> DataFrame:
    """Files whose checksum and size, both known without reading them, occur in more than one split."""
    both = files.where("crc IS NOT NULL AND size_bytes IS NOT NULL AND split IS NOT NULL")
    groups = both.groupBy("crc", "size_bytes").agg(F.min("split").alias("_a"), F.max("split").alias("_b")).where("_a <> _b")
    return both.join(groups.select("crc", "size_bytes"), ["crc", "size_bytes"], "left_semi").select(*files.columns)


def exact_content_cross_split(files: DataFrame) -> DataFrame:
    """Contents in more than one split, of files with ``path``, ``split``, ``crc`` and ``size_bytes``.

    Only the files that checksum and size leave are opened and hashed, so the bytes that are read follow
    the number of likely copies, not of files.
    """
    rows = with_sha256(content_candidates(files).select("path", "split").repartition("path"))
    return content_cross_split(rows)


def near_duplicate_consecutive(files: DataFrame, least: float = 0.95) -> DataFrame:
    """Neighbours of a sequence, ordered by file, of nearly equal hash and different content."""
    w = Window.partitionBy("dataset", "sequence_id").orderBy("source_file")
    out = files.where("sequence_id <> 'SEQUENCE_NOT_PROVIDED'").select(
        "dataset", "sequence_id", "source_file", "phash", "sha256", F.lag("source_file").over(w).alias("previous_file"),
        F.lag("phash").over(w).alias("_p"), F.lag("sha256").over(w).alias("_s"),
    )
    out = out.withColumn("similarity", hash_similarity(F.col("phash"), F.col("_p")))
    return out.where((F.col("similarity") >= least) & (F.col("sha256") != F.col("_s"))).select(
        "dataset", "sequence_id", "previous_file", "source_file", "similarity"
    )


BANDS = ((0, 22), (22, 21), (43, 21))  # first bit and width


def _masks(width: int, errors: int) -> list[int]:
    """All differences of at most ``errors`` bits in a band."""
    return [sum(1 << b for b in bits) for n in range(errors + 1) for bits in combinations(range(width), n)]


def near_hash_pairs(hashes: DataFrame, distance: int, column: str = "phash") -> DataFrame:
    """Pairs ``(a, b, distance)`` of distinct hashes within a Hamming distance, ``a < b``.

    Two hashes within the distance differ in at most a third of it in one of three bands. Those
    differences are spelled out, half of them on either side, so that keys keep 21 bits and buckets stay
    small at any number of hashes. The pairs are of distinct hashes, however many files share one;
    files are joined by the caller.
    """
    errors = distance // len(BANDS)
    some = hashes.select(column).where(F.col(column).isNotNull()).distinct()

    def keys(k: int, at: int, width: int, most: int) -> Column:
        band = F.shiftrightunsigned(column, at).bitwiseAND(F.lit((1 << width) - 1))
        masks = F.array(*[F.lit(m).cast("bigint") for m in _masks(width, most)])
        return F.transform(masks, lambda m: F.struct(F.lit(k).alias("k"), band.bitwiseXOR(m).alias("v")))

    def keyed(name: str, most: int) -> DataFrame:
        bands = F.concat(*[keys(k, *band, most) for k, band in enumerate(BANDS)])
        return some.select(F.col(column).alias(name), F.explode(bands).alias("band"))

    pairs = keyed("a", errors - errors // 2).join(keyed("b", errors // 2), "band")
    pairs = pairs.where((F.col("a") < F.col("b")) & (hamming(F.col("a"), F.col("b")) <= distance))
    return pairs.select("a", "b", hamming(F.col("a"), F.col("b")).alias("distance")).distinct()


def near_duplicate_cross_split(files: DataFrame, distance: int = 3) -> DataFrame:
    """Hashes in different splits that are nearly equal, with ``n_pairs`` of files of different content.

    One row is a pair of (hash, split); the files of a hash are counted, not paired. ``n_pairs`` is the product of both
    counts less the pairs of equal content.
    """
    f = files.where("split IS NOT NULL AND phash IS NOT NULL")
    contents = f.groupBy("phash", "split", "sha256").agg(F.count(F.lit(1)).alias("n"))
    groups = contents.groupBy("phash", "split").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("sha256").isNotNull(), F.col("n"))).alias("known"))
    own = f.select(F.col("phash").alias("a"), F.col("phash").alias("b"), F.lit(0).alias("distance")).distinct()
    pairs = near_hash_pairs(f, distance).unionByName(own)

    def side(rows: DataFrame, name: str, *keys: str) -> DataFrame:
        return rows.select(F.col("phash").alias(name), F.col("split").alias(f"split_{name}"), *keys, *[F.col(c).alias(f"{c}_{name}") for c in ("n", "known") if c in rows.columns])

    apart = "split_a <> split_b AND (a < b OR split_a < split_b)"
    out = pairs.join(side(groups, "a"), "a").join(side(groups, "b"), "b").where(apart)
    same = pairs.join(side(contents, "a", "sha256"), "a").join(side(contents, "b", "sha256"), ["b", "sha256"]).where(apart)
    key = ["a", "split_a", "b", "split_b"]
    same = same.groupBy(*key).agg(F.sum(F.col("n_a") * F.col("n_b")).alias("same"))
    out = out.join(same, key, "left").withColumn("n_pairs", F.col("known_a") * F.col("known_b") - F.coalesce("same", F.lit(0))).where("n_pairs > 0")
    return out.select(*key, "distance", "n_pairs", F.round(1 - F.col("distance") / 64, 6).alias("similarity"))


def near_duplicate_pairs(files: DataFrame, distance: int = 8) -> DataFrame:
    """Pairs of different hashes within a distance, with how many files have each."""
    n = files.groupBy("phash").agg(F.count(F.lit(1)).alias("n"))
    pairs = near_hash_pairs(files, distance)
    pairs = pairs.join(n.select(F.col("phash").alias("a"), F.col("n").alias("n_a")), "a")
    return pairs.join(n.select(F.col("phash").alias("b"), F.col("n").alias("n_b")), "b").select("a", "b", "distance", "n_a", "n_b")
