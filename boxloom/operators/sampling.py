"""Reproducible samples and subset plans: hash order, round robin, quotas. No random generator, no global sort of all rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boxloom.operators.ranks import least_rows


def hash_key(*key: str) -> Column:
    return F.sha2(F.concat_ws("|", *[F.col(k).cast("string") for k in key]), 256)


def hash_rank(seed: str, *key: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(seed), *[F.col(k).cast("string") for k in key]), 256)


def sample_fixed(rows: DataFrame, n: int, seed: str, *key: str) -> DataFrame:
    """``n`` rows, uniform by hash order: the same whatever the order and the partitions of the input."""
    return rows.withColumn("rank_hash", hash_rank(seed, *key)).orderBy("rank_hash").limit(n)


def sample_cover(rows: DataFrame, n: int, seed: str) -> DataFrame:
    """The first frame of each sequence, then a sample of the rest, ``n`` rows in all (more if sequences are more)."""
    w = Window.partitionBy("dataset", "sequence_id").orderBy("frame_id")
    first = rows.withColumn("rn", F.row_number().over(w).cast("bigint")).where("rn = 1").drop("rn").withColumn("picked", F.lit("FIRST_FRAME"))
    rest = rows.join(first.select("image_id"), "image_id", "left_anti")
    # at most n rows are numbered; the number of first frames meets them by a constant key
    some = sample_fixed(rest, n, seed, "image_id").withColumn("place", F.row_number().over(Window.orderBy("rank_hash"))).withColumn("one", F.lit(1))
    taken = first.agg(F.count(F.lit(1)).alias("taken")).withColumn("one", F.lit(1))
    fill = some.join(taken, "one").where(F.col("place") <= n - F.col("taken")).drop("rank_hash", "place", "one", "taken")
    return first.unionByName(fill.withColumn("picked", F.lit("FILL")))


def sample_quota(rows: DataFrame, targets: DataFrame, seed: str) -> DataFrame:
    """The first ``target`` rows of each (split, dataset) in hash order; a short group raises.

    The hash at which a group is cut is found by counts, so no group is sorted whole.
    """
    out = least_rows(rows, targets, hash_rank(seed, "image_id"), "split", "dataset")
    n = rows.groupBy("split", "dataset").agg(F.count(F.lit(1)).alias("n"))
    refuse = F.raise_error(F.lit("a quota cannot be met")).cast("boolean")
    short = F.when(F.coalesce("n", F.lit(0)) < F.col("target"), refuse).otherwise(F.lit(False))
    refused = targets.join(n, ["split", "dataset"], "left").where(short).select("split", "dataset")
    return out.unionByName(refused, allowMissingColumns=True).select(*out.columns)


def round_robin(rows: DataFrame, *group: str, order: tuple[str, ...] = ("frame_id",)) -> DataFrame:
    """``turn``: 1 for the first row of each group, 2 for the second, ...; order by it to interleave."""
    return rows.withColumn("turn", F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("bigint"))


def subset_plan(rows: DataFrame, allocation: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first ``target`` candidates of each dataset in round-robin order of their sequences, and shortfalls.

    ``allocation`` has dataset and target, and may have a ``scenario``: scenarios take from the same order, each
    as far as its target. A sequence can give at most the greatest target, so its later rows are dropped before
    the dataset is ordered.
    """
    on = ["scenario", "dataset"] if "scenario" in allocation.columns else ["dataset"]
    most = allocation.groupBy("dataset").agg(F.max("target").alias("_most"))
    turns = round_robin(rows, "dataset", "sequence_id").join(most, "dataset").where("turn <= _most")
    w = Window.partitionBy("dataset").orderBy("turn", "sequence_id", "image_id")
    ordered = turns.withColumn("position", F.row_number().over(w).cast("bigint")).where("position <= _most").drop("_most")
    picked = ordered.join(allocation.select(*on, "target"), "dataset").where("position <= target")
    n = picked.groupBy(*on).agg(F.count(F.lit(1)).alias("n_selected"))
    report = allocation.join(n, on, "left").withColumn("n_selected", F.coalesce("n_selected", F.lit(0)))
    return picked, report.withColumn("shortfall", F.greatest(F.col("target") - F.col("n_selected"), F.lit(0)))


def first_candidate_per_source(rows: DataFrame, source: str, mapped: str, ordinal: str) -> DataFrame:
    """One row a source: the first that is mapped, else the first."""
    w = Window.partitionBy(source).orderBy(F.col(mapped).isNull(), ordinal)
    return rows.withColumn("rn", F.row_number().over(w).cast("bigint")).where("rn = 1").drop("rn")


def queue_candidates(
    rows: DataFrame, *by: str, key: tuple[str, ...] = ("sequence_id", "frame_id", "track_id"), caps: tuple[int, ...] = (1, 2, 3, 5)
) -> DataFrame:
    """Rows that ``review_queue`` can take, before other parts of a stratum are joined: the ``caps[-1]`` hash-least keys of each ``by``.

    ``by`` has the sequence, the parts of the stratum that rows have, and what the others follow from. Each task drops its
    own rows first, so that the rows dealt by group are few.
    """
    w = Window.partitionBy(*by).orderBy("_hash")
    return rows.withColumn("_hash", hash_key(*key)).withColumn("_at", F.dense_rank().over(w)).where(F.col("_at") <= caps[-1]).drop("_hash", "_at")


def review_queue(
    rows: DataFrame, n: int, *stratum: str, key: tuple[str, ...] = ("sequence_id", "frame_id", "track_id"),
    sequence: str = "sequence_id", caps: tuple[int, ...] = (1, 2, 3, 5),
) -> DataFrame:
    """A greedy queue of ``n`` keys: strata take turns, and all strata share one cap a sequence.

    In its turn a stratum gives its hash-least key that is not chosen yet and whose sequence is below the
    cap. Passes over the strata (in their order) go on until one of them gives nothing; then the cap
    rises. Returns the strata, the key, ``cap`` and ``queue_position`` from 1 on.

    The choice is sequential, but few keys can matter: no sequence gives more than the last cap, so of a
    sequence its ``caps[-1]`` hash-least keys in a stratum are enough, and keys passed over belong to
    sequences chosen before, fewer than ``n``, so a stratum's first ``caps[-1] * (n - 1) + 1`` of those are. Only they meet in
    one task, which reads them in the order of strata and hash.
    """
    names, last = list(stratum), caps[-1]
    slim = rows.select(*dict.fromkeys([*names, *key, sequence])).withColumn("rank_hash", hash_key(*key))
    of_sequence = Window.partitionBy(*names, sequence).orderBy("rank_hash")
    some = slim.withColumn("at", F.dense_rank().over(of_sequence)).where(F.col("at") <= last).drop("at").distinct()
    some = some.withColumn("at", F.row_number().over(Window.partitionBy(*names).orderBy("rank_hash"))).where(F.col("at") <= last * (n - 1) + 1).drop("at")
    columns = [c for c in some.columns if c != "rank_hash"]

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        strata: dict[tuple, list[tuple]] = {}
        for part in parts:
            own = {c: [None if pd.isna(x) else x for x in part[c].tolist()] for c in part.columns}
            rows = zip(zip(*(own[c] for c in columns), strict=True), zip(*(own[c] for c in names), strict=True), own["rank_hash"], own[sequence], strict=True)
            for values, which, rank, at in rows:
                strata.setdefault(which, []).append((rank, at, values))
        yield pd.DataFrame([(*v, c, k) for k, (v, c) in enumerate(take_turns(list(strata.values()), n, caps), 1)], columns=[*columns, "cap", "queue_position"])

    schema = T.StructType([some.schema[c] for c in columns]).add("cap", T.IntegerType()).add("queue_position", T.LongType())
    return some.repartition(1).sortWithinPartitions(*names, "rank_hash").mapInPandas(run, schema)


def take_turns(strata: list[list[tuple]], n: int, caps: tuple[int, ...]) -> list[tuple]:
    """``(value, cap)`` of the greedy choice from lists of (key, sequence, value), each in its order.

    What a list passes over under one cap stays passed over under it, so each cap reads a list once.
    """
    chosen: list[tuple] = []
    taken: set = set()
    held: dict = {}
    for cap in caps:
        at = [0] * len(strata)
        moved = True
        while moved and len(chosen) < n:
            moved = False
            for k, own in enumerate(strata):
                while at[k] < len(own) and (own[at[k]][0] in taken or held.get(own[at[k]][1], 0) >= cap):
                    at[k] += 1
                if at[k] < len(own) and len(chosen) < n:
                    key, sequence, value = own[at[k]]
                    taken.add(key)
                    held[sequence] = held.get(sequence, 0) + 1
                    chosen.append((value, cap))
                    moved = True
    return chosen


def cap_examples(rows: DataFrame, n: int, *order: str) -> DataFrame:
    w = Window.partitionBy("dataset").orderBy(*order)
    return rows.withColumn("rn", F.row_number().over(w).cast("bigint")).where(F.col("rn") <= n)


def numbered(rows: DataFrame, prefix: str, key: str, name: str = "id", width: int = 6) -> DataFrame:
    """``name``: ``prefix`` and the place of each row in the order of a text key, from 1 on.

    Rows are counted by the first two characters of the key; those counts give each part its first
    number, so that no window holds all rows. Keys have to be distinct for ids that can be repeated.
    """
    rows = rows.withColumn("part", F.substring(key, 1, 2))
    counts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each two characters
    first = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    at = rows.withColumn("at", F.row_number().over(Window.partitionBy("part").orderBy(key))).join(first, "part")
    return at.withColumn(name, F.format_string(f"{prefix}%0{width}d", F.col("first") + F.col("at"))).drop("part", "first", "at")
