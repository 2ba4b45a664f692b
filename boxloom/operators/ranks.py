"""Exact order statistics and ranks of large groups, by counts of ranges that narrow down to what is asked for.

No group is sorted or held whole: a pass counts the cells of a range of values, the cell that holds a
rank is the next range, and only a cell of a bounded number of rows is sorted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boxloom.sources.scratch import new_path

CELLS = 4096  # of a range
SORTED = 100_000  # rows that are sorted at once


def _held(rows: DataFrame) -> DataFrame:
    """A table of a few rows a group and cell, written so that later passes do not compute it again."""
    path = new_path(rows.sparkSession, "ranks")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _group(by: tuple[str, ...]) -> Column:
    return F.struct(*by) if by else F.lit(0)


def _cell(v: Column, low: Column, high: Column, first: bool) -> Column:
    """The cell of a value in its range; any function that never falls will do, and the first pass takes logarithms."""

    def at(x: Column) -> Column:
        x = x.cast("double")
        return F.signum(x) * F.log1p(F.abs(x)) if first else x

    share = (at(v) - at(low)) / (at(high) - at(low))
    return F.coalesce(F.greatest(F.least(F.floor(share * CELLS), F.lit(CELLS - 1)), F.lit(0)), F.lit(0)).cast("int")


def order_statistics(rows: DataFrame, column: str, ranks: DataFrame) -> DataFrame:
    """``g``, ``rank`` and ``value``: of each group ``g`` of ``rows``, the value of each rank (from 0 on) in ``ranks``.

    ``rows`` have ``g`` and the column, without nulls and NaN. Ranks that a group does not have give no row. A
    value that very many rows share is a cell of its own as soon as its range is, and is never sorted.
    """
    values = rows.select("g", F.col(column).alias("v"))
    whole = values.groupBy("g").agg(F.min("v").alias("a"), F.max("v").alias("b"), F.count(F.lit(1)).alias("n"))
    todo = _held(ranks.select("g", "rank").distinct().join(whole, "g").where("rank BETWEEN 0 AND n - 1").withColumn("skip", F.lit(0).cast("bigint")))
    done, first = [], True
    while True:
        done.append(todo.where("a = b").select("g", "rank", F.col("a").alias("value")))
        small = todo.where((F.col("a") < F.col("b")) & (F.col("n") <= SORTED))
        inside = values.join(small.select("g", "a", "b").distinct(), "g").where("v BETWEEN a AND b")
        placed = inside.withColumn("at", F.row_number().over(Window.partitionBy("g", "a", "b").orderBy("v")))
        done.append(small.join(placed, ["g", "a", "b"]).where("at = rank - skip + 1").select("g", "rank", F.col("v").alias("value")))
        large = todo.where((F.col("a") < F.col("b")) & (F.col("n") > SORTED))
        if not large.limit(1).count():
            return reduce(DataFrame.union, done)
        ranges = large.select("g", "a", "b").distinct()
        cells = (
            values.join(ranges, "g").where("v BETWEEN a AND b").withColumn("cell", _cell(F.col("v"), F.col("a"), F.col("b"), first))
            .groupBy("g", "a", "b", "cell").agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("m"))
        )
        before = Window.partitionBy("g", "a", "b").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
        cells = cells.withColumn("before", F.coalesce(F.sum("m").over(before), F.lit(0)))
        hit = (F.col("rank") >= F.col("skip") + F.col("before")) & (F.col("rank") < F.col("skip") + F.col("before") + F.col("m"))
        todo = _held(
            large.join(cells, ["g", "a", "b"]).where(hit)
            .select("g", "rank", F.col("low").alias("a"), F.col("high").alias("b"), F.col("m").alias("n"), (F.col("skip") + F.col("before")).alias("skip"))
        )
        first = False


def exact_quantiles(rows: DataFrame, column: str, shares: dict[str, float], *by: str) -> DataFrame:
    """The quantiles of a group's present numbers, each as a column, interpolated between neighbours as ``percentile`` does."""
    v = F.col(column).cast("double")
    rows = rows.where(v.isNotNull() & ~F.isnan(v)).select(_group(by).alias("g"), v.alias("v"))
    names = F.array(*[F.struct(F.lit(k).alias("name"), F.lit(p).alias("p")) for k, p in shares.items()])
    wanted = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).select("g", F.explode(names).alias("x"), (F.col("x.p") * (F.col("n") - 1)).alias("at"))
    wanted = wanted.select("g", "x.name", "at", F.floor("at").alias("low"), F.ceil("at").alias("high"))
    found = order_statistics(rows, "v", wanted.select("g", F.explode(F.array("low", "high")).alias("rank")))
    both = wanted.join(found.select("g", F.col("rank").alias("low"), F.col("value").alias("x")), ["g", "low"]).join(
        found.select("g", F.col("rank").alias("high"), F.col("value").alias("y")), ["g", "high"]
    )
    value = F.when(F.col("low") == F.col("high"), F.col("x")).otherwise((F.col("high") - F.col("at")) * F.col("x") + (F.col("at") - F.col("low")) * F.col("y"))
    out = both.groupBy("g").agg(*[F.max(F.when(F.col("name") == k, value)).alias(k) for k in shares])
    return out.select(*[F.col("g").getField(c).alias(c) for c in by], *shares)


def least_rows(rows: DataFrame, targets: DataFrame, key: Column, *by: str) -> DataFrame:
    """The ``target`` rows of the least keys of each group, fewer where it has fewer; keys are texts of hexadecimal digits.

    The first 15 digits are compared as a number; rows of the very number at which a group is cut are put in order
    by the whole key.
    """
    number = F.conv(F.substring("_key", 1, 15), 16, 10).cast("bigint")
    rows = rows.withColumn("_key", key).withColumn("_number", number).withColumn("_g", _group(by))
    goals = targets.select(_group(by).alias("_g"), F.col("target").cast("bigint").alias("_target"))
    counts = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    goals = goals.join(counts, "_g").withColumn("_target", F.least("_target", "_n")).where("_target > 0").drop("_n")
    cut = order_statistics(rows.withColumnRenamed("_g", "g"), "_number", goals.select(F.col("_g").alias("g"), (F.col("_target") - 1).alias("rank")))
    goals = _held(goals.join(cut.select(F.col("g").alias("_g"), F.col("value").alias("_cut")), "_g"))
    near = rows.join(goals, "_g").where("_number <= _cut")
    less = near.where("_number < _cut")
    taken = less.groupBy("_g").agg(F.count(F.lit(1)).alias("_less"))
    ties = near.where("_number = _cut").withColumn("_at", F.row_number().over(Window.partitionBy("_g").orderBy("_key"))).join(taken, "_g", "left")
    ties = ties.where(F.col("_at") <= F.col("_target") - F.coalesce("_less", F.lit(0)))
    own = [c for c in rows.columns if c not in ("_key", "_number", "_g")]
    return less.select(*own).unionByName(ties.select(*own))


def turns(rows: DataFrame, name: str, *by: str, sequence: str, order: tuple[str, ...]) -> DataFrame:
    """``name``: the place of a row in its group, in the order of sequences and, within one, of ``order``.

    Sequences are counted; the counts give each its first number, so only a sequence is sorted.
    """
    counts = rows.groupBy(*by, sequence).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy(sequence).rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*by, sequence, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    at = F.row_number().over(Window.partitionBy(*by, sequence).orderBy(*order))
    return rows.withColumn("_at", at).join(first, [*by, sequence]).withColumn(name, F.col("_first") + F.col("_at")).drop("_at", "_first")
