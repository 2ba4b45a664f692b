"""Uniform shuffle of a table into shards of exact sizes, by a hypergeometric communication matrix.

A uniform random permutation of all rows sends a random number of rows of each partition to each shard.
Those numbers are drawn first, as one matrix with the partitions' row counts and the shards' sizes for
margins; then partitions and shards only permute their own rows:

1. rows are put in random order within each partition;
2. the first ``m[p][0]`` rows of partition ``p`` go to shard 0, the next ``m[p][1]`` to shard 1, ...;
3. rows are put in random order again within each shard.

Scale: the driver sees one count a partition and sends back one row of the matrix a partition, of
``MOST_PARTS`` at most. No sort is global and none needs a whole shard in one task: a shard's order is a
random key cut into ranges, whose counts give each range its first slot. Random keys are hashes of the
row's place, so hot keys and repeated rows are spread like all others.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from boxloom.llm.columns import packed, unpacked
from boxloom.llm.scratch import written

#: Partitions that rows are dealt from, at most; with 24 shards the broadcast matrix has 20 MB then.
MOST_PARTS = 100_000
_PLACE = (1 << 33) - 1  # monotonically_increasing_id: the partition above, the place in it below


def _stirling_error(n: int) -> float:
    """``ln n!`` less Stirling's formula, to the last digits also where ``ln n!`` itself is large."""
    if n < 16:
        return math.lgamma(n + 1) - (n + 0.5) * math.log(n) + n - 0.5 * math.log(2 * math.pi)
    return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / 1680 / n / n) / n / n) / n / n) / n


def _deviance(x: float, mean: float) -> float:
    """``x ln(x / mean) + mean - x``, without cancellation where the two are close."""
    d = (x - mean) / (x + mean)
    if abs(d) > 0.1:
        return x * math.log(x / mean) + mean - x
    total, term, k = (x - mean) * d, 2 * x * d, 1
    while term and abs(term) > 1e-18 * abs(total):
        term *= d * d
        k += 2
        total += term / k
    return total


def _binomial(x: int, n: int, p: float) -> float:
    """Probability of ``x`` successes in ``n`` trials."""
    if x in (0, n):
        return (p if x else 1 - p) ** n
    error = _stirling_error(n) - _stirling_error(x) - _stirling_error(n - x)
    return math.sqrt(n / (2 * math.pi * x * (n - x))) * math.exp(error - _deviance(x, n * p) - _deviance(n - x, n * (1 - p)))


def hypergeometric(rng: random.Random, good: int, bad: int, drawn: int) -> int:
    """How many of ``drawn`` items without replacement are good, by inversion from the mode outwards.

    The mode's probability is a ratio of three binomial ones whose large parts cancel on paper, not in
    doubles (Loader, "Fast and accurate computation of binomial probabilities", 2000), so it is good to
    about 1e-12 at any number of rows. Draws beyond what is left of the sum by then fall to the mode.
    """
    low, high = max(0, drawn - bad), min(drawn, good)
    if low == high:
        return low
    mode = min(high, max(low, (drawn + 1) * (good + 1) // (good + bad + 2)))
    share = drawn / (good + bad)
    p = _binomial(mode, good, share) * _binomial(drawn - mode, bad, share) / _binomial(drawn, good + bad, share)
    left = rng.random() - p
    up = down = mode
    p_up = p_down = p
    while left > 0:
        if up < high:
            p_up *= (good - up) * (drawn - up) / ((up + 1) * (bad - drawn + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - drawn + down) / ((good - down + 1) * (drawn - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
        if (up == high or p_up < 1e-300) and (down == low or p_down < 1e-300):
            return mode
    return mode


def communication_matrix(rows: list[int], columns: list[int], seed: int) -> list[list[int]]:
    """A random matrix with these margins, as a uniform permutation makes it."""
    if sum(rows) != sum(columns):
        raise ValueError("margins have different sums")
    rng = random.Random(seed)
    left, out = list(columns), []
    for n in rows:
        rest, own = sum(left), []
        for c in left:
            k = hypergeometric(rng, c, rest - c, n)
            own.append(k)
            rest, n = rest - c, n - k
        left = [a - b for a, b in zip(left, own, strict=True)]
        out.append(own)
    return out


def uniform_shards(df: DataFrame, shards: int, seed: int = 0, rows_per_range: int = 50_000) -> DataFrame:
    """The rows of ``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (0, 1, ... in each shard).

    Shards differ by one row at most, the first ones are the larger. Any columns may be null; repeated
    rows are rows of their own; an empty table gives an empty table. Old columns of the result names (in
    any case) are replaced. Rows are written once to the shared folder, so all steps see the same order,
    also after a loss of executors.
    """
    spark = df.sparkSession
    columns, row = packed(df, ["shard", "slot"])
    rows = df.coalesce(MOST_PARTS).select(row.alias("row"), F.xxhash64(F.monotonically_increasing_id(), F.lit(seed)).alias("k")).sortWithinPartitions("k")
    rows = written(rows.select("row", F.monotonically_increasing_id().alias("id")))
    rows = rows.withColumn("part", F.shiftright("id", 33)).withColumn("place", F.col("id").bitwiseAND(_PLACE))

    counts = sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect())
    total = sum(n for _, n in counts)
    sizes = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    ends = [(p, [sum(own[: s + 1]) for s in range(shards)]) for (p, _), own in zip(counts, matrix, strict=True)]
    bounds = spark.createDataFrame(ends, "part bigint, ends array<bigint>")

    ranges = max(1, -(-total // shards // rows_per_range), int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
    key = F.xxhash64("id", F.lit(seed + 1))
    dealt = rows.join(F.broadcast(bounds), "part").select(
        "row",
        F.expr("size(filter(ends, e -> e <= place))").alias("shard"),
        key.alias("k"),
        # ranges of the key's upper bits, in the order of the key
        F.floor((F.shiftright(key, 32) + (1 << 31)) * ranges / (1 << 32)).cast("int").alias("range"),
    )
    firsts = dealt.groupBy("shard", "range").agg(F.count(F.lit(1)).alias("n"))
    firsts = firsts.withColumn("first", F.sum("n").over(Window.partitionBy("shard").orderBy("range")) - F.col("n"))
    within = Window.partitionBy("shard", "range").orderBy("k")
    placed = dealt.withColumn("at", F.row_number().over(within) - 1)
    return placed.join(firsts.drop("n"), ["shard", "range"]).select(
        *unpacked(columns, "row"), "shard", (F.col("first") + F.col("at")).alias("slot")
    )
