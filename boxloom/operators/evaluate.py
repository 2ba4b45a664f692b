"""Detection scoring: greedy matching in each image, average precision, recall by size, diagnostics."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from boxloom.operators.boxes import CORNERS, iou
from boxloom.operators.ranks import _held

THRESHOLDS = tuple(round(0.5 + 0.05 * k, 2) for k in range(10))


def iou_candidates(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Overlapping pairs of a prediction and a label of the same image, with their IoU."""
    truth = labels.select("image_id", "annotation_id", *[F.col(c).alias(f"{c}2") for c in CORNERS])
    overlap = "xmin < xmax2 AND xmin2 < xmax AND ymin < ymax2 AND ymin2 < ymax"
    return predictions.join(truth, "image_id").where(overlap).select(
        "dataset", "image_id", "pred_no", "confidence", "annotation_id", iou().alias("iou")
    )


def _greedy(thresholds: tuple[float, ...]):
    """Of candidates in order, keep those whose prediction and label are both free in their image.

    Thresholds are bits: one pass over the candidates of an image answers all of them.
    """
    ordered = sorted(range(len(thresholds)), key=thresholds.__getitem__)
    levels = [thresholds[k] for k in ordered]
    reached = [sum(1 << k for k in ordered[:n]) for n in range(len(levels) + 1)]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        image, predictions, labels = None, {}, {}
        for part in parts:
            bits = []
            for own, pred_no, annotation_id, iou in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                if own != image:
                    image, predictions, labels = own, {}, {}
                free = reached[bisect_right(levels, iou)] & ~(predictions.get(pred_no, 0) | labels.get(annotation_id, 0))
                if free:
                    predictions[pred_no] = predictions.get(pred_no, 0) | free
                    labels[annotation_id] = labels.get(annotation_id, 0) | free
                bits.append(free)
            out = part.append_column("bits", pa.array(bits, pa.int32()))
            yield out.filter(pc.greater(out.column("bits"), 0))

    return run


def match_bits(candidates: DataFrame, thresholds: tuple[float, ...] = (0.5,), n_tasks: int | None = None) -> DataFrame:
    """Matched pairs with ``bits``: bit k tells whether they match at the k-th IoU threshold.

    Matches are one to one: predictions by confidence, each to the best free label; of labels with equal
    IoU the later one wins. A match touches its own image only, so rows are dealt by image and sorted; a
    partition is read as a stream that remembers one image. ``n_tasks`` is the number of partitions, else the session's.
    """
    order = ["image_id", F.desc("confidence"), "pred_no", F.desc("iou"), F.desc("annotation_id")]
    rows = candidates.where(F.col("iou") >= min(thresholds)).select("image_id", F.col("confidence").cast("double").alias("confidence"), "pred_no", "annotation_id", "iou")
    dealt = rows.repartition(n_tasks, "image_id") if n_tasks else rows.repartition("image_id")
    rows = dealt.sortWithinPartitions(*order).select("image_id", "pred_no", "annotation_id", "iou", "confidence")
    return rows.mapInArrow(_greedy(thresholds), "image_id long, pred_no string, annotation_id string, iou double, confidence double, bits int")


def match_predictions(candidates: DataFrame, thresholds: tuple[float, ...] = (0.5,), n_tasks: int | None = None) -> DataFrame:
    """The matches of ``match_bits``, a row for each threshold."""
    each = F.array(*[F.when(_bit(k) > 0, F.lit(float(x))) for k, x in enumerate(thresholds)])
    found = match_bits(candidates, thresholds, n_tasks)
    return found.select("image_id", F.explode(F.array_compact(each)).alias("threshold"), "pred_no", "annotation_id", "iou", "confidence")


def _bit(k: int) -> Column:
    return F.shiftright("bits", k).bitwiseAND(1)


def _whole_images(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches of rows in the order of ``image_id`` (the first column), cut anew so that each holds whole images."""
    held: list[pa.Table] = []
    for part in parts:
        rows = pa.Table.from_batches([part])
        if not rows.num_rows:
            continue
        images = rows.column(0).to_numpy()
        if held and held[-1].column(0)[-1].as_py() != images[0]:
            yield pa.concat_tables(held)
            held = []
        last = int(np.searchsorted(images, images[-1]))  # where the last image begins
        if last:
            yield pa.concat_tables([*held, rows.slice(0, last)])
            held = []
        held.append(rows.slice(last))
    if held:
        yield pa.concat_tables(held)


def _order(confidence: float | None) -> tuple:
    """Falls with the confidence, as Spark orders it: NaN first, null last."""
    return (1, 0.0) if confidence is None else (-1, 0.0) if confidence != confidence else (0, -confidence)


def _scored(thresholds: tuple[float, ...], kept: list[str]):
    """``kept`` and ``bits`` of every prediction, from its candidates or a row without one.

    A candidate whose prediction and label have no other is free at every threshold that it reaches; the others are
    taken in order, image by image. Copies of a prediction differ by their ``mark`` and share their bits.
    """
    levels = sorted(thresholds)
    ordered = sorted(range(len(thresholds)), key=thresholds.__getitem__)
    reached = np.array([sum(1 << k for k in ordered[:n]) for n in range(len(levels) + 1)], np.int64)

    def codes(rows: pa.Table, name: str) -> np.ndarray:
        """A number for each image and value."""
        own = rows.column(name).combine_chunks().dictionary_encode()
        own = own.indices.fill_null(len(own.dictionary)).to_numpy().astype(np.int64)
        image = rows.column("image_id").to_numpy()
        image = np.cumsum(np.concatenate([[0], image[1:] != image[:-1]]))
        return np.unique(image * (int(own.max()) + 1) + own, return_inverse=True)[1]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_images(parts):
            p, t = codes(rows, "pred_no"), codes(rows, "annotation_id")
            pair = rows.column("iou").is_valid().to_numpy()
            iou = rows.column("iou").fill_null(-1.0).to_numpy()
            bits = np.where(pair, reached[np.searchsorted(levels, iou, "right")], 0)
            several = pair & ((np.bincount(p, pair)[p] > 1) | (np.bincount(t, pair)[t] > 1))
            of = np.zeros(int(p.max()) + 1, np.int64)
            of[p[pair]] = bits[pair]
            if several.any():
                at = np.flatnonzero(several)
                some = rows.take(at)
                mine, label, free = p[at].tolist(), t[at].tolist(), bits[at].tolist()
                names = ("image_id", "confidence", "pred_no", "iou")
                image, confidence, number, overlap = (some.column(c).to_pylist() for c in names)
                labels = some.column("annotation_id").to_pylist()
                turn = sorted(range(len(at)), key=labels.__getitem__, reverse=True)  # the sort below keeps it among equals
                turn.sort(key=lambda k: (image[k], _order(confidence[k]), number[k], -overlap[k]))
                taken, used = {}, {}
                for k in turn:
                    own = free[k] & ~(taken.get(mine[k], 0) | used.get(label[k], 0))
                    taken[mine[k]] = taken.get(mine[k], 0) | own
                    used[label[k]] = used.get(label[k], 0) | own
                of[list(taken)] = list(taken.values())
            first = np.sort(np.unique(rows.column("mark").to_numpy(), return_index=True)[1])
            out = rows.select(kept).take(first).append_column("bits", pa.array(of[p[first]], pa.int32()))
            yield from out.combine_chunks().to_batches()

    return run


def scored_predictions(predictions: DataFrame, labels: DataFrame, thresholds: tuple[float, ...] = (0.5,), n_tasks: int | None = None) -> DataFrame:
    """Every prediction once, without its corners, with ``bits``: bit k tells whether it has a match at the k-th threshold.

    Matches are those of ``match_bits``. Predictions without a candidate stay in the join, so nothing has to be joined to
    the predictions again; of a task's rows only those that compete in their image are put in order. ``n_tasks`` is that of
    ``match_bits``.
    """
    kept = [c for c in predictions.columns if c not in CORNERS]
    truth = labels.select(F.col("image_id").alias("_image"), "annotation_id", *[F.col(c).alias(f"{c}2") for c in CORNERS])
    marked = predictions.withColumn("confidence", F.col("confidence").cast("double")).withColumn("mark", F.monotonically_increasing_id())
    overlap = F.expr("xmin < xmax2 AND xmin2 < xmax AND ymin < ymax2 AND ymin2 < ymax")
    pairs = marked.join(truth, (F.col("image_id") == F.col("_image")) & overlap & (iou() >= min(thresholds)), "left")
    rows = pairs.select("image_id", *[c for c in kept if c != "image_id"], "mark", "annotation_id", F.when(F.col("_image").isNotNull(), iou()).alias("iou"))
    schema = T.StructType([marked.schema[c] for c in kept]).add("bits", T.IntegerType())
    dealt = rows.repartition(n_tasks, "image_id") if n_tasks else rows.repartition("image_id")
    return dealt.sortWithinPartitions("image_id").mapInArrow(_scored(thresholds, kept), schema)


def with_bits(predictions: DataFrame, found: DataFrame, n_tasks: int | None = None) -> DataFrame:
    """Every prediction with the ``bits`` of its matches in ``found``; ``n_tasks`` is the number of partitions, else the session's."""
    own = predictions.withColumn("bits", F.lit(0)).withColumn("_own", F.lit(True))
    both = own.unionByName(found.select("image_id", "pred_no", "bits"), allowMissingColumns=True)
    dealt = both.repartition(n_tasks, "image_id") if n_tasks else both.repartition("image_id")
    w = Window.partitionBy("image_id", "pred_no")
    return dealt.withColumn("bits", F.bit_or("bits").over(w)).where("_own").drop("_own")


RANKS, RANGE_ROWS = 1 << 16, 1 << 20  # ranks of a piece, rows that a task puts in order


def _cut(by: list[str], schema: pa.Schema, n: int, size: int):
    """Pieces of rows in order: no more than ``size`` ranks of one group and one level, their bits side by side."""
    kind = "<u2" if n <= 16 else "<u4"

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, key, head, held, length = TaskContext.get().partitionId() << 32, None, {}, [], 0

        def piece() -> pa.RecordBatch:
            bits = np.concatenate(held)
            values = {**head, "id": number, "n": length, "found": [int(np.count_nonzero(bits & (1 << k))) for k in range(n)], "data": bits.astype(kind).tobytes()}
            return pa.RecordBatch.from_pylist([values], schema)

        for part in parts:
            if not part.num_rows:
                continue
            coded = [part.column(c).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False) for c in [*by, "level"]]
            new = np.zeros(part.num_rows - 1, bool)
            for c in coded:
                new |= c[1:] != c[:-1]
            starts, bits = [0, *(np.flatnonzero(new) + 1).tolist()], part.column("bits").to_numpy()
            for start, end in zip(starts, [*starts[1:], part.num_rows], strict=True):
                own = tuple(part.column(c)[start].as_py() for c in [*by, "level"])
                while start < end:
                    if held and (own != key or length == size):
                        yield piece()
                        number, held, length = number + 1, [], 0
                    if not held:
                        key, head = own, {c: part.column(c)[start].as_py() for c in [*by, "level", "confidence", "tie"]}
                    more = min(end - start, size - length)
                    held.append(bits[start : start + more])
                    start, length = start + more, length + more
        if held:
            yield piece()

    return run


def ranked_pieces(scored: DataFrame, n: int, *by: str, floors: tuple[float, ...]) -> DataFrame:
    """Scored predictions by falling confidence, ties in the order of an MD5 of the id, as pieces of up to ``RANKS`` rows.

    A piece has the number of its rows, those ``found`` at each threshold, and their bits as ``data``; ``level`` is the
    number of floors that its rows reach, ``base_n`` and ``base`` are the rows and hits of its group before it. Rows are written
    once and put in order by ranges of (group, confidence, MD5), so neither a group nor a confidence has to fit into a task.
    """
    spark = scored.sparkSession
    tie = F.unhex(F.md5(F.concat_ws(":", "image_id", "pred_no")))
    level = sum((F.when(F.col("confidence") >= x, 1).otherwise(0) for x in floors), F.lit(0))
    rows = scored.where("confidence IS NOT NULL").select(*by, F.col("confidence").cast("double").alias("confidence"), tie.alias("tie"), level.alias("level"), "bits")
    rows = _held(rows)  # the bounds of the ranges are drawn from them
    n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    order = [*by, F.desc("confidence"), "tie"]
    schema = T.StructType([rows.schema[c] for c in [*by, "level", "confidence", "tie"]])
    schema = schema.add("id", T.LongType()).add("n", T.LongType()).add("found", T.ArrayType(T.LongType())).add("data", T.BinaryType())
    cut = _cut(list(by), to_arrow_schema(schema), n, RANKS)
    pieces = _held(rows.repartitionByRange(n_ranges, *order).sortWithinPartitions(*order).mapInArrow(cut, schema))
    before = Window.partitionBy(*by).orderBy(F.desc("confidence"), "tie", "id").rowsBetween(Window.unboundedPreceding, -1)
    base = F.array(*[F.coalesce(F.sum(F.col("found")[k]).over(before), F.lit(0)) for k in range(n)])
    sums = pieces.drop("data").select("id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base_n"), base.alias("base"))
    return pieces.join(sums, "id")


def _precisions(row: dict) -> Iterator[np.ndarray]:
    """For each threshold the precisions at the true positives of a piece."""
    n = len(row["base"])
    bits = np.frombuffer(row["data"], "<u2" if n <= 16 else "<u4")
    for k in range(n):
        at = np.flatnonzero(bits & (1 << k))
        yield (row["base"][k] + np.arange(1, len(at) + 1)) / (row["base_n"] + 1 + at)


def _best(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best precision of each piece at each threshold, 0 without a true positive."""
    for part in parts:
        best = [[float(x.max(initial=0.0)) for x in _precisions(r)] for r in part.to_pylist()]
        yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(best, pa.list_(pa.float64()))], ["id", "best"])


def _areas(by: list[str]):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = part.to_pylist()
            areas = [[float(np.maximum(np.maximum.accumulate(x[::-1]), y).sum()) for x, y in zip(_precisions(r), r["later"], strict=True)] for r in rows]
            names = [*by, "floor", "found"]
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.array(areas, pa.list_(pa.float64()))], [*names, "area"])

    return run


def precision_envelope(pieces: DataFrame, n: int, *by: str, floors: tuple[float, ...]) -> DataFrame:
    """For each group, piece and confidence floor that it reaches: ``found`` and ``area``, the sums of the precision envelope, by threshold.

    The envelope at a true positive is the best precision from there on; precisions beyond the floor do not count. A floor
    keeps a piece whole or drops it, so only the maxima of pieces are put in order floor by floor.
    """
    best = pieces.select("id", "base_n", "base", "data").mapInArrow(_best, "id long, best array<double>")
    least = F.array(*[F.lit(float(x)) for x in sorted(floors)])
    each = pieces.select(*by, "id", "confidence", "tie", F.explode(F.slice(least, F.lit(1), F.col("level"))).alias("floor")).join(best, "id")
    after = Window.partitionBy(*by, "floor").orderBy("confidence", F.desc("tie"), F.desc("id")).rowsBetween(Window.unboundedPreceding, -1)
    later = F.array(*[F.coalesce(F.max(F.col("best")[k]).over(after), F.lit(0.0)) for k in range(n)])
    rows = pieces.select(*by, "id", "found", "base_n", "base", "data").join(each.select("id", "floor", later.alias("later")), "id")
    schema = T.StructType([rows.schema[c] for c in [*by, "floor", "found"]]).add("area", T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(_areas(list(by)), schema)


def _each(thresholds: tuple[float, ...]) -> Column:
    return F.explode(F.array(*[F.lit(float(x)) for x in thresholds])).alias("threshold")


def average_precision(
    predictions: DataFrame, labels: DataFrame, found: DataFrame, *by: str,
    thresholds: tuple[float, ...] = THRESHOLDS, floors: tuple[float, ...] | None = None, n_tasks: int | None = None,
) -> DataFrame:
    """``scored_average_precision`` of predictions whose ``match_bits`` at these thresholds are ``found``."""
    return scored_average_precision(with_bits(predictions, found, n_tasks), labels, *by, thresholds=thresholds, floors=floors)


def scored_average_precision(
    scored: DataFrame, labels: DataFrame, *by: str, thresholds: tuple[float, ...] = THRESHOLDS, floors: tuple[float, ...] | None = None
) -> DataFrame:
    """All-point AP for each group and threshold: null without labels, 0 without predictions.

    AP is the sum over true positives of the best precision from there on, over the number of labels.
    ``scored`` are the ``scored_predictions`` at these thresholds. With ``floors`` there is a row for each of them, as
    ``confidence``: only predictions of that confidence or more count. As predictions are matched by falling
    confidence, those that a floor leaves are ranked and matched as without it.
    """
    every, least = range(len(thresholds)), floors or (float("-inf"),)
    pieces = ranked_pieces(scored, len(thresholds), *by, floors=least)
    of = [F.struct(F.lit(float(thresholds[k])).alias("threshold"), F.sum(F.col("area")[k]).alias("area"), F.sum(F.col("found")[k]).alias("n_tp")) for k in every]
    sums = precision_envelope(pieces, len(thresholds), *by, floors=least).groupBy(*by, "floor").agg(F.array(*of).alias("x"))
    sums = sums.select(*by, "floor", F.explode("x").alias("x")).select(*by, "floor", "x.*")
    total = labels.groupBy(*by).agg(F.count(F.lit(1)).alias("n_labels"))
    total = total.select("*", _each(thresholds)).select("*", F.explode(F.array(*[F.lit(float(x)) for x in least])).alias("floor"))
    out = total.join(sums, ["threshold", "floor", *by], "left").select(
        "threshold", F.col("floor").alias("confidence"), *by, "n_labels", F.coalesce("n_tp", F.lit(0)).alias("n_tp"), (F.coalesce("area", F.lit(0.0)) / F.col("n_labels")).alias("ap")
    )
    return out if floors else out.drop("confidence")


def map50_95(ap: DataFrame, *by: str) -> DataFrame:
    return ap.groupBy(*by).agg(F.avg("ap").alias("map"), F.max(F.when(F.col("threshold") == 0.5, F.col("ap"))).alias("ap50"))


def recall_by(
    labels: DataFrame, matches: DataFrame, *by: str, thresholds: tuple[float, ...] = (0.5,), floors: tuple[float, ...] | None = None
) -> DataFrame:
    """Share of labels that are matched, by threshold and columns of the labels; with ``floors`` by predictions of that ``confidence`` or more."""
    hits = matches.select("threshold", "image_id", "annotation_id", F.col("confidence").alias("hit"))
    out = labels.select("*", _each(thresholds)).join(hits, ["threshold", "image_id", "annotation_id"], "left")
    least = floors or (float("-inf"),)
    found = F.array(*[F.struct(F.lit(float(x)).alias("confidence"), F.count_if(F.col("hit") >= x).alias("n_found")) for x in least])
    out = out.groupBy("threshold", *by).agg(F.count(F.lit(1)).alias("n_labels"), found.alias("x"))
    out = out.select("threshold", *by, "n_labels", F.explode("x").alias("x")).select("threshold", *by, "n_labels", "x.*").withColumn("recall", F.col("n_found") / F.col("n_labels"))
    return out if floors else out.drop("confidence")


def image_diagnostics(predictions: DataFrame, labels: DataFrame, matches: DataFrame, n_tasks: int | None = None) -> DataFrame:
    """True positives, false negatives and false positives of each image at one threshold; ``n_tasks`` is that of ``match_bits``."""
    p = predictions.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_predictions"))
    n = labels.groupBy("image_id").agg(F.count(F.lit(1)).alias("n_labels"))
    m = (matches.repartition(n_tasks, "image_id") if n_tasks else matches).groupBy("image_id").agg(F.count(F.lit(1)).alias("tp"))
    out = n.join(p, "image_id", "full_outer").join(m, "image_id", "left").na.fill(0, ["n_predictions", "n_labels", "tp"])
    return out.select("image_id", "tp", (F.col("n_labels") - F.col("tp")).alias("fn"), (F.col("n_predictions") - F.col("tp")).alias("fp"))


def top_k_images(diagnostics: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` worst and the ``k`` best images by misses, false alarms, hits and id."""
    worst = diagnostics.orderBy(F.desc("fn"), F.desc("fp"), "tp", "image_id").limit(k).withColumn("kind", F.lit("WORST"))
    best = diagnostics.orderBy("fn", "fp", F.desc("tp"), "image_id").limit(k).withColumn("kind", F.lit("BEST"))
    return worst.unionByName(best)


def condition_rows(rows: DataFrame) -> DataFrame:
    """Rows of sequences with scene attributes, once for each of DAY, NIGHT and RAIN that applies."""
    kinds = F.array_compact(F.array(
        F.when(F.col("lighting") == "DAY", "DAY"), F.when(F.col("lighting") == "NIGHT", "NIGHT"), F.when(F.col("weather").contains("RAIN"), "RAIN")
    ))
    return rows.withColumn("condition", F.explode(kinds))


def condition_metrics(ap: DataFrame, images: DataFrame, least_images: int = 30, least_boxes: int = 100) -> DataFrame:
    """AP by condition where there is enough of it, else null with a status."""
    n = images.groupBy("condition").agg(F.count(F.lit(1)).alias("n_images"))
    out = ap.join(n, "condition")
    enough = (F.col("n_images") >= least_images) & (F.col("n_labels") >= least_boxes)
    return out.select("condition", "n_images", "n_labels", F.when(enough, F.col("ap")).alias("ap"), F.when(enough, "MEASURED").otherwise("NOT_MEASURED_TOO_SMALL").alias("status"))


def condition_overlap(rows: DataFrame) -> DataFrame:
    """Images under rain at night, and their share of the rain and of the night images."""
    night, rain = F.col("lighting") == "NIGHT", F.col("weather").contains("RAIN")
    out = rows.agg(F.count_if(night).alias("n_night"), F.count_if(rain).alias("n_rain"), F.count_if(night & rain).alias("n_both"))
    return out.selectExpr("*", "try_divide(n_both, n_night) AS share_of_night", "try_divide(n_both, n_rain) AS share_of_rain")


def prediction_counts(predictions: DataFrame, regions: DataFrame) -> DataFrame:
    """Raw, ignored (centre in a region) and eligible predictions by dataset."""
    from boxloom.operators.boxes import split_by_regions

    rows = split_by_regions(predictions, regions)
    return rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("n_raw"), F.count_if("ignored").alias("n_ignored"), F.count_if(~F.col("ignored")).alias("n_eligible"))
