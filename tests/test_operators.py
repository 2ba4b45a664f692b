"""Operators on literal boxes, splits, duplicates, samples, scores and tracks."""

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from boxloom.functions import text as T
from boxloom.operators import boxes as B
from boxloom.operators import classes as C
from boxloom.operators import duplicates as D
from boxloom.operators import evaluate as E
from boxloom.operators import release as R
from boxloom.operators import sampling as S
from boxloom.operators import splits as X
from boxloom.operators import tracks as K


@pytest.fixture(scope="module")
def boxes(spark):
    rows = [
        (1, 10.0, 20.0, 110.0, 220.0, 100, 200), (2, 10.0, 10.0, 10.0, 20.0, 100, 100), (3, -5.0, 10.0, 110.0, 95.0, 100, 100),
        (4, 110.0, 10.0, 120.0, 20.0, 100, 100), (5, float("nan"), 1.0, 2.0, 3.0, 100, 100), (6, 1.0, 1.0, 500.0, 3.0, 0, 0),
    ]
    return spark.createDataFrame(rows, "id int, xmin double, ymin double, xmax double, ymax double, width int, height int")


def test_validate(boxes):
    got = {r.id: r.issues for r in B.box_validate(boxes).collect()}
    assert got[1] == ["X_OUT_OF_BOUNDS", "Y_OUT_OF_BOUNDS"] and got[2] == ["NON_POSITIVE_SIZE"] and got[5] == ["NAN_OR_INFINITY"] and got[6] == []


def test_clip(boxes):
    got = {r.id: r for r in B.box_clip(boxes).collect()}
    r = got[3]
    assert (r.cx0, r.cy0, r.cx1, r.cy1, r.clip_adjustments) == (0.0, 10.0, 100.0, 95.0, "LEFT_BOUNDARY_CLIPPED|RIGHT_BOUNDARY_CLIPPED")
    assert r.visible and not got[4].visible


def test_letterbox_and_device_groups(spark):
    rows = spark.createDataFrame([(k, 0.0, 0.0, float(w), 50.0, 320, 320) for k, w in enumerate((3, 7, 12, 20))], "id int, xmin double, ymin double, xmax double, ymax double, width int, height int")
    assert [r.lb_category for r in B.letterbox_metrics(rows).orderBy("id").collect()] == ["EXTREMELY_TINY", "VERY_SMALL", "SMALL", "USABLE"]
    rows = spark.createDataFrame([(k, 0.0, 0.0, float(w), float(h), 640, 480) for k, (w, h) in enumerate(((24, 40), (25, 40), (50, 60)))], rows.schema)
    assert [r.size_group for r in B.device_size_group(rows).orderBy("id").collect()] == ["<25", "25–49", "≥50"]


def test_label_line_round_trip(spark):
    row = spark.createDataFrame([(90.0, 20.0, 100.0, 60.0, 100, 100)], "cx0 double, cy0 double, cx1 double, cy1 double, width int, height int")
    line = B.yolo_normalize(row)
    assert line.first().label_line == "0 0.95000000 0.40000000 0.10000000 0.40000000"
    back = B.yolo_denormalize(line).first()
    assert [round(back[c], 6) for c in ("px0", "py0", "px1", "py1")] == [90, 20, 100, 60]
    with pytest.raises(Exception, match="outside"):
        B.yolo_normalize(row.withColumn("cx1", F.lit(500.0))).collect()


def test_geometry_of_the_ground(spark):
    config = {"status": "CALIBRATED", "frame_size_px": (100, 200), "normalized_polygon": [(0.1, 0.2), (0.9, 0.2), (0.8, 0.9), (0.2, 0.9)]}
    assert B.roi_polygon(config) == [(10, 40), (89, 40), (79, 179), (20, 179)]
    with pytest.raises(ValueError):
        B.roi_polygon(config | {"status": "DRAFT"})
    h = B.homography([(0, 0), (100, 0), (100, 200), (0, 200)], [(0, 0), (10, 0), (10, 10), (0, 10)])
    gx, gy = B.ground_project(F.lit(50.0), F.lit(100.0), h)
    x, y, r = spark.range(1).select(gx, gy, B.ground_range(gx, gy, (5.0, -7.0))).first()
    assert (round(x, 6), round(y, 6), round(r, 6)) == (5, 5, 12)
    square = [(0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0)]
    points = spark.createDataFrame([(5.0, 5.0), (10.0, 5.0), (0.0, 0.0), (11.0, 5.0), (5.0, 10.0)], "x double, y double")
    assert [r[0] for r in points.select(B.point_in_polygon(F.col("x"), F.col("y"), square)).collect()] == [True, True, True, False, True]


def test_regions(spark):
    rows = spark.createDataFrame([("a", 1.0, 1.0, 5.0, 5.0), ("a", 40.0, 10.0, 60.0, 30.0), ("b", 1.0, 1.0, 5.0, 5.0)], "sequence_id string, xmin double, ymin double, xmax double, ymax double")
    regions = spark.createDataFrame([("a", 0.0, 0.0, 20.0, 20.0)], "sequence_id string, left double, top double, right double, bottom double")
    assert sorted((r.sequence_id, r.xmin, r.ignored) for r in B.split_by_regions(rows, regions).collect()) == [("a", 1.0, True), ("a", 40.0, False), ("b", 1.0, False)]


def test_splits(spark):
    keys = spark.range(1000).select(F.concat(F.lit("seq_"), "id").alias("k"))
    n = {r.s: r["count"] for r in keys.select(X.hash_split(F.col("k")).alias("s")).groupBy("s").count().collect()}
    assert 750 <= n["train"] <= 850 and n["validation"] >= 70 and n["cross_test"] >= 70
    rows = spark.createDataFrame([("d", "a", "train"), ("d", "a", "validation"), ("d", "b", "train")], "dataset string, sequence_id string, split string")
    assert [tuple(r) for r in X.sequence_leakage(rows).collect()] == [("d", "a", "train|validation")]
    with pytest.raises(Exception, match="no split"):
        C.join_split(spark.createDataFrame([("d", "zz")], "dataset string, sequence_id string"), rows.limit(1)).collect()


def test_manifests_and_pairs(spark):
    a = spark.createDataFrame([("x", "1"), ("y", "1"), ("z", None)], "relative_path string, checksum string")
    b = spark.createDataFrame([("x", "1"), ("y", "2"), ("w", "1"), ("z", None)], "relative_path string, checksum string")
    assert {r.relative_path: r.state for r in C.manifest_diff(a, b).collect()} == {"x": "MATCH", "y": "MODIFIED", "w": "UNEXPECTED", "z": "MATCH"}
    assert {(r.relative_path, r.issue) for r in C.pair_check(a, b, ["relative_path"]).collect()} == {("w", "MISSING_IMAGE")}
    files = spark.createDataFrame([("A/b/one.jpg",), ("c/two.jpg",), ("d/two.jpg",)], "source_file string")
    manifest = spark.createDataFrame([("./b/one.jpg", True), ("two.jpg", True), ("c\\two.jpg", False)], "source_file string, selected boolean")
    got = {(r.source_file, r.wanted, r.n_matches) for r in C.select_by_manifest(files, manifest, strict=False).select(files.source_file, "wanted", "n_matches").collect()}
    assert got == {("A/b/one.jpg", "b/one.jpg", 1), ("c/two.jpg", "two.jpg", 2), ("d/two.jpg", "two.jpg", 2)}


def test_near_hash_pairs(spark):
    rng = random.Random(1)
    values = [rng.getrandbits(63) for _ in range(30)]
    values += [v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for v in values]
    values = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    want = {(min(a, b), max(a, b)) for a in values for b in values if a != b and bin((a ^ b) & (2**64 - 1)).count("1") <= 3}
    got = D.near_hash_pairs(spark.createDataFrame([(v,) for v in values], "phash long"), 3).collect()
    assert {(r.a, r.b) for r in got} == want


def test_samples(spark):
    rows = spark.range(500).select(F.col("id").alias("image_id"), (F.col("id") % 7).alias("sequence_id"), F.lit("d").alias("dataset"), F.col("id").alias("frame_id"), F.lit("train").alias("split"))
    a = {r.image_id for r in S.sample_fixed(rows, 40, "s", "image_id").collect()}
    assert len(a) == 40 and a == {r.image_id for r in S.sample_fixed(rows.repartition(5).orderBy(F.desc("image_id")), 40, "s", "image_id").collect()}
    cover = S.sample_cover(rows, 20, "s").collect()
    assert len(cover) == 20 and {r.sequence_id for r in cover if r.picked == "FIRST_FRAME"} == set(range(7))
    quota = spark.createDataFrame([("train", "d", 30)], "split string, dataset string, target int")
    assert S.sample_quota(rows, quota, "s").count() == 30
    with pytest.raises(Exception, match="quota"):
        S.sample_quota(rows, quota.withColumn("target", F.lit(501)), "s").collect()
    picked, report = S.subset_plan(rows, spark.createDataFrame([("d", 15), ("e", 3)], "dataset string, target int"))
    assert sorted(r.image_id for r in picked.collect()) == sorted([*range(14), 14]) and {r.dataset: r.shortfall for r in report.collect()} == {"d": 0, "e": 3}


def test_scoring(spark):
    box = "dataset string, image_id long, xmin double, ymin double, xmax double, ymax double"
    labels = spark.createDataFrame([("d", 1, 0.0, 0.0, 20.0, 20.0, "a")], box + ", annotation_id string")
    predictions = spark.createDataFrame([("d", 1, 100.0, 100.0, 120.0, 120.0, 0.95, "p1"), ("d", 1, 0.0, 0.0, 20.0, 20.0, 0.9, "p2")], box + ", confidence double, pred_no string")
    pairs = E.iou_candidates(predictions, labels)
    assert [r.iou for r in pairs.collect()] == [1.0]
    matches = E.match_predictions(pairs, E.THRESHOLDS)
    ap = E.average_precision(predictions, labels, E.match_bits(pairs, E.THRESHOLDS), "dataset")
    assert {r.ap for r in ap.collect()} == {0.5} and E.map50_95(ap, "dataset").first().map == 0.5
    one = matches.where("threshold = 0.5")
    d = E.image_diagnostics(predictions, labels, one).first()
    assert (d.tp, d.fn, d.fp) == (1, 0, 1) and E.recall_by(labels, one, "dataset").first().recall == 1.0


def test_average_precision_against_brute_force(spark, monkeypatch):
    """Many images, equal confidences, several ranges of ranks; ties in the order of the id's MD5."""
    monkeypatch.setattr(E, "RANKS", 16)
    rng = random.Random(4)
    labels, predictions = [], []
    for image in range(60):
        for k in range(rng.randrange(5)):
            x, y = rng.randrange(60), rng.randrange(60)
            labels.append(("d", image, float(x), float(y), x + 20.0, y + 20.0, f"a{k}"))
            for j in range(rng.randrange(4)):
                dx, dy = rng.randrange(-8, 9), rng.randrange(-4, 5)
                predictions.append(("d", image, x + dx, float(y + dy), x + dx + 20.0, y + dy + 20.0, rng.randrange(12) / 10, f"p{k}{j}"))
    predictions = [(*p[:2], float(p[2]), *p[3:]) for p in predictions]

    def iou(p, t):
        w, h = min(p[4], t[4]) - max(p[2], t[2]), min(p[5], t[5]) - max(p[3], t[3])
        return w * h / ((p[4] - p[2]) * (p[5] - p[3]) + (t[4] - t[2]) * (t[5] - t[3]) - w * h) if w > 0 and h > 0 else 0.0

    def brute(threshold, floor=0.0):
        hit, used = {}, set()
        seen = [p for p in predictions if p[6] >= floor]
        for p in sorted(seen, key=lambda p: (p[1], -p[6], p[7])):
            free = [(iou(p, t), t[6]) for t in labels if t[1] == p[1] and (t[1], t[6]) not in used and iou(p, t) >= threshold and iou(p, t) > 0]
            if free:
                used.add((p[1], max(free)[1]))
                hit[p[1], p[7]] = True
        order = sorted(seen, key=lambda p: (-p[6], hashlib.md5(f"{p[1]}:{p[7]}".encode()).hexdigest()))
        tps, precision, n = [], [], 0
        for i, p in enumerate(order, 1):
            n += (p[1], p[7]) in hit
            precision.append(n / i)
            tps.append((p[1], p[7]) in hit)
        return sum(max(precision[i:]) for i, tp in enumerate(tps) if tp) / len(labels), sum(tps)

    box = "dataset string, image_id long, xmin double, ymin double, xmax double, ymax double"
    t = spark.createDataFrame(labels, box + ", annotation_id string")
    p = spark.createDataFrame(predictions, box + ", confidence double, pred_no string")
    found = E.match_bits(E.iou_candidates(p, t), E.THRESHOLDS)
    got = E.average_precision(p, t, found, "dataset").collect()
    assert len(got) == 10 and all(abs(r.ap - brute(r.threshold)[0]) < 1e-12 for r in got)
    floors = (0.0, 0.3, 0.35, 0.8, 1.5)
    got = E.average_precision(p, t, found, "dataset", floors=floors).collect()
    assert len(got) == 50 and {r.confidence for r in got} == set(floors)
    for r in got:
        ap, n_tp = brute(r.threshold, r.confidence)
        assert abs(r.ap - ap) < 1e-12 and r.n_tp == n_tp
    recall = E.recall_by(t, E.match_predictions(E.iou_candidates(p, t)), "dataset", floors=floors).collect()
    assert {r.confidence: r.n_found for r in recall} == {x: brute(0.5, x)[1] for x in floors}


def test_scored_predictions_are_the_matches(spark):
    """Copies, images over several batches, ties, confidences that are NaN or null, and predictions without a label; each is matched once for all."""
    rng = random.Random(11)
    labels, predictions = [], []
    for image in range(40):
        for k in range(rng.randrange(1, 7)):
            x = float(rng.randrange(30))
            labels.append(("d", image, x, 0.0, x + 20, 20.0, f"a{k}"))
            for j in range(rng.randrange(4)):
                at = x + rng.randrange(-9, 10) + (500 if rng.random() < 0.2 else 0)
                confidence = rng.choice([0.1, 0.1, 0.5, 0.9, None, float("nan")])
                predictions += [("d", image, at, 0.0, at + 20, 20.0, confidence, f"p{k}{j}")] * rng.choice([1, 1, 2])
    box = "dataset string, image_id long, xmin double, ymin double, xmax double, ymax double"
    t = spark.createDataFrame(labels, box + ", annotation_id string")
    p = spark.createDataFrame(predictions, box + ", confidence double, pred_no string").repartition(3)
    found = E.match_bits(E.iou_candidates(p, t), E.THRESHOLDS)
    want = collections.Counter(map(str, E.with_bits(p, found).select("dataset", "image_id", "confidence", "pred_no", "bits").collect()))
    assert sum(want.values()) == len(predictions) and len({k.split("bits=")[1] for k in want}) > 4
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for n in (None, 5):
            scored = E.scored_predictions(p, t, E.THRESHOLDS, n)
            assert collections.Counter(map(str, scored.select("dataset", "image_id", "confidence", "pred_no", "bits").collect())) == want
        one = E.scored_average_precision(scored, t, "dataset", floors=(0.0, 0.5))
        two = E.average_precision(p, t, found, "dataset", floors=(0.0, 0.5))
        assert sorted(one.collect()) == sorted(two.collect()) and one.count() == 20
        for ap in (one, two):  # written pieces are scanned, predictions are not ranked or matched again
            assert "pred_no" not in ap._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)


def test_near_hashes_of_distance_8(spark):
    rng = random.Random(9)
    values = [rng.getrandbits(64) for _ in range(25)]
    for v in list(values):
        for n in (1, 7, 8, 9):
            values.append(v ^ sum(1 << b for b in rng.sample(range(64), n)))
    values = [v - (1 << 64) if v >= 1 << 63 else v for v in values]
    want = {(min(a, b), max(a, b)) for a in values for b in values if a != b and bin((a ^ b) & (2**64 - 1)).count("1") <= 8}
    got = D.near_hash_pairs(spark.createDataFrame([(v,) for v in values], "phash long"), 8).collect()
    assert {(r.a, r.b) for r in got} == want and len(got) == len(want)


def test_split_audit_states(spark):
    rows = [("a", "s1", "train"), ("a", "s2", "validation"), ("b", "s1", "cross_test"), ("c", "s1", "train")]
    assigned = spark.createDataFrame([(*r, "SEQUENCE_ID", r[0] != "c") for r in rows], "dataset string, sequence_id string, split string, split_unit string, evaluation_eligible boolean")
    scenes = assigned.select("dataset", "sequence_id", F.lit("URBAN").alias("road_type"), F.lit("DAY").alias("lighting"))
    files = assigned.select("dataset", "sequence_id", F.lit("f1").alias("source_file"))
    fixed = spark.createDataFrame([("b", "s1"), ("b", "s9")], "dataset string, sequence_id string")
    policy = X.SplitPolicy(test_road_types=("URBAN", "RURAL"), test_lightings=("DAY",), train_only=("c",), main_test_locked=True)
    got = {r.check_name: (r.n_offenders, r.status) for r in X.split_audit(assigned, scenes, files, fixed, policy).collect()}
    assert got["file_in_one_split"] == (1, "FAIL") and got["test_datasets"] == (1, "FAIL") and got["validation_datasets"] == (1, "PARTIAL")
    assert got["test_road_types"] == (1, "PARTIAL") and got["test_lightings"] == (0, "PASS") and got["train_only_datasets"] == (0, "PASS")
    assert got["fixed_test_members"] == (1, "FAIL") and got["main_test_collected"] == (1, "PENDING") and got["main_test_locked"] == (0, "PASS")
    assert got["split_unit_is_sequence"] == (0, "PASS") and len(got) == 14


def test_stop_rules_are_validated():
    for wrong in ({"stop_speed": 3.0, "resume_speed": 3.0}, {"stop_speed": 0.0}, {"stop_seconds": 0.0}, {"resume_seconds": -1.0}, {"fps": 0.0}):
        with pytest.raises(ValueError):
            K.StopRules(**wrong)


def test_motion_in_two_directions(spark):
    """Motion across the image is motion: a track with a constant x that moves in y raises no alert."""
    rules = K.StopRules(fps=10.0)
    rows = [("c", 1, i + 1, 5.0, i * 0.5) for i in range(100)] + [("c", 2, i + 1, 3.0, 4.0) for i in range(100)]
    events = K.stop_alert_batch(spark.createDataFrame(rows, "sequence_id string, track_id long, frame_id long, x double, y double"), rules).collect()
    assert [(e.track_id, e.range_m_at_alert, e.speed_kmh_at_alert) for e in events] == [(2, 5.0, 0.0)]


def test_chunk_merge(spark):
    chunk = "image_id long, n_boxes int, annotation_status string"
    a = spark.createDataFrame([(1, 2, "AUTO"), (2, 0, "NONE")], chunk)
    b = spark.createDataFrame([(3, 1, "AUTO")], chunk)
    images = spark.createDataFrame([(1,), (2,), (3,)], "image_id long")
    labels = spark.createDataFrame([(1, 2), (2, 0), (3, 1)], "image_id long, n_lines long")
    tasks = spark.createDataFrame([(1, "AUTO", 2, 7, "x"), (3, None, None, 0, "y"), (9, "OLD", 5, 1, "z")], "image_id long, auto_annotation_status string, auto_box_count long, version int, own string")
    reports, after = R.merge_chunk_reports([a, b], images, labels, tasks)
    want = [(1, "AUTO", 2, 7, "x"), (3, "AUTO", 1, 1, "y"), (9, "OLD", 5, 1, "z")]
    assert reports.count() == 3 and sorted(map(tuple, after.collect())) == want
    assert sorted(map(tuple, R.merge_chunk_reports([a, b], images, labels, after)[1].collect())) == want
    assert R.batch_summary(reports).first()[:3] == (3, 3, 1)
    for chunks, i, t, error in (
        ([a, b, b], images, labels, "DUPLICATE_REPORT"), ([a], images, labels, "MISSING_REPORT"), ([a, b], images.where("image_id < 3"), labels, "EXTRA_REPORT"),
        ([a, b], images, labels.where("image_id > 1"), "MISSING_LABEL"), ([a, b], images, labels.withColumn("n_lines", F.lit(1)), "2 COUNT_MISMATCH"),
    ):
        with pytest.raises(ValueError, match=error):
            R.merge_chunk_reports(chunks, i, t, tasks)


def test_release(spark, tmp_path):
    rows = spark.createDataFrame(
        [("d", 1, "s", "a1", 1, "car", -5.0, 5.0, 50.0, 30.0), ("d", 1, "s", "a2", 1, "car", 0.0, 5.0, 50.0, 30.0), ("d", 1, "s", "a3", 79, "car", 1.0, 1.0, 4.0, 4.0), ("d", 1, "s", "a4", 2, "dog", 1.0, 1.0, 4.0, 4.0), ("d", 1, "s", "a5", 2, "crowd", 1.0, 1.0, 4.0, 4.0), ("d", 1, "s", "a6", 2, "car", 150.0, 1.0, 160.0, 4.0)],
        "dataset string, image_id long, sequence_id string, annotation_id string, track_id long, original_class string, xmin double, ymin double, xmax double, ymax double",
    ).withColumn("width", F.lit(100)).withColumn("height", F.lit(50))
    rules = spark.createDataFrame([("d", "car", "vehicle", True, "EXPORT"), ("d", "crowd", "other", False, "IGNORE_REGION")], "dataset string, original_class string, mapped_class string, include boolean, handling string")
    out = R.export_boxes(rows, rules, spark.createDataFrame([("s", 79)], "sequence_id string, track_id long"))
    assert {r.annotation_id: r.reason for r in out.collect()} == {"a1": None, "a2": "DUPLICATE_BOX", "a3": "TRACK_EXCLUDED", "a4": "UNMAPPED_CLASS", "a5": "IGNORE_REGION", "a6": "NOT_VISIBLE_AFTER_CLIP"}
    assert R.reconcile(out).first().reconciled
    images = spark.createDataFrame([("d", 1), ("d", 2)], "dataset string, image_id long")
    files = R.label_files(images, out)
    assert {r.image_id: r.n_lines for r in files.collect()} == {1: 1, 2: 0}
    qc = R.release_qc(images, out, files)
    assert {r.status for r in qc.collect()} == {"PASS"}
    R.write_release(files, str(tmp_path / "r"), qc)
    with pytest.raises(Exception, match="(?i)exist"):
        R.write_release(files, str(tmp_path / "r"), qc)
    lines = spark.createDataFrame([(1, "a", "0 0.5 0.5 0.1 0.1"), (1, "b", "0 0.5 0.5 0.1 0.1"), (1, "c", "1 0.5 0.5 0.1 0.1"), (1, "d", "0 x 0.5 0.1 0.1"), (1, "e", "0 0.5"), (1, "f", "0 0.5 0.5 1.1 0.1")], "image_id long, annotation_id string, label_line string")
    assert {r.annotation_id: r.error for r in R.label_line_errors(lines).collect()} == {"a": None, "b": "DUPLICATE_LINE", "c": "CLASS_ID", "d": "NOT_A_NUMBER", "e": "FIELD_COUNT", "f": "OUT_OF_RANGE"}


RULES = K.StopRules(stop_speed=2, resume_speed=3, stop_seconds=3, resume_seconds=1, window=2, max_gap=1, fps=10)


def track(spark, xs, frames=None):
    rows = [("c", 1, f, float(x)) for f, x in zip(frames or range(1, len(xs) + 1), xs, strict=True)]
    return spark.createDataFrame(rows, "sequence_id string, track_id long, frame_id long, x double")


def test_stop_alert_states(spark):
    still, move = [0.0] * 80, [0.3 * k for k in range(1, 60)]
    events = K.stop_alert_batch(track(spark, still + move), RULES).collect()
    assert len(events) == 1 and events[0].end_reason == "MOTION_RESUMED" and events[0].alerted_at_s - events[0].started_at_s >= 3
    events = K.stop_alert_batch(track(spark, still), RULES).collect()
    assert [e.end_reason for e in events] == ["END_OF_REPLAY"]
    frames = [*range(1, 81), *range(200, 205)]
    events = K.stop_alert_batch(track(spark, still + [0.0] * 5, frames), RULES).collect()
    assert [(e.end_reason, e.ended_at_s) for e in events] == [("TRACK_LOST", 7.9)]
    left = track(spark, still).withColumn("inside", F.col("frame_id") < 70)
    assert [e.end_reason for e in K.stop_alert_batch(left, RULES).collect()] == ["LEFT_ROI"]


def test_jitter_gives_one_alert(spark):
    rows = []
    for seed in range(20):
        rng = random.Random(seed)
        rows += [("c", seed, f, rng.uniform(-0.045, 0.045)) for f in range(1, 241)]
    points = spark.createDataFrame(rows, "sequence_id string, track_id long, frame_id long, x double")
    rules = K.StopRules(stop_speed=2, resume_speed=3, fps=30)
    counts = {r.track_id: r["count"] for r in K.stop_alert_batch(points, rules).groupBy("track_id").count().collect()}
    assert sum(counts.get(s) == 1 for s in range(20)) >= 19


def test_segments_and_speed(spark):
    points = track(spark, [0, 1, 2, 3, 10], [1, 2, 3, 4, 30])
    got = [r.segment for r in K.track_segments(points, 1.0, 10).orderBy("frame_id").collect()]
    assert got == [0, 0, 0, 0, 1]
    two = track(spark, [0, 10], [1, 3])
    speeds = [r.speed for r in K.track_speed(K.track_segments(two, 5), 2).orderBy("frame_id").collect()]
    assert speeds == [None, 18.0]


def test_expected_events(spark):
    alerts = spark.createDataFrame([("c", 1, "e1", 5.0), ("c", 1, "e2", 6.0)], "sequence_id string, track_id long, event_id string, alerted_at_s double")
    expected = spark.createDataFrame([("c", 1, "x1", 4.0, 9.0, "APPROVED"), ("c", 1, "x2", 4.5, 9.0, "APPROVED"), ("c", 1, "x3", 0.0, 1.0, "APPROVED"), ("c", 1, "x4", 4.0, 9.0, "DRAFT")], "sequence_id string, track_id long, event_id string, expected_start_s double, expected_end_s double, approval_status string")
    m = K.match_expected_events(expected, alerts)
    assert {r.expected_id: r.event_id for r in m.collect()} == {"x1": "e1", "x2": "e2", "x3": None}
    r = K.alert_metrics(m, alerts, 2.0).first()
    assert (r.n_missed, r.false_alerts_per_hour, r.mean_latency_s) == (1, 0.0, 1.25)
    assert K.alert_metrics(m.limit(0), alerts, 2.0).first().status.startswith("NOT_MEASURED")


def test_text_functions(spark):
    rows = spark.createDataFrame([("a/MVI_1/img00012.jpg",), ("p/q_f7.png",), ("solo.jpg",)], "p string")
    got = rows.select(T.safe_sequence(F.col("p")), T.frame_number(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("MVI_1", 12), ("p", 7), ("solo", None)]
