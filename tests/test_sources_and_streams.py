"""Readers and writers on small files, pixel functions, and streams against the batch operators."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.functions import images as I
from boxloom.operators import duplicates
from boxloom.operators import tracks as K
from boxloom.sources import digests, label_files, readers, writers
from boxloom.streaming import alerts


def test_box_csv(spark, tmp_path):
    (tmp_path / "b.csv").write_text("m1,car,-5,5,50,30\nm1,dog,1,1\nm2,car,a,1,2,3\n\n")
    good, bad = readers.read_box_csv(spark, str(tmp_path / "b.csv"))
    assert [(r.image, r.xmin, r.ymax) for r in good.collect()] == [("m1", -5.0, 30.0)]
    assert sorted(r.issue for r in bad.collect()) == ["MALFORMED_ROW", "NON_NUMERIC_BBOX"]


def test_table_csv(spark, tmp_path):
    assert readers.read_table_csv(spark, str(tmp_path / "none.csv"), "a string, b string").count() == 0
    rows = spark.createDataFrame([(True, float("nan"), "x"), (False, 1.5, None)], "a boolean, b double, c string")
    assert [tuple(r) for r in writers.as_csv_fields(rows, ["c", "a", "b", "zz"]).collect()] == [("x", "TRUE", "", ""), ("", "FALSE", "1.5", "")]
    writers.write_table_csv(rows, str(tmp_path / "out"), ["c", "a", "b"])
    assert readers.read_table_csv(spark, str(tmp_path / "out"), "c string, a string, b string").count() == 2
    writers.write_summary_json(rows.limit(1), str(tmp_path / "json"))
    assert '"c":"x"' in spark.read.text(str(tmp_path / "json")).first().value


def test_coco(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"images":[{"id":1,"file_name":"a","width":10,"height":20}],"categories":[{"id":3,"name":"car"}],"annotations":[{"id":1,"image_id":1,"category_id":3,"bbox":[1,2,3,4]},{"id":2,"image_id":9,"category_id":4,"bbox":[1,2]}]}')
    images, boxes = readers.read_coco(spark, str(tmp_path / "c.json"))
    got = {r.annotation_id: r for r in boxes.collect()}
    assert images.count() == 1 and (got[1].xmax, got[1].ymax, got[1].original_class, got[1].issue) == (4, 6, "car", None)
    assert got[2].original_class == "UNKNOWN_CATEGORY_4" and got[2].issue.startswith("MALFORMED")


def test_track_xml(spark, tmp_path):
    (tmp_path / "t.xml").write_text('<sequence name="MVI_1"><sequence_attribute camera_state="stable" sence_weather="sunny"/><ignored_region><box left="1" top="2" width="3" height="4"/></ignored_region><frame num="1"><target_list><target id="7"><box left="10" top="20" width="5" height="6"/><attribute vehicle_type="car" truncation_ratio="0.1"/></target><target id="8"><attribute vehicle_type="car"/></target></target_list></frame></sequence>')
    boxes, sequences, regions = readers.read_track_xml(spark, str(tmp_path / "t.xml"))
    got = {r.track_id: r for r in boxes.collect()}
    assert (got[7].xmax, got[7].ymax, got[7].issue) == (15, 26, None) and got[8].issue == "MISSING_BOX"
    assert sequences.first().weather == "sunny" and regions.first().right == 4


def test_label_files_and_assets(spark, tmp_path):
    (tmp_path / "train").mkdir()
    (tmp_path / "train" / "i1.txt").write_text("0 0.5 0.5 0.1 0.1\n\n1 2 3\n")
    rows = readers.read_yolo_labels(spark, str(tmp_path / "train")).collect()
    assert {(r.split, r.image_id, r.n_parts) for r in rows} == {("train", "i1", 5), ("train", "i1", 3)}


def test_written_label_files(spark, tmp_path):
    rows = [("train", f"i{k}", "0 0.5 0.5 0.1 0.1\n0 0.1 0.1 0.1 0.1" if k % 3 else "") for k in range(2000)] + [("val", "i5", "0 0.2 0.2 0.1 0.1"), ("val", "j", None)]
    labels = spark.createDataFrame(rows, "split string, image_id string, label_text string").repartition(3)
    path = str(tmp_path / "labels")
    label_files.write_label_files(labels, path)
    assert (tmp_path / "labels" / "train" / "i1.txt").read_text() == rows[1][2] + "\n" and (tmp_path / "labels" / "val" / "j.txt").read_text() == "\n"
    got = sorted((r.split, r.image_id, r.label_line or "") for r in label_files.read_label_files(spark, path).collect())
    assert got == sorted((s, i, line) for s, i, t in rows for line in (t or "").split("\n"))
    assert len(list(tmp_path.rglob("*"))) == len(rows) + 3  # no folder an image, nothing staged is left
    with pytest.raises(ValueError, match="exists"):
        label_files.write_label_files(labels, path)
    with pytest.raises(ValueError, match="two rows"):
        label_files.write_label_files(labels.unionByName(labels), str(tmp_path / "twice"))
    with pytest.raises(Exception, match="not a file name"):
        label_files.write_label_files(labels.limit(5).withColumn("image_id", F.concat(F.lit("../"), "image_id")), str(tmp_path / "unsafe"))
    assert not (tmp_path / "unsafe").exists() and not list(tmp_path.glob("*.staging*"))
    (tmp_path / "labels" / "extra.txt").write_text("x")
    (tmp_path / "labels" / "train" / "deep").mkdir()
    (tmp_path / "labels" / "train" / "deep" / "k.txt").write_text("x")
    (tmp_path / "labels" / "train" / "k.jpg").write_text("x")
    assets = {r.relative_path: (r.split, r.image_id, r.issue, r["first"]) for r in label_files.list_assets(spark, path, (".txt",)).collect()}
    assert len(assets) == len(rows) + 3
    assert {p for p, x in assets.items() if x[2] == "UNEXPECTED_PATH"} == {"extra.txt", "train/deep/k.txt", "train/k.jpg"}
    assert assets["train/i5.txt"] == ("train", "i5", "DUPLICATE_ID", True) and assets["val/i5.txt"][2:] == ("DUPLICATE_ID", False) and assets["train/i1.txt"][2:] == (None, True)


def test_digests_of_files(spark, tmp_path):
    data = {"a.bin": b"x" * 1000, "b c.bin": random.Random(1).randbytes(300_000), "c.bin": b"y" * 4096}
    for name, content in data.items():
        (tmp_path / name).write_bytes(content)
    want = {n: (len(b), hashlib.sha256(b).hexdigest()) for n, b in data.items()}
    got = digests.sha256_files(spark, str(tmp_path), block_bytes=4096).collect()
    assert {r.path.rsplit("/", 1)[1].replace("%20", " "): (r.size_bytes, r.sha256) for r in got} == want
    paths = spark.createDataFrame([(1, str(tmp_path / "a.bin")), (2, str(tmp_path / "gone")), (3, None)], "id int, path string")
    assert {r.id: r.sha256 for r in digests.with_sha256(paths, 7).collect()} == {1: want["a.bin"][1], 2: None, 3: None}


def test_copies_across_splits_open_candidates_only(spark, tmp_path):
    """Files that checksum and size set apart are not opened: here they are not there."""
    for name, content in (("a", b"same"), ("b", b"same"), ("c", b"clash"), ("d", b"other")):
        (tmp_path / name).write_bytes(content)
    at = [(str(tmp_path / n), s, c, z) for n, s, c, z in (("a", "train", 1, 4), ("b", "val", 1, 4), ("c", "train", 2, 5), ("d", "val", 2, 5), ("gone", "train", 3, 9), ("gone2", "train", 3, 9), ("gone3", None, 1, 4))]
    files = spark.createDataFrame(at, "path string, split string, crc long, size_bytes long")
    assert {r.path.rsplit("/", 1)[1] for r in duplicates.content_candidates(files).collect()} == {"a", "b", "c", "d"}
    assert [(r.n_files, r.splits, r.sha256) for r in duplicates.exact_content_cross_split(files).collect()] == [(2, "train|val", hashlib.sha256(b"same").hexdigest())]


def test_pixels(spark):
    rng = np.random.default_rng(0)
    smooth = np.repeat(np.add.outer(np.arange(48), np.arange(64))[..., None], 3, axis=2).astype(np.uint8)
    noisy = np.clip(smooth + rng.integers(-2, 3, smooth.shape), 0, 255).astype(np.uint8)
    rows = [(48, 64, 3, bytearray(smooth.tobytes())), (48, 64, 3, bytearray(noisy.tobytes())), (-1, -1, -1, bytearray())]
    table = spark.createDataFrame(rows, "height int, width int, nChannels int, data binary")
    got = [r.m for r in table.select(I.image_measures()("height", "width", "nChannels", "data").alias("m")).collect()]
    assert bin((got[0].ahash ^ got[1].ahash) & (2**64 - 1)).count("1") <= 4 and got[0].sharpness < got[1].sharpness
    assert got[2].brightness is None and got[2].ahash is None
    alone = table.limit(1).select(I.image_measures()("height", "width", "nChannels", "data").alias("m")).first().m
    assert (alone.ahash, alone.phash) == (got[0].ahash, got[0].phash)  # the same to the last bit beside an unreadable image
    region = F.array(F.struct(F.lit(0.0).alias("left"), F.lit(0.0).alias("top"), F.lit(64.0).alias("right"), F.lit(24.0).alias("bottom")))
    masked = table.limit(1).select(I.mask_regions()("height", "width", "nChannels", "data", region).alias("x")).first().x
    a = np.frombuffer(bytes(masked), np.uint8).reshape(48, 64, 3)
    assert not a[:24].any() and (a[24:] == smooth[24:]).all()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Three tracks that stop and go on, as files in time order."""
    rng = random.Random(3)
    rows = []
    for t in range(3):
        x = 0.0
        for f in range(1, 301):
            x += 0.0 if 50 < f % 150 < 110 else rng.uniform(0.3, 0.6)
            rows.append(("c", t, f, x))
    table = spark.createDataFrame(rows, "sequence_id string, track_id long, frame_id long, x double")
    table = table.withColumn("ts", F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("frame_id") * 100))
    path = tmp_path_factory.mktemp("points")
    for k in range(3):
        part = table.where((F.col("frame_id") > 100 * k) & (F.col("frame_id") <= 100 * (k + 1)))
        part.coalesce(1).write.mode("append").parquet(str(path))
    return table, str(path)


def run(spark, frame, name, mode="append"):
    q = frame.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name).collect()


def source(spark, stored):
    return spark.readStream.schema(stored[0].schema).option("maxFilesPerTrigger", 1).parquet(stored[1])


def test_stop_alert_stream_equals_batch(spark, stored):
    rules = K.StopRules(fps=10)
    want = sorted(map(tuple, K.stop_alert_batch(stored[0].drop("ts"), rules).where("end_reason <> 'END_OF_REPLAY'").collect()))
    got = sorted(map(tuple, run(spark, alerts.stop_alert_stream(source(spark, stored), rules, "0 seconds"), "stops")))
    assert want and want == got


@pytest.fixture(scope="module")
def jumbled(spark, tmp_path_factory):
    """Tracks with gaps, whose points come up to two seconds after their time, cut into batches of any size."""
    rng = random.Random(5)
    rows = []
    for t in range(6):
        x = 0.0
        for f in range(1, 301):
            x += 0.0 if 50 < f % 150 < 110 else rng.uniform(0.3, 0.6)
            if not (t == 2 and 120 < f < 180):
                rows.append((f"c{t % 2}", t, f, x))
    rows.sort(key=lambda r: 100 * r[2] + rng.uniform(0, 1900))
    cuts = sorted(rng.sample(range(1, len(rows)), 6))
    schema, path, batches = "sequence_id string, track_id long, frame_id long, x double", str(tmp_path_factory.mktemp("jumbled")), []
    for a, b in zip([0, *cuts], [*cuts, len(rows)]):
        batches.append(rows[a:b])
        part = spark.createDataFrame(rows[a:b], schema).withColumn("ts", F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("frame_id") * 100))
        part.coalesce(1).write.mode("append").parquet(path)
    return spark.read.parquet(path), path, batches


def test_stop_alert_stream_at_any_cut(spark, jumbled):
    rules = K.StopRules(fps=10)
    want = sorted(map(tuple, K.stop_alert_batch(jumbled[0].drop("ts"), rules).where("end_reason <> 'END_OF_REPLAY'").collect()))
    got = sorted(map(tuple, run(spark, alerts.stop_alert_stream(source(spark, jumbled), rules, "2 seconds"), "jumbled_stops")))
    assert {r[-1] for r in want} == {"TRACK_LOST", "MOTION_RESUMED"} and got == want


def test_track_away_since_the_gap_before_the_watermark(spark, tmp_path):
    """Track 0 was last seen 1.1 s before the watermark of the batch in which it comes again, and comes in no later one."""
    parts = [[(0, 1, 60), (1, 1, 71)], [(0, 72, 130), (1, 72, 130)], [(1, 131, 200)]]
    schema = "sequence_id string, track_id long, frame_id long, x double"
    for part in parts:
        rows = spark.createDataFrame([("c", t, f, float(t * f)) for t, a, b in part for f in range(a, b + 1)], schema)
        rows.withColumn("ts", F.timestamp_millis(F.lit(1_700_000_000_000) + F.col("frame_id") * 100)).coalesce(1).write.mode("append").parquet(str(tmp_path / "points"))
    rows, rules = spark.read.parquet(str(tmp_path / "points")), K.StopRules(fps=10)
    want = sorted(map(tuple, K.stop_alert_batch(rows.drop("ts"), rules).where("end_reason <> 'END_OF_REPLAY'").collect()))
    got = run(spark, alerts.stop_alert_stream(source(spark, (rows, str(tmp_path / "points"))), rules, "0 seconds"), "away")
    assert [r[-1] for r in want] == ["TRACK_LOST"] * 2 and sorted(map(tuple, got)) == want


@pytest.mark.parametrize("n_keys", [1, 4])
def test_tracks_share_keys(spark, tmp_path, n_keys):
    """Many tracks are held in the state of few keys, with the rows of the batch operator."""
    rows = spark.range(60).crossJoin(spark.range(1, 121).withColumnRenamed("id", "frame_id")).where("id % 7 > 0 OR frame_id < 60")
    rows = rows.selectExpr("concat('c', id % 3) AS sequence_id", "id AS track_id", "frame_id", "CAST(if(frame_id BETWEEN 20 + id % 10 AND 90, 0, frame_id) AS DOUBLE) AS x", "timestamp_millis(1700000000000 + 100 * frame_id) AS ts")
    for k in range(3):
        rows.where(f"(frame_id - 1) div 40 = {k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "points"))
    rules = K.StopRules(fps=10)
    want = sorted(map(tuple, K.stop_alert_batch(rows.drop("ts"), rules).where("end_reason <> 'END_OF_REPLAY'").collect()))
    found = alerts.stop_alert_stream(source(spark, (rows, str(tmp_path / "points"))), rules, "0 seconds", n_keys)
    query = found.writeStream.format("memory").queryName(f"shared{n_keys}").outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert want and sorted(map(tuple, spark.table(f"shared{n_keys}").collect())) == want
    assert max(p.stateOperators[0].numRowsTotal for p in query.recentProgress) <= 4 * n_keys  # two values and a timer with its index


def test_late_points_are_counted_and_left_out(spark, jumbled):
    want, latest = [], None
    for batch in jumbled[2]:
        if latest is not None:
            want += [(*r[:3], 100 * latest - 500 - 100 * r[2]) for r in batch if 100 * r[2] <= 100 * latest - 500]
        latest = max([latest or 0, *(r[2] for r in batch)])
    got = run(spark, alerts.late_points(source(spark, jumbled), "500 milliseconds"), "late")
    assert want and sorted((r.sequence_id, r.track_id, r.frame_id, r.behind_ms) for r in got) == sorted(want)
    rules, late = K.StopRules(fps=10, max_gap=5), {r[1:3] for r in want}
    on_time = spark.createDataFrame([r for batch in jumbled[2] for r in batch if r[1:3] not in late], jumbled[0].drop("ts").schema)
    kept = {tuple(r) for r in K.stop_alert_batch(on_time, rules).where("end_reason = 'MOTION_RESUMED'").collect()}
    stream = run(spark, alerts.stop_alert_stream(source(spark, jumbled), rules, "500 milliseconds"), "stops_without_late")
    assert kept <= {tuple(r) for r in stream}


def test_stream_windows(spark, stored):
    got = run(spark, alerts.alerts_tumbling(source(spark, stored), "1 second", "5 seconds"), "tumbling")
    assert got and all(r.n_rows <= 3 * 50 and r.n_tracks == 3 for r in got)
    again = source(spark, stored).unionByName(source(spark, stored))
    rows = run(spark, alerts.stream_dedup(again, "1 minute"), "once")
    assert len(rows) == stored[0].count()
