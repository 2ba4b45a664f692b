"""Queries against their SQL on tables with keys and times beyond those of the given ones."""

import collections
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from boxloom.operators import evaluate
from boxloom.plans import catalog, files  # noqa: F401  (files adds its queries to the catalog's)
from boxloom.sources import adapters, label_files

GIVEN = "/root/testdata/sf0.001"


def same(spark, folder, name, *tables):
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for t in tables:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    got = catalog.QUERIES[name](spark, str(folder))
    columns = ", ".join(f'"{c}"' for c in got.columns)
    want = db.execute(f"SELECT {columns} FROM ({catalog.SQL[name]})").fetchall()
    assert want and collections.Counter(map(tuple, got.collect())) == collections.Counter(want)


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return tmp_path_factory.mktemp("larger")


def test_frame_numbers_of_more_than_five_digits(spark, folder):
    spark.range(99_990, 100_040).selectExpr("id AS page_id", "'' AS url", "'' AS html").write.parquet(str(folder / "pages.parquet"))
    same(spark, folder, "text_functions", "pages")


@pytest.fixture(scope="module")
def seasons(spark, folder):
    """Tracks of 1,100 hours, over 45 days, that stand and move by turns; one batch in the middle has two points."""
    hours = spark.range(1100).where("id < 500 OR id >= 700 OR id = 600").crossJoin(spark.range(6, 9).withColumnRenamed("id", "user_id")).where("id <> 600 OR user_id < 8")
    rows = hours.selectExpr(
        "1100 * user_id + id AS event_id", "CAST(timestamp_seconds(1704067200 + 3600 * id + 5) AS TIMESTAMP_NTZ) AS ts", "user_id", "'view' AS event_type",
        "CAST(if(id div 70 % 2 = 0, 70 * (id div 70), id) * 7 * user_id AS DOUBLE) AS value", "'{\"k\": 5}' AS props",
    )
    rows.write.parquet(str(folder / "events.parquet"))
    return folder


@pytest.mark.parametrize("name", ["stop_alert_stream", "late_points"])
def test_streams_of_any_length(spark, seasons, name):
    same(spark, seasons, name, "events")


@pytest.fixture(scope="module")
def odd_events(spark, tmp_path_factory):
    """Users of negative, huge and no numbers, at hours before and after the first frame."""
    folder = tmp_path_factory.mktemp("odd")
    users = spark.createDataFrame([(-19,), (-7,), (-1,), (4,), (2**59,), (None,)], "user_id long").withColumn("u", F.coalesce(F.col("user_id") % 1000, F.lit(5)))
    rows = spark.range(700).crossJoin(users).where("(17 * id + u) % 5 > 0 AND (u <> -7 OR id < 400) AND (user_id IS NOT NULL OR id % 2 = 0)").selectExpr(
        "700 * (u + 1000) + id AS event_id", "CAST(timestamp_seconds(1704067200 + 3600 * (id - 350) + 5) AS TIMESTAMP_NTZ) AS ts", "user_id", "'view' AS event_type",
        "CAST(if(id div 70 % 2 = 0, 70 * (id div 70), id) * 7 * (1 + abs(u) % 3) AS DOUBLE) AS value", "'{\"k\": 5}' AS props",
    )
    rows.write.parquet(str(folder / "events.parquet"))
    return folder


def test_stop_alerts_of_odd_tracks(spark, odd_events):
    same(spark, odd_events, "stop_alert_stream", "events")


def n_batches(stream):
    query = stream.writeStream.format("noop").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return sum(p.numInputRows > 0 for p in query.recentProgress)


def test_long_streams_take_several_cuts_in_a_batch(spark, seasons, monkeypatch):
    monkeypatch.setattr(files, "_BATCHES", 4)
    points = files._timed(spark, str(seasons))
    assert n_batches(files._stream(spark, points, F.expr("frame_id div 120"), exact=True)) == 10
    assert n_batches(files._stream(spark, points, F.expr("frame_id div 120"))) == 4
    same(spark, seasons, "stop_alert_stream", "events")


def test_tasks_grow_in_number_with_the_boxes(spark, monkeypatch):
    """Joins, windows, matches and merges are dealt to as many tasks as the table asks for, with the same rows."""
    names = ("export_boxes", "duplicate_box_rows", "track_consistency", "image_diagnostics", "merge_chunk_reports", "release_round_trip", "coco_round_trip")
    few = {n: collections.Counter(map(tuple, catalog.QUERIES[n](spark, GIVEN).collect())) for n in names}
    monkeypatch.setattr(adapters, "TASK_ROWS", 300)
    n = adapters.n_tasks(spark, GIVEN)
    assert n == 20 and adapters.boxes_raw(spark, GIVEN).rdd.getNumPartitions() == n
    assert catalog.QUERIES["export_boxes"](spark, GIVEN).rdd.getNumPartitions() == n
    for name in names:
        assert collections.Counter(map(tuple, catalog.QUERIES[name](spark, GIVEN).collect())) == few[name]


def test_label_files_in_archives(spark, tmp_path, monkeypatch):
    rows = [("train" if k % 5 else "val", f"i{k}", f"0 0.5 0.5 0.1 0.{k}\n0 0.1 0.1 0.1 0.1" if k % 3 else "") for k in range(3000)]
    labels = spark.createDataFrame(rows, "split string, image_id string, label_text string").repartition(3)
    path = str(tmp_path / "labels")
    label_files.write_label_files(labels, path, archives=True)
    found = [p for p in tmp_path.rglob("*") if p.is_file() and p.suffix != ".crc"]
    assert {p.suffix for p in found} == {".zip"} and {p.parent.name for p in found} == {"train", "val"} and len(found) <= 6
    got = sorted((r.split, r.image_id, r.label_line or "") for r in label_files.read_label_files(spark, path, archives=True).collect())
    assert got == sorted((s, i, line) for s, i, t in rows for line in t.split("\n"))
    with pytest.raises(Exception, match="not a file name"):
        label_files.write_label_files(labels.limit(5).withColumn("image_id", F.concat(F.lit("../"), "image_id")), str(tmp_path / "unsafe"), archives=True)
    assert not (tmp_path / "unsafe").exists() and not list(tmp_path.glob("*.staging*"))


def test_counts_of_images_keep_the_number_of_tasks(spark, monkeypatch):
    """The join of counts and matches is not dealt to the session's number again."""
    monkeypatch.setattr(adapters, "TASK_ROWS", 300)
    matches, seen = evaluate.match_predictions, []
    monkeypatch.setattr(evaluate, "match_predictions", lambda *a: seen.append(a[2]) or matches(*a))
    plan = catalog.QUERIES["image_diagnostics"](spark, GIVEN)._jdf.queryExecution().optimizedPlan().toString()
    assert seen == [20] and plan.count("RepartitionByExpression [image_id") >= 2  # of the candidates and of their matches
    assert re.search(r"Aggregate \[image_id#\d+L?\], [^\n]*AS tp#[^\n]*\n[^\n]*RepartitionByExpression \[image_id#\d+L?\], 20", plan)


@pytest.mark.parametrize("name", ["release_qc", "box_count_mismatch"])
def test_exclusions_leave_the_number_of_tasks(spark, monkeypatch, name):
    """Boxes are dealt by image after the join with the exclusions, which may deal them by track."""
    want = collections.Counter(map(tuple, catalog.QUERIES[name](spark, GIVEN).collect()))
    monkeypatch.setattr(adapters, "TASK_ROWS", 300)
    got = catalog.QUERIES[name](spark, GIVEN)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"RepartitionByExpression \[image_id#\d+L?\], 20(?:(?!RepartitionByExpression).)*Join LeftOuter, \(\(sequence_id", plan, re.DOTALL)
    assert collections.Counter(map(tuple, got.collect())) == want


def shuffled_in(spark, name):
    """Numbers of partitions of the hashed exchanges that run, merged ones among them."""
    rows = catalog.QUERIES[name](spark, GIVEN)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan, {int(n) for n in re.findall(r"Exchange hashpartitioning\([^)]*, (\d+)\), REPARTITION_BY_NUM", plan)}


@pytest.mark.parametrize("name", ["duplicate_box_rows", "track_consistency"])
def test_tasks_are_not_merged_where_the_session_has_many(spark, monkeypatch, name):
    """Of 50 partitions Spark would merge most; tables that ask for more than a task a core are dealt by their size."""
    monkeypatch.setattr(adapters, "TASK_ROWS", 300)
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        plan, numbers = shuffled_in(spark, name)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert numbers == {20}, plan


def test_coco_boxes_are_dealt_by_image_alone(spark, monkeypatch):
    """However large the documents: boxes of a category do not meet in a task, those of an image in one of 20."""
    want = collections.Counter(map(tuple, catalog.QUERIES["coco_round_trip"](spark, GIVEN).collect()))
    monkeypatch.setattr(adapters, "TASK_ROWS", 300)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = catalog.QUERIES["coco_round_trip"](spark, GIVEN)
        assert collections.Counter(map(tuple, rows.collect())) == want
        plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert not re.search(r"hashpartitioning\(category_id#\d+L, \d+\)", plan)
    assert re.findall(r"hashpartitioning\(image_id#\d+L, (\d+)\)", plan) == ["20", "20"]


def test_boxes_are_dealt_as_few_columns(spark, monkeypatch):
    """Names of images and sequences are put together after lines and orders are dealt, classes before; each is dealt once for the join."""
    monkeypatch.setattr(adapters, "TASK_ROWS", 300)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "50")
    try:
        rows = catalog.QUERIES["track_consistency"](spark, GIVEN)
        dealt = re.findall(r"RepartitionByExpression \[(\w+)#[^\n]*\], 20\n[ :+-]*Project \[([^\n]*)\]", rows._jdf.queryExecution().optimizedPlan().toString())
        plan, numbers = shuffled_in(spark, "track_consistency")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    names = {by: re.sub(r"#\d+L?|concat\(.*\) AS ", "", found) for by, found in dealt}
    assert names.pop("dataset") and names == {"o_orderkey": "o_orderkey, o_custkey", "l_orderkey": "l_orderkey, l_suppkey, original_class"}
    assert numbers == {20} and plan.count("Exchange hashpartitioning(") == 3, plan


def test_lines_and_orders_are_dealt_to_few_tasks(spark, monkeypatch):
    """Tasks that read files deal straight into files; tracks are dealt by table size after the join."""
    want = collections.Counter(map(tuple, catalog.QUERIES["track_consistency"](spark, GIVEN).collect()))
    monkeypatch.setattr(adapters, "TASK_ROWS", 300)
    monkeypatch.setattr(adapters, "STRAIGHT", 6)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = catalog.QUERIES["track_consistency"](spark, GIVEN)
        assert collections.Counter(map(tuple, rows.collect())) == want
        plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    found = dict(re.findall(r"Exchange hashpartitioning\((\w+)#[^)]*, (\d+)\), REPARTITION_BY_NUM", plan))
    assert found == {"l_orderkey": "6", "o_orderkey": "6", "dataset": "20"}, plan
