"""Order statistics by counted ranges, manifests and moves that refuse, and the rules of the quality audit."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from boxloom.operators import audit as Q
from boxloom.operators import classes as C
from boxloom.operators import metadata as M
from boxloom.operators import ranks as N
from boxloom.operators import sampling as S


@pytest.fixture()
def narrow(monkeypatch):
    """Few cells and no large sorts, so that ranges narrow down over several passes."""
    monkeypatch.setattr(N, "CELLS", 8)
    monkeypatch.setattr(N, "SORTED", 5)


@pytest.mark.parametrize("seed", range(3))
def test_quantiles(spark, narrow, seed):
    r = random.Random(seed)
    draw = [lambda: r.gauss(0, 1), lambda: 10.0 ** r.uniform(-200, 200) * r.choice((-1, 1)), lambda: float(r.choice((1, 2, 2, 2, 7)))]
    rows = [(f"g{g}", draw[g]()) for g in range(3) for _ in range(r.choice((1, 2, 60, 150)))] + [("one", 5.0), ("none", None), ("none", float("nan")), (None, 3.0), (None, 4.0)]
    table = spark.createDataFrame(rows, "g string, v double").repartition(4)
    shares = {"least": 0.0, "p05": 0.05, "middle": 0.5, "p95": 0.95, "most": 1.0}
    got = {x.g: x for x in N.exact_quantiles(table, "v", shares, "g").collect()}
    by = {}
    for g, v in rows:
        if v is not None and v == v:
            by.setdefault(g, []).append(v)
    assert set(got) == set(by)
    for g, values in by.items():
        assert np.allclose([got[g][k] for k in shares], np.quantile(values, list(shares.values())), rtol=1e-12)
    whole = N.exact_quantiles(table, "v", {"middle": 0.5}).first()
    assert np.isclose(whole.middle, np.median([v for own in by.values() for v in own]))


def test_quotas(spark, narrow):
    rows = spark.range(900).select(F.col("id").alias("image_id"), F.expr("if(id % 3 = 0, 'train', 'val')").alias("split"), F.expr("concat('d', id % 2)").alias("dataset"))
    rows = rows.unionByName(rows.where("image_id < 30"))  # equal keys are cut by nothing but their number
    targets = spark.createDataFrame([("train", "d0", 40), ("val", "d0", 1), ("val", "d1", 310), ("train", "d1", 0)], "split string, dataset string, target int")
    got = [(r.split, r.dataset, r.image_id) for r in S.sample_quota(rows, targets, "s").collect()]
    want = []
    for t in targets.collect():
        own = rows.where((F.col("split") == t.split) & (F.col("dataset") == t.dataset)).withColumn("h", S.hash_rank("s", "image_id")).orderBy("h").limit(t.target)
        want += [(t.split, t.dataset, r.image_id) for r in own.collect()]
    assert sorted(got) == sorted(want)
    with pytest.raises(Exception, match="quota"):
        S.sample_quota(rows, targets.withColumn("target", F.lit(400)), "s").collect()


def test_turns(spark):
    r = random.Random(2)
    rows = list({(f"s{r.randrange(3)}", f"q{r.randrange(6)}", r.randrange(50)) for _ in range(200)})
    got = N.turns(spark.createDataFrame(rows, "s string, q string, f int"), "turn", "s", sequence="q", order=("f",)).collect()
    for s in {x[0] for x in rows}:
        assert [(g.q, g.f) for g in sorted((g for g in got if g.s == s), key=lambda g: g.turn)] == sorted((q, f) for t, q, f in rows if t == s)


def test_moves_and_selections_refuse(spark):
    rows = spark.createDataFrame([("d", "a", "train"), ("d", "b", "val")], "dataset string, sequence_id string, split string")
    moves = spark.createDataFrame([("d", "a", "val"), ("d", "b", "val")], "dataset string, sequence_id string, new_split string")
    assert sorted(map(tuple, C.apply_split_moves(rows, moves).collect())) == [("d", "a", "val"), ("d", "b", "val")]
    assert [tuple(r) for r in C.split_moves_log(rows, moves).collect()] == [("d", "a", "train", "val")]
    with pytest.raises(Exception, match="no sequence d:c"):
        C.apply_split_moves(rows, moves.unionByName(moves.limit(1).withColumn("sequence_id", F.lit("c")))).collect()
    files = spark.createDataFrame([("x/a.jpg",), ("y/a.jpg",), ("y/b.jpg",)], "source_file string")
    wanted = spark.createDataFrame([("b.jpg", True), ("x/a.jpg", True), ("gone.jpg", False)], "source_file string, selected boolean")
    assert sorted(r.source_file for r in C.select_by_manifest(files, wanted).collect()) == ["x/a.jpg", "y/b.jpg"]
    more = spark.createDataFrame([("a.jpg", True), ("gone.jpg", True)], "source_file string, selected boolean")
    assert {r.wanted: r.error for r in C.selection_errors(files, wanted.unionByName(more)).collect()} == {"a.jpg": "AMBIGUOUS", "gone.jpg": "MISSING"}
    for k in range(2):
        with pytest.raises(Exception, match=("AMBIGUOUS a.jpg", "MISSING gone.jpg")[k]):
            C.select_by_manifest(files, more.where(F.col("source_file") == ("a.jpg", "gone.jpg")[k])).collect()


def test_audit(spark):
    rules = spark.createDataFrame([("d", "car", "vehicle", True, "EXPORT", False, True), ("d", "dog", "", False, "EXCLUDE", False, False), ("d", "bus", "vehicle", True, "EXPORT", True, False)],
        "dataset string, original_class string, mapped_class string, include boolean, handling string, review_required boolean, has_track_exclusions boolean")
    box = "dataset string, image_id long, annotation_id string, original_class string, source_mapped_class string, xmin double, ymin double, xmax double, ymax double, width int, height int"
    rows = [("d", 1, "a", "car", "vehicle"), ("d", 1, "b", "car", None), ("d", 1, "c", "dog", None), ("d", 2, "d", "bus", "car"), ("d", 2, "e", "tram", "vehicle")]
    rows = [(*r, 1.0, 1.0, 9.0, 9.0, 10, 10) for r in rows] + [("d", 2, "f", "car", "vehicle", -1.0, 1.0, 9.0, 9.0, 10, 10)]
    mapped = C.apply_class_rules(spark.createDataFrame(rows, box), rules.drop("review_required", "has_track_exclusions"))
    assert {r.annotation_id: r.mapping_status for r in mapped.collect()} == {"a": "CONSISTENT", "b": "CORRECTED_TO_CONFIG", "c": "CONSISTENT", "d": "CORRECTED_TO_CONFIG", "e": "UNMAPPED_CLASS", "f": "CONSISTENT"}
    measures = spark.createDataFrame([("d", "OK", 44.0, 100.0), ("d", "OK", 45.0, 59.0), ("d", "OK", 220.5, 60.0), ("d", "OK", 4.0, 0.0), ("d", "OK", 251.0, 70.0)], "dataset string, read_status string, brightness double, sharpness double")
    flags = M.image_suspects(measures)
    assert [[r[f"{k}_suspect"] for k in ("black", "white", "underexposed", "overexposed", "blur")] for r in flags.collect()] == [
        [False, False, True, False, False], [False, False, False, False, True], [False, False, False, True, False], [True, False, True, False, True], [False, True, False, True, False]]
    groups = spark.createDataFrame([("d", "NEAR"), ("d", "BASENAME"), ("clean", "BASENAME")], "dataset string, kind string")
    gate = Q.quality_gate(mapped, flags, groups)
    got = {r.dataset: r for r in gate.collect()}
    d = got["d"]
    assert (d.n_invalid, d.n_issues, d.n_clipped, d.n_corrected, d.n_unmapped, d.n_underexposed, d.n_overexposed, d.n_blurred, d.n_near_groups, d.gate) == (1, 1, 1, 2, 1, 2, 2, 2, 1, "REVIEW_REQUIRED")
    assert got["clean"].gate == "PASS"
    broken = flags.unionByName(spark.createDataFrame([("d", "CORRUPT_OR_UNREADABLE")], "dataset string, read_status string"), allowMissingColumns=True)
    assert {r.gate for r in Q.quality_gate(mapped, broken, groups).where("dataset = 'd'").collect()} == {"BLOCKED"}
    labels = Q.label_consistency(mapped, rules)
    at = {r.original_class: r for r in labels.collect()}
    assert (at["car"].mapping_status, at["car"].configured_include, at["car"].source_mapped_values, at["car"].n_corrected) == ("DATA_LEAD_APPROVED_WITH_TRACK_EXCLUSION", "TRUE_WITH_TRACK_EXCLUSION", "EMPTY|vehicle", 1)
    assert {k: r.mapping_status for k, r in at.items() if k != "car"} == {"dog": "APPROVED", "bus": "DEFINED_PENDING_DATA_LEAD_APPROVAL", "tram": "UNMAPPED_CLASS_REVIEW_REQUIRED"}
    queue = Q.quality_review_queue(gate, labels).orderBy("queue_id").collect()
    assert [(r.queue_id, r.issue_category, r.issue_count) for r in queue] == [
        (f"QREV_{k:04d}", c, n) for k, (c, n) in enumerate((("INVALID_ANNOTATION", 1), ("BOUNDARY_BBOX_CLIPPED", 1), ("NEAR_DUPLICATE", 1), ("BLUR_SUSPECT", 2), ("UNDEREXPOSED_SUSPECT", 2), ("OVEREXPOSED_SUSPECT", 2), ("CLASS_MAPPING_CORRECTED", 2), ("CLASS_POLICY_PENDING", 2)), 1)]
