"""Samples, queues and turns against plain restatements of their rules, on random tables."""

import hashlib
import random
from collections import Counter

import pytest

from boxloom.operators import sampling as S
from boxloom.plans import catalog


def greedy(rows, n, caps):
    """One cap after another, passes over the sorted strata, a search from the front each time."""
    strata = {}
    for stratum, sequence, frame, track in rows:
        strata.setdefault(stratum, []).append((sequence, frame, track))
    for own in strata.values():
        own.sort(key=lambda k: hashlib.sha256("|".join(map(str, k)).encode()).hexdigest())
    out, seen, count = [], set(), Counter()
    for cap in caps:
        more = True
        while more and len(out) < n:
            more = False
            for stratum in sorted(strata):
                k = next((k for k in strata[stratum] if k not in seen and count[k[0]] < cap), None)
                if k and len(out) < n:
                    out.append((stratum, *k))
                    seen.add(k)
                    count[k[0]] += 1
                    more = True
    return out


@pytest.mark.parametrize("seed", range(6))
def test_review_queue(spark, seed):
    r = random.Random(seed)
    hot = [("s0", f"q{r.randrange(3)}", r.randrange(40), r.randrange(3)) for _ in range(300)]  # few sequences in a large stratum
    rows = hot + [(f"s{r.randrange(5)}", f"q{r.randrange(12)}", r.randrange(30), r.randrange(2)) for _ in range(r.choice((5, 60, 400)))]
    rows += rows[:20]  # repeated rows; keys may also stand in two strata
    n = r.choice((1, 7, 25, 1000))
    table = spark.createDataFrame(rows, "stratum string, sequence_id string, frame_id int, track_id int").repartition(5)
    got = S.review_queue(table, n, "stratum").orderBy("queue_position").collect()
    assert [(g.stratum, g.sequence_id, g.frame_id, g.track_id) for g in got] == greedy(rows, n, (1, 2, 3, 5))
    assert [g.queue_position for g in got] == list(range(1, len(got) + 1))


def test_review_queue_of_nothing(spark):
    table = spark.createDataFrame([], "stratum string, sequence_id string, frame_id int, track_id int")
    assert S.review_queue(table, 5, "stratum").count() == 0


def test_candidates_of_a_queue_are_enough_and_few(spark):
    """Sequences of two datasets share a name, keys repeat; the queue is that of all rows, and few rows meet the other table."""
    rng = random.Random(6)
    rows = [(f"d{rng.randrange(2)}", f"s{rng.randrange(4)}", rng.randrange(60), rng.randrange(3), rng.choice("xy")) for _ in range(3000)]
    rows = spark.createDataFrame(rows, "dataset string, sequence_id string, frame_id long, track_id long, size string")
    scenes = spark.createDataFrame([(f"d{k}", f"s{n}", "rain" if (n + k) % 3 else "dry") for k in range(2) for n in range(4)], "dataset string, sequence_id string, weather string")
    some = S.queue_candidates(rows, "dataset", "sequence_id", "size")
    queue = [S.review_queue(r.join(scenes, ["dataset", "sequence_id"]), 30, "weather", "size").collect() for r in (rows, some)]
    assert sorted(queue[0]) == sorted(queue[1]) and len(queue[0]) > 15
    keys = some.distinct().groupBy("dataset", "sequence_id", "size").count().collect()
    assert len(keys) == 16 and {r["count"] for r in keys} == {5}
    plan = catalog.QUERIES["review_queue_stratified"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    boxes = plan[plan.rindex("Join Inner, ((dataset"):]  # the join with the scenes
    assert "dense_rank" in boxes
