"""The log through its life: runs and their commits, snapshots, retention."""

from __future__ import annotations

import datetime as dt
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tests.test_scoring import MODELS, TEXTS, WORDS
from vigil import schemas
from vigil.operators import log as L
from vigil.plans import lifecycle, pipeline
from vigil.sources.config import literal_table

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 5, 1)


def small_run(spark, ids=(1, 2, 3, 4)):
    """Two projects: 'good' stories by words above 0.5; every story."""
    stories = spark.createDataFrame([(i, f"https://x.org/{i}", "good" if i % 2 else "bad", TEXTS[i], "en", START) for i in ids],
                                    "story_id long, url string, title string, story_text string, language string, indexed_date timestamp")
    projects = literal_table(spark, [(p, f"p{p}", None, None, None, None, None, m, 1) for p, m in ((1, 0.6), (2, 0.0))], schemas.PROJECT)
    terms = literal_table(spark, [(1, 1, False, "term", "good"), (2, 1, False, "wildcard", "*")], schemas.PROJECT_TERMS)
    weights = literal_table(spark, [(1, 1, t, idf, w) for t, idf, w in WORDS], schemas.MODEL_TERMS)
    return pipeline.run(stories, projects, terms, literal_table(spark, MODELS[:1], schemas.MODEL), weights, START)


def test_a_run_commits_once_and_whole(spark, tmp_path):
    path = str(tmp_path / "log")
    assert lifecycle.run_state(spark, path).count() == 0
    result = small_run(spark)
    broken = replace(result, model_terms=result.model_terms.withColumn("weight", F.raise_error(F.lit("killed")).cast("double")))
    with pytest.raises(Exception, match="killed"):
        lifecycle.commit_run(spark, broken, path, "a", START, START + DAY, START + 2 * DAY)
    assert (tmp_path / "log" / "run=a" / "inserts").exists()           # left behind, but not to be seen
    assert lifecycle.committed_runs(spark, path) == [] and lifecycle.run_state(spark, path).count() == 0
    lifecycle.commit_run(spark, result, path, "a", START, START + DAY, START + 2 * DAY)
    state = {(r.project_id, r.url[-1]): r for r in lifecycle.run_state(spark, path).collect()}
    assert set(state) == {(1, "1"), (1, "3"), (2, "1"), (2, "2"), (2, "3"), (2, "4")}
    top, none, low = state[1, "1"], state[2, "3"], state[2, "4"]
    assert top.above_threshold and top.posted_date == START + 2 * DAY and top.processed_date == START + DAY and top.model_score > 0.6
    assert none.model_score is None and none.processed_date is None and not none.above_threshold       # no text
    assert low.posted_date == START + 2 * DAY and low.queued_date == START and low.model_id == 1
    lifecycle.commit_run(spark, small_run(spark, ids=(1,)), path, "a", START, START, START)            # committed already
    assert lifecycle.run_state(spark, path).count() == 6
    lifecycle.commit_run(spark, small_run(spark, ids=(1, 2)), path, "b", START + 5 * DAY, START + 6 * DAY)
    again = {(r.project_id, r.url[-1]): r for r in lifecycle.run_state(spark, path).collect()}
    assert len(again) == 6 and again[1, "1"].queued_date == START and again[1, "1"].processed_date == START + 6 * DAY


def random_log(spark, seed=3, n=60):
    rng = random.Random(seed)
    inserts = [(f"s{i}", i % 3, START + rng.randint(0, 200) * dt.timedelta(hours=1), None, None, False, None) for i in range(n)]
    events, used = [], set()
    for i, _, queued, *_ in inserts:
        for _ in range(rng.randint(0, 5)):
            t = queued + rng.randint(1, 240) * dt.timedelta(minutes=37)
            if (i, t) in used:
                continue
            used.add((i, t))
            events.append((i, t, *rng.choice([(rng.random(), t, None, None), (None, None, True, None), (None, None, None, t)])))
    a = spark.createDataFrame(inserts, "id string, project_id int, queued_date timestamp, model_score double, processed_date timestamp, "
                              "above_threshold boolean, posted_date timestamp")
    b = spark.createDataFrame(events, "id string, event_time timestamp, model_score double, processed_date timestamp, above_threshold boolean, "
                              "posted_date timestamp")
    return a, b


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_snapshots_fold_to_the_state(spark, tmp_path):
    inserts, events = random_log(spark)
    whole = rows(L.log_state(inserts, events))
    since = None
    for days in (2, 4, 5, 30):
        upto = START + days * DAY
        snapshot = L.compact(spark, str(tmp_path / "snap"), inserts, events, upto, since)
        want = L.log_state(inserts.filter(F.col("queued_date") < F.lit(upto)), events.filter(F.col("event_time") < F.lit(upto)))
        assert rows(L.state_of(snapshot)) == rows(want)
        since = upto
    assert rows(L.state_of(snapshot)) == whole
    L.compact(spark, str(tmp_path / "snap"), inserts, events, since, START)       # a snapshot taken again changes nothing
    assert sorted(p.name for p in (tmp_path / "snap").glob("version=*")) == ["version=2", "version=3"]


def test_late_events_lose_to_later_ones(spark):
    inserts, events = random_log(spark, seed=4)
    parts = [events.filter(F.pmod(F.xxhash64("id", "event_time"), F.lit(3)) == k) for k in range(3)]   # not in the order of time
    snapshot = None
    for k, part in enumerate(parts):
        snapshot = L.fold_state(snapshot, inserts if k == 0 else inserts.limit(0), part)
    assert rows(L.state_of(snapshot)) == rows(L.log_state(inserts, events))
    twice = L.fold_state(snapshot, inserts, events)                               # a replay changes nothing
    assert rows(twice) == rows(snapshot)


def test_retention_deletes_day_folders(spark, tmp_path):
    path = str(tmp_path / "log")
    log = spark.createDataFrame([(i, START + (i % 10) * DAY + dt.timedelta(hours=i)) for i in range(24)] + [(99, None)], "id long, queued_date timestamp")
    L.append_log(log, path)
    as_of = START + 30 * DAY + dt.timedelta(hours=3)
    deleted = {r.day: r.deleted for r in L.delete_old_days(spark, path, 26, as_of).collect()}
    gone = [START + d * DAY for d in range(4)]
    assert deleted == {f"{d:%Y-%m-%d}": sum(START + (i % 10) * DAY == d for i in range(24)) for d in gone}
    left = sorted(p.name for p in (tmp_path / "log").glob("queued_day=*"))
    assert left == sorted([f"queued_day={START + d * DAY:%Y-%m-%d}" for d in range(4, 10)] + ["queued_day=__HIVE_DEFAULT_PARTITION__"])
    kept, _ = L.retain(log, 26, as_of)
    on_disk, _ = L.retain(spark.read.parquet(path), 26, as_of)
    assert rows(on_disk.select("id")) == rows(kept.select("id")) and (99,) in rows(on_disk.select("id"))
    assert L.delete_old_days(spark, path, 26, as_of).collect() == []              # nothing more to delete
