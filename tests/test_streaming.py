"""Streams over silence, failures, replays and many batches."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vigil.operators import dedupe as D
from vigil.operators.log import append_log
from vigil.streaming import ingest as J

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 3, 1)


def _alerts(spark, tmp_path, stories, ticks, name, threshold=2, steps=1):
    """Runs the alert over files that arrive in ``steps`` lots."""
    log_dir, clock_dir = str(tmp_path / f"{name}-log"), str(tmp_path / f"{name}-clock")
    schema, out = "processed_date timestamp", str(tmp_path / f"{name}-out")
    for k in range(steps):
        last = max(ticks) - START + DAY
        cut = lambda rows: [(t,) for t in rows if (t - START) * steps // last == k]
        spark.createDataFrame(cut(stories), schema).coalesce(1).write.mode("append").parquet(log_dir)
        spark.createDataFrame(cut(ticks), "tick timestamp").coalesce(1).write.mode("append").parquet(clock_dir)
        log = J.read_stream(spark, log_dir, spark.createDataFrame([], schema).schema)
        clock = J.read_stream(spark, clock_dir, spark.createDataFrame([], "tick timestamp").schema)
        alerts = J.volume_alert_stream(log, clock, threshold=threshold)
        J.run_available(alerts.writeStream.outputMode("append").format("parquet").option("path", out), str(tmp_path / f"{name}-ck"))
    return {r.window.start: (r.total_stories, r.alert) for r in spark.read.parquet(out).collect()}


@pytest.mark.parametrize("steps", [1, 3])
def test_silent_stretch_alerts(spark, tmp_path, steps):
    # ten stories a day, but none from day 5 to day 11; the clock ticks daily
    stories = [START + d * DAY + dt.timedelta(hours=h) for d in range(20) if not 5 <= d < 12 for h in range(10)]
    ticks = [START + d * DAY for d in range(20)]
    got = _alerts(spark, tmp_path, stories, ticks, f"gap{steps}", steps=steps)
    total = lambda start: sum(start <= t < start + 4 * DAY for t in stories)
    # closed: windows that end a day before the latest time seen
    want = {START + d * DAY: total(START + d * DAY) for d in range(-3, 15)}
    assert {k: v[0] for k, v in got.items()} == want
    assert all(v[1] == (v[0] / 4 < 2) for v in got.values())
    assert got[START + 6 * DAY] == (0, True) and got[START + 5 * DAY] == (0, True)


def test_total_outage_alerts_by_the_clock_alone(spark, tmp_path):
    got = _alerts(spark, tmp_path, [START], [START + d * DAY for d in range(12)], "outage")
    assert [got[START + d * DAY] for d in range(0, 7)] == [(1, True)] + [(0, True)] * 6


def test_clock_and_calendar(spark):
    assert J.clock_stream(spark).isStreaming and J.clock_stream(spark).columns == ["tick"]
    days = J.calendar(spark.createDataFrame([(START + dt.timedelta(hours=5), START + 3 * DAY)], "first timestamp, last timestamp"))
    assert sorted(r.tick for r in days.collect()) == [START + d * DAY for d in range(4)]
    assert J.calendar(spark.createDataFrame([(None, None)], "first timestamp, last timestamp")).collect() == []


def test_versions_survive_a_failing_write(spark, tmp_path):
    path = str(tmp_path / "marks")
    write = J.versioned_table_writer(path, run_id="a")
    with pytest.raises(FileNotFoundError):
        J.read_versioned(spark, path)
    table = lambda n: spark.createDataFrame([(1, n)], "project_id long, latest long")
    write(table(1), 0)
    broken = table(2).withColumn("latest", F.when(F.col("latest") > 0, F.raise_error(F.lit("disk full")).cast("long")))
    with pytest.raises(Exception, match="disk full"):
        write(broken, 1)
    assert J.read_versioned(spark, path).first().latest == 1
    reader = J.read_versioned(spark, path)
    write(table(2), 1)                  # the retry
    assert J.read_versioned(spark, path).first().latest == 2 and reader.first().latest == 1
    write(table(99), 1)                 # a replay after its commit changes nothing
    assert J.read_versioned(spark, path).first().latest == 2
    for n in range(3, 9):
        write(table(n), n)
    J.versioned_table_writer(path, run_id="b")(table(50), 0)      # another run counts from 0
    assert J.read_versioned(spark, path).first().latest == 50
    assert sorted(p.name for p in (tmp_path / "marks").glob("version=*")) == ["version=7", "version=8"]


def test_log_lookup_reads_only_the_batchs_buckets(spark, tmp_path):
    log, schema = str(tmp_path / "log"), "feed_pos long, project_id long, url string, normalized_url string"
    write = J.replay_safe_log_writer(log, "feed_pos", run_id="r", buckets=16)
    for b in range(6):                   # each batch half new, half known
        write(spark.createDataFrame([(100 * b + i, 1, f"u{20 * b + i}", f"u{20 * b + i}") for i in range(40)], schema), b)
    rows = spark.read.parquet(log)
    assert sorted(r.url for r in rows.collect()) == sorted({f"u{i}" for i in range(140)})
    assert rows.select("bucket").distinct().count() == 16
    batch = spark.createDataFrame([(1, 1, "u3", "u3"), (2, 1, "new", "new")], schema)
    seen = J.seen_in_buckets(rows, batch, buckets=16)
    plan = seen._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    touched = {r.b for r in batch.select(J.key_bucket(batch, buckets=16).alias("b")).collect()}
    assert "bucket" in filters and {r.bucket for r in seen.select("bucket").distinct().collect()} <= touched
    assert "u3" in {r.url for r in seen.collect()} and seen.count() < rows.count() / 2


def test_recent_log_reads_only_its_days(spark, tmp_path):
    log = str(tmp_path / "daily")
    as_of = START + 60 * DAY
    rows = [(i % 3, f"u{i}", f"u{i}", START + i * DAY, START + i * DAY if i % 2 else None) for i in range(60)]
    append_log(spark.createDataFrame(rows, "project_id long, url string, normalized_url string, queued_date timestamp, processed_date timestamp"), log)
    stories = spark.createDataFrame([(i % 3, f"u{i}") for i in range(60)], "project_id long, url string").withColumn("normalized_url", F.col("url"))
    held = spark.read.parquet(log)
    kept = D.drop_recently_processed(stories, held, as_of, 14)
    assert sorted(r.url for r in kept.collect()) == sorted(f"u{i}" for i in range(60) if not (i % 2 and i > 46))
    plan = D._recent(held, as_of, 14)._jdf.queryExecution().executedPlan().toString()
    assert "queued_day" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert {r.project_id: r.skipped_dupes for r in D.skipped_counts(stories, held, as_of, 14).collect()} == {0: 2, 1: 2, 2: 3}


@pytest.mark.parametrize("name", ["stream_dedupe_keys", "stream_in_window", "stream_late_rows", "stream_replay_safe_log", "stream_scores"])
def test_streams_read_tables_that_are_folders(spark, tmp_path, name):
    import __spark_entry__ as entry
    whole, parts = tmp_path / "whole", tmp_path / "parts"
    docs = [(i, f"the thing number {i} was word{i % 7}", "en", f"src{i % 3}") for i in range(60)]
    tables = {"documents": spark.createDataFrame(docs, "doc_id long, text string, lang string, source string"),
              "labels": spark.createDataFrame([(i, i % 2, i % 3 % 2) for i in range(0, 60, 2)], "doc_id long, quality int, toxic int"),
              "pages": spark.createDataFrame([(i, f"http://h{i % 5}.example.org/en/{i}") for i in range(40)], "page_id long, url string")}
    for table, df in tables.items():
        df.repartition(3).write.parquet(f"{parts}/{table}.parquet")
        df.toPandas().to_parquet(whole.mkdir(exist_ok=True) or whole / f"{table}.parquet", index=False)
    one, many = (sorted(map(str, entry.queries()[name](spark, str(d)).collect())) for d in (whole, parts))
    assert one and one == many
