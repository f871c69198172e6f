"""Shapes of plans that decide how the operators behave on large tables."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from catalog import adapters
from catalog.queries import ORACLES, QUERIES
from tests.helpers import record, records, table
from tidings.operators import activity, agreement, editions, quality, sightings
from tidings.sources import feeds, history, raw


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("plans"))
    rows = [record(f"s{i}", topic=f"T{i % 3}", run_date=f"2026-09-{i % 9 + 1:02d}") for i in range(60)]
    heads = table(spark, rows)
    history.export_table(heads, folder, "headlines")
    sentiment = heads.select(
        "headline_id", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("model"), F.lit("neutral").alias("label"),
        F.lit(0.0).alias("score"), F.col("first_seen_at").alias("scored_at")).distinct()
    history.export_table(sentiment, folder, "sentiment")
    return history.load_history(spark, folder)


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_no_loops_or_products_on_large_sides(tables, no_broadcast):
    good, sentiment = quality.good_headlines(tables["headlines"]), tables["sentiment"]
    frames = [
        good, activity.daily_activity(good), activity.history_overview(good), editions.edition(good),
        agreement.paired_scores(good, sentiment, "a", "b"), sightings.upsert(tables["headlines"], tables["headlines"]),
        activity.daily_sentiment(good, sentiment, "2026-09-01", "2026-09-05"),
    ]
    for frame in frames:
        text = plan(frame)
        assert "NestedLoop" not in text and "Cartesian" not in text
        assert "BroadcastHashJoin" not in text  # nothing is broadcast regardless of its size


def test_top_k_limits_rows_before_the_shuffle(tables):
    text = plan(editions.edition(tables["headlines"], "2026-09-09"))
    assert text.count("WindowGroupLimit") == 2


def test_filters_and_columns_reach_the_scan(tables):
    text = plan(activity.daily_counts(tables["headlines"], "2026-09-02", "2026-09-04"))
    assert "GreaterThanOrEqual(first_run_date,2026-09-02)" in text
    assert "ReadSchema: struct<topic:string,first_run_date:date>" in text
    pending = plan(sightings.seen_again(tables["headlines"], tables["headlines"]))
    assert "ReadSchema: struct<headline_id:string,topic:string>" in pending


def test_pairing_reads_each_models_scores_only(tables):
    text = plan(agreement.paired_scores(tables["headlines"], tables["sentiment"], "a", "b"))
    assert text.count("EqualTo(model,a)") == 1 and text.count("EqualTo(model,b)") == 1
    assert "SortAggregate" not in text


def test_activity_reads_the_history_once(tables):
    assert plan(activity.history_overview(tables["headlines"])).count("FileScan") == 1
    assert plan(activity.daily_activity(tables["headlines"])).count("FileScan") == 1


def test_every_query_has_its_comparison():
    assert set(ORACLES) == set(QUERIES) and len(QUERIES) > 80


def test_a_day_is_read_from_its_own_folders(spark, tmp_path):
    folder = str(tmp_path / "raw")
    for day in ("2026-09-12", "2026-09-13", "2026-09-14"):
        raw.write_partitions(spark, folder, records(spark, [record("a", run_date=day), record("b", topic="Tesla", run_date=day)]))
    day = raw.read_partition(spark, folder, "2026-09-13")
    assert day.inputFiles() and all("/landing=2/date=2026-09-13/" in f for f in day.inputFiles())
    assert "Exchange" not in plan(day) and day.count() == 2


def test_items_are_parsed_once(spark):
    """A filter on what becomes of the items must not be copied into the parser's place."""
    documents = spark.createDataFrame([], "run_date date, topic string, collected_at timestamp_ntz, content string")
    kept, _ = feeds.parse_feed(documents)
    optimized = kept._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_xml(") == 2  # as it is, and repaired


def test_history_keys_are_worked_out_once(spark, tmp_path, monkeypatch):
    rows = [(i, datetime(2024, 1, 1 + i % 9, 5), i % 7, ["view", "purchase"][i % 2], 1.0, f'{{"k": {i % 13}}}') for i in range(80)]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    sf, made, calls = str(tmp_path), adapters.raw_records, []
    wanted = [adapters.fresh_headlines(spark, sf), adapters.fresh_sentiment(spark, sf)]
    monkeypatch.setattr(adapters, "raw_records", lambda *given: calls.append(1) or made(*given))
    stored = history.load_history(spark, adapters.stored_history(spark, sf))
    assert len(calls) == 1
    for name, frame in zip(("headlines", "sentiment"), wanted):
        assert stored[name].count() == frame.count() and not stored[name].exceptAll(frame.select(*stored[name].columns)).count()
