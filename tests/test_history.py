import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.helpers import JUNK, NOW, record, records, scores, table, values
from tidings.operators import quality, scoring, sightings
from tidings.sources import directory, history, raw, snapshots


def upsert_all(spark, batches):
    state = table(spark, [])
    for rows in batches:
        state = sightings.upsert(state, table(spark, rows))
    return state


def test_same_story_in_two_runs_is_stored_once(spark, tmp_path):
    folder = str(tmp_path / "history")
    one = [record("Fed holds rates", link="https://n.example.com/ABC?oc=5", run_date="2026-09-13")]
    two = [record("Fed holds", link="https://n.example.com/ABC/?oc=6&utm_source=x")]
    assert values(sightings.upsert_counts(table(spark, []), table(spark, one))) == [(1, 0)]
    history.upsert_months(spark, folder, table(spark, one))

    stored = history.load_history(spark, folder)["headlines"]
    assert values(sightings.upsert_counts(stored, table(spark, two))) == [(0, 1)]
    history.upsert_months(spark, folder, table(spark, two))
    assert values(history.load_history(spark, folder)["headlines"].select(
        "title", "link", F.col("first_run_date").cast("string"), F.col("last_run_date").cast("string")
    )) == [("Fed holds rates", "https://n.example.com/ABC?oc=5", "2026-09-13", "2026-09-14")]


def test_copies_in_one_batch_collapse_to_the_earliest(spark):
    rows = [
        record("Oil", link="https://e.com/1?utm_x=2", collected_at="2026-09-14T10:00:00Z"),
        record("Oil first", link="https://e.com/1", collected_at="2026-09-14T08:00:00Z"),
        record("Oil tie", link="https://e.com/1?oc=3", collected_at="2026-09-14T08:00:00Z"),
    ]
    [row] = table(spark, rows).collect()
    assert (row["title"], str(row["first_seen_at"]), str(row["last_seen_at"])) == (
        "Oil first", "2026-09-14 08:00:00", "2026-09-14 10:00:00")


def test_an_earlier_late_sighting_moves_dates_and_keeps_stored_attributes(spark):
    stored = table(spark, [record("kept", link="https://e.com/1")])
    late = table(spark, [record("other", link="https://e.com/1", run_date="2026-08-30")])
    [row] = sightings.upsert(stored, late).collect()
    assert (row["title"], row["first_run_date"], row["last_run_date"]) == (
        "kept", date(2026, 8, 30), date(2026, 9, 14))


def test_late_load_moves_a_row_to_another_month_and_drops_the_empty_one(spark, tmp_path):
    folder = str(tmp_path / "history")
    history.upsert_months(spark, folder, table(spark, [record("a"), record("b", run_date="2026-07-02")]))
    touched = history.upsert_months(spark, folder, table(spark, [record("a", run_date="2026-08-31")]))
    assert touched == {"2026-08", "2026-09"}
    stored = history.read_table(spark, folder, "headlines")
    assert sorted(values(stored, "title", "month")) == [("a", "2026-08"), ("b", "2026-07")]
    assert "2026-09" not in snapshots.current(spark, f"{folder}/headlines").months()


def test_export_replaces_tables_and_removes_stale_months(spark, tmp_path):
    folder = str(tmp_path / "history")
    assert values(history.table_counts(history.load_history(spark, folder))) == [("headlines", 0), ("sentiment", 0)]
    assert history.count_files(spark, folder) == 0
    both = table(spark, [record("august story", run_date="2026-08-31"), record("september story")])
    history.export_table(both, folder, "headlines")
    history.export_table(both, folder, "headlines")
    assert snapshots.current(spark, f"{folder}/headlines").months() == {"2026-08", "2026-09"}
    assert history.load_history(spark, folder)["headlines"].count() == 2
    history.export_table(table(spark, [record("september story")]), folder, "headlines")
    assert snapshots.current(spark, f"{folder}/headlines").months() == {"2026-09"}


def test_month_filter_reaches_the_folders(spark, tmp_path):
    folder = str(tmp_path / "history")
    rows = [record(f"s{m}", run_date=f"2026-{m:02d}-05") for m in range(1, 9)]
    history.export_table(table(spark, rows), folder, "headlines")
    some = history.within(history.read_table(spark, folder, "headlines"), "2026-03-01", "2026-04-30")
    assert sorted(values(some, "title")) == ["s3", "s4"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "PushedFilters: [IsNotNull(first_run_date)" in plan


def test_a_rewrite_that_stops_midway_leaves_the_old_version_whole(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "history")
    one = [record("a", run_date="2026-08-01"), record("b", run_date="2026-09-02")]
    history.upsert_months(spark, folder, table(spark, one))
    before = sorted(values(history.read_table(spark, folder, "headlines")))
    late = table(spark, [record("b", run_date="2026-07-01"), record("c", run_date="2026-08-05")])

    def stop(*_):
        raise KeyboardInterrupt

    for step in ("commit", "write_snap"):
        with monkeypatch.context() as patched:
            patched.setattr(history, step, stop)
            with pytest.raises(KeyboardInterrupt):
                history.upsert_months(spark, folder, late)
        assert sorted(values(history.read_table(spark, folder, "headlines"))) == before
    for _ in range(2):  # done again, and once more
        history.upsert_months(spark, folder, late)
        stored = history.read_table(spark, folder, "headlines")
        assert sorted(values(stored, "title", "month")) == [("a", "2026-08"), ("b", "2026-07"), ("c", "2026-08")]


def test_a_second_writer_of_a_version_fails(spark, tmp_path):
    root = str(tmp_path / "t")
    seen = snapshots.current(spark, root)
    snapshots.commit(spark, seen, [("2026-01", "x")])
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        snapshots.commit(spark, seen, [("2026-02", "y")])
    assert snapshots.current(spark, root).pairs == (("2026-01", "x"),)


def test_compaction_keeps_rows_and_removes_old_files(spark, tmp_path):
    folder = str(tmp_path / "history")
    for k in range(3):
        history.append_sentiment(spark, folder, spark.createDataFrame(
            [(f"k{k}", "m", "neutral", 0.0)], "headline_id string, model string, label string, score double").withColumn(
            "scored_at", F.lit("2026-09-14 09:00:00").cast("timestamp_ntz")))
    before = sorted(values(history.read_table(spark, folder, "sentiment")))
    assert history.count_files(spark, folder) == 3
    history.compact(spark, folder, "sentiment")
    assert sorted(values(history.read_table(spark, folder, "sentiment"))) == before and history.count_files(spark, folder) == 1
    data = tmp_path / "history" / "sentiment"
    assert [len(list((data / part).iterdir())) for part in ("data", "keys", "manifests")] == [1, 1, 1]
    known = spark.createDataFrame([("k1", "m"), ("k1", "n"), ("k9", "m")], "headline_id string, model string")
    assert sorted(values(history.unscored(spark, folder, known))) == [("k1", "n"), ("k9", "m")]


@pytest.mark.parametrize("size", [400, 4000])
def test_a_lookup_reads_a_bounded_share_of_the_directory(spark, tmp_path, size):
    folder = str(tmp_path / "keys")
    rows = spark.range(size).select(F.concat(F.lit("k"), "id").alias("headline_id"), F.concat(F.lit("2026-0"), F.col("id") % 9 + 1).alias("month"))
    directory.add(spark, folder, rows, known=False)
    directory.add(spark, folder, rows.limit(50))  # nothing new
    total = len(spark.read.schema(directory.ENTRY).parquet(folder).inputFiles())
    ten = rows.filter(F.col("headline_id").isin(*[f"k{i}" for i in range(10)]))
    assert total <= directory.BUCKETS
    found = directory.entries(spark, folder, ten)
    assert len(found.inputFiles()) <= 10
    assert sorted(values(found.join(ten.select("headline_id"), "headline_id", "left_semi"))) == sorted(values(ten))
    assert directory.months_of(spark, folder, ten.limit(0)) == set()


def test_an_upsert_opens_only_the_months_of_its_stories(spark, tmp_path):
    folder = str(tmp_path / "history")
    history.upsert_months(spark, folder, table(spark, [record(f"s{m}", run_date=f"2026-{m:02d}-05") for m in range(1, 9)]))
    before = dict(snapshots.current(spark, f"{folder}/headlines").pairs)
    history.upsert_months(spark, folder, table(spark, [record("s3", run_date="2026-09-05"), record("new", run_date="2026-09-05")]))
    after = dict(snapshots.current(spark, f"{folder}/headlines").pairs)
    assert {m for m in after if after[m] != before.get(m)} == {"2026-03", "2026-09"}
    assert values(history.stories(spark, folder, "headlines", history.read_table(spark, folder, "headlines").filter("title = 's3'")), "month") == ["2026-03"]


def test_only_titles_of_new_snaps_meet_the_rules(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "history")
    rules = quality.RULES

    def load(*rows):
        history.upsert_months(spark, folder, table(spark, list(rows)))

    def flagged(some=rules):
        return sorted(values(history.flagged_titles(spark, folder, some)))

    def as_computed(some=rules):
        return sorted(values(quality.flagged_stories(history.read_table(spark, folder, "headlines"), some)))

    assert flagged() == []
    load(record("fine"), record(JUNK, run_date="2026-08-03"))
    assert flagged() == as_computed() and len(flagged()) == 1
    asked = []
    reason = history.low_quality_reason
    monkeypatch.setattr(history, "low_quality_reason", lambda *a: asked.append(a) or reason(*a))
    assert flagged() == as_computed() and asked == []  # a second run matches no stored title
    load(record("x__y filled in", run_date="2026-08-04"))
    assert flagged() == as_computed() and len(flagged()) == 2 and len(asked) == 1
    assert flagged(rules[1:]) == as_computed(rules[1:]) and len(flagged(rules[1:])) == 1 and len(asked) == 3
    history.compact(spark, folder, "headlines")
    assert flagged() == as_computed()


def counted(headlines, rules=quality.RULES):
    """(topic, first, last, n, hidden) worked out from all rows."""
    bad = set(values(quality.flagged_stories(headlines, rules), "headline_id"))
    cells = {}
    for story, *span in values(headlines, "headline_id", "topic", "first_run_date", "last_run_date"):
        cells.setdefault(tuple(span), [0, 0])[story in bad] += 1
    return sorted((*span, *n) for span, n in cells.items())


def test_kept_counts_equal_the_full_scan_under_random_upserts(spark, tmp_path, monkeypatch):
    folder, rng = str(tmp_path / "history"), random.Random(3)
    read = lambda rules=quality.RULES: sorted(values(history.span_counts(spark, folder, rules)))
    assert read() == []
    for load in range(4):
        rows = []
        for _ in range(25):
            n, month = rng.randrange(30), rng.choice([5, 6, 7, 8])
            title = JUNK if rng.random() < 0.1 else f"Story {n}"
            rows.append(record(title, topic=rng.choice("AB"), link=f"https://e.com/{n}", run_date=f"2026-{month:02d}-{rng.randrange(1, 28):02d}"))
        history.upsert_months(spark, folder, table(spark, rows))
        if load != 1:  # one version is passed over
            assert read() == counted(history.read_table(spark, folder, "headlines"))
    assert read(quality.RULES[1:]) == counted(history.read_table(spark, folder, "headlines"), quality.RULES[1:])
    monkeypatch.setattr(history, "flagged_titles", None)
    assert read()  # a second call reads no stored title and no row of the history
    history.tidy(spark, f"{folder}/headlines")
    assert read() == counted(history.read_table(spark, folder, "headlines"))


def test_a_first_failing_title_hides_rows_of_months_counted_before(spark, tmp_path):
    folder = str(tmp_path / "history")
    link, other = "https://e.com/1", "https://e.com/2"
    history.upsert_months(spark, folder, table(spark, [record("Fine", link=link, run_date="2026-05-02"), record("Other", link=other, run_date="2026-05-02")]))
    assert values(history.span_counts(spark, folder), "n", "hidden") == [(2, 0)]
    history.upsert_months(spark, folder, table(spark, [record(JUNK, topic="B", link=link, run_date="2026-08-02")]))
    assert sorted(values(history.span_counts(spark, folder), "topic", "n", "hidden")) == [("B", 0, 1), ("Markets", 1, 1)]


def test_rows_of_a_month_lie_by_the_day_last_seen(spark, tmp_path):
    folder = str(tmp_path / "history")
    rows = [record(f"s{i}", run_date=f"2026-05-{1 + i % 20:02d}") for i in range(60)] + [record("s3", run_date="2026-06-01")]
    history.upsert_months(spark, folder, table(spark, rows))
    for file in history.read_table(spark, folder, "headlines").inputFiles():
        days = values(spark.read.parquet(file), "last_run_date")
        assert days == sorted(days)


def random_batches(seed, days=6, per_day=40):
    """Sightings where one story makes up a third of all rows."""
    rng = random.Random(seed)
    batches = []
    for day in range(1, days + 1):
        rows = []
        for _ in range(per_day):
            n = 0 if rng.random() < 0.34 else rng.randrange(1, 12)
            rows.append(record(
                f"Story {n} v{rng.randrange(9)}", topic=rng.choice(["A", "B", "C"]),
                link=f"https://e.com/{n}?utm_x={rng.randrange(99)}",
                run_date=f"2026-09-{day:02d}", collected_at=f"2026-09-{day:02d}T{rng.randrange(24):02d}:00:00Z",
            ))
        batches.append(rows)
    return batches


def expected_state(batches):
    """The same state by plain loops."""
    state = {}
    for rows in batches:
        batch = {}
        for r in sorted(enumerate(rows), key=lambda p: (p[1][5], p[0])):
            topic, title, link, seen, day = r[1][0], r[1][1], r[1][3], r[1][5], r[1][6]
            key = (link.split("?")[0], topic)
            old = batch.get(key)
            batch[key] = (old[0] if old else title, min(seen, old[1]) if old else seen,
                          max(seen, old[2]) if old else seen, day)
        for key, (title, first, last, day) in batch.items():
            old = state.get(key)
            state[key] = (old[0], min(old[1], first), max(old[2], last), min(old[3], day), max(old[4], day)) if old \
                else (title, first, last, day, day)
    return {(k[1], *v) for k, v in state.items()}


def as_text(state):
    stamp = "yyyy-MM-dd'T'HH:mm:ss'Z'"
    return set(values(state.select(
        "topic", "title", F.date_format("first_seen_at", stamp).alias("a"), F.date_format("last_seen_at", stamp).alias("b"),
        F.col("first_run_date").cast("string").alias("c"), F.col("last_run_date").cast("string").alias("d"))))


def test_incremental_loads_rebuild_and_plain_loops_agree_on_skewed_data(spark):
    batches = random_batches(7)
    want = expected_state(batches)
    every = sightings.normalize(records(spark, [r for rows in batches for r in rows]))
    assert as_text(sightings.rebuild(every)) == want
    assert as_text(upsert_all(spark, batches[:4])) == expected_state(batches[:4])
    stored = upsert_all(spark, batches[:2])
    rest = sightings.normalize(records(spark, [r for rows in batches[2:] for r in rows]))
    assert as_text(sightings.rebuild(rest, stored)) == want


def test_result_does_not_depend_on_partitioning(spark):
    rows = [r for b in random_batches(3) for r in b]
    typed = sightings.normalize(records(spark, rows))
    want = as_text(sightings.rebuild(typed.coalesce(1)))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert as_text(sightings.rebuild(typed.repartition(int(n)))) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_a_story_under_two_topics_is_scored_once(spark):
    link = "https://example.com/tesla-earnings"
    heads = table(spark, [record("Tesla earnings beat", link=link), record("Tesla earnings beat", topic="Tesla", link=link)])
    none = scores(spark, heads, {})
    assert heads.count() == 2
    assert values(scoring.pending(heads, none, "vader"), "title") == ["Tesla earnings beat"]
    done = scores(spark, heads, {"Tesla earnings beat": {"vader": ("positive", 0.4)}})
    assert scoring.pending(heads, done, "vader").count() == 0
    assert scoring.pending(heads, done, "finbert").count() == 1


def test_scores_append_once(spark):
    heads = table(spark, [record("a"), record("b")])
    first = scores(spark, heads, {"a": {"m": ("neutral", 0.0)}})
    more = scores(spark, heads, {"b": {"m": ("positive", 0.5)}})
    assert scoring.append_scores(first, more).count() == 2
    with pytest.raises(Exception, match="scored twice"):
        scoring.append_scores(first, first).collect()
    with pytest.raises(Exception, match="scored twice"):
        scoring.append_scores(first, more.unionByName(more)).collect()


def test_a_story_is_flagged_by_any_of_its_titles(spark):
    link = "https://e.com/1"
    heads = table(spark, [
        record("Fine title", link=link), record(JUNK, topic="Tesla", link=link),
        record("zz__x", topic="AI", link=link), record("Other"),
    ])
    assert values(quality.flagged_stories(heads), "reason") == ["quote_page"]
    assert values(quality.good_headlines(heads), "title") == ["Other"]
    assert values(quality.hidden_rows(heads)) == [3]


# ---------------------------------------------------------------- raw landing


def test_rewriting_a_partition_changes_nothing_and_later_runs_only_add(spark, tmp_path):
    folder = str(tmp_path / "raw")
    rows = [record("a", published_at="2026-09-14T05:00:00Z"), record("b"), record("c", published_at=None),
            record("b", link="https://example.com/news/b?utm_source=x")]
    counted = raw.write_partitions(spark, folder, records(spark, rows))
    assert values(counted) == [("2026-09-14", "Markets", 3)]

    files = sorted((tmp_path / "raw" / "landing=1").rglob("*.json"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert [line.split('"title":"')[1][0] for line in lines] == ["b", "a", "c"]  # newest first, undated last
    first = sorted(values(raw.read_raw(spark, folder)), key=str)
    assert values(raw.write_partitions(spark, folder, records(spark, rows[:3]))) == [("2026-09-14", "Markets", 3)]
    assert sorted(values(raw.read_raw(spark, folder)), key=str) == first
    assert lines == [line for f in files for line in f.read_text().splitlines()]  # written once

    later = [record("a", collected_at="2026-09-14T15:00:00Z"), record("new", collected_at="2026-09-14T15:00:00Z")]
    raw.write_partitions(spark, folder, records(spark, later))
    kept = dict(values(raw.read_partition(spark, folder, "2026-09-14"), "title", "collected_at"))
    assert kept["a"] == "2026-09-14T09:00:00Z" and kept["new"] == "2026-09-14T15:00:00Z" and len(kept) == 4


def test_a_rewrite_leaves_other_topics_and_days_alone(spark, tmp_path):
    folder = str(tmp_path / "raw")
    raw.write_partitions(spark, folder, records(spark, [
        record("a"), record("b", topic="Tesla"), record("c", run_date="2026-09-13")]))
    raw.write_partitions(spark, folder, records(spark, [record("d", topic="Tesla")]))
    assert sorted(values(raw.read_raw(spark, folder), "date", "topic_slug", "title")) == [
        ("2026-09-13", "markets", "c"), ("2026-09-14", "markets", "a"),
        ("2026-09-14", "tesla", "b"), ("2026-09-14", "tesla", "d")]
    assert raw.read_partition(spark, folder, "2026-09-01").count() == 0


def test_compaction_and_repair_of_the_landing_zone(spark, tmp_path):
    folder = str(tmp_path / "raw")
    raw.write_partitions(spark, folder, records(spark, [record("a", source="old"), record("other day", run_date="2026-09-02")]))
    raw.write_partitions(spark, folder, records(spark, [record("a", source="new"), record("b")]))
    before = sorted(values(raw.read_raw(spark, folder)), key=str)
    raw.compact(spark, folder)
    assert sorted(values(raw.read_raw(spark, folder)), key=str) == before
    assert {f.split("/landing=")[1][:1] for f in raw.read_partition(spark, folder, "2026-09-14").inputFiles()} == {"3"}
    raw.write_partitions(spark, folder, records(spark, [record("a", source="newer"), record("c")]))
    assert sorted(values(raw.read_partition(spark, folder, "2026-09-14"), "title", "source")) == [("a", "old"), ("b", "Reuters"), ("c", "Reuters")]

    (tmp_path / "raw" / "landing=9" / "date=2026-09-20").mkdir(parents=True)  # never entered
    (tmp_path / "raw" / "date=2026-09-03" / "topic_slug=x").mkdir(parents=True)
    (tmp_path / "raw" / "date=2026-09-03" / "topic_slug=x" / "f.json").write_text('{"topic": "X", "title": "given", "link": "https://e.com/g"}\n')
    raw.repair(spark, folder)
    assert sorted(p.name for p in (tmp_path / "raw").iterdir()) == ["catalogue", "landing=1", "landing=3", "landing=4", "landing=5"]
    assert values(raw.partition_dates(spark, folder)) == [date(2026, 9, d) for d in (2, 3, 14)]
    assert values(raw.read_partition(spark, folder, "2026-09-03"), "title") == ["given"]


def test_partition_dates_ignore_empty_and_stray_folders(spark, tmp_path):
    folder = tmp_path / "raw"
    assert values(raw.partition_dates(spark, str(folder / "missing"))) == []
    raw.write_partitions(spark, str(folder), records(spark, [record("a"), record("b", run_date="2026-09-02")]))
    (folder / "date=2026-09-03").mkdir()
    (folder / "date=not-a-date" / "topic_slug=x").mkdir(parents=True)
    (folder / "date=not-a-date" / "topic_slug=x" / "f.json").write_text("{}\n\n")
    assert values(raw.partition_dates(spark, str(folder))) == [date(2026, 9, 2), date(2026, 9, 14)]
    assert raw.read_partition(spark, str(folder), "2026-09-02").count() == 1


def test_scored_at_is_utc(spark):
    heads = table(spark, [record("a")])
    out = scoring.score_pending(heads, scores(spark, heads, {}), {"lexicon": scoring.lexicon_score}, NOW)
    assert values(out.select(F.col("scored_at").cast("string"))) == ["2026-09-14 09:00:00"]
