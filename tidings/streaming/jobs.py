"""Structured Streaming forms of landing, upsert, scoring and daily counts.

The batch jobs are safe to repeat, so a micro-batch that is run again after a failure leaves the
same tables: stored versions win on landing, first and last dates only move outwards, and a
story with a score is no longer pending. What a micro-batch reads of the history is bounded by
its own stories: the directory names the months they lie in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidings.functions.times import parse_iso
from tidings.operators import sightings
from tidings.operators.scoring import Scorer
from tidings.plans.jobs import Paths, score_history
from tidings.schemas import RAW_RECORD
from tidings.session import scratch
from tidings.sources import history, raw


def read_record_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw records from new JSON files under `path`, with the run date as partition `date`."""
    reader = spark.readStream.schema(RAW_RECORD)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path).withColumn("date", F.col("run_date"))


def _start(stream: DataFrame, checkpoint: str, work, trigger: dict) -> StreamingQuery:
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(work)
        .trigger(**trigger)
        .start()
    )


def land_stream(
    records: DataFrame, paths: Paths, checkpoint: str, trigger: dict = {"availableNow": True}
) -> StreamingQuery:
    """Merge arriving records into the raw partitions; the first version of a record stays."""

    def work(batch: DataFrame, batch_id: int) -> None:
        raw.write_partitions(batch.sparkSession, paths.raw, batch)

    return _start(records, checkpoint, work, trigger)


def upsert_stream(
    records: DataFrame, paths: Paths, checkpoint: str, trigger: dict = {"availableNow": True}
) -> StreamingQuery:
    """Upsert arriving records into the stored headlines. Late records move first and last
    dates outwards whatever the order of arrival."""

    def work(batch: DataFrame, batch_id: int) -> None:
        fresh = sightings.rebuild(sightings.normalize(batch))
        history.upsert_months(batch.sparkSession, paths.history, fresh)

    return _start(records, checkpoint, work, trigger)


def delivered_once(records: DataFrame, lateness: str) -> DataFrame:
    """Records without those delivered again within `lateness`, by state that expires with the
    watermark. A record later than that is left out; so is one without a time."""
    seen = F.coalesce(parse_iso(F.col("collected_at")), F.col("run_date").try_cast("timestamp_ntz")).cast("timestamp")
    return (
        records.withColumn("seen", seen).filter("seen IS NOT NULL")
        .withWatermark("seen", lateness).dropDuplicatesWithinWatermark(RAW_RECORD.fieldNames()).drop("seen")
    )


def score_stream(
    records: DataFrame, paths: Paths, checkpoint: str, scorers: dict[str, Scorer], now,
    lateness: str = "7 days", trigger: dict = {"availableNow": True},
) -> StreamingQuery:
    """Upsert arriving records and score their stories, once per story and model. Titles and scores
    are read from the months of these stories only; a new model over the whole history, and
    records later than `lateness`, are for the batch job."""

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch(spark) as store:
            fresh = store(sightings.rebuild(sightings.normalize(batch)))
            history.upsert_months(spark, paths.history, fresh)
            score_history(spark, paths, scorers, now, fresh.select("headline_id").distinct())

    return _start(delivered_once(records, lateness), checkpoint, work, trigger)


def daily_count_stream(
    typed: DataFrame, time_column: str = "collected_at", lateness: str = "2 days"
) -> DataFrame:
    """(day, topic, n): sightings per topic in day windows. A day is final once the watermark
    has passed it; records later than `lateness` are left out."""
    return (
        typed.withColumn(time_column, F.col(time_column).cast("timestamp"))
        .withWatermark(time_column, lateness)
        .groupBy(F.window(time_column, "1 day").alias("w"), "topic")
        .agg(F.count("*").alias("n"))
        .select(F.to_date("w.start").alias("day"), "topic", "n")
    )


def final_count_stream(
    typed: DataFrame, folder: str, checkpoint: str, time_column: str = "collected_at", lateness: str = "2 days",
    trigger: dict = {"availableNow": True},
) -> tuple[StreamingQuery, StreamingQuery]:
    """Two queries over the same sightings: final day counts, appended once under `folder`/final when the
    watermark has passed a day, whose state then goes; and what arrived per micro-batch, day and
    topic, under `folder`/arrived. `late_counts` compares them."""
    final = (
        daily_count_stream(typed, time_column, lateness).writeStream.outputMode("append").format("parquet")
        .option("path", f"{folder}/final").option("checkpointLocation", f"{checkpoint}/final").trigger(**trigger).start()
    )

    def work(batch: DataFrame, batch_id: int) -> None:
        # a repeated micro-batch writes the same folder again
        batch.groupBy(F.to_date(time_column).alias("day"), "topic").agg(F.count("*").alias("n")).write.mode("overwrite").parquet(
            f"{folder}/arrived/batch={batch_id}")

    return final, _start(typed, f"{checkpoint}/arrived", work, trigger)


def late_counts(spark: SparkSession, folder: str) -> DataFrame:
    """(day, topic, n, late): for every day that is final, sightings counted in time and sightings
    that came after the day was closed."""
    columns = "day date, topic string, n long"
    final = spark.read.schema(columns).parquet(f"{folder}/final")
    arrived = spark.read.schema(f"{columns}, batch long").parquet(f"{folder}/arrived").groupBy("day", "topic").agg(F.sum("n").alias("arrived"))
    closed = final.agg(F.max("day").alias("closed"))  # days close in order
    return (
        arrived.join(F.broadcast(closed), F.col("day") <= F.col("closed")).join(final, ["day", "topic"], "left")
        .select("day", "topic", F.coalesce("n", F.lit(0)).alias("n"), (F.col("arrived") - F.coalesce("n", F.lit(0))).alias("late"))
    )
