"""Wall time of the headline queries; prints one JSON line.

Every query runs twice and the second run counts, so that the start of the JVM and its compiler
stay out; `first_runs` has the total of the first ones.
`history_store` is the whole load: events to sightings, keys, collapse, scores, monthly Parquet.
The analytics after it read that stored history. Beside them stand two plain forms: activity by a
range join of days with the history, pairs by joining the scores twice.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import adapters as A  # noqa: E402
from catalog.queries import QUERIES  # noqa: E402

HEADLINE = [
    "edition_top_k", "batch_collapse", "upsert_state", "history_rebuild", "feed_parse", "raw_merge",
    "quality_reason", "dedup_key", "score_lexicon", "good_headlines", "pending_sentiment", "daily_sentiment",
    "daily_activity", "top_sources", "paired_scores", "report_latest", "report_trends", "report_agreement", "report_status",
]


def activity_by_range_join(spark, sf):
    good = A.good(spark, sf)
    days = good.select(F.col("first_run_date").alias("d")).union(good.select("last_run_date")).distinct()
    joined = days.join(good, F.col("d").between(F.col("first_run_date"), F.col("last_run_date")), "left")
    return joined.groupBy("d").agg(
        F.count_if(F.col("first_run_date") == F.col("d")), F.count_if(F.col("first_run_date") < F.col("d"))
    )


def pairs_by_self_join(spark, sf):
    scores = A.sentiment(spark, sf)

    def of(model):
        return scores.filter(F.col("model") == model).select(
            "headline_id", F.col("label").alias(f"label_{model}"), F.col("score").alias(f"score_{model}")
        )

    return A.good(spark, sf).join(of(A.MODEL_A), "headline_id").join(of(A.MODEL_B), "headline_id")


def run(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    A.own_folder(spark)
    run(A.table(spark, sf, "events"))  # start the executors

    seconds: dict[str, float] = {}
    first_runs = []

    def timed(name, work) -> None:
        for attempt in range(2):
            start = time.perf_counter()
            work()
            seconds[name] = round(time.perf_counter() - start, 3)
            if attempt == 0:
                first_runs.append(seconds[name])

    timed("history_store", lambda: A.stored_history(spark, sf, renew=True))
    for name in HEADLINE:
        timed(name, lambda name=name: run(QUERIES[name](spark, sf)))
    total, first = round(sum(seconds.values()), 3), round(sum(first_runs), 3)
    timed("plain_activity_by_range_join", lambda: run(activity_by_range_join(spark, sf)))
    timed("plain_pairs_by_self_join", lambda: run(pairs_by_self_join(spark, sf)))
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": total, "unit": "sec", "queries": seconds, "first_runs": first,
        "sf": os.path.basename(sf.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
