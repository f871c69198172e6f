"""Versions of a table kept as month folders.

Data lie in `data/snap=<id>/month=<YYYY-MM>/` and are never rewritten in place. A manifest names, for
every month, the snaps that hold it now, and the generation of the key directory. A version is one
manifest of one file, which its job's commit moves into place, so that a change of many months is
there as a whole or not at all. A second writer of the same version fails.

A manifest is as long as the table has months, a few lines each; the driver reads it.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tidings.sources.files import children, exists, remove

ROW = "version long, month string, snap string"


@dataclass(frozen=True)
class Snapshot:
    """A version: (month, snap) pairs and the generation of the directory, both names of folders."""

    root: str
    version: int = 0
    pairs: tuple[tuple[str, str], ...] = ()
    keys: str = field(default_factory=lambda: uuid.uuid4().hex)

    @property
    def data(self) -> str:
        return f"{self.root}/data"

    @property
    def key_folder(self) -> str:
        return f"{self.root}/keys/{self.keys}"

    def folders(self, months: set[str] | None = None) -> list[str]:
        return [f"{self.data}/snap={s}/month={m}" for m, s in self.pairs if months is None or m in months]

    def months(self) -> set[str]:
        return {m for m, _ in self.pairs}


def current(spark: SparkSession, root: str) -> Snapshot:
    """The newest version, an empty one of number 0 if there is none."""
    folder = f"{root}/manifests"
    if not exists(spark, folder):
        return Snapshot(root)
    rows = spark.read.schema(ROW).option("recursiveFileLookup", True).json(folder).collect()
    newest = max((r["version"] for r in rows), default=0)
    rows = [r for r in rows if r["version"] == newest]
    keys = [r["snap"] for r in rows if r["month"] is None]
    pairs = tuple(sorted((r["month"], r["snap"]) for r in rows if r["month"] is not None))
    return Snapshot(root, newest, pairs, keys[0]) if keys else Snapshot(root)


def write_snap(frame: DataFrame, snapshot: Snapshot, order: list[str], name: str | None = None) -> list[tuple[str, str]]:
    """Write `frame`, which has `month`, as a new snap that no version names yet; returns its pairs."""
    name = name or uuid.uuid4().hex
    folder = f"{snapshot.data}/snap={name}"
    (
        # by range, so a month that holds most of the rows fills several files, each with a narrow
        # span of keys
        frame.repartitionByRange("month", *order)
        .sortWithinPartitions("month", *order)
        .write.option("compression", "zstd")
        .partitionBy("month")
        .parquet(folder)
    )
    written = frame.sparkSession.read.schema(frame.schema).parquet(folder).select("month").distinct()
    return [(r["month"], name) for r in written.collect()]


def commit(spark: SparkSession, before: Snapshot, pairs: list[tuple[str, str]], keys: str | None = None) -> Snapshot:
    """Make `pairs` the next version after `before`."""
    after = Snapshot(before.root, before.version + 1, tuple(sorted(pairs)), keys or before.keys)
    rows = [(after.version, None, after.keys), *((after.version, m, s) for m, s in after.pairs)]
    spark.createDataFrame(rows, ROW).coalesce(1).write.json(f"{after.root}/manifests/{after.version:012d}")
    return after


def tidy(spark: SparkSession, root: str) -> None:
    """Remove what the newest version does not name. Not while others read or write the table."""
    now = current(spark, root)
    keep = {s for _, s in now.pairs}
    beside = [
        (f"{root}/{kind}/{rules}", {f"snap={s}" for s in keep})
        for kind in ("flags", "counts") for rules in children(spark, f"{root}/{kind}")
    ]
    for folder, kept in (*beside, (now.data, {f"snap={s}" for s in keep}), (f"{root}/keys", {now.keys}), (f"{root}/manifests", {f"{now.version:012d}"})):
        for name in set(children(spark, folder)) - kept:
            remove(spark, f"{folder}/{name}")
