"""Tables of day folders that are read through a pointer, and keyed snapshots in buckets.

A day table is a list of folders, each with rows of one day, in a small JSON file. A change writes folders beside
the old ones and then the next list; readers take the list with the highest number, so they see all of
a compaction or an expiry or nothing of it. A list is created once: of two writers the later one is refused.

A snapshot of the keyed store lies in buckets of its key. Newer rows are merged while reading: they alone are
shuffled, into the same buckets, and hide the snapshot's rows of their keys.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from editengine import schema as S
from editengine.operators.serving import upsert_latest


class Folder:
    """A path, through the file system that Spark sees."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        return [x.getPath().getName() for x in self.fs.listStatus(self.path)] if self.fs.exists(self.path) else []

    def child(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(self.path, name)

    def read(self, name: str) -> str:
        with_lines = self.jvm.java.util.Scanner(self.fs.open(self.child(name)), "UTF-8").useDelimiter("\\A")
        try:
            return with_lines.next()
        finally:
            with_lines.close()

    def create(self, name: str, text: str) -> None:
        """A new file, whole or not at all; refused if it is there."""
        draft = self.child(f".{uuid.uuid4().hex}")
        out = self.fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        if self.fs.exists(self.child(name)) or not self.fs.rename(draft, self.child(name)):
            self.fs.delete(draft, False)
            raise RuntimeError(f"another writer has made {name}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.child(name), True)


class DayTable:
    """Rows in folders of their day. ``day`` becomes a column of what is read, for pruning."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _lists(self) -> list[str]:
        return sorted(x for x in Folder(self.spark, f"{self.path}/lists").names() if x.endswith(".json"))

    def folders(self) -> dict[str, list[str]]:
        """The folders of each day, as of the newest list."""
        lists = self._lists()
        return json.loads(Folder(self.spark, f"{self.path}/lists").read(lists[-1])) if lists else {}

    def _swap(self, before: int, folders: dict[str, list[str]]) -> None:
        Folder(self.spark, f"{self.path}/lists").create(f"{before + 1:012d}.json", json.dumps(folders))

    def _write(self, rows: DataFrame) -> dict[str, list[str]]:
        run = f"run={uuid.uuid4().hex}"
        rows.write.partitionBy("day").parquet(f"{self.path}/data/{run}")
        days = [x for x in Folder(self.spark, f"{self.path}/data/{run}").names() if x.startswith("day=")]
        return {x.removeprefix("day="): [f"{run}/{x}"] for x in days}

    def _changed(self, change) -> None:
        """``change`` of the present folders becomes the next list."""
        count, now = len(self._lists()), self.folders()
        self._swap(count, {day: own for day, own in sorted(change(now).items()) if own})

    def append(self, rows: DataFrame, day) -> None:
        """Add rows; ``day`` is their day, a date column. Rows without one go under a folder of their own."""
        made = self._write(rows.withColumn("day", day))
        self._changed(lambda now: {d: now.get(d, []) + made.get(d, []) for d in {*now, *made}})

    def read(self, days: Iterable[str] | None = None) -> DataFrame | None:
        """All rows, or those of some days, with their ``day``; None if there are none."""
        now = self.folders()
        wanted = [f"{self.path}/data/{x}" for d in (now if days is None else days) for x in now.get(d, [])]
        if not wanted:
            return None
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*wanted).drop("run")

    def compact(self, before: str | None = None, rows_per_file: int = 2_000_000) -> list[str]:
        """Rewrite the days before a date, or all but the last one, that lie in several folders into few files."""

        closed = sorted(d for d in self.folders() if not d.startswith("__"))
        closed = [d for d in closed if d < before] if before else closed[:-1]

        def change(now):
            several = [d for d in closed if len(now.get(d, [])) > 1]
            if not several:
                return now
            # A large day is spread over tasks by the number of its rows. A seed makes the deal repeatable. Days are
            # written one by one: a write that makes the folders itself sorts each task's rows, whole files, by day.
            counts = {str(r["day"]): r["count"] for r in self.read(several).groupBy("day").count().collect()}  # a row for each day
            run, made = f"run={uuid.uuid4().hex}", {}
            for day in several:
                dealt = self.read([day]).drop("day").withColumn("file", F.rand(1))
                dealt = dealt.repartition(-(-counts.get(day, 1) // rows_per_file), "file").drop("file")
                made[day] = [f"{run}/day={day}"]
                dealt.write.option("maxRecordsPerFile", rows_per_file).parquet(f"{self.path}/data/{made[day][0]}")
            return {**now, **made}

        self._changed(change)
        return closed

    def expire(self, alive, border: str) -> None:
        """Forget the days before the border; of the border day only the rows that ``alive`` tells stay."""

        def change(now):
            kept = {d: own for d, own in now.items() if d > border or d.startswith("__")}
            left = self.read([border])
            return kept if left is None else {**kept, **self._write(left.where(alive))}

        self._changed(change)

    def sweep(self, lists: int = 2) -> int:
        """Remove the folders that none of the last lists names; returns how many."""
        names = self._lists()
        folder, gone = Folder(self.spark, f"{self.path}/lists"), 0
        used = {x for name in names[-lists:] for own in json.loads(folder.read(name)).values() for x in own}
        data = Folder(self.spark, f"{self.path}/data")
        for run in data.names():
            own = Folder(self.spark, f"{self.path}/data/{run}")
            for day in own.names():
                if day.startswith("day=") and f"{run}/{day}" not in used:
                    own.delete(day)
                    gone += 1
        for name in names[:-lists]:
            folder.delete(name)
        return gone


KEY = ("event_time", "event_id", "wiki", "wiki_lang")


def write_keyed(rows: DataFrame, path: str, buckets: int = 64) -> None:
    """A snapshot with one row for each key, in buckets of the key; ``rows`` must be so already."""
    place = f"{path}/buckets-{buckets}"
    name = _name(place)
    rows.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    laid = rows.select(*S.STORE_COLUMNS).repartition(buckets, *KEY).sortWithinPartitions("wiki", F.desc("event_time"))
    laid.write.format("parquet").mode("overwrite").option("path", place).bucketBy(buckets, *KEY).saveAsTable(name)


def _name(place: str) -> str:
    return "keyed_" + hashlib.md5(place.encode()).hexdigest()


def read_keyed(spark: SparkSession, path: str) -> DataFrame | None:
    """The snapshot at a path, which Spark knows to be in buckets; None where there is none."""
    found = [x for x in Folder(spark, path).names() if x.startswith("buckets-")]
    if not found:
        return None
    place, buckets = f"{path}/{found[0]}", int(found[0].removeprefix("buckets-"))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(place)} ({S.STORE_DDL}) USING parquet CLUSTERED BY ({', '.join(KEY)}) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(_name(place))


def merged(snapshot: DataFrame, newer: DataFrame, *version: str) -> DataFrame:
    """The snapshot's rows with those of newer batches over them; the snapshot is not shuffled."""
    fresh = upsert_latest(newer.select(*S.STORE_COLUMNS, *version), *version)
    hidden = fresh.select(*KEY)
    return snapshot.join(hidden, list(KEY), "left_anti").select(*S.STORE_COLUMNS).unionByName(fresh.select(*S.STORE_COLUMNS))


def compact_keyed(spark: SparkSession, earlier: str | None, newer: DataFrame, path: str, *version: str, buckets: int = 64) -> None:
    """The next snapshot: the earlier one with newer batches over it, at another path."""
    older = read_keyed(spark, earlier) if earlier else None
    rows = upsert_latest(newer.select(*S.STORE_COLUMNS, *version), *version) if older is None else merged(older, newer, *version)
    write_keyed(rows, path, buckets)
