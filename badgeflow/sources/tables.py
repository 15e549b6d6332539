"""Where the pipeline's tables lie, and how they are read and written.

Every folder is Parquet. Tables that grow batch by batch are partitioned by day first, then by
the run and batch that wrote the rows: readers prune days, a replay finds and replaces its own
folders, and a batch id of one run never touches those of another. ``close_day`` merges a day's
batches into one folder once no more are expected, and ``expire`` removes old days, so what a
reader lists follows the days that are kept, not the batches ever run.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from badgeflow import schemas
from badgeflow.functions.clock import AsOf
from badgeflow.operators.feed import table_changes
from badgeflow.sources import files
from badgeflow.sources.messages import message_variant
from badgeflow.sources.seeds import fill_columns, seed_users, seed_zones

BATCHED = {
    "raw": (schemas.RAW_FILES, "ingestion_date"),
    "rejects": (schemas.REJECTS_FILES, "ingestion_date"),
    "staging": (schemas.STAGING_FILES, "load_date"),
    "ingest_log": (schemas.INGEST_LOG_FILES, "log_date"),
    "run_log": (schemas.RUN_LOG_FILES, "run_date"),
    "first_events": (schemas.FIRST_EVENTS_FILES, "event_date"),
    "hourly_parts": (schemas.HOURLY_PARTS_FILES, "part_date"),
    "hourly_bits": (schemas.HOURLY_BITS_FILES, "part_date"),
}
#: Bloom filters of badges, no larger than the badges of a file need.
BADGE_FILTER = {"parquet.bloom.filter.enabled#badge_id": "true", "parquet.bloom.filter.adaptive.enabled#badge_id": "true"}
#: The run that merged days belong to; runs of writers start with another letter.
CLOSED = "closed"
BY_HAND = "by-hand"


@dataclass(frozen=True)
class Layout:
    """With ``variant`` the messages of raw are kept as variants in place of text: Spark shreds their common fields into
    Parquet columns of their own, and ``messages.message_fields`` reads single fields. A layout keeps one kind for good."""

    root: str
    variant: bool = False

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/_checkpoints/{query}"

    # --- reading ---------------------------------------------------------------------
    def _read(self, spark: SparkSession, table: str, schema: StructType) -> DataFrame:
        return spark.read.schema(schema).parquet(self.path(table))

    def _schema(self, name: str) -> StructType:
        return schemas.RAW_VARIANT_FILES if name == "raw" and self.variant else BATCHED[name][0]

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """A table of batches, with the columns of its folders."""
        return self._read(spark, name, self._schema(name))

    def raw(self, spark: SparkSession) -> DataFrame:
        return self.table(spark, "raw")

    def raw_stream(self, spark: SparkSession, max_files: int | None = None) -> DataFrame:
        """Raw rows of open days with the file they come from, in column ``file``."""
        reader = spark.readStream.schema(self._schema("raw")).option("basePath", self.path("raw"))
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        open_days = f"{self.path('raw')}/ingestion_date=*/run=[^{CLOSED[0]}]*"
        return with_file(reader.parquet(open_days))

    def staged_batch_stream(self, spark: SparkSession, max_files: int | None = None) -> DataFrame:
        """Marker rows of staged batches."""
        reader = spark.readStream.schema(schemas.STAGED_BATCHES)
        if max_files is not None:
            reader = reader.option("maxFilesPerTrigger", max_files)
        return reader.parquet(self.path("staged_batches"))

    def staging(self, spark: SparkSession) -> DataFrame:
        return self.table(spark, "staging")

    def users(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """A version of the dimension, the newest one if none is named."""
        folder = self._users_version(spark) if version is None else self._version(version)
        return spark.read.schema(schemas.USERS).parquet(folder)

    def user_changes(self, spark: SparkSession, before: int, after: int | None = None) -> DataFrame:
        """Change rows between two versions of the dimension."""
        return table_changes(self.users(spark, before), self.users(spark, after), ["user_key"])

    def zones(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "dim_zones", schemas.ZONES)

    def readers(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "dim_readers", schemas.READERS)

    def fact(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "fact", schemas.FACT_FILES)

    def staged_files(self, spark: SparkSession) -> DataFrame:
        """The raw files that have been staged."""
        return self._read(spark, "staged_files", schemas.STAGED_FILES)

    def value_numbers(self, spark: SparkSession) -> DataFrame:
        """The numbers of values that rollups count."""
        return self._read(spark, "value_numbers", schemas.VALUE_NUMBERS)

    def ingest_log(self, spark: SparkSession) -> DataFrame:
        return self.table(spark, "ingest_log")

    def run_log(self, spark: SparkSession) -> DataFrame:
        return self.table(spark, "run_log")

    def batch(self, spark: SparkSession, name: str, run: str, batch_id: int) -> DataFrame:
        """The rows of one batch, read from its own folders."""
        schema = self._schema(name)
        folders = files.matching(spark, self._folders(name, run, batch_id))
        if not folders:
            return fill_columns(spark.range(0).select(), schema, {})
        return spark.read.schema(schema).option("basePath", self.path(name)).parquet(*folders)

    def _folders(self, name: str, run: str, batch_id: int | str, day: str = "*") -> str:
        return f"{self.path(name)}/{BATCHED[name][1]}={day}/run={run}/batch_id={batch_id}"

    # --- writing ---------------------------------------------------------------------
    def create(self, spark: SparkSession, as_of: AsOf = None) -> Layout:
        """Empty tables and seeded dimensions; a table that exists is left alone."""

        for name in (*BATCHED, "fact", "staged_files", "staged_batches", "dim_readers", "value_numbers"):
            files.make(spark, self.path(name))
        seed_zones(spark, as_of).coalesce(1).write.mode("ignore").parquet(self.path("dim_zones"))
        seed_users(spark, as_of).coalesce(1).write.mode("ignore").parquet(self._version(0))
        return self

    def raw_files(self, raw: DataFrame) -> DataFrame:
        """Raw rows with the two columns only the files carry, and their message as the layout keeps it."""
        rows = raw.withColumns({
            "message_bytes": F.octet_length("raw_json"),
            "ingestion_date": F.to_date("ingestion_time"),
        })
        return rows.withColumn("raw_json", message_variant()) if self.variant else rows

    def append_raw(self, raw: DataFrame) -> None:
        """Append rows to raw by hand, as a batch of their own."""
        self.write_batch(self.raw_files(raw), "raw", f"{BY_HAND}-{uuid.uuid4().hex}", 0)

    def write_batch(self, rows: DataFrame, name: str, run: str, batch_id: int, few_days: bool = False) -> None:
        """Write a batch, in place of what an earlier attempt of it may have written.

        With ``few_days`` the rows come from a shuffle and belong to few days, so that each task may write its own
        files; otherwise a day's rows are brought together first, see ``_clustered``.
        """
        day = BATCHED[name][1]
        self.drop_batch(rows.sparkSession, name, run, batch_id)
        named = rows.withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")})
        self._clustered(named, [day, "run", "batch_id"], not few_days).mode("append").parquet(self.path(name))

    @staticmethod
    def _clustered(rows: DataFrame, folders: list[str], together: bool, whole_days: bool = False) -> DataFrameWriter:
        """A writer into folders, of rows that are sorted by time and badge within each file of events.

        Pages then hold a short span of time each, and Parquet's page index leaves out those that a filter on
        the facts' ``event_hour`` excludes (Spark hands no filters on zone-less timestamps to Parquet). Rows brought together
        by day make few files, and adaptive execution splits a day that is too large for one task. Files of whole, merged
        days also carry Bloom filters of their badges, so that the rows of one badge are read without the row groups that
        lack it. (Small files of one batch have their dictionaries for that, and a filter would outweigh them.)
        """
        of_events = {"event_timestamp", "badge_id"} <= set(rows.columns)
        if together:
            rows = rows.hint("rebalance", folders[0])
        if of_events:  # the folders first: the writer asks for that order, and would sort again
            rows = rows.sortWithinPartitions(*folders, "event_timestamp", "badge_id")
        writer = rows.write.partitionBy(*folders)
        if of_events and whole_days:
            for option, value in BADGE_FILTER.items():
                writer = writer.option(option, value)
        return writer

    def drop_batch(self, spark: SparkSession, name: str, run: str, batch_id: int) -> None:
        files.remove(spark, self._folders(name, run, batch_id))

    def append_fact(self, fact: DataFrame, few_days: bool = False) -> None:
        rows = fact.withColumn("load_date", F.to_date("fact_load_time"))
        self._clustered(rows, ["event_date", "load_date"], not few_days).mode("append").parquet(self.path("fact"))

    def append_staged_files(self, staged: DataFrame) -> None:
        staged.coalesce(1).write.mode("append").partitionBy("ingestion_date").parquet(self.path("staged_files"))

    def append_staged_batch(self, spark: SparkSession, run: str, batch_id: int, staged_at: datetime) -> None:
        marker = spark.createDataFrame([(run, batch_id, staged_at)], schemas.STAGED_BATCHES)
        marker.coalesce(1).write.mode("append").parquet(self.path("staged_batches"))

    # --- versions of the user dimension ----------------------------------------------
    def _version(self, number: int) -> str:
        return f"{self.path('dim_users')}/version={number}"

    def _users_version(self, spark: SparkSession) -> str:
        """The newest complete version: Spark marks a folder when all of it is written."""
        done = files.matching(spark, f"{self.path('dim_users')}/version=*/_SUCCESS")
        return self._version(max(int(path.split("version=")[1].split("/")[0]) for path in done))

    def append_users(self, users: DataFrame) -> None:
        """Add rows to the newest version; nothing is written when there are none."""
        _append_some(users, self._users_version(users.sparkSession))

    def append_value_numbers(self, numbers: DataFrame) -> None:
        _append_some(numbers, self.path("value_numbers"))

    def replace_users(self, users: DataFrame) -> None:
        """A new version of the dimension, which readers take from then on."""
        newest = int(self._users_version(users.sparkSession).split("version=")[1])
        users.write.mode("overwrite").parquet(self._version(newest + 1))

    # --- keeping folders few -----------------------------------------------------------
    def close_day(self, spark: SparkSession, name: str, day: str) -> None:
        """Merge the batches of a day. Run it when no batch writes to that day any more.

        A raw day must be staged first: streams read open days only.
        """
        column = BATCHED[name][1]
        folder = f"{column}={day}"
        if not self._closing(spark, name, folder):
            rows = self._of_folder(spark, name, self._schema(name), f"{folder}/run=*/batch_id=*")
            if rows is None:
                return
            if name == "raw" and self.unstaged(spark, with_file(rows)).take(1):
                raise RuntimeError(f"raw rows of {day} are not staged yet")
            closed = rows.withColumns({"run": F.lit(CLOSED), "batch_id": F.lit(0)}).drop(column)
            self._prepare(rows, closed, name, folder, "run", "batch_id")
        self._swap(spark, name, folder)
        if name == "raw":
            files.remove(spark, f"{self.path('staged_files')}/ingestion_date={day}")

    def close_fact_day(self, spark: SparkSession, day: str) -> None:
        """Merge the files of a day of events. Run it when no load is under way: a load that
        compares with half a day would add facts twice."""
        folder = f"event_date={day}"
        if not self._closing(spark, "fact", folder):
            rows = self._of_folder(spark, "fact", schemas.FACT_FILES, f"{folder}/load_date=*")
            if rows is None:
                return
            self._prepare(rows, rows.drop("event_date"), "fact", folder, "load_date")
        self._swap(spark, "fact", folder)

    def _of_folder(self, spark: SparkSession, name: str, schema: StructType, pattern: str) -> DataFrame | None:
        folders = files.matching(spark, f"{self.path(name)}/{pattern}")
        return spark.read.schema(schema).option("basePath", self.path(name)).parquet(*folders) if folders else None

    def _hidden(self, name: str, folder: str) -> str:
        return f"{self.path(name)}/_closing/{folder}"

    def _closing(self, spark: SparkSession, name: str, folder: str) -> bool:
        """Whether merged rows wait to take their place: an earlier call was broken off."""
        return files.exists(spark, f"{self._hidden(name, folder)}/rows/_SUCCESS")

    def _prepare(self, rows: DataFrame, merged: DataFrame, name: str, folder: str, *partitions: str) -> None:
        """Write the merged rows under a hidden name, after the list of the files that they replace."""
        spark, hidden = rows.sparkSession, self._hidden(name, folder)
        old = spark.createDataFrame([(f,) for f in rows.inputFiles()], "value string")  # the files of one day
        old.coalesce(1).write.mode("overwrite").text(f"{hidden}/old")
        self._clustered(merged, list(partitions), True, whole_days=True).mode("overwrite").parquet(f"{hidden}/rows")

    def _swap(self, spark: SparkSession, name: str, folder: str) -> None:
        """Remove the listed files and move the merged ones to their place. Names never recur, so a
        call that was broken off is simply done again."""
        hidden = self._hidden(name, folder)
        for row in spark.read.text(f"{hidden}/old").collect():
            files.remove(spark, row.value)
        depth = "/".join(["*=*"] * (2 if name in BATCHED else 1))
        for path in files.matching(spark, f"{hidden}/rows/{depth}/*.parquet"):
            files.rename(spark, path, f"{self.path(name)}/{folder}/{path.split('/rows/')[1]}")
        for empty in files.matching(spark, f"{self.path(name)}/{folder}/{depth}"):
            if not files.matching(spark, f"{empty}/*.parquet"):
                files.remove(spark, empty)
        files.remove(spark, hidden)

    def close_users(self, spark: SparkSession) -> None:
        self.replace_users(self.users(spark).hint("rebalance"))

    def expire(self, spark: SparkSession, name: str, before: str) -> None:
        """Remove the days of a table before a day (``2024-01-31``), whether or not a consumer still needs their rows; see
        ``pipeline.sweep``."""
        column = BATCHED[name][1]
        for path in files.matching(spark, f"{self.path(name)}/{column}=*"):
            if path.split(f"{column}=")[1] < before:
                files.remove(spark, path)

    def unstaged(self, spark: SparkSession, raw: DataFrame) -> DataFrame:
        """Files of raw rows that have not been staged, with their number of rows.

        Only files are counted: Spark takes the numbers of rows from the files' footers.
        """
        held = raw.where(F.col("run") != CLOSED).groupBy("ingestion_date", "file").agg(F.count("*").alias("n_rows"))
        return held.join(self.staged_files(spark), ["ingestion_date", "file"], "left_anti")


def _append_some(rows: DataFrame, path: str) -> None:
    kept = rows.persist()
    try:
        if kept.take(1):
            kept.write.mode("append").parquet(path)
    finally:
        kept.unpersist()


def with_file(rows: DataFrame) -> DataFrame:
    """Rows of files with the file's path in column ``file``."""
    return rows.withColumn("file", F.col("_metadata.file_path"))
