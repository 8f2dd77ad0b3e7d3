"""Time-partitioned tables: layout, pruned scans, and batches that are seen whole or not at all.

A micro-batch writes several tables and, after all of them, one commit row. Readers take the batches up
to the last commit, so a batch that failed between two outputs shows in none of them; when it is run
again, it replaces what it had written.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions.columns import moment


@dataclass(frozen=True)
class Layout:
    """Days per time partition and, when there, hash partitions of the benchmark."""

    days: int
    spaces: int = 0

    @property
    def partitions(self) -> list[str]:
        return ["date", "space"] if self.spaces else ["date"]


# Partition widths of the tables.
LAYOUTS = {
    "ticks": Layout(1, 3),
    "candles_1m": Layout(7),
    "candles_5m": Layout(30),
    "alerts": Layout(7),
    "volatility": Layout(7),
}
_EPOCH = date(1970, 1, 1)


def partition_date(time: str | Column, days: int = 1) -> Column:
    """First day of the partition that holds `time`."""
    column = F.col(time) if isinstance(time, str) else time
    number = F.unix_date(F.to_date(column))
    return F.date_from_unix_date((number - F.pmod(number, F.lit(days))).cast("int"))


def first_day(moment_of: datetime, days: int) -> date:
    number = (moment_of.date() - _EPOCH).days
    return _EPOCH + timedelta(days=number - number % days)


def space_of(benchmark: str | Column, spaces: int) -> Column:
    column = F.col(benchmark) if isinstance(benchmark, str) else benchmark
    return F.pmod(F.xxhash64(column), F.lit(spaces)).cast("int")


def arranged(df: DataFrame, layout: Layout) -> DataFrame:
    """Add the partition columns and cluster rows so that files hold one benchmark's time range.

    Ranges are cut by row count, so a busy day or benchmark is written by many tasks.
    """
    out = df.withColumn("date", partition_date("time", layout.days))
    if layout.spaces:
        out = out.withColumn("space", space_of("benchmark", layout.spaces))
    return out.repartitionByRange(*layout.partitions, "benchmark", "time").sortWithinPartitions(
        *layout.partitions, "benchmark", F.desc("time")
    )


def write_table(df: DataFrame, path: str, layout: Layout, mode: str = "append", whole: bool = False) -> None:
    """Write in the table's layout; `overwrite` replaces only the partitions that `df` holds, or the `whole` table."""
    replaced = "static" if whole else "dynamic"
    writer = arranged(df, layout).write.mode(mode).option("partitionOverwriteMode", replaced)
    writer.partitionBy(*layout.partitions).parquet(path)


def read_table(
    spark: SparkSession,
    path: str,
    schema: StructType,
    layout: Layout,
    start: datetime | None = None,
    end: datetime | None = None,
    benchmark: str | None = None,
) -> DataFrame:
    """Scan a table; time and benchmark bounds also become partition filters."""
    full = StructType([*schema.fields]).add("date", "date")
    if layout.spaces:
        full = full.add("space", "integer")
    df = spark.read.schema(full).parquet(path)
    if start is not None:
        df = df.where((F.col("date") >= F.lit(first_day(start, layout.days))) & (F.col("time") >= moment(df, "time", start)))
    if end is not None:
        df = df.where((F.col("date") <= F.lit(first_day(end, layout.days))) & (F.col("time") <= moment(df, "time", end)))
    if benchmark is not None:
        df = df.where(F.col("benchmark") == benchmark)
        if layout.spaces:
            df = df.where(F.col("space") == space_of(F.lit(benchmark), layout.spaces))
    return df.drop(*layout.partitions)


def write_batch(df: DataFrame, path: str, batch_id: int, days: int = 1) -> None:
    """Write one micro-batch; writing it again after a restart replaces what it wrote before."""
    rows = df.withColumns({"date": partition_date("time", days), "batch_id": F.lit(batch_id).cast("long")})
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date", "batch_id").parquet(path)


def read_batches(
    spark: SparkSession,
    path: str,
    schema: StructType,
    until: int | None,
    layout: Layout = Layout(1),
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """Rows of the batches up to `until`, with `date` and `batch_id`; time bounds also become partition filters."""
    full = StructType([*schema.fields]).add("date", "date").add("batch_id", "long")
    df = spark.read.schema(full).parquet(path)
    if until is not None:
        df = df.where(F.col("batch_id") <= until)
    if start is not None:
        df = df.where((F.col("date") >= F.lit(first_day(start, layout.days))) & (F.col("time") >= moment(df, "time", start)))
    if end is not None:
        df = df.where((F.col("date") <= F.lit(first_day(end, layout.days))) & (F.col("time") <= moment(df, "time", end)))
    return df


def dates_of(spark: SparkSession, path: str) -> list[date]:
    """The dates of a table's partitions, newest first, from one listing of its folder."""
    store, at = _located(spark, path)
    names = (status.getPath().getName() for status in store.listStatus(at) if status.isDirectory())
    return sorted((date.fromisoformat(n.removeprefix("date=")) for n in names if n.startswith("date=")), reverse=True)


def newest_rows(rows: DataFrame, dates: list[date], count: int, order: list[Column]) -> DataFrame:
    """The first `count` rows of an order that begins with the latest time, from as few dates as hold them.

    `rows` has the partition column `date` still. All rows of a date are newer than those of earlier
    dates, so the search goes down from the newest date, to twice as many each time it finds too few.
    """
    step = 1
    while True:
        found = rows.where(F.col("date") >= F.lit(dates[step - 1])) if step <= len(dates) else rows
        if step >= len(dates) or found.limit(count).count() >= count:
            return found.orderBy(*order).limit(count).drop("date")
        step = min(2 * step, len(dates))


NO_BATCH = -1
#: Commit rows that stay: the last one, and those that a reader may just be looking at.
KEPT_COMMITS = 4


def commit_batch(spark: SparkSession, root: str, batch_id: int, seen: int) -> None:
    """Say that all outputs of a batch are written, and how many rows came up to its end."""
    row = spark.createDataFrame([(seen, batch_id)], "seen long, batch_id long").coalesce(1)
    row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/commits")
    remove(spark, [f"{root}/commits/batch_id={batch_id - KEPT_COMMITS}"])


def last_commit(spark: SparkSession, root: str, before: int | None = None) -> tuple[int, int]:
    """Number of the last committed batch (before a given one) and the rows seen up to its end; (-1, 0) for none."""
    if not exists(spark, f"{root}/commits"):
        return NO_BATCH, 0
    rows = spark.read.schema("seen long, batch_id long").parquet(f"{root}/commits")
    if before is not None:
        rows = rows.where(F.col("batch_id") < before)
    found = rows.agg(F.max("batch_id").alias("batch_id"), F.max_by("seen", "batch_id").alias("seen")).first()
    return (NO_BATCH, 0) if found["batch_id"] is None else (found["batch_id"], found["seen"])


def _located(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    store, at = _located(spark, path)
    return store.exists(at)


def remove(spark: SparkSession, paths: list[str]) -> None:
    """Delete partition folders; those that are gone already are no fault."""
    for path in paths:
        store, at = _located(spark, path)
        store.delete(at, True)
