"""Table upkeep: insert-or-ignore, retention, compaction, storage report, models, backfill."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timedelta
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickloom.functions.columns import moment, start_of
from tickloom.operators import alerts, candles, returns
from tickloom.plans import marts, staging
from tickloom.session import lookup, written
from tickloom.sources.tables import (
    LAYOUTS,
    Layout,
    arranged,
    exists,
    first_day,
    read_batches,
    read_table,
    remove,
    write_table,
)

RETAINED_DAYS, COMPACT_AFTER_DAYS = 30, 7


def insert_ignore(
    incoming: DataFrame, stored: DataFrame, keys: list[str] | None = None, order_by=("event_id",)
) -> DataFrame:
    """Rows to append. Without keys nothing can collide, so that is all of them.

    With keys the first row of each key counts. Both sides shrink to one row per key before they
    meet, so copies cause no skew. With a time among the keys only stored rows of the incoming rows'
    span are looked at.
    """
    if not keys:
        return incoming
    if "time" in keys:
        span = incoming.agg(F.min("time").cast("string").alias("low"), F.max("time").cast("string").alias("high")).first()
        kind = stored.schema["time"].dataType
        low, high = (F.lit(span[c]).cast(kind) for c in ("low", "high"))
        stored = stored.where(F.col("time").between(low, high) | F.col("time").isNull())
    known = stored.select(*keys).distinct()
    return marts.distinct_on(incoming, keys, order_by).join(known, keys, "left_anti")


def retained_ticks(ticks: DataFrame, as_of: datetime, days: int = RETAINED_DAYS) -> DataFrame:
    return ticks.where(F.col("time") >= moment(ticks, "time", as_of - timedelta(days=days)))


def drop_expired(
    spark: SparkSession, table: str, as_of: datetime, days: int = RETAINED_DAYS, layout: Layout = Layout(1)
) -> list[str]:
    """Drop the date partitions of a catalog table that lie wholly before the retained days.

    A partition of `layout` is named by its first day and holds `layout.days` days; it goes when its
    last day has passed.
    """
    cutoff = (as_of - timedelta(days=days)).date()
    names = spark.sql(f"SHOW PARTITIONS {table}")  # one name per partition
    named = names.select(F.regexp_extract("partition", r"(?:^|/)date=([0-9-]+)", 1).alias("date")).distinct()
    last = F.date_add(F.to_date("date"), layout.days - 1)
    expired = [row["date"] for row in named.where(last < F.lit(cutoff)).orderBy("date").collect()]
    for day in expired:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (date = '{day}')")
    return expired


LEDGER = "date date, run long, last_batch long"


def ledger(spark: SparkSession, target: str) -> DataFrame:
    """Per date that was compacted: the run that holds its rows, and the last batch they were taken from.

    One row per date and run; of a date's runs the newest counts.
    """
    path = f"{target.rstrip('/')}-ledger"
    if not exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(LEDGER).parquet(path)
    return rows.groupBy("date").agg(F.max("run").alias("run"), F.max("last_batch").alias("last_batch"))


def _untaken(spark: SparkSession, source: str, schema: StructType, known: DataFrame, until: int | None) -> DataFrame:
    """Rows of batches that no compaction took: told by date and batch, both partition columns."""
    taken = known.select(F.col("date").alias("taken_date"), "last_batch")
    stored = read_batches(spark, source, schema, until)
    joined = stored.join(taken, F.col("date") == F.col("taken_date"), "left")
    return joined.where(F.col("last_batch").isNull() | (F.col("batch_id") > F.col("last_batch"))).drop("taken_date", "last_batch")


def _cold(spark: SparkSession, target: str, schema: StructType, layout: Layout, known: DataFrame) -> DataFrame:
    """The compacted rows: of each date those of the run that counts."""
    full = StructType([*schema.fields]).add("date", "date")
    if layout.spaces:
        full = full.add("space", "integer")
    if not exists(spark, target):
        return spark.createDataFrame([], full)
    return spark.read.schema(full.add("run", "long")).parquet(target).join(known.select("date", "run"), ["date", "run"], "left_semi")


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType,
    as_of: datetime,
    until: int | None = None,
    layout: Layout = LAYOUTS["ticks"],
) -> int | None:
    """Rewrite dates older than seven days from small batch files into clustered, sorted files.

    A run takes the dates that have rows which no earlier run took, late ones too, and writes each such
    date whole, with what earlier runs had of it, to folders of its own. The ledger then names the run
    for these dates: that one write makes it count. A run that failed before leaves nothing that a reader
    sees; runs are numbered by the clock, so its number never comes again. After that, `sweep` removes
    what the run replaced. `until` is the last committed batch; batches have to be stored by `layout`'s
    days. Returns the run's number, or None if there was nothing to do.
    """
    known = lookup(ledger(spark, target))
    old = _untaken(spark, source, schema, known, until).where(F.col("date") < F.lit(_cold_until(as_of, layout)))
    # metadata: one row per date
    due = lookup(old.groupBy("date").agg(F.max("batch_id").alias("last_batch")))
    if due.isEmpty():
        return None
    newest = known.agg(F.max("run").alias("run")).first()["run"]
    run = max(time.time_ns() // 1000, -1 if newest is None else newest + 1)
    before = _cold(spark, target, schema, layout, known).join(due.select("date"), "date", "left_semi")
    # batches that arrive meanwhile are left to the next run
    taken = old.join(due.withColumnRenamed("last_batch", "newest"), "date").where(F.col("batch_id") <= F.col("newest"))
    rows = taken.select(*schema.names).unionByName(before.select(*schema.names))
    writer = arranged(rows, layout).withColumn("run", F.lit(run).cast("long")).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*layout.partitions, "run").parquet(target)
    entries = due.select("date", F.lit(run).cast("long").alias("run"), "last_batch").coalesce(1)
    entries.write.mode("append").parquet(f"{target.rstrip('/')}-ledger")
    sweep(spark, source, target, layout)
    return run


def sweep(spark: SparkSession, source: str, target: str, layout: Layout = LAYOUTS["ticks"]) -> None:
    """Remove the batch folders that the ledger has taken and the runs that a newer one replaced.

    It may be run at any time: readers go by the ledger. Folder names come to the driver, not rows.
    """
    known = ledger(spark, target)
    hot = spark.read.schema("date date, batch_id long").parquet(source).distinct().join(known, "date")
    gone = [f"{source}/date={r['date']}/batch_id={r['batch_id']}" for r in hot.where("batch_id <= last_batch").collect()]
    names = [*layout.partitions, "run"]
    forms = {"date": "date date", "space": "space int", "run": "run long"}
    cold = spark.read.schema(", ".join(forms[n] for n in names)).parquet(target).distinct()
    newest = known.select("date", F.col("run").alias("newest"))
    for r in cold.join(newest, "date").where("run < newest").collect():
        gone.append(f"{target}/" + "/".join(f"{n}={r[n]}" for n in names))
    remove(spark, gone)


def _cold_until(as_of: datetime, layout: Layout):
    return first_day(as_of - timedelta(days=COMPACT_AFTER_DAYS), layout.days)


def read_hot_and_cold(
    spark: SparkSession,
    source: str,
    target: str,
    schema: StructType,
    until: int | None = None,
    layout: Layout = LAYOUTS["ticks"],
    origin: str | None = None,
) -> DataFrame:
    """All rows once, whenever it is called: compacted ones, and those of batches that no compaction took.

    A column named by `origin` says which: cold or hot.
    """
    known = ledger(spark, target)
    hot = _untaken(spark, source, schema, known, until).select(*schema.names)
    cold = _cold(spark, target, schema, layout, known).select(*schema.names)
    if origin:
        hot, cold = hot.withColumn(origin, F.lit("hot")), cold.withColumn(origin, F.lit("cold"))
    return hot.unionByName(cold)


def storage_report(spark: SparkSession, path: str) -> DataFrame:
    """Number and size of files per date; reads file listings, not contents."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    day = F.regexp_extract("path", r"date=([0-9-]+)", 1).alias("date")
    return files.groupBy(day).agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


def compaction_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two storage reports side by side: files and bytes per date before and after compaction."""
    sides = [
        report.select("date", F.col("files").alias(f"files_{side}"), F.col("bytes").alias(f"bytes_{side}"))
        for side, report in (("before", before), ("after", after))
    ]
    return sides[0].join(sides[1], "date", "left")


@dataclass(frozen=True)
class Model:
    """A report that is rebuilt from others: what it reads, and whether it is a view or a table."""

    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    view: bool = False


SOURCE = "ticks"


def models(as_of: datetime) -> dict[str, Model]:
    return {
        "spread_analysis": Model(("stg_ticks",), marts.spread_analysis),
        "daily_analytics": Model(("stg_ticks",), marts.daily_analytics),
        "stg_ticks": Model((SOURCE,), lambda ticks: staging.stg_ticks(ticks, as_of), view=True),
    }


def build_order(known: dict[str, Model]) -> list[str]:
    """Models after all that they read."""
    order = TopologicalSorter({name: model.inputs for name, model in known.items()}).static_order()
    return [name for name in order if name in known]


def build_models(ticks: DataFrame, as_of: datetime, prefix: str = "", location: str | None = None) -> list[str]:
    """Publish all models in the order of their inputs: views as views, the others as rebuilt tables."""
    spark, known = ticks.sparkSession, models(as_of)
    order = build_order(known)
    for name in order:
        rows = known[name].build(*[ticks if i == SOURCE else spark.table(f"{prefix}{i}") for i in known[name].inputs])
        if known[name].view:
            rows.createOrReplaceTempView(f"{prefix}{name}")
            continue
        writer = rows.write.mode("overwrite")
        if location:
            writer = writer.option("path", f"{location}/{name}")
        writer.saveAsTable(f"{prefix}{name}")
    return order


def backfill(lake_ticks: DataFrame, root: str) -> str:
    """Rebuild all derived tables from stored ticks, with the same operators as the stream.

    The tables are written to a new folder below `root`, and one row then makes that folder the current
    one, so readers see all old tables or all new ones. Returns the folder. The scans behind alerts and
    volatility are run once: clustering reads its rows twice, to cut the ranges and to deal them out.
    """
    spark, version = lake_ticks.sparkSession, time.time_ns() // 1000
    here = f"{root}/tables-{version}"
    write_table(lake_ticks, f"{here}/ticks", LAYOUTS["ticks"], "overwrite", whole=True)
    stored = read_table(spark, f"{here}/ticks", lake_ticks.schema, LAYOUTS["ticks"])
    kind = stored.schema["time"].dataType
    write_table(candles.candles_1m(stored), f"{here}/candles_1m", LAYOUTS["candles_1m"], "overwrite", whole=True)
    five = candles.candles_5m(stored)
    timed = five.withColumn("time", F.timestamp_millis("window_start").cast(kind))
    write_table(timed, f"{here}/candles_5m", LAYOUTS["candles_5m"], "overwrite", whole=True)
    raised = written(alerts.alerts_all(stored), "alerts")
    write_table(raised, f"{here}/alerts", LAYOUTS["alerts"], "overwrite", whole=True)
    sampled = returns.volatility_sampled(stored).select("time", "benchmark", "rolling_std_30")
    hours = returns.realized_vol(stored).select("benchmark", F.col("window_end").cast(kind).alias("_end"), "realized_vol")
    # the hour that ended last: one row per benchmark and five minutes
    ended = sampled.withColumn("_end", start_of("time", returns.PANE_SECONDS).cast(kind))
    measured = ended.join(hours, ["benchmark", "_end"], "left").drop("_end")
    write_table(written(measured, "volatility"), f"{here}/volatility", LAYOUTS["volatility"], "overwrite", whole=True)
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").parquet(f"{root}/current")
    return here


def current_tables(spark: SparkSession, root: str) -> str:
    """The folder of the last backfill that was completed."""
    version = spark.read.schema("version long").parquet(f"{root}/current").agg(F.max("version")).first()[0]
    return f"{root}/tables-{version}"
