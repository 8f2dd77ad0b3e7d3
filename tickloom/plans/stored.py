"""Dashboard queries on stored tables: the newest rows without reading what is older."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import alerts
from tickloom.plans import dashboard, maintenance
from tickloom.sources.tables import LAYOUTS, dates_of, newest_rows, space_of


@dataclass
class StoredTables:
    """The tables that the last complete `maintenance.backfill` built below `root`, laid out by `LAYOUTS`."""

    spark: SparkSession
    root: str

    def __post_init__(self):
        self.folder = maintenance.current_tables(self.spark, self.root)

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def rows(self, name: str) -> DataFrame:
        """A whole table with its partition columns."""
        return self.spark.read.parquet(self._path(name))

    def _newest(self, name: str, rows: DataFrame, count: int, *order) -> DataFrame:
        return newest_rows(rows, dates_of(self.spark, self._path(name)), count, list(order))

    def latest_price(self, benchmark: str) -> DataFrame:
        here = (F.col("benchmark") == benchmark) & (F.col("space") == space_of(F.lit(benchmark), LAYOUTS["ticks"].spaces))
        rows = self.rows("ticks").where(here)
        return dashboard.latest_price(self._newest("ticks", rows, 1, F.desc("time"), F.desc("event_id")), benchmark)

    def latest_ticks(self, count: int = 9) -> DataFrame:
        rows = self._newest("ticks", self.rows("ticks"), count, F.desc("time"), F.desc("event_id"))
        return dashboard.latest_ticks(rows, count)

    def latest_candles(self, count: int = 10) -> DataFrame:
        rows = self._newest("candles_1m", self.rows("candles_1m"), count, F.desc("time"), F.col("benchmark"))
        return dashboard.latest_candles(rows, count)

    def _newest_alerts(self, count: int) -> DataFrame:
        order = F.desc("time"), F.desc("event_id"), F.desc("rule")
        return self._newest("alerts", self.rows("alerts"), count, *order)

    def recent_alerts(self, count: int = 20) -> DataFrame:
        return dashboard.recent_alerts(self._newest_alerts(count), count)

    def alert_history(self, count: int = 100) -> DataFrame:
        return alerts.newest_alerts(self._newest_alerts(count), count)
