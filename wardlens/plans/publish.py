"""Publish indicators to a table whose reporting periods are replaced atomically.

A rerun for the same (start, end) replaces exactly that period's rows and
leaves every other period — including overlapping ones — untouched.

Each publish writes the rows into a folder of its own and then makes it the
period's live folder in one step (``wardlens.sources.versions``): a reader sees
the old rows or the new ones, never none or both, and a failed computation
changes nothing. Two writers of one period cannot both win; writers of different
periods do not disturb each other. ``sweep_published`` removes folders that are
no longer live.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlens import schemas
from wardlens.plans.indicators import INDICATOR_COLUMNS, validate_period
from wardlens.sources.versions import VersionedTable


def period_name(start: dt.date, end: dt.date) -> str:
    return f"{start.isoformat()}_{end.isoformat()}"


def publish_indicators(indicators: DataFrame, root: str, start: dt.date, end: dt.date) -> str:
    """Replace the rows of period (start, end) under ``root``; returns their
    folder. Rows of any other period are an error, and change nothing."""
    return publish_periods(indicators, root, [(start, end)])


def publish_periods(indicators: DataFrame, root: str,
                    periods: list[tuple[dt.date, dt.date]]) -> str:
    """Replace the rows of several periods in one step: readers see all of the
    new rows or none. A period without rows is published as empty."""
    for start, end in periods:
        validate_period(start, end)
    spark = indicators.sparkSession
    table = VersionedTable(spark, root)
    base = table.newest()
    rows = indicators.select(*INDICATOR_COLUMNS)
    folder = table.new_folder()
    name = F.concat_ws("_", "ReportingPeriodStart", "ReportingPeriodEnd")
    rows.withColumn("period", name).repartition("period").write.partitionBy("period").parquet(
        table.path(folder))
    names = [period_name(*p) for p in periods]
    written = {n.removeprefix("period=") for n, _ in table._names(table.path(folder))
               if n.startswith("period=")}
    if not written <= set(names):
        where, files = table._at(table.path(folder))
        files.delete(where, True)
        raise ValueError(f"the indicators hold rows of a period other than {', '.join(names)}")
    # A period without rows is live with no folder of its own.
    table.commit(base, {n: f"{folder}/period={n}" if n in written else f"{folder}/_none"
                        for n in names})
    return table.path(folder)


def read_indicators(spark: SparkSession, root: str, start: dt.date | None = None,
                    end: dt.date | None = None) -> DataFrame:
    """Read the published table; a period that is asked for is found by name,
    so only its folder is listed and read."""
    table = VersionedTable(spark, root)
    live = {p: f for p, f in table.parts().items() if not f.endswith("/_none")}
    wanted = [p for p in live if (start is None or p.split("_")[0] == start.isoformat())
              and (end is None or p.split("_")[1] == end.isoformat())]
    schema = schemas.QUALITY_INDICATORS
    if not wanted:
        return spark.createDataFrame([], schema).select(*INDICATOR_COLUMNS)
    return spark.read.schema(schema).parquet(
        *sorted(table.path(live[p]) for p in wanted)).select(*INDICATOR_COLUMNS)


def sweep_published(spark: SparkSession, root: str,
                    older_than: dt.timedelta = dt.timedelta(days=1)) -> int:
    """Delete folders that are no longer live and older than any reader."""
    return VersionedTable(spark, root).sweep(older_than.total_seconds())
