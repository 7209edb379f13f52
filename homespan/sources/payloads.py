"""Statistics responses landed as JSON files: arrays of arrays, and nested series.

A payload file is one API response and is parsed as one row, so its size is bounded by
what one response holds; the number of files is not bounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homespan.config import CENSUS_VARIABLES, LABOUR_SERIES
from homespan.functions.text import strict_double
from homespan.schemas import LABOUR_PAYLOAD


class PayloadError(ValueError):
    """No landed payload holds usable data."""


@dataclass(frozen=True)
class Parsed:
    """Rows of the readable payloads, and the other payloads with the ``REASON`` they were set aside."""

    rows: DataFrame
    rejected: DataFrame

    def require_rows(self) -> DataFrame:
        if self.rows.isEmpty():
            reasons = [r["REASON"] for r in self.rejected.select("REASON").distinct().collect()]
            raise PayloadError("no usable payload: " + (", ".join(sorted(reasons)) or "no files"))
        return self.rows


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed file: ``PAYLOAD_FILE``, ``LANDED_AT`` (when the file last changed), ``PAYLOAD``."""
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.col("_metadata.file_path").alias("PAYLOAD_FILE"),
        F.col("_metadata.file_modification_time").alias("LANDED_AT"),
        F.col("value").alias("PAYLOAD"),
    )


def table_payloads(
    payloads: DataFrame, columns: Iterable[str] = tuple(CENSUS_VARIABLES), keep: Iterable[str] = ()
) -> Parsed:
    """Payloads whose first inner array is the header and whose others are rows, as text columns.

    Cells are taken by the position of their name in the payload's own header.
    ``keep`` names columns of ``payloads`` to carry along. The parsed body is bound once
    inside one generator, so no payload is parsed a second time to filter or locate cells.
    """
    columns, body = list(columns), F.from_json("PAYLOAD", TABLE_PAYLOAD)
    rows = payloads.select(*keep, F.inline(F.flatten(F.transform(F.array(body), lambda t: _cells(t, columns)))))
    return Parsed(rows, _rejected(payloads, F.get(F.transform(F.array(body), lambda t: _table_reason(t, columns)), F.lit(0))))


TABLE_PAYLOAD = "array<array<string>>"


def _lacking(header: Column, columns: list[str]) -> Column:
    return reduce(or_, [~F.array_contains(header, c) for c in columns])


def _cells(table: Column, columns: list[str]) -> Column:
    """The data rows of a parsed table as structs, null if it lacks rows or columns."""
    header = F.get(table, F.lit(0))
    rows = F.transform(
        F.slice(table, F.lit(2), F.size(table)),
        lambda row: F.struct(
            *[F.get(row, F.array_position(header, F.lit(c)).cast("int") - 1).alias(c) for c in columns]
        ),
    )
    return F.when((F.size(table) > 1) & ~_lacking(header, columns), rows)


def _table_reason(table: Column, columns: list[str]) -> Column:
    header = F.get(table, F.lit(0))
    return (
        F.when(table.isNull() | header.isNull(), "unreadable")
        .when(F.size(table) < 2, "no rows")
        .when(_lacking(header, columns), "header lacks columns")
    )


def series_payloads(payloads: DataFrame, keep: Iterable[str] = ()) -> Parsed:
    """Every data point of every series: ``seriesID, year, period, periodName, value`` as text.

    Payloads without points yield none by the way generators treat null and empty arrays,
    so rows need no separate check.
    """
    keep = list(keep)
    series = F.from_json("PAYLOAD", LABOUR_PAYLOAD)["Results"]["series"]
    each = payloads.select(*keep, F.explode(series).alias("S"))
    points = each.select(*keep, F.col("S.seriesID").alias("seriesID"), F.inline("S.data"))
    return Parsed(points, _rejected(payloads, F.get(F.transform(F.array(series), _series_reason), F.lit(0))))


def _series_reason(found: Column) -> Column:
    has_points = F.exists(found, lambda s: F.coalesce(F.size(s["data"]) > 0, F.lit(False)))
    return F.when(found.isNull(), "unreadable").when(~has_points, "no data")


def _rejected(payloads: DataFrame, reason: Column) -> DataFrame:
    return payloads.withColumn("REASON", reason).filter(F.col("REASON").isNotNull())


# ---- payloads opened once: rows and rejects side by side ------------------------------


def open_tables(payloads: DataFrame, columns: Iterable[str] = tuple(CENSUS_VARIABLES)) -> DataFrame:
    """Add ``REASON`` (null for a usable payload) and ``ROWS`` (array of structs) of table payloads, from one parse."""
    columns = list(columns)
    return _opened(payloads, F.from_json("PAYLOAD", TABLE_PAYLOAD), lambda t: _cells(t, columns), lambda t: _table_reason(t, columns))


def open_series(payloads: DataFrame) -> DataFrame:
    """The same for nested series; a response without series that states a status is refused, and the status named."""

    def points(body: Column) -> Column:
        return F.flatten(
            F.transform(
                body["Results"]["series"],
                lambda s: F.transform(
                    F.coalesce(s["data"], F.array()),
                    lambda p: F.struct(s["seriesID"].alias("seriesID"), *[p[c].alias(c) for c in POINT_COLUMNS]),
                ),
            )
        )

    def reason(body: Column) -> Column:
        found, status = body["Results"]["series"], body["status"]
        return F.when(found.isNull() & status.isNotNull(), F.concat(F.lit("refused: "), status)).otherwise(_series_reason(found))

    return _opened(payloads, F.from_json("PAYLOAD", f"status string, {LABOUR_PAYLOAD}"), points, reason)


POINT_COLUMNS = ("year", "period", "periodName", "value")


def _opened(payloads: DataFrame, body: Column, rows: Callable, reason: Callable) -> DataFrame:
    both = F.transform(F.array(body), lambda b: F.struct(reason(b).alias("REASON"), rows(b).alias("ROWS")))
    opened = payloads.withColumn("OPENED", F.get(both, F.lit(0)))
    told = F.col("OPENED.REASON")
    return opened.withColumns({"REASON": told, "ROWS": F.when(told.isNull(), F.col("OPENED.ROWS"))}).drop("OPENED")


def labour_table(points: DataFrame, areas: Mapping[str, str] = LABOUR_SERIES) -> DataFrame:
    """Typed monthly rates. A rate that is not a number fails the job; an unknown series keeps its id as area."""
    area = F.col("seriesID")
    for series_id, name in areas.items():
        area = F.when(F.col("seriesID") == series_id, F.lit(name)).otherwise(area)
    return points.select(
        area.alias("METRO_AREA"),
        F.col("year").try_cast("int").alias("YEAR"),
        F.col("periodName").alias("MONTH"),
        strict_double(F.col("value")).alias("UNEMPLOYMENT_RATE"),
    )
