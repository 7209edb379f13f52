"""Counts that make loads and cleaning checkable."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from homespan.functions.text import MISSING, to_day
from homespan.operators.layers import MEASURES

AUDITED: Mapping[str, Callable[[Column], Column]] = {**MEASURES, "PERIOD_END": to_day}
COUNTS = ("PRESENT", "MARKED_MISSING", "UNREADABLE")
AUDIT_SQL = "SOURCE string, COLUMN_NAME string, ROW_COUNT long, PRESENT long, MARKED_MISSING long, UNREADABLE long"


def row_counts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One row per source: ``SOURCE``, ``ROW_COUNT``."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("ROW_COUNT")).select(F.lit(name).alias("SOURCE"), "ROW_COUNT")
        for name, df in sources.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), counts)


def _counts(name: str, parse: Callable[[Column], Column]) -> list[Column]:
    """Cells present, cells marked missing, and cells whose text could not be read."""
    text = F.col(name)
    marked = text == MISSING
    unreadable = text.isNotNull() & ~marked & parse(text).isNull()
    return [F.count(text), F.count_if(marked), F.count_if(unreadable)]


def cleaning_counts(bronze: DataFrame, columns: Mapping[str, Callable[[Column], Column]] = MEASURES) -> DataFrame:
    """Per measure (or other column, with how it is read): present, marked missing and unreadable cells."""
    sums = []
    for name, parse in columns.items():
        told = [count.alias(c) for count, c in zip(_counts(name, parse), COUNTS, strict=True)]
        sums.append(F.struct(F.lit(name).alias("MEASURE"), *told).alias(name))
    return bronze.agg(*sums).select(F.inline(F.array(*[F.col(n) for n in columns])))


def watched(bronze: DataFrame, source: str) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The same rows, and what to ask, once a job has run over all of them, for the counts that job took on its way.

    Use it in a job without a shuffle (such as cleaning and writing silver): a task that runs again after a
    shuffle was lost would count twice.
    """
    seen = Observation()
    told = [
        count.alias(f"{c}:{name}")
        for name, parse in AUDITED.items()
        for count, c in zip(_counts(name, parse), COUNTS, strict=True)
    ]
    rows = bronze.observe(seen, F.count(F.lit(1)).alias("rows"), *told)

    def counts() -> DataFrame:
        found = seen.get
        lines = [(source, name, found["rows"], *[found[f"{c}:{name}"] for c in COUNTS]) for name in AUDITED]
        return bronze.sparkSession.createDataFrame(lines, AUDIT_SQL)

    return rows, counts


def feed_counts(spark: SparkSession, feeds: Mapping[str, DataFrame], sources: list[str]) -> DataFrame:
    """Rows and cells of every feed in one pass over all of them, a line per source and audited column.

    Sources without a feed and feeds without rows have zeros; a column that a feed lacks is never present.
    """
    wanted = spark.createDataFrame([(s, n, s in feeds) for s in sources for n in AUDITED], "SOURCE string, COLUMN_NAME string, LANDED boolean")
    if not feeds:
        found = spark.createDataFrame([], AUDIT_SQL)
    else:
        cells = [
            df.select(F.lit(source).alias("SOURCE"), *[(F.col(n) if n in df.columns else F.lit(None).cast("string")).alias(n) for n in AUDITED])
            for source, df in feeds.items()
        ]
        told = []
        for name, parse in AUDITED.items():
            counts = [count.alias(c) for count, c in zip(_counts(name, parse), COUNTS, strict=True)]
            told.append(F.struct(F.lit(name).alias("COLUMN_NAME"), *counts).alias(name))
        sums = reduce(DataFrame.unionByName, cells).groupBy("SOURCE").agg(F.count(F.lit(1)).alias("ROW_COUNT"), *told)
        found = sums.select("SOURCE", "ROW_COUNT", F.inline(F.array(*[F.col(n) for n in AUDITED])))
    joined = wanted.join(found, ["SOURCE", "COLUMN_NAME"], "left").fillna(0, ["ROW_COUNT", *COUNTS])
    return joined.select("SOURCE", "LANDED", "COLUMN_NAME", "ROW_COUNT", *COUNTS)
