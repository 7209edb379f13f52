"""Tab-delimited market feeds, one file per geographic grain."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homespan.config import FEED_FILES


def read_feed(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    sep: str = "\t",
    spread: bool = False,
) -> DataFrame:
    """All columns as text, named by the header row; ``.gz`` files are decompressed by suffix.

    With a declared ``schema`` no header pre-read is needed, and a header that differs fails.
    One gzip file is read by one task. Filter first and spread after where possible
    (``write_table`` does so); ``spread`` rebalances here for callers that keep every row.
    """
    reader = spark.read.option("header", True).option("sep", sep)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    feed = reader.csv(path)
    return feed.hint("rebalance") if spread else feed


def read_feeds(
    spark: SparkSession,
    folder: str,
    files: Mapping[str, str] = FEED_FILES,
    grains: Iterable[str] | None = None,
    schema: T.StructType | None = None,
) -> dict[str, DataFrame]:
    """Grain name to feed, for all grains or the ones asked for."""
    wanted = list(files) if grains is None else list(grains)
    return {grain: read_feed(spark, f"{folder.rstrip('/')}/{files[grain]}", schema) for grain in wanted}


def union_feeds(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """One frame over all grains with a ``GRAIN`` tag; columns a feed lacks are null."""
    tagged = [df.withColumn("GRAIN", F.lit(grain)) for grain, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
