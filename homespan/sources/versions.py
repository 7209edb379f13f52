"""Replacing a stored table without a moment in which it is absent or half there.

A new version is written into a folder of its own beside the old one, read back and checked, and only then does a small
pointer file name it; ``read_table`` follows the pointer. A run that dies before leaves the old version in place, and the
leftover folder goes with a later replacement. The version before the current one is kept for frames that still read it.
One writer at a time replaces a table.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Mapping
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession

from homespan.sources.files import POINTER, drop_folder, folders, read_text, replace_text
from homespan.sources.tables import Written, read_table, verify_table, write_table

PREFIX = "v-"


def replace_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Iterable[str] = (),
    order_by: Iterable[str] = (),
    rebalance: bool = True,
    audits: Mapping[str, Column] | None = None,
    check: Callable[[Written], None] | None = None,
) -> Written:
    """Write, verify, check, and switch. ``check`` may refuse what was written by raising: the old version then stays."""
    spark, base = df.sparkSession, path.rstrip("/")
    version = f"{PREFIX}{time.time_ns():020d}-{uuid4().hex[:8]}"
    written = write_table(df, f"{base}/{version}", fmt, partition_by, rebalance, order_by, audits=audits)
    verify_table(spark, written)
    if check is not None:
        check(written)
    before = read_text(spark, f"{base}/{POINTER}")
    replace_text(spark, f"{base}/{POINTER}", version)
    for name in folders(spark, base):
        if name.startswith(PREFIX) and name < (before or version).strip():
            drop_folder(spark, f"{base}/{name}")
    return written


def published(spark: SparkSession, written: Written) -> DataFrame:
    """The rows of a written version, with the columns and types that were written."""
    return read_table(spark, written.path, written.fmt, written.schema).select(*written.schema.names)
