"""Layer tables by path: read, overwrite, verify, name for SQL, preview, and cut lineage."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homespan.schemas import schema_differences
from homespan.sources.files import current_path

CHECKPOINT_DIR = "spark.checkpoint.dir"


class TableMismatch(RuntimeError):
    """What was read back is not what was written."""


@dataclass(frozen=True)
class Written:
    path: str
    fmt: str
    rows: int
    schema: T.StructType
    partition_by: tuple[str, ...] = ()
    metrics: Mapping[str, object] = field(default_factory=dict)


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None
) -> DataFrame:
    """A stored table, in its current version. A declared schema also types partition columns, which are only text in paths."""
    reader = spark.read.format(fmt)
    return (reader if schema is None else reader.schema(schema)).load(current_path(spark, path))


def sort_columns(order_by: Iterable[str]) -> list[Column]:
    """Column names to sort by; ``-NAME`` is descending. Nulls count as lowest."""
    return [F.desc(name[1:]) if name.startswith("-") else F.asc(name) for name in order_by]


def write_table(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Iterable[str] = (),
    rebalance: bool = True,
    order_by: Iterable[str] = (),
    files: int | None = None,
    audits: Mapping[str, Column] | None = None,
) -> Written:
    """Replace the whole target. Rows, and ``audits`` over them, are counted by the write job itself, not by a second pass.

    The rebalance hint lets AQE split large and merge small output partitions, which also
    spreads what came from one unsplittable file. With ``order_by`` rows are dealt by ranges instead (``files`` of them,
    or as many as suit) and sorted within, so that the files in order of their names hold the rows in order. Counts are
    taken after the last shuffle, where a task that runs again does not count twice.
    """
    keys, order = list(partition_by), list(order_by)
    seen = Observation()
    if order:
        columns = sort_columns([*keys, *order])
        spread = df.repartitionByRange(files, *columns) if files else df.repartitionByRange(*columns)
        out = spread.sortWithinPartitions(*columns)
    else:
        out = df.hint("rebalance", *keys) if rebalance else df
    told = [column.alias(name) for name, column in (audits or {}).items()]
    out = out.observe(seen, F.count(F.lit(1)).alias("rows"), *told)
    writer = out.write.format(fmt).mode("overwrite")
    if keys:
        writer = writer.partitionBy(*keys)
    writer.save(path)
    metrics = dict(seen.get)
    return Written(path, fmt, metrics.pop("rows"), df.schema, tuple(keys), metrics)


def verify_table(spark: SparkSession, written: Written) -> DataFrame:
    """Read back, compare schema and row count with what was written, and return the table."""
    stored = read_table(spark, written.path, written.fmt)
    in_files = T.StructType([f for f in written.schema if f.name not in written.partition_by])
    lines = schema_differences(stored, in_files)
    if not lines:
        stored = read_table(spark, written.path, written.fmt, written.schema)
        found = stored.count()
        if found != written.rows:
            lines.append(f"{found} rows instead of {written.rows}")
    if lines:
        raise TableMismatch(f"{written.path}: " + "; ".join(lines))
    return stored.select(*written.schema.names)


def open_view(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """Name a stored table for SQL in this session."""
    read_table(spark, path, fmt).createOrReplaceTempView(name)
    return spark.table(f"`{name.replace('`', '``')}`")


def name_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def publish_view(spark: SparkSession, path: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A view in the catalog over the stored table's current version, for every session that shares the catalog.

    It names a version, so publish again after the table was replaced.
    """
    quoted, folder = name.replace("`", "``"), current_path(spark, path).replace("`", "``")
    spark.sql(f"CREATE OR REPLACE VIEW `{quoted}` AS SELECT * FROM {fmt}.`{folder}`")
    return spark.table(f"`{quoted}`")


def preview(df: DataFrame, keys: Iterable[str], n: int = 10) -> DataFrame:
    """The first ``n`` rows by key, so that the same rows come back each time."""
    return df.orderBy(*keys).limit(n)


def _shared_checkpoint_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get(CHECKPOINT_DIR, None)
        if folder is None:
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that the driver and all executors share")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Compute a frame once into the shared checkpoint folder.

    For frames that a plan reads more than once with different columns, where exchange
    reuse cannot help. What is stored is as large as the frame.
    """
    _shared_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialize_by(df: DataFrame, *partition_by: str) -> DataFrame:
    """Compute a frame once into a table in the shared checkpoint folder, partitioned so that later filters prune files."""
    path = f"{_shared_checkpoint_dir(df.sparkSession)}/by-{uuid4().hex}"
    written = write_table(df, path, partition_by=partition_by)
    return read_table(df.sparkSession, path, schema=written.schema).select(*df.columns)
