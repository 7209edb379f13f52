"""Landed payloads as a stored table: usable rows and rejects from one parse, counted while they are written.

The table keeps one record for each row of a usable payload, and one with the reason and the text of each payload that was
set aside, in a partition of its own. A response that landed again, whole or corrected, adds records; ``latest`` picks
what landed last for each key.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homespan.sources.payloads import PayloadError
from homespan.sources.tables import Written
from homespan.sources.versions import published, replace_table

PLACE_KEYS = ("state", "place")
POINT_KEYS = ("seriesID", "year", "period")
ORDER = ("LANDED_AT", "PAYLOAD_FILE", "POSITION")
ABOUT = ("PAYLOAD_FILE", "LANDED_AT", "POSITION")
NAMED = 20


@dataclass(frozen=True)
class Landed:
    """Records of usable payloads, the payloads set aside, and how many there were of each."""

    rows: DataFrame
    rejected: DataFrame
    accepted_payloads: int
    rejected_payloads: int
    row_count: int
    written: Written


def records(opened: DataFrame) -> DataFrame:
    """One record per row of a usable payload and per payload set aside; the text is kept of the latter."""
    each = opened.select(
        "PAYLOAD_FILE", "LANDED_AT", "REASON", F.when(F.col("REASON").isNotNull(), F.col("PAYLOAD")).alias("PAYLOAD"),
        F.posexplode_outer("ROWS").alias("POSITION", "ROW"),
    )
    return each.select(*ABOUT, "REASON", "PAYLOAD", "ROW.*", F.col("REASON").isNotNull().alias("REJECTED"))


AUDITS = {
    "accepted": lambda: F.count_if(~F.col("REJECTED") & (F.col("POSITION") == 0)),
    "rejected": lambda: F.count_if("REJECTED"),
}


def land(opened: DataFrame, path: str, fmt: str = "parquet", allowed: int | None = None) -> Landed:
    """Store the records of opened payloads.

    More than ``allowed`` rejects, or no usable row at all, is an error that names files and reasons and leaves the stored
    table as it was. None allows any number.
    """

    def check(written: Written) -> None:
        rejected = int(written.metrics["rejected"])
        if (allowed is not None and rejected > allowed) or written.rows == rejected:
            raise PayloadError(_complaint(published(opened.sparkSession, written), rejected, allowed))

    audits = {name: made() for name, made in AUDITS.items()}
    written = replace_table(records(opened), path, fmt, ("REJECTED",), audits=audits, check=check)
    table = published(opened.sparkSession, written)
    accepted, rejected = (int(written.metrics[name]) for name in ("accepted", "rejected"))
    rows = table.filter("NOT REJECTED").drop("REJECTED", "REASON", "PAYLOAD")
    aside = table.filter("REJECTED").select("PAYLOAD_FILE", "LANDED_AT", "REASON", "PAYLOAD")
    return Landed(rows, aside, accepted, rejected, written.rows - rejected, written)


def _complaint(table: DataFrame, rejected: int, allowed: int | None) -> str:
    if not rejected:
        return "no usable payload: no files"
    some = table.filter("REJECTED").select("PAYLOAD_FILE", "REASON").orderBy("PAYLOAD_FILE").limit(NAMED).collect()
    names = ", ".join(f"{(r['PAYLOAD_FILE'] or '').rsplit('/', 1)[-1]} ({r['REASON']})" for r in some)
    limit = "no usable payload" if allowed is None or rejected <= allowed else f"{allowed} allowed"
    return f"{rejected} payloads set aside, {limit}: {names}"


def latest(rows: DataFrame, keys: Sequence[str], order: Iterable[str] = ORDER) -> DataFrame:
    """For each key the row that landed last, by time, then file, then place in it; ``order`` columns are dropped.

    Folded map-side, so a response that landed many times sends one row per key and task. Rows that lack a part of the
    key cannot be told apart and stay as they are.
    """
    order = [c for c in order if c in rows.columns]
    values = [c for c in rows.columns if c not in keys and c not in order]
    unkeyed = reduce(or_, [F.col(k).isNull() for k in keys])
    alone: Column = F.when(unkeyed, F.struct(*order)).alias("ALONE")
    newest = F.max_by(F.struct(*values), F.struct(*order)).alias("NEWEST") if values else F.lit(1).alias("NEWEST")
    found = rows.groupBy(*keys, alone).agg(newest)
    return found.select(*[F.col(f"NEWEST.{c}").alias(c) if c in values else F.col(c) for c in rows.columns if c not in order])
