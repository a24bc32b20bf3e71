"""Scans of the five raw sources (S1-S5) with their declared schema.

Reading with an explicit schema skips inference and lets Catalyst prune
columns and push predicates (lookback bounds, event_type) into the Parquet
scan.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..schemas import RAW_SCHEMAS
from ..session import cut_lineage
from .properties import PARSED_EVENTS, SR_ID, parsed_events

SOURCE_NAMES = tuple(RAW_SCHEMAS)


def read_raw(spark: SparkSession, landing_dir: str, name: str) -> DataFrame:
    """One raw table stored as Parquet at ``<landing_dir>/<name>``; events in the
    form they were landed in (``land``)."""
    path, schema = os.path.join(landing_dir, name), RAW_SCHEMAS[name]
    if name == "raw_events" and SR_ID in spark.read.parquet(path).columns:
        schema = PARSED_EVENTS
    return spark.read.schema(schema).parquet(path)


@dataclass
class RawSources:
    """Lazily built raw DataFrames; each attribute is a fresh logical plan."""

    loader: Callable[[str], DataFrame]

    def __getattr__(self, name: str) -> DataFrame:
        if name in RAW_SCHEMAS:
            return self.loader(name)
        raise AttributeError(name)

    def table(self, name: str) -> DataFrame:
        return self.loader(name)

    @classmethod
    def from_landing(cls, spark: SparkSession, landing_dir: str) -> "RawSources":
        return cls(lambda n: read_raw(spark, landing_dir, n))

    @classmethod
    def from_frames(cls, frames: dict) -> "RawSources":
        return cls(lambda n: frames[n])


def landed(raw: RawSources, names) -> RawSources:
    """The sources with ``names`` written once, as an ingestion lands them, so that a
    run's many steps read their columns and don't derive the tables again each time.
    Views of late or earlier rows belong on top. ``released_cuts`` bounds their time."""
    held = {name: cut_lineage(raw.table(name)) for name in names}
    return RawSources(lambda name: held[name] if name in held else raw.table(name))


# Column each landed table is range-ordered on, so that lookback predicates
# prune files and row groups by their min/max statistics.
LANDING_ORDER = {"raw_events": "event_ts", "raw_sessions": "updated_at",
                 "service_requests": "updated_at", "raw_pro_profiles": "updated_at",
                 "raw_payments": "updated_at"}


def land(raw: RawSources, landing_dir: str, files_per_table: int | None = None,
         parse_properties: bool = False) -> None:
    """Write raw sources as Parquet with the declared schema (an ingestion
    step): range-partitioned on the table's update time. With
    ``parse_properties`` events land with their JSON parsed (``PARSED_EVENTS``)."""
    for name, schema in RAW_SCHEMAS.items():
        df = raw.table(name).select(*[f.name for f in schema.fields])
        if parse_properties and name == "raw_events":
            df = parsed_events(df)
        order = LANDING_ORDER[name]
        df = (df.repartitionByRange(files_per_table, order) if files_per_table
              else df.repartitionByRange(order))
        df.sortWithinPartitions(order).write.mode("overwrite").parquet(
            os.path.join(landing_dir, name))
