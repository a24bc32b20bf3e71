"""Full build: every model from the raw sources, as one lazy DAG."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from ..sources.raw import RawSources
from . import dims, facts

BUILD_ORDER = ["dim_date", "dim_category", "dim_geography", "dim_session", "dim_pro",
               "dim_service_request", "fct_booking_events", "fct_session_events",
               "fct_booking_funnel", "fct_revenue"]


def default_run_ts() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


class Models:
    """Lazily constructed model DataFrames over one set of raw sources.

    ``overrides`` replaces an upstream model (e.g. with a table read back from
    the warehouse) so downstream models read the materialised version.
    """

    def __init__(self, spark: SparkSession, raw: RawSources, run_ts=None,
                 overrides: dict | None = None):
        self.spark, self.raw = spark, raw
        self.run_ts = run_ts or default_run_ts()
        self._cache: dict[str, DataFrame] = dict(overrides or {})

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = getattr(self, f"_build_{name}")()
        return self._cache[name]

    def _build_dim_date(self):
        return dims.dim_date(self.spark, self.run_ts)

    def _build_dim_category(self):
        return dims.dim_category(self.raw.service_requests, self.run_ts)

    def _build_dim_geography(self):
        return dims.dim_geography(self.raw.service_requests, self.run_ts)

    def _build_dim_session(self):
        return dims.dim_session(self.raw.raw_sessions, self.run_ts)

    def _build_dim_pro(self):
        return dims.dim_pro(self.raw.raw_pro_profiles, self.run_ts)

    def _build_dim_service_request(self):
        return dims.dim_service_request(self.raw.service_requests, self["dim_category"],
                                        self["dim_geography"], self.run_ts)

    def _build_fct_booking_events(self):
        return facts.fct_booking_events(self.raw.raw_events, self.run_ts)

    def _build_fct_session_events(self):
        return facts.fct_session_events(self.raw.raw_events, self["dim_session"], self.run_ts)

    def _build_fct_booking_funnel(self):
        return facts.fct_booking_funnel(self.raw.service_requests, self["dim_category"],
                                        self["dim_geography"], self["dim_service_request"],
                                        self["fct_booking_events"], self["dim_session"],
                                        self["dim_pro"], self.run_ts)

    def stored(self, name: str) -> tuple[DataFrame, str | None]:
        """A model as the warehouse stores it, and the form that is (``warehouse.FORMS``)."""
        if name == "fct_revenue" and name not in self._cache:
            return facts.stored_revenue(*self._revenue_sources()), "revenue"
        return self[name], None

    def _revenue_sources(self):
        return (self.raw.raw_payments, self.raw.service_requests, self["dim_category"], self["dim_geography"],
                self["dim_service_request"], self["dim_pro"], self.run_ts)

    def _build_fct_revenue(self):
        return facts.fct_revenue(*self._revenue_sources())

    def _build_session_funnel(self):
        return facts.session_funnel(self.raw.raw_events, self.raw.raw_sessions,
                                    self.raw.service_requests, self.raw.raw_pro_profiles)
