"""Sources: raw landing tables (declared schema) and the test-data adapter."""

from .raw import RawSources, read_raw
from .testdata import testdata_sources
from .calendar import date_spine

__all__ = ["RawSources", "read_raw", "testdata_sources", "date_spine"]
