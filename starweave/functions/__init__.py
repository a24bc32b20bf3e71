"""Column expressions (all built-in Catalyst expressions; no UDFs)."""

from .flags import flag, is_in_flag, bool_flag, notnull_flag
from .json import field_text, json_text, variant_text
from .keys import hash_key, surrogate_key, ts_text
from .time import date_key, lookback, seconds_between, to_day

__all__ = ["flag", "is_in_flag", "bool_flag", "notnull_flag", "field_text", "json_text",
           "variant_text", "hash_key", "surrogate_key", "ts_text", "date_key", "lookback", "seconds_between", "to_day"]
