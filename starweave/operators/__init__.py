"""Reusable DataFrame operators."""

from .dedup import first_per_group, latest_per_key
from .joins import lookup_join, sized_broadcast, assert_unique_keys
from .merge import insert_new_members, new_members, upsert
from .scd2 import close_versions, scd2_apply, scd2_upserts
from .sequence import sequence_within_group

__all__ = ["first_per_group", "latest_per_key", "lookup_join", "sized_broadcast",
           "assert_unique_keys", "insert_new_members", "new_members", "upsert", "scd2_apply", "scd2_upserts",
           "close_versions", "sequence_within_group"]
