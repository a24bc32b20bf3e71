"""The subpackage's registered queries and their DuckDB SQL."""

from __future__ import annotations

from . import (centroids, decontaminate, language, mixing, neardup, periodic, quality, sharding, substrings,
               tokencounts, tokenfiles, topk, warc)

QUERIES = {
    "op1_near_dedup": neardup.op1_near_dedup,
    "op2_decontaminate": decontaminate.op2_decontaminate,
    "op3_language_id": language.op3_language_id,
    "op4_quality": quality.op4_quality,
    "op5_mixing": mixing.op5_mixing,
    "op6_top_k": topk.op6_top_k,
    "op7_warc": warc.op7_warc,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_token_ids": tokenfiles.op9_token_ids,
    "op10_sharding": sharding.op10_sharding,
    "op11_centroids": centroids.op11_centroids,
    "op12_periodic_runs": periodic.op12_periodic_runs,
    "op13_token_counts": tokencounts.op13_token_counts,
}
SQL = {
    "op1_near_dedup": neardup.OP1_SQL,
    "op2_decontaminate": decontaminate.OP2_SQL,
    "op5_mixing": mixing.OP5_SQL,
    "op6_top_k": topk.OP6_SQL,
    "op7_warc": warc.OP7_SQL,
    "op8_substring_dedup": substrings.OP8_SQL,
    "op10_sharding": sharding.OP10_SQL,
    "op11_centroids": centroids.OP11_SQL,
}
