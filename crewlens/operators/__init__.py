"""Relational operators. They take column names, so they work on any table."""

from crewlens.operators.bitmaps import IdSet, id_bitmaps
from crewlens.operators.groups import (
    child_rollup,
    distinct_list,
    explode_keep,
    first_per_group,
    ordered_text,
    rollup,
    top_n_per_group,
)
from crewlens.operators.joins import HotKeys, lookup_join, merge_on_key, plan_bytes
from crewlens.operators.sets import stack, union_tenants

__all__ = [
    "HotKeys",
    "IdSet",
    "child_rollup",
    "distinct_list",
    "explode_keep",
    "first_per_group",
    "id_bitmaps",
    "lookup_join",
    "merge_on_key",
    "ordered_text",
    "plan_bytes",
    "rollup",
    "stack",
    "top_n_per_group",
    "union_tenants",
]
