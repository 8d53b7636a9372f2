"""JSON records and generic maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_record(*columns: Column | str) -> Column:
    """One JSON object per row from the named columns."""
    return F.to_json(F.struct(*columns))


def record_map(json: Column, value_type: str = "string") -> Column:
    """A JSON object as a map with values of one type."""
    return F.from_json(json, f"map<string,{value_type}>")


def merge_maps(left: Column, right: Column) -> Column:
    """Union of two maps; on a shared key the right one wins.

    Written without ``map_concat`` so it does not depend on the session's duplicate-key policy.
    """
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)
