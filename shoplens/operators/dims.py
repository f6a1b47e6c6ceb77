"""DIM1: the latest user row per id (last change wins)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoplens.operators.keyed import latest_by_key


#: What orders a user's versions: their own number where the feed has one, else when and where their messages stand.  An
#: offset alone is no order, as a topic has several partitions.
VERSION_ORDER = ("seq", "timestamp", "partition", "offset")


def version_order(columns: list[str]) -> tuple[str, ...]:
    return tuple(c for c in VERSION_ORDER if c in columns)


def latest_users(user_changes: DataFrame) -> DataFrame:
    """One row per user ``id``: the version that is last by those of ``VERSION_ORDER`` that the feed has."""
    return latest_by_key(user_changes, ["id"], version_order(user_changes.columns))
