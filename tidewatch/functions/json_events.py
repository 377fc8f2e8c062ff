"""Encoding events as the raw JSON the contract reads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_json(
    id: Column, type: Column, repo: Column, actor: Column, created_at: Column, **extra: Column
) -> Column:
    """The nested JSON text of one event; `extra` fields follow at the top level."""
    return F.to_json(
        F.struct(
            id.alias("id"),
            type.alias("type"),
            F.struct(repo.alias("name")).alias("repo"),
            F.struct(actor.alias("login")).alias("actor"),
            created_at.alias("created_at"),
            *[column.alias(name) for name, column in extra.items()],
        )
    )
