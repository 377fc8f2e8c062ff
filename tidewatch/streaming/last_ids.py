"""Dedupe bounded by a number of ids: the last N accepted ids of each shard are remembered."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def dedupe_last(events: DataFrame, limit: int, order: Sequence[str], shards: int = 64) -> DataFrame:
    """The events whose id is not among the last `limit` ids accepted in its shard.

    Ids are dealt to shards by hash, and each shard forgets its oldest id by
    arrival once it holds more than `limit`; a repeat does not renew its id.
    Inside a batch events arrive in the order of the columns `order`, which hold no nulls. With one
    shard this is one list of the last `limit` ids of the whole stream, in one
    task; with more, each task holds the ids of a shard and its rows of one
    batch. Events without id are dropped. `ingest.dedupe_stream`, bounded by
    time, is the default.
    """
    if limit < 1 or shards < 1:
        raise ValueError("limit and shards must be positive")
    order = list(order)
    # Whole numbers travel as text: pandas would turn those of a column with nulls into floats.
    whole = {f.name for f in events.schema if isinstance(f.dataType, T.IntegralType)}
    carried = [F.col(c).cast("string").alias(c) if c in whole else F.col(c) for c in events.columns]
    places = [f"_order{i}" for i in range(len(order))]
    spread = events.filter(F.length("id") > 0).select(
        F.pmod(F.xxhash64("id"), F.lit(shards)).alias("_shard"), *[F.col(c).alias(p) for c, p in zip(order, places)], *carried
    )
    schema = spread.select(*events.columns).schema

    def fresh(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        known = dict.fromkeys(state.get[0]) if state.exists else {}
        rows = pd.concat(list(chunks)).sort_values(places, kind="stable")
        keep = []
        for event_id in rows["id"]:
            new = event_id not in known
            keep.append(new)
            if new:
                known[event_id] = None
                if len(known) > limit:
                    del known[next(iter(known))]
        state.update((list(known),))
        yield rows.loc[keep, schema.names]

    kept = spread.groupBy("_shard").applyInPandasWithState(
        fresh, schema, "ids array<string>", "append", GroupStateTimeout.NoTimeout
    )
    return kept.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in events.schema])
