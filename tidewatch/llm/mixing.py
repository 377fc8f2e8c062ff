"""Mixing sources to target weights: Sainte-Laguë apportionment of equal blocks of words, then seeded block selection."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidewatch.llm.common import WORD, stored, text_or_empty

BLOCK_WORDS = 128
SHARD_WORDS = 131_072
SHARD_ROWS = 4096
BRANCH = 1024
LEAST_BLOCKS = 16


def words(column: str) -> Column:
    return F.regexp_count(text_or_empty(column), F.lit(WORD)).cast("long")


def source_targets(
    sources: DataFrame, weights: Sequence[float] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """`sources` (source, source_size, …) with `target`.

    Sources in code point order, null last, take the weights in turn. The words
    of the mix, `share` of all, are dealt by weight; a target stops at `most`
    times its source's size and the rest is dealt again. The fixed point has
    target = min(most * size, level * weight): ordered by most * size / weight,
    a source is full when the level still reaches it after all before it are.
    """
    order = W.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("_place"), F.lit(len(weights))) + 1).cast("int"))
    placed = sources.withColumn("_place", F.row_number().over(order) - 1).withColumn("_weight", weight)
    full = F.col("source_size") * most
    placed = placed.withColumn("_full", full).withColumn("_ratio", full / F.col("_weight"))
    fill = W.orderBy("_ratio", "_place")
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    everyone = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(everyone) * share - F.coalesce(F.sum("_full").over(before), F.lit(0.0))
    onward = F.sum("_weight").over(fill.rowsBetween(0, W.unboundedFollowing))
    placed = placed.withColumn("_level", left / onward)
    # The level of the first source that stays below its limit holds for all after it.
    open_level = F.min(F.when(F.col("_level") < F.col("_ratio"), F.struct("_ratio", "_place", "_level"))).over(everyone)
    placed = placed.withColumn("_open", open_level)
    target = F.when(F.col("_open").isNull(), F.col("_full")).otherwise(
        F.least("_full", F.col("_open._level") * F.col("_weight"))
    )
    return placed.withColumn("target", target).drop("_place", "_weight", "_full", "_ratio", "_level", "_open")


def sainte_lague(children: DataFrame, parent: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Integer `quota` of each child: its parent's `seats` go one by one to the highest votes / (2 * seats so far + 1).

    `children` has the parent columns, the key columns, votes (double) and
    seats (the parent's, bigint). Equal quotients go by key. Each child starts
    with its rounded share; only the few quotients around the last seat are
    ranked. The quotas of a parent add up to its seats, unless it has no votes.
    """
    of = W.partitionBy(*parent)
    base = children.withColumn("_all", F.sum("votes").over(of)).withColumn("_n", F.count(F.lit(1)).over(of))
    share = F.when(F.col("_all") > 0, F.col("votes") / F.col("_all")).otherwise(F.lit(0.0))
    base = base.withColumn("_share", share)
    base = base.withColumn("quota", F.floor(F.col("_share") * F.col("seats") + 0.5).cast("long"))
    base = base.withColumn("_short", F.col("seats") - F.sum("quota").over(of))
    near = F.ceil(F.col("_share") * (F.abs("_short") + F.col("_n"))).cast("long") + 1
    steps = F.when(F.col("_short") > 0, F.sequence(F.lit(0).cast("long"), near)).when(
        F.col("_short") < 0, F.sequence(F.lit(-1).cast("long"), -F.least(near + 1, "quota"), F.lit(-1).cast("long"))
    )
    steps = F.when((F.col("votes") > 0) & ((F.col("_short") > 0) | (F.col("quota") > 0)), steps)
    moves = base.where("_short != 0").select(*parent, *key, "_short", "votes", "quota", F.explode(steps).alias("_step"))
    quotient = F.col("votes") / (2 * (F.col("quota") + F.col("_step")) + 1)
    up = [F.col(c).asc_nulls_last() for c in key]
    down = [F.col(c).desc_nulls_first() for c in key]
    ranked = moves.withColumn("_quotient", quotient)
    gained = ranked.where("_short > 0").withColumn("_rank", F.row_number().over(of.orderBy(F.desc("_quotient"), *up)))
    lost = ranked.where("_short < 0").withColumn("_rank", F.row_number().over(of.orderBy("_quotient", *down)))
    change = (
        gained.where("_rank <= _short").withColumn("_change", F.lit(1))
        .union(lost.where("_rank <= -_short").withColumn("_change", F.lit(-1)))
        .groupBy(*parent, *key).agg(F.sum("_change").alias("_change"))
    )
    change = change.select(*[F.col(c).alias(f"_to_{c}") for c in (*parent, *key)], "_change")
    both = [F.col(c).eqNullSafe(F.col(f"_to_{c}")) for c in (*parent, *key)]
    quota = (F.col("quota") + F.coalesce("_change", F.lit(0))).alias("quota")
    return base.join(change, both, "left").select(*children.columns, quota)


def _taken(seed: int):
    def taken(rows: pd.DataFrame) -> pd.DataFrame:
        """Words taken of each document of one shard: `quota` of its blocks, whole rounds first, then seeded ones."""
        rows = rows.sort_values(["_order", "doc_id", "size"], kind="stable", ignore_index=True)
        block_words = int(rows["block"].iloc[0])
        ends = rows["size"].to_numpy(np.int64).cumsum()
        starts = ends - rows["size"].to_numpy(np.int64)
        total, quota = int(ends[-1]), int(rows["quota"].iloc[0])
        blocks = -(-total // block_words)
        rounds, rest = divmod(quota, blocks) if blocks else (0, 0)
        source, shard = rows["source"].iloc[0], int(rows["_shard"].iloc[0])
        source = "\x00" if source is None else str(source)
        dice = np.random.default_rng([seed, shard, *source.encode()])
        chosen = np.zeros(blocks, bool)
        chosen[dice.permutation(blocks)[:rest]] = True
        # Chosen words before any position of the shard, at the blocks' borders.
        sizes = np.minimum(block_words, total - np.arange(blocks) * block_words)
        before = np.concatenate(([0], np.where(chosen, sizes, 0).cumsum())).astype(np.int64)

        def upto(at: np.ndarray) -> np.ndarray:
            block = np.minimum(at // block_words, max(blocks - 1, 0))
            return before[block] + (at - block * block_words) * (chosen[block] if blocks else 0)

        rows["taken"] = rounds * (ends - starts) + (upto(ends) - upto(starts) if blocks else 0)
        spans = [""] * len(rows)
        if rest:
            edges = np.flatnonzero(np.diff(np.concatenate(([0], chosen.astype(np.int8), [0]))))
            for a, b in edges.reshape(-1, 2) * block_words:
                b = min(b, total)
                for i in range(int(np.searchsorted(ends, a, "right")), int(np.searchsorted(starts, b, "left"))):
                    low, high = max(a, starts[i]) - starts[i], min(b, ends[i]) - starts[i]
                    if high > low:
                        spans[i] += f"{low}-{high} "
        rows["rounds"], rows["spans"] = rounds, [x.strip() for x in spans]
        return rows[["_row", "doc_id", "source", "size", "taken", "rounds", "spans"]]

    return taken


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = 17,
) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, rounds, spans) for every row of `docs`.

    A source is cut into shards of about `shard_words` words by a seeded hash;
    a shard's documents in seeded order make blocks of `block_words` words.
    Blocks of a source whose target is under `LEAST_BLOCKS` of them are halved
    until it has as many, so that it comes as near to its target as others.
    Sainte-Laguë deals the mix's blocks of each size to sources by target, and
    a source's blocks down a tree of shards by size, never more than `BRANCH`
    children at a time. A shard takes all its blocks for each whole round of its quota and
    a seeded choice of them for the rest: `rounds` whole copies of the document
    and the word ranges `spans` ("0-128 256-300"), which add up to `taken`.

    Null text has size 0, null source is a source of its own, ids may be null
    or repeat (each row counts by itself, and equal rows are spread over shards
    like others). Rows without words take part in no shard. Other columns aren't read. An empty
    table gives an empty one. The same rows give the same choice, in whatever
    order or partitions they come.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words(text_col).alias("size"), F.xxhash64(text_or_empty(text_col)).alias("_row"))
    # Equal rows are counted inside tasks, then numbered, so that each has a place of its own.
    base = base.groupBy("doc_id", "source", "size", "_row").agg(F.count(F.lit(1)).alias("_copies"))
    base = base.select("doc_id", "source", "size", "_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))).alias("_copy"))
    order = F.when(F.col("_copy") > 1, F.xxhash64("doc_id", "_row", F.lit(seed), "_copy")).otherwise(F.xxhash64("doc_id", "_row", F.lit(seed)))
    base = stored(base.withColumn("_order", order).drop("_copy"), "sizes")
    sources = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count_if(F.col("size") > 0).alias("_rows"))
    sources = source_targets(sources, weights, share, most)
    halved = [F.lit(block_words >> i) for i in range(block_words.bit_length())]
    block = F.coalesce(*[F.when(F.col("target") >= LEAST_BLOCKS * b, b) for b in halved], F.lit(1))
    sources = sources.withColumn("block", block)
    sources = sources.withColumns(
        {
            "votes": F.col("target"),
            "seats": F.round(F.sum("target").over(W.partitionBy("block")) / F.col("block")).cast("long"),
            "_shards": F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words), F.ceil(F.col("_rows") / SHARD_ROWS)).cast("long"),
        }
    )
    sources = stored(sainte_lague(sources, ["block"], ["source"]).drop("votes", "seats"), "sources")

    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    shards = sources.select(F.col("source").alias("_of"), "_shards", "block")
    placed = base.where("size > 0").join(shards, F.col("source").eqNullSafe(F.col("_of"))).withColumn("_shard", F.pmod("_order", "_shards"))
    sized = placed.groupBy("source", "_shard").agg(F.sum("size").cast("double").alias("votes"), F.first("block").alias("block"))
    sized = stored(sized, "shards")
    depth, widest = 1, sources.agg(F.max("_shards")).first()[0] or 1
    while widest > BRANCH**depth:
        depth += 1
    parents = sources.select("source", F.lit(0).cast("long").alias("_node"), F.col("quota").alias("seats"))
    for level in range(depth - 1, -1, -1):
        nodes = sized.withColumn("_node", F.floor(F.col("_shard") / BRANCH ** (level + 1)).cast("long"))
        nodes = nodes.withColumn("_child", F.floor(F.col("_shard") / BRANCH**level).cast("long"))
        nodes = nodes.groupBy("source", "_node", "_child").agg(F.sum("votes").alias("votes"))
        joined = nodes.join(parents, [same(nodes, parents), nodes["_node"] == parents["_node"]])
        children = joined.select(nodes["source"], nodes["_node"], "_child", "votes", "seats")
        quotas = sainte_lague(children, ["source", "_node"], ["_child"])
        parents = stored(quotas.select("source", F.col("_child").alias("_node"), F.col("quota").alias("seats")), "quotas")
    quota = parents.select(F.col("source").alias("_of"), F.col("_node").alias("_at"), F.col("seats").alias("quota"))
    with_quota = placed.join(quota, [placed["source"].eqNullSafe(quota["_of"]), placed["_shard"] == quota["_at"]])
    # No shard gives more than its words `most` times, whatever rounding says.
    sums = sized.select(F.col("source").alias("_src"), F.col("_shard").alias("_sh"), F.floor(most * F.ceil(F.col("votes") / F.col("block"))).cast("long").alias("_cap"))
    with_quota = with_quota.join(sums, [with_quota["source"].eqNullSafe(sums["_src"]), with_quota["_shard"] == sums["_sh"]])
    with_quota = with_quota.select("_row", F.col("doc_id").cast("string").alias("doc_id"), "source", "size", "_order", "_shard", with_quota["block"], F.least("quota", "_cap").alias("quota"))
    # Ids travel as text: pandas would make floats of whole numbers beside nulls.
    source_kind = docs.schema[source_col].dataType.simpleString()
    schema = f"_row long, doc_id string, source {source_kind}, size long, taken long, rounds long, spans string"
    taken = with_quota.groupBy("source", "_shard").applyInPandas(_taken(seed), schema)
    none = base.where("size = 0").select("_row", F.col("doc_id").cast("string").alias("doc_id"), "source", "size", F.lit(0).cast("long").alias("taken"), F.lit(0).cast("long").alias("rounds"), F.lit("").alias("spans"))
    taken = taken.unionByName(none)
    named = sources.select(F.col("source").alias("_of"), "source_size", "target")
    found = taken.join(named, taken["source"].eqNullSafe(F.col("_of")))
    doc_id = F.col("doc_id").cast(docs.schema[id_col].dataType).alias("doc_id")
    return found.select(doc_id, "size", "source_size", "target", "taken", "source", "rounds", "spans", "_row")
