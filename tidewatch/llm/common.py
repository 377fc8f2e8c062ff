"""Helpers the corpus operators share: stored intermediate tables and connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import working_folder

WHITE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back: later jobs neither recompute it nor need its executors."""
    spark = df.sparkSession
    folder = working_folder(spark, name)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def computed(df: DataFrame, **columns: Column) -> DataFrame:
    """`df` with new columns, each computed once however often it is used: a generator keeps them from being inlined."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def packed(docs: DataFrame) -> Column:
    """A caller's whole row as one struct, so that no column of it can clash with a name used beside it."""
    return F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns])


def components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """Connected components of an undirected graph: (node, label), label the smallest node of the component.

    Nodes are not null. Only nodes with an edge to another node are returned.
    Each round hooks every node to its smallest neighbour, shortens the chains
    and contracts the edges, so a round at least merges every node that is not
    a local minimum; no group of a hub is ever gathered (minima are partly
    aggregated, joins are plain equality joins that may be split).
    """
    low, high = F.least(u, v).alias("u"), F.greatest(u, v).alias("v")
    edges = stored(edges.where(F.col(u) != F.col(v)).select(low, high).distinct(), "edges")
    labels = None
    while edges.limit(1).count():
        both = edges.union(edges.select("v", "u"))
        hooks = both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("up"))
        hooks = stored(hooks.select("node", F.least("node", "up").alias("up")), "hooks")
        for _ in range(2):
            upper = hooks.select(F.col("node").alias("up"), F.col("up").alias("top"))
            hooks = hooks.join(upper, "up").select("node", F.col("top").alias("up"))
        hooks = stored(hooks, "hooks")
        if labels is None:
            labels = hooks.select("node", F.col("up").alias("label"))
        else:
            moved = hooks.select(F.col("node").alias("label"), "up")
            labels = stored(
                labels.join(moved, "label", "left").select("node", F.coalesce("up", "label").alias("label")), "labels"
            )
        from_u = hooks.select(F.col("node").alias("u"), F.col("up").alias("a"))
        from_v = hooks.select(F.col("node").alias("v"), F.col("up").alias("b"))
        edges = (
            edges.join(from_u, "u")
            .join(from_v, "v")
            .where("a != b")
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
            .distinct()
        )
        edges = stored(edges, "edges")
    if labels is None:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return labels
