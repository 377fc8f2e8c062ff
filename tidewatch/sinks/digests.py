"""Which ids differ between two tables: hash trees over ranges of hashed ids, followed only where digests differ.

A tree is a folder. `ids` holds (id, leaf, digest) of every row, sorted by
leaf, the leading bits of the id's hash; `nodes/bits=b` holds rows and digest
sum of each range of the first b bits. Sums do not depend on order, so a tree
is built from partly aggregated counts, and two trees are compared by sums of
signed differences, for which a missing node is a zero.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.session import working_folder

# Leading hash bits of each level; the last is that of the leaves.
LEVELS = (8, 16, 24)

# Up to this many differing ranges are written into the scan's filter; more are joined.
FILTERED_RANGES = 128

_ID_SCHEMA = "id STRING, leaf BIGINT, digest BIGINT"
_NODE_SCHEMA = "node BIGINT, rows BIGINT, digest DECIMAL(38,0)"


def write_tree(rows: DataFrame, folder: str, id_col: str = "id", columns: Sequence[str] | None = None, levels: Sequence[int] = LEVELS) -> None:
    """The tree of a table; `columns` (all unless given) are what a row's digest covers."""
    spark = rows.sparkSession
    name = F.col(id_col).cast("string")
    covered = [F.col(c) for c in (columns or rows.columns)]
    leaf = F.shiftrightunsigned(F.xxhash64(name), 64 - levels[-1])
    # A null changes no running hash, so each column also says whether it is null.
    digest = F.xxhash64(*[part for c in covered for part in (c.isNull(), c)])
    ids = rows.select(name.alias("id"), leaf.alias("leaf"), digest.alias("digest"))
    ids = ids.repartitionByRange("leaf", "id").sortWithinPartitions("leaf", "id")
    ids.write.option("parquet.block.size", 8 << 20).parquet(f"{folder}/ids")
    finer, rows_, sums = spark.read.schema(_ID_SCHEMA).parquet(f"{folder}/ids"), F.count("*"), F.sum(F.col("digest").cast("decimal(20,0)"))
    node, below = F.col("leaf"), levels[-1]
    for bits in reversed(levels):
        nodes = finer.groupBy(F.shiftright(node, below - bits).alias("node"))
        nodes = nodes.agg(rows_.alias("rows"), sums.cast("decimal(38,0)").alias("digest"))
        nodes.repartitionByRange("node").sortWithinPartitions("node").write.parquet(f"{folder}/nodes/bits={bits}")
        finer = spark.read.schema(_NODE_SCHEMA).parquet(f"{folder}/nodes/bits={bits}")
        node, below, rows_, sums = F.col("node"), bits, F.sum("rows"), F.sum("digest")


def _inside(rows: DataFrame, node: str, shift: int, found: DataFrame | None, listed: list[int] | None) -> DataFrame:
    """The rows below the differing nodes of the level above."""
    if listed is not None:
        within = [F.col(node).between(n << shift, ((n + 1) << shift) - 1) for n in listed]
        below: Column = F.lit(False)
        for one in within:
            below = below | one
        return rows.where(below)
    if found is None:
        return rows
    return rows.join(found.select(F.col("node").alias("_above")), F.shiftright(node, shift) == F.col("_above"), "left_semi")


def _signed(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.withColumn("_sign", F.lit(1)).unionByName(right.withColumn("_sign", F.lit(-1)))


def differing_ids(spark: SparkSession, left: str, right: str, levels: Sequence[int] = LEVELS) -> DataFrame:
    """(id, difference): ids of only one tree, of other rows, or stored another number of times.

    Both trees need the same levels and digest columns. `difference` is
    `missing right`, `missing left` or `altered`. What is read below the first
    level is what lies in differing ranges. Null ids compare as one id.
    """
    found, listed, above = None, None, 0
    for bits in levels:
        sides = [
            _inside(spark.read.schema(_NODE_SCHEMA).parquet(f"{folder}/nodes/bits={bits}"), "node", bits - above, found, listed)
            for folder in (left, right)
        ]
        merged = _signed(*sides).groupBy("node").agg(
            F.sum(F.col("rows") * F.col("_sign")).alias("_rows"),
            F.sum(F.when(F.col("_sign") > 0, F.col("digest")).otherwise(-F.col("digest"))).alias("_digest"),
        )
        folder = working_folder(spark, "differing-nodes")
        merged.where("_rows != 0 OR _digest != 0").select("node").write.parquet(folder)
        found = spark.read.schema("node BIGINT").parquet(folder)
        head = found.limit(FILTERED_RANGES + 1).collect()
        listed = sorted(r.node for r in head) if len(head) <= FILTERED_RANGES else None
        above = bits
    sides = [_inside(spark.read.schema(_ID_SCHEMA).parquet(f"{folder}/ids"), "leaf", 0, found, listed) for folder in (left, right)]
    signed = F.col("digest").cast("decimal(20,0)") * F.col("_sign")
    ids = _signed(*sides).groupBy("id").agg(
        F.count_if(F.col("_sign") > 0).alias("_left"), F.count_if(F.col("_sign") < 0).alias("_right"), F.sum(signed).alias("_digest")
    )
    kind = F.when(F.col("_right") == 0, "missing right").when(F.col("_left") == 0, "missing left").otherwise("altered")
    return ids.where("_left != _right OR _digest != 0").select("id", kind.alias("difference"))
