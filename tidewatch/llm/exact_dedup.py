"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import WHITE, stored, text_or_empty


def normalised(column: str) -> Column:
    """The text with each run of white space replaced by one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(column), WHITE, " ")


def hash_128(text: Column) -> Column:
    return F.md5(text)


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    content_hash: Callable[[Column], Column] = hash_128,
) -> DataFrame:
    """One row per row of `docs`: its id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their normalised bytes are. Grouping is by hash and
    text, so texts that share a hash but differ stay apart: the aggregation
    compares the bytes. Copies inside a task collapse before the shuffle, so a
    text that a third of the rows share costs a row per task.

    Null texts are empty texts. Ids may be null: a null id never is the
    smallest one, and a group without ids keeps a null keep_id and drops
    nothing. Of rows that repeat an id and text, all have `kept` true.
    Columns other than the two named ones are not read. An empty table gives
    an empty one.
    """
    text = normalised(text_col)
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"))
    base = base.select("doc_id", "_text", content_hash(F.col("_text")).alias("_hash"), F.sha2("_text", 256).alias("_sha"))
    groups = base.groupBy("_hash", "_sha", "_text").agg(
        F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # Rows find their group by both hashes. Where two texts share both, the text itself decides.
    keys = groups.groupBy("_hash", "_sha").agg(
        F.min("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size"),
        F.count(F.lit(1)).alias("_texts"),
    )
    # Stored, so that the texts are shuffled once, whatever reads the groups.
    keys = stored(keys, "text-groups")
    columns = ("doc_id", "keep_id", "group_size", "_sha")
    found = base.select("doc_id", "_hash", "_sha").join(keys, ["_hash", "_sha"]).where("_texts = 1").select(*columns)
    shared = keys.where("_texts > 1").select("_hash", "_sha")
    if shared.limit(1).count():
        clashing = base.join(shared, ["_hash", "_sha"]).join(
            groups.join(shared, ["_hash", "_sha"], "left_semi"), ["_hash", "_sha", "_text"]
        )
        found = found.union(clashing.select(*columns))
    return found.select(
        "doc_id",
        "keep_id",
        "group_size",
        F.coalesce(F.col("doc_id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs`, all its columns, without the rows whose text a row of smaller id has.

    Rows that repeat both id and text, and rows without an id, are reduced to
    one row per text: that of the smallest hash of its other columns. Null
    counts as empty. Columns may have any names; an empty table gives an empty
    one.
    """
    text = normalised(text_col)
    same = F.col(text_col).eqNullSafe(text)
    # The group's key already carries the text: rows whose text equals it carry none.
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text_col]
    row = F.struct(same.alias("same"), F.when(~same, F.col(text_col)).alias("raw"), *others)
    order = F.struct(F.col(id_col).isNull(), F.col(id_col), same, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    keyed = docs.select(text.alias("text"), hash_128(text).alias("hash"), F.sha2(text, 256).alias("sha"), row.alias("row"), order.alias("place"))
    kept = keyed.groupBy("hash", "sha", "text").agg(F.min_by("row", "place").alias("row"))
    back = F.when(F.col("row.same"), F.col("text")).otherwise(F.col("row.raw")).alias(text_col)
    return kept.select(*[back if c == text_col else F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
