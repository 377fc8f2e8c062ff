"""Documents to training tokens: five stages over whole tables, each reading what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import exact_dedup, mixing, near_copies, pieces, queries, toxicity
from tidewatch.llm.common import WORD, packed, stored, text_or_empty

NEAR_BITS = 8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents the factorization machine predicts toxic.

    Null and empty texts have no terms and stay unless the machine's bias alone
    says otherwise; rows may repeat, ids may be null, other columns are kept as
    they are; without labels of both kinds, and from an empty table, nothing goes.
    """
    machine = toxicity.train(docs, queries.table(spark, sf_dir, "labels"))
    return toxicity.drop_toxic(docs, machine)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text, the one of the smallest id."""
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, the one of the smallest id.

    Near copies share four fifths of their five-word shingles. Fingerprints
    within NEAR_BITS and min-hash bands name candidates only; whole texts
    decide before anything is linked.
    """
    return near_copies.one_of_each(docs, shingle=5, distance=NEAR_BITS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix's rows: a document once for each whole round its shard takes, and once more with its chosen blocks.

    Rows that repeat id, source and text are dealt one by one and each comes as
    often as it is dealt, all with the other columns of one of them (that of
    the smallest row hash). Null texts and texts without words are not taken.
    Columns may have any names; an empty table gives an empty one.
    """
    dealt = mixing.mix(docs).where("taken > 0").select("doc_id", F.col("_row").alias("hash"), "source", "rounds", "spans")
    dealt = stored(dealt, "dealt")
    text = text_or_empty("text")
    given = docs.select(packed(docs).alias("row"), F.col("doc_id").alias("of_doc"), F.xxhash64(text).alias("of_hash"), F.col("source").alias("of_source"))
    same = F.col("of_doc").eqNullSafe(F.col("doc_id")) & (F.col("of_hash") == F.col("hash")) & F.col("of_source").eqNullSafe(F.col("source"))
    twice = stored(dealt.groupBy("doc_id", "hash", "source").count().where("count > 1").drop("count"), "dealt-twice")
    if twice.limit(1).count():
        one = given.join(twice, same, "left_semi").groupBy("of_doc", "of_hash", "of_source").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
        given = given.join(twice, same, "left_anti").unionByName(one)
    wholes = F.array_repeat(F.lit(""), F.col("rounds").cast("int"))
    parts = F.when(F.col("spans") != "", F.array("spans")).otherwise(F.array().cast("array<string>"))
    rows = given.join(dealt, same).select("row", F.explode(F.concat(wholes, parts)).alias("take"))
    words = F.regexp_extract_all(F.coalesce("row.text", F.lit("")), F.lit(WORD), F.lit(0))
    chosen = F.flatten(
        F.transform(
            F.split("take", " "),
            lambda s: F.slice(words, F.split(s, "-")[0].cast("int") + 1, F.split(s, "-")[1].cast("int") - F.split(s, "-")[0].cast("int")),
        )
    )
    rows = rows.select("row", F.when(F.col("take") == "", F.col("row.text")).otherwise(F.array_join(chosen, " ")).alias("text"))
    own = {"text": F.col("text"), "n_chars": F.char_length("text").cast("long")}
    return rows.select(*[own.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang and the ids of the text, for every row.

    Null and empty texts have no ids; rows may repeat, ids may be null, other
    columns are not read; an empty table gives an empty one.
    """
    about = ["source", "lang"]
    keyed = docs.select(F.struct("doc_id", *about).alias("doc_id"), "text")
    found = pieces.encode(keyed, queries.piece_model())
    return found.select("doc_id.*", "n_chunks", F.size("ids").alias("n_tokens"), "ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode),
]

# Fingerprints, the factorization machine and the tokenizer are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
