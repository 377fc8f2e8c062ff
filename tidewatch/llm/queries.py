"""The corpus operators applied to their whole tables, by name, and the SQL of those SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import (
    exact_dedup,
    fingerprints,
    hnsw,
    licences,
    mixing,
    periodic_runs,
    pieces,
    pseudonyms,
    simhash,
    site_quality,
    token_files,
    toxicity,
    whitening,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("_row")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(table(spark, sf_dir, "documents"))


def op4_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonymised(table(spark, sf_dir, "documents"), key="corpus-1")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_vectors(table(spark, sf_dir, "embeddings"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_files.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def piece_model() -> dict:
    import public_tokenizers

    return pieces.load(public_tokenizers.path("piece_bpe_32k.model"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = piece_model()
    decoded = pieces.decode(pieces.encode(table(spark, sf_dir, "documents"), model), model)
    return decoded.select("doc_id", "n_chunks", "n_tokens", "ids_crc32", F.sha2("text", 256).alias("decoded_sha256"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprints.half_edited(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprints.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        fingerprints.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        fingerprints.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(periodic_runs.repeated_tails(table(spark, sf_dir, "documents")))
    found = found.withColumn("best", periodic_runs.best_run(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_licences": op3_licences,
    "op4_site_quality": op4_site_quality,
    "op5_toxicity": op5_toxicity,
    "op6_near_vectors": op6_near_vectors,
    "op7_simhash": op7_simhash,
    "op8_token_files": op8_token_files,
    "op9_pseudonyms": op9_pseudonyms,
    "op10_pieces": op10_pieces,
    "op11_fingerprints": op11_fingerprints,
    "op12_whitening": op12_whitening,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLE_SQL = {
    "op2_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY t)
    """,
    "op3_licences": licences.oracle(),
    "op11_fingerprints": fingerprints.oracle(),
}
