"""The event contract: raw JSON text to a typed event, or the reason it is refused."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.timebuckets import parse_rfc3339

INVALID_JSON = "invalid json"
INVALID_CREATED_AT = "invalid created_at"

# Contract fields in the order they are checked: the name used in reasons, the
# top-level key, the key inside it (if nested), and the column it fills.
FIELDS = (
    ("id", "id", None, "id"),
    ("type", "type", None, "type"),
    ("repo.name", "repo", "name", "repo_name"),
    ("actor.login", "actor", "login", "actor_name"),
    ("created_at", "created_at", None, "created_text"),
)

PARSED_COLUMNS = ("id", "type", "repo_name", "actor_name", "created_at", "reason")

# Only the contract's fields are materialised, everything else in the text is
# skipped by the JSON reader. VARIANT keeps each field's JSON type, so a
# number where a string belongs is seen as such and not silently cast.
_EVENT_FIELDS = ", ".join(
    f"{key}: struct<{inner}: variant>" if inner else f"{key}: variant" for _, key, inner, _ in FIELDS
)
_SEALED_SCHEMA = f"array<struct<{_EVENT_FIELDS}, seal: bigint>>"
_STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


# The wording of reasons, which dead letters carry.
def missing(field: str) -> str:
    return f"missing required field {field}"


def _sealed(value: Column) -> Column:
    """`[<value>, {"seal": <hash of value>}]` parsed as an array.

    The JSON reader stops at the end of the first document, so text after an
    event would go unnoticed. Inside the array any such text breaks the
    syntax, adds elements, or cuts off the seal.
    """
    seal = F.xxhash64(value).cast("string")
    return F.from_json(
        F.concat(F.lit("["), value, F.lit(',{"seal":'), seal, F.lit("}]")),
        _SEALED_SCHEMA,
        _STRICT_JSON,
    )


def check_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """`parse_events` for rows that are all written as they are.

    A filter on the result would be pushed down and parse every text again;
    where rows are filtered, use `parse_events`.
    """
    doc = messages.withColumn("_doc", _sealed(F.col(value)))
    event = F.try_element_at("_doc", F.lit(1))
    seal = F.try_element_at("_doc", F.lit(2))["seal"]
    fields = doc.select(
        *messages.columns,
        ((F.size("_doc") == 2) & (seal == F.xxhash64(F.col(value)))).alias("_whole"),
        *[
            (event[key][inner] if inner else event[key]).alias(f"_{key}")
            for _, key, inner, _ in FIELDS
        ],
    )
    typed = fields.withColumns(
        {f"_{key}_kind": F.schema_of_variant(F.col(f"_{key}")) for _, key, _, _ in FIELDS}
    )

    mistyped = ~F.coalesce("_whole", F.lit(False))
    texts = []
    for _, key, inner, name in FIELDS:
        kind = F.col(f"_{key}_kind")
        mistyped = mistyped | ~F.coalesce(kind, F.lit("VOID")).isin("STRING", "VOID")
        if inner:
            # Without an inner value the outer one is missing, or no object. Only then is it
            # looked at: WHEN keeps the second parse from being shared and run for every row.
            outer = F.schema_of_variant(F.try_variant_get(F.try_parse_json(value), f"$.{key}", "variant"))
            outer = F.coalesce(outer, F.lit("VOID"))
            mistyped = mistyped | F.when(
                kind.isNull(), (outer != "VOID") & ~outer.startswith("OBJECT")
            ).otherwise(F.lit(False))
        texts.append(F.when(kind == "STRING", F.col(f"_{key}").try_cast("string")).alias(name))
    checked = typed.select(*messages.columns, mistyped.alias("_broken"), *texts).withColumn(
        "created_at", parse_rfc3339(F.col("created_text"))
    )

    reason = F.when(F.col("_broken"), INVALID_JSON)
    for path, _, _, name in FIELDS:
        reason = reason.when(F.coalesce(F.col(name), F.lit("")) == "", missing(path))
    reason = reason.when(F.col("created_at").isNull(), INVALID_CREATED_AT)
    return checked.select(*messages.columns, *PARSED_COLUMNS[:-1], reason.alias("reason"))


def parse_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add the event columns and `reason` (NULL for a valid event) to `messages`.

    Checks run in a fixed order and the first failure is the reason: JSON and
    field types, required fields, then the timestamp.
    """
    # The generator ends the parse: a filter on its output is not pushed into
    # it, so every text is parsed once however the result is used.
    checked = check_events(messages, value)
    return checked.select(*messages.columns, F.inline(F.array(F.struct(*PARSED_COLUMNS))))


def valid_events(parsed: DataFrame, value: str = "value") -> DataFrame:
    """The accepted part of `parse_events`, payload byte for byte as received."""
    return parsed.filter(F.col("reason").isNull()).withColumn("payload", F.col(value))


def rejected_messages(parsed: DataFrame, stage: str = "decode") -> DataFrame:
    """The refused part of `parse_events`: key and value unchanged, with reason and stage."""
    return parsed.filter(F.col("reason").isNotNull()).withColumn("stage", F.lit(stage))
