"""From topic messages to typed rows (pipelines 2, 4, 5, 6, 7, 8).

Decoding is split from typing: a decoder turns ``value`` into named text (or
loosely typed) fields, then ``functions.casting`` applies a target.  Both
steps are single projections, so a scan → decode → cast → write chain is one
codegen stage with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions import casting, wire
from tidewater.schemas import (
    ENVELOPE_FIELDS,
    LAKE_POSITIONS,
    POSITION_WIRE_FIELDS,
    WAREHOUSE_FIRST_DAY,
    WAREHOUSE_LAST_DAY,
    WAREHOUSE_POSITIONS,
    Target,
)

NFIELDS = "_nfields"


def parse_delimited(messages: DataFrame, keep: list[str] = ["offset"]) -> DataFrame:
    """``keep`` + field count + the 12 text fields (NULL where absent)."""
    # split once into a column, then index it: an inline split per field
    # would re-parse the line twelve times
    parts = F.col("_parts")
    return messages.select(*keep, wire.split_fields("value").alias("_parts")).select(
        *keep,
        # a NULL message has no fields: it is a reject, not a lost row
        F.coalesce(F.size(parts), F.lit(0)).alias(NFIELDS),
        *[F.get(parts, i).alias(n) for i, n in enumerate(POSITION_WIRE_FIELDS)],
        F.spark_partition_id().alias(PARSE_FENCE),
    )


# keeps arity filters above the split (see casting.FENCE)
PARSE_FENCE = "_pfence"


def arity_ok(n: int = len(POSITION_WIRE_FIELDS)):
    return (F.col(NFIELDS) == n) & (F.col(PARSE_FENCE) >= 0)


def parse_rejects(parsed: DataFrame, keep: list[str] = ["offset"]) -> DataFrame:
    """Lines whose field count is not 12 (dropped by ignore-parse-errors)."""
    n = len(POSITION_WIRE_FIELDS)
    return parsed.where((F.col(NFIELDS) != n) & (F.col(PARSE_FENCE) >= 0)).select(
        *keep,
        F.lit("PARSE").alias("error_stage"),
        F.lit(None).cast("string").alias("error_column"),
        F.concat(F.lit(f"expected {n} fields, got "), F.col(NFIELDS).cast("string")).alias("error_message"),
    )


STAGE = "_stage"


def classify_delimited(parsed: DataFrame, targets: list[Target], keep: list[str] = ["offset"],
                       checks: list | None = None) -> DataFrame:
    """Every parsed line, typed, with ``_errors`` and the stage they belong to:
    PARSE for a wrong number of fields, else CAST.  Lines without an error have
    an empty list; one table holds them all, so a batch is cast once."""
    n = len(POSITION_WIRE_FIELDS)
    typed = casting.apply_target(parsed, targets, keep=[*keep, NFIELDS], checks=checks)
    short = F.col(NFIELDS) != n
    told = F.struct(F.lit(None).cast("string").alias("column"),
                    F.concat(F.lit(f"expected {n} fields, got "), F.col(NFIELDS).cast("string")).alias("message"))
    return typed.select(*keep, *[t.name for t in targets],
                        F.when(short, F.array(told)).otherwise(F.col(casting.ERRORS)).alias(casting.ERRORS),
                        F.when(short, F.lit("PARSE")).otherwise(F.lit("CAST")).alias(STAGE), casting.FENCE)


def good_of(classified: DataFrame, policy: str = "reject") -> DataFrame:
    return casting.good_rows(classified, policy).drop(STAGE)


def rejects_of(classified: DataFrame, keep: list[str] = ["offset"]) -> DataFrame:
    """One row per bad record: ``keep``, stage, first failing column, reason."""
    return casting.reject_rows(classified, keep, F.col(STAGE))


def to_lake(parsed: DataFrame, keep: list[str] = [], policy: str = "drop") -> DataFrame:
    """Lake typing (doubles, all nullable).

    ``drop``: malformed lines are skipped and a field that does not parse is
    NULL (ignore-parse-errors); ``fail``: either aborts the job; ``reject``:
    all lines with ``_errors`` for the caller to split (:func:`lake_split`).
    """
    if policy == "drop":
        typed = casting.apply_target(parsed.where(arity_ok()), LAKE_POSITIONS, keep=keep)
        return typed.drop(casting.ERRORS, casting.FENCE)
    typed = classify_delimited(parsed, LAKE_POSITIONS, keep)
    return typed if policy == "reject" else good_of(typed, policy)


def lake_split(parsed: DataFrame, keep: list[str] = ["offset"]) -> tuple[DataFrame, DataFrame]:
    """(good typed rows, rejects of both stages) of the lake's target."""
    typed = classify_delimited(parsed, LAKE_POSITIONS, keep)
    return good_of(typed), rejects_of(typed, keep)


_CHECKS: list = []


def warehouse_checks() -> list[tuple[str, F.Column, str]]:
    """pos_date must fall in the table's day-range partitioning (one
    constant list, so typed expressions built from it are reused)."""
    if not _CHECKS:
        _CHECKS.append(("pos_date",
                        (F.col("pos_date") < F.lit(WAREHOUSE_FIRST_DAY).cast("date"))
                        | (F.col("pos_date") > F.lit(WAREHOUSE_LAST_DAY).cast("date")),
                        "no partition for date"))
    return _CHECKS


def classify_warehouse(parsed: DataFrame, keep: list[str] = ["offset"]) -> DataFrame:
    return classify_delimited(parsed, WAREHOUSE_POSITIONS, keep, warehouse_checks())


def warehouse_split(parsed: DataFrame, keep: list[str] = ["offset"]) -> tuple[DataFrame, DataFrame]:
    """(good typed rows, rejects of both stages) — the load's error table."""
    typed = classify_warehouse(parsed, keep)
    return good_of(typed), rejects_of(typed, keep)


# --- flat JSON --------------------------------------------------------------

def classify_json(messages: DataFrame, targets: list[Target] = LAKE_POSITIONS, keep: list[str] = ["offset"]) -> DataFrame:
    """Flat JSON records, typed, with errors and stage as delimited lines have
    them: a message that is no JSON object is a PARSE error, a field that does
    not cast a CAST error.  The three policies follow from it (``good_of``)."""
    rec = F.col("_rec")
    fields = [rec[t.name].alias(t.name) for t in targets]
    bad = rec.isNull() | rec["_corrupt"].isNotNull()
    read = messages.select(*keep, wire.decode_json_text("value", [t.name for t in targets]).alias("_rec")).select(
        *keep, *fields, F.coalesce(bad, F.lit(True)).alias("_bad"))
    typed = casting.apply_target(read, targets, keep=[*keep, "_bad"])
    told = F.struct(F.lit(None).cast("string").alias("column"), F.lit("value is not a JSON object").alias("message"))
    return typed.select(*keep, *[t.name for t in targets],
                        F.when(F.col("_bad"), F.array(told)).otherwise(F.col(casting.ERRORS)).alias(casting.ERRORS),
                        F.when(F.col("_bad"), F.lit("PARSE")).otherwise(F.lit("CAST")).alias(STAGE), casting.FENCE)


# --- envelope (pipelines 7, 8) -------------------------------------------

ENVELOPE_TARGET = [
    Target(f, {"string": "string", "double": "double", "int32": "int"}[t]) for f, t, _ in ENVELOPE_FIELDS
]


def parse_envelope(messages: DataFrame, keep: list[str] = ["offset"]) -> DataFrame:
    """``keep`` + value and headers, the typed payload, the missing required
    fields and ``_problem``: why the envelope is unusable, or NULL.  Every field
    is looked up and cast once; wrong types are the casts' own errors."""
    cols = [c for c in ("value", "headers") if c not in keep]
    keep_all = [*keep, *cols]
    read = messages.select(*keep_all, wire.decode_envelope("value").alias("_env"))
    payload = {t.name: F.try_element_at(F.col("_env")["payload"], F.lit(t.name)) for t in ENVELOPE_TARGET}
    typed = casting.apply_target(read, ENVELOPE_TARGET, source=payload, keep=[*keep_all, "_env"])
    env, wrong = F.col("_env"), F.transform(casting.ERRORS, lambda e: e["column"])
    typed = typed.withColumn("_missing", wire.envelope_missing_required(env))
    problem = (F.when(env.isNull() | env["_corrupt"].isNotNull(), F.lit("value is not a JSON object"))
               .when(env["schema"].isNull() | env["payload"].isNull(),
                     F.lit("envelope needs schema and payload"))
               .when(F.size("_missing") > 0,
                     F.concat(F.lit("null value for required field "), F.array_join("_missing", ",")))
               .when(F.size(casting.ERRORS) > 0,
                     F.concat(F.lit("wrong type for field "), F.array_join(wrong, ","))))
    return typed.select(*keep_all, *[t.name for t in ENVELOPE_TARGET], "_missing", problem.alias("_problem"), casting.FENCE)


def envelope_usable(usable: bool = True) -> F.Column:
    """Filter for (un)usable envelopes; references the fence so the JSON
    parse is not inlined into the condition."""
    p = envelope_problem()
    return (p.isNull() if usable else p.isNotNull()) & (F.col(casting.FENCE) >= 0)


def envelope_problem() -> F.Column:
    """Why a decoded envelope is unusable, or NULL when it is fine."""
    return F.col("_problem")


def envelope_rows(parsed: DataFrame, keep: list[str] = ["offset"],
                  whitelist: list[str] | None = None) -> DataFrame:
    """Typed payload columns of usable envelopes, restricted to ``whitelist``."""
    names = whitelist or [f for f, _, _ in ENVELOPE_FIELDS]
    return parsed.where(envelope_usable(True)).select(*keep, *[t.name for t in ENVELOPE_TARGET if t.name in names])
