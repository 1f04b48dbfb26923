"""Cast text (or loosely typed) columns to a target with an error policy.

``apply_target`` adds the typed columns and an ``_errors`` array in three
narrow projections (clean inputs, cast, collect errors): nothing leaves the
JVM and the same expressions serve the three policies of the reference loads:

* ``fail``   – any bad row raises (ANSI-style), the load stops;
* ``drop``   – bad rows are skipped (ignore-parse-errors, header rows);
* ``reject`` – bad rows go to a reject/dead-letter output with the reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.schemas import Target

ERRORS = "_errors"
POLICIES = ("fail", "drop", "reject")


def _parse(src: Column, t: Target) -> Column:
    if t.dtype in ("timestamp_ntz", "timestamp") and t.fmt:
        return F.try_to_timestamp(src, F.lit(t.fmt)).cast(t.dtype)
    if t.dtype == "date" and t.fmt:
        return F.try_to_timestamp(src, F.lit(t.fmt)).cast("date")
    return src.try_cast(t.dtype)


def _err(name: str, message: str, bad: Column) -> Column:
    return F.when(bad, F.struct(F.lit(name).alias("column"), F.lit(message).alias("message")))


def apply_target(
    df: DataFrame,
    targets: list[Target],
    source: dict[str, str | Column] | None = None,
    keep: list[str] | None = None,
    trim: bool = False,
    checks: list[tuple[str, Column, str]] | None = None,
) -> DataFrame:
    """``keep`` columns + typed target columns + ``_errors``.

    ``source`` maps a target name to its input column (default: same name);
    ``None`` means absent, and the target's default is used.  Text inputs are
    trimmed when ``trim`` is set; empty text is NULL for non-text targets.
    ``checks`` adds (column, failing condition on typed values, message).

    Three projections, so each input is cleaned once, each cast runs once, and
    the error list reads the finished columns by name.
    """
    keep = list(keep or [])
    source = source or {}
    key = _memo_key(targets, source, trim, checks)
    built = _BUILT.get(key) if key is not None else None
    if built is None:
        built = _build(targets, source, trim, checks)
        if key is not None:
            _BUILT[key] = built
    srcs, mids, typed, errors = built
    step1 = df.select(*keep, *srcs)
    step2 = step1.select(*keep, *mids, *typed)
    return step2.select(*keep, *[t.name for t in targets], errors.alias(ERRORS),
                        F.spark_partition_id().alias(FENCE))


# Column trees for a target are constant: build them once per process (each
# F.* call is a round trip to the JVM, thousands per target).
_BUILT: dict = {}


def _memo_key(targets, source, trim, checks):
    if any(not isinstance(v, (str, type(None))) for v in source.values()):
        return None
    return (tuple(targets), tuple(sorted(source.items(), key=lambda kv: kv[0])), trim,
            id(checks) if checks is not None else None)


def _build(targets, source, trim, checks):
    srcs, typed, errs = [], [], []
    for t in targets:
        raw = source.get(t.name, t.name)
        s_name = f"_src_{t.name}"
        if raw is None:
            typed.append(F.lit(t.default).cast(t.dtype).alias(t.name))
            continue
        src = F.col(raw) if isinstance(raw, str) else raw
        if trim:
            src = F.trim(src.cast("string"))
        if t.dtype != "string":
            src = F.when(src.cast("string") != F.lit(""), src)
        srcs.append(src.alias(s_name))
        s = F.col(s_name)
        value = _parse(s, t) if t.dtype != "string" else s.cast("string")
        if t.default is not None:
            # only for an absent or empty input: an uncastable one is an error
            value = F.when(s.isNull(), F.lit(t.default).cast(t.dtype)).otherwise(value)
        typed.append(value.alias(t.name))
        v = F.col(t.name)
        if t.dtype != "string":
            errs.append(_err(t.name, f"cannot cast to {t.dtype}", s.isNotNull() & v.isNull()))
        if t.max_len is not None:
            errs.append(_err(t.name, f"longer than {t.max_len}", F.length(v) > t.max_len))
        if not t.nullable:
            errs.append(_err(t.name, "null in NOT NULL column", v.isNull()))
    for name, bad, message in checks or []:
        errs.append(_err(name, message, bad))
    mids = [F.col(f"_src_{t.name}") for t in targets if source.get(t.name, t.name) is not None]
    errors = (F.filter(F.array(*errs), lambda e: e.isNotNull()) if errs
              else F.array().cast("array<struct<column:string,message:string>>"))
    return srcs, mids, typed, errors


# Catalyst pushes a Filter below any deterministic Project by inlining the
# projected expressions into the condition.  For ``size(_errors) = 0`` that
# means re-running every cast (and the message split beneath them) inside one
# huge condition that is too big for codegen.  A non-deterministic column in
# the projection stops the pushdown; the filters below reference it so column
# pruning keeps it, and it costs one int per row.
FENCE = "_fence"


def _ok(good: bool) -> Column:
    cond = F.size(ERRORS) == 0 if good else F.size(ERRORS) > 0
    return cond & (F.col(FENCE) >= 0)


def good_rows(typed: DataFrame, policy: str = "reject") -> DataFrame:
    """Rows with no error; under ``fail`` the first bad row aborts the job."""
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}")
    if policy == "fail":
        guard = F.when(
            F.size(ERRORS) > 0,
            F.raise_error(F.concat_ws(" ", F.lit("bad record:"), F.get(F.col(ERRORS), 0)["column"],
                                      F.get(F.col(ERRORS), 0)["message"])),
        ).otherwise(F.lit(True))
        return typed.where(guard & (F.col(FENCE) >= 0)).drop(ERRORS, FENCE)
    return typed.where(_ok(True)).drop(ERRORS, FENCE)


def reject_rows(typed: DataFrame, keep: list[str], stage: str | Column = "CAST") -> DataFrame:
    """One row per bad record: ``keep`` + stage, first failing column, reason."""
    first = F.get(F.col(ERRORS), 0)
    return typed.where(_ok(False)).select(
        *keep,
        (F.lit(stage) if isinstance(stage, str) else stage).alias("error_stage"),
        first["column"].alias("error_column"),
        first["message"].alias("error_message"),
    )
