"""Deterministic identifiers: row hashes, idempotency keys, event ids, trace ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEMA_VERSION = "1"
LENGTH = 32


def _short(message: Column, length: int = LENGTH) -> Column:
    return F.left(F.sha2(message, 256), F.lit(length))


def iso_z(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def slot_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyyMMdd'T'HHmm'Z'")


def row_hash(columns: list[str], logical_date: str) -> Column:
    """Key of a row that has none: hash of the date and its values in order of column name, null as ''."""
    pairs = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))) for c in sorted(columns)]
    return _short(F.concat(F.lit(f"{logical_date}\x1e"), F.concat_ws("\x1f", *pairs)))


def idempotency_key(event_type: Column | str, dataset: Column | str, slot: Column, key: Column) -> Column:
    """Hash of the logical unit of work; ``slot`` is text in ISO form with Z."""
    parts = [F.lit(SCHEMA_VERSION), *(F.lit(x) if isinstance(x, str) else x for x in (event_type, dataset)), slot, F.coalesce(key.cast("string"), F.lit(""))]
    return _short(F.concat_ws("|", *parts))


def event_id(idempotency: Column, run_id: Column | str, try_number: Column | int) -> Column:
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    attempt = F.lit(try_number) if isinstance(try_number, int) else try_number
    return _short(F.concat_ws("|", idempotency, run, attempt.cast("string")))


def trace_id(ts: Column, pipeline: str) -> Column:
    slot = F.date_format(ts, "yyyyMMdd'T'HHmm")
    return F.concat_ws("-", F.lit(pipeline), slot, _short(F.concat(F.lit(f"{pipeline}|"), slot), 6))
