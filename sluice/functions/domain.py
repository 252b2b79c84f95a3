"""Domain scalars: channel, customer state, context, exit status, durations,
state domains, versioned names (F7-F9, F14, F16-F19, U5)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Canonical enumerations.
CUSTOMER_ABSENT = "ABSENT"
CUSTOMER_UNRESOLVED = "UNRESOLVED_SOURCE_REFERENCE"
PIPELINE_STATES = ("PENDING", "RUNNING", "SUCCEEDED", "BLOCKED", "FAILED")
STAGE_STATES = ("PENDING", "RUNNING", "SUCCEEDED", "FAILED", "SKIPPED")
STAGES = ("INGESTION", "TRANSFORMATION", "DATA_QUALITY")
OUTCOME_STATUSES = ("SUCCESS", "UNTRANSFORMABLE", "AMBIGUOUS", "BUSINESS_RULE_REJECTED")
QUALITY_STATUSES = ("SATISFIED", "VIOLATED", "NOT_APPLICABLE", "EVALUATION_ERROR")
DISPOSITIONS = ("BLOCKING", "NON_BLOCKING")
EVALUATION_SCOPES = ("RECORD", "COLLECTION", "GROUP")
FAILURE_CATEGORIES = (
    "INGESTION_FAILURE", "TRANSFORMATION_FAILURE", "DATA_QUALITY_EVALUATION_FAILURE",
    "INVALID_STAGE_RESULT", "PERSISTENCE_FAILURE", "CONFIGURATION_FAILURE",
    "UNEXPECTED_EXECUTION_FAILURE",
)
# Migration / ledger artifact names ``VNNN__name.sql``.
VERSIONED_NAME_PATTERN = "\\AV([0-9]{3})__([a-z0-9_]+)\\.sql\\z"


def channel_code(contract_id: Column | str, mapping: dict[str, str]) -> Column:
    """F8: contract id -> sales channel code (``ECOMMERCE`` / ``RETAIL``)."""
    c = _col(contract_id)
    expr = None
    for cid, code in mapping.items():
        expr = (F.when(c == cid, F.lit(code)) if expr is None
                else expr.when(c == cid, F.lit(code)))
    return expr


def customer_state(email: Column | str) -> Column:
    """``ABSENT`` when no email, else ``UNRESOLVED_SOURCE_REFERENCE``.
    The email itself is never carried to an output."""
    return F.when(_col(email).isNull(), F.lit(CUSTOMER_ABSENT)).otherwise(
        F.lit(CUSTOMER_UNRESOLVED))


def source_context(terminal_id: Column | str | None = None) -> Column:
    """source-local context map; only ``terminal_id`` is ever written."""
    if terminal_id is None:
        return F.create_map().cast("map<string,string>")
    return F.create_map(F.lit("terminal_id"), _col(terminal_id))


def exit_status(state: Column | str) -> Column:
    """SUCCEEDED 0, BLOCKED 3, anything else 1."""
    s = _col(state)
    return F.when(s == "SUCCEEDED", 0).when(s == "BLOCKED", 3).otherwise(1)


def in_domain(c: Column | str, values: Iterable[str]) -> Column:
    """The value belongs to an enumerated set."""
    return _col(c).isin(list(values))


def positive_int(c: Column | str) -> Column:
    """versions and row numbers are integers > 0."""
    return _col(c) > 0


def duration_micros(started: Column | str, completed: Column | str) -> Column:
    """F16: ``completed - started`` in microseconds, null unless both exist."""
    s, c = _col(started), _col(completed)
    return F.when(s.isNotNull() & c.isNotNull(), F.unix_micros(c) - F.unix_micros(s))


def timestamp_order_ok(started: Column | str, completed: Column | str) -> Column:
    """completion is not before the start (null parts pass)."""
    s, c = _col(started), _col(completed)
    return s.isNull() | c.isNull() | (c >= s)


def parse_versioned_name(name: Column | str) -> tuple[Column, Column, Column]:
    """(well_formed, version, name) of a ``VNNN__name.sql`` artifact."""
    n = _col(name)
    ok = n.rlike(VERSIONED_NAME_PATTERN)
    version = F.when(ok, F.regexp_extract(n, VERSIONED_NAME_PATTERN, 1).cast("int"))
    label = F.when(ok, F.regexp_extract(n, VERSIONED_NAME_PATTERN, 2))
    return ok, version, label
