"""Pure ``Column`` functions (no DataFrame work): text rules, typed parsing,
business rules and domain predicates.  All of them compile to JVM
expressions, so they stay inside whole-stage code generation."""

from sluice.functions.text import (  # noqa: F401
    STRIP_CLASS_JAVA,
    STRIP_CLASS_RE2,
    btrim_blank,
    is_failure_code,
    is_relative_path,
    is_sha256,
    non_blank,
    normalize_identifier,
    normalize_text,
    scope_reference,
    unicode_strip,
)
from sluice.functions.parsing import (  # noqa: F401
    DECIMAL_GRAMMAR,
    TIMESTAMP_GRAMMAR,
    CURRENCY_GRAMMAR,
    decimal_error,
    parse_decimal,
    parse_timestamp,
    timestamp_error,
    is_currency_code,
    integral_quantity_ok,
    line_amount,
    monetary_consistent,
    to_quantity,
)
from sluice.functions.domain import (  # noqa: F401
    channel_code,
    customer_state,
    duration_micros,
    exit_status,
    in_domain,
    parse_versioned_name,
    positive_int,
    source_context,
    timestamp_order_ok,
)
