"""Canonical mapping and transformation outcomes.

Every validated record yields exactly one outcome row; no row is dropped.
``abort_kind`` marks records whose mapping raises in the reference instead of
producing an outcome (a blank identifier, or a UTC overflow); one such record
fails its whole file at the transformation stage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.domain import customer_state, source_context
from sluice.functions.parsing import (
    AMOUNT_TYPE,
    integral_quantity_ok,
    line_amount,
    monetary_consistent,
    to_quantity,
    utc_overflow,
    wide_line_amount,
    WIDE_TYPE,
)
from sluice.functions.text import non_blank, normalize_identifier, normalize_text
from sluice.operators.contracts import (
    ECOMMERCE_SALES_V1,
    PRODUCT_CATALOG_V1,
    RETAIL_SALES_V1,
    Contract,
)

# Outcome statuses, issue codes and their safe messages.
SUCCESS = "SUCCESS"
UNTRANSFORMABLE = "UNTRANSFORMABLE"
AMBIGUOUS = "AMBIGUOUS"
BUSINESS_RULE_REJECTED = "BUSINESS_RULE_REJECTED"
RULE_CODE = "BUSINESS_RULE_VIOLATION"
RULE_MESSAGE = "Record violates governed transformation rules"
MAPPING_CODE = "MAPPING_IMPOSSIBLE"
MAPPING_MESSAGE = "Record cannot be deterministically transformed"
ABORT_BLANK = "blank_identifier"
ABORT_OVERFLOW = "utc_overflow"

PROVENANCE_FIELDS = ("contract_id", "contract_version", "source_identifier",
                     "content_sha256", "source_id", "run_id", "row_number")
#: What mappers hand on from the validated row: its provenance, and the key of its first failure.
CARRIED_FIELDS = (*PROVENANCE_FIELDS, "failure_key")
SALES_LINE_COLUMNS = (
    "sales_channel_code", "source_transaction_number", "transaction_timestamp",
    "store_code", "customer_reference_state", "product_sku", "quantity",
    "unit_price", "unit_price_wide", "currency_code", "line_amount", "line_amount_wide",
    "source_local_context")
PRODUCT_COLUMNS = ("sku", "product_name", "category_code", "list_price", "list_price_wide", "unit_cost",
                   "unit_cost_wide", "product_currency_code")


def _wide(df: DataFrame, name: str) -> Column:
    """The wide values of a decimal field; none in frames made without them."""
    return F.col(name + "_wide") if name + "_wide" in df.columns else F.lit(None).cast(WIDE_TYPE)


def new_run_id() -> str:
    """One run id per job (not per row, not per task retry)."""
    return str(uuid.uuid4())


def attach_provenance(df: DataFrame, run_id: str | None = None) -> DataFrame:
    """The record provenance as one struct column."""
    rid = run_id or new_run_id()
    if "run_id" not in df.columns:
        df = df.withColumn("run_id", F.lit(rid))
    return df.withColumn("provenance", F.struct(*[F.col(c) for c in PROVENANCE_FIELDS]))


def _first_abort(*checks: tuple[Column, str]) -> Column:
    expr = None
    for cond, kind in checks:
        expr = F.when(cond, F.lit(kind)) if expr is None else expr.when(cond, F.lit(kind))
    return expr


def _outcome(rule_ok: Column, abort: Column, mappable: Column) -> tuple[Column, Column, Column]:
    status = (
        F.when(~rule_ok, F.lit(BUSINESS_RULE_REJECTED))
        .when(abort.isNotNull(), F.lit(None).cast("string"))
        .when(~mappable, F.lit(UNTRANSFORMABLE))
        .otherwise(F.lit(SUCCESS))
    )
    code = (F.when(status == BUSINESS_RULE_REJECTED, F.lit(RULE_CODE))
            .when(status == UNTRANSFORMABLE, F.lit(MAPPING_CODE)))
    message = (F.when(status == BUSINESS_RULE_REJECTED, F.lit(RULE_MESSAGE))
               .when(status == UNTRANSFORMABLE, F.lit(MAPPING_MESSAGE)))
    return status, code, message


def map_sales_lines(validated: DataFrame, contract: Contract) -> DataFrame:
    """E-commerce or retail records -> canonical sales lines."""
    retail = contract.channel == "RETAIL"
    txn_field = "receipt_number" if retail else "order_number"
    ts_field = "transaction_timestamp" if retail else "order_timestamp"
    q, price, price_wide = F.col("quantity"), F.col("unit_price"), _wide(validated, "unit_price")
    rule_ok = integral_quantity_ok(q, _wide(validated, "quantity"))
    instant = F.col(ts_field)
    # Mapping order of the reference: transaction number, timestamp, store, sku.
    checks = [(~non_blank(txn_field), ABORT_BLANK), (utc_overflow(instant), ABORT_OVERFLOW)]
    if retail:
        checks.append((~non_blank("store_code"), ABORT_BLANK))
    checks.append((~non_blank("sku"), ABORT_BLANK))
    abort = F.when(rule_ok, _first_abort(*checks))
    # columns of their own, so that the status doesn't compute them again
    validated = validated.withColumn("_quantity", to_quantity(q))
    qty = F.col("_quantity")
    validated = validated.withColumns({
        "_amount": F.when(price_wide.isNull(), line_amount(qty, price)).cast(AMOUNT_TYPE),
        "_amount_wide": wide_line_amount(qty, price, price_wide)})
    amount, amount_wide = F.col("_amount"), F.col("_amount_wide")
    status, code, message = _outcome(rule_ok, abort, amount.isNotNull() | amount_wide.isNotNull())
    canonical = [
        F.lit(contract.channel).alias("sales_channel_code"),
        normalize_identifier(txn_field).alias("source_transaction_number"),
        instant.alias("transaction_timestamp"),
        (normalize_identifier("store_code") if retail else F.lit(None).cast("string")).alias("store_code"),
        (F.lit("ABSENT") if retail else customer_state("customer_email")).alias("customer_reference_state"),
        normalize_identifier("sku").alias("product_sku"),
        qty.alias("quantity"),
        price.alias("unit_price"), price_wide.alias("unit_price_wide"),
        F.col("currency_code").alias("currency_code"),
        amount.alias("line_amount"), amount_wide.alias("line_amount_wide"),
        (source_context("terminal_id") if retail else source_context()).alias("source_local_context"),
    ]
    prov = [c for c in CARRIED_FIELDS if c in validated.columns]
    return validated.select(
        *prov, status.alias("status"), code.alias("issue_code"), message.alias("issue_message"),
        abort.alias("abort_kind"),
        *canonical,
    ).withColumns({name: F.when(F.col("status") == SUCCESS, F.col(name))
                   for name in SALES_LINE_COLUMNS})


def map_products(validated: DataFrame, contract: Contract = PRODUCT_CATALOG_V1) -> DataFrame:
    """Product records -> canonical products (monetary rule first)."""
    price_wide, cost_wide = _wide(validated, "list_price"), _wide(validated, "unit_cost")
    either = lambda name, wide: F.coalesce(F.col(name).isNotNull() | wide.isNotNull(), F.lit(False))
    mark = lambda there: F.when(there, F.lit(1))
    rule_ok = monetary_consistent(mark(either("list_price", price_wide)), mark(either("unit_cost", cost_wide)),
                                  "currency_code")
    abort = F.when(rule_ok, _first_abort(
        (~non_blank("sku"), ABORT_BLANK),
        (~non_blank("product_name"), ABORT_BLANK),
        (~non_blank("category_code"), ABORT_BLANK)))
    status, code, message = _outcome(rule_ok, abort, F.lit(True))
    prov = [c for c in CARRIED_FIELDS if c in validated.columns]
    out = validated.select(
        *prov, status.alias("status"), code.alias("issue_code"), message.alias("issue_message"),
        abort.alias("abort_kind"),
        normalize_identifier("sku").alias("sku"),
        normalize_text("product_name").alias("product_name"),
        normalize_identifier("category_code").alias("category_code"),
        F.col("list_price"), price_wide.alias("list_price_wide"), F.col("unit_cost"), cost_wide.alias("unit_cost_wide"),
        F.col("currency_code").alias("product_currency_code"),
    )
    return out.withColumns({name: F.when(F.col("status") == SUCCESS, F.col(name))
                            for name in PRODUCT_COLUMNS})


#: E5: contract key -> mapper.  Users may add their own.
MAPPERS: dict[tuple[str, int], Callable[[DataFrame, Contract], DataFrame]] = {
    PRODUCT_CATALOG_V1.key: map_products,
    ECOMMERCE_SALES_V1.key: map_sales_lines,
    RETAIL_SALES_V1.key: map_sales_lines,
}


def canonicalize(validated: DataFrame, contract: Contract, run_id: str | None = None,
                 mappers=None, ruleset_version: int = 1) -> DataFrame:
    """P21 + P22: dispatch on the exact contract and classify every record.

    A record of another contract is a fault of the caller and fails the job; the
    outcomes carry the version of the rules that made them."""
    mappers = mappers or MAPPERS
    if contract.key not in mappers:
        raise LookupError(f"no mapping rules for contract {contract.key}")
    if "contract_id" in validated.columns:
        same = (F.col("contract_id") == contract.contract_id) & (F.col("contract_version") == contract.version)
        validated = validated.withColumn("contract_id", F.when(same, F.col("contract_id")).otherwise(
            F.raise_error(F.lit("record and rules name different contracts")).cast("string")))
    if "run_id" not in validated.columns:
        validated = validated.withColumn("run_id", F.lit(run_id or new_run_id()))
    return mappers[contract.key](validated, contract).withColumn("ruleset_version", F.lit(ruleset_version))


def mapped_states(validated: DataFrame, contract: Contract, files: Sequence[str], mappers=None) -> DataFrame:
    """What :func:`batch_counts` and the first failure need of each file, in one pass over its rows:
    the least ``failure_key`` and the states of :func:`count_states`, which merge.

    The rows are mapped without waiting for their file's outcome; the states of a file that
    turns out to have failures are not to be used."""
    mappers = mappers or MAPPERS
    if contract.key not in mappers:
        raise LookupError(f"no mapping rules for contract {contract.key}")
    # a mapper hands on provenance; the file's columns go through it in the place of the run id
    rows = validated.withColumn("run_id", F.struct(*files))
    return mappers[contract.key](rows, contract).groupBy("run_id").agg(
        F.min("failure_key").alias("failure_key"), *count_states()).select(
        "run_id.*", "failure_key", *STATES)


def successful_records(outcomes: DataFrame) -> DataFrame:
    """Canonical records of SUCCESS outcomes (order by row_number at the edge)."""
    # Spark pushes no filter past a row's number: a filter on the status alone would be
    # pushed into the parsing, with all that the status is made of written out again.
    numbered = outcomes.withColumn("_row", F.monotonically_increasing_id())
    return numbered.where((F.col("status") == SUCCESS) & (F.col("_row") >= 0)).drop(
        "status", "issue_code", "issue_message", "abort_kind", "ruleset_version", "_row")


def union_sales_lines(*frames: DataFrame) -> DataFrame:
    """U4: both channels share one canonical type."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def abort_key() -> Column:
    """The row's abort as (row, kind) in a bigint; the least key is the first abort."""
    kind_code = F.when(F.col("abort_kind") == ABORT_BLANK, 0).when(
        F.col("abort_kind") == ABORT_OVERFLOW, 1)
    return F.when(kind_code.isNotNull(), F.shiftleft(F.col("row_number"), 1).bitwiseOR(kind_code.cast("long")))


def abort_of_key(key: Column) -> Column:
    return F.when(key.isNotNull(), F.when(
        key.bitwiseAND(F.lit(1)) == 0, F.lit(ABORT_BLANK)).otherwise(F.lit(ABORT_OVERFLOW)))


def failed_outcome() -> Column:
    return F.col("status").isNotNull() & (F.col("status") != SUCCESS)


def batch_counts(outcomes: DataFrame, file_col: str = "source_id") -> DataFrame:
    """A7 + P24: per-file record/success/failure counts and the first abort.

    The first abort (lowest row number) decides the failure kind; the
    (row, kind) pair is packed into a bigint to stay a hash aggregate."""
    return _counts(outcomes.groupBy(file_col).agg(*count_states()), file_col)


STATES = ("record_count", "success_count", "failure_count", "_abort")


def count_states() -> list[Column]:
    return [F.count(F.lit(1)).alias("record_count"),
            F.count_if(F.col("status") == SUCCESS).alias("success_count"),
            F.count_if(failed_outcome()).alias("failure_count"),
            F.min(abort_key()).alias("_abort")]


def batch_counts_of(states: DataFrame, file_col: str = "source_id") -> DataFrame:
    """:func:`batch_counts` from states of parts of the files."""
    merged = [F.sum(c).alias(c) for c in STATES[:3]]
    return _counts(states.groupBy(file_col).agg(*merged, F.min("_abort").alias("_abort")), file_col)


def _counts(agg: DataFrame, file_col: str) -> DataFrame:
    return agg.select(
        file_col, "record_count", "success_count", "failure_count",
        abort_of_key(F.col("_abort")).alias("abort_kind"),
        F.shiftright(F.col("_abort"), 1).alias("abort_row_number"))


def _digest(columns: Sequence[str]) -> Column:
    """128 bits of a row's values, nulls marked; other values have others, but once in 2^128 pairs."""
    values = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return F.struct(*[F.xxhash64(F.lit(salt), *values).alias(f"h{salt}") for salt in (1, 2)])


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def check_coherence(outcomes: DataFrame, accepted: DataFrame | None = None) -> DataFrame:
    """Outcome invariants, one ``reason`` per broken row (null: coherent).

    Whether a record is there is read off its mandatory columns and not off the
    status. With ``accepted`` (the batch the outcomes came from), the identity of each
    outcome must be that of a row of the batch."""
    mandatory = [c for c in ("sales_channel_code", "source_transaction_number", "sku", "product_name")
                 if c in outcomes.columns]
    has_record = F.lit(True)
    for c in mandatory:
        has_record = has_record & F.col(c).isNotNull()
    has_issue = F.col("issue_code").isNotNull() | F.col("issue_message").isNotNull()
    whole_issue = F.col("issue_code").isNotNull() & F.col("issue_message").isNotNull()
    reason = (F.when(F.col("status").isNull() & F.col("abort_kind").isNull(), F.lit("no_outcome"))
              .when((F.col("status") == SUCCESS) & ~has_record, F.lit("success_without_record"))
              .when((F.col("status") == SUCCESS) & has_issue, F.lit("success_with_issue"))
              .when((F.col("status") != SUCCESS) & ~whole_issue, F.lit("failure_without_issue"))
              .when((F.col("status") != SUCCESS) & has_record, F.lit("failure_with_record")))
    out = outcomes.withColumn("reason", reason)
    if accepted is not None:
        # both sides send 128-bit digests of the key and of the identity, a third of their width
        keys = ["source_id", "row_number"]
        identity = ["contract_id", "contract_version", "source_identifier", "content_sha256"]
        whole = F.col("source_id").isNotNull() & F.col("row_number").isNotNull()
        batch = accepted.select(F.when(whole, _digest(keys)).alias("_b_key"), _digest(identity).alias("_b_same"))
        out = out.withColumns({"_key": F.when(whole, _digest(keys)), "_same": _digest(identity)}).join(
            batch, F.col("_key") == F.col("_b_key"), "left")
        # an outcome without a row in the batch agrees only if it has no identity at all
        bare = _all([F.col(c).isNull() for c in identity])
        differs = F.when(F.col("_b_same").isNull(), ~bare).otherwise(F.col("_same") != F.col("_b_same"))
        out = out.withColumn("reason", F.coalesce("reason", F.when(differs, F.lit("foreign_identity"))))
        out = out.drop("_key", "_same", "_b_key", "_b_same")
    return out.withColumn("coherent", F.col("reason").isNull())
