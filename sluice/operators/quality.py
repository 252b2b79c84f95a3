"""Data-quality expectations, evaluation and summary.

An :class:`Expectation` is declared with ``Column`` expressions: for GROUP and
COLLECTION scopes they are aggregate expressions evaluated per scope group,
for RECORD scope they are row expressions.  Evaluation is one aggregation per
expectation plus a ``CASE``, with no Python on the data path.  Provenance of
violations is returned as a long table (:func:`affected_records`) instead of
an unbounded array on the outcome row."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import scope_reference

RECORD, COLLECTION, GROUP = "RECORD", "COLLECTION", "GROUP"
BLOCKING, NON_BLOCKING = "BLOCKING", "NON_BLOCKING"
SATISFIED, VIOLATED = "SATISFIED", "VIOLATED"
NOT_APPLICABLE, EVALUATION_ERROR = "NOT_APPLICABLE", "EVALUATION_ERROR"
# Evidence codes and the evaluation-error reason.
DUPLICATE_SKU = "DUPLICATE_SKU"
MIXED_TRANSACTION_CURRENCY = "MIXED_TRANSACTION_CURRENCY"
INCOHERENT_TRANSACTION_GROUP = "INCOHERENT_TRANSACTION_GROUP"

EVIDENCE_TYPE = ("struct<issue_code:string,duplicate_sku:string,"
                 "affected_count:bigint,reason_code:string>")


def evidence(issue_code=None, duplicate_sku=None, affected_count=None, reason_code=None) -> Column:
    def v(x, t):
        if x is None:
            return F.lit(None).cast(t)
        return (F.lit(x) if isinstance(x, str) else x).cast(t)
    return F.struct(
        v(issue_code, "string").alias("issue_code"),
        v(duplicate_sku, "string").alias("duplicate_sku"),
        v(affected_count, "bigint").alias("affected_count"),
        v(reason_code, "string").alias("reason_code"),
    )


@dataclass(frozen=True)
class Expectation:
    """Definition + behaviour of one expectation.

    ``keys``: columns naming one evaluated scope (RECORD: the row key).
    ``evaluated_scope``: Column over ``keys`` giving the scope reference.
    ``applies`` / ``satisfied``: boolean (aggregate) Columns.
    ``applies_unavailable`` / ``condition_unavailable``: reason-code Columns,
    null when the behaviour could decide.
    ``affected_scope`` / ``evidence_of``: Columns describing a violation.
    ``prepare``: optional pre-aggregation of the records (e.g. per-key counts),
    applied before the per-scope aggregation."""

    expectation_id: str
    version: int
    scope: str
    disposition: str
    keys: tuple[str, ...]
    evaluated_scope: Callable[[], Column]
    satisfied: Callable[[], Column]
    applies: Callable[[], Column] = lambda: F.lit(True)
    applies_unavailable: Callable[[], Column] | None = None
    condition_unavailable: Callable[[], Column] | None = None
    affected_scope: Callable[[], Column] | None = None
    evidence_of: Callable[[], Column] | None = None
    prepare: Callable[[DataFrame], DataFrame] | None = None
    description: str = ""
    evidence_on_satisfied: bool = False


PROVENANCE_TYPE = "array<struct<source_id:string,source_identifier:string,row_number:bigint>>"


def _provenance(df: DataFrame, e: Expectation) -> Column:
    """A RECORD outcome names its record; COLLECTION and GROUP outcomes name none."""
    if e.scope != RECORD:
        return F.lit(None).cast(PROVENANCE_TYPE)
    field = lambda c: F.col(c) if c in df.columns else F.lit(None)
    return F.array(F.struct(*[field(c).alias(c) for c in ("source_id", "source_identifier", "row_number")])).cast(
        PROVENANCE_TYPE)


def _scope_rows(records: DataFrame, e: Expectation) -> DataFrame:
    df = e.prepare(records) if e.prepare else records
    null_reason = lambda: F.lit(None).cast("string")
    cols = [
        e.evaluated_scope().alias("evaluated_scope"),
        e.applies().alias("_applies"),
        (e.applies_unavailable or null_reason)().alias("_applies_unavailable"),
        e.satisfied().alias("_satisfied"),
        (e.condition_unavailable or null_reason)().alias("_condition_unavailable"),
        (e.affected_scope or null_reason)().alias("_affected_scope"),
        (e.evidence_of or (lambda: evidence()))().cast(EVIDENCE_TYPE).alias("_evidence"),
    ]
    if e.scope == RECORD:
        cols.append(_provenance(df, e).alias("provenance"))
    if e.scope == RECORD:
        return df.select(*e.keys, *cols)
    return df.groupBy(*e.keys).agg(*cols).withColumn("provenance", _provenance(df, e))


def evaluate_quality(records: DataFrame, expectations: Sequence[Expectation]) -> DataFrame:
    """E2 + E3: one outcome per expectation and evaluated scope.

    Precedence per scope: applicability unavailable -> EVALUATION_ERROR; not
    applicable -> NOT_APPLICABLE (the condition is not used); condition
    unavailable -> EVALUATION_ERROR; satisfied -> SATISFIED; else VIOLATED
    with disposition and affected scope.  A null boolean fails the job, as a
    wrong return type does in the reference."""
    out = None
    for ordinal, e in enumerate(expectations, start=1):
        s = _scope_rows(records, e)
        status = (
            F.when(F.col("_applies_unavailable").isNotNull(), F.lit(EVALUATION_ERROR))
            .when(F.col("_applies").isNull(),
                  F.raise_error(F.lit("whether an expectation applies is neither true nor false")))
            .when(~F.col("_applies"), F.lit(NOT_APPLICABLE))
            .when(F.col("_condition_unavailable").isNotNull(), F.lit(EVALUATION_ERROR))
            .when(F.col("_satisfied").isNull(),
                  F.raise_error(F.lit("an expectation's condition is neither true nor false")))
            .when(F.col("_satisfied"), F.lit(SATISFIED))
            .otherwise(F.lit(VIOLATED))
        ).cast("string")
        reason = F.coalesce(F.col("_applies_unavailable"), F.col("_condition_unavailable"))
        ev = (
            F.when(status == EVALUATION_ERROR, evidence(reason_code=reason))
            .when(status == VIOLATED, F.col("_evidence"))
            .when((status == SATISFIED) & F.lit(e.evidence_on_satisfied), F.col("_evidence"))
            .otherwise(evidence())
        ).cast(EVIDENCE_TYPE)
        o = s.select(
            *e.keys,
            F.lit(ordinal).alias("expectation_ordinal"),
            F.lit(e.expectation_id).alias("expectation_id"),
            F.lit(e.version).alias("expectation_version"),
            F.lit(e.scope).alias("evaluation_scope"),
            status.alias("status"),
            "evaluated_scope",
            F.when(status == VIOLATED, F.lit(e.disposition)).alias("disposition"),
            F.when(status == VIOLATED, F.col("_affected_scope")).alias("affected_scope"),
            ev.alias("evidence"), "provenance",
        )
        out = o if out is None else out.unionByName(o, allowMissingColumns=True)
    return out


# ----------------------------------------------------------- built-in rules
_TRANSACTION = ("source_id", "sales_channel_code", "source_transaction_number")


def _currency_counts(lines: DataFrame) -> DataFrame:
    # lines per (transaction, currency): a plain hash aggregate for codes of any length
    return lines.groupBy(*_TRANSACTION, "currency_code").agg(F.count(F.lit(1)).alias("_n"))


def _sku_counts(products: DataFrame) -> DataFrame:
    # Per (file, sku) count and first row; a plain hash aggregate.
    return products.groupBy("source_id", "sku").agg(
        F.count(F.lit(1)).alias("_n"), F.min("row_number").alias("_first_row"))


def _dup(c: Column) -> Column:
    return F.when(F.col("_n") > 1, c)


PRODUCT_SKU_UNIQUENESS = Expectation(
    expectation_id="DQ-PRODUCT-001", version=1, scope=COLLECTION, disposition=BLOCKING,
    keys=("source_id",),
    evaluated_scope=lambda: F.lit("product-catalog:v1"),
    satisfied=lambda: F.max("_n") <= 1,
    affected_scope=lambda: F.concat(F.lit("product-sku:"), F.min_by(
        _dup(F.col("sku")), _dup(F.col("_first_row")))),
    evidence_of=lambda: evidence(
        DUPLICATE_SKU, F.min_by(_dup(F.col("sku")), _dup(F.col("_first_row"))),
        F.sum(_dup(F.col("_n")))),
    prepare=_sku_counts,
    description="No two products of a file share a SKU",
)

SALES_TRANSACTION_CURRENCY = Expectation(
    expectation_id="DQ-SALES-001", version=1, scope=GROUP, disposition=BLOCKING,
    keys=_TRANSACTION,
    evaluated_scope=lambda: scope_reference(
        "sales-transaction", "sales_channel_code", "source_transaction_number"),
    satisfied=lambda: F.count(F.lit(1)) <= 1,
    affected_scope=lambda: scope_reference(
        "transaction", "sales_channel_code", "source_transaction_number"),
    evidence_of=lambda: evidence(MIXED_TRANSACTION_CURRENCY, None, F.sum("_n")),
    prepare=_currency_counts,
    description="All lines of a transaction are in one currency",
)


def sku_uniqueness(products: DataFrame) -> DataFrame:
    """A1: DQ-PRODUCT-001 per product file."""
    return evaluate_quality(products, [PRODUCT_SKU_UNIQUENESS])


def transaction_currency(lines: DataFrame) -> DataFrame:
    """A2 + A3: DQ-SALES-001 per (file, channel, transaction)."""
    return evaluate_quality(lines, [SALES_TRANSACTION_CURRENCY])


def affected_records(records: DataFrame, outcomes: DataFrame, expectation: Expectation) -> DataFrame:
    """The records named by violated outcomes (all rows of a duplicated
    SKU; all lines of a mixed transaction), as a long provenance table."""
    violated = outcomes.where(F.col("status") == VIOLATED)
    if expectation is PRODUCT_SKU_UNIQUENESS:
        dup_keys = _sku_counts(records).where(F.col("_n") > 1).select("source_id", "sku")
        keys = dup_keys.join(violated.select("source_id"), "source_id", "left_semi")
        return records.join(keys, ["source_id", "sku"], "left_semi")
    return records.join(violated.select(*expectation.keys), list(expectation.keys), "left_semi")


def group_coherence(groups: DataFrame, members: DataFrame, group_col: str = "group_id") -> DataFrame:
    """A4: caller-supplied groups must be non-empty and hold one
    (channel, transaction); otherwise DQ-SALES-001 is an EVALUATION_ERROR
    with reason INCOHERENT_TRANSACTION_GROUP.  Coherent groups are evaluated
    normally (SATISFIED / VIOLATED)."""
    # the currency rule of A2 per transaction, then the transactions of each group
    transactions = members.groupBy(group_col, "sales_channel_code", "source_transaction_number", "currency_code").agg(
        F.count(F.lit(1)).alias("_n")).groupBy(group_col, "sales_channel_code", "source_transaction_number").agg(
        F.count(F.lit(1)).alias("_currencies"), F.sum("_n").alias("_n"))
    per_group = transactions.groupBy(group_col).agg(
        F.count(F.lit(1)).alias("_transactions"), F.sum("_n").alias("_n"), F.max("_currencies").alias("_currencies"),
        F.any_value("sales_channel_code").alias("_ch"), F.any_value("source_transaction_number").alias("_txn"))
    g = groups.select(group_col).join(per_group, group_col, "left")
    n = F.col("_n")
    incoherent = F.coalesce(F.col("_transactions") != 1, F.lit(True))
    status = (F.when(incoherent, F.lit(EVALUATION_ERROR))
              .when(F.col("_currencies") == 1, F.lit(SATISFIED))
              .otherwise(F.lit(VIOLATED)))
    return g.select(
        group_col, status.alias("status"),
        F.when(incoherent, F.lit(INCOHERENT_TRANSACTION_GROUP)).alias("reason_code"),
        F.when(status == VIOLATED, F.lit(BLOCKING)).alias("disposition"),
        F.when(status == VIOLATED, scope_reference("transaction", "_ch", "_txn")).alias("affected_scope"),
        F.when(status == VIOLATED, n).cast("long").alias("affected_count"),
    )


def summarize_quality(outcomes: DataFrame, by: Sequence[str] | None = None) -> DataFrame:
    """A5: the eight counts (one all-zero row on empty input when ``by`` is None)."""
    st = F.col("status")
    counts = [
        F.count(F.lit(1)).alias("total_evaluation_count"),
        F.count_if(st.isin(SATISFIED, VIOLATED)).alias("applicable_evaluation_count"),
        F.count_if(st == SATISFIED).alias("satisfied_count"),
        F.count_if(st == VIOLATED).alias("violation_count"),
        F.count_if((st == VIOLATED) & (F.col("disposition") == BLOCKING)).alias("blocking_violation_count"),
        F.count_if((st == VIOLATED) & (F.col("disposition") == NON_BLOCKING)).alias("non_blocking_violation_count"),
        F.count_if(st == NOT_APPLICABLE).alias("not_applicable_count"),
        F.count_if(st == EVALUATION_ERROR).alias("evaluation_error_count"),
    ]
    if by:
        return outcomes.groupBy(*by).agg(*counts)
    return outcomes.agg(*counts)


def quality_verdict(outcomes: DataFrame, file_col: str = "source_id") -> DataFrame:
    """Per file, any evaluation error / any blocking violation."""
    st = F.col("status")
    return outcomes.groupBy(file_col).agg(
        F.bool_or(st == EVALUATION_ERROR).alias("any_evaluation_error"),
        F.bool_or((st == VIOLATED) & (F.col("disposition") == BLOCKING)).alias("any_blocking_violation"),
    )
