"""Relational constraints as DataFrame checks.

* ``check_rows``: named row predicates; a null predicate passes, as in SQL.
* ``check_domains``: NOT NULL, character length, NUMERIC(18,2) precision/scale.
* ``check_unique_keys``: keys occurring more than once (and null primary keys).
* ``check_foreign_keys``: non-null child keys without a parent (anti join).

The SQL CHECKs use ``btrim`` (spaces only), not the Unicode strip of the
canonical rules; both live side by side on purpose."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.domain import PIPELINE_STATES, STAGE_STATES


def c(name: str) -> Column:
    return F.col(name)


def _non_blank(col: str) -> Column:
    return F.trim(c(col)) != ""


def _pattern(col: str, regex: str) -> Column:
    return c(col).rlike(f"\\A{regex}\\z")


# ---------------------------------------------------------------- S14 schema
@dataclass(frozen=True)
class ColumnSpec:
    name: str
    type: str            # bigint / int / smallint / varchar(n) / char(n) / numeric / timestamp / uuid
    nullable: bool = False


def _cols(spec: str) -> tuple[ColumnSpec, ...]:
    out = []
    for part in spec.split(","):
        name, typ = part.split()
        out.append(ColumnSpec(name, typ.rstrip("?"), typ.endswith("?")))
    return tuple(out)


# Column names, types and nullability of the governed schema.
SCHEMAS: dict[str, tuple[ColumnSpec, ...]] = {
    "sales_channels": _cols("sales_channel_id bigint, sales_channel_code varchar(32), "
                            "sales_channel_name varchar(100)"),
    "stores": _cols("store_id bigint, store_code varchar(50), store_name varchar(200), "
                    "country_code char(2)"),
    "customers": _cols("customer_id bigint"),
    "product_categories": _cols("product_category_id bigint, category_code varchar(50), "
                                "category_name varchar(200)"),
    "products": _cols("product_id bigint, sku varchar(100), product_name varchar(255), "
                      "product_category_id bigint, list_price numeric?, unit_cost numeric?, "
                      "currency_code char(3)?"),
    "orders": _cols("order_id bigint, sales_channel_id bigint, store_id bigint?, "
                    "customer_id bigint?, order_timestamp timestamp, currency_code char(3), "
                    "order_amount numeric?"),
    "order_items": _cols("order_item_id bigint, order_id bigint, line_number int, "
                         "product_id bigint, quantity int, unit_price numeric, "
                         "discount_amount numeric?, line_amount numeric"),
    "payments": _cols("payment_id bigint, order_id bigint, payment_timestamp timestamp, "
                      "payment_status varchar(50), payment_amount numeric"),
    "returns": _cols("return_id bigint, order_item_id bigint, return_timestamp timestamp, "
                     "return_quantity int, return_amount numeric?, return_reason varchar(255)?"),
    "pipeline_executions": _cols(
        "pipeline_execution_id uuid, predecessor_execution_id uuid?, state varchar(16), "
        "created_at timestamp, started_at timestamp?, completed_at timestamp?, "
        "failure_category varchar(64)?, failure_code varchar(128)?"),
    "pipeline_stage_executions": _cols(
        "pipeline_stage_execution_id bigint, pipeline_execution_id uuid, stage varchar(32), "
        "stage_sequence smallint, state varchar(16), started_at timestamp?, "
        "completed_at timestamp?, failure_category varchar(64)?, failure_code varchar(128)?"),
}

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "sales_channels": ("sales_channel_id",), "stores": ("store_id",),
    "customers": ("customer_id",), "product_categories": ("product_category_id",),
    "products": ("product_id",), "orders": ("order_id",), "order_items": ("order_item_id",),
    "payments": ("payment_id",), "returns": ("return_id",),
    "pipeline_executions": ("pipeline_execution_id",),
    "pipeline_stage_executions": ("pipeline_stage_execution_id",),
}
UNIQUE_KEYS: dict[str, tuple[tuple[str, tuple[str, ...]], ...]] = {
    "sales_channels": (("uq_sales_channels_code", ("sales_channel_code",)),),
    "stores": (("uq_stores_code", ("store_code",)),),
    "product_categories": (("uq_product_categories_code", ("category_code",)),),
    "products": (("uq_products_sku", ("sku",)),),
    "order_items": (("uq_order_items_order_line", ("order_id", "line_number")),),
    "pipeline_stage_executions": (
        ("uq_pipeline_stage_executions_pipeline_stage", ("pipeline_execution_id", "stage")),
        ("uq_pipeline_stage_executions_pipeline_sequence",
         ("pipeline_execution_id", "stage_sequence"))),
}
# (name, child table, child columns, parent table, parent columns)
FOREIGN_KEYS: tuple[tuple[str, str, tuple[str, ...], str, tuple[str, ...]], ...] = (
    ("fk_products_category", "products", ("product_category_id",), "product_categories", ("product_category_id",)),
    ("fk_orders_channel", "orders", ("sales_channel_id",), "sales_channels", ("sales_channel_id",)),
    ("fk_orders_store", "orders", ("store_id",), "stores", ("store_id",)),
    ("fk_orders_customer", "orders", ("customer_id",), "customers", ("customer_id",)),
    ("fk_order_items_order", "order_items", ("order_id",), "orders", ("order_id",)),
    ("fk_order_items_product", "order_items", ("product_id",), "products", ("product_id",)),
    ("fk_payments_order", "payments", ("order_id",), "orders", ("order_id",)),
    ("fk_returns_order_item", "returns", ("order_item_id",), "order_items", ("order_item_id",)),
    ("fk_pipeline_executions_predecessor", "pipeline_executions", ("predecessor_execution_id",),
     "pipeline_executions", ("pipeline_execution_id",)),
    ("fk_stage_executions_execution", "pipeline_stage_executions", ("pipeline_execution_id",),
     "pipeline_executions", ("pipeline_execution_id",)),
)


def struct_type(table: str) -> T.StructType:
    """A table of the governed schema as a Spark schema. Text lengths and the shape
    of identifiers are domain rules (P26), which a Spark type does not hold."""
    plain = {"bigint": T.LongType(), "int": T.IntegerType(), "smallint": T.ShortType(),
             "timestamp": T.TimestampType(), "numeric": T.DecimalType(18, 2)}
    return T.StructType([T.StructField(c.name, plain.get(c.type, T.StringType()), c.nullable)
                         for c in SCHEMAS[table]])


# ------------------------------------------------------------ P25 CHECKs
def _nn_or(col: str, cond: Column) -> Column:
    return c(col).isNull() | cond


def _stage_shape() -> Column:
    s, st, co = c("state"), c("started_at"), c("completed_at")
    fc, fcode = c("failure_category"), c("failure_code")
    no_fail = fc.isNull() & fcode.isNull()
    return (
        ((s == "PENDING") & st.isNull() & co.isNull() & no_fail)
        | ((s == "RUNNING") & st.isNotNull() & co.isNull() & no_fail)
        | ((s == "SUCCEEDED") & st.isNotNull() & co.isNotNull() & no_fail)
        | ((s == "FAILED") & st.isNotNull() & co.isNotNull() & fc.isNotNull())
        | ((s == "SKIPPED") & st.isNull() & co.isNotNull() & no_fail)
    )


CHECKS: dict[str, tuple[tuple[str, Callable[[], Column]], ...]] = {
    "sales_channels": (
        ("ck_sales_channels_code_non_blank", lambda: _non_blank("sales_channel_code")),
        ("ck_sales_channels_name_non_blank", lambda: _non_blank("sales_channel_name")),
    ),
    "stores": (
        ("ck_stores_code_non_blank", lambda: _non_blank("store_code")),
        ("ck_stores_name_non_blank", lambda: _non_blank("store_name")),
        ("ck_stores_country_code", lambda: _pattern("country_code", "[A-Z]{2}")),
    ),
    "product_categories": (
        ("ck_product_categories_code_non_blank", lambda: _non_blank("category_code")),
        ("ck_product_categories_name_non_blank", lambda: _non_blank("category_name")),
    ),
    "products": (
        ("ck_products_sku_non_blank", lambda: _non_blank("sku")),
        ("ck_products_name_non_blank", lambda: _non_blank("product_name")),
        ("ck_products_list_price_non_negative", lambda: _nn_or("list_price", c("list_price") >= 0)),
        ("ck_products_unit_cost_non_negative", lambda: _nn_or("unit_cost", c("unit_cost") >= 0)),
        ("ck_products_currency_code", lambda: _nn_or("currency_code", _pattern("currency_code", "[A-Z]{3}"))),
        ("ck_products_currency_presence", lambda: c("currency_code").isNotNull()
         == (c("list_price").isNotNull() | c("unit_cost").isNotNull())),
    ),
    "orders": (
        ("ck_orders_currency_code", lambda: _pattern("currency_code", "[A-Z]{3}")),
        ("ck_orders_amount_non_negative", lambda: _nn_or("order_amount", c("order_amount") >= 0)),
    ),
    "order_items": (
        ("ck_order_items_line_number_positive", lambda: c("line_number") > 0),
        ("ck_order_items_quantity_positive", lambda: c("quantity") > 0),
        ("ck_order_items_unit_price_non_negative", lambda: c("unit_price") >= 0),
        ("ck_order_items_discount_non_negative", lambda: _nn_or("discount_amount", c("discount_amount") >= 0)),
        ("ck_order_items_line_amount_non_negative", lambda: c("line_amount") >= 0),
    ),
    "payments": (
        ("ck_payments_status_non_blank", lambda: _non_blank("payment_status")),
        ("ck_payments_amount_non_negative", lambda: c("payment_amount") >= 0),
    ),
    "returns": (
        ("ck_returns_quantity_positive", lambda: c("return_quantity") > 0),
        ("ck_returns_amount_non_negative", lambda: _nn_or("return_amount", c("return_amount") >= 0)),
        ("ck_returns_reason_non_blank", lambda: _nn_or("return_reason", _non_blank("return_reason"))),
    ),
    "pipeline_executions": (
        ("ck_pipeline_executions_state", lambda: c("state").isin(*PIPELINE_STATES)),
        ("ck_pipeline_executions_predecessor_not_self", lambda: c("predecessor_execution_id").isNull()
         | (c("predecessor_execution_id") != c("pipeline_execution_id"))),
        ("ck_pipeline_executions_started_at", lambda: _nn_or("started_at", c("started_at") >= c("created_at"))),
        ("ck_pipeline_executions_completed_at", lambda: c("completed_at").isNull()
         | (c("started_at").isNotNull() & (c("completed_at") >= c("started_at")))),
        ("ck_pipeline_executions_failure_consistency", lambda:
         ((c("state") == "FAILED") & c("failure_category").isNotNull())
         | (c("state").isin("PENDING", "RUNNING", "SUCCEEDED", "BLOCKED")
            & c("failure_category").isNull() & c("failure_code").isNull())),
        ("ck_pipeline_executions_failure_code_category", lambda: c("failure_code").isNull()
         | c("failure_category").isNotNull()),
    ),
    "pipeline_stage_executions": (
        ("ck_pipeline_stage_executions_stage_sequence", lambda:
         ((c("stage") == "INGESTION") & (c("stage_sequence") == 1))
         | ((c("stage") == "TRANSFORMATION") & (c("stage_sequence") == 2))
         | ((c("stage") == "DATA_QUALITY") & (c("stage_sequence") == 3))),
        ("ck_pipeline_stage_executions_state", lambda: c("state").isin(*STAGE_STATES)),
        ("ck_pipeline_stage_executions_shape", _stage_shape),
        ("ck_pipeline_stage_executions_failure_code_category", lambda: c("failure_code").isNull()
         | c("failure_category").isNotNull()),
        ("ck_pipeline_stage_executions_timestamp_order", lambda: c("started_at").isNull()
         | c("completed_at").isNull() | (c("completed_at") >= c("started_at"))),
    ),
}


def failed_checks(rules: Sequence[tuple[str, Callable[[], Column]]]) -> Column:
    """Array of the names of the rules a row breaks (null result passes)."""
    return F.array_compact(F.array(*[
        F.when(~F.coalesce(cond(), F.lit(True)), F.lit(name)) for name, cond in rules]))


def check_rows(df: DataFrame, rules: Sequence[tuple[str, Callable[[], Column]]],
               key: Sequence[str]) -> DataFrame:
    """P25: one row per (row key, broken rule)."""
    return (df.select(*key, failed_checks(rules).alias("_failed"))
            .where(F.size("_failed") > 0)
            .select(*key, F.explode("_failed").alias("constraint_name")))


def _domain_rules(spec: Sequence[ColumnSpec]) -> list[tuple[str, Callable[[], Column]]]:
    rules = []
    for col in spec:
        if not col.nullable:
            rules.append((f"nn_{col.name}", lambda n=col.name: c(n).isNotNull()))
        if col.type.startswith(("varchar(", "char(")):
            size = int(col.type.split("(")[1].rstrip(")"))
            rules.append((f"len_{col.name}", lambda n=col.name, s=size: F.length(c(n)) <= s))
        if col.type == "numeric":
            rules.append((f"num_{col.name}", lambda n=col.name: (
                (c(n) == F.round(c(n), 2)) & (F.abs(c(n)) < F.lit(10 ** 16)))))
        if col.type == "uuid":
            rules.append((f"uuid_{col.name}", lambda n=col.name: c(n).rlike(
                "\\A[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\\z")))
    return rules


def check_domains(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Column domain rules of one table."""
    return check_rows(df, _domain_rules(SCHEMAS[table]), key)


#: The rows of one key are dealt to so many tasks before they are counted.
SALTS = 32


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys`` and ``row_count``: the rows of every key.

    The keys, nothing else, are dealt by value and a salt and counted where they arrive, so a task
    holds the keys of its own part and not all that its share of the input has; the salt
    deals a hot key to many tasks, whose counts are summed."""
    dealt = df.select(*keys, (F.monotonically_increasing_id() % SALTS).alias("_salt")).repartition(*keys, "_salt")
    parts = dealt.groupBy(*keys, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    return parts.groupBy(*keys).agg(F.sum("_n").alias("row_count"))


def check_unique_keys(df: DataFrame, keys: Sequence[str], name: str,
                      primary: bool = False) -> DataFrame:
    """Key values held by more than one row (one output row per value),
    plus a row for null primary keys (see :func:`key_counts`)."""
    broken = F.col("row_count") > 1
    if primary:
        for k in keys:
            broken = broken | c(k).isNull()
    dup = key_counts(df, keys).where(broken)
    return dup.select(F.lit(name).alias("constraint_name"),
                      F.concat_ws("|", *[c(k).cast("string") for k in keys]).alias("key_value"),
                      "row_count")


def check_foreign_keys(child: DataFrame, parent: DataFrame, child_cols: Sequence[str],
                       parent_cols: Sequence[str], name: str) -> DataFrame:
    """Distinct non-null child keys with no parent row.  A null child key
    is allowed (nullable references).  Child keys are counted before the join (see
    :func:`key_counts`), so a hot key meets the parents as one row."""
    not_null = None
    for k in child_cols:
        not_null = c(k).isNotNull() if not_null is None else not_null & c(k).isNotNull()
    keys = key_counts(child.where(not_null), child_cols)
    pk = parent.select(*[c(p).alias(f"_p{i}") for i, p in enumerate(parent_cols)])
    cond = None
    for i, k in enumerate(child_cols):
        e = c(k) == c(f"_p{i}")
        cond = e if cond is None else cond & e
    missing = keys.join(pk, cond, "left_anti")
    return missing.select(F.lit(name).alias("constraint_name"),
                          F.concat_ws("|", *[c(k).cast("string") for k in child_cols]).alias("key_value"),
                          "row_count")
