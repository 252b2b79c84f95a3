"""Governed raw rows derived from the warehouse tables.

The given tables hold no governed CSV files, so each sales line and product
becomes one raw text row, exactly as a source file would deliver it: every
value is a string, some are padded, malformed or blank on purpose.  The rules
below are deterministic functions of the row's own keys (no randomness, no
sampling), so the same rows can be rebuilt in plain SQL for verification.

File layout of the derived rows (one "file" per supplier and channel, one per
100 products) keeps every file bounded in size as the data grows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sluice.operators.contracts import (
    ECOMMERCE_SALES_V1,
    PRODUCT_CATALOG_V1,
    RETAIL_SALES_V1,
    Contract,
)
from sluice.sources.files import source_identity

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Row-variant rule (a residue of the row keys) and the row numbering
# stride (more lines than one order can have in one file).
VARIANT_MODULUS = 10007
PRODUCT_VARIANT_MODULUS = 1009
PRODUCTS_PER_FILE = 100
LINES_PER_ORDER_STRIDE = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money_text(c: Column) -> Column:
    return c.cast("decimal(18,2)").cast("string")


def _with_identity(df: DataFrame, contract: Contract, file_label: Column) -> DataFrame:
    path = F.concat(F.lit(contract.directory + "/"), file_label, F.lit(".csv"))
    # Derived rows have no file bytes; the hash of the path stands in for the
    # content hash so that the identity payload keeps its governed shape.
    content = F.sha2(path, 256)
    return df.select(
        F.lit(contract.contract_id).alias("contract_id"),
        F.lit(contract.version).alias("contract_version"),
        path.alias("source_identifier"),
        content.alias("content_sha256"),
        source_identity(F.lit(contract.contract_id), F.lit(contract.version),
                        path, content).alias("source_id"),
        "*",
    )


def _sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order (sort-merge on l_orderkey at scale) plus
    the row variant and the file-local row number."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate")
    od = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    variant = (F.col("l_orderkey") * 7919 + F.col("l_partkey") * 104729
               + F.col("l_suppkey") * 31 + F.col("l_linenumber")) % VARIANT_MODULUS
    retail = F.col("l_returnflag") == "R"
    # Row number inside one file: order key stride plus the rank of the line
    # among the same order's lines in that file.  The window's groups are one
    # order in one file (a handful of rows) and are co-partitioned with the
    # join on l_orderkey, so no extra shuffle is planned. The order is total: lines
    # that tie are equal in every column.
    w = Window.partitionBy("l_orderkey", "l_suppkey", "is_retail").orderBy(
        "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    return (
        j.withColumn("v", variant)
        .withColumn("is_retail", retail)
        .withColumn("row_number",
                    (F.lit(2) + F.col("l_orderkey") * LINES_PER_ORDER_STRIDE
                     + F.row_number().over(w) - 1).cast("long"))
    )


def _quantity_text(v: Column) -> Column:
    q = F.col("l_quantity").cast("long").cast("string")
    return (
        F.when(v < 3, F.concat(q, F.lit(".5")))
        .when(v == 3, F.lit("0"))
        .when((v >= 10) & (v < 20), F.concat(q, F.lit(".0")))
        .otherwise(q)
    )


def _common_sales_text(v: Column, txn_prefix: str, ts: Column, offset_key: Column):
    key = F.col("l_orderkey").cast("string")
    txn = (
        F.when(v == 8, F.lit(""))
        .when((v >= 20) & (v < 30), F.concat(F.lit(" " + txn_prefix), key, F.lit(" ")))
        .otherwise(F.concat(F.lit(txn_prefix), key))
    )
    base_ts = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    offset = (F.when(offset_key % 3 == 0, F.lit("Z"))
              .when(offset_key % 3 == 1, F.lit("+02:00")).otherwise(F.lit("-05:00")))
    ts_text = F.when(v == 5, base_ts).otherwise(F.concat(base_ts, offset))
    part = F.col("l_partkey").cast("string")
    sku = (
        F.when(v == 7, F.lit("   "))
        .when((v >= 30) & (v < 40), F.concat(F.lit("  SKU-"), part))
        .otherwise(F.concat(F.lit("SKU-"), part))
    )
    price = F.when(v == 4, F.lit("n/a")).otherwise(_money_text(F.col("l_extendedprice")))
    currency = (
        F.when(v == 6, F.lit("eur"))
        .when((F.col("l_linenumber") % 2 == 0) & (F.col("l_orderkey") % 5 == 1), F.lit("USD"))
        .otherwise(F.lit("EUR"))
    )
    return txn, ts_text, sku, _quantity_text(v), price, currency


def ecommerce_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw e-commerce sales rows (lines whose return flag is not ``R``)."""
    lines = _sales_lines(spark, sf_dir).where(~F.col("is_retail"))
    v = F.col("v")
    txn, ts_text, sku, qty, price, cur = _common_sales_text(
        v, "WEB-", F.col("o_orderdate"), F.col("o_orderkey"))
    email = F.when(F.col("o_custkey") % 4 == 0, F.lit("")).otherwise(
        F.concat(F.lit("customer"), F.col("o_custkey").cast("string"), F.lit("@example.com")))
    rows = lines.select(
        "l_suppkey", "row_number",
        txn.alias("order_number"), ts_text.alias("order_timestamp"),
        email.alias("customer_email"), sku.alias("sku"), qty.alias("quantity"),
        price.alias("unit_price"), cur.alias("currency_code"))
    label = F.concat(F.lit("supplier-"), F.col("l_suppkey").cast("string"))
    return _with_identity(rows, ECOMMERCE_SALES_V1, label).drop("l_suppkey")


def retail_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw retail sales rows (lines whose return flag is ``R``)."""
    lines = _sales_lines(spark, sf_dir).where(F.col("is_retail"))
    v = F.col("v")
    txn, ts_text, sku, qty, price, cur = _common_sales_text(
        v, "POS-", F.col("l_shipdate"), F.col("l_linenumber"))
    store = F.when(v == 9, F.lit(" ")).otherwise(
        F.concat(F.lit("STORE-"), F.col("l_suppkey").cast("string")))
    till = F.concat(F.lit("TILL-"), F.col("l_linenumber").cast("string"))
    terminal = F.when((v >= 40) & (v < 50), F.concat(till, F.lit(" "))).otherwise(till)
    rows = lines.select(
        "l_suppkey", "row_number",
        txn.alias("receipt_number"), ts_text.alias("transaction_timestamp"),
        store.alias("store_code"), terminal.alias("terminal_id"), sku.alias("sku"),
        qty.alias("quantity"), price.alias("unit_price"), cur.alias("currency_code"))
    label = F.concat(F.lit("store-"), F.col("l_suppkey").cast("string"))
    return _with_identity(rows, RETAIL_SALES_V1, label).drop("l_suppkey")


def products_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw product-catalog rows, one file per 100 consecutive part keys."""
    p = read_table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_type", "p_size", "p_retailprice")
    w = (F.col("p_partkey") * 37 + F.col("p_size")) % PRODUCT_VARIANT_MODULUS
    key = F.col("p_partkey")
    sku = (
        F.when(w < 2, F.concat(F.lit("SKU-"), (key - 1).cast("string")))
        .when(w == 2, F.lit(" "))
        .otherwise(F.concat(F.lit("SKU-"), key.cast("string")))
    )
    name = F.when(w == 3, F.lit("")).otherwise(F.col("p_name"))
    list_price = (
        F.when(w == 4, F.lit("-1.00"))
        .when(w.isin(5, 6), F.lit(""))
        .otherwise(_money_text(F.col("p_retailprice")))
    )
    unit_cost = F.when(w.isin(5, 6) | (F.col("p_size") % 3 == 0), F.lit("")).otherwise(
        F.concat(F.col("p_size").cast("string"), F.lit(".50")))
    currency = F.when(w == 6, F.lit("")).otherwise(F.lit("EUR"))
    rows = p.select(
        (F.floor(key / PRODUCTS_PER_FILE)).cast("long").alias("_file"),
        (F.lit(2) + key % PRODUCTS_PER_FILE).cast("long").alias("row_number"),
        sku.alias("sku"), name.alias("product_name"), F.col("p_type").alias("category_code"),
        list_price.alias("list_price"), unit_cost.alias("unit_cost"),
        currency.alias("currency_code"))
    label = F.concat(F.lit("catalog-"), F.col("_file").cast("string"))
    return _with_identity(rows, PRODUCT_CATALOG_V1, label).drop("_file")


def raw_for(spark: SparkSession, sf_dir: str, contract: Contract) -> DataFrame:
    if contract is ECOMMERCE_SALES_V1:
        return ecommerce_raw(spark, sf_dir)
    if contract is RETAIL_SALES_V1:
        return retail_raw(spark, sf_dir)
    if contract is PRODUCT_CATALOG_V1:
        return products_raw(spark, sf_dir)
    raise ValueError(f"no derived rows for {contract.key}")


# How the ``events`` table reads as an execution log.
EVENT_STATES = (("signup", "PENDING"), ("view", "RUNNING"), ("click", "RUNNING"),
                ("error", "FAILED"))
BLOCKED_VALUE_THRESHOLD = 40.0


def execution_uuid(user: Column) -> Column:
    """A UUID-shaped execution id for an events ``user_id``."""
    return F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(user.cast("string"), 12, "0"))


def execution_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a pipeline-execution event log: one execution
    per user; event types map to target states (purchases end SUCCEEDED, or
    BLOCKED when their value is at least the threshold)."""
    ev = read_table(spark, sf_dir, "events")
    target = None
    for etype, state in EVENT_STATES:
        cond = F.col("event_type") == etype
        target = F.when(cond, F.lit(state)) if target is None else target.when(cond, F.lit(state))
    target = target.when((F.col("event_type") == "purchase")
                         & (F.col("value") >= BLOCKED_VALUE_THRESHOLD), F.lit("BLOCKED")) \
                   .when(F.col("event_type") == "purchase", F.lit("SUCCEEDED"))
    failed = target == "FAILED"
    return ev.select(
        execution_uuid(F.col("user_id")).alias("pipeline_execution_id"),
        F.col("event_id"), F.col("ts").cast("timestamp").alias("event_time"),
        target.alias("target_state"),
        F.when(failed, F.lit("UNEXPECTED_EXECUTION_FAILURE")).alias("failure_category"),
        F.when(failed, F.lit("UNEXPECTED_EXECUTION_ERROR")).alias("failure_code"),
        F.when(F.col("user_id") % 17 == 0, execution_uuid(F.col("user_id")))
        .when(F.col("user_id") % 19 == 0, execution_uuid(F.col("user_id") + 10**9))
        .when(F.col("user_id") % 5 != 0, execution_uuid(F.col("user_id") - 1))
        .alias("predecessor_execution_id"))


# How the ``events`` table reads as a stage log.
STAGE_EVENT_STATES = (("signup", "PENDING"), ("view", "RUNNING"), ("click", "SKIPPED"),
                      ("purchase", "SUCCEEDED"), ("error", "FAILED"))
STAGES = ("INGESTION", "TRANSFORMATION", "DATA_QUALITY")


def stage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a stage event log: one execution per user, the stage by
    the event's number modulo three, the target state by its type."""
    ev = read_table(spark, sf_dir, "events")
    target = F.create_map(*[F.lit(x) for pair in STAGE_EVENT_STATES for x in pair])[F.col("event_type")]
    failed = target == "FAILED"
    return ev.select(
        execution_uuid(F.col("user_id")).alias("pipeline_execution_id"),
        F.get(F.array(*[F.lit(x) for x in STAGES]), (F.col("event_id") % 3).cast("int")).alias("stage"),
        "event_id", F.col("ts").cast("timestamp").alias("event_time"), target.alias("target_state"),
        F.when(failed, F.lit("INGESTION_FAILURE")).alias("failure_category"),
        F.when(failed, F.lit("INGESTION_ERROR")).alias("failure_code"))
