"""The relational business tables (S14) derived from the warehouse tables.

Each table keeps the column names and types of the governed relational
schema; values come from the given tables by fixed rules, including some
rows that break a constraint, so the checks have something to find."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.sources.tables import read_table

# The approved sales channels (code, name).
APPROVED_CHANNELS = (("ECOMMERCE", "E-Commerce"), ("RETAIL", "Retail"))


def _d2(c):
    return c.cast("decimal(18,2)")


def _swap(key, divisor: int, rest: int, value, other):
    """``value`` for the rows whose key leaves ``rest`` modulo ``divisor``, else ``other``:
    the rows that break a rule on purpose, by value and never by leaving rows out."""
    return F.when(key % divisor == rest, value).otherwise(other)


def sales_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approved channels and one odd one for each region."""
    rows = [(i, code, name) for i, (code, name) in enumerate(APPROVED_CHANNELS, start=1)]
    approved = spark.createDataFrame(
        rows, "sales_channel_id long, sales_channel_code string, sales_channel_name string")
    r = read_table(spark, sf_dir, "region")
    k = F.col("r_regionkey")
    code = (F.when(k == 1, F.rpad(F.col("r_name"), 40, "X")).when(k == 2, F.lit("RETAIL"))
            .when(k == 3, F.lit(" ")).otherwise(F.col("r_name")))
    odd = r.select((k + 2).cast("long").alias("sales_channel_id"), code.alias("sales_channel_code"),
                   F.when(k == 4, F.lit("")).otherwise(F.col("r_name")).alias("sales_channel_name"))
    return approved.unionByName(odd)


def stores(spark, sf_dir) -> DataFrame:
    s = read_table(spark, sf_dir, "supplier")
    n, k = F.col("s_nationkey"), F.col("s_suppkey")
    country = F.when(n % 10 == 9, F.lit("Z9")).otherwise(
        F.concat(F.expr("chr(65 + s_nationkey % 26)"), F.expr("chr(65 + (s_nationkey * 7) % 26)")))
    label = lambda x: F.concat(F.lit("STORE-"), x.cast("string"))
    return s.select(_swap(k, 41, 8, k - 1, k).alias("store_id"),
                    _swap(k, 47, 5, F.lit("  "), _swap(k, 37, 7, label(k - 1), label(k))).alias("store_code"),
                    _swap(k, 43, 6, F.lit(""), F.col("s_name")).alias("store_name"),
                    _swap(k, 31, 9, F.lit("USA"), country).alias("country_code"))


def customers(spark, sf_dir) -> DataFrame:
    k = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(_swap(k, 53, 3, k - 1, k).alias("customer_id"))


def product_categories(spark, sf_dir) -> DataFrame:
    sizes = read_table(spark, sf_dir, "part").select("p_size").distinct()
    k = F.col("p_size")
    text = k.cast("string")
    return sizes.select(
        _swap(k, 100, 31, k - 1, k).cast("long").alias("product_category_id"),
        _swap(k, 100, 13, F.lit(" "), _swap(k, 100, 21, F.lit("SIZE-20"), F.concat(F.lit("SIZE-"), text)))
        .alias("category_code"),
        _swap(k, 100, 17, F.lit(""), F.concat(F.lit("Size "), text)).alias("category_name"))


def products(spark, sf_dir) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    k, size = F.col("p_partkey"), F.col("p_size")
    price = F.col("p_retailprice").cast("decimal(28,4)")
    label = lambda x: F.concat(F.lit("SKU-"), x.cast("string"))
    cost = F.when(size % 4 == 0, F.lit(None)).otherwise(size.cast("decimal(28,4)"))
    return p.select(
        _swap(k, 373, 8, k - 1, k).alias("product_id"),
        _swap(k, 401, 3, F.lit(" "), _swap(k, 397, 4, label(k - 1), _swap(
            k, 359, 10, F.rpad(label(k), 120, "0"), label(k)))).alias("sku"),
        _swap(k, 389, 5, F.lit(" "), _swap(k, 349, 12, F.lit(None), F.col("p_name"))).alias("product_name"),
        _swap(k, 367, 9, size + 1000, size).cast("long").alias("product_category_id"),
        _swap(k, 500, 7, -price, _swap(k, 353, 11, price + F.lit("0.0001").cast("decimal(28,4)"), price))
        .cast("decimal(28,4)").alias("list_price"),
        _swap(k, 383, 6, F.lit("-1.5").cast("decimal(28,4)"), cost).cast("decimal(28,4)").alias("unit_cost"),
        F.when(k % 300 == 11, F.lit(None)).when(k % 379 == 7, F.lit("eu")).otherwise(F.lit("EUR"))
        .alias("currency_code"))


def orders(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    amount = _d2(F.col("o_totalprice"))
    return o.select(
        _swap(k, 727, 4, k - 1, k).alias("order_id"),
        F.when(k % 709 == 2, F.lit(99)).when(k % 2 == 0, F.lit(1)).otherwise(F.lit(2)).cast("long")
        .alias("sales_channel_id"),
        F.when(k % 2 == 1, F.col("o_custkey") % 120).alias("store_id"),
        _swap(k, 719, 3, F.col("o_custkey") + 10**9, F.col("o_custkey")).alias("customer_id"),
        _swap(k, 733, 5, F.lit(None), F.col("o_orderdate").cast("timestamp")).alias("order_timestamp"),
        _swap(k, 1000, 5, F.lit("eur"), F.lit("EUR")).alias("currency_code"),
        _swap(k, 701, 1, -amount, amount).cast("decimal(18,2)").alias("order_amount"))


def _item_id():
    return (F.col("l_orderkey") * 100000 + F.col("l_linenumber") * 10000
            + F.col("l_partkey") % 10000)


def _line_variant():
    return F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_partkey")


def order_items(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    v = _line_variant()
    qty = F.col("l_quantity").cast("int")
    price = _d2(F.col("l_extendedprice"))
    discount = _d2(F.col("l_discount") * 100)
    amount = (price * qty.cast("decimal(10,0)")).cast("decimal(18,2)")
    return li.select(
        _item_id().alias("order_item_id"),
        _swap(v, 997, 6, F.col("l_orderkey") + 10**12, F.col("l_orderkey")).alias("order_id"),
        _swap(v, 997, 1, F.lit(0), F.col("l_linenumber")).cast("int").alias("line_number"),
        _swap(v, 997, 7, F.col("l_partkey") + 10**9, F.col("l_partkey")).alias("product_id"),
        _swap(v, 997, 2, -qty, qty).alias("quantity"),
        _swap(v, 997, 3, -price, price).cast("decimal(18,2)").alias("unit_price"),
        _swap(v, 997, 4, F.lit("-0.01").cast("decimal(18,2)"), discount).cast("decimal(18,2)")
        .alias("discount_amount"),
        _swap(v, 997, 5, -amount, amount).cast("decimal(18,2)").alias("line_amount"))


def payments(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    amount = _d2(F.col("o_totalprice"))
    return o.select(
        _swap(k, 757, 3, k - 1, k).alias("payment_id"),
        _swap(k, 751, 2, k + 10**12, k).alias("order_id"),
        F.col("o_orderdate").cast("timestamp").alias("payment_timestamp"),
        F.when(F.col("o_orderstatus") == "P", F.lit(" ")).otherwise(F.col("o_orderstatus"))
        .alias("payment_status"),
        _swap(k, 743, 1, -amount, amount).cast("decimal(18,2)").alias("payment_amount"))


def returns(spark, sf_dir) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    v = _line_variant()
    qty = F.col("l_quantity").cast("int")
    amount = _d2(F.col("l_extendedprice"))
    reason = (F.when(F.col("l_linenumber") % 3 == 0, F.lit(None))
              .when(F.col("l_linenumber") % 3 == 1, F.lit("damaged")).otherwise(F.lit(" ")))
    return li.select(
        _item_id().alias("return_id"),
        _swap(v, 199, 10, _item_id() + 10**15, _item_id()).alias("order_item_id"),
        F.col("l_shipdate").cast("timestamp").alias("return_timestamp"),
        _swap(v, 199, 8, -qty, qty).alias("return_quantity"),
        _swap(v, 199, 9, -amount, amount).cast("decimal(18,2)").alias("return_amount"),
        reason.cast("string").alias("return_reason"))


def business_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "sales_channels": sales_channels(spark, sf_dir), "stores": stores(spark, sf_dir),
        "customers": customers(spark, sf_dir),
        "product_categories": product_categories(spark, sf_dir),
        "products": products(spark, sf_dir), "orders": orders(spark, sf_dir),
        "order_items": order_items(spark, sf_dir), "payments": payments(spark, sf_dir),
        "returns": returns(spark, sf_dir),
    }


def approved_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approved store reference rows: one per supplier."""
    return read_table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("STORE-"), F.col("s_suppkey").cast("string")).alias("store_code"),
        F.col("s_name").alias("store_name"))


def registered_stores(spark: SparkSession, sf_dir: str, renamed: bool = True) -> DataFrame:
    """Stores that a legacy table already holds: every store with retail lines; those whose
    key ends in 3 under a code of their own. ``renamed``: those whose key ends in 7 carry
    another name."""
    li = read_table(spark, sf_dir, "lineitem").where(F.col("l_returnflag") == "R")
    k = F.col("l_suppkey")
    name = F.concat(F.lit("Supplier#"), F.lpad(k.cast("string"), 9, "0"))
    if renamed:
        name = F.when(k % 10 == 7, F.concat(F.lit("Store "), k.cast("string"))).otherwise(name)
    prefix = F.when(k % 10 == 3, F.lit("KIOSK-")).otherwise(F.lit("STORE-"))
    return li.select(F.concat(prefix, k.cast("string")).alias("store_code"), name.alias("store_name")).distinct()
