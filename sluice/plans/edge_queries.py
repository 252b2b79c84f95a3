"""Registered queries of values and outcomes at the edge of what is allowed. The SQL is
written out by hand."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import parsing as P
from sluice.operators.canonical import canonicalize, union_sales_lines
from sluice.operators.contracts import ECOMMERCE_SALES_V1, PRODUCT_CATALOG_V1, RETAIL_SALES_V1
from sluice.operators.ordering import GROUP_ORDER, order_groups, order_records, with_position
from sluice.operators.validate import validate_rows
from sluice.plans import oracle as O
from sluice.plans.ingest import ingest_rows
from sluice.plans.more_queries import _DOCS_SQL, _documents
from sluice.plans.queries import register
from sluice.sources.csv import register_governed_csv
from sluice.sources.tables import raw_for, read_table

_KEYS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")

_WIDE_SQL = """WITH t AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(trunc(l_quantity) AS BIGINT) AS qty, kind,
   CASE kind WHEN 0 THEN price WHEN 1 THEN price || '00000001' WHEN 2 THEN '123456789012345678901' || lpad(CAST(l_orderkey AS VARCHAR), 9, '0')
     WHEN 3 THEN '-' || price || 'E+25' WHEN 4 THEN '1234567890123456789012345678' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') || '7'
     WHEN 5 THEN translate(price, '0123456789', '٠١٢٣٤٥٦٧٨٩') WHEN 6 THEN replace(price, '.', ',') WHEN 7 THEN '.' || l_orderkey || 'e-20'
     WHEN 8 THEN '000.000' ELSE price || 'E99999999999' END AS value
   FROM (SELECT *, (l_orderkey * 7 + l_linenumber * 3 + l_partkey) % 10 AS kind, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price FROM lineitem)),
 a AS (SELECT *, translate(value, '٠١٢٣٤٥٦٧٨٩', '0123456789') AS x FROM t),
 p AS (SELECT *, regexp_full_match(x, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?') AS ok,
   regexp_extract(x, '^[+-]?([0-9.]*)', 1) AS mantissa, CASE WHEN regexp_matches(x, '[eE]') THEN try_cast(regexp_extract(x, '[eE]([+-]?[0-9]+)$', 1) AS INTEGER) ELSE 0 END AS e FROM a),
 d AS (SELECT *, trim(replace(mantissa, '.', ''), '0') AS digits,
   length(regexp_extract(mantissa, '[.]([0-9]*)', 1)) - (length(replace(mantissa, '.', '')) - length(rtrim(replace(mantissa, '.', ''), '0'))) - e AS s FROM p),
 r AS (SELECT *, CASE WHEN NOT ok THEN 'invalid_decimal' WHEN length(digits) > 38 OR e IS NULL THEN 'decimal_out_of_range' END AS category FROM d),
 u AS (SELECT *, CASE WHEN category IS NULL THEN CASE WHEN digits = '' THEN 0::HUGEINT WHEN x LIKE '-%' THEN -CAST(digits AS HUGEINT) ELSE CAST(digits AS HUGEINT) END END AS n,
   CASE WHEN category IS NULL THEN CASE WHEN digits = '' THEN 0 ELSE s END END AS scale FROM r)
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, category, CAST(n AS VARCHAR) AS unscaled, CAST(scale AS INTEGER) AS scale,
   CAST(n * qty AS VARCHAR) AS amount_unscaled, CAST(sign(n) AS INTEGER) AS sign FROM u"""


@register("wide_decimals", _WIDE_SQL)
def _wide_q(spark, sf_dir):
    """Decimals of any width, from every line's price; those of over 38 digits fall out."""
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    key = F.col("l_orderkey").cast("string")
    kind = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3 + F.col("l_partkey")) % 10
    forms: list[Column] = [
        price, F.concat(price, F.lit("00000001")), F.concat(F.lit("123456789012345678901"), F.lpad(key, 9, "0")),
        F.concat(F.lit("-"), price, F.lit("E+25")),
        F.concat(F.lit("1234567890123456789012345678"), F.lpad(key, 10, "0"), F.lit("7")),
        F.translate(price, "0123456789", "٠١٢٣٤٥٦٧٨٩"), F.replace(price, F.lit("."), F.lit(",")),
        F.concat(F.lit("."), key, F.lit("e-20")), F.lit("000.000"), F.concat(price, F.lit("E99999999999"))]
    rows = read_table(spark, sf_dir, "lineitem").select(
        *_KEYS, F.col("l_quantity").cast("long").alias("qty"), F.get(F.array(*forms), kind.cast("int")).alias("value"))
    parts = P.decimal_parts("value")
    rows = rows.select(*_KEYS, "qty", *[v.alias("_" + k) for k, v in parts.items()])
    got = {k: F.col("_" + k) for k in parts}
    narrow, wide = P.decimal_values_from(got)
    category = P.decimal_error_from(got)
    rows = rows.select(*_KEYS, "qty", category.alias("category"), F.when(category.isNull(), P.as_wide(narrow, wide)).alias("w"))
    times = F.struct(F.col("qty").cast("decimal(38,0)").alias("unscaled"), F.lit(0).alias("scale"))
    zero = F.struct(F.lit(0).cast("decimal(38,0)").alias("unscaled"), F.lit(0).alias("scale"))
    text = lambda c: c.cast("string")
    return rows.select(*_KEYS, "category", text(F.col("w.unscaled")).alias("unscaled"), F.col("w.scale").alias("scale"),
                       text(P.wide_product(F.col("w"), times)["unscaled"]).alias("amount_unscaled"),
                       P.wide_compare(F.col("w"), zero).alias("sign"))


def _spoil(raw: DataFrame) -> DataFrame:
    """Retail rows some of whose values are valid text that no record or instant can hold."""
    n = F.col("row_number") % 97
    return raw.withColumns({
        "quantity": F.when(n == 2, F.lit("123456789012345678901234")).when(n == 3, F.lit("12345678901234567890123456789012345678")).otherwise(F.col("quantity")),
        "transaction_timestamp": F.when(n == 5, F.lit("9999-12-31T23:30:00-05:00")).when(n == 7, F.lit("0001-01-01T00:30:00+02:00"))
        .otherwise(F.col("transaction_timestamp")),
        "unit_price": F.when(n == 11, F.lit("1" * 39)).when(n == 13, F.lit("0.12345678901")).otherwise(F.col("unit_price"))})


_SPOILED = """spoiled AS (SELECT * REPLACE (
   CASE row_number % 97 WHEN 2 THEN '123456789012345678901234' WHEN 3 THEN '12345678901234567890123456789012345678' ELSE quantity END AS quantity,
   CASE row_number % 97 WHEN 5 THEN '9999-12-31T23:30:00-05:00' WHEN 7 THEN '0001-01-01T00:30:00+02:00' ELSE transaction_timestamp END AS transaction_timestamp,
   CASE row_number % 97 WHEN 11 THEN repeat('1', 39) WHEN 13 THEN '0.12345678901' ELSE unit_price END AS unit_price) FROM retail_raw)"""
_BLANK = f"(length({O.strip('receipt_number')}) = 0 OR length({O.strip('store_code')}) = 0 OR length({O.strip('sku')}) = 0)"


@register("rare_outcomes", f"""WITH {O.LINES}, {O.RETAIL_RAW}, {_SPOILED},
 c AS (SELECT source_identifier, row_number, CASE
     WHEN receipt_number = '' THEN 'non_nullable_empty'
     WHEN NOT regexp_full_match(transaction_timestamp, {O.q(O.TS_RE)}) THEN 'invalid_timestamp'
     WHEN try_cast(quantity AS DOUBLE) <= 0 THEN 'positive'
     WHEN NOT regexp_full_match(unit_price, {O.q(O.DEC_RE)}) THEN 'invalid_decimal'
     WHEN length(trim(replace(unit_price, '.', ''), '0')) > 38 THEN 'decimal_out_of_range'
     WHEN NOT regexp_full_match(currency_code, '[A-Z]{{3}}') THEN 'uppercase_currency_code' END AS category,
   regexp_full_match(quantity, '[0-9]+([.]0*)?') AS whole, length(quantity) > 19 AS too_long,
   transaction_timestamp LIKE '9999-12-31T23:30:00-05:00' OR transaction_timestamp LIKE '0001-01-01T00:30:00+02:00' AS beyond,
   length({O.strip('receipt_number')}) = 0 AS no_receipt, {_BLANK} AS blank, unit_price = '0.12345678901' AS wide_price, quantity FROM spoiled)
 SELECT source_identifier, row_number, category, CASE WHEN category IS NULL AND whole THEN
     CASE WHEN no_receipt THEN 'blank_identifier' WHEN beyond THEN 'utc_overflow' WHEN blank THEN 'blank_identifier' END END AS abort_kind,
   CASE WHEN category IS NOT NULL THEN NULL WHEN NOT whole THEN 'BUSINESS_RULE_REJECTED' WHEN no_receipt OR beyond OR blank THEN NULL
     WHEN too_long THEN 'UNTRANSFORMABLE' ELSE 'SUCCESS' END AS status,
   CASE WHEN category IS NULL AND whole AND NOT (no_receipt OR beyond OR blank OR too_long) AND wide_price
     THEN CAST(12345678901 * CAST(CAST(quantity AS DOUBLE) AS BIGINT) AS VARCHAR) END AS wide_amount FROM c""")
def _rare_q(spark, sf_dir):
    """Every row's failure, abort or outcome, with untransformable quantities,
    instants beyond the calendar and decimals out of range among them."""
    rows = validate_rows(_spoil(raw_for(spark, sf_dir, RETAIL_SALES_V1)), RETAIL_SALES_V1)
    # every row is mapped in the one pass that validates it; what comes of a failed one is not looked at
    outcomes = canonicalize(rows.withColumn("failure_key", F.col("first_error.category")), RETAIL_SALES_V1, "run-1")
    good = lambda c, name: F.when(F.col("failure_key").isNull(), c).alias(name)
    return outcomes.select(
        "source_identifier", "row_number", F.col("failure_key").alias("category"),
        good(F.col("abort_kind"), "abort_kind"), good(F.col("status"), "status"),
        good(F.col("line_amount_wide.unscaled").cast("string"), "wide_amount"))


@register("order_records", O.full_chain(PRODUCT_CATALOG_V1) + """
 SELECT source_identifier, row_number, row_number() OVER (ORDER BY source_id, row_number) AS position FROM records""")
def _order_records_q(spark, sf_dir):
    """O2: canonical products by file and row, each with its place in the whole."""
    ing = ingest_rows(raw_for(spark, sf_dir, PRODUCT_CATALOG_V1), PRODUCT_CATALOG_V1, "run-1")
    return with_position(order_records(ing.records)).select("source_identifier", "row_number", "position")


_LINES_SQL = (O.full_chain(RETAIL_SALES_V1), O.full_chain(ECOMMERCE_SALES_V1))


@register("order_groups", f"""SELECT sales_channel_code, source_transaction_number, source_identifier, row_number,
   row_number() OVER (ORDER BY sales_channel_code, source_transaction_number, source_id, row_number) AS position
 FROM (SELECT * FROM ({_LINES_SQL[0]} SELECT sales_channel_code, source_transaction_number, source_id, source_identifier, row_number FROM records)
   UNION ALL SELECT * FROM ({_LINES_SQL[1]} SELECT sales_channel_code, source_transaction_number, source_id, source_identifier, row_number FROM records))""")
def _order_groups_q(spark, sf_dir):
    """O3: the sales lines of both channels by transaction, each with its place in the whole."""
    lines = union_sales_lines(*[ingest_rows(raw_for(spark, sf_dir, c), c, "run-1").records
                                for c in (RETAIL_SALES_V1, ECOMMERCE_SALES_V1)])
    lines = lines.select(*GROUP_ORDER, "source_identifier")  # what is ordered is stored
    return with_position(order_groups(lines)).select(
        "sales_channel_code", "source_transaction_number", "source_identifier", "row_number", "position")


@register("governed_csv_function", f"""WITH {_DOCS_SQL}
 SELECT k AS order_key, CAST(2 * r AS BIGINT) AS row_number, CAST(p AS VARCHAR) AS part,
   'line ' || n || ', "x"' || chr(10) || 'next' AS note, price
 FROM lines WHERE k % 50 NOT BETWEEN 7 AND 12""")
def _csv_function_q(spark, sf_dir):
    """The same documents as in `read_governed_csv`, cut in two blocks, by the table function in SQL."""
    data = F.encode("csv_text", "UTF-8")
    half = (F.octet_length(data) / 2).cast("int")
    docs = _documents(spark, sf_dir).select(F.col("source_id").alias("path"), data.alias("data"), half.alias("half"))
    parts = F.array(F.struct(F.lit(0).alias("block"), F.expr("substring(data, 1, half)").alias("content")),
                    F.struct(F.lit(1).alias("block"), F.expr("substring(data, half + 1)").alias("content")))
    docs.select("path", F.inline(parts)).createOrReplaceTempView("sluice_csv_blocks")
    register_governed_csv(spark)
    return spark.sql("""WITH t AS (
          SELECT * FROM governed_csv(TABLE(sluice_csv_blocks) PARTITION BY path ORDER BY block))
        SELECT CAST(path AS BIGINT) AS order_key, row_number, vals[0] AS part, vals[1] AS note, vals[2] AS price
        FROM t LEFT SEMI JOIN (SELECT path AS sound FROM t WHERE kind = 'file' AND failure_category IS NULL) ON path = sound
        WHERE kind = 'row'""")
