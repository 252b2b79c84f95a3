"""Independent DuckDB SQL for the verification of the registered queries.

This module only builds SQL text; it is used by ``__spark_entry__.oracle_sql``
and by the tests.  It re-derives the raw rows from the same tables and applies
the governed rules in plain SQL (RE2 regexes, ``try_cast``), so the Spark
operators and the SQL are two independent implementations of one spec."""

from __future__ import annotations

from sluice.operators.contracts import (
    DECIMAL,
    ECOMMERCE_SALES_V1,
    NON_NEGATIVE,
    POSITIVE,
    PRODUCT_CATALOG_V1,
    RETAIL_SALES_V1,
    STRING,
    TIMESTAMP,
    TIMEZONE_AWARE,
    UPPERCASE_CURRENCY_CODE,
    Contract,
)

DEC_RE = r"[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
TS_RE = (r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?"
         r"(?:Z|[+-][0-9]{2}:[0-9]{2})")
STRIP = (r"[\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
         r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q('^' + STRIP + '+|' + STRIP + '+$')}, '', 'g')"


def money_text(x: str) -> str:
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS VARCHAR)"


def ts_text(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%f')"


def identity(cid: str, version: int, path: str) -> str:
    content = f"sha256({path})"
    payload = (f"'{{\"content_sha256\":\"' || {content} || '\",\"contract_id\":\"{cid}\","
               f"\"contract_version\":{version},\"source_path\":\"' || {path} || '\"}}'")
    return f"sha256({payload})"


LINES = """
lines AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
         l.l_extendedprice, l.l_shipdate, o.o_orderkey, o.o_custkey, o.o_orderdate,
         (l.l_orderkey * 7919 + l.l_partkey * 104729 + l.l_suppkey * 31 + l.l_linenumber) % 10007 AS v,
         l.l_returnflag = 'R' AS is_retail,
         CAST(2 + l.l_orderkey * 1048576 + row_number() OVER (
             PARTITION BY l.l_orderkey, l.l_suppkey, l.l_returnflag = 'R'
             ORDER BY l.l_linenumber, l.l_partkey, l.l_quantity, l.l_extendedprice, l.l_returnflag, l.l_shipdate) - 1
             AS BIGINT) AS row_number
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""


def _sales_common(prefix: str, ts: str, offset_key: str) -> str:
    key = "CAST(l_orderkey AS VARCHAR)"
    qty = "CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR)"
    base = f"strftime({ts}, '%Y-%m-%dT%H:%M:%S')"
    off = (f"CASE WHEN {offset_key} % 3 = 0 THEN 'Z' WHEN {offset_key} % 3 = 1 "
           f"THEN '+02:00' ELSE '-05:00' END")
    return f"""
    CASE WHEN v = 8 THEN '' WHEN v >= 20 AND v < 30 THEN ' {prefix}' || {key} || ' '
         ELSE '{prefix}' || {key} END AS txn_text,
    CASE WHEN v = 5 THEN {base} ELSE {base} || {off} END AS ts_text,
    CASE WHEN v = 7 THEN '   ' WHEN v >= 30 AND v < 40 THEN '  SKU-' || CAST(l_partkey AS VARCHAR)
         ELSE 'SKU-' || CAST(l_partkey AS VARCHAR) END AS sku,
    CASE WHEN v < 3 THEN {qty} || '.5' WHEN v = 3 THEN '0'
         WHEN v >= 10 AND v < 20 THEN {qty} || '.0' ELSE {qty} END AS quantity,
    CASE WHEN v = 4 THEN 'n/a' ELSE {money_text('l_extendedprice')} END AS unit_price,
    CASE WHEN v = 6 THEN 'eur' WHEN l_linenumber % 2 = 0 AND l_orderkey % 5 = 1 THEN 'USD'
         ELSE 'EUR' END AS currency_code"""


def _with_identity(contract: Contract, label: str, inner: str) -> str:
    path = f"'{contract.directory}/' || {label} || '.csv'"
    return f"""
  SELECT '{contract.contract_id}' AS contract_id, {contract.version} AS contract_version,
         {path} AS source_identifier, sha256({path}) AS content_sha256,
         {identity(contract.contract_id, contract.version, path)} AS source_id, d.*
  FROM ({inner}) d"""


ECOMMERCE_RAW = "ecommerce_raw AS (" + _with_identity(
    ECOMMERCE_SALES_V1, "'supplier-' || CAST(l_suppkey AS VARCHAR)", f"""
    SELECT l_suppkey, row_number, txn_text AS order_number, ts_text AS order_timestamp,
           CASE WHEN o_custkey % 4 = 0 THEN '' ELSE 'customer' || CAST(o_custkey AS VARCHAR)
                || '@example.com' END AS customer_email,
           sku, quantity, unit_price, currency_code
    FROM (SELECT *, {_sales_common('WEB-', 'o_orderdate', 'o_orderkey')} FROM lines
          WHERE NOT is_retail)""") + ")"

RETAIL_RAW = "retail_raw AS (" + _with_identity(
    RETAIL_SALES_V1, "'store-' || CAST(l_suppkey AS VARCHAR)", f"""
    SELECT l_suppkey, row_number, txn_text AS receipt_number, ts_text AS transaction_timestamp,
           CASE WHEN v = 9 THEN ' ' ELSE 'STORE-' || CAST(l_suppkey AS VARCHAR) END AS store_code,
           CASE WHEN v >= 40 AND v < 50 THEN 'TILL-' || CAST(l_linenumber AS VARCHAR) || ' '
                ELSE 'TILL-' || CAST(l_linenumber AS VARCHAR) END AS terminal_id,
           sku, quantity, unit_price, currency_code
    FROM (SELECT *, {_sales_common('POS-', 'l_shipdate', 'l_linenumber')} FROM lines
          WHERE is_retail)""") + ")"

PRODUCTS_RAW = "products_raw AS (" + _with_identity(
    PRODUCT_CATALOG_V1, "'catalog-' || CAST(_file AS VARCHAR)", f"""
    SELECT p_partkey // 100 AS _file, CAST(2 + p_partkey % 100 AS BIGINT) AS row_number,
           CASE WHEN w < 2 THEN 'SKU-' || CAST(p_partkey - 1 AS VARCHAR) WHEN w = 2 THEN ' '
                ELSE 'SKU-' || CAST(p_partkey AS VARCHAR) END AS sku,
           CASE WHEN w = 3 THEN '' ELSE p_name END AS product_name,
           p_type AS category_code,
           CASE WHEN w = 4 THEN '-1.00' WHEN w IN (5, 6) THEN ''
                ELSE {money_text('p_retailprice')} END AS list_price,
           CASE WHEN w IN (5, 6) OR p_size % 3 = 0 THEN ''
                ELSE CAST(p_size AS VARCHAR) || '.50' END AS unit_cost,
           CASE WHEN w = 6 THEN '' ELSE 'EUR' END AS currency_code
    FROM (SELECT *, (p_partkey * 37 + p_size) % 1009 AS w FROM part)""") + ")"

RAW_CTES = {ECOMMERCE_SALES_V1.key: ("ecommerce_raw", [LINES, ECOMMERCE_RAW]),
            RETAIL_SALES_V1.key: ("retail_raw", [LINES, RETAIL_RAW]),
            PRODUCT_CATALOG_V1.key: ("products_raw", [PRODUCTS_RAW])}


# ------------------------------------------------------------- validation
def _dec_err(x: str) -> str:
    mantissa = f"regexp_extract({x}, '^[+-]?([0-9.]*)', 1)"
    digits = f"length(trim(replace({mantissa}, '.', ''), '0'))"
    exp_txt = f"regexp_extract({x}, '[eE]([+-]?[0-9]+)$', 1)"
    fits = f"({digits} <= 38 AND ({exp_txt} = '' OR try_cast({exp_txt} AS INTEGER) IS NOT NULL))"
    return (f"CASE WHEN NOT regexp_full_match({x}, {q(DEC_RE)}) THEN 'invalid_decimal' "
            f"WHEN NOT coalesce({fits}, false) THEN 'decimal_out_of_range' END")


def _ts_parts(x: str) -> tuple[str, str]:
    rest = f"substr({x}, 20)"
    frac = f"regexp_extract({rest}, '^\\.([0-9]+)', 1)"
    zone = f"regexp_extract({rest}, '(Z|[+-][0-9]{{2}}:[0-9]{{2}})$', 1)"
    offset = (f"(CASE WHEN {zone} = 'Z' THEN 0 ELSE (CASE WHEN substr({zone},1,1) = '-' THEN -1 ELSE 1 END)"
              f" * (try_cast(substr({zone},2,2) AS INTEGER) * 60 + try_cast(substr({zone},5,2) AS INTEGER)) END)")
    local = (f"try_cast(substr({x},1,10) || ' ' || substr({x},12,8) || "
             f"CASE WHEN {frac} <> '' THEN '.' || substr({frac},1,6) ELSE '' END AS TIMESTAMP)")
    return local, offset


def _ts_err(x: str) -> str:
    local, offset = _ts_parts(x)
    clock = (f"(try_cast(substr({x},12,2) AS INTEGER) <= 23 AND try_cast(substr({x},15,2) AS INTEGER) <= 59 "
             f"AND try_cast(substr({x},18,2) AS INTEGER) <= 59)")
    valid = (f"(regexp_full_match({x}, {q(TS_RE)}) AND substr({x},1,4) <> '0000' AND {clock} "
             f"AND {local} IS NOT NULL AND abs({offset}) < 1440)")
    return f"CASE WHEN NOT coalesce({valid}, false) THEN 'invalid_timestamp' END"


def _ts_value(x: str) -> str:
    local, offset = _ts_parts(x)
    return f"({local} - to_minutes({offset}))"


def field_sql(f) -> tuple[str, str]:
    """(value, error) SQL of one contract field over its raw column."""
    x = f'"{f.name}"'
    empty = f"({x} IS NULL OR {x} = '')"
    if f.type == DECIMAL:
        terr = _dec_err(x)
        value = f"CASE WHEN NOT {empty} AND ({terr}) IS NULL THEN try_cast({x} AS DECIMAL(27,9)) END"
    elif f.type == TIMESTAMP:
        terr = _ts_err(x)
        value = f"CASE WHEN NOT {empty} AND ({terr}) IS NULL THEN {_ts_value(x)} END"
    else:
        terr = None
        value = f"CASE WHEN NOT {empty} THEN {x} END"
    parts = [f"WHEN {empty} THEN " + ("NULL" if f.nullable else "'non_nullable_empty'")]
    if terr:
        parts.append(f"WHEN ({terr}) IS NOT NULL THEN ({terr})")
    for c in f.constraints:
        cond = {NON_NEGATIVE: f"({value}) >= 0", POSITIVE: f"({value}) > 0",
                UPPERCASE_CURRENCY_CODE: f"regexp_full_match({value}, '[A-Z]{{3}}')",
                TIMEZONE_AWARE: f"({value}) IS NOT NULL"}[c]
        parts.append(f"WHEN NOT coalesce({cond}, true) THEN '{c.lower()}'")
    return value, "CASE " + " ".join(parts) + " END"


def validated_cte(contract: Contract, name: str = "validated") -> str:
    src, _ = RAW_CTES[contract.key]
    vals, errs = [], []
    for i, f in enumerate(contract.fields, start=1):
        v, e = field_sql(f)
        vals.append(f'{v} AS "{f.name}"')
        errs.append(f"{e} AS _err_{i}")
    first_field = "CASE " + " ".join(
        f"WHEN _err_{i} IS NOT NULL THEN '{f.name}'" for i, f in enumerate(contract.fields, 1)) + " END"
    first_cat = "CASE " + " ".join(
        f"WHEN _err_{i} IS NOT NULL THEN _err_{i}" for i, f in enumerate(contract.fields, 1)) + " END"
    first_ord = "CASE " + " ".join(
        f"WHEN _err_{i} IS NOT NULL THEN {i}" for i, f in enumerate(contract.fields, 1)) + " END"
    count = " + ".join(f"CAST(_err_{i} IS NOT NULL AS BIGINT)" for i in range(1, len(contract.fields) + 1))
    return f"""{name} AS (
  SELECT *, {first_field} AS first_field, {first_cat} AS first_category,
         {first_ord} AS first_ordinal, ({count}) AS error_count
  FROM (SELECT contract_id, contract_version, source_identifier, content_sha256, source_id,
               row_number, {", ".join(vals)}, {", ".join(errs)} FROM {src}) t
)"""


def with_ctes(contract: Contract, *extra: str) -> str:
    _, ctes = RAW_CTES[contract.key]
    return "WITH " + ",\n".join([*ctes, validated_cte(contract), *extra])


def failures_cte(name: str = "failures") -> str:
    return f"""{name} AS (
  SELECT source_id, arg_min(first_category, CAST(row_number AS HUGEINT) * 1000 + first_ordinal) AS failure_category,
         min(row_number) AS row_number,
         arg_min(first_field, CAST(row_number AS HUGEINT) * 1000 + first_ordinal) AS field_name
  FROM validated WHERE error_count > 0 GROUP BY source_id
)"""


def accepted_cte(name: str = "accepted") -> str:
    return f"""{name} AS (
  SELECT * FROM validated v WHERE NOT EXISTS (SELECT 1 FROM failures f WHERE f.source_id = v.source_id)
)"""


def _non_blank(x: str) -> str:
    return f"({strip(x)} <> '')"


def _norm(x: str) -> str:
    return f"CASE WHEN {strip(x)} <> '' THEN {strip(x)} END"


def outcomes_cte(contract: Contract, name: str = "outcomes") -> str:
    """Canonical outcomes over accepted rows."""
    if contract.kind == "product":
        rule = ("((list_price IS NOT NULL OR unit_cost IS NOT NULL) = (currency_code IS NOT NULL))")
        abort = (f"CASE WHEN {rule} THEN CASE WHEN NOT {_non_blank('sku')} THEN 'blank_identifier' "
                 f"WHEN NOT {_non_blank('product_name')} THEN 'blank_identifier' "
                 f"WHEN NOT {_non_blank('category_code')} THEN 'blank_identifier' END END")
        status = (f"CASE WHEN NOT {rule} THEN 'BUSINESS_RULE_REJECTED' WHEN ({abort}) IS NOT NULL "
                  f"THEN NULL ELSE 'SUCCESS' END")
        canon = (f"{_norm('sku')} AS sku, {_norm('product_name')} AS product_name, "
                 f"{_norm('category_code')} AS category_code, list_price, unit_cost, "
                 f"currency_code AS product_currency_code")
        cols = ["sku", "product_name", "category_code", "list_price", "unit_cost",
                "product_currency_code"]
    else:
        retail = contract.channel == "RETAIL"
        txn = "receipt_number" if retail else "order_number"
        ts = "transaction_timestamp" if retail else "order_timestamp"
        rule = "(quantity = floor(quantity))"
        overflow = (f"({ts} < TIMESTAMP '0001-01-01 00:00:00' OR "
                    f"{ts} > TIMESTAMP '9999-12-31 23:59:59.999999')")
        checks = [f"WHEN NOT {_non_blank(txn)} THEN 'blank_identifier'",
                  f"WHEN {overflow} THEN 'utc_overflow'"]
        if retail:
            checks.append(f"WHEN NOT {_non_blank('store_code')} THEN 'blank_identifier'")
        checks.append(f"WHEN NOT {_non_blank('sku')} THEN 'blank_identifier'")
        abort = f"CASE WHEN {rule} THEN CASE {' '.join(checks)} END END"
        qty = "try_cast(quantity AS DECIMAL(10,0))"
        status = (f"CASE WHEN NOT {rule} THEN 'BUSINESS_RULE_REJECTED' WHEN ({abort}) IS NOT NULL "
                  f"THEN NULL WHEN {qty} IS NULL THEN 'UNTRANSFORMABLE' ELSE 'SUCCESS' END")
        cust = ("'ABSENT'" if retail else
                "CASE WHEN customer_email IS NULL THEN 'ABSENT' ELSE 'UNRESOLVED_SOURCE_REFERENCE' END")
        store = _norm("store_code") if retail else "CAST(NULL AS VARCHAR)"
        ctx = "'terminal_id=' || terminal_id" if retail else "''"
        canon = (f"'{contract.channel}' AS sales_channel_code, {_norm(txn)} AS source_transaction_number, "
                 f"{ts} AS transaction_timestamp, {store} AS store_code, "
                 f"{cust} AS customer_reference_state, {_norm('sku')} AS product_sku, "
                 f"CAST({qty} AS BIGINT) AS quantity, unit_price, currency_code, "
                 f"CAST(CAST({qty} AS DECIMAL(10,0)) * unit_price AS DECIMAL(38,9)) AS line_amount, "
                 f"{ctx} AS source_local_context")
        cols = ["sales_channel_code", "source_transaction_number", "transaction_timestamp",
                "store_code", "customer_reference_state", "product_sku", "quantity",
                "unit_price", "currency_code", "line_amount", "source_local_context"]
    nulling = ", ".join(f"CASE WHEN status = 'SUCCESS' THEN {c} END AS {c}" for c in cols)
    return f"""{name} AS (
  SELECT source_identifier, source_id, row_number, status,
         CASE WHEN status = 'BUSINESS_RULE_REJECTED' THEN 'BUSINESS_RULE_VIOLATION'
              WHEN status = 'UNTRANSFORMABLE' THEN 'MAPPING_IMPOSSIBLE' END AS issue_code,
         abort_kind, {nulling}
  FROM (SELECT source_identifier, source_id, row_number, {status} AS status, {abort} AS abort_kind,
               {canon} FROM accepted) t
)"""


def counts_cte(name: str = "counts") -> str:
    return f"""{name} AS (
  SELECT source_id, count(*) AS record_count,
         count(*) FILTER (WHERE status = 'SUCCESS') AS success_count,
         count(*) FILTER (WHERE status IS NOT NULL AND status <> 'SUCCESS') AS failure_count,
         arg_min(abort_kind, row_number) FILTER (WHERE abort_kind IS NOT NULL) AS abort_kind,
         min(row_number) FILTER (WHERE abort_kind IS NOT NULL) AS abort_row_number
  FROM outcomes GROUP BY source_id
)"""


def records_cte(name: str = "records") -> str:
    return f"""{name} AS (
  SELECT o.* FROM outcomes o JOIN counts c ON o.source_id = c.source_id
  WHERE o.status = 'SUCCESS' AND c.failure_count = 0 AND c.abort_kind IS NULL
)"""


def quality_cte(contract: Contract, name: str = "quality") -> str:
    if contract.kind == "product":
        return f"""{name} AS (
  SELECT source_id, 'DQ-PRODUCT-001' AS expectation_id, 1 AS expectation_version,
         CASE WHEN max(n) <= 1 THEN 'SATISFIED' ELSE 'VIOLATED' END AS status,
         'product-catalog:v1' AS evaluated_scope,
         CASE WHEN max(n) > 1 THEN 'BLOCKING' END AS disposition,
         CASE WHEN max(n) > 1 THEN 'product-sku:' || arg_min(sku, first_row) FILTER (WHERE n > 1) END AS affected_scope,
         CASE WHEN max(n) > 1 THEN 'DUPLICATE_SKU' END AS issue_code,
         arg_min(sku, first_row) FILTER (WHERE n > 1) AS duplicate_sku,
         sum(n) FILTER (WHERE n > 1) AS affected_count
  FROM (SELECT source_id, sku, count(*) AS n, min(row_number) AS first_row FROM records
        GROUP BY source_id, sku) g
  GROUP BY source_id
)"""
    return f"""{name} AS (
  SELECT source_id, sales_channel_code, source_transaction_number,
         'DQ-SALES-001' AS expectation_id, 1 AS expectation_version,
         CASE WHEN min(currency_code) = max(currency_code) THEN 'SATISFIED' ELSE 'VIOLATED' END AS status,
         'sales-transaction:' || sales_channel_code || ':' || source_transaction_number AS evaluated_scope,
         CASE WHEN min(currency_code) <> max(currency_code) THEN 'BLOCKING' END AS disposition,
         CASE WHEN min(currency_code) <> max(currency_code)
              THEN 'transaction:' || sales_channel_code || ':' || source_transaction_number END AS affected_scope,
         CASE WHEN min(currency_code) <> max(currency_code) THEN 'MIXED_TRANSACTION_CURRENCY' END AS issue_code,
         CAST(NULL AS VARCHAR) AS duplicate_sku,
         CASE WHEN min(currency_code) <> max(currency_code) THEN count(*) END AS affected_count
  FROM records GROUP BY source_id, sales_channel_code, source_transaction_number
)"""


def files_cte(name: str = "files") -> str:
    return f"""{name} AS (
  SELECT source_id, any_value(source_identifier) AS source_identifier FROM validated GROUP BY source_id
)"""


def verdicts_cte(name: str = "verdicts") -> str:
    return f"""{name} AS (
  SELECT f.source_identifier,
    CASE WHEN fl.source_id IS NOT NULL THEN 'FAILED'
         WHEN c.abort_kind IS NOT NULL OR c.failure_count > 0 THEN 'FAILED'
         WHEN qv.any_error THEN 'FAILED' WHEN qv.any_blocking THEN 'BLOCKED'
         ELSE 'SUCCEEDED' END AS state,
    CASE WHEN fl.source_id IS NOT NULL THEN 'INGESTION_FAILURE'
         WHEN c.abort_kind = 'blank_identifier' THEN 'CONFIGURATION_FAILURE'
         WHEN c.abort_kind = 'utc_overflow' THEN 'UNEXPECTED_EXECUTION_FAILURE'
         WHEN c.failure_count > 0 THEN 'TRANSFORMATION_FAILURE'
         WHEN qv.any_error THEN 'DATA_QUALITY_EVALUATION_FAILURE' END AS failure_category,
    CASE WHEN fl.source_id IS NOT NULL THEN 'INGESTION_ERROR'
         WHEN c.abort_kind = 'blank_identifier' THEN 'CONFIGURATION_ERROR'
         WHEN c.abort_kind = 'utc_overflow' THEN 'UNEXPECTED_EXECUTION_ERROR'
         WHEN c.failure_count > 0 THEN 'TRANSFORMATION_UNSUCCESSFUL_OUTCOME'
         WHEN qv.any_error THEN 'DATA_QUALITY_EVALUATION_ERROR' END AS failure_code,
    CASE WHEN fl.source_id IS NOT NULL THEN 1
         WHEN c.abort_kind IS NOT NULL OR c.failure_count > 0 THEN 2
         WHEN qv.any_error THEN 3 END AS failed_stage
  FROM files f LEFT JOIN failures fl ON f.source_id = fl.source_id
  LEFT JOIN counts c ON f.source_id = c.source_id
  LEFT JOIN (SELECT source_id, bool_or(status = 'EVALUATION_ERROR') AS any_error,
                    bool_or(status = 'VIOLATED' AND disposition = 'BLOCKING') AS any_blocking
             FROM quality GROUP BY source_id) qv ON f.source_id = qv.source_id
)"""


def stage_state(seq: int) -> str:
    return (f"CASE WHEN state IN ('SUCCEEDED', 'BLOCKED') THEN 'SUCCEEDED' "
            f"WHEN failed_stage IS NULL THEN 'SKIPPED' WHEN {seq} < failed_stage THEN 'SUCCEEDED' "
            f"WHEN {seq} = failed_stage THEN 'FAILED' ELSE 'SKIPPED' END")


def full_chain(contract: Contract, *extra: str) -> str:
    return with_ctes(contract, failures_cte(), accepted_cte(), outcomes_cte(contract),
                     counts_cte(), records_cte(), quality_cte(contract), files_cte(),
                     verdicts_cte(), *extra)


# --------------------------------------------------------- relational tables
REL_CTES = {
    "sales_channels": """sales_channels AS (
  SELECT * FROM (VALUES (1::BIGINT, 'ECOMMERCE', 'E-Commerce'), (2::BIGINT, 'RETAIL', 'Retail'))
         t(sales_channel_id, sales_channel_code, sales_channel_name)
  UNION ALL SELECT CAST(r_regionkey + 2 AS BIGINT),
         CASE r_regionkey WHEN 1 THEN rpad(r_name, 40, 'X') WHEN 2 THEN 'RETAIL' WHEN 3 THEN ' ' ELSE r_name END,
         CASE WHEN r_regionkey = 4 THEN '' ELSE r_name END FROM region)""",
    "stores": """stores AS (
  SELECT CASE WHEN s_suppkey % 41 = 8 THEN s_suppkey - 1 ELSE s_suppkey END AS store_id,
         CASE WHEN s_suppkey % 47 = 5 THEN '  ' WHEN s_suppkey % 37 = 7 THEN 'STORE-' || CAST(s_suppkey - 1 AS VARCHAR)
              ELSE 'STORE-' || CAST(s_suppkey AS VARCHAR) END AS store_code,
         CASE WHEN s_suppkey % 43 = 6 THEN '' ELSE s_name END AS store_name,
         CASE WHEN s_suppkey % 31 = 9 THEN 'USA' WHEN s_nationkey % 10 = 9 THEN 'Z9'
              ELSE chr(65 + s_nationkey % 26) || chr(65 + (s_nationkey * 7) % 26) END AS country_code
  FROM supplier)""",
    "customers": """customers AS (
  SELECT CASE WHEN c_custkey % 53 = 3 THEN c_custkey - 1 ELSE c_custkey END AS customer_id FROM customer)""",
    "product_categories": """product_categories AS (
  SELECT CAST(CASE WHEN p_size % 100 = 31 THEN p_size - 1 ELSE p_size END AS BIGINT) AS product_category_id,
         CASE WHEN p_size % 100 = 13 THEN ' ' WHEN p_size % 100 = 21 THEN 'SIZE-20'
              ELSE 'SIZE-' || CAST(p_size AS VARCHAR) END AS category_code,
         CASE WHEN p_size % 100 = 17 THEN '' ELSE 'Size ' || CAST(p_size AS VARCHAR) END AS category_name
  FROM (SELECT DISTINCT p_size FROM part))""",
    "products": """products AS (
  SELECT CASE WHEN k % 373 = 8 THEN k - 1 ELSE k END AS product_id,
         CASE WHEN k % 401 = 3 THEN ' ' WHEN k % 397 = 4 THEN 'SKU-' || CAST(k - 1 AS VARCHAR)
              WHEN k % 359 = 10 THEN rpad('SKU-' || CAST(k AS VARCHAR), 120, '0')
              ELSE 'SKU-' || CAST(k AS VARCHAR) END AS sku,
         CASE WHEN k % 389 = 5 THEN ' ' WHEN k % 349 = 12 THEN NULL ELSE p_name END AS product_name,
         CAST(CASE WHEN k % 367 = 9 THEN p_size + 1000 ELSE p_size END AS BIGINT) AS product_category_id,
         CASE WHEN k % 500 = 7 THEN -price WHEN k % 353 = 11 THEN price + 0.0001 ELSE price END AS list_price,
         CASE WHEN k % 383 = 6 THEN CAST(-1.5 AS DECIMAL(28,4)) WHEN p_size % 4 = 0 THEN NULL
              ELSE CAST(p_size AS DECIMAL(28,4)) END AS unit_cost,
         CASE WHEN k % 300 = 11 THEN NULL WHEN k % 379 = 7 THEN 'eu' ELSE 'EUR' END AS currency_code
  FROM (SELECT *, p_partkey AS k, CAST(p_retailprice AS DECIMAL(28,4)) AS price FROM part))""",
    "orders": """orders_t AS (
  SELECT CASE WHEN k % 727 = 4 THEN k - 1 ELSE k END AS order_id,
         CAST(CASE WHEN k % 709 = 2 THEN 99 WHEN k % 2 = 0 THEN 1 ELSE 2 END AS BIGINT) AS sales_channel_id,
         CASE WHEN k % 2 = 1 THEN o_custkey % 120 END AS store_id,
         CASE WHEN k % 719 = 3 THEN o_custkey + 1000000000 ELSE o_custkey END AS customer_id,
         CASE WHEN k % 733 = 5 THEN NULL ELSE o_orderdate END AS order_timestamp,
         CASE WHEN k % 1000 = 5 THEN 'eur' ELSE 'EUR' END AS currency_code,
         CASE WHEN k % 701 = 1 THEN -amount ELSE amount END AS order_amount
  FROM (SELECT *, o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS amount FROM orders))""",
    "order_items": """order_items AS (
  SELECT l_orderkey * 100000 + l_linenumber * 10000 + l_partkey % 10000 AS order_item_id,
         CASE WHEN v % 997 = 6 THEN l_orderkey + 1000000000000 ELSE l_orderkey END AS order_id,
         CASE WHEN v % 997 = 1 THEN 0 ELSE l_linenumber END AS line_number,
         CASE WHEN v % 997 = 7 THEN l_partkey + 1000000000 ELSE l_partkey END AS product_id,
         CASE WHEN v % 997 = 2 THEN -qty ELSE qty END AS quantity,
         CASE WHEN v % 997 = 3 THEN -price ELSE price END AS unit_price,
         CASE WHEN v % 997 = 4 THEN CAST(-0.01 AS DECIMAL(18,2))
              ELSE CAST(l_discount * 100 AS DECIMAL(18,2)) END AS discount_amount,
         CASE WHEN v % 997 = 5 THEN -amount ELSE amount END AS line_amount
  FROM (SELECT *, CAST(price * CAST(qty AS DECIMAL(10,0)) AS DECIMAL(18,2)) AS amount
        FROM (SELECT *, l_orderkey * 7 + l_linenumber * 3 + l_partkey AS v,
                     CAST(trunc(l_quantity) AS INTEGER) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS price
              FROM lineitem)))""",
    "payments": """payments AS (
  SELECT CASE WHEN o_orderkey % 757 = 3 THEN o_orderkey - 1 ELSE o_orderkey END AS payment_id,
         CASE WHEN o_orderkey % 751 = 2 THEN o_orderkey + 1000000000000 ELSE o_orderkey END AS order_id,
         o_orderdate AS payment_timestamp,
         CASE WHEN o_orderstatus = 'P' THEN ' ' ELSE o_orderstatus END AS payment_status,
         CASE WHEN o_orderkey % 743 = 1 THEN -CAST(o_totalprice AS DECIMAL(18,2))
              ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS payment_amount
  FROM orders)""",
    "returns": """returns AS (
  SELECT id AS return_id, CASE WHEN v % 199 = 10 THEN id + 1000000000000000 ELSE id END AS order_item_id,
         l_shipdate AS return_timestamp,
         CASE WHEN v % 199 = 8 THEN -qty ELSE qty END AS return_quantity,
         CASE WHEN v % 199 = 9 THEN -amount ELSE amount END AS return_amount,
         CASE WHEN l_linenumber % 3 = 0 THEN NULL WHEN l_linenumber % 3 = 1 THEN 'damaged' ELSE ' ' END AS return_reason
  FROM (SELECT *, l_orderkey * 100000 + l_linenumber * 10000 + l_partkey % 10000 AS id,
               l_orderkey * 7 + l_linenumber * 3 + l_partkey AS v,
               CAST(trunc(l_quantity) AS INTEGER) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount
        FROM lineitem WHERE l_returnflag = 'R'))""",
}
REL_VIEW = {t: ("orders_t" if t == "orders" else t) for t in REL_CTES}
REL_WITH = "WITH " + ",\n".join(REL_CTES.values())

CHECK_SQL = {
    "sales_channels": [("ck_sales_channels_code_non_blank", "trim(sales_channel_code) <> ''"),
                       ("ck_sales_channels_name_non_blank", "trim(sales_channel_name) <> ''")],
    "stores": [("ck_stores_code_non_blank", "trim(store_code) <> ''"),
               ("ck_stores_name_non_blank", "trim(store_name) <> ''"),
               ("ck_stores_country_code", "regexp_full_match(country_code, '[A-Z]{2}')")],
    "product_categories": [("ck_product_categories_code_non_blank", "trim(category_code) <> ''"),
                           ("ck_product_categories_name_non_blank", "trim(category_name) <> ''")],
    "products": [("ck_products_sku_non_blank", "trim(sku) <> ''"),
                 ("ck_products_name_non_blank", "trim(product_name) <> ''"),
                 ("ck_products_list_price_non_negative", "list_price IS NULL OR list_price >= 0"),
                 ("ck_products_unit_cost_non_negative", "unit_cost IS NULL OR unit_cost >= 0"),
                 ("ck_products_currency_code",
                  "currency_code IS NULL OR regexp_full_match(currency_code, '[A-Z]{3}')"),
                 ("ck_products_currency_presence",
                  "(currency_code IS NOT NULL) = (list_price IS NOT NULL OR unit_cost IS NOT NULL)")],
    "orders": [("ck_orders_currency_code", "regexp_full_match(currency_code, '[A-Z]{3}')"),
               ("ck_orders_amount_non_negative", "order_amount IS NULL OR order_amount >= 0")],
    "order_items": [("ck_order_items_line_number_positive", "line_number > 0"),
                    ("ck_order_items_quantity_positive", "quantity > 0"),
                    ("ck_order_items_unit_price_non_negative", "unit_price >= 0"),
                    ("ck_order_items_discount_non_negative", "discount_amount IS NULL OR discount_amount >= 0"),
                    ("ck_order_items_line_amount_non_negative", "line_amount >= 0")],
    "payments": [("ck_payments_status_non_blank", "trim(payment_status) <> ''"),
                 ("ck_payments_amount_non_negative", "payment_amount >= 0")],
    "returns": [("ck_returns_quantity_positive", "return_quantity > 0"),
                ("ck_returns_amount_non_negative", "return_amount IS NULL OR return_amount >= 0"),
                ("ck_returns_reason_non_blank", "return_reason IS NULL OR trim(return_reason) <> ''")],
}


# ------------------------------------------------------------------ history
def exec_uuid(x: str) -> str:
    return f"('00000000-0000-4000-8000-' || lpad(CAST({x} AS VARCHAR), 12, '0'))"


HISTORY_LOG = f"""log AS (
  SELECT {exec_uuid('user_id')} AS pipeline_execution_id, event_id, ts AS event_time,
         CASE WHEN event_type = 'signup' THEN 'PENDING' WHEN event_type IN ('view', 'click') THEN 'RUNNING'
              WHEN event_type = 'error' THEN 'FAILED'
              WHEN event_type = 'purchase' AND value >= 40.0 THEN 'BLOCKED'
              WHEN event_type = 'purchase' THEN 'SUCCEEDED' END AS target_state,
         CASE WHEN event_type = 'error' THEN 'UNEXPECTED_EXECUTION_FAILURE' END AS failure_category,
         CASE WHEN event_type = 'error' THEN 'UNEXPECTED_EXECUTION_ERROR' END AS failure_code,
         CASE WHEN user_id % 17 = 0 THEN {exec_uuid('user_id')}
              WHEN user_id % 19 = 0 THEN {exec_uuid('user_id + 1000000000')}
              WHEN user_id % 5 <> 0 THEN {exec_uuid('user_id - 1')} END AS predecessor_execution_id
  FROM events
),
slog AS (
  SELECT {exec_uuid('user_id')} AS pipeline_execution_id, event_id, ts AS event_time,
         CASE event_id % 3 WHEN 0 THEN 'INGESTION' WHEN 1 THEN 'TRANSFORMATION' ELSE 'DATA_QUALITY' END AS stage,
         CASE event_type WHEN 'signup' THEN 'PENDING' WHEN 'view' THEN 'RUNNING' WHEN 'click' THEN 'SKIPPED'
              WHEN 'purchase' THEN 'SUCCEEDED' WHEN 'error' THEN 'FAILED' END AS target_state,
         CASE WHEN event_type = 'error' THEN 'INGESTION_FAILURE' END AS failure_category,
         CASE WHEN event_type = 'error' THEN 'INGESTION_ERROR' END AS failure_code
  FROM events
),
s1 AS (
  SELECT pipeline_execution_id, stage, event_time AS t1, event_id AS e1 FROM slog WHERE target_state = 'PENDING'
  QUALIFY row_number() OVER (PARTITION BY pipeline_execution_id, stage ORDER BY event_time, event_id) = 1
),
s2 AS (
  SELECT l.pipeline_execution_id, l.stage, l.event_time AS t2, l.event_id AS e2, l.target_state AS st2
  FROM slog l JOIN s1 USING (pipeline_execution_id, stage)
  WHERE l.target_state IN ('RUNNING', 'SKIPPED') AND (l.event_time, l.event_id) > (s1.t1, s1.e1)
  QUALIFY row_number() OVER (PARTITION BY l.pipeline_execution_id, l.stage ORDER BY l.event_time, l.event_id) = 1
),
s3 AS (
  SELECT l.pipeline_execution_id, l.stage, l.event_time AS t3, l.event_id AS e3, l.target_state AS st3,
         l.failure_category AS fc, l.failure_code AS fcode
  FROM slog l JOIN s2 USING (pipeline_execution_id, stage)
  WHERE s2.st2 = 'RUNNING' AND l.target_state IN ('SUCCEEDED', 'FAILED') AND (l.event_time, l.event_id) > (s2.t2, s2.e2)
  QUALIFY row_number() OVER (PARTITION BY l.pipeline_execution_id, l.stage ORDER BY l.event_time, l.event_id) = 1
),
p1 AS (
  SELECT pipeline_execution_id, event_time AS t1, event_id AS e1 FROM log WHERE target_state = 'PENDING'
  QUALIFY row_number() OVER (PARTITION BY pipeline_execution_id ORDER BY event_time, event_id) = 1
),
p2 AS (
  SELECT l.pipeline_execution_id, l.event_time AS t2, l.event_id AS e2 FROM log l JOIN p1 USING (pipeline_execution_id)
  WHERE l.target_state = 'RUNNING' AND (l.event_time > p1.t1 OR (l.event_time = p1.t1 AND l.event_id > p1.e1))
  QUALIFY row_number() OVER (PARTITION BY l.pipeline_execution_id ORDER BY l.event_time, l.event_id) = 1
),
p3 AS (
  SELECT l.pipeline_execution_id, l.event_time AS t3, l.event_id AS e3, l.target_state AS s3,
         l.failure_category AS fc, l.failure_code AS fcode FROM log l JOIN p2 USING (pipeline_execution_id)
  WHERE l.target_state IN ('SUCCEEDED', 'BLOCKED', 'FAILED')
    AND (l.event_time > p2.t2 OR (l.event_time = p2.t2 AND l.event_id > p2.e2))
  QUALIFY row_number() OVER (PARTITION BY l.pipeline_execution_id ORDER BY l.event_time, l.event_id) = 1
),
execs AS (
  SELECT p1.pipeline_execution_id, CASE WHEN p3.s3 IS NOT NULL THEN p3.s3 WHEN p2.t2 IS NOT NULL THEN 'RUNNING'
         ELSE 'PENDING' END AS state, p1.t1 AS created_at, p2.t2 AS started_at, p3.t3 AS completed_at,
         CASE WHEN p3.s3 = 'FAILED' THEN p3.fc END AS failure_category,
         CASE WHEN p3.s3 = 'FAILED' THEN p3.fcode END AS failure_code,
         p1.e1, p2.e2, p3.e3,
         (SELECT any_value(predecessor_execution_id) FROM log WHERE log.pipeline_execution_id = p1.pipeline_execution_id)
           AS predecessor_execution_id
  FROM p1 LEFT JOIN p2 USING (pipeline_execution_id) LEFT JOIN p3 USING (pipeline_execution_id)
),
stages AS (
  SELECT pipeline_execution_id, stage,
         CASE stage WHEN 'INGESTION' THEN 1 WHEN 'TRANSFORMATION' THEN 2 ELSE 3 END AS stage_sequence,
         coalesce(st3, st2, 'PENDING') AS state, CASE WHEN st2 = 'RUNNING' THEN t2 END AS started_at,
         CASE WHEN st2 = 'RUNNING' THEN t3 ELSE t2 END AS completed_at,
         CASE WHEN st3 = 'FAILED' THEN fc END AS failure_category,
         CASE WHEN st3 = 'FAILED' THEN fcode END AS failure_code, t1, e1, t2, e2, st2, t3, e3
  FROM s1 LEFT JOIN s2 USING (pipeline_execution_id, stage) LEFT JOIN s3 USING (pipeline_execution_id, stage)
),
last_pipelines AS (
  SELECT pipeline_execution_id, arg_max(target_state, CAST(epoch_us(event_time) AS HUGEINT) * 1000000000000 + event_id) AS state,
         min(event_time) AS created_at, min(event_time) FILTER (WHERE target_state = 'RUNNING') AS started_at,
         min(event_time) FILTER (WHERE target_state IN ('SUCCEEDED', 'BLOCKED', 'FAILED')) AS completed_at,
         max(failure_category) AS failure_category, max(failure_code) AS failure_code,
         any_value(predecessor_execution_id) AS predecessor_execution_id
  FROM log GROUP BY pipeline_execution_id
),
last_stages AS (
  SELECT pipeline_execution_id, stage,
         CASE stage WHEN 'INGESTION' THEN 1 WHEN 'TRANSFORMATION' THEN 2 ELSE 3 END AS stage_sequence,
         arg_max(target_state, CAST(epoch_us(event_time) AS HUGEINT) * 1000000000000 + event_id) AS state,
         min(event_time) FILTER (WHERE target_state = 'RUNNING') AS started_at,
         min(event_time) FILTER (WHERE target_state IN ('SUCCEEDED', 'FAILED', 'SKIPPED')) AS completed_at,
         max(failure_category) AS failure_category, max(failure_code) AS failure_code
  FROM slog GROUP BY pipeline_execution_id, stage
)"""
HISTORY_WITH = "WITH " + HISTORY_LOG


REFERENCE_WITH = """WITH approved AS (
  SELECT 'STORE-' || CAST(s_suppkey AS VARCHAR) AS store_code, s_name AS store_name FROM supplier
), agreed AS (
  SELECT DISTINCT CASE WHEN l_suppkey % 10 = 3 THEN 'KIOSK-' ELSE 'STORE-' END || CAST(l_suppkey AS VARCHAR) AS store_code,
         'Supplier#' || lpad(CAST(l_suppkey AS VARCHAR), 9, '0') AS store_name, l_suppkey
  FROM lineitem WHERE l_returnflag = 'R'
), existing AS (
  SELECT store_code, CASE WHEN l_suppkey % 10 = 7 THEN 'Store ' || CAST(l_suppkey AS VARCHAR)
                          ELSE store_name END AS store_name FROM agreed
)"""

#: Keys, references and domains of the business tables as the governed schema has
#: them, written out here and not taken from the operators' own lists.
UNIQUE_SQL = """
 SELECT 'pk_sales_channels' AS constraint_name, CAST(sales_channel_id AS VARCHAR) AS key_value, count(*) AS row_count FROM sales_channels GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'uq_sales_channels_code', sales_channel_code, count(*) FROM sales_channels GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'pk_stores', CAST(store_id AS VARCHAR), count(*) FROM stores GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'uq_stores_code', store_code, count(*) FROM stores GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'pk_customers', CAST(customer_id AS VARCHAR), count(*) FROM customers GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'pk_product_categories', CAST(product_category_id AS VARCHAR), count(*) FROM product_categories GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'uq_product_categories_code', category_code, count(*) FROM product_categories GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'pk_products', CAST(product_id AS VARCHAR), count(*) FROM products GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'uq_products_sku', sku, count(*) FROM products GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'pk_orders', CAST(order_id AS VARCHAR), count(*) FROM orders_t GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'pk_order_items', CAST(order_item_id AS VARCHAR), count(*) FROM order_items GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'uq_order_items_order_line', CAST(order_id AS VARCHAR) || '|' || CAST(line_number AS VARCHAR), count(*) FROM order_items GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'pk_payments', CAST(payment_id AS VARCHAR), count(*) FROM payments GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'pk_returns', CAST(return_id AS VARCHAR), count(*) FROM returns GROUP BY ALL HAVING count(*) > 1"""

FOREIGN_SQL = """
 SELECT 'fk_products_category' AS constraint_name, CAST(product_category_id AS VARCHAR) AS key_value, count(*) AS row_count
 FROM products WHERE product_category_id NOT IN (SELECT product_category_id FROM product_categories) GROUP BY ALL
 UNION ALL SELECT 'fk_orders_channel', CAST(sales_channel_id AS VARCHAR), count(*) FROM orders_t
 WHERE sales_channel_id NOT IN (SELECT sales_channel_id FROM sales_channels) GROUP BY ALL
 UNION ALL SELECT 'fk_orders_store', CAST(store_id AS VARCHAR), count(*) FROM orders_t
 WHERE store_id NOT IN (SELECT store_id FROM stores) GROUP BY ALL
 UNION ALL SELECT 'fk_orders_customer', CAST(customer_id AS VARCHAR), count(*) FROM orders_t
 WHERE customer_id NOT IN (SELECT customer_id FROM customers) GROUP BY ALL
 UNION ALL SELECT 'fk_order_items_order', CAST(order_id AS VARCHAR), count(*) FROM order_items
 WHERE order_id NOT IN (SELECT order_id FROM orders_t) GROUP BY ALL
 UNION ALL SELECT 'fk_order_items_product', CAST(product_id AS VARCHAR), count(*) FROM order_items
 WHERE product_id NOT IN (SELECT product_id FROM products) GROUP BY ALL
 UNION ALL SELECT 'fk_payments_order', CAST(order_id AS VARCHAR), count(*) FROM payments
 WHERE order_id NOT IN (SELECT order_id FROM orders_t) GROUP BY ALL
 UNION ALL SELECT 'fk_returns_order_item', CAST(order_item_id AS VARCHAR), count(*) FROM returns
 WHERE order_item_id NOT IN (SELECT order_item_id FROM order_items) GROUP BY ALL"""

#: table: (view, row key, columns that may not be null, longest texts, amounts).
DOMAIN_SPEC = {
    "sales_channels": ("sales_channels", "sales_channel_id", "sales_channel_id sales_channel_code sales_channel_name",
                       {"sales_channel_code": 32, "sales_channel_name": 100}, ""),
    "stores": ("stores", "store_id", "store_id store_code store_name country_code",
               {"store_code": 50, "store_name": 200, "country_code": 2}, ""),
    "customers": ("customers", "customer_id", "customer_id", {}, ""),
    "product_categories": ("product_categories", "product_category_id", "product_category_id category_code category_name",
                           {"category_code": 50, "category_name": 200}, ""),
    "products": ("products", "product_id", "product_id sku product_name product_category_id",
                 {"sku": 100, "product_name": 255, "currency_code": 3}, "list_price unit_cost"),
    "orders": ("orders_t", "order_id", "order_id sales_channel_id order_timestamp currency_code", {"currency_code": 3},
               "order_amount"),
    "order_items": ("order_items", "order_item_id",
                    "order_item_id order_id line_number product_id quantity unit_price line_amount", {},
                    "unit_price discount_amount line_amount"),
    "payments": ("payments", "payment_id", "payment_id order_id payment_timestamp payment_status payment_amount",
                 {"payment_status": 50}, "payment_amount"),
    "returns": ("returns", "return_id", "return_id order_item_id return_timestamp return_quantity",
                {"return_reason": 255}, "return_amount"),
}


def domain_sql() -> str:
    parts = []
    for table, (view, key, needed, longest, amounts) in DOMAIN_SPEC.items():
        rules = [(f"nn_{c}", f"{c} IS NOT NULL") for c in needed.split()]
        rules += [(f"len_{c}", f"length({c}) <= {n}") for c, n in longest.items()]
        rules += [(f"num_{c}", f"{c} = round({c}, 2) AND abs({c}) < 10000000000000000") for c in amounts.split()]
        parts += [f"SELECT '{table}' AS table_name, CAST({key} AS VARCHAR) AS row_key, '{name}' AS constraint_name "
                  f"FROM {view} WHERE NOT coalesce({cond}, true)" for name, cond in rules]
    return REL_WITH + "\n" + "\nUNION ALL\n".join(parts)


PIPELINE_CHECK_SQL = [
    ("ck_pipeline_executions_state", "state IN ('PENDING', 'RUNNING', 'SUCCEEDED', 'BLOCKED', 'FAILED')"),
    ("ck_pipeline_executions_predecessor_not_self",
     "predecessor_execution_id IS NULL OR predecessor_execution_id <> pipeline_execution_id"),
    ("ck_pipeline_executions_started_at", "started_at IS NULL OR started_at >= created_at"),
    ("ck_pipeline_executions_completed_at",
     "completed_at IS NULL OR (started_at IS NOT NULL AND completed_at >= started_at)"),
    ("ck_pipeline_executions_failure_consistency",
     "(state = 'FAILED' AND failure_category IS NOT NULL) OR (state IN ('PENDING', 'RUNNING', 'SUCCEEDED', "
     "'BLOCKED') AND failure_category IS NULL AND failure_code IS NULL)"),
    ("ck_pipeline_executions_failure_code_category", "failure_code IS NULL OR failure_category IS NOT NULL"),
    ("terminal_requires_completed_at",
     "state NOT IN ('SUCCEEDED', 'BLOCKED', 'FAILED') OR completed_at IS NOT NULL"),
]
STAGE_CHECK_SQL = [
    ("ck_pipeline_stage_executions_stage_sequence",
     "(stage = 'INGESTION' AND stage_sequence = 1) OR (stage = 'TRANSFORMATION' AND stage_sequence = 2) "
     "OR (stage = 'DATA_QUALITY' AND stage_sequence = 3)"),
    ("ck_pipeline_stage_executions_state", "state IN ('PENDING', 'RUNNING', 'SUCCEEDED', 'FAILED', 'SKIPPED')"),
    ("ck_pipeline_stage_executions_shape",
     "(state = 'PENDING' AND started_at IS NULL AND completed_at IS NULL AND failure_category IS NULL AND failure_code IS NULL)"
     " OR (state = 'RUNNING' AND started_at IS NOT NULL AND completed_at IS NULL AND failure_category IS NULL AND failure_code IS NULL)"
     " OR (state = 'SUCCEEDED' AND started_at IS NOT NULL AND completed_at IS NOT NULL AND failure_category IS NULL AND failure_code IS NULL)"
     " OR (state = 'FAILED' AND started_at IS NOT NULL AND completed_at IS NOT NULL AND failure_category IS NOT NULL)"
     " OR (state = 'SKIPPED' AND started_at IS NULL AND completed_at IS NOT NULL AND failure_category IS NULL AND failure_code IS NULL)"),
    ("ck_pipeline_stage_executions_failure_code_category", "failure_code IS NULL OR failure_category IS NOT NULL"),
    ("ck_pipeline_stage_executions_timestamp_order",
     "started_at IS NULL OR completed_at IS NULL OR completed_at >= started_at"),
]
