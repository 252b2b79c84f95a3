"""Registered queries of the operators around files, CSV documents, contracts, the
ledger, stage history, expectations and sinks. The SQL is written out by hand."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions import domain as D
from sluice.functions import text as T
from sluice.operators import constraints as K
from sluice.operators import history as H
from sluice.operators.canonical import attach_provenance, canonicalize, check_coherence
from sluice.operators.contracts import (
    BUILT_IN_REGISTRY,
    ECOMMERCE_SALES_V1,
    PRODUCT_CATALOG_V1,
    RETAIL_SALES_V1,
    contract_for_path,
    resolve_contract,
)
from sluice.operators.quality import (
    NON_BLOCKING,
    RECORD,
    BLOCKING,
    Expectation,
    affected_records,
    PRODUCT_SKU_UNIQUENESS,
    evaluate_quality,
    evidence,
)
from sluice.operators.reference import audit_ledger, reference_rows
from sluice.operators.validate import (
    check_has_rows,
    check_headers,
    file_status,
    header_uniqueness,
    project_by_name,
    validate_rows,
)
from sluice.plans import oracle as O
from sluice.plans.ingest import ingest_rows, replay_equivalence, verdicts_for
from sluice.plans.queries import _ingest, _executions, _stages, _union, dec_text, register, ts_text
from sluice.session import ensure_checkpoint_dir
from sluice.sources.csv import parse_text_rows
from sluice.sources.files import eligible_name, select_sources, source_identifier
from sluice.sources.relational import APPROVED_CHANNELS
from sluice.sources.sinks import read_canonical, write_canonical
from sluice.sources.tables import raw_for, read_table, stage_log


def _col(c):
    return F.col(c).cast("string")


# --------------------------------------------------------- files and contracts
_NAMES_SQL = """names AS (
  SELECT page_id, CASE page_id % 9 WHEN 0 THEN 'page-' || page_id || '.csv' WHEN 1 THEN '.page-' || page_id || '.csv'
    WHEN 2 THEN '~page-' || page_id || '.csv' WHEN 3 THEN '#page-' || page_id || '.csv'
    WHEN 4 THEN 'page-' || page_id || '.csv~' WHEN 5 THEN 'page-' || page_id || '.CSV'
    WHEN 6 THEN 'page-' || page_id || '.txt' WHEN 7 THEN '.csv' ELSE 'page ' || page_id || '.csv.csv' END AS name,
    CASE page_id % 5 WHEN 0 THEN 'retail_sales/v1/' WHEN 1 THEN 'product_catalog/v1/' WHEN 2 THEN 'ecommerce_sales/v2/'
    WHEN 3 THEN 'retail_sales/v1/old/' ELSE '' END AS folder FROM pages)"""


def _names(spark, sf_dir) -> DataFrame:
    k, t = F.col("page_id"), F.col("page_id").cast("string")
    forms = ["page-{}.csv", ".page-{}.csv", "~page-{}.csv", "#page-{}.csv", "page-{}.csv~", "page-{}.CSV",
             "page-{}.txt", ".csv", "page {}.csv.csv"]
    folders = ["retail_sales/v1/", "product_catalog/v1/", "ecommerce_sales/v2/", "retail_sales/v1/old/", ""]
    named = F.array(*[F.concat(F.lit(f.split("{}")[0]), t, F.lit(f.split("{}")[1])) if "{}" in f else F.lit(f)
                      for f in forms])
    return read_table(spark, sf_dir, "pages").select(
        "page_id", F.get(named, (k % 9).cast("int")).alias("name"),
        F.get(F.array(*[F.lit(f) for f in folders]), (k % 5).cast("int")).alias("folder"))


@register("eligible_name", f"""WITH {_NAMES_SQL}
 SELECT page_id, name, regexp_full_match(name, '[^.~#].*[.]csv') AS eligible FROM names""")
def _eligible_q(spark, sf_dir):
    """S2 over one file name per web page."""
    return _names(spark, sf_dir).select("page_id", "name", eligible_name("name").alias("eligible"))


@register("contract_for_path", f"""WITH {_NAMES_SQL}
 SELECT page_id, folder || name AS path, CASE folder WHEN 'retail_sales/v1/' THEN 'northstar.retail_sales'
   WHEN 'product_catalog/v1/' THEN 'northstar.product_catalog' END AS contract_id,
   CASE WHEN folder IN ('retail_sales/v1/', 'product_catalog/v1/') THEN 1 END AS contract_version FROM names""")
def _contract_path_q(spark, sf_dir):
    """S3 over one path per web page, some in unknown or nested folders."""
    files = _names(spark, sf_dir).select("page_id", F.concat("folder", "name").alias("path"))
    return contract_for_path(files, BUILT_IN_REGISTRY, "path")


@register("source_identifier", f"""WITH {_NAMES_SQL}
 SELECT page_id, CASE WHEN page_id % 4 <> 0 THEN folder || name END AS source_identifier FROM names""")
def _identifier_q(spark, sf_dir):
    """S6 over qualified paths, a quarter of them outside the root."""
    root = "hdfs://store:8020/data"
    outside = F.col("page_id") % 4 == 0
    path = F.concat(F.when(outside, F.lit(root + "-other/")).otherwise(F.lit(root + "/")), "folder", "name")
    return _names(spark, sf_dir).select("page_id", source_identifier(path, root).alias("source_identifier"))


@register("order_sources", f"""WITH {_NAMES_SQL}
 SELECT folder || name AS source_identifier, page_id FROM names WHERE regexp_full_match(name, '[^.~#].*[.]csv')
 ORDER BY 1, 2""")
def _order_q(spark, sf_dir):
    """O1: eligible paths in byte order."""
    return _names(spark, sf_dir).where(eligible_name("name")).select(
        F.concat("folder", "name").alias("source_identifier"), "page_id").orderBy("source_identifier", "page_id")


@register("select_sources", """WITH listing AS (
  SELECT DISTINCT 'retail_sales/v1/store-' || l_suppkey || '.csv' AS path FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 4 <> 1),
 req AS (SELECT s_suppkey AS request_id, 'retail_sales/v1/store-' || s_suppkey || '.csv' AS requested_path FROM supplier
  UNION ALL SELECT s_suppkey, 'retail_sales/v1/store-' || s_suppkey || '.csv' FROM supplier WHERE s_suppkey % 6 = 0)
 SELECT request_id, requested_path, CAST(path IS NOT NULL AS BIGINT) AS match_count,
   CASE WHEN path IS NULL THEN 'source_selection' ELSE 'SELECTED' END AS selection
 FROM req LEFT JOIN listing ON path = requested_path""")
def _select_q(spark, sf_dir):
    """A request per supplier, every sixth twice, against the files that have retail lines.
    Files of some suppliers lie under a name that nobody asks for."""
    label = lambda c: F.concat(F.lit("retail_sales/v1/store-"), F.col(c).cast("string"), F.lit(".csv"))
    listing = read_table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").withColumn(
        "k", F.when(F.col("l_suppkey") % 4 == 1, -F.col("l_suppkey")).otherwise(F.col("l_suppkey"))).select(
        label("k").alias("source_identifier")).distinct()
    s = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("request_id"),
                                                     label("s_suppkey").alias("requested_path"))
    return select_sources(s.unionByName(s.where("request_id % 6 = 0")), listing)


@register("resolve_contract", """SELECT s_suppkey, id AS contract_id, version AS contract_version,
   CASE WHEN id = 'other.feed' THEN 'UNKNOWN_CONTRACT' WHEN version = 1 THEN 'RESOLVED' ELSE 'UNSUPPORTED_VERSION' END AS resolution
 FROM (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN 'northstar.product_catalog' WHEN 1 THEN 'northstar.retail_sales'
   WHEN 2 THEN 'northstar.ecommerce_sales' ELSE 'other.feed' END AS id, CAST(1 + s_suppkey % 3 // 2 AS INTEGER) AS version FROM supplier)""")
def _resolve_q(spark, sf_dir):
    """One requested contract per supplier, some unknown or of another version."""
    ids = ["northstar.product_catalog", "northstar.retail_sales", "northstar.ecommerce_sales", "other.feed"]
    k = F.col("s_suppkey")
    asked = read_table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.get(F.array(*[F.lit(i) for i in ids]), (k % 4).cast("int")).alias("contract_id"),
        (1 + F.floor((k % 3) / 2)).cast("int").alias("contract_version"))
    return resolve_contract(asked, BUILT_IN_REGISTRY)


@register("reference_rows", """SELECT channel_code, channel_name, count(o_orderkey) AS n_orders
 FROM (VALUES ('ECOMMERCE', 'E-Commerce', 0), ('RETAIL', 'Retail', 1)) t(channel_code, channel_name, parity)
 LEFT JOIN orders ON o_orderkey % 2 = parity GROUP BY ALL""")
def _reference_q(spark, sf_dir):
    """The approved channels as a relation, with the orders of each."""
    rows = reference_rows(spark, [(*c, i) for i, c in enumerate(APPROVED_CHANNELS)],
                          "channel_code string, channel_name string, parity long")
    o = read_table(spark, sf_dir, "orders").groupBy((F.col("o_orderkey") % 2).alias("parity")).agg(
        F.count("o_orderkey").alias("n_orders"))
    return rows.join(o, "parity", "left").select("channel_code", "channel_name", F.coalesce("n_orders", F.lit(0)).alias("n_orders"))


# -------------------------------------------------------------- CSV documents
_DOCS_SQL = """lines AS (
  SELECT l_orderkey AS k, l_partkey AS p, l_linenumber AS n, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity) AS r,
    count(*) OVER (PARTITION BY l_orderkey) AS total FROM lineitem)"""


def _documents(spark, sf_dir) -> DataFrame:
    """One CSV document per order: quoted and doubled quotes, commas and line feeds in
    values, CRLF, a mark, and structural faults by the order's key."""
    li = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity").alias("line"))
    k = F.col("k")
    end = F.when(k % 4 == 1, F.lit("\r\n")).otherwise(F.lit("\n"))
    header = (F.when(k % 50 == 7, F.lit("part,note,part")).when(k % 50 == 8, F.lit("part,,price"))
              .otherwise(F.lit("part,note,price")))
    tail = (F.when(k % 50 == 9, F.lit("1,2")).when(k % 50 == 10, F.lit('1,"open,2'))
            .when(k % 50 == 11, F.lit('1,"a"b,2')).otherwise(F.lit("")))
    # an order has a handful of lines; they become text where they have met
    row = lambda x: F.concat(
        x["l_partkey"].cast("string"), F.lit(',"line '), x["l_linenumber"].cast("string"),
        F.lit(', ""x""\nnext",'), x["l_extendedprice"].cast("decimal(18,2)").cast("string"))
    rows = F.array_join(F.transform(F.array_sort(F.collect_list("line")), row), "\n")
    docs = li.groupBy("k").agg(rows.alias("rows"))
    text = F.concat(F.when(k % 3 == 0, F.lit("﻿")).otherwise(F.lit("")), header, end, F.col("rows"), end, tail)
    return docs.select(k.cast("string").alias("source_id"), k.alias("order_key"),
                       F.when(k % 50 == 12, F.lit("\n\n")).otherwise(text).alias("csv_text"))


@register("read_governed_csv", f"""WITH {_DOCS_SQL}
 SELECT k AS order_key, CAST(2 * r AS BIGINT) AS row_number, CAST(p AS VARCHAR) AS part,
   'line ' || n || ', "x"' || chr(10) || 'next' AS note, price
 FROM lines WHERE k % 50 NOT BETWEEN 7 AND 12""")
def _csv_q(spark, sf_dir):
    """S8 + E6: write every order as a CSV document, parse it back, one row per line."""
    rows = parse_text_rows(_documents(spark, sf_dir)).where("kind = 'row'")
    return rows.select("order_key", "row_number", *[F.get("vals", F.lit(i)).alias(n)
                                                    for i, n in enumerate(("part", "note", "price"))])


@register("csv_structure_failures", f"""WITH {_DOCS_SQL}
 SELECT k AS order_key, CASE k % 50 WHEN 7 THEN 'duplicate_header' WHEN 8 THEN 'empty_header' WHEN 9 THEN 'row_width'
     WHEN 10 THEN 'malformed_csv' WHEN 11 THEN 'malformed_csv' WHEN 12 THEN 'missing_header' END AS failure_category,
   CASE WHEN k % 50 IN (7, 8) THEN 1 WHEN k % 50 = 9 THEN 2 + 2 * any_value(total) END AS row_number,
   CASE WHEN k % 50 = 9 THEN 3 END AS expected_field_count, CASE WHEN k % 50 = 9 THEN 2 END AS actual_field_count,
   CASE WHEN k % 50 NOT BETWEEN 7 AND 12 THEN any_value(total) END AS data_row_count
 FROM lines GROUP BY k""")
def _csv_failures_q(spark, sf_dir):
    """The status of every order's CSV document."""
    return parse_text_rows(_documents(spark, sf_dir)).where("kind = 'file'").select(
        "order_key", "failure_category", "row_number", "expected_field_count", "actual_field_count", "data_row_count")


# ------------------------------------------------------- headers and projection
_HEAD_SQL = """heads AS (
  SELECT o_orderkey AS k, CASE o_orderkey % 6 WHEN 0 THEN ['sku','product_name','category_code','list_price','unit_cost','currency_code']
    WHEN 1 THEN ['currency_code','unit_cost','list_price','category_code','product_name','sku']
    WHEN 2 THEN ['sku','Product_Name','category_code','list_price','unit_cost']
    WHEN 3 THEN ['sku','sku','extra','category_code','list_price','unit_cost','currency_code']
    WHEN 4 THEN ['sku','','b','a'] ELSE CAST([] AS VARCHAR[]) END AS headers FROM orders)"""


def _heads(spark, sf_dir) -> DataFrame:
    full = ["sku", "product_name", "category_code", "list_price", "unit_cost", "currency_code"]
    forms = [full, full[::-1], ["sku", "Product_Name", *full[2:5]], ["sku", "sku", "extra", *full[2:]],
             ["sku", "", "b", "a"], []]
    array = F.array(*[F.array(*[F.lit(x) for x in f]).cast("array<string>") for f in forms])
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"), F.get(array, (F.col("o_orderkey") % 6).cast("int")).alias("headers"))


@register("check_headers", f"""WITH {_HEAD_SQL}, w AS (SELECT unnest(['category_code','currency_code','list_price','product_name','sku','unit_cost']) AS name),
 m AS (SELECT k, string_agg(name, ',' ORDER BY name) AS missing FROM heads, w WHERE NOT list_contains(headers, name) GROUP BY k),
 u AS (SELECT k, string_agg(h, ',' ORDER BY h) AS unexpected FROM (SELECT DISTINCT k, unnest(headers) AS h FROM heads)
       WHERE h NOT IN (SELECT name FROM w) GROUP BY k)
 SELECT heads.k AS order_key, coalesce(missing, '') AS missing, coalesce(unexpected, '') AS unexpected,
   missing IS NOT NULL OR unexpected IS NOT NULL AS header_mismatch
 FROM heads LEFT JOIN m USING (k) LEFT JOIN u USING (k)""")
def _headers_q(spark, sf_dir):
    """P2 + U1 + O5 over one header per order: right, reversed, short, repeated, foreign, empty."""
    return check_headers(_heads(spark, sf_dir), PRODUCT_CATALOG_V1).select(
        F.col("k").alias("order_key"), F.array_join("missing_headers", ",").alias("missing"),
        F.array_join("unexpected_headers", ",").alias("unexpected"), "header_mismatch")


@register("header_uniqueness", f"""WITH {_HEAD_SQL}
 SELECT k AS order_key, len(headers) = len(list_distinct(headers)) AND NOT list_contains(headers, '') AS headers_ok FROM heads""")
def _unique_headers_q(spark, sf_dir):
    """A10."""
    return header_uniqueness(_heads(spark, sf_dir)).select(F.col("k").alias("order_key"), "headers_ok")


@register("check_has_rows", """SELECT p_partkey AS part, count(l_partkey) AS data_row_count
 FROM part LEFT JOIN lineitem ON l_partkey = p_partkey AND l_returnflag = 'R' AND l_partkey % 3 <> 0 GROUP BY p_partkey""")
def _has_rows_q(spark, sf_dir):
    """Data rows per notional file (one per part), zero included; the rows of every third
    part name a file that isn't there."""
    files = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("source_id"))
    k = F.col("l_partkey")
    rows = read_table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(
        F.when(k % 3 == 0, -1 - k).otherwise(k).alias("source_id"))
    return check_has_rows(files, rows).select(F.col("source_id").alias("part"), "data_row_count")


@register("project_by_name", """SELECT p_partkey AS part, 'SKU-' || p_partkey AS sku, p_name AS product_name, p_type AS category_code,
   CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS list_price, NULL AS unit_cost, 'EUR' AS currency_code FROM part""")
def _project_q(spark, sf_dir):
    """Values picked by header name from rows in two column orders."""
    k = F.col("p_partkey")
    p = read_table(spark, sf_dir, "part")
    sku = F.concat(F.lit("SKU-"), k.cast("string"))
    a = F.array(sku, "p_name", "p_type", F.col("p_size").cast("string"), F.lit("EUR"))
    b = F.array(F.lit("EUR"), "p_type", sku, "p_name")
    ha, hb = ["sku", "product_name", "category_code", "list_price", "currency_code"], [
        "currency_code", "category_code", "sku", "product_name"]
    lit = lambda names: F.array(*[F.lit(n) for n in names])
    rows = p.select(k.alias("part"), F.when(k % 2 == 0, lit(ha)).otherwise(lit(hb)).alias("headers"),
                    F.when(k % 2 == 0, a).otherwise(b).alias("vals"))
    return project_by_name(rows, PRODUCT_CATALOG_V1)


# ---------------------------------------------------- provenance and coherence
@register("attach_provenance", O.with_ctes(RETAIL_SALES_V1) + """
 SELECT source_identifier, row_number, 'northstar.retail_sales:1:' || source_identifier || ':' || content_sha256 || ':' ||
   source_id || ':run-1:' || row_number AS provenance FROM validated""")
def _provenance_q(spark, sf_dir):
    """The provenance struct of every retail row."""
    v = validate_rows(raw_for(spark, sf_dir, RETAIL_SALES_V1), RETAIL_SALES_V1)
    p = F.col("provenance")
    text = F.concat_ws(":", p["contract_id"], p["contract_version"], p["source_identifier"], p["content_sha256"],
                       p["source_id"], p["run_id"], p["row_number"])
    return attach_provenance(v, "run-1").select("source_identifier", "row_number", text.alias("provenance"))


@register("check_coherence", O.with_ctes(ECOMMERCE_SALES_V1, O.failures_cte(), O.accepted_cte(), O.outcomes_cte(ECOMMERCE_SALES_V1)) + """
 SELECT source_identifier, row_number, CASE
   WHEN row_number % 7 = 0 AND status = 'SUCCESS' THEN 'success_without_record'
   WHEN row_number % 7 = 1 AND status = 'SUCCESS' THEN 'success_with_issue'
   WHEN row_number % 7 = 2 AND status <> 'SUCCESS' THEN 'failure_without_issue'
   WHEN row_number % 7 = 3 AND status IS NOT NULL THEN 'foreign_identity'
   WHEN row_number % 7 = 3 THEN 'foreign_identity' END AS reason FROM outcomes""")
def _coherence_q(spark, sf_dir):
    """P27 over outcomes some of which were spoiled on purpose."""
    ing = _ingest(spark, sf_dir, ECOMMERCE_SALES_V1)
    k, ok = F.col("row_number") % 7, F.col("status") == "SUCCESS"
    spoiled = ing.outcomes.withColumns({
        "product_sku": F.col("product_sku"),
        "source_transaction_number": F.when(~((k == 0) & ok), F.col("source_transaction_number")),
        "issue_code": F.when((k == 1) & ok, F.lit("X")).when(~((k == 2) & ~ok), F.col("issue_code")),
        "content_sha256": F.when(k == 3, F.lit("other")).otherwise(F.col("content_sha256"))})
    return check_coherence(spoiled, ing.accepted).select("source_identifier", "row_number", "reason")


@register("replay_equivalence", O.with_ctes(RETAIL_SALES_V1, O.failures_cte(), O.accepted_cte(), O.outcomes_cte(RETAIL_SALES_V1)) + """,
 a AS (SELECT source_identifier, row_number, status, CAST(unit_price AS VARCHAR) AS unit_price FROM outcomes),
 b AS (SELECT source_identifier, row_number, status, CASE WHEN row_number % 11 = 0 THEN NULL ELSE unit_price END AS unit_price FROM a)
 SELECT *, 'first' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
 UNION ALL SELECT *, 'second' AS side FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def _replay_q(spark, sf_dir):
    """Two runs under different run ids, the second with some prices lost on purpose."""
    v = ingest_rows(raw_for(spark, sf_dir, RETAIL_SALES_V1), RETAIL_SALES_V1, "first").accepted
    first, second = (canonicalize(v, RETAIL_SALES_V1, run).select(
        "source_identifier", "row_number", "status", dec_text("unit_price").alias("unit_price"), "run_id")
        for run in ("first", "second"))
    second = second.withColumn("unit_price", F.when(F.col("row_number") % 11 != 0, F.col("unit_price")))
    return replay_equivalence(first, second)


@register("audit_ledger", """WITH r AS (SELECT CASE WHEN p_partkey % 10 = 3 THEN -p_partkey ELSE p_partkey END AS k, p_name AS n, p_type AS c FROM part),
 m AS (SELECT CASE WHEN p_partkey % 10 = 6 THEN -p_partkey ELSE p_partkey END AS k, CASE WHEN p_partkey % 10 = 4 THEN 'renamed' ELSE p_name END AS n,
         CASE WHEN p_partkey % 10 = 5 THEN 'changed' ELSE p_type END AS c FROM part),
 j AS (SELECT coalesce(r.k, m.k) AS k, r.k AS rk, m.k AS mk, r.n AS rn, m.n AS mn, r.c AS rc, m.c AS mc FROM r FULL JOIN m USING (k))
 SELECT k AS version, CASE WHEN mk IS NULL THEN 'unknown_version' WHEN rk IS NULL THEN 'not_applied' WHEN rn <> mn THEN 'filename_mismatch'
   WHEN rc <> mc THEN 'checksum_mismatch' WHEN k > (SELECT min(k) FROM j WHERE rk IS NULL) THEN 'non_contiguous' ELSE 'ok' END AS status FROM j""")
def _ledger_q(spark, sf_dir):
    """A ledger of parts against a manifest that differs by key; some versions are recorded
    or listed under a number that the other side doesn't have."""
    k = F.col("p_partkey")
    p = read_table(spark, sf_dir, "part")
    base = p.select(k.alias("version"), F.col("p_name").alias("filename"), F.col("p_type").alias("checksum"))
    v = F.col("version")
    manifest = base.withColumns({
        "version": F.when(v % 10 == 6, -v).otherwise(v),
        "filename": F.when(v % 10 == 4, F.lit("renamed")).otherwise(F.col("filename")),
        "checksum": F.when(v % 10 == 5, F.lit("changed")).otherwise(F.col("checksum"))})
    return audit_ledger(base.withColumn("version", F.when(v % 10 == 3, -v).otherwise(v)), manifest)


# ----------------------------------------------------------------- scalar rules
@register("governed_text_rules", """WITH t AS (
  SELECT page_id, CASE page_id % 7 WHEN 0 THEN sha256(html) WHEN 1 THEN upper(sha256(html)) WHEN 2 THEN substr(sha256(html), 2)
      WHEN 3 THEN 'E-' || page_id WHEN 4 THEN '-E' WHEN 5 THEN 'a/b/' || page_id WHEN 6 THEN 'a/../' || page_id END AS x,
    CASE page_id % 4 WHEN 0 THEN 'V' || lpad(CAST(page_id % 1000 AS VARCHAR), 3, '0') || '__create_' || page_id || '.sql'
      WHEN 1 THEN 'V1__x.sql' WHEN 2 THEN 'V001__Upper.sql' ELSE 'V001__x.SQL' END AS f, page_id % 5 - 2 AS n FROM pages)
 SELECT page_id, regexp_full_match(x, '[0-9a-f]{64}') AS is_sha256, regexp_full_match(x, '[A-Z0-9][A-Z0-9_.-]{0,63}') AS is_failure_code,
   regexp_full_match(x, '[^/].*') AND x NOT LIKE '%//%' AND NOT regexp_matches(x, '(^|/)[.][.]?(/|$)') AS is_relative_path,
   n > 0 AS positive_version, regexp_full_match(f, 'V[0-9]{3}__[a-z0-9_]+[.]sql') AS well_formed,
   CASE WHEN regexp_full_match(f, 'V[0-9]{3}__[a-z0-9_]+[.]sql') THEN CAST(substr(f, 2, 3) AS INTEGER) END AS version,
   CASE WHEN regexp_full_match(f, 'V[0-9]{3}__[a-z0-9_]+[.]sql') THEN regexp_extract(f, '__(.*)[.]sql$', 1) END AS label
 FROM t""")
def _text_rules_q(spark, sf_dir):
    """F11, F12, F14, F15 and F19 over texts derived from every web page."""
    k, t = F.col("page_id"), F.col("page_id").cast("string")
    sha = F.sha2("html", 256)
    x = F.get(F.array(sha, F.upper(sha), F.substring(sha, 2, 63), F.concat(F.lit("E-"), t), F.lit("-E"),
                      F.concat(F.lit("a/b/"), t), F.concat(F.lit("a/../"), t)), (k % 7).cast("int"))
    f = F.get(F.array(F.concat(F.lit("V"), F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("__create_"), t, F.lit(".sql")),
                      F.lit("V1__x.sql"), F.lit("V001__Upper.sql"), F.lit("V001__x.SQL")), (k % 4).cast("int"))
    p = read_table(spark, sf_dir, "pages").select("page_id", x.alias("x"), f.alias("f"), (k % 5 - 2).alias("n"))
    ok, version, label = D.parse_versioned_name("f")
    return p.select("page_id", T.is_sha256("x").alias("is_sha256"), T.is_failure_code("x").alias("is_failure_code"),
                    T.is_relative_path("x").alias("is_relative_path"), D.positive_int("n").alias("positive_version"),
                    ok.alias("well_formed"), version.alias("version"), label.alias("label"))


@register("timestamp_order", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
   s IS NULL OR o IS NULL OR s >= o AS in_order FROM (SELECT *, CASE WHEN l_linenumber % 5 = 0 THEN NULL
     WHEN l_linenumber % 2 = 0 THEN o_orderdate ELSE l_shipdate END AS s, CASE WHEN l_partkey % 7 = 0 THEN NULL
     WHEN l_linenumber % 2 = 0 THEN l_shipdate ELSE o_orderdate END AS o
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""")
def _order_rule_q(spark, sf_dir):
    """F17 over order and ship dates, swapped on every second line, null on some."""
    j = read_table(spark, sf_dir, "lineitem").join(
        read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    swap = F.col("l_linenumber") % 2 == 0
    done = F.when(F.col("l_linenumber") % 5 == 0, F.lit(None)).when(swap, F.col("o_orderdate")).otherwise(F.col("l_shipdate"))
    start = F.when(F.col("l_partkey") % 7 == 0, F.lit(None)).when(swap, F.col("l_shipdate")).otherwise(F.col("o_orderdate"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                    D.timestamp_order_ok(start, done).alias("in_order"))


@register("state_domain", """SELECT event_id, event_type, event_type IN ('view', 'click') AS in_domain FROM events""")
def _domain_rule_q(spark, sf_dir):
    """U5 over every event's type."""
    return read_table(spark, sf_dir, "events").select(
        "event_id", "event_type", D.in_domain("event_type", ("view", "click")).alias("in_domain"))


# ------------------------------------------------------------------ stage history
@register("current_stage_state", O.HISTORY_WITH + f""" SELECT pipeline_execution_id, stage, stage_sequence, state,
   {O.ts_text('started_at')} AS started_at, {O.ts_text('completed_at')} AS completed_at, failure_category, failure_code FROM stages""")
def _stage_state_q(spark, sf_dir):
    """W3 for stages."""
    return _stages(spark, sf_dir).select(
        "pipeline_execution_id", "stage", "stage_sequence", "state", ts_text("started_at").alias("started_at"),
        ts_text("completed_at").alias("completed_at"), "failure_category", "failure_code")


@register("check_stage_transitions", O.HISTORY_WITH + """, m AS (SELECT l.*, s.e1, s.e2, s.e3,
   CASE WHEN s.e1 IS NULL OR (l.event_time, l.event_id) <= (s.t1, s.e1) THEN NULL
        WHEN s.e2 IS NULL OR (l.event_time, l.event_id) <= (s.t2, s.e2) THEN 'PENDING'
        WHEN s.e3 IS NULL OR (l.event_time, l.event_id) <= (s.t3, s.e3) THEN s.st2 ELSE s.state END AS prior_state
   FROM slog l LEFT JOIN stages s USING (pipeline_execution_id, stage))
 SELECT pipeline_execution_id, stage, event_id, target_state, prior_state,
   coalesce(event_id IN (e1, e2, e3), false) AS accepted,
   coalesce((prior_state IS NULL AND target_state = 'PENDING') OR (prior_state = 'PENDING' AND target_state IN ('RUNNING', 'SKIPPED'))
     OR (prior_state = 'RUNNING' AND target_state IN ('SUCCEEDED', 'FAILED')), false) AS legal_pair FROM m""")
def _stage_transitions_q(spark, sf_dir):
    """W2 for stages."""
    log = stage_log(spark, sf_dir)
    return H.check_stage_transitions(log, H.replay_stage_log(log)).drop("event_time")


@register("stage_order_check", O.HISTORY_WITH + """
 SELECT pipeline_execution_id, n > 1 AS duplicate_stage, given <> sorted AS out_of_order FROM (
   SELECT pipeline_execution_id, string_agg(CAST(stage_sequence AS VARCHAR), ',' ORDER BY t1, e1) AS given,
          string_agg(CAST(stage_sequence AS VARCHAR), ',' ORDER BY stage_sequence) AS sorted FROM stages GROUP BY ALL)
 JOIN (SELECT pipeline_execution_id, max(c) AS n FROM (SELECT pipeline_execution_id, stage, count(*) AS c FROM slog
   WHERE target_state = 'PENDING' GROUP BY ALL) GROUP BY ALL) USING (pipeline_execution_id)""")
def _stage_order_q(spark, sf_dir):
    """W4."""
    log = stage_log(spark, sf_dir)
    return H.stage_order_check(log, H.replay_stage_log(log))


@register("history_keys", O.HISTORY_WITH + """
 SELECT 'fk_pipeline_executions_predecessor' AS constraint_name, predecessor_execution_id AS key_value, count(*) AS row_count FROM last_pipelines
 WHERE predecessor_execution_id NOT IN (SELECT pipeline_execution_id FROM last_pipelines) GROUP BY ALL
 UNION ALL SELECT 'fk_stage_executions_execution', pipeline_execution_id, count(*) FROM slog
 WHERE pipeline_execution_id NOT IN (SELECT pipeline_execution_id FROM execs) GROUP BY ALL
 UNION ALL SELECT 'pk_pipeline_executions', pipeline_execution_id, count(*) FROM log GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'pk_pipeline_stage_executions', CAST(event_id % 4000 AS VARCHAR), count(*) FROM slog GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'uq_pipeline_stage_executions_pipeline_stage', pipeline_execution_id || '|' || stage, count(*) FROM slog GROUP BY ALL HAVING count(*) > 1
 UNION ALL SELECT 'uq_pipeline_stage_executions_pipeline_sequence', pipeline_execution_id || '|' ||
   CASE stage WHEN 'INGESTION' THEN '1' WHEN 'TRANSFORMATION' THEN '2' ELSE '3' END, count(*) FROM slog GROUP BY ALL HAVING count(*) > 1""")
def _history_keys_q(spark, sf_dir):
    """J1 and A6 for the two history tables, over the raw logs taken as tables."""
    log, ex = _executions(spark, sf_dir)
    one = log.groupBy("pipeline_execution_id").agg(F.first("predecessor_execution_id").alias("predecessor_execution_id"))
    stages = stage_log(spark, sf_dir).withColumns({
        "pipeline_stage_execution_id": F.col("event_id") % 4000,
        "stage_sequence": F.create_map(*[F.lit(x) for kv in H.STAGE_SEQUENCE.items() for x in kv])[F.col("stage")]})
    names = {n: (c, p) for n, _, c, _, p in K.FOREIGN_KEYS}
    fk = [K.check_foreign_keys(child, parent, *names[n], n) for n, child, parent in (
        ("fk_pipeline_executions_predecessor", one, one), ("fk_stage_executions_execution", stages, ex))]
    uq = [K.check_unique_keys(log, K.PRIMARY_KEYS["pipeline_executions"], "pk_pipeline_executions", True),
          K.check_unique_keys(stages, K.PRIMARY_KEYS["pipeline_stage_executions"], "pk_pipeline_stage_executions", True)]
    uq += [K.check_unique_keys(stages, cols, n) for n, cols in K.UNIQUE_KEYS["pipeline_stage_executions"]]
    return _union(fk + uq)


# -------------------------------------------------------------------- expectations
def _price_expectation(disposition: str) -> Expectation:
    """A product's list price is at least twice its unit cost; needs both."""
    return Expectation(
        "DQ-PRICE-001", 2, RECORD, disposition, ("source_id", "source_identifier", "row_number"),
        evaluated_scope=lambda: F.concat(F.lit("product-row:"), F.col("row_number").cast("string")),
        applies=lambda: F.col("product_currency_code").isNotNull(),
        applies_unavailable=lambda: F.when(F.col("row_number") % 40 == 5, F.lit("NO_PRICE_POLICY")),
        satisfied=lambda: F.coalesce(F.col("list_price") >= F.col("unit_cost") * 40, F.lit(False)),
        condition_unavailable=lambda: F.when(F.col("unit_cost").isNull(), F.lit("NO_UNIT_COST")),
        affected_scope=lambda: F.concat(F.lit("sku:"), F.col("sku")),
        evidence_of=lambda: evidence("PRICE_BELOW_COST_RULE"))


_PRICE_SQL = """prices AS (SELECT source_id, source_identifier, row_number,
   CASE WHEN row_number % 40 = 5 THEN 'EVALUATION_ERROR' WHEN product_currency_code IS NULL THEN 'NOT_APPLICABLE'
        WHEN unit_cost IS NULL THEN 'EVALUATION_ERROR' WHEN list_price >= unit_cost * 40 THEN 'SATISFIED' ELSE 'VIOLATED' END AS status,
   CASE WHEN row_number % 40 = 5 THEN 'NO_PRICE_POLICY' WHEN product_currency_code IS NOT NULL AND unit_cost IS NULL THEN 'NO_UNIT_COST' END AS reason_code,
   sku FROM records)"""


@register("evaluate_quality", O.full_chain(PRODUCT_CATALOG_V1, _PRICE_SQL) + """
 SELECT source_identifier, row_number, status, reason_code, CASE WHEN status = 'VIOLATED' THEN 'NON_BLOCKING' END AS disposition,
   CASE WHEN status = 'VIOLATED' THEN 'sku:' || sku END AS affected_scope, source_id || ':' || source_identifier || ':' || row_number AS provenance
 FROM prices""")
def _evaluate_q(spark, sf_dir):
    """A caller's RECORD expectation with every outcome, and the record it names."""
    records = _ingest(spark, sf_dir, PRODUCT_CATALOG_V1).records
    p = F.get("provenance", F.lit(0))
    return evaluate_quality(records, [_price_expectation(NON_BLOCKING)]).select(
        "source_identifier", "row_number", "status", F.col("evidence.reason_code").alias("reason_code"), "disposition",
        "affected_scope", F.concat_ws(":", p["source_id"], p["source_identifier"], p["row_number"]).alias("provenance"))


def _custom_verdicts(disposition: str) -> str:
    return f"""SELECT '{disposition}' AS disposition, f.source_identifier,
   CASE WHEN fl.source_id IS NOT NULL OR c.abort_kind IS NOT NULL OR c.failure_count > 0 THEN 'FAILED'
        WHEN q.err THEN 'FAILED' WHEN q.bad AND '{disposition}' = 'BLOCKING' THEN 'BLOCKED' ELSE 'SUCCEEDED' END AS state,
   CASE WHEN fl.source_id IS NOT NULL THEN 'INGESTION_FAILURE' WHEN c.abort_kind = 'blank_identifier' THEN 'CONFIGURATION_FAILURE'
        WHEN c.failure_count > 0 THEN 'TRANSFORMATION_FAILURE' WHEN q.err THEN 'DATA_QUALITY_EVALUATION_FAILURE' END AS failure_category
 FROM files f LEFT JOIN failures fl USING (source_id) LEFT JOIN counts c ON c.source_id = f.source_id
 LEFT JOIN (SELECT source_id, bool_or(status = 'EVALUATION_ERROR' AND reason_code = 'NO_PRICE_POLICY') AS err,
              bool_or(status = 'VIOLATED') AS bad FROM prices GROUP BY source_id) q ON q.source_id = f.source_id"""


@register("file_verdicts_with_expectations", O.full_chain(PRODUCT_CATALOG_V1, _PRICE_SQL) + " " + " UNION ALL ".join(
    _custom_verdicts(d) for d in ("BLOCKING", "NON_BLOCKING")))
def _custom_verdicts_q(spark, sf_dir):
    """E1 + K1: file verdicts under a caller's expectation, blocking and not."""
    from dataclasses import replace
    frames = []
    for disposition in (BLOCKING, NON_BLOCKING):
        e = replace(_price_expectation(disposition), condition_unavailable=None)
        ing = ingest_rows(raw_for(spark, sf_dir, PRODUCT_CATALOG_V1), PRODUCT_CATALOG_V1, "run", expectations=[
            replace(e, applies=lambda: F.col("product_currency_code").isNotNull() & F.col("unit_cost").isNotNull())])
        frames.append(verdicts_for(ing).select(F.lit(disposition).alias("disposition"), "source_identifier", "state",
                                               "failure_category"))
    return _union(frames)


@register("affected_products", O.full_chain(PRODUCT_CATALOG_V1) + """
 SELECT source_identifier, row_number, sku FROM records r WHERE sku IN
   (SELECT sku FROM records r2 WHERE r2.source_id = r.source_id GROUP BY sku HAVING count(*) > 1)""")
def _affected_products_q(spark, sf_dir):
    """J6 for duplicated SKUs."""
    ing = _ingest(spark, sf_dir, PRODUCT_CATALOG_V1)
    return affected_records(ing.records, ing.quality, PRODUCT_SKU_UNIQUENESS).select("source_identifier", "row_number", "sku")


# ---------------------------------------------------------------------------- sinks
def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/sluice-{name}-{uuid.uuid4().hex}"


@register("write_canonical", O.full_chain(PRODUCT_CATALOG_V1) + """
 SELECT source_identifier, row_number, sku, product_name, CAST(list_price AS VARCHAR) AS list_price FROM records""")
def _write_canonical_q(spark, sf_dir):
    """Store the canonical products twice under different runs and read them back once."""
    path = _scratch(spark, "canonical")
    for run in ("first", "second"):
        ing = ingest_rows(raw_for(spark, sf_dir, PRODUCT_CATALOG_V1), PRODUCT_CATALOG_V1, run)
        write_canonical(ing.records, path)
        ing.release()
    return read_canonical(spark, path, ing.records.schema).select("source_identifier", "row_number", "sku", "product_name",
                                              dec_text("list_price").alias("list_price"))


@register("write_history", O.full_chain(PRODUCT_CATALOG_V1) + """ SELECT source_identifier, found, n_events FROM (
   SELECT source_identifier, true AS found, CASE WHEN state IN ('SUCCEEDED', 'BLOCKED') OR failed_stage = 3 THEN 9
     WHEN failed_stage = 2 THEN 8 WHEN failed_stage = 1 THEN 7 END AS n_events FROM verdicts)
 UNION ALL SELECT 'no such file', false, 0""")
def _write_history_q(spark, sf_dir):
    """S12 + S13: store the events of every verdict twice under one run, read every file's
    events and those of a file that has none."""
    path = _scratch(spark, "history")
    ing = _ingest(spark, sf_dir, PRODUCT_CATALOG_V1)
    events = H.history_events(verdicts_for(ing), "2026-01-01 00:00:00")
    for _ in range(2):
        H.write_history(events, path, "run-1", "source_identifier")
    ids = ing.files.select("source_identifier").distinct()
    ids = ids.unionByName(spark.createDataFrame([("no such file",)], "source_identifier string"))
    return H.read_history(spark, path, ids, "source_identifier").groupBy("source_identifier", "found").agg(
        F.count("target_state").alias("n_events"))
