"""Registered queries: one per operator, each over the whole given tables.

``QUERIES[name](spark, sf_dir) -> DataFrame`` and ``ORACLES[name] -> SQL``.
Result columns are plain strings/integers (timestamps as ISO text, decimals as
their exact text) so results compare value for value with the SQL oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators.contracts import (
    BUILT_IN_CONTRACTS,
    ECOMMERCE_SALES_V1,
    PRODUCT_CATALOG_V1,
    RETAIL_SALES_V1,
    Contract,
)
from sluice.operators.quality import summarize_quality
from sluice.operators.validate import validate_rows, first_failure_per_file, file_atomic
from sluice.plans import oracle as O
from sluice.plans.ingest import Ingested, ingest_rows, one_pass_verdicts, verdicts_for
from sluice.sources.tables import raw_for

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Instants are compared and printed in UTC whatever session runs us.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            # The JVM never compiles methods of more than 8000 bytes. Parsing and mapping in one
            # method of generated code are longer; beyond this limit Spark cuts them up.
            spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
            return fn(spark, sf_dir)
        run.__name__ = run.__qualname__ = f"query_{name}"
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def ts_text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def dec_text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _sql_union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(f"SELECT * FROM ({p})" for p in parts)


def _ingest(spark: SparkSession, sf_dir: str, contract: Contract) -> Ingested:
    return ingest_rows(raw_for(spark, sf_dir, contract), contract, run_id="registered-query")


# ------------------------------------------------------------------ P13
def _validate_q(spark, sf_dir):
    frames = []
    for c in BUILT_IN_CONTRACTS:
        v = validate_rows(raw_for(spark, sf_dir, c), c)
        frames.append(v.select(
            "source_identifier", "row_number",
            F.size("errors").cast("long").alias("error_count"),
            F.col("first_error.field_name").alias("first_field"),
            F.col("first_error.category").alias("first_category")))
    return _union(frames)


_VALIDATE_SQL = _sql_union([
    O.with_ctes(c) + " SELECT source_identifier, row_number, error_count, first_field, "
                     "first_category FROM validated" for c in BUILT_IN_CONTRACTS])
register("validate_rows", _VALIDATE_SQL)(_validate_q)


# ------------------------------------------------------------------ P14
@register("first_failure_per_file", _sql_union([
    O.with_ctes(c, O.failures_cte()) + " SELECT v.source_identifier, f.failure_category, "
    "f.row_number, f.field_name FROM failures f JOIN (SELECT DISTINCT source_id, source_identifier "
    "FROM validated) v ON f.source_id = v.source_id" for c in BUILT_IN_CONTRACTS]))
def _first_failure_q(spark, sf_dir):
    frames = []
    for c in BUILT_IN_CONTRACTS:
        v = validate_rows(raw_for(spark, sf_dir, c), c)
        frames.append(first_failure_per_file(v, c, ("source_id", "source_identifier")).select(
            "source_identifier", "failure_category", "row_number", "field_name"))
    return _union(frames)


# ------------------------------------------------------------------ P15
@register("file_atomic", _sql_union([
    O.with_ctes(c, O.failures_cte(), O.accepted_cte()) +
    " SELECT source_identifier, count(*) AS accepted_rows, min(row_number) AS first_row, "
    "max(row_number) AS last_row FROM accepted GROUP BY source_identifier"
    for c in BUILT_IN_CONTRACTS]))
def _file_atomic_q(spark, sf_dir):
    frames = []
    for c in BUILT_IN_CONTRACTS:
        ing = _ingest(spark, sf_dir, c)
        frames.append(ing.accepted.groupBy("source_identifier").agg(
            F.count(F.lit(1)).alias("accepted_rows"), F.min("row_number").alias("first_row"),
            F.max("row_number").alias("last_row")))
    return _union(frames)


# ------------------------------------------------------------- P21 / P22
@register("canonicalize", _sql_union([
    O.with_ctes(c, O.failures_cte(), O.accepted_cte(), O.outcomes_cte(c)) +
    " SELECT source_identifier, row_number, status, issue_code, abort_kind FROM outcomes"
    for c in BUILT_IN_CONTRACTS]))
def _canonicalize_q(spark, sf_dir):
    return _union([
        _ingest(spark, sf_dir, c).outcomes.select(
            "source_identifier", "row_number", "status", "issue_code", "abort_kind")
        for c in BUILT_IN_CONTRACTS])


def _sales_select(df: DataFrame) -> DataFrame:
    ctx = F.array_join(F.transform(F.map_entries("source_local_context"),
                                   lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return df.select(
        "source_identifier", "row_number", "status", "sales_channel_code",
        "source_transaction_number", ts_text("transaction_timestamp").alias("transaction_timestamp"),
        "store_code", "customer_reference_state", "product_sku", "quantity",
        dec_text("unit_price").alias("unit_price"), "currency_code",
        dec_text("line_amount").alias("line_amount"),
        F.when(F.col("status") == "SUCCESS", ctx).alias("source_local_context"))


def _sales_sql(c: Contract) -> str:
    return O.with_ctes(c, O.failures_cte(), O.accepted_cte(), O.outcomes_cte(c)) + f"""
 SELECT source_identifier, row_number, status, sales_channel_code, source_transaction_number,
        {O.ts_text('transaction_timestamp')} AS transaction_timestamp, store_code,
        customer_reference_state, product_sku, quantity, CAST(unit_price AS VARCHAR) AS unit_price,
        currency_code, CAST(line_amount AS VARCHAR) AS line_amount, source_local_context
 FROM outcomes"""


@register("map_ecommerce_lines", _sales_sql(ECOMMERCE_SALES_V1))
def _map_ecom_q(spark, sf_dir):
    return _sales_select(_ingest(spark, sf_dir, ECOMMERCE_SALES_V1).outcomes)


@register("map_retail_lines", _sales_sql(RETAIL_SALES_V1))
def _map_retail_q(spark, sf_dir):
    return _sales_select(_ingest(spark, sf_dir, RETAIL_SALES_V1).outcomes)


@register("map_products", O.with_ctes(
    PRODUCT_CATALOG_V1, O.failures_cte(), O.accepted_cte(), O.outcomes_cte(PRODUCT_CATALOG_V1)) + """
 SELECT source_identifier, row_number, status, sku, product_name, category_code,
        CAST(list_price AS VARCHAR) AS list_price, CAST(unit_cost AS VARCHAR) AS unit_cost,
        product_currency_code FROM outcomes""")
def _map_products_q(spark, sf_dir):
    o = _ingest(spark, sf_dir, PRODUCT_CATALOG_V1).outcomes
    return o.select("source_identifier", "row_number", "status", "sku", "product_name",
                    "category_code", dec_text("list_price").alias("list_price"),
                    dec_text("unit_cost").alias("unit_cost"), "product_currency_code")


# ------------------------------------------------------------------ A7
@register("batch_counts", _sql_union([
    O.with_ctes(c, O.failures_cte(), O.accepted_cte(), O.outcomes_cte(c), O.counts_cte()) +
    " SELECT o.source_identifier, c.record_count, c.success_count, c.failure_count, c.abort_kind, "
    "c.abort_row_number FROM counts c JOIN (SELECT DISTINCT source_id, source_identifier FROM outcomes) o "
    "ON c.source_id = o.source_id" for c in BUILT_IN_CONTRACTS]))
def _batch_counts_q(spark, sf_dir):
    frames = []
    for c in BUILT_IN_CONTRACTS:
        ing = _ingest(spark, sf_dir, c)
        names = ing.files.select("source_id", "source_identifier")
        frames.append(ing.counts.join(names, "source_id").select(
            "source_identifier", "record_count", "success_count", "failure_count",
            "abort_kind", "abort_row_number"))
    return _union(frames)


# ------------------------------------------------------------ A1 / A2
def _quality_frame(ing: Ingested) -> DataFrame:
    names = ing.files.select("source_id", "source_identifier")
    return ing.quality.join(names, "source_id").select(
        "source_identifier", "expectation_id", "expectation_version", "status",
        "evaluated_scope", "disposition", "affected_scope",
        F.col("evidence.issue_code").alias("issue_code"),
        F.col("evidence.duplicate_sku").alias("duplicate_sku"),
        F.col("evidence.affected_count").alias("affected_count"))


def _quality_sql(c: Contract) -> str:
    return O.full_chain(c) + f""" SELECT f.source_identifier, q.expectation_id, q.expectation_version,
       q.status, q.evaluated_scope, q.disposition, q.affected_scope, q.issue_code, q.duplicate_sku,
       q.affected_count FROM quality q JOIN files f ON q.source_id = f.source_id"""


@register("sku_uniqueness", _quality_sql(PRODUCT_CATALOG_V1))
def _sku_q(spark, sf_dir):
    return _quality_frame(_ingest(spark, sf_dir, PRODUCT_CATALOG_V1))


@register("transaction_currency", _sql_union([
    _quality_sql(ECOMMERCE_SALES_V1), _quality_sql(RETAIL_SALES_V1)]))
def _currency_q(spark, sf_dir):
    return _union([_quality_frame(_ingest(spark, sf_dir, c))
                   for c in (ECOMMERCE_SALES_V1, RETAIL_SALES_V1)])


# ------------------------------------------------------------------ A5
_SUMMARY_COLS = """count(*) AS total_evaluation_count,
  count(*) FILTER (WHERE status IN ('SATISFIED', 'VIOLATED')) AS applicable_evaluation_count,
  count(*) FILTER (WHERE status = 'SATISFIED') AS satisfied_count,
  count(*) FILTER (WHERE status = 'VIOLATED') AS violation_count,
  count(*) FILTER (WHERE status = 'VIOLATED' AND disposition = 'BLOCKING') AS blocking_violation_count,
  count(*) FILTER (WHERE status = 'VIOLATED' AND disposition = 'NON_BLOCKING') AS non_blocking_violation_count,
  count(*) FILTER (WHERE status = 'NOT_APPLICABLE') AS not_applicable_count,
  count(*) FILTER (WHERE status = 'EVALUATION_ERROR') AS evaluation_error_count"""


@register("summarize_quality", _sql_union([
    O.full_chain(c) + f" SELECT '{c.contract_id}' AS contract_id, {_SUMMARY_COLS} FROM quality"
    for c in BUILT_IN_CONTRACTS]))
def _summary_q(spark, sf_dir):
    return _union([
        summarize_quality(_ingest(spark, sf_dir, c).quality).select(
            F.lit(c.contract_id).alias("contract_id"), "*")
        for c in BUILT_IN_CONTRACTS])


# ------------------------------------------------------------------ K1 / K2
@register("file_verdicts", _sql_union([
    O.full_chain(c) + f""" SELECT source_identifier, state, failure_category, failure_code,
       {O.stage_state(1)} AS ingestion_state, {O.stage_state(2)} AS transformation_state,
       {O.stage_state(3)} AS data_quality_state FROM verdicts""" for c in BUILT_IN_CONTRACTS]))
def _verdicts_q(spark, sf_dir):
    frames = []
    for c in BUILT_IN_CONTRACTS:
        v = one_pass_verdicts(raw_for(spark, sf_dir, c), c)
        frames.append(v.select(
            "source_identifier", "state", "failure_category", "failure_code",
            F.col("stages")[0]["state"].alias("ingestion_state"),
            F.col("stages")[1]["state"].alias("transformation_state"),
            F.col("stages")[2]["state"].alias("data_quality_state")))
    return _union(frames)


# ------------------------------------------------------ P25 / P26 / A6 / J1
from sluice.operators import constraints as K  # noqa: E402
from sluice.sources.relational import business_tables  # noqa: E402

_BUSINESS = ("sales_channels", "stores", "customers", "product_categories", "products",
             "orders", "order_items", "payments", "returns")


def _row_key(table: str) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in K.PRIMARY_KEYS[table]])


@register("check_rows", O.REL_WITH + "\n" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, CAST({K.PRIMARY_KEYS[t][0]} AS VARCHAR) AS row_key, "
    f"'{name}' AS constraint_name FROM {O.REL_VIEW[t]} WHERE NOT coalesce({cond}, true)"
    for t, rules in O.CHECK_SQL.items() for name, cond in rules))
def _check_rows_q(spark, sf_dir):
    tabs = business_tables(spark, sf_dir)
    frames = []
    for t, rules in K.CHECKS.items():
        if t not in tabs:
            continue
        frames.append(K.check_rows(tabs[t].withColumn("_key", _row_key(t)), rules, ["_key"])
                      .select(F.lit(t).alias("table_name"), F.col("_key").alias("row_key"),
                              "constraint_name"))
    return _union(frames)


def _unique_specs():
    for t in _BUSINESS:
        yield t, f"pk_{t}", K.PRIMARY_KEYS[t], True
        for name, cols in K.UNIQUE_KEYS.get(t, ()):
            yield t, name, cols, False


@register("check_unique_keys", O.REL_WITH + O.UNIQUE_SQL)
def _unique_q(spark, sf_dir):
    tabs = business_tables(spark, sf_dir)
    return _union([K.check_unique_keys(tabs[t], cols, name, primary)
                   for t, name, cols, primary in _unique_specs()])


@register("check_foreign_keys", O.REL_WITH + O.FOREIGN_SQL)
def _fk_q(spark, sf_dir):
    tabs = business_tables(spark, sf_dir)
    return _union([K.check_foreign_keys(tabs[child], tabs[parent], ccols, pcols, name)
                   for name, child, ccols, parent, pcols in K.FOREIGN_KEYS if child in tabs])


@register("check_domains", O.domain_sql())
def _domain_q(spark, sf_dir):
    tabs = business_tables(spark, sf_dir)
    return _union([
        K.check_domains(tabs[t].withColumn("_key", _row_key(t)), t, ["_key"]).select(
            F.lit(t).alias("table_name"), F.col("_key").alias("row_key"), "constraint_name")
        for t in _BUSINESS])


# ------------------------------------------------------------------ history
from sluice.operators import history as H  # noqa: E402
from sluice.sources.tables import execution_log, stage_log  # noqa: E402


def _executions(spark, sf_dir):
    log = execution_log(spark, sf_dir)
    rep = H.replay_pipeline_log(log)
    preds = log.groupBy("pipeline_execution_id").agg(
        F.first("predecessor_execution_id").alias("predecessor_execution_id"))
    return log, rep.join(preds, "pipeline_execution_id", "left")


def _stages(spark, sf_dir):
    return H.replay_stage_log(stage_log(spark, sf_dir))


def _exec_text(df: DataFrame, *more: str) -> DataFrame:
    return df.select("pipeline_execution_id", "state",
                     ts_text("created_at").alias("created_at"), ts_text("started_at").alias("started_at"),
                     ts_text("completed_at").alias("completed_at"), "failure_category", "failure_code", *more)


_EXEC_SQL = (f"SELECT pipeline_execution_id, state, {O.ts_text('created_at')} AS created_at, "
             f"{O.ts_text('started_at')} AS started_at, {O.ts_text('completed_at')} AS completed_at, "
             "failure_category, failure_code FROM execs")


@register("current_state", O.HISTORY_WITH + " " + _EXEC_SQL)
def _current_state_q(spark, sf_dir):
    _, ex = _executions(spark, sf_dir)
    return _exec_text(ex)


@register("check_transitions", O.HISTORY_WITH + """
 SELECT l.pipeline_execution_id, l.event_id, l.target_state,
   CASE WHEN e.e1 IS NULL OR (l.event_time, l.event_id) <= (e.created_at, e.e1) THEN NULL
        WHEN e.e2 IS NULL OR (l.event_time, l.event_id) <= (e.started_at, e.e2) THEN 'PENDING'
        WHEN e.e3 IS NULL OR (l.event_time, l.event_id) <= (e.completed_at, e.e3) THEN 'RUNNING'
        ELSE e.state END AS prior_state,
   coalesce(l.event_id IN (e.e1, e.e2, e.e3), false) AS accepted
 FROM log l LEFT JOIN execs e USING (pipeline_execution_id)""")
def _transitions_q(spark, sf_dir):
    log, ex = _executions(spark, sf_dir)
    return H.check_transitions(log, ex).select(
        "pipeline_execution_id", "event_id", "target_state", "prior_state", "accepted")


@register("join_history", O.HISTORY_WITH + f"""
 SELECT e.pipeline_execution_id, e.state, string_agg(s.stage || ':' || s.state || ':' ||
        coalesce({O.ts_text('s.started_at')}, '-') || ':' || coalesce({O.ts_text('s.completed_at')}, '-'),
        ';' ORDER BY s.stage_sequence) AS stages
 FROM execs e JOIN stages s USING (pipeline_execution_id) GROUP BY e.pipeline_execution_id, e.state""")
def _join_history_q(spark, sf_dir):
    _, ex = _executions(spark, sf_dir)
    j = H.join_history(ex, _stages(spark, sf_dir)).where("stages is not null")
    txt = F.array_join(F.transform("stages", lambda s: F.concat_ws(
        ":", s["stage"], s["state"], F.coalesce(ts_text(s["started_at"]), F.lit("-")),
        F.coalesce(ts_text(s["completed_at"]), F.lit("-")))), ";")
    return j.select("pipeline_execution_id", "state", txt.alias("stages"))


@register("runtime_metrics", O.HISTORY_WITH + """
 SELECT e.pipeline_execution_id, e.state, epoch_us(e.completed_at) - epoch_us(e.started_at) AS duration_us,
   max(epoch_us(s.completed_at) - epoch_us(s.started_at)) FILTER (WHERE s.stage = 'INGESTION') AS ingestion_us,
   max(epoch_us(s.completed_at) - epoch_us(s.started_at)) FILTER (WHERE s.stage = 'TRANSFORMATION') AS transformation_us,
   max(epoch_us(s.completed_at) - epoch_us(s.started_at)) FILTER (WHERE s.stage = 'DATA_QUALITY') AS data_quality_us
 FROM execs e LEFT JOIN stages s USING (pipeline_execution_id) GROUP BY ALL""")
def _metrics_q(spark, sf_dir):
    _, ex = _executions(spark, sf_dir)
    return H.runtime_metrics(ex, _stages(spark, sf_dir))


@register("operator_report", O.HISTORY_WITH + f"""
 SELECT pipeline_execution_id, state, {O.ts_text('created_at')} AS created_at,
   {O.ts_text('started_at')} AS started_at, {O.ts_text('completed_at')} AS completed_at,
   failure_category, failure_code,
   CASE WHEN state = 'SUCCEEDED' THEN 0 WHEN state = 'BLOCKED' THEN 3 ELSE 1 END AS exit_status
 FROM execs""")
def _report_q(spark, sf_dir):
    _, ex = _executions(spark, sf_dir)
    return _exec_text(H.operator_report(ex), "exit_status")


@register("predecessor_link", O.HISTORY_WITH + """
 SELECT e.pipeline_execution_id, e.predecessor_execution_id, p.state AS predecessor_state,
   coalesce(e.predecessor_execution_id = e.pipeline_execution_id, false) AS self_reference,
   (e.predecessor_execution_id IS NOT NULL AND p.pipeline_execution_id IS NULL) AS missing_predecessor
 FROM execs e LEFT JOIN execs p ON e.predecessor_execution_id = p.pipeline_execution_id""")
def _pred_q(spark, sf_dir):
    _, ex = _executions(spark, sf_dir)
    return H.predecessor_link(ex)


# ---------------------------------------------------------------- reference
from sluice.operators import reference as R  # noqa: E402
from sluice.sources.relational import approved_stores, registered_stores  # noqa: E402


@register("missing_reference", O.REFERENCE_WITH + """
 SELECT a.store_code, a.store_name FROM approved a
 WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.store_code = a.store_code)""")
def _missing_ref_q(spark, sf_dir):
    return R.missing_reference(approved_stores(spark, sf_dir), registered_stores(spark, sf_dir),
                               "store_code")


@register("conflicting_reference", O.REFERENCE_WITH + """
 SELECT a.store_code, a.store_name AS approved_store_name, e.store_name AS existing_store_name
 FROM approved a JOIN existing e USING (store_code) WHERE a.store_name IS DISTINCT FROM e.store_name""")
def _conflict_ref_q(spark, sf_dir):
    return R.conflicting_reference(approved_stores(spark, sf_dir), registered_stores(spark, sf_dir),
                                   "store_code", "store_name")


@register("exact_reference_state", O.REFERENCE_WITH + """
 SELECT store_code, store_name, 'missing' AS side FROM (SELECT * FROM approved EXCEPT ALL SELECT * FROM existing)
 UNION ALL
 SELECT store_code, store_name, 'unexpected' AS side FROM (SELECT * FROM existing EXCEPT ALL SELECT * FROM approved)""")
def _exact_ref_q(spark, sf_dir):
    return R.exact_reference_state(approved_stores(spark, sf_dir), registered_stores(spark, sf_dir))


@register("append_missing_reference", O.REFERENCE_WITH + """
 SELECT 'agreed' AS register, a.store_code, a.store_name FROM approved a
 WHERE NOT EXISTS (SELECT 1 FROM agreed e WHERE e.store_code = a.store_code)
   AND NOT EXISTS (SELECT 1 FROM approved a2 JOIN agreed e2 USING (store_code)
                   WHERE a2.store_name IS DISTINCT FROM e2.store_name)
 UNION ALL SELECT 'renamed', a.store_code, a.store_name FROM approved a
 WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE e.store_code = a.store_code)
   AND NOT EXISTS (SELECT 1 FROM approved a2 JOIN existing e2 USING (store_code)
                   WHERE a2.store_name IS DISTINCT FROM e2.store_name)""")
def _append_ref_q(spark, sf_dir):
    """S11 against a register that agrees with the approved names, and against
    one with conflicts, which blocks every row."""
    return _union([
        R.append_missing_reference(approved_stores(spark, sf_dir), registered_stores(spark, sf_dir, renamed),
                                   "store_code", "store_name").select(F.lit(label).alias("register"), "*")
        for label, renamed in (("agreed", False), ("renamed", True))])


# ------------------------------------------------------------ scalar rules
from sluice.functions import parsing as P  # noqa: E402
from sluice.functions import text as T  # noqa: E402
from sluice.sources.files import content_sha256, source_identity  # noqa: E402
from sluice.sources.tables import read_table  # noqa: E402


@register("content_sha256", "SELECT doc_id, sha256(text) AS content_sha256 FROM documents")
def _sha_q(spark, sf_dir):
    """S5 over whole document texts (UTF-8 bytes)."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", content_sha256(F.encode("text", "UTF-8")).alias("content_sha256"))


@register("source_identity", """SELECT page_id, sha256('{"content_sha256":"' || sha256(html)
  || '","contract_id":"northstar.product_catalog","contract_version":1,"source_path":"product_catalog/v1/'
  || CAST(page_id AS VARCHAR) || '.csv"}') AS source_id FROM pages""")
def _identity_q(spark, sf_dir):
    """S5 + S7 over one notional file per web page, its html as the content."""
    p = read_table(spark, sf_dir, "pages")
    path = F.concat(F.lit("product_catalog/v1/"), F.col("page_id").cast("string"), F.lit(".csv"))
    return p.select("page_id", source_identity(F.lit("northstar.product_catalog"), F.lit(1), path,
                                               content_sha256(F.encode("html", "UTF-8"))).alias("source_id"))


def _texts_sql() -> str:
    return "WITH " + O.LINES[1:] + """, texts AS (
  SELECT row_number, l_orderkey, l_partkey, l_suppkey, l_linenumber,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) AS t1,
         CAST(CAST(trunc(l_quantity) AS BIGINT) AS VARCHAR) || CASE WHEN v < 100 THEN 'E+' || CAST(v % 3 AS VARCHAR)
              WHEN v < 200 THEN '.' || CAST(v AS VARCHAR) || '0' WHEN v < 300 THEN ' ' ELSE '' END AS t2
  FROM lines)"""


def _texts(spark, sf_dir):
    from sluice.sources.tables import _sales_lines
    li = _sales_lines(spark, sf_dir)
    v = F.col("v")
    q = F.col("l_quantity").cast("long").cast("string")
    t2 = F.concat(q, F.when(v < 100, F.concat(F.lit("E+"), (v % 3).cast("string")))
                  .when(v < 200, F.concat(F.lit("."), v.cast("string"), F.lit("0")))
                  .when(v < 300, F.lit(" ")).otherwise(F.lit("")))
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("t1"),
                     t2.alias("t2"))


@register("parse_decimal", _texts_sql() + f"""
 SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, t2 AS text,
   {O._dec_err('t2')} AS error,
   CAST(CASE WHEN ({O._dec_err('t2')}) IS NULL THEN try_cast(t2 AS DECIMAL(27,9)) END AS VARCHAR) AS value,
   CAST(try_cast(t1 AS DECIMAL(27,9)) AS VARCHAR) AS price
 FROM texts""")
def _parse_decimal_q(spark, sf_dir):
    """P7 over every line's quantity text (plain, exponent, fraction, padded)."""
    t = _texts(spark, sf_dir)
    return t.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", F.col("t2").alias("text"),
                    P.decimal_error("t2").alias("error"),
                    P.parse_decimal("t2").cast("string").alias("value"),
                    P.parse_decimal("t1").cast("string").alias("price"))


def _ts_texts_sql() -> str:
    return f"""WITH ts AS (
  SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') ||
    CASE o_orderkey % 7 WHEN 0 THEN 'Z' WHEN 1 THEN '+23:59' WHEN 2 THEN '-05:00'
         WHEN 3 THEN '.1234567+02:00' WHEN 4 THEN '' WHEN 5 THEN '+24:00' ELSE '-00:30' END AS text
  FROM orders)"""


@register("parse_timestamp", _ts_texts_sql() + f"""
 SELECT o_orderkey, text, {O._ts_err('text')} AS error,
   {O.ts_text("CASE WHEN (" + O._ts_err('text') + ") IS NULL THEN " + O._ts_value('text') + " END")} AS utc
 FROM ts""")
def _parse_ts_q(spark, sf_dir):
    """P8 + F3 over every order date with offsets up to ±23:59 and bad ones."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 7
    suffix = (F.when(k == 0, "Z").when(k == 1, "+23:59").when(k == 2, "-05:00")
              .when(k == 3, ".1234567+02:00").when(k == 4, "").when(k == 5, "+24:00").otherwise("-00:30"))
    t = o.select("o_orderkey", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"),
                                        suffix).alias("text"))
    return t.select("o_orderkey", "text", P.timestamp_error("text").alias("error"),
                    ts_text(P.parse_timestamp("text")).alias("utc"))


@register("normalize_identifier", f"""
 SELECT conv_id, turn, {O._norm('text')} AS identifier, {O._non_blank('text')} AS non_blank
 FROM conversations""")
def _normalize_q(spark, sf_dir):
    """F1 + F13 over whole conversation texts."""
    c = read_table(spark, sf_dir, "conversations")
    return c.select("conv_id", "turn", T.normalize_identifier("text").alias("identifier"),
                    T.non_blank("text").alias("non_blank"))


# ------------------------------------------------------ A4 / A8 / J6 / K3 / K4
from sluice.operators.quality import (  # noqa: E402
    SALES_TRANSACTION_CURRENCY, affected_records, group_coherence, quality_verdict)


@register("quality_verdict", _sql_union([
    O.full_chain(c) + """ SELECT f.source_identifier, bool_or(q.status = 'EVALUATION_ERROR') AS any_evaluation_error,
       bool_or(q.status = 'VIOLATED' AND q.disposition = 'BLOCKING') AS any_blocking_violation
     FROM quality q JOIN files f ON q.source_id = f.source_id GROUP BY f.source_identifier"""
    for c in BUILT_IN_CONTRACTS]))
def _quality_verdict_q(spark, sf_dir):
    frames = []
    for c in BUILT_IN_CONTRACTS:
        ing = _ingest(spark, sf_dir, c)
        frames.append(quality_verdict(ing.quality).join(
            ing.files.select("source_id", "source_identifier"), "source_id").select(
            "source_identifier", "any_evaluation_error", "any_blocking_violation"))
    return _union(frames)


@register("affected_records", _sql_union([
    O.full_chain(c) + """ SELECT r.source_identifier, r.row_number, r.source_transaction_number, r.currency_code
     FROM records r WHERE EXISTS (SELECT 1 FROM quality q WHERE q.status = 'VIOLATED'
       AND q.source_id = r.source_id AND q.sales_channel_code = r.sales_channel_code
       AND q.source_transaction_number = r.source_transaction_number)"""
    for c in (ECOMMERCE_SALES_V1, RETAIL_SALES_V1)]))
def _affected_q(spark, sf_dir):
    """Every line of a mixed-currency transaction (provenance as rows)."""
    frames = []
    for c in (ECOMMERCE_SALES_V1, RETAIL_SALES_V1):
        ing = _ingest(spark, sf_dir, c)
        frames.append(affected_records(ing.records, ing.quality, SALES_TRANSACTION_CURRENCY).select(
            "source_identifier", "row_number", "source_transaction_number", "currency_code"))
    return _union(frames)


def _coherence_sql() -> str:
    member = ("SELECT CAST(regexp_extract(source_transaction_number, '([0-9]+)$', 1) AS BIGINT) AS group_id, "
              "sales_channel_code, source_transaction_number, currency_code FROM records")
    members = " UNION ALL ".join(f"SELECT * FROM ({O.full_chain(c)} {member})"
                                 for c in (ECOMMERCE_SALES_V1, RETAIL_SALES_V1))
    key = "m.sales_channel_code || chr(0) || m.source_transaction_number"
    bad = f"count(m.group_id) = 0 OR min({key}) <> max({key})"
    return f"""WITH members AS ({members})
 SELECT o.o_orderkey AS group_id,
   CASE WHEN {bad} THEN 'EVALUATION_ERROR'
        WHEN min(m.currency_code) = max(m.currency_code) THEN 'SATISFIED' ELSE 'VIOLATED' END AS status,
   CASE WHEN {bad} THEN 'INCOHERENT_TRANSACTION_GROUP' END AS reason_code
 FROM orders o LEFT JOIN members m ON m.group_id = o.o_orderkey GROUP BY o.o_orderkey"""


@register("group_coherence", _coherence_sql())
def _coherence_q(spark, sf_dir):
    """A4: every order as a caller-supplied transaction group over the
    canonical lines of both channels; empty or mixed groups are errors."""
    lines = union_sales_lines(*[_ingest(spark, sf_dir, c).records
                                for c in (ECOMMERCE_SALES_V1, RETAIL_SALES_V1)])
    members = lines.select(
        F.regexp_extract("source_transaction_number", "([0-9]+)\\z", 1).cast("long").alias("group_id"),
        "sales_channel_code", "source_transaction_number", "currency_code")
    groups = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("group_id"))
    return group_coherence(groups, members).select("group_id", "status", "reason_code")


from sluice.operators.canonical import union_sales_lines  # noqa: E402


@register("check_shapes", O.HISTORY_WITH + "\n" + "\nUNION ALL\n".join(
    [f"SELECT 'pipeline_executions' AS table_name, pipeline_execution_id AS row_key, '{n}' AS constraint_name "
     f"FROM last_pipelines WHERE NOT coalesce({cond}, true)" for n, cond in O.PIPELINE_CHECK_SQL] +
    [f"SELECT 'pipeline_stage_executions', pipeline_execution_id || '|' || CAST(stage_sequence AS VARCHAR), "
     f"'{n}' FROM last_stages WHERE NOT coalesce({cond}, true)" for n, cond in O.STAGE_CHECK_SQL]))
def _shapes_q(spark, sf_dir):
    """K4: CHECK rules of both history tables, and the domain rule that a terminal pipeline
    has a completion time, over tables kept without compare-and-set."""
    log, stages = execution_log(spark, sf_dir), stage_log(spark, sf_dir)
    preds = log.groupBy("pipeline_execution_id").agg(
        F.first("predecessor_execution_id").alias("predecessor_execution_id"))
    ex = H.last_event_rows(log, ["pipeline_execution_id"], terminal=H.TERMINAL_PIPELINE).join(
        preds, "pipeline_execution_id")
    rows = H.last_event_rows(stages, ["pipeline_execution_id", "stage"]).withColumn(
        "stage_sequence", F.create_map(*[F.lit(x) for kv in H.STAGE_SEQUENCE.items() for x in kv])[F.col("stage")])
    rules = list(K.CHECKS["pipeline_executions"]) + [
        ("terminal_requires_completed_at", lambda: ~F.col("state").isin("SUCCEEDED", "BLOCKED", "FAILED")
         | F.col("completed_at").isNotNull())]
    a = K.check_rows(ex, rules, ["pipeline_execution_id"]).select(
        F.lit("pipeline_executions").alias("table_name"),
        F.col("pipeline_execution_id").alias("row_key"), "constraint_name")
    b = K.check_rows(rows.withColumn("_k", F.concat_ws("|", "pipeline_execution_id",
                                                         F.col("stage_sequence").cast("string"))),
                     K.CHECKS["pipeline_stage_executions"], ["_k"]).select(
        F.lit("pipeline_stage_executions").alias("table_name"), F.col("_k").alias("row_key"),
        "constraint_name")
    return a.unionByName(b)


def _events_sql() -> str:
    parts = []
    for c in BUILT_IN_CONTRACTS:
        chain = O.full_chain(c, """ev AS (
  SELECT source_identifier, state, failed_stage, NULL AS stage, 0 AS seq, 'PENDING' AS target_state, 0 AS off FROM verdicts
  UNION ALL SELECT source_identifier, state, failed_stage, NULL, 1, 'RUNNING', 1 FROM verdicts
  UNION ALL SELECT source_identifier, state, failed_stage, NULL, 99, state, 8 FROM verdicts
  UNION ALL SELECT source_identifier, state, failed_stage, s.stage, 10 * s.seq,
     CASE WHEN (""" + O.stage_state("s.seq") + """) <> 'SKIPPED' THEN 'RUNNING' END, 2 * s.seq
     FROM verdicts CROSS JOIN (VALUES ('INGESTION', 1), ('TRANSFORMATION', 2), ('DATA_QUALITY', 3)) s(stage, seq)
  UNION ALL SELECT source_identifier, state, failed_stage, s.stage, 10 * s.seq + 1, """ + O.stage_state("s.seq") + """,
     2 * s.seq + 1
     FROM verdicts CROSS JOIN (VALUES ('INGESTION', 1), ('TRANSFORMATION', 2), ('DATA_QUALITY', 3)) s(stage, seq))""")
        parts.append(chain + f""" SELECT source_identifier, stage, seq, target_state,
   {O.ts_text("make_timestamp(epoch_us(TIMESTAMP '2026-01-01 00:00:00') + off * 1000000)")} AS event_time
 FROM ev WHERE target_state IS NOT NULL""")
    return _sql_union(parts)


@register("history_events", _events_sql())
def _events_q(spark, sf_dir):
    """K3: the execution/stage event log implied by every file verdict."""
    frames = []
    for c in BUILT_IN_CONTRACTS:
        v = verdicts_for(_ingest(spark, sf_dir, c))
        frames.append(H.history_events(v, "2026-01-01 00:00:00").select(
            "source_identifier", "stage", "seq", "target_state",
            ts_text("event_time").alias("event_time")))
    return _union(frames)

from sluice.plans import more_queries  # noqa: E402, F401  (registers its queries)
from sluice.plans import edge_queries  # noqa: E402, F401
