"""Constraints (P25, A6, J1), reference seeding (S11, J2, J3, U2), history."""

import pytest
from pyspark.sql import functions as F

from sluice.operators import constraints as K
from sluice.operators import history as H
from sluice.operators import reference as R


def test_checks_products(spark):
    df = spark.createDataFrame([(1, "SKU-1", "n", 1.0, None, "EUR"), (2, " ", "n", -1.0, None, "EUR"),
                                (3, "SKU-3", "n", None, None, "EUR"), (4, "SKU-4", "n", 2.0, None, "eu")],
                               "product_id long, sku string, product_name string, list_price double, "
                               "unit_cost double, currency_code string")
    got = sorted((r["product_id"], r["constraint_name"]) for r in
                 K.check_rows(df, K.CHECKS["products"], ["product_id"]).collect())
    assert got == [(2, "ck_products_list_price_non_negative"), (2, "ck_products_sku_non_blank"),
                   (3, "ck_products_currency_presence"), (4, "ck_products_currency_code")]


def test_checks_stage_shape(spark):
    df = spark.createDataFrame([(1, "INGESTION", 1, "SKIPPED", None, "2026-01-01", None, None),
                                (2, "INGESTION", 2, "PENDING", None, None, None, None)],
                               "id long, stage string, stage_sequence int, state string, started_at string, "
                               "completed_at string, failure_category string, failure_code string")
    got = sorted((r["id"], r["constraint_name"]) for r in
                 K.check_rows(df, K.CHECKS["pipeline_stage_executions"], ["id"]).collect())
    assert got == [(2, "ck_pipeline_stage_executions_stage_sequence")]


def test_unique_and_foreign_keys(spark):
    items = spark.createDataFrame([(1, 10, 1), (2, 10, 1), (3, 11, 1), (None, 12, 1)],
                                  "order_item_id long, order_id long, line_number int")
    dup = K.check_unique_keys(items, ["order_id", "line_number"], "uq").collect()
    assert [(r["key_value"], r["row_count"]) for r in dup] == [("10|1", 2)]
    pk = K.check_unique_keys(items, ["order_item_id"], "pk", primary=True).collect()
    assert [(r["key_value"], r["row_count"]) for r in pk] == [("", 1)]
    orders = spark.createDataFrame([(10, None), (11, 5)], "order_id long, store_id long")
    stores = spark.createDataFrame([(1,)], "store_id long")
    fk = K.check_foreign_keys(items, orders, ["order_id"], ["order_id"], "fk_items").collect()
    assert [r["key_value"] for r in fk] == ["12"]
    fk2 = K.check_foreign_keys(orders, stores, ["store_id"], ["store_id"], "fk_store").collect()
    assert [r["key_value"] for r in fk2] == ["5"]   # null store_id is allowed


APPROVED = [("ECOMMERCE", "E-Commerce"), ("RETAIL", "Retail")]


@pytest.mark.parametrize("existing,inserted", [
    ([], ["ECOMMERCE", "RETAIL"]), (APPROVED, []), ([("RETAIL", "Retail")], ["ECOMMERCE"]),
    ([("RETAIL", "Retail shop")], []), ([("MARKET", "Market")], ["ECOMMERCE", "RETAIL"])])
def test_seed_cases(spark, tmp_root, existing, inserted):
    schema = "sales_channel_code string, sales_channel_name string"
    approved = R.reference_rows(spark, APPROVED, schema)
    ex = spark.createDataFrame(existing, schema)
    path = tmp_root + "/channels"
    got = sorted(r[0] for r in R.append_missing_reference(
        approved, ex, "sales_channel_code", "sales_channel_name", path=path).collect())
    assert got == inserted
    conflicts = R.conflicting_reference(approved, ex, "sales_channel_code", "sales_channel_name").count()
    assert conflicts == (1 if existing == [("RETAIL", "Retail shop")] else 0)
    if existing == []:   # a second run inserts nothing
        again = spark.read.parquet(path)
        assert R.missing_reference(approved, again, "sales_channel_code").count() == 0
        assert R.exact_reference_state(approved, again).count() == 0


def test_ledger_audit(spark):
    rec = spark.createDataFrame([(1, "V001__a.sql", "x"), (2, "V002__b.sql", "y"), (9, "V009__z.sql", "z")],
                                "version int, filename string, checksum string")
    man = spark.createDataFrame([(1, "V001__a.sql", "x"), (2, "V002__b.sql", "changed"), (3, "V003__c.sql", "c")],
                                "version int, filename string, checksum string")
    got = {r["version"]: r["status"] for r in R.audit_ledger(rec, man).collect()}
    assert got == {1: "ok", 2: "checksum_mismatch", 3: "not_applied", 9: "unknown_version"}


def log(spark, rows):
    return spark.createDataFrame(
        [("e", i, f"2026-08-01 10:00:{i:02d}", s, "X" if s == "FAILED" else None, None) for i, s in rows],
        "pipeline_execution_id string, event_id long, event_time string, target_state string, "
        "failure_category string, failure_code string").withColumn("event_time", F.col("event_time").cast("timestamp"))


def test_replay_rejects_illegal_transitions(spark):
    lg = log(spark, [(1, "PENDING"), (2, "SUCCEEDED"), (3, "RUNNING"), (4, "FAILED"), (5, "SUCCEEDED")])
    rep = H.replay_pipeline_log(lg)
    r = rep.first()
    assert (r["state"], r["failure_category"]) == ("FAILED", "X")
    tr = {x["event_id"]: (x["prior_state"], x["accepted"]) for x in H.check_transitions(lg, rep).collect()}
    assert tr == {1: (None, True), 2: ("PENDING", False), 3: ("PENDING", True), 4: ("RUNNING", True),
                  5: ("FAILED", False)}


def stage_events(spark, events):
    return log(spark, [(i, st) for i, _, st in events]).join(
        spark.createDataFrame([(i, stage) for i, stage, _ in events], "event_id long, stage string"), "event_id")


def test_stage_replay_and_metrics(spark):
    rep = H.replay_pipeline_log(log(spark, [(1, "PENDING"), (2, "RUNNING"), (32, "SUCCEEDED")]))
    events = stage_events(spark, [
        (1, "INGESTION", "PENDING"), (2, "INGESTION", "SUCCEEDED"), (3, "INGESTION", "RUNNING"),
        (5, "INGESTION", "FAILED"), (6, "INGESTION", "SUCCEEDED"), (7, "DATA_QUALITY", "PENDING"),
        (8, "TRANSFORMATION", "PENDING"), (9, "TRANSFORMATION", "SKIPPED"), (10, "TRANSFORMATION", "RUNNING"),
        (11, "DATA_QUALITY", "PENDING")])
    stages = H.replay_stage_log(events)
    got = {r["stage"]: (r["state"], r["started_at"] is not None, r["completed_at"] is not None) for r in stages.collect()}
    assert got == {"INGESTION": ("FAILED", True, True), "TRANSFORMATION": ("SKIPPED", False, True),
                   "DATA_QUALITY": ("PENDING", False, False)}
    seen = {r["event_id"]: (r["prior_state"], r["accepted"], r["legal_pair"])
            for r in H.check_stage_transitions(events, stages).collect()}
    assert seen[2] == ("PENDING", False, False) and seen[3] == ("PENDING", True, True)
    assert seen[6] == ("FAILED", False, False) and seen[10] == ("SKIPPED", False, False)
    order = H.stage_order_check(events, stages).first()
    assert order["duplicate_stage"] and order["out_of_order"]
    m = H.runtime_metrics(rep, stages).first()
    assert (m["duration_us"], m["ingestion_us"], m["transformation_us"]) == (30_000_000, 2_000_000, None)
    nested = H.join_history(rep, stages).first()["stages"]
    assert [s["stage"] for s in nested] == ["INGESTION", "TRANSFORMATION", "DATA_QUALITY"]


def test_schema_types():
    t = K.struct_type("products")
    assert [f.name for f in t][:2] == ["product_id", "sku"] and t["list_price"].nullable
    assert t["list_price"].dataType.simpleString() == "decimal(18,2)" and not t["sku"].nullable


def test_history_is_written_once_per_run_and_read_by_id(spark, tmp_root):
    events = spark.createDataFrame([("a", 0, "PENDING"), ("a", 1, "RUNNING"), ("b", 0, "PENDING")],
                                   "source_id string, seq int, target_state string")
    for run in ("r1", "r1", "r2"):
        H.write_history(events, tmp_root + "/history", run)
    assert H.read_history(spark, tmp_root + "/history").count() == 6
    ids = spark.createDataFrame([("a",), ("zz",)], "source_id string")
    got = [(r["source_id"], r["found"]) for r in H.read_history(spark, tmp_root + "/history", ids).collect()]
    assert sorted(got) == [("a", True)] * 4 + [("zz", False)]
