"""Validation, canonical mapping, quality, verdicts."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import write
from sluice.operators.canonical import batch_counts, canonicalize
from sluice.operators.contracts import (
    BUILT_IN_REGISTRY, ECOMMERCE_SALES_V1, PRODUCT_CATALOG_V1, RETAIL_SALES_V1, resolve_contract)
from sluice.operators.quality import (
    EVALUATION_ERROR, NOT_APPLICABLE, SATISFIED, VIOLATED, Expectation, evaluate_quality,
    group_coherence, sku_uniqueness, summarize_quality, transaction_currency, affected_records,
    PRODUCT_SKU_UNIQUENESS)
from sluice.operators.validate import (
    check_headers, file_atomic, first_failure_per_file, validate_rows)
from sluice.plans.ingest import ingest_files, verdicts_for

PROV = "contract_id string, contract_version int, source_identifier string, content_sha256 string, source_id string, row_number long"


def sales_rows(spark, rows):
    cols = ", ".join(f"{f.name} string" for f in ECOMMERCE_SALES_V1.fields)
    data = [("northstar.ecommerce_sales", 1, "e/v1/f.csv", "h", sid, rn, *vals) for sid, rn, vals in rows]
    return spark.createDataFrame(data, PROV + ", " + cols)


def good(order="WEB-1", qty="2", price="24.99", cur="EUR", sku="SKU-1"):
    return [order, "2026-08-01T10:15:00+02:00", "a@example.com", sku, qty, price, cur]


def test_resolve_contract(spark):
    req = spark.createDataFrame([("northstar.retail_sales", 1), ("northstar.retail_sales", 2),
                                 ("nope", 1)], "contract_id string, contract_version int")
    got = {(r[0], r[1]): r["resolution"] for r in resolve_contract(req, BUILT_IN_REGISTRY).collect()}
    assert got == {("northstar.retail_sales", 1): "RESOLVED",
                   ("northstar.retail_sales", 2): "UNSUPPORTED_VERSION", ("nope", 1): "UNKNOWN_CONTRACT"}


def test_header_mismatch(spark):
    df = spark.createDataFrame([(["sku", "Product_Name", "category_code", "list_price", "unit_cost",
                                  "currency_code", "extra"],)], "headers array<string>")
    r = check_headers(df, PRODUCT_CATALOG_V1).first()
    assert r["header_mismatch"] and list(r["missing_headers"]) == ["product_name"]
    assert list(r["unexpected_headers"]) == ["Product_Name", "extra"]


def test_first_failure_and_atomicity(spark):
    rows = sales_rows(spark, [("f", 2, good()), ("f", 3, good(qty="0", cur="eur")),
                              ("f", 4, good(price="bad")), ("g", 2, good())])
    v = validate_rows(rows, ECOMMERCE_SALES_V1)
    ff = first_failure_per_file(v, ECOMMERCE_SALES_V1).collect()
    assert [(r["source_id"], r["failure_category"], r["row_number"], r["field_name"]) for r in ff] == [
        ("f", "positive", 3, "quantity")]
    kept = file_atomic(v, first_failure_per_file(v, ECOMMERCE_SALES_V1)).collect()
    assert [r["source_id"] for r in kept] == ["g"]


def test_empty_value_rules(spark):
    rows = sales_rows(spark, [("f", 2, ["WEB-1", "2026-08-01T10:15:00Z", "", "SKU", "1", "1", "EUR"]),
                              ("g", 2, ["", "2026-08-01T10:15:00Z", "", "SKU", "1", "1", "EUR"])])
    v = {r["source_id"]: r for r in validate_rows(rows, ECOMMERCE_SALES_V1).collect()}
    assert v["f"]["errors"] == [] and v["f"]["customer_email"] is None
    assert v["g"]["first_error"]["category"] == "non_nullable_empty"


def test_mixed_outcomes(spark):
    rows = sales_rows(spark, [("f", 2, good(qty="2", price="10.125")), ("f", 3, good(qty="1.5")),
                              ("f", 4, good(qty="3", price="2.10"))])
    o = canonicalize(validate_rows(rows, ECOMMERCE_SALES_V1), ECOMMERCE_SALES_V1, "run").orderBy(
        "row_number").collect()
    assert [r["status"] for r in o] == ["SUCCESS", "BUSINESS_RULE_REJECTED", "SUCCESS"]
    assert o[0]["line_amount"] == Decimal("20.250") and o[2]["line_amount"] == Decimal("6.30")
    assert o[1]["issue_code"] == "BUSINESS_RULE_VIOLATION" and o[1]["line_amount"] is None
    assert str(o[0]["transaction_timestamp"]) == "2026-08-01 08:15:00"


def test_blank_identifier_aborts_file(spark):
    rows = sales_rows(spark, [("f", 2, good()), ("f", 3, good(sku="   ")), ("f", 4, good(qty="1.5"))])
    o = canonicalize(validate_rows(rows, ECOMMERCE_SALES_V1), ECOMMERCE_SALES_V1, "run")
    c = batch_counts(o).first()
    assert (c["abort_kind"], c["abort_row_number"], c["failure_count"]) == ("blank_identifier", 3, 1)


def products(spark, rows):
    return spark.createDataFrame(
        [("f", i + 2, sku, "EUR") for i, sku in enumerate(rows)],
        "source_id string, row_number long, sku string, currency_code string")


@pytest.mark.parametrize("skus,dup,count", [(["A", "B", "A"], "A", 2), (["B", "A", "A", "B"], "B", 4),
                                            (["A", "B"], None, None)])
def test_duplicate_sku(spark, skus, dup, count):
    out = sku_uniqueness(products(spark, skus)).first()
    assert out["status"] == (VIOLATED if dup else SATISFIED)
    assert out["evidence"]["duplicate_sku"] == dup and out["evidence"]["affected_count"] == count
    if dup:
        assert out["affected_scope"] == f"product-sku:{dup}" and out["disposition"] == "BLOCKING"
        aff = affected_records(products(spark, skus), sku_uniqueness(products(spark, skus)),
                               PRODUCT_SKU_UNIQUENESS).count()
        assert aff == count


def test_mixed_currency(spark):
    lines = spark.createDataFrame([("f", "ECOMMERCE", "ORDER-1", "USD"), ("f", "ECOMMERCE", "ORDER-1", "EUR"),
                                   ("f", "ECOMMERCE", "ORDER-2", "EUR")],
                                  "source_id string, sales_channel_code string, source_transaction_number string, currency_code string")
    out = {r["source_transaction_number"]: r for r in transaction_currency(lines).collect()}
    v = out["ORDER-1"]
    assert (v["status"], v["disposition"], v["affected_scope"], v["evidence"]["affected_count"]) == (
        VIOLATED, "BLOCKING", "transaction:ECOMMERCE:ORDER-1", 2)
    assert v["evaluated_scope"] == "sales-transaction:ECOMMERCE:ORDER-1"
    assert out["ORDER-2"]["status"] == SATISFIED and out["ORDER-2"]["evidence"]["issue_code"] is None


def test_incoherent_groups(spark):
    groups = spark.createDataFrame([("empty",), ("two_orders",), ("two_channels",), ("ok",)], "group_id string")
    members = spark.createDataFrame(
        [("two_orders", "ECOMMERCE", "O-1", "EUR"), ("two_orders", "ECOMMERCE", "O-2", "EUR"),
         ("two_channels", "ECOMMERCE", "O-1", "EUR"), ("two_channels", "RETAIL", "O-1", "EUR"),
         ("ok", "RETAIL", "O-9", "EUR")],
        "group_id string, sales_channel_code string, source_transaction_number string, currency_code string")
    got = {r["group_id"]: (r["status"], r["reason_code"]) for r in group_coherence(groups, members).collect()}
    assert got["ok"] == (SATISFIED, None)
    for g in ("empty", "two_orders", "two_channels"):
        assert got[g] == (EVALUATION_ERROR, "INCOHERENT_TRANSACTION_GROUP")


def test_evaluation_precedence_and_summary(spark):
    df = spark.createDataFrame([(1, True, None, True, None), (2, True, None, False, None), (3, False, None, False, None),
                                (4, True, "X", True, None), (5, True, None, True, "Y")],
                               "k int, applies boolean, au string, sat boolean, cu string")
    e = Expectation("DQ-T", 1, "RECORD", "NON_BLOCKING", ("k",), evaluated_scope=lambda: F.col("k").cast("string"),
                    satisfied=lambda: F.col("sat"), applies=lambda: F.col("applies"),
                    applies_unavailable=lambda: F.col("au"), condition_unavailable=lambda: F.col("cu"),
                    affected_scope=lambda: F.lit("rec"))
    out = {r["k"]: r["status"] for r in evaluate_quality(df, [e]).collect()}
    assert out == {1: SATISFIED, 2: VIOLATED, 3: NOT_APPLICABLE, 4: EVALUATION_ERROR, 5: EVALUATION_ERROR}
    s = summarize_quality(evaluate_quality(df, [e])).first()
    assert tuple(s) == (5, 2, 1, 1, 0, 1, 1, 2)
    empty = summarize_quality(evaluate_quality(df.where("k < 0"), [e])).first()
    assert tuple(empty) == (0,) * 8


def test_verdicts_from_files(spark, tmp_root):
    hdr = b"sku,product_name,category_code,list_price,unit_cost,currency_code\n"
    write(tmp_root, "product_catalog/v1/ok.csv", hdr + b"SKU-1001,Trail Bottle,OUTDOOR,24.99,10.50,EUR\nSKU-1002,Travel Mug,HOME,,,\n")
    write(tmp_root, "product_catalog/v1/dup.csv", hdr + b"A,x,C,1,,EUR\nB,y,C,1,,EUR\nA,z,C,1,,EUR\n")
    write(tmp_root, "product_catalog/v1/bad.csv", hdr + b"A,x,C,1,,EUR\nB,y,C,-1,,EUR\n")
    write(tmp_root, "product_catalog/v1/rule.csv", hdr + b"A,x,C,,,EUR\n")
    write(tmp_root, "product_catalog/v1/blank.csv", hdr + b"   ,x,C,1,,EUR\n")
    write(tmp_root, "product_catalog/v1/hdr.csv", b"sku,name\nA,x\n")
    write(tmp_root, "product_catalog/v1/nodata.csv", hdr)
    ing = ingest_files(spark, tmp_root, PRODUCT_CATALOG_V1, run_id="r")
    got = {r["source_identifier"].split("/")[-1]: (r["state"], r["failure_code"], [s["state"] for s in r["stages"]])
           for r in verdicts_for(ing).collect()}
    assert got["ok.csv"] == ("SUCCEEDED", None, ["SUCCEEDED"] * 3)
    assert got["dup.csv"] == ("BLOCKED", None, ["SUCCEEDED"] * 3)
    assert got["bad.csv"] == ("FAILED", "INGESTION_ERROR", ["FAILED", "SKIPPED", "SKIPPED"])
    assert got["hdr.csv"][1] == "INGESTION_ERROR" and got["nodata.csv"][1] == "INGESTION_ERROR"
    assert got["rule.csv"] == ("FAILED", "TRANSFORMATION_UNSUCCESSFUL_OUTCOME", ["SUCCEEDED", "FAILED", "SKIPPED"])
    assert got["blank.csv"] == ("FAILED", "CONFIGURATION_ERROR", ["SUCCEEDED", "FAILED", "SKIPPED"])
    fails = {r["source_id"]: r["failure_category"] for r in ing.ingestion_failures.collect()}
    assert sorted(fails.values()) == ["header_mismatch", "no_data_records", "non_negative"]
