"""Findings of round 3: what the queries no longer store, hold or shuffle."""

from pyspark.sql import functions as F

from sluice.functions.text import unicode_strip
from sluice.operators.canonical import check_coherence
from sluice.operators.compare import multiset_difference
from sluice.operators.constraints import check_foreign_keys, check_unique_keys
from sluice.operators.contracts import RETAIL_SALES_V1
from sluice.plans.edge_queries import _rare_q
from sluice.plans.ingest import ingest_rows, one_pass_verdicts

FIELDS = ("receipt_number", "transaction_timestamp", "store_code", "terminal_id", "sku", "quantity", "unit_price",
          "currency_code")


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _raw(spark):
    ts = "2026-08-02T09:30:00+02:00"
    rows = [("a", 2, "P-1", ts, "S", "T", "K", "1", "2.50", "EUR"), ("a", 3, "P-1", ts, "S", "T", "K", "2", "2.50", "USD"),
            ("b", 2, "P-2", ts, "S", "T", "K", "1", "bad", "EUR"), ("b", 3, "P-3", ts, "S", "T", "K", "1.5", "1", "EUR"),
            ("c", 2, "P-4", ts, "S", "T", "K", "1.5", "1", "EUR"), ("c", 3, " ", ts, "S", "T", "K", "1", "1", "EUR"),
            (None, 2, "P-5", ts, "S", "T", "K", "1", "1", "EUR"), (None, 3, "P-5", ts, "S", "T", "K", "0", "1", "EUR")]
    schema = "source_id string, row_number long, " + ", ".join(f"{f} string" for f in FIELDS)
    c = RETAIL_SALES_V1
    return spark.createDataFrame(rows, schema).select(
        F.lit(c.contract_id).alias("contract_id"), F.lit(c.version).alias("contract_version"),
        F.concat(F.lit("retail_sales/v1/"), F.coalesce("source_id", F.lit("none"))).alias("source_identifier"),
        F.lit("hash").alias("content_sha256"), "*")


def test_ingestion_stores_one_row_per_file(spark):
    ing = ingest_rows(_raw(spark), RETAIL_SALES_V1, "run")
    for df in (ing.accepted, ing.outcomes, ing.counts, ing.records, ing.quality, ing.files):
        assert "InMemoryRelation" not in _plan(df)  # validated rows were cached, memory and disk
    assert [tuple(r) for r in ing.ingestion_failures.select("source_id", "row_number", "field_name").where(
        "source_id is not null").collect()] == [("b", 2, "unit_price")]
    counts = {r["source_id"]: (r["record_count"], r["success_count"], r["failure_count"], r["abort_kind"],
                               r["abort_row_number"]) for r in ing.counts.collect()}
    assert counts == {"a": (2, 2, 0, None, None), "c": (2, 0, 1, "blank_identifier", 3), None: (2, 2, 0, None, None)}
    assert ing.accepted.count() == 6  # a file without an id is no file's failure
    assert [(r["source_id"], r["status"]) for r in ing.quality.collect()] == [("a", "VIOLATED")]
    assert {(r["source_id"], r["raw_row_count"]) for r in ing.files.collect()} == {
        ("a", 2), ("b", 2), ("c", 2), (None, 2)}


def test_keys_are_dealt_before_they_are_counted(spark):
    child = spark.createDataFrame([(i % 3 if i % 7 else None,) for i in range(700)], "k long")
    parent = spark.createDataFrame([(0,), (1,)], "p long")
    unique = check_unique_keys(child, ["k"], "pk", True)
    missing = check_foreign_keys(child, parent, ["k"], ["p"], "fk")
    for df in (unique, missing):
        lines = df._jdf.queryExecution().sparkPlan().toString().splitlines()
        assert any("REPARTITION_BY_COL" in x for x in lines) or "RepartitionByExpression" in _plan(df)
    assert sum(r["row_count"] for r in unique.collect()) == 700
    assert [(r["key_value"], r["row_count"]) for r in missing.collect()] == [
        ("2", sum(1 for i in range(700) if i % 7 and i % 3 == 2))]


def test_verdicts_deal_rows_before_keys_are_held(spark):
    v = one_pass_verdicts(_raw(spark), RETAIL_SALES_V1)
    assert "RepartitionByExpression" in _plan(v)
    assert {r["source_id"]: r["state"] for r in v.where("source_id is not null").collect()} == {
        "a": "BLOCKED", "b": "FAILED", "c": "FAILED"}


def test_difference_is_one_aggregate(spark):
    a = spark.createDataFrame([("x", 1), ("x", 1), ("x", None), ("y", 2)], "g string, v int")
    b = spark.createDataFrame([("x", 1), ("x", None), ("x", None), ("z", 3), ("z", 3), ("y", 2)], "g string, v int")
    d = multiset_difference(a, b, "g")
    assert _plan(d).count("Aggregate") == 1  # each side was subtracted from the other before
    assert sorted(map(str, d.collect())) == sorted(map(str, [
        ("x", 1, "first"), ("x", None, "second"), ("z", 3, "second"), ("z", 3, "second")])) or {
        tuple(r) for r in d.collect()} == {("x", 1, "first"), ("x", None, "second"), ("z", 3, "second")} and d.count() == 4


def test_rare_outcomes_read_their_rows_once(spark):
    df = _rare_q(spark, "/root/testdata/sf0.001")
    assert "Union" not in _plan(df)


def test_coherence_compares_digests(spark):
    schema = ("source_id string, row_number long, contract_id string, contract_version int, source_identifier string, "
              "content_sha256 string, status string, abort_kind string, issue_code string, issue_message string, sku string")
    good = ("a", 2, "c", 1, "p", "h", "SUCCESS", None, None, None, "k")
    rows = [good, ("a", 3, "c", 1, "p", "other", *good[6:]), (None, 4, None, None, None, None, *good[6:]),
            (None, 5, "c", None, None, None, *good[6:])]
    batch = spark.createDataFrame([good, good, ("a", 3, *good[2:])], schema)
    out = check_coherence(spark.createDataFrame(rows, schema), batch)
    assert "_b_content_sha256" not in _plan(out)
    assert sorted((r["row_number"], r["reason"] or "") for r in out.collect()) == [
        (2, ""), (2, ""), (3, "foreign_identity"), (4, ""), (5, "foreign_identity")]


def test_strip_of_visible_ends(spark):
    texts = ["", " ", "a", " a ", "a b", " a", "a　", "é", " é\t", "\x1ca", "~", "!x!", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", unicode_strip("t").alias("s")).collect()
    assert [r["s"] for r in rows] == [t if t is None else t.strip() for t in texts]
