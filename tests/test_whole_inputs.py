"""Registered queries hand every row of their tables to the operator."""

import pytest

from sluice.plans import more_queries as M

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("query, operator, place, key", [
    (M._has_rows_q, "check_has_rows", 1, "l_partkey"), (M._select_q, "select_sources", 1, "l_suppkey")])
def test_no_row_is_left_out(spark, monkeypatch, query, operator, place, key):
    seen, plain = [], getattr(M, operator)
    monkeypatch.setattr(M, operator, lambda *a: seen.append(a[place]) or plain(*a))
    query(spark, SF)
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_returnflag = 'R'").select(key)
    assert seen[0].count() == (lines if operator == "check_has_rows" else lines.distinct()).count()


@pytest.mark.parametrize("query, operator, places", [
    ("_ledger_q", "audit_ledger", (0, 1)), ("_write_history_q", "H.read_history", (2,))])
def test_every_row_reaches_the_operator(spark, monkeypatch, query, operator, places):
    seen = []
    home, name = (M.H, "read_history") if operator.startswith("H.") else (M, operator)
    plain = getattr(home, name)
    monkeypatch.setattr(home, name, lambda *a: seen.append(a) or plain(*a))
    getattr(M, query)(spark, SF)
    part = spark.read.parquet(f"{SF}/part.parquet")
    expect = part.count() if operator == "audit_ledger" else 1 + part.selectExpr("p_partkey div 100").distinct().count()
    for place in places:
        assert seen[0][place].count() == expect


def test_every_store_is_registered(spark):
    from sluice.sources.relational import registered_stores
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").where("l_returnflag = 'R'").select("l_suppkey").distinct()
    assert registered_stores(spark, SF).count() == lines.count()
