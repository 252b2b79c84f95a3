"""Scalar rules (F1-F19, P5-P12) on the reference's literal cases."""

import random
from decimal import Context, Decimal

import pytest
from pyspark.sql import functions as F

from sluice.functions import parsing as P
from sluice.functions import text as T
from sluice.functions import domain as D


def one(spark, expr, value, schema="x string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("value", ["1", "10.50", "0", "1E+2", "-3", ".5", "5.", "1e-3"])
def test_decimal_valid(spark, value):
    assert one(spark, P.decimal_error(F.col("x")), value) is None
    assert one(spark, P.parse_decimal(F.col("x")), value) == Decimal(value)


@pytest.mark.parametrize("value", ["bad", " 1", "1 ", "1,5", "1_000", "NaN", "-NaN", "Infinity", "Inf", "", "١,٢", "一"])
def test_decimal_invalid(spark, value):
    assert one(spark, P.decimal_error(F.col("x")), value) == "invalid_decimal"


@pytest.mark.parametrize("value", ["1" * 39, "0." + "1" * 39, "1e99999999999", "-" + "9" * 39 + "E-5"])
def test_decimal_out_of_range(spark, value):
    assert one(spark, P.decimal_error(F.col("x")), value) == "decimal_out_of_range"


WIDE = ["1.0000000001", "1e-25", "1E+400", "1234567890123456789", "9" * 38, "-0." + "0" * 30 + "12", "1" * 30, "1" * 30 + "0" * 20,
        "١٢.٥", "१e٣", "０.５", "𝟙𝟚", "000.000", "-0", "5.", "24.990", "1E+2", "99999999999999999999.000000001"]


def test_wide_decimals_are_exact(spark):
    df = spark.createDataFrame([(v,) for v in WIDE], "x string")
    for r in df.select("x", P.decimal_error("x").alias("e"), P.parse_decimal("x").alias("n"), P.parse_wide_decimal("x").alias("w")).collect():
        value = Decimal(r["x"])
        assert r["e"] is None
        assert Decimal(r["w"]["unscaled"]).scaleb(-r["w"]["scale"], Context(prec=60)) == value, r["x"]
        assert r["n"] in (None, value)
        assert (r["n"] is None) == (abs(value) >= 10**18 or bool(value) and value.normalize(Context(prec=60)).as_tuple().exponent < -9)


def test_wide_comparison_and_product(spark):
    rng = random.Random(4)
    texts = WIDE + [f"{rng.choice(['', '-'])}{rng.randrange(10 ** rng.randrange(1, 25))}E{rng.randrange(-40, 40)}" for _ in range(60)]
    df = spark.createDataFrame([(a, rng.choice(texts)) for a in texts for _ in range(4)], "a string, b string")
    a, b = P.parse_wide_decimal("a"), P.parse_wide_decimal("b")
    df = df.select("a", "b", a.alias("x"), b.alias("y")).select(
        "a", "b", P.wide_compare(F.col("x"), F.col("y")).alias("c"), P.wide_product(F.col("x"), F.col("y")).alias("p"))
    for r in df.collect():
        x, y = Decimal(r["a"]), Decimal(r["b"])
        assert r["c"] == (x > y) - (x < y), (r["a"], r["b"])
        product = Context(prec=120).multiply(x, y)
        if r["p"] is None:
            assert len(product.normalize(Context(prec=120)).as_tuple().digits) > 37
        else:
            assert Decimal(r["p"]["unscaled"]).scaleb(-r["p"]["scale"], Context(prec=120)) == product


def test_wide_prices_reach_the_amount(spark):
    from sluice.operators.canonical import canonicalize
    from sluice.operators.contracts import ECOMMERCE_SALES_V1 as E
    from sluice.operators.validate import validate_rows
    values = [("2", "0.1234567890123"), ("12345678901", "2.5"), ("3", "1" * 30), ("2.0", "1E+20"), ("9" * 18, "9" * 30), ("1.5", "1e-12"),
              ("1e-12", "1"), ("9" * 25, "1"), ("7", "-0.00000000001")]
    raw = spark.createDataFrame(
        [("f", i, "W-1", "2026-08-01T10:15:00Z", None, "S", q, p, "EUR") for i, (q, p) in enumerate(values)],
        "source_id string, row_number long, order_number string, order_timestamp string, customer_email string, sku string, "
        "quantity string, unit_price string, currency_code string")
    rows = {r["row_number"]: r["first_error"] for r in validate_rows(raw, E).collect()}
    assert [rows[i] and rows[i]["category"] for i in range(9)] == [None] * 8 + ["non_negative"]
    got = {r["row_number"]: r for r in canonicalize(validate_rows(raw, E), E, "r").collect()}
    for i in (0, 1, 2, 3):
        amount, wide = got[i]["line_amount"], got[i]["line_amount_wide"]
        value = amount if wide is None else Decimal(wide["unscaled"]).scaleb(-wide["scale"], Context(prec=60))
        assert got[i]["status"] == "SUCCESS" and value == Context(prec=60).multiply(*map(Decimal, values[i]))
    assert [got[i]["status"] for i in (4, 5, 6, 7)] == [
        "UNTRANSFORMABLE", "BUSINESS_RULE_REJECTED", "BUSINESS_RULE_REJECTED", "UNTRANSFORMABLE"]


def test_decimal_trailing_zeros_are_exact(spark):
    assert one(spark, P.decimal_error(F.col("x")), "1." + "0" * 25) is None


@pytest.mark.parametrize("value,utc", [
    ("2026-08-01T10:15:00Z", "2026-08-01 10:15:00"),
    ("2026-08-01T10:15:00+00:00", "2026-08-01 10:15:00"),
    ("2026-08-01T10:15:00+02:00", "2026-08-01 08:15:00"),
    ("2026-08-01T10:15:00-05:00", "2026-08-01 15:15:00"),
    ("2026-08-01T10:15:00.123+02:00", "2026-08-01 08:15:00.123"),
    ("2026-08-01T10:30:00+03:00", "2026-08-01 07:30:00"),
    ("2026-08-01T10:30:00-05:00", "2026-08-01 15:30:00"),
    ("2026-08-01T10:15:00+23:59", "2026-07-31 10:16:00"),
    ("2026-08-01T10:15:00.1234567Z", "2026-08-01 10:15:00.123456"),
])
def test_timestamp_valid(spark, value, utc):
    assert one(spark, P.timestamp_error(F.col("x")), value) is None
    got = one(spark, F.date_format(P.parse_timestamp(F.col("x")), "yyyy-MM-dd HH:mm:ss.SSSSSS"), value)
    assert got.rstrip("0").rstrip(".") == utc.rstrip("0").rstrip(".") or got.startswith(utc)


@pytest.mark.parametrize("value", [
    "2026-08-01T10:15:00", "2026-08-01X10:15:00Z", "2026-08-01,10:15:00Z", "2026-02-30T10:00:00Z",
    "0000-01-01T00:00:00Z", "2026-08-01T24:00:00Z", "2026-08-01T23:59:60Z", "2026-08-01T10:15:00+24:00",
    "2026-08-01 10:15:00Z", "2026-08-01T10:15Z"])
def test_timestamp_invalid(spark, value):
    assert one(spark, P.timestamp_error(F.col("x")), value) == "invalid_timestamp"


@pytest.mark.parametrize("value,ok", [("EUR", True), ("eur", False), ("EU", False), ("EURO", False),
                                      ("ÉUR", False), ("EUR\n", False)])
def test_currency(spark, value, ok):
    assert one(spark, P.is_currency_code(F.col("x")), value) is ok


def test_strip_and_blank(spark):
    assert one(spark, T.normalize_identifier(F.col("x")), "  Ab C-1  ") == "Ab C-1"
    for blank in ["", " ", "\t\r\n", "  ", "\x1c\x1f"]:
        assert one(spark, T.normalize_identifier(F.col("x")), blank) is None
        assert one(spark, T.non_blank(F.col("x")), blank) is False
    # SQL CHECK flavour: spaces only
    assert one(spark, T.btrim_blank(F.col("x")), "\t") is False
    assert one(spark, T.btrim_blank(F.col("x")), "   ") is True


def test_integral_quantity(spark):
    df = spark.createDataFrame([(Decimal(v),) for v in ["1", "2.0", "3.000", "1.5", "0.25"]],
                               "q decimal(27,9)")
    got = [r["ok"] for r in df.select(P.integral_quantity_ok("q").alias("ok")).collect()]
    assert got == [True, True, True, False, False]


def test_line_amount_exact(spark):
    df = spark.createDataFrame([(Decimal(3), Decimal("1.2345"))], "q decimal(10,0), p decimal(27,9)")
    assert df.select(P.line_amount("q", "p").alias("a")).first()["a"] == Decimal("3.7035")


@pytest.mark.parametrize("lp,uc,cur,ok", [
    ("1", None, "EUR", True), (None, "1", "EUR", True), ("1", "1", "EUR", True), (None, None, None, True),
    (None, None, "EUR", False), ("1", None, None, False), (None, "1", None, False)])
def test_monetary_rule(spark, lp, uc, cur, ok):
    df = spark.createDataFrame([(lp, uc, cur)], "lp string, uc string, cur string")
    assert df.select(P.monetary_consistent("lp", "uc", "cur").alias("r")).first()["r"] is ok


def test_patterns(spark):
    assert one(spark, T.is_sha256(F.col("x")), "a" * 64) is True
    assert one(spark, T.is_sha256(F.col("x")), "A" * 64) is False
    assert one(spark, T.is_failure_code(F.col("x")), "INGESTION_ERROR") is True
    assert one(spark, T.is_failure_code(F.col("x")), "bad code") is False
    for good in ["a.csv", "x/y.csv"]:
        assert one(spark, T.is_relative_path(F.col("x")), good) is True
    for bad in ["", ".", "/abs.csv", "C:x.csv", "a\\b.csv", "../x.csv", "a/./b.csv", "a//b.csv"]:
        assert one(spark, T.is_relative_path(F.col("x")), bad) is False


def test_domain_scalars(spark):
    assert one(spark, D.exit_status(F.col("x")), "SUCCEEDED") == 0
    assert one(spark, D.exit_status(F.col("x")), "BLOCKED") == 3
    assert one(spark, D.exit_status(F.col("x")), "FAILED") == 1
    assert one(spark, D.customer_state(F.col("x")), None) == "ABSENT"
    assert one(spark, D.customer_state(F.col("x")), "a@b") == "UNRESOLVED_SOURCE_REFERENCE"
    ok, ver, name = D.parse_versioned_name(F.col("x"))
    assert one(spark, F.struct(ok, ver, name), "V002__create_core.sql") == (True, 2, "create_core")
    assert one(spark, ok, "V2__x.sql") is False


def test_durations(spark):
    df = spark.createDataFrame([("2026-08-01 10:00:00", "2026-08-01 10:07:30"), ("2026-08-01 10:00:00", None)],
                               "s string, c string").select(F.col("s").cast("timestamp").alias("s"),
                                                            F.col("c").cast("timestamp").alias("c"))
    got = [r["d"] for r in df.select(D.duration_micros("s", "c").alias("d")).collect()]
    assert got == [450_000_000, None]
