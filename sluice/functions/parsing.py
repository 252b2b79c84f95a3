"""Typed parsing of governed text and the transformation rules
(P7-P12, F3-F6).  Grammar first, cast second: Spark's casts are more lenient
than the governed grammar (they trim, accept missing zones, ...)."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# The governed grammars, after digits of other scripts became ASCII.
DECIMAL_GRAMMAR = "\\A[+-]?(?:[0-9]+(?:\\.[0-9]*)?|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?\\z"
TIMESTAMP_GRAMMAR = (
    "\\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(?:\\.[0-9]+)?"
    "(?:Z|[+-][0-9]{2}:[0-9]{2})\\z"
)
#: Plain decimals that the storage type holds as they are; most values are.
PLAIN_DECIMAL = "\\A[0-9]{1,18}(?:\\.[0-9]{1,9})?\\z"
CURRENCY_GRAMMAR = "\\A[A-Z]{3}\\z"

#: Exact storage type of governed decimals: 18 integer and 9 fraction digits. A value that
#: needs more is carried beside it as (unscaled, scale), up to WIDE_DIGITS significant digits.
DECIMAL_TYPE = DecimalType(27, 9)
WIDE_DIGITS = 38
UNSCALED_TYPE = DecimalType(WIDE_DIGITS, 0)
WIDE_TYPE = "struct<unscaled:decimal(38,0),scale:int>"
#: Integral quantities up to 10 digits are multiplied as decimal(10,0), so that
#: decimal(10,0) * decimal(27,9) is exactly decimal(38,9); others as wide values.
QUANTITY_TYPE = DecimalType(10, 0)
AMOUNT_TYPE = DecimalType(38, 9)

_MINUTES_PER_DAY = 1440
#: Decimal digits of all scripts and the ASCII digits they stand for.
_DIGITS = "".join(c for c in map(chr, range(0x80, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd")
_ASCII_DIGITS = "".join(str(unicodedata.decimal(c)) for c in _DIGITS)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------- decimals
def ascii_digits(c: Column | str) -> Column:
    """The text with the decimal digits of every script as ASCII digits."""
    s = _col(c)
    return F.when(s.rlike("[^\\x00-\\x7F]"), F.translate(s, _DIGITS, _ASCII_DIGITS)).otherwise(s)


def _significant(digits: Column) -> tuple[Column, Column]:
    """Digits without zeros at either end, and the number of zeros cut at the right end."""
    whole = F.regexp_replace(digits, "\\A0+", "")
    kept = F.regexp_replace(whole, "0+\\z", "")
    return kept, F.length(whole) - F.length(kept)


def decimal_parts(c: Column | str) -> dict[str, Column]:
    """Stage-1 pieces of a decimal text (computed once per value).

    A plain value needs one pattern and one cast; only the others are taken apart."""
    s = _col(c)
    plain = s.rlike(PLAIN_DECIMAL)
    t = ascii_digits(s)
    grammar = t.rlike(DECIMAL_GRAMMAR)
    mantissa = F.regexp_extract(t, "\\A[+-]?([0-9.]*)", 1)
    digits, zeros = _significant(F.replace(mantissa, F.lit(".")))
    exp_txt = F.regexp_extract(t, "[eE]([+-]?[0-9]+)\\z", 1)
    exp = F.when(exp_txt == "", F.lit(0)).otherwise(exp_txt.try_cast("int"))
    scale = F.length(F.regexp_extract(mantissa, "\\.([0-9]*)", 1)) - zeros - exp.cast("long")
    odd = ~plain & grammar
    signed = F.concat(F.when(t.startswith("-"), F.lit("-")).otherwise(F.lit("")), digits)
    return {
        "plain": plain,
        "grammar": F.when(plain, F.lit(True)).otherwise(grammar),
        "digits": F.when(odd, F.length(digits)),
        "unscaled": F.when(odd & (F.length(digits) <= WIDE_DIGITS), F.when(digits == "", F.lit(0).cast(
            UNSCALED_TYPE)).otherwise(signed.try_cast(UNSCALED_TYPE))),
        "scale": F.when(odd, F.when(digits == "", F.lit(0)).otherwise(scale.try_cast("int"))),
        "narrow": F.when(plain, s.try_cast(DECIMAL_TYPE)).otherwise(t.try_cast(DECIMAL_TYPE)),
    }


def _narrow_fits(parts: dict[str, Column]) -> Column:
    return (parts["scale"] <= 9) & (parts["digits"] - parts["scale"] <= 18)


def decimal_error_from(parts: dict[str, Column]) -> Column:
    return (F.when(parts["plain"], F.lit(None).cast("string"))
            .when(~parts["grammar"], F.lit("invalid_decimal"))
            .when(parts["unscaled"].isNull() | parts["scale"].isNull(), F.lit("decimal_out_of_range")))


def decimal_values_from(parts: dict[str, Column]) -> tuple[Column, Column]:
    """A valid decimal as decimal(27,9), or as (unscaled, scale) if that type doesn't hold it."""
    narrow = F.when(parts["plain"] | _narrow_fits(parts), parts["narrow"])
    wide = F.when(~parts["plain"] & ~_narrow_fits(parts), F.struct(
        parts["unscaled"].alias("unscaled"), parts["scale"].alias("scale")))
    return narrow, wide.cast(WIDE_TYPE)


def decimal_error(c: Column | str) -> Column:
    """``invalid_decimal`` when the text breaks the grammar, ``decimal_out_of_range``
    when it has more than WIDE_DIGITS significant digits, else null."""
    return decimal_error_from(decimal_parts(c))


def parse_decimal(c: Column | str) -> Column:
    """Exact decimal(27,9) value of a governed decimal text; null if it is wider or invalid."""
    parts = decimal_parts(c)
    return F.when(decimal_error_from(parts).isNull(), decimal_values_from(parts)[0])


def parse_wide_decimal(c: Column | str) -> Column:
    """Exact (unscaled, scale) of any governed decimal text; null if it is invalid."""
    parts = decimal_parts(c)
    narrow, wide = decimal_values_from(parts)
    return F.when(decimal_error_from(parts).isNull(), as_wide(narrow, wide))


def as_wide(narrow: Column | str, wide: Column | str) -> Column:
    """A value held as either type as (unscaled, scale), without zeros at the end of unscaled."""
    narrow, wide = _col(narrow), _col(wide)
    text = F.replace(narrow.cast("string"), F.lit("."))
    digits, zeros = _significant(F.replace(text, F.lit("-")))
    sign = F.when(narrow < 0, F.lit("-")).otherwise(F.lit(""))
    value = F.struct(F.concat(sign, digits).try_cast(UNSCALED_TYPE).alias("unscaled"),
                     (F.lit(DECIMAL_TYPE.scale) - zeros).cast("int").alias("scale"))
    zero = F.struct(F.lit(0).cast(UNSCALED_TYPE).alias("unscaled"), F.lit(0).alias("scale"))
    return F.when(wide.isNotNull(), wide).when(narrow == 0, zero.cast(WIDE_TYPE)).when(
        narrow.isNotNull(), value.cast(WIDE_TYPE))


def wide_product(a: Column, b: Column) -> Column:
    """The exact product of two (unscaled, scale) values; null beyond WIDE_DIGITS digits."""
    unscaled = F.try_multiply(a["unscaled"], b["unscaled"]).cast(UNSCALED_TYPE)
    scale = (a["scale"].cast("long") + b["scale"]).try_cast("int")
    return F.when(unscaled.isNotNull() & scale.isNotNull(), F.struct(
        unscaled.alias("unscaled"), scale.alias("scale"))).cast(WIDE_TYPE)


def wide_compare(a: Column, b: Column) -> Column:
    """-1, 0 or 1 as a is below, equal to or above b; exact for any scales.

    Signs first, then the place of the first digit, then the digits as text; unscaled
    values have no zeros at the end, so equal numbers have equal digits."""
    text = lambda x: F.abs(x["unscaled"]).cast("string")
    place = lambda x: F.length(text(x)).cast("long") - x["scale"]
    order = lambda x, y: F.when(x < y, F.lit(-1)).when(x > y, F.lit(1)).otherwise(F.lit(0))
    sign_a, sign_b = F.signum(a["unscaled"]).cast("int"), F.signum(b["unscaled"]).cast("int")
    size = F.when(place(a) != place(b), order(place(a), place(b))).otherwise(order(text(a), text(b)))
    return F.when(sign_a != sign_b, order(sign_a, sign_b)).when(sign_a == 0, F.lit(0)).otherwise(sign_a * size)


# ------------------------------------------------------------------- timestamps
def _ts_parts(s: Column):
    rest = F.substring(s, 20, 1 << 20)
    # without a fraction the rest is the zone; the grammar is checked apart from this
    whole = ~rest.startswith(".")
    frac = F.when(whole, F.lit("")).otherwise(F.regexp_extract(rest, "\\A\\.([0-9]+)", 1))
    zone = F.when(whole, rest).otherwise(F.regexp_extract(rest, "(Z|[+-][0-9]{2}:[0-9]{2})\\z", 1))
    sign = F.when(F.substring(zone, 1, 1) == "-", F.lit(-1)).otherwise(F.lit(1))
    offset_minutes = F.when(zone == "Z", F.lit(0)).otherwise(
        sign * (F.substring(zone, 2, 2).try_cast("int") * 60
                + F.substring(zone, 5, 2).try_cast("int"))
    )
    # Fractions beyond microseconds are truncated, as the reference does.
    local = F.concat(
        F.substring(s, 1, 19),
        F.when(frac != "", F.concat(F.lit("."), F.substring(frac, 1, 6))).otherwise(F.lit("")),
        F.lit("Z"),
    )
    hh = F.substring(s, 12, 2).try_cast("int")
    mi = F.substring(s, 15, 2).try_cast("int")
    ss = F.substring(s, 18, 2).try_cast("int")
    clock_ok = (hh <= 23) & (mi <= 59) & (ss <= 59)
    return local.try_cast("timestamp"), offset_minutes, clock_ok


def timestamp_parts(c: Column | str) -> dict[str, Column]:
    """Stage-1 pieces of a timestamp text (computed once per value)."""
    s = _col(c)
    local_ts, offset, clock_ok = _ts_parts(s)
    return {
        "grammar": s.rlike(TIMESTAMP_GRAMMAR) & (F.substring(s, 1, 4) != "0000"),
        "local": local_ts,
        "offset": offset,
        "clock_ok": clock_ok,
    }


def timestamp_error_from(parts: dict[str, Column]) -> Column:
    valid = (parts["grammar"] & parts["clock_ok"] & parts["local"].isNotNull()
             & (F.abs(parts["offset"]) < _MINUTES_PER_DAY))
    return F.when(~F.coalesce(valid, F.lit(False)), F.lit("invalid_timestamp"))


def timestamp_value_from(parts: dict[str, Column]) -> Column:
    return parts["local"] - F.make_dt_interval(F.lit(0), F.lit(0), parts["offset"], F.lit(0))


def timestamp_error(c: Column | str) -> Column:
    """``invalid_timestamp`` unless the text is an ISO-8601 instant with
    seconds, an optional fraction and a ``Z``/``±HH:MM`` offset below 24 h."""
    s = _col(c)
    local_ts, offset, clock_ok = _ts_parts(s)
    valid = (
        s.rlike(TIMESTAMP_GRAMMAR)
        & (F.substring(s, 1, 4) != "0000")
        & clock_ok
        & local_ts.isNotNull()
        & (F.abs(offset) < _MINUTES_PER_DAY)
    )
    return F.when(~valid, F.lit("invalid_timestamp"))


def parse_timestamp(c: Column | str) -> Column:
    """P8 + F3: the UTC instant of a governed timestamp text, else null.

    Offsets up to ±23:59 are applied as interval arithmetic, since Spark's
    zone parser stops at ±18:00."""
    s = _col(c)
    local_ts, offset, _ = _ts_parts(s)
    return F.when(
        timestamp_error(s).isNull(),
        local_ts - F.make_dt_interval(F.lit(0), F.lit(0), offset, F.lit(0)),
    )


def timestamp_offset(c: Column | str) -> Column:
    """The source offset text (``Z`` or ``±HH:MM``), kept until canonicalisation."""
    return F.regexp_extract(_col(c), "(Z|[+-][0-9]{2}:[0-9]{2})\\z", 1)


def utc_overflow(instant: Column | str) -> Column:
    """True when converting to UTC leaves years 1-9999 (the reference then
    fails with an overflow, not a validation error)."""
    t = _col(instant)
    return (t < F.lit("0001-01-01 00:00:00").cast("timestamp")) | (
        t > F.lit("9999-12-31 23:59:59.999999").cast("timestamp"))


# --------------------------------------------------------------- constraints
def is_currency_code(c: Column | str) -> Column:
    """Three ASCII capitals."""
    return _col(c).rlike(CURRENCY_GRAMMAR)


# ------------------------------------------------------------ business rules
def integral_quantity_ok(q: Column | str, wide: Column | None = None) -> Column:
    """the quantity is an exact integer (``2.0`` yes, ``1.5`` no)."""
    q = _col(q)
    narrow = q == F.floor(q)
    return narrow if wide is None else F.coalesce(narrow, wide["scale"] <= 0)


def to_quantity(q: Column | str) -> Column:
    """integral quantity as a long; null when it does not fit (it is wide then)."""
    return _col(q).try_cast("long")


def line_amount(quantity: Column | str, unit_price: Column | str) -> Column:
    """exact ``quantity * unit_price`` as decimal(38,9), no rounding; null when a wider
    type is needed (:func:`wide_line_amount`)."""
    return (_col(quantity).try_cast(QUANTITY_TYPE) * _col(unit_price).cast(DECIMAL_TYPE)).cast(AMOUNT_TYPE)


def wide_line_amount(quantity: Column, unit_price: Column, price_wide: Column) -> Column:
    """the same as (unscaled, scale) where decimal(38,9) doesn't hold it; null beyond
    WIDE_DIGITS digits or where :func:`line_amount` is not null."""
    q = F.struct(quantity.cast(UNSCALED_TYPE).alias("unscaled"), F.lit(0).alias("scale"))
    product = wide_product(as_wide(unit_price, price_wide), q)
    return F.when(price_wide.isNotNull() | quantity.try_cast(QUANTITY_TYPE).isNull(), product)


def monetary_consistent(list_price: Column | str, unit_cost: Column | str,
                        currency: Column | str) -> Column:
    """currency present exactly when a price or a cost is present."""
    has_money = _col(list_price).isNotNull() | _col(unit_cost).isNotNull()
    return has_money == _col(currency).isNotNull()
