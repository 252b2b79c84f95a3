"""Contract validation.

``validate_rows`` turns raw string rows into typed columns plus an ordered
error array; ``first_failure_per_file`` and ``file_atomic`` give the
file-level outcome: the first bad row (then the first bad field in contract
order) rejects the whole file, and no partial result survives."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.parsing import (
    decimal_error_from,
    decimal_parts,
    decimal_values_from,
    timestamp_error_from,
    timestamp_parts,
    timestamp_value_from,
    is_currency_code,
    timestamp_offset,
)
from sluice.operators.contracts import (
    DECIMAL,
    NON_NEGATIVE,
    POSITIVE,
    STRING,
    TIMESTAMP,
    TIMEZONE_AWARE,
    UPPERCASE_CURRENCY_CODE,
    Contract,
    Field,
)
from sluice.operators.skew import spread_join

# Validation failure categories, in the order used to pack the
# (row, field, category) key of the first failure.
CATEGORIES = (
    "non_nullable_empty", "invalid_decimal", "decimal_out_of_range",
    "invalid_timestamp", "non_negative", "positive", "uppercase_currency_code",
    "timezone_aware",
)
#: Ending of the column with a decimal field's wide values.
WIDE = "_wide"
ERROR_TYPE = "array<struct<field_ordinal:int,field_name:string,category:string>>"
PROVENANCE_COLUMNS = ("contract_id", "contract_version", "source_identifier",
                      "content_sha256", "source_id", "row_number")


def _constraint_ok(constraint: str, value: Column, wide: Column | None = None) -> Column:
    if constraint in (NON_NEGATIVE, POSITIVE):
        sign = value if wide is None else F.coalesce(F.signum(value), F.signum(wide["unscaled"]))
        return sign >= 0 if constraint == NON_NEGATIVE else sign > 0
    if constraint == UPPERCASE_CURRENCY_CODE:
        return is_currency_code(value)
    if constraint == TIMEZONE_AWARE:
        # The grammar already demands an offset; a parsed value is aware.
        return value.isNotNull()
    raise ValueError(constraint)


def _stage_one(f: Field, i: int) -> dict[str, Column]:
    """Parse pieces of one field, named ``_<i>_<piece>``."""
    raw = F.col(f.name)
    if f.type == DECIMAL:
        parts = decimal_parts(raw)
    elif f.type == TIMESTAMP:
        parts = timestamp_parts(raw)
    else:
        parts = {}
    return {f"_{i}_{k}": v for k, v in parts.items()}


def _stage_two(f: Field, i: int) -> tuple[Column, Column | None, Column]:
    """(typed value, wide decimal or None, first error category) of one field from its pieces."""
    raw = F.col(f.name)
    empty = raw.isNull() | (raw == "")
    parts = {k: F.col(f"_{i}_{k}") for k in ("plain", "grammar", "digits", "unscaled", "scale", "narrow",
                                              "local", "offset", "clock_ok")}
    wide = None
    if f.type == DECIMAL:
        type_err = decimal_error_from(parts)
        parsed, wide = (F.when(type_err.isNull(), x) for x in decimal_values_from(parts))
        wide = F.when(~empty, wide)
    elif f.type == TIMESTAMP:
        type_err = timestamp_error_from(parts)
        parsed = F.when(type_err.isNull(), timestamp_value_from(parts))
    elif f.type == STRING:
        type_err, parsed = None, raw                      # P6: kept byte-exact
    else:
        raise ValueError(f.type)
    value = F.when(~empty, parsed)
    err = F.when(empty, F.lit(None if f.nullable else "non_nullable_empty"))
    if type_err is not None:
        err = err.when(type_err.isNotNull(), type_err)
    for c in f.constraints:
        err = err.when(~_constraint_ok(c, value, wide), F.lit(c.lower()))
    return value, wide, err.cast("string")


def validate_rows(raw: DataFrame, contract: Contract,
                  keep: tuple[str, ...] | None = None) -> DataFrame:
    """P13 + P17: typed projection with provenance and an ordered error array.

    ``raw`` holds one string column per contract field (any order) plus the
    provenance columns.  Timestamp fields also keep their source offset in
    ``<name>_offset``, decimals that decimal(27,9) doesn't hold are in ``<name>_wide``.  Output columns: provenance, typed fields, ``errors``,
    ``first_error``.

    Three projections (parse pieces -> values and categories -> error array)
    keep every parse expression evaluated once per value and the generated
    code small."""
    keep = tuple(c for c in (keep or PROVENANCE_COLUMNS) if c in raw.columns)
    names = contract.header_names
    stage1 = {}
    for i, f in enumerate(contract.fields, start=1):
        stage1.update(_stage_one(f, i))
    s1 = raw.select(*keep, *names, *[v.alias(k) for k, v in stage1.items()])
    typed, errs = [], []
    for i, f in enumerate(contract.fields, start=1):
        value, wide, err = _stage_two(f, i)
        typed.append(value.alias(f.name))
        if wide is not None:
            typed.append(wide.alias(f.name + WIDE))
        errs.append(err.alias(f"_err_{i}"))
        if f.type == TIMESTAMP:
            typed.append(F.when(F.col(f.name) != "", timestamp_offset(F.col(f.name)))
                         .alias(f.name + "_offset"))
    s2 = s1.select(*keep, *typed, *errs)
    items = [F.when(F.col(f"_err_{i}").isNotNull(), F.struct(
        F.lit(i).alias("field_ordinal"), F.lit(f.name).alias("field_name"),
        F.col(f"_err_{i}").alias("category")))
        for i, f in enumerate(contract.fields, start=1)]
    errors = F.array_compact(F.array(*items)).cast(ERROR_TYPE)
    out_cols = [c for c in s2.columns if not c.startswith("_err_")]
    return s2.select(*out_cols, errors.alias("errors")).withColumn(
        "first_error", F.get(F.col("errors"), 0))


def _category_index(cat: Column) -> Column:
    expr = None
    for i, c in enumerate(CATEGORIES):
        expr = F.when(cat == c, F.lit(i)) if expr is None else expr.when(cat == c, F.lit(i))
    return expr


_FIELD_BITS, _CATEGORY_BITS = 9, 5


def failure_key(contract: Contract) -> Column:
    """The row's first failure as (row, field, category) in one decimal, null if it has none.

    The least key of a file names its first failure, so finding it is a plain partial +
    final hash aggregate (no sort, no per-file collection), also when one file is huge."""
    if len(contract.fields) >= 1 << _FIELD_BITS or len(CATEGORIES) > 1 << _CATEGORY_BITS:
        raise ValueError("too many fields or categories to pack")
    first = F.col("first_error")
    shift = 1 << (_FIELD_BITS + _CATEGORY_BITS)
    detail = (F.shiftleft(first["field_ordinal"], _CATEGORY_BITS) + _category_index(first["category"]))
    packed = F.col("row_number").cast("decimal(19,0)") * F.lit(shift).cast("decimal(6,0)") + detail
    return F.when(first.isNotNull(), packed.cast("decimal(30,0)"))


def failure_of_key(key: str, contract: Contract) -> list[Column]:
    """failure_category, row_number and field_name of a key by :func:`failure_key`."""
    shift = 1 << (_FIELD_BITS + _CATEGORY_BITS)
    row = F.expr(f"{key} div {shift}").cast("long")
    detail = (F.col(key) % F.lit(shift)).cast("int")
    ordinal = F.shiftright(detail, _CATEGORY_BITS)
    cat_idx = detail.bitwiseAND(F.lit((1 << _CATEGORY_BITS) - 1))
    field_name = None
    for i, f in enumerate(contract.fields, start=1):
        field_name = (F.when(ordinal == i, F.lit(f.name)) if field_name is None
                      else field_name.when(ordinal == i, F.lit(f.name)))
    category = F.get(F.array(*[F.lit(c) for c in CATEGORIES]), cat_idx)
    return [category.alias("failure_category"), row.alias("row_number"), field_name.alias("field_name")]


def first_failure_per_file(validated: DataFrame, contract: Contract,
                           file_cols: str | Sequence[str] = "source_id") -> DataFrame:
    """P14 + O6: the first failing row and, in it, the first failing field (see :func:`failure_key`).

    Of rows, or of states that carry the least ``failure_key`` of many rows."""
    files = [file_cols] if isinstance(file_cols, str) else list(file_cols)
    # rows without a failure have no key; a filter on them would be pushed into the parsing
    key = F.col("failure_key") if "failure_key" in validated.columns else failure_key(contract)
    agg = validated.groupBy(*files).agg(F.min(key).alias("_k")).where("_k is not null")
    return agg.select(*files, *failure_of_key("_k", contract))


def file_atomic(validated: DataFrame, failures: DataFrame,
                file_col: str = "source_id", few: bool = False) -> DataFrame:
    """Rows of files without any failure.

    An anti join on the file and a bucket of the row, so that the rows of one
    hot file are dealt to many tasks (see :func:`spread_join`)."""
    return spread_join(validated, failures.select(file_col), file_col, "left_anti", few=few)


def check_headers(files: DataFrame, contract: Contract,
                  headers_col: str = "headers") -> DataFrame:
    """P2 + U1 + O5: sorted missing and unexpected header lists (case-sensitive)."""
    expected = F.array(*[F.lit(n) for n in contract.header_names])
    h = F.col(headers_col)
    missing = F.array_sort(F.array_except(expected, h))
    unexpected = F.array_sort(F.array_except(h, expected))
    return files.withColumn("missing_headers", missing).withColumn(
        "unexpected_headers", unexpected).withColumn(
        "header_mismatch", (F.size(missing) > 0) | (F.size(unexpected) > 0))


def header_uniqueness(files: DataFrame, headers_col: str = "headers") -> DataFrame:
    """A10: headers of one file are distinct and non-empty."""
    h = F.col(headers_col)
    return files.withColumn(
        "headers_ok",
        (F.size(F.array_distinct(h)) == F.size(h))
        & ~F.exists(h, lambda x: x == ""))


def check_has_rows(files: DataFrame, rows: DataFrame,
                   file_col: str = "source_id") -> DataFrame:
    """Per-file data-record count; 0 means ``no_data_records``."""
    counts = rows.groupBy(file_col).agg(F.count(F.lit(1)).alias("data_row_count"))
    return files.join(counts, file_col, "left").withColumn(
        "data_row_count", F.coalesce(F.col("data_row_count"), F.lit(0)).cast("long"))


def project_by_name(rows: DataFrame, contract: Contract,
                    headers_col: str = "headers", vals_col: str = "vals") -> DataFrame:
    """Pick each contract field from the parsed values by header name."""
    h, v = F.col(headers_col), F.col(vals_col)
    keep = [c for c in rows.columns if c not in (headers_col, vals_col)]
    picked = [F.get(v, F.array_position(h, f.name).cast("int") - 1).alias(f.name)
              for f in contract.fields]
    return rows.select(*keep, *picked)


def file_status(parsed_files: DataFrame, contract: Contract) -> DataFrame:
    """P16 (file part): structural failure, header mismatch or no data
    records, in that precedence, for ``kind = 'file'`` rows of the parser."""
    checked = check_headers(parsed_files.withColumn(
        "_h", F.coalesce(F.col("headers"), F.array().cast("array<string>"))), contract, "_h")
    category = (
        F.when(F.col("failure_category").isNotNull(), F.col("failure_category"))
        .when(F.col("header_mismatch"), F.lit("header_mismatch"))
        .when(F.col("data_row_count") == 0, F.lit("no_data_records"))
    )
    return checked.withColumn("file_failure", category).drop("_h")
