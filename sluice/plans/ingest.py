"""Ingestion composition and per-file verdicts.

The reference drives one file through three stages; here every stage is one
lazy DataFrame over all files and the verdict is one row per file, computed
from per-file aggregates joined on ``source_id``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.operators.canonical import (
    ABORT_BLANK,
    ABORT_OVERFLOW,
    SUCCESS,
    abort_key,
    abort_of_key,
    batch_counts_of,
    canonicalize,
    failed_outcome,
    mapped_states,
    successful_records,
)
from sluice.operators.compare import multiset_difference
from sluice.operators.contracts import Contract
from sluice.operators.quality import (
    PRODUCT_SKU_UNIQUENESS,
    SALES_TRANSACTION_CURRENCY,
    evaluate_quality,
    quality_verdict,
)
from sluice.operators.skew import FEW_FILES, spread_join
from sluice.operators.validate import (
    failure_key,
    failure_of_key,
    file_atomic,
    first_failure_per_file,
    validate_rows,
)
from sluice.session import ensure_checkpoint_dir

STAGES = (("INGESTION", 1), ("TRANSFORMATION", 2), ("DATA_QUALITY", 3))
STAGE_TYPE = ("array<struct<stage:string,stage_sequence:int,state:string,"
              "failure_category:string,failure_code:string>>")


@dataclass
class Ingested:
    """All intermediate frames of one contract's run (each one lazy)."""

    contract: Contract
    validated: DataFrame
    ingestion_failures: DataFrame
    accepted: DataFrame
    outcomes: DataFrame
    counts: DataFrame
    records: DataFrame          # successful canonical records of clean files
    quality: DataFrame          # quality outcomes of clean files
    files: DataFrame

    def release(self) -> None:
        """Nothing is held but one row per file, which Spark drops with its checkpoint."""


def source_files(raw: DataFrame) -> DataFrame:
    """One row per source file present in the raw rows."""
    # The other columns depend on source_id; grouping on them keeps the
    # aggregate a hash aggregate (no string buffers).
    return raw.groupBy("source_id", "source_identifier", "contract_id", "contract_version").agg(
        F.count(F.lit(1)).alias("raw_row_count"))


def expectations_for(contract: Contract):
    return [PRODUCT_SKU_UNIQUENESS] if contract.kind == "product" else [SALES_TRANSACTION_CURRENCY]


def without_emails(validated: DataFrame) -> DataFrame:
    """The validated rows with a mark in place of an e-mail address: only its presence
    is used from here on, so the address itself is never stored."""
    if "customer_email" not in validated.columns:
        return validated
    return validated.withColumn("customer_email", F.when(F.col("customer_email").isNotNull(), F.lit("*")))


def ingest_rows(raw: DataFrame, contract: Contract, run_id: str | None = None,
                file_failures: DataFrame | None = None, expectations=None) -> Ingested:
    """Validate -> first failure -> file atomicity -> canonicalise ->
    counts -> quality, for every file of one contract at once.

    ``file_failures`` (source_id, failure_category) adds structural failures
    found by the CSV parser; they take precedence over field errors.
    ``expectations`` replaces the built-in one of the contract's kind (E1)."""
    # Validated rows are wide and never stored: a first pass leaves one row of states per file, and
    # each later step reads the source again, with only the columns that it needs.
    validated = without_emails(validate_rows(raw, contract))
    states, few = file_states(validated, contract)
    small = F.broadcast if few else (lambda df: df)
    few = few and file_failures is None  # files without rows are in no states
    failures = first_failure_per_file(states, contract)
    if file_failures is not None:
        structural = file_failures.select("source_id", "failure_category")
        failures = structural.unionByName(
            failures.join(structural.select("source_id"), "source_id", "left_anti"),
            allowMissingColumns=True)
    accepted = file_atomic(validated, failures, few=few)
    outcomes = canonicalize(accepted, contract, run_id)
    counts = small(batch_counts_of(states.join(failures.select("source_id"), "source_id", "left_anti")))
    clean = counts.where((F.col("failure_count") == 0) & F.col("abort_kind").isNull())
    records = spread_join(successful_records(outcomes), clean.select("source_id"), "source_id", "left_semi", few=few)
    quality = evaluate_quality(records, expectations or expectations_for(contract))
    files = states.select("source_id", "source_identifier", "contract_id", "contract_version",
                          F.col("record_count").alias("raw_row_count"))
    return Ingested(contract, validated, small(failures) if few else failures, accepted, outcomes, counts, records,
                    quality, small(files))


FILE_COLUMNS = ("source_id", "source_identifier", "contract_id", "contract_version")


def file_states(validated: DataFrame, contract: Contract) -> tuple[DataFrame, bool]:
    """One stored row of states per file, and whether they are few enough to be broadcast."""
    ensure_checkpoint_dir(validated.sparkSession)
    rows = validated.withColumn("failure_key", failure_key(contract))
    states = mapped_states(rows, contract, FILE_COLUMNS).checkpoint()
    return states, states.count() <= FEW_FILES


def _stage_array(failed_stage: Column, state: Column, category: Column, code: Column) -> Column:
    items = []
    for name, seq in STAGES:
        st = (
            F.when(state.isin("SUCCEEDED", "BLOCKED"), F.lit("SUCCEEDED"))
            .when(failed_stage.isNull(), F.lit("SKIPPED"))
            .when(F.lit(seq) < failed_stage, F.lit("SUCCEEDED"))
            .when(F.lit(seq) == failed_stage, F.lit("FAILED"))
            .otherwise(F.lit("SKIPPED"))
        )
        failed_here = (state == "FAILED") & (failed_stage == seq)
        items.append(F.struct(
            F.lit(name).alias("stage"), F.lit(seq).alias("stage_sequence"), st.alias("state"),
            F.when(failed_here, category).alias("failure_category"),
            F.when(failed_here, code).alias("failure_code")))
    return F.array(*items).cast(STAGE_TYPE)


def file_verdicts(files: DataFrame, ingestion_failures: DataFrame, counts: DataFrame,
                  quality: DataFrame, supported: Column | None = None) -> DataFrame:
    """K1 + K2: state, failure category/code and the three stage states per
    file, first matching rule wins (see README)."""
    qv = quality_verdict(quality)
    f = (
        files.join(ingestion_failures.select("source_id", F.col("failure_category").alias("_ing")),
                   "source_id", "left")
        .join(counts.select("source_id", "failure_count", F.col("abort_kind").alias("_abort")),
              "source_id", "left")
        .join(qv, "source_id", "left")
    )
    sup = supported if supported is not None else (
        F.col("supported") if "supported" in files.columns else F.lit(True))
    return _verdicts(f, sup)


def _verdicts(f: DataFrame, sup: Column) -> DataFrame:
    """The verdict of files with ``_ing``, ``_abort``, ``failure_count`` and the quality flags."""
    rules = [
        (~sup, None, "CONFIGURATION_FAILURE", "CONFIGURATION_ERROR", "FAILED"),
        (F.col("_ing").isNotNull(), 1, "INGESTION_FAILURE", "INGESTION_ERROR", "FAILED"),
        (F.col("_abort") == ABORT_BLANK, 2, "CONFIGURATION_FAILURE", "CONFIGURATION_ERROR", "FAILED"),
        (F.col("_abort") == ABORT_OVERFLOW, 2, "UNEXPECTED_EXECUTION_FAILURE",
         "UNEXPECTED_EXECUTION_ERROR", "FAILED"),
        (F.col("failure_count") > 0, 2, "TRANSFORMATION_FAILURE",
         "TRANSFORMATION_UNSUCCESSFUL_OUTCOME", "FAILED"),
        (F.coalesce(F.col("any_evaluation_error"), F.lit(False)), 3,
         "DATA_QUALITY_EVALUATION_FAILURE", "DATA_QUALITY_EVALUATION_ERROR", "FAILED"),
        (F.coalesce(F.col("any_blocking_violation"), F.lit(False)), None, None, None, "BLOCKED"),
    ]

    def chain(pick):
        expr = None
        for r in rules:
            val = F.lit(pick(r))
            expr = F.when(r[0], val) if expr is None else expr.when(r[0], val)
        return expr

    state = chain(lambda r: r[4]).otherwise(F.lit("SUCCEEDED"))
    stage = chain(lambda r: r[1]).cast("int")
    category = chain(lambda r: r[2]).cast("string")
    code = chain(lambda r: r[3]).cast("string")
    out = f.select("source_id", "source_identifier", "contract_id", "contract_version",
                   state.alias("state"), category.alias("failure_category"),
                   code.alias("failure_code"), stage.alias("failed_stage"))
    return out.withColumn("stages", _stage_array(
        F.col("failed_stage"), F.col("state"), F.col("failure_category"), F.col("failure_code")))


def one_pass_verdicts(raw: DataFrame, contract: Contract) -> DataFrame:
    """K1 + K2 for every file of one contract, with the built-in expectation of its kind.

    All that a verdict needs is a state per file that merges: the least failure key, the
    least abort key, the number of failed outcomes, and whether a SKU occurs twice or a
    transaction has two currencies. Rows are validated and mapped in one projection without
    waiting for their file's outcome: where a file has failures, the later
    states are not looked at, and where it has none, every row is accepted. One aggregate by
    (file, SKU or transaction) and one of its few rows by file replace the joins."""
    rows = validate_rows(raw, contract).withColumn("failure_key", failure_key(contract))
    outcomes = canonicalize(rows, contract, "verdict")
    files = ["source_id", "source_identifier", "contract_id", "contract_version"]
    done = F.col("status") == SUCCESS
    states = [F.min("failure_key").alias("_fail"), F.min(abort_key()).alias("_ab"),
              F.count_if(failed_outcome()).alias("failure_count")]
    if contract.kind == "product":
        key, states = "sku", [*states, F.count_if(done).alias("_low"), F.lit(1).alias("_high")]
        bad = F.col("_low") > 1
    else:
        # accepted currencies are three capitals, so their bytes are a number
        c = F.col("currency_code")
        number = F.when(done, F.ascii(F.substring(c, 1, 1)) * 65536 + F.ascii(F.substring(c, 2, 1)) * 256
                        + F.ascii(F.substring(c, 3, 1)))
        key, states = "source_transaction_number", [*states, F.min(number).alias("_low"), F.max(number).alias("_high")]
        bad = F.col("_low") < F.col("_high")
    # Nearly every key is new to a task; rows are dealt first, so that no task holds more keys
    # than its own part has.
    per_key = outcomes.repartition("source_id", key).groupBy(*files, key).agg(*states)
    per_file = per_key.groupBy(*files).agg(
        F.min("_fail").alias("_fail"), F.min("_ab").alias("_ab"), F.sum("failure_count").alias("failure_count"),
        F.bool_or(F.col(key).isNotNull() & bad).alias("any_blocking_violation"))
    return _verdicts(per_file.select(
        *files, failure_of_key("_fail", contract)[0].alias("_ing"), abort_of_key(F.col("_ab")).alias("_abort"),
        "failure_count", F.lit(False).alias("any_evaluation_error"), "any_blocking_violation"), F.lit(True))


def verdicts_for(ing: Ingested) -> DataFrame:
    return file_verdicts(ing.files, ing.ingestion_failures, ing.counts, ing.quality)


def verdicts_for_requests(spark, root: str, requests: DataFrame, registry=None,
                          run_id: str | None = None) -> DataFrame:
    """P16 + K1 for requested contracts (``contract_id``, ``contract_version``).

    One verdict per file of every supported contract, one for each contract
    directory that cannot be listed, and one for each unsupported request. The
    requests are joined with the registry; the loop is over registered contracts."""
    from sluice.operators.contracts import BUILT_IN_REGISTRY, resolve_contract
    from sluice.sources.files import discovery_failures, source_identity

    reg = registry or BUILT_IN_REGISTRY
    asked = resolve_contract(requests.select("contract_id", "contract_version").distinct(), reg)
    wanted = asked.where("resolution = 'RESOLVED'").select("contract_id", "contract_version")
    parts = [verdicts_for(ingest_files(spark, root, c, reg, run_id)) for c in reg.contracts.values()]
    verdicts = parts[0]
    for more in parts[1:]:
        verdicts = verdicts.unionByName(more)
    none = spark.createDataFrame([], "source_id string, failure_category string")
    counts = spark.createDataFrame([], "source_id string, failure_count long, abort_kind string")
    outcomes = spark.createDataFrame([], "source_id string, status string, disposition string")
    lost = discovery_failures(spark, root, reg)
    lost = file_verdicts(lost, lost.select("source_id", "failure_category"), counts, outcomes)
    unknown = asked.where("resolution <> 'RESOLVED'").select(
        F.lit(None).cast("string").alias("source_identifier"), "contract_id", "contract_version",
        source_identity("contract_id", "contract_version", F.lit(None).cast("string"),
                        F.lit(None).cast("string")).alias("source_id"),
        F.lit(False).alias("supported"))
    unknown = file_verdicts(unknown, none, counts, outcomes)
    return verdicts.unionByName(lost).join(
        wanted, ["contract_id", "contract_version"], "left_semi").unionByName(unknown)


def replay_equivalence(first: DataFrame, second: DataFrame, ignore=("run_id",), by: str | None = None) -> DataFrame:
    """Rows that differ between two runs once the run id is dropped
    (empty when the runs are equivalent), tagged with the side they came from.

    ``by``: a column whose groups are compared apart, by default the file if there is one."""
    a = first.drop(*[c for c in ignore if c in first.columns])
    b = second.drop(*[c for c in ignore if c in second.columns])
    if by is None:
        by = next((c for c in ("source_id", "source_identifier") if c in a.columns), None)
    return multiset_difference(a, b, by)


def ingest_files(spark, root: str, contract: Contract, registry=None,
                 run_id: str | None = None, files: DataFrame | None = None) -> Ingested:
    """P16 over governed CSV files under ``root``: listing -> hash/identity ->
    parse (block by block) -> structural and header checks ->
    validation ... -> quality, for every file of ``contract``.

    ``files``: a listing to use instead, also one with a content column."""
    from sluice.operators.contracts import ContractRegistry
    from sluice.operators.validate import file_status, project_by_name
    from sluice.sources.csv import read_governed_csv
    from sluice.sources.files import list_source_files

    reg = registry or ContractRegistry.of(contract)
    files = (files if files is not None else list_source_files(spark, root, reg)).where(
        (F.col("contract_id") == contract.contract_id)
        & (F.col("contract_version") == contract.version))
    parsed = read_governed_csv(files)  # its steps read a checkpoint, not the files again
    status = file_status(parsed.where(F.col("kind") == "file"), contract)
    structural = status.where(F.col("file_failure").isNotNull()).select(
        "source_id", F.col("file_failure").alias("failure_category"))
    rows = project_by_name(
        parsed.where(F.col("kind") == "row").join(structural.select("source_id"), "source_id", "left_anti"),
        contract)
    ing = ingest_rows(rows, contract, run_id, file_failures=structural)
    ing.files = parsed.where(F.col("kind") == "file").select(
        "source_id", "source_identifier", "contract_id", "contract_version")
    return ing
