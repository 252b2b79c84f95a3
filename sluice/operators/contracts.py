"""Source contracts (E4), the registry (P1) and the directory mapping (S3).

A contract is a small driver-side spec; operators turn it into ``Column``
expressions.  User-defined contracts work exactly like the built-ins."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STRING, DECIMAL, TIMESTAMP = "STRING", "DECIMAL", "TIMESTAMP"
NON_NEGATIVE = "NON_NEGATIVE"
POSITIVE = "POSITIVE"
UPPERCASE_CURRENCY_CODE = "UPPERCASE_CURRENCY_CODE"
TIMEZONE_AWARE = "TIMEZONE_AWARE"
_TYPES = (STRING, DECIMAL, TIMESTAMP)
_CONSTRAINTS = (NON_NEGATIVE, POSITIVE, UPPERCASE_CURRENCY_CODE, TIMEZONE_AWARE)


@dataclass(frozen=True)
class Field:
    name: str
    type: str = STRING
    nullable: bool = False
    constraints: tuple[str, ...] = ()

    def __post_init__(self):
        if not self.name or self.name != self.name.strip():
            raise ValueError("field name must be non-blank")
        if self.type not in _TYPES:
            raise ValueError(f"unsupported field type {self.type!r}")
        for c in self.constraints:
            if c not in _CONSTRAINTS:
                raise ValueError(f"unsupported constraint {c!r}")


@dataclass(frozen=True)
class Contract:
    contract_id: str
    version: int
    fields: tuple[Field, ...]
    directory: str = ""
    channel: str | None = None
    kind: str = "sales"  # "sales" or "product"

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError("contract field names must be unique")
        if not isinstance(self.version, int) or self.version <= 0:
            raise ValueError("contract version must be a positive integer")

    @property
    def key(self) -> tuple[str, int]:
        return (self.contract_id, self.version)

    @property
    def header_names(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> Field:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)


# The three approved v1 source contracts, in contract field order.
PRODUCT_CATALOG_V1 = Contract(
    "northstar.product_catalog", 1,
    (
        Field("sku"),
        Field("product_name"),
        Field("category_code"),
        Field("list_price", DECIMAL, True, (NON_NEGATIVE,)),
        Field("unit_cost", DECIMAL, True, (NON_NEGATIVE,)),
        Field("currency_code", STRING, True, (UPPERCASE_CURRENCY_CODE,)),
    ),
    directory="product_catalog/v1", kind="product",
)
ECOMMERCE_SALES_V1 = Contract(
    "northstar.ecommerce_sales", 1,
    (
        Field("order_number"),
        Field("order_timestamp", TIMESTAMP, False, (TIMEZONE_AWARE,)),
        Field("customer_email", STRING, True),
        Field("sku"),
        Field("quantity", DECIMAL, False, (POSITIVE,)),
        Field("unit_price", DECIMAL, False, (NON_NEGATIVE,)),
        Field("currency_code", STRING, False, (UPPERCASE_CURRENCY_CODE,)),
    ),
    directory="ecommerce_sales/v1", channel="ECOMMERCE",
)
RETAIL_SALES_V1 = Contract(
    "northstar.retail_sales", 1,
    (
        Field("receipt_number"),
        Field("transaction_timestamp", TIMESTAMP, False, (TIMEZONE_AWARE,)),
        Field("store_code"),
        Field("terminal_id"),
        Field("sku"),
        Field("quantity", DECIMAL, False, (POSITIVE,)),
        Field("unit_price", DECIMAL, False, (NON_NEGATIVE,)),
        Field("currency_code", STRING, False, (UPPERCASE_CURRENCY_CODE,)),
    ),
    directory="retail_sales/v1", channel="RETAIL",
)
BUILT_IN_CONTRACTS = (PRODUCT_CATALOG_V1, ECOMMERCE_SALES_V1, RETAIL_SALES_V1)


@dataclass
class ContractRegistry:
    """Exact (id, version) lookup; no fallback to another version."""

    contracts: dict[tuple[str, int], Contract] = field(default_factory=dict)

    @classmethod
    def of(cls, *contracts: Contract) -> "ContractRegistry":
        reg = cls()
        for c in contracts:
            reg.register(c)
        return reg

    def register(self, contract: Contract) -> None:
        if contract.key in self.contracts:
            raise ValueError(f"duplicate contract {contract.key}")
        self.contracts[contract.key] = contract

    def resolve(self, contract_id: str, version: int) -> Contract:
        if (contract_id, version) in self.contracts:
            return self.contracts[(contract_id, version)]
        if any(cid == contract_id for cid, _ in self.contracts):
            raise LookupError("this version of the contract is not registered")
        raise LookupError("the contract is not registered")

    def to_frame(self, spark: SparkSession) -> DataFrame:
        """The registry as a tiny DataFrame (one row per contract)."""
        rows = [(c.contract_id, c.version, c.directory, c.channel, c.kind)
                for c in self.contracts.values()]
        return spark.createDataFrame(
            rows, "contract_id string, contract_version int, directory string, "
                  "channel string, kind string")


BUILT_IN_REGISTRY = ContractRegistry.of(*BUILT_IN_CONTRACTS)


def resolve_contract(requests: DataFrame, registry: ContractRegistry,
                     id_col: str = "contract_id",
                     version_col: str = "contract_version") -> DataFrame:
    """Classify requested contract keys.

    Adds ``resolution``: ``RESOLVED``, ``UNSUPPORTED_VERSION`` (id known,
    version not) or ``UNKNOWN_CONTRACT``.  The registry side is bounded by the
    number of registered contracts, so it is broadcast."""
    spark = requests.sparkSession
    reg = registry.to_frame(spark)
    exact = F.broadcast(reg.select(
        F.col("contract_id").alias("_rid"), F.col("contract_version").alias("_rver"),
        F.lit(True).alias("_exact")))
    ids = F.broadcast(reg.select(F.col("contract_id").alias("_kid")).distinct()
                      .withColumn("_known", F.lit(True)))
    out = (
        requests.join(exact, (F.col(id_col) == F.col("_rid"))
                      & (F.col(version_col) == F.col("_rver")), "left")
        .join(ids, F.col(id_col) == F.col("_kid"), "left")
    )
    resolution = (
        F.when(F.col("_exact"), F.lit("RESOLVED"))
        .when(F.col("_known"), F.lit("UNSUPPORTED_VERSION"))
        .otherwise(F.lit("UNKNOWN_CONTRACT"))
    )
    return out.withColumn("resolution", resolution).drop(
        "_rid", "_rver", "_exact", "_kid", "_known")


def contract_for_path(files: DataFrame, registry: ContractRegistry,
                      path_col: str = "source_identifier") -> DataFrame:
    """S3: attach the contract whose directory holds the file
    (``<family>/v<version>/<name>``); unmatched files get null ids."""
    reg = F.broadcast(registry.to_frame(files.sparkSession).select(
        F.col("directory").alias("_dir"), "contract_id", "contract_version"))
    parent = F.regexp_extract(F.col(path_col), "\\A(.*)/[^/]*\\z", 1)
    return files.join(reg, parent == F.col("_dir"), "left").drop("_dir")
