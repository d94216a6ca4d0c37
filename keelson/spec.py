"""Table descriptions as plain data: file contract, cleansing spec, run identity."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import types as T


@dataclass(frozen=True)
class Run:
    """Identity of one load. Passed in, never read from a clock inside an operator, so that
    repeating a run gives the same rows."""

    run_id: str
    batch_id: str
    as_of: datetime
    source_system: str
    load_type: str = "INCREMENTAL"

    @classmethod
    def start(cls, source_system: str, load_type: str = "INCREMENTAL") -> Run:
        now = datetime.now(timezone.utc)
        return cls(str(uuid.uuid4()), now.strftime("%Y%m%d%H%M%S"), now, source_system, load_type)


@dataclass(frozen=True)
class Contract:
    """What a CSV drop must look like."""

    columns: tuple[str, ...]
    # Keep columns a drop has beside these, as text.
    keep_extra: bool = False
    # Keep malformed rows whole, as text, instead of cutting and padding them.
    rescue: bool = False
    delimiter: str = ","
    quote: str = '"'
    escape: str = '"'

    def csv_options(self) -> dict[str, str]:
        return {"header": "true", "sep": self.delimiter, "quote": self.quote, "escape": self.escape}


@dataclass(frozen=True)
class CodeMap:
    """Groups of codes in ``source`` become a label in ``target``."""

    source: str
    target: str
    groups: Mapping[str, tuple[str, ...]]
    default: str


@dataclass(frozen=True)
class TableSpec:
    """How one table is cleansed, deduplicated and upserted. Rules and standardisations are SQL
    expressions; rules see the standardised values."""

    key: str
    order_by: str
    tie_break: tuple[str, ...]
    standardise: Mapping[str, str]
    code_map: CodeMap
    tracked: tuple[str, ...]
    rules: Mapping[str, str]
    hash_column: str = "_record_hash"
    updated_at: str = "_silver_update_ts"
    # None: a changed row takes every column of its source row, lineage included.
    update_columns: tuple[str, ...] | None = None
    null_safe_hash: bool = False
    cluster_by: tuple[str, ...] = field(default=())


# --- Fixed values: columns, codes, rules and formats results depend on ---------------------

CUSTOMER_COLUMNS = (
    "customer_id",
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
)

# Columns of the null report.
NULL_COUNTS = {
    "null_customer_id": "customer_id",
    "null_unique_id": "customer_unique_id",
    "null_zip": "customer_zip_code_prefix",
    "null_city": "customer_city",
    "null_state": "customer_state",
}

REGIONS = {
    "Norte": ("AC", "AP", "AM", "PA", "RO", "RR", "TO"),
    "Nordeste": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Centro-Oeste": ("DF", "GO", "MT", "MS"),
    "Sudeste": ("ES", "MG", "RJ", "SP"),
    "Sul": ("PR", "RS", "SC"),
}

HASH_SEPARATOR = "||"

CUSTOMER_RULES = {
    "DQ-01": "customer_id IS NOT NULL",
    "DQ-02": "customer_unique_id IS NOT NULL",
    "DQ-03": "length(customer_state) = 2",
    # \z, not $: $ would let a trailing line break through.
    "DQ-04": r"customer_zip_code_prefix RLIKE '^[0-9]+\\z'",
}

# For contracts that rescue malformed rows: these rows break this rule first.
RESCUE_RULE = {"DQ-00": "_rescued_row IS NULL"}

# Update only these on a changed row; the rest of the row keeps its first insert.
CONTENT_COLUMNS = (
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
    "customer_region",
    "_record_hash",
    "_silver_update_ts",
    "_batch_id",
)

# --------------------------------------------------------------------------------------------

CUSTOMER_CONTRACT = Contract(CUSTOMER_COLUMNS)

CUSTOMER_SPEC = TableSpec(
    key="customer_id",
    order_by="_created_at",
    tie_break=(
        "_source_file_name",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    ),
    standardise={
        "customer_city": "upper(trim(customer_city))",
        "customer_state": "upper(trim(customer_state))",
        "customer_zip_code_prefix": "trim(customer_zip_code_prefix)",
    },
    code_map=CodeMap("customer_state", "customer_region", REGIONS, "Unknown"),
    tracked=("customer_zip_code_prefix", "customer_city", "customer_state"),
    rules=CUSTOMER_RULES,
    cluster_by=("customer_state",),
)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_text = T.StringType()

BRONZE_SCHEMA = _schema(
    *((name, _text) for name in CUSTOMER_COLUMNS),
    ("_pipeline_run_id", _text),
    ("_batch_id", _text),
    ("_source_system", _text),
    ("_load_type", _text),
    ("_created_at", T.TimestampType()),
    ("_ingestion_date", T.DateType()),
    ("_source_file_path", _text),
    ("_source_file_name", _text),
)

SILVER_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields
    + _schema(
        ("customer_region", _text),
        ("_record_hash", _text),
        ("_silver_update_ts", T.TimestampType()),
    ).fields
)

QUARANTINE_SCHEMA = T.StructType(
    BRONZE_SCHEMA.fields
    + _schema(
        ("_dq_error_reason", _text),
        ("_quarantine_ts", T.TimestampType()),
        ("_quarantine_run_id", _text),
    ).fields
)

GOLD_SCHEMA = _schema(
    ("SurrogateKey", _text),
    ("BusinessKey_CustomerID", _text),
    ("customer_unique_id", _text),
    ("customer_zip_code_prefix", _text),
    ("customer_city", _text),
    ("customer_state", _text),
    ("customer_region", _text),
    ("_record_hash", _text),
    ("Version", T.IntegerType()),
    ("IsCurrent", T.BooleanType()),
    ("EffectiveStartDate", T.TimestampType()),
    ("EffectiveEndDate", T.TimestampType()),
    ("_audit_insert_batch", _text),
    ("_audit_update_batch", _text),
)
