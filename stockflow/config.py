"""Typed configuration: one ``SourceConfig`` per source, one ``RunContext`` per run."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame

# --- Fixed values -----------------------------------------------------------

PLATFORM_ZONE = ZoneInfo("America/New_York")

# Schemas every environment needs before the first write.
LAYERS = ("raw", "stg", "core", "out", "cfg", "log", "sbx")

# Refresh cadence -> (warn, fail) age of a source file in hours; None skips the check.
CADENCE_HOURS: Mapping[str, tuple[float | None, float | None]] = {
    "daily": (30, 54),
    "every_other_day": (58, 96),
    "weekly": (192, 216),
    "bi_weekly": (360, 384),
    "monthly": (768, 792),
    "ad_hoc": (None, None),
}

# Text a delimited file uses for "no value"; the usual dataframe-reader defaults.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Standard columns of the customer-inventory domain.
INVENTORY_REQUIRED = ("location", "item", "on_hand_qty")
INVENTORY_OPTIONAL = ("in_transit_qty", "max_order_qty")

# Header statuses that never count as orders.
EXCLUDED_HEADER_STATUSES = ("DOO_DRAFT", "DOO_REFERENCE")

# Line status, order types and name fragment that never count as in transit.
CANCELED_LINE_STATUS = "CANCELED"
EXCLUDED_ORDER_TYPES = (
    "BAILMENT - RETURN ORDER",
    "BILLING ORDER",
    "DESTRUCTION ORDER",
    "INTERCOMPANY ORDER",
    "RETURN ORDER",
)
PALLET_FRAGMENT = "PALLET"
CHARGE_SKUS = ("PALLETSLIPCHG",)

DEFAULT_COMPANIES = ("SA",)

# Distributor location code -> customer code with delivery address.
DISTRIBUTOR_LOCATIONS = {
    "ABQ": "1056497 001",
    "ATL": "1056527 001",
    "SAV": "1056529 001",
}

# ----------------------------------------------------------------------------


@dataclass(frozen=True)
class SourceConfig:
    """Everything that differs between two sources.

    ``expected_columns`` and ``required_columns`` use sanitised file names;
    ``business_key``, ``text_columns`` and ``quantity_columns`` use the names
    after ``renames``.
    """

    source_name: str
    domain: str
    src_path: str
    src_format: str = "csv"
    delimiter: str = ","
    encoding: str = "utf-8"
    multi_line: bool = False
    # Sheets only: most columns of a line, and other names a wanted column goes by.
    sheet_width: int = 64
    aliases: Mapping[str, str] = field(default_factory=dict)
    na_tokens: tuple[str, ...] = NA_TOKENS
    env: str = "dev"
    notebook_type: str = "source"
    expected_columns: tuple[str, ...] = ()
    required_columns: tuple[str, ...] = ()
    business_key: tuple[str, ...] = ()
    renames: Mapping[str, str] = field(default_factory=dict)
    text_columns: tuple[str, ...] = ()
    quantity_columns: tuple[str, ...] = ()
    header_key: str | None = None
    header_literals: tuple[str, ...] = ()
    custom: Callable[[DataFrame], DataFrame] | None = None
    min_rows: int = 1
    max_rows: int | None = None
    refresh_cadence: str = "daily"
    warn_hours: float | None = 30
    fail_hours: float | None = 54
    owner: str = ""
    delivery_method: str = "lakehouse"
    table_format: str = "parquet"

    def __post_init__(self) -> None:
        if self.env not in ("dev", "prod"):
            raise ValueError(f"env must be 'dev' or 'prod', not {self.env!r}")

    def _table(self, layer: str) -> str:
        name = f"{self.domain}_{self.source_name}"
        return f"sbx.{name}_{layer}" if self.env == "dev" else f"{layer}.{name}"

    @property
    def raw_table(self) -> str:
        return self._table("raw")

    @property
    def stg_table(self) -> str:
        return self._table("stg")

    @property
    def rejects_table(self) -> str:
        return f"{self.stg_table}_rejects"

    def staged_name(self, column: str) -> str:
        """Name a file column carries after the renames."""
        return self.renames.get(column, column)

    @property
    def staged_required(self) -> tuple[str, ...]:
        """Required columns under their staged names, so the staged gate sees them."""
        return tuple(self.staged_name(c) for c in self.required_columns)

    @property
    def raw_quantities(self) -> tuple[str, ...]:
        """Quantity columns under their file names."""
        back = {new: old for old, new in self.renames.items()}
        return tuple(back.get(c, c) for c in self.quantity_columns)


@dataclass(frozen=True)
class RunContext:
    """Identity of one run. The date is taken from the Eastern timestamp, so an
    evening run on a UTC host still lands in the right partition."""

    run_id: str
    load_timestamp: datetime
    src_file_name: str = ""

    @classmethod
    def start(cls, src_file_name: str = "", now: datetime | None = None) -> RunContext:
        return cls(str(uuid.uuid4()), now or datetime.now(PLATFORM_ZONE), src_file_name)

    def part(self, name: str, src_file_name: str = "") -> RunContext:
        """The context of one step of this run; a rerun gives the step the same identity."""
        return RunContext(f"{self.run_id}-{name}", self.load_timestamp, src_file_name)

    @property
    def load_date(self) -> date:
        return self.load_timestamp.astimezone(PLATFORM_ZONE).date()
