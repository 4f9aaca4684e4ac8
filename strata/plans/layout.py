"""Where each layer lives under a lake root (local path or Hadoop URI)."""

from __future__ import annotations

from dataclasses import dataclass

from strata.contracts import (
    BRONZE_DIR,
    CUSTOMER_STATE_NAME,
    GOLD_CUSTOMER_NAME,
    GOLD_DIR,
    GOLD_QUALITY_NAME,
    GOLD_SALES_NAME,
    QUARANTINE_NAME,
    SILVER_DIR,
)
from strata.operators.lineage import child


@dataclass(frozen=True)
class Lake:
    base: str

    @property
    def bronze(self) -> str:
        return child(self.base, *BRONZE_DIR)

    @property
    def silver(self) -> str:
        return child(self.base, *SILVER_DIR)

    @property
    def rejected(self) -> str:
        """Quarantine, beside the Silver table."""
        return child(self.base, *SILVER_DIR[:-1], QUARANTINE_NAME)

    @property
    def gold(self) -> str:
        return child(self.base, *GOLD_DIR)

    @property
    def gold_sales(self) -> str:
        return child(self.gold, GOLD_SALES_NAME)

    @property
    def gold_customer(self) -> str:
        return child(self.gold, GOLD_CUSTOMER_NAME)

    @property
    def customer_state(self) -> str:
        """Orders per customer and day that refreshes of the customer table build on."""
        return child(self.gold, CUSTOMER_STATE_NAME)

    @property
    def gold_quality(self) -> str:
        return child(self.gold, GOLD_QUALITY_NAME)
